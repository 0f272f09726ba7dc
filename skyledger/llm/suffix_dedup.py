"""Removal of repeated byte strings by difference-cover blockwise suffix sorting.

Every byte covered by a string of ``min_bytes`` (100) bytes that also starts
earlier (smaller document id, or same document and earlier start) is removed.
Strings are judged on the input and never cross documents.

Method.  A suffix matters only as far as its first 100 bytes, and only where
another suffix ties with it.  Places of a document whose offset modulo 31 lies
in a difference cover (6 of 31 residues) are the cover sample: whenever the
strings at i and j are equal, some d < 31 puts both i + d and j + d into the
sample, and there they share at least 70 bytes.

1. Cover sample.  The sample's suffixes are sorted on (a fingerprint of) 70
   bytes, one bucket of the key range at a time.  Suffixes whose windows hold
   no tied sample have no equal and drop out.
2. Long ties.  Tied samples are sorted on 131 bytes.  A sample that is not the
   first of its rank settles its 32 windows at once, so the inside of long
   repeats is never sorted place by place.
3. Blocks.  The suffixes that are left are sorted on 100 bytes, again one
   bucket at a time; all but the first of each run of equal ones are repeats.

Ties, not alphabetical order, decide here, so the sort key of a suffix is a
64-bit fingerprint of its prefix (a polynomial over random byte values,
modulo 2^64, then mixed) instead of the bytes: a suffix costs 8 bytes or less
on the wire, never 100.  Step 1 uses short fingerprints, as a false tie there
only leaves more for step 3.

Layout.  Documents are dealt once into chunks of 1 to 32 MB and kept as a
bucketed table, so every later step finds a chunk's rows together without a
shuffle.  A chunk sends, per bucket of the key range, its distinct keys as one
delta-coded blob (a key that a chunk holds many times travels once), and gets
back one bit per key.  Both the chunks and the buckets stay bounded in size
as the input grows, and a passage that every document holds costs a bucket at
most one key per chunk.

Defined results: a null text is empty; texts under 100 bytes lose nothing; ids
must be integers, a null id comes before all others; rows with equal ids are
taken as separate documents in a fixed order, so of identical rows one stays;
extra columns pass unchanged.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import dealt_table, materialize, text_of, worker_store

MIN_BYTES = 100
COVER_PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)  # every residue mod 31 is a difference of two of these
# Between their bounds both grow with the input, a 256th of it each.  The upper bounds are for
# about 1 GB of Python memory a core; raise them with it, as larger chunks and buckets mean fewer blobs.
SMALLEST_CHUNK, LARGEST_CHUNK = 1 << 20, 32 << 20  # bytes of text
SMALLEST_BUCKET, LARGEST_BUCKET = 1 << 18, 1 << 23  # keys
SPARE_BITS = 10  # step 1: keys have log2(samples) + 10 bits, so about 0.1 % are false ties

_CODEC = "zstd"
_STEP = 1 << 19  # places hashed at a time
_BASE = 0x9E3779B97F4A7C15
_CHUNK, _ID, _TEXT, _ROW = "_chunk", "_id", "_text", "_row"  # _row: the caller's columns, whatever their names
_RESULT = ("n_bytes", "spans", "kept")


class Hasher:
    """Fingerprints of fixed-length byte windows by a rolling polynomial."""

    def __init__(self, longest: int):
        seed = b"".join(hashlib.sha256(b"byte %d" % k).digest()[:8] for k in range(256))
        self.values = np.frombuffer(seed, dtype="<u8") | np.uint64(1)
        n = _STEP + longest
        self.powers = self._powers(_BASE, n)
        self.inverse = self._powers(pow(_BASE, -1, 1 << 64), _STEP)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out)

    def keys(self, data: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
        """A key of ``data[p : p + length]`` for every p in ``places`` (sorted)."""
        out = np.empty(len(places), dtype=np.uint64)
        for first in range(0, len(data), _STEP):
            lo, hi = np.searchsorted(places, (first, first + _STEP))
            if lo == hi:
                continue
            part = self.values[data[first : first + _STEP + length]]
            part *= self.powers[: len(part)]
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(part, out=sums[1:])
            p = places[lo:hi] - first
            out[lo:hi] = (sums[p + length] - sums[p]) * self.inverse[p]
        out ^= out >> np.uint64(33)
        out *= np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(33)
        out *= np.uint64(0xC4CEB9FE1A85EC53)
        return out ^ (out >> np.uint64(33))


def _pack(values: np.ndarray) -> bytes:
    """64-bit values as compressed byte planes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), codec=_CODEC, asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    planes = pa.decompress(data, decompressed_size=8 * n, codec=_CODEC, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(8, n).T).view(np.uint64).ravel()


def _spread(first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """True at every place in some [first, last); both come in ascending order."""
    some = last > first
    first, last = first[some], last[some]
    marks = np.zeros(n + 1, dtype=np.int8)
    if len(first):
        apart = first[1:] > last[:-1]  # runs that neither overlap nor touch
        marks[first[np.append(True, apart)]] = 1
        marks[last[np.append(apart, True)]] = -1
    return np.cumsum(marks[:n], dtype=np.int8).view(bool)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order, the first place of each, which of them each place has, counts."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.flatnonzero(new)
    first = np.minimum.reduceat(order, at) if len(at) else order
    which = np.empty(len(keys), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    return ranked[at], first, which, np.diff(np.append(at, len(keys)))


class Plan:
    """Sizes that all tasks share."""

    def __init__(self, total_bytes: int, min_bytes: int):
        self.min_bytes = min_bytes
        self.sample_bytes = min_bytes - COVER_PERIOD + 1
        self.settled_bytes = min_bytes + COVER_PERIOD
        chunk = min(LARGEST_CHUNK, max(SMALLEST_CHUNK, total_bytes // 256))
        self.n_chunks = max(1, -(-total_bytes // chunk))
        samples = max(1, total_bytes * len(COVER) // COVER_PERIOD)
        bucket = min(LARGEST_BUCKET, max(SMALLEST_BUCKET, samples // 256))
        self.n_buckets = max(1, -(-samples // bucket))
        self.key_bits = min(64, samples.bit_length() + SPARE_BITS)


class Chunk:
    """The documents of one chunk, in the order of their ids, as one byte array."""

    def __init__(self, rows: pa.Table, plan: Plan):
        self.rows = rows.sort_by([(_ID, "ascending"), (_TEXT, "ascending")])
        self.plan = plan
        texts = [t or b"" for t in self.rows.column(_TEXT).cast(pa.binary()).to_pylist()]
        self.data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.ids = self.rows.column(_ID).to_numpy()
        store, sizes = worker_store(), (plan.settled_bytes, _STEP)
        if store.get("hasher_of") != sizes:
            store["hasher_of"], store["hasher"] = sizes, Hasher(plan.settled_bytes)
        self.hasher = store["hasher"]

    def samples(self) -> np.ndarray:
        """Places of the cover sample whose first ``sample_bytes`` lie in their document."""
        longest = int((self.ends - self.starts).max(initial=0))
        offsets = np.arange(longest, dtype=np.int64)
        offsets = offsets[np.isin(offsets % COVER_PERIOD, COVER)]
        counts = np.searchsorted(offsets, self.ends - self.starts - self.plan.sample_bytes, side="right")
        parts = [offsets[:n] + s for n, s in zip(counts.tolist(), self.starts.tolist(), strict=True) if n]
        return np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)

    def first_ids(self, places: np.ndarray) -> np.ndarray:
        return self.ids[np.searchsorted(self.ends, places, side="right")]

    # Each step: its places, their keys, the distinct keys, which of them each place has.
    def step1(self):
        places = self.samples()
        keys = self.hasher.keys(self.data, places, self.plan.sample_bytes)
        keys >>= np.uint64(64 - self.plan.key_bits)
        return places, *_distinct(keys)

    def step2(self, answer1: np.ndarray):
        """Tied samples; also the mask of windows that hold one."""
        places, _, _, which, counts = self.step1()
        tied = places[(answer1 | (counts > 1))[which]]
        doc = np.searchsorted(self.ends, tied, side="right")
        n = len(self.data)
        open_windows = _spread(np.maximum(tied - (COVER_PERIOD - 1), self.starts[doc]), tied + 1, n)
        closing = np.maximum(self.starts, self.ends - self.plan.min_bytes + 1)
        open_windows &= _spread(self.starts, closing, n)
        long = tied[tied + self.plan.settled_bytes <= self.ends[doc]]
        keys = self.hasher.keys(self.data, long, self.plan.settled_bytes)
        return open_windows, long, *_distinct(keys)

    def step3(self, answer1: np.ndarray, answer2: np.ndarray):
        """Windows that long ties left open; also the samples that settled theirs."""
        open_windows, long, _, first, which, _ = self.step2(answer1)
        settled = long[self._later(answer2, first, which)]
        open_windows &= ~_spread(settled, settled + COVER_PERIOD + 1, len(self.data))
        places = np.flatnonzero(open_windows)
        keys = self.hasher.keys(self.data, places, self.plan.min_bytes)
        return settled, places, *_distinct(keys)

    @staticmethod
    def _later(answer: np.ndarray, first: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Not the first of its key anywhere: answered so, or not the first in this chunk."""
        later = answer[which]
        local = np.ones(len(which), dtype=bool)
        local[first] = False
        return later | local

    def removed(self, answer1, answer2, answer3) -> np.ndarray:
        settled, places, _, first, which, _ = self.step3(answer1, answer2)
        later = places[self._later(answer3, first, which)]
        n = len(self.data)
        return _spread(settled, settled + self.plan.settled_bytes, n) | _spread(
            later, later + self.plan.min_bytes, n
        )


_REQUEST = "bucket int, chunk int, n int, keys binary, ids binary"
_ANSWER = "step int, chunk int, bucket int, n int, bits binary"


def _buckets(keys: np.ndarray, bits: int, n_buckets: int) -> np.ndarray:
    """Bounds in sorted ``keys`` of every bucket of the key range."""
    top = min(bits, 32)
    bucket = ((keys >> np.uint64(bits - top)) * np.uint64(n_buckets)) >> np.uint64(top)
    return np.searchsorted(bucket, np.arange(n_buckets + 1, dtype=np.uint64))


def _requests(chunk: int, keys: np.ndarray, ids: np.ndarray | None, bits: int, plan: Plan) -> pa.Table:
    rows = []
    bounds = _buckets(keys, bits, plan.n_buckets)
    for bucket in np.flatnonzero(np.diff(bounds)).tolist():
        lo, hi = bounds[bucket], bounds[bucket + 1]
        deltas = np.diff(keys[lo:hi], prepend=np.uint64(0))
        rows.append((bucket, chunk, int(hi - lo), _pack(deltas), None if ids is None else _pack(ids[lo:hi])))
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    names = ("bucket", "chunk", "n", "keys", "ids")
    return pa.table({k: pa.array(c, t) for k, c, t in zip(names, columns, kinds, strict=True)})


def _sorted_bucket(step: int) -> Callable[[pa.Table], pa.Table]:
    """Sorts one bucket and answers every chunk: ties (step 1) or not the first (steps 2, 3)."""

    def sort(requests: pa.Table) -> pa.Table:
        requests = requests.sort_by("chunk")
        counts = requests.column("n").to_pylist()
        packed = zip(requests.column("keys").to_pylist(), counts, strict=True)
        keys = np.concatenate([np.cumsum(_unpack(k, n)) for k, n in packed])
        if step == 1:
            order = np.argsort(keys)
        else:
            packed = zip(requests.column("ids").to_pylist(), counts, strict=True)
            ids = np.concatenate([_unpack(k, n) for k, n in packed]).view(np.int64)
            order = np.lexsort((ids, keys))  # stable: equal ids in the order of chunks
        keys = keys[order]
        same = keys[1:] == keys[:-1]
        answer = np.zeros(len(keys), dtype=bool)
        answer[order[1:]] = same
        if step == 1:
            answer[order[:-1]] |= same
        bits = [np.packbits(x).tobytes() for x in np.split(answer, np.cumsum(counts)[:-1])]
        n = requests.num_rows
        return pa.table(
            {
                "step": pa.array([step] * n, pa.int32()),
                "chunk": requests.column("chunk").cast(pa.int32()),
                "bucket": requests.column("bucket").cast(pa.int32()),
                "n": requests.column("n").cast(pa.int32()),
                "bits": pa.array(bits, pa.binary()),
            }
        )

    return sort


def _answers(rows: pa.Table) -> dict[int, np.ndarray]:
    """The answers to one chunk by step, in the order of its distinct keys."""
    out = {}
    rows = rows.sort_by([("step", "ascending"), ("bucket", "ascending")])
    steps = rows.column("step").to_pylist()
    packed = zip(steps, rows.column("n").to_pylist(), rows.column("bits").to_pylist(), strict=True)
    for step, n, bits in packed:
        part = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=n).astype(bool)
        out.setdefault(step, []).append(part)
    none = np.zeros(0, dtype=bool)
    return {k: np.concatenate(out[k]) if k in out else none for k in (1, 2, 3)}


def _asking(step: int, plan: Plan) -> Callable:
    def ask(rows: pa.Table, answers: pa.Table) -> pa.Table:
        chunk, number = Chunk(rows, plan), rows.column(_CHUNK)[0].as_py()
        got = _answers(answers)
        if step == 1:
            return _requests(number, chunk.step1()[1], None, plan.key_bits, plan)
        if step == 2:
            _, places, keys, first, _, _ = chunk.step2(got[1])
        else:
            _, places, keys, first, _, _ = chunk.step3(got[1], got[2])
        return _requests(number, keys, chunk.first_ids(places[first]), 64, plan)

    return ask


def _whole_characters(text: bytes, spans: list[dict]) -> str:
    """The text without the spans, each shrunk to whole UTF-8 characters."""
    kept, at = [], 0
    for span in spans:
        start, end = span["start"], span["start"] + span["length"]
        while start < end and text[start] & 0xC0 == 0x80:  # inside a character that began before
            start += 1
        while end > start and end < len(text) and text[end] & 0xC0 == 0x80:  # cuts the last character
            end -= 1
        kept.append(text[at:start])
        at = end
    kept.append(text[at:])
    return b"".join(kept).decode("utf-8")


def _finish(plan: Plan, columns: list[str], as_text: bool) -> Callable:
    def finish(rows: pa.Table, answers: pa.Table) -> pa.Table:
        chunk, got = Chunk(rows, plan), _answers(answers)
        gone = chunk.removed(got[1], got[2], got[3])
        spans, kept = [], []
        for start, end in zip(chunk.starts.tolist(), chunk.ends.tolist(), strict=True):
            mask = gone[start:end]
            edges = np.flatnonzero(np.diff(mask, prepend=False, append=False)).tolist()
            spans.append([{"start": a, "length": b - a} for a, b in zip(edges[::2], edges[1::2], strict=True)])
            whole = chunk.data[start:end]
            if as_text:
                kept.append(_whole_characters(whole.tobytes(), spans[-1]))
            else:
                kept.append((whole[~mask] if edges else whole).tobytes())
        out = chunk.rows.select(columns)
        out = out.append_column("n_bytes", pa.array(chunk.ends - chunk.starts, pa.int64()))
        span = pa.struct([("start", pa.int64()), ("length", pa.int64())])
        out = out.append_column("spans", pa.array(spans, pa.list_(span)))
        return out.append_column("kept", pa.array(kept, pa.string() if as_text else pa.binary()))

    return finish


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_bytes: int = MIN_BYTES,
    as_text: bool = False,
) -> DataFrame:
    """The rows of ``docs``, all columns but the text, with ``n_bytes`` (of the text), ``spans``
    (the removed runs: start, length in bytes) and ``kept``: the remaining bytes, or with ``as_text``
    the remaining text, for which runs that cut a character are shortened to whole characters.
    These three take the place of columns of ``docs`` with their names.

    The result reads a table in the checkpoint folder (``dealt_table``); ``release`` removes it.
    """
    if not isinstance(docs.schema[id_column].dataType, T.IntegralType):
        raise TypeError(f"{id_column} must be an integer: its order says which copy is first")
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    plan = Plan(total, min_bytes)

    others = [c for c in docs.columns if c not in (text_column, *_RESULT)]
    order = F.coalesce(F.col(id_column).cast("bigint"), F.lit(-(2**63)))
    number = F.pmod(F.xxhash64(id_column, text_column), F.lit(plan.n_chunks)).cast("int")
    rows = docs.select(
        F.struct(*others).alias(_ROW), text_of(text_column).alias(_TEXT), order.alias(_ID), number.alias(_CHUNK)
    )
    table = dealt_table(rows, _CHUNK, plan.n_chunks)

    def chunks():
        return spark.table(table).groupBy(_CHUNK)

    answers = spark.createDataFrame([], _ANSWER)
    for step in (1, 2, 3):
        requests = chunks().cogroup(answers.groupBy("chunk")).applyInArrow(_asking(step, plan), _REQUEST)
        answered = requests.groupBy("bucket").applyInArrow(_sorted_bucket(step), _ANSWER)
        answers = answers.unionByName(materialize(answered, f"answers{step}"))
    span = T.StructType().add("start", T.LongType()).add("length", T.LongType())
    schema = T.StructType([spark.table(table).schema[_ROW]])
    schema = schema.add("n_bytes", T.LongType()).add("spans", T.ArrayType(span)).add("kept", T.StringType() if as_text else T.BinaryType())
    found = chunks().cogroup(answers.groupBy("chunk")).applyInArrow(_finish(plan, [_ROW], as_text), schema)
    return found.select(f"{_ROW}.*", *_RESULT)


def without_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_bytes: int = MIN_BYTES
) -> DataFrame:
    """``docs`` with every text cut to what ``remove_repeats`` keeps, all other columns unchanged."""
    others = [F.col(c) for c in docs.columns if c != text_column]
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.struct(*others).alias("row"))
    kept = remove_repeats(rows, "id", "text", min_bytes, as_text=True)
    return kept.select("row.*", F.col("kept").alias(text_column)).select(*docs.columns)
