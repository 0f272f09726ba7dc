"""Language-model scores by prediction by partial matching (PPM).

A document is read as its words (lower-cased A-Z), joined by single blanks,
and an end mark.  The model is a trie of byte contexts up to five bytes deep
with the counts of what follows each context in the training documents.  The
probability of a byte is looked up in its longest known context; if the byte
never followed it, an escape is paid, d / 2n with n symbols seen there of
which d distinct (method D: each distinct symbol cedes half a count), and the
next shorter context is tried, where symbols that the longer context already
had are excluded.  Below the empty
context all byte values not yet excluded are equally likely.  A document's
score is the log10 probability of all its bytes.

Scale.  The code length of a byte depends on the byte and the five before it
only, so it is worked out once for every distinct six-byte cell, not once for
every place.  Documents are dealt once into chunks of 1 to 16 MB, kept as a
bucketed table.  Each chunk sends its distinct cells, with their training
counts, to the trie's branches (a branch is a set of three-byte contexts with
all that lies below them); a branch merges the counts of all chunks, works
out every cell's code length in arrays, and answers each chunk.  Contexts of
two bytes or less are one table of at most 2^24 cells (a proven bound), summed
by Spark and given to all branches.  The words' training counts travel the
same way, in buckets of the words' hashes.  Nothing is capped: counts cover
all training documents, and the model grows with them.

Defined results: a null or empty text has one token, the end.  Rows are
scored one by one, so repeated rows and ids give repeated results; other
columns are ignored.  Without training documents every context is unknown,
and all byte values are equally likely.  An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import dealt_table, field, materialize, text_of

ORDER = 5  # bytes of the longest context; a cell is a context and the byte after it
LOW_ORDER = 2  # contexts up to this length are one bounded table
SMALLEST_CHUNK, LARGEST_CHUNK = 1 << 20, 16 << 20  # bytes of text
_CHUNK, _TEXT, _TRAIN = "_chunk", "_text", "_train"
_END = 0xFF  # no byte of UTF-8
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_CODEC = "zstd"
_STEP = 1 << 20  # cells worked on at a time
_WORDS, _CELLS = 0, 1  # kinds of request
_REQUEST = "kind int, bucket int, chunk int, n int, keys binary, counts binary"
_ANSWER = "kind int, bucket int, chunk int, n int, keys binary, vals binary"


def _pack(data: bytes) -> bytes:
    return pa.compress(data, codec=_CODEC, asbytes=True)


def _pack_numbers(values: np.ndarray) -> bytes:
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return _pack(np.ascontiguousarray(planes).tobytes())


def _unpack_numbers(data: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = pa.decompress(data, decompressed_size=n * size, codec=_CODEC, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).view(kind).ravel()


def _pack_words(words: list[bytes]) -> bytes:
    data = b" ".join(words)
    return len(data).to_bytes(8, "little") + _pack(data)


def _unpack_words(data: bytes) -> list[bytes]:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], decompressed_size=size, codec=_CODEC, asbytes=True).split(b" ")


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive parts of the given sizes, which may be 0."""
    out = np.zeros(len(sizes), dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    some = np.flatnonzero(sizes)
    if len(some):
        out[some] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[some], dtype=out.dtype)
    return out


def _cells(plain: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """The cells of all bytes and ends of the texts."""
    pad, end = bytes([_END] * ORDER), bytes([_END])
    data = np.frombuffer(b"".join(pad + p + end for p in plain), dtype=np.uint8)
    starts = np.cumsum(sizes + ORDER) - sizes
    here = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    here += np.arange(len(here))  # the place of every scored byte in ``data``
    wide = data.astype(np.uint64)
    cells = wide.copy()
    for k in range(1, ORDER + 1):  # the nearest byte of the context comes first
        cells[k:] |= wide[:-k] << np.uint64(8 * (ORDER + 1 - k))
    return cells[here]


class Chunk:
    """The documents of one chunk as words and as cells."""

    def __init__(self, rows: pa.Table):
        texts = [(t or b"").translate(_LOWER) for t in rows.column(_TEXT).cast(pa.binary()).to_pylist()]
        self.words = [t.split() for t in texts]
        self.train = np.array(rows.column(_TRAIN).to_pylist(), dtype=bool)
        # Bytes and the end of each document.
        self.sizes = np.array([sum(map(len, w)) + max(len(w), 1) for w in self.words], dtype=np.int64)

    def cells(self) -> Iterator[tuple[slice, np.ndarray]]:
        """Documents and their cells, in steps that bound what is held at a time."""
        done, first, ends = 0, 0, np.cumsum(self.sizes)
        while first < len(self.words):
            last = max(first + 1, int(np.searchsorted(ends, done + _STEP, side="right")))
            part = slice(first, last)
            yield part, _cells([b" ".join(w) for w in self.words[part]], self.sizes[part])
            done, first = int(ends[last - 1]), last

    def cell_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct cells of all documents, sorted, with their counts in training documents."""
        found, counts = [], []
        for part, cells in self.cells():
            train = np.repeat(self.train[part], self.sizes[part])
            seen, times = np.unique(cells[train], return_counts=True)
            others = np.unique(cells[~train])
            found += [seen, others]
            counts += [times, np.zeros(len(others), dtype=np.int64)]
        cells, which = np.unique(np.concatenate(found), return_inverse=True)
        return cells, np.bincount(which, np.concatenate(counts), len(cells)).astype(np.int64)

    @staticmethod
    def branches(cells: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """An order of the cells by branch, sorted within each; and the bounds of the branches."""
        context = cells >> np.uint64(8 * (ORDER - 2))  # three bytes
        branch = ((context * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(n_buckets)
        order = np.argsort(branch, kind="stable")
        return order, np.searchsorted(branch[order], np.arange(n_buckets + 1, dtype=np.uint64))

    def word_counts(self) -> Counter:
        """Training counts of all documents' words; the empty word is the end."""
        counts = Counter({b"": int(self.train.sum())})
        for words, train in zip(self.words, self.train.tolist(), strict=True):
            if train:
                counts.update(words)
        for words, train in zip(self.words, self.train.tolist(), strict=True):
            if not train:
                counts.update(dict.fromkeys(words, 0))
        return counts


def _ask(n_buckets: int) -> Callable[[pa.Table], pa.Table]:
    def ask(rows: pa.Table) -> pa.Table:
        number = rows.column(_CHUNK)[0].as_py()
        chunk, out = Chunk(rows), []
        counts = chunk.word_counts()
        buckets: list[list[bytes]] = [[] for _ in range(n_buckets)]
        for word in sorted(counts):
            buckets[zlib.crc32(word) % n_buckets].append(word)
        for bucket, words in enumerate(buckets):
            if words:
                n = np.fromiter(map(counts.__getitem__, words), np.int64, len(words))
                out.append((_WORDS, bucket, number, len(words), _pack_words(words), _pack_numbers(n)))
        cells, times = chunk.cell_counts()
        order, bounds = chunk.branches(cells, n_buckets)
        cells, times = cells[order], times[order]
        for bucket in np.flatnonzero(np.diff(bounds)).tolist():
            part = slice(bounds[bucket], bounds[bucket + 1])
            deltas = np.diff(cells[part], prepend=np.uint64(0))
            n = len(deltas)
            out.append((_CELLS, bucket, number, n, _pack_numbers(deltas), _pack_numbers(times[part].copy())))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        names = ("kind", "bucket", "chunk", "n", "keys", "counts")
        columns = zip(*out, strict=True)
        return pa.table({k: pa.array(c, t) for k, c, t in zip(names, columns, kinds, strict=True)})

    return ask


class CellTable:
    """Values by cell: a hash table with linear probing, filled and read in arrays."""

    def __init__(self, cells: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(cells)).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(0xFFFFFFFFFFFFFFFF))  # no cell: its top bytes are 0
        self.values = np.zeros(1 << self.bits, dtype=values.dtype)
        slot, mask = self._slot(cells), (1 << self.bits) - 1
        while len(cells):
            free = self.keys[slot] == np.uint64(0xFFFFFFFFFFFFFFFF)
            self.keys[slot[free]] = cells[free]  # of several for a slot one stays
            won = free & (self.keys[slot] == cells)
            self.values[slot[won]] = values[won]
            cells, values, slot = cells[~won], values[~won], (slot[~won] + 1) & mask

    def _slot(self, cells: np.ndarray) -> np.ndarray:
        return ((cells * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, cells: np.ndarray) -> np.ndarray:
        """The values of cells that are all in the table."""
        slot, mask = self._slot(cells), (1 << self.bits) - 1
        out = self.values[slot]
        rest = np.flatnonzero(self.keys[slot] != cells)
        slot = slot[rest]
        while len(rest):
            slot = (slot + 1) & mask
            found = self.keys[slot] == cells[rest]
            out[rest[found]] = self.values[slot[found]]
            rest, slot = rest[~found], slot[~found]
        return out


class Level:
    """All cells of one context length, with counts by cell and by context."""

    def __init__(self, cells: np.ndarray, counts: np.ndarray):
        self.cells, self.counts = cells, counts  # cells sorted and distinct
        context = cells >> np.uint64(8)
        new = np.ones(len(cells), dtype=bool)
        new[1:] = context[1:] != context[:-1]
        self.first = np.flatnonzero(new)
        self.context_of = np.cumsum(new) - 1  # by cell
        self.total = np.add.reduceat(counts, self.first)
        self.distinct = np.add.reduceat((counts > 0).astype(np.int64), self.first)

    def index(self, cells: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cells, cells)


def _shorter(cells: np.ndarray) -> np.ndarray:
    """The cells with one context byte less."""
    return (cells >> np.uint64(16) << np.uint64(8)) | (cells & np.uint64(255))


def _excluded(longer: Level, shorter: Level) -> np.ndarray:
    """By context of ``longer``: what its symbols count in the context one shorter."""
    there = shorter.counts[shorter.index(_shorter(longer.cells))]
    return np.add.reduceat(np.where(longer.counts > 0, there, 0), longer.first)


def code_lengths(cells: np.ndarray, counts: np.ndarray, low: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 probability of each cell's last byte after its context.

    ``cells``: the distinct cells of a branch, sorted, with training counts;
    ``low``: all distinct cells of LOW_ORDER context bytes, with theirs.
    """
    levels: dict[int, Level] = {}
    for order in range(LOW_ORDER, -1, -1):
        if order < LOW_ORDER:
            found, which = np.unique(_shorter(levels[order + 1].cells), return_inverse=True)
            sums = np.bincount(which, levels[order + 1].counts, len(found)).astype(np.int64)
            levels[order] = Level(found, sums)
        else:
            levels[order] = Level(*low)
    at, of = {}, cells
    for order in range(ORDER, LOW_ORDER, -1):
        found, which = np.unique(of, return_inverse=True)
        if order == ORDER:
            sums = counts
        else:
            sums = np.bincount(which, levels[order + 1].counts, len(found)).astype(np.int64)
        levels[order] = Level(found, sums)
        at[order] = which if order == ORDER else which[at[order + 1]]
        of = _shorter(found)
    for order in range(LOW_ORDER, -1, -1):
        at[order] = levels[order].index(_shorter(levels[order + 1].cells))[at[order + 1]]
    out = np.zeros(len(cells))
    open_cells = np.ones(len(cells), dtype=bool)
    for order in range(ORDER, -1, -1):
        level, cell = levels[order], at[order]
        context = level.context_of[cell]
        total, distinct = level.total[context], level.distinct[context]
        if order < ORDER:  # a longer context that was known has been tried; its symbols are out
            above = levels[order + 1]
            tried = above.context_of[at[order + 1]]
            total = total - _excluded(above, level)[tried]
            distinct = distinct - above.distinct[tried]
        count = level.counts[cell]
        hit = open_cells & (count > 0)
        out[hit] += np.log10((2 * count[hit] - 1) / (2 * total[hit]))
        open_cells &= count == 0
        escape = open_cells & (distinct > 0)
        out[escape] += np.log10(distinct[escape] / (2 * total[escape]))
    known = int(levels[0].distinct[0]) if len(levels[0].cells) else 0
    out[open_cells] += -np.log10(max(1, 256 - known))
    return out


def _answer(low: tuple[np.ndarray, np.ndarray]) -> Callable[[pa.Table], pa.Table]:
    """Merges one bucket of words, or one branch of the trie, and answers every chunk."""

    def of_words(requests: pa.Table, sizes: list[int]) -> list[bytes]:
        lists = [_unpack_words(k) for k in requests.column("keys").to_pylist()]
        counts = [
            _unpack_numbers(c, n, np.int64).tolist()
            for c, n in zip(requests.column("counts").to_pylist(), sizes, strict=True)
        ]
        total: dict[bytes, int] = {}
        for words, numbers in zip(lists, counts, strict=True):
            for word, n in zip(words, numbers, strict=True):
                total[word] = total.get(word, 0) + n
        return [_pack_numbers(np.array([total[w] for w in words], dtype=np.int64)) for words in lists]

    def of_cells(requests: pa.Table, sizes: list[int]) -> list[bytes]:
        keys = requests.column("keys").to_pylist()
        parts = [np.cumsum(_unpack_numbers(k, n, np.uint64)) for k, n in zip(keys, sizes, strict=True)]
        counts = requests.column("counts").to_pylist()
        numbers = np.concatenate([_unpack_numbers(c, n, np.int64) for c, n in zip(counts, sizes, strict=True)])
        cells, which = np.unique(np.concatenate(parts), return_inverse=True)
        sums = np.bincount(which, numbers, len(cells)).astype(np.int64)
        values = code_lengths(cells, sums, low).astype(np.float32)[which]
        return [_pack_numbers(v) for v in np.split(values, np.cumsum(sizes)[:-1])]

    def answer(requests: pa.Table) -> pa.Table:
        sizes = requests.column("n").to_pylist()
        kind = requests.column("kind")[0].as_py()
        values = (of_words if kind == _WORDS else of_cells)(requests, sizes)
        names = ["kind", "bucket", "chunk", "n", "keys"]
        return requests.select(names).append_column("vals", pa.array(values, pa.binary()))

    return answer


def _low_cells(requests: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All distinct cells of LOW_ORDER context bytes with training counts: at most 2^24 rows."""

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, n, counts in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                cells = np.cumsum(_unpack_numbers(keys, n, np.uint64))
                cells = (cells >> np.uint64(8 * (ORDER - LOW_ORDER)) & ~np.uint64(255)) | (cells & np.uint64(255))
                found, which = np.unique(cells, return_inverse=True)
                sums = np.bincount(which, _unpack_numbers(counts, n, np.int64), len(found))
                arrays = [pa.array(found.astype(np.int64)), pa.array(sums.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, names=["cell", "n"])

    parts = requests.filter(F.col("kind") == _CELLS).select("keys", "n", "counts")
    rows = parts.mapInArrow(shorten, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    table = rows.toArrow().sort_by("cell")
    return table.column("cell").to_numpy().astype(np.uint64), table.column("n").to_numpy().astype(np.int64)


def _score(tokens: int, vocabulary: int, names: list[str]) -> Callable:
    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(rows)
        words: dict[bytes, int] = {}
        cells, values = [], []
        fields = (answers.column(c).to_pylist() for c in ("kind", "n", "keys", "vals"))
        for kind, n, keys, vals in zip(*fields, strict=True):
            if kind == _WORDS:
                words.update(zip(_unpack_words(keys), _unpack_numbers(vals, n, np.int64).tolist(), strict=True))
            else:
                cells.append(np.cumsum(_unpack_numbers(keys, n, np.uint64)))
                values.append(_unpack_numbers(vals, n, np.float32))
        n_words = np.array([len(w) for w in chunk.words], dtype=np.int64)
        every = list(chain.from_iterable(chunk.words))
        counts = np.fromiter(map(words.__getitem__, every), np.int64, len(every))
        end, n_tokens = words[b""], n_words + 1
        n_known = _sums(counts > 0, n_words) + (end > 0)
        base = _sums(np.log10(counts + 1.0), n_words) + np.log10(end + 1.0)
        base -= n_tokens * np.log10(tokens + vocabulary + 1.0)
        table = CellTable(np.concatenate(cells), np.concatenate(values))
        total = np.concatenate([_sums(table.of(found), chunk.sizes[part]) for part, found in chunk.cells()])
        out = rows.select(names[:-6])
        out = out.append_column("n_bytes", pa.array(chunk.sizes))
        out = out.append_column("n_tokens", pa.array(n_tokens))
        out = out.append_column("n_known", pa.array(n_known))
        out = out.append_column("train_tokens", pa.array([tokens] * out.num_rows, pa.int64()))
        out = out.append_column("base_score", pa.array(base))
        return out.append_column("score", pa.array(total))

    return score


def score_documents(
    docs: DataFrame, train: Column, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per document: id, ``train`` (whether the model learned from it), ``n_bytes`` (scored, with the
    end), ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-one unigrams), ``score``.

    The result reads a table in the checkpoint folder (``dealt_table``); ``release`` removes it.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    chunk_bytes = min(LARGEST_CHUNK, max(SMALLEST_CHUNK, total // 128))
    n_chunks = max(1, -(-total // chunk_bytes))
    n_buckets = max(64, -(-total // (16 << 20)))
    rows = docs.select(
        F.col(id_column),
        F.coalesce(train, F.lit(False)).alias(_TRAIN),
        text_of(text_column).alias(_TEXT),
        F.pmod(F.xxhash64(id_column, text_column), F.lit(n_chunks)).cast("int").alias(_CHUNK),
    )
    table = dealt_table(rows, _CHUNK, n_chunks)

    requests = spark.table(table).groupBy(_CHUNK).applyInArrow(_ask(n_buckets), _REQUEST)
    requests = materialize(requests, "requests")
    low = _low_cells(requests)
    answers = requests.groupBy("kind", "bucket").applyInArrow(_answer(low), _ANSWER)
    answers = materialize(answers, "answers")
    tokens, vocabulary = _token_totals(requests)

    schema = T.StructType([field(docs, id_column), T.StructField(_TRAIN, T.BooleanType())])
    for name in ("n_bytes", "n_tokens", "n_known", "train_tokens"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("base_score", T.DoubleType()).add("score", T.DoubleType())
    score = _score(tokens, vocabulary, schema.names)
    scored = spark.table(table).groupBy(_CHUNK).cogroup(answers.groupBy("chunk")).applyInArrow(score, schema)
    return scored.withColumnRenamed(_TRAIN, "train")


def _token_totals(requests: DataFrame) -> tuple[int, int]:
    """Number of training tokens and of distinct ones."""

    def count(rows: pa.Table) -> pa.Table:
        known: set[bytes] = set()
        tokens = 0
        fields = (rows.column(c).to_pylist() for c in ("keys", "n", "counts"))
        for keys, n, counts in zip(*fields, strict=True):
            numbers = _unpack_numbers(counts, n, np.int64)
            tokens += int(numbers.sum())
            words = _unpack_words(keys)
            known.update(words[k] for k in np.flatnonzero(numbers).tolist())
        return pa.table({"tokens": pa.array([tokens], pa.int64()), "words": pa.array([len(known)], pa.int64())})

    words = requests.filter(F.col("kind") == _WORDS).groupBy("bucket")
    counted = words.applyInArrow(count, "tokens bigint, words bigint")
    row = counted.agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).first()
    return row["tokens"] or 0, row["words"] or 0
