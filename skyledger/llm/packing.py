"""Best-fit packing of tokenised documents into sequences.

Linear grouping: pieces longer than a quarter of a sequence are sorted by
length and cut into groups of equal cardinality, every length rounded up to
its group's largest.  With so few sizes the best mix of configurations
(multisets of sizes that fit a sequence) is a small linear programme, solved
by column generation with a knapsack over the capacity; its fractional rest
goes first-fit-decreasing.  Every place of a configuration then takes an
actual piece of its group, which is never longer than the place, and short
pieces are put best-fit-decreasing into what the actual lengths leave free.

Scale.  Packing looks at the number of pieces of each length only: at most
4096 rows reach the driver, whatever the number of documents, and the plan it
makes (runs of equal lengths that go to consecutive sequences) is bounded by
the number of lengths too.  Documents are tokenised once.  Pieces are
numbered within their length in salted parts (a prefix sum over
(length, salt) counts), so a length that a third of all pieces share is no
single group, and find their sequence by number in the plan, which travels to
the tasks.

Defined results: a null or empty text is one piece that holds only the end
id.  Repeated rows are packed like any others.  Other columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import field, materialize, slices, text_of, worker_store

SEQUENCE_TOKENS = 4096
END_ID = 1
LARGE_SHARE = 4  # pieces longer than capacity / LARGE_SHARE count as large
GROUPS = (8, 16, 32)  # numbers of cardinality groups that are tried; the fewest sequences win
_CACHED_WORDS, _CACHED_PARTS = 300_000, 200_000  # about 100 MB of an encoder
_WORDS_A_CALL = 100
_MARKS = string.punctuation.replace("'", "")  # an apostrophe may begin a token of letters
_SLICE_BYTES = 10 << 20


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes.

    White space never lies inside a token of this tokenizer and no merge
    crosses it, so a text's ids are those of its parts between white space,
    in order.  A part of letters and final marks is again the lower-cased
    letters and the marks, as the tokenizer always splits there.  The first
    words and parts seen, the frequent ones among them, are kept for later
    texts; others are encoded again, which changes no result.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        ends = [i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size() + 1, dtype=bool)
        self.ends_word[ends] = True
        self.words_seen: dict[str, bytes] = {}
        self.parts_seen: dict[str, bytes] = {}

    @staticmethod
    def parts(text: str) -> list[str]:
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")

    def _encode_each(self, texts: list[str]) -> Iterator[np.ndarray]:
        for at in range(0, len(texts), 5_000):
            for found in self.tokenizer.encode_batch_fast(texts[at : at + 5_000], add_special_tokens=False):
                yield np.array(found.ids, dtype="<u4")

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Words of letters: each ends with a token that says so, so that many can share a call."""
        found = {}
        groups = [words[k : k + _WORDS_A_CALL] for k in range(0, len(words), _WORDS_A_CALL)]
        for group, ids in zip(groups, self._encode_each([" ".join(g) for g in groups]), strict=True):
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            data, bounds = ids.tobytes(), [0, *(4 * ends).tolist()]
            for word, first, last in zip(group, bounds[:-1], bounds[1:], strict=True):
                found[word] = data[first:last]
        return found

    def _encode_parts(self, parts: set[str]) -> dict[str, bytes]:
        made, words, others = [], set(), set()
        for part in parts:
            word = part.rstrip(_MARKS)
            if word.isalpha() and (word.isascii() or max(word) <= "\xff"):
                marks, word = part[len(word) :], word.lower()
                words.add(word)
            else:
                marks, word = part, ""
            others.add(marks)
            made.append((part, word, marks))
        seen = self.words_seen
        found = self._encode_words(list(words.difference(seen)))
        if len(seen) < _CACHED_WORDS:
            seen.update(islice(found.items(), _CACHED_WORDS - len(seen)))
        rest = list(others)
        of_marks = dict(zip(rest, (ids.tobytes() for ids in self._encode_each(rest)), strict=True))
        found[""] = b""
        return {p: (found[w] if w in found else seen[w]) + of_marks[m] for p, w, m in made}

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.parts(t) for t in texts]
        found = self._encode_parts(set().union(*split).difference(self.parts_seen))
        known = {**self.parts_seen, **found}
        if len(self.parts_seen) < _CACHED_PARTS:
            self.parts_seen.update(islice(found.items(), _CACHED_PARTS - len(self.parts_seen)))
        return [b"".join(map(known.__getitem__, parts)) for parts in split]


def _kept_encoder(tokenizer_json: str) -> Encoder:
    """The encoder of this worker process, which outlives the task with its words and parts."""
    store, key = worker_store(), hash(tokenizer_json)
    if key not in store.get("encoders", {}):
        store["encoders"] = {key: Encoder(tokenizer_json)}
    return store["encoders"][key]


def token_pieces(
    docs: DataFrame,
    tokenizer_json: str,
    id_column: str,
    text_column: str,
    capacity: int,
    end_id: int,
    keep_encoder: bool,
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = (_kept_encoder if keep_encoder else Encoder)(tokenizer_json)
        for batch in slices(batches, 1, _SLICE_BYTES):
            rows, columns = [], ([], [], [], [])
            for row, ids in enumerate(encoder.encode(batch.column(1).to_pylist())):
                ids += end
                n = len(ids) // 4
                for piece, start in enumerate(range(0, n, capacity)):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append(row)
                    values = (piece, start, len(part) // 4, zlib.crc32(part))
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
            arrays = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(columns[0], pa.int32())]
            arrays += [pa.array(c, pa.int64()) for c in columns[1:]]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = T.StructType([field(docs, id_column), T.StructField("piece", T.IntegerType())])
    for name in ("start", "length", "ids_crc32"):
        schema = schema.add(name, T.LongType())
    names = schema.names
    return docs.select(F.col(id_column), text_of(text_column).alias("text")).mapInArrow(cut, schema)


def best_mix(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Configurations (count of each size) with how often each is used, rounded down.

    Solves min sum(x) with A x = demand over all configurations by the
    revised simplex method; new columns come from an unbounded knapsack.
    """
    k = len(sizes)
    need = np.array(demand, dtype=float)
    columns = np.diag([float(capacity // s) for s in sizes])
    inverse = np.diag(1 / np.diag(columns))
    used = inverse @ need
    for _ in range(40 * k):
        prices = inverse.sum(0)
        column = _best_configuration(sizes, prices, capacity)
        if prices @ column <= 1 + 1e-9:
            break
        direction = inverse @ column
        ratios = np.where(direction > 1e-12, used / np.where(direction > 1e-12, direction, 1), np.inf)
        leave = int(np.argmin(ratios))
        step = ratios[leave]
        used -= step * direction
        used[leave] = step
        inverse[leave] /= direction[leave]
        others = np.arange(k) != leave
        inverse[others] -= np.outer(direction[others], inverse[leave])
        columns[:, leave] = column
    whole = np.floor(np.maximum(used, 0) + 1e-6).astype(np.int64)
    return [(columns[:, j].astype(int).tolist(), int(whole[j])) for j in range(k) if whole[j]]


def _best_configuration(sizes: list[int], prices: np.ndarray, capacity: int) -> np.ndarray:
    worth = np.zeros(capacity + 1)
    layers = []
    for _ in range(capacity // min(sizes)):  # one more piece in each round
        better, choice = worth.copy(), np.full(capacity + 1, -1)
        for i, size in enumerate(sizes):
            gain = worth[: capacity + 1 - size] + prices[i]
            more = gain > better[size:] + 1e-12
            better[size:][more] = gain[more]
            choice[size:][more] = i
        layers.append(choice)
        if not (choice >= 0).any():
            break
        worth = better
    column = np.zeros(len(sizes))
    room = capacity
    for choice in reversed(layers):
        if choice[room] >= 0:
            column[choice[room]] += 1
            room -= sizes[choice[room]]
    return column


@dataclass(frozen=True)
class Run:
    """``count`` pieces of a length from number ``first`` on: ``each`` a sequence, from ``sequence`` on."""

    length: int
    first: int
    count: int
    sequence: int
    offset: int
    each: int


class _Bins:
    """Kinds of sequence by free room: (contents as a linked list, how many)."""

    def __init__(self, capacity: int):
        self.kinds: list[list[tuple]] = [[] for _ in range(capacity + 1)]
        self.filled = np.zeros(capacity + 1, dtype=bool)

    def add(self, room: int, contents, count: int) -> None:
        if count:
            self.kinds[room].append((contents, count))
            self.filled[room] = True

    def take(self, at_least: int):
        """A kind with the least sufficient room, or None."""
        at = int(np.argmax(self.filled[at_least:])) + at_least
        if not self.filled[at]:
            return None
        kind = self.kinds[at].pop()
        self.filled[at] = bool(self.kinds[at])
        return at, *kind


def _pack_large(counts: dict[int, int], capacity: int, groups: int, bins: _Bins) -> None:
    """Large pieces by linear grouping into ``bins``."""
    lengths = sorted(counts, reverse=True)
    total = sum(counts.values())
    if not total:
        return
    per_group = total if len(lengths) == 1 else -(-total // groups)
    # Cut the sorted pieces into groups; equal rounded sizes are one size.
    members: dict[int, list[list[int]]] = {}
    if len(lengths) <= groups:
        members = {n: [[n, counts[n]]] for n in lengths}
    else:
        room, size = 0, 0
        for n in lengths:
            left = counts[n]
            while left:
                if not room:
                    room, size = per_group, n
                part = min(room, left)
                members.setdefault(size, []).append([n, part])
                room, left = room - part, left - part
    sizes = list(members)
    demand = [sum(c for _, c in members[s]) for s in sizes]
    mixes = best_mix(sizes, demand, capacity)
    rest = [d - sum(c[i] * m for c, m in mixes) for i, d in enumerate(demand)]
    for i, r in enumerate(rest):  # rounding cannot use more than there is; guard it all the same
        while r < 0:
            j = next(j for j, (c, m) in enumerate(mixes) if c[i] and m)
            mixes[j] = (mixes[j][0], mixes[j][1] - 1)
            rest = [x + y for x, y in zip(rest, mixes[j][0], strict=True)]
            r = rest[i]
    open_bins: list[list] = []
    for i, r in enumerate(rest):  # first-fit-decreasing
        for _ in range(r):
            fit = next((b for b in open_bins if b[0] >= sizes[i]), None)
            if fit is None:
                open_bins.append(fit := [capacity, [0] * len(sizes)])
            fit[0] -= sizes[i]
            fit[1][i] += 1
    mixes += [(c, 1) for _, c in open_bins]
    queues = [members[s] for s in sizes]
    for configuration, times in mixes:
        if not times:
            continue
        places = [i for i, n in enumerate(configuration) for _ in range(n)]
        taken = [_next_pieces(queues[i], times) for i in places]  # per place: [length, count] in order
        cuts = sorted({e for t in taken for e in np.cumsum([c for _, c in t]).tolist()})
        ends = [np.cumsum([c for _, c in t]) for t in taken]
        before = 0
        for cut in cuts:
            contents, room = None, capacity
            for t, e in zip(taken, ends, strict=True):
                n = t[int(np.searchsorted(e, before, side="right"))][0]
                contents, room = (contents, n, 1), room - n
            bins.add(room, contents, cut - before)
            before = cut


def _next_pieces(queue: list[list[int]], n: int) -> list[list[int]]:
    out = []
    while n:
        part = min(n, queue[0][1])
        out.append([queue[0][0], part])
        n -= part
        queue[0][1] -= part
        if not queue[0][1]:
            queue.pop(0)
    return out


def plan_packing(counts: dict[int, int], capacity: int, groups: tuple[int, ...] = GROUPS) -> list[Run]:
    """The runs that place all pieces, given the number of pieces of each length.

    Fewer groups leave more room to short pieces, more groups waste less room
    on long ones; which is better depends on the lengths.
    """
    plans = [_plan(counts, capacity, g) for g in groups]
    return min(plans, key=lambda runs: max((r.sequence + r.count // r.each for r in runs), default=0))


def _plan(counts: dict[int, int], capacity: int, groups: int) -> list[Run]:
    bins = _Bins(capacity)
    large = {n: c for n, c in counts.items() if capacity // LARGE_SHARE < n < capacity}
    bins.add(0, (None, capacity, 1), counts.get(capacity, 0))
    _pack_large(large, capacity, groups, bins)
    for length in sorted((n for n in counts if n <= capacity // LARGE_SHARE), reverse=True):
        left = counts[length]
        while left:  # best fit: the fullest sequence with room, as often as it fits
            room, contents, count = bins.take(length) or (capacity, None, left)
            each = min(room // length, left)
            whole = min(count, left // each)
            bins.add(room - each * length, (contents, length, each), whole)
            bins.add(room, contents, count - whole if contents else 0)
            left -= whole * each
    runs, numbers, sequence = [], dict.fromkeys(counts, 0), 0
    for kinds in bins.kinds:
        for contents, count in kinds:
            order = []
            while contents:
                contents, length, each = contents
                order.append((length, each))
            offset = 0
            for length, each in reversed(order):
                runs.append(Run(length, numbers[length], count * each, sequence, offset, each))
                numbers[length] += count * each
                offset += length * each
            sequence += count
    return runs


def _numbered(pieces: DataFrame, id_column: str, total: int) -> DataFrame:
    """Pieces with ``number``, from 0 within each length.

    About sqrt(n) salts: both the parts of a length and the rows of its prefix sum stay small.
    """
    salts = max(1, round(total**0.5))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(id_column, "piece", "ids_crc32"), F.lit(salts)))
    order = Window.partitionBy("length").orderBy("salt")
    parts = (
        salted.groupBy("length", "salt")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("length", "salt", (F.sum("n").over(order) - F.col("n")).alias("before"))
    )
    within = Window.partitionBy("length", "salt").orderBy(id_column, "piece", "ids_crc32")
    numbered = salted.withColumn("within", F.row_number().over(within) - 1)
    joined = numbered.join(parts, ["length", "salt"])
    return joined.withColumn("number", F.col("before") + F.col("within")).drop("salt", "before", "within")


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    groups: tuple[int, ...] = GROUPS,
    keep_encoder: bool = True,
) -> DataFrame:
    """Per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    ``keep_encoder`` lets worker processes keep tokenizer and frequent words
    from task to task (some 150 MB each); off, every task starts anew, which
    costs a quarter more time and leaves the memory to other stages.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    pieces = token_pieces(docs, tokenizer_json, id_column, text_column, capacity, end_id, keep_encoder)
    pieces = materialize(pieces, "pieces")
    rows = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``capacity`` rows
    counts = {r["length"]: r["n"] for r in sorted(rows)}
    runs = sorted(plan_packing(counts, capacity, groups), key=lambda r: (r.length, r.first))
    bases = np.zeros(capacity + 2, dtype=np.int64)
    for length, n in counts.items():
        bases[length + 1] = n
    bases = np.cumsum(bases)  # pieces shorter than each length: numbers run over all lengths
    firsts = np.array([bases[r.length] + r.first for r in runs], dtype=np.int64)
    fields = np.array([(r.sequence, r.offset, r.each) for r in runs], dtype=np.int64).reshape(-1, 3)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = bases[length] + batch.column("number").to_numpy()
            run = np.searchsorted(firsts, number, side="right") - 1
            sequence, offset, each = fields[run].T
            turn = number - firsts[run]
            arrays = [batch.column(c) for c in names[:-2]]
            arrays += [pa.array(sequence + turn // each), pa.array(offset + turn % each * length)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = T.StructType([*pieces.schema]).add("sequence_id", T.LongType()).add("offset", T.LongType())
    names = schema.names
    return _numbered(pieces, id_column, sum(counts.values())).mapInArrow(place, schema)
