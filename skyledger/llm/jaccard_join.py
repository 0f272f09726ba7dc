"""Near duplicates: Jaccard join of word n-gram sets by MinHash banding.

Documents are sets of five-word shingles (a document of one to four words is
one shingle).  Rows of MinHash values are grouped into bands; band and row
counts follow from the similarity and the recall asked for.  Documents that
agree in a whole band are candidates.  Their full signatures leave only pairs
that can be similar enough (a bound that a pair of the threshold's similarity
misses with probability below 1e-6), and these pairs are verified exactly on
the full shingle sets.

Scale.
- Documents with equal sets are one node with a multiplicity; copies are
  never paired with each other.
- Only (band key, node) rows are shuffled for all documents; signatures
  join them in bands that more than one node shares, texts only for nodes
  that have a similar signature, found again through a bit table of at most
  8 MB and an exact join.
- A band key or cluster of many nodes is cut into blocks of a few hundred
  by a hash, and every pair of blocks is one unit of work, spread over the
  cluster; inside, pairs are counted in arrays.  What leaves a unit is one
  row per node, never a row per pair.

Defined results: a null text is empty; a text without words links to nothing
and is a class of its own; identical rows link to each other; a null id never
names a class; other columns are ignored.  An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bits import bit_table, let, power_of_two
from .common import byte_values, field, materialize, slices, text_of
from .graph import connected_components

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RECALL = 0.99999  # of pairs exactly at SIMILARITY; more similar pairs have more
MAX_HASHES = 160
BLOCK = 256  # nodes of one block of a band key or cluster
_SLICE_BYTES = 8 << 20
_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)  # odd 64-bit constants, one per place


def choose_bands(similarity: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, so the fewest false candidates, that reach the recall."""
    for rows in range(16, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)) if similarity < 1 else 1
        if bands * rows <= max_hashes:
            return bands, rows
    raise ValueError("no bands reach this recall")


def least_agreement(similarity: float, hashes: int, miss: float = 1e-6) -> int:
    """Equal MinHash values that a pair of ``similarity`` has but with probability ``miss``."""
    below = 0.0
    for k in range(hashes + 1):
        below += math.comb(hashes, k) * similarity**k * (1 - similarity) ** (hashes - k)
        if below > miss:
            return k
    return hashes


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingles of every text, as 64-bit hashes."""
    words = [t.split() for t in texts]
    distinct = list(set().union(*words))
    digests = b"".join(hashlib.blake2b(w, digest_size=8).digest() for w in distinct)
    number = dict(zip(distinct, range(len(distinct)), strict=True))
    hashes = np.frombuffer(digests, dtype="<u8")
    out = []
    for ws in words:
        ids = hashes[np.fromiter(map(number.__getitem__, ws), np.int64, len(ws))]
        n = max(min(len(ids), 1), len(ids) - SHINGLE_WORDS + 1)
        size = min(SHINGLE_WORDS, len(ids))
        sums = np.full(n, np.uint64(size))
        for k in range(size):
            sums += ids[k : k + n] * _MULTIPLIERS[k]
        out.append(np.unique(_mix(sums)))
    return out


def _signing(bands: int, rows: int, names: list[str]):
    """Per text: set fingerprint, number of shingles, band keys, and one byte of every MinHash."""
    rng = np.random.default_rng(20)
    factors = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    marks = _mix(np.arange(1, bands + 1, dtype=np.uint64))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, _SLICE_BYTES):
            sets = shingle_sets(byte_values(batch, 2))
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            full = np.flatnonzero(sizes)
            prints, keys, bytes_ = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            if len(full):
                values = np.concatenate([sets[k] for k in full])
                first = np.cumsum(sizes[full]) - sizes[full]
                least = np.empty((bands * rows, len(full)), dtype=np.uint64)
                for h in range(bands * rows):
                    least[h] = np.minimum.reduceat(values * factors[h] + shifts[h], first)
                least = _mix(least)
                of_rows = least.reshape(bands, rows, len(full))
                band = np.repeat(marks[:, None], len(full), axis=1)
                for r in range(rows):
                    band = _mix(band + of_rows[:, r] * _MULTIPLIERS[r % 5])
                band, small = np.ascontiguousarray(band.T), np.ascontiguousarray(least.T.astype(np.uint8))
                for at, k in enumerate(full.tolist()):
                    prints[k] = hashlib.blake2b(sets[k].tobytes(), digest_size=16).digest()
                    keys[k] = band[at].view(np.int64)
                    bytes_[k] = small[at].tobytes()
            arrays = [
                batch.column(0),
                batch.column(1),
                pa.array(prints, pa.binary()),
                pa.array(sizes, pa.int32()),
                pa.array(keys, pa.list_(pa.int64())),
                pa.array(bytes_, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return sign


def _units(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole units from sorted batches, with the first row of each unit.

    A unit is the rows with equal values in the first ``n_keys`` columns; it
    is bounded by two blocks, so what is carried from batch to batch is too.
    """
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        first = _unit_starts(table, n_keys)
        if first[-1]:
            yield table.slice(0, first[-1]), first[:-1]
        rest = table.slice(first[-1])
    if rest is not None and rest.num_rows:
        yield rest, _unit_starts(rest, n_keys)


def _unit_starts(table: pa.Table, n_keys: int) -> np.ndarray:
    changed = np.zeros(table.num_rows, dtype=bool)
    changed[0] = True
    for k in range(n_keys):
        column = table.column(k).combine_chunks()
        if pa.types.is_binary(column.type):
            column = column.dictionary_encode().indices
        values = column.to_numpy(zero_copy_only=False)
        changed[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(changed)


def _least_labels(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least node that each of ``n`` nodes is connected to by the pairs."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _similar_signatures(least: int):
    """Of sorted (key, i, j, node, signature) rows the edges that join similar signatures."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in _units(batches, 3):
            n = table.num_rows
            column = table.column("signature").combine_chunks()
            signature = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(n, -1)
            end = np.repeat(np.append(first[1:], n), np.diff(np.append(first, n)))
            here, step, left, right = np.arange(n), 0, [], []
            while len(here):
                step += 1
                here = here[here + step < end[here]]
                for at in range(0, len(here), 20_000):
                    part = here[at : at + 20_000]
                    equal = (signature[part] == signature[part + step]).sum(1)
                    part = part[equal >= least]
                    left.append(part)
                    right.append(part + step)
            label = _least_labels(n, np.concatenate(left or [here]), np.concatenate(right or [here]))
            linked = np.flatnonzero(label != np.arange(n))
            nodes = table.column("node").combine_chunks()
            arrays = [nodes.take(pa.array(linked)), nodes.take(pa.array(label[linked]))]
            yield pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

    return join


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections."""
    n = len(sets)
    values, which = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    often = np.bincount(which, minlength=len(values))
    common = np.flatnonzero(often > 1)  # only these are in an intersection
    place = np.full(len(values), -1)
    place[common] = np.arange(len(common))
    place = place[which]
    owner, place = owner[place >= 0], place[place >= 0]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((n, n), dtype=np.float32)
    for at in range(0, len(common), 4096):
        lo, hi = np.searchsorted(place, (at, at + 4096))
        has = np.zeros((n, min(4096, len(common) - at)), dtype=np.float32)
        has[owner[lo:hi], place[lo:hi] - at] = 1
        out += has @ has.T
    return out


def _verified(similarity: float):
    """Of sorted (root, i, j, node, block, copies, shingles) rows: per node its links in this unit
    (copies counted) and a node of its class."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in _units(batches, 3):
            bounds = np.append(first, table.num_rows).tolist()
            links = np.zeros(table.num_rows, dtype=np.int64)
            labels = np.arange(table.num_rows)
            block, copies = table.column("block").to_numpy(), table.column("copies").to_numpy()
            pair = table.column("i").to_numpy() != table.column("j").to_numpy()
            shingles = table.column("shingles")
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                if hi - lo < 2:
                    continue
                sets = [np.frombuffer(s, dtype="<u8") for s in shingles.slice(lo, hi - lo).to_pylist()]
                sizes = np.array([len(s) for s in sets])
                both = _intersections(sets)
                union = sizes[:, None] + sizes[None, :] - both
                similar = both >= similarity * union - 1e-6
                np.fill_diagonal(similar, False)
                if pair[lo]:  # two blocks: pairs inside one of them have their own unit
                    similar &= block[lo:hi][:, None] != block[lo:hi][None, :]
                links[lo:hi] = similar @ copies[lo:hi]
                labels[lo:hi] = lo + _least_labels(hi - lo, *np.nonzero(similar))
            nodes = table.column("node").combine_chunks()
            arrays = [nodes, nodes.take(pa.array(labels)), pa.array(links)]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "other", "links"])

    return verify


def _blocks(rows: DataFrame, key: str, count: str) -> DataFrame:
    """Rows with the pairs of blocks (``i`` <= ``j``) of their key that they take part in."""
    n = F.ceil(F.col(count) / BLOCK).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", key), n).cast("int"))
    other = F.explode(F.sequence(F.lit(0), n - 1))
    pairs = rows.select("*", other.alias("other"))
    least, most = F.least("block", "other"), F.greatest("block", "other")
    return pairs.withColumn("i", least).withColumn("j", most).drop("other", count)


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys)


def row_key(text: Column) -> Column:
    """With the id, what tells rows of documents apart."""
    return F.xxhash64(text)


def join_similar(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """Per document: id, ``row_key``, ``n_shingles``, ``n_links`` (documents that it is similar to),
    ``class_node`` (equal in a class of linked documents; null without words), ``class_id`` (least id
    of the class)."""
    bands, rows = choose_bands(similarity, recall)
    text = text_of(text_column)
    pairs = docs.select(F.col(id_column).alias("id"), row_key(text).alias("row_key"), text.alias("text"))
    schema = T.StructType([field(pairs, "id"), T.StructField("row_key", T.LongType())])
    schema = schema.add("node", T.BinaryType()).add("n_shingles", T.IntegerType())
    schema = schema.add("bands", T.ArrayType(T.LongType())).add("signature", T.BinaryType())
    signed = materialize(pairs.mapInArrow(_signing(bands, rows, schema.names), schema), "signed")

    nodes = signed.filter("node is not null").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct("id", "row_key")).alias("example"),
        F.min("id").alias("least_id"),
        F.first("bands").alias("bands"),
        F.first("signature").alias("signature"),
    )
    nodes = materialize(nodes, "nodes")

    # Nodes that share a band key, in blocks; edges between similar signatures.
    keys = nodes.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows_of_keys = keys.join(shared, "key").join(nodes.select("node", "signature"), "node")
    dealt = _dealt(_blocks(rows_of_keys, "key", "n").select("key", "i", "j", "node", "signature"), "key", "i", "j")
    least = least_agreement(similarity, bands * rows)
    edges = dealt.mapInArrow(_similar_signatures(least), "a binary, b binary")
    clusters = materialize(connected_components(edges), "clusters")

    # The full sets of the clustered nodes, verified in pairs of blocks.
    sizes = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    members = clusters.join(sizes, "root").join(nodes.select("node", "copies", "example"), "node")
    members = materialize(members, "members")
    sets = _sets_of(pairs, members)
    blocks = _blocks(sets, "root", "n").select("root", "i", "j", "node", "block", "copies", "shingles")
    links = _dealt(blocks, "root", "i", "j").mapInArrow(
        _verified(similarity), "node binary, other binary, links bigint"
    )
    links = materialize(links, "links")
    classes = connected_components(links.select(F.col("node").alias("a"), F.col("other").alias("b")))

    judged = (
        nodes.select("node", "copies", "least_id")
        .join(links.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
        .join(classes, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
    )
    judged = materialize(judged.select("node", "root", "n_links", "least_id"), "judged")
    least_ids = judged.groupBy("root").agg(F.min("least_id").alias("class_id"))
    judged = judged.join(least_ids, "root").select("node", "root", "n_links", "class_id")
    return signed.select("id", "row_key", "node", "n_shingles").join(judged, "node", "left").select(
        F.col("id").alias(id_column),
        "row_key",
        F.col("n_shingles").cast("bigint").alias("n_shingles"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.col("root").alias("class_node"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
    )


def _sets_of(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` with the full sets (``shingles``) of their example texts.

    A bit table of the wanted rows keeps most other texts out of the join.
    """
    wanted = members.select("node", F.col("example.id").alias("want_id"), F.col("example.row_key").alias("want_key"))
    n_words = power_of_two(wanted.count())

    def probe(key: Column) -> tuple[Column, Column]:
        word = F.shiftrightunsigned(key, 6).bitwiseAND(F.lit(n_words - 1)).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), key.bitwiseAND(F.lit(63)).cast("int"))
        return word, bit

    word, mask = probe(F.col("want_key"))
    bits = materialize(bit_table(wanted.select(word.alias("word"), mask.alias("mask")), n_words), "bits").scalar()

    def listed(table: Column) -> Column:
        word, mask = probe(F.col("row_key"))
        return F.get(table, word).bitwiseAND(mask) != 0

    likely = pairs.select("id", "row_key", "text", bits.alias("bits"))
    likely = likely.filter(let(F.col("bits"), listed)).select("id", "row_key", "text")
    same = F.col("id").eqNullSafe(F.col("want_id")) & (F.col("row_key") == F.col("want_key"))
    texts = likely.join(wanted, same).select("node", "text")

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, _SLICE_BYTES):
            found = [s.tobytes() for s in shingle_sets(byte_values(batch, 1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["node", "shingles"])

    sets = texts.mapInArrow(shingles, "node binary, shingles binary").dropDuplicates(["node"])
    return materialize(members.select("node", "root", "n", "copies").join(sets, "node"), "sets")


def first_of_each_class(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` without all but the first document (least id, a null id before all) of each
    class of near duplicates; all columns unchanged, whatever their names.  Of rows with equal id and
    text the one that comes first as JSON text stays."""
    joined = join_similar(docs, id_column, text_column)
    rows = materialize(joined.select(F.col(id_column).alias("keep_id"), "row_key", "class_node"), "rows")
    first = rows.filter("class_node is not null").groupBy("class_node").agg(
        F.min(F.struct("keep_id", "row_key")).alias("first")
    )
    kept = first.select("first.*").unionByName(
        rows.filter("class_node is null").select("keep_id", "row_key").distinct()
    )
    copies = rows.groupBy(F.col("keep_id").alias("copy_id"), F.col("row_key").alias("copy_key")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("class_node").isNotNull()).alias("has_words")
    )
    kept = kept.join(copies, F.col("keep_id").eqNullSafe(F.col("copy_id")) & (F.col("row_key") == F.col("copy_key")))
    kept = kept.select("keep_id", "row_key", (F.col("has_words") & (F.col("n") > 1)).alias("repeated"))
    kept = materialize(kept, "kept")
    # The caller's columns travel in a struct, so that none of their names can clash.
    given = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(id_column).alias("id"),
        row_key(text_of(text_column)).alias("own_key"),
    )
    same = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("own_key") == F.col("row_key"))
    once = given.join(kept.filter("not repeated"), same, "left_semi").select("row")
    again = given.join(kept.filter("repeated"), same, "left_semi").groupBy("id", "own_key")
    again = again.agg(F.min_by("row", F.to_json("row")).alias("row")).select("row")
    return once.unionByName(again).select("row.*")
