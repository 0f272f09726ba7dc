"""Merkle manifest of a dataset: nodes labelled with the intervals of leaf ranks they cover.

Every row is a leaf, its digest the SHA-256 of its fields.  The leaves of a
group stand in the order of their ids; eight consecutive nodes make a node of
the next level, until one is left, the group's root.  The groups' roots, in the
order of their keys, are the leaves of one more tree of the same shape, whose
root stands for the dataset.

A node is labelled with the half-open interval of leaf ranks below it.  Ancestor
and descendant are then interval containment: a node of level k lies in the
bucket (its first rank div 8^(k+1)) of its parent's level, and joining a level
with the next on group and bucket, with the containment test, attaches to every
node its parent.  What a parent's interval covers besides the node's own is
covered by its siblings: those that end before it are its left siblings, those
that begin behind it its right ones.  A proof is the siblings of a node, of its
parent and so on to the root; folding a digest with them gives the root again.

Scale.  The texts are read and hashed once, and only digests move on.  Ranks
come from a range partitioning by group, id and digest and a prefix sum over
the partitions' counts, so a group of any size is spread over many tasks.  A
level is an eighth of the one below; proofs flow down from the root, so that a
leaf gets the whole of its proof in one join with its parents.  Levels are
written tables.  The driver sees counts and the root only.

Defined results.  A null field is written ``-``; rows with a null id stand
first in their group; rows of equal id stand in the order of their digests,
equal rows side by side.  A null group is a group
of its own, before all others.  A group of one leaf is that leaf; a dataset of
one leaf has an empty proof.  Texts are hashed whole, whatever their length.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

FAN_OUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ROW_BITS = (1 << 33) - 1  # of a monotonically increasing id: the row within its partition
_PATH = "array<struct<left:binary,right:binary>>"


def field_text(value: Column) -> Column:
    """A field as its byte count and its value, or ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """The digest of a row with these fields."""
    return F.unhex(F.sha2(F.concat(*map(field_text, values)), 256))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; a text of one byte a character takes the quicker way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def as_hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _digest(digests: Column) -> Column:
    """Digest of digests in a row, taken as hexadecimal text."""
    return F.unhex(F.sha2(as_hex(digests), 256))


def _in_a_row(nodes: Column) -> Column:
    """The digests of an array of nodes, one after the other."""
    return F.aggregate(nodes, F.lit(b""), lambda found, node: F.concat(found, node["digest"]))


def ranked(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with their ``rank`` (from 0) within ``group`` and the group's size ``n``.

    Rows are dealt by ranges of (group, order) and numbered where they lie;
    the counts of their group in earlier partitions are added.  A null group
    is a group, before the others; nulls come first in the order too.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    dealt = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id().bitwiseAND(_ROW_BITS)
    dealt = materialize(dealt.withColumns({"part": F.spark_partition_id(), "place": place}), "ranked")
    counts = dealt.groupBy(group, "part").agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("first"))
    within = Window.partitionBy(group)  # a row for each partition that holds some of the group
    earlier = within.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col(group).alias("in_group"),
        F.col("part").alias("in_part"),
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("base"),
        F.sum("rows").over(within).alias("n"),
    )
    same = (F.col("part") == F.col("in_part")) & F.col(group).eqNullSafe(F.col("in_group"))
    return dealt.join(counts, same).select(*rows.columns, (F.col("place") + F.col("base")).alias("rank"), "n")


def build_levels(leaves: DataFrame) -> list[DataFrame]:
    """The levels of the trees over ``leaves`` (``grp``, ``lo``, ``hi``, ``n``, ``digest``), lowest first.

    A node above the leaves also has ``kids``, the labels and digests of its
    children.  A group is in all levels up to that of its root, the first
    level whose width (``FAN_OUT`` to the power of its number) is ``n`` or more.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, width = [leaves], 1
    while width < most:
        below, width = levels[-1].filter(F.col("n") > width), width * FAN_OUT
        kids = F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids")
        ends = F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("n").alias("n")
        nodes = below.groupBy("grp", F.expr(f"lo div {width}").alias("bucket")).agg(*ends, kids)
        nodes = nodes.select("grp", "lo", "hi", "n", _digest(_in_a_row(F.col("kids"))).alias("digest"), "kids")
        levels.append(materialize(nodes, "level"))
    return levels


def roots_of(levels: list[DataFrame]) -> DataFrame:
    """(``grp``, ``digest``) of the root of every group."""
    found = None
    for number, nodes in enumerate(levels):
        roots = nodes.filter(F.col("n") <= FAN_OUT**number).select("grp", "digest")
        found = roots if found is None else found.unionByName(roots)
    return found


def attach_proofs(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The leaves with the columns of ``above`` (one row for each ``grp``, among them ``path``).

    ``path`` grows on its way down: the siblings of the node, left and right,
    come before those of its parent.
    """
    carried = [c for c in above.columns if c not in ("grp", "path")]
    above = above.select(F.col("grp").alias("above_grp"), F.col("path").alias("above_path"), *carried)
    flow = None
    for number in reversed(range(len(levels))):
        width = FAN_OUT**number
        nodes = levels[number]
        top = nodes.filter(F.col("n") <= width).join(above, F.col("grp").eqNullSafe(F.col("above_grp")))
        top = top.select(*nodes.columns, F.col("above_path").alias("path"), *carried)
        if flow is not None:
            parents = flow.select(
                F.col("grp").alias("p_grp"),
                F.col("lo").alias("p_lo"),
                F.col("hi").alias("p_hi"),
                F.col("kids").alias("p_kids"),
                F.col("path").alias("p_path"),
                *carried,
            )
            bucket = width * FAN_OUT
            contained = (
                F.col("grp").eqNullSafe(F.col("p_grp"))
                & (F.expr(f"lo div {bucket}") == F.expr(f"p_lo div {bucket}"))
                & (F.col("lo") >= F.col("p_lo"))
                & (F.col("hi") <= F.col("p_hi"))
            )
            left = F.filter("p_kids", lambda k: k["hi"] <= F.col("lo"))
            right = F.filter("p_kids", lambda k: k["lo"] >= F.col("hi"))
            own = F.array(F.struct(_in_a_row(left).alias("left"), _in_a_row(right).alias("right")))
            inner = nodes.filter(F.col("n") > width).join(parents, contained)
            path = F.concat(own, F.col("p_path")).alias("path")
            top = top.unionByName(inner.select(*nodes.columns, path, *carried))
        flow = top
    return flow


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest gives with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda own, step: _digest(F.concat(step["left"], own, step["right"])))


def proof_digest(path: Column) -> Column:
    """SHA-256 (hexadecimal) of all siblings of ``path``, level by level, left to right."""
    levels = F.transform(path, lambda step: as_hex(F.concat(step["left"], step["right"])))
    return F.sha2(F.array_join(levels, ""), 256)


def merkle_manifest(leaves: DataFrame) -> DataFrame:
    """``leaves`` (``id``, ``grp``, ``digest``, any others) with ``lo``, ``hi`` (the leaf's label),
    ``path``, ``subroot`` and ``root``."""
    kept = materialize(leaves.withColumn("tie", F.monotonically_increasing_id()), "leaves")
    others = [c for c in leaves.columns if c not in ("grp", "digest")]

    def labelled(rows: DataFrame, *columns: str) -> DataFrame:
        label = F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi")
        return rows.select("grp", *label, "n", "digest", *columns)

    # Equal rows are told apart by where they lay, so that any number of them is dealt evenly.
    own = build_levels(materialize(labelled(ranked(kept, "grp", "id", "digest", "tie"), *others), "level"))
    tops = roots_of(own).select(F.lit(0).alias("grp"), F.col("grp").alias("key"), "digest")
    upper = build_levels(materialize(labelled(ranked(tops, "grp", "key"), "key"), "level"))
    root = roots_of(upper).select("grp", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root"))
    subroots = attach_proofs(upper, root)
    above = subroots.select(F.col("key").alias("grp"), F.col("digest").alias("subroot"), "path", "root")
    return attach_proofs(own, materialize(above, "subroots"))


def leaves_of(docs: DataFrame, tampered: Column, tampered_text: Column, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(``id``, ``grp``, ``digest``, ``presented``): the leaves of ``documents`` by language.

    ``presented`` is the digest that is to be verified: that of the row with
    ``tampered_text`` for its last field where ``tampered`` holds.
    """
    columns = [F.col(c) for c in fields]
    digest = leaf_digest(*columns)
    changed = leaf_digest(*columns[:-1], tampered_text)
    return docs.select(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("grp"),
        digest.alias("digest"),
        F.when(tampered, changed).alias("changed"),
    ).select("id", "grp", "digest", F.coalesce("changed", "digest").alias("presented"))
