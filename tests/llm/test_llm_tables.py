"""Whitening, line dedup and Merkle manifest against brute force on small and odd inputs."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import line_dedup as L
from skyledger.llm import merkle as M
from skyledger.llm import whitening as W
from skyledger.llm.oracle import LINE_DEDUP, MERKLE
from skyledger.llm.queries import QUERIES
from tools.oracle_check import duck_connection

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id bigint, embedding array<float>, label int, component int, x int"


def same_as_sql(frame, sql):
    columns = sorted(frame.columns)
    rows = sorted(tuple(r) for r in frame.select(*columns).collect())
    found = duck_connection(SF).execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
    return rows == sorted(found) and len(rows) > 0


def whitened_by_hand(rows):
    """{id: (deviation, coordinates)} and shares, by the eigenvectors of the covariance."""
    usable = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in rows]
    distinct = sorted({tuple(x) for _, x in usable})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums, strict=True)] for x in distinct])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    share = values / (centred**2).sum() * n
    out = []
    for i, x in usable:
        away = [n * c - s for c, s in zip(x, sums, strict=True)]
        out.append((i, sum(a * a for a in away), np.array(away) / n @ vectors / np.sqrt(values)))
    return n, out, share


def check_whitening(spark, rows, kept):
    n, by_hand, share = whitened_by_hand(kept)
    frame = spark.createDataFrame([(i, v, 0, 7, 8) for i, v in rows], VECTORS)
    found = W.whiten(frame).collect()
    assert len(found) == len(share) * len(kept) and {r["n"] for r in found} == {n}
    assert max(r["identity_error"] for r in found) < 1e-9
    signs = {}
    spare = sorted(by_hand, key=lambda r: (repr(r[0]), r[1], tuple(r[2])))
    groups = {}
    for r in found:
        groups.setdefault((repr(r["vec_id"]), r["deviation"]), {}).setdefault(r["component"], []).append(r)
    for i, deviation, coordinates in spare:
        mine = groups[(repr(i), deviation)]
        for k, value in enumerate(coordinates):
            row = mine[k + 1][0]
            assert row["explained"] == pytest.approx(share[k], rel=1e-9)
            sign = signs.setdefault(k, 1 if row["whitened"] * value > 0 else -1) if abs(value) > 1e-6 else 1
            assert row["whitened"] == pytest.approx(sign * value if k in signs else value, abs=1e-8)


def test_whitening_equals_eigenvectors(spark):
    rng = np.random.default_rng(3)
    scale = np.array([5.0, 3.0, 2.0, 1.0, 0.5, 0.02])
    good = [(i, (rng.normal(size=6) * scale + 1).astype(np.float32).tolist()) for i in range(300)]
    good += [(1000 + i, good[7][1]) for i in range(150)] + [(None, good[3][1])]
    bad = [
        (2000, None), (2001, []), (2002, [1.0] * 5), (2003, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
        (2004, [float("nan")] * 6), (2005, [float("inf")] + [0.0] * 5), (2006, [2.0] * 9),
    ]
    check_whitening(spark, good + bad, good)


def test_whitening_of_flat_and_empty_tables(spark):
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(20)]  # one direction only, exactly
    frame = spark.createDataFrame([(i, v, 0, 0, 0) for i, v in line], VECTORS)
    found = W.whiten(frame).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 20
    assert all(r["explained"] == pytest.approx(1) for r in found)
    for rows in ([], line[:1] * 5, [(1, None), (2, [])]):
        assert W.whiten(spark.createDataFrame([(i, v, 0, 0, 0) for i, v in rows], VECTORS)).collect() == []


def test_whitening_is_exact_on_large_entries(spark):
    """Deviations beyond the range of a product of longs are exact, and null beyond a long."""
    rows = [(0, [1.0e7, 0.0]), (1, [-1.0e7, 0.0]), (2, [0.0, 1.0]), (3, [3.0e18, 0.0])]
    frame = spark.createDataFrame([(i, v, 0, 0, 0) for i, v in rows[:3]], VECTORS)
    away = 3 * 256 * 10**7
    found = {r["vec_id"]: r["deviation"] for r in W.whiten(frame).collect()}
    assert found[2] == (512**2) and found[0] is None and away * away > 1 << 63
    wide = spark.createDataFrame([(i, v, 0, 0, 0) for i, v in rows], VECTORS)
    assert {r["vec_id"] for r in W.whiten(wide).collect()} == {0, 1, 2, 3}


def test_cholesky_shifts_only_as_far_as_it_must():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(50, 4))
    g = a.T @ a
    assert np.allclose(W.shifted_cholesky(g, False).T @ W.shifted_cholesky(g, False), g, rtol=1e-13)
    flat = np.outer([1.0, 2.0, 3.0], [1.0, 2.0, 3.0])
    r = W.shifted_cholesky(flat, False)
    assert np.abs(r.T @ r - flat).max() < 1e-9


def key_of(line):
    stripped = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in stripped)


def deduped_by_hand(rows, min_chars=10):
    first = {}
    order = lambda i: (i is not None, i or 0)
    for i, text in rows:
        for line in (text or "").split("\n"):
            k = key_of(line)
            if len(k) >= min_chars and (k not in first or order(i) < order(first[k])):
                first[k] = i
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = [len(key_of(x)) >= min_chars and first[key_of(x)] != i for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        out.append((i, len(lines), sum(gone), kept))
    return sorted(out, key=repr)


def line_texts():
    rng = random.Random(4)
    pool = [" A common Line of text ", "a common line OF TEXT", "\tÀ LONG ÉLAN of words\r", "à long élan of words",
            "À long Élan of words", "short", "", "x" * 10, "y" * 9, "日本語日本語日本語日", "tail of it all\x0b"]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    texts += [None, "", "\n", "\n\n", "a common line of text\n", " \n ", "z" * 300_000, "z" * 300_000 + "\nz"]
    return texts + ["\n".join(f"line number {k % 50_000}" for k in range(60_000))] * 2


def test_line_dedup_equals_brute_force(spark, docs_of):
    texts = line_texts()
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    ids[3] = ids[9]  # two rows of one document
    ids[5] = None
    docs = docs_of(texts, ids).withColumns({c: F.lit(1) for c in ("row", "row_key", "at", "keep", "n_lines", "carried")})
    expected = deduped_by_hand(list(zip(ids, texts, strict=True)))
    cleaned = L.drop_lines(docs)
    assert cleaned.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"] or "") for r in cleaned.collect()), key=repr)
    assert got == sorted(((i, kept) for i, _, _, kept in expected), key=repr)
    bitmaps = L.keep_bitmaps(docs).collect()
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"]) for r in bitmaps), key=repr) == sorted(
        (r[:3] for r in expected), key=repr
    )
    for r in bitmaps:  # runs are maximal and in order
        ends = [(run["start"], run["start"] + run["length"]) for run in r["keep"]]
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
        assert sum(b - a for a, b in ends) == r["n_lines"] - r["n_dropped"]


def test_line_dedup_sets_hot_hashes_apart(spark, docs_of):
    rng = random.Random(2)
    texts = [f"the very common line\nown line number {k}\npair line number {k // 2}" for k in range(400)]
    rng.shuffle(texts)
    docs = docs_of(texts)
    rows = L.hash_rows(docs, "doc_id", "text", 10)
    hot = L.hot_hashes(rows, 8).collect()
    assert len(hot) == 1 and hot[0]["first"]["id"] == 0
    got = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in spread(docs)), key=repr)
    assert got == deduped_by_hand(list(enumerate(texts)))
    assert L.hot_hashes(rows.limit(0), 8).collect() == []


def spread(docs):
    counts = L.keep_bitmaps(docs).select("doc_id", F.col("n_lines").alias("n"), "n_dropped")
    texts = L.drop_lines(docs).select("doc_id", "text")
    return texts.join(counts, "doc_id").withColumnRenamed("n", "n_lines").collect()


def test_line_dedup_of_empty_table_and_sql(spark, docs_of):
    assert L.keep_bitmaps(docs_of([])).collect() == [] and L.drop_lines(docs_of([])).collect() == []
    found = QUERIES["op12_line_dedup"](spark, SF)
    assert same_as_sql(found, LINE_DEDUP)
    plan = found._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "MapIn"))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[k : k + 8])) for k in range(0, len(below), 8)])
    return levels


def leaf_text(*values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def manifest_by_hand(rows):
    """Rows (doc_id, source, lang, n_chars, text) -> the query's result."""
    groups = {}
    for i, source, lang, n, text in rows:
        lowered = None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        tampered = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        own = digest(leaf_text(i, source, lang, n, text))
        shown = digest(leaf_text(i, source, lang, n, lowered)) if tampered else own
        groups.setdefault(lang, []).append(((i is not None, i or 0), own, shown, i))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([own for _, own, _, _ in sorted(groups[g])]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs])
    out = []
    for place, g in enumerate(langs):
        for rank, (_, own, shown, i) in enumerate(sorted(groups[g])):
            folded, siblings = shown, ""
            for levels, at in ((trees[g], rank), (top, place)):
                for level in levels[:-1]:
                    run = level[at // 8 * 8 : at // 8 * 8 + 8]
                    left, right = "".join(run[: at % 8]), "".join(run[at % 8 + 1 :])
                    siblings += left + right
                    folded = digest(left + folded + right)
                    at //= 8
            root = top[-1][0]
            out.append((i, own, trees[g][-1][0], root, digest(siblings), folded, folded == root))
    return sorted(out, key=repr)


def manifest_rows(frame):
    tampered = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    proven = M.merkle_manifest(M.leaves_of(frame, tampered, M.ascii_lower(F.col("text"))))
    folded = M.as_hex(M.fold(F.col("presented"), F.col("path")))
    columns = [M.as_hex(F.col(c)) for c in ("digest", "subroot", "root")]
    found = proven.select("id", *columns, M.proof_digest(F.col("path")), folded, folded == columns[-1])
    return sorted((tuple(r) for r in found.collect()), key=repr)


KINDS = "doc_id bigint, source string, lang string, n_chars bigint, text string, id int, grp int, path string, rank int"


def odd_leaves():
    rng = random.Random(6)
    rows = []
    for k in range(150):
        lang = rng.choice([None, "en", "en", "en", "é", "zz", ""])
        text = rng.choice([None, "", "Abc", "ÀBC déf", "x" * 5000, f"Text {k}", "-", "1:1"])
        rows.append((k if k % 17 else None, rng.choice([None, "s", "é"]), lang, rng.choice([None, 3]), text))
    return rows + [rows[5]] * 20 + [(7, "other", "en", 1, "Same id")] + [(500, "s", "alone", 1, "A")]


@pytest.mark.parametrize("keep", [None, 1, 65])
def test_merkle_manifest_equals_brute_force(spark, keep):
    rows = odd_leaves() if keep is None else [(k, "s", "en", 1, f"T{k}") for k in range(keep)]
    frame = spark.createDataFrame([(*r, 1, 2, "p", 3) for r in rows], KINDS)
    assert manifest_rows(frame) == manifest_by_hand(rows)


def test_merkle_manifest_of_many_equal_rows_groups_and_none(spark):
    equal = [(None, None, None, None, "same")] * 300 + [(k, "s", f"l{k}", 1, "T") for k in range(70)]
    frame = spark.createDataFrame([(*r, 1, 2, "p", 3) for r in equal], KINDS)
    assert manifest_rows(frame) == manifest_by_hand(equal)
    assert manifest_rows(frame.limit(0)) == []


def test_merkle_ranks_are_dense_within_groups(spark):
    rows = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 > 0, F.lit("a")).alias("grp"))
    found = M.ranked(rows, "grp", "id").collect()
    for group in (None, "a"):
        mine = sorted((r["id"], r["rank"], r["n"]) for r in found if r["grp"] == group)
        assert [r[1] for r in mine] == list(range(len(mine))) and {r[2] for r in mine} == {len(mine)}


def test_merkle_manifest_equals_sql(spark):
    assert same_as_sql(QUERIES["op13_merkle_manifest"](spark, SF), MERKLE)
