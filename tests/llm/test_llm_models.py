"""Packing, classifiers, language model, token counts, votes and URL filter on small and odd inputs."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from skyledger.llm import packing as P
from skyledger.llm import quality_rules as Q
from skyledger.llm import rule_ensemble as R
from skyledger.llm.oracle import URL_FILTER
from skyledger.llm.ppm import CellTable, score_documents
from skyledger.llm.queries import QUERIES, tokenizer_path
from skyledger.llm.token_counts import BLANK, Vocabulary, count_tokens, trie_counts
from skyledger.llm.toxicity import score_toxicity
from skyledger.llm.url_filter import RULES, judge_urls
from tools.oracle_check import duck_connection

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t ", "The", "x" * 3000, "don't STOP! 3.14 (ok)\x0b<|endoftext|> İstanbul ΣΑΣ é e\u0301 日本 &&&", "a b\nc d\n a b\nc d\n"]


def whole(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


# Packing


def token_pieces(texts, capacity):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    out = []
    for doc, text in texts:
        ids = np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            out.append((doc, piece, start, len(part), zlib.crc32(part.tobytes())))
    return sorted(out, key=repr)


def check_packing(rows, capacity):
    at = defaultdict(list)
    for r in rows:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(at)


@pytest.mark.parametrize("capacity", [4096, 64])
def test_packing_pieces_and_places(spark, docs_of, capacity):
    rows = [(r["doc_id"], r["text"]) for r in whole(spark).collect()]
    texts = [t for _, t in rows[:60]] + ODD + ODD
    frame = docs_of(texts).repartition(3)
    got = P.pack_documents(frame, tokenizer_path("word_bpe_49k.json"), capacity=capacity).collect()
    pieces = sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=repr)
    assert pieces == token_pieces(enumerate(texts), capacity)
    used = check_packing(got, capacity)
    assert used <= 1.02 * math.ceil(sum(r["length"] for r in got) / capacity) + 1


def test_packing_repeated_rows_null_ids_and_empty(docs_of):
    path = tokenizer_path("word_bpe_49k.json")
    got = P.pack_documents(docs_of(["same", "same", "other"], [4, 4, None]), path).collect()
    assert len(got) == 3 and check_packing(got, 4096) == 1
    assert P.pack_documents(docs_of([]), path).collect() == []


def test_plans_place_every_piece_once():
    rng = random.Random(0)
    for capacity, top in [(100, 100), (4096, 4096), (64, 20)]:
        for _ in range(6):
            counts = {rng.randrange(1, top + 1): rng.randrange(1, 4000) for _ in range(rng.randrange(1, 90))}
            runs = P.plan_packing(counts, capacity)
            placed, fill = Counter(), defaultdict(int)
            for r in sorted(runs, key=lambda r: r.offset):
                placed[r.length] += r.count
                for k in range(0, r.count, max(1, r.count // 50 * r.each or r.each)):
                    fill[r.sequence + k // r.each] += 0
            assert placed == counts
            total = max(r.sequence + r.count // r.each for r in runs)
            bound = -(-sum(n * c for n, c in counts.items()) // capacity)
            large = sum(c for n, c in counts.items() if 2 * n > capacity)
            assert total >= bound
            if top <= capacity // 3:  # small pieces fill everything
                assert total <= bound * 1.2 + 1
            assert total <= max(2 * bound, large + bound) + 1


def test_best_mix_uses_pairs_that_fit():
    # 60 + 40 fill a sequence of 100: the optimum pairs them all.
    mixes = P.best_mix([60, 40], [1000, 1000], 100)
    assert sum(m for _, m in mixes) == 1000


# Quality classifier and toxicity


def auc(score, label):
    order = np.argsort(np.argsort(score)) + 1
    good = label == 1
    n1, n0 = good.sum(), (~good).sum()
    return (order[good].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


@pytest.mark.parametrize("name, label, least", [("op2_rule_ensemble", "quality", 0.97), ("op10_kneser_ney", "toxic", 0.8)])
def test_classifiers_on_held_out_rows(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    frame = QUERIES[name](spark, sf)
    assert frame.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = frame.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert ((rows.score >= 0) & (rows.score <= 1)).all()
    assert (rows.predicted == (rows.score >= 0.5)).all()
    assert auc(rows.score.to_numpy(), rows[label].to_numpy()) >= least
    assert (rows.predicted == rows[label]).mean() >= 0.9


def test_classifiers_odd_inputs(spark, docs_of):
    frame = docs_of([*ODD, "again", "again"], [*range(len(ODD)), 0, None])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    one_class = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 0, 1), (3, None, None)], none.schema)
    for labels, quality, toxic in [(none, 0.5, 0.5), (one_class, 1.0, 0.0)]:
        for scored, want in [
            (R.score_quality(frame, labels, F.lit(True)), quality),
            (score_toxicity(frame, labels, F.lit(True)), toxic),
        ]:
            rows = scored.collect()
            assert len(rows) == len(ODD) + 2
            assert all(abs(r["score"] - want) < 1e-5 for r in rows)
    assert R.score_quality(docs_of([]), none, F.lit(True)).collect() == []
    assert score_toxicity(docs_of([]), none, F.lit(True)).collect() == []


def test_rules_compile_to_their_conjunctions(spark):
    printed = "Tree\n  If (feature 0 <= 1.5)\n   If (feature 1 <= 0.25)\n    Predict: 0.0\n   Else (feature 1 > 0.25)\n    Predict: 1.0\n  Else (feature 0 > 1.5)\n   Predict: 1.0\n"
    rules = R.tree_rules(printed, ["a", "b"])
    assert [len(r.tests) for r in rules] == [1, 2, 2, 1]
    kept = R._complement_free(rules + rules)
    assert len(kept) == 3  # the two halves of the root are one feature
    frame = spark.createDataFrame([(1.0, 0.2), (1.0, 0.9), (2.0, 0.9)], "a double, b double")
    model = R.Ensemble(0.0, ((rules[2], 2.0), (rules[1], -3.0)))
    got = [round(r[0], 9) for r in frame.select(model.column()).collect()]
    assert got == [round(1 / (1 + math.exp(-x)), 9) for x in (-3.0, 2.0, 0.0)]


# PPM


def ppm_brute(rows, trained):
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    words = [(t or "").encode().translate(lower).split() for _, t in rows]
    counts, after = Counter(), defaultdict(Counter)
    streams = [b"\xff" * 5 + b" ".join(w) + b"\xff" for w in words]
    for k, ws in enumerate(words):
        if trained[k]:
            counts.update([*ws, b""])
            for at in range(5, len(streams[k])):
                for n in range(6):
                    after[streams[k][at - n : at]][streams[k][at]] += 1
    total, distinct, out = sum(counts.values()), len(counts), []
    for k, ws in enumerate(words):
        tokens = [*ws, b""]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
        score = 0.0
        for at in range(5, len(streams[k])):
            out_of, symbol = set(), streams[k][at]
            for n in range(5, -1, -1):
                seen = after.get(streams[k][at - n : at])
                if not seen:
                    continue
                rest = {s: c for s, c in seen.items() if s not in out_of}
                mass = 2 * sum(rest.values())
                if symbol in rest:
                    score += math.log10((2 * rest[symbol] - 1) / mass)
                    break
                if rest:
                    score += math.log10(len(rest) / mass)
                out_of |= set(seen)
            else:
                score -= math.log10(256 - len(out_of))
        out.append((len(tokens), sum(counts[w] > 0 for w in tokens), total, base, score))
    return out


def test_ppm_equals_brute_force(spark, docs_of, monkeypatch):
    from skyledger.llm import ppm

    monkeypatch.setattr(ppm, "SMALLEST_CHUNK", 20_000)
    monkeypatch.setattr(ppm, "_STEP", 5_000)
    texts = [r["text"] for r in whole(spark).limit(60).collect()] + ODD + ODD
    rows = list(enumerate(texts))
    trained = [zlib.crc32(str(k).encode()) % 7 != 2 for k, _ in rows]
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    got = {r["doc_id"]: r for r in score_documents(docs_of(texts), learn).collect()}
    for (k, _), want in zip(rows, ppm_brute(rows, trained), strict=True):
        r = got[k]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:3] and r["train"] == trained[k]
        assert r["base_score"] == pytest.approx(want[3], rel=1e-9)
        assert r["score"] == pytest.approx(want[4], rel=1e-5, abs=1e-5)


def test_ppm_odd_inputs(docs_of):
    rows = score_documents(docs_of(["a b", "a b", None], [1, 1, None]), F.lit(False)).collect()
    assert [r["train_tokens"] for r in rows] == [0, 0, 0] and all(r["n_known"] == 0 for r in rows)
    assert sorted(round(r["score"] / -math.log10(256)) for r in rows) == [1, 4, 4]
    assert score_documents(docs_of([]), F.lit(True)).collect() == []


def test_cell_table_finds_every_cell():
    rng = np.random.default_rng(0)
    cells = np.unique(rng.integers(0, 1 << 48, 5000, dtype=np.uint64))
    values = rng.random(len(cells)).astype(np.float32)
    order = rng.permutation(len(cells))
    assert (CellTable(cells, values).of(cells[order]) == values[order]).all()


# Token counts


def test_trie_counts_equal_plain_viterbi():
    rng = random.Random(4)
    pieces = {BLANK: -3, BLANK + "a": -2, "a": -4, "ab": -5, "b": -4, "ba": -9, "abab": -7, "é": -6}
    vocabulary = Vocabulary.of(pieces)
    words = {BLANK + "".join(rng.choice("abéz日") for _ in range(rng.randrange(9))) for _ in range(400)}
    for word, got in trie_counts(list(words), vocabulary).items():
        best = [(0, 0)]
        for end in range(1, len(word) + 1):
            n = len(word[end - 1].encode())
            options = [(best[end - 1][0] + n * vocabulary.byte_score, best[end - 1][1] - n)]
            options += [
                (best[k][0] + pieces[word[k:end]], best[k][1] - 1) for k in range(end) if word[k:end] in pieces
            ]
            best.append(max(options))
        assert got == (best[-1][0], -best[-1][1])


def test_token_counts_add_up(spark, docs_of):
    vocabulary = Vocabulary.from_sentencepiece(tokenizer_path("piece_bpe_32k.model"))
    texts = [*ODD, *(r["text"] for r in whole(spark).limit(30).collect())]
    for r in count_tokens(docs_of(texts), vocabulary).collect():
        words = (texts[r["doc_id"]] or "").encode().split()
        found = trie_counts(list({BLANK + w.decode() for w in words}), vocabulary)
        assert r["n_pre_tokens"] == len(words)
        assert r["n_tokens"] == sum(found[BLANK + w.decode()][1] for w in words)
        assert r["forward_score"] == sum(found[BLANK + w.decode()][0] for w in words)
    assert count_tokens(docs_of([]), vocabulary).collect() == []


# Quality rules


def base_counts(text):
    words = (text or "").encode().split()
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)}
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_counts_equal_brute_force(spark, docs_of):
    texts = [*ODD, "a a a a a a a", "w x y z v w x y z v", *(r["text"] for r in whole(spark).collect())]
    for r in Q.judge_quality(docs_of(texts)).collect():
        want = base_counts(texts[r["doc_id"]])
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r["kept"] and r["base_failed"])


def test_votes_recover_planted_accuracies():
    rng = np.random.default_rng(1)
    n, rules = 40_000, Q.RULES[:4]
    good = rng.random(n) < 0.85
    right = np.array([0.95, 0.9, 0.85, 0.8])
    votes = np.where(rng.random((n, 4)) < right, 1, -1) * np.where(good, 1, -1)[:, None]
    votes[rng.random((n, 4)) < 0.2] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = Q.fit_votes(patterns, counts.astype(float), rules)
    assert model.prior_good == pytest.approx(0.85, abs=0.05)
    assert list(model.accuracies().values()) == pytest.approx(right.tolist(), abs=0.05)


def test_kept_documents_follow_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op7_quality_rules"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = rows.filter("not base_failed").toPandas()
    assert rows.kept[rows.quality == 1].mean() >= 0.99
    assert rows.kept[rows.quality == 0].mean() <= 0.2


def test_keep_good_keeps_columns(docs_of):
    good = "The old house of the family was on a hill and it is for sale with an open garden by the sea."
    frame = docs_of([good, None, "### $$$", good], [1, 2, 3, None])
    kept = Q.keep_good(frame)
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == {1, None}
    assert Q.keep_good(docs_of([])).collect() == []


# URL filter


def judged(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for mark in "/?#":
        host = host.split(mark, 1)[0]
    path = rest[len(host) :]
    for mark in "?#":
        path = path.split(mark, 1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def test_urls_equal_plain_rules(spark):
    urls = [
        None, "", "no scheme", "://", "http://", "HTTP://EXAMPLE.ORG/es/x?y#z", "https://a.b.example.org/en/12",
        "x://example.org/en/2", "x://notexample.org/es/", "x://org/", "x://org", "x://a.com/de/1", "x://com/fr/",
        "x://a.com?q=/de/", "x://É.COM/de/", "a://b://c.org/x", "x://.org/", "x://a..com/fr/", "x://host:80/de/",
        "x://example.org/es", "x://example.org\n/es/",
    ]
    pages = spark.createDataFrame([(k % 19, u, "h") for k, u in enumerate(urls * 2)], "page_id bigint, url string, host string")
    listed = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = sorted((tuple(r) for r in judge_urls(pages, listed).collect()), key=repr)
    assert got == sorted(((k % 19, *judged(u)) for k, u in enumerate(urls * 2)), key=repr)
    assert judge_urls(pages.limit(0), listed).collect() == []
    assert {r["verdict"] for r in judge_urls(pages, listed.limit(0)).collect()} == {"allow"}


def test_url_query_equals_sql(spark):
    want = sorted(duck_connection(SF).execute(URL_FILTER).fetchall(), key=repr)
    assert sorted((tuple(r) for r in QUERIES["op9_url_filter"](spark, SF).collect()), key=repr) == want


# Pipeline and registration


def test_pipeline_stages(spark):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["quality_rules", "near_duplicates", "repeated_strings", "benchmark_text", "packed"]
    from skyledger.llm.common import materialize

    counts = [docs.count()]
    for name, stage in C.STAGES[:-1]:
        out = materialize(stage(spark, docs, SF), name)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        kept = {r["doc_id"] for r in out.collect()}
        if name == "quality_rules":
            judged = Q.judge_quality(docs).filter("kept").collect()
            assert kept == {r["doc_id"] for r in judged}
        counts.append(out.count())
        docs = out
    assert counts == sorted(counts, reverse=True) and counts[-1] < counts[0]
    rows = C.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
    check_packing(rows, 4096)


def test_pipeline_empty_table(spark, tmp_path):
    import corpus_pipeline as C

    for table in ("documents", "benchmark"):
        frame = spark.read.parquet(f"{SF}/{table}.parquet")
        frame.limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    names = set(E.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert "pipeline" in names
