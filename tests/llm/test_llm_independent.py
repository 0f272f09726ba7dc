"""The quality verdict and the whole pipeline against versions written without the library."""

import math

import pytest
from test_llm_dedup import hits, similar_classes
from test_llm_models import check_packing, token_pieces

import corpus_pipeline
from skyledger.llm import quality_rules as Q

SF = "/root/testdata/sf0.001"
VOTES = [rule.name for rule in Q.RULES]


def posteriors(votes, rounds=200):
    """Chance of good for every document (a list of votes each), by EM document by document."""
    n, n_rules = len(votes), len(votes[0])
    weak = max(1.0, 0.01 * n)
    start = {0: 0.95, 1: 0.4}
    good = [start.get(sum(v < 0 for v in row), 0.05) for row in votes]
    for _ in range(rounds):
        log_rate = []
        for j in range(n_rules):
            by_class = []
            for is_good in (False, True):
                weak_shares = {-1: 0.1, 0: 0.3, 1: 0.6} if is_good else {-1: 0.6, 0: 0.3, 1: 0.1}
                sums = {v: weak * share for v, share in weak_shares.items()}
                for row, g in zip(votes, good, strict=True):
                    sums[row[j]] += g if is_good else 1 - g
                total = sum(sums.values())
                by_class.append({v: math.log(s / total) for v, s in sums.items()})
            log_rate.append(by_class)
        prior = min(max((sum(good) + 1) / (n + 2), 1e-3), 1 - 1e-3)
        renewed = []
        for row in votes:
            odds = math.log(prior / (1 - prior))
            odds += sum(log_rate[j][1][v] - log_rate[j][0][v] for j, v in enumerate(row))
            renewed.append(1 / (1 + math.exp(-max(-500.0, min(500.0, odds)))))
        moved = max(abs(a - b) for a, b in zip(good, renewed, strict=True))
        good = renewed
        if moved < 1e-9:
            break
    return good


@pytest.fixture(scope="module")
def judged(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = Q.judge_quality(docs).collect()
    return rows, posteriors([[r[v] for v in VOTES] for r in rows])


def test_quality_posterior_equals_em_by_document(judged):
    rows, by_hand = judged
    for r, p in zip(rows, by_hand, strict=True):
        assert r["p_good"] == pytest.approx(p, abs=1e-6)
        assert r["kept"] == (not r["base_failed"] and p >= 0.5)


def without_repeats_by_hand(rows, size=100):
    """Texts without strings of 100 bytes that start earlier, cut at whole characters."""
    seen, out = set(), []
    for doc, text in sorted(rows):
        data = text.encode()
        gone = bytearray(len(data) + 1)
        for at in range(len(data) - size + 1):
            window = data[at : at + size]
            if window in seen:
                gone[at : at + size] = b"\1" * size
            seen.add(window)
        kept, at = b"", 0
        while at < len(data):
            if not gone[at]:
                kept += data[at : at + 1]
                at += 1
                continue
            end = at
            while gone[end]:
                end += 1
            begin, stop = at, end
            while begin < stop and data[begin] & 0xC0 == 0x80:
                begin += 1
            while stop > begin and stop < len(data) and data[stop] & 0xC0 == 0x80:
                stop -= 1
            kept += data[at:begin] + data[stop:end]
            at = end
        out.append((doc, kept.decode()))
    return out


def test_pipeline_equals_stages_by_hand(spark, judged):
    rows, by_hand = judged
    good = {r["doc_id"] for r, p in zip(rows, by_hand, strict=True) if not r["base_failed"] and p >= 0.5}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    texts = [(r["doc_id"], r["text"]) for r in docs if r["doc_id"] in good]
    classes = similar_classes(texts)
    texts = [(doc, text) for doc, text in texts if classes[doc][0] == doc]
    texts = without_repeats_by_hand(texts)
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    hit = {doc for doc, _, n_hit, _ in hits(texts, [tuple(r) for r in items]) if n_hit}
    texts = [(doc, text) for doc, text in texts if doc not in hit]
    assert 0 < len(texts) < len(good) < len(docs) and hit
    found = corpus_pipeline.run(spark, SF).collect()
    got = sorted((tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in found), key=repr)
    assert got == token_pieces(texts, 4096)
    check_packing(found, 4096)
