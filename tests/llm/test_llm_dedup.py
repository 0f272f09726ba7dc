"""Suffix dedup, Jaccard join and winnowing against brute force on small and odd inputs."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from skyledger.llm import jaccard_join as J
from skyledger.llm import suffix_dedup as S
from skyledger.llm.graph import connected_components
from skyledger.llm.oracle import WINNOWING
from skyledger.llm.queries import QUERIES
from skyledger.llm.winnowing import clean_documents, decontaminate
from tools.oracle_check import duck_connection

SF = "/root/testdata/sf0.001"


def removed_spans(rows, size=100):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - size + 1):
            window = data[at : at + size]
            if window in seen:
                gone[at : at + size] = b"\1" * size
            seen.add(window)
        runs = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(data)))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((doc_id, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def suffix_result(frame):
    kept = F.octet_length("kept")
    rows = S.remove_repeats(frame).select(
        "doc_id", "n_bytes", F.col("n_bytes") - kept, F.size("spans"), F.sha2("kept", 256)
    )
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def odd_texts():
    rng = random.Random(5)
    words = ["alpha", "bé", "größe", "x", "日本語", "of", "the", "\n", "long-word-with-parts"]
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts = [None, "", "ab", passage, passage, passage[:99], passage[:100], "a" * 350, "a" * 99, "ab" * 300]
    for _ in range(40):
        own = " ".join(rng.choice(words) + str(rng.randrange(99)) for _ in range(rng.randrange(60)))
        cut = rng.randrange(len(passage))
        texts.append(own + passage[cut : cut + rng.randrange(300)] + own[::-1] + rng.choice(["", passage[:130]]))
    return texts


def test_cover_meets_every_shift():
    shifts = {(a - b) % S.COVER_PERIOD for a in S.COVER for b in S.COVER}
    assert shifts == set(range(S.COVER_PERIOD))


def test_suffix_dedup_equals_brute_force(spark, docs_of):
    texts = odd_texts()
    ids = [7 * k % 53 for k in range(len(texts))]  # not in the order of rows
    frame = docs_of(texts, ids)
    assert suffix_result(frame.repartition(3)) == removed_spans(zip(ids, texts, strict=True))
    table = spark.read.parquet(f"{SF}/documents.parquet")
    want = removed_spans([(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()])
    got = sorted((tuple(r) for r in QUERIES["op3_suffix_dedup"](spark, SF).collect()), key=repr)
    assert got == want


def test_suffix_dedup_with_many_chunks_and_buckets(docs_of, monkeypatch):
    monkeypatch.setattr(S, "SMALLEST_CHUNK", 1500)
    monkeypatch.setattr(S, "SMALLEST_BUCKET", 200)
    monkeypatch.setattr(S, "_STEP", 700)
    texts = odd_texts()
    assert suffix_result(docs_of(texts)) == removed_spans(enumerate(texts))


def test_suffix_dedup_odd_rows(docs_of):
    long = "".join(random.Random(8).choices("abcdefgh", k=400))
    assert suffix_result(docs_of([])) == []
    kept = {r[0]: r[2] for r in suffix_result(docs_of([long, long], [None, 3]))}
    assert kept == {None: 0, 3: 400}  # the null id comes first
    twice = suffix_result(docs_of([long, long], [4, 4]))
    assert sorted(r[2] for r in twice) == [0, 400]  # of identical rows one stays
    with pytest.raises(TypeError):
        S.remove_repeats(docs_of([long]).withColumn("doc_id", F.col("doc_id").cast("string")))


def test_text_without_repeats_stays_whole_characters(docs_of):
    shared = "".join(chr(0x100 + k) for k in range(60))  # two bytes each
    frame = docs_of(["a" + shared + "b", "c" + shared + "d", None])
    got = {r["doc_id"]: r for r in S.without_repeats(frame).collect()}
    assert S.without_repeats(frame).columns == frame.columns
    assert got[0]["text"] == "a" + shared + "b" and got[1]["text"] == "cd" and got[2]["text"] == ""
    # 101 bytes of the second text repeat; the run ends inside a character, which stays whole.
    first = "x" * 3 + "".join(chr(0x4E00 + k) for k in range(33)) + "é"
    second = first[:36] + "è"
    rows = {r["doc_id"]: r["text"] for r in S.without_repeats(docs_of([first, second])).collect()}
    assert rows[0] == first and rows[1] in ("è", second[-1:])


def similar_classes(rows):
    sets = {}
    for key, text in rows:
        words = (text or "").encode().split()
        sets[key] = frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else None
    links, least = dict.fromkeys(sets, 0), {k: k for k in sets}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                    links[a] += 1
                    links[b] += 1
                    low, high = sorted((find(a), find(b)))
                    least[high] = low
    return {k: (find(k), links[k]) for k in sets}


def near_texts():
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    texts = [None, "", "  \n", "one", "one", "two words", "a b c d e", "a b c d f"]
    for _ in range(70):  # a group larger than one block below
        words = list(base)
        words[rng.randrange(120)] = f"x{rng.randrange(9999)}"
        texts.append(" ".join(words))
    texts += [" ".join(base)] * 5
    texts += [" ".join(f"u{rng.randrange(99999)}" for _ in range(50)) for _ in range(20)]
    return texts


@pytest.mark.parametrize("block", [256, 16])
def test_jaccard_join_equals_brute_force(docs_of, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    texts = near_texts()
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in J.join_similar(docs_of(texts)).collect()}
    assert got == similar_classes(enumerate(texts))


def test_jaccard_null_and_repeated_ids(docs_of):
    rows = J.join_similar(docs_of(["a b c", "a b c", "a b c", "", None], [None, 7, 7, None, 7])).collect()
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"], r["n_shingles"]) for r in rows), key=repr)
    want = [(7, 7, 2, 1), (7, 7, 2, 1), (7, 7, 0, 0), (None, 7, 2, 1), (None, None, 0, 0)]
    assert got == sorted(want, key=repr)
    assert J.join_similar(docs_of([])).collect() == []


def test_jaccard_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in QUERIES["op4_jaccard_join"](spark, SF).collect()}
    assert got == similar_classes([(r["doc_id"], r["text"]) for r in rows])


def test_first_of_each_class(docs_of):
    text = " ".join(f"w{k}" for k in range(40))
    frame = docs_of([text, text, "other words here", None, None, text + " z"], [5, 2, 9, 1, 1, 2])
    kept = sorted((r["doc_id"], r["text"]) for r in J.first_of_each_class(frame).collect() if r["text"])
    assert len(kept) == 2 and kept[0][0] == 2 and kept[1] == (9, "other words here")
    assert J.first_of_each_class(frame).filter("text is null").count() == 2  # no words: no group
    same = docs_of([text, text], [3, 3])
    assert J.first_of_each_class(same).count() == 1
    assert J.first_of_each_class(docs_of([])).count() == 0


def test_bands_reach_their_recall():
    for similarity, recall in [(0.8, 0.9999), (0.8, 0.99999), (0.9, 0.999), (0.6, 0.99)]:
        bands, rows = J.choose_bands(similarity, recall)
        assert 1 - (1 - similarity**rows) ** bands >= recall and bands * rows <= J.MAX_HASHES


def test_connected_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)]
    least = {}

    def find(x):
        while least.setdefault(x, x) != x:
            x = least[x]
        return x

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        least[high] = low
    got = dict(connected_components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect())
    assert got == {x: find(x) for p in pairs if p[0] != p[1] for x in p}


def hits(docs, items, window=10):
    def words(text):
        out, word = [], ""
        for c in (text or "") + " ":
            c = c.lower() if "A" <= c <= "Z" else c
            if c.isascii() and not (c.isdigit() or c.islower()):
                if word:
                    out.append(word)
                word = ""
            else:
                word += c
        return out

    runs = {}
    for item, text in items:
        ws = words(text)
        n = min(window, len(ws))
        for k in range(len(ws) - n + 1 if n else 0):
            runs.setdefault(tuple(ws[k : k + n]), set()).add(item)
    out = []
    for doc, text in docs:
        ws, hit, found = words(text), set(), set()
        for n in {len(r) for r in runs}:
            for k in range(len(ws) - n + 1):
                if items_of := runs.get(tuple(ws[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= items_of
        out.append((doc, len(ws), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=repr)


def winnow_result(docs, items):
    rows = decontaminate(docs, items).select("doc_id", "n_words", "n_hit", "items").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_winnowing_equals_brute_force(spark, docs_of):
    rng = random.Random(2)
    vocabulary = ["Alpha", "b2", "größe", "É", "of", "the", "9"]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(n))) for k, n in enumerate([1, 3, 4, 7, 9, 10, 11, 30])]
    items[0] = (0, "solitary")
    items += [(50, None), (51, ""), (None, "null item words " * 4), (20, items[7][1]), (3, items[3][1])]
    texts = [None, "", "?!", "solitary", "SOLITARY, indeed"]
    for _ in range(40):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(40))]
        item = rng.choice(items)[1] or ""
        texts.append(", ".join(own) + "; " + item.upper() + " " + " ".join(own[:5]))
    frame = docs_of(texts)
    listed = spark.createDataFrame(items, "item_id bigint, text string")
    assert winnow_result(frame, listed) == hits(enumerate(texts), items)
    clean = {r["doc_id"] for r in clean_documents(frame, listed).collect()}
    assert clean == {d for d, _, n, _ in hits(enumerate(texts), items) if not n}
    assert clean_documents(frame, listed).columns == frame.columns


def test_winnowing_empty_sides_and_repeats(spark, docs_of):
    none = spark.createDataFrame([], "item_id bigint, text string")
    one = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert winnow_result(docs_of(["a b c d"]), none) == [(0, 4, 0, [])]
    assert winnow_result(docs_of([]), one) == []
    got = winnow_result(docs_of(["x a b c", "x a b c", "a b"], [1, 1, None]), one)
    assert got == sorted([(1, 4, 3, ["1"]), (1, 4, 3, ["1"]), (None, 2, 0, [])], key=repr)


def test_winnowing_query_equals_sql_and_stays_native(spark):
    want = sorted(map(tuple, duck_connection(SF).execute(WINNOWING).fetchall()))
    frame = QUERIES["op8_winnowing"](spark, SF)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(tuple(r) for r in frame.select(columns).collect()) == want
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))
