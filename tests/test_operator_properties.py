"""Operators against brute-force Python models on random data."""

import re
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from skyledger.operators import agency_winners, latest_per_key, speed_stats, word_count

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))

record = st.tuples(
    st.integers(min_value=0, max_value=6),                       # batch_no
    st.sampled_from(["dhs", "fbi", "doj", "DHS", "a b", ""]),     # agency
    st.sampled_from(["F1", "F2"]),                                 # flight_id
    st.integers(min_value=-(2**31), max_value=2**31 - 1),          # speed
)


def _records(spark, rows):
    return spark.createDataFrame(rows, "batch_no long, agency string, flight_id string, speed int")


@SETTINGS
@given(st.lists(record, min_size=0, max_size=300))
def test_agency_winners_model(spark, rows):
    counts = defaultdict(Counter)
    for b, a, _, _ in rows:
        counts[b][a] += 1
    want = set()
    for b, c in counts.items():
        top = max(c.values())
        names = sorted(a for a, n in c.items() if n == top)
        want.add((b, "[" + ", ".join(names) + "]", top))
    got = {tuple(r) for r in agency_winners(_records(spark, rows)).collect()}
    assert got == want


@SETTINGS
@given(st.lists(record, min_size=0, max_size=300), st.sampled_from([None, "F1"]))
def test_speed_stats_model(spark, rows, flight):
    groups = defaultdict(list)
    for b, a, f, s in rows:
        if a == "dhs" and (flight is None or f == flight):
            groups[b].append(s)
    # No 32-bit wrap: the average is over the exact sum.
    want = {(b, "L", max(v), min(v), sum(v) / len(v), len(v)) for b, v in groups.items()}
    got = {tuple(r) for r in speed_stats(_records(spark, rows), "dhs", flight=flight, label="L").collect()}
    assert {g[:4] + (g[5],) for g in got} == {w[:4] + (w[5],) for w in want}
    by_key = {(g[0]): g[4] for g in got}
    for w in want:
        assert abs(by_key[w[0]] - w[4]) <= 1e-9 * max(1.0, abs(w[4]))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["x", "y", "z"]), st.integers(0, 50), st.integers(0, 9)),
                min_size=0, max_size=100, unique_by=lambda t: (t[0], t[1])))
def test_latest_per_key_model(spark, rows):
    want = {}
    for k, b, v in rows:
        if k not in want or b > want[k][0]:
            want[k] = (b, v)
    df = spark.createDataFrame(rows, "k string, batch_no long, v long")
    got = {(r["k"], r["v"]) for r in latest_per_key(df, ["k"]).collect()}
    assert got == {(k, bv[1]) for k, bv in want.items()}


text = st.text(alphabet="ab \t\n\r\f\x0bé", max_size=40)


@SETTINGS
@given(st.lists(st.one_of(text, st.none()), min_size=0, max_size=40))
def test_word_count_model(spark, docs):
    want = Counter(w for d in docs if d for w in re.split(r"[ \t\n\r\f]+", d) if w)
    df = spark.createDataFrame([(d,) for d in docs], "text string")
    got = {r["word"]: r["n"] for r in word_count(df).collect()}
    assert got == dict(want)
