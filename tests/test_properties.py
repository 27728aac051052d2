"""Operators against brute-force Python on random inputs (hypothesis)."""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wayfarer.functions import top_keys
from wayfarer.operators import dedupe, kind_rollup, period_over_period, top_n_per_group

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

series = st.lists(
    st.tuples(st.sampled_from("abc"), st.integers(2019, 2021), st.integers(1, 4), st.integers(0, 30)),
    min_size=1, max_size=25, unique_by=lambda t: t[:3])


def _py_growth(rows, gap):
    out = {}
    by = defaultdict(list)
    for e, y, q, n in rows:
        by[e].append((y, q, n))
    for e, lst in by.items():
        lst.sort()
        for i, (y, q, n) in enumerate(lst):
            if i == 0:
                prev = None
            else:
                py, pq, pn = lst[i - 1]
                prev = pn if gap == "bridge" or (py * 4 + pq) == (y * 4 + q) - 1 else 0
            rate = round((n - prev) / prev, 4) if prev else 0.0
            flag = "none" if prev is None else ("yes" if rate > 0.3 else "no")
            out[(e, y, q)] = (rate, flag)
    return out


@SETTINGS
@given(rows=series, gap=st.sampled_from(["bridge", "strict"]))
def test_growth_matches_python(spark, rows, gap):
    df = spark.createDataFrame(rows, "e string, y int, q int, n long")
    got = {(r.e, r.y, r.q): (r.rate, r.flag) for r in
           period_over_period(df, ["e"], "n", ("y", "q"), 4, 0.3, gap, ("none", "yes", "no"), "rate", "flag").collect()}
    want = _py_growth(rows, gap)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][1] == want[k][1] and abs(got[k][0] - want[k][0]) < 1e-9, (k, got[k], want[k])


dup_rows = st.lists(st.tuples(st.sampled_from(["u1", "u2"]), st.sampled_from(["d1", "d2"]),
                              st.sampled_from([None, "x", "y", "z"]), st.integers(0, 3)), min_size=1, max_size=30)


@SETTINGS
@given(rows=dup_rows, parts=st.integers(1, 5))
def test_dedupe_matches_python(spark, rows, parts):
    df = spark.createDataFrame(rows, "k1 string, k2 string, o string, r int").repartition(parts)
    got = sorted(tuple(r) for r in dedupe(df, ["k1", "k2"], order=["o"]).collect())
    best = {}
    for k1, k2, o, r in rows:
        key = (o is None, o or "", r)
        if (k1, k2) not in best or key < best[(k1, k2)][0]:
            best[(k1, k2)] = (key, (k1, k2, o, r))
    assert got == sorted(v for _, v in best.values())


maps = st.lists(st.dictionaries(st.sampled_from("abcde"), st.integers(0, 4), max_size=5), min_size=1, max_size=10)


@SETTINGS
@given(ms=maps)
def test_top_keys_matches_python(spark, ms):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(ms)], "i int, m map<string,bigint>")
    got = {r.i: r.t for r in df.select("i", top_keys("m").alias("t")).collect()}
    for i, m in enumerate(ms):
        want = sorted(k for k, v in m.items() if v == max(m.values())) if m else None
        assert got[i] == want


visits = st.lists(st.tuples(st.sampled_from(["u", "v"]), st.sampled_from([None, "c1", "c2"]),
                            st.sampled_from(["t1", "t2", "t3"]), st.integers(1, 9)), min_size=1, max_size=30)


@SETTINGS
@given(rows=visits)
def test_kind_rollup_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "u string, city string, trip string, d int")
    out = kind_rollup(df, ["u"], maps={"m": "city"}, distinct_counts={"trips": "trip"}, row_count="n",
                      mins={"lo": "d"}, maxs={"hi": "d"})
    got = {r.u: (dict(r.m), r.trips, r.n, r.lo, r.hi) for r in out.collect()}
    want = {}
    for u in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == u]
        want[u] = (dict(Counter(r[1] for r in mine if r[1] is not None)), len({r[2] for r in mine}), len(mine),
                   min(r[3] for r in mine), max(r[3] for r in mine))
    assert got == want


ranked = st.lists(st.tuples(st.sampled_from(["q1", "q2"]), st.text("abcdef", min_size=1, max_size=3),
                            st.integers(0, 5)), min_size=1, max_size=30, unique_by=lambda t: t[:2])


@SETTINGS
@given(rows=ranked, n=st.integers(1, 6))
def test_top_n_matches_python(spark, rows, n):
    df = spark.createDataFrame(rows, "g string, id string, c long")
    got = sorted(tuple(r) for r in top_n_per_group(df, ["g"], [F.col("c").desc(), F.col("id")], n).collect())
    want = []
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1].encode()))
        want += [(*r, i + 1) for i, r in enumerate(mine[:n])]
    assert got == sorted(want)
