"""The one-pass report: exact lines, sketches within their bounds, mergeable cells, one scan."""

import datetime
import math

from tests.conftest import SF_SMALL
from tests.test_plans import plan
from wayfarer.operators.profile import FIRST_BUCKET, HLL_BITS, QUANTILE_ERROR, Profile, merge_cells, profile_cells, profile_report, profile_table
from wayfarer.plans import FIXTURE_PARAMS as P
from wayfarer.plans.registry import TRIP_PROFILE, Layers, profiled_trips


def lines(df, *sections):
    return sorted((tuple(r) for r in df.collect() if r["section"] in sections), key=repr)


def test_special_rows(spark):
    day = datetime.date(1970, 1, 11)
    df = spark.createDataFrame([("a", "x", day, -3.0), (None, " ", None, 0.0), ("a", "x", day, None), ("b", "", None, 8.0), (None, " ", None, 0.0)],
                               "k string, t string, d date, v double")
    spec = Profile(columns=("k", "t"), parsed=(("t", "d"),), histograms=("k",), ranges=("d", "v"), keys=(("k", "t"), ("k",)),
                   distinct=("k",), quantiles=("v",), probabilities=(0.0, 0.5, 1.0))
    got = {(r["section"], r["item"], r["value"]): r for r in profile_table(df, spec).collect()}
    count = {k: r["row_cnt"] for k, r in got.items()}
    assert count[("rows", "", "")] == 5 and count[("column", "k", "null")] == 2 and count[("column", "t", "blank")] == 3
    assert count[("parse", "t", "parsed")] == 2 and count[("parse", "t", "failed")] == 3
    assert count[("histogram", "k", None)] == 2 and count[("histogram", "k", "a")] == 2 and count[("histogram", "k", "b")] == 1
    assert count[("duplicates", "k,t", "surplus")] == 2 and count[("duplicates", "k", "surplus")] == 2
    assert tuple(got[("range", "d", "")])[3:7] == (2, 0.4, 10.0, 10.0) and tuple(got[("range", "v", "")])[3:7] == (4, 0.8, -3.0, 8.0)
    assert round(got[("distinct", "k", None)]["estimate"]) == 2
    near = {p: got[("quantile", "v", p)]["estimate"] for p in ("0.0", "0.5", "1.0")}
    assert abs(near["0.0"] + 3) <= 0.03 and near["0.5"] == 0.0 and abs(near["1.0"] - 8) <= 0.08


def test_values_without_a_bucket_are_left_out(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (1e-300,), (1e300,)], "v double")
    got = {r["value"]: r for r in profile_table(df, Profile(quantiles=("v",), probabilities=(0.1, 1.0))).collect() if r["section"] == "quantile"}
    assert abs(got["0.1"]["estimate"] / 1e-300 - 1) <= 0.01 and abs(got["1.0"]["estimate"] / 1e300 - 1) <= 0.01 and got["0.1"]["row_cnt"] == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, v int")
    got = profile_table(df, Profile(columns=("k",), histograms=("v",), ranges=("v",), keys=(("k",),), distinct=("k",), quantiles=("v",)))
    assert sorted((r["section"], r["row_cnt"]) for r in got.collect()) == [("duplicates", 0), ("rows", 0)]


def test_keys_that_run_together_are_told_apart(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("1:a", None), (None, "1:a"), ("-", None), (None, "-")], "x string, y string")
    got = profile_table(df, Profile(keys=(("x", "y"),)))
    assert lines(got, "duplicates")[0][3] == 0


def test_sketches_are_within_their_bounds(spark):
    n = 200_000
    df = spark.range(n).selectExpr("id AS v", "id % 30000 AS w", "concat('u', id % 500) AS u", "exp(pmod(hash(id), 1000) / 100.0) AS x")
    spec = Profile(distinct=("v", "w", "u"), quantiles=("v", "x"), probabilities=(0.01, 0.25, 0.5, 0.9, 0.999))
    report = profile_table(df, spec).collect()
    sigma = 1.04 / math.sqrt(1 << HLL_BITS)
    for item, true in (("v", n), ("w", 30_000), ("u", 500)):
        said = next(r["estimate"] for r in report if (r["section"], r["item"]) == ("distinct", item))
        assert abs(said - true) <= 4 * sigma * true, (item, said)
    for item in ("v", "x"):
        values = sorted(float(r[0]) for r in df.select(item).collect())
        for p in spec.probabilities:
            true = values[max(math.ceil(n * p), 1) - 1]
            said = next(r["estimate"] for r in report if (r["section"], r["item"], r["value"]) == ("quantile", item, str(p)))
            assert abs(said - true) <= QUANTILE_ERROR * abs(true) * 1.0001, (item, p, said, true)
    assert FIRST_BUCKET > math.log(1.7e308) / math.log((1 + QUANTILE_ERROR) / (1 - QUANTILE_ERROR))


def test_merged_cells_are_the_cells_of_all_rows(spark):
    df = profiled_trips(Layers(spark, SF_SMALL, P))
    whole = profile_cells(df, TRIP_PROFILE)
    third = [df.where(f"coalesce(crc32(departure_date), 0) % 3 = {k}") for k in range(3)]
    parts = merge_cells(*[profile_cells(t, TRIP_PROFILE) for t in third])
    assert sorted(map(tuple, parts.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert profile_report(parts, TRIP_PROFILE).count() == profile_report(whole, TRIP_PROFILE).count() > 20


def test_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "cast(id AS string) AS s").write.parquet(path)
    spec = Profile(columns=("id", "s"), histograms=("id",), ranges=("id",), keys=(("id", "s"), ("s",)), distinct=("s",), quantiles=("id",))
    p = plan(profile_table(spark.read.parquet(path), spec))
    cells = plan(profile_cells(spark.read.parquet(path), spec))
    assert cells.count("FileScan") == 1 and cells.count("Exchange") == 1 and "SortAggregate" not in cells and "Python" not in cells
    assert p.count("FileScan") == 1, p
