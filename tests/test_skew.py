"""Skewed inputs: one user, one POI, one month and one copy group each hold about a third of the rows.

The skewed tables are derived from the sf0.001 tables with DuckDB into a temporary folder;
both the Spark queries and the oracle SQL then run unchanged on that folder.
"""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.compare_oracle import TABLES, digest
from tests.conftest import SF_SMALL

SKEWED = ["dedupe_trips", "clean_trips", "user_month", "attraction_quarter", "city_quarter",
          "city_quarter_from_attractions", "user_portrait",
          "top_attractions", "top_cities", "favorite_city"]


@pytest.fixture(scope="module")
def skew_dir(tmp_path_factory):
    out = tmp_path_factory.mktemp("skew")
    con = duckdb.connect()
    src = lambda t: f"read_parquet('{SF_SMALL}/{t}.parquet')"
    con.execute(f"COPY (SELECT * FROM {src('part')}) TO '{out}/part.parquet' (FORMAT parquet)")
    # a third of the orders belong to user 7 and fall in 2001-03; order 1 (also user 7) is copied 750 times
    con.execute(f"""COPY (
        SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 OR o_orderkey = 1 THEN 7 ELSE o_custkey END AS o_custkey,
               o_orderstatus,
               o_totalprice,
               CASE WHEN o_orderkey % 3 = 2 THEN TIMESTAMP '2001-03-15' ELSE o_orderdate END AS o_orderdate,
               o_orderpriority
        FROM {src('orders')}, range(CASE WHEN o_orderkey = 1 THEN 750 ELSE 1 END)
    ) TO '{out}/orders.parquet' (FORMAT parquet)""")
    # a third of the line items visit POI 5
    con.execute(f"""COPY (
        SELECT l_orderkey, CASE WHEN l_orderkey % 3 = 1 THEN 5 ELSE l_partkey END AS l_partkey, l_suppkey,
               l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
        FROM {src('lineitem')}
    ) TO '{out}/lineitem.parquet' (FORMAT parquet)""")
    for t in set(TABLES) - {"part", "orders", "lineitem"}:
        con.execute(f"COPY (SELECT * FROM {src(t)}) TO '{out}/{t}.parquet' (FORMAT parquet)")
    return str(out)


@pytest.mark.parametrize("name", SKEWED)
def test_skewed_matches_duckdb(spark, skew_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{skew_dir}/{t}.parquet')")
    df = E.queries()[name](spark, skew_dir)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert len(got) == len(want)
    assert digest(df.columns, got) == digest(ocols, want)


def test_hot_user_month_is_spread(spark, skew_dir):
    """With a low bound the hot user-months take the other route; the rows are the same."""
    from wayfarer.plans import FIXTURE_PARAMS, jobs
    from wayfarer.plans.registry import Layers, canonical
    L = Layers(spark, skew_dir, FIXTURE_PARAMS)
    usual = {tuple(r) for r in canonical(L.user_month).collect()}
    split = canonical(jobs.user_month(L.visits, L.dwd_poi, FIXTURE_PARAMS.with_(hot_user_month_visits=20)))
    assert {tuple(r) for r in split.collect()} == usual
    most = max(r[0] for r in L.user_month.select("total_spot_cnt").collect())
    assert most > 20


def test_skew_is_real(spark, skew_dir):
    from wayfarer.plans import FIXTURE_PARAMS
    from wayfarer.plans.registry import Layers
    L = Layers(spark, skew_dir, FIXTURE_PARAMS)
    trips = L.ods_trip
    n = trips.count()
    hot_user = trips.filter("blog_id = '7'").count()
    assert hot_user > n / 3
    v = L.visits
    assert v.filter("poi_id = '5'").count() > v.count() / 4
