"""Portraits from bucketed months and from totals that take replaced months as changes."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, rows
from tests.test_plans import plan
from wayfarer.plans import FIXTURE_PARAMS as P
from wayfarer.plans import jobs, portrait
from wayfarer.plans.registry import Layers, canonical
from wayfarer.sources import write_layer
from wayfarer.sources.tables import create_layer_databases


@pytest.fixture(scope="module")
def months(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("portrait") / "um")
    write_layer(Layers(spark, SF_SMALL, P).user_month, "dws_user_travel_month", path)
    return path


def test_bucketed_months_are_read_without_an_exchange(spark, months, tmp_path):
    create_layer_databases(spark)
    um = spark.read.parquet(months)
    portrait.write_bucketed_months(um, "dws.bucketed_um", 4, str(tmp_path / "b"))
    try:
        df = jobs.user_portrait(spark.table("dws.bucketed_um"), P, by_user=True)
        p = plan(df)
        assert "Exchange" not in p and p.count("FileScan") == 1 and "Bucketed: true" in p
        assert rows(canonical(df)) == rows(canonical(jobs.user_portrait(um, P)))
        files = spark.table("dws.bucketed_um").inputFiles()
        assert len(files) == 4
    finally:
        spark.sql("DROP TABLE dws.bucketed_um")


def test_state_gives_the_portrait(spark, months):
    um = spark.read.parquet(months)
    state = portrait.portrait_state(um)
    assert rows(canonical(portrait.portrait_of_state(state, P))) == rows(canonical(jobs.user_portrait(um, P)))


@pytest.mark.parametrize("replaced", [[(2000, 5)], [(1995, 1), (2001, 8), (1998, 12)], [(1980, 1)]])
def test_replaced_months(spark, months, replaced):
    um = spark.read.parquet(months)
    old = portrait.months_of(spark, months, replaced)
    # some users lose the month, others other counts, one is new to the table
    new = old.where("cast(blog_id AS bigint) % 3 <> 0").withColumns({
        "trip_total_cnt": F.col("trip_total_cnt") + 1, "city_visit_map": F.transform_values("city_visit_map", lambda k, v: v + 2),
        "partner_visit_map": F.map_concat("partner_visit_map", F.create_map(F.lit("other"), F.lit(7).cast("bigint")))})
    new = new.unionByName(new.orderBy("blog_id").limit(1).withColumn("blog_id", F.lit("new one")))
    there = F.lit(False)
    for y, m in replaced:
        there = there | ((F.col("travel_year") == y) & (F.col("travel_month") == m))
    whole = um.where(~there).unionByName(new)
    got = portrait.update_state(portrait.portrait_state(um), old, new)
    want = portrait.portrait_state(whole)

    def said(state):
        return {r["blog_id"]: ({k: tuple(v) for k, v in r["months"].items()}, r["city_total_map"], r["category_total_map"], r["partner_total_map"])
                for r in state.collect()}

    assert said(got) == said(want)
    assert rows(canonical(portrait.portrait_of_state(got, P))) == rows(canonical(jobs.user_portrait(whole, P)))


def test_other_months_are_not_scanned(spark, months):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    p = plan(portrait.months_of(spark, months, [(2000, 5), (2000, 6)]))
    assert re.search(r"PartitionFilters: \[.*2000.*5.*6", p) and "Filter" not in p.split("FileScan")[0]
    state = portrait.portrait_state(spark.read.parquet(months))
    update = portrait.update_state(state, portrait.months_of(spark, months, [(2000, 5)]), portrait.months_of(spark, months, [(2000, 5)]))
    scans = [x for x in plan(update).splitlines() if "FileScan" in x]
    assert len(scans) == 3 and sum("= 2000" in x for x in scans) == 2
    spark.conf.unset("spark.sql.maxMetadataStringLength")
