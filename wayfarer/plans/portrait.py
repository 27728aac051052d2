"""The user portrait kept up to date: bucketed months, and totals that take replaced months as changes.

``portrait_state`` holds per user what the portrait is made from. When months of the user-month table are
replaced, ``update_state`` takes their old rows off and adds the new ones; months that are not replaced are
not read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfarer.functions.maps import top_keys
from wayfarer.plans.jobs import user_level, user_status
from wayfarer.plans.params import REFERENCE_PARAMS, Params
from wayfarer.schemas import ADS_USER_PORTRAIT

MAPS = {"city_total_map": "city_visit_map", "category_total_map": "category_visit_map", "partner_total_map": "partner_visit_map"}
MONTH_STATE = "struct<trips: bigint, spots: bigint, last: date>"


# -- storage by user ------------------------------------------------------------------------------
def write_bucketed_months(user_month: DataFrame, table: str, buckets: int, location: str | None = None) -> None:
    """The user-month table as a catalog table bucketed by user: jobs by user read it without a shuffle. The
    rows are hashed to the buckets first, so each bucket is one file."""
    w = (user_month.repartition(buckets, "blog_id").write.mode("overwrite").format("parquet")
         .bucketBy(buckets, "blog_id").sortBy("blog_id"))
    (w.option("path", location) if location else w).saveAsTable(table)


# -- incremental totals ---------------------------------------------------------------------------
def _months(rows: DataFrame) -> DataFrame:
    """Per user the rows' months as a map (year * 12 + month - 1 -> trips, spots, last date), and the three
    maps summed. A user's rows are bounded by the number of months."""
    month = (F.col("travel_year") * 12 + F.col("travel_month") - 1).cast("int")
    state = F.struct(F.col("trip_total_cnt").cast("bigint").alias("trips"), F.col("total_spot_cnt").cast("bigint").alias("spots"),
                     F.col("last_trip_date").alias("last"))
    listed = [F.flatten(F.collect_list(F.map_entries(F.col(c).cast("map<string,bigint>")))).alias(f"_{out}") for out, c in MAPS.items()]
    found = rows.groupBy("blog_id").agg(F.map_from_entries(F.collect_list(F.struct(month, state))).alias("months"), *listed)
    empty = F.expr("map_from_arrays(cast(array() as array<string>), cast(array() as array<bigint>))")
    summed = [F.aggregate(f"_{out}", empty, lambda acc, e: _added(acc, F.create_map(e["key"], e["value"]))).alias(out) for out in MAPS]
    return found.select("blog_id", "months", *summed)


def _added(a: Column, b: Column, sign: int = 1) -> Column:
    """The sum of two maps key by key (``sign`` -1: their difference), without the keys that come to nothing."""
    both = F.map_zip_with(a, b, lambda k, x, y: F.coalesce(x, F.lit(0)) + sign * F.coalesce(y, F.lit(0)))
    return F.map_filter(both, lambda k, v: v != 0)


def portrait_state(user_month: DataFrame) -> DataFrame:
    """(blog_id, months, city_total_map, category_total_map, partner_total_map) of every user."""
    return _months(user_month)


def update_state(state: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """``state`` after the user-month rows ``old`` (all rows of the replaced months, as they were) gave way to
    ``new``. Users that neither of them names are passed on as they are; users without a month left go."""
    off = _months(old).select("blog_id", F.map_keys("months").alias("_gone"), *[F.col(c).alias(f"_off_{c}") for c in MAPS])
    on = _months(new).select("blog_id", F.col("months").alias("_new"), *[F.col(c).alias(f"_on_{c}") for c in MAPS])
    both = state.join(off, "blog_id", "left").join(on, "blog_id", "full")
    no_map = F.expr("map_from_arrays(cast(array() as array<string>), cast(array() as array<bigint>))")
    no_months = F.expr(f"map_from_arrays(cast(array() as array<int>), cast(array() as array<{MONTH_STATE}>))")
    gone = F.coalesce("_gone", F.array().cast("array<int>"))
    kept = F.map_filter(F.coalesce("months", no_months), lambda k, v: ~F.array_contains(gone, k))
    months = F.map_concat(kept, F.coalesce("_new", no_months))
    maps = [F.when(F.col(f"_off_{c}").isNull() & F.col(f"_on_{c}").isNull(), F.col(c)).otherwise(
        _added(_added(F.coalesce(c, no_map), F.coalesce(f"_off_{c}", no_map), -1), F.coalesce(f"_on_{c}", no_map))).alias(c) for c in MAPS]
    return both.select("blog_id", months.alias("months"), *maps).where(F.size("months") > 0)


def portrait_of_state(state: DataFrame, params: Params = REFERENCE_PARAMS) -> DataFrame:
    """``user_portrait`` from the state; a row of its own for each user, so nothing is shuffled."""
    values = F.map_values("months")
    t = state.select(
        "blog_id", F.aggregate(values, F.lit(0).cast("bigint"), lambda a, m: a + m["trips"]).alias("total_trips"),
        F.aggregate(values, F.lit(0).cast("bigint"), lambda a, m: a + m["spots"]).alias("total_spots"),
        F.array_max(F.transform(values, lambda m: m["last"])).alias("last_trip_date"),
        F.size(F.array_distinct(F.transform(F.map_keys("months"), lambda k: F.floor(k / 12)))).alias("active_years"), *MAPS)
    return t.select(
        "blog_id", "total_trips", "total_spots", top_keys("city_total_map").alias("favorite_city"),
        top_keys("category_total_map").alias("favorite_category"), top_keys("partner_total_map").alias("favorite_partner"),
        user_level("total_trips", "active_years", params).alias("user_level"),
        user_status("last_trip_date", params).alias("user_status"),
    ).select(*[f.name for f in ADS_USER_PORTRAIT.fields])


def months_of(spark: SparkSession, table: str, months: list[tuple[int, int]], as_table: bool = False) -> DataFrame:
    """The rows of some (year, month) partitions of a user-month table; no other partition is read."""
    df = spark.table(table) if as_table else spark.read.parquet(table)
    wanted = F.lit(False)
    for year, month in months:
        wanted = wanted | ((F.col("travel_year") == year) & (F.col("travel_month") == month))
    return df.where(wanted)
