"""The warehouse jobs, each a pure function from DataFrames to a DataFrame.

raw (ODS) -> clean (DWD) -> rollups per user-month / attraction-quarter / city-quarter (DWS)
-> user portrait and per-quarter rankings (ADS). Output columns follow ``wayfarer.schemas``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfarer.functions.classify import classify
from wayfarer.functions.dates import days_since, quarter_of_month
from wayfarer.functions.maps import top_keys
from wayfarer.functions.text import composite_id, period_label, split_keep_empty
from wayfarer.operators.clean import (
    blanks_to_null,
    dedupe,
    drop_null_keys,
    explode_sequence,
    fill_default,
    with_parsed_date,
    year_range,
)
from wayfarer.operators.enrich import join_dim, unique_by_key
from wayfarer.operators.growth import period_over_period
from wayfarer.operators.ledger import Tap, no_tap
from wayfarer.operators.ranking import top_n_per_group
from wayfarer.operators.regions import LEVELS, hierarchy_rollup, region_dim, share_of_parent, with_regions
from wayfarer.operators.reuse import broadcast_within, persisted
from wayfarer.operators.rollup import fold_parts, kind_rollup, map_entry, null_key_expr, row_rollup
from wayfarer.plans.params import REFERENCE_PARAMS, Params
from wayfarer.schemas import (
    ADS_TOP_ATTRACTIONS,
    ADS_TOP_CITIES,
    ADS_USER_PORTRAIT,
    DWD_POI,
    DWD_VISIT,
    DWS_ATTRACTION_QUARTER,
    DWS_CITY_QUARTER,
    DWS_USER_MONTH,
)
from wayfarer.sources.csv_load import read_poi_csv, read_trip_csv

USER_MONTH = ["blog_id", "travel_year", "travel_month"]
PERIOD_Q = ["travel_year", "travel_quarter"]


def _names(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields]


# ---------------------------------------------------------------- ODS
def load_ods(spark: SparkSession, poi_csv: str, trip_csv: str) -> tuple[DataFrame, DataFrame]:
    """Raw CSVs -> ODS POI and trip tables (renamed, declared types)."""
    return read_poi_csv(spark, poi_csv), read_trip_csv(spark, trip_csv)


# ---------------------------------------------------------------- DWD
def clean_poi(ods_poi: DataFrame, params: Params = REFERENCE_PARAMS, tap: Tap = no_tap) -> DataFrame:
    """POI dimension: drop rows without id/name/city, blank or missing label -> default label,
    label split into tags, category from the ordered keyword rules on the label text, and
    one row per POI id (``params.unique_poi``: the smallest by name, city, category, label).

    Enforcing the key here, once, lets every roll-up join the dimension without re-checking
    it; a repeated id would otherwise multiply the visits it is joined to. ``tap`` counts the rows
    read, those with keys and the unique ones."""
    df = tap(ods_poi.select("poi_id", "name_zh", "city_zh", "label_zh"), "read")
    df = tap(drop_null_keys(df, ["poi_id", "name_zh", "city_zh"]), "with_keys")
    df = blanks_to_null(df, ["label_zh"])
    df = fill_default(df, params.label_default, ["label_zh"])
    df = df.select(
        "poi_id",
        F.col("name_zh").alias("name"),
        F.col("city_zh").alias("city"),
        split_keep_empty("label_zh", params.label_sep).alias("label"),
        classify("label_zh", params.rules).alias("category"),
    )
    if params.unique_poi == "first":
        df = dedupe(df, ["poi_id"], order=["name", "city", "category", "label"]).select(*_names(DWD_POI))
    else:
        df = unique_by_key(df, ["poi_id"], params.unique_poi)
    return tap(df, "unique")


def parse_trips(ods_trip: DataFrame, params: Params = REFERENCE_PARAMS, tap: Tap = no_tap) -> DataFrame:
    """Trips with key fields present, companions filled and the departure date parsed."""
    df = tap(ods_trip.select("blog_id", "departure_date", "travel_partners", "visit_sequence"), "read")
    df = tap(drop_null_keys(df, ["blog_id", "departure_date", "visit_sequence"]), "with_keys")
    df = fill_default(df, params.partner_default, ["travel_partners"])
    return with_parsed_date(df, "departure_date", "travel_date", params.date_formats,
                            year_col="travel_year", month_col="travel_month")


def dedupe_trips(parsed: DataFrame, params: Params = REFERENCE_PARAMS, tap: Tap = no_tap) -> DataFrame:
    """Year range, then one trip per (user, parsed date, raw sequence).

    The year is a function of the parsed date, a de-dup key, so filtering first yields the same
    rows with less data shuffled. Survivor: smallest (date text, companions)."""
    df = tap(year_range(parsed, "travel_year", params.year_min, params.year_max), "in_years")
    return tap(dedupe(df, ["blog_id", "travel_date", "visit_sequence"], order=["departure_date", "travel_partners"]), "unique")


def explode_visits(trips: DataFrame, params: Params = REFERENCE_PARAMS) -> DataFrame:
    """Trip id from the raw date text, then one row per visited POI."""
    df = trips.withColumn("trip_id", composite_id(params.trip_id_sep, "blog_id", "departure_date"))
    df = explode_sequence(df, "visit_sequence", "poi_id", params.sequence_sep)
    return df.select(*_names(DWD_VISIT))


def clean_trips(ods_trip: DataFrame, params: Params = REFERENCE_PARAMS, lay_out: bool = False, tap: Tap = no_tap) -> DataFrame:
    """Visit fact table (one row per trip and visited POI).

    ``lay_out`` rebalances the trips on the table's partition columns before they are exploded, so the
    layout of the write moves trips and not their visits. ``tap`` counts the trips read, with keys, in the
    range of years (unparsed dates are in none) and unique, and their visits."""
    trips = dedupe_trips(parse_trips(ods_trip, params, tap), params, tap)
    if lay_out:
        trips = trips.hint("rebalance", "travel_year", "travel_month")
    return tap(explode_visits(trips, params), "visits", filters=False)


# ---------------------------------------------------------------- DWS
def poi_dim(dwd_poi: DataFrame, params: Params = REFERENCE_PARAMS) -> DataFrame:
    """The join-side dimension (``params.poi_join_unique`` re-checks the key when the input
    did not come from ``clean_poi``)."""
    return unique_by_key(dwd_poi.select("poi_id", "name", "city", "category"), ["poi_id"], params.poi_join_unique)


def user_month(visits: DataFrame, dwd_poi: DataFrame, params: Params = REFERENCE_PARAMS) -> DataFrame:
    """Per user and month: distinct trips, visits, first/last date and three distribution maps.

    Visits to unknown POIs are kept (left join): they count as visits but add no city or
    category key. The visits are hashed by user and month once, meet in a row of their user-month and are
    counted there: one exchange of the narrow visits instead of one of each (kind, key) entry.

    A user-month of more than ``hot_bound`` visits would make too large a row; these few
    (at most all visits over that number, which bounds the broadcast) take the roll-up's own two
    exchanges instead, counted per (kind, key) over all tasks before they meet."""
    dim = poi_dim(dwd_poi, params).select("poi_id", "city", "category")
    hot = F.broadcast(hot_user_months(visits, params).select(*USER_MONTH))
    usual = _months(visits.join(hot, USER_MONTH, "left_anti"), dim, params, one_hash=True)
    return usual.unionByName(_months(visits.join(hot, USER_MONTH, "left_semi"), dim, params))


MONTH_MAPS = {"city_visit_map": "city", "category_visit_map": "category", "partner_visit_map": "travel_partners"}
MONTH_DATES = {"first_trip_date": "travel_date"}, {"last_trip_date": "travel_date"}


def _months(visits: DataFrame, dim: DataFrame, params: Params, one_hash: bool = False) -> DataFrame:
    """The roll-up of ``user_month``; with ``one_hash`` (no user-month beyond ``hot_bound``) it has one exchange of the visits."""
    j = join_dim(visits, dim, ["poi_id"], how="left", broadcast=params.broadcast_poi, unique_key="allow")
    first, last = MONTH_DATES
    rollup = row_rollup if one_hash else kind_rollup
    return rollup(
        j.repartition(*USER_MONTH) if one_hash else j, USER_MONTH, maps=MONTH_MAPS,
        distinct_counts={"trip_total_cnt": "trip_id"}, row_count="total_spot_cnt", mins=first, maxs=last,
        null_key=params.null_map_key,
    ).select(*_names(DWS_USER_MONTH))


ROW_VISITS = 4096  # the most visits that meet in one row


def hot_bound(params: Params) -> int:
    """Visits beyond which a user-month is rolled up over many tasks."""
    return min(params.hot_user_month_visits, ROW_VISITS)


def hot_user_months(visits: DataFrame, params: Params = REFERENCE_PARAMS) -> DataFrame:
    """User-months of more than ``hot_bound`` visits, with ``_salts``, the visits in units of that."""
    counted = visits.groupBy(*USER_MONTH).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_bound(params))
    return counted.select(*USER_MONTH, F.ceil(F.col("_n") / hot_bound(params)).cast("bigint").alias("_salts"))


@contextmanager
def user_month_reused(visits: DataFrame, dwd_poi: DataFrame, params: Params = REFERENCE_PARAMS,
                      tap: Tap = no_tap) -> Iterator[DataFrame]:
    """``user_month`` for a write inside the block; the rows of the visits are scanned once.

    The hot user-months are found first, by a job that reads the visits' keys alone, and kept. With none, as
    usual, every user-month is hashed once and rolled up. Else the visits are hashed by user-month and
    salt, 0 but for the hot ones, whose visits are dealt to as many salts as they exceed the bound times; equal
    visits, which share a salt, are counted first, so however often one is repeated a part has few rows. That roll-up is kept: compact rows, of which the usual ones are the result as they are, and those
    of the hot user-months are folded over their salts. What is kept is released when the block ends."""
    dim = poi_dim(dwd_poi, params).select("poi_id", "city", "category")
    with persisted(hot_user_months(visits, params)) as hot:
        if not hot.count():
            yield _months(tap(visits, "visits"), dim, params, one_hash=True)
            return
        hot = broadcast_within(hot, params.hint_bytes)
        dealt = F.pmod(F.xxhash64("trip_id", "poi_id", "travel_partners"), F.col("_salts")) + 1
        salted = tap(visits, "visits").join(hot, USER_MONTH, "left").withColumns({
            "_salt": F.coalesce(dealt, F.lit(0)), "_trip": F.when(F.col("_salts").isNotNull(), F.col("trip_id")).otherwise("")})
        j = join_dim(salted, dim, ["poi_id"], how="left", broadcast=params.broadcast_poi, unique_key="allow")
        first, last = MONTH_DATES
        same = j.repartition(*USER_MONTH, "_salt").groupBy(
            *USER_MONTH, "_salt", "trip_id", "_trip", "travel_date", "travel_partners", "city", "category").agg(F.count(F.lit(1)).alias("_n"))
        parts = row_rollup(
            same, [*USER_MONTH, "_salt"], maps={**MONTH_MAPS, "_trips": "_trip"}, weight="_n",
            distinct_counts={"trip_total_cnt": "trip_id"}, row_count="total_spot_cnt", mins=first, maxs=last,
            null_key=params.null_map_key)
        with persisted(parts) as kept:
            usual = kept.where(F.col("_salt") == 0).select(*_names(DWS_USER_MONTH))
            folded = fold_parts(kept.where(F.col("_salt") > 0), USER_MONTH, maps=list(MONTH_MAPS), sums=["total_spot_cnt"],
                                mins=list(first), maxs=list(last), distinct={"trip_total_cnt": "_trips"})
            yield usual.unionByName(folded.select(*_names(DWS_USER_MONTH)))


def quarterly_visits(visits: DataFrame, params: Params = REFERENCE_PARAMS) -> DataFrame:
    """Visits counted per (POI, year, quarter, companions) - the eager pre-aggregation both
    quarterly roll-ups start from. Partial aggregation runs before the shuffle, so a POI
    with a huge share of the visits is reduced map-side; the dimension join then runs on
    the reduced rows instead of on every visit."""
    v = visits.withColumn("travel_quarter", quarter_of_month("travel_month"))
    partner = null_key_expr("travel_partners", params.null_map_key)
    return v.groupBy("poi_id", *PERIOD_Q, partner.alias("travel_partners")).agg(F.count(F.lit(1)).alias("_n"))


def attraction_quarter(visits: DataFrame, dwd_poi: DataFrame, params: Params = REFERENCE_PARAMS) -> DataFrame:
    """Per attraction and quarter: visits, companion map, growth against the previous quarter."""
    pre = quarterly_visits(visits, params)
    j = join_dim(pre, poi_dim(dwd_poi, params), ["poi_id"], how="inner", broadcast=params.broadcast_poi, unique_key="allow")
    # rows per POI are bounded by quarters x companion types: hash them by POI once, so the
    # aggregation and the growth window both reuse this partitioning (no further shuffle)
    j = j.repartition("poi_id")
    # several dimension rows of one id and name (``unique_poi="allow"``) count together
    j = j.groupBy("poi_id", "name", "city", "category", *PERIOD_Q, "travel_partners").agg(F.sum("_n").alias("_n"))
    agg = j.groupBy("poi_id", "name", "city", "category", *PERIOD_Q).agg(
        F.sum("_n").alias("visit_total_cnt"),
        F.map_from_entries(F.collect_list(map_entry(F.col("travel_partners"), F.col("_n"), params.null_map_key)))
        .alias("partner_map"),
    )
    # an attraction is its id and names: duplicates that are allowed grow separately
    out = period_over_period(agg, ["poi_id", "name", "city", "category"], "visit_total_cnt", PERIOD_Q, 4, params.rising_threshold,
                             params.growth_gap, params.rising_flags)
    return out.select(*_names(DWS_ATTRACTION_QUARTER))


def city_quarter(visits: DataFrame, dwd_poi: DataFrame, params: Params = REFERENCE_PARAMS) -> DataFrame:
    """Per city and quarter: visits, distinct attractions, companion map and growth."""
    pre = quarterly_visits(visits, params)
    dim = poi_dim(dwd_poi, params).select("poi_id", "city")
    j = join_dim(pre, dim, ["poi_id"], how="inner", broadcast=params.broadcast_poi, unique_key="allow")
    agg = kind_rollup(j, ["city", *PERIOD_Q], maps={"partner_map": "travel_partners"},
                      distinct_counts={"unique_attraction_cnt": "poi_id"}, row_count="visit_trip_cnt",
                      weight="_n", null_key=params.null_map_key)
    out = period_over_period(agg, ["city"], "visit_trip_cnt", PERIOD_Q, 4, params.rising_threshold,
                             params.growth_gap, params.rising_flags)
    return out.select(*_names(DWS_CITY_QUARTER))


def city_quarter_from_attractions(attraction_quarter_df: DataFrame, params: Params = REFERENCE_PARAMS) -> DataFrame:
    """``city_quarter`` derived from the attraction-quarter table instead of the visits.

    Same rows as ``city_quarter`` (visits and companion counts add up over a city's POIs; the
    distinct attractions of a city-quarter are its POI rows), but the input is bounded by
    POIs x quarters, so the pipeline reads the visit fact table once for both quarterly tables.
    """
    aq = attraction_quarter_df
    pois = aq.select("city", *PERIOD_Q, F.lit(1).alias("kind"), F.col("poi_id").alias("key"),
                     F.col("visit_total_cnt").alias("_w"))
    partners = aq.select("city", *PERIOD_Q, F.lit(0).alias("kind"),
                         F.explode(F.col("partner_map").cast("map<string,bigint>")).alias("key", "_w"))
    level1 = pois.unionByName(partners).groupBy("city", *PERIOD_Q, "kind", "key").agg(F.sum("_w").alias("_n"))
    kind, n = F.col("kind"), F.col("_n")
    agg = level1.groupBy("city", *PERIOD_Q).agg(
        F.sum(F.when(kind == 1, n)).alias("visit_trip_cnt"),
        F.count(F.when(kind == 1, F.lit(1))).alias("unique_attraction_cnt"),
        F.map_from_entries(F.collect_list(F.when(kind == 0, F.struct(F.col("key"), n.alias("value")))))
        .alias("partner_map"),
    )
    out = period_over_period(agg, ["city"], "visit_trip_cnt", PERIOD_Q, 4, params.rising_threshold,
                             params.growth_gap, params.rising_flags)
    return out.select(*_names(DWS_CITY_QUARTER))


def region_quarter(city_quarter_df: DataFrame, regions: DataFrame, params: Params = REFERENCE_PARAMS) -> DataFrame:
    """Per quarter and level of the place hierarchy (city, province, region, total): visits, attractions, cities,
    growth against the previous quarter and the share of the next wider level's visits. ``regions``
    maps (city, province, region); other cities count as ``unmapped``.

    One aggregate over the city table, which has a row for each city and quarter, whatever the visits."""
    cities = city_quarter_df.select("city", *PERIOD_Q, "visit_trip_cnt", "unique_attraction_cnt")
    placed = with_regions(cities, region_dim(regions), params.broadcast_poi)
    out = hierarchy_rollup(placed, PERIOD_Q, {
        "visit_trip_cnt": F.sum("visit_trip_cnt"), "unique_attraction_cnt": F.sum("unique_attraction_cnt"),
        "city_cnt": F.count(F.lit(1))})
    out = period_over_period(out, ["level", *LEVELS], "visit_trip_cnt", PERIOD_Q, 4, params.rising_threshold,
                             params.growth_gap, params.rising_flags)
    return share_of_parent(out, PERIOD_Q, "visit_trip_cnt", "share_of_parent")


# ---------------------------------------------------------------- ADS
def user_totals(user_month_df: DataFrame, by_user: bool = False) -> DataFrame:
    """Per user: totals, last trip, active years and the three maps summed over all months.

    The entries of each map (and one "year" row per user-month) become rows tagged with their
    kind, summed per (user, kind, key), and per user only distinct keys are collected (bounded by
    the number of cities, categories and companion types).

    The input holds at most one row per user and month, so however many visits a user has, the
    user's rows are bounded by the number of months: the table is read once and hashed by user
    once, and the expansion, both aggregations and the collect then run without another shuffle.
    ``by_user`` says that it is bucketed by user already: then nothing is shuffled at all."""
    hashed = user_month_df if by_user else user_month_df.repartition("blog_id")
    none_l, none_d = F.lit(None).cast("bigint"), F.lit(None).cast("date")

    def entries(kind: int, map_col: str):
        return F.transform(F.map_entries(F.col(map_col).cast("map<string,bigint>")), lambda e: F.struct(
            F.lit(kind).alias("kind"), e["key"].alias("key"), e["value"].alias("cnt"),
            none_l.alias("trips"), none_l.alias("spots"), none_d.alias("last")))

    year = F.array(F.struct(
        F.lit(3).alias("kind"), F.col("travel_year").cast("string").alias("key"), none_l.alias("cnt"),
        F.col("trip_total_cnt").cast("bigint").alias("trips"), F.col("total_spot_cnt").cast("bigint").alias("spots"),
        F.col("last_trip_date").alias("last")))
    maps = [F.coalesce(entries(k, c), F.array()) for k, c in enumerate(
        ("city_visit_map", "category_visit_map", "partner_visit_map"))]
    rows = hashed.select("blog_id", F.inline(F.concat(year, *maps)))
    level1 = rows.groupBy("blog_id", "kind", "key").agg(
        F.sum("cnt").alias("cnt"), F.sum("trips").alias("trips"), F.sum("spots").alias("spots"),
        F.max("last").alias("last"))
    kind = F.col("kind")

    def summed(k: int):
        return F.map_from_entries(F.collect_list(F.when(kind == k, F.struct("key", "cnt"))))

    return level1.groupBy("blog_id").agg(
        F.sum(F.when(kind == 3, F.col("trips"))).alias("total_trips"),
        F.sum(F.when(kind == 3, F.col("spots"))).alias("total_spots"),
        F.max(F.when(kind == 3, F.col("last"))).alias("last_trip_date"),
        F.count(F.when(kind == 3, F.lit(1))).alias("active_years"),
        summed(0).alias("city_total_map"),
        summed(1).alias("category_total_map"),
        summed(2).alias("partner_total_map"),
    )


def user_status(last_trip_date: str, params: Params = REFERENCE_PARAMS):
    """Churned when the last trip is more than ``churn_days`` before the reference date."""
    churned, active = params.user_status
    return F.when(days_since(params.reference_date, last_trip_date) > params.churn_days, churned).otherwise(active)


def user_level(total_trips: str, active_years: str, params: Params = REFERENCE_PARAMS):
    """Frequency level from trips per active year: >= high_freq, >= mid_freq, else low."""
    high, mid, low = params.user_levels
    avg = F.when(F.col(active_years) > 0, F.col(total_trips) / F.col(active_years)).otherwise(F.lit(0.0))
    return F.when(avg >= params.high_freq, high).when(avg >= params.mid_freq, mid).otherwise(low)


def user_portrait(user_month_df: DataFrame, params: Params = REFERENCE_PARAMS, by_user: bool = False) -> DataFrame:
    """Per user: totals, favourite city / category / companions (all ties, sorted), level, status."""
    t = user_totals(user_month_df, by_user)
    return t.select(
        "blog_id", "total_trips", "total_spots",
        top_keys("city_total_map").alias("favorite_city"),
        top_keys("category_total_map").alias("favorite_category"),
        top_keys("partner_total_map").alias("favorite_partner"),
        user_level("total_trips", "active_years", params).alias("user_level"),
        user_status("last_trip_date", params).alias("user_status"),
    ).select(*_names(ADS_USER_PORTRAIT))


def _ranked_year(df: DataFrame, params: Params) -> DataFrame:
    return df if params.ranking_year is None else df.filter(F.col("travel_year") == params.ranking_year)


def top_attractions(attraction_quarter_df: DataFrame, params: Params = REFERENCE_PARAMS) -> DataFrame:
    """Top-N attractions per quarter of the ranking year (without one, of all that is given: see
    ``read_latest_year``); ties broken by POI id (then name, city, category); top companions read from
    the row's own map."""
    df = _ranked_year(attraction_quarter_df, params)
    order = [F.col("visit_total_cnt").desc(), F.col("poi_id"), F.col("name"), F.col("city"), F.col("category")]
    ranked = top_n_per_group(df, PERIOD_Q, order, params.top_attractions)
    return ranked.select(
        period_label("travel_year", "travel_quarter").alias("year_quarter"),
        "poi_id", "name", "city", "category", "visit_total_cnt",
        top_keys("partner_map").alias("top_partner"),
        F.col("rank").cast("int").alias("rank"), "is_hot_rising", "visit_cnt_growth_rate",
    ).select(*_names(ADS_TOP_ATTRACTIONS))


def top_cities(city_quarter_df: DataFrame, params: Params = REFERENCE_PARAMS, with_growth: bool = False) -> DataFrame:
    """Top-N cities per quarter of the ranking year, ties broken by city, ordered by quarter and rank;
    ``with_growth`` adds the growth rate behind the declared columns."""
    df = _ranked_year(city_quarter_df, params)
    ranked = top_n_per_group(df, PERIOD_Q, [F.col("visit_trip_cnt").desc(), F.col("city")], params.top_cities)
    return ranked.select(
        period_label("travel_year", "travel_quarter").alias("year_quarter"),
        "city", "visit_trip_cnt", "unique_attraction_cnt",
        top_keys("partner_map").alias("top_partner"),
        F.col("rank").cast("int").alias("rank"), "is_hot_rising", "visit_cnt_growth_rate",
    ).select(*_names(ADS_TOP_CITIES), *(["visit_cnt_growth_rate"] if with_growth else [])).orderBy("year_quarter", "rank")


__all__ = [
    "load_ods", "clean_poi", "parse_trips", "dedupe_trips", "explode_visits", "clean_trips", "poi_dim",
    "user_month", "user_month_reused", "hot_user_months", "quarterly_visits", "attraction_quarter", "city_quarter", "city_quarter_from_attractions",
    "region_quarter",
    "user_totals", "user_status",
    "user_level", "user_portrait", "top_attractions", "top_cities",
]
