"""Registered queries: every operator family and job over the test tables (sf directory).

Each query reads the given Parquet tables and runs the library on all their rows. Results
are passed through ``canonical`` so both engines of the correctness check print the same
types (maps and arrays as text, dates and decimals as text, integers as BIGINT).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ByteType, DateType, DecimalType, IntegerType, MapType, ShortType

from wayfarer.functions.classify import REFERENCE_RULES, classify
from wayfarer.functions.dates import parse_date_multi
from wayfarer.functions.maps import map_text, top_keys
from wayfarer.operators.clean import drop_null_keys, explode_sequence
from wayfarer.operators.enrich import join_dim
from wayfarer.operators.ledger import StepLedger
from wayfarer.operators.profile import Profile, merge_cells, profile_cells, profile_report
from wayfarer.operators.quality import column_profile, conform_failures, duplicate_summary, parse_failures, value_histogram
from wayfarer.operators.ranking import argmax_set
from wayfarer.operators.rollup import count_map
from wayfarer.plans import jobs, portrait
from wayfarer.plans.params import FIXTURE_PARAMS, Params
from wayfarer.plans.pipeline import run_pipeline, table_paths
from wayfarer.schemas import TABLES
from wayfarer.session import scratch_path, sized_session
from wayfarer.sources.csv_load import POI_CSV_COLUMNS, TRIP_CSV_COLUMNS, read_poi_csv, read_trip_csv, write_source_csv
from wayfarer.sources.ddl import create_declared, load_declared
from wayfarer.sources.staged import read_staged, replace_staged
from wayfarer.sources.tables import create_layer_databases, read_latest_year, read_table, read_year, write_layer
from wayfarer.sources.testdata import raw_bytes, raw_pois, raw_regions, raw_trips


def canonical(df: DataFrame) -> DataFrame:
    """Engine-neutral column types for result comparison."""
    cols = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, MapType):
            c = map_text(c)
        elif isinstance(t, ArrayType):
            c = F.array_join(c, "|")
        elif isinstance(t, (DateType, DecimalType)):
            c = c.cast("string")
        elif isinstance(t, (IntegerType, ShortType, ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


@dataclass
class Layers:
    """The warehouse tables of one sf directory as lazy DataFrames (nothing is cached)."""

    spark: SparkSession
    sf_dir: str
    params: Params = FIXTURE_PARAMS

    @cached_property
    def ods_poi(self) -> DataFrame:
        return raw_pois(self.spark, self.sf_dir)

    @cached_property
    def ods_trip(self) -> DataFrame:
        return raw_trips(self.spark, self.sf_dir)

    @cached_property
    def dwd_poi(self) -> DataFrame:
        return jobs.clean_poi(self.ods_poi, self.params)

    @cached_property
    def parsed(self) -> DataFrame:
        return jobs.parse_trips(self.ods_trip, self.params)

    @cached_property
    def visits(self) -> DataFrame:
        return jobs.clean_trips(self.ods_trip, self.params)

    @cached_property
    def user_month(self) -> DataFrame:
        return jobs.user_month(self.visits, self.dwd_poi, self.params)

    @cached_property
    def attraction_quarter(self) -> DataFrame:
        return jobs.attraction_quarter(self.visits, self.dwd_poi, self.params)

    @cached_property
    def city_quarter(self) -> DataFrame:
        return jobs.city_quarter(self.visits, self.dwd_poi, self.params)

    def dim(self, *cols: str) -> DataFrame:
        return jobs.poi_dim(self.dwd_poi, self.params).select("poi_id", *cols)


Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Callable[[Layers], DataFrame]] = {}


def _register(name: str):
    def deco(fn: Callable[[Layers], DataFrame]):
        _REGISTRY[name] = fn
        return fn
    return deco


# words of the test tables' names, as labels
CHINESE_WORDS = {"small": "森林", "red": "公园", "blue": "湖泊", "hot": "温泉", "cold": "高楼", "ring": "博物馆", "gear": "古镇", "bolt": "乡村",
                 "widget": "漂流", "gizmo": "商圈"}


# -- sources ---------------------------------------------------------------------------
@_register("csv_rename_load_poi")
def _csv_poi(L: Layers) -> DataFrame:
    path = scratch_path(L.spark, "poi_csv")
    write_source_csv(L.ods_poi, path, POI_CSV_COLUMNS)
    return read_poi_csv(L.spark, path)


@_register("csv_rename_load_trips")
def _csv_trips(L: Layers) -> DataFrame:
    path = scratch_path(L.spark, "trip_csv")
    write_source_csv(L.ods_trip, path, TRIP_CSV_COLUMNS)
    return read_trip_csv(L.spark, path)


# -- cleaning operators -------------------------------------------------------------------
_TRIP_COLS = ["blog_id", "departure_date", "travel_partners", "visit_sequence"]


@_register("drop_null_keys")
def _drop_null(L: Layers) -> DataFrame:
    return drop_null_keys(L.ods_trip.select(*_TRIP_COLS), ["blog_id", "departure_date", "visit_sequence"])


@_register("fill_default")
def _fill(L: Layers) -> DataFrame:
    return L.parsed.select(*_TRIP_COLS)


@_register("blank_to_null")
def _blank(L: Layers) -> DataFrame:
    from wayfarer.functions.text import blank_to_null
    return L.ods_poi.select("poi_id", blank_to_null("label_zh").alias("label_zh"))


@_register("split_tags")
def _split(L: Layers) -> DataFrame:
    return L.dwd_poi.select("poi_id", "label")


@_register("classify_rules")
def _classify(L: Layers) -> DataFrame:
    return L.dwd_poi.select("poi_id", F.array_join("label", L.params.label_sep).alias("label_zh"), "category")


@_register("classify_chinese_rules")
def _classify_chinese(L: Layers) -> DataFrame:
    """The default rules, on labels whose words are put into the language of the rules."""
    label = F.col("name_en")
    for word, said in CHINESE_WORDS.items():
        label = F.replace(label, F.lit(word), F.lit(said))
    label = F.when(F.col("poi_id").cast("bigint") % 19 == 0, REFERENCE_RULES.sentinel_text).otherwise(F.replace(label, F.lit(" "), F.lit("")))
    return L.ods_poi.select("poi_id", label.alias("label_zh")).withColumn("category", classify("label_zh", REFERENCE_RULES))


@_register("parse_date_multi")
def _parse(L: Layers) -> DataFrame:
    # year / month of the parsed date are checked by year_range and dedupe_trips (non-NULL there)
    return L.parsed.select(*_TRIP_COLS, "travel_date")


@_register("parse_date_optional")
def _parse_optional(L: Layers) -> DataFrame:
    # dashed dates of every other user carry a time, which one format has as an optional section
    timed = F.col("departure_date").contains("-") & (F.col("blog_id").cast("bigint") % 2 == 0)
    text = F.when(timed, F.concat("departure_date", F.lit(" 08:30"))).otherwise(F.col("departure_date"))
    t = L.ods_trip.select("blog_id", text.alias("departure_date"))
    return t.withColumn("travel_date", parse_date_multi("departure_date", ("yyyy/M/d", "yyyy-MM-dd[ HH:mm]", "yyyyMMdd")))


@_register("year_range")
def _years(L: Layers) -> DataFrame:
    from wayfarer.operators.clean import year_range
    p = L.params
    return year_range(L.parsed, "travel_year", p.year_min, p.year_max).select(
        "blog_id", "departure_date", "travel_date", "travel_year")


@_register("dedupe_trips")
def _dedupe(L: Layers) -> DataFrame:
    return jobs.dedupe_trips(L.parsed, L.params)


@_register("composite_trip_id")
def _trip_id(L: Layers) -> DataFrame:
    from wayfarer.functions.text import composite_id
    t = jobs.dedupe_trips(L.parsed, L.params)
    return t.select("blog_id", "departure_date",
                    composite_id(L.params.trip_id_sep, "blog_id", "departure_date").alias("trip_id"))


@_register("explode_sequence")
def _explode(L: Layers) -> DataFrame:
    return explode_sequence(L.parsed.select("blog_id", "departure_date", "visit_sequence"),
                            "visit_sequence", "poi_id", L.params.sequence_sep)


@_register("clean_poi")
def _clean_poi(L: Layers) -> DataFrame:
    return L.dwd_poi


@_register("clean_trips")
def _clean_trips(L: Layers) -> DataFrame:
    return L.visits


# -- joins and roll-ups -------------------------------------------------------------------
def _left_joined(L: Layers) -> DataFrame:
    return join_dim(L.visits, L.dim("city", "category"), ["poi_id"], how="left", unique_key="allow")


@_register("join_dim_left")
def _jl(L: Layers) -> DataFrame:
    return _left_joined(L).select("blog_id", "trip_id", "poi_id", "city", "category")


@_register("join_dim_inner")
def _ji(L: Layers) -> DataFrame:
    return join_dim(L.visits, L.dim("name", "city", "category"), ["poi_id"], how="inner",
                    unique_key="allow").select("blog_id", "trip_id", "poi_id", "name", "city", "category")


@_register("user_month_base")
def _um_base(L: Layers) -> DataFrame:
    return L.user_month.select("blog_id", "trip_total_cnt", "total_spot_cnt", "first_trip_date", "last_trip_date",
                               "travel_year", "travel_month")


def _um_map(L: Layers, dim: str, out: str) -> DataFrame:
    return count_map(_left_joined(L), jobs.USER_MONTH, dim, out, null_key=L.params.null_map_key)


_register("user_month_city_map")(lambda L: _um_map(L, "city", "city_visit_map"))
_register("user_month_category_map")(lambda L: _um_map(L, "category", "category_visit_map"))
_register("user_month_partner_map")(lambda L: _um_map(L, "travel_partners", "partner_visit_map"))


@_register("user_month")
def _um(L: Layers) -> DataFrame:
    return L.user_month


@_register("user_month_persisted")
def _um_persisted(L: Layers) -> DataFrame:
    """One scan of the stored visits, with user-months beyond 4 visits dealt to salts and folded."""
    visits, out = scratch_path(L.spark, "visits"), scratch_path(L.spark, "user_month")
    write_layer(L.visits, "dwd_user_travel_sequence_info", visits)
    with jobs.user_month_reused(read_table(L.spark, visits), L.dwd_poi, L.params.with_(hot_user_month_visits=4)) as df:
        write_layer(df, "dws_user_travel_month", out)
    return read_table(L.spark, out, columns=[f.name for f in TABLES["dws_user_travel_month"][0].fields])


@_register("attraction_quarter")
def _aq(L: Layers) -> DataFrame:
    return L.attraction_quarter


@_register("attraction_growth_bridge")
def _aq_bridge(L: Layers) -> DataFrame:
    return L.attraction_quarter.select("poi_id", "travel_year", "travel_quarter", "visit_total_cnt",
                                       "visit_cnt_growth_rate")


@_register("rising_flag")
def _rising(L: Layers) -> DataFrame:
    return L.city_quarter.select("city", "travel_year", "travel_quarter", "visit_trip_cnt", "is_hot_rising")


@_register("attraction_growth_strict")
def _aq_strict(L: Layers) -> DataFrame:
    strict = jobs.attraction_quarter(L.visits, L.dwd_poi, L.params.with_(growth_gap="strict"))
    return strict.select("poi_id", "travel_year", "travel_quarter", "visit_total_cnt", "visit_cnt_growth_rate",
                         "is_hot_rising")


@_register("attraction_quarter_allow")
def _aq_allow(L: Layers) -> DataFrame:
    p = L.params.with_(unique_poi="allow")
    return jobs.attraction_quarter(L.visits, jobs.clean_poi(L.ods_poi, p), p)


@_register("city_quarter")
def _cq(L: Layers) -> DataFrame:
    return L.city_quarter


@_register("city_growth_strict")
def _cq_strict(L: Layers) -> DataFrame:
    strict = jobs.city_quarter(L.visits, L.dwd_poi, L.params.with_(growth_gap="strict"))
    return strict.select("city", "travel_year", "travel_quarter", "visit_trip_cnt", "visit_cnt_growth_rate",
                         "is_hot_rising")


@_register("city_quarter_from_attractions")
def _cq_from_aq(L: Layers) -> DataFrame:
    return jobs.city_quarter_from_attractions(L.attraction_quarter, L.params)


@_register("region_quarter")
def _region_quarter(L: Layers) -> DataFrame:
    return jobs.region_quarter(L.city_quarter, raw_regions(L.spark, L.sf_dir), L.params)


@_register("top_partner")
def _top_partner(L: Layers) -> DataFrame:
    return L.attraction_quarter.select("poi_id", "travel_year", "travel_quarter",
                                       top_keys("partner_map").alias("top_partner"))


# -- portrait -----------------------------------------------------------------------------
def _favorite(L: Layers, map_col: str, out: str) -> DataFrame:
    """The long-table route (explode, sum, dense_rank = 1, collect) - cross-checks ``top_keys``."""
    long = (L.user_month.select("blog_id", F.explode(map_col).alias("k", "n"))
            .groupBy("blog_id", "k").agg(F.sum("n").alias("n")))
    return argmax_set(long, ["blog_id"], "k", "n", out)


_register("favorite_city")(lambda L: _favorite(L, "city_visit_map", "favorite_city"))
_register("favorite_category")(lambda L: _favorite(L, "category_visit_map", "favorite_category"))
_register("favorite_partner")(lambda L: _favorite(L, "partner_visit_map", "favorite_partner"))


@_register("user_status")
def _status(L: Layers) -> DataFrame:
    return jobs.user_totals(L.user_month).select(
        "blog_id", jobs.user_status("last_trip_date", L.params).alias("user_status"))


@_register("user_level")
def _level(L: Layers) -> DataFrame:
    return jobs.user_totals(L.user_month).select(
        "blog_id", jobs.user_level("total_trips", "active_years", L.params).alias("user_level"))


@_register("user_portrait")
def _portrait(L: Layers) -> DataFrame:
    return jobs.user_portrait(L.user_month, L.params)


@_register("user_portrait_bucketed")
def _portrait_bucketed(L: Layers) -> DataFrame:
    create_layer_databases(L.spark)
    place = scratch_path(L.spark, "bucketed")
    table = "dws.b_" + place.rsplit("-", 1)[-1]
    portrait.write_bucketed_months(L.user_month, table, buckets=8, location=place)
    return jobs.user_portrait(L.spark.table(table), L.params, by_user=True)


@_register("user_portrait_updated")
def _portrait_updated(L: Layers) -> DataFrame:
    """A state made while one month of the table was wrong, updated with that month's right rows."""
    right, wrong, state = (scratch_path(L.spark, n) for n in ("months", "months-before", "portrait-state"))
    write_layer(L.user_month, "dws_user_travel_month", right)
    replaced = (L.params.ranking_year, 3)
    months = read_table(L.spark, right)
    there = (F.col("travel_year") == replaced[0]) & (F.col("travel_month") == replaced[1])
    # before: half of the month's users were missing, the others had other counts and one more city
    before = months.where(there & (F.col("blog_id").cast("bigint") % 2 == 0)).withColumns({
        "total_spot_cnt": F.col("total_spot_cnt") + 5, "last_trip_date": F.lit("2099-01-01").cast("date"),
        "city_visit_map": F.map_concat(F.transform_values("city_visit_map", lambda k, v: v * 9), F.create_map(F.lit("nowhere"), F.lit(99).cast("bigint"))),
        "category_visit_map": F.transform_values("category_visit_map", lambda k, v: v + 40)})
    # and somebody was there who should not have been
    before = before.unionByName(before.limit(1).withColumn("blog_id", F.lit("nobody")))
    write_layer(months.where(~there).unionByName(before), "dws_user_travel_month", wrong)
    portrait.portrait_state(read_table(L.spark, wrong)).write.parquet(state)
    updated = portrait.update_state(L.spark.read.parquet(state), portrait.months_of(L.spark, wrong, [replaced]),
                                    portrait.months_of(L.spark, right, [replaced]))
    return portrait.portrait_of_state(updated, L.params)


@_register("top_cities_latest")
def _top_cities_latest(L: Layers) -> DataFrame:
    path = scratch_path(L.spark, "dws_city_travel_quarter")
    write_layer(L.city_quarter, "dws_city_travel_quarter", path)
    return jobs.top_cities(read_latest_year(L.spark, path), L.params.with_(ranking_year=None))


@_register("top_attractions")
def _top_attr(L: Layers) -> DataFrame:
    return jobs.top_attractions(L.attraction_quarter, L.params)


@_register("top_cities")
def _top_cities(L: Layers) -> DataFrame:
    return jobs.top_cities(L.city_quarter, L.params)


@_register("top_cities_growth")
def _top_cities_growth(L: Layers) -> DataFrame:
    return jobs.top_cities(L.city_quarter, L.params, with_growth=True)


# -- storage round trips ------------------------------------------------------------------
@_register("partition_pruned_year")
def _pruned(L: Layers) -> DataFrame:
    path = scratch_path(L.spark, "dws_city_travel_quarter")
    write_layer(L.city_quarter, "dws_city_travel_quarter", path)
    return read_year(L.spark, path, L.params.ranking_year).select(
        "city", "visit_trip_cnt", "unique_attraction_cnt", "partner_map", "visit_cnt_growth_rate", "is_hot_rising",
        "travel_year", "travel_quarter")


@_register("layered_top_cities")
def _layered(L: Layers) -> DataFrame:
    warehouse = scratch_path(L.spark, "warehouse")
    run_pipeline(L.spark, L.ods_poi, L.ods_trip, warehouse, L.params)
    return read_table(L.spark, table_paths(warehouse)["ads_city_top10_last_year"])


@_register("catalog_dynamic_overwrite")
def _catalog(L: Layers) -> DataFrame:
    """A partitioned catalog table whose ranking year is replaced; the other years stay."""
    create_layer_databases(L.spark)
    place = scratch_path(L.spark, "catalog")
    table = "dws.t_" + place.rsplit("-", 1)[-1]
    write_layer(L.city_quarter, "dws_city_travel_quarter", table, as_table=True, location=place)
    # stored apart: a table can't be read and overwritten at once
    change = scratch_path(L.spark, "change")
    write_layer(read_year(L.spark, table, L.params.ranking_year, as_table=True)
                .withColumn("visit_trip_cnt", F.col("visit_trip_cnt") + 1000), "dws_city_travel_quarter", change)
    write_layer(read_table(L.spark, change), "dws_city_travel_quarter", table, as_table=True, overwrite="dynamic")
    return read_table(L.spark, table, as_table=True)


@_register("ddl_text_table")
def _text_table(L: Layers) -> DataFrame:
    """The raw POI table as declared: delimited files behind an external table of the catalog."""
    create_layer_databases(L.spark)
    place = scratch_path(L.spark, "text")
    table = create_declared(L.spark, "ods_poi_dim", "ods.x_" + place.rsplit("-", 1)[-1], place)
    load_declared(L.ods_poi, "ods_poi_dim", table)
    return L.spark.table(table)


@_register("staged_overwrite")
def _staged(L: Layers) -> DataFrame:
    """A staged table, made wrong first and then replaced by a plan that reads it."""
    table = scratch_path(L.spark, "staged")
    replace_staged(L.city_quarter.withColumn("visit_trip_cnt", F.col("visit_trip_cnt") + 1000), "dws_city_travel_quarter", table)
    before = read_staged(L.spark, table)
    replace_staged(before.withColumn("visit_trip_cnt", F.col("visit_trip_cnt") - 1000), "dws_city_travel_quarter", table)
    return read_staged(L.spark, table)


@_register("step_counts")
def _step_counts(L: Layers) -> DataFrame:
    """Rows at each point of each step, counted while the warehouse is written."""
    ledger = StepLedger()
    run_pipeline(L.spark, L.ods_poi, L.ods_trip, scratch_path(L.spark, "warehouse"), L.params, ledger=ledger)
    return ledger.table(L.spark)


# -- quality ------------------------------------------------------------------------------
TRIP_PROFILE = Profile(
    columns=("blog_id", "departure_date", "travel_partners", "visit_sequence"), parsed=(("departure_date", "travel_date"),),
    histograms=("travel_year",), ranges=("travel_date", "n_visits"), keys=(("blog_id", "travel_date", "visit_sequence"),),
    distinct=("blog_id", "visit_sequence"), quantiles=("n_visits",))


def profiled_trips(L: Layers) -> DataFrame:
    day = parse_date_multi("departure_date", L.params.date_formats)
    return L.ods_trip.withColumn("travel_date", day).withColumns({
        "travel_year": F.year("travel_date"), "n_visits": F.size(F.split("visit_sequence", L.params.sequence_sep))})


@_register("quality_one_pass")
def _quality_one_pass(L: Layers) -> DataFrame:
    """The exact lines of the report (tests check the sketches' lines against their bounds)."""
    report = profile_report(profile_cells(profiled_trips(L), TRIP_PROFILE), TRIP_PROFILE)
    return report.where(~F.col("section").isin("distinct", "quantile")).drop("estimate")


@_register("quality_merged")
def _quality_merged(L: Layers) -> DataFrame:
    """The same lines from the cells of the halves of the table, taken apart and merged."""
    trips = profiled_trips(L)
    half = F.coalesce(F.crc32(F.col("retrieval_date")), F.lit(0)) % 2
    cells = merge_cells(*[profile_cells(trips.where(half == k), TRIP_PROFILE) for k in (0, 1)])
    return profile_report(cells, TRIP_PROFILE).where(~F.col("section").isin("distinct", "quantile")).drop("estimate")


@_register("quality_report")
def _quality(L: Layers) -> DataFrame:
    return column_profile(L.ods_trip, ["blog_id", "departure_date", "travel_partners", "visit_sequence"])


@_register("quality_report_poi")
def _quality_poi(L: Layers) -> DataFrame:
    return column_profile(L.ods_poi, ["poi_id", "name_zh", "city_zh", "label_zh"])


@_register("quality_report_typed")
def _quality_typed(L: Layers) -> DataFrame:
    return column_profile(L.ods_poi, ["longitude", "latitude"])


@_register("quality_year_histogram")
def _years_histogram(L: Layers) -> DataFrame:
    return value_histogram(L.parsed, "travel_year")


@_register("quality_category_histogram")
def _category_histogram(L: Layers) -> DataFrame:
    return value_histogram(L.dwd_poi, "category")


@_register("conform_failures")
def _conform_failures(L: Layers) -> DataFrame:
    text = F.when(F.col("poi_id").cast("bigint") % 29 == 0, F.lit("n/a")).otherwise(F.col("latitude").cast("string"))
    rows = L.ods_poi.withColumn("latitude", text).withColumn("longitude", F.col("longitude").cast("string"))
    return conform_failures(rows, TABLES["ods_poi_dim"][0])


@_register("date_parse_failures")
def _parse_fail(L: Layers) -> DataFrame:
    return parse_failures(L.parsed, "departure_date", "travel_date")


@_register("duplicate_trips")
def _dups(L: Layers) -> DataFrame:
    return duplicate_summary(L.parsed, ["blog_id", "travel_date", "visit_sequence"])


def queries(params: Params = FIXTURE_PARAMS) -> dict[str, Query]:
    def bind(fn: Callable[[Layers], DataFrame]) -> Query:
        return lambda spark, sf_dir: canonical(fn(Layers(sized_session(spark, raw_bytes(spark, sf_dir)), sf_dir, params)))
    return {name: bind(fn) for name, fn in _REGISTRY.items()}
