"""Map the TPC-H-shaped test tables onto the trip domain, with deterministic dirt.

* POI  = ``part``: id p_partkey, name p_name, city p_brand, label = words of p_name + p_type.
* trip = ``orders`` row of user o_custkey on o_orderdate, companions o_orderpriority,
  visit sequence = the order's ``lineitem`` part keys (ascending) joined by ';'.

Dirt is injected by key arithmetic so every engine reproduces it row for row; no row of the
source tables is left out. POIs: name NULL for key % 97 = 0, blank label for % 13 = 0, NULL
label for % 17 = 0; every POI with % 23 = 0 appears a second time with its type as city and label.
Trips: ten years earlier for % 53 = 0 and ten years later for % 59 = 0 (outside the year range);
date text 'junk' for % 101 = 0, else alternating three layouts by % 3; companions NULL for
% 11 = 0; a trailing ';;' for % 7 = 0; every order with % 50 = 0 appears twice: for % 100 = 0 the
second one's date is in the next layout, for % 150 = 0 it has other companions, else it is an
exact copy.
Regions: the city Brand#n is in province P(n div 5) and region R(n div 10), other cities in those of their
first two words and their first word; n % 7 = 0 is in no mapping, n % 6 = 0 is mapped a second time to
province A0 without a region, n % 11 = 0 to province Z9 of region R9.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfarer.schemas import ODS_POI, ODS_TRIP, conform
from wayfarer.sources.files import stored_bytes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Stored bytes of the tables that the raw tables are derived from."""
    return sum(stored_bytes(spark, f"{sf_dir.rstrip('/')}/{name}.parquet") for name in ("part", "orders", "lineitem"))


def raw_pois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ODS POI table (``ods_poi_dim`` columns) derived from ``part``."""
    # dealt as it is read: a row group may hold the whole table, and its task would sort it for the de-dup
    p = table(spark, sf_dir, "part").hint("rebalance", "p_partkey")
    k = F.col("p_partkey")
    label = F.concat(F.regexp_replace("p_name", " ", ";"), F.lit(";"), F.col("p_type"))
    # duplicates: one extra row for every 23rd part (generated by a filter-free explode)
    p = p.withColumn("_copy", F.explode(F.when(k % 23 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    again = F.col("_copy") == 1
    df = p.select(
        k.cast("string").alias("poi_id"),
        F.when(k % 97 == 0, F.lit(None)).otherwise(F.col("p_name")).alias("name_zh"),
        F.col("p_name").alias("name_en"),
        F.when(again, F.col("p_type")).otherwise(F.col("p_brand")).alias("city_zh"),
        F.when(again, F.col("p_type")).otherwise(F.col("p_brand")).alias("city_en"),
        F.col("p_size").cast("decimal(10,6)").alias("latitude"),
        F.col("p_retailprice").cast("decimal(10,6)").alias("longitude"),
        F.when(k % 13 == 0, F.lit("  ")).when(k % 17 == 0, F.lit(None))
         .when(again, F.col("p_type")).otherwise(label).alias("label_zh"),
        F.col("p_type").alias("label_en"),
    )
    return conform(df, ODS_POI)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ODS trip table (``ods_user_travel_sequence`` columns) derived from ``orders`` + ``lineitem``."""
    # hashed before they are collected: a task that reads a row group of millions would sort all of it in memory
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").repartition("l_orderkey")
    # an order has a handful of line items, so the collected list per order is bounded
    seqs = li.groupBy("l_orderkey").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("l_partkey")), lambda x: x.cast("string")),
                     ";").alias("seq"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    k = F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    day = F.when(k % 53 == 0, F.add_months(day, -120)).when(k % 59 == 0, F.add_months(day, 120)).otherwise(day)
    # copies: one extra row for every 50th order (generated by a filter-free explode)
    copies = F.when(k % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    t = (o.join(seqs, o.o_orderkey == seqs.l_orderkey, "left")
         .withColumn("_copy", F.explode(copies)).withColumn("_day", day))
    d, again = F.col("_day"), F.col("_copy") == 1
    layout = F.when(again & (k % 100 == 0), (k + 1) % 3).otherwise(k % 3)
    t = t.select(
        F.col("o_custkey").cast("string").alias("blog_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("retrieval_date"),
        F.when(k % 101 == 0, F.lit("junk"))
         .when(layout == 0, F.date_format(d, "yyyy/M/d"))
         .when(layout == 1, F.date_format(d, "yyyy-MM-dd"))
         .otherwise(F.date_format(d, "yyyyMMdd")).alias("departure_date"),
        F.when(k % 11 == 0, F.lit(None)).when(again & (k % 150 == 0), F.lit("0-OTHER"))
         .otherwise(F.col("o_orderpriority")).alias("travel_partners"),
        F.when(k % 7 == 0, F.concat(F.col("seq"), F.lit(";;"))).otherwise(F.col("seq")).alias("visit_sequence"),
    )
    return conform(t, ODS_TRIP)


def raw_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(city, province, region) of the test tables' cities, derived from ``part``."""
    city = raw_pois(spark, sf_dir).select(F.col("city_zh").alias("city")).where("city IS NOT NULL").distinct()
    n = F.expr("try_cast(substring_index(city, '#', -1) AS INT)")
    province = F.coalesce(F.concat(F.lit("P"), F.floor(n / 5)), F.substring_index("city", " ", 2))
    region = F.coalesce(F.concat(F.lit("R"), F.floor(n / 10)), F.substring_index("city", " ", 1))
    again = F.when(n % 6 == 0, F.array(F.lit("A0"))).when(n % 11 == 0, F.array(F.lit("Z9"))).otherwise(F.array())
    rows = city.where(n.isNull() | (n % 7 != 0)).select(
        "city", F.explode(F.concat(F.array(province), again)).alias("province"), region.alias("region"))
    return rows.withColumn("region", F.when(F.col("province") == "A0", "  ").when(F.col("province") == "Z9", "R9").otherwise(F.col("region")))
