"""A table's quality report from one scan: exact counts and sketches, as cells that can be merged.

Each row of the table becomes a few small rows ``(part, key)``: one for each column (is it NULL, blank or a
value), for each parsed column, histogram, range, set of key columns, and for the sketches. They are
counted where they arise, so one scan and one exchange of the counts give the whole report. A sketch is
its cells too: a HyperLogLog register is the largest rank of its key, a quantile bucket the number of
values in it, so counting, merging over tasks and merging the cells of several days are one and the same
aggregation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HLL_BITS = 12  # 4,096 registers: a standard error of 1.04 / 64, 1.6 %
QUANTILE_ERROR = 0.01  # relative error of a quantile's value
FIRST_BUCKET = 1 << 20  # larger than any bucket's number, so that signs and zero are in order
CELLS = ("part", "key", "n", "rank", "low", "high")


@dataclass(frozen=True)
class Profile:
    """What to report: the parts of every profile of a table, in this order.

    columns     NULL, blank and other values of each
    parsed      (text, parsed): values that are absent, failed to parse, parsed
    histograms  rows for each value
    ranges      smallest and largest value, numbers or dates
    keys        sets of columns: surplus rows that repeat another's values
    distinct    estimated number of values (HyperLogLog)
    quantiles   columns of numbers whose quantiles are estimated, of the finite ones
    """

    columns: tuple[str, ...] = ()
    parsed: tuple[tuple[str, str], ...] = ()
    histograms: tuple[str, ...] = ()
    ranges: tuple[str, ...] = ()
    keys: tuple[tuple[str, ...], ...] = ()
    distinct: tuple[str, ...] = ()
    quantiles: tuple[str, ...] = ()
    probabilities: tuple[float, ...] = (0.5, 0.9, 0.99)

    @property
    def parts(self) -> list[tuple[str, str]]:
        return [("rows", ""), *[("column", c) for c in self.columns], *[("parse", c) for c, _ in self.parsed],
                *[("histogram", c) for c in self.histograms], *[("range", c) for c in self.ranges],
                *[("duplicates", ",".join(k)) for k in self.keys], *[("distinct", c) for c in self.distinct],
                *[("quantile", c) for c in self.quantiles]]

    def numbers(self, section: str) -> list[int]:
        return [i for i, (s, _) in enumerate(self.parts) if s == section]


def _gamma() -> float:
    return (1 + QUANTILE_ERROR) / (1 - QUANTILE_ERROR)


def _register(c: str) -> tuple[Column, Column]:
    """(register, rank) of a value: the low bits of its hash, and the place of the first one in the others."""
    h = F.xxhash64(c)
    rest = F.shiftrightunsigned(h, HLL_BITS)
    rank = F.when(rest == 0, 65 - HLL_BITS).otherwise(F.lit(65 - HLL_BITS) - F.length(F.bin(rest)))
    return h.bitwiseAND(F.lit((1 << HLL_BITS) - 1)), rank


def _bucket(c: str) -> Column:
    """The number of the bucket of a value, in the order of the values: bucket k of the powers of gamma holds
    those up to gamma ** k."""
    x = F.col(c).cast("double")
    k = F.ceil(F.log(F.abs(x)) / F.lit(math.log(_gamma()))) + FIRST_BUCKET
    return F.when(x > 0, k).when(x < 0, -k).otherwise(F.lit(0)).cast("bigint")


def _key_digest(columns: Sequence[str]) -> Column:
    """One digest for each combination of values; lengths keep neighbouring values apart."""
    said = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
            for c in columns]
    return F.sha2(F.concat(*said), 256)


def _as_number(df: DataFrame, c: str) -> Column:
    return F.unix_date(c).cast("double") if dict(df.dtypes)[c] == "date" else F.col(c).cast("double")


def profile_cells(df: DataFrame, profile: Profile) -> DataFrame:
    """(part, key, n, rank, low, high): the counted cells of ``profile.parts``, by their numbers."""
    rows: list[tuple[Column | None, Column | None, Column | None]] = [(None, None, None)]  # key, rank, value

    def text(c: str) -> Column:
        return F.col(c).cast("string")

    for c in profile.columns:
        rows.append((F.when(F.col(c).isNull(), "null").when(F.trim(text(c)) == "", "blank").otherwise("value"), None, None))
    for c, done in profile.parsed:
        rows.append((F.when(F.col(c).isNull(), "absent").when(F.col(done).isNull(), "failed").otherwise("parsed"), None, None))
    for c in profile.histograms:
        rows.append((text(c), None, None))
    for c in profile.ranges:
        rows.append((F.when(F.col(c).isNull(), "null").otherwise("value"), None, _as_number(df, c)))
    for columns in profile.keys:
        rows.append((_key_digest(columns), None, None))
    for c in profile.distinct:
        at, rank = _register(c)
        rows.append((F.when(F.col(c).isNotNull(), at).cast("string"), F.when(F.col(c).isNotNull(), rank), None))
    for c in profile.quantiles:
        x = F.col(c).cast("double")
        rows.append((F.when(~F.isnan(x) & (F.abs(x) < math.inf), _bucket(c)).cast("string"), None, None))
    none = {"string": F.lit(None).cast("string"), "int": F.lit(None).cast("int"), "double": F.lit(None).cast("double")}
    listed = [x for i, (key, rank, value) in enumerate(rows) for x in (
        F.lit(i), none["string"] if key is None else key, none["int"] if rank is None else rank.cast("int"),
        none["double"] if value is None else value)]
    expanded = df.select(F.stack(F.lit(len(rows)), *listed).alias("part", "key", "rank", "value"))
    return expanded.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("rank"),
                                               F.min("value").alias("low"), F.max("value").alias("high"))


def merge_cells(*cells: DataFrame) -> DataFrame:
    """The cells of several tables, or of several days of one, as those of all their rows together."""
    union = reduce(DataFrame.unionByName, [c.select(*CELLS) for c in cells])
    return union.groupBy("part", "key").agg(F.sum("n").alias("n"), F.max("rank").alias("rank"), F.min("low").alias("low"),
                                            F.max("high").alias("high"))


def _distinct_estimate(harmonic: Column, used: Column) -> Column:
    """HyperLogLog's estimate from the sum of 2 ** -rank over the used registers; while some are empty and the
    estimate is small, by the number of empty ones."""
    m = float(1 << HLL_BITS)
    empty = F.lit(m) - used
    raw = F.lit(0.7213 / (1 + 1.079 / m) * m * m) / (harmonic + empty)
    return F.when((raw <= 2.5 * m) & (empty > 0), F.lit(m) * F.log(F.lit(m) / empty)).otherwise(raw)


def _quantile(buckets: Column, n: Column, p: float) -> Column:
    """The value of the bucket that holds the ``p`` quantile, ``buckets`` being (bucket, n) in order."""
    wanted = F.greatest(F.ceil(n * F.lit(p)), F.lit(1))
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("bigint").alias("bucket"))

    def step(state: Column, b: Column) -> Column:
        seen = state["seen"] + b["n"]
        here = F.when(state["bucket"].isNull() & (seen >= wanted), b["bucket"]).otherwise(state["bucket"])
        return F.struct(seen.alias("seen"), here.alias("bucket"))

    bucket = F.aggregate(buckets, start, step)["bucket"]
    middle = F.pow(F.lit(_gamma()), F.abs(bucket) - FIRST_BUCKET) * F.lit(2 / (_gamma() + 1))
    return F.when(bucket == 0, F.lit(0.0)).otherwise(F.signum(bucket.cast("double")) * middle)


def profile_report(cells: DataFrame, profile: Profile) -> DataFrame:
    """(section, item, value, row_cnt, share, low, high, estimate) from the cells of ``profile``.

    rows: all rows. column: rows with a ``null``, ``blank`` or other ``value``. parse: ``absent``, ``failed`` or
    ``parsed``. histogram: rows with each value. range: rows with a value, the smallest and the largest (a
    date as days since 1970). duplicates: rows that repeat another's keys. distinct: the estimated number
    of values, quantile: the estimated value of each probability, of the rows that have one. ``share`` is of all
    rows. A section without rows has no line but ``rows`` and ``duplicates``, which are 0."""
    number = {s: profile.numbers(s) for s in ("rows", "range", "duplicates", "distinct", "quantile")}
    part, key = F.col("part"), F.col("key")
    copies, sketch = part.isin(number["duplicates"]), part.isin(number["distinct"] + number["quantile"])
    # the cells of copies are as many as distinct keys: their surplus is summed before anything else
    small = cells.groupBy("part", F.when(~copies, key).alias("key")).agg(
        F.sum(F.when(copies, F.col("n") - 1).otherwise(F.col("n"))).alias("n"), F.max("rank").alias("rank"),
        F.min("low").alias("low"), F.max("high").alias("high"))
    # at most 2**HLL_BITS registers, and the buckets between the smallest and the largest double
    used = key.isNotNull() & sketch
    buckets = F.array_sort(F.collect_list(F.when(part.isin(number["quantile"]) & used, F.struct(
        key.cast("bigint").alias("bucket"), F.col("n").alias("n")))))
    found = small.groupBy("part", F.when(~sketch, key).alias("key")).agg(
        F.sum(F.when(~sketch | used, F.col("n"))).alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum(F.when(part.isin(number["distinct"]) & used, F.pow(F.lit(2.0), -F.col("rank")))).alias("harmonic"),
        F.count(F.when(part.isin(number["distinct"]) & used, F.lit(1))).alias("used"), buckets.alias("buckets"))
    found = found.where(~part.isin(number["range"]) | (key == "value"))
    spark = cells.sparkSession
    names = spark.createDataFrame([(i, s, c) for i, (s, c) in enumerate(profile.parts)], "part int, section string, item string")
    always = names.where(part.isin(number["rows"] + number["duplicates"])).select("part")
    found = found.join(always, "part", "full")
    n = F.coalesce("n", F.lit(0))
    values = [F.struct(F.when(part.isin(number["duplicates"]), F.lit("surplus")).when(part.isin(number["range"]), F.lit(""))
                       .when(part == 0, F.lit("")).otherwise(key).alias("value"),
                       F.when(part.isin(number["distinct"]), _distinct_estimate(F.col("harmonic"), F.col("used"))).alias("estimate"))]
    each = F.when(part.isin(number["quantile"]), F.array(*[
        F.struct(F.lit(str(p)).alias("value"), _quantile(F.col("buckets"), F.col("n"), p).alias("estimate"))
        for p in profile.probabilities])).otherwise(F.array(*values))
    total = F.max(F.when(part == 0, n)).over(Window.partitionBy(F.lit(0)))  # some hundred lines at most, and the histograms'
    lines = found.select("part", n.alias("row_cnt"), F.try_divide(n, total).alias("share"), "low", "high", F.inline(each))
    lines = lines.where(~part.isin(number["distinct"] + number["quantile"]) | (F.col("row_cnt") > 0))
    return lines.join(F.broadcast(names), "part").select("section", "item", "value", "row_cnt", "share", "low", "high", "estimate")


def profile_table(df: DataFrame, profile: Profile) -> DataFrame:
    """``profile_report`` of one table, in one scan."""
    return profile_report(profile_cells(df, profile), profile)
