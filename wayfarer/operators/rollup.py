"""Roll-ups with embedded distribution maps (``key -> count``).

``count_map`` is the plain two-level form (count per key, then collect per group).
``kind_rollup`` computes several maps, distinct counts, row counts and min / max in one pass:
each input row is expanded into one ``(kind, key)`` row per dimension, counted once per
``(group, kind, key)`` (partial aggregation before the shuffle) and folded per group with
conditional aggregates. Nothing collected is larger than the number of distinct map keys of
one group; distinct counts are counted, never collected. ``row_rollup`` gives the same for groups that
are known to have few rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_key_expr(col: str, null_key: str) -> Column:
    """The map key column under a NULL-key policy (a label policy replaces NULL by the label)."""
    c = F.col(col).cast("string")
    if null_key in ("drop", "error"):
        return c
    return F.coalesce(c, F.lit(null_key))


def map_entry(key: Column, value: Column, null_key: str = "drop") -> Column:
    """A (key, value) struct for ``map_from_entries``; NULL (skipped by collect) for a dropped NULL key."""
    entry = F.struct(key.alias("key"), value.alias("value"))
    return F.when(key.isNotNull(), entry) if null_key == "drop" else entry


def count_map(df: DataFrame, keys: Sequence[str], dim: str, out: str, null_key: str = "drop",
              weight: str | None = None) -> DataFrame:
    """``keys + [out]`` where ``out`` maps each value of ``dim`` to its row count (or summed weight).

    ``null_key``: ``drop`` NULL values (a group with only NULLs gets an empty map), ``error``
    (``map_from_entries`` raises on a NULL key), or a label that replaces NULL.
    """
    keys = list(keys)
    measure = F.sum(weight) if weight else F.count(F.lit(1))
    counted = df.groupBy(*keys, null_key_expr(dim, null_key).alias("_k")).agg(measure.alias("_n"))
    return counted.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(map_entry(F.col("_k"), F.col("_n"), null_key))).alias(out))


def kind_rollup(df: DataFrame, keys: Sequence[str], *, maps: Mapping[str, str] | None = None,
                distinct_counts: Mapping[str, str] | None = None, row_count: str | None = None,
                weight: str | None = None, mins: Mapping[str, str] | None = None,
                maxs: Mapping[str, str] | None = None, null_key: str = "drop") -> DataFrame:
    """One-pass roll-up per ``keys``.

    maps            {out: dim}  -> map dim value -> rows (or summed ``weight``)
    distinct_counts {out: col}  -> number of distinct non-NULL values of col
    row_count       out         -> rows in the group (or summed ``weight``)
    mins / maxs     {out: col}  -> min / max of col over the group
    """
    keys = list(keys)
    maps, distinct_counts = dict(maps or {}), dict(distinct_counts or {})
    mins, maxs = dict(mins or {}), dict(maxs or {})
    kinds: list[tuple[str, str, str]] = [("map", out, dim) for out, dim in maps.items()]
    kinds += [("distinct", out, c) for out, c in distinct_counts.items()]
    if not kinds:
        raise ValueError("kind_rollup needs at least one map or distinct count")

    carried = {f"_min{i}": c for i, c in enumerate(mins.values())}
    carried.update({f"_max{i}": c for i, c in enumerate(maxs.values())})
    stack_args = []
    for i, (what, _, c) in enumerate(kinds):
        key = null_key_expr(c, null_key) if what == "map" else F.col(c).cast("string")
        stack_args += [F.lit(i), key]
    w = F.col(weight) if weight else F.lit(1).cast("bigint")
    # stack emits the (kind, key) rows without building an array of structs per input row
    expanded = df.select(*keys, w.alias("_w"), *[F.col(c).alias(a) for a, c in carried.items()],
                         F.stack(F.lit(len(kinds)), *stack_args).alias("kind", "key"))

    # every input row appears once per kind, so min / max need to be carried by one kind only
    first = F.col("kind") == 0
    level1_aggs = [F.sum("_w").alias("_n")]
    level1_aggs += [F.min(F.when(first, F.col(a))).alias(a) for a in carried if a.startswith("_min")]
    level1_aggs += [F.max(F.when(first, F.col(a))).alias(a) for a in carried if a.startswith("_max")]
    level1 = expanded.groupBy(*keys, "kind", "key").agg(*level1_aggs)

    kind, key, n = F.col("kind"), F.col("key"), F.col("_n")
    level2 = []
    for i, (what, out, _) in enumerate(kinds):
        if what == "map":
            entry = map_entry(key, n, null_key)
            level2.append(F.map_from_entries(F.collect_list(F.when(kind == i, entry))).alias(out))
        else:
            level2.append(F.count(F.when((kind == i) & key.isNotNull(), F.lit(1))).alias(out))
    if row_count:
        level2.append(F.sum(F.when(kind == 0, n)).alias(row_count))
    level2 += [F.min(f"_min{i}").alias(out) for i, out in enumerate(mins)]
    level2 += [F.max(f"_max{i}").alias(out) for i, out in enumerate(maxs)]
    return level1.groupBy(*keys).agg(*level2)


def row_rollup(df: DataFrame, keys: Sequence[str], *, maps: Mapping[str, str], distinct_counts: Mapping[str, str],
               row_count: str, weight: str | None = None, mins: Mapping[str, str] | None = None,
               maxs: Mapping[str, str] | None = None, null_key: str = "drop") -> DataFrame:
    """``kind_rollup`` for groups of few rows: a group's rows meet in one row and are counted there.

    Each input row is sorted once and nothing is expanded, so a task holds its own rows and no (kind, key) rows
    of them. What is collected is the group, so the caller bounds its rows."""
    kinds = {**dict(maps), **dict(distinct_counts)}
    w = F.col(weight) if weight else F.lit(1).cast("bigint")
    fields = [(null_key_expr(c, null_key) if out in maps else F.col(c).cast("string")).alias(f"k{i}") for i, (out, c) in enumerate(kinds.items())]
    group = df.groupBy(*keys).agg(
        F.collect_list(F.struct(*fields, w.alias("w"))).alias("_rows"), F.sum(w).alias(row_count),
        *[F.min(c).alias(out) for out, c in dict(mins or {}).items()], *[F.max(c).alias(out) for out, c in dict(maxs or {}).items()])
    rows = F.col("_rows")

    def values(k: str, no_null: bool) -> Column:
        found = F.array_distinct(F.transform(rows, lambda r: r[k]))
        return F.array_compact(found) if no_null else found

    def counted(k: str) -> Column:
        return F.map_from_entries(F.transform(values(k, null_key == "drop"), lambda v: F.struct(
            v.alias("key"), F.aggregate(rows, F.lit(0).cast("bigint"), lambda n, r: F.when(r[k].eqNullSafe(v), n + r["w"]).otherwise(n)).alias("value"))))

    out = [(counted(f"k{i}") if out in maps else F.size(values(f"k{i}", True)).cast("bigint")).alias(out) for i, out in enumerate(kinds)]
    return group.select(*keys, *out, row_count, *dict(mins or {}), *dict(maxs or {}))


def fold_parts(parts: DataFrame, keys: Sequence[str], *, maps: Sequence[str], sums: Sequence[str] = (),
               mins: Sequence[str] = (), maxs: Sequence[str] = (), distinct: Mapping[str, str] | None = None) -> DataFrame:
    """Roll-ups of disjoint parts of each group -> one row per ``keys``: maps are summed key by key, ``sums`` added,
    ``mins`` and ``maxs`` taken; ``distinct`` {out: map column} counts the keys of a map summed likewise.

    Entries are counted per (keys, kind, key) before they meet, so a group of many parts is spread."""
    keys, kinds = list(keys), [*maps, *dict(distinct or {}).values()]
    measures = [*sums, *mins, *maxs]
    none = [F.lit(None).cast(parts.schema[c].dataType).alias(c) for c in measures]
    own = F.array(F.struct(F.lit(-1).alias("kind"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("bigint").alias("_n"),
                           *[F.col(c) for c in measures]))

    def entries(k: int, c: str) -> Column:
        return F.coalesce(F.transform(F.map_entries(F.col(c).cast("map<string,bigint>")), lambda e: F.struct(
            F.lit(k).alias("kind"), e["key"].alias("key"), e["value"].alias("_n"), *none)), F.array())

    rows = parts.select(*keys, F.inline(F.concat(own, *[entries(k, c) for k, c in enumerate(kinds)])))
    level1 = rows.groupBy(*keys, "kind", "key").agg(
        F.sum("_n").alias("_n"), *[F.sum(c).alias(c) for c in sums], *[F.min(c).alias(c) for c in mins],
        *[F.max(c).alias(c) for c in maxs])
    kind = F.col("kind")
    folded = [F.map_from_entries(F.collect_list(F.when(kind == k, F.struct(F.col("key"), F.col("_n").alias("value"))))).alias(c)
              for k, c in enumerate(maps)]
    folded += [F.count(F.when(kind == len(maps) + k, F.lit(1))).alias(out) for k, out in enumerate(distinct or {})]
    folded += [F.sum(c).alias(c) for c in sums] + [F.min(c).alias(c) for c in mins] + [F.max(c).alias(c) for c in maxs]
    return level1.groupBy(*keys).agg(*folded)
