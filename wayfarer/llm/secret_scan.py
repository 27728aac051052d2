"""Secret scan over a trigram inverted index.

Each rule's regex gives a Boolean query over the trigrams every match must contain. The index
stores, for each trigram that some query names, the documents that hold it (ASCII case folded);
intersecting its posting lists gives a rule's candidates, and only those are matched with the
regex. A rule without mandatory trigrams scans every document. Match positions come from the text
between matches: a window sums the lengths before each one, so nothing but built-in functions runs.
"""

from __future__ import annotations

import re._constants as rc
import re._parser as rp
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.llm.common import stored, text_or_empty
from wayfarer.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """A match of ``pattern`` counts when its ``group`` has ``min_length`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    min_length: int = 1


# The kinds of the result contract, in their order. For a run of one character class
# a minimum length within the pattern finds the same matches as dropping short runs afterwards.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}"),
)

MOST_STRINGS = 32  # alternatives of a literal kept while a query is derived
SPREAD = 32  # tasks that a trigram's posting list is dealt over
ALL = ("all",)  # the query that every document fulfils


def _both(a: tuple, b: tuple) -> tuple:
    return b if a == ALL else a if b == ALL or a == b else ("and", a, b)


def _either(queries: list[tuple]) -> tuple:
    unique = list(dict.fromkeys(queries))
    if not unique or ALL in unique:
        return ALL
    return unique[0] if len(unique) == 1 else ("or", *unique)


def _of_strings(strings: Iterable[str]) -> tuple:
    """Some one of the strings occurs: each needs all its trigrams."""
    options = []
    for s in sorted(strings):
        query = ALL
        for g in dict.fromkeys(s[i: i + 3] for i in range(len(s) - 2)):
            query = _both(query, ("tri", g))
        options.append(query)
    return _either(options)


def _walk(items) -> tuple[set[str] | None, tuple]:
    """(all strings that a match can be, or None when unknown; query) of a parsed sequence."""
    query, strings, exact = ALL, {""}, True
    for op, arg in items:
        part, inner = None, ALL
        if op is rc.LITERAL:
            part = {chr(arg).lower()}
        elif op is rc.IN and all(o is rc.LITERAL for o, _ in arg):
            part = {chr(a).lower() for _, a in arg}
        elif op is rc.SUBPATTERN:
            part, inner = _walk(arg[-1])
        elif op is rc.BRANCH:
            each = [_walk(branch) for branch in arg[1]]
            if all(s is not None for s, _ in each):
                part = set().union(*(s for s, _ in each))
            else:
                inner = _either([_both(_of_strings(s), q) if s is not None else q for s, q in each])
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
            low, high, sub = arg
            strings_of, query_of = _walk(sub)
            if (low, high) == (0, 1) and strings_of is not None and min(map(len, strings)) < 3:
                part = strings_of | {""}
            elif low >= 1:
                inner = _both(_of_strings(strings_of), query_of) if strings_of is not None else query_of
        elif op is rc.AT:
            part = {""}
        if part is not None and len(strings) * len(part) <= MOST_STRINGS:
            strings = {s + p for s in strings for p in part}
            query = _both(query, inner)
        else:  # what stands before and after an unknown part is mandatory separately
            query = _both(query, _both(_of_strings(strings), inner if part is None else _both(inner, _of_strings(part))))
            strings, exact = {""}, False
    return (strings, query) if exact else (None, _both(query, _of_strings(strings)))


def trigram_query(pattern: str) -> tuple:
    """Boolean query over lower-case trigrams that every text with a match of ``pattern`` fulfils."""
    strings, query = _walk(rp.parse(pattern))
    return query if strings is None else _both(query, _of_strings(strings))


def trigrams_of(query: tuple) -> set[str]:
    if query[0] == "tri":
        return {query[1]}
    return set().union(*(trigrams_of(q) for q in query[1:])) if query != ALL else set()


def _fulfils(query: tuple, number: dict[str, int], found: Column) -> Column:
    if query[0] == "tri":
        return F.array_contains(found, number[query[1]])
    parts = [_fulfils(q, number, found) for q in query[1:]]
    out = parts[0]
    for p in parts[1:]:
        out = out & p if query[0] == "and" else out | p
    return out


def write_index(docs: DataFrame, trigrams: list[str], path: str) -> None:
    """Postings (_tri, _id, _key) under ``path``, one folder for each trigram. A trigram's list is dealt
    over ``SPREAD`` tasks by the key, so no task holds the whole list of a common one."""
    # ``lower`` folds more than ASCII: a superset, verified later. It is a column of its own, as within
    # the array it would be repeated for each trigram
    low = docs.select("_id", "_key", F.lower("_text").alias("_low"))
    found = F.array_compact(F.array(*[F.when(F.col("_low").contains(g), F.lit(i)) for i, g in enumerate(trigrams)]))
    postings = low.select("_id", "_key", F.explode(found).alias("_tri"))
    postings.repartition("_tri", F.pmod("_key", F.lit(SPREAD))).write.partitionBy("_tri").parquet(path)


def candidates(index: DataFrame, queries: dict[int, tuple], trigrams: list[str]) -> DataFrame:
    """(_id, _key, _rules): the documents whose postings fulfil some rule's query."""
    number = {g: i for i, g in enumerate(trigrams)}
    found = index.groupBy("_id", "_key").agg(F.collect_set("_tri").alias("_found"))  # at most one of each trigram
    rules = F.array_compact(F.array(*[F.when(_fulfils(q, number, F.col("_found")), F.lit(r))
                                      for r, q in queries.items()]))
    return found.select("_id", "_key", rules.alias("_rules")).where(F.size("_rules") > 0)


def _matches(rule: Rule, number: int) -> Column:
    """Every match of a rule in ``_text``, dropped ones too: rule, place among them, characters
    between it and the one before, its length, whether it counts."""
    gaps = F.transform(F.split("_text", rule.pattern, -1), F.length)
    lengths = F.transform(F.regexp_extract_all("_text", F.lit(rule.pattern), F.lit(0)), F.length)
    groups = F.transform(F.regexp_extract_all("_text", F.lit(rule.pattern), F.lit(rule.group)), F.length)
    return F.transform(F.arrays_zip(gaps.alias("gap"), lengths.alias("len"), groups.alias("of")), lambda m, i: F.struct(
        F.lit(number).alias("rule"), i.alias("place"), m["gap"].alias("gap"), m["len"].alias("length"),
        (m["of"] >= rule.min_length).alias("counts")))


_NO_MATCH = "array<struct<rule:int,place:int,gap:int,length:int,counts:boolean>>"


def _scan(rows: DataFrame, rules: dict[int, Rule], applies) -> DataFrame:
    arrays = [F.when(applies(r), F.filter(_matches(rule, r), lambda m: m["length"].isNotNull()))
              .otherwise(F.array().cast(_NO_MATCH)) for r, rule in rules.items()]
    return rows.select("_id", "_key", F.inline(F.flatten(F.array(*arrays)).cast(_NO_MATCH)))


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, spans): the key (_id, _key) of each row of ``docs``, and the spans found by key:
    _rule (its number), _start, _end in code points. Rows equal in id and text share one key, and
    its spans are listed once."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    texts = texts.withColumn("_key", F.xxhash64("_text"))
    queries = {r: trigram_query(rule.pattern) for r, rule in enumerate(rules)}
    indexed = {r: q for r, q in queries.items() if q != ALL}
    found = None
    if indexed:
        trigrams = sorted(set().union(*map(trigrams_of, indexed.values())))
        path = scratch_path(spark, "trigram-index")
        write_index(texts, trigrams, path)
        index = spark.read.schema("_id " + docs.schema[id_col].dataType.simpleString() + ", _key long, _tri int").parquet(path)
        # stored, so that Spark knows how few they are: it then broadcasts them, or filters the texts by them
        keys = stored(candidates(index, indexed, trigrams), "candidates").withColumnsRenamed({"_id": "_cid", "_key": "_ckey"})
        rows = texts.join(keys, F.col("_id").eqNullSafe(F.col("_cid")) & (F.col("_key") == F.col("_ckey")))
        found = _scan(rows, {r: rules[r] for r in indexed},
                      lambda r: F.array_contains("_rules", r))
    plain = {r: rule for r, rule in enumerate(rules) if r not in indexed}
    if plain:
        some = reduce(or_, [F.col("_text").rlike(rule.pattern) for rule in plain.values()])
        full = _scan(texts.where(some), plain, lambda r: F.lit(True))
        found = full if found is None else found.unionByName(full)
    found = found.distinct()  # rows that repeat a text and its id
    before = Window.partitionBy("_id", "_key", "rule").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("length")).over(before)
    spans = (found.withColumn("_end", end).where("counts")
             .select("_id", "_key", F.col("rule").alias("_rule"), (F.col("_end") - F.col("length")).alias("_start"), "_end"))
    return texts.select("_id", "_key"), spans


def secret_scan(docs: DataFrame, more: tuple[Rule, ...] = MORE_RULES, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_assign, n_access, n_hex, base_sha256 (of the base
    kinds' ``kind:start:end``) and spans (all kinds, the same form).

    NULL counts as empty and holds no secret. Rows that repeat an id and a text give the same result
    each; rows that share an id only are judged by their own text. A document's matches are ordered
    in one window, bounded by its own length. An empty table gives an empty result. Other columns
    are not read.
    """
    rules = BASE_RULES + tuple(more)
    base = len(BASE_RULES)
    rows, spans = find_secrets(docs, rules, id_col, text_col)
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    counts = [F.count_if(F.col("_rule") == r).alias(f"n_{rules[r].kind}") for r in range(base)]
    per_doc = spans.groupBy("_id", "_key").agg(
        *counts, F.array_sort(F.collect_list(F.struct("_start", "_rule", "_end"))).alias("_spans"))

    def listed(c: Column) -> Column:
        return F.array_join(F.transform(c, lambda s: F.concat_ws(
            ":", F.element_at(kinds, s["_rule"] + 1), s["_start"].cast("string"), s["_end"].cast("string"))), ",")

    base_spans = listed(F.filter("_spans", lambda s: s["_rule"] < base))
    per_doc = per_doc.select(F.col("_id").alias("_sid"), F.col("_key").alias("_skey"),
                             *[f"n_{r.kind}" for r in BASE_RULES], F.sha2(base_spans, 256).alias("_sha"),
                             listed(F.col("_spans")).alias("_list"))
    out = rows.join(per_doc, F.col("_id").eqNullSafe(F.col("_sid")) & (F.col("_key") == F.col("_skey")), "left")
    return out.select(F.col("_id").alias(id_col),
                      *[F.coalesce(f"n_{r.kind}", F.lit(0)).cast("long").alias(f"n_{r.kind}") for r in BASE_RULES],
                      F.coalesce("_sha", F.sha2(F.lit(""), 256)).alias("base_sha256"),
                      F.coalesce("_list", F.lit("")).alias("spans"))


def _oracle() -> str:
    """DuckDB: every rule on every row, positions by a running sum over the pieces."""
    parts = []
    for r, rule in enumerate(BASE_RULES + MORE_RULES):
        p = rule.pattern.replace("'", "''")
        parts.append(f"""
        SELECT row, {r} AS r, '{rule.kind}' AS kind, unnest(range(len(h))) AS place, unnest(list_transform(g[1:len(h)], lambda x: length(x))) AS gap,
               unnest(list_transform(h, lambda x: length(x))) AS len,
               unnest(list_transform(f, lambda x: length(x) >= {rule.min_length})) AS counts
        FROM (SELECT row, string_split_regex(text, '{p}') AS g, regexp_extract_all(text, '{p}', 0) AS h,
                     regexp_extract_all(text, '{p}', {rule.group}) AS f FROM d WHERE regexp_matches(text, '{p}'))""")
    base = ", ".join(f"'{r.kind}'" for r in BASE_RULES)
    return f"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
    m AS ({" UNION ALL ".join(parts)}),
    s AS (SELECT row, r, kind, counts, len, sum(gap + len) OVER (PARTITION BY row, r ORDER BY place)::BIGINT AS e FROM m),
    a AS (SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                 count(*) FILTER (kind = 'hex') AS n_hex,
                 string_agg(kind || ':' || (e - len) || ':' || e, ',' ORDER BY e - len, r) FILTER (kind IN ({base})) AS b,
                 string_agg(kind || ':' || (e - len) || ':' || e, ',' ORDER BY e - len, r) AS spans
          FROM s WHERE counts GROUP BY row)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN a USING (row)"""


ORACLE_SQL = _oracle()
