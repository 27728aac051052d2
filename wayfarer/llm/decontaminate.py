"""Benchmark decontamination with a distributed positional inverted index.

The index stores a posting (term, document, position) for each occurrence of a term that some
benchmark item uses, sorted within its files by document. A window of an item is looked up from its
rarest term: the term's postings, moved back by its offset in the window, are the possible starts;
they are intersected with the moved postings of the second rarest term, at most ``slop`` positions
off for proximity matches. The words of what is left are compared with the document, which confirms
exact phrase matches. Only candidates are ever shuffled by position, so a stop word's long posting
list is read but never moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfarer.llm.common import LOWER, NON_WORD_RUN, UPPER, stored

WINDOW = 10
_END = "\x00end"  # not a word: its posting's position is the number of words


def words(text: str | Column) -> Column:
    """The words of a text, A-Z lower-cased; none for NULL. The Unicode-wide ``lower`` is only
    used where it cannot change anything but A-Z."""
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    low = F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))
    return F.array_remove(F.split(low, NON_WORD_RUN), "")


def item_windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Stored (item, window, _wid): each run of ``window`` words of an item as an array, once for each
    item; an item of fewer words is one window; without words it has none. Equal windows share a number."""
    w = items.select(F.col(id_col).alias("item"), words(text_col).alias("_w")).where(F.size("_w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_w") - window + 1, F.lit(1)))
    found = stored(w.select("item", F.explode(F.transform(starts, lambda i: F.slice("_w", i, window))).alias("window"))
                   .distinct(), "item-windows")
    numbers = stored(found.select("window").distinct().withColumn("_wid", F.monotonically_increasing_id()), "windows")
    return stored(found.join(numbers, "window").select("item", "window", "_wid"), "numbered-windows")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_key"), F.col(text_col).alias("_text"))


def build_index(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored postings (_term, _id, _key, _pos) of all documents for the terms of ``windows``; the
    one of the end mark tells a document's number of words. A row is known by its id and its text's
    hash. The terms are matched while the texts are scanned, without a shuffle when Spark finds the
    term list small enough to broadcast."""
    terms = windows.select(F.explode("window").alias("_term")).distinct()
    spark = docs.sparkSession
    terms = stored(terms.unionByName(spark.range(1).select(F.lit(_END).alias("_term"))), "test-terms")
    tokens = _texts(docs, id_col, text_col).select(
        "_id", "_key", F.posexplode(F.concat(words("_text"), F.array(F.lit(_END)))).alias("_pos", "_term"))
    return stored(tokens.join(terms, "_term").select("_term", "_id", "_key", "_pos"), "postings")


def _rarest(windows: DataFrame, index: DataFrame) -> DataFrame:
    """Distinct windows all of whose terms occur in the corpus: _wid, and the offset and term of the
    rarest (_off, _term) and the second rarest place (_off2, _term2, NULL in a window of one word)."""
    freq = index.where(F.col("_term") != _END).groupBy("_term").agg(F.count(F.lit(1)).alias("_n"))
    places = windows.select("_wid", F.size("window").alias("_size"), "window").distinct().select(
        "_wid", "_size", F.posexplode("window").alias("_off", "_term"))
    rare = F.array_sort(F.collect_list(F.struct("_n", "_off", "_term")))  # the places of one window
    look = places.join(freq, "_term").groupBy("_wid", "_size").agg(rare.alias("_rare")).where(F.size("_rare") == F.col("_size"))
    one, two = F.col("_rare")[0], F.try_element_at("_rare", F.lit(2))
    return look.select("_wid", one["_off"].alias("_off"), one["_term"].alias("_term"),
                       two["_off"].alias("_off2"), two["_term"].alias("_term2"))


def find_windows(index: DataFrame, windows: DataFrame, slop: int = 0) -> DataFrame:
    """Candidates (_id, _key, _wid, _start): documents in which the rarest term of a window stands
    where it should and the second rarest at most ``slop`` words from its place. All exact phrase
    matches are among them."""
    look = stored(_rarest(windows, index), "rarest-terms")
    postings = index.where(F.col("_term") != _END)
    starts = (postings.join(look, "_term")
              .select("_id", "_key", "_wid", "_off2", "_term2", (F.col("_pos") - F.col("_off")).alias("_start"))
              .where("_start >= 0"))
    single = starts.where(F.col("_term2").isNull()).select("_id", "_key", "_wid", "_start")
    wanted = starts.where(F.col("_term2").isNotNull()).withColumn(
        "_shift", F.explode(F.sequence(F.lit(-slop), F.lit(slop)))).withColumn(
        "_at", F.col("_start") + F.col("_off2") + F.col("_shift"))
    second = postings.join(look.select(F.col("_term2").alias("_term")).distinct(), "_term", "left_semi").select(
        F.col("_term").alias("_t"), F.col("_id").alias("_i"), F.col("_key").alias("_k"), F.col("_pos").alias("_p"))
    both = wanted.join(second, (F.col("_term2") == F.col("_t")) & F.col("_id").eqNullSafe(F.col("_i"))
                       & (F.col("_key") == F.col("_k")) & (F.col("_at") == F.col("_p")))
    return single.unionByName(both.select("_id", "_key", "_wid", "_start"))


def confirm(docs: DataFrame, found: DataFrame, windows: DataFrame, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(_id, _key, _hits): of each document with candidates its distinct (wid, start, size, exact): exact
    when the words there are the window's. One list a document, bounded by its own length."""
    found = found.distinct().join(windows.select("_wid", "window").distinct(), "_wid")
    per_doc = (found.groupBy("_id", "_key").agg(F.collect_list(F.struct("_wid", "_start", "window")).alias("_found"))
               .withColumnsRenamed({"_id": "_cid", "_key": "_ckey"}))
    texts = _texts(docs, id_col, text_col).where(F.col("_text").isNotNull())
    both = texts.join(per_doc, F.col("_id").eqNullSafe(F.col("_cid")) & (F.col("_key") == F.col("_ckey")))
    # two mentions of _w in the lambda: Spark then keeps it as a column, worked out once for a document,
    # instead of writing its expression into the lambda, once for each candidate
    hits = F.transform("_found", lambda c: F.struct(
        c["_wid"].alias("_wid"), c["_start"].alias("start"), F.size(c["window"]).alias("size"),
        ((c["_start"] + F.size(c["window"]) <= F.size("_w"))
         & (F.slice("_w", c["_start"] + 1, F.size(c["window"])) == c["window"])).alias("exact")))
    return both.withColumn("_w", words("_text")).select("_id", "_key", hits.alias("_hits"))


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 2, id_col: str = "doc_id",
            text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Phrase and proximity matches: ``id_col``, item, window (its words), start, kind (``phrase``, or
    ``proximity`` when only the two rarest terms stand within ``slop`` words of their places)."""
    windows = item_windows(items, window, item_id, item_text)
    found = find_windows(build_index(docs, windows, id_col, text_col), windows, slop)
    hits = confirm(docs, found, windows, id_col, text_col).select("_id", "_key", F.inline("_hits")).distinct()
    return hits.join(windows, "_wid").select(
        F.col("_id").alias(id_col), "item", F.array_join("window", " ").alias("window"), "start",
        F.when(F.col("exact"), "phrase").otherwise("proximity").alias("kind"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_words, n_hit (words inside any occurrence of a window),
    n_items (items with occurring windows), items_sha256 (their ids sorted as strings), contaminated.

    NULL texts have no words and items without words no windows. Items that repeat a text are all
    named; words that only an item without an id contains are hit, but it is not named. Rows that repeat an id and a text give the same result each; rows that share only an id
    are judged by their own text. Empty tables give no rows, or no hits. Other columns are not read.
    """
    out = _judged(docs, items, window, id_col, text_col, item_id, item_text)
    return out.select(F.col("_id").alias(id_col), "n_words", F.coalesce("_n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce(F.size("_items"), F.lit(0)).cast("long").alias("n_items"),
                      F.sha2(F.coalesce(F.array_join("_items", ","), F.lit("")), 256).alias("items_sha256"),
                      F.col("_n_hit").isNotNull().alias("contaminated"))


def _judged(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
            item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(_id, _key, n_words, _n_hit, _items): one row per row of ``docs``; _n_hit is NULL without a hit."""
    windows = item_windows(items, window, item_id, item_text)
    index = build_index(docs, windows, id_col, text_col)
    hits = stored(confirm(docs, find_windows(index, windows), windows, id_col, text_col)
                  .select("_id", "_key", F.filter("_hits", lambda h: h["exact"]).alias("_hits"))
                  .where(F.size("_hits") > 0).dropDuplicates(["_id", "_key"]), "phrase-hits")
    covered = F.array_distinct(F.flatten(F.transform("_hits", lambda h: F.sequence(
        h["start"], h["start"] + h["size"] - 1))))
    n_hit = hits.select("_id", "_key", F.size(covered).cast("long").alias("_n_hit"))
    named = (hits.select("_id", "_key", F.explode(F.array_distinct(F.transform("_hits", lambda h: h["_wid"]))).alias("_wid"))
             .join(windows.select("_wid", F.col("item").cast("string").alias("item")), "_wid")
             .groupBy("_id", "_key").agg(F.array_sort(F.collect_set("item")).alias("_items")))
    named = named.withColumnsRenamed({"_id": "_iid", "_key": "_ikey"})
    flagged = n_hit.join(named, F.col("_id").eqNullSafe(F.col("_iid")) & (F.col("_key") == F.col("_ikey")), "left")
    flagged = flagged.select(F.col("_id").alias("_fid"), F.col("_key").alias("_fkey"), "_n_hit",
                             F.coalesce("_items", F.array().cast("array<string>")).alias("_items"))
    rows = index.where(F.col("_term") == _END).select("_id", "_key", F.col("_pos").cast("long").alias("n_words"))
    return rows.join(flagged, F.col("_id").eqNullSafe(F.col("_fid")) & (F.col("_key") == F.col("_fkey")), "left")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """``docs`` without the contaminated rows: those that have a contaminated row's id and text."""
    bad = _judged(docs, items, id_col=id_col, text_col=text_col, **options).where(F.col("_n_hit").isNotNull())
    bad = bad.select(F.col("_id").alias("_bad"), F.col("_key").alias("_badkey")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad["_bad"]) & (F.xxhash64(docs[text_col]) == bad["_badkey"]), "left_anti")


# DuckDB: windows as joined text, matched by a plain equality join of all word runs.
ORACLE_SQL = r"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id,
                   list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
iw AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS k
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM win),
runs AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
         FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lengths WHERE len(w) >= n)),
hit AS (SELECT r, i, runs.n, item_id FROM runs JOIN win ON runs.k = win.k AND runs.n = win.n),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s
        FROM hit GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM dw LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""
