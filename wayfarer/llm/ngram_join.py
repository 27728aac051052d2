"""Near-duplicate join: Jaccard similarity of word shingles by prefix filters under several orders.

A document's set is its distinct five-word shingles, as 64-bit hashes. Two sets with similarity of
0.75 or more miss at most a quarter of each other's shingles, so under any one global order of the
shingles they share one among the first quarter plus one of each; among a longer prefix they share
accordingly more. Equal sets are one class from the start. Then

1. first order (by hash): of a prefix of half the set, 3/16 of the set must occur in other classes'
   prefixes (a quarter of the smaller set, which has at least 3/4 of the shingles). Shingles travel as packed 32-bit fingerprints and are counted by bucket; one
   batch sends a shingle that several of its documents share once. Most documents end here.
2. the survivors' shingles get their document frequencies, and each class its prefix under three
   orders that put rare shingles first and break ties differently.
3. classes are merged along few verified links, found by min-hash stars around the most central class,
   so that a large group of near copies becomes one component without all its pairs.
4. candidates are then only pairs between different components that share prefix shingles under all
   three orders and whose sizes leave room for a link; each is verified by its sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfarer.llm.common import LOWER, UPPER, stored
from wayfarer.llm.token_binary import RangeHash

SHINGLE = 5
BUCKET_SHINGLES = 1_000_000  # fingerprints counted together
FLUSH_SHINGLES = 500_000  # fingerprints a task holds before it sends them on
STARS = 6  # min-hash orders of the merging step
ORDERS = 3

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_HASH = RangeHash(41)


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """Each text's distinct shingle hashes in ascending order. With fewer words than ``size`` the whole
    sequence is one; without words the set is empty. Words are parted by ASCII white space, A-Z folded."""
    rows = [b" ".join((t or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()) for t in texts]
    raw = np.frombuffer(b"\n".join(rows) + b"\n", "u1")
    stops = np.flatnonzero((raw == 32) | (raw == 10))  # ends of words
    starts = np.append(0, stops[:-1] + 1)
    ends_text = raw[stops] == 10
    of = np.cumsum(ends_text) - ends_text  # each word's text
    seen = stops > starts
    starts, stops, of = starts[seen], stops[seen], of[seen]
    words = np.bincount(of, minlength=len(rows))
    after = np.cumsum(words)  # first word behind each text
    at = np.arange(len(of))
    first, last = (after - words)[of], after[of] - 1
    keep = (at + size - 1 <= last) | (at == first)
    end = np.minimum(at + size - 1, last)[keep]
    h = _mix(_HASH(raw, starts[keep], stops[end]))
    cuts = np.searchsorted(of[keep], np.arange(len(rows) + 1))
    return [np.unique(h[a:b]) for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]


def _slices(texts: list[str | None], size: int = 1 << 19) -> Iterator[tuple[int, int]]:
    start = total = 0
    for k, t in enumerate(texts):
        total += len(t or "")
        if total >= size:
            yield start, k + 1
            start, total = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(hashes.tobytes())


def may_miss(n: int) -> int:
    """Shingles of a set of ``n`` that a similar set may lack: a quarter."""
    return n // 4


def long_prefix(n: int) -> int:
    """Length of the first order's prefix: half the set, more than may miss."""
    return max(may_miss(n) + 1, -(-n // 2)) if n else 0


def describe(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(_id, _key, _n, _set): hash of the text, size and 128-bit digest of each row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            sets = [(len(s), _digest(s)) for a, b in _slices(texts) for s in shingle_sets(texts[a:b], size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_key"), pa.array([n for n, _ in sets], pa.int64()),
                 pa.array([d for _, d in sets], pa.binary())], names=["_id", "_key", "_n", "_set"])

    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_key"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, _key long, _n long, _set binary")


_PACK = "bucket int, batch string, sets binary, lengths binary, known binary, prints binary, shared binary"


def _pack(sets: list[bytes], heads: list[np.ndarray], buckets: int) -> pd.DataFrame:
    """One row for each bucket: the batch's sets with shingles in it (16 bytes each); of each the number
    of fingerprints sent and of those known to be shared within the batch; the fingerprints; and the
    shared ones once."""
    of = np.repeat(np.arange(len(heads)), [len(x) for x in heads])
    h = np.concatenate(heads)
    bucket = ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(buckets)
    key = (bucket << np.uint64(32)) | ((h * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(32))
    order = np.argsort(key, kind="stable")  # rows of one key stay in the order of their sets
    key, of = key[order], of[order]
    same = key[1:] == key[:-1]
    shared = np.zeros(len(key), bool)
    shared[1:] |= same
    shared[:-1] |= same
    digests = np.frombuffer(b"".join(sets), "V16")
    cuts = np.searchsorted(key >> np.uint64(32), np.arange(buckets + 1, dtype="u8"))
    rows = []
    for b in range(buckets):
        part = slice(cuts[b], cuts[b + 1])
        if cuts[b] == cuts[b + 1]:
            continue
        who, prints, common = of[part], (key[part] & np.uint64(0xFFFFFFFF)).astype("u4"), shared[part]
        there, where = np.unique(who, return_inverse=True)
        known = np.bincount(where, weights=common, minlength=len(there)).astype("u4")
        by_set = np.argsort(where[~common], kind="stable")
        rows.append((b, digests[there].tobytes(), np.bincount(where[~common], minlength=len(there)).astype("u4").tobytes(),
                     known.tobytes(), prints[~common][by_set].tobytes(), np.unique(prints[common]).tobytes()))
    return pd.DataFrame(rows, columns=["bucket", "sets", "lengths", "known", "prints", "shared"])


def _count_shared(group: pd.DataFrame) -> pd.DataFrame:
    """For each batch with shingles in a bucket, of each of its sets the number of these that another
    set has too: one packed row, so the rows are the packs and not sets times buckets."""
    digests = np.frombuffer(b"".join(group["sets"]), "V16")
    lengths = np.frombuffer(b"".join(group["lengths"]), "u4").astype("i8")
    known = np.frombuffer(b"".join(group["known"]), "u4").astype("i8")
    prints = np.frombuffer(b"".join(group["prints"]), "u4")
    shared = np.unique(np.frombuffer(b"".join(group["shared"]), "u4"))
    names, number = np.unique(digests, return_inverse=True)  # copies in several batches are one set
    row = np.repeat(np.arange(len(digests)), lengths)
    pair = np.unique((prints.astype("u8") << np.uint64(32)) | number[row].astype("u8"))
    values, times = np.unique(pair >> np.uint64(32), return_counts=True)
    common = np.union1d(values[times > 1].astype("u4"), shared)
    hit = np.isin(prints, common)
    total = (known + np.bincount(row, weights=hit, minlength=len(digests))).astype("u4")
    ends = np.cumsum([len(x) // 16 for x in group["sets"]])
    rows = []
    for batch, stop, n in zip(group["batch"], ends.tolist(), np.diff(ends, prepend=0).tolist(), strict=True):
        part = slice(stop - n, stop)
        some = total[part] > 0
        rows.append((batch, digests[part][some].tobytes(), total[part][some].tobytes()))
    return pd.DataFrame(rows, columns=["batch", "sets", "counts"])


def _sum_batch(group: pd.DataFrame) -> pd.DataFrame:
    """The counts of a batch's sets over all buckets; a batch holds a set once."""
    names, number = np.unique(np.frombuffer(b"".join(group["sets"]), "V16"), return_inverse=True)
    counts = np.frombuffer(b"".join(group["counts"]), "u4")
    return pd.DataFrame({"_set": [x.tobytes() for x in names],
                         "_shared": np.bincount(number, weights=counts, minlength=len(names)).astype("i8")})


def shared_in_prefix(docs: DataFrame, text_col: str, size: int, buckets: int) -> DataFrame:
    """(_set, _shared): how many shingles of a set's long prefix occur in another set's. Sets without any
    are absent. Equal fingerprints of different shingles can only make the number too large."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("batch", pa.string()),
                            *[(c, pa.binary()) for c in ("sets", "lengths", "known", "prints", "shared")]])
        part, number = TaskContext.get().partitionId(), 0
        held: dict[bytes, np.ndarray] = {}
        count = 0

        def packed() -> pa.RecordBatch:
            rows = _pack(list(held), list(held.values()), buckets)
            rows.insert(1, "batch", f"{part}-{number}")
            return pa.RecordBatch.from_pandas(rows, schema, preserve_index=False)

        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for a, b in _slices(texts):
                for s in shingle_sets(texts[a:b], size):
                    if len(s) and (d := _digest(s)) not in held:
                        held[d] = s[: long_prefix(len(s))].copy()
                        count += len(held[d])
                if count >= FLUSH_SHINGLES:
                    yield packed()
                    number, held, count = number + 1, {}, 0
        if held:
            yield packed()

    packs = docs.select(F.col(text_col).alias("_text")).mapInArrow(send, _PACK)
    counted = packs.groupBy("bucket").applyInPandas(_count_shared, "batch string, sets binary, counts binary")
    found = counted.groupBy("batch").applyInPandas(_sum_batch, "_set binary, _shared long")
    return found.groupBy("_set").agg(F.max("_shared").alias("_shared"))  # copies in several batches count alike


def fetch_sets(docs: DataFrame, alive: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(_cls, _n, _tokens) of the classes ``alive`` (_set, _rep, _n, _cls): their representatives' texts
    are read again; a repeated id's other texts are told apart by their digests."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = rows.join(alive.select("_rep"), F.col("_id").eqNullSafe(F.col("_rep")), "left_semi").select("_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for a, b in _slices(texts):
                sets = [s for s in shingle_sets(texts[a:b], size) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(s) for s in sets], pa.binary()),
                     pa.array([s.view("i8") for s in sets], pa.list_(pa.int64()))], names=["_set", "_tokens"])

    found = rows.mapInArrow(run, "_set binary, _tokens array<long>")
    return found.join(alive.select("_set", "_cls", "_n"), "_set").select("_cls", "_n", "_tokens").dropDuplicates(["_cls"])


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Min-hash values and prefixes of each class. A shingle stands in a prefix as its rank under that
    order, a number of the shingle alone: the frequency above 43 bits of a hash. Shingles of equal rank
    can only add candidates."""
    for batch in batches:
        own = batch.column("_own")
        counts = np.diff(own.offsets.to_numpy())
        stops = np.cumsum(counts)
        flat = own.flatten()
        f, t = flat.field("_f").to_numpy().astype("u8"), flat.field("_t").to_numpy().view("u8")
        often, size = np.minimum(f, np.uint64((1 << 20) - 1)), np.floor(np.log2(f)).astype("u8")
        ranks = [(of << np.uint64(43)) | (_seeded(t, k) >> np.uint64(21)) for k, of in enumerate((often, often, size))]
        hashes = [_seeded(t, 100 + k) for k in range(STARS)]
        room, size_of = batch.column("_room").to_numpy(), batch.column("_n").to_numpy()
        parts = [slice(stop - n, stop) for n, stop in zip(counts.tolist(), stops.tolist(), strict=True)]
        arrays = [pa.array([[h[p].min().view("i8") for h in hashes] for p in parts], pa.list_(pa.int64()))]
        arrays += [pa.array([np.sort(r[p])[:k].view("i8") for p, k in zip(parts, room, strict=True)], pa.list_(pa.int64()))
                   for r in ranks]
        centre = [(f[p].sum() + n - len(f[p])) / n for p, n in zip(parts, size_of.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_cls"), batch.column("_n"), pa.array(counts, pa.int64()), pa.array(centre, pa.float64()), *arrays],
            names=["_cls", "_n", "_own", "_centre", "_stars", "_o1", "_o2", "_o3"])


def _seeded(t: np.ndarray, seed: int) -> np.ndarray:
    return _mix(t ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 1) & ((1 << 64) - 1)))


def prefixes(sets: DataFrame) -> DataFrame:
    """(_cls, _n, _own, _centre, _stars, _o1, _o2, _o3): the number of shared shingles, the mean
    frequency of the set's, min-hashes, and the shared shingles of the prefix under each
    order: (frequency, hash 1), (frequency, hash 2), (magnitude of the frequency, hash 3). All three
    put shingles of one class alone first. Classes with more of these than may miss have no partner
    and are left out."""
    posting = sets.select("_cls", "_n", F.explode("_tokens").alias("_t"))
    freq = posting.groupBy("_t").agg(F.count(F.lit(1)).alias("_f")).where("_f > 1")
    own = posting.join(freq, "_t").groupBy("_cls", "_n").agg(F.collect_list(F.struct("_f", "_t")).alias("_own"))  # a set
    room = F.floor(F.col("_n") / 4).cast("int") + 1 - (F.col("_n") - F.size("_own")).cast("int")
    own = own.withColumn("_room", room).where("_room > 0")
    return own.mapInArrow(_ranked, "_cls long, _n long, _own long, _centre double, _stars array<long>, _o1 array<long>, _o2 array<long>, _o3 array<long>")


def _may_link(a: str, own_a: str, b: str, own_b: str) -> Column:
    """Similarity of 0.75 needs 3/7 of both sizes together in common: no more than the smaller set, and
    no more than either set shares with any other."""
    return 7 * F.least(own_a, own_b) >= 3 * (F.col(a) + F.col(b))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (_a, _b) whose similarity is 0.75 or more."""
    left = pairs.join(sets.select(F.col("_cls").alias("_a"), F.col("_n").alias("_na"), F.col("_tokens").alias("_ta")), "_a")
    both = left.join(sets.select(F.col("_cls").alias("_b"), F.col("_n").alias("_nb"), F.col("_tokens").alias("_tb")), "_b")
    common = F.size(F.array_intersect("_ta", "_tb"))
    return both.where(100 * common >= 75 * (F.col("_na") + F.col("_nb") - common)).select("_a", "_b")


def star_pairs(prefix: DataFrame) -> DataFrame:
    """At most one pair (_a, _b) a class: with the most central class among those that have one of its
    min-hashes, the one met under most orders. Central is the class whose shingles are the most
    frequent: of a group of near copies the one nearest to what they are copies of."""
    mine = prefix.select("_cls", "_n", "_own", "_centre", F.posexplode("_stars").alias("_s", "_t"))
    heads = mine.groupBy("_s", "_t").agg(F.max(F.struct("_centre", (-F.col("_cls")).alias("_c"), "_n", "_own")).alias("_head"))
    met = mine.join(heads, ["_s", "_t"]).select(
        "_cls", "_n", "_own", (-F.col("_head")["_c"]).alias("_b"), F.col("_head")["_n"].alias("_nb"), F.col("_head")["_own"].alias("_ob"))
    met = met.where((F.col("_b") != F.col("_cls")) & _may_link("_n", "_own", "_nb", "_ob"))
    votes = met.groupBy("_cls", "_b").agg(F.count(F.lit(1)).alias("_v"))
    return votes.groupBy(F.col("_cls").alias("_a")).agg(F.max_by("_b", F.struct("_v", -F.col("_b"))).alias("_b"))


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(_cls, _comp): smallest class number reachable. Every round takes the smallest label around and
    then the label's own label; rounds grow with the logarithm of a chain's length."""
    links = stored(links.select("_a", "_b").unionByName(links.select(F.col("_b").alias("_a"), F.col("_a").alias("_b"))), "links")
    labels = stored(nodes.select("_cls", F.col("_cls").alias("_comp")), "labels")
    if links.isEmpty():
        return labels
    while True:
        around = links.join(labels.select(F.col("_cls").alias("_b"), "_comp"), "_b").groupBy(F.col("_a").alias("_cls")).agg(F.min("_comp").alias("_near"))
        near = stored(labels.join(around, "_cls", "left").select("_cls", "_comp", F.least("_comp", "_near").alias("_new")), "labels-near")
        jump = near.select(F.col("_cls").alias("_new"), F.col("_new").alias("_root"))
        labels = stored(near.join(jump, "_new").select("_cls", F.col("_root").alias("_comp"), (F.col("_root") < F.col("_comp")).alias("_moved")), "labels")
        if labels.where("_moved").isEmpty():
            return labels.select("_cls", "_comp")


def _open(postings: DataFrame) -> DataFrame:
    """The postings that can still bring a pair: of shingles whose classes are in several components, of
    classes with enough shingles from this one on (``_own``) for the smallest class it stands in."""
    span = postings.groupBy("_t").agg(F.min("_comp").alias("_low"), F.max("_comp").alias("_high"), F.min("_n").alias("_least"))
    fits = 3 * (F.col("_n") + F.col("_least")) <= 7 * F.col("_own")
    return postings.join(span.where("_low < _high").select("_t", "_least"), "_t").where(fits).drop("_least")


def candidate_pairs(prefix: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs (_a, _b) of classes in different components that share prefix shingles under every order.
    Shingles whose classes are all in one component bring none, nor does a shingle that stands too late
    in a set for the sizes at hand; of the others a class meets the components it is not in, and then
    their members with the shingle."""
    rows = prefix.join(comps, "_cls")
    # all that two sets have in common comes from their smallest common shingle on, in either set:
    # ``_own`` of a posting counts the shared shingles from it on
    first = rows.select("_cls", "_n", "_own", "_comp", F.posexplode("_o1").alias("_i", "_t"))
    first = first.withColumn("_own", F.col("_own") - F.col("_i")).drop("_i")
    first = stored(_open(stored(_open(first), "open-postings")), "open-postings")
    # the few meet the many: a class looks up the components with more classes of the shingle than its own
    # (ties by number), unless their smallest size or most shingles left rule out a link
    groups = first.groupBy("_t", "_comp").agg(F.count(F.lit(1)).alias("_m"), F.min("_n").alias("_gn"), F.max("_own").alias("_go"))
    others = groups.select(F.col("_t").alias("_to"), F.col("_comp").alias("_other"), F.col("_m").alias("_om"), "_gn", "_go")
    mine = first.join(groups.select("_t", "_comp", "_m"), ["_t", "_comp"])
    larger = F.struct("_m", "_comp") < F.struct("_om", "_other")
    meet = mine.join(others, (F.col("_t") == F.col("_to")) & larger & _may_link("_n", "_own", "_gn", "_go")).select(
        "_t", F.col("_cls").alias("_a"), F.col("_n").alias("_na"), F.col("_own").alias("_oa"), "_other")
    members = first.select(F.col("_t").alias("_tb"), F.col("_comp").alias("_cb"), F.col("_cls").alias("_b"),
                           F.col("_n").alias("_nb"), F.col("_own").alias("_ob"))
    pairs = meet.join(members, (F.col("_t") == F.col("_tb")) & (F.col("_other") == F.col("_cb")) & _may_link("_na", "_oa", "_nb", "_ob"))
    pairs = pairs.select("_a", "_b").distinct()
    a = prefix.select(F.col("_cls").alias("_a"), F.col("_o2").alias("_a2"), F.col("_o3").alias("_a3"))
    b = prefix.select(F.col("_cls").alias("_b"), F.col("_o2").alias("_b2"), F.col("_o3").alias("_b3"))
    both = pairs.join(a, "_a").join(b, "_b")
    return both.where(F.arrays_overlap("_a2", "_b2") & F.arrays_overlap("_a3", "_b3")).select("_a", "_b")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_shingles, component_id (smallest id reachable by links of
    similarity 0.75 or more, itself included).

    NULL, empty and blank texts have empty sets and are linked with nothing: their component is their own
    id. Equal sets are one class, whatever the number of rows. Rows without an id take part; a component
    without any id has a NULL component_id. Rows that repeat an id are told apart by their texts. An
    empty table gives an empty result. Other columns are not read. Sets are compared by 64-bit hashes.
    """
    out = _judged(docs, id_col, text_col, size)
    return out.select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"),
                      F.when(F.col("_n") == 0, F.col("_id")).otherwise(F.col("_component")).alias("component_id"))


def _judged(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE) -> DataFrame:
    """(_id, _key, _n, _component, _first): one row per row of ``docs``. _first is the (id, hash of the text)
    of the component's row that stands for it: the smallest, rows without an id last. NULL for an empty set."""
    rows = stored(describe(docs, id_col, text_col, size), "shingle-sets")
    first = F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_key")).alias("_first")
    classes = stored(rows.where("_n > 0").groupBy("_set").agg(F.min("_id").alias("_rep"), F.max("_n").alias("_n"), first), "set-classes")
    total = classes.agg(F.sum("_n")).first()[0] or 0
    buckets = max(1, -(-(total // 2) // BUCKET_SHINGLES))
    shared = shared_in_prefix(docs, text_col, size, buckets)
    alive = stored(classes.join(shared, "_set").where(16 * F.col("_shared") >= 3 * F.col("_n")).drop("_shared"), "alive")
    alive = stored(alive.withColumn("_cls", F.monotonically_increasing_id()), "alive-classes")
    sets = stored(fetch_sets(docs, alive, id_col, text_col, size), "alive-sets")
    prefix = stored(prefixes(sets), "prefixes")
    merged = stored(verified(star_pairs(prefix), sets), "star-links")
    comps = components(prefix.select("_cls"), merged)
    more = stored(verified(candidate_pairs(prefix, comps), sets), "prefix-links")
    if not more.isEmpty():
        comps = components(prefix.select("_cls"), merged.unionByName(more))
    named = alive.join(comps, "_cls")
    least = named.groupBy("_comp").agg(F.min("_rep").alias("_least"), F.min("_first").alias("_head"))
    of_set = named.join(least, "_comp").select("_set", "_least", "_head")
    ids = classes.join(of_set, "_set", "left").select("_set", F.coalesce("_least", "_rep").alias("_component"),
                                                      F.coalesce("_head", "_first").alias("_first"))
    return rows.join(ids, "_set", "left").select("_id", "_key", "_n", "_component", "_first")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group: the one of the smallest id, and of rows that share it the one of the
    smallest text hash; a row without an id only where no other has one. Documents without shingles stay.
    Rows are known by their id and text: of rows that repeat both, one stays."""
    found = stored(_judged(docs, id_col, text_col).where("_n > 0"), "near-copies")
    head = F.col("_id").eqNullSafe(F.col("_first")["_id"]) & (F.col("_key") == F.col("_first")["_key"])
    gone = found.where(~head).select(F.col("_id").alias("_gone"), F.col("_key").alias("_gonekey")).distinct()
    key = F.xxhash64(docs[text_col])
    kept = docs.join(gone, docs[id_col].eqNullSafe(gone["_gone"]) & (key == gone["_gonekey"]), "left_anti")
    twice = stored(found.where(head).groupBy("_id", "_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
                   .select(F.col("_id").alias("_twice"), F.col("_key").alias("_twicekey")), "repeated-rows")
    if twice.isEmpty():
        return kept
    again = kept[id_col].eqNullSafe(twice["_twice"]) & (F.xxhash64(kept[text_col]) == twice["_twicekey"])
    once = kept.join(twice, again, "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(twice, again, "left_anti").unionByName(once)
