"""Token ids as bit-packed blocks.

Texts are range-partitioned and sorted by id, encoded, and stored in blocks of whole documents:
each row of the output table is one block whose ids take the minimum number of bits the vocabulary
needs. The table is written by Spark, so the commit protocol covers lost executors and any store
Spark writes to will do. A block's header holds its offset in its part and the ids and token counts
of its documents; a second table, one row for each part, holds the parts' offsets. Together they
give random access by position without reading other parts or unpacking other blocks.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfarer.llm.common import text_or_empty
from wayfarer.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
BLOCK_IDS = 1 << 16  # a block is closed at the first document that reaches this many ids
CACHE_PIECES = 1_000_000  # distinct pieces of text whose ids a worker remembers, about 60 bytes each
BLOCKS, PARTS = "blocks", "parts"
BLOCK_SCHEMA = ("part int, block int, before long, bits int, n_ids long, doc_ids array<long>, "
                "n_tokens array<long>, payload binary")
PART_SCHEMA = "part int, base long"


def bits_for(vocabulary: int) -> int:
    """Bits that hold any id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Each id in ``bits`` bits, lowest bit first, without padding between ids."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype("<u4")[:, None] >> np.arange(bits, dtype="u4")) & 1
    return np.packbits(planes.astype("u1").ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a packed block; reads only the bytes that hold them."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", stop - start, start * bits // 8).astype("<u4")
    first, last = start * bits, stop * bits
    raw = np.frombuffer(payload, "u1")[first // 8: -(-last // 8)]
    planes = np.unpackbits(raw, bitorder="little")[first % 8: first % 8 + last - first]
    return (planes.reshape(-1, bits).astype("<u4") << np.arange(bits, dtype="u4")).sum(axis=1, dtype="<u4")


class Pieces:
    """The tokenizer's pieces (its split pattern) in a run of Latin-1 text, found with numpy.

    Every Latin-1 text is NFC-normal, and lower-casing it stays within Latin-1, so bytes are
    characters here. The pattern: a contraction, a run of letters, one digit, or a run of other
    visible characters.
    """

    # The contractions of the tokenizer's split pattern.
    CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
    SPACE, LETTER, DIGIT, OTHER = range(4)

    def __init__(self):
        chars = [chr(c) for c in range(256)]
        kinds = [self.SPACE if c in "\t\n\v\f\r \x85\xa0" else
                 self.LETTER if (k := unicodedata.category(c)[0]) == "L" else
                 self.DIGIT if k == "N" else self.OTHER for c in chars]
        self.kind = np.array(kinds, "u1")
        self.lower = bytes(ord(c.lower()) for c in chars)

    def spans(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First and one-past-last byte of each piece of a lower-cased text."""
        raw = np.frombuffer(text, "u1")
        kind = self.kind[raw]
        change = np.empty(len(raw), bool)
        change[:1] = True
        np.not_equal(kind[1:], kind[:-1], out=change[1:])
        change |= kind == self.DIGIT
        for i in np.flatnonzero((raw == ord("'")) & change).tolist():
            for tail in self.CONTRACTIONS:
                if text.startswith(tail, i + 1):
                    change[i + 1] = False
                    if i + 1 + len(tail) < len(raw):
                        change[i + 1 + len(tail)] = True
                    break
        first = np.flatnonzero(change)
        last = np.append(first[1:], len(raw))
        seen = kind[first] != self.SPACE
        return first[seen], last[seen]


class RangeHash:
    """Polynomial hashes modulo 2**64 of many byte ranges of one buffer."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.value = rng.integers(0, 1 << 64, 256, dtype="u8")
        self.base = int(rng.integers(0, 1 << 63, dtype="u8")) * 2 + 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.power, self.back = np.ones(1, "u8"), np.ones(1, "u8")

    @staticmethod
    def _grown(powers: np.ndarray, base: int, n: int) -> np.ndarray:
        while len(powers) < n:
            powers = np.concatenate([powers, powers * np.uint64(pow(base, len(powers), 1 << 64))])
        return powers

    def __call__(self, raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        self.power = self._grown(self.power, self.base, len(raw) + 1)
        self.back = self._grown(self.back, self.inverse, len(raw) + 1)
        sums = np.zeros(len(raw) + 1, "u8")
        np.cumsum(self.value[raw] * self.power[: len(raw)], out=sums[1:])
        return (sums[last] - sums[first]) * self.back[first]


class Encoder:
    """Ids of whole texts, from a bounded memory of the tokenizer's pieces.

    A text's ids are those of its pieces in order. The pieces of many Latin-1 texts are found and
    hashed together; only pieces not met before go to the tokenizer, many to a call, and their ids
    are kept by a 128-bit hash. Other texts, texts that hold a special token's string, and
    tokenizers without word-end tokens are encoded whole.
    """

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.cache_pieces = cache_pieces
        self.word_end = np.zeros(self.vocabulary, bool)
        self.word_end[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # the same vocabulary for texts of ready, already normal pieces
        self.of_pieces = Tokenizer.from_file(path)
        self.of_pieces.normalizer = normalizers.Sequence([])
        self.of_pieces.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.pieces, self.hashes = Pieces(), (RangeHash(3), RangeHash(5))
        self.forget()

    def forget(self) -> None:
        self.keys, self.checks = np.zeros(0, "u8"), np.zeros(0, "u8")
        self.first, self.count, self.flat = np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0, "u4")

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each piece, and all their ids; 200 pieces to a text. Each piece ends
        with one word-end token; where the numbers disagree, pieces are encoded one by one."""
        counts, flat = [], []
        groups = [pieces[i: i + 200] for i in range(0, len(pieces), 200)]
        for group, e in zip(groups, self.of_pieces.encode_batch_fast([" ".join(g) for g in groups],
                                                                     add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "u4")
            ends = np.flatnonzero(self.word_end[ids]) + 1
            if len(ends) == len(group) and ends[-1] == len(ids):
                counts.append(np.diff(ends, prepend=0))
                flat.append(ids)
            else:
                each = self._whole(group)
                counts.append(np.array([len(x) for x in each], "i8"))
                flat.extend(each)
        return np.concatenate(counts), np.concatenate(flat)

    def _learn(self, keys: np.ndarray, checks: np.ndarray, pieces: list[str]) -> None:
        count, ids = self._encode_pieces(pieces)
        first = len(self.flat) + np.cumsum(count) - count
        order = np.argsort(keys := np.concatenate([self.keys, keys]), kind="stable")
        self.keys = keys[order]
        self.checks = np.concatenate([self.checks, checks])[order]
        self.first = np.concatenate([self.first, first])[order]
        self.count = np.concatenate([self.count, count])[order]
        self.flat = np.concatenate([self.flat, ids])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        easy, raws, whole = [], [], []
        for k, text in enumerate(texts):
            try:
                if not self.word_end.any() or any(s in text for s in self.specials):
                    raise ValueError("whole")
                raws.append(text.encode("latin-1").translate(self.pieces.lower))
                easy.append(k)
            except ValueError:  # UnicodeEncodeError too
                whole.append(k)
        for k, ids in zip(whole, self._whole([texts[k] for k in whole]), strict=True):
            out[k] = ids
        if not easy:
            return out
        if len(self.keys) > self.cache_pieces:
            self.forget()
        text = b"\n".join(raws) + b"\n"
        begins = np.cumsum([0, *(len(r) + 1 for r in raws)])
        first, last = self.pieces.spans(text)
        raw = np.frombuffer(text, "u1")
        keys, at, of = np.unique(self.hashes[0](raw, first, last), return_index=True, return_inverse=True)
        checks = self.hashes[1](raw, first, last)
        if len(keys):
            row = np.searchsorted(self.keys, keys)
            known = np.zeros(len(keys), bool)
            inside = row < len(self.keys)
            known[inside] = self.keys[row[inside]] == keys[inside]
            new = np.flatnonzero(~known)
            if len(new):
                pieces = [text[a:b].decode("latin-1") for a, b in zip(first[at[new]].tolist(), last[at[new]].tolist(),
                                                                       strict=True)]
                self._learn(keys[new], checks[at[new]], pieces)
                row = np.searchsorted(self.keys, keys)
            row = row[of]
            if not np.array_equal(self.checks[row], checks):  # two pieces with one key: practically never
                for k, ids in zip(easy, self._whole([texts[k] for k in easy]), strict=True):
                    out[k] = ids
                return out
            count = self.count[row]
            ends = np.cumsum(count)
            ids = self.flat[np.repeat(self.first[row] - (ends - count), count) + np.arange(ends[-1])]
            cuts = np.concatenate([[0], ends])[np.searchsorted(first, begins)]
        else:
            ids, cuts = np.zeros(0, "u4"), np.zeros(len(begins), "i8")
        for k, a, b in zip(easy, cuts.tolist(), cuts[1:].tolist(), strict=False):
            out[k] = ids[a:b]
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder in a Python worker, kept for its later tasks."""
    return Encoder(path)


def _slices(texts: list[str], size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``size`` characters together."""
    start = total = 0
    for k, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield start, k + 1
            start, total = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
                 block_ids: int = BLOCK_IDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id``, and write the packed blocks under ``path`` in
    ascending id order.

    NULL texts count as empty: they hold the end id alone. Rows with a NULL id come first. Rows that
    repeat an id follow one another, ordered by their text's hash. An empty table writes empty
    tables. Other columns of ``docs`` are not read. ``tokenizer`` is the path of a tokenizer file
    present on every machine (default: the public 49k word vocabulary).
    """
    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text_or_empty(text_col).alias("_text"))
    # by the text's hash too: the rows of one id, or without one, are dealt over many tasks
    rows = rows.withColumn("_tie", F.xxhash64("_text")).repartitionByRange("_id", "_tie").sortWithinPartitions("_id", "_tie")
    rows = rows.select(F.spark_partition_id().alias("part"), "_id", "_text")

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer)
        bits = bits_for(max(enc.vocabulary, end_id + 1))
        part = number = before = held = 0
        ids: list[np.ndarray] = []
        doc_ids: list[int | None] = []

        def block() -> pd.DataFrame:
            return pd.DataFrame({"part": [part], "block": [number], "before": [before], "bits": [bits],
                                 "n_ids": [held], "doc_ids": [doc_ids], "n_tokens": [[len(x) for x in ids]],
                                 "payload": [pack(np.concatenate(ids), bits)]})

        for batch in batches:
            texts = batch["_text"].tolist()
            keys = [None if pd.isna(x) else int(x) for x in batch["_id"]]
            part = int(batch["part"].iloc[0]) if texts else part
            for a, b in _slices(texts):
                for key, x in zip(keys[a:b], enc.encode(texts[a:b]), strict=True):
                    ids.append(np.append(x, np.uint32(end_id)).astype("u4"))
                    doc_ids.append(key)
                    held += len(x) + 1
                    if held >= block_ids:
                        yield block()
                        number, before, held, ids, doc_ids = number + 1, before + held, 0, [], []
        if ids:
            yield block()

    rows.mapInPandas(blocks, BLOCK_SCHEMA).write.option("compression", "none").parquet(f"{path}/{BLOCKS}")
    # (part, base): ids before each part; one row for each write task
    parts = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/{BLOCKS}").groupBy("part").agg(F.sum("n_ids").alias("_all"))
    base = F.sum("_all").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts.select("part", F.coalesce(base, F.lit(0)).alias("base")).write.parquet(f"{path}/{PARTS}")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The stored blocks with ``start``, the ids of the corpus before each. The broadcast side has
    one row for each write task."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/{BLOCKS}")
    parts = spark.read.schema(PART_SCHEMA).parquet(f"{path}/{PARTS}")
    return blocks.join(F.broadcast(parts), "part").withColumn("start", F.col("base") + F.col("before"))


def read_range(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """(position, token_id) of the ids ``start`` to ``stop`` of the whole corpus. The parts that hold some
    of them are looked up first, so the scan of the blocks is pruned to them; of their blocks only those
    that hold some are unpacked, and of these only the bytes needed."""
    base = F.col("base")
    ends = spark.read.schema(PART_SCHEMA).parquet(f"{path}/{PARTS}").where(base < stop).agg(
        F.coalesce(F.max(F.when(base <= start, F.col("part"))), F.lit(0)).alias("first"), F.max("part").alias("last")).first()
    found = read_tokens(spark, path).where(F.col("part").between(ends["first"], -1 if ends["last"] is None else ends["last"]))
    found = found.where((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                a, b = max(0, start - r.start), min(r.n_ids, stop - r.start)
                yield pd.DataFrame({"position": np.arange(r.start + a, r.start + b),
                                    "token_id": unpack(r.payload, r.bits, a, b).astype("i4")})

    return found.select("start", "n_ids", "bits", "payload").mapInPandas(cut, "position long, token_id int")


def document_tokens(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """What the files hold of each document: id, start (ids before it), n_tokens (with the end id),
    ids_crc32 (of its ids as little-endian unsigned 32-bit integers)."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                counts = np.asarray(r.n_tokens, "i8")
                ends = np.cumsum(counts)
                ids = unpack(r.payload, r.bits, 0, r.n_ids)
                yield pd.DataFrame({
                    "_id": pd.array([None if x is None or pd.isna(x) else int(x) for x in r.doc_ids], "Int64"),
                    "start": r.start + ends - counts, "n_tokens": counts,
                    "ids_crc32": [zlib.crc32(ids[e - c: e].tobytes()) for e, c in zip(ends, counts, strict=True)]})

    out = read_tokens(spark, path).mapInPandas(digest, "_id long, start long, n_tokens long, ids_crc32 long")
    return out.withColumnRenamed("_id", id_col)


def token_binary(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``docs`` as packed blocks (to a fresh folder of the shared scratch space by default)
    and return ``document_tokens`` of what was written."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-blocks")
    write_tokens(docs, path, **options)
    return document_tokens(spark, path, options.get("id_col", "doc_id"))
