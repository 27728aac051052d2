"""Harmonic packing of documents into sequences of a fixed capacity.

Pieces of documents fall into classes by the reciprocal of their length: class ``j`` holds lengths from
``capacity / (j + 1)``, not included, to ``capacity / j``. A bin of class ``j`` takes ``j`` pieces, whatever
they are, so it never overflows, and a worker fills bins without knowing of the others'. What a class
wastes is small when its pieces come close to ``capacity / j``. So documents are cut: into whole sequences,
then into the longest length ``capacity / j`` that the rest still has, until what is left lies close
enough below one.

A worker hands on the bins it can't fill, fewer than one a class, and no other ids are ever shuffled. In a
second round the pieces of these bins are numbered class by class over all workers and make full bins
again. Less than a bin of each class is left in the whole corpus; its ids become sequences end to end, the
last ones cut at powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfarer.llm.common import text_or_empty
from wayfarer.llm.token_binary import END_ID, TOKENIZER, Encoder, bits_for, pack, unpack
from wayfarer.session import scratch_path

CAPACITY = 2048
PAD_ID = 0
SPARE = 16  # ids that a bin may waste for a piece that is left whole
SHORT = 32  # pieces of so few ids are left whole in any case: a bin of them wastes fewer
ENCODED = 1 << 19  # characters encoded together
CACHE_PIECES = 1 << 19  # distinct pieces of text whose ids a worker remembers
WRITTEN = 64  # sequences handed to Spark together
ROW_BITS = 40  # of a document's number among all workers' documents: its place in its worker's input
FIRST, SECOND, PARTS = "first", "second", "parts"

PIECES = "doc_ids array<string>, rows array<long>, starts array<long>, lengths array<long>, doc_tokens array<long>"
SCHEMA = f"part int, number long, class int, n_ids long, size long, bits int, {PIECES}, payload binary"
_LISTS = {"rows": pa.int64(), "starts": pa.int64(), "lengths": pa.int64(), "doc_tokens": pa.int64()}
_ARROW = pa.schema([("part", pa.int32()), ("number", pa.int64()), ("class", pa.int32()), ("n_ids", pa.int64()), ("size", pa.int64()),
                    ("bits", pa.int32()), ("doc_ids", pa.list_(pa.string())), *[(c, pa.list_(t)) for c, t in _LISTS.items()],
                    ("payload", pa.binary())])


@dataclass(frozen=True)
class Piece:
    doc_id: str | None
    row: int  # of the document in its worker's input
    start: int
    doc_tokens: int
    ids: np.ndarray


@lru_cache(maxsize=8)
def cuts(capacity: int, spare: int = SPARE, short: int = SHORT) -> tuple[tuple[int, ...], ...]:
    """The lengths that a rest of each length below ``capacity`` is cut into, in falling order."""
    out: list[tuple[int, ...]] = [()]
    for rest in range(1, capacity):
        j = capacity // rest
        if rest <= short or capacity - j * rest <= spare:
            out.append((rest,))
        else:
            cut = capacity // (j + 1)
            out.append((cut, *out[rest - cut]))
    return tuple(out)


def cut_document(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids."""
    return [capacity] * (n // capacity) + list(cuts(capacity)[n % capacity])


class Bin:
    """Pieces of one sequence, their ids in place in the sequence's own array; what is not used is padding."""

    def __init__(self, capacity: int, pad_id: int = PAD_ID):
        self.ids, self.used = np.full(capacity, pad_id, "u4"), 0
        self.pieces: list[tuple[str | None, int, int, int, int]] = []  # doc_id, row, start, length, doc_tokens

    def add(self, doc_id: str | None, row: int, start: int, doc_tokens: int, ids: np.ndarray) -> None:
        self.ids[self.used: self.used + len(ids)] = ids
        self.used += len(ids)
        self.pieces.append((doc_id, row, start, len(ids), doc_tokens))


class Bins:
    """One worker's open bins, one for each class; a bin is full with the class's number of pieces."""

    def __init__(self, capacity: int, pad_id: int = PAD_ID):
        self.capacity, self.pad_id = capacity, pad_id
        self.open: dict[int, Bin] = {}

    def add(self, doc_id: str | None, row: int, start: int, doc_tokens: int, ids: np.ndarray) -> Bin | None:
        """The bin that the piece fills, if it does."""
        kind = self.capacity // len(ids)
        if (bin_ := self.open.get(kind)) is None:
            bin_ = self.open[kind] = Bin(self.capacity, self.pad_id)
        bin_.add(doc_id, row, start, doc_tokens, ids)
        return self.open.pop(kind) if len(bin_.pieces) == kind else None


def padded(n: int, capacity: int) -> int:
    """Ids of a sequence with its padding: none at a power of two."""
    return n if n & (n - 1) == 0 else capacity


def end_to_end(pieces: list[Piece], capacity: int, pad_id: int = PAD_ID) -> list[Bin]:
    """Sequences of all ids of ``pieces``, one piece after the other, cut where a sequence is full; the last
    ones end at falling powers of two."""
    joined: list[Piece] = []  # what was cut from one document and lies together is one piece again
    for p in sorted(pieces, key=lambda p: (p.row, p.start)):
        last = joined[-1] if joined else None
        if last and last.row == p.row and last.start + len(last.ids) == p.start:
            joined[-1] = Piece(p.doc_id, p.row, last.start, p.doc_tokens, np.concatenate([last.ids, p.ids]))
        else:
            joined.append(p)
    left = sum(len(p.ids) for p in joined)
    out: list[Bin] = []
    room = 0
    for p in joined:
        at = 0
        while at < len(p.ids):
            if not room:
                room = capacity if left >= capacity else 1 << (left.bit_length() - 1)
                out.append(Bin(capacity, pad_id))
            n = min(room, len(p.ids) - at)
            out[-1].add(p.doc_id, p.row, p.start + at, p.doc_tokens, p.ids[at: at + n])
            at, room, left = at + n, room - n, left - n
    return out


class Writer:
    """Rows of the stored tables, some at a time."""

    def __init__(self, bits: int):
        self.bits = bits
        self.held: list[tuple] = []

    def put(self, part: int, number: int | None, kind: int | None, bin_: Bin, whole: bool = True) -> Iterator[pa.RecordBatch]:
        """A sequence with its padding or, not ``whole``, the pieces of an open bin."""
        size = padded(bin_.used, len(bin_.ids)) if whole else bin_.used
        self.held.append((part, number, kind, bin_.used, size, self.bits, *map(list, zip(*bin_.pieces, strict=True)),
                          pack(bin_.ids[:size], self.bits)))
        if len(self.held) == WRITTEN:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            columns = zip(*self.held, strict=True)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)
            self.held = []


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder in a Python worker, kept for its later tasks."""
    return Encoder(path, CACHE_PIECES)


def _pieces(r: dict) -> list[Piece]:
    """The pieces of a stored row."""
    ids = unpack(r["payload"], r["bits"], 0, r["n_ids"])
    ends = np.cumsum(np.asarray(r["lengths"], "i8")).tolist()
    return [Piece(d, k, s, t, ids[e - n: e]) for d, k, s, n, t, e in
            zip(r["doc_ids"], r["rows"], r["starts"], r["lengths"], r["doc_tokens"], ends, strict=True)]


def write_sequences(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, pad_id: int = PAD_ID,
                    capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id``, and write the packed sequences under ``path``.

    NULL texts count as empty: they hold the end id alone. Rows with a NULL id and rows that repeat an id
    are documents of their own. An empty table writes empty tables. Other columns of ``docs`` are not read.
    ``tokenizer`` is the path of a tokenizer file present on every machine (default: the public 49k word
    vocabulary). A sequence shorter than ``capacity`` is padded with ``pad_id``, unless its length is a
    power of two. A worker holds one batch of texts and less than a bin of each class.
    """
    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
    spark = docs.sparkSession
    rows = docs.select(F.spark_partition_id().alias("part"), F.col(id_col).cast("string").alias("_id"),
                       text_or_empty(text_col).alias("_text"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        out = Writer(bits_for(max(enc.vocabulary, end_id + 1, pad_id + 1)))
        bins = Bins(capacity, pad_id)
        part = number = row = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            ends = np.cumsum(pc.binary_length(batch.column("_text")).to_numpy())
            a = 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + ENCODED, "right")))
                some = batch.slice(a, b - a)
                keys, texts = some.column("_id").to_pylist(), some.column("_text").to_pylist()
                for key, x in zip(keys, enc.encode(texts), strict=True):
                    ids = np.append(x, np.uint32(end_id)).astype("u4")
                    at = 0
                    for n in cut_document(len(ids), capacity):
                        full = bins.add(key, row, at, len(ids), ids[at: at + n])
                        at += n
                        if full:
                            yield from out.put(part, number, capacity // n, full)
                            number += 1
                    row += 1
                a = b
        for kind, bin_ in sorted(bins.open.items()):
            yield from out.put(part, None, kind, bin_, whole=False)
        yield from out.flush()

    rows.mapInArrow(fill, SCHEMA).write.option("compression", "none").parquet(f"{path}/{FIRST}")
    first = spark.read.schema(SCHEMA).parquet(f"{path}/{FIRST}")
    _second_round(first.where("number IS NULL"), capacity, pad_id).write.option("compression", "none").parquet(f"{path}/{SECOND}")
    second = spark.read.schema(SCHEMA).parquet(f"{path}/{SECOND}")
    # (part, base): sequences before each part's; one row for each task of the first round
    parts = first.where("number IS NOT NULL").unionByName(second).groupBy("part").agg(F.count(F.lit(1)).alias("_all"))
    before = F.sum("_all").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts.select("part", F.coalesce(before, F.lit(0)).alias("base")).write.parquet(f"{path}/{PARTS}")


def _second_round(open_bins: DataFrame, capacity: int, pad_id: int) -> DataFrame:
    """Sequences from the bins that the workers could not fill, as part -1. A class's pieces are numbered over
    all workers; each ``class`` of them are a bin, and those of the last, short bins go end to end."""
    counts = open_bins.select("part", "class", F.size("lengths").cast("long").alias("_n"))
    classes = counts.groupBy("class").agg(F.sum("_n").alias("_total"))  # as many rows as there are classes
    full = F.expr("_total div class")
    classes = classes.select(F.col("class").alias("_of"), full.alias("_full"),
                             F.coalesce(F.sum(full).over(Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)),
                                        F.lit(0)).alias("_base"),
                             F.sum(full).over(Window.partitionBy()).alias("_last"))
    before = F.sum("_n").over(Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(F.col("part").alias("_part"), F.col("class").alias("_class"),
                           F.coalesce(before, F.lit(0)).alias("_before"))
    placed = (open_bins.join(counts, (F.col("part") == F.col("_part")) & (F.col("class") == F.col("_class")))
              .join(classes, F.col("class") == F.col("_of"))
              .select(*open_bins.columns, F.col("class").alias("kind"), F.col("_before").alias("before"),
                      F.col("_full").alias("full"), F.col("_base").alias("base"), F.col("_last").alias("last")))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each open bin's pieces to the numbers of their sequences; all pieces of short bins have the last."""
        out = Writer(1)
        for batch in batches:
            for r in batch.to_pylist():
                out.bits, kind, at = r["bits"], r["kind"], r["before"]
                pieces = _pieces(r)
                while pieces:
                    n = kind - at % kind
                    some = Bin(capacity, pad_id)
                    for p in pieces[:n]:  # documents of all workers: a row's number with its worker's
                        some.add(p.doc_id, (r["part"] << ROW_BITS) + p.row, p.start, p.doc_tokens, p.ids)
                    if at // kind < r["full"]:
                        yield from out.put(-1, r["base"] + at // kind, kind, some, whole=False)
                    else:
                        yield from out.put(-1, r["last"], None, some, whole=False)
                    pieces, at = pieces[n:], at + n
        yield from out.flush()

    def assemble(rows: pa.Table) -> pa.Table:
        """One full bin, of the class's number of pieces, or less than a bin of each class."""
        found = rows.to_pylist()
        out, number, kind = Writer(found[0]["bits"]), found[0]["number"], found[0]["class"]
        pieces = sorted((p for r in found for p in _pieces(r)), key=lambda p: (p.row, p.start))
        if kind is None:
            made = end_to_end(pieces, capacity, pad_id)
        else:
            made = [Bin(capacity, pad_id)]
            for p in pieces:
                made[0].add(p.doc_id, p.row, p.start, p.doc_tokens, p.ids)
        batches = [f for k, b in enumerate(made) for f in out.put(-1, number + k, kind, b)]
        return pa.Table.from_batches([*batches, *out.flush()], _ARROW)

    return placed.mapInArrow(deal, SCHEMA).groupBy("number").applyInArrow(assemble, SCHEMA)


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """The stored sequences: sequence_id (numbered from 0 without gaps), class, n_ids, size (with padding), bits,
    the pieces (doc_ids, starts, lengths and doc_tokens, each an array) and payload (the packed ids)."""
    first = spark.read.schema(SCHEMA).parquet(f"{path}/{FIRST}").where("number IS NOT NULL")
    rows = first.unionByName(spark.read.schema(SCHEMA).parquet(f"{path}/{SECOND}"))
    parts = spark.read.schema("part int, base long").parquet(f"{path}/{PARTS}")
    return rows.join(parts, "part").select((F.col("base") + F.col("number")).alias("sequence_id"), "class", "n_ids", "size", "bits",
                                           "doc_ids", "rows", "starts", "lengths", "doc_tokens", "payload")


def sequence_ids(sequences: DataFrame) -> DataFrame:
    """(sequence_id, input_ids): the ids of ``read_sequences``' rows with their padding, unpacked."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = unpack(r["payload"], r["bits"], 0, r["size"]).astype("i4")
                yield pa.record_batch({"sequence_id": pa.array([r["sequence_id"]], pa.int64()),
                                       "input_ids": pa.array([ids], pa.list_(pa.int32()))})

    return sequences.select("sequence_id", "size", "bits", "payload").mapInArrow(expand, "sequence_id long, input_ids array<int>")


def packed_pieces(sequences: DataFrame, id_col: str = "doc_id", id_type: str = "bigint") -> DataFrame:
    """One row for each piece in ``read_sequences``' rows: ``id_col``, start (its document's ids before it),
    length, ids_crc32 (of its ids as little-endian unsigned 32-bit integers), doc_tokens, sequence_id, offset
    (the sequence's ids before it), size (of the sequence, with padding)."""

    schema = pa.schema([("_id", pa.string()), *[(c, pa.int64()) for c in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "size")]])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, WRITTEN):
                rows = [(p.doc_id, p.start, len(p.ids), zlib.crc32(p.ids.tobytes()), p.doc_tokens, r["sequence_id"], at, r["size"])
                        for r in batch.slice(a, WRITTEN).to_pylist() for p, at in _placed(r)]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    out = sequences.drop("class").mapInArrow(digest, "_id string, start long, length long, ids_crc32 long, doc_tokens long, "
                                                     "sequence_id long, offset long, size long")
    return out.select(F.col("_id").cast(id_type).alias(id_col), *out.columns[1:])


def _placed(r: dict) -> Iterator[tuple[Piece, int]]:
    at = 0
    for p in _pieces(r):
        yield p, at
        at += len(p.ids)


def pack_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", **options) -> DataFrame:
    """Write ``docs`` as packed sequences (to a fresh folder of the shared scratch space by default) and
    return ``packed_pieces`` of what was written."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "sequences")
    write_sequences(docs, path, id_col=id_col, **options)
    return packed_pieces(read_sequences(spark, path), id_col, docs.schema[id_col].dataType.simpleString())
