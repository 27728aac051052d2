import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import path
from wayfarer.llm import packing as P
from wayfarer.llm import registry
from wayfarer.session import scratch_path

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
SPECIAL = [None, "", "  ", "a", "some words here", "é İI Σας 日本 ー", "<|endoftext|> x", "word " * 20_000, "x y z " * 700, "b " * 2047, "c " * 2048]


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("capacity", [1, 2, 7, 64, 2048, 4096])
def test_cuts_are_whole_and_close_to_their_class(capacity):
    for n in range(3 * capacity + 2):
        found = P.cut_document(n, capacity)
        assert sum(found) == n and all(1 <= x <= capacity for x in found)
        for x in found:
            assert x <= P.SHORT or capacity - (capacity // x) * x <= max(P.SPARE, capacity // x)


def test_documents_are_cut_into_few_pieces_with_little_waste():
    lengths = random.Random(1).choices(range(1, 2048), k=20_000)
    bins, n_pieces, waste, room = P.Bins(2048), 0, 0, 0
    for k, n in enumerate(lengths):
        for x in P.cut_document(n):
            n_pieces += 1
            full = bins.add(str(k), k, 0, n, np.zeros(x, "u4"))
            if full:
                assert len(full.pieces) == 2048 // x and full.used <= 2048
                waste, room = waste + 2048 - full.used, room + 2048
    assert waste / room < 0.004 and n_pieces / len(lengths) < 4


def test_end_to_end_joins_cut_documents_and_ends_at_powers_of_two():
    rng = random.Random(2)
    pieces = [P.Piece(str(k), k, 10 * j, 50, np.arange(10 * j, 10 * j + 10).astype("u4")) for k in range(30) for j in range(5)]
    rng.shuffle(pieces)
    made = P.end_to_end(pieces, 64)
    assert [b.used for b in made] == [64] * 23 + [16, 8, 4] and sum(len(b.pieces) for b in made) < 30 + 27
    got = defaultdict(list)
    for b in made:
        at = 0
        for _, row, start, length, _ in b.pieces:
            assert b.ids[at: at + length].tolist() == list(range(start, start + length))
            got[row] += range(start, start + length)
            at += length
    assert all(sorted(x) == list(range(50)) for x in got.values()) and len(got) == 30
    assert P.end_to_end([], 64) == []


def check(rows, want, capacity=2048):
    """Each id in exactly one piece; sequences without gaps; padding only where it may be. Returns the padding."""
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
        docs[r["doc_id"]].append(r)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity and {r["size"] for r in pieces} == {at if at & (at - 1) == 0 else capacity}
        padding += pieces[0]["size"] - at
    assert sorted(sequences) == list(range(len(sequences)))
    found = []
    for key, pieces in docs.items():
        for t in sorted({ids for ids in want if ids[0] == key}):
            found.append(t)
        if sum(k == key for k, _ in want) > 1:
            continue  # rows with one id: see the caller
        ids, at = next(ids for k, ids in want if k == key), 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at: at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    assert sum(r["length"] for r in rows) == sum(len(ids) for _, ids in want)
    return padding


@pytest.mark.parametrize("parts", [1, 3])
def test_special_rows(docs, parts):
    rows = list(enumerate(SPECIAL)) + [(20 + k, "again and again " * 40) for k in range(60)]
    got = P.pack_documents(docs(rows).repartition(parts)).collect()
    assert check(got, [(i, tuple(ids_of(t))) for i, t in rows]) < 2048


def test_null_and_repeated_ids(docs):
    rows = [(None, "a b c"), (None, None), (5, "x y"), (5, "x y"), (5, "z " * 3000)]
    got = P.pack_documents(docs(rows)).collect()
    want = [(i, tuple(ids_of(t))) for i, t in rows]
    check(got, want)
    starts = defaultdict(int)
    for r in got:
        starts[(r["doc_id"], r["doc_tokens"], r["start"] == 0)] += r["length"] if r["start"] else 1
    assert starts[(None, 4, True)] == 1 and starts[(None, 1, True)] == 1 and starts[(5, 3, True)] == 2 and starts[(5, 3001, True)] == 1


def test_empty_table_and_string_ids(docs, spark):
    assert P.pack_documents(docs([])).collect() == []
    df = spark.createDataFrame([("a", "x y"), (None, "z")], "doc_id string, text string")
    assert {(r["doc_id"], r["doc_tokens"]) for r in P.pack_documents(df).collect()} == {("a", 3), (None, 2)}


def test_bins_are_filled_alike_for_any_split_and_second_round_bins_are_full(spark, tmp_path):
    df = spark.read.parquet(path("documents")).select("doc_id", "text")
    for parts, capacity in ((1, 256), (7, 256), (16, 64)):
        folder = scratch_path(spark, "packing-test")
        P.write_sequences(df.repartition(parts), folder, capacity=capacity)
        found = P.read_sequences(spark, folder).collect()
        assert all(len(r["lengths"]) == r["class"] for r in found if r["class"] is not None)
        last = [r for r in found if r["class"] is None]
        assert sum(r["n_ids"] for r in last) < capacity * 100 and all(r["n_ids"] == r["size"] for r in last)
        assert sum(r["size"] - r["n_ids"] for r in found) < 0.06 * sum(r["size"] for r in found)
        ids = {r["sequence_id"]: r["input_ids"] for r in P.sequence_ids(P.read_sequences(spark, folder)).collect()}
        assert all(len(ids[r["sequence_id"]]) == r["size"] for r in found)
        assert all(set(ids[r["sequence_id"]][r["n_ids"]:]) <= {P.PAD_ID} for r in found)


def test_query_keeps_every_id(spark):
    rows = [(r["doc_id"], tuple(ids_of(r["text"]))) for r in spark.read.parquet(path("documents")).collect()]
    got = registry.queries()["op11_packing"](spark, path("x").rsplit("/", 1)[0]).collect()
    padding = check(got, rows)
    assert padding < 0.01 * sum(len(ids) for _, ids in rows)
