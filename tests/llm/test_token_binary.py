import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import path
from wayfarer.llm import token_binary as T
from wayfarer.session import scratch_path

FILE = public_tokenizers.path(T.TOKENIZER)
SPECIAL = [None, "", "   ", "it's they'RE 'start .'s don't 'l ''s 5's x'", "École ÀÉ × ÿ µ ª º ² ½ \x1c \x85 \xa0 ß", "é İI Σας 日本 ー",
           "<|endoftext|> a<|startoftext|>", "a\x00b \t\r\n 12 3a4 $$$ a$b", "word " * 20_000, "x" * 3_000, "😀 ok", "'", "'s", "12"]


def ids_of(text):
    return [*Tokenizer.from_file(FILE).encode(text or "", add_special_tokens=False).ids, T.END_ID]


def want(rows):
    out, start = [], 0
    for i, text in rows:
        ids = ids_of(text)
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def got(df):
    return [tuple(r) for r in df.orderBy("start").collect()]


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_pack_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << min(bits, 31), 1001).astype("u4")
    packed = T.pack(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    for a, b in ((0, 1001), (0, 0), (5, 6), (17, 900), (1000, 1001)):
        assert np.array_equal(T.unpack(packed, bits, a, b), ids[a:b])
    assert T.bits_for(49_408) == 16 and T.bits_for(1) == 1 and T.bits_for(65_537) == 17


def test_encoder_equals_the_library():
    rng = random.Random(4)
    alphabet = "abcdefgh'st. ,!\n\t\xa0\x85ÉéßÀ12½×µ-_́日Σ<|>"
    texts = [t or "" for t in SPECIAL] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)]
    encoder = T.Encoder(FILE, cache_pieces=200)
    for _ in range(2):  # the second time from memory
        for a in range(0, len(texts), 97):
            part = texts[a: a + 97]
            assert [[*map(int, x), T.END_ID] for x in encoder.encode(part)] == [ids_of(t) for t in part]


def test_special_texts(docs):
    rows = list(enumerate(SPECIAL))
    assert got(T.token_binary(docs(rows[::-1]), block_ids=64)) == want(rows)


def test_test_documents(spark):
    table = spark.read.parquet(path("documents"))
    rows = sorted((r.doc_id, r.text) for r in table.select("doc_id", "text").collect())
    assert got(T.token_binary(table)) == want(rows)


def test_null_and_repeated_ids(docs):
    rows = [(3, "c"), (None, "n"), (1, "a"), (1, "a"), (None, None)]
    found = got(T.token_binary(docs(rows)))
    assert [r[0] for r in found] == [None, None, 1, 1, 3]
    assert [r[1] for r in found] == np.cumsum([0, *[r[2] for r in found[:-1]]]).tolist()


def test_random_access(spark, docs):
    rows = [(i, "some words here " * (i % 7)) for i in range(60)]
    place = scratch_path(spark, "test-tokens")
    T.write_tokens(docs(rows), place, block_ids=50)
    everything = [x for _, t in rows for x in ids_of(t)]
    for a, b in ((0, 5), (47, 153), (len(everything) - 3, len(everything) + 10), (10, 10)):
        found = T.read_range(spark, place, a, b).orderBy("position").collect()
        assert [(r.position, r.token_id) for r in found] == list(enumerate(everything))[a:b]


def test_a_range_is_read_from_its_parts_alone(spark, docs):
    place = scratch_path(spark, "test-tokens")
    T.write_tokens(docs([(i, "some words here " * 9) for i in range(400)]).repartition(4), place, block_ids=50)
    plan = T.read_range(spark, place, 5, 9)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(part" in plan and "LessThanOrEqual(part" in plan


def test_rows_of_one_id_are_dealt_over_tasks(spark, docs):
    place = scratch_path(spark, "test-tokens")
    rows = [(None if i % 3 else 7, f"words {i} " * 30) for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is small
    T.write_tokens(docs(rows), place, block_ids=50)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = spark.read.parquet(f"{place}/{T.BLOCKS}").groupBy("part").sum("n_ids").collect()
    assert len(parts) > 2 and max(r[1] for r in parts) < 0.6 * sum(r[1] for r in parts)


def test_empty_table(docs):
    assert got(T.token_binary(docs([]))) == []
