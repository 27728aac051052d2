import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import path
from wayfarer.llm import periodic_runs as P
from wayfarer.llm import registry


def brute(x, min_length=24, min_exponent=3):
    """Every period on its own: stretches in which words so far apart are equal; of one stretch its smallest period."""
    found = {}
    for p in range(1, len(x) // 2 + 1):
        a = 0
        while a + p < len(x):
            b = a
            while b + p < len(x) and x[b] == x[b + p]:
                b += 1
            if b - a >= p:
                found.setdefault((a, b + p), p)
            a = b + 1
    return sorted((a, b - a, p) for (a, b), p in found.items() if b - a >= max(min_length, min_exponent * p))


def by_start(runs):
    return sorted(runs, key=lambda r: (r[0], r[2]))


def texts(seed):
    rng = random.Random(seed)
    out = [[], [0], [0] * 23, [0] * 24, [0, 1] * 40, [0] * 500, [*range(50)] * 4, [*range(50)] * 3 + [7], ([0] * 30 + [1]) * 5]
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    out += [fib[-1], [bin(i).count("1") & 1 for i in range(512)]]  # rich in runs; without cubes
    for _ in range(60):
        x = [rng.randrange(rng.choice((1, 2, 3, 30))) for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(3)):
            a = rng.randrange(len(x) + 1)
            x = x[:a] + x[a: a + rng.randrange(1, 40)] * rng.randrange(1, 7) + x[a:]
        out.append(x)
    return out


@pytest.mark.parametrize("low", [(24, 3), (2, 2), (10, 4)])
def test_runs_equal_brute_force(low):
    some = texts(1)
    got = P.runs_of([np.array(t, "i8") for t in some], *low)
    assert [by_start(r) for r in got] == [by_start(brute(t, *low)) for t in some]


@pytest.mark.parametrize("chunk", [1, 2, 7, 64])
def test_words_may_come_one_at_a_time_or_many(chunk):
    some = [np.array(t, "i8") for t in texts(2)]
    assert P.runs_of(some, 2, 2, chunk) == P.runs_of(some, 2, 2)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), max_size=4), st.integers(1, 40))
def test_any_texts_in_any_chunks(some, chunk):
    got = P.runs_of([np.array(t, "i8") for t in some], 2, 2, chunk)
    assert [by_start(r) for r in got] == [by_start(brute(t, 2, 2)) for t in some]


def test_a_run_is_open_until_its_period_breaks():
    c = P.SquareCatchers()
    for w in [5, 1, 2, 3, 1, 2, 3]:
        c.append([w])
    assert c.open.tolist() == [[1, 3]] and not c.closed
    c.append([1])
    assert c.open.tolist() == [[1, 3]]
    c.append([9])
    assert not len(c.open) and c.closed[0].tolist() == [[1, 8, 3]]
    many = P.SquareCatchers()
    for _ in range(600):  # multiples of the period don't pile up
        many.append([4])
    assert many.open.tolist() == [[0, 1]]


def test_a_long_text_of_one_word():
    n = 300_000
    assert P.runs_of([np.zeros(n, "i8")]) == [[(0, n, 1)]]
    x = np.arange(100_000)
    assert P.runs_of([np.concatenate([x, x, x])]) == [[(0, n, 100_000)]]


def test_a_collision_is_found_and_tried_again(monkeypatch):
    real = P.SquareCatchers._mix

    def weak(self, a, b):  # every stretch has one hash in the first try
        return real(self, a, b) if self.seed else np.zeros(len(a), "u8")

    init = P.SquareCatchers.__init__

    def seeded(self, longest=None, seed=0):
        init(self, longest, seed)
        self.seed = seed

    monkeypatch.setattr(P.SquareCatchers, "__init__", seeded)
    monkeypatch.setattr(P.SquareCatchers, "_mix", weak)
    x = [*range(40), *([1, 2] * 20)]
    assert P.runs_of([np.array(x, "i8")]) == [brute(x)]


def expected(doc_id, text):
    w = [x for x in (text or "").encode().split()]
    if doc_id is not None and w and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = by_start(brute(w))
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
SPECIAL = [None, "", " \t\n ", "a b " * 30, "é ü  x\x85y \x1c" * 30, "w " * 3_000, "one two\x0bthree\x0c" * 9,
           "a b c d " * 6 + "x y " * 20, "日本 語 " * 12, "a\x00b c " * 12]


def test_query_on_special_rows(docs):
    rows = [(i, t) for i, t in enumerate(SPECIAL * 3)] + [(None, t) for t in SPECIAL] + [(3, "z " * 40), (3, "z " * 40)]
    got = P.run_digests(P.periodic_runs(docs(rows), P.said_again)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((expected(*r) for r in rows), key=repr)
    assert P.run_digests(P.periodic_runs(docs([]))).count() == 0


def test_runs_and_collapsed_text(docs):
    row = P.periodic_runs(docs([(1, "so " + "la di da " * 10 + "end")])).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 30, 3)] and row["collapsed"] == "so la di da end" and row["n_words"] == 32


def test_ids_of_other_types(spark):
    df = spark.createDataFrame([("a", "x " * 30), (None, "y")], "doc_id string, text string")
    assert {r["doc_id"]: r["n_runs"] for r in P.run_digests(P.periodic_runs(df)).collect()} == {"a": 1, None: 0}


def test_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(path("documents")).collect()]
    got = registry.queries()["op13_periodic_runs"](spark, path("x").rsplit("/", 1)[0]).select(*COLUMNS).collect()
    short = {i for i, t in rows if len((t or "").split()) < 1500}  # the brute force is quadratic
    want = [expected(*r) for r in rows if r[0] in short]
    assert sorted((tuple(r) for r in got if r["doc_id"] in short), key=repr) == sorted(want, key=repr)
    assert len(got) == len(rows) and sum(r["n_runs"] > 0 for r in got) > 5
