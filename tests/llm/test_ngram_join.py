import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import path
from wayfarer.llm import ngram_join as N

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[k: k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """All pairs that share a shingle, by position of the row; components by union-find."""
    sets = [shingles(t) for _, t in rows]
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    common = Counter((a, b) for ks in holders.values() for i, b in enumerate(ks) for a in ks[:i])
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for (a, b), c in common.items():
        if 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c):
            parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted([(i, len(s), least.get(root(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))], key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def edited(words, rng, share):
    return " ".join(rng.choice(words) + "x" if rng.random() < share else w for w in words)


def corpus(seed):
    """Unrelated texts, chains of edits at about the threshold, a large group of near copies, a common
    passage, and short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage = text(60)
    rows = [text(rng.randrange(1, 200)) for _ in range(60)]
    rows += [f"{passage} {text(rng.randrange(2, 120))}" for _ in range(60)]
    base = text(150).split()
    rows += [edited(base, rng, rng.choice([0.005, 0.01, 0.02, 0.03])) for _ in range(80)]
    for _ in range(6):
        chain = text(100)
        for _ in range(6):
            rows.append(chain)
            chain = edited(chain.split(), rng, 0.025)
    rows += ["a b c d", "A  b\tc d", "a b c d e", "a b c d e f", "one", "ONE", "", " \n", None]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_corpus(docs, seed):
    rows = corpus(seed)
    assert got(N.ngram_join(docs(rows))) == brute(rows)


def test_test_documents(spark):
    table = spark.read.parquet(path("documents"))
    rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    want = brute(rows)
    assert got(N.ngram_join(table)) == want
    assert any(c != i for i, _, c in want)


def test_special_rows(docs):
    long = " ".join(f"v{k}" for k in range(40_000))
    rows = [(5, long), (6, long + " end"), (7, None), (8, ""), (8, ""), (None, "p q r s t"), (None, "lone text of nobody here"),
            (9, "p q r s t"), (4, "same words in this text"), (4, "same words in this text"), (4, "other words in that text")]
    assert got(N.ngram_join(docs(rows))) == brute(rows)


def test_empty_and_wordless_tables(docs):
    assert got(N.ngram_join(docs([]))) == []
    assert got(N.ngram_join(docs([(1, None), (2, " ")]))) == [(1, 0, 1), (2, 0, 2)]


def test_threshold_is_exact(docs):
    """Sets of 7 with 6 common: 6 of 8 is 0.75; of 6 with 5 common: 5 of 7 is less."""
    a = [f"t{k}" for k in range(11)]
    b = ["x", *a[1:]]
    c, d = a[:10], ["x", *a[1:10]]
    rows = [(1, " ".join(a)), (2, " ".join(b))]
    assert got(N.ngram_join(docs(rows))) == [(1, 7, 1), (2, 7, 1)]
    rows = [(1, " ".join(c)), (2, " ".join(d))]
    assert got(N.ngram_join(docs(rows))) == [(1, 6, 1), (2, 6, 2)]


def test_hashes_stand_for_shingles():
    texts = [t for _, t in corpus(3)]
    assert [len(s) for s in N.shingle_sets(texts)] == [len(shingles(t)) for t in texts]
    assert np.array_equal(N.shingle_sets(["A b  c\nd e f"])[0], N.shingle_sets(["a B c d E f "])[0])


def test_candidates_keep_every_link(docs):
    """Without the merging step the filters alone keep every link between different sets."""
    rows = corpus(4)
    table = docs(rows)
    alive = N.describe(table, "doc_id", "text", 5).where("_n > 0").groupBy("_set").agg(
        {"_id": "min", "_n": "max"}).toDF("_set", "_rep", "_n").selectExpr("*", "_rep AS _cls")
    alive = N.stored(alive, "test-alive")
    sets = N.stored(N.fetch_sets(table, alive, "doc_id", "text", 5), "test-sets")
    prefix = N.stored(N.prefixes(sets), "test-prefix")
    alone = prefix.selectExpr("_cls", "_cls AS _comp")
    found = {tuple(sorted(r)) for r in N.verified(N.candidate_pairs(prefix, alone), sets).collect()}
    reps = {r._cls: shingles(dict(rows)[r._cls]) for r in alive.collect()}
    want = {(a, b) for a in reps for b in reps if a < b and 100 * len(reps[a] & reps[b]) >= 75 * len(reps[a] | reps[b])}
    assert found == want


def test_one_document_of_each_group_stays(docs):
    rows = corpus(5) + [(0, dict(corpus(5))[0])]
    table = docs(rows)
    kept = N.drop_near_copies(table)
    assert kept.columns == table.columns
    component = {i: (n, c) for i, n, c in brute(rows)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (n, c) in component.items() if n == 0 or i == c)


def test_dropping_goes_by_id_and_text(docs):
    one, two, three = (" ".join(f"{c}{k}" for k in range(60)) for c in "abc")
    rows = [(3, one), (5, one + " more"), (5, two), (5, two), (None, one + " less"), (None, three), (None, three + " x"), (None, ""), (None, None), (6, ""), (3, three + " y z")]
    kept = sorted(((r.doc_id, r.text) for r in N.drop_near_copies(docs(rows)).collect()), key=repr)
    assert kept == sorted([(3, one), (5, two), (3, three + " y z"), (None, ""), (None, None), (6, "")], key=repr)
    alone = N.drop_near_copies(docs([(None, three), (None, three + " x"), (None, three)])).collect()
    assert len(alone) == 1
