import hashlib
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wayfarer.llm import exact_dedup as E


def brute(rows):
    """From the contract's wording."""
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    out = []
    for i, t in norm:
        ids = [j for j, u in norm if u == t]
        known = [j for j in ids if j is not None]
        keep = min(known) if known else None
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_special_rows(docs):
    rows = [(1, "a  b"), (2, "a\tb"), (3, None), (4, ""), (5, " "), (6, "x" * 50_000), (7, "x" * 50_000), (7, "x" * 50_000),
            (None, "a b"), (None, "lone"), (8, "A b"), (9, "a\u00a0b")]
    assert got(E.exact_dedup(docs(rows))) == brute(rows)


def test_empty_table(docs):
    assert got(E.exact_dedup(docs([]))) == []


def test_full_filter_stays_exact(docs):
    """Far too few bits: nearly every row is possibly repeated, and the result is the same."""
    rows = [(i, f"text {i % 300}") for i in range(500)]
    digests = E.exact_dedup(docs(rows), max_bits=64)
    assert got(digests) == brute(rows)


def test_unique_rows_pass_the_filter(docs):
    rows = [(i, f"text {i}") for i in range(1000)] + [(2000 + i, "copy") for i in range(500)]
    table = docs(rows).selectExpr("doc_id AS _id", "unhex(sha2(text, 256)) AS _sha")
    flagged = E.possibly_repeated(table, E.filter_bits(len(rows)))
    assert flagged.where("_maybe AND _id >= 2000").count() == 500
    assert flagged.where("_maybe AND _id < 2000").count() < 100


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 9), st.one_of(st.none(), st.text("a \t\n\u00a0", max_size=4))), max_size=12))
def test_random_rows(docs, rows):
    assert got(E.exact_dedup(docs(rows))) == brute(rows)
