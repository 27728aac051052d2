import random
import re

import pytest

from tests.llm.conftest import path
from wayfarer.llm import license_scan as L

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    """The contract's base columns, word by word."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in L.BASE_PHRASES:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i: i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def test_base_of_the_test_documents(spark):
    rows = spark.read.parquet(path("documents", "sf0.01"))
    want = {r.doc_id: base(r.text) for r in rows.select("doc_id", "text").collect()}
    found = L.license_scan(rows).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found} == want
    assert sum(r.n_base for r in found) > 0
    for r in found:
        assert 0 <= r.score <= 1
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))


@pytest.mark.parametrize("text", [None, "", "mit", "The MIT\nLicense; MIT--license", "mitlicense", "MIT License MIT License",
                                  "É general public\x00license é", "a " * 30_000 + "Apache License"])
def test_base_of_special_texts(docs, text):
    r = L.license_scan(docs([(1, text)])).collect()[0]
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text)


UNICODE_SPACES = "\x1c\x1d\x85\u00a0\u1680\u2000\u2003\u2028\u2029\u202f\u205f\u3000"


def base_spans(text):
    """(label, start, end) of the base phrases in code points of the text."""
    words = [(m[0].translate(LOWER), m.start(), m.end()) for m in re.finditer(r"(?:[A-Za-z0-9]|[^\x00-\x7F])+", text)]
    out = set()
    for phrase, label in L.BASE_PHRASES:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if [w for w, *_ in words[i: i + len(p)]] == p:
                out.add(f"{label}:{words[i][1]}:{words[i + len(p) - 1][2]}")
    return out


@pytest.mark.parametrize("text", ["é\u00a0é\u00a0é mit license", "see\u00a0note\u00a0one: the MIT License", "\u3000 \u3000 x MIT License",
                                  "a\u2003b MIT License", "\u3000mit license", "mit license\u00a0", "mit\u00a0license"])
def test_words_with_white_space_that_is_not_ascii(docs, text):
    r = L.license_scan(docs([(1, text)])).collect()[0]
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text)
    assert base_spans(text) <= set(r.spans.split(","))


def test_random_texts_with_unicode_spaces():
    rng = random.Random(8)
    search = L.NoticeSearch(L.BASE_PHRASES, L.NOTICES)
    pieces = ["mit", "license", "MIT License", "apache", "General Public License", "é", "x", "9", *UNICODE_SPACES, " ", " ", "\n", "-", "."]
    some = 0
    for _ in range(3000):
        text = "".join(rng.choice(pieces) + rng.choice(("", " ", " ", "\u00a0")) for _ in range(rng.randrange(12)))
        got = L.scan_text(text, search)
        assert got[:5] == base(text), text
        spans = set(filter(None, got[7].split(",")))
        assert base_spans(text) <= spans and all(0 <= int(x.split(":")[1]) < int(x.split(":")[2]) <= len(text) for x in spans), text
        some += got[1] > 0
    assert some > 300


def test_edits_within_bounds(docs):
    text = "é Licenced undr the Apache Licence, Version 2.0."
    r = L.license_scan(docs([(1, text)])).collect()[0]
    assert (r.n_base, r.base_labels, r.labels) == (0, "", "apache")
    assert 0.9 < r.score < 1
    label, a, b = r.spans.split(":")
    assert (label, text[int(a): int(b)]) == ("apache", "Licenced undr the Apache Licence, Version 2.0")


def test_too_many_edits(docs):
    r = L.license_scan(docs([(1, "licxxsed undxx the apaxxe licxxse versixx 2 0")])).collect()[0]
    assert (r.labels, r.score, r.spans) == ("", 0.0, "")


def test_every_edited_notice_is_found():
    """Pigeonhole: any notice with up to its number of substitutions keeps one piece."""
    search = L.NoticeSearch(L.BASE_PHRASES, L.NOTICES)
    for k, n in enumerate(search.notices):
        if n.base:
            continue
        for start in range(0, len(n.text) - n.errors):
            letters = list(n.text)
            for e in range(n.errors):
                letters[(start + e * 7) % len(letters)] = "\u00df"
            assert any(i == k for i, *_ in search.find(f" x {''.join(letters)} y "))


def test_empty_table(docs):
    assert L.license_scan(docs([])).collect() == []
