import hashlib
import re

from wayfarer.llm import decontaminate as D

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text, items, window=10):
    w = words(text)
    hit, named = set(), set()
    for item, t in items:
        v = words(t)
        for i in range(max(1, len(v) - window + 1) if v else 0):
            run = v[i: i + window]
            for k in range(len(w) - len(run) + 1):
                if w[k: k + len(run)] == run:
                    hit.update(range(k, k + len(run)))
                    named.add(str(item))
    return (len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit))


ALPHA = "one two three four five six seven eight nine ten eleven twelve thirteen"
ITEMS = [(1, ALPHA), (2, ALPHA), (10, "Kurz"), (11, None), (12, "..."), (13, "a a a a a a a a a a a a"), (14, "É 日本"), (None, "orphan words here")]


def items_table(spark, rows=ITEMS):
    return spark.createDataFrame([(i, t, "z", 5) for i, t in rows], "item_id long, text string, window string, doc_id int")


def compare(spark, docs, rows, items=ITEMS):
    found = [tuple(r) for r in D.decontaminate(docs(rows), items_table(spark, items)).collect()]
    named = [(i, t) for i, t in items if i is not None]
    assert sorted(found, key=repr) == sorted([(i, *brute(t, named)) for i, t in rows], key=repr)


def test_special_rows(spark, docs):
    rows = [(1, ALPHA.upper() + " x " + ALPHA), (2, None), (3, ""), (4, "kurz, KURZ"), (5, "a " * 15), (6, "é 日本"), (7, "É-日本!"),
            (8, "word " * 30_000 + ALPHA), (9, ALPHA[:40]), (1, "one"), (None, ALPHA), (None, "kurz"), (20, "x"), (20, "x"),
            (21, ALPHA), (21, ALPHA), (22, "two three four five six seven eight nine ten eleven")]
    compare(spark, docs, rows, [i for i in ITEMS if i[0] is not None])


def test_empty_tables(spark, docs):
    compare(spark, docs, [])
    compare(spark, docs, [(1, "a b")], [])


def test_item_without_id(spark, docs):
    r = D.decontaminate(docs([(1, "orphan words here")]), items_table(spark)).collect()[0]
    assert (r.contaminated, r.n_hit, r.n_items) == (True, 3, 0)


def test_phrase_and_proximity(spark, docs):
    near = ALPHA.replace("six", "six inserted")
    rows = D.matches(docs([(1, ALPHA), (2, near)]), items_table(spark, ITEMS[:1]), slop=1).collect()
    assert {r.kind for r in rows if r.doc_id == 1} == {"phrase"}
    assert {r.start for r in rows if r.doc_id == 1} == {0, 1, 2, 3}
    assert {r.kind for r in rows if r.doc_id == 2} == {"proximity"}


def test_dropping_keeps_columns(spark, docs):
    table = docs([(1, ALPHA), (2, "clean"), (None, "clean too"), (3, None)])
    kept = D.drop_contaminated(table, items_table(spark))
    assert kept.columns == table.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [2, 3, None]


def test_dropping_goes_by_id_and_text(spark, docs):
    rows = [(None, ALPHA), (None, "clean"), (None, None), (5, ALPHA), (5, "clean too"), (5, ALPHA)]
    kept = D.drop_contaminated(docs(rows), items_table(spark)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted([(None, "clean"), (None, None), (5, "clean too")], key=repr)
