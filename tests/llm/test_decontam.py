"""Decontamination against a brute-force search for windows."""

import hashlib
import random

import pytest

from chatlog.llm import decontam
from fixtures import docs, prose, words


def brute(rows, items, span=10):
    windows = {}
    for item, text in items:
        w = words(text)
        t = min(len(w), span)
        for i in range(len(w) - t + 1) if w else []:
            windows.setdefault(tuple(w[i:i + t]), set()).add(item)
    out = []
    for doc, text in rows:
        w, hit, names = words(text), set(), set()
        for i in range(len(w)):
            for t in range(1, span + 1):
                if (found := windows.get(tuple(w[i:i + t]))) and i + t <= len(w):
                    hit.update(range(i, i + t))
                    names.update(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def fixture():
    rng = random.Random(4)
    items = [(i, prose(rng, n)) for i, n in enumerate([40, 25, 10, 11, 9, 3, 1, 0])]
    items += [(7, None), (8, "repeat " * 30), (9, items[0][1]), (None, prose(rng, 20)), (0, prose(rng, 15)), (11, "É, le TEST-case of Ünicode und mehr wörter hier an board")]
    rows = [(i, prose(rng, rng.randrange(0, 80))) for i in range(20)]
    for i, (_, text) in enumerate(items):
        w = (text or "").split()
        rows.append((100 + i, " ".join([prose(rng, 7), *w[2:], prose(rng, 5)])))
        rows.append((200 + i, " ".join([prose(rng, 3), *w[:9], "cut", *w[9:19], prose(rng, 5)])))
    rows += [(300, None), (301, ""), (302, "..."), (303, "repeat " * 500), (100, rows[20][1]), (100, rows[20][1]), (None, rows[21][1]), (None, None)]
    rows.append((400, "x É LE test CASE OF Ünicode und mehr wörter hier an board y"))
    return rows, items


@pytest.mark.parametrize("extra", [False, True])
def test_equals_brute_force(spark, extra):
    rows, items = fixture()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontam.decontaminate(docs(spark, rows, extra), bench).drop("items").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, items)


def test_without_broadcast(spark):
    """The same by shuffled joins."""
    rows, items = fixture()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = decontam.decontaminate(docs(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")).drop("items").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(map(tuple, got), key=repr) == brute(rows, items)


def test_empty_tables(spark):
    rows, items = fixture()
    none = spark.createDataFrame([], "item_id bigint, text string")
    got = decontam.decontaminate(docs(spark, rows), none).collect()
    assert len(got) == len(rows) and not any(r["contaminated"] for r in got)
    assert decontam.decontaminate(docs(spark, []), spark.createDataFrame(items, "item_id bigint, text string")).count() == 0


def test_clean_keeps_whole_rows(spark):
    rows, items = fixture()
    df = docs(spark, rows, extra=True)
    got = decontam.clean(df, spark.createDataFrame(items, "item_id bigint, text string"))
    assert got.columns == df.columns
    want = sorted(r[0] for r in brute(rows, items) if not r[5] and r[0] is not None)
    assert sorted(r["doc_id"] for r in got.collect() if r["doc_id"] is not None) == want
