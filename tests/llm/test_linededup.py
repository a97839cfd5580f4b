"""Line dedup against brute force; insertions and deletions."""

import random

import numpy as np
import pytest

from chatlog.llm import cuckoo, linededup
from chatlog.llm.cuckoo import Bank, Shard
from chatlog.llm.linededup import LineIndex
from fixtures import ascii_lower, docs


def brute(rows, known=None):
    def key(line):
        return ascii_lower(line.strip(" \t\n\x0b\x0c\r"))

    held = {}
    for doc, text in known or rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20 and doc is not None:
                held.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 20 or len(h := held.get(key(x), ())) < 3 or doc == max(h) or (doc or -1) > max(h)]
        if doc is None:
            kept = [x for x in lines if len(held.get(key(x), ())) < 3]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def fixture():
    rng = random.Random(1)
    shared = [f"A shared line number {i} of the fixture {'é' * (i % 3)}" for i in range(12)]
    rows = []
    for d in range(40):
        lines = [rng.choice([*shared, "short", "", f"a line of its own number {d} {rng.random()}"]) for _ in range(rng.randrange(1, 12))]
        rows.append((d, "\n".join(rng.choice([x, f"  {x}\t\r", x.upper() if x.isascii() else x]) for x in lines)))
    hot = "This very common line stands in every document of a third of all"
    rows += [(100 + i, f"{hot}\n{hot}\nown {i}") for i in range(30)]
    rows += [(1, rows[1][1]), (1, rows[1][1]), (None, f"{hot}\n{shared[0]}\nx"), (200, None), (201, ""), (202, "\n\n"), (203, "É" * 19), (204, "É" * 20)]
    return rows


@pytest.mark.parametrize("extra,send", [(False, 64 << 20), (True, 64 << 20), (False, 0)])
def test_equals_brute_force(spark, monkeypatch, extra, send):
    """With filters sent to all workers, and with keys sent to their shard's filter."""
    monkeypatch.setattr(linededup, "SEND_BYTES", send)
    rows = fixture()
    got = linededup.dedup_lines(docs(spark, rows, extra)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_empty_table(spark):
    assert linededup.dedup_lines(docs(spark, [])).count() == 0


def test_insert_and_delete_are_reversible(spark):
    rows = [r for r in fixture() if r[0] is not None]
    first, second = [r for r in rows if r[0] % 3], [r for r in rows if not r[0] % 3]
    everything = docs(spark, rows)
    index = LineIndex.empty(spark, shards=8).insert(docs(spark, first)).insert(docs(spark, second)).insert(docs(spark, first))
    assert sorted(map(tuple, index.dedup(everything).collect()), key=repr) == brute(rows)
    gone = spark.createDataFrame([(d,) for d, _ in second], "id bigint")
    back = index.delete(gone)
    assert sorted(map(tuple, back.dedup(docs(spark, first)).collect()), key=repr) == brute(first)
    plain = LineIndex.empty(spark, shards=8).insert(docs(spark, first))
    assert sorted(back.counts.collect()) == sorted(plain.counts.collect())
    again = back.insert(docs(spark, second))
    assert sorted(map(tuple, again.dedup(everything).collect()), key=repr) == brute(rows)


def test_filters_grow(spark):
    """Inserts that double: the filters hold all shared keys, none too full, and hardly any key is in a stash."""
    index, sizes = LineIndex.empty(spark, shards=2), []
    for step in range(5):
        lines = range(10 * 2 ** step, 20 * 2 ** step)
        rows = [(100 * step + copy, "\n".join(f"a line that three documents share {i}" for i in lines)) for copy in range(3)]
        index = index.insert(docs(spark, rows))
        filters = index.filters.collect()
        held = sum(r.held for r in filters)
        assert held == index.counts.filter("n >= 3").count() == 10 * 2 ** (step + 1) - 10
        assert sum(len(r.stash) for r in filters) <= held / 100
        assert all(r.held <= cuckoo.LOAD * len(r.slots) / 2 for r in filters)
        sizes.append(sum(len(r.slots) for r in filters))
    assert sizes[-1] > 4 * sizes[0]
    text = "a line that three documents share 300\na line that no other one has"
    assert [r.n_dropped for r in index.dedup(docs(spark, [(1, text)])).collect()] == [1]
    index = index.delete(spark.createDataFrame([(400 + i,) for i in range(3)], "id bigint"))
    assert sum(r.held for r in index.filters.collect()) == 10 * 2 ** 4 - 10
    assert [r.n_dropped for r in index.dedup(docs(spark, [(1, text)])).collect()] == [0]


def test_text_ids(spark):
    rows = [("b10", "one line of twenty characters\nx"), ("b9", "one line of twenty characters"), ("a", "One line of twenty characters")]
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert sorted((r.doc_id, r.text, r.n_dropped) for r in got) == [("a", "", 1), ("b10", "x", 1), ("b9", "one line of twenty characters", 0)]


def test_cuckoo_filter():
    rng = np.random.default_rng(3)
    keys = rng.integers(-(1 << 62), 1 << 62, 3000)
    shard = Shard.sized(1000)  # far too small: the rest goes to the stash
    shard.insert(keys[:2000])
    shard.insert(keys[2000:])
    assert shard.held == len(keys)
    assert shard.stash and shard.contains(keys).all()
    shard.delete(keys[:1500])
    assert shard.held == 1500
    assert shard.contains(keys[1500:]).all()
    roomy = Shard.sized(3000)
    roomy.insert(keys)
    assert not roomy.stash
    assert roomy.contains(rng.integers(-(1 << 62), 1 << 62, 20000)).mean() < 0.01
    roomy.delete(keys)
    assert not roomy.slots.any()
    bank = Bank({2: shard, 5: Shard.sized(4)})
    assert bank.contains(np.full(1500, 2), keys[1500:]).all()
    assert not bank.contains(np.array([0, 5, 9]), np.array([1, 2, 3])).any()
