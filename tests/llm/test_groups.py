"""Near-duplicates and nearest neighbours."""

import collections
import random

import numpy as np
import pytest

from chatlog.llm import hnsw, probminhash as P
from chatlog.llm.components import components
from chatlog.llm.workers import word_list
from fixtures import docs, prose


# --- near-duplicates -----------------------------------------------------------


def brute(rows):
    """doc -> (least id, size) by all pairs of links."""
    sets = [P.shingles(word_list(t or ""))[0] for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if P.similarity(sets[i], sets[j]) >= P.SIMILAR:
                parent[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], min(ids, default=None), len(members)) for i in members]
    return sorted(out, key=repr)


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"edit{rng.random()}"
    return " ".join(w)


def fixture():
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randrange(20, 150), 3000)) for i in range(30)]
    for k in range(6):  # copies and near copies, some just on either side of the bound
        base = prose(rng, 120, 3000)
        rows += [(1000 + 50 * k + j, edited(rng, base, j % 5)) for j in range(12)]
        rows += [(1040 + 50 * k + j, base.upper() + "!") for j in range(3)]
    chain = prose(rng, 200, 5000).split()
    rows += [(2000 + j, " ".join(chain[4 * j:4 * j + 100])) for j in range(8)]  # neighbours link, ends don't
    passage = prose(rng, 60, 9000)
    rows += [(3000 + j, f"{passage} {prose(rng, 60, 9000)}") for j in range(25)]  # share much, but no links
    rows += [(4000, None), (4001, ""), (4002, "..."), (4003, "one two"), (4004, "One, two!"), (4005, "one two three"), (4006, "same " * 300), (4007, "same " * 500)]
    rows += [(0, rows[0][1]), (0, rows[0][1]), (None, rows[1][1]), (None, "lonely words without any id at all"), (5000, prose(rng, 20000, 9000))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("extra,block", [(False, 1024), (True, 4)])
def test_classes_equal_brute_force(spark, monkeypatch, extra, block):
    """Also when a bucket is compared in many small blocks."""
    monkeypatch.setattr(P, "BLOCK", block)
    rows = fixture()
    assert sorted(map(tuple, P.classes(docs(spark, rows, extra)).collect()), key=repr) == brute(rows)


def uneven():
    """Pairs of sets just at the bound; one text, or each, repeats a passage that the other lacks or has once."""
    rng, rows = random.Random(11), []
    for k in range(45):
        word = lambda n: [f"w{rng.getrandbits(48)}" for _ in range(n)]
        base, mine, theirs, times = word(84), word(16), word(6), (100, 1000, 1)[k % 3]
        rows += [(10 * k, " ".join(base + mine * times)), (10 * k + 1, " ".join(base))]
        base, often = word(120), word(20)
        rows += [(10 * k + 5, " ".join(base + often + mine[:6])), (10 * k + 6, " ".join(base + often * times + theirs))]
    return rows


def test_uneven_repeats_equal_brute_force(spark):
    rows = uneven()
    assert sorted(map(tuple, P.classes(docs(spark, rows)).collect()), key=repr) == brute(rows)


def test_uneven_repeats_are_candidates():
    """Whatever the counts, similar sets share a band and enough registers to be looked at."""
    rows, seen = dict(uneven()), 0
    for i in rows:
        if i + 1 in rows:
            (a, n), (b, m) = (P.shingles(word_list(rows[j])) for j in (i, i + 1))
            if P.similarity(a, b) >= P.SIMILAR:
                same = np.frombuffer(P._signed([rows[i]])[2][0].as_py(), "<u4") == np.frombuffer(P._signed([rows[i + 1]])[2][0].as_py(), "<u4")
                assert same.mean() >= P.LEAST_SHARE and same.reshape(P.BANDS, P.BAND).all(1).any()
                seen += 1
    assert seen >= 45


def test_one_of_each(spark):
    rows = fixture()
    df = docs(spark, rows, extra=True)
    kept = P.one_of_each(df)
    assert kept.columns == df.columns
    got = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert got == sorted({c for _, c, _ in brute(rows) if c is not None})


def test_blocks_find_what_connects(spark, monkeypatch):
    """Whatever the blocks, the links between components connect what all pairs would."""
    rng = np.random.default_rng(0)
    groups, members = rng.permutation(40) % 4, []
    for n in range(40):
        words = [b"w%d" % w for w in range(100 * groups[n], 100 * groups[n] + 100)]
        words[rng.integers(0, 100)] = b"x%d" % n
        items, counts = P.shingles(words)
        sign = P.signature(items, counts.astype(float))
        for band in range(P.BANDS):
            key = hash(sign[P.BAND * band:P.BAND * band + P.BAND].tobytes())
            members.append((key, band, n, n // 2, bytearray(sign.astype("<u4").tobytes()), bytearray(items.astype("<u8").tobytes())))
    df = spark.createDataFrame(members, "bucket bigint, band int, node bigint, comp bigint, sign binary, items binary")
    own = [(2 * n, 2 * n + 1) for n in range(20)]  # the components there were before
    everything = brute_groups([(a, b) for a in range(40) for b in range(a) if groups[a] == groups[b]] + own)
    for block in (4, 1024):
        monkeypatch.setattr(P, "BLOCK", block)
        found = [tuple(r) for r in P._close(df).collect()]
        assert all(groups[a] == groups[b] for a, b in found)
        assert brute_groups(found + own) == everything
    assert len(found) < 200  # not all pairs


def brute_groups(pairs):
    label = {n: n for pair in pairs for n in pair}
    while True:
        new = dict(label)
        for a, b in pairs:
            new[a] = new[b] = min(new[a], new[b])
        if new == label:
            return label
        label = new


def test_registers_agree_as_often_as_texts_are_alike():
    rng, hits, share = random.Random(3), [], []
    for _ in range(60):
        items = np.array([rng.getrandbits(64) for _ in range(90)], np.uint64)
        weights = np.array([rng.choice([1.0, 1.4, 2.0]) for _ in range(90)])
        a, b = np.arange(0, 60), np.arange(rng.choice([5, 15, 30]), 90)
        x, y = dict(zip(a, weights[a])), dict(zip(b, weights[b] * 1.3))
        both = set(x) & set(y)
        share.append(sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in set(x) | set(y)) for i in both))
        hits.append((P.signature(items[a], weights[a]) == P.signature(items[b], weights[b] * 1.3)).mean())
    assert abs(np.mean(np.array(hits) - share)) < 0.01 and np.std(np.array(hits) - share) < 0.06


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (95, 100), (7, 7)], "a bigint, b bigint")
    got = dict(map(tuple, components(links).collect()))
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}


def test_no_documents(spark):
    assert P.classes(docs(spark, [])).count() == 0 and P.one_of_each(docs(spark, [])).count() == 0


# --- nearest neighbours -----------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int"


def nearest(rows, queries, k):
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    good = list({(i, v.tobytes()): (i, v) for i, v in good}.values())
    out = {}
    for q, v in good:
        if q in queries:
            near = sorted((-float((v * w).sum()), i) for i, w in good if i != q and len(w) == len(v))[:k]
            out[q] = near
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).selectExpr("*", "'x' AS id", "'x' AS v", "1 AS shard", "2 AS dim", "3 AS rank")


def test_neighbours_of_odd_tables(spark, monkeypatch):
    """With several shards and query blocks; small shards are searched whole, so results are exact."""
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 60)
    monkeypatch.setattr(hnsw, "QUERY_BLOCK", 5)
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8) * rng.choice([0.1, 1, 30])]) for i in range(200)]
    rows += [(300 + i, rows[7][1]) for i in range(40)] + [(7, rows[7][1])]  # copies, and a repeated row
    rows += [(400, None), (401, [0.0] * 8), (402, [1.0, None] + [0.0] * 6), (403, [float("nan")] * 8), (404, [float("inf")] * 8), (None, rows[3][1]), (405, [])]
    rows += [(500 + i, [float(np.float32(x)) for x in rng.normal(size=3)]) for i in range(4)]
    df = vectors(spark, rows)
    got = hnsw.search(hnsw.build_index(df, k=5), df.filter("vec_id % 10 = 0 or vec_id = 7"), k=5).collect()
    want = nearest(rows, {i for i, _ in rows if i is not None and (i % 10 == 0 or i == 7)}, 5)
    found = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append((-r["score"], r["vec_id"]))
        assert r["rank"] == len(found[r["query_id"]])
    assert set(found) == set(want)
    for q in want:
        assert [i for _, i in found[q]] == [i for _, i in want[q]]
        assert np.allclose([s for s, _ in found[q]], [s for s, _ in want[q]], rtol=1e-12)


def test_neighbours_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = hnsw.search(hnsw.build_index(df, k=20), df.filter("vec_id % 20 = 0"), k=20).toPandas()
    pdf = df.toPandas().sort_values("vec_id")
    x, ids = np.stack(pdf["embedding"]).astype(np.float64), pdf["vec_id"].to_numpy()
    recall = []
    for q, own in got.groupby("query_id"):
        s = x @ x[np.searchsorted(ids, q)]
        s[ids == q] = -np.inf
        recall.append(len(set(ids[np.argsort(-s)[:20]]) & set(own["vec_id"])) / 20)
    assert len(recall) == (ids % 20 == 0).sum() and np.mean(recall) > 0.95


def clustered(rng, n=1500, dim=32):
    centres = rng.normal(size=(40, dim))
    return centres[rng.integers(0, 40, n)] + 0.4 * rng.normal(size=(n, dim))


@pytest.mark.parametrize("kind", ["one 1e4", "one 1e6", "one 1e200", "log-normal", "tiny and huge"])
def test_recall_whatever_the_lengths(spark, monkeypatch, kind):
    """One shard of many rows is walked, not searched whole, beside vectors of quite other lengths."""
    monkeypatch.setattr(hnsw, "WHOLE_ROWS", 50)
    rng = np.random.default_rng(9)
    x = clustered(rng)
    if kind.startswith("one"):
        x[7] *= float(kind.split()[1]) if "e200" not in kind else 1
        if "e200" in kind:
            x[7, 3] = 1e200
    elif kind == "log-normal":
        x *= rng.lognormal(0, 1, len(x))[:, None]
    else:
        x[:500] *= 1e-160
        x[500:1000] *= 1e150
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>")
    got = hnsw.search(hnsw.build_index(df, k=20), df.filter("vec_id % 20 = 0"), k=20).toPandas()
    recall = []
    for q, own in got.groupby("query_id"):
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        recall.append(len(set(np.argsort(-s, kind="stable")[:20]) & set(own["vec_id"])) / 20)
    assert len(recall) == 75 and np.mean(recall) > 0.95, np.mean(recall)


def test_no_vectors(spark):
    df = vectors(spark, [(1, None)])
    assert hnsw.search(hnsw.build_index(df, k=3), df, k=3).count() == 0
