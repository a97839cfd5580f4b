"""Importance resampling against plain Python, and the checksums of spans against zlib."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from chatlog.llm import resample as R
from fixtures import docs, prose, words


def test_span_checksums():
    rng = random.Random(3)
    data = np.frombuffer(bytes(rng.randrange(256) for _ in range(50_000)), np.uint8)
    spans = [(0, 50_000), (5, 5)]
    for _ in range(1500):
        n = rng.choice([1, 2, 5, 63, 64, 65, 127, 128, 129, 200, 1000, 5000])
        at = rng.randrange(len(data) - n)
        spans.append((at, at + n))
    starts, ends = map(np.array, zip(*spans))
    assert R.span_crcs(data, starts, ends).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in spans]


TEXTS = ["Hello, World x", "", "...", None, "äöÜ A1 " + "z" * 300, "a", "b c", "x\x00y\x7fz É"]


def features(text, run):
    w = words(text)
    return [" ".join(w[i:i + k]) for k in range(1, run + 1) for i in range(len(w) - k + 1)]


@pytest.mark.parametrize("run", [1, 2, 3])
def test_run_hashes(run):
    n_words, n, hashes = R.run_hashes(pa.array(["skipped", *TEXTS]).slice(1), run)
    assert n_words.tolist() == [len(words(t)) for t in TEXTS]
    assert n.tolist() == [len(features(t, run)) for t in TEXTS]
    assert hashes.tolist() == [zlib.crc32(f.encode()) for t in TEXTS for f in features(t, run)]


def brute(rows, target, run=1, buckets=10_000, least=20, percent=10, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in features(t, run))
    t = Counter(bucket(f) for _, x in target for f in features(x, run))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for i, text in rows:
        f = features(text, run)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, len(words(text)) >= least])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


def fixture():
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randrange(0, 60), 300 if i % 3 else 40)) for i in range(200)]
    rows += [(500, rows[3][1])] * 30 + [(None, prose(rng, 30))] * 3 + list(enumerate(TEXTS, 600)) + [(900, "long " * 20_000)]
    return rows, [(f"t{i}", prose(rng, 25, 40)) for i in range(12)] + [("n", None), ("e", "")]


@pytest.mark.parametrize("run, buckets, least, percent", [(1, 10_000, 20, 10), (2, 50, 0, 100), (3, 1000, 5, 33)])
def test_resample_equals_brute_force(spark, run, buckets, least, percent):
    rows, target = fixture()
    items = spark.createDataFrame(target, "item_id string, text string")
    out = R.resample(docs(spark, rows, extra=True), items, run, buckets, least, percent)
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows, target, run, buckets, least, percent)


def test_empty_sides(spark):
    rows, target = fixture()
    none = spark.createDataFrame([], "item_id string, text string")
    assert sorted(map(tuple, R.resample(docs(spark, rows), none).collect()), key=repr) == brute(rows, [])
    items = spark.createDataFrame(target, "item_id string, text string")
    assert R.resample(docs(spark, []), items).collect() == []


def test_draw_gives_whole_rows(spark):
    rows = [(i, prose(random.Random(i), 40)) for i in range(60)]
    items = spark.createDataFrame([("t", prose(random.Random(1), 40))], "item_id string, text string")
    df = docs(spark, rows)
    ranked = {r.doc_id for r in R.resample(df, items).collect() if r.rank is not None}
    drawn = R.draw(df, items)
    assert {r.doc_id for r in drawn.collect()} == ranked and drawn.columns == df.columns and len(ranked) == 6
