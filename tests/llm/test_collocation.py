"""Phrase mining against counting all runs of words."""

import collections
import random
import re

import numpy as np
import pytest

from chatlog.llm import collocation as C
from fixtures import ascii_lower


def brute(rows, longest=3, least=10, cover=50, top=2000):
    count = collections.Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", ascii_lower(text or "")):
            w = re.findall("[^ \t]+", piece)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    count[lang or "und", tuple(w[i:i + k])] += 1
    total = collections.Counter()
    for (lang, p), n in count.items():
        total[lang] += n * (len(p) == 1)
    wanted = {key: a for key, a in count.items() if len(key[1]) > 1 and a >= least}
    out = collections.defaultdict(list)
    for (lang, p), a in wanted.items():
        cuts = []
        for k in range(1, len(p)):
            left, right = count[lang, p[:k]], count[lang, p[k:]]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        inside = any(lang == other and len(q) > len(p) and 100 * b >= cover * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                     for (other, q), b in wanted.items())
        if not inside:
            out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, rank, p.decode(), -a, left, right, total[lang], -score)
                  for lang, each in out.items() for rank, (score, a, p, left, right) in enumerate(sorted(each)[:top], 1))


def fixture(seed=5):
    rng = random.Random(seed)
    words = ["a", "b", "Ä", "ä", "c'd", "\x00x", "日本", "New", "york", "e-f", "z" * 200]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" "] * 12 + ["\t", ". ", ",", "\n", "\r\n", "\x0b", "?!"]) for _ in range(n))
    rows = [(rng.choice(["en", "de", "x y", None, "und"]), text(rng.randrange(1, 120))) for _ in range(150)]
    rows += [("en", "of the " * 900), ("en", " ".join(f"of the rare{i}" for i in range(60)))] + [("en", "copy of a copy, again")] * 40
    return rows + [("en", None), ("de", ""), ("fr", " .,"), ("fr", "once only")]


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, lang, text, "q", "r") for i, (lang, text) in enumerate(rows)],
                               "doc_id bigint, lang string, text string, w0 string, n string")
    return sorted(tuple(r) for r in C.collocations(df, **more).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_phrases_equal_counting(spark):
    rows = fixture()
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("longest, least, cover, top", [(2, 3, 50, 5), (4, 5, 30, 2000), (3, 1, 100, 40)])
def test_other_lengths_and_limits(spark, longest, least, cover, top):
    rows = fixture(longest)[:90] + fixture()[-6:]
    assert run(spark, rows, longest=longest, least=least, cover_percent=cover, top=top) == brute(rows, longest, least, cover, top)


@pytest.mark.parametrize("head", [0, 3, 9])
def test_words_without_numbers_hot_routes_and_small_stretches(spark, monkeypatch, head):
    rows = fixture(8)
    want = brute(rows)
    for name, value in (("HEAD_WORDS", head), ("ROUTE", 100), ("HOT_ROUTE", 150), ("FLUSH", 400)):
        monkeypatch.setattr(C, name, value)
    assert run(spark, rows) == want


def test_empty(spark):
    assert run(spark, []) == run(spark, [("en", None), (None, "")]) == []


def test_scores_beyond_64_bits(spark):
    a, left, right = 4_000_000_001, 5_000_000_003, 7_000_000_001
    df = spark.createDataFrame([(a, left, right)], "a bigint, l bigint, r bigint")
    assert df.select(C._score("a", "l", "r")).collect()[0][0] == 1000000 * a * a // (left * right)


def test_quicksort_counts_equal_parts():
    rng = np.random.default_rng(1)
    keys, weights = rng.integers(-1, 4, (500, 3)), rng.integers(1, 4, 500)
    keys[:, 1:][keys[:, :-1] < 0] = -1
    keys[:, 2][keys[:, 1] < 0] = -1
    for least in (1, 20):
        want = collections.Counter()
        for row, n in zip(keys.tolist(), weights.tolist()):
            for d in range(1, 4):
                if row[d - 1] < 0:
                    break
                want[tuple(row[:d])] += n
        depth, at, weight = C.equal_parts(keys, weights, least)
        got = {tuple(keys[r][:d].tolist()): n for d, r, n in zip(depth, at, weight.tolist())}
        assert got == {k: n for k, n in want.items() if n >= least}
