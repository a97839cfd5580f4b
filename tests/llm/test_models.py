"""Language ID, language-model scoring and toxicity."""

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatlog.llm import langid, ppm, toxicity
from chatlog.llm.common import least_hashes
from chatlog.llm.workers import subword_ids, word_list
from fixtures import docs

SF = "/root/testdata/sf0.01"


def test_words_are_the_same_in_tasks_and_columns(spark):
    from chatlog.llm import common

    texts = ["A-Z É Ünï 漢字 x1_y", "", "\x7f~`a", "ÀB c"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(common.words(df["t"])).collect()] == [[w.decode() for w in word_list(t)] for t in texts]


def test_subwords_do_not_depend_on_their_neighbours():
    words = [b"a", b"abc", "für".encode(), b"x" * 70, b"abcdefgh", b""]
    together = subword_ids(words, (1, 2, 3), 12)
    for i, w in enumerate(words):
        assert together[1][together[0] == i].tolist() == subword_ids([w], (1, 2, 3), 12)[1].tolist()
    assert len(subword_ids([b"abc"], (3,), 12)[0]) == 3  # <ab abc bc>


# --- language ---------------------------------------------------------------


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    size, lengths = 3, [5, 4, 4, 1]
    start, change = np.exp(rng.normal(size=size)), np.exp(rng.normal(size=(size, size)))
    emit = [np.exp(rng.normal(size=(n, size))) for n in lengths]
    psi = [np.array([e[t] for e in emit if len(e) > t]) for t in range(5)]
    out = langid._share(psi, start, change)
    for d, e in enumerate(emit):
        want, total = np.zeros((len(e), size)), 0.0
        for path in itertools.product(range(size), repeat=len(e)):
            w = start[path[0]] * math.prod(e[t, k] for t, k in enumerate(path)) * math.prod(change[a, b] for a, b in zip(path, path[1:]))
            total += w
            for t, k in enumerate(path):
                want[t, k] += w
        assert np.allclose([out[t][d] for t in range(len(e))], want / total)


@pytest.fixture(scope="module")
def language_model(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    return table, langid.fit(table.filter(~langid.held_out()))


def test_language_held_out(spark, language_model):
    table, model = language_model
    got = {r["doc_id"]: r for r in langid.identify(table, model).collect()}
    rows = [r for r in table.select("doc_id", "lang", "text").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 and r["lang"]]
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_of_switched_words(spark, language_model):
    table, model = language_model
    pick = {r["lang"]: r["text"] for r in table.filter("length(text) > 600 and length(text) < 3000").select("lang", "text").orderBy("doc_id").collect()}
    a, b = (b" ".join(word_list(pick[k])[:60]).decode() for k in ("en", "de"))
    row = langid.identify(docs(spark, [(1, f"{a} {b}")]), model, runs=True).first()
    share = collections.Counter()
    for lang, n in zip(row["run_langs"], row["run_words"]):
        share[lang] += n
    assert sum(row["run_words"]) == 120 and 50 <= share["en"] <= 70 and 50 <= share["de"] <= 70
    assert len(row["run_langs"]) <= 8


def test_language_edge_cases(spark, language_model):
    _, model = language_model
    long = "the of and " * 40_000
    rows = [(1, None), (2, ""), (3, "123 456 !!"), (None, "the of and"), (5, long), (5, long), (6, "漢")]
    got = langid.identify(docs(spark, rows, extra=True), model).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert by[1] == by[2] == by[3] == ("und", 0.0) and by[5][0] == by[None][0] == "en" and by[6][0] != "und"
    assert langid.identify(docs(spark, []), model).count() == 0
    assert langid.fit(docs(spark, [])) is None
    assert [r["lang_pred"] for r in langid.identify(docs(spark, [(1, "abc")]), None).collect()] == ["und"]


# --- partial matching ---------------------------------------------------------


def _codes(text):
    b = bytes([ppm.BEGIN] * 2) + text.encode() + bytes([ppm.END])
    return [(b[j], b[j + 1], b[j + 2]) for j in range(len(b) - 2)]


def _brute(training, texts):
    levels = collections.defaultdict(collections.Counter)
    for t in training:
        for p, q, r in _codes(t):
            for context in ((p, q), (q,), ()):
                levels[context][r] += 1

    def prob(p, q, r):
        left, out = set(range(256)) - {ppm.BEGIN}, 1.0
        for context in ((p, q), (q,), ()):
            seen = {k: v for k, v in levels[context].items() if k in left}
            total = sum(seen.values()) + len(seen)
            if r in seen:
                return out * seen[r] / total
            if seen:
                out *= len(seen) / total
            left -= set(seen)
        return out / len(left)

    return [sum(math.log10(prob(*c)) for c in _codes(t)) for t in texts]


def test_partial_matching_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ppm, "HEAD_TOKENS", 5)
    texts = ["the cat sat", "The cat  sat\ton the mat", "ünï code", "", None, "zebra quilt 漢", "the the the", "cat " * 900, "the cat sat", "q" * 100]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "mat"), (1, texts[1])]
    df = docs(spark, rows, extra=True)
    training = df["doc_id"] % 2 == 0
    got = sorted(map(tuple, ppm.score(df, training).collect()), key=repr)
    train = [t or "" for i, t in rows if i is not None and i % 2 == 0]
    counts = collections.Counter(w for t in train for w in [*ppm.tokens(t), b" "])
    total, kinds = sum(counts.values()), len(counts)
    want = []
    for (i, t), s in zip(rows, _brute(train, [t or "" for _, t in rows])):
        own = [*ppm.tokens(t or ""), b" "]
        want.append((i, len(own), sum(counts[w] > 0 for w in own), total, sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own), s))
    want.sort(key=repr)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-6)


def _brute_deep(training, texts, order):
    levels = collections.defaultdict(collections.Counter)
    pad = lambda t: bytes([ppm.BEGIN] * order) + t.encode() + bytes([ppm.END])
    for b in map(pad, training):
        for j in range(order, len(b)):
            for k in range(order + 1):
                levels[b[j - k:j]][b[j]] += 1

    def prob(b, j):
        left, out = set(range(256)) - {ppm.BEGIN}, 1.0
        for k in range(order, -1, -1):
            seen = {c: n for c, n in levels[b[j - k:j]].items() if c in left}
            total = sum(seen.values()) + len(seen)
            if b[j] in seen:
                return out * seen[b[j]] / total
            if seen:
                out *= len(seen) / total
            left -= set(seen)
        return out / len(left)

    return [sum(math.log10(prob(b, j)) for j in range(order, len(b))) for b in map(pad, texts)]


@pytest.mark.parametrize("held", [0, 30, 10**6])
def test_deeper_contexts_equal_brute_force(spark, monkeypatch, held):
    """Whether codes are held by the workers or joined."""
    monkeypatch.setattr(ppm, "HEAD_CODES", held)
    monkeypatch.setattr(ppm, "FLUSH_CODES", 10)
    texts = ["the cat sat", "The cat  sat\ton the mat", "ünï code", "", None, "zebra quilt 漢", "the the the", "cat " * 90, "the cat sat", "q" * 100, "abcde abcdf xbcde"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "mat"), (1, texts[1])]
    df = docs(spark, rows, extra=True)
    got = sorted(((r["doc_id"], r["score"]) for r in ppm.score(df, df["doc_id"] % 2 == 0, order=4).collect()), key=repr)
    train = [t or "" for i, t in rows if i is not None and i % 2 == 0]
    want = sorted(zip([i for i, _ in rows], _brute_deep(train, [t or "" for _, t in rows], 4)), key=repr)
    assert [g[0] for g in got] == [w[0] for w in want] and np.allclose([g[1] for g in got], [w[1] for w in want], rtol=1e-9)


def test_probabilities_sum_to_one():
    codes, _ = ppm._symbols(["abracadabra", "ünï"])
    code, n = np.unique(codes[(codes & 0xFF) != ppm.BEGIN], return_counts=True)
    table = 10.0 ** ppm.probabilities(code, n).reshape(256, 256, 256)
    table[:, :, ppm.BEGIN] = 0
    sums = table[[97, 98, 0, 200], [98, 114, 7, 97]].sum(1)
    assert np.allclose(sums, 1, atol=1e-5)


def test_partial_matching_without_training(spark):
    df = docs(spark, [(1, "ab"), (2, None)])
    rows = {r["doc_id"]: r for r in ppm.score(df, df["doc_id"] < 0).collect()}
    assert rows[1]["train_tokens"] == 0 and rows[1]["base_score"] == 0 and math.isclose(rows[1]["score"], 3 * math.log10(1 / 255), rel_tol=1e-6)
    assert ppm.score(docs(spark, [])).count() == 0


# --- toxicity -------------------------------------------------------------------


@pytest.fixture(scope="module")
def toxic_data():
    """Texts of plain words, half of them with a few from a list of bad ones."""
    rng = np.random.default_rng(1)
    syllables = ["th", "er", "in", "an", "re", "on", "at", "en", "nd", "ti", "es", "or", "te", "of", "ed"]
    plain = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(3000)]
    bad = ["blorgface", "quazwump", "zikfrotz", "vlumpkin"]
    texts, labels = [], []
    for i in range(700):
        own = rng.choice(plain, rng.integers(20, 200)).tolist()
        if i % 2:
            for _ in range(max(1, len(own) // 40)):
                own.insert(int(rng.integers(0, len(own))), str(rng.choice(bad)))
        texts.append(" ".join(own))
        labels.append(i % 2)
    return texts, labels, toxicity.train(texts[:500], labels[:500])


def test_toxicity_held_out(toxic_data):
    texts, labels, model = toxic_data
    got = np.array(toxicity.Scorer(model)(texts[500:])[0]) >= 0.5
    assert (got == np.array(labels[500:])).mean() > 0.97


def test_toxicity_between_windows():
    """Insults of long texts, all where every fifth window doesn't reach, are learnt."""
    rng = np.random.default_rng(4)
    plain = ["".join(rng.choice(list("aeioulnrst"), 6)) for _ in range(600)]
    texts = []
    for i in range(60):
        own = rng.choice(plain, 1600).tolist()
        if i % 2:
            for at in range(25, 1600, 80):
                own[at] = "zwompgax"
        texts.append(" ".join(own))
    scorer = toxicity.Scorer(toxicity.train(texts, [i % 2 for i in range(60)]))
    words = rng.choice(plain, 15).tolist()
    clean, bad = scorer([" ".join(words), " ".join([*words, "zwompgax"])])[0].to_pylist()
    assert clean < 0.5 < bad


def test_toxicity_of_rare_words():
    """Words in four of two thousand documents are learnt."""
    rng = np.random.default_rng(5)
    plain = ["".join(rng.choice(list("aeioulnrst"), 6)) for _ in range(30)]
    rare = ["".join(rng.choice(list("bcdfghjkmpqvwxyz"), 9)) for _ in range(50)]
    texts = [" ".join([*rng.choice(plain, 12), *([rare[i % 50]] if i < 200 else [])]) for i in range(2000)]
    scorer = toxicity.Scorer(toxicity.train(texts, [int(i < 200) for i in range(2000)]))
    without = [" ".join(rng.choice(plain, 12)) for _ in rare]
    before, after = (scorer(t)[0].to_numpy() for t in (without, [f"{t} {w}" for t, w in zip(without, rare)]))
    assert np.mean(after > before) > 0.9


def test_toxicity_of_misspellings(toxic_data):
    texts, labels, model = toxic_data
    clean = [t for t, y in zip(texts[500:], labels[500:]) if not y][:40]
    score = toxicity.Scorer(model)
    found = [np.mean(np.array(score([t + w for t in clean])[0]) >= 0.5) for w in ("", " blorgfacex", " quazwumps", " zzikfrotz")]
    assert found[0] < 0.05 and min(found[1:]) > 0.7  # none of these words was in the training texts


def test_toxicity_edge_cases(spark, toxic_data):
    texts, labels, model = toxic_data
    rows = [(1, None), (2, ""), (3, "..."), (None, texts[1]), (5, texts[1]), (5, texts[1]), (6, "there an " * 50_000 + "blorgface quazwump"), (7, "blorgface")]
    df = docs(spark, rows, extra=True)
    got = toxicity.score(df, model).collect()
    by = {r["doc_id"]: (r["score"], r["predicted"]) for r in got}
    assert len(got) == len(rows) and by[1] == by[2] == by[3] and by[1][1] == 0
    assert by[5] == by[None] and by[5][1] == by[6][1] == by[7][1] == 1
    assert all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(docs(spark, []), model).count() == 0


def test_toxicity_fit(spark, toxic_data):
    texts, labels, _ = toxic_data
    df = docs(spark, list(enumerate(texts)), extra=True)
    marks = spark.createDataFrame([*enumerate(labels), (None, 1), (9999, 1), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(df, marks)
    assert (np.array(toxicity.Scorer(model)(texts)[0]) >= 0.5).astype(int).tolist() == pytest.approx(labels, abs=1)
    empty = toxicity.fit(df, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert [r["predicted"] for r in toxicity.score(docs(spark, [(1, "a b")]), empty).collect()] == [0]


def test_sample_of_a_repeated_id_is_bounded(spark, monkeypatch):
    """An id of many rows serves with one text, the same whatever their order; null labels and ids do not serve."""
    rows = [(1, f"text number {i} of one id") for i in range(5000)] + [(2, "another"), (None, "no id"), (3, None)]
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels: seen.append((texts, labels)) or toxicity.Model(np.zeros(2), 0.0))
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 1), (None, 1), (4, None)], "doc_id bigint, toxic int")
    for order in (rows, rows[::-1]):
        toxicity.fit(spark.createDataFrame(order, "doc_id bigint, text string"), labels)
    assert seen[0] == seen[1] and seen[0][1] == [1, 0] and seen[0][0][1] == "another"


def test_a_diverged_model_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "train", lambda texts, labels: toxicity.Model(np.array([0.0, np.nan]), 0.0))
    df = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    with pytest.raises(ValueError, match="not finite"):
        toxicity.fit(df, spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int"))


def test_least_hashes(spark):
    """The least numbers of each label, copies counted once, few and many rows."""
    rng = random.Random(2)
    rows = [(label, rng.getrandbits(64) - (1 << 63)) for label, n in (("a", 4000), ("b", 30), (None, 5)) for _ in range(n)]
    rows += rows[:1] * 3000
    got = least_hashes(spark.createDataFrame(rows, "label string, h long"), "label", "h", F.when(F.col("label") == "a", 50).otherwise(20)).collect()
    want = [(label, h) for label, most in (("a", 50), ("b", 20)) for h in sorted({h for k, h in rows if k == label})[:most]]
    assert sorted(map(tuple, got)) == sorted(want)
