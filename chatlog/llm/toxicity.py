"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams, a window the average over its WINDOW
places, where a repeated word and an empty place add nothing, and softmax(W window + b) its
class. A misspelt word shares most n-grams with the word it came from. A document is as toxic as
its most toxic window, so a long clean text hides nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chatlog.llm.common import bucket_of, least_hashes
from chatlog.llm.workers import KEEP_WORDS, map_texts, row_means, subword_ids, word_list

SIZES, BITS, DIM = (3, 4, 5), 16, 4
WINDOW, STEP = 16, 8
#: Bounds of the training sample: documents by class, code points of each.
SAMPLE_DOCS, SAMPLE_CHARS = {0: 2400, 1: 1200}, 20_000
#: Training: rounds, steps of each, windows per step, rate, and decay of vectors.
ROUNDS, STEPS, BATCH, RATE, DECAY = 3, 150, 1024, 0.05, 1e-6
#: N-grams in fewer of the sampled documents carry nothing.
MIN_DOCS = 3


@dataclass
class Model:
    gram: np.ndarray  # what an n-gram adds to the log-odds, by bucket: vectors times (W[:, 1] - W[:, 0])
    bias: float


def _window_starts(n: int) -> list[int]:
    return [*range(0, max(1, n - WINDOW + 1), STEP), *([n - WINDOW] if n > WINDOW and (n - WINDOW) % STEP else [])]


def _adam(params: list[np.ndarray], state: list, grads: list[np.ndarray], t: int) -> None:
    for p, (m, v), g in zip(params, state, grads):
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        p -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)


def _ranges(begins: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All places begins[r] .. begins[r + 1] - 1 of the given rows, in their order."""
    sizes = begins[rows + 1] - begins[rows]
    return np.repeat(begins[rows] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _sums(index: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    return np.stack([np.bincount(index, column, rows) for column in values.T], 1)


def train(texts: list[str], labels: list[int], seed: int = 7) -> Model:
    """Fit on all windows of labelled texts.

    All windows of a clean text are clean. Of a toxic text all windows count as toxic in the
    first round and its most toxic one in the others.
    """
    names: dict[bytes, int] = {}
    windows, owner, in_docs = [], [], np.zeros(1 << BITS, np.int64)
    for d, text in enumerate(texts):
        ids = [names.setdefault(w, len(names)) for w in word_list(text)]
        for s in _window_starts(len(ids)) if ids else []:
            windows.append(sorted(set(ids[s:s + WINDOW])))
            owner.append(d)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (1 << BITS, DIM))
    weights, bias = rng.normal(0, 0.1, (DIM, 2)), np.zeros(2)
    if not windows or len(set(labels)) < 2:
        share = (sum(labels) + 0.5) / (len(labels) + 2)
        return Model(np.zeros(1 << BITS), float(np.log(share / (1 - share))))
    word, bucket = subword_ids(list(names), SIZES, BITS)
    begins = np.searchsorted(word, np.arange(len(names) + 1))
    for text in texts:
        grams = [bucket[begins[i]:begins[i + 1]] for i in {names[w] for w in word_list(text)}]
        in_docs[np.unique(np.concatenate([*grams, bucket[:0]]))] += 1
    known = (in_docs >= MIN_DOCS)[:, None]
    vectors *= known
    owner, y_doc = np.array(owner), np.array(labels)
    sizes = np.fromiter(map(len, windows), np.int64)
    places, flat = np.concatenate(([0], np.cumsum(sizes))), np.concatenate(windows)
    params = [vectors, weights, bias]
    state, t = [(np.zeros_like(p), np.zeros_like(p)) for p in params], 0
    chosen = np.arange(len(windows))
    for turn in range(ROUNDS):
        if turn:
            odds = row_means(word, (vectors @ (weights[:, 1] - weights[:, 0]))[bucket], len(names))
            score = np.bincount(np.repeat(np.arange(len(windows)), sizes), odds[flat], len(windows))
            order = np.lexsort((-score, owner))
            top = order[np.r_[True, owner[order][1:] != owner[order][:-1]]]
            chosen = np.union1d(np.flatnonzero(y_doc[owner] == 0), top[y_doc[owner[top]] == 1])
        toxic, clean = chosen[y_doc[owner[chosen]] == 1], chosen[y_doc[owner[chosen]] == 0]
        for _ in range(STEPS):
            t += 1  # as many toxic windows as clean ones
            batch = np.concatenate([rng.choice(toxic, BATCH // 2), rng.choice(clean, BATCH // 2)])
            col, row = flat[_ranges(places, batch)], np.repeat(np.arange(BATCH), sizes[batch])
            own, col = np.unique(col, return_inverse=True)
            at, of = bucket[_ranges(begins, own)], np.repeat(np.arange(len(own)), np.diff(begins)[own])
            per_word = np.maximum(np.diff(begins)[own], 1)[:, None]
            mean = _sums(row, (_sums(of, vectors[at], len(own)) / per_word)[col], BATCH) / WINDOW
            logits = mean @ weights + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(BATCH), np.repeat([1, 0], BATCH // 2)] -= 1
            p /= BATCH
            to_word = _sums(col, ((p @ weights.T) / WINDOW)[row], len(own)) / per_word
            to_gram = _sums(at, to_word[of], 1 << BITS) * known + DECAY * vectors
            _adam(params, state, [to_gram, mean.T @ p, p.sum(0)], t)
    return Model(vectors @ (weights[:, 1] - weights[:, 0]), float(bias[1] - bias[0]))


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.rows, self.odds = {}, np.zeros(0)

    def _learn(self, words: list[bytes]) -> None:
        word, bucket = subword_ids(words, SIZES, BITS)
        self.rows.update(zip(words, range(len(self.odds), len(self.odds) + len(words))))
        self.odds = np.concatenate([self.odds, row_means(word, self.model.gram[bucket], len(words))])

    def __call__(self, texts: list[str]) -> list[pa.Array]:
        if len(self.rows) > KEEP_WORDS:
            self._forget()
        lists = [word_list(t) for t in texts]
        if new := list(set().union(*lists).difference(self.rows)):
            self._learn(new)
        return [pa.array([self.score(words) for words in lists], pa.float64())]

    def score(self, words: list[bytes]) -> float:
        """Probability of the most toxic window; without words, what the bias alone says."""
        rows, best = self.rows, 0.0
        if words:
            ids = np.array([rows[w] for w in words])
            order = np.argsort(ids, kind="stable")
            before = np.full(len(ids), -1)  # where the word stood last
            again = ids[order[1:]] == ids[order[:-1]]
            before[order[1:][again]] = order[:-1][again]
            starts = np.array(_window_starts(len(ids)))[:, None]
            places = np.minimum(starts + np.arange(min(WINDOW, len(ids))), len(ids) - 1)
            best = float((self.odds[ids[places]] * (before[places] < starts)).sum(1).max()) / WINDOW
        return 1 / (1 + math.exp(-min(700.0, max(-700.0, self.model.bias + best))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Train on up to SAMPLE_DOCS documents by class, of at most SAMPLE_CHARS code points.

    Only rows with a label of 0 or 1, an id and a text serve; which of them is settled by a hash
    of the id. An id that several rows have serves with one of its texts. The sample is bounded, so it is
    trained on the driver.
    """
    marked = labels.filter(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y"))
    marked = marked.groupBy("_id").agg(F.max("_y").alias("_y"))
    texts = docs.filter(F.length(text_col).between(1, SAMPLE_CHARS)).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    able = texts.select("_id").join(marked, "_id").select("_y", F.xxhash64("_id").alias("_h"))
    ids = least_hashes(able, "_y", "_h", F.when(F.col("_y") == 1, SAMPLE_DOCS[1]).otherwise(SAMPLE_DOCS[0]))
    chosen = texts.withColumn("_h", F.xxhash64("_id")).join(F.broadcast(ids), "_h").groupBy("_id").agg(  # one text an id: its least by digest
        F.min_by("_text", F.struct(F.xxhash64("_text"), "_text")).alias("_text"), F.first("_y").alias("_y"))
    rows = sorted(chosen.collect(), key=lambda r: (r["_id"], r["_text"]))
    model = train([r["_text"] for r in rows], [int(r["_y"]) for r in rows])
    if not all(np.isfinite(part).all() for part in vars(model).values() if isinstance(part, (float, np.ndarray))):
        raise ValueError("the training diverged: a weight is not finite")
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per document row: the columns in `keep` (the id alone), score, predicted.

    Null and empty texts, and those without words, get the score of the bias. Rows are
    independent: repeated rows, null ids and further columns make no difference.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [F.col(c) for c in (keep or [id_col])]
    rows = docs.select(*kept, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_scored_text"))
    out = map_texts(rows, lambda: Scorer(sent.value), "_score double")
    score = F.col("_score")
    return out.select(*rows.columns[:-1], score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def held_out(id_col: str = "doc_id"):
    return bucket_of(id_col, 5) == 0
