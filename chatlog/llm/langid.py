"""Language of the words of code-switched text: a linear-chain conditional random field.

A word's scores sum learnt weights of its character n-grams (with word edges, so prefixes and
suffixes are among them) and, if the lexicon has it, of the word itself. Learnt transitions
tie neighbours. Forward-backward gives each word's distribution over languages; a document's
language is the one with the largest mean share.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chatlog.llm.common import bucket_of, least_hashes
from chatlog.llm.workers import KEEP_WORDS, map_texts, row_means, subword_ids, word_list

SIZES, BITS = (1, 2, 3, 4), 16
#: Bounds of the training sample: documents per language and code points of each.
SAMPLE_DOCS, SAMPLE_CHARS = 300, 20_000
#: Training sequences: so many, of so many words, changing language at a word with this chance.
SEQUENCES, LENGTH, SWITCH = 5000, 40, 0.05
EPOCHS, RATE, DECAY = 40, 0.3, 1e-6
UNKNOWN = "und"
#: Texts that step together: the longest sets the number of steps.
PART_BYTES = 8 << 20


@dataclass
class Model:
    langs: list[str]
    gram: np.ndarray  # bucket x language
    lexicon: dict[bytes, int]
    word: np.ndarray  # lexicon entry x language
    start: np.ndarray
    change: np.ndarray  # from language x to language, log weights


def _share(psi: list[np.ndarray], start: np.ndarray, change: np.ndarray, pairs: bool = False):
    """Marginals by position for sequences sorted by falling length; psi[t] holds those longer than t.

    With `pairs`, also the expected number of each change.
    """
    n, size = len(psi), psi[0].shape
    ahead = [None] * n
    a = start * psi[0]
    for t in range(n):
        if t:
            a = (ahead[t - 1][:len(psi[t])] @ change) * psi[t]
        ahead[t] = a = a / a.sum(1, keepdims=True)
    back, out, total = np.ones(size), [None] * n, np.zeros(change.shape)
    for t in range(n - 1, -1, -1):
        if t + 1 < n:
            k = len(psi[t + 1])
            seen = psi[t + 1] * back[:k]
            if pairs:
                joint = ahead[t][:k, :, None] * change * seen[:, None, :]
                total += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            b = seen @ change.T
            back[:k] = b / b.sum(1, keepdims=True)
        m = ahead[t] * back[:len(psi[t])]
        out[t] = m / m.sum(1, keepdims=True)
    return (out, total) if pairs else out


def train(texts: list[str], langs: list[str], seed: int = 5) -> Model | None:
    """Fit on sequences that are put together from stretches of texts of known language.

    None if there is no word to learn from.
    """
    names = sorted(set(langs))
    pools = {k: [w for t, lang in zip(texts, langs) if lang == k for w in word_list(t)] for k in names}
    names = [k for k in names if pools[k]]
    if not names:
        return None
    rng, size = np.random.default_rng(seed), len(names)
    vocabulary = {w: i for i, w in enumerate(sorted({w for k in names for w in pools[k]}))}
    pool = [np.array([vocabulary[w] for w in pools[k]]) for k in names]
    y = np.zeros((LENGTH, SEQUENCES), np.int64)
    y[0] = rng.integers(0, size, SEQUENCES)
    for t in range(1, LENGTH):
        y[t] = np.where(rng.random(SEQUENCES) < SWITCH, rng.integers(0, size, SEQUENCES), y[t - 1])
    sizes = np.array([len(p) for p in pool])
    base, shift = np.concatenate(pool), np.concatenate(([0], np.cumsum(sizes)[:-1]))
    place = (rng.random(SEQUENCES) * (1 << 40)).astype(np.int64) + np.arange(LENGTH)[:, None]
    x = base[shift[y] + place % sizes[y]]
    used, x = np.unique(x, return_inverse=True)
    x = x.reshape(y.shape)
    ordered = sorted(vocabulary, key=vocabulary.get)
    words = [ordered[i] for i in used]
    row, bucket = subword_ids(words, SIZES, BITS)
    per_word = np.maximum(np.bincount(row, minlength=len(words)), 1)
    plain = np.array([w.isdigit() for w in words])
    often = np.bincount(x.ravel(), minlength=len(words)) >= 3
    params = [np.zeros((1 << BITS, size)), np.zeros((len(words), size)), np.zeros(size), np.eye(size) * 2.0]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    gram, own, start, change = params
    first, follow = np.bincount(y[0], minlength=size), np.zeros((size, size))
    np.add.at(follow, (y[:-1].ravel(), y[1:].ravel()), 1)
    for step in range(1, EPOCHS + 1):
        scores = (row_means(row, gram[bucket], len(words)) + own) * ~plain[:, None]
        e = scores[x]
        psi = list(np.exp(e - e.max(2, keepdims=True)))
        shares, moved = _share(psi, np.exp(start), np.exp(change), pairs=True)
        error = np.stack(shares)
        begun = error[0].sum(0)
        error[np.arange(LENGTH)[:, None], np.arange(SEQUENCES), y] -= 1
        flat = error.reshape(-1, size)
        to_word = np.stack([np.bincount(x.ravel(), flat[:, k], len(words)) for k in range(size)], 1) * ~plain[:, None] / y.size
        share = to_word / per_word[:, None]
        to_gram = np.stack([np.bincount(bucket, share[row, k], 1 << BITS) for k in range(size)], 1)
        grads = [to_gram + DECAY * gram, to_word * often[:, None] + DECAY * own, (begun - first) / y.size, (moved - follow) / y.size]
        for p, (m, v), g in zip(params, moments, grads):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    kept = np.flatnonzero(often)
    return Model(names, gram, {words[i]: n for n, i in enumerate(kept)}, own[kept], start, change)


class Labeler:
    """Word labels and document shares for lists of texts."""

    def __init__(self, model: Model | None, runs: bool = False):
        self.model, self.runs = model, runs
        if model:
            self._forget()

    def _forget(self) -> None:
        self.rows, self.table = {}, np.zeros((1, len(self.model.langs)))

    def _learn(self, words: list[bytes]) -> None:
        m = self.model
        row, bucket = subword_ids(words, SIZES, BITS)
        scores = row_means(row, m.gram[bucket], len(words))
        listed = [(i, m.lexicon[w]) for i, w in enumerate(words) if w in m.lexicon]
        if listed:
            at, entry = np.array(listed).T
            scores[at] += m.word[entry]
        scores[[i for i, w in enumerate(words) if w.isdigit()]] = 0
        begin = len(self.table)
        self.table = np.concatenate([self.table, np.exp(scores - scores.max(1, keepdims=True))])
        self.rows.update(zip(words, range(begin, begin + len(words))))

    def shares(self, texts: list[str]) -> list[np.ndarray]:
        """For each text, the distribution over languages of each of its words."""
        if len(self.rows) > KEEP_WORDS:
            self._forget()
        ids, rows = [], self.rows
        lists = [word_list(t) for t in texts]
        if new := list(set().union(*lists).difference(rows)):
            self._learn(new)
        for words in lists:
            ids.append(np.array([rows[w] for w in words], np.int64))
        out: list[np.ndarray] = [np.zeros((0, self.table.shape[1]))] * len(texts)
        lengths = np.array([len(i) for i in ids])
        start, change = np.exp(self.model.start), np.exp(self.model.change)
        # Texts of like length go together, so few steps run over few texts.
        for low in (1 << k for k in range(0, 40, 2)):
            some = np.flatnonzero((lengths >= low) & (lengths < 4 * low))
            some = some[np.argsort(-lengths[some], kind="stable")]
            if not len(some):
                continue
            live = np.searchsorted(-lengths[some], -np.arange(lengths[some[0]]), "left")
            begin = np.concatenate(([0], np.cumsum(live)))
            place = [begin[:lengths[d]] + i for i, d in enumerate(some)]
            by_step = np.zeros(begin[-1], np.int64)
            for d, p in zip(some, place):
                by_step[p] = ids[d]
            psi = np.split(self.table[by_step], begin[1:-1])
            flat = np.concatenate(_share(psi, start, change))
            for d, p in zip(some, place):
                out[d] = flat[p]
        return out

    def __call__(self, texts: list[str]) -> list[pa.Array]:
        known = [self.model is not None and any(map(str.isalpha, t)) for t in texts]
        shares = self.shares(texts) if self.model else [None] * len(texts)
        langs, scores, parts, sizes = [], [], [], []
        for ok, s in zip(known, shares):
            mean = s.mean(0) if ok else None
            best = int(mean.argmax()) if ok else -1
            langs.append(self.model.langs[best] if ok else UNKNOWN)
            scores.append(float(min(1.0, mean[best])) if ok else 0.0)
            if self.runs:
                label = s.argmax(1) if ok else np.zeros(0, np.int64)
                cut = np.flatnonzero(np.r_[True, label[1:] != label[:-1]]) if len(label) else np.zeros(0, np.int64)
                parts.append([self.model.langs[k] for k in label[cut]])
                sizes.append(np.diff(np.r_[cut, len(label)]).tolist())
        out = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
        return out + ([pa.array(parts, pa.list_(pa.string())), pa.array(sizes, pa.list_(pa.int32()))] if self.runs else [])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Train on up to SAMPLE_DOCS documents per language, of at most SAMPLE_CHARS code points.

    Rows without text or language are left out; which rows serve is settled by a hash of id and
    text, and equal rows count as one. The sample is bounded, so it is trained on the driver.
    """
    able = docs.filter(F.length(text_col).between(1, SAMPLE_CHARS) & F.col(lang_col).isNotNull())
    able = able.select(F.xxhash64(id_col, text_col).alias("_h"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
    chosen = least_hashes(able, "_lang", "_h", F.lit(SAMPLE_DOCS))
    rows = able.join(F.broadcast(chosen), ["_h", "_lang"]).dropDuplicates(["_h", "_lang"]).collect()
    rows.sort(key=lambda r: (r["_lang"], r["_h"]))
    return train([r["_text"] for r in rows], [r["_lang"] for r in rows])


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", runs: bool = False) -> DataFrame:
    """Per document row: id, lang_pred, score; with `runs`, also run_langs and run_words.

    The runs are stretches of words of one language. A text that is null, empty or without any
    letter is `und` with score 0; of equal shares the first language by name wins. Rows are
    independent: repeated rows, null ids and further columns make no difference.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_labelled_text"))
    return map_texts(rows, lambda: Labeler(sent.value, runs), "lang_pred string, score double" + ", run_langs array<string>, run_words array<int>" * runs, PART_BYTES)


def held_out(id_col: str = "doc_id"):
    return bucket_of(id_col, 3) == 1
