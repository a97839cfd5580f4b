"""Language-model scoring by prediction by partial matching over bytes.

The trie of byte contexts has `order` levels below the root. Up to ORDER it is kept as flat count
arrays; a deeper one, which grows with the input, as Spark tables by code, of which the workers
hold the most frequent codes and the others are joined. A symbol not seen after a context costs an escape (method C: as many escape counts as distinct
symbols), and the symbols already offered are excluded in the shorter context. Counts come
from all training documents, so a document's code length does not depend on other documents'
order. 0xFE and 0xFF, which no UTF-8 text holds, stand before and after each text.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chatlog.llm.common import bucket_of
from chatlog.llm.workers import bounded_batches, map_texts, parts
from chatlog.session import settled

#: Bytes of context. Two bound the trie by 256^3 counts, whatever the input, so it can be sent to every worker.
ORDER = 2
BEGIN, END = 0xFE, 0xFF
#: Frequent tokens whose counts every worker holds; the others are joined. Longer tokens are always joined.
HEAD_TOKENS, HEAD_BYTES = 131_072, 64
#: The key of the end of a document among the tokens; no token holds a space.
END_TOKEN = b" "
#: Frequent codes of deeper contexts that every worker holds.
HEAD_CODES = 1_000_000
FLUSH, FLUSH_CODES = 300_000, 1_000_000


def tokens(text: str) -> list[bytes]:
    """A-Z lower-cased, cut at ASCII white space."""
    return text.encode().lower().split()


def _symbols(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Context-and-symbol codes of all texts in a row, and where each text begins.

    Codes that reach over the border of two texts predict BEGIN; they are marked 0, as no text holds BEGIN.
    """
    rows = [bytes([BEGIN] * order) + t.encode() + bytes([END]) for t in texts]
    b = np.frombuffer(b"".join(rows) + bytes([BEGIN] * order), np.uint8).astype(np.uint32 if order <= ORDER else np.int64)
    codes = np.zeros(len(b) - order, b.dtype)
    for j in range(order + 1):
        codes |= b[j:j + len(codes)] << b.dtype.type(8 * (order - j))
    codes[b[order:] == BEGIN] = sum(BEGIN << 8 * j for j in range(order + 1))
    return codes, np.concatenate(([0], np.cumsum([len(r) for r in rows])))[:-1]


def count_contexts(texts: DataFrame) -> DataFrame:
    """(code, n) over the one column of texts, added up per task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, n = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for batch in batches:
            for part in parts(batch, 0):
                new, more = np.unique(_symbols(part.column(0).to_pylist())[0], return_counts=True)
                code, at = np.unique(np.concatenate([code, new]), return_inverse=True)
                n = np.bincount(at, np.concatenate([n, more])).astype(np.int64)
        real = (code & 0xFF) != BEGIN
        yield pa.RecordBatch.from_arrays([pa.array(code[real].astype(np.int32)), pa.array(n[real])], names=["code", "n"])

    return texts.mapInArrow(run, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def count_tokens(texts: DataFrame) -> DataFrame:
    """(token, n) over the one column of texts, ends included, added up per task before the shuffle."""
    def packed(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["token", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for part in parts(batch, 0):
                for text in part.column(0).to_pylist():
                    counts.update(tokens(text))
                    counts[END_TOKEN] += 1
                if len(counts) >= FLUSH:
                    yield packed(counts)
                    counts.clear()
        if counts:
            yield packed(counts)

    return texts.mapInArrow(run, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, most: int, able: Column) -> Column:
    """Holds for the most frequent of the rows that are `able`, `most` at most.

    Where they begin is read from a histogram of a few hundred steps of the counts' logarithm, so
    no task sorts or gathers the rows.
    """
    step = F.floor(F.log2("n") * 16)
    steps = sorted(counts.filter(able).groupBy(step.alias("step")).count().collect(), reverse=True)
    least, so_far = math.inf, 0
    for row in steps:
        so_far += row["count"]
        if so_far > most:
            break
        least = row["step"]
    return able & (step >= F.lit(float(least)))


def probabilities(code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log10 probability of each symbol after each context of two bytes, as a flat array by code."""
    trie = np.zeros((256, 256, 256), np.float32)  # first, second, symbol
    trie.reshape(-1)[code] = n
    pairs = trie.sum(0, dtype=np.float64)
    single = pairs.sum(0)
    alphabet = np.arange(256) != BEGIN
    fresh = alphabet & (single == 0)
    uniform = fresh / max(1, fresh.sum())
    for second in range(256):
        seen2 = pairs[second] > 0
        left1 = np.where(seen2, 0, single)
        total1, kinds1 = left1.sum(), (left1 > 0).sum()
        escape1 = kinds1 / (total1 + kinds1) if kinds1 else 1.0
        lowest = np.where(left1 > 0, left1 / max(1, total1 + kinds1), escape1 * uniform)
        counts = trie[:, second, :].astype(np.float64)
        seen3 = counts > 0
        total3, kinds3 = counts.sum(1), seen3.sum(1)
        escape3 = np.where(kinds3 > 0, kinds3 / np.maximum(1, total3 + kinds3), 1.0)
        total2, kinds2 = ~seen3 @ pairs[second], (~seen3 & seen2).sum(1)
        escape2 = np.where(kinds2 > 0, kinds2 / np.maximum(1, total2 + kinds2), 1.0)
        shorter = np.where(seen2, pairs[second] / np.maximum(1, total2 + kinds2)[:, None], escape2[:, None] * lowest)
        p = np.where(seen3, counts / np.maximum(1, total3 + kinds3)[:, None], escape3[:, None] * shorter)
        trie[:, second, :] = np.log10(np.maximum(p, 1e-300))
    trie[:, :, BEGIN] = 0  # the border between texts costs nothing
    return trie.reshape(-1)


def count_deep(texts: DataFrame, order: int) -> DataFrame:
    """(code, n) of contexts of `order` bytes and their symbol, added up per task before the shuffle."""
    def packed(code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        real = (code & 0xFF) != BEGIN
        return pa.RecordBatch.from_arrays([pa.array(code[real]), pa.array(n[real])], names=["code", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        code, n = none, none
        for batch in batches:
            for part in parts(batch, 0):
                new, more = np.unique(_symbols(part.column(0).to_pylist(), order)[0], return_counts=True)
                code, at = np.unique(np.concatenate([code, new]), return_inverse=True)
                n = np.bincount(at, np.concatenate([n, more])).astype(np.int64)
                if len(code) >= FLUSH_CODES:
                    yield packed(code, n)
                    code, n = none, none
        yield packed(code, n)

    return texts.mapInArrow(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def _short(order: int, code: str = "code") -> Column:
    """A code without the bytes of context beyond `order`."""
    return F.col(code).bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1).cast("bigint"))


def _levels(counts: DataFrame, order: int) -> list[tuple[DataFrame, DataFrame]]:
    """By order from 0: (code, n) and (context, total, kinds, low).

    low is how often the context's symbols follow its next shorter context, where they are excluded.
    """
    codes = [counts]
    for k in range(order - 1, -1, -1):
        codes.insert(0, settled(codes[0].groupBy(_short(k).alias("code")).agg(F.sum("n").alias("n"))))
    levels = []
    for k, own in enumerate(codes):
        own = own.withColumn("context", F.shiftright("code", 8))
        if k:
            shorter = codes[k - 1].select(F.col("code").alias("_shorter"), F.col("n").alias("_low"))
            own = own.withColumn("_shorter", _short(k - 1)).join(shorter, "_shorter")
        else:
            own = own.withColumn("_low", F.lit(0))
        levels.append((codes[k], settled(own.groupBy("context").agg(
            F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("_low").alias("low")))))
    return levels


def _unseen(wanted: DataFrame, levels: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(code, log) of distinct codes whose symbol did not follow their whole context."""
    order = len(levels) - 1
    for k, (codes, contexts) in enumerate(levels):
        small = F.broadcast if k < 2 else lambda table: table  # 256^2 rows at most
        if k < order:
            wanted = wanted.withColumn("_key", _short(k)).join(small(codes.select(F.col("code").alias("_key"), F.col("n").alias(f"_n{k}"))), "_key", "left").drop("_key")
        own = contexts.select(F.col("context").alias("_key"), *[F.col(c).alias(f"_{c}{k}") for c in ("total", "kinds", "low")])
        wanted = wanted.withColumn("_key", F.shiftright(_short(k), 8)).join(small(own), "_key", "left").drop("_key")
    number = lambda c: F.coalesce(F.col(c), F.lit(0))
    log = -F.log10(F.lit(255) - number("_kinds0"))
    for k in range(order + 1):
        total, kinds = number(f"_total{k}"), number(f"_kinds{k}")
        if k < order:
            total, kinds = total - number(f"_low{k + 1}"), kinds - number(f"_kinds{k + 1}")
        log = F.when(kinds > 0, F.log10(kinds / (total + kinds))).otherwise(0.0) + log
        if k < order:
            log = F.when(F.col(f"_n{k}").isNotNull(), F.log10(F.col(f"_n{k}") / (total + kinds))).otherwise(log)
    return wanted.select("code", log.alias("log"))


_TABLES: dict[str, np.ndarray] = {}


def _table(name: str, sent) -> np.ndarray:
    """The probabilities of one model, once per worker process."""
    if name not in _TABLES:
        _TABLES.clear()
        _TABLES[name] = probabilities(*sent.value[:2])
    return _TABLES[name]


def _held(codes: np.ndarray, begin: np.ndarray, known: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """Per text the sum over the codes held by the worker, and the others with their numbers."""
    own, at = np.unique(codes, return_inverse=True)
    log, other = np.zeros(len(own)), (own & 0xFF) != BEGIN  # the border between texts costs nothing
    if len(known):
        spot = np.minimum(np.searchsorted(known, own), len(known) - 1)
        found = known[spot] == own
        log[found] = logs[spot[found]]
        other &= ~found
    missed = np.flatnonzero(other[at])
    text = np.searchsorted(begin, missed, "right") - 1
    pair, often = np.unique(text * len(own) + at[missed], return_counts=True)
    offsets = pa.array(np.searchsorted(pair, np.arange(len(begin) + 1) * len(own)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (own[pair % len(own)], often)]
    return np.add.reduceat(log[at], begin), lists


def score(docs: DataFrame, training: Column | None = None, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, order: int = ORDER) -> DataFrame:
    """Per document row: `keep` (the id alone), n_tokens, n_known, train_tokens, base_score, score.

    The model learns from rows where `training` holds (null: it doesn't; all rows by default).
    score is its log10 probability of the text and its end, base_score that of the tokens and
    their end by add-one counts. Null and empty texts have only the end. Repeated rows count as
    often as they occur; without training rows all symbols are alike. Token counts are exact:
    those of the most frequent are held by the workers, the rest is joined. So are, beyond ORDER
    bytes of context, the codes of the model.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    learnt = (docs if training is None else docs.filter(training)).select(text.alias("_text"))
    deep = order > ORDER
    if deep:
        levels = _levels(settled(count_deep(learnt, order)), order)
        seen = levels[order][0].withColumn("context", F.shiftright("code", 8)).join(levels[order][1], "context")
        seen = settled(seen.select("code", "n", F.log10(F.col("n") / (F.col("total") + F.col("kinds"))).alias("log")))
        hot = _frequent(seen, HEAD_CODES, F.lit(True))
        grams = seen.filter(hot).select("code", F.col("log").alias("n")).toArrow().sort_by("code")  # HEAD_CODES rows at most
    else:
        grams = count_contexts(learnt).toArrow()  # 256^3 rows at most
    counts = settled(count_tokens(learnt))
    total, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = _frequent(counts, HEAD_TOKENS, F.octet_length("token") <= HEAD_BYTES)
    head = counts.filter(frequent).toArrow()  # HEAD_TOKENS rows at most
    known = dict(zip(head["token"].to_pylist(), head["n"].to_pylist()))
    name = uuid.uuid4().hex
    sent = spark.sparkContext.broadcast((grams["code"].to_numpy().astype(np.int64), grams["n"].to_numpy(), known))

    def make():
        table = None if deep else _table(name, sent)
        logs = {t: math.log10(n + 1) for t, n in sent.value[2].items()}

        def work(texts: list[str]) -> list[pa.Array]:
            codes, begin = _symbols(texts, order)
            if deep:
                probability, missed = _held(codes, begin, *sent.value[:2])
            else:
                probability, missed = np.add.reduceat(table[codes], begin, dtype=np.float64), []
            n_tokens, n_known, sums, rare, times = [], [], [], [], []
            for t in texts:
                own = tokens(t)
                own.append(END_TOKEN)
                found = [x for x in map(logs.get, own) if x is not None]
                n_tokens.append(len(own))
                n_known.append(len(found))
                sums.append(math.fsum(found))
                others = Counter([x for x in own if x not in logs]) if len(found) < len(own) else {}
                rare.append(list(others))
                times.append(list(others.values()))
            return [pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(sums, pa.float64()), pa.array(probability),
                    pa.array(rare, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64())), *missed]

        return work

    kept = [F.col(c) for c in (keep or [id_col])]
    rows = docs.select(*kept, text.alias("_scored_text"))
    kept = rows.columns[:-1]
    made = map_texts(rows, make, "_n bigint, _known bigint, _sum double, _ppm double, _rare array<binary>, _times array<bigint>"
                     + (", _codes array<bigint>, _often array<bigint>" if deep else ""))
    scored = settled(made.withColumn("_row", F.monotonically_increasing_id()))  # written, so the number stays
    rare = scored.filter(F.size("_rare") > 0).select("_row", F.explode(F.arrays_zip("_rare", "_times")).alias("x"))
    rare = rare.select("_row", F.col("x._rare").alias("token"), F.col("x._times").alias("times"))
    more = rare.join(counts.filter(~frequent), "token").groupBy("_row").agg(
        F.sum("times").alias("_more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("_plus"))
    if deep:
        codes = scored.filter(F.size("_codes") > 0).select("_row", F.explode(F.arrays_zip("_codes", "_often")).alias("x"))
        codes = codes.select("_row", F.col("x._codes").alias("code"), F.col("x._often").alias("often"))
        wanted = settled(codes.select("code").distinct().join(seen.filter(~hot).select("code", "log"), "code", "left"))
        logs = wanted.filter("log IS NOT NULL").unionByName(_unseen(wanted.filter("log IS NULL").select("code"), levels))
        rest = codes.join(logs, "code").groupBy("_row").agg(F.sum(F.col("often") * F.col("log")).alias("_rest"))
        scored = scored.join(rest, "_row", "left").withColumn("_ppm", F.col("_ppm") + F.coalesce("_rest", F.lit(0.0)))
    base = F.col("_sum") + F.coalesce("_plus", F.lit(0.0)) - F.col("_n") * F.lit(math.log10(total + kinds + 1))
    return scored.join(more, "_row", "left").select(
        *kept, F.col("_n").alias("n_tokens"), (F.col("_known") + F.coalesce("_more", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"), base.alias("base_score"), F.col("_ppm").alias("score"))


def held_out(id_col: str = "doc_id") -> Column:
    return bucket_of(id_col, 7) == 2
