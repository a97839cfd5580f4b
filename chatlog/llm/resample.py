"""Importance resampling towards a target corpus by hashed word runs.

Runs of words are hashed by CRC-32 with position tables. Without its start value CRC-32 is linear
over XOR: the checksum of a span is the XOR of what each byte contributes at its distance from the
end, and a constant that depends on the length. So all spans of a batch are hashed at once, by one
table look-up per byte and `bitwise_xor.reduceat` over the spans. Spans longer than the table are cut
into blocks from the end, and neighbouring blocks folded: the left one moved by a block's length of
zero bytes, which again is linear, then XORed with the right one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from chatlog.llm.numbering import number_rows
from chatlog.llm.workers import WORD_BYTES, bounded_batches, parts
from chatlog.session import settled

RUN, BUCKETS, SEED, LEAST_WORDS, PERCENT = 1, 10_000, 2024, 20, 10
#: Distances from the end that have a table.
DEPTH = 64
#: Bytes of text hashed at once.
HASH_BYTES = 1 << 20
POLYNOMIAL = 0xEDB88320


# --- checksums of many spans -----------------------------------------------------


def _byte_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = x >> np.uint32(1) ^ np.where(x & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    return x


_BYTE = _byte_table()


def _position_table() -> np.ndarray:
    """[distance from the end, byte] -> contribution."""
    rows = [_BYTE]
    for _ in range(DEPTH - 1):
        rows.append(rows[-1] >> np.uint32(8) ^ _BYTE[rows[-1] & np.uint32(255)])
    return np.stack(rows)


_POSITION = _position_table().ravel()
_LENGTH = np.array([zlib.crc32(bytes(n)) for n in range(DEPTH + 1)], np.uint32)


def _moved(state: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Checksum states after zero bytes; `move` has a row of 256 per byte of a state."""
    return (move[0][state & np.uint32(255)] ^ move[1][state >> np.uint32(8) & np.uint32(255)]
            ^ move[2][state >> np.uint32(16) & np.uint32(255)] ^ move[3][state >> np.uint32(24)])


def _move_table() -> np.ndarray:
    """The table that moves a state by DEPTH zero bytes."""
    state = np.arange(256, dtype=np.uint32)[None] << np.array([[0], [8], [16], [24]], np.uint32)
    for _ in range(DEPTH):
        state = state >> np.uint32(8) ^ _BYTE[state & np.uint32(255)]
    return state


_MOVE = _move_table()


def _plain(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XOR of contributions per span of 1 to DEPTH bytes."""
    lengths = ends - starts
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    left = np.repeat(lengths + first, lengths) - np.arange(int(lengths.sum())) - 1  # distance from the end
    byte = data[np.repeat(ends - 1, lengths) - left]
    return np.bitwise_xor.reduceat(_POSITION[(left << 8) + byte], first)


def span_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of each span data[start:end]; an empty span has 0."""
    out = np.zeros(len(starts), np.uint32)
    lengths = ends - starts
    short = np.flatnonzero((lengths > 0) & (lengths <= DEPTH))
    if len(short):
        out[short] = _plain(data, starts[short], ends[short]) ^ _LENGTH[lengths[short]]
    long = np.flatnonzero(lengths > DEPTH)
    if len(long):
        blocks = -(-lengths[long] // DEPTH)
        span = np.repeat(np.arange(len(long)), blocks)
        from_end = np.repeat(np.cumsum(blocks), blocks) - np.arange(len(span)) - 1
        end = ends[long][span] - from_end * DEPTH
        state = _plain(data, np.maximum(starts[long][span], end - DEPTH), end)
        move = _MOVE
        while from_end.any():
            state = np.where(from_end & 1, _moved(state, move), state)
            from_end = from_end >> 1
            pair = np.flatnonzero(np.concatenate(([True], (from_end[1:] != from_end[:-1]) | (span[1:] != span[:-1]))))
            state, span, from_end = np.bitwise_xor.reduceat(state, pair), span[pair], from_end[pair]
            move = _moved(move, move)
        zeros = {n: zlib.crc32(bytes(n)) for n in set(lengths[long].tolist())}
        out[long] = state ^ np.array([zeros[n] for n in lengths[long].tolist()], np.uint32)
    return out


# --- word runs of a batch --------------------------------------------------------

_LOWER = np.frombuffer(WORD_BYTES, np.uint8)


def run_hashes(texts: pa.Array, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, runs of 1 to `run` words per text, and the checksum of every run, text by text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
    data, bounds = _LOWER[raw], bounds - bounds[0]
    inside = data != 32
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edge = bounds[(bounds > 0) & (bounds < len(data))]  # texts follow each other without a space
    begins[edge] = inside[edge]
    stops[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    words = np.diff(np.searchsorted(starts, bounds))
    if run == 1:
        return words, words, span_crcs(data, starts, ends)
    lengths = ends - starts  # every word again, with one space behind it
    at = np.cumsum(lengths + 1) - lengths - 1
    joined = np.full(int((lengths + 1).sum()), 32, np.uint8)
    steps = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    joined[np.repeat(at, lengths) + steps] = data[np.repeat(starts, lengths) + steps]
    text = np.repeat(np.arange(len(words)), words)
    hashes, owner = [], []
    for n in range(1, run + 1):
        first = np.flatnonzero(text[:len(text) - n + 1] == text[n - 1:]) if len(text) >= n else np.zeros(0, np.int64)
        hashes.append(span_crcs(joined, at[first], at[first + n - 1] + lengths[first + n - 1]))
        owner.append(text[first])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return words, np.bincount(owner, minlength=len(words)), np.concatenate(hashes)[order]


def bucket_counts(texts: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of the one column of texts: each task counts on its own, then at most `buckets` rows a task meet."""
    bounded_batches(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in parts(batch, 0, HASH_BYTES):
                n += np.bincount(run_hashes(part.column(0), run)[2] % np.uint32(buckets), minlength=buckets)
        kept = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int32()), pa.array(n[kept])], names=["bucket", "n"])

    return texts.mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) for every bucket, from the bucket counts of the documents and of the target."""
    spark = docs.sparkSession
    both = docs.select("bucket", F.col("n").alias("s"), F.lit(0).cast("bigint").alias("t")).unionByName(
        target.select("bucket", F.lit(0).cast("bigint").alias("s"), F.col("n").alias("t")))
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("bigint").alias("s"), F.lit(0).cast("bigint").alias("t"))
    each = both.unionByName(every).groupBy("bucket").agg(F.sum("s").cast("double").alias("s"), F.sum("t").cast("double").alias("t"))
    sums = each.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = (F.col("t") + 1) * (F.col("all_s") + buckets) / ((F.col("s") + 1) * (F.col("all_t") + buckets))
    return each.join(F.broadcast(sums)).select("bucket", F.floor(F.log(ratio) * 1000).cast("bigint").alias("gain"))


def weigh(docs: DataFrame, gain: np.ndarray, run: int = RUN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _words, n_features, weight) per document: weight is the floored mean gain of its runs, 0 without any."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    bounded_batches(docs.sparkSession)
    schema = T.StructType([rows.schema.fields[0], *T.StructType.fromDDL("_words bigint, n_features bigint, weight bigint").fields])

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, 1, HASH_BYTES):
                words, n, hashes = run_hashes(part.column(1), run)
                ends = np.concatenate(([0], np.cumsum(gain[hashes % np.uint32(len(gain))])))
                at = np.concatenate(([0], np.cumsum(n)))
                weight = (ends[at[1:]] - ends[at[:-1]]) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(v.astype(np.int64)) for v in (words, n, weight)]], names=schema.fieldNames())

    return rows.mapInArrow(run_all, schema)


def noise(id_text: Column, seed: int) -> Column:
    """floor of 1000 times a Gumbel variable that only seed and id decide."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_text, F.lit(""))), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.log(-F.log((h + 0.5) / F.lit(4294967296.0))) * -1000).cast("bigint")


def resample(
    docs: DataFrame, target: DataFrame, run: int = RUN, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
    percent: int = PERCENT, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
) -> DataFrame:
    """Per document row: id, n_features, weight, score, rank.

    Features are all runs of 1 to `run` words. Of the N rows with at least `least_words` words the
    floor(percent * N / 100) of highest score are drawn, without replacement; they have ranks from 1 in
    order of score, ties to the smaller id, nulls first. Other rows have a null rank. Null and
    empty texts have no features, weight 0, and are never drawn unless `least_words` is 0. A null id
    draws its noise from an empty one. Rows repeated whole have neighbouring ranks. With an empty target all
    gains follow from the documents alone; an empty table gives no rows. Bucket counts and
    gains are `buckets` rows each, whatever the input; nothing else reaches the driver.
    """
    text = F.col(f"`{text_col}`").cast("string")
    wanted = target.select(F.col(f"`{target_text}`").cast("string").alias("_text"))
    table = gains(settled(bucket_counts(docs.select(text.alias("_text")), run, buckets)), bucket_counts(wanted, run, buckets), buckets)
    gain = np.zeros(buckets, np.int64)
    for bucket, value in table.collect():
        gain[bucket] = value
    score = F.col("weight") + noise(F.col("_id").cast("string"), seed)
    scored = settled(weigh(docs, gain, run, id_col, text_col).select(
        "_id", "n_features", "weight", score.alias("score"), (F.col("_words") >= least_words).alias("_able")))
    able = scored.filter("_able").count()
    numbered, _ = number_rows(scored, [F.col("_able").desc(), F.col("score").desc(), F.col("_id").asc_nulls_first()])
    drawn = F.col("_able") & (F.col("_at") < percent * able // 100)
    return numbered.select(F.col("_id").alias(id_col), "n_features", "weight", "score", F.when(drawn, F.col("_at") + 1).alias("rank"))


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **more) -> DataFrame:
    """The drawn rows of `docs` with all their columns; ids should be unique and not null."""
    chosen = resample(docs, target, id_col=id_col, **more).filter("rank IS NOT NULL").select(F.col(id_col).alias("_drawn"))
    return docs.join(chosen, F.col(f"`{id_col}`") == F.col("_drawn"), "left_semi")
