"""Helpers for code that runs on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, types as T

#: Texts come in batches of this many rows at most, and are handled in parts of about this many bytes.
BATCH_ROWS, PART_BYTES = 1000, 2 << 20
#: Bytes as word characters: A-Z lower-cased, all that stands between words a space.
WORD_BYTES = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
#: Growing memories of a worker are emptied beyond this many entries.
KEEP_WORDS = 200_000


def word_list(text: str) -> list[bytes]:
    """The words of a text, as `common.words` finds them."""
    return text.encode().translate(WORD_BYTES).split()


def parts(batch: pa.RecordBatch, text: int, limit: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about `limit` bytes of text each, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, before = 0, 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, end - at)
        at, before = end, int(ends[end - 1])


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch to BATCH_ROWS rows: a batch of long texts is held several times."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def map_texts(
    rows: DataFrame, make: Callable[[], Callable[[list[str]], list[pa.Array]]], added: str, part_bytes: int = PART_BYTES
) -> DataFrame:
    """`rows`, whose last column is the text, with that column replaced by those `added`.

    `make` is called once per task and returns the function from texts to arrays. Other
    columns pass through as they came. Nothing is shuffled.
    """
    bounded_batches(rows.sparkSession)
    schema = T.StructType([*rows.schema.fields[:-1], *T.StructType.fromDDL(added).fields])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in parts(batch, batch.num_columns - 1, part_bytes):
                made = work(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=names)

    return rows.mapInArrow(run, schema)


def subword_ids(words: list[bytes], sizes: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every character n-gram of <word>, by bytes; buckets are `bits` wide.

    Words are laid out in tables by length, so one long word doesn't widen all rows.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    every_word, every_bucket = [], []
    for width in (1 << k for k in range(2, 40)):
        rows = np.flatnonzero((lengths <= width) & ((lengths > width // 2) | (width == 4)))
        if len(rows):
            flat = np.zeros((len(rows), width + 2), np.uint8)
            flat[:, 0] = 60
            flat[:, 1:-1] = np.array([words[r] for r in rows], f"S{width}").view(np.uint8).reshape(len(rows), width)
            flat[np.arange(len(rows)), lengths[rows] + 1] = 62
            for n in sizes:
                spots = width + 3 - n
                if spots <= 0:
                    continue
                h = np.full((len(rows), spots), 0x811C9DC5 + n, np.uint32)
                for j in range(n):
                    h = (h ^ flat[:, j:j + spots]) * np.uint32(0x01000193)
                h ^= h >> np.uint32(15)
                h = (h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - bits)
                w, s = np.nonzero(np.arange(spots) <= (lengths[rows] + 2 - n)[:, None])
                every_word.append(rows[w])
                every_bucket.append(h[w, s].astype(np.int64))
        if not (lengths > width).any():
            break
    if not every_word:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word, bucket = np.concatenate(every_word), np.concatenate(every_bucket)
    order = np.argsort(word, kind="stable")
    return word[order], bucket[order]


def row_means(index: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Mean of `values` per row number; 0 for rows without any."""
    n = np.maximum(np.bincount(index, minlength=rows), 1)
    if values.ndim == 1:
        return np.bincount(index, values, rows) / n
    return np.stack([np.bincount(index, c, rows) for c in values.T], 1) / n[:, None]
