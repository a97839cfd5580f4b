"""Sharding by a keyed permutation of global row numbers.

Rows are numbered in the order of their ids. A Feistel network over the next power of four permutes
the numbers; a result beyond the last row is permuted again until it lies within (cycle walking), so
the network is a permutation of exactly 0 .. rows-1. Place p belongs to shard p mod k, slot p div k:
`locate` and `row_at` compute either side from the other with the number of rows and the seed alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from chatlog.llm.numbering import number_rows

SHARDS, SEED, ROUNDS = 16, 2024, 6
#: Arithmetic of the round function is modulo this prime; halves have at most 24 bits.
PRIME, FACTOR_1, FACTOR_2, HALF_BITS = (1 << 31) - 1, 1_000_003_333, 1_640_531_527, 24


def half_bits(rows: int) -> int:
    """Bits of each half, the fewest whose square of values holds all rows."""
    bits = max(1, ((rows - 1).bit_length() + 1) // 2)
    if bits > HALF_BITS:
        raise ValueError(f"{rows} rows are more than {1 << 2 * HALF_BITS}")
    return bits


def round_keys(seed: int) -> list[int]:
    return [int(hashlib.sha256(f"{seed}:{r}".encode()).hexdigest()[:8], 16) % PRIME for r in range(ROUNDS)]


def _mixed(half: np.ndarray, key: int, mask: int) -> np.ndarray:
    x = (half * FACTOR_1 + key) % PRIME
    x = ((x ^ x >> 15) * FACTOR_2 + key) % PRIME
    return (x ^ x >> 13) & mask


def permute(numbers: np.ndarray, rows: int, seed: int = SEED, back: bool = False) -> np.ndarray:
    """Each of `numbers` (0 .. rows-1) moved by the permutation, or `back` from where it was moved to."""
    bits, keys = half_bits(rows), round_keys(seed)
    mask = (1 << bits) - 1

    def network(v: np.ndarray) -> np.ndarray:
        left, right = v >> bits, v & mask
        for key in reversed(keys) if back else keys:
            if back:
                left, right = right ^ _mixed(left, key, mask), left
            else:
                left, right = right, left ^ _mixed(right, key, mask)
        return left << bits | right

    out = network(np.asarray(numbers, np.int64))
    while len(outside := np.flatnonzero(out >= rows)):
        out[outside] = network(out[outside])
    return out


def locate(numbers: np.ndarray, rows: int, shards: int = SHARDS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(shard, slot) of row numbers."""
    place = permute(numbers, rows, seed)
    return place % shards, place // shards


def row_at(shard: np.ndarray, slot: np.ndarray, rows: int, shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """The row numbers that stand at the given shards and slots."""
    return permute(np.asarray(slot, np.int64) * shards + shard, rows, seed, back=True)


def _numbered(docs: DataFrame, shards: int, seed: int, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """`_id`, `size`, `text_crc32`, `more`, `shard` and `slot`, one row per document."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    narrow = docs.select(F.col(f"`{id_col}`").alias("_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
                         F.crc32(text).alias("text_crc32"), *more)
    numbered, rows = number_rows(narrow, [F.col(c).asc_nulls_first() for c in narrow.columns])

    @F.pandas_udf("bigint")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), rows, seed))

    placed = numbered.withColumn("_place", place("_at"))
    return placed.withColumn("shard", (F.col("_place") % shards).cast("int")).withColumn(
        "slot", F.expr(f"_place div {shards}")).drop("_at", "_place")


def place(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: id, size, text_crc32, law, shard, slot, grown_shard.

    The law is `rows`: shards differ by one row at most, whatever the texts, and slots run from 0
    without a gap. Rows are numbered by id (nulls first), then size, then checksum; rows equal in
    all three follow each other, which of them is which makes no difference. Groups of equal texts are
    not kept together, as a group of a third of all rows fits no shard of this law: the permutation spreads
    them. The result depends on the rows, the seed and the number of shards only, not on files or partitions.
    Null text counts as empty: size 1, checksum 0. `grown_shard` is null, as one more shard would move
    rows between all. Columns other than id and text are not looked at. An empty table gives no rows.
    """
    out = _numbered(docs, shards, seed, id_col, text_col)
    return out.select(F.col("_id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id",
                 text_col: str = "text", rows_per_file: int = 100_000) -> None:
    """Write (shard, slot, id, text) as Parquet below `path`, a folder per shard, in the places of `place`.

    Files hold stretches of `rows_per_file` slots in order, so a shard is written by many tasks. Rows
    of one id and text are written once per repetition; null text is written as empty.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    key = ["_id", "size", "text_crc32", "_th"]
    placed = _numbered(docs, shards, seed, id_col, text_col, F.xxhash64(text).alias("_th"))
    texts = docs.select(F.col(f"`{id_col}`").alias("_id_b"), (F.octet_length(text) + 1).cast("bigint").alias("_size_b"),
                        F.crc32(text).alias("_crc_b"), F.xxhash64(text).alias("_th_b"), text.alias("_text"))
    texts = texts.dropDuplicates(["_id_b", "_size_b", "_crc_b", "_th_b"])
    same = F.lit(True)
    for a, b in zip(key, ["_id_b", "_size_b", "_crc_b", "_th_b"]):
        same = same & F.col(a).eqNullSafe(F.col(b))
    rows = placed.join(texts, same).select("shard", "slot", F.col("_id").alias(id_col), F.col("_text").alias(text_col))
    file = F.floor(F.col("slot") / rows_per_file)
    rows.withColumn("_file", file).repartition("shard", "_file").sortWithinPartitions("shard", "slot").drop("_file").write.partitionBy("shard").parquet(path)
