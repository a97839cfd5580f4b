"""Incremental, reversible removal of lines that many documents share.

An index keeps, exactly, which documents hold which line keys, and how many do. Keys held by
at least `min_docs` documents are also in cuckoo filters, one per shard of the key space.
Documents can be inserted and deleted; both change the counts of the keys they hold, and keys
that cross the threshold enter or leave the filters; a filter that gets too full is built again, twice
as large, from the counts. Lookups ask the filters first, so only
lines that may be shared meet the exact counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chatlog.llm.common import ascii_lower, join_docs, keyed
from chatlog.llm.cuckoo import LOAD, Bank, Shard
from chatlog.session import settled

MIN_CHARS, MIN_DOCS, SHARDS = 20, 3, 1024
#: Filters of up to this many bytes are sent to every worker; beyond, keys go to their shard's filter.
SEND_BYTES = 64 << 20
#: White space that a key leaves out at both ends.
BLANK = " \t\n\x0b\x0c\r"
KEY = ["h1", "h2"]
FILTERS = "shard int, slots binary, stash array<bigint>, held bigint"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(_id, _th, pos, h1, h2) of every line whose key is long enough; `docs` as `keyed` gives them."""
    each = docs.select("_id", "_th", F.posexplode(_lines(F.col("_text"))).alias("pos", "_line"))
    # A short line cannot have a long key.
    each = each.filter(F.length("_line") >= min_chars).select("_id", "_th", "pos", F.btrim("_line", F.lit(BLANK)).alias("_line"))
    each = each.filter(F.length("_line") >= min_chars).select("_id", "_th", "pos", ascii_lower(F.col("_line")).alias("_key"))
    return each.select("_id", "_th", "pos", F.xxhash64("_key").alias("h1"), F.hash("_key").alias("h2"))


@dataclass(frozen=True)
class LineIndex:
    """refs (h1, h2, doc), counts (h1, h2, n, last) and filters (shard, slots, stash, held), in the shared folder.

    Ids are of type `id_type`, all whole numbers `bigint`; the greatest is meant in the order of that type.
    """

    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int = SHARDS
    min_chars: int = MIN_CHARS
    min_docs: int = MIN_DOCS
    id_type: str = "bigint"

    @classmethod
    def empty(cls, spark: SparkSession, id_type: str = "bigint", **sizes) -> "LineIndex":
        made = lambda schema: spark.createDataFrame([], schema)
        id_type = "bigint" if id_type in ("tinyint", "smallint", "int") else id_type
        return cls(made(f"h1 bigint, h2 int, doc {id_type}"), made(f"h1 bigint, h2 int, n bigint, last {id_type}"),
                   made(FILTERS), id_type=id_type, **sizes)

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> "LineIndex":
        """With the lines of these documents. A document without id is not counted; one that is in already counts once."""
        pairs = _keys(keyed(docs.filter(F.col(id_col).isNotNull()), id_col, text_col), self.min_chars)
        pairs = pairs.select(*KEY, F.col("_id").cast(self.id_type).alias("doc")).distinct()
        fresh = not self.refs.take(1)
        pairs = settled(pairs if fresh else pairs.join(self.refs, [*KEY, "doc"], "left_anti"))
        more = pairs.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("doc").alias("last"))
        if fresh:
            counts = settled(more.withColumn("_was", F.lit(0).cast("bigint")))
        else:
            both = self.counts.withColumn("_was", F.col("n")).unionByName(more.withColumn("_was", F.lit(0).cast("bigint")))
            counts = settled(both.groupBy(*KEY).agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.sum("_was").alias("_was")))
        risen = counts.filter((F.col("n") >= self.min_docs) & (F.col("_was") < self.min_docs))
        return replace(self, refs=pairs if fresh else self.refs.unionByName(pairs), counts=counts.drop("_was"),
                       filters=self._changed(risen.select(*KEY, F.lit(True).alias("enter")), None if fresh else counts))

    def delete(self, ids: DataFrame) -> "LineIndex":
        """Without the documents whose ids are in the one column of `ids`: as if they had never been inserted."""
        gone = ids.select(F.col(ids.columns[0]).cast(self.id_type).alias("doc")).distinct()
        lost = settled(self.refs.join(gone, "doc", "left_semi").select(*KEY).distinct())
        refs = settled(self.refs.join(gone, "doc", "left_anti").select(*KEY, "doc"))
        left = refs.join(lost, KEY, "left_semi").groupBy(*KEY).agg(F.count("*").alias("n"), F.max("doc").alias("last"))
        counts = settled(self.counts.join(lost, KEY, "left_anti").unionByName(left))
        was = self.counts.join(lost, KEY, "left_semi").filter(F.col("n") >= self.min_docs)
        fallen = was.select(*KEY).join(left.filter(F.col("n") >= self.min_docs), KEY, "left_anti")
        return replace(self, refs=refs, counts=counts, filters=self._changed(fallen.select(*KEY, F.lit(False).alias("enter"))))

    def _shard(self) -> Column:
        return F.pmod(F.col("h2"), F.lit(self.shards)).cast("int").alias("shard")

    def _changed(self, keys: DataFrame, counts: DataFrame | None = None) -> DataFrame:
        """The filters after keys have entered or left; from `counts` those are built again that get too full."""

        def change(keys: pa.Table, old: pa.Table) -> pa.Table:
            shard = (keys if keys.num_rows else old)["shard"][0].as_py()
            h, enter = keys["h1"].to_numpy(), keys["enter"].to_numpy().astype(bool)
            if old.num_rows and not (keys.num_rows and keys["rebuild"][0].as_py()):
                row = old.slice(0, 1).to_pylist()[0]
                own = Shard(np.frombuffer(row["slots"], np.uint16).reshape(-1, 4).copy(), row["stash"])
            else:
                own = Shard.sized(2 * len(h))
            own.delete(h[~enter])
            own.insert(h[enter])
            return pa.table({"shard": pa.array([shard], pa.int32()), "slots": pa.array([own.slots.tobytes()], pa.binary()),
                             "stash": pa.array([list(own.stash.elements())], pa.list_(pa.int64())), "held": pa.array([own.held], pa.int64())})

        dealt = keys.select(self._shard(), "h1", "enter", F.lit(False).alias("rebuild"))
        if counts is not None:
            dealt = settled(dealt)
            more = dealt.groupBy("shard").agg(F.count_if("enter").alias("more")).join(self.filters, "shard")
            room = LOAD * F.octet_length("slots") / 2  # slots of two bytes
            full = settled(more.filter(F.col("held") + F.col("more") > room).select("shard"))  # fewer rows than shards
            every = counts.filter(F.col("n") >= self.min_docs).select(self._shard(), "h1", F.lit(True).alias("enter"), F.lit(True).alias("rebuild"))
            dealt = dealt.join(full, "shard", "left_anti").unionByName(every.join(F.broadcast(full), "shard", "left_semi"))
        return settled(dealt.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(change, FILTERS))

    def _maybe(self, lines: DataFrame) -> DataFrame:
        """Those of `lines` (with h1, h2 among the columns) that the filters let pass."""
        size = self.filters.agg(F.coalesce(F.sum(F.octet_length("slots") + 8 * F.size("stash")), F.lit(0))).first()[0]
        if size <= SEND_BYTES:
            sent = lines.sparkSession.sparkContext.broadcast(Bank({
                r["shard"]: Shard(np.frombuffer(r["slots"], np.uint16).reshape(-1, 4), r["stash"]) for r in self.filters.toLocalIterator()}))
            shards, at = self.shards, [lines.columns.index(c) for c in KEY]

            def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    h1, h2 = (batch.column(i).to_numpy() for i in at)
                    yield batch.filter(pa.array(sent.value.contains(h2.astype(np.int64) % shards, h1)))

            return lines.mapInArrow(ask, lines.schema)

        def ask_one(keys: pa.Table, own: pa.Table) -> pa.Table:
            if not keys.num_rows or not own.num_rows:
                return keys.slice(0, 0).select(KEY)
            row = own.slice(0, 1).to_pylist()[0]
            shard = Shard(np.frombuffer(row["slots"], np.uint16).reshape(-1, 4), row["stash"])
            return keys.filter(pa.array(shard.contains(keys["h1"].to_numpy()))).select(KEY)

        # Distinct keys are spread evenly over the shards, however often a line occurs.
        keys = lines.select(self._shard(), *KEY).distinct().groupBy("shard")
        passed = keys.cogroup(self.filters.groupBy("shard")).applyInArrow(ask_one, "h1 bigint, h2 int")
        return lines.join(passed, KEY, "left_semi").select(*lines.columns)

    def dedup(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
        """Per document row: `keep` (the id alone), text, n_lines, n_dropped.

        Lines whose key is held by at least `min_docs` indexed documents stay only in the
        document with the largest id of them. Null text is one empty line. A document without id is
        never that one. Equal rows have equal results, once per row. Only lines with shared keys
        are shuffled, besides the documents themselves.
        """
        keep = keep or [id_col]
        d = keyed(docs, id_col, text_col)
        shared = self.counts.filter(F.col("n") >= self.min_docs).select(*KEY, "last")
        lines = self._maybe(_keys(d, self.min_chars)).join(shared, KEY)
        out = lines.filter(F.col("_id").isNull() | (F.col("_id").cast(self.id_type) < F.col("last")))
        out = out.groupBy("_id", "_th").agg(F.collect_set("pos").alias("_out"))
        d = keyed(docs, id_col, text_col, F.struct(*keep).alias("_kept"))
        d = join_docs(d, out).withColumn("_lines", _lines(F.col("_text")))
        stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_out")
        kept = F.when(F.col("_out").isNull(), F.col("_text")).otherwise(
            F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n"))
        return d.select(
            *[F.col("_kept")[c].alias(c) for c in keep], kept.alias(text_col), F.size("_lines").cast("bigint").alias("n_lines"),
            F.coalesce(F.size("_out"), F.lit(0)).cast("bigint").alias("n_dropped"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Index a whole corpus and remove its shared lines."""
    return LineIndex.empty(docs.sparkSession, docs.schema[id_col].dataType.simpleString()).insert(docs, id_col, text_col).dedup(docs, id_col, text_col, keep)
