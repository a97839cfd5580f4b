"""Approximate nearest neighbours by inner product: a navigable small-world graph per shard.

Vectors are dealt to shards by their length, in ranges of a factor of two, and by a hash. Each shard has
a layered graph stored as flat neighbour arrays. One more coordinate makes all vectors of a shard
equally long, so that the largest inner product with a query is the least distance; within a range
it takes no precision from the others, however long the vectors of other ranges are. Every query
goes to every shard; the shards' results are scored exactly and merged. Shards of few rows
are searched whole.
"""

from __future__ import annotations

import math
from heapq import heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from chatlog.session import settled

SHARD_ROWS, QUERY_BLOCK = 8192, 4096
#: Tasks for each group of work, so that few groups share one by chance.
SPREAD = 4
LINKS, BUILD_WIDTH, SEARCH_WIDTH = 16, 100, 160
#: Shards of at most this many rows need no walk: all their rows are scored.
WHOLE_ROWS = 512


class Graph:
    """neighbours[level] is a flat array of `width(level)` places per node, -1 where unused."""

    def __init__(self, vectors: np.ndarray, levels: np.ndarray, neighbours: list[np.ndarray], entry: int):
        self.vectors, self.levels, self.neighbours, self.entry = vectors, levels, neighbours, entry
        self.seen, self.mark = np.zeros(len(vectors), np.int64), 0

    @staticmethod
    def width(level: int) -> int:
        return LINKS * 2 if level == 0 else LINKS

    def search(self, query: np.ndarray, width: int, starts: list[tuple[float, int]], level: int) -> list[tuple[float, int]]:
        """The `width` nodes nearest to the query that a best-first walk finds, as (nearness, node)."""
        self.mark += 1
        seen, mark, places, w = self.seen, self.mark, self.neighbours[level], self.width(level)
        ahead, best = [], []
        for s, i in starts:
            seen[i] = mark
            heappush(ahead, (-s, i))
            heappush(best, (s, i))
        while ahead:
            s, i = heappop(ahead)
            if -s < best[0][0] and len(best) >= width:
                break
            near = places[i * w:(i + 1) * w]
            near = near[near >= 0]
            near = near[seen[near] != mark]
            if not len(near):
                continue
            seen[near] = mark
            for t, j in zip((self.vectors[near] @ query).tolist(), near.tolist()):
                if len(best) < width:
                    heappush(best, (t, j))
                    heappush(ahead, (-t, j))
                elif t > best[0][0]:
                    heapreplace(best, (t, j))
                    heappush(ahead, (-t, j))
        return best

    def descend(self, query: np.ndarray, upto: int) -> list[tuple[float, int]]:
        at = [(float(self.vectors[self.entry] @ query), self.entry)]
        for level in range(int(self.levels[self.entry]), upto, -1):
            at = [max(self.search(query, 1, at, level))]
        return at

    def _chosen(self, nodes: np.ndarray, nearness: np.ndarray, most: int) -> np.ndarray:
        """Near and varied: a node nearer to one already chosen than to the centre waits."""
        order = np.argsort(-nearness, kind="stable")
        nodes, nearness = nodes[order], nearness[order]
        if len(nodes) <= most:
            return nodes
        own = self.vectors[nodes]
        among = own @ own.T
        taken, waiting, closest = [], [], np.full(len(nodes), -np.inf, np.float32)
        for k in range(len(nodes)):
            if closest[k] < nearness[k]:
                taken.append(k)
                if len(taken) == most:
                    break
                np.maximum(closest, among[k], out=closest)
            else:
                waiting.append(k)
        return nodes[taken + waiting[:most - len(taken)]]

    def _link(self, node: int, others: np.ndarray, level: int) -> None:
        w, places = self.width(level), self.neighbours[level]
        places[node * w:node * w + len(others)] = others
        for j in others.tolist():
            row = places[j * w:(j + 1) * w]
            n = int((row >= 0).sum())
            if n < w:
                row[n] = node
            else:
                all_of = np.append(row, node)
                kept = self._chosen(all_of, self.vectors[all_of] @ self.vectors[j], w)
                row[:] = -1
                row[:len(kept)] = kept

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 3) -> "Graph":
        rng = np.random.default_rng(seed)
        levels = np.minimum((-np.log(1 - rng.random(len(vectors))) / math.log(LINKS)).astype(np.int64), 12)
        graph = cls(vectors, levels, [np.full(len(vectors) * cls.width(k), -1, np.int32) for k in range(int(levels.max()) + 1)], 0)
        for node in range(1, len(vectors)):
            query, level = vectors[node], int(levels[node])
            at = graph.descend(query, level)
            for k in range(min(level, int(levels[graph.entry])), -1, -1):
                at = graph.search(query, BUILD_WIDTH, at, k)
                graph._link(node, graph._chosen(np.array([i for _, i in at]), np.array([s for s, _ in at], np.float32), LINKS), k)
            if level > levels[graph.entry]:
                graph.entry = node
        return graph


def usable(vector: str) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(~bad & F.exists(x, lambda v: v != 0), F.lit(False))


def length_range(vector: str) -> Column:
    """floor(log2 of the length, plus a half), from components divided by the largest, so nothing overflows.

    Vectors of length one lie in the middle of their range.
    """
    top = F.array_max(F.transform(vector, lambda x: F.abs(x)))
    ratio = F.aggregate(F.transform(vector, lambda x: x / top), F.lit(0.0), lambda a, x: a + x * x)
    return F.floor(F.log2(top) + F.log2(ratio) / 2 + 0.5).cast("int")


def _levelled(x: np.ndarray, range_: int) -> np.ndarray:
    """Vectors of one range brought to lengths from about a half to one, and one more coordinate that makes them all one."""
    y = np.ldexp(x, -range_) / math.sqrt(2)
    return np.ascontiguousarray(np.column_stack([y, np.sqrt(np.maximum(0, 1 - (y * y).sum(1)))]), np.float32)


def build_index(vectors: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per shard: shard, dim, range, rows, vectors, levels, neighbours, entry, ids.

    Equal vectors are one node, so copies cannot crowd out its links; a node keeps the k + 1
    least of their ids, all that a list of k without the query's own can need. Rows without an
    id or a usable vector are left out, and vectors of one length have shards of their own. The
    number of shards follows the number of nodes; the index is written to the shared folder.
    """
    v = vectors.filter(F.col(id_col).isNotNull() & usable(vector_col))
    v = v.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    least = Window.partitionBy("v").orderBy("id")
    nodes = v.distinct().withColumn("_n", F.row_number().over(least)).filter(F.col("_n") <= k + 1)
    nodes = settled(nodes.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(
        "v", "ids", F.size("v").alias("dim"), length_range("v").alias("range")))
    sizes = nodes.groupBy("dim", "range").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("shards", F.ceil(F.col("n") / SHARD_ROWS).cast("int"))
    same = (F.col("dim") == F.col("_dim")) & (F.col("range") == F.col("_range"))
    dealt = nodes.join(sizes.withColumnsRenamed({"dim": "_dim", "range": "_range"}), same).withColumn("shard", F.pmod(F.xxhash64("v"), F.col("shards")).cast("int"))

    def build(group: pa.Table) -> pa.Table:
        dim, n = group["dim"][0].as_py(), group.num_rows
        x = group["v"].combine_chunks().flatten().to_numpy().reshape(n, dim)
        order = np.lexsort(x.T[::-1])
        x, ids = x[order], group["ids"].combine_chunks().take(pa.array(order)).to_pylist()
        range_ = group["range"][0].as_py()
        graph = Graph.build(_levelled(x, range_))
        return pa.table({
            "shard": pa.array([group["shard"][0].as_py()], pa.int32()), "dim": pa.array([dim], pa.int32()), "rows": pa.array([n], pa.int32()),
            "vectors": pa.array([x.astype("<f8").tobytes()], pa.binary()), "levels": pa.array([graph.levels.astype("<i4").tobytes()], pa.binary()),
            "neighbours": pa.array([[a.astype("<i4").tobytes() for a in graph.neighbours]], pa.list_(pa.binary())),
            "entry": pa.array([graph.entry], pa.int32()), "ids": pa.array([ids], pa.list_(pa.list_(pa.int64()))),
            "range": pa.array([range_], pa.int32())})

    # A shard is much work for few bytes, so tasks are not merged by size.
    tasks = SPREAD * (sizes.agg(F.coalesce(F.sum("shards"), F.lit(1))).first()[0] or 1)
    dealt = dealt.select("dim", "range", "shard", "v", "ids").repartition(tasks, "dim", "range", "shard")
    return settled(dealt.groupBy("dim", "range", "shard").applyInArrow(
        build, "shard int, dim int, rows int, vectors binary, levels binary, neighbours array<binary>, entry int, ids array<array<bigint>>, range int"))


def search(index: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per query its k nearest found: query_id, rank, vec_id, score.

    Nearness is the inner product in double precision, ties go to the smaller id, and rows with
    the query's own id are no candidates. Queries without an id or a usable vector, or of a length
    that no indexed vector has, give no rows; repeated queries count once. A shard meets the
    queries in blocks of bounded size.
    """
    q = queries.filter(F.col(id_col).isNotNull() & usable(vector_col)).select(
        F.col(id_col).cast("bigint").alias("query_id"), F.col(vector_col).cast("array<double>").alias("v")).distinct()
    q = settled(q.withColumn("dim", F.size("v")))
    blocks = max(1, math.ceil(q.count() / QUERY_BLOCK))
    shards = index.groupBy("dim", "range").agg(F.max("shard").alias("last")).withColumnRenamed("range", "_range")
    asked = q.join(shards, "dim").withColumn("block", F.pmod(F.xxhash64("query_id", "v"), F.lit(blocks)).cast("int"))
    asked = asked.select("dim", F.col("_range").alias("range"), F.explode(F.sequence(F.lit(0), "last")).alias("shard"), "block", "query_id", "v")
    offered = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    out = "query_id bigint, vec_id bigint, score double"

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        row = right.slice(0, 1).to_pylist()[0]
        x = np.frombuffer(row["vectors"], "<f8").reshape(row["rows"], row["dim"])
        graph = None if row["rows"] <= WHOLE_ROWS else Graph(
            _levelled(x, row["range"]), np.frombuffer(row["levels"], "<i4"), [np.frombuffer(a, "<i4") for a in row["neighbours"]], row["entry"])
        asked = left["v"].combine_chunks().flatten().to_numpy().reshape(left.num_rows, row["dim"])
        whose, found, scores = [], [], []
        for own, query in zip(left["query_id"].to_pylist(), asked):
            if graph is None:
                nodes = np.arange(row["rows"])
            else:
                query_ = query / np.abs(query).max()
                unit = np.append(query_ / np.linalg.norm(query_), 0).astype(np.float32)
                near = graph.search(unit, max(SEARCH_WIDTH, k + 1), graph.descend(unit, 0), 0)
                nodes = np.sort([i for _, i in near])
            exact = (x[nodes] * query).sum(1)
            listed = sorted((-s, i) for s, n in zip(exact.tolist(), nodes.tolist()) for i in row["ids"][n] if i != own)[:k]
            whose += [own] * len(listed)
            found += [i for _, i in listed]
            scores += [-s for s, _ in listed]
        return pa.table({"query_id": pa.array(whose, pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(scores, pa.float64())})

    by = ["dim", "range", "shard", "block"]
    tasks = SPREAD * blocks * max(1, index.count())
    found = asked.repartition(tasks, *by).groupBy(*by).cogroup(offered.repartition(tasks, *by).groupBy(*by)).applyInArrow(look, out)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
