"""Near-duplicates by ProbMinHash, banding and exact verification.

A text is the bag of its five-word shingles, weighed from 1 to HEAVIEST by their counts. Every
shingle is a Poisson process of its weight, whose arrivals fall into random registers; a
register keeps the shingle that came first, and a shingle stops once its next arrival is later
than all registers. Two texts agree in a register with the probability Jaccard similarity of
their bags, which is at least their sets' Jaccard similarity over HEAVIEST. Texts that agree in a band of registers are candidates; a link is a candidate pair
whose sets of shingles have a Jaccard similarity of at least 0.8, and a class what links connect.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from chatlog.llm.common import join_docs, keyed, whole
from chatlog.llm.components import components
from chatlog.llm.workers import KEEP_WORDS, map_texts, word_list
from chatlog.session import settled

WORDS, SIMILAR = 5, 0.8
#: The weight that counts of a shingle tend to; that of a single one is 1.
HEAVIEST = 1.1
#: The lowest chance that a register agrees in a pair of SIMILAR sets, whatever the counts on either side.
LEAST = SIMILAR / HEAVIEST
#: Such a pair shares no band with chance (1 - LEAST^4)^33 at most, about 0.00002.
BANDS, BAND = 33, 4
REGISTERS = BANDS * BAND
#: Least share of equal registers worth an exact look: six deviations below LEAST.
LEAST_SHARE = LEAST - 6 * (LEAST * (1 - LEAST) / REGISTERS) ** 0.5
#: Buckets are compared in blocks of this many texts.
BLOCK = 1024
GOLDEN = np.uint64(0x9E3779B97F4A7C15)

_WORDS: dict[bytes, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and their counts; a text of fewer words is one shingle."""
    if len(_WORDS) > KEEP_WORDS:
        _WORDS.clear()
    for w in set(words).difference(_WORDS):
        _WORDS[w] = xxhash.xxh3_64_intdigest(w)
    h = np.array([_WORDS[w] for w in words], np.uint64)
    k = min(WORDS, len(h))
    if not k:
        return h, np.zeros(0, np.int64)
    out = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        out = _mix((out + h[j:j + len(out)]) * GOLDEN + np.uint64(k))
    return np.unique(out, return_counts=True)


def weights_of(counts: np.ndarray) -> np.ndarray:
    return HEAVIEST - (HEAVIEST - 1) / counts


def signature(items: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The item kept by each register, shortened to 32 bits."""
    first, kept = np.full(REGISTERS, np.inf), np.zeros(REGISTERS, np.uint64)
    due = np.zeros(len(items))
    per_turn, turn = max(1, -(-1000 // len(items))), 0
    while len(items):
        steps = np.arange(turn + 1, turn + per_turn + 1, dtype=np.uint64)
        draw = _mix(items[:, None] + steps * GOLDEN)
        wait = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weights[:, None]
        at = due[:, None] + np.cumsum(wait, 1)
        register = (_mix(draw ^ GOLDEN) % np.uint64(REGISTERS)).astype(np.int64)
        soon = at < first.max()
        when, where, what = at[soon], register[soon], np.broadcast_to(items[:, None], at.shape)[soon]
        np.minimum.at(first, where, when)
        won = first[where] == when
        kept[where[won]] = what[won]
        due = at[:, -1]
        more = due < first.max()
        items, weights, due, turn = items[more], weights[more], due[more], turn + per_turn
    return (_mix(kept) >> np.uint64(32)).astype(np.uint32)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets of hashes."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if both else 0.0


def _signed(texts: list[str]) -> list[pa.Array]:
    digests, sizes, signs, done = [], [], [], {}
    for text in texts:
        words = word_list(text)
        digest = hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None
        if digest and digest not in done:
            items, counts = shingles(words)
            done[digest] = len(items), signature(items, weights_of(counts)).astype("<u4").tobytes()
        size, sign = done.get(digest, (0, None))
        digests.append(digest)
        sizes.append(size)
        signs.append(sign)
    return [pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.array(signs, pa.binary())]


def _itemized(texts: list[str]) -> list[pa.Array]:
    return [pa.array([shingles(word_list(t))[0].astype("<u8").tobytes() for t in texts], pa.binary())]


def _verified(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """Of pairs (a, b) of nodes those similar enough, by all their shingles."""
    left = items.select(F.col("node").alias("a"), F.col("items").alias("_ia"))
    right = items.select(F.col("node").alias("b"), F.col("items").alias("_ib"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch["_ia"].to_pylist(), batch["_ib"].to_pylist())
            keep = [similarity(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")) >= SIMILAR for a, b in both]
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "_ia", "_ib").mapInArrow(run, "a bigint, b bigint")


def _close(members: DataFrame) -> DataFrame:
    """Links between different components of a bucket, enough to connect what is linked in it.

    A bucket is compared in blocks, two at a time, so no task holds more than two blocks. A pair
    is looked at in the first band it shares and in no other, and not if links found before
    connect it already; only links leave the task, fewer than there are texts.
    """
    sizes = members.groupBy("bucket").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    dealt = members.join(sizes, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "band", "node", "comp", "sign", "items")

    def compare(group: pa.Table) -> pa.Table:
        own, node, comp = (group[c].to_numpy() for c in ("own", "node", "comp"))
        i, j, band = (group[c][0].as_py() for c in ("i", "j", "band"))
        signs = np.frombuffer(b"".join(group["sign"].to_pylist()), "<u4").reshape(len(node), REGISTERS)
        items = [np.frombuffer(x, "<u8") for x in group["items"].to_pylist()]
        size, parent = np.array(list(map(len, items))), {c: c for c in comp.tolist()}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        a, b = [], []
        right = np.flatnonzero(own == j)
        for n in np.flatnonzero(own == i):
            others = right[(comp[right] != comp[n]) & ((node[right] < node[n]) | (i != j))]
            others = others[(size[others] >= SIMILAR * size[n]) & (size[n] >= SIMILAR * size[others])]
            same = signs[others] == signs[n]
            share = same.mean(1)
            shared = same.reshape(len(others), BANDS, BAND).all(2)
            fit = (share >= LEAST_SHARE) & (shared.argmax(1) == band) & shared.any(1)
            for m in others[fit][np.argsort(-share[fit], kind="stable")]:
                one, two = root(comp[n]), root(comp[m])
                if one != two and similarity(items[n], items[m]) >= SIMILAR:
                    parent[one] = two
                    a.append(node[n])
                    b.append(node[m])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("bucket", "i", "j").applyInArrow(compare, "a bigint, b bigint")


def _band_keys() -> Column:
    band = lambda i: F.xxhash64(F.lit(i), F.substring("sign", 4 * BAND * i + 1, 4 * BAND))
    return F.array(*[band(i) for i in range(BANDS)])


def _members(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _th, node, comp) of every row; comp is null for texts without words.

    1. Texts of equal words are one node. 2. In each bucket every text is paired with the
    bucket's first one, and verified with the one it meets in most buckets. 3. Where a bucket
    still has several components, its other texts are verified with its first one too. 4. In
    buckets that still have several, all texts of different components are compared, in blocks.
    """
    d = keyed(docs, id_col, text_col)
    rows = settled(map_texts(d, lambda: _signed, "digest binary, size int, sign binary"))
    nodes = rows.filter(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.first("size").alias("size"), F.first("sign").alias("sign"), F.min(F.struct("_id", "_th")).alias("one"))
    nodes = settled(nodes.withColumn("node", F.monotonically_increasing_id()))  # written, so the number stays
    bands = nodes.select("node", F.posexplode(_band_keys()).alias("band", "bucket"))
    shared = settled(bands.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("first")).filter("n > 1").select("bucket", "first"))
    members = settled(bands.join(shared, "bucket"))
    wanted = members.select("node").distinct().join(nodes.select("node", "one"), "node").select("node", "one._id", "one._th")
    texts = join_docs(d, wanted, "inner").dropDuplicates(["node"]).select("node", "_text")
    items = settled(map_texts(texts, lambda: _itemized, "items binary"))

    tried = members.filter("node <> first").groupBy(F.col("node").alias("a"), F.col("first").alias("b")).agg(F.count("*").alias("n"))
    best = tried.groupBy("a").agg(F.max(F.struct("n", -F.col("b"))).alias("top")).select("a", (-F.col("top.col2")).alias("b"))
    best = settled(best)
    links = settled(_verified(best, items))

    def labelled(comps: DataFrame) -> DataFrame:
        """Members with their component, of buckets that have several."""
        of = members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        mixed = of.groupBy("bucket").agg(F.min("comp").alias("_low"), F.max("comp").alias("_high")).filter("_low < _high")
        return of.join(mixed, "bucket", "left_semi")

    open_ = settled(labelled(components(links)))
    heads = open_.filter("node = first").select("bucket", F.col("comp").alias("_head"))
    again = open_.filter("node <> first").join(heads, "bucket").filter("comp <> _head")
    again = again.select(F.col("node").alias("a"), F.col("first").alias("b")).distinct().join(best, ["a", "b"], "left_anti")
    links = settled(links.unionByName(_verified(again, items)))

    open_ = labelled(components(links)).filter("node <> first")
    more = _close(open_.join(nodes.select("node", "sign"), "node").join(items, "node"))
    links = settled(links.unionByName(more))
    comps = components(links)
    named = nodes.select("digest", "node").join(comps, "node", "left").select("digest", F.coalesce("comp", "node").alias("comp"))
    return settled(rows.select("_id", "_th", "digest").join(named, "digest", "left").drop("digest"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: id, class_id, class_size.

    class_id is the least id of the class. A null, empty or wordless text resembles nothing and
    is a class of its own; texts of fewer than five words are one shingle, so alike only if
    their words are equal. Repeated rows are copies. A class without any id has a null class_id.
    """
    rows = _members(docs, id_col, text_col)
    known = rows.filter(F.col("comp").isNotNull())
    each = known.groupBy("comp").agg(F.min("_id").alias("class_id"), F.count("*").alias("class_size"))
    alone = rows.filter(F.col("comp").isNull()).select("_id", F.col("_id").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"))
    return known.join(each, "comp").select("_id", "class_id", "class_size").unionByName(alone).withColumnRenamed("_id", id_col)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, of each class only the one with the least id, then digest of its text; without id last."""
    rows = _members(docs, id_col, text_col)
    known = rows.filter(F.col("comp").isNotNull())
    chosen = known.groupBy("comp").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_th")).alias("one")).select("one._id", "one._th")
    copies = known.groupBy("_id", "_th").count()
    chosen = settled(join_docs(chosen, copies, "inner"))
    d = keyed(docs, id_col, text_col, whole(docs))
    wordless = rows.filter(F.col("comp").isNull()).select("_id", "_th").distinct().withColumn("count", F.lit(1))
    single = join_docs(d, chosen.filter("count = 1").unionByName(wordless.select("_id", "_th", F.col("count").cast("bigint"))), "inner")
    repeated = join_docs(d, chosen.filter("count > 1"), "inner").dropDuplicates(["_id", "_th"])
    return single.unionByName(repeated).select("_row.*")
