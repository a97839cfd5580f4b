"""Benchmark decontamination by winnowing.

Of every `w` consecutive k-gram hashes the least is kept, with k + w - 1 = `span`. Two texts
that share `span` words share all k-grams of that stretch, hence the least one: looking up the
kept hashes of a document among those of the items finds every shared stretch. Each hit names
a run of window starts that have this least hash; it is extended to whole windows of `span`
words, which are compared word by word with the windows of the items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chatlog.llm.common import join_docs, keyed, whole, words
from chatlog.session import settled

SPAN = 10
GRAM = 5


def _runs(h: str, span: int) -> Column:
    """Winnowed runs of one length: array of (t, s, e, fp) over the word hashes in `h`.

    Windows s to e-1 (by first word) have the kept hash fp.
    """
    k = min(GRAM, span)
    w = span - k + 1
    count = F.size(h) - F.lit(span) + 1
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    grams = F.transform(
        upto(F.when(count > 0, F.size(h) - F.lit(k) + 1).otherwise(0)),
        lambda i: F.xxhash64(F.lit(span), *[F.get(h, i + j) for j in range(k)]),
    )
    # Each level is bound once by a one-element transform: no level is computed per position.
    def kept(g):
        return grams if w == 1 else F.transform(upto(count), lambda i: F.least(*[F.get(g, i + j) for j in range(w)]))

    def starts(m):
        return F.filter(upto(F.size(m)), lambda i: (i == 0) | (F.get(m, i) != F.get(m, i - 1)))

    def spans(m, s):
        return F.transform(s, lambda at, j: F.struct(
            F.lit(span).alias("t"), at.alias("s"), F.coalesce(F.get(s, j + 1), F.size(m)).alias("e"), F.get(m, at).alias("fp")))

    let = lambda value, use: F.element_at(F.transform(F.array(value), use), 1)
    return let(grams, lambda g: let(kept(g) if w > 1 else g, lambda m: let(starts(m), lambda s: spans(m, s))))


def _hashes() -> Column:
    return F.transform("_words", lambda x: F.xxhash64(x))


def _all_runs(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds `_runs` from `_words`, for each window length."""
    df = df.withColumn("_h", _hashes())
    return df.withColumn("_runs", F.flatten(F.array(*[_runs("_h", t) for t in lengths])))


def _covered(spans: Column) -> Column:
    """Positions covered by an array of (start, end), ends exclusive."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(
        F.array_sort(spans), start,
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], a["upto"]))).alias("n"),
            F.greatest(a["upto"], x["end"]).alias("upto")),
        lambda a: a["n"])


def _find(docs: DataFrame, items: DataFrame, span: int, id_col: str, text_col: str, item_id: str, item_text: str):
    """Per document (_id, _th, _rows, n_words), and per hit document (_id, _th, n_hit, items); the latter is None without items."""
    own = items.select(F.col(item_id).cast("string").alias("_item"), F.col(item_text).alias("_t"))
    own = settled(own.select("_item", words(F.col("_t")).alias("_words")).filter(F.size("_words") > 0))
    lengths = sorted(r[0] for r in own.select(F.least(F.size("_words"), F.lit(span))).distinct().collect())  # at most `span`
    d = keyed(docs, id_col, text_col)
    listed = d.select("_id", "_th", words(F.col("_text")).alias("_words"))
    if not lengths:
        return listed.select("_id", "_th", F.lit(1).alias("_rows"), F.size("_words").alias("n_words")), None

    prints = settled(_all_runs(own, lengths).select(F.explode("_runs").alias("r")).select(
        F.col("r.t").alias("t"), F.col("r.fp").alias("fp")).distinct())
    whole = F.array(F.struct(F.col("t"), F.lit(0).alias("s"), (F.size("_words") - F.col("t") + 1).alias("e")))
    sized = own.withColumn("t", F.least(F.size("_words"), F.lit(span)))
    windows = settled(_windows(sized.withColumn("_runs", whole), "_item").select("t", "_window", "_item").distinct())

    # One row per run, and one of length 0 that stands for the document itself.
    stand_in = F.struct(F.lit(0).alias("t"), F.lit(0).alias("s"), F.size("_words").alias("e"), F.col("_th").alias("fp"))
    runs = _all_runs(listed, lengths).select("_id", "_th", F.explode(F.array_append("_runs", stand_in)).alias("r"))
    runs = runs.select("_id", "_th", F.col("r.t").alias("t"), F.col("r.s").alias("s"), F.col("r.e").alias("e"), F.col("r.fp").alias("fp"))
    found = runs.join(prints.withColumn("_hit", F.lit(True)), ["t", "fp"], "left").filter("t = 0 or _hit")
    per_doc = settled(found.groupBy("_id", "_th").agg(
        F.sum(F.when(F.col("t") == 0, 1).otherwise(0)).alias("_rows"),
        F.max(F.when(F.col("t") == 0, F.col("e"))).alias("n_words"),
        F.collect_set(F.when(F.col("t") > 0, F.struct("t", "s", "e"))).alias("_runs")))

    hits = per_doc.filter(F.size("_runs") > 0).select("_id", "_th", "_runs")
    texts = join_docs(d, hits, "inner").dropDuplicates(["_id", "_th"])
    tried = _windows(texts.select("_id", "_th", words(F.col("_text")).alias("_words"), "_runs"), "_id", "_th")
    asked = windows.select("t", "_window", F.xxhash64("_window", "t").alias("_w"))
    met = settled(tried.join(asked.distinct(), ["t", "_window"]).select("_id", "_th", "t", "at", "_w"))
    covered = met.groupBy("_id", "_th").agg(F.collect_set(F.struct(
        F.col("at").alias("start"), (F.col("at") + F.col("t")).alias("end"))).alias("_spans"))
    covered = covered.select("_id", "_th", _covered(F.col("_spans")).alias("n_hit"))
    whose = windows.select(F.xxhash64("_window", "t").alias("_w"), "_item")
    named = met.select("_id", "_th", "_w").distinct().join(whose, "_w").groupBy("_id", "_th").agg(F.collect_set("_item").alias("items"))
    return per_doc.select("_id", "_th", "_rows", "n_words"), join_docs(covered, named)


def decontaminate(
    docs: DataFrame, items: DataFrame, span: int = SPAN,
    id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Per document row: id, n_words, n_hit, n_items, items_sha256, contaminated, items.

    A window is `span` consecutive words of an item, or all words of an item with fewer. A word
    of a document is hit if it lies in an occurrence of a window. Null and empty texts, on either
    side, have no words: such a document has no hits, such an item no windows. Items of one id
    count once, items with a null id mark words but are not counted. Repeated document rows
    give repeated result rows; without items nothing is hit. The item tables are written to the
    shared folder first, so whether a join broadcasts them goes by their measured size.
    """
    per_doc, hit = _find(docs, items, span, id_col, text_col, item_id, item_text)
    none = [F.lit(None).cast("int").alias("n_hit"), F.lit(None).cast("array<string>").alias("items")]
    out = per_doc.select("*", *none) if hit is None else join_docs(per_doc, hit)
    listed = F.array_sort(F.coalesce("items", F.array().cast("array<string>")))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return out.select("*", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))).alias("_copy")).select(
        F.col("_id").alias(id_col), F.col("n_words").cast("bigint").alias("n_words"), n_hit.alias("n_hit"),
        F.size(listed).cast("bigint").alias("n_items"), F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"), listed.alias("items"))


def clean(
    docs: DataFrame, items: DataFrame, span: int = SPAN,
    id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of `docs` without a hit word, with all their columns; other cases as in `decontaminate`."""
    _, hit = _find(docs, items, span, id_col, text_col, item_id, item_text)
    if hit is None:
        return docs
    rows = keyed(docs, id_col, text_col, whole(docs))
    return join_docs(rows, hit.select("_id", "_th"), "left_anti").select("_row.*")


def _windows(df: DataFrame, *keys: str) -> DataFrame:
    """One row (keys, t, at, _window) per window named by `_runs` over `_words`."""
    each = df.select(*keys, "_words", F.explode("_runs").alias("r"))
    each = each.filter("r.e > r.s").select(*keys, F.col("r.t").alias("t"), F.explode(F.transform(
        F.sequence(F.col("r.s"), F.col("r.e") - 1),
        lambda i: F.struct(i.alias("at"), F.array_join(F.slice("_words", i + 1, F.col("r.t")), " ").alias("w")))).alias("x"))
    return each.select(*keys, "t", F.col("x.at").alias("at"), F.col("x.w").alias("_window"))
