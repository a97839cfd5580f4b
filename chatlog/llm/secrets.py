"""Secret scan with corpus-wide ownership counts.

Spans of fixed patterns are always reported. Every candidate value, those spans' and any other
long mixed token, is counted by its digest over the distinct owners and repositories it occurs
in. A value of few owners looks live and specific; one seen under many owners is a copied
example. Long tokens outside the fixed patterns are added as spans only if they are specific.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chatlog.llm.common import indices, join_docs, keyed, let, sums_before
from chatlog.session import settled

# The patterns of the report, their kinds in order, and least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ["assign", "access", "hex", "owned"]
#: Possible secrets of other forms: long tokens with letters and digits.
WIDE = r"[A-Za-z0-9+/_=-]{20,}"


def _spans(kind: int, text: str, pattern: str, value_group: int, least: int, looks: str) -> Column:
    """Array of (start, kind, end, value) in code points; `looks` is a cheap test of the whole text."""
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,value:string>>")
    every = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = every if value_group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p).cast("bigint"))

    def placed(m, v, g):
        steps = F.transform(m, lambda x, i: F.get(g, i) + F.length(x))
        return let(sums_before(steps), lambda at: F.transform(indices(F.size(m)), lambda i: F.struct(
            (F.get(at, i) + F.get(g, i)).alias("start"), F.lit(kind).alias("kind"),
            (F.get(at, i) + F.get(g, i) + F.length(F.get(m, i))).alias("end"), F.get(v, i).alias("value"))))

    found = let(every, lambda m: let(values, lambda v: let(gaps, lambda g: placed(m, v, g))))
    return F.when(F.col(text).rlike(looks), F.filter(found, lambda x: F.length(x["value"]) >= least)).otherwise(none)


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan_secrets(
    docs: DataFrame, owner_col: str = "source", repo_cols: tuple[str, ...] = ("source", "lang"),
    max_owners: int = 1, max_repos: int = 3, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per document row: id, n_assign, n_access, n_hex, base_sha256, spans, n_specific, n_copied.

    A value is specific if it occurs under at most `max_owners` owners and `max_repos`
    repositories. n_specific and n_copied count the document's spans of either sort. Null text is
    empty; a null owner or repository part counts as one unknown owner. Equal texts under one id
    have equal results, once per row. An added span overlaps no fixed one.
    """
    owner = F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("_owner")
    repo = F.to_json(F.struct(*[F.col(c).cast("string").alias(f"r{i}") for i, c in enumerate(repo_cols)])).alias("_repo")
    d = keyed(docs, id_col, text_col, owner, repo)
    base = F.concat(
        _spans(0, "_text", ASSIGN, 2, 12, r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"),
        _spans(1, "_text", ACCESS, 0, 18, "AKIA[A-Z0-9]{14}"),
        _spans(2, "_text", HEX, 0, 16, "[0-9a-f]{16}"),
    )
    wide = F.filter(_spans(3, "_text", WIDE, 0, 20, WIDE), lambda x: x["value"].rlike("[0-9]") & x["value"].rlike("[A-Za-z]"))
    digest = lambda spans: F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), F.sha2(x["value"], 256).alias("digest")))
    found = d.select("_id", "_th", "_owner", "_repo", digest(base).alias("_base"), digest(wide).alias("_wide"))
    found = found.withColumn("_wide", F.filter("_wide", lambda x: ~F.exists("_base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))))
    found = settled(found)  # narrow: the texts are read once

    some = found.filter((F.size("_base") > 0) | (F.size("_wide") > 0)).withColumn("_all", F.concat("_base", "_wide"))
    seen = some.select("_owner", "_repo", F.explode("_all.digest").alias("digest")).groupBy("digest", "_owner", "_repo").count()
    owned = seen.groupBy("digest").agg(F.countDistinct("_owner").alias("owners"), F.countDistinct("_repo").alias("repos"))
    owned = owned.select("digest", ((F.col("owners") <= max_owners) & (F.col("repos") <= max_repos)).alias("specific"))
    each = some.dropDuplicates(["_id", "_th"]).select("_id", "_th", F.explode("_all").alias("x"))
    each = each.select("_id", "_th", "x.*").join(owned, "digest")
    kept = (F.col("kind") < 3) | F.col("specific")
    judged = each.groupBy("_id", "_th").agg(
        F.collect_list(F.when(kept, F.struct("start", "kind", "end"))).alias("_spans"),
        F.sum(F.when(kept & F.col("specific"), 1).otherwise(0)).alias("n_specific"),
        F.sum(F.when(kept & ~F.col("specific"), 1).otherwise(0)).alias("n_copied"))
    count = lambda k: F.size(F.filter("_base", lambda x: x["kind"] == k)).cast("bigint")
    base_only = F.transform("_base", lambda x: F.struct(x["start"], x["kind"], x["end"]))
    return join_docs(found, judged).select(
        F.col("_id").alias(id_col), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(base_only), 256).alias("base_sha256"), F.coalesce(_joined(F.col("_spans")), F.lit("")).alias("spans"),
        F.coalesce("n_specific", F.lit(0)).alias("n_specific"), F.coalesce("n_copied", F.lit(0)).alias("n_copied"))
