"""A training corpus from raw documents, in stages.

Each stage works on all rows the one before it kept and returns their columns; the last gives
token ids. Between stages the driver, or any caller, may write the rows and read them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chatlog.llm import bpe, decontam, linededup, probminhash, toxicity
from chatlog.llm.common import table, whole
from chatlog.llm.queries import VOCABULARY
from chatlog.session import settled


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not call toxic."""
    able = ~toxicity.held_out()
    model = toxicity.fit(docs.filter(able), table(spark, sf_dir, "labels").filter(able))
    return toxicity.score(docs.select(whole(docs), "text"), model, keep=["_row"]).filter("predicted = 0").select("_row.*")


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many share; n_chars follows the text."""
    kept = linededup.dedup_lines(docs.select("doc_id", "text", whole(docs)), keep=["_row"])
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return kept.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id."""
    return probminhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed little-endian unsigned 32-bit), decoded_sha256."""
    out = bpe.encode_decode(docs, VOCABULARY)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids",
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_shared_lines),
    ("near-dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]
ORACLE_SQL = None  # a trained classifier decides in the first stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's rows written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
