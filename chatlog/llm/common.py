"""Column helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from chatlog.session import settled

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words, after A-Z are lower-cased.
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else untouched; the cheap path serves pure ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NON_WORD, -1), "")


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """`_id`, `_th` (digest of the text), `_text` (null: empty) and `more` as they are.

    (_id, _th) names a document also where ids are null or repeated; rows equal in both
    have equal results. Any other column is left behind, so no name can clash.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_th"), text.alias("_text"), *more)


def whole(docs: DataFrame) -> Column:
    """All columns of a row as one, `_row`, so that no name can clash on the way."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def join_docs(a: DataFrame, b: DataFrame, how: str = "left") -> DataFrame:
    """`a` joined to `b` by document; `b` may not share any other column."""
    b = b.withColumnsRenamed({"_id": "_id_b", "_th": "_th_b"})
    return a.join(b, F.col("_id").eqNullSafe(F.col("_id_b")) & (F.col("_th") == F.col("_th_b")), how).drop("_id_b", "_th_b")


def bucket_of(id_col: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as bucket 0."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string")) % F.lit(n), F.lit(0)).cast("int")


def let(value: Column, use) -> Column:
    """`use(value)` with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def indices(count: Column) -> Column:
    """0 .. count-1."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def sums_before(lengths: Column, block: int = 64) -> Column:
    """For each element of a whole-number array, the sum of those before it.

    Summed in blocks, so an array of n elements costs about n * block, not n * n.
    """
    total = lambda part: F.aggregate(part, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def before(arr):
        blocks = F.transform(indices(F.ceil(F.size(arr) / F.lit(block)).cast("int")), lambda b: total(F.slice(arr, b * block + 1, block)))
        return let(blocks, lambda each: let(
            F.transform(indices(F.size(each)), lambda b: total(F.slice(each, F.lit(1), b))),
            lambda offset: F.transform(indices(F.size(arr)), lambda i: F.get(offset, F.floor(i / F.lit(block)).cast("int")) + total(
                F.slice(arr, F.floor(i / F.lit(block)).cast("int") * block + 1, i % block)))))

    return let(lengths, before)


def least_hashes(rows: DataFrame, label: str, number: str, most: Column) -> DataFrame:
    """The distinct (label, number) with the `most` least numbers of each label; `number` is a 64-bit hash.

    About twice as many as wanted lie below a bound that follows from an estimate of how many a label has, so
    what is ranked in one task does not grow with the table. The estimates are sent to all tasks: one row per
    label, of which the result has `most` rows.
    """
    rows = settled(rows.select(label, number))
    kinds = rows.groupBy(label).agg(F.approx_count_distinct(number).alias("_kinds"))
    place = F.col(number).cast("double") / F.lit(2.0 ** 64) + 0.5
    near = rows.join(F.broadcast(kinds), label).filter(place * F.col("_kinds") <= 2 * most + 64).select(label, number).distinct()
    first = Window.partitionBy(label).orderBy(number)
    return near.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= most).drop("_n")
