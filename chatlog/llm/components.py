"""Connected components of a large link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chatlog.session import settled


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every linked node; comp is the least node of the component.

    `links` has two whole-number columns a and b. Each turn takes the least label among the
    neighbours, then the label of that label, so long chains halve. Labels are written to the
    shared folder after each turn; only the number of changed labels reaches the driver.
    """
    both = settled(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = settled(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_least")).select(
        "node", F.least("node", "_least").alias("comp")))
    while True:
        around = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("_near"))
        hooked = labels.join(around, "node").select("node", F.col("comp").alias("_was"), F.least("comp", "_near").alias("comp"))
        of = labels.select(F.col("node").alias("comp"), F.col("comp").alias("_next"))
        moved = settled(hooked.join(of, "comp").select("node", "_was", F.least("comp", "_next").alias("comp")))
        labels = moved.select("node", "comp")
        if not moved.filter("comp <> _was").take(1):
            return labels
