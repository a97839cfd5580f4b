"""Model aliases and their capabilities."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chatlog import fixed

# A dimension is broadcast only after a count shows it has no more rows than this.
BROADCAST_ROWS = 10_000


def small_side(dim: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`dim` with a broadcast hint if a bounded count shows that it is small.

    A larger one is left to Spark: a shuffled join, with skewed aliases split by
    adaptive execution.
    """
    return F.broadcast(dim) if dim.limit(rows + 1).count() <= rows else dim


def resolve_models(
    df: DataFrame,
    aliases: DataFrame,
    capabilities: DataFrame,
    default: str,
    alias: str = "model_alias",
    is_omni: bool = False,
    temperature: float = fixed.DEFAULT_TEMPERATURE,
    max_tokens: int = 100_000,
) -> DataFrame:
    """Effective model and capabilities of each row's alias.

    `aliases` has (alias, model), `capabilities` (model, is_omni,
    default_temperature, max_tokens). An unknown alias gets the model `default`; a
    model without a capability row gets the values given as arguments.
    """
    names = small_side(aliases.select(F.col("alias").alias(alias), F.col("model").alias("_model")))
    caps = small_side(
        capabilities.select(F.col("model").alias("model_effective"), "is_omni", "default_temperature", "max_tokens")
    )
    known = df.join(names, alias, "left").withColumns({
        "model_effective": F.coalesce("_model", F.lit(default)),
        "alias_known": F.col("_model").isNotNull(),
    })
    return known.join(caps, "model_effective", "left").select(
        *df.columns, "model_effective", "alias_known",
        F.coalesce("is_omni", F.lit(is_omni)).alias("is_omni"),
        F.coalesce("default_temperature", F.lit(temperature)).alias("default_temperature"),
        F.coalesce("max_tokens", F.lit(max_tokens)).alias("max_tokens"),
    )


def list_models(aliases: DataFrame) -> DataFrame:
    """The served alias list."""
    return aliases.select("alias", "model").distinct()
