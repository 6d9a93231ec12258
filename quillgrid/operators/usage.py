"""Tokens and their cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid import fixed
from quillgrid.functions import text


def totals(usage: DataFrame, prices: dict | None = None) -> DataFrame:
    """stem, model, tokens and unrounded cost. usage: stem, model, input_tokens, output_tokens; null counts as none."""
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    each = usage.groupBy("stem", "model").agg(zero("input_tokens"), zero("output_tokens"))
    return each.withColumn("cost", text.cost(F.col("model"), F.col("input_tokens"), F.col("output_tokens"), prices))


def by_model(usage: DataFrame, prices: dict | None = None) -> DataFrame:
    each = usage.groupBy("model").agg(F.count("*").alias("strips"), F.sum("input_tokens").cast("long").alias("input_tokens"), F.sum("output_tokens").cast("long").alias("output_tokens"))
    return each.withColumn("cost", text.cost(F.col("model"), F.col("input_tokens"), F.col("output_tokens"), prices))


def dry_run(pending: DataFrame, refused: DataFrame, model: str, limit: int | None = None) -> DataFrame:
    """One row: pending strips (at most limit), refused pages, and the planned cost."""
    n = F.count("*") if limit is None else F.least(F.count("*"), F.lit(limit))
    p = pending.agg(n.cast("long").alias("pending")).join(refused.agg(F.count("*").alias("refused")))  # one row each
    tokens_in, tokens_out = fixed.PLANNED
    return p.withColumn("cost", text.cost(F.lit(model), F.col("pending") * tokens_in, F.col("pending") * tokens_out))


def run_totals(strips: DataFrame, model: str) -> DataFrame:
    """One row over a run: new, skipped, errors, refused pages, tokens, cost and exit_code. strips: stem, outcome (new, skipped, error or refused), tokens."""
    n = lambda kind: F.count_if(F.col("outcome") == kind)
    tokens = lambda c: F.coalesce(F.sum(F.when(F.col("outcome") == "new", F.col(c))), F.lit(0)).cast("long")
    out = strips.agg(n("new").alias("new"), n("skipped").alias("skipped"), n("error").alias("errors"), F.countDistinct(F.when(F.col("outcome") == "refused", F.col("stem"))).alias("refused"), tokens("input_tokens").alias("input_tokens"), tokens("output_tokens").alias("output_tokens"))
    return out.withColumns({"cost": text.cost(F.lit(model), F.col("input_tokens"), F.col("output_tokens")), "exit_code": F.when(F.col("errors") > 0, 1).otherwise(0)})
