"""Projected effect of retention offers on a scored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.functions.columns import flag, ratio


def _saved(targeted: Column, success_rate: Column) -> Column:
    return F.floor(targeted * success_rate).cast("long")


def retention_impact(
    scored: DataFrame,
    threshold: float = 0.7,
    success_rate: float = 0.50,
    customer_value: float = 1200,
) -> DataFrame:
    """One row: retention before and after offers to everyone scored above ``threshold``.

    Saved customers are a share of all targeted ones, churners or not, so the new rate can exceed 1.
    """
    counted = scored.agg(
        F.count("*").alias("n"),
        F.sum("label").alias("churners"),
        F.sum(flag(F.col("p") > F.lit(threshold))).alias("targeted"),
    )
    base = 1 - ratio(F.col("churners"), F.col("n"))
    saved = _saved(F.col("targeted"), F.lit(float(success_rate)))
    new = 1 - ratio(F.col("churners") - saved, F.col("n"))
    return counted.select(
        base.alias("baseline_retention_rate"),
        new.alias("new_retention_rate"),
        (ratio(new - base, base) * 100).alias("retention_improvement_pct"),
        F.col("targeted").alias("customers_targeted"),
        saved.alias("customers_saved"),
        (saved * F.lit(customer_value)).alias("annual_revenue_saved"),
    )


def impact_scenarios(
    scored: DataFrame,
    thresholds: Sequence[float] = (0.5, 0.6, 0.7),
    success_rates: Sequence[float] = (0.45, 0.50, 0.55),
) -> DataFrame:
    """Targeted, saved and relative churn reduction for every threshold and success rate.

    All thresholds are counted in one pass; the combinations are formed on the resulting row.
    """
    targeted = [
        F.struct(
            F.lit(float(t)).alias("threshold"), F.sum(flag(F.col("p") > F.lit(t))).alias("targeted")
        )
        for t in thresholds
    ]
    counted = scored.agg(F.sum("label").alias("churners"), F.array(*targeted).alias("grid"))
    rates = F.array(*[F.lit(float(r)) for r in success_rates])
    scenarios = counted.select("churners", F.explode("grid").alias("g")).select(
        "churners", "g.*", F.explode(rates).alias("success_rate")
    )
    return scenarios.withColumn("saved", _saved(F.col("targeted"), F.col("success_rate"))).select(
        "threshold",
        "success_rate",
        F.col("targeted").alias("customers_targeted"),
        F.col("saved").alias("customers_saved"),
        ratio(F.col("saved"), F.col("churners")).alias("churn_reduction"),
    )
