"""Cohort, trend, risk, campaign and data-quality reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.functions.columns import as_of_column, flag, month_bucket, percent, ratio

RISK_SIGNALS = (
    "month_to_month_risk", "new_customer_risk", "payment_risk", "high_price_risk", "no_support_risk",
)


def cohort_churn(churn: DataFrame) -> DataFrame:
    """Churn rate by contract and payment method, worst first."""
    keys = ("contract_type", "payment_method")
    return (
        churn.groupBy(*keys)
        .agg(
            F.count("*").alias("total_customers"),
            F.sum("churn").alias("churned_customers"),
            percent(F.col("churn")).alias("churn_rate_pct"),
            F.avg("monthly_charges").alias("avg_monthly_charges"),
            F.avg("tenure_months").alias("avg_tenure_months"),
        )
        .orderBy(F.desc("churn_rate_pct"), *keys)
    )


def churn_trend(events: DataFrame, as_of: date | None = None, months: int = 12) -> DataFrame:
    """Churn events per calendar month over the last ``months`` months."""
    return (
        events.filter(F.col("churn_date") >= F.add_months(as_of_column(as_of), -months))
        .groupBy(month_bucket(F.col("churn_date")).alias("churn_month"))
        .agg(
            F.count("*").alias("churned_customers"),
            F.avg("tenure_months").alias("avg_tenure_at_churn"),
            F.avg("monthly_charges").alias("avg_monthly_charges"),
        )
        .orderBy("churn_month")
    )


def with_risk_signals(churn: DataFrame) -> DataFrame:
    """Add the five 0/1 risk signals and their sum to every row."""
    signals = (
        F.col("contract_type") == "Month-to-month",
        F.col("tenure_months") <= 6,
        F.col("payment_method") == "Electronic check",
        F.col("monthly_charges") > 70,
        F.col("tech_support") == "No",
    )
    flagged = churn.withColumns({n: flag(p) for n, p in zip(RISK_SIGNALS, signals)})
    return flagged.withColumn("risk_score", sum((F.col(n) for n in RISK_SIGNALS), F.lit(0)))


def risk_signals(churn: DataFrame) -> DataFrame:
    """Signals and score of the customers who have not churned."""
    active = with_risk_signals(churn.filter(F.col("churn") == 0))
    return active.select("customer_id", *RISK_SIGNALS, "risk_score")


def high_risk_customers(
    customers: DataFrame, churn: DataFrame, min_score: int = 3, top: int = 100
) -> DataFrame:
    """The ``top`` riskiest active customers; equal rows are ordered by customer id."""
    scores = risk_signals(churn).select("customer_id", "risk_score")
    score = F.col("risk_score")
    category = (
        F.when(score >= 4, "Critical Risk")
        .when(score >= 3, "High Risk")
        .when(score >= 2, "Medium Risk")
        .otherwise("Low Risk")
    )
    return (
        customers.join(scores.filter(score >= min_score), "customer_id")
        .select(
            "customer_id", "gender", "tenure_months", "contract_type", "monthly_charges",
            "payment_method", "risk_score", category.alias("risk_category"),
        )
        .orderBy(F.desc("risk_score"), F.desc("monthly_charges"), "customer_id")
        .limit(top)
    )


def campaign_impact(
    campaigns: DataFrame,
    targets: DataFrame,
    customers: DataFrame,
    churn: DataFrame,
    as_of: date | None = None,
    months: int = 6,
    baseline_contract: str = "Month-to-month",
) -> DataFrame:
    """Churn of the targeted customers per recent campaign against a contract baseline.

    Both sides of the customer join are counted per customer first, so repeated targets and repeated
    customers travel as numbers. A target without a customer counts as not churned.
    """
    recent = campaigns.filter(
        F.col("campaign_start_date") >= F.add_months(as_of_column(as_of), -months)
    ).select("campaign_id", "campaign_name")
    touched = (
        targets.join(recent, "campaign_id")
        .groupBy("campaign_id", "campaign_name", "customer_id")
        .agg(F.count("*").alias("touches"))
    )
    known = (
        customers.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.count("*").alias("records"), F.sum(flag(F.col("churn") == 1)).alias("churned"))
    )
    rows = F.sum(F.col("touches") * F.coalesce("records", F.lit(1)))
    churned = F.sum(F.col("touches") * F.coalesce("churned", F.lit(0)))
    per_campaign = (
        touched.join(known, "customer_id", "left")
        .groupBy("campaign_id", "campaign_name")
        .agg(
            F.count("customer_id").alias("customers_targeted"),
            churned.alias("churned_after_campaign"),
            (ratio(churned, rows) * 100).alias("rate"),
        )
    )
    baseline = churn.filter(F.col("contract_type") == baseline_contract).agg(
        (F.avg("churn") * 100).alias("baseline")
    )
    lift = ratio(F.col("baseline_churn_rate_pct") - F.col("rate"), F.col("baseline_churn_rate_pct"))
    return (
        per_campaign.withColumn("baseline_churn_rate_pct", baseline.scalar())
        .select(
            "campaign_id",
            "campaign_name",
            "customers_targeted",
            "churned_after_campaign",
            F.round("rate", 2).alias("churn_rate_pct"),
            "baseline_churn_rate_pct",
            F.round(lift * 100, 2).alias("retention_improvement_pct"),
        )
        .orderBy(F.desc("retention_improvement_pct"), "campaign_id")
    )


def data_quality(churn: DataFrame) -> DataFrame:
    """Six quality measures in long form from one pass over the table."""
    key, label = F.col("customer_id"), F.col("churn")
    negatives, positives = F.sum(flag(label == 0)), F.sum(flag(label == 1))
    measures = {
        "Total Records": F.count("*"),
        "Missing Customer IDs": F.sum(flag(key.isNull())),
        "Missing Tenure": F.sum(flag(F.col("tenure_months").isNull())),
        "Duplicate Customer IDs": F.count("*") - F.countDistinct(key),
        "Churn Rate": percent(label),
        "Class Imbalance Ratio": F.round(
            negatives.cast("double") / F.nullif(positives, F.lit(0)), 2
        ),
    }
    wide = churn.agg(*[m.cast("double").alias(n) for n, m in measures.items()])
    return wide.unpivot([], list(measures), "metric", "value")
