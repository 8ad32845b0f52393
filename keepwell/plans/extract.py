"""Extraction of the labelled training table and of customer behaviour."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.functions.columns import as_of_column, flag, month_boundaries
from keepwell.operators.bitmaps import day_bitmaps, distinct_days
from keepwell.operators.joins import HOT_KEY_ROWS, left_joins
from keepwell.sources.layout import KeyedStore

CUSTOMER_COLUMNS = ("customer_id", "gender", "senior_citizen", "partner", "dependents", "tenure_months")
SERVICE_COLUMNS = (
    "phone_service", "multiple_lines", "internet_service", "online_security", "online_backup",
    "device_protection", "tech_support", "streaming_tv", "streaming_movies",
)
BILLING_COLUMNS = (
    "contract_type", "paperless_billing", "payment_method", "monthly_charges", "total_charges",
)


def churn_dataset(
    customers: DataFrame,
    services: DataFrame,
    billing: DataFrame,
    churn_events: DataFrame,
    signup_from: date = date(2020, 1, 1),
    statuses: Sequence[str] = ("Active", "Churned"),
    hot_key_rows: int = HOT_KEY_ROWS,
    heavy_keys: Sequence[Mapping] | None = None,
) -> DataFrame:
    """One row per customer and matching service, billing and event row; ``churn`` = an event exists.

    Repeated rows on the right multiply the customer's rows; removing them is a separate step.
    ``heavy_keys``: heavy customers of the three right tables, if known (see :func:`stored_churn_dataset`).
    """
    eligible = customers.filter(
        F.col("status").isin(*statuses) & (F.col("signup_date") >= F.lit(signup_from))
    ).select(*CUSTOMER_COLUMNS)
    rights = [
        services.select("customer_id", *SERVICE_COLUMNS),
        billing.select("customer_id", *BILLING_COLUMNS),
        churn_events.select("customer_id", "churn_date"),
    ]
    joined = left_joins(eligible, rights, "customer_id", hot_key_rows, heavy_keys)
    return joined.select(
        *CUSTOMER_COLUMNS,
        *SERVICE_COLUMNS,
        *BILLING_COLUMNS,
        flag(F.col("churn_date").isNotNull()).alias("churn"),
    )


def stored_churn_dataset(store: KeyedStore, **options) -> DataFrame:
    """:func:`churn_dataset` over tables in buckets of the customer, so that its joins need no shuffle.

    The store has ``customers``, ``services``, ``billing`` and ``churn_events``; rows of its heavy keys are salted.
    """
    rights = ("services", "billing", "churn_events")
    heavy = [store.heavy[name] for name in rights]
    return churn_dataset(store["customers"], *[store[name] for name in rights], heavy_keys=heavy, **options)


def _exact_average(measure: str) -> Column:
    """Average of a column from its exact sum in millionths, the same in every order of the rows."""
    total = F.sum(F.col(measure).cast("decimal(28,6)")).cast("double")
    return F.try_divide(total, F.count(measure).cast("double"))


def activity_metrics(
    activity: DataFrame,
    as_of: date | None = None,
    window_days: int = 90,
    approximate: bool = False,
) -> DataFrame:
    """Behaviour per customer over the last ``window_days`` days.

    ``total_logins_last_90_days`` counts distinct login days and keeps its name for any window.
    ``approximate`` counts distinct values with a sketch, which avoids multiplying the rows.
    """
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    today = as_of_column(as_of)
    start = F.min("signup_date")
    end = F.coalesce(F.max("churn_date"), today)
    return (
        activity.filter(F.col("activity_date") >= F.date_sub(today, window_days))
        .groupBy("customer_id")
        .agg(
            month_boundaries(start, end).alias("activity_tenure_months"),
            F.datediff(end, start).alias("tenure_days"),
            distinct("login_date").alias("total_logins_last_90_days"),
            _exact_average("session_duration_minutes").alias("avg_session_duration"),
            distinct("support_ticket_id").alias("total_support_tickets"),
            F.sum(flag(F.col("ticket_status") == "Unresolved")).alias("unresolved_tickets"),
            F.sum(flag(F.col("payment_status") == "Late")).alias("late_payments"),
            F.max("days_since_last_payment").alias("days_since_last_payment"),
        )
    )


def activity_metrics_by_bitmaps(
    activity: DataFrame, as_of: date | None = None, window_days: int = 90
) -> DataFrame:
    """The rows of :func:`activity_metrics`, with login days counted in bitmaps.

    Only the tickets are counted as distinct values, so that no row is multiplied before the shuffle.
    """
    today = as_of_column(as_of)
    windowed = activity.filter(F.col("activity_date") >= F.date_sub(today, window_days))
    days = distinct_days(day_bitmaps(windowed, ["customer_id"], "login_date"), ["customer_id"])
    start, end = F.min("signup_date"), F.coalesce(F.max("churn_date"), today)
    others = windowed.groupBy("customer_id").agg(
        month_boundaries(start, end).alias("activity_tenure_months"),
        F.datediff(end, start).alias("tenure_days"),
        _exact_average("session_duration_minutes").alias("avg_session_duration"),
        F.countDistinct("support_ticket_id").alias("total_support_tickets"),
        F.sum(flag(F.col("ticket_status") == "Unresolved")).alias("unresolved_tickets"),
        F.sum(flag(F.col("payment_status") == "Late")).alias("late_payments"),
        F.max("days_since_last_payment").alias("days_since_last_payment"),
    )
    # Rows without a customer form a group of their own, so the keys are compared as values.
    days = days.withColumnRenamed("customer_id", "owner")
    logins = F.coalesce("n_days", F.lit(0).cast("long")).alias("total_logins_last_90_days")
    return others.join(days, F.col("customer_id").eqNullSafe(F.col("owner")), "left").select(
        "customer_id", "activity_tenure_months", "tenure_days", logins, "avg_session_duration",
        "total_support_tickets", "unresolved_tickets", "late_payments", "days_since_last_payment",
    )


def customer_behavior(
    customers: DataFrame,
    activity: DataFrame,
    as_of: date | None = None,
    window_days: int = 90,
    null_label: str | None = None,
) -> DataFrame:
    """Customers with their behaviour metrics, segment and engagement level.

    A customer without activity falls into the last step of both ladders unless ``null_label`` names
    a label of its own.
    """
    metrics = activity_metrics(activity, as_of, window_days).drop("tenure_days")
    tenure = F.col("activity_tenure_months")
    logins = F.col("total_logins_last_90_days")

    def ladder(measure, steps, last):
        label = F.when(measure.isNull(), F.lit(last if null_label is None else null_label))
        for predicate, name in steps:
            label = label.when(predicate, name)
        return label.otherwise(last)

    segment = ladder(
        tenure,
        [(tenure <= 6, "New Customer"), (tenure <= 24, "Regular Customer")],
        "Loyal Customer",
    )
    engagement = ladder(
        logins,
        [(logins < 5, "Low Engagement"), (logins < 20, "Medium Engagement")],
        "High Engagement",
    )
    return customers.join(metrics, "customer_id", "left").select(
        *customers.columns,
        *[c for c in metrics.columns if c != "customer_id"],
        segment.alias("customer_segment"),
        engagement.alias("engagement_level"),
    )
