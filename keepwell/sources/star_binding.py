"""Derive the churn schema from the star-schema test tables.

Plain arithmetic on the given columns only, so that another engine gives the same values.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.functions.columns import month_boundaries

AS_OF = date(2001, 8, 1)
ACTIVITY_AS_OF = date(2024, 1, 31)
SIGNUP_FROM = date(1997, 1, 1)
ACTIVITY_DAYS = 20
DEFAULT_ACTIVITY_DAYS = 90
LOGIN_PARTS = ((date(1900, 1, 1), date(2024, 1, 14)), (date(2024, 1, 10), date(2024, 1, 20)), (date(2024, 1, 21), date(9999, 1, 1)))
TREND_MONTHS = 24
CAMPAIGN_MONTHS = 6
SCORE_THRESHOLD = 0.5

SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def _yes(predicate: Column) -> Column:
    return F.when(predicate, "Yes").otherwise("No")


class StarBinding:
    """Lazily built churn tables over one test-data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def source(self, name: str) -> DataFrame:
        """Scan with a declared schema, which saves a look into the files."""
        reader = self.spark.read.schema(SOURCE_SCHEMAS[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    def base(self) -> DataFrame:
        orders = (
            self.source("orders")
            .groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(
                F.count("*").alias("n_orders"),
                F.max(F.col("o_orderdate").cast("date")).alias("last_order"),
            )
        )
        offset = (F.col("c_custkey") * 7919 % 1800).cast("int")
        lapsed = F.col("last_order") < F.date_sub(F.lit(AS_OF), 365)
        return (
            self.source("customer")
            .join(orders, "c_custkey", "left")
            .withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))
            .withColumn("signup_date", F.date_sub("last_order", offset))
            .withColumn("churn_date", F.when(lapsed, F.date_add("last_order", 30)))
        )

    @staticmethod
    def _billing_columns() -> dict[str, Column]:
        segment = F.col("c_mktsegment")
        method = F.col("c_nationkey") % 4
        monthly = F.lit(20) + (F.col("c_acctbal") + 1000) / 100
        return {
            "contract_type": F.when(segment.isin("AUTOMOBILE", "BUILDING"), "Month-to-month")
            .when(segment.isin("FURNITURE", "HOUSEHOLD"), "One year")
            .otherwise("Two year"),
            "paperless_billing": _yes(F.col("c_custkey") % 2 == 0),
            "payment_method": F.when(method == 0, "Electronic check")
            .when(method == 1, "Mailed check")
            .when(method == 2, "Bank transfer")
            .otherwise("Credit card"),
            "monthly_charges": monthly,
            "total_charges": monthly * F.col("n_orders"),
        }

    def billing(self) -> DataFrame:
        columns = [c.alias(n) for n, c in self._billing_columns().items()]
        return (
            self.base()
            .filter(F.col("c_custkey") % 13 != 0)
            .select(F.col("c_custkey").alias("customer_id"), *columns)
        )

    def services(self) -> DataFrame:
        k = F.col("c_custkey")
        support = F.col("c_nationkey") % 3
        return (
            self.source("customer")
            .filter(k % 11 != 0)
            .select(
                k.alias("customer_id"),
                _yes(k % 10 != 0).alias("phone_service"),
                _yes(k % 3 == 0).alias("multiple_lines"),
                F.when(k % 3 == 0, "DSL").when(k % 3 == 1, "Fiber optic").otherwise("No")
                .alias("internet_service"),
                _yes(k % 4 == 0).alias("online_security"),
                _yes(k % 5 == 1).alias("online_backup"),
                _yes(k % 6 == 1).alias("device_protection"),
                F.when(support == 0, "No").when(support == 1, "Yes").otherwise("No internet service")
                .alias("tech_support"),
                _yes(k % 7 == 1).alias("streaming_tv"),
                _yes(k % 8 == 1).alias("streaming_movies"),
            )
        )

    def customers(self) -> DataFrame:
        k = F.col("c_custkey")
        billed = k % 13 != 0
        billing = self._billing_columns()
        carried = ("contract_type", "payment_method", "monthly_charges")
        until = F.coalesce("churn_date", F.lit(AS_OF))
        return self.base().select(
            k.alias("customer_id"),
            F.when(k % 2 == 0, "Female").otherwise("Male").alias("gender"),
            F.when(k % 5 == 0, 1).otherwise(0).alias("senior_citizen"),
            _yes(k % 3 == 1).alias("partner"),
            _yes(k % 4 == 1).alias("dependents"),
            "signup_date",
            F.when(k % 29 == 0, "Suspended").when(F.col("churn_date").isNull(), "Active")
            .otherwise("Churned").alias("status"),
            month_boundaries(F.col("signup_date"), until).alias("tenure_months"),
            *[F.when(billed, billing[n]).alias(n) for n in carried],
            F.when(F.col("churn_date").isNotNull(), 1).otherwise(0).alias("churn"),
        )

    def churn_events(self) -> DataFrame:
        k = F.col("c_custkey")
        tenure = month_boundaries(F.col("signup_date"), F.col("churn_date"))
        monthly = self._billing_columns()["monthly_charges"]
        repeats = F.when(k % 17 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return (
            self.base()
            .filter(F.col("churn_date").isNotNull())
            .select(
                k.alias("customer_id"),
                "churn_date",
                tenure.alias("tenure_months"),
                F.when(k % 13 != 0, monthly).alias("monthly_charges"),
                F.explode(repeats).alias("occurrence"),
            )
            .drop("occurrence")
        )

    def customer_activity(self) -> DataFrame:
        kind = F.col("event_type")
        day = F.col("ts").cast("date")
        owners = self.base().select(F.col("c_custkey").alias("user_id"), "signup_date", "churn_date")
        return (
            self.source("events")
            .join(owners, "user_id", "left")
            .select(
                F.col("user_id").alias("customer_id"),
                "signup_date",
                "churn_date",
                day.alias("activity_date"),
                F.when(kind == "click", day).alias("login_date"),
                F.col("value").alias("session_duration_minutes"),
                F.when(kind == "error", F.col("event_id")).alias("support_ticket_id"),
                F.when(
                    kind == "error",
                    F.when(F.col("event_id") % 3 == 0, "Unresolved").otherwise("Resolved"),
                ).alias("ticket_status"),
                F.when(
                    kind == "purchase", F.when(F.col("event_id") % 4 == 0, "Late").otherwise("OnTime")
                ).alias("payment_status"),
                F.when(kind == "purchase", F.datediff(F.lit(ACTIVITY_AS_OF), day))
                .alias("days_since_last_payment"),
            )
        )

    def retention_campaigns(self) -> DataFrame:
        start = F.date_add(F.lit(date(2001, 1, 15)), F.col("r_regionkey") * 30)
        return self.source("region").select(
            F.col("r_regionkey").alias("campaign_id"),
            F.col("r_name").alias("campaign_name"),
            start.alias("campaign_start_date"),
        )

    def retention_targets(self) -> DataFrame:
        k = F.col("c_custkey")
        nations = self.source("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("campaign_id")
        )
        targeted = F.when(k % 3 != 0, F.array(k))
        orphan = F.when(k % 50 == 0, F.array(k + 1000000))
        empty = F.array().cast("array<bigint>")
        ids = F.concat(F.coalesce(targeted, empty), F.coalesce(orphan, empty))
        return (
            self.source("customer")
            .join(nations, "c_nationkey")
            .select("campaign_id", F.explode(ids).alias("customer_id"))
        )
