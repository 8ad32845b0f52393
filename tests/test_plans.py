"""Shape of the physical plans: pruning, pushdown, single scans and no pairwise joins."""

import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

import registry
from keepwell.plans import extract, reports
from keepwell.scratch import materialise
from keepwell.sources import star_binding as star
from keepwell.sources.star_binding import StarBinding


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def stored(spark, data):
    bound = StarBinding(spark, data)
    names = ("customers", "services", "billing", "churn_events", "customer_activity")
    return {name: materialise(getattr(bound, name)(), name) for name in names}


@pytest.fixture(scope="module")
def churn(stored):
    return materialise(
        extract.churn_dataset(
            stored["customers"], stored["services"], stored["billing"], stored["churn_events"],
            star.SIGNUP_FROM,
        )
    )


def test_extraction_filters_reach_the_scan(stored):
    text = plan(
        extract.churn_dataset(
            stored["customers"], stored["services"], stored["billing"], stored["churn_events"],
            star.SIGNUP_FROM,
        )
    )
    pushed = re.findall(r"PushedFilters: \[(.*)\]", text)
    assert any("In(status" in p and "GreaterThanOrEqual(signup_date" in p for p in pushed)
    assert not any("status" in line and "monthly_charges" in line for line in text.splitlines() if "ReadSchema" in line)


def test_activity_window_reaches_the_scan(stored):
    text = plan(extract.activity_metrics(stored["customer_activity"], star.ACTIVITY_AS_OF, 20))
    assert "GreaterThanOrEqual(activity_date,2024-01-11)" in text


def test_cohorts_read_only_their_columns(churn):
    text = plan(reports.cohort_churn(churn))
    read = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {
        "contract_type", "payment_method", "churn", "monthly_charges", "tenure_months",
    }


def test_quality_report_scans_once(churn):
    assert len(re.findall(r"\(\d+\) Scan parquet", plan(reports.data_quality(churn)))) == 1


def test_top_list_sorts_and_limits_in_one_step(stored, churn):
    text = plan(reports.high_risk_customers(stored["customers"], churn))
    assert "TakeOrderedAndProject" in text and "EqualTo(churn,0)" in text


@pytest.mark.parametrize(
    "name",
    ["churn_dataset", "customer_behavior", "cohort_churn", "churn_trend", "high_risk_customers",
     "campaign_impact", "data_quality", "dedupe", "null_counts", "modes", "retention_impact",
     "impact_scenarios", "decile_lift", "roc_curve"],
)
def test_no_pairwise_joins_and_no_row_functions(spark, data, name):
    text = plan(registry.queries()[name](spark, data))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in text


@pytest.mark.parametrize("shuffles", ["1", "4", "16"])
@pytest.mark.parametrize("name", ["cohort_churn", "decile_lift", "roc_auc", "modes", "clean", "stratified_split"])
def test_results_do_not_depend_on_partitions(spark, data, name, shuffles):
    def rows():
        return sorted(map(str, registry.queries()[name](spark, data).collect()))

    usual = rows()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    try:
        assert rows() == usual
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_missing_metrics_fall_into_the_last_step_unless_named(spark):
    customers = spark.createDataFrame([(1,), (2,)], "customer_id bigint")
    activity = spark.sql(
        "select 1L customer_id, date'2024-01-01' signup_date, cast(null as date) churn_date, "
        "date'2024-01-20' activity_date, date'2024-01-20' login_date, 5D session_duration_minutes, "
        "7L support_ticket_id, 'Unresolved' ticket_status, 'Late' payment_status, "
        "3 days_since_last_payment"
    )
    day = star.ACTIVITY_AS_OF
    rows = extract.customer_behavior(customers, activity, day).orderBy("customer_id").collect()
    labels = [(r["customer_segment"], r["engagement_level"]) for r in rows]
    assert labels == [("New Customer", "Low Engagement"), ("Loyal Customer", "High Engagement")]
    named = extract.customer_behavior(customers, activity, day, null_label="Unknown")
    assert named.filter("customer_id = 2").first()["customer_segment"] == "Unknown"
    ladder = activity.withColumn("signup_date", F.lit(star.date(2020, 1, 1)))
    assert extract.customer_behavior(customers, ladder, day).filter("customer_id = 1").first()[
        "customer_segment"
    ] == "Loyal Customer"


def test_event_rows_multiply_customers(spark):
    customers = spark.sql(
        "select 1L customer_id, 'F' gender, 0 senior_citizen, 'No' partner, 'No' dependents, "
        "5 tenure_months, 'Active' status, date'2021-01-01' signup_date"
    )
    empty = {c: F.lit(None).cast("string") for c in extract.SERVICE_COLUMNS + extract.BILLING_COLUMNS}
    others = spark.range(0).withColumnRenamed("id", "customer_id").withColumns(empty)
    events = spark.sql("select 1L customer_id, d churn_date from values (date'2022-01-01'), (null) t(d)")
    rows = extract.churn_dataset(customers, others, others, events).collect()
    assert sorted(r["churn"] for r in rows) == [0, 1]


def test_approximate_counts_read_each_row_once(stored):
    exact = extract.activity_metrics(stored["customer_activity"], star.ACTIVITY_AS_OF, 20)
    quick = extract.activity_metrics(stored["customer_activity"], star.ACTIVITY_AS_OF, 20, True)
    assert "Expand" in plan(exact) and "Expand" not in plan(quick)
    assert quick.columns == exact.columns and quick.count() == exact.count()
