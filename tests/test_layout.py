"""Stored layouts and day bitmaps: same rows as without them, and the plans they are made for."""

import io
import re
from contextlib import contextmanager, redirect_stdout
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import registry
from keepwell.operators import bitmaps
from keepwell.plans import extract
from keepwell.scratch import materialise
from keepwell.sources import layout
from keepwell.sources import star_binding as star
from keepwell.sources.star_binding import StarBinding


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@contextmanager
def without_broadcasts(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture(scope="module")
def bound(spark, data):
    return StarBinding(spark, data)


@pytest.fixture(scope="module")
def activity(bound):
    return materialise(bound.customer_activity(), "activity")


def test_joins_of_stored_tables_need_no_shuffle(spark, bound):
    store = registry.stored_by_customer(bound)
    with without_broadcasts(spark):
        stored = extract.stored_churn_dataset(store, signup_from=star.SIGNUP_FROM)
        text = plan(stored)
        assert "Exchange" not in text and len(re.findall(r"\(\d+\) SortMergeJoin", text)) == 3
        assert "Exchange" in plan(registry.churn_table(bound))
        counted = store["churn_events"].groupBy("customer_id").count()
        assert "Exchange" not in plan(counted)
        assert rows(stored) == rows(registry.churn_table(bound))


def test_heavy_keys_of_a_store_are_salted(spark, bound):
    store = registry.stored_by_customer(bound, min_rows=1)
    assert store.heavy["churn_events"] and set(store.heavy["churn_events"].values()) == {2}
    assert not store.heavy["billing"]
    salted = extract.stored_churn_dataset(store, signup_from=star.SIGNUP_FROM, hot_key_rows=1)
    assert "_salt" in plan(salted)
    assert rows(salted) == rows(registry.churn_table(bound))


def test_stored_tables_keep_null_keys_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, "a"), (1, None), (1, "b"), (1, "b"), (7, "c")], "customer_id bigint, x string")
    assert rows(layout.write_buckets(df, "customer_id", 4)) == rows(df)
    empty = layout.store_by_key({"none": df.filter("false")}, "customer_id", 4)
    assert empty["none"].count() == 0 and empty.heavy == {"none": {}}


@pytest.fixture(scope="module")
def year(spark):
    """Three rows a day for 2023 and 2024, with some rows without a date."""
    day = F.date_add(F.lit(date(2023, 1, 1)), (F.col("id") % 731).cast("int"))
    return spark.range(3 * 731).select("id", F.when(F.col("id") % 97 != 0, day).alias("day"), (F.col("id") % 5).alias("customer_id"))


def test_a_window_reads_the_folders_of_its_months(spark, year):
    path = layout.write_by_month(year, "day", files_per_month=2)
    end = date(2024, 3, 10)
    recent = layout.read_window(spark, path, year, "day", end, 20).filter(F.col("day") <= F.lit(end))
    whole = year.filter((F.col("day") >= F.lit(end - timedelta(20))) & (F.col("day") <= F.lit(end)))
    assert recent.columns == year.columns and rows(recent) == rows(whole)
    text = plan(layout.read_window(spark, path, year, "day", end, 20))
    assert re.search(r"PartitionFilters: \[.*stored_month#\d+ >= 202402", text)
    assert "GreaterThanOrEqual(day,2024-02-19)" in text

    def files(days):
        part = layout.read_window(spark, path, year, "day", date(2024, 12, 31), days)
        leaf = part._jdf.queryExecution().sparkPlan().collectLeaves().head()
        return leaf.selectedPartitions().totalNumberOfFiles(), leaf.relation().location().inputFiles()

    few, every = files(20)
    # 24 months and one folder without a date, each with one or two files.
    assert few <= 2 and len(every) >= 25
    assert few < files(90)[0] <= 8 and 24 <= files(5000)[0] < len(every)


def test_a_large_month_is_written_by_several_tasks(spark):
    day = F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 40).cast("int"))
    df = spark.range(0, 40_000, 1, 8).select("id", F.when(F.col("id") % 10 != 0, day).alias("day"))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "32k")
    try:
        path = layout.write_by_month(df, "day")
    finally:
        spark.conf.set(name, before)
    stored = spark.read.parquet(path)
    assert rows(stored.drop(layout.MONTH)) == rows(df)
    files = stored.filter(F.col(layout.MONTH) == 202401).groupBy(F.input_file_name()).count().collect()
    assert len(files) > 1 and max(f["count"] for f in files) < 20_000


def test_a_window_of_an_empty_table(spark, year):
    path = layout.write_by_month(year.filter("false"), "day")
    assert layout.read_window(spark, path, year, "day", date(2024, 1, 1)).count() == 0


@pytest.mark.parametrize("days", [20, 90])
def test_metrics_by_bitmaps_are_the_metrics(activity, days):
    found = extract.activity_metrics_by_bitmaps(activity, star.ACTIVITY_AS_OF, days)
    exact = extract.activity_metrics(activity, star.ACTIVITY_AS_OF, days)
    assert rows(found) == rows(exact) and found.columns == exact.columns
    assert "Expand" not in plan(found) and "Expand" in plan(exact)


def test_metrics_by_bitmaps_with_nulls_and_other_login_days(spark, activity):
    odd = activity.withColumn("customer_id", F.when(F.col("customer_id") % 4 != 0, F.col("customer_id") % 5))
    odd = odd.withColumn("login_date", F.date_sub("login_date", (F.hash("support_ticket_id", "activity_date") % 400).cast("int")))
    found = extract.activity_metrics_by_bitmaps(odd, star.ACTIVITY_AS_OF, 20)
    assert rows(found) == rows(extract.activity_metrics(odd, star.ACTIVITY_AS_OF, 20))
    assert found.filter("customer_id is null").count() == 1
    assert extract.activity_metrics_by_bitmaps(odd.filter("false"), star.ACTIVITY_AS_OF, 20).count() == 0


def test_bitmaps_of_parts_count_days_of_any_window(spark, year):
    keys = ["customer_id"]
    parts = [bitmaps.day_bitmaps(year.filter(F.col("id") % 3 != n), keys, "day") for n in range(3)]
    merged = materialise(bitmaps.merge_bitmaps(parts, keys), "merged")
    assert rows(merged) == rows(bitmaps.day_bitmaps(year, keys, "day"))
    edges = [date(2023, 1, 1), date(2023, 1, 31), date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1), date(2025, 5, 5)]
    for first in [None, *edges]:
        for last in [None, *edges]:
            chosen = year.filter("day is not null")
            chosen = chosen if first is None else chosen.filter(F.col("day") >= F.lit(first))
            chosen = chosen if last is None else chosen.filter(F.col("day") <= F.lit(last))
            wanted = chosen.groupBy("customer_id").agg(F.countDistinct("day").alias("n_days"))
            assert rows(bitmaps.distinct_days(merged, keys, first, last)) == rows(wanted), (first, last)
