import pytest
from pyspark.sql import functions as F

from keepwell.operators import cleaning

SCHEMA = "customer_id bigint, churn int, n int, d double, s string, gone string"


@pytest.fixture
def raw(spark):
    rows = [
        (1, 0, 1, 1.0, "a", None), (2, 1, 2, 2.0, "b", None), (3, 0, None, float("nan"), "a", None),
        (4, 0, 4, None, "b", None), (5, 1, 11, 8.0, None, None), (None, 0, 10, 3.0, None, None),
        (None, 1, 12, 3.0, None, None), (1, 1, 99, 5.0, "z", None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_first_row_in_the_given_order_survives(spark, raw):
    kept = {r["customer_id"]: r["n"] for r in cleaning.drop_duplicate_keys(raw, order_by=["n"]).collect()}
    assert kept == {1: 1, 2: 2, 3: None, 4: 4, 5: 11, None: 10}
    for partitions in (1, 4, 16):
        again = cleaning.drop_duplicate_keys(raw.repartition(partitions), order_by=["n"]).collect()
        assert {r["customer_id"]: r["n"] for r in again} == kept


def test_duplicates_are_reduced_before_the_shuffle(spark, raw):
    plan = cleaning.drop_duplicate_keys(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_duplicate_report_counts_null_as_one_key(raw):
    assert cleaning.duplicate_report(raw).first() == (8, 6, 2)


def test_null_counts_include_nan(raw):
    got = {r["column"]: r["n_missing"] for r in cleaning.null_counts(raw).collect()}
    assert got == {"customer_id": 2, "n": 1, "d": 2, "s": 3, "gone": 8}


def test_modes_prefer_the_smallest_among_equals(raw):
    unique = cleaning.drop_duplicate_keys(raw, order_by=["n"])
    got = {r["column"]: r["mode"] for r in cleaning.modes(unique, ["s", "gone"]).collect()}
    assert got == {"s": "a"}


def test_clean_fills_without_truncating(raw):
    got = cleaning.clean(raw, order_by=["n"])
    rows = {r["customer_id"]: r for r in got.collect()}
    assert dict(got.dtypes)["n"] == "double" and dict(got.dtypes)["churn"] == "int"
    assert rows[3]["n"] == 4.0  # 1, 2, 4, 10, 11
    assert rows[3]["d"] == rows[4]["d"] == 2.5  # 1, 2, 3, 8
    assert rows[5]["s"] == rows[None]["s"] == "a"
    assert all(r["gone"] is None for r in rows.values())


def test_fractional_median_of_integers(spark):
    df = spark.createDataFrame([(1, 0, 1), (2, 0, 2), (3, 0, None)], "customer_id int, churn int, n int")
    assert {r["n"] for r in cleaning.clean(df).collect()} == {1.0, 2.0, 1.5}


def test_include_all_fills_the_key_too(raw):
    got = cleaning.clean(raw, order_by=["n"], include_all=True)
    assert got.filter(F.col("customer_id").isNull()).count() == 0


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cleaning.clean(empty).count() == 0
    assert cleaning.duplicate_report(empty).first()["n_records"] == 0
    assert cleaning.imbalance_ratio(empty).first()[0] is None


def test_class_tables(raw):
    assert [tuple(r) for r in cleaning.class_distribution(raw).collect()] == [(0, 4), (1, 4)]
    assert cleaning.imbalance_ratio(raw.filter("churn = 0 or n = 99")).first()[0] == 0.25
    got = {r["churn"]: r["median_n"] for r in cleaning.median_by_class(raw, "n").collect()}
    assert got == {0: 4.0, 1: 11.5}


def test_approximate_medians(raw):
    got = {r["column"]: r["median"] for r in cleaning.medians(raw, ["n"], accuracy=100).collect()}
    assert got == {"n": 10.0}
