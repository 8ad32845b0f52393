import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keepwell.operators import cleaning, joins, ordering
from keepwell.operators.ordering import (
    class_cuts, cuts_passed, exact_quantiles, key_hash, running_totals,
)
from keepwell.scratch import materialise


def doubles(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_quantiles_match_numpy_when_narrowing(spark, fraction):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=3000), np.full(2500, 0.25), rng.exponential(size=500)])
    df = doubles(spark, values.tolist()).repartition(7)
    found = exact_quantiles(df, {"x": F.col("x"), "y": -F.col("x")}, fraction, exact_rows=20)
    assert found["x"] == pytest.approx(np.quantile(values, fraction), abs=1e-12)
    assert found["y"] == pytest.approx(np.quantile(-values, fraction), abs=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-5, 5).map(float), min_size=1, max_size=40))
def test_median_of_tied_values(spark, values):
    found = exact_quantiles(doubles(spark, values), {"x": F.col("x")}, exact_rows=2)
    assert found["x"] == np.median(values)


def test_quantile_between_two_heavy_values(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") < 9990, 0.0).when(F.col("id") < 10010, F.col("id") / 10000).otherwise(5.0)
        .alias("x")
    )
    expected = np.median(df.toPandas()["x"])
    assert exact_quantiles(df, {"x": F.col("x")}, exact_rows=4)["x"] == pytest.approx(expected)


def test_quantile_skips_nulls_and_nan(spark):
    df = doubles(spark, [1.0, 2.0, 4.0, 10.0, None, float("nan")])
    assert exact_quantiles(df, {"x": F.col("x")})["x"] == 3.0
    assert exact_quantiles(df.filter("x is null"), {"x": F.col("x")})["x"] is None


@pytest.mark.parametrize("slices", [1, 3, 16])
def test_running_totals(spark, slices):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("k"), (F.col("id") % 7).alias("v"))
    got = running_totals(
        df, [F.desc("k")], {"place": F.lit(1), "sum": F.col("v")}, slices
    ).orderBy(F.desc("k")).toPandas()
    assert got["place"].tolist() == list(range(1, 501))
    assert got["sum"].tolist() == got["v"].cumsum().tolist()


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_class_cuts_are_exact_and_stable(spark, partitions):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 5 == 0).cast("int").alias("c"))
    df = df.repartition(partitions)
    cuts = class_cuts(df, "c", "k", lambda n: [0, n // 3, n])
    got = df.withColumn("part", cuts_passed(df, "c", "k", cuts))
    sizes = {(r["c"], r["part"]): r["count"] for r in got.groupBy("c", "part").count().collect()}
    assert sizes == {(0, 1): 800, (0, 2): 1600, (1, 1): 200, (1, 2): 400}
    order = got.withColumn("h", key_hash(df, "k", 42)).toPandas().sort_values(["c", "h", "k"])
    assert (order.groupby("c")["part"].diff().dropna() >= 0).all()


def test_class_cuts_with_equal_hashes_null_and_text_keys(spark):
    shared = [(1000003 * i, "a") for i in range(10)] + [(None, "a")]
    df = spark.createDataFrame(shared, "k bigint, c string")
    cuts = class_cuts(df, "c", "k", lambda n: [1, 4])
    got = df.withColumn("part", cuts_passed(df, "c", "k", cuts)).groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in got} == {0: 1, 1: 3, 2: 7}
    text = df.withColumn("k", F.coalesce(F.col("k").cast("string"), F.lit("none")))
    cuts = class_cuts(text, "c", "k", lambda n: [5])
    parts = text.withColumn("part", cuts_passed(text, "c", "k", cuts)).groupBy("part").count()
    assert {r["part"]: r["count"] for r in parts.collect()} == {0: 5, 1: 6}


def test_heavy_right_keys_are_salted_without_changing_the_join(spark):
    left = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "k bigint, l string"
    )
    right = spark.createDataFrame(
        [(1, i % 3) for i in range(60)] + [(2, 1), (2, None), (None, 5), (9, 9)], "k bigint, r int"
    )
    plain = left.join(right, "k", "left")
    assert joins.hot_keys([right, left], "k", min_rows=10) == [{1: 60}, {}]
    salted = joins.left_joins(left, [right], "k", min_rows=10)
    assert salted.columns == plain.columns
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_heavy_text_keys(spark):
    left = spark.createDataFrame([("x",), ("y",)], "k string")
    right = spark.createDataFrame([("x", i) for i in range(30)], "k string, r int")
    assert joins.left_joins(left, [right], "k", min_rows=5).count() == 31


def test_two_thousand_heavy_keys_and_one_with_a_third_of_the_rows(spark):
    right = spark.range(60_000).select(
        F.when(F.col("id") < 20_000, F.lit(7)).otherwise(F.col("id") % 2000).cast("bigint").alias("k"), F.col("id").alias("r")
    )
    left = spark.range(2100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("l"))
    heavy = joins.hot_keys([right], "k", min_rows=15)[0]
    assert len(heavy) == 2000 and heavy[7] == 20_020
    plain, salted = left.join(right, "k", "left"), joins.left_joins(left, [right], "k", min_rows=15)
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


def test_infinite_values_count_in_quantiles(spark):
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, inf, inf, inf, None, float("nan"))], "v double")
    assert ordering.exact_quantiles(df, {"v": F.col("v")})["v"] == inf
    assert ordering.exact_quantiles(df, {"v": F.col("v")}, exact_rows=1)["v"] == inf
    assert cleaning.medians(df, ["v"], accuracy=1000).first()["median"] == inf
    low = spark.createDataFrame([(v,) for v in (-inf, -inf, -1.0, 3.0, 4.0)], "v double")
    for limit in (1, 100):
        assert ordering.exact_quantiles(low, {"v": F.col("v")}, exact_rows=limit)["v"] == -1.0


def test_slices_follow_the_data_and_keep_the_order(spark, monkeypatch):
    written = []

    def keep(df, label):
        written.append(materialise(df, label))
        return written[-1]

    monkeypatch.setattr(ordering, "materialise", keep)
    df = spark.range(2_000_000).select("id", (F.col("id") % 3).alias("v"))
    got = ordering.running_totals(df, [F.desc("id")], {"place": F.lit(1)})
    assert got.filter(F.col("place") != 2_000_000 - F.col("id")).count() == 0
    assert written[0].select("_slice").distinct().count() > 1


def test_class_cuts_with_ranks_per_class(spark):
    df = spark.range(90).select(F.col("id").alias("k"), (F.col("id") % 3).alias("c"))
    cuts = class_cuts(df, "c", "k", {0: [3], 1: [0], 2: [30]})
    passed = df.withColumn("after", cuts_passed(df, "c", "k", cuts)).filter("after = 0").groupBy("c").count()
    assert {tuple(r) for r in passed.collect()} == {(0, 3), (2, 30)}
