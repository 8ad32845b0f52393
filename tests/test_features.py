import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.operators import features


@pytest.fixture
def table(spark):
    rows = [
        (1, 0, "b", 2.0, 7, True), (2, 1, "B", 4.0, 7, False), (3, 0, "a ", 6.0, 7, True),
        (4, 0, "a", 8.0, 7, True), (5, 1, None, 10.0, 7, None),
    ]
    return spark.createDataFrame(
        rows, "customer_id bigint, churn int, s string, d double, constant int, flag boolean"
    )


def test_engineer_only_uses_present_columns(spark):
    assert features.engineer(spark.range(1)).columns == ["id"]
    df = spark.sql("select 6 tenure_months, 10D monthly_charges, 'Month-to-month' contract_type")
    assert features.engineer(df).select(
        "tenure_years", "is_new_customer", "is_loyal_customer", "total_revenue", "avg_monthly_spend",
        "is_month_to_month",
    ).first() == (0.5, 1, 0, 60.0, 60.0 / 7, 1)
    nulls = spark.sql("select cast(null as int) tenure_months, cast(null as string) contract_type")
    row = features.engineer(nulls).first()
    assert row["is_new_customer"] == row["is_loyal_customer"] == row["is_month_to_month"] == 0
    assert "total_revenue" not in row
    loyal = features.engineer(spark.sql("select 24 tenure_months, 1 monthly_charges")).first()
    assert loyal["is_loyal_customer"] == 1
    odd = features.engineer(spark.sql("select -1 tenure_months, 1D monthly_charges")).first()
    assert odd["avg_monthly_spend"] is None


def test_codes_follow_string_order(table):
    codes = {r["value"]: r["code"] for r in features.fit_labels(table, ["s"]).collect()}
    assert codes == {"B": 0, "a": 1, "a ": 2, "b": 3, "nan": 4}


@pytest.mark.parametrize("inline, windowed", [(256, 100_000), (0, 100_000), (0, 1)])
def test_large_label_sets_give_the_same_codes(table, monkeypatch, inline, windowed):
    monkeypatch.setattr(features, "INLINE_LABELS", inline)
    monkeypatch.setattr(features, "WINDOWED_LABELS", windowed)
    two = table.withColumn("t", F.concat(F.lit("t"), F.col("customer_id") % 2))
    fitted = features.fit_features(two)
    rows = fitted.encode(two).orderBy("customer_id").collect()
    assert [r["s"] for r in rows] == [3, 0, 2, 1, 4]
    assert [r["t"] for r in rows] == [1, 0, 1, 0, 1]
    with pytest.raises(Exception, match="unseen value in s: new"):
        fitted.transform(two.withColumn("s", F.lit("new"))).collect()


def test_scaling_uses_the_population_deviation(table):
    fitted = features.fit_features(table)
    got = fitted.transform(table).orderBy("customer_id").toPandas()
    d = np.array([2.0, 4, 6, 8, 10])
    assert got["d"].tolist() == pytest.approx(((d - d.mean()) / d.std()).tolist())
    assert got["constant"].tolist() == [0.0] * 5
    assert list(got.columns) == ["customer_id", "churn", "s", "d", "constant", "flag"]
    assert fitted.moments.keys() == {"s", "d", "constant"}


def test_new_rows_need_no_label_and_extra_text_is_dropped(table, folder):
    fitted = features.fit_features(table)
    fitted.save(folder)
    again = features.FittedFeatures.load(table.sparkSession, folder)
    new = table.drop("churn").withColumn("remark", F.lit("?"))
    got = again.transform(new)
    assert got.columns == ["customer_id", *fitted.names]
    known = fitted.transform(table).drop("churn")
    assert sorted(map(str, got.collect())) == sorted(map(str, known.collect()))


def test_target_and_types_are_checked(table):
    with pytest.raises(ValueError, match="churn"):
        features.fit_features(table.drop("churn"))
    with pytest.raises(ValueError, match="day"):
        features.fit_features(table.withColumn("day", F.current_date()))


def test_assembled_vector_keeps_the_order(table):
    known = table.na.fill(True, ["flag"])
    fitted = features.fit_features(known)
    row = fitted.assemble(fitted.transform(known)).filter("customer_id = 1").first()
    assert row["features"].toArray().tolist() == [float(row[n]) for n in fitted.names]


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_split_and_folds_are_stratified(spark, partitions):
    df = spark.range(1000).select(
        F.col("id").alias("customer_id"), (F.col("id") % 9 == 0).cast("int").alias("churn")
    ).repartition(partitions)
    split = features.stratified_split(df)
    sizes = {tuple(r)[:2]: r["count"] for r in split.groupBy("churn", "split").count().collect()}
    assert sizes == {(0, "test"): 178, (0, "train"): 710, (1, "test"): 22, (1, "train"): 90}
    first = sorted(r[0] for r in split.filter("split = 'test'").select("customer_id").collect())
    whole = features.stratified_split(df.coalesce(1)).filter("split = 'test'").select("customer_id")
    assert first == sorted(r[0] for r in whole.collect())
    folds = features.stratified_folds(df, "churn", "customer_id", 5)
    for label in (0, 1):
        counts = [r["count"] for r in folds.filter(F.col("churn") == label).groupBy("fold").count().collect()]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_category_of_the_test_part_alone_has_a_code(spark):
    rows = [(k, k % 2, "rare" if k == 9 else "ab"[k % 2], float(k)) for k in range(10)]
    table = spark.createDataFrame(rows, "customer_id long, churn int, kind string, x double")
    train, test = table.filter("customer_id < 8"), table.filter("customer_id >= 8")
    fitted = features.fit_features(train, labels_from=table)
    assert fitted.transform(test).count() == 2
    assert fitted.moments["x"][0] == 3.5
    with pytest.raises(Exception, match="unseen value in kind: rare"):
        features.fit_features(train).transform(test).collect()
    with pytest.warns(UserWarning, match="other"):
        fitted.transform(test.withColumn("other", F.lit("t")))
