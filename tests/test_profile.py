import pytest
from pyspark.sql import functions as F

import registry
from keepwell.operators import cleaning, features, profile
from keepwell.scratch import materialise
from keepwell.sources.star_binding import StarBinding

SCHEMA = "customer_id long, churn int, n int, x double, s string, gone string"


@pytest.fixture
def raw(spark):
    rows = [
        (k, k % 2, None if k % 7 == 0 else k % 5, float("nan") if k % 11 == 0 else k / 3, None if k % 13 == 0 else f"v{k % 4}", None)
        for k in range(200)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def jobs(spark, name, work):
    """How many jobs ``work`` starts, and its result."""
    context = spark.sparkContext
    context.setJobGroup(name, name)
    try:
        result = work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(name)), result


@pytest.mark.parametrize("partitions", [1, 16])
def test_profile_of_the_written_rows(raw, partitions):
    table, found = profile.write_profiled(raw.repartition(partitions), "raw")
    assert sorted(map(str, table.collect())) == sorted(map(str, raw.collect()))
    assert found.rows == 200
    counted = {r["column"]: r["n_missing"] for r in cleaning.null_counts(raw).collect()}
    assert {c: n for c, n in found.missing.items() if n} == counted
    want = features.feature_moments(raw, ["customer_id", "churn", "n"]).collect()
    for row in want:
        assert found.moments[row["feature"]] == pytest.approx((row["mean"], row["sd"]))


def test_profile_of_an_empty_table(spark):
    table, found = profile.write_profiled(spark.createDataFrame([], SCHEMA), "empty")
    assert table.count() == 0 and found.rows == 0 and set(found.missing.values()) == {0}
    assert found.moments["x"] == (None, None)
    fitted, table = features.fit_while_writing(spark.createDataFrame([], SCHEMA))
    assert fitted.transform(table).count() == 0


def test_columns_without_a_value_stay(raw):
    rows = cleaning.clean(raw).collect()
    assert all(r["gone"] is None and r["s"] is not None and r["x"] == r["x"] for r in rows)


@pytest.mark.parametrize("inline, windowed", [(256, 100_000), (2, 100_000), (2, 3)])
def test_fit_while_writing_equals_the_fit_of_a_written_table(spark, raw, monkeypatch, inline, windowed):
    monkeypatch.setattr(features, "INLINE_LABELS", inline)
    monkeypatch.setattr(features, "WINDOWED_LABELS", windowed)
    full = cleaning.clean(raw).withColumn("flag", F.col("n") > 2).withColumn("two", F.concat(F.lit("t"), F.col("customer_id") % 2))
    want = features.fit_features(full)
    got, table = features.fit_while_writing(full)
    assert (got.names, got.encoded, got.inline) == (want.names, want.encoded, want.inline)
    assert list(got.moments) == [n for n in want.names if n in want.moments]
    for name, pair in want.moments.items():
        assert got.moments[name] == pytest.approx(pair)
    assert sorted(map(tuple, got.labels.collect())) == sorted(map(tuple, want.labels.collect()))
    rows = {r["customer_id"]: r for r in want.transform(full).collect()}
    for row in got.transform(table).collect():
        assert tuple(row) == pytest.approx(tuple(rows[row["customer_id"]]))


def test_a_third_fewer_jobs(spark, data):
    """Against the passes one by one: missing values, sizes, values; labels, their sizes, the small ones, moments."""
    churn = materialise(registry.churn_table(StarBinding(spark, data)), "churn")

    def by_passes():
        unique = materialise(cleaning.drop_duplicate_keys(churn), "unique")
        missing = [r["column"] for r in cleaning.null_counts(unique).collect()]
        numeric = [c for c in cleaning.numeric_columns(unique) if c in missing]
        cleaning.exact_quantiles(unique, {c: F.col(c) for c in numeric})
        cleaning.modes(unique, [c for c in cleaning.string_columns(unique) if c in missing]).collect()
        table = materialise(features.engineer(unique), "engineered")
        return features.fit_features(table)

    before, _ = jobs(spark, "passes", by_passes)
    after, (fitted, table) = jobs(spark, "profiled", lambda: features.fit_while_writing(features.engineer(cleaning.clean(churn))))
    assert fitted.transform(table).count() == churn.count()
    assert 3 * after <= 2 * before
