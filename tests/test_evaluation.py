import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from keepwell.plans import evaluation, impact, reports


def scored(spark, rows):
    data = [(i, label, float(p), int(p > 0.5)) for i, (label, p) in enumerate(rows)]
    return spark.createDataFrame(data, "customer_id bigint, label int, p double, prediction int")


def pairwise_auc(frame):
    pos, neg = frame[frame.label == 1].p.to_numpy(), frame[frame.label == 0].p.to_numpy()
    wins = (pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()
    return wins / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def random_scores(spark):
    rng = np.random.default_rng(5)
    return scored(spark, [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(701)])


def test_auc_matches_all_pairs(random_scores):
    frame = random_scores.toPandas()
    for partitions in (1, 9):
        got = evaluation.roc_auc(random_scores.repartition(partitions)).first()[0]
        assert got == pytest.approx(pairwise_auc(frame), abs=1e-12)


def test_extreme_areas(spark):
    assert evaluation.roc_auc(scored(spark, [(1, 0.9), (0, 0.1)])).first()[0] == 1.0
    assert evaluation.roc_auc(scored(spark, [(1, 0.1), (0, 0.9)])).first()[0] == 0.0
    assert evaluation.roc_auc(scored(spark, [(1, 0.4), (0, 0.4)])).first()[0] == 0.5
    assert evaluation.roc_auc(scored(spark, [(1, 0.4), (1, 0.6)])).first()[0] is None


def test_curve_ends_at_the_corners_and_encloses_the_area(random_scores):
    curve = evaluation.roc_curve(random_scores).toPandas().sort_values(["fpr", "tpr"])
    assert curve[["fpr", "tpr"]].iloc[0].tolist() == [0, 0]
    assert curve[["fpr", "tpr"]].iloc[-1].tolist() == [1, 1]
    area = np.trapezoid(curve["tpr"], curve["fpr"])
    assert area == pytest.approx(pairwise_auc(random_scores.toPandas()), abs=1e-12)


def test_single_class_curve_has_null_rates(spark):
    curve = evaluation.roc_curve(scored(spark, [(1, 0.2), (1, 0.8)])).collect()
    assert all(r["fpr"] is None for r in curve)


def test_confusion_has_all_cells(spark):
    got = evaluation.confusion_matrix(scored(spark, [(1, 0.9), (1, 0.8)])).collect()
    assert {tuple(r) for r in got} == {(0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 2)}


def test_report_values_and_zero_denominators(spark):
    df = scored(spark, [(1, 0.9), (1, 0.1), (0, 0.9), (0, 0.1), (0, 0.2)])
    rows = {r["class"]: tuple(r)[1:] for r in evaluation.classification_report(df).collect()}
    assert rows["1"] == (0.5, 0.5, 0.5, 2)
    assert rows["0"] == pytest.approx((2 / 3, 2 / 3, 2 / 3, 3))
    assert rows["accuracy"] == pytest.approx((0.6, 0.6, 0.6, 5))
    assert rows["macro avg"][2] == pytest.approx((0.5 + 2 / 3) / 2)
    assert rows["weighted avg"][2] == pytest.approx(0.4 * 0.5 + 0.6 * 2 / 3)
    none = scored(spark, [(0, 0.1), (0, 0.2)])
    rows = {r["class"]: tuple(r)[1:] for r in evaluation.classification_report(none).collect()}
    assert rows["1"] == (0.0, 0.0, 0.0, 0)
    assert evaluation.metric_row(none).first()["roc_auc"] is None


def test_best_model_prefers_the_first_among_equals(spark):
    rows = [("a", 0, 0.7), ("b", 1, 0.8), ("c", 2, 0.8)]
    table = spark.createDataFrame(rows, "model string, train_order int, roc_auc double")
    assert evaluation.best_model(table).first()["model"] == "b"


@pytest.mark.parametrize("tiles", [3, 10])
def test_tiles_with_one_heavy_repeated_row(spark, tiles):
    rows = [(7, 1, 0.4, 0)] * 150 + [(i, i % 3 % 2, (i % 11) / 10, 0) for i in range(303)]
    df = spark.createDataFrame(rows, "customer_id bigint, label int, p double, prediction int")
    frame = df.toPandas().sort_values(["p", "customer_id", "label"], ascending=[False, True, True])
    sizes = [len(rows) // tiles + (t < len(rows) % tiles) for t in range(tiles)]
    frame["tile"] = np.repeat(np.arange(1, tiles + 1), sizes)
    expected = frame.groupby("tile")["label"].agg(["size", "sum"])
    got = evaluation.decile_lift(df, tiles).toPandas().sort_values("tile")
    assert got["customers"].tolist() == expected["size"].tolist()
    assert got["churners"].tolist() == expected["sum"].tolist()
    assert got["cumulative_capture"].iloc[-1] == 1.0
    top = evaluation.high_risk_band(df, (0.2,)).first()
    cut = int(len(rows) * 0.2 + 0.5)
    assert (top["customers"], top["churners"]) == (cut, frame["label"].head(cut).sum())
    assert top["lift"] == pytest.approx(frame["label"].head(cut).mean() / frame["label"].mean())


def test_fewer_rows_than_tiles(spark):
    got = evaluation.decile_lift(scored(spark, [(1, 0.9), (0, 0.1)])).toPandas()
    assert got["tile"].tolist() == [1, 2] and got["lift"].tolist() == [2.0, 0.0]


def test_impact_formulas_and_strict_threshold(spark):
    df = scored(spark, [(1, 0.9), (0, 0.8), (0, 0.7), (1, 0.2), (0, 0.71)])
    row = impact.retention_impact(df, 0.7, 0.5, 1200).first()
    assert row["customers_targeted"] == 3 and row["customers_saved"] == 1
    assert row["baseline_retention_rate"] == pytest.approx(0.6)
    assert row["new_retention_rate"] == pytest.approx(0.8)
    assert row["retention_improvement_pct"] == pytest.approx(100 / 3)
    assert row["annual_revenue_saved"] == 1200


def test_impact_edges(spark):
    all_churn = impact.retention_impact(scored(spark, [(1, 0.1), (1, 0.2)])).first()
    assert all_churn["retention_improvement_pct"] is None
    none_churn = impact.retention_impact(scored(spark, [(0, 0.9)] * 4)).first()
    assert none_churn["new_retention_rate"] == 1.5
    grid = impact.impact_scenarios(scored(spark, [(1, 0.9), (0, 0.65)]), (0.6, 0.7), (0.5, 1.0)).toPandas()
    assert isinstance(grid, pd.DataFrame) and len(grid) == 4
    best = grid[(grid["threshold"] == 0.6) & (grid["success_rate"] == 1.0)].iloc[0]
    assert (best["customers_targeted"], best["customers_saved"], best["churn_reduction"]) == (2, 2, 2.0)


def churn_rows(spark, rows):
    names = "customer_id bigint, contract_type string, tenure_months int, payment_method string, "
    return spark.createDataFrame(rows, names + "monthly_charges double, tech_support string, churn int")


def test_null_inputs_raise_no_risk_flag(spark):
    df = churn_rows(spark, [(1, None, None, None, None, None, 0), (2, "Month-to-month", 6, "Electronic check", 70.01, "No", 0)])
    got = {r["customer_id"]: r["risk_score"] for r in reports.risk_signals(df).collect()}
    assert got == {1: 0, 2: 5}


def test_quality_of_an_empty_and_a_one_class_table(spark):
    empty = churn_rows(spark, [])
    got = {r["metric"]: r["value"] for r in reports.data_quality(empty).collect()}
    assert got["Total Records"] == 0 and got["Missing Tenure"] is None and got["Churn Rate"] is None
    one = churn_rows(spark, [(1, "a", 1, "b", 1.0, "c", 0), (1, "a", 1, "b", 1.0, "c", 0), (None,) * 6 + (0,)])
    got = {r["metric"]: r["value"] for r in reports.data_quality(one).collect()}
    assert got["Duplicate Customer IDs"] == 2 and got["Class Imbalance Ratio"] is None
    assert got["Missing Customer IDs"] == 1


def test_campaigns_with_repeats_orphans_and_no_baseline(spark):
    campaigns = spark.sql("select 1 campaign_id, 'c' campaign_name, date'2024-01-01' campaign_start_date")
    targets = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (1, 99), (1, None), (2, 1)], "campaign_id int, customer_id bigint")
    customers = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1)], "customer_id bigint, churn int")
    churn = churn_rows(spark, [(1, "Month-to-month", 1, "b", 1.0, "c", 1), (2, "Month-to-month", 1, "b", 1.0, "c", 0)])
    from datetime import date

    row = reports.campaign_impact(campaigns, targets, customers, churn, date(2024, 3, 1)).collect()
    assert len(row) == 1
    assert (row[0]["customers_targeted"], row[0]["churned_after_campaign"]) == (3, 3)
    assert (row[0]["churn_rate_pct"], row[0]["retention_improvement_pct"]) == (50.0, 0.0)
    zero = churn.withColumn("churn", F.lit(0))
    assert reports.campaign_impact(campaigns, targets, customers, zero, date(2024, 3, 1)).first()[
        "retention_improvement_pct"
    ] is None
    assert reports.campaign_impact(campaigns, targets, customers, churn, date(2025, 1, 1)).count() == 0


def test_reports_default_to_today(spark):
    events = spark.sql("select current_date() churn_date, 1 tenure_months, 1D monthly_charges")
    assert reports.churn_trend(events).count() == 1


def test_histograms_merge_and_their_bounds_enclose_the_area(spark):
    rows = [(k % 3 == 0, ((k * 7919) % 1009) / 1000 + (0.1 if k % 3 == 0 else -0.05)) for k in range(900)]
    scored = spark.createDataFrame([(int(a), p) for a, p in rows] + [(1, None)], "label int, p double")
    known = scored.filter("p IS NOT NULL")
    exact = evaluation.roc_auc(known).first()[0]
    widths = []
    for bins in (4, 40, 400):
        whole = evaluation.score_histogram(scored, bins)
        assert whole.count() <= bins
        parts = [evaluation.score_histogram(scored.filter(f"{c} p < 0.4"), bins) for c in ("", "NOT")]
        merged = parts[0].unionByName(parts[1]).groupBy("bin").agg(
            F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives")
        )
        assert sorted(merged.collect()) == sorted(whole.collect())
        lower, upper = evaluation.auc_bounds(whole).first()
        assert lower <= exact <= upper
        widths.append(upper - lower)
        assert max(r["tpr"] for r in evaluation.binned_roc_curve(whole).collect()) == 1.0
    assert widths == sorted(widths)[::-1]
    one_class = evaluation.score_histogram(scored.filter("label = 1"))
    assert evaluation.auc_bounds(one_class).first()["lower"] is None


def test_areas_of_several_scores_are_those_of_the_evaluator(spark, monkeypatch):
    """One order of all scores, whatever their number; the edges as Spark's evaluator has them."""
    calls, totals = [], evaluation.running_totals
    monkeypatch.setattr(evaluation, "running_totals", lambda *a: calls.append(1) or totals(*a))
    both = spark.range(500).selectExpr(
        "cast(id % 7 < 2 as double) target",
        "array(pmod(hash(id), 1000) / 1000d, round(pmod(hash(id), 13) / 13d, 1), 0.5d, (id % 7) / 7d) scores",
    )
    for table in (both, both.filter("target = 1"), both.filter("target = 0"), both.filter("false")):
        single = [table.select("target", F.col("scores")[i].alias("score")) for i in range(4)]
        evaluator = BinaryClassificationEvaluator(labelCol="target", rawPredictionCol="score", numBins=0)
        assert evaluation.areas(table, 4) == pytest.approx([evaluator.evaluate(t) for t in single], abs=1e-12)
    assert len(calls) == 4
