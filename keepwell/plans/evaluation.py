"""Evaluation tables over scored rows with (label, prediction, p)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.functions.columns import flag, ratio
from keepwell.operators.ordering import running_totals
from keepwell.plans.reports import RISK_SIGNALS, with_risk_signals
from keepwell.scratch import materialise

METRICS = ("accuracy", "roc_auc", "f1_score", "churn_precision", "churn_recall", "churn_f1")


def rule_scores(churn: DataFrame, threshold: float = 0.5, score: Column | None = None) -> DataFrame:
    """Score customers by a rule: the share of risk signals present, unless ``score`` is given."""
    p = F.col("risk_score") / F.lit(float(len(RISK_SIGNALS))) if score is None else score
    return with_risk_signals(churn).select(
        "customer_id", F.col("churn").alias("label"), p.cast("double").alias("p")
    ).withColumn("prediction", flag(F.col("p") > threshold))


def _cell_counts() -> dict[tuple[int, int], Column]:
    return {
        (actual, predicted): F.count(
            F.when((F.col("label") == actual) & (F.col("prediction") == predicted), 1)
        )
        for actual in (0, 1)
        for predicted in (0, 1)
    }


def _cells(scored: DataFrame) -> DataFrame:
    """One row with the four counts n00, n01, n10, n11 (actual, predicted)."""
    return scored.agg(*[c.alias(f"n{a}{p}") for (a, p), c in _cell_counts().items()])


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """All four label and prediction cells, empty ones included."""
    cells = [
        F.struct(F.lit(a).alias("label"), F.lit(p).alias("prediction"), F.col(f"n{a}{p}").alias("n"))
        for a, p in _cell_counts()
    ]
    return _cells(scored).select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def _or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def _class_scores(actual: int) -> tuple[Column, Column, Column, Column]:
    """Precision, recall, F1 and support of one class from the four counts."""
    other = 1 - actual
    hit, false_alarm, miss = (F.col(f"n{a}{p}") for a, p in ((actual, actual), (other, actual), (actual, other)))
    return (
        _or_zero(hit, hit + false_alarm),
        _or_zero(hit, hit + miss),
        _or_zero(2 * hit, 2 * hit + false_alarm + miss),
        hit + miss,
    )


def classification_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and the two averages."""
    per_class = {c: _class_scores(c) for c in (0, 1)}
    total = sum((per_class[c][3] for c in (0, 1)), F.lit(0)).cast("long")
    accuracy = _or_zero(F.col("n00") + F.col("n11"), total)

    def row(name: str, scores: Sequence[Column], support: Column) -> Column:
        labels = ("precision", "recall", "f1_score")
        return F.struct(
            F.lit(name).alias("class"),
            *[s.alias(n) for n, s in zip(labels, scores)],
            support.cast("long").alias("support"),
        )

    macro = [(per_class[0][i] + per_class[1][i]) / 2 for i in range(3)]
    weighted = [
        _or_zero(per_class[0][i] * per_class[0][3] + per_class[1][i] * per_class[1][3], total)
        for i in range(3)
    ]
    rows = [
        row("0", per_class[0][:3], per_class[0][3]),
        row("1", per_class[1][:3], per_class[1][3]),
        row("accuracy", [accuracy] * 3, total),
        row("macro avg", macro, total),
        row("weighted avg", weighted, total),
    ]
    return _cells(scored).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _score_steps(scored: DataFrame) -> DataFrame:
    """Positives and negatives per distinct score."""
    return scored.groupBy("p").agg(
        F.sum(flag(F.col("label") == 1)).alias("positives"),
        F.sum(flag(F.col("label") == 0)).alias("negatives"),
    )


def roc_auc(scored: DataFrame) -> DataFrame:
    """One row: probability that a positive outranks a negative, ties counting one half.

    NULL when a class is missing.
    """
    steps = running_totals(_score_steps(scored), [F.col("p")], {"upto": F.col("negatives")})
    positives, negatives = (F.col(c).cast("double") for c in ("positives", "negatives"))
    outranked = F.sum(positives * (F.col("upto") - negatives / 2))
    return steps.agg(ratio(outranked, F.sum(positives) * F.sum(negatives)).alias("roc_auc"))


def areas(scored: DataFrame, n: int) -> list[float]:
    """ROC-AUC of each of ``n`` scores, from one order of all: rows have ``target`` and the array ``scores``.

    As the curves of Spark's evaluator have it, the area is 0 without positives, 1 without negatives and a half without rows.
    """
    each = scored.select("target", F.posexplode("scores").alias("place", "p"))
    steps = each.groupBy("place", "p").agg(
        F.sum(flag(F.col("target") == 1)).alias("positives"), F.sum(flag(F.col("target") == 0)).alias("negatives")
    )
    placed = running_totals(steps, [F.col("place"), F.col("p")], {"upto": F.col("negatives")})
    positives, negatives = (F.col(c).cast("double") for c in ("positives", "negatives"))
    totals = placed.groupBy("place").agg(
        F.sum(positives * (F.col("upto") - negatives / 2)).alias("outranked"),
        F.sum(positives).alias("positives"), F.sum(negatives).alias("negatives"),
    )
    found = {row["place"]: row for row in totals.collect()}
    if not found:
        return [0.5] * n
    result, earlier = [], 0.0
    for place in range(n):
        outranked, ones, zeros = found[place][1:]
        area = (outranked - ones * earlier) / (ones * zeros) if ones and zeros else float(ones > 0)
        result.append(area)
        earlier += zeros
    return result


def _without_collinear(steps: DataFrame) -> DataFrame:
    """Steps that differ from the step after them, and the first and the last; joined by their place."""
    after = steps.select(
        (F.col("place") - 1).alias("place"),
        F.col("positives").alias("next_positives"),
        F.col("negatives").alias("next_negatives"),
    )
    same = (F.col("positives") == F.col("next_positives")) & (F.col("negatives") == F.col("next_negatives"))
    keep = (F.col("place") == 1) | ~F.coalesce(same, F.lit(False))
    return steps.join(after, "place", "left").filter(keep)


def roc_curve(scored: DataFrame, all_points: bool = False) -> DataFrame:
    """Curve points per distinct score, highest first, after the origin (whose threshold is NULL).

    A point between two equal steps lies on the line through its neighbours and is left out unless
    ``all_points``; the points of the highest and the lowest score always stay. A rate is NULL when its
    class is missing.
    """
    steps = running_totals(
        _score_steps(scored),
        [F.desc("p")],
        {"true_positives": F.col("positives"), "false_positives": F.col("negatives"), "place": F.lit(1)},
    )
    if not all_points:
        steps = _without_collinear(materialise(steps, "steps"))
    totals = steps.agg(
        F.max("true_positives").alias("p"), F.max("false_positives").alias("n")
    ).first()
    points = steps.select(F.col("p").alias("threshold"), "false_positives", "true_positives")
    none = F.lit(0).cast("long")
    origin = scored.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        none.alias("false_positives"),
        none.alias("true_positives"),
    )
    return origin.unionByName(points).select(
        "threshold",
        ratio(F.col("false_positives"), F.lit(totals["n"])).alias("fpr"),
        ratio(F.col("true_positives"), F.lit(totals["p"])).alias("tpr"),
    )


def score_histogram(scored: DataFrame, bins: int = 1000, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """(bin, positives, negatives) over equal bins of the scores from ``low`` to ``high``, empty ones left out.

    Scores beyond the range count in the first and the last bin, NULL scores nowhere. Histograms of one range merge by
    adding their counts, so each task and each day can have its own; there are never more than ``bins`` rows.
    """
    place = F.floor((F.col("p") - low) / (high - low) * bins)
    number = F.greatest(F.least(place, F.lit(bins - 1)), F.lit(0)).cast("int")
    counted = scored.filter(F.col("p").isNotNull()).groupBy(number.alias("bin"))
    return counted.agg(
        F.sum(flag(F.col("label") == 1)).alias("positives"), F.sum(flag(F.col("label") == 0)).alias("negatives")
    )


def auc_bounds(histogram: DataFrame) -> DataFrame:
    """One row: ``lower`` and ``upper``, between which the exact ROC-AUC of the counted scores lies.

    Only pairs within a bin are unknown: all of them in the wrong order give the lower bound, in the right order the
    upper one. NULL when a class is missing. The window runs over the bins, whose number is bounded.
    """
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    positives, negatives = (F.col(c).cast("double") for c in ("positives", "negatives"))
    below = histogram.withColumn("below", F.coalesce(F.sum(negatives).over(before), F.lit(0.0)))
    pairs = F.sum(positives) * F.sum(negatives)
    return below.agg(
        ratio(F.sum(positives * F.col("below")), pairs).alias("lower"),
        ratio(F.sum(positives * (F.col("below") + negatives)), pairs).alias("upper"),
    )


def binned_roc_curve(histogram: DataFrame) -> DataFrame:
    """(bin, fpr, tpr) of the curve at the lower edge of each bin, exact there; at most one row per bin."""
    down = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    rates = {"fpr": "negatives", "tpr": "positives"}
    return histogram.select(
        "bin", *[ratio(F.sum(c).over(down), F.sum(c).over(whole)).alias(n) for n, c in rates.items()]
    )


def metric_row(scored: DataFrame) -> DataFrame:
    """One row with accuracy, ROC-AUC, F1 and the precision, recall and F1 of class 1."""
    precision, recall, f1, _ = _class_scores(1)
    total = sum((F.col(f"n{a}{p}") for a, p in _cell_counts()), F.lit(0))
    return _cells(scored).select(
        _or_zero(F.col("n00") + F.col("n11"), total).alias("accuracy"),
        roc_auc(scored).scalar().alias("roc_auc"),
        f1.alias("f1_score"),
        precision.alias("churn_precision"),
        recall.alias("churn_recall"),
        f1.alias("churn_f1"),
    )


def compare_models(scored_by_model: Mapping[str, DataFrame]) -> DataFrame:
    """Metric row per model in training order."""
    table = None
    for order, (model, scored) in enumerate(scored_by_model.items()):
        row = metric_row(scored).select(
            F.lit(model).alias("model"), F.lit(order).alias("train_order"), *METRICS
        )
        table = row if table is None else table.unionByName(row)
    return table


def best_model(comparison: DataFrame) -> DataFrame:
    """The model with the highest ROC-AUC; among equals the one trained first."""
    return comparison.orderBy(F.desc("roc_auc"), "train_order").limit(1)


def _placed_groups(scored: DataFrame) -> DataFrame:
    """Equal rows with their number and the last position they take in the score order."""
    groups = scored.groupBy("p", "customer_id", "label").agg(F.count("*").alias("rows"))
    order = [F.desc("p"), F.col("customer_id"), F.col("label")]
    return running_totals(groups, order, {"upto": F.col("rows")})


def decile_lift(scored: DataFrame, tiles: int = 10) -> DataFrame:
    """Churn by tile of the score order, tile 1 holding the highest scores.

    Tiles follow the NTILE rule: sizes differ by one at most and the larger ones come first. Equal
    scores are ordered by customer id, then label. Equal rows are counted first and a group that
    crosses a tile edge is divided between the tiles by count.
    """
    placed = _placed_groups(scored)
    total = placed.agg(F.max("upto")).first()[0] or 0
    size, larger = divmod(total, tiles)
    edges = [size * t + min(t, larger) for t in range(tiles + 1)]
    parts = [
        F.struct(
            F.lit(t + 1).alias("tile"),
            (
                F.least("upto", F.lit(edges[t + 1]))
                - F.greatest(F.col("upto") - F.col("rows"), F.lit(edges[t]))
            ).alias("n"),
        )
        for t in range(tiles)
    ]
    covered = F.filter(F.array(*parts), lambda part: part["n"] > 0)
    by_tile = (
        placed.select("label", F.explode(covered).alias("part"))
        .groupBy(F.col("part.tile").alias("tile"))
        .agg(
            F.sum("part.n").alias("customers"),
            F.sum(F.col("part.n") * F.col("label")).alias("churners"),
        )
    )
    return _with_lift(by_tile, "tile")


def _with_lift(bands: DataFrame, band: str) -> DataFrame:
    """Add rate, cumulative capture and lift to a table with a few rows per score order."""
    rows = bands.collect()
    customers = sum(r["customers"] for r in rows)
    churners = sum(r["churners"] for r in rows)
    average, captured, table = (churners / customers if customers else 0.0), 0, []
    for r in sorted(rows, key=lambda r: r[band]):
        captured += r["churners"]
        rate = r["churners"] / r["customers"]
        table.append(
            (
                r[band], r["customers"], r["churners"], rate,
                captured / churners if churners else None, rate / average if average else None,
            )
        )
    kind = bands.schema[band].dataType.simpleString()
    return bands.sparkSession.createDataFrame(
        table,
        f"{band} {kind}, customers bigint, churners bigint, churn_rate double, "
        "cumulative_capture double, lift double",
    )


def high_risk_band(scored: DataFrame, fractions: Sequence[float] = (0.15, 0.20)) -> DataFrame:
    """Churn rate of the top share of customers by score and its multiple of the average rate."""
    placed = _placed_groups(scored)
    sums = placed.agg(
        F.sum("rows").alias("n"), F.sum(F.col("rows") * F.col("label")).alias("churners")
    ).first()
    total = sums["n"] or 0
    average = sums["churners"] / total if total else 0.0
    before = F.col("upto") - F.col("rows")
    bands = []
    for fraction in fractions:
        size = int(total * fraction + 0.5)
        inside = F.greatest(F.least("upto", F.lit(size)) - before, F.lit(0))
        bands.append(
            F.struct(
                F.lit(float(fraction)).alias("fraction"),
                F.lit(size).cast("long").alias("customers"),
                F.sum(inside * F.col("label")).alias("churners"),
            )
        )
    rate = ratio(F.col("churners"), F.col("customers"))
    return (
        placed.agg(F.array(*bands).alias("bands"))
        .select(F.explode("bands").alias("band"))
        .select("band.*")
        .withColumn("churn_rate", rate)
        .withColumn("lift", ratio(F.col("churn_rate"), F.lit(average)))
    )
