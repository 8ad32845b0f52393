"""Distributed model search, selection and scoring with ``pyspark.ml``."""

from __future__ import annotations

import hashlib
import itertools
import math
import threading
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.operators.balance import class_counts, needs_rebalancing, smote, smote_parts, weight_column
from keepwell.operators.cleaning import class_values
from keepwell.operators.features import (
    FittedFeatures, fit_features, stratified_folds, stratified_split,
)
from keepwell.plans.evaluation import METRICS, areas, best_model, compare_models
from keepwell.plans.grown_forest import BinnedRows, GrownForest, bin_rows, fit_forest, numbered
from keepwell.plans.nested_forest import nested_scores, node_table
from keepwell.scratch import discard, materialise
from keepwell.sources.runs import SearchJournal, log_run, new_run_id

LOGISTIC, FOREST = "Logistic Regression", "Random Forest"
DEEPEST_TREE = 30
#: A fit's table gets a partition, and so each of its jobs a task, for so many rows.
ROWS_PER_TASK = 20_000
#: Up to so many partitions Spark adds the gradients of a logistic fit's iteration with one stage less.
ONE_STAGE_PARTITIONS = 5
#: A task of a logistic fit has no more rows, unless its table has fewer partitions.
MOST_ROWS_PER_TASK = 1_000_000
#: A forest that may have more nodes is grown and kept on the executors instead of the driver.
DRIVER_NODES = 20_000
#: Fits at once; a forest keeps the cluster busy by itself and its jobs take the driver's memory.
FITS_AT_ONCE = {LOGISTIC: 8, FOREST: 2}
#: Each logistic fit keeps a copy of its features (8 bytes a cell) on the executors; fits at once keep no more cells than this.
CELLS_AT_ONCE = 500_000_000
# Iteration limit and stopping tolerance of the logistic fits.
MAX_ITERATIONS = 1000
TOLERANCE = 1e-4


@dataclass(frozen=True)
class Candidate:
    """One grid point. ``class_weight`` is ``balanced`` or None."""

    family: str
    class_weight: str | None
    settings: tuple[tuple[str, object], ...]

    @property
    def params(self) -> dict[str, object]:
        return {**dict(self.settings), "class_weight": self.class_weight}

    @property
    def text(self) -> str:
        return ", ".join(f"{k}={v}" for k, v in self.params.items())

    def estimator(self, total_weight: float, seed: int):
        """The Spark estimator for a training table of the given total weight.

        ``C`` weighs the summed loss; Spark averages the loss, hence the division by the weight.
        """
        options = dict(self.settings)
        common = {"featuresCol": "features", "labelCol": "target"}
        if self.class_weight == "balanced":
            common["weightCol"] = "weight"
        if self.family == LOGISTIC:
            return LogisticRegression(
                maxIter=MAX_ITERATIONS,
                tol=TOLERANCE,
                regParam=1.0 / (options["C"] * total_weight),
                elasticNetParam=1.0 if options["penalty"] == "l1" else 0.0,
                standardization=False,
                family="binomial",
                **common,
            )
        return RandomForestClassifier(
            numTrees=options["n_estimators"],
            maxDepth=options["max_depth"] or DEEPEST_TREE,
            minInstancesPerNode=options["min_samples_leaf"],
            featureSubsetStrategy="sqrt",
            seed=seed,
            **common,
        )


def _grid(family: str, class_weight: Sequence, **axes: Sequence) -> list[Candidate]:
    points = itertools.product(*axes.values(), class_weight)
    return [Candidate(family, p[-1], tuple(zip(axes, p[:-1]))) for p in points]


def logistic_grid(
    C: Sequence[float] = (0.01, 0.1, 1.0, 10.0),
    penalty: Sequence[str] = ("l1", "l2"),
    class_weight: Sequence = ("balanced", None),
) -> list[Candidate]:
    return _grid(LOGISTIC, class_weight, C=C, penalty=penalty)


def forest_grid(
    n_estimators: Sequence[int] = (100, 200),
    max_depth: Sequence = (10, 20, None),
    min_samples_leaf: Sequence[int] = (1, 2),
    class_weight: Sequence = ("balanced", None),
) -> list[Candidate]:
    """Forest candidates. Spark has no minimum split size, so that axis does not exist."""
    return _grid(
        FOREST, class_weight, n_estimators=n_estimators, max_depth=max_depth,
        min_samples_leaf=min_samples_leaf,
    )


@dataclass
class TrainingTable:
    """Prepared rows (key, label, feature columns) and how to turn them into model input."""

    rows: DataFrame
    names: list[str]
    key: str = "customer_id"
    label: str = "churn"
    seed: int = 42

    def with_rows(self, rows: DataFrame) -> TrainingTable:
        return TrainingTable(rows, self.names, self.key, self.label, self.seed)

    def rebalanced(self) -> TrainingTable:
        """Oversample when the smallest class is below half of the largest."""
        if not needs_rebalancing(class_counts(self.rows, self.label)):
            return self
        grown = smote(self.rows, self.names, self.label, self.key, seed=self.seed)
        named = grown.withColumn(self.key, F.concat_ws("#", self.key, "copy_no"))
        return self.with_rows(materialise(named.drop("copy_no"), "balanced"))

    def model_input(self) -> tuple[DataFrame, int]:
        """Vector, target and balanced weight per row, and the total weight (equal to the rows)."""
        counts = class_counts(self.rows, self.label)
        assembler = VectorAssembler(inputCols=self.names, outputCol="features")
        table = assembler.transform(self.rows).select(
            self.key,
            F.col(self.label).cast("double").alias("target"),
            weight_column(counts, self.label).alias("weight"),
            "features",
        )
        return table, sum(counts.values())


def score(model: Model, table: DataFrame, key: str = "customer_id") -> DataFrame:
    """Key, label when known, predicted class and probability of class 1."""
    label = [F.col("target").cast("int").alias("label")] if "target" in table.columns else []
    return model.transform(table).select(
        key,
        *label,
        vector_to_array("probability")[1].alias("p"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def _sized(table: DataFrame, rows: float) -> DataFrame:
    """``table`` in no more partitions than its rows fill: each iteration of a fit is a job with a task per partition."""
    return table.coalesce(max(1, math.ceil(rows / ROWS_PER_TASK)))


class Shared:
    """Tables of a part that its forests share, each made when the first of them asks for it."""

    def __init__(self):
        self._lock, self._training, self._held_out = threading.Lock(), None, None

    def training(self, fold: Fold) -> BinnedRows:
        with self._lock:
            self._training = self._training or bin_rows(fold.training)
            return self._training

    def held_out(self, table: DataFrame) -> DataFrame:
        with self._lock:
            self._held_out = self._held_out or numbered(table)
            return self._held_out

    def discard(self) -> None:
        with self._lock:
            discard(*[t for t in (self._training and self._training.table, self._held_out) if t])
            self._training = self._held_out = None


@dataclass
class Fold:
    """Model input of one training part, its total weight, and the rows held out from it (none for the whole)."""

    training: DataFrame
    weight: float
    held_out: DataFrame | None
    even: bool = False  # all classes have one size, so balanced weights are 1
    fits: int = 1  # fits that run at once
    shared: Shared | None = None  # while several forests are fitted


@dataclass
class Parts:
    """Folds of a training table, and the whole of it for the refit, all filters of one written table.

    ``table`` has key, target, features, ``fold`` and ``weights``: per fold, and last for the whole, the row's balanced
    weight, 0 where the part does not have the row. Synthetic rows have no fold and a weight in the part
    that they were made from, ``part``, which names their folder, so that a fit does not read those of other parts.
    ``digest`` names the data and how they are cut, ``width`` is the number of features.
    """

    table: DataFrame
    folds: list[Fold]
    whole: Fold
    digest: str
    width: int = 1


def make_folds(table: TrainingTable, folds: int = 5, rebalance: str | None = "fold") -> Parts:
    """Stratified folds, made once and shared by every grid.

    ``rebalance="fold"`` oversamples the training part of each fold only. ``"train"`` oversamples
    before the folds are cut, so synthetic rows also fall into validation parts. None: never.
    """
    if rebalance == "train":
        table = table.rebalanced()
    folded = materialise(stratified_folds(table.rows, table.label, table.key, folds, table.seed), "folds")
    numbers = [*range(folds), folds]  # the last for the whole

    made = None
    if rebalance == "fold":
        class_values(folded, table.label)
        known = folded.filter(F.col(table.label).isNotNull() & F.col("fold").isNotNull())
        sizes = known.groupBy("fold", table.label).count().collect()
        counts = {i: Counter() for i in numbers}
        for row in sizes:
            for i in numbers:
                if row["fold"] != i:
                    counts[i][row[table.label]] += row["count"]
        short = {i: (F.col("fold") != i, n) for i, n in counts.items() if needs_rebalancing(n)}
        made = smote_parts(folded, table.names, short, table.label, table.key, seed=table.seed)
    doubles = [F.col(c).cast("double").alias(c) for c in table.names]
    own = folded.select(F.col(table.key).cast("string").alias(table.key), table.label, *doubles, "fold").withColumn("part", F.lit(None).cast("int"))
    if made is not None:
        named = made.withColumn(table.key, F.concat_ws("#", table.key, "copy_no")).drop("copy_no")
        own = own.unionByName(named.withColumn("fold", F.lit(None).cast("int")))
    labelled = own.filter(F.col(table.label).isNotNull())
    rows = materialise(VectorAssembler(inputCols=table.names, outputCol="features").transform(labelled).select(
        table.key, table.label, F.col(table.label).cast("double").alias("target"), "features", "fold", "part"
    ), "parts")

    def inside(number: int) -> Column:
        return F.coalesce((F.col("part") == number) | F.col("part").isNull() & (F.col("fold") != number), F.lit(False))

    counted = rows.groupBy(table.label).agg(*[F.count(F.when(inside(i), 1)).alias(f"n{i}") for i in numbers]).collect()
    counts = [{r[table.label]: r[f"n{i}"] for r in counted if r[f"n{i}"]} for i in numbers]
    weights = [F.when(inside(i), weight_column(c, table.label)).otherwise(0.0) if c else F.lit(0.0) for i, c in zip(numbers, counts)]
    weighed = rows.select(table.key, "target", "features", "fold", F.array(*weights).alias("weights"), "part")
    stored = materialise(weighed, "weighted", ["part"])
    own_rows = F.col("part").isNull()
    totals = [sum(c.values()) for c in counts]

    def training(number: int) -> DataFrame:
        part = stored.filter(own_rows | (F.col("part") == number)).filter(F.col("weights")[number] > 0)
        part = part.select(table.key, "target", F.col("weights")[number].alias("weight"), "features")
        return _sized(part, totals[number])

    cut = [
        Fold(
            training(i), totals[i], stored.filter(own_rows & (F.col("fold") == i)).select(table.key, "target", "features"),
            len(set(counts[i].values())) == 1,
        )
        for i in range(folds)
    ]
    content = folded.agg(F.count("*"), F.sum(F.xxhash64(*sorted(folded.columns)).cast("decimal(38,0)"))).first()
    told = (tuple(content), table.names, table.label, folds, table.seed, rebalance)
    digest = hashlib.md5(repr(told).encode()).hexdigest()
    return Parts(stored, cut, Fold(training(folds), totals[folds], None), digest, len(table.names))


def _jobs(candidates: Sequence[Candidate], even: bool) -> list[list[Candidate]]:
    """Candidates that one fit scores: forests that differ in size and depth only, and, where the classes are of
    one size, candidates that differ in the class weight only."""
    groups: dict[tuple, list[Candidate]] = {}
    free = {"n_estimators", "max_depth"} | ({"class_weight"} if even else set())
    for c in candidates:
        apart = free if c.family == FOREST else free - {"n_estimators", "max_depth"}
        groups.setdefault((c.family, *(v for k, v in c.params.items() if k not in apart)), []).append(c)
    return list(groups.values())


def _largest(group: Sequence[Candidate]) -> Candidate:
    """The forest that holds all of a group: as many trees and as deep as any."""
    options = [dict(c.settings) for c in group]
    trees, depth = max(o["n_estimators"] for o in options), max(o["max_depth"] or DEEPEST_TREE for o in options)
    settings = {**options[0], "n_estimators": trees, "max_depth": depth}
    return Candidate(FOREST, group[0].class_weight, tuple(settings.items()))


def _few(table: DataFrame, rows: float, fits: int) -> DataFrame:
    """``table`` for one of ``fits`` logistic fits at once: in partitions that keep the cluster busy between them."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.coalesce(max(ONE_STAGE_PARTITIONS, math.ceil(cores / fits), math.ceil(rows / MOST_ROWS_PER_TASK)))


def _fold_scores(group: Sequence[Candidate], fold: Fold, seed: int) -> list[float]:
    """ROC-AUC of a job's candidates on the held-out rows, from one fit, whose model is dropped afterwards."""
    evaluator = BinaryClassificationEvaluator(labelCol="target", metricName="areaUnderROC", numBins=0)
    held_out = _sized(fold.held_out, fold.weight)
    if group[0].family == LOGISTIC:
        model = group[0].estimator(fold.weight, seed).fit(_few(fold.training, fold.weight, fold.fits))
        scored = model.transform(_few(held_out, fold.weight, fold.fits)).select("target", "probability")
        return [evaluator.setRawPredictionCol("probability").evaluate(scored)] * len(group)
    model = fit_candidate(fold, _largest(group), seed)
    options = [dict(c.settings) for c in group]
    wanted = [(o["n_estimators"], o["max_depth"] or DEEPEST_TREE) for o in options]
    cuts = sorted(set(wanted))
    if isinstance(model, GrownForest):
        scored = model.scores(fold.shared.held_out(held_out) if fold.shared else held_out, cuts)
    else:
        scored = nested_scores(held_out, node_table(held_out.sparkSession, model), cuts)
    found = areas(scored.select("target", "scores"), len(cuts))
    return [found[cuts.index(c)] for c in wanted]


def _fits_at_once(parts: Parts, candidates: Sequence[Candidate]) -> int:
    """As many as the family allows, the cluster has cores, and, for logistic fits, their copies of the features leave room."""
    most = min(min(FITS_AT_ONCE[c.family] for c in candidates), parts.table.sparkSession.sparkContext.defaultParallelism)
    if any(c.family == LOGISTIC for c in candidates):
        cells = max(f.weight for f in parts.folds) * parts.width
        most = min(most, max(1, int(CELLS_AT_ONCE // max(1, cells))))
    return most


def cross_validate(
    parts: Parts, candidates: Sequence[Candidate], seed: int = 42, parallelism: int | None = None, journal: str | None = None
) -> list[float]:
    """Mean ROC-AUC of every candidate over the folds.

    Forests that differ only in size and depth share a fit per fold. With a ``journal``, the path of a run table, each
    score is recorded as it is known, and scores that are recorded already are not computed again. The rows of a fold
    are kept from its first fit to its last.
    """
    spark = parts.table.sparkSession
    parallelism = parallelism or _fits_at_once(parts, candidates)
    log = SearchJournal(spark, journal, f"{parts.digest}-{seed}") if journal else None
    known = log.scores() if log else {}
    jobs = [
        (group, number) for number, fold in enumerate(parts.folds) for group in _jobs(candidates, fold.even)
        if any((c.text, number) not in known for c in group)
    ]

    def run(job: tuple[list[Candidate], int]) -> tuple[int, dict]:
        group, number = job
        found = _fold_scores(group, replace(parts.folds[number], fits=parallelism, shared=shared[number]), seed)
        if log:
            log.record([(c.family, c.text, number, s) for c, s in zip(group, found)])
        return number, {(c.text, number): s for c, s in zip(group, found)}

    left = Counter(number for _, number in jobs)
    shared = {number: Shared() for number in left}
    kept = {number: (parts.folds[number].training.persist(), parts.folds[number].held_out.persist()) for number in left}
    try:
        with ThreadPool(parallelism) as pool:
            for number, found in pool.imap_unordered(inheritable_thread_target(spark)(run), jobs):
                known.update(found)
                left[number] -= 1
                if not left[number]:
                    for table in kept.pop(number):
                        table.unpersist()
                    shared[number].discard()
    finally:
        for tables in kept.values():
            for table in tables:
                table.unpersist()
    return [sum(known[c.text, f] for f in range(len(parts.folds))) / len(parts.folds) for c in candidates]


@dataclass
class Search:
    """Outcome of a grid search: every candidate's score and the refitted best one."""

    family: str
    candidates: list[Candidate]
    scores: list[float]
    model: Model | None = None

    @property
    def best(self) -> int:
        return max(range(len(self.scores)), key=lambda i: self.scores[i])

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (self.family, c.text, float(s), i == self.best)
            for i, (c, s) in enumerate(zip(self.candidates, self.scores))
        ]
        return spark.createDataFrame(
            rows, "model string, params string, cv_roc_auc double, is_best boolean"
        )


def grid_search(
    parts: Parts,
    candidates: Sequence[Candidate],
    seed: int = 42,
    parallelism: int | None = None,
    journal: str | None = None,
) -> Search:
    """Cross-validate the candidates and refit the best on the whole."""
    scores = cross_validate(parts, candidates, seed, parallelism, journal)
    search = Search(candidates[0].family, list(candidates), scores)
    search.model = fit_candidate(parts.whole, candidates[search.best], seed)
    return search


def _most_nodes(rows: float, candidate: Candidate) -> float:
    """Bound of a forest's nodes: no tree has more than the depth allows, or, as measured, than half of its rows."""
    options = dict(candidate.settings)
    return options["n_estimators"] * min(rows / 2, 2 ** ((options["max_depth"] or DEEPEST_TREE) + 1))


def fit_candidate(part: Fold, candidate: Candidate, seed: int = 42) -> Model:
    if candidate.family == FOREST and _most_nodes(part.weight, candidate) > DRIVER_NODES:
        options = dict(candidate.settings)
        return fit_forest(
            part.shared.training(part) if part.shared else part.training, options["n_estimators"], options["max_depth"] or DEEPEST_TREE, options["min_samples_leaf"],
            seed, candidate.class_weight == "balanced" and not part.even,
        )
    return candidate.estimator(part.weight, seed).fit(part.training)


def feature_importance(spark: SparkSession, model: Model, names: Sequence[str]) -> DataFrame:
    """Forest importance per feature, highest first."""
    values = [float(v) for v in model.featureImportances.toArray()]
    table = spark.createDataFrame(list(zip(names, values)), "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def coefficients(spark: SparkSession, model: Model, names: Sequence[str]) -> DataFrame:
    """Logistic coefficient per feature, largest magnitude first."""
    values = [float(v) for v in model.coefficients.toArray()]
    table = spark.createDataFrame(list(zip(names, values)), "feature string, coefficient double")
    return table.withColumn("abs_coefficient", F.abs("coefficient")).orderBy(
        F.desc("abs_coefficient"), "feature"
    )


def top_rows(ranked: DataFrame, n: int = 10) -> DataFrame:
    """The first rows of a ranked table: 10 for a report, 15 for a chart; fewer when it is shorter."""
    return ranked.limit(n)


@dataclass
class TrainingRun:
    """Everything a training run leaves behind."""

    run_id: str
    fitted: FittedFeatures
    searches: dict[str, Search]
    scored: dict[str, DataFrame]
    comparison: DataFrame
    best_name: str
    split: DataFrame
    log: list[tuple] = field(default_factory=list)

    @property
    def pipeline(self) -> PipelineModel:
        """Assembler and best model as one stage list that can be saved."""
        assembler = VectorAssembler(inputCols=self.fitted.names, outputCol="features")
        return PipelineModel(stages=[assembler, self.searches[self.best_name].model])

    def drivers(self) -> DataFrame:
        """Importance or coefficient table of the best model."""
        spark, model = self.split.sparkSession, self.searches[self.best_name].model
        report = feature_importance if self.best_name == FOREST else coefficients
        return report(spark, model, self.fitted.names)


def training_parts(
    df: DataFrame,
    key: str = "customer_id",
    label: str = "churn",
    test_fraction: float = 0.2,
    folds: int = 5,
    seed: int = 42,
    fit_scope: str = "train",
    rebalance: str | None = "fold",
) -> tuple[tuple[DataFrame, FittedFeatures, DataFrame], Parts]:
    """What a search works on: (split, fitted preparation, model input of the test part), and the folds."""
    if fit_scope not in ("train", "all"):
        raise ValueError("fit_scope is 'train' or 'all'")
    split = materialise(stratified_split(df, label, key, test_fraction, seed), "split")
    train_part = split.filter(F.col("split") == "train").drop("split")
    test_part = split.filter(F.col("split") == "test").drop("split")
    fitted = fit_features(train_part if fit_scope == "train" else df, key, label, labels_from=df)
    train = TrainingTable(
        materialise(fitted.transform(train_part), "train"), fitted.names, key, label, seed
    )
    test, _ = train.with_rows(materialise(fitted.transform(test_part), "test")).model_input()
    return (split, fitted, test), make_folds(train, folds, rebalance)


def train_select(
    df: DataFrame,
    grids: Sequence[Sequence[Candidate]] | None = None,
    key: str = "customer_id",
    label: str = "churn",
    test_fraction: float = 0.2,
    folds: int = 5,
    seed: int = 42,
    fit_scope: str = "train",
    rebalance: str | None = "fold",
    parallelism: int | None = None,
    run_log: str | None = None,
    experiment: str = "Churn_Prediction",
    journal: str | None = None,
) -> TrainingRun:
    """Split, prepare, search every grid, evaluate on the test part and pick the best model.

    ``df`` is cleaned and engineered. Label codes come from every row, so a category may be absent from
    the training part; ``fit_scope="train"`` learns moments on that part only, ``"all"`` on every row.
    ``journal`` is the path of a run table from which an interrupted search of the same data goes on.
    """
    grids = grids or [logistic_grid(), forest_grid()]
    prepared, parts = training_parts(df, key, label, test_fraction, folds, seed, fit_scope, rebalance)
    split, fitted, test = prepared
    searches, scored = {}, {}
    for candidates in grids:
        search = grid_search(parts, candidates, seed, parallelism, journal)
        searches[search.family] = search
        scored[search.family] = materialise(score(search.model, test, key), "scored")
    comparison = materialise(compare_models(scored), "comparison")
    best_name = best_model(comparison).first()["model"]
    run = TrainingRun(new_run_id(), fitted, searches, scored, comparison, best_name, split)
    run.log = _run_entries(run, experiment, label)
    if run_log:
        log_run(df.sparkSession, run_log, run.run_id, run.log)
    return run


def _run_entries(run: TrainingRun, experiment: str, label: str) -> list[tuple]:
    """Data-set facts, search results, test metrics and the chosen model of a run."""
    parts = run.split.groupBy("split").agg(
        F.count("*").alias("n"), F.avg(label).alias("rate")
    ).collect()
    entries = [("setup", None, "experiment", experiment)]
    entries += [("data", None, "n_features", len(run.fitted.names))]
    for row in parts:
        entries += [
            ("data", None, f"n_{row['split']}", row["n"]),
            ("data", None, f"churn_rate_{row['split']}", row["rate"]),
        ]
    for family, search in run.searches.items():
        best = search.candidates[search.best]
        entries += [("search", family, k, v) for k, v in best.params.items()]
        entries.append(("search", family, "cv_roc_auc", search.scores[search.best]))
    for row in run.comparison.collect():
        entries += [("test", row["model"], metric, row[metric]) for metric in METRICS]
    entries.append(("selection", run.best_name, "best_model", run.best_name))
    return entries


def score_customers(pipeline: PipelineModel, fitted: FittedFeatures, df: DataFrame) -> DataFrame:
    """Score new rows with a saved model; the label is not needed. Stays on the executors."""
    prepared = fitted.transform(df.drop(fitted.label))
    return score(pipeline, prepared, fitted.key)
