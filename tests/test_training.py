import numpy as np
import pytest
from pyspark.sql import functions as F

import registry
from keepwell.operators import balance
from keepwell.plans import evaluation, grown_forest, nested_forest, training
from keepwell.plans.churn_run import run_churn_model
from keepwell.sources import runs, tables
from keepwell.sources.star_binding import StarBinding

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def engineered(spark):
    return registry._engineered(StarBinding(spark, DATA))


@pytest.fixture(scope="module")
def run(spark, engineered, tmp_path_factory):
    log = str(tmp_path_factory.mktemp("runs") / "log")
    grids = [
        training.logistic_grid((1.0,), ("l1", "l2"), ("balanced",)),
        training.forest_grid((10,), (5,), (1,), (None,)),
    ]
    return training.train_select(engineered, grids, folds=3, run_log=log), log


def test_grid_sizes():
    assert len(training.logistic_grid()) == 16
    assert len(training.forest_grid()) == 24


def test_penalty_and_depth_mapping(spark):
    candidate = training.logistic_grid((0.1,), ("l1",), ("balanced",))[0]
    estimator = candidate.estimator(500, 42)
    assert estimator.getRegParam() == pytest.approx(1 / 50)
    assert estimator.getElasticNetParam() == 1.0 and not estimator.getStandardization()
    assert estimator.getWeightCol() == "weight" and estimator.getMaxIter() == 1000
    forest = training.forest_grid((7,), (None,), (2,), (None,))[0].estimator(500, 1)
    assert (forest.getMaxDepth(), forest.getNumTrees(), forest.getMinInstancesPerNode()) == (30, 7, 2)
    assert not forest.isSet(forest.weightCol)


def test_split_sizes_and_selection(run):
    result, _ = run
    sizes = {tuple(r)[:2]: r["count"] for r in result.split.groupBy("churn", "split").count().collect()}
    assert sizes == {(0, "train"): 768, (0, "test"): 192, (1, "train"): 152, (1, "test"): 38}
    areas = {r["model"]: r["roc_auc"] for r in result.comparison.collect()}
    assert set(areas) == {training.LOGISTIC, training.FOREST}
    assert areas[result.best_name] == max(areas.values())


def test_models_beat_the_rule(run, engineered):
    result, _ = run
    held_out = result.scored[result.best_name].select("customer_id")
    rule = evaluation.rule_scores(engineered).join(held_out, "customer_id")
    baseline = evaluation.roc_auc(rule).first()[0]
    best = evaluation.roc_auc(result.scored[result.best_name]).first()[0]
    assert best > baseline


def test_best_candidate_is_the_argmax(run, spark):
    result, _ = run
    for search in result.searches.values():
        table = search.table(spark).collect()
        assert len(table) == len(search.candidates)
        best = [r for r in table if r["is_best"]]
        assert len(best) == 1 and best[0]["cv_roc_auc"] == max(r["cv_roc_auc"] for r in table)


def test_driver_tables(run, spark):
    result, _ = run
    names = result.fitted.names
    importance = training.feature_importance(spark, result.searches[training.FOREST].model, names)
    values = [r["importance"] for r in importance.collect()]
    assert sum(values) == pytest.approx(1) and min(values) >= 0 and values == sorted(values)[::-1]
    weights = training.coefficients(spark, result.searches[training.LOGISTIC].model, names)
    sizes = [r["abs_coefficient"] for r in weights.collect()]
    assert sizes == sorted(sizes)[::-1] and len(sizes) == len(names)
    assert training.top_rows(weights).count() == 10
    assert training.top_rows(weights.limit(3), 15).count() == 3
    assert result.drivers().count() == len(names)


def test_saved_model_gives_identical_scores(run, spark, engineered, folder):
    result, _ = run
    runs.save_model(folder, result.pipeline, result.fitted)
    pipeline, fitted = runs.load_model(spark, folder)
    test_keys = result.scored[result.best_name].select("customer_id")
    rows = engineered.join(test_keys, "customer_id").drop("churn")
    again = training.score_customers(pipeline, fitted, rows).select("customer_id", "p", "prediction")
    known = result.scored[result.best_name].select("customer_id", "p", "prediction")
    assert sorted(again.collect()) == sorted(known.collect())


def test_run_log_is_appended(run, spark):
    result, log = run
    table = runs.read_runs(spark, log)
    keys = {r["key"] for r in table.collect()}
    assert {"experiment", "n_train", "n_test", "n_features", "churn_rate_train", "churn_rate_test",
            "cv_roc_auc", "accuracy", "roc_auc", "churn_recall", "best_model"} <= keys
    before = table.count()
    runs.log_run(spark, log, "other", [("impact", None, "saved", 3), ("x", "m", "text", None)])
    assert runs.read_runs(spark, log).count() == before + 2
    assert table.filter("key = 'best_model'").first()["value_string"] == result.best_name


def test_wrong_scope_is_refused(engineered):
    with pytest.raises(ValueError):
        training.train_select(engineered, fit_scope="some")


@pytest.mark.parametrize("mode", ["fold", "train", None])
def test_parts_are_filters_of_one_table(spark, engineered, mode):
    fitted = registry.features.fit_features(engineered)
    table = training.TrainingTable(fitted.transform(engineered), fitted.names)
    parts = training.make_folds(table, 3, mode)
    held = sum(p.held_out.count() for p in parts.folds)
    assert held == (1920 if mode == "train" else 1150)
    source = sorted(parts.table.inputFiles())
    for part in [*parts.folds, parts.whole]:
        assert sorted(part.training.inputFiles()) == source
        assert part.training.count() == part.weight
        assert part.training.agg(F.sum("weight")).first()[0] == pytest.approx(part.weight)
        sizes = {r["target"]: r["count"] for r in part.training.groupBy("target").count().collect()}
        assert (sizes[0.0] == sizes[1.0]) == (mode is not None)
        if part.held_out is not None:
            keys = part.training.join(part.held_out, "customer_id", "left_semi")
            assert keys.isEmpty() and sorted(part.held_out.inputFiles()) == source
    if mode == "fold":
        assert [p.weight for p in parts.folds] == [1280.0] * 3 and parts.whole.weight == 1920
        assert training.make_folds(table, 3, mode).digest == parts.digest != training.make_folds(table, 4, mode).digest


def _one_part(engineered):
    fitted = registry.features.fit_features(engineered)
    return training.make_folds(training.TrainingTable(fitted.transform(engineered), fitted.names), 2)


def test_nested_scores_are_the_models_own_and_near_real_fits(spark, engineered):
    fold = _one_part(engineered).folds[0]
    real = {}
    for trees, depth in ((60, 30), (60, 4), (25, 4), (25, 30)):
        candidate = training.forest_grid((trees,), (depth,), (2,), (None,))[0]
        real[trees, depth] = candidate.estimator(fold.weight, 7).fit(fold.training)
    nodes = nested_forest.node_table(spark, real[60, 30])
    found = nested_forest.nested_scores(fold.held_out, nodes, list(real))
    own = training.score(real[60, 30], fold.held_out).select("label", "p").toPandas()
    got = found.selectExpr("cast(target as int) label", "scores[0] p").toPandas()
    assert sorted(got.round(9).itertuples(index=False)) == sorted(own.round(9).itertuples(index=False))

    def area(frame):
        return evaluation.roc_auc(frame).first()[0]

    for i, (setting, model) in enumerate(real.items()):
        nested = found.selectExpr("cast(target as int) label", f"scores[{i}] p")
        assert area(nested) == pytest.approx(area(training.score(model, fold.held_out)), abs=0.04), setting


@pytest.mark.parametrize("group_rows", [30_000, 200])
def test_forest_grown_on_executors_is_near_real_fits(spark, engineered, folder, monkeypatch, group_rows):
    """More nodes than the driver may hold: no Spark forest is fitted, and scores, importance and storage work as with one."""
    fold = _one_part(engineered).folds[0]
    candidate = training.forest_grid((60,), (None,), (2,), ("balanced",))[0]
    cuts = [(60, 30), (60, 4), (25, 4), (25, 30)]
    real = [training.forest_grid((n,), (d,), (2,), (None,))[0].estimator(fold.weight, 7).fit(fold.training) for n, d in cuts]
    monkeypatch.setattr(training, "DRIVER_NODES", 0)
    monkeypatch.setattr(grown_forest, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(training.Candidate, "estimator", lambda *_: pytest.fail("fitted on the driver"))
    model = training.fit_candidate(fold, candidate)
    assert (len(model.top) == 60) == (group_rows == 30_000)
    found = model.scores(fold.held_out, cuts).selectExpr("cast(target as int) label", "scores")
    for i, other in enumerate(real):
        area = evaluation.roc_auc(found.selectExpr("label", f"scores[{i}] p")).first()[0]
        assert area == pytest.approx(evaluation.roc_auc(training.score(other, fold.held_out)).first()[0], abs=0.04), cuts[i]
    importance, known = model.featureImportances.toArray(), real[0].featureImportances.toArray()
    assert importance.sum() == pytest.approx(1) and abs(importance - known).max() < 0.06
    model.write().save(folder)
    again = sorted(training.score(grown_forest.GrownForest.load(folder), fold.held_out).collect())
    assert again == sorted(training.score(model, fold.held_out).collect()) and len(again) == fold.held_out.count()
    grid = training.forest_grid((5, 10), (3, None), (1,), ("balanced", None))
    assert len(training._fold_scores(grid, fold, 42)) == 8


def test_grown_parts_are_pruned_as_a_fit_prunes():
    bins = np.array([[0], [1], [2], [3]], np.uint8).repeat(10, 0)
    ones = np.array([0] * 10 + [0] * 7 + [1] * 3 + [0] * 2 + [1] * 8 + [1] * 10)
    values = grown_forest._values(ones, np.ones(40), [1.0, 1.0])
    for limit, leaves in ((1, 2), (30, 2)):
        nodes, first, importance = grown_forest.grow(bins, values, 0, limit, 1, np.random.default_rng(0))
        below = nodes[nodes["left"][0] : nodes["left"][0] + 2]
        assert below["share"].tolist() == [0.15, 0.9] and (below["uniform"] >= 30).all() and nodes["uniform"][0] == 0
        assert first.tolist() == [1, 0] and importance.tolist() == pytest.approx([14.9 + 16.4 - 20.05])


def test_cut_trees_are_pruned_as_a_fit_prunes(spark):
    nodes = nested_forest.NodeTable(
        np.array([0]), np.zeros(7, int), np.array([0.0, -1, 1, 0, 0, 0, 0]), np.array([1, 3, 5, -1, -1, -1, -1]),
        np.array([2, 4, 6, -1, -1, -1, -1]), np.array([0, 1, 1, 2, 2, 2, 2]),
        np.array([0.6, 0.9, 0.55, 1.0, 0.2, 0.8, 0.3]), np.array([1, 1, 1, 1, 0, 1, 0]),
    )
    rows = np.array([[-2.0], [-0.5], [0.5], [2.0]])
    assert nodes.scores(rows, [(1, 2), (1, 1), (1, 0)]).T.tolist() == [[1.0, 0.2, 0.8, 0.3], [0.6] * 4, [0.6] * 4]


def test_interrupted_search_goes_on_with_what_is_missing(spark, engineered, folder, monkeypatch):
    parts = _one_part(engineered)
    grid = training.forest_grid((3, 6), (2, None), (1, 2), ("balanced", None)) + training.logistic_grid((0.1, 1.0), ("l2",))
    whole = training.cross_validate(parts, grid, parallelism=1)
    journal = f"{folder}/journal"
    record, fits, fit = runs.SearchJournal.record, [], training._fold_scores

    def counted(group, fold, seed):
        fits.append(group)
        if len(fits) == 4:
            raise RuntimeError("killed")
        return fit(group, fold, seed)

    monkeypatch.setattr(training, "_fold_scores", counted)
    with pytest.raises(RuntimeError):
        training.cross_validate(parts, grid, parallelism=1, journal=journal)
    log = runs.SearchJournal(spark, journal, f"{parts.digest}-42")
    before = log.scores()
    assert 0 < len(before) < 2 * len(grid)
    fits += [None] * 4  # beyond the fault
    done = len(fits)
    assert training.cross_validate(parts, grid, parallelism=1, journal=journal) == pytest.approx(whole)
    assert len(fits) - done == 8 - 3  # per fold two forests and two logistic fits
    record(log, [("x", *key, score) for key, score in before.items()])  # again: counts once
    assert len(log.scores()) == 2 * len(grid)
    done = len(fits)
    training.cross_validate(parts, grid, parallelism=1, journal=journal)
    assert len(fits) == done
    assert runs.SearchJournal(spark, journal, "another").scores() == {}


def test_whole_run_from_a_file(spark, folder):
    churn = registry.churn_table(StarBinding(spark, DATA))
    tables.write_report(churn, f"{folder}/in", "csv")
    grid = [training.logistic_grid((1.0,), ("l2",), (None,))]
    result = run_churn_model(
        f"{folder}/in", f"{folder}/out", spark, tables.CHURN_SCHEMA, grid,
        threshold=0.2, folds=2, fit_scope="all", rebalance=None,
    )
    mean, sd = result.fitted.moments["senior_citizen"]
    rows = registry.unique_customers(StarBinding(spark, DATA))
    assert mean == pytest.approx(rows.agg(F.avg("senior_citizen")).first()[0])
    impact = spark.read.option("header", True).csv(f"{folder}/out/reports/business_impact").first()
    scored = result.scored[result.best_name]
    assert int(impact["customers_targeted"]) == scored.filter("p > 0.2").count()
    assert spark.read.option("header", True).csv(f"{folder}/out/reports/model_coefficients").count() == 25
    stages = {r["stage"] for r in runs.read_runs(spark, f"{folder}/out/runs").collect()}
    assert stages == {"setup", "data", "search", "test", "selection", "impact"}
    pipeline, fitted = runs.load_model(spark, f"{folder}/out/model")
    assert fitted.names == result.fitted.names and len(pipeline.stages) == 2


def test_whole_forest_grid_by_few_fits(spark, tmp_path, monkeypatch):
    """The registered search, to its end: all candidates, five folds, one fit per leaf size and fold."""
    fits, fit = [], training._fold_scores
    monkeypatch.setattr(training, "_fold_scores", lambda *job: fits.append(job[0]) or fit(*job))
    monkeypatch.setattr(registry, "_journal", lambda _: str(tmp_path / "journal"))
    rows = registry.queries()["forest_search"](spark, "/root/testdata/sf0.001").collect()
    assert len(fits) == 10 and sorted(map(len, fits)) == [12] * 10
    assert len({r["params"] for r in rows}) == 24 and sum(r["is_best"] for r in rows) == 1
    assert max(rows, key=lambda r: r["cv_roc_auc"])["cv_roc_auc"] == [r for r in rows if r["is_best"]][0]["cv_roc_auc"]
    again = registry.queries()["forest_search"](spark, "/root/testdata/sf0.001").collect()
    assert len(fits) == 10 and [r["cv_roc_auc"] for r in again] == [r["cv_roc_auc"] for r in rows]


def _unbalanced(spark, rows=400):
    numbers = spark.range(rows).withColumnRenamed("id", "customer_id")
    return training.TrainingTable(numbers.selectExpr(
        "customer_id", "cast(customer_id % 5 = 0 as int) churn", "cast(customer_id * 37 % 101 as double) a",
        "cast(customer_id * 53 % 97 + 20 * (customer_id % 5) as double) b",
    ), ["a", "b"])


def test_a_fit_reads_no_synthetic_rows_of_other_parts(spark):
    parts = training.make_folds(_unbalanced(spark), 2)
    for number, part in enumerate([*parts.folds, parts.whole]):
        files = part.training.select(F.input_file_name().alias("file")).distinct().collect()
        assert {row["file"].split("/part=")[1].split("/")[0] for row in files} == {"__HIVE_DEFAULT_PARTITION__", str(number)}
        plan = part.training._jdf.queryExecution().executedPlan().toString()
        assert "(part#" in plan.split("PartitionFilters: [")[1].split("]")[0]
        assert part.training.count() == part.weight
        if part.held_out is not None:
            files = part.held_out.select(F.input_file_name().alias("file")).distinct().collect()
            assert all("/part=__HIVE_DEFAULT_PARTITION__/" in row["file"] for row in files)
            assert part.held_out.count() == 200


def test_rows_of_a_fold_are_kept_from_its_first_fit_to_its_last(spark, monkeypatch):
    parts, kept, real = training.make_folds(_unbalanced(spark), 2), [], training._fold_scores

    def watched(group, fold, *options):
        kept.append((fold.training.is_cached, fold.held_out.is_cached, parts.table.is_cached))
        return real(group, fold, *options)

    monkeypatch.setattr(training, "_fold_scores", watched)
    scores = training.cross_validate(parts, training.logistic_grid((0.1, 1.0), ("l2",), (None,)))
    assert kept == [(True, True, False)] * 4 and all(0.5 < s <= 1 for s in scores)
    assert not any(t.is_cached for f in parts.folds for t in (f.training, f.held_out))


def test_copies_of_the_features_bound_the_fits_at_once(spark, monkeypatch):
    parts, grid = training.make_folds(_unbalanced(spark), 2), training.logistic_grid()
    assert parts.width == 2 and parts.folds[0].weight == 320
    most = min(training.FITS_AT_ONCE[training.LOGISTIC], spark.sparkContext.defaultParallelism)
    assert training._fits_at_once(parts, grid) == most
    monkeypatch.setattr(training, "CELLS_AT_ONCE", 2 * 320 * 2)
    assert training._fits_at_once(parts, grid) == min(2, most)
    monkeypatch.setattr(training, "CELLS_AT_ONCE", 10)
    assert training._fits_at_once(parts, grid) == 1


def test_a_logistic_fit_has_few_tasks_but_bounded_ones(spark, monkeypatch):
    table, cores = spark.range(100, numPartitions=64), spark.sparkContext.defaultParallelism
    assert training._few(table, 100, cores).rdd.getNumPartitions() == training.ONE_STAGE_PARTITIONS
    assert training._few(table, 100, 1).rdd.getNumPartitions() == max(training.ONE_STAGE_PARTITIONS, cores)
    monkeypatch.setattr(training, "MOST_ROWS_PER_TASK", 2)
    assert training._few(table, 100, cores).rdd.getNumPartitions() == 50


def test_splits_of_few_rows_are_those_of_whole_histograms(monkeypatch):
    rng = np.random.default_rng(3)
    bins = np.stack([rng.integers(0, k, 800) for k in (2, 3, 32, 32, 9, 1)], axis=1).astype(np.uint8)
    ones = (rng.random(800) < bins[:, 2] / 40).astype(int)
    values = grown_forest._values(ones, rng.integers(1, 5, 800), [1.0, 1.0])
    order = rng.permutation(800)
    for min_leaf in (1, 3):
        grown = []
        for few, at in ((0, slice(None)), (1e9, slice(None)), (grown_forest.FEW, order)):
            monkeypatch.setattr(grown_forest, "FEW", few)
            grown.append(grown_forest.grow(bins[at], values[at], 0, 30, min_leaf, np.random.default_rng(5)))
        for nodes, first, importance in grown[1:]:
            assert len(nodes) > 50 and (nodes == grown[0][0]).all()
            assert (first == grown[0][1]).all() and importance == pytest.approx(grown[0][2])


def test_parts_are_oversampled_and_binned_once(spark, monkeypatch):
    """One search of neighbours for all parts, and per fold one table of bins and one to score for all its forests."""
    written, write = [], training.materialise
    for module in (balance, grown_forest):
        monkeypatch.setattr(module, "materialise", lambda df, label, *a: written.append(label) or write(df, label, *a))
    parts = training.make_folds(_unbalanced(spark), 2)
    assert written == ["minority", "points"]
    written.clear()
    monkeypatch.setattr(training, "DRIVER_NODES", 0)
    monkeypatch.setattr(training, "areas", lambda scored, n: ordered.append(n) or evaluation.areas(scored, n))
    ordered = []
    grid = training.forest_grid((3, 6), (2, None), (1, 2))
    scores = training.cross_validate(parts, grid)
    assert sorted(written) == ["binned"] * 2 + ["to_score"] * 2 and ordered == [4] * 4
    again = [training._fold_scores(group, fold, 42) for fold in parts.folds for group in training._jobs(grid, fold.even)]
    assert sorted(scores) == pytest.approx(sorted(
        (a + b) / 2 for one, two in zip(again[:2], again[2:]) for a, b in zip(one, two)
    ))
