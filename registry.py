"""All registered queries: each takes a session and a test-data folder and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwell.functions import columns
from keepwell.operators import balance, bitmaps, cleaning, features, neighbours
from keepwell.plans import evaluation, extract, impact, reports, training
from keepwell.scratch import materialise, scratch_path, shared_path
from keepwell.sources import layout, runs
from keepwell.sources import star_binding as star
from keepwell.sources.star_binding import StarBinding
from keepwell.sources.tables import (
    CHURN_SCHEMA, load_csv, numeric_columns, register_views, string_columns, table_shape, write_report,
)

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round the double columns, whose last digits depend on the order of summation."""
    return df.select(
        *[
            columns.half_up(F.col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def churn_table(bound: StarBinding, **options) -> DataFrame:
    return extract.churn_dataset(
        bound.customers(), bound.services(), bound.billing(), bound.churn_events(), star.SIGNUP_FROM, **options
    )


def _bound(build: Callable[[StarBinding], DataFrame]) -> Query:
    return lambda spark, folder: build(StarBinding(spark, folder))


def _base_tables() -> dict[str, Query]:
    return {
        "table_customers": _bound(lambda b: b.customers()),
        "table_services": _bound(lambda b: b.services()),
        "table_billing": _bound(lambda b: b.billing()),
        "table_churn_events": _bound(lambda b: b.churn_events()),
        "table_customer_activity": _bound(lambda b: b.customer_activity()),
        "table_retention_campaigns": _bound(lambda b: b.retention_campaigns()),
        "table_retention_targets": _bound(lambda b: b.retention_targets()),
    }


def stored_by_customer(bound: StarBinding, **options) -> layout.KeyedStore:
    """The four tables of the extraction in buckets of the customer, as many as there are shuffle partitions."""
    tables = {
        "customers": bound.customers(), "services": bound.services(), "billing": bound.billing(),
        "churn_events": bound.churn_events(),
    }
    buckets = int(bound.spark.conf.get("spark.sql.shuffle.partitions"))
    return layout.store_by_key(tables, "customer_id", buckets, **options)


def _stored_activity(bound: StarBinding, days: int) -> DataFrame:
    """Activity from folders per month, of which only those of the window are read, with days in bitmaps."""
    activity = bound.customer_activity()
    path = layout.write_by_month(activity, "activity_date")
    recent = layout.read_window(bound.spark, path, activity, "activity_date", star.ACTIVITY_AS_OF, days)
    return extract.activity_metrics_by_bitmaps(recent, star.ACTIVITY_AS_OF, days)


def _login_days(bound: StarBinding) -> DataFrame:
    """Login days per customer and in two windows, from bitmaps of three parts that are stored and merged."""
    activity, keys = bound.customer_activity(), ["customer_id"]
    parts = [
        bitmaps.day_bitmaps(activity.filter(F.col("login_date").between(*ends)), keys, "login_date")
        for ends in star.LOGIN_PARTS
    ]
    stored = materialise(bitmaps.merge_bitmaps(parts, keys), "bitmaps")
    found = bitmaps.distinct_days(stored, keys).withColumnRenamed("n_days", "all_days")
    for name, days in (("days_20", star.ACTIVITY_DAYS), ("days_90", star.DEFAULT_ACTIVITY_DAYS)):
        start = F.date_sub(F.lit(star.ACTIVITY_AS_OF), days)
        window = bitmaps.distinct_days(stored, keys, start, star.ACTIVITY_AS_OF).withColumnRenamed("n_days", name)
        found = found.join(window, keys, "left").fillna(0, [name])
    return found


def _reports() -> dict[str, Query]:
    return {
        "churn_dataset": _bound(churn_table),
        "activity_metrics": _bound(
            lambda b: rounded(
                extract.activity_metrics(
                    b.customer_activity(), star.ACTIVITY_AS_OF, star.ACTIVITY_DAYS
                )
            )
        ),
        "customer_behavior": _bound(
            lambda b: rounded(
                extract.customer_behavior(
                    b.customers(), b.customer_activity(), star.ACTIVITY_AS_OF, star.ACTIVITY_DAYS
                )
            )
        ),
        "activity_metrics_90": _bound(
            lambda b: rounded(
                extract.activity_metrics(
                    b.customer_activity(), star.ACTIVITY_AS_OF, star.DEFAULT_ACTIVITY_DAYS
                )
            )
        ),
        "customer_behavior_90": _bound(
            lambda b: rounded(
                extract.customer_behavior(
                    b.customers(), b.customer_activity(), star.ACTIVITY_AS_OF, star.DEFAULT_ACTIVITY_DAYS
                )
            )
        ),
        "activity_metrics_stored": _bound(lambda b: rounded(_stored_activity(b, star.ACTIVITY_DAYS))),
        "activity_metrics_stored_90": _bound(lambda b: rounded(_stored_activity(b, star.DEFAULT_ACTIVITY_DAYS))),
        "churn_dataset_stored": _bound(
            lambda b: extract.stored_churn_dataset(stored_by_customer(b), signup_from=star.SIGNUP_FROM)
        ),
        "login_days": _bound(_login_days),
        "cohort_churn": _bound(lambda b: rounded(reports.cohort_churn(churn_table(b)))),
        "churn_trend": _bound(
            lambda b: rounded(reports.churn_trend(b.churn_events(), star.AS_OF, star.TREND_MONTHS))
        ),
        "risk_signals": _bound(lambda b: reports.risk_signals(churn_table(b))),
        "high_risk_customers": _bound(
            lambda b: reports.high_risk_customers(b.customers(), churn_table(b))
        ),
        "campaign_impact": _bound(
            lambda b: rounded(
                reports.campaign_impact(
                    b.retention_campaigns(), b.retention_targets(), b.customers(), churn_table(b),
                    star.AS_OF, star.CAMPAIGN_MONTHS,
                )
            )
        ),
        "data_quality": _bound(lambda b: reports.data_quality(churn_table(b))),
    }


def unique_customers(bound: StarBinding) -> DataFrame:
    return cleaning.drop_duplicate_keys(churn_table(bound))


def prepared(bound: StarBinding) -> tuple[features.FittedFeatures, DataFrame]:
    """Cleaned and engineered churn table with a preparation fitted on all of it."""
    return features.fit_while_writing(features.engineer(cleaning.clean(churn_table(bound))))


def _stored_churn(bound: StarBinding) -> DataFrame:
    return materialise(churn_table(bound), "churn")


def _medians(bound: StarBinding) -> DataFrame:
    churn = _stored_churn(bound)
    return cleaning.medians(
        churn, [c for c in numeric_columns(churn) if c not in ("customer_id", "churn")]
    )


def _medians_narrowed(bound: StarBinding) -> DataFrame:
    """The medians, with brackets narrowed until no more than 50 values are left."""
    churn = _stored_churn(bound)
    columns_ = [c for c in numeric_columns(churn) if c not in ("customer_id", "churn")]
    return cleaning.medians(churn, columns_, exact_rows=50)


def _modes(bound: StarBinding) -> DataFrame:
    unique = unique_customers(bound)
    return cleaning.modes(unique, string_columns(unique))


def _cleaning() -> dict[str, Query]:
    return {
        "dedupe": _bound(unique_customers),
        "duplicate_report": _bound(lambda b: cleaning.duplicate_report(churn_table(b))),
        "table_shape": _bound(lambda b: table_shape(churn_table(b))),
        "null_counts": _bound(lambda b: cleaning.null_counts(churn_table(b))),
        "medians": _bound(lambda b: rounded(_medians(b))),
        "modes": _bound(_modes),
        "clean": _bound(lambda b: rounded(cleaning.clean(churn_table(b)))),
        "class_distribution": _bound(lambda b: cleaning.class_distribution(churn_table(b))),
        "imbalance_ratio": _bound(lambda b: rounded(cleaning.imbalance_ratio(churn_table(b)))),
        "tenure_by_churn": _bound(lambda b: rounded(cleaning.median_by_class(_stored_churn(b)))),
        "class_weights": _bound(lambda b: rounded(balance.class_weights(_stored_churn(b)))),
    }


def _split(bound: StarBinding) -> DataFrame:
    unique = materialise(unique_customers(bound).select("customer_id", "churn"), "unique")
    return features.stratified_split(unique)


def _folds(bound: StarBinding) -> DataFrame:
    unique = materialise(unique_customers(bound).select("customer_id", "churn"), "unique")
    return features.stratified_folds(unique, "churn", "customer_id", 5)


def _moments(bound: StarBinding) -> DataFrame:
    fitted, table = prepared(bound)
    return features.feature_moments(fitted.encode(table), fitted.names)


def _prepare(bound: StarBinding) -> DataFrame:
    fitted, table = prepared(bound)
    return fitted.transform(table)


def _prepare_with_extra_text(bound: StarBinding) -> DataFrame:
    """Rows with a text column that was not there in fitting, which the preparation drops."""
    fitted, table = prepared(bound)
    return fitted.transform(table.withColumn("remark", F.concat(F.lit("new "), "customer_id")))


def _rebalancing_gate(bound: StarBinding) -> DataFrame:
    """Class sizes per contract, and whether training on its customers would oversample."""
    churn = churn_table(bound)
    sizes: dict[str | None, dict] = {}
    for row in churn.filter("churn IS NOT NULL").groupBy("contract_type", "churn").count().collect():
        sizes.setdefault(row["contract_type"], {})[row["churn"]] = row["count"]
    rows = [(c, min(n.values()), max(n.values()), balance.needs_rebalancing(n)) for c, n in sizes.items()]
    return churn.sparkSession.createDataFrame(rows, "contract_type string, smallest long, largest long, needed boolean")


def _label_codes(bound: StarBinding) -> DataFrame:
    table = features.engineer(cleaning.clean(churn_table(bound)))
    return features.fit_labels(table, string_columns(table))


def _smote(bound: StarBinding, **options) -> DataFrame:
    cleaned = materialise(cleaning.clean(churn_table(bound)), "cleaned")
    return balance.smote(cleaned, ["tenure_months", "monthly_charges"], **options)


def _smote_prepared(bound: StarBinding) -> DataFrame:
    """Oversampling on every feature of the prepared table, as before training."""
    fitted, table = prepared(bound)
    return balance.smote(materialise(fitted.transform(table), "prepared"), fitted.names)


def _projected_recall(bound: StarBinding) -> DataFrame:
    """Recall of the search by random projections among the churned customers, on all prepared features."""
    fitted, table = prepared(bound)
    rows = fitted.transform(table).filter("churn = 1")
    vector = F.array(*[F.col(c).cast("double") for c in fitted.names])
    points = balance.distinct_points(rows.select("customer_id", vector.alias("vector")), "customer_id")
    points = materialise(points, "points")
    found = neighbours.projected_neighbours(points, 5, bucket_rows=128)
    return neighbours.recall(materialise(found, "found"), points, 5)


def _labels_in_slices(bound: StarBinding) -> DataFrame:
    table = features.engineer(cleaning.clean(churn_table(bound)))
    return features.fit_labels(table, string_columns(table), windowed_labels=0)


def _features() -> dict[str, Query]:
    return {
        "engineer": _bound(lambda b: features.engineer(cleaning.clean(churn_table(b)))),
        "label_codes": _bound(_label_codes),
        "feature_moments": _bound(lambda b: rounded(_moments(b))),
        "prepare": _bound(lambda b: rounded(_prepare(b))),
        "stratified_split": _bound(_split),
        "split_profile": _bound(lambda b: rounded(cleaning.label_profile(_split(b), "split"))),
        "stratified_folds": _bound(_folds),
        "prepare_with_extra_text": _bound(lambda b: rounded(_prepare_with_extra_text(b))),
        "rebalancing_gate": _bound(_rebalancing_gate),
        "smote": _bound(lambda b: rounded(_smote(b))),
        "smote_prepared": _bound(lambda b: rounded(_smote_prepared(b))),
        # The paths of large tables, by way of small parameters.
        "projected_recall": _bound(_projected_recall),
        "smote_boxed": _bound(lambda b: rounded(_smote(b, box_rows=32))),
        "label_codes_sliced": _bound(_labels_in_slices),
        "medians_narrowed": _bound(lambda b: rounded(_medians_narrowed(b))),
        "churn_dataset_salted": _bound(lambda b: churn_table(b, hot_key_rows=1)),
    }


def scored_customers(bound: StarBinding) -> DataFrame:
    return materialise(evaluation.rule_scores(churn_table(bound), star.SCORE_THRESHOLD), "scored")


def _rule_models(bound: StarBinding) -> dict[str, DataFrame]:
    """Three deterministic scores, standing in for trained models."""
    churn = _stored_churn(bound)
    tenure = F.lit(1.0) / (F.col("tenure_months") + 1)
    contract = F.col("month_to_month_risk").cast("double")
    return {
        "risk_score": evaluation.rule_scores(churn, star.SCORE_THRESHOLD),
        "contract": evaluation.rule_scores(churn, 0.5, contract),
        "tenure": evaluation.rule_scores(churn, 0.05, tenure),
    }


def _comparison(bound: StarBinding) -> DataFrame:
    return rounded(evaluation.compare_models(_rule_models(bound)))


def _scored(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _bound(lambda b: rounded(build(scored_customers(b))))


def _fine_curve(bound: StarBinding) -> DataFrame:
    """Curve of a score with a value of its own for nearly every customer, with many points on one line."""
    score = F.coalesce(F.col("total_charges"), F.lit(0.0)) + F.col("customer_id") / 1e6
    return rounded(evaluation.roc_curve(evaluation.rule_scores(churn_table(bound), 0.5, score)), 5)


def _fine_scores(bound: StarBinding) -> DataFrame:
    """A score between 0 and 1 with a value of its own for nearly every customer."""
    charges = F.coalesce(F.col("total_charges"), F.lit(0.0)) + F.col("customer_id") / 1e6
    return evaluation.rule_scores(churn_table(bound), 0.5, 1000 / (charges + 1000))


def _auc_bounds(bound: StarBinding) -> DataFrame:
    """Bounds of the ROC-AUC from 50 and from 1000 bins, beside the exact value."""
    scored = materialise(_fine_scores(bound), "scored")
    exact = evaluation.roc_auc(scored).scalar()
    found = [evaluation.auc_bounds(evaluation.score_histogram(scored, n)).withColumn("bins", F.lit(n)) for n in (50, 1000)]
    both = found[0].unionByName(found[1]).withColumn("exact", exact)
    return rounded(both.withColumn("encloses", (F.col("lower") <= F.col("exact")) & (F.col("exact") <= F.col("upper"))))


def _evaluation() -> dict[str, Query]:
    return {
        "rule_scores": _bound(
            lambda b: evaluation.rule_scores(churn_table(b), star.SCORE_THRESHOLD)
        ),
        "confusion_matrix": _scored(evaluation.confusion_matrix),
        "classification_report": _scored(evaluation.classification_report),
        "roc_auc": _scored(evaluation.roc_auc),
        "roc_curve": _scored(evaluation.roc_curve),
        "roc_curve_all": _scored(lambda s: evaluation.roc_curve(s, all_points=True)),
        "roc_curve_fine": _bound(_fine_curve),
        "auc_bounds": _bound(_auc_bounds),
        "binned_roc_curve": _bound(
            lambda b: rounded(evaluation.binned_roc_curve(evaluation.score_histogram(_fine_scores(b), 50)))
        ),
        "metric_summary": _scored(evaluation.metric_row),
        "model_comparison": _bound(_comparison),
        "best_model": _bound(lambda b: evaluation.best_model(_comparison(b))),
        "decile_lift": _scored(evaluation.decile_lift),
        "high_risk_band": _scored(evaluation.high_risk_band),
        "retention_impact": _scored(lambda s: impact.retention_impact(s, star.SCORE_THRESHOLD)),
        "impact_scenarios": _scored(lambda s: impact.impact_scenarios(s, (0.3, 0.5, 0.7))),
    }


def _engineered(bound: StarBinding) -> DataFrame:
    return materialise(features.engineer(cleaning.clean(churn_table(bound))), "engineered")


# Candidates of the queries that fit a single model; the searches take the full grids.
SHORT_LOGISTIC = training.logistic_grid((0.1, 1.0), ("l2",), (None,))
SHORT_FOREST = training.forest_grid((20,), (5,), (1, 2), ("balanced",))


def _training_table(bound: StarBinding) -> training.TrainingTable:
    fitted, table = prepared(bound)
    return training.TrainingTable(materialise(fitted.transform(table), "train"), fitted.names)


def _journal(spark: SparkSession) -> str:
    """One run table for all searches: equal data and settings share their scores, an interrupted search goes on."""
    return shared_path(spark, "search-journal")


def _search_parts(bound: StarBinding) -> training.Parts:
    """Folds and whole of the training part, as ``train_select`` makes them."""
    return training.training_parts(_engineered(bound))[1]


def _search(candidates: list[training.Candidate]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        parts = _search_parts(StarBinding(spark, folder))
        return training.grid_search(parts, candidates, journal=_journal(spark)).table(spark)

    return run


def _drivers(candidate: training.Candidate, report: Callable, top: int | None = None) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        table = _training_table(StarBinding(spark, folder))
        grown = table.rebalanced()
        model = training.fit_candidate(training.Fold(*grown.model_input(), None), candidate)
        ranked = report(spark, model, table.names)
        return ranked if top is None else training.top_rows(ranked, top)

    return run


def _train(bound: StarBinding, run_log: str | None = None) -> training.TrainingRun:
    return training.train_select(_engineered(bound), run_log=run_log, journal=_journal(bound.spark))


def _run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "runs")
    _train(StarBinding(spark, folder), path)
    return runs.read_runs(spark, path)


def _saved_model(bound: StarBinding):
    """A fitted model with its preparation, the same after saving and loading, and the table of its customers."""
    spark = bound.spark
    fitted, table = prepared(bound)
    rows = training.TrainingTable(materialise(fitted.transform(table), "train"), fitted.names)
    model = training.fit_candidate(training.Fold(*rows.model_input(), None), SHORT_LOGISTIC[0])
    assembler = training.VectorAssembler(inputCols=fitted.names, outputCol="features")
    pipeline, path = training.PipelineModel(stages=[assembler, model]), scratch_path(spark, "model")
    runs.save_model(path, pipeline, fitted)
    return (pipeline, fitted), runs.load_model(spark, path), table


def _reloaded_scores(bound: StarBinding) -> DataFrame:
    """Fit, save, load and score the whole table without its label."""
    _, loaded, table = _saved_model(bound)
    return training.score_customers(*loaded, table)


def _model_round_trip(bound: StarBinding) -> DataFrame:
    """Per customer, whether a saved and loaded model gives the score of the fitted one, and one between 0 and 1."""
    fitted, loaded, table = _saved_model(bound)
    before = training.score_customers(*fitted, table).select("customer_id", F.col("p").alias("before"))
    after = training.score_customers(*loaded, table).select("customer_id", F.col("p").alias("after"))
    before, after = materialise(before, "before"), materialise(after, "after")
    return before.join(after, "customer_id").select(
        "customer_id", (F.abs(F.col("before") - F.col("after")) < 1e-9).alias("same"), F.col("after").between(0, 1).alias("is_share")
    )


def _driver_ranks(bound: StarBinding) -> DataFrame:
    """Per report of what drives a model: its features, whether they fall in order, and the rows of report and chart."""
    spark, found = bound.spark, []
    for name, candidate, report in (
        ("coefficients", SHORT_LOGISTIC[0], training.coefficients), ("feature_importance", SHORT_FOREST[0], training.feature_importance)
    ):
        table = _drivers(candidate, report)(spark, bound.folder)
        sizes = [abs(row[1]) for row in table.collect()]  # one row per feature
        shown = [training.top_rows(table, n).count() for n in (10, 15)]
        whole = abs(sum(sizes) - 1) < 1e-9 if name == "feature_importance" else None
        found.append((name, len(sizes), sizes == sorted(sizes, reverse=True), *shown, whole))
    schema = "report string, n_features int, falls boolean, in_report int, in_chart int, sums_to_one boolean"
    return spark.createDataFrame(found, schema)


def _search_folds(bound: StarBinding) -> DataFrame:
    """What each fit of the search sees: held-out and training rows per fold, and those of the refit (fold 5)."""
    table, numbers = _search_parts(bound).table, range(6)
    listed = F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.col("weights")[i].alias("weight")) for i in numbers]))
    rows = table.select("target", "fold", listed.alias("of")).select("target", "fold", "of.*")
    inside = F.col("weight") > 0
    return rows.groupBy(F.col("part").alias("fold_no")).agg(
        F.sum(columns.flag(F.col("fold") == F.col("part"))).cast("long").alias("held_out"),
        F.sum(columns.flag((F.col("fold") == F.col("part")) & (F.col("target") == 1))).cast("long").alias("held_out_churned"),
        F.sum(columns.flag(inside)).cast("long").alias("training"),
        F.sum(columns.flag(inside & (F.col("target") == 1))).cast("long").alias("training_churned"),
        F.sum(columns.flag(inside & F.col("fold").isNull())).cast("long").alias("synthetic"),
    ).withColumnsRenamed({"fold_no": "fold"})


def _run_facts(spark: SparkSession, folder: str) -> DataFrame:
    """The run log's facts that do not hang on a fit: sizes and rates, and how many entries of each kind there are."""
    log = _run_metrics(spark, folder)
    data = log.filter("stage = 'data'").select("stage", "key", "value_double")
    kinds = log.filter("stage IN ('search', 'test', 'selection')").groupBy("stage", "key").agg(F.count("*").cast("double").alias("value_double"))
    return rounded(data.unionByName(kinds.select("stage", "key", "value_double")))


def _training() -> dict[str, Query]:
    return {
        "logistic_search": _search(training.logistic_grid()),
        "forest_search": _search(training.forest_grid()),
        "train_select": _bound(lambda b: _train(b).comparison),
        "coefficients": _drivers(SHORT_LOGISTIC[0], training.coefficients),
        "feature_importance": _drivers(SHORT_FOREST[0], training.feature_importance),
        "top_features": _drivers(SHORT_FOREST[0], training.feature_importance, 15),
        "score_customers": _bound(_reloaded_scores),
        "model_round_trip": _bound(_model_round_trip),
        "driver_ranks": _bound(_driver_ranks),
        "search_folds": _bound(_search_folds),
        "run_facts": _run_facts,
        "run_metrics": _run_metrics,
    }


def _csv_round_trip(bound: StarBinding) -> DataFrame:
    churn = churn_table(bound)
    path = scratch_path(churn.sparkSession, "churn-csv")
    write_report(churn, path, "csv")
    return load_csv(churn.sparkSession, path, CHURN_SCHEMA)


def _report_round_trip(bound: StarBinding) -> DataFrame:
    scored = scored_customers(bound)
    spark, path = scored.sparkSession, scratch_path(scored.sparkSession, "impact-csv")
    report = rounded(impact.retention_impact(scored, star.SCORE_THRESHOLD))
    write_report(report, path, "csv")
    return load_csv(spark, path, report.schema, required=())


def _csv_texts(bound: StarBinding) -> DataFrame:
    """Whole texts with quotes, commas and line ends, and look-alikes of numbers and missing values, by way of a file."""
    docs = bound.spark.read.parquet(f"{bound.folder}/documents.parquet")
    likes = F.array(*map(F.lit, ("none", "Na", " NA ", "1D", "NULL", "", "-1", "True")))
    text = F.concat(F.lit('say "hi", ok\n '), F.regexp_replace("text", "\r", ""), F.lit(" "))
    path = scratch_path(bound.spark, "texts-csv")
    write_report(docs.select("doc_id", text.alias("note"), likes[(F.col("doc_id") % 8).cast("int")].alias("like")), path, "csv")
    return load_csv(bound.spark, path, required=("doc_id", "note"))


def _medians_with_infinity(bound: StarBinding) -> DataFrame:
    """Median of the charges, with the charges of some customers infinite."""
    key, infinite = F.col("customer_id"), F.lit(float("inf"))
    charges = F.when(key % 5 == 0, infinite).when(key % 7 == 0, -infinite).otherwise(F.col("monthly_charges"))
    churn = materialise(churn_table(bound).select(charges.alias("charges")), "charges")
    return rounded(cleaning.medians(churn, ["charges"]))


def _test_part_prepared(bound: StarBinding) -> DataFrame:
    """Test rows coded with the categories of all rows and scaled with the moments of the training rows."""
    table = _engineered(bound)
    split = materialise(features.stratified_split(table), "split")
    train, test = (split.filter(F.col("split") == part).drop("split") for part in ("train", "test"))
    return rounded(features.fit_features(train, labels_from=table).transform(test))


def _cohort_sql(bound: StarBinding) -> DataFrame:
    """A report written as SQL text over named views."""
    register_views({"churn_dataset": churn_table(bound)})
    report = bound.spark.sql(
        """
        SELECT contract_type, payment_method, count(*) AS total_customers,
               sum(churn) AS churned_customers, avg(monthly_charges) AS avg_monthly_charges
        FROM churn_dataset GROUP BY contract_type, payment_method
        """
    )
    return rounded(report)


def _date_functions(bound: StarBinding) -> DataFrame:
    signup = F.col("signup_date")
    until = F.coalesce("churn_date", F.lit(star.AS_OF))
    return bound.base().select(
        F.col("c_custkey").alias("customer_id"),
        columns.month_boundaries(signup, until).alias("months_crossed"),
        F.datediff(until, signup).alias("days_between"),
        F.date_sub(signup, 90).alias("days_back"),
        F.add_months(signup, -12).alias("months_back"),
        columns.month_bucket(signup).alias("month_start"),
        until.alias("end_date"),
    )


def _value_functions(bound: StarBinding) -> DataFrame:
    tenure, monthly, support = F.col("tenure_months"), F.col("monthly_charges"), F.col("tech_support")
    return churn_table(bound).select(
        "customer_id",
        F.abs(monthly - 70).alias("charge_gap"),
        columns.half_up(monthly / 7, 2).alias("weekly_charge"),
        columns.ratio(monthly, F.nullif(tenure - 6, F.lit(0))).alias("charge_per_month_past_six"),
        columns.flag(monthly > 70).alias("is_expensive"),
        columns.text_token(support).alias("support_token"),
        F.floor(F.col("total_charges")).cast("long").alias("whole_charges"),
    )


def _sources() -> dict[str, Query]:
    return {
        "csv_round_trip": _bound(_csv_round_trip),
        "csv_texts": _bound(_csv_texts),
        "report_round_trip": _bound(_report_round_trip),
        "medians_with_infinity": _bound(_medians_with_infinity),
        "test_part_prepared": _bound(_test_part_prepared),
        "cohort_sql": _bound(_cohort_sql),
        "date_functions": _bound(_date_functions),
        "value_functions": _bound(_value_functions),
    }


def queries() -> dict[str, Query]:
    return {
        **_base_tables(), **_sources(), **_reports(), **_cleaning(), **_features(), **_evaluation(),
        **_training(),
    }
