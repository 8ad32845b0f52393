"""The whole training job: from a customer file or table to model, reports and projected impact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keepwell.operators.cleaning import clean
from keepwell.operators.features import engineer
from keepwell.plans.impact import retention_impact
from keepwell.plans.training import FOREST, Candidate, TrainingRun, train_select
from keepwell.scratch import materialise
from keepwell.sources.runs import log_run, save_model
from keepwell.sources.tables import load_csv, require_columns, write_report


def run_churn_model(
    source: DataFrame | str,
    output: str,
    spark: SparkSession | None = None,
    schema: T.StructType | None = None,
    grids: Sequence[Sequence[Candidate]] | None = None,
    threshold: float = 0.7,
    success_rate: float = 0.50,
    customer_value: float = 1200,
    order_by: Sequence[str] = (),
    **training,
) -> TrainingRun:
    """Train on a delimited file or a table and write everything below ``output``.

    ``output`` receives ``model`` (with its preparation), ``runs`` (the appended run log) and the
    ``reports``: ``model_comparison``, ``business_impact`` and the feature importance or coefficients
    of the best model. Further arguments go to :func:`train_select`.
    """
    if isinstance(source, str):
        source = load_csv(spark or SparkSession.active(), source, schema)
    table = materialise(engineer(clean(require_columns(source), order_by=order_by)), "engineered")
    log = f"{output}/runs"
    run = train_select(table, grids, run_log=log, **training)
    impact = retention_impact(run.scored[run.best_name], threshold, success_rate, customer_value)
    impact = materialise(impact, "impact")
    entries = [("impact", run.best_name, k, v) for k, v in impact.first().asDict().items()]
    log_run(table.sparkSession, log, run.run_id, entries)
    drivers = "feature_importance" if run.best_name == FOREST else "model_coefficients"
    write_report(run.drivers(), f"{output}/reports/{drivers}", "csv")
    write_report(run.comparison, f"{output}/reports/model_comparison", "csv")
    write_report(impact, f"{output}/reports/business_impact", "csv")
    save_model(f"{output}/model", run.pipeline, run.fitted)
    return run
