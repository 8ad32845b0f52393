"""Run log table and storage of fitted models."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.operators.features import FittedFeatures

RUN_SCHEMA = (
    "run_id string, stage string, model string, key string, value_double double, value_string string"
)


def new_run_id() -> str:
    return uuid.uuid4().hex


def log_run(spark: SparkSession, path: str, run_id: str, entries: Iterable[tuple]) -> None:
    """Append (stage, model, key, value) entries of a run; numbers and texts get their own column."""
    rows = []
    for stage, model, key, value in entries:
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        rows.append(
            (run_id, stage, model, key, float(value), None)
            if number
            else (run_id, stage, model, key, None, None if value is None else str(value))
        )
    table = spark.createDataFrame(rows, RUN_SCHEMA).withColumn("logged_at", F.current_timestamp())
    table.coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{RUN_SCHEMA}, logged_at timestamp").parquet(path)


class SearchJournal:
    """Scores of a search, one record per candidate and fold, in a run table that outlives the search.

    The records of a search carry its digest as run. Each call of :meth:`record` is one append, which Spark commits
    whole or not at all; a record written twice counts once. Threads of one session may share a journal, but
    only one session writes to a path at a time.
    """

    def __init__(self, spark: SparkSession, path: str, search: str):
        self.spark, self.path, self.search = spark, path, search
        self._lock = threading.Lock()
        empty = spark.createDataFrame([], f"{RUN_SCHEMA}, logged_at timestamp")
        empty.coalesce(1).write.mode("ignore").parquet(path)

    def scores(self) -> dict[tuple[str, int], float]:
        """Score by (candidate, fold)."""
        rows = read_runs(self.spark, self.path).filter(
            (F.col("run_id") == self.search) & (F.col("stage") == "fold_score")
        )
        found = {}
        for row in rows.select("key", "value_double").distinct().collect():
            fold, candidate = row["key"].split("|", 1)
            found[candidate, int(fold)] = row["value_double"]
        return found

    def record(self, scores: Iterable[tuple[str, str, int, float]]) -> None:
        """Append (family, candidate, fold, score) records."""
        entries = [("fold_score", family, f"{fold}|{candidate}", float(score)) for family, candidate, fold, score in scores]
        with self._lock:
            log_run(self.spark, self.path, self.search, entries)


def save_model(path: str, model: PipelineModel, fitted: FittedFeatures) -> None:
    """Write the model and the preparation it needs below one folder."""
    model.write().overwrite().save(f"{path}/model")
    fitted.save(f"{path}/preparation")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, FittedFeatures]:
    return PipelineModel.load(f"{path}/model"), FittedFeatures.load(spark, f"{path}/preparation")
