"""Derived features, label encoding, scaling and the fitted preparation state."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwell.functions.columns import flag, text_token
from keepwell.operators.ordering import class_cuts, cuts_passed, running_totals
from keepwell.operators.profile import code_moments, first_values, value_counts, weighted_moments, write_profiled
from keepwell.scratch import materialise
from keepwell.sources.tables import string_columns

INLINE_LABELS = 256
WINDOWED_LABELS = 100_000


def engineer(df: DataFrame) -> DataFrame:
    """Add tenure, revenue and contract features for the input columns that exist."""
    present = set(df.columns)
    tenure, monthly = F.col("tenure_months"), F.col("monthly_charges")
    added: dict[str, Column] = {}
    if "tenure_months" in present:
        added["tenure_years"] = tenure / 12
        added["is_new_customer"] = flag(tenure <= 6)
        added["is_loyal_customer"] = flag(tenure >= 24)
    if {"tenure_months", "monthly_charges"} <= present:
        added["total_revenue"] = monthly * tenure
        added["avg_monthly_spend"] = F.try_divide(monthly * tenure, tenure + 1)
    if "contract_type" in present:
        added["is_month_to_month"] = flag(F.col("contract_type") == "Month-to-month")
    return df.withColumns(added) if added else df


def fit_labels(
    df: DataFrame, columns: Sequence[str], windowed_labels: int = WINDOWED_LABELS
) -> DataFrame:
    """Codes 0 .. k-1 in string order for the distinct values of each column.

    Values are counted for all columns in one shuffle. Up to ``windowed_labels`` values per column
    are numbered per column; beyond that the numbering runs over range slices.
    """
    tokens = df.select(*[text_token(F.col(c)).alias(c) for c in columns])
    values = materialise(
        tokens.unpivot([], list(columns), "column", "value").distinct(), "labels"
    )
    return _number_labels(values, _label_sizes(values), windowed_labels)


def _number_labels(values: DataFrame, sizes: dict[str, int], windowed_labels: int) -> DataFrame:
    """Add ``code`` to written rows (column, value, ...), given the number of values per column."""
    if max(sizes.values(), default=0) <= windowed_labels:
        order = Window.partitionBy("column").orderBy("value")
        return values.withColumn("code", F.row_number().over(order) - 1)
    numbered = running_totals(values, [F.col("column"), F.col("value")], {"place": F.lit(1)})
    start, first = F.lit(0), 0
    for column in sorted(sizes):
        start = F.when(F.col("column") == column, F.lit(first)).otherwise(start)
        first += sizes[column]
    return numbered.select(*values.columns, (F.col("place") - 1 - start).cast("int").alias("code"))


def _label_sizes(labels: DataFrame) -> dict[str, int]:
    return {row["column"]: row["count"] for row in labels.groupBy("column").count().collect()}


def feature_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation per column, from one pass."""
    pairs = [
        F.struct(
            F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd")
        ).alias(f"m{i}")
        for i, c in enumerate(columns)
    ]
    wide = df.agg(*pairs)
    return wide.select(F.explode(F.array(*wide.columns)).alias("m")).select("m.*")


@dataclass
class FittedFeatures:
    """Everything needed to repeat a fitted preparation on new rows.

    ``labels`` holds (column, value, code), ``moments`` maps a scaled column to (mean, sd) and
    ``names`` is the feature order. Labels of columns with few values are kept as literals.
    """

    labels: DataFrame
    moments: dict[str, tuple[float | None, float | None]]
    names: list[str]
    encoded: list[str]
    key: str = "customer_id"
    label: str = "churn"
    inline: dict[str, list[str]] = field(default_factory=dict)

    def encode(self, df: DataFrame) -> DataFrame:
        """Replace strings by codes. A value not seen in fitting is an error when the row is computed.

        String columns without fitted labels are dropped, with a warning.
        """
        known_names = {self.key, self.label, *self.encoded}
        unknown = [c for c in string_columns(df) if c not in known_names]
        if unknown:
            warnings.warn(f"columns without fitted labels are dropped: {unknown}", stacklevel=2)
        df = df.drop(*unknown)
        for column in self.encoded:
            token = text_token(F.col(column))
            unseen = F.raise_error(F.concat(F.lit(f"unseen value in {column}: "), token))
            if column in self.inline:
                known = F.array(*[F.lit(v) for v in self.inline[column]])
                place = F.array_position(known, token)
                df = df.withColumn(
                    column, F.when(place > 0, (place - 1).cast("int")).otherwise(unseen)
                )
            else:
                lookup = self.labels.filter(F.col("column") == column).select(
                    F.col("value").alias("_value"), F.col("code").alias("_code")
                )
                df = (
                    df.join(lookup, token == F.col("_value"), "left")
                    .withColumn(column, F.when(F.col("_code").isNotNull(), F.col("_code")).otherwise(unseen))
                    .drop("_value", "_code")
                )
        return df

    def transform(self, df: DataFrame) -> DataFrame:
        """Encode and scale; key and label pass through when present, in front of the features."""
        encoded = self.encode(df)
        columns = [c for c in (self.key, self.label) if c in encoded.columns]
        scaled = []
        for name in self.names:
            if name not in self.moments:
                scaled.append(F.col(name))
                continue
            mean, sd = self.moments[name]
            value = F.col(name).cast("double")
            if mean is not None:
                value = (value - F.lit(mean)) / F.lit(sd or 1.0)
            scaled.append(value.alias(name))
        return encoded.select(*columns, *scaled)

    def assemble(self, prepared: DataFrame, output: str = "features") -> DataFrame:
        """Add the feature vector in the fitted order."""
        return VectorAssembler(inputCols=self.names, outputCol=output).transform(prepared)

    def save(self, path: str) -> None:
        """Write the state as two Parquet tables below ``path``."""
        self.labels.write.mode("overwrite").parquet(f"{path}/labels")
        rows = [
            (i, n, n in self.encoded, n in self.moments, *self.moments.get(n, (None, None)))
            for i, n in enumerate(self.names)
        ]
        rows += [(-2, self.key, False, False, None, None), (-1, self.label, False, False, None, None)]
        schema = (
            "place int, feature string, is_encoded boolean, is_scaled boolean, mean double, sd double"
        )
        spark = self.labels.sparkSession
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{path}/features")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedFeatures:
        key, label, *rows = spark.read.parquet(f"{path}/features").orderBy("place").collect()
        return cls(
            spark.read.parquet(f"{path}/labels"),
            {r["feature"]: (r["mean"], r["sd"]) for r in rows if r["is_scaled"]},
            [r["feature"] for r in rows],
            [r["feature"] for r in rows if r["is_encoded"]],
            key["feature"],
            label["feature"],
        )._with_inline()

    def _with_inline(self) -> FittedFeatures:
        small = [c for c, n in _label_sizes(self.labels).items() if n <= INLINE_LABELS]
        if small:
            few = self.labels.filter(F.col("column").isin(small)).orderBy("column", "code")
            for row in few.collect():
                self.inline.setdefault(row["column"], []).append(row["value"])
        return self


def _feature_names(df: DataFrame, key: str, label: str) -> tuple[list[str], list[str], list[str]]:
    """All features, those that are coded and those that are scaled; an error for columns of other types."""
    if label not in df.columns:
        raise ValueError(f"target column {label!r} not found")
    fields = [f for f in df.schema.fields if f.name not in (key, label)]
    odd = [
        f.name
        for f in fields
        if not isinstance(f.dataType, (T.NumericType, T.StringType, T.BooleanType))
    ]
    if odd:
        raise ValueError(f"columns of unsupported type: {odd}")
    names = [f.name for f in fields]
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    scaled = [f.name for f in fields if not isinstance(f.dataType, T.BooleanType)]
    return names, text, scaled


def fit_features(
    df: DataFrame, key: str = "customer_id", label: str = "churn", labels_from: DataFrame | None = None
) -> FittedFeatures:
    """Learn label codes and scaling moments for every column but key and label.

    Numeric and string columns are used and scaled, booleans are used as they are. ``labels_from`` is a
    table with further rows, such as the test part, whose categories have codes too.
    """
    names, text, scaled = _feature_names(df, key, label)
    empty = df.sparkSession.createDataFrame([], "column string, value string, code int")
    labels = fit_labels(df if labels_from is None else labels_from, text) if text else empty
    fitted = FittedFeatures(labels, {}, names, text, key, label)._with_inline()
    if scaled:
        for row in feature_moments(fitted.encode(df), scaled).collect():
            fitted.moments[row["feature"]] = (row["mean"], row["sd"])
    return fitted


def fit_while_writing(
    df: DataFrame, key: str = "customer_id", label: str = "churn"
) -> tuple[FittedFeatures, DataFrame]:
    """:func:`fit_features` of a table that is still to be written, and the written table.

    The moments of numbers come from one aggregate of the written table, the codes and their moments from
    one count of the values of all string columns.
    """
    names, text, scaled = _feature_names(df, key, label)
    table, profile = write_profiled(df, "engineered")
    moments = {c: profile.moments[c] for c in scaled if c not in text}
    if not text:
        empty = df.sparkSession.createDataFrame([], "column string, value string, code int")
        return FittedFeatures(empty, moments, names, text, key, label), table
    tokens = table.select(*[text_token(F.col(c)).alias(c) for c in text])
    counts = materialise(value_counts(tokens, text), "labels")
    first = first_values(counts, INLINE_LABELS + 1)
    small = {c: found for c, found in first.items() if len(found) <= INLINE_LABELS}
    sizes = {c: len(found) for c, found in small.items()}
    if len(small) < len(first):
        sizes = _label_sizes(counts)
    coded = _number_labels(counts, sizes, WINDOWED_LABELS)
    many = [c for c in first if c not in small]
    if many:
        coded = materialise(coded, "codes")
        moments |= weighted_moments(coded.filter(F.col("column").isin(many)))
    moments |= {c: code_moments([n for _, n in found]) for c, found in small.items()}
    moments |= {c: (None, None) for c in text if c not in first}
    inline = {c: [value for value, _ in found] for c, found in small.items()}
    ordered = {c: moments[c] for c in scaled}
    return FittedFeatures(coded.drop("n"), ordered, names, text, key, label, inline), table


def stratified_split(
    df: DataFrame,
    label: str = "churn",
    key: str = "customer_id",
    test_fraction: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Add ``split`` = train or test; each class gives the rounded fraction of its rows to test."""
    cuts = class_cuts(df, label, key, lambda n: [int(n * test_fraction + 0.5)], seed)
    first = cuts_passed(df, label, key, cuts, seed) == 0
    return df.withColumn("split", F.when(first, "test").otherwise("train"))


def stratified_folds(
    df: DataFrame, label: str, key: str, folds: int = 5, seed: int = 42
) -> DataFrame:
    """Add ``fold`` = 0 .. folds-1; every class is spread over the folds within one row."""
    cuts = class_cuts(df, label, key, lambda n: [n * i // folds for i in range(1, folds)], seed)
    return df.withColumn("fold", cuts_passed(df, label, key, cuts, seed))
