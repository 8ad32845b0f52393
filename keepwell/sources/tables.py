"""Table schemas, readers, guards and report sinks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REQUIRED_COLUMNS = ("customer_id", "churn")

# Fields read as missing in delimited files, compared as they stand.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# What a field must look like before it is taken for a number.
WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$|^\s*[+-]?(inf|Infinity)\s*$"

CHURN_SCHEMA = T.StructType(
    [T.StructField("customer_id", T.LongType())]
    + [T.StructField("gender", T.StringType()), T.StructField("senior_citizen", T.IntegerType())]
    + [T.StructField(name, T.StringType()) for name in ("partner", "dependents")]
    + [T.StructField("tenure_months", T.IntegerType())]
    + [
        T.StructField(name, T.StringType())
        for name in (
            "phone_service", "multiple_lines", "internet_service", "online_security", "online_backup",
            "device_protection", "tech_support", "streaming_tv", "streaming_movies", "contract_type",
            "paperless_billing", "payment_method",
        )
    ]
    + [T.StructField(name, T.DoubleType()) for name in ("monthly_charges", "total_charges")]
    + [T.StructField("churn", T.IntegerType())]
)


def require_columns(df: DataFrame, names: Iterable[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Return ``df`` unchanged, or raise when a required column is absent. Runs no job."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def load_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    required: Iterable[str] = REQUIRED_COLUMNS,
    multi_line: bool = True,
) -> DataFrame:
    """Read a delimited file with a header.

    Fields may be quoted; a quote inside one is doubled. Fields are read as text so that every
    missing-value token can be turned into NULL before the cast. Rows with fewer fields than the header
    end in NULLs, and a row with more (but for an empty one at its end) is an error when it is read. Without a schema the types are
    inferred, which costs one extra pass over the file. Line ends inside quotes need ``multi_line``, for
    which each file is read by one task; turn it off for large files that are known to have none.
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
    )
    names = reader.csv(path).columns
    if schema is not None and names != schema.names:
        raise ValueError(f"header {names} differs from the schema {schema.names}")
    extra = "_beyond_header"
    text_schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, extra]])
    read = reader.schema(text_schema).csv(path)
    overlong = F.raise_error(F.lit(f"row with more than {len(names)} fields")).cast("boolean")
    whole = read.filter(F.when(F.col(extra).isNotNull(), overlong).otherwise(F.lit(True)))
    raw = require_columns(whole.drop(extra), required)
    text = raw.select(*[F.when(~F.col(c).isin(*MISSING_TOKENS), F.col(c)).alias(c) for c in raw.columns])
    if schema is None:
        kinds = _inferred_types(text)
    else:
        kinds = {f.name: f.dataType for f in schema.fields}
    return text.select(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()])


def _inferred_types(text: DataFrame) -> dict[str, T.DataType]:
    """Narrowest of bigint, double and boolean that holds every value of a column, else string."""
    tests = {
        "bigint": lambda c: F.col(c).rlike(WHOLE_NUMBER) & F.col(c).try_cast("bigint").isNotNull(),
        "double": lambda c: F.col(c).rlike(NUMBER) & F.col(c).try_cast("double").isNotNull(),
        "boolean": lambda c: F.lower(F.trim(F.col(c))).isin("true", "false"),
    }
    kinds = {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
    row = text.agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(text.columns)],
        *[
            F.count(F.when(test(c), 1)).alias(f"{kind}{i}")
            for i, c in enumerate(text.columns)
            for kind, test in tests.items()
        ],
    ).first()
    return {
        c: next(
            (kinds[k] for k in kinds if row[f"n{i}"] and row[f"{k}{i}"] == row[f"n{i}"]), T.StringType()
        )
        for i, c in enumerate(text.columns)
    }


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Expose the given tables to ``spark.sql`` under their names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def table_shape(df: DataFrame) -> DataFrame:
    """One row: number of records and number of columns."""
    return df.agg(F.count("*").alias("n_records"), F.lit(len(df.columns)).alias("n_columns"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite a report. The file count follows the partitions of ``df``.

    Delimited files keep white space at the ends of fields and double the quotes inside.
    """
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.format(fmt).save(path)
