"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that separate words: space and the control characters tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once per row even where a lambda uses it often."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words of a text as an array; no words for NULL and for texts of white space."""
    core = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, SPACE_CLASS + "+"))


def fresh_name(taken: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no taken column has that name."""
    used = {name.lower() for name in taken}
    while wanted.lower() in used:
        wanted = "_" + wanted
    return wanted


def row_key(row_id: Column, text: Column) -> Column:
    """Tells rows with one identifier but different texts apart; always used beside the identifier."""
    return F.xxhash64(row_id, text)


def put(array: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """``array`` with the values from ``at`` on, made twice as long as often as needed."""
    while at + len(values) > len(array):
        array = np.concatenate((array, np.zeros_like(array)))
    array[at : at + len(values)] = values
    return array
