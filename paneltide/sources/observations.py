"""CSV and Parquet files of observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.functions.scalars import nan_to_null, null_words, strip, to_number, to_period
from paneltide.operators.relational import group_periods, ordered
from paneltide.spec import PanelSpec

# The key of the observation table and its order in files.
KEY = ("PHARMACEUTICAL", "REF_AREA", "TIME_PERIOD")


def typed(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Text columns to an integer period and a double value; what is neither is null."""
    return df.withColumns({
        spec.time: to_period(F.col(spec.time)), spec.value: to_number(F.col(spec.value))})


def read_csv(
    spark: SparkSession, path: str, spec: PanelSpec,
    columns: Sequence[str] | None = None, quoted_lines: bool = False,
) -> DataFrame:
    """Observations from CSV files with a header; null words in any column become null.

    ``columns`` names the columns of the files, which saves reading the header first.
    ``quoted_lines`` allows line breaks in quoted cells, but then files are not split.
    """
    reader = spark.read.option("header", True).option("multiLine", quoted_lines).option("escape", '"')
    if columns is not None:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    raw = reader.csv(path)
    cleaned = raw.select(*[null_words(F.col(f"`{c}`")).alias(c) for c in raw.columns])
    # A time or value column that is absent is a mistake in the call, not a missing value.
    return typed(cleaned, spec)


def write_csv(df: DataFrame, path: str, keys: Sequence[str] = (), overwrite: bool = False) -> None:
    """CSV files with a header; with ``keys`` in their order over all files."""
    out = ordered(df, keys) if keys else df
    out.write.mode("overwrite" if overwrite else "errorifexists").option(
        "header", True).option("escape", '"').csv(path)


def write_table(df: DataFrame, path: str, code: str = "PHARMACEUTICAL", overwrite: bool = False) -> None:
    """Parquet, one folder per code, so that a filter on codes reads only theirs.

    Rows are brought together by code first; a code with many rows gets several files.
    """
    df.hint("rebalance", code).write.mode(
        "overwrite" if overwrite else "errorifexists").partitionBy(code).parquet(path)


def read_table(spark: SparkSession, path: str, spec: PanelSpec | None = None) -> DataFrame:
    """Parquet observations; with ``spec``, values that are not a number become null."""
    df = spark.read.parquet(path)
    return df if spec is None else df.withColumn(spec.value, nan_to_null(F.col(spec.value)))


def read_group_periods(spark: SparkSession, path: str, spec: PanelSpec) -> DataFrame:
    """Distinct (group, period) of a CSV file, without nulls."""
    raw = spark.read.option("header", True).csv(path).select(*spec.keys)
    keys = raw.select(
        *[null_words(F.col(g)).alias(g) for g in spec.groups],
        to_period(strip(F.col(spec.time))).alias(spec.time))
    return group_periods(keys, spec)
