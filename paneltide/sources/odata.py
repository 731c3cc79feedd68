"""Landed OData-JSON responses of health indicators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.functions.scalars import to_number, to_period
from paneltide.operators.relational import first_rows
from paneltide.sources import landed
from paneltide.spec import PanelSpec

# Field names of a response, and the value fields in order of preference.
GROUP_FIELD, TIME_FIELD, FILTER_FIELD = "SpatialDim", "TimeDim", "Dim1"
VALUE_FIELDS = ("numericValue", "NumericValue", "value")


@dataclass(frozen=True)
class Indicator:
    """An indicator: its code, the column it becomes, and an optional value of Dim1."""

    code: str
    col: str
    dim1_filter: str | None = None


# The indicators that the health data are enriched with.
INDICATORS = (
    Indicator("HWF_0001", "Ärzte_pro_10000"),
    Indicator("HWF_0002", "Ärzte"),
    Indicator("HWF_0004", "Arzthelfer_pro_10000"),
    Indicator("WHS6_102", "Krankenhausbetten_pro_10000"),
    Indicator("GLASSAMC_AWARE", "Access_Anteil", "GLASSAMCAWARE_ANTIBIOTICSGROUP_GLASSAMC_AWARE_A"),
)


def read_responses(
    spark: SparkSession, path: str, one_per_line: bool = False, files: DataFrame | None = None,
) -> DataFrame:
    """Response texts from folders ``indicator=<code>``: (indicator, source, line, value).

    ``files`` are the files to read (``landed.needed_files``), all others are left alone.  Their
    names pass through the driver, as those of a listing do.

    ``line`` puts the lines of a file in order: where their part of the file starts, and
    their place in that part, which one task reads from its start to its end.  The numbers
    themselves depend on the tasks, their order does not.
    """
    texts = landed.read_text(spark, path, files, wholetext=not one_per_line)
    place = F.struct(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return texts.select(
        F.col("indicator").cast("string").alias("indicator"),
        F.col("_metadata.file_path").alias("source"), place.alias("line"), "value")


def parse_responses(responses: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row per element: (indicator, source, line, position, dim1, group, time, value).

    ``position`` keeps the order of a response, and ``line`` that of the responses of a file.  The value field is chosen per response:
    the first of the candidates that any element has.  A response with elements but
    without a value field stops the query.
    """
    # Responses that were not read from lines are alone in their source.
    line = F.col("line") if "line" in responses.columns else F.lit(0)
    parsed = responses.select(
        "indicator", "source", line.alias("line"),
        F.from_json("value", "value array<map<string,string>>")["value"].alias("_items"))

    def if_present(name: str) -> Column:
        return F.when(F.exists("_items", lambda m: F.map_contains_key(m, name)), F.lit(name))

    field = F.coalesce(*[if_present(name) for name in VALUE_FIELDS])
    missing = F.raise_error(F.concat(F.lit("no value field in "), F.col("source"))).cast("string")
    chosen = parsed.withColumn(
        "_field", F.coalesce(field, F.when(F.size("_items") > 0, missing)))
    items = F.transform("_items", lambda m: F.struct(
        m[FILTER_FIELD].alias("dim1"), m[GROUP_FIELD].alias("group"), m[TIME_FIELD].alias("time"),
        m[F.col("_field")].alias("number")))
    rows = chosen.select("indicator", "source", "line", F.posexplode(items).alias("position", "_item"))
    return rows.select(
        "indicator", "source", "line", "position", F.col("_item.dim1").alias("dim1"),
        F.col("_item.group").alias(spec.groups[0]),
        to_period(F.col("_item.time")).alias(spec.time),
        to_number(F.col("_item.number")).alias(spec.value))


def tidy_indicator(df: DataFrame, spec: PanelSpec, order: str) -> DataFrame:
    """A frame with response fields as columns to (group, time, value), first row per key.

    The column ``order`` says which row of a key is the first.  The value column is the first of the candidates that exists.  Two of them differ only
    by case, so columns are picked by position.
    """
    chosen = next((n for n in VALUE_FIELDS if n in df.columns), None)
    if chosen is None:
        raise ValueError(f"none of {VALUE_FIELDS} in {df.columns}")
    names = {GROUP_FIELD: spec.groups[0], TIME_FIELD: spec.time, chosen: spec.value}
    renamed = df.toDF(*[names.get(c, f"_{i}") for i, c in enumerate(df.columns)])
    at = f"_{df.columns.index(order)}"
    return first_rows(renamed.select(*spec.keys, spec.value, at), spec.keys, [at]).drop(at)


def select_indicators(
    rows: DataFrame, spec: PanelSpec, indicators: Sequence[Indicator] = INDICATORS
) -> DataFrame:
    """Rows of the listed indicators as (col, group, time, value), first row per key.

    The first is by file, line and position.  Where an indicator names a value of Dim1, only rows with it count.
    """
    wanted = rows.sparkSession.createDataFrame(
        [(i.code, i.col, i.dim1_filter) for i in indicators],
        "indicator string, col string, dim1_filter string")
    # The list is that of the caller. A shuffle by indicator would send all rows of one to one task.
    kept = rows.join(F.broadcast(wanted), "indicator", "inner").where(
        F.col("dim1_filter").isNull() | (F.col("dim1") == F.col("dim1_filter")))
    arrival = ["source", "line", "position"]
    tidy = kept.select("col", *spec.keys, spec.value, *arrival)
    return first_rows(tidy, ["col", *spec.keys], arrival).drop(*arrival)
