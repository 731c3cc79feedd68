"""Projections, filters, joins and profiles that need no series order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneltide.functions.blocks import add_block, spread
from paneltide.functions.intervals import interval_sets
from paneltide.spec import PanelSpec

# Columns of the observation table that the analysis has no use for.
IRRELEVANT_COLUMNS = (
    "REF_AREA_LABEL", "MEASURE", "MEASURE_LABEL", "UNIT_MEASURE", "UNIT_MEASURE_LABEL",
    "MARKET_TYPE", "MARKET_TYPE_LABEL", "PHARMACEUTICAL_LABEL", "UNIT_MULT",
    "UNIT_MULT_LABEL", "OBS_STATUS_LABEL", "OBS_STATUS2_LABEL", "OBS_STATUS3_LABEL",
)


def drop_columns(df: DataFrame, columns: Sequence[str] = IRRELEVANT_COLUMNS) -> DataFrame:
    """Drop columns; a name that is not there is an error."""
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        raise ValueError(f"columns not found: {unknown}")
    return df.drop(*columns)


def filter_code_prefix(
    df: DataFrame, prefix: str = "J01", code: str = "PHARMACEUTICAL"
) -> DataFrame:
    """Rows whose code starts with the prefix, ignoring case."""
    return df.where(F.upper(F.col(code).cast("string")).startswith(prefix.upper()))


def expand_codes(codes: DataFrame, requested: Sequence[str], code: str = "id") -> DataFrame:
    """Requested codes with one-letter entries replaced by all codes that start so.

    ``position`` keeps the order: explicit codes as given, then the expanded ones.  If
    a one-letter entry is given and the result holds a code that is not in the list,
    the result is empty.
    """
    spark = codes.sparkSession
    letters = sorted({c for c in requested if len(c) == 1})
    explicit = [(c, i) for i, c in enumerate(requested) if len(c) != 1]
    given = spark.createDataFrame(explicit, f"`{code}` string, position bigint")
    if not letters:
        return given
    expanded = (
        codes.where(F.substring(code, 1, 1).isin(letters))
        .select(code, F.lit(len(requested)).cast("bigint").alias("position")).distinct()
    )
    unknown = given.join(codes.select(code), code, "left_anti")
    return given.union(expanded).where(~unknown.exists())


def key_filter(df: DataFrame, **wanted: str | Sequence[str]) -> DataFrame:
    """Rows whose columns equal a value or one of several; pushed down to the scan."""
    for column, value in wanted.items():
        values = [value] if isinstance(value, str) else list(value)
        df = df.where(F.col(column).isin(*values))
    return df


def last_observations(df: DataFrame, series: Sequence[str], time: str, n: int = 2000) -> DataFrame:
    """The last n rows of every series.

    The rank limit is applied on both sides of the shuffle, so each task sends on at
    most n rows of a series however long it is.
    """
    window = Window.partitionBy(*series).orderBy(F.col(time).desc_nulls_last())
    return df.withColumn("_rank", F.row_number().over(window)).where(
        F.col("_rank") <= n).drop("_rank")


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key in the given order; an aggregate, so copies of a key
    are reduced before the shuffle."""
    others = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


def group_periods(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Distinct (group, period) without nulls: the base grid for indicators."""
    return df.select(*spec.keys).dropna().distinct()


def group_period_lists(df: DataFrame, spec: PanelSpec, form: str = "array") -> DataFrame:
    """The sorted distinct periods of every group in one cell, ``periods``.

    As ``runs`` (start, end) the cell grows with the gaps of the group; an ``array`` or ``text``
    has every period, and ``group_periods`` one row for each.
    """
    return interval_sets(df, spec, "periods", form)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def in_group_range(rows: DataFrame, keys: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows between the first and last key period of their group.

    Rows are reduced by a semi join on (group, period) afterwards, so this is only for
    sources that filter by range.
    """
    bounds = keys.groupBy(*spec.groups).agg(
        F.min(spec.time).alias("_first"), F.max(spec.time).alias("_last"))
    blocked = add_block(rows.where(spec.has_key()), spec)
    return (
        spread(blocked, bounds, spec, "inner")
        .where(F.col(spec.time).between(F.col("_first"), F.col("_last")))
        .select(*rows.columns)
    )


def in_key_periods(rows: DataFrame, keys: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows whose (group, period) is among the keys."""
    return rows.join(keys.select(*spec.keys), spec.keys, "left_semi")


def dataset_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and number of non-null cells."""
    counts = df.agg(F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("column"),
            F.lit(kind).alias("type"), F.count(F.col(name)).alias("non_null"))
        for i, (name, kind) in enumerate(df.dtypes)
    ]).alias("columns"))
    return counts.select(F.explode("columns").alias("c")).select("c.*")


def dataset_size(df: DataFrame, code: str, group: str) -> DataFrame:
    """One row: rows, columns, distinct codes and distinct groups."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.count_distinct(code).alias("n_codes"),
        F.count_distinct(group).alias("n_groups"))


def head(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def ordered(df: DataFrame, keys: Sequence[str], descending: Sequence[str] = ()) -> DataFrame:
    """Sort for output, nulls last; ``descending`` names the keys to turn round."""
    return df.orderBy(*[
        F.col(c).desc_nulls_last() if c in descending else F.col(c).asc_nulls_last()
        for c in keys
    ])


def value_range(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row: first and last period and the lowest and highest value."""
    return df.agg(
        F.min(spec.time).alias("min_year"), F.max(spec.time).alias("max_year"),
        F.min(spec.value).alias("min_value"), F.max(spec.value).alias("max_value"))


def non_null_cells(df: DataFrame, columns: Sequence[str]) -> Column:
    """Number of non-null cells in the columns, as an aggregate."""
    return sum((F.count(F.col(c)) for c in columns), F.lit(0))


def pivot_indicators(rows: DataFrame, spec: PanelSpec, columns: Sequence[str]) -> DataFrame:
    """Long (group, period, col, value) to one column per indicator, all in one shuffle."""
    return rows.groupBy(*spec.keys).pivot("col", list(columns)).agg(F.first(spec.value, True))


def join_indicators(
    base: DataFrame, rows: DataFrame, spec: PanelSpec, columns: Sequence[str]
) -> DataFrame:
    """Base keys with one column per indicator; null where an indicator has no value."""
    return base.join(pivot_indicators(rows, spec, columns), spec.keys, "left")
