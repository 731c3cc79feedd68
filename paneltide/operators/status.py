"""Status flags: masks, reports per code, trigger counts, and cutting at breaks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneltide.functions.blocks import add_block
from paneltide.functions.intervals import FORMS, block_runs, gathered, over_blocks, to_form
from paneltide.functions.skew import give_back
from paneltide.functions.scalars import any_of, normalize, safe_ratio, split_periods, strip
from paneltide.operators.gaps import missing_runs, periods
from paneltide.spec import PanelSpec

# The flags that the status columns carry.
BREAK = "B"
DEFINITION_DIFFERS = "D"
TRIGGERS = ("P", "E", "D")


def status_mask(
    df: DataFrame, columns: Sequence[str], values: Sequence[str], how: str = "none"
) -> Column:
    """True if any of the columns that exist has one of the values; never null."""
    return any_of(
        F.coalesce(normalize(F.col(c), how).isin(*values), F.lit(False))
        for c in columns if c in df.columns)


def status_report(
    df: DataFrame, spec: PanelSpec, code: str = "PHARMACEUTICAL",
    flag: str = DEFINITION_DIFFERS,
) -> DataFrame:
    """Rows with the flag, rows in all, and their share, for every code."""
    flagged = status_mask(df, spec.status, (flag,), "strip_upper")
    return (
        df.where(F.col(code).isNotNull())
        .groupBy(code)
        .agg(F.count_if(flagged).alias("rows_with_D"), F.count("*").alias("rows_total"))
        .withColumn("share_D", safe_ratio(F.col("rows_with_D"), F.col("rows_total")))
    )


def status_totals(
    df: DataFrame, spec: PanelSpec, flag: str = DEFINITION_DIFFERS
) -> DataFrame:
    """One row over all rows, with or without a code; the share is in percent."""
    flagged = status_mask(df, spec.status, (flag,), "strip_upper")
    return df.agg(F.count_if(flagged).alias("total_d"), F.count("*").alias("total_rows")).withColumn(
        "share_total", safe_ratio(F.col("total_d") * 100.0, F.col("total_rows")))


def lowest_shares(report: DataFrame, code: str = "PHARMACEUTICAL", n: int = 10) -> DataFrame:
    """The codes with the lowest shares, for a bar chart."""
    return report.orderBy("share_D", code).limit(n)


def lowest_code(report: DataFrame, code: str = "PHARMACEUTICAL") -> DataFrame:
    """One row: the code of two or more characters with the lowest share.

    Reading it fails if there is no such code.
    """
    found = (
        report.withColumn(code, strip(F.col(code).cast("string")))
        .where(F.length(code) >= 2)
        .agg(F.min(F.struct("share_D", F.col(code).alias("code"))).alias("best"))
    )
    nothing = F.raise_error(F.lit("no code with at least two characters")).cast("string")
    return found.select(F.coalesce("best.code", nothing).alias(code))


def trigger_counts(
    df: DataFrame, triggers: Sequence[str] = TRIGGERS,
    columns: Sequence[str] = ("OBS_STATUS", "OBS_STATUS2", "OBS_STATUS3"),
) -> DataFrame:
    """Rows that have each trigger value in any status column, as (value, count)."""
    existing = [c for c in columns if c in df.columns]
    if not existing:
        return df.sparkSession.createDataFrame([], "value string, count bigint")
    counts = df.agg(F.array(*[
        F.struct(
            F.lit(v).alias("value"),
            F.count_if(status_mask(df, existing, (v,), "strip")).alias("count"))
        for v in triggers
    ]).alias("counts"))
    return counts.select(F.explode("counts").alias("c")).select("c.value", "c.count")


def trigger_summary(
    df: DataFrame, triggers: Sequence[str] = TRIGGERS,
    columns: Sequence[str] = ("OBS_STATUS", "OBS_STATUS2", "OBS_STATUS3"),
) -> DataFrame:
    """One row: rows with any trigger, and rows with triggers in several columns."""
    hits = sum(
        (status_mask(df, (c,), triggers, "strip").cast("int") for c in columns if c in df.columns),
        F.lit(0))
    return df.agg(
        F.count_if(hits > 0).alias("rows_with_any"),
        F.count_if(hits > 1).alias("rows_with_multiple"))


def add_status_flag(
    df: DataFrame, spec: PanelSpec, flag_col: str = "Status-Flag",
    triggers: Sequence[str] = TRIGGERS, how: str = "strip",
) -> DataFrame:
    """1 if any status column has a trigger value, else 0."""
    return df.withColumn(flag_col, status_mask(df, spec.status, triggers, how).cast("int"))


def add_d_flag(df: DataFrame, spec: PanelSpec, flag_col: str = "D-Flag") -> DataFrame:
    """1 if any status column says that the definition differs, else 0."""
    return add_status_flag(df, spec, flag_col, (DEFINITION_DIFFERS,), "strip_upper")


def coverage(
    df: DataFrame, spec: PanelSpec,
    break_flag: str = BREAK, difference_flag: str = DEFINITION_DIFFERS,
) -> DataFrame:
    """First and last period, rows with a period, flagged rows and gaps per group.

    Rows are first counted per (group, period), on the map side too, so the input is read
    once and a group is as large as its periods.
    """
    counted = df.where(spec.has_group()).groupBy(*spec.keys).agg(
        F.count(spec.time).alias("_rows"),
        F.count_if(status_mask(df, spec.status, (break_flag,))).alias("_breaks"),
        F.count_if(status_mask(df, spec.status, (difference_flag,))).alias("_differences"))
    span = F.max(spec.time).cast("bigint") - F.min(spec.time).cast("bigint") + 1
    return counted.groupBy(*spec.groups).agg(
        F.min(spec.time).alias("min_year"),
        F.max(spec.time).alias("max_year"),
        F.sum("_rows").alias("n_periods"),
        F.sum("_breaks").alias("time_break_rows"),
        F.sum("_differences").alias("defdiff_rows"),
        F.coalesce(span - F.count(spec.time), F.lit(0)).alias("missing_years"))


def group_count(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.where(spec.has_group()).agg(
        F.count_distinct(*spec.groups).alias("num_groups"))


def coverage_gaps(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row per run of gap periods of a group: ``run_start`` and ``run_end``."""
    kind = df.schema[spec.time].dataType
    known = periods(df.withColumn(spec.value, F.lit(1.0)), spec).withColumnRenamed("has_value", spec.value)
    return missing_runs(known, spec, nulls_too=False).select(
        *spec.groups, *[F.col(c).cast(kind).alias(c) for c in ("run_start", "run_end")])


def coverage_missing_lists(df: DataFrame, spec: PanelSpec, form: str = "array") -> DataFrame:
    """Gap periods of every group in one cell, empty where there is none.

    As ``runs`` the cell grows with the gaps; an ``array`` or ``text`` has every period.
    ``coverage_gaps`` has one row per run.
    """
    kind = df.schema[spec.time].dataType.simpleString()
    nothing = F.array().cast(f"array<struct<start:{kind},end:{kind}>>")
    groups = df.where(spec.has_group()).select(*spec.groups).distinct()
    return groups.join(gathered(coverage_gaps(df, spec), spec, "missing_years"), spec.groups, "left").withColumn(
        "missing_years", to_form(F.coalesce("missing_years", nothing), form))


@dataclass(frozen=True)
class BreakCut:
    """What cutting at breaks yields; always the same parts, empty if there is no break."""

    panel: DataFrame
    summary: DataFrame
    total_cut: DataFrame
    break_periods: DataFrame


def break_periods(df: DataFrame, spec: PanelSpec, flag: str = BREAK) -> DataFrame:
    """Distinct (group, period) that carry the break flag."""
    return (
        df.where(spec.has_key() & status_mask(df, spec.status, (flag,)))
        .select(*spec.keys).distinct()
    )


def last_breaks(df: DataFrame, spec: PanelSpec, flag: str = BREAK) -> DataFrame:
    return (
        df.where(spec.has_key() & status_mask(df, spec.status, (flag,)))
        .groupBy(*spec.groups).agg(F.max(spec.time).alias("last_break"))
    )


def cut_at_breaks(
    df: DataFrame, spec: PanelSpec, flag: str = BREAK, keep_groupless: bool = True,
    unique: bool = False,
) -> DataFrame:
    """Rows after the last break of their group; groups without one stay whole.

    Rows without a group have no series to cut and stay, unless ``keep_groupless`` is
    off; rows without a period stay only in groups without a break.  A period may have any
    number of rows: the last breaks are found by an aggregate, and go back to rows that
    need not be gathered by group.  With ``unique`` the caller knows that it has one, and
    if a time range is declared the cut then shares the shuffle of the steps after it.
    """
    is_break = status_mask(df, spec.status, (flag,))
    last = F.max(F.when(is_break, F.col(spec.time)))
    rows = add_block(df if keep_groupless else df.where(spec.has_group()), spec)
    if unique and spec.bounded:
        known = rows.withColumn("_last_break", F.when(spec.has_group(), last.over(spec.whole())))
    else:
        facts = df.where(spec.has_group()).groupBy(*spec.groups).agg(
            last.alias("_last_break"), F.count("*").alias("_n"))
        known = give_back(rows, facts, spec.groups, "_n")
    later = F.col("_last_break").isNull() | F.coalesce(
        F.col(spec.time) > F.col("_last_break"), F.lit(False))
    return known.where(later).select(*df.columns)


def break_summary(
    df: DataFrame, spec: PanelSpec, flag: str = BREAK, lists: str | None = None
) -> DataFrame:
    """Last break and number of rows cut, per group with a break.

    Rows are first counted per (group, period), on the map side too; the rest works on
    that table, by block, and on one row per block.  ``break_periods`` has the breaks, one row
    each.  ``lists`` adds them as a cell ``years_with_breaks``: as ``runs`` (start, end), an
    ``array`` or ``text``.
    """
    if lists not in (None, *FORMS):
        raise ValueError(f"lists must be None or one of {FORMS}")
    counted = add_block(df.where(spec.has_key()), spec).groupBy(
        *dict.fromkeys([*spec.task_keys, spec.time])
    ).agg(F.count("*").alias("_rows"), F.max(status_mask(df, spec.status, (flag,))).alias("_break"))
    own = F.max(F.when(F.col("_break"), F.col(spec.time)))
    here = Window.partitionBy(*spec.task_keys)
    blocks = counted.withColumn("_own", own.over(here)).groupBy(*spec.task_keys).agg(
        F.max("_own").alias("_own"), F.sum("_rows").alias("_all"),
        F.sum(F.when(F.col(spec.time) <= F.col("_own"), F.col("_rows"))).alias("_cut"),
        *([block_runs(F.when(F.col("_break"), F.col(spec.time))).alias("_runs")] if lists else []))
    if spec.bounded:
        found = blocks.where("_own is not null").withColumnsRenamed({"_own": "last_break", "_cut": "rows_cut"})
    else:
        earlier = spec.over_blocks().rowsBetween(Window.unboundedPreceding, -1)
        up_to = F.col("_cut") + F.coalesce(F.sum("_all").over(earlier), F.lit(0))
        found = blocks.withColumn("_cut", up_to).where("_own is not null").groupBy(*spec.groups).agg(
            F.max("_own").alias("last_break"),
            F.max_by("_cut", "_own").alias("rows_cut"),
            *([over_blocks("_runs").alias("_runs")] if lists else []))
    listed = [to_form(F.col("_runs"), lists).alias("years_with_breaks")] if lists else []
    return found.select(*spec.groups, "last_break", *listed, "rows_cut")


def handle_breaks(
    df: DataFrame, spec: PanelSpec, flag: str = BREAK, lists: str | None = None
) -> BreakCut:
    summary = break_summary(df, spec, flag, lists)
    return BreakCut(
        panel=cut_at_breaks(df, spec, flag),
        summary=summary,
        total_cut=summary.agg(F.coalesce(F.sum("rows_cut"), F.lit(0)).alias("total_cut")),
        break_periods=break_periods(df, spec, flag),
    )


def break_periods_from_summary(summary: DataFrame, spec: PanelSpec) -> DataFrame:
    """The break periods that a summary lists as text, one row each."""
    return summary.select(
        *spec.groups, F.explode(split_periods(F.col("years_with_breaks"))).alias(spec.time))
