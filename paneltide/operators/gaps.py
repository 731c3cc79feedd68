"""Gaps: measuring them, listing them, filling the time axis, trimming series.

A period is *missing* if it lies between the first and last period of its group and
either has no row (a gap) or, where ``nulls_too`` is set, has a null value.  Nothing
here builds the missing periods just to count them: counts follow from spans and
numbers of observed periods, runs from the distance of neighbouring observed periods.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneltide.functions.blocks import (
    add_block,
    explode_range,
    reject_duplicates,
    spread,
    with_facts,
)
from paneltide.functions.intervals import FORMS, gathered, interval_sets, runs_of, to_form
from paneltide.functions.materialize import cut
from paneltide.functions.scalars import safe_ratio
from paneltide.spec import PanelSpec


def _number(name: str) -> Column:
    return F.col(name).cast("bigint")


def periods(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Distinct (group, time) with ``has_value``: no row of the period has a null value."""
    return (
        df.where(spec.has_key())
        .groupBy(*spec.keys)
        .agg(F.min(F.col(spec.value).isNotNull()).alias("has_value"))
    )


def spans(found: DataFrame, spec: PanelSpec) -> DataFrame:
    """First and last period, length, and observed and valued periods per group."""
    return (
        found.groupBy(*spec.groups)
        .agg(
            F.min(spec.time).alias("first_year"),
            F.max(spec.time).alias("last_year"),
            F.count("*").alias("observed_periods"),
            F.count_if("has_value").alias("valued_periods"),
        )
        .withColumn("series_length", _number("last_year") - _number("first_year") + 1)
    )


def _run_ends(df: DataFrame, spec: PanelSpec, nulls_too: bool) -> DataFrame:
    """Rows that end a run of missing periods, and the last row of every series.

    A run ends before a period that is not missing, and with the last period of its
    series.  ``series_length`` is set in the last row only, so it can be summed up.
    """
    rows = add_block(df.where(spec.has_key()).select(*spec.keys, spec.value), spec)
    here = _number(spec.time)
    present = F.col(spec.value).isNotNull() if nulls_too else F.lit(True)

    def by_block() -> DataFrame:
        blocks = rows.groupBy(*spec.task_keys).agg(
            F.min(here).alias("_lo"), F.max(here).alias("_hi"),
            F.max(F.when(present, here)).alias("_last_present"))
        earlier = spec.over_blocks().rowsBetween(Window.unboundedPreceding, -1)
        return blocks.select(
            *spec.task_keys,
            F.min("_lo").over(spec.whole()).alias("_first"),
            F.max("_hi").over(spec.whole()).alias("_last"),
            F.max("_last_present").over(earlier).alias("_before"))

    in_front = spec.in_order().rowsBetween(Window.unboundedPreceding, -1)
    known = with_facts(reject_duplicates(rows, spec), spec, by_block, {
        "_first": F.min(here).over(spec.whole()),
        "_last": F.max(here).over(spec.whole()),
        "_before": F.lit(None).cast("bigint"),
    }).withColumn("_present", present).withColumn(
        "_previous",
        F.coalesce(F.max(F.when(present, here)).over(in_front), "_before", F.col("_first") - 1))
    is_last = here == F.col("_last")
    return (
        known.where(F.col("_present") | is_last)
        .select(
            *spec.groups,
            (F.col("_previous") + 1).alias("run_start"),
            F.when(F.col("_present"), here - 1).otherwise(here).alias("run_end"),
            F.when(is_last, F.col("_last") - F.col("_first") + 1).alias("series_length"),
        )
        .withColumn("run_length", F.expr("run_end - run_start + 1"))
    )


def missing_runs(df: DataFrame, spec: PanelSpec, nulls_too: bool = True) -> DataFrame:
    """One row per maximal run of missing periods: start, end and length."""
    return _run_ends(df, spec, nulls_too).where("run_length > 0").drop("series_length")


def _merged_runs(df: DataFrame, spec: PanelSpec, nulls_too: bool) -> DataFrame:
    """``missing_runs`` with several rows of a period taken as one, null if any of them is."""
    merged = periods(df, spec).withColumn(spec.value, F.when(F.col("has_value"), 1.0))
    kind = df.schema[spec.time].dataType
    return missing_runs(merged, spec, nulls_too).withColumns(
        {c: F.col(c).cast(kind) for c in ("run_start", "run_end")})


def missing_periods(
    df: DataFrame, spec: PanelSpec, nulls_too: bool = True, duplicates: str = "merge"
) -> DataFrame:
    """One row per (group, missing period); the form without a length bound.

    With ``duplicates='merge'`` a period with several rows counts once, and as null if
    any of them is null; with ``'error'`` it stops the query.
    """
    if duplicates not in ("merge", "error"):
        raise ValueError("duplicates must be 'merge' or 'error'")
    runs = _merged_runs(df, spec, nulls_too) if duplicates == "merge" else missing_runs(df, spec, nulls_too)
    return explode_range(runs, F.col("run_start"), F.col("run_end"), spec.time, spec).select(*spec.keys)


def _bounded_gap_summary(df: DataFrame, spec: PanelSpec, nulls_too: bool) -> DataFrame:
    """The summary with arrays, from sets that the time range bounds, in one shuffle."""
    rows = add_block(df.where(spec.has_key()), spec)
    nulls = F.when(F.col(spec.value).isNull(), F.col(spec.time))
    gathered = rows.groupBy(*spec.groups).agg(
        F.collect_set(spec.time).alias("_observed"), F.collect_set(nulls).alias("_null"))
    first, last = F.array_min("_observed"), F.array_max("_observed")
    missing = F.array_except(F.sequence(first, last), F.col("_observed"))
    if nulls_too:
        missing = F.array_sort(F.array_union(missing, F.col("_null")))
    return gathered.select(
        *spec.groups, first.alias("first_year"), last.alias("last_year"),
        F.size("_observed").cast("bigint").alias("observed_periods"),
        (last.cast("bigint") - first.cast("bigint") + 1).alias("series_length"),
        missing.alias("missing_years"),
    ).withColumn("missing_count", F.size("missing_years").cast("bigint"))


def gap_summary(
    df: DataFrame,
    spec: PanelSpec,
    nulls_too: bool = False,
    lists: str | None = None,
) -> DataFrame:
    """Span, observed and missing periods of every group that misses at least one.

    ``nulls_too`` also counts periods with a null value as missing.  ``missing_runs`` has one
    row per run of missing periods and ``missing_periods`` one per period.  ``lists`` adds
    them as a cell ``missing_years``: as ``runs`` (start, end), which grows with the gaps of
    the group, or with every period as an ``array`` or as ``text``.
    """
    if lists not in (None, *FORMS):
        raise ValueError(f"lists must be None or one of {FORMS}")
    if spec.bounded and lists is not None:
        summary = _bounded_gap_summary(df, spec, nulls_too)
        if lists == "text":
            summary = summary.withColumn(
                "missing_years", F.array_join(F.col("missing_years").cast("array<string>"), ", "))
        elif lists == "runs":
            summary = summary.withColumn("missing_years", runs_of(F.col("missing_years")))
    else:
        present = "valued_periods" if nulls_too else "observed_periods"
        summary = spans(periods(df, spec), spec).withColumn(
            "missing_count", F.col("series_length") - F.col(present)).drop("valued_periods")
        if lists is not None:
            listed = gathered(_merged_runs(df, spec, nulls_too), spec, "missing_years", lists)
            summary = summary.where("missing_count > 0").join(listed, spec.groups, "left")
    return summary.where("missing_count > 0").withColumn(
        "missing_quote", F.col("missing_count") / F.col("series_length"))


def gap_overview(df: DataFrame, spec: PanelSpec, **options: object) -> DataFrame:
    """``gap_summary`` with null values counted as missing, and the runs of missing periods."""
    return gap_summary(df, spec, nulls_too=True, **{"lists": "runs", **options})


def missing_ratio_isolated(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row: missing periods without a missing neighbour, as a share of all spans."""
    single = F.count_if(F.col("run_length") == 1)
    return _run_ends(df, spec, True).agg(
        safe_ratio(single, F.sum("series_length")).alias("missing_ratio_isolated"))


def missing_ratio_sequential(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row: share of periods in missing runs above 1, and group and length of the longest.

    Of several longest runs the one of the first group in sort order counts.
    """
    length = F.when(F.col("run_length") > 1, F.col("run_length"))
    rank = F.struct((-length).alias("rank"), *spec.groups)
    found = _run_ends(df, spec, True).agg(
        safe_ratio(F.coalesce(F.sum(length), F.lit(0)), F.sum("series_length"))
        .alias("missing_ratio_sequential"),
        F.min(F.when(length.isNotNull(), rank)).alias("top"),
    )
    return found.select(
        "missing_ratio_sequential",
        *[F.col(f"top.{g}").alias(f"longest_{g}") for g in spec.groups],
        (-F.col("top.rank")).alias("longest_run_length"),
    )


def densify(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Add a row for every gap; other columns of added rows are null.

    Each row brings forth the gap rows up to the next period of its group, so the
    panel is shuffled once and never joined to a grid.
    """
    rows = add_block(df.where(spec.has_key()), spec)
    return _densify(reject_duplicates(rows, spec), rows, spec, df.columns)


def _densify(
    rows: DataFrame, unchecked: DataFrame, spec: PanelSpec, columns: list[str]
) -> DataFrame:
    """``densify`` for rows that have their block and are known to be unique; the block
    table is made from the rows before that check."""
    kind = rows.schema[spec.time].dataType

    def by_block() -> DataFrame:
        starts = unchecked.groupBy(*spec.task_keys).agg(F.min(spec.time).alias("_first"))
        return starts.select(
            *spec.task_keys, F.lead("_first").over(spec.over_blocks()).alias("_next_first"))

    ahead = with_facts(
        rows.withColumn("_next", F.lead(spec.time).over(spec.in_order())),
        spec, by_block, {"_next_first": F.lit(None).cast(kind)})
    stop = _guarded(F.col(spec.time), F.coalesce("_next", "_next_first", F.col(spec.time) + 1) - 1, spec)
    filled = explode_range(ahead, F.col(spec.time), stop, "_period", spec)
    observed = F.col("_period") == F.col(spec.time)
    return filled.select(*[
        F.col("_period").cast(kind).alias(c) if c == spec.time
        else F.col(c) if c in spec.groups
        else F.when(observed, F.col(c)).alias(c)
        for c in columns
    ])


def _guarded(first: Column, last: Column, spec: PanelSpec) -> Column:
    """``last``, unless it is too far from ``first`` to make all periods between them."""
    far = F.raise_error(F.concat(
        F.lit("periods too far apart to fill in: "), first.cast("string"), F.lit(".."), last.cast("string")))
    return F.when(last.cast("bigint") - first.cast("bigint") >= spec.max_span, far.cast("bigint")).otherwise(last)


def global_grid(
    df: DataFrame, spec: PanelSpec, period_range: tuple[int, int] | None = None
) -> DataFrame:
    """Every group on the same time axis: the whole range of the panel, or the given one."""
    kind = df.schema[spec.time].dataType
    if period_range is None:
        known = df.where(F.col(spec.time).isNotNull())
        first, last = (known.agg(F.min(spec.time)).scalar(), known.agg(F.max(spec.time)).scalar())
    else:
        first, last = (F.lit(bound) for bound in period_range)
    groups = df.where(spec.has_group()).select(*spec.groups).distinct()
    grid = explode_range(groups, first, _guarded(first, last, spec), spec.time, spec.with_(time_range=None)).withColumn(
        spec.time, F.col(spec.time).cast(kind))
    return grid.join(df.where(spec.has_key()), spec.keys, "left").select(*df.columns)


@dataclass(frozen=True)
class Trimmed:
    """What trimming yields: the kept panel and reports on what was cut."""

    panel: DataFrame
    cuts: DataFrame
    above_threshold: DataFrame
    # One row per observed period that was cut.
    removed_periods: DataFrame
    # The same per group, as the runs ``removed_runs``.
    removed_runs: DataFrame

    @property
    def removed_years(self) -> DataFrame:
        """The same with every period in a text, which is as long as the periods."""
        *groups, _ = self.removed_runs.columns
        return self.removed_runs.select(
            *groups, to_form(F.col("removed_runs"), "text").alias("removed_years"))


def _with_rest(df: DataFrame, spec: PanelSpec, threshold: float) -> DataFrame:
    """Rows with ``_above`` (their group is to be cut) and ``_may_start`` (the time of a
    value from which on the rest misses few enough periods)."""
    rows = add_block(df.where(spec.has_key()), spec)
    here, value = _number(spec.time), F.col(spec.value)

    def by_block() -> DataFrame:
        blocks = rows.groupBy(*spec.task_keys).agg(
            F.min(here).alias("_lo"), F.max(here).alias("_hi"),
            F.count("*").alias("_rows"), F.count(spec.value).alias("_values"))
        earlier = spec.over_blocks().rowsBetween(Window.unboundedPreceding, -1)
        whole = spec.whole()
        return blocks.select(
            *spec.task_keys,
            F.min("_lo").over(whole).alias("_first"),
            F.max("_hi").over(whole).alias("_last"),
            F.sum("_rows").over(whole).alias("_observed"),
            F.coalesce(F.sum("_values").over(earlier), F.lit(0)).alias("_before"))

    known = with_facts(reject_duplicates(rows, spec), spec, by_block, {
        "_first": F.min(here).over(spec.whole()),
        "_last": F.max(here).over(spec.whole()),
        "_observed": F.count("*").over(spec.whole()),
        "_before": F.lit(0).cast("bigint"),
    })
    in_front = spec.in_order().rowsBetween(Window.unboundedPreceding, -1)
    length = F.col("_last") - F.col("_first") + 1
    offset = here - F.col("_first")
    return (
        known.withColumn("_length", length)
        .withColumn("_gaps", F.col("_length") - F.col("_observed"))
        .withColumn("_above", F.col("_gaps") / F.col("_length") > threshold)
        .withColumn("_front", F.col("_before") + F.count(spec.value).over(in_front))
        .withColumn("_share", (F.col("_gaps") - offset + F.col("_front")) / (F.col("_length") - offset))
        .withColumn("_may_start", F.when(value.isNotNull() & (F.col("_share") <= threshold), here))
    )


def trim_cuts(df: DataFrame, spec: PanelSpec, threshold: float = 0.2) -> DataFrame:
    """Where each group whose share of gaps is above the threshold has to be cut.

    A series is cut from the start until the share of missing periods in the rest is
    at most the threshold, then up to its next value.  With k the distance of a value
    from the first period and b the number of values before it, the rest from there on
    still misses ``gaps - (k - b)`` of ``length - k`` periods; the first value for which
    that share is low enough is where the kept part starts (``keep_from``).  It is null
    if no part can be kept.  Gaps alone decide whether a group is cut, while nulls count
    as missing when they are removed.
    """
    return (
        _with_rest(df.select(*spec.keys, spec.value), spec, threshold)
        .where("_above")
        .groupBy(*spec.groups)
        .agg(
            F.min("_first").alias("from_year"),
            F.max("_last").alias("_end"),
            F.min("_may_start").alias("keep_from"),
        )
        .withColumn("to_year", F.coalesce(F.col("keep_from") - 1, F.col("_end")))
        .select(*spec.groups, "from_year", "to_year", "keep_from")
    )


def removed_periods(df: DataFrame, cuts: DataFrame, spec: PanelSpec) -> DataFrame:
    """Observed periods that the cuts remove, one row each."""
    rows = add_block(df.where(spec.has_key()).select(*spec.keys), spec)
    return (
        spread(rows, cuts, spec, "inner")
        .where(F.col(spec.time) <= F.col("to_year"))
        .select(*spec.keys)
    )


def emptied_groups(cuts: DataFrame, spec: PanelSpec) -> DataFrame:
    """Groups of which the cuts leave nothing."""
    return cuts.where("keep_from is null").select(*spec.groups)


def trim_panel(
    df: DataFrame, spec: PanelSpec, threshold: float = 0.2, cuts: DataFrame | None = None
) -> DataFrame:
    """Rows that trimming keeps, with the gaps of every remaining series as null rows.

    Without a declared time range the cuts are read more than once.  They are written
    when this is called, unless they are passed in.
    """
    if spec.bounded:
        start = F.min("_may_start").over(spec.whole())
        kept = _with_rest(df, spec, threshold).withColumn("_start", start).where(
            ~F.col("_above") | (_number(spec.time) >= F.col("_start")))
        # The rows have been checked for repeated periods, and are still in time order.
        return _densify(kept, kept, spec, df.columns)
    rows = add_block(df.where(spec.has_key()), spec)
    if cuts is None:
        cuts = cut(trim_cuts(df, spec, threshold))
    kept = spread(rows, cuts, spec).where(
        F.col("to_year").isNull() | (F.col(spec.time) > F.col("to_year")))
    return _densify(reject_duplicates(kept, spec), kept, spec, df.columns)


def trim_by_missing_ratio(
    df: DataFrame, spec: PanelSpec, threshold: float = 0.2
) -> Trimmed:
    cuts = trim_cuts(df, spec, threshold)
    if not spec.bounded:
        cuts = cut(cuts)
    removed = removed_periods(df, cuts, spec)
    return Trimmed(
        panel=trim_panel(df, spec, threshold, cuts),
        cuts=cuts,
        above_threshold=gap_summary(df, spec).where(
            F.col("missing_quote") > threshold),
        removed_periods=removed,
        removed_runs=interval_sets(removed, spec, "removed_runs"),
    )
