"""Sets of periods as runs: a sorted array of (start, end), both included.

A set grows with its gaps and not with its periods: a group that is observed without a gap is
one run, however long.  Sets are made per (group, block), where the block width bounds
the periods that are looked at together, and merged per group: runs that touch at a block
border become one.  Periods come back only where they are asked for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneltide.functions.blocks import add_block
from paneltide.spec import PanelSpec

# What a set may be handed out as: its runs, its periods, or these as ``"a, b, c"`` text.
FORMS = ("runs", "array", "text")


def _zipped(starts: Column, ends: Column) -> Column:
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), b.alias("end")))


def _once(value: Column, function: Callable[[Column], Column]) -> Column:
    """function(value), with value worked out once however often the function names it."""
    return F.get(F.transform(F.array(value), function), 0)


def runs_of(periods: Column) -> Column:
    """The runs of an array of distinct periods."""
    def found(x: Column) -> Column:
        starts = F.filter(x, lambda t, i: (i == 0) | (F.get(x, i - 1) < t - 1))
        ends = F.filter(x, lambda t, i: F.get(x, i + 1).isNull() | (F.get(x, i + 1) > t + 1))
        return _zipped(starts, ends)

    return _once(F.sort_array(periods), found)


def merged(runs: Column) -> Column:
    """Runs that do not overlap, with those that touch made one."""
    def found(x: Column) -> Column:
        starts = F.filter(x, lambda r, i: (i == 0) | (F.get(x, i - 1)["end"] < r["start"] - 1))
        ends = F.filter(x, lambda r, i: F.get(x, i + 1).isNull() | (F.get(x, i + 1)["start"] > r["end"] + 1))
        return _zipped(F.transform(starts, lambda r: r["start"]), F.transform(ends, lambda r: r["end"]))

    return _once(F.sort_array(runs), found)


def size(runs: Column) -> Column:
    """The number of periods in a set."""
    return F.aggregate(
        runs, F.lit(0).cast("bigint"), lambda n, r: n + r["end"].cast("bigint") - r["start"].cast("bigint") + 1)


def to_form(runs: Column, form: str) -> Column:
    """A set as one of FORMS; the cell of all but ``runs`` is as long as its periods."""
    if form not in FORMS:
        raise ValueError(f"form must be one of {FORMS}")
    if form == "runs":
        return runs
    periods = F.flatten(F.transform(runs, lambda r: F.sequence(r["start"], r["end"])))
    return periods if form == "array" else F.array_join(periods.cast("array<string>"), ", ")


def block_runs(period: Column) -> Column:
    """Aggregate over the rows of one block: the runs of the periods that are not null."""
    return runs_of(F.collect_set(period))


def over_blocks(runs: str) -> Column:
    """Aggregate over the blocks of a group: their sets in column ``runs``, merged."""
    return merged(F.flatten(F.collect_list(runs)))


def interval_sets(periods: DataFrame, spec: PanelSpec, name: str, form: str = "runs") -> DataFrame:
    """The distinct periods of every group as a set ``name``; repeated rows do not matter."""
    rows = add_block(periods.where(spec.has_key()).select(*spec.keys), spec)
    sets = rows.groupBy(*spec.task_keys).agg(block_runs(F.col(spec.time)).alias(name))
    if not spec.bounded:
        sets = sets.groupBy(*spec.groups).agg(over_blocks(name).alias(name))
    return sets.select(*spec.groups, to_form(F.col(name), form).alias(name))


def period_runs(periods: DataFrame, spec: PanelSpec) -> DataFrame:
    """The same with one row per run: group, ``run_start`` and ``run_end``."""
    return interval_sets(periods, spec, "_runs").select(
        *spec.groups, F.explode("_runs").alias("_run")).select(
        *spec.groups, F.col("_run.start").alias("run_start"), F.col("_run.end").alias("run_end"))


def gathered(runs: DataFrame, spec: PanelSpec, name: str, form: str = "runs") -> DataFrame:
    """Rows (group, run_start, run_end) to one set per group, in the type of the periods."""
    run = F.struct(F.col("run_start").alias("start"), F.col("run_end").alias("end"))
    found = runs.groupBy(*spec.groups).agg(F.sort_array(F.collect_list(run)).alias(name))
    return found.select(*spec.groups, to_form(F.col(name), form).alias(name))
