"""Choosing an imputation method: mask known values, impute them, measure the errors.

Every candidate position has a priority, the hash of (seed, trial, group, position).
Positions are taken in priority order; one that is too close to a taken one of its
series is refused, and over all series the first ``target`` taken ones count.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneltide.functions.blocks import add_block, reject_duplicates, with_facts
from paneltide.functions.materialize import cut
from paneltide.functions.skew import give_back
from paneltide.operators.complete import filter_complete_series
from paneltide.operators.fill import CURVES, MAX_ORDER, interpolate_spline, legendre, products, scaled, solve
from paneltide.spec import PanelSpec

# Positions that one row chooses from, and how far it looks ahead at first for the next
# position that is taken for certain.
POSITIONS = 1_024


@dataclass(frozen=True)
class MaskKind:
    """How many values one mask covers, and where in a series of n rows it may start."""

    name: str
    width: int
    # Two masks of a series start at least this far apart.
    distance: int
    # Positions kept free at the end, counted from the start of a mask.
    free_at_end: int
    shortest: int


ISOLATED = MaskKind("isolated", width=1, distance=2, free_at_end=2, shortest=3)
SEQUENTIAL = MaskKind("sequential", width=3, distance=3, free_at_end=4, shortest=7)


def complete_lengths(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Number of rows of every group without a null value."""
    return (
        df.where(spec.has_group()).groupBy(*spec.groups)
        .agg(F.count("*").alias("_rows"), F.count(spec.value).alias("_values"))
        .where("_rows = _values").drop("_values")
    )


def _eligible(lengths: DataFrame, kind: MaskKind) -> DataFrame:
    return (
        lengths.where(F.col("_rows") >= kind.shortest)
        .withColumn("_last", F.col("_rows") - kind.free_at_end)
        .where("_last >= 1")
    )


def mask_target(lengths: DataFrame, kind: MaskKind, ratio: float) -> DataFrame:
    """One row: number of candidates, and how many are to be masked (at least one of any)."""
    found = _eligible(lengths, kind).agg(F.coalesce(F.sum("_last"), F.lit(0)).alias("candidates"))
    rounded = F.bround(F.col("candidates") * F.lit(float(ratio))).cast("bigint")
    return found.withColumn(
        "target", F.least(F.greatest(rounded, F.lit(1)), F.col("candidates")))


def _accepted(
    lengths: DataFrame, spec: PanelSpec, kind: MaskKind, seed: int, trials: int,
    ahead: int = POSITIONS,
) -> DataFrame:
    """Positions taken in priority order, per trial and series, without the target.

    A position with the lowest priority among all that are too close to it is taken for
    certain, and then neither side of it has a say in the other.  So a series falls into
    short stretches between such positions, and each stretch is decided on its own.
    Positions are generated from the series lengths, POSITIONS at a time.  Only the rows
    that say which ones are shuffled, so that a long series is worked on by many tasks;
    their number is fixed, as these rows are small but the work on them is not.
    """
    near = kind.distance
    tasks = int(lengths.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def priority(position: Column) -> Column:
        parts = [F.lit(str(seed)), F.col("trial").cast("string"),
                 *[F.col(g).cast("string") for g in spec.groups], position.cast("string")]
        return F.md5(F.concat_ws("|", *parts))

    pieces = (
        _eligible(lengths, kind)
        .withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(trials - 1))))
        .withColumn("_piece", F.explode(F.expr(f"sequence(0L, (_last - 1) div {POSITIONS}L)")))
        .repartition(tasks, "trial", *spec.groups, "_piece")
        .withColumn("_lo", F.col("_piece") * POSITIONS + 1)
        .withColumn("_hi", F.least(F.col("_lo") + POSITIONS - 1, "_last"))
        .withColumn("_from", F.greatest(F.col("_lo") - near + 1, F.lit(1)))
        .withColumn("_to", F.least(F.col("_hi") + ahead, "_last"))
        .withColumn("_pr", F.transform(F.sequence("_from", "_to"), priority))
    )
    none = F.array().cast("array<bigint>")

    def at(position: Column) -> Column:
        return F.get("_pr", (position - F.col("_from")).cast("int"))

    def lowest(position: Column) -> Column:
        own, rivals = at(position), []
        for j in range(1, near):
            rivals += [at(position - j), at(position + j)]
        result = F.lit(True)
        for rival in rivals:
            result = result & (rival.isNull() | (own < rival))
        return result

    def marks() -> Column:
        at_end = F.col("_to") == F.col("_last")
        judged_to = F.when(at_end, F.col("_to")).otherwise(F.col("_to") - near + 1)
        before = F.when(F.col("_lo") == 1, F.array(F.lit(1 - near).cast("bigint"))).otherwise(none)
        after = F.when(at_end, F.array(F.col("_last") + near)).otherwise(none)
        return F.concat(before, F.filter(F.sequence(F.col("_lo"), judged_to), lowest), after)

    # A piece that sees no certain position behind it looks on to the end of its series.
    certain = pieces.withColumn("_marks", marks()).withColumn(
        "_blind", (F.col("_to") < F.col("_last")) & ~F.coalesce(F.array_max("_marks") > F.col("_hi"), F.lit(False)))
    certain = (
        certain.withColumn("_to", F.when(F.col("_blind"), F.col("_last")).otherwise(F.col("_to")))
        .withColumn("_pr", F.when(
            F.col("_blind"), F.transform(F.sequence("_from", "_last"), priority)).otherwise(F.col("_pr")))
        .withColumn("_marks", F.when(F.col("_blind"), marks()).otherwise(F.col("_marks")))
    )
    stretches = F.transform(
        F.filter("_marks", lambda m: m <= F.col("_hi")),
        lambda m, i: F.struct(m.alias("a"), F.get("_marks", i + 1).alias("z")))
    cut = certain.withColumn("_stretch", F.explode(stretches)).select(
        "trial", *spec.groups, "_from", "_pr",
        F.col("_stretch.a").alias("_a"), F.col("_stretch.z").alias("_z"))

    inner = F.when(
        F.col("_a") + near <= F.col("_z") - near,
        F.transform(
            F.sequence(F.col("_a") + near, F.col("_z") - near),
            lambda p: F.struct(at(p).alias("pr"), p.alias("pos"))))
    start = F.when(F.col("_a") >= 1, F.array(F.struct(at(F.col("_a")).alias("pr"), F.col("_a").alias("pos"))))
    empty = F.array().cast("array<struct<pr:string,pos:bigint>>")
    taken = F.aggregate(
        F.array_sort(F.coalesce(inner, empty)), empty,
        lambda done, c: F.when(
            F.exists(done, lambda d: F.abs(d["pos"] - c["pos"]) < near), done
        ).otherwise(F.concat(done, F.array(c))))
    return cut.select(
        "trial", *spec.groups, F.explode(F.concat(F.coalesce(start, empty), taken)).alias("_c")
    ).select("trial", *spec.groups, F.col("_c.pos").alias("position"), F.col("_c.pr").alias("priority"))


def mask_targets(
    df: DataFrame, spec: PanelSpec, kind: MaskKind, ratio: float, seed: int, trials: int = 1,
    lengths: DataFrame | None = None,
) -> DataFrame:
    """Chosen mask starts as (trial, kind, group, position); positions count rows from 0.

    Only the lengths of the series are needed of the panel.  They are read several times,
    so they are written when this is called, unless they are passed in; and so are the positions
    that may be masked, which are counted before they are chosen from.  The first ``target`` by priority are found per leading digits of the priority: their
    counts tell how many of each to keep, so no trial is sorted as a whole.
    """
    if lengths is None:
        lengths = cut(complete_lengths(df, spec))
    taken = cut(_accepted(lengths, spec, kind, seed, trials).withColumn(
        "_bucket", F.substring("priority", 1, 4)))
    target = mask_target(lengths, kind, ratio).select("target").scalar()
    in_order = Window.partitionBy("trial").orderBy("_bucket")
    buckets = (
        taken.groupBy("trial", "_bucket").agg(F.count("*").alias("_n"))
        .withColumn("_before", F.sum("_n").over(
            in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n"))
        .withColumn("_wanted", target - F.col("_before"))
        .where("_wanted > 0").select("trial", "_bucket", "_wanted")
    )
    ranked = Window.partitionBy("trial", "_bucket").orderBy("priority", "position")
    return (
        taken.join(buckets, ["trial", "_bucket"], "inner")
        .withColumn("_rank", F.row_number().over(ranked))
        .where("_rank <= _wanted")
        .select("trial", F.lit(kind.name).alias("kind"), *spec.groups, "position")
    )


def mask_isolated(
    df: DataFrame, spec: PanelSpec, ratio: float, seed: int = 42, trials: int = 1,
    lengths: DataFrame | None = None,
) -> DataFrame:
    """Single values to mask, no two of them neighbours."""
    return mask_targets(df, spec, ISOLATED, ratio, seed, trials, lengths)


def mask_sequential(
    df: DataFrame, spec: PanelSpec, ratio: float, seed: int = 42, trials: int = 1,
    lengths: DataFrame | None = None,
) -> DataFrame:
    """Starts of runs of three values to mask; runs may touch, but not overlap."""
    return mask_targets(df, spec, SEQUENTIAL, ratio, seed, trials, lengths)


def add_position(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Adds ``position``, the place of a row in its series, from 0."""
    rows = add_block(df.where(spec.has_group()), spec)

    def by_block() -> DataFrame:
        earlier = spec.over_blocks().rowsBetween(Window.unboundedPreceding, -1)
        sizes = rows.groupBy(*spec.task_keys).agg(F.count("*").alias("_n"))
        return sizes.select(
            *spec.task_keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))

    ranked = reject_duplicates(rows, spec).withColumn(
        "_rank", F.row_number().over(spec.in_order()))
    return with_facts(ranked, spec, by_block, {"_offset": F.lit(0).cast("bigint")}).select(
        *df.columns, (F.col("_offset") + F.col("_rank") - 1).alias("position"))


def masked_panel(df: DataFrame, spec: PanelSpec, targets: DataFrame) -> DataFrame:
    """The series that hold a target, once per trial and kind, with masked values.

    Columns: trial, kind, group, time, position, value, ``masked_value`` (null where
    masked) and ``is_target`` (the mask starts there).
    """
    cell = F.expr(f"position div {POSITIONS}L")
    width = F.when(F.col("kind") == SEQUENTIAL.name, SEQUENTIAL.width).otherwise(ISOLATED.width)
    run = F.struct("trial", "kind")
    covered = targets.select(
        "trial", "kind", *spec.groups,
        F.col("position").alias("_start"),
        F.explode(F.sequence(F.col("position"), F.col("position") + width - 1)).alias("position"),
    ).withColumn("_cell", cell)
    # A cell is a range of positions and runs are few, which bounds the lists.
    starts = F.collect_set(F.when(F.col("position") == F.col("_start"), F.col("position")))
    by_cell = (
        covered.groupBy("trial", "kind", *spec.groups, "_cell")
        .agg(F.collect_set("position").alias("masked"), starts.alias("starts"))
        .groupBy(*spec.groups, "_cell")
        .agg(F.map_from_entries(F.collect_list(F.struct(run, F.struct("masked", "starts")))).alias("_masks"))
    )
    runs = targets.groupBy(*spec.groups).agg(F.collect_set(run).alias("_runs"))
    rows = add_position(
        filter_complete_series(df.select(*spec.keys, spec.value), spec, unique=True), spec
    ).withColumn("_cell", cell)
    # Cells are multiplied by the runs once they are spread over tasks, like the rows.
    wanted = (
        rows.select(*spec.groups, "_cell").distinct()
        .join(runs, spec.groups, "inner")
        .join(by_cell, [*spec.groups, "_cell"], "left")
        .withColumn("_run", F.explode("_runs"))
        .select(*spec.groups, "_cell", "_run", F.try_element_at("_masks", F.col("_run")).alias("_mask"))
    )

    def among(positions: str) -> Column:
        return F.coalesce(F.array_contains(F.col("_mask")[positions], F.col("position")), F.lit(False))

    return (
        rows.join(wanted, [*spec.groups, "_cell"], "inner")
        .withColumn("is_masked", among("masked"))
        .select(
            F.col("_run.trial").alias("trial"), F.col("_run.kind").alias("kind"), *spec.groups,
            spec.time, "position", spec.value,
            F.when(~F.col("is_masked"), F.col(spec.value)).alias("masked_value"),
            "is_masked", among("starts").alias("is_target"))
    )


def _width() -> Column:
    return F.when(F.col("kind") == SEQUENTIAL.name, SEQUENTIAL.width).otherwise(ISOLATED.width)


def masked_stretches(targets: DataFrame, spec: PanelSpec) -> DataFrame:
    """Targets with ``first`` and ``last``, the ends of the masked positions without a break around them.

    Masked runs may touch, so a stretch may be longer than a run.  Both ends of a series are
    never masked, so there are known values at ``first - 1`` and ``last + 1``.
    """
    runs = spec.with_(group=("trial", "kind", *spec.groups), time="position", checked=True)
    width, here = _width(), F.col("position")
    rows = add_block(targets, runs)
    forward, back = runs.in_order(), runs.backwards()
    unknown = F.lit(None).cast("bigint")

    def starts(before: Column) -> Column:
        return F.when(here - before > width, here)

    def ends(after: Column) -> Column:
        return F.when(after - here > width, here + width - 1)

    def by_block() -> DataFrame:
        inner = rows.withColumns({
            "_start": starts(F.lag("position").over(forward)), "_end": ends(F.lag("position").over(back))})
        blocks = inner.groupBy(*runs.task_keys).agg(
            F.min("position").alias("_lo"), F.max("position").alias("_hi"),
            F.max("_start").alias("_start"), F.min("_end").alias("_end"))
        order, reverse = runs.over_blocks(), runs.over_blocks_backwards()
        others = (Window.unboundedPreceding, -1)
        known = blocks.withColumns({"_before": F.lag("_hi").over(order), "_after": F.lag("_lo").over(reverse)})
        opens = F.when(F.col("_before").isNull() | (F.col("_lo") - F.col("_before") > width), F.col("_lo"))
        closes = F.when(F.col("_after").isNull() | (F.col("_after") - F.col("_hi") > width), F.col("_hi") + width - 1)
        return known.withColumns({
            "_start": F.coalesce("_start", opens), "_end": F.coalesce("_end", closes)}).select(
            *runs.task_keys, "_before", "_after",
            F.max("_start").over(order.rowsBetween(*others)).alias("_carried_start"),
            F.min("_end").over(reverse.rowsBetween(*others)).alias("_carried_end"))

    known = with_facts(
        rows.withColumns({"_previous": F.lag("position").over(forward), "_next": F.lag("position").over(back)}), runs, by_block,
        {name: unknown for name in ("_before", "_after", "_carried_start", "_carried_end")})
    before, after = F.coalesce("_previous", "_before"), F.coalesce("_next", "_after")
    marked = known.withColumns({
        "_start": F.when(before.isNull(), here).otherwise(starts(before)),
        "_end": F.when(after.isNull(), here + width - 1).otherwise(ends(after))})
    to_here = (Window.unboundedPreceding, Window.currentRow)
    return marked.select(
        *targets.columns,
        F.coalesce(F.max("_start").over(forward.rowsBetween(*to_here)), "_carried_start").alias("first"),
        F.coalesce(F.min("_end").over(back.rowsBetween(*to_here)), "_carried_end").alias("last"))


def _series_values(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows of complete series with position, and of their series ``_n``, ``_lo``, ``_hi`` and ``_mean``."""
    rows = add_position(
        filter_complete_series(df.select(*spec.keys, spec.value), spec, unique=True), spec)
    here = F.col(spec.time).cast("double")
    facts = {"_n": F.count("*"), "_lo": F.min(here), "_hi": F.max(here), "_sum": F.sum(spec.value)}
    rows = add_block(rows, spec.with_(checked=True))

    def by_block() -> DataFrame:
        blocks = rows.groupBy(*spec.task_keys).agg(*[e.alias(n) for n, e in facts.items()])
        combine = {"_lo": F.min, "_hi": F.max}
        return blocks.select(*spec.task_keys, *[
            combine.get(n, F.sum)(n).over(spec.whole()).alias(n) for n in facts])

    known = with_facts(rows, spec, by_block, {n: e.over(spec.whole()) for n, e in facts.items()})
    return known.withColumn("_mean", F.col("_sum") / F.col("_n")).drop("_sum")


def _looked_up(stretches: DataFrame, values: DataFrame, spec: PanelSpec) -> DataFrame:
    """Targets with the known values next to their stretch and ``masked``, the values they cover.

    The panel is looked up by (group, position): at most five rows per target, whatever
    the length of its series.
    """
    last = F.col("position") + _width() - 1
    places = F.array_union(
        F.array(F.col("first") - 1, F.col("last") + 1), F.sequence(F.col("position"), last))
    asked = stretches.withColumn("_at", F.explode(places))
    found = values.select(
        *spec.groups, F.col("position").alias("_at"), F.col(spec.time).cast("double").alias("_t"),
        F.col(spec.value).cast("double").alias("_v"), "_n", "_lo", "_hi", "_mean")
    point = F.struct(F.col("_at").alias("at"), F.col("_t").alias("t"), F.col("_v").alias("v"))
    covered = F.col("_at").between(F.col("position"), last)
    return asked.join(found, [*spec.groups, "_at"], "inner").groupBy(
        "trial", "kind", *spec.groups, "position", "first", "last").agg(
        F.max(F.when(F.col("_at") == F.col("first") - 1, F.col("_v"))).alias("before"),
        F.max(F.when(F.col("_at") == F.col("last") + 1, F.col("_v"))).alias("after"),
        F.sort_array(F.collect_list(F.when(covered, point))).alias("masked"),
        *[F.first(c).alias(c) for c in ("_n", "_lo", "_hi", "_mean")])


def _fits(looked_up: DataFrame, values: DataFrame, spec: PanelSpec, order: int) -> DataFrame:
    """Least-squares polynomial of every masked series: (trial, kind, group), coefficients and ``_path``.

    The sums of the normal equations are taken once over each whole series; what is masked is
    taken off them per trial and kind.
    """
    def sums(rows: DataFrame, by: list[str]) -> DataFrame:
        return rows.withColumns({
            "_y": F.col("_v") - F.col("_mean"),
            **{f"_b{i}": b for i, b in enumerate(legendre(scaled(F.col("_t")), order))},
        }).groupBy(*by).agg(*[e.alias(n) for n, e in products(order).items()], F.count("*").alias("_rows"))

    names = list(products(order))
    point = values.withColumns({"_t": F.col(spec.time).cast("double"), "_v": F.col(spec.value).cast("double")})
    whole = sums(point, spec.groups).withColumnsRenamed({n: f"_all{n}" for n in (*names, "_rows")})
    covered = looked_up.select("*", F.explode("masked").alias("_p")).withColumns(
        {"_t": F.col("_p.t"), "_v": F.col("_p.v")})
    off = sums(covered, ["trial", "kind", *spec.groups])
    left = off.join(whole, spec.groups, "inner").withColumns({
        **{n: F.col(f"_all{n}") - F.col(n) for n in names},
        "_masked": F.col("_rows"), "_count": F.col("_all_rows") - F.col("_rows")})
    left = left.withColumn("_degree", F.least(F.lit(order), F.col("_count") - 1))
    return solve(left, order).select(
        "trial", "kind", *spec.groups, "_masked", "_count", "_path", *[f"_c{i}" for i in range(order + 1)])


def _curve_errors(spec: PanelSpec, order: int, curve: str):
    """Errors of the spline over the values of one series, for all its masks, without a copy of it."""
    groups, along = spec.groups, CURVES[curve]

    def errors(series: pa.Table, masks: pa.Table) -> pa.Table:
        trial, kind, at, width, scored = (masks[c].to_pylist() for c in ("trial", "kind", "position", "_width", "_scored"))
        by_place = np.argsort(series["position"].to_numpy())
        t = series["_t"].to_numpy()[by_place]
        v = series["_v"].to_numpy()[by_place]
        by_run: dict = {}
        for k, run in enumerate(zip(trial, kind, strict=True)):
            by_run.setdefault(run, []).append(k)
        out = []
        for (run_trial, run_kind), rows in by_run.items():
            known = np.ones(len(v), bool)
            for k in rows:
                known[at[k]:at[k] + width[k]] = False
            places = np.array([at[k] + j for k in rows for j in range(scored[k])])
            estimate = along(t[known], v[known], order, t[places])
            starts = [at[k] for k in rows for _ in range(scored[k])]
            out += zip([run_trial] * len(places), [run_kind] * len(places), starts, (v[places] - estimate).tolist(), strict=True)
        columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
        keys = {g: pa.array([series[g][0].as_py()] * len(out), series.schema.field(g).type) for g in groups}
        return pa.table({
            "trial": pa.array(columns[0], pa.int32()), "kind": pa.array(columns[1], pa.string()), **keys,
            "position": pa.array(columns[2], pa.int64()), "error": pa.array(columns[3], pa.float64())})

    return errors


def _spline_errors(
    df: DataFrame, spec: PanelSpec, masks: DataFrame, values: DataFrame, order: int, score_all: bool, curve: str
) -> DataFrame:
    """Errors of the masked series that no polynomial is close to: (trial, kind, group, position, error).

    With a declared time range every series goes to one task, once for all its masks.
    Without one, series of any length are filled by block, a copy for each trial and kind.
    """
    if spec.bounded:
        wide = masks.withColumns({"_width": _width(), "_scored": _width() if score_all else F.lit(1)})
        series = values.select(
            *spec.groups, "position", F.col(spec.time).cast("double").alias("_t"), F.col(spec.value).cast("double").alias("_v"))
        keys = ", ".join(f"`{g}` {df.schema[g].dataType.simpleString()}" for g in spec.groups)
        # Both come from the same rows, so the keys of one get names of their own.
        wide = wide.withColumnsRenamed({g: f"_mask_{g}" for g in spec.groups})
        masked = wide.groupBy(*[f"_mask_{g}" for g in spec.groups])
        return series.groupBy(*spec.groups).cogroup(masked).applyInArrow(
            _guarded(_curve_errors(spec, order, curve), spec), f"trial int, kind string, {keys}, position long, error double")
    series = spec.with_(group=("trial", "kind", *spec.groups), value="masked_value")
    filled = interpolate_spline(cut(masked_panel(df, spec, masks)), series, order, curve=curve)
    return filled.where(F.col("is_masked" if score_all else "is_target")).select(
        "trial", "kind", *spec.groups, "position", (F.col(spec.value) - F.col("masked_value")).alias("error"))


def _guarded(function, spec: PanelSpec):
    """``function``, unless a series has no masks or is not there."""
    groups = spec.groups

    def call(series: pa.Table, masks: pa.Table) -> pa.Table:
        if series.num_rows and masks.num_rows:
            return function(series, masks)
        keys = {g: pa.array([], series.schema.field(g).type) for g in groups}
        return pa.table({
            "trial": pa.array([], pa.int32()), "kind": pa.array([], pa.string()), **keys,
            "position": pa.array([], pa.int64()), "error": pa.array([], pa.float64())})

    return call


def masking_errors(
    df: DataFrame, spec: PanelSpec, targets: DataFrame, order: int = 3, score_all: bool = False,
    curve: str = "through",
) -> DataFrame:
    """Error of each method at the masked values: (trial, kind, method, group, position, error).

    Of a run of masked values only the first is scored, unless ``score_all`` is set.  No
    series is copied for a trial: the line needs the two known values around a masked
    stretch, and the polynomial the sums over its whole series less those over what is masked, so the
    work follows the targets.  Only series that need the spline are looked at whole.
    Targets, values and what was looked up are each written once, when this is called.
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    too_high, order = order > MAX_ORDER, min(order, MAX_ORDER)
    targets = cut(targets)
    values = cut(_series_values(df, spec))
    looked_up = cut(_looked_up(masked_stretches(targets, spec), values, spec))
    fits = cut(_fits(looked_up, values, spec, order))
    run = ["trial", "kind", *spec.groups]
    fitted = give_back(looked_up, fits, run, "_masked")
    places = F.col("masked") if score_all else F.slice("masked", 1, 1)
    scored = fitted.withColumn("_p", F.explode(places))
    span = F.col("last") - F.col("first") + 2
    slope = (F.col("after") - F.col("before")) / span
    line = F.col("before") + slope * (F.col("_p.at") - F.col("first") + 1)
    polynomial = F.col("_mean") + sum(
        (F.col(f"_c{i}") * b for i, b in enumerate(legendre(scaled(F.col("_p.t")), order))), F.lit(0.0))
    by_line = F.lit(too_high) & (F.col("_count") > MAX_ORDER + 1)
    smooth = F.when(by_line, line).when(F.col("_path") == "poly", polynomial)
    methods = F.array(
        F.struct(F.lit("linear").alias("method"), line.alias("estimate")),
        F.struct(F.lit("spline").alias("method"), smooth.alias("estimate")))
    plain = scored.withColumn("_m", F.explode(methods)).where("_m.estimate is not null").select(
        "trial", "kind", F.col("_m.method").alias("method"), *spec.groups, "position",
        (F.col("_p.v") - F.col("_m.estimate")).alias("error"))
    on_spline = fits.where("_path = 'spline'")
    if too_high:
        on_spline = on_spline.where(F.col("_count") <= MAX_ORDER + 1)
    if not on_spline.take(1):
        return plain
    masks = give_back(targets, on_spline.select(*run, "_masked", F.lit(True).alias("_on")), run, "_masked").where("_on").drop("_on")
    curved = _spline_errors(df, spec, masks, values, order, score_all, curve)
    return plain.unionByName(curved.select(
        "trial", "kind", F.lit("spline").alias("method"), *spec.groups, "position", "error"))


def error_metrics(errors: DataFrame, *by: str) -> DataFrame:
    """MAE, RMSE and number of scored values, over all rows or per ``by``."""
    error = F.col("error")
    return errors.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.count(error).alias("count"))


def trial_metrics(errors: DataFrame) -> DataFrame:
    """Per trial and method, the mean of the metrics of the kinds that scored any value."""
    kinds = error_metrics(errors, "trial", "kind", "method").where(F.col("count") > 0)
    return kinds.groupBy("trial", "method").agg(
        F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"))


def pooled_metrics(errors: DataFrame, trials: int) -> DataFrame:
    """One row: errors of both methods over all trials, rounded to two places."""
    def of(method: str, error: Column) -> Column:
        return F.when(F.col("method") == method, error)

    error = F.col("error")
    return errors.agg(
        F.round(F.avg(of("linear", F.abs(error))), 2).alias("mae_linear"),
        F.round(F.sqrt(F.avg(of("linear", error * error))), 2).alias("rmse_linear"),
        F.round(F.avg(of("spline", F.abs(error))), 2).alias("mae_spline"),
        F.round(F.sqrt(F.avg(of("spline", error * error))), 2).alias("rmse_spline"),
        F.lit(trials).alias("runs"))


def compare_methods(
    df: DataFrame, spec: PanelSpec, ratio_isolated: float, ratio_sequential: float,
    trials: int = 100, base_seed: int = 42, order: int = 3, score_all: bool = False, curve: str = "through",
) -> DataFrame:
    """Errors of linear and spline imputation over repeated isolated and sequential masking.

    All trials are one job, with the trial as a column.  Both kinds use the same
    priorities in a trial and start from the unmasked panel.
    """
    lengths = cut(complete_lengths(df, spec))
    targets = mask_isolated(df, spec, ratio_isolated, base_seed, trials, lengths).union(
        mask_sequential(df, spec, ratio_sequential, base_seed, trials, lengths))
    return pooled_metrics(masking_errors(df, spec, targets, order, score_all, curve), trials)
