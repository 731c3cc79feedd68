"""Sets of periods as runs, against plain sets."""

import random

import pytest
from pyspark.sql import functions as F

import naive
from paneltide import PanelSpec
from paneltide.functions import intervals
from paneltide.operators import gaps, relational, status

SPEC = PanelSpec("g", "t", "v", status=("s",))
SPECS = {"block": SPEC, "split": SPEC.with_(block=3), "bounded": SPEC.with_(time_range=(-100, 3000))}


@pytest.fixture(params=SPECS, ids=list(SPECS))
def spec(request):
    return SPECS[request.param]


def runs(periods):
    out = []
    for t in sorted(set(periods)):
        if out and out[-1][1] == t - 1:
            out[-1] = (out[-1][0], t)
        else:
            out.append((t, t))
    return out


def cells(df, name):
    return {r.g: [tuple(x) for x in r[name]] for r in df.collect()}


@pytest.fixture
def periods():
    rng = random.Random(2)
    return {f"g{k}": [t for t in range(-20, 30) if rng.random() < rng.choice([0.2, 0.9])] * rng.choice([1, 3]) or [4] for k in range(25)}


def test_sets_of_every_form(panel, spec, periods):
    df = panel([(g, t, None) for g, ts in periods.items() for t in ts] + [(None, 1, None), ("g0", None, None)])
    assert cells(intervals.interval_sets(df, spec, "s"), "s") == {g: runs(ts) for g, ts in periods.items()}
    each = intervals.period_runs(df, spec).collect()
    assert sorted((r.g, r.run_start, r.run_end) for r in each) == sorted((g, a, z) for g, ts in periods.items() for a, z in runs(ts))
    arrays = {r.g: r.periods for r in relational.group_period_lists(df, spec).collect()}
    assert arrays == {g: sorted(set(ts)) for g, ts in periods.items()}
    texts = {r.g: r.s for r in intervals.interval_sets(df, spec, "s", "text").collect()}
    assert texts == {g: ", ".join(map(str, sorted(set(ts)))) for g, ts in periods.items()}
    sizes = intervals.interval_sets(df, spec, "s").select("g", intervals.size(F.col("s")).alias("n"))
    assert {r.g: r.n for r in sizes.collect()} == {g: len(set(ts)) for g, ts in periods.items()}


def test_missing_runs_in_a_cell(panel, spec):
    some = naive.random_panel(3)
    want = {g: naive.missing_runs(s) for g, s in some.items() if naive.missing_runs(s)}
    assert cells(gaps.gap_overview(panel(naive.rows(some)), spec), "missing_years") == want


def test_break_runs_and_counts(panel, spec):
    rng = random.Random(5)
    rows = [(f"g{g}", t, 1.0, "B" if rng.random() < 0.5 else "x") for g in range(9) for t in range(2000, 2030) for _ in range(rng.randint(0, 2))]
    df = panel(rows, "g string, t int, v double, s string")
    breaks = {}
    for g, t, _, s in rows:
        if s == "B":
            breaks.setdefault(g, set()).add(t)
    cut = {g: sum(1 for h, t, _, _ in rows if h == g and t <= max(b)) for g, b in breaks.items()}
    plain = status.break_summary(df, spec)
    assert plain.columns == ["g", "last_break", "rows_cut"]
    assert {r.g: (r.last_break, r.rows_cut) for r in plain.collect()} == {g: (max(b), cut[g]) for g, b in breaks.items()}
    listed = status.break_summary(df, spec, lists="runs")
    assert cells(listed, "years_with_breaks") == {g: runs(b) for g, b in breaks.items()}
    assert {r.g: r.rows_cut for r in listed.collect()} == cut


def test_coverage_gaps(panel, spec, periods):
    df = panel([(g, t, None) for g, ts in periods.items() for t in ts])
    want = {g: runs(set(range(min(ts), max(ts) + 1)) - set(ts)) for g, ts in periods.items()}
    assert cells(status.coverage_missing_lists(df, spec, "runs"), "missing_years") == want
    each = sorted((r.g, r.run_start, r.run_end) for r in status.coverage_gaps(df, spec).collect())
    assert each == sorted((g, a, z) for g, rs in want.items() for a, z in rs)


def test_a_group_of_five_million_periods_is_a_short_cell(spark):
    """No array on the way is longer than a block, and the cell has a run per gap."""
    df = spark.range(5_000_000).selectExpr("'long' g", "cast(id as int) t", "1.0D v", "if(id % 1000003 = 7, 'B', 'x') s").where("t % 1000000 <> 999999")
    found = intervals.interval_sets(df, SPEC, "s").first()
    assert [tuple(r) for r in found.s] == [(k * 1_000_000, k * 1_000_000 + 999_998) for k in range(5)]
    assert tuple(status.break_summary(df, SPEC).first()) == ("long", 4 * 1_000_003 + 7, 4 * 1_000_003 + 7 + 1 - 4)
    plan = status.break_summary(df, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "collect_" not in plan and "sort_array" not in plan
    longest = intervals.add_block(df, SPEC).groupBy(*SPEC.task_keys).agg(F.size(F.collect_set("t")).alias("n")).agg(F.max("n")).first()[0]
    assert longest <= SPEC.block
