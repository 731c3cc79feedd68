"""Series operators against plain restatements, for whole and for split series."""

import pytest

import naive
from paneltide import PanelSpec
from paneltide.operators import complete, features, fill, gaps, masking, status

BASE = PanelSpec("g", "t", "v", status=("s",))
SPECS = {
    "bounded": BASE.with_(time_range=(-1000, 3000)),
    "one_block": BASE,
    "blocks_of_4": BASE.with_(block=4),
    "blocks_of_1": BASE.with_(block=1),
}


@pytest.fixture(params=SPECS, ids=list(SPECS))
def spec(request):
    return SPECS[request.param]


@pytest.fixture(params=[1, 2])
def random_panel(request):
    return naive.random_panel(request.param)


def by_group(result, *columns):
    out = {}
    for row in sorted(result.collect(), key=lambda r: (r["g"], r["t"])):
        out.setdefault(row["g"], []).append(tuple(row[c] for c in columns))
    return out


def approx(pairs):
    return [tuple(pytest.approx(x, abs=1e-9) if isinstance(x, float) else x for x in p) for p in pairs]


def test_densify(panel, spec, random_panel):
    got = by_group(gaps.densify(panel(naive.rows(random_panel)), spec), "t", "v")
    assert got == {g: list(naive.dense(s).items()) for g, s in random_panel.items()}


def test_missing_runs(panel, spec, random_panel):
    got = {(r.g, r.run_start, r.run_end, r.run_length)
           for r in gaps.missing_runs(panel(naive.rows(random_panel)), spec).collect()}
    assert got == {(g, a, b, b - a + 1) for g, s in random_panel.items() for a, b in naive.missing_runs(s)}


def test_runs_of_gaps_only(panel, spec, random_panel):
    got = {(r.g, r.run_start, r.run_end)
           for r in gaps.missing_runs(panel(naive.rows(random_panel)), spec, nulls_too=False).collect()}
    present = {g: {t: 0.0 for t in s} for g, s in random_panel.items()}
    assert got == {(g, a, b) for g, s in present.items() for a, b in naive.missing_runs(s)}


def test_ratios_add_up_to_the_missing_share(panel, spec, random_panel):
    df = panel(naive.rows(random_panel))
    isolated = gaps.missing_ratio_isolated(df, spec).first()[0]
    sequential = gaps.missing_ratio_sequential(df, spec).first()
    full = [naive.dense(s) for s in random_panel.values()]
    missing = sum(v is None for s in full for v in s.values()) / sum(map(len, full))
    assert isolated + sequential[0] == pytest.approx(missing)
    longest = max((b - a + 1, g) for g, s in random_panel.items() for a, b in naive.missing_runs(s))[0]
    first = min(g for g, s in random_panel.items() for a, b in naive.missing_runs(s) if b - a + 1 == longest)
    assert (sequential["longest_g"], sequential["longest_run_length"]) == (first, longest)


@pytest.mark.parametrize("nulls_too", [False, True])
def test_gap_summary(panel, spec, random_panel, nulls_too):
    got = {r.g: (r.first_year, r.last_year, r.observed_periods, r.series_length, r.missing_count, r.missing_years)
           for r in gaps.gap_summary(panel(naive.rows(random_panel)), spec, nulls_too, lists="array").collect()}
    want = {}
    for g, s in random_panel.items():
        missing = [t for t, v in naive.dense(s).items() if (v is None if nulls_too else t not in s)]
        if missing:
            want[g] = (min(s), max(s), len(s), max(s) - min(s) + 1, len(missing), missing)
    assert got == want


@pytest.mark.parametrize("threshold", [0.0, 0.2, 0.5])
def test_trim(panel, spec, random_panel, threshold):
    trimmed = gaps.trim_by_missing_ratio(panel(naive.rows(random_panel)), spec, threshold)
    want = {g: naive.trim(s, threshold) for g, s in random_panel.items()}
    assert by_group(trimmed.panel, "t", "v") == {g: list(s.items()) for g, (s, _) in want.items() if s}
    cuts = {r.g: (r.from_year, r.to_year) for r in trimmed.cuts.collect()}
    assert cuts == {g: c for g, (_, c) in want.items() if c}
    emptied = {r.g for r in gaps.emptied_groups(trimmed.cuts, spec).collect()}
    assert emptied == {g for g, (s, c) in want.items() if c and not s}
    removed = {r.g: r.removed_years for r in trimmed.removed_years.collect()}
    assert removed == {
        g: ", ".join(str(t) for t in sorted(random_panel[g]) if t <= c[1]) for g, (_, c) in want.items() if c}


def test_linear(panel, spec, random_panel):
    got = by_group(fill.interpolate_linear(panel(naive.rows(random_panel)), spec), "t", "v", "was_filled")
    for g, s in random_panel.items():
        values = [s[t] for t in sorted(s)]
        filled = naive.linear(values)
        assert got[g] == approx(
            (t, f, v is None and f is not None) for t, v, f in zip(sorted(s), values, filled))


def test_fill_linear_drops_what_stays_null(panel, spec, random_panel):
    got = by_group(fill.fill_linear(panel(naive.rows(random_panel)), spec), "t")
    assert set(got) == {g for g, s in random_panel.items() if any(v is not None for v in s.values())}


def test_lags_and_rolling_means(panel, spec, random_panel):
    result = features.add_time_features(panel(naive.rows(random_panel)), spec, lags=(1, 3), windows=(1, 4))
    got = by_group(result, "t", "lag_1", "lag_3", "roll_mean_1", "roll_mean_4")
    for g, s in random_panel.items():
        values = [s[t] for t in sorted(s)]
        assert got[g] == approx(zip(
            sorted(s), naive.lag(values, 1), naive.lag(values, 3),
            naive.rolling(values, 1), naive.rolling(values, 4)))


def test_complete_series(panel, spec, random_panel):
    got = by_group(complete.filter_complete_series(panel(naive.rows(random_panel)), spec), "t", "v")
    assert got == {g: sorted(s.items()) for g, s in random_panel.items() if None not in s.values()}


def test_positions(panel, spec, random_panel):
    got = by_group(masking.add_position(panel(naive.rows(random_panel)), spec), "t", "position")
    assert got == {g: [(t, i) for i, t in enumerate(sorted(s))] for g, s in random_panel.items()}


def test_cut_at_breaks(panel, spec, random_panel):
    rows = [(g, t, v, "B" if (t + i) % 5 == 0 and i % 3 else "x")
            for i, (g, s) in enumerate(random_panel.items()) for t, v in s.items()]
    kept = status.cut_at_breaks(panel(rows, "g string, t int, v double, s string"), spec)
    want = []
    for g in random_panel:
        breaks = [t for h, t, _, s in rows if h == g and s == "B"]
        want += [r for r in rows if r[0] == g and (not breaks or r[1] > max(breaks))]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("operator", [
    gaps.densify, gaps.missing_runs, fill.interpolate_linear, gaps.trim_panel, fill.interpolate_spline])
def test_repeated_period_stops_the_query(panel, spec, operator):
    df = panel([("a", 1, 1.0), ("a", 2, None), ("a", 2, 3.0), ("a", 4, 3.0), ("b", 1, 1.0)])
    with pytest.raises(Exception, match="duplicate period"):
        operator(df, spec).collect()


def test_summary_merges_repeated_periods(panel, spec):
    df = panel([("a", 1, 1.0), ("a", 2, None), ("a", 2, 3.0), ("a", 4, 3.0)])
    row = gaps.gap_overview(df, spec).first()
    assert (row.observed_periods, row.missing_count, row.missing_years) == (3, 2, "2, 3")


def test_period_outside_the_declared_range_stops_the_query(panel):
    df = panel([("a", 1, 1.0), ("a", 5000, 2.0)])
    with pytest.raises(Exception, match="period outside"):
        gaps.densify(df, SPECS["bounded"]).collect()


def test_null_groups_and_times(panel, spec):
    df = panel([("a", 1, 1.0), ("a", 3, None), ("a", None, 9.0), (None, 1, 5.0), (None, 1, 5.0), (None, None, None)])
    assert gaps.gap_summary(df, spec).count() == 1
    assert sorted(r.t for r in gaps.densify(df, spec).collect()) == [1, 2, 3]
    lagged = features.add_lag_features(df, spec).collect()
    assert len(lagged) == 6
    assert {(r.t, r.lag_1) for r in lagged if r.g == "a"} == {(1, None), (3, 1.0), (None, None)}
    assert all(r.lag_1 is None for r in lagged if r.g is None)
    # The row without a period comes last, so its value closes the gap.
    filled = fill.interpolate_linear(df, spec)
    assert {(r.t, r.v) for r in filled.collect()} == {(1, 1.0), (3, 5.0), (None, 9.0)}


def test_lists_have_no_limit_and_are_the_same_in_both_modes(panel):
    df = panel([("a", 1, 1.0), ("a", 1_200_000, 1.0), ("b", 1, 1.0), ("b", 3, 2.0)])
    for spec in (BASE, BASE.with_(time_range=(0, 2_000_000))):
        rows = gaps.gap_summary(df, spec, lists="array").selectExpr(
            "g", "size(missing_years) n", "missing_years[0] a", "element_at(missing_years, -1) z", "missing_count").collect()
        assert sorted(map(tuple, rows)) == [("a", 1_199_998, 2, 1_199_999, 1_199_998), ("b", 1, 2, 2, 1)]
        assert "missing_years" not in gaps.gap_summary(df, spec).columns


def test_triggers_with_white_space_never_match_a_stripped_cell(spark):
    df = spark.createDataFrame([("D",), (" D",), ("x",), (None,)], "s string")
    got = df.select(status.status_mask(df, ["s"], [" D"], "strip").alias("a"), status.status_mask(df, ["s"], ["D"], "strip").alias("b"))
    assert [tuple(r) for r in got.collect()] == [(False, True), (False, True), (False, False), (False, False)]


def test_high_orders_fall_back_to_the_line(panel, spec):
    rows = [("long", t, None if t in (4, 7, 8) else float(t * t)) for t in range(1, 11)]
    rows += [("short", t, None if t == 3 else float(t * t)) for t in range(1, 6)] + [("one", 1, 5.0), ("one", 2, None)]
    for order in (6, 9):
        filled = fill.interpolate_spline(panel(rows), spec, order)
        got = {(r.g, r.t): (r.v, r.fill_path) for r in filled.where("was_filled").collect()}
        assert got["long", 4] == (17.0, "linear") and got["long", 7][0] == pytest.approx(36 + 45 / 3)
        assert got["short", 3][1] == "poly" and got["short", 3][0] == pytest.approx(9.0)
        assert got["one", 2] == (5.0, "linear")
    assert ("one", 2) not in {(r.g, r.t) for r in fill.fill_spline(panel(rows), spec, 6).collect()}


def test_long_gap_is_expanded_in_steps(panel):
    df = panel([("a", -5, 1.0), ("a", 200_000, 2.0)])
    result = gaps.densify(df, BASE)
    assert (result.count(), result.distinct().count()) == (200_006, 200_006)


def test_an_outlier_period_stops_the_fill(panel, spec):
    df = panel([("a", 2000, 1.0), ("a", 2002, 1.0), ("b", 2001, 1.0), ("b", 2090, 2.0)])
    narrow = spec.with_(max_span=50)
    for fill_in in (gaps.densify, gaps.global_grid):
        with pytest.raises(Exception, match="too far apart"):
            fill_in(df, narrow).collect()
        assert fill_in(df.where("t < 2050"), narrow).count() >= 4


def test_empty_panel(panel, spec):
    df = panel([])
    assert gaps.gap_summary(df, spec).count() == 0
    assert gaps.missing_ratio_isolated(df, spec).first()[0] == 0.0
    assert tuple(gaps.missing_ratio_sequential(df, spec).first()) == (0.0, None, None)
    assert gaps.trim_panel(df, spec).count() == 0
    assert fill.fill_linear(df, spec).count() == 0
    assert fill.fill_spline(df, spec).count() == 0
