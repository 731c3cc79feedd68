"""Hand-worked cases, one per edge rule."""

import pytest
from pyspark.sql import functions as F

from paneltide import PanelSpec
from paneltide.functions.scalars import split_periods, strip, to_number, to_period
from paneltide.operators import charts, features, fill, gaps, masking, relational, status

SPEC = PanelSpec("g", "t", "v", status=("s1", "s2"))


@pytest.fixture(params=[SPEC, SPEC.with_(time_range=(1900, 2100)), SPEC.with_(block=2)],
                ids=["block", "bounded", "split"])
def spec(request):
    return request.param


def series(df, *columns):
    return [tuple(r[c] for c in columns) for r in sorted(df.collect(), key=lambda r: r["t"])]


def test_trim(panel, spec):
    df = panel([("A", t, float(t)) for t in (2000, 2003, 2004, 2005, 2006)])
    result = gaps.trim_by_missing_ratio(df, spec, 0.2)
    assert series(result.panel, "t") == [(2003,), (2004,), (2005,), (2006,)]
    assert tuple(result.cuts.first()) == ("A", 2000, 2002, 2003)
    assert result.removed_years.first().removed_years == "2000"
    assert result.above_threshold.first().missing_count == 2


def test_trim_at_the_threshold_keeps_all(panel, spec):
    df = panel([("A", t, 1.0) for t in (2000, 2001, 2002, 2004)])
    result = gaps.trim_by_missing_ratio(df, spec, 0.2)
    assert series(result.panel, "t", "v") == [(2000, 1.0), (2001, 1.0), (2002, 1.0), (2003, None), (2004, 1.0)]
    assert result.cuts.count() == 0


def test_trim_ignores_groups_with_nulls_only(panel, spec):
    df = panel([("A", 2000 + i, None if i in (0, 2, 3) else 1.0) for i in range(5)])
    assert gaps.trim_panel(df, spec).count() == 5


def test_trim_keeps_other_columns_on_observed_rows(panel, spec):
    df = panel([("A", 2000, 1.0, "x"), ("A", 2002, 2.0, "y"), ("A", 2003, 2.0, "z"), ("A", 2004, 2.0, "z"),
                ("A", 2005, 2.0, "z")], "g string, t int, v double, note string")
    assert series(gaps.trim_panel(df, spec, 0.3), "t", "note") == [
        (2000, "x"), (2001, None), (2002, "y"), (2003, "z"), (2004, "z"), (2005, "z")]


def test_summary_and_overview(panel, spec):
    df = panel([("A", 2000, 1.0), ("A", 2001, None), ("A", 2003, 1.0)])
    summary = gaps.gap_summary(df, spec, lists="array").first()
    assert (summary.missing_years, summary.missing_count, summary.missing_quote) == ([2002], 1, 0.25)
    assert [tuple(r) for r in gaps.gap_overview(df, spec).first().missing_years] == [(2001, 2002)]
    overview = gaps.gap_overview(df, spec, lists="text").first()
    assert (overview.missing_years, overview.missing_count, overview.observed_periods,
            overview.series_length, overview.missing_quote) == ("2001, 2002", 2, 3, 4, 0.5)


def test_runs(panel, spec):
    df = panel([("A", 2000 + i, v) for i, v in enumerate([1.0, None, 1.0, None, None, 1.0])])
    assert gaps.missing_ratio_isolated(df, spec).first()[0] == pytest.approx(1 / 6)
    assert tuple(gaps.missing_ratio_sequential(df, spec).first()) == (pytest.approx(2 / 6), "A", 2)


def test_first_group_wins_a_tie_of_longest_runs(panel, spec):
    rows = [(g, 2000 + i, v) for g in "CBA" for i, v in enumerate([1.0, None, None, 1.0])]
    assert gaps.missing_ratio_sequential(panel(rows), spec).first().longest_g == "A"


def test_linear_counts_rows_not_years(panel, spec):
    df = panel([("A", t, v) for t, v in zip((2000, 2001, 2005, 2006, 2010), (None, 1.0, None, 4.0, None))])
    assert [v for (v,) in series(fill.fill_linear(df, spec), "v")] == [1.0, 1.0, 2.5, 4.0, 4.0]


def test_rolling_and_lag(panel, spec):
    df = panel([("A", 2000 + i, v) for i, v in enumerate([1.0, None, 3.0, 4.0])])
    assert series(features.add_rolling_features(df, spec), "roll_mean_3") == [(1.0,), (1.0,), (2.0,), (3.5,)]
    assert series(features.add_lag_features(df, spec), "lag_1", "lag_2") == [
        (None, None), (1.0, None), (None, 1.0), (3.0, None)]


COLUMNS = "g string, t int, v double, s1 string, s2 string"


def test_breaks(panel, spec):
    rows = [("X", y, 1.0, "B" if y == 2001 else None, "B" if y == 2004 else None) for y in range(2000, 2007)]
    assert tuple(status.handle_breaks(panel(rows, COLUMNS), spec).summary.first()) == ("X", 2004, 5)
    cut = status.handle_breaks(panel([*rows, ("Y", 2000, 1.0, " B", "b")], COLUMNS), spec, lists="text")
    assert tuple(cut.summary.first()) == ("X", 2004, "2001, 2004", 5)
    assert cut.total_cut.first().total_cut == 5
    assert sorted((r.g, r.t) for r in cut.panel.collect()) == [("X", 2005), ("X", 2006), ("Y", 2000)]
    assert sorted(r.t for r in status.break_periods_from_summary(cut.summary, spec).collect()) == [2001, 2004]


def test_row_without_period_goes_with_a_break(panel, spec):
    df = panel([("X", 2000, 1.0, "B", None), ("X", None, 2.0, None, None), ("X", 2001, 3.0, None, None),
                ("Y", None, 4.0, None, None), (None, 2000, 5.0, "B", None)], COLUMNS)
    assert {r.v for r in status.cut_at_breaks(df, spec).collect()} == {3.0, 4.0, 5.0}
    assert status.break_summary(df, spec).first().rows_cut == 1


def test_no_breaks_gives_the_same_shape(panel, spec):
    cut = status.handle_breaks(panel([("X", 2000, 1.0, None, None)], COLUMNS), spec)
    assert (cut.panel.count(), cut.summary.count(), cut.total_cut.first().total_cut) == (1, 0, 0)


def test_number_parsing(spark):
    texts = ["2019", "2020-Q1", " 7 ", "1e3", "", "0x10", "1_000", "1d", "2019.0", "2019.5", "nan", "\t8\n", ".5", "+3", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string").select(
        "i", to_number(F.col("x")).alias("n"), to_period(F.col("x")).alias("p")).orderBy("i").collect()
    assert [r.n for r in df] == [2019, None, 7, 1000, None, None, None, None, 2019, 2019.5, None, 8, 0.5, 3, None]
    assert [r.p for r in df] == [2019, None, 7, 1000, None, None, None, None, 2019, None, None, 8, None, 3, None]


def test_text_helpers(spark):
    row = spark.createDataFrame([("\t\u2003 a b\xa0\n", "2001, 2004, x,")], "a string, b string").select(
        strip(F.col("a")).alias("a"), split_periods(F.col("b")).alias("b")).first()
    assert (row.a, row.b) == ("a b", [2001, 2004])


@pytest.mark.parametrize("ratio, target", [(0.1, 1), (0.5, 2), (0.0, 1), (0.3, 2), (1.0, 5), (9.0, 5)])
def test_mask_target(panel, ratio, target):
    lengths = masking.complete_lengths(panel([("A", t, 1.0) for t in range(7)]), SPEC)
    assert tuple(masking.mask_target(lengths, masking.ISOLATED, ratio).first()) == (5, target)


@pytest.mark.parametrize("length, starts", [(6, 0), (7, 3), (8, 4)])
def test_sequential_candidates(panel, length, starts):
    lengths = masking.complete_lengths(panel([("A", t, 1.0) for t in range(length)]), SPEC)
    assert masking.mask_target(lengths, masking.SEQUENTIAL, 0.0).first().candidates == starts


def test_nothing_to_mask(panel, spec):
    df = panel([("A", t, None if t == 3 else 1.0) for t in range(9)])
    assert masking.mask_isolated(df, spec, 0.5).count() == 0
    result = masking.compare_methods(df, spec, 0.5, 0.5, trials=2).first()
    assert tuple(result) == (None, None, None, None, 2)


def test_status_report(panel):
    rows = [("a", " d ", None), ("a", "D", "D"), ("a", "x", None), ("b", None, None), (None, "D", None)]
    df = panel(rows, "code string, s1 string, s2 string")
    report = {r.code: (r.rows_with_D, r.rows_total, r.share_D) for r in status.status_report(df, SPEC, "code").collect()}
    assert report == {"a": (2, 3, pytest.approx(2 / 3)), "b": (0, 1, 0.0)}
    assert tuple(status.status_totals(df, SPEC).first()) == (3, 5, pytest.approx(60.0))


def test_status_report_without_status_columns(panel):
    df = panel([("a",), ("b",)], "code string")
    assert {r.rows_with_D for r in status.status_report(df, SPEC, "code").collect()} == {0}
    assert status.add_status_flag(df, SPEC).first()["Status-Flag"] == 0
    assert status.trigger_counts(df).count() == 0


def test_lowest_code(panel):
    report = panel([("x", 0.0), (" J01 ", 0.1), ("A02", 0.1), ("B", 0.0)], "code string, share_D double")
    assert status.lowest_code(report, "code").first().code == "A02"
    with pytest.raises(Exception, match="no code"):
        status.lowest_code(report.where("share_D < 0.1"), "code").collect()


def test_trigger_counts(panel):
    df = panel([(" P", "E"), ("P", None), ("p", "x"), ("D", "D")], "s1 string, s2 string")
    counts = {r.value: r["count"] for r in status.trigger_counts(df, columns=("s1", "s2", "s3")).collect()}
    assert counts == {"P": 2, "E": 1, "D": 1}
    assert tuple(status.trigger_summary(df, columns=("s1", "s2", "s3")).first()) == (3, 2)


def test_period_flag(panel):
    df = panel([("A", t, 1.0) for t in (2019, 2020, 2021, 2022, None)])
    assert {r.t: r["Corona-Flag"] for r in features.add_period_flag(df, SPEC).collect()} == {
        2019: 0, 2020: 1, 2021: 1, 2022: 0, None: 0}


def test_drop_columns_names_what_is_missing(panel):
    with pytest.raises(ValueError, match="MEASURE"):
        relational.drop_columns(panel([]))
    assert relational.drop_columns(panel([]), ["v"]).columns == ["g", "t"]


def test_one_group(panel):
    df = panel([("A", 1, 1.0), ("B", 2, 2.0)])
    assert charts.one_group(df, SPEC, "B").first().t == 2
    with pytest.raises(Exception, match="no rows"):
        charts.one_group(df, SPEC, "C").collect()


def test_gap_series_with_limits(panel):
    df = panel([("A", 2001, 5.0), ("B", 2003, 7.0)])
    rows = charts.gap_series(df, SPEC).collect()
    assert {(r.g, r.t, r.v) for r in rows} == {
        ("A", 2001, 5.0), ("A", 2002, None), ("A", 2003, None), ("B", 2001, None), ("B", 2002, None), ("B", 2003, 7.0)}
    assert {(r.x_min, r.x_max, r.y_min, r.y_max) for r in rows} == {(2001, 2003, 5.0, 7.0)}
    given = charts.gap_series(df, SPEC, (2002, 2003), (0, 10)).collect()
    assert {(r.t, r.x_min, r.y_max) for r in given} == {(2002, 2002, 10.0), (2003, 2002, 10.0)}


def test_first_rows(panel):
    df = panel([("A", 1, 5.0, 0), ("A", 1, 6.0, 1), ("A", 2, None, 2), ("A", 2, 1.0, 3)],
               "g string, t int, v double, at int")
    assert {(r.t, r.v) for r in relational.first_rows(df, ["g", "t"], ["at"]).collect()} == {(1, 5.0), (2, None)}


def test_expand_codes(panel):
    codes = panel([("A01",), ("A02",), ("B01",), ("C09",)], "id string")
    def expand(*wanted):
        return [r.id for r in relational.expand_codes(codes, wanted).orderBy("position", "id").collect()]
    assert expand("C09", "A") == ["C09", "A01", "A02"]
    assert expand("Z99") == ["Z99"]
    assert expand("Z99", "A") == []
    assert expand("X") == []


def test_coverage(panel):
    df = panel([("A", 2000, 1.0, "B", None), ("A", 2003, 1.0, "D", "B"), ("A", 2003, 2.0, " B", None),
                ("A", None, 1.0, None, None), ("N", None, 1.0, None, None)], COLUMNS)
    got = {r.g: tuple(r)[1:] for r in status.coverage(df, SPEC).collect()}
    assert got == {"A": (2000, 2003, 3, 2, 1, 2), "N": (None, None, 0, 0, 0, 0)}
    lists = {r.g: r.missing_years for r in status.coverage_missing_lists(df, SPEC).collect()}
    assert lists == {"A": [2001, 2002], "N": []}
    assert status.group_count(df, SPEC).first().num_groups == 2
