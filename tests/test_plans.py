"""What the physical plans must and must not have."""

import re

import pytest
from pyspark.sql import functions as F

from paneltide import PanelSpec
from paneltide.operators import charts, complete, features, fill, gaps, masking, relational, status
from paneltide.plans.enrich import enrich
from paneltide.plans.prepare import Settings, prepare_panel
from paneltide.sources import clustered, odata

SPEC = PanelSpec("g", "t", "v", status=("s",))
BOUNDED = SPEC.with_(time_range=(0, 3000))
OPERATORS = {
    "densify": gaps.densify, "runs": gaps.missing_runs, "summary": gaps.gap_summary,
    "isolated": gaps.missing_ratio_isolated, "sequential": gaps.missing_ratio_sequential,
    "trim": gaps.trim_panel, "cuts": gaps.trim_cuts, "linear": fill.fill_linear,
    "features": features.build_features, "breaks": status.cut_at_breaks, "break_summary": status.break_summary,
    "coverage": status.coverage, "position": masking.add_position, "grid": gaps.global_grid,
    "chart": charts.gap_series, "spline": fill.fill_spline,
    "mask": lambda df, spec: masking.mask_isolated(df, spec, 0.1),
}


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "panel")
    spark.createDataFrame([("a", 1, 1.0, "B", "x"), ("a", 3, None, "x", "y")],
                          "g string, t int, v double, s string, other string").write.parquet(path)
    return spark.read.parquet(path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(pattern, plan):
    return len(re.findall(pattern, plan))


@pytest.mark.parametrize("spec", [SPEC, BOUNDED], ids=["blocks", "bounded"])
@pytest.mark.parametrize("name", OPERATORS)
def test_no_plan_gathers_or_multiplies(table, name, spec):
    plan = plan_of(OPERATORS[name](table.drop("other"), spec))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoop"):
        assert bad not in plan
    # A window without a partition would bring all rows into one task.
    for window in re.findall(r"Window(?:GroupLimit)? \[.*", plan):
        assert not re.search(r"\], \[\](,|$)", window) or "RANGE" in window


@pytest.mark.parametrize("name", ["densify", "runs", "linear", "trim", "cuts", "isolated", "position", "features"])
def test_rows_of_long_series_are_shuffled_by_block(table, name):
    """Only block tables, marked by their aggregates, may be shuffled by the group alone."""
    plan = plan_of(OPERATORS[name](table.where("g is not null").drop("other"), SPEC))
    assert re.search(r"hashpartitioning\(g#\d+, _block#\d+", plan)
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"hashpartitioning\(g#\d+, \d+\)", line):
            below = "\n".join(lines[i:i + 6])
            assert "Aggregate" in below, below


@pytest.mark.parametrize("name", ["densify", "runs", "linear", "trim", "cuts", "isolated", "position"])
def test_bounded_series_are_shuffled_once(table, name):
    plan = plan_of(OPERATORS[name](table.drop("other"), BOUNDED))
    assert count("Exchange hash", plan) == 1
    assert "Join" not in plan
    assert count("FileScan", plan) == 1


@pytest.mark.parametrize("spec", [SPEC, BOUNDED], ids=["blocks", "bounded"])
def test_reports_read_their_input_once(table, spec):
    for df in (status.coverage(table, spec), status.break_summary(table, spec)):
        assert count("FileScan", plan_of(df)) == 1


def landed_rows(spark, folder):
    spark.createDataFrame([("I", '{"value":[{"SpatialDim":"a","TimeDim":"1","value":"2"}]}')], "indicator string, value string"
                          ).write.partitionBy("indicator").text(folder)
    return odata.read_responses(spark, folder, one_per_line=True)


def test_rows_of_an_indicator_are_not_sent_to_one_task(spark, tmp_path):
    """Spark sends one side everywhere by itself where it is small; here it may not, as with many responses."""
    rows = odata.parse_responses(landed_rows(spark, str(tmp_path / "landed")), SPEC)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(odata.select_indicators(rows, SPEC, [odata.Indicator("I", "i"), odata.Indicator("J", "j")]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(indicator" not in plan and count("BroadcastHashJoin", plan) == 1


def test_enrichment_reads_the_panel_and_the_responses_once(spark, table, tmp_path):
    (tmp_path / "indicator=I").mkdir()
    (tmp_path / "indicator=I" / "a.json").write_text('{"value":[]}')
    responses = odata.read_responses(spark, str(tmp_path))
    plan = plan_of(enrich(table, responses, SPEC, [odata.Indicator("I", "i")]))
    assert (count("FileScan parquet", plan), count("FileScan text", plan)) == (1, 1)


@pytest.mark.parametrize("spec", [SPEC, BOUNDED], ids=["blocks", "bounded"])
@pytest.mark.parametrize("name", ["breaks", "complete"])
def test_a_hot_group_of_raw_rows_is_dealt_out(spark, name, spec):
    """Two thirds of all rows are one group with few periods; broadcasts are off."""
    rows = spark.range(300_000).selectExpr(
        "case when id % 3 < 2 then 'hot' when id % 1000 = 2 then null else concat('g', id % 4001) end g",
        "cast(2000 + id % 10 as int) t", "cast(id as double) v", "case when id % 3 = 2 and id % 4001 = 5 and id % 10 = 3 then 'B' end s")
    operator = {"breaks": status.cut_at_breaks, "complete": complete.filter_complete_series}[name]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(before, ("16", "-1", "false"), strict=True):
            spark.conf.set(k, v)
        sizes = sorted(r["count"] for r in operator(rows, spec).groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) > 290_000 and len(sizes) == 16 and sizes[-1] <= 3 * sizes[len(sizes) // 2]


def test_bounded_splines_are_one_pass(table):
    plan = plan_of(fill.fill_spline(table.drop("other"), BOUNDED))
    assert (count("Exchange", plan), count("FileScan", plan), count(r"Window \[sum", plan), count("MapInArrow", plan)) == (1, 1, 1, 1)
    assert "Union" not in plan and "FlatMapGroups" not in plan


def test_prepare_is_one_shuffle(table):
    plan = plan_of(prepare_panel(table.drop("other"), BOUNDED, Settings()))
    assert (count("Exchange", plan), count("FileScan", plan), count("Join", plan)) == (1, 1, 0)


def test_prepare_on_a_clustered_table_is_no_shuffle(spark, tmp_path):
    rows = spark.range(3000).selectExpr(
        "concat('g', id % 50) g", "cast(2000 + id div 50 as int) t", "case when id % 9 = 0 then null else cast(id as double) end v",
        "case when id = 777 then 'B' end s", "case when id % 2 = 0 then 'even' else 'odd' end code")
    with pytest.raises(ValueError, match="time range"):
        clustered.write_clustered(rows, "clustered_t", f"{tmp_path}/t", SPEC, 4)
    clustered.write_clustered(rows, "clustered_t", f"{tmp_path}/t", BOUNDED, 4, code="code")
    clustered.replace_codes(rows.where("code = 'odd'").withColumn("v", -F.col("v")), "clustered_t", BOUNDED)
    table = clustered.read_clustered(spark, "clustered_t")
    now = rows.withColumn("v", F.when(F.col("code") == "odd", -F.col("v")).otherwise(F.col("v")))
    assert sorted(map(str, table.select(*rows.columns).collect())) == sorted(map(str, now.collect()))
    assert table.select(F.input_file_name()).distinct().count() == 8
    prepared = prepare_panel(table.drop("code"), BOUNDED, Settings())
    plan = plan_of(prepared)
    assert (count("Exchange", plan), count("FileScan", plan), count("Join", plan)) == (0, 1, 0)
    want = prepare_panel(now.drop("code"), BOUNDED, Settings())
    assert sorted(map(str, prepared.collect())) == sorted(map(str, want.collect()))
    spark.sql("DROP TABLE clustered_t")


def test_lags_and_rolling_means_share_a_window(table):
    plan = plan_of(features.build_features(table.drop("other"), BOUNDED, keep_groupless=False))
    assert (count("Exchange", plan), count(" Sort ", plan)) == (1, 1)


def test_rows_without_a_group_take_part_in_the_same_pass(table):
    plan = plan_of(features.build_features(table, BOUNDED))
    assert (count("FileScan", plan), count("Exchange", plan), count("Union", plan)) == (1, 1, 0)


def test_rows_without_a_group_are_dealt_out(spark):
    """A third of all rows have no group and repeat their periods."""
    rows = spark.range(60_000).selectExpr(
        "case when id % 3 > 0 then concat('g', id div 300) end g", "cast(id % 300 as int) t", "cast(id as double) v", "'x' s", "id")
    for spec in (BOUNDED, SPEC):
        out = features.build_features(rows, spec)
        assert out.columns == ["g", "t", "v", "s", "id", "D-Flag", "Status-Flag", "lag_1", "lag_2", "roll_mean_3"]
        counts = out.agg(F.count("*"), F.count("lag_1"), F.count_if(F.expr("g is null")), F.count_if(F.expr("g is null and roll_mean_3 is not null"))).first()
        assert tuple(counts) == (60_000, 40_000 - 200, 20_000, 0)


def test_scans_read_only_what_is_needed(table):
    plan = plan_of(gaps.missing_runs(table, SPEC))
    assert all(s == "g:string,t:int,v:double" for s in re.findall(r"ReadSchema: struct<(.*?)>", plan))
    plan = plan_of(relational.key_filter(table, s="B", g=["a", "b"]).select("t"))
    assert "EqualTo(s,B)" in plan and "In(g, [a,b])" in plan


def test_last_observations_are_limited_before_the_shuffle(table):
    plan = plan_of(relational.last_observations(table, ["g"], "t", 3))
    assert count("WindowGroupLimit", plan) == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hash")


def test_reports_aggregate_before_the_shuffle(table):
    for df in (status.status_report(table, SPEC, "other"), features.yearly_trend(table, SPEC)):
        plan = plan_of(df)
        assert count("HashAggregate", plan) == 2 and "partial_" in plan


def test_prepare_with_splines_and_blocks_agrees(spark):
    rows = spark.range(400).selectExpr(
        "concat('g', id % 10) g", "cast(2000 + id div 10 as int) t",
        "case when id % 7 = 0 then null else cast(id as double) end v",
        "case when id = 23 then 'B' else 'x' end s").where("id % 11 != 3")
    for method in ("linear", "spline"):
        settings = Settings(threshold=0.05, method=method)
        want = prepare_panel(rows, BOUNDED, settings).drop("fill_path").collect()
        got = prepare_panel(rows, SPEC.with_(block=3), settings).drop("fill_path").collect()
        def key(r):
            return (r.g, r.t)
        assert [key(r) for r in sorted(want, key=key)] == [key(r) for r in sorted(got, key=key)]
        for a, b in zip(sorted(want, key=key), sorted(got, key=key)):
            assert tuple(a) == pytest.approx(tuple(b)) or all(
                x == y or x == pytest.approx(y) for x, y in zip(a, b))


def test_splines_of_any_length_are_one_pass(table):
    """Rows are read and walked once; what crosses a block border comes from tables written before."""
    plan = plan_of(fill.fill_spline(table.drop("other"), SPEC))
    assert (count("FileScan", plan), count("MapInArrow", plan)) == (1, 1)
    assert "CoGroup" not in plan
