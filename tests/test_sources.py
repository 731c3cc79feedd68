"""Messages and files with all the ways in which they can be incomplete."""

import json
import random

import pytest
from pyspark.sql import functions as F

from paneltide import PanelSpec
from paneltide.plans.enrich import enrich, enrichment_report
from paneltide.sources import observations, odata, pieces, sdmx

SPEC = PanelSpec()


def texts(spark, *messages):
    return spark.createDataFrame([(m if isinstance(m, str) else json.dumps(m),) for m in messages], "value string")


def message(series, attributes=None, observation_values=("2000", "2001")):
    def values(*ids):
        return [{"id": i, "name": f"name {i}"} for i in ids]

    return {"data": {
        "dataSets": [{"series": series}, {"series": {"0:0": {"observations": {"0": [99]}}}}],
        "structure": {
            "dimensions": {
                "series": [{"id": "REF_AREA", "values": values("AT", "DE")},
                           {"id": "PHARMACEUTICAL", "values": values("J01")}],
                "observation": [{"id": "TIME_PERIOD", "values": values(*observation_values)}]},
            "attributes": attributes or {},
        }}}


ATTRIBUTES = {
    "series": [{"id": "UNIT", "values": [{"id": "U", "name": " ", "names": {"de": "Einheit", "en": "Unit"}}]},
               {"id": "OBS_STATUS", "values": [{"id": "S", "name": "Series"}]}],
    "observation": [{"id": "OBS_STATUS", "values": [{"id": "A"}, {"id": "B", "names": {"fr": "Rupture"}}]},
                    {"id": "NOTE"}],
}
COLUMNS = ("REF_AREA", "REF_AREA_LABEL", "PHARMACEUTICAL", "TIME_PERIOD", "OBS_VALUE",
           "OBS_STATUS", "OBS_STATUS_LABEL", "NOTE", "UNIT", "UNIT_LABEL")


def parse(spark, *messages, columns=COLUMNS):
    return sdmx.parse_messages(texts(spark, *messages), columns).collect()


def test_series_and_observations(spark):
    rows = parse(spark, message({"1:0": {"attributes": [0], "observations": {"0": [1.5, 1, "x"], "1": [None]}}}, ATTRIBUTES))
    got = {r.TIME_PERIOD: r for r in rows}
    assert got["2000"][:10] == ("DE", "name DE", "J01", "2000", "1.5", "B", "Rupture", "x", "U", "Unit")
    assert got["2001"][:10] == ("DE", "name DE", "J01", "2001", None, None, None, None, "U", "Unit")


def test_observation_attributes_override_those_of_the_series(spark):
    series = {"0:0": {"attributes": [None, 0], "observations": {"0": [1, 0], "1": [2]}}}
    got = {r.TIME_PERIOD: r for r in parse(spark, message(series, ATTRIBUTES))}
    assert (got["2000"].OBS_STATUS, got["2000"].OBS_STATUS_LABEL, got["2000"].UNIT) == ("A", "Series", None)
    assert (got["2001"].OBS_STATUS, got["2001"].OBS_STATUS_LABEL) == ("S", "Series")


def test_index_past_the_values_is_a_raw_attribute(spark):
    got = parse(spark, message({"0:0": {"observations": {"0": [1, 7, 3]}}}, ATTRIBUTES))[0]
    assert (got.OBS_STATUS, got.OBS_STATUS_LABEL, got.NOTE) == ("7", None, "3")


def test_what_does_not_fit_is_left_out(spark):
    series = {
        "0": {"observations": {"0": [1]}},
        "0:0:0": {"observations": {"0": [1]}},
        "9:0": {"observations": {"0": [2], "5": [3]}},
        "1:0": {"attributes": [0]},
    }
    rows = parse(spark, message(series))
    assert [(r.REF_AREA, r.PHARMACEUTICAL, r.TIME_PERIOD, r.OBS_VALUE) for r in rows] == [(None, "J01", "2000", "2")]


@pytest.mark.parametrize("empty", [
    "", "null", "{}", "not json", {"data": None}, {"data": {"dataSets": [], "structure": {}}},
    {"data": {"dataSets": [{"series": {"0": {"observations": {"0": [1]}}}}], "structure": {}}},
    {"data": {"dataSets": [{}], "structure": {"dimensions": {"series": [], "observation": []}}}},
])
def test_messages_without_data(spark, empty):
    assert parse(spark, empty) == []
    assert len(parse(spark, empty, message({"0:0": {"observations": {"0": [1]}}}))) == 1


def test_other_attributes_stay_in_a_map(spark):
    series = {"0:0": {"attributes": [0], "observations": {"0": [1, 0, "n"]}}}
    row = parse(spark, message(series, ATTRIBUTES), columns=("REF_AREA", "TIME_PERIOD", "OBS_VALUE"))[0]
    assert row.attributes == {"REF_AREA_LABEL": "name AT", "PHARMACEUTICAL": "J01", "UNIT": "U",
                              "PHARMACEUTICAL_LABEL": "name J01", "UNIT_LABEL": "Unit", "OBS_STATUS": "A", "NOTE": "n"}


def test_load_observations(spark):
    messages = texts(spark, message({"0:0": {"observations": {"0": [1], "1": [2]}}, "1:0": {"observations": {"1": ["x"]}}}))
    rows = sdmx.load_observations(messages, SPEC, codes=["J01"], last_n=1).collect()
    assert {(r.REF_AREA, r.TIME_PERIOD, r.OBS_VALUE) for r in rows} == {("AT", 2001, 2.0), ("DE", 2001, None)}
    codes = spark.createDataFrame([("J01",), ("A01",)], "id string")
    assert sdmx.load_observations(messages, SPEC, codes=["J"], codelist=codes).count() == 3
    assert sdmx.load_observations(messages, SPEC, codes=["A"], codelist=codes).count() == 0
    assert sdmx.load_observations(messages, SPEC, codes=["X99", "J"], codelist=codes).count() == 0


@pytest.mark.parametrize("wrap", [lambda m: {"data": m}, lambda m: m])
def test_codelist(spark, wrap):
    lists = [{"id": "CL_PHARMACEUTICAL", "codes": [{"id": " J01 "}, {"id": "J01"}, {"id": " "}, {"id": ""}, {"Id": "A"}, {}]},
             {"id": "CL_PHARMACEUTICAL", "codes": [], "items": [{"id": "B"}]}, {"id": "OTHER", "codes": [{"id": "no"}]}]
    got = sdmx.parse_codelist(texts(spark, wrap({"codelists": lists}))).collect()
    assert sorted(r.id for r in got) == ["A", "B", "J01"]
    assert sdmx.parse_codelist(texts(spark, "{}", "[]", "x")).count() == 0


def test_messages_in_files(spark, tmp_path):
    text = json.dumps(message({"0:0": {"observations": {"0": [1]}}}), indent=2)
    for name in ("a.json", "b.json"):
        (tmp_path / name).write_text(text)
    assert sdmx.parse_messages(sdmx.read_messages(spark, str(tmp_path))).count() == 2


def test_csv(spark, tmp_path):
    (tmp_path / "o.csv").write_text(
        'PHARMACEUTICAL,REF_AREA,TIME_PERIOD,OBS_VALUE,NOTE\nJ01,NA,2000,1.5,"a ""b"", c"\nJ02,DE,2000-Q1,x,\n'
        "J03,None,2001.0,nan,n/a\n")
    rows = observations.read_csv(spark, str(tmp_path / "o.csv"), SPEC).orderBy("PHARMACEUTICAL").collect()
    assert [tuple(r) for r in rows] == [
        ("J01", None, 2000, 1.5, 'a "b", c'), ("J02", "DE", None, None, None), ("J03", None, 2001, None, None)]
    keys = observations.read_group_periods(spark, str(tmp_path / "o.csv"), SPEC).collect()
    assert keys == []
    copy = str(tmp_path / "copy")
    observations.write_csv(spark.createDataFrame(rows), copy, ["PHARMACEUTICAL"])
    again = observations.read_csv(spark, copy, SPEC, columns=["PHARMACEUTICAL", "REF_AREA", "TIME_PERIOD", "OBS_VALUE", "NOTE"])
    assert again.orderBy("PHARMACEUTICAL").collect() == rows
    with pytest.raises(Exception, match="already exists"):
        observations.write_csv(spark.createDataFrame(rows), copy)
    observations.write_csv(spark.createDataFrame(rows), copy, overwrite=True)


def test_table_is_pruned_by_code(spark, tmp_path):
    df = spark.createDataFrame([("J01", "AT", 2000, 1.0), ("J02", "AT", 2000, 2.0)],
                               "PHARMACEUTICAL string, REF_AREA string, TIME_PERIOD int, OBS_VALUE double")
    observations.write_table(df, str(tmp_path / "t"))
    nan = df.withColumn("OBS_VALUE", F.lit(float("nan")))
    observations.write_table(nan, str(tmp_path / "n"))
    assert {r.OBS_VALUE for r in observations.read_table(spark, str(tmp_path / "n"), SPEC).collect()} == {None}
    part = observations.read_table(spark, str(tmp_path / "t")).where("PHARMACEUTICAL = 'J02'")
    assert part.first().OBS_VALUE == 2.0
    assert len(part.inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(PHARMACEUTICAL" in part._jdf.queryExecution().toString()


INDICATORS = (odata.Indicator("I1", "one"), odata.Indicator("I2", "two", "KEEP"), odata.Indicator("I3", "three"))


def responses(spark, *rows):
    return spark.createDataFrame(
        [(code, f"f{i}", json.dumps({"value": items})) for i, (code, items) in enumerate(rows)],
        "indicator string, source string, value string")


def item(area, year, **fields):
    return {"SpatialDim": area, "TimeDim": year, **fields}


def test_enrich(spark):
    found = responses(
        spark,
        ("I1", [item("AT", 2000, NumericValue=5), item("AT", 2000, NumericValue=6), item("DE", 2000, NumericValue=7)]),
        ("I1", [item("AT", 2000, NumericValue=8)]),
        ("I2", [item("AT", 2000, Dim1="DROP", NumericValue=1), item("AT", 2000, Dim1="KEEP", NumericValue=2.5)]),
        ("I2", [item("DE", 2000, NumericValue=3)]),
        ("I3", []), ("XX", [item("AT", 2000, NumericValue=1)]))
    panel = spark.createDataFrame([("AT", 2000), ("AT", 2000), ("AT", 2002), (None, 2000)], "REF_AREA string, TIME_PERIOD int")
    result = enrich(panel, found, SPEC, INDICATORS)
    assert result.columns == ["REF_AREA", "TIME_PERIOD", "one", "two", "three"]
    assert {tuple(r) for r in result.collect()} == {("AT", 2000, 5.0, 2.5, None), ("AT", 2002, None, None, None)}
    assert tuple(enrichment_report(result, INDICATORS).first()) == (2, 2)


def test_value_field_is_chosen_per_response(spark):
    found = responses(
        spark, ("I1", [item("AT", 2000, numericValue=None, NumericValue=1, value="2"), item("DE", 2000, NumericValue=3)]),
        ("I1", [item("FR", 2000, value="4"), item("IT", "x", value="n")]))
    got = {r.REF_AREA: (r.TIME_PERIOD, r.OBS_VALUE) for r in odata.parse_responses(found, SPEC).collect()}
    assert got == {"AT": (2000, None), "DE": (2000, None), "FR": (2000, 4.0), "IT": (None, None)}
    with pytest.raises(Exception, match="no value field"):
        odata.parse_responses(responses(spark, ("I1", [item("AT", 2000)])), SPEC).collect()
    assert odata.parse_responses(responses(spark, ("I1", [])), SPEC).count() == 0


def test_tidy_indicator(spark):
    df = spark.createDataFrame([("AT", 2000, 6.0, 9.0, 2), ("AT", 2000, 5.0, 9.0, 1)],
                               "SpatialDim string, TimeDim int, NumericValue double, value double, at int")
    assert [tuple(r) for r in odata.tidy_indicator(df, SPEC, "at").collect()] == [("AT", 2000, 5.0)]
    both = spark.createDataFrame([(2000, "AT", 1.0, 2.0, 0)], ["TimeDim", "SpatialDim", "NumericValue", "numericValue", "at"])
    assert tuple(odata.tidy_indicator(both, SPEC, "at").first()) == ("AT", 2000, 2.0)
    with pytest.raises(ValueError, match="numericValue"):
        odata.tidy_indicator(df.select("SpatialDim", "TimeDim", "at"), SPEC, "at")


@pytest.mark.parametrize("partitions", ["1", "64"])
@pytest.mark.parametrize("bytes_per_task", ["1k", "128m"])
def test_first_line_of_a_file_wins(spark, tmp_path, partitions, bytes_per_task):
    folder = tmp_path / "indicator=I1"
    folder.mkdir()
    lines = [json.dumps({"value": [item("AT", 2000, NumericValue=n), item("DE", n % 7, NumericValue=n)]}) for n in range(300)]
    (folder / "a.json").write_text("\n".join(lines))
    (folder / "b.json").write_text(json.dumps({"value": [item("AT", 2000, NumericValue=-1), item("FR", 1, NumericValue=5)]}))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_per_task)
        rows = odata.parse_responses(odata.read_responses(spark, str(tmp_path), one_per_line=True), SPEC)
        found = odata.select_indicators(rows, SPEC, [odata.Indicator("I1", "x")]).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = {(r[SPEC.groups[0]], r[SPEC.time]): r[SPEC.value] for r in found}
    assert got == {("AT", 2000): 0.0, ("FR", 1): 5.0, **{("DE", n): float(n) for n in range(7)}}


def test_responses_in_folders(spark, tmp_path):
    folder = tmp_path / "indicator=I1"
    folder.mkdir()
    (folder / "AT.json").write_text(json.dumps({"value": [item("AT", 2000, NumericValue=5)]}, indent=1))
    read = odata.read_responses(spark, str(tmp_path))
    assert odata.parse_responses(read, SPEC).select("indicator", "REF_AREA", F.col("OBS_VALUE")).first() == ("I1", "AT", 5.0)


def test_only_requested_folders_are_read(spark, tmp_path):
    for code in ("A01", "B02"):
        (tmp_path / f"code={code}").mkdir()
        (tmp_path / f"code={code}" / "m.json").write_text("{}")
    messages = sdmx.read_messages(spark, str(tmp_path))
    for codes, codelist in ((["A01"], None), (["A"], spark.createDataFrame([("A01",)], "id string"))):
        rows = sdmx.load_observations(messages, PanelSpec(), codes=codes, codelist=codelist, folder="code", last_n=None)
        assert "PartitionFilters: [" in (plan := rows._jdf.queryExecution().executedPlan().toString())
        assert "code#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_only_needed_files_are_read(spark, tmp_path):
    from paneltide import PanelSpec
    from paneltide.sources import landed, odata

    spec = PanelSpec("g", "t", "v")

    def land(code, name, items):
        folder = tmp_path / "landed" / f"indicator={code}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}.json").write_text(json.dumps({"value": [
            {"SpatialDim": g, "TimeDim": t, "NumericValue": v} for g, t, v in items]}))

    for n in range(12):
        land(f"I{n % 3}", f"file {n}", [(f"G{n}", 2000 + k, n + k) for k in range(5)] + [(None, 2000, 1)])
    land("I0", "empty", [])
    land("I0", "undated", [("G1", None, 3)])
    path = str(tmp_path / "landed")

    def parsed(files=None):
        return odata.parse_responses(odata.read_responses(spark, path, files=files), spec)

    def names(df):
        return sorted(r.path.rsplit("/", 1)[1] for r in df.collect())

    landed.index_files(landed.list_files(spark, path), parsed(), spec).write.parquet(f"{tmp_path}/index")
    index = spark.read.parquet(f"{tmp_path}/index")
    wanted = spark.createDataFrame([("G1", 2001), ("G1", 2002), ("G5", 2004), ("G7", 1990), ("G9", None)], "g string, t int")
    needed = landed.needed_files(landed.list_files(spark, path), index, wanted, spec)
    # G9 has no period, so nothing can be told apart from it.
    assert names(needed) == ["file 1.json", "file 5.json", "file 9.json", "undated.json"]
    assert landed.list_files(spark, path).count() - needed.count() == 10
    read = parsed(needed)
    assert read.select("source").distinct().count() == 4
    assert sorted(read.where("g = 'G5'").select("indicator", "g", "t", "v").collect()) == [("I2", "G5", 2000 + k, 5.0 + k) for k in range(5)]
    # Files that are new or have changed are read whatever the index says.
    land("I1", "new", [("G2", 2000, 1)])
    land("I2", "file 8", [("G1", 2001, 1), ("G1", 2002, 1)])
    needed = landed.needed_files(landed.list_files(spark, path), index, wanted, spec)
    assert names(needed) == ["file 1.json", "file 5.json", "file 8.json", "file 9.json", "new.json", "undated.json"]
    nothing = landed.needed_files(landed.list_files(spark, path), landed.index_files(landed.list_files(spark, path), parsed(), spec), wanted.limit(0), spec)
    assert nothing.count() == 0 and parsed(nothing).count() == 0


def _long_message(rng, layout):
    """A message of many series, with texts that look like its own syntax, and a second data set."""
    odd = ['}},"0:1":{"observations":{"0":[9', '\\"}}', "}}", ',"1:1":{"a":{', "{[", "x"]
    areas = [{"id": f"A{i}", "name": rng.choice([*odd, None]), "names": {"en": rng.choice(odd)}} for i in range(40)]
    codes = [{"id": f"J{i}", "name": rng.choice(odd)} for i in range(30)]

    def series(n):
        found = {}
        for _ in range(n):
            cells = {str(p): [rng.choice([1.5, None, "x"]), rng.randrange(3), rng.choice([None, *odd])] for p in rng.sample(range(6), 4)}
            entry = {"attributes": [rng.choice([0, 1, "}}", None])], "observations": cells}
            if layout == "swapped" or (layout == "mixed" and rng.random() < 0.2):
                entry = dict(reversed(entry.items()))
            elif rng.random() < 0.05:
                entry = rng.choice([{"observations": {}}, {}, {"attributes": [0]}])
            found[f"{rng.randrange(45)}:{rng.randrange(30)}"] = entry
        return found

    structure = {
        "dimensions": {
            "series": [{"id": "REF_AREA", "values": areas}, {"id": "PHARMACEUTICAL", "values": codes}],
            "observation": [{"id": "TIME_PERIOD", "values": [{"id": str(2000 + i)} for i in range(5)]}]},
        "attributes": ATTRIBUTES}
    sets = [{"action": "}}", "series": series(300)}, {"series": series(40)}]
    return {"data": {"structure": structure, "dataSets": sets} if rng.random() < 0.5 else {"dataSets": sets, "structure": structure}}


@pytest.mark.parametrize("layout", ["plain", "mixed", "swapped", "blanks"])
def test_pieces_of_long_messages(spark, tmp_path, layout):
    rng = random.Random(layout)
    for i in range(3):
        separators = (", ", " : ") if layout == "blanks" else (",", ":")
        (tmp_path / f"m{i}.json").write_text(json.dumps(_long_message(rng, layout), separators=separators, ensure_ascii=i > 0))
    for i, text in enumerate(["", "{}", "not json }} at all }}", '{"data":{"dataSets":[{"series":{"0:0":{"observations":{}}']):
        (tmp_path / f"n{i}.json").write_text(text)
    want = sdmx.parse_messages(sdmx.read_messages(spark, str(tmp_path)), COLUMNS)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")  # a series may lie in several tasks
    try:
        read = pieces.read_pieces(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 20
        got = sdmx.parse_pieces(read, COLUMNS)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)

    def plain(rows):
        return sorted(repr((tuple(r)[:-1], sorted(r.attributes.items()))) for r in rows.collect())

    found = plain(got)
    assert found == plain(want) and len(found) > 1000
    longest = read.agg(F.max(F.length("value"))).first()[0]
    assert layout != "plain" or longest < 20_000


def test_series_end_with_two_braces(spark):
    with pytest.raises(ValueError, match="two braces"):
        pieces.read_pieces(spark, "/nowhere", "}")


def test_pieces_with_blanks_between_the_braces(spark, tmp_path):
    series = {f"{i % 2}:0": {"observations": {"0": [i], "1": [i]}} for i in range(2)}
    (tmp_path / "m.json").write_text(json.dumps(message(series, ATTRIBUTES), indent=0))
    want = sdmx.parse_messages(sdmx.read_messages(spark, str(tmp_path)), COLUMNS).collect()
    read = pieces.read_pieces(spark, str(tmp_path), "}\n}")
    assert read.count() > 3
    got = sdmx.parse_pieces(read, COLUMNS, "}\n}").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) == 4


def test_index_of_landed_messages(spark, tmp_path):
    from paneltide.sources import landed

    spec = PanelSpec(group=("PHARMACEUTICAL", "REF_AREA"))
    path = str(tmp_path / "landed")
    (tmp_path / "landed").mkdir()
    for n in range(8):
        series = {f"{n % 2}:0": {"observations": {"0": [n], "1": [n]}}}
        (tmp_path / "landed" / f"m{n}.json").write_text(
            json.dumps(message(series, observation_values=(str(2000 + 2 * n), str(2001 + 2 * n))), separators=(",", ":")))
    (tmp_path / "landed" / "none.json").write_text("{}")
    columns = (*spec.keys, spec.value)

    def rows(files=None):
        return observations.typed(sdmx.parse_messages(
            landed.with_source(sdmx.read_messages(spark, path, files=files)), columns, keep=["source"]), spec)

    in_pieces = observations.typed(sdmx.parse_pieces(pieces.read_pieces(spark, path), columns, source="source"), spec)
    assert sorted(in_pieces.drop("attributes").collect()) == sorted(rows().drop("attributes").collect())
    files = landed.list_files(spark, path)
    index = landed.index_files(files, rows(), spec)
    wanted = spark.createDataFrame([("J01", "AT", 2004), ("J01", "AT", 2009), ("J01", "DE", 1990)], "PHARMACEUTICAL string, REF_AREA string, TIME_PERIOD int")
    needed = landed.needed_files(files, index, wanted, spec)
    assert sorted(r.path.rsplit("/", 1)[1] for r in needed.collect()) == ["m2.json", "m4.json"]
    assert {(r.REF_AREA, r.TIME_PERIOD) for r in rows(needed).collect()} == {("AT", 2004), ("AT", 2005), ("AT", 2008), ("AT", 2009)}
    assert pieces.read_pieces(spark, path, files=needed.limit(0)).count() == 0
