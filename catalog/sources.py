"""Queries over messages and files that Spark writes from the given tables and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.panels import (
    SPEC, YEARLY, month_of, table, yearly,
)
from catalog.registry import ORACLES, query
from paneltide import PanelSpec
from paneltide.functions.intervals import period_runs
from paneltide.functions.materialize import new_folder
from paneltide.operators import relational
from paneltide.plans.enrich import enrich, enrichment_report
from paneltide.sources import landed, observations, odata, pieces, sdmx

OBSERVATIONS = PanelSpec()


# --- CSV and Parquet files -------------------------------------------------------------

def _csv(spark, sf_dir):
    """The yearly panel as CSV, with some cells that are no numbers."""
    folder = new_folder(spark, "observations-csv")
    broken = yearly(spark, sf_dir).select(
        F.col("g").cast("string").alias("PHARMACEUTICAL"),
        F.when(F.col("g") % 5 == 0, "NA").otherwise(F.concat(F.lit("C"), F.col("g") % 7)).alias("REF_AREA"),
        F.when(F.col("t") == 1996, F.concat(F.col("t"), F.lit("-Q1")))
        .otherwise(F.concat(F.lit(" "), F.col("t"), F.lit(" "))).alias("TIME_PERIOD"),
        F.when(F.col("t") == 1997, "0x10").when(F.col("t") == 1998, "1_000")
        .otherwise(F.format_string("%.2f", "v")).alias("OBS_VALUE"))
    observations.write_csv(broken, folder)
    return folder


READ_BACK = f"""WITH {YEARLY} SELECT CAST(g AS VARCHAR) AS "PHARMACEUTICAL",
  CASE WHEN g % 5 = 0 THEN NULL ELSE 'C' || (g % 7) END AS "REF_AREA",
  CASE WHEN t = 1996 THEN NULL ELSE t END AS "TIME_PERIOD",
  CASE WHEN t IN (1997, 1998) THEN NULL ELSE v END AS "OBS_VALUE" FROM p"""


@query("s1_s10_read_csv", READ_BACK)
def _(spark, sf_dir):
    return observations.read_csv(spark, _csv(spark, sf_dir), OBSERVATIONS)


@query("s9_group_periods", f"""WITH {YEARLY} SELECT DISTINCT 'C' || (g % 7) AS "REF_AREA", t AS "TIME_PERIOD" FROM p
WHERE g % 5 <> 0 AND t <> 1996""")
def _(spark, sf_dir):
    return observations.read_group_periods(spark, _csv(spark, sf_dir), OBSERVATIONS)


@query("s10_partitioned_table", f"WITH {YEARLY} SELECT g, t, v FROM p WHERE t IN (1996, 1999)")
def _(spark, sf_dir):
    folder = new_folder(spark, "observations-table")
    observations.write_table(yearly(spark, sf_dir), folder, "t")
    return relational.key_filter(observations.read_table(spark, folder), t=[1996, 1999]).select("g", "t", "v")


# --- SDMX-JSON: one message per nation, a series per market segment, monthly values -----

SDMX_PANEL = """p AS (SELECT n_name AS "PHARMACEUTICAL", c_mktsegment AS "REF_AREA",
  CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INTEGER) AS "TIME_PERIOD",
  round(sum(o_totalprice), 2) AS "OBS_VALUE", count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3)"""
SDMX_COLUMNS = ("PHARMACEUTICAL", "PHARMACEUTICAL_LABEL", "REF_AREA", "REF_AREA_LABEL", "TIME_PERIOD",
                "OBS_VALUE", "OBS_STATUS", "OBS_STATUS_LABEL", "OBS_NOTE", "UNIT_MULT", "UNIT_MULT_LABEL")
# Fixed by the tables: the market segments, which are the values of a dimension.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _messages(spark, sf_dir):
    """Messages as text: (code, value).  The nations and months bound their number and size."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    months = orders.agg(
        F.min(month_of("o_orderdate")).alias("a"), F.max(month_of("o_orderdate")).alias("b"))
    first_month = months.select("a").scalar()
    times = months.select(F.concat_ws(",", F.transform(
        F.sequence("a", "b"), lambda m: F.concat(F.lit('{"id":"'), m, F.lit('"}'))))).scalar()
    cells = (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .join(nations, customers.c_nationkey == nations.n_nationkey)
        .groupBy("n_name", "c_mktsegment", month_of("o_orderdate").alias("month"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("v"), F.count("*").alias("n"))
    )
    # Value, status as an index, and a raw note that is sometimes absent.
    cell = F.concat(
        F.lit('"'), F.col("month") - first_month, F.lit('":['), F.col("v").cast("string"), F.lit(","),
        F.col("n") % 3, F.when(F.col("n") % 2 == 0, F.concat(F.lit(',"n'), F.col("n"), F.lit('"]'))).otherwise(",null]"))
    segment = F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("c_mktsegment")) - 1
    series = (
        cells.groupBy("n_name", segment.alias("segment"))
        .agg(F.concat_ws(",", F.sort_array(F.collect_list(cell))).alias("cells"))
        .withColumn("series", F.concat(
            F.lit('"'), F.col("segment"), F.lit(':0":{"attributes":[0],"observations":{'), F.col("cells"), F.lit("}}")))
    )
    segments = ",".join(f'{{"id":"{s}","name":" ","names":{{"de":"de {s}","en":"Segment {s}"}}}}' for s in SEGMENTS)
    return series.groupBy("n_name").agg(
        F.concat_ws(",", F.sort_array(F.collect_list("series"))).alias("all")
    ).select(F.col("n_name").alias("code"), F.concat(
        F.lit('{"data":{"dataSets":[{"series":{"0":{"observations":{"0":[1]}},"9:0":{"observations":{}},'),
        F.col("all"), F.lit('}}],"structure":{"dimensions":{"series":[{"id":"REF_AREA","values":[' + segments
                            + ']},{"id":"PHARMACEUTICAL","values":[{"id":"'),
        F.col("n_name"), F.lit('","name":"Nation"}]}],"observation":[{"id":"TIME_PERIOD","values":['), times,
        F.lit(']}]},"attributes":{"series":[{"id":"UNIT_MULT","values":[{"id":"0","name":"Units"}]}],'
              '"observation":[{"id":"OBS_STATUS","values":[{"id":"A","name":"Normal"},'
              '{"id":"P","names":{"fr":"Provisoire"}}]},{"id":"OBS_NOTE"}]}}}}'),
    ).alias("value"))


def _land(spark, sf_dir):
    """Messages written one per file, as a collector lands them, in folders by code."""
    folder = new_folder(spark, "messages")
    _messages(spark, sf_dir).repartition("code").write.partitionBy("code").text(folder)
    return folder


def _landed(spark, sf_dir):
    return sdmx.read_messages(spark, _land(spark, sf_dir))


SDMX_ROWS = f"""WITH {SDMX_PANEL} SELECT "PHARMACEUTICAL", 'Nation' AS "PHARMACEUTICAL_LABEL",
  "REF_AREA", 'Segment ' || "REF_AREA" AS "REF_AREA_LABEL", "TIME_PERIOD", "OBS_VALUE",
  CASE n % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'P' ELSE '2' END AS "OBS_STATUS",
  CASE n % 3 WHEN 0 THEN 'Normal' WHEN 1 THEN 'Provisoire' END AS "OBS_STATUS_LABEL",
  CASE WHEN n % 2 = 0 THEN 'n' || n END AS "OBS_NOTE", '0' AS "UNIT_MULT", 'Units' AS "UNIT_MULT_LABEL" FROM p"""


@query("s2_s4_sdmx_messages", SDMX_ROWS)
def _(spark, sf_dir):
    rows = observations.typed(sdmx.parse_messages(_landed(spark, sf_dir), SDMX_COLUMNS), OBSERVATIONS)
    return rows.drop("attributes")


@query("s2_sdmx_pieces", SDMX_ROWS)
def _(spark, sf_dir):
    read = pieces.read_pieces(spark, _land(spark, sf_dir))
    return observations.typed(sdmx.parse_pieces(read, SDMX_COLUMNS), OBSERVATIONS).drop("attributes")


@query("s2_repeated_names", SDMX_ROWS.replace("CASE n % 3 WHEN 0 THEN 'Normal'", "CASE WHEN n % 2 = 0 THEN 'n' || n WHEN n % 3 = 0 THEN 'Normal'")
       .replace("WHEN 1 THEN 'Provisoire' END", "WHEN n % 3 = 1 THEN 'Provisoire' END")
       .replace("""CASE WHEN n % 2 = 0 THEN 'n' || n END AS "OBS_NOTE", """, ""))
def _(spark, sf_dir):
    """The note is named like the label of the status, and comes after it."""
    renamed = _landed(spark, sf_dir).withColumn(
        "value", F.replace("value", F.lit('{"id":"OBS_NOTE"}'), F.lit('{"id":"OBS_STATUS_LABEL"}')))
    columns = [c for c in SDMX_COLUMNS if c != "OBS_NOTE"]
    return observations.typed(sdmx.parse_messages(renamed, columns), OBSERVATIONS).drop("attributes")


@query("f9_other_attributes", f"""WITH {SDMX_PANEL} SELECT "PHARMACEUTICAL", "REF_AREA", "TIME_PERIOD",
  CASE n % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'P' ELSE '2' END AS status, '0' AS unit,
  CAST(CASE WHEN n % 2 = 0 THEN 7 ELSE 6 END - CASE WHEN n % 3 = 2 THEN 1 ELSE 0 END AS INTEGER) AS n_others FROM p""")
def _(spark, sf_dir):
    rows = sdmx.parse_messages(_landed(spark, sf_dir), ("PHARMACEUTICAL", "REF_AREA", "TIME_PERIOD", "OBS_VALUE"))
    others = F.col("attributes")
    return observations.typed(rows, OBSERVATIONS).select(
        "PHARMACEUTICAL", "REF_AREA", "TIME_PERIOD", others["OBS_STATUS"].alias("status"),
        others["UNIT_MULT"].alias("unit"), F.size(others).alias("n_others"))


@query("s4_s5_load_observations", f"""WITH {SDMX_PANEL} SELECT "PHARMACEUTICAL", "REF_AREA", "TIME_PERIOD", "OBS_VALUE" FROM p
WHERE "PHARMACEUTICAL" IN ('NATION_3', 'NATION_11') QUALIFY row_number() OVER (
  PARTITION BY "PHARMACEUTICAL", "REF_AREA" ORDER BY "TIME_PERIOD" DESC) <= 24""")
def _(spark, sf_dir):
    return sdmx.load_observations(
        _landed(spark, sf_dir), OBSERVATIONS, SDMX_COLUMNS, codes=["NATION_3", "NATION_11"],
        series=["PHARMACEUTICAL", "REF_AREA"], last_n=24, folder="code",
    ).select("PHARMACEUTICAL", "REF_AREA", "TIME_PERIOD", "OBS_VALUE")


@query("s4_load_pieces", ORACLES["s4_s5_load_observations"])
def _(spark, sf_dir):
    return sdmx.load_observations(
        pieces.read_pieces(spark, _land(spark, sf_dir)), OBSERVATIONS, SDMX_COLUMNS, codes=["NATION_3", "NATION_11"],
        series=["PHARMACEUTICAL", "REF_AREA"], last_n=24, folder="code", end=pieces.END,
    ).select("PHARMACEUTICAL", "REF_AREA", "TIME_PERIOD", "OBS_VALUE")


@query("s4_needed_files", f"""WITH {SDMX_PANEL}, k AS (SELECT "PHARMACEUTICAL", "REF_AREA", min("TIME_PERIOD") AS a, max("TIME_PERIOD") AS b
  FROM p WHERE n >= 3 AND "PHARMACEUTICAL" LIKE '%1' GROUP BY 1, 2)
SELECT p."PHARMACEUTICAL", p."REF_AREA", "TIME_PERIOD", "OBS_VALUE" FROM p JOIN k USING ("PHARMACEUTICAL", "REF_AREA")
WHERE "TIME_PERIOD" BETWEEN a AND b""")
def _(spark, sf_dir):
    """Of landed messages those that can have the wanted series and periods, by an index of what they have."""
    spec = PanelSpec(group=("PHARMACEUTICAL", "REF_AREA"))
    columns = (*spec.keys, spec.value)
    folder = _land(spark, sf_dir)
    files = landed.list_files(spark, folder)
    texts = landed.with_source(sdmx.read_messages(spark, folder))
    rows = observations.typed(sdmx.parse_messages(texts, columns, keep=["source"]), spec)
    index = landed.index_files(files, rows, spec)
    cells = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(
        table(spark, sf_dir, "nation").where("n_name LIKE '%1'"), F.col("c_nationkey") == F.col("n_nationkey"))
    wanted = cells.groupBy(
        F.col("n_name").alias("PHARMACEUTICAL"), F.col("c_mktsegment").alias("REF_AREA"), month_of("o_orderdate").alias("TIME_PERIOD")
    ).agg(F.count("*").alias("n")).where("n >= 3").drop("n")
    needed = landed.needed_files(files, index, wanted, spec)
    found = observations.typed(sdmx.parse_pieces(pieces.read_pieces(spark, folder, files=needed), columns), spec)
    spans = wanted.groupBy(*spec.groups).agg(F.min(spec.time).alias("a"), F.max(spec.time).alias("b"))
    return found.join(spans, spec.groups).where(F.col(spec.time).between(F.col("a"), F.col("b"))).select(*columns)


def _codelist(spark, sf_dir):
    """Code lists as messages, one per brand and split of its parts: other lists, padded,
    blank and repeated ids, and other field names."""
    parts = table(spark, sf_dir, "part").select(
        "p_brand", (F.col("p_partkey") % 2).alias("half"),
        F.concat("p_type", F.lit("/"), F.col("p_size")).alias("id"))
    names = [("codelists", "codes", "id"), ("Codelists", "Items", "Id")]
    message = F.lit(None).cast("string")
    for half, (lists, items, name) in enumerate(names):
        code = F.concat(F.lit(f'{{"{name}":" '), F.col("id"), F.lit('\\t"}'))
        text = F.concat(
            F.lit(f'{{"{lists}":[{{"id":"CL_OTHER","{items}":[{{"{name}":"x"}}]}},'
                  f'{{"id":"CL_PHARMACEUTICAL","{items}":[{{"{name}":"  "}},'),
            F.concat_ws(",", F.collect_set(code)), F.lit("]}]}"))
        message = F.when(F.col("half") == half, text).otherwise(message)
    texts = parts.groupBy("p_brand", "half").agg(message.alias("value")).select(
        F.when(F.col("half") == 0, F.concat(F.lit('{"data":'), F.col("value"), F.lit("}")))
        .otherwise(F.col("value")).alias("value"))
    folder = new_folder(spark, "codelists")
    texts.write.text(folder)
    return sdmx.read_messages(spark, folder, one_per_line=True)


@query("s3_codelist", "SELECT DISTINCT p_type || '/' || p_size AS id FROM part")
def _(spark, sf_dir):
    return sdmx.parse_codelist(_codelist(spark, sf_dir))


# --- OData-JSON: responses per block of customers ---------------------------------------

KEYED = SPEC
INDICATORS = (
    odata.Indicator("SPEND", "spend_urgent", "1-URGENT"),
    odata.Indicator("ORDERS", "orders_first"),
    odata.Indicator("ABSENT", "absent"),
)
BY_PRIORITY = """x AS (SELECT CAST(o_custkey AS VARCHAR) AS g, CAST(year(o_orderdate) AS INTEGER) AS t,
  o_orderpriority AS dim1, round(sum(o_totalprice), 2) AS spend, CAST(count(*) AS DOUBLE) AS n,
  min(o_custkey) AS k FROM orders GROUP BY 1, 2, 3)"""


def _landed_responses(spark, sf_dir):
    """Responses for blocks of 500 customers, so that their size does not grow with the data."""
    rows = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("t"), "o_orderpriority")
        .agg(F.round(F.sum("o_totalprice"), 2).alias("spend"), F.count("*").cast("double").alias("n"))
        .withColumn("part", F.expr("o_custkey div 500"))
    )
    key = [F.col("o_custkey").cast("string").alias("SpatialDim"), F.col("t").alias("TimeDim"),
           F.col("o_orderpriority").alias("Dim1")]

    def message(code, rows, value):
        item = F.struct(*key, value)
        return rows.groupBy("part").agg(F.sort_array(F.collect_list(item)).alias("value")).select(
            F.lit(code).alias("indicator"), F.to_json(F.struct("value")).alias("value"))

    texts = message("SPEND", rows, F.col("spend").alias("NumericValue")).union(
        message("ORDERS", rows, F.col("n").alias("numericValue")))
    folder = new_folder(spark, "responses")
    texts.write.partitionBy("indicator").text(folder)
    return folder


def _responses(spark, sf_dir):
    return odata.read_responses(spark, _landed_responses(spark, sf_dir), one_per_line=True)


def _base(spark, sf_dir):
    """Customers and the years that their items were shipped in: other keys than those of the
    responses, some of them without any."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", F.year("l_shipdate").alias("t"))
    return orders.join(items, orders.o_orderkey == items.l_orderkey).groupBy(
        F.col("o_custkey").cast("string").alias("g"), "t").agg(F.count("*").cast("double").alias("v"))


@query("s7_p8_indicator_rows", f"""WITH {BY_PRIORITY} SELECT 'SPEND' AS indicator, g, t, dim1, spend AS v FROM x
UNION ALL SELECT 'ORDERS', g, t, dim1, n FROM x""")
def _(spark, sf_dir):
    return odata.parse_responses(_responses(spark, sf_dir), KEYED).drop("source", "line", "position")


@query("p7_p11_select_indicators", f"""WITH {BY_PRIORITY}
SELECT 'spend_urgent' AS col, g, t, spend AS v FROM x WHERE dim1 = '1-URGENT'
UNION ALL SELECT 'orders_first', g, t, arg_min(n, dim1) FROM x GROUP BY g, t""")
def _(spark, sf_dir):
    return odata.select_indicators(odata.parse_responses(_responses(spark, sf_dir), KEYED), KEYED, INDICATORS)


@query("s8_in_group_range", f"""WITH {YEARLY}, k AS (SELECT g, min(t) AS a, max(t) AS b FROM p WHERE v > 500000 GROUP BY g)
SELECT p.* FROM p JOIN k ON p.g = k.g WHERE t BETWEEN a AND b""")
def _(spark, sf_dir):
    panel = yearly(spark, sf_dir)
    return relational.in_group_range(panel, panel.where("v > 500000").select("g", "t"), SPEC)


@query("s8_needed_files", f"""WITH {BY_PRIORITY}, {YEARLY}, k AS (SELECT CAST(g AS VARCHAR) AS g, min(t) AS a, max(t) AS b FROM p
  WHERE v > 500000 GROUP BY g)
SELECT 'SPEND' AS indicator, x.g, t, dim1, spend AS v FROM x JOIN k ON x.g = k.g WHERE t BETWEEN a AND b
UNION ALL SELECT 'ORDERS', x.g, t, dim1, n FROM x JOIN k ON x.g = k.g WHERE t BETWEEN a AND b""")
def _(spark, sf_dir):
    folder = _landed_responses(spark, sf_dir)
    files = landed.list_files(spark, folder)
    rows = odata.parse_responses(odata.read_responses(spark, folder, one_per_line=True), KEYED)
    index = landed.index_files(files, rows, KEYED)
    wanted = yearly(spark, sf_dir).where("v > 500000").select(F.col("g").cast("string").alias("g"), "t")
    needed = landed.needed_files(files, index, wanted, KEYED)
    found = odata.parse_responses(odata.read_responses(spark, folder, one_per_line=True, files=needed), KEYED)
    return relational.in_group_range(found, wanted, KEYED).drop("source", "line", "position")


@query("j3_in_key_periods", f"""WITH {YEARLY} SELECT p.* FROM p SEMI JOIN (
  SELECT o_custkey, year(l_shipdate) AS y FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R') k
  ON p.g = k.o_custkey AND p.t = k.y""")
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("g"))
    items = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select("l_orderkey", F.year("l_shipdate").alias("t"))
    keys = orders.join(items, orders.o_orderkey == items.l_orderkey).select("g", "t")
    return relational.in_key_periods(yearly(spark, sf_dir), keys, SPEC)


@query("p11_first_arrival", """WITH x AS (SELECT CAST(o_custkey AS VARCHAR) AS g, CAST(year(o_orderdate) AS INTEGER) AS t,
  o_orderkey // 100 AS part, o_orderpriority AS dim1, round(sum(o_totalprice), 2) AS spend FROM orders GROUP BY 1, 2, 3, 4)
SELECT 'first_spend' AS col, g, t, arg_min(spend, (part, dim1)) AS v FROM x GROUP BY g, t
UNION ALL SELECT 'first_urgent', g, t, arg_min(spend, part) FROM x WHERE dim1 = '1-URGENT' GROUP BY g, t""")
def _(spark, sf_dir):
    """Lines for every 100 orders, many to a file, in which the keys come back again and again."""
    rows = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("t"), F.expr("o_orderkey div 100").alias("part"), "o_orderpriority")
        .agg(F.round(F.sum("o_totalprice"), 2).alias("spend"))
    )
    item = F.struct(
        F.col("o_custkey").cast("string").alias("SpatialDim"), F.col("t").alias("TimeDim"),
        F.col("o_orderpriority").alias("Dim1"), F.col("spend").alias("NumericValue"))
    lines = rows.groupBy("part").agg(F.sort_array(F.collect_list(item)).alias("value")).select(
        "part", F.lit("SPEND").alias("indicator"), F.to_json(F.struct("value")).alias("value"))
    folder = new_folder(spark, "arrivals")
    in_order = lines.repartitionByRange(4, "part").sortWithinPartitions("indicator", "part")
    in_order.select("indicator", "value").write.partitionBy("indicator").text(folder)
    responses = odata.read_responses(spark, folder, one_per_line=True)
    return odata.select_indicators(odata.parse_responses(responses, SPEC), SPEC, (
        odata.Indicator("SPEND", "first_spend"), odata.Indicator("SPEND", "first_urgent", "1-URGENT")))


@query("j11_group_periods", """SELECT DISTINCT o_custkey AS g, CAST(year(o_orderdate) AS INTEGER) AS t FROM orders""")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("g"), F.year("o_orderdate").alias("t"))
    return relational.group_periods(rows, SPEC)


@query("s9_group_period_lists", """SELECT o_custkey AS g, string_agg(DISTINCT CAST(year(o_orderdate) AS VARCHAR), ', '
  ORDER BY CAST(year(o_orderdate) AS VARCHAR)) AS periods FROM orders GROUP BY 1""")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("g"), F.year("o_orderdate").alias("t"))
    return relational.group_period_lists(rows, SPEC).withColumn(
        "periods", F.array_join(F.col("periods").cast("array<string>"), ", "))


@query("s9_group_period_runs", """WITH y AS (SELECT DISTINCT o_custkey AS g, CAST(year(o_orderdate) AS INTEGER) AS t FROM orders),
x AS (SELECT g, t, t - row_number() OVER (PARTITION BY g ORDER BY t) AS island FROM y)
SELECT g, min(t) AS run_start, max(t) AS run_end FROM x GROUP BY g, island""")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("g"), F.year("o_orderdate").alias("t"))
    return period_runs(rows, SPEC.with_(block=2))


ENRICHED = f"""{BY_PRIORITY}, b AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS g, CAST(year(l_shipdate) AS INTEGER) AS t
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
u AS (SELECT g, t, spend FROM x WHERE dim1 = '1-URGENT'),
o AS (SELECT g, t, arg_min(n, dim1) AS n FROM x GROUP BY g, t),
e AS (SELECT b.g, b.t, u.spend AS spend_urgent, o.n AS orders_first, CAST(NULL AS DOUBLE) AS absent
  FROM b LEFT JOIN u ON u.g = b.g AND u.t = b.t LEFT JOIN o ON o.g = b.g AND o.t = b.t)"""


@query("j1_enrich", f"WITH {ENRICHED} SELECT * FROM e")
def _(spark, sf_dir):
    return enrich(_base(spark, sf_dir), _responses(spark, sf_dir), KEYED, INDICATORS)


@query("a15_enrichment_report", f"""WITH {ENRICHED} SELECT count(*) AS n_rows,
  count(spend_urgent) + count(orders_first) + count(absent) AS total_entries FROM e""")
def _(spark, sf_dir):
    return enrichment_report(enrich(_base(spark, sf_dir), _responses(spark, sf_dir), KEYED, INDICATORS), INDICATORS)


@query("s11_write_enriched", f"""WITH {ENRICHED} SELECT g, t, spend_urgent, orders_first, CAST(NULL AS VARCHAR) AS absent FROM e""")
def _(spark, sf_dir):
    folder = new_folder(spark, "enriched")
    enriched = enrich(_base(spark, sf_dir), _responses(spark, sf_dir), KEYED, INDICATORS)
    observations.write_csv(enriched, folder, ["g", "t"], overwrite=True)
    back = observations.read_csv(spark, folder, SPEC.with_(value="spend_urgent"))
    return back.withColumn("orders_first", F.col("orders_first").cast("double"))
