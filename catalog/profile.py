"""Profiling queries: status flags, coverage, breaks, plain columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.panels import (
    CODED, ORDER_ROWS, SPEC, YEARLY, coded, monthly, monthly_sql, order_rows, table, yearly,
)
from catalog.registry import query
from paneltide.operators import charts, features, relational, status

HIT = "(s1 = 'R' OR s2 = 'R' OR s3 = 'R')"
REPORT = f"""report AS (SELECT code, count(*) FILTER (WHERE {HIT}) AS rows_with_D, count(*) AS rows_total,
  count(*) FILTER (WHERE {HIT}) / count(*) AS share_D FROM p GROUP BY code)"""


def _report(spark, sf_dir):
    return status.status_report(coded(spark, sf_dir), SPEC, "code", "R")


@query("a3_status_report", f"""WITH {CODED}, {REPORT}
SELECT code, rows_with_D, rows_total, round(share_D, 8) AS share_D FROM report""")
def _(spark, sf_dir):
    return _report(spark, sf_dir).withColumn("share_D", F.round("share_D", 8))


@query("a3_status_totals", f"""WITH {CODED} SELECT count(*) FILTER (WHERE {HIT}) AS total_d,
  count(*) AS total_rows, round(count(*) FILTER (WHERE {HIT}) * 100.0 / count(*), 6) AS share_total FROM p""")
def _(spark, sf_dir):
    return status.status_totals(coded(spark, sf_dir), SPEC, "R").withColumn(
        "share_total", F.round("share_total", 6))


@query("o1_c3_lowest_shares", f"""WITH {CODED}, {REPORT}
SELECT code, round(share_D, 8) AS share_D FROM report ORDER BY report.share_D, code LIMIT 10""")
def _(spark, sf_dir):
    return status.lowest_shares(_report(spark, sf_dir), "code").select(
        "code", F.round("share_D", 8).alias("share_D"))


@query("o2_lowest_code", f"""WITH {CODED}, {REPORT}
SELECT trim(code) AS code FROM report WHERE length(trim(code)) >= 2 ORDER BY share_D, code LIMIT 1""")
def _(spark, sf_dir):
    return status.lowest_code(_report(spark, sf_dir), "code")


TRIGGERS = ("R", "F", "P")
ANY = " OR ".join(f"s{i} IN ('R', 'F', 'P')" for i in (1, 2, 3))
HITS = " + ".join(f"CAST(s{i} IN ('R', 'F', 'P') AS INTEGER)" for i in (1, 2, 3))


@query("a7_trigger_counts", f"""WITH {CODED}, x AS (SELECT unnest(['R', 'F', 'P']) AS value)
SELECT value, count(*) AS count FROM x JOIN p ON s1 = value OR s2 = value OR s3 = value GROUP BY value""")
def _(spark, sf_dir):
    return status.trigger_counts(coded(spark, sf_dir), TRIGGERS, ("s1", "s2", "s3"))


@query("a7_trigger_summary", f"""WITH {CODED} SELECT count(*) FILTER (WHERE {ANY}) AS rows_with_any,
  count(*) FILTER (WHERE {HITS} > 1) AS rows_with_multiple FROM p""")
def _(spark, sf_dir):
    return status.trigger_summary(coded(spark, sf_dir), TRIGGERS, ("s1", "s2", "s3"))


@query("g1_status_flag", f"""WITH {CODED} SELECT l_orderkey, l_linenumber, s1,
  CAST({ANY} AS INTEGER) AS flag FROM p""")
def _(spark, sf_dir):
    return status.add_status_flag(coded(spark, sf_dir), SPEC, "flag", TRIGGERS).select(
        "l_orderkey", "l_linenumber", "s1", "flag")


@query("g2_definition_flag", f"""WITH {CODED} SELECT l_orderkey, l_linenumber,
  CAST({HIT} AS INTEGER) AS flag FROM p""")
def _(spark, sf_dir):
    return status.add_status_flag(coded(spark, sf_dir), SPEC, "flag", ("R",), "strip_upper").select(
        "l_orderkey", "l_linenumber", "flag")


@query("p1_drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def _(spark, sf_dir):
    return relational.drop_columns(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderpriority"])


@query("p2_code_prefix", """SELECT p_partkey, p_brand, p_type FROM part WHERE upper(p_brand) LIKE 'BRAND#1%'""")
def _(spark, sf_dir):
    return relational.filter_code_prefix(
        table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type"), "brand#1", "p_brand")


@query("p10_one_group", f"""WITH {YEARLY} SELECT * FROM p WHERE g = 7""")
def _(spark, sf_dir):
    return charts.one_group(yearly(spark, sf_dir), SPEC, 7)


@query("p11_first_rows", """SELECT o_custkey, t, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
  min(o_orderdate) AS o_orderdate,
  arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice
FROM (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS t FROM orders) GROUP BY 1, 2""")
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("t"), "o_orderkey", "o_orderdate", "o_totalprice")
    return relational.first_rows(orders, ["o_custkey", "t"], ["o_orderdate", "o_orderkey"])


@query("s5_last_observations", f"""WITH {YEARLY} SELECT g, t, v FROM p
QUALIFY row_number() OVER (PARTITION BY g ORDER BY t DESC) <= 3""")
def _(spark, sf_dir):
    return relational.last_observations(yearly(spark, sf_dir), ["g"], "t", 3)


@query("s6_key_filter", """SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_quantity FROM lineitem
WHERE l_linestatus = 'F' AND l_returnflag IN ('A', 'N')""")
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity")
    return relational.key_filter(lines, l_linestatus="F", l_returnflag=["A", "N"])


@query("p3_expand_codes", """WITH c AS (SELECT DISTINCT p_type AS id FROM part)
SELECT id, CAST(0 AS BIGINT) AS position FROM c WHERE id = 'PROMO'
UNION ALL SELECT id, CAST(3 AS BIGINT) FROM c WHERE id LIKE 'E%' OR id LIKE 'S%'""")
def _(spark, sf_dir):
    codes = relational.distinct_values(table(spark, sf_dir, "part"), "p_type").toDF("id")
    return relational.expand_codes(codes, ["PROMO", "S", "E"])


@query("p3_unknown_code", "SELECT p_type AS id, CAST(0 AS BIGINT) AS position FROM part WHERE false")
def _(spark, sf_dir):
    codes = relational.distinct_values(table(spark, sf_dir, "part"), "p_type").toDF("id")
    return relational.expand_codes(codes, ["no such code", "S"])


@query("a10_dataset_profile", """SELECT CAST(0 AS INTEGER) AS position, 'o_orderkey' AS "column", 'bigint' AS type, count(o_orderkey) AS non_null FROM orders
UNION ALL SELECT 1, 'o_custkey', 'bigint', count(o_custkey) FROM orders
UNION ALL SELECT 2, 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
UNION ALL SELECT 3, 'o_totalprice', 'double', count(o_totalprice) FROM orders
UNION ALL SELECT 4, 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM orders
UNION ALL SELECT 5, 'o_orderpriority', 'string', count(o_orderpriority) FROM orders""")
def _(spark, sf_dir):
    return relational.dataset_profile(table(spark, sf_dir, "orders"))


@query("a10_dataset_size", """SELECT count(*) AS n_rows, CAST(6 AS INTEGER) AS n_columns,
  count(DISTINCT o_orderpriority) AS n_codes, count(DISTINCT o_custkey) AS n_groups FROM orders""")
def _(spark, sf_dir):
    return relational.dataset_size(table(spark, sf_dir, "orders"), "o_orderpriority", "o_custkey")


@query("o5_head", f"WITH {YEARLY} SELECT * FROM p ORDER BY g, t LIMIT 5")
def _(spark, sf_dir):
    return relational.head(yearly(spark, sf_dir), ["g", "t"])


@query("a11_value_range", f"""WITH {YEARLY} SELECT min(t) AS min_year, max(t) AS max_year,
  min(v) AS min_value, max(v) AS max_value FROM p""")
def _(spark, sf_dir):
    return relational.value_range(yearly(spark, sf_dir), SPEC)


@query("a16_distinct_values", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL")
def _(spark, sf_dir):
    return relational.distinct_values(table(spark, sf_dir, "orders"), "o_custkey")


@query("o3_ordered", f"WITH {YEARLY} SELECT * FROM p ORDER BY g, t")
def _(spark, sf_dir):
    return relational.ordered(yearly(spark, sf_dir), ["g", "t"])


GAPS = """y AS (SELECT DISTINCT g, t FROM p),
s AS (SELECT g, min(t) AS a, max(t) AS b, count(*) AS n FROM y GROUP BY g)"""


@query("a4_coverage", f"""WITH {ORDER_ROWS}, {GAPS}
SELECT p.g, min(t) AS min_year, max(t) AS max_year, count(t) AS n_periods,
  count(*) FILTER (WHERE s1 = 'P') AS time_break_rows, count(*) FILTER (WHERE s1 = 'F') AS defdiff_rows,
  CAST(any_value(b - a + 1 - n) AS BIGINT) AS missing_years
FROM p JOIN s ON p.g = s.g GROUP BY p.g""")
def _(spark, sf_dir):
    return status.coverage(order_rows(spark, sf_dir), SPEC, "P", "F")


@query("a4_missing_lists", f"""WITH {ORDER_ROWS}, {GAPS},
x AS (SELECT g, CAST(unnest(range(a, b + 1)) AS INTEGER) AS t FROM s),
m AS (SELECT x.g, string_agg(CAST(x.t AS VARCHAR), ', ' ORDER BY x.t) AS l
      FROM x ANTI JOIN y ON x.g = y.g AND x.t = y.t GROUP BY x.g)
SELECT s.g, coalesce(l, '') AS missing_years FROM s LEFT JOIN m ON s.g = m.g""")
def _(spark, sf_dir):
    lists = status.coverage_missing_lists(order_rows(spark, sf_dir), SPEC)
    return lists.withColumn("missing_years", F.array_join(F.col("missing_years").cast("array<string>"), ", "))


@query("a4_coverage_gaps", f"""WITH {ORDER_ROWS}, {GAPS},
x AS (SELECT g, CAST(unnest(range(a, b + 1)) AS INTEGER) AS t FROM s),
m AS (SELECT x.g, x.t, x.t - row_number() OVER (PARTITION BY x.g ORDER BY x.t) AS island
      FROM x ANTI JOIN y ON x.g = y.g AND x.t = y.t)
SELECT g, min(t) AS run_start, max(t) AS run_end FROM m GROUP BY g, island""")
def _(spark, sf_dir):
    return status.coverage_gaps(order_rows(spark, sf_dir), SPEC.with_(block=2))


@query("a4_group_count", f"WITH {ORDER_ROWS} SELECT count(DISTINCT g) AS num_groups FROM p")
def _(spark, sf_dir):
    return status.group_count(order_rows(spark, sf_dir), SPEC)


BREAKS = """k AS (SELECT g, max(t) AS last_break,
  string_agg(DISTINCT CAST(t AS VARCHAR), ', ' ORDER BY CAST(t AS VARCHAR)) AS years_with_breaks
  FROM p WHERE s1 = 'P' GROUP BY g)"""


@query("a5_break_summary", f"""WITH {ORDER_ROWS}, {BREAKS}
SELECT k.g, last_break, years_with_breaks, count(*) AS rows_cut
FROM k JOIN p ON p.g = k.g AND p.t <= last_break GROUP BY ALL""")
def _(spark, sf_dir):
    return status.break_summary(order_rows(spark, sf_dir), SPEC, "P", lists="text")


@query("a5_last_breaks", f"""WITH {ORDER_ROWS}, {BREAKS}
SELECT k.g, last_break, count(*) AS rows_cut FROM k JOIN p ON p.g = k.g AND p.t <= last_break GROUP BY ALL""")
def _(spark, sf_dir):
    return status.break_summary(order_rows(spark, sf_dir), SPEC.with_(block=2), "P")


@query("a5_total_cut", f"""WITH {ORDER_ROWS}, {BREAKS}
SELECT count(*) AS total_cut FROM k JOIN p ON p.g = k.g AND p.t <= last_break""")
def _(spark, sf_dir):
    return status.handle_breaks(order_rows(spark, sf_dir), SPEC, "P").total_cut


@query("a5_break_periods", f"WITH {ORDER_ROWS} SELECT DISTINCT g, t FROM p WHERE s1 = 'P'")
def _(spark, sf_dir):
    return status.break_periods(order_rows(spark, sf_dir), SPEC, "P")


CUT = f"""WITH {ORDER_ROWS}, {BREAKS}
SELECT p.* FROM p LEFT JOIN k ON p.g = k.g WHERE last_break IS NULL OR t > last_break"""


@query("w8_cut_at_breaks", CUT)
def _(spark, sf_dir):
    return status.cut_at_breaks(order_rows(spark, sf_dir), SPEC, "P")


@query("w8_cut_at_breaks_split", CUT)
def _(spark, sf_dir):
    return status.cut_at_breaks(order_rows(spark, sf_dir), SPEC.with_(block=2), "P")


@query("c2_break_series", f"""WITH o AS ({ORDER_ROWS[len('p AS ('):-1]}), {YEARLY},
lim AS (SELECT min(t) AS x_min, max(t) AS x_max, min(v) AS y_min, max(v) AS y_max FROM p),
grid AS (SELECT g, CAST(unnest(range(x_min, x_max + 1)) AS INTEGER) AS t FROM (SELECT DISTINCT g FROM p), lim),
k AS (SELECT DISTINCT g, t FROM o WHERE s1 = 'P')
SELECT grid.g, grid.t, p.v, lim.*, CAST(k.g IS NOT NULL AS INTEGER) AS is_break_year
FROM grid LEFT JOIN p ON p.g = grid.g AND p.t = grid.t LEFT JOIN k ON k.g = grid.g AND k.t = grid.t, lim""")
def _(spark, sf_dir):
    breaks = status.break_periods(order_rows(spark, sf_dir), SPEC, "P")
    return charts.break_series(yearly(spark, sf_dir), SPEC, breaks)


@query("c1_gap_series", f"""WITH {YEARLY},
lim AS (SELECT min(t) AS x_min, max(t) AS x_max, min(v) AS y_min, max(v) AS y_max FROM p),
grid AS (SELECT g, CAST(unnest(range(x_min, x_max + 1)) AS INTEGER) AS t FROM (SELECT DISTINCT g FROM p), lim)
SELECT grid.g, grid.t, p.v, lim.* FROM grid LEFT JOIN p ON p.g = grid.g AND p.t = grid.t, lim""")
def _(spark, sf_dir):
    return charts.gap_series(yearly(spark, sf_dir), SPEC)


@query("a6_yearly_trend", f"""WITH {YEARLY} SELECT t, round(avg(v), 4) AS mean, count(v) AS count FROM p GROUP BY t""")
def _(spark, sf_dir):
    return features.yearly_trend(yearly(spark, sf_dir), SPEC).withColumn("mean", F.round("mean", 4))


# The odd unit keeps means off the halfway points that two engines may round differently.
UNIT = 7654321.0


@query("c4_trend_series", f"""WITH {monthly_sql(UNIT)} SELECT t, round(avg(v), 8) AS mean, count(v) AS count,
  CAST(t BETWEEN 23964 AND 23987 AS INTEGER) AS in_range FROM p GROUP BY t""")
def _(spark, sf_dir):
    return charts.trend_series(monthly(spark, sf_dir, UNIT), SPEC, (23964, 23987)).withColumn(
        "mean", F.round("mean", 8))


@query("g3_period_flag", f"""WITH {YEARLY} SELECT *, CAST(t BETWEEN 1998 AND 1999 AS INTEGER) AS flag FROM p""")
def _(spark, sf_dir):
    return features.add_period_flag(yearly(spark, sf_dir), SPEC, "flag", (1998, 1999))
