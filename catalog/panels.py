"""Panels made from the given tables, in Spark and in SQL.

Every panel has a group ``g``, an integer time ``t`` and a nullable value ``v``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide import PanelSpec

SPEC = PanelSpec("g", "t", "v", status=("s1", "s2", "s3"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def month_of(date: str):
    return (F.year(date) * 12 + F.month(date) - 1).cast("int")


# Yearly spend of every customer.  Years without an order are gaps.
YEARLY = """p AS (
  SELECT o_custkey AS g, CAST(year(o_orderdate) AS INTEGER) AS t,
         round(sum(o_totalprice), 2) AS v
  FROM orders GROUP BY 1, 2)"""


def yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("g"), F.year("o_orderdate").alias("t"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
    )


# The same with a status per year.
YEARLY_STATUS = """p AS (
  SELECT o_custkey AS g, CAST(year(o_orderdate) AS INTEGER) AS t,
         round(sum(o_totalprice), 2) AS v,
         CASE min(o_orderstatus) WHEN 'F' THEN ' d ' WHEN 'O' THEN 'E ' ELSE 'P' END AS s1
  FROM orders GROUP BY 1, 2)"""


def yearly_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.min("o_orderstatus")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("g"), F.year("o_orderdate").alias("t"))
        .agg(
            F.round(F.sum("o_totalprice"), 2).alias("v"),
            F.when(status == "F", " d ").when(status == "O", "E ").otherwise("P").alias("s1"))
    )


# The same with a second status: a break, in the rare years with a very large order.
YEARLY_BREAKS = YEARLY_STATUS.replace("ELSE 'P' END AS s1", """ELSE 'P' END AS s1,
         CASE WHEN max(o_totalprice) > 480000 THEN 'B' END AS s2""")


def yearly_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.min("o_orderstatus")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("g"), F.year("o_orderdate").alias("t"))
        .agg(
            F.round(F.sum("o_totalprice"), 2).alias("v"),
            F.when(status == "F", " d ").when(status == "O", "E ").otherwise("P").alias("s1"),
            F.when(F.max("o_totalprice") > 480000, "B").alias("s2"))
    )


# Daily value of every user's events of some kind: a day with other events only has a null value.
def daily_sql(kind: str) -> str:
    return f"""p AS (
  SELECT user_id AS g, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS t,
         round(sum(CASE WHEN {kind} THEN value END), 2) AS v
  FROM events GROUP BY 1, 2)"""


PURCHASES = "event_type = 'purchase'"
# So rare that some users have no value at all, and so frequent that some have one every day.
LARGE_PURCHASES = "event_type = 'purchase' AND value > 150"
OTHER_EVENTS = "event_type <> 'purchase'"
DAILY = daily_sql(PURCHASES)


def daily(spark: SparkSession, sf_dir: str, kind: str = PURCHASES) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("g"), F.unix_date(F.to_date("ts")).alias("t"))
        .agg(F.round(F.sum(F.when(F.expr(kind), F.col("value"))), 2).alias("v"))
    )


# Monthly order value of every nation, in units of ``scale``.
def monthly_sql(scale: float = 1.0) -> str:
    return f"""p AS (
  SELECT n_name AS g, CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INTEGER) AS t,
         round(sum(o_totalprice), 2) / {scale:.1f} AS v
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2)"""


def monthly(spark: SparkSession, sf_dir: str, scale: float = 1.0) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .join(nations, customers.c_nationkey == nations.n_nationkey)
        .groupBy(F.col("n_name").alias("g"), month_of("o_orderdate").alias("t"))
        .agg((F.round(F.sum("o_totalprice"), 2) / F.lit(float(scale))).alias("v"))
    )


# One row per line item with a code and three status columns.
CODED = """p AS (
  SELECT p_brand AS code, l_orderkey, l_linenumber, l_returnflag AS s1, l_linestatus AS s2,
         o_orderstatus AS s3
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey)"""


def coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .join(orders, lines.l_orderkey == orders.o_orderkey)
        .select(
            F.col("p_brand").alias("code"), "l_orderkey", "l_linenumber",
            F.col("l_returnflag").alias("s1"), F.col("l_linestatus").alias("s2"),
            F.col("o_orderstatus").alias("s3"))
    )


# One row per order: several rows per (customer, year), with a status.
ORDER_ROWS = """p AS (
  SELECT o_custkey AS g, CAST(year(o_orderdate) AS INTEGER) AS t, o_totalprice AS v,
         o_orderstatus AS s1, o_orderkey
  FROM orders)"""


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("g"), F.year("o_orderdate").alias("t"),
        F.col("o_totalprice").alias("v"), F.col("o_orderstatus").alias("s1"), "o_orderkey")


# Continuations for SQL: the dense panel d (with has_row), and its runs r of missing periods.
DENSE = """s AS (SELECT g, min(t) AS a, max(t) AS b, count(DISTINCT t) AS n FROM p GROUP BY g),
grid AS (SELECT g, CAST(unnest(range(a, b + 1)) AS INTEGER) AS t FROM s),
d AS (SELECT grid.g, grid.t, p.v, p.g IS NOT NULL AS has_row
      FROM grid LEFT JOIN p ON p.g = grid.g AND p.t = grid.t)"""

RUNS = DENSE + """,
i AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY t)
              - row_number() OVER (PARTITION BY g, v IS NULL ORDER BY t) AS island FROM d),
r AS (SELECT g, CAST(min(t) AS BIGINT) AS run_start, CAST(max(t) AS BIGINT) AS run_end,
             count(*) AS run_length
      FROM i WHERE v IS NULL GROUP BY g, island)"""


def linear_sql(source: str, keys: str = "g") -> str:
    """CTEs that end in ``f``: the rows of ``source`` with ``pos`` and the linear fill ``w``."""
    join = " AND ".join(f"y.{k} = x.{k}" for k in keys.split(", "))
    join2 = " AND ".join(f"z.{k} = x.{k}" for k in keys.split(", "))
    return f"""n0 AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY t) AS pos FROM {source}),
n1 AS (SELECT *,
  max(CASE WHEN v IS NOT NULL THEN pos END) OVER (
    PARTITION BY {keys} ORDER BY pos ROWS UNBOUNDED PRECEDING) AS p0,
  min(CASE WHEN v IS NOT NULL THEN pos END) OVER (
    PARTITION BY {keys} ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p1 FROM n0),
f AS (SELECT x.*, CASE
    WHEN x.v IS NOT NULL THEN x.v WHEN p0 IS NULL THEN z.v WHEN p1 IS NULL THEN y.v
    ELSE y.v + (z.v - y.v) / (p1 - p0) * (x.pos - p0) END AS w
  FROM n1 x LEFT JOIN n0 y ON {join} AND y.pos = x.p0 LEFT JOIN n0 z ON {join2} AND z.pos = x.p1)"""


def polynomial_sql(source: str, keys: str = "g", order: int = 3) -> str:
    """CTEs that end in ``q``: the rows of ``source`` with ``fit``, the least-squares
    polynomial of degree min(order, values - 1) by Gram-Schmidt, and its residual ``rss``."""
    over = f"OVER (PARTITION BY {keys})"
    ctes = [f"""q0 AS (SELECT *, count(v) {over} AS n,
  t - avg(CASE WHEN v IS NOT NULL THEN t END) {over} AS x,
  avg(v) {over} AS fit FROM {source})""",
            "e0 AS (SELECT *, CASE WHEN v IS NOT NULL THEN 1.0 END AS b0, 1.0 AS a0, v - fit AS res FROM q0)"]
    # Each degree: the next power made orthogonal to all lower ones over the valued rows.
    for k in range(1, order + 1):
        raw = " * ".join(["x"] * k)
        parts = []
        for j in range(k):
            parts.append(
                f"coalesce(sum(b{j} * {raw}) {over} / nullif(sum(b{j} * b{j}) {over}, 0), 0) * a{j}")
        ctes.append(f"""q{k} AS (SELECT *, {raw} - ({' + '.join(parts)}) AS a{k} FROM e{k - 1})""")
        ctes.append(f"""m{k} AS (SELECT *, CASE WHEN v IS NOT NULL THEN a{k} END AS b{k} FROM q{k})""")
        ctes.append(f"""u{k} AS (SELECT *, CASE WHEN n > {k} THEN
  sum(b{k} * res) {over} / sum(b{k} * b{k}) {over} ELSE 0 END AS c{k} FROM m{k})""")
        ctes.append(f"""e{k} AS (SELECT * EXCLUDE (fit, res),
  fit + c{k} * CASE WHEN n > {k} THEN a{k} ELSE 0 END AS fit,
  res - c{k} * CASE WHEN n > {k} THEN a{k} ELSE 0 END AS res FROM u{k})""")
    ctes.append(f"q AS (SELECT *, sum(res * res) {over} AS rss FROM e{order})")
    return ",\n".join(ctes)


def spline_sql(source: str) -> str:
    """CTEs that end in ``sp``: (g, t, spline) for the rows of ``source`` without a value, by
    the cubic spline through all values of the group, if it has five or more.

    Second derivatives m at the values follow from a tridiagonal system, solved by a sweep
    forwards and one backwards; at both ends the first two pieces are one cubic.
    """
    return f"""kn AS (SELECT g, t AS x, v AS y, row_number() OVER o - 1 AS i, count(*) OVER (PARTITION BY g) - 1 AS m,
  lead(t) OVER o - t AS h, t - lag(t) OVER o AS hb, (lead(v) OVER o - v) / (lead(t) OVER o - t) AS dv
  FROM {source} WHERE v IS NOT NULL WINDOW o AS (PARTITION BY g ORDER BY t)),
eq AS (SELECT *, 6 * (dv - lag(dv) OVER (PARTITION BY g ORDER BY i)) AS rhs,
  CASE WHEN i = m - 1 THEN hb - h * h / hb ELSE hb END AS lo,
  2 * (hb + h) + CASE WHEN i = 1 THEN hb * (1 + hb / h) WHEN i = m - 1 THEN h * (1 + h / hb) ELSE 0 END AS di,
  CASE WHEN i = 1 THEN h - hb * hb / h ELSE h END AS up FROM kn WHERE m >= 4),
fw AS (SELECT g, i, m, up / di AS c, rhs / di AS r FROM eq WHERE i = 1
  UNION ALL SELECT eq.g, eq.i, eq.m, eq.up / (eq.di - eq.lo * fw.c), (eq.rhs - eq.lo * fw.r) / (eq.di - eq.lo * fw.c)
  FROM fw JOIN eq ON eq.g = fw.g AND eq.i = fw.i + 1 WHERE eq.i < eq.m),
bw AS (SELECT g, i, m, r AS d2 FROM fw WHERE i = m - 1
  UNION ALL SELECT fw.g, fw.i, fw.m, fw.r - fw.c * bw.d2 FROM bw JOIN fw ON fw.g = bw.g AND fw.i = bw.i - 1),
en AS (SELECT g, i, d2 FROM bw
  UNION ALL SELECT a.g, 0, (1 + k0.h / k1.h) * a.d2 - k0.h / k1.h * b.d2 FROM bw a
    JOIN bw b ON b.g = a.g AND b.i = 2 JOIN kn k0 ON k0.g = a.g AND k0.i = 0 JOIN kn k1 ON k1.g = a.g AND k1.i = 1
    WHERE a.i = 1
  UNION ALL SELECT a.g, a.m, (1 + k0.h / k1.h) * a.d2 - k0.h / k1.h * b.d2 FROM bw a
    JOIN bw b ON b.g = a.g AND b.i = a.m - 2 JOIN kn k0 ON k0.g = a.g AND k0.i = a.m - 1
    JOIN kn k1 ON k1.g = a.g AND k1.i = a.m - 2 WHERE a.i = a.m - 1),
pc AS (SELECT k.g, k.i, k.m, k.x, k.h, k.y, z.y AS yn, z.x AS xn, a.d2 AS a2, b.d2 AS b2 FROM kn k
  JOIN kn z ON z.g = k.g AND z.i = k.i + 1 JOIN en a ON a.g = k.g AND a.i = k.i JOIN en b ON b.g = k.g AND b.i = k.i + 1),
sp AS (SELECT s.g, s.t, a2 * (xn - t) ** 3 / (6 * h) + b2 * (t - x) ** 3 / (6 * h)
    + (y / h - a2 * h / 6) * (xn - t) + (yn / h - b2 * h / 6) * (t - x) AS spline
  FROM {source} s JOIN pc ON pc.g = s.g AND (s.t > x OR i = 0) AND (s.t < xn OR i = m - 1) WHERE s.v IS NULL)"""
