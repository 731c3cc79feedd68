"""Queries that depend on the order within a series: gaps, trimming, fills, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.panels import (
    DAILY, DENSE, LARGE_PURCHASES, OTHER_EVENTS, RUNS, SPEC, YEARLY, YEARLY_STATUS, daily, daily_sql,
    linear_sql, polynomial_sql, spline_sql, yearly, yearly_status,
)
from catalog.registry import query
from paneltide.operators import complete, features, fill, gaps, relational

# Time axes of the yearly and daily panels, and blocks that cut their series in pieces.
YEARS, DAYS = (1900, 2100), (0, 40_000)
SPLIT_YEARS = SPEC.with_(block=2)
SPLIT_DAYS = SPEC.with_(block=4)


def both(name, sql, function, panel, split=SPLIT_YEARS):
    """Register a query for a declared time range and one with series cut into blocks."""
    bounded = SPEC.with_(time_range=YEARS if split is SPLIT_YEARS else DAYS)
    query(name, sql)(lambda spark, sf_dir: function(panel(spark, sf_dir), bounded))
    query(f"{name}_split", sql)(lambda spark, sf_dir: function(panel(spark, sf_dir), split))


def _summary(nulls: bool, panel: str) -> str:
    missing = "v IS NULL" if nulls else "NOT has_row"
    return f"""WITH {panel}, {DENSE},
m AS (SELECT g, count(*) AS k, string_agg(CAST(t AS VARCHAR), ', ' ORDER BY t) AS l FROM d WHERE {missing} GROUP BY g)
SELECT s.g, a AS first_year, b AS last_year, n AS observed_periods, CAST(b - a + 1 AS BIGINT) AS series_length,
  k AS missing_count, k / (b - a + 1) AS missing_quote, l AS missing_years FROM s JOIN m ON s.g = m.g"""


def _gap_summary(panel, spec):
    return gaps.gap_summary(panel, spec, lists="array").withColumn(
        "missing_years", F.array_join(F.col("missing_years").cast("array<string>"), ", "))


both("a1_gap_summary", _summary(False, YEARLY), _gap_summary, yearly)
both("a2_gap_overview", _summary(True, DAILY),
     lambda df, spec: gaps.gap_overview(df, spec, lists="text"), daily, SPLIT_DAYS)
both("u2_missing_periods", f"WITH {DAILY}, {DENSE} SELECT g, CAST(t AS BIGINT) AS t FROM d WHERE v IS NULL",
     gaps.missing_periods, daily, SPLIT_DAYS)
both("w1_missing_runs", f"WITH {DAILY}, {RUNS} SELECT * FROM r", gaps.missing_runs, daily, SPLIT_DAYS)

for panel_name, sql, panel, split in (
    ("yearly", YEARLY, yearly, SPLIT_YEARS), ("daily", DAILY, daily, SPLIT_DAYS),
):
    both(f"a8_isolated_ratio_{panel_name}", f"""WITH {sql}, {RUNS}
SELECT count(*) / (SELECT count(*) FROM d) AS missing_ratio_isolated FROM r WHERE run_length = 1""",
         gaps.missing_ratio_isolated, panel, split)
    both(f"a9_sequential_ratio_{panel_name}", f"""WITH {sql}, {RUNS}, l AS (SELECT * FROM r WHERE run_length > 1)
SELECT CAST(sum(run_length) AS DOUBLE) / (SELECT count(*) FROM d) AS missing_ratio_sequential,
  (SELECT g FROM l ORDER BY run_length DESC, g LIMIT 1) AS longest_g,
  CAST(max(run_length) AS BIGINT) AS longest_run_length FROM l""",
         gaps.missing_ratio_sequential, panel, split)

both("j9_densify", f"WITH {YEARLY_STATUS}, s AS (SELECT g, min(t) AS a, max(t) AS b FROM p GROUP BY g)"
     ", x AS (SELECT g, CAST(unnest(range(a, b + 1)) AS INTEGER) AS t FROM s) "
     "SELECT x.g, x.t, p.v, p.s1 FROM x LEFT JOIN p ON p.g = x.g AND p.t = x.t",
     gaps.densify, yearly_status)
query("j10_global_grid", f"""WITH {YEARLY}, b AS (SELECT min(t) AS a, max(t) AS z FROM p),
x AS (SELECT g, CAST(unnest(range(a, z + 1)) AS INTEGER) AS t FROM (SELECT DISTINCT g FROM p), b)
SELECT x.g, x.t, p.v FROM x LEFT JOIN p ON p.g = x.g AND p.t = x.t""")(
    lambda spark, sf_dir: gaps.global_grid(yearly(spark, sf_dir), SPEC))


# Trimming as defined: positions k of the dense series, gaps m0, missing values before k.
def _trim(panel: str, threshold: float) -> str:
    return f"""WITH {panel}, {DENSE},
h AS (SELECT g, a, b, (b - a + 1 - n) AS m0, (b - a + 1) AS len FROM s),
k AS (SELECT d.*, a, b, m0, len, d.t - a AS k, coalesce(sum(CAST(v IS NULL AS INTEGER)) OVER (
        PARTITION BY d.g ORDER BY d.t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS np
      FROM d JOIN h ON d.g = h.g),
above AS (SELECT * FROM k WHERE m0 / len > {threshold}),
k1 AS (SELECT g, min(k) AS k1 FROM above WHERE (m0 - np) / (len - k) <= {threshold} GROUP BY g),
k2 AS (SELECT above.g, min(above.t) AS keep_from FROM above JOIN k1 ON above.g = k1.g
       WHERE above.k >= k1.k1 AND above.v IS NOT NULL GROUP BY above.g),
cuts AS (SELECT u.g, CAST(u.a AS BIGINT) AS from_year,
          CAST(coalesce(k2.keep_from - 1, u.b) AS BIGINT) AS to_year, CAST(k2.keep_from AS BIGINT) AS keep_from
         FROM (SELECT DISTINCT g, a, b FROM above) u LEFT JOIN k2 ON u.g = k2.g)"""


for panel_name, sql, panel, split, threshold in (
    ("yearly", YEARLY, yearly, SPLIT_YEARS, 0.2), ("daily", DAILY, daily, SPLIT_DAYS, 0.05),
):
    trim = _trim(sql, threshold)
    both(f"w4_trim_{panel_name}", f"""{trim} SELECT d.g, d.t, d.v FROM d LEFT JOIN cuts ON d.g = cuts.g
WHERE to_year IS NULL OR d.t > to_year""",
         lambda df, spec, x=threshold: gaps.trim_by_missing_ratio(df, spec, x).panel, panel, split)
    both(f"w5_cut_events_{panel_name}", f"{trim} SELECT g, from_year, to_year, keep_from FROM cuts",
         lambda df, spec, x=threshold: gaps.trim_by_missing_ratio(df, spec, x).cuts, panel, split)
    both(f"w6_removed_years_{panel_name}", f"""{trim}
SELECT cuts.g, string_agg(CAST(p.t AS VARCHAR), ', ' ORDER BY p.t) AS removed_years
FROM cuts JOIN p ON p.g = cuts.g AND p.t BETWEEN from_year AND to_year GROUP BY cuts.g""",
         lambda df, spec, x=threshold: gaps.trim_by_missing_ratio(df, spec, x).removed_years, panel, split)
    both(f"w6_removed_runs_{panel_name}", f"""{trim},
x AS (SELECT p.g, p.t, p.t - row_number() OVER (PARTITION BY p.g ORDER BY p.t) AS island
  FROM cuts JOIN p ON p.g = cuts.g AND p.t BETWEEN from_year AND to_year),
r AS (SELECT g, island, min(t) AS a, max(t) AS z FROM x GROUP BY g, island)
SELECT g, string_agg(a || '-' || z, ' ' ORDER BY a) AS removed_runs FROM r GROUP BY g""",
         lambda df, spec, x=threshold: gaps.trim_by_missing_ratio(df, spec, x).removed_runs.withColumn(
             "removed_runs", F.array_join(F.transform("removed_runs", lambda r: F.concat_ws("-", r["start"], r["end"])), " ")),
         panel, split)
    query(f"w7_emptied_groups_{panel_name}", f"{trim} SELECT g FROM cuts WHERE keep_from IS NULL")(
        lambda spark, sf_dir, b=panel, x=threshold: gaps.emptied_groups(
            gaps.trim_cuts(b(spark, sf_dir), SPEC, x), SPEC))

query("o4_by_missing_quote", f"""WITH {YEARLY}, {DENSE}, m AS (SELECT g, count(*) AS k FROM d WHERE NOT has_row GROUP BY g)
SELECT s.g, k AS missing_count, k / (b - a + 1) AS missing_quote FROM s JOIN m ON s.g = m.g
ORDER BY missing_quote DESC, s.g""")(
    lambda spark, sf_dir: relational.ordered(
        gaps.gap_summary(yearly(spark, sf_dir), SPEC, lists=None), ["missing_quote", "g"], ["missing_quote"])
    .select("g", "missing_count", "missing_quote"))

query("p6_above_threshold", f"""WITH {YEARLY}, {DENSE}, m AS (SELECT g, count(*) AS k FROM d WHERE NOT has_row GROUP BY g)
SELECT s.g, k AS missing_count, k / (b - a + 1) AS missing_quote FROM s JOIN m ON s.g = m.g
WHERE k / (b - a + 1) > 0.2""")(
    lambda spark, sf_dir: gaps.trim_by_missing_ratio(yearly(spark, sf_dir), SPEC, 0.2)
    .above_threshold.select("g", "missing_count", "missing_quote"))

both("w7_emptied_groups_rare", f"{_trim(daily_sql(LARGE_PURCHASES), 0.05)} SELECT g FROM cuts WHERE keep_from IS NULL",
     lambda df, spec: gaps.emptied_groups(gaps.trim_cuts(df, spec, 0.05), spec),
     lambda spark, sf_dir: daily(spark, sf_dir, LARGE_PURCHASES), SPLIT_DAYS)

both("g5_complete_series", f"""WITH {daily_sql(OTHER_EVENTS)} SELECT p.* FROM p
WHERE g NOT IN (SELECT g FROM p WHERE v IS NULL)""", complete.filter_complete_series,
     lambda spark, sf_dir: daily(spark, sf_dir, OTHER_EVENTS), SPLIT_DAYS)
both("g5_complete_series_yearly", f"""WITH {YEARLY}, {DENSE} SELECT g, t, v FROM d
WHERE g NOT IN (SELECT g FROM d WHERE v IS NULL)""",
     lambda df, spec: complete.filter_complete_series(gaps.densify(df, spec), spec), yearly)


def _rounded(df, *columns, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in columns})


both("w9_linear_yearly", f"""WITH {YEARLY}, {DENSE}, {linear_sql('d')}
SELECT g, t, round(w, 4) AS v, v IS NULL AND w IS NOT NULL AS was_filled FROM f""",
     lambda df, spec: _rounded(fill.interpolate_linear(gaps.densify(df, spec), spec), "v"), yearly)
both("w11_fill_linear_daily", f"""WITH {DAILY}, {linear_sql('p')}
SELECT g, t, round(w, 8) AS v, v IS NULL AS was_filled FROM f WHERE w IS NOT NULL""",
     lambda df, spec: _rounded(fill.fill_linear(df, spec), "v", digits=8), daily, SPLIT_DAYS)
both("w13_filled_points", f"""WITH {DAILY}, {linear_sql('p')}
SELECT g, t, round(w, 8) AS v FROM f WHERE v IS NULL AND w IS NOT NULL""",
     lambda df, spec: _rounded(fill.filled_points(fill.fill_linear(df, spec), spec), "v", digits=8),
     daily, SPLIT_DAYS)

# In such units all yearly series are within the allowance of the polynomial, and the odd
# size keeps results off the halfway points that two engines may round differently.
SCALED = YEARLY.replace("round(sum(o_totalprice), 2)", "round(sum(o_totalprice), 2) / 7654321.0")


def _scaled_gaps(df, spec):
    return gaps.densify(df.withColumn("v", F.col("v") / 7654321.0), spec)


both("w12_polynomial_yearly", f"""WITH RECURSIVE {SCALED}, {DENSE}, {polynomial_sql('d')}, {spline_sql('d')}
SELECT q.g, q.t, round(CASE WHEN v IS NOT NULL THEN v WHEN rss <= n THEN fit ELSE spline END, 8) AS v,
  CASE WHEN v IS NOT NULL THEN 'none' WHEN rss <= n THEN 'poly' ELSE 'spline' END AS fill_path, v IS NULL AS was_filled
FROM q LEFT JOIN sp ON sp.g = q.g AND sp.t = q.t WHERE v IS NOT NULL OR n >= 2""",
     lambda df, spec: _rounded(fill.fill_spline(_scaled_gaps(df, spec), spec), "v", digits=8), yearly)
both("w10_quadratic_yearly", f"""WITH {SCALED}, {DENSE}, {polynomial_sql('d', order=2)}
SELECT g, t, round(CASE WHEN v IS NULL AND n >= 2 AND rss <= n THEN fit ELSE v END, 8) AS v,
  v IS NULL AS was_filled FROM q""",
     lambda df, spec: _rounded(fill.interpolate_spline(_scaled_gaps(df, spec), spec, 2), "v", digits=8)
     .drop("fill_path"), yearly)
# At about full size the daily series go through the spline, or have few enough values for a
# polynomial.  The odd factor keeps results off halfway points, as above.
LARGE = DAILY.replace("value END), 2)", "value END), 2) * 1.2345677")


def _large(df):
    return df.withColumn("v", F.col("v") * 1.2345677)


both("w12_spline_daily", f"""WITH RECURSIVE {LARGE}, {polynomial_sql('p')}, {spline_sql('p')}
SELECT q.g, q.t, round(CASE WHEN v IS NOT NULL THEN v WHEN rss <= n THEN fit ELSE spline END, 3) AS v,
  CASE WHEN v IS NOT NULL THEN 'none' WHEN rss <= n THEN 'poly' ELSE 'spline' END AS fill_path, v IS NULL AS was_filled
FROM q LEFT JOIN sp ON sp.g = q.g AND sp.t = q.t WHERE v IS NOT NULL OR n >= 2""",
     lambda df, spec: _rounded(fill.fill_spline(_large(df), spec), "v", digits=3), daily, SPLIT_DAYS)

# The smoothing spline has no SQL; tests hold it against a dense solution in another basis.
query("w12_smooth_daily")(lambda spark, sf_dir: _rounded(
    fill.fill_spline(_large(daily(spark, sf_dir)), SPEC.with_(time_range=DAYS), curve="smooth"), "v", digits=3))

LAGS = """lag(v, 1) OVER w AS lag_1, lag(v, 2) OVER w AS lag_2"""
both("w2_lags", f"WITH {DAILY} SELECT g, t, v, {LAGS} FROM p WINDOW w AS (PARTITION BY g ORDER BY t)",
     features.add_lag_features, daily, SPLIT_DAYS)
both("w3_rolling_mean", f"""WITH {DAILY} SELECT g, t, v, round(avg(v) OVER (
  PARTITION BY g ORDER BY t ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS roll_mean_3 FROM p""",
     lambda df, spec: _rounded(features.add_rolling_features(df, spec), "roll_mean_3"), daily, SPLIT_DAYS)
both("g4_build_features", f"""WITH {YEARLY_STATUS}
SELECT g, t, v, s1, CAST(upper(trim(s1)) = 'D' AS INTEGER) AS "D-Flag",
  CAST(trim(s1) IN ('P', 'E', 'D') AS INTEGER) AS "Status-Flag", {LAGS},
  round(avg(v) OVER (PARTITION BY g ORDER BY t ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS roll_mean_3
FROM p WINDOW w AS (PARTITION BY g ORDER BY t)""",
     lambda df, spec: _rounded(features.build_features(df, spec), "roll_mean_3"), yearly_status)
