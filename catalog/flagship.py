"""The whole way from raw rows to an imputed panel with features."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from catalog.panels import SPEC, YEARLY_BREAKS, linear_sql, yearly_breaks
from catalog.registry import query
from paneltide.functions.materialize import new_folder
from paneltide.plans.prepare import Settings, prepare_panel
from paneltide.sources.clustered import read_clustered, replace_codes, write_clustered

BOUNDED = SPEC.with_(time_range=(1900, 2100))

# Cut at the last break, fill the axis, trim, interpolate, add features.
PREPARED = f"""WITH raw AS ({YEARLY_BREAKS[len('p AS ('):-1]}),
k AS (SELECT g, max(t) AS last_break FROM raw WHERE s2 = 'B' GROUP BY g),
p AS (SELECT raw.* FROM raw LEFT JOIN k ON raw.g = k.g WHERE last_break IS NULL OR t > last_break),
s AS (SELECT g, min(t) AS a, max(t) AS b, count(*) AS n FROM p GROUP BY g),
grid AS (SELECT g, CAST(unnest(range(a, b + 1)) AS INTEGER) AS t FROM s),
d AS (SELECT grid.g, grid.t, p.v, p.s1, p.s2 FROM grid LEFT JOIN p ON p.g = grid.g AND p.t = grid.t),
h AS (SELECT d.*, d.t - a AS k, b - a + 1 - n AS m0, b - a + 1 AS len, coalesce(sum(CAST(v IS NULL AS INTEGER)) OVER (
  PARTITION BY d.g ORDER BY d.t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS np FROM d JOIN s ON d.g = s.g),
k1 AS (SELECT g, min(k) AS k1 FROM h WHERE (m0 - np) / (len - k) <= 0.2 GROUP BY g),
k2 AS (SELECT h.g, min(k) AS k2 FROM h JOIN k1 ON h.g = k1.g WHERE k >= k1 AND v IS NOT NULL GROUP BY h.g),
kept AS (SELECT h.g, h.t, h.v, h.s1, h.s2 FROM h LEFT JOIN k2 ON h.g = k2.g WHERE m0 / len <= 0.2 OR k >= k2),
{linear_sql('kept')}
SELECT g, t, round(w, 4) AS v, s1, s2, v IS NULL AS was_filled, CAST(coalesce(upper(trim(s1)) = 'D', false) AS INTEGER) AS "D-Flag",
  CAST(coalesce(trim(s1) IN ('P', 'E', 'D'), false) AS INTEGER) AS "Status-Flag",
  round(lag(w, 1) OVER o, 4) AS lag_1, round(lag(w, 2) OVER o, 4) AS lag_2,
  round(avg(w) OVER (PARTITION BY g ORDER BY t ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS roll_mean_3
FROM f WINDOW o AS (PARTITION BY g ORDER BY t)"""


def _prepared(spark, sf_dir, spec):
    features = prepare_panel(yearly_breaks(spark, sf_dir), spec, Settings())
    return features.withColumns({c: F.round(c, 4) for c in ("v", "lag_1", "lag_2", "roll_mean_3")})


@query("e3_prepare_panel", PREPARED)
def _(spark, sf_dir):
    return _prepared(spark, sf_dir, BOUNDED)


@query("e3_prepare_panel_split", PREPARED)
def _(spark, sf_dir):
    return _prepared(spark, sf_dir, SPEC.with_(block=2))


@query("e3_prepare_panel_clustered", PREPARED)
def _(spark, sf_dir):
    """From a clustered table, in which the values of one folder are wrong at first."""
    name = f"panel_{uuid4().hex}"
    rows = yearly_breaks(spark, sf_dir).withColumn("part", F.col("t") % 3)
    wrong = rows.withColumn("v", F.when(F.col("part") == 1, 2 * F.col("v")).otherwise(F.col("v")))
    write_clustered(wrong, name, new_folder(spark, "clustered"), BOUNDED, buckets=8, code="part")
    replace_codes(rows.where("part = 1"), name, BOUNDED)
    features = prepare_panel(read_clustered(spark, name).drop("part"), BOUNDED, Settings())
    return features.withColumns({c: F.round(c, 4) for c in ("v", "lag_1", "lag_2", "roll_mean_3")})
