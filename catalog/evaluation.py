"""Queries that choose an imputation method by masking known values."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.panels import (
    SPEC as ANY_LENGTH, YEARLY, linear_sql, monthly, monthly_sql, polynomial_sql, spline_sql, yearly,
)
from catalog.registry import query
from paneltide.functions.materialize import cut
from paneltide.operators import masking

SEED = 42
# Month numbers of the years 1900 to 2100, which take in the yearly axis as well.
SPEC = ANY_LENGTH.with_(time_range=(1_900, 25_211))


def targets_sql(kind: str, ratio: float, trials: int, suffix: str = "") -> str:
    """CTEs that end in ``mask``: each candidate in priority order is taken unless a taken
    one of its series is too close; then the first ``target`` of a trial count."""
    kept = {"isolated": (2, 3, 2), "sequential": (3, 7, 4)}
    distance, shortest, free = kept[kind]
    return f"""len{suffix} AS (SELECT g, count(*) AS n FROM p GROUP BY g HAVING count(*) = count(v)),
cand{suffix} AS (SELECT g, trial, pos, md5(concat_ws('|', '{SEED}', trial, g, pos)) AS pr
  FROM (SELECT g, unnest(range(1, n - {free} + 1)) AS pos FROM len{suffix} WHERE n >= {shortest}), range({trials}) r(trial)),
goal{suffix} AS (SELECT least(greatest(round_even(count(*) * {ratio}, 0), 1), count(*)) AS target
  FROM cand{suffix} WHERE trial = 0),
fold{suffix} AS (SELECT g, trial, list_reduce(list([pos] ORDER BY pr), lambda a, c:
    CASE WHEN len(list_filter(a, lambda q: abs(q - c[1]) < {distance})) > 0 THEN a ELSE list_concat(a, c) END) AS l
  FROM cand{suffix} GROUP BY g, trial),
taken{suffix} AS (SELECT f.g, f.trial, f.pos, c.pr FROM (SELECT g, trial, unnest(l) AS pos FROM fold{suffix}) f
  JOIN cand{suffix} c ON c.g = f.g AND c.trial = f.trial AND c.pos = f.pos),
mask{suffix} AS (SELECT CAST(trial AS INTEGER) AS trial, '{kind}' AS kind, g, CAST(pos AS BIGINT) AS position
  FROM taken{suffix} QUALIFY row_number() OVER (PARTITION BY trial ORDER BY pr) <= (SELECT target FROM goal{suffix}))"""


for panel_name, sql, panel, ratio, trials in (
    ("yearly", YEARLY, yearly, 0.1, 3), ("monthly", monthly_sql(), monthly, 0.2, 10),
):
    query(f"w14_mask_isolated_{panel_name}", f"""WITH {sql}, {targets_sql('isolated', ratio, trials)}
SELECT * FROM mask""")(
        lambda spark, sf_dir, b=panel, r=ratio, n=trials: masking.mask_isolated(
            b(spark, sf_dir), SPEC, r, SEED, n))
    query(f"w15_mask_sequential_{panel_name}", f"""WITH {sql}, {targets_sql('sequential', ratio, trials)}
SELECT * FROM mask""")(
        lambda spark, sf_dir, b=panel, r=ratio, n=trials: masking.mask_sequential(
            b(spark, sf_dir), SPEC, r, SEED, n))

query("f7_mask_target", f"""WITH {YEARLY}, len AS (SELECT g, count(*) AS n FROM p GROUP BY g HAVING count(*) = count(v))
SELECT CAST(sum(n - 2) AS BIGINT) AS candidates, CAST(round_even(sum(n - 2) * 0.05, 0) AS BIGINT) AS target
FROM len WHERE n >= 3""")(
    lambda spark, sf_dir: masking.mask_target(
        masking.complete_lengths(yearly(spark, sf_dir), SPEC), masking.ISOLATED, 0.05))

# Values in units in which the polynomial is within its allowance for every series.
SCALE, TRIALS = 31_234_567.0, 5
RATIOS = (0.1, 0.15)


def _panel(spark, sf_dir):
    return monthly(spark, sf_dir, SCALE)


def _targets(panel):
    lengths = cut(masking.complete_lengths(panel, SPEC))
    return masking.mask_isolated(panel, SPEC, RATIOS[0], SEED, TRIALS, lengths).union(
        masking.mask_sequential(panel, SPEC, RATIOS[1], SEED, TRIALS, lengths))


KEYS = "trial, kind, g"


def masked_sql(scale: float, trials: int = TRIALS) -> str:
    """CTEs that end in ``k``: the series that hold a target, with the masked value as v."""
    return f"""{monthly_sql(scale)}, {targets_sql('isolated', RATIOS[0], trials, '_i')},
{targets_sql('sequential', RATIOS[1], trials, '_s')},
t0 AS (SELECT *, position AS at FROM mask_i UNION ALL
  SELECT trial, kind, g, position, position + unnest([0, 1, 2]) AS at FROM mask_s),
rows AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY t) - 1 AS position FROM p),
held AS (SELECT DISTINCT trial, kind, g FROM t0),
k AS (SELECT h.trial, h.kind, x.g, x.t, x.position, x.v AS original,
  CASE WHEN t0.at IS NULL THEN x.v END AS v, t0.at IS NOT NULL AS is_masked,
  coalesce(t0.position = t0.at, false) AS is_target
  FROM held h JOIN rows x ON x.g = h.g
  LEFT JOIN t0 ON t0.trial = h.trial AND t0.kind = h.kind AND t0.g = x.g AND t0.at = x.position)"""


MASKED = f"WITH {masked_sql(SCALE)}"
ERRORS = f"""{MASKED.replace("WITH", "WITH RECURSIVE", 1)}, {linear_sql('k', KEYS)}, {polynomial_sql('k', KEYS)},
ks AS (SELECT concat_ws('|', trial, kind, g) AS g, t, v FROM k), {spline_sql('ks')},
err AS (SELECT trial, kind, 'linear' AS method, g, position, is_target, original - w AS error FROM f WHERE is_masked
  UNION ALL SELECT trial, kind, 'spline', q.g, position, is_target, original - CASE WHEN rss <= n THEN fit ELSE spline END
  FROM q LEFT JOIN sp ON sp.g = concat_ws('|', trial, kind, q.g) AND sp.t = q.t WHERE is_masked)"""


def _errors(spark, sf_dir, score_all=False):
    panel = _panel(spark, sf_dir)
    return masking.masking_errors(panel, SPEC, _targets(panel), score_all=score_all)


@query("w15_masked_panel", f"""{MASKED} SELECT trial, kind, g, t, CAST(position AS BIGINT) AS position,
  original AS v, v AS masked_value, is_masked, is_target FROM k""")
def _(spark, sf_dir):
    panel = _panel(spark, sf_dir)
    return masking.masked_panel(panel, SPEC, _targets(panel))


METRICS = "avg(abs(error)) AS mae, sqrt(avg(error * error)) AS rmse, count(error) AS count"


@query("a12_error_metrics", f"""{ERRORS}, m AS (SELECT trial, kind, method, {METRICS} FROM err WHERE is_target GROUP BY ALL)
SELECT trial, kind, method, round(mae, 7) AS mae, round(rmse, 7) AS rmse, count FROM m""")
def _(spark, sf_dir):
    return masking.error_metrics(_errors(spark, sf_dir), "trial", "kind", "method").withColumns({
        "mae": F.round("mae", 7), "rmse": F.round("rmse", 7)})


@query("a12_error_metrics_all_masked", f"""{ERRORS}, m AS (SELECT kind, method, {METRICS} FROM err GROUP BY ALL)
SELECT kind, method, round(mae, 7) AS mae, round(rmse, 7) AS rmse, count FROM m""")
def _(spark, sf_dir):
    return masking.error_metrics(_errors(spark, sf_dir, True), "kind", "method").withColumns({
        "mae": F.round("mae", 7), "rmse": F.round("rmse", 7)})


@query("a14_trial_metrics", f"""{ERRORS}, m AS (SELECT trial, kind, method, {METRICS} FROM err WHERE is_target GROUP BY ALL)
SELECT trial, method, round(avg(mae), 7) AS mae, round(avg(rmse), 7) AS rmse FROM m WHERE count > 0 GROUP BY ALL""")
def _(spark, sf_dir):
    return masking.trial_metrics(_errors(spark, sf_dir)).withColumns({
        "mae": F.round("mae", 7), "rmse": F.round("rmse", 7)})


def pooled_sql(errors: str, trials: int = TRIALS) -> str:
    """Errors pooled over trials by the number of scored values."""
    return f"""{errors}, m AS (SELECT trial, kind, method, {METRICS} FROM err WHERE is_target GROUP BY ALL),
w AS (SELECT method, round(sum(mae * count) / sum(count), 2) AS mae,
  round(sqrt(sum(rmse * rmse * count) / sum(count)), 2) AS rmse FROM m GROUP BY method)
SELECT max(mae) FILTER (WHERE method = 'linear') AS mae_linear, max(rmse) FILTER (WHERE method = 'linear') AS rmse_linear,
  max(mae) FILTER (WHERE method = 'spline') AS mae_spline, max(rmse) FILTER (WHERE method = 'spline') AS rmse_spline,
  CAST({trials} AS INTEGER) AS runs FROM w"""


@query("g6_a13_compare_methods", pooled_sql(ERRORS))
def _(spark, sf_dir):
    return masking.compare_methods(_panel(spark, sf_dir), SPEC, *RATIOS, TRIALS, SEED)


# All trials that a comparison has by default.  In such units every series is within the allowance
# of its polynomial, so the work follows the masked values.
POLYNOMIAL_ERRORS = f"""WITH {masked_sql(SCALE, 100)}, {linear_sql('k', KEYS)}, {polynomial_sql('k', KEYS)},
err AS (SELECT trial, kind, 'linear' AS method, is_target, original - w AS error FROM f
  UNION ALL SELECT trial, kind, 'spline', is_target, original - fit FROM q)"""


@query("g6_compare_methods_100_trials", pooled_sql(POLYNOMIAL_ERRORS, 100))
def _(spark, sf_dir):
    return masking.compare_methods(_panel(spark, sf_dir), SPEC, *RATIOS, base_seed=SEED)


# In smaller units the values are large enough for the spline.
LARGE = 123_456.7
SPLINE_ERRORS = f"""WITH RECURSIVE {masked_sql(LARGE)}, {linear_sql('k', KEYS)}, {polynomial_sql('k', KEYS)},
one AS (SELECT trial || '/' || kind || '/' || g AS g, t, v FROM k), {spline_sql('one')},
err AS (SELECT trial, kind, 'linear' AS method, is_target, original - w AS error FROM f
  UNION ALL SELECT trial, kind, 'spline', is_target, original - CASE WHEN rss <= n THEN fit ELSE spline END
  FROM q LEFT JOIN sp ON sp.g = trial || '/' || kind || '/' || q.g AND sp.t = q.t)"""


@query("g6_compare_methods_spline", pooled_sql(SPLINE_ERRORS))
def _(spark, sf_dir):
    return masking.compare_methods(monthly(spark, sf_dir, LARGE), SPEC, *RATIOS, TRIALS, SEED)


# The smoothing spline has no SQL; tests hold it against a dense solution in another basis.
@query("g6_compare_methods_smooth")
def _(spark, sf_dir):
    return masking.compare_methods(monthly(spark, sf_dir, LARGE), SPEC, *RATIOS, TRIALS, SEED, curve="smooth")
