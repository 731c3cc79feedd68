"""Masking against a plain walk over all candidates, and the error metrics."""

import math

import pytest

import naive
from paneltide import PanelSpec
from paneltide.operators import fill, masking

SPEC = PanelSpec("g", "t", "v")
LENGTHS = {"a": 5, "b": 12, "c": 40, "d": 2, "e": 7}


@pytest.fixture
def full(panel):
    rows = [(g, 2000 + 2 * i, math.sin(i) * 10 + i) for g, n in LENGTHS.items() for i in range(n)]
    return panel([*rows, ("z", 2000, None), *[("z", 2001 + i, 1.0) for i in range(20)]])


@pytest.mark.parametrize("kind, width", [(masking.ISOLATED, 1), (masking.SEQUENTIAL, 3)])
@pytest.mark.parametrize("ratio", [0.0, 0.1, 0.25, 0.5, 1.0])
def test_targets_equal_a_plain_walk(full, kind, width, ratio):
    got = masking.mask_targets(full, SPEC, kind, ratio, seed=7, trials=4).collect()
    for trial in range(4):
        assert {(r.g, r.position) for r in got if r.trial == trial} == naive.greedy(LENGTHS, ratio, 7, trial, width)


@pytest.mark.parametrize("kind, width", [(masking.ISOLATED, 1), (masking.SEQUENTIAL, 3)])
def test_series_longer_than_one_piece(spark, kind, width):
    length = 2 * masking.POSITIONS + 700
    df = spark.range(length).selectExpr("'long' g", "id t", "1.0D v")
    got = {(r.g, r.position) for r in masking.mask_targets(df, SPEC, kind, 0.3, seed=1).collect()}
    assert got == naive.greedy({"long": length}, 0.3, 1, 0, width)


@pytest.mark.parametrize("kind", [masking.ISOLATED, masking.SEQUENTIAL])
def test_positions_do_not_depend_on_how_far_a_piece_looks_ahead(spark, kind):
    lengths = spark.createDataFrame([("long", 3 * masking.POSITIONS + 5), ("short", 9)], "g string, _rows long")
    near, far = ({tuple(r) for r in masking._accepted(lengths, SPEC, kind, 1, 20, ahead).collect()} for ahead in (4, masking.POSITIONS))
    assert near == far and len(near) > 15_000


def test_priorities_are_worked_out_once(spark, full):
    """What follows the greedy choice reads its result."""
    targets = masking.mask_isolated(full, SPEC, 0.3)
    plan = targets._jdf.queryExecution().executedPlan().toString()
    assert "md5" not in plan and "ExistingRDD" in plan


def test_masks_keep_their_distance_and_leave_the_ends(full):
    iso = masking.mask_isolated(full, SPEC, 1.0, trials=3).collect()
    seq = masking.mask_sequential(full, SPEC, 1.0, trials=3).collect()
    for rows, distance, width in ((iso, 2, 1), (seq, 3, 3)):
        series = {}
        for r in rows:
            assert 1 <= r.position and r.position + width - 1 <= LENGTHS[r.g] - 2
            series.setdefault((r.trial, r.g), []).append(r.position)
        for positions in series.values():
            ordered = sorted(positions)
            assert all(b - a >= distance for a, b in zip(ordered, ordered[1:]))


@pytest.mark.parametrize("spec", [SPEC, SPEC.with_(time_range=(1900, 2200)), SPEC.with_(block=5)])
def test_errors_and_pooling(full, spec):
    targets = masking.mask_isolated(full, spec, 0.2, 3, trials=2).union(
        masking.mask_sequential(full, spec, 0.2, 3, trials=2))
    errors = masking.masking_errors(full, spec, targets)
    linear = [r for r in errors.collect() if r.method == "linear"]
    chosen = {(r.trial, r.kind, r.g, r.position) for r in targets.collect()}
    assert {(r.trial, r.kind, r.g, r.position) for r in linear} == chosen
    value = {(g, i): math.sin(i) * 10 + i for g, n in LENGTHS.items() for i in range(n)}
    total = 0.0
    for r in linear:
        masked = {p + k for t, kind, g, p in chosen if (t, kind, g) == (r.trial, r.kind, r.g)
                  for k in range(3 if kind == "sequential" else 1)}
        known = [None if i in masked else value[r.g, i] for i in range(LENGTHS[r.g])]
        want = value[r.g, r.position] - naive.linear(known)[r.position]
        assert r.error == pytest.approx(want, abs=1e-9)
        total += abs(want)
    pooled = masking.pooled_metrics(errors, 2).first()
    assert pooled.mae_linear == pytest.approx(round(total / len(linear), 2), abs=0.011)
    assert pooled.runs == 2


@pytest.mark.parametrize("spec", [SPEC.with_(time_range=(0, 100)), SPEC.with_(block=5)], ids=["bounded", "split"])
def test_stretches_of_touching_runs(spark, spec):
    kinds = {"sequential": [1, 4, 7, 11, 14, 20, 31, 34, 37, 40, 43], "isolated": [1, 3, 5, 9]}
    rows = [(0, k, g, p) for k, ps in kinds.items() for g in "ab" for p in ps if g == "a" or p > 5]
    got = masking.masked_stretches(spark.createDataFrame(rows, "trial int, kind string, g string, position long"), spec)
    masked = {}
    for _, k, g, p in rows:
        masked.setdefault((k, g), set()).update(range(p, p + (3 if k == "sequential" else 1)))
    for r in got.collect():
        first = last = r.position
        held = masked[r.kind, r.g]
        while first - 1 in held:
            first -= 1
        while last + 1 in held:
            last += 1
        assert (r.first, r.last) == (first, last)


@pytest.mark.parametrize("spec", [SPEC.with_(time_range=(0, 3000)), SPEC.with_(block=100)], ids=["bounded", "split"])
def test_work_follows_the_targets(spark, spec, monkeypatch):
    """A hundred trials on few targets: no copy of a series, and five rows looked up per target at most."""
    df = spark.range(2_000).selectExpr("concat('g', id % 2) g", "cast(id div 2 as int) t", "(id div 2) * 0.001D + (id % 7) * 0.01D v")
    lengths = masking.complete_lengths(df, spec)
    targets = masking.mask_isolated(df, spec, 0.001, 3, 100, lengths).union(masking.mask_sequential(df, spec, 0.001, 3, 100, lengths)).cache()
    asked = []
    real = masking._looked_up

    def counted(stretches, values, spec):
        found = real(stretches, values, spec)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        asked.append((found.count(), "Generate explode(array_union" in plan))
        return found

    monkeypatch.setattr(masking, "_looked_up", counted)
    monkeypatch.setattr(masking, "masked_panel", None)
    monkeypatch.setattr(masking, "_curve_errors", None)
    errors = masking.masking_errors(df, spec, targets)
    assert errors.count() == 2 * targets.count() == 800
    assert asked == [(400, True)]
    pooled = masking.pooled_metrics(errors, 100).first()
    assert pooled.mae_linear < 0.05 and pooled.mae_spline < 0.05


def test_scoring_all_masked_values(full):
    targets = masking.mask_sequential(full, SPEC, 0.2, 3)
    first = masking.masking_errors(full, SPEC, targets)
    every = masking.masking_errors(full, SPEC, targets, score_all=True)
    assert every.count() == 3 * first.count()


def test_trial_metrics_average_the_kinds(panel):
    rows = [(0, "isolated", "linear", 1.0), (0, "isolated", "linear", 3.0), (0, "sequential", "linear", 4.0),
            (1, "isolated", "linear", None), (1, "sequential", "linear", 2.0)]
    errors = panel(rows, "trial int, kind string, method string, error double")
    got = {r.trial: (r.mae, r.rmse) for r in masking.trial_metrics(errors).collect()}
    assert got == {0: (3.0, pytest.approx((math.sqrt(5) + 4) / 2)), 1: (2.0, 2.0)}


def test_same_targets_in_every_block_size(full):
    want = masking.compare_methods(full, SPEC, 0.2, 0.2, trials=2).first()
    split = masking.compare_methods(full, SPEC.with_(block=6), 0.2, 0.2, trials=2).first()
    assert tuple(want) == tuple(split)
    assert fill.MAX_ORDER == 5
