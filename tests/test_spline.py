"""Polynomial and spline fills against direct solutions."""

import numpy as np
import pytest

from paneltide import PanelSpec
from paneltide.functions.bspline import HALO, WINDOW, interpolate, smooth
from paneltide.operators import fill

SPEC = PanelSpec("g", "t", "v")
SPECS = {"bounded": SPEC.with_(time_range=(-10, 100_000)), "block": SPEC, "split": SPEC.with_(block=7)}


@pytest.fixture(params=SPECS, ids=list(SPECS))
def spec(request):
    return SPECS[request.param]


def truncated_powers(x, y, at, degree):
    """The interpolating spline in another basis, solved as one dense system."""
    x, at = np.asarray(x, float), np.asarray(at, float)
    middle, scale = x.mean(), np.ptp(x) / 2
    x, at = (x - middle) / scale, (at - middle) / scale
    half = (degree + 1) // 2
    if degree % 2:
        knots = x[half:len(x) - half]
    else:
        knots = ((x[:-1] + x[1:]) / 2)[degree // 2:len(x) - 1 - degree // 2]

    def basis(u):
        return np.column_stack(
            [u ** k for k in range(degree + 1)] + [np.clip(u - c, 0, None) ** degree for c in knots])

    return basis(at) @ np.linalg.lstsq(basis(x), y, rcond=None)[0]


@pytest.mark.parametrize("degree", [1, 2, 3, 4, 5])
def test_spline_in_two_bases(degree):
    rng = np.random.default_rng(degree)
    x = np.sort(rng.choice(60, 14, replace=False)).astype(float)
    y = rng.normal(size=14)
    at = np.array([x[0] - 0.5, *((x[:-1] + x[1:]) / 2), x[-1] + 0.5])
    assert interpolate(x, y, degree, at) == pytest.approx(truncated_powers(x, y, at, degree), abs=1e-5)
    assert interpolate(x, y, degree, x) == pytest.approx(y, abs=1e-9)


def test_pieces_of_a_long_series_agree_with_one_solution(monkeypatch):
    rng = np.random.default_rng(0)
    x = np.cumsum(rng.integers(1, 4, size=2 * WINDOW + 50)).astype(float)
    y = np.cumsum(rng.normal(size=len(x)))
    at = x[:-1] + 0.5
    pieces = interpolate(x, y, 3, at)
    monkeypatch.setattr("paneltide.functions.bspline.WINDOW", len(x))
    assert pieces == pytest.approx(interpolate(x, y, 3, at), abs=1e-9)


def filled(result):
    return {(r.g, r.t): (r.v, r.fill_path) for r in result.collect()}


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_polynomial_within_the_allowance(panel, spec, order):
    rng = np.random.default_rng(order)
    rows, want = [], {}
    for g in range(8):
        t = np.arange(2000, 2003 + 2 * g)
        v = rng.normal(size=len(t)) * 0.3 + 5
        holes = set(rng.choice(len(t), size=max(1, len(t) // 4), replace=False).tolist())
        known = [i for i in range(len(t)) if i not in holes]
        rows += [(f"g{g}", int(t[i]), None if i in holes else float(v[i])) for i in range(len(t))]
        fit = np.polynomial.Polynomial.fit(t[known], v[known], min(order, len(known) - 1))
        want |= {(f"g{g}", int(t[i])): float(fit(t[i])) for i in holes}
    got = filled(fill.interpolate_spline(panel(rows), spec, order))
    for key, value in want.items():
        assert got[key] == (pytest.approx(value, abs=1e-7), "poly")
    assert {p for k, (_, p) in got.items() if k not in want} == {"none"}


@pytest.mark.parametrize("order", [2, 3])
def test_spline_beyond_the_allowance(panel, spec, order):
    rng = np.random.default_rng(order)
    rows, want = [], {}
    for g in range(4):
        t = np.arange(-2, 30 + g)
        v = rng.normal(size=len(t)) * 100
        holes = {0, 7, 8, 9, 20, len(t) - 1}
        known = [i for i in range(len(t)) if i not in holes]
        rows += [(f"g{g}", int(t[i]), None if i in holes else float(v[i])) for i in range(len(t))]
        places = sorted(holes)
        values = truncated_powers(t[known], v[known], t[places], order)
        want |= {(f"g{g}", int(t[i])): float(x) for i, x in zip(places, values)}
    got = filled(fill.fill_spline(panel(rows), spec, order))
    for key, value in want.items():
        assert got[key] == (pytest.approx(value, rel=1e-4, abs=1e-3), "spline")


def test_long_split_series_agree_with_whole_ones(spark):
    """Far more blocks than a halo spans, some of them without any value."""
    length = 6 * HALO
    df = spark.range(length).selectExpr(
        "'a' g", "cast(id as int) t",
        "case when id % 5 = 2 or id between 100 and 130 then null else sin(id) * 1000 + id end v")
    whole = filled(fill.interpolate_spline(df, SPECS["bounded"]))
    split = filled(fill.interpolate_spline(df, SPECS["split"]))
    assert {p for _, p in whole.values()} == {"spline", "none"}
    assert split.keys() == whole.keys()
    for key, (value, path) in whole.items():
        assert split[key] == (pytest.approx(value, rel=1e-9, abs=1e-6), path)


def dense_smooth(x, y, at, degree):
    """The smoothing spline in truncated powers: the jumps are their coefficients; the weight by halving."""
    x, at = np.asarray(x, float), np.asarray(at, float)
    middle, scale = x.mean(), np.ptp(x) / 2
    x, at = (x - middle) / scale, (at - middle) / scale
    half = (degree + 1) // 2
    if degree % 2:
        knots = x[half:len(x) - half]
    else:
        knots = ((x[:-1] + x[1:]) / 2)[degree // 2:len(x) - 1 - degree // 2]

    def basis(u):
        return np.column_stack(
            [u ** k for k in range(degree + 1)] + [np.clip(u - c, 0, None) ** degree for c in knots])

    b, penalty = basis(x), np.diag([0.0] * (degree + 1) + [1.0] * len(knots))
    low, high = -40.0, 40.0
    for _ in range(200):
        u = (low + high) / 2
        c = np.linalg.lstsq(np.vstack([b, np.exp(u / 2) * penalty]), np.concatenate([y, np.zeros(len(penalty))]), rcond=None)[0]
        low, high = (low, u) if ((b @ c - y) ** 2).sum() > len(y) else (u, high)
    return basis(at) @ c


@pytest.mark.parametrize("degree", [1, 2, 3, 4, 5])
@pytest.mark.parametrize("size", [2.0, 30.0])
def test_smoothing_spline_in_two_bases(degree, size):
    rng = np.random.default_rng(degree)
    x = np.sort(rng.choice(60, 22, replace=False)).astype(float)
    y = rng.normal(size=22) * size + np.sin(x / 4) * 3 * size
    at = np.array([x[0] - 0.5, *((x[:-1] + x[1:]) / 2), x[-1] + 0.5])
    assert smooth(x, y, degree, at) == pytest.approx(dense_smooth(x, y, at, degree), rel=1e-4, abs=1e-4 * size)
    assert ((smooth(x, y, degree, x) - y) ** 2).sum() == pytest.approx(22, rel=1e-6)


@pytest.mark.parametrize("noise", [1.5, 50.0])
def test_long_series_use_up_the_allowance(noise):
    rng = np.random.default_rng(3)
    x = np.cumsum(rng.integers(1, 4, size=5_000)).astype(float)
    y = np.cumsum(rng.normal(size=5_000)) + rng.normal(size=5_000) * noise
    assert ((smooth(x, y, 3, x) - y) ** 2).sum() == pytest.approx(5_000, rel=1e-6)


def test_smooth_fills_agree_in_all_modes(panel, spec):
    rng = np.random.default_rng(9)
    rows, want = [], {}
    for g in range(4):
        t = np.arange(-2, 30 + g)
        v = np.sin(t / 3) * 20 + rng.normal(size=len(t)) * 4
        holes = {0, 7, 8, 9, 20, len(t) - 1}
        known = [i for i in range(len(t)) if i not in holes]
        rows += [(f"g{g}", int(t[i]), None if i in holes else float(v[i])) for i in range(len(t))]
        places = sorted(holes)
        values = dense_smooth(t[known], v[known], t[places], 3)
        want |= {(f"g{g}", int(t[i])): float(x) for i, x in zip(places, values)}
    got = filled(fill.fill_spline(panel(rows), spec, curve="smooth"))
    assert len(got) == len(rows)
    for key, value in want.items():
        assert got[key] == (pytest.approx(value, rel=1e-4, abs=1e-3), "smooth")


def test_few_values(panel, spec):
    df = panel([("one", 1, 7.0), ("one", 2, None), ("no", 1, None), ("two", 1, 1.0), ("two", 2, None), ("two", 3, 3.0)])
    kept = filled(fill.fill_spline(df, spec))
    assert kept == {("one", 1): (7.0, "none"), ("two", 1): (1.0, "none"),
                    ("two", 2): (pytest.approx(2.0), "poly"), ("two", 3): (3.0, "none")}
    every = filled(fill.interpolate_spline(df, spec))
    assert every[("one", 2)] == (7.0, "linear")
    assert every[("no", 1)] == (None, "none")


def test_observed_values_and_other_columns_stay(panel, spec):
    rows = [("a", t, None if t % 4 == 1 else 1000.0 * (t % 3), f"x{t}", t) for t in range(20)]
    df = panel([*rows, ("a", None, 5.0, "late", 99)], "g string, t int, v double, note string, n int")
    got = {r.n: r for r in fill.interpolate_spline(df, spec).collect()}
    assert len(got) == 21
    for _, t, v, note, n in rows:
        assert got[n].note == note and got[n].t == t and got[n].was_filled == (v is None)
        assert v is None or got[n].v == v
    assert got[99].v == 5.0 and got[99].fill_path == "none"
