"""Interpolating and smoothing B-splines for the points of a series."""

from __future__ import annotations

import numpy as np

# Points solved together, and points on either side that only steady the solution.  The
# pull of a point on a spline fades by a constant factor per point (0.27 for cubic, 0.43
# for degree five, on even spacing; 0.5 at most for cubic on any), so after 64 points it is
# below double precision.
WINDOW = 96
HALO = 64


def _knots(x: np.ndarray, degree: int) -> np.ndarray:
    """Knots at the points (odd degree) or midway (even), none next to the ends."""
    half = (degree + 1) // 2
    if degree % 2:
        inner = x[half:len(x) - half]
    else:
        middle = (x[:-1] + x[1:]) / 2
        inner = middle[degree // 2:len(middle) - degree // 2]
    return np.concatenate([np.repeat(x[0], degree + 1), inner, np.repeat(x[-1], degree + 1)])


def _basis(knots: np.ndarray, degree: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Span of each place and its degree+1 basis values; outside, the end pieces go on."""
    last = len(knots) - degree - 2
    span = np.clip(np.searchsorted(knots, at, side="right") - 1, degree, last)
    values = np.zeros((len(at), degree + 1))
    values[:, 0] = 1.0
    for d in range(1, degree + 1):
        carry = np.zeros(len(at))
        for r in range(d):
            right = knots[span + r + 1] - at
            left = at - knots[span + r + 1 - d]
            share = values[:, r] / (right + left)
            values[:, r] = carry + right * share
            carry = left * share
        values[:, d] = carry
    return span, values


def _solve_and_evaluate(
    x: np.ndarray, y: np.ndarray, degree: int, at: np.ndarray
) -> np.ndarray:
    middle, scale = x.mean(), max((x[-1] - x[0]) / 2, 1e-300)
    x, at = (x - middle) / scale, (at - middle) / scale
    knots = _knots(x, degree)
    span, values = _basis(knots, degree, x)
    matrix = np.zeros((len(x), len(x)))
    rows = np.arange(len(x))
    for d in range(degree + 1):
        matrix[rows, span - degree + d] = values[:, d]
    weights = np.linalg.solve(matrix, y)
    span, values = _basis(knots, degree, at)
    return sum(values[:, d] * weights[span - degree + d] for d in range(degree + 1))


def interpolate(x: np.ndarray, y: np.ndarray, degree: int, at: np.ndarray) -> np.ndarray:
    """Values at ``at`` of the spline through the sorted points (x, y)."""
    out = np.empty(len(at))
    place = np.searchsorted(x, at)
    for first in range(0, len(x), WINDOW):
        last = first + WINDOW
        inside = (place >= first) | (first == 0)
        inside &= (place < last) | (last >= len(x))
        if inside.any():
            lo, hi = max(first - HALO, 0), min(last + HALO, len(x))
            out[inside] = _solve_and_evaluate(x[lo:hi], y[lo:hi], degree, at[inside])
    return out


# Coefficients that one step of the solution works on.
STEP = 48


def _jumps(knots: np.ndarray, degree: int) -> np.ndarray:
    """How the highest derivative of each spline that has it jumps at the inner knots, one row per knot.

    Row j belongs to knot j + degree + 1 and to the coefficients from j on.
    """
    at = np.arange(degree + 1, len(knots) - degree - 1)
    rows = np.empty((len(at), degree + 2))
    for j in range(degree + 2):
        first = at - degree - 1 + j
        product = np.ones(len(at))
        for m in range(degree + 2):
            other = first + m
            product *= np.where(other == at, 1.0, knots[at] - knots[np.minimum(other, len(knots) - 1)])
        rows[:, j] = (knots[first + degree + 1] - knots[first]) / product
    return rows


def _penalised(
    basis: np.ndarray, first: np.ndarray, y: np.ndarray, jumps: np.ndarray, weight: float
) -> np.ndarray:
    """Coefficients with the least squares of the residuals and of ``weight`` times the jumps.

    Both kinds of rows touch a few neighbouring coefficients only, so the triangle of the
    equations is made STEP coefficients at a time, and its size is that of the band.
    """
    n, band = len(y), jumps.shape[1]
    carry, carried = np.zeros((0, band)), np.zeros(0)
    triangles = []
    for a in range(0, n, STEP):
        b = min(a + STEP, n)
        width = b - a + band
        d0, d1 = min(a, len(jumps)), min(b, len(jumps))
        p0, p1 = np.searchsorted(first, [a, b])
        heavy = np.zeros((d1 - d0, width))
        for j in range(band):
            heavy[np.arange(d1 - d0), np.arange(d1 - d0) + j] = weight * jumps[d0:d1, j]
        light = np.zeros((p1 - p0, width))
        for j in range(basis.shape[1]):
            light[np.arange(p1 - p0), first[p0:p1] - a + j] = basis[p0:p1, j]
        old = np.zeros((len(carry), width))
        old[:, :carry.shape[1]] = carry
        matrix = np.vstack([heavy, old, light])
        right = np.concatenate([np.zeros(d1 - d0), carried, y[p0:p1]])
        q, r = np.linalg.qr(matrix)
        z = q.T @ right
        triangles.append((a, b, r[:b - a], z[:b - a]))
        carry, carried = r[b - a:, b - a:], z[b - a:]
    weights = np.zeros(n + band)
    for a, b, r, z in reversed(triangles):
        weights[a:b] = np.linalg.solve(r[:, :b - a], z - r[:, b - a:] @ weights[b:b + r.shape[1] - (b - a)])
    return weights[:n]


def smooth(x: np.ndarray, y: np.ndarray, degree: int, at: np.ndarray) -> np.ndarray:
    """Values at ``at`` of the smoothing spline of the sorted points (x, y).

    Of all splines with the knots of ``interpolate`` whose squared residuals sum up to at most the number of
    points it has the smallest jumps of its highest derivative.  The weight of the jumps is found by a
    root search on the residual, which grows with it, from none for the spline through all points to
    that of the least-squares polynomial.
    """
    allowed = float(len(x))
    middle, scale = x.mean(), (x[-1] - x[0]) / max(len(x) - 1, 1)
    x, at = (x - middle) / scale, (at - middle) / scale
    knots = _knots(x, degree)
    span, basis = _basis(knots, degree, x)
    jumps, first = _jumps(knots, degree), span - degree

    def solved(u: float) -> tuple[float, np.ndarray]:
        weights = _penalised(basis, first, y, jumps, np.exp(u / 2))
        fitted = sum(basis[:, j] * weights[first + j] for j in range(degree + 1))
        return float(((y - fitted) ** 2).sum()), weights

    low = high = 0.0
    residual, weights = solved(0.0)
    below, above = residual, residual
    while below > allowed and low > -80:
        low -= 8
        below, weights = solved(low)
    while above <= allowed and high < 80:
        high += 8
        above, weights = solved(high)
    # Halving and secant steps in turn, on logarithms, between a residual that is too small and one too large.
    for step in range(80):
        if high - low < 1e-12 or abs(residual - allowed) <= 1e-9 * allowed:
            break
        if step % 2 or below <= 0:
            u = (low + high) / 2
        else:
            share = (np.log(allowed) - np.log(below)) / (np.log(above) - np.log(below))
            u = low + min(max(share, 0.02), 0.98) * (high - low)
        residual, weights = solved(u)
        if residual > allowed:
            high, above = u, residual
        else:
            low, below = u, residual
    span, values = _basis(knots, degree, at)
    return sum(values[:, j] * weights[span - degree + j] for j in range(degree + 1))
