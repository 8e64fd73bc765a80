"""Smoothing splines with adaptive knots (INT-3, smoothing form).

The spline of degree k has a residual sum of squares at a target: knots are added, where the
residuals are largest, until the least-squares spline is at or under the target; if it is under,
the jumps of its k-th derivative at the knots are penalised until the residual equals
the target.  A polynomial of degree k that already meets the target is the result as it is (the
smoothest case), and a target of 0 interpolates.  This is the scheme published by P. Dierckx.
"""

from __future__ import annotations

import numpy as np

from gridloom.operators.interp import bspline_basis, interpolate_spline

_TOLERANCE = 1e-3  # the residual is met to this share of the target
_ROUNDS = 60


def _clamped(x: np.ndarray, inner: list[float], k: int) -> np.ndarray:
    return np.r_[(x[0],) * (k + 1), sorted(inner), (x[-1],) * (k + 1)]


def _least_squares(x: np.ndarray, y: np.ndarray, t: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients, squared residuals at the sites)."""
    a = bspline_basis(t, k, x)
    c = np.linalg.lstsq(a, y, rcond=None)[0]
    return c, (a @ c - y) ** 2


def _jumps(t: np.ndarray, k: int) -> np.ndarray:
    """Jump of the k-th derivative at every inner knot, as rows over the coefficients."""
    n = len(t) - k - 1
    d = np.eye(n)
    knots = t
    for degree in range(k, 0, -1):  # coefficients of the derivative, degree by degree
        span = knots[degree + 1:-1] - knots[1:len(knots) - degree - 1]
        d = degree * (d[1:] - d[:-1]) / np.where(span > 0, span, 1.0)[:, None]
        knots = knots[1:-1]
    return d[1:] - d[:-1]


def _add_knots(x: np.ndarray, squared: np.ndarray, inner: list[float], count: int) -> list[float]:
    """Up to ``count`` further knots, each at the middle site of the interval with the largest residual that has one."""
    inner = list(inner)
    for _ in range(count):
        edges = np.r_[x[0], sorted(inner), x[-1]]
        best, place = -1.0, None
        for a, b in zip(edges[:-1], edges[1:]):
            inside = np.flatnonzero((x > a) & (x < b))
            if len(inside):
                held = squared[(x >= a) & (x <= b)].sum()
                if held > best:
                    best, place = held, x[inside[len(inside) // 2]]
        if place is None:
            break
        inner.append(float(place))
    return inner


def smoothing_spline(x: np.ndarray, y: np.ndarray, x_new: np.ndarray, k: int, target: float) -> np.ndarray:
    """Values at ``x_new`` of the degree-k spline whose residual sum of squares at the sites meets ``target``.

    Sites ascend.  With no more than k + 1 sites, or a target of 0, the spline interpolates (of the degree the
    sites allow); NaN outside the sites.
    """
    x, y, x_new = (np.asarray(v, dtype=float) for v in (x, y, x_new))
    m = len(x)
    if m <= k + 1 or target <= 0:
        return interpolate_spline(x, y, x_new, k)
    out = np.full(len(x_new), np.nan)
    inside = (x_new >= x[0]) & (x_new <= x[-1])
    inner: list[float] = []
    t = _clamped(x, inner, k)
    c, squared = _least_squares(x, y, t, k)
    residual, last, added = squared.sum(), None, 1
    while residual > target * (1 + _TOLERANCE):
        if last is not None:  # as many as the last gain suggests, at most twice the last number
            gain = last - residual
            wish = added * 2 if gain <= 0 else int(added * (residual - target) / gain)
            added = max(1, added // 2, min(added * 2, wish))
        more = _add_knots(x, squared, inner, min(added, m - k - 1 - len(inner)))
        if len(more) == len(inner):
            return interpolate_spline(x, y, x_new, k)  # no room for knots: the interpolant is the limit
        inner, last = more, residual
        t = _clamped(x, inner, k)
        c, squared = _least_squares(x, y, t, k)
        residual = squared.sum()
    if inner and residual < target * (1 - _TOLERANCE):
        a, d = bspline_basis(t, k, x), _jumps(t, k)

        def fit(weight: float) -> tuple[np.ndarray, float]:
            c = np.linalg.lstsq(np.vstack([a, np.sqrt(weight) * d]), np.r_[y, np.zeros(len(d))], rcond=None)[0]
            return c, ((a @ c - y) ** 2).sum()

        low, high = -30.0, 30.0  # log10 of the penalty's weight; the residual grows with it
        for _ in range(_ROUNDS):
            middle = (low + high) / 2
            c, residual = fit(10.0 ** middle)
            if abs(residual - target) <= target * _TOLERANCE:
                break
            low, high = (middle, high) if residual < target else (low, middle)
    if inside.any():
        out[inside] = bspline_basis(t, k, x_new[inside]) @ c
    return out
