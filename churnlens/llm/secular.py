"""Symmetric rank-one updates of an eigendecomposition by the secular equation.

``update`` takes Q diag(d) Q^T to Q' diag(d') Q'^T = Q diag(d) Q^T + u u^T.
With z = Q^T u the new eigenvalues are the roots of 1 + sum z_i^2 / (d_i - t),
one in each gap of d.  Components that z doesn't touch, and all but one of a
cluster of equal eigenvalues (rotated so that z is zero there), are deflated:
they stay as they are.  The roots are found all at once, each as an offset from
the pole nearest to it, by rational interpolation inside a shrinking bracket;
the vectors come from the weights for which the found roots are exact, which
keeps them orthogonal.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)


def _roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and the matrix d_i - t_j for distinct ascending ``d`` and positive ``z2``."""
    k = len(d)
    j = np.arange(k)
    top = np.append(d[1:], d[-1] + z2.sum())
    half = (top - d) / 2
    apart = d[:, None] - d[None, :]
    high = 1 + (z2[:, None] / (apart - half)).sum(0) < 0  # the root lies in the upper half of its gap
    high[-1] = False
    origin = j + high
    delta, top_delta = apart[:, origin], top - d[origin]
    lo, hi = np.where(high, -half, 0.0), np.where(high, 0.0, half)
    lo[-1], hi[-1] = 0.0, 2 * half[-1]
    t = (lo + hi) / 2
    below = j[:, None] <= j[None, :]
    with np.errstate(all="ignore"):
        for _ in range(80):
            den = delta - t
            terms = z2[:, None] / den
            f = 1 + terms.sum(0)
            wide = np.abs(f) > EPS * k * (1 + np.abs(terms).sum(0))
            lo, hi = np.where(f < 0, t, lo), np.where(f < 0, hi, t)
            wide &= hi - lo > 2 * EPS * np.maximum(np.abs(lo), np.abs(hi))
            if not wide.any():
                break
            slopes = terms / den
            left = np.where(below, slopes, 0).sum(0)
            right = slopes.sum(0) - left
            near, far = den[j, j], top_delta - t
            c = f - near * left - far * right
            a = (near + far) * f - near * far * (left + right)
            b = near * far * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = t + step
            inside = np.isfinite(new) & (new > lo) & (new < hi)
            t = np.where(wide, np.where(inside, new, (lo + hi) / 2), t)
    return d[origin] + t, delta - t


def update(d: np.ndarray, q: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending eigenvalues and their vectors (columns) after adding u u^T; the inputs are not changed."""
    z = q.T @ u
    norm2 = float(z @ z)
    if norm2 == 0 or not np.isfinite(norm2):
        return d, q
    tol = 8 * EPS * max(float(np.abs(d).max()), norm2)
    live = np.abs(z) * np.sqrt(norm2) > tol
    at = np.flatnonzero(live)
    close = np.flatnonzero(np.diff(d[at]) * np.abs(z[at[:-1]] * z[at[1:]]) <= tol * (z[at[:-1]] ** 2 + z[at[1:]] ** 2)) if len(at) > 1 else ()
    if len(close):
        z, q = z.copy(), q.copy()
        for m in close:
            i, k = at[m], at[m + 1]
            r = np.hypot(z[i], z[k])
            c, s = z[k] / r, z[i] / r
            q[:, i], q[:, k] = c * q[:, i] - s * q[:, k], s * q[:, i] + c * q[:, k]
            z[i], z[k], live[i] = 0.0, r, False
        at = np.flatnonzero(live)
    if not len(at):
        return d, q
    z2 = z[at] ** 2
    values, den = _roots(d[at], z2)
    if len(at) > 1:
        apart = np.abs(d[at][:, None] - d[at][None, :])
        np.fill_diagonal(apart, 1.0)
        weight = np.exp((np.log(np.abs(den)).sum(1) - np.log(apart).sum(1)) / 2)
        w = np.copysign(weight, z[at])[:, None] / den
        w /= np.sqrt((w * w).sum(0))
    else:
        w = np.ones((1, 1))
    d, moved = d.copy(), q[:, at] @ w
    d[at] = values
    if len(at) == len(d):
        q = moved
    else:
        q = q.copy()
        q[:, at] = moved
    order = np.argsort(d, kind="stable")
    return (d, q) if (order[1:] > order[:-1]).all() else (d[order], q[:, order])
