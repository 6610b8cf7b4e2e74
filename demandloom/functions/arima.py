"""Seasonal ARIMA over a block of equally long monthly series: differences, orders and coefficients a series.

    phi(B) PHI(B^12) (w_t - c) = theta(B) THETA(B^12) e_t,   w = (1 - B)^d (1 - B^12)^D y

with phi(B) = 1 - phi_1 B - ..., theta(B) = 1 + theta_1 B + ... and one coefficient at most in PHI and
THETA. Every step works on all series of the block at once:

* D by a seasonal unit-root statistic (`seasonal_t`): a unit root, or a pattern of months that repeats,
  leaves its t-value above SEASONAL_CUT;
* d by KPSS: the series (or its seasonal difference) is differenced while the statistic of its
  partial sums lies above LEVEL_CUT;
* each order starts from a long autoregression, whose residuals stand for the shocks in one least
  squares fit (Hannan and Rissanen), and goes on by damped Gauss-Newton steps on the conditional sum
  of squares. The steps move the partial autocorrelations through tanh, so that every fit is
  stationary and invertible;
* the order with the smallest corrected information criterion over a common range of months;
* forecasts by the expanded recursion, deviations by its psi weights.

A series without variation keeps its value. A series too short for an order does not try it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SEASON = 12
# 5 % point of the KPSS statistic around a level; 5 % point of the seasonal t-value where both
# unit roots are there (our own simulation of series of 5 to 30 years; a test repeats it).
LEVEL_CUT = 0.463
SEASONAL_CUT = -1.78
#: orders tried: p, q up to 2 and a seasonal term on either side
ORDERS = tuple((p, q, sp, sq) for p in range(3) for q in range(3) for sp in range(2) for sq in range(2))
STEPS = 12
_EDGE = 0.98


def kpss(x: np.ndarray) -> np.ndarray:
    """The KPSS statistic of each series around its level, Bartlett weights over 4 (n / 100)^(1/4) lags."""
    n = x.shape[1]
    e = x - x.mean(axis=1, keepdims=True)
    lags = int(4 * (n / 100) ** 0.25)
    spread = (e ** 2).sum(axis=1) / n
    for k in range(1, lags + 1):
        spread = spread + 2 * (1 - k / (lags + 1)) * (e[:, k:] * e[:, :-k]).sum(axis=1) / n
    sums = np.cumsum(e, axis=1)
    return (sums ** 2).sum(axis=1) / n ** 2 / np.maximum(spread, 1e-12)


def seasonal_t(y: np.ndarray) -> np.ndarray:
    """t-value of last year's monthly change in a regression of the change of both differences.

    With a seasonal unit root the change a year ago says nothing about by how much this year's
    differs from it, beyond what the year's own change says; without one, it is undone.
    """
    month, year = np.diff(y, axis=1), y[:, SEASON:] - y[:, :-SEASON]
    columns = [x - x.mean(axis=1, keepdims=True) for x in (np.diff(year, axis=1), year[:, :-1], month[:, :-SEASON])]
    target, level, change = columns
    aa, ab, bb = (level ** 2).sum(axis=1), (level * change).sum(axis=1), (change ** 2).sum(axis=1)
    det = np.maximum(aa * bb - ab ** 2, 1e-12)
    ta, tb = (target * level).sum(axis=1), (target * change).sum(axis=1)
    beta_a, beta_b = (ta * bb - tb * ab) / det, (tb * aa - ta * ab) / det
    rest = ((target - beta_a[:, None] * level - beta_b[:, None] * change) ** 2).sum(axis=1) / max(target.shape[1] - 3, 1)
    return beta_b / np.sqrt(np.maximum(rest * aa / det, 1e-12))


def differences(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """d (0 to 2, with a seasonal difference 0 to 1) and D (0 or 1) of each series."""
    n, months = y.shape
    seasonal, plain = np.zeros(n, int), np.zeros(n, int)
    if months >= 4 * SEASON:
        seasonal = ((seasonal_t(y) > SEASONAL_CUT) & (y.std(axis=1) > 1e-9)).astype(int)
    for strength in (0, 1):
        rows = np.flatnonzero(seasonal == strength)
        if not len(rows):
            continue
        x = differenced(y[rows], 0, strength)
        for times in range(2 - strength):
            if x.shape[1] < SEASON:
                break
            more = (kpss(x) > LEVEL_CUT) & (x.std(axis=1) > 1e-9) & (plain[rows] == times)
            plain[rows[more]] += 1
            x = np.diff(x, axis=1)
    return plain, seasonal


def differenced(y: np.ndarray, d: int, seasonal: int) -> np.ndarray:
    for _ in range(seasonal):
        y = y[:, SEASON:] - y[:, :-SEASON]
    return np.diff(y, n=d, axis=1) if d else y


def _lagged(x: np.ndarray, k: int) -> np.ndarray:
    """x moved by k months, zeros before."""
    out = np.zeros_like(x)
    if k < x.shape[1]:
        out[:, k:] = x[:, :x.shape[1] - k]
    return out


def _least_squares(columns: list[np.ndarray], target: np.ndarray) -> np.ndarray:
    design = np.stack(columns, axis=2)
    gram = np.einsum("ntp,ntq->npq", design, design)
    size = np.trace(gram, axis1=1, axis2=2)[:, None, None] + 1e-9
    gram = gram + 1e-8 * size * np.eye(gram.shape[1])
    return np.linalg.solve(gram, np.einsum("ntp,nt->np", design, target)[..., None])[..., 0]


def _start(x: np.ndarray, order: tuple[int, int, int, int]) -> np.ndarray:
    """Coefficients (phi, theta, PHI, THETA) of each series by two regressions."""
    p, q, sp, sq = order
    n, months = x.shape
    if not any(order):
        return np.zeros((n, 0))
    long = min(max(p + q + 2, SEASON + 1 if sp or sq else 0), max(months // 3, 1))
    own = [_lagged(x, k)[:, long:] for k in range(1, long + 1)]
    shocks = np.zeros_like(x)
    shocks[:, long:] = x[:, long:] - np.einsum("ntp,np->nt", np.stack(own, axis=2), _least_squares(own, x[:, long:]))
    columns = [_lagged(x, k) for k in range(1, p + 1)] + [_lagged(shocks, k) for k in range(1, q + 1)]
    columns += [_lagged(x, SEASON)] * sp + [_lagged(shocks, SEASON)] * sq
    begin = min(long + (SEASON if sp or sq else 0), months - len(columns) - 2)
    return _least_squares([c[:, begin:] for c in columns], x[:, begin:])


def _to_partial(coefficients: np.ndarray) -> np.ndarray:
    """Partial autocorrelations of up to two coefficients, pulled inside the admissible region."""
    if coefficients.shape[1] < 2:
        return np.clip(coefficients, -_EDGE, _EDGE)
    second = np.clip(coefficients[:, 1], -_EDGE, _EDGE)
    return np.stack([np.clip(coefficients[:, 0] / (1 - second), -_EDGE, _EDGE), second], axis=1)


def _from_partial(r: np.ndarray) -> np.ndarray:
    return r if r.shape[1] < 2 else np.stack([r[:, 0] * (1 - r[:, 1]), r[:, 1]], axis=1)


def _free(start: np.ndarray, order: tuple[int, int, int, int]) -> np.ndarray:
    """Unbounded parameters of the starting coefficients."""
    p, q, sp, sq = order
    cut = np.cumsum([0, p, q, sp, sq])
    parts = [start[:, a:b] for a, b in zip(cut[:-1], cut[1:])]
    return np.arctanh(np.concatenate([_to_partial(parts[0]), _to_partial(-parts[1]), np.clip(parts[2], -_EDGE, _EDGE),
                                      np.clip(parts[3], -_EDGE, _EDGE)], axis=1))


def _bound(free: np.ndarray, order: tuple[int, int, int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """phi, theta, PHI, THETA of unbounded parameters."""
    p, q, sp, sq = order
    r = np.tanh(free)
    cut = np.cumsum([0, p, q, sp, sq])
    return _from_partial(r[:, :cut[1]]), -_from_partial(r[:, cut[1]:cut[2]]), r[:, cut[2]:cut[3]], r[:, cut[3]:]


def _expanded(short: np.ndarray, year: np.ndarray, sign: float) -> np.ndarray:
    """Coefficients of lags 1.. of the product of both polynomials, each 1 + sign * (c_1 B + ...)."""
    n, k = short.shape
    one = np.concatenate([np.ones((n, 1)), sign * short], axis=1)
    out = np.zeros((n, 1 + k + SEASON * year.shape[1]))
    out[:, :k + 1] = one
    if year.shape[1]:
        out[:, SEASON:SEASON + k + 1] += sign * year * one
    return out[:, 1:]


def residuals(x: np.ndarray, phi: np.ndarray, theta: np.ndarray, year_phi: np.ndarray, year_theta: np.ndarray) -> np.ndarray:
    """Shocks of each month, those before the first month and the deviations there taken as zero."""
    ar, ma = _expanded(phi, year_phi, -1.0), _expanded(theta, year_theta, 1.0)
    filtered = x.copy()
    for k in range(ar.shape[1]):
        if ar[:, k].any():
            filtered += ar[:, k:k + 1] * _lagged(x, k + 1)
    if not ma.shape[1]:
        return filtered
    lags = [k for k in range(ma.shape[1]) if ma[:, k].any()]
    out = filtered.T.copy()
    weights = [ma[:, k] for k in lags]
    for t in range(1, len(out)):
        for k, w in zip(lags, weights):
            if k < t:
                out[t] -= w * out[t - 1 - k]
    return out.T


@dataclass
class Fit:
    """One order fitted to a block: centred series, coefficients, shocks and criterion."""

    centre: np.ndarray
    parts: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    shocks: np.ndarray
    variance: np.ndarray
    criterion: np.ndarray


def fit_order(w: np.ndarray, order: tuple[int, int, int, int], mean: bool, begin: int) -> Fit:
    """Conditional least squares of one order; squares count from month `begin` on."""
    n, months = w.shape
    centre = w.mean(axis=1) if mean else np.zeros(n)
    x = w - centre[:, None]
    free = _free(_start(x, order), order)

    def shocks_of(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        return residuals(x[rows], *_bound(values, order))

    # each series moves until it no longer gains, whatever the others of the block do
    going = np.arange(n)
    shocks = shocks_of(going, free)
    total = (shocks[:, begin:] ** 2).sum(axis=1)
    damping = np.full(n, 1e-3)
    for _ in range(STEPS if any(order) else 0):
        now, at = shocks[going], free[going]
        slope = np.stack([(shocks_of(going, at + 1e-5 * (np.arange(at.shape[1]) == k)) - now)[:, begin:] / 1e-5
                          for k in range(at.shape[1])], axis=2)
        gram = np.einsum("ntp,ntq->npq", slope, slope)
        pull = np.einsum("ntp,nt->np", slope, now[:, begin:])
        scale = np.einsum("npp->np", gram) + 1e-9 * (1 + np.einsum("npp->n", gram)[:, None])
        step = np.linalg.solve(gram + (damping[going][:, None] * scale)[:, :, None] * np.eye(at.shape[1]), -pull[..., None])[..., 0]
        tried = np.clip(at + np.clip(step, -1, 1), -np.arctanh(_EDGE), np.arctanh(_EDGE))
        new = shocks_of(going, tried)
        squares = (new[:, begin:] ** 2).sum(axis=1)
        better = squares < total[going]
        gain = np.where(better, (total[going] - squares) / np.maximum(total[going], 1e-12), 0.0)
        won = going[better]
        free[won], shocks[won], total[won] = tried[better], new[better], squares[better]
        damping[going] = np.clip(np.where(better, damping[going] / 5, damping[going] * 10), 1e-6, 1e6)
        going = going[np.where(better, gain > 1e-7, damping[going] < 1e3)]
        if not len(going):
            break
    used = months - begin
    k = sum(order) + int(mean) + 1
    variance = total / max(used - k + 1, 1)
    criterion = used * np.log(total / used + 1e-9) + 2 * k + 2 * k * (k + 1) / max(used - k - 1, 1)
    return Fit(centre, _bound(free, order), shocks, variance, criterion)


def _history(order: tuple[int, int, int, int], months: int) -> bool:
    p, q, sp, sq = order
    return months >= (3 * SEASON + 6 if sp or sq else 12) + 3 * sum(order)


def _integrated(ar: np.ndarray, d: int, seasonal: int) -> np.ndarray:
    """Lag coefficients of y itself: the autoregression times the differences (as 1 + c_1 B + ...)."""
    poly = np.concatenate([np.ones((len(ar), 1)), ar], axis=1)
    for lag, times in ((1, d), (SEASON, seasonal)):
        for _ in range(times):
            longer = np.zeros((len(poly), poly.shape[1] + lag))
            longer[:, :poly.shape[1]] += poly
            longer[:, lag:] -= poly
            poly = longer
    return poly[:, 1:]


def forecast(y: np.ndarray, fit: Fit, d: int, seasonal: int, h: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of h months ahead."""
    phi, theta, year_phi, year_theta = fit.parts
    ar, ma = _expanded(phi, year_phi, -1.0), _expanded(theta, year_theta, 1.0)
    full = _integrated(ar, d, seasonal)
    # a constant of the differenced series enters every month
    drift = fit.centre * (1 + ar.sum(axis=1))
    path = np.concatenate([np.zeros((len(y), full.shape[1])), y], axis=1) if full.shape[1] > y.shape[1] else y
    shocks = np.concatenate([np.zeros((len(y), SEASON + 3)), fit.shocks], axis=1)
    n = path.shape[1]
    out = np.concatenate([path, np.zeros((len(y), h))], axis=1)
    for k in range(h):
        value = drift.copy()
        for lag in range(full.shape[1]):
            value -= full[:, lag] * out[:, n + k - 1 - lag]
        for lag in range(k, ma.shape[1]):
            value += ma[:, lag] * shocks[:, shocks.shape[1] + k - 1 - lag]
        out[:, n + k] = value
    psi = np.zeros((len(y), h))
    psi[:, 0] = 1.0
    for k in range(1, h):
        value = ma[:, k - 1].copy() if k <= ma.shape[1] else np.zeros(len(y))
        for lag in range(min(k, full.shape[1])):
            value -= full[:, lag] * psi[:, k - 1 - lag]
        psi[:, k] = value
    return out[:, n:], np.sqrt(fit.variance[:, None] * np.cumsum(psi ** 2, axis=1))


@dataclass
class Chosen:
    """What was chosen for each series of a block, and its forecast."""

    d: np.ndarray
    seasonal: np.ndarray
    orders: np.ndarray
    coefficients: list
    mean: np.ndarray
    sd: np.ndarray


def arima(y: np.ndarray, h: int, orders=ORDERS, given: tuple[int, int] | None = None) -> Chosen:
    """Differences (unless given as d and D), order and coefficients of every series, and its forecast for h months."""
    y = np.asarray(y, float)
    n = len(y)
    d, seasonal = differences(y) if given is None else (np.full(n, given[0]), np.full(n, given[1]))
    out = Chosen(d, seasonal, np.zeros((n, 4), int), [None] * n, np.repeat(y[:, -1:], h, axis=1), np.zeros((n, h)))
    flat = y.std(axis=1) <= 1e-9
    for key in sorted(set(zip(d[~flat].tolist(), seasonal[~flat].tolist()))):
        rows = np.flatnonzero((d == key[0]) & (seasonal == key[1]) & ~flat)
        # fits run on series of one size, so that steps and stops do not depend on units
        scale = y[rows].std(axis=1, keepdims=True)
        w = differenced(y[rows] / scale, *key)
        possible = [o for o in orders if _history(o, w.shape[1])] or [(0, 0, 0, 0)]
        begin = max(o[0] + SEASON * o[2] for o in possible)
        begin = begin if w.shape[1] - begin >= 2 * SEASON else 0
        best = np.full(len(rows), np.inf)
        for order in possible:
            fit = fit_order(w, order, sum(key) < 2, begin)
            better = np.flatnonzero(fit.criterion < best - 1e-9)
            if not len(better):
                continue
            best[better] = fit.criterion[better]
            part = Fit(fit.centre[better], tuple(c[better] for c in fit.parts), fit.shocks[better], fit.variance[better], fit.criterion[better])
            mean, sd = forecast(y[rows[better]] / scale[better], part, *key, h)
            at = rows[better]
            out.mean[at], out.sd[at] = mean * scale[better], sd * scale[better]
            out.orders[at] = order
            for i, row in enumerate(at):
                out.coefficients[row] = tuple(c[i] for c in part.parts)
    return out


def fixed_airline(y: np.ndarray, h: int, theta: float = -0.4, year_theta: float = -0.6) -> tuple[np.ndarray, np.ndarray]:
    """Forecast of the (0,1,1)(0,1,1) model with given coefficients: only the shocks are worked out."""
    y = np.asarray(y, float)
    w = differenced(y, 1, 1)
    n = len(w)
    parts = (np.zeros((n, 0)), np.full((n, 1), theta), np.zeros((n, 0)), np.full((n, 1), year_theta))
    shocks = residuals(w, *parts)
    return forecast(y, Fit(np.zeros(n), parts, shocks, (shocks ** 2).mean(axis=1), np.zeros(n)), 1, 1, h)
