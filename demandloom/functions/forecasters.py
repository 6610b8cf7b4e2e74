"""Small univariate forecasters over a block of equally long monthly series.

Each takes a matrix (series x months) and a horizon and returns the forecast and its
standard deviation per step, both (series x horizon). They run inside an Arrow-batched
column function: Spark owns partitioning, cutting, scoring and selection.

A series too short for a method has no forecast by it (NaN throughout); no other method
steps in under the same name. LEAST names the months each one needs.
"""

from __future__ import annotations

from functools import wraps

import numpy as np

from demandloom.functions import arima as seasonal_arima

SEASON = 12
#: months a method needs; those not named take any
LEAST = {"seasonal_naive": SEASON, "ets": 2 * SEASON, "theta": 2 * SEASON, "mfles": 2 * SEASON,
         "auto_ar": 2 * SEASON + 6, "auto": 2 * SEASON, "arima": 2 * SEASON, "airline": 2 * SEASON + 2}


def _long_enough(method):
    """The method, with NaN for series of fewer months than it needs."""
    @wraps(method)
    def guarded(y: np.ndarray, h: int, **settings):
        if y.shape[1] < LEAST[method.__name__]:
            return np.full((len(y), h), np.nan), np.full((len(y), h), np.nan)
        return method(y, h, **settings)
    return guarded


def _steps(h: int) -> np.ndarray:
    return np.arange(1, h + 1)


def _sd(errors: np.ndarray) -> np.ndarray:
    if errors.shape[1] < 2:
        return np.zeros((errors.shape[0], 1))
    return errors.std(axis=1, ddof=1, keepdims=True)


def _running_sd(total: np.ndarray, squares: np.ndarray, count: int) -> np.ndarray:
    """Sample deviation from a running sum and sum of squares."""
    spread = np.maximum(squares - total ** 2 / max(count, 1), 0.0)
    return np.sqrt(spread / max(count - 1, 1))[:, None]


def _flat(level: np.ndarray, errors: np.ndarray, h: int):
    return np.repeat(level[:, None], h, axis=1), np.repeat(_sd(errors), h, axis=1)


def _slope(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares slope per series and the centred time it refers to."""
    time = np.arange(y.shape[1]) - (y.shape[1] - 1) / 2
    return (y * time).sum(axis=1) / max((time ** 2).sum(), 1e-12), time


def _seasonal_means(y: np.ndarray) -> np.ndarray:
    """Additive monthly effects around a straight line, summing to zero."""
    slope, time = _slope(y)
    around = y - y.mean(axis=1, keepdims=True) - slope[:, None] * time
    effects = np.stack([around[:, m::SEASON].mean(axis=1) for m in range(SEASON)], axis=1)
    return effects - effects.mean(axis=1, keepdims=True)


def _smooth(y: np.ndarray, alphas=(0.05, 0.1, 0.2, 0.3, 0.5, 0.8)):
    """Exponential smoothing with the best of a few weights: level, weight, one-step deviation."""
    a = np.asarray(alphas)[:, None]
    level = np.repeat(y[None, :, 0], len(alphas), axis=0)
    total, squares = np.zeros_like(level), np.zeros_like(level)
    for t in range(1, y.shape[1]):
        e = y[:, t] - level
        level = level + a * e
        total, squares = total + e, squares + e ** 2
    best, rows = squares.argmin(axis=0), np.arange(y.shape[0])
    sd = _running_sd(total[best, rows], squares[best, rows], y.shape[1] - 1)
    return level[best, rows], np.asarray(alphas)[best], sd


@_long_enough
def seasonal_naive(y: np.ndarray, h: int):
    mean = y[:, -SEASON:][:, np.arange(h) % SEASON]
    growth = np.sqrt(np.arange(h) // SEASON + 1)
    return mean, _sd(y[:, SEASON:] - y[:, :-SEASON]) * growth


def croston_sba(y: np.ndarray, h: int, alpha: float = 0.1):
    """Smoothed demand size over smoothed interval, with the Syntetos-Boylan correction."""
    n, months = y.shape
    hit = y > 0
    first = np.where(hit.any(axis=1), hit.argmax(axis=1), months - 1)
    size = y[np.arange(n), first].astype(float)
    gap = first + 1.0
    since = np.ones(n)
    errors = np.zeros((n, months))
    for t in range(months):
        errors[:, t] = y[:, t] - (1 - alpha / 2) * size / gap
        update = hit[:, t] & (t > first)
        size = np.where(update, size + alpha * (y[:, t] - size), size)
        gap = np.where(update, gap + alpha * (since - gap), gap)
        since = np.where(hit[:, t], 1.0, since + 1)
    return _flat((1 - alpha / 2) * size / gap, errors, h)


@_long_enough
def ets(y: np.ndarray, h: int, damping: float = 0.95):
    """Additive damped-trend exponential smoothing, weights chosen per series from a grid."""
    n, months = y.shape
    grid = np.array([(a, b, g) for a in (0.05, 0.2, 0.5) for b in (0.0, 0.1) for g in (0.0, 0.1, 0.3)])
    a, b, g = (grid[:, i][:, None] for i in range(3))
    shape = (len(grid), n)
    level = np.broadcast_to(y[:, :SEASON].mean(axis=1), shape).copy()
    trend = np.zeros(shape)
    season = np.broadcast_to(_seasonal_means(y), shape + (SEASON,)).copy()
    total, squares = np.zeros(shape), np.zeros(shape)
    for t in range(months):
        s = t % SEASON
        base = level + damping * trend
        e = y[:, t] - base - season[:, :, s]
        level, trend = base + a * e, damping * trend + a * b * e
        season[:, :, s] += g * e
        total, squares = total + e, squares + e ** 2
    best, rows = squares.argmin(axis=0), np.arange(n)
    level, trend, season, total, squares = (x[best, rows] for x in (level, trend, season, total, squares))
    damped = np.cumsum(damping ** _steps(h))
    mean = level[:, None] + trend[:, None] * damped + season[:, (months + np.arange(h)) % SEASON]
    weight = grid[best, 0][:, None]
    return mean, _running_sd(total, squares, months) * np.sqrt(1 + (_steps(h) - 1) * weight ** 2)


@_long_enough
def theta(y: np.ndarray, h: int):
    """Smoothing of the deseasonalised series with half of its linear drift."""
    n, months = y.shape
    effects = _seasonal_means(y)
    position = np.arange(months) % SEASON
    x = y - effects[:, position]
    slope, _time = _slope(x)
    level, alpha, sd = _smooth(x)
    drift = (_steps(h) - 1)[None, :] + ((1 - (1 - alpha) ** months) / alpha)[:, None]
    mean = level[:, None] + 0.5 * slope[:, None] * drift + effects[:, (months + np.arange(h)) % SEASON]
    return mean, sd * np.sqrt(1 + (_steps(h) - 1) * alpha[:, None] ** 2)


def _autoregress(x: np.ndarray, order: int, h: int):
    """Least-squares autoregression: forecast, residuals and an information criterion."""
    n, months = x.shape
    columns = [np.ones((n, months - order))] + [x[:, order - k:months - k] for k in range(1, order + 1)]
    design = np.stack(columns, axis=2)
    target = x[:, order:]
    gram = np.einsum("ntp,ntq->npq", design, design) + 1e-6 * np.eye(order + 1)
    beta = np.linalg.solve(gram, np.einsum("ntp,nt->np", design, target)[..., None])[..., 0]
    residual = target - np.einsum("ntp,np->nt", design, beta)
    path = x[:, months - order:] if order else x[:, :0]
    ahead = []
    for _ in range(h):
        step = beta[:, 0] + sum(beta[:, k] * path[:, -k] for k in range(1, order + 1))
        step = np.clip(step, -2 * np.abs(x).max(axis=1), 2 * np.abs(x).max(axis=1))
        path = np.concatenate([path, step[:, None]], axis=1)
        ahead.append(step)
    count = target.shape[1]
    aic = count * np.log((residual ** 2).mean(axis=1) + 1e-9) + 2 * (order + 1)
    return np.stack(ahead, axis=1), residual, aic / count


@_long_enough
def auto_ar(y: np.ndarray, h: int):
    """Autoregression of order 0-3 on the series or on its seasonal differences, best by criterion."""
    n, months = y.shape
    options = []
    for order in range(4):
        mean, residual, aic = _autoregress(y, order, h)
        options.append((aic, mean, _sd(residual)))
        diff, residual, aic = _autoregress(y[:, SEASON:] - y[:, :-SEASON], order, h)
        path = y[:, -SEASON:]
        for k in range(h):
            path = np.concatenate([path, (path[:, k] + diff[:, k])[:, None]], axis=1)
        options.append((aic, path[:, SEASON:], _sd(residual)))
    best = np.stack([o[0] for o in options]).argmin(axis=0)
    rows = np.arange(n)
    mean = np.stack([o[1] for o in options])[best, rows]
    sd = np.stack([o[2] for o in options])[best, rows]
    return mean, np.repeat(sd, h, axis=1)


@_long_enough
def arima(y: np.ndarray, h: int):
    """Seasonal ARIMA, differences and orders chosen per series."""
    out = seasonal_arima.arima(y, h)
    # a root near one lets a path run away: no month is further from the past than its whole range, twice
    reach = 2 * (y.max(axis=1) - y.min(axis=1))[:, None]
    return np.clip(out.mean, y.min(axis=1)[:, None] - reach, y.max(axis=1)[:, None] + reach), out.sd


@_long_enough
def airline(y: np.ndarray, h: int):
    """The (0,1,1)(0,1,1) ARIMA with fixed coefficients."""
    return seasonal_arima.fixed_airline(y, h)


def _waves(t: np.ndarray, harmonics: int) -> np.ndarray:
    angle = 2 * np.pi * np.outer(t, np.arange(1, harmonics + 1)) / SEASON
    return np.concatenate([np.sin(angle), np.cos(angle)], axis=1)


def fourier_trend(y: np.ndarray, h: int):
    """Ridge regression on a piecewise-linear trend and yearly waves, solved once for all series."""
    n, months = y.shape
    t = np.arange(months + h)
    knots = np.linspace(0, 0.8 * months, 6)[1:]
    hinges = np.maximum(t[:, None] - knots, 0) / months
    design = np.concatenate([np.ones((len(t), 1)), t[:, None] / months, hinges, _waves(t, 3)], axis=1)
    penalty = np.diag([1e-6, 0.1] + [5.0] * len(knots) + [0.5] * 6)
    seen = design[:months]
    beta = np.linalg.solve(seen.T @ seen + penalty, seen.T @ y.T)
    fit = (design @ beta).T
    return fit[:, months:], np.repeat(_sd(y - fit[:, :months]), h, axis=1)


@_long_enough
def mfles(y: np.ndarray, h: int, rounds: int = 10, rate: float = 0.5):
    """Boosted decomposition: median, then repeated damped fits of trend, waves and level."""
    n, months = y.shape
    t = np.arange(months + h)
    line = np.stack([np.ones(len(t)), t / months], axis=1)
    bases = [line, _waves(t, 2)]
    fit = np.repeat(np.median(y, axis=1)[:, None], months + h, axis=1)
    for _ in range(rounds):
        for base in bases:
            beta, *_rest = np.linalg.lstsq(base[:months], (y - fit[:, :months]).T, rcond=None)
            fit = fit + rate * (base @ beta).T
    level, _alpha, sd = _smooth(y - fit[:, :months])
    return fit[:, months:] + level[:, None], np.repeat(sd, h, axis=1)


MODELS = {
    "ets": ets, "theta": theta, "arima": arima, "mfles": mfles,
    "croston_sba": croston_sba, "fourier_trend": fourier_trend,
}
AUTO_CANDIDATES = ("seasonal_naive", "ets", "theta", "croston_sba")


@_long_enough
def auto(y: np.ndarray, h: int):
    """The candidate with the smallest error on the last year, refitted on everything.

    Candidates that the months before the last year are too few for do not take part.
    """
    candidates = [seasonal_naive if c == "seasonal_naive" else MODELS[c] for c in AUTO_CANDIDATES]
    past, recent = y[:, :-SEASON], y[:, -SEASON:]
    misses = np.stack([np.abs(np.maximum(f(past, SEASON)[0], 0) - recent).mean(axis=1) for f in candidates])
    best = np.nan_to_num(misses, nan=np.inf).argmin(axis=0)
    mean, sd = np.zeros((len(y), h)), np.zeros((len(y), h))
    for i, f in enumerate(candidates):
        chosen = best == i
        if chosen.any():
            mean[chosen], sd[chosen] = f(y[chosen], h)
    return mean, sd


FITTED = {**MODELS, "auto_ar": auto_ar, "airline": airline, "seasonal_naive": seasonal_naive, "auto": auto}
