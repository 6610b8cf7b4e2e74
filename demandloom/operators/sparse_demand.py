"""Forecasting of series with few demands, by one Arrow function over blocks of equally long series.

    tsb     demand probability smoothed every month, demand size in months with demand; their product
    adida   months added up into periods of the mean interval between demands, smoothed, spread evenly
    imapa   the mean of such forecasts over all period lengths from one month to that interval

All three smooth with fixed weights and give one level for every month ahead. A period counts back
from the newest month, and the oldest months that fill no period are left out. A series without any
demand is forecast as 0 by all of them; one without months has no forecast.

A block holds its series side by side: `y` is months x series, `gone` marks NULL values and is None
where there are none. A period with a NULL month has no total, smoothing starts anew behind it, and
for the demand probability it is a month without demand.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Weights of new months in the smoothed size, probability and period totals.
SIZE_WEIGHT = 0.2
CHANCE_WEIGHT = 0.1
PERIOD_WEIGHT = 0.2


def _hits(y: np.ndarray, gone: np.ndarray | None) -> np.ndarray:
    """Months with demand; a NaN is above zero, as in Spark."""
    hit = (y > 0) | np.isnan(y)
    return hit if gone is None else hit & ~gone


def smoothed(values: np.ndarray, gone: np.ndarray | None, weight: float = PERIOD_WEIGHT):
    """Exponential smoothing from the first value on: the last level and where it is NULL."""
    level = values[0]
    for i in range(1, len(values)):
        step = level + weight * (values[i] - level)
        level = step if gone is None else np.where(gone[i - 1] | gone[i], values[i], step)
    return level, None if gone is None else gone[-1]


def periods(y: np.ndarray, gone: np.ndarray | None, length: int):
    """Totals of consecutive periods of `length` months that end with the newest month."""
    whole = len(y) // length
    shape = (whole, length, y.shape[1])
    spans = y[len(y) - whole * length:].reshape(shape)
    total = 0.0 + spans[:, 0]
    for month in range(1, length):
        total += spans[:, month]
    return total, None if gone is None else gone[len(y) - whole * length:].reshape(shape).any(axis=1)


def mean_interval(y: np.ndarray, gone: np.ndarray | None) -> np.ndarray:
    """Months per demand, rounded, at least 1 and at most half of the series."""
    hits, most = _hits(y, gone).sum(axis=0), len(y) // 2
    rounded = (2 * len(y) + hits) // np.maximum(2 * hits, 1)
    return np.maximum(1, np.where(hits > 0, np.minimum(rounded, most), most))


def _of(series: slice | np.ndarray, y: np.ndarray, gone: np.ndarray | None):
    return y[:, series], None if gone is None else gone[:, series]


def _spread(y: np.ndarray, gone: np.ndarray | None, length: int):
    """Smoothed period totals a month."""
    level, none = smoothed(*periods(y, gone, length))
    return level / length, none


def tsb(y: np.ndarray, gone: np.ndarray | None):
    """Probability of a demand times its size; both start from the first demand and the share of months with one."""
    hit = _hits(y, gone)
    size, chance = y[hit.argmax(axis=0), np.arange(y.shape[1])], hit.sum(axis=0) / len(y)
    for v, h in zip(y, hit):
        size = np.where(h, size + SIZE_WEIGHT * (v - size), size)
        chance = chance + CHANCE_WEIGHT * (h - chance)
    return np.where(hit.any(axis=0), size * chance, 0.0), None


def adida(y: np.ndarray, gone: np.ndarray | None):
    lengths = mean_interval(y, gone)
    out, none = np.zeros(len(lengths)), np.zeros(len(lengths), dtype=bool)
    for length in np.unique(lengths):
        some = np.flatnonzero(lengths == length)
        out[some], unknown = _spread(*_of(some, y, gone), int(length))
        none[some] = False if unknown is None else unknown
    return out, none


def imapa(y: np.ndarray, gone: np.ndarray | None):
    lengths = mean_interval(y, gone)
    order = np.argsort(-lengths, kind="stable")  # those that still take part come first
    y, gone = _of(order, y, gone)
    total, none = np.zeros(len(lengths)), np.zeros(len(lengths), dtype=bool)
    for length in range(1, int(lengths.max()) + 1):
        some = slice(0, int((lengths >= length).sum()))
        level, unknown = _spread(*_of(some, y, gone), length)
        total[some] += level
        none[some] |= False if unknown is None else unknown
    out, nulls = np.empty_like(total), np.empty_like(none)
    out[order], nulls[order] = total / lengths[order], none
    return out, nulls


_BLOCKS = {"tsb": tsb, "adida": adida, "imapa": imapa}


def _blocks(y: pa.Array, wanted: dict[str, np.ndarray]) -> dict[str, pa.Array]:
    """Levels of the rows wanted of each method; rows of the same length are computed as one block."""
    values, lengths = y.flatten(), pc.list_value_length(y).fill_null(0).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    months = values.to_numpy(zero_copy_only=False)
    nulls = values.is_null().to_numpy(zero_copy_only=False) if values.null_count else None
    out = {name: (np.zeros(len(y)), np.ones(len(y), dtype=bool)) for name in wanted}
    with np.errstate(all="ignore"):
        for n in np.unique(lengths[lengths > 0]):
            same = lengths == n
            for name, chosen in wanted.items():
                rows = np.flatnonzero(same & chosen)
                if len(rows):
                    at = starts[rows] + np.arange(n)[:, None]
                    gone = None if nulls is None or not nulls[at].any() else nulls[at]
                    levels, none = out[name]
                    levels[rows], unknown = _BLOCKS[name](months[at], gone)
                    none[rows] = False if unknown is None else unknown
    return {name: pa.array(levels, pa.float64(), mask=none) for name, (levels, none) in out.items()}


@F.arrow_udf(T.DoubleType())
def _level(model: pa.Array, y: pa.Array) -> pa.Array:
    wanted = {name: pc.equal(model, name).fill_null(False).to_numpy(zero_copy_only=False) for name in _BLOCKS}
    out = pa.nulls(len(y), pa.float64())
    for name, levels in _blocks(y, wanted).items():
        out = pc.if_else(pa.array(wanted[name]), levels, out)
    return out


@F.arrow_udf(T.StructType([T.StructField(name, T.DoubleType()) for name in _BLOCKS]))
def _levels(y: pa.Array) -> pa.Array:
    all_rows = np.ones(len(y), dtype=bool)
    made = _blocks(y, {name: all_rows for name in _BLOCKS})
    return pa.StructArray.from_arrays(list(made.values()), names=list(made))


def level(model: Column, y: Column) -> Column:
    """What the method named by `model` makes of an array of months; NULL for any other model."""
    return _level(model, y.cast("array<double>"))


def levels(y: Column) -> Column:
    """What every method makes of an array of months, one field each."""
    return _levels(y.cast("array<double>"))


METHODS = {name: (lambda y, name=name: level(F.lit(name), y)) for name in _BLOCKS}
