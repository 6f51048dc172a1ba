"""Numeric kernels over one daily series each. A series has at most one value per calendar day."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# Kernels travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

def loess(y: np.ndarray, width: int, weights: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """Local linear fit with tricube weights over the nearest ``width`` points."""
    n = len(y)
    at = np.arange(n, dtype=float) if at is None else at
    q = min(width, n)
    start = np.clip(np.floor(at).astype(int) - q // 2, 0, n - q)
    near = start[:, None] + np.arange(q)
    distance = np.abs(near - at[:, None])
    reach = np.maximum(distance.max(axis=1) + max(0, (width - n) // 2), 1e-12)[:, None]
    u = distance / reach
    w = np.where(u <= 0.999, (1 - np.minimum(u, 1) ** 3) ** 3, 0.0) * weights[near]
    total = w.sum(axis=1, keepdims=True)
    w = np.where(total > 0, w / np.where(total > 0, total, 1), 1.0 / q)
    centre = (w * near).sum(axis=1, keepdims=True)
    spread = (w * (near - centre) ** 2).sum(axis=1, keepdims=True)
    usable = np.sqrt(spread) > 0.001 * max(n - 1, 1)
    slope = np.where(usable, (at[:, None] - centre) * (near - centre) / np.where(usable, spread, 1), 0.0)
    return (w * (1 + slope) * y[near]).sum(axis=1)


def _mean_filter(x: np.ndarray, width: int) -> np.ndarray:
    return np.convolve(x, np.ones(width) / width, mode="valid")


def seasonal_trend(y: np.ndarray, period: int = 7, seasonal: int = 7, rounds: int = 15) -> tuple[np.ndarray, np.ndarray]:
    """Robust seasonal-trend decomposition by loess: seasonal and trend parts."""
    y = np.asarray(y, float)
    n = len(y)
    trend_width = math.ceil(1.5 * period / (1 - 1.5 / seasonal))
    trend_width += 1 - trend_width % 2
    low_width = period + 1 + period % 2
    trend, weights = np.zeros(n), np.ones(n)
    for _ in range(rounds):
        for _ in range(2):
            cycle = np.empty(n + 2 * period)
            for p in range(period):
                part = (y - trend)[p::period]
                cycle[p::period] = loess(part, seasonal, weights[p::period], np.arange(-1.0, len(part) + 1))
            low = _mean_filter(_mean_filter(_mean_filter(cycle, period), period), 3)
            season = cycle[period : period + n] - loess(low, low_width, np.ones(n))
            trend = loess(y - season, trend_width, weights)
        rest = np.abs(y - season - trend)
        limit = 6 * np.median(rest)
        if limit <= 0:
            break
        u = rest / limit
        weights = np.where(u <= 0.001, 1.0, np.where(u >= 0.999, 0.0, (1 - np.minimum(u, 1) ** 2) ** 2))
    return season, trend


def strength(y: np.ndarray) -> float:
    season, trend = seasonal_trend(y)
    v = float(np.var(season))
    return v / (v + float(np.var(y - season - trend)) + 1e-9)


def spectrum_peaks(y: np.ndarray) -> tuple[bool, bool]:
    """Whether the one-sided periodogram at 7 and at 365 days exceeds three times its median."""
    y = np.asarray(y, float)
    power = np.abs(np.fft.rfft(y - y.mean())) ** 2
    power[1 : len(power) - (len(y) % 2 == 0)] *= 2
    with np.errstate(divide="ignore"):
        periods = len(y) / np.arange(len(power))
    base = 3 * np.median(power)
    weekly = power[np.argmin(np.abs(periods - 7))] > base
    annual = len(periods) > 365 and power[np.argmin(np.abs(periods - 365))] > base
    return bool(weekly), bool(annual)


@pandas_udf(T.DoubleType())
def seasonal_strength(y: pd.Series) -> pd.Series:
    return y.map(lambda v: strength(np.asarray(v)) if len(v) >= 14 else None).astype("float64")


@pandas_udf(T.StructType([T.StructField(n, T.BooleanType()) for n in ("weekly", "annual")]))
def spectral_flags(y: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([spectrum_peaks(np.asarray(v)) for v in y], columns=["weekly", "annual"])
