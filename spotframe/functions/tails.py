"""Tail probabilities of test statistics, applied to small result tables as Arrow UDFs."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

_erfc = np.vectorize(math.erfc, otypes=[float])
_lgamma = np.vectorize(math.lgamma, otypes=[float])
TINY = 1e-300
EXACT_SIDE = 8
#: Degrees of freedom from which the t distribution is taken as normal.
NORMAL_FROM = 1e8


def _normal_two_sided(z: np.ndarray) -> np.ndarray:
    return np.minimum(1.0, _erfc(np.abs(z) / math.sqrt(2.0)))


def _continued_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz steps, all rows at once)."""
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < TINY, TINY, d)
    value = d.copy()
    for m in range(1, 400):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / np.where(np.abs(d) < TINY, TINY, d)
            c = 1.0 + numerator / c
            c = np.where(np.abs(c) < TINY, TINY, c)
            step = c * d
            value *= step
        if np.all(np.abs(step - 1.0) < 1e-15):
            break
    return value


def _incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    front = np.exp(_lgamma(a + b) - _lgamma(a) - _lgamma(b) + a * np.log(np.maximum(x, TINY)) + b * np.log(np.maximum(1.0 - x, TINY)))
    lower = x < (a + 1.0) / (a + b + 2.0)
    direct = front * _continued_beta(a, b, x) / a
    mirrored = 1.0 - front * _continued_beta(b, a, 1.0 - x) / b
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, np.where(lower, direct, mirrored)))


def _t_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    # the continued fraction needs more steps than it is given from here on; the limit is then right to its last digits
    wide = df > NORMAL_FROM
    some = np.where(wide, 1.0, df)
    return np.where(wide, _normal_two_sided(t), np.clip(_incomplete_beta(some / 2.0, np.full_like(df, 0.5), some / (some + t * t)), 0.0, 1.0))


def _chi2_upper_one(x: float, df: float) -> float:
    """Upper tail of the chi-squared distribution by series or continued fraction."""
    if not (x == x and df > 0):
        return float("nan")
    if x <= 0:
        return 1.0
    a, h = df / 2.0, x / 2.0
    scale = math.exp(a * math.log(h) - h - math.lgamma(a))
    if h < a + 1.0:
        term = total = 1.0 / a
        k = a
        while term > total * 1e-16:
            k += 1.0
            term *= h / k
            total += term
        return max(0.0, 1.0 - scale * total)
    b = h + 1.0 - a
    c, d = 1.0 / TINY, 1.0 / b
    value = d
    for i in range(1, 1000):
        n = -i * (i - a)
        b += 2.0
        d = 1.0 / (n * d + b or TINY)
        c = b + n / c or TINY
        step = c * d
        value *= step
        if abs(step - 1.0) < 1e-15:
            break
    else:
        # not converged: the cube root of x / df is close to normal for the large df that this takes
        z = ((x / df) ** (1.0 / 3.0) - 1.0 + 2.0 / (9.0 * df)) / math.sqrt(2.0 / (9.0 * df))
        return 0.5 * math.erfc(z / math.sqrt(2.0))
    return scale * value


def _exact_u(u: float, n1: int, n2: int) -> float:
    """Two-sided exact p of the U statistic: counts of subsets by their rank sum, up to the smaller tail only."""
    tail = int(round(min(u, n1 * n2 - u)))
    ways = np.zeros(tail + 1)
    ways[0] = 1.0
    few, many = sorted((n1, n2))
    # the generating function is a Gaussian binomial: product of (1 - q^(many + i)) / (1 - q^i)
    for i in range(1, few + 1):
        top = many + i
        if top <= tail:
            shifted = np.zeros_like(ways)
            shifted[top:] = ways[: ways.size - top]
            ways = ways - shifted
        # dividing by 1 - q^i: running sums with stride i
        padded = np.zeros(-(-ways.size // i) * i)
        padded[: ways.size] = ways
        ways = padded.reshape(-1, i).cumsum(axis=0).ravel()[: tail + 1]
    return float(min(1.0, 2.0 * ways.sum() / math.comb(n1 + n2, few)))


@F.pandas_udf(T.DoubleType())
def t_p(t: pd.Series, df: pd.Series) -> pd.Series:
    ok = t.notna() & df.notna() & (df > 0)
    out = pd.Series(np.nan, index=t.index, dtype=float)
    out[ok] = _t_two_sided(t[ok].to_numpy(float), df[ok].to_numpy(float))
    return out.astype(object).where(out.notna(), None)


@F.pandas_udf(T.DoubleType())
def chi2_p(x: pd.Series, df: pd.Series) -> pd.Series:
    out = pd.Series([_chi2_upper_one(float(a), float(b)) if a == a and a is not None and b == b and b is not None else None for a, b in zip(x, df)])
    return out.astype(object).where(out.notna(), None)


@F.pandas_udf(T.DoubleType())
def u_p(u: pd.Series, n1: pd.Series, n2: pd.Series, ties: pd.Series) -> pd.Series:
    """Two-sided Mann-Whitney p: exact where one side has at most 8 values and none tie, else normal."""
    out = []
    for uu, a, b, t in zip(u, n1, n2, ties):
        if uu is None or uu != uu or a < 2 or b < 2:
            out.append(None)
        elif min(a, b) <= EXACT_SIDE and t == 0:
            out.append(_exact_u(float(uu), int(a), int(b)))
        else:
            n = a + b
            spread = math.sqrt(a * b / 12.0 * ((n + 1.0) - t / (n * (n - 1.0))))
            larger = max(uu, a * b - uu)
            z = (larger - a * b / 2.0 - 0.5) / spread if spread > 0 else float("nan")
            out.append(float(min(1.0, math.erfc(z / math.sqrt(2.0)))) if z == z else None)
    return pd.Series(out, dtype=object)


def rho_p(rho: Column, n: Column) -> Column:
    """Two-sided p of a rank correlation through its t statistic."""
    room = (F.lit(1.0) - rho) * (F.lit(1.0) + rho)
    t = F.when(room > 0, rho * F.sqrt((n - 2) / room))
    return F.when((n > 2) & (room <= 0), F.lit(0.0)).otherwise(t_p(t, (n - 2).cast("double")))
