"""Tail probabilities for small result tables: a few rows per model, as Arrow-batched functions."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def student_tail(t: float, df: int) -> float:
    """P(T > t), t >= 0, whole degrees of freedom, by the finite cosine series."""
    theta = math.atan(t / math.sqrt(df))
    c2 = math.cos(theta) ** 2
    if df % 2:
        term, acc = math.cos(theta), 0.0
        for k in range(1, (df - 1) // 2 + 1):
            acc += term
            term *= c2 * (2 * k) / (2 * k + 1)
        inside = 2 / math.pi * (theta + math.sin(theta) * acc)
    else:
        term, acc = 1.0, 0.0
        for k in range(1, df // 2 + 1):
            acc += term
            term *= c2 * (2 * k - 1) / (2 * k)
        inside = math.sin(theta) * acc
    return max(0.0, (1 - inside) / 2)


def student_quantile(p: float, df: int) -> float:
    """t with P(T <= t) = p, by bisection (monotone, p >= 0.5)."""
    if p < 0.5:
        return -student_quantile(1 - p, df)
    lo, hi = 0.0, 1.0
    while student_tail(hi, df) > 1 - p:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if student_tail(mid, df) > 1 - p else (lo, mid)
    return (lo + hi) / 2


def chi2_tail(x: float, df: int) -> float:
    """P(X > x) for whole degrees of freedom, by the finite Poisson series."""
    if x <= 0:
        return 1.0
    half = x / 2
    first = 0.5 if df % 2 else 0.0
    # terms half^k e^-half / gamma(k + 1) by their logarithms: far from the ends each alone may underflow
    total = math.fsum(math.exp(k * math.log(half) - half - math.lgamma(k + 1)) for k in (first + i for i in range(df // 2)))
    return min(1.0, total + (math.erfc(math.sqrt(half)) if df % 2 else 0.0))


def signed_rank_p(w: float, n: int, ties: float, exact: bool) -> float:
    """Two-sided p of the signed-rank statistic ``w`` (smaller rank sum) over ``n`` non-zero differences.

    Exact by counting sign patterns; with ties or zeros, or beyond 50 differences, the normal form
    with tie correction ``ties`` = sum(t^3 - t).
    """
    if n == 0:
        return 1.0
    if exact and n <= 50:
        ways = [1] + [0] * (n * (n + 1) // 2)
        for r in range(1, n + 1):
            for s in range(len(ways) - 1, r - 1, -1):
                ways[s] += ways[s - r]
        return min(1.0, 2 * sum(ways[: int(w) + 1]) / 2**n)
    var = n * (n + 1) * (2 * n + 1) / 24 - ties / 48
    return math.erfc(abs(w - n * (n + 1) / 4) / math.sqrt(var) / math.sqrt(2)) if var > 0 else 1.0


def _each(fn, *cols: pd.Series) -> pd.Series:
    ok = pd.concat(cols, axis=1).notna().all(axis=1)
    return pd.Series([fn(*v) if g else None for g, *v in zip(ok, *cols)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _t_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    return _each(lambda a, b: 2 * student_tail(abs(a), int(b)), t, df)


@F.pandas_udf(T.DoubleType())
def _t_quantile(p: pd.Series, df: pd.Series) -> pd.Series:
    return _each(lambda a, b: student_quantile(a, int(b)), p, df)


@F.pandas_udf(T.DoubleType())
def _chi2_tail(x: pd.Series, df: pd.Series) -> pd.Series:
    return _each(lambda a, b: chi2_tail(a, int(b)), x, df)


@F.pandas_udf(T.DoubleType())
def _signed_rank(w: pd.Series, n: pd.Series, ties: pd.Series, exact: pd.Series) -> pd.Series:
    return _each(lambda a, b, c, d: signed_rank_p(a, int(b), c, bool(d)), w, n, ties, exact)


def t_two_sided_p(t: Column, df: Column) -> Column:
    return _t_two_sided(t.cast("double"), df.cast("double"))


def t_quantile(p: Column | float, df: Column) -> Column:
    return _t_quantile(F.lit(p) if isinstance(p, float) else p, df.cast("double"))


def chi2_p(x: Column, df: Column) -> Column:
    return _chi2_tail(x.cast("double"), df.cast("double"))


def signed_rank_p_value(w: Column, n: Column, ties: Column, exact: Column) -> Column:
    return _signed_rank(w.cast("double"), n.cast("double"), ties.cast("double"), exact.cast("double"))
