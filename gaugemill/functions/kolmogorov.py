"""p-values of the two-sided two-sample Kolmogorov-Smirnov test.

Large samples use the one-sample statistic at ``n = round(n1 n2 / (n1 + n2))``: in the middle the series of Pelz and
Good (1976) as a column expression, in the tail the one-sided sum of Birnbaum and Tingey (1951), for every ``n``. Where
both samples hold at most 10,000 values the exact two-sample distribution is used (share of lattice paths, Hodges
1958), and for ``n`` up to 140 the exact one-sample one (Marsaglia, Tsang and Wang 2003). All but the series run as an
Arrow function over the per-feature result, one short row per feature.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXACT_UP_TO = 10_000
SMALL_N = 140
TAIL_FROM = 2.2
TAIL_POINTS = 200_000
TERMS = 10


def _theta(power: int, half: float) -> str:
    """Sum over all whole k of x^power exp(-x / 2z²) with x = (pi (k + half))², as SQL over a column ``z``."""
    start = 0 if half else 1
    x = f"pow(pi() * (k + {half}D), 2)"
    term = f"2D * pow({x}, {power}) * exp(-{x} / (2D * z * z))"
    return f"aggregate(sequence({start}, {start + TERMS - 1}), 0D, (total, k) -> total + {term})"


def with_large_sample_pvalue(df: DataFrame, d: str, n: str, name: str) -> DataFrame:
    """``df`` with P(D >= d) for the one-sample statistic at size ``n``, good where ``n d²`` is below ``TAIL_FROM``."""
    # below z = 0.1 the distribution function is smaller than any double near 1
    steps = df.withColumns({"z": F.expr(f"greatest(sqrt({n}) * {d}, 0.1D)"), "c": F.expr("sqrt(pi() / 2)")})
    steps = steps.withColumns(
        {f"s{p}": F.expr(_theta(p, 0.5)) for p in range(4)} | {f"t{p}": F.expr(_theta(p, 0.0)) for p in (1, 2)}
    )
    steps = steps.withColumns({
        "k0": F.expr("c / z * s0"),
        "k1": F.expr("c / (6 * pow(z, 4)) * (s1 - z * z * s0)"),
        "k2": F.expr(
            "c / (72 * pow(z, 7)) * ((6 * pow(z, 6) + 2 * pow(z, 4)) * s0 + (2 * pow(z, 4) - 5 * z * z) * s1"
            " + (1 - 2 * z * z) * s2) - c / (36 * pow(z, 3)) * t1"
        ),
        "k3": F.expr(
            "c / (6480 * pow(z, 10)) * ((5 - 30 * z * z) * s3 + (212 * pow(z, 4) - 60 * z * z) * s2"
            " + (135 * pow(z, 4) - 96 * pow(z, 6)) * s1 - (30 * pow(z, 6) + 90 * pow(z, 8)) * s0)"
            " + c / (108 * pow(z, 6)) * (3 * z * z * t1 - t2)"
        ),
    })
    p = F.expr(f"least(1D, greatest(0D, 1 - (k0 + k1 / sqrt({n}) + k2 / {n} + k3 / ({n} * sqrt({n})))))")
    return steps.withColumn(name, p).select(*df.columns, name)


def exact_two_sample(d: float, n1: int, n2: int) -> float:
    """Share of lattice paths from (0, 0) to (n1, n2) that leave the band of half-width ``d``."""
    common = math.gcd(n1, n2)
    limit = round(d * (n1 // common) * n2) * common
    if limit == 0:
        return 1.0
    left = np.ones(n1 + 2)  # left[i + 1]: share of paths to (i, s - i) that left the band
    left[1] = 0.0
    step = np.arange(n1 + 1, dtype=np.float64)
    low = high = 0
    for s in range(1, n1 + n2 + 1):
        # points of this diagonal with |i n2 - (s - i) n1| < limit
        first = max(0, s - n2, (s * n1 - limit) // (n1 + n2) + 1)
        last = min(n1, s, -((-s * n1 - limit) // (n1 + n2)) - 1)
        if first > last:
            return 1.0
        i = step[first : last + 1]
        inside = i / s * left[first : last + 1] + (s - i) / s * left[first + 1 : last + 2]
        left[low + 1 : first + 1] = 1.0
        left[last + 2 : high + 2] = 1.0
        left[first + 1 : last + 2] = inside
        low, high = first, last
    return float(min(1.0, left[n1 + 1]))


def _stirling_rest(x: np.ndarray) -> np.ndarray:
    """What Stirling's formula leaves out of log x!."""
    small = np.array([0.0] + [math.lgamma(k + 1) - (k + 0.5) * math.log(k) + k - 0.5 * math.log(2 * math.pi) for k in range(1, 16)])
    large = np.maximum(x, 16.0)
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * large**2)) / large**2) / large**2) / large
    return np.where(x < 16, small[np.minimum(x, 15).astype(int)], series)


def _one_sided(d: float, n: int) -> float:
    """P(D+ >= d) for sample size ``n``.

    The terms of the sum form one smooth hill, summed in logarithms. The large parts of their logarithms cancel, so they
    are taken as differences: log1p of the small ratios, and the rests of Stirling's formula. A hill wider than
    ``TAIL_POINTS`` terms is measured at as many places at an even distance, which for such a hill is the sum itself but
    for rounding.
    """
    last = math.ceil(n * (1 - d)) - 1
    total = (1 - d) ** n
    if last < 1:
        return min(1.0, total)
    step = max(1, -(-last // TAIL_POINTS))
    j = np.arange(1 + step // 2, last + 1, step, dtype=np.float64)
    u, v = j / n, (n - j) / n
    gain = n * (u * np.log1p(d / u) + v * np.log1p(np.maximum(-d / v, -1 + 1e-300)))
    log = gain - np.log(d + u) - 0.5 * np.log(2 * np.pi * n * u * v) + _stirling_rest(np.array([float(n)]))[0] - _stirling_rest(j) - _stirling_rest(n - j)
    return float(min(1.0, total + d * step * np.exp(log).sum()))


def one_sample_tail(d: float, n: int) -> float:
    """P(D >= d) where ``n d²`` is at least ``TAIL_FROM``: twice the one-sided tail, less what both sides share."""
    if d >= 1:
        return 0.0
    return min(1.0, max(0.0, 2 * _one_sided(d, n) - 2 * math.exp(-8.0 * n * d * d)))


def exact_one_sample(d: float, n: int) -> float:
    """P(D >= d) for the one-sample statistic: exact for small ``n``, and in the tail for any ``n``."""
    if d >= 1 or n == 0:
        return 0.0 if n else 1.0
    if n * d <= 0.5:
        return 1.0
    if d >= 0.5 or n * d * d > 4:
        return min(1.0, 2 * _one_sided(d, n))
    k = math.ceil(n * d)
    h, m = k - n * d, 2 * k - 1
    fact = np.array([math.factorial(i) for i in range(m + 1)], dtype=np.float64)
    gap = np.subtract.outer(np.arange(m), np.arange(m)) + 1
    body = np.where(gap >= 0, 1.0 / fact[np.clip(gap, 0, m)], 0.0)
    body[:, 0] -= h ** np.arange(1, m + 1) / fact[1:]
    body[-1, :] -= (h ** np.arange(1, m + 1) / fact[1:])[::-1]
    body[-1, 0] += max(0.0, 2 * h - 1) ** m / fact[m]
    inside = np.linalg.matrix_power(body, n)[k - 1, k - 1]
    scale = math.exp(math.lgamma(n + 1) - n * math.log(n))
    return float(min(1.0, max(0.0, 1 - inside * scale)))


@F.pandas_udf(T.DoubleType())
def _exact_pvalue(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    def one(d: float, n1: float, n2: float) -> float | None:
        if math.isnan(d):
            return None
        if max(n1, n2) <= EXACT_UP_TO:
            return exact_two_sample(d, int(n1), int(n2))
        n = round(n1 * n2 / (n1 + n2))
        return exact_one_sample(d, n) if n <= SMALL_N else one_sample_tail(d, n)

    return pd.Series([one(*row) for row in zip(d, n1, n2, strict=True)], dtype="float64")


def with_ks_pvalue(df: DataFrame, statistic: str = "ks_statistic", n1: str = "n_reference", n2: str = "n_current") -> DataFrame:
    """``df`` with ``ks_pvalue`` of the two-sample statistic; NULL where there is none."""
    # size of the limit distribution, halves to even
    sized = df.withColumn("__n", F.expr(f"rint(try_divide(CAST({n1} AS DOUBLE) * {n2}, {n1} + {n2}))"))
    sized = with_large_sample_pvalue(sized, statistic, "__n", "__limit")
    in_tail = f"__n * {statistic} * {statistic} >= {TAIL_FROM}"
    exact = F.expr(f"greatest({n1}, {n2}) <= {EXACT_UP_TO} OR __n <= {SMALL_N} OR {in_tail}")
    by_hand = _exact_pvalue(F.when(exact, F.col(statistic)), F.col(n1).cast("double"), F.col(n2).cast("double"))
    value = F.when(F.col(statistic).isNull(), None).when(exact, by_hand).otherwise(F.col("__limit"))
    return sized.withColumn("ks_pvalue", value).drop("__n", "__limit")
