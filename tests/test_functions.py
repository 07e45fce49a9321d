import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugemill.functions import kolmogorov
from gaugemill.functions.keys import clean_key_text, key_bucket, normalize_key, prediction_key
from gaugemill.functions.numeric import to_double


def python_key(v):
    """The key rule, told in Python."""
    s = v.strip().strip('"').strip("'")
    return str(int(float(s))).zfill(5) if s.replace(".", "", 1).isdigit() else s


TEXTS = [
    "98178", '"98136"', " 98028 ", "98042.0", "'98001'", '"\'7\'"', "007", "0", "00000", "5.", ".5", "1.2.3", "-5", "", '""', "abc",
    "123456", "1234567.9", "\t42\n", "98 178", "9e3", "12d",
]


def test_text_keys_follow_the_rule(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "k string")
    got = [r[0] for r in df.select(normalize_key(F.col("k"), T.StringType())).collect()]
    assert got == [python_key(t) for t in TEXTS]


@pytest.mark.parametrize(
    ("rows", "kind", "want"),
    [
        ([(98178,), (None,), (-5,), (7,), (1234567,)], "long", ["98178", None, "-5", "00007", "1234567"]),
        ([(98042.0,), (float("nan"),), (None,), (3.9,)], "double", ["98042", None, None, "00003"]),
    ],
)
def test_numeric_keys(spark, rows, kind, want):
    df = spark.createDataFrame(rows, f"k {kind}")
    assert [r[0] for r in df.select(normalize_key(F.col("k"), df.schema["k"].dataType)).collect()] == want


def test_other_key_forms(spark):
    df = spark.createDataFrame([(' 9"8178 ',), (None,), ("-3",), ("x",), ("98178",), ("1e300",)], "k string")
    rows = df.select(clean_key_text(F.col("k")), prediction_key(F.col("k")), key_bucket(F.col("k"))).collect()
    assert [r[0] for r in rows] == ["98178", None, "-3", "x", "98178", "1e300"]
    assert [r[1] for r in rows] == ["98178", "", "-3", "x", "98178", "1e300"]
    assert [r[2] for r in rows] == [178, 0, 997, 0, 178, 0]


def test_numeric_coercion(spark):
    texts = ["12", " 12 ", "1e3", "12d", "1.5F", "inf", "-inf", "nan", "", "0x10", "1_000", None, "abc"]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    got = [r[0] for r in df.select(to_double(F.col("c"), T.StringType())).collect()]
    assert got == [12.0, 12.0, 1000.0, None, None, math.inf, -math.inf, None, None, None, None, None, None]


# Statistic and p-value of recorded tests of 21,613 against 100 values.
RECORDED = [
    (0.052051080368296865, 0.936187288623376),
    (0.07324989589598857, 0.6297938933374944),
    (0.10316106047286355, 0.22183617391883018),
    (0.1600495072410124, 0.010509482049607862),
    (0.1737792069587748, 0.004123459474481614),
    (0.021323740341461117, 0.9999999995503089),
    (0.002458242724286297, 1.0),
]


@pytest.mark.parametrize(("d", "p"), RECORDED)
def test_small_side_pvalues_match_recorded_ones(d, p):
    assert kolmogorov.exact_one_sample(d, round(21613 * 100 / 21713)) == pytest.approx(p, abs=1e-12)


def path_share(limit, n1, n2):
    """Share of all orderings whose path leaves the band, by listing them."""
    out = total = 0
    for first in itertools.combinations(range(n1 + n2), n1):
        i = j = 0
        left = False
        for step in range(n1 + n2):
            i, j = (i + 1, j) if step in first else (i, j + 1)
            left |= abs(i * n2 - j * n1) >= limit
        total += 1
        out += left
    return out / total


@pytest.mark.parametrize(("n1", "n2", "limit"), [(5, 4, 7), (6, 6, 18), (3, 7, 9), (8, 5, 40), (4, 4, 4), (1, 6, 3), (7, 3, 12)])
def test_two_sample_pvalue_counts_paths(n1, n2, limit):
    assert kolmogorov.exact_two_sample(limit / (n1 * n2), n1, n2) == pytest.approx(path_share(limit, n1, n2), abs=1e-12)


def test_large_sample_series_agrees_with_exact_values(spark):
    rows = [(d, 140.0) for d in (0.03, 0.05, 0.08, 0.1, 0.12)] + [(d, 1000.0) for d in (0.08, 0.1)]
    df = kolmogorov.with_large_sample_pvalue(spark.createDataFrame(rows, "d double, n double"), "d", "n", "p")
    for r in df.collect():
        assert r["p"] == pytest.approx(kolmogorov.exact_one_sample(r["d"], int(r["n"])), abs=1e-5)


def test_pvalue_picks_the_regime(spark):
    rows = [(0.05, 500, 400), (0.02, 50_000, 20_000), (0.2, 30_000, 100), (0.5, 20_000, 20_000), (None, 10, 10), (1e-6, 10**12, 10**12)]
    df = kolmogorov.with_ks_pvalue(spark.createDataFrame(rows, "ks_statistic double, n_reference long, n_current long"))
    got = [r["ks_pvalue"] for r in df.collect()]
    assert got[0] == pytest.approx(kolmogorov.exact_two_sample(0.05, 500, 400))
    assert got[1] == pytest.approx(2 * np.exp(-2 * 0.02**2 * 100_000 / 7), rel=0.02)
    assert got[2] == pytest.approx(kolmogorov.exact_one_sample(0.2, 100))
    assert got[3] == 0.0
    assert got[4] is None
    assert got[5] == pytest.approx(0.6993742, abs=1e-4)  # limit distribution at z = sqrt(1/2)


def one_sided_in_decimals(d, n):
    """The sum of Birnbaum and Tingey with 60 digits."""
    from decimal import Decimal, localcontext

    with localcontext() as context:
        context.prec = 60
        d, total, choose = Decimal(d), Decimal(0), Decimal(1)
        for j in range(int(n * (1 - d)) + 1):
            rest = 1 - d - Decimal(j) / n
            if rest > 0:
                total += choose * (d + Decimal(j) / n) ** (j - 1) * rest ** (n - j)
            choose = choose * (n - j) / (j + 1)
        return float(d * total)


@pytest.mark.parametrize(("d", "n"), [("0.4", 20), ("0.9", 7), ("0.15", 150), ("0.05", 1000), ("0.07", 500), ("0.3", 500), ("0.05", 3000)])
def test_tail_agrees_with_sum_in_decimals(d, n):
    want = one_sided_in_decimals(d, n)
    assert kolmogorov._one_sided(float(d), n) == pytest.approx(want, rel=1e-12)


def test_tail_of_any_size(monkeypatch):
    for n in (10**5, 10**6, 10**9, 10**12):
        z2 = 3.0
        got = kolmogorov.one_sample_tail((z2 / n) ** 0.5, n)
        # the limit, and the first term beyond it (Smirnov 1944)
        assert got == pytest.approx(2 * np.exp(-2 * z2) * (1 - 2 * z2**0.5 / (3 * n**0.5)) - 2 * np.exp(-8 * z2), rel=5 / n + 1e-8)
    whole = kolmogorov._one_sided(0.005, 150_000)
    monkeypatch.setattr(kolmogorov, "TAIL_POINTS", 10_000)
    assert kolmogorov._one_sided(0.005, 150_000) == pytest.approx(whole, rel=1e-12)
