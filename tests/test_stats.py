"""Statistical tests against direct least squares, and verdicts on known series."""

import math

import numpy as np
from series_frames import column, frame

from tidemark.functions import tails
from tidemark.operators import decompose, stats


def ols(x, y):
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    resid = y - x @ beta
    return beta, float(resid @ resid)


def direct_adf(y):
    n = len(y)
    m = max(0, min(n // 2 - 2, math.ceil(12 * (n / 100) ** 0.25)))
    dy = np.diff(y)

    def design(lag, first):
        t = np.arange(first, n - 1)
        cols = [np.ones(len(t)), y[t]] + [dy[t - j] for j in range(1, lag + 1)]
        return np.column_stack(cols), dy[t]

    best = None
    for lag in range(m + 1):
        x, d = design(lag, m)
        _, ssr = ols(x, d)
        aic = len(d) * math.log(ssr / len(d)) + 2 * (lag + 2)
        if best is None or aic < best[0]:
            best = (aic, lag)
    x, d = design(best[1], best[1])
    beta, ssr = ols(x, d)
    se = math.sqrt(ssr / (len(d) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])
    return beta[1] / se, best[1]


def test_adf_matches_direct_regression_for_any_block(spark):
    rng = np.random.default_rng(42)
    y = np.cumsum(rng.normal(size=600)) * 0.2 + rng.normal(size=600)
    want, lag = direct_adf(y)
    for size in (None, 100):
        row = stats.adf(frame(spark, y), "value", size=size, cell="7 days").first()
        assert row.adf_lags == lag
        np.testing.assert_allclose(row.adf_stat, want, rtol=1e-6)


def test_verdicts(spark):
    rng = np.random.default_rng(42)
    noise = stats.stationarity(frame(spark, rng.normal(size=500)), "value").first()
    assert noise.conclusion == "STATIONNAIRE" and not noise.differencing_recommended
    walk = stats.stationarity(frame(spark, np.cumsum(rng.normal(size=500))), "value").first()
    assert walk.conclusion == "NON_STATIONNAIRE" and walk.differencing_recommended


def test_kpss_matches_direct_formula(spark):
    y = np.cumsum(np.random.default_rng(3).normal(size=400))
    e = y - y.mean()
    n = len(y)
    cov = int(n ** (2 / 9))
    s0, s1 = e @ e / n, 0.0
    for i in range(1, cov + 1):
        p = e[i:] @ e[:-i] / (n / 2)
        s0, s1 = s0 + p, s1 + i * p
    lags = int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3))
    var = (e @ e + 2 * sum((e[i:] @ e[:-i]) * (1 - i / (lags + 1)) for i in range(1, lags + 1))) / n
    want = (np.cumsum(e) ** 2).sum() / n**2 / var
    row = stats.kpss(frame(spark, y), "value", size=120, cell="5 days").first()
    assert row.kpss_lags == lags
    np.testing.assert_allclose(row.kpss_stat, want, rtol=1e-9)


def test_granger_finds_the_cause(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=300)
    y = rng.normal(0, 0.3, size=300)
    y[2:] += 0.7 * x[:-2]
    df = frame(spark, y, cause=x, other=rng.normal(size=300))
    rows = {r.candidate: r for r in stats.granger(df, "value", ["cause", "other"], 12, size=100).collect()}
    assert rows["cause"].causes and rows["cause"].best_lag == 2
    p = []
    for lag in range(1, 13):
        t = np.arange(lag, 300)
        own = np.column_stack([np.ones(len(t))] + [y[t - j] for j in range(1, lag + 1)])
        joint = np.column_stack([own] + [x[t - j] for j in range(1, lag + 1)])
        r, u = ols(own, y[t])[1], ols(joint, y[t])[1]
        d = len(t) - 2 * lag - 1
        p.append(tails.f_sf((r - u) / lag / (u / d), lag, d))
    np.testing.assert_allclose(rows["cause"].min_pvalue, min(p), atol=1e-12)


def test_partial_autocorrelation_of_ar1(spark):
    rng = np.random.default_rng(7)
    y = np.zeros(2000)
    for i in range(1, 2000):
        y[i] = 0.8 * y[i - 1] + rng.normal()
    rows = stats.pacf(frame(spark, y), "value", 10, size=500).orderBy("lag").collect()
    assert abs(rows[0].pacf - 0.8) < 0.05
    assert all(abs(r.pacf) < 0.1 for r in rows[1:])


def test_tails():
    assert abs(tails.chi2_sf(3.841458820694124, 1) - 0.05) < 1e-10
    assert abs(tails.chi2_sf(18.307038053275146, 10) - 0.05) < 1e-10
    assert abs(tails.f_sf(4.9646027437307145, 1, 10) - 0.05) < 1e-9
    assert abs(tails.unit_root_pvalue(-7.6594) / 1.7e-11 - 1) < 0.05
    assert tails.level_pvalue(0.3273) == 0.1


def direct_w(x):
    """W of a sorted sample straight from the order statistics."""
    from statistics import NormalDist

    x, n = np.sort(x), len(x)
    m = np.array([NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    u, ssq = 1 / np.sqrt(n), m @ m
    a = m.copy()
    a[-1] = np.polyval((*stats.SW_OUTER, m[-1] / np.sqrt(ssq)), u)
    a[-2] = np.polyval((*stats.SW_SECOND, m[-2] / np.sqrt(ssq)), u)
    a[0], a[1] = -a[-1], -a[-2]
    a[2:-2] /= np.sqrt((ssq - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * a[-1] ** 2 - 2 * a[-2] ** 2))
    return (a @ x) ** 2 / ((x - x.mean()) ** 2).sum()


def test_shapiro_over_all_values(spark):
    rng = np.random.default_rng(1)
    samples = {"normal": rng.normal(size=9000), "skewed": rng.exponential(size=500), "tied": np.round(rng.normal(size=700), 1), "flat": np.ones(30), "few": np.array([1.0, 2.0])}
    df = None
    for name, x in samples.items():
        part = frame(spark, x, series=name)
        df = part if df is None else df.unionByName(part)
    got = {r.series_id: r for r in stats.shapiro(df, "value", cell=400).collect()}
    assert set(got) == set(samples)
    for name in ("normal", "skewed", "tied"):
        assert abs(got[name].shapiro_w - direct_w(samples[name])) < 1e-9 and got[name].n == len(samples[name])
    assert got["normal"].shapiro_pval > 0.05 > 1e-6 > got["skewed"].shapiro_pval
    assert got["flat"].shapiro_w is None and got["few"].shapiro_pval is None


def test_constant_and_short_series_have_no_verdict(spark):
    rng = np.random.default_rng(5)
    df = frame(spark, rng.normal(size=300), series="noise").unionByName(frame(spark, np.full(300, 7.0), series="flat"))
    df = df.unionByName(frame(spark, [1.0], series="one")).unionByName(frame(spark, [np.nan] * 40, series="null"))
    got = {r.series_id: r for r in stats.stationarity(df, "value").collect()}
    assert got["noise"].conclusion is not None and got["noise"].reason is None
    for name in ("flat", "one"):
        assert got[name].conclusion is None and got[name].differencing_recommended is None and got[name].reason
    assert {r.series_id for r in stats.kpss(df, "value").collect()} == {"noise", "flat", "one"}


def test_partial_autocorrelation_of_an_exact_recursion():
    g = np.array([1.0, 1.0, 1.0, 1.0]) * 50.0
    p = stats._levinson(50, g * (50 - np.arange(4)) / 50)
    assert abs(p[0] - 1.0) < 1e-12 and np.isnan(p[1:]).all()


def test_stl_recovers_a_season(spark):
    t = np.arange(1440)
    y = 10 * np.sin(2 * np.pi * t / 24) + np.random.default_rng(42).normal(0, 0.5, 1440)
    df = frame(spark, y)
    whole = decompose.stl(df, "value", 24, outer=2)
    row = decompose.strengths(whole).first()
    assert row.strong_seasonality and row.seasonal_strength > 0.9


def test_robust_stl_does_not_depend_on_blocks(spark):
    rng = np.random.default_rng(9)
    y = 10 * np.sin(2 * np.pi * np.arange(1440) / 24) + rng.normal(0, 0.5, 1440) + 30 * (rng.random(1440) < 0.02)
    df = frame(spark, y)
    whole, blocks = (decompose.stl(df, "value", 24, block_periods=k, outer=3).cache() for k in (400, 22))
    for part in ("trend", "seasonal"):
        assert np.abs(column(blocks, part) - column(whole, part)).max() < 1e-6


def test_plain_stl_does_not_depend_on_blocks(spark):
    t = np.arange(1440)
    y = 10 * np.sin(2 * np.pi * t / 24) + np.random.default_rng(42).normal(0, 0.5, 1440)
    df = frame(spark, y)
    whole = column(decompose.stl(df, "value", 24, robust=False), "seasonal")
    blocks = column(decompose.stl(df, "value", 24, robust=False, block_periods=20, halo_periods=16), "seasonal")
    assert np.abs(blocks - whole).max() < 1e-6
