"""Stationarity, autocorrelation, causality and residual tests.

Shared primitive: cross products of lagged columns.  Each position block (with a halo of
earlier rows) turns into one small numpy product; the products are summed per series with
map-side combine, and only the resulting small matrices are solved.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.tails import chi2_tail, chi2_tail_even, f_sf, level_pvalue, normal_cdf, unit_root_pvalue
from tidemark.operators.blocks import BLOCK_ROWS, CELL, DEFAULT_KEYS, attach, halo, null_safe_join, spread_join, with_position
from tidemark.session import cut

ACF_LAGS = 72
# Verdicts when both tests say stationary, none does, only ADF, only KPSS.
VERDICTS = ("STATIONNAIRE", "NON_STATIONNAIRE", "TREND_STATIONARY", "DIFFERENCE_STATIONARY")


def _fields(df: DataFrame, names: Sequence[str]) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def _centred(df: DataFrame, columns: Sequence[str], keys: Sequence[str], ts: str, cell: str | None) -> DataFrame:
    """Rows complete in ``columns``, minus the series mean, with ``pos`` and ``n``."""
    keys = list(keys)
    rows = df.select(*keys, ts, *[F.col(c).cast("double").alias(c) for c in columns]).dropna(subset=[ts, *columns])
    means = rows.groupBy(*keys).agg(*[F.avg(c).alias(f"__m_{c}") for c in columns])
    flat = attach(rows, means, keys).select(*keys, ts, *[(F.col(c) - F.col(f"__m_{c}")).alias(c) for c in columns])
    return with_position(flat, keys, ts, cell=cell, name="pos", total="n")


def _longest(rows: DataFrame) -> int:
    """Length of the longest series: the one number that fixes the block halo."""
    return int(rows.agg(F.max("n")).first()[0] or 0)


def _sum_arrays(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Element-wise sum of the array column ``g`` per series and ``n``; ``head`` is kept."""
    keys = list(keys)
    cells = parts.select(*keys, "n", F.posexplode("g").alias("i", "x"))
    sums = cells.groupBy(*keys, "n", "i").agg(F.sum("x").alias("x"))
    return sums.groupBy(*keys, "n").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("s")).select(
        *keys, "n", F.col("s.x").alias("g")
    )


# ------------------------------------------------------------------ autocovariance


def autocovariance(
    df: DataFrame, column: str, max_lag, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts",
    size: int | None = None, cell: str | None = CELL,
) -> DataFrame:
    """Per series ``n`` and ``g[k] = sum (y[t]-m)(y[t-k]-m)`` for k = 0..max_lag.

    ``max_lag`` is a number or a function of the series length.
    """
    keys = list(keys)
    lag_of = max_lag if callable(max_lag) else (lambda n: max_lag)
    rows = _centred(df, [column], keys, ts, cell)
    depth = lag_of(_longest(rows)) if callable(max_lag) else max_lag
    b = halo(rows, keys, ts, pos="pos", before=depth, size=size or max(BLOCK_ROWS, 4 * depth))
    size = b.size

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        y, n = pdf[column].to_numpy(), int(pdf["n"].iloc[0])
        first = int(np.searchsorted(pdf["pos"].to_numpy(), int(pdf["__blk"].iloc[0]) * size))
        g = np.zeros(min(lag_of(n), max(n - 1, 0)) + 1)
        for k in range(len(g)):
            lo = max(first, k)
            if lo < len(y):
                g[k] = y[lo:] @ y[lo - k : len(y) - k]
        return pd.DataFrame({**{c: [pdf[c].iloc[0]] for c in keys}, "n": [n], "g": [g]})

    fields = _fields(rows, keys)
    schema = (fields + ", " if fields else "") + "n bigint, g array<double>"
    parts = b.df.groupBy(*b.partition).applyInPandas(block, schema)
    return _sum_arrays(parts, keys)


def acf(df: DataFrame, column: str, lags: int = ACF_LAGS, **kw) -> DataFrame:
    """Biased autocorrelations 1..lags with their 95 % bound, one row per lag."""
    keys = list(kw.get("keys", DEFAULT_KEYS))
    return _acf_of(autocovariance(df, column, lags, **kw), keys)


def _acf_of(g: DataFrame, keys: Sequence[str]) -> DataFrame:
    rows = g.select(*keys, "n", F.col("g")[0].alias("g0"), F.posexplode("g").alias("lag", "x")).filter("lag > 0")
    bound = F.lit(1.96) / F.sqrt("n")
    value = F.when(F.col("g0") > 0, F.col("x") / F.col("g0"))
    return rows.select(*keys, "lag", value.alias("acf"), bound.alias("bound"), (F.abs(value) > bound).alias("significant"))


def _levinson(n: int, g: np.ndarray) -> np.ndarray:
    """Partial autocorrelations from lagged sums, each divided by its number of terms."""
    r = g / (n - np.arange(len(g)))
    if r[0] <= 0:
        return np.full(len(g) - 1, np.nan)
    phi, var, out = np.zeros(0), r[0], []
    for k in range(1, len(r)):
        if not var > 1e-12 * r[0]:  # explained without rest: later orders are not defined
            out.append(np.nan)
            continue
        last = (r[k] - phi @ r[k - 1 : 0 : -1]) / var
        phi = np.append(phi - last * phi[::-1], last)
        var *= 1.0 - last * last
        out.append(last)
    return np.array(out)


def pacf(df: DataFrame, column: str, lags: int = ACF_LAGS, **kw) -> DataFrame:
    """Yule-Walker partial autocorrelations 1..lags (lag sums over their term counts)."""
    keys = list(kw.get("keys", DEFAULT_KEYS))
    return _pacf_of(autocovariance(df, column, lags, **kw), keys)


def _pacf_of(g: DataFrame, keys: Sequence[str]) -> DataFrame:
    fields = _fields(g, keys)

    def solve(batches):
        for pdf in batches:
            out = pdf[[*keys, "n"]].copy()
            out["p"] = [_levinson(n, np.asarray(x)) for n, x in zip(pdf["n"], pdf["g"])]
            yield out

    solved = g.mapInPandas(solve, (fields + ", " if fields else "") + "n bigint, p array<double>")
    bound = F.lit(1.96) / F.sqrt("n")
    return solved.select(*keys, "n", F.posexplode("p").alias("i", "pacf")).select(
        *keys, (F.col("i") + 1).alias("lag"), F.nanvl("pacf", F.lit(None).cast("double")).alias("pacf"), bound.alias("bound"),
        (F.abs("pacf") > bound).alias("significant"),
    )


def order_suggestion(df: DataFrame, column: str, lags: int = ACF_LAGS, **kw) -> DataFrame:
    """Suggested orders: q and p are the last significant lag of ACF and PACF (0 if none)."""
    keys = list(kw.get("keys", DEFAULT_KEYS))
    g = autocovariance(df, column, lags, **kw)
    a, p = _acf_of(g, keys), _pacf_of(g, keys)

    def last(rows: DataFrame, order: str, count: str) -> DataFrame:
        return rows.groupBy(*keys).agg(
            F.coalesce(F.max(F.when(F.col("significant"), F.col("lag"))), F.lit(0)).alias(order),
            F.count_if("significant").alias(count),
        )

    return null_safe_join(last(a, "q", "n_significant_acf"), last(p, "p", "n_significant_pacf"), keys)


def ljung_box(df: DataFrame, column: str, at: Sequence[int] = (10, 20, 40), **kw) -> DataFrame:
    """Ljung-Box statistic and p-value at the given lags."""
    keys = list(kw.get("keys", DEFAULT_KEYS))
    g = autocovariance(df, column, max(at), **kw)
    terms = g.select(*keys, "n", F.col("g")[0].alias("g0"), F.posexplode("g").alias("lag", "x")).filter("lag > 0")
    share = F.pow(F.col("x") / F.col("g0"), 2) / (F.col("n") - F.col("lag"))
    scale = F.col("n") * (F.col("n") + 2)
    wide = terms.groupBy(*keys, "n").agg(
        *[(scale * F.sum(F.when(F.col("lag") <= h, share))).alias(f"q{h}") for h in at]
    )
    tail = lambda h: chi2_tail_even(F.col(f"q{h}"), h) if h % 2 == 0 else chi2_tail(F.col(f"q{h}"), F.lit(float(h)))
    rows = [F.struct(F.lit(h).alias("lag"), F.col(f"q{h}").alias("lb_stat"), tail(h).alias("lb_pvalue")) for h in at]
    return wide.select(*keys, F.inline(F.array(*rows)))


def durbin_watson(
    df: DataFrame, column: str, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts", step: str | None = None,
    size: int | None = None, cell: str | None = CELL,
) -> DataFrame:
    """Sum of squared first differences over the sum of squares; fine within (1.5, 2.5)."""
    rows = df.select(*keys, ts, column).dropna(subset=[column])
    b = halo(rows, keys, ts, before=1, step=step, size=size, cell=cell)
    moved = b.close(b.df.withColumn("__d", F.col(column) - F.lag(column, 1).over(b.w)))
    dw = F.sum(F.col("__d") * F.col("__d")) / F.sum(F.col(column) * F.col(column))
    return moved.groupBy(*keys).agg(dw.alias("durbin_watson")).withColumn(
        "dw_ok", (F.col("durbin_watson") > 1.5) & (F.col("durbin_watson") < 2.5)
    )


def jarque_bera(df: DataFrame, column: str, *, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """Normality over all rows from moments alone (one aggregate)."""
    m = df.groupBy(*keys).agg(
        F.count(column).alias("n"), F.skewness(column).alias("skew"), F.kurtosis(column).alias("kurt")
    )
    stat = F.col("n") / 6.0 * (F.pow("skew", 2) + F.pow("kurt", 2) / 4.0)
    return m.withColumn("jb_stat", stat).withColumn("jb_pvalue", F.exp(-F.col("jb_stat") / 2.0))


# ------------------------------------------------------------------ KPSS and ADF


def _bandwidth_limit(n: int) -> int:
    """Largest bandwidth the automatic rule returns for ``n`` rows unless near lags cancel the variance."""
    if n < 2:
        return 0
    cov = int(n ** (2.0 / 9.0))
    return max(cov, min(int(1.1447 * cov ** (2.0 / 3.0) * n ** (1.0 / 3.0)) + 1, n - 1))


def _kpss_lags(n: int, g: np.ndarray) -> int | None:
    """Automatic bandwidth; nothing for a constant series or one below three rows."""
    cov = int(n ** (2.0 / 9.0))
    i = np.arange(1, min(cov, len(g) - 1) + 1)
    inner = 2.0 * g[i] / n
    s0 = g[0] / n + inner.sum()
    if n < 3 or not g[0] > 0 or s0 == 0:
        return None
    ratio = (i @ inner) / s0
    return min(int(1.1447 * (ratio * ratio) ** (1.0 / 3.0) * n ** (1.0 / 3.0)), n - 1)


def _kpss_row(n: int, g: np.ndarray, eta: float) -> tuple[float | None, int | None, float | None]:
    """Statistic, bandwidth and p-value; nothing for a constant series or one below three rows."""
    lags = _kpss_lags(n, g)
    if lags is None:
        return None, None, None
    k = np.arange(1, lags + 1)
    long_run = (g[0] + 2.0 * (g[k] @ (1.0 - k / (lags + 1.0)))) / n
    if not long_run > 0:
        return None, None, None
    stat = eta / long_run
    return float(stat), lags, level_pvalue(stat)


def kpss(
    df: DataFrame, column: str, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts", size: int | None = None,
    cell: str | None = CELL,
) -> DataFrame:
    """Level stationarity with the automatic bandwidth; p-value clipped to [0.01, 0.10]."""
    from tidemark.operators.blocks import cell_scan

    keys = list(keys)
    g = cut(autocovariance(df, column, _bandwidth_limit, keys=keys, ts=ts, size=size, cell=cell))

    def beyond(batches):
        for pdf in batches:
            lags = [_kpss_lags(n, np.asarray(x)) or 0 for n, x in zip(pdf["n"], pdf["g"])]
            yield pd.DataFrame({"k": [k if k >= len(x) else 0 for k, x in zip(lags, pdf["g"])]})

    more = g.mapInPandas(beyond, "k long").agg(F.max("k")).first()[0]
    if more:
        # near lags that cancel the variance ask for a wider window than the usual bound
        g = autocovariance(df, column, more, keys=keys, ts=ts, size=size, cell=cell)
    rows = df.select(*keys, ts, F.col(column).cast("double").alias("y")).dropna(subset=[ts, "y"])
    flat = attach(rows, rows.groupBy(*keys).agg(F.avg("y").alias("m")), keys).withColumn("e", F.col("y") - F.col("m"))
    partial = cell_scan(flat.select(*keys, ts, "e"), keys, ts, cell=cell, running={"s": F.col("e")})
    eta = partial.groupBy(*keys).agg((F.sum(F.col("s") * F.col("s")) / F.pow(F.count("*"), 2)).alias("eta"))
    joined = attach(g, eta, keys)
    fields = _fields(g, keys)

    def solve(batches):
        for pdf in batches:
            got = [_kpss_row(n, np.asarray(x), e) for n, x, e in zip(pdf["n"], pdf["g"], pdf["eta"])]
            out = pdf[keys].copy()
            for j, name in enumerate(("kpss_stat", "kpss_lags", "kpss_pval")):
                out[name] = pd.array([r[j] for r in got], "Int32" if j == 1 else "Float64")
            yield out

    schema = (fields + ", " if fields else "") + "kpss_stat double, kpss_lags int, kpss_pval double"
    return joined.mapInPandas(solve, schema).withColumn("stationary_kpss", F.col("kpss_pval") > 0.05)


def _adf_lags(n: int) -> int:
    return max(0, min(n // 2 - 2, math.ceil(12.0 * (n / 100.0) ** 0.25)))


def _fit(gram: np.ndarray, use: list[int], target: int, rows: int):
    """Least squares from cross products: coefficients, residual sum, inverse."""
    xx, xy = gram[np.ix_(use, use)], gram[use, target]
    inv = np.linalg.pinv(xx)
    beta = inv @ xy
    return beta, max(float(gram[target, target] - beta @ xy), 1e-300), inv


def _adf_design(y: np.ndarray, start: int, stop: int, lags: int) -> np.ndarray:
    """Rows t = start..stop-1 of [1, y[t-1], dy[t-1]..dy[t-lags], dy[t]]."""
    t = np.arange(start, stop)
    dy = np.diff(y, prepend=y[:1])
    cols = [np.ones(len(t)), y[t - 1], *[dy[t - j] for j in range(1, lags + 1)], dy[t]]
    return np.column_stack(cols) if len(t) else np.zeros((0, lags + 3))


def _adf_row(n: int, g: np.ndarray, head: np.ndarray) -> tuple[float, float, int]:
    m = _adf_lags(n)
    width = m + 3
    gram, target = g.reshape(width, width), width - 1
    rows = n - m - 1
    best = None
    for lag in range(m + 1):
        _, ssr, _ = _fit(gram, [0, 1, *range(2, 2 + lag)], target, rows)
        aic = rows * math.log(ssr / rows) + 2.0 * (lag + 2)
        if best is None or aic < best[0]:
            best = (aic, lag)
    lag = best[1]
    # the refit may use the first rows again, which the common sample left out
    extra = _adf_design(head, lag + 1, m + 1, lag)
    use = [0, 1, *range(2, 2 + lag), target]
    full = gram[np.ix_(use, use)] + extra.T @ extra
    count = n - lag - 1
    beta, ssr, inv = _fit(full, list(range(lag + 2)), lag + 2, count)
    stat = beta[1] / math.sqrt(ssr / (count - lag - 2) * inv[1, 1])
    return float(stat), unit_root_pvalue(stat), lag


def adf(
    df: DataFrame, column: str, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts", size: int | None = None,
    cell: str | None = CELL,
) -> DataFrame:
    """Unit-root test with a constant, lag order by AIC on a common sample."""
    keys = list(keys)
    rows = _centred(df, [column], keys, ts, cell)
    depth = _adf_lags(_longest(rows)) + 1
    b = halo(rows, keys, ts, pos="pos", before=depth, size=size or max(BLOCK_ROWS, 4 * depth))
    size = b.size

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        y, n = pdf[column].to_numpy(), int(pdf["n"].iloc[0])
        at = pdf["pos"].to_numpy()
        m = _adf_lags(n)
        start = int(np.searchsorted(at, max(int(pdf["__blk"].iloc[0]) * size, m + 1)))
        z = _adf_design(y, start, len(y), m)
        return pd.DataFrame({**{c: [pdf[c].iloc[0]] for c in keys}, "n": [n], "g": [(z.T @ z).ravel()]})

    fields = _fields(rows, keys)
    prefix = fields + ", " if fields else ""
    parts = b.df.groupBy(*b.partition).applyInPandas(block, prefix + "n bigint, g array<double>")
    heads = rows.filter(F.col("pos") <= depth + 1).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("pos", column))).alias("h")
    ).select(*keys, F.col(f"h.{column}").alias("head"))
    joined = attach(_sum_arrays(parts, keys), heads, keys)

    def solve(batches):
        for pdf in batches:
            got = [
                _adf_row(n, np.asarray(g), np.asarray(h)) if n > 10 and g[0] > 0 else (None, None, None)
                for n, g, h in zip(pdf["n"], pdf["g"], pdf["head"])
            ]
            out = pdf[keys].copy()
            for j, name in enumerate(("adf_stat", "adf_pval", "adf_lags")):
                out[name] = [r[j] for r in got]
            yield out

    schema = prefix + "adf_stat double, adf_pval double, adf_lags int"
    return joined.mapInPandas(solve, schema).withColumn("stationary_adf", F.col("adf_pval") < 0.05)


def stationarity(df: DataFrame, column: str, **kw) -> DataFrame:
    """Joint verdict of both tests and whether differencing is recommended.

    Where a test has no result (a constant or short series), ``conclusion`` and the
    recommendation are null and ``reason`` says so.  Series without any value have no row.
    """
    keys = list(kw.get("keys", DEFAULT_KEYS))
    both = null_safe_join(adf(df, column, **kw), kpss(df, column, **kw), keys) if keys else attach(adf(df, column, **kw), kpss(df, column, **kw))
    a, k = F.col("stationary_adf"), F.col("stationary_kpss")
    both_agree, neither, only_adf, only_kpss = VERDICTS
    verdict = F.when(a & k, both_agree).when(~a & ~k, neither).when(a, only_adf).otherwise(only_kpss)
    known = a.isNotNull() & k.isNotNull()
    return both.withColumns({
        "conclusion": F.when(known, verdict), "differencing_recommended": F.when(known, ~a | ~k),
        "reason": F.when(~known, "constant or too short for the tests"),
    })


# ------------------------------------------------------------------ Granger causality


def _granger_rows(n: int, g: np.ndarray, yh: np.ndarray, xh: np.ndarray, depth: int):
    width = 2 * depth + 2
    gram, target = g.reshape(width, width), width - 1
    best = (None, None)
    for lag in range(1, depth + 1):
        # order `lag` uses the rows from `lag` on: add the ones before the common sample
        extra = _granger_design(yh, xh, lag, min(depth, len(yh)), depth, lag)
        full = gram + extra.T @ extra
        own = [0, *range(1, lag + 1)]
        joint = [*own, *range(depth + 1, depth + lag + 1)]
        rows = n - lag
        _, restricted, _ = _fit(full, own, target, rows)
        _, free, _ = _fit(full, joint, target, rows)
        df = rows - 2 * lag - 1
        if df <= 0:
            continue
        p = f_sf((restricted - free) / lag / (free / df), lag, df)
        if best[0] is None or p < best[0]:
            best = (p, lag)
    return best


def _granger_design(y, x, start, stop, depth, have):
    """[1, y lags, x lags, y] for t = start..stop-1; lags above ``have`` stay zero."""
    t = np.arange(start, stop)
    z = np.zeros((len(t), 2 * depth + 2))
    if len(t):
        z[:, 0] = 1.0
        for j in range(1, have + 1):
            z[:, j], z[:, depth + j] = y[t - j], x[t - j]
        z[:, -1] = y[t]
    return z


def granger(
    df: DataFrame, target: str, candidates: Sequence[str], max_lag: int = 24, *, keys: Sequence[str] = DEFAULT_KEYS,
    ts: str = "ts", size: int | None = None, cell: str | None = CELL,
) -> DataFrame:
    """Smallest F-test p-value over lags 1..max_lag per candidate; causes when below 0.05.

    Series with fewer than ``4 * max_lag`` complete rows are skipped.
    """
    keys = [*keys, "candidate"]
    pairs = [F.struct(F.lit(c).alias("candidate"), F.col(c).cast("double").alias("x")) for c in candidates]
    long = df.select(*keys[:-1], ts, F.col(target).cast("double").alias("y"), F.explode(F.array(*pairs)).alias("p"))
    rows = _centred(long.select(*keys[:-1], ts, "y", "p.candidate", "p.x"), ["y", "x"], keys, ts, cell)
    rows = rows.filter(F.col("n") >= 4 * max_lag)
    b = halo(rows, keys, ts, pos="pos", before=max_lag, size=size)
    size = b.size

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        y, x = pdf["y"].to_numpy(), pdf["x"].to_numpy()
        start = int(np.searchsorted(pdf["pos"].to_numpy(), max(int(pdf["__blk"].iloc[0]) * size, max_lag)))
        z = _granger_design(y, x, start, len(y), max_lag, max_lag)
        return pd.DataFrame({**{c: [pdf[c].iloc[0]] for c in keys}, "n": [int(pdf["n"].iloc[0])], "g": [(z.T @ z).ravel()]})

    fields = _fields(rows, keys)
    parts = b.df.groupBy(*b.partition).applyInPandas(block, fields + ", n bigint, g array<double>")
    heads = rows.filter(F.col("pos") < max_lag).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("pos", "y", "x"))).alias("h")
    ).select(*keys, F.col("h.y").alias("yh"), F.col("h.x").alias("xh"))
    joined = null_safe_join(_sum_arrays(parts, keys), heads, keys)

    def solve(batches):
        for pdf in batches:
            got = [
                _granger_rows(n, np.asarray(g), np.asarray(a), np.asarray(c), max_lag)
                for n, g, a, c in zip(pdf["n"], pdf["g"], pdf["yh"], pdf["xh"])
            ]
            out = pdf[keys].copy()
            out["min_pvalue"] = [r[0] for r in got]
            out["best_lag"] = [r[1] for r in got]
            yield out

    return joined.mapInPandas(solve, fields + ", min_pvalue double, best_lag int").withColumn(
        "causes", F.col("min_pvalue") < 0.05
    )


# ------------------------------------------------------------------ normality


# Polynomial weights of the two outer order statistics and of the
# transformation to normality, highest order first.
SW_OUTER = (-2.706056, 4.434685, -2.071190, -0.147981, 0.221157)
SW_SECOND = (-3.582633, 5.682633, -1.752461, -0.293762, 0.042981)
TIE_CHUNK = 50_000


def _shapiro_row(n: int, sxx: float, mm: float, mx: float, low: np.ndarray, high: np.ndarray) -> tuple[float | None, float | None]:
    """W and p from sums over all order statistics: ``sxx`` squares about the mean, ``mm`` squared
    normal scores, ``mx`` scores times values, and the outermost values in ascending order."""
    from statistics import NormalDist

    if n < 4 or high[-1] - low[0] < 1e-19:
        return None, None
    score = lambda i: NormalDist().inv_cdf((i - 0.375) / (n + 0.25))
    last, before, u = score(n), score(n - 1), 1.0 / math.sqrt(n)
    a1 = float(np.polyval((*SW_OUTER, last / math.sqrt(mm)), u))
    outer = a1 * (high[-1] - low[0])
    inner = mx - last * (high[-1] - low[0])
    if n > 5:
        a2 = float(np.polyval((*SW_SECOND, before / math.sqrt(mm)), u))
        phi = (mm - 2 * last**2 - 2 * before**2) / (1 - 2 * a1**2 - 2 * a2**2)
        outer += a2 * (high[-2] - low[1])
        inner -= before * (high[-2] - low[1])
    else:
        phi = (mm - 2 * last**2) / (1 - 2 * a1**2)
    w = min(1.0, (outer + inner / math.sqrt(phi)) ** 2 / sxx)
    if n < 12:
        gamma = -2.273 + 0.459 * n
        mu = np.polyval((-0.0006714, 0.025054, -0.39978, 0.5440), n)
        sigma = math.exp(np.polyval((-0.0020322, 0.062767, -0.77857, 1.3822), n))
        y = -math.log(gamma - math.log(1.0 - w)) if w < 1.0 and gamma - math.log(1.0 - w) > 0 else -50.0
    else:
        mu = np.polyval((0.0038915, -0.083751, -0.31082, -1.5861), math.log(n))
        sigma = math.exp(np.polyval((0.0030302, -0.082676, -0.4803), math.log(n)))
        y = math.log(1.0 - w) if w < 1.0 else -50.0
    return float(w), 1.0 - normal_cdf((y - mu) / sigma)


@F.pandas_udf(T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.DoubleType())]))
def _score_sums(first: pd.Series, last: pd.Series, n: pd.Series) -> pd.DataFrame:
    """Sum of the normal scores of ranks first..last and of their squares."""
    from statistics import NormalDist

    inv = NormalDist().inv_cdf
    rows = []
    for a, b, size in zip(first, last, n):
        m = [inv((i - 0.375) / (size + 0.25)) for i in range(int(a), int(b) + 1)]
        rows.append((math.fsum(m), math.fsum(x * x for x in m)))
    return pd.DataFrame(rows, columns=["a", "b"])


def shapiro(
    df: DataFrame, column: str, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts", cell: int = 20_000
) -> DataFrame:
    """Shapiro-Wilk over all values of each series (the p-value's approximation is published for
    up to 5000 values; the statistic has no limit).

    Equal values are counted first.  Ranks come from counts by value range, so that no task
    sorts a series; a run of equal values is summed in chunks.  Null columns for a
    constant series or one of fewer than four values.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(column).cast("double").alias("x")).dropna(subset=["x"])
    counts = rows.groupBy(*keys, "x").agg(F.count("*").alias("c"))
    ends = rows.groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg("x").alias("mean"), F.min("x").alias("lo"), F.max("x").alias("hi"),
        (F.var_pop("x") * F.count("*")).alias("sxx"),
    )
    joined = spread_join(counts, ends, keys) if keys else attach(counts, ends)
    slices = F.ceil(F.col("n") / F.lit(cell))
    place = F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * slices)
    parts = joined.withColumn("part", F.when(F.col("hi") > F.col("lo"), F.least(place, slices - 1)).otherwise(0))
    sizes = parts.groupBy(*keys, "part").agg(F.sum("c").alias("s"))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "part", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("o"))
    inside = Window.partitionBy(*keys, "part").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = null_safe_join(parts, offsets, [*keys, "part"]).withColumn("upto", F.col("o") + F.sum("c").over(inside))
    first = F.col("upto") - F.col("c") + 1
    chunk = F.explode(F.sequence(first, F.col("upto"), F.lit(TIE_CHUNK)))
    chunks = ranked.select(*keys, "n", "x", "mean", "upto", chunk.alias("a"))
    sums = _score_sums("a", F.least(F.col("a") + TIE_CHUNK - 1, F.col("upto")), "n")
    scored = chunks.select(*keys, "x", "mean", sums.alias("m"))
    total = scored.groupBy(*keys).agg(F.sum(F.col("m.a") * (F.col("x") - F.col("mean"))).alias("mx"), F.sum("m.b").alias("mm"))
    edge = lambda at, name: F.max(F.when((F.col("upto") >= at) & (F.col("upto") - F.col("c") < at), F.col("x"))).alias(name)
    tips = ranked.groupBy(*keys).agg(edge(F.lit(1), "x1"), edge(F.lit(2), "x2"), edge(F.col("n") - 1, "x3"), edge(F.col("n"), "x4"))
    every = attach(attach(ends, total, keys), tips, keys)
    fields = _fields(rows, keys)

    def solve(batches):
        for pdf in batches:
            got = [
                _shapiro_row(int(r.n), r.sxx, r.mm, r.mx, np.array([r.x1, r.x2], float), np.array([r.x3, r.x4], float))
                for r in pdf.itertuples()
            ]
            out = pdf[[*keys, "n"]].copy()
            for j, name in enumerate(("shapiro_w", "shapiro_pval")):
                out[name] = pd.array([r[j] for r in got], "Float64")
            yield out

    schema = (fields + ", " if fields else "") + "n bigint, shapiro_w double, shapiro_pval double"
    return every.mapInPandas(solve, schema).withColumn("normal_residuals", F.col("shapiro_pval") > 0.05)


def residual_tests(df: DataFrame, column: str, *, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts", **kw) -> DataFrame:
    """Ljung-Box minimum p, Shapiro-Wilk p and Durbin-Watson in one row per series."""
    lb = ljung_box(df, column, keys=keys, ts=ts, **kw).groupBy(*keys).agg(F.min("lb_pvalue").alias("ljung_box_pmin"))
    lb = lb.withColumn("no_autocorr", F.col("ljung_box_pmin") > 0.05)
    sw = shapiro(df, column, keys=keys, ts=ts).drop("n")
    dw = durbin_watson(df, column, keys=keys, ts=ts)
    every = df.select(*keys).distinct()
    if not keys:
        return attach(attach(lb, sw), dw)
    return attach(attach(attach(every, lb, keys), sw, keys), dw, keys)
