"""Seasonal ARIMA (2,1,2)(1,1,1), spread over blocks.

:func:`fit` regresses the differenced series on a long autoregression to estimate its shocks, then
on its own and the shocks' lags (Hannan-Rissanen), seasonal lags free.  :func:`fit_multiplicative`
starts there and minimises the conditional sum of squares of the multiplied polynomials by damped
Gauss-Newton steps.  Everything is a sum of block cross products, so a series of any length is
fitted without gathering it; only the last rows a forecast starts from are grouped per series.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.blocks import CELL, DEFAULT_KEYS, attach, from_micros, halo, micros, null_safe_join, seconds, spread_join, with_position
from tidemark.operators.stats import _fields, _sum_arrays
from tidemark.operators.timeindex import tail_rows
from tidemark.session import cut, new_dir


def _orders(season: int) -> list[int]:
    return [1, 2, season, season + 1, season + 2]


def _solve(rows: DataFrame, keys: list[str], width: int, name: str) -> DataFrame:
    prefix = _fields(rows, keys)
    prefix = prefix + ", " if prefix else ""

    def run(batches):
        for pdf in batches:
            out = pdf[keys].copy()
            coef = []
            for g in pdf["g"]:
                m = np.asarray(g).reshape(width, width)
                x, scale = m[:-1, :-1], max(np.trace(m[:-1, :-1]) / (width - 1), 1e-12)
                coef.append(np.linalg.solve(x + 1e-9 * scale * np.eye(width - 1), m[:-1, -1]))
            out[name] = coef
            yield out

    return rows.mapInPandas(run, f"{prefix}{name} array<double>")


def fit(
    df: DataFrame, column: str, *, season: int = 24, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts",
    size: int | None = None, cell: str | None = CELL, long_order: int | None = None,
) -> DataFrame:
    """Per series: ``phi`` (long autoregression), ``theta`` (own lags, then shock lags), ``n_rows``.

    A series too short to be fitted keeps its row with null coefficients and a ``reason``.
    """
    keys = list(keys)
    lags = _orders(season)
    order = long_order or 2 * season + 4
    reach = season + 1
    rows = df.select(*keys, ts, F.col(column).cast("double").alias("y")).dropna(subset=[ts, "y"])
    rows = with_position(rows, keys, ts, cell=cell, name="pos", total="n")
    prefix = _fields(rows, keys)
    prefix = prefix + ", " if prefix else ""

    def differenced(y: np.ndarray) -> np.ndarray:
        w = np.full(len(y), np.nan)
        w[reach:] = y[reach:] - y[reach - 1 : -1] - y[1 : len(y) - season] + y[: len(y) - reach]
        return w

    def products(block_size: int, back: Sequence[int], shocks: bool, first: int):
        def block(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("pos")
            w = differenced(pdf["y"].to_numpy())
            at = pdf["pos"].to_numpy()
            lo = int(np.searchsorted(at, max(int(pdf["__blk"].iloc[0]) * block_size, first)))
            t = np.arange(lo, len(w))
            cols = [w[t - k] for k in back]
            if shocks:
                phi = np.asarray(pdf["phi"].iloc[0])
                e = w.copy()
                for k, c in enumerate(phi, start=1):
                    e[k:] -= c * w[:-k]
                cols += [e[t - k] for k in back]
            z = np.column_stack([*cols, w[t]])
            return pd.DataFrame({**{c: [pdf[c].iloc[0]] for c in keys}, "n": [int(pdf["n"].iloc[0])], "g": [(z.T @ z).ravel()]})

        return block

    schema = prefix + "n bigint, g array<double>"
    depth = reach + order
    a = halo(rows.filter(F.col("n") > 2 * depth + 2 * season), keys, ts, pos="pos", before=depth, size=size)
    gram = a.df.groupBy(*a.partition).applyInPandas(products(a.size, range(1, order + 1), False, depth), schema)
    phi = _solve(_sum_arrays(gram, keys), keys, order + 1, "phi")
    deep = depth + max(lags)
    b = halo(rows, keys, ts, pos="pos", before=deep, size=size)
    known = null_safe_join(b.df, phi, keys)
    gram = known.groupBy(*b.partition).applyInPandas(products(b.size, lags, True, deep), schema)
    theta = _solve(_sum_arrays(gram, keys), keys, 2 * len(lags) + 1, "theta")
    every = rows.groupBy(*keys).agg(F.max("n").alias("n_rows"))
    fitted = attach(attach(every, phi, keys), theta, keys)
    return fitted.withColumn("reason", F.when(F.col("theta").isNull(), f"fewer than {2 * depth + 2 * season + 1} rows"))


def forecast(
    df: DataFrame, model: DataFrame, column: str, steps: int, *, season: int = 24, step: str = "1 hour",
    keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts", long_order: int | None = None,
) -> DataFrame:
    """``steps`` values after the last row of every series; null where the series was not fitted.

    ``model`` comes from :func:`fit` or :func:`fit_multiplicative`.
    """
    keys = list(keys)
    lags, order = _orders(season), long_order or 2 * season + 4
    multiplied = "params" in model.columns
    depth = memory(season)
    need = season + 1 + max(lags) + 1 + (sum(depth) if multiplied else order)
    rows = df.select(*keys, ts, F.col(column).cast("double").alias("y")).dropna(subset=[ts, "y"])
    tail = null_safe_join(tail_rows(rows, need, keys=keys, ts=ts), model.select(*keys, "params" if multiplied else "phi", "theta"), keys)
    prefix = _fields(rows, keys)
    prefix = prefix + ", " if prefix else ""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__us")
        y = list(pdf["y"])
        if pdf["theta"].iloc[0] is None:
            last = int(pdf["__us"].iloc[-1])
            times = [last + (i + 1) * seconds(step) * 1_000_000 for i in range(steps)]
            return pd.DataFrame({**{c: [pdf[c].iloc[0]] * steps for c in keys}, "__us": times, "predicted": [None] * steps})
        arr = np.asarray(y)
        w = arr[season + 1 :] - arr[season:-1] - arr[1 : len(arr) - season] + arr[: len(arr) - season - 1]
        if multiplied:
            e = shocks(w, np.asarray(pdf["params"].iloc[0]), season, depth)
        else:
            e = w.copy()
            for k, c in enumerate(pdf["phi"].iloc[0], start=1):
                e[k:] -= c * w[:-k]
        w, e = list(w), list(e)
        own, shock = np.split(np.asarray(pdf["theta"].iloc[0]), 2)
        for _ in range(steps):
            nxt = sum(c * w[-k] for c, k in zip(own, lags)) + sum(c * e[-k] for c, k in zip(shock, lags))
            w.append(nxt)
            e.append(0.0)
            y.append(nxt + y[-1] + y[-season] - y[-season - 1])
        last = int(pdf["__us"].iloc[-1])
        out = {c: [pdf[c].iloc[0]] * steps for c in keys}
        out["__us"] = [last + (i + 1) * seconds(step) * 1_000_000 for i in range(steps)]
        out["predicted"] = y[-steps:]
        return pd.DataFrame(out)

    made = tail.withColumn("__us", micros(ts)).drop(ts).groupBy(*keys).applyInPandas(one, prefix + "__us bigint, predicted double")
    return made.select(*keys, from_micros(F.col("__us")).alias(ts), "predicted")


# ------------------------------------------------------------------ multiplicative model

#: Order of ``params``: phi_1, phi_2, seasonal phi, theta_1, theta_2, seasonal theta.
N_PARAMS = 6
BOUND, SEASONAL_BOUND = 0.98, 0.95
_LEFT_OUT = 1e-9


def memory(season: int, bound: float = BOUND, seasonal_bound: float = SEASONAL_BOUND) -> tuple[int, int]:
    """Lags (plain, seasonal) after which the moving-average filters have faded below 1e-9."""
    plain = int(np.ceil(np.log(_LEFT_OUT) / np.log(bound)))
    return plain, int(np.ceil(np.log(_LEFT_OUT) / np.log(seasonal_bound))) * season


def _filtered(x: np.ndarray, response: np.ndarray) -> np.ndarray:
    response = response[: len(x)]
    size = 1 << (len(x) + len(response)).bit_length()
    return np.fft.irfft(np.fft.rfft(x, size) * np.fft.rfft(response, size), size)[: len(x)]


def _back(x: np.ndarray, k: int) -> np.ndarray:
    return np.concatenate([np.zeros(min(k, len(x))), x[: max(len(x) - k, 0)]])


def _responses(params: np.ndarray, season: int, depth: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Impulse responses of the two inverted moving-average polynomials."""
    plain, seasonal = np.zeros(depth[0] + 1), np.zeros(depth[1] + 1)
    plain[0], plain[1] = 1.0, -params[3]
    for k in range(2, len(plain)):
        plain[k] = -params[3] * plain[k - 1] - params[4] * plain[k - 2]
    seasonal[::season] = (-params[5]) ** np.arange(len(seasonal[::season]))
    return plain, seasonal


def shocks(w: np.ndarray, params: np.ndarray, season: int, depth: tuple[int, int], slopes: bool = False):
    """Shocks of the differenced series ``w`` (what precedes it counts as zero), with their slopes on request."""
    plain, seasonal = _responses(params, season, depth)
    u = _filtered(_filtered(w, plain), seasonal)
    a = u - params[0] * _back(u, 1) - params[1] * _back(u, 2)
    e = a - params[2] * _back(a, season)
    if not slopes:
        return e
    b = u - params[2] * _back(u, season)
    by_plain, by_season = _filtered(e, plain), _filtered(e, seasonal)
    parts = [_back(b, 1), _back(b, 2), _back(a, season), _back(by_plain, 1), _back(by_plain, 2), _back(by_season, season)]
    return e, -np.column_stack(parts)


def invertible(params: np.ndarray, bound: float, seasonal_bound: float) -> np.ndarray:
    """``params`` with the moving-average roots drawn inside the bounds."""
    out = np.array(params, dtype=float)
    radius = np.abs(np.roots([1.0, out[3], out[4]])).max()
    if radius > bound:
        out[3:5] *= [bound / radius, (bound / radius) ** 2]
    out[5] = np.clip(out[5], -seasonal_bound, seasonal_bound)
    return out


def _expanded(p: np.ndarray) -> list[float]:
    """Own and shock lag coefficients of the multiplied-out polynomials, as :func:`forecast` reads them."""
    return [p[0], p[1], p[2], -p[0] * p[2], -p[1] * p[2], p[3], p[4], p[5], p[3] * p[5], p[4] * p[5]]


def _written(df: DataFrame) -> DataFrame:
    """A table in the shared folder: unlike a checkpoint it forgets the constraints that pile up round by round."""
    path = new_dir(df.sparkSession, "arima")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _next_trial(best: np.ndarray, gram: np.ndarray, damping: float, bounds: tuple[float, float]) -> np.ndarray:
    m = gram.reshape(N_PARAMS + 1, N_PARAMS + 1)
    normal, slope = m[:-1, :-1], m[:-1, -1]
    floor = 1e-12 * max(np.trace(normal), 1e-300)
    return invertible(best - np.linalg.solve(normal + np.diag(damping * np.diag(normal) + floor), slope), *bounds)


def _step(row: dict, gram: np.ndarray, bounds: tuple[float, float], tolerance: float) -> dict:
    """One damped Gauss-Newton decision for one series, from the cross products at its trial."""
    sse = float(gram[-1])
    row = {**row, "rounds": row["rounds"] + 1}
    gain = np.inf if row["sse"] is None else row["sse"] - sse
    if gain >= 0:
        settled = sse == 0 or (np.isfinite(gain) and gain <= tolerance * sse)
        row |= {"best": list(row["trial"]), "sse": sse, "gram": list(gram), "damping": max(row["damping"] / 10, 1e-9), "converged": bool(settled)}
    else:
        row["damping"] *= 10
        # no smaller step is better either: a minimum, as far as doubles can tell
        row["converged"] = bool(row["damping"] > 1e8)
    if not row["converged"]:
        row["trial"] = list(_next_trial(np.asarray(row["best"]), np.asarray(row["gram"]), row["damping"], bounds))
    return row


def fit_multiplicative(
    df: DataFrame, column: str, *, season: int = 24, keys: Sequence[str] = DEFAULT_KEYS, ts: str = "ts",
    size: int | None = None, cell: str | None = CELL, long_order: int | None = None, rounds: int = 30,
    tolerance: float = 1e-8, bound: float = BOUND, seasonal_bound: float = SEASONAL_BOUND,
) -> DataFrame:
    """Per series: the multiplicative (2,1,2)(1,1,1) model of least conditional sum of squares.

    Damped Gauss-Newton from the estimates of :func:`fit`, all series in the same jobs: each round
    is one pass over packed blocks that sums the 7 x 7 cross products of shocks and slopes per series.
    A block carries as many earlier rows as the moving-average filters remember: inverse roots stay
    within ``bound`` and ``seasonal_bound``, which leaves less than 1e-6 of a shock out.
    Columns: ``params`` (see ``N_PARAMS``), ``theta`` (multiplied out), ``sse``, ``n_rows``, ``rounds``,
    ``converged`` and, for series too short to be fitted, null parameters and a ``reason``.
    """
    keys, bounds = list(keys), (bound, seasonal_bound)
    depth, reach = memory(season, bound, seasonal_bound), season + 1
    base = df.select(*keys, ts, F.col(column).cast("double").alias("y")).dropna(subset=[ts, "y"])
    rows = with_position(base, keys, ts, cell=cell, name="pos", total="n")
    start = cut(fit(df, column, season=season, keys=keys, ts=ts, size=size, cell=cell, long_order=long_order))
    spread = halo(rows.drop("n"), keys, ts, pos="pos", before=sum(depth) + reach + 2, size=size)
    packed = spread.df.groupBy(*spread.partition).agg(F.sort_array(F.collect_list(F.struct("pos", "y"))).alias("r"))
    packed = cut(packed.select(*keys, "__blk", F.col("r.pos")[0].alias("lo"), F.col("r.y").alias("y")))
    prefix = _fields(base, keys)
    prefix = prefix + ", " if prefix else ""
    block_rows = spread.size

    def begin(theta):
        return list(invertible(np.asarray(theta)[[0, 1, 2, 5, 6, 7]], *bounds))

    def initial(batches):
        for pdf in batches:
            out = pdf[keys].copy()
            out["trial"] = out["best"] = [begin(t) for t in pdf["theta"]]
            out["damping"], out["rounds"], out["converged"] = 1e-3, 0, False
            out["sse"], out["gram"] = None, None
            yield out[[*keys, *(n for n, _ in fields)]]

    fields = [("trial", "array<double>"), ("best", "array<double>"), ("damping", "double"), ("rounds", "int"),
              ("converged", "boolean"), ("sse", "double"), ("gram", "array<double>")]
    schema = prefix + ", ".join(f"{n} {t}" for n, t in fields)

    def products(batches):
        for pdf in batches:
            out = pdf[keys].copy()
            out["n"], sums = 0, []
            for blk, lo, y, trial in zip(pdf["__blk"], pdf["lo"], pdf["y"], pdf["trial"]):
                y, at = np.asarray(y), max(int(blk) * block_rows - int(lo), reach)
                if len(y) <= at:  # only earlier rows of a next block that does not exist
                    sums.append(np.zeros((N_PARAMS + 1) ** 2))
                    continue
                w = np.zeros(len(y))
                w[reach:] = y[reach:] - y[reach - 1 : -1] - y[1 : len(y) - season] + y[: len(y) - reach]
                e, j = shocks(w, np.asarray(trial), season, depth, slopes=True)
                z = np.column_stack([j, e])[at:]
                sums.append((z.T @ z).ravel())
            out["g"] = sums
            yield out

    def update(batches):
        names = [n for n, _ in fields]
        for pdf in batches:
            new = [
                _step(dict(zip(names, row)), np.asarray(g), bounds, tolerance)
                for g, row in zip(pdf["g"], pdf[names].astype(object).where(pdf[names].notna(), None).itertuples(index=False, name=None))
            ]
            out = pdf[keys].copy()
            for name in names:
                out[name] = [r[name] for r in new]
            yield out

    state = cut(start.where("theta IS NOT NULL").select(*keys, "theta").mapInPandas(initial, schema))
    for _ in range(rounds):
        open_ = state.where("NOT converged")
        if open_.isEmpty():
            break
        tried = spread_join(packed, open_.select(*keys, "trial"), keys) if keys else attach(packed, open_.select("trial"))
        sums = _sum_arrays(tried.mapInPandas(products, prefix + "n bigint, g array<double>"), keys)
        moved = attach(open_, sums.select(*keys, "g"), keys).mapInPandas(update, schema)
        state = _written(state.where("converged").unionByName(moved))

    def finish(batches):
        for pdf in batches:
            out = pdf[[*keys, "sse", "rounds", "converged"]].copy()
            out["params"] = pdf["best"]
            out["theta"] = [_expanded(np.asarray(p)) for p in pdf["best"]]
            yield out

    made = state.mapInPandas(finish, prefix + "sse double, rounds int, converged boolean, params array<double>, theta array<double>")
    return attach(start.select(*keys, "n_rows", "reason"), made, keys)
