"""The multiplicative seasonal model against a direct minimiser of the same sum of squares."""

import numpy as np
import pytest
from series_frames import column, frame

from tidemark.operators import arima

S = 6


def polynomials(p):
    own = np.zeros(S + 3)
    own[[0, 1, 2, S, S + 1, S + 2]] = 1, -p[0], -p[1], -p[2], p[0] * p[2], p[1] * p[2]
    push = np.zeros(S + 3)
    push[[0, 1, 2, S, S + 1, S + 2]] = 1, p[3], p[4], p[5], p[3] * p[5], p[4] * p[5]
    return own, push


def direct_shocks(y, p):
    """The recursion itself, row by row; nothing before the first difference."""
    own, push = polynomials(p)
    w = (y[S:] - y[:-S])[1:] - (y[S:] - y[:-S])[:-1]
    w, e = np.concatenate([np.zeros(S + 2), w]), np.zeros(len(w) + S + 2)
    for t in range(S + 2, len(w)):
        e[t] = own @ w[t - S - 2 : t + 1][::-1] - push[1:] @ e[t - S - 2 : t][::-1]
    return e[S + 2 :]


def direct_fit(y, p):
    """Damped Gauss-Newton with numeric slopes over the whole series."""
    damping, e = 1e-3, direct_shocks(y, p)
    for _ in range(60):
        slopes = np.column_stack([(direct_shocks(y, p + d) - direct_shocks(y, p - d)) / 2e-5 for d in 1e-5 * np.eye(6)])
        normal = slopes.T @ slopes
        new = p - np.linalg.solve(normal + damping * np.diag(np.diag(normal)), slopes.T @ e)
        tried = direct_shocks(y, new)
        if tried @ tried < e @ e:
            done = e @ e - tried @ tried < 1e-11 * (e @ e)
            p, e, damping = new, tried, damping / 10
            if done:
                break
        else:
            damping *= 10
    return p, e @ e


def simulated(p, n, seed):
    own, push = polynomials(np.asarray(p))
    e = np.random.default_rng(seed).normal(size=n)
    w = np.zeros(n)
    for t in range(S + 2, n):
        w[t] = push @ e[t - S - 2 : t + 1][::-1] - own[1:] @ w[t - S - 2 : t][::-1]
    y = np.zeros(n)
    for t in range(S + 1, n):
        y[t] = w[t] + y[t - 1] + y[t - S] - y[t - S - 1]
    return y


TRUTH = {"a": [0.5, 0.2, 0.3, 0.3, 0.1, -0.5], None: [-0.4, 0.1, -0.5, -0.3, 0.2, -0.3]}


@pytest.fixture(scope="module")
def series():
    return {k: simulated(p, 1500, 7 + i) for i, (k, p) in enumerate(TRUTH.items())}


@pytest.fixture(scope="module")
def table(spark, series):
    parts = [frame(spark, y, series=k) for k, y in series.items()]
    return parts[0].unionByName(parts[1])


def test_shocks_are_the_recursion(series):
    y, p = series["a"], np.array(TRUTH["a"])
    w = np.zeros(len(y))
    w[S + 1 :] = y[S + 1 :] - y[S:-1] - y[1:-S] + y[: -S - 1]
    e, slopes = arima.shocks(w, p, S, arima.memory(S), slopes=True)
    assert np.allclose(e[S + 1 :], direct_shocks(y, p), atol=1e-7)
    numeric = np.column_stack([(direct_shocks(y, p + d) - direct_shocks(y, p - d)) / 2e-6 for d in 1e-6 * np.eye(6)])
    assert np.allclose(slopes[S + 1 :], numeric, atol=1e-4)


def test_coefficients_of_a_direct_minimiser(spark, series, table):
    # bounds that forget within some hundred rows, so that each series is cut into several blocks
    got = {r.series_id: r for r in arima.fit_multiplicative(table, "value", season=S, size=500, bound=0.9, seasonal_bound=0.8, long_order=20, tolerance=1e-10).collect()}
    assert set(got) == set(series)
    for key, y in series.items():
        want, sse = direct_fit(y, np.array(TRUTH[key]))
        assert got[key].converged and got[key].n_rows == len(y)
        assert np.allclose(got[key].params, want, atol=2e-3)
        assert got[key].sse == pytest.approx(sse, rel=1e-6)
        assert np.allclose(want, TRUTH[key], atol=0.25)


def test_forecast_goes_on_by_the_recursion(spark, series, table):
    model = arima.fit_multiplicative(table, "value", season=S, long_order=20)
    made = arima.forecast(table, model, "value", 8, season=S).cache()
    for row in model.collect():
        y, p = list(series[row.series_id]), np.array(row.params)
        own, push = polynomials(p)
        e = list(direct_shocks(np.array(y), p))
        w = list(np.diff(np.array(y[S:]) - np.array(y[:-S])))
        for _ in range(8):
            w.append(-own[1:] @ np.array(w[-S - 2 :])[::-1] + push[1:] @ np.array(e[-S - 2 :])[::-1])
            e.append(0.0)
            y.append(w[-1] + y[-1] + y[-S] - y[-S - 1])
        got = made.where(made.series_id.eqNullSafe(row.series_id))
        assert np.allclose(column(got, "predicted"), y[-8:], atol=1e-4 * np.ptp(y))


def test_short_and_constant_series(spark):
    flat = frame(spark, np.full(400, 3.0), series="flat")
    odd = flat.unionByName(frame(spark, np.arange(9.0), series="short"))
    got = {r.series_id: r for r in arima.fit_multiplicative(odd, "value", season=S, long_order=10).collect()}
    assert got["flat"].converged and got["flat"].sse == 0 and got["flat"].params == [0.0] * 6
    assert got["short"].params is None and "fewer than" in got["short"].reason
    made = arima.forecast(odd, arima.fit_multiplicative(odd, "value", season=S, long_order=10), "value", 2, season=S)
    assert sorted((r.series_id, r.predicted) for r in made.collect()) == [("flat", 3.0), ("flat", 3.0), ("short", None), ("short", None)]
    assert arima.fit_multiplicative(odd.limit(0), "value", season=S, long_order=10).collect() == []
