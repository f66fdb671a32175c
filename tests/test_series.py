from datetime import date, timedelta

import numpy as np
import pytest
from helpers import incidents
from incidentlens.operators import forecasting as fc
from incidentlens.operators import series as sr
from incidentlens.operators.staging import typed

START = date(2023, 1, 1)


def daily(spark, name_to_values):
    rows = [(n, START + timedelta(days=i), float(v)) for n, vs in name_to_values.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "series_id string, date date, y double")


def simulate(phi, theta, n, seed=0, level=500.0):
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 10, n + 1)
    d = np.zeros(n)
    for t in range(n):
        d[t] = (phi * d[t - 1] if t else 0) + e[t + 1] + theta * e[t]
    return level + np.cumsum(d)


def test_gaps_become_zero(spark):
    rows = [("2024-01-01T05:00:00", "A"), ("2024-01-04T05:00:00", "A"), ("2024-01-04T06:00:00", "A"), ("2024-01-02T00:00:00", "B")]
    out = sr.daily_series(typed(incidents(spark, rows)))
    got = {}
    for r in out.orderBy("date").collect():
        got.setdefault(r.series_id, []).append(r.y)
    assert got == {"A": [1.0, 0.0, 0.0, 2.0], "B": [1.0], "ALL": [1.0, 1.0, 0.0, 2.0]}
    only = sr.daily_series(typed(incidents(spark, rows)), ["A"], total=False)
    assert {r.series_id for r in only.collect()} == {"A"}


def test_total_and_types_come_from_one_scan(spark):
    plan = sr.daily_series(typed(incidents(spark, [("2024-01-01T05:00:00", "A")])))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def reference_decomposition(y, p):
    n, h = len(y), p // 2
    weights = np.full(p, 1 / p) if p % 2 else np.array([0.5, *[1] * (p - 1), 0.5]) / p
    trend = np.full(n, np.nan)
    for i in range(h, n - h):
        trend[i] = (y[i - h : i + h + 1] * weights).sum()
    phases = np.array([np.nanmean((y - trend)[k::p]) for k in range(p)])
    seasonal = np.resize(phases - phases.mean(), n)
    return trend, seasonal, y - trend - seasonal


@pytest.mark.parametrize("period", [7, 6])
def test_decomposition(spark, period):
    y = np.random.default_rng(3).normal(100, 10, 45)
    out = sr.seasonal_decompose(daily(spark, {"s": y}), period).orderBy("date").collect()
    for name, want in zip(("trend", "seasonal", "residual"), reference_decomposition(y, period)):
        got = np.array([np.nan if r[name] is None else r[name] for r in out])
        assert np.allclose(got, want, equal_nan=True), name
    assert all(r.error is None for r in out)


def test_short_series_fails_alone(spark):
    out = sr.seasonal_decompose(daily(spark, {"short": [1] * 10, "long": range(20)}), 7)
    errors = {r.series_id for r in out.filter("error is not null").collect()}
    assert errors == {"short"} and out.filter("series_id = 'long' and trend is not null").count() == 14


def test_split_is_chronological(spark):
    out = sr.chronological_split(daily(spark, {"s": range(11)})).orderBy("date").collect()
    assert [r.is_train for r in out] == [True] * 8 + [False] * 3


def test_metrics_with_a_zero_day(spark):
    rows = [("s", "m", 0.0, 1.0), ("s", "m", 10.0, 8.0), ("s", "m", 5.0, 6.0)]
    df = spark.createDataFrame(rows, "series_id string, model_type string, y double, yhat double")
    m = sr.forecast_metrics(df).first()
    assert m.mae == pytest.approx(4 / 3) and m.rmse == pytest.approx(2**0.5)
    assert m.mape == pytest.approx(20.0) and m.zero_days == 1
    assert sr.forecast_metrics(df, infinite_mape=True).first().mape == float("inf")


def test_arima_must_be_strictly_better(spark):
    rows = [("tie", "ARIMA", 1.0, 1.0), ("tie", "Prophet", 1.0, 1.0), ("a", "ARIMA", 1.0, 1.0), ("a", "Prophet", 1.0, 1.2)]
    df = spark.createDataFrame(rows, "series_id string, model_type string, mae double, rmse double")
    assert {r.series_id: r.best_model for r in sr.choose_model(df).collect()} == {"tie": "Prophet", "a": "ARIMA"}


def test_published_interval_widths():
    half = fc.Z95 * fc.horizon_deviations(-0.1745, -0.599, 73.52**2, 1, 14)
    assert np.allclose(half[:4], [144.10, 147.74, 156.66, 164.06], atol=0.1)
    assert abs(half[13] - 226.14) < 0.1


@pytest.mark.parametrize("phi,theta", [(0.6, 0.0), (-0.3, 0.5), (0.2, -0.7)])
def test_arima_recovers_its_parameters(phi, theta):
    m = fc.fit_arma(np.diff(simulate(phi, theta, 3000, seed=4)), 1, 1)
    assert abs(m["phi"] - phi) < 0.1 and abs(m["theta"] - theta) < 0.1 and abs(m["sigma2"] ** 0.5 - 10) < 0.5


def test_exact_likelihood_matches_covariance_matrix():
    phi, theta, n = 0.5, -0.3, 12
    x = np.random.default_rng(0).normal(size=n)
    psi = [1.0] + [phi ** (j - 1) * (phi + theta) for j in range(1, 4000)]
    acov = [sum(psi[i] * psi[i + k] for i in range(4000 - n)) for k in range(n)]
    cov = np.array([[acov[abs(i - j)] for j in range(n)] for i in range(n)])
    squares, logs, *_ = fc._innovations(x, np.array([phi]), np.array([theta]))
    assert np.isclose(squares[0], x @ np.linalg.solve(cov, x)) and np.isclose(logs[0], np.linalg.slogdet(cov)[1])


def test_forecasts_of_many_series(spark):
    df = daily(spark, {"a": simulate(0.3, -0.5, 120), "b": simulate(0.0, 0.4, 90, 1), "short": range(20)})
    out = fc.run_model(df, "arima", days_ahead=14, min_days=30)
    rows = out.collect()
    errors = [r for r in rows if r.kind == "error"]
    assert [e.series_id for e in errors] == ["short"] and "30 days" in errors[0].error
    for name, n in (("a", 120), ("b", 90)):
        test = [r for r in rows if r.series_id == name and r.kind == "test"]
        future = sorted((r for r in rows if r.series_id == name and r.kind == "future"), key=lambda r: r.date)
        assert len(test) == n - int(n * 0.8) and len(future) == 14
        assert future[0].date == START + timedelta(days=n) and future[0].y is None
        widths = [r.upper_ci - r.lower_ci for r in future]
        assert all(b >= a for a, b in zip(widths, widths[1:]))
        assert set(future[0].params) >= {"phi", "theta", "sigma2", "aic", "bic"}


def test_offset_form_repeats_training_steps(spark):
    y = simulate(0.3, -0.5, 100)
    out = fc.run_model(daily(spark, {"a": y}), "ARIMA", 10, offset_from_train=True)
    rows = sorted(out.collect(), key=lambda r: r.date)
    test = [r.yhat for r in rows if r.kind == "test"][:10]
    future = [r for r in rows if r.kind == "future"]
    assert np.allclose(test, [r.yhat for r in future]) and future[0].date == START + timedelta(days=100)


def test_model_names_and_orders(spark):
    df = daily(spark, {"a": range(50)})
    with pytest.raises(ValueError):
        fc.run_model(df, "naive")
    with pytest.raises(ValueError):
        fc.run_model(df, "arima", order=(3, 1, 0))
    drift = fc.run_model(df, "arima", 3, order=(0, 2, 0)).filter("kind = 'future'").orderBy("date").collect()
    assert np.allclose([r.yhat for r in drift], [50, 51, 52])


def test_additive_model_follows_trend_and_week(spark):
    t = np.arange(200)
    y = 300 + 0.5 * t + 30 * np.sin(2 * np.pi * t / 7)
    out = fc.run_model(daily(spark, {"s": y}), "prophet", 28).filter("kind = 'future'").orderBy("date").collect()
    want = 300 + 0.5 * np.arange(200, 228) + 30 * np.sin(2 * np.pi * np.arange(200, 228) / 7)
    got = np.array([r.yhat for r in out])
    assert np.abs(got - want).mean() < 12
    assert all(r.lower_ci < r.yhat < r.upper_ci and r.model_type == "Prophet" for r in out)


def test_stationarity(spark):
    rng = np.random.default_rng(5)
    df = daily(spark, {"noise": rng.normal(0, 1, 300), "walk": np.cumsum(rng.normal(0, 1, 300)), "flat": [3] * 50})
    out = {r.series_id: r for r in fc.stationarity(df).collect()}
    assert out["noise"].is_stationary and not out["walk"].is_stationary
    assert out["flat"].error and out["flat"].is_stationary is None
    assert out["noise"].critical_1 == pytest.approx(-3.4525, abs=0.01)


def test_p_values_at_published_critical_values():
    from statistics import NormalDist

    for stat, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        got = NormalDist().cdf(sum(c * stat**i for i, c in enumerate(fc.P_SMALL)))
        assert got == pytest.approx(p, abs=0.002)


def test_short_series_is_fitted_unless_the_caller_objects(spark):
    from incidentlens.operators.forecasting import run_model

    ten = spark.sql(
        "SELECT 's' AS series_id, date_add(DATE'2024-01-01', cast(id AS int)) AS date,"
        " cast(5 + id % 3 AS double) AS y FROM range(10)"
    )
    assert {r.kind for r in run_model(ten, "ARIMA", days_ahead=2).collect()} == {"test", "future"}
    assert {r.kind for r in run_model(ten, "ARIMA", min_days=30).collect()} == {"error"}
