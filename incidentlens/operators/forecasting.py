"""Forecast models and the unit-root test, one task per group of series.

Spark reduces the detail rows to daily counts, brings the days of each series
together and runs all series in parallel; inside a task a series is a short
array.  A series that cannot be fitted yields one row with its `error` and does
not disturb the others."""

from __future__ import annotations

import math
from collections.abc import Callable
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


Z95 = NormalDist().inv_cdf(0.975)
Z80 = NormalDist().inv_cdf(0.9)

ARIMA, ADDITIVE = "ARIMA", "Prophet"  # names stored with the results

OUTPUT = (
    "series_id string, kind string, date date, y double, yhat double, lower_ci double, "
    "upper_ci double, model_type string, params map<string,double>, error string"
)
COLUMNS = [c.split()[0] for c in OUTPUT.split(", ")]


# --- ARIMA(p<=1, d, q<=1) ----------------------------------------------------


def _innovations(x: np.ndarray, phi: np.ndarray, theta: np.ndarray):
    """Exact Gaussian innovations of ARMA(1,1) for many (phi, theta) at once:
    sum of squared standardised errors, sum of log variances, last error and
    last variance ratio."""
    r = (1 + 2 * phi * theta + theta**2) / (1 - phi**2)
    pred = np.zeros_like(phi)
    squares, logs = np.zeros_like(phi), np.zeros_like(phi)
    for value in x:
        e = value - pred
        squares += e * e / r
        logs += np.log(r)
        pred = phi * value + theta * e / r
        last, last_r = e, r
        r = 1 + theta**2 - theta**2 / r
    return squares, logs, last, last_r


def fit_arma(x: np.ndarray, p: int, q: int) -> dict[str, float]:
    """Maximum likelihood by a shrinking grid inside the stationary and
    invertible square."""
    n = len(x)
    center, width = np.array([0.0, 0.0]), np.array([0.98 * p, 0.98 * q])
    best = None
    for _ in range(9):
        axes = [
            np.clip(np.linspace(c - w, c + w, 9), -0.999, 0.999) if w else np.array([0.0])
            for c, w in zip(center, width)
        ]
        phi, theta = (g.ravel() for g in np.meshgrid(*axes, indexing="ij"))
        squares, logs, last, last_r = _innovations(x, phi, theta)
        objective = n * np.log(np.maximum(squares / n, 1e-300)) + logs
        i = int(np.argmin(objective))
        if best is None or objective[i] <= best[0]:
            best = (objective[i], phi[i], theta[i], squares[i], logs[i], last[i], last_r[i])
        center, width = np.array([best[1], best[2]]), width * 0.3
    _, phi, theta, squares, logs, last, last_r = best
    sigma2 = max(squares / n, 1e-12)
    loglik = -0.5 * (n * math.log(2 * math.pi * sigma2) + logs + n)
    k = p + q + 1
    return {
        "phi": float(phi),
        "theta": float(theta),
        "sigma2": float(sigma2),
        "last_error": float(last / last_r),
        "aic": float(2 * k - 2 * loglik),
        "bic": float(k * math.log(n) - 2 * loglik),
    }


def horizon_deviations(phi: float, theta: float, sigma2: float, d: int, steps: int) -> np.ndarray:
    """Standard deviation of the forecast error 1..steps days ahead."""
    psi = np.array([1.0] + [phi ** (j - 1) * (phi + theta) for j in range(1, steps)])
    for _ in range(d):
        psi = np.cumsum(psi)
    return np.sqrt(sigma2 * np.cumsum(psi**2))


def arima_forecast(y: np.ndarray, order: tuple[int, int, int], steps: int):
    p, d, q = order
    x = np.diff(y, n=d)
    m = fit_arma(x, p, q)
    ahead = np.empty(steps)
    value = m["phi"] * x[-1] + m["theta"] * m["last_error"]
    for h in range(steps):
        ahead[h] = value
        value = m["phi"] * value
    for back in range(d - 1, -1, -1):
        ahead = np.diff(y, n=back)[-1] + np.cumsum(ahead)
    half = Z95 * horizon_deviations(m["phi"], m["theta"], m["sigma2"], d, steps)
    return ahead, ahead - half, ahead + half, m


# --- additive trend and seasonality ------------------------------------------

CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
CHANGEPOINT_SCALE = 0.05
SEASONALITY_SCALE = 10.0
GROWTH_SCALE = 5.0
SEASONS = ((365.25, 10), (7.0, 3))  # a within-day season is constant on daily data


def _design(day: np.ndarray, t: np.ndarray, knots: np.ndarray) -> np.ndarray:
    waves = [
        f(2 * np.pi * k * day / period)
        for period, pairs in SEASONS
        for k in range(1, pairs + 1)
        for f in (np.sin, np.cos)
    ]
    hinges = np.maximum(t[:, None] - knots[None, :], 0.0)
    return np.column_stack([np.ones_like(t), t, *waves, hinges])


def additive_forecast(day: np.ndarray, y: np.ndarray, future: np.ndarray):
    """Piecewise linear trend plus Fourier seasons, fitted as a posterior mode:
    normal priors on growth and seasons, a Laplace prior on slope changes
    (reached by reweighted ridge steps)."""
    start, span = day[0], max(day[-1] - day[0], 1)
    scale = np.abs(y).max() or 1.0
    z = y / scale
    to_t = lambda d: (d - start) / span
    t = to_t(day)
    n_knots = min(CHANGEPOINTS, int(len(day) * CHANGEPOINT_RANGE) - 1)
    at = np.linspace(0, int(len(day) * CHANGEPOINT_RANGE) - 1, n_knots + 1).round().astype(int)[1:]
    knots = t[at]
    X = _design(day.astype(float), t, knots)
    fixed = X.shape[1] - len(knots)
    precision = np.full(X.shape[1], SEASONALITY_SCALE**-2)
    precision[:2] = GROWTH_SCALE**-2
    gram, moment = X.T @ X, X.T @ z
    sigma2, delta = max(z.var() / 4, 1e-8), np.full(len(knots), CHANGEPOINT_SCALE)
    for _ in range(40):
        precision[fixed:] = 1.0 / (CHANGEPOINT_SCALE * np.maximum(np.abs(delta), 1e-6))
        beta = np.linalg.solve(gram + sigma2 * np.diag(precision), moment)
        sigma2 = max(float(np.mean((z - X @ beta) ** 2)), 1e-10)
        if np.max(np.abs(beta[fixed:] - delta), initial=0.0) < 1e-7:
            break
        delta = beta[fixed:]
    tf = to_t(future)
    mean = _design(future.astype(float), tf, knots) @ beta
    # slope changes go on after the history at the rate and size seen in it
    beyond = np.maximum(tf - 1.0, 0.0)
    drift = len(knots) * 2 * float(np.mean(np.abs(beta[fixed:]))) ** 2 * beyond**3 / 3 if len(knots) else 0.0
    half = Z80 * np.sqrt(sigma2 + drift)
    params = {"sigma": math.sqrt(sigma2) * scale, "slope_per_day": float(beta[1]) * scale / span}
    return mean * scale, (mean - half) * scale, (mean + half) * scale, params


# --- running models over all series ------------------------------------------


def spread(series: DataFrame) -> DataFrame:
    """One series per task where possible: series are small but slow to fit, so
    partitions must not be merged by size."""
    tasks = 4 * series.sparkSession.sparkContext.defaultParallelism
    return series.repartition(tasks, "series_id")


def _model(model_type: str, order) -> Callable:
    if model_type.lower() == ARIMA.lower():
        if order[0] not in (0, 1) or order[2] not in (0, 1):
            raise ValueError(f"ARIMA{order} is not supported: p and q must be 0 or 1")
        return lambda day, y, future: arima_forecast(y, order, len(future))
    if model_type.lower() == ADDITIVE.lower():
        return additive_forecast
    raise ValueError(f"Unknown model type: {model_type}")


def run_model(
    series: DataFrame,
    model_type: str,
    days_ahead: int = 30,
    order: tuple[int, int, int] = (1, 1, 1),
    share: float = 0.8,
    offset_from_train: bool = False,
    min_days: int | None = None,
) -> DataFrame:
    """Fit each series of (series_id, date, y) and return one long table.

    kind = "test": days after the first `share` of the series, forecast from the
    model fitted on that share.  kind = "future": `days_ahead` days after the
    last one, from a model refitted on all days; `offset_from_train` instead
    uses the training fit's first steps under those dates.  kind = "error": a
    single row for a series that failed.  `params` describes the fit.  A series is
    too short only if the caller says so by `min_days`."""
    forecast = _model(model_type, order)
    name = ARIMA if model_type.lower() == ARIMA.lower() else ADDITIVE

    def per_series(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date")
        y = pdf["y"].to_numpy(float)
        day = pd.to_datetime(pdf["date"]).to_numpy().astype("datetime64[D]").astype("int64")
        n = len(y)

        def rows(kind, days, actual, result):
            mean, low, high, params = result
            return pd.DataFrame(
                {
                    "series_id": key[0],
                    "kind": kind,
                    "date": pd.to_datetime(days.astype("datetime64[D]")).date,
                    "y": actual,
                    "yhat": mean,
                    "lower_ci": low,
                    "upper_ci": high,
                    "model_type": name,
                    "params": [params] * len(days),
                    "error": None,
                }
            )

        try:
            if min_days is not None and n <= min_days:
                raise ValueError(f"needs more than {min_days} days, has {n}")
            cut = int(n * share)
            future = day[-1] + 1 + np.arange(days_ahead)
            test = forecast(day[:cut], y[:cut], day[cut:])
            out = [rows("test", day[cut:], y[cut:], test)]
            if days_ahead:
                if offset_from_train:
                    steps = day[cut - 1] + 1 + np.arange(days_ahead) if name == ARIMA else future
                    ahead = forecast(day[:cut], y[:cut], steps)
                else:
                    ahead = forecast(day, y, future)
                out.append(rows("future", future, np.nan, ahead))
            return pd.concat(out, ignore_index=True)
        except Exception as err:  # recorded with the series
            return pd.DataFrame(
                [[key[0], "error", None, None, None, None, None, name, None, str(err)]],
                columns=COLUMNS,
            )

    narrow = series.select("series_id", "date", "y")
    out = spread(narrow).groupBy("series_id").applyInPandas(per_series, OUTPUT)
    # pandas has no null double: the actual of a future day comes back as NaN
    return out.withColumn("y", F.when(~F.isnan("y"), F.col("y")))


def test_rows(fitted: DataFrame) -> DataFrame:
    return fitted.filter(F.col("kind") == "test")


def future_rows(fitted: DataFrame) -> DataFrame:
    return fitted.filter(F.col("kind") == "future").select(
        "series_id", "date", F.col("yhat").alias("forecast"), "lower_ci", "upper_ci", "model_type"
    )


# --- augmented Dickey-Fuller ---------------------------------------------------
# MacKinnon's published response surfaces, constant, no trend.
CRITICAL = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}
P_LOW, P_HIGH, P_SPLIT = -18.83, 2.74, -1.61
P_SMALL = (2.1659, 1.4412, 0.038269)
P_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)

ADF_OUTPUT = (
    "series_id string, adf_statistic double, p_value double, used_lag int, n_obs int, "
    "critical_1 double, critical_5 double, critical_10 double, is_stationary boolean, error string"
)


def _least_squares(X: np.ndarray, z: np.ndarray):
    beta, *_ = np.linalg.lstsq(X, z, rcond=None)
    rss = float(np.sum((z - X @ beta) ** 2))
    return beta, rss


def adf(y: np.ndarray) -> tuple[float, float, int, int]:
    """(statistic, p-value, lag, observations); the lag has the lowest AIC among
    regressions on a common sample and the statistic uses all days it allows."""
    n = len(y)
    if n < 8 or np.all(y == y[0]):
        raise ValueError("series is too short or constant")
    top = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)
    dy = np.diff(y)

    def regression(lags: int, skip: int):
        z = dy[skip:]
        past = [dy[skip - j : len(dy) - j] for j in range(1, lags + 1)]
        return np.column_stack([y[skip:-1], *past, np.ones(len(z))]), z

    def aic(lags: int) -> float:
        X, z = regression(lags, top)
        _, rss = _least_squares(X, z)
        m = len(z)
        return m * (math.log(2 * math.pi * max(rss, 1e-300) / m) + 1) + 2 * X.shape[1]

    lag = min(range(top + 1), key=aic)
    X, z = regression(lag, lag)
    beta, rss = _least_squares(X, z)
    m, k = X.shape
    variance = rss / (m - k) * np.linalg.pinv(X.T @ X)[0, 0]
    stat = float(beta[0] / math.sqrt(variance))
    if stat > P_HIGH:
        p = 1.0
    elif stat < P_LOW:
        p = 0.0
    else:
        c = P_SMALL if stat <= P_SPLIT else P_LARGE
        p = NormalDist().cdf(sum(a * stat**i for i, a in enumerate(c)))
    return stat, p, lag, m


def stationarity(series: DataFrame) -> DataFrame:
    """Unit-root test of every series; stationary when the p-value is below 0.05."""

    def per_series(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        columns = [c.split()[0] for c in ADF_OUTPUT.split(", ")]
        try:
            y = pdf.sort_values("date")["y"].dropna().to_numpy(float)
            stat, p, lag, m = adf(y)
            limits = [sum(b / m**i for i, b in enumerate(CRITICAL[c])) for c in ("1%", "5%", "10%")]
            row = [key[0], stat, p, lag, m, *limits, p < 0.05, None]
        except Exception as err:  # recorded with the series
            row = [key[0], *[None] * 8, str(err)]
        return pd.DataFrame([row], columns=columns)

    narrow = series.select("series_id", "date", "y")
    return spread(narrow).groupBy("series_id").applyInPandas(per_series, ADF_OUTPUT)
