"""Direct numpy versions of series statistics, to test the expressions against."""

from __future__ import annotations

import math

import numpy as np

from tradecast.operators.series import ADF_CRIT_C


def _ols(y: np.ndarray, X: np.ndarray):
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    resid = y - X @ beta
    ssr = float(resid @ resid)
    return beta, ssr


def _aic(ssr: float, nobs: int, k: int) -> float:
    llf = -nobs / 2.0 * (math.log(2 * math.pi) + math.log(ssr / nobs) + 1.0)
    return -2.0 * llf + 2.0 * k


def _lagged(x: np.ndarray, lags: int):
    """Regressand Δx_t and regressors [x_{t-1}, Δx_{t-1}, …, Δx_{t-lags}]."""
    dx = np.diff(x)
    nobs = len(dx) - lags
    cols = [x[-nobs - 1:-1]] + [dx[lags - j: lags - j + nobs] for j in range(1, lags + 1)]
    return dx[-nobs:], np.column_stack(cols), nobs


def adf_test(values: np.ndarray) -> dict:
    """Augmented Dickey–Fuller with a constant, lag length by AIC on a common
    sample, then refit on the full sample with the chosen lag."""
    x = np.asarray(values, dtype=float)
    n = len(x)
    maxlag = int(math.ceil(12.0 * (n / 100.0) ** 0.25))
    maxlag = min(n // 2 - 2, maxlag)
    if maxlag < 0:
        return {"n_obs": 0, "used_lag": None, "adf_stat": None}
    y, lagged, nobs = _lagged(x, maxlag)
    full = np.column_stack([np.ones(nobs), lagged])
    best = None
    for k in range(2, 2 + maxlag + 1):
        _, ssr = _ols(y, full[:, :k])
        aic = _aic(ssr, nobs, k)
        if best is None or aic < best[0]:
            best = (aic, k - 2)
    lag = best[1]
    y, lagged, nobs = _lagged(x, lag)
    X = np.column_stack([lagged[:, :lag + 1], np.ones(nobs)])
    beta, ssr = _ols(y, X)
    sigma2 = ssr / (nobs - X.shape[1])
    cov = sigma2 * np.linalg.inv(X.T @ X)
    stat = float(beta[0] / math.sqrt(cov[0, 0]))
    crit = {k: b[0] + b[1] / nobs + b[2] / nobs ** 2 + b[3] / nobs ** 3 for k, b in ADF_CRIT_C.items()}
    return {"n_obs": nobs, "used_lag": lag, "adf_stat": stat, "crit_1pct": crit["1%"],
            "crit_5pct": crit["5%"], "crit_10pct": crit["10%"], "stationary_5pct": int(stat < crit["5%"])}
