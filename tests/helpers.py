"""Small panels and plain-Python models that the Spark results are compared with."""

import datetime as dt

import numpy as np


def months(n, year=2020, month=1):
    return [dt.date(year + (month - 1 + i) // 12, (month - 1 + i) % 12 + 1, 1) for i in range(n)]


def seasonal_values(n, seed=0, level=1000.0, slope=5.0, swing=200.0, noise=20.0):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return np.round(level + slope * t + swing * np.sin(2 * np.pi * t / 12) + noise * rng.standard_normal(n), 2)


def panel(spark, series, start=2020):
    """``series`` maps a key to its monthly values."""
    rows = [(k, d, float(v)) for k, vs in series.items() for d, v in zip(months(len(vs), start), vs, strict=True)]
    return spark.createDataFrame(rows, "City string, period date, sales double")


def smooth_by_hand(ys, kind, alpha, beta, gamma, m=12):
    """Textbook recursion with the season indexed by position."""
    season = [0.0] * m
    if kind == "holt_winters":
        level = sum(ys[:m]) / m
        slope = (sum(ys[m : 2 * m]) - sum(ys[:m])) / m**2
        season, begin = [y - level for y in ys[:m]], m
    elif kind == "holt":
        level, slope, begin = ys[1], ys[1] - ys[0], 2
    else:
        level, slope, begin, beta = ys[0], 0.0, 1, 0.0
    sse, fitted = 0.0, []
    for t in range(begin, len(ys)):
        k = t % m
        f = level + slope + season[k]
        fitted.append(f)
        sse += (ys[t] - f) ** 2
        new = alpha * (ys[t] - season[k]) + (1 - alpha) * (level + slope)
        moved = gamma * (ys[t] - level - slope) + (1 - gamma) * season[k]
        slope = beta * (new - level) + (1 - beta) * slope
        if kind == "holt_winters":
            season[k] = moved
        level = new
    n = len(ys)
    return sse, fitted, lambda h: level + h * slope + season[(n + h - 1) % m]


def search_by_hand(ys, kind, axes, half_steps, m=12):
    """Best (sse, alpha, beta, gamma) of the grid and of one pass around the winner."""
    grid = [(a, b, g) for a in axes[0] for b in axes[1] for g in axes[2]]
    best = min((smooth_by_hand(ys, kind, *p, m)[0], *p) for p in grid)
    steps = [(-h, 0.0, h) if h else (0.0,) for h in half_steps]

    def move(x, d, h):
        return min(0.99, max(0.01, x + d)) if h else x

    near = [
        tuple(move(x, d, h) for x, d, h in zip(best[1:], (da, db, dg), half_steps, strict=True))
        for da in steps[0]
        for db in steps[1]
        for dg in steps[2]
    ]
    return min((smooth_by_hand(ys, kind, *p, m)[0], *p) for p in near)


def arima_by_hand(ys, p, d, q, steps):
    """Two-stage least squares with loops and ``lstsq``-style normal equations."""
    scale = max(abs(y) for y in ys)
    levels = [np.array(ys) / scale]
    for _ in range(d):
        levels.append(np.diff(levels[-1]))
    mean = levels[-1].mean() if d == 0 else 0.0
    w = levels[-1] - mean

    def regress(x, y):
        return np.linalg.solve(x.T @ x + 1e-8 * np.eye(x.shape[1]), x.T @ y)

    m = max(p, q) + 2
    e = {}
    if q:
        x = np.array([[w[t - i] for i in range(1, m + 1)] for t in range(m, len(w))])
        long = regress(x, w[m:])
        e = {t: w[t] - x[t - m] @ long for t in range(m, len(w))}
    first = m + q if q else p
    x = np.array(
        [[w[t - i] for i in range(1, p + 1)] + [e[t - j] for j in range(1, q + 1)] for t in range(first, len(w))]
    )
    coef = regress(x, w[first:])
    phi, theta = coef[:p].copy(), coef[p:].copy()
    if p:
        r = max(abs(np.roots(np.concatenate([[1.0], -phi]))))
        if r >= 0.98:
            phi = phi * (0.98 / r) ** np.arange(1, p + 1)
    if q == 1:
        t0 = 1 / theta[0] if abs(theta[0]) > 1 else theta[0]
        theta = np.array([min(0.98, max(-0.98, t0))])
    elif q > 1:
        r = max(abs(np.roots(np.concatenate([[1.0], theta]))))
        if r >= 0.98:
            theta = theta * (0.98 / r) ** np.arange(1, q + 1)
    resid = np.zeros(len(w))
    for t in range(p, len(w)):
        back = [resid[t - j] if t - j >= p else 0.0 for j in range(1, q + 1)]
        resid[t] = w[t] - sum(phi[i] * w[t - 1 - i] for i in range(p)) - np.dot(theta, back)
    hist, errs, path = list(w), list(resid), []
    for _ in range(steps):
        nxt = sum(phi[i] * hist[-1 - i] for i in range(p)) + sum(theta[j] * errs[-1 - j] for j in range(q))
        hist.append(nxt)
        errs.append(0.0)
        path.append(nxt + mean)
    path = np.array(path)
    for level in range(d - 1, -1, -1):
        path = levels[level][-1] + np.cumsum(path)
    return np.concatenate([phi, theta]), path * scale
