"""NumPy kernels the models hand to Arrow-batched functions.

The functions are pickled by value, so executors need NumPy and pandas but not this package.
"""

import itertools
import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

BATCH_ROWS = 1024
CELLS = 4_000_000  # doubles in the largest array of a block, candidates included
LOWEST, HIGHEST = 0.01, 0.99
RIDGE = 1e-8
MAX_ROOT = 0.98

# Seasons (period in days, pairs) and prior scales of the additive regression.
SEASONS = ((365.25, 10), (30.5, 3))
MAX_CHANGEPOINTS = 25
CHANGEPOINT_SHARE = 0.8
PRIOR_TREND, PRIOR_CHANGE, PRIOR_SEASON = 5.0, 0.05, 10.0
ITERATIONS = 10
MIN_CURVE_POINTS = 5
CURVE_FIELDS = ("t0", "span", "scale", "sigma", "trend", "changes", "hinges", "season")


# --- batches --------------------------------------------------------------------------


def by_length(values: pd.Series, *labels, cells=1):
    """Yield ``(rows, matrix, label…)`` for the non-null arrays of equal length and labels. A block has
    at most ``BATCH_ROWS`` rows and, with ``cells`` doubles of working memory a value, ``CELLS`` of them;
    a single row is always a block."""
    groups = {}
    for i, v in enumerate(values):
        key = tuple(column.iloc[i] for column in labels)
        if v is not None and all(part is not None for part in key):
            groups.setdefault((len(v), *key), []).append(i)
    for (length, *key), rows in groups.items():
        block = max(1, min(BATCH_ROWS, CELLS // max(1, length * cells)))
        for start in range(0, len(rows), block):
            part = rows[start : start + block]
            yield (part, np.stack([np.asarray(values.iloc[i], dtype=float) for i in part]), *key)


# --- smoothing parameters ---------------------------------------------------------------


def one_step_forecasts(y, kind, m, alpha, beta, gamma):
    """Yield ``(t, forecast)`` for every series (rows of ``y``) under every candidate (columns
    of the parameter matrices), from the first value not used to start the recursion."""
    season = [0.0] * max(m, 1)
    if kind == "holt_winters":
        first, second = y[:, :m].sum(axis=1), y[:, m : 2 * m].sum(axis=1)
        level = np.broadcast_to((first / m)[:, None], alpha.shape)
        trend = ((second - first) / (m * m))[:, None]
        season = [y[:, [k]] - level for k in range(m)]
        begin = m
    elif kind == "holt":
        level, trend, begin = y[:, [1]], y[:, [1]] - y[:, [0]], 2
    else:
        level, trend, begin = y[:, [0]], 0.0, 1
    for t in range(begin, y.shape[1]):
        value, k = y[:, [t]], t % max(m, 1)
        base, s = level + trend, season[k]
        yield t, base + s
        new_level = alpha * (value - s) + (1 - alpha) * base
        if kind != "ses":
            trend = beta * (new_level - level) + (1 - beta) * trend
        if kind == "holt_winters":
            season[k] = gamma * (value - base) + (1 - gamma) * s
        level = new_level


def smoothing_error(y, kind, m, alpha, beta, gamma):
    """Sum of squared one-step errors per series and candidate."""
    sse = np.zeros(alpha.shape)
    for t, forecast in one_step_forecasts(y, kind, m, alpha, beta, gamma):
        sse += (y[:, [t]] - forecast) ** 2
    return sse


def pick(y, kind, m, candidates):
    """Winning ``(sse, alpha, beta, gamma)`` rows; candidates are in ascending order, so the
    first minimum is also the smallest parameter set."""
    with np.errstate(all="ignore"):
        sse = smoothing_error(y, kind, m, *(candidates[:, :, j] for j in range(3)))
    sse = np.where(np.isnan(sse), np.inf, sse)
    best = sse.argmin(axis=1)
    rows = np.arange(len(y))
    return np.column_stack([sse[rows, best], candidates[rows, best]])


def around(best, half_steps):
    """Candidates one step below, at and above the winner in every searched direction."""
    sides = [(-h, 0.0, h) if h else (0.0,) for h in half_steps]
    moves = np.array(list(itertools.product(*sides)))
    searched = np.array([h > 0 for h in half_steps])
    moved = best[:, None, 1:] + moves[None, :, :]
    return np.where(searched, np.clip(moved, LOWEST, HIGHEST), moved)


def search_rows(plans, m, refine):
    """Grid search, then ``refine`` passes of halving steps around the winner.

    ``plans`` maps a model kind to its grid axes and half steps. A row whose errors are all infinite is
    searched again with the level-only kind; ``kind`` tells which one the parameters are of.
    """
    width = max(len(list(itertools.product(*axes))) for axes, _ in plans.values())

    def search(y, name):
        axes, half_steps = plans[name]
        grid = np.array(list(itertools.product(*axes)))
        best = pick(y, name, m, np.broadcast_to(grid, (len(y), *grid.shape)))
        for i in range(refine):
            best = pick(y, name, m, around(best, [h * 0.5**i for h in half_steps]))
        return best

    def run(kind: pd.Series, ys: pd.Series) -> pd.DataFrame:
        found, used = np.full((len(ys), 4), np.nan), kind.astype(object).copy()
        for rows, y, name in by_length(ys, kind, cells=width):
            best = search(y, name)
            broken = np.flatnonzero(~np.isfinite(best[:, 0]))
            if len(broken) and name != "ses":
                best[broken] = search(y[broken], "ses")
                used.iloc[np.array(rows)[broken]] = "ses"
            found[rows] = best
        out = pd.DataFrame(found, columns=["sse", "alpha", "beta", "gamma"])
        return out.assign(kind=used.to_numpy())

    return run


def fitted_rows(m):
    """One-step forecasts of whole series under their own parameters."""

    def run(kind: pd.Series, ys: pd.Series, alpha: pd.Series, beta: pd.Series, gamma: pd.Series) -> pd.Series:
        found = [None] * len(ys)
        for rows, y, name in by_length(ys, kind):
            given = [column.iloc[rows].to_numpy()[:, None] for column in (alpha, beta, gamma)]
            steps = [np.broadcast_to(f, (len(y), 1)) for _, f in one_step_forecasts(y, name, m, *given)]
            values = np.concatenate(steps, axis=1) if steps else np.empty((len(y), 0))
            for i, row in zip(rows, values, strict=True):
                found[i] = row
        return pd.Series(found, dtype=object)

    return run


# --- two-stage least squares ------------------------------------------------------------


def lagged(values, lags, first):
    """Columns ``values[t - lag]`` for ``t = first…``, per series."""
    width = values.shape[1]
    return np.stack([values[:, first - lag : width - lag] for lag in lags], axis=2)


def least_squares(design, target):
    """Coefficients of every series from its normal equations."""
    k = design.shape[2]
    gram = np.einsum("bti,btj->bij", design, design)
    gram[:, np.arange(k), np.arange(k)] += RIDGE
    cross = np.einsum("bti,bt->bi", design, target)
    return np.linalg.solve(gram, cross[:, :, None])[:, :, 0]


def two_stage(w, p, q):
    """AR and MA coefficients; the MA regressors are residuals of a long autoregression."""
    first, parts = p, [lagged(w, range(1, p + 1), p)] if p else []
    if q:
        m = max(p, q) + 2
        design = lagged(w, range(1, m + 1), m)
        residual = w[:, m:] - np.einsum("btk,bk->bt", design, least_squares(design, w[:, m:]))
        first = m + q
        parts = [lagged(w, range(1, p + 1), first)] if p else []
        parts.append(lagged(residual, range(1, q + 1), q))
    return least_squares(np.concatenate(parts, axis=2), w[:, first:])


# --- root limits ----------------------------------------------------------------------


def largest_root(coefs):
    """Largest modulus among the roots of z^k - c1 z^(k-1) - … - ck, per row."""
    n, k = coefs.shape
    companion = np.zeros((n, k, k))
    companion[:, 0, :] = coefs
    companion[:, np.arange(1, k), np.arange(k - 1)] = 1.0
    return np.abs(np.linalg.eigvals(companion)).max(axis=1)


def shrink(coefs, modulus):
    """Pull roots inside the limit: the k-th coefficient is scaled by the k-th power."""
    ratio = np.where(modulus >= MAX_ROOT, MAX_ROOT / np.maximum(modulus, MAX_ROOT), 1.0)
    return coefs * ratio[:, None] ** np.arange(1, coefs.shape[1] + 1)


def stable(phi, theta):
    """AR and MA coefficients with all roots inside the limit."""
    if phi.shape[1]:
        phi = shrink(phi, largest_root(phi))
    if theta.shape[1] == 1:
        large = np.abs(theta) > 1
        theta = np.where(large, 1 / np.where(large, theta, 1.0), theta)
        theta = np.clip(theta, -MAX_ROOT, MAX_ROOT)
    elif theta.shape[1]:
        theta = shrink(theta, largest_root(-theta))
    return phi, theta


def limited(raw, p):
    """Coefficients inside the limits, and which rows they were moved for."""
    fixed = np.concatenate(stable(raw[:, :p], raw[:, p:]), axis=1)
    return fixed, ~np.isclose(fixed, raw, rtol=0, atol=1e-12).all(axis=1)


def arma_rows(p, q):
    def run(w: pd.Series) -> pd.DataFrame:
        found = [(None, None)] * len(w)
        for rows, matrix in by_length(w):
            raw = two_stage(matrix, p, q)
            solved = np.isfinite(raw).all(axis=1)  # a failed solve has no coefficients
            rows, raw = np.array(rows)[solved], raw[solved]
            for i, coef, flag in zip(rows, *limited(raw, p), strict=True):
                found[i] = (coef, bool(flag))
        return pd.DataFrame(found, columns=["coef", "adjusted"], dtype=object)

    return run


def solve_moments(
    n: pd.Series, peak: pd.Series, centre: pd.Series, sums: pd.Series, cross: pd.Series, target_sum: pd.Series, target_cross: pd.Series
) -> pd.Series:
    """Least-squares coefficients from moment rows: products about ``centre`` in units of ``peak``."""
    if not len(n):
        return pd.Series([], dtype=object)
    sums, cross, target_cross = (np.stack([np.asarray(x, float) for x in column]) for column in (sums, cross, target_cross))
    k = sums.shape[1]
    count, mean, target = (column.to_numpy(float)[:, None] for column in (n, centre, target_sum))
    unit = peak.to_numpy(float) ** 2
    unit[unit == 0] = 1.0
    gram = np.zeros((len(n), k, k))
    low = np.tril_indices(k)
    gram[:, low[0], low[1]] = cross - mean * (sums[:, low[0]] + sums[:, low[1]]) + count * mean**2
    gram[:, low[1], low[0]] = gram[:, low[0], low[1]]
    gram /= unit[:, None, None]
    gram[:, np.arange(k), np.arange(k)] += RIDGE
    right = (target_cross - mean * (sums + target) + count * mean**2) / unit[:, None]
    found = [None] * len(n)
    with np.errstate(all="ignore"):
        usable = np.isfinite(gram).all(axis=(1, 2)) & np.isfinite(right).all(axis=1)
        coefs = np.linalg.solve(gram[usable], right[usable][:, :, None])[:, :, 0]
    for i, row in zip(np.flatnonzero(usable), coefs, strict=True):
        if np.isfinite(row).all():
            found[i] = row
    return pd.Series(found, dtype=object)


def stable_rows(p):
    """Limits on AR (the first ``p``) and MA coefficients of every row; null rows stay null."""

    def run(raw: pd.Series) -> pd.DataFrame:
        found = [(None, None)] * len(raw)
        for rows, matrix in by_length(raw):
            for i, coef, flag in zip(rows, *limited(matrix, p), strict=True):
                found[i] = (coef, bool(flag))
        return pd.DataFrame(found, columns=["coef", "adjusted"], dtype=object)

    return run


# --- additive regression --------------------------------------------------------------


def changepoint_days(days, most=MAX_CHANGEPOINTS):
    """Evenly spaced dates inside the first part of the history."""
    head = math.floor(CHANGEPOINT_SHARE * len(days))
    count = min(most, head - 1)
    if count < 1:
        return np.empty(0)
    return days[np.linspace(0, head - 1, count + 1).round().astype(int)][1:]


def design_matrix(days, t0, span, changes, seasons=SEASONS):
    t = (days - t0) / span
    blocks = [np.ones((len(days), 1)), t[:, None]]
    blocks.append(np.maximum(t[:, None] - (changes[None, :] - t0) / span, 0.0))
    for period, pairs in seasons:
        angle = 2 * np.pi * days[:, None] / period * np.arange(1, pairs + 1)[None, :]
        blocks += [np.sin(angle), np.cos(angle)]
    return np.concatenate(blocks, axis=1)


def prior_scales(n_changes, seasons=SEASONS):
    n_season = 2 * sum(pairs for _, pairs in seasons)
    return np.concatenate(
        [np.full(2, PRIOR_TREND), np.full(n_changes, PRIOR_CHANGE), np.full(n_season, PRIOR_SEASON)]
    )


def ridge_fit(design, prior, ys):
    """Coefficients (columns) and noise deviation of each column of ``ys``.

    The noise variance is re-estimated with the effective number of parameters, which keeps a
    design with more columns than rows from fitting the noise away.
    """
    u, s, vt = np.linalg.svd(design * prior, full_matrices=False)
    projected = u.T @ ys
    outside = np.maximum((ys**2).sum(axis=0) - (projected**2).sum(axis=0), 0.0)
    variance = np.maximum(ys.var(axis=0), 1e-12)
    for _ in range(ITERATIONS):
        kept = (s**2)[:, None] / ((s**2)[:, None] + variance[None, :])
        rss = ((1 - kept) ** 2 * projected**2).sum(axis=0) + outside
        variance = np.maximum(rss / np.maximum(len(ys) - kept.sum(axis=0), 1.0), 1e-12)
    weights = s[:, None] / ((s**2)[:, None] + variance[None, :])
    return prior[:, None] * (vt.T @ (weights * projected)), np.sqrt(variance)


def posterior_fit(design, prior, ys, noise):
    """Coefficients (columns) of each column of ``ys`` for a given noise deviation, by one Cholesky
    factor for all of them."""
    scaled = design * prior
    factor = np.linalg.cholesky(scaled.T @ scaled + noise**2 * np.eye(len(prior)))
    half = np.linalg.solve(factor, scaled.T @ ys)
    return prior[:, None] * np.linalg.solve(factor.T, half), np.full(ys.shape[1], float(noise))


def fit_calendar(days, ys, seasons=SEASONS, most=MAX_CHANGEPOINTS, noise=None):
    """Parameter rows of all series (columns of ``ys``) observed on the same ``days``; none for a series
    whose solve gave no numbers."""
    t0, span = float(days[0]), max(float(days[-1] - days[0]), 1.0)
    changes = changepoint_days(days, most)
    scale = np.abs(ys).max(axis=0)
    scale[scale == 0] = 1.0
    design, prior = design_matrix(days, t0, span, changes, seasons), prior_scales(len(changes), seasons)
    with np.errstate(all="ignore"):
        fit = ridge_fit(design, prior, ys / scale) if noise is None else posterior_fit(design, prior, ys / scale, noise)
    beta, sigma = fit
    last = 2 + len(changes)
    return [
        (t0, span, float(scale[j]), float(sigma[j]), beta[:2, j], changes, beta[2:last, j], beta[last:, j])
        if np.isfinite(beta[:, j]).all() and np.isfinite(sigma[j])
        else None
        for j in range(ys.shape[1])
    ]


def curve_rows(seasons=SEASONS, most=MAX_CHANGEPOINTS, noise=None):
    """Fit a batch of series; those with identical calendars share one factorisation. A series whose solve
    fails has no parameters, whatever the others of its batch are."""

    def solved(days, ys):
        try:
            return fit_calendar(days, ys, seasons, most, noise)
        except np.linalg.LinAlgError:
            return [None] if ys.shape[1] == 1 else [solved(days, ys[:, [j]])[0] for j in range(ys.shape[1])]

    def run(days: pd.Series, ys: pd.Series) -> pd.DataFrame:
        none = (None,) * len(CURVE_FIELDS)
        found = [none] * len(days)
        calendars = {}
        for i, d in enumerate(days):
            if d is not None and len(d) >= MIN_CURVE_POINTS:
                calendars.setdefault(np.asarray(d, dtype=float).tobytes(), []).append(i)
        for key, members in calendars.items():
            stacked = np.stack([np.asarray(ys.iloc[i], dtype=float) for i in members], axis=1)
            for i, row in zip(members, solved(np.frombuffer(key), stacked), strict=True):
                found[i] = row or none
        return pd.DataFrame(found, columns=list(CURVE_FIELDS))

    return run


cloudpickle.register_pickle_by_value(sys.modules[__name__])
