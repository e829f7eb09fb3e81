"""Small-matrix statistics: Spark aggregates moments over all rows, the p x p matrix is solved on the driver.

Only matrices whose size is the number of variables come to the driver, never rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def moments(rows: DataFrame, vector: str) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, means, covariance) of an array column, from sums of products each task adds up for itself."""

    def part(batches):
        total = None
        for batch in batches:
            if len(batch):
                m = np.array(batch["v"].tolist(), float)
                m1 = np.concatenate([np.ones((len(m), 1)), m], 1)
                total = m1.T @ m1 if total is None else total + m1.T @ m1
        if total is not None:
            p = len(total)
            yield pd.DataFrame({"i": np.repeat(np.arange(p), p), "j": np.tile(np.arange(p), p), "s": total.ravel()})

    sums = rows.select(F.col(vector).alias("v")).mapInPandas(part, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas()
    p = int(sums["i"].max()) + 1
    s = np.zeros((p, p))
    s[sums["i"], sums["j"]] = sums["s"]
    n, mean = s[0, 0], s[0, 1:] / s[0, 0]
    return int(n), mean, (s[1:, 1:] - n * np.outer(mean, mean)) / (n - 1)


def pca(rows: DataFrame, vector: str, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(means, scales, components, variance ratios) of the standardised columns; each component's largest entry is positive."""
    _, mean, cov = moments(rows, vector)
    scale = np.sqrt(np.diag(cov))
    values, basis = np.linalg.eigh(cov / np.outer(scale, scale))
    order = values.argsort()[::-1][:k]
    parts = basis[:, order].T
    parts *= np.sign(parts[np.arange(len(parts)), np.abs(parts).argmax(1)])[:, None]
    return mean, scale, parts, values[order] / values.sum()


def classical_mds(distances: np.ndarray, k: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, stress by dimension 1..k) of a square distance matrix by double centring."""
    n = len(distances)
    centre = np.eye(n) - 1 / n
    values, basis = np.linalg.eigh(-0.5 * centre @ (distances**2) @ centre)
    order = values.argsort()[::-1]
    points = basis[:, order] * np.sqrt(np.maximum(values[order], 0))
    stress = []
    for d in range(1, k + 1):
        fit = np.sqrt(((points[:, None, :d] - points[None, :, :d]) ** 2).sum(-1))
        stress.append(float(np.sqrt(((distances - fit) ** 2).sum() / (distances**2).sum())))
    return points[:, :k], np.array(stress)


def leaf_order(distances: np.ndarray) -> list[int]:
    """Leaves of an average-linkage tree, left to right; ties join the groups with the smallest members first."""
    groups = [[i] for i in range(len(distances))]
    while len(groups) > 1:
        best = min((distances[np.ix_(a, b)].mean(), min(a), min(b), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        i, j = best[3], best[4]
        left, right = sorted((groups[i], groups[j]), key=min)
        groups = [g for k, g in enumerate(groups) if k not in (i, j)] + [left + right]
    return groups[0] if groups else []


def principal_axes(correlation: np.ndarray, factors: int, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """(loadings, communalities) of principal-axis factoring, iterated until the communalities settle."""
    h = 1 - 1 / np.diag(np.linalg.pinv(correlation))
    for _ in range(rounds):
        reduced = correlation.copy()
        np.fill_diagonal(reduced, h)
        values, basis = np.linalg.eigh(reduced)
        order = values.argsort()[::-1][:factors]
        loadings = basis[:, order] * np.sqrt(np.maximum(values[order], 0))
        new = (loadings**2).sum(1)
        if np.abs(new - h).max() < 1e-9:
            break
        h = new
    return loadings, h


def parallel_analysis(correlation: np.ndarray, n: int, draws: int = 100, seed: int = 1) -> int:
    """Number of leading eigenvalues above the 95th percentile of those of random data of the same shape.

    The random data's p x p moments are drawn as such (Bartlett's triangle of a Wishart matrix), never its n rows.
    """
    rng, p = np.random.default_rng(seed), len(correlation)
    random = []
    for _ in range(draws):
        half = np.tril(rng.standard_normal((p, p)), -1) + np.diag(np.sqrt(rng.chisquare(n - 1 - np.arange(p))))
        moments_ = half @ half.T
        scale = np.sqrt(np.diag(moments_))
        random.append(np.sort(np.linalg.eigvalsh(moments_ / np.outer(scale, scale)))[::-1])
    above = np.sort(np.linalg.eigvalsh(correlation))[::-1] > np.percentile(random, 95, axis=0)
    return int(p if above.all() else above.argmin())


def ols(rows: DataFrame, vector: str) -> tuple[np.ndarray, float]:
    """(coefficients with the intercept first, R squared) of the vector's first entry on the others."""
    n, mean, cov = moments(rows, vector)
    slope = np.linalg.lstsq(cov[1:, 1:], cov[1:, 0], rcond=None)[0]
    return np.concatenate([[mean[0] - slope @ mean[1:]], slope]), float(slope @ cov[1:, 0] / cov[0, 0])


def change_points(means: list[float], weights: list[float], penalty: float, least: int = 3) -> list[int]:
    """Starts of the segments that minimise weighted squared error plus penalty a segment, each at least least long."""
    n = len(means)
    w, x = np.concatenate([[0], np.cumsum(weights)]), np.asarray(means) * np.asarray(weights)
    s, q = np.concatenate([[0], np.cumsum(x)]), np.concatenate([[0], np.cumsum(x * np.asarray(means))])
    cost, back = [0.0] + [np.inf] * n, [0] * (n + 1)
    for j in range(least, n + 1):
        for i in range(0, j - least + 1):
            if cost[i] < np.inf:
                c = cost[i] + penalty + q[j] - q[i] - (s[j] - s[i]) ** 2 / (w[j] - w[i])
                if c < cost[j] - 1e-12:
                    cost[j], back[j] = c, i
    out, j = [], n
    while j > 0 and cost[n] < np.inf:
        out.append(back[j])
        j = back[j]
    return out[::-1]


def stress_curve(distances: np.ndarray, dimensions: int) -> list[float]:
    """Stress of classical scaling in 1, 2 ... dimensions: the root of squared misfit over squared distance."""
    return classical_mds(distances, dimensions)[1].tolist()


def shepard_pairs(distances: np.ndarray, k: int = 2) -> list[tuple[int, int, float, float]]:
    """(i, j, distance, distance on the k-dimensional map) of every pair i < j."""
    points, _ = classical_mds(distances, k)
    return [(i, j, float(distances[i, j]), float(np.linalg.norm(points[i] - points[j]))) for i in range(len(distances)) for j in range(i + 1, len(distances))]


def varimax(loadings: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """(rotated loadings, rotation) of Kaiser's criterion: pairs of factors are turned by the best angle until none turns.

    Rows are scaled to unit length meanwhile.
    """
    p, k = loadings.shape
    unit = loadings / np.maximum(np.sqrt((loadings**2).sum(1, keepdims=True)), 1e-12)
    turn = np.eye(k)
    for _ in range(rounds):
        largest = 0.0
        for i in range(k):
            for j in range(i + 1, k):
                x, y = (unit @ turn)[:, [i, j]].T
                u, v = x**2 - y**2, 2 * x * y
                angle = np.arctan2(2 * (u @ v - u.sum() * v.sum() / p), u @ u - v @ v - (u.sum() ** 2 - v.sum() ** 2) / p) / 4
                c, s = np.cos(angle), np.sin(angle)
                turn[:, [i, j]] = turn[:, [i, j]] @ np.array([[c, -s], [s, c]])
                largest = max(largest, abs(angle))
        if largest < 1e-9:
            break
    return loadings @ turn, turn


def promax(loadings: np.ndarray, power: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(pattern, factor correlations) of the oblique rotation towards powers of the varimax loadings."""
    straight, turn = varimax(loadings)
    target = straight * np.abs(straight) ** (power - 1)
    oblique = np.linalg.lstsq(straight, target, rcond=None)[0]
    oblique = oblique @ np.diag(np.sqrt(np.diag(np.linalg.inv(oblique.T @ oblique))))
    inverse = np.linalg.inv(turn @ oblique)
    return straight @ oblique, inverse @ inverse.T


def score_weights(correlation: np.ndarray, pattern: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Weights of the standardised variables in Thurstone's regression scores: correlation**-1 times the structure."""
    return np.linalg.solve(correlation, pattern @ factors)


def minimum_partials(correlation: np.ndarray) -> tuple[int, list[float]]:
    """Velicer's test: the number of components that leaves the least mean squared partial correlation, and the means."""
    p = len(correlation)
    values, basis = np.linalg.eigh(correlation)
    parts = (basis * np.sqrt(np.maximum(values, 0)))[:, ::-1]
    means = []
    for m in range(p - 1):
        rest = correlation - parts[:, :m] @ parts[:, :m].T
        scale = np.sqrt(np.maximum(np.diag(rest), 1e-12))
        partial = rest / np.outer(scale, scale)
        means.append(float(((partial**2).sum() - p) / (p * (p - 1))))
    return int(np.argmin(means)), means
