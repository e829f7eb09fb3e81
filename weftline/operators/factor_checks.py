"""Stability and held-out checks of the factor model, from moment matrices by month or by fold.

A moment matrix holds the sums of products of (1, measures): it has all that a refit or a linear prediction needs, adds
up over groups, and does not grow with the rows. Tasks add up their own rows; what is shuffled are (p + 1)^2 sums a
group and task.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators import matrices
from weftline.operators.graphs import written


def group_moments(rows: DataFrame, group: str, vector: str) -> DataFrame:
    """(group, i, j, s): sums of products of (1, vector) over each group's rows; rows with a null in either are left out."""
    complete = rows.where(F.col(group).isNotNull() & F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull()))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            m = np.array(batch["v"].tolist(), float)
            m = np.concatenate([np.ones((len(m), 1)), m], 1)
            kinds, place = np.unique(batch["g"].to_numpy(), return_inverse=True)
            order = place.argsort(kind="stable")
            ends = np.searchsorted(place[order], np.arange(len(kinds) + 1))
            p = m.shape[1]
            for k, (a, b) in enumerate(itertools.pairwise(ends.tolist())):
                part = m[order[a:b]]
                yield pd.DataFrame({"g": kinds[k], "i": np.repeat(np.arange(p), p), "j": np.tile(np.arange(p), p), "s": (part.T @ part).ravel()})

    kind = rows.schema[group].dataType.simpleString()
    parts = complete.select(F.col(group).alias("g"), F.col(vector).cast("array<double>").alias("v")).mapInPandas(add, f"g {kind}, i int, j int, s double")
    return parts.groupBy(F.col("g").alias(group), "i", "j").agg(F.sum("s").alias("s"))


def square(part: pd.DataFrame, value: str = "s") -> np.ndarray:
    """The matrix of rows (i, j, value)."""
    p = int(part["i"].max()) + 1
    out = np.zeros((p, p))
    out[part["i"], part["j"]] = part[value]
    return out


def covariance(s: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(n, means, covariance) of a moment matrix."""
    n, mean = s[0, 0], s[0, 1:] / s[0, 0]
    return n, mean, (s[1:, 1:] - n * np.outer(mean, mean)) / (n - 1)


def correlation(s: np.ndarray, shrink: float) -> np.ndarray:
    """Correlations, drawn a little towards none, so that those of measures built of each other can be inverted."""
    _, _, cov = covariance(s)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-300))
    return (1 - shrink) * cov / np.outer(sd, sd) + shrink * np.eye(len(sd))


def fitted(s: np.ndarray, factors: int, shrink: float) -> np.ndarray:
    """Promax pattern of the principal-axis factors, each with a positive sum."""
    loadings, _ = matrices.principal_axes(correlation(s, shrink), factors)
    pattern, _ = matrices.promax(loadings)
    signs = np.sign(pattern.sum(0))
    return pattern * np.where(signs == 0, 1, signs)


def aligned(pattern: np.ndarray, to: np.ndarray) -> np.ndarray:
    """The pattern's factors in the order and with the signs that agree best with `to`: largest sum of absolute congruence."""
    k = to.shape[1]
    lengths = np.outer(np.linalg.norm(to, axis=0), np.linalg.norm(pattern, axis=0))
    congruence = to.T @ pattern / np.maximum(lengths, 1e-12)
    if k <= 6:
        order = max(itertools.permutations(range(k)), key=lambda o: (round(sum(abs(congruence[i, j]) for i, j in enumerate(o)), 12), [-j for j in o]))
    else:
        left, order = np.abs(congruence), [0] * k
        for _ in range(k):
            i, j = np.unravel_index(left.argmax(), left.shape)
            order[i], left[i], left[:, j] = int(j), -1, -1
    signs = np.sign([congruence[i, j] for i, j in enumerate(order)])
    return pattern[:, list(order)] * np.where(signs == 0, 1, signs)


def draw(seed: int, replicate: int, clusters: int) -> np.ndarray:
    """How often each cluster is drawn in a replicate: as many draws as clusters, by seed and replicate alone."""
    return np.bincount(np.random.default_rng([seed, replicate]).integers(0, clusters, clusters), minlength=clusters)


def bootstrap(rows: DataFrame, cluster: str, vector: str, factors: int, replicates: int = 500, seed: int = 1, shrink: float = 0.02) -> DataFrame:
    """(variable, factor, loading, low, high, refits): each loading of the full fit with its 2.5 and 97.5 percentiles.

    Clusters (months) are drawn with replacement, all rows of one together. Each task multiplies its clusters' moment
    matrices with their numbers of draws in all replicates; the sums of a replicate are refitted and aligned to the
    full fit in a group of its own. A replicate in which a measure does not vary is left out; refits counts the others.
    The driver gets the clusters' names, of which a calendar has few, and one matrix.
    """
    moments = written(group_moments(rows, cluster, vector))
    names = {r[0]: i for i, r in enumerate(moments.select(cluster).distinct().orderBy(cluster).collect())}
    full_moments = square(moments.groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas())
    full = fitted(full_moments, factors, shrink)
    numbered = moments.groupBy(cluster).agg(F.sort_array(F.collect_list(F.struct("i", "j", "s"))).alias("m")).select(F.col(cluster).alias("g"), F.transform("m", lambda x: x["s"]).alias("m"))

    def weighted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        draws = np.stack([draw(seed, r, len(names)) for r in range(replicates)])
        for batch in batches:
            if len(batch):
                sums = draws[:, [names[g] for g in batch["g"]]] @ np.array(batch["m"].tolist(), float)
                size = sums.shape[1]
                yield pd.DataFrame({"r": np.repeat(np.arange(replicates), size), "at": np.tile(np.arange(size), replicates), "s": sums.ravel()})

    def refit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s in batch["m"]:
                p = round(len(s) ** 0.5)
                s = np.array(s, float).reshape(p, p)
                _, _, cov = covariance(s)
                if (np.diag(cov) <= 1e-12 * np.maximum(1, np.diag(s)[1:] / s[0, 0])).any():
                    continue
                pattern = aligned(fitted(s, factors, shrink), full)
                yield pd.DataFrame({"variable": np.repeat(np.arange(p - 1), factors), "factor": np.tile(np.arange(factors), p - 1), "loading": pattern.ravel()})

    sums = numbered.mapInPandas(weighted, "r int, at int, s double").groupBy("r", "at").agg(F.sum("s").alias("s"))
    one = sums.groupBy("r").agg(F.sort_array(F.collect_list(F.struct("at", "s"))).alias("m")).select("r", F.transform("m", lambda x: x["s"]).alias("m"))
    loadings = one.mapInPandas(refit, "variable int, factor int, loading double")
    ends = loadings.groupBy("variable", "factor").agg(F.percentile("loading", F.lit(0.025)).alias("low"), F.percentile("loading", F.lit(0.975)).alias("high"), F.count("*").alias("refits"))
    whole = rows.sparkSession.createDataFrame([(i, f, float(full[i, f])) for i in range(len(full)) for f in range(factors)], "variable int, factor int, loading double")
    return whole.join(ends, ["variable", "factor"], "left")


def masked_errors(train: np.ndarray, test: np.ndarray, shrink: float) -> list[tuple[int, float, float]]:
    """(measure, rmse, rmse of the training mean): each measure of the test rows predicted from their others.

    The prediction is the conditional mean under the training moments; its squared error is a quadratic form in the
    test moments, so no row is looked at again.
    """
    _, mean, cov = covariance(train)
    cov = (1 - shrink) * cov + shrink * np.diag(np.diag(cov))
    n, p, out = test[0, 0], len(mean), []
    for j in range(p):
        others = [i for i in range(p) if i != j]
        slope = np.linalg.lstsq(cov[np.ix_(others, others)], cov[others, j], rcond=None)[0]
        residual = np.zeros(p + 1)
        residual[j + 1], residual[[i + 1 for i in others]] = 1, -slope
        residual[0] = slope @ mean[others] - mean[j]
        plain = np.zeros(p + 1)
        plain[0], plain[j + 1] = -mean[j], 1
        out.append((j, *(float(np.sqrt(max(0.0, v @ test @ v / n))) for v in (residual, plain))))
    return out


def masked_prediction(rows: DataFrame, fold: str, vector: str, shrink: float = 0.02, least: int = 30) -> DataFrame:
    """(fold, variable, trained, n, rmse, mean_rmse): each fold after the first predicted from all folds before it.

    Training moments are running sums over the folds in order, so no fold sees itself or a later one. Folds with fewer
    than `least` rows before them are left out.
    """
    moments = group_moments(rows, fold, vector)
    before = Window.partitionBy("i", "j").orderBy(fold).rowsBetween(Window.unboundedPreceding, -1)
    both = moments.withColumn("train", F.sum("s").over(before)).where(F.col("train").isNotNull())

    def errors(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        train, test = square(part, "train"), square(part)
        found = masked_errors(train, test, shrink) if train[0, 0] >= least else []
        return pd.DataFrame([(key[0], j, int(train[0, 0]), int(test[0, 0]), e, m) for j, e, m in found], columns=["fold", "variable", "trained", "n", "rmse", "mean_rmse"])

    kind = rows.schema[fold].dataType.simpleString()
    return both.groupBy(F.col(fold).alias("fold")).applyInPandas(errors, f"fold {kind}, variable int, trained long, n long, rmse double, mean_rmse double")
