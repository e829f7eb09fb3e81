"""Matrix statistics over Spark aggregates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators import factor_checks, matrices
from weftline.plans.registry import Tables, query

_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _vector(t: Tables) -> DataFrame:
    return t.lineitem.select(F.array(*_COLUMNS).alias("v"))


@query("G10_pca")
def g10(t: Tables) -> DataFrame:
    """Component, variance ratio and loadings of the standardised embeddings."""
    _, _, parts, ratio = matrices.pca(t.embeddings.select(F.transform("embedding", lambda x: x.cast("double")).alias("v")), "v", 5)
    return t.spark.createDataFrame([(i, round(float(r), 6), [round(float(x), 6) for x in p]) for i, (r, p) in enumerate(zip(ratio, parts, strict=True))], "component int, ratio double, loadings array<double>")


def _chords(t: Tables) -> np.ndarray:
    _, _, cov = matrices.moments(_vector(t), "v")
    sd = np.sqrt(np.diag(cov))
    return np.sqrt(np.maximum(2 * (1 - cov / np.outer(sd, sd)), 0))


@query("G13_G14_map")
def g13(t: Tables) -> DataFrame:
    """Variables placed by classical scaling of chord distances, in the order of an average-linkage tree."""
    d = _chords(t)
    points, _ = matrices.classical_mds(d)
    return t.spark.createDataFrame([(_COLUMNS[i], n, round(float(abs(points[i, 0])), 6)) for n, i in enumerate(matrices.leaf_order(d))], "variable string, place int, x double")


@query("G13_stress")
def g13_stress(t: Tables) -> DataFrame:
    """How well the map shows the distances: stress by number of dimensions."""
    curve = matrices.stress_curve(_chords(t), len(_COLUMNS) - 1)
    return t.spark.createDataFrame([(i + 1, round(s, 6)) for i, s in enumerate(curve)], "dimensions int, stress double")


@query(
    "G13_shepard_distances",
    "WITH c AS (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM lineitem" for i, a in enumerate(_COLUMNS) for b in _COLUMNS[i + 1 :]) + ") SELECT a, b, round(sqrt(2 * (1 - r)), 6) AS distance FROM c",
)
def g13_shepard(t: Tables) -> DataFrame:
    """The distances of the Shepard pairs; G13_shepard_pairs has those on the map beside them."""
    return g13_pairs(t).drop("mapped")


@query("G13_shepard_pairs")
def g13_pairs(t: Tables) -> DataFrame:
    pairs = [(_COLUMNS[i], _COLUMNS[j], round(d, 6), round(m, 6)) for i, j, d, m in matrices.shepard_pairs(_chords(t))]
    return t.spark.createDataFrame(pairs, "a string, b string, distance double, mapped double")


#: Eight measures of an order line, four of them built of the others, so that there are factors to be found.
_MEASURES = ("l_quantity", "l_extendedprice", "l_extendedprice * (1 - l_discount)", "l_discount", "l_tax", "l_discount + l_tax", "l_quantity + l_linenumber", "l_linenumber")


def _measures(t: Tables) -> tuple[DataFrame, int, np.ndarray, np.ndarray, np.ndarray]:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.array(*[F.expr(m).cast("double") for m in _MEASURES]).alias("v"))
    n, mean, cov = matrices.moments(rows, "v")
    sd = np.sqrt(np.diag(cov))
    # A little of the unit matrix keeps the correlations of built measures invertible.
    return rows, n, mean, sd, 0.98 * cov / np.outer(sd, sd) + 0.02 * np.eye(len(sd))


@query("G15_factors")
def g15(t: Tables) -> DataFrame:
    """Promax pattern and communalities of as many principal-axis factors as parallel analysis finds."""
    _, n, _, _, r = _measures(t)
    loadings, h = matrices.principal_axes(r, max(1, matrices.parallel_analysis(r, n)))
    pattern, _ = matrices.promax(loadings)
    pattern = pattern * np.sign(pattern.sum(0))
    return t.spark.createDataFrame([(m, f, round(float(pattern[i, f]), 5), round(float(h[i]), 5)) for i, m in enumerate(_MEASURES) for f in range(pattern.shape[1])], "variable string, factor int, loading double, communality double")


@query("G15_retained")
def g15_retained(t: Tables) -> DataFrame:
    """How many factors to keep, by parallel analysis and by the minimum of mean squared partial correlations."""
    _, n, _, _, r = _measures(t)
    return t.spark.createDataFrame([("parallel", matrices.parallel_analysis(r, n)), ("partials", matrices.minimum_partials(r)[0])], "rule string, factors int")


@query("G15_scores")
def g15_scores(t: Tables) -> DataFrame:
    """Regression scores of every line: its standardised measures times p x m weights, as column expressions."""
    rows, n, mean, sd, r = _measures(t)
    loadings, _ = matrices.principal_axes(r, 2)
    pattern, phi = matrices.promax(loadings)
    weights = matrices.score_weights(r, pattern * np.sign(pattern.sum(0)), phi) / sd[:, None]
    score = lambda f: F.round(sum((F.col("v")[i] - float(mean[i])) * float(weights[i, f]) for i in range(len(_MEASURES))), 6)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", score(0).alias("first"), score(1).alias("second"))


@query("G16_bootstrap")
def g16(t: Tables) -> DataFrame:
    """Percentile interval of the mean price from 500 resamples of months: monthly sums times seeded draws."""
    months = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("m")).agg(F.sum("o_totalprice").alias("s"), F.count("*").alias("n"))
    draws = months.select("m", "s", "n", F.explode(F.sequence(F.lit(0), F.lit(499))).alias("r"))
    # Poisson weights by inverting a hash: each replicate and month has its own, wherever the row is.
    u = (F.pmod(F.xxhash64("m", "r"), F.lit(1_000_000)) + 0.5) / 1_000_000
    weight = F.when(u < 0.36788, 0).when(u < 0.73576, 1).when(u < 0.9197, 2).when(u < 0.98101, 3).when(u < 0.99634, 4).otherwise(5)
    means = draws.groupBy("r").agg((F.sum(weight * F.col("s")) / F.sum(weight * F.col("n"))).alias("mean"))
    return means.agg(F.round(F.percentile("mean", F.lit(0.025)), 2).alias("low"), F.round(F.percentile("mean", F.lit(0.975)), 2).alias("high"))


@query("G16_stability")
def g16_stability(t: Tables) -> DataFrame:
    """The factor loadings of order lines with the percentiles of 500 refits, months of shipping drawn as clusters."""
    rows = t.lineitem.select(F.date_format("l_shipdate", "yyyy-MM").alias("month"), F.array(*[F.expr(m).cast("double") for m in _MEASURES]).alias("v"))
    found = factor_checks.bootstrap(rows, "month", "v", factors=2)
    name = F.array(*[F.lit(m) for m in _MEASURES])[F.col("variable")]
    return found.select(name.alias("variable"), "factor", *[F.round(c, 5).alias(c) for c in ("loading", "low", "high")], "refits")


@query("G17_masked_prediction")
def g17_masked(t: Tables) -> DataFrame:
    """Each measure of a year's lines predicted from the others under the moments of all earlier years."""
    rows = t.lineitem.select(F.year("l_shipdate").alias("year"), F.array(*[F.expr(m).cast("double") for m in _MEASURES]).alias("v"))
    found = factor_checks.masked_prediction(rows, "year", "v")
    name = F.array(*[F.lit(m) for m in _MEASURES])[F.col("variable")]
    return found.select("fold", name.alias("variable"), "trained", "n", F.round("rmse", 6).alias("rmse"), F.round("mean_rmse", 6).alias("mean_rmse"))


@query("G18_change_points")
def g18(t: Tables) -> DataFrame:
    """Segments of each status's monthly means; a series is one group of at most its months."""
    monthly = t.orders.groupBy("o_orderstatus", F.date_format("o_orderdate", "yyyy-MM").alias("m")).agg(F.avg("o_totalprice").alias("mean"), F.count("*").alias("n")).where("n >= 10")

    def cut(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("m")
        starts = matrices.change_points((part["mean"] / 1000).tolist(), part["n"].tolist(), penalty=20_000.0)
        return pd.DataFrame({"o_orderstatus": part["o_orderstatus"].iloc[0], "start": [part["m"].iloc[i] for i in starts]})

    return monthly.groupBy("o_orderstatus").applyInPandas(cut, "o_orderstatus string, start string")


@query(
    "G19_ols_with_controls",
    """WITH g AS (SELECT l_extendedprice - avg(l_extendedprice) OVER w AS y, l_quantity - avg(l_quantity) OVER w AS x FROM lineitem WINDOW w AS (PARTITION BY l_returnflag))
    SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS plain, (SELECT round(sum(x * y) / sum(x * x), 4) FROM g) AS controlled,
    (SELECT round(1 - (sum(y * y) - sum(x * y) * sum(x * y) / sum(x * x)) / (SELECT var_pop(l_extendedprice) * count(*) FROM lineitem), 6) FROM g) AS r2 FROM lineitem""",
)
def g19(t: Tables) -> DataFrame:
    """Price on quantity, alone and with the return flag as a control: a column for each flag but one."""
    flag = lambda f: (F.col("l_returnflag") == f).cast("double")
    plain, _ = matrices.ols(t.lineitem.select(F.array("l_extendedprice", "l_quantity").alias("v")), "v")
    with_flags, r2 = matrices.ols(t.lineitem.select(F.array("l_extendedprice", "l_quantity", flag("A"), flag("N")).alias("v")), "v")
    return t.spark.createDataFrame([(round(float(plain[1]), 4), round(float(with_flags[1]), 4), round(r2, 6))], "plain double, controlled double, r2 double")


@query(
    "G17_chronological_folds",
    "SELECT fold, CAST(count(*) AS BIGINT) AS n, min(year) AS first, max(year) AS last, round(sqrt(avg(pow(p - prior, 2))), 2) AS rmse "
    "FROM (SELECT o_totalprice AS p, year(o_orderdate) AS year, (year(o_orderdate) - 1995) // 2 AS fold FROM orders) o "
    "JOIN (SELECT f AS pf, avg(o_totalprice) AS prior FROM (SELECT unnest([1, 2, 3]) AS f) JOIN orders "
    "ON (year(o_orderdate) - 1995) // 2 < f GROUP BY 1) ON pf = fold GROUP BY 1",
)
def g17(t: Tables) -> DataFrame:
    """Each later two-year fold predicted by the mean of all earlier ones; sums per fold, few rows, carry it."""
    from pyspark.sql import Window

    o = t.orders.select(F.col("o_totalprice").alias("p"), F.year("o_orderdate").alias("year")).withColumn("fold", F.expr("(year - 1995) div 2"))
    cells = o.groupBy("fold").agg(F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q"), F.min("year").alias("first"), F.max("year").alias("last"))
    before = Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("prior", F.sum("s").over(before) / F.sum("n").over(before)).where("prior is not null")
    mse = F.col("q") / F.col("n") - 2 * F.col("prior") * F.col("s") / F.col("n") + F.col("prior") * F.col("prior")
    return cells.select("fold", "n", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"), F.round(F.sqrt(mse), 2).alias("rmse"))
