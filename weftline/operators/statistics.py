"""Grouped statistics: time series, intervals, standardised trends, contrasts, spreads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(c: Column) -> Column:
    """c, null where it is NaN or infinite."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def mean_interval(mean: Column, sd: Column, n: Column, least: int = 5) -> tuple[Column, Column]:
    """Both ends of mean -/+ 1.96 s / sqrt(n); null under least values."""
    half = F.lit(1.96) * sd / F.sqrt(n)
    return F.when(n >= least, mean - half), F.when(n >= least, mean + half)


def time_series(rows: DataFrame, period: Column, value: str, low: str, high: str, coverage: Column, digits: int = 6) -> DataFrame:
    """One row per period: n, mean, ci_low, ci_high, low, high (null unless every value has one) and coverage.

    Rows without a period or a finite value are left out.
    """
    v = finite(F.col(value))
    used = rows.withColumn("_p", period).withColumn("_v", v).withColumn("_c", coverage).where("_p is not null and _v is not null")
    grouped = used.groupBy(F.col("_p").alias("period")).agg(
        F.count("*").alias("n"), F.avg("_v").alias("mean"), F.stddev_samp("_v").alias("sd"), F.avg("_c").alias("coverage"), *[F.when(F.count(c) == F.count("*"), F.avg(c)).alias(k) for k, c in (("low", low), ("high", high))]
    )
    lo, hi = mean_interval(F.col("mean"), F.col("sd"), F.col("n"))
    return grouped.select("period", "n", *[F.round(c, digits).alias(k) for k, c in (("mean", F.col("mean")), ("ci_low", lo), ("ci_high", hi), ("low", F.col("low")), ("high", F.col("high")), ("coverage", F.col("coverage")))])


def shares(rows: DataFrame, group: Sequence[str], part: str, least: int) -> DataFrame:
    """Share of each part within its group, for groups of at least so many rows with a part."""
    counts = rows.where(F.col(part).isNotNull()).groupBy(*group, part).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*group))
    return counts.withColumn("total", total).where(F.col("total") >= least).withColumn("share", F.round(F.col("n") / F.col("total"), 6))


def standardised(rows: DataFrame, period: str, stratum: str, value: str, least_rows: int, least_stratum: int = 5, least_weight: float = 0.5) -> DataFrame:
    """Per period the mean of value with the pooled mix of strata as fixed weights, re-normalised over supported strata.

    A stratum counts in a period with least_stratum rows or more; the result is null unless the period has least_rows
    and the supported strata cover least_weight of the mix.
    """
    rows = rows.where(F.col(stratum).isNotNull() & F.col(value).isNotNull())
    cells = rows.groupBy(period, stratum).agg(F.count("*").alias("n"), F.avg(value).alias("m"))
    # The mix and every later figure come from the cells, which are few; the rows are read once.
    mix = cells.groupBy(stratum).agg(F.sum("n").alias("w"))
    total = cells.agg(F.sum("n")).first()[0] or 1
    joined = cells.join(mix, stratum).withColumn("w", F.col("w") / F.lit(float(total)))
    good = F.col("n") >= least_stratum
    out = joined.groupBy(period).agg(F.sum("n").alias("n"), F.sum(F.when(good, F.col("w"))).alias("weight"), F.sum(F.when(good, F.col("w") * F.col("m"))).alias("sum"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("observed"))
    ok = (F.col("n") >= least_rows) & (F.col("weight") >= least_weight)
    return out.select(period, "n", F.round("observed", 6).alias("observed"), F.round(F.when(ok, F.col("sum") / F.col("weight")), 6).alias("standardised"))


def effect(n1: Column, m1: Column, s1: Column, n2: Column, m2: Column, s2: Column) -> Column:
    """Mean difference over the pooled standard deviation; null where it is undefined or the variance vanishes."""
    pooled = ((n1 - 1) * s1 * s1 + (n2 - 1) * s2 * s2) / (n1 + n2 - 2)
    return F.when((n1 > 1) & (n2 > 1) & (pooled > 1e-12), (m2 - m1) / F.sqrt(pooled))


def evenness(counts: DataFrame, group: Sequence[str], n: str) -> DataFrame:
    """Per group: total, top_share, and spread, the Shannon entropy of the shares over its maximum (0 for one part)."""
    shared = counts.withColumn("_t", F.sum(n).over(Window.partitionBy(*group))).withColumn("_s", F.col(n) / F.col("_t"))
    out = shared.groupBy(*group).agg(F.sum(n).alias("total"), F.max("_s").alias("top_share"), F.count("*").alias("parts"), F.sum(-F.col("_s") * F.log("_s")).alias("h"))
    return out.select(*group, "total", F.round("top_share", 6).alias("top_share"), F.round(F.when(F.col("parts") > 1, F.col("h") / F.log("parts")).otherwise(0.0), 6).alias("spread"))


def islands(rows: DataFrame, keys: Sequence[str], index: str) -> DataFrame:
    """Runs of consecutive whole numbers per key: first, last, n. Repeated numbers count once."""
    unique = rows.select(*keys, index).distinct()
    w = Window.partitionBy(*keys).orderBy(index) if keys else Window.orderBy(index)
    return unique.withColumn("_i", F.col(index) - F.row_number().over(w)).groupBy(*keys, "_i").agg(F.min(index).alias("first"), F.max(index).alias("last"), F.count("*").alias("n")).drop("_i")


def merged_ranges(rows: DataFrame, key: str, first: str, last: str) -> DataFrame:
    """Overlapping or adjacent closed ranges of each key, merged."""
    w = Window.partitionBy(key).orderBy(first, last)
    seen = F.max(last).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.select(key, first, last, F.when(F.col(first) <= seen + 1, 0).otherwise(1).alias("_new"))
    marked = marked.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(key, "_island").agg(F.min(first).alias("first"), F.max(last).alias("last")).drop("_island")


def evenly_spaced(rows: DataFrame, key: str, order: Sequence[str], k: int) -> DataFrame:
    """At most k rows per key, evenly spaced along order: places i*(n-1) div (k-1); all of them where there are no more."""
    w = Window.partitionBy(key)
    ranked = rows.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    chosen = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.floor(i * (F.col("_n") - 1) / F.lit(max(1, k - 1))))
    return ranked.where((F.col("_n") <= k) | F.array_contains(chosen, F.col("_i").cast("long"))).drop("_i", "_n")
