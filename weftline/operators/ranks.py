"""Places of rows along an order, and exact quantiles, without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.graphs import written


def numbered(rows: DataFrame, lot: str, order: Sequence[str | Column], place: str = "place", total: str | None = None) -> DataFrame:
    """rows with their place, from 0, along order within their lot, and the lot's number of rows if total is named.

    Rows are dealt into ranges of (lot, order) and written once; each range numbers its own, and the ranges' counts, a
    row each, say what comes before. So a lot may be as large as the table. Rows that order leaves equal share a range.
    """
    ranged = written(rows.repartitionByRange(lot, *order).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy(lot, "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(lot).orderBy("_range")
    offsets = counts.select(F.col(lot).alias("_lot"), F.col("_range").alias("_at"), (F.sum("_n").over(before) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy(lot)).alias("_total"))
    own = F.row_number().over(Window.partitionBy(lot, "_range").orderBy(*order)) - 1
    out = ranged.withColumn("_own", own).join(offsets, F.col(lot).eqNullSafe(F.col("_lot")) & (F.col("_range") == F.col("_at")))
    extra = [F.col("_total").alias(total)] if total else []
    return out.select(*rows.columns, (F.col("_own") + F.col("_before")).alias(place), *extra)


def quantiles(rows: DataFrame, lot: str, value: str, shares: dict[str, float]) -> DataFrame:
    """One row a lot: its exact quantiles of value by name, linear between the two nearest rows. Null values do not count."""
    names = list(shares)
    at = numbered(rows.where(F.col(value).isNotNull()).select(lot, value), lot, [value], "_place", "_total")
    wanted = F.array(*[F.struct(F.lit(n).alias("name"), ((F.col("_total") - 1) * F.lit(float(shares[n]))).alias("x")) for n in names])
    # Of each lot at most two rows a quantile go on.
    near = at.select(lot, value, "_place", F.filter(wanted, lambda w: (F.floor(w["x"]) == F.col("_place")) | (F.ceil(w["x"]) == F.col("_place"))).alias("w")).where(F.size("w") > 0)
    near = near.select(lot, value, "_place", F.explode("w").alias("w"))
    part = near.groupBy(lot, F.col("w.name").alias("name")).agg(F.min_by(value, "_place").alias("low"), F.max_by(value, "_place").alias("high"), F.any_value(F.col("w.x") - F.floor("w.x")).alias("rest"))
    part = part.select(lot, "name", (F.col("low") + (F.col("high") - F.col("low")) * F.col("rest")).alias("q"))
    return part.groupBy(lot).agg(*[F.max(F.when(F.col("name") == n, F.col("q"))).alias(n) for n in names])
