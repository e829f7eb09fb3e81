"""Range and proximity joins over closed intervals."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _cells(df: DataFrame, ends: tuple[str, str], width: int) -> DataFrame:
    return df.withColumn("_cell", F.explode(F.sequence(F.expr(f"{ends[0]} div {width}"), F.expr(f"{ends[1]} div {width}"))))


def contained(outer: DataFrame, inner: DataFrame, key: str, ends: tuple[str, str], inner_ends: tuple[str, str], width: int) -> DataFrame:
    """Pairs of one key where outer holds inner. Joined on key and a cell of the line, so it stays an equi-join.

    An inner interval lies in the cell of its start, an outer one in every cell it touches; width: about an outer length.
    """
    o = _cells(outer, ends, width)
    i = inner.withColumn("_cell", F.expr(f"{inner_ends[0]} div {width}"))
    j = o.join(i, [key, "_cell"]).where((F.col(ends[0]) <= F.col(inner_ends[0])) & (F.col(ends[1]) >= F.col(inner_ends[1])))
    return j.drop("_cell")


def covered(spans: DataFrame, ranges: DataFrame, ids: Sequence[str], key: str, ends: tuple[str, str], range_ends: tuple[str, str], width: int) -> DataFrame:
    """Length of each span that its key's ranges cover, summed over ranges; spans that meet none are left out.

    A pair that shares several cells is counted in the first one only.
    """
    s, r = _cells(spans, ends, width), _cells(ranges, range_ends, width)
    first = F.expr(f"greatest({ends[0]}, {range_ends[0]}) div {width}")
    j = s.join(r, [key, "_cell"]).where((F.col(range_ends[0]) < F.col(ends[1])) & (F.col(range_ends[1]) > F.col(ends[0])) & (F.col("_cell") == first))
    length = F.greatest(F.lit(0), F.least(ends[1], range_ends[1]) - F.greatest(ends[0], range_ends[0]))
    return j.groupBy(*ids).agg(F.sum(length).alias("covered"))


def merge_near(points: DataFrame, key: str, at: str, tie: str, gap: int) -> DataFrame:
    """Accepted points per key: a point within gap of the last accepted one merges into it. first, n, last.

    What is accepted depends on what was before, so each key is folded in order. Only (key, instant) rows are shuffled,
    sorted by Spark, and streamed: a key's points are never gathered.
    """
    rows = points.select(F.col(key).cast("long").alias("key"), F.col(at).cast("long").alias("at"), F.col(tie).cast("long").alias("tie"))

    def fold(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        now = None
        for batch in batches:
            out = []
            for k, a in zip(batch["key"].tolist(), batch["at"].tolist(), strict=True):
                if now and now[0] == k and a - now[1] < gap:
                    now = (k, now[1], now[2] + 1, a)
                    continue
                if now:
                    out.append(now)
                now = (k, a, 1, a)
            yield pd.DataFrame(out, columns=["key", "first", "n", "last"])
        if now:
            yield pd.DataFrame([now], columns=["key", "first", "n", "last"])

    return rows.repartition("key").sortWithinPartitions("key", "at", "tie").mapInPandas(fold, "key long, first long, n long, last long")
