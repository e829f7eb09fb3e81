"""Order-dependent folds: greedy packing, rate limits, span planning.

Rows are shuffled by key and sorted by Spark, then streamed through one pass per partition: no key is gathered whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pack_in_order(rows: DataFrame, most_size: int, most_rows: int, by_key: bool, cell: int = 100_000) -> DataFrame:
    """rows (key, place, size) with a pack number: a pack closes before it would exceed a bound; larger rows stand alone.

    by_key: packs within each key, numbered from 0. Otherwise consecutive keys share packs within a cell of so many
    keys, and (lot, pack) names a pack: cells follow from the keys alone, so names depend on neither settings nor run,
    and a table of any size packs in parallel.
    """
    lot = F.col("key") if by_key else F.expr(f"key div {cell}")
    parts = rows.withColumn("lot", lot).repartition("lot").sortWithinPartitions("lot", "key", "place")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lot, pack, size, n = None, 0, 0, 0
        for batch in batches:
            packs = []
            for where, s in zip(batch["lot"].tolist(), batch["size"].tolist(), strict=True):
                if where != lot:
                    lot, pack, size, n = where, 0, 0, 0
                if n and (size + s > most_size or n + 1 > most_rows):
                    pack, size, n = pack + 1, 0, 0
                size, n = size + s, n + 1
                packs.append(pack)
            yield batch[["key", "place", "size", "lot"]].assign(pack=packs)

    return parts.select("key", "place", "size", "lot").mapInPandas(fold, "key long, place long, size long, lot long, pack long")


def rate_limited(requests: DataFrame, per_day: int = 50, per_hour: int = 20, gap_ms: int = 3000) -> DataFrame:
    """requests (key, at, id) with admitted: at most so many a day and a trailing hour, and gap_ms after the last admitted.

    Only admitted requests count, so each decision depends on earlier ones.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, day, today, recent = None, None, 0, []
        for batch in batches:
            out = []
            for k, at in zip(batch["key"].tolist(), batch["at"].tolist(), strict=True):
                if k != key:
                    key, day, today, recent = k, None, 0, []
                if at // 86_400_000 != day:
                    day, today = at // 86_400_000, 0
                recent = [r for r in recent if r > at - 3_600_000]
                ok = today < per_day and len(recent) < per_hour and not (recent and at - recent[-1] < gap_ms)
                if ok:
                    today += 1
                    recent.append(at)
                out.append(ok)
            yield batch.assign(admitted=out)

    rows = requests.repartition("key").sortWithinPartitions("key", "at", "id").select("key", "at", "id")
    return rows.mapInPandas(fold, "key long, at long, id long, admitted boolean")


@dataclass(frozen=True)
class SpanPolicy:
    """In samples: recordings up to direct are one span; cores are least to most long, cut within reach of target."""

    direct: int
    least: int
    target: int
    most: int
    reach: int
    padding: int
    most_spans: int


class _Spans:
    """One recording's spans, from its marks in order. Holds the marks that the next cut may fall on, and the spans."""

    def __init__(self, key: int, total: int, policy: SpanPolicy) -> None:
        self.key, self.total, self.policy = key, total, policy
        self.start, self.near, self.spans, self.problem = 0, [], [], None
        self.open = total > policy.direct

    def window(self) -> tuple[int, int, int]:
        """Where the next cut may be, and where it is wanted."""
        least, most = self.start + self.policy.least, min(self.start + self.policy.most, self.total - self.policy.least)
        return least, most, min(self.start + self.policy.target, most)

    def mark(self, at: int, confidence: float, kind: str) -> None:
        while self.more() and at > self.window()[1]:
            self.cut()
        if self.more():
            self.near.append((at, confidence, kind))

    def more(self) -> bool:
        return self.open and self.problem is None and self.total - self.start > self.policy.most

    def cut(self) -> None:
        least, most, wanted = self.window()
        if least > most:
            self.problem = "no valid final core"
            return
        found = [(abs(a - wanted), -c, a, kind) for a, c, kind in self.near if least <= a <= most and abs(a - wanted) <= self.policy.reach]
        if found:
            _, confidence, end, kind = min(found)
            self.spans.append((self.start, end, f"candidate_{kind}", -confidence))
        else:
            end = max(least, wanted)
            self.spans.append((self.start, end, "fixed_target", None))
        self.start = end
        self.near = [m for m in self.near if m[0] >= self.window()[0]]
        if len(self.spans) >= self.policy.most_spans:
            self.problem = "more spans than the policy allows"

    def rows(self) -> list[tuple]:
        while self.more():
            self.cut()
        if self.problem:
            return [(self.key, None, None, None, None, None, self.problem, None)]
        padding = self.policy.padding if self.open else 0
        spans = [*self.spans, (self.start, self.total, "recording_end", None)]
        return [(self.key, i, a, b, max(0, a - padding), min(self.total, b + padding), why, c) for i, (a, b, why, c) in enumerate(spans)]


def plan_spans(marks: DataFrame, policy: SpanPolicy) -> DataFrame:
    """Cuts recordings at marks (key, total, at, confidence, kind): key, n, start, end, padded_start, padded_end, reason, confidence.

    From each cut the next is the mark nearest to the wanted place, then the most confident, the earliest, the first
    kind by name; without one in reach it is the wanted place. Padding is clipped at the ends. A recording that cannot
    be cut by the policy gives one row with the reason alone. Marks are shuffled and sorted by Spark and streamed: what
    is held is one recording's spans, at most policy.most_spans, and the marks the next cut may fall on. A recording
    without marks comes as one row with a null at.
    """
    names = ["key", "n", "start", "end", "padded_start", "padded_end", "reason", "confidence"]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            out = []
            for key, total, at, confidence, kind in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now is None or now.key != key:
                    out += now.rows() if now else []
                    now = _Spans(key, total, policy)
                if at is not None:
                    now.mark(at, confidence, kind)
            yield _spans(out)
        yield _spans(now.rows() if now else [])

    def _spans(rows: list[tuple]) -> pa.RecordBatch:
        types = [*[pa.int64()] * 6, pa.string(), pa.float64()]
        columns = list(zip(*rows, strict=True)) or [[]] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    rows = marks.repartition("key").sortWithinPartitions("key", "at", F.desc("confidence"), "kind")
    rows = rows.select(F.col("key").cast("long"), F.col("total").cast("long"), F.col("at").cast("long"), F.col("confidence").cast("double"), "kind")
    return rows.mapInArrow(fold, "key long, n long, start long, end long, padded_start long, padded_end long, reason string, confidence double")


def span_coverage(spans: DataFrame) -> DataFrame:
    """Proof of coverage by key: spans, first and last sample of the cores, their summed length, gaps and overlaps between neighbours."""
    w = Window.partitionBy("key").orderBy("n")
    step = F.col("start") - F.lag("end").over(w)
    rows = spans.where("n is not null").withColumn("step", F.coalesce(step, F.lit(0)))
    return rows.groupBy("key").agg(
        F.count("*").alias("spans"), F.min("start").alias("first"), F.max("end").alias("last"), F.sum(F.col("end") - F.col("start")).alias("core"),
        F.sum(F.greatest("step", F.lit(0))).alias("gap"), F.sum(F.greatest(-F.col("step"), F.lit(0))).alias("overlap"), F.sum(F.col("padded_end") - F.col("padded_start")).alias("analysed"),
    )
