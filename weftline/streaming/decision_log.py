"""Structured Streaming over append-only logs: the current state per key is kept by foreachBatch, exactly once per batch.

These map append-only logs, their current views and imports (R1, R3, R4) to micro-batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


#: Batches after which what was written since the last base goes into a new one.
EVERY = 16


def follow_latest(log: DataFrame, keys: list[str], sequence: str, path: str, checkpoint: str, every: int = EVERY) -> StreamingQuery:
    """Keep the latest row of each key of a streaming log under path; current_state() reads it.

    A batch writes the latest row of its own keys alone, as delta-<batch>. Every so many batches the base and the deltas
    since go into a new base-<batch>; what is older than the base before is removed, so a reader of that one ends in
    peace. A batch that is run again overwrites its own delta, or finds itself in a base: no row counts twice.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        base, _ = _written(spark, path)
        if base is not None and base >= number:
            return
        _latest(batch, keys, sequence).write.mode("overwrite").parquet(f"{path}/delta-{number}")
        if (number + 1) % every == 0:
            _latest(current_rows(spark, path), keys, sequence).write.mode("overwrite").parquet(f"{path}/base-{number}")
            _remove(spark, path, before=base)

    return log.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _latest(rows: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(sequence)).alias("_b"))
    return best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in rest])


def _folders(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(kind, batch) of everything under path that was written to the end."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    names = [s.getPath() for s in fs.listStatus(where) if s.isDirectory()]
    done = [p.getName().split("-") for p in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return [(kind, int(n)) for kind, n in done]


def _written(spark: SparkSession, path: str) -> tuple[int | None, list[int]]:
    """The newest base and the deltas after it."""
    found = _folders(spark, path)
    base = max((n for kind, n in found if kind == "base"), default=None)
    return base, sorted(n for kind, n in found if kind == "delta" and (base is None or n > base))


def _remove(spark: SparkSession, path: str, before: int | None) -> None:
    for kind, n in _folders(spark, path) if before is not None else []:
        if n < before or kind == "delta" and n == before:
            where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}-{n}")
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def current_rows(spark: SparkSession, path: str) -> DataFrame:
    base, deltas = _written(spark, path)
    return spark.read.parquet(*[f"{path}/base-{base}"] * (base is not None), *[f"{path}/delta-{n}" for n in deltas])


def current_state(spark: SparkSession, path: str, keys: list[str], sequence: str) -> DataFrame:
    """The latest row of each key, from the newest base and the deltas after it."""
    return _latest(current_rows(spark, path), keys, sequence)


def windowed_counts(events: DataFrame, at: str, kind: str, width: str = "1 day", late: str = "2 hours") -> DataFrame:
    """Counts and sums by tumbling event-time window and kind. In complete mode every row counts and every window stays;
    in append mode, as keyed_state.closed_windows() has it, rows behind the watermark are dropped."""
    timed = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return timed.groupBy(F.window(at, width).alias("w"), kind).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), kind, "n", "total")
