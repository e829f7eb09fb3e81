"""Order-dependent folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators import folds
from weftline.plans.registry import Tables, query
from weftline.streaming import keyed_state


def pack_sql(rows: str, lot: str, most_size: int, most_rows: int) -> str:
    """Greedy packing as recursion over each lot's rows in order; rows: a query for key, place, size."""
    closes = f"total + s.size > {most_size} OR n + 1 > {most_rows}"
    return f"""WITH RECURSIVE s AS (SELECT *, row_number() OVER (PARTITION BY lot ORDER BY key, place) AS i FROM (SELECT key, place, size, {lot} AS lot FROM ({rows}))),
    r AS (SELECT key, place, size, lot, i, CAST(0 AS BIGINT) AS pack, size AS total, 1 AS n FROM s WHERE i = 1
    UNION ALL SELECT s.key, s.place, s.size, s.lot, s.i, CASE WHEN {closes} THEN pack + 1 ELSE pack END, CASE WHEN {closes} THEN s.size ELSE total + s.size END, CASE WHEN {closes} THEN 1 ELSE n + 1 END
    FROM r JOIN s ON s.lot = r.lot AND s.i = r.i + 1)
    SELECT key, place, size, lot, pack FROM r"""


@query("K4_summary_shards", pack_sql("SELECT conv_id AS key, CAST(turn AS BIGINT) AS place, CAST(strlen(text) AS BIGINT) AS size FROM conversations", "key // 100", 65_536, 64))
def k4(t: Tables) -> DataFrame:
    """Turns in order, at most 64 and 64 KiB a shard, by hundreds of conversations."""
    rows = t.conversations.select(F.col("conv_id").alias("key"), F.col("turn").cast("long").alias("place"), F.octet_length("text").cast("long").alias("size"))
    return folds.pack_in_order(rows, most_size=65_536, most_rows=64, by_key=False, cell=100)


@query("K5_passage_shards", pack_sql("SELECT doc_id AS key, CAST(0 AS BIGINT) AS place, CAST(coalesce(strlen(text), 0) AS BIGINT) AS size FROM documents", "key // 500", 4 * 1024 * 1024, 32))
def k5(t: Tables) -> DataFrame:
    """Documents in order, at most 32 and 4 MiB a shard, by 500 ids."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = t.documents.select(F.col("doc_id").alias("key"), F.lit(0).cast("long").alias("place"), size.alias("size"))
    return folds.pack_in_order(rows, most_size=4 * 1024 * 1024, most_rows=32, by_key=False, cell=500)


@query(
    "R5_rate_limits",
    """WITH RECURSIVE s AS (SELECT user_id AS key, epoch_us(ts) // 1000 AS "at", event_id AS id, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id) AS i FROM events),
    r AS (SELECT key, "at", id, i, true AS admitted, "at" // 86400000 AS day, 1 AS today, ["at"] AS recent FROM s WHERE i = 1
    UNION ALL SELECT key, "at", id, i, ok, day, today + CASE WHEN ok THEN 1 ELSE 0 END, CASE WHEN ok THEN list_append(recent, "at") ELSE recent END
    FROM (SELECT *, today < 2 AND len(recent) < 1 AND (len(recent) = 0 OR "at" - recent[-1] >= 3000) AS ok
          FROM (SELECT s.key, s."at", s.id, s.i, s."at" // 86400000 AS day, CASE WHEN s."at" // 86400000 = r.day THEN r.today ELSE 0 END AS today, [x FOR x IN r.recent IF x > s."at" - 3600000] AS recent
                FROM r JOIN s ON s.key = r.key AND s.i = r.i + 1)))
    SELECT key, "at", id, admitted FROM r""",
)
def r5(t: Tables) -> DataFrame:
    rows = t.events.select(F.col("user_id").alias("key"), F.expr("unix_millis(cast(ts as timestamp))").alias("at"), F.col("event_id").alias("id"))
    return folds.rate_limited(rows, per_day=2, per_hour=1, gap_ms=3000)


@query(
    "R6_result_cache",
    "SELECT user_id, event_type, bucket, min(event_id) AS event_id, CAST(count(*) - 1 AS BIGINT) AS hits "
    "FROM (SELECT *, epoch_us(ts) // 300000000 AS bucket FROM events) GROUP BY 1, 2, 3",
)
def r6(t: Tables) -> DataFrame:
    """Five-minute result cache: the first request of a key and bucket computes, the others hit."""
    bucket = F.expr("unix_seconds(cast(ts as timestamp)) div 300")
    return t.events.groupBy("user_id", "event_type", bucket.alias("bucket")).agg(F.min("event_id").alias("event_id"), (F.count("*") - 1).alias("hits"))


_REQUESTS = """SELECT CAST(user_id AS VARCHAR) AS key, epoch_us(ts) // 1000 AS "at", event_id AS id, event_type AS what, event_type = 'error' AS failed FROM events"""


@query(
    "R5_clock_limits",
    f"""WITH RECURSIVE q AS ({_REQUESTS}), s AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY "at", id) AS i FROM q),
    r AS (SELECT key, "at", id, what, i, 'admitted' AS outcome, "at" // 86400000 AS day, "at" // 3600000 AS hour, 1 AS today, 1 AS this_hour, "at" AS last FROM s WHERE i = 1
    UNION ALL SELECT key, "at", id, what, i, CASE WHEN ok THEN 'admitted' ELSE 'refused' END, day, hour, today + CASE WHEN ok THEN 1 ELSE 0 END, this_hour + CASE WHEN ok THEN 1 ELSE 0 END, CASE WHEN ok THEN "at" ELSE last END
    FROM (SELECT *, today < 3 AND this_hour < 1 AND (last IS NULL OR "at" - last >= 600000) AS ok FROM (
          SELECT s.key, s."at", s.id, s.what, s.i, s."at" // 86400000 AS day, s."at" // 3600000 AS hour, CASE WHEN s."at" // 86400000 = r.day THEN r.today ELSE 0 END AS today,
          CASE WHEN s."at" // 3600000 = r.hour THEN r.this_hour ELSE 0 END AS this_hour, CASE WHEN s."at" // 86400000 = r.day THEN r.last END AS last FROM r JOIN s ON s.key = r.key AND s.i = r.i + 1)))
    SELECT key, "at", id, what, outcome FROM r""",
)
def r5_clock(t: Tables) -> DataFrame:
    """Requests of each user under limits by day and clock hour and a gap of ten minutes; tight, so that some are refused."""
    return keyed_state.decided(_requests(t), keyed_state.limited(per_day=3, per_hour=1, gap=600_000))


@query("R6_keyed_cache")
def r6_cache(t: Tables) -> DataFrame:
    """Outcomes of each user's requests with a result cache of two days at most and a cooldown of an hour after errors."""
    return keyed_state.decided(_requests(t), keyed_state.cached(lifetime=2 * 86_400_000, cooldown=3_600_000))


def _requests(t: Tables) -> DataFrame:
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    return t.events.select(F.col("user_id").cast("string").alias("key"), at.alias("at"), F.col("event_id").alias("id"), F.col("event_type").alias("what"), (F.col("event_type") == "error").alias("failed"))
