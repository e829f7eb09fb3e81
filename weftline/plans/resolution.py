"""W*, R*, J9, J11, J12, P6, K11, K12: logs and observations; events is the log (user_id, event_id, event_type, ts, props)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators import resolve
from weftline.operators.graphs import shared_folder
from weftline.plans.registry import Tables, query
from weftline.streaming import decision_log, keyed_state

RANK = "CASE event_type WHEN 'error' THEN 0 WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'click' THEN 3 ELSE 4 END"


@query(
    "W1_latest_by_sequence",
    "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) n "
    "FROM events) WHERE n = 1",
)
def w1(t: Tables) -> DataFrame:
    return resolve.latest_per_key(t.events.select("user_id", "event_id", "event_type", "value"), ["user_id"], [F.col("event_id")])


@query(
    "W2_latest_by_instant",
    "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type "
    "ORDER BY date_trunc('day', ts) DESC, event_id DESC) n FROM events) WHERE n = 1",
)
def w2(t: Tables) -> DataFrame:
    e = t.events.select("user_id", "event_type", F.date_trunc("day", "ts").alias("day"), "event_id", "value")
    return resolve.latest_per_key(e, ["user_id", "event_type"], [F.col("day"), F.col("event_id")]).drop("day")


_WINNER = (
    f"SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CAST(json_extract_string(props, '$.k') AS INT) DESC, date_trunc('day', "
    f"ts) DESC, {RANK}, md5(props) DESC, event_type DESC, event_id DESC) n FROM events"
)


def _ranked(t: Tables) -> tuple[DataFrame, list]:
    e = t.events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return e, [F.desc("k"), F.desc(F.date_trunc("day", "ts")), F.expr(RANK), F.desc(F.md5(F.col("props").cast("binary"))), F.desc("event_type"), F.desc("event_id")]


@query("W3_winner_observation", f"SELECT user_id, event_id, event_type, value FROM ({_WINNER}) WHERE n = 1")
def w3(t: Tables) -> DataFrame:
    e, order = _ranked(t)
    return resolve.winners(e, ["user_id"], order).select("user_id", "event_id", "event_type", "value")


@query(
    "W4_first_known_field",
    f"""SELECT user_id, min_by(big, n) FILTER (big IS NOT NULL) AS big, min_by(kind, n) FILTER (kind IS NOT NULL AND kind <> '') AS kind
    FROM (SELECT user_id, n, CASE WHEN value > 60 THEN value END AS big, CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS kind FROM ({_WINNER})) GROUP BY 1""",
)
def w4(t: Tables) -> DataFrame:
    e, order = _ranked(t)
    e = e.withColumn("big", F.when(F.col("value") > 60, F.col("value"))).withColumn("kind", F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")))
    return resolve.best_known(e, ["user_id"], ["big", "kind"], order)


@query(
    "W5_first_and_last",
    "SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_event_type, arg_max(event_type, (ts, event_id)) AS last_event_type, arg_min(value, (ts, event_id)) AS first_value, arg_max(value, (ts, event_id)) AS last_value FROM events GROUP BY 1",
)
def w5(t: Tables) -> DataFrame:
    return resolve.first_last(t.events, ["user_id"], "ts", "event_id", ["event_type", "value"])


@query(
    "W6_chronology_audit",
    "SELECT user_id, event_id, n, gap_ms FROM (SELECT user_id, event_id, CAST(row_number() OVER w AS BIGINT) AS n, epoch_us(ts) // 1000 - epoch_us(lag(ts) OVER w) // 1000 AS gap_ms FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) WHERE gap_ms < 600000",
)
def w6(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id")
    ms = F.expr("unix_micros(cast(ts as timestamp)) div 1000")
    return t.events.select("user_id", "event_id", F.row_number().over(w).cast("long").alias("n"), (ms - F.lag(ms).over(w)).alias("gap_ms")).where("gap_ms < 600000")


_ALLOWED = [("signup", "view"), ("signup", "click"), ("view", "click"), ("view", "view"), ("click", "view"), ("click", "purchase"), ("purchase", "view"), ("purchase", "error"), ("error", "signup")]


@query(
    "W7_illegal_transitions",
    "SELECT user_id, event_id, previous, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM events) WHERE previous IS NOT NULL AND (previous, event_type) NOT IN ("
    + ", ".join(f"('{a}', '{b}')" for a, b in _ALLOWED)
    + ")",
)
def w7(t: Tables) -> DataFrame:
    return resolve.transitions(t.events, "user_id", ["event_id"], "event_type", _ALLOWED).select("user_id", "event_id", "previous", "event_type")


@query(
    "W8_running_offset",
    "SELECT l_orderkey, l_linenumber, l_partkey, first_byte, first_byte + l_quantity - 1 AS last_byte "
    "FROM (SELECT *, coalesce(sum(l_quantity) OVER (PARTITION BY l_orderkey "
    "ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_byte "
    "FROM lineitem)",
)
def w8(t: Tables) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("l_quantity").over(w), F.lit(0.0))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", first.alias("first_byte"), (first + F.col("l_quantity") - 1).alias("last_byte"))


@query(
    "W9_ordinal",
    "SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey "
    "ORDER BY o_orderdate, o_orderkey) - 1 AS BIGINT) AS ordinal FROM orders",
)
def w9(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return t.orders.select("o_custkey", "o_orderkey", (F.row_number().over(w) - 1).cast("long").alias("ordinal"))


@query(
    "J9_newest_theta",
    "SELECT a.user_id, a.event_type, a.event_id FROM events a WHERE NOT EXISTS (SELECT 1 FROM events b "
    "WHERE b.user_id = a.user_id AND b.event_type = a.event_type AND (b.ts > a.ts OR (b.ts = a.ts AND b.event_id > a.event_id)))",
)
def j9(t: Tables) -> DataFrame:
    """The theta anti-join 'no newer row', as the aggregate it amounts to."""
    return resolve.latest_per_key(t.events.select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).drop("ts")


@query(
    "J11_as_of_backward",
    "SELECT p.user_id, p.event_id, s.event_type AS state FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type IN ('signup', 'error')) s ON p.user_id = s.user_id AND p.ts >= s.ts",
)
def j11(t: Tables) -> DataFrame:
    p = t.events.where("event_type = 'purchase'").select("user_id", "ts", "event_id")
    s = t.events.where("event_type in ('signup', 'error')").select("user_id", "ts", F.col("event_type").alias("state"))
    return resolve.as_of(p, s, "user_id", "ts", "state").drop("ts")


@query(
    "J12_as_of_forward",
    """SELECT p.user_id, p.event_id, coalesce(s.event_id, l.last_id) AS segment FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') s ON p.user_id = s.user_id AND p.ts < s.ts LEFT JOIN (SELECT user_id, arg_max(event_id, ts) AS last_id FROM events WHERE event_type = 'view' GROUP BY 1) l ON l.user_id = p.user_id""",
)
def j12(t: Tables) -> DataFrame:
    """The first segment after the instant, or else the key's last one."""
    p = t.events.where("event_type = 'purchase'").select("user_id", "ts", "event_id")
    v = t.events.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("segment"))
    last = v.groupBy("user_id").agg(F.max_by("segment", "ts").alias("last_id"))
    return resolve.as_of(p, v, "user_id", "ts", "segment", backward=False).join(last, "user_id", "left").select("user_id", "event_id", F.coalesce("segment", "last_id").alias("segment"))


@query(
    "P6_eligible",
    """WITH cur AS (SELECT user_id, arg_max(event_type, event_id) AS s FROM events GROUP BY 1), gates AS (SELECT user_id, event_type AS gate, arg_max(value, event_id) AS v FROM events GROUP BY 1, 2)
    SELECT user_id FROM cur WHERE s <> 'error' AND user_id IN (SELECT user_id FROM gates WHERE v > 2 GROUP BY 1 HAVING count(DISTINCT gate) = 5) AND user_id NOT IN (SELECT user_id FROM events WHERE value > 250)""",
)
def p6(t: Tables) -> DataFrame:
    current = resolve.latest_per_key(t.events.select("user_id", "event_id", "event_type"), ["user_id"], [F.col("event_id")])
    decisions = current.select("user_id", F.when(F.col("event_type") != "error", "publish").otherwise("hold").alias("decision"))
    gates = t.events.groupBy("user_id", F.col("event_type").alias("gate")).agg(F.max_by("value", "event_id").alias("v")).select("user_id", "gate", F.when(F.col("v") > 2, "cleared").otherwise("held").alias("decision"))
    return resolve.eligible(decisions, gates, t.events.where("value > 250").select("user_id").distinct(), "user_id", 5)


@query(
    "R2_chronology_rules",
    "SELECT user_id, event_id, event_type, rule FROM (SELECT *, CASE WHEN event_type = 'view' AND p = 'error' THEN 'weakens' WHEN ts <= pt THEN 'time' WHEN p = event_type THEN 'repeats' END AS rule FROM (SELECT *, lag(event_type) OVER w AS p, lag(ts) OVER w AS pt FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))) WHERE rule IS NOT NULL",
)
def r2(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id")
    e = t.events.withColumn("p", F.lag("event_type").over(w)).withColumn("pt", F.lag("ts").over(w))
    rule = F.when((F.col("event_type") == "view") & (F.col("p") == "error"), "weakens").when(F.col("ts") <= F.col("pt"), "time").when(F.col("p") == F.col("event_type"), "repeats")
    return e.select("user_id", "event_id", "event_type", rule.alias("rule")).where("rule is not null")


@query("R1_current_view", "SELECT user_id, event_type, CAST(count(*) AS BIGINT) AS n, max(event_id) AS last_id FROM events GROUP BY 1, 2")
def r1(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last_id"))


@query("R3_import_once", "SELECT user_id, event_id FROM events WHERE event_id % 7 < 5")
def r3(t: Tables) -> DataFrame:
    """A replayed batch adds nothing: rows of batches 2 to 4 arrive again and are ignored by their key."""
    e = t.events.select("user_id", "event_id")
    return resolve.insert_ignore(e.where("event_id % 7 < 4"), e.where("event_id % 7 between 2 and 4"), ["event_id"]).select("user_id", "event_id")


@query(
    "R4_late_observations",
    "SELECT user_id, epoch_us(min(ts)) AS first_seen, epoch_us(max(ts)) AS last_seen, arg_max(event_type, (value, event_id)) AS winner "
    "FROM events GROUP BY 1",
)
def r4(t: Tables) -> DataFrame:
    """Early and late parts merge to what the whole history gives."""

    def part(e: DataFrame) -> DataFrame:
        best = F.max(F.struct("value", "event_id", "event_type"))
        return e.groupBy("user_id").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), best.alias("winner"))

    both = resolve.upsert(part(t.events.where("event_id % 3 <> 0")), part(t.events.where("event_id % 3 = 0")), "user_id", {"first_seen": "least", "last_seen": "greatest", "winner": "greatest"})
    return both.select("user_id", F.unix_micros(F.col("first_seen").cast("timestamp")).alias("first_seen"), F.unix_micros(F.col("last_seen").cast("timestamp")).alias("last_seen"), "winner.event_type").withColumnRenamed("event_type", "winner")


@query(
    "K11_upsert",
    "SELECT o_custkey, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1",
)
def k11(t: Tables) -> DataFrame:
    def part(o: DataFrame) -> DataFrame:
        return o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"), F.count("*").alias("n"))

    return resolve.upsert(part(t.orders.where("o_orderkey % 2 = 0")), part(t.orders.where("o_orderkey % 2 = 1")), "o_custkey", {"first_date": "least", "last_date": "greatest", "n": "sum"})


@query(
    "K12_insert_ignore",
    "SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders "
    "WHERE o_orderstatus = 'F') GROUP BY 1 UNION ALL SELECT o_custkey, min(o_orderkey) FROM orders WHERE o_orderstatus = 'F' GROUP BY 1",
)
def k12(t: Tables) -> DataFrame:
    old = t.orders.where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey"))
    return resolve.insert_ignore(old, t.orders.select("o_custkey", "o_orderkey"), ["o_custkey"])


@query("R1_stream_latest", "SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY 1")
def r1_stream(t: Tables) -> DataFrame:
    """The current view of the event log, kept by a stream that reads it to its end."""
    folder = f"{shared_folder(t.spark)}/stream-{uuid.uuid4().hex}"
    rows = t.events.select("user_id", "event_type", "event_id")
    log = t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.folder).select(*rows.columns)
    decision_log.follow_latest(log, ["user_id"], "event_id", f"{folder}/state", f"{folder}/mark").awaitTermination()
    return decision_log.current_state(t.spark, f"{folder}/state", ["user_id"], "event_id")


@query(
    "R7_stream_windows",
    "SELECT date_trunc('day', ts) AS start, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total FROM events "
    "GROUP BY 1, 2",
)
def r7(t: Tables) -> DataFrame:
    """Daily windows of event time, each written once, when the watermark has passed its end; a last row far ahead closes
    all. One file of events is one batch."""
    folder = f"{shared_folder(t.spark)}/stream-{uuid.uuid4().hex}"
    ahead = t.events.orderBy(F.desc("ts")).limit(1).withColumn("ts", (F.col("ts") + F.expr("interval 10 days"))).withColumn("event_type", F.lit("closing"))
    t.events.write.parquet(f"{folder}/in")
    ahead.write.mode("append").parquet(f"{folder}/in")
    log = t.spark.readStream.schema(t.events.schema).parquet(f"{folder}/in")
    windows = keyed_state.closed_windows(log, "ts", "event_type", "value").writeStream.outputMode("append").format("parquet")
    windows.option("checkpointLocation", f"{folder}/mark").trigger(availableNow=True).start(f"{folder}/windows").awaitTermination()
    found = t.spark.read.parquet(f"{folder}/windows")
    return found.select("start", "event_type", "n", F.round("total", 4).alias("total"))
