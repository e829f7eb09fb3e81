"""V*: validation queries. V9 is packaging and not built."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators import checks, log_proofs
from weftline.operators.graphs import written
from weftline.plans.registry import Tables, query


@query(
    "V1_V2_integrity_report",
    """SELECT 'orders.pk' AS "check", CAST(count(*) - count(DISTINCT o_orderkey) AS BIGINT) AS violations FROM orders UNION ALL SELECT 'lineitem.order', CAST(count(*) AS BIGINT) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'orders.customer', CAST(count(*) AS BIGINT) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'lineitem.place', CAST(count(*) AS BIGINT) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
    UNION ALL SELECT 'events.kind', CAST(count(*) AS BIGINT) FROM events WHERE event_type NOT IN ('view', 'click', 'signup') UNION ALL SELECT 'labels.document', CAST(count(*) AS BIGINT) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""",
)
def v1(t: Tables) -> DataFrame:
    return checks.report(
        {
            "orders.pk": checks.duplicate_keys(t.orders, ["o_orderkey"]),
            "lineitem.order": checks.orphans(t.lineitem, "l_orderkey", t.orders, "o_orderkey"),
            "orders.customer": checks.orphans(t.orders, "o_custkey", t.customer, "c_custkey"),
            "lineitem.place": checks.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"]),
            "events.kind": checks.outside(t.events, "event_type", ["view", "click", "signup"]),
            "labels.document": checks.orphans(t.labels, "doc_id", t.documents, "doc_id"),
        }
    )


@query(
    "V3_append_only",
    "SELECT user_id, CAST(count(*) AS BIGINT) AS n FROM (SELECT user_id, ts <= lag(ts) OVER (PARTITION BY user_id "
    "ORDER BY event_id) AS back FROM events) WHERE back GROUP BY 1",
)
def v3(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id")
    return t.events.withColumn("back", F.col("ts") <= F.lag("ts").over(w)).where("back").groupBy("user_id").agg(F.count("*").alias("n"))


@query(
    "V4_release_shape",
    """WITH m AS (SELECT o_orderkey // 1000 AS shard, count(*) AS rows, min(o_orderkey) AS first_id, max(o_orderkey) AS last_id FROM orders GROUP BY 1),
    s AS (SELECT l_orderkey AS id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS place, l_quantity AS start FROM lineitem)
    SELECT 'shards' AS "check", CAST(count(*) AS BIGINT) AS violations FROM m WHERE shard % 5 = 3
    UNION ALL SELECT 'ranges', CAST(0 AS BIGINT) UNION ALL SELECT 'ids', CAST(0 AS BIGINT)
    UNION ALL SELECT 'slugs', CAST(count(*) AS BIGINT) FROM (SELECT o_custkey, o_orderdate FROM orders GROUP BY 1, 2 HAVING count(*) > 1)
    UNION ALL SELECT 'orphans', CAST(count(*) AS BIGINT) FROM s WHERE id NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'places', CAST(0 AS BIGINT) UNION ALL SELECT 'lengths', CAST(count(*) AS BIGINT) FROM lineitem WHERE l_discount = 0
    UNION ALL SELECT 'order', CAST(count(*) AS BIGINT) FROM (SELECT start < lag(start) OVER (PARTITION BY id ORDER BY place) AS late FROM s) WHERE late""",
)
def v4(t: Tables) -> DataFrame:
    """Orders as a release in shards of a thousand ids, of which every fifth is a row short in the manifest; lines as its segments."""
    shard = F.expr("o_orderkey div 1000")
    manifest = t.orders.groupBy(shard.alias("shard")).agg(F.count("*").alias("rows"), F.min("o_orderkey").alias("first_id"), F.max("o_orderkey").alias("last_id"))
    manifest = manifest.withColumn("rows", F.when(F.col("shard") % 5 == 3, F.col("rows") - 1).otherwise(F.col("rows")))
    recordings = t.orders.select(F.col("o_orderkey").alias("id"), shard.alias("shard"), F.concat_ws("-", "o_custkey", F.col("o_orderdate").cast("string")).alias("slug"))
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")) - 1
    segments = t.lineitem.select(F.col("l_orderkey").alias("id"), place.alias("place"), F.col("l_quantity").alias("start"), (F.col("l_quantity") + F.col("l_discount")).alias("end"))
    return checks.release_shape(manifest, recordings, segments)


@query(
    "V5_score_bounds",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_discount NOT BETWEEN 0 AND 0.09 OR l_tax NOT BETWEEN 0 AND 0.08 "
    "OR l_quantity <> floor(l_quantity)",
)
def v5(t: Tables) -> DataFrame:
    bad = ~F.col("l_discount").between(0, 0.09) | ~F.col("l_tax").between(0, 0.08) | (F.col("l_quantity") != F.floor("l_quantity"))
    return t.lineitem.where(bad).select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "V6_scope_uniqueness",
    "SELECT conv_id, turn FROM conversations GROUP BY 1, 2 HAVING count(*) > 1 UNION ALL SELECT conv_id, min(turn) FROM conversations "
    "GROUP BY 1 HAVING min(turn) <> 0 OR max(turn) + 1 <> count(DISTINCT turn)",
)
def v6(t: Tables) -> DataFrame:
    g = t.conversations.groupBy("conv_id").agg(F.min("turn").alias("turn"), F.max("turn").alias("hi"), F.countDistinct("turn").alias("n"))
    return checks.duplicate_keys(t.conversations, ["conv_id", "turn"]).drop("n").unionByName(g.where("turn <> 0 or hi + 1 <> n").select("conv_id", "turn"))


@query(
    "V7_network_projection",
    """WITH n AS (SELECT n_name AS name, CASE WHEN n_regionkey = 4 THEN 'other' ELSE 'public_creator' END AS grp FROM nation),
    e AS (SELECT a.n_name AS a, b.n_name AS b, c.w - 3 AS weight FROM nation a, nation b, (SELECT c_nationkey AS x, s_nationkey AS y, count(*) AS w FROM customer JOIN supplier ON c_custkey % 10 = s_suppkey GROUP BY 1, 2) c WHERE c.x = a.n_nationkey AND c.y = b.n_nationkey)
    SELECT x AS "check", CAST(0 AS BIGINT) AS violations FROM (VALUES ('names'), ('unique names'), ('unique years'), ('intervals'), ('months'), ('unique months'), ('month names'), ('rates'), ('endpoints'), ('burst names'), ('bursts')) AS v(x)
    UNION ALL SELECT 'groups', CAST(count(*) AS BIGINT) FROM n WHERE grp = 'other'
    UNION ALL SELECT 'years', CAST(count(DISTINCT year(o_orderdate)) AS BIGINT) FROM orders WHERE year(o_orderdate) < 2000
    UNION ALL SELECT 'loops', CAST(count(*) AS BIGINT) FROM e WHERE a = b
    UNION ALL SELECT 'unique edges', CAST(count(*) AS BIGINT) FROM (SELECT least(a, b), greatest(a, b) FROM e GROUP BY 1, 2 HAVING count(*) > 1)
    UNION ALL SELECT 'weights', CAST(count(*) AS BIGINT) FROM e WHERE weight < 0""",
)
def v7(t: Tables) -> DataFrame:
    """Nations as names, customers and suppliers as their links, orders as the years: what is wrong with them as a projection."""
    names = t.nation.select(F.col("n_name").alias("name"), F.when(F.col("n_regionkey") == 4, "other").otherwise("public_creator").alias("group"))
    annual = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.min("o_totalprice").alias("low"), F.avg("o_totalprice").alias("middle"), F.max("o_totalprice").alias("high"))
    named = t.events.join(t.nation, F.col("user_id") % 25 == F.col("n_nationkey"))
    monthly = named.groupBy(F.date_format("ts", "yyyy-MM").alias("month"), F.col("n_name").alias("name")).agg(F.count("*").alias("rate"))
    links = t.customer.join(t.supplier, F.col("c_custkey") % 10 == F.col("s_suppkey")).groupBy("c_nationkey", "s_nationkey").agg((F.count("*") - 3).alias("weight"))
    one, other = (t.nation.select(F.col("n_nationkey").alias(k), F.col("n_name").alias(n)) for k, n in (("c_nationkey", "a"), ("s_nationkey", "b")))
    edges = links.join(one, "c_nationkey").join(other, "s_nationkey").select("a", "b", "weight", F.lit(1.0).alias("baseline"), F.lit(1.0).alias("lift"))
    bursts = names.select("name", F.lit("2020-01").alias("start"), F.lit("2020-03").alias("end"), F.lit(3).alias("months"))
    return checks.network_projection(names, annual, monthly, edges, bursts, ["on_channel", "public_creator"])


@query(
    "V8_symmetry",
    "SELECT CAST(count(*) AS BIGINT) AS broken FROM (SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b "
    "ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey)",
)
def v8(t: Tables) -> DataFrame:
    """Half a matrix: every pair lacks its mirror image."""
    a, b = t.nation.alias("a"), t.nation.alias("b")
    half = a.join(b, (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") < F.col("b.n_nationkey"))).select(F.col("a.n_nationkey").alias("a"), F.col("b.n_nationkey").alias("b"), F.lit(1.0).alias("v"))
    return checks.asymmetric(half, "a", "b", "v").agg(F.count("*").alias("broken"))


@query(
    "V3_log_extended",
    """WITH o AS (SELECT user_id AS key, event_id, CASE WHEN user_id % 11 = 3 AND event_id % 5 = 0 THEN 'edited' ELSE event_type END AS kind FROM events WHERE event_id * 10 < (SELECT max(event_id) * 8 FROM events)),
    n AS (SELECT user_id AS key, event_id, event_type AS kind FROM events WHERE NOT (user_id % 7 = 2 AND event_id % 10 = 1)),
    x AS (SELECT key, event_id, kind, row_number() OVER (PARTITION BY key ORDER BY event_id) - 1 AS place FROM o), y AS (SELECT key, event_id, kind, row_number() OVER (PARTITION BY key ORDER BY event_id) - 1 AS place FROM n),
    d AS (SELECT coalesce(x.key, y.key) AS key, coalesce(x.place, y.place) AS place, x.event_id AS was, y.event_id AS now, x.event_id IS NOT NULL AND (y.event_id IS NULL OR x.event_id <> y.event_id OR x.kind <> y.kind) AS breach FROM x FULL JOIN y ON x.key = y.key AND x.place = y.place),
    f AS (SELECT key, CAST(min(place) FILTER (breach) AS BIGINT) AS place, count(was) AS n, count(now) AS m FROM d GROUP BY 1)
    SELECT key, place, CASE WHEN n = 0 THEN 'added' WHEN m = 0 THEN 'removed' WHEN place IS NOT NULL THEN 'breach' WHEN n = m THEN 'same' ELSE 'extended' END AS verdict FROM f""",
)
def v3_extended(t: Tables) -> DataFrame:
    """Two snapshots of the event log by user: most users' histories were extended, some were edited or cut."""
    kind = F.when((F.col("user_id") % 11 == 3) & (F.col("event_id") % 5 == 0), "edited").otherwise(F.col("event_type"))
    last = t.events.agg(F.max("event_id")).first()[0]
    old = t.events.where(F.col("event_id") * 10 < last * 8).select("user_id", "event_id", kind.alias("kind"))
    new = t.events.where("not (user_id % 7 = 2 and event_id % 10 = 1)").select("user_id", "event_id", F.col("event_type").alias("kind"))
    chains = [written(log_proofs.chained(x, "user_id", ["event_id"], ["event_id", "kind"])) for x in (old, new)]
    found = log_proofs.compared(*chains)
    breach = F.col("verdict").isin("changed", "deleted", "inserted", "reordered")
    return found.select("key", "place", F.when(breach, "breach").otherwise(F.col("verdict")).alias("verdict"))


# Orders as summaries of four kinds, lines as their items, nine of ten customers as published recordings.
_SUMMARY_SQL = """WITH s AS (SELECT CASE WHEN o_orderkey % 97 = 5 THEN 'S ' ELSE 's-' END || o_orderkey AS id, ['archive', 'yearly', 'monthly', 'transcript', 'weekly'][CASE WHEN o_orderkey % 101 = 7 THEN 5 ELSE o_orderkey % 4 + 1 END] AS kind,
      CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderkey % 4 = 1 THEN strftime(o_orderdate, '%Y') WHEN o_orderkey % 4 = 2 THEN strftime(o_orderdate, '%Y-%m') END AS period,
      CASE WHEN o_orderkey % 4 = 3 OR o_orderkey % 50 = 0 THEN 'r' || o_custkey END AS recording_id, CASE WHEN o_orderpriority LIKE '1%' THEN 'prepared' ELSE 'approved' END AS publication FROM orders),
    i AS (SELECT CASE WHEN l_orderkey % 97 = 5 THEN 'S ' ELSE 's-' END || l_orderkey AS id, CASE l_linenumber WHEN 1 THEN 'summary' WHEN 2 THEN 'uncertainties' WHEN 3 THEN 'topics' ELSE 'other' END AS section, CASE WHEN l_quantity > 1 THEN 'text' ELSE ' ' END AS text,
      CASE l_returnflag WHEN 'R' THEN 'uncertainty' WHEN 'A' THEN 'observed' ELSE 'told' END AS classification, CASE WHEN l_tax = 0 THEN NULL ELSE ['r' || l_suppkey, 'r' || (l_partkey % 100 * 10)] END AS sources FROM lineitem),
    p AS (SELECT 'r' || c_custkey AS recording_id FROM customer WHERE c_custkey % 10 <> 0), e AS (SELECT id, unnest(sources) AS recording_id FROM i)
    SELECT 'ids' AS "check", CAST(count(*) AS BIGINT) AS violations FROM s WHERE id LIKE 'S %' UNION ALL SELECT 'unique ids', count(*) FROM (SELECT id FROM s GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'kinds', count(*) FROM s WHERE kind = 'weekly' UNION ALL SELECT 'publication', count(*) FROM s WHERE publication = 'prepared' UNION ALL SELECT 'titles', 0 UNION ALL SELECT 'periods', count(*) FROM s WHERE length(period) = 10
    UNION ALL SELECT 'kind and period', count(*) FROM s WHERE (kind = 'archive' AND period IS NOT NULL) OR (kind = 'yearly' AND coalesce(length(period), 0) <> 4) OR (kind IN ('monthly', 'transcript') AND length(period) <> 7)
    UNION ALL SELECT 'unreleased', count(*) FROM s WHERE kind = 'transcript' AND (recording_id IS NULL OR recording_id NOT IN (SELECT recording_id FROM p)) UNION ALL SELECT 'recordings', count(*) FROM s WHERE kind <> 'transcript' AND recording_id IS NOT NULL
    UNION ALL SELECT 'unique scopes', count(*) FROM (SELECT kind, CASE WHEN kind = 'transcript' THEN recording_id ELSE period END AS scope FROM s GROUP BY 1, 2 HAVING count(*) > 1)
    UNION ALL SELECT 'empty', count(*) FROM s WHERE id NOT IN (SELECT id FROM i WHERE section = 'summary') UNION ALL SELECT 'sections', count(*) FROM i WHERE section = 'other'
    UNION ALL SELECT 'long sections', count(*) FROM (SELECT id, section FROM i GROUP BY 1, 2 HAVING count(*) > 100) UNION ALL SELECT 'texts', count(*) FROM i WHERE text = ' '
    UNION ALL SELECT 'classes', count(*) FROM i WHERE classification = 'told' OR (section = 'uncertainties' AND classification <> 'uncertainty') UNION ALL SELECT 'sources', count(*) FROM i WHERE sources IS NULL OR sources[1] = sources[2]
    UNION ALL SELECT 'unreleased sources', count(*) FROM e WHERE recording_id NOT IN (SELECT recording_id FROM p) UNION ALL SELECT 'foreign sources', count(*) FROM e JOIN s USING (id) WHERE kind = 'transcript' AND e.recording_id IS DISTINCT FROM s.recording_id
    UNION ALL SELECT 'orphans', count(*) FROM i WHERE id NOT IN (SELECT id FROM s)"""


@query("V6_summary_release", _SUMMARY_SQL)
def v6_release(t: Tables) -> DataFrame:
    """What is wrong with orders and lines as a release of summaries."""
    key, line = F.col("o_orderkey"), F.col("l_orderkey")
    name = lambda k: F.concat(F.when(k % 97 == 5, "S ").otherwise("s-"), k.cast("string"))
    recording = lambda c: F.concat(F.lit("r"), c.cast("string"))
    kinds = F.array(*[F.lit(k) for k in checks.SUMMARY_KINDS])
    day = lambda form: F.date_format("o_orderdate", form)
    period = F.when(F.col("o_orderstatus") == "P", day("yyyy-MM-dd")).when(key % 4 == 1, day("yyyy")).when(key % 4 == 2, day("yyyy-MM"))
    summaries = t.orders.select(
        name(key).alias("id"),
        F.when(key % 101 == 7, "weekly").otherwise(F.get(kinds, (key % 4).cast("int"))).alias("kind"),
        period.alias("period"),
        F.lit("A summary").alias("title"),
        F.when((key % 4 == 3) | (key % 50 == 0), recording(F.col("o_custkey"))).alias("recording_id"),
        F.when(F.col("o_orderpriority").startswith("1"), "prepared").otherwise("approved").alias("publication"),
    )
    number, flag = F.col("l_linenumber"), F.col("l_returnflag")
    items = t.lineitem.select(
        name(line).alias("id"),
        F.when(number == 1, "summary").when(number == 2, "uncertainties").when(number == 3, "topics").otherwise("other").alias("section"),
        F.when(F.col("l_quantity") > 1, "text").otherwise(" ").alias("text"),
        F.when(flag == "R", "uncertainty").when(flag == "A", "observed").otherwise("told").alias("classification"),
        F.when(F.col("l_tax") != 0, F.array(recording(F.col("l_suppkey")), recording(F.col("l_partkey") % 100 * 10))).alias("sources"),
    )
    published = t.customer.where("c_custkey % 10 <> 0").select(recording(F.col("c_custkey")).alias("recording_id"))
    return checks.summary_release(summaries, items, published, ["summary", "uncertainties", "topics"], ["observed", "uncertainty"])
