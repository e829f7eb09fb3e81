"""K1-K3, K6-K8: release building. K9 is packaging and not built."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators import fulltext, graphs
from weftline.operators.graphs import shared_folder
from weftline.plans.registry import Tables, query
from weftline.plans.search import TOKENS
from weftline.sources import sinks
from weftline.sources.releases import Releases


def _release(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey")
    return sinks.nested(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), lines, "o_orderkey", "lines", ["l_linenumber", "l_partkey", "l_suppkey"], ["l_linenumber", "l_partkey", "l_suppkey"])


@query(
    "K1_nested_release",
    "SELECT o_orderkey, o_custkey, CAST(count(l_orderkey) AS INT) AS n, coalesce(string_agg(l_linenumber || ':' || l_partkey, ',' "
    "ORDER BY l_linenumber, l_partkey, l_suppkey), '') AS lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2",
)
def k1(t: Tables) -> DataFrame:
    text = F.array_join(F.transform("lines", lambda x: F.concat_ws(":", x["l_linenumber"], x["l_partkey"])), ",")
    return _release(t).select("o_orderkey", "o_custkey", F.size("lines").alias("n"), text.alias("lines"))


@query(
    "K2_sharded_release",
    "SELECT o_orderstatus, CAST(n // 250 AS BIGINT) AS shard, CAST(count(*) AS BIGINT) AS rows, min(o_orderkey) AS first_id, "
    "max(o_orderkey) AS last_id FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS n "
    "FROM orders) GROUP BY 1, 2",
)
def k2(t: Tables) -> DataFrame:
    shards = sinks.numbered_shards(t.orders, ["o_orderkey"], 250, "o_orderstatus")
    return shards.groupBy("o_orderstatus", "shard").agg(F.count("*").alias("rows"), F.min("o_orderkey").alias("first_id"), F.max("o_orderkey").alias("last_id"))


@query(
    "K2_sealed_shards",
    "SELECT o_orderstatus, shard, rows, CAST(strlen(payload) AS BIGINT) AS bytes, sha256(payload) AS sha256 "
    "FROM (SELECT o_orderstatus, CAST(n // 250 AS BIGINT) AS shard, CAST(count(*) AS BIGINT) AS rows, '[' || "
    "string_agg('{\"o_orderkey\":' || o_orderkey || ',\"o_custkey\":' || o_custkey || '}', ',' ORDER BY o_orderkey) || ']' AS payload "
    "FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS n FROM orders) GROUP BY 1, 2)",
)
def k2b(t: Tables) -> DataFrame:
    shards = sinks.numbered_shards(t.orders, ["o_orderkey"], 250, "o_orderstatus")
    return sinks.sealed(shards, ["o_orderstatus", "shard"], ["o_orderkey"], ["o_orderkey", "o_custkey"]).drop("payload")


@query(
    "K2_written_and_validated",
    "SELECT CAST(count(*) AS BIGINT) AS shards, CAST(0 AS BIGINT) AS broken "
    "FROM (SELECT DISTINCT o_orderstatus, (row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) // 250 FROM orders)",
)
def k2c(t: Tables) -> DataFrame:
    """A release written to the shared folder, read again and verified."""
    shards = sinks.numbered_shards(t.orders, ["o_orderkey"], 250, "o_orderstatus")
    sealed = sinks.sealed(shards, ["o_orderstatus", "shard"], ["o_orderkey"], ["o_orderkey", "o_custkey"])
    path = f"{shared_folder(t.spark)}/release-{uuid.uuid4().hex}"
    manifest = sinks.write_release(sealed, F.concat_ws("-", "o_orderstatus", F.col("shard").cast("string")), path)
    broken = sinks.validate_release(t.spark, path).count()
    return manifest.agg(F.count("*").alias("shards"), F.lit(broken).cast("long").alias("broken"))


_CELL = "o_orderkey // 1000"


@query(
    "K2_reused_shards",
    f"""WITH s AS (SELECT {_CELL} AS shard, CAST(count(*) AS BIGINT) AS n, bool_or(o_orderkey BETWEEN lo AND hi) AS touched
        FROM orders, (SELECT min(o_orderkey) + (max(o_orderkey) - min(o_orderkey)) // 2 AS lo, min(o_orderkey) + (max(o_orderkey) - min(o_orderkey)) // 2 + (max(o_orderkey) - min(o_orderkey)) // 100 AS hi FROM orders) GROUP BY 1)
    SELECT 1 AS release, count(*) AS shards, count(*) AS written, CAST(sum(n) AS BIGINT) AS rows FROM s UNION ALL SELECT 2, count(*), count(*) FILTER (touched), CAST(sum(n) AS BIGINT) FROM s""",
)
def k2_reused(t: Tables) -> DataFrame:
    """A release of all orders, then one in which the prices of a hundredth of the keys have changed: what each writes."""
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", F.expr("o_orderkey div 1000").alias("shard"))
    lo, hi = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    middle = lo + (hi - lo) // 2
    later = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey").between(middle, middle + (hi - lo) // 100), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    releases = Releases(t.spark, f"{shared_folder(t.spark)}/releases-{uuid.uuid4().hex}")
    done = [releases.publish({"orders": (rows, "shard")}) for rows in (orders, later)]
    return t.spark.createDataFrame([(i + 1, d.shards, d.written, d.rows) for i, d in enumerate(done)], "release int, shards long, written long, rows long")


_KEPT = "SELECT c_custkey AS id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)"


@query(
    "K3_graph_tree",
    f"""WITH k AS ({_KEPT}), o AS (SELECT * FROM orders WHERE o_custkey IN (FROM k)),
    s AS (SELECT 'nodes' AS "table", CAST(c_nationkey AS VARCHAR) AS shard FROM customer WHERE c_custkey IN (FROM k)
      UNION ALL SELECT 'edges', CAST(o_orderkey // 5000 AS VARCHAR) FROM (SELECT DISTINCT o_orderkey, o_custkey FROM o WHERE o_orderstatus = 'F')
      UNION ALL SELECT 'evidence', CAST(o_orderkey // 5000 AS VARCHAR) FROM o WHERE o_totalprice > 300000)
    SELECT "table", shard, count(*) AS rows FROM s GROUP BY 1, 2""",
)
def k3_tree(t: Tables) -> DataFrame:
    """The graph as a release: customers that have both participants (orders that are done) and evidence (dear ones) are its
    nodes; edges and evidence go with them, each table in shards of its own."""
    link = lambda c: t.orders.where(c).select(F.col("o_custkey").alias("id"))
    kept = graphs.written(graphs.pruned(t.customer.select(F.col("c_custkey").alias("id")), {"participants": link("o_orderstatus = 'F'"), "evidence": link("o_totalprice > 300000")}))
    nodes = t.customer.join(kept, F.col("c_custkey") == F.col("id"), "left_semi").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("label"), F.col("c_nationkey").alias("shard"))
    rows = t.orders.join(kept, F.col("o_custkey") == F.col("id"), "left_semi").withColumn("shard", F.expr("o_orderkey div 5000"))
    edges = rows.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("node"), F.col("o_orderkey").alias("event"), "shard").distinct()
    evidence = rows.where("o_totalprice > 300000").select(F.col("o_orderkey").alias("event"), F.col("o_totalprice").alias("price"), "shard")
    releases = Releases(t.spark, f"{shared_folder(t.spark)}/releases-{uuid.uuid4().hex}")
    releases.publish({"nodes": (nodes, "shard"), "edges": (edges, "shard"), "evidence": (evidence, "shard")})
    return releases.manifest().select("table", "shard", "rows")


@query("K3_graph_release", "SELECT n_regionkey AS r, string_agg(n_name, ',' ORDER BY n_name) AS names, CAST(count(*) AS BIGINT) AS n FROM nation GROUP BY 1")
def k3(t: Tables) -> DataFrame:
    return t.nation.groupBy(F.col("n_regionkey").alias("r")).agg(F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("names"), F.count("*").alias("n"))


@query(
    "K6_score_shards",
    "SELECT lpad(CAST(n // 100 AS VARCHAR), 4, '0') || '-' || substr(sha256(string_agg(CAST(o_orderkey AS VARCHAR), ',' "
    "ORDER BY o_orderkey)), 1, 16) AS id, CAST(count(*) AS BIGINT) AS rows "
    "FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM orders) GROUP BY n // 100",
)
def k6(t: Tables) -> DataFrame:
    rows = sinks.numbered_shards(t.orders.select("o_orderkey", F.lit("all").alias("lot")), ["o_orderkey"], 100, "lot")
    g = rows.groupBy("shard").agg(F.count("*").alias("rows"), F.array_sort(F.collect_list("o_orderkey")).alias("ids"))
    digest = F.sha2(F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").cast("binary"), 256)
    return g.select(F.concat(F.lpad(F.col("shard").cast("string"), 4, "0"), F.lit("-"), F.substring(digest, 1, 16)).alias("id"), "rows")


@query(
    "K8_postings_index",
    f"""WITH d AS (SELECT 'd' || doc_id AS id, text FROM documents UNION ALL SELECT 'c' || conv_id || '.' || turn, text FROM conversations)
    SELECT substr(term, 1, 1) AS bucket, CAST(count(*) AS BIGINT) AS postings, CAST(sum(tf) AS BIGINT) AS hits
    FROM (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({TOKENS}) AS term FROM d) GROUP BY 1, 2) GROUP BY 1""",
)
def k8(t: Tables) -> DataFrame:
    """Postings of all documents and turns, by the term's first letter."""
    rows = t.documents.select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    rows = rows.union(t.conversations.select(F.concat(F.lit("c"), "conv_id", F.lit("."), "turn"), "text"))
    return fulltext.postings(rows, "id", "text").groupBy(F.substring("term", 1, 1).alias("bucket")).agg(F.count("*").alias("postings"), F.sum("tf").alias("hits"))
