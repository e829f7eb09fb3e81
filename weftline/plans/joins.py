"""J*, U*: joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators import intervals, vectors
from weftline.plans.registry import Tables, query


@query(
    "J1_inner_multi_key",
    "SELECT a.l_orderkey, a.l_linenumber, a.l_partkey, b.l_suppkey FROM lineitem a "
    "JOIN (SELECT l_orderkey, l_linenumber, max(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1, 2) b "
    "ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber WHERE a.l_quantity > 45",
)
def j1(t: Tables) -> DataFrame:
    top = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_suppkey").alias("l_suppkey"))
    return t.lineitem.where("l_quantity > 45").select("l_orderkey", "l_linenumber", "l_partkey").join(top, ["l_orderkey", "l_linenumber"])


@query(
    "J2_five_way_chain",
    "SELECT r_name, n_name, CAST(count(*) AS BIGINT) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2",
)
def j2(t: Tables) -> DataFrame:
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    j = j.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name", "n_name").agg(F.count("*").alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query(
    "J3_computed_key",
    "SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON replace(c_name, 'Customer', 'map') = 'map#' || split_part(s_name, '#', "
    "2)",
)
def j3(t: Tables) -> DataFrame:
    a = t.customer.select("c_custkey", F.replace("c_name", F.lit("Customer"), F.lit("map")).alias("key"))
    b = t.supplier.select("s_suppkey", F.concat(F.lit("map#"), F.split_part("s_name", F.lit("#"), F.lit(2))).alias("key"))
    return a.join(b, "key").select("c_custkey", "s_suppkey")


@query(
    "J4_left_default",
    "SELECT c_custkey, coalesce(s, 'active') AS state FROM customer LEFT "
    "JOIN (SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS s FROM orders WHERE o_orderpriority = '1-URGENT' "
    "GROUP BY 1) ON c_custkey = o_custkey",
)
def j4(t: Tables) -> DataFrame:
    now = t.orders.where("o_orderpriority = '1-URGENT'").groupBy("o_custkey").agg(F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("s"))
    return t.customer.join(now, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("s", F.lit("active")).alias("state"))


_DRIFT = "SELECT l_partkey AS k, 'left' AS side FROM lineitem WHERE l_quantity > 48 EXCEPT SELECT l_partkey, 'left' FROM lineitem WHERE l_quantity < 3"


@query(
    "J5_U6_symmetric_difference",
    f"({_DRIFT}) UNION ALL (SELECT l_partkey AS k, 'right' AS side FROM lineitem WHERE l_quantity < 3 EXCEPT SELECT l_partkey, 'right' "
    f"FROM lineitem WHERE l_quantity > 48)",
)
def j5(t: Tables) -> DataFrame:
    a = t.lineitem.where("l_quantity > 48").select(F.col("l_partkey").alias("k")).distinct()
    b = t.lineitem.where("l_quantity < 3").select(F.col("l_partkey").alias("k")).distinct()
    return a.join(b, "k", "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, "k", "left_anti").withColumn("side", F.lit("right")))


@query(
    "J6_semi",
    "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders "
    "WHERE o_custkey = c_custkey AND o_orderstatus <> 'F' AND o_totalprice > 400000)",
)
def j6(t: Tables) -> DataFrame:
    good = t.orders.where("o_orderstatus <> 'F' and o_totalprice > 400000")
    return t.customer.join(good, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey", "c_name")


@query("J7_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
def j7(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.where("o_totalprice > 450000"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query(
    "J8_only_in_group",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n "
    "FROM lineitem) WHERE n = 1",
)
def j8(t: Tables) -> DataFrame:
    n = F.count("*").over(Window.partitionBy("l_orderkey", "l_linenumber"))
    return t.lineitem.withColumn("n", n).where("n = 1").select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "J10_self_equi",
    "SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b "
    "ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey",
)
def j10(t: Tables) -> DataFrame:
    a, b = t.nation.alias("a"), t.nation.alias("b")
    return a.join(b, (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") < F.col("b.n_nationkey"))).select(F.col("a.n_nationkey").alias("a"), F.col("b.n_nationkey").alias("b"))


_SPANS = (
    "SELECT o_custkey AS k, CAST(o_orderkey AS BIGINT) AS span, epoch(o_orderdate)::BIGINT // 86400 AS a, epoch(o_orderdate)::BIGINT "
    "// 86400 + 120 AS b FROM orders"
)


def spans(t: Tables) -> DataFrame:
    day = F.expr("unix_seconds(cast(o_orderdate as timestamp)) div 86400")
    return t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("span"), day.alias("a"), (day + 120).alias("b"))


@query(
    "J13_containment",
    f"SELECT s.k, s.span, p.span AS inside, (p.a - s.a) * 2 AS scaled FROM ({_SPANS}) s JOIN (SELECT k, span, a + 5 AS a, a + 40 AS b "
    f"FROM ({_SPANS})) p ON s.k = p.k AND s.a <= p.a AND s.b >= p.b",
)
def j13(t: Tables) -> DataFrame:
    inner = spans(t).select("k", F.col("span").alias("inside"), (F.col("a") + 5).alias("pa"), (F.col("a") + 40).alias("pb"))
    return intervals.contained(spans(t), inner, "k", ("a", "b"), ("pa", "pb"), width=120).select("k", "span", "inside", ((F.col("pa") - F.col("a")) * 2).alias("scaled"))


@query(
    "J14_proximity_merge",
    """WITH RECURSIVE s AS (SELECT user_id AS key, epoch_us(ts) // 1000 AS "at", row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id) AS i FROM events),
    r AS (SELECT key, "at", i, "at" AS first FROM s WHERE i = 1
    UNION ALL SELECT s.key, s."at", s.i, CASE WHEN s."at" - r.first < 7200000 THEN r.first ELSE s."at" END FROM r JOIN s ON s.key = r.key AND s.i = r.i + 1)
    SELECT key, first, CAST(count(*) AS BIGINT) AS n, max("at") AS last FROM r GROUP BY 1, 2""",
)
def j14(t: Tables) -> DataFrame:
    """Points of each user in time order; one within two hours of the last accepted point merges into it."""
    e = t.events.select("user_id", F.expr("unix_millis(cast(ts as timestamp))").alias("at"), "event_id")
    return intervals.merge_near(e, "user_id", "at", "event_id", 7_200_000)


@query(
    "J15_covered_length",
    f"SELECT s.k, s.span, CAST(sum(greatest(0, least(s.b, r.b) - greatest(s.a, r.a))) AS BIGINT) AS covered FROM ({_SPANS}) s "
    f"JOIN (SELECT k, a + 30 AS a, a + 50 AS b FROM ({_SPANS}) WHERE span % 3 = 0) r ON s.k = r.k AND r.a < s.b AND r.b > s.a "
    f"GROUP BY 1, 2",
)
def j15(t: Tables) -> DataFrame:
    ranges = spans(t).where("span % 3 = 0").select("k", (F.col("a") + 30).alias("ra"), (F.col("a") + 50).alias("rb"))
    return intervals.covered(spans(t), ranges, ["k", "span"], "k", ("a", "b"), ("ra", "rb"), width=120)


@query(
    "J16_hamming",
    "SELECT a.vec_id AS a, b.vec_id AS b, CAST(bit_count(xor(a.h, b.h)) AS INT) AS distance "
    "FROM (SELECT vec_id, label, list_sum([CASE WHEN embedding[i] > 0 THEN 1::BIGINT << (i - 1) ELSE 0 END FOR i IN range(1, "
    "33)])::BIGINT AS h FROM embeddings) a JOIN (SELECT vec_id, label, list_sum([CASE WHEN embedding[i] > 0 THEN 1::BIGINT << (i - 1) "
    "ELSE 0 END FOR i IN range(1, 33)])::BIGINT AS h FROM embeddings) b ON a.label = b.label AND a.vec_id < b.vec_id "
    "WHERE bit_count(xor(a.h, b.h)) <= 8",
)
def j16(t: Tables) -> DataFrame:
    """Pairs of one class within 8 bits of each other's 32-bit sign hash, met in bands of bits: an exact pigeonhole join."""
    return vectors.hamming_pairs(vectors.sign_hash(t.embeddings, "embedding", 32), "vec_id", "label", "h", 32, 8)


_UNIT = "SELECT vec_id, label, [x / sqrt(list_sum([y * y FOR y IN v])) FOR x IN v] AS v FROM (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"


@query(
    "J17_top_neighbours",
    f"SELECT a, b, round(s, 5) AS similarity FROM (SELECT a.vec_id AS a, b.vec_id AS b, list_dot_product(a.v, b.v) AS s, row_number() "
    f"OVER (PARTITION BY a.vec_id ORDER BY list_dot_product(a.v, b.v) DESC, b.vec_id) AS n FROM ({_UNIT}) a JOIN ({_UNIT}) b ON true "
    f"WHERE a.vec_id % 50 = 0) WHERE n <= 32 AND a <> b",
)
def j17(t: Tables) -> DataFrame:
    """The 32 nearest rows, itself included, of every vector whose id divides by 50, against all rows in reach."""
    return vectors.top_neighbours(t.embeddings, t.embeddings.where("vec_id % 50 = 0"), "vec_id", "embedding", 32).where("a <> b").select("a", "b", F.round("similarity", 5).alias("similarity"))


@query(
    "J18_lookup",
    "SELECT o_orderkey, n_name, coalesce(s_name, '-') AS s_name FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation "
    "ON c_nationkey = n_nationkey LEFT JOIN supplier ON s_suppkey = o_custkey WHERE o_totalprice > 300000",
)
def j18(t: Tables) -> DataFrame:
    o = t.orders.where("o_totalprice > 300000").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return o.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t.supplier, F.col("s_suppkey") == F.col("o_custkey"), "left").select("o_orderkey", "n_name", F.coalesce("s_name", F.lit("-")).alias("s_name"))


@query(
    "J19_backward_index",
    "SELECT l_partkey, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n, string_agg(DISTINCT CAST(l_orderkey AS VARCHAR), ',' "
    "ORDER BY CAST(l_orderkey AS VARCHAR)) AS orders FROM lineitem GROUP BY 1",
)
def j19(t: Tables) -> DataFrame:
    found = F.array_sort(F.collect_set(F.col("l_orderkey").cast("string")))
    return t.lineitem.groupBy("l_partkey").agg(F.countDistinct("l_orderkey").alias("n"), F.array_join(found, ",").alias("orders"))


@query(
    "J20_unique_resolution",
    "SELECT s_suppkey, CASE WHEN count(DISTINCT c_custkey) = 0 THEN 'none' WHEN count(DISTINCT c_custkey) = 1 THEN 'unique' ELSE "
    "'ambiguous' END AS state, CASE WHEN count(DISTINCT c_custkey) = 1 THEN min(c_custkey) END AS c_custkey FROM supplier LEFT "
    "JOIN (SELECT * FROM customer WHERE c_acctbal > 8000) ON c_nationkey = s_nationkey AND c_custkey % 10 = s_suppkey % 10 GROUP BY 1",
)
def j20(t: Tables) -> DataFrame:
    c = t.customer.where("c_acctbal > 8000").select("c_custkey", F.col("c_nationkey").alias("s_nationkey"), (F.col("c_custkey") % 10).alias("d"))
    g = t.supplier.withColumn("d", F.col("s_suppkey") % 10).join(c, ["s_nationkey", "d"], "left").groupBy("s_suppkey").agg(F.countDistinct("c_custkey").alias("n"), F.min("c_custkey").alias("m"))
    return g.select("s_suppkey", F.when(F.col("n") == 0, "none").when(F.col("n") == 1, "unique").otherwise("ambiguous").alias("state"), F.when(F.col("n") == 1, F.col("m")).alias("c_custkey"))


@query(
    "J21_first_against_rest",
    "SELECT a.k, a.first AS first, o.o_orderkey AS other FROM (SELECT o_custkey AS k, min(o_orderkey) AS first FROM orders "
    "GROUP BY 1) a JOIN orders o ON o.o_custkey = a.k AND o.o_orderkey > a.first",
)
def j21(t: Tables) -> DataFrame:
    first = F.min("o_orderkey").over(Window.partitionBy("o_custkey"))
    return t.orders.select(F.col("o_custkey").alias("k"), first.alias("first"), F.col("o_orderkey").alias("other")).where("other > first")


@query(
    "J22_shared_sets",
    """WITH u AS (SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM events WHERE value > 100 GROUP BY 1),
    s AS (SELECT kinds, CAST(count(*) AS BIGINT) AS users, min(user_id) AS first FROM u GROUP BY 1)
    SELECT a.kinds AS a, b.kinds AS b, CAST(len(list_intersect(string_split(a.kinds, ','), string_split(b.kinds, ','))) AS INT) AS shared,
           CASE WHEN a.kinds = b.kinds THEN a.users * (a.users - 1) // 2 ELSE a.users * b.users END AS pairs
    FROM s a JOIN s b ON a.kinds <= b.kinds AND list_has_any(string_split(a.kinds, ','), string_split(b.kinds, ','))""",
)
def j22(t: Tables) -> DataFrame:
    """Users with a kind in common: pairs of their distinct kind sets, of which there are few, and how many users' pairs each stands for.

    J22_members has the users of every set. No pair of users is written out.
    """
    s = kind_sets(t).groupBy("kinds").agg(F.count("*").alias("users")).withColumn("kind", F.explode(F.split("kinds", ",")))
    a, b = s.alias("a"), s.alias("b")
    pairs = a.join(b, (F.col("a.kind") == F.col("b.kind")) & (F.col("a.kinds") <= F.col("b.kinds")))
    pairs = pairs.groupBy(F.col("a.kinds").alias("a"), F.col("b.kinds").alias("b"), F.col("a.users").alias("n"), F.col("b.users").alias("m")).agg(F.count("*").cast("int").alias("shared"))
    return pairs.select("a", "b", "shared", F.when(F.col("a") == F.col("b"), F.expr("n * (n - 1) div 2")).otherwise(F.col("n") * F.col("m")).alias("pairs"))


def kind_sets(t: Tables) -> DataFrame:
    found = t.events.where("value > 100").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("kinds"))
    return found.select("user_id", F.array_join("kinds", ",").alias("kinds"))


@query("J22_members", "SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM events WHERE value > 100 GROUP BY 1")
def j22_members(t: Tables) -> DataFrame:
    return kind_sets(t)


@query(
    "J23_topic_mask",
    "SELECT o_orderkey, o_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 490000) AS member FROM orders "
    "WHERE o_orderstatus = 'P'",
)
def j23(t: Tables) -> DataFrame:
    topic = t.orders.where("o_totalprice > 490000").select("o_custkey").distinct().withColumn("member", F.lit(True))
    return t.orders.where("o_orderstatus = 'P'").join(topic, "o_custkey", "left").select("o_orderkey", F.coalesce("member", F.lit(False)).alias("member"))


@query(
    "J24_release_binding",
    "SELECT a.l_orderkey, a.l_partkey, a.l_suppkey, a.l_linenumber FROM lineitem a "
    "WHERE (a.l_orderkey, a.l_partkey, a.l_suppkey, a.l_linenumber) NOT IN (SELECT l_orderkey, l_partkey, "
    "l_suppkey, l_linenumber FROM lineitem WHERE l_discount > 0.02)",
)
def j24(t: Tables) -> DataFrame:
    """Rows whose four identity keys match no current row: stale, to be rejected."""
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return t.lineitem.select(*keys).join(t.lineitem.where("l_discount > 0.02").select(*keys), keys, "left_anti")


@query("U1_union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier UNION SELECT n_nationkey FROM nation")
def u1(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey")).union(t.nation.select("n_nationkey")).distinct()


@query("U2_union_all", "SELECT o_orderdate AS at, 'order' AS kind FROM orders UNION ALL SELECT l_shipdate, 'ship' FROM lineitem WHERE l_quantity = 50")
def u2(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderdate").alias("at"), F.lit("order").alias("kind")).union(t.lineitem.where("l_quantity = 50").select("l_shipdate", F.lit("ship")))


@query(
    "U4_set_identities",
    "SELECT 'both' AS side, count(*)::BIGINT AS n FROM (SELECT l_partkey FROM lineitem WHERE l_tax = 0 INTERSECT SELECT l_partkey "
    "FROM lineitem WHERE l_discount = 0) UNION ALL SELECT 'missing', count(*)::BIGINT FROM (SELECT p_partkey FROM part EXCEPT "
    "SELECT l_partkey FROM lineitem WHERE l_tax = 0)",
)
def u4(t: Tables) -> DataFrame:
    free = t.lineitem.where("l_tax = 0").select("l_partkey")
    both = free.intersect(t.lineitem.where("l_discount = 0").select("l_partkey")).agg(F.count("*").alias("n")).select(F.lit("both").alias("side"), "n")
    return both.unionByName(t.part.select("p_partkey").subtract(free).agg(F.count("*").alias("n")).select(F.lit("missing").alias("side"), "n"))
