"""A*: aggregations. Passages are lineitem joined to orders: recording = order, kind = l_linestatus, subject = l_returnflag."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators import statistics as st
from weftline.operators import ranks
from weftline.plans.registry import Tables, query

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels", "conversations", "embeddings")


@query("A1_table_counts", " UNION ALL ".join(f"SELECT '{n}' AS relation, CAST(count(*) AS BIGINT) AS n FROM {n}" for n in _TABLES))
def a1(t: Tables) -> DataFrame:
    counts = [getattr(t, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("relation"), "n") for n in _TABLES]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query(
    "A2_grouped_counts",
    "SELECT o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n, o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS "
    "known FROM orders GROUP BY 1, 2",
)
def a2(t: Tables) -> DataFrame:
    vocabulary = t.spark.createDataFrame([("1-URGENT",), ("2-HIGH",), ("3-MEDIUM",)], "o_orderpriority string").withColumn("known", F.lit(True))
    counts = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(vocabulary), "o_orderpriority", "left").select("o_orderstatus", "o_orderpriority", "n", F.coalesce("known", F.lit(False)).alias("known"))


@query(
    "A3_distinct_coverage",
    "SELECT l_returnflag, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n_orders, CAST(count(DISTINCT l_partkey) AS BIGINT) AS n_parts "
    "FROM lineitem GROUP BY 1",
)
def a3(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_orderkey").alias("n_orders"), F.countDistinct("l_partkey").alias("n_parts"))


@query("A4_distinct_over_union", "SELECT CAST(count(*) AS BIGINT) AS n FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier)")
def a4(t: Tables) -> DataFrame:
    return t.customer.select("c_nationkey").union(t.supplier.select("s_nationkey")).agg(F.countDistinct("c_nationkey").alias("n"))


@query(
    "A5_filtered_sums",
    "SELECT l_linestatus, coalesce(round(sum(l_quantity) FILTER (l_discount > 0.05), 2), 0) AS qty, CAST(count(*) FILTER (l_tax = 0) "
    "AS BIGINT) AS untaxed, coalesce(sum(l_quantity) FILTER (l_discount > 5), 0) AS none FROM lineitem GROUP BY 1",
)
def a5(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_linestatus").agg(
        F.coalesce(F.round(F.sum(F.when(F.col("l_discount") > 0.05, F.col("l_quantity"))), 2), F.lit(0.0)).alias("qty"), F.count_if(F.col("l_tax") == 0).alias("untaxed"), F.coalesce(F.sum(F.when(F.col("l_discount") > 5, F.col("l_quantity"))), F.lit(0.0)).alias("none")
    )


@query("A6_having_gates", "SELECT user_id FROM events WHERE value > 60 GROUP BY 1 HAVING count(DISTINCT event_type) = 5")
def a6(t: Tables) -> DataFrame:
    return t.events.where("value > 60").groupBy("user_id").agg(F.countDistinct("event_type").alias("n")).where("n = 5").select("user_id")


_KINDS = ("click", "error", "purchase", "signup", "view")


@query("A7_pivot", "SELECT user_id, " + ", ".join(f"max(CASE WHEN event_type = '{k}' THEN value END) AS \"{k}\"" for k in _KINDS) + " FROM events GROUP BY 1")
def a7(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").pivot("event_type", list(_KINDS)).agg(F.max("value"))


_SEVERITY = {"view": 0, "click": 1, "signup": 2, "purchase": 3, "error": 4}


@query("A8_severity_max", "SELECT user_id, date_trunc('day', ts) AS day, arg_max(event_type, CASE event_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _SEVERITY.items()) + " END) AS worst FROM events GROUP BY 1, 2")
def a8(t: Tables) -> DataFrame:
    rank = F.create_map(*[F.lit(x) for kv in _SEVERITY.items() for x in kv])
    back = F.create_map(*[F.lit(x) for k, v in _SEVERITY.items() for x in (v, k)])
    return t.events.groupBy("user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.max(rank[F.col("event_type")]).alias("r")).select("user_id", "day", back[F.col("r")].alias("worst"))


@query(
    "A9_ordinal_consistency",
    "SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n, min(l_linenumber) AS lo, max(l_linenumber) AS hi, CAST(count(DISTINCT l_linenumber) AS BIGINT) AS d, CAST(sum(CAST(l_returnflag = 'R' AS INT)) AS BIGINT) AS returned FROM lineitem GROUP BY 1 HAVING min(l_linenumber) <> 1 OR max(l_linenumber) <> count(*) OR count(DISTINCT l_linenumber) <> count(*)",
)
def a9(t: Tables) -> DataFrame:
    g = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.min("l_linenumber").alias("lo"), F.max("l_linenumber").alias("hi"), F.countDistinct("l_linenumber").alias("d"), F.count_if(F.col("l_returnflag") == "R").alias("returned"))
    return g.where("lo <> 1 or hi <> n or d <> n")


@query(
    "A10_release_stats",
    "SELECT CAST(count(*) AS BIGINT) AS recordings, CAST(sum(segments) AS BIGINT) AS segments, CAST(count(*) FILTER (segments > 4) AS BIGINT) AS long, round(avg(segments), 6) AS mean_segments FROM (SELECT o_orderkey, count(l_orderkey) AS segments FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)",
)
def a10(t: Tables) -> DataFrame:
    """Counts over the nested release: recordings with their segments as an array."""
    segments = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_partkey")).alias("segments"))
    nested = t.orders.join(segments, F.col("l_orderkey") == F.col("o_orderkey"), "left").select("o_orderkey", F.coalesce(F.size("segments"), F.lit(0)).alias("n"))
    nested = nested.withColumn("n", F.greatest("n", F.lit(0)))
    return nested.agg(F.count("*").alias("recordings"), F.sum("n").cast("long").alias("segments"), F.count_if(F.col("n") > 4).alias("long"), F.round(F.avg("n"), 6).alias("mean_segments"))


@query(
    "A11_facets",
    """SELECT 'priority' AS facet, string_agg(v, '|' ORDER BY v) AS facet_values FROM (SELECT DISTINCT coalesce(o_orderpriority, 'Unknown') AS v FROM orders WHERE o_orderstatus <> 'F')
    UNION ALL SELECT 'year', string_agg(CAST(v AS VARCHAR), '|' ORDER BY v DESC) FROM (SELECT DISTINCT year(o_orderdate) AS v FROM orders WHERE o_orderstatus <> 'F')""",
)
def a11(t: Tables) -> DataFrame:
    o = t.orders.where("o_orderstatus <> 'F'")
    one = o.agg(F.array_sort(F.collect_set(F.coalesce("o_orderpriority", F.lit("Unknown")))).alias("p"), F.sort_array(F.collect_set(F.year("o_orderdate")), asc=False).alias("y"))
    return one.select(F.explode(F.array(F.struct(F.lit("priority").alias("facet"), F.array_join("p", "|").alias("facet_values")), F.struct(F.lit("year").alias("facet"), F.array_join(F.transform("y", lambda x: x.cast("string")), "|").alias("facet_values")))).alias("x")).select("x.*")


@query(
    "A12_shard_rollup",
    "SELECT o_custkey // 100 AS shard, CAST(count(*) AS BIGINT) AS n, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_id, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_id FROM orders GROUP BY 1",
)
def a12(t: Tables) -> DataFrame:
    at = F.struct("o_orderdate", "o_orderkey")
    return t.orders.groupBy(F.expr("o_custkey div 100").alias("shard")).agg(F.count("*").alias("n"), F.min_by("o_orderkey", at).alias("first_id"), F.max_by("o_orderkey", at).alias("last_id"))


@query(
    "A13_time_series",
    """SELECT period, CAST(count(*) AS BIGINT) AS n, round(avg(v), 6) AS mean, CASE WHEN count(*) >= 5 THEN round(avg(v) - 1.96 * stddev_samp(v) / sqrt(count(*)), 6) END AS ci_low,
    CASE WHEN count(*) >= 5 THEN round(avg(v) + 1.96 * stddev_samp(v) / sqrt(count(*)), 6) END AS ci_high, CASE WHEN count(low) = count(*) THEN round(avg(low), 6) END AS low, CASE WHEN count(high) = count(*) THEN round(avg(high), 6) END AS high, round(avg(coverage), 6) AS coverage
    FROM (SELECT year(o_orderdate) AS period, o_totalprice / 1000 AS v, o_totalprice / 1100 AS low, CASE WHEN o_orderstatus <> 'P' OR year(o_orderdate) > 1996 THEN o_totalprice / 900 END AS high, CASE WHEN o_orderpriority = '5-LOW' THEN 0.5 ELSE 0.9 END AS coverage FROM orders) GROUP BY 1""",
)
def a13(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    o = t.orders.select("o_orderdate", (price / 1000).alias("v"), (price / 1100).alias("low"), F.when((F.col("o_orderstatus") != "P") | (F.year("o_orderdate") > 1996), price / 900).alias("high"), F.when(F.col("o_orderpriority") == "5-LOW", 0.5).otherwise(0.9).alias("c"))
    return st.time_series(o, F.year("o_orderdate"), "v", "low", "high", F.col("c"))


@query(
    "A14_mean_interval",
    "SELECT o_custkey, CAST(count(*) AS BIGINT) AS n, CASE WHEN count(*) >= 5 THEN round(avg(o_totalprice) - 1.96 * "
    "stddev_samp(o_totalprice) / sqrt(count(*)), 4) END AS lo, CASE WHEN count(*) >= 5 THEN round(avg(o_totalprice) + 1.96 * "
    "stddev_samp(o_totalprice) / sqrt(count(*)), 4) END AS hi FROM orders GROUP BY 1",
)
def a14(t: Tables) -> DataFrame:
    g = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("m"), F.stddev_samp("o_totalprice").alias("s"))
    lo, hi = st.mean_interval(F.col("m"), F.col("s"), F.col("n"))
    return g.select("o_custkey", "n", F.round(lo, 4).alias("lo"), F.round(hi, 4).alias("hi"))


def passages(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("recording"), F.col("l_linestatus").alias("kind"), F.year("l_shipdate").alias("year"), F.when(F.col("l_tax") > 0, F.col("l_returnflag")).alias("subject"), F.col("l_linenumber").alias("place"), F.col("l_partkey").alias("part"), F.col("l_quantity").alias("dim0"), (F.col("l_discount") * 100).alias("dim1")
    )


P = (
    "(SELECT l_orderkey AS recording, l_linestatus AS kind, year(l_shipdate) AS year, "
    "CASE WHEN l_tax > 0 THEN l_returnflag END AS subject, l_linenumber AS place, l_partkey AS part, l_quantity AS dim0, l_discount * "
    "100 AS dim1 FROM lineitem)"
)


@query(
    "A15_subject_shares",
    f"SELECT kind, year, subject, CAST(n AS BIGINT) AS n, CAST(total AS BIGINT) AS total, round(n / total, 6) AS share "
    f"FROM (SELECT *, sum(n) OVER (PARTITION BY kind, year) AS total FROM (SELECT kind, year, subject, count(*) AS n FROM {P} "
    f"WHERE subject IS NOT NULL GROUP BY 1, 2, 3)) WHERE total >= 30",
)
def a15(t: Tables) -> DataFrame:
    return st.shares(passages(t), ["kind", "year"], "subject", 30)


@query(
    "A16_subject_profile",
    f"SELECT kind, subject, CAST(s.n AS BIGINT) AS n, round(s.m - o.m, 6) AS difference "
    f"FROM (SELECT kind, subject, count(*) AS n, avg(dim0) AS m FROM {P} WHERE subject IS NOT NULL GROUP BY 1, 2 "
    f"HAVING count(*) >= 30) s JOIN (SELECT kind, avg(dim0) AS m FROM {P} GROUP BY 1) o USING (kind)",
)
def a16(t: Tables) -> DataFrame:
    cells = passages(t).groupBy("kind", "subject").agg(F.count("*").alias("n"), F.sum("dim0").alias("s"))
    w = Window.partitionBy("kind")
    overall = F.sum("s").over(w) / F.sum("n").over(w)
    return cells.withColumn("overall", overall).where("subject is not null and n >= 30").select("kind", "subject", "n", F.round(F.col("s") / F.col("n") - F.col("overall"), 6).alias("difference"))


@query(
    "A17_held_constant_trend",
    f"""WITH r AS (SELECT * FROM {P} WHERE subject IS NOT NULL), c AS (SELECT year, subject, count(*) AS n, avg(dim0) AS m FROM r GROUP BY 1, 2), w AS (SELECT subject, count(*) / (SELECT count(*) FROM r) AS w FROM r GROUP BY 1)
    SELECT year, CAST(sum(n) AS BIGINT) AS n, round(sum(n * m) / sum(n), 6) AS observed, CASE WHEN sum(n) >= 30 AND sum(w) FILTER (n >= 5) >= 0.5 THEN round(sum(w * m) FILTER (n >= 5) / sum(w) FILTER (n >= 5), 6) END AS standardised FROM c JOIN w USING (subject) GROUP BY 1""",
)
def a17(t: Tables) -> DataFrame:
    return st.standardised(passages(t), "year", "subject", "dim0", 30)


@query(
    "A18_within_contrast",
    f"""WITH r AS (SELECT recording, avg(dim0) FILTER (part % 2 = 0) AS inside, avg(dim0) FILTER (part % 2 = 1) AS outside FROM {P} GROUP BY 1), d AS (SELECT inside - outside AS d FROM r WHERE inside IS NOT NULL AND outside IS NOT NULL)
    SELECT CAST(count(*) AS BIGINT) AS recordings, round(avg(d), 6) AS within, round(1.96 * stddev_samp(d) / sqrt(count(*)), 6) AS half, (SELECT round(avg(dim0) FILTER (part % 2 = 0) - avg(dim0) FILTER (part % 2 = 1), 6) FROM {P}) AS across FROM d""",
)
def a18(t: Tables) -> DataFrame:
    inside, outside = F.col("part") % 2 == 0, F.col("part") % 2 == 1
    per = passages(t).groupBy("recording").agg(*[f(F.when(m, F.col("dim0"))).alias(f"{n}_{k}") for k, m in (("in", inside), ("out", outside)) for n, f in (("s", F.sum), ("c", F.count))])
    d = F.when((F.col("c_in") > 0) & (F.col("c_out") > 0), F.try_divide("s_in", "c_in") - F.try_divide("s_out", "c_out"))
    out = per.withColumn("d", d).agg(F.count("d").alias("recordings"), F.avg("d").alias("m"), F.stddev_samp("d").alias("s"), *[F.sum(c).alias(c) for c in ("s_in", "c_in", "s_out", "c_out")])
    return out.select("recordings", F.round("m", 6).alias("within"), F.round(1.96 * F.col("s") / F.sqrt("recordings"), 6).alias("half"), F.round(F.col("s_in") / F.col("c_in") - F.col("s_out") / F.col("c_out"), 6).alias("across"))


@query(
    "A19_recording_spread",
    f"SELECT recording, CAST(count(*) AS BIGINT) AS n, round(avg(dim0), 6) AS mean, round(stddev_samp(dim0), 6) AS sd FROM {P} "
    f"GROUP BY 1",
)
def a19(t: Tables) -> DataFrame:
    return passages(t).groupBy("recording").agg(F.count("*").alias("n"), F.round(F.avg("dim0"), 6).alias("mean"), F.round(F.stddev_samp("dim0"), 6).alias("sd"))


@query(
    "A20_year_axis",
    f"SELECT y AS year, CAST(count(p.year) AS BIGINT) AS n FROM (SELECT unnest(range(min(year), max(year) + 1)) AS y FROM {P} "
    f"WHERE dim0 > 10) LEFT JOIN (SELECT * FROM {P} WHERE dim0 > 49) p ON p.year = y GROUP BY 1",
)
def a20(t: Tables) -> DataFrame:
    p = passages(t)
    axis = p.where("dim0 > 10").agg(F.min("year").alias("a"), F.max("year").alias("b")).select(F.explode(F.sequence(F.col("a").cast("long"), F.col("b").cast("long"))).alias("year"))
    counts = p.where("dim0 > 49").groupBy(F.col("year").cast("long").alias("year")).agg(F.count("*").alias("n"))
    return axis.join(counts, "year", "left").select("year", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "A21_two_sample_effect",
    "SELECT o_orderpriority, round(m2 - m1, 4) AS difference, round((m2 - m1) / sqrt(((n1 - 1) * s1 * s1 + (n2 - 1) * s2 * s2) / (n1 + "
    "n2 - 2)), 6) AS effect FROM (SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS n1, count(*) FILTER (o_orderstatus "
    "= 'O') AS n2, avg(o_totalprice) FILTER (o_orderstatus = 'F') AS m1, avg(o_totalprice) FILTER (o_orderstatus = 'O') AS m2, "
    "stddev_samp(o_totalprice) FILTER (o_orderstatus = 'F') AS s1, stddev_samp(o_totalprice) FILTER (o_orderstatus = 'O') AS s2 "
    "FROM orders GROUP BY 1)",
)
def a21(t: Tables) -> DataFrame:
    part = {k: F.when(F.col("o_orderstatus") == v, F.col("o_totalprice")) for k, v in (("1", "F"), ("2", "O"))}
    g = t.orders.groupBy("o_orderpriority").agg(*[f(c).alias(n + k) for k, c in part.items() for n, f in (("n", F.count), ("m", F.avg), ("s", F.stddev_samp))])
    c = F.col
    return g.select("o_orderpriority", F.round(c("m2") - c("m1"), 4).alias("difference"), F.round(st.effect(c("n1"), c("m1"), c("s1"), c("n2"), c("m2"), c("s2")), 6).alias("effect"))


@query("A22_distribution", "SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS sd, " + ", ".join(f"round(quantile_cont(l_extendedprice, {q}), 4) AS {k}" for k, q in (("p10", 0.1), ("q25", 0.25), ("median", 0.5), ("q75", 0.75), ("p90", 0.9))) + " FROM lineitem GROUP BY 1")
def a22(t: Tables) -> DataFrame:
    moments = t.lineitem.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.avg("l_extendedprice"), 4).alias("mean"), F.round(F.stddev_samp("l_extendedprice"), 4).alias("sd"))
    shares = {"p10": 0.1, "q25": 0.25, "median": 0.5, "q75": 0.75, "p90": 0.9}
    found = ranks.quantiles(t.lineitem, "l_returnflag", "l_extendedprice", shares)
    return moments.join(found.select("l_returnflag", *[F.round(k, 4).alias(k) for k in shares]), "l_returnflag")


@query(
    "A23_genre_standardised",
    """WITH r AS (SELECT year(o_orderdate) AS year, o_orderpriority AS genre, o_totalprice / 1000 AS v FROM orders), c AS (SELECT year, genre, count(*) AS n, avg(v) AS m FROM r GROUP BY 1, 2), w AS (SELECT genre, count(*) / (SELECT count(*) FROM r) AS w FROM r GROUP BY 1)
    SELECT year, CAST(sum(n) AS BIGINT) AS n, round(sum(n * m) / sum(n), 6) AS observed, CASE WHEN sum(n) >= 30 AND sum(w) FILTER (n >= 5) >= 0.5 THEN round(sum(w * m) FILTER (n >= 5) / sum(w) FILTER (n >= 5), 6) END AS standardised FROM c JOIN w USING (genre) GROUP BY 1""",
)
def a23(t: Tables) -> DataFrame:
    o = t.orders.select(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("genre"), (F.col("o_totalprice") / 1000).alias("v"))
    return st.standardised(o, "year", "genre", "v", 30)


@query(
    "A24_coverage_cell",
    f"SELECT kind, year, CAST(count(*) AS BIGINT) AS total, CAST(count(subject) AS BIGINT) AS scored, CAST(count(*) FILTER (subject IS "
    f"NULL) AS BIGINT) AS missing, round(count(subject) / count(*), 6) AS ratio, round(var_samp(dim1), 6) AS variance, "
    f"CAST(count(DISTINCT recording) AS BIGINT) AS recordings FROM {P} GROUP BY 1, 2",
)
def a24(t: Tables) -> DataFrame:
    return passages(t).groupBy("kind", "year").agg(F.count("*").alias("total"), F.count("subject").alias("scored"), F.count_if(F.col("subject").isNull()).alias("missing"), F.round(F.count("subject") / F.count("*"), 6).alias("ratio"), F.round(F.var_samp("dim1"), 6).alias("variance"), F.countDistinct("recording").alias("recordings"))


@query(
    "A25_variation_ranking",
    f"SELECT recording, round(sd, 6) AS sd, CAST(row_number() OVER (ORDER BY round(sd, 6) DESC, recording) AS BIGINT) AS place "
    f"FROM (SELECT recording, stddev_samp(dim0) AS sd FROM {P} GROUP BY 1 HAVING count(*) >= 3) QUALIFY place <= 50",
)
def a25(t: Tables) -> DataFrame:
    """The fifty recordings that vary most: a top-k before the numbering, so no global sort."""
    g = passages(t).groupBy("recording").agg(F.round(F.stddev_samp("dim0"), 6).alias("sd"), F.count("*").alias("n")).where("n >= 3").select("recording", "sd")
    top = g.orderBy(F.desc("sd"), "recording").limit(50)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("sd"), "recording")).cast("long"))


_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("A26_correlations", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r, CAST(count(*) AS BIGINT) AS n FROM lineitem" for i, a in enumerate(_MEASURES) for b in _MEASURES[i + 1 :]))
def a26(t: Tables) -> DataFrame:
    """All pairs in one aggregate over one scan."""
    pairs = [(a, b) for i, a in enumerate(_MEASURES) for b in _MEASURES[i + 1 :]]
    both = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull()
    one = t.lineitem.agg(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(F.corr(a, b), 6).alias("r"), F.count_if(both(a, b)).alias("n")) for a, b in pairs]).alias("x"))
    return one.select(F.explode("x").alias("x")).select("x.*")


@query("A27_neighbour_ranking", "SELECT b, r, CAST(row_number() OVER (ORDER BY abs(r) DESC, b) AS BIGINT) AS place FROM (" + " UNION ALL ".join(f"SELECT '{b}' AS b, round(corr(l_quantity, {b}), 6) AS r FROM lineitem" for b in _MEASURES[1:]) + ")")
def a27(t: Tables) -> DataFrame:
    near = a26(t).where("a = 'l_quantity'").select("b", "r")
    return near.withColumn("place", F.row_number().over(Window.orderBy(F.desc(F.abs("r")), "b")).cast("long"))


@query(
    "A28_top_loadings",
    "SELECT label, dim, loading FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY abs(loading) DESC, dim) AS place "
    "FROM (SELECT label, dim, round(avg(CAST(x AS DOUBLE)), 6) AS loading "
    "FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings) GROUP BY 1, 2)) "
    "WHERE place <= 6",
)
def a28(t: Tables) -> DataFrame:
    means = t.embeddings.select("label", F.posexplode("embedding").alias("dim", "x")).groupBy("label", F.col("dim").cast("long").alias("dim")).agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("loading"))
    w = Window.partitionBy("label").orderBy(F.desc(F.abs("loading")), "dim")
    return means.withColumn("place", F.row_number().over(w)).where("place <= 6").drop("place")


@query(
    "A29_residuals",
    "SELECT round(sqrt(avg(r * r)), 6) AS rms, round(max(abs(r)), 6) AS largest FROM (SELECT o.m - p.m AS r "
    "FROM (SELECT o_orderstatus, o_orderpriority, avg(o_totalprice) AS m FROM orders GROUP BY 1, 2) o "
    "JOIN (SELECT o_orderstatus, avg(o_totalprice) AS m FROM orders GROUP BY 1) p USING (o_orderstatus))",
)
def a29(t: Tables) -> DataFrame:
    cells = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.avg("o_totalprice").alias("m"), F.sum("o_totalprice").alias("s"), F.count("*").alias("n"))
    w = Window.partitionBy("o_orderstatus")
    r = F.col("m") - F.sum("s").over(w) / F.sum("n").over(w)
    return cells.select(r.alias("r")).agg(F.round(F.sqrt(F.avg(F.col("r") * F.col("r"))), 6).alias("rms"), F.round(F.max(F.abs("r")), 6).alias("largest"))


@query(
    "A30_agreement",
    "SELECT user_id, CAST(count(*) AS BIGINT) AS settings, CAST(count(*) FILTER (list_contains(kinds, 'purchase')) AS BIGINT) AS agree "
    "FROM (SELECT user_id, date_trunc('day', ts) AS day, list(event_type) AS kinds FROM events GROUP BY 1, 2) GROUP BY 1",
)
def a30(t: Tables) -> DataFrame:
    days = t.events.groupBy("user_id", F.date_trunc("day", "ts").alias("day")).agg(F.collect_set("event_type").alias("kinds"))
    return days.groupBy("user_id").agg(F.count("*").alias("settings"), F.count_if(F.array_contains("kinds", "purchase")).alias("agree"))


@query("A31_basis_counts", "SELECT o_orderpriority AS basis, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1 ORDER BY 2 DESC, 1")
def a31(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_orderpriority").alias("basis")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "basis")


@query(
    "A33_spread",
    "SELECT year, CAST(sum(n) AS BIGINT) AS total, round(max(n / t), 6) AS top_share, round(CASE WHEN count(*) > 1 THEN sum(-(n / t) * "
    "ln(n / t)) / ln(count(*)) ELSE 0 END, 6) AS spread FROM (SELECT *, sum(n) OVER (PARTITION BY year) AS t "
    "FROM (SELECT year(o_orderdate) AS year, o_custkey, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) >= 2)) GROUP BY 1",
)
def a33(t: Tables) -> DataFrame:
    counts = t.orders.groupBy(F.year("o_orderdate").alias("year"), "o_custkey").agg(F.count("*").alias("n")).where("n >= 2")
    return st.evenness(counts, ["year"], "n")


@query(
    "A36_piece_capacity",
    "SELECT l_suppkey, CAST(count(DISTINCT piece) AS BIGINT) AS pieces "
    "FROM (SELECT l_suppkey, unnest(range(l_partkey // 10, (l_partkey + CAST(l_quantity AS BIGINT)) // 10 + 1)) AS piece "
    "FROM lineitem) GROUP BY 1",
)
def a36(t: Tables) -> DataFrame:
    spans = t.lineitem.select("l_suppkey", F.expr("l_partkey div 10").alias("a"), F.expr("(l_partkey + cast(l_quantity as bigint)) div 10").alias("b"))
    return spans.select("l_suppkey", F.explode(F.sequence("a", "b")).alias("piece")).groupBy("l_suppkey").agg(F.countDistinct("piece").alias("pieces"))


@query(
    "A38_status_summary",
    "SELECT 'orders' AS relation, o_orderstatus AS state, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 2 UNION ALL "
    "SELECT 'events', event_type, CAST(count(*) AS BIGINT) FROM events GROUP BY 2",
)
def a38(t: Tables) -> DataFrame:
    a = t.orders.groupBy(F.col("o_orderstatus").alias("state")).agg(F.count("*").alias("n")).select(F.lit("orders").alias("relation"), "state", "n")
    return a.unionByName(t.events.groupBy(F.col("event_type").alias("state")).agg(F.count("*").alias("n")).select(F.lit("events").alias("relation"), "state", "n"))


@query(
    "A39_half_years",
    "SELECT CAST(year(o_orderdate) AS BIGINT) * 2 + CASE WHEN month(o_orderdate) > 6 THEN 1 ELSE 0 END AS half, CAST(count(*) AS "
    "BIGINT) AS n, round(quantile_cont(o_totalprice, 0.5), 4) AS median, round(quantile_cont(o_totalprice, 0.75) - "
    "quantile_cont(o_totalprice, 0.25), 4) AS iqr FROM orders GROUP BY 1",
)
def a39(t: Tables) -> DataFrame:
    half = F.year("o_orderdate").cast("long") * 2 + F.when(F.month("o_orderdate") > 6, 1).otherwise(0)
    rows = t.orders.select(half.alias("half"), "o_totalprice")
    found = ranks.quantiles(rows, "half", "o_totalprice", {"q25": 0.25, "median": 0.5, "q75": 0.75})
    counts = rows.groupBy("half").agg(F.count("*").alias("n"))
    return counts.join(found, "half").select("half", "n", F.round("median", 4).alias("median"), F.round(F.col("q75") - F.col("q25"), 4).alias("iqr"))


@query(
    "W10_W11_arc",
    f"SELECT recording, place, part, round(v, 6) AS smooth, CAST(row_number() OVER (PARTITION BY recording "
    f"ORDER BY dim0 DESC, place, part, dim1) AS BIGINT) AS rank FROM (SELECT *, "
    f"CASE WHEN count(dim0) OVER w >= 3 THEN avg(dim0) OVER w END AS v FROM {P} WINDOW w AS (PARTITION BY recording "
    f"ORDER BY place, part, dim0, dim1 ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))",
)
def w10(t: Tables) -> DataFrame:
    w = Window.partitionBy("recording").orderBy("place", "part", "dim0", "dim1").rowsBetween(-2, 2)
    r = Window.partitionBy("recording").orderBy(F.desc("dim0"), "place", "part", "dim1")
    smooth = F.when(F.count("dim0").over(w) >= 3, F.avg("dim0").over(w))
    return passages(t).select("recording", "place", "part", F.round(smooth, 6).alias("smooth"), F.row_number().over(r).cast("long").alias("rank"))


@query(
    "W12_adjacent_differences",
    "SELECT o_custkey, round(min(d), 2) AS fall, round(max(d), 2) AS rise, CAST(count(*) FILTER (d < 0) AS BIGINT) AS falls "
    "FROM (SELECT o_custkey, o_totalprice - lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS d "
    "FROM orders) GROUP BY 1",
)
def w12(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    d = t.orders.select("o_custkey", (F.col("o_totalprice") - F.lag("o_totalprice").over(w)).alias("d"))
    return d.groupBy("o_custkey").agg(F.round(F.min("d"), 2).alias("fall"), F.round(F.max("d"), 2).alias("rise"), F.count_if(F.col("d") < 0).alias("falls"))


@query(
    "W13_milestones",
    "SELECT o_custkey, year(o_orderdate) AS year, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_id, arg_max(o_orderkey, "
    "(o_totalprice, o_orderkey)) AS peak_id FROM orders GROUP BY 1, 2",
)
def w13(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("last_id"), F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("peak_id"))


@query(
    "W14_mean_change",
    "SELECT o_custkey, round(avg(abs(d)), 1) AS change, round(arg_max(o_totalprice, (o_orderdate, o_orderkey)) - arg_min(o_totalprice, "
    "(o_orderdate, o_orderkey)), 2) AS drift FROM (SELECT *, o_totalprice - lag(o_totalprice) OVER (PARTITION BY o_custkey "
    "ORDER BY o_orderdate, o_orderkey) AS d FROM orders) GROUP BY 1 HAVING count(*) >= 3",
)
def w14(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = t.orders.withColumn("d", F.col("o_totalprice") - F.lag("o_totalprice").over(w))
    at = F.struct("o_orderdate", "o_orderkey")
    g = o.groupBy("o_custkey").agg(F.round(F.avg(F.abs("d")), 1).alias("change"), F.round(F.max_by("o_totalprice", at) - F.min_by("o_totalprice", at), 2).alias("drift"), F.count("*").alias("n"))
    return g.where("n >= 3").drop("n")


_MONTHS = (
    "SELECT o_orderpriority AS topic, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS BIGINT) AS m, count(*) AS hits, "
    "count(DISTINCT o_custkey) AS recordings, count(*) / 10.0 AS rate FROM orders WHERE o_orderstatus = 'P' GROUP BY 1, 2"
)


@query(
    "W15_bursts",
    f"""WITH r AS ({_MONTHS}), b AS (SELECT a.topic, a.m, a.rate, median(b.rate) AS base FROM r a JOIN r b ON a.topic = b.topic AND b.m <> a.m AND abs(b.m - a.m) <= 12 GROUP BY 1, 2, 3 HAVING count(*) >= 3), f AS (SELECT r.topic, r.m FROM r JOIN b USING (topic, m) WHERE r.hits >= 3 AND r.recordings >= 3 AND r.rate >= 1.2 * greatest(base, 0.2))
    SELECT topic, min(m) AS first, max(m) AS last, CAST(count(*) AS BIGINT) AS n FROM (SELECT *, m - row_number() OVER (PARTITION BY topic ORDER BY m) AS i FROM f) GROUP BY topic, i""",
)
def w15(t: Tables) -> DataFrame:
    """Months whose rate stands out from their neighbours of a year either side, adjacent ones grouped."""
    month = (F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("long")
    r = t.orders.where("o_orderstatus = 'P'").groupBy(F.col("o_orderpriority").alias("topic"), month.alias("m")).agg(F.count("*").alias("hits"), F.countDistinct("o_custkey").alias("recordings"), (F.count("*") / 10).alias("rate"))
    around = r.select("topic", "rate", F.explode(F.sequence(F.col("m") - 12, F.col("m") + 12)).alias("m2"), "m").where("m2 <> m").groupBy("topic", F.col("m2").alias("m")).agg(F.percentile("rate", F.lit(0.5)).alias("base"), F.count("*").alias("k")).where("k >= 3")
    flagged = r.join(around, ["topic", "m"]).where("hits >= 3 and recordings >= 3 and rate >= 1.2 * greatest(base, 0.2)")
    return st.islands(flagged, ["topic"], "m")


@query(
    "W16_contiguous_runs",
    "SELECT user_id, min(d) AS first, max(d) AS last, CAST(count(*) AS BIGINT) AS n "
    "FROM (SELECT *, d - row_number() OVER (PARTITION BY user_id ORDER BY d) AS i "
    "FROM (SELECT DISTINCT user_id, CAST(day(ts) AS BIGINT) AS d FROM events WHERE event_type = 'error')) GROUP BY user_id, i",
)
def w16(t: Tables) -> DataFrame:
    return st.islands(t.events.where("event_type = 'error'").select("user_id", F.dayofmonth("ts").cast("long").alias("d")), ["user_id"], "d")


@query("W17_merged_ranges", 'SELECT l_suppkey, min(a) AS "first", max(b) AS "last" FROM (SELECT *, sum(CASE WHEN a <= seen + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY l_suppkey ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS i FROM (SELECT *, max(b) OVER (PARTITION BY l_suppkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM (SELECT l_suppkey, l_partkey * 100 AS a, l_partkey * 100 + CAST(l_quantity AS BIGINT) * 10 AS b FROM lineitem))) GROUP BY l_suppkey, i')
def w17(t: Tables) -> DataFrame:
    return st.merged_ranges(t.lineitem.select("l_suppkey", (F.col("l_partkey") * 100).alias("a"), (F.col("l_partkey") * 100 + F.col("l_quantity").cast("long") * 10).alias("b")), "l_suppkey", "a", "b")


@query(
    "W18_uniform_cap",
    "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey "
    "ORDER BY o_orderdate, o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) "
    "WHERE n <= 4 OR list_contains([0, (n - 1) // 3, 2 * (n - 1) // 3, n - 1], i)",
)
def w18(t: Tables) -> DataFrame:
    return st.evenly_spaced(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"], 4).select("o_custkey", "o_orderkey")


@query(
    "W19_stratified_sample",
    "SELECT o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority "
    "ORDER BY o_orderdate, o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) "
    "WHERE i IN (SELECT unnest(range(0, 100))) AND n < 100 OR n >= 100 AND floor(ceil(i * 100 / n) * n / 100) = i AND ceil(i * 100 / "
    "n) < 100",
)
def w19(t: Tables) -> DataFrame:
    """A hundred rows a stratum at places floor(i * n / 100)."""
    r = ranks.numbered(t.orders.select("o_orderpriority", "o_orderdate", "o_orderkey"), "o_orderpriority", ["o_orderdate", "o_orderkey"], "i", "n")
    step = F.ceil(F.col("i") * 100 / F.col("n"))
    taken = (F.floor(step * F.col("n") / 100) == F.col("i")) & (step < 100)
    return r.where((F.col("n") < 100) | taken).select("o_orderpriority", "o_orderkey")
