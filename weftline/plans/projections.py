"""P*, O*, F*: projections, filters, sorts, top-k and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import text as tx
from weftline.plans.registry import Tables, query


@query(
    "P1_recording_filter",
    "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'r') AND contains(lower(p_name), 'in') AND p_size BETWEEN 5 AND "
    "40 AND p_type IN ('ECONOMY', 'PROMO')",
)
def p1(t: Tables) -> DataFrame:
    return t.part.where(tx.all_words_in(F.col("p_name"), ["r", "in"]) & F.col("p_size").between(5, 40) & F.col("p_type").isin("ECONOMY", "PROMO")).select("p_partkey", "p_name")


@query(
    "P2_browse_filter",
    "SELECT o_orderkey, CASE WHEN o_totalprice <= 0 THEN 'unknown' WHEN o_totalprice * 30 / 60000 < 5 THEN 'under-5' WHEN o_totalprice "
    "* 30 / 60000 < 20 THEN '5-20' WHEN o_totalprice * 30 / 60000 < 60 THEN '20-60' WHEN o_totalprice * 30 / 60000 < 180 THEN '60-180' "
    "ELSE '180-plus' END AS length FROM orders WHERE o_orderstatus <> 'F' AND year(o_orderdate) = 1997",
)
def p2(t: Tables) -> DataFrame:
    return t.orders.where((F.col("o_orderstatus") != "F") & (F.year("o_orderdate") == 1997)).select("o_orderkey", tx.length_bucket(F.col("o_totalprice") * 30).alias("length"))


@query("P3_summary_filter", "SELECT conv_id, turn FROM conversations WHERE role = 'user' AND contains(lower(text), 'the')")
def p3(t: Tables) -> DataFrame:
    return t.conversations.where((F.col("role") == "user") & tx.all_words_in(F.col("text"), ["the"])).select("conv_id", "turn")


@query(
    "P4_matched_alias",
    "SELECT p_partkey, alias FROM (SELECT p_partkey, [x FOR x IN [p_name, p_brand, p_type] IF contains(lower(x), 'e') AND "
    "contains(lower(x), 'o')][1] AS alias FROM part) WHERE alias IS NOT NULL",
)
def p4(t: Tables) -> DataFrame:
    found = F.get(F.filter(F.array("p_name", "p_brand", "p_type"), lambda x: tx.all_words_in(x, ["e", "o"])), 0)
    return t.part.select("p_partkey", found.alias("alias")).where("alias is not null")


@query(
    "P5_passage_finder",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem "
    "WHERE l_linestatus = 'O' AND l_quantity >= 40 AND -l_discount >= -0.02 AND year(l_shipdate) BETWEEN 1996 AND 1999 "
    "ORDER BY l_quantity DESC, l_orderkey, l_linenumber",
)
def p5(t: Tables) -> DataFrame:
    """Conjunctive predicates with per-dimension thresholds: the sign says at least or at most."""
    thresholds = {"l_quantity": 40.0, "l_discount": -0.02}
    rows = t.lineitem.where((F.col("l_linestatus") == "O") & F.year("l_shipdate").between(1996, 1999))
    for name, least in thresholds.items():
        rows = rows.where(F.col(name) >= least if least >= 0 else F.col(name) <= -least)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").orderBy(F.desc("l_quantity"), "l_orderkey", "l_linenumber")


@query(
    "P7_public_rows",
    "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0 AND c_nationkey IN (SELECT n_nationkey FROM nation "
    "WHERE n_regionkey <> 2) AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O')",
)
def p7(t: Tables) -> DataFrame:
    c = t.customer.where("c_acctbal > 0").join(t.nation.where("n_regionkey <> 2"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    return c.join(t.orders.where("o_orderstatus = 'O'"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey", "c_name")


@query(
    "P8_derived_case",
    "SELECT o_orderkey, o_orderstatus = 'P' AS machine, CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' WHEN o_orderstatus = 'F' "
    "THEN 'done' END AS code, coalesce(CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END, 'active') AS state FROM orders",
)
def p8(t: Tables) -> DataFrame:
    s = F.col("o_orderstatus")
    return t.orders.select("o_orderkey", (s == "P").alias("machine"), F.when(F.col("o_orderpriority") == "1-URGENT", "urgent").when(s == "F", "done").alias("code"), F.coalesce(F.when(s != "O", s), F.lit("active")).alias("state"))


@query(
    "P9_code_lookup",
    "SELECT event_id, CASE event_type WHEN 'view' THEN 'seen' WHEN 'click' THEN 'touched' END AS label, event_type NOT IN ('view', "
    "'click') AS rejected FROM events",
)
def p9(t: Tables) -> DataFrame:
    names = F.create_map(*[F.lit(x) for x in ("view", "seen", "click", "touched")])
    label = F.try_element_at(names, F.col("event_type"))
    return t.events.select("event_id", label.alias("label"), label.isNull().alias("rejected"))


@query("P10_allow_list", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def p10(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_name", "c_mktsegment")


@query(
    "P11_effective_date",
    "SELECT event_id, coalesce(CASE WHEN value > 50 THEN value END, CASE WHEN event_type = 'click' THEN 0.5 END, 1.0) AS effective "
    "FROM events",
)
def p11(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.coalesce(F.when(F.col("value") > 50, F.col("value")), F.when(F.col("event_type") == "click", 0.5), F.lit(1.0)).alias("effective"))


@query(
    "P12_exact_resolution",
    "SELECT o.o_orderkey, CASE WHEN u.n = 1 THEN u.id END AS resolved FROM orders o LEFT "
    "JOIN (SELECT o_custkey, o_orderdate, count(*) AS n, min(o_orderkey) AS id FROM orders WHERE o_totalprice > 100000 "
    "GROUP BY 1, 2) u USING (o_custkey, o_orderdate)",
)
def p12(t: Tables) -> DataFrame:
    u = t.orders.where("o_totalprice > 100000").groupBy("o_custkey", "o_orderdate").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("id"))
    return t.orders.join(u, ["o_custkey", "o_orderdate"], "left").select("o_orderkey", F.when(F.col("n") == 1, F.col("id")).alias("resolved"))


@query(
    "P13_T14_placeholders",
    "SELECT doc_id, CAST(count(*) AS BIGINT) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) "
    "WHERE regexp_matches(line, '^[A-Z][a-z]{0,3}\\.$') GROUP BY 1",
)
def p13(t: Tables) -> DataFrame:
    lines = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.where(F.col("line").rlike(r"^[A-Z][a-z]{0,3}\.\z")).groupBy("doc_id").agg(F.count("*").alias("n"))


@query(
    "P14_first_per_url",
    "SELECT host, arg_min(page_id, page_id) AS page_id, CAST(count(*) AS BIGINT) AS n "
    "FROM (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host FROM pages) GROUP BY 1",
)
def p14(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.try_parse_url("url", F.lit("HOST")).alias("host")).groupBy("host").agg(F.min("page_id").alias("page_id"), F.count("*").alias("n"))


@query(
    "P15_null_safe",
    "SELECT a.o_orderkey FROM orders a JOIN orders b ON a.o_orderkey = b.o_orderkey "
    "WHERE (CASE WHEN a.o_orderstatus = 'P' THEN NULL ELSE a.o_orderstatus END) IS NOT DISTINCT "
    "FROM (CASE WHEN b.o_totalprice > 200000 THEN NULL ELSE 'F' END)",
)
def p15(t: Tables) -> DataFrame:
    s = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return t.orders.where(s.eqNullSafe(F.when(F.col("o_totalprice") <= 200000, "F"))).select("o_orderkey")


@query(
    "P16_pattern_predicates",
    "SELECT p_partkey FROM part WHERE p_brand GLOB 'Brand#1?' AND p_name LIKE '%ring%' AND instr(p_name, 'red') = 0 AND p_size BETWEEN "
    "3 AND 45 AND p_type IN ('ECONOMY', 'SMALL', 'PROMO')",
)
def p16(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_brand").rlike(r"^Brand#1.\z") & F.col("p_name").like("%ring%") & (F.instr("p_name", "red") == 0) & F.col("p_size").between(3, 45) & F.col("p_type").isin("ECONOMY", "SMALL", "PROMO")).select("p_partkey")


@query(
    "O1_nulls_last",
    "SELECT o_orderkey, v FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS v FROM orders) "
    "ORDER BY v DESC NULLS LAST, o_orderkey LIMIT 200",
)
def o1(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("v")).orderBy(F.desc_nulls_last("v"), "o_orderkey").limit(200)


@query("O2_newest_first", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 100")
def o2(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderdate").orderBy(F.desc_nulls_last("o_orderdate"), "o_orderkey").limit(100)


@query(
    "O3_collated_order",
    "SELECT p_partkey, p_name FROM part ORDER BY coalesce(CASE WHEN p_size > 10 THEN p_brand END, '9999'), lower(p_name), p_partkey "
    "LIMIT 150",
)
def o3(t: Tables) -> DataFrame:
    return t.part.orderBy(F.coalesce(F.when(F.col("p_size") > 10, F.col("p_brand")), F.lit("9999")), F.expr("collate(p_name, 'UTF8_LCASE')"), "p_partkey").limit(150).select("p_partkey", "p_name")


@query("O4_year_desc", "SELECT o_orderkey FROM orders ORDER BY -coalesce(year(o_orderdate), -1), lower(o_orderpriority), o_orderkey LIMIT 100")
def o4(t: Tables) -> DataFrame:
    return t.orders.orderBy(-F.coalesce(F.year("o_orderdate"), F.lit(-1)), F.lower("o_orderpriority"), "o_orderkey").limit(100).select("o_orderkey")


@query("O5_latest_limit", "SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def o5(t: Tables) -> DataFrame:
    return t.events.orderBy(F.desc("ts"), F.desc("event_id")).limit(1).select("event_id")


@query("O6_numeric_aware", "SELECT v FROM (SELECT DISTINCT p_brand AS v FROM part) ORDER BY CAST(regexp_extract(v, '[0-9]+') AS INT), v")
def o6(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_brand").alias("v")).distinct().orderBy(F.try_to_number(F.regexp_extract("v", "[0-9]+", 0), F.lit("999999")), "v")


@query(
    "O7_O8_directory_order",
    "SELECT user_id, n FROM (SELECT user_id, CAST(count(*) AS BIGINT) AS n, count(DISTINCT event_type) > 4 AS multi FROM events "
    "GROUP BY 1) ORDER BY multi DESC, n DESC, user_id",
)
def o7(t: Tables) -> DataFrame:
    g = t.events.groupBy("user_id").agg(F.count("*").alias("n"), (F.countDistinct("event_type") > 4).alias("multi"))
    return g.orderBy(F.desc("multi"), F.desc("n"), "user_id").drop("multi")


@query(
    "O9_top_k_per_group",
    "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey "
    "ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n <= 5",
)
def o9(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return t.orders.withColumn("n", F.row_number().over(w)).where("n <= 5").select("o_custkey", "o_orderkey")


@query("O10_page", "SELECT o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 20 OFFSET 40")
def o10(t: Tables) -> DataFrame:
    return t.orders.orderBy("o_totalprice", "o_orderkey").offset(40).limit(20).select("o_orderkey")


@query(
    "O11_merge_results",
    "SELECT id, max(score) AS score FROM (SELECT o_custkey AS id, max(o_totalprice) AS score FROM orders WHERE o_orderstatus = 'F' "
    "GROUP BY 1 UNION ALL SELECT o_custkey, max(o_totalprice) FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1) GROUP BY 1 "
    "ORDER BY score DESC, id LIMIT 60",
)
def o11(t: Tables) -> DataFrame:
    part = lambda c: t.orders.where(c).groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_totalprice").alias("score"))
    both = part("o_orderstatus = 'F'").union(part("o_orderpriority = '5-LOW'"))
    return both.groupBy("id").agg(F.max("score").alias("score")).orderBy(F.desc("score"), "id").limit(60)


@query(
    "O13_preview",
    "SELECT doc_id, CASE WHEN length(text) <= 240 THEN text ELSE regexp_extract(substr(text, 1, 241), '(?s)^(.*)\\s', 1) END AS "
    "preview FROM documents",
)
def o13(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", tx.preview(F.col("text")).alias("preview"))


@query(
    "F1_slugs",
    "SELECT c_custkey, regexp_replace(substr(trim(regexp_replace(lower(c_name || ' ' || c_mktsegment), '[^a-z0-9]+', '-', 'g'), '-'), "
    "1, 30), '-+$', '') AS slug, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS label FROM customer",
)
def f1(t: Tables) -> DataFrame:
    name = F.concat_ws(" ", "c_name", "c_mktsegment")
    return t.customer.select("c_custkey", tx.ascii_slug(name, 30).alias("slug"), F.concat(F.upper(F.substring("c_mktsegment", 1, 1)), F.lower(F.substring("c_mktsegment", 2, 100))).alias("label"))


@query("F1_normal_forms", "SELECT doc_id, lower(trim(regexp_replace(nfc_normalize(text), '[ \\n]+', ' ', 'g'))) AS key FROM documents")
def f1b(t: Tables) -> DataFrame:
    """Match keys of all texts; they hold no compatibility characters, so that NFC gives what NFKC does."""
    return t.documents.select("doc_id", tx.match_key("text").alias("key"))


@query(
    "F2_patterns",
    r"SELECT page_id, regexp_extract(url, '[?&]page=([0-9]+)', 1) AS page, regexp_matches(html, '<title>[^<]*</title>') AS titled, "
    r"CAST(len(regexp_extract_all(html, '<a href=')) AS INT) AS links FROM pages",
)
def f2(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.regexp_extract("url", "[?&]page=([0-9]+)", 1).alias("page"), F.col("html").rlike("<title>[^<]*</title>").alias("titled"), F.regexp_count("html", F.lit("<a href=")).alias("links"))


@query("F3_query_words", "SELECT p_partkey, CAST(len(string_split(lower(p_name), ' ')) AS INT) AS n, string_split(lower(p_name), ' ')[1] AS first FROM part")
def f3(t: Tables) -> DataFrame:
    w = tx.words(F.col("p_name"))
    return t.part.select("p_partkey", F.size(w).alias("n"), F.get(w, 0).alias("first"))


@query(
    "F4_partial_dates",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN CAST(year(o_orderdate) AS INT) END AS year, "
    "CASE WHEN o_orderkey % 4 IN (1, 2) THEN strftime(o_orderdate, '%Y-%m') END AS month, CAST(date_diff('day', TIMESTAMP "
    "'1995-01-01', o_orderdate) AS INT) AS days FROM orders",
)
def f4(t: Tables) -> DataFrame:
    k = F.col("o_orderkey") % 4
    d = F.col("o_orderdate")
    label = F.when(k == 0, F.date_format(d, "yyyy")).when(k == 1, F.date_format(d, "yyyy-MM")).when(k == 2, F.date_format(d, "yyyy-MM-dd")).otherwise(F.concat(F.date_format(d, "yyyy"), F.lit("-02-31")))
    year, month = tx.partial_date(F.col("label"))
    return t.orders.withColumn("label", label).select("o_orderkey", year.alias("year"), month.alias("month"), F.datediff("o_orderdate", F.lit("1995-01-01").cast("date")).alias("days"))


@query(
    "F4_clock",
    "SELECT event_id, CASE WHEN value * 100 >= 3600 THEN printf('%d:%02d:%02d', CAST(floor(value * 100) AS BIGINT) // 3600, "
    "CAST(floor(value * 100) AS BIGINT) % 3600 // 60, CAST(floor(value * 100) AS BIGINT) % 60) ELSE printf('%d:%02d', CAST(floor(value "
    "* 100) AS BIGINT) // 60, CAST(floor(value * 100) AS BIGINT) % 60) END AS clock FROM events",
)
def f4b(t: Tables) -> DataFrame:
    return t.events.select("event_id", tx.clock(F.col("value") * 100).alias("clock"))


@query(
    "F5_math",
    "SELECT event_id, round(sqrt(value * value + user_id * user_id), 6) AS hypot, round(sqrt(greatest(2 * (1 - value / 1000), 0)), 6) "
    "AS chord, CAST(round(value * 1000) AS BIGINT) AS scaled, CAST(floor(10 + (value - 5) * 90 / 500) AS BIGINT) AS rescaled "
    "FROM events",
)
def f5(t: Tables) -> DataFrame:
    v = F.col("value")
    return t.events.select("event_id", F.round(F.hypot(v, F.col("user_id")), 6).alias("hypot"), F.round(F.sqrt(F.greatest(2 * (1 - v / 1000), F.lit(0.0))), 6).alias("chord"), F.round(v * 1000).cast("long").alias("scaled"), F.floor(10 + (v - 5) * 90 / 500).alias("rescaled"))


@query(
    "F6_arrays",
    "SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds, bool_or(event_type IN ('click', 'error')) AS "
    "overlaps FROM events WHERE value > 40 GROUP BY 1",
)
def f6(t: Tables) -> DataFrame:
    g = t.events.where("value > 40").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("k"))
    return g.select("user_id", F.array_join("k", ",").alias("kinds"), F.arrays_overlap("k", F.array(F.lit("click"), F.lit("error"))).alias("overlaps"))


@query(
    "F7_maps",
    "SELECT user_id, string_agg(event_type, ',' ORDER BY n DESC, event_type) AS top, max(n) FILTER (event_type = 'click') AS clicks "
    "FROM (SELECT user_id, event_type, CAST(count(*) AS BIGINT) AS n, row_number() OVER (PARTITION BY user_id "
    "ORDER BY count(*) DESC, event_type) AS r FROM events GROUP BY 1, 2) WHERE r <= 3 OR event_type = 'click' GROUP BY 1 "
    "HAVING count(*) >= 0",
)
def f7(t: Tables) -> DataFrame:
    counts = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    m = counts.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    order = F.array_sort(F.transform(F.map_entries("m"), lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("k"))))
    top = F.transform(F.filter(order, lambda e, i: (i < 3) | (e["k"] == "click")), lambda e: e["k"])
    return m.select("user_id", F.array_join(top, ",").alias("top"), F.try_element_at("m", F.lit("click")).alias("clicks"))


@query(
    "F8_json",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, json_valid(props) AS valid, '{\"k\":' || "
    "json_extract_string(props, '$.k') || '}' AS canonical FROM events",
)
def f8(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.variant_get(F.try_parse_json("props"), "$.k", "int").alias("k"), F.try_parse_json("props").isNotNull().alias("valid"), tx.canonical_json(F.col("props")).alias("canonical"))


@query(
    "F9_hash_ids",
    "SELECT c_custkey, sha256(c_name) AS digest, 'cus_' || substr(sha256(c_name || chr(0) || c_mktsegment), 1, 24) AS id, md5(c_name) "
    "AS m FROM customer",
)
def f9(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.sha2(F.col("c_name").cast("binary"), 256).alias("digest"), tx.short_id("cus", F.col("c_name"), F.col("c_mktsegment"), digits=24).alias("id"), F.md5(F.col("c_name").cast("binary")).alias("m"))


@query(
    "F10_deep_links",
    "SELECT page_id, url || CASE WHEN contains(url, '?') THEN '&t=' ELSE '?t=' END || CAST(CAST(floor(page_id * 1.5) AS BIGINT) AS "
    "VARCHAR) AS link FROM pages",
)
def f10(t: Tables) -> DataFrame:
    return t.pages.select("page_id", tx.deep_link(F.col("url"), F.col("page_id") * 1.5).alias("link"))


@query(
    "F11_null_semantics",
    "SELECT o_orderkey, CASE WHEN v IS NULL THEN NULL ELSE greatest(v, 200000) END AS strict_max, coalesce(v, 0) AS filled "
    "FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS v FROM orders)",
)
def f11(t: Tables) -> DataFrame:
    v = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return t.orders.select("o_orderkey", F.when(v.isNotNull(), F.greatest(v, F.lit(200000.0))).alias("strict_max"), F.coalesce(v, F.lit(0.0)).alias("filled"))


@query(
    "F12_date_estimates",
    "SELECT o_orderkey, problem FROM (SELECT o_orderkey, CASE WHEN o_totalprice < 5000 THEN 'too small' WHEN year(o_orderdate) > 2000 "
    "AND o_orderstatus = 'F' THEN 'late' WHEN o_orderpriority = '5-LOW' AND o_totalprice > 480000 THEN 'unlikely' END AS problem "
    "FROM orders) WHERE problem IS NOT NULL",
)
def f12(t: Tables) -> DataFrame:
    problem = F.when(F.col("o_totalprice") < 5000, "too small").when((F.year("o_orderdate") > 2000) & (F.col("o_orderstatus") == "F"), "late").when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_totalprice") > 480000), "unlikely")
    return t.orders.select("o_orderkey", problem.alias("problem")).where("problem is not null")


@query(
    "F13_estimate_text",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'On ' || strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderstatus = 'O' THEN "
    "'Around ' || strftime(o_orderdate, '%Y-%m') ELSE 'Between ' || CAST(year(o_orderdate) AS VARCHAR) || ' and ' || "
    "CAST(year(o_orderdate) + 1 AS VARCHAR) END AS described FROM orders",
)
def f13(t: Tables) -> DataFrame:
    d, y = F.col("o_orderdate"), F.year("o_orderdate")
    text = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("On "), F.date_format(d, "yyyy-MM-dd"))).when(F.col("o_orderstatus") == "O", F.concat(F.lit("Around "), F.date_format(d, "yyyy-MM"))).otherwise(F.format_string("Between %d and %d", y, y + 1))
    return t.orders.select("o_orderkey", text.alias("described"))


@query(
    "F14_language_partition",
    "SELECT part, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE WHEN regexp_matches(l, '^[A-Za-z]{2}(-|_|$)') THEN lower(substr(l, "
    "1, 2)) ELSE 'en' END AS part FROM (SELECT CASE WHEN doc_id % 3 = 0 THEN lang || '-XX' WHEN doc_id % 3 = 1 THEN lang ELSE 'x' || "
    "lang END AS l FROM documents)) GROUP BY 1",
)
def f14(t: Tables) -> DataFrame:
    k = F.col("doc_id") % 3
    label = F.when(k == 0, F.concat("lang", F.lit("-XX"))).when(k == 1, F.col("lang")).otherwise(F.concat(F.lit("x"), "lang"))
    return t.documents.select(tx.language_partition(label).alias("part")).groupBy("part").agg(F.count("*").alias("n"))


@query(
    "F15_note_projection",
    "SELECT c_custkey, c_name AS title, CASE WHEN c_acctbal < 0 THEN 'debt' END AS note FROM customer "
    "WHERE c_name IS NOT NULL AND c_acctbal < 100",
)
def f15(t: Tables) -> DataFrame:
    return t.customer.where("c_name is not null and c_acctbal < 100").select("c_custkey", F.col("c_name").alias("title"), F.when(F.col("c_acctbal") < 0, "debt").alias("note"))
