"""G*, U3, U5, A32, A34, A35, A37, O12: graphs, clusters, neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators import folds, graphs, networks, pieces, vectors
from weftline.plans.registry import Tables, query

_CHAIN = """
    SELECT 'r' || n_regionkey AS a, 'n' || n_nationkey AS b FROM nation
    UNION SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer
    UNION SELECT 'c' || o_custkey, 'o' || o_orderkey FROM orders
    UNION SELECT 'o' || l_orderkey, 'p' || l_partkey FROM lineitem
    UNION SELECT 'p' || l_partkey, 's' || l_suppkey FROM lineitem
"""
_BACK = "SELECT 's' || s_suppkey AS a, 'n' || s_nationkey AS b FROM supplier"


def _links(table: DataFrame, a: str, b: str, kinds: str) -> DataFrame:
    return table.select(F.concat(F.lit(kinds[0]), F.col(a)).alias("a"), F.concat(F.lit(kinds[1]), F.col(b)).alias("b"))


def chain(t: Tables) -> DataFrame:
    """Edges of five types down the tables: region, nation, customer, order, part, supplier."""
    out = _links(t.nation, "n_regionkey", "n_nationkey", "rn").union(_links(t.customer, "c_nationkey", "c_custkey", "nc")).union(_links(t.orders, "o_custkey", "o_orderkey", "co"))
    return out.union(_links(t.lineitem, "l_orderkey", "l_partkey", "op")).union(_links(t.lineitem, "l_partkey", "l_suppkey", "ps")).distinct()


def back(t: Tables) -> DataFrame:
    """From suppliers to their nations, which closes cycles."""
    return _links(t.supplier, "s_suppkey", "s_nationkey", "sn")


_SEEDS = [("r0", 1), ("r1", 3), ("n7", 2), ("c5", 4)]
_SEED_ROWS = ", ".join(f"('{i}', {n})" for i, n in _SEEDS)


@query(
    "G1_U5_reachability",
    f"WITH RECURSIVE e AS ({_CHAIN} UNION {_BACK}), r(id, label) AS (SELECT * FROM (VALUES {_SEED_ROWS}) UNION SELECT e.b, r.label "
    f"FROM r JOIN e ON e.a = r.id) SELECT id, max(label) AS label FROM r GROUP BY 1",
)
def g1(t: Tables) -> DataFrame:
    """Over the whole graph of all tables, with cycles through the suppliers' nations."""
    return graphs.reachable(chain(t).union(back(t)), t.spark.createDataFrame(_SEEDS, "id string, label int"))


@query(
    "G2_cycles",
    f"WITH RECURSIVE e AS ({_CHAIN}), r(s, v) AS (SELECT DISTINCT b, b FROM ({_BACK}) UNION SELECT r.s, e.b FROM r JOIN e ON e.a = r.v) "
    f"SELECT x.a, x.b, count(r.v) > 0 AS cyclic FROM ({_BACK}) x LEFT JOIN r ON r.s = x.b AND r.v = x.a GROUP BY 1, 2",
)
def g2(t: Tables) -> DataFrame:
    """Which new edges, from suppliers to nations, would close a cycle: those whose target reaches their source."""
    return graphs.closing_edges(chain(t), back(t))


@query(
    "G3_components",
    "WITH RECURSIVE e AS (SELECT DISTINCT * FROM (SELECT l_suppkey AS a, l_suppkey // 3 AS b FROM lineitem "
    "UNION ALL SELECT l_suppkey // 3, l_suppkey FROM lineitem)), r(id, c) AS (SELECT a, a FROM e UNION "
    "SELECT e.b, r.c FROM r JOIN e ON e.a = r.id) SELECT id, min(c) AS component FROM r GROUP BY 1",
)
def g3(t: Tables) -> DataFrame:
    return graphs.components(t.lineitem.select(F.col("l_suppkey").alias("a"), F.expr("l_suppkey div 3").alias("b")))


@query(
    "G8_U3_pruning",
    "SELECT c_custkey AS id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders "
    "WHERE o_orderstatus = 'F') AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)",
)
def g8(t: Tables) -> DataFrame:
    link = lambda c: t.orders.where(c).select(F.col("o_custkey").alias("id"))
    return graphs.pruned(t.customer.select(F.col("c_custkey").alias("id")), {"participants": link("o_orderstatus = 'F'"), "evidence": link("o_totalprice > 400000")})


_PAIRS = (
    "SELECT a.l_suppkey AS a, b.l_suppkey AS b, CAST(count(*) AS BIGINT) AS weight FROM (SELECT DISTINCT l_orderkey, l_suppkey "
    "FROM lineitem) a JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) b "
    "ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey GROUP BY 1, 2"
)
_TOTAL = "(SELECT l_suppkey AS s, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1)"
_LIFT = (
    f"SELECT a, b, weight, round(weight * (SELECT count(DISTINCT l_orderkey) FROM lineitem) / (x.n * y.n), 6) AS lift FROM ({_PAIRS}) p "
    f"JOIN {_TOTAL} x ON x.s = a JOIN {_TOTAL} y ON y.s = b"
)


def co_mentions(t: Tables) -> DataFrame:
    """Pairs of suppliers in one order, which has at most a handful, with weight and lift over independence."""
    m = t.lineitem.select("l_orderkey", "l_suppkey").distinct()
    a, b = m.alias("a"), m.alias("b")
    pairs = a.join(b, (F.col("a.l_orderkey") == F.col("b.l_orderkey")) & (F.col("a.l_suppkey") < F.col("b.l_suppkey"))).groupBy(F.col("a.l_suppkey").alias("a"), F.col("b.l_suppkey").alias("b")).agg(F.count("*").alias("weight"))
    n = m.groupBy(F.col("l_suppkey").alias("s")).agg(F.count("*").alias("n"))
    total = m.agg(F.countDistinct("l_orderkey")).first()[0]
    out = pairs.join(n.select(F.col("s").alias("a"), F.col("n").alias("na")), "a").join(n.select(F.col("s").alias("b"), F.col("n").alias("nb")), "b")
    return out.select("a", "b", "weight", F.round(F.col("weight") * F.lit(total) / (F.col("na") * F.col("nb")), 6).alias("lift"))


@query("A32_co_mention_lift", _LIFT)
def a32(t: Tables) -> DataFrame:
    return co_mentions(t)


@query(
    "O12_edge_selection",
    f"SELECT a, b, weight, lift, greatest(0, n - 40) AS hidden FROM (SELECT *, CAST(count(*) OVER () AS BIGINT) AS n FROM ({_LIFT}) "
    f"WHERE weight >= 2 AND lift >= 1.1) ORDER BY weight DESC, a, b LIMIT 40",
)
def o12(t: Tables) -> DataFrame:
    found = graphs.written(co_mentions(t))
    top, hidden = graphs.strongest_edges(found, 2, 1.1, 40)
    return top.withColumn("hidden", F.lit(hidden).cast("long"))


@query(
    "A34_degrees",
    f"SELECT id, CAST(sum(weight) AS BIGINT) AS degree, CAST(count(*) AS BIGINT) AS links FROM (SELECT a AS id, weight FROM ({_PAIRS}) "
    f"UNION ALL SELECT b, weight FROM ({_PAIRS})) GROUP BY 1",
)
def a34(t: Tables) -> DataFrame:
    return graphs.degrees(co_mentions(t))


_ERAS = ("early", "late")
#: Events as mentions: a day is a recording, the user is who is named.
_MENTIONS = """SELECT CAST(ts AS DATE) AS recording, 86400000 AS duration, CASE WHEN day(ts) <= 15 THEN 'early' ELSE 'late' END AS era,
    user_id AS name, epoch_us(ts) // 1000 % 86400000 AS t, CAST(CASE WHEN event_type = 'view' THEN 0.5 ELSE 1.0 END AS DOUBLE) AS weight FROM events"""
_NEAR = """SELECT {by} x.name AS a, y.name AS b, sum(x.weight * y.weight) AS weight FROM {of} x JOIN {of} y
    ON x.recording = y.recording {on} AND x.name < y.name AND abs(x.t - y.t) <= 120000 GROUP BY ALL"""


def _windowed_sql(draws: int) -> str:
    moved = f"""SELECT * REPLACE ((t + ('0x' || substr(md5('7|' || draw || '|' || recording || '|' || name), 1, 12))::BIGINT % duration) % duration AS t)
        FROM m, (SELECT unnest(range({draws})) AS draw)"""
    return f"""WITH m AS ({_MENTIONS}), w AS ({_NEAR.format(by="x.era,", of="m", on="")}),
    s AS (SELECT a, b, sum(weight) AS weight, {", ".join(f"coalesce(sum(weight) FILTER (era = '{e}'), 0.0) AS era_{e}" for e in _ERAS)} FROM w GROUP BY 1, 2 HAVING sum(weight) >= 3),
    v AS MATERIALIZED ({moved}), c AS ({_NEAR.format(by="x.draw,", of="v", on="AND x.draw = y.draw")}),
    f AS (SELECT a, b, sum(c.weight) AS total, count(*) FILTER (c.weight > s.weight + 1e-9) AS above, count(*) FILTER (abs(c.weight - s.weight) <= 1e-9) AS equal FROM c JOIN s USING (a, b) GROUP BY 1, 2)
    SELECT a, b, weight, {", ".join(f"era_{e}" for e in _ERAS)}, round(coalesce(total, 0) / {draws}.0, 6) AS baseline, round(weight / nullif(coalesce(total, 0) / {draws}.0, 0), 6) AS lift,
    round(100.0 * ({draws} - coalesce(above, 0) - coalesce(equal, 0) + coalesce(equal, 0) / 2) / {draws}, 6) AS percentile, round((1 + coalesce(above, 0) + coalesce(equal, 0)) / {draws + 1}.0, 6) AS p
    FROM s LEFT JOIN f USING (a, b)"""


@query("A32_G20_windowed_co_mentions", _windowed_sql(20))
def a32_windowed(t: Tables) -> DataFrame:
    """Names within two minutes of each other, by era, against twenty seeded circular shifts; weights of three or more."""
    ms = F.unix_millis(F.col("ts").cast("timestamp")) % 86_400_000
    rows = t.events.select(
        F.to_date("ts").alias("recording"), F.lit(86_400_000).cast("long").alias("duration"), F.when(F.dayofmonth("ts") <= 15, "early").otherwise("late").alias("era"),
        F.col("user_id").alias("name"), ms.alias("t"), F.when(F.col("event_type") == "view", 0.5).otherwise(1.0).alias("weight"),
    )
    found = networks.co_mentions(rows, list(_ERAS), draws=20, seed=7)
    return found.select("a", "b", "weight", *[f"era_{e}" for e in _ERAS], *[F.round(c, 6).alias(c) for c in ("baseline", "lift", "percentile", "p")])


_TRACKED = ("the", "la", "und", "license", "reserved")
_LIST = ", ".join(f"'{n}'" for n in _TRACKED)
_DATED = "SELECT doc_id, text, o_orderdate FROM documents JOIN orders ON o_orderkey = doc_id"
_COUNTED = rf"""WITH l AS (SELECT o_orderdate, unnest(string_split(text, chr(10))) AS line FROM ({_DATED})),
    w AS (SELECT strftime(o_orderdate, '{{form}}') AS period, list_filter(regexp_split_to_array(lower(line), '[^\p{{{{L}}}}\p{{{{N}}}}]+'), lambda x: x <> '') AS t, contains(line, '?') AS question FROM l),
    k AS (SELECT period, name, CAST(sum(len(list_filter(t, lambda x: x = name))) AS BIGINT) AS n, CAST(sum(CASE WHEN question THEN 0 ELSE len(list_filter(t, lambda x: x = name)) END) AS BIGINT) AS strict
          FROM w, (SELECT unnest([{_LIST}]) AS name) GROUP BY 1, 2),
    d AS (SELECT period, sum(len(t)) AS words FROM w GROUP BY 1)"""


def _named(t: Tables, form: str) -> tuple[DataFrame, DataFrame]:
    """(period, name, n, strict) and (period, words) of the dated documents; strict leaves question-shaped lines out."""
    dated = t.documents.join(t.orders.select(F.col("o_orderkey").alias("doc_id"), "o_orderdate"), "doc_id")
    lines = dated.select(F.date_format("o_orderdate", form).alias("period"), F.explode(F.split("text", "\n")).alias("line"))
    words = lines.select("period", F.contains("line", F.lit("?")).alias("question"), F.array_remove(F.split(F.lower("line"), r"[^\p{L}\p{N}]+"), "").alias("t"))
    count = lambda name: F.size(F.filter("t", lambda x: x == name))
    hits = [F.struct(F.lit(n).alias("name"), count(n).alias("n")) for n in _TRACKED]
    named = words.select("period", "question", F.explode(F.array(*hits)).alias("h"))
    counts = named.groupBy("period", "h.name").agg(F.sum("h.n").alias("n"), F.sum(F.when(F.col("question"), 0).otherwise(F.col("h.n"))).cast("long").alias("strict"))
    return counts, words.groupBy("period").agg(F.sum(F.size("t")).alias("words"))


@query(
    "T16_monthly_rates",
    _COUNTED.format(form="%Y-%m") + " SELECT period, name, n, round(10000.0 * n / nullif(words, 0), 6) AS rate, round(10000.0 * strict / nullif(words, 0), 6) AS strict_rate, "
    "round(n / nullif(sum(n) OVER (PARTITION BY period), 0), 6) AS share FROM k JOIN d USING (period)",
)
def t16_monthly(t: Tables) -> DataFrame:
    """Matches of each tracked name per 10,000 words by month, with and without question-shaped lines, and its share of the month's."""
    counts, words = _named(t, "yyyy-MM")
    totals = counts.groupBy("period").agg(F.sum("n").alias("all"))
    rate = lambda c: F.round(10_000.0 * F.col(c) / F.when(F.col("words") > 0, F.col("words")), 6)
    found = counts.join(words, "period").join(totals, "period")
    return found.select("period", "name", "n", rate("n").alias("rate"), rate("strict").alias("strict_rate"), F.round(F.col("n") / F.when(F.col("all") > 0, F.col("all")), 6).alias("share"))


@query(
    "A33_annual_names",
    _COUNTED.format(form="%Y") + f""", s AS (SELECT period, CAST(sum(n) AS BIGINT) AS matches, max(n) AS top, count(*) FILTER (n >= 5) AS active_names, sum(CASE WHEN n > 0 THEN n * ln(n) END) AS h FROM k GROUP BY 1),
    g AS (SELECT count(DISTINCT name) FILTER (n > 0) AS known FROM k)
    SELECT period, CAST(words AS BIGINT) AS words, matches, round(10000.0 * matches / words, 6) AS rate, round(CASE WHEN matches > 0 AND known > 1 THEN (ln(matches) - h / matches) / ln(known) END, 6) AS spread,
    round(top / nullif(matches, 0), 6) AS top_share, active_names FROM d JOIN s USING (period), g""",
)
def a33_annual(t: Tables) -> DataFrame:
    """Yearly words, rate per 10,000 words, evenness, top share and active names (five matches or more)."""
    counts, words = _named(t, "yyyy")
    found = networks.period_rates(counts, words, "period")
    return found.select("period", "words", "matches", *[F.round(c, 6).alias(c) for c in ("rate", "spread", "top_share")], "active_names")


_CO_SUPPLIED = "SELECT a.l_suppkey AS a, b.l_suppkey AS b, count(DISTINCT a.l_partkey) AS weight FROM lineitem a JOIN lineitem b ON a.l_partkey = b.l_partkey AND a.l_suppkey < b.l_suppkey GROUP BY 1, 2 HAVING count(DISTINCT a.l_partkey) >= 2"


@query(
    "G3_weighted_components",
    f"WITH RECURSIVE w AS MATERIALIZED ({_CO_SUPPLIED}), e AS (SELECT a, b FROM w UNION SELECT b, a FROM w), r(id, c) AS (SELECT a, a FROM e UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id), "
    "n AS (SELECT id, min(c) AS component FROM r GROUP BY 1), s AS (SELECT component, sum(weight) AS weight FROM w JOIN n ON id = a GROUP BY 1), m AS (SELECT component, count(*) AS members FROM n GROUP BY 1) "
    "SELECT component, CAST(members AS BIGINT) AS members, CAST(weight AS BIGINT) AS weight, row_number() OVER (ORDER BY weight DESC, component) AS place FROM s JOIN m USING (component)",
)
def g3_weighted(t: Tables) -> DataFrame:
    """Components of the suppliers that share two parts or more, the heaviest first."""
    held = graphs.written(t.lineitem.select("l_partkey", "l_suppkey").distinct())
    pairs = held.withColumnRenamed("l_suppkey", "a").join(held.withColumnRenamed("l_suppkey", "b"), "l_partkey").where("a < b")
    edges = graphs.written(pairs.groupBy("a", "b").agg(F.count("*").alias("weight")).where("weight >= 2"))
    return graphs.weighted_components(edges)


@query(
    "G20_shift_baseline",
    """WITH m AS (SELECT DISTINCT l_orderkey AS k, l_suppkey % 10 AS g, l_suppkey FROM lineitem),
    s AS (SELECT (k + 97 - lo) % (hi - lo + 1) + lo AS k, g FROM m, (SELECT min(k) AS lo, max(k) AS hi FROM m))
    SELECT m.g AS a, s.g AS b, CAST(count(*) AS BIGINT) AS n FROM m JOIN s USING (k) WHERE m.g < s.g GROUP BY 1, 2""",
)
def g20(t: Tables) -> DataFrame:
    """Co-mentions expected by chance: one side shifted by a fixed step around the axis, whose end meets its start."""
    m = t.lineitem.select(F.col("l_orderkey").alias("k"), "l_suppkey").distinct().select("k", (F.col("l_suppkey") % 10).alias("g"))
    lo, hi = t.lineitem.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    shifted = m.select(((F.col("k") + 97 - lo) % (hi - lo + 1) + lo).alias("k"), F.col("g").alias("b"))
    return m.withColumnRenamed("g", "a").join(shifted, "k").where("a < b").groupBy("a", "b").agg(F.count("*").alias("n"))


@query(
    "A35_fingerprint_summary",
    "WITH h AS (SELECT vec_id, label, list_sum([CASE WHEN embedding[i] > 0 THEN 1::BIGINT << (i - 1) ELSE 0 END FOR i IN range(1, "
    "33)])::BIGINT AS h FROM embeddings) SELECT a.label, CAST(min(bit_count(xor(a.h, b.h))) AS INT) AS best, CAST(count(*) FILTER (a.h "
    "= b.h) AS BIGINT) AS exact FROM h a JOIN h b ON a.label = b.label AND a.vec_id < b.vec_id WHERE bit_count(xor(a.h, b.h)) <= 10 "
    "GROUP BY 1",
)
def a35(t: Tables) -> DataFrame:
    pairs = vectors.hamming_pairs(vectors.sign_hash(t.embeddings, "embedding", 32), "vec_id", "label", "h", 32, 10)
    return pairs.join(t.embeddings.select(F.col("vec_id").alias("a"), "label"), "a").groupBy("label").agg(F.min("distance").alias("best"), F.count_if(F.col("distance") == 0).alias("exact"))


@query(
    "G11_nearest_standardised",
    "SELECT a, b, round(d, 5) AS distance FROM (SELECT a.vec_id AS a, b.vec_id AS b, sqrt(list_sum([(x[1] - x[2]) ** 2 FOR x IN "
    "list_zip(a.v, b.v)])) AS d, row_number() OVER (PARTITION BY a.vec_id "
    "ORDER BY sqrt(list_sum([(x[1] - x[2]) ** 2 FOR x IN list_zip(a.v, b.v)])), b.vec_id) AS n "
    "FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) a JOIN (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) b "
    "ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0) WHERE n <= 5",
)
def g11(t: Tables) -> DataFrame:
    """Five exact Euclidean neighbours of the query rows."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    return vectors.euclidean_neighbours(t.embeddings.select("vec_id", v.alias("v")), t.embeddings.where("vec_id % 50 = 0").select("vec_id", v.alias("v")), "vec_id", "v", 5).select("a", "b", F.round("distance", 5).alias("distance"))


#: The vectors of the tables are random: no two are as alike as LEVELS asks, so these stand in for them.
_LEVELS = (0.2, 0.25, 0.3)
_EDGES = f"""
    WITH v AS (SELECT vec_id, label, coalesce(text, '') AS text, [x / sqrt(list_sum([y * y FOR y IN embedding::DOUBLE[]])) FOR x IN embedding::DOUBLE[]] AS v
               FROM embeddings LEFT JOIN documents ON doc_id = vec_id),
    common AS (SELECT label FROM embeddings GROUP BY 1 HAVING count(*) <= greatest(5, (SELECT count(*) FROM embeddings) * 0.1)),
    f AS (SELECT vec_id, v, CASE WHEN label IN (FROM common) THEN [label] ELSE []::INT[] END AS ents,
                 regexp_extract_all(text, '\\b(?:19|20)\\d{{2}}\\b') AS years,
                 [x FOR x IN [CASE WHEN regexp_matches(lower(text), '\\b(?:married|marriage|wedding)\\b') THEN 'm' END,
                              CASE WHEN regexp_matches(lower(text), '\\b(?:divorced?|divorcing|separated)\\b') THEN 'd' END] IF x IS NOT NULL] AS moves FROM v),
    p AS (SELECT a.vec_id AS a, b.vec_id AS b, list_dot_product(a.v, b.v) AS similarity,
                 CASE WHEN len(a.moves) > 0 AND len(b.moves) > 0 AND NOT list_has_any(a.moves, b.moves) THEN 1.01
                      WHEN len(a.years) > 0 AND len(b.years) > 0 AND NOT list_has_any(a.years, b.years) THEN 1.01
                      WHEN list_has_any(a.ents, b.ents) THEN {_LEVELS[0]} WHEN list_has_any(a.years, b.years) THEN {_LEVELS[1]} ELSE {_LEVELS[2]} END AS needed
          FROM f a JOIN f b ON a.vec_id < b.vec_id)
    SELECT a, b, round(similarity, 5) AS similarity FROM p WHERE similarity >= needed"""


def _accounts(t: Tables) -> DataFrame:
    """Vectors as accounts: their class is the entity, the text is the document's of the same number, whose facts alone are sent."""
    texts = t.documents.select(F.col("doc_id").alias("vec_id"), *vectors.text_facts(F.col("text")))
    return t.embeddings.join(texts, "vec_id", "left").select("vec_id", "embedding", "years", "transitions", F.array(F.col("label").cast("string")).alias("entities"))


def _facts(t: Tables) -> DataFrame:
    return vectors.account_facts(_accounts(t), "vec_id", "embedding")


@query("G6_account_edges", _EDGES)
def g6_edges(t: Tables) -> DataFrame:
    return vectors.account_edges(_accounts(t), "vec_id", "embedding", _LEVELS).withColumn("similarity", F.round("similarity", 5))


@query(
    "G6_directed_edges",
    f"WITH e AS ({_EDGES}), u AS (SELECT vec_id, [x / sqrt(list_sum([y * y FOR y IN embedding::DOUBLE[]])) FOR x IN embedding::DOUBLE[]] AS v FROM embeddings), "
    "n AS (SELECT x.vec_id AS a, y.vec_id AS b, row_number() OVER (PARTITION BY x.vec_id ORDER BY list_dot_product(x.v, y.v) DESC, y.vec_id) AS place FROM u x, u y) "
    "SELECT a, b, similarity FROM e JOIN n USING (a, b) WHERE place <= 32",
)
def g6_directed(t: Tables) -> DataFrame:
    """The edges that ask for a merge: to a greater id among the row's 32 best, itself included."""
    return vectors.best_edges(_facts(t), _LEVELS, 32).where("a < b").select("a", "b", F.round("similarity", 5).alias("similarity"))


@query("G6_complete_link")
def g6(t: Tables) -> DataFrame:
    """Complete-link groups of at most 24 accounts, every pair of which is as similar as it has to be; directed edges ask."""
    return vectors.account_groups(_facts(t), _LEVELS, 32, 24)


@query("A37_G9_group_stats")
def a37(t: Tables) -> DataFrame:
    """Id (digest of the members' ids), members, least similarity, medoid and distinct recordings of each group."""
    facts = _facts(t)
    groups = vectors.account_groups(facts, _LEVELS, 32, 24)
    recordings = t.documents.select(F.col("doc_id").alias("id"), F.col("source").alias("recording"))
    return vectors.group_figures(vectors.inner_edges(groups, facts), groups, recordings)


@query(
    "G22_fixed_hop",
    "SELECT o_orderkey, CAST(s AS BIGINT) AS start, CAST(least(s + 30, d) AS BIGINT) AS stop "
    "FROM (SELECT o_orderkey, d, unnest(range(0, d, 25)) AS s FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) // 1000 AS "
    "d FROM orders)) WHERE d - s >= 10 OR s = 0",
)
def g22(t: Tables) -> DataFrame:
    """Chunks of 30 every 25; a tail under 10 goes, unless it is all there is."""
    d = t.orders.select("o_orderkey", F.expr("cast(o_totalprice as bigint) div 1000").alias("d"))
    return d.where("d > 0").select("o_orderkey", "d", F.explode(F.sequence(F.lit(0).cast("long"), F.col("d") - 1, F.lit(25).cast("long"))).alias("start")).where("d - start >= 10 or start = 0").select("o_orderkey", "start", F.least(F.col("start") + 30, "d").alias("stop"))


@query(
    "G23_selection_planner",
    "SELECT l_partkey, arg_min(l_orderkey, (l_quantity, l_orderkey)) AS chosen, min(l_quantity) AS size FROM lineitem "
    "WHERE l_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45) GROUP BY 1",
)
def g23(t: Tables) -> DataFrame:
    """The smallest rendition of every part that no other source covers."""
    covered = t.lineitem.where("l_quantity > 45").select("l_partkey").distinct()
    return t.lineitem.join(covered, "l_partkey", "left_anti").groupBy("l_partkey").agg(F.min_by("l_orderkey", F.struct("l_quantity", "l_orderkey")).alias("chosen"), F.min("l_quantity").alias("size"))


@query(
    "G26_identity_projection",
    "SELECT conv_id, turn, CAST(turn * 1000 AS BIGINT) AS start_ms, CAST(least(turn * 1000 + length(text), ends) AS BIGINT) AS end_ms, turn * 1000 + length(text) > ends AS overran "
    "FROM (SELECT *, count(*) OVER (PARTITION BY conv_id) * 1000 - 500 AS ends FROM conversations) WHERE turn * 1000 < ends",
)
def g26(t: Tables) -> DataFrame:
    """Turns on the time line of their recording, not shifted: what runs over its end is cut there, what begins behind it goes."""
    ends = t.conversations.groupBy("conv_id").agg((F.count("*") * 1000 - 500).alias("ends"))
    start = F.col("turn") * 1000
    end = start + F.char_length("text")
    rows = t.conversations.join(ends, "conv_id").where(start < F.col("ends"))
    return rows.select("conv_id", "turn", start.cast("long").alias("start_ms"), F.least(end, F.col("ends")).cast("long").alias("end_ms"), (end > F.col("ends")).alias("overran"))


@query(
    "G27_cannot_link",
    "SELECT least(a, b) AS lo, greatest(a, b) AS hi, CAST(count(*) AS BIGINT) AS n "
    "FROM (SELECT user_id AS a, CAST(json_extract(props, '$.k') AS BIGINT) AS b FROM events) WHERE a <> b GROUP BY 1, 2 "
    "HAVING count(*) > 1",
)
def g27(t: Tables) -> DataFrame:
    e = t.events.select(F.col("user_id").alias("a"), F.get_json_object("props", "$.k").cast("long").alias("b")).where("a <> b")
    return e.groupBy(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).agg(F.count("*").alias("n")).where("n > 1")


_POLICY = folds.SpanPolicy(direct=200_000, least=120_000, target=300_000, most=420_000, reach=40_000, padding=5_000, most_spans=16)
_TOTAL_S = "CASE WHEN user_id % 10 = 0 THEN 150000 ELSE 2592000 END"
_SPANS = f"""
    WITH RECURSIVE m AS (SELECT user_id AS key, CAST({_TOTAL_S} AS BIGINT) AS total, epoch_us(ts) // 1000000 - 1704067200 AS at, value AS confidence, event_type AS kind FROM events),
    k AS (SELECT DISTINCT key, total FROM m),
    r AS (SELECT key, total, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS start, CAST('' AS VARCHAR) AS reason FROM k
    UNION ALL SELECT w.key, w.total, w.n + 1, coalesce(arg_min(m.at, (abs(m.at - wanted), -confidence, m.at, kind)), any_value(greatest(w.least, wanted))),
              coalesce('candidate_' || arg_min(kind, (abs(m.at - wanted), -confidence, m.at, kind)), 'fixed_target')
              FROM (SELECT *, start + {_POLICY.least} AS least, least(start + {_POLICY.most}, total - {_POLICY.least}) AS latest, least(start + {_POLICY.target}, start + {_POLICY.most}, total - {_POLICY.least}) AS wanted
                    FROM r WHERE total > {_POLICY.direct} AND total - start > {_POLICY.most}) w
              LEFT JOIN m ON m.key = w.key AND m.at BETWEEN w.least AND w.latest AND abs(m.at - wanted) <= {_POLICY.reach} GROUP BY w.key, w.total, w.n)
    """
_SPAN_ROWS = f"""{_SPANS}, p AS (SELECT key, n, start, coalesce(lead(start) OVER w, total) AS stop, coalesce(lead(reason) OVER w, 'recording_end') AS reason, total, CASE WHEN total > {_POLICY.direct} THEN {_POLICY.padding} ELSE 0 END AS padding
    FROM r WINDOW w AS (PARTITION BY key ORDER BY n))"""


def _spans(t: Tables) -> DataFrame:
    """Events as boundary candidates of their user's recording; every tenth recording is short enough for one span."""
    total = F.when(F.col("user_id") % 10 == 0, 150_000).otherwise(2_592_000).cast("long")
    at = F.expr("unix_seconds(cast(ts as timestamp)) - 1704067200")
    marks = t.events.select(F.col("user_id").alias("key"), total.alias("total"), at.alias("at"), F.col("value").alias("confidence"), F.col("event_type").alias("kind"))
    return folds.plan_spans(marks, _POLICY)


@query("G21_span_planner", f'{_SPAN_ROWS} SELECT key, n, start, stop AS "end", greatest(0, start - padding) AS padded_start, least(total, stop + padding) AS padded_end, reason FROM p')
def g21(t: Tables) -> DataFrame:
    return _spans(t).drop("confidence")


@query(
    "G21_coverage",
    f"""{_SPAN_ROWS} SELECT key, CAST(count(*) AS BIGINT) AS spans, CAST(0 AS BIGINT) AS first, any_value(total) AS last, any_value(total) AS core, CAST(0 AS BIGINT) AS gap, CAST(0 AS BIGINT) AS overlap,
    CAST(sum(least(total, stop + padding) - greatest(0, start - padding)) AS BIGINT) AS analysed FROM p GROUP BY 1""",
)
def g21_coverage(t: Tables) -> DataFrame:
    """The proof of coverage: every recording's cores begin at 0, end at its end and leave neither gap nor overlap."""
    return folds.span_coverage(_spans(t))


@query(
    "G25_payload_audit",
    "SELECT o_orderstatus, CAST(sum(greatest(0, least(b, 400) - greatest(a, 100))) AS BIGINT) AS bytes "
    "FROM (SELECT o_orderstatus, CAST(floor(o_totalprice) AS BIGINT) // 1000 AS a, CAST(floor(o_totalprice) AS BIGINT) // 1000 + 20 AS "
    "b FROM orders) GROUP BY 1",
)
def g25(t: Tables) -> DataFrame:
    a = F.expr("cast(o_totalprice as bigint) div 1000")
    inside = F.greatest(F.lit(0), F.least(a + 20, F.lit(400)) - F.greatest(a, F.lit(100)))
    return t.orders.groupBy("o_orderstatus").agg(F.sum(inside).cast("long").alias("bytes"))


@query(
    "G9_attach_groups",
    "SELECT e.user_id, e.event_type, CASE WHEN g.n = 1 AND g.d = sha256(e.event_type) THEN g.grp END AS grp "
    "FROM (SELECT DISTINCT user_id, event_type FROM events) e LEFT JOIN (SELECT user_id, min(grp) AS grp, count(*) AS n, min(d) AS d "
    "FROM (SELECT user_id, user_id // 10 AS grp, sha256(CASE WHEN user_id % 3 = 0 THEN 'view' ELSE 'click' END) AS d "
    "FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 4 <> 0) GROUP BY 1) g USING (user_id)",
)
def g9(t: Tables) -> DataFrame:
    """Group membership attached where it is unique and its digest still agrees; stale or doubled rows fall back to none."""
    members = t.events.select("user_id").distinct().where("user_id % 4 <> 0").select("user_id", F.expr("user_id div 10").alias("grp"), F.sha2(F.when(F.col("user_id") % 3 == 0, "view").otherwise("click").cast("binary"), 256).alias("d"))
    g = members.groupBy("user_id").agg(F.min("grp").alias("grp"), F.count("*").alias("n"), F.min("d").alias("d"))
    good = (F.col("n") == 1) & (F.col("d") == F.sha2(F.col("event_type").cast("binary"), 256))
    return t.events.select("user_id", "event_type").distinct().join(g, "user_id", "left").select("user_id", "event_type", F.when(good, F.col("grp")).alias("grp"))


_PIECE = 1 << 20
_FILES = f"""f AS MATERIALIZED (SELECT l_suppkey AS payload, l_orderkey AS k, l_linenumber AS n, size, l_returnflag AS flag, l_quantity AS q, "end" - size AS begin, "end", total, ("end" - size) // {_PIECE} AS first, ("end" - 1) // {_PIECE} AS last
    FROM (SELECT *, CAST(sum(size) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, size, l_returnflag, l_quantity ROWS UNBOUNDED PRECEDING) AS BIGINT) AS "end", CAST(sum(size) OVER (PARTITION BY l_suppkey) AS BIGINT) AS total
          FROM (SELECT *, CAST(floor(l_extendedprice * 100) AS BIGINT) AS size FROM lineitem))),
    v AS MATERIALIZED (SELECT DISTINCT payload, unnest(range(first, last + 1)) AS p FROM f WHERE flag = 'R' OR q > 45)"""


def _payloads(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Order lines as files of their supplier's payload; what was returned or is large has been verified, by two sources."""
    files = t.lineitem.select(F.col("l_suppkey").alias("payload"), F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.floor(F.col("l_extendedprice") * 100).alias("size"), "l_returnflag", "l_quantity")
    files = graphs.written(pieces.spans(files, "payload", ["k", "n", "size", "l_returnflag", "l_quantity"], "size", _PIECE))
    verified = pieces.merged(*[pieces.bitmaps(files.where(c), "payload") for c in ("l_returnflag = 'R'", "l_quantity > 45")])
    return files, graphs.written(verified)


@query(
    "G25_A36_file_coverage",
    f"""WITH {_FILES}, c AS (SELECT payload, k, n, begin, sum(least("end", (p + 1) * {_PIECE}) - greatest(begin, p * {_PIECE})) AS covered FROM (SELECT payload, k, n, begin, "end", unnest(range(first, last + 1)) AS p FROM f) JOIN v USING (payload, p) GROUP BY 1, 2, 3, 4)
    SELECT payload, k, n, begin, size AS bytes, CAST(coalesce(covered, 0) AS BIGINT) AS covered, last - first + 1 AS pieces, least((last + 1) * {_PIECE}, total) - first * {_PIECE} AS capacity FROM f LEFT JOIN c USING (payload, k, n, begin)""",
)
def g25_files(t: Tables) -> DataFrame:
    """Bytes of each file in verified pieces, and the capacity of the pieces that it touches. Line numbers repeat in the tables; where a file begins tells them apart."""
    files, verified = _payloads(t)
    return pieces.covered(files, "payload", ["k", "n", "begin"], verified, _PIECE)


@query(
    "G25_payload_coverage",
    f"""WITH {_FILES}, t AS (SELECT payload, any_value(total) AS bytes, (any_value(total) - 1) // {_PIECE} + 1 AS pieces FROM f GROUP BY 1)
    SELECT payload, bytes, pieces, CAST(count(p) AS BIGINT) AS verified, CAST(coalesce(sum(least((p + 1) * {_PIECE}, bytes) - p * {_PIECE}), 0) AS BIGINT) AS covered FROM t LEFT JOIN v USING (payload) GROUP BY 1, 2, 3""",
)
def g25_payloads(t: Tables) -> DataFrame:
    files, verified = _payloads(t)
    return pieces.payloads(files, "payload", verified, _PIECE)
