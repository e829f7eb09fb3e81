"""T*, K10: text, search and retrieval."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.text import tokens
from weftline.operators import entities, folds, fulltext, graphs
from weftline.operators.text_index import TextIndex
from weftline.plans.folds import pack_sql
from weftline.plans.registry import Tables, query
from weftline.sources import publish

TOKENS = r"list_filter(regexp_split_to_array(strip_accents(lower(text)), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
_BM25 = """WITH d AS (SELECT {key} AS id, {tokens} AS t FROM {table} WHERE {where}), s AS (SELECT id, len(t) AS n, {tfs} FROM d), g AS (SELECT count(*) AS n, avg(n) AS mean, {dfs} FROM s)
SELECT s.id AS {alias}, round({score}, 6) AS score FROM s, g WHERE {any} ORDER BY score DESC, 1 LIMIT {limit}"""


def _bm25_sql(table: str, key: str, alias: str, words: list[str], limit: int, where: str = "true") -> str:
    return _BM25.format(
        table=table, key=key, alias=alias, limit=limit, where=where, tokens=TOKENS,
        tfs=", ".join(f"len(list_filter(t, lambda x: x = '{w}')) AS tf{i}" for i, w in enumerate(words)),
        dfs=", ".join(f"count(*) FILTER (tf{i} > 0) AS df{i}" for i in range(len(words))),
        score=" + ".join(f"ln(1.0 + (g.n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * s.n / mean))" for i in range(len(words))),
        any=" OR ".join(f"tf{i} > 0" for i in range(len(words))),
    )


def _index(t: Tables, table: str, rows: DataFrame, facets: tuple[str, ...] = (), every: int = 25_000) -> TextIndex:
    """The stored index of a table's rows (key, text, facets), built by the first query that asks while its files are as they are."""
    at = hashlib.sha256(json.dumps([t.folder, table, every, publish.fingerprint(t.spark, f"{t.folder}/{table}.parquet")]).encode()).hexdigest()
    index = TextIndex(t.spark, f"{graphs.shared_folder(t.spark)}/text-index-{at[:24]}")
    if not index.segments():
        index.add(rows, "key", "text", facets, every)
    return index


def _documents(t: Tables) -> TextIndex:
    return _index(t, "documents", t.documents.select(F.col("doc_id").alias("key"), "text", "lang", "source", "n_chars"), ("lang", "source", "n_chars"))


def _turns(t: Tables) -> TextIndex:
    """A segment for about every thousand turns."""
    return _index(t, "conversations", t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("key"), "text"), every=1_000)


@query("T1_bm25_documents", _bm25_sql("documents", "doc_id", "doc_id", ["worthless", "the", "reserved"], 50))
def t1(t: Tables) -> DataFrame:
    return _documents(t).search(["worthless", "the", "reserved"], 50, digits=6).select(F.col("key").alias("doc_id"), "score")


@query("T2_bm25_turns", _bm25_sql("conversations", "conv_id * 1000 + turn", "turn_id", ["the", "and"], 100))
def t2(t: Tables) -> DataFrame:
    return _turns(t).search(["the", "and"], 100, digits=6).select(F.col("key").alias("turn_id"), "score")


@query("T3_bm25_filtered", _bm25_sql("documents", "doc_id", "doc_id", ["license", "mit"], 200, "lang = 'en' AND source IN ('src0', 'src1', 'src2') AND n_chars > 200"))
def t3(t: Tables) -> DataFrame:
    found = _documents(t).search_among([["license", "mit"]], "lang = 'en' and source in ('src0', 'src1', 'src2') and n_chars > 200", digits=6)
    return found.select(F.col("key").alias("doc_id"), "score").orderBy(F.desc("score"), "doc_id").limit(200)


@query("T4_tokeniser", f"SELECT doc_id, CAST(len({TOKENS}) AS INT) AS n, CAST(len(list_distinct({TOKENS})) AS INT) AS kinds FROM documents")
def t4(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", tokens(F.col("text")).alias("t")).select("doc_id", F.size("t").alias("n"), F.size(F.array_distinct("t")).alias("kinds"))


@query(
    "T4_postings",
    f"SELECT term, CAST(count(*) AS BIGINT) AS tf, CAST(count(DISTINCT id) AS BIGINT) AS df "
    f"FROM (SELECT doc_id AS id, unnest({TOKENS}) AS term FROM documents) GROUP BY 1",
)
def t4b(t: Tables) -> DataFrame:
    return fulltext.postings(t.documents, "doc_id", "text").groupBy("term").agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))


@query(
    "T5_search_records",
    "SELECT conv_id, turn, 'conv-' || CAST(conv_id AS VARCHAR) || '#turn-' || CAST(turn AS VARCHAR) AS url, role, CAST(length(text) AS "
    "INT) AS size FROM conversations WHERE trim(text) <> ''",
)
def t5(t: Tables) -> DataFrame:
    url = F.concat(F.lit("conv-"), F.col("conv_id").cast("string"), F.lit("#turn-"), F.col("turn").cast("string"))
    return t.conversations.where(F.trim("text") != "").select("conv_id", "turn", url.alias("url"), "role", F.char_length("text").alias("size"))


#: A query and its aliases, each searched for by itself.
_ALIASES = ("license", "licence", "licensed", "rights")


@query(
    "T6_faceted_search",
    "WITH " + ", ".join(f"q{i} AS (" + _bm25_sql("documents", "doc_id", "doc_id", [q], 200, "lang IN ('en', 'de')") + ")" for i, q in enumerate(_ALIASES))
    + " SELECT doc_id, max(score) AS score, string_agg(q, ',' ORDER BY q) AS matched FROM (" + " UNION ALL ".join(f"SELECT doc_id, score, '{q}' AS q FROM q{i}" for i, q in enumerate(_ALIASES)) + ") GROUP BY 1",
)
def t6(t: Tables) -> DataFrame:
    """The 200 best of each alias among two languages, merged by document: its best score and the aliases it matched."""
    found = _documents(t).search_among([[q] for q in _ALIASES], "lang in ('en', 'de')", digits=6)
    # Each task keeps 200 rows of a query before they meet.
    best = found.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "key"))).where("place <= 200")
    alias = F.array(*map(F.lit, _ALIASES))[F.col("query")]
    return best.groupBy(F.col("key").alias("doc_id")).agg(F.max("score").alias("score"), F.array_join(F.array_sort(F.collect_set(alias)), ",").alias("matched"))


@query(
    "T6_facets",
    f"SELECT source, lang, CAST(count(*) AS BIGINT) AS n FROM (SELECT source, lang, {TOKENS} AS t FROM documents) WHERE list_has_any(t, {list(_ALIASES)}) GROUP BY 1, 2",
)
def t6_facets(t: Tables) -> DataFrame:
    """How many of the documents that match any alias each facet has."""
    index = _documents(t)
    hits = index.postings(_ALIASES).select("segment", "cell", "key").distinct()
    return index.docs().join(hits, ["segment", "cell", "key"]).groupBy("source", "lang").agg(F.count("*").alias("n"))


@query(
    "T7_snippets",
    "SELECT doc_id, regexp_replace(substr(text, greatest(instr(lower(text), 'licensed') - 40, 1), 88), '(licensed)', "
    "'<mark>\\1</mark>', 'gi') AS snippet FROM documents WHERE instr(lower(text), 'licensed') > 0",
)
def t7(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", fulltext.snippet(F.col("text"), "licensed").alias("snippet")).where("snippet is not null")


_NAMES = ["Apache License", "MIT License", "GNU General Public License", "License"]
_MENTION = r"regexp_extract_all(text, '(GNU General Public License|Apache License|MIT License|License)(?:[^\p{L}\p{N}]|$)', 1)"


@query(
    "T8_T9_mentions",
    f"SELECT name, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT doc_id) AS BIGINT) AS docs "
    f"FROM (SELECT doc_id, unnest({_MENTION}) AS name FROM documents) GROUP BY 1 HAVING count(DISTINCT doc_id) >= 2",
)
def t8(t: Tables) -> DataFrame:
    """Whole-word mentions of gazetteer names, the longest first, kept where two documents or more have them."""
    found = t.documents.select("doc_id", F.explode(fulltext.mentions(F.col("text"), _NAMES)).alias("name"))
    return found.groupBy("name").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs")).where("docs >= 2")


_CAPITALISED = rf"""SELECT doc_id, unnest(list_distinct(list_concat(regexp_extract_all(text, '{entities.PHRASE}', 0), regexp_extract_all(text, '{entities.INTRODUCED}', 1)))) AS label FROM documents""".replace("[ '-]", "[ ''-]")
_DISCOVERED = rf"""SELECT label, count(DISTINCT doc_id) AS docs FROM ({_CAPITALISED}) WHERE NOT regexp_matches(label, '^(?:{entities.LEAD_IN})\b', 'i') AND NOT regexp_matches(label, '\b(?:{entities.CALENDAR})\b', 'i') GROUP BY 1 HAVING count(DISTINCT doc_id) >= 2"""


@query("T8_discovered_phrases", _DISCOVERED)
def t8_discovered(t: Tables) -> DataFrame:
    return entities.discovered(t.documents, "doc_id", "text")


@query("T9_gazetteer_mentions")
def t9(t: Tables) -> DataFrame:
    """Entities (the words that open a document as speakers, places, platforms, discovered phrases) with the documents that mention them, and how often."""
    speakers = t.documents.select(F.regexp_extract("text", r"^\p{Lu}\p{L}+", 0).alias("label")).where("label <> ''").distinct()
    names = graphs.written(entities.gazetteer(speakers, entities.discovered(t.documents, "doc_id", "text")))
    found = entities.mentions(t.documents, "doc_id", "text", names)
    return found.groupBy("label").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs")).join(names, "label").select("id", "label", "type", "n", "docs")


_TITLE = _MENTION.replace("text", "split_part(text, chr(10), 1)")


@query(
    "T10_mention_graph",
    f"""WITH m AS (SELECT unnest({_TITLE}) AS entity, doc_id, 'title' AS basis FROM documents UNION ALL SELECT unnest({_MENTION}), doc_id, 'text' FROM documents
    UNION ALL SELECT source, doc_id, 'speaker' FROM documents WHERE source IS NOT NULL)
    SELECT entity, doc_id, string_agg(DISTINCT basis, ',' ORDER BY basis) AS basis FROM m GROUP BY 1, 2""",
)
def t10(t: Tables) -> DataFrame:
    """Entities and recordings with the bases they meet on: named in the first line, named in the text, or speaking."""
    d = t.documents.select("doc_id", "source", "text", F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"))
    speakers = d.where("source is not null").select(F.col("source").alias("entity"), "doc_id", F.lit("speaker").alias("basis"))
    named = [d.select(F.explode(fulltext.mentions(F.col(c), _NAMES)).alias("entity"), "doc_id", F.lit(c).alias("basis")) for c in ("title", "text")]
    found = graphs.mention_graph(speakers.union(named[0]).union(named[1]), "entity", "doc_id", "basis")
    return found.select("entity", "doc_id", F.array_join("basis", ",").alias("basis"))


@query(
    "T10_events",
    "SELECT substr(sha256(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) || '|' || role), 1, 16) AS id, CAST(count(*) AS BIGINT) "
    "AS n FROM conversations GROUP BY 1",
)
def t10_events(t: Tables) -> DataFrame:
    """Accounts of one event: the same text but for case and white space, of one classification."""
    key = F.sha2(F.concat_ws("|", F.lower(F.trim(F.regexp_replace("text", r"\s+", " "))), "role").cast("binary"), 256)
    return t.conversations.groupBy(F.substring(key, 1, 16).alias("id")).agg(F.count("*").alias("n"))


@query(
    "T11_passage_windows",
    r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM documents), n AS (SELECT doc_id, w, len(w) AS n FROM w)
    SELECT doc_id, CAST(s AS INT) AS start, CAST(len(w[s + 1 : s + 500]) AS INT) AS size, w[s + 1] AS first FROM (SELECT doc_id, w, unnest(CASE WHEN n >= 500 THEN list_distinct(list_append(range(0, n - 499, 500), n - 500)) WHEN n >= 20 THEN [0] ELSE []::BIGINT[] END) AS s FROM n)""",
)
def t11(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", F.array_remove(F.split("text", r"\s+"), "").alias("w"))
    rows = rows.select("doc_id", "w", F.explode(fulltext.windows(F.col("w"))).alias("start"))
    return rows.select("doc_id", "start", F.size(F.slice("w", F.col("start") + 1, 500)).alias("size"), F.get("w", F.col("start")).alias("first"))


@query(
    "T12_hybrid_retrieval",
    "WITH b AS (" + _bm25_sql("documents", "doc_id", "doc_id", ["the"], 30) + "), r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS n FROM b), v AS (SELECT vec_id AS doc_id, row_number() OVER (ORDER BY round(list_dot_product(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)) / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 9) DESC, vec_id) AS n FROM embeddings QUALIFY n <= 30) SELECT doc_id, round(sum(1.0 / (60 + n)), 9) AS score FROM (SELECT * FROM r UNION ALL SELECT * FROM v) GROUP BY 1 ORDER BY score DESC, doc_id LIMIT 6",
)
def t12(t: Tables) -> DataFrame:
    """Reciprocal-rank fusion of the thirty best by BM25 and by cosine, six kept."""
    b = _documents(t).search(["the"], 30, digits=6).select(F.col("key").alias("doc_id"), "score")
    asked = F.array(*[F.lit(float(x)) for x in t.embeddings.where("vec_id = 0").first()["embedding"]])
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, c: a.cast("double") * c.cast("double")), F.lit(0.0), lambda s, z: s + z)
    v = t.embeddings.select(F.col("vec_id").alias("doc_id"), F.round(dot("embedding", asked) / F.sqrt(dot("embedding", "embedding")), 9).alias("score")).orderBy(F.desc("score"), "doc_id").limit(30)
    ranked = [x.select("doc_id", F.row_number().over(Window.orderBy(F.desc("score"), "doc_id")).alias("n")) for x in (b, v)]
    fused = ranked[0].unionByName(ranked[1]).groupBy("doc_id").agg(F.round(F.sum(1.0 / (60 + F.col("n"))), 9).alias("score"))
    return fused.orderBy(F.desc("score"), "doc_id").limit(6)


@query(
    "T15_exact_duplicates",
    "SELECT min(doc_id) AS doc_id, CAST(count(*) AS BIGINT) AS copies, CAST(count(DISTINCT source) AS BIGINT) AS sources "
    "FROM documents GROUP BY sha256(text) HAVING count(*) > 1",
)
def t15(t: Tables) -> DataFrame:
    g = t.documents.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("digest")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.countDistinct("source").alias("sources"))
    return g.where("copies > 1").drop("digest")


@query(
    "T16_rates_per_10k",
    "SELECT source, round(10000.0 * sum(hits) / sum(words), 6) AS rate "
    "FROM (SELECT source, len(regexp_extract_all(text, 'the')) AS hits, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: "
    "x <> '')) AS words FROM documents) GROUP BY 1",
)
def t16(t: Tables) -> DataFrame:
    rows = t.documents.select("source", F.regexp_count("text", F.lit("the")).alias("hits"), F.size(F.array_remove(F.split("text", r"\s+"), "")).alias("words"))
    return rows.groupBy("source").agg(F.round(10000.0 * F.sum("hits") / F.sum("words"), 6).alias("rate"))


_TURN_TOKENS = f"SELECT conv_id * 1000 + turn AS key, {TOKENS} AS t FROM conversations"


@query(
    "K8_flushed_index",
    f"SELECT term, CAST(count(DISTINCT key) AS BIGINT) AS df, CAST(count(*) AS BIGINT) AS tf, CAST(min(key) AS BIGINT) AS first FROM (SELECT key, unnest(t) AS term FROM ({_TURN_TOKENS})) GROUP BY 1",
)
def k8(t: Tables) -> DataFrame:
    """The stored blocks of all segments, a segment flushed for about every thousand turns: frequencies and first key of each term."""
    index = _turns(t)
    blocks = index.stored()
    return blocks.groupBy("term").agg(F.sum("n").cast("long").alias("df"), F.sum(F.aggregate("tfs", F.lit(0).cast("long"), lambda s, x: s + x)).alias("tf"), F.min("first").alias("first"))


@query(
    "T1_phrases",
    f"SELECT doc_id, CAST(len(list_filter(range(1, len(t)), lambda i: t[i] = 'all' AND t[i + 1] = 'rights' AND t[i + 2] = 'reserved')) AS BIGINT) AS n FROM (SELECT doc_id, {TOKENS} AS t FROM documents) WHERE n > 0",
)
def t1_phrases(t: Tables) -> DataFrame:
    return _documents(t).phrase(["all", "rights", "reserved"]).select(F.col("key").alias("doc_id"), "n")


@query(
    "T1_prefixes",
    f"SELECT doc_id, CAST(len(list_distinct(m)) AS BIGINT) AS terms, CAST(len(m) AS BIGINT) AS n FROM (SELECT doc_id, list_filter({TOKENS}, lambda x: starts_with(x, 'licen')) AS m FROM documents) WHERE len(m) > 0",
)
def t1_prefixes(t: Tables) -> DataFrame:
    return _documents(t).prefix("licen").select(F.col("key").alias("doc_id"), "terms", "n")


@query("K10_W20_document_export", pack_sql("SELECT conv_id AS key, CAST(turn AS BIGINT) AS place, CAST(length(text) + 1 AS BIGINT) AS size FROM conversations", "key", 12_000, 10**9))
def k10(t: Tables) -> DataFrame:
    """Turns of a conversation packed in order into documents of at most 12,000 characters; longer turns stand alone."""
    rows = t.conversations.select(F.col("conv_id").alias("key"), F.col("turn").cast("long").alias("place"), (F.char_length("text") + 1).cast("long").alias("size"))
    return folds.pack_in_order(rows, most_size=12_000, most_rows=10**9, by_key=True)


@query(
    "T13_containment",
    f"""WITH b AS (SELECT item_id, {TOKENS} AS w FROM benchmark), d AS (SELECT doc_id, {TOKENS} AS w FROM documents),
    s AS (SELECT DISTINCT item_id, unnest([array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)]) AS g FROM b),
    n AS (SELECT item_id, count(*) AS n FROM s GROUP BY 1),
    p AS (SELECT DISTINCT doc_id, unnest([array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)]) AS g FROM d)
    SELECT item_id, doc_id, round(count(*) / any_value(n), 6) AS containment FROM s JOIN p USING (g) JOIN n USING (item_id) GROUP BY 1, 2 HAVING count(*) >= 0.5 * any_value(n)""",
)
def t13(t: Tables) -> DataFrame:
    """Documents that contain half or more of a benchmark passage's five-word shingles."""
    return fulltext.contained(t.benchmark, "item_id", t.documents, "doc_id", "text", words=5, least=0.5).withColumn("containment", F.round("containment", 6))
