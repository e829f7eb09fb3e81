"""DuckDB equivalents of the queries that SQL can express: op1, op7, op11 and op13. The others are tested in tests/llm."""

from weftline.llm.quality_rules import MAX_HOST_RATE, RULES

_WORDS = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

NGRAM_JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE [array_to_string(w[i : i + 2], ' ') FOR i IN range(1, len(w) - 1)] END) AS g FROM w),
n AS MATERIALIZED (SELECT w.doc_id, count(s.g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
r(id, hit) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.hit)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.hit) AS component_id FROM n JOIN r ON r.id = n.doc_id GROUP BY 1, 2
"""

_FAILS = ", ".join(f"CAST(sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS DOUBLE) AS f_{r}" for r, c in RULES.items())
_MEANS = ", ".join(f"sum(f_{r}) / sum(n) AS m_{r}" for r in RULES)
_SPREADS = ", ".join(f"greatest(sum(n * pow(f_{r} / n - m_{r}, 2)) / sum(n) - any_value(m_{r} * (1 - m_{r})) * count(*) / sum(n), 1e-9) AS b_{r}" for r in RULES)
_STRENGTHS = ", ".join(f"m_{r}, least(greatest(m_{r} * (1 - m_{r}) / b_{r} - 1, 1), 1e6) AS k_{r}" for r in RULES)
_SHRUNK = ", ".join(f"(f_{r} + m_{r} * k_{r}) / (n + k_{r})" for r in RULES)

QUALITY_RULES = f"""
WITH d AS (SELECT doc_id, coalesce(source, chr(0) || 'none') AS host, coalesce(text, '') AS text, {_WORDS.format(text="coalesce(text, '')")} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
t AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
p AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM t, (SELECT unnest(range(8)) AS k) GROUP BY 1),
f AS MATERIALIZED (SELECT d.doc_id, host, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(l) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words FROM d LEFT JOIN p ON p.doc_id = d.doc_id),
h AS (SELECT host, count(*) AS n, {_FAILS} FROM f GROUP BY 1), m AS (SELECT {_MEANS} FROM h), b AS (SELECT {_SPREADS} FROM h, m), k AS (SELECT {_STRENGTHS} FROM m, b),
v AS (SELECT host, greatest({_SHRUNK}) <= {MAX_HOST_RATE} AS host_ok FROM h, k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({RULES["short"]}) OR ({RULES["repetitive"]}) AS base_failed, NOT (({RULES["short"]}) OR ({RULES["repetitive"]})) AND host_ok AS kept FROM f JOIN v USING (host)
"""

# Squared distances from inner products of whole numbers under 2^53, exact in doubles; ties go to the lower index.
_ASSIGN = """
a{i} AS MATERIALIZED (SELECT r, v.p, any_value(v.x) AS x, min({{'d': CAST(v.xx - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x) AS BIGINT), 'j': c.j}}) AS m FROM v JOIN c{i} c ON c.p = v.p GROUP BY 1, 2)"""
_MEANS_OF = """
c{n} AS MATERIALIZED (SELECT c.p, c.j, coalesce(s.x, c.x) AS x FROM c{i} c LEFT JOIN (SELECT p, j, list(s ORDER BY k) AS x FROM (SELECT p, m.j AS j, k, floor(sum(x[k]) / count(*)) AS s FROM (SELECT p, m, x, unnest(range(1, len(x) + 1)) AS k FROM a{i}) GROUP BY 1, 2, 3) GROUP BY 1, 2) s ON s.p = c.p AND s.j = c.j)"""

VECTOR_CODES = (
    """
WITH e AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT r, p, x, list_inner_product(x, x) AS xx FROM (SELECT r, p, x[p * (len(x) // 4) + 1 : (p + 1) * (len(x) // 4)] AS x FROM (SELECT *, unnest(range(4)) AS p FROM e))),
c0 AS MATERIALIZED (SELECT p, r AS j, x FROM v WHERE r < 256),"""
    + ",".join(_ASSIGN.format(i=i) + "," + _MEANS_OF.format(i=i, n=i + 1) for i in range(4))
    + ","
    + _ASSIGN.format(i=4)
    + """,
h AS (SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY p, j, k)) AS h FROM (SELECT p, j, unnest(x) AS y, unnest(range(len(x))) AS k FROM c4)),
o AS (SELECT r, string_agg(lower(printf('%02x', m.j)), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a4 GROUP BY 1)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM o JOIN e USING (r), h
"""
)

# Bytes as hexadecimal digits; starts and ends count bytes from 1.
SUFFIX_DEDUP = """
WITH b AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, i, substr(x, 2 * i - 1, 200) AS s FROM (SELECT doc_id, x, unnest(range(1, len(x) // 2 - 98)) AS i FROM b)),
l AS (SELECT doc_id, i FROM (SELECT doc_id, i, min({'d': doc_id, 'i': i}) OVER (PARTITION BY s) AS f FROM w) WHERE f <> {'d': doc_id, 'i': i}),
g AS (SELECT doc_id, i, sum(apart) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS apart FROM l)),
s AS (SELECT doc_id, min(i) AS a, max(i) + 99 AS e FROM g GROUP BY doc_id, g),
p AS (SELECT doc_id, a, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM (SELECT doc_id, a, e FROM s UNION ALL SELECT doc_id, len(x) // 2 + 1, NULL FROM b)),
k AS (SELECT p.doc_id, string_agg(substr(x, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - before - 1) AS BIGINT)), '' ORDER BY a) AS kept, coalesce(sum(e - a + 1), 0) AS n_removed, count(e) AS n_spans FROM p JOIN b USING (doc_id) GROUP BY p.doc_id)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, n_spans, sha256(unhex(kept)) AS kept_sha256 FROM k JOIN b USING (doc_id)
"""
