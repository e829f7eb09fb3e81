"""Full-text search: postings, BM25, snippets, passage windows, gazetteer mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import tokens
from weftline.operators.graphs import written

#: The two BM25 constants of the reference's full-text index.
K1, B = 1.2, 0.75


def postings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf, length): one row per term of a document; length counts its terms, repeated ones too."""
    terms = docs.select(key, tokens(F.col(text)).alias("_t")).withColumn("length", F.size("_t"))
    return terms.select(key, "length", F.explode("_t").alias("term")).groupBy(key, "length", "term").agg(F.count("*").alias("tf"))


def _occurrences(terms: str, word: str) -> Column:
    return F.size(F.filter(terms, lambda x: x == word))


def bm25(docs: DataFrame, key: str, text: str, query: list[str]) -> DataFrame:
    """(key, score) of documents with any query term, higher is better: sum of idf * tf (k1 + 1) / (tf + k1 norm).

    Only the query's terms are counted, inside each row, so nothing is exploded. The counts are written once, without
    texts; document frequencies and the mean length are one row over them, read before the scoring pass.
    """
    t = tokens(F.col(text))
    rows = docs.select(key, t.alias("_t"))
    rows = rows.select(key, F.size("_t").alias("_n"), *[_occurrences("_t", q).alias(f"_tf{i}") for i, q in enumerate(query)])
    rows = written(rows)
    stats = rows.agg(F.count("*").alias("n"), F.avg("_n").alias("mean"), *[F.count_if(F.col(f"_tf{i}") > 0).alias(f"df{i}") for i in range(len(query))]).first()
    score = F.lit(0.0)
    norm = F.lit(1 - B) + F.lit(B) * F.col("_n") / F.lit(stats["mean"] or 1.0)
    for i in range(len(query)):
        idf = F.log(F.lit(1.0) + (F.lit(float(stats["n"] - stats[f"df{i}"])) + 0.5) / (F.lit(float(stats[f"df{i}"])) + 0.5))
        tf = F.col(f"_tf{i}")
        score = score + idf * tf * (K1 + 1) / (tf + F.lit(K1) * norm)
    return rows.where(" or ".join(f"_tf{i} > 0" for i in range(len(query)))).select(key, score.alias("score"))


def fan_out(docs: DataFrame, key: str, text: str, queries: list[str], limit: int, digits: int = 6) -> DataFrame:
    """(key, score, matched): the limit best rows of each query searched for by itself, merged by row; ties by key."""
    found = None
    for q in queries:
        one = bm25(docs, key, text, [q]).select(key, F.round("score", digits).alias("score"), F.lit(q).alias("query"))
        one = one.orderBy(F.desc("score"), key).limit(limit)
        found = one if found is None else found.unionByName(one)
    return found.groupBy(key).agg(F.max("score").alias("score"), F.array_sort(F.collect_set("query")).alias("matched"))


def shingles(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(key, shingle): 64-bit hashes of the distinct word shingles of each row, whole texts."""
    w = docs.select(key, tokens(F.col(text)).alias("_w"))
    w = w.select(key, "_w", F.size("_w").alias("_n")).where(F.col("_n") >= words)
    grams = F.transform(F.sequence(F.lit(1), F.col("_n") - (words - 1)), lambda i: F.xxhash64(F.array_join(F.slice("_w", i, words), " ")))
    return w.select(key, F.explode(F.array_distinct(grams)).alias("shingle"))


def contained(passages: DataFrame, passage_key: str, docs: DataFrame, key: str, text: str, words: int, least: float) -> DataFrame:
    """(passage_key, key, containment) of every row of docs that has at least a share least of a passage's shingles.

    Rare first: a row must share one of the passage's rarest (1 - least) n + 1 shingles, so only those, rarest among the
    rows, propose pairs; shingles that many rows share are not enumerated but where they are all a passage has. Each
    proposed pair is then counted exactly. Rows are cut down to the passages' shingles first.
    """
    asked = written(shingles(passages, passage_key, text, words))
    held = written(shingles(docs, key, text, words).join(asked.select("shingle").distinct(), "shingle", "left_semi"))
    size = asked.groupBy(passage_key).agg(F.count("*").alias("n"))
    rarity = asked.join(held.groupBy("shingle").agg(F.count("*").alias("rows")), "shingle", "left")
    # A passage's shingles, as many as one text has, are sorted in its row.
    lists = rarity.groupBy(passage_key).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("rows", F.lit(0)).alias("rows"), "shingle"))).alias("all"))
    rare = lists.select(passage_key, F.explode(F.slice("all", F.lit(1), F.size("all") - F.ceil(F.size("all") * F.lit(least)).cast("int") + 1)).alias("x")).select(passage_key, "x.shingle")
    pairs = rare.join(held, "shingle").select(passage_key, key).distinct()
    common = pairs.join(asked, passage_key).join(held, [key, "shingle"]).groupBy(passage_key, key).agg(F.count("*").alias("c"))
    return common.join(size, passage_key).where(F.col("c") >= F.col("n") * F.lit(least)).select(passage_key, key, (F.col("c") / F.col("n")).alias("containment"))


def snippet(text: Column, word: str, around: int = 40) -> Column:
    """The first match of word with so many characters around it, the match marked; null without a match."""
    at = F.instr(F.lower(text), word.lower())
    start = F.greatest(at - around, F.lit(1))
    cut = F.substring(text, start, F.lit(2 * around + len(word)))
    return F.when(at > 0, F.regexp_replace(cut, f"(?i)({word})", "<mark>$1</mark>"))


def windows(words: Column, size: int = 500, least: int = 20) -> Column:
    """Start places of the passages of a word array: every size words, the last passage the last size words.

    From least to size - 1 words there is one short passage, below least none.
    """
    n = F.size(words)
    full = F.array_distinct(F.concat(F.sequence(F.lit(0), n - size, F.lit(size)), F.array(n - size)))
    return F.when(n >= size, full).when(n >= least, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))


def mentions(text: Column, names: list[str]) -> Column:
    """Names that occur as whole words, the longest first where they overlap."""
    escaped = ["".join(f"\\{c}" if not c.isalnum() else c for c in n) for n in sorted(names, key=lambda n: (-len(n), n))]
    pattern = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(escaped)})(?![\p{{L}}\p{{N}}])"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
