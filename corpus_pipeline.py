"""The corpus pipeline: language ID, quality rules, near duplicates, secret scans, packing.

STAGES lists (name, function); each takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's docs. All but the last return the columns of documents. SQL cannot express the stages, so
ORACLE_SQL is None and the tests compare with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import common, language_id, ngram_jaccard, quality_rules, queries, secret_scans

#: A text of which a smaller share of trigrams is typical of its best language is in none of them.
LEAST_LANGUAGE_SCORE = 0.2


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from two of three folds of docs; drops texts that are undetermined or in no learned language.

    Null, empty and letterless texts are undetermined. Repeated rows are each judged, and learned from, as they come.
    An empty table, or one without labels, gives no rows.
    """
    learned = docs.where(F.coalesce(common.id_remainder("doc_id", 3), F.lit(1)) != 1)
    filters = language_id.fit(learned)
    pred, score = common.unused(docs, "lang_pred"), common.unused(docs, "lang_score")
    found = language_id.predict(docs, filters, lang_pred=pred, score=score)
    return found.where((F.col(pred) != language_id.UNDETERMINED) & (F.col(score) >= LEAST_LANGUAGE_SCORE)).select(*_columns(docs))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the rules themselves or come from a host that does.

    Null and empty texts fail; a null host is a host of its own; repeated rows all stay or all go; an empty table
    gives no rows.
    """
    return quality_rules.keep_passing(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts linked at five-word shingles and similarity 0.8 the smallest id stays.

    Null, empty and wordless texts, and rows with a null id, link with nothing and stay. Ids name texts: repeated rows
    of an id that stays all stay. An empty table gives no rows.
    """
    return ngram_jaccard.keep_representatives(docs, words=5, num=8, den=10)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts [SECRET] in place of every span found; n_chars follows the text. All rows stay; null and empty texts do not change."""
    return secret_scans.redacted(docs, n_chars="n_chars" if "n_chars" in docs.columns else None)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 1024 tokens. Null and empty texts are their closing id alone; an empty table gives no rows."""
    return queries.packed_pieces(docs)


STAGES = [
    ("language_id", language_stage),
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secret_scans", secret_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = common.documents(spark, sf_dir), common.Scratch(spark)
    for i, (name, stage) in enumerate(STAGES[:-1]):
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if i:
            scratch.drop(STAGES[i - 1][0])
    return STAGES[-1][1](spark, docs, sf_dir)
