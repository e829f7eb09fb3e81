"""The queries of the training-data operators: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import oracles
from weftline.llm.common import documents, saved, shared_dir
from weftline.llm.fingerprints import fingerprints
from weftline.llm.language_id import language_id
from weftline.llm.license_scans import license_scans
from weftline.llm.lm_scoring import lm_scores
from weftline.llm.ngram_jaccard import jaccard_components
from weftline.llm.packing import pack_documents
from weftline.llm.periodic_runs import looped, periodic_runs
from weftline.llm.piece_encoding import piece_encoding
from weftline.llm.quality_rules import quality_rules
from weftline.llm.secret_scans import secret_scans
from weftline.llm.suffix_dedup import repeated_bytes
from weftline.llm.token_counts import token_counts
from weftline.llm.vector_codes import vector_codes


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), words=3, num=90, den=100)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))


def op4_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = piece_encoding(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))
    return found.select("doc_id", "n_bytes", "n_pieces", F.crc32("ids").alias("ids_crc32"), "round_trip")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of this call's own, so every distinct text is encoded here."""
    return token_counts(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), f"{shared_dir(spark)}/token-counts-{uuid.uuid4().hex}")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def packed_pieces(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    pieces = pack_documents(docs, vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(documents(spark, sf_dir))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """matches as start:end:identifier, licenses as names, comma-joined."""
    found = license_scans(documents(spark, sf_dir))
    spans = F.transform("matches", lambda m: F.concat_ws(":", m["start"], m["end"], m["sentence"]))
    return found.select("doc_id", F.size("matches").cast("long").alias("n_sentences"), F.array_join(spans, ",").alias("matches"), F.array_join("licenses", ",").alias("licenses"))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans(documents(spark, sf_dir))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_bytes(documents(spark, sf_dir))
    n_removed = F.expr("aggregate(removed, 0L, (s, r) -> s + r.end - r.start)")
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the documents with planted loops; the longest run is the first of equal ones by start, then period."""
    found = periodic_runs(looped(documents(spark, sf_dir)))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    length, period = -F.col("best.n"), F.col("best.period")
    return found.select("doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"), period.alias("period"), F.expr("(-1000 * best.n) div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    entries = ",".join(str(x) for book in books for entry in book.tolist() for x in entry)
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    rows = saved(coded.select("vec_id", "label", code.alias("code"), F.expr("aggregate(errors, 0L, (s, x) -> s + x)").alias("error")))
    by_label = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = rows.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(entries.encode()).hexdigest()).alias("codebooks_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_jaccard": op1_ngram_jaccard,
        "op2_lm_scoring": op2_lm_scoring,
        "op3_fingerprints": op3_fingerprints,
        "op4_piece_encoding": op4_piece_encoding,
        "op5_token_counts": op5_token_counts,
        "op6_language_id": op6_language_id,
        "op7_quality_rules": op7_quality_rules,
        "op8_packing": op8_packing,
        "op9_license_scans": op9_license_scans,
        "op10_secret_scans": op10_secret_scans,
        "op11_suffix_dedup": op11_suffix_dedup,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_vector_codes": op13_vector_codes,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard": oracles.NGRAM_JACCARD, "op7_quality_rules": oracles.QUALITY_RULES, "op11_suffix_dedup": oracles.SUFFIX_DEDUP, "op13_vector_codes": oracles.VECTOR_CODES}
