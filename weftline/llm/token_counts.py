"""Token counts behind a digest cache: content and tokenizer digests are joined to stored counts, only distinct misses
are encoded, and their counts are appended to the cache.

Texts are de-duplicated by digest with a map-side combine before the one shuffle that carries text, so a group of
copies sends one row a task; afterwards only (id, digest) rows meet the counts.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import SPACE_CLASS, small_batches

#: A worker forgets its words' counts when it has so many.
MEMO_WORDS = 1_200_000
CACHE_COLUMNS = "digest binary, n_tokens long, tokenizer string"
#: Texts that such a tokenizer as WordCounter's takes for the same.
_ALIKE = (("Some Words, and 12 more", "some words, and 12 more"), ("some words", "\n some\t \x0bwords \r"), ("a  b.\n\nC", "a b. c"))
_CLOSING = b'.,;:!?|)]}"'


def tokenizer_digest(path: str) -> str:
    """Version of a tokenizer: sha256 of its file."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


class WordCounter:
    """Token counts of texts under a tokenizers file that drops white space and never looks across it.

    So a text's count is the sum over its ASCII-white-space-separated words, each encoded by the library once while it
    is remembered. ASCII lower-casing and splitting off closing punctuation after a letter, which such a word pattern
    does itself, let more words share an entry; both are left out where a special token might be.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder, self.memo = Tokenizer.from_file(path), {}
        for one, other in _ALIKE:
            a, b = (self.encoder.encode(t, add_special_tokens=False).ids for t in (one, other))
            if a != b:
                raise ValueError(f"{path}: not a tokenizer that drops white space and folds ASCII case: {one!r} and {other!r} differ")

    def _encode(self, words: list[bytes]) -> None:
        for i in range(0, len(words), 4096):
            part = words[i : i + 4096]
            encoded = self.encoder.encode_batch_fast([w.decode("utf-8", "surrogatepass") for w in part], add_special_tokens=False)
            self.memo.update(zip(part, map(len, encoded), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        split = [t.encode("utf-8", "surrogatepass") for t in texts]
        split = [(t if b"<|" in t else t.lower()).split() for t in split]
        new = set().union(*split).difference(memo)
        parts = {}
        for w in new:
            core = w.rstrip(_CLOSING)
            if core and len(core) < len(w) and core[-1:].isalpha() and b"<|" not in w:
                parts[w] = core, w[len(core) :]
        self._encode([w for w in new if w not in parts])
        self._encode(list({x for pair in parts.values() for x in pair}.difference(memo)))
        for w, (core, end) in parts.items():
            memo[w] = memo[core] + memo[end]
        return [sum(map(memo.__getitem__, words)) for words in split]


_COUNTERS: dict[str, WordCounter] = {}


def count_tokens(texts: Column, path: str) -> Column:
    """Token counts by WordCounter; each Python worker keeps one and its words from task to task."""

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if path not in _COUNTERS:
            _COUNTERS[path] = WordCounter(path)
        for batch in batches:
            yield pd.Series(_COUNTERS[path].count(batch.tolist()), dtype="int64")

    return counted(texts)


def token_counts(docs: DataFrame, tokenizer: str, cache: str, doc_id: str = "doc_id", text: str = "text", limit: int = 2048) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes (UTF-8), n_tokens (long), over_limit (n_tokens > limit).

    tokenizer: a tokenizers .json whose normaliser drops white space (see WordCounter; another kind raises ValueError),
    readable on every executor.
    cache: a shared folder of Parquet files, made if missing, one part a tokenizer version; misses are appended to it.
    Null and empty texts have 0 tokens. Repeated rows come back as often as they came in; an empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    version = tokenizer_digest(tokenizer)
    store = f"{cache.rstrip('/')}/tokenizer={version}"
    raw = F.coalesce(F.col(text), F.lit(""))
    content = F.trim(F.regexp_replace(raw, SPACE_CLASS, " "))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.octet_length(raw).cast("long").alias("n_bytes"), F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"))
    wanted = docs.select(F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"), content.alias("text"))
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    known = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    schema = "digest binary, n_tokens long"
    misses = wanted.join(spark.read.schema(schema).parquet(store).select("digest"), "digest", "left_anti") if known else wanted
    misses = misses.dropDuplicates(["digest"])
    misses.select("digest", count_tokens(F.col("text"), tokenizer).alias("n_tokens")).write.mode("append").parquet(store)
    # Two runs at once, or one repeated after it failed, may have stored a digest twice.
    counts = spark.read.schema(schema).parquet(store).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    found = rows.join(counts, "digest", "left")
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
