"""Language ID with a bit-sliced Bloom filter: slot s holds one bit per language, so the AND of a gram's slots is the
set of all languages containing that gram.

Fitting counts character trigrams by language (map-side sums, then a shuffle on the trigram), keeps each trigram for
the languages it is typical of, and ORs the language masks slot by slot; what reaches the driver is at most SLOTS rows
however large the corpus is. Prediction needs no shuffle: each text is a run of vectorised look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import Scratch, id_remainder, small_batches, unused

#: Slots of the filter; with HASHES look-ups a trigram. 8 bytes a slot for each 64 languages.
SLOTS_LOG2 = 20
HASHES = 3
#: A language contains a trigram if its rate there is at least this share of the highest rate over the languages ...
TYPICAL = 0.25
#: ... and at least this rate in itself, so that a few odd trigrams don't count.
LEAST_RATE = 2e-6
UNDETERMINED = "und"
#: Languages that are learned, those with the most text: the filter, 8 MB for each 64 of them, is broadcast.
MOST_LANGUAGES = 512
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], np.uint64)


def trigrams(text: str) -> np.ndarray:
    """Exact 63-bit keys of the character trigrams of a lower-cased text, a space put before and after it."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    if len(points) < 3:
        return np.empty(0, np.int64)
    return (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]


def slots(keys: np.ndarray, which: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * _SEEDS[which]
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * _SEEDS[4 - which]) >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            keys, n = np.unique(np.concatenate([trigrams(t) for t in texts]), return_counts=True)
            yield pd.DataFrame({"lang": lang, "key": keys, "n": n})


def _to_slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for which in range(HASHES):
            yield pd.DataFrame({"slot": slots(batch["key"].to_numpy(), which), "word": batch["word"], "mask": batch["mask"]})


class Filters:
    """Languages, and words of 64 language bits by slot; false_rate: how often a trigram in no language hits each."""

    def __init__(self, languages: list[str], masks: np.ndarray) -> None:
        self.languages, self.masks = languages, masks
        bits = [(masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1) for i in range(len(languages))]
        self.false_rate = np.array([b.mean() ** HASHES for b in bits])

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language whose corrected share of the text's trigrams is highest, ties by name; and that share."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        keys = trigrams(text)
        at = [slots(keys, which) for which in range(HASHES)]
        rates = np.empty(len(self.languages))
        for word in range(len(self.masks)):
            found = self.masks[word][at[0]]
            for more in at[1:]:
                found = found & self.masks[word][more]
            for i in range(word * 64, min(len(self.languages), word * 64 + 64)):
                rates[i] = np.count_nonzero(found & np.uint64(1 << (i % 64))) / len(keys)
        rates = np.clip((rates - self.false_rate) / np.maximum(1 - self.false_rate, 1e-9), 0, 1)
        best = int(rates.argmax())
        return self.languages[best], float(rates[best])


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", most: int = MOST_LANGUAGES) -> Filters:
    """Filters of all rows with text and language. No such rows: filters without languages, which predict `und`.

    most: of more labels than that, those with the most trigrams are learned, ties by name; the rows of the others,
    as stray values of a dirty column are, teach nothing. All rows are counted.
    """
    spark = labelled.sparkSession
    small_batches(spark)
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    counts = rows.mapInPandas(_count, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    scratch = Scratch(spark)
    counts = scratch.save(counts, "counts")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(most).collect()}
    languages = sorted(totals)
    places = spark.createDataFrame([(x, i, float(totals[x])) for i, x in enumerate(languages)], "lang string, place int, total double")
    rates = counts.join(F.broadcast(places), "lang").select("key", "place", (F.col("n") / F.col("total")).alias("rate"))
    # The languages of one trigram, at most as many as there are: gathered in a row, not joined with itself.
    rates = rates.groupBy("key").agg(F.collect_list(F.struct("rate", "place")).alias("all"))
    rates = rates.select("key", F.explode("all").alias("x"), F.array_max("all")["rate"].alias("top"))
    kept = rates.where((F.col("x.rate") >= TYPICAL * F.col("top")) & (F.col("x.rate") >= LEAST_RATE))
    masks = kept.select("key", (F.col("x.place") / 64).cast("int").alias("word"), F.expr("shiftleft(1L, x.place % 64)").alias("mask"))
    masks = masks.groupBy("key", "word").agg(F.bit_or("mask").alias("mask")).mapInPandas(_to_slots, "slot long, word int, mask long")
    found = masks.groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toPandas()
    scratch.drop("counts")
    table = np.zeros((max(1, -(-len(languages) // 64)), 1 << SLOTS_LOG2), np.uint64)
    table[found["word"].to_numpy(), found["slot"].to_numpy()] = found["mask"].to_numpy(np.int64).view(np.uint64)
    return Filters(languages, table)


def predict(docs: DataFrame, filters: Filters, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of docs, with lang_pred and score (0 to 1) added or replaced.

    Null, empty and letterless texts: `und`, 0. A long text is looked up in one pass over its trigrams. Rows stay as they
    are, repeated ones too; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    @F.pandas_udf("lang string, score double")
    def scored(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang", "score"])

    kept = [c for c in docs.columns if c not in (lang_pred, score)]
    found = unused(docs, "found")
    out = docs.select(*[F.col(f"`{c}`") for c in kept], scored(F.col(text)).alias(found))
    return out.select(*[F.col(f"`{c}`") for c in kept], F.col(found)["lang"].alias(lang_pred), F.col(found)["score"].alias(score))


def language_id(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 3, held: int = 1) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score.

    Learns from rows whose crc32(doc_id) mod folds is not held; rows with a null id, text or language are not learned
    from. lang, source and doc_id are not inputs of a prediction.
    """
    ours = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.coalesce(id_remainder(doc_id, folds), F.lit(held)).alias("fold"))
    filters = fit(ours.where(F.col("fold") != held))
    rows = ours.select("doc_id", (F.col("fold") == held).alias("held_out"), "text")
    return predict(rows, filters).select("doc_id", "held_out", "lang_pred", "score")
