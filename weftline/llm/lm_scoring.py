"""LM scoring by prediction by partial matching over bytes, and word-unigram scores beside it.

The model is the trie of byte contexts up to ORDER with counts from all training texts: a symbol is coded in the longest
context that has seen it; each longer context on the way is left by an escape, and symbols that context had
are excluded below. Escapes are estimated from the symbols a context has seen once (method X): in large contexts those,
not all its symbols, tell how often a new one comes. In a fixed trie the symbols excluded at an order are those of the context one longer, so a symbol's
whole chain of escapes is a function of its (ORDER+1)-gram alone, computed once a gram by joins from the shortest order up.

Scoring sums a table over each text's grams (and words). The table grows with the corpus and is never broadcast whole:
keys with at least a 2**-HEAVY_LOG2 share of all occurrences, at most that many, go into a slot table of fixed size on
every worker; occurrences of all other keys are sent in columns, by hash of the key, to where their values are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import id_remainder, saved, small_batches

ORDER = 5
#: Codes: 0 before and after a text, otherwise byte + 1.
SYMBOLS = 257
HEAVY_LOG2 = 21
#: By kind: slots, and the type of their values.
SLOTS_LOG2 = (21, 22)
SLOT_TYPES = (np.float64, np.float32)
#: Rare occurrences that one group looks up.
GROUP_KEYS = 4_000_000
#: Text that is cut into keys at once; keys that a task holds before it merges, hands on counts, or sends occurrences.
CHUNK_BYTES = 500_000
MERGE_KEYS = 1_000_000
SEND_KEYS = 1_000_000
#: Rows of one Arrow batch of counts.
BATCH_KEYS = 100_000
WORDS, GRAMS = 0, 1
_BITS = 9
_MIX = np.uint64(0x9E3779B97F4A7C15)
_NULL_ID = -(2**63)
ADD = 0.1


def gram_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ORDER+1)-gram of every byte and of the end of each text, in order; and the text each belongs to."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = np.frombuffer((b"\0" * (ORDER + 1)).join([b"", *texts, b""]), np.uint8)
    codes = raw.astype(np.int64) + 1
    starts = np.concatenate(([0], np.cumsum(lengths + ORDER + 1)))
    for i in range(ORDER + 1):
        codes[starts + i] = 0
    keys = codes.copy()
    for i in range(1, ORDER + 1):
        keys[i:] |= codes[:-i] << (_BITS * i)
    # A separator's first place is the end of the text before it (none before the first); its others are contexts.
    keep = np.ones(len(keys), bool)
    for i in range(ORDER + 1):
        keep[starts + i] = False
    keep[starts[1:]] = True
    return keys[keep], np.repeat(np.arange(len(texts)), lengths + 1)


def word_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    split = [t.lower().split() for t in texts]
    n = np.fromiter(map(len, split), np.int64, len(split))
    keys = np.fromiter((xxhash.xxh3_64_intdigest(w) for words in split for w in words), np.uint64, int(n.sum()))
    return keys.view(np.int64), np.repeat(np.arange(len(split)), n)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(first row's number, ids, train flags, texts in UTF-8) for runs of rows of about CHUNK_BYTES."""
    row, ids, train, texts, size = 0, [], [], [], 0
    for batch in batches:
        for at, flag, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            ids.append(_NULL_ID if at is None else at)
            train.append(flag)
            texts.append((text or "").encode("utf-8", "surrogatepass"))
            size += len(texts[-1])
            if size >= CHUNK_BYTES:
                yield row, ids, train, texts
                row, ids, train, texts, size = row + len(ids), [], [], [], 0
    if ids:
        yield row, ids, train, texts


def _merge(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    keys, *counts = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = keys.argsort(kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], *[np.add.reduceat(c[order], first) if len(first) else c for c in counts]


def count_keys(rows: DataFrame) -> DataFrame:
    """(kind, key, n_train, n_all) over all texts of rows (doc_id, train, text), summed in each task before the shuffle."""
    schema = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("n_train", pa.int64()), ("n_all", pa.int64())])

    def out(kind: int, parts: list) -> Iterator[pa.RecordBatch]:
        keys, train, total = _merge(parts)
        for i in range(0, len(keys), BATCH_KEYS):
            k, *n = (c[i : i + BATCH_KEYS] for c in (keys, train, total))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k), *[pa.array(c, pa.int64()) for c in n]], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # By kind: parts of (keys, 32-bit counts); how many keys they hold; how many of them are merged already.
        held: dict[int, list] = {WORDS: [], GRAMS: []}
        size, merged = {WORDS: 0, GRAMS: 0}, {WORDS: 0, GRAMS: 0}
        for _, _, train, texts in _chunks(batches):
            flags = np.array(train, bool)
            for kind, keys_of in ((WORDS, word_keys), (GRAMS, gram_keys)):
                keys, owner = keys_of(texts)
                learned = flags[owner]
                for used, k in ((1, keys[learned]), (0, keys[~learned])):
                    u, n = np.unique(k, return_counts=True)
                    n = n.astype(np.uint32)
                    held[kind].append((u, n * np.uint32(used), n))
                    size[kind] += len(u)
                if size[kind] - merged[kind] > MERGE_KEYS:
                    held[kind] = [_merge(held[kind])]
                    size[kind] = merged[kind] = len(held[kind][0][0])
                    if size[kind] > MERGE_KEYS:
                        yield from out(kind, held[kind])
                        held[kind], size[kind], merged[kind] = [], 0, 0
        for kind, parts in held.items():
            if parts:
                yield from out(kind, parts)

    return rows.mapInArrow(count, "kind int, key long, n_train long, n_all long").groupBy("kind", "key").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all"))


def gram_values(grams: DataFrame) -> DataFrame:
    """(key, n_all, value) of grams (key, n_train, n_all): log10 PPM probability of a gram's last symbol after its others.

    Orders are built from the shortest up. A row of an order knows its count, its context's figures, and what its symbol
    costs further down when this context has not seen it (below): the next shorter context's figures, less those of the
    symbols that this context has seen. So an order is one join with the order before, by the gram without its first
    symbol, and one window by context, of at most SYMBOLS rows. Nothing grows but the number of contexts.
    """
    tables = {ORDER: grams}
    for order in range(ORDER - 1, -1, -1):
        end = F.col("key").bitwiseAND(F.lit((1 << (_BITS * (order + 1))) - 1))
        tables[order] = tables[order + 1].groupBy(end.alias("key")).agg(F.sum("n_train").alias("n_train"))
    over = Window.partitionBy("context")
    count, lower = F.col("n_train"), F.col("lower_n")
    seen = count > 0
    within = lambda c: F.sum(c).over(over)
    figures = {
        "total": within(count),
        "once": within((count == 1).cast("long")),
        "gone": within(F.when(seen, lower).otherwise(0)),
        "gone_once": within((seen & (lower == 1)).cast("long")),
        "kinds": within(seen.cast("long")),
    }

    def coded(n: Column, total: Column, once: Column, below: Column) -> Column:
        """A symbol of n in a context of that total: coded, or escaped from and coded below. Empty contexts cost nothing."""
        whole = total + once + 1
        return F.when(n > 0, F.log10(n / whole)).when(total > 0, F.log10((once + 1) / whole) + below).otherwise(below)

    found = None
    for order in range(ORDER + 1):
        rows = tables[order]
        if found is None:
            rows = rows.select("key", "n_train", F.lit(0).cast("long").alias("lower_n"))
        else:
            # Up to two symbols, an order has at most SYMBOLS ** 2 rows.
            shorter = F.broadcast(found) if order <= 2 else found
            rows = rows.withColumn("lower", F.col("key").bitwiseAND(F.lit((1 << (_BITS * order)) - 1))).join(shorter, "lower")
        rows = rows.withColumn("context", F.shiftright("key", _BITS)).withColumns(figures)
        if found is None:
            below = -F.log10(F.lit(SYMBOLS) - F.col("kinds"))
        else:
            below = coded(lower, F.col("lower_total") - F.col("gone"), F.col("lower_once") - F.col("gone_once"), F.col("below"))
        if order == ORDER:
            return rows.select("key", "n_all", coded(count, F.col("total"), F.col("once"), below).alias("value"))
        found = rows.select(F.col("key").alias("lower"), count.alias("lower_n"), F.col("total").alias("lower_total"), F.col("once").alias("lower_once"), below.alias("below"))


class Slots:
    """Most frequent keys and their values at the slot their hash names; a slot's other keys are looked up as rare."""

    def __init__(self, kind: int, keys: np.ndarray, values: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(counts, kind="stable")
        self.__setstate__((kind, keys[order], values[order]))

    def __getstate__(self) -> tuple:
        """The keys and values alone travel; each worker lays them out again."""
        held = np.flatnonzero(self.keys != -1)
        return self.kind, self.keys[held], self.values[held]

    def __setstate__(self, state: tuple) -> None:
        self.kind, keys, values = state
        self.bits = SLOTS_LOG2[self.kind]
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, SLOT_TYPES[self.kind])
        at = self.slot(keys)
        # Keys come in ascending order of count: of a slot's keys the last one stays in both arrays.
        self.keys[at], self.values[at] = keys, values

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.slot(keys)
        found = self.keys[at] == keys
        return found, np.where(found, self.values[at], 0.0)


def _place(keys: np.ndarray, parts: int) -> np.ndarray:
    mixed = keys.astype(np.int64).view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int32)


def lm_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 10) -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens (long), base_score, score (double).

    Learns from rows whose crc32(doc_id) mod folds is not 0. score: log10 probability of the whole text's bytes and
    its end under the model; base_score: of its words and end under smoothed unigrams. A null text is empty: its end
    alone is scored. Rows with a null id are held out. Repeated rows are learned from, and scored, as often as they
    come. With no training rows the model is uniform; an empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    held = F.coalesce(id_remainder(doc_id, folds), F.lit(0)) == 0
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (~held).alias("train"), F.col(text).alias("text"))
    n_docs = rows.where("train").count()
    counts = saved(count_keys(rows))
    sums = {r["kind"]: r for r in counts.groupBy("kind").agg(F.sum("n_train").alias("train"), F.sum("n_all").alias("all"), F.count(F.when(F.col("n_train") > 0, 1)).alias("kinds")).collect()}
    zero = {"train": 0, "all": 0, "kinds": 0}
    words, grams = sums.get(WORDS, zero), sums.get(GRAMS, zero)
    tokens = words["train"] + n_docs
    below = np.log10(tokens + ADD * (words["kinds"] + (n_docs > 0) + 1))
    end = np.log10(n_docs + ADD) - below

    by_gram = gram_values(counts.where(F.col("kind") == GRAMS).select("key", "n_train", "n_all"))
    by_word = counts.where(F.col("kind") == WORDS).select("key", "n_all", F.when(F.col("n_train") > 0, F.log10(F.col("n_train") + ADD)).otherwise(F.lit(None)).alias("value"))
    unknown = float(np.log10(ADD))
    by_word = by_word.select(F.lit(WORDS).alias("kind"), "key", "n_all", (F.coalesce("value", F.lit(unknown)) - float(below)).alias("value"), F.col("value").isNotNull().alias("known"))
    values = saved(by_gram).select(F.lit(GRAMS).alias("kind"), "key", "n_all", "value", F.lit(False).alias("known")).unionByName(by_word)
    least = {WORDS: max(1, words["all"] >> HEAVY_LOG2), GRAMS: max(1, grams["all"] >> HEAVY_LOG2)}
    heavy = {}
    rare = {}
    for kind, total in ((WORDS, words["all"]), (GRAMS, grams["all"])):
        top = values.where((F.col("kind") == kind) & (F.col("n_all") >= least[kind]) & (F.col("n_all") > 1) & (F.lit(kind == GRAMS) | F.col("known"))).select("key", "value", "n_all").toPandas()
        heavy[kind] = Slots(kind, top["key"].to_numpy(np.int64), top["value"].to_numpy(float), top["n_all"].to_numpy())
        rare[kind] = max(8, -(-(total - int(top["n_all"].sum())) // GROUP_KEYS))
    return _scored(rows, values, spark.sparkContext.broadcast(heavy), rare, tokens, float(end), n_docs > 0, folds)


def _scored(rows: DataFrame, values: DataFrame, heavy, parts: dict[int, int], tokens: int, end: float, end_known: bool, folds: int) -> DataFrame:
    first = {WORDS: 0, GRAMS: parts[WORDS]}
    owners = sum(parts.values())
    schema = pa.schema([("part", pa.int32()), ("rows", pa.binary()), ("owner", pa.binary()), ("keys", pa.binary()), ("sums", pa.binary())])

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        held: dict[int, list] = {WORDS: [], GRAMS: []}
        size, names = 0, []

        def flush() -> Iterator[pa.RecordBatch]:
            ids = np.concatenate(names) if names else np.empty((0, 2), np.int64)
            for kind, got in held.items():
                if not got:
                    continue
                keys, owner = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
                place = _place(keys, parts[kind]).astype(np.uint16 if parts[kind] < 65536 else np.uint32)
                order = place.argsort(kind="stable")
                ends = np.cumsum(np.bincount(place, minlength=parts[kind]))
                out = []
                for p, (lo, hi) in enumerate(zip(np.concatenate(([0], ends[:-1])), ends, strict=True)):
                    if hi > lo:
                        k, o = keys[order[lo:hi]], owner[order[lo:hi]]
                        new = np.concatenate(([True], o[1:] != o[:-1]))
                        out.append((first[kind] + p, ids[o[new]].tobytes(), (np.cumsum(new) - 1).astype(np.uint32).tobytes(), k.tobytes(), None))
                yield _batch(schema, out)

        start = 0
        for row, at, _, texts in _chunks(batches):
            mine = np.stack((base + row + np.arange(len(at)), np.array(at, np.int64)), 1)
            names.append(mine)
            totals = np.zeros((len(at), 4))
            for kind, keys_of, column in ((WORDS, word_keys, 0), (GRAMS, gram_keys, 1)):
                keys, owner = keys_of(texts)
                found, value = heavy.value[kind].look(keys)
                totals[:, column] = np.bincount(owner, value, len(at))
                if kind == WORDS:
                    totals[:, 2] = np.bincount(owner, minlength=len(at)) + 1
                    totals[:, 3] = np.bincount(owner[found], minlength=len(at)) + end_known
                    totals[:, 0] += end
                held[kind].append((keys[~found], owner[~found] + start))
                size += len(held[kind][-1][0])
            yield _batch(schema, [(owners + int(mine[0, 0] % 61), mine.tobytes(), None, None, totals.tobytes())])
            start += len(at)
            if size > SEND_KEYS:
                yield from flush()
                held, size, names, start = {WORDS: [], GRAMS: []}, 0, [], 0
        yield from flush()

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, value, known = (right.column(c).to_numpy() for c in ("key", "value", "known"))
        order = keys.argsort()
        keys, value, known = keys[order], value[order], known[order]
        out = []
        for part, rows_, owner, wanted, sums in zip(*[left.column(c).to_pylist() for c in ("part", "rows", "owner", "keys", "sums")], strict=True):
            ids = np.frombuffer(rows_, np.int64).reshape(-1, 2)
            if sums is not None:
                totals = np.frombuffer(sums).reshape(-1, 4)
            else:
                at = np.searchsorted(keys, np.frombuffer(wanted, np.int64))
                who = np.frombuffer(owner, np.uint32)
                totals = np.zeros((len(ids), 4))
                totals[:, 1 if part >= parts[WORDS] else 0] = np.bincount(who, value[at], len(ids))
                totals[:, 3] = np.bincount(who, known[at], len(ids))
            out.append((ids, totals))
        if not out:
            return pa.table({"row": pa.array([], pa.int64()), "doc_id": pa.array([], pa.int64()), "base": pa.array([], pa.float64()), "score": pa.array([], pa.float64()), "n": pa.array([], pa.float64()), "known": pa.array([], pa.float64())})
        ids, totals = np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])
        # One row a document from this group, whatever the number of its blocks.
        rows_, at = np.unique(ids[:, 0], return_inverse=True)
        names = np.empty(len(rows_), np.int64)
        names[at] = ids[:, 1]
        table = [np.bincount(at, totals[:, c], len(rows_)) for c in range(4)]
        return pa.table({"row": rows_, "doc_id": names, "base": table[0], "score": table[1], "n": table[2], "known": table[3]})

    @F.pandas_udf("int")
    def placed(kind: pd.Series, key: pd.Series) -> pd.Series:
        k, which = key.to_numpy(np.int64), kind.to_numpy()
        return pd.Series(np.where(which == WORDS, _place(k, parts[WORDS]), parts[WORDS] + _place(k, parts[GRAMS])))

    blocks = rows.mapInArrow(sent, "part int, rows binary, owner binary, keys binary, sums binary")
    table = values.select(placed("kind", "key").alias("part"), "key", "value", "known")
    partial = blocks.groupBy("part").cogroup(table.groupBy("part")).applyInArrow(summed, "row long, doc_id long, base double, score double, n double, known double")
    sums = partial.groupBy("row", "doc_id").agg(*[F.sum(c).alias(c) for c in ("base", "score", "n", "known")])
    out = sums.select(F.when(F.col("doc_id") != _NULL_ID, F.col("doc_id")).alias("doc_id"), *[F.col(c) for c in ("base", "score", "n", "known")])
    held = F.coalesce(id_remainder("doc_id", folds), F.lit(0)) == 0
    return out.select(
        "doc_id",
        held.alias("held_out"),
        F.col("n").cast("long").alias("n_tokens"),
        F.col("known").cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
