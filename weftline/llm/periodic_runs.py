"""Periodic runs: bit-parallel lags over big-integer planes of word ids.

A run is a stretch of words with smallest period q that no neighbour extends, at least max(LEAST, 2 * q) words long. Bit
b of all word ids of a text is one big integer, its plane. For a lag q every plane is XORed with itself shifted by q
and the results are ORed: zeros are words equal to the word q later. ANDing the matches with themselves shifted by
1, 2, 4 ... leaves the starts of stretches that are long enough.

Lags under NEAR are all tried. A longer lag q of [Q, 2Q) needs Q equal words in a row, hence a whole block of Q/2 words
at a multiple of Q/2 that recurs q later: only lags where some block's hash does are tried. No run is lost by that, and
a text of n words costs about n log n beside the planes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import SPACE_CLASS, small_batches

#: Words of the shortest run.
LEAST = 12
#: Lags below are tried without asking the blocks.
NEAR = 32
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def planes(ids: np.ndarray) -> list[int]:
    """One big integer for each bit of the ids; its bit i is that of word i."""
    bits = int(ids.max(initial=0)).bit_length()
    return [int.from_bytes(np.packbits((ids >> b) & 1, bitorder="little").tobytes(), "little") for b in range(bits)]


def stretches(of: list[int], n: int, lag: int, least: int) -> list[tuple[int, int]]:
    """(start, end) of the maximal stretches of at least so many words in a row that equal the word lag later."""
    differ = 0
    for plane in of:
        differ |= plane ^ (plane >> lag)
    found = ~differ & ((1 << (n - lag)) - 1)
    width = 1
    while found and width < least:
        step = min(width, least - width)
        found &= found >> step
        width += step
    starts, ends = found & ~(found << 1), found & ~(found >> 1)
    out = []
    while starts:
        first, last = starts & -starts, ends & -ends
        out.append((first.bit_length() - 1, last.bit_length() - 1 + least))
        starts ^= first
        ends ^= last
    return out


def far_lags(ids: np.ndarray, least: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """The lags of [least, 2 * least) that a run may have, ascending. runs: those of shorter lags, whose multiples are known."""
    n, block = len(ids), least // 2
    if n < 2 * least:
        return np.empty(0, np.int64)
    # Polynomial hashes of all windows of block words, modulo 2^64, from running sums.
    up = np.multiply.accumulate(np.full(n, _BASE, np.uint64))
    down = np.multiply.accumulate(np.full(n, _INVERSE, np.uint64))
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((mixed ^ (mixed >> np.uint64(29))) * up, dtype=np.uint64)))
    windows = (sums[block:] - sums[:-block]) * down[: n - block + 1]
    rows = (len(windows) - least - 1) // block + 1
    # Windows beyond the end are zero with a flag of their own: they equal no block.
    beyond = np.zeros(rows * block + 2 * least, bool)
    padded = np.zeros(len(beyond), np.uint64)
    padded[: len(windows)], beyond[len(windows) :] = windows[: len(padded)], True
    view = np.lib.stride_tricks.sliding_window_view
    same = view(padded, least)[least : least + rows * block : block] == padded[: rows * block : block][:, None]
    same &= ~view(beyond, least)[least : least + rows * block : block]
    for start, length, period in runs:
        for lag in range(-(-least // period) * period, min(2 * least, length - block + 1), period):
            same[-(-start // block) : (start + length - lag - block) // block + 1, lag - least] = False
    lags = np.flatnonzero(same.any(axis=0)) + least
    return lags[2 * lags <= n]


def runs_of(words: list[str]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    n, known = len(words), {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    of, found = planes(ids), {}

    def try_lag(lag: int) -> None:
        for start, end in stretches(of, n, lag, max(LEAST - lag, lag)):
            # The same stretch under a shorter lag: this one is a multiple of its period.
            found.setdefault((start, end + lag), lag)

    for lag in range(1, min(NEAR, n // 2 + 1) if n >= LEAST else 1):
        try_lag(lag)
    least = NEAR
    while 2 * least <= n:
        for lag in far_lags(ids, least, [(s, e - s, p) for (s, e), p in found.items()]).tolist():
            try_lag(lag)
        least *= 2
    return sorted((s, e - s, p) for (s, e), p in found.items())


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words that no run contains after its first period."""
    kept, at = [], 0
    for start, end in sorted((s + p, s + length) for s, length, p in runs):
        if end > at:
            kept += words[at : max(at, start)]
            at = end
    return kept + words[at:]


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    collapsed is the text's words outside repeated periods, joined by one space. Null, empty and wordless texts have no
    words and no runs; repeated rows and null ids each get their row; an empty table gives none. A text of any length
    is one row's work: its planes take one bit a word each.
    """
    small_batches(docs.sparkSession)
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, runs, texts = [], [], []
            for body in batch.column(1).to_pylist():
                words = _WORD.findall(body or "")
                own = runs_of(words)
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in own])
                texts.append(" ".join(collapsed(words, own)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(runs, schema.field("runs").type), pa.array(texts, pa.string())], schema=schema)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(found, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def looped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and text; one text in ten, by crc32 of the id, repeats from some word on (the query's planted runs). Null ids: unchanged."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.filter(F.split(F.col(text), SPACE_CLASS), lambda w: w != ""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.floor(h / 10).alias("g"), words.alias("w"))
    looping = F.expr(
        """transform(array(named_struct('n', size(w), 'a', cast(g % size(w) as int), 'k', cast(3 + g % 8 as int))), s ->
           array_join(transform(w, (x, i) -> if(i < s.a, x, w[s.a + (i - s.a) % (1 + (s.n - s.a) div s.k)])), ' '))[0]"""
    )
    return rows.select("doc_id", F.when(F.size("w") > 0, looping).otherwise(F.col("text")).alias("text"))
