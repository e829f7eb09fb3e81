"""Coverage of files by pieces against sets of bytes."""

import random

import pytest
from pyspark.sql import functions as F

from weftline.operators import pieces


@pytest.mark.parametrize("piece", [7, 64])
def test_coverage_against_sets(spark, monkeypatch, piece):
    rng = random.Random(piece)
    files = [(p, i, rng.choice([0, 1, 5, 40, 3000 * (p == 2) + 1])) for p in range(4) for i in range(30)] + [(9, 0, 0), (8, 0, 3 * piece), (8, 1, 1)]
    if piece == 7:
        # More pieces than one bitmap has.
        files.append((7, 0, 7 * 70_000 + 3))
    spans = pieces.spans(spark.createDataFrame(files, "payload int, i int, size long"), "payload", ["i"], "size", piece).cache()
    rows = {(r.payload, r.i): r for r in spans.collect()}
    totals = {p: sum(s for q, _, s in files if q == p) for p, _, _ in files}
    held = {p: set() for p in totals}
    sources = [[], []]
    for p, total in totals.items():
        n = -(-total // piece)
        for k in range(0 if p == 3 else 6 if n else 0):
            a = rng.randrange(n)
            b = min(n - 1, a + rng.randrange(1 + n // 3))
            sources[k % 2].append((p, a, b))
            held[p] |= set(range(a, b + 1))
    maps = pieces.merged(*[pieces.bitmaps(spark.createDataFrame([*s, (0, 3, 2)], "payload int, first long, last long"), "payload") for s in sources])
    for r in pieces.covered(spans, "payload", ["i"], maps, piece).collect():
        at = rows[r.payload, r.i]
        touched = range(at.begin // piece, (at.end - 1) // piece + 1) if at.end > at.begin else range(0)
        covered = sum(min(at.end, (p + 1) * piece) - max(at.begin, p * piece) for p in touched if p in held[r.payload])
        capacity = sum(min(totals[r.payload], (p + 1) * piece) - p * piece for p in touched)
        assert (r.bytes, r.covered, r.pieces, r.capacity) == (at.end - at.begin, covered, len(touched), capacity), at
    for r in pieces.payloads(spans, "payload", maps, piece).collect():
        total = totals[r.payload]
        bytes_ = sum(min(total, (p + 1) * piece) - p * piece for p in held[r.payload])
        assert (r.bytes, r.pieces, r.verified, r.covered) == (total, -(-total // piece), len(held[r.payload]), bytes_)


def test_bits_between(spark):
    rng = random.Random(1)
    bits = {b for b in range(pieces.BUCKET) if rng.random() < 0.3}
    maps = spark.createDataFrame([(0, b) for b in bits], "payload int, p long").select("payload", F.col("p").alias("first"), F.col("p").alias("last"))
    cases = [(a, b) for a in (0, 1, 7, 8, 9, 100, 32_760) for b in (0, 1, 8, 9, 15, 16, 105, 32_767, 32_768)]
    asked = spark.createDataFrame(cases, "a long, b long").crossJoin(F.broadcast(pieces.bitmaps(maps, "payload")))
    for r in asked.select("a", "b", pieces.bits_between(F.col("bits"), F.col("a"), F.col("b")).alias("n")).collect():
        assert r.n == sum(r.a <= x < r.b for x in bits), r
