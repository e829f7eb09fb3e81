"""Coverage of files by verified pieces of their payload, with bitmaps by bucket of pieces.

A payload is its files laid end to end and cut into pieces of one length, the last one short. What several sources have
verified is ORed as bitmaps of 32,768 pieces, 4 KiB each; a file counts the bits of its range of pieces in the buckets
that it crosses. So neither files nor verified ranges are compared piece by piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pieces of one bitmap, as Spark's bitmap functions have them.
BUCKET = 32_768


def spans(files: DataFrame, payload: str, order: list[str], size: str, piece: int) -> DataFrame:
    """files with their first byte, end, first and last piece (null for empty files), and the payload's total bytes.

    A payload's files are sorted in one task, as the running offset needs; payloads are many.
    """
    before = Window.partitionBy(payload).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(payload)
    out = files.withColumn("begin", F.coalesce(F.sum(size).over(before), F.lit(0))).withColumn("total", F.sum(size).over(whole))
    out = out.withColumn("end", F.col("begin") + F.col(size))
    some = F.col(size) > 0
    return out.withColumns({"first": F.when(some, F.floor(F.col("begin") / piece)), "last": F.when(some, F.floor((F.col("end") - 1) / piece))})


def bitmaps(ranges: DataFrame, payload: str) -> DataFrame:
    """(payload, bucket, bits) of ranges of pieces (first, last, both included) from any number of sources.

    A range gives its bits to each bucket that it crosses; each task makes bitmaps of its own rows, which are ORed.
    """
    cut = ranges.where("first <= last").select(payload, "first", "last", F.explode(F.sequence(F.floor(F.col("first") / BUCKET), F.floor(F.col("last") / BUCKET))).alias("bucket"))
    inner = F.sequence(F.greatest(F.col("first"), F.col("bucket") * BUCKET), F.least(F.col("last"), F.col("bucket") * BUCKET + BUCKET - 1))
    bits = cut.select(payload, "bucket", F.explode(inner).alias("p")).groupBy(payload, "bucket")
    return bits.agg(F.bitmap_construct_agg((F.col("p") % BUCKET)).alias("bits"))


def merged(*maps: DataFrame) -> DataFrame:
    """Bitmaps (payload, bucket, bits) of several sources as one."""
    out = maps[0]
    for m in maps[1:]:
        out = out.unionByName(m)
    return out.groupBy(*[c for c in out.columns if c != "bits"]).agg(F.bitmap_or_agg("bits").alias("bits"))


def _byte(bits: Column, at: Column) -> Column:
    return F.conv(F.hex(F.substring(bits, at + 1, F.lit(1))), 16, 10).cast("int")


def bits_between(bits: Column, low: Column, high: Column) -> Column:
    """Number of set bits at low <= bit < high of one bitmap, by its bytes: whole ones at once, the two at the ends masked."""
    a, b = F.floor(low / 8).cast("int"), F.floor(high / 8).cast("int")
    from_a = F.lit(0xFF) - (F.call_function("shiftleft", F.lit(1), (low % 8).cast("int")) - 1)
    to_b = F.call_function("shiftleft", F.lit(1), (high % 8).cast("int")) - 1
    inside = F.when(b > a + 1, F.bitmap_count(F.substring(bits, a + 2, b - a - 1))).otherwise(F.lit(0))
    same = F.bit_count(_byte(bits, a).bitwiseAND(from_a).bitwiseAND(to_b))
    ends = F.bit_count(_byte(bits, a).bitwiseAND(from_a)) + F.when(to_b > 0, F.bit_count(_byte(bits, b).bitwiseAND(to_b))).otherwise(F.lit(0))
    return F.when(low >= high, F.lit(0)).when(a == b, same).otherwise(ends + inside).cast("long")


def has_bit(bits: Column, at: Column) -> Column:
    return F.getbit(_byte(bits, F.floor(at / 8).cast("int")), (at % 8).cast("int")) == 1


def covered(files: DataFrame, payload: str, key: list[str], verified: DataFrame, piece: int) -> DataFrame:
    """(payload, *key, bytes, covered, pieces, capacity) of files as spans() gives them.

    covered: bytes of the file in verified pieces. capacity: bytes of all pieces that it touches, the payload's last
    one short. Empty files have no pieces.
    """
    each = files.where(F.col("first").isNotNull()).withColumn("bucket", F.explode(F.sequence(F.floor(F.col("first") / BUCKET), F.floor(F.col("last") / BUCKET))))
    met = each.join(verified, [payload, "bucket"])
    base = F.col("bucket") * BUCKET
    low, high = F.greatest(F.col("first"), base) - base, F.least(F.col("last") + 1, base + BUCKET) - base
    in_bucket = lambda p: (p >= base) & (p < base + BUCKET) & has_bit(F.col("bits"), p - base)
    whole = bits_between(F.col("bits"), low, high) * piece
    # Whole pieces, less what the first and the last have outside of the file.
    outside = F.when(in_bucket(F.col("first")), F.col("begin") - F.col("first") * piece).otherwise(0) + F.when(in_bucket(F.col("last")), (F.col("last") + 1) * piece - F.col("end")).otherwise(0)
    sums = met.groupBy(payload, *key).agg(F.sum(whole - outside).alias("covered"))
    pieces = F.coalesce(F.col("last") - F.col("first") + 1, F.lit(0))
    short = F.when(F.col("last") == F.floor((F.col("total") - 1) / piece), F.col("total") - F.col("last") * piece - piece).otherwise(0)
    out = files.join(sums, [payload, *key], "left")
    return out.select(payload, *key, (F.col("end") - F.col("begin")).alias("bytes"), F.coalesce("covered", F.lit(0)).alias("covered"), pieces.alias("pieces"), F.when(pieces > 0, pieces * piece + short).otherwise(0).alias("capacity"))


def payloads(files: DataFrame, payload: str, verified: DataFrame, piece: int) -> DataFrame:
    """(payload, bytes, pieces, verified, covered): of each payload its pieces, how many are verified and their bytes."""
    totals = files.groupBy(payload).agg(F.max("total").alias("bytes")).withColumn("pieces", F.ceil(F.col("bytes") / piece))
    counts = verified.join(totals, payload)
    base = F.col("bucket") * BUCKET
    high = F.least(F.col("pieces"), base + BUCKET) - base
    last = F.col("pieces") - 1
    short = F.when((last >= base) & (last < base + BUCKET) & has_bit(F.col("bits"), last - base), F.col("pieces") * piece - F.col("bytes")).otherwise(0)
    sums = counts.groupBy(payload).agg(F.sum(bits_between(F.col("bits"), F.lit(0), high)).alias("verified"), F.sum(short).alias("short"))
    out = totals.join(sums, payload, "left").fillna(0, ["verified", "short"])
    return out.select(payload, "bytes", "pieces", "verified", (F.col("verified") * piece - F.col("short")).alias("covered"))
