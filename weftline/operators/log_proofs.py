"""Proof that a log has only been extended: chained digests by key.

A row's digest covers the one before it in its key, so the last one, the head, covers the key's whole history. Of two
snapshots only the heads are compared; where a longer log holds the old head at the old length, the key was extended.
Only keys that were not are looked at row by row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.graphs import written


def chained(log: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """(key, place, row, digest): the log's rows numbered from 0 in each key, with the chain up to each.

    order must tell the rows of a key apart. Rows are sorted by Spark and streamed; no key is gathered.
    """
    body = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    rows = log.select(F.col(key).alias("key"), body.alias("body"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(order)])
    rows = rows.repartition("key").sortWithinPartitions("key", *[f"_{i}" for i in range(len(order))]).select("key", "body")
    kind = rows.schema["key"].dataType.simpleString()

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, place, head = None, -1, ""
        for batch in batches:
            places, rows_, digests = [], [], []
            for k, b in zip(batch["key"], batch["body"], strict=True):
                if place < 0 or k != last:
                    last, place, head = k, -1, ""
                place += 1
                row = hashlib.sha256(b.encode()).hexdigest()
                head = hashlib.sha256((head + row).encode()).hexdigest()
                places.append(place)
                rows_.append(row)
                digests.append(head)
            yield pd.DataFrame({"key": batch["key"], "place": places, "row": rows_, "digest": digests})

    return rows.where("key is not null").mapInPandas(chain, f"key {kind}, place long, row string, digest string")


def heads(chain: DataFrame) -> DataFrame:
    """(key, n, head): kept beside the log."""
    return chain.groupBy("key").agg(F.count("*").alias("n"), F.max_by("digest", "place").alias("head"))


def compared(old: DataFrame, new: DataFrame) -> DataFrame:
    """(key, verdict, place) of each key of two chains: same, extended, added, or the first breach of the old history.

    A breach is the first place at which the chains differ: removed (the key is gone), deleted (the old row stands no
    more, what follows moved up), inserted (a row that was not there moved it down), reordered (the row stands at
    another place) or changed.
    """
    before, after = written(heads(old)), written(heads(new).withColumnRenamed("n", "m").withColumnRenamed("head", "new_head"))
    both = written(before.join(after, "key", "full_outer"))
    # At the old length the new chain has to have the old head: one row a key that grew.
    grown = both.where("n is not null and m > n")
    at = new.join(grown.select("key", (F.col("n") - 1).alias("place"), "head"), ["key", "place"]).where(F.col("digest") == F.col("head")).select("key", F.lit(True).alias("kept"))
    known = both.join(at, "key", "left")
    verdict = (
        F.when(F.col("n").isNull(), "added").when(F.col("m").isNull(), "removed").when((F.col("n") == F.col("m")) & (F.col("head") == F.col("new_head")), "same").when(F.col("kept"), "extended")
    )
    known = written(known.select("key", verdict.alias("verdict")))
    bad = known.where("verdict is null").select("key")
    x = written(old.join(bad, "key", "left_semi"))
    y = written(new.join(bad, "key", "left_semi"))
    sides = x.select("key", "place", F.col("row").alias("was"), F.col("digest").alias("d")).join(y.select("key", "place", F.col("row").alias("now"), F.col("digest").alias("e")), ["key", "place"], "full_outer")
    first = sides.where(~F.coalesce(F.col("d") == F.col("e"), F.lit(False))).groupBy("key").agg(F.min(F.struct("place", "was", "now")).alias("f")).select("key", "f.*")
    first = written(first)
    # Where the two rows of the breach stand from there on in the other history.
    later = lambda rows, column, name: first.join(rows.withColumnRenamed("place", "p"), "key").where((F.col("p") >= F.col("place")) & (F.col("row") == F.col(column))).select("key").distinct().withColumn(name, F.lit(True))
    found = first.join(later(y, "was", "old_later"), "key", "left").join(later(x, "now", "new_later"), "key", "left").fillna(False, ["old_later", "new_later"])
    kind = (
        F.when(F.col("old_later") & F.col("new_later"), "reordered").when(F.col("old_later"), "inserted").when(F.col("now").isNull() | F.col("new_later"), "deleted").otherwise("changed")
    )
    return known.where("verdict is not null").select("key", "verdict", F.lit(None).cast("long").alias("place")).unionByName(found.select("key", kind.alias("verdict"), "place"))
