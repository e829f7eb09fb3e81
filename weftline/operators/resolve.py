"""Resolving competing observations and append-only decision logs to one state per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(log: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row of each key that comes first under order. A max_by aggregate: partial sums before the shuffle, no window sort.

    order: columns, largest first (negate or use desc-able expressions for smallest first); ties end with a unique column.
    """
    rest = [c for c in log.columns if c not in keys]
    best = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)])).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest])


def winners(observations: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The winning observation of each key under a mixed ascending and descending order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return observations.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def best_known(observations: DataFrame, keys: Sequence[str], fields: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key; each field is its first non-null, non-empty value in winner order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = observations.withColumn("_n", F.row_number().over(w))
    picked = [F.min_by(F.col(f), F.when(F.col(f).isNotNull() & (F.col(f).cast("string") != ""), F.col("_n"))).alias(f) for f in fields]
    return ranked.groupBy(*keys).agg(*picked)


def first_last(observations: DataFrame, keys: Sequence[str], at: str, tie: str, fields: Sequence[str]) -> DataFrame:
    """Each key's fields at its earliest and latest observation, as first_<field> and last_<field>."""
    when = F.struct(at, tie)
    pick = [f(F.col(c), when).alias(f"{n}_{c}") for c in fields for n, f in (("first", F.min_by), ("last", F.max_by))]
    return observations.groupBy(*keys).agg(*pick)


def transitions(log: DataFrame, key: str, order: Sequence[str], state: str, allowed: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows whose change of state from their predecessor is not allowed; first rows have none."""
    w = Window.partitionBy(key).orderBy(*order)
    moved = log.withColumn("previous", F.lag(state).over(w)).where(F.col("previous").isNotNull())
    legal = F.lit(False)
    for a, b in allowed:
        legal = legal | ((F.col("previous") == a) & (F.col(state) == b))
    return moved.where(~legal)


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, value: str, backward: bool = True) -> DataFrame:
    """left with the right side's value in force at its instant: the last at or before it, or the first after it.

    Both sides are laid on one line per key and the value is carried along it: one shuffle, no inequality join. At an
    equal instant the right row counts as before for the backward direction, and is not after for the forward one.
    """
    extra = [c for c in left.columns if c not in (key, at)]
    side = left.select(key, at, F.struct(*extra).alias("_row"), F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.lit(1).alias("_side"))
    other = right.select(key, at, F.lit(None).cast(side.schema["_row"].dataType).alias("_row"), F.col(value).alias("_v"), F.lit(0).alias("_side"))
    # Forward, the line is walked from its end: a value is carried from what came before either way, in one pass.
    order = [at, "_side"] if backward else [F.desc(at), F.desc("_side")]
    line = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    carried = F.last("_v", ignorenulls=True).over(line)
    both = side.unionByName(other).withColumn("_c", carried).where("_side = 1")
    return both.select(key, at, *[F.col(f"_row.{c}").alias(c) for c in extra], F.col("_c").alias(value))


def eligible(decisions: DataFrame, gates: DataFrame, restricted: DataFrame, key: str, needed: int) -> DataFrame:
    """Keys whose current decision is publish, with needed distinct cleared gates and no restriction."""
    open_ = decisions.where("decision = 'publish'").select(key)
    cleared = gates.where("decision = 'cleared'").groupBy(key).agg(F.countDistinct("gate").alias("_g")).where(F.col("_g") == needed).select(key)
    return open_.join(cleared, key, "left_semi").join(restricted.select(key), key, "left_anti")


def upsert(old: DataFrame, new: DataFrame, key: str, rules: dict[str, str]) -> DataFrame:
    """Merge new rows into old by key: per column replace (new if not null), keep, least, greatest or sum."""
    a, b = old.alias("a"), new.alias("b")
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    merge = {
        "replace": lambda x, y: F.coalesce(y, x),
        "keep": lambda x, y: F.coalesce(x, y),
        "least": F.least,
        "greatest": F.greatest,
        "sum": lambda x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)),
    }
    return joined.select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), *[merge[r](F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c, r in rules.items()])


def insert_ignore(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """old and the new rows whose key it lacks; of new rows with one key, the one that sorts first stays."""
    first = winners(new, keys, [F.col(c) for c in new.columns if c not in keys])
    return old.unionByName(first.join(old, list(keys), "left_anti"))
