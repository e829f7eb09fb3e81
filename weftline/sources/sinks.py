"""Release sinks: nested documents, content-addressed shards with a manifest written last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import ranks


def nested(parents: DataFrame, children: DataFrame, key: str, name: str, fields: list[str], order: list[str]) -> DataFrame:
    """parents with an array of their children (fields), sorted by order; parents without any get an empty array."""
    rest = [f for f in fields if f not in order]
    grouped = children.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, *rest))).alias(name))
    joined = parents.join(grouped, key, "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.array().cast(grouped.schema[name].dataType)))


def numbered_shards(rows: DataFrame, order: list[str], size: int, lot: str) -> DataFrame:
    """rows with shard: runs of size rows along order within each lot. Lots may be as large as the table."""
    return ranks.numbered(rows, lot, order, "_place").withColumn("shard", F.floor(F.col("_place") / size)).drop("_place")


def sealed(rows: DataFrame, keys: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """One JSON payload per shard with its row count, bytes and sha256."""
    rest = [f for f in fields if f not in order]
    body = F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(*order, *rest))), lambda x: F.struct(*[x[f].alias(f) for f in fields])))
    return rows.groupBy(*keys).agg(F.count("*").alias("rows"), body.alias("payload")).withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("sha256", F.sha2(F.col("payload").cast("binary"), 256))


def write_release(shards: DataFrame, name: Column, path: str) -> DataFrame:
    """Write payloads by name, many shards a file, then the manifest of what was written; readers trust only what it names."""
    spark = shards.sparkSession
    shards.select(name.alias("name"), "rows", "payload").write.mode("errorifexists").parquet(f"{path}/shards")
    kept = spark.read.parquet(f"{path}/shards")
    manifest = kept.select("name", "rows", F.octet_length("payload").cast("long").alias("bytes"), F.sha2(F.col("payload").cast("binary"), 256).alias("sha256"))
    manifest.write.mode("errorifexists").parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def validate_release(spark: SparkSession, path: str) -> DataFrame:
    """Names in the manifest whose shard is missing, doubled or differs in bytes or digest; empty for a sound release.

    Payloads are digested where they are read; only names and digests meet the manifest.
    """
    found = spark.read.parquet(f"{path}/shards").select("name", F.octet_length("payload").cast("long").alias("length"), F.sha2(F.col("payload").cast("binary"), 256).alias("digest"))
    found = found.groupBy("name").agg(F.max("length").alias("length"), F.max("digest").alias("digest"), F.count("*").alias("n"))
    joined = spark.read.parquet(f"{path}/manifest").join(found, "name", "left")
    good = (F.col("n") == 1) & (F.col("length") == F.col("bytes")) & (F.col("digest") == F.col("sha256"))
    return joined.where(~F.coalesce(good, F.lit(False))).select("name")
