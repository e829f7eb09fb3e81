"""Releases that reuse shards: shards named by their content, a validated manifest, one pointer that is swapped.

Folder layout:

* ``shards/digest=D``: the rows of one shard, under the digest of their sorted JSON lines. What has the digest is there
  already; a shard is never changed. Writing one again, after a failure or by a doubled run, replaces it by itself.
* ``manifests/R``: a row for each shard of release R, the digest of its manifest.
* ``current``: the release that counts, put in place by one rename when the manifest has been checked.

A run that fails or is doubled leaves the old release as it was. Shards that no kept release names go on request.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.graphs import written
from weftline.sources import publish


@dataclass
class Published:
    """A release: its name, its shards, those of them that had to be written, and its rows."""

    name: str
    shards: int
    written: int
    rows: int


class Releases:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def current(self) -> str | None:
        body = publish.read_text(self.spark, f"{self.path}/current")
        return json.loads(body)["release"] if body else None

    def manifest(self, release: str | None = None) -> DataFrame:
        """(table, shard, digest, rows) of a release, the current one if none is named."""
        release = release or self.current()
        if release is None:
            return self.spark.createDataFrame([], "`table` string, shard string, digest string, rows long")
        return self.spark.read.parquet(f"{self.path}/manifests/{release}")

    def rows(self, table: str, schema: str, release: str | None = None) -> DataFrame:
        """A table's rows, read from the shards that the release names."""
        named = self.manifest(release).where(F.col("table") == table).select("digest")
        stored = self.spark.read.schema("line string, digest string").parquet(f"{self.path}/shards").join(named, "digest", "left_semi")
        return stored.select(F.from_json("line", schema).alias("r")).select("r.*")

    def publish(self, tables: dict[str, tuple[DataFrame, str]]) -> Published:
        """Publishes tables, name -> (rows, the name of the column with their shard), as the new current release.

        A shard's rows meet in one task to be hashed: shards have bounds, as packing gives them. Equal rows count as
        often as they come; the order of rows does not matter. Nulls are kept.
        """
        lines = None
        for name, (rows, shard) in tables.items():
            rest = [F.col(f"`{c}`") for c in rows.columns if c != shard]
            one = rows.select(F.lit(name).alias("table"), F.col(f"`{shard}`").cast("string").alias("shard"), F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}).alias("line"))
            lines = one if lines is None else lines.unionByName(one)
        body = F.sort_array(F.collect_list("line"))
        packed = lines.groupBy("table", "shard").agg(body.alias("lines"))
        digest = F.sha2(F.concat_ws("\n", F.col("table"), F.array_join("lines", "\n")).cast("binary"), 256)
        packed = written(packed.select("table", "shard", digest.alias("digest"), "lines"))
        manifest = packed.select("table", "shard", "digest", F.size("lines").cast("long").alias("rows"))
        figures = manifest.agg(F.count("*").alias("shards"), F.sum("rows").alias("rows"), _whole(F.concat_ws(":", "table", "shard", "digest")).alias("name")).first()
        release = f"release_{figures['name'] or '0'}"
        old = self.manifest().select("digest").distinct()
        fresh = written(packed.select("digest").distinct().join(old, "digest", "left_anti"))
        rows = packed.dropDuplicates(["digest"]).join(fresh, "digest", "left_semi").select(F.explode("lines").alias("line"), "digest")
        # Each digest's rows are written by one task, in place of whatever an earlier try has left there.
        rows.repartition("digest").sortWithinPartitions("digest", "line").write.option("partitionOverwriteMode", "dynamic").partitionBy("digest").mode("overwrite").parquet(f"{self.path}/shards")
        if not publish.exists(self.spark, f"{self.path}/manifests/{release}/_SUCCESS"):
            manifest.write.mode("overwrite").parquet(f"{self.path}/manifests/{release}")
        broken = self.broken(release, fresh).limit(5).collect()
        if broken:
            raise ValueError(f"{release}: shards are missing or differ: {[r['digest'] for r in broken]}")
        publish.swap_text(self.spark, f"{self.path}/current", json.dumps({"release": release, "shards": figures["shards"], "rows": figures["rows"] or 0}))
        return Published(release, figures["shards"], fresh.count(), figures["rows"] or 0)

    def broken(self, release: str, only: DataFrame | None = None) -> DataFrame:
        """The manifest's shards whose stored rows are missing or have another digest; only: digests to read again."""
        named = self.manifest(release)
        named = named if only is None else named.join(only, "digest", "left_semi")
        stored = self.spark.read.schema("line string, digest string").parquet(f"{self.path}/shards").join(named.select("digest").distinct(), "digest", "left_semi")
        held = stored.groupBy("digest").agg(F.sort_array(F.collect_list("line")).alias("lines"))
        again = F.sha2(F.concat_ws("\n", F.col("table"), F.array_join("lines", "\n")).cast("binary"), 256)
        return named.join(held, "digest", "left").where(~F.coalesce(again == F.col("digest"), F.lit(False))).select("table", "shard", "digest")

    def forget(self, keep: list[str]) -> int:
        """Deletes the manifests of all other releases but the current one, and the shards that none left names."""
        kept = {*keep, self.current()}
        for name in publish.names(self.spark, f"{self.path}/manifests"):
            if name not in kept:
                publish.delete(self.spark, f"{self.path}/manifests/{name}")
        left = publish.names(self.spark, f"{self.path}/manifests")
        named = self.spark.read.parquet(*[f"{self.path}/manifests/{n}" for n in left]).select("digest").distinct()
        stored = self.spark.createDataFrame([(n.removeprefix("digest="),) for n in publish.names(self.spark, f"{self.path}/shards") if n.startswith("digest=")], "digest string")
        gone = [r["digest"] for r in stored.join(named, "digest", "left_anti").collect()]
        for digest in gone:
            publish.delete(self.spark, f"{self.path}/shards/digest={digest}")
        return len(gone)


def _whole(key):
    """A digest of all rows' keys that needs no order: sums of parts of each one's own digest."""
    d = F.sha2(key.cast("binary"), 256)
    parts = [F.sum(F.conv(F.substring(d, 1 + 10 * i, 10), 16, 10).cast("decimal(20,0)")) for i in range(4)]
    return F.substring(F.sha2(F.concat_ws(",", *[p.cast("string") for p in parts]).cast("binary"), 256), 1, 24)
