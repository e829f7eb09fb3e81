"""Iterative graph operators over edge DataFrames: reachability, components, cycles, pruning.

Every round is written to the checkpoint folder, so a lost executor re-reads it and plans stay short.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which the driver and all executors share; where it is unset, local sessions get one of their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="weftline-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder."""
    path = f"{shared_folder(df.sparkSession)}/graph-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reachable(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(id, label): every vertex reached from seeds (id, label) along edges (a, b), seeds included, with its highest label.

    A vertex is passed on again only when a higher label reaches it, so cycles end. Each round writes the fresh labels
    alone; those known before are only looked up for the vertices the round has reached.
    """
    edges = written(edges.select("a", "b"))
    fresh = known = written(seeds.groupBy("id").agg(F.max("label").alias("label")))
    while fresh.limit(1).count():
        step = written(fresh.join(edges, fresh["id"] == edges["a"]).groupBy(F.col("b").alias("id")).agg(F.max("label").alias("label")))
        no_better = known.withColumnRenamed("label", "held").join(step, "id").where("held >= label").select("id").distinct()
        fresh = written(step.join(no_better, "id", "left_anti"))
        known = known.unionByName(fresh)
    return known.groupBy("id").agg(F.max("label").alias("label"))


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest vertex each vertex of the undirected edges (a, b) is connected to."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy(F.col("a").alias("id")).agg(F.min("component").alias("m"))
        step = labels.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "m").alias("component"))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("far"))
        step = written(step.join(jump, "component", "left").select("id", "old", F.coalesce("far", "component").alias("component")))
        changed = step.where("component <> old").limit(1).count()
        labels = step.select("id", "component")
        if not changed:
            return labels


def closing_edges(edges: DataFrame, new: DataFrame) -> DataFrame:
    """new (a, b) with cyclic: would the edge close a cycle of edges, i.e. is there a path from its b to its a?

    Paths are followed from all targets at once; each round writes the (target, vertex) pairs it has reached first.
    """
    edges, new = written(edges.select("a", "b")), new.select("a", "b").distinct()
    fresh = seen = written(new.select(F.col("b").alias("start"), F.col("b").alias("at")).distinct())
    while fresh.limit(1).count():
        step = fresh.join(edges, fresh["at"] == edges["a"]).select("start", F.col("b").alias("at")).distinct()
        fresh = written(step.join(seen, ["start", "at"], "left_anti"))
        seen = seen.unionByName(fresh)
    found = seen.select(F.col("start").alias("b"), F.col("at").alias("a"), F.lit(True).alias("cyclic"))
    return new.join(found, ["a", "b"], "left").select("a", "b", F.coalesce("cyclic", F.lit(False)).alias("cyclic"))


def on_cycles(edges: DataFrame) -> DataFrame:
    """Vertices left when those without an edge in or without an edge out are taken away again and again.

    Empty for an acyclic graph; otherwise every cycle, and what lies between cycles.
    """
    left = written(edges.select("a", "b").distinct())
    n = left.count()
    while n:
        sources, targets = left.select(F.col("a").alias("v")).distinct(), left.select(F.col("b").alias("v")).distinct()
        inner = sources.intersect(targets)
        kept = left.join(inner.withColumnRenamed("v", "a"), "a", "left_semi").join(inner.withColumnRenamed("v", "b"), "b", "left_semi")
        left = written(kept)
        now = left.count()
        if now == n:
            break
        n = now
    return left.select(F.col("a").alias("id")).union(left.select("b")).distinct()


def pruned(vertices: DataFrame, links: dict[str, DataFrame]) -> DataFrame:
    """Vertices (id) that have at least one row in every link table (id, ...)."""
    for table in links.values():
        vertices = vertices.join(table.select("id").distinct(), "id", "left_semi")
    return vertices


def strongest_edges(edges: DataFrame, support: float, lift: float, cap: int) -> tuple[DataFrame, int]:
    """The cap heaviest edges (a, b, weight, lift) that have the support and lift; and how many more qualify."""
    good = edges.where((F.col("weight") >= support) & (F.col("lift") >= lift))
    return good.orderBy(F.desc("weight"), "a", "b").limit(cap), max(0, good.count() - cap)


def degrees(edges: DataFrame) -> DataFrame:
    """(id, degree, links): summed weight and number of the edges at each vertex."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("id"), "weight")
    return ends.groupBy("id").agg(F.sum("weight").alias("degree"), F.count("*").alias("links"))


def mention_graph(mentions: DataFrame, entity: str, recording: str, basis: str) -> DataFrame:
    """(entity, recording, basis): one edge for each entity and recording that meet, with the sorted set of bases."""
    return mentions.groupBy(entity, recording).agg(F.array_sort(F.collect_set(basis)).alias(basis))


def weighted_components(edges: DataFrame) -> DataFrame:
    """One row for each component of edges (a, b, weight): component (least id), members, weight, place by weight, heaviest first."""
    from weftline.operators import ranks

    found = written(components(edges.select("a", "b")))
    weights = edges.join(found, edges["a"] == found["id"]).groupBy("component").agg(F.sum("weight").alias("weight"))
    sizes = found.groupBy("component").agg(F.count("*").alias("members"))
    rows = weights.join(sizes, "component").withColumn("lot", F.lit(0))
    return ranks.numbered(rows, "lot", [F.desc("weight"), F.asc("component")]).select("component", "members", "weight", (F.col("place") + 1).alias("place"))
