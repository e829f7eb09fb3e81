"""Releases that reuse shards, and proofs that logs are only extended."""

import os

import pytest
from pyspark.sql import functions as F

from weftline.operators import log_proofs
from weftline.sources import publish
from weftline.sources.releases import Releases


def table(spark, n, changed=()):
    rows = spark.range(n).select("id", F.concat(F.lit("v"), F.col("id")).alias("v"), (F.col("id") / 50).cast("int").alias("shard"))
    return rows.withColumn("v", F.when(F.col("id").isin(list(changed)), "new").otherwise(F.col("v")))


def stored(path):
    return {d: os.path.getmtime(f"{path}/shards/{d}") for d in os.listdir(f"{path}/shards") if d.startswith("digest=")}


def test_only_changed_shards_are_written(spark, tmp_path):
    r = Releases(spark, str(tmp_path))
    one = r.publish({"t": (table(spark, 5000), "shard")})
    assert (one.shards, one.written, one.rows) == (100, 100, 5000)
    before = stored(tmp_path)
    two = r.publish({"t": (table(spark, 5000, range(100, 150)), "shard")})
    assert (two.shards, two.written) == (100, 1) and r.current() == two.name != one.name
    after = stored(tmp_path)
    assert before.items() <= after.items() and len(after) == 101
    assert {(x.id, x.v) for x in r.rows("t", "id long, v string").collect()} == {(x.id, x.v) for x in table(spark, 5000, range(100, 150)).collect()}
    # The same once more writes nothing and has the same name, whatever the order of the rows.
    again = r.publish({"t": (table(spark, 5000, range(100, 150)).repartition(3).orderBy(F.desc("id")), "shard")})
    assert (again.name, again.written) == (two.name, 0) and stored(tmp_path) == after
    assert r.broken(two.name).count() == 0
    assert r.forget([]) == 1 and len(stored(tmp_path)) == 100
    assert r.rows("t", "id long, v string").count() == 5000


def test_a_crash_before_the_swap_keeps_the_old_release(spark, tmp_path, monkeypatch):
    r = Releases(spark, str(tmp_path))
    one = r.publish({"t": (table(spark, 500), "shard")})

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(publish, "swap_text", lost)
        with pytest.raises(OSError):
            r.publish({"t": (table(spark, 500, [3]), "shard")})
    assert r.current() == one.name
    assert r.rows("t", "id long, v string").where("v = 'new'").count() == 0
    done = r.publish({"t": (table(spark, 500, [3]), "shard")})
    assert done.name == r.current() != one.name
    assert r.rows("t", "id long, v string").where("v = 'new'").count() == 1 and r.rows("t", "id long, v string").count() == 500


def test_damaged_shards_are_named_and_not_published(spark, tmp_path):
    r = Releases(spark, str(tmp_path))
    one = r.publish({"t": (table(spark, 200), "shard")})
    victim = r.manifest().where("shard = '2'").first()["digest"]
    spark.createDataFrame([("{}", victim)], "line string, digest string").write.option("partitionOverwriteMode", "dynamic").partitionBy("digest").mode("overwrite").parquet(f"{tmp_path}/shards")
    assert [x.shard for x in r.broken(one.name).collect()] == ["2"]


def test_tables_nulls_and_repeats(spark, tmp_path):
    r = Releases(spark, str(tmp_path))
    rows = spark.createDataFrame([("a", None, 1), ("a", None, 1), (None, "x", 2)], "k string, v string, s int")
    done = r.publish({"nodes": (rows, "s"), "edges": (rows.limit(0), "s")})
    assert (done.shards, done.rows) == (2, 3)
    assert sorted(map(tuple, r.rows("nodes", "k string, v string").collect()), key=str) == sorted([("a", None), ("a", None), (None, "x")], key=str)
    assert r.rows("edges", "k string, v string").count() == 0


OLD = {k: [f"{k}{i}" for i in range(6)] for k in "abcdefgh"}
NEW = {
    "a": OLD["a"],
    "b": [*OLD["b"], "more"],
    "c": [*OLD["c"][:2], "other", *OLD["c"][3:]],
    "d": [*OLD["d"][:3], *OLD["d"][4:]],
    "e": [*OLD["e"][:1], "in", *OLD["e"][1:]],
    "f": [*OLD["f"][:2], OLD["f"][3], OLD["f"][2], *OLD["f"][4:]],
    "g": OLD["g"][:4],
    "z": ["first"],
}


def log(spark, histories):
    return spark.createDataFrame([(k, i, v) for k, rows in histories.items() for i, v in enumerate(rows)] + [(None, 1, "lost")], "k string, at long, v string").repartition(3)


def test_breaches_are_named(spark):
    old, new = (log_proofs.chained(log(spark, h), "k", ["at"], ["k", "v"]).cache() for h in (OLD, NEW))
    found = {r["key"]: (r.verdict, r.place) for r in log_proofs.compared(old, new).collect()}
    assert found == {
        "a": ("same", None), "b": ("extended", None), "c": ("changed", 2), "d": ("deleted", 3), "e": ("inserted", 1), "f": ("reordered", 2), "g": ("deleted", 4), "h": ("removed", None), "z": ("added", None),
    }
    assert {r["verdict"] for r in log_proofs.compared(old, old).collect()} == {"same"}


def test_heads_cover_the_whole_history(spark):
    heads = log_proofs.heads(log_proofs.chained(log(spark, OLD), "k", ["at"], ["k", "v"]))
    once = {r["key"]: (r.n, r.head) for r in heads.collect()}
    changed = OLD | {"a": ["a0", "a1 ", *OLD["a"][2:]]}
    again = {r["key"]: (r.n, r.head) for r in log_proofs.heads(log_proofs.chained(log(spark, changed), "k", ["at"], ["k", "v"])).collect()}
    assert once["a"] != again["a"] and {k: v for k, v in once.items() if k != "a"} == {k: v for k, v in again.items() if k != "a"}
