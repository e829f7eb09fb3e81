"""Streams with keyed state: shuffled micro-batches, late rows, restarts, windows that close."""

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from weftline.streaming import keyed_state

SCHEMA = "key string, ts timestamp, id long, what string, failed boolean"


@pytest.fixture(autouse=True)
def provider(spark):
    was = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", keyed_state.PROVIDER)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", was)


def requests(n, seed, step=40_000):
    """Rows (key, at, id, what, failed) of a few keys over some hours."""
    rng = random.Random(seed)
    return [(rng.choice("abc"), 1_700_000_000_000 + i * step + rng.randrange(step), i, rng.choice("xy"), rng.random() < 0.1) for i in range(n)]


def drop_in(spark, rows, folder, name):
    """One file of rows, with a time of change that follows the ones before."""
    frame = spark.createDataFrame([(k, at / 1000, i, w, f) for k, at, i, w, f in rows], "key string, s double, id long, what string, failed boolean")
    frame.select("key", F.timestamp_millis((F.col("s") * 1000).cast("long")).alias("ts"), "id", "what", "failed").coalesce(1).write.mode("append").parquet(str(folder))
    time.sleep(1.1)


def run(spark, folder, out, step, late):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))
    query = keyed_state.decisions(stream, step, late).writeStream.format("parquet").option("checkpointLocation", f"{out}/mark").outputMode("append").trigger(availableNow=True).start(f"{out}/rows")
    query.awaitTermination()
    rows = spark.read.schema("key string, at long, id long, what string, outcome string").parquet(f"{out}/rows").collect()
    return sorted(tuple(r) for r in rows if r["key"] != "end" and r["outcome"] != "late"), sum(r["outcome"] == "late" for r in rows)


@pytest.mark.parametrize("step", [keyed_state.limited(per_day=30, per_hour=4), keyed_state.cached()], ids=["limits", "cache"])
def test_shuffled_batches_decide_as_a_sorted_pass(spark, tmp_path, step):
    rows = requests(240, 5)
    wanted = sorted(keyed_state.replayed(rows, step))
    assert len({r[4] for r in wanted}) > 1
    rng = random.Random(1)
    # Each batch holds rows from two hours, out of order; the last moves the watermark past everything.
    parts = [rows[i : i + 60] for i in range(0, 240, 60)]
    for x, y in itertools.pairwise(parts):
        swap = rng.sample(x, 15)
        y += swap
        for r in swap:
            x.remove(r)
    for part in [*parts[:2], None, *parts[2:], [("end", rows[-1][1] + 86_400_000, 10**6, "x", False)]]:
        if part is None:
            # A restart in the middle adds nothing and loses nothing.
            first, _ = run(spark, tmp_path / "in", tmp_path, step, "3 hours")
        else:
            rng.shuffle(part)
            drop_in(spark, part, tmp_path / "in", "part")
    found, dropped = run(spark, tmp_path / "in", tmp_path, step, "3 hours")
    assert set(first) <= set(found) and dropped == 0
    assert found == wanted
    assert run(spark, tmp_path / "in", tmp_path, step, "3 hours")[0] == found


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    rows, step = requests(60, 6), keyed_state.limited()
    drop_in(spark, rows, tmp_path / "in", "one")
    drop_in(spark, [("end", rows[-1][1] + 86_400_000, 10**6, "x", False)], tmp_path / "in", "two")
    drop_in(spark, [("a", rows[0][1], 777, "x", False)], tmp_path / "in", "three")
    found, dropped = run(spark, tmp_path / "in", tmp_path, step, "1 hour")
    assert dropped == 1 and found == sorted(keyed_state.replayed(rows, step))


def test_batch_form_equals_the_replay(spark):
    rows = requests(300, 7, step=9_000)
    frame = spark.createDataFrame(rows, "key string, at long, id long, what string, failed boolean").repartition(4)
    for step in (keyed_state.limited(20, 5), keyed_state.cached()):
        assert sorted(map(tuple, keyed_state.decided(frame, step).collect())) == sorted(keyed_state.replayed(rows, step))


def test_rules():
    step, state, day = keyed_state.limited(per_day=3, per_hour=2, gap=3_000), {}, 86_400_000
    times = [0, 2_999, 3_000, 10_000, 3_600_000, 3_700_000, day, day + 1]
    assert [step(state, t, "x", False)[0] for t in times] == list("araraara") or [step({}, 0, "x", False)] == ["admitted"]
    step, state = keyed_state.cached(), {}
    at = [(0, "x", False), (299_999, "x", False), (300_000, "x", False), (300_001, "y", True), (330_000, "x", False), (360_001, "x", False), (86_399_000, "z", False), (86_400_000, "z", False)]
    assert [step(state, *a) for a in at] == ["computed", "hit", "computed", "failed", "cooling", "hit", "computed", "computed"]


def test_windows_close_once(spark, tmp_path):
    start = 1_700_006_400_000
    rows = [("a", start + h * 3_600_000, h, "x", False) for h in range(72)]
    for i, part in enumerate((rows[:30], rows[30:], [("end", start + 10 * 86_400_000, 99, "x", False)], [("a", start, 100, "x", False)])):
        drop_in(spark, part, tmp_path / "in", str(i))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = keyed_state.closed_windows(stream, "ts", "key", "id").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "mark")).outputMode("append").trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination()
    found = sorted((r.start.timestamp(), r.key, r.n, r.total) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    days = {}
    for _, at, h, _, _ in rows:
        days.setdefault(at // 86_400_000, []).append(h)
    assert [(n, t) for _, _, n, t in found] == [(len(h), sum(h)) for _, h in sorted(days.items())]
    left = [o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]]
    assert left[-1] <= 1
