"""Reconciliation plans: grammars by hand, resolution states, and the assignment against taking pairs one at a time."""

import random

import pytest
from pyspark.sql import functions as F

from weftline.operators import reconcile
from weftline.plans import registry

ID = "abcDEF_-123"
NAMES = {
    f"Show [{ID}].mp4": ("terminal", ID, None),
    f"Show [{ID}].ia.OGV": ("terminal", ID, None),
    f"Show [{ID}]": ("terminal", ID, None),
    f"Show [{ID}].ia": (None, None, None),
    f"Show [{ID}] part 2.mp4": (None, None, None),
    f"Show -{ID}.mp4": (None, None, None),
    f"Show [{ID}].mp4\n": (None, None, None),
    f"Show [{ID}x].mp4": (None, None, None),
    f"Show [{ID}] 480p.WebM": ("format_label_video", None, None),
    f"Show [{ID}].M4A": ("audio_only", None, None),
    "Show [short] 480p.mp4": (None, None, "format_label_invalid_id"),
    "Show [short].m4a": (None, None, "audio_only_invalid_id"),
    f"Show [{ID}] 720p.mp4": (None, None, "ambiguous_suffix"),
    f"Show [{ID}] 480p.m4a": (None, None, "ambiguous_suffix"),
    "": (None, None, None),
    "x" * 5000 + f"[{ID}].mp4": (None, None, None),
    f"a\0b [{ID}].mp4": (None, None, None),
}


def test_grammars(spark):
    rows = spark.createDataFrame([(n,) for n in [*NAMES, None]], "name string")
    name = F.col("name")
    got = {r[0]: tuple(r)[1:] for r in rows.select("name", reconcile.lane(name), reconcile.bracket_id(name), reconcile.rejection(name)).collect()}
    assert got.pop(None) == (None, None, None)
    assert got == NAMES


def _catalogue(spark):
    ids = {n: f"{n:011d}" for n in range(1, 6)}
    natives = [(ids[1], "y1", "r1"), (ids[2], "y2", "r2"), (ids[3], "y3", None), (ids[4], "y4", "r4")]
    links = [("y1", "r1"), ("y1", "r1"), ("y2", "r2"), ("y2", "r9"), ("y3", "r3"), (None, "r5"), ("y4", None)]
    return ids, spark.createDataFrame(natives, "video_id string, source_id string, expected string"), spark.createDataFrame(links, "source_id string, recording_id string")


def test_resolution(spark):
    ids, natives, links = _catalogue(spark)
    asked = spark.createDataFrame([(v, 1) for v in [*ids.values(), None, ids[1]]], "video_id string, extra int")
    got = {r.video_id: (r.resolution_state, r.native_source_id, r.native_recording_id) for r in reconcile.resolved(asked, natives, links).collect()}
    without = "native_source_without_unique_recording"
    assert got == {
        ids[1]: ("unique_native_recording", "y1", "r1"),
        ids[2]: (without, "y2", None),
        ids[3]: (without, "y3", None),
        ids[4]: (without, "y4", None),
        ids[5]: ("missing_native_source", None, None),
    }


def test_bracket_plan(spark):
    ids, natives, links = _catalogue(spark)
    files = [
        ("a", "r7", f"A [{ids[1]}].mp4", f"A [{ids[1]}]"),
        ("b", "r1", f"B [{ids[1]}].mp4", None),
        ("b", "r1", f"B [{ids[1]}].mp4", None),
        ("c", "r8", "C.mp4", f"C [{ids[5]}]"),
        ("d", "r6", f"D [{ids[1]}].mp4", f"D [{ids[2]}]"),
        ("e", "r5", f"E [{ids[1]}].txt", None),
        ("f", None, f"F [{ids[2]}].mkv", "F"),
        (None, None, None, None),
    ]
    plan = reconcile.bracket_plan(spark.createDataFrame(files, "source_id string, recording_id string, name string, title string"), natives, links)
    assert [tuple(r) for r in plan["issues"].collect()] == [("d", "r6", ids[1], ids[2])]
    got = sorted(tuple(r) for r in plan["candidates"].collect())
    assert got == sorted(
        [
            ("source_to_locator", ids[1], "a", "y1", "name_and_title", "unique_native_recording"),
            ("source_to_locator", ids[1], "b", "y1", "name", "unique_native_recording"),
            ("source_to_locator", ids[5], "c", ids[5], "title", "missing_native_source"),
            ("source_to_locator", ids[2], "f", "y2", "name", "native_source_without_unique_recording"),
            ("recording_to_native", ids[1], "r7", "r1", "shared_id", "unique_native_recording"),
            ("repeat", ids[1], "r1", "r7", "shared_id", "repeat"),
        ]
    )


def test_suffix_plan(spark):
    ids, natives, links = _catalogue(spark)
    paths = [("a", f"in/x/A [{ids[1]}] 480p.mp4"), ("b", f"in/B [{ids[5]}].m4a"), ("c", "in/C [no].m4a"), ("d", f"out/D [{ids[1]}].m4a"), ("e", f"E [{ids[1]}].m4a"), ("f", None), ("g", "in/plain.mp4")]
    plan = reconcile.suffix_plan(spark.createDataFrame(paths, "source_id string, path string"), natives, links, ["in"])
    assert sorted(tuple(r) for r in plan["candidates"].collect()) == [
        ("a", "format_label_video", ids[1], "y1", "unique_native_recording"),
        ("b", "audio_only", ids[5], ids[5], "missing_native_source"),
    ]
    assert [tuple(r) for r in plan["rejects"].collect()] == [("in", "audio_only_invalid_id", 1)]


def test_hint_plan(spark):
    side = "native_id string, source_id string, url string"
    listed = spark.createDataFrame([("1", "u1"), ("2", "u2"), ("3", "u3"), ("4", "u4"), ("5", "u5"), (None, "u6")], "native_id string, url string")
    providers = spark.createDataFrame([("1", "p1", "u1"), ("2", "p2", "u2"), ("3", "p3", "other"), ("4", "p4", "u4")], side)
    hints = spark.createDataFrame([("2", "h2", "u2"), ("4", "h4", "other"), ("5", "h5", "u5")], side)
    got = {r["url"]: (r["class"], r["left_id"], r["right_id"]) for r in reconcile.hint_plan(listed, hints, providers).collect()}
    assert got == {
        "u1": ("already_provider", None, None),
        "u2": ("late_provider", "h2", "p2"),
        "u3": ("url_differs", None, None),
        "u4": ("url_differs", None, None),
        "u5": ("provider_missing", None, None),
        "u6": ("provider_missing", None, None),
    }


def test_assignment_takes_pairs_by_level(spark):
    draw = random.Random(5)
    # One key has a third of the rows; some keys are null or one-sided.
    row = lambda i, only: (i, draw.choice(["hot", "hot", *"abcd", None, only]), draw.choice([1, 2, None]), draw.choice(["x", "y"]))
    left, right = [row(i, "left") for i in range(120)], [row(i, "right") for i in range(90)]
    schema = "id long, video string, size int, name string"
    levels = [["video", "size", "name"], ["video", "size"], ["video"]]
    at = {"video": 1, "size": 2, "name": 3}
    expected, taken = {}, set()
    for n, level in enumerate(levels):
        for a in left:
            for b in right:
                equal = all(a[at[c]] is not None and a[at[c]] == b[at[c]] for c in level)
                if equal and a[0] not in expected and b[0] not in taken:
                    expected[a[0]] = (b[0], n, None)
                    taken.add(b[0])
    videos = {b[1] for b in right}
    for a in left:
        if a[0] not in expected:
            expected[a[0]] = (None, None, "no_key" if a[1] is None else "outnumbered" if a[1] in videos else "no_counterpart")
    frames = [spark.createDataFrame(rows, schema).repartition(5) for rows in (left, right)]
    got = {r.id: (r.other, r.level, r.reason) for r in reconcile.assigned(*frames, levels).collect()}
    assert got == expected
    assert {x[2] for x in got.values()} == {None, "no_key", "outnumbered", "no_counterpart"}
    empty = spark.createDataFrame([], schema)
    assert reconcile.assigned(empty, frames[1], levels).count() == 0
    assert {r.reason for r in reconcile.assigned(frames[0], empty, levels).collect()} == {"no_key", "no_counterpart"}


@pytest.mark.parametrize("name", ["G24_bracket_plan", "G24_suffix_plan"])
def test_patterns_are_matched_once(spark, data, name):
    """What is returned is read from written ids: no pattern is left in its plan, to be matched again in every branch."""
    plan = registry.queries()[name](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan and "RLIKE" not in plan


def test_captured_documents_are_compressed(spark):
    from weftline.plans import imports

    rows = spark.range(50).selectExpr("id", "repeat('payload', 20) as name")
    found = imports._json(registry.Tables(spark, ""), rows, "id long, name string")
    assert all(f.endswith(".gz") for f in found.inputFiles()) and sorted(r.id for r in found.collect()) == list(range(50))
