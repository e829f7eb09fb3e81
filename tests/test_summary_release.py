"""The validator of summary releases: a sound release has no violation, each fault shows under its own name."""

from weftline.operators import checks

SUMMARY = "id string, kind string, period string, title string, recording_id string, publication string"
ITEM = "id string, section string, text string, classification string, sources array<string>"
SECTIONS, CLASSES = ["summary", "topics", "uncertainties"], ["statement", "uncertainty"]
GOOD = [
    ("all", "archive", None, "All", None, "approved"),
    ("y-2020", "yearly", "2020", "2020", None, "approved"),
    ("m-2020-01", "monthly", "2020-01", "January", None, "approved"),
    ("t-1", "transcript", "2020-01", "One", "r1", "approved"),
]
ITEMS = [(s[0], "summary", "text", "statement", ["r1"]) for s in GOOD] + [("t-1", "uncertainties", "text", "uncertainty", ["r1"])]


def found(spark, summaries, items, prepared=False):
    published = spark.createDataFrame([("r1",), ("r2",), (None,)], "recording_id string")
    out = checks.summary_release(spark.createDataFrame(summaries, SUMMARY), spark.createDataFrame(items, ITEM), published, SECTIONS, CLASSES, prepared)
    return {r.check: r.violations for r in out.collect() if r.violations}


def test_sound_release(spark):
    assert found(spark, GOOD, ITEMS) == {}
    assert found(spark, [], []) == {}


def test_faults_of_summaries(spark):
    bad = [
        ("index", "archive", None, "x", None, "approved"),
        ("m-bad", "monthly", "2020-13", "x", None, "prepared"),
        ("t-2", "transcript", None, " ", "r9", "approved"),
        ("t-2", "yearly", None, "x", "r1", "approved"),
        (None, None, None, None, None, None),
    ]
    items = [*ITEMS, *[(i, "summary", "text", "statement", ["r9"] if i == "t-2" else ["r1"]) for i in ("index", "m-bad")]]
    got = found(spark, GOOD + bad, items)
    assert got == {"ids": 2, "unique ids": 1, "kinds": 1, "publication": 2, "titles": 2, "periods": 1, "kind and period": 1, "unreleased": 1, "recordings": 1, "unique scopes": 1, "empty": 3}
    assert found(spark, [("p", "archive", None, "x", None, "prepared")], [("p", "summary", "t", "statement", ["r1"])], True) == {}


def test_faults_of_items(spark):
    bad = [
        ("t-1", "topics", "", "statement", ["r1"]),
        ("t-1", "topics", "t", "statement", ["r2"]),
        ("all", "uncertainties", "t", "statement", ["r1", "r1"]),
        ("all", "topics", "t", "other", None),
        ("all", "none", "t", "statement", ["r9"]),
        ("gone", "topics", "t", "statement", []),
        *[("y-2020", "topics", "t", "statement", ["r1"])] * 101,
    ]
    assert found(spark, GOOD, ITEMS + bad) == {"texts": 1, "foreign sources": 1, "classes": 2, "sources": 3, "sections": 1, "unreleased sources": 1, "long sections": 1, "orphans": 1}
