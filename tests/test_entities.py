"""Discovered phrases and the gazetteer's mentions against regular expressions."""

import random
import time

import regex

from pyspark.sql import functions as F
from weftline.operators import entities


def plain(texts, names):
    pattern = regex.compile(r"(?<![\p{L}\p{N}_])(?:%s)(?![\p{L}\p{N}_])" % "|".join(regex.escape(n) for n in sorted(names, key=len, reverse=True)))
    return {(k, m[0], m.start(), m.end()) for k, t in texts.items() if t for m in pattern.finditer(t)}


def found(spark, texts, names, **more):
    docs = spark.createDataFrame(list(texts.items()), "id long, text string").repartition(3)
    rows = entities.mentions(docs, "id", "text", spark.createDataFrame([(n,) for n in names], "label string"), **more).collect()
    assert len({tuple(r) for r in rows}) == len(rows)
    return {(r["id"], r["label"], r["start"], r["end"]) for r in rows}


def test_mentions_equal_the_expression(spark):
    rng = random.Random(2)
    parts = ["Ann", "Anna", "Ann Lee", "Lee", "Bo", "Ño", "x_y", "R2", "K-9", "a.b"]
    names = sorted({" ".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(900)} | {f"Name{i}" for i in range(100)})
    texts = {i: "".join(rng.choice([*parts, " ", " ", " ", "é", "_", ".", "1", f"Name{rng.randrange(120)}"]) for _ in range(rng.randrange(120))) for i in range(150)}
    texts |= {1000: None, 1001: "", 1002: "Ann Lee Bo " * 5000}
    wanted = plain(texts, names)
    assert len(wanted) > 5000
    assert found(spark, texts, names) == wanted
    # The same, dealt over several automatons.
    assert found(spark, texts, names, most=4000) == wanted
    assert found(spark, texts, []) == set()


def test_many_names_take_linear_time(spark):
    rng = random.Random(4)
    names = [f"{''.join(rng.choices('abcdefghij', k=9))} {i}" for i in range(100_000)]
    texts = {i: " and ".join(rng.choices(names, k=200)) for i in range(40)}
    start = time.perf_counter()
    assert len(found(spark, texts, names)) == 40 * 200
    assert time.perf_counter() - start < 60


def test_discovered_phrases(spark):
    both = "Whether Daniel met Chris Broad is unclear. My friend Sunny was called The a friend, named And, and called Monday."
    rows = [(1, both), (2, both), (3, "In May Anne-Marie Dupont came; Anne-Marie Dupont left. Will Smith. Osaka Castle Park Gate"), (4, "Anne-Marie Dupont"), (5, None)]
    docs = spark.createDataFrame(rows, "id long, text string")
    assert {(r.label, r.docs) for r in entities.discovered(docs, "id", "text").collect()} == {("Chris Broad", 2), ("Sunny", 2), ("Anne-Marie Dupont", 2)}
    assert "Osaka Castle Park" in {r.label for r in entities.discovered(docs, "id", "text", least=1).collect()}


def test_gazetteer_keeps_the_first_of_a_key(spark):
    speakers = spark.createDataFrame([("Japan",), ("Will  Smith",), (" ",)], "label string")
    phrases = spark.createDataFrame([("will smith",), ("New One",), ("YouTube",)], "label string")
    found = {r.label: r.type for r in entities.gazetteer(speakers, phrases).collect()}
    assert found["Japan"] == "person" and found["Will  Smith"] == "person" and found["New One"] == "unknown" and found["YouTube"] == "platform"
    assert "will smith" not in found and len(found) == 17 + 7 + 2
    assert entities.gazetteer(speakers, phrases).where(F.length("id") == 31).count() == len(found)
