"""The stored inverted index against scores and counts worked out plainly."""

import math
import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline.operators import text_index
from weftline.operators.text_index import TextIndex

WORDS = ["alpha", "beta", "gamma", "delta", "beth", "bell", "omega"]


def corpus(n, seed):
    """A few documents are about omega; the rest hardly name it."""
    rng = random.Random(seed)
    out = {}
    for i in range(n):
        words = rng.choices(WORDS[:6], k=rng.randrange(30))
        if i % 97 == 5:
            words += ["omega"] * 8
        out[seed * 100_000 + i * 7] = " ".join(words)
    return out


def frame(spark, texts):
    return spark.createDataFrame([(k, t, f"f{k % 3}") for k, t in texts.items()], "id long, text string, facet string")


def scores(texts, terms):
    tokens = {k: re.findall(r"\w+", t) for k, t in texts.items()}
    n, mean = len(tokens), sum(map(len, tokens.values())) / len(tokens)
    df = {t: sum(t in w for w in tokens.values()) for t in terms}
    out = {}
    for k, w in tokens.items():
        c = Counter(w)
        if any(c[t] for t in terms):
            out[k] = sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * len(w) / mean)) for t in terms if c[t])
    return out


def best(found, limit):
    return [(k, pytest.approx(s)) for k, s in sorted(found.items(), key=lambda x: (-x[1], x[0]))[:limit]]


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if not f.startswith(("current", ".current", "_", "."))}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    was, text_index.CELL = text_index.CELL, 64
    texts = corpus(2500, 1)
    index = TextIndex(spark, path)
    index.add(frame(spark, texts), "id", "text", ["facet"], every=1_000)
    yield index, texts, path
    text_index.CELL = was


def test_flush_every_so_many_records(built):
    index, texts, _ = built
    found = index.segments()
    assert len(found) == 3 and sum(s.n for s in found) == len(texts)
    assert sum(s.terms for s in found) == sum(len(t.split()) for t in texts.values())
    with pytest.raises(ValueError):
        index.add(index.docs(), "key", "facet", every=10)


@pytest.mark.parametrize(("terms", "limit"), [(["omega"], 5), (["omega", "beta"], 20), (["alpha", "beta", "gamma"], 7), (["beta"], 5000), (["missing"], 5)])
def test_scores(built, terms, limit):
    index, texts, _ = built
    assert [(r["key"], r["score"]) for r in index.search(terms, limit).collect()] == best(scores(texts, terms), limit)


def test_blocks_below_the_threshold_stay_shut(built):
    index, texts, _ = built
    every = scores(texts, ["omega", "beta"])
    least = sorted(every.values())[-10]
    opened = index.opened(["omega", "beta"], 10, least)
    stored = index.blocks(["omega", "beta"]).select("segment", "cell").distinct()
    assert 0 < opened.count() < 0.7 * stored.count()


def test_only_the_buckets_of_the_terms_are_read(built):
    index, _, _ = built
    asked = {re.search(r"bucket=(\d+)", f)[1] for f in index.blocks(["omega"]).inputFiles() if "bucket=" in f}
    plan = index.blocks(["omega"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("PushedFilters")[0] and "In(term" in plan or "EqualTo(term" in plan
    assert asked


def test_search_among_facets(built):
    index, texts, _ = built
    part = {k: t for k, t in texts.items() if k % 3 == 1}
    found = index.search_among([["omega", "beta"], ["delta"]], "facet = 'f1'").collect()
    for i, terms in enumerate((["omega", "beta"], ["delta"])):
        assert {r["key"]: r["score"] for r in found if r["query"] == i} == {k: pytest.approx(s) for k, s in scores(part, terms).items()}


@pytest.mark.parametrize("words", [["alpha", "beta"], ["omega", "omega", "omega"], ["beta", "alpha", "beta"], ["delta"], ["alpha", "nothing"]])
def test_phrases(built, words):
    index, texts, _ = built
    wanted = {}
    for k, t in texts.items():
        w = t.split()
        n = sum(w[i : i + len(words)] == words for i in range(len(w)))
        if n:
            wanted[k] = n
    assert {r["key"]: r["n"] for r in index.phrase(words).collect()} == wanted


def test_prefixes(built):
    index, texts, _ = built
    wanted = {k: (len({x for x in t.split() if x.startswith("be")}), sum(x.startswith("be") for x in t.split())) for k, t in texts.items()}
    assert {r["key"]: (r["terms"], r["n"]) for r in index.prefix("be").collect()} == {k: v for k, v in wanted.items() if v[0]}


def test_segments_are_added_merged_and_survive_failure(spark, tmp_path):
    index, one, two = TextIndex(spark, str(tmp_path)), corpus(400, 2), corpus(300, 3)
    index.add(frame(spark, one), "id", "text")
    before = files(tmp_path)
    index.add(frame(spark, two), "id", "text")
    after = files(tmp_path)
    assert before.items() <= after.items() and len(after) > len(before)
    # A build that fails before the swap leaves its files and no segment.
    broken = frame(spark, corpus(50, 4)).withColumn("text", F.when(F.col("id") > 400_100, F.raise_error(F.lit("lost"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="lost"):
        index.add(broken, "id", "text")
    both = one | two
    for merged in (False, True):
        if merged:
            assert index.merge().n == 700 and len(index.segments()) == 1
        assert [(r["key"], r["score"]) for r in index.search(["omega", "alpha"], 12).collect()] == best(scores(both, ["omega", "alpha"]), 12)
        assert index.docs().count() == 700
    assert not before.keys() & files(tmp_path).keys()


def test_odd_texts(spark, tmp_path):
    index = TextIndex(spark, str(tmp_path))
    index.add(spark.createDataFrame([(1, None), (2, ""), (3, "Ünder — ünder"), (4, "x " * 30_000)], "id long, text string"), "id", "text")
    assert [(s.n, s.terms) for s in index.segments()] == [(4, 30_002)]
    assert [r["key"] for r in index.search(["under"], 3).collect()] == [3]
    assert {r["key"]: r["n"] for r in index.phrase(["x", "x"]).collect()} == {4: 29_999}
    empty = TextIndex(spark, str(tmp_path / "none"))
    assert empty.segments() == []
