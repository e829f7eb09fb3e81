"""Hand-computed cases of the core operators (FIXTURES.md), sources, sinks and streams."""

import hashlib
import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.functions import text as tx
from weftline.operators import checks, folds, fulltext, graphs, intervals, matrices, ranks, resolve, statistics, vectors
from weftline.sources import codec, importers, readers, sinks
from weftline.streaming import decision_log


@pytest.fixture(scope="module")
def passages(spark):
    rows = [(0, "A", 0, 2016, "games", 1.0), (1, "A", 0, 2016, "games", 2.0), (2, "A", 0, 2016, "family", -1.0), (3, "B", 1, 2017, "family", 0.0), (4, "B", 1, 2017, None, None), (5, "B", 1, 2017, "family", 3.0)]
    return spark.createDataFrame(rows, "idx int, recording string, kind int, year int, subject string, dim0 double")


def test_subject_shares(passages):
    found = {(r.kind, r.year, r.subject): r.share for r in statistics.shares(passages, ["kind", "year"], "subject", 2).collect()}
    assert found == {(0, 2016, "games"): 0.666667, (0, 2016, "family"): 0.333333, (1, 2017, "family"): 1.0}


def test_held_constant_needs_support(passages):
    found = {r.year: (r.n, r.observed, r.standardised) for r in statistics.standardised(passages, "year", "subject", "dim0", 2, least_stratum=1).collect()}
    assert found[2016][:2] == (3, 0.666667) and found[2016][2] == pytest.approx(1.5 * 0.4 + -1 * 0.6, abs=1e-6)
    assert all(r.standardised is None for r in statistics.standardised(passages, "year", "subject", "dim0", 30).collect())


def test_time_series_and_intervals(spark):
    rows = [(2020, 0.8, 0.7, 0.9, 0.9), (2020, 0.2, 0.1, 0.3, 0.5), (None, 0.5, 0.1, 0.2, 0.1), (2020, float("nan"), 1.0, 1.0, 1.0)]
    frame = spark.createDataFrame(rows, "p int, v double, low double, high double, c double")
    r = statistics.time_series(frame, F.col("p"), "v", "low", "high", F.col("c")).first()
    assert (r.period, r.n, r["mean"], r.low, r.high, r.coverage, r.ci_low) == (2020, 2, 0.5, 0.4, 0.6, 0.7, None)
    partial = frame.withColumn("low", F.when(F.col("v") == 0.8, F.col("low")))
    assert statistics.time_series(partial, F.col("p"), "v", "low", "high", F.col("c")).first().low is None
    six = spark.range(1, 7).agg(F.count("*").alias("n"), F.avg("id").alias("m"), F.stddev_samp("id").alias("s"))
    lo, hi = six.select(*statistics.mean_interval(F.col("m"), F.col("s"), F.col("n"))).first()
    assert (lo, hi) == pytest.approx((3.5 - 1.96 * np.sqrt(3.5 / 6), 3.5 + 1.96 * np.sqrt(3.5 / 6)))


def test_effect(spark):
    cols = [F.lit(float(x)) for x in (10, 1, 2, 10, 3, 2)]
    assert spark.range(1).select(statistics.effect(*cols)).first()[0] == 1
    assert spark.range(1).select(statistics.effect(*[F.lit(float(x)) for x in (1, 1, 2, 1, 3, 2)])).first()[0] is None


def test_ranges_and_caps(spark):
    ranges = spark.createDataFrame([("k", 0, 1), ("k", 2, 4), ("k", 7, 9)], "k string, a int, b int")
    assert sorted((r.first, r.last) for r in statistics.merged_ranges(ranges, "k", "a", "b").select(F.col("first"), F.col("last")).collect()) == [(0, 4), (7, 9)]
    ten = spark.range(10).withColumn("k", F.lit(1))
    assert sorted(r.id for r in statistics.evenly_spaced(ten, "k", ["id"], 4).collect()) == [0, 3, 6, 9]
    near = intervals.merge_near(spark.createDataFrame([(1, t, i) for i, t in enumerate([0, 50, 120, 130, 400])], "k long, t long, i long"), "k", "t", "i", 100)
    assert sorted((r["first"], r.n, r["last"]) for r in near.collect()) == [(0, 2, 50), (120, 2, 130), (400, 1, 400)]


def test_length_buckets(spark):
    limits = {1: "under-5", 299999: "under-5", 300000: "5-20", 1199999: "5-20", 1200000: "20-60", 3599999: "20-60", 3600000: "60-180", 10799999: "60-180", 10800000: "180-plus", 0: "unknown", -1: "unknown"}
    frame = spark.createDataFrame([(k,) for k in limits] + [(None,)], "ms long")
    found = {r.ms: r.b for r in frame.select("ms", tx.length_bucket(F.col("ms")).alias("b")).collect()}
    assert found == limits | {None: "unknown"}


def test_text_functions(spark):
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    assert get(tx.slug(F.lit("  Ünïcode Títle: the 2nd! "))) == "unicode-title-the-2nd"
    assert get(tx.words(F.lit("  Japan   TRIP "))) == ["japan", "trip"]
    assert get(tx.match_key(F.lit(" ﬁne  Print\n"))) == "fine print"
    assert get(tx.canonical_json(F.lit('{"b": 1, "a": [1, "é"]}'))) == '{"a":[1,"é"],"b":1}' and get(tx.canonical_json(F.lit("{"))) is None
    assert get(tx.uuid5("6ba7b810-9dad-11d1-80b4-00c04fd430c8", F.lit("python.org"))) == "886313e1-3b8a-5372-9b90-0c9aee199e5d"
    assert get(F.struct(*tx.partial_date(F.lit("2020-02-30")))) == (None, None)
    assert get(F.struct(*tx.partial_date(F.lit("2020-02")))) == (2020, "2020-02")
    assert get(tx.clock(F.lit(3725.9))) == "1:02:05" and get(tx.clock(F.lit(65))) == "1:05"
    assert get(tx.deep_link(F.lit("https://x/y?v=1"), F.lit(12.7))) == "https://x/y?v=1&t=12"
    assert get(fulltext.mentions(F.lit("New Yorkers in New York City, York."), ["York", "New York", "New York City"])) == ["New York City", "York"]


def test_passage_windows(spark):
    sizes = {10: [], 20: [0], 499: [0], 500: [0], 1000: [0, 500], 1200: [0, 500, 700]}
    for n, starts in sizes.items():
        got = spark.range(1).select(F.sequence(F.lit(1), F.lit(n)).alias("w")).select(fulltext.windows(F.col("w"))).first()[0]
        assert got == starts, n


def test_decision_logs(spark):
    log = spark.createDataFrame([("x", 1, "publish", 5), ("x", 2, "hold", 1), ("y", 3, "publish", 1)], "k string, seq long, decision string, at long")
    now = {r.k: r.decision for r in resolve.latest_per_key(log, ["k"], [F.col("seq")]).collect()}
    assert now == {"x": "hold", "y": "publish"}
    gates = spark.createDataFrame([(k, g, "cleared") for k in "xyz" for g in ("a", "b", "c") if (k, g) != ("z", "c")], "k string, gate string, decision string")
    decisions = spark.createDataFrame([(k, "publish") for k in "xyz"], "k string, decision string")
    restricted = spark.createDataFrame([("y",)], "k string")
    assert [r.k for r in resolve.eligible(decisions, gates, restricted, "k", 3).collect()] == ["x"]
    steps = spark.createDataFrame([("r", i, s) for i, s in enumerate(["active", "disputed", "retracted", "active"])], "k string, seq int, state string")
    legal = [("active", "disputed"), ("disputed", "retracted")]
    assert [(r.previous, r.state) for r in resolve.transitions(steps, "k", ["seq"], "state", legal).collect()] == [("retracted", "active")]


def test_as_of_at_the_same_instant(spark):
    left = spark.createDataFrame([("r", 10, "d1"), ("r", 9, "d0"), ("s", 5, "d2")], "k string, t long, d string")
    right = spark.createDataFrame([("r", 10, 1), ("r", 20, 0)], "k string, t long, v int")
    assert {r.d: r.v for r in resolve.as_of(left, right, "k", "t", "v").collect()} == {"d1": 1, "d0": None, "d2": None}
    assert {r.d: r.v for r in resolve.as_of(left, right, "k", "t", "v", backward=False).collect()} == {"d1": 0, "d0": 1, "d2": None}


def test_best_known_fields(spark):
    rows = [("s", 3, None, ""), ("s", 2, None, "url"), ("s", 1, "title", "old")]
    frame = spark.createDataFrame(rows, "k string, rank int, title string, url string")
    r = resolve.best_known(frame, ["k"], ["title", "url"], [F.desc("rank")]).first()
    assert (r.title, r.url) == ("title", "url")


def test_edge_selection(spark):
    edges = spark.createDataFrame([("N1", "N2", 20.0, 4.0), ("N1", "N3", 10.0, 2.0), ("N2", "N3", 8.0, 2.0), ("N4", "N5", 16.0, 8.0), ("N1", "N4", 0.5, 100.0)], "a string, b string, weight double, lift double")
    top, hidden = graphs.strongest_edges(edges, 5, 1.5, 40)
    assert [r.weight for r in top.orderBy(F.desc("weight")).collect()] == [20, 16, 10, 8] and hidden == 0
    assert graphs.strongest_edges(edges, 5, 1.5, 2)[1] == 2
    assert graphs.strongest_edges(edges, 0, 50, 40)[0].first().weight == 0.5
    assert {r.id: (r.degree, r.links) for r in graphs.degrees(graphs.strongest_edges(edges, 5, 1.5, 1)[0]).collect()} == {"N1": (20, 1), "N2": (20, 1)}


def test_reachability_with_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (5, 6)], "a long, b long")
    seeds = spark.createDataFrame([(1, 1), (3, 2)], "id long, label int")
    assert {r.id: r.label for r in graphs.reachable(edges, seeds).collect()} == {1: 2, 2: 2, 3: 2, 4: 2}
    assert {r.id for r in graphs.on_cycles(edges).collect()} == {1, 2, 3}
    assert graphs.on_cycles(edges.where("a <> 3")).count() == 0
    assert {r.id: r.component for r in graphs.components(edges).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 5}


def greedy_groups(edges, cap):
    """One merge at a time from the best edge down: member -> least id of its group."""
    group = {x: {x} for a, b, _ in edges for x in (a, b)}
    linked = {(a, b) for a, b, _ in edges}
    for a, b, _ in sorted(edges, key=lambda e: (-e[2], e[0], e[1])):
        x, y = group[a], group[b]
        if x is not y and len(x) + len(y) <= cap and all((min(i, j), max(i, j)) in linked for i in x for j in y):
            x |= y
            for j in y:
                group[j] = x
    return {m: min(g) for m, g in group.items()}


def grouped(spark, edges, cap):
    frame = spark.createDataFrame(edges, "a long, b long, similarity double")
    return {r["id"]: r["group"] for r in vectors.complete_link_groups(frame, cap).collect()}


def test_complete_link_respects_cap_and_all_pairs(spark):
    edges = [(1, 2, 0.95), (2, 3, 0.94), (1, 3, 0.5), (4, 5, 0.9)]
    assert grouped(spark, [e for e in edges if e[2] >= 0.8], 24) == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4}
    assert grouped(spark, edges, 24) == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}
    assert grouped(spark, edges, 2) == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4}


def test_complete_link_against_one_merge_at_a_time(spark):
    rng = np.random.default_rng(4)
    ids = [(a, b) for a in range(40) for b in range(a + 1, 40)]
    edges = [(a, b, float(np.round(rng.random(), 2))) for a, b in ids if rng.random() < 0.7 or a // 8 == b // 8]
    assert grouped(spark, edges, 5) == greedy_groups(edges, 5)
    assert grouped(spark, edges, 24) == greedy_groups(edges, 24)


@pytest.mark.parametrize(("bits", "most"), [(32, 8), (32, 10), (8, 3), (5, 4), (4, 4)])
def test_hamming_pairs_find_all(spark, bits, most):
    """Hashes that differ from 0 by up to most bits, in every spread of them over the bits; a null vector has no bit set."""
    even = sum(1 << i * bits // most for i in range(most))
    rng = np.random.default_rng(bits)
    hashes = [0, even, (1 << most) - 1, *(int(sum(1 << int(i) for i in rng.choice(bits, min(bits, most + k % 2), replace=False))) for k in range(150))]
    frame = spark.createDataFrame(list(enumerate(hashes)), "id long, h long").withColumn("g", F.col("id") % 2)
    found = {(r.a, r.b): r.distance for r in vectors.hamming_pairs(frame.union(frame.selectExpr("id", "h", "7 as g")), "id", "g", "h", bits, most).where("a < b").collect()}
    assert found == {(i, j): d for i in range(153) for j in range(i + 1, 153) if (d := (hashes[i] ^ hashes[j]).bit_count()) <= most}
    assert [r.h for r in vectors.sign_hash(spark.createDataFrame([([1.0, -1.0, 2.0],), (None,)], "v array<double>"), "v", 3).collect()] == [5, 0]


def test_near_pairs_find_all(spark, monkeypatch):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(120, 8))
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    frame = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(m)], "id long, v array<double>")
    wanted = {(i, j) for i in range(120) for j in range(i + 1, 120) if unit[i] @ unit[j] >= 0.3}
    for block in (2000, 25):
        monkeypatch.setattr(vectors, "BLOCK", block)
        found = vectors.near_pairs(frame, "id", "v", 0.3).collect()
        assert len(found) == len(wanted) and {(r.a, r.b) for r in found} == wanted
        near = {(r.a, r.b) for r in vectors.top_neighbours(frame, frame.where("id % 5 = 0"), "id", "v", 4).collect()}
        assert near == {(i, int(j)) for i in range(0, 120, 5) for j in np.argsort(-(unit @ unit[i]))[:4]}


def clustered(rng, n, spread):
    centres = rng.normal(size=(24, 16))
    return centres[rng.integers(0, 24, n)] + rng.normal(size=(n, 16)) * spread


@pytest.mark.parametrize("spread", [0.03, 3.0])
def test_neighbours_in_reach(spark, monkeypatch, spread):
    """Brute force on clustered and on formless vectors, with repeated, zero and null ones; clusters meet few others."""
    monkeypatch.setattr(vectors, "BLOCK", 40)
    rng = np.random.default_rng(4)
    m = clustered(rng, 600, spread)
    m[7] = m[8] = m[9]
    m[11] = 0
    frame = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(m)] + [(600, None)], "id long, v array<double>").repartition(5)
    unit = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    cos = unit @ unit.T
    for least in (0.9, 0.5, 0.0):
        report = {}
        found = {(r.a, r.b): r.similarity for r in vectors.near_pairs(frame, "id", "v", least, report).collect()}
        sure = {(i, j) for i in range(600) for j in range(i + 1, 600) if cos[i, j] >= least + 1e-9}
        maybe = {(i, j) for i in range(600) for j in range(i + 1, 600) if cos[i, j] >= least - 1e-9}
        assert sure <= found.keys() <= maybe
        assert least < 0.9 or spread > 1 or report["share"] < 0.3
    queries = frame.where("id % 20 = 7")
    report = {}
    best = {}
    for r in vectors.top_neighbours(frame, queries, "id", "v", 6, report).collect():
        best.setdefault(r.a, []).append((r.b, r.similarity))
    assert spread > 1 or report["share"] < 0.5
    for i in range(7, 600, 20):
        assert sorted(s for _, s in best[i]) == pytest.approx(np.sort(cos[i])[-6:])
    near = {}
    for r in vectors.euclidean_neighbours(frame, queries, "id", "v", 6).collect():
        near.setdefault(r.a, []).append(r.distance)
    for i in range(7, 600, 20):
        d = np.delete(np.sqrt(((m - m[i]) ** 2).sum(1)), i)
        assert sorted(near[i]) == pytest.approx(np.sort(d)[:6])
    assert {r.b for r in vectors.top_neighbours(frame.limit(3), frame.where("id = 0"), "id", "v", 10).collect()} == {r.id for r in frame.limit(3).collect() if r.v}
    assert vectors.near_pairs(frame.limit(0), "id", "v", 0.5).count() == 0


def greedy_directed(n, similarity, needed, k, cap):
    """One merge at a time along directed edges, all pairs across as similar as they have to be."""
    edges = []
    for i in range(n):
        for j in sorted(range(n), key=lambda j: (-similarity[i][j], j))[:k]:
            if j > i and similarity[i][j] >= needed[i][j]:
                edges.append((-similarity[i][j], i, j))
    group = {i: {i} for i in range(n)}
    for _, i, j in sorted(edges):
        x, y = group[i], group[j]
        if x is not y and len(x) + len(y) <= cap and all(similarity[u][v] >= needed[u][v] for u in x for v in y):
            x |= y
            for v in y:
                group[v] = x
    return {frozenset(g) for g in group.values() if len(g) > 1}


@pytest.mark.parametrize(("k", "cap"), [(3, 24), (5, 4), (32, 24)])
def test_directed_edges_ask_for_merges(spark, k, cap):
    rng = np.random.default_rng(k)
    m = clustered(rng, 90, 0.5)
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    similarity = np.round(unit @ unit.T, 12)
    entities = rng.integers(0, 40, 90)
    frame = spark.createDataFrame([(i, r.tolist(), "", [str(e)]) for i, (r, e) in enumerate(zip(m, entities, strict=True))], "id long, v array<double>, text string, entities array<string>")
    levels = (0.7, 0.75, 0.8)
    needed = np.where(entities[:, None] == entities[None], levels[0], levels[2])
    edges = vectors.account_edges(frame, "id", "v", levels, neighbours=k).cache()
    groups = vectors.complete_link_groups(edges, cap)
    members = {}
    for r in groups.collect():
        members.setdefault(r["group"], set()).add(r["id"])
    assert {frozenset(g) for g in members.values() if len(g) > 1} == greedy_directed(90, similarity, needed, k, cap)
    recordings = spark.createDataFrame([(i, f"r{i % 7}" if i % 5 else None) for i in range(90)], "id long, recording string")
    for r in vectors.group_figures(edges, groups, recordings).collect():
        ids = sorted(members[r["group"]])
        inner = similarity[np.ix_(ids, ids)]
        assert (r.members, r.least) == (len(ids), pytest.approx(inner.min(), abs=1e-5))
        assert r.medoid == ids[int(np.argmax(np.round(inner.mean(axis=1), 12)))]
        assert r.recordings == len({i % 7 for i in ids if i % 5})
        assert r["id"] == "accounts_" + hashlib.sha256(json.dumps(ids, separators=(",", ":")).encode()).hexdigest()[:24]


@pytest.mark.parametrize(("k", "cap", "few"), [(5, 4, 0), (32, 24, 20), (3, 6, 4096)])
def test_account_groups_without_all_edges(spark, monkeypatch, k, cap, few):
    """As one merge at a time, with facts that forbid pairs, copies of vectors, and accounts with no edge among their best."""
    monkeypatch.setattr(vectors, "FEW", few)
    monkeypatch.setattr(vectors, "ROUNDS", 2)
    rng = np.random.default_rng(k)
    m = clustered(rng, 90, 0.5)
    m[40:50] = m[40]
    said = [["", "In 1990.", "In 1991.", "They married.", "They divorced in 1990."][i] for i in rng.integers(0, 5, 90)]
    entities = rng.integers(0, 30, 90)
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    similarity = np.round(unit @ unit.T, 12)
    levels = (0.7, 0.75, 0.8)
    year, move = [re.findall(r"\d{4}", t) for t in said], [[w for w in ("married", "divorced") if w in t] for t in said]
    apart = lambda c, i, j: bool(c[i] and c[j] and not set(c[i]) & set(c[j]))
    bar = lambda i, j: 1.01 if apart(year, i, j) or apart(move, i, j) else 0.7 if entities[i] == entities[j] else 0.75 if set(year[i]) & set(year[j]) else 0.8
    needed = np.array([[bar(i, j) for j in range(90)] for i in range(90)])
    frame = spark.createDataFrame([(i, r.tolist(), t, [str(e)]) for i, (r, t, e) in enumerate(zip(m, said, entities, strict=True))], "id long, v array<double>, text string, entities array<string>")
    linked = {(i, j) for i in range(90) for j in range(i + 1, 90) if similarity[i, j] >= needed[i, j]}
    assert {(r.a, r.b) for r in vectors.account_edges(frame, "id", "v", levels).collect()} == linked
    facts = vectors.account_facts(frame, "id", "v")
    groups = vectors.account_groups(facts, levels, k, cap)
    members = {}
    for r in groups.collect():
        members.setdefault(r["group"], set()).add(r["id"])
    assert all(g == min(ids) for g, ids in members.items()) and set().union(*members.values()) == {i for pair in linked for i in pair}
    assert {frozenset(g) for g in members.values() if len(g) > 1} == greedy_directed(90, similarity, needed, k, cap)
    inner = {(r.a, r.b): r.similarity for r in vectors.inner_edges(groups, facts).collect()}
    assert inner == {(i, j): pytest.approx(similarity[i, j]) for g in members.values() for i in g for j in g if i < j}


def test_required_similarity(spark):
    rows = [(1, "They married in 1990.", ["x"]), (2, "The divorce of 1990.", ["x"]), (3, "In 1990.", ["x"]), (4, "In 1990.", ["y"]), (5, "In 2001.", ["x"]), (6, "No year.", ["z"])]
    frame = spark.createDataFrame([(i, t, e, [1.0, i / 1000]) for i, t, e in rows], "id long, text string, entities array<string>, v array<double>")
    found = {(r.a, r.b) for r in vectors.account_edges(frame, "id", "v").collect()}
    assert found == {(1, 3), (1, 4), (1, 6), (2, 3), (2, 4), (2, 6), (3, 4), (3, 6), (4, 6), (5, 6)}
    assert vectors.account_edges(frame, "id", "v", (1.0, 1.0, 1.0)).count() == 0


def test_as_of_forward_is_linear(spark):
    left = spark.range(20_000).select(F.lit(1).alias("k"), (F.col("id") * 2).alias("t"), F.col("id").alias("d"))
    right = spark.range(20_000).select(F.lit(1).alias("k"), (F.col("id") * 2 + 1).alias("t"), F.col("id").alias("v"))
    found = resolve.as_of(left, right, "k", "t", "v", backward=False)
    assert found.where("v = d").count() == 20_000


def test_closing_edges(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y")], "a string, b string")
    new = spark.createDataFrame([("c", "a"), ("a", "c"), ("y", "a")], "a string, b string")
    assert {(r.a, r.b): r.cyclic for r in graphs.closing_edges(edges, new).collect()} == {("c", "a"): True, ("a", "c"): False, ("y", "a"): False}


def test_matrices(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(300, 3)) @ np.array([[1, 0.8, 0], [0, 0.6, 0], [0, 0, 1.0]])
    frame = spark.createDataFrame([(r.tolist(),) for r in data], "v array<double>")
    n, mean, cov = matrices.moments(frame, "v")
    assert n == 300 and np.allclose(mean, data.mean(0)) and np.allclose(cov, np.cov(data, rowvar=False))
    _, _, parts, ratio = matrices.pca(frame, "v", 3)
    assert np.allclose(parts @ parts.T, np.eye(3)) and ratio.sum() == pytest.approx(1)
    points = np.array([[0, 0], [1, 0], [0, 1.0]])
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    placed, stress = matrices.classical_mds(d)
    assert np.allclose(np.sqrt(((placed[:, None] - placed[None]) ** 2).sum(-1)), d) and stress[1] < 1e-9
    assert matrices.change_points([0.0] * 10 + [5.0] * 10, [1.0] * 20, penalty=2.0) == [0, 10]
    assert matrices.leaf_order(np.array([[0, 5, 1], [5, 0, 5], [1, 5, 0.0]])) == [0, 2, 1]
    b, r2 = matrices.ols(spark.createDataFrame([([2.0 + 3 * x, float(x)],) for x in range(20)], "v array<double>"), "v")
    assert np.allclose(b, [2, 3]) and r2 == pytest.approx(1)


def test_factor_rotation():
    rng = np.random.default_rng(5)
    pattern = np.array([[0.8, 0], [0.7, 0], [0.75, 0], [0, 0.8], [0, 0.7], [0, 0.6]])
    phi = np.array([[1, 0.4], [0.4, 1]])
    r = pattern @ phi @ pattern.T
    np.fill_diagonal(r, 1)
    assert matrices.parallel_analysis(r, 2000) == 2 and matrices.minimum_partials(r)[0] == 2
    loadings, _ = matrices.principal_axes(r, 2)
    found, between = matrices.promax(loadings)
    found = found * np.sign(found.sum(0))
    if abs(found[0, 0]) < abs(found[0, 1]):
        found = found[:, ::-1]
    assert np.allclose(found, pattern, atol=0.07) and abs(abs(between[0, 1]) - 0.4) < 0.1
    turned, turn = matrices.varimax(loadings)
    assert np.allclose(turn @ turn.T, np.eye(2)) and np.allclose(turned @ turned.T, loadings @ loadings.T)
    scores = rng.multivariate_normal([0, 0], phi, 20_000)
    data = scores @ pattern.T + rng.normal(size=(20_000, 6)) * np.sqrt(1 - np.diag(pattern @ phi @ pattern.T))
    weights = matrices.score_weights(np.corrcoef(data, rowvar=False), pattern, phi)
    assert all(np.corrcoef(data @ weights[:, i], scores[:, i])[0, 1] > 0.85 for i in range(2))


def test_stress_falls_to_zero():
    points = np.random.default_rng(0).normal(size=(8, 3))
    d = np.linalg.norm(points[:, None] - points[None], axis=2)
    curve = matrices.stress_curve(d, 3)
    assert curve[0] > curve[1] > curve[2] and curve[2] < 1e-6
    assert all(abs(x - y) < 1e-6 for _, _, x, y in matrices.shepard_pairs(d, 3)) and len(matrices.shepard_pairs(d)) == 28


def test_release_and_network_checks(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    manifest = frame([(0, 2, 1, 2), (1, 1, 2, 5)], "shard int, rows long, first_id int, last_id int")
    recordings = frame([(1, 0, "x"), (2, 0, "x"), (5, 1, None)], "id int, shard int, slug string")
    segments = frame([(1, 0, 0, 5), (1, 2, 3, 3), (5, 0, 9, 10), (5, 1, 2, 4), (7, 0, 0, 1)], "id int, place int, start int, end int")
    found = {r.check: r.violations for r in checks.release_shape(manifest, recordings, segments).collect()}
    assert found == {"shards": 1, "ranges": 1, "ids": 0, "slugs": 1, "orphans": 1, "places": 1, "lengths": 1, "order": 1}
    names = frame([("A", "g"), ("B", "h"), ("file:x", "g")], "name string, group string")
    annual = frame([(2001, 1.0, 2.0, 3.0), (1999, 3.0, 2.0, 1.0)], "year int, low double, middle double, high double")
    monthly = frame([("2020-13", "A", 1.0), ("2020-01", "C", -1.0)], "month string, name string, rate double")
    edges = frame([("A", "B", 1.0, 1.0, 1.0), ("B", "A", 1.0, 1.0, None), ("A", "A", -1.0, 1.0, 1.0)], "a string, b string, weight double, baseline double, lift double")
    bursts = frame([("A", "2020-02", "2020-01", 1)], "name string, start string, end string, months int")
    found = {r.check: r.violations for r in checks.network_projection(names, annual, monthly, edges, bursts, ["g"]).collect()}
    assert {k for k, v in found.items() if v} == {"names", "groups", "years", "intervals", "months", "month names", "rates", "loops", "unique edges", "weights", "bursts"}


def test_rate_limits(spark):
    rows = [("1", 0), ("1", 1000), ("1", 4000), ("1", 8000), ("1", 12_000)]
    frame = spark.createDataFrame([(int(k), at, i) for i, (k, at) in enumerate(rows)], "key long, at long, id long")
    found = {r.id: r.admitted for r in folds.rate_limited(frame, per_day=3, per_hour=20).collect()}
    assert found == {0: True, 1: False, 2: True, 3: True, 4: False}


def test_packing_in_order(spark):
    frame = spark.createDataFrame([(1, i, s) for i, s in enumerate([5, 5, 1, 20, 3, 3, 3])], "key long, place long, size long")
    packs = [r.pack for r in folds.pack_in_order(frame, 10, 2, by_key=True).orderBy("place").collect()]
    assert packs == [0, 0, 1, 2, 3, 3, 4]


def test_spans_cover(spark):
    rows = [(1, 1000, 95, 0.2, "x"), (1, 1000, 105, 0.9, "x"), (1, 1000, 300, 0.5, "y"), (1, 1000, 300, 0.5, "b"), (2, 90, None, None, None), (3, 5000, None, None, None)]
    marks = spark.createDataFrame(rows, "key long, total long, at long, confidence double, kind string")
    policy = folds.SpanPolicy(direct=100, least=50, target=100, most=150, reach=20, padding=5, most_spans=10)
    found = folds.plan_spans(marks, policy)
    spans = found.where("key = 1").orderBy("n").collect()
    assert (spans[0].start, spans[0].end, spans[0].reason) == (0, 105, "candidate_x") and spans[-1].end == 1000
    assert [s.reason for s in spans if s.end == 300] == ["candidate_b"] and spans[1].reason == "fixed_target"
    assert all(a.end == b.start for a, b in zip(spans, spans[1:], strict=False))
    assert all(50 <= s.end - s.start <= 150 for s in spans)
    assert spans[0].padded_start == 0 and spans[1].padded_start == spans[1].start - 5
    assert [(r.start, r.end, r.padded_end) for r in found.where("key = 2").collect()] == [(0, 90, 90)]
    assert [(r.n, r.reason) for r in found.where("key = 3").collect()] == [(None, "more spans than the policy allows")]
    proof = {r.key: r for r in folds.span_coverage(found).collect()}
    assert set(proof) == {1, 2} and (proof[1].first, proof[1].last, proof[1].core, proof[1].gap, proof[1].overlap) == (0, 1000, 1000, 0, 0)


def test_checks(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, None)], "id int, s string")
    assert [r.id for r in checks.duplicate_keys(a, ["id"]).collect()] == [1]
    assert [r.id for r in checks.orphans(a, "id", spark.createDataFrame([(1,)], "k int"), "k").collect()] == [2]
    assert [r.s for r in checks.outside(a, "s", ["x"]).collect()] == ["y"]
    assert checks.unknown_columns(a, {"id": "int", "t": "string"}) == ["missing t", "unknown s"]
    assert checks.unknown_columns(a, {"id": "bigint", "s": "string"}) == ["id is int, not bigint"]
    m = spark.createDataFrame([("a", "b", 0.5), ("b", "a", 0.5), ("a", "c", 0.1), ("c", "a", 0.2)], "a string, b string, r double")
    assert checks.asymmetric(m, "a", "b", "r").count() == 2


def test_json_lines_reject_others(spark, tmp_path):
    (tmp_path / "good.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert sorted(r.a for r in readers.json_lines(spark, f"file://{tmp_path}/good.jsonl", "a long").collect()) == [1, 2]
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n[1]x\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.json_lines(spark, f"file://{tmp_path}/bad.jsonl", "a long").collect()


def test_bencode():
    value, span = readers.bdecode(b"d4:infod6:lengthi5e4:name1:xe1:zi-3ee")
    assert value == {b"info": {b"length": 5, b"name": b"x"}, b"z": -3} and span == (7, 29)
    for bad in (b"i5", b"5:abc", b"le1", b"x"):
        with pytest.raises(ValueError):
            readers.bdecode(bad)


def test_verified_shards_leave_out_broken_ones(spark, tmp_path):
    import hashlib

    bodies = {"a.json": json.dumps([{"x": 1}, {"x": 2}]), "b.json": json.dumps([{"x": 3}])}
    for name, body in bodies.items():
        (tmp_path / name).write_text(body)
    rows = [(n, len(b), hashlib.sha256(b.encode()).hexdigest()) for n, b in bodies.items()]
    rows[1] = (rows[1][0], rows[1][1], "0" * 64)
    files = spark.read.format("binaryFile").load(f"file://{tmp_path}/*.json")
    good, broken = readers.verified_shards(files, spark.createDataFrame([*rows, ("c.json", 1, "")], "name string, bytes long, sha256 string"), "x: bigint")
    assert sorted(r.x for r in good.collect()) == [1, 2] and sorted(r.name for r in broken.collect()) == ["b.json", "c.json"]


def test_front_matter_and_columns(spark):
    page = '---\nkind: x\ntitle: "A page"\n---\nText [a](https://e.org/1) and [b](http://e.org/2).'
    title, links = spark.range(1).select(*readers.front_matter(F.lit(page))).first()
    assert title == "A page" and links == ["https://e.org/1", "http://e.org/2"]
    import base64

    code = base64.b64encode(np.array([20, -128, -20], "i1").tobytes()).decode()
    assert spark.range(1).select(readers.typed_column(F.lit(code), "i1", -128)).first()[0] == [20.0, None, -20.0]


def test_importers_reject(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    video = lambda i: (i, None, "T", None, "1.5", "public", None, None)
    channel = frame([((None, "UC1", "Name"), [video("abcdefghijk"), video("short"), video(None), video("abcdefghijk")])], importers.CHANNEL)
    found = importers.channel_inventory(channel)
    assert found["videos"].count() == 1 and found["rejects"].count() == 2 and found["videos"].first().duration_ms == 1500
    info = frame([("abcdefghijk", None, None, None, None, None, "20200230", "public", "x", None, None, "/a"), ("bad", *[None] * 10, "/b")], importers.INFO + ", path string")
    found = importers.extractor_info(info)
    assert found["rejects"].first().reason == "no video id" and found["videos"].first().title == "abcdefghijk" and found["videos"].first().duration_ms is None
    lines = frame([("https://archive.org/download/it%20em/a/b+c.mp4",), (" ",), ("http://archive.org/download/x/y.mp4",), ("https://archive.org/details/x/y",), (None,)], "value string")
    found = importers.url_hints(lines, frame([], "source_id string"), "p")
    assert found["hints"].first().native_id == "it em/a/b+c.mp4" and found["rejects"].count() == 2
    items = frame([((None, None), None, "/in/ia-77.json"), ((None, None), [], "/in/none.json"), (("x", "t"), [("20200102-A b-abcdefghijk.ia.mp4", *[None] * 8)], "/in/z.json")], importers.ARCHIVE + ", path string")
    found = importers.archive_metadata(items)
    assert {r.native_id for r in found["sources"].collect()} == {"77", "x"} and found["rejects"].count() == 1
    f = found["files"].first()
    assert (f.title, f.date_label, f.video_id, f.url) == ("A b", "2020-01-02", "abcdefghijk", "https://archive.org/download/x/20200102-A%20b-abcdefghijk.ia.mp4")
    import uuid

    key = importers.SEPARATOR.join(["internet_archive", "archive_item", "x"])
    assert found["sources"].where("native_id = 'x'").first().source_id == "src_" + uuid.uuid5(uuid.UUID(importers.NAMESPACE), key).hex


def test_compact_shards_are_lossless(spark):
    rng = np.random.default_rng(6)

    def value(depth):
        kind = rng.integers(0, 8 if depth else 6)
        if kind < 6:
            return [None, True, 1, 1.5, "a", "b"][kind]
        return {k: value(depth - 1) for k in "xyz"[: rng.integers(0, 4)]} if kind == 6 else [value(depth - 1) for _ in range(rng.integers(0, 4))]

    for _ in range(200):
        rows = [value(2) for _ in range(rng.integers(0, 12))]
        assert json.dumps(codec.unpack(json.loads(json.dumps(codec.pack(rows))))) == json.dumps(rows)
    assert codec.pack([{"a": 1, "b": "x"}] * 3) == ["o", ["a", "b"], [["c", 1, 3], ["c", "x", 3]], 3]
    assert codec.pack(["x", "y", "x", "y"]) == ["d", ["x", "y"], [0, 1, 0, 1]] and codec.pack([1, True]) == ["p", [1, True]]
    assert codec.pack([1, {"a": 2}]) == ["g", [0, 1], [["p", [1]], ["o", ["a"], [["p", [2]]], 1]]]
    for bad in (["c", 1, 1], ["d", ["x"], [1]], ["o", ["a"], [["p", [1, 2]]], 1], ["g", [0, 0], [["p", [1]], ["p", [1]]]], ["q", []], 7):
        with pytest.raises(ValueError):
            codec.unpack(bad)


def test_release_is_sealed(spark, tmp_path):
    rows = spark.range(10).select(F.lit("l").alias("lot"), "id", (F.col("id") * 2).alias("v"))
    sealed = sinks.sealed(sinks.numbered_shards(rows, ["id"], 4, "lot"), ["lot", "shard"], ["id"], ["id", "v"])
    path = f"file://{tmp_path}/release"
    manifest = sinks.write_release(sealed, F.concat_ws("-", "lot", F.col("shard").cast("string")), path)
    assert sorted(r.rows for r in manifest.collect()) == [2, 4, 4] and sinks.validate_release(spark, path).count() == 0
    kept = spark.read.parquet(f"{path}/shards").collect()
    for other, names in (([r for r in kept if r.name != "l-1"], ["l-1"]), (kept + kept[:1], [kept[0].name]), ([r if r.name != "l-1" else (r[0], r[1], r[2].replace('"v":8', '"v":9')) for r in kept], ["l-1"])):
        spark.createDataFrame(other, "name string, rows long, payload string").write.mode("overwrite").parquet(f"{path}/shards")
        assert [r.name for r in sinks.validate_release(spark, path).collect()] == names


def test_numbered_and_quantiles(spark):
    rng = np.random.default_rng(2)
    rows = [("a", float(x), i) for i, x in enumerate(rng.integers(0, 50, 900))] + [("b", float(x), i) for i, x in enumerate(rng.normal(size=7))] + [("c", 3.0, 0), ("d", None, 0)]
    frame = spark.createDataFrame(rows, "lot string, v double, id long").repartition(5)
    found = ranks.numbered(frame, "lot", ["v", "id"], "place", "total").collect()
    for lot in "abcd":
        own = sorted(((r.v or 0, r.id, r.place, r.total) for r in found if r.lot == lot))
        assert [r[2] for r in own] == list(range(len(own))) and {r[3] for r in own} == {len(own)}
    shares = {"low": 0.1, "middle": 0.5, "high": 0.975}
    got = {r.lot: r for r in ranks.quantiles(frame, "lot", "v", shares).collect()}
    assert set(got) == {"a", "b", "c"}
    for lot, r in got.items():
        values = [v for x, v, _ in rows if x == lot]
        assert all(abs(r[k] - np.quantile(values, q)) < 1e-9 for k, q in shares.items())


def test_tokens_without_diacritics(spark):
    frame = spark.createDataFrame([("Crème Brûlée, Ångström ǖ",), ("e\u0301te\u0301 straße",), ("plain",), (None,)], "t string")
    assert [r[0] for r in frame.select(tx.tokens(F.col("t"))).collect()] == [["creme", "brulee", "angstrom", "u"], ["ete", "straße"], ["plain"], None]


def test_contained_against_brute_force(spark):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(30)]
    passages = [(i, " ".join(rng.choice(words, rng.integers(3, 25)))) for i in range(20)]
    docs = [(i, " ".join([*rng.choice(words, 20), passages[i % 20][1][: rng.integers(0, 200)], *rng.choice(words, 5)])) for i in range(40)]
    a, b = spark.createDataFrame(passages, "item long, text string"), spark.createDataFrame(docs, "doc long, text string")

    def grams(t):
        w = t.split()
        return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}

    wanted = {}
    for i, p in passages:
        for d, t in docs:
            if grams(p) and len(grams(p) & grams(t)) >= 0.4 * len(grams(p)):
                wanted[i, d] = len(grams(p) & grams(t)) / len(grams(p))
    found = {(r["item"], r["doc"]): r.containment for r in fulltext.contained(a, "item", b, "doc", "text", 3, 0.4).collect()}
    assert found == wanted and wanted


@pytest.mark.parametrize("every", [2, 16])
def test_stream_keeps_the_latest(spark, tmp_path, every):
    schema = "k long, seq long, state string"
    log, state, mark = (f"file://{tmp_path}/{n}" for n in ("log", "state", "mark"))
    batches = [[(1, 1, "a"), (2, 2, "b")], [(1, 3, "c"), (3, 4, "d")], [(2, 0, "late")], [(3, 5, "e")], [(4, 6, "f")]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(log)
        decision_log.follow_latest(spark.readStream.schema(schema).parquet(log), ["k"], "seq", state, mark, every).awaitTermination()
    assert {r.k: r.state for r in decision_log.current_state(spark, state, ["k"], "seq").collect()} == {1: "c", 2: "b", 3: "e", 4: "f"}
    names = {p.name for p in (tmp_path / "state").iterdir()}
    assert names == ({"base-1", "delta-2", "base-3", "delta-3", "delta-4"} if every == 2 else {f"delta-{i}" for i in range(5)})


def test_stream_windows_agree_with_batch(spark, data):
    events = spark.read.parquet(f"{data}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(data)
    q = decision_log.windowed_counts(stream, "ts", "event_type").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = events.groupBy(F.date_trunc("day", F.col("ts").cast("timestamp")).alias("start"), "event_type").agg(F.count("*").alias("n"))
    assert {(r.start, r.event_type): r.n for r in spark.table("w").collect()} == {(r.start, r.event_type): r.n for r in batch.collect()}


def test_perceptual_hash(spark):
    from weftline.functions import images

    rng = np.random.default_rng(2)
    y, x = np.mgrid[0:32, 0:32]
    base = 100 + 60 * np.sin(x / 5) + 40 * np.cos(y / 7 + x / 11)
    rows = [(0, base), (1, base + rng.normal(0, 2, base.shape)), (2, base * 1.1 + 5), (3, rng.uniform(0, 255, base.shape)), (4, None)]
    frame = spark.createDataFrame([(i, None if p is None else p.ravel().tolist()) for i, p in rows], "id int, p array<double>")
    h = frame.select("id", images.perceptual_hash(F.col("p")).alias("h"))
    pairs = h.alias("a").join(h.where("id = 0").select(F.col("h").alias("h0"), F.lit(0).alias("zero")).alias("b"), F.col("b.zero") <= F.col("a.id"))
    d = {r.id: r.d for r in pairs.select("id", images.hash_distance(F.col("h"), F.col("h0")).alias("d")).collect()}
    assert d[0] == 0 and d[1] <= 0.25 and d[2] <= 0.05 and d[3] >= 0.3 and d[4] is None
