"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters, one check per pair.

1. A first pass counts shingles in a sketch of fixed size (SKETCH_LOG2 counters): the global order is by counter, then
   hash, so shingles that many texts share come last. Any order gives exact results; this one keeps lists short.
2. A second pass writes each text's set size, set digest and prefix: the rarest shingles, as many as a partner must
   hit. Copies (equal digests) fall into classes, and only the smallest id of each class goes on.
3. Prefix shingles held by two classes or more give candidates; the others, nearly all, are dropped by a bit filter
   before their rows are shuffled. First each class is checked with one leader, the class that has its shared shingles
   earliest; linked classes become components. Then only pairs across components are left to enumerate: length and
   positional filters in the join, the prefixes' agreement (suffix filter) once per pair.
4. Every surviving pair's full sets are compared once. Connected components over all links are the result.

A group of near copies thus costs about one check per member, not one per pair. Hot shingles are spread by map-side
sums or by Spark's splitting of skewed sort-merge joins; what is broadcast (sketch, filters) has a bounded size, beyond
which filters only let more rows through to the exact joins.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import BitFilter, Scratch, small_batches, unused

SKETCH_LOG2 = 22
SEGMENT_LOG2 = 16
#: Partitions that the rows of one class of copies are dealt over.
SALTS = 32
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
#: Hashes at which the suffix filter cuts sets.
_CUTS = np.arange(1, 16, dtype=np.uint64) << np.uint64(60)
_WORD = xxhash.xxh3_64_intdigest


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; words are ASCII-lower-cased, cut at ASCII white space.

    A text with fewer words is one shingle, one without any has none.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    if len(found) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found), seed=len(found))], np.uint64)
    h = np.fromiter(map(_WORD, found), np.uint64, len(found))
    n = len(h) - words + 1
    mix = h[:n] * _A
    for i in range(1, words):
        mix = (mix ^ (mix >> np.uint64(32))) * _B + h[i : n + i]
    mix = (mix ^ (mix >> np.uint64(29))) * _C
    return np.unique(mix ^ (mix >> np.uint64(32)))


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def sketch(docs: DataFrame, words: int) -> np.ndarray:
    """Counters over the top hash bits of all texts' distinct shingles, summed segment by segment."""
    schema = pa.schema([("segment", pa.int32()), ("counts", pa.binary())])
    size = 1 << SEGMENT_LOG2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, n = np.zeros(1 << SKETCH_LOG2, np.uint32), [], 0
        for batch in batches:
            for text in batch.column(1).to_pylist():
                held.append((shingle_set(text, words) >> np.uint64(64 - SKETCH_LOG2)).astype(np.int32))
                n += len(held[-1])
            if n > 4_000_000:
                total += np.bincount(np.concatenate(held), minlength=len(total)).astype(np.uint32)
                held, n = [], 0
        if n:
            total += np.bincount(np.concatenate(held), minlength=len(total)).astype(np.uint32)
        parts = [(i, total[i * size : (i + 1) * size]) for i in range(len(total) // size)]
        yield _rows(schema, [(i, zlib.compress(p.tobytes(), 1)) for i, p in parts if p.any()])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(zlib.decompress(body), np.uint32)
        yield _rows(schema, [(i, s.tobytes()) for i, s in sums.items()])

    kind = "segment int, counts binary"
    parts = docs.mapInArrow(count, kind).repartition(1 << (SKETCH_LOG2 - SEGMENT_LOG2), "segment").mapInArrow(add, kind).collect()
    table = np.zeros(1 << SKETCH_LOG2, np.uint32)
    for r in parts:
        table[r["segment"] * size : (r["segment"] + 1) * size] = np.frombuffer(r["counts"], np.uint32)
    return table


def prefixes(docs: DataFrame, counts: Broadcast, words: int, num: int, den: int) -> DataFrame:
    """doc_id, n, d1, d2 (the set's digest), prefix (rarest first), for every row of docs."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("prefix", pa.list_(pa.int64()))])

    def one(at: int | None, text: str | None) -> tuple:
        h = shingle_set(text, words)
        n = len(h)
        if not n:
            return at, 0, 0, 0, []
        digest = np.frombuffer(xxhash.xxh3_128_digest(h.tobytes()), np.int64)
        rare = counts.value[(h >> np.uint64(64 - SKETCH_LOG2)).astype(np.int64)]
        order = np.lexsort((h, rare))[: n - -(-num * n // den) + 1]
        return at, n, int(digest[0]), int(digest[1]), h[order].view(np.int64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _rows(schema, [one(*x) for x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)])

    return docs.mapInArrow(cut, "doc_id long, n long, d1 long, d2 long, prefix array<long>")


def _of(ids: DataFrame, name: str) -> DataFrame:
    return ids.select(F.xxhash64(F.col(name).cast("long")).alias("hash"))


def verified(pairs: DataFrame, docs: DataFrame, words: int, num: int, den: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose sets' Jaccard similarity is num/den or more; each pair's sets are compared once."""
    ids = scratch.hold(BitFilter(_of(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id")))
    schema = pa.schema([("id", pa.int64()), ("set", pa.binary())])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(ids.hit(batch.column(2).to_numpy().view(np.uint64))))
            yield _rows(schema, [(i, shingle_set(t, words).tobytes()) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                # Suffix filter: cut both sets at the same hashes; the parts' sizes alone may differ too much.
                apart = np.abs(np.diff(np.searchsorted(x, _CUTS), prepend=0, append=len(x)) - np.diff(np.searchsorted(y, _CUTS), prepend=0, append=len(y))).sum()
                if (num + den) * int(apart) > (den - num) * (len(x) + len(y)):
                    continue
                both = np.sort(np.concatenate((x, y)), kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                if den * common >= num * (len(x) + len(y) - common):
                    out.append(i)
            yield batch.select([0, 1]).take(pa.array(out, pa.int64()))

    found = docs.where("doc_id is not null").select("doc_id", "text", F.xxhash64("doc_id").alias("hash")).mapInArrow(sets, "id long, set binary")
    joined = pairs.join(found.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
    joined = joined.join(found.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
    return joined.select("a", "b", "set_a", "set_b").mapInArrow(compare, "a long, b long").distinct()


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(id, label): the smallest id each linked id reaches, saved under name. Rounds of least neighbour label and pointer jumping."""
    both = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    edges = scratch.save(links.select(F.explode(both).alias("e")).select("e.*").distinct(), f"{name}/edges")
    labels = edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("m")).select("id", F.least("id", "m").alias("label"))
    labels, at = scratch.save(labels, f"{name}/0"), 0
    while True:
        near = edges.join(labels, edges["v"] == labels["id"]).groupBy(F.col("u").alias("id")).agg(F.min("label").alias("m"))
        step = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("far"))
        step = step.join(jump, "label", "left").select("id", "old", F.least("label", F.coalesce("far", "label")).alias("label"))
        step = scratch.save(step, f"{name}/{at + 1}")
        changed = step.where("label <> old").limit(1).count()
        labels = step.select("id", "label")
        scratch.drop(f"{name}/{at}")
        at += 1
        if not changed:
            scratch.drop(f"{name}/edges")
            return labels


def _prepared(docs: DataFrame, words: int, num: int, den: int, doc_id: str, text: str, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """docs (doc_id, text); every row's set figures; and the prefix shingles that two classes or more hold, with their leaders."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts = scratch.hold(docs.sparkSession.sparkContext.broadcast(sketch(docs, words)))
    sets = scratch.save(prefixes(docs, counts, words, num, den), "prefixes")
    scratch.release()
    # Copies: equal sets. n and prefix are functions of the digest, so any row's will do. Different sets share at most
    # n of n + 1 shingles: where that is too little, as in the shortest texts, a set links with none but its copies.
    linkable = sets.where("n > 0 and doc_id is not null").where(F.lit(den) * F.col("n") >= F.lit(num) * (F.col("n") + 1))
    first = scratch.save(linkable.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "n", "prefix")).alias("x")).select("x.*"), "classes")
    sets = scratch.save(sets.drop("prefix"), "sets")
    scratch.drop("prefixes")
    shared = scratch.save(first.select(F.explode("prefix").alias("token")).groupBy("token").count().where("count > 1").select("token"), "shared")
    postings = scratch.save(_shared_postings(first, scratch.hold(BitFilter(shared))), "postings")
    scratch.release()
    scratch.drop("shared", "classes")
    # A shingle's leader: the class that has it earliest, so the one with the fewest rare shingles of its own.
    leaders = postings.groupBy("token").agg(F.count("*").alias("c"), F.min_by("rep", "at").alias("leader"), F.min("at").alias("leader_at")).where("c > 1").drop("c")
    # Written first: a join of two plain exchanges is one whose skewed partitions Spark can split.
    common = scratch.save(postings.join(scratch.save(leaders, "leaders"), "token"), "common")
    scratch.drop("postings", "leaders")
    return docs, sets, common


def _shared_postings(classes: DataFrame, shared: BitFilter) -> DataFrame:
    """(token, rep, at) of each class's prefix shingles that hit the filter; at orders by place in the prefix, then size."""
    schema = pa.schema([("token", pa.int64()), ("rep", pa.int64()), ("at", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, n, prefix = batch.columns
            size = prefix.value_lengths().to_numpy(zero_copy_only=False)
            token = prefix.flatten().to_numpy()
            pos = np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)
            kept = shared.hit(token.view(np.uint64))
            at = (pos << 31) + np.repeat(n.to_numpy(), size)
            columns = [token[kept], np.repeat(rep.to_numpy(), size)[kept], at[kept]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return classes.select("doc_id", "n", "prefix").mapInArrow(cut, "token long, rep long, at long")


def jaccard_links(docs: DataFrame, words: int = 5, num: int = 8, den: int = 10, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(pairs, members): every link between different texts once, as pairs (a, b) of class representatives, a < b; and
    (doc_id, n_shingles, rep) for every row of docs. Copies share a representative, the class's smallest id.

    All links are checked and returned, so groups of near copies give as many pairs as they have links; for groups
    alone jaccard_components() is cheaper. Texts without shingles have no link and, as rep, their own id.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    docs, sets, common = _prepared(docs, words, num, den, doc_id, text, scratch)
    pairs = _across(common, spark.createDataFrame([], "id long, label long"), spark.createDataFrame([], "a long, b long"), num, den, scratch)
    reps = sets.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("members")).where("members > 1")
    reps = reps.select("d1", "d2", "rep", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = sets.select("doc_id", "n", "d1", "d2", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    members = rows.join(reps, ["d1", "d2", "salt"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("rep", "doc_id").alias("rep"))
    return verified(pairs, docs, words, num, den, scratch), members


def jaccard_components(docs: DataFrame, words: int = 5, num: int = 8, den: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles (long), component_id (smallest id reachable by links, itself included).

    Texts link when their shingle sets' Jaccard similarity is num/den or more. Null, empty and wordless texts have no
    shingles and link with nothing. Ids name texts: a repeated row shares its id's component; a row with a null id
    takes its copies' component, or null. An empty table gives no rows.
    """
    return _components(docs, words, num, den, doc_id, text, Scratch(docs.sparkSession))


def _components(docs: DataFrame, words: int, num: int, den: int, doc_id: str, text: str, scratch: Scratch) -> DataFrame:
    docs, sets, common = _prepared(docs, words, num, den, doc_id, text, scratch)
    classes = sets.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("members")).where("members > 1")
    n, pos, n2, pos2 = (F.expr(x) for x in ("at % 2147483648L", "at div 2147483648L", "leader_at % 2147483648L", "leader_at div 2147483648L"))
    fits = _fits(n, pos, n2, pos2, num, den)
    star = common.where((F.col("rep") != F.col("leader")) & fits).groupBy("rep", "leader").agg(F.count("*").alias("c"))
    star = star.groupBy("rep").agg(F.max_by("leader", "c").alias("leader"))
    star = scratch.save(star.select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct(), "star")
    links = scratch.save(verified(star, docs, words, num, den, scratch), "links")
    scratch.release()
    labels = components(links, scratch, "stars")
    rest = _across(common, labels, star, num, den, scratch)
    scratch.drop("star")
    if rest.limit(1).count():
        more = scratch.save(verified(rest, docs, words, num, den, scratch), "more")
        scratch.release()
        labels = components(links.unionByName(more), scratch, "groups")
    scratch.drop("across", "links", "more")
    # Rows of one class may be a third of all: they are dealt out over salts, and only classes of copies carry those.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    copies = classes.join(labels, classes["rep"] == labels["id"], "left").select("d1", "d2", F.coalesce("label", "rep").alias("shared"), salts)
    out = sets.select("doc_id", "n", "d1", "d2", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    out = out.join(copies, ["d1", "d2", "salt"], "left").join(labels, F.col("doc_id") == labels["id"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("shared", "label", "doc_id").alias("component_id"))


def _fits(n: Column, pos: Column, n2: Column, pos2: Column, num: int, den: int) -> Column:
    """Length and positional filters for a common shingle at these places: may the rest still reach the overlap?"""
    length = (F.lit(den) * n >= F.lit(num) * n2) & (F.lit(den) * n2 >= F.lit(num) * n)
    # Different sets of one size agree in all but one at most.
    length &= (n != n2) | (F.lit(num + den) * (n - 1) >= F.lit(2 * num) * n)
    return length & (F.lit(num + den) * F.least(n - pos, n2 - pos2) >= F.lit(num) * (n + n2))


def _apart(num: int, den: int) -> int:
    """Different sets of one size under this cannot link: they agree in all but one at most."""
    return -(-(num + den) // (den - num))


def _size_class(n: Column, num: int, den: int) -> Column:
    """Small sizes are classes of their own; larger ones fall into steps of den/num, so that links reach one step at most.

    Steps are wider by a little than den/num, more than rounding takes from the logarithm.
    """
    step = F.floor(F.log(n.cast("double")) / float(np.log(den / num) * (1 + 1e-9)))
    return F.when(n < _apart(num, den), n).otherwise(F.lit(_apart(num, den)) + step).cast("long")


def _partner_sizes(n: Column, num: int, den: int) -> Column:
    """The size classes of the sets of n shingles or more that may link with a set of n."""
    sizes = F.sequence(n + 1, F.floor(F.lit(den) * n / F.lit(num)).cast("long"))
    small = F.array_distinct(F.transform(sizes, lambda m: _size_class(m, num, den)))
    own = _size_class(n, num, den)
    return F.when(n < _apart(num, den), small).otherwise(F.array(own, own + 1))


def _across(common: DataFrame, labels: DataFrame, seen: DataFrame, num: int, den: int, scratch: Scratch) -> DataFrame:
    """Candidate pairs (a, b) of classes in different components, past all filters and not checked yet; takes common's place."""
    named = common.select("token", "rep", "at").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    named = scratch.save(named.select("token", "rep", "at", F.coalesce("label", "rep").alias("label")), "named")
    scratch.drop("common")
    mixed = scratch.save(named.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("token"), "mixed")
    rows = named.join(mixed, "token").select("token", "rep", "label", F.expr("at % 2147483648L").alias("n"), F.expr("at div 2147483648L").alias("pos"))
    rows = scratch.save(rows.withColumn("size", _size_class(F.col("n"), num, den)), "rows")
    scratch.drop("named", "mixed")
    # The smaller set of a pair asks for the sizes that its partners may have, so that sets of sizes that cannot link
    # never meet, and neither do those whose common shingle comes too late for any partner.
    least = F.when(F.col("n") < _apart(num, den), F.col("n") + 1).otherwise(F.col("n"))
    asks = rows.where(F.lit(num + den) * (F.col("n") - F.col("pos")) >= F.lit(num) * (F.col("n") + least))
    asks = asks.withColumn("wants", F.explode(_partner_sizes(F.col("n"), num, den)))
    smallest = F.ceil(F.lit(num) * F.col("n") / F.lit(den))
    gives = rows.where(F.lit(num + den) * (F.col("n") - F.col("pos")) >= F.lit(num) * (F.col("n") + smallest))
    x, y = scratch.save(asks, "asks").alias("x"), scratch.save(gives, "gives").alias("y")
    scratch.drop("rows")
    near = _fits(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"), num, den)
    once = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.rep") < F.col("y.rep")))
    hits = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.wants") == F.col("y.size")) & once & (F.col("x.label") != F.col("y.label")) & near)
    pairs = hits.groupBy(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).agg(
        F.count("*").alias("c"), F.max("x.pos").alias("pa"), F.max("y.pos").alias("pb"), F.first("x.n").alias("na"), F.first("y.n").alias("nb")
    )
    # Suffix filter: past the last common prefix shingle at most the shorter rest can agree, before it only those counted.
    rest = F.col("c") + F.least(F.col("na") - F.col("pa") - 1, F.col("nb") - F.col("pb") - 1)
    pairs = pairs.where(F.lit(num + den) * rest >= F.lit(num) * (F.col("na") + F.col("nb")))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = scratch.save(pairs.join(seen, ["a", "b"], "left_anti"), "across")
    scratch.drop("asks", "gives")
    return pairs


def keep_representatives(docs: DataFrame, words: int = 5, num: int = 8, den: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the rows whose component has a smaller id; all columns and all other rows stay.

    Rows with a null id stay, and so do repeated rows of an id that stays: ids name texts. The ids to drop are set in a
    filter of bounded size; only rows that hit it are shuffled, to be checked against the exact ids.
    """
    scratch = Scratch(docs.sparkSession)
    found = _components(docs, words, num, den, doc_id, text, scratch)
    drop = scratch.save(found.where("component_id <> doc_id").select(F.col("doc_id").alias("id")).distinct(), "drop")
    scratch.drop("sets", "stars", "groups")
    at = F.col(f"`{doc_id}`").cast("long")
    names = [F.col(f"`{c}`") for c in docs.columns]
    maybe, key = unused(docs, "maybe"), unused(docs, "key")
    flagged = docs.select(*names, BitFilter(_of(drop, "id")).may_hold(F.when(at.isNotNull(), F.xxhash64(at))).alias(maybe), at.alias(key))
    sure = flagged.where(~F.col(maybe) | F.col(key).isNull())
    checked = flagged.where(F.col(maybe) & F.col(key).isNotNull())
    checked = checked.join(drop.withColumnRenamed("id", key), key, "left_anti")
    return sure.select(*names).unionByName(checked.select(*names))
