"""A stored inverted index: segments of term-partitioned posting blocks, BM25 with skipped blocks, phrases, prefixes.

Folder layout:

* ``postings/segment=S/bucket=B``: a row is a block, the postings of one term in one cell of documents: their number,
  largest count and least length (from which a bound of the block's scores follows for any mean length), keys as
  offsets from the first, counts, lengths and positions. Files hold the terms of one bucket, sorted, so a search opens
  its terms' buckets only, and in them row groups and columns that it needs.
* ``docs/segment=S``: a document's key, cell, length and facets.
* ``current``: names and figures of the segments that count, swapped by one rename. A failed or doubled build leaves
  the old index as it was; segments are never changed, only added or merged into new ones.

Cells are dealt by a hash of the key, about CELL documents each, so a frequent term has many blocks of bounded size.
"""

from __future__ import annotations

import json
import math
import uuid
import zlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.text import tokens
from weftline.operators.fulltext import K1, B
from weftline.operators.graphs import written
from weftline.sources import publish

#: Documents of a cell; buckets of terms; cells of one bucket's file.
CELL, BUCKETS, FILE_CELLS = 512, 32, 4096
#: Least, usual and most records of a segment.
EVERY = (1_000, 25_000, 100_000)
_BLOCK = "term string, cell int, n int, most int, least int, first long, keys array<long>, tfs array<int>, lengths array<int>, positions array<array<int>>, segment string, bucket int"


@dataclass
class Segment:
    """Documents, their terms (repeated ones too) and cells."""

    name: str
    n: int
    terms: int
    cells: int


class TextIndex:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # -- segments

    def segments(self) -> list[Segment]:
        body = publish.read_text(self.spark, f"{self.path}/current")
        return [Segment(**s) for s in json.loads(body)["segments"]] if body else []

    def _swap(self, segments: list[Segment]) -> None:
        publish.swap_text(self.spark, f"{self.path}/current", json.dumps({"segments": [asdict(s) for s in segments]}))

    def add(self, docs: DataFrame, key: str, text: str, facets: Sequence[str] = (), every: int = EVERY[1]) -> list[Segment]:
        """Indexes docs in new segments of about `every` records each, dealt by key; older segments' files stay as they are.

        key: a whole number that names the document; the index trusts that it is new. Null texts have no terms.
        """
        if not EVERY[0] <= every <= EVERY[2]:
            raise ValueError(f"a segment has {EVERY[0]} to {EVERY[2]} records")
        total = docs.count()
        count = max(1, -(-total // every))
        cells = max(1, -(-total // (count * CELL)))
        prefix = "s" + uuid.uuid4().hex[:12]
        words = tokens(F.coalesce(F.col(text), F.lit("")))
        rows = docs.select(F.col(key).cast("long").alias("key"), words.alias("t"), *facets)
        rows = rows.withColumns({"segment": F.concat(F.lit(f"{prefix}-"), F.pmod(F.xxhash64("key"), F.lit(count)).cast("string")), "cell": _cell(cells), "length": F.size("t")})
        rows.select("key", "cell", "length", *facets, "segment").write.partitionBy("segment").mode("append").parquet(f"{self.path}/docs")
        occurrences = rows.select("segment", "cell", "key", "length", F.posexplode("t").alias("pos", "term"))
        dealt = _dealt(occurrences, cells)
        own = dealt.groupBy("segment", "bucket", "salt", "term", "cell", "key").agg(F.first("length").alias("length"), F.sort_array(F.collect_list("pos")).alias("positions"))
        self._write(own)
        return self._finished([f"{prefix}-{i}" for i in range(count)], cells, self.segments())

    def merge(self, names: Sequence[str] | None = None) -> Segment:
        """The named segments, or all, as one new one; the old ones' files go once nothing names them."""
        old = [s for s in self.segments() if names is None or s.name in names]
        kept = [s for s in self.segments() if s not in old]
        cells = max(1, -(-sum(s.n for s in old) // CELL))
        name = "s" + uuid.uuid4().hex[:12]
        docs = self.docs(old)
        docs.withColumn("cell", _cell(cells)).withColumn("segment", F.lit(name)).write.partitionBy("segment").mode("append").parquet(f"{self.path}/docs")
        rows = self._postings(self._blocks(old), positions=True).select(F.lit(name).alias("segment"), _cell(cells).alias("cell"), "key", "length", "term", "positions")
        self._write(_dealt(rows, cells))
        (new,) = self._finished([name], cells, kept)
        for s in old:
            publish.delete(self.spark, f"{self.path}/docs/segment={s.name}")
            publish.delete(self.spark, f"{self.path}/postings/segment={s.name}")
        return new

    def _write(self, rows: DataFrame) -> None:
        """rows (segment, bucket, salt, term, cell, key, length, positions), dealt by the first three: one shuffle in all."""
        posting = F.sort_array(F.collect_list(F.struct("key", "length", "positions")))
        blocks = rows.groupBy("segment", "bucket", "salt", "term", "cell").agg(posting.alias("p")).withColumn("first", F.col("p")[0]["key"])
        blocks = blocks.select(
            "term", "cell", F.size("p").alias("n"), F.array_max(F.transform("p", lambda p: F.size(p["positions"]))).alias("most"), F.array_min("p.length").alias("least"), "first",
            F.transform("p", lambda p: p["key"] - F.col("first")).alias("keys"), F.transform("p", lambda p: F.size(p["positions"])).alias("tfs"), F.col("p.length").alias("lengths"),
            F.col("p.positions").alias("positions"), "segment", "bucket",
        )
        blocks.sortWithinPartitions("segment", "bucket", "term", "cell").write.partitionBy("segment", "bucket").mode("append").parquet(f"{self.path}/postings")

    def _finished(self, names: list[str], cells: int, others: list[Segment]) -> list[Segment]:
        found = self.spark.read.parquet(f"{self.path}/docs").where(F.col("segment").isin(names))
        figures = found.groupBy("segment").agg(F.count("*").alias("n"), F.sum("length").alias("terms")).collect()
        new = [Segment(r["segment"], r["n"], r["terms"], cells) for r in sorted(figures)]
        self._swap(others + new)
        return new

    # -- what is stored

    def docs(self, segments: list[Segment] | None = None) -> DataFrame:
        """key, cell, length and facets of the documents."""
        names = [s.name for s in (self.segments() if segments is None else segments)]
        return self.spark.read.parquet(f"{self.path}/docs").where(F.col("segment").isin(names))

    def _blocks(self, segments: list[Segment], terms: Sequence[str] | None = None) -> DataFrame:
        stored = self.spark.read.schema(_BLOCK).parquet(f"{self.path}/postings").where(F.col("segment").isin([s.name for s in segments]))
        if terms is not None:
            buckets = sorted({zlib.crc32(t.encode()) % BUCKETS for t in terms})
            stored = stored.where(F.col("bucket").isin(buckets) & F.col("term").isin(list(terms)))
        return stored

    def stored(self) -> DataFrame:
        """All blocks of the segments that count."""
        return self._blocks(self.segments())

    def blocks(self, terms: Sequence[str]) -> DataFrame:
        """The blocks of the terms in all segments, in one scan of their buckets."""
        return self._blocks(self.segments(), terms)

    @staticmethod
    def _postings(blocks: DataFrame, positions: bool = False) -> DataFrame:
        """One row per posting: segment, cell, term, key, tf, length (, positions)."""
        columns = ["keys", "tfs", "lengths"] + ["positions"] * positions
        rows = blocks.select("segment", "cell", "term", "first", F.explode(F.arrays_zip(*columns)).alias("p"))
        more = [F.col("p.positions").alias("positions")] if positions else []
        return rows.select("segment", "cell", "term", (F.col("first") + F.col("p.keys")).alias("key"), F.col("p.tfs").alias("tf"), F.col("p.lengths").alias("length"), *more)

    def postings(self, terms: Sequence[str], positions: bool = False) -> DataFrame:
        return self._postings(self.blocks(terms), positions)

    # -- searches

    def search(self, terms: Sequence[str], limit: int, digits: int | None = None) -> DataFrame:
        """(key, score) of the `limit` best documents by BM25, exactly; ties by key. digits: scores are rounded first.

        The headers of the terms' blocks bound the scores of every cell. The most promising cells are scored first; the
        limit-th best score there is a threshold, and only cells whose bound reaches it are opened.
        """
        segments, weights = self.segments(), Counter(terms)
        blocks = self._blocks(segments, list(weights))
        df = {r["term"]: r["df"] for r in blocks.groupBy("term").agg(F.sum("n").alias("df")).collect()}
        if not df:
            return self.spark.createDataFrame([], "key long, score double")
        n, mean = sum(s.n for s in segments), _mean(segments)
        idf = F.create_map(*[x for t in df for x in (F.lit(t), F.lit(float(_idf(n, df[t]) * weights[t])))])
        bound = F.sum(idf[F.col("term")] * _share(F.col("most"), F.col("least"), mean)).alias("bound")
        cells = blocks.groupBy("segment", "cell").agg(bound, F.sum("n").alias("n"))

        def scored(of: DataFrame) -> DataFrame:
            rows = self._postings(blocks.join(of.select("segment", "cell"), ["segment", "cell"], "left_semi"))
            score = F.sum(idf[F.col("term")] * _share(F.col("tf"), F.col("length"), mean))
            return rows.groupBy("segment", "cell", "key").agg((score if digits is None else F.round(score, digits)).alias("score"))

        first = cells.orderBy(F.desc("bound"), "segment", "cell").limit(max(4, -(-2 * limit // CELL)))
        best = scored(first).select("score").orderBy(F.desc("score")).limit(limit).agg(F.min("score").alias("least"), F.count("*").alias("n")).first()
        # A bound is a sum in another order: it may fall short of a score by rounding, and of a rounded one by a step.
        least = best["least"] * (1 - 1e-9) - (10.0**-digits if digits is not None else 0) if best["n"] == limit else -1.0
        return scored(cells.where(F.col("bound") >= least)).select("key", "score").orderBy(F.desc("score"), "key").limit(limit)

    def opened(self, terms: Sequence[str], limit: int, least: float) -> DataFrame:
        """(segment, cell, bound) of the cells that a search with that threshold opens."""
        segments = self.segments()
        blocks = self._blocks(segments, list(terms))
        df = {r["term"]: r["df"] for r in blocks.groupBy("term").agg(F.sum("n").alias("df")).collect()}
        idf = F.create_map(*[x for t in df for x in (F.lit(t), F.lit(float(_idf(sum(s.n for s in segments), df[t]))))])
        bound = F.sum(idf[F.col("term")] * _share(F.col("most"), F.col("least"), _mean(segments))).alias("bound")
        return blocks.groupBy("segment", "cell").agg(bound).where(F.col("bound") >= least)

    def search_among(self, queries: Sequence[Sequence[str]], where: str, digits: int | None = None) -> DataFrame:
        """(query, key, score) of all documents with any term of a query, among those whose facets fulfil `where`.

        The corpus is the documents that do: their number, mean length and document frequencies count. All queries'
        terms are read in one scan; what matches is written once without texts.
        """
        allowed = self.docs().where(where)
        figures = allowed.agg(F.count("*").alias("n"), F.avg("length").alias("mean")).first()
        terms = sorted({t for q in queries for t in q})
        rows = written(self.postings(terms).join(allowed.select("segment", "cell", "key"), ["segment", "cell", "key"]))
        df = {r["term"]: r["df"] for r in rows.groupBy("term").agg(F.count("*").alias("df")).collect()}
        pairs = [(i, t, float(c * _idf(figures["n"], df[t]))) for i, q in enumerate(queries) for t, c in Counter(q).items() if t in df]
        if not pairs:
            return self.spark.createDataFrame([], "query int, key long, score double")
        asked = F.array(*[F.struct(F.lit(i).alias("query"), F.lit(t).alias("term"), F.lit(w).alias("idf")) for i, t, w in pairs])
        rows = rows.select("key", "tf", "length", F.explode(F.filter(asked, lambda a: a["term"] == F.col("term"))).alias("a"))
        scores = rows.groupBy(F.col("a.query").alias("query"), "key").agg(F.sum(F.col("a.idf") * _share(F.col("tf"), F.col("length"), figures["mean"] or 1.0)).alias("score"))
        return scores.withColumn("score", F.round("score", digits)) if digits is not None else scores

    def phrase(self, words: Sequence[str]) -> DataFrame:
        """(key, n): documents in which the words stand one after the other, and how often; places that overlap all count."""
        offsets: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            offsets.setdefault(w, []).append(i)
        shifts = F.create_map(*[x for w, o in offsets.items() for x in (F.lit(w), F.array(*map(F.lit, o)))])
        rows = self.postings(list(offsets), positions=True).select("segment", "cell", "key", F.explode("positions").alias("pos"), shifts[F.col("term")].alias("shifts"))
        starts = rows.select("segment", "cell", "key", F.explode(F.transform("shifts", lambda i: F.col("pos") - i)).alias("start"))
        whole = starts.groupBy("segment", "cell", "key", "start").agg(F.count("*").alias("hits")).where(F.col("hits") == len(words))
        return whole.groupBy("segment", "cell", "key").agg(F.count("*").alias("n")).select("key", "n")

    def prefix(self, start: str) -> DataFrame:
        """(key, terms, n): documents with terms that begin so, how many different ones and how many in all."""
        blocks = self._blocks(self.segments()).where(F.col("term").startswith(start))
        return self._postings(blocks).groupBy("segment", "cell", "key").agg(F.count("*").alias("terms"), F.sum("tf").alias("n")).select("key", "terms", "n")


def _cell(cells: int) -> Column:
    return F.pmod(F.shiftright(F.xxhash64("key"), 20), F.lit(cells)).cast("int")


def _bucket(term: Column) -> Column:
    return (F.crc32(term.cast("binary")) % BUCKETS).cast("int")


def _dealt(rows: DataFrame, cells: int) -> DataFrame:
    """Rows with their bucket, dealt so that a bucket's cells of one file meet; a frequent term is dealt over many files."""
    rows = rows.withColumns({"bucket": _bucket(F.col("term")), "salt": F.pmod(F.col("cell"), F.lit(-(-cells // FILE_CELLS)))})
    return rows.repartition("segment", "bucket", "salt")


def _mean(segments: list[Segment]) -> float:
    return sum(s.terms for s in segments) / max(1, sum(s.n for s in segments)) or 1.0


def _idf(n: int, df: int) -> float:
    return math.log(1.0 + (n - df + 0.5) / (df + 0.5))


def _share(tf: Column, length: Column, mean: float) -> Column:
    """The part of a term's score that depends on the document; grows with tf, falls with length."""
    return tf * (K1 + 1) / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * length / F.lit(float(mean))))
