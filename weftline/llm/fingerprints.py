"""Document fingerprints: Merkle trees over paragraphs and sections.

A text's lines, long ones divided after sentences, are its paragraphs; a section ends at a blank line or at a paragraph
whose own hash says so, hence an edit moves no later boundary. A leaf says whether its paragraph is a line's last, so
the leaves in order determine the text; each node is the hash of its children's. A fingerprint writes the tree out:
root/section=paragraph.paragraph;section=... Roots test equality, differing sections and then paragraphs locate an
edit, the share of equal paragraphs is the likeness. Roots are 128-bit hashes, the tree's other nodes are written with
64 bits.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import partitions, small_batches

#: Longer lines are divided after the first sentence end beyond SHORT characters, at LONG at the latest.
SHORT, LONG = 40, 240
_PARTS = re.compile(rf".{{{SHORT},{LONG}}}?[.!?](?=\s|$)|.{{1,{LONG}}}", re.S)
#: One paragraph in so many ends a section.
SECTION = 8
#: Hexadecimal digits that a fingerprint shows of each node below the root.
NODE = 16


def _hash(data: bytes) -> str:
    return hashlib.blake2b(data, digest_size=16).hexdigest()


def paragraphs(text: str) -> list[tuple[str, bool]]:
    """(paragraph, whether it is its line's last). Joined, with a line feed after each line but the text's last, they are the text."""
    out = []
    for line in text.split("\n"):
        parts = [line] if len(line) <= 2 * SHORT else _PARTS.findall(line)
        out += [(p, False) for p in parts[:-1]]
        out.append((parts[-1], True))
    return out


def fingerprint(text: str | None, memo: dict[tuple[str, bool], str] | None = None) -> str:
    """The tree as text; that of a null text is the empty text's. memo: paragraphs' hashes, shared between texts."""
    memo = {} if memo is None else memo
    sections, now = [], []
    for part in paragraphs(text or ""):
        if (leaf := memo.get(part)) is None:
            leaf = memo[part] = _hash((part[0] + ("\n" if part[1] else "")).encode("utf-8", "surrogatepass"))
        now.append(leaf)
        if not part[0] or int(leaf[-4:], 16) % SECTION == 0:
            sections.append(now)
            now = []
    if now:
        sections.append(now)
    nodes = [_hash("".join(s).encode()) for s in sections]
    root = _hash("".join(nodes).encode())
    return f"{root}/" + ";".join(f"{n[:NODE]}=" + ".".join(x[:NODE] for x in s) for n, s in zip(nodes, sections, strict=True))


def _sections(mark: str) -> list[tuple[str, list[str]]]:
    return [(s[:NODE], s[NODE + 1 :].split(".")) for s in mark.split("/", 1)[1].split(";")]


def likeness(one: str, other: str) -> float:
    """Equal paragraphs over the larger number of them; 1 for equal roots."""
    if one[:32] == other[:32]:
        return 1.0
    a, b = (Counter(x for _, s in _sections(m) for x in s) for m in (one, other))
    return sum((a & b).values()) / max(sum(a.values()), sum(b.values()))


def differing(one: str, other: str) -> tuple[range, range]:
    """The paragraphs of each text between the first and the last that differ; sections that agree are not entered."""
    if one[:32] == other[:32]:
        return range(0), range(0)
    a, b = _sections(one), _sections(other)
    ends = []
    for step in (1, -1):
        same = 0
        for (x, s), (y, _) in zip(a[::step], b[::step], strict=False):
            if x != y:
                break
            same += len(s)
        ends.append(same)
    flat = [[x for _, s in m for x in s] for m in (a, b)]
    least = min(map(len, flat))
    first = min(ends[0], least)
    while first < least and flat[0][first] == flat[1][first]:
        first += 1
    last = min(ends[1], least - first)
    while last < least - first and flat[0][-1 - last] == flat[1][-1 - last]:
        last += 1
    return range(first, len(flat[0]) - last), range(first, len(flat[1]) - last)


def with_next(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (bucket, peek, order, doc_id, text), sorted so that each row's next one by descending id follows it.

    Ids are cut into ranges by approximate quantiles. The last row of a range needs the first of the following range:
    that row is sent along as a peek row, so neighbours never meet in a global sort. Equal ids are ordered by text. Rows
    with a null id have no place in the order: they are dealt by their texts to buckets below 0.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = 4 * partitions(spark)
    apart = rows.where("doc_id is null").select((-1 - F.pmod(F.xxhash64("text"), F.lit(n))).cast("int").alias("bucket"), F.lit(False).alias("peek"), F.lit(0).cast("long").alias("order"), "doc_id", "text")
    rows = rows.where("doc_id is not null").withColumn("order", F.col("doc_id"))
    cuts = sorted({int(x) for x in rows.approxQuantile("order", [i / n for i in range(1, n)], 0.25 / n)})
    # bucket = how many cuts lie above the id: 0 holds the largest ids.
    bucket = F.lit(0)
    if cuts:
        bucket = F.lit(len(cuts)) - _rank(cuts)
    rows = rows.withColumn("bucket", bucket.cast("int"))
    firsts = rows.groupBy("bucket").agg(F.max("order").alias("order")).collect()
    found = sorted((r["bucket"], r["order"]) for r in firsts)
    if not found:
        return apart
    after = [(found[i - 1][0], found[i][1]) for i in range(len(found))]
    peeks = spark.createDataFrame(after, "bucket int, order long")
    heads = rows.select("order", "text").join(F.broadcast(peeks.select("order").distinct()), "order", "left_semi").groupBy("order").agg(F.min("text").alias("text"))
    peeks = heads.join(F.broadcast(peeks), "order").select("bucket", F.lit(True).alias("peek"), "order", F.lit(None).cast("long").alias("doc_id"), "text")
    both = rows.select("bucket", F.lit(False).alias("peek"), "order", "doc_id", "text").unionByName(peeks).unionByName(apart)
    return both.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket", "peek", F.desc("order"), "text")


def _rank(cuts: list[int]) -> Column:
    """Number of cuts at or below the id, as a binary decision tree of comparisons."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col("order") < F.lit(cuts[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(cuts))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars/3) code points replaced by as many of the next document's first (or all
    of them), in descending order of id, the first following the last. A null text is empty. A single row and a row with
    a null id are their own next; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def row(at: int | None, body: str, mark: str, memo: dict, following: str, its_mark: str) -> tuple:
        n = len(body)
        edited = body[: n - n // 3] + following[: n // 3]
        edited_mark = mark if edited == body else fingerprint(edited, memo)
        return at, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), mark, edited_mark, likeness(mark, edited_mark), likeness(mark, its_mark)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            out = []
            for bucket, peek, _, at, body in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                memo: dict[tuple[str, bool], str] = {}
                mark = fingerprint(body, memo)
                if bucket < 0:
                    out.append(row(at, body, mark, memo, body, mark))
                    continue
                if last and last[0] == bucket:
                    out.append(row(*last[1:], body, mark))
                last = None if peek else (bucket, at, body, mark, memo)
            columns = list(zip(*out, strict=True)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return with_next(docs, doc_id, text).mapInArrow(marked, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
