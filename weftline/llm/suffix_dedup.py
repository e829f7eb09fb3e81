"""Suffix-array dedup: bytes covered by a string of `width` bytes that also starts earlier, in any document.

Suffixes must meet those that share their first `width` bytes without a sort of all suffixes by their texts. Every
string of that width has an anchor: of the shorter strings in it (`anchor_size` bytes) the one with the least hash.
Equal strings have equal anchors, so shards are dealt by anchor:

1. Each text is cut into snippets: the stretches whose strings share one anchor. Anchors are counted first; a snippet
   whose anchor stands alone in all texts has no equal anywhere and goes no further (a bit filter drops nearly all).
2. Snippets that are equal as a whole collapse: all but the earliest are repeats.
3. What is left differs somewhere but has an anchor in common: the few snippets at the ends of copies and around
   edits. A shard of them gets a suffix array by sorted ranks and permuted common prefixes; where neighbours share
   `width` bytes or more, all but the earliest start of the run are repeats.
4. An anchor with more than HOT different snippets (a line that many texts have in different surroundings) is split:
   its strings meet by hash, one row each, and the earliest stays.

Repeats are spans of starts; a document's spans are merged over its bytes at the end. Documents are (id, text): rows
that repeat both are the same document. "Earlier" is by id (null first), then, among texts of one id, by digest, then
by start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import BitFilter, Scratch, partitions, small_batches
from weftline.llm.suffix_arrays import permuted_common_prefixes, suffix_array

WIDTH = 100
#: Different snippets of one anchor in one shard.
HOT = 4096
#: Bytes hashed at a time, and bytes of one shard's array.
PIECE, SHARD = 1 << 19, 1 << 20
#: Anchors in one task when they are counted.
COUNTED = 1 << 21
#: Stands after each snippet; no byte of a UTF-8 text.
_END = 0xFF
_SYMBOL = np.array([xxhash.xxh3_64_intdigest(bytes([b])) for b in range(256)], np.uint64)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PLACE_BITS = 22


def anchor_size(width: int) -> int:
    """The largest power of two within a third of the width."""
    return 1 << max(0, (width // 3).bit_length() - 1)


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """Least value of every window of span values."""
    done = 1
    while done < span:
        step = min(done, span - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def snippets(data: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor's hash, first start, number of starts) of the snippets of the strings in data that start at `starts`.

    starts: ascending places, each with width bytes after it; where they are not consecutive, snippets end.
    """
    size = anchor_size(width)
    if not len(starts):
        return np.empty(0, np.uint64), starts, starts
    h, done, factor = _SYMBOL[data], 1, int(_A)
    while done < size:
        h = h[:-done] * np.uint64(factor) + h[done:]
        factor = factor * factor % (1 << 64)
        done *= 2
    h = (h ^ (h >> np.uint64(29))) * _B
    h ^= h >> np.uint64(32)
    # Ordered by the hash's upper bits, then by place.
    keyed = (h >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(h), dtype=np.uint64)
    at = (_least(keyed, width - size + 1)[starts] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1))))
    # The least of many hashes have upper bits of zero: mixed once more (one to one), for lots and filters that go by them.
    least = h[at[new]] * _A
    return (least ^ (least >> np.uint64(32))) * _B, starts[new], np.diff(np.append(new, len(starts)))


def pieces(texts: list[bytes], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(data, starts, text's number, offset in the text) of about PIECE bytes each; long texts overlap by width - 1 bytes."""
    parts, number, offset, total = [], [], [], 0

    def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(p) for p in parts])
        begins = np.cumsum(sizes) - sizes
        counts = sizes - width + 1
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = np.repeat(begins, counts) + inner
        return np.frombuffer(b"".join(parts), np.uint8), starts, np.repeat(np.array(number), counts), inner + np.repeat(np.array(offset), counts)

    for i, text in enumerate(texts):
        for at in range(0, len(text) - width + 1, PIECE):
            part = text[at : at + PIECE + width - 1]
            parts.append(part)
            number.append(i)
            offset.append(at)
            total += len(part)
            if total >= PIECE:
                yield joined()
                parts, number, offset, total = [], [], [], 0
    if parts:
        yield joined()


def _utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def shared_anchors(rows: DataFrame, width: int) -> DataFrame:
    """(anchor): the hashes of anchors that stand at two places or more.

    Anchors are sent in columns, not in rows, dealt by their upper bits to tasks of about COUNTED each.
    """
    spark = rows.sparkSession
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A snippet has about half as many starts as places for its anchor.
    expected = 2 * total // (width - anchor_size(width) + 2)
    log2 = max(4, (expected // COUNTED).bit_length())

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            found = np.sort(np.concatenate(held))
            # Two of each say as much as many.
            found = found[np.concatenate(([True] * min(2, len(found)), found[2:] != found[:-2]))]
            cuts = np.searchsorted(found, np.arange(1, 1 << log2, dtype=np.uint64) << np.uint64(64 - log2))
            parts = [(i, p.tobytes()) for i, p in enumerate(np.split(found, cuts)) if len(p)]
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.binary())], ["lot", "anchors"])

        for batch in batches:
            for data, starts, _, _ in pieces([_utf8(t) for t in batch.column(0).to_pylist()], width):
                held.append(snippets(data, starts, width)[0])
                n += len(held[-1])
            if n > 1_000_000:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lots: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for lot, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                lots.setdefault(lot, []).append(np.frombuffer(body, np.uint64))
        for held in lots.values():
            found = np.sort(np.concatenate(held))
            same = found[1:] == found[:-1]
            again = found[1:][same & np.concatenate(([True], ~same[:-1]))]
            yield pa.RecordBatch.from_arrays([pa.array(again.view(np.int64))], ["anchor"])

    sent = rows.select("text").mapInArrow(send, "lot int, anchors binary")
    return sent.repartition(max(partitions(spark), 1 << log2), "lot").mapInArrow(repeated, "anchor long")


def kept_snippets(rows: DataFrame, shared: BitFilter, width: int) -> DataFrame:
    """(anchor, snippet, o, t, start, n) of the snippets whose anchors may be shared; snippet: a digest of its bytes."""
    schema = pa.schema([("anchor", pa.int64()), ("snippet", pa.int64()), ("o", pa.int64()), ("t", pa.int64()), ("start", pa.int64()), ("n", pa.int32())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            o, t = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for data, starts, number, offset in pieces([_utf8(x) for x in batch.column(2).to_pylist()], width):
                anchor, first, n = snippets(data, starts, width)
                some = shared.hit(anchor)
                anchor, first, n = anchor[some], first[some], n[some]
                body = memoryview(data)
                digests = np.fromiter((xxhash.xxh3_64_intdigest(body[a : a + m]) for a, m in zip(first.tolist(), (n + width - 1).tolist(), strict=True)), np.uint64, len(first))
                at = np.searchsorted(starts, first)
                columns = [anchor.view(np.int64), digests.view(np.int64), o[number[at]], t[number[at]], offset[at], n]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return rows.select("o", "t", "text").mapInArrow(cut, "anchor long, snippet long, o long, t long, start long, n int")


def later_starts(bodies: list[bytes], doc: np.ndarray, start: np.ndarray, width: int) -> list[list[tuple[int, int]]]:
    """For each snippet the spans (first, n) of its starts whose string of width bytes starts earlier in another one.

    doc, start: the snippets' documents, as numbers in their order, and places in them.
    """
    sizes = np.array([len(b) for b in bodies]) + 1
    t = np.frombuffer(bytes([_END]).join([*bodies, b""]), np.uint8)
    sa = suffix_array(t, 256)
    shared = permuted_common_prefixes(t, sa)[sa]
    begins = np.cumsum(sizes) - sizes
    out: list[list[tuple[int, int]]] = [[] for _ in bodies]
    # Slots of the array that share width symbols with a neighbour: few.
    meets = shared >= width
    slots = np.flatnonzero(meets | np.append(meets[1:], False))
    if not len(slots):
        return out
    at = sa[slots]
    of = np.searchsorted(begins, at, side="right") - 1
    inner = at - begins[of]
    place = (doc[of].astype(np.int64) << 40) | (start[of] + inner)
    runs = np.flatnonzero(~meets[slots])
    earliest = np.repeat(np.minimum.reduceat(place, runs), np.diff(np.append(runs, len(slots))))
    later = np.zeros(len(t), np.int8)
    later[at[(place != earliest) & (inner + width < sizes[of])]] = 1
    edges = np.flatnonzero(np.diff(later, prepend=0, append=0))
    of = np.searchsorted(begins, edges[::2], side="right") - 1
    # The end marks, never later themselves, part the snippets.
    for i, a, n in zip(of.tolist(), (edges[::2] - begins[of]).tolist(), (edges[1::2] - edges[::2]).tolist(), strict=True):
        out[i].append((a, n))
    return out


_SPANS = pa.schema([("o", pa.int64()), ("t", pa.int64()), ("start", pa.int64()), ("n", pa.int32())])
_SPAN_TYPES = "o long, t long, start long, n int"


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SPANS, strict=True)], schema=_SPANS)


def shard_spans(found: DataFrame, width: int) -> DataFrame:
    """Spans of later starts among snippets (anchor, o, t, start, body) of shared anchors, by suffix arrays of shards."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        held, total, last = [], 0, None
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if total >= SHARD and row[0] != last:
                    yield held
                    held, total = [], 0
                held.append(row)
                total += len(row[4])
                last = row[0]
        if held:
            yield held

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in shards(batches):
            number = {key: i for i, key in enumerate(sorted({(r[1], r[2]) for r in held}))}
            doc = np.array([number[r[1], r[2]] for r in held])
            spans = later_starts([r[4] for r in held], doc, np.array([r[3] for r in held]), width)
            yield _span_batch([(r[1], r[2], r[3] + first, n) for r, own in zip(held, spans, strict=True) for first, n in own])

    rows = found.select("anchor", "o", "t", "start", "body")
    return rows.repartition(partitions(found.sparkSession), "anchor").sortWithinPartitions("anchor").mapInArrow(sort, _SPAN_TYPES)


def with_bodies(found: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """found (anchor, o, t, start, n, kinds) with the snippets' bytes, body."""
    hits = BitFilter(found.select(F.xxhash64("o", "t")).distinct())
    wanted = found.groupBy("o", "t").agg(F.collect_list(F.struct("anchor", "start", "n", "kinds")).alias("snippets"))
    texts = rows.where(hits.may_hold(F.xxhash64("o", "t")))
    schema = pa.schema([("anchor", pa.int64()), ("o", pa.int64()), ("t", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("kinds", pa.int64()), ("body", pa.binary())])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for o, t, text, own in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                body = _utf8(text)
                out = [(s["anchor"], o, t, s["start"], s["n"], s["kinds"], body[s["start"] : s["start"] + s["n"] + width - 1]) for s in own]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    joined = texts.join(wanted, ["o", "t"]).select("o", "t", "text", "snippets")
    return joined.mapInArrow(take, "anchor long, o long, t long, start long, n int, kinds long, body binary")


def hot_spans(found: DataFrame, scratch: Scratch, width: int) -> DataFrame:
    """Spans of later starts among snippets of hot anchors: every string is a row of its own and meets its equals by hash."""
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("o", pa.int64()), ("t", pa.int64()), ("start", pa.int64())])

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for o, t, start, body in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                for i in range(len(body) - width + 1):
                    h = np.frombuffer(xxhash.xxh3_128_digest(body[i : i + width]), np.int64)
                    out.append((int(h[0]), int(h[1]), o, t, start + i))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    rows = found.select("o", "t", "start", "body").mapInArrow(strings, "h1 long, h2 long, o long, t long, start long")
    rows = scratch.save(rows.withColumn("n", F.lit(1)), "strings")
    return later_than_first(rows, scratch.save(earliest(rows, ["h1", "h2"]).where("copies > 1"), "first"), ["h1", "h2"])


def earliest(rows: DataFrame, key: list[str]) -> DataFrame:
    """One row per key: at (o, t, start, n; the earliest) and its copies."""
    return rows.groupBy(*key).agg(F.min(F.struct("o", "t", "start", "n")).alias("at"), F.count("*").alias("copies"))


def later_than_first(rows: DataFrame, first: DataFrame, key: list[str]) -> DataFrame:
    """Spans (o, t, start, n) of the rows that are not the earliest of their key.

    first: of earliest(), those with copies, saved: a join right behind the aggregation could not be split where a key has many rows.
    """
    first = first.select(*key, F.col("at").alias("first"))
    return rows.join(first, key).where(F.struct("o", "t", "start", "n") != F.col("first")).select("o", "t", "start", "n")


def repeated_bytes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, removed (start, end; byte spans, ascending, apart), kept (the other bytes).

    A byte is removed if a string of width bytes that covers it also starts earlier, overlaps included, judged on the
    texts as given. Null texts are empty; a null id comes before all others; rows equal in id and text are one document
    and get the same result; texts of one id are ordered by digest. Texts shorter than width stay whole. A long text is
    hashed in overlapping pieces. An empty table gives no rows.
    """
    if width < 2:
        raise ValueError("strings have two bytes at least")
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark)
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("o"), F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("t", F.xxhash64("text", F.col("doc_id").isNull()))
    shared = scratch.save(shared_anchors(rows, width), "shared")
    anchors = BitFilter(shared, 16)
    found = scratch.save(kept_snippets(rows, anchors, width), "snippets")
    anchors.destroy()
    scratch.drop("shared")
    distinct = scratch.save(earliest(found, ["anchor", "snippet"]), "distinct")
    spans = scratch.save(later_than_first(found, distinct.where("copies > 1"), ["anchor", "snippet"]), "copies")
    scratch.drop("snippets")
    kinds = scratch.save(distinct.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"), "kinds")
    differing = scratch.save(distinct.join(kinds, "anchor").select("anchor", "at.*", "kinds"), "differing")
    scratch.drop("distinct", "kinds")
    bodies = scratch.save(with_bodies(differing, rows, width), "bodies")
    scratch.drop("differing")
    spans = spans.unionByName(scratch.save(shard_spans(bodies.where(F.col("kinds") <= hot), width), "sorted"))
    spans = spans.unionByName(scratch.save(hot_spans(bodies.where(F.col("kinds") > hot), scratch, width), "hot"))
    scratch.drop("bodies", "strings", "first")
    return cut_out(rows, spans, width)


def cut_out(rows: DataFrame, spans: DataFrame, width: int) -> DataFrame:
    """The result from the spans of starts; only texts that may have some are shuffled to them and sent to Python."""
    hits = BitFilter(spans.select(F.xxhash64("o", "t")).distinct())
    span, spans_type = pa.struct([("start", pa.int64()), ("end", pa.int64())]), "array<struct<start: long, end: long>>"
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed", pa.list_(span)), ("kept", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, kept = [], [], []
            for text, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                body, out, left, at = _utf8(text), [], [], 0
                for start, end in sorted((s["start"], s["start"] + s["n"] + width - 1) for s in own or ()):
                    if out and start <= out[-1]["end"]:
                        out[-1]["end"] = max(end, out[-1]["end"])
                    else:
                        out.append({"start": start, "end": end})
                for s in out:
                    left.append(body[at : s["start"]])
                    at = s["end"]
                sizes.append(len(body))
                removed.append(out)
                kept.append(b"".join([*left, body[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, schema.field("removed").type), pa.array(kept, pa.binary())], schema=schema)

    own = spans.groupBy("o", "t").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    marked = rows.withColumn("some", hits.may_hold(F.xxhash64("o", "t")))
    with_spans = marked.where("some").join(own, ["o", "t"], "left").select("doc_id", "text", "spans")
    parted = with_spans.mapInArrow(cut, f"doc_id long, n_bytes long, removed {spans_type}, kept binary")
    whole = [F.octet_length("text").cast("long").alias("n_bytes"), F.array().cast(spans_type).alias("removed"), F.col("text").cast("binary").alias("kept")]
    return parted.unionByName(marked.where("not some").select("doc_id", *whole))
