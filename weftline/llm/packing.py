"""Packing token sequences into windows by Karmarkar-Karp multiway differencing.

Each task encodes its own documents and packs them in groups of a bounded number of tokens, so nothing is shuffled
and no group grows with the corpus. Stretches as long as a window are windows by themselves; the rests are differenced:
the two partial partitions with the largest imbalances are merged, heavy windows onto light ones, until one is left.
Where a window then exceeds the capacity, the group is differenced anew into one window more.
"""

from __future__ import annotations

import heapq
import math
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import small_batches

#: Rests are cut to at most this share of a window, so that windows can be made nearly equal.
REST_SHARE = 4
#: Windows that the rests of one group fill.
GROUP_WINDOWS = 48
MEMO_CHUNKS = 300_000
#: A space that begins a word of the byte-level pattern: cutting there never divides one of its matches.
CUT = re.compile(r" (?=\S)")
SPECIAL = "<|endoftext|>"


def difference(sizes: list[int], windows: int) -> np.ndarray:
    """Window of each size under Karmarkar-Karp multiway differencing into so many windows."""
    nodes: list[tuple] = []
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[-1] = size
        nodes.append((sums, None, None, None))
        heap.append((-size, i))
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        sums = nodes[a][0] + nodes[b][0][::-1]
        order = sums.argsort(kind="stable")
        sums = sums[order]
        sums -= sums[0]
        nodes[a], nodes[b] = (None, *nodes[a][1:]), (None, *nodes[b][1:])
        nodes.append((sums, a, b, order))
        heapq.heappush(heap, (-int(sums[-1]), len(nodes) - 1))
    out = np.zeros(len(sizes), np.int64)
    stack = [(heap[0][1], np.arange(windows))] if heap else []
    while stack:
        at, names = stack.pop()
        _, a, b, order = nodes[at]
        if order is None:
            out[at] = names[-1]
            continue
        back = np.empty(windows, np.int64)
        back[order] = names
        stack += [(a, back), (b, back[::-1])]
    return out


def pack(sizes: list[int], capacity: int) -> np.ndarray:
    """Window of each size, no window over capacity: as few as the total needs, one more each time one is exceeded."""
    windows = max(1, math.ceil(sum(sizes) / capacity))
    while True:
        found = difference(sizes, windows)
        if not sizes or np.bincount(found, sizes, windows).max() <= capacity:
            return found
        windows += 1


class ByteEncoder:
    """Ids (little-endian unsigned 32 bit) of texts as a byte-level BPE tokenizers file gives them.

    Texts are cut where the file's word pattern always cuts (CUT); each chunk is encoded by the rank file of the same
    vocabulary once while it is remembered. Texts that hold the special token's string go to the file's own library.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.full = Tokenizer.from_file(json_path)
        encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

        class Memo(dict):
            def __missing__(self, chunk: str) -> bytes:
                if len(self) > MEMO_CHUNKS:
                    self.clear()
                self[chunk] = ids = np.array(encode(" " + chunk), "<u4").tobytes()
                return ids

        self.first, self.memo = encode, Memo()

    def ids(self, text: str) -> bytes:
        if SPECIAL in text:
            return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, *chunks = CUT.split(text)
        return np.array(self.first(first), "<u4").tobytes() + b"".join(map(self.memo.__getitem__, chunks))


_ENCODERS: dict[tuple, ByteEncoder] = {}


class _Packer:
    """Cuts documents into pieces and numbers windows from first on; rows leave as Arrow batches."""

    def __init__(self, capacity: int, first: int) -> None:
        self.capacity, self.window, self.done, self.rests, self.waiting = capacity, first, [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total = len(ids) // 4
        start = 0
        while total - start >= self.capacity:
            self.done.append((doc_id, start, self.capacity, ids[4 * start : 4 * (start + self.capacity)], total, self.window, 0))
            self.window += 1
            start += self.capacity
        step = max(1, self.capacity // REST_SHARE)
        while start < total:
            length = min(step, total - start)
            self.rests.append((doc_id, start, length, ids[4 * start : 4 * (start + length)], total))
            self.waiting += length
            start += length
        if self.waiting >= GROUP_WINDOWS * self.capacity:
            self.close()

    def close(self) -> None:
        found = pack([r[2] for r in self.rests], self.capacity)
        fill: dict[int, int] = {}
        for piece, window in zip(self.rests, found.tolist(), strict=True):
            at = fill.get(window, 0)
            self.done.append((*piece, window, at))
            fill[window] = at + piece[2]
        names = {w: self.window + i for i, w in enumerate(sorted(fill))}
        n = len(found)
        self.done[len(self.done) - n :] = [(*r[:5], names[r[5]], r[6]) for r in self.done[len(self.done) - n :]]
        self.window += len(names)
        self.rests, self.waiting = [], 0

    def rows(self, schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*self.done, strict=True)) or [[]] * len(schema)
        self.done = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str, pattern: str, capacity: int = 1024, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, little-endian unsigned 32 bit), doc_tokens, sequence_id, offset.

    A document's ids end with end_id; null and empty texts are that id alone. Pieces of a sequence lie without gaps
    from offset 0. sequence_id: the partition's number in the upper, the window's within it in the lower 32 bits.
    Documents are packed by row, so repeated ids and rows are packed as often as they come. No rows: no pieces.
    """
    small_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (json_path, ranks_path, pattern)
        if key not in _ENCODERS:
            _ENCODERS[key] = ByteEncoder(*key)
        encoder = _ENCODERS[key]
        packer = _Packer(capacity, TaskContext.get().partitionId() << 32)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                packer.add(at, encoder.ids(body or "") + end)
            yield packer.rows(schema)
        packer.close()
        yield packer.rows(schema)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(packed, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
