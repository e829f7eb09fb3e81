"""Vector code compression: product codes by Elkan's form of Lloyd's rounds, in integers.

Vectors are cut into parts; each part has its own codebook of entries. A round assigns every part to its nearest entry
and moves each entry to the mean of its parts. Between rounds every part keeps an upper bound of the distance to its
own entry and one lower bound for each entry. When entries move, the bounds move with them; an entry is only looked at
where its lower bound and half its distance from the own entry do not strictly exceed the upper bound. What is looked at
gets its squared distance in integers, so results are those of the plain method, ties included.

The state of a round is one table in the shared folder: each task reads its own rows and writes the next state, the
previous one is deleted. Only sums by entry (entries x dimensions numbers) reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import Scratch, small_batches, unused

#: Integer components are under 2^LIMIT_LOG2 in size, so that squared distances fit 64 bits.
LIMIT_LOG2 = 26
#: Bounds are kept away from the true distance by this share, far more than rounding takes.
_SLACK = 1e-9
#: Lower bounds are stored in so many steps of the largest one, rounded down: a byte each.
_STEPS = 255


def usable(vector: str | Column) -> Column:
    """The vector is not null and holds neither nulls nor NaN or infinities."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def part_bounds(size: int, parts: int) -> list[int]:
    """Where the parts begin, and the end: consecutive, equal but for one component that the first ones may have more."""
    return [0, *np.cumsum([size // parts + (i < size % parts) for i in range(parts)]).tolist()]


def squared(x: np.ndarray, entries: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Squared distances of the pairs (row of x, entry), in integers."""
    diff = x[pairs[0]] - entries[pairs[1]]
    return np.einsum("ij,ij->i", diff, diff)


class State:
    """Of a batch's rows, for one part: the entry, an upper bound of its distance, a lower bound for each entry."""

    def __init__(self, own: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> None:
        self.own, self.upper, self.lower = own, upper, lower

    @classmethod
    def fresh(cls, n: int, k: int) -> State:
        """Before the first round: nothing is known, so nothing is pruned."""
        return cls(np.zeros(n, np.int64), np.full(n, np.inf), np.zeros((n, k)))

    def shift(self, moved: np.ndarray) -> None:
        """Entries moved by so much: every bound gives way by that."""
        self.upper = (self.upper + moved[self.own]) * (1 + _SLACK)
        self.lower = np.maximum(self.lower - moved * (1 + _SLACK), 0)

    def assign(self, x: np.ndarray, entries: np.ndarray, between: np.ndarray) -> np.ndarray:
        """Moves every row to its nearest entry, ties to the lower index. Returns the squared distances.

        between: half the distances of the entries from each other.
        """
        rows, halves = np.arange(len(x)), between * (1 - _SLACK)
        best = squared(x, entries, (rows, self.own))
        true = np.sqrt(best.astype(np.float64))
        self.upper = np.minimum(self.upper, true * (1 + _SLACK))
        self.lower[rows, self.own] = true * (1 - _SLACK)
        near = (self.lower <= self.upper[:, None]) & (halves[self.own] <= self.upper[:, None])
        near[rows, self.own] = False
        pairs = np.nonzero(near)
        if len(pairs[0]):
            found = squared(x, entries, pairs)
            self.lower[pairs] = np.sqrt(found.astype(np.float64)) * (1 - _SLACK)
            # Least (distance, index) of each row: the own entry joins the pairs.
            at, to = np.concatenate((rows, pairs[0])), np.concatenate((self.own, pairs[1]))
            of = np.concatenate((best, found))
            order = np.lexsort((to, of, at))
            first = order[np.searchsorted(at[order], rows)]
            self.own, best = to[first], of[first]
            self.upper = np.sqrt(best.astype(np.float64)) * (1 + _SLACK)
        return best

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        """Each row's largest lower bound, and its lower bounds in steps of that, rounded down."""
        scale = self.lower.max(axis=1, initial=0)
        steps = np.floor(self.lower * (_STEPS / np.where(scale > 0, scale, 1))[:, None]).astype(np.uint8)
        return scale, steps

    @staticmethod
    def unpacked(scale: np.ndarray, steps: np.ndarray) -> np.ndarray:
        return steps * (scale * ((1 - _SLACK) / _STEPS))[:, None]


def _binary(rows: np.ndarray) -> pa.Array:
    """A binary value for each row of a two-dimensional array."""
    width = rows.shape[1] * rows.itemsize
    offsets = pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _array(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


class Coder:
    """Codebooks of the parts and what the tasks do with them; small enough to travel with a task."""

    def __init__(self, books: list[np.ndarray], bounds: list[int]) -> None:
        self.books, self.bounds = books, bounds
        self.moved = [np.zeros(len(b)) for b in books]
        self.k = len(books[0])

    def halves(self) -> list[np.ndarray]:
        return [np.sqrt(np.maximum(((b[:, None, :] - b[None]) ** 2).sum(-1), 0)) / 2 for b in self.books]

    def assigned(self, vectors: DataFrame, first: bool, last: bool) -> DataFrame:
        """The next state, or, for the last, (row, codes, errors)."""
        bounds, parts, k, books, moved = self.bounds, len(self.books), self.k, self.books, self.moved
        row = vectors.schema["row"]

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            halves = self.halves()
            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                x = _array(batch.column("x"), np.int32, bounds[-1]).astype(np.int64)
                owns, uppers, scales, steps, errors = [], [], [], [], []
                if not first:
                    held = [_array(batch.column(c), t, w) for c, t, w in (("own", np.uint16, parts), ("upper", np.float64, parts), ("scale", np.float64, parts), ("lower", np.uint8, parts * k))]
                for p in range(parts):
                    if first:
                        state = State.fresh(n, k)
                    else:
                        state = State(held[0][:, p].astype(np.int64), held[1][:, p], State.unpacked(held[2][:, p], held[3][:, p * k : (p + 1) * k]))
                        state.shift(moved[p])
                    errors.append(state.assign(x[:, bounds[p] : bounds[p + 1]], books[p], halves[p]))
                    owns.append(state.own)
                    uppers.append(state.upper)
                    scale, rounded = state.packed()
                    scales.append(scale)
                    steps.append(rounded)
                own = np.stack(owns, 1)
                if last:
                    lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * parts, pa.int32()), pa.array(v.reshape(-1), t)) for v, t in ((own, pa.int32()), (np.stack(errors, 1), pa.int64()))]
                    yield pa.RecordBatch.from_arrays([batch.column("row"), *lists], ["row", "codes", "errors"])
                else:
                    new = [_binary(own.astype(np.uint16)), _binary(np.stack(uppers, 1)), _binary(np.stack(scales, 1)), _binary(np.concatenate(steps, 1))]
                    yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("x"), *new], ["row", "x", "own", "upper", "scale", "lower"])

        kind = f"row {row.dataType.simpleString()}, "
        return vectors.mapInArrow(step, kind + ("codes array<int>, errors array<long>" if last else "x binary, own binary, upper binary, scale binary, lower binary"))

    def moved_to_means(self, state: DataFrame) -> Coder:
        """Each entry at its parts' componentwise mean, rounded down; entries without parts stay."""
        bounds, parts, k = self.bounds, len(self.books), self.k
        width = max(b - a for a, b in zip(bounds, bounds[1:], strict=False))

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, counts = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
            for batch in batches:
                x, own = _array(batch.column("x"), np.int32, bounds[-1]).astype(np.int64), _array(batch.column("own"), np.uint16, parts)
                for p in range(parts):
                    np.add.at(sums[p, :, : bounds[p + 1] - bounds[p]], own[:, p], x[:, bounds[p] : bounds[p + 1]])
                    counts[p] += np.bincount(own[:, p], minlength=k)
            at = np.flatnonzero(counts.reshape(-1))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts.reshape(-1)[at], pa.int64()), _binary(sums.reshape(-1, width)[at])], ["slot", "n", "sums"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for slot, n, sums in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    total[slot] = total.get(slot, 0) + np.concatenate(([n], np.frombuffer(sums, np.int64)))
            out = [(s, int(v[0]), v[1:].tobytes()) for s, v in total.items()]
            columns = list(zip(*out, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())], ["slot", "n", "sums"])

        kind = "slot int, n long, sums binary"
        # Rows of one task's sums are few; they meet by slot, a task adding up some slots.
        found = state.select("x", "own").mapInArrow(partial, kind).repartition("slot").mapInArrow(add, kind).collect()
        books = [b.copy() for b in self.books]
        for r in found:
            p, j = divmod(r["slot"], k)
            books[p][j] = np.frombuffer(r["sums"], np.int64)[: bounds[p + 1] - bounds[p]] // r["n"]
        new = Coder(books, bounds)
        new.moved = [np.sqrt(((a - b) ** 2).sum(-1).astype(np.float64)) for a, b in zip(books, self.books, strict=True)]
        return new


def vector_codes(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> tuple[DataFrame, list[np.ndarray]]:
    """(rows, codebooks): columns of vectors but the vector itself, codes array<int>, errors array<long>.

    Vectors that are null or hold nulls, NaN or infinities are left out. Components become floor(scale * x). Codebooks
    start at the smallest ids (null ids last, equal ids by their vectors). All other rows are coded, but for vectors of
    another length than the smallest id's and those with a component of 2^LIMIT_LOG2 or more after scaling: they stay,
    with null codes and errors. Repeated rows each count. Fewer vectors than entries: as many entries. An empty table
    gives no rows and no codebooks. Columns named codes or errors are replaced.
    """
    if entries > 1 << 16:
        raise ValueError("entries are numbered with 16 bits")
    spark = vectors.sparkSession
    small_batches(spark)
    scratch = Scratch(spark)
    others = [F.col(f"`{c}`") for c in vectors.columns if c.lower() not in (vector.lower(), "codes", "errors")]
    kept = vectors.where(usable(vector)).select(F.struct(*others).alias("row"), F.col(f"`{vec_id}`").alias("at"), F.transform(F.col(f"`{vector}`").cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale)))).alias("v"), F.exists(F.col(f"`{vector}`"), lambda x: F.abs(x.cast("double")) * scale >= 2.0**LIMIT_LOG2).alias("far"))
    order = [F.asc_nulls_last("at"), F.asc("v")]
    head = kept.where(~F.col("far") & (F.size("v") >= parts)).orderBy(*order).select(F.size("v").alias("n")).first()
    if head is None:
        return kept.select("row.*", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("array<long>").alias("errors")), []
    fits = (F.size("v") == head["n"]) & ~F.col("far")
    smallest = np.array([r["v"] for r in kept.where(fits).orderBy(*order).select("v").limit(entries).collect()], np.int64)
    bounds = part_bounds(head["n"], parts)
    coder = Coder([smallest[:, a:b].copy() for a, b in zip(bounds, bounds[1:], strict=False)], bounds)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("v").flatten().to_numpy().reshape(-1, bounds[-1]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("row"), _binary(x)], ["row", "x"])

    state = kept.where(fits).select("row", "v").mapInArrow(whole, f"row {kept.schema['row'].dataType.simpleString()}, x binary")
    for i in range(rounds):
        state = scratch.save(coder.assigned(state, first=i == 0, last=False), f"state{i}")
        if i:
            scratch.drop(f"state{i - 1}")
        coder = coder.moved_to_means(state)
    coded = coder.assigned(state, first=rounds == 0, last=True)
    rest = kept.where(~fits).select("row", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("array<long>").alias("errors"))
    return coded.unionByName(rest).select("row.*", "codes", "errors"), coder.books
