"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but these six ASCII white-space characters.
SPACE_CLASS = r"[\x20\x09-\x0D]+"


#: Rows, and bytes, of one Arrow batch: long texts keep a Python worker's memory bounded. The same for all operators,
#: as the session's settings are read when a plan runs, not when it is built.
BATCH_ROWS, BATCH_BYTES = 1000, 4_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, local sessions get one of their own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="weftline-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, and a lost executor re-reads instead of recomputing."""
    return Scratch(df.sparkSession).save(df)


class Scratch:
    """Tables in the shared folder, each deleted when its last reader has been written."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder, self.names = spark, f"{shared_dir(spark)}/weftline-{uuid.uuid4().hex}", 0
        self.held: list = []

    def save(self, df: DataFrame, name: str | None = None) -> DataFrame:
        """df written and read back; without a name it stays until the folder is cleared."""
        self.names += 1
        path = f"{self.folder}/{name or self.names}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def hold(self, shared):
        """A broadcast value that release() frees."""
        self.held.append(shared)
        return shared

    def release(self) -> None:
        """Frees what is held: call when all that reads it has been written."""
        for shared in self.held:
            shared.destroy()
        self.held = []

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches that Python workers get, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def unused(docs: DataFrame, name: str) -> str:
    """name, with underscores put in front until docs has no such column (column names ignore case)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def id_remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo modulus; null for a null id."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(col.cast("string").cast("binary")) % modulus


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


class BitFilter:
    """Bits at the top of 64-bit hashes: what does not hit them is none of the keys. Broadcast, of bounded size.

    It has `each` bits a key or more, as a power of two within `bounds`; beyond, it only lets more through. Tasks build
    it in segments; the driver gets each segment once, as bytes.
    """

    SEGMENT_LOG2 = 20

    def __init__(self, hashes: DataFrame, each: int = 8, bounds: tuple[int, int] = (20, 28)) -> None:
        """hashes: one column of longs; repeated and null ones do no harm."""
        spark = hashes.sparkSession
        column = F.col(f"`{hashes.columns[0]}`")
        self.log2 = log2 = min(bounds[1], max(bounds[0], (each * hashes.count()).bit_length()))
        inner, schema = self.SEGMENT_LOG2, pa.schema([("segment", pa.int32()), ("bits", pa.binary())])

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables: dict[int, np.ndarray] = {}
            for batch in batches:
                slots = batch.column(1).to_numpy()
                for segment in np.unique(slots >> inner).tolist():
                    table = tables.setdefault(segment, np.zeros(1 << inner, bool))
                    table[slots[slots >> inner == segment] & ((1 << inner) - 1)] = True
            yield pa.RecordBatch.from_arrays([pa.array(list(tables), pa.int32()), pa.array([np.packbits(t, bitorder="little").tobytes() for t in tables.values()], pa.binary())], schema=schema)

        slots = hashes.where(column.isNotNull()).select(self.slot(column).alias("slot"))
        slots = slots.select(F.shiftright("slot", inner).alias("segment"), "slot").repartition(min(partitions(spark), 1 << (log2 - inner)), "segment")
        table = np.zeros(1 << (log2 - 3), np.uint8)
        for r in slots.mapInArrow(build, "segment int, bits binary").toLocalIterator():
            table[r["segment"] << (inner - 3) : (r["segment"] + 1) << (inner - 3)] = np.frombuffer(r["bits"], np.uint8)
        self.shared = spark.sparkContext.broadcast(table)

    def slot(self, hashed: Column) -> Column:
        return F.shiftrightunsigned(hashed, 64 - self.log2)

    def hit(self, hashes: np.ndarray) -> np.ndarray:
        """For hashes as unsigned 64-bit numbers."""
        return self.hit_slots((hashes >> np.uint64(64 - self.log2)).astype(np.int64))

    def hit_slots(self, slots: np.ndarray) -> np.ndarray:
        return ((self.shared.value[slots >> 3] >> (slots & 7).astype(np.uint8)) & np.uint8(1)).astype(bool)

    def may_hold(self, hashed: Column) -> Column:
        """As a column; null hashes are held by none."""

        @F.pandas_udf("boolean")
        def maybe(slots: pd.Series) -> pd.Series:
            return pd.Series(self.hit_slots(slots.to_numpy(np.int64)))

        return F.coalesce(hashed.isNotNull() & maybe(self.slot(F.coalesce(hashed, F.lit(0)))), F.lit(False))

    def destroy(self) -> None:
        """After its last reader has been written: frees the memory of driver and executors."""
        self.shared.destroy()
