"""Readers with explicit schemas: JSON documents, JSON lines, OCR tables, bencode, verified shards, front matter, columns.

All go through Spark's readers, so any store Spark reads will do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_documents(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Whole-file JSON documents; a malformed one fails the read."""
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")


def json_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON objects, one a line; blank lines are skipped, anything else than an object fails the read."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def ocr_words(spark: SparkSession, path: str) -> DataFrame:
    """Word rows (level 5) of 12-column OCR tables, with line: what orders the rows of a file as they stand in it.

    line: file, place of the block that the task read, and a number that grows from row to row within it; so files may
    be split and read in any order.
    """
    names = "level page_num block_num par_num line_num word_num left top width height".split()
    schema = T.StructType([*[T.StructField(n, T.IntegerType()) for n in names], T.StructField("conf", T.DoubleType()), T.StructField("text", T.StringType())])
    rows = spark.read.schema(schema).csv(path, sep="\t", header=True, quote="", mode="FAILFAST")
    line = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return rows.select("*", line.alias("line")).where("level = 5")


def out_of_order(words: DataFrame) -> DataFrame:
    """OCR words that do not follow their page's reading order strictly. A page lies in one file."""
    from pyspark.sql import Window

    place = F.struct("block_num", "par_num", "line_num", "word_num")
    w = Window.partitionBy("line.file", "page_num").orderBy("line.block", "line.row")
    return words.withColumn("_before", F.lag(place).over(w)).where(F.col("_before") >= place).drop("_before")


def exploded_segments(transcripts: DataFrame, key: str, segments: str, words: str) -> DataFrame:
    """Transcripts with nested segments and words as rows (key, segment, segment fields, word, word fields)."""
    s = transcripts.select(key, F.posexplode(segments).alias("segment", "_s"))
    return s.select(key, "segment", "_s.*").select("*", F.posexplode_outer(words).alias("word", "_w")).select("*", "_w.*").drop("_w", words)


def bdecode(data: bytes) -> tuple[object, tuple[int, int] | None]:
    """Value of a bencoded byte string, and the span of the top dictionary's info value; ValueError where malformed."""
    span: list = [None]

    def value(i: int, depth: int) -> tuple[object, int]:
        c = data[i : i + 1]
        if c == b"i":
            end = data.index(b"e", i)
            return int(data[i + 1 : end]), end + 1
        if c in (b"l", b"d"):
            items, i = [], i + 1
            while data[i : i + 1] != b"e":
                start = i
                item, i = value(i, depth + 1)
                if c == b"d" and depth == 0 and len(items) % 2 and items[-1] == b"info":
                    span[0] = (start, i)
                items.append(item)
            return (items if c == b"l" else dict(zip(items[::2], items[1::2], strict=True))), i + 1
        if not c.isdigit():
            raise ValueError(f"no bencoded value at byte {i}")
        colon = data.index(b":", i)
        n = int(data[i:colon])
        if colon + 1 + n > len(data):
            raise ValueError("a string runs past the end")
        return data[colon + 1 : colon + 1 + n], colon + 1 + n

    found, end = value(0, 0)
    if end != len(data):
        raise ValueError("data after the value")
    return found, span[0]


def torrent_files(content: DataFrame, path: str = "path", body: str = "content") -> DataFrame:
    """Files of bencoded manifests: (path, place, name, length, first, last), offsets running through the payload."""

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for p, data in zip(batch["path"], batch["body"], strict=True):
                info = bdecode(bytes(data))[0][b"info"]
                files = info.get(b"files") or [{b"path": [info[b"name"]], b"length": info[b"length"]}]
                at = 0
                for i, f in enumerate(files):
                    rows.append((p, i, b"/".join(f[b"path"]).decode("utf-8", "replace"), f[b"length"], at, at + f[b"length"] - 1))
                    at += f[b"length"]
            yield pd.DataFrame(rows, columns=["path", "place", "name", "length", "first", "last"])

    return content.select(F.col(path).alias("path"), F.col(body).alias("body")).mapInPandas(listed, "path string, place long, name string, length long, first long, last long")


def file_digests(content: DataFrame) -> DataFrame:
    """(path, length, sha256) of whole files, digested where they are read: a manifest of any number of files."""
    return content.select("path", "length", F.sha2("content", 256).alias("sha256"))


def verified_shards(content: DataFrame, manifest: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the shards whose bytes match the manifest (name, bytes, sha256), and the names of those that do not."""
    shards = content.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length"), F.sha2("content", 256).alias("digest"), F.col("content").cast("string").alias("body"))
    joined = manifest.join(shards, "name", "left")
    good = (F.col("bytes") == F.col("length")) & (F.col("sha256") == F.col("digest"))
    rows = joined.where(good).select("name", F.explode(F.from_json("body", f"array<struct<{schema}>>", {"mode": "FAILFAST"})).alias("_r")).select("name", "_r.*")
    return rows, joined.where(~F.coalesce(good, F.lit(False))).select("name")


def front_matter(text: Column) -> tuple[Column, Column]:
    """(title, cited links) of a page with a front-matter block."""
    title = F.regexp_extract(text, r"(?s)\A---\n.*?^title:\s*[\"']?(.*?)[\"']?\s*$.*?^---", 1)
    title = F.regexp_extract(F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---", 1), r"(?m)^title:\s*[\"']?(.*?)[\"']?\s*$", 1)
    return F.nullif(title, F.lit("")), F.regexp_extract_all(text, F.lit(r"\]\((https?://[^)\s]+)\)"), F.lit(1))


def typed_column(encoded: Column, kind: str, missing: int | None = None) -> Column:
    """array<double> of a base64 column of little-endian numbers (numpy kind such as i1, u1, <u4); missing becomes null."""

    @F.pandas_udf("array<double>")
    def decoded(s: pd.Series) -> pd.Series:
        def one(body: bytes | None) -> list | None:
            return None if body is None else [None if x == missing else float(x) for x in np.frombuffer(body, kind).tolist()]

        return s.map(one)

    return decoded(F.unbase64(encoded))


def or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet table at path, or an empty one where there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
