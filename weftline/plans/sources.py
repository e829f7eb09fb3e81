"""S*: sources. Inputs are derived from the driver tables and written to the shared folder first, then read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.graphs import shared_folder
from weftline.plans.registry import Tables, query
from weftline.sources import codec, readers


def _path(t: Tables) -> str:
    return f"{shared_folder(t.spark)}/source-{uuid.uuid4().hex}"


@query("S2_json_lines", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def s2(t: Tables) -> DataFrame:
    path = _path(t)
    t.orders.select("o_orderkey", "o_custkey", "o_totalprice").write.json(path)
    return readers.json_lines(t.spark, path, "o_orderkey long, o_custkey long, o_totalprice double")


@query(
    "S15_ocr_words",
    """WITH w AS (SELECT o_orderkey // 500 AS page, o_orderkey AS k, CASE WHEN o_orderkey % 60 = 5 THEN o_orderkey - 60 ELSE o_orderkey END AS word FROM orders WHERE o_orderkey % 6 = 5),
    o AS (SELECT page, word <= lag(word) OVER (PARTITION BY page ORDER BY k) AS late FROM w)
    SELECT CAST(count(*) AS BIGINT) AS words, CAST(count(DISTINCT page) AS BIGINT) AS pages, CAST(count(*) FILTER (late) AS BIGINT) AS misplaced FROM o""",
)
def s15(t: Tables) -> DataFrame:
    """Orders as words, 500 keys a page, whole pages in each of several files; every tenth word has the number of an earlier one."""
    path = _path(t)
    k = F.col("o_orderkey")
    ones = [F.lit(1).alias(n) for n in "block_num par_num line_num".split()]
    word = F.when(k % 60 == 5, k - 60).otherwise(k).alias("word_num")
    box = [F.lit(1).alias(n) for n in "left top width height".split()]
    rows = t.orders.select((k % 6).alias("level"), F.expr("o_orderkey div 500").alias("page_num"), *ones, word, *box, F.lit(90.5).alias("conf"), F.col("o_orderstatus").alias("text"), k.alias("k"))
    rows.repartitionByRange("page_num").sortWithinPartitions("page_num", "k").drop("k").write.csv(path, sep="\t", header=True)
    words = readers.ocr_words(t.spark, path)
    misplaced = readers.out_of_order(words).count()
    return words.agg(F.count("*").alias("words"), F.countDistinct("page_num").alias("pages"), F.lit(misplaced).cast("long").alias("misplaced"))


@query("S16_transcripts", "SELECT conv_id, CAST(turn AS BIGINT) AS segment, CAST(len(string_split(text, ' ')) AS BIGINT) AS words FROM conversations")
def s16(t: Tables) -> DataFrame:
    segment = F.struct("turn", F.transform(F.split("text", " "), lambda w: F.struct(w.alias("w"))).alias("words"))
    nested = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(segment)).alias("segments"))
    rows = readers.exploded_segments(nested, "conv_id", "segments", "words")
    return rows.groupBy("conv_id", F.col("turn").alias("segment")).agg(F.count("*").alias("words"))


@query("S18_verified_shards", "SELECT o_orderkey // 5000 AS shard, CAST(count(*) AS BIGINT) AS n FROM orders WHERE o_orderkey // 5000 <> 1 GROUP BY 1")
def s18(t: Tables) -> DataFrame:
    """All orders in shards of 5000 keys, a file each; the digest of one of them is not the manifest's, so it is left out."""
    path = _path(t)
    body = t.orders.groupBy(F.expr("o_orderkey div 5000").alias("shard")).agg(F.to_json(F.collect_list(F.struct("o_orderkey"))).alias("value"))
    body.repartition("shard").write.partitionBy("shard").option("lineSep", "\n").text(path)
    files = t.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path)
    digest = F.when(F.col("path").contains("shard=1/"), "of other bytes").otherwise(F.sha2("content", 256))
    manifest = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), digest.alias("sha256"))
    rows, _ = readers.verified_shards(files, manifest, "o_orderkey: bigint")
    return rows.groupBy(F.expr("o_orderkey div 5000").alias("shard")).agg(F.count("*").alias("n"))


@query(
    "S19_page_titles",
    "SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title, CAST(len(regexp_extract_all(html, "
    "'href=\"([^\"]+)\"', 1)) AS INT) AS links FROM pages",
)
def s19(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.nullif(F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit("")).alias("title"), F.size(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))).alias("links"))


@query("S20_typed_columns", "SELECT c_custkey, CAST(c_custkey % 100 AS DOUBLE) AS first, CAST(1 AS INT) AS n FROM customer")
def s20(t: Tables) -> DataFrame:
    encoded = t.customer.select("c_custkey", F.base64(F.unhex(F.lpad(F.hex(F.col("c_custkey") % 100), 2, "0"))).alias("e"))
    return encoded.select("c_custkey", readers.typed_column(F.col("e"), "i1", -128).alias("v")).select("c_custkey", F.get("v", 0).alias("first"), F.size("v").alias("n"))


@query("S22_tables", "SELECT CAST(count(*) AS BIGINT) AS n FROM orders")
def s22(t: Tables) -> DataFrame:
    return t.orders.agg(F.count("*").alias("n"))


@query("S23_or_empty", "SELECT CAST(0 AS BIGINT) AS n")
def s23(t: Tables) -> DataFrame:
    return readers.or_empty(t.spark, f"{t.folder}/no_such_table.parquet", "id long").agg(F.count("*").alias("n"))


@query("S1_json_documents", "SELECT 'catalogue' AS name, CAST(count(*) AS BIGINT) AS items, CAST(sum(n_nationkey) AS BIGINT) AS total FROM nation")
def s1(t: Tables) -> DataFrame:
    """One document that holds a list, as the snapshot importers read it."""
    path = _path(t)
    body = t.nation.agg(F.collect_list(F.struct("n_nationkey", "n_name")).alias("items")).select(F.to_json(F.struct(F.lit("catalogue").alias("name"), "items")).alias("value"))
    body.coalesce(1).write.text(path)
    doc = readers.json_documents(t.spark, path, "name string, items array<struct<n_nationkey: int, n_name: string>>")
    return doc.select("name", F.explode("items").alias("i")).groupBy("name").agg(F.count("*").alias("items"), F.sum("i.n_nationkey").cast("long").alias("total"))


@query(
    "S10_S11_torrent_listing",
    "SELECT CAST(s_suppkey AS VARCHAR) || '.bin' AS path, CAST(place AS BIGINT) AS place, 100 + place AS length, CAST(CASE place WHEN "
    "0 THEN 0 WHEN 1 THEN 100 ELSE 201 END AS BIGINT) AS first FROM supplier, (SELECT unnest([0, 1, 2])::BIGINT AS place)",
)
def s10(t: Tables) -> DataFrame:
    """Bencoded manifests of three files each, listed with running offsets."""
    file = lambda i: f"d6:lengthi{100 + i}e4:pathl1:{i}ee"
    body = f"d4:infod5:filesl{file(0)}{file(1)}{file(2)}e4:name1:xee"
    content = t.supplier.select(F.concat(F.col("s_suppkey").cast("string"), F.lit(".bin")).alias("path"), F.encode(F.lit(body), "UTF-8").alias("content"))
    return readers.torrent_files(content).select("path", "place", "length", "first")


def _shards(t: Tables) -> DataFrame:
    """All customers as JSON rows, a hundred keys a shard."""
    row = F.struct("c_custkey", "c_mktsegment", "c_nationkey", F.lit("customer").alias("kind"))
    return t.customer.groupBy(F.expr("c_custkey div 100").alias("shard")).agg(F.to_json(F.array_sort(F.collect_list(row))).alias("rows"))


@query(
    "S21_compact_shards",
    "SELECT c_custkey // 100 AS shard, c_custkey, c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_nationkey, 'customer' AS kind "
    "FROM customer",
)
def s21(t: Tables) -> DataFrame:
    """Compact shards decoded to their rows."""
    read = _shards(t).select("shard", codec.decoded(codec.encoded(F.col("rows"))).alias("rows"))
    return read.select("shard", F.inline(F.from_json("rows", "array<struct<c_custkey: bigint, c_mktsegment: string, c_nationkey: bigint, kind: string>>", {"mode": "FAILFAST"})))


@query(
    "K7_compact_shards",
    "SELECT c_custkey // 100 AS shard, CAST(count(*) AS BIGINT) AS n, true AS same, true AS smaller FROM customer GROUP BY 1 "
    "HAVING count(*) > 20",
)
def k7(t: Tables) -> DataFrame:
    """Shards of more than twenty rows: encoded, the same when read back, and smaller."""
    s = _shards(t).withColumn("node", codec.encoded(F.col("rows")))
    s = s.select("shard", F.json_array_length("rows").cast("long").alias("n"), (codec.decoded(F.col("node")) == F.col("rows")).alias("same"), (F.char_length("node") < F.char_length("rows")).alias("smaller"))
    return s.where("n > 20")
