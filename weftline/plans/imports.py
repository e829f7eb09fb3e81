"""Importers and reconciliation. Captured documents are made of the driver tables, written as JSON or text and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators import reconcile
from weftline.operators.graphs import shared_folder
from weftline.plans.registry import Tables, query
from weftline.sources import importers, readers


def _sql_id(prefix: str, *parts: str) -> str:
    """The SQL of importers.stable_id()."""
    h = f"sha1(unhex('{importers.NAMESPACE.replace('-', '')}') || encode(concat_ws(chr(31), {', '.join(parts)})))"
    variant = f"substr('89ab', (strpos('0123456789abcdef', substr({h}, 17, 1)) - 1) % 4 + 1, 1)"
    return f"'{prefix}_' || substr({h}, 1, 12) || '5' || substr({h}, 14, 3) || {variant} || substr({h}, 18, 15)"


def _sql_source(platform: str, kind: str, native: str) -> str:
    return _sql_id("src", f"'{platform}'", f"'{kind}'", native)


def _json(t: Tables, rows: DataFrame, schema: str) -> DataFrame:
    path = f"{shared_folder(t.spark)}/captured-{uuid.uuid4().hex}"
    rows.write.json(path, compression="gzip")
    return readers.json_lines(t.spark, path, schema)


@query(
    "S3_combined_digest",
    """WITH f AS (SELECT 'region-' || n_regionkey || '.txt' AS name, string_agg(n_name || chr(10), '' ORDER BY n_nationkey) AS body FROM nation GROUP BY n_regionkey)
    SELECT CAST(count(*) AS BIGINT) AS files, sha256(string_agg(name || repeat(chr(0), 8) || chr(CAST(length(body) AS INT)) || body, '' ORDER BY name)) AS sha256 FROM f""",
)
def s3(t: Tables) -> DataFrame:
    """Files under 128 bytes, so that the SQL can write their lengths as one character."""
    path = f"{shared_folder(t.spark)}/captured-{uuid.uuid4().hex}"
    rows = t.nation.repartition("n_regionkey").sortWithinPartitions("n_regionkey", "n_nationkey")
    rows.select("n_regionkey", F.col("n_name").alias("value")).write.partitionBy("n_regionkey").option("lineSep", "\n").text(path)
    files = t.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path)
    name = F.concat(F.lit("region-"), F.regexp_extract("path", r"n_regionkey=(\d+)", 1), F.lit(".txt"))
    return importers.combined_digest(files.select(name.alias("name"), "content"))


# Orders are archive items, their lines files: of every four line numbers one is an original, two are derived from the
# first line's file, one is no media. Every tenth item has no title, every ninth no identifier but a numbered file.
_LINE_FILE = """strftime(l_shipdate, '%Y%m%d') || '-Part  ' || l_partkey || CASE WHEN l_linenumber % 2 = 0 THEN '-' || lpad(CAST(l_orderkey % 1000 AS VARCHAR), 11, 'v') ELSE '' END
    || CASE l_linenumber % 4 WHEN 0 THEN '.txt' WHEN 1 THEN '.mp4' ELSE '.ia.OGV' END"""
_FILES = f"""
    WITH l AS (SELECT *, {_LINE_FILE} AS name, 'item ' || l_orderkey AS item, l_orderkey % 9 = 0 AS bare FROM lineitem),
    f AS (SELECT DISTINCT CASE WHEN bare THEN CAST(l_orderkey AS VARCHAR) ELSE item END AS item, name, l_linenumber, l_quantity,
          strftime(l_shipdate, '%Y-%m-%d') AS day, l_partkey, l_orderkey FROM l),
    o AS (SELECT item, min(name) AS name FROM f WHERE l_linenumber = 1 GROUP BY 1),
    m AS (SELECT f.*, o.name AS original, 'Part ' || l_partkey AS title, CASE WHEN l_linenumber % 2 = 0 THEN 'youtube:video:' || lpad(CAST(l_orderkey % 1000 AS VARCHAR), 11, 'v')
          ELSE 'internet_archive:' || f.item || ':' || regexp_replace(f.name, '(\\.ia)?\\.[A-Za-z0-9]+$', '') END AS key
          FROM f LEFT JOIN o USING (item) WHERE l_linenumber % 4 <> 0)"""
_FILE_ID = _sql_source("internet_archive", "archive_media_file", "item || '/' || name")


def _archive(t: Tables) -> DataFrame:
    n, kind = F.col("l_linenumber"), F.col("l_linenumber") % 4
    suffix = F.when(n % 2 == 0, F.concat(F.lit("-"), F.lpad((F.col("l_orderkey") % 1000).cast("string"), 11, "v"))).otherwise("")
    ending = F.when(kind == 0, ".txt").when(kind == 1, ".mp4").otherwise(".ia.OGV")
    name = F.concat(F.date_format("l_shipdate", "yyyyMMdd"), F.lit("-Part  "), F.col("l_partkey").cast("string"), suffix, ending)
    f = t.lineitem.select("l_orderkey", n.alias("n"), name.alias("name"), F.when(kind == 1, "original").otherwise("derivative").alias("source"), F.col("l_quantity").cast("string").alias("size"))
    first = f.where("n = 1").groupBy("l_orderkey").agg(F.min("name").alias("original"))
    f = f.join(first, "l_orderkey", "left").withColumn("original", F.when(F.col("source") == "derivative", F.col("original")))
    items = f.groupBy("l_orderkey").agg(F.collect_list(F.struct("name", "source", "original", "size", F.col("size").alias("length"))).alias("files"))
    key = F.col("l_orderkey")
    identifier = F.when(key % 9 != 0, F.concat(F.lit("item "), key.cast("string")))
    title = F.when(key % 10 != 0, F.concat(F.lit("Title "), key.cast("string")))
    captured = _json(t, items.select(F.struct(identifier.alias("identifier"), title.alias("title")).alias("metadata"), "files", F.concat(F.lit("/in/archive-"), key.cast("string"), F.lit(".json")).alias("path")), importers.ARCHIVE + ", path string")
    return captured


@query(
    "S4_archive_files",
    f"""{_FILES} SELECT {_FILE_ID} AS source_id, item || '/' || name AS native_id, title, day AS date_label, {_sql_id('rec', 'key')} AS recording_id,
    CASE WHEN l_linenumber % 4 = 1 THEN 'archive_original_file' ELSE 'archive_derivative_file' END AS role, CAST(l_quantity AS BIGINT) AS bytes, CAST(l_quantity * 1000 AS BIGINT) AS duration_ms FROM m""",
)
def s4(t: Tables) -> DataFrame:
    return importers.archive_metadata(_archive(t))["files"].select("source_id", "native_id", "title", "date_label", "recording_id", "role", "bytes", "duration_ms")


@query(
    "S4_archive_derivatives",
    f"{_FILES} SELECT {_FILE_ID} AS from_id, 'derivative_of' AS kind, {_FILE_ID.replace('name', 'original')} AS to_id FROM m WHERE l_linenumber % 4 <> 1 AND original IS NOT NULL",
)
def s4_links(t: Tables) -> DataFrame:
    return importers.archive_metadata(_archive(t))["relations"]


def _legacy(t: Tables) -> DataFrame:
    """Customers as legacy entries: two of three mapped to the first file of an order, some of those to none that exists."""
    first = t.lineitem.where("l_linenumber = 1").select("l_orderkey", F.concat(F.date_format("l_shipdate", "yyyyMMdd"), F.lit("-Part  "), F.col("l_partkey").cast("string"), F.lit(".mp4")).alias("name"))
    c = t.customer.select("c_custkey", "c_name", ((F.col("c_custkey") * 7) % 300).alias("l_orderkey")).join(first, "l_orderkey", "left")
    key = F.col("l_orderkey")
    item = F.when(key % 9 != 0, F.concat(F.lit("item "), key.cast("string"))).otherwise(key.cast("string"))
    mapped = F.col("c_custkey") % 3 != 0
    video = F.struct(F.lit("archive_metadata_reconciliation").alias("url_basis"), F.when(mapped, item).alias("internet_archive_item"), F.when(mapped, F.coalesce("name", F.lit("gone.mp4"))).alias("internet_archive_filename"))
    return _json(t, c.select(F.col("c_name").alias("source_record_id"), F.struct(F.col("c_name").alias("title")).alias("transcript"), video.alias("video")), importers.LEGACY)


_LEGACY = f"""
    {_FILES}, first AS (SELECT l_orderkey, item, name FROM m WHERE l_linenumber = 1),
    c AS (SELECT c_name, c_custkey % 3 <> 0 AS mapped, item, name FROM customer LEFT JOIN first ON l_orderkey = (c_custkey * 7) % 300),
    r AS (SELECT {_sql_source('legacy_archive', 'legacy_catalog_entry', 'c_name')} AS from_id, {_FILE_ID} AS to_id FROM c WHERE mapped AND name IS NOT NULL)"""


@query(
    "S5_legacy_tasks",
    f"""{_LEGACY} SELECT {_sql_id('rtk', "'source_recovery'", _sql_source('legacy_archive', 'legacy_catalog_entry', 'c_name'))} AS task_id, 'source_recovery' AS kind, CAST(1 AS BIGINT) AS entries FROM c WHERE NOT mapped
    UNION ALL SELECT {_sql_id('rtk', "'shared_legacy_mapping'", 'to_id')}, 'shared_legacy_mapping', CAST(count(*) AS BIGINT) FROM r GROUP BY to_id HAVING count(*) > 1""",
)
def s5(t: Tables) -> DataFrame:
    return importers.legacy_manifest(_legacy(t), importers.archive_metadata(_archive(t))["files"])["tasks"].select("task_id", "kind", "entries")


@query("S5_legacy_mappings", f"{_LEGACY} SELECT from_id, 'mapped_to' AS kind, to_id, 'reconciled' AS basis FROM r")
def s5_mappings(t: Tables) -> DataFrame:
    return importers.legacy_manifest(_legacy(t), importers.archive_metadata(_archive(t))["files"])["relations"].drop("recording_id")


# Parts are videos of five channels; every seventh has no valid id, every fifth is listed twice.
_VIDEO = "lpad(CAST(p_partkey AS VARCHAR), CASE WHEN p_partkey % 7 = 0 THEN 10 ELSE 11 END, 'w')"


def _video_id() -> F.Column:
    key = F.col("p_partkey")
    return F.when(key % 7 == 0, F.lpad(key.cast("string"), 10, "w")).otherwise(F.lpad(key.cast("string"), 11, "w"))


def _channels(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    observed = F.when(key % 2 == 0, F.struct(F.concat(F.lit("Live stream "), "p_name").alias("title"), F.lit("public").alias("inferred_access"), F.lit("61.5").alias("duration_seconds")))
    item = F.struct(_video_id().alias("video_id"), F.col("p_name").alias("title_label"), F.lit("2020-02-03T04:05:06Z").alias("published_utc"), F.lit("59").alias("duration_seconds"), F.when(key % 3 == 0, "members_only").otherwise("odd").alias("access"), observed.alias("observed"))
    rows = t.part.withColumn("twice", F.explode(F.sequence(F.lit(0), F.when(key % 5 == 0, 1).otherwise(0))))
    rows = rows.groupBy((key % 5).alias("channel")).agg(F.collect_list(item).alias("items"))
    return _json(t, rows.select(F.struct(F.concat(F.lit("UC"), F.col("channel").cast("string")).alias("channel_id")).alias("expected_channel"), "items"), importers.CHANNEL)


_VIDEOS = f"""
    SELECT {_sql_source('youtube', 'youtube_video', _VIDEO)} AS source_id, {_sql_source('youtube', 'channel', "'UC' || p_partkey % 5")} AS parent_id,
    CASE WHEN p_partkey % 2 = 0 THEN 'Live stream ' || p_name ELSE p_name END AS title, '2020-02-03' AS date_label,
    CASE WHEN p_partkey % 2 = 0 THEN 'public' WHEN p_partkey % 3 = 0 THEN 'members_only' ELSE 'unknown' END AS access,
    CASE WHEN p_partkey % 2 = 0 THEN 'livestream' ELSE 'video' END AS recording_type, CAST(CASE WHEN p_partkey % 2 = 0 THEN 61500 ELSE 59000 END AS BIGINT) AS duration_ms
    FROM part WHERE p_partkey % 7 <> 0"""


@query("S6_channel_inventory", _VIDEOS)
def s6(t: Tables) -> DataFrame:
    return importers.channel_inventory(_channels(t))["videos"].select("source_id", "parent_id", "title", "date_label", "access", "recording_type", "duration_ms")


@query(
    "S7_search_candidates",
    f"""WITH c AS (SELECT l_orderkey * 8 + l_linenumber AS place, lpad(CAST(l_partkey AS VARCHAR), CASE WHEN l_partkey % 7 = 0 THEN 10 ELSE 11 END, 'w') AS id, l_partkey % 7 <> 0 AS valid FROM lineitem),
    f AS (SELECT id, min(place) AS first FROM c GROUP BY 1), k AS (SELECT {_VIDEO} AS id FROM part WHERE p_partkey % 2 = 0)
    SELECT place, id, CASE WHEN NOT valid THEN 'invalid' WHEN place > first THEN 'duplicate' WHEN id IN (FROM k) THEN 'existing' ELSE 'new' END AS state,
    CASE WHEN valid AND place = first THEN {_sql_id('rtk', "'youtube_discovery_candidate'", _sql_source('youtube', 'youtube_video', 'id'))} END AS task_id FROM c JOIN f USING (id)""",
)
def s7(t: Tables) -> DataFrame:
    part = F.col("l_partkey")
    rows = t.lineitem.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("place"), F.when(part % 7 == 0, F.lpad(part.cast("string"), 10, "w")).otherwise(F.lpad(part.cast("string"), 11, "w")).alias("id"))
    known = t.part.where("p_partkey % 2 = 0").select(importers.source_id("youtube", "youtube_video", _video_id()).alias("source_id"))
    return importers.search_candidates(_json(t, rows, importers.CANDIDATE + ", place long"), known, "search").select("place", "id", "state", "task_id")


_PUBLISHED = (
    "CASE WHEN c_custkey % 3 = 0 THEN strftime(to_timestamp(1500000000 + c_custkey * 1000) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') "
    "WHEN c_custkey % 3 = 1 THEN '2019-05-06T00:00:00Z' END"
)


@query(
    "S8_extractor_info",
    f"""SELECT {_sql_source('youtube', 'youtube_video', "lpad(CAST(c_custkey AS VARCHAR), 11, 'x')")} AS source_id, {_sql_source('youtube', 'channel', "c_mktsegment")} AS parent_id,
    {_PUBLISHED} AS published_at, substr({_PUBLISHED}, 1, 10) AS date_label, CASE WHEN c_custkey % 2 = 0 THEN 'public' ELSE 'unknown' END AS access,
    CASE WHEN c_custkey % 4 = 0 THEN 'livestream' ELSE 'video' END AS recording_type, CAST(CASE WHEN c_acctbal >= 0 THEN round_even(c_acctbal * 1000, 0) END AS BIGINT) AS duration_ms FROM customer WHERE c_custkey % 11 <> 0""",
)
def s8(t: Tables) -> DataFrame:
    """Every eleventh document comes twice, so neither of its captures is taken."""
    key = F.col("c_custkey")
    rows = t.customer.withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(key % 11 == 0, 1).otherwise(0))))
    info = rows.select(
        F.lpad(key.cast("string"), 11, "x").alias("id"),
        F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("channel_id"),
        F.when(key % 3 == 0, (F.lit(1_500_000_000) + key * 1000).cast("string")).alias("timestamp"),
        F.when(key % 3 == 1, "20190506").when(key % 3 == 2, "2019").alias("upload_date"),
        F.when(key % 2 == 0, "public").otherwise("needs_auth").alias("availability"),
        F.col("c_acctbal").cast("string").alias("duration"),
        (key % 4 == 0).alias("was_live"),
        F.concat(F.lit("/in/"), key.cast("string"), F.lit(".info.json")).alias("path"),
    )
    videos = importers.extractor_info(_json(t, info, importers.INFO + ", path string"))["videos"]
    return videos.select("source_id", "parent_id", "published_at", "date_label", "access", "recording_type", "duration_ms")


@query(
    "S9_url_hints",
    f"""{_FILES}, u AS (SELECT DISTINCT 'item ' || l_orderkey AS item, 'Part ' || l_partkey || '.mp4' AS name FROM lineitem WHERE l_linenumber <= 2
    UNION SELECT item, name FROM m WHERE l_linenumber = 1)
    SELECT item || '/' || name AS native_id, (item, name) IN (SELECT (item, name) FROM m) AS resolved,
    CASE WHEN (item, name) IN (SELECT (item, name) FROM m) THEN {_FILE_ID} ELSE {_sql_source('internet_archive', 'archive_url_discovery_hint', "item || '/' || name")} END AS source_id FROM u""",
)
def s9(t: Tables) -> DataFrame:
    """URLs of two lines of each order, of all its imported first files, and of pages that are no archive files."""
    files = importers.archive_metadata(_archive(t))["files"]
    url = F.concat(F.lit("https://archive.org/download/item%20"), F.col("l_orderkey").cast("string"), F.lit("/Part%20"), F.col("l_partkey").cast("string"), F.lit(".mp4"))
    lines = t.lineitem.where("l_linenumber <= 2").select(url.alias("value")).union(t.pages.select("url"))
    first = files.where(F.col("role") == "archive_original_file").where(~F.col("url").contains("-v")).select("url", "native_id")
    mine = t.lineitem.where("l_linenumber = 1").select(F.when(F.col("l_orderkey") % 9 != 0, F.concat(F.lit("item "), F.col("l_orderkey").cast("string"))).otherwise(F.col("l_orderkey").cast("string")).alias("item"), F.concat(F.date_format("l_shipdate", "yyyyMMdd"), F.lit("-Part  "), F.col("l_partkey").cast("string"), F.lit(".mp4")).alias("name"))
    first = first.join(mine.select(F.concat_ws("/", "item", "name").alias("native_id")).distinct(), "native_id", "left_semi")
    path = f"{shared_folder(t.spark)}/captured-{uuid.uuid4().hex}"
    lines.union(first.select("url")).write.text(path)
    return importers.url_hints(t.spark.read.text(path), files, "abc123")["hints"].select("native_id", "resolved", "source_id")


@query(
    "S12_snapshot_bundle",
    f"""{_LEGACY} SELECT 'internet_archive' AS importer, 'files' AS name, CAST(count(*) AS BIGINT) AS n FROM m
    UNION ALL SELECT 'internet_archive', 'sources', (SELECT count(DISTINCT l_orderkey) FROM lineitem)
    UNION ALL SELECT 'internet_archive', 'relations', (SELECT count(*) FROM m WHERE l_linenumber % 4 <> 1 AND original IS NOT NULL)
    UNION ALL SELECT 'internet_archive', 'rejects', 0
    UNION ALL SELECT 'legacy_manifest', 'sources', (SELECT count(*) FROM c WHERE NOT mapped OR name IS NOT NULL)
    UNION ALL SELECT 'legacy_manifest', 'relations', (SELECT count(*) FROM r)
    UNION ALL SELECT 'legacy_manifest', 'tasks', (SELECT count(*) FROM c WHERE NOT mapped) + (SELECT count(*) FROM (SELECT to_id FROM r GROUP BY 1 HAVING count(*) > 1))
    UNION ALL SELECT 'legacy_manifest', 'rejects', (SELECT count(*) FROM c WHERE mapped AND name IS NULL)
    UNION ALL SELECT 'current_channel', 'channels', (SELECT count(DISTINCT p_partkey % 5) FROM part)
    UNION ALL SELECT 'current_channel', x, (SELECT count(*) FROM part WHERE p_partkey % 7 <> 0) FROM (VALUES ('videos'), ('relations')) AS v(x)
    UNION ALL SELECT 'current_channel', 'rejects', (SELECT sum(CASE WHEN p_partkey % 5 = 0 THEN 2 ELSE 1 END) FROM part WHERE p_partkey % 7 = 0)""",
)
def s12(t: Tables) -> DataFrame:
    return importers.snapshot_bundle(_archive(t), _legacy(t), _channels(t))["statistics"]


def _discovery(t: Tables) -> DataFrame:
    """Nations as feeds, customers as their posts, listed twice where the number is even; every ninth has no valid id."""
    key = F.col("c_custkey")
    locator = F.struct(F.when(key % 4 == 0, "elsewhere").otherwise("youtube_video").alias("locator_kind"), F.lit("https://example.org").alias("canonical_url"), F.lpad((key % 50).cast("string"), 11, "y").alias("native_id"))
    post = F.struct(F.when(key % 9 == 0, "NO").otherwise(F.lpad(key.cast("string"), 7, "p")).alias("post_id"), F.col("c_name").alias("title"), F.concat(F.lit("https://www.reddit.com/comments/"), key.cast("string")).alias("permalink"), F.array(locator).alias("media_locators"))
    rows = t.customer.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(key % 2 == 0, 2).otherwise(1))))
    rows = rows.groupBy("c_nationkey", "copy").agg(F.collect_list(post).alias("posts"))
    snapshot = F.struct(F.concat_ws("-", "c_nationkey", "copy").alias("snapshot_id"), F.concat(F.lit("2024-01-0"), F.col("copy").cast("string"), F.lit("T00:00:00Z")).alias("observed_at"))
    return _json(t, rows.select(F.concat(F.lit("sub"), F.col("c_nationkey").cast("string")).alias("subreddit"), snapshot.alias("snapshot"), "posts"), importers.DISCOVERY)


_POST = _sql_source("reddit", "post", "lpad(CAST(c_custkey AS VARCHAR), 7, 'p')")


@query(
    "S13_discovery_posts",
    f"SELECT {_POST} AS source_id, {_sql_source('reddit', 'subreddit_atom_feed', "'sub' || c_nationkey || ':new'")} AS feed_id, c_name AS title, '2024-01-01T00:00:00Z' AS observed_at FROM customer WHERE c_custkey % 9 <> 0",
)
def s13_posts(t: Tables) -> DataFrame:
    return importers.discovery_manifest(_discovery(t))["posts"].select("source_id", "feed_id", "title", "observed_at")


@query(
    "S13_discovery_locators",
    f"SELECT {_sql_source('youtube', 'youtube_video', "lpad(CAST(c_custkey % 50 AS VARCHAR), 11, 'y')")} AS source_id, CAST(count(*) AS BIGINT) AS posts FROM customer WHERE c_custkey % 9 <> 0 AND c_custkey % 4 <> 0 GROUP BY c_custkey % 50",
)
def s13_locators(t: Tables) -> DataFrame:
    return importers.discovery_manifest(_discovery(t))["locators"].select("source_id", "posts")


# Orders are snapshots, their lines the items; some have another status, come before their start or differ from the payload.
_PROBLEM = """CASE WHEN l_partkey % 40 = 1 THEN 'request or status' WHEN l_partkey % 40 = 2 THEN 'out of time order' WHEN l_partkey % 40 = 3 THEN 'content type' WHEN l_partkey % 40 = 4 THEN 'payload differs' END"""


@query(
    "S14_archive_snapshots",
    f"""WITH p AS (SELECT CAST(l_orderkey AS VARCHAR) AS snapshot_id, 'it em ' || l_linenumber || '-' || l_partkey AS identifier, {_PROBLEM} AS problem FROM lineitem)
    SELECT 'problem' AS kind, snapshot_id, identifier, problem FROM p WHERE problem IS NOT NULL
    UNION ALL SELECT 'item', snapshot_id, identifier, NULL FROM p WHERE snapshot_id NOT IN (SELECT snapshot_id FROM p WHERE problem IS NOT NULL)""",
)
def s14(t: Tables) -> DataFrame:
    name_of = lambda x: F.concat(F.lit("it em "), x["l_linenumber"].cast("string"), F.lit("-"), x["l_partkey"].cast("string"))

    def item(x: Column) -> Column:
        part, name = x["l_partkey"] % 40, name_of(x)
        size = F.octet_length(name).cast("long")
        return F.struct(
            name.alias("identifier"),
            F.concat(F.lit("https://archive.org/metadata/"), F.replace(name, F.lit(" "), F.lit("%20"))).alias("request_url"),
            F.when(part == 1, 404).otherwise(200).alias("http_status"),
            F.when(part == 2, "2024-01-02T00:00:00Z").otherwise("2023-12-31T00:00:00Z").alias("started_at"),
            F.lit("2024-01-01T00:00:00Z").alias("observed_at"),
            F.when(part == 3, "text/html").otherwise("application/JSON; charset=utf-8").alias("content_type"),
            F.sha2(name.cast("binary"), 256).alias("payload_sha256"),
            F.when(part == 4, size + 1).otherwise(size).alias("byte_count"),
        )

    # Keys alone are sent; what an item says is made where its envelope is.
    lines = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_partkey")).alias("lines"))
    sealed = lines.select(F.col("l_orderkey").cast("string").alias("snapshot_id"), F.transform("lines", item).alias("items"))
    rows = t.lineitem.select("l_linenumber", "l_partkey").distinct()
    name = name_of({c: F.col(c) for c in rows.columns})
    rows = rows.select(name.alias("identifier"), F.sha2(name.cast("binary"), 256).alias("payload_sha256"), F.octet_length(name).cast("long").alias("bytes"))
    envelope = sealed.select("snapshot_id", F.lit(1).alias("schema_version"), F.lit("archive_org_item_metadata").alias("snapshot_kind"), F.lit("2024-01-01T00:00:00Z").alias("observed_at"), "items")
    out = importers.archive_snapshots(_json(t, envelope, importers.ENVELOPE), rows.select("identifier", F.col("payload_sha256").alias("sha256"), "bytes"))
    problems = out["problems"].select(F.lit("problem").alias("kind"), "snapshot_id", "identifier", "problem")
    return problems.unionByName(out["items"].select(F.lit("item").alias("kind"), "snapshot_id", "identifier", F.lit(None).cast("string").alias("problem")))


@query(
    "S17_job_results",
    """SELECT CAST(o_orderkey AS VARCHAR) AS job_id, CASE WHEN o_orderstatus = 'P' THEN 'not completed' WHEN o_orderkey % 10 = 3 THEN 'unknown input' WHEN o_orderkey % 10 = 4 THEN 'outputs' END AS reason,
    CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 10 NOT IN (3, 4) THEN CAST(o_orderkey % 1000 AS BIGINT) END AS seconds FROM orders""",
)
def s17(t: Tables) -> DataFrame:
    """Orders as jobs: jobs with their seconds, rejects with the reason."""
    key = F.col("o_orderkey")
    digest = lambda c: F.sha2(c.cast("string").cast("binary"), 256)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    output = F.struct(F.lit("audio").alias("role"), digest(F.col("o_custkey")).alias("sha256"), F.when(key % 10 == 4, 0).otherwise(7).cast("long").alias("byte_count"))
    rows = t.orders.select(
        key.cast("string").alias("job_id"),
        F.when(key % 2 == 0, "acquisition").otherwise("preprocess").alias("kind"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("completed").alias("state"),
        digest(key).alias("input_sha256"),
        stamp(start).alias("started_at"),
        stamp(F.timestamp_seconds(F.unix_timestamp(start) + key % 1000)).alias("completed_at"),
        F.array(output).alias("outputs"),
    )
    out = importers.job_results(_json(t, rows, importers.RESULT), t.orders.where(key % 10 != 3).select(digest(key).alias("sha256")))
    rejects = out["rejects"].select("job_id", "reason", F.lit(None).cast("long").alias("seconds"))
    return rejects.unionByName(out["jobs"].select("job_id", F.lit(None).cast("string").alias("reason"), "seconds"))


@query(
    "G24_reconciliation",
    f"""{_FILES}, w AS (SELECT DISTINCT 'other' AS item, name, CASE WHEN l_linenumber % 2 = 0 THEN lpad(CAST(l_orderkey % 1000 AS VARCHAR), 11, 'v') END AS vid FROM f WHERE l_linenumber = 2
    UNION SELECT item, name, NULL FROM m WHERE l_linenumber = 1 UNION SELECT 'other', 'lost-' || l_partkey || '.mp4', NULL FROM f WHERE l_linenumber = 3),
    v AS (SELECT lpad(CAST(l_orderkey % 1000 AS VARCHAR), 11, 'v') AS vid, count(DISTINCT (item, name)) AS n FROM m WHERE l_linenumber % 2 = 0 GROUP BY 1)
    SELECT w.item, w.name, CASE WHEN (w.item, w.name) IN (SELECT (item, name) FROM m) THEN 'exact' WHEN n = 1 THEN 'by_id' WHEN n > 1 THEN 'ambiguous' ELSE 'missing' END AS state FROM w LEFT JOIN v USING (vid)""",
)
def g24(t: Tables) -> DataFrame:
    """Names of another listing against the imported files."""
    files = importers.archive_metadata(_archive(t))["files"]
    line = lambda n: t.lineitem.where(F.col("l_linenumber") == n)
    day = F.date_format("l_shipdate", "yyyyMMdd")
    second = line(2).select(F.lit("other").alias("item"), F.concat(day, F.lit("-Part  "), F.col("l_partkey").cast("string"), F.lit("-"), F.lpad((F.col("l_orderkey") % 1000).cast("string"), 11, "v"), F.lit(".ia.OGV")).alias("name"))
    item = F.when(F.col("l_orderkey") % 9 != 0, F.concat(F.lit("item "), F.col("l_orderkey").cast("string"))).otherwise(F.col("l_orderkey").cast("string"))
    first = line(1).select(item.alias("item"), F.concat(day, F.lit("-Part  "), F.col("l_partkey").cast("string"), F.lit(".mp4")).alias("name"))
    lost = line(3).select(F.lit("other").alias("item"), F.concat(F.lit("lost-"), F.col("l_partkey").cast("string"), F.lit(".mp4")).alias("name"))
    return importers.reconciled(second.union(first).union(lost).distinct(), files).select("item", "name", "state")


# Lines are files: by line number their names end in an id, in one before .ia.OGV, in a format label or an audio suffix,
# have it in the middle or nowhere; titles carry it for some, another one for others. Four of five parts have a source
# of their own, most of these a recording; every seventh source is linked with a second one.
_NUMBERED = "lpad(CAST(l_partkey AS VARCHAR(20)), 11, 'v')"
_BRACKETED = f"""'Part ' || l_partkey || CASE l_linenumber WHEN 1 THEN ' [' || {_NUMBERED} || '].mp4' WHEN 2 THEN ' [' || {_NUMBERED} || '].ia.OGV' WHEN 3 THEN ' [' || {_NUMBERED} || '] 480p.mkv'
    WHEN 4 THEN ' [' || {_NUMBERED} || '].m4a' WHEN 5 THEN ' [' || {_NUMBERED} || '] two.mp4' WHEN 6 THEN ' [' || l_partkey || '].m4a' ELSE '.webm' END"""
_TITLED = f"""CASE WHEN l_suppkey % 4 = 0 THEN 'Part [' || {_NUMBERED} || ']' WHEN l_suppkey % 9 = 1 THEN 'Part [' || lpad(CAST(l_suppkey AS VARCHAR(20)), 11, 'w') || ']' ELSE 'Part' END"""
_KEY = "'f' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey"
_NATIVE = """nat AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 11, 'v') AS video_id, 'y' || p_partkey AS native_source_id, CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 7 <> 0 THEN 'r' || p_partkey END AS rec FROM part WHERE p_partkey % 5 <> 0)"""
_STATE = "CASE WHEN native_source_id IS NULL THEN 'missing_native_source' WHEN rec IS NULL THEN 'native_source_without_unique_recording' ELSE 'unique_native_recording' END"
# The terminal id, with a video suffix or none.
_TERMINAL = r"'\[([A-Za-z0-9_-]{11})\]((\.(?i:ia))?\.(?i:mp4|webm|ogv|mkv|mov|m4v))?$'"


def _bracketed(t: Tables) -> DataFrame:
    rows = t.lineitem
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.expr(_KEY).alias("source_id"), F.expr("'r' || l_suppkey").alias("recording_id"), F.expr(_BRACKETED).alias("name"), F.expr(_TITLED).alias("title"))


def _natives(t: Tables) -> tuple[DataFrame, DataFrame]:
    part = t.part.where("p_partkey % 5 <> 0").select("p_partkey", F.expr("'y' || p_partkey").alias("source_id"), F.expr("'r' || p_partkey").alias("recording_id"))
    natives = part.select(F.lpad(F.col("p_partkey").cast("string"), 11, "v").alias("video_id"), "source_id", F.when(F.col("p_partkey") % 3 != 0, F.col("recording_id")).alias("expected"))
    second = part.where("p_partkey % 7 = 0").select("source_id", F.lit("r0").alias("recording_id"))
    return natives, part.select("source_id", "recording_id").unionByName(second)


@query(
    "G24_bracket_plan",
    f"""WITH {_NATIVE}, f AS (SELECT DISTINCT {_KEY} AS source_id, 'r' || l_suppkey AS recording_id, {_BRACKETED} AS name, {_TITLED} AS title FROM lineitem),
    b AS (SELECT source_id, recording_id, nullif(regexp_extract(name, {_TERMINAL}, 1), '') AS by_name, nullif(regexp_extract(title, {_TERMINAL}, 1), '') AS by_title FROM f WHERE name NOT LIKE '%.m4a'),
    g AS (SELECT *, coalesce(by_name, by_title) AS video_id, CASE WHEN by_name = by_title THEN 'name_and_title' WHEN by_name IS NOT NULL THEN 'name' ELSE 'title' END AS basis FROM b
          WHERE coalesce(by_name, by_title) IS NOT NULL AND coalesce(by_name = by_title, true)),
    p AS (SELECT g.*, native_source_id, rec FROM g LEFT JOIN nat USING (video_id)),
    o AS (SELECT DISTINCT video_id, recording_id, rec FROM p), a AS (SELECT video_id, min(recording_id) AS anchor FROM o GROUP BY 1)
    SELECT 'source_to_locator' AS kind, video_id, source_id AS left_id, coalesce(native_source_id, video_id) AS right_id, basis, {_STATE} AS resolution_state FROM p
    UNION ALL SELECT 'recording_to_native', video_id, recording_id, rec, 'shared_id', 'unique_native_recording' FROM o WHERE rec <> recording_id
    UNION ALL SELECT 'repeat', video_id, anchor, recording_id, 'shared_id', 'repeat' FROM o JOIN a USING (video_id) WHERE recording_id > anchor
    UNION ALL SELECT 'issue', NULL, source_id, recording_id, by_name, by_title FROM b WHERE by_name <> by_title""",
)
def g24_brackets(t: Tables) -> DataFrame:
    """Candidates and issues of all lines as archive files."""
    plan = reconcile.bracket_plan(_bracketed(t), *_natives(t))
    issues = plan["issues"].select(F.lit("issue").alias("kind"), F.lit(None).cast("string").alias("video_id"), F.col("source_id").alias("left_id"), F.col("recording_id").alias("right_id"), F.col("by_name").alias("basis"), F.col("by_title").alias("resolution_state"))
    return plan["candidates"].unionByName(issues)


@query(
    "G24_suffix_plan",
    f"""WITH {_NATIVE}, f AS (SELECT l_returnflag AS directory, l_linenumber AS n, {_KEY} AS source_id, {_NUMBERED} AS video_id FROM lineitem WHERE l_returnflag IN ('A', 'R'))
    SELECT 'candidate' AS kind, source_id, CASE n WHEN 3 THEN 'format_label_video' WHEN 4 THEN 'audio_only' ELSE 'terminal' END AS detail, coalesce(native_source_id, video_id) AS right_id, {_STATE} AS state, CAST(1 AS BIGINT) AS n
    FROM f LEFT JOIN nat USING (video_id) WHERE n <= 4
    UNION ALL SELECT 'reject', directory, 'audio_only_invalid_id', NULL, NULL, CAST(count(*) AS BIGINT) FROM f WHERE n = 6 GROUP BY 2""",
)
def g24_suffixes(t: Tables) -> DataFrame:
    """Lines of two return flags as payload files, the flags as first directories."""
    files = t.lineitem.select(F.expr(_KEY).alias("source_id"), F.concat_ws("/", "l_returnflag", F.col("l_orderkey").cast("string"), F.expr(_BRACKETED)).alias("path"))
    plan = reconcile.suffix_plan(files, *_natives(t), ["A", "R"])
    good = plan["candidates"].select(F.lit("candidate").alias("kind"), "source_id", F.col("lane").alias("detail"), "right_id", F.col("resolution_state").alias("state"), F.lit(1).cast("long").alias("n"))
    text = F.lit(None).cast("string")
    return good.unionByName(plan["rejects"].select(F.lit("reject").alias("kind"), F.col("directory").alias("source_id"), F.col("reason").alias("detail"), text.alias("right_id"), text.alias("state"), "n"))


@query(
    "G24_hint_plan",
    """SELECT CAST(o_orderkey AS VARCHAR) AS native_id, CASE WHEN n = 0 THEN 'provider_missing' WHEN moved OR (hinted AND o_orderkey % 13 = 5) THEN 'url_differs' WHEN hinted THEN 'late_provider' ELSE 'already_provider' END AS class,
    CASE WHEN n > 0 AND NOT moved AND hinted AND o_orderkey % 13 <> 5 THEN 'h' || o_orderkey END AS left_id, CASE WHEN n > 0 AND NOT moved AND hinted AND o_orderkey % 13 <> 5 THEN 'p' || o_orderkey END AS right_id
    FROM (SELECT *, o_orderstatus = 'O' AS hinted, o_orderkey % 11 = 3 AS moved, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n FROM orders)""",
)
def g24_hints(t: Tables) -> DataFrame:
    """Orders as a captured list of addresses, their lines as the files a provider has, open ones hinted before."""
    key = F.col("o_orderkey")
    address = lambda c, other: F.concat(F.lit("https://archive.org/download/"), c.cast("string"), F.when(other, "/moved").otherwise(""))
    listed = t.orders.select(key.cast("string").alias("native_id"), address(key, F.lit(False)).alias("url"))
    line = F.col("l_orderkey")
    providers = t.lineitem.select(line.cast("string").alias("native_id"), F.concat(F.lit("p"), line.cast("string")).alias("source_id"), address(line, line % 11 == 3).alias("url"))
    hints = t.orders.where("o_orderstatus = 'O'").select(key.cast("string").alias("native_id"), F.concat(F.lit("h"), key.cast("string")).alias("source_id"), address(key, key % 13 == 5).alias("url"))
    return reconcile.hint_plan(listed, hints, providers).drop("url")


@query(
    "G24_assignment",
    f"""WITH f AS (SELECT DISTINCT {_KEY} AS id, l_orderkey % 3 = 0 AS wanted, CASE WHEN l_linenumber <= 5 THEN {_NUMBERED} END AS video, l_quantity AS size, {_BRACKETED} AS name FROM lineitem),
    l AS (SELECT * FROM f WHERE wanted), r AS (SELECT * FROM f WHERE NOT wanted),
    n0 AS (SELECT a.id, b.id AS other FROM (SELECT *, row_number() OVER (PARTITION BY video, size, name ORDER BY id) AS k FROM l WHERE video IS NOT NULL) a JOIN (SELECT *, row_number() OVER (PARTITION BY video, size, name ORDER BY id) AS k FROM r) b USING (video, size, name, k)),
    l1 AS (SELECT * FROM l WHERE id NOT IN (SELECT id FROM n0)), r1 AS (SELECT * FROM r WHERE id NOT IN (SELECT other FROM n0)),
    n1 AS (SELECT a.id, b.id AS other FROM (SELECT *, row_number() OVER (PARTITION BY video, size ORDER BY id) AS k FROM l1 WHERE video IS NOT NULL) a JOIN (SELECT *, row_number() OVER (PARTITION BY video, size ORDER BY id) AS k FROM r1) b USING (video, size, k)),
    l2 AS (SELECT * FROM l1 WHERE id NOT IN (SELECT id FROM n1)), r2 AS (SELECT * FROM r1 WHERE id NOT IN (SELECT other FROM n1)),
    n2 AS (SELECT a.id, b.id AS other FROM (SELECT *, row_number() OVER (PARTITION BY video ORDER BY id) AS k FROM l2 WHERE video IS NOT NULL) a JOIN (SELECT *, row_number() OVER (PARTITION BY video ORDER BY id) AS k FROM r2) b USING (video, k))
    SELECT id, other, 0 AS level, NULL AS reason FROM n0 UNION ALL SELECT id, other, 1, NULL FROM n1 UNION ALL SELECT id, other, 2, NULL FROM n2
    UNION ALL SELECT id, NULL, NULL, CASE WHEN video IS NULL THEN 'no_key' WHEN video IN (SELECT video FROM r WHERE video IS NOT NULL) THEN 'outnumbered' ELSE 'no_counterpart' END FROM l2 WHERE id NOT IN (SELECT id FROM n2)""",
)
def g24_assignment(t: Tables) -> DataFrame:
    """Files of every third order against all others: by id, size and name, then by id and size, then by id."""
    rows = _bracketed(t).select(F.col("source_id").alias("id"), (F.col("l_orderkey") % 3 == 0).alias("wanted"), F.when(F.col("l_linenumber") <= 5, F.lpad(F.col("l_partkey").cast("string"), 11, "v")).alias("video"), F.col("l_quantity").alias("size"), "name").distinct()
    return reconcile.assigned(rows.where("wanted"), rows.where("not wanted"), [["video", "size", "name"], ["video", "size"], ["video"]])
