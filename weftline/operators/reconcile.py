"""Plans that reconcile listings of files with a catalogue: every row is a candidate or an issue for review, none a decision.

A file is met by its keys alone (ids in its name, native ids, digests of what it says); pairs within a key are never
enumerated: groups get an anchor, and one-to-one assignments meet by number within the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators import ranks
from weftline.operators.graphs import written

# The grammar of ids and suffixes.
VIDEO_SUFFIXES = "mp4|webm|ogv|mkv|mov|m4v"
BRACKET = r"\[([A-Za-z0-9_-]{11})\]"
TERMINAL = rf"{BRACKET}(?:(?:\.(?i:ia))?\.(?i:{VIDEO_SUFFIXES}))?\z"
FORMAT_LABEL = rf"{BRACKET} 480p\.(?i:{VIDEO_SUFFIXES})\z"
AUDIO_ONLY = rf"{BRACKET}\.(?i:m4a)\z"
LONGEST_NAME = 4096


def _id(name: Column, pattern: str) -> Column:
    fit = (F.char_length(name) <= LONGEST_NAME) & ~F.contains(name, F.lit("\0"))
    return F.when(fit, F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")))


def bracket_id(name: Column) -> Column:
    """The id in brackets that ends a name, but for a video suffix; null for any other name. Ids elsewhere do not count."""
    return _id(name, TERMINAL)


def lane(name: Column) -> Column:
    """format_label_video, audio_only or terminal by the suffix that follows the id; null without an id so placed."""
    return (
        F.when(_id(name, FORMAT_LABEL).isNotNull(), "format_label_video")
        .when(_id(name, AUDIO_ONLY).isNotNull(), "audio_only")
        .when(bracket_id(name).isNotNull(), "terminal")
    )


def rejection(name: Column) -> Column:
    """Why a name with something in brackets is in no lane; null for names in a lane and names without such a hint."""
    token = r"\[[^\[\]\r\n]{1,64}\]"
    hint = F.contains(F.lower(name), F.lit("480p")) | F.contains(F.lower(name), F.lit(".m4a")) | name.rlike(rf"{token}[ \t]+[0-9]{{3,4}}[pP]")
    return F.when(
        lane(name).isNull(),
        F.when(name.rlike(rf"{token} 480p\.(?i:{VIDEO_SUFFIXES})\z"), "format_label_invalid_id")
        .when(name.rlike(rf"{token}\.(?i:m4a)\z"), "audio_only_invalid_id")
        .when(name.rlike(token) & hint, "ambiguous_suffix"),
    )


def resolved(ids: DataFrame, natives: DataFrame, links: DataFrame) -> DataFrame:
    """One row per distinct video_id of ids: native_source_id, native_recording_id, resolution_state.

    natives: (video_id, source_id, expected), expected being the recording that the id itself names, null where the
    catalogue has none; links: (source_id, recording_id). An id is resolved only if its source is linked with that
    recording and no other. Of several natives of one id the least source counts; null ids are left out.
    """
    mapped = links.groupBy("source_id").agg(F.min("recording_id").alias("low"), F.max("recording_id").alias("high"))
    one = natives.groupBy("video_id").agg(F.min(F.struct("source_id", "expected")).alias("n")).select("video_id", "n.*")
    sole = (F.col("low") == F.col("high")) & (F.col("low") == F.col("expected"))
    own = one.join(mapped, "source_id", "left").select("video_id", F.col("source_id").alias("native_source_id"), F.when(sole, F.col("expected")).alias("native_recording_id"))
    state = (
        F.when(F.col("native_source_id").isNull(), "missing_native_source")
        .when(F.col("native_recording_id").isNull(), "native_source_without_unique_recording")
        .otherwise("unique_native_recording")
    )
    return ids.where("video_id is not null").select("video_id").distinct().join(own, "video_id", "left").withColumn("resolution_state", state)


def bracket_plan(files: DataFrame, natives: DataFrame, links: DataFrame) -> dict[str, DataFrame]:
    """Candidates and issues of files (source_id, recording_id, name, title) whose name or title ends in a bracketed id.

    issues: files whose name and title end in different ids, which take no further part. candidates (kind, video_id,
    left_id, right_id, basis, resolution_state): source_to_locator, each file with its id's native source, or the id
    itself; recording_to_native, each recording of an id with the resolved one where they differ; repeat, each further
    recording of an id with the least one. Files that are no video are not read; repeated rows count once.
    """
    video = F.col("name").rlike(rf"\.(?i:{VIDEO_SUFFIXES})\z")
    hint = F.contains("name", F.lit("[")) | F.contains("title", F.lit("["))
    # Written before anything is asked of the ids: filters on them would be pushed down and match the patterns again, in every branch.
    rows = written(files.where(F.coalesce(hint, F.lit(True)) & video).select("source_id", "recording_id", bracket_id(F.col("name")).alias("by_name"), bracket_id(F.col("title")).alias("by_title")).distinct())
    rows = rows.where("by_name is not null or by_title is not null")
    both = F.col("by_name").isNotNull() & F.col("by_title").isNotNull()
    conflict = both & (F.col("by_name") != F.col("by_title"))
    basis = F.when(both, "name_and_title").when(F.col("by_name").isNotNull(), "name").otherwise("title")
    good = rows.where(~conflict).select("source_id", "recording_id", F.coalesce("by_name", "by_title").alias("video_id"), basis.alias("basis"))
    placed = written(good.join(resolved(good, natives, links), "video_id"))
    candidate = lambda kind, left, right, base, state: [F.lit(kind).alias("kind"), "video_id", F.col(left).alias("left_id"), right.alias("right_id"), base.alias("basis"), state.alias("resolution_state")]
    shared = F.lit("shared_id")
    locators = placed.select(*candidate("source_to_locator", "source_id", F.coalesce("native_source_id", "video_id"), F.col("basis"), F.col("resolution_state")))
    own = placed.where("recording_id is not null").select("video_id", "recording_id", "native_recording_id").distinct()
    other = own.where("native_recording_id <> recording_id").select(*candidate("recording_to_native", "recording_id", F.col("native_recording_id"), shared, F.lit("unique_native_recording")))
    anchor = own.groupBy("video_id").agg(F.min("recording_id").alias("anchor"))
    repeats = own.join(anchor, "video_id").where("recording_id > anchor").select(*candidate("repeat", "anchor", F.col("recording_id"), shared, F.lit("repeat")))
    return {"candidates": locators.unionByName(other).unionByName(repeats), "issues": rows.where(conflict).select("source_id", "recording_id", "by_name", "by_title")}


def suffix_plan(files: DataFrame, natives: DataFrame, links: DataFrame, directories: Sequence[str]) -> dict[str, DataFrame]:
    """Payload files (source_id, path) of the given first directories by the lane of their name.

    candidates: source_id, lane, video_id, right_id (native source, or the id), resolution_state; rejects: directory,
    reason, n. Names without any hint of an id are in neither.
    """
    parts = F.split("path", "/")
    rows = files.select("source_id", F.element_at(parts, 1).alias("directory"), F.element_at(parts, -1).alias("name")).where((F.size(parts) > 1) & F.col("directory").isin(list(directories)))
    found = F.coalesce(_id(F.col("name"), FORMAT_LABEL), _id(F.col("name"), AUDIO_ONLY), bracket_id(F.col("name")))
    # Written first, as in bracket_plan; the names go no further.
    named = written(rows.select("source_id", "directory", lane(F.col("name")).alias("lane"), found.alias("video_id"), rejection(F.col("name")).alias("reason")))
    good = named.where("lane is not null")
    candidates = good.join(resolved(good, natives, links), "video_id").select("source_id", "lane", "video_id", F.coalesce("native_source_id", "video_id").alias("right_id"), "resolution_state")
    return {"candidates": candidates, "rejects": named.where("reason is not null").groupBy("directory", "reason").agg(F.count("*").alias("n"))}


def hint_plan(listed: DataFrame, hints: DataFrame, providers: DataFrame) -> DataFrame:
    """Each row of a captured list (native_id, url) with its class, by hints and providers (native_id, source_id, url).

    provider_missing: the catalogue has no such file; url_differs: it, or the hint, stands at another address;
    already_provider: no hint was needed; late_provider: the hint came first, a candidate for review (left_id the
    hint, right_id the provider). Null ids are provider_missing.
    """
    side = lambda df, name: df.groupBy("native_id").agg(F.min(F.struct("source_id", "url")).alias(name))
    rows = listed.select("native_id", "url").join(side(providers, "p"), "native_id", "left").join(side(hints, "h"), "native_id", "left")
    elsewhere = (~F.col("p.url").eqNullSafe(F.col("url"))) | (F.col("h").isNotNull() & ~F.col("h.url").eqNullSafe(F.col("url")))
    kind = F.when(F.col("p").isNull(), "provider_missing").when(elsewhere, "url_differs").when(F.col("h").isNull(), "already_provider").otherwise("late_provider")
    late = kind == "late_provider"
    return rows.select("native_id", "url", kind.alias("class"), F.when(late, F.col("h.source_id")).alias("left_id"), F.when(late, F.col("p.source_id")).alias("right_id"))


def assigned(left: DataFrame, right: DataFrame, levels: Sequence[Sequence[str]]) -> DataFrame:
    """One-to-one assignment of left to right rows (id and key columns): id, other, level, reason.

    levels: column lists, the strictest first, each a part of the one before. At a level rows of equal, non-null keys
    meet, the n-th left over with the n-th left over by id: the result of taking pairs by level, left id and right id,
    each if both are still free. A left row without one has a reason: no_key (a column of the last level is null),
    no_counterpart (no right row has its key there), outnumbered (all that have are taken). Ids are unique on a side.
    """
    last = list(levels[-1])
    columns = list(dict.fromkeys(c for level in levels for c in level))
    free = [df.select("id", *columns) for df in (left, right)]
    pairs = []
    for i, level in enumerate(levels):
        whole = " and ".join(f"{c} is not null" for c in level)
        lot = F.to_json(F.array(*[F.col(c).cast("string") for c in level]))
        mine, theirs = (written(ranks.numbered(df.where(whole).select("id", lot.alias("lot")), "lot", ["id"])) for df in free)
        met = written(mine.join(theirs.withColumnRenamed("id", "other"), ["lot", "place"]).select("id", "other", F.lit(i).alias("level")))
        pairs.append(met)
        free = [free[0].join(met, "id", "left_anti"), free[1].join(met.select(F.col("other").alias("id")), "id", "left_anti")]
    keys = right.groupBy(*last).agg(F.lit(True).alias("met"))
    reason = F.when(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in last]), "no_key").when(F.col("met"), "outnumbered").otherwise("no_counterpart")
    rest = free[0].join(keys, last, "left").select("id", F.lit(None).cast(dict(right.dtypes)["id"]).alias("other"), F.lit(None).cast("int").alias("level"), reason.alias("reason"))
    found = reduce(DataFrame.unionByName, pairs)
    return found.withColumn("reason", F.lit(None).cast("string")).unionByName(rest)
