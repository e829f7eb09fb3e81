"""Integrity checks: each returns a DataFrame of violations, empty for sound data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators import ranks
from weftline.operators.graphs import written


# Fixed values of summary releases.
SUMMARY_KINDS = ["archive", "yearly", "monthly", "transcript"]
RESERVED_IDS = ["browse", "index", "search"]


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-null key no parent has."""
    return child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def outside(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(allowed)))


def report(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, violations) of every check; all counts come from one union."""
    parts = [df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations") for name, df in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unknown_columns(df: DataFrame, expected: dict[str, str]) -> list[str]:
    """What keeps df's schema from being exactly expected (name -> type): missing, unknown and mistyped columns."""
    have = dict(df.dtypes)
    return sorted([f"missing {c}" for c in expected if c not in have] + [f"unknown {c}" for c in have if c not in expected] + [f"{c} is {have[c]}, not {k}" for c, k in expected.items() if c in have and have[c] != k])


def asymmetric(pairs: DataFrame, a: str, b: str, value: str, tolerance: float = 1e-8) -> DataFrame:
    """Pairs of a long matrix whose mirror image is missing or differs."""
    other = pairs.select(F.col(a).alias(b), F.col(b).alias(a), F.col(value).alias("_other"))
    return pairs.join(other, [a, b], "left").where(F.col("_other").isNull() | (F.abs(F.col(value) - F.col("_other")) > tolerance))


def release_shape(manifest: DataFrame, recordings: DataFrame, segments: DataFrame) -> DataFrame:
    """(check, violations) of a release: manifest (shard, rows, first_id, last_id), recordings (id, shard, slug), segments
    (id, place, start, end).

    Every shard holds the rows and the range of ids that the manifest says, and ranges do not meet; ids and slugs are
    unique; a recording's segments are numbered from 0 without gaps, have a positive length and start in order.
    """
    held = recordings.groupBy("shard").agg(F.count("*").alias("held"), F.min("id").alias("lo"), F.max("id").alias("hi"))
    both = manifest.join(held, "shard", "full_outer")
    differ = ~F.coalesce((F.col("rows") == F.col("held")) & (F.col("first_id") == F.col("lo")) & (F.col("last_id") == F.col("hi")), F.lit(False))
    # Each range beside the next one: numbered without a sort in one task.
    placed = written(ranks.numbered(manifest.select("shard", "first_id", "last_id").withColumn("lot", F.lit(0)), "lot", ["first_id", "last_id", "shard"]))
    following = placed.select((F.col("place") - 1).alias("place"), F.col("first_id").alias("next"))
    overlap = placed.join(following, "place").where("next <= last_id")
    inner = Window.partitionBy("id").orderBy("place")
    late = segments.withColumn("before", F.lag("start").over(inner)).where("start < before")
    numbers = segments.groupBy("id").agg(F.min("place").alias("lo"), F.max("place").alias("hi"), F.count("*").alias("n"), F.countDistinct("place").alias("kinds"))
    return report(
        {
            "shards": both.where(differ),
            "ranges": overlap,
            "ids": duplicate_keys(recordings, ["id"]),
            "slugs": duplicate_keys(recordings.where("slug is not null"), ["slug"]),
            "orphans": orphans(segments, "id", recordings, "id"),
            "places": numbers.where("lo <> 0 or hi <> n - 1 or kinds <> n"),
            "lengths": segments.where(~F.coalesce(F.col("end") > F.col("start"), F.lit(False))),
            "order": late,
        }
    )


def network_projection(names: DataFrame, annual: DataFrame, monthly: DataFrame, edges: DataFrame, bursts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(check, violations) of a mention network: names (name, group), annual (year, low, middle, high), monthly (month, name,
    rate), edges (a, b, weight, baseline, lift), bursts (name, start, end, months).

    Names are unique, of known groups and fit to be shown; years and months exist and come once; intervals are in order;
    an edge joins two different known names, once whichever way; rates and weights are not negative; bursts end after
    they start and are of known names.
    """
    month = r"^20\d{2}-(0[1-9]|1[0-2])$"
    unfit = (F.trim("name") == "") | (F.char_length("name") > 100) | F.col("name").rlike(r"[<>\x00-\x1f]|(?i:https?:|file:|/home/|/mnt/)")
    negative = lambda *cs: F.greatest(*[F.coalesce(F.col(c) < 0, F.lit(True)).cast("int") for c in cs]) == 1
    ends = edges.select(F.explode(F.array("a", "b")).alias("name"))
    pairs = edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    return report(
        {
            "names": names.where(F.col("name").isNull() | unfit),
            "unique names": duplicate_keys(names, ["name"]),
            "groups": names.where(~F.coalesce(F.col("group").isin(list(groups)), F.lit(False))),
            "years": annual.where(~F.coalesce(F.col("year").between(2000, 2100), F.lit(False))),
            "unique years": duplicate_keys(annual, ["year"]),
            "intervals": annual.where((F.col("low") > F.col("high")) | (F.col("low") > F.col("middle")) | (F.col("middle") > F.col("high"))),
            "months": monthly.where(~F.coalesce(F.col("month").rlike(month), F.lit(False))),
            "unique months": duplicate_keys(monthly, ["month", "name"]),
            "month names": orphans(monthly, "name", names, "name"),
            "rates": monthly.where(F.col("rate") < 0),
            "loops": edges.where(F.col("a").eqNullSafe(F.col("b"))),
            "endpoints": orphans(ends, "name", names, "name"),
            "unique edges": duplicate_keys(pairs, ["lo", "hi"]),
            "weights": edges.where(negative("weight", "baseline", "lift")),
            "burst names": orphans(bursts, "name", names, "name"),
            "bursts": bursts.where(~F.coalesce(F.col("start").rlike(month) & F.col("end").rlike(month) & (F.col("start") <= F.col("end")) & (F.col("months") >= 1), F.lit(False))),
        }
    )


def summary_release(summaries: DataFrame, items: DataFrame, published: DataFrame, sections: Sequence[str], classes: Sequence[str], prepared: bool = False) -> DataFrame:
    """(check, violations) of a release of summaries (id, kind, period, title, recording_id, publication), their items (id,
    section, text, classification, sources) and the published recordings (recording_id).

    Ids are slugs, unique and not reserved; a kind has the period that fits it; a transcript's summary is of a published
    recording, any other of none; a scope (kind with its recording or period) has one summary. Every summary has items
    in the first section, none has over 100 in one. An item has a text, a class that fits its section, and sources:
    at least one, none twice, all published, and for a transcript its own recording alone.
    """
    no = lambda c: ~F.coalesce(c, F.lit(False))
    written_text = lambda c, most: (F.trim(c) != "") & (F.char_length(c) <= most)
    kind, period = F.col("kind"), F.col("period")
    transcript = F.coalesce(kind == "transcript", F.lit(False))
    fits = (
        F.when(kind == "archive", period.isNull())
        .when(kind == "yearly", period.rlike(r"^\d{4}$"))
        .when(kind == "monthly", period.isNull() | period.rlike(r"^\d{4}-\d{2}$"))
        .when(kind == "transcript", period.isNull() | period.rlike(r"^\d{4}-\d{2}$"))
    )
    scopes = summaries.select("kind", F.when(transcript, F.col("recording_id")).otherwise(period).alias("scope"))
    released = published.select("recording_id").where("recording_id is not null").distinct()
    unreleased = summaries.where(transcript).join(released, "recording_id", "left_anti")
    opened = summaries.join(items.where(F.col("section") == sections[0]).select("id").distinct(), "id", "left_anti")
    sources = F.coalesce("sources", F.array().cast("array<string>"))
    doubled = (F.size(sources) == 0) | (F.size(F.array_distinct(sources)) < F.size(sources))
    each = items.select("id", F.explode("sources").alias("recording_id"))
    unlisted = each.join(released, "recording_id", "left_anti")
    own = summaries.where(transcript).select("id", F.col("recording_id").alias("own"))
    foreign = each.join(own, "id").where(~F.col("recording_id").eqNullSafe(F.col("own")))
    fitting = F.col("classification").isin(list(classes)) & ((F.col("section") != "uncertainties") | (F.col("classification") == "uncertainty"))
    return report(
        {
            "ids": summaries.where(no(F.col("id").rlike(r"^[a-z0-9][a-z0-9-]{0,95}$") & ~F.col("id").isin(RESERVED_IDS))),
            "unique ids": duplicate_keys(summaries, ["id"]),
            "kinds": summaries.where(no(kind.isin(SUMMARY_KINDS))),
            "publication": summaries.where(no(F.col("publication").isin(["approved", "prepared"] if prepared else ["approved"]))),
            "titles": summaries.where(no(written_text(F.col("title"), 500))),
            "periods": summaries.where(period.isNotNull() & no(period.rlike(r"^(19|20)\d{2}(-(0[1-9]|1[0-2]))?$"))),
            "kind and period": summaries.where(kind.isin(SUMMARY_KINDS) & no(fits)),
            "unreleased": unreleased,
            "recordings": summaries.where(~transcript & F.col("recording_id").isNotNull()),
            "unique scopes": duplicate_keys(scopes, ["kind", "scope"]),
            "empty": opened,
            "sections": items.where(no(F.col("section").isin(list(sections)))),
            "long sections": items.groupBy("id", "section").agg(F.count("*").alias("n")).where("n > 100"),
            "texts": items.where(no(written_text(F.col("text"), 4000))),
            "classes": items.where(no(fitting)),
            "sources": items.where(doubled),
            "unreleased sources": unlisted,
            "foreign sources": foreign,
            "orphans": orphans(items, "id", summaries, "id"),
        }
    )
