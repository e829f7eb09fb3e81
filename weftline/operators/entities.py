"""Entities: phrases discovered in texts, and whole-word mentions of a gazetteer of any size."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.graphs import written

# Known places and platforms, and the patterns of names in prose.
PLACES = ("Japan", "Thailand", "England", "United Kingdom", "South Korea", "Korea", "China", "Taiwan", "Hong Kong", "Germany", "Canada", "Australia", "Tokyo", "Osaka", "Kyoto", "Bangkok", "London")
PLATFORMS = ("YouTube", "Twitch", "Patreon", "Discord", "Reddit", "TikTok", "Instagram")
PHRASE = r"\b[A-Z][a-z]{2,}(?:[ '-][A-Z][a-z]{2,}){1,2}\b"
INTRODUCED = r"\b(?:named|called|friend|advisor|instructor|coworker)\s+([A-Z][a-z]{2,})\b"
# Words that begin no name, months and days.
LEAD_IN = (
    "And|Or|But|An|A|They|Them|You|Your|We|Our|He|She|Him|My|Me|Us|Am|Are|Were|Was|Have|Has|Had|Been|Being|Then|Than|So|Because|There|Here|These|Those|Yes|Yet|Very|Today|Yesterday|Tomorrow|"
    "The|This|That|His|Her|Their|When|After|Before|During|According|Last|Next|One|Two|Three|First|Second|Whether|Why|How|What|Which|Who|Where|If|While|Despite|Both|Did|Does|Will|Would|Could|"
    "Should|Can|Some|Several|Many|Most|More|Other|Only|Any|All|Still|Also|About|Around|As|At|By|For|From|In|Into|Is|It|Its|On|Since|To|Until|With|Without|No|Not"
)
CALENDAR = "January|February|March|April|May|June|July|August|September|October|November|December|Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday"
# Word borders are those of ASCII, whatever the expression engine thinks of other letters.
_BORDER = ("(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])")
#: Characters of the names that one automaton takes; more are dealt over several.
AUTOMATON = 4_000_000


def may_be_name(label: Column) -> Column:
    """Neither begins with a word that begins no name nor holds a month or day. For labels of ASCII letters, as the patterns find."""
    return ~label.rlike(rf"(?i)^(?:{LEAD_IN})\b") & ~label.rlike(rf"(?i)\b(?:{CALENDAR})\b")


def discovered(docs: DataFrame, key: str, text: str, least: int = 2) -> DataFrame:
    """(label, docs): name-like phrases, and single names that are introduced as such, that `least` documents or more have."""
    within = lambda p: F.lit(p.removeprefix(r"\b").removesuffix(r"\b").join(_BORDER))
    both = F.concat(F.regexp_extract_all(F.col(text), within(PHRASE), F.lit(0)), F.regexp_extract_all(F.col(text), within(INTRODUCED), F.lit(1)))
    found = docs.select(key, F.explode(F.array_distinct(both)).alias("label")).where(may_be_name(F.col("label")))
    return found.groupBy("label").agg(F.countDistinct(key).alias("docs")).where(F.col("docs") >= least)


def gazetteer(speakers: DataFrame, phrases: DataFrame) -> DataFrame:
    """(id, label, type): people from speakers (label), places, platforms, then phrases (label); of one key the first stays.

    A key is the label in lower case with single spaces; the id is its digest.
    """
    spark = speakers.sparkSession
    fixed = spark.createDataFrame([(x, "place", 1) for x in PLACES] + [(x, "platform", 2) for x in PLATFORMS], "label string, type string, rank int")
    rows = speakers.select("label", F.lit("person").alias("type"), F.lit(0).alias("rank")).unionByName(fixed).unionByName(phrases.select("label", F.lit("unknown").alias("type"), F.lit(3).alias("rank")))
    rows = rows.withColumn("label", F.trim("label")).where("label <> ''")
    name = F.lower(F.regexp_replace("label", r"\s+", " "))
    first = rows.groupBy(name.alias("key")).agg(F.min(F.struct("rank", "label", "type")).alias("x"))
    return first.select(F.concat(F.lit("entity_"), F.substring(F.sha2(F.col("key").cast("binary"), 256), 1, 24)).alias("id"), "x.label", "x.type")


def _word(c: str) -> bool:
    return c.isalnum() or c == "_"


def automaton(names: list[str]):
    """An Aho-Corasick automaton of the names."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for name in names:
        machine.add_word(name, len(name))
    if names:
        machine.make_automaton()
    return machine


def candidates(machine, text: str) -> list[tuple[int, int]]:
    """(start, end) of all whole-word occurrences of the machine's names, overlapping ones too."""
    out = []
    for last, size in machine.iter(text) if len(machine) else ():
        start, end = last + 1 - size, last + 1
        if not (start and _word(text[start - 1])) and not (end < len(text) and _word(text[end])):
            out.append((start, end))
    return out


def leftmost_longest(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of spans those that a reader from the left takes, the longest at each place, none overlapping."""
    out, at = [], 0
    for start, end in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= at:
            out.append((start, end))
            at = end
    return out


def mentions(docs: DataFrame, key: str, text: str, names: DataFrame, most: int = AUTOMATON) -> DataFrame:
    """(key, label, start, end): whole-word mentions of names (label), from the left, the longest where several begin.

    Time is linear in the texts and the names. Names of up to `most` characters in all make one automaton, sent to the
    tasks; more are dealt by their first letter and digest to several, the texts go past each, and what is found meets
    by document. Null texts have no mentions.
    """
    labels = written(names.select("label").where(F.length("label") > 0).distinct())
    size = labels.agg(F.sum(F.length("label")).alias("n")).first()["n"] or 0
    lots = -(-size // most) or 1
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    first = F.pmod(F.xxhash64(F.substring("label", 1, 1), F.when(F.lit(lots > 64), F.xxhash64("label") % 16)), F.lit(int(lots)))

    def passed(lot: int, whole: bool) -> DataFrame:
        # A lot may be larger than most where many names begin alike, by a factor that the digests bound.
        held = rows.sparkSession.sparkContext.broadcast([r["label"] for r in labels.where(first == lot).collect()])

        def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            machine = automaton(held.value)
            for batch in batches:
                out = []
                for k, body in zip(batch["key"], batch["text"], strict=True):
                    spans = candidates(machine, body)
                    out += [(k, body[a:b], a, b) for a, b in (leftmost_longest(spans) if whole else spans)]
                yield pd.DataFrame(out, columns=["key", "label", "start", "end"])

        return rows.mapInPandas(find, f"key {kind}, label string, start int, end int")

    if lots == 1:
        found = passed(0, True)
    else:
        several = None
        for lot in range(lots):
            part = written(passed(lot, False))
            several = part if several is None else several.unionByName(part)

        def settle(part: pd.DataFrame) -> pd.DataFrame:
            kept = leftmost_longest(list(zip(part["start"], part["end"], strict=True)))
            return part.set_index(["start", "end"]).loc[kept].reset_index()[["key", "label", "start", "end"]].drop_duplicates()

        found = several.groupBy("key").applyInPandas(settle, f"key {kind}, label string, start int, end int")
    return found.withColumnRenamed("key", key) if key != "key" else found
