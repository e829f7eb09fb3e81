"""Text, date, id and url functions: Column to Column; pandas UDFs only for Unicode normal forms and canonical JSON."""

from __future__ import annotations

import json
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_form(c: Column, form: str = "NFKC") -> Column:
    """Unicode normal form; null stays null."""

    @F.pandas_udf("string")
    def normalised(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize(form, x))

    return normalised(c)


def canonical_json(c: Column) -> Column:
    """JSON text with sorted keys, no spaces, non-ASCII kept; null for text that is not JSON."""

    @F.pandas_udf("string")
    def canonical(s: pd.Series) -> pd.Series:
        def one(x: str | None) -> str | None:
            try:
                return None if x is None else json.dumps(json.loads(x), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
            except ValueError:
                return None

        return s.map(one)

    return canonical(c)


def slug(c: Column, most: int = 80) -> Column:
    """Lower-case ASCII words joined by hyphens, cut at most characters; letters with marks lose them."""
    plain = F.regexp_replace(normal_form(c, "NFKD"), r"[^\x00-\x7F]", "")
    return _slug(plain, most)


def ascii_slug(c: Column, most: int = 80) -> Column:
    """slug() of text that is ASCII already, without leaving the JVM."""
    return _slug(c, most)


def _slug(c: Column, most: int) -> Column:
    joined = F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-")
    return F.regexp_replace(F.substring(F.regexp_replace(joined, "^-+|-+$", ""), 1, most), "-+$", "")


def match_key(c: Column) -> Column:
    """Normal form, trimmed, white space collapsed, lower case: texts with one key count as the same."""
    return F.lower(F.trim(F.regexp_replace(normal_form(c), r"\s+", " ")))


def words(c: Column) -> Column:
    """Query words: lower case, split at white space."""
    return F.array_remove(F.split(F.lower(F.trim(c)), r"\s+"), "")


def all_words_in(text: Column, query: list[str]) -> Column:
    low = F.lower(text)
    found = F.lit(True)
    for w in query:
        found = found & (F.instr(low, w) > 0)
    return found


def preview(c: Column, most: int = 240) -> Column:
    """At most so many characters, cut before the last word that does not fit whole."""
    return F.when(F.char_length(c) <= most, c).otherwise(F.regexp_extract(F.substring(c, 1, most + 1), r"(?s)^(.*)\s", 1))


def _accents() -> tuple[str, str]:
    """Latin letters that decompose into an ASCII letter and marks, lower case, and those ASCII letters."""
    found = {}
    for code in range(0xC0, 0x1F00):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and parts[0].isascii() and parts[0].isalpha() and all(map(unicodedata.combining, parts[1:])):
            found[chr(code)] = parts[0]
    return "".join(found), "".join(found.values())


def unaccented(c: Column) -> Column:
    """Without the diacritics of Latin letters, composed or combining. Texts in ASCII are left as they are."""
    bare = F.regexp_replace(F.translate(c, *_accents()), r"[\u0300-\u036f]", "")
    return F.when(c.rlike(r"[^\x00-\x7f]"), bare).otherwise(c)


def tokens(c: Column) -> Column:
    """Search terms: letters and digits, lower case, without diacritics."""
    return F.array_remove(F.split(unaccented(F.lower(c)), r"[^\p{L}\p{N}]+"), "")


def partial_date(c: Column) -> tuple[Column, Column]:
    """(year, month) of YYYY, YYYY-MM or YYYY-MM-DD; both null unless the calendar has it, month null where not given."""
    full = F.rpad(c, 10, "")
    day = F.when(c.rlike(r"^\d{4}$"), F.concat(c, F.lit("-01-01"))).when(c.rlike(r"^\d{4}-\d{2}$"), F.concat(c, F.lit("-01"))).when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), full)
    valid = F.try_to_date(day, "yyyy-MM-dd")
    return F.year(valid), F.when(F.char_length(c) >= 7, F.date_format(valid, "yyyy-MM"))


# The buckets of lengths, by the minutes they end before.
LENGTHS = {"under-5": 5, "5-20": 20, "20-60": 60, "60-180": 180}
LONGEST, NO_LENGTH = "180-plus", "unknown"


def length_bucket(ms: Column) -> Column:
    """The bucket of a length in milliseconds; unknown for null, NaN and what is not positive."""
    bucket = F.when(ms.isNull() | F.isnan(ms.cast("double")) | (ms <= 0), NO_LENGTH)
    for name, minutes in LENGTHS.items():
        bucket = bucket.when(ms < minutes * 60_000, name)
    return bucket.otherwise(LONGEST)


def clock(seconds: Column) -> Column:
    """h:mm:ss, or m:ss under an hour."""
    s = F.floor(seconds)
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    return F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, r)).otherwise(F.format_string("%d:%02d", m, r))


def deep_link(base: Column, seconds: Column) -> Column:
    return F.concat(base, F.when(F.instr(base, "?") > 0, F.lit("&t=")).otherwise(F.lit("?t=")), F.floor(seconds).cast("string"))


def short_id(prefix: str, *parts: Column, digits: int = 32) -> Column:
    """prefix_ and the first hex digits of the sha256 of the parts, NUL-joined."""
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(F.concat_ws("\u0000", *parts).cast("binary"), 256), 1, digits))


def uuid5(namespace: str, name: Column) -> Column:
    """RFC 4122 version 5, as text: sha1 of namespace and name with version and variant bits set."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    high = F.element_at(F.array(*[F.lit(x) for x in "89ab"]), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1)
    part = lambda a, n: F.substring(h, a, n)
    return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(high, part(18, 3)), part(21, 12))


def language_partition(c: Column) -> Column:
    """Two-letter primary language, or en."""
    primary = F.lower(F.regexp_extract(F.coalesce(c, F.lit("")), r"^([A-Za-z]{2})(?:-|_|$)", 1))
    return F.when(primary == "", "en").otherwise(primary)
