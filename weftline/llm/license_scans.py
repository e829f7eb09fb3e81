"""License scans by sentence rules: normalised sentences are mapped to known licence-sentence identifiers, and the
sequence of identifiers is matched against ordered licence rules.

A text is a stream of normalised words, so comment marks, quotes, markup and line ends do not matter. Sentences end at
blank lines, closing punctuation and list numbers. Within a sentence, known ones may begin and end wherever something
else than a space stands between two words (a line end, a semicolon, a bracket): wraps move nothing. Three tables know
sentences: fixed ones by all their words, open ones (with names or years in them) by their first words, and statements
that something is licensed under a named licence, with its version. Each text is scanned within its row, no shuffle;
only sentences with a trigger word, which every known one has, are looked at.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import small_batches

# Identifiers and the normalised sentences they stand for. {a|b|} is any one of these, or none; * is any
# words, or none. Of two that fit at one place the longer counts, then the earlier entry.
SENTENCES = {
    "AllRights": ("all rights reserved", "copyright * all rights reserved"),
    "MITgrant": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files *",),
    "MITcond": ("the above copyright notice and this permission notice {including the next paragraph|} shall be included in all copies or substantial portions of the software",),
    "MITwarranty": ("the software is provided as is without warranty of any kind express or implied *",),
    "MITliability": ("in no event shall the authors or copyright holders be liable for any claim damages or other liability *",),
    "ISCgrant": ("permission to use copy modify and {or|} distribute this software for any purpose with or without fee is hereby granted *",),
    "ISCwarranty": ("the software is provided as is and the author disclaims all warranties *",),
    "BSDgrant": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",),
    "BSDsource": ("{1|a|} redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",),
    "BSDbinary": ("{2|b|} redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer *",),
    "BSDname": ("{3|c|} neither the name of * may be used to endorse or promote products derived from this software without specific prior written permission", "{3|c|} the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission"),
    "BSDwarranty": ("this software is provided by * as is and any express or implied warranties * are disclaimed", "this software is provided by * as is and any express or implied warranties * are disclaimed *"),
    "ApacheComply": ("you may not use this file except in compliance with the license",),
    "ApacheCopy": ("you may obtain a copy of the license at *",),
    "ApacheWarranty": ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis *",),
    "ApacheSee": ("see the license for the specific language governing permissions and limitations under the license",),
    "ApacheTitle": ("apache license version 2 0 january 2004 *",),
    "GNUwarranty": ("this {program|library|file|software|work} is distributed in the hope that it will be useful but without any warranty *",),
    "GNUsee": ("see the gnu {lesser|affero|library|} general public license for more details",),
    "GNUcopy": ("you should have received a copy of the gnu {lesser|affero|library|} general public license along with *",),
    "GPL2title": ("gnu general public license version 2 june 1991 *",),
    "GPL3title": ("gnu general public license version 3 29 june 2007 *",),
    "LGPL21title": ("gnu lesser general public license version 2 1 february 1999 *",),
    "LGPL3title": ("gnu lesser general public license version 3 29 june 2007 *",),
    "AGPL3title": ("gnu affero general public license version 3 19 november 2007 *",),
    "MPL2name": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
    "MPL2copy": ("if a copy of the mpl was not distributed with this file you can obtain one at *",),
    "MPL2title": ("mozilla public license version 2 0 {1 definitions|}",),
    "EPL1title": ("eclipse public license v 1 0 *",),
    "EPL2title": ("eclipse public license v 2 0 *",),
    "EPL1name": ("this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 *",),
    "EPL2name": ("this program and the accompanying materials are made available under the terms of the eclipse public license {v 2 0|2 0|v2 0} *",),
    "ZlibWarranty": ("this software is provided as is without any express or implied warranty",),
    "ZlibGrant": ("permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions *",),
    "BoostGrant": ("permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license *",),
    "BoostTitle": ("boost software license version 1 0 august 17th 2003",),
    "BoostName": ("distributed under the boost software license version 1 0 *",),
    "CC0name": ("* {dedicated|released|waived} * public domain * cc0 1 0 *",),
    "CC0title": ("creative commons cc0 1 0 universal *", "cc0 1 0 universal *"),
    "Unlicense": ("this is free and unencumbered software released into the public domain",),
    "MITtitle": ("{the|} mit license {mit|}",),
    "ISCtitle": ("{the|} isc license {isc|}",),
    "BSDtitle": ("{the|} bsd {2|3} clause license", "{the|} {2|3} clause bsd license"),
}
# Licences and the identifiers, in order, that show them; earlier rules win. A licence of None is the one
# that the first sentence names.
RULES = (
    ("Apache-2.0", ("Named:Apache-2.0", "ApacheComply", "ApacheCopy", "ApacheWarranty", "ApacheSee")),
    ("BSD-3-Clause", ("BSDgrant", "BSDsource", "BSDbinary", "BSDname", "BSDwarranty")),
    ("BSD-2-Clause", ("BSDgrant", "BSDsource", "BSDbinary", "BSDwarranty")),
    ("MIT", ("MITgrant", "MITcond", "MITwarranty", "MITliability")),
    ("MIT", ("MITgrant", "MITcond", "MITwarranty")),
    ("ISC", ("ISCgrant", "ISCwarranty")),
    ("BSL-1.0", ("BoostTitle", "BoostGrant")),
    ("BSL-1.0", ("BoostGrant",)),
    ("Zlib", ("ZlibWarranty", "ZlibGrant")),
    (None, ("GNUfree", "GNUwarranty", "GNUsee", "GNUcopy")),
    (None, ("GNUfree", "GNUwarranty", "GNUsee")),
    ("MPL-2.0", ("MPL2name", "MPL2copy")),
    (None, ("GNUfree",)),
    (None, ("Named",)),
    ("MPL-2.0", ("MPL2name",)),
    ("Apache-2.0", ("ApacheTitle",)),
    ("GPL-2.0", ("GPL2title",)),
    ("GPL-3.0", ("GPL3title",)),
    ("LGPL-2.1", ("LGPL21title",)),
    ("LGPL-3.0", ("LGPL3title",)),
    ("AGPL-3.0", ("AGPL3title",)),
    ("MPL-2.0", ("MPL2title",)),
    ("EPL-1.0", ("EPL1title",)),
    ("EPL-2.0", ("EPL2title",)),
    ("EPL-1.0", ("EPL1name",)),
    ("EPL-2.0", ("EPL2name",)),
    ("BSL-1.0", ("BoostTitle",)),
    ("BSL-1.0", ("BoostName",)),
    ("CC0-1.0", ("CC0name",)),
    ("CC0-1.0", ("CC0title",)),
    ("Unlicense", ("Unlicense",)),
    ("Proprietary", ("AllRights",)),
)
#: An open sentence is found by so many of its first words, or all before the *.
HEAD = 3
#: Identifiers passed over between, and before, those of a rule: what licence texts carry without being part of them.
FILLERS = ("AllRights", "MITtitle", "ISCtitle", "BSDtitle")
# Each known sentence has one of these; the phrases with anything between their words that is no word.
TRIGGERS = ("licen", "warrant", "redistribut", "permission", "reserved", "gpl", "cc0")
_PHRASES = "|".join(p.replace(" ", "[^a-z0-9]+") for p in ("public domain", "copy of the mpl", "liable for any claim", "under mit"))
_TRIGGER = re.compile("|".join((*TRIGGERS, _PHRASES, "under[^a-z0-9]+(?:the[^a-z0-9]+|a[^a-z0-9]+)?(?:cc|creative)")))
#: Where sentences end: a line without words, closing punctuation (a number may go on: "v. 2.0"), a list number.
_ENDS = re.compile(r"\n[^\w\n]*(?=\n)|(?<=[.!?])[\"')\]*_]*(?:\s+(?!\W*\d)|$)|\n(?=[^\w\n]*\(?\d{1,2}[.)]\s)")
_WORD = re.compile(r"[a-z0-9]+")
# Comment marks at a line's start that are words.
_MARK = re.compile(r"^[ \t]*(?:dnl|rem)\b", re.M)
_OTHER = re.compile(r"[^a-z0-9]+")

# Names of licences in normalised words.
_VERSION = r"(?:(?: version| v)? v?|v)"
_NAMES = (
    (r"(?:mit x11|mit expat|mit|expat)", "MIT"),
    (rf"apache(?: software)?(?: licen[sc]e)?{_VERSION}2(?: 0)?", "Apache-2.0"),
    (rf"(?:gnu )?(?:(?P<kind>lesser general|library general|affero general|general) public licen[sc]e(?: [la]?gpl)?|(?P<short>[la]?gpl))(?: as published by the free software foundation)?(?: either)?(?:{_VERSION}(?P<version>[123](?: [01])?)\b)?(?: of the licen[sc]e)?(?P<later> or (?:at your option )?(?:any )?(?:later|newer)(?: versions?)?)?(?: only)?", "GNU"),
    (r"(?:(?P<clauses>2|two|simplified|freebsd|3|three|new|modified|revised) (?:clause )?)?bsd(?: (?P<after>2|two|3|three) clause)?", "BSD"),
    (r"isc", "ISC"),
    (rf"(?:mozilla public licen[sc]e(?: mpl)?|mpl){_VERSION}(?P<mpl>1 0|1 1|2 0)", "MPL"),
    (rf"(?:eclipse public licen[sc]e(?: epl)?|epl){_VERSION}(?P<epl>1 0|2 0)", "EPL"),
    (r"zlib(?: libpng)?", "Zlib"),
    (rf"boost(?: software)?(?: licen[sc]e)?{_VERSION}1 0", "BSL-1.0"),
    (rf"artistic licen[sc]e{_VERSION}2 0", "Artistic-2.0"),
    (r"unlicen[sc]e", "Unlicense"),
    (r"wtfpl", "WTFPL"),
    (r"(?:creative commons )?(?:cc0|cc zero|zero)(?: v?1 0)?(?: universal)?", "CC0-1.0"),
    (r"(?:creative commons|cc) (?P<cc>(?:by|attribution)(?: (?:sa|nc|nd|share ?alike|non ?commercial|no ?deriv(?:ative)?s(?: works)?))*)(?: v?[1234] [05])?(?: (?:international|unported|generic))?", "CC"),
)
_NAMED = [(re.compile(rf"{p}(?: (?:software |public )?licen[sc]e(?: agreement)?)?(?: (?:mit|isc|the licen[sc]e))?\b"), name) for p, name in _NAMES]
_STATES = re.compile(r"(?:(?:this|the|these|our|all) (?:[a-z0-9]+ ){1,4}?(?:is|are|can be|may be) |it is |you may use (?:it|this [a-z]+) )?(?:(?:dual|also|hereby|free|open source)? ?(?:licen[sc]ed|released|distributed|available|published|provided|made available|redistributed|used) )?(?:to you )?under (?:the )?(?:terms (?:and conditions )?of )?(?:either )?(?:the |an? )?(?:terms of )?(?:the )?")
_ALSO = re.compile(r" (?:or|and)(?: under)?(?: the terms of)?(?: the| an?)? ")
_FREE = re.compile(r"(?:this|the) [a-z0-9]+(?: [a-z0-9]+)? is free software you can redistribute it and or modify it under the terms of (?:the )?")
_SPDX = re.compile(r"spdx-license-identifier:[ \t]*([^\n]*)", re.I)
_SPDX_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+-]+")


def normalise(sentence: str) -> str:
    return _OTHER.sub(" ", sentence.lower()).strip()


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans of the sentences, cut at blank lines, after closing punctuation and before list numbers."""
    cuts = [0, *[m.end() for m in _ENDS.finditer(text)], len(text)]
    return [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def _expanded(template: str) -> Iterator[str]:
    """A template's sentences: one for each choice of words."""
    parts = [p.split("|") for p in re.split(r"[{}]", template)]
    for choice in itertools.product(*parts):
        yield " ".join(" ".join(choice).split())


def _gnu(m: re.Match) -> str:
    kind = (m["kind"] or m["short"])[0].replace("g", "")
    version = (m["version"] or "").replace(" ", ".")
    version = f"-{version}{'' if '.' in version else '.0'}" if version else ""
    return f"{kind.upper()}GPL{version}{'-or-later' if m['later'] and version else ''}"


def _creative_commons(m: re.Match) -> str:
    words = m["cc"].replace(" ", "")
    found = [short for short, long in (("NC", "noncommercial"), ("ND", "noderiv"), ("SA", "sharealike")) if re.search(f"(?: {short.lower()}\\b)", m["cc"]) or long in words]
    return "-".join(["CC-BY", *found])


def _named(norm: str, at: int) -> tuple[str, int] | None:
    """The licence that is named at this place, the longest name, and where it ends."""
    best = None
    for pattern, name in _NAMED:
        if (m := pattern.match(norm, at)) and (best is None or m.end() > best[1]):
            if name == "GNU":
                name = _gnu(m)
            elif name == "BSD":
                many = m["clauses"] or m["after"]
                name = "BSD" if not many else "BSD-2-Clause" if many in ("2", "two", "simplified", "freebsd") else "BSD-3-Clause"
            elif name in ("MPL", "EPL"):
                name = f"{name}-{m[name.lower()].replace(' ', '.')}"
            elif name == "CC":
                name = _creative_commons(m)
            best = name, m.end()
    return best


def spdx_licences(expression: str) -> list[str]:
    """The licences of an SPDX expression in order, with their exceptions; what stands after the expression is left out."""
    out: list[str] = []
    need, depth = True, 0
    for m in _SPDX_TOKEN.finditer(expression.split("*/")[0].split("-->")[0]):
        word = m[0]
        if word == "(":
            if not need:
                break
            depth += 1
        elif word == ")":
            if need or not depth:
                break
            depth -= 1
        elif word.upper() in ("AND", "OR", "WITH"):
            if need:
                break
            need = True
            with_exception = word.upper() == "WITH"
            if with_exception:
                out[-1] += " WITH"
        elif need:
            word = word.rstrip(".")
            if out and out[-1].endswith(" WITH"):
                out[-1] += f" {word}"
            else:
                out.append(word)
            need = False
        else:
            break
    return [x.removesuffix(" WITH") for x in out if x]


class SentenceMap:
    """Sentences at a place in a stream of words -> identifier, by look-ups whose work is linear in the sentence."""

    def __init__(self, sentences: dict[str, tuple[str, ...]] = SENTENCES) -> None:
        self.exact: dict[tuple[str, ...], str] = {}
        self.sizes: dict[str, list[int]] = {}
        self.open: dict[tuple[str, ...], list[tuple[str, list[str]]]] = {}
        self.inner: dict[str, list[tuple[str, list[str]]]] = {}
        for name, templates in sentences.items():
            for text in dict.fromkeys(t for template in templates for t in _expanded(template)):
                words = tuple(text.split())
                parts = [p.strip() for p in text.split("*")]
                if "*" not in words:
                    self.exact.setdefault(words, name)
                    sizes = self.sizes.setdefault(words[0], [])
                    if len(words) not in sizes:
                        sizes.append(len(words))
                elif parts[0]:
                    self.open.setdefault(tuple(parts[0].split()[:HEAD]), []).append((name, parts))
                else:
                    self.inner.setdefault([p for p in parts if p][-1].split()[0], []).append((name, parts))

    def within(self, words: list[str], joints: list[bool]) -> list[tuple[int, int, str]]:
        """(first word, end, identifier) of the known sentences in a sentence, left to right, apart.

        joints: for each place between words, the ends included, whether a known sentence may begin or end there.
        """
        n, norm = len(words), " ".join(words)
        at = [0]
        for w in words:
            at.append(at[-1] + len(w) + 1)
        ends = {a - 1: i for i, a in enumerate(at)}
        for w in self.inner.keys() & set(words):
            for name, parts in self.inner[w]:
                if _holds(f" {norm} ", parts):
                    return [(0, n, name)]
        out, i, failed = [], 0, set()
        while i < n:
            best = self._at(words, joints, norm, at, ends, i, failed) if joints[i] else None
            if best:
                out.append((i, *best))
                i = best[0]
            else:
                i += 1
        return out

    def _at(self, words: list[str], joints: list[bool], norm: str, at: list[int], ends: dict[int, int], i: int, failed: set) -> tuple[int, str] | None:
        found = []
        for size in self.sizes.get(words[i], ()):
            if i + size <= len(words) and joints[i + size] and (name := self.exact.get(tuple(words[i : i + size]))):
                found.append((i + size, name))
        for k in range(1, HEAD + 1):
            for entry in self.open.get(tuple(words[i : i + k]), ()):
                key = (entry[0], entry[1][0])
                if key in failed:
                    continue
                if end := _open_end(norm, at[i], entry[1], ends, joints):
                    found.append((end, entry[0]))
                else:
                    # What does not follow here in this sentence does not follow later in it.
                    failed.add(key)
        if m := _STATES.match(norm, at[i]) if "under" in words[i : i + 12] else None:
            found += self._named_end(norm, m.end(), ends, joints, "Named")
        if m := _FREE.match(norm, at[i]) if words[i] in ("this", "the") else None:
            found += self._named_end(norm, m.end(), ends, joints, "GNUfree")
        return max(found, key=lambda x: x[0]) if found else None

    @staticmethod
    def _named_end(norm: str, at: int, ends: dict[int, int], joints: list[bool], kind: str) -> list[tuple[int, str]]:
        names, found = [], []
        while one := _named(norm, at):
            names.append(one[0])
            end = ends.get(one[1])
            if end is not None and joints[end]:
                found = [(end, f"{kind}:{'+'.join(dict.fromkeys(names))}")]
            more = _ALSO.match(norm, one[1])
            if not more:
                break
            at = more.end()
        return found


def _open_end(norm: str, at: int, parts: list[str], ends: dict[int, int], joints: list[bool]) -> int | None:
    """Where an open sentence that begins at this place ends, in words: with its last part, or with the whole sentence."""
    text = norm + " "
    if not text.startswith(parts[0] + " ", at):
        return None
    at += len(parts[0]) + 1
    for part in parts[1:]:
        if not part:
            continue
        found = text.find(f" {part} ", at - 1)
        if found < 0:
            return None
        at = found + len(part) + 2
    if parts[-1] == "":
        return ends[len(norm)]
    end = ends.get(at - 1)
    return end if end is not None and joints[end] else None


def _holds(sentence: str, parts: list[str]) -> bool:
    """Do all parts stand in the sentence in order, the last at its end?"""
    at, end = 0, len(sentence)
    if parts[-1]:
        if not sentence.endswith(f" {parts[-1]} "):
            return False
        end -= len(parts[-1]) + 1
    for part in parts[1:-1]:
        if (at := sentence.find(f" {part} ", at, end)) < 0:
            return False
        at += len(part) + 1
    return at < end


_MAP = SentenceMap()


def _rule_at(names: tuple[str, ...], at: int) -> tuple[list[str], int] | None:
    """The licences of the first rule whose identifiers come from at on, fillers passed over; and where it ends."""
    for licence, wanted in RULES:
        i, k, first = at, 0, ""
        while i < len(names) and k < len(wanted):
            if names[i] == wanted[k] or names[i].split(":")[0] == wanted[k]:
                first = first or names[i]
                k += 1
            elif names[i] not in FILLERS or i == at and licence == "Proprietary":
                break
            i += 1
        if k == len(wanted):
            return ([licence] if licence else first.split(":")[1].split("+")), i
    return None


def scan_text(text: str | None) -> tuple[list[tuple[int, int, str]], list[str]]:
    """Known sentences (start, end, identifier) in order; and the licences their sequence shows, in order, once each.

    An identifier that begins no rule's sequence is passed over; fillers may stand before and within a rule's sequence.
    A span reaches to its sentence's ends where the known one does.
    """
    # The only letter that is longer in lower case would move the places behind it.
    whole = _MARK.sub(lambda m: " " * len(m[0]), (text or "").replace("\u0130", "i").lower())
    if not _TRIGGER.search(whole):
        return [], []
    found, spdx = [], {}
    for a, b in sentences(whole):
        low = whole[a:b]
        if not _TRIGGER.search(low):
            continue
        for line in _SPDX.finditer(low):
            spdx[a + line.start()] = spdx_licences(text[a + line.start(1) : a + line.end(1)])
            found.append((a + line.start(), a + line.end(), "SPDX"))
        marks = [m.span() for m in _WORD.finditer(low)]
        if not marks:
            continue
        joints = [True, *[low[x[1] : y[0]].strip(" ") != "" for x, y in zip(marks, marks[1:], strict=False)], True]
        for i, end, name in _MAP.within([low[x:y] for x, y in marks], joints):
            found.append((a + (marks[i][0] if i else 0), b if end == len(marks) else a + marks[end - 1][1], name))
    found.sort()
    names = tuple(f[2] for f in found)
    licences, at = [], 0
    while at < len(names):
        if names[at] == "SPDX":
            licences += spdx[found[at][0]]
            at += 1
            continue
        shown, at = _rule_at(names, at) or ([], at + 1)
        licences += shown
    return found, list(dict.fromkeys(licences))


def license_scans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, matches (array of start, end in code points, sentence identifier), licenses (array).

    Null and empty texts have neither. Long texts and long sentences take time in proportion to their length. Repeated
    rows and null ids come back as often as they came in; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("matches array<struct<start:long,end:long,sentence:string>>, licenses array<string>")
    def scanned(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([scan_text(t) for t in texts], columns=["matches", "licenses"])

    return docs.select(F.col(doc_id).alias("doc_id"), scanned(F.col(text)).alias("_found")).select("doc_id", "_found.matches", "_found.licenses")
