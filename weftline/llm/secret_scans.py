"""Secret scans: fixed patterns, and a randomness test battery over long runs of encoding characters.

Each run's encoding is inferred from its characters; three tests (chi-squared uniformity over that alphabet, runs about
its middle, lag-1 serial correlation) must not reject randomness. Short runs pass such tests whatever they are, so a
run must also have too many rare letters for ordinary text, whatever its case (hex, with six letters: too few equal
characters). Ordinary text's shares are those of the whole corpus outside the runs. That p-value is controlled for false
discoveries by Benjamini-Hochberg within each length class over the whole corpus. Only character counts and the counts
of p-values by class and bin, tables of fixed size, reach the driver; candidates are few and never leave their row.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import Scratch, saved, small_batches, unused

#: Kinds in their listed order; the last is the battery's.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Every access and hex match lies in one of these.
RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings from the narrowest; a run gets the first that has all its characters.
ENCODINGS = (DIGITS + "abcdef", DIGITS + "ABCDEF", UPPER + "234567", LOWER + "234567", DIGITS + LOWER, DIGITS + UPPER, DIGITS + UPPER + LOWER, DIGITS + UPPER + LOWER + "+/-_")
HEX_ENCODINGS = 2
#: Lengths at which a new class of the false-discovery control begins.
LENGTH_CLASSES = (20, 24, 32, 48, 80, 160)
#: Letters of ordinary text in per mille; with some capitals, digits and signs they count as PRIOR_CHARS characters of the corpus, so that a tiny one has shares too.
LETTERS = dict(zip(LOWER, (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1), strict=True))
PRIOR_CHARS = 2000
#: A run without digits needs so many letters of either case.
LEAST_OF_CASE = 3
LEAST_RANDOM_P = 1e-3
FALSE_DISCOVERIES = 0.05
#: Bins of the normal score of p, so many a unit.
BINS, A_UNIT = 600, 50

SPAN = "struct<start:long,kind:int,end:long>"
#: pairs: equal characters, pair by pair; -1 where a test rejects randomness. letters: counts of a to z in either case.
#: covered: by base spans, whole. chars: counts of a whole batch, in its first row.
FOUND = f"base array<{SPAN}>, runs array<struct<start:long,end:long,cls:int,enc:int,n:int,pairs:long,letters:array<int>,covered:boolean>>, chars array<long>"


def _upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(run: str) -> tuple[float, int, int, int, list[int]] | None:
    """p that a random string is this odd (three tests, Bonferroni), encoding, length, pairs of equal characters and letters; None: not a candidate.

    Runs without a letter are numbers, those without a digit and of one case are words; neither are candidates.
    """
    body = run.rstrip("=")
    chars = set(body)
    if not chars - set(DIGITS):
        return None
    if not chars & set(DIGITS) and min(sum(map(str.islower, body)), sum(map(str.isupper, body))) < LEAST_OF_CASE:
        return None
    enc = next(i for i, a in enumerate(ENCODINGS) if chars <= set(a))
    alphabet = ENCODINGS[enc]
    n, size = len(body), len(alphabet)
    codes = np.fromiter(map(alphabet.index, body), float, n)
    counts = np.bincount(codes.astype(int), minlength=size)
    chi = float(((counts - n / size) ** 2).sum() * size / n)
    odd = [_upper((chi - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n))]
    high = codes >= size / 2
    up = int(high.sum())
    if 0 < up < n:
        mean = 2 * up * (n - up) / n + 1
        sd = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        odd.append(2 * _upper(abs(1 + int((high[1:] != high[:-1]).sum()) - mean) / sd))
    if codes.std() > 0:
        middle = codes - codes.mean()
        odd.append(2 * _upper(abs(float((middle[1:] * middle[:-1]).sum() / (middle**2).sum())) * math.sqrt(n)))
    letters = list(map(body.lower().count, LOWER))
    return min(1.0, len(odd) * min(odd)), enc, n, int((counts * (counts - 1)).sum()) // 2, letters


def _gaps(start: int, end: int, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The parts of start to end outside spans (start, kind, end)."""
    out = []
    for a, _, b in sorted(spans):
        if start < min(a, end):
            out.append((start, min(a, end)))
        start = max(start, b)
    return [*out, (start, end)] if start < end else out


def scan_text(text: str | None) -> tuple[list, list]:
    """Base spans (start, kind, end), and the battery's candidates (start, end, length class, encoding, length, pairs, letters, covered).

    Candidates are the runs, and long parts of runs that base spans leave over.
    """
    if not text:
        return [], []
    assigned, base, runs, first = [], [], [], 0
    if ":" in text or "=" in text:
        assigned = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    for run in RUN.finditer(text):
        own = [(run.start() + m.start(), k, run.start() + m.end()) for k, p in ((1, ACCESS), (2, HEX)) for m in p.finditer(run[0])]
        base += own
        while first < len(assigned) and assigned[first][2] <= run.start():
            first += 1
        over = first
        while over < len(assigned) and assigned[over][0] < run.end():
            over += 1
        gaps = _gaps(run.start(), run.end(), own + assigned[first:over])
        for a, b in dict.fromkeys([run.span(), *[g for g in gaps if g[1] - g[0] >= LENGTH_CLASSES[0]]]):
            if p := battery(text[a:b]):
                cls = sum(b - a >= least for least in LENGTH_CLASSES) - 1
                runs.append((a, b, cls, p[1], p[2], p[3] if p[0] >= LEAST_RANDOM_P else -1, p[4], not gaps))
    return sorted(assigned + base), runs


def _counted(texts: pd.Series) -> list[int]:
    """How often each character of the widest encoding is in texts, outside runs."""
    counts = np.zeros(256, np.int64)
    for t in texts:
        if t:
            counts += np.bincount(np.frombuffer(RUN.sub(" ", t).encode("ascii", "ignore"), np.uint8), minlength=256)
    return counts[[ord(c) for c in ENCODINGS[-1]]].tolist()


def _held(counts: list[int]) -> dict[str, float]:
    """counts by character, with the prior's."""
    prior = {c: 0.94 * LETTERS[c] for c in LOWER} | {c: 0.04 * LETTERS[c.lower()] for c in UPPER} | dict.fromkeys(DIGITS, 1.5) | dict.fromkeys("+/-_", 1.25)
    total = sum(prior.values())
    return {c: n + prior[c] * PRIOR_CHARS / total for c, n in zip(ENCODINGS[-1], counts, strict=True)}


def _pairs_score(r: Column, held: dict[str, float]) -> Column:
    """Normal score of few equal pairs. A gamma distribution with the multinomial's mean and variance is made normal by its cube root."""
    shares = []
    for alphabet in ENCODINGS:
        share = np.array([held[c] for c in alphabet])
        share /= share.sum()
        shares.append((float((share**2).sum()), float((share**3).sum())))
    two, three = (F.get(F.array(*[F.lit(x[i]) for x in shares]), r["enc"]) for i in (0, 1))
    n = r["n"].cast("double")
    mean = n * (n - 1) / 2 * two
    shape = mean * mean / (mean * (1 - two) + n * (n - 1) * (n - 2) * (three - two * two))
    return (1 - 1 / (9 * shape) - F.cbrt((r["pairs"] + 0.5) / mean)) * 3 * F.sqrt(shape)


def _letters_score(r: Column, held: dict[str, float]) -> Column:
    """Normal score of rare letters: the sum of their negative log shares, as a shifted gamma with its three moments."""
    share = np.array([held[c] + held[c.upper()] for c in LOWER])
    share /= share.sum()
    rare = -np.log(share)
    mean = float(share @ rare)
    var, third = (float(share @ (rare - mean) ** k) for k in (2, 3))
    total = F.aggregate(F.zip_with(r["letters"], F.array(*[F.lit(float(x)) for x in rare]), lambda n, x: n * x), F.lit(0.0), lambda a, x: a + x)
    m = F.aggregate(r["letters"], F.lit(0), lambda a, x: a + x).cast("double")
    skew = max(third / var**1.5, 1e-3) / F.sqrt(m)
    z = (total - m * mean) / F.sqrt(m * var)
    return 6 / skew * (F.cbrt(F.greatest(F.lit(0.0), 1 + skew * z / 2)) - 1) + skew / 6


def _binned(r: Column, held: dict[str, float]) -> Column:
    """The bin of a run's score against ordinary text; 0 where a test rejects randomness."""
    score = F.when(r["enc"] < HEX_ENCODINGS, _pairs_score(r, held)).otherwise(_letters_score(r, held))
    return F.when(r["pairs"] < 0, 0).otherwise(F.least(F.lit(BINS), F.greatest(F.lit(0), F.floor(score * A_UNIT)))).cast("int")


def _thresholds(runs: DataFrame) -> dict[int, int]:
    """Length class -> the least bin that Benjamini-Hochberg keeps."""
    counts = np.zeros((len(LENGTH_CLASSES), BINS + 1))
    for r in runs.groupBy("cls", "bin").count().collect():
        counts[r["cls"], r["bin"]] = r["count"]
    kept = {}
    for cls, row in enumerate(counts):
        above = row[::-1].cumsum()[::-1]
        good = [k for k in range(1, BINS + 1) if above[k] and row.sum() * _upper(k / A_UNIT) <= FALSE_DISCOVERIES * above[k]]
        kept[cls] = min(good, default=BINS + 1)
    return kept


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def _floors(found: DataFrame) -> tuple[Column, dict[str, float]]:
    """From all rows' column found: the least bin kept, by length class, and the corpus' characters."""
    chars = dict(found.select(F.posexplode("found.chars").alias("i", "n")).groupBy("i").agg(F.sum("n")).collect())
    held = _held([chars.get(i, 0) for i in range(len(ENCODINGS[-1]))])
    least = _thresholds(found.select(F.explode("found.runs").alias("r")).select("r.cls", _binned(F.col("r"), held).alias("bin")))
    return F.array(*[F.lit(least[c]) for c in range(len(LENGTH_CLASSES))]), held


def _scanned(text: str) -> Column:
    @F.pandas_udf(FOUND)
    def scanned(texts: pd.Series) -> pd.DataFrame:
        rows = [(*scan_text(t), None if i else _counted(texts)) for i, t in enumerate(texts)]
        return pd.DataFrame(rows, columns=["base", "runs", "chars"])

    return scanned(F.col(f"`{text}`"))


def _all_spans(found: str, floors: Column, held: dict[str, float]) -> Column:
    random = F.filter(F.col(found)["runs"], lambda r: (_binned(r, held) >= F.get(floors, r["cls"])) & ~r["covered"])
    random = F.transform(random, lambda r: F.struct(r["start"].alias("start"), F.lit(3).alias("kind"), r["end"].alias("end")))
    return F.array_sort(F.concat(F.col(found)["base"], random))


def find_spans(docs: DataFrame, text: str = "text", base: str = "base_spans", spans: str = "all_spans", keep: list[str] | None = None) -> DataFrame:
    """The columns of docs (or those in keep), with arrays of (start, kind, end): the base patterns' spans, and those with the battery's.

    Offsets are code points, end exclusive, sorted by start, then kind. Null and empty texts have none. Spans of the
    battery that base spans cover whole are left out; others may overlap them. These columns are written to the shared folder once.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in (base, spans)]
    columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]
    rows = saved(docs.select(*columns, _scanned(text).alias("found")))
    columns = [F.col(f"c{i}").alias(c) for i, c in enumerate(kept)]
    return rows.select(*columns, F.col("found.base").alias(base), _all_spans("found", *_floors(rows)).alias(spans))


def redacted(docs: DataFrame, text: str = "text", n_chars: str | None = None, mask: str = "[SECRET]") -> DataFrame:
    """docs with mask in place of every span that find_spans() gives, and the texts' new lengths in n_chars if named.

    All rows stay; null and empty texts and those without spans do not change. Texts are scanned in two passes, for the
    corpus' figures and for the rows, so that none is written in between.
    """
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    figures = scratch.save(docs.select(_scanned(text).alias("found")), "figures")
    floors, held = _floors(figures)
    scratch.drop("figures")
    found, spans = unused(docs, "found"), unused(docs, "spans")
    rows = docs.select("*", _scanned(text).alias(found)).withColumn(spans, _all_spans(found, floors, held))
    changed = F.size(spans) > 0
    new = {text: redact(f"`{text}`", spans, mask)}
    if n_chars is not None:
        new[n_chars] = F.when(changed, F.char_length(new[text]).cast("long")).otherwise(F.col(f"`{n_chars}`"))
    return rows.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def redact(text: str, spans: str, mask: str = "[SECRET]") -> Column:
    """text with each span of the array column replaced by mask; overlapping spans are replaced once."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    taken = F.aggregate(
        F.col(spans),
        start,
        lambda a, s: F.struct(
            F.when(s["start"] >= a["at"], F.concat(a["out"], F.substring(text, a["at"].cast("int") + 1, (s["start"] - a["at"]).cast("int")), F.lit(mask))).otherwise(a["out"]).alias("out"),
            F.greatest(a["at"], s["end"]).alias("at"),
        ),
        lambda a: F.concat(a["out"], F.substring(text, a["at"].cast("int") + 1, 2147483647)),
    )
    return F.when(F.size(spans) > 0, taken).otherwise(F.col(text))


def secret_scans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_assign, n_access, n_hex (long), base_sha256, spans (string)."""
    found = find_spans(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), keep=["doc_id"])
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(_joined(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"), _joined(F.col("all_spans")).alias("spans"))
