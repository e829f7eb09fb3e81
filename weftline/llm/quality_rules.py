"""Host-level quality rules: rule failures by host, shrunk by an empirical beta prior, joined back to documents.

Only DataFrame functions: every per-document figure is an array expression inside one row, so texts are never
shuffled; hosts are aggregated with map-side partial sums, and only (id, host, figures) meets the host verdicts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import SPACE_CLASS, saved

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
#: A host fails a rule where its shrunk failure rate is above this.
MAX_HOST_RATE = 0.5
#: Rule name -> condition over the figures of text_figures().
RULES = {
    "short": "n_words < 20",
    "repetitive": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
}
#: Up to so many hosts their verdicts are broadcast; beyond, Spark's skew-splitting sort-merge join is used.
BROADCAST_HOSTS = 50_000


def _joined(hashes: str, step: int) -> Column:
    """A hash of each element with the one step places on; the last ones, which have none, go."""
    n = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, step + 1, n), lambda a, b: F.xxhash64(a, b))


def text_figures(docs: DataFrame, text: str, keep: dict[str, Column]) -> DataFrame:
    """keep's columns and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of each text (long).

    Null and empty texts give zeros. A word in several repeated windows counts once.
    """
    words = F.array_remove(F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), SPACE_CLASS), "")
    lines = F.filter(F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.select(
        *[c.alias(k) for k, c in keep.items()],
        words.alias("_w"),
        lines.alias("_l"),
        F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    # An array that a later lambda reads is also read outside it: Spark then computes it once per row, not per element.
    out = out.select(
        *keep,
        "n_symbols",
        F.size("_w").cast("long").alias("n_words"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.aggregate("_w", F.lit(0).cast("long"), lambda a, w: a + F.char_length(w)).alias("word_chars"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
    )
    figures = [*keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    # Hashes of 2, 4, then 8 neighbouring words; a text whose 4-word windows all differ has no repeated 8-word window.
    out = out.select(*figures, F.when(F.size("_h") > WINDOW, _joined("_h", 1)).alias("_g"))
    out = out.select(*figures, _joined("_g", 2).alias("_g"))
    out = out.select(*figures, F.when(F.size(F.array_distinct("_g")) < F.size("_g"), _joined("_g", 4)).alias("_g"))
    pairs = F.when(
        F.size(F.array_distinct("_g")) < F.size("_g"),
        F.array_sort(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
    )
    out = out.select(*figures, pairs.alias("_p"))
    twice = F.filter(
        "_p", lambda x, i: F.coalesce(F.get("_p", i - 1)["g"] == x["g"], F.lit(False)) | F.coalesce(F.get("_p", i + 1)["g"] == x["g"], F.lit(False))
    )
    out = out.select(*figures, F.array_sort(F.transform(twice, lambda x: x["i"])).alias("_s"))
    covered = F.aggregate(
        F.transform("_s", lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_s", i + 1) - s, F.lit(WINDOW)))),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    return out.select(*figures, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def host_verdicts(figures: DataFrame, host: str, max_rate: float = MAX_HOST_RATE) -> tuple[DataFrame, int]:
    """One row per host: n_docs, shrunk_<rule> in 0..1 and host_ok; and the number of hosts.

    Each rule's beta prior is fitted by moments over all hosts: its mean is the pooled failure rate, its strength
    follows from how much more the hosts' rates vary than sampling alone explains. Small hosts thus lean on the pool.
    """
    hosts = saved(figures.groupBy(F.col(host).alias("_host")).agg(F.count("*").alias("n_docs"), *[F.sum(F.when(F.expr(c), 1).otherwise(0)).alias(f"f_{r}") for r, c in RULES.items()]))
    total = hosts.agg(F.count("*").alias("hosts"), F.sum("n_docs").alias("n"), *[F.sum(f"f_{r}").alias(r) for r in RULES]).first()
    if not total["n"]:
        return hosts.select("_host", "n_docs", *[F.lit(0.0).alias(f"shrunk_{r}") for r in RULES], F.lit(True).alias("host_ok")), 0
    means = {r: total[r] / total["n"] for r in RULES}
    spread = hosts.agg(*[F.sum(F.col("n_docs") * F.pow(F.col(f"f_{r}") / F.col("n_docs") - m, 2)).alias(r) for r, m in means.items()]).first()
    shrunk = []
    for r, m in means.items():
        between = max(spread[r] / total["n"] - m * (1 - m) * total["hosts"] / total["n"], 1e-9)
        strength = min(max(m * (1 - m) / between - 1, 1.0), 1e6)
        shrunk.append(((F.col(f"f_{r}") + F.lit(m * strength)) / (F.col("n_docs") + F.lit(strength))).alias(f"shrunk_{r}"))
    rated = hosts.select("_host", "n_docs", *shrunk)
    return rated.withColumn("host_ok", F.greatest(*[F.col(f"shrunk_{r}") for r in RULES]) <= max_rate), total["hosts"]


def _keyed(docs: DataFrame, host: str, keep: dict[str, Column]) -> dict[str, Column]:
    return keep | {"_host": F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("\u0000none"))}


def _judged(figures: DataFrame, hosts: DataFrame, n_hosts: int) -> DataFrame:
    """figures with host_ok, base_failed and kept."""
    hosts = hosts.select("_host", "host_ok")
    joined = figures.join(F.broadcast(hosts) if n_hosts <= BROADCAST_HOSTS else hosts, "_host", "left")
    base = F.expr(f"({RULES['short']}) or ({RULES['repetitive']})")
    return joined.withColumns({"base_failed": base, "kept": ~base & F.col("host_ok")})


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, kept.

    base_failed: under 20 words, or over 30 % of the words lie in repeated 8-word windows. kept: not base_failed, and
    the host passes all RULES. A null host is a host of its own; null or empty texts fail; an empty table gives an
    empty result; repeated rows and ids come back as often as they came in. Columns of docs with other names, however
    they clash, are not read.
    """
    figures = saved(text_figures(docs, text, _keyed(docs, host, {"_id": F.col(f"`{doc_id}`")})))
    judged = _judged(figures, *host_verdicts(figures, "_host", max_rate))
    return judged.select(F.col("_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep_passing(docs: DataFrame, text: str = "text", host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of docs that quality_rules() keeps, with docs' columns, whatever their names.

    Figures are computed in two passes, for the hosts and for the rows, so that no text is written in between.
    """
    hosts, n_hosts = host_verdicts(text_figures(docs, text, _keyed(docs, host, {})), "_host", max_rate)
    rows = {f"_c{i}": F.col(f"`{c}`") for i, c in enumerate(docs.columns)}
    # A filter is not moved below a column of row numbers; below, Spark would repeat the figures' expressions in it.
    figures = text_figures(docs, text, _keyed(docs, host, rows)).withColumn("_row", F.monotonically_increasing_id())
    return _judged(figures, hosts, n_hosts).where("kept and _row >= 0").select(*[F.col(k).alias(c) for k, c in zip(rows, docs.columns, strict=True)])
