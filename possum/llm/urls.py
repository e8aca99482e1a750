"""Host word segmentation and naive Bayes over URLs (operator 5).

Rules decide the URLs they fit.  For all others a multinomial naive Bayes
model decides, learned from the URLs that a rule decides: its tokens are the
words of the host and of the path.  Names are often words run together, so
each distinct name is cut into words by the Viterbi path under a unigram
model, whose counts come from the visible text of all pages.

Names and words meet by joins (all substrings of distinct names against the
word counts), so neither the vocabulary nor the model is held by one
process; joins whose key may be hot have written sides, so AQE can split it.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule and gets the likelier class; of rules that fit, the longest
(host and path together) wins; words that no decided URL has do not count;
without any decided URL, or at equal odds, the verdict is allow.  Repeated
rows are judged alike and each returned; an empty table gives no rows.  Extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import materialise
from .common import map_rows

# Verdict, host, start of the path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path)."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def by_rules(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))]
    return F.coalesce(*fits)


def word_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(word, n): lower-case letter words of the visible text of all pages."""
    visible = F.regexp_replace(F.coalesce(F.col(html_col), F.lit("")),
                               r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    words = F.explode(F.split(F.lower(visible), "[^a-z]+")).alias("word")
    return (pages.select(words).where(F.length("word") > 0)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def viterbi(name: str, pieces: list[tuple[int, int, float]], unknown: float) -> list[str]:
    """The likeliest cut of ``name``; (start, length, log probability) of its known
    words.  A character in no word costs ``unknown``; runs of them are one word."""
    ends: dict[int, list[tuple[int, float]]] = {}
    for start, length, logp in pieces:
        ends.setdefault(start + length, []).append((start, logp))
    best, back = [0.0] + [-math.inf] * len(name), [0] * (len(name) + 1)
    known = [True] * (len(name) + 1)
    for end in range(1, len(name) + 1):
        best[end], back[end], known[end] = best[end - 1] + unknown, end - 1, False
        for start, logp in ends.get(end, ()):
            if best[start] + logp > best[end]:
                best[end], back[end], known[end] = best[start] + logp, start, True
    words, end = [], len(name)
    while end:
        start = back[end]
        while not known[end] and start and not known[start]:
            start = back[start]
        words.append(name[start:end])
        end = start
    return words[::-1]


def segmented(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) for distinct ``names``."""
    counts = materialise(counts)
    total = counts.agg(F.sum("n")).first()[0] or 1
    unknown = -math.log(total) - math.log(10.0)
    size = F.length("name")
    # Only substrings as long as some word; n characters of words have fewer
    # than sqrt(2 n) different lengths.
    lengths = [r["size"] for r in counts.select(F.length("word").alias("size")).distinct()
               .orderBy("size").collect()]
    fits = F.filter(F.array(*[F.lit(k) for k in lengths]).cast("array<int>"),
                    lambda k: k <= size - F.col("start"))
    pieces = (names.select("name", F.explode(F.sequence(F.lit(0), size - 1)).alias("start"))
              .select("name", "start", F.explode(fits).alias("length"))
              .withColumn("word", F.expr("substring(name, start + 1, length)")))
    pieces = materialise(pieces.join(counts.hint("merge"), "word").select(
        "name", F.struct("start", "length", F.log(F.col("n") / F.lit(float(total))).alias("logp"))
        .alias("piece")))
    # At most one piece per character of a name and word length.
    grouped = names.join(pieces.groupBy("name").agg(F.collect_list("piece").alias("pieces")),
                         "name", "left")

    def rows(batch: list[dict]) -> Iterator[tuple]:
        for d in batch:
            pieces = [(p["start"], p["length"], p["logp"]) for p in d["pieces"] or ()]
            yield d["name"], viterbi(d["name"], pieces, unknown)

    return materialise(map_rows(grouped, "name string, words array<string>", rows))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
          url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, p_block, host_words."""
    host, path = split_url(F.col(url_col))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"),
                        path.alias("path"), F.monotonically_increasing_id().alias("row"))
    base = materialise(base.withColumn("fit", by_rules(F.col("host"), F.col("path"), rules)))

    def names_of(col: str, side: str) -> Column:
        # Numbers stand apart from letters, and for their length.
        apart = F.regexp_replace(F.lower(col), "[0-9]+", " # ")
        found = F.filter(F.split(apart, "[^a-z#]+"), lambda x: x != "")
        return F.transform(found, lambda x: F.struct(F.lit(side).alias("side"), x.alias("name")))

    names = base.select("row", "host", F.col("fit.verdict").alias("known"), F.explode(
        F.concat(names_of("host", "h:"), names_of("path", "p:"))).alias("t")).select(
        "row", "known", "t.side", "t.name")
    letters = materialise(names.select("name").where(F.col("name").rlike("^[a-z]+$")).distinct())
    cut = segmented(letters, word_counts(pages, html_col))
    words = materialise(
        names.join(cut.hint("merge"), "name", "left")
        .select("row", "known", "side", F.explode(F.coalesce("words", F.array("name"))).alias("w"))
        .select("row", "known", F.concat("side", "w").alias("word")))
    learned = words.where(F.col("known").isNotNull()).groupBy("word").agg(
        F.count_if(F.col("known") == "block").alias("block"),
        F.count_if(F.col("known") == "allow").alias("allow"))
    learned = materialise(learned)
    sums = learned.agg(F.coalesce(F.sum("block"), F.lit(0)), F.coalesce(F.sum("allow"), F.lit(0)),
                       F.count(F.lit(1))).first()
    rows = {r["v"]: r["count"] for r in base.groupBy(F.col("fit.verdict").alias("v")).count().collect()}
    prior = math.log((rows.get("block", 0) + 1) / (rows.get("allow", 0) + 1))
    weight = (F.log((F.col("block") + 1) / F.lit(float(sums[0] + sums[2] + 1)))
              - F.log((F.col("allow") + 1) / F.lit(float(sums[1] + sums[2] + 1))))
    weights = materialise(learned.select("word", weight.alias("weight")))
    odds = (words.join(weights.hint("merge"), "word")
            .groupBy("row").agg(F.sum("weight").alias("odds")))
    split = names.where("side = 'h:'").join(cut.hint("merge"), "name", "left").select(
        "row", F.coalesce("words", F.array("name")).alias("words"))
    host_words = split.groupBy("row").agg(
        F.array_join(F.sort_array(F.flatten(F.collect_list("words"))), " ").alias("host_words"))
    z = F.round(F.coalesce("odds", F.lit(0.0)) + F.lit(prior), 9)
    out = base.join(odds, "row", "left").join(host_words, "row", "left")
    learned_any = bool(rows.get("block") or rows.get("allow"))
    method = F.when(F.lit(learned_any) & (z > 0), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                      F.coalesce("fit.verdict", method).alias("verdict"),
                      (1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(500.0)), F.lit(-500.0)))))
                      .alias("p_block"),
                      F.coalesce("host_words", F.lit("")).alias("host_words"))
