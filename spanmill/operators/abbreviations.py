"""Which dots end no sentence, learned from the texts themselves.

The statistics are those of unsupervised boundary detection by log-likelihood ratios (Kiss and
Strunk, 2006). A word is an abbreviation if a dot follows it far more often than chance, the more
so the shorter it is and the more dots it has inside, the less so the more often it stands without.
A dot after a number ends no sentence in front of a word that follows numbers with dots more often
than chance (a month, say), unless the word is one that begins sentences.

All counts are sums over tokens, so partial ones add up; texts are read once for both tables and
only counts are shuffled. What is learned goes into the boundary pattern of
``with_sentences`` (functions/sentences.py), the MOST best entries of each kind."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WS
from ..session import cut_lineage
from .ranking import scalar

#: Scores from which a word is an abbreviation, a follower of numbers, and a sentence starter.
ABBREVIATION, FOLLOWER, STARTER = 0.3, 7.88, 30.0
#: Assumed share of an abbreviation's occurrences that have a dot.
DOTTED = 0.99
MOST = 2000
NUMBER = "##"
NUMBER_RE = r"^\p{N}+([.,]\p{N}+)*$"


@dataclass(frozen=True)
class Learned:
    """Entries for ``with_sentences``: abbreviations without their last dot, and words in front of
    which a dot after a number ends no sentence."""
    abbreviations: tuple[str, ...] = ()
    followers: tuple[str, ...] = ()


def _trimmed(word: Column) -> Column:
    """A word without the marks around it, except dots behind it."""
    return F.regexp_replace(F.regexp_replace(word, r"^[^\p{L}\p{N}]+", ""), r"[^\p{L}\p{N}.]+$", "")


def _kind(c: str) -> Column:
    return F.regexp_replace(F.lower(c), r"\.+$", "")


def _dotted(c: str) -> Column:
    return F.col(c).rlike(r"[^.]\.$")


def _raw_counts(texts: DataFrame, text: str) -> DataFrame:
    """t (a white-space separated token with a letter or digit, as it stands), after (0; 1 behind
    a token with one dot; 2 if that is a number), n. Few tokens have a dot: only those are taken
    apart here, where every token passes."""
    raw = F.filter(F.split(F.col(text), f"{WS}+"), lambda w: w.rlike(r"[\p{L}\p{N}]"))
    d = texts.select(raw.alias("w")).withColumn("w", F.when(F.spark_partition_id() >= 0, F.col("w")))
    each = d.select(F.posexplode("w").alias("i", "t"), F.col("w").alias("all")).select(
        "t", F.get("all", F.col("i") - 1).alias("p"))
    p = _trimmed(F.col("p"))
    dotted = p.rlike(r"[^.]\.$")
    number = F.regexp_replace(F.lower(p), r"\.+$", "").rlike(NUMBER_RE)
    after = F.when(F.col("p").isNull() | ~F.contains("p", F.lit(".")), 0).when(~dotted, 0).when(
        number, 2).otherwise(1)
    return each.groupBy("t", after.alias("after")).agg(F.count(F.lit(1)).alias("n"))


def token_counts(texts: DataFrame, text: str) -> DataFrame:
    """type, n, n_dot, n_after_dot, n_after_number: the sums that all scores are made of. Every
    score takes totals of them besides the rows, so they are kept and the texts read once."""
    d = _raw_counts(texts, text).select(_trimmed(F.col("t")).alias("t"), "after", "n")
    d = d.select(F.when(_kind("t").rlike(NUMBER_RE), F.lit(NUMBER)).otherwise(_kind("t")).alias("type"),
                 _dotted("t").alias("dot"), "after", "n")
    one = lambda c, name: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(name)
    return cut_lineage(d.groupBy("type").agg(
        F.sum("n").alias("n"), one(F.col("dot"), "n_dot"), one(F.col("after") > 0, "n_after_dot"),
        one(F.col("after") == 2, "n_after_number")))


def _likelihood(k: Column, n: Column, p: Column) -> Column:
    """log of p^k (1 - p)^(n - k), for p kept away from 0 and 1."""
    p = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return k * F.log(p) + (n - k) * F.log(1 - p)


def abbreviation_scores(counts: DataFrame) -> DataFrame:
    """token_counts() -> type, n_dot, n_plain, score for the types that have a dot at least once
    and are no numbers."""
    p = scalar(counts, F.sum("n_dot") / F.sum("n"))
    n, k = F.col("n"), F.col("n_dot")
    ratio = 2 * (_likelihood(k, n, F.lit(DOTTED)) - _likelihood(k, n, p))
    inside = F.length("type") - F.length(F.replace("type", F.lit("."), F.lit("")))
    letters = (F.length("type") - inside).cast("double")
    score = ratio * F.exp(-letters) * (inside + 1) * F.pow(letters, -(n - k))
    return counts.where((F.col("type") != NUMBER) & (k > 0)).select(
        "type", "n_dot", (n - k).alias("n_plain"), score.alias("score"))


def _association(both: Column, first: Column, second: Column, total: Column) -> Column:
    """Log-likelihood ratio of two events' independence, negative if they avoid each other."""
    p, p1 = second / total, both / first
    p2 = F.when(total > first, (second - both) / (total - first)).otherwise(F.lit(0.0))
    ratio = -2 * (_likelihood(both, first, p) + _likelihood(second - both, total - first, p)
                  - _likelihood(both, first, p1) - _likelihood(second - both, total - first, p2))
    return F.when(p1 > p, ratio).otherwise(-ratio)


def follower_scores(counts: DataFrame) -> DataFrame:
    """token_counts() -> type, n, n_after_number, n_after_dot, follower, starter: how strongly
    words go with a dotted number before them, and with any other dot before them. Words that
    never follow a dotted number are left out."""
    total, numbers, dots = (scalar(counts, F.sum(c)) for c in ("n", "n_after_number", "n_after_dot"))
    others = F.col("n_after_dot") - F.col("n_after_number")
    return counts.where((F.col("n_after_number") > 0) & (F.col("type") != NUMBER)).select(
        "type", "n", "n_after_number", "n_after_dot",
        _association(F.col("n_after_number"), numbers, F.col("n"), total).alias("follower"),
        F.when(dots > numbers, _association(others, dots - numbers, F.col("n"), total))
        .otherwise(F.lit(0.0)).alias("starter"))


def learn(texts: DataFrame, text: str = "text", most: int = MOST) -> Learned:
    """The entries learned from a column of texts (null ones have no tokens): at most ``most`` of
    each kind, the best by score, ties by the word."""
    counts = token_counts(texts.where(F.col(text).isNotNull()), text)
    short = abbreviation_scores(counts).where(F.col("score") >= ABBREVIATION)
    after = follower_scores(counts).where((F.col("follower") >= FOLLOWER) & (F.col("starter") < STARTER))
    names = lambda d, by: tuple(
        r.type for r in d.orderBy(F.desc(by), "type").limit(most).select("type").collect())
    return Learned(names(short, "score"), names(after, "follower"))
