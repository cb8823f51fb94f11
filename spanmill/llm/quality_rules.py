"""Quality rules whose cutoffs are certified on labelled documents.

Every rule rejects a document whose signal is above a cutoff. The candidate cutoffs are fixed
beforehand, and for each stratum (language) labelled good documents tell how many of them a
cutoff would reject. A cutoff may be used only if the exact binomial tail shows, at a level
corrected for all strata and rules, that it rejects at most ``risk`` of the good documents. A
rule's candidates are tested from the loosest on up to the first that fails, so they need no
correction among themselves. Among the certified cutoffs the one that finds most bad documents
is taken, each good document lost counting as several; a rule that finds too few is left out.

A stratum with too few good documents to certify anything is served by the cutoffs certified
on all strata together, but for those that lose too many of its own labelled documents.

Everything is DataFrame functions: word windows are compared inside a row, so no text is
shuffled, and what the calibration gathers are counts per stratum, rule and candidate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import solid, written

SPACE, WORD_CHAR = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
#: Words of a window that counts as repeated when the text has it twice.
WINDOW = 8
#: Base rule: fewer words fail, and a larger percentage of words in repeated windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: Candidate cutoffs of every rule; a share is above its cutoff if strictly greater.
CUTOFFS = [0.01, 0.02, 0.03, 0.05, 0.08, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.8]
#: Share of good documents that one rule may reject in a stratum, and the chance that any
#: cutoff of any rule and stratum is certified wrongly.
RISK, ERROR = 0.004, 0.05
#: Bad documents that must be found for each good one lost.
WORTH = 5
RULES = ["symbol_share", "dup_line_share", "repeat_share", "caps_share", "digit_share"]


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def with_signals(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of the base rule and the shares of RULES (null text: no words).

    New columns: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed boolean, and one double for each of RULES. Windows are compared by a 64-bit
    hash of their words."""
    keep = docs.columns
    d = docs.withColumn("_t", F.coalesce(F.col(text), F.lit("")))
    d = d.withColumn("_w", solid(F.filter(F.split("_t", f"{SPACE}+"), lambda w: w != "")))
    d = d.withColumn("_l", solid(F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD_CHAR))))
    d = d.withColumn("_h", solid(F.transform("_w", lambda w: F.xxhash64(w))))
    for step in (1, 2, 4):  # hashes of 2, 4 and at last 8 words
        ahead = F.slice("_h", step + 1, F.greatest(F.size("_h"), F.lit(1)))
        d = d.withColumn("_h", solid(F.zip_with("_h", ahead, lambda a, b: F.xxhash64(a, b))))
    d = d.withColumn("_h", solid(F.slice("_h", 1, F.greatest(F.size("_h") - (WINDOW - 1), F.lit(0)))))
    twice = F.size(F.array_distinct("_h")) < F.size("_h")
    d = d.withColumn("_s", solid(F.when(twice, F.sort_array(F.transform(
        "_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))))

    def beside(x, j):  # whether the j-th of the sorted windows is the same as x
        return F.coalesce(x["h"] == F.get("_s", j)["h"], F.lit(False))

    d = d.withColumn("_p", solid(F.sort_array(F.transform(
        F.filter("_s", lambda x, i: beside(x, i - 1) | beside(x, i + 1)), lambda x: x["i"]))))
    gaps = F.zip_with("_p", F.slice("_p", 2, F.greatest(F.size("_p"), F.lit(1))),
                      lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(0), lambda s, x: s + x)
    long = lambda c: c.cast("long")
    d = d.select(
        *keep, long(F.size("_w")).alias("n_words"),
        long(F.length(F.array_join("_w", ""))).alias("word_chars"),
        long(F.regexp_count("_t", F.lit("[#*$%&|<>]"))).alias("n_symbols"),
        long(F.size("_l") - F.size(F.array_distinct("_l"))).alias("n_dup_lines"),
        long(F.coalesce(F.when(F.col("_p").isNotNull(), covered), F.lit(0))).alias("n_repeat_words"),
        F.size("_l").alias("_n_lines"),
        F.regexp_count("_t", F.lit("[A-Z]")).alias("_caps"),
        F.regexp_count("_t", F.lit("[0-9]")).alias("_digits"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return d.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        _share(F.col("n_symbols"), F.col("word_chars")).alias("symbol_share"),
        _share(F.col("n_dup_lines"), F.col("_n_lines")).alias("dup_line_share"),
        _share(F.col("n_repeat_words"), F.col("n_words")).alias("repeat_share"),
        _share(F.col("_caps"), F.col("word_chars")).alias("caps_share"),
        _share(F.col("_digits"), F.col("word_chars")).alias("digit_share"))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), exact up to rounding, for k < n * p.

    The largest term is taken through logarithms, the smaller ones relative to it."""
    up = F.sequence(F.lit(1), F.greatest(k, F.lit(1)).cast("int"))
    ln_choose = F.when(k > 0, F.aggregate(
        up, F.lit(0.0), lambda s, i: s + F.log((n - k + i) / i))).otherwise(F.lit(0.0))
    top = ln_choose + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    zero = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(s, j):  # from the term of i + 1 hits down to the one of i, i = k - j
        i = k - j + 1
        term = s["term"] * i * (1 - p) / ((n - i + 1) * p)
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

    rest = F.when(k > 0, F.aggregate(up, zero, step)["sum"]).otherwise(F.lit(1.0))
    return F.exp(top + F.log(rest))


def _losses(labelled: DataFrame) -> DataFrame:
    """labelled (stratum, good boolean, base_failed, RULES) -> stratum, rule, j (from 1), n, lost,
    found: its good documents, and how many good and bad ones are above the j-th cutoff.

    Documents that the base rule rejects do not count: a cutoff neither loses nor finds them."""
    grid = F.array(*[F.lit(c) for c in CUTOFFS])

    def passed(rule: str) -> Column:
        return F.size(F.filter(grid, lambda c: c < F.col(rule))).alias("passed")

    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), passed(r)) for r in RULES]))
    counts = (labelled.where(~F.col("base_failed")).select("stratum", "good", each.alias("x"))
              .groupBy("stratum", "x.rule", "x.passed")
              .agg(F.sum(F.col("good").cast("long")).alias("good"),
                   F.sum((~F.col("good")).cast("long")).alias("bad")))
    # a document that passes j cutoffs is above the first j of them; counts has few rows
    above = Window.partitionBy("stratum", "rule").orderBy(F.desc("j"))
    whole = Window.partitionBy("stratum", "rule")
    steps = F.explode(F.sequence(F.lit(0), F.lit(len(CUTOFFS)))).alias("j")
    full = (counts.select("stratum", "rule").distinct().select("stratum", "rule", steps)
            .join(counts.withColumnRenamed("passed", "j"), ["stratum", "rule", "j"], "left")
            .na.fill(0, ["good", "bad"]))
    summed = full.select(
        "stratum", "rule", "j", F.sum("good").over(whole).alias("n"),
        F.sum("good").over(above).alias("lost"), F.sum("bad").over(above).alias("found"))
    return summed.where("j > 0")


def _certified(losses: DataFrame, tests: Column, risk: float, error: float) -> DataFrame:
    """The cutoff taken for each stratum and rule of losses, tests sequences being tested.

    A tighter cutoff loses at least as many, so its tail is no smaller: those that pass the
    level are the ones in front of the first that fails."""
    sure = binomial_tail(F.col("lost"), F.col("n"), risk) <= error / tests
    gain = F.col("found") - WORTH * F.col("lost")
    best = F.max(F.struct(gain.alias("gain"), "j", "n", "lost", "found"))
    return (losses.where(F.when(F.col("lost") < F.col("n") * risk, sure).otherwise(F.lit(False)))
            .groupBy("stratum", "rule").agg(best.alias("b")).where("b.gain > 0")
            .select("stratum", "rule", "b.j", F.col("b.n").alias("good"),
                    F.col("b.lost").alias("good_lost"), F.col("b.found").alias("bad_found")))


def _cutoff(j: Column) -> Column:
    return F.get(F.array(*[F.lit(c) for c in CUTOFFS]), j - 1).alias("cutoff")


def certified_cutoffs(labelled: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """labelled (stratum, good boolean, base_failed, RULES) -> (stratum, rule, cutoff, good,
    good_lost, bad_found): the cutoff taken for each stratum and rule that has one of its own."""
    losses = _losses(labelled)
    tests = losses.agg(F.countDistinct("stratum")).scalar() * len(RULES)
    return _certified(losses, tests, risk, error).select(
        "stratum", "rule", _cutoff(F.col("j")), "good", "good_lost", "bad_found")


def served_cutoffs(labelled: DataFrame, strata: DataFrame, risk: float = RISK,
                   error: float = ERROR) -> DataFrame:
    """labelled as before, strata (stratum): all that are to be judged -> stratum, rule, cutoff.

    A stratum whose good documents could certify a cutoff has its own cutoffs or none. The
    others, also those without any label, take the ones certified on all labelled documents
    together, which count as one more stratum in the correction; a cutoff that loses more than
    ``risk`` of a stratum's own good documents is not taken there."""
    losses = written(_losses(labelled))  # a few hundred rows
    tests = (losses.agg(F.countDistinct("stratum")).scalar() + 1) * len(RULES)
    own = _certified(losses, tests, risk, error).select("stratum", "rule", "j")
    pooled = _certified(
        losses.groupBy(F.lit("").alias("stratum"), "rule", "j")
        .agg(*[F.sum(c).alias(c) for c in ("n", "lost", "found")]), tests, risk, error)
    rules = F.explode(F.array(*[F.lit(r) for r in RULES])).alias("rule")
    few = F.pow(F.lit(1 - risk), F.col("n")) > error / tests
    lent = (strata.select("stratum", rules).join(pooled.select("rule", "j"), "rule")
            .join(losses.select("stratum", "rule", "j", "n", "lost"), ["stratum", "rule", "j"], "left")
            .na.fill(0, ["n", "lost"])
            .where(few & (F.col("lost") <= F.col("n") * risk)).select("stratum", "rule", "j"))
    return own.unionByName(lent).select("stratum", "rule", _cutoff(F.col("j")))


#: Languages up to which every task gets the cutoffs, a row each.
SHARED_STRATA = 10_000


def _cuts(signals: DataFrame, labels: DataFrame) -> DataFrame:
    """signals (doc_id, lang, base_failed, RULES; a written table) and labels -> a written table
    with a row per language that has a cutoff: stratum, and each rule's cutoff."""
    signals = signals.withColumn("stratum", F.coalesce("lang", F.lit("")))
    marks = (labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("_id"))
             .agg((F.min("quality") > 0).alias("good")))
    labelled = signals.select(F.col("doc_id").alias("_id"), "stratum", "base_failed", *RULES).join(
        marks, "_id")
    strata = signals.select("stratum").distinct()
    return written(served_cutoffs(labelled, strata).groupBy("stratum").agg(*[
        F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"{r}_cutoff") for r in RULES]))


def _with_kept(signals: DataFrame, cuts: DataFrame, lang: Column) -> DataFrame:
    """Add kept and the cutoffs. Few cutoffs go to every task, so that no row is shuffled."""
    if cuts.limit(SHARED_STRATA + 1).count() <= SHARED_STRATA:
        cuts = F.broadcast(cuts)
    over = F.lit(False)
    for r in RULES:
        over = over | F.coalesce(F.col(r) > F.col(f"{r}_cutoff"), F.lit(False))
    return (signals.withColumn("stratum", F.coalesce(lang, F.lit(""))).join(cuts, "stratum", "left")
            .withColumn("kept", ~(F.col("base_failed") | over)).drop("stratum"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs (doc_id, text, lang, any others) and labels (doc_id, quality 0/1) -> one row per
    row of docs: doc_id, the counts and shares, base_failed, kept, and each rule's cutoff.

    Null and empty texts have no words and fail the base rule; a null language is a stratum of
    its own. A document with several labels counts as bad if any is 0; labels without a
    document, null labels and empty tables change nothing: without certified cutoffs the base
    rule decides alone. Repeated rows are judged alike."""
    narrow = written(with_signals(docs.select("doc_id", "lang", "text")).drop("text"))
    return _with_kept(narrow, _cuts(narrow, labels), F.col("lang")).drop("lang")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that judge() keeps, with all their columns.

    Only signals are written for the cutoffs; the documents are then read once more and pass
    in one stage, without being written or shuffled here."""
    narrow = written(with_signals(docs.select("doc_id", "lang", "text")).drop("text"))
    cuts = _cuts(narrow, labels)
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    rows = with_signals(packed, "doc.text")
    return _with_kept(rows, cuts, F.col("doc.lang")).where("kept").select("doc.*")
