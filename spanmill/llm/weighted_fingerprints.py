"""Document fingerprints by consistent weighted sampling.

A document is a weighted set: a term is a lower-cased word, its weight the code points that it
takes up in the text. For each of SAMPLES hash functions a term gets r and c from a gamma(2, 1)
distribution and b from a uniform one, all from a hash of the term alone; with its weight w

    t = floor(ln w / r + b),    ln a = ln c - r * (t - b + 1),

and the term of least a, together with its t, is the sample. Two documents have the same sample
with a probability equal to their generalised Jaccard similarity, the sum of the smaller weights
over the sum of the larger ones, so the share of equal samples estimates it.

All of it is column expressions. Documents are dealt out once, by ranges of their ids; the edited
text, the terms, the samples and the comparison with the next document all stay there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import solid, written

#: Samples of a fingerprint; hexadecimal digits of a sample in it.
SAMPLES, DIGITS = 64, 4
#: Quantiles that the gamma variates are drawn from.
QUANTILES = 4096
#: Documents of a range of ids.
RANGE_ROWS = 2000
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def gamma_table(spark: SparkSession) -> DataFrame:
    """One row: r, the middles of QUANTILES equally likely slices of the gamma(2, 1)
    distribution, and ln_r, their logarithms.

    Its distribution function is 1 - (1 + x) exp(-x); Newton's steps on its logarithm."""
    step = "greatest(x + (ln((1 + x) * exp(-x)) - ln(1 - u)) * (1 + x) / x, 1e-9D)"
    r = spark.range(1).select(F.expr(
        f"transform(transform(sequence(0, {QUANTILES} - 1), i -> (i + 0.5D) / {QUANTILES}), "
        f"u -> aggregate(sequence(1, 60), 1.0D, (x, k) -> {step}))").alias("r"))
    return r.select("r", F.transform("r", lambda x: F.log(x)).alias("ln_r"))


def edited(text: Column, n: Column, following: Column) -> Column:
    """text with its last n // 4 code points replaced by the first as many of the next text."""
    cut = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), (n - cut).cast("int")),
                    F.substring(following, F.lit(1), cut))


def terms(text: Column) -> Column:
    """Sorted hashes of a text's lower-cased words; the last 8 bits are a word's length."""
    words = F.filter(F.split(F.lower(text), WORD_SPLIT), lambda w: w != "")
    return F.sort_array(F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(
        F.lit(~255)).bitwiseOR(F.least(F.length(w), F.lit(255)).cast("long"))))


def _samples(spark: SparkSession, term: Column, weight: Column) -> list[Column]:
    """For each hash function a number whose minimum over the terms is the sample: ln a in the
    high bits, a hash of term and t in the low 23."""
    table = gamma_table(spark)
    gammas, logs = table.select("r").scalar(), table.select("ln_r").scalar()
    out = []
    for k in range(SAMPLES):
        h = F.xxhash64(term, F.lit(k))
        r = F.get(gammas, h.bitwiseAND(F.lit(QUANTILES - 1)).cast("int"))
        c = F.get(logs, F.shiftright(h, 12).bitwiseAND(F.lit(QUANTILES - 1)).cast("int"))
        b = F.shiftright(h, 24).bitwiseAND(F.lit((1 << 24) - 1)) / F.lit(float(1 << 24))
        t = F.floor(weight / r + b)
        low = c - r * (t - b + 1)
        high = F.greatest(F.least(low + 300, F.lit(500.0)), F.lit(0.0)) * (1 << 31)
        out.append(F.shiftleft(high.cast("long"), 23).bitwiseOR(
            F.xxhash64(term, t).bitwiseAND(F.lit((1 << 23) - 1))))
    return out


def _ranges(docs: DataFrame) -> Column:
    """The number of each row's range of ids; null ids are in front. Ranges follow the order of
    the ids and have about RANGE_ROWS rows if ids are spread evenly."""
    s = docs.agg(F.count("*").alias("n"), F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).first()
    if s.a is None:
        return F.lit(0).cast("long")
    wide = max(1.0, (float(s.z) - float(s.a) + 1) / max(1, s.n // RANGE_ROWS))
    place = F.floor((F.col("doc_id").cast("double") - float(s.a)) / wide) + 1
    return F.coalesce(place, F.lit(0)).cast("long")


def _next_ranges(rows: DataFrame) -> DataFrame:
    """rows (part) -> part, after: the next range that has rows, the first after the last.

    In two levels, so that one task sees a thousandth of the ranges."""
    parts = rows.select("part").distinct().withColumn("group", F.floor(F.col("part") / 1000))
    inner = Window.partitionBy("group").orderBy("part")
    groups = parts.groupBy("group").agg(F.min("part").alias("first"))
    whole = Window.partitionBy(F.lit(0))
    ahead = groups.select("group", F.coalesce(
        F.lead("first").over(whole.orderBy("group")), F.min("first").over(whole)).alias("jump"))
    return (parts.withColumn("near", F.lead("part").over(inner)).join(ahead, "group")
            .select("part", F.coalesce("near", "jump").alias("after")))


def _with_next(rows: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """rows (part, pos, value ...) with the value of the next row, the first one's after the
    last. Only the first row of a range leaves its task."""
    window = Window.partitionBy("part").orderBy(*order)
    led = rows.withColumn("_lead", F.lead(F.struct(value)).over(window))
    firsts = (rows.withColumn("_rn", F.row_number().over(window)).where("_rn = 1")
              .select(F.col("part").alias("after"), F.struct(F.col(value).alias("_v")).alias("_edge")))
    edges = (_next_ranges(rows).join(firsts, "after")
             .select(F.col("part").alias("_part"), "_edge"))
    joined = led.join(edges, (F.col("part") == F.col("_part")) & F.col("_lead").isNull(), "left")
    return joined.withColumn(out, F.coalesce(F.col(f"_lead.{value}"), F.col("_edge._v"))).drop(
        "_lead", "_part", "_edge")


def likeness(a: str, b: str) -> Column:
    """Share of equal samples of two fingerprint columns (0 to 1)."""
    return F.expr(f"aggregate(sequence(0, {SAMPLES - 1}), 0, (s, i) -> s + int(substr({a}, i * "
                  f"{DIGITS} + 1, {DIGITS}) = substr({b}, i * {DIGITS} + 1, {DIGITS}))) / "
                  f"{float(SAMPLES)}D")


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, any others) -> doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, one row per row of docs.

    Null texts are empty. Texts without words have one common fingerprint. Rows follow each
    other by doc_id (null first), equal ids by their texts; a single row is its own successor.
    An empty table gives no rows."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("part", _ranges(rows)).withColumn("tie", F.xxhash64("text"))
    window = Window.partitionBy("part").orderBy("doc_id", "tie", "text")
    placed = rows.withColumn("pos", F.row_number().over(window)).drop("tie")
    led = _with_next(placed, ["pos"], "text", "following")
    n = F.length("text")
    both = led.select(
        "part", "pos", "doc_id", n.cast("long").alias("n_chars"), "text",
        solid(edited(F.col("text"), n, F.col("following"))).alias("other"))
    sets = both.select(
        "part", "pos", "doc_id", "n_chars", F.unhex(F.sha2("other", 256)).alias("sha"),
        F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")),
                          F.struct(F.lit(1).alias("which"), F.col("other").alias("t")))).alias("s"))
    keys = ["part", "pos", "doc_id", "n_chars", "sha", "which"]
    sets = sets.select(*keys[:-1], "s.which", solid(terms(F.col("s.t"))).alias("terms"))
    # a run's start; its length is the distance to the next start
    runs = sets.select(*keys, "terms", solid(F.filter(
        F.sequence(F.lit(0), F.greatest(F.size("terms") - 1, F.lit(0))),
        lambda i: F.coalesce(F.get("terms", i) != F.get("terms", i - 1), F.lit(True)))).alias("at"))
    each = runs.select(*keys, F.posexplode("at").alias("j", "i"),
                       F.get("terms", F.col("i")).alias("term"),
                       (F.coalesce(F.get("at", F.col("j") + 1), F.size("terms")) - F.col("i"))
                       .alias("times"))
    size = F.col("term").bitwiseAND(F.lit(255))
    weighed = each.select(*keys, "term", F.log(F.greatest(F.col("times") * size, F.lit(1))).alias("w"))
    mins = [F.min(s).alias(f"m{k}") for k, s in enumerate(_samples(docs.sparkSession, F.col("term"), F.col("w")))]
    signed = weighed.groupBy(*keys).agg(*mins)
    part = [F.lower(F.lpad(F.hex(F.xxhash64(f"m{k}").bitwiseAND(F.lit(16 ** DIGITS - 1))), DIGITS, "0"))
            for k in range(SAMPLES)]
    prints = signed.select(*keys, F.concat(*part).alias("print"))
    pairs = written(prints.groupBy(*keys[:-1]).agg(  # read three times below
        F.max(F.when(F.col("which") == 0, F.col("print"))).alias("fingerprint"),
        F.max(F.when(F.col("which") == 1, F.col("print"))).alias("edited_fingerprint")))
    out = _with_next(pairs, ["pos"], "fingerprint", "next_fingerprint")
    return out.select(
        "doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"))
