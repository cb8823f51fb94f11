"""Substring-containment join without all pairs.

Catalyst can only plan ``contains`` joins as nested loops. The **anchor join** is exact and its
work follows the input: if needle ⊂ text, every *interior* token of the needle (not the first or
the last part, which may be cut) is a whole token of the text, and consecutive interior tokens
are consecutive text tokens. So each needle takes one interior run of 3 tokens (of 1, if it has
fewer than 3) as its anchor: the rarest in the texts, by a frequency table of bounded size. Texts
emit the hashes of their distinct runs of 1 and 3 tokens; those that no anchor can have end at a
bucket filter in the same stage, the rest is equi-joined, and ``contains`` verifies the
candidates. Hash collisions only add candidates; they never lose a pair.

A needle without an interior token is found through the vocabulary: its longest run of letters
and digits, or of other characters, lies inside one such run (a unit) of the text. Units that hold
a needle's first characters leave the texts' stage; distinct ones are matched to needles, and lead
to texts. No side is ever limited in size; joins are left to the engine, which broadcasts what
proves small and splits hot keys.

``mode="broadcast"`` asks for a nested loop over broadcast needles; beyond a checked size the
anchor join takes its place, with the same result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .clean import CONTEXT, texts_apart
from .sketches import bucket_filter, rarest

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
UNIT = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"
# the nested loop does |texts| x |needles| substring tests: only on request and when small
BROADCAST_MAX_ROWS = 256
BROADCAST_MAX_CHARS = 5_000_000
GRAM = 3
# keys a text may meet through its question, and questions that may hold a key's own
MOST_KEYS, MOST_HOLDERS = 256, 64
# pairs, for each text, that keys beyond these limits may make with texts all the same
MOST_PAIRS = 4


def _materialize(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Column computed once per row: the nondeterministic (always true) guard keeps the
    optimizer from inlining it into lambda bodies or pushing filters through it."""
    return df.withColumn(name, F.when(F.spark_partition_id() >= 0, expr))


def nested_loop(hay: DataFrame, needles: DataFrame, hay_col: str, needle_col: str,
                extra: Column | None = None) -> DataFrame:
    """Broadcast nested loop; the needle side must have passed a size check."""
    cond = F.contains(F.col(hay_col), F.col(needle_col))
    if extra is not None:
        cond = cond & extra
    return hay.join(F.broadcast(needles), cond, "inner")


def _run_hash(run: str, k: int) -> str:
    """Hash of the run of k tokens at __tok[i], element-wise (no string is built)."""
    return f"xxhash64({k}, {', '.join(f'{run}[i + {j}]' for j in range(k))})"


def _needle_runs(needles: DataFrame, needle_id: str, needle_col: str) -> DataFrame:
    """needle_id, h, len: the interior runs of each needle that may be its anchor. A needle
    without an interior token has none."""
    d = _materialize(needles.select(needle_id, needle_col), "__tok",
                     F.split(F.col(needle_col), TOKEN_SPLIT, -1))
    d = _materialize(d, "__tok", F.expr("slice(__tok, 2, greatest(size(__tok) - 2, 0))"))
    def runs(k: int) -> str:
        length = " + ".join(f"length(__tok[i + {j}])" for j in range(k))
        return (f"transform(sequence(0, size(__tok) - {k}), i -> named_struct("
                f"'h', {_run_hash('__tok', k)}, 'len', {length}))")
    each = F.when(F.size("__tok") >= 3, F.expr(runs(3))).when(F.size("__tok") >= 1, F.expr(runs(1)))
    return d.select(needle_id, F.inline(each))


def _text_runs(hay: DataFrame, hay_col: str, id_col: str) -> DataFrame:
    """id, h: the distinct runs of 1 and of 3 tokens of each text, one explode for both."""
    d = _materialize(hay.select(id_col, hay_col), "__tok", F.split(F.col(hay_col), TOKEN_SPLIT, -1))
    d = _materialize(d, "__tok", F.filter("__tok", lambda x: F.length(x) > 0))
    def runs(k: int) -> Column:
        return F.when(F.size("__tok") >= k, F.expr(
            f"transform(sequence(0, size(__tok) - {k}), i -> {_run_hash('__tok', k)})")
        ).otherwise(F.array().cast("array<bigint>"))
    hashes = F.array_distinct(F.concat(runs(1), runs(3)))
    return d.select(id_col, F.explode(_materialize_expr(hashes)).alias("h"))


def _materialize_expr(expr: Column) -> Column:
    return F.when(F.spark_partition_id() >= 0, expr)


def anchors(hay: DataFrame, needles: DataFrame, hay_id: str, hay_col: str, needle_id: str,
            needle_col: str) -> tuple[DataFrame, DataFrame]:
    """(needle_id, h) of the needles that have an anchor, and (hay_id, h) of the runs that leave
    the texts' stage: those that some anchor may have."""
    choices = _needle_runs(needles, needle_id, needle_col)
    runs = _text_runs(hay, hay_col, hay_id)
    keyed = rarest(choices, runs, needle_id, -F.col("len"))
    return keyed, bucket_filter(runs, keyed)


def _anchor_candidates(hay: DataFrame, needles: DataFrame, hay_id: str, hay_col: str,
                       needle_id: str, needle_col: str) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs of ids, and the needles that have no anchor."""
    keyed, runs = anchors(hay, needles, hay_id, hay_col, needle_id, needle_col)
    tokens = F.size(F.split(F.col(needle_col), TOKEN_SPLIT, -1))
    rest = needles.filter(F.coalesce(tokens, F.lit(0)) <= 2)
    return runs.join(keyed, "h").select(hay_id, needle_id).distinct(), rest


def _grams(col: str) -> Column:
    """Distinct character n-grams of a short string, n = 1 .. GRAM; of an empty one, itself."""
    lengths = F.sequence(F.lit(1), F.least(F.length(col), F.lit(GRAM)))
    grams = F.array_distinct(F.flatten(F.transform(lengths, lambda n: F.transform(
        F.sequence(F.lit(1), F.length(col) - n + 1), lambda i: F.substring(F.col(col), i, n)))))
    return F.when(F.col(col) == "", F.array(F.lit(""))).otherwise(grams)


def _units(col: str) -> Column:
    return F.regexp_extract_all(F.col(col), F.lit(UNIT), F.lit(0))


def _unit_candidates(hay: DataFrame, needles: DataFrame, hay_id: str, hay_col: str,
                     needle_id: str, needle_col: str) -> DataFrame:
    """Candidates of needles without an interior token. Every text has the empty unit too,
    in which an empty needle is found."""
    longest = F.array_max(F.transform(
        _units(needle_col), lambda u: F.struct(F.length(u).alias("n"), u.alias("u"))))["u"]
    sought = needles.filter(F.col(needle_col).isNotNull()).select(
        needle_id, F.coalesce(longest, F.lit("")).alias("__part")).withColumn(
        "__gram", F.substring("__part", 1, GRAM)).withColumn("h", F.xxhash64("__gram"))
    units = hay.filter(F.col(hay_col).isNotNull()).select(hay_id, F.explode(
        F.array_union(_units(hay_col), F.array(F.lit("")))).alias("__unit"))
    grams = units.select(hay_id, "__unit", F.explode(_grams("__unit")).alias("__gram")).withColumn(
        "h", F.xxhash64("__gram"))
    left = bucket_filter(grams, sought).select(hay_id, "__unit", "__gram")
    hits = (left.select("__unit", "__gram").distinct()
            .join(sought.drop("h"), "__gram").filter(F.contains("__unit", "__part"))
            .select("__unit", needle_id))
    return left.select(hay_id, "__unit").join(hits, "__unit").select(hay_id, needle_id).distinct()


def _verified(candidates: DataFrame, hay: DataFrame, needles: DataFrame, hay_id: str,
              needle_id: str, conditions: list[Column]) -> DataFrame:
    full = candidates.join(needles, needle_id).join(hay, hay_id)
    return full.filter(reduce(lambda a, b: a & b, conditions))


def anchor_join(hay: DataFrame, needles: DataFrame, hay_id: str, hay_col: str,
                needle_id: str, needle_col: str, extra: Column | None = None) -> DataFrame:
    """All (hay row, needle row) pairs with needle ⊂ hay text (and ``extra``), exact."""
    candidates, short = _anchor_candidates(hay, needles, hay_id, hay_col, needle_id, needle_col)
    candidates = candidates.unionByName(
        _unit_candidates(hay, short, hay_id, hay_col, needle_id, needle_col))
    conditions = [F.contains(F.col(hay_col), F.col(needle_col))] + ([] if extra is None else [extra])
    return _verified(candidates, hay, needles, hay_id, needle_id, conditions)


def contain_join(hay: DataFrame, needles: DataFrame, hay_id: str, hay_col: str,
                 needle_id: str, needle_col: str, extra: Column | None = None,
                 mode: str = "anchor") -> DataFrame:
    """Pairs with needle ⊂ hay. ``mode``: anchor, or broadcast for a needle side that is
    small (checked; a larger one is joined by anchors)."""
    if mode not in ("anchor", "broadcast"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "broadcast":
        row = needles.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(needle_col)).alias("c")).first()
        if row["n"] <= BROADCAST_MAX_ROWS and (row["c"] or 0) <= BROADCAST_MAX_CHARS:
            return nested_loop(hay, needles, hay_col, needle_col, extra)
    return anchor_join(hay, needles, hay_id, hay_col, needle_id, needle_col, extra)


def _contained_by_text(hay: DataFrame, keys: DataFrame) -> DataFrame:
    """Pairs with __sc ⊂ __text and __q ⊂ __iq. A key is found through its sentence if that
    has an anchor, else through its question, else through the sentence's longest unit: a
    short sentence alone would meet a share of all texts."""
    by_sentence, rest = _anchor_candidates(hay, keys, "__iord", "__text", "__kid", "__sc")
    by_question, last = _anchor_candidates(hay, rest, "__iord", "__iq", "__kid", "__q")
    candidates = (by_sentence.unionByName(by_question)
                  .unionByName(_unit_candidates(hay, last, "__iord", "__text", "__kid", "__sc")))
    return _verified(candidates, hay, keys, "__iord", "__kid",
                     [F.contains("__iq", "__q"), F.contains("__text", "__sc")])


def _contained_both(hay: DataFrame, keys: DataFrame, texts_of: DataFrame) -> DataFrame:
    """Pairs with __sc ⊂ __text and __q ⊂ __iq (__sc, __q, __iord); hay (__iord, __tkey, __iq),
    texts_of (__iord, __tkey, __text). Distinct questions are matched first, and a key meets the
    texts asked with a question that holds its own: a short sentence would meet a share of all
    texts. The keys go to the texts, which cross one shuffle. Keys of a question inside many others,
    or of one that very many keys share, may meet too many in this way and are then found by their
    texts instead, which takes the tokens of all texts: far more than a few such questions do."""
    def texts(d: DataFrame, col: str) -> DataFrame:
        return d.where(F.col(col).isNotNull()).select(col).distinct().withColumn(f"{col}_id", F.sha2(col, 256))
    asked = cut_lineage(anchor_join(texts(hay, "__iq"), texts(keys, "__q"), "__iq_id", "__iq", "__q_id", "__q")
                        .select("__q", "__iq"))
    sizes = keys.groupBy("__q").agg(F.count(F.lit(1)).alias("__n"))
    crowded = asked.join(sizes, "__q").groupBy("__iq").agg(F.sum("__n").alias("__n")).where(
        F.col("__n") > MOST_KEYS).select("__iq")
    wide = asked.groupBy("__q").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > MOST_HOLDERS)
    apart = cut_lineage(wide.select("__q").unionByName(
        asked.join(crowded, "__iq", "left_semi").select("__q")).distinct())
    askers = hay.groupBy("__iq").agg(F.count(F.lit(1)).alias("__m"))
    more = (asked.join(apart, "__q", "left_semi").join(sizes, "__q").join(askers, "__iq")
            .agg(F.sum(F.col("__n").cast("double") * F.col("__m"))).first()[0]) or 0
    few = more <= MOST_PAIRS * hay.count()
    near = keys if few else keys.join(apart, "__q", "left_anti")
    at = ["__iord", "__tkey"]
    met = hay.join(near.join(asked, "__q").select("__sc", "__q", "__iq"), "__iq")
    found = (texts_of.join(met.select(*at, "__sc", "__q"), at)
             .where(F.contains("__text", "__sc")).select("__sc", "__q", "__iord"))
    if few:
        return found
    rest = _contained_by_text(hay.join(texts_of.distinct(), at), keys.join(apart, "__q", "left_semi"))
    return found.unionByName(rest.select("__sc", "__q", "__iord"))


def map_to_items(parsed: DataFrame, items: DataFrame,
                 texts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """J2 + J3: map each parsed instruction (sentence_context, question) to the retrieval
    item whose positive text contains the sentence and whose question contains the
    question; the item with the largest ord wins per key. Rows without an item are
    rejects (the original stops with a key error). ``texts``: see texts_apart(); items then
    hold the sha-256 of the text in its place."""
    if texts is None:
        items, texts = texts_apart(items)
    keys = parsed.select("sentence_context", "question").distinct().select(
        F.sha2(F.concat(F.sha2("sentence_context", 256), F.sha2("question", 256)), 256).alias("__kid"),
        F.col("sentence_context").alias("__sc"), F.col("question").alias("__q"))
    hay = items.select(F.col("ord").alias("__iord"), CONTEXT().alias("__tkey"), F.col("question").alias("__iq"))
    texts_of = texts.select(F.col("ord").alias("__iord"), F.col("text_key").alias("__tkey"),
                            F.col("text").alias("__text"))
    pairs = _contained_both(hay, keys, texts_of)
    best = pairs.groupBy("__sc", "__q").agg(F.max("__iord").alias("item_ord"))
    # written once: the mapped rows and the rejects are both read from it
    mapped = cut_lineage(parsed.join(
        best.withColumnRenamed("__sc", "sentence_context").withColumnRenamed("__q", "question"),
        ["sentence_context", "question"], "left"))
    rejects = mapped.filter(F.col("item_ord").isNull()).select(
        F.lit("assemble").alias("stage"),
        F.concat_ws(":", F.col("ord").cast("string"), F.col("block").cast("string")).alias("key"),
        F.lit("no_source_item").alias("reason"))
    return mapped.filter(F.col("item_ord").isNotNull()), rejects
