"""F1-F4 exclusion rules and A1 collapse of identical contexts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains
from ..options import ExclusionRules

POLICIES = ("longest", "shortest", "first", "random")

# nested element access on retrieval items (null when missing).
def TITLE() -> Column:
    return F.get(F.col("positive_ctxs.title"), 0)


def CONTEXT() -> Column:
    return F.get(F.col("positive_ctxs.text"), 0)


def ANSWER() -> Column:
    return F.get(F.col("answers"), 0)


def QUESTION() -> Column:
    return F.col("question")


def texts_apart(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items whose context is its sha-256, their texts (ord, text_key, text)): steps that only
    compare contexts move 64 characters instead of the passage."""
    digest = F.sha2(CONTEXT(), 256)
    title = [F.col("positive_ctxs.title").alias("title")] if "title" in items.schema["positive_ctxs"].dataType.names else []
    return (items.withColumn("positive_ctxs", F.struct(*title, F.array(digest).alias("text"))),
            items.select("ord", digest.alias("text_key"), CONTEXT().alias("text")))


def with_texts(rows: DataFrame, texts: DataFrame, ord_col: str) -> DataFrame:
    """Rows of texts_apart() with their contexts again; a text crosses one shuffle. Equal
    (ord, text_key) are one text."""
    def key(ord_: str, text: Column) -> Column:
        return F.concat_ws(":", F.coalesce(F.col(ord_).cast("string"), F.lit("none")), text)
    one = (texts.select(key("ord", F.col("text_key")).alias("__tk"), "text").groupBy("__tk")
           .agg(F.any_value("text").alias("__text")))
    return (rows.withColumn("__tk", key(ord_col, CONTEXT())).join(one, "__tk", "left")
            .withColumn("positive_ctxs", F.struct(F.array("__text").alias("text"))).drop("__tk", "__text"))


def rule_predicates(rules: ExclusionRules) -> list[tuple[str, str, Column]]:
    """(field, text, hit) for every rule; a rule hits when the field contains the text."""
    out = []
    for field, col, texts in (("title", TITLE(), rules.title), ("answer", ANSWER(), rules.answer),
                              ("question", QUESTION(), rules.question)):
        for text in texts:
            out.append((field, text, F.coalesce(contains(col, text), F.lit(False))))
    return out


def exclude(items: DataFrame, rules: ExclusionRules, *more: Column) -> DataFrame:
    """Drop every row hit by any rule (all rules act, unlike the original script).
    The rules are an OR-folded predicate evaluated in the scan stage. ``more`` are a caller's
    own predicates: a row that one of them holds for is dropped too."""
    preds = [p for _, _, p in rule_predicates(rules)] + [F.coalesce(p, F.lit(False)) for p in more]
    if not preds:
        return items
    hit = preds[0]
    for p in preds[1:]:
        hit = hit | p
    return items.filter(~hit)


def rule_hit_counts(items: DataFrame, rules: ExclusionRules) -> DataFrame:
    """rows hit per rule and rows kept, in one pass (one row per rule)."""
    preds = rule_predicates(rules)
    any_hit = F.lit(False)
    for _, _, p in preds:
        any_hit = any_hit | p
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.count_if(~any_hit).alias("n_kept")]
    aggs += [F.count_if(p).alias(f"hit_{i}") for i, (_, _, p) in enumerate(preds)]
    one = items.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(i).cast("bigint").alias("rule_no"), F.lit(f).alias("field"),
                              F.lit(t).alias("pattern"), F.col(f"hit_{i}").alias("hits"))
                     for i, (f, t, _) in enumerate(preds)])
    return one.select("n_rows", "n_kept", F.inline(rows))


def collapse(items: DataFrame, policy: str | Column = "longest", seed: str = "42") -> DataFrame:
    """A1: one item per identical positive context.

    longest / shortest answer (tie -> smaller ord), first (smallest ord), random (seeded
    md5 order), or a caller's order key (the smallest wins, tie -> smaller ord). Items without
    a context are not identical to each other: each stays. Output ``ord`` is the first-seen ord of the group (so later positional
    steps keep the first-seen order); ``src_ord`` is the ord of the kept item.
    Map-side partial aggregation keeps one candidate per group and map task before the
    shuffle, so a context repeated in a third of all rows costs one row per task."""
    own = isinstance(policy, Column)
    if not own and policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    alen = F.length(ANSWER())
    ordc = F.col("ord")
    rest = [c for c in items.columns if c != "ord"]
    row = F.struct(ordc.alias("src_ord"), *[F.col(c) for c in rest])
    if own:
        pick = F.min(F.struct(policy.alias("k1"), ordc.alias("k2"), row.alias("row")))
    elif policy == "longest":
        pick = F.max(F.struct(alen.alias("k1"), (-ordc).alias("k2"), row.alias("row")))
    elif policy == "shortest":
        pick = F.min(F.struct(alen.alias("k1"), ordc.alias("k2"), row.alias("row")))
    elif policy == "first":
        pick = F.min(F.struct(ordc.alias("k1"), ordc.alias("k2"), row.alias("row")))
    else:
        h = F.md5(F.concat(F.lit(seed), F.lit("|"), ordc.cast("string")))
        pick = F.min(F.struct(h.alias("k1"), ordc.alias("k2"), row.alias("row")))
    # group on a sha-256 of the context: the text then crosses the shuffle once (inside
    # the kept row) instead of twice (key and row)
    key = F.coalesce(F.sha2(CONTEXT(), 256), F.concat(F.lit("none:"), ordc.cast("string")))
    grouped = items.groupBy(key.alias("__ctx")).agg(F.min(ordc).alias("ord"), pick.alias("__pick"))
    return grouped.select("ord", "__pick.row.*")
