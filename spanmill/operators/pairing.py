"""J1 last-wins equi join, X5/X6/X8 single-sentence cut, J3 strict lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sentences import sentence_in
from ..functions.text import offset_ok
from .clean import ANSWER, CONTEXT


def text_key(*cols: Column) -> Column:
    """Fixed-size join key for long texts: sha-256 over the sha-256 of each part.
    Shuffles move 64 characters instead of the whole passage."""
    return F.sha2(F.concat(*[F.sha2(c, 256) for c in cols]), 256)


def pair_answer_start(items: DataFrame, span_items: DataFrame) -> DataFrame:
    """Attach ``answer_start`` from span items matched on (question, context,
    answer); on duplicate keys the span with the largest ord wins; unmatched items keep
    null (D6). The span side is reduced to (key, start) before its shuffle."""
    right = (span_items
             .select(text_key(F.col("question"), F.col("context"), F.get(F.col("answers.text"), 0))
                     .alias("__k"),
                     F.struct(F.col("ord"), F.get(F.col("answers.answer_start"), 0).alias("s")).alias("__v"))
             .groupBy("__k").agg(F.max("__v").alias("__v"))
             .select("__k", F.col("__v.s").cast("int").alias("answer_start")))
    left = items.withColumn("__k", text_key(F.col("question"), CONTEXT(), ANSWER()))
    return left.join(right, "__k", "left").drop("__k")


def single_sentence_context(paired: DataFrame, require_full_span: bool = False) -> DataFrame:
    """X6 + X7 + X8 on paired items. Adds ``sentence_context`` and ``reason`` (null when
    the row is usable): no_answer_start (D6), offset_mismatch (X6 assertion),
    no_sentence (start lies in no sentence, D12)."""
    # the always-true guard keeps the text's parts from being built once per use
    hit = F.when(F.spark_partition_id() >= 0, sentence_in(CONTEXT(), "answer_start"))
    d, hit = paired.withColumn("__hit", hit), F.col("__hit")
    ok_span = (F.col("answer_start") + F.length(ANSWER()) <= hit["end"]) if require_full_span else F.lit(True)
    reason = (F.when(F.col("answer_start").isNull(), F.lit("no_answer_start"))
              .when(~offset_ok(CONTEXT(), ANSWER(), F.col("answer_start")), F.lit("offset_mismatch"))
              .when(hit.isNull() | ~ok_span, F.lit("no_sentence")))
    return (d.withColumn("reason", reason)
            .withColumn("sentence_context", F.when(F.col("reason").isNull(), F.col("__hit.text")))
            .drop("__hit"))


def strict_lookup(left: DataFrame, right: DataFrame, on: list[str], stage: str,
                  key_col: str = "ord") -> tuple[DataFrame, DataFrame]:
    """Inner join plus the rows without a partner as rejects (stage, key, reason)."""
    matched = left.join(right, on, "inner")
    missing = (left.join(right.select(*on).distinct(), on, "left_anti")
               .select(F.lit(stage).alias("stage"), F.col(key_col).cast("string").alias("key"),
                       F.lit("no_partner").alias("reason")))
    return matched, missing
