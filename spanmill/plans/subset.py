"""Entry 1: retrieval items -> single-sentence QA subset.

read -> F1-F3 exclude -> A1 collapse -> J1 answer starts -> X6/X7/X8 sentence cut ->
F5 drop rows without a sentence -> F6 project. A1 and J1 compare contexts by their digests;
the texts of the kept items follow in one shuffle, for the cut.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import token_estimate
from ..operators.clean import ANSWER, collapse, exclude, texts_apart, with_texts
from ..operators.pairing import pair_answer_start, single_sentence_context
from ..options import SubsetOptions
from ..session import cut_lineage


@dataclass
class SubsetResult:
    rows: DataFrame      # ord, question, answer_span, sentence_context
    rejects: DataFrame   # stage, key, reason
    cut: DataFrame       # every collapsed item with answer_start, sentence_context, reason


def build_subset(items: DataFrame, span_items: DataFrame,
                 opts: SubsetOptions = SubsetOptions(), materialize: bool = False,
                 texts: DataFrame | None = None) -> SubsetResult:
    """``materialize``: checkpoint the cut into the shared checkpoint folder (the stage
    hand-off of the original pipeline), so later stages and their size checks read it
    instead of recomputing the lineage. ``texts`` (ord, text_key, text): items and span items
    then hold the sha-256 of a context in its place."""
    if texts is None:
        items, texts = texts_apart(items)
        span_items = span_items.withColumn("context", F.sha2("context", 256))
    kept = exclude(items, opts.rules)
    # column pruning: entry 1 only needs these fields after the rules ran, so upstream
    # columns (titles, hard negatives) are never computed or carried through the shuffle
    kept = kept.select("ord", "question", "answers",
                       F.struct(F.col("positive_ctxs.text").alias("text")).alias("positive_ctxs"))
    collapsed = collapse(kept, opts.policy, opts.seed)
    paired = with_texts(pair_answer_start(collapsed, span_items), texts, "src_ord")
    cut = single_sentence_context(paired, opts.require_full_span)
    if materialize:
        cut = cut_lineage(cut.drop("positive_ctxs"))
    rows = cut.filter(F.col("reason").isNull()).select(
        "ord", "question", ANSWER().alias("answer_span"), "sentence_context")
    rejects = cut.filter(F.col("reason").isNotNull()).select(
        F.lit("subset").alias("stage"), F.col("ord").cast("string").alias("key"), "reason")
    return SubsetResult(rows, rejects, cut)


def subset_summary(cut: DataFrame) -> DataFrame:
    """Rows kept, rows whose start lies in no sentence, mean sentence length (0 when
    empty) and the token estimate of sentence + question, in one aggregation."""
    ok = F.col("reason").isNull()
    return cut.agg(
        F.count_if(ok).alias("n_rows"),
        F.count_if(F.col("reason") == "no_sentence").alias("n_no_sentence"),
        F.count_if(F.col("reason").isin("no_answer_start", "offset_mismatch")).alias("n_unpaired"),
        F.round(F.coalesce(F.avg(F.when(ok, F.length("sentence_context"))), F.lit(0.0)), 6)
        .cast("double").alias("mean_context_length"),
        F.coalesce(F.sum(F.when(ok, token_estimate("sentence_context") + token_estimate("question"))),
                   F.lit(0)).cast("bigint").alias("token_estimate"),
    )
