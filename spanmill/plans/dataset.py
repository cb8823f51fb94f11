"""Entry 3: instruction rows + retrieval items -> the final dataset.

V1 parse -> position i by (ord, block) -> J2 containment map to items (+ J3 rejects) ->
M3 round robin over the answerable grid -> M4-M7 contexts; first n div 2 positions ->
M8 deranged questions -> M9 unanswerable rows; U3 union -> M10.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.assemble import assemble
from ..operators.containment import map_to_items
from ..operators.prompts import parse_instructions
from ..operators.ranking import scalar, with_row_number
from ..options import AssembleOptions
from ..session import cut_lineage


@dataclass
class DatasetResult:
    rows: DataFrame       # pass, i, p_idx, grid columns, contexts, question, answer, positive_ctx_idx
    mapped: DataFrame     # parsed rows with i, n and item_ord
    rejects: DataFrame
    parts: dict


def build_dataset(spark: SparkSession, instructions: DataFrame, items: DataFrame, texts: DataFrame,
                  negatives: DataFrame, opts: AssembleOptions = AssembleOptions()) -> DatasetResult:
    """``items`` (ord, question, answers, positive_ctxs) hold the sha-256 of a text in its place,
    ``texts`` (ord, text_key, text) the texts, ``negatives`` (ord, s, neg_id) the ords of an item's
    negatives in the order of s."""
    parsed, bad = parse_instructions(instructions)
    ranked = with_row_number(parsed, ["ord", "block"], "i")
    ranked = ranked.withColumn("n", scalar(parsed, F.count(F.lit(1))))
    ranked = cut_lineage(ranked)
    mapped, unmapped = map_to_items(ranked, items, texts)
    final, parts = assemble(mapped.select("i", "n", "question", "answer", "item_ord"), items, texts, negatives,
                            spark, opts, ranked.select("i", "question"))
    return DatasetResult(final, mapped, bad.unionByName(unmapped), parts)
