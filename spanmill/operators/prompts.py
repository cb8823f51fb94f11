"""Prompt / reply / verdict stages as tables.

The model call itself is outside the engine: the engine writes ``prompts(ord, prompt)``
and joins a ``replies(ord, response)`` table back (a ``mapInPandas`` hook may fill it).
Every rejected row is kept with a reason.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import any_pattern, quote_regex, render_template, split_exact, strip
from ..options import CONTEXT_PREFIX, QUESTION_SEPARATOR, GenerateOptions
from .ranking import with_row_number


def _rejects(df: DataFrame, stage: str, reason_col: str = "reason") -> DataFrame:
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in ("ord", "block") if c in df.columns])
    return df.select(F.lit(stage).alias("stage"), key.alias("key"), F.col(reason_col).alias("reason"))


def read_template(path: str | None, default: str) -> str:
    """The prompt template is a small driver-side literal: the given file if it
    exists, else the default (it becomes ``lit`` pieces in ``render_template``)."""
    import os

    if path and os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            return f.read()
    return default


def render_prompts(subset: DataFrame, template: str) -> DataFrame:
    """One prompt per subset row."""
    return subset.select("ord", render_template(template, context="sentence_context", question="question",
                                                answer_span="answer_span").alias("prompt"))


def reply_with(prompts: DataFrame, generate: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """Hook: fill replies by a user function over batches of prompts (Arrow batches).
    The function is the model client; it is not part of the engine."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"ord": b["ord"], "response": generate(b["prompt"])})
    return prompts.mapInPandas(run, "ord long, response string")


def attach_replies(subset: DataFrame, replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One reply per prompt row (left join on ord). Rows without a reply, and rows whose
    replies differ, go to rejects; a reply that is there twice counts once."""
    one = replies.filter(F.col("response").isNotNull()).groupBy("ord").agg(
        F.min("response").alias("response"), F.max("response").alias("__last"))
    joined = subset.join(one, "ord", "left").withColumn(
        "reason", F.when(F.col("response").isNull(), F.lit("no_reply"))
        .when(F.col("response") != F.col("__last"), F.lit("several_replies"))).drop("__last")
    return (joined.filter(F.col("reason").isNull()).drop("reason"),
            _rejects(joined.filter(F.col("reason").isNotNull()), "generate"))


def reply_status(replied: DataFrame, opts: GenerateOptions) -> DataFrame:
    """F9 empty, F8 refusal, X15 no block: the first check that hits names the reason."""
    block_re = "(?s)" + quote_regex(opts.start_marker + "\n") + "(.*?)" + quote_regex("\n" + opts.end_marker)
    refusal = any_pattern("response", opts.refusal_patterns) if opts.filter_refusals else F.lit(False)
    blocks = F.regexp_extract_all("response", F.lit(block_re), 1)
    return (replied.withColumn("__blocks", blocks)
            .withColumn("reason", F.when(strip("response") == "", F.lit("empty_reply"))
                        .when(refusal, F.lit("refusal"))
                        .when(F.size("__blocks") == 0, F.lit("no_block"))))


def parse_replies(replied: DataFrame, opts: GenerateOptions) -> tuple[DataFrame, DataFrame]:
    """One instruction row per marked block: instruction = context and question in
    the fixed format, response = stripped block, category from the options."""
    st = reply_status(replied, opts)
    instruction = strip(F.concat(F.lit(CONTEXT_PREFIX), F.col("sentence_context"), F.lit(QUESTION_SEPARATOR),
                                 F.col("question"), F.lit("\n")))
    rows = (st.filter(F.col("reason").isNull())
            .select("ord", instruction.alias("instruction"), F.posexplode("__blocks").alias("block", "b"))
            .select("ord", F.col("block").cast("bigint").alias("block"), "instruction",
                    strip("b").alias("response"), F.lit(opts.category).alias("category")))
    return rows, _rejects(st.filter(F.col("reason").isNotNull()), "generate")


def cap_rows(rows: DataFrame, target: int | None) -> DataFrame:
    """Stop at the target count: the first ``target`` rows by (ord, block)."""
    if target is None:
        return rows
    if target <= 0:
        return rows.limit(0)
    ranked = with_row_number(rows, ["ord", "block"], "__n")
    return ranked.filter(F.col("__n") < target).drop("__n")


def parse_instructions(instructions: DataFrame, carry: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """V1 (X1-X3): split the instruction at the question separator (exactly two parts,
    else reject), remove the context prefix everywhere (D14), strip all three fields.
    ``carry`` names input columns to keep beside them."""
    parts = split_exact("instruction", QUESTION_SEPARATOR)
    d = instructions.withColumn("__p", parts).withColumn(
        "reason", F.when(F.col("instruction").isNull() | (F.size("__p") != 2), F.lit("bad_separator"))
        .when(F.col("response").isNull(), F.lit("no_response")))
    ok = d.filter(F.col("reason").isNull()).select(
        "ord", "block",
        strip(F.col("__p")[1]).alias("question"),
        strip(F.replace(F.col("__p")[0], F.lit(CONTEXT_PREFIX), F.lit(""))).alias("sentence_context"),
        strip("response").alias("answer"), *carry)
    return ok, _rejects(d.filter(F.col("reason").isNotNull()), "parse")


def judge_prompts(parsed: DataFrame, template: str) -> DataFrame:
    """V2: one judge prompt per parsed row."""
    return parsed.select("ord", "block", render_template(template, answer="answer",
                                                         context="sentence_context").alias("prompt"))


def judge_with(prompts: DataFrame, judge: Callable[[pd.Series], pd.DataFrame]) -> DataFrame:
    """Hook: fill verdicts by a user function over batches of judge prompts. It returns a
    frame with ``is_valid`` (true, false or missing) and ``error_messages`` in the same order."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            verdict = judge(b["prompt"]).reset_index(drop=True)
            keys = b[["ord", "block"]].reset_index(drop=True)
            yield keys.assign(is_valid=verdict["is_valid"], error_messages=verdict["error_messages"])
    return prompts.mapInPandas(run, "ord long, block long, is_valid boolean, error_messages string")


def attach_verdicts(rows: DataFrame, verdicts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """V3: left join the verdict on (ord, block); without a block column in ``verdicts`` a
    verdict holds for all blocks of its ord. A row without a verdict, and one whose verdicts
    contradict each other, go to rejects."""
    keys = [c for c in ("ord", "block") if c in verdicts.columns]
    one = verdicts.filter(F.col("is_valid").isNotNull()).groupBy(*keys).agg(
        F.bool_and("is_valid").alias("is_valid"), F.bool_or("is_valid").alias("__any"),
        F.min("error_messages").alias("error_messages"))
    j = rows.join(one, keys, "left").withColumn(
        "reason", F.when(F.col("is_valid").isNull(), F.lit("no_verdict"))
        .when(F.col("is_valid") != F.col("__any"), F.lit("several_verdicts"))).drop("__any")
    return (j.filter(F.col("reason").isNull()).drop("reason"),
            _rejects(j.filter(F.col("reason").isNotNull()), "validate"))


def split_by_verdict(judged: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """V4: the original rows, split into valid and invalid (S5 writes both)."""
    return (judged.filter(F.col("is_valid")).select(*keep),
            judged.filter(~F.col("is_valid")).select(*keep))
