"""Stage wiring: options (X16, D3), template file (S6), reply hook (G2), the generation
and validation plans on small inputs."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from spanmill.operators import prompts as G
from spanmill.options import DEFAULT_PROMPT_TEMPLATE, GenerateOptions, options_for
from spanmill.plans.instructions import build_instructions, validate


def test_options_per_stage_and_unknown_stage():
    o = options_for("generate", target_count=5)
    assert isinstance(o, GenerateOptions) and o.target_count == 5
    with pytest.raises(KeyError):
        options_for("unknown_stage")


def test_template_file_or_default(scratch):
    p = f"{scratch}/t.txt"
    with open(p, "w") as f:
        f.write("C={context} Q={question} A={answer_span}")
    assert G.read_template(p, "x") == "C={context} Q={question} A={answer_span}"
    assert G.read_template(f"{scratch}/missing.txt", DEFAULT_PROMPT_TEMPLATE) == DEFAULT_PROMPT_TEMPLATE


def _subset(spark):
    return spark.createDataFrame([(0, "Wer?", "Anna", "Anna kam."), (1, "Wo?", "Berlin", "In Berlin."),
                                  (2, "Was?", "x", "X ist y.")],
                                 "ord bigint, question string, answer_span string, sentence_context string")


def test_reply_hook_and_generation_plan(spark):
    sub = _subset(spark)
    prompts = G.render_prompts(sub, "C={context}|Q={question}|A={answer_span}")

    def fake_model(p: pd.Series) -> pd.Series:      # stands in for the external client
        return p.map(lambda s: "" if s.startswith("C=X") else f"BEGINANSWER\n{s.split('|A=')[1]}.\nENDANSWER")

    replies = G.reply_with(prompts, fake_model)
    r = build_instructions(sub, replies, GenerateOptions(template="C={context}|Q={question}|A={answer_span}"))
    rows = sorted((x["ord"], x["response"]) for x in r.rows.collect())
    assert rows == [(0, "Anna."), (1, "Berlin.")]
    assert [x["reason"] for x in r.rejects.collect()] == ["empty_reply"]


def test_validation_split_keeps_original_rows(spark):
    rows = spark.createDataFrame(
        [(0, 0, "CONTEXT: a\nQUESTION: q", "r0", "c"), (1, 0, "CONTEXT: b\nQUESTION: q", "r1", "c"),
         (2, 0, "CONTEXT: c\nQUESTION: q", "r2", "c"), (3, 0, "broken", "r3", "c")],
        "ord bigint, block bigint, instruction string, response string, category string")
    verdicts = spark.createDataFrame([(0, True, None), (1, False, "missing fact")],
                                     "ord bigint, is_valid boolean, error_messages string")
    v = validate(rows, verdicts)
    assert [x["ord"] for x in v.valid.collect()] == [0]
    assert [x["instruction"] for x in v.invalid.collect()] == ["CONTEXT: b\nQUESTION: q"]
    assert sorted(x["reason"] for x in v.rejects.collect()) == ["bad_separator", "no_verdict"]
    assert v.judge_prompts.filter(F.col("ord") == 0).first()["prompt"].startswith("Context: a\n")
