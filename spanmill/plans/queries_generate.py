"""Registered queries for entry 2 and validation."""

from __future__ import annotations

import string

from pyspark.sql import functions as F

from ..options import (ANSWER_END_MARKER, ANSWER_START_MARKER, CONTEXT_PREFIX, DEFAULT_CATEGORY,
                       DEFAULT_JUDGE_TEMPLATE, DEFAULT_PROMPT_TEMPLATE, QUESTION_SEPARATOR,
                       REFUSAL_PATTERNS, GenerateOptions)
from ..sources import fixtures as fx
from . import oracle as O
from .instructions import build_instructions, validate
from .queries import _subset, _t, register

CAP_TARGET = 300


def template_sql(template: str, slots: dict[str, str]) -> str:
    parts = []
    for literal, name, _s, _c in string.Formatter().parse(template):
        if literal:
            parts.append(O.q(literal))
        if name is not None:
            parts.append(slots[name])
    return "(" + " || ".join(parts) + ")"


NL = "chr(10)"
BLOCK_SQL = O.q(ANSWER_START_MARKER + "\\n(.*?)\\n" + ANSWER_END_MARKER)
REFUSAL_SQL = O.q("(?i)" + "|".join(f"(?:{p})" for p in REFUSAL_PATTERNS))


def _block(x: str) -> str:
    return f"{O.q(ANSWER_START_MARKER)} || {NL} || {x} || {NL} || {O.q(ANSWER_END_MARKER)}"


O.cte("responses", f"""
SELECT ord, CASE WHEN ord % 11 = 0 THEN ''
                 WHEN ord % 13 = 0 THEN sentence_context
                 WHEN ord % 17 = 0 THEN {_block('sentence_context')} || {NL} || {_block('answer_span')}
                 WHEN ord % 19 = 0 THEN {_block(O.q(fx.REFUSAL_REPLY))}
                 ELSE {_block('sentence_context')} END AS response
FROM subset""")
O.cte("rstatus", f"""
SELECT s.*, r.response, regexp_extract_all(r.response, {BLOCK_SQL}, 1, 's') AS blocks,
       CASE WHEN r.response IS NULL THEN 'no_reply'
            WHEN {O.strip_sql('r.response')} = '' THEN 'empty_reply'
            WHEN regexp_matches(r.response, {REFUSAL_SQL}) THEN 'refusal'
            WHEN len(regexp_extract_all(r.response, {BLOCK_SQL}, 1, 's')) = 0 THEN 'no_block' END AS reason
FROM subset s LEFT JOIN responses r USING (ord)""")
O.cte("instr", f"""
SELECT ord, CAST(block AS BIGINT) AS block,
       {O.strip_sql(f"{O.q(CONTEXT_PREFIX)} || sentence_context || {O.q(QUESTION_SEPARATOR)} || question || {NL}")}
         AS instruction,
       {O.strip_sql('b')} AS response, {O.q(DEFAULT_CATEGORY)} AS category
FROM (SELECT ord, sentence_context, question, unnest(blocks) AS b, unnest(range(0, len(blocks))) AS block
      FROM rstatus WHERE reason IS NULL)""")
O.cte("parsed", f"""
SELECT ord, block, {O.strip_sql('p[2]')} AS question,
       {O.strip_sql(f"replace(p[1], {O.q(CONTEXT_PREFIX)}, '')")} AS sentence_context,
       {O.strip_sql('response')} AS answer
FROM (SELECT *, string_split(instruction, {O.q(QUESTION_SEPARATOR)}) AS p FROM instr) WHERE len(p) = 2""")
O.cte("verdicts", """
SELECT doc_id AS ord, quality = 1 AS is_valid FROM labels""")
O.cte("judged", """
SELECT i.*, v.is_valid FROM instr i JOIN parsed p USING (ord, block) LEFT JOIN verdicts v USING (ord)""")


def _instructions(spark, sf_dir, target=None, materialize=False, t=None):
    sub = _subset(spark, sf_dir, t=t).rows
    return build_instructions(sub, fx.responses(sub), GenerateOptions(target_count=target),
                              materialize=materialize)


def _validation(spark, sf_dir):
    rows = _instructions(spark, sf_dir).rows
    return validate(rows, fx.verdicts(_t(spark, sf_dir)))


@register("render_prompts", "SELECT ord, " + template_sql(
    DEFAULT_PROMPT_TEMPLATE, {"context": "sentence_context", "question": "question",
                              "answer_span": "answer_span"}) + " AS prompt FROM subset")
def q_render_prompts(spark, sf_dir):
    return _instructions(spark, sf_dir).prompts


@register("refusal_filter", "SELECT ord, coalesce(reason, 'ok') AS status FROM rstatus")
def q_refusal_filter(spark, sf_dir):
    from ..operators.prompts import reply_status
    sub = _subset(spark, sf_dir).rows
    replied = sub.join(fx.responses(sub), "ord", "left")
    st = reply_status(replied, GenerateOptions())
    return st.select("ord", F.coalesce("reason", F.lit("ok")).alias("status"))


@register("parse_replies", "SELECT * FROM instr")
def q_parse_replies(spark, sf_dir):
    return _instructions(spark, sf_dir).rows


@register("cap_rows", f"SELECT ord, block FROM instr ORDER BY ord, block LIMIT {CAP_TARGET}")
def q_cap_rows(spark, sf_dir):
    return _instructions(spark, sf_dir, CAP_TARGET).rows.select("ord", "block")


@register("parse_instructions", "SELECT * FROM parsed")
def q_parse_instructions(spark, sf_dir):
    from ..operators.prompts import parse_instructions
    ok, _ = parse_instructions(_instructions(spark, sf_dir).rows)
    return ok


@register("judge_prompts", "SELECT ord, block, " + template_sql(
    DEFAULT_JUDGE_TEMPLATE, {"answer": "answer", "context": "sentence_context"}) + " AS prompt FROM parsed")
def q_judge_prompts(spark, sf_dir):
    return _validation(spark, sf_dir).judge_prompts


@register("verdict_valid", "SELECT ord, block, instruction, response, category FROM judged WHERE is_valid")
def q_verdict_valid(spark, sf_dir):
    return _validation(spark, sf_dir).valid


@register("verdict_invalid", "SELECT ord, block, instruction, response, category FROM judged WHERE NOT is_valid")
def q_verdict_invalid(spark, sf_dir):
    return _validation(spark, sf_dir).invalid


@register("verdict_rejects", """
SELECT CAST(ord AS VARCHAR) || ':' || CAST(block AS VARCHAR) AS key, 'no_verdict' AS reason
FROM judged WHERE is_valid IS NULL""")
def q_verdict_rejects(spark, sf_dir):
    return _validation(spark, sf_dir).rejects.select("key", "reason")
