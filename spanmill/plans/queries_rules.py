"""Registered queries for exclusion rules given as a table.

The rules come from earlier rejections: the answer of every document labelled as bad, and the
question of every document labelled as toxic, exclude all items that contain them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.rules import exclude_by_table, rule_table_counts
from ..sources import fixtures as fx
from . import oracle as O
from .queries import _t, register

O.cte("rule_rows", """
SELECT DISTINCT 2 * q.doc_id AS rule_no, 'answer' AS field, q.answer AS pattern
FROM qa q JOIN labels l ON l.doc_id = q.doc_id AND l.quality = 0
UNION ALL
SELECT DISTINCT 2 * q.doc_id + 1, 'question', q.question
FROM qa q JOIN labels l ON l.doc_id = q.doc_id AND l.toxic = 1""")
O.cte("rule_hits", """
SELECT DISTINCT r.rule_no, q.ord FROM rule_rows r JOIN qa q
ON CASE r.field WHEN 'answer' THEN contains(q.answer, r.pattern) ELSE contains(q.question, r.pattern) END""")


def _inputs(spark, sf_dir):
    t = _t(spark, sf_dir, materialize=True)
    return fx.qa_items(t), fx.rejection_rules(t)


@register("exclude_rule_table", """
SELECT ord, answer FROM qa WHERE ord NOT IN (SELECT ord FROM rule_hits)""")
def q_exclude_rule_table(spark, sf_dir):
    kept = exclude_by_table(*_inputs(spark, sf_dir))
    return kept.select("ord", F.get("answers", 0).alias("answer"))


@register("rule_table_counts", """
SELECT r.rule_no, (SELECT count(*) FROM rule_hits h WHERE h.rule_no = r.rule_no) AS hits
FROM (SELECT DISTINCT rule_no FROM rule_rows) r""")
def q_rule_table_counts(spark, sf_dir):
    return rule_table_counts(*_inputs(spark, sf_dir))
