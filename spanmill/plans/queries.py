"""Registered queries: name -> (spark, sf_dir) -> DataFrame, with their oracle SQL.

Outputs are flat (strings, BIGINT, DOUBLE rounded to 6 places, BOOLEAN) and every
computed column is aliased, so Spark and the oracle can be compared by value hash.
All queries read the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sentences import chunk_texts, sentence_at, sentence_window, with_sentences
from ..functions.text import all_offsets, offset_ok
from ..operators import clean
from ..options import ExclusionRules, SubsetOptions
from ..sources import fixtures as fx
from ..sources.tables import Tables
from . import oracle as O
from .subset import build_subset, subset_summary

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Rules used by the registered queries: they hit rows of the test tables.
QUERY_RULES = ExclusionRules(title=("src13",), answer=("ment",), question=("Eau",))
RULES_SQL = ("NOT (contains(source, 'src13') OR contains(answer, 'ment') OR contains(question, 'Eau'))")


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = O.build(sql)
        return fn
    return deco


def _t(spark, sf_dir, materialize: bool = False) -> Tables:
    return Tables(spark, sf_dir, materialize)


def _subset(spark, sf_dir, policy="longest", materialize=True, t=None):
    t = t or _t(spark, sf_dir, materialize)
    return build_subset(fx.keyed_items(t), fx.keyed_spans(t), SubsetOptions(rules=QUERY_RULES, policy=policy),
                        materialize=materialize, texts=fx.qa_texts(t))


# ---- X7 / X8 / W1 / W2 ---------------------------------------------------------
@register("sentences", 'SELECT doc_id, i, start, "end", text FROM sentences')
def q_sentences(spark, sf_dir):
    s = fx.sentences_long(_t(spark, sf_dir))
    return s.select("doc_id", F.col("i").cast("bigint").alias("i"), F.col("start").cast("bigint").alias("start"),
                    F.col("end").cast("bigint").alias("end"), "text")


@register("sentence_at_offset", """
SELECT a.ord, a.answer_start, s.i AS sentence_i, s.text AS sentence
FROM qa a LEFT JOIN sentences s
  ON s.doc_id = a.doc_id AND s.start <= a.answer_start AND a.answer_start < s."end" """)
def q_sentence_at_offset(spark, sf_dir):
    d = with_sentences(fx.qa_flat(_t(spark, sf_dir)), "text", "sents")
    hit = sentence_at("sents", "answer_start")
    return d.select("ord", "answer_start", hit["i"].cast("bigint").alias("sentence_i"),
                    hit["text"].alias("sentence"))


@register("sentence_window3", """
SELECT a.ord, substr(a.text, lo.start + 1, hi."end" - lo.start) AS window_text
FROM qa a
JOIN sentences h ON h.doc_id = a.doc_id AND h.start <= a.answer_start AND a.answer_start < h."end"
JOIN nsent n ON n.doc_id = a.doc_id
JOIN sentences lo ON lo.doc_id = a.doc_id AND lo.i = greatest(h.i - 1, 0)
JOIN sentences hi ON hi.doc_id = a.doc_id AND hi.i = least(h.i + 1, n.n - 1)""")
def q_sentence_window3(spark, sf_dir):
    d = with_sentences(fx.qa_flat(_t(spark, sf_dir)), "text", "sents")
    return d.select("ord", sentence_window("text", "sents", "answer_start", 1).alias("window_text")) \
        .filter(F.col("window_text").isNotNull())


@register("sentence_chunks", """
SELECT doc_id, CAST(i // 3 AS BIGINT) AS chunk_no, string_agg(text, ' ' ORDER BY i) AS chunk
FROM sentences GROUP BY doc_id, i // 3""")
def q_sentence_chunks(spark, sf_dir):
    d = with_sentences(fx.usable_documents(_t(spark, sf_dir)).select("doc_id", "text"), "text", "sents")
    d = d.withColumn("__k", F.lit(3)).select("doc_id", F.posexplode(chunk_texts("sents", "__k")))
    return d.select("doc_id", F.col("pos").cast("bigint").alias("chunk_no"), F.col("col").alias("chunk"))


@register("sentence_chunks_full", """
SELECT doc_id, string_agg(text, ' ' ORDER BY i) AS chunk FROM sentences GROUP BY doc_id""")
def q_sentence_chunks_full(spark, sf_dir):
    d = with_sentences(fx.usable_documents(_t(spark, sf_dir)).select("doc_id", "text"), "text", "sents")
    d = d.withColumn("__k", F.lit(-1))
    return d.select("doc_id", F.explode(chunk_texts("sents", "__k")).alias("chunk"))


# ---- X5 / X6 ----------------------------------------------------------------------
@register("answer_offsets", """
SELECT ord, CAST(len(h) AS BIGINT) AS n_hits, h[1] AS first_hit, h[-1] AS last_hit,
       CAST(list_sum(h) AS BIGINT) AS sum_hits
FROM (SELECT ord, list_filter(range(0, length(text)),
                              lambda i: substr(text, i + 1, length(answer)) = answer) AS h FROM qa)""")
def q_answer_offsets(spark, sf_dir):
    d = fx.qa_flat(_t(spark, sf_dir)).select("ord", all_offsets("text", "answer").alias("h"))
    return d.select("ord", F.size("h").cast("bigint").alias("n_hits"),
                    F.get("h", 0).cast("bigint").alias("first_hit"),
                    F.when(F.size("h") > 0, F.element_at("h", -1)).cast("bigint").alias("last_hit"),
                    F.when(F.size("h") > 0, F.aggregate("h", F.lit(0).cast("bigint"), lambda a, x: a + x))
                    .alias("sum_hits"))


@register("offset_check", """
SELECT ord, answer_start,
       coalesce(answer_start >= 0 AND answer_start < length(context)
                AND substr(context, answer_start + 1, length(answer)) = answer, false) AS ok
FROM spans""")
def q_offset_check(spark, sf_dir):
    s = fx.spans(_t(spark, sf_dir))
    ans = F.get(F.col("answers.text"), 0)
    start = F.get(F.col("answers.answer_start"), 0)
    return s.select("ord", start.cast("bigint").alias("answer_start"),
                    offset_ok("context", ans, start).alias("ok"))


# ---- F1-F4 / A1 ---------------------------------------------------------------------
@register("exclude_rules", f"SELECT ord, answer FROM qa WHERE {RULES_SQL}")
def q_exclude_rules(spark, sf_dir):
    items = fx.qa_items(_t(spark, sf_dir))
    return clean.exclude(items, QUERY_RULES).select("ord", clean.ANSWER().alias("answer"))


@register("rule_hit_counts", """
SELECT (SELECT count(*) FROM qa) AS n_rows,
       (SELECT count(*) FROM qa WHERE NOT (contains(source, 'src13') OR contains(answer, 'ment')
                                           OR contains(question, 'Eau'))) AS n_kept,
       r.rule_no, r.field, r.pattern,
       (SELECT count(*) FROM qa WHERE CASE r.field WHEN 'title' THEN contains(source, r.pattern)
                                      WHEN 'answer' THEN contains(answer, r.pattern)
                                      ELSE contains(question, r.pattern) END) AS hits
FROM (VALUES (0::BIGINT, 'title', 'src13'), (1::BIGINT, 'answer', 'ment'), (2::BIGINT, 'question', 'Eau'))
     r(rule_no, field, pattern)""")
def q_rule_hit_counts(spark, sf_dir):
    return clean.rule_hit_counts(fx.qa_items(_t(spark, sf_dir)), QUERY_RULES)


_COLLAPSE_ORDER = {
    "longest": "length(answer) DESC, ord",
    "shortest": "length(answer), ord",
    "first": "ord",
    "random": "md5('42' || '|' || CAST(ord AS VARCHAR)), ord",
}


def _collapse_sql(policy: str) -> str:
    return f"""
SELECT gord AS ord, ord AS src_ord, answer FROM (
  SELECT ord, answer, min(ord) OVER (PARTITION BY text) AS gord,
         row_number() OVER (PARTITION BY text ORDER BY {_COLLAPSE_ORDER[policy]}) AS rk
  FROM qa) WHERE rk = 1"""


def _collapse_query(policy: str) -> Query:
    def run(spark, sf_dir):
        c = clean.collapse(fx.qa_items(_t(spark, sf_dir)), policy)
        return c.select("ord", "src_ord", clean.ANSWER().alias("answer"))
    return run


for _p in ("longest", "shortest", "first", "random"):
    register(f"collapse_{_p}", _collapse_sql(_p))(_collapse_query(_p))


# ---- entry 1: J1, X6-X8, F5-F7, A7 --------------------------------------------------------
O.cte("filt", f"SELECT * FROM qa WHERE {RULES_SQL}")
O.cte("collapsed", """
SELECT gord AS ord, ord AS src_ord, doc_id, question, answer, text FROM (
  SELECT *, min(ord) OVER (PARTITION BY text) AS gord,
         row_number() OVER (PARTITION BY text ORDER BY length(answer) DESC, ord) AS rk
  FROM filt) WHERE rk = 1""")
O.cte("span_last", """
SELECT question, context, answer, answer_start FROM (
  SELECT *, row_number() OVER (PARTITION BY question, context, answer ORDER BY ord DESC) AS rk
  FROM spans) WHERE rk = 1""")
O.cte("paired", """
SELECT c.*, s.answer_start FROM collapsed c
LEFT JOIN span_last s ON s.question = c.question AND s.context = c.text AND s.answer = c.answer""")
O.cte("cut", """
SELECT p.*, CASE WHEN p.answer_start IS NULL THEN 'no_answer_start'
                 WHEN NOT coalesce(p.answer_start >= 0 AND p.answer_start < length(p.text)
                      AND substr(p.text, p.answer_start + 1, length(p.answer)) = p.answer, false)
                      THEN 'offset_mismatch'
                 WHEN s.text IS NULL THEN 'no_sentence' END AS reason,
       s.text AS stext
FROM paired p LEFT JOIN sentences s
  ON s.doc_id = p.doc_id AND s.start <= p.answer_start AND p.answer_start < s."end" """)
O.cte("subset", """
SELECT ord, question, answer AS answer_span, stext AS sentence_context FROM cut WHERE reason IS NULL""")


@register("pair_answer_start", "SELECT ord, src_ord, CAST(answer_start AS BIGINT) AS answer_start FROM paired")
def q_pair_answer_start(spark, sf_dir):
    return _subset(spark, sf_dir).cut.select("ord", "src_ord", F.col("answer_start").cast("bigint").alias("answer_start"))


@register("pair_unmatched", "SELECT CAST(ord AS VARCHAR) AS key, reason FROM cut WHERE reason IS NOT NULL")
def q_pair_unmatched(spark, sf_dir):
    return _subset(spark, sf_dir).rejects.select("key", "reason")


@register("subset_rows", "SELECT * FROM subset")
def q_subset_rows(spark, sf_dir):
    return _subset(spark, sf_dir).rows


@register("subset_summary", f"""
SELECT count(*) FILTER (WHERE reason IS NULL) AS n_rows,
       count(*) FILTER (WHERE reason = 'no_sentence') AS n_no_sentence,
       count(*) FILTER (WHERE reason IN ('no_answer_start', 'offset_mismatch')) AS n_unpaired,
       round(coalesce(avg(length(stext)) FILTER (WHERE reason IS NULL), 0.0), 6) AS mean_context_length,
       CAST(coalesce(sum({O.tokens_sql('stext')} + {O.tokens_sql('question')})
                     FILTER (WHERE reason IS NULL), 0) AS BIGINT) AS token_estimate
FROM cut""")
def q_subset_summary(spark, sf_dir):
    return subset_summary(_subset(spark, sf_dir).cut)
