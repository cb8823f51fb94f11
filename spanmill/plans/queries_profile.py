"""Registered profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import DIGITS_RE
from ..operators import profile as P
from ..operators.clean import ANSWER, CONTEXT
from ..operators.ranking import scalar
from ..sources import fixtures as fx
from . import oracle as O
from .queries import _t, register

PROBE_TITLES = ("src13", "src7", "Portugal")


def _overlap(col_a, col_b):
    def run(spark, sf_dir):
        t = _t(spark, sf_dir, materialize=True)
        return P.distinct_overlap(fx.qa_items(t), fx.spans(t), col_a(), col_b())
    return run


for _name, _ca, _cb, _sa, _sb in (
        ("contexts", CONTEXT, lambda: F.col("context"), "text", "context"),
        ("questions", lambda: F.col("question"), lambda: F.col("question"), "question", "question"),
        ("answers", ANSWER, lambda: F.get(F.col("answers.text"), 0), "answer", "answer")):
    register(f"overlap_{_name}", f"""
SELECT (SELECT count(DISTINCT {_sa}) FROM qa) AS n_a, (SELECT count(DISTINCT {_sb}) FROM spans) AS n_b,
       (SELECT count(*) FROM (SELECT {_sa} FROM qa INTERSECT SELECT {_sb} FROM spans)) AS n_both""")(
        _overlap(_ca, _cb))


@register("distinct_counts", """
SELECT count(DISTINCT question) AS questions, count(DISTINCT text) AS contexts,
       count(DISTINCT answer) AS answers, count(DISTINCT source) AS titles FROM qa""")
def q_distinct_counts(spark, sf_dir):
    items = fx.qa_items(_t(spark, sf_dir))
    return P.distinct_counts(items, {"questions": F.col("question"), "contexts": CONTEXT(),
                                     "answers": ANSWER(), "titles": F.get(F.col("positive_ctxs.title"), 0)})


@register("duplicate_values", """
SELECT 'question' AS field, question AS value, count(*) AS n, min(ord) AS first_ord
FROM qa GROUP BY question HAVING count(*) > 1
UNION ALL
SELECT 'answer' AS field, answer AS value, count(*) AS n, min(ord) AS first_ord
FROM qa GROUP BY answer HAVING count(*) > 1""")
def q_duplicate_values(spark, sf_dir):
    items = fx.qa_items(_t(spark, sf_dir))
    # one pass over the items: a row gives its question and its answer
    each = F.explode(F.array(F.struct(F.lit("question").alias("field"), F.col("question").alias("value")),
                             F.struct(F.lit("answer").alias("field"), ANSWER().alias("value"))))
    values = items.select("ord", each.alias("x")).select("ord", "x.field", "x.value")
    return P.duplicated_values(values, F.col("value"), by=["field"])


@register("duplicate_rows", """
SELECT ord, question FROM qa
WHERE question IN (SELECT question FROM qa GROUP BY question HAVING count(*) > 1)""")
def q_duplicate_rows(spark, sf_dir):
    return P.duplicated_rows(fx.qa_items(_t(spark, sf_dir)), F.col("question")).select("ord", "question")


@register("length_describe", """
SELECT count(l) AS count, round(avg(l), 6) AS mean, round(stddev_samp(l), 6) AS std,
       round(min(l), 6) AS min, round(quantile_cont(l, 0.25), 6) AS q25,
       round(quantile_cont(l, 0.5), 6) AS q50, round(quantile_cont(l, 0.75), 6) AS q75,
       round(max(l), 6) AS max
FROM (SELECT CAST(length(answer) AS DOUBLE) AS l FROM qa)""")
def q_length_describe(spark, sf_dir):
    return P.describe_lengths(fx.qa_items(_t(spark, sf_dir)), F.length(ANSWER()))


@register("length_extremes", """
SELECT (SELECT answer FROM qa ORDER BY length(answer) DESC, ord LIMIT 1) AS longest,
       (SELECT answer FROM qa ORDER BY length(answer), ord LIMIT 1) AS shortest,
       (SELECT question FROM qa ORDER BY length(answer), ord LIMIT 1) AS question_of_shortest""")
def q_length_extremes(spark, sf_dir):
    items = fx.qa_items(_t(spark, sf_dir))
    return P.length_extremes(items, F.length(ANSWER()), ANSWER(), F.col("question"))


@register("length_upper_median", """
SELECT ord, answer FROM (
  SELECT ord, answer, row_number() OVER (ORDER BY length(answer), ord) - 1 AS pos, count(*) OVER () AS n
  FROM qa) WHERE pos = n // 2""")
def q_length_upper_median(spark, sf_dir):
    items = fx.qa_items(_t(spark, sf_dir)).select("ord", ANSWER().alias("answer"))
    return P.upper_median(items, F.length("answer")).select("ord", "answer")


@register("sorted_by_length", """
SELECT ord, row_number() OVER (ORDER BY length(answer), ord) - 1 AS pos FROM qa""")
def q_sorted_by_length(spark, sf_dir):
    items = fx.qa_items(_t(spark, sf_dir)).select("ord", ANSWER().alias("answer"))
    return P.sorted_positions(items, F.length("answer")).select("ord", "pos")


@register("digit_answers", f"""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE regexp_matches(w, {O.q(DIGITS_RE)})) AS n_digits
FROM (SELECT unnest(string_split(text, ' ')) AS w FROM sentences)""")
def q_digit_answers(spark, sf_dir):
    words = fx.sentences_long(_t(spark, sf_dir)).select(F.explode(F.split("text", " ", -1)).alias("w"))
    return P.digit_count(words, F.col("w"))


@register("row_counts", """
SELECT (SELECT count(*) FROM documents) AS n_documents, (SELECT count(*) FROM qa) AS n_items,
       (SELECT count(*) FROM spans) AS n_spans, (SELECT count(*) FROM questions) AS n_questions,
       (SELECT count(DISTINCT text) FROM qa) AS n_contexts""")
def q_row_counts(spark, sf_dir):
    t = _t(spark, sf_dir, materialize=True)
    items = fx.qa_items(t)
    return t.documents.agg(F.count(F.lit(1)).alias("n_documents")).select(
        "n_documents",
        scalar(items, F.count(F.lit(1))).alias("n_items"),
        scalar(fx.spans(t), F.count(F.lit(1))).alias("n_spans"),
        scalar(fx.questions(t), F.count(F.lit(1))).alias("n_questions"),
        scalar(items, F.count_distinct(P.digest(CONTEXT()))).alias("n_contexts"))


@register("title_member", """
SELECT p.probe, EXISTS (SELECT 1 FROM qa WHERE source = p.probe) AS present
FROM (VALUES ('src13'), ('src7'), ('Portugal')) p(probe)""")
def q_title_member(spark, sf_dir):
    probes = spark.createDataFrame([(p,) for p in PROBE_TITLES], "probe string")
    items = fx.qa_items(_t(spark, sf_dir))
    return P.members(items, F.get(F.col("positive_ctxs.title"), 0), probes)


@register("first_n", "SELECT ord, question FROM qa ORDER BY ord LIMIT 20")
def q_first_n(spark, sf_dir):
    return P.first_n(fx.qa_items(_t(spark, sf_dir)), 20).select("ord", "question")


@register("sketch_profile", """
SELECT f.field, count(*) AS n_rows, count(DISTINCT CASE f.field WHEN 'text' THEN d.text WHEN 'lang' THEN d.lang
  ELSE d.source END) AS n_distinct
FROM documents d CROSS JOIN (VALUES ('text'), ('lang'), ('source')) f(field) GROUP BY f.field""")
def q_sketch_profile(spark, sf_dir):
    """Row and distinct counts from a new store of sketches (exact up to 2^16 distinct values)."""
    import uuid

    from ..operators.profile_store import summary, update
    from ..session import checkpoint_dir

    store = f"{checkpoint_dir(spark).rstrip('/')}/profile-{uuid.uuid4().hex}"
    names = ["text", "lang", "source"]
    update(spark, f"{sf_dir.rstrip('/')}/documents.parquet", store, {n: F.col(n) for n in names})
    return summary(spark, store, names).select("field", "n_rows", "n_distinct")
