"""Derived views that express the driver tables in the data model of the original
pipeline (retrieval items, span items, replies, verdicts). They are Spark jobs over
the whole tables, so their work grows with the input.

* ``questions``  user turns directly followed by an assistant turn, ``k`` = 0-based
  position by (conv_id, turn).
* ``qa_items``   one retrieval item per document: ord = doc_id, question =
  questions[doc_id mod K], title = [source], positive = [text], answer = 2nd and 3rd
  blank-separated word of sentence ``doc_id mod n_sentences`` (whole sentence if it has
  fewer than 3 words), hard negatives = the documents at cyclic shifts 1, 2, 3 of a
  seeded (md5) order inside the same language.
* ``spans``      span items for a partial overlap with ``qa_items`` (every item whose
  doc_id is not a multiple of 5), plus an earlier duplicate with a wrong start for
  multiples of 7 (it loses under last-wins).
* ``responses``  one reply per subset row with the marker layouts a model returns
  (empty, unmarked, two blocks, refusal, one block), chosen by the row's ord.
* ``verdicts``   labels.quality = 1 as ``is_valid``; documents without a label get null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sentences import sentence_parts, with_sentences
from ..functions.text import RSTRIP_RE
from ..operators.ranking import scalar, with_group_row_number, with_row_number
from ..options import ANSWER_END_MARKER, ANSWER_START_MARKER
from .tables import Tables, spread

REFUSAL_REPLY = "As an AI, I cannot provide an answer to this question."


def usable_documents(t: Tables) -> DataFrame:
    """Documents that have a text; ``document_rejects`` has the others."""
    return t.view("usable_documents", lambda: spread(t.documents.filter(F.col("text").isNotNull())))


def document_rejects(t: Tables) -> DataFrame:
    return t.documents.filter(F.col("text").isNull()).select(
        F.lit("subset").alias("stage"), F.col("doc_id").cast("string").alias("key"),
        F.lit("no_text").alias("reason"))


def _sentences_long(t: Tables) -> DataFrame:
    d = with_sentences(usable_documents(t).select("doc_id", "text"), "text", "sents")
    return d.select("doc_id", F.inline("sents"))


def _question_pairs(t: Tables) -> DataFrame:
    c = t.conversations
    user = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    reply = c.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    return user.join(reply, ["conv_id", "turn"])


def _questions(t: Tables) -> DataFrame:
    return with_row_number(_question_pairs(t), ["conv_id", "turn"], "k")


def negative_ids(t: Tables, shifts=(1, 2, 3)) -> DataFrame:
    """(doc_id, s, neg_id): documents at cyclic shifts of the md5 order inside the language."""
    d = t.documents.filter(F.col("text").isNotNull()).select("doc_id", "lang", F.md5(F.col("doc_id").cast("string")).alias("h"))
    ranked = with_group_row_number(d, ["lang"], [F.col("h"), F.col("doc_id")], "r", "nl")
    wanted = (ranked.select("doc_id", "lang", "r", "nl")
              .withColumn("s", F.explode(F.array(*[F.lit(s) for s in shifts])))
              .withColumn("tr", F.pmod(F.col("r") + F.col("s"), F.col("nl"))))
    targets = ranked.select("lang", F.col("r").alias("tr"), F.col("doc_id").alias("neg_id"))
    return wanted.join(targets, ["lang", "tr"]).select("doc_id", "s", "neg_id")


def _with_questions(t: Tables, d: DataFrame) -> DataFrame:
    n_q = scalar(_question_pairs(t), F.count(F.lit(1)))
    return d.withColumn("k", F.pmod(F.col("doc_id"), n_q)).join(questions(t).select("k", "question"), "k")


def _with_answers(d: DataFrame) -> DataFrame:
    """Adds answer and answer_start; only the chosen sentence is measured and trimmed."""
    once = lambda c: F.when(F.spark_partition_id() >= 0, c)
    d = d.withColumn("__parts", once(sentence_parts("text")))
    at = F.pmod(F.col("doc_id"), F.size("__parts")).cast("int")
    d = d.withColumn("__pick", once(F.struct(
        F.length(F.array_join(F.slice("__parts", F.lit(1), at), "")).alias("start"),
        F.regexp_replace(F.get("__parts", at), RSTRIP_RE, "").alias("text"))))
    return (d.withColumn("__words", F.split(F.col("__pick.text"), " ", -1))
            .withColumn("answer", F.when(F.size("__words") >= 3,
                                         F.concat(F.col("__words")[1], F.lit(" "), F.col("__words")[2]))
                        .otherwise(F.col("__pick.text")))
            .withColumn("answer_start", (F.col("__pick.start") + F.instr(F.col("__pick.text"), F.col("answer"))
                                         - 1).cast("bigint"))
            .drop("__pick", "__words", "__parts"))


def _qa_flat(t: Tables) -> DataFrame:
    """One row per document: ord, doc_id, lang, source, text, question, answer,
    answer_start."""
    # attach the question first (a shuffle of documents), then cut: the sentence parts are built
    # after the join and never cross a shuffle
    d = _with_answers(_with_questions(t, usable_documents(t)))
    # the sentence arrays stay out of the view (and its checkpoint); consumers that need
    # them segment again, row-locally
    return d.select(F.col("doc_id").alias("ord"), "doc_id", "lang", "source", "text",
                    "question", "answer", "answer_start")


def _qa_items(t: Tables) -> DataFrame:
    """Retrieval items in the nested model (question, answers, positive_ctxs) plus ``ord``;
    ``negative_ids`` has the documents of their hard_negative_ctxs."""
    return qa_flat(t).select(
        "ord", "question", F.array("answer").alias("answers"),
        F.struct(F.array("source").alias("title"), F.array("text").alias("text")).alias("positive_ctxs"))


def _qa_keyed(t: Tables) -> DataFrame:
    """qa_flat with ``text_key``, the sha-256 of the text, in the place of the text, which
    crosses no shuffle and is not written; ``qa_texts`` has it."""
    d = _with_answers(usable_documents(t).withColumn("text_key", F.sha2("text", 256)))
    return _with_questions(t, d.drop("text")).select(F.col("doc_id").alias("ord"), "doc_id", "source", "text_key",
                                                     "question", "answer", "answer_start")


def qa_texts(t: Tables) -> DataFrame:
    """(ord, text_key, text) of the usable documents."""
    return t.documents.filter(F.col("text").isNotNull()).select(
        F.col("doc_id").alias("ord"), F.sha2("text", 256).alias("text_key"), "text")


def keyed_items(t: Tables) -> DataFrame:
    """qa_items with the text's key as the positive context."""
    return qa_keyed(t).select(
        "ord", "question", F.array("answer").alias("answers"),
        F.struct(F.array("source").alias("title"), F.array("text_key").alias("text")).alias("positive_ctxs"))


def keyed_spans(t: Tables) -> DataFrame:
    """Span items with the text's key as the context."""
    return _span_items(qa_keyed(t).withColumnRenamed("text_key", "text"))


def _spans(t: Tables) -> DataFrame:
    """Span items (question, context, answers{text, answer_start}, ord)."""
    return _span_items(qa_flat(t))


def _span_items(flat: DataFrame) -> DataFrame:
    flat = flat.filter(F.pmod("doc_id", F.lit(5)) != 0)
    good = F.struct(F.col("answer_start").cast("int").alias("answer_start"), F.col("ord").alias("ord"))
    stale = F.struct(F.lit(-1).alias("answer_start"), (F.lit(-1) - F.col("ord")).alias("ord"))
    # one pass: a row gives one or two span items
    each = F.explode(F.when(F.pmod("doc_id", F.lit(7)) == 0, F.array(good, stale)).otherwise(F.array(good)))
    return (flat.select("question", F.col("text").alias("context"), "answer", each.alias("v"))
            .select("question", "context",
                    F.struct(F.array("answer").alias("text"),
                             F.array("v.answer_start").alias("answer_start")).alias("answers"),
                    "v.ord"))


def reply_for(ord_col, sentence_col, answer_col):
    """Reply layouts keyed by ord (first rule that hits wins)."""
    o = F.col(ord_col)
    block = lambda body: F.concat(F.lit(ANSWER_START_MARKER + "\n"), body, F.lit("\n" + ANSWER_END_MARKER))
    return (F.when(F.pmod(o, F.lit(11)) == 0, F.lit(""))
            .when(F.pmod(o, F.lit(13)) == 0, F.col(sentence_col))
            .when(F.pmod(o, F.lit(17)) == 0,
                  F.concat(block(F.col(sentence_col)), F.lit("\n"), block(F.col(answer_col))))
            .when(F.pmod(o, F.lit(19)) == 0, block(F.lit(REFUSAL_REPLY)))
            .otherwise(block(F.col(sentence_col))))


def responses(subset: DataFrame) -> DataFrame:
    return subset.select("ord", reply_for("ord", "sentence_context", "answer_span").alias("response"))


def verdicts(t: Tables) -> DataFrame:
    return t.labels.select(F.col("doc_id").alias("ord"), (F.col("quality") == 1).alias("is_valid"),
                           F.when(F.col("quality") != 1, F.lit("context does not hold the answer"))
                           .alias("error_messages"))


def rejection_rules(t: Tables) -> DataFrame:
    """Exclusion rules (rule_no, field, pattern): the answers of documents labelled as bad and the
    questions of those labelled as toxic."""
    d = qa_flat(t).join(t.labels, "doc_id")
    answers = d.filter(F.col("quality") == 0).select(
        (2 * F.col("doc_id")).alias("rule_no"), F.lit("answer").alias("field"), F.col("answer").alias("pattern"))
    asked = d.filter(F.col("toxic") == 1).select(
        (2 * F.col("doc_id") + 1).alias("rule_no"), F.lit("question").alias("field"), F.col("question").alias("pattern"))
    return answers.unionByName(asked).distinct()


def questions(t: Tables) -> DataFrame:
    return t.view("questions", lambda: _questions(t))


def qa_flat(t: Tables) -> DataFrame:
    return t.view("qa_flat", lambda: _qa_flat(t), heavy=True)


def qa_keyed(t: Tables) -> DataFrame:
    return t.view("qa_keyed", lambda: _qa_keyed(t), heavy=True)


def qa_items(t: Tables) -> DataFrame:
    return t.view("qa_items", lambda: _qa_items(t))


def spans(t: Tables) -> DataFrame:
    return t.view("spans", lambda: _spans(t))


def sentences_long(t: Tables) -> DataFrame:
    return t.view("sentences_long", lambda: _sentences_long(t))
