"""Registered queries for containment mapping and dataset assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.containment import contain_join
from ..options import DEFAULT_SEED, NO_ANSWER_TEXT
from ..sources import fixtures as fx
from ..sources.tables import spread
from . import oracle as O
from .dataset import build_dataset
from .queries import _t, register
from .queries_generate import _instructions

SEP = "\u001e"
SEP_SQL = "chr(30)"


def _dataset(spark, sf_dir):
    t = _t(spark, sf_dir, materialize=True)
    rows = _instructions(spark, sf_dir, materialize=True, t=t).rows
    return build_dataset(spark, rows, *_sources(t))


def _sources(t):
    """Items by text key, their texts, and their negatives by ord."""
    return (fx.keyed_items(t), fx.qa_texts(t), fx.negative_ids(t).withColumnRenamed("doc_id", "ord"))


def _joined(col):
    return F.array_join(F.col(col), SEP)


# ---- J2 containment ------------------------------------------------------------------
_PAIRS_SQL = "SELECT b.item_id, d.doc_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)"


def _pairs(mode):
    def run(spark, sf_dir):
        t = _t(spark, sf_dir)
        hay = spread(t.documents.select("doc_id", F.col("text").alias("hay")))
        needles = t.benchmark.select("item_id", F.col("text").alias("needle"))
        return contain_join(hay, needles, "doc_id", "hay", "item_id", "needle", mode=mode) \
            .select("item_id", "doc_id")
    return run


register("contain_join_small", _PAIRS_SQL)(_pairs("broadcast"))
register("contain_join_anchor", _PAIRS_SQL)(_pairs("anchor"))

O.cte("imap", """
SELECT p.*, m.item_ord FROM parsed p LEFT JOIN (
  SELECT k.sentence_context, k.question, max(q.ord) AS item_ord
  FROM (SELECT DISTINCT sentence_context, question FROM parsed) k
  JOIN qa q ON contains(q.text, k.sentence_context) AND contains(q.question, k.question)
  GROUP BY k.sentence_context, k.question) m USING (sentence_context, question)""")
O.cte("iranked", """
SELECT *, row_number() OVER (ORDER BY ord, block) - 1 AS i, count(*) OVER () AS n FROM imap""")
O.cte("mapped", "SELECT * FROM iranked WHERE item_ord IS NOT NULL")


@register("map_instructions", "SELECT ord, block, i, item_ord FROM mapped")
def q_map_instructions(spark, sf_dir):
    return _dataset(spark, sf_dir).mapped.select("ord", "block", "i", "item_ord")


@register("unmapped_instructions", """
SELECT CAST(ord AS VARCHAR) || ':' || CAST(block AS VARCHAR) AS key, 'no_source_item' AS reason
FROM iranked WHERE item_ord IS NULL""")
def q_unmapped_instructions(spark, sf_dir):
    return _dataset(spark, sf_dir).rejects.filter(F.col("reason") == "no_source_item").select("key", "reason")


# ---- M1-M3 -------------------------------------------------------------------------------
O.cte("grid0", """
SELECT a.range AS n_pos, b.range AS n_neg, c.range AS pos_len, d.range AS neg_len
FROM range(0, 2) a, range(0, 4) b, range(-1, 1) c, range(-1, 1) d
WHERE a.range + b.range > 0 AND NOT (a.range > 0 AND c.range = 0) AND NOT (b.range > 0 AND d.range = 0)
  AND NOT (a.range = 0 AND c.range <> 0) AND NOT (b.range = 0 AND d.range <> 0)
  AND NOT (a.range > 1 AND c.range = -1) AND NOT (b.range > 3 AND d.range = -1)""")
O.cte("agrid", """
SELECT row_number() OVER (ORDER BY n_pos, n_neg, pos_len, neg_len) - 1 AS p_idx, *
FROM grid0 WHERE n_pos > 0""")
O.cte("ugrid", """
SELECT row_number() OVER (ORDER BY n_pos, n_neg, pos_len, neg_len) - 1 AS p_idx, *
FROM grid0 WHERE n_pos = 0""")
O.cte("abase", """
SELECT m.i, m.n, m.question, m.answer AS gen_answer, q.answer AS item_answer, [q.text] AS pos_ctxs,
       coalesce(g.negs, []) AS neg_ctxs
FROM mapped m JOIN qa q ON q.ord = m.item_ord LEFT JOIN negs g ON g.doc_id = q.ord""")
O.cte("dr", f"""
SELECT i, question, row_number() OVER (ORDER BY md5('{DEFAULT_SEED}|' || question), i) - 1 AS p,
       count(*) OVER () AS nn FROM iranked""")
O.cte("dm", "SELECT max(c) AS m FROM (SELECT count(*) AS c FROM iranked GROUP BY question)")
O.cte("deranged", """
SELECT a.i, a.question, b.question AS new_question
FROM dr a JOIN dr b ON b.p = (a.p + (SELECT m FROM dm)) % a.nn""")


def _shuffle_sql(arr: str, key: str) -> str:
    return (f"list_transform(list_sort(list_transform({arr}, lambda c, j: "
            f"{{'h': md5('{DEFAULT_SEED}|' || {key} || '|' || CAST(j - 1 AS VARCHAR)), 'j': j - 1, 'c': c}})), "
            f"lambda x: x.c)")


def _compiled(rows: str, key_prefix: str) -> str:
    return f"""
SELECT *, CASE WHEN len(pos_out) > 0 THEN CAST(list_position(contexts, pos_out[1]) - 1 AS INTEGER)
               ELSE -1 END AS positive_ctx_idx
FROM (SELECT *, {_shuffle_sql('list_concat(pos_out, neg_out)', f"'{key_prefix}:' || CAST(i AS VARCHAR) || '|c'")}
              AS contexts
      FROM (SELECT *,
              CASE WHEN n_pos = 0 THEN []::VARCHAR[]
                   WHEN pos_len = -1 AND n_pos = 1 THEN list_slice(pos_ctxs, 1, 1) END AS pos_out,
              CASE WHEN n_neg = 0 THEN []::VARCHAR[]
                   WHEN neg_len = -1 AND n_neg BETWEEN 1 AND 3 THEN list_slice(neg_ctxs, 1, CASE WHEN n_neg = 3 THEN len(neg_ctxs) ELSE n_neg END) END AS neg_out
            FROM {rows}))"""


O.cte("arows", """
SELECT b.*, g.p_idx, g.n_pos, g.n_neg, g.pos_len, g.neg_len FROM abase b
JOIN agrid g ON g.p_idx = b.i % (SELECT count(*) FROM agrid)""")
O.cte("urows", """
SELECT b.i, b.n, d.new_question AS question, b.pos_ctxs, b.neg_ctxs, g.p_idx, g.n_pos, g.n_neg, g.pos_len, g.neg_len
FROM abase b JOIN deranged d USING (i) JOIN ugrid g ON g.p_idx = b.i % (SELECT count(*) FROM ugrid)
WHERE b.i < b.n // 2""")
O.cte("acomp", _compiled("arows", "a"))
O.cte("ucomp", _compiled("urows", "u"))
O.cte("final_rows", f"""
SELECT 'answerable' AS pass, i, p_idx, n_pos, n_neg, pos_len, neg_len, contexts, question,
       gen_answer AS answer, positive_ctx_idx FROM acomp
UNION ALL
SELECT 'unanswerable' AS pass, i, p_idx, n_pos, n_neg, pos_len, neg_len, contexts, question,
       {O.q(NO_ANSWER_TEXT)} AS answer, positive_ctx_idx FROM ucomp""")


@register("param_grid", """
SELECT g.n_pos, g.n_neg, g.pos_len, g.neg_len, count(f.i) AS n_rows
FROM grid0 g LEFT JOIN final_rows f USING (n_pos, n_neg, pos_len, neg_len)
GROUP BY g.n_pos, g.n_neg, g.pos_len, g.neg_len""")
def q_param_grid(spark, sf_dir):
    r = _dataset(spark, sf_dir)
    grid = r.parts["grid"]
    cols = ["n_pos", "n_neg", "pos_len", "neg_len"]
    counts = r.rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
    return grid.join(counts, cols, "left").select(
        *[F.col(c).cast("bigint").alias(c) for c in cols], F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


@register("grid_split", """
SELECT * FROM (
  SELECT 'answerable' AS pass, p_idx, n_pos, n_neg, pos_len, neg_len FROM agrid
  UNION ALL SELECT 'unanswerable' AS pass, p_idx, n_pos, n_neg, pos_len, neg_len FROM ugrid)
SEMI JOIN (SELECT DISTINCT pass, p_idx FROM final_rows) USING (pass, p_idx)""")
def q_grid_split(spark, sf_dir):
    """The grid entries that receive instruction rows (all of them, unless there are few rows)."""
    r = _dataset(spark, sf_dir)
    cols = ["p_idx", "n_pos", "n_neg", "pos_len", "neg_len"]
    a = r.parts["answerable_grid"].select(F.lit("answerable").alias("pass"), *[F.col(c).cast("bigint") for c in cols])
    u = r.parts["unanswerable_grid"].select(F.lit("unanswerable").alias("pass"),
                                            *[F.col(c).cast("bigint") for c in cols])
    # the split is applied to the instruction rows: keep params that receive rows
    used = r.rows.select("pass", F.col("p_idx").cast("bigint")).distinct()
    return a.unionByName(u).join(used, ["pass", "p_idx"], "left_semi")


@register("round_robin", "SELECT pass, i, p_idx FROM final_rows")
def q_round_robin(spark, sf_dir):
    return _dataset(spark, sf_dir).rows.select("pass", "i", F.col("p_idx").cast("bigint"))


@register("choose_positives", f"SELECT i, array_to_string(pos_out, {SEP_SQL}) AS positives FROM acomp")
def q_choose_positives(spark, sf_dir):
    return _dataset(spark, sf_dir).parts["answerable"].select("i", _joined("pos_out").alias("positives"))


@register("choose_negatives", f"""
SELECT 'answerable' AS pass, i, array_to_string(neg_out, {SEP_SQL}) AS negatives FROM acomp
UNION ALL SELECT 'unanswerable' AS pass, i, array_to_string(neg_out, {SEP_SQL}) AS negatives FROM ucomp""")
def q_choose_negatives(spark, sf_dir):
    r = _dataset(spark, sf_dir)
    return r.parts["answerable"].select(F.lit("answerable").alias("pass"), "i", _joined("neg_out").alias("negatives")) \
        .unionByName(r.parts["unanswerable"].select(F.lit("unanswerable").alias("pass"), "i",
                                                    _joined("neg_out").alias("negatives")))


@register("shuffle_index", f"""
SELECT pass, i, positive_ctx_idx, array_to_string(contexts, {SEP_SQL}) AS contexts FROM final_rows""")
def q_shuffle_index(spark, sf_dir):
    return _dataset(spark, sf_dir).rows.select("pass", "i", "positive_ctx_idx", _joined("contexts").alias("contexts"))


@register("rederange_questions", "SELECT i, question, new_question FROM deranged")
def q_rederange_questions(spark, sf_dir):
    return _dataset(spark, sf_dir).parts["deranged"].select("i", "question", "new_question")


@register("unanswerable_rows", f"""
SELECT i, array_to_string(contexts, {SEP_SQL}) AS contexts, question, answer, positive_ctx_idx
FROM final_rows WHERE pass = 'unanswerable'""")
def q_unanswerable_rows(spark, sf_dir):
    return _dataset(spark, sf_dir).rows.filter(F.col("pass") == "unanswerable").select(
        "i", _joined("contexts").alias("contexts"), "question", "answer", "positive_ctx_idx")


@register("final_dataset", f"""
SELECT pass, i, array_to_string(contexts, {SEP_SQL}) AS contexts, question, answer, positive_ctx_idx
FROM final_rows""")
def q_final_dataset(spark, sf_dir):
    return _dataset(spark, sf_dir).rows.select("pass", "i", _joined("contexts").alias("contexts"), "question",
                                               "answer", "positive_ctx_idx")


# ---- chunked contexts (non-default limits: every M4/M5 path) ---------------------------
CHUNKED = (2, 4, 2)   # max positives, max negatives, max context length in sentences


def _grid_sql(max_pos: int, max_neg: int, max_len: int) -> str:
    top = 0 if max_len == -1 else max_len
    return f"""
SELECT a.range AS n_pos, b.range AS n_neg, c.range AS pos_len, d.range AS neg_len
FROM range(0, {max_pos + 1}) a, range(0, {max_neg + 1}) b, range(-1, {top + 1}) c, range(-1, {top + 1}) d
WHERE a.range + b.range > 0 AND NOT (a.range > 0 AND c.range = 0) AND NOT (b.range > 0 AND d.range = 0)
  AND NOT (a.range = 0 AND c.range <> 0) AND NOT (b.range = 0 AND d.range <> 0)
  AND NOT (a.range > 1 AND c.range = -1) AND NOT (b.range > 3 AND d.range = -1)"""


O.cte("grid_c", _grid_sql(*CHUNKED))
O.cte("agrid_c", """
SELECT row_number() OVER (ORDER BY n_pos, n_neg, pos_len, neg_len) - 1 AS p_idx, *
FROM grid_c WHERE n_pos > 0""")
O.cte("ugrid_c", """
SELECT row_number() OVER (ORDER BY n_pos, n_neg, pos_len, neg_len) - 1 AS p_idx, *
FROM grid_c WHERE n_pos = 0""")
# chunk lists per document and chunk size (-1 = the whole context re-joined)
O.cte("dchunks", f"""
SELECT doc_id, k, list(chunk ORDER BY c) AS chunks FROM (
  SELECT s.doc_id, kk.k, s.i // kk.k AS c, string_agg(s.text, ' ' ORDER BY s.i) AS chunk
  FROM sentences s CROSS JOIN (SELECT range AS k FROM range(1, {CHUNKED[2] + 1})) kk
  GROUP BY s.doc_id, kk.k, s.i // kk.k
  UNION ALL
  SELECT doc_id, -1 AS k, 0 AS c, string_agg(text, ' ' ORDER BY i) AS chunk FROM sentences GROUP BY doc_id)
GROUP BY doc_id, k""")
O.cte("negids", """
SELECT a.doc_id, s.s, b.doc_id AS neg_id
FROM nrank a CROSS JOIN (VALUES (1), (2), (3)) s(s)
JOIN nrank b ON b.lang = a.lang AND b.r = (a.r + s.s) % a.nl""")
O.cte("negchunks", """
SELECT n.doc_id, d.k, flatten(list(d.chunks ORDER BY n.s)) AS chunks
FROM negids n JOIN dchunks d ON d.doc_id = n.neg_id GROUP BY n.doc_id, d.k""")
O.cte("cbase", """
SELECT m.i, m.n, m.question, m.answer AS gen_answer, q.answer AS item_answer, q.ord AS item_ord,
       [q.text] AS pos_ctxs, coalesce(g.negs, []) AS neg_ctxs
FROM mapped m JOIN qa q ON q.ord = m.item_ord LEFT JOIN negs g ON g.doc_id = q.ord""")


def _compiled_chunked(rows: str, prefix: str) -> str:
    key = f"'{prefix}:' || CAST(i AS VARCHAR)"
    pos = f"""
CASE WHEN n_pos = 0 THEN []::VARCHAR[]
     WHEN pos_len = -1 AND n_pos = 1 THEN list_slice(pos_ctxs, 1, 1)
     ELSE list_concat(CASE WHEN hit > 0 THEN [pchunks[hit]] ELSE []::VARCHAR[] END,
                      CASE WHEN n_pos > 1 THEN list_slice({_shuffle_sql('rest', key + " || '|p'")}, 1, n_pos - 1)
                           ELSE []::VARCHAR[] END) END"""
    neg = f"""
CASE WHEN n_neg = 0 THEN []::VARCHAR[]
     WHEN neg_len = -1 AND n_neg BETWEEN 1 AND 3
       THEN list_slice(neg_ctxs, 1, CASE WHEN n_neg = 3 THEN len(neg_ctxs) ELSE n_neg END)
     ELSE list_slice({_shuffle_sql('coalesce(nchunks, []::VARCHAR[])', key + " || '|n'")}, 1, n_neg) END"""
    return f"""
SELECT *, CASE WHEN len(pos_out) > 0 THEN CAST(list_position(contexts, pos_out[1]) - 1 AS INTEGER)
               ELSE -1 END AS positive_ctx_idx
FROM (SELECT *, {_shuffle_sql('list_concat(pos_out, neg_out)', key + " || '|c'")} AS contexts
      FROM (SELECT *, {pos} AS pos_out, {neg} AS neg_out
            FROM (SELECT *, list_filter(pchunks, lambda c, j: j <> hit) AS rest
                  FROM (SELECT r.*, pc.chunks AS pchunks, nc.chunks AS nchunks,
                               coalesce(list_position(list_transform(pc.chunks, lambda c: contains(c, r.item_answer)),
                                                      true), 0) AS hit
                        FROM {rows} r
                        LEFT JOIN dchunks pc ON pc.doc_id = r.item_ord AND pc.k = r.pos_len
                                            AND NOT (r.pos_len = -1 AND r.n_pos = 1) AND r.n_pos > 0
                        LEFT JOIN negchunks nc ON nc.doc_id = r.item_ord AND nc.k = r.neg_len))))"""


O.cte("arows_c", """
SELECT b.*, g.p_idx, g.n_pos, g.n_neg, g.pos_len, g.neg_len FROM cbase b
JOIN agrid_c g ON g.p_idx = b.i % (SELECT count(*) FROM agrid_c)""")
O.cte("urows_c", """
SELECT b.i, b.n, b.item_ord, b.item_answer, d.new_question AS question, b.pos_ctxs, b.neg_ctxs,
       g.p_idx, g.n_pos, g.n_neg, g.pos_len, g.neg_len
FROM cbase b JOIN deranged d USING (i) JOIN ugrid_c g ON g.p_idx = b.i % (SELECT count(*) FROM ugrid_c)
WHERE b.i < b.n // 2""")
O.cte("acomp_c", _compiled_chunked("arows_c", "a"))
O.cte("ucomp_c", _compiled_chunked("urows_c", "u"))


@register("final_dataset_chunked", f"""
SELECT 'answerable' AS pass, i, p_idx, array_to_string(contexts, {SEP_SQL}) AS contexts, question,
       gen_answer AS answer, positive_ctx_idx FROM acomp_c
UNION ALL
SELECT 'unanswerable' AS pass, i, p_idx, array_to_string(contexts, {SEP_SQL}) AS contexts, question,
       {O.q(NO_ANSWER_TEXT)} AS answer, positive_ctx_idx FROM ucomp_c""")
def q_final_dataset_chunked(spark, sf_dir):
    from ..options import AssembleOptions
    t = _t(spark, sf_dir, materialize=True)
    rows = _instructions(spark, sf_dir, materialize=True, t=t).rows
    opts = AssembleOptions(max_positives=CHUNKED[0], max_negatives=CHUNKED[1], max_context_length=CHUNKED[2])
    r = build_dataset(spark, rows, *_sources(t), opts)
    return r.rows.select("pass", "i", F.col("p_idx").cast("bigint"), _joined("contexts").alias("contexts"),
                         "question", "answer", "positive_ctx_idx")
