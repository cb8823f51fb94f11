"""Registered queries for heading removal (X18-X20) and extra negatives."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import NOT_WS, WS
from ..operators.abbreviations import DOTTED, NUMBER, NUMBER_RE, abbreviation_scores, follower_scores, token_counts
from ..operators.headings import line_profile, strip_headings
from ..operators.negatives import dissimilar_partners, random_partners
from ..options import DEFAULT_SEED, HEADING_EXCEPTION_ANSWERS
from ..sources import fixtures as fx
from . import oracle as O
from .queries import _t, register

SINGLE_WORD_SQL = O.q(f"^{WS}*{NOT_WS}+{WS}*" + r"\z")
EXCEPTIONS_SQL = ", ".join(O.q(a) for a in HEADING_EXCEPTION_ANSWERS)
RANDOM_K = 3
DISSIMILAR_K = 10
DISSIMILAR_MAX_COSINE = 0.2
DISSIMILAR_TOP = 3


def _sw(x: str) -> str:
    return f"coalesce(regexp_matches({x}, {SINGLE_WORD_SQL}), false)"


def _eq(x: str) -> str:
    return f"coalesce(length({x}) - length(replace({x}, '=', '')) >= 2, false)"


O.cte("hl", "SELECT ord AS doc_id, answer, string_split(text, chr(10)) AS l0 FROM qa")
O.cte("hl3", f"""
SELECT *, CASE WHEN {_eq('l2[1]')} THEN l2[2:] ELSE l2 END AS l3 FROM (
  SELECT *, CASE WHEN l1[1] = '' THEN l1[2:] ELSE l1 END AS l2 FROM (SELECT *, l0[2:] AS l1 FROM hl))""")


@register("strip_headings", f"""
SELECT doc_id, reason, CASE WHEN reason IS NULL THEN array_to_string(
         CASE WHEN {_sw('l3[1]')} AND coalesce(answer IN ({EXCEPTIONS_SQL}), false) THEN l3[2:] ELSE l3 END,
         chr(10)) END AS stripped
FROM (SELECT *, CASE WHEN NOT {_sw('l0[1]')} THEN 'title_not_single_word'
                     WHEN {_sw('l3[1]')} AND NOT coalesce(answer IN ({EXCEPTIONS_SQL}), false)
                     THEN 'single_token_line' END AS reason FROM hl3)""")
def q_strip_headings(spark, sf_dir):
    d = fx.qa_flat(_t(spark, sf_dir)).select(F.col("ord").alias("doc_id"), "text", "answer")
    return strip_headings(d, "text", "answer").select("doc_id", "reason", "stripped")


@register("single_word_lines", f"""
SELECT doc_id, CAST(len(l0) AS BIGINT) AS n_lines,
       CAST(len(list_filter(l0, lambda l: {_sw('l')})) AS BIGINT) AS n_single_word,
       CAST(len(list_filter(l0, lambda l: {_eq('l')})) AS BIGINT) AS n_heading
FROM hl""")
def q_single_word_lines(spark, sf_dir):
    d = fx.usable_documents(_t(spark, sf_dir))
    return d.select("doc_id", line_profile(d, "text").alias("p")).select("doc_id", "p.*")


O.cte("erank", f"""
SELECT vec_id, embedding,
       row_number() OVER (ORDER BY md5('{DEFAULT_SEED}|' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS r,
       count(*) OVER () AS n
FROM embeddings""")


def _partners_sql(k: int) -> str:
    return f"""
SELECT a.vec_id, CAST(s.s AS BIGINT) AS s, b.vec_id AS partner_id, a.embedding AS ea, b.embedding AS eb
FROM erank a CROSS JOIN (SELECT range AS s FROM range(1, {k + 1})) s
JOIN erank b ON b.r = (a.r + s.s) % a.n"""


O.cte("rpartners", _partners_sql(RANDOM_K))
O.cte("dpartners", _partners_sql(DISSIMILAR_K))


@register("random_negatives", "SELECT vec_id, s, partner_id FROM rpartners")
def q_random_negatives(spark, sf_dir):
    return random_partners(_t(spark, sf_dir).embeddings, "vec_id", RANDOM_K, DEFAULT_SEED)


@register("dissimilar_negatives", f"""
SELECT vec_id, partner_id, cosine, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cosine, partner_id) AS rank FROM (
    SELECT vec_id, partner_id,
           round(list_dot_product(CAST(ea AS DOUBLE[]), CAST(eb AS DOUBLE[]))
                 / sqrt(list_dot_product(CAST(ea AS DOUBLE[]), CAST(ea AS DOUBLE[]))
                        * list_dot_product(CAST(eb AS DOUBLE[]), CAST(eb AS DOUBLE[]))), 6) AS cosine
    FROM dpartners) WHERE cosine <= {DISSIMILAR_MAX_COSINE})
WHERE rank <= {DISSIMILAR_TOP}""")
def q_dissimilar_negatives(spark, sf_dir):
    return dissimilar_partners(_t(spark, sf_dir).embeddings, "vec_id", "embedding", DISSIMILAR_K,
                               DISSIMILAR_MAX_COSINE, DISSIMILAR_TOP, DEFAULT_SEED)


NEAR_DUP_COSINE = 0.9
_UNIT_SQL = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))"


@register("near_dup_reject", f"""
WITH e AS (SELECT vec_id, {_UNIT_SQL} AS v FROM embeddings)
SELECT vec_id FROM e a WHERE NOT EXISTS (
  SELECT 1 FROM e b WHERE b.vec_id < a.vec_id AND list_cosine_similarity(a.v, b.v) >= {NEAR_DUP_COSINE})""")
def q_near_dup_reject(spark, sf_dir):
    from ..operators.neardup import near_dup_reject
    rows = _t(spark, sf_dir).embeddings
    return near_dup_reject(rows, "vec_id", "embedding", NEAR_DUP_COSINE)[0].select("vec_id")


@register("near_dup_signatures", f"""
WITH e AS (SELECT vec_id, {_UNIT_SQL} AS v FROM embeddings)
SELECT vec_id FROM e a WHERE NOT EXISTS (
  SELECT 1 FROM e b WHERE b.vec_id < a.vec_id AND list_cosine_similarity(a.v, b.v) >= {NEAR_DUP_COSINE})""")
def q_near_dup_signatures(spark, sf_dir):
    """The rule of near_dup_reject in signature mode. It could keep a row that the exact mode
    drops; on tables whose close pairs are all found the results agree."""
    from ..operators.neardup import near_dup_reject
    rows = _t(spark, sf_dir).embeddings
    return near_dup_reject(rows, "vec_id", "embedding", NEAR_DUP_COSINE, "signatures")[0].select("vec_id")


# ---- X7: statistics of learned abbreviations and of words behind ordinals -------------------
def _kind(x: str) -> str:
    return f"regexp_replace(lower({x}), '\\.+$', '')"


def _log_l(k: str, n: str, p: str) -> str:
    p = f"least(greatest({p}, 1e-9), 1 - 1e-9)"
    return f"(({k}) * ln({p}) + (({n}) - ({k})) * ln(1 - {p}))"


def _association_sql(both: str, first: str, second: str, total: str) -> str:
    p, p1 = f"({second} / {total})", f"({both} / {first})"
    p2 = f"(CASE WHEN {total} > {first} THEN ({second} - {both}) / ({total} - {first}) ELSE 0.0 END)"
    rest = f"({second} - {both})", f"({total} - {first})"
    ratio = (f"-2 * ({_log_l(both, first, p)} + {_log_l(*rest, p)} - {_log_l(both, first, p1)}"
             f" - {_log_l(*rest, p2)})")
    return f"CASE WHEN {p1} > {p} THEN {ratio} ELSE -({ratio}) END"


O.cte("tok_raw", f"""
SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, {O.q(WS + "+")}),
  lambda w: regexp_replace(regexp_replace(w, '^[^\\p{{L}}\\p{{N}}]+', ''), '[^\\p{{L}}\\p{{N}}.]+$', '')),
  lambda w: w <> '') AS w FROM udocs""")
O.cte("tok_rows", """
SELECT w[i] AS t, CASE WHEN i > 1 THEN w[i - 1] ELSE '' END AS p
FROM (SELECT w, unnest(range(1, len(w) + 1)) AS i FROM tok_raw)""")
O.cte("tok_counts", f"""
SELECT CASE WHEN regexp_matches({_kind('t')}, {O.q(NUMBER_RE)}) THEN '{NUMBER}' ELSE {_kind('t')} END AS type,
  count(*)::DOUBLE AS n, count(*) FILTER (regexp_matches(t, '[^.]\\.$'))::DOUBLE AS n_dot,
  count(*) FILTER (regexp_matches(p, '[^.]\\.$'))::DOUBLE AS n_after_dot,
  count(*) FILTER (regexp_matches(p, '[^.]\\.$') AND regexp_matches({_kind('p')}, {O.q(NUMBER_RE)}))::DOUBLE
    AS n_after_number
FROM tok_rows GROUP BY 1""")
O.cte("tok_totals", """
SELECT sum(n) AS n, sum(n_dot) AS dots, sum(n_after_dot) AS after_dot, sum(n_after_number) AS after_number
FROM tok_counts""")


@register("abbreviation_scores", f"""
SELECT type, n_dot::BIGINT AS n_dot, n_plain::BIGINT AS n_plain, round(ratio * exp(-letters) * (inside + 1)
  * power(letters, -n_plain), 4) + 0.0 AS score
FROM (SELECT c.type, c.n_dot, c.n - c.n_dot AS n_plain,
  length(type) - length(replace(type, '.', '')) AS inside, length(replace(type, '.', ''))::DOUBLE AS letters,
  2 * ({_log_l('c.n_dot', 'c.n', str(DOTTED))} - {_log_l('c.n_dot', 'c.n', '(t.dots / t.n)')}) AS ratio
  FROM tok_counts c CROSS JOIN tok_totals t WHERE c.type <> '{NUMBER}' AND c.n_dot > 0)""")
def q_abbreviation_scores(spark, sf_dir):
    counts = token_counts(fx.usable_documents(_t(spark, sf_dir)), "text")
    return abbreviation_scores(counts).withColumn("score", F.round("score", 4))


@register("follower_scores", f"""
SELECT c.type, c.n::BIGINT AS n, c.n_after_number::BIGINT AS n_after_number,
  c.n_after_dot::BIGINT AS n_after_dot,
  round({_association_sql('c.n_after_number', 't.after_number', 'c.n', 't.n')}, 4) + 0.0 AS follower,
  CASE WHEN t.after_dot > t.after_number THEN round({_association_sql(
    '(c.n_after_dot - c.n_after_number)', '(t.after_dot - t.after_number)', 'c.n', 't.n')}, 4) + 0.0
  ELSE 0.0 END AS starter
FROM tok_counts c CROSS JOIN tok_totals t WHERE c.n_after_number > 0 AND c.type <> '{NUMBER}'""")
def q_follower_scores(spark, sf_dir):
    counts = token_counts(fx.usable_documents(_t(spark, sf_dir)), "text")
    return follower_scores(counts).withColumns({c: F.round(c, 4) for c in ("follower", "starter")})


# ---- the functions in Spark SQL alone --------------------------------------------------------
def _from_sql(query: str):
    def run(spark, sf_dir):
        from ..functions.sql import install
        install(spark)
        return spark.sql(query.replace("{documents}", f"parquet.`{sf_dir.rstrip('/')}/documents.parquet`"))
    return run


register("sql_sentences", 'SELECT doc_id, i, start, "end", text FROM sentences')(_from_sql("""
SELECT doc_id, CAST(e.i AS BIGINT) AS i, CAST(e.start AS BIGINT) AS start, CAST(e.end AS BIGINT) AS end, e.text
FROM (SELECT doc_id, sm_sentences(text) AS s FROM {documents}) LATERAL VIEW inline(s) e"""))
register("sql_text_functions", f"""
SELECT doc_id, length({O.strip_sql('text')})::BIGINT AS n_stripped, {O.tokens_sql('text')}::BIGINT AS n_tokens,
  (length(text) - length(replace(text, 'e', '')))::BIGINT AS n_e, {_sw('source')} AS one_word,
  coalesce(substr(text, 1, 3) = substr(text, 1, 3) AND length(text) > 0, false) AS begins
FROM udocs""")(_from_sql("""
SELECT doc_id, CAST(length(sm_strip(text)) AS BIGINT) AS n_stripped,
  CAST(sm_token_estimate(text) AS BIGINT) AS n_tokens, CAST(sm_char_count(text, 'e') AS BIGINT) AS n_e,
  sm_is_single_word(source) AS one_word, sm_offset_ok(text, substr(text, 1, 3), 0) AS begins
FROM {documents} WHERE text IS NOT NULL"""))
