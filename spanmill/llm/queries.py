"""The registered query of each operator, with production parameters, and its SQL if any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
import public_tokenizers

from . import (bin_completion, byte_bpe, chat_masks, phrase_mining, prefix_trie, quality_rules,
               secret_crf, simhash_dedup, token_store, toxicity_cnn, url_cascade, weak_pii,
               weighted_fingerprints)
from .common import table
from .encoders import crc32_wide

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def hex64(name: str):
    return F.lpad(F.lower(F.hex(name)), 16, "0")


@query
def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex64("fingerprint").alias("fingerprint"), "component_id")


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


@query
def op7_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity_cnn.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumn("predicted", (F.col("score") >= toxicity_cnn.CUTOFF).cast("int"))


@query
def op1_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = weak_pii.find(table(spark, sf_dir, "documents"))
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    base = [count(k).alias(f"n_{k}") for k in weak_pii.BASE]
    others = F.size(F.filter("spans", lambda s: ~s["base"])).cast("long")
    return found.select("doc_id", *base,
                        F.sha2(weak_pii.digest(F.col("spans"), True), 256).alias("base_sha256"),
                        weak_pii.digest(F.col("spans")).alias("spans"), others.alias("n_other"),
                        F.size("spans").cast("long").alias("n_spans"))


@query
def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store(table(spark, sf_dir, "documents"),
                             public_tokenizers.path("word_bpe_49k.json"), True)


def pieces_with_crc(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "piece", "start", "length",
                         crc32_wide("ids").alias("ids_crc32"), "sequence_id", "offset")


@query
def op10_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces_with_crc(bin_completion.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.digests(byte_bpe.encoded(table(spark, sf_dir, "documents"), *where), *where)


@query
def op2_chat_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = "<|im_end|><|im_start|>assistant ok"
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", both), (-1, 1, "assistant", both)], rows.schema)
    return chat_masks.digests(chat_masks.format_chats(rows.unionByName(extra), path), path)


#: The fixed rules of op5: host and path prefix, verdict.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
             ("org/fr/", "allow")]
#: Name parts of hosts whose pages are on the blocking list of op5.
LISTED_HOSTS = "casino|bets|pills|adult|spam|ads-track"


@query
def op5_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    host, path = url_cascade.host_and_path(F.col("url"))
    listed = pages.where(host.rlike(LISTED_HOSTS)).select(F.concat(host, path).alias("key"))
    return url_cascade.judge(pages, URL_RULES, listed)


ORACLE["op5_url_cascade"] = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
host AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
split AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM host),
rules(rule, domain, below, says) AS (VALUES ('net/', 'net', '/', 'block'),
  ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(says, length(rule)) AS says
  FROM split JOIN rules ON (host = domain OR ends_with(host, '.' || domain))
    AND starts_with(path, below) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN regexp_matches(host, '{LISTED_HOSTS}')
  THEN 'block' ELSE 'allow' END) AS verdict
FROM split LEFT JOIN fits USING (page_id)
"""


@query
def op6_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query
def op11_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_crf.find(table(spark, sf_dir, "documents"))
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, secret_crf.BASE),
                        F.sha2(secret_crf.digest(F.col("spans"), True), 256).alias("base_sha256"),
                        secret_crf.digest(F.col("spans")).alias("spans"), count("crf"))


@query
def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.collocations(table(spark, sf_dir, "documents"))


ORACLE["op12_phrase_mining"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2),
    lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM words, range(1, 6) AS t(m) WHERE len(w) >= m),
freq AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY lang, m, phrase
  HAVING count(*) >= 100),
cuts AS (
  SELECT lang, m, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
    array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
  FROM freq, range(1, 5) AS t(k) WHERE k < m),
scored AS (
  SELECT c.lang, c.m, c.phrase, a, k, h.f AS l, r.f AS r, n,
    (1000::HUGEINT * a::HUGEINT * n::HUGEINT) // (h.f::HUGEINT * r.f::HUGEINT) AS score
  FROM cuts c JOIN freq h ON h.lang = c.lang AND h.phrase = c.head
    JOIN freq r ON r.lang = c.lang AND r.phrase = c.rest JOIN sizes s ON s.lang = c.lang),
best AS (SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM freq o WHERE o.lang = b.lang AND o.f = b.a AND o.m > b.m
      AND contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' '))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang
  ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


ORACLE["op13_prefix_trie"] = r"""
WITH turns AS (
  SELECT conv_id, turn, strlen(coalesce(text, '')) AS bytes, sha256(concat(
    strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS dig
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'dig': dig, 'bytes': bytes} ORDER BY turn NULLS FIRST, dig) AS t,
    xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(range(1, len(conv_id::VARCHAR) + 1),
      lambda i: [ord(substr(conv_id::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384)
        ELSE a // 2 END), 4294967295) % 9 AS h
  FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, coalesce(b.t, [])[1:c.h] || c.t[c.h + 1:] AS t
  FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
paths AS (
  SELECT conv_id, d AS depth, len(t) AS total, CASE WHEN d > 0 THEN t[d].bytes ELSE 0 END AS bytes,
    sha256(array_to_string(list_transform(t[1:d], lambda x: x.dig), ',')) AS key
  FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
      FILTER (WHERE total = depth), '')) AS ends_sha256
  FROM paths GROUP BY depth, key),
up AS (SELECT n.*, p.key AS parent FROM nodes n LEFT JOIN paths p
  ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
kids AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM up
  WHERE parent IS NOT NULL GROUP BY 1, 2),
full_nodes AS (SELECT u.*, coalesce(k.n_children, 0) AS n_children
  FROM up u LEFT JOIN kids k ON k.parent = u.key AND k.depth = u.depth),
sums AS (
  SELECT p.depth, p.key, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
    sum((n.n_convs - 1) * n.bytes)::BIGINT AS saved_tokens
  FROM full_nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY 1, 2)
SELECT n.conv_id, n.depth, o.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
  s.saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s USING (depth, key)
LEFT JOIN nodes o ON o.key = n.parent AND o.depth = n.depth - 1
"""
