"""Sketches, rules as a table, anchors of the containment join, signatures of near duplicates."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanmill.operators import neardup as N
from spanmill.operators.containment import anchor_join, anchors
import spanmill.operators.rules as rules_module
from spanmill.operators.rules import exclude_by_table, pattern_hits, rule_table_counts
from spanmill.operators.sketches import bucket_filter, frequencies, rarest, with_frequency

SF = "/root/testdata/sf0.01"


def test_bucket_filter_loses_nothing_and_passes_few(spark):
    rows = spark.range(200_000).select(F.xxhash64("id").alias("h"), "id")
    keys = spark.range(0, 300).select(F.xxhash64("id").alias("h"))
    left = {r.id for r in bucket_filter(rows, keys).collect()}
    assert left >= set(range(300)) and len(left) < 320


def test_frequency_is_an_upper_bound(spark):
    rows = spark.range(5000).select(F.xxhash64(F.expr("id % 97")).alias("h"))
    keys = spark.range(200).select("id", F.xxhash64("id").alias("h"))
    counts = {r.id: r.n for r in with_frequency(keys, frequencies(rows), "n").collect()}
    real = {k: sum(1 for i in range(5000) if i % 97 == k) for k in range(200)}
    assert all(counts[k] >= real[k] for k in real) and sum(counts.values()) < 5000 * 1.01


def test_rarest_choice(spark):
    a, b, c, d = (k | k << 20 for k in (1, 2, 3, 4))
    rows = spark.createDataFrame([(h,) for h in [a] * 5 + [b] * 2 + [c]], "h long")
    choices = spark.createDataFrame(
        [("x", a, 1), ("x", b, 1), ("y", c, 5), ("y", d, 1), ("z", a, 0), ("w", c, 1), ("w", d + 1, 1)],
        "k string, h long, len int")
    got = {r.k: r.h for r in rarest(choices, rows, "k", -F.col("len")).collect()}
    assert got == {"x": b, "y": d, "z": a, "w": d + 1}


def brute_hits(texts, rules):
    return sorted({(i, no) for i, f, t in texts for no, g, p in rules
                   if None not in (f, t, g, p) and f == g and p in t})


def test_rule_table_against_contains(spark):
    r = random.Random(3)
    letters = "abcä😀 ."
    make = lambda n: "".join(r.choice(letters) for _ in range(n))
    texts = [(i % 250, r.choice(["title", "answer", None]), r.choice([None, "", make(r.randrange(1, 40))]))
             for i in range(500)]
    rules = [(i, r.choice(["title", "answer", "other", None]), r.choice(["", None, make(1), make(r.randrange(2, 9))]))
             for i in range(120)]
    rules += [rules[5], (7, "title", "aa"), (500, "title", "x" * 3000)]
    texts += [(900, "title", "b" + "x" * 3001), (901, "title", "a" * 100_000), texts[0]]
    ts = spark.createDataFrame(texts, "id long, field string, text string")
    rs = spark.createDataFrame(rules, "rule_no long, field string, pattern string")
    want = brute_hits(texts, rules)
    assert len(want) > 200
    assert sorted(map(tuple, pattern_hits(ts, rs).collect())) == want
    assert pattern_hits(ts.limit(0), rs).count() == 0 and pattern_hits(ts, rs.limit(0)).count() == 0


def test_equal_texts_are_searched_once(spark, monkeypatch):
    items = spark.createDataFrame(
        [(i % 290 if i % 7 else None, "t", f"w{i % 3} und mehr", f"Wer kam am Tag {i % 4}?") for i in range(300)],
        "ord long, title string, a string, question string").selectExpr(
        "ord", "question", "array(a) answers", "struct(array(title) title, array('') text) positive_ctxs")
    rows = [(k % 40, f, p) for k, (f, p) in enumerate(
        [("answer", "w1 und"), ("question", "Tag 2"), ("answer", "nie"), ("question", ""), ("title", "x")] * 20)]
    rows += [(0, "question", "Tag 3"), (0, "answer", "w2"), (50, None, "w1"), (51, "answer", None), (None, "answer", "w1")]
    rules = spark.createDataFrame(rows, "rule_no long, field string, pattern string")
    have = [(r.ord, {"answer": r.answers[0], "question": r.question, "title": "t"}) for r in items.collect()]
    hits = {(o, n) for o, t in have for n, f, p in rows if o is not None and f and p is not None and p in t[f]}
    want = {n: sum(m == n for _, m in hits) if n is not None else 0 for n, _, _ in rows}
    searched, whole = [], rules_module.rarest
    monkeypatch.setattr(rules_module, "rarest", lambda c, r, *a: searched.append(r.count()) or whole(c, r, *a))
    assert {r.rule_no: r.hits for r in rule_table_counts(items, rules).collect()} == want
    kept = [r.ord for r in exclude_by_table(items, rules.where("pattern <> ''")).collect()]
    gone = {o for o, t in have for n, f, p in rows if o is not None and f and p and p in t[f]}
    assert collections.Counter(kept) == collections.Counter(o for o, _ in have if o not in gone)
    assert max(searched) < 300


def test_a_hundred_thousand_rules(spark):
    words = spark.range(100_000).select(
        F.col("id").alias("rule_no"), F.lit("question").alias("field"),
        F.concat(F.lit("rule "), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit("?")).alias("pattern"))
    items = spark.range(4000).select(
        F.col("id").alias("ord"),
        F.concat(F.lit("is this rule "), F.lpad((F.col("id") * 50).cast("string"), 6, "0"),
                 F.when(F.col("id") % 2 == 0, "? yes").otherwise("! no")).alias("question"),
        F.array(F.lit("rule 000001?")).alias("answers"),
        F.struct(F.array(F.lit("t")).alias("title"), F.array(F.lit("x")).alias("text")).alias("positive_ctxs"))
    kept = {r.ord for r in exclude_by_table(items, words).select("ord").collect()}
    hit = {i for i in range(4000) if i % 2 == 0 and i * 50 < 100_000}
    assert kept == set(range(4000)) - hit
    counts = rule_table_counts(items, words)
    assert counts.count() == 100_000 and counts.where("hits > 0").count() == len(hit)


def test_runs_that_leave_the_texts_follow_the_hits(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.col("text").alias("hay"))
    needles = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", F.col("text").alias("needle"))
    keyed, runs = anchors(docs, needles, "doc_id", "hay", "item_id", "needle")
    pairs = anchor_join(docs, needles, "doc_id", "hay", "item_id", "needle").count()
    assert pairs > 0 and keyed.count() == needles.count()
    # all distinct runs of all texts would be some hundred thousand
    assert runs.count() <= 20 * pairs


def test_anchor_is_the_rarest_run(spark):
    hay = spark.createDataFrame([(i, f"x the big common words of all days {i} y") for i in range(50)]
                                + [(99, "x the one seldom found run of days y")], "doc_id long, hay string")
    needles = spark.createDataFrame([(1, "x the big common words of all days 7 y"),
                                     (2, "the one seldom found run of days y"), (3, "words"), (4, "f al")],
                                    "item_id long, needle string")
    got = sorted((r.item_id, r.doc_id) for r in anchor_join(
        hay, needles, "doc_id", "hay", "item_id", "needle").collect())
    assert got == sorted([(1, 7), (2, 99)] + [(k, i) for k in (3, 4) for i in range(50)])
    keyed, runs = anchors(hay, needles, "doc_id", "hay", "item_id", "needle")
    assert {r.item_id for r in keyed.collect()} == {1, 2}
    assert runs.join(keyed.where("item_id = 1"), "h").count() == 1


def brute_dropped(vectors, threshold):
    u = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return {i for i in range(len(u)) if i and (u[:i] @ u[i]).max() >= threshold}


def close_vectors(seed, n, dim, common=0.0):
    """Random vectors; a third lie at about the threshold from an earlier one."""
    r = np.random.default_rng(seed)
    v = r.normal(size=(n, dim)) + common
    for i in range(n // 3, 2 * n // 3):
        a = v[r.integers(0, n // 3)]
        v[i] = a + r.normal(size=dim) * np.linalg.norm(a) / np.sqrt(dim) * r.uniform(0.1, 0.5)
    return v[r.permutation(n)]


@pytest.mark.parametrize("common", [0.0, 1.5])
def test_signatures_recall(spark, common):
    threshold = 0.95 if common else 0.9
    v = close_vectors(4, 2000, 64, common)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    want = brute_dropped(v, threshold)
    got = {r.id for r in N.near_duplicates(df, "id", "v", threshold, "signatures").collect()}
    assert got <= want and len(got) >= 0.9 * len(want) and len(want) > 300


def test_signatures_compare_few_pairs(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    units = N._classes(df, "vec_id", "embedding")[1]
    signed, bits = N.signatures(units, 0.9)
    home = signed.select(F.col("id").alias("home_id"), F.col("sketch").alias("home_sketch"),
                         F.posexplode("codes").alias("t", "cell"))
    n = units.count()
    pairs = N.signature_pairs(N._visits(signed, bits), home).count()
    assert 0 < pairs < 0.05 * n * (n - 1) / 2


def test_signatures_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(N, "CELL_ROWS", 16)
    r = np.random.default_rng(8)
    centre = r.normal(size=16)
    v = np.concatenate([centre + r.normal(size=(400, 16)) * 0.02, r.normal(size=(200, 16))])
    v = np.concatenate([v, v[:50], np.zeros((2, 16))])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(9999, None)],
                               "id long, v array<double>")
    want = brute_dropped(v[:-2], 0.9)
    got = {x.id for x in N.near_duplicates(df, "id", "v", 0.9, "signatures").collect()}
    assert got <= want and len(got) >= 0.95 * len(want) and set(range(1, 400)) <= got
    assert N.near_duplicates(df.limit(0), "id", "v", 0.9, "signatures").count() == 0
    assert not {650, 651, 9999} & {x.id for x in N.near_duplicates(df, "id", "v", 0.9).collect()}


def test_signature_sizes_reach_the_recall():
    for n, threshold in ((2000, 0.9), (10**6, 0.9), (10**10, 0.95)):
        bits, tables = N.signature_sizes(n, threshold)
        p = np.arccos(threshold) / np.pi
        one = (1 - p) ** bits + bits * p * (1 - p) ** (bits - 1)
        assert 1 - (1 - one) ** tables >= N.RECALL and tables * (bits + 1) < n / 10


def test_exact_mode_meets_in_blocks(spark, monkeypatch):
    """Small blocks, several batches, products at the threshold, odd vectors; no pair of rows is joined."""
    r = np.random.default_rng(9)
    centre = r.normal(size=16)
    v = np.concatenate([centre + r.normal(size=(300, 16)) * 0.1, r.normal(size=(300, 16)), np.zeros((2, 16))])
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(9000, None), (9001, [1.0, 0.0]), (9002, [0.9, 0.1])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    want = brute_dropped(v[:-2], 0.9) | {9002}
    monkeypatch.setattr(N, "BLOCK_ROWS", 64)
    monkeypatch.setattr(N, "VISIT_ROWS", 7)
    got = N.near_duplicates(df, "id", "v", 0.9, "exact")
    assert {x.id for x in got.collect()} == want
    assert "home_id" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_products_near_the_threshold_are_summed_in_order():
    home, u = np.array([[1.0, 0.0]]), np.array([[0.9, 0.0], [0.9 - 1e-12, 0.0], [np.nan, 0.0], [0.95, 0.0]])
    ids = np.array([5, 6, 7, 0])
    assert N._close_rows(ids, u, np.array([1]), home, 0.9).tolist() == [5, 7]
