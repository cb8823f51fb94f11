"""More edge rows from FIXTURES §4."""

import pytest
from pyspark.sql import functions as F

from spanmill.functions.sentences import chunk_texts, with_sentences
from spanmill.operators import assemble as M
from spanmill.operators.containment import map_to_items
from spanmill.operators.headings import strip_headings


def test_chunk_sizes(spark):
    df = with_sentences(spark.createDataFrame([("A a. B b. C c.",)], "t string"), "t", "s")
    got = df.select(chunk_texts("s", 1).alias("c1"), chunk_texts("s", 2).alias("c2"),
                    chunk_texts("s", 9).alias("c9")).first()
    assert got["c1"] == ["A a.", "B b.", "C c."] and got["c2"] == ["A a. B b.", "C c."]
    assert got["c9"] == ["A a. B b. C c."]
    with pytest.raises(ValueError):
        chunk_texts("s", 0)
    with pytest.raises(Exception):
        df.withColumn("k", F.lit(0)).select(chunk_texts("s", "k")).collect()


@pytest.mark.parametrize("qs,ok", [(["a"], False), (["a", "b"], True), (["a", "a", "b", "c"], True),
                                   (["a", "a", "a", "b", "c"], False)])
def test_derangement_limits(spark, qs, ok):
    df = spark.createDataFrame([(i, q) for i, q in enumerate(qs)], "i bigint, question string")
    if not ok:
        with pytest.raises(ValueError):
            M.derange_questions(df, "1")
        return
    out = M.derange_questions(df, "1").collect()
    assert all(r["question"] != r["new_question"] for r in out)
    assert sorted(r["new_question"] for r in out) == sorted(qs)


def test_round_robin_fewer_rows_than_parameters(spark):
    grid = M.param_grid(spark, 1, 3, -1)
    ans, una = M.split_grid(grid)
    rows = spark.createDataFrame([(0,), (1,)], "i bigint")
    got = sorted((r["i"], r["p_idx"]) for r in M.round_robin(rows, ans).collect())
    assert got == [(0, 0), (1, 1)]
    empty_grid = ans.filter(F.lit(False))
    assert M.round_robin(rows, empty_grid).count() == 0     # empty grid: empty pass (D18)


def test_heading_removal(spark):
    rows = [(0, "Titel\n\n== Kopf ==\nDer erste Satz.", "x"),
            (1, "Zwei Worte\nText.", "x"),
            (2, "Titel\nEinzel\nRest.", "x"),
            (3, "Titel\nKnicklichter\nRest hier.", "Knicklichter"),
            (4, "Titel", "x")]
    df = spark.createDataFrame(rows, "id int, t string, a string")
    got = {r["id"]: (r["reason"], r["stripped"]) for r in strip_headings(df, "t", "a").collect()}
    assert got[0] == (None, "Der erste Satz.")
    assert got[1][0] == "title_not_single_word"
    assert got[2][0] == "single_token_line"
    assert got[3] == (None, "Rest hier.")
    assert got[4] == (None, "")


def test_mapping_last_item_wins_and_no_match(spark):
    item = "ord bigint, question string, positive_ctxs struct<text:array<string>>"
    items = spark.createDataFrame([(1, "Wer kam heute?", {"text": ["Anna kam heute zu uns nach Hause."]}),
                                   (5, "Wer kam heute?", {"text": ["Gestern: Anna kam heute zu uns nach Hause."]}),
                                   (7, "Andere Frage", {"text": ["Anna kam heute zu uns nach Hause."]})], item)
    parsed = spark.createDataFrame([(0, 0, "kam heute zu uns nach", "kam heute"), (1, 0, "nicht da", "kam")],
                                   "ord bigint, block bigint, sentence_context string, question string")
    mapped, rejects = map_to_items(parsed, items)
    assert [(r["ord"], r["item_ord"]) for r in mapped.collect()] == [(0, 5)]
    assert [r["reason"] for r in rejects.collect()] == ["no_source_item"]


def test_mapping_is_written_once_for_both_sides(spark):
    parsed = spark.createDataFrame([(1, 0, "sat on", "who"), (2, 0, "gone", "who"), (3, 0, "sat on", "gone")],
                                   "ord long, block long, sentence_context string, question string")
    items = spark.createDataFrame([(7, "who sat", ["cat"], (["a cat sat on it"],))],
                                  "ord long, question string, answers array<string>, positive_ctxs struct<text: array<string>>")
    mapped, rejects = map_to_items(parsed, items)
    assert [tuple(r) for r in mapped.select("ord", "item_ord").collect()] == [(1, 7)]
    assert sorted(r["key"] for r in rejects.collect()) == ["2:0", "3:0"]
    for side in (mapped, rejects):  # not the whole search again
        assert "Join" not in side._jdf.queryExecution().executedPlan().toString()
