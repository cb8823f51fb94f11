"""Row-local functions: X1-X8, X11, X14, X17, X19, X20, F12, W1, W2."""

import random
import time

from pyspark.sql import functions as F

from spanmill.functions.sentences import chunk_texts, sentence_at, sentence_in, sentence_window, with_sentences
from spanmill.functions.text import (all_offsets, char_count, first_index_of, is_digits, is_single_word,
                                     offset_ok, render_template, split_exact, strip)


def _one(spark, df_cols, expr):
    return spark.createDataFrame([df_cols[1]], df_cols[0]).select(expr.alias("x")).first()["x"]


def test_strip_unicode_white_space(spark):
    df = spark.createDataFrame([(" \t abc  \n",), ("  ",), (None,)], "s string")
    assert [r[0] for r in df.select(strip("s")).collect()] == ["abc", "", None]


def test_split_exact_and_marker_inside(spark):
    df = spark.createDataFrame([("CONTEXT: a\nQUESTION: b",), ("no sep",), ("x\nQUESTION: y\nQUESTION: z",)],
                               "s string")
    sizes = [r[0] for r in df.select(F.size(split_exact("s", "\nQUESTION: "))).collect()]
    assert sizes == [2, 1, 3]


def test_offsets_overlapping_empty_and_wrong(spark):
    df = spark.createDataFrame([("aaaa", "aa", 1), ("abc", "", 2), ("abc", "b", 0), ("x😀ab", "ab", 2)],
                               "t string, n string, s int")
    rows = df.select(all_offsets("t", "n").alias("h"), offset_ok("t", "n", "s").alias("ok")).collect()
    assert rows[0]["h"] == [0, 1, 2] and rows[0]["ok"]
    assert rows[1]["h"] == [0, 1, 2] and rows[1]["ok"]
    assert rows[2]["h"] == [1] and not rows[2]["ok"]
    # offsets count code points: the emoji is one character
    assert rows[3]["h"] == [2] and rows[3]["ok"]


def test_digits_single_word_char_count(spark):
    df = spark.createDataFrame([("",), ("123",), ("²",), ("-1",), (" ",), ("1 2",)], "s string")
    got = df.select(is_digits("s"), is_single_word("s"), char_count("s", "2")).collect()
    assert [r[0] for r in got] == [False, True, True, False, False, False]
    assert [r[1] for r in got] == [False, True, True, True, False, False]


def test_template_with_braces_in_values(spark):
    df = spark.createDataFrame([("{x}", "q")], "c string, q string")
    got = df.select(render_template("C: {context}\nQ: {question}", context="c", question="q")).first()[0]
    assert got == "C: {x}\nQ: q"


def test_first_index_of(spark):
    df = spark.createDataFrame([(["a", "b", "a"], "a"), (["a"], "z"), ([], "z")], "a array<string>, v string")
    assert [r[0] for r in df.select(first_index_of("a", "v")).collect()] == [0, -1, -1]


def _sents(spark, text):
    df = with_sentences(spark.createDataFrame([(text,)], "t string"), "t", "s")
    return df.first()["s"]


def test_sentences_cover_text_and_offsets(spark):
    text = "Das ist gut. Er kam am Montag! Wer?  Niemand.\nNeu hier"
    s = _sents(spark, text)
    assert [x["text"] for x in s] == ["Das ist gut.", "Er kam am Montag!", "Wer?", "Niemand.", "Neu hier"]
    for x in s:
        assert text[x["start"]:x["end"]] == x["text"]
    assert s[0]["start"] == 0


def test_day_ordinal_splits_with_the_plain_rule(spark):
    # the rule has no abbreviation/ordinal guard: "3. Mai" ends a sentence (documented)
    assert [x["text"] for x in _sents(spark, "Am 3. Mai kam er.")] == ["Am 3.", "Mai kam er."]


def test_sentences_edge_texts(spark):
    assert [x["text"] for x in _sents(spark, "no end punctuation")] == ["no end punctuation"]
    assert [x["text"] for x in _sents(spark, "   ")] == [""]


def test_sentence_at_gap_is_null(spark):
    df = with_sentences(spark.createDataFrame([("Ab cd.  Ef gh.", 6), ("Ab cd.  Ef gh.", 8),
                                               ("Ab cd.  Ef gh.", 0)], "t string, p int"), "t", "s")
    got = [r[0] for r in df.select(sentence_at("s", "p")["text"]).collect()]
    assert got == [None, "Ef gh.", "Ab cd."]


def test_chunks_and_window(spark):
    text = "A a. B b. C c. D d. E e."
    df = with_sentences(spark.createDataFrame([(text, 10)], "t string, p int"), "t", "s")
    df = df.withColumn("k2", F.lit(2)).withColumn("km", F.lit(-1))
    r = df.select(chunk_texts("s", "k2").alias("c2"), chunk_texts("s", "km").alias("cm"),
                  sentence_window("t", "s", "p", 1).alias("w")).first()
    assert r["c2"] == ["A a. B b.", "C c. D d.", "E e."]
    assert r["cm"] == [text]
    assert r["w"] == "B b. C c. D d."


def test_long_document_is_linear(spark):
    """50,000 sentences in one document must not hit the quadratic path."""
    text = " ".join(f"Satz {i} ist hier." for i in range(50_000))
    df = spark.createDataFrame([(text,)], "t string")
    t0 = time.time()
    s = with_sentences(df, "t", "s").select(F.size("s").alias("n"), F.element_at("s", -1)["start"].alias("last")).first()
    assert s["n"] == 50_000
    assert text[s["last"]:].startswith("Satz 49999")
    assert time.time() - t0 < 60


def test_optional_ordinal_and_abbreviation_guard(spark):
    from spanmill.functions.sentences import DEFAULT_ABBREVIATIONS
    text = "Am 3. Mai kam Dr. Weber. Er blieb."
    df = with_sentences(spark.createDataFrame([(text,)], "t string"), "t", "s", guard_ordinals=True,
                        abbreviations=DEFAULT_ABBREVIATIONS)
    s = df.first()["s"]
    assert [x["text"] for x in s] == ["Am 3. Mai kam Dr. Weber.", "Er blieb."]
    for x in s:
        assert text[x["start"]:x["end"]] == x["text"]


def test_one_sentence_is_that_of_the_table(spark):
    r = random.Random(4)
    rows = [("".join(r.choice(["A", "b", " ", ".", "! ", "? \u00c9", " \n", "\U0001f600", ". X", "\x85", "  "])
                     for _ in range(r.randrange(60))), r.randrange(-2, 90)) for _ in range(1500)]
    rows += [(None, 1), ("Abc. Def", None), ("", 0), (" \n", 0), ("A. B", 2), ("A. B", 3)]
    df = with_sentences(spark.createDataFrame(rows, "t string, p int"), "t", "s")
    got = df.select(sentence_at("s", "p").alias("a"), sentence_in("t", "p").alias("b")).select(
        *[F.col("a." + c).eqNullSafe(F.col("b." + c)).alias(c) for c in ("start", "end", "text")], "b")
    assert got.where("start and end and text").count() == len(rows)
    assert got.where("b is not null").count() > 300
