"""Learned sentence ends, prefix sums, and selection by counts."""

import itertools
import random
import subprocess
import sys
import time

from pyspark.sql import functions as F

from spanmill.functions.sentences import with_sentences
from spanmill.functions.text import all_offsets, prefix_sums
from spanmill.operators import abbreviations as A
from spanmill.operators.profile import duplicated_values, upper_median

NOUNS = ["Haus", "Garten", "Brief", "Turm", "Wagen", "Fluss", "Markt", "Abend"]
VERBS = ["steht", "liegt", "kommt", "bleibt", "geht"]
MONTHS = ["Mai", "Juni", "April"]


def german(seed, sentences):
    """(sentence list): invented ones with abbreviations and ordinals inside."""
    r, out = random.Random(seed), []
    for _ in range(sentences):
        words = [r.choice(["Der", "Die", "Ein"]), r.choice(NOUNS), r.choice(VERBS)]
        words += r.choice([["am", f"{r.randrange(1, 31)}.", r.choice(MONTHS)], ["bei", "Dr.", r.choice(NOUNS)],
                           ["usw.", "Neu"], ["ca.", str(r.randrange(100))], ["im", r.choice(NOUNS)],
                           ["z.B.", r.choice(NOUNS)], ["seit", str(r.randrange(1900, 2000))]])
        out.append(" ".join([*words, r.choice(["oft", "nie", "hier", "dort"])]) + r.choice(".!.?."))
    return out


def test_learned_ends_against_marked_ones(spark):
    train = [" ".join(german(seed, 12)) for seed in range(150)]
    df = spark.createDataFrame([(t,) for t in train] + [(None,), ("",)], "text string")
    learned = A.learn(df)
    assert {"dr", "usw", "z.b", "ca"} <= set(learned.abbreviations)
    assert not set(w.lower() for w in NOUNS + VERBS + ["oft", "nie", "hier", "dort"]) & set(learned.abbreviations)
    assert {m.lower() for m in MONTHS} == set(learned.followers)
    held_out = [german(seed, 20) for seed in range(1000, 1040)]
    rows = spark.createDataFrame([(i, " ".join(s)) for i, s in enumerate(held_out)], "id long, text string")

    def ends(**more):
        got = with_sentences(rows, "text", "s", **more).collect()
        return {(r.id, x["end"]) for r in got for x in r.s}

    marked = {(i, e) for i, s in enumerate(held_out)
              for e in (n + k for k, n in enumerate(itertools.accumulate(map(len, s))))}
    plain, better = ends(), ends(learned=learned)
    assert len(plain & marked) / len(plain) < 0.8
    assert len(better & marked) / len(better) >= 0.99 and len(better & marked) / len(marked) >= 0.97


def test_counts_of_the_learner(spark):
    df = spark.createDataFrame([("Am 3. Mai, (z.B. hier) war es... Ende. 4. mai!",), (" \n",)], "t string")
    got = {r.type: tuple(r)[1:] for r in A.token_counts(df, "t").collect()}
    assert got["##"] == (2, 2, 1, 0) and got["mai"] == (2, 0, 2, 2)
    assert got["z.b"] == (1, 1, 0, 0) and got["hier"] == (1, 0, 1, 0)
    assert got["es"] == (1, 0, 0, 0) and got["ende"] == (1, 1, 0, 0)
    empty = spark.createDataFrame([], "t string")
    assert A.learn(empty, "t") == A.Learned()


def test_texts_are_counted_once(spark):
    """Scores take totals besides the counts; the texts are not taken apart again for each."""
    texts = ["Am 3. Mai z.B. kam er. Am 4. Mai ging er.", "- -- Nr. 7 ... 8. (Mai) ...", "", "x.. 5. .. mai"]
    counts = A.token_counts(spark.createDataFrame([(t,) for t in texts], "t string"), "t")
    for scores in (A.follower_scores(counts), A.abbreviation_scores(counts)):
        assert "Generate" not in scores._jdf.queryExecution().toString()
    got = {r.type: tuple(r)[1:] for r in counts.collect()}
    assert got["mai"] == (4, 0, 4, 4) and got["##"] == (5, 4, 1, 0) and got["nr"] == (1, 1, 0, 0)
    assert got["x"] == (1, 0, 0, 0) and got["am"] == (2, 0, 1, 0) and "" not in got


def test_words_are_taken_literally(spark):
    learned = A.Learned(("a.b", "x+", "\\E"), ("mai(",))
    df = spark.createDataFrame([("Der a.b. Hund. Ein axb. Hund x+. Ja \\E. Gut 3. Mai( 3. Mai",)], "t string")
    got = [x["text"] for x in with_sentences(df, "t", "s", learned=learned).first().s]
    assert got == ["Der a.b. Hund.", "Ein axb.", "Hund x+. Ja \\E. Gut 3. Mai( 3.", "Mai"]


def test_prefix_sums(spark):
    r = random.Random(1)
    for n in (0, 1, 31, 32, 33, 1023, 1024, 1025, 5000):
        v = [r.randrange(9) for _ in range(n)]
        df = spark.createDataFrame([(v,)], "v array<int>")
        got = df.select(prefix_sums(F.col("v")).alias("p")).first().p
        assert got == list(itertools.accumulate(v, initial=0))[:-1]


def test_offsets_of_many_hits_stay_linear(spark):
    df = spark.createDataFrame([("ab" * 60_000,)], "t string").withColumn("n", F.lit("ab"))
    began = time.time()
    row = df.select(all_offsets(F.col("t"), F.col("n")).alias("o")).first()
    assert row.o == list(range(0, 120_000, 2)) and time.time() - began < 30


def test_upper_median_ties_and_sparse_ords(spark):
    r = random.Random(4)
    for n in (1, 2, 7, 400):
        rows = [(r.randrange(-10**15, 10**15), r.choice([None, "", "aa", "aa", "aa", "bbb"])) for _ in range(n)]
        df = spark.createDataFrame(rows, "ord long, v string")
        want = sorted(rows, key=lambda x: (-1 if x[1] is None else len(x[1]), x[0]))[n // 2]
        got = upper_median(df, F.length("v"))
        assert [tuple(x) for x in got.collect()] == [want]
    assert upper_median(df.limit(0), F.length("v")).count() == 0


def test_upper_median_orders_no_whole_table(spark):
    df = spark.range(1000).select(F.col("id").alias("ord"), F.lit("same").alias("v"))
    plan = upper_median(df, F.length("v"))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    ordered = next(i for i, line in enumerate(plan) if "row_number()" in line)
    below = next(line for line in plan[ordered + 1:] if "Filter" in line)
    assert "__blk" in below or "shiftright" in below


def test_duplicate_values_by_digest(spark):
    rows = [(1, "a", "x"), (2, "a", "x"), (2, "b", "x"), (2, "b", "x"), (3, "a", None), (4, "a", None), (5, "a", "y")]
    df = spark.createDataFrame(rows, "ord long, field string, v string")
    got = sorted(map(str, map(tuple, duplicated_values(df, F.col("v"), by=["field"]).collect())))
    assert got == sorted(["('a', 'x', 2, 1)", "('b', 'x', 2, 2)", "('a', None, 2, 3)"])


def test_entry_without_the_optional_libraries():
    code = ("import sys\nsys.modules['tokenizers'] = None\nsys.modules['xxhash'] = None\n"
            "import __spark_entry__ as e\nassert 'subset_rows' in e.queries() and 'pipeline' not in e.queries()")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])


def test_sql_functions(spark):
    from spanmill.functions.sql import install

    assert "sm_sentences" in install(spark) and install(spark)  # again: nothing to complain about
    row = spark.sql(r"""SELECT sm_strip('\u0085 a b \n') AS s, sm_is_digits('12²') AS d, sm_is_digits('') AS e,
        sm_is_single_word(' x ') AS w, sm_is_single_word('x y') AS v, sm_token_estimate('a, b') AS t,
        sm_char_count('a=b=c', '=') AS c, sm_offset_ok('abc', 'bc', 1) AS o, sm_offset_ok('abc', 'x', -1) AS p,
        sm_prefix_sums(array(3, 4, 5)) AS q, sm_strip(NULL) AS n""").first()
    assert tuple(row) == ("a b", True, False, True, False, 3, 2, True, False, [0, 3, 7], None)
    spark.createDataFrame([(1, "One. Two!  Three"), (2, None), (3, ""), (4, "x. y.")],
                          "id long, t string").createOrReplaceTempView("sm_texts")
    rows = "SELECT id, e.* FROM (SELECT {} AS id, sm_sentences({}) AS s FROM {}) LATERAL VIEW inline(s) e"
    got = spark.sql(rows.format("id", "t", "sm_texts") + " ORDER BY id, i")
    assert [tuple(r) for r in got.collect()] == [(1, 0, 0, 4, "One."), (1, 1, 5, 9, "Two!"), (1, 2, 11, 16, "Three"),
                                                 (3, 0, 0, 0, ""), (4, 0, 0, 5, "x. y.")]
    plan = spark.sql(rows.format("doc_id", "text", "parquet.`/root/testdata/sf0.001/documents.parquet`"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan


def test_sql_sentences_of_a_long_text(spark):
    from spanmill.functions.sql import install

    install(spark)
    spark.createDataFrame([("Ein Satz. " * 20_000,)], "t string").createOrReplaceTempView("sm_long")
    r = spark.sql("SELECT count(*) AS n, max(e.start) AS last FROM (SELECT sm_sentences(t) AS s FROM sm_long) "
                  "LATERAL VIEW inline(s) e").first()
    assert (r.n, r.last) == (20_000, 199_990)
