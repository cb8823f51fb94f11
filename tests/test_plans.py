"""Plan checks and a property check of the sentence offsets."""

from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from spanmill.functions.sentences import with_sentences

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    df = entry.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_python_in_core_plans(spark):
    for name in ("collapse_longest", "contain_join_anchor", "rederange_questions", "subset_rows"):
        plan = _plan(spark, name)
        for bad in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in plan, (name, bad)


def test_anchor_join_has_no_nested_loop(spark):
    plan = _plan(spark, "contain_join_anchor")
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BroadcastHashJoin" in plan or "SortMergeJoin" in plan


def test_short_needles_have_no_nested_loop(spark):
    for name in ("contain_join_anchor", "map_instructions"):
        plan = _plan(spark, name)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_row_numbers_build_without_a_job(spark):
    """Numbering is arithmetic on keys: nothing runs before the query itself."""
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    for name in ("sorted_by_length", "random_negatives", "length_upper_median"):
        entry.queries()[name](spark, SF)
    assert set(tracker.getJobIdsForGroup(None)) == before


def test_entry_one_is_computed_once(spark):
    for name, most in (("subset_rows", 15), ("parse_replies", 30), ("verdict_valid", 30), ("cap_rows", 40)):
        assert _plan(spark, name).count("FileScan") < most, name


def test_no_task_holds_a_table(spark):
    """Exchanges to a single partition carry counts, never rows of a table."""
    for name in ("collapse_longest", "sorted_by_length", "random_negatives", "duplicate_values"):
        df = entry.queries()[name](spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
        for i, line in enumerate(plan):
            if "Exchange SinglePartition" in line:
                assert any(w in plan[i + 1] for w in ("HashAggregate", "Project", "BroadcastExchange")), (name, plan[i + 1])


ALPHABET = st.sampled_from(list("ab .!?AÄB\n\t x"))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, min_size=0, max_size=60), min_size=1, max_size=8))
def test_sentence_offsets_cut_the_text(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in with_sentences(df, "t", "s").collect():
        t, s = row["t"], row["s"]
        assert [x["i"] for x in s] == list(range(len(s)))
        for x in s:
            assert t[x["start"]:x["end"]] == x["text"]
        starts = [x["start"] for x in s]
        assert starts == sorted(starts) and starts[0] == 0
