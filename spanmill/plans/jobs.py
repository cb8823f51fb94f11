"""The three stages as batch jobs that write their outputs (S4/S5), the way the original
scripts hand files to each other. Every write overwrites, so reruns do not grow outputs.

    python -m spanmill.plans.jobs subset   <sf_dir> <out_dir>
    python -m spanmill.plans.jobs generate <sf_dir> <out_dir>   # replies from the fixture rule
    python -m spanmill.plans.jobs dataset  <sf_dir> <out_dir>
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..options import AssembleOptions, GenerateOptions, SubsetOptions
from ..sources import fixtures as fx
from ..sources.jsonl import INSTRUCTION_SCHEMA, SUBSET_SCHEMA, read_jsonl, write_jsonl, write_split
from ..sources.tables import Tables
from .dataset import build_dataset
from .instructions import INSTRUCTION_COLUMNS, build_instructions, validate
from .subset import build_subset, subset_summary


def subset_job(spark: SparkSession, sf_dir: str, out: str, opts: SubsetOptions = SubsetOptions()) -> None:
    t = Tables(spark, sf_dir, materialize=True)
    r = build_subset(fx.keyed_items(t), fx.keyed_spans(t), opts, materialize=True, texts=fx.qa_texts(t))
    write_jsonl(r.rows.select("question", "answer_span", "sentence_context", "ord"), f"{out}/subset")
    write_jsonl(r.rejects.unionByName(fx.document_rejects(t)), f"{out}/subset_rejects")
    write_jsonl(subset_summary(r.cut), f"{out}/subset_summary")


def generate_job(spark: SparkSession, sf_dir: str, out: str, opts: GenerateOptions = GenerateOptions()) -> None:
    """Prompts are written for the model; replies are read back as a table. Here the
    reply table is the fixture rule over the subset (no model is called)."""
    schema = T.StructType([T.StructField("ord", T.LongType()), *SUBSET_SCHEMA.fields])
    subset, bad_lines = read_jsonl(spark, f"{out}/subset", schema, "read")
    r = build_instructions(subset, fx.responses(subset), opts, materialize=True)
    write_jsonl(r.prompts, f"{out}/prompts")
    write_jsonl(r.rows.select(*INSTRUCTION_COLUMNS), f"{out}/instructions")
    write_jsonl(r.rejects.unionByName(bad_lines), f"{out}/generate_rejects")
    v = validate(r.rows, fx.verdicts(Tables(spark, sf_dir)))
    judged = v.valid.withColumn("is_valid", F.lit(True)).unionByName(
        v.invalid.withColumn("is_valid", F.lit(False)))
    write_split(judged, F.col("is_valid"), f"{out}/valid_items", f"{out}/invalid_items", INSTRUCTION_COLUMNS)
    write_jsonl(v.rejects, f"{out}/validate_rejects")


def dataset_job(spark: SparkSession, sf_dir: str, out: str, opts: AssembleOptions = AssembleOptions(),
                source: str = "instructions") -> None:
    """``source``: ``instructions`` (all rows, as the original) or ``valid_items``."""
    schema = T.StructType([T.StructField("ord", T.LongType()), T.StructField("block", T.LongType())]
                          + list(INSTRUCTION_SCHEMA.fields))
    rows, bad_lines = read_jsonl(spark, f"{out}/{source}", schema, "read")
    t = Tables(spark, sf_dir, materialize=True)
    negatives = fx.negative_ids(t).withColumnRenamed("doc_id", "ord")
    r = build_dataset(spark, rows, fx.keyed_items(t), fx.qa_texts(t), negatives, opts)
    write_jsonl(r.rows.select("contexts", "question", "answer", "positive_ctx_idx", "pass", "i"), f"{out}/dataset")
    write_jsonl(r.rejects.unionByName(bad_lines), f"{out}/dataset_rejects")


JOBS = {"subset": subset_job, "generate": generate_job, "dataset": dataset_job}


def main(argv: list[str]) -> None:
    if len(argv) != 4 or argv[1] not in JOBS:
        raise SystemExit(__doc__)
    from ..session import build_session

    spark = build_session()
    JOBS[argv[1]](spark, argv[2], argv[3])


if __name__ == "__main__":
    main(sys.argv)
