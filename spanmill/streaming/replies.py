"""Structured Streaming use of the row-local stages.

The original pipeline has no stream; the reply stage is the one place where rows arrive
over time (a model answers prompts one by one). Parsing a reply (F9, F8, X15, G3) holds
no cross-row state, so the same Column expressions run on a streaming DataFrame: replies
land as JSON lines in a folder, each micro-batch is parsed and written idempotently per
batch id (a rerun of a batch overwrites its own output), and the checkpoint location
makes the query survive restarts and executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.prompts import parse_replies
from ..options import GenerateOptions

REPLY_SCHEMA = T.StructType([
    T.StructField("ord", T.LongType()), T.StructField("question", T.StringType()),
    T.StructField("answer_span", T.StringType()), T.StructField("sentence_context", T.StringType()),
    T.StructField("response", T.StringType())])


def reply_stream(spark: SparkSession, replies_dir: str, max_files_per_trigger: int = 100) -> DataFrame:
    return (spark.readStream.schema(REPLY_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
            .json(replies_dir))


def parse_reply_stream(replies: DataFrame, opts: GenerateOptions = GenerateOptions()) -> tuple[DataFrame, DataFrame]:
    """Instruction rows and rejects of a streaming reply table (stateless)."""
    return parse_replies(replies, opts)


def start_instruction_sink(spark: SparkSession, replies_dir: str, out_dir: str, checkpoint: str,
                           opts: GenerateOptions = GenerateOptions(),
                           available_now: bool = True) -> StreamingQuery:
    """Parse replies as they arrive; each micro-batch writes ``out_dir/rows/batch=<id>`` and
    ``out_dir/rejects/batch=<id>`` (overwrite per batch id: exactly-once output)."""
    rows, rejects = parse_reply_stream(reply_stream(spark, replies_dir), opts)
    tagged = rows.select(F.lit("rows").alias("__kind"), F.to_json(F.struct(*rows.columns)).alias("value")) \
        .unionByName(rejects.select(F.lit("rejects").alias("__kind"),
                                    F.to_json(F.struct(*rejects.columns)).alias("value")))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        for kind in ("rows", "rejects"):
            (batch.filter(F.col("__kind") == kind).select("value")
             .write.mode("overwrite").text(f"{out_dir}/{kind}/batch={batch_id}"))

    writer = tagged.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
