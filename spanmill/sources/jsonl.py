"""JSON-lines sources and sinks, the two-way split sink and the nested span
reader. Reads always use an explicit schema; writes always overwrite (reruns do not grow
outputs)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import with_row_number

CORRUPT = "_corrupt_record"

INSTRUCTION_SCHEMA = T.StructType([
    T.StructField("instruction", T.StringType()), T.StructField("response", T.StringType()),
    T.StructField("category", T.StringType())])
SUBSET_SCHEMA = T.StructType([
    T.StructField("question", T.StringType()), T.StructField("answer_span", T.StringType()),
    T.StructField("sentence_context", T.StringType())])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType,
               stage: str = "read") -> tuple[DataFrame, DataFrame]:
    """S3: one object per line with an explicit schema; unparsable lines go to rejects
    (stage, key = the raw line, reason). Lines are read as text and parsed with
    ``from_json`` (PERMISSIVE), so the corrupt-record column is an ordinary column."""
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    parsed = lines.select(F.from_json("value", with_corrupt, {"mode": "PERMISSIVE",
                                                              "columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    ok = parsed.filter(F.col(f"r.{CORRUPT}").isNull()).select(*[F.col(f"r.{f.name}") for f in schema.fields])
    bad = parsed.filter(F.col(f"r.{CORRUPT}").isNotNull()).select(
        F.lit(stage).alias("stage"), F.col(f"r.{CORRUPT}").alias("key"), F.lit("corrupt_line").alias("reason"))
    return ok, bad


def write_jsonl(df: DataFrame, path: str) -> None:
    """Overwrite, one object per row; null fields are written as null (not dropped)."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def _file_system(spark: SparkSession, path: str):
    """(file system of a path, path class), so that stores other than local disks work too."""
    jvm = spark.sparkContext._jvm
    make = jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def write_split(df: DataFrame, predicate: Column, valid_path: str, invalid_path: str,
                columns: list[str] | None = None) -> None:
    """One input, two outputs (rows where the predicate is true / false), optionally
    restricted to ``columns``. Both sides are written in one pass over the input, into a hidden
    folder beside the first output that the job's commit completes; only then each side replaces
    its old output by a rename. A job that fails leaves the old outputs as they were."""
    spark, cols = df.sparkSession, columns or df.columns
    staged = f"{valid_path.rstrip('/')}.split-{uuid.uuid4().hex}"
    fs, make = _file_system(spark, staged)
    sides = {"valid": valid_path, "invalid": invalid_path}
    # the guard is always true but not deterministic: the predicate is not evaluated again below
    side = F.when(F.spark_partition_id() >= 0, F.when(predicate, "valid").when(~predicate, "invalid"))
    try:
        (df.select(*cols, side.alias("__side")).where(F.col("__side").isNotNull())
         .write.partitionBy("__side").option("ignoreNullFields", "false").json(staged))
        for name, target in sides.items():
            part = make(f"{staged}/__side={name}")
            fs.mkdirs(part)  # a side may be empty
            fs.create(make(f"{staged}/__side={name}/_SUCCESS"), True).close()
            fs.delete(make(target), True)
            fs.mkdirs(make(target).getParent())
            if not fs.rename(part, make(target)):
                raise OSError(f"cannot move {part} to {target}")
    finally:
        fs.delete(make(staged), True)


def to_json_lines(df: DataFrame) -> DataFrame:
    """Rows as JSON text (nulls kept)."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


NESTED_SCHEMA = T.StructType([T.StructField("data", T.ArrayType(T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("paragraphs", T.ArrayType(T.StructType([
        T.StructField("context", T.StringType()),
        T.StructField("qas", T.ArrayType(T.StructType([
            T.StructField("id", T.StringType()),
            T.StructField("question", T.StringType()),
            T.StructField("answers", T.ArrayType(T.StructType([
                T.StructField("text", T.StringType()),
                T.StructField("answer_start", T.IntegerType())])))])))])))])))])


def _nested_files(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*NESTED_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(schema).option("multiLine", "true")
            .option("columnNameOfCorruptRecord", CORRUPT).json(path)
            .withColumn("__file", F.input_file_name()))


def nested_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Files that ``read_nested_spans`` cannot use: unreadable, or without a data list."""
    return _nested_files(spark, path).filter(F.col("data").isNull()).select(
        F.lit("read").alias("stage"), F.col("__file").alias("key"), F.lit("corrupt_file").alias("reason"))


def read_nested_spans(spark: SparkSession, path: str) -> DataFrame:
    """Article / paragraph / question files (one JSON document per file) as span
    items (question, context, answers{text, answer_start}, title, ord). ``ord`` follows
    file, article, paragraph and question order."""
    docs = _nested_files(spark, path)
    art = docs.select("__file", F.posexplode("data").alias("__a", "a"))
    par = art.select("__file", "__a", F.col("a.title").alias("title"),
                     F.posexplode("a.paragraphs").alias("__p", "p"))
    qas = par.select("__file", "__a", "__p", "title", F.col("p.context").alias("context"),
                     F.posexplode("p.qas").alias("__q", "qa"))
    items = qas.select("__file", "__a", "__p", "__q", "title", "context",
                       F.col("qa.question").alias("question"),
                       F.struct(F.col("qa.answers.text").alias("text"),
                                F.col("qa.answers.answer_start").alias("answer_start")).alias("answers"))
    ranked = with_row_number(items, ["__file", "__a", "__p", "__q"], "ord", top=F.col("__file"),
                             bucket=F.col("__a"))
    return ranked.select("question", "context", "answers", "title", "ord")
