"""Read the source tables with explicit schemas (no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMAS = {
    "documents": T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType())]),
    "conversations": T.StructType([
        T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]),
    "benchmark": T.StructType([
        T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())]),
    "labels": T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
        T.StructField("toxic", T.IntegerType())]),
    "embeddings": T.StructType([
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType())]),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Row-local text work is CPU-heavy. When the source yields fewer splits than the
    cluster has cores (a small single-row-group file), spread the rows round-robin;
    a large input already has enough splits and is left alone (no extra shuffle)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


class Tables:
    """Lazy access to the tables of one data folder. Derived views are memoised per
    instance, so a query that uses one view twice builds one plan (and Spark reuses
    its exchanges)."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = False):
        self.spark, self.sf_dir, self.materialize = spark, sf_dir, materialize
        self._views: dict = {}

    def view(self, name: str, build, heavy: bool = False):
        """``heavy`` views are checkpointed into the shared folder when the instance
        materializes (multi-stage plans read them several times)."""
        if name not in self._views:
            df = build()
            if heavy and self.materialize:
                from ..session import cut_lineage
                df = cut_lineage(df)
            self._views[name] = df
        return self._views[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)
