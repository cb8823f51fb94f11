"""Helpers shared by the operators: table access, written hand-overs, row keys, barriers."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Folder that holds the package, for Python workers that do not have it on their path.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Bytes of a row group, which a writing task holds in memory.
ROW_GROUP = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package (on a cluster: ship it with --py-files)."""
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


def written(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and read it back.

    Like ``checkpoint()`` this cuts the lineage and survives lost executors, but it keeps
    columns prunable, so that a second pass reads only what it needs."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def solid(col: Column) -> Column:
    """Barrier: the value is computed once and not inlined into later lambdas.

    The guard is always true but not deterministic, so the optimizer neither merges the
    projection with the next one nor pushes filters through it."""
    return F.when(F.spark_partition_id() >= 0, col)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]],
                schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def spread_rows(df: DataFrame) -> DataFrame:
    """Deal the rows of a small unsplit file over all cores; leave larger inputs alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def hex_of(data: bytes) -> str:
    import hashlib

    return hashlib.sha256(data).hexdigest()
