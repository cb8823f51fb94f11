"""A2, A3, U1 and A4 kept up to date file by file, from mergeable sketches.

Every input file gets one row in a store (a Parquet table): a theta sketch per profiled column
(distinct values, overlaps), a KLL sketch of a column's lengths (quantiles) and a frequent-items
sketch (values that repeat often). A sketch's size is bounded by its parameters, so a store is
small beside its files. ``update`` reads only files that are new or have changed; ``summary``,
``overlap`` and ``frequent`` unite the sketches and read no input at all.

Error: a theta estimate is exact below 2^LG_NOMINAL distinct values and has a relative standard
error of 2^(-LG_NOMINAL/2) beyond; a KLL rank is exact for the first K_RANKS lengths and is off by
about 2.3 / K_RANKS beyond; a value that is more frequent than rows / ITEMS is always reported."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .profile import digest

LG_NOMINAL, K_RANKS, ITEMS = 16, 8191, 10_000


def _files(spark: SparkSession, path: str) -> DataFrame:
    """path, size, changed of the data files below a path; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


def _store(spark: SparkSession, store: str) -> DataFrame | None:
    try:
        return spark.read.parquet(store)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def update(spark: SparkSession, path: str, store: str, values: dict[str, Column]) -> int:
    """Sketch the files below ``path`` that the store has not seen in this state; returns how many.
    ``values``: the profiled string columns. Rerunning adds nothing; a file that was written anew
    is sketched again, and its last row counts."""
    files, known = _files(spark, path), _store(spark, store)
    if known is not None:
        files = files.join(known.select("path", "size", "changed"), ["path", "size", "changed"], "left_anti")
    new = [r.path for r in files.select("path").collect()]  # one name per new file
    if not new:
        return 0
    sketches = []
    for name, value in values.items():
        text = digest(value)
        sketches += [
            F.theta_sketch_agg(text, F.lit(LG_NOMINAL)).alias(f"{name}_distinct"),
            F.kll_sketch_agg_bigint(F.length(value).cast("long"), F.lit(K_RANKS)).alias(f"{name}_lengths"),
            F.expr(f"approx_top_k_accumulate(__{name}, {ITEMS})").alias(f"{name}_items")]
    rows = spark.read.parquet(*new).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("changed"), "*").withColumns(
            {f"__{n}": digest(v) for n, v in values.items()})
    made = rows.groupBy("path", "size", "changed").agg(F.count(F.lit(1)).alias("n_rows"), *sketches)
    made.withColumns({"run": F.lit(uuid.uuid4().hex), "at": F.current_timestamp()}).write.mode("append").parquet(store)
    return len(new)


def _latest(spark: SparkSession, store: str) -> DataFrame:
    """The store's last row per file."""
    last = Window.partitionBy("path").orderBy(F.desc("at"), F.desc("run"))
    return spark.read.parquet(store).withColumn("__k", F.row_number().over(last)).where("__k = 1").drop("__k")


def summary(spark: SparkSession, store: str, names: list[str]) -> DataFrame:
    """A2, A4: field, n_rows, n_distinct, and the quartiles of its lengths."""
    rows = _latest(spark, store)
    one = rows.agg(F.sum("n_rows").alias("n_rows"), *[x for n in names for x in (
        F.theta_sketch_estimate(F.theta_union_agg(f"{n}_distinct", F.lit(LG_NOMINAL))).alias(f"{n}_d"),
        F.kll_merge_agg_bigint(f"{n}_lengths").alias(f"{n}_l"))])
    quartile = lambda n, q: F.kll_sketch_get_quantile_bigint(f"{n}_l", F.lit(q))
    each = F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"{n}_d").alias("n_distinct"),
                              *[quartile(n, q).alias(c) for q, c in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
                     for n in names])
    return one.where("n_rows > 0").select("n_rows", F.inline(each)).select(
        "field", "n_rows", "n_distinct", "q25", "q50", "q75")


def overlap(spark: SparkSession, store_a: str, name_a: str, store_b: str, name_b: str) -> DataFrame:
    """n_a, n_b, n_both, the distinct values of two stores' columns and of both."""
    def united(store: str, name: str, out: str) -> DataFrame:
        return _latest(spark, store).agg(F.theta_union_agg(f"{name}_distinct", F.lit(LG_NOMINAL)).alias(out))

    both = united(store_a, name_a, "a").crossJoin(united(store_b, name_b, "b"))  # a row each
    return both.select(F.theta_sketch_estimate("a").alias("n_a"), F.theta_sketch_estimate("b").alias("n_b"),
                       F.theta_sketch_estimate(F.theta_intersection("a", "b")).alias("n_both"))


def frequent(spark: SparkSession, store: str, name: str, k: int) -> DataFrame:
    """A3: digest, n: the k most frequent values' digests with their estimated counts."""
    top = _latest(spark, store).agg(F.expr(f"approx_top_k_combine({name}_items, {ITEMS})").alias("s"))
    return top.select(F.explode(F.expr(f"approx_top_k_estimate(s, {k})")).alias("x")).select(
        F.col("x.item").alias("digest"), F.col("x.count").alias("n"))
