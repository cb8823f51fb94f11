"""Profiles kept by file, and the split sink in one pass."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spanmill.operators import profile_store as S
from spanmill.sources.jsonl import write_split

def values():
    return {"text": F.col("text"), "source": F.col("source")}


def rows_of(spark, ids):
    return spark.createDataFrame([(i, f"text {i % 700} " + "x" * (i % 90), f"src{min(i % 50, 5)}") for i in ids],
                                 "id long, text string, source string")


def test_a_new_file_updates_the_profile_without_the_others(spark, scratch):
    data, store = f"{scratch}/data", f"{scratch}/store"
    rows_of(spark, range(1000)).coalesce(1).write.parquet(data)
    assert S.update(spark, data, store, values()) == 1 and S.update(spark, data, store, values()) == 0
    first = {f for f in os.listdir(data) if f.endswith(".parquet")}
    rows_of(spark, range(900, 3000)).coalesce(1).write.mode("append").parquet(data)
    for name in first:  # the old file cannot be read any more; its sketches are enough
        stat = os.stat(f"{data}/{name}")
        with open(f"{data}/{name}", "r+b") as f:
            f.write(b"\0" * stat.st_size)
        os.utime(f"{data}/{name}", ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert S.update(spark, data, store, values()) == 1
    rows = [r for ids in (range(1000), range(900, 3000)) for r in
            ((f"text {i % 700} " + "x" * (i % 90), f"src{min(i % 50, 5)}") for i in ids)]
    got = {r.field: r for r in S.summary(spark, store, list(values())).collect()}
    assert got["text"].n_rows == 3100
    assert got["text"].n_distinct == len({t for t, _ in rows}) and got["source"].n_distinct == 6
    lengths = sorted(len(t) for t, _ in rows)
    for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
        at = [i for i, n in enumerate(lengths) if n == got["text"][name]]
        assert at and at[0] - 60 <= q * len(lengths) <= at[-1] + 60
    counts = Counter(s for _, s in rows)
    top = [(r.n) for r in S.frequent(spark, store, "source", 6).collect()]
    assert top == sorted(counts.values(), reverse=True)


def test_overlap_of_two_stores_and_error_beyond_the_exact_size(spark, scratch):
    for name, ids in (("a", range(0, 300_000)), ("b", range(200_000, 500_000))):
        spark.range(ids.start, ids.stop, 1, 4).select(
            F.col("id").cast("string").alias("text"), F.lit("s").alias("source")).write.parquet(f"{scratch}/{name}")
        assert S.update(spark, f"{scratch}/{name}", f"{scratch}/{name}-store", values()) == 4
    r = S.overlap(spark, f"{scratch}/a-store", "text", f"{scratch}/b-store", "text").first()
    assert abs(r.n_a / 300_000 - 1) < 0.02 and abs(r.n_b / 300_000 - 1) < 0.02
    assert abs(r.n_both / 100_000 - 1) < 0.04


def test_a_changed_file_counts_once(spark, scratch):
    data, store = f"{scratch}/d", f"{scratch}/s"
    rows_of(spark, range(10)).coalesce(1).write.parquet(data)
    S.update(spark, data, store, values())
    name = next(f for f in os.listdir(data) if f.endswith(".parquet"))
    rows_of(spark, range(25)).coalesce(1).write.parquet(f"{scratch}/other")
    other = next(f for f in os.listdir(f"{scratch}/other") if f.endswith(".parquet"))
    with open(f"{scratch}/other/{other}", "rb") as f:
        content = f.read()
    with open(f"{data}/{name}", "wb") as f:
        f.write(content)
    for f in os.listdir(data):
        if f.endswith(".crc"):
            os.remove(f"{data}/{f}")
    assert S.update(spark, data, store, values()) == 1
    assert S.summary(spark, store, ["text"]).first().n_rows == 25


def test_split_reads_once_and_keeps_old_outputs_on_failure(spark, scratch):
    reads = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda x: (reads.add(1), x)[1], "long")
    df = spark.range(10, numPartitions=1).select(seen("id").alias("id"), F.lit(None).cast("string").alias("n"))
    v, i = f"{scratch}/v", f"{scratch}/i"
    write_split(df.withColumn("ok", F.col("id") % 3 == 0), F.col("ok"), v, i, ["id", "n"])
    assert sorted(r.id for r in spark.read.json(v).collect()) == [0, 3, 6, 9] and reads.value == 10
    assert sorted(r.id for r in spark.read.json(i).collect()) == [1, 2, 4, 5, 7, 8]
    assert all('"n":null' in r.value for r in spark.read.text(v).collect())
    bad = spark.range(4).withColumn("ok", F.expr("if(id = 3, raise_error('stop'), id % 2 = 0)"))
    with pytest.raises(Exception, match="stop"):
        write_split(bad, F.col("ok").cast("boolean"), v, i)
    assert spark.read.json(v).count() == 4 and sorted(os.listdir(scratch)) == ["i", "v"]
    write_split(spark.range(3).withColumn("ok", F.lit(True)), F.col("ok"), v, i, ["id"])
    assert spark.read.json(v).count() == 3 and spark.read.schema("id long").json(i).count() == 0
