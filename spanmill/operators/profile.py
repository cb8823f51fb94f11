"""Profiling: overlaps, duplicates, length statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_digits
from .ranking import scalar, with_row_number


def distinct_overlap(a: DataFrame, b: DataFrame, col_a: Column, col_b: Column) -> DataFrame:
    """Distinct values of each side and of their intersection, with one shuffle:
    both sides are tagged, unioned and grouped by the value's digest (map-side combine first)."""
    tagged = (a.select(digest(col_a).alias("v"), F.lit(True).alias("in_a"), F.lit(False).alias("in_b"))
              .unionByName(b.select(digest(col_b).alias("v"), F.lit(False).alias("in_a"),
                                    F.lit(True).alias("in_b"))))
    per_value = tagged.filter(F.col("v").isNotNull()).groupBy("v").agg(
        F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    return per_value.agg(F.count_if("in_a").alias("n_a"), F.count_if("in_b").alias("n_b"),
                         F.count_if(F.col("in_a") & F.col("in_b")).alias("n_both"))


def digest(value: Column) -> Column:
    """Fixed-size stand-in for a long text in groupings and joins."""
    return F.sha2(value, 256)


def distinct_counts(df: DataFrame, columns: dict[str, Column], approx: bool = False) -> DataFrame:
    """A2: distinct values per column in one pass over (column, digest) pairs; ``approx``
    uses HyperLogLog++ (bounded memory per column)."""
    if approx:
        return df.agg(*[F.approx_count_distinct(c, 0.01).cast("bigint").alias(name)
                        for name, c in columns.items()])
    names = list(columns)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), digest(columns[n]).alias("v"))
                               for i, n in enumerate(names)]))
    seen = df.select(each.alias("x")).select("x.*").where(F.col("v").isNotNull()).distinct()
    return seen.agg(*[F.count_if(F.col("c") == i).alias(n) for i, n in enumerate(names)])


def duplicated_values(df: DataFrame, value: Column, ord_col: str = "ord", by: list[str] = ()) -> DataFrame:
    """A3: values seen more than once (within ``by``), with their count and first-seen ord. Groups
    are formed on digests; only values that are there more than once travel, once each."""
    key = F.coalesce(digest(value.cast("string")), F.lit(""))
    seen = (df.groupBy(*by, key.alias("__d"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(ord_col).alias("first_ord"))
            .filter(F.col("n") > 1))
    first = df.select(F.col(ord_col).alias("first_ord"), key.alias("__d"), value.alias("value"))
    # an ord may stand several times: one row of the value is as good as another
    named = (seen.join(first, ["first_ord", "__d"]).dropDuplicates([*by, "__d"]))
    return named.select(*by, "value", "n", "first_ord")


def duplicated_rows(df: DataFrame, value: Column, ord_col: str = "ord") -> DataFrame:
    """Every row whose value occurs more than once (keep all members), sorted by
    value then ord. Keys via A3, rows via a left-semi join (no wide window)."""
    keyed = df.withColumn("__v", value)
    keys = duplicated_values(keyed, F.col("__v"), ord_col).select(F.col("value").alias("__v"))
    return keyed.join(keys, "__v", "left_semi").orderBy("__v", ord_col).drop("__v")


def describe_lengths(df: DataFrame, length: Column) -> DataFrame:
    """A4: count, mean, sample std, min, linear quartiles, max."""
    x = length.cast("double")
    q = F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    r = lambda c: F.round(c, 6).cast("double")
    return df.agg(F.count(x).alias("count"), r(F.avg(x)).alias("mean"), r(F.stddev_samp(x)).alias("std"),
                  r(F.min(x)).alias("min"), q.alias("__q"), r(F.max(x)).alias("max")) \
        .select("count", "mean", "std", "min", r(F.col("__q")[0]).alias("q25"),
                r(F.col("__q")[1]).alias("q50"), r(F.col("__q")[2]).alias("q75"), "max")


def length_extremes(df: DataFrame, length: Column, value: Column, question: Column,
                    ord_col: str = "ord") -> DataFrame:
    """A5: longest value, shortest value and the question of the shortest; ties -> first."""
    o = F.col(ord_col)
    longest = F.max(F.struct(length.alias("l"), (-o).alias("o"), value.alias("v")))
    shortest = F.min(F.struct(length.alias("l"), o.alias("o"), value.alias("v"), question.alias("q")))
    return df.agg(longest.alias("a"), shortest.alias("b")).select(
        F.col("a.v").alias("longest"), F.col("b.v").alias("shortest"),
        F.col("b.q").alias("question_of_shortest"))


def sorted_positions(df: DataFrame, length: Column, ord_col: str = "ord", name: str = "pos") -> DataFrame:
    """O1: stable sort by length (ties by ord) as a 0-based position column."""
    keyed = df.withColumn("__len", F.coalesce(length, F.lit(-1)))
    return with_row_number(keyed, ["__len", ord_col], name, top=F.col("__len"),
                           bucket=F.shiftright(F.col(ord_col).cast("bigint"), 16)).drop("__len")


def _holding(sizes: DataFrame, key: str, k: Column) -> Column:
    """struct(key, rest) of the group that holds the k-th row, rest counting from its first row;
    sizes (key, n) has a row per group. A scalar: no driver round trip."""
    before = F.coalesce(F.sum("n").over(
        Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = sizes.withColumn("__b", before).where((F.col("__b") <= k) & (k < F.col("__b") + F.col("n")))
    return found.select(F.struct(F.col(key).alias("key"), (k - F.col("__b")).alias("rest"))).scalar()


def upper_median(df: DataFrame, length: Column, ord_col: str = "ord") -> DataFrame:
    """The row at position n div 2 of the stable sort by length.

    Selection instead of a sort: counts by length name the length and how many of its rows come
    first, counts of those rows by the high bits of ord name a block of 2^16 ords, and only that
    block's rows are put in order."""
    keyed = df.withColumns({"__len": F.coalesce(length, F.lit(-1)),
                            "__blk": F.shiftright(F.col(ord_col).cast("bigint"), 16)})
    half = F.floor(scalar(df, F.count(F.lit(1))) / 2)
    at = _holding(keyed.groupBy("__len").agg(F.count(F.lit(1)).alias("n")), "__len", half)
    same = keyed.where(F.col("__len") == at["key"])
    block = _holding(same.groupBy("__blk").agg(F.count(F.lit(1)).alias("n")), "__blk", at["rest"])
    last = same.where(F.col("__blk") == block["key"]).withColumn(
        "__pos", F.row_number().over(Window.orderBy(ord_col)) - 1)
    return last.where(F.col("__pos") == block["rest"]).drop("__len", "__blk", "__pos")


def digit_count(df: DataFrame, value: Column) -> DataFrame:
    """Rows whose value is all digits."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(is_digits(value)).alias("n_digits"))


def first_n(df: DataFrame, n: int, ord_col: str = "ord") -> DataFrame:
    """The first n rows by ord (a top-k: each task keeps n rows, then one merge)."""
    return df.orderBy(ord_col).limit(n)


def members(df: DataFrame, value: Column, probes: DataFrame) -> DataFrame:
    """for each probe value, whether it occurs (left-semi existence per probe)."""
    present = df.select(value.alias("probe")).join(probes.select("probe"), "probe", "left_semi").distinct()
    return probes.join(present.withColumn("present", F.lit(True)), "probe", "left") \
        .select("probe", F.coalesce("present", F.lit(False)).alias("present"))
