"""Global 0-based row numbers without a one-partition window over the rows.

``row_number() over (order by k)`` puts every row into one task. Here a row's bucket is
arithmetic on its order key: 2**16 consecutive values of an integer key, or the first four
digits of a hash. Rows are numbered inside their bucket, and bucket counts, summed in two
levels, give each bucket's offset. Nothing is sampled or collected and no job runs while the
plan is built; a retry after executor loss puts every row in the same bucket again.

An integer key is taken to be roughly dense (a position or id), so that a bucket has about
2**16 rows and the upper level one row per 2**28 keys. A sparse key still gives right numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_BITS, GROUP_BITS = 16, 28
HASH_DIGITS = 4


def _buckets(df: DataFrame, first: Column) -> tuple[Column, Column]:
    """(upper level, bucket) of the leading order key."""
    kind = df.select(first.alias("k")).schema["k"].dataType.typeName()
    if kind == "string":  # a hexadecimal hash; nulls come first in either case
        return F.coalesce(F.substring(first, 1, HASH_DIGITS), F.lit("")), F.lit(0)
    key = F.coalesce(first.cast("bigint"), F.lit(-(1 << 63)))
    return F.shiftright(key, GROUP_BITS), F.shiftright(key, ROWS_BITS)


def _numbered(df: DataFrame, group: list[str], top: Column, bucket: Column, order: list[Column],
              name: str) -> DataFrame:
    """0-based position within the group columns, through (top, bucket)."""
    tagged = df.withColumns({"__rn_t": top, "__rn_b": bucket})
    counts = tagged.groupBy(*group, "__rn_t", "__rn_b").agg(F.count(F.lit(1)).alias("__rn_n"))
    lower = Window.partitionBy(*group, "__rn_t").orderBy("__rn_b").rowsBetween(
        Window.unboundedPreceding, -1)
    upper = (Window.partitionBy(*(group or [F.lit(0)])).orderBy("__rn_t")
             .rowsBetween(Window.unboundedPreceding, -1))
    tops = (counts.groupBy(*group, "__rn_t").agg(F.sum("__rn_n").alias("__rn_n"))
            .select(*group, "__rn_t", F.coalesce(F.sum("__rn_n").over(upper), F.lit(0)).alias("__rn_u")))
    offsets = counts.withColumn("__rn_l", F.coalesce(F.sum("__rn_n").over(lower), F.lit(0)))
    offsets = _join(offsets.drop("__rn_n"), tops, group, ["__rn_t"]).select(
        *group, "__rn_t", "__rn_b", (F.col("__rn_l") + F.col("__rn_u")).alias("__rn_off"))
    inside = Window.partitionBy(*group, "__rn_t", "__rn_b").orderBy(*order)
    placed = tagged.withColumn("__rn_pos", F.row_number().over(inside) - 1)
    return (_join(placed, offsets, group, ["__rn_t", "__rn_b"])
            .withColumn(name, (F.col("__rn_off") + F.col("__rn_pos")).cast("bigint"))
            .drop("__rn_t", "__rn_b", "__rn_pos", "__rn_off"))


def _join(left: DataFrame, right: DataFrame, group: list[str], keys: list[str]) -> DataFrame:
    """Inner equi-join; null groups meet each other, the other keys are never null."""
    names = [*group, *keys]
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in names})
    on = F.lit(True)
    for k in names:
        mine, other = F.col(k), F.col(f"__r_{k}")
        on = on & (mine.eqNullSafe(other) if k in group else mine == other)
    return left.join(renamed, on).drop(*[f"__r_{k}" for k in names])


def with_row_number(df: DataFrame, order: list, name: str = "rn", top: Column | None = None,
                    bucket: Column | None = None) -> DataFrame:
    """Add ``name`` = 0-based position of the row in ``order`` (Columns or names; the last
    one unique). The leading key is an integer or a hexadecimal hash; for others, or a key
    with few values, give ``top`` and ``bucket``: (top, bucket) must follow the order."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    if top is None:
        top, inferred = _buckets(df, cols[0])
        bucket = inferred if bucket is None else bucket
    return _numbered(df, [], top, F.lit(0) if bucket is None else bucket, cols, name)


def with_group_row_number(df: DataFrame, group: list, order: list, name: str = "rn",
                          size_name: str | None = None) -> DataFrame:
    """0-based position inside each group (columns by name) and optionally the group's size.
    A hot group is spread over the buckets of its order key."""
    if any(not isinstance(c, str) for c in group):
        raise ValueError("group columns must be given by name")
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    top, bucket = _buckets(df, cols[0])
    out = _numbered(df, list(group), top, bucket, cols, name)
    if size_name:
        sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias(size_name))
        out = _join(out, sizes, list(group), [])
    return out


def scalar(df: DataFrame, expr: Column) -> Column:
    """A one-value aggregate used as a column (scalar subquery; no driver round trip)."""
    return df.select(expr).scalar()
