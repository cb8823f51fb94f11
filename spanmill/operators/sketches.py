"""Small mergeable summaries of hashed keys, as tables of a size that is bounded by a parameter.

Both cut a 64-bit hash into SLICES slices of BITS bits. A *bucket filter* is the set of slice
values of the keys sought: a row stays only if every slice of its hash is in the set, so the rows
that no key can meet end in the stage that made them. It may let strangers through (an equi-join
behind it decides) and never loses a row. A *frequency table* counts rows per slice value; the
least of a key's counts is at least its frequency, and close to it for a key that matters.

The tables have at most 2^BITS rows a slice, whatever the input, so they are broadcast. Partial
ones add up: counts by sum, sets by union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, SLICES = 20, 2


def slice_of(hashed: Column, s: int) -> Column:
    return F.shiftrightunsigned(hashed, s * BITS).bitwiseAND(F.lit((1 << BITS) - 1))


def bucket_filter(rows: DataFrame, keys: DataFrame, col: str = "h") -> DataFrame:
    """The rows whose hash in ``col`` may be among those of keys (every one that is, stays)."""
    for s in range(SLICES):
        held = keys.select(slice_of(F.col(col), s).alias(f"__s{s}")).distinct()
        rows = rows.withColumn(f"__s{s}", slice_of(F.col(col), s)).join(
            F.broadcast(held), f"__s{s}", "left_semi").drop(f"__s{s}")
    return rows


def frequencies(rows: DataFrame, col: str = "h") -> DataFrame:
    """(s, b, n): rows per slice and slice value."""
    cells = F.array(*[F.struct(F.lit(s).alias("s"), slice_of(F.col(col), s).alias("b"))
                      for s in range(SLICES)])
    return rows.select(F.inline(cells)).groupBy("s", "b").agg(F.count(F.lit(1)).alias("n"))


def with_frequency(keys: DataFrame, counted: DataFrame, name: str, col: str = "h") -> DataFrame:
    """keys with an upper bound of each hash's number of rows (0 if it has none)."""
    for s in range(SLICES):
        part = counted.where(F.col("s") == s).select(
            F.col("b").alias("__b"), F.col("n").alias(f"__n{s}"))
        keys = keys.join(F.broadcast(part), slice_of(F.col(col), s) == F.col("__b"), "left").drop("__b")
    least = F.least(*[F.coalesce(f"__n{s}", F.lit(0)) for s in range(SLICES)])
    return keys.withColumn(name, least).drop(*[f"__n{s}" for s in range(SLICES)])


def rarest(choices: DataFrame, rows: DataFrame, group: str, *ties: Column, col: str = "h") -> DataFrame:
    """(group, col): for each value of ``group`` the choice that the fewest rows have, by a
    frequency table of the rows that any choice can meet; ``ties`` decide between equals."""
    counted = frequencies(bucket_filter(rows.select(col), choices, col), col)
    ranked = with_frequency(choices, counted, "__f", col)
    best = F.min(F.struct(F.col("__f"), *[t.alias(f"t{i}") for i, t in enumerate(ties)],
                          F.col(col)))
    return ranked.groupBy(group).agg(best.alias("__m")).select(group, F.col(f"__m.{col}").alias(col))
