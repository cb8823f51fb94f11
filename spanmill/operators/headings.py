"""Title and heading removal on contexts, as array expressions over lines.

Per context: split on newline; the first line must be a single word (else reject
``title_not_single_word``); drop it; drop one following empty line; drop one line with
at least two ``=``; if the next line is a single token, reject (``single_token_line``)
unless the item's answer is on the exception list, in which case that line is dropped
too; re-join with newline. The single-token test is the white-space word test (X19).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import char_count, is_single_word
from ..options import HEADING_EXCEPTION_ANSWERS


def strip_headings(df: DataFrame, text_col: str, answer_col: str | None = None,
                   exceptions=HEADING_EXCEPTION_ANSWERS) -> DataFrame:
    """Adds ``stripped`` (null when rejected) and ``reason``."""
    lines = F.split(F.col(text_col), "\n", -1)
    d = df.withColumn("__l0", lines)
    first_ok = F.coalesce(is_single_word(F.get(F.col("__l0"), 0)), F.lit(False))
    d = d.withColumn("__l1", F.slice("__l0", 2, F.greatest(F.size("__l0") - 1, F.lit(0))))
    d = d.withColumn("__l2", F.when(F.get(F.col("__l1"), 0) == "",
                                    F.slice("__l1", 2, F.greatest(F.size("__l1") - 1, F.lit(0))))
                     .otherwise(F.col("__l1")))
    d = d.withColumn("__l3", F.when(char_count(F.get(F.col("__l2"), 0), "=") >= 2,
                                    F.slice("__l2", 2, F.greatest(F.size("__l2") - 1, F.lit(0))))
                     .otherwise(F.col("__l2")))
    single_next = F.coalesce(is_single_word(F.get(F.col("__l3"), 0)), F.lit(False))
    excepted = (F.coalesce(F.col(answer_col).isin(list(exceptions)), F.lit(False))
                if answer_col else F.lit(False))
    d = d.withColumn("reason", F.when(~first_ok, F.lit("title_not_single_word"))
                     .when(single_next & ~excepted, F.lit("single_token_line")))
    final_lines = F.when(single_next & excepted, F.slice("__l3", 2, F.greatest(F.size("__l3") - 1, F.lit(0)))) \
        .otherwise(F.col("__l3"))
    d = d.withColumn("stripped", F.when(F.col("reason").isNull(), F.array_join(final_lines, "\n")))
    return d.drop("__l0", "__l1", "__l2", "__l3")


def line_profile(df: DataFrame, text_col: str) -> Column:
    """X19/X20 per text: number of lines, single-word lines and lines with >= 2 '='."""
    lines = F.split(F.col(text_col), "\n", -1)
    return F.struct(
        F.size(lines).cast("bigint").alias("n_lines"),
        F.size(F.filter(lines, lambda l: is_single_word(l))).cast("bigint").alias("n_single_word"),
        F.size(F.filter(lines, lambda l: char_count(l, "=") >= 2)).cast("bigint").alias("n_heading"))
