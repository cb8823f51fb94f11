"""Negatives beyond the hard negatives.

J7 pairs every row with the rows at cyclic shifts 1..k of a seeded md5 permutation (an
equi-join on the shifted position, O(n*k), never all pairs). J8 scores those candidates
by cosine similarity of their embeddings (array expressions, JVM-side), keeps the ones at
or below a threshold and the ``top`` least similar per row (a window over at most k rows
per row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import scalar, with_row_number


def random_partners(df: DataFrame, id_col: str, k: int, seed: str) -> DataFrame:
    """(id, s, partner_id) for s = 1..k (partners differ from the row when k < n)."""
    h = F.md5(F.concat(F.lit(seed + "|"), F.col(id_col).cast("string")))
    ranked = with_row_number(df.select(id_col).withColumn("__h", h), ["__h", id_col], "__r").drop("__h")
    n = scalar(df, F.count(F.lit(1)))
    wanted = (ranked.withColumn("s", F.explode(F.sequence(F.lit(1), F.lit(k))))
              .withColumn("__t", F.pmod(F.col("__r") + F.col("s"), n)))
    targets = ranked.select(F.col("__r").alias("__t"), F.col(id_col).alias("partner_id"))
    return wanted.join(targets, "__t").select(id_col, F.col("s").cast("bigint").alias("s"), "partner_id")


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                      lambda acc, v: acc + v)
    na = F.aggregate(F.transform(a, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0),
                     lambda acc, v: acc + v)
    nb = F.aggregate(F.transform(b, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0),
                     lambda acc, v: acc + v)
    return F.when(na * nb > 0, dot / F.sqrt(na * nb))


def dissimilar_partners(df: DataFrame, id_col: str, vec_col: str, k: int, threshold: float,
                        top: int, seed: str) -> DataFrame:
    """(id, partner_id, cosine, rank) among J7 candidates with cosine <= threshold."""
    cand = random_partners(df, id_col, k, seed)
    vecs = df.select(id_col, vec_col)
    scored = (cand.join(vecs, id_col)
              .join(vecs.select(F.col(id_col).alias("partner_id"), F.col(vec_col).alias("__pv")), "partner_id")
              .withColumn("cosine", F.round(cosine(F.col(vec_col), F.col("__pv")), 6))
              .filter(F.col("cosine") <= threshold))
    w = Window.partitionBy(id_col).orderBy("cosine", "partner_id")
    return (scored.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= top)
            .select(id_col, "partner_id", "cosine", "rank"))
