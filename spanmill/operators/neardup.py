"""Reject a row when an earlier row's embedding is too close.

The rule: a row is dropped if any row with a smaller id has a cosine similarity of at least
``threshold`` to it, whether or not that row is itself kept. Equal vectors are collapsed first, so
a large group of copies costs one row. The others meet through cells: every vector lives in the
cell of its nearest pivot. With r the angle of the threshold, a vector within r of x lives in a
cell p with angle(x, p) <= angle(x, nearest) + 2r (the triangle inequality holds for angles). So x
visits those cells, and the exact cosine decides. A cell is dealt into blocks of bounded size; a
task holds one block and streams its visitors past it, as matrix products. Pivots are a fixed
number of rows chosen by a hash of their ids, whatever the input's size.

In many dimensions the bounds of this exact mode hardly exclude a cell, and it compares most pairs.
``mode="signatures"`` does not: see signature_near_duplicates(). It drops only rows that the rule
drops, and finds a close pair with a stated probability instead of always.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

PIVOTS = 24
#: Rounding of angles near a cell's edge must not lose a pair.
SLACK = 1e-6
#: Rows of a cell that meet as one matrix, visitors multiplied with them at a time, and how far the
#: matrix product may be from the sum in order.
BLOCK_ROWS, VISIT_ROWS, ROUNDING = 4096, 512, 1e-9


def _guarded(col: Column) -> Column:
    return F.when(F.spark_partition_id() >= 0, col)


def _unit(vec: str) -> Column:
    v = F.transform(vec, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(norm > 0, F.transform(v, lambda x: x / norm))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _angle(a: Column, b: Column) -> Column:
    return F.acos(F.greatest(F.least(_dot(a, b), F.lit(1.0)), F.lit(-1.0)))


def _classes(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """(ids of rows with an earlier equal vector, one row (id, u) per distinct direction)."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).filter(
        F.exists("v", lambda x: x != 0))
    classes = rows.groupBy("v").agg(F.min("id").alias("first"))
    copies = rows.join(classes, "v").filter(F.col("id") > F.col("first")).select("id")
    units = classes.select(F.col("first").alias("id"), _guarded(_unit("v")).alias("u")).filter(
        F.col("u").isNotNull())
    return copies, units


def near_duplicates(df: DataFrame, id_col: str, vec_col: str, threshold: float,
                    mode: str = "exact") -> DataFrame:
    """Ids of the rows that the rule drops. Rows without a vector, or with a zero vector, have no
    direction and are never dropped; equal ids of equal vectors are one row."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    if mode not in ("exact", "signatures"):
        raise ValueError(f"unknown mode {mode!r}")
    copies, units = _classes(df, id_col, vec_col)
    close = (exact_close if mode == "exact" else signature_near_duplicates)(units, threshold)
    # a class that is dropped takes its copies with it; these are dropped in any case
    return copies.unionByName(close).distinct().select(F.col("id").alias(id_col))


def exact_close(units: DataFrame, threshold: float) -> DataFrame:
    """units (id, u) -> the ids with an earlier unit vector within the threshold."""
    r = math.acos(threshold) + SLACK
    pivots = (units.orderBy(F.xxhash64("id"), "id").limit(PIVOTS)  # a fixed number of rows
              .agg(F.sort_array(F.collect_list(F.struct("id", "u"))).alias("pivots")))
    placed = units.withColumn("pivots", _guarded(pivots.scalar())).withColumn(
        "angles", _guarded(F.transform("pivots", lambda p: _angle(F.col("u"), p["u"])))).drop("pivots")
    near = F.array_min("angles")
    home = placed.select("id", "u", (F.array_position("angles", near) - 1).cast("int").alias("cell")).where(
        F.col("cell").isNotNull())
    cells = F.filter(F.transform("angles", lambda a, i: F.struct(i.alias("cell"), a.alias("a"))),
                     lambda c: c["a"] <= near + 2 * r)
    sizes = home.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("parts"))
    dim = F.size("u").alias("dim")  # vectors of different lengths have no cosine
    sizes = F.broadcast(sizes)  # a row per pivot at most
    homes = home.join(sizes, "cell").select(
        "id", "u", "cell", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part"), dim, F.lit(False).alias("visits"))
    visits = placed.select("id", "u", F.explode(F.transform(cells, lambda c: c["cell"])).alias("cell")).join(
        sizes, "cell").select("id", "u", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                              dim, F.lit(True).alias("visits"))
    tasks = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = homes.unionByName(visits).repartition(tasks, "cell", "part").sortWithinPartitions("cell", "part", "dim", "visits")
    kind = units.schema["id"].dataType.simpleString()
    return met.mapInArrow(_met_blocks(threshold), f"id {kind}").distinct()


def _met_blocks(threshold: float):
    """Batches of (id, u, cell, part, dim, visits), a block's own rows first: the ids of visitors with an
    earlier row of the block within the threshold. Products near it are summed anew in the order of
    the vector, so that the matrix product's rounding decides nothing. Not a number counts as close,
    as in Spark's comparison."""
    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, rows = None, [], []
        for b in batches:
            id_, visits = b.column("id").to_numpy(zero_copy_only=False), b.column("visits").to_numpy(zero_copy_only=False)
            keys = np.stack([b.column(k).to_numpy() for k in ("cell", "part", "dim")])
            turns = np.flatnonzero((np.diff(keys) != 0).any(0) | (np.diff(visits.astype(int)) != 0)) + 1
            found = []
            for lo, hi in zip([0, *turns], [*turns, b.num_rows]):
                if hi == lo:
                    continue
                if block != (at := tuple(keys[:, lo])):
                    block, ids, rows = at, [], []
                u = b.column("u").slice(lo, hi - lo).flatten().to_numpy().reshape(hi - lo, at[2])
                if not visits[lo]:
                    ids.append(id_[lo:hi])
                    rows.append(u)
                    continue
                if not ids:
                    continue
                if len(ids) > 1:
                    ids, rows = [np.concatenate(ids)], [np.concatenate(rows)]
                for k in range(0, hi - lo, VISIT_ROWS):
                    found.append(_close_rows(id_[lo + k:min(hi, lo + k + VISIT_ROWS)], u[k:k + VISIT_ROWS],
                                             ids[0], rows[0], threshold))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found), b.schema.field("id").type)], ["id"])

    return met


def _close_rows(ids: np.ndarray, u: np.ndarray, home_ids: np.ndarray, home: np.ndarray,
                threshold: float) -> np.ndarray:
    earlier = home_ids[None, :] < ids[:, None]
    products = u @ home.T
    close = (earlier & ~(products < threshold + ROUNDING)).any(1)
    x, y = np.nonzero(earlier & (np.abs(products - threshold) <= ROUNDING) & ~close[:, None])
    for k in range(0, len(x), BLOCK_ROWS):
        a, b = x[k:k + BLOCK_ROWS], y[k:k + BLOCK_ROWS]
        close[a[np.add.accumulate(u[a] * home[b], axis=1)[:, -1] >= threshold]] = True
    return ids[close]


#: Signature mode: probability with which a pair exactly at the threshold shares a cell; most rows
#: of a cell that meet as a whole; bits of a sketch and how many standard deviations of its
#: distance at the threshold are let through; rows from which the planes' offsets are taken.
RECALL, CELL_ROWS, SKETCH_BITS, SKETCH_SIGMAS, OFFSET_ROWS = 0.97, 1024, 256, 4, 4096


def signature_sizes(n: int, threshold: float) -> tuple[int, int]:
    """(bits, tables): bits so that n spread rows have about one row a cell, and as many tables as
    RECALL takes if a row visits its own cell and those that differ in one bit."""
    bits = min(max(math.ceil(math.log2(max(n, 2))), 4), 40)
    p = math.acos(threshold) / math.pi  # a plane parts a pair at the threshold
    one = (1 - p) ** bits + bits * p * (1 - p) ** (bits - 1)
    return bits, max(1, math.ceil(math.log(1 - RECALL) / math.log(max(1 - one, 1e-9))))


def _planes(dim: int, bits: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """Planes of the tables, orthogonal in groups of dim, and of the sketch."""
    r = np.random.default_rng(20)
    groups = [np.linalg.qr(r.normal(size=(dim, dim)))[0]
              for _ in range(-(-bits * tables // dim))]
    return np.concatenate(groups, 1)[:, :bits * tables], r.normal(size=(dim, SKETCH_BITS))


def signatures(units: DataFrame, threshold: float) -> tuple[DataFrame, int]:
    """units (id, u) -> (id, codes: a cell number per table, sketch: 64-bit words), and the bits
    of a code. A plane is moved to the mean of a bounded sample, so that vectors with a common
    part still spread over the cells (the median would cut through a group of near copies that
    holds most rows). Vectors of another length than the sample's raise."""
    sample = units.orderBy(F.xxhash64("id"), "id").limit(OFFSET_ROWS).select("u").toArrow()
    vectors = sample["u"].to_pylist()
    dim = len(vectors[0]) if vectors else 1
    bits, tables = signature_sizes(units.count(), threshold)
    planes, sketch = _planes(dim, bits, tables)
    offsets = np.mean(np.array(vectors) @ planes, 0) if vectors else np.zeros(bits * tables)
    weights = np.left_shift(np.int64(1), np.arange(bits, dtype=np.int64))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u = b.column("u").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dim)
            codes = ((u @ planes > offsets).reshape(b.num_rows, tables, bits) @ weights).reshape(-1)
            words = np.packbits(u @ sketch > 0, axis=1).view("<i8").reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), _lists(codes, tables), _lists(words, SKETCH_BITS // 64)],
                ["id", "codes", "sketch"])

    kind = units.schema["id"].dataType.simpleString()
    return units.mapInArrow(signed, f"id {kind}, codes array<bigint>, sketch array<bigint>"), bits


def _lists(values: np.ndarray, size: int) -> pa.ListArray:
    offsets = np.arange(0, len(values) + 1, size, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64)))


def _visits(signed: DataFrame, bits: int) -> DataFrame:
    """id, sketch, t, cell: a row per visited cell, the own one and those one bit away."""
    flips = F.concat(F.array(F.lit(0).cast("long")), F.transform(
        F.sequence(F.lit(0), F.lit(bits - 1)), lambda i: F.pow(F.lit(2.0), i).cast("long")))
    return signed.select("id", "sketch", F.posexplode("codes").alias("t", "own"), flips.alias("f")).select(
        "id", "sketch", "t", F.explode(F.transform("f", lambda f: F.col("own").bitwiseXOR(f))).alias("cell"))


def _apart(a: str, b: str) -> Column:
    """Bits in which two sketches differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0),
                       lambda s, x: s + x)


def _close_pairs(pairs: DataFrame, units: DataFrame, threshold: float) -> DataFrame:
    """pairs (id, home_id) -> ids of those whose exact cosine reaches the threshold."""
    mine = units.select("id", F.col("u").alias("__a"))
    other = units.select(F.col("id").alias("home_id"), F.col("u").alias("__b"))
    return pairs.join(mine, "id").join(other, "home_id").filter(
        _dot(F.col("__a"), F.col("__b")) >= threshold).select("id").distinct()


def signature_pairs(visits: DataFrame, home: DataFrame) -> DataFrame:
    """(id, sketch, home_id, home_sketch): each visiting row with the earlier rows of the cell.
    A cell of more than CELL_ROWS rows is dealt into parts of about that many, which a visitor
    meets one by one in different groups, so no group of the join is larger."""
    sizes = home.groupBy("t", "cell").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > CELL_ROWS).select(
        "t", "cell", F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    dealt = home.join(large, ["t", "cell"], "left").select(
        "t", "cell", F.pmod(F.xxhash64("home_id"), parts).cast("int").alias("part"), "home_id", "home_sketch")
    seen = visits.join(large, ["t", "cell"], "left").select(
        "id", "sketch", "t", "cell", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    return seen.join(dealt, ["t", "cell", "part"]).where(F.col("home_id") < F.col("id")).select(
        "id", "sketch", "home_id", "home_sketch")


def signature_near_duplicates(units: DataFrame, threshold: float) -> DataFrame:
    """units (id, u) -> ids with an earlier unit vector within the threshold, by random planes.

    A row lives in one cell per table, the signs of its products with that table's planes, and
    visits this cell and those one bit away. Candidates within reach by their sketches are
    verified by the exact cosine, so nothing is dropped that the rule keeps. Visitors first meet
    the earliest row of a cell; who is close to it is decided and visits no more, which ends most
    of the work in a large group of near copies. The others meet the whole cell."""
    units = cut_lineage(units)
    signed, bits = signatures(units, threshold)
    signed = cut_lineage(signed)
    p = math.acos(threshold) / math.pi
    reach = SKETCH_BITS * p + SKETCH_SIGMAS * math.sqrt(SKETCH_BITS * p * (1 - p))
    visits = _visits(signed, bits)
    home = signed.select(F.col("id").alias("home_id"), F.col("sketch").alias("home_sketch"),
                         F.posexplode("codes").alias("t", "cell"))
    leaders = home.groupBy("t", "cell").agg(F.min(F.struct("home_id", "home_sketch")).alias("m")).select(
        "t", "cell", "m.home_id", "m.home_sketch")
    near = lambda d: d.where(_apart("sketch", "home_sketch") <= reach).select(
        "id", "home_id").distinct()
    first = visits.join(leaders, ["t", "cell"]).where(F.col("home_id") < F.col("id"))
    decided = cut_lineage(_close_pairs(near(first), units, threshold))
    rest = _visits(signed.join(decided, "id", "left_anti"), bits)
    found = _close_pairs(near(signature_pairs(rest, home)), units, threshold)
    return decided.unionByName(found)


def near_dup_reject(df: DataFrame, id_col: str, vec_col: str, threshold: float,
                    mode: str = "exact") -> tuple[DataFrame, DataFrame]:
    """(kept rows, rejects): rejects carry the reason ``near_duplicate``."""
    dropped = near_duplicates(df, id_col, vec_col, threshold, mode)
    rejects = dropped.select(F.lit("generate").alias("stage"), F.col(id_col).cast("string").alias("key"),
                             F.lit("near_duplicate").alias("reason"))
    return df.join(dropped, id_col, "left_anti"), rejects
