"""Packing of token pieces into sequences by bin completion.

Only lengths matter to a packing, and there are at most ``capacity`` of them. So the corpus is
reduced to a histogram of lengths, the histogram is packed into patterns (a list of lengths and
how often it is used), and every piece finds its place from its rank among the pieces of its
length. The histogram and the patterns do not grow with the corpus; ranks are counted in
buckets, so a length that very many pieces share is never ranked in one task.

The patterns come from a branch-and-bound: the longest piece left is completed by undominated
fillings (among equal sums fewer, larger pieces; nothing that another filling contains), the
waste bound prunes, and a best-fit-decreasing packing is the first incumbent."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .encoders import with_ids

#: Tokens of a sequence; id appended to each document.
CAPACITY, END = 1024, 2
#: Fillings tried at a node, pieces in a filling beside the longest, nodes of the search.
FILLINGS, MOST_ADDED, NODES = 3, 3, 3000
#: Documents ranked together.
BUCKET_ROWS = 20_000

Pattern = tuple[tuple[int, ...], int]


def lower_bound(counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """Sequences that no packing can do without: by the sum of the lengths, and by the pieces
    that cannot share a sequence with each other (Martello and Toth's second bound)."""
    lengths = sorted(k for k, c in counts.items() if c)
    total = sum(k * c for k, c in counts.items())
    best = -(-total // capacity)
    for alpha in lengths:
        if alpha > capacity // 2:
            break
        large = [(k, counts[k]) for k in lengths if k > capacity - alpha]
        middle = [(k, counts[k]) for k in lengths if capacity // 2 < k <= capacity - alpha]
        small = sum(k * counts[k] for k in lengths if alpha <= k <= capacity // 2)
        room = sum((capacity - k) * c for k, c in middle)
        need = sum(c for _, c in large) + sum(c for _, c in middle)
        best = max(best, need + max(0, -(-(small - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Best-fit decreasing over a histogram: sequences with equal contents move together."""
    open_: dict[int, list[Pattern]] = {}  # by room left
    done: list[Pattern] = []

    def put(room, pattern, n):
        if room:
            open_.setdefault(room, []).append((pattern, n))
        else:
            done.append((pattern, n))

    for k in sorted((k for k, c in counts.items() if c), reverse=True):
        left = counts[k]
        while left:
            room = min((r for r in open_ if r >= k), default=None)
            if room is None:
                each = capacity // k
                if left >= each:
                    put(capacity - each * k, (k,) * each, left // each)
                if left % each:
                    put(capacity - left % each * k, (k,) * (left % each), 1)
                break
            pattern, n = open_[room].pop()
            if not open_[room]:
                del open_[room]
            used = min(left, n)
            if n > used:
                put(room, pattern, n - used)
            put(room - k, (*pattern, k), used)
            left -= used
    return done + [p for group in open_.values() for p in group]


def _fillings(counts: np.ndarray, room: int) -> list[tuple[int, ...]]:
    """Undominated fillings of room, fullest first. counts: pieces left by length."""
    if room and counts[room]:
        return [(room,)]  # one piece that fills it: dominates every other filling
    have = [int(k) for k in np.flatnonzero(counts[:room + 1]) if k]
    if not have:
        return [()]
    one = sum(1 << k for k in have)
    mask = (1 << (room + 1)) - 1
    reach = [1, one]  # reach[j]: sums of j pieces, a length's count left aside
    for _ in range(MOST_ADDED - 1):
        nxt = 0
        for k in have:
            nxt |= reach[-1] << k
        reach.append(nxt & mask)

    def build(total: int, pieces: int, most: int, left: dict) -> tuple[int, ...] | None:
        """total as a sum of so many pieces of at most most, the largest first."""
        if pieces == 0:
            return () if total == 0 else None
        for k in reversed(have):
            if k <= most and k <= total and k * pieces >= total and reach[pieces - 1] >> (total - k) & 1:
                if left.get(k, int(counts[k])) > 0:
                    rest = build(total - k, pieces - 1, k,
                                 left | {k: left.get(k, int(counts[k])) - 1})
                    if rest is not None:
                        return (k, *rest)
        return None

    out: list[tuple[int, ...]] = []
    sums = 0
    for r in reach[1:]:
        sums |= r
    total = (sums & mask).bit_length() - 1
    while total > 0 and len(out) < FILLINGS:
        if sums >> total & 1:
            for j in range(1, MOST_ADDED + 1):
                if reach[j] >> total & 1 and (found := build(total, j, room, {})):
                    out.append(found)
                    break
        total -= 1
    return out or [()]


def pack(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[Pattern]:
    """{length: pieces} -> patterns (lengths in order, how often), as few sequences as found.

    Every branch uses a filling as often as the pieces allow; the search ends when the lower
    bound is met, the tree is done or ``nodes`` are spent."""
    best = best_fit(counts, capacity)
    size = sum(n for _, n in best)
    bound = lower_bound(counts, capacity)
    start = np.zeros(capacity + 1, np.int64)
    for k, c in counts.items():
        start[k] = c
    lengths = np.arange(capacity + 1)
    stack: list[tuple[np.ndarray, int, tuple]] = [(start, 0, ())]
    while stack and nodes and size > bound:
        left, used, chain = stack.pop()
        nodes -= 1
        if used + -(-int((left * lengths).sum()) // capacity) >= size:
            continue  # the waste so far already costs a sequence too many
        filled = np.flatnonzero(left)
        if not len(filled):
            best, size = [], used
            while chain:
                chain, pattern = chain
                best.append(pattern)
            continue
        top = int(filled[-1])
        rest = left.copy()
        rest[top] -= 1
        branches = []
        for filling in _fillings(rest, capacity - top):
            pattern = (top, *filling)
            room = capacity - sum(pattern)
            while filling and room >= pattern[-1] and left[pattern[-1]] > pattern.count(pattern[-1]):
                pattern += (pattern[-1],)  # small pieces may go on
                room -= pattern[-1]
            kinds, each = np.unique(pattern, return_counts=True)
            times = int((left[kinds] // each).min())
            after = left.copy()
            after[kinds] -= each * times
            branches.append((after, used + times, (chain, (pattern, times))))
        stack.extend(reversed(branches))  # the fullest filling is tried first
    return best


def tokens(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """docs (doc_id, text) -> a written table row, doc_id, ids (little-endian 16-bit numbers,
    with the end id), n. Null texts are empty."""
    encoded = with_ids(docs.select("doc_id", "text"), path, False, end, 2)
    return written(encoded.select(F.monotonically_increasing_id().alias("row"), "doc_id", "ids",
                                  (F.length("ids") / 2).cast("long").alias("n")))


def _places(sized: DataFrame, capacity: int) -> DataFrame:
    """sized (row, n) -> row, first (length of the first piece), sequence_id and offset of the
    first piece, full_id (id of the sequence of the next, full, piece; one less for each)."""
    cut = F.pmod(F.col("n") - 1, F.lit(capacity))
    parts = sized.select("row", (cut + 1).alias("first"),
                         F.floor((F.col("n") - 1) / capacity).cast("long").alias("full"))
    lengths = parts.groupBy("first").count().collect()  # at most capacity rows
    counts = {int(r["first"]): int(r["count"]) for r in lengths}
    buckets = max(1, -(-sum(counts.values()) // BUCKET_ROWS))
    slots, at, taken = [], 0, dict.fromkeys(counts, 0)
    for pattern, times in pack(counts, capacity):
        offset = 0
        for k in pattern:
            slots.append((k, taken[k], taken[k] + times, at - taken[k], offset))
            taken[k] += times
            offset += k
        at += times
    slot = sized.sparkSession.createDataFrame(
        slots, "length long, low long, high long, shift long, offset long")
    parts = parts.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    before = (parts.groupBy("first", "bucket").agg(F.count("*").alias("c"))
              .withColumn("before", F.sum("c").over(
                  Window.partitionBy("first").orderBy("bucket")) - F.col("c")).drop("c"))
    mine = Window.partitionBy("bucket").orderBy("row")
    ranked = parts.select(
        "row", "first", "bucket", "full", F.row_number().over(
            Window.partitionBy("bucket", "first").orderBy("row")).alias("rn"),
        F.sum("full").over(mine).alias("run"))
    ranked = (ranked.join(before, ["first", "bucket"])
              .withColumn("rank", F.col("before") + F.col("rn") - 1))
    # slots: a few rows for each of at most capacity lengths, whatever the corpus
    hit = ((F.col("first") == F.col("length")) & (F.col("rank") >= F.col("low"))
           & (F.col("rank") < F.col("high")))
    full_id = -1 - (F.col("bucket") * (1 << 40) + F.col("run") - F.col("full"))
    return ranked.join(F.broadcast(slot), hit).select(
        "row", "first", (F.col("rank") + F.col("shift")).alias("sequence_id"), "offset",
        full_id.alias("full_id"))


def packed(encoded: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """encoded (a written table of tokens()) -> a row per piece: doc_id, piece, start, length,
    ids (binary, little-endian 16-bit), sequence_id, offset.

    Documents longer than capacity are cut into full pieces, the first piece taking the rest.
    Sequences of full pieces have negative numbers. Repeated rows are packed each for itself;
    an empty table gives no rows."""
    placed = encoded.join(_places(encoded.select("row", "n"), capacity), "row")
    each = placed.select("*", F.explode(F.sequence(
        F.lit(0), ((F.col("n") - F.col("first")) / capacity).cast("int"))).alias("piece"))
    head = F.col("piece") == 0
    start = F.when(head, 0).otherwise(F.col("first") + (F.col("piece") - 1) * capacity)
    length = F.when(head, F.col("first")).otherwise(F.lit(capacity)).cast("long")
    return each.select(
        "doc_id", F.col("piece").cast("int"), start.cast("long").alias("start"),
        length.alias("length"),
        F.substring("ids", (2 * start + 1).cast("int"), (2 * length).cast("int")).alias("ids"),
        F.when(head, F.col("sequence_id")).otherwise(F.col("full_id") - (F.col("piece") - 1))
         .cast("long").alias("sequence_id"),
        F.when(head, F.col("offset")).otherwise(F.lit(0)).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """packed() of every row of docs (doc_id, text, any others), encoded by the tokenizer."""
    return packed(tokens(docs, path), capacity)


def sequences(pieces: DataFrame) -> DataFrame:
    """pieces -> sequence_id, ids: the pieces of each sequence (at most capacity ids) joined."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.expr("aggregate(p, cast('' as binary), (s, x) -> concat(s, x.ids))")
        .alias("ids"))
