"""The trie of conversation prefixes, its nodes found by vertical bitmaps.

A shard holds some thousand conversations, each a bit. For every position and turn there is a
bitset of the conversations that have this turn there. Starting with the bitset of all, the
intersection with the posting of a member's next turn gives a child, whose popcount counts its
conversations; a depth-first walk meets every node of the shard once. Nodes of several shards are
one node if their prefixes have the same digest.

A conversation may hold a large share of all turns, so it is cut into bands of BAND turns, and a
band starts from the digest of the turns before it. Sums over subtrees take pointer doubling:
after k rounds a node has summed its descendants up to 2^k levels below, so that a trie of depth d
needs log2(d) rounds, however it is shaped."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import with_group_row_number
from .common import map_batches, written

#: Turns in a band, and bands in a group of bands that has a digest of its own.
BAND, GROUP = 64, 1024
#: Bands of conversations in a shard.
SHARD = 4096
#: Conversations of one residue class share their head: ids are taken modulo this, and at most
#: HEAD - 1 turns are taken over.
FAMILY, HEAD = 5, 9
#: Ids are joined to text in chunks of 2^CHUNK_BITS consecutive values.
CHUNK_BITS = 16
ROOT = b""
_NODE = ("key binary, parent binary, depth long, conv_id long, n_convs long, bytes long, "
         "ends array<long>")


def turn_digest(role: Column, text: Column) -> Column:
    """Binary SHA-256 that two turns share only if both role and text are equal."""
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (0-based, by turn, null first, then digest), dig, bytes of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", F.col("turn").cast("long").alias("turn"), turn_digest(role, text).alias("dig"),
        F.octet_length(text).cast("long").alias("bytes"))
    return with_group_row_number(rows, ["conv_id"], ["turn", "dig"], "pos").select(
        "conv_id", "pos", "dig", "bytes")


def with_family_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """turns (conv_id, pos, dig, bytes) -> the same with every conversation c rebuilt: the first
    h turns of c - c % 5, then its own behind its first h, h = crc32(c) % 9; and (conv_id, total),
    the number of its turns, for each conversation that there was, even if none are left."""
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = sizes.select("conv_id", "n", first.alias("first"),
                         (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD).alias("h"))
    found = sizes.select(F.col("conv_id").alias("first"), F.col("n").alias("there"))
    convs = written(convs.join(found, "first", "left").withColumn(
        "head", F.least("h", F.coalesce("there", F.lit(0)))))
    own = turns.join(convs.select("conv_id", "h", "head"), "conv_id").where("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "dig", "bytes")
    heads = (turns.where((F.col("pos") < HEAD - 1) & (F.col("conv_id") % FAMILY == 0))
             .withColumnRenamed("conv_id", "first")
             .join(convs.select("conv_id", "first", "h"), "first").where("pos < h")
             .select("conv_id", "pos", "dig", "bytes"))
    total = F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return own.unionByName(heads), convs.select("conv_id", total.alias("total"))


def _joined(digests: Column) -> Column:
    return F.array_join(F.transform(digests, F.hex), "")


def _sorted_list(group, name: str, value: str):
    """Of a grouped table: the values in the order of the column ``name``, as an array."""
    rows = F.array_sort(F.collect_list(F.struct(name, value)))
    return group.agg(F.transform(rows, lambda x: x[value]).alias(value))


def _start_keys(bands: DataFrame) -> DataFrame:
    """bands (conv_id, band, digs) -> conv_id, band, key: the digest of all turns before a band,
    for every band that follows a full one (whether or not the conversation has it)."""
    full = bands.where(F.size("digs") == BAND).select(
        "conv_id", "band", F.unhex(F.sha2(_joined(F.col("digs")), 256)).alias("d"))
    groups = _sorted_list(full.withColumn("g", F.floor(F.col("band") / GROUP)).groupBy("conv_id", "g"),
                          "band", "d")
    whole = groups.where(F.size("d") == GROUP).select(
        "conv_id", "g", F.unhex(F.sha2(_joined(F.col("d")), 256)).alias("gd"))
    tops = _sorted_list(whole.groupBy("conv_id"), "g", "gd").select(
        "conv_id", F.posexplode(F.transform("gd", lambda _, i: F.sha2(_joined(
            F.slice("gd", F.lit(1), i + 1)), 256))).alias("i", "before"))
    tops = tops.select("conv_id", (F.col("i") + 1).cast("long").alias("g"), "before")
    starts = tops.select("conv_id", (F.col("g") * GROUP).alias("band"),
                         F.unhex(F.sha2(F.concat("before", F.lit("/")), 256)).alias("key"))
    inside = groups.join(tops, ["conv_id", "g"], "left").select(
        "conv_id", "g", F.posexplode(F.transform(F.slice("d", 1, GROUP - 1), lambda _, i: F.sha2(
            F.concat(F.coalesce("before", F.lit("")), F.lit("/"),
                     _joined(F.slice("d", F.lit(1), i + 1))), 256))).alias("i", "k"))
    return starts.unionByName(inside.select(
        "conv_id", (F.col("g") * GROUP + F.col("i") + 1).alias("band"), F.unhex("k").alias("key")))


def _bands(turns: DataFrame, totals: DataFrame) -> DataFrame:
    """conv_id, band, start (digest of what is before), next (of what is before the next band, if
    this one is full), last, digs, bytes."""
    cut = turns.withColumn("band", F.floor(F.col("pos") / BAND)).groupBy("conv_id", "band").agg(
        F.array_sort(F.collect_list(F.struct("pos", "dig", "bytes"))).alias("t"))
    bands = written(cut.select("conv_id", "band", F.col("t.dig").alias("digs"),
                               F.col("t.bytes").alias("bytes")))
    keys = written(_start_keys(bands))
    following = keys.select("conv_id", (F.col("band") - 1).alias("band"), F.col("key").alias("next"))
    return (bands.join(keys.withColumnRenamed("key", "start"), ["conv_id", "band"], "left")
            .join(following, ["conv_id", "band"], "left")
            .join(totals, "conv_id")
            .select("conv_id", "band", F.coalesce("start", F.lit(ROOT)).alias("start"), "next",
                    (F.col("band") * BAND + F.size("digs") == F.col("total")).alias("last"),
                    "digs", "bytes"))


def shard_nodes(rows: list[tuple]) -> Iterator[tuple]:
    """(conv_id, band, start, next, last, digs, bytes) rows of a shard -> its nodes: (key, parent,
    depth, smallest conv_id, conversations, bytes of the last text, conv_ids that end there)."""
    rows = sorted(rows, key=lambda r: (r[0], r[1]))  # the lowest bit is the smallest id
    postings: dict[tuple[int, bytes], int] = {}
    starts: dict[tuple[int, bytes], int] = {}
    ends: dict[int, int] = {}
    lengths: dict[int, int] = {}
    for i, (_, band, start, _, last, digs, _) in enumerate(rows):
        bit, n = 1 << i, len(digs)
        starts[band, start] = starts.get((band, start), 0) | bit
        lengths[n] = lengths.get(n, 0) | bit
        if last:
            ends[n] = ends.get(n, 0) | bit
        for d, turn in enumerate(digs):
            postings[d, turn] = postings.get((d, turn), 0) | bit
    for (band, start), members in starts.items():
        open_nodes = [(members, 0, start, hashlib.sha256(start))]
        while open_nodes:
            members, d, key, digest = open_nodes.pop()
            left = members & ~lengths.get(d, 0)
            while left:
                row = rows[(left & -left).bit_length() - 1]
                turn = row[5][d]
                child = left & postings[d, turn]
                left ^= child
                below = digest.copy()
                below.update(turn)
                name = row[3] if d + 1 == BAND else below.digest()
                over, done = child & ends.get(d + 1, 0), []
                while over:
                    low = over & -over
                    done.append(rows[low.bit_length() - 1][0])
                    over ^= low
                yield (name, key, band * BAND + d + 1, row[0], child.bit_count(), row[6][d], done)
                open_nodes.append((child, d + 1, name, below))


def _shards(bands: DataFrame) -> DataFrame:
    """The nodes of all shards, a node once per shard. Rows are dealt by (conv_id, band), so hot
    prefixes are spread, and sorted, so that a shard has few distinct ones."""
    dealt = bands.repartition("conv_id", "band").sortWithinPartitions("band", "start", "digs")
    names = ["conv_id", "band", "start", "next", "last", "digs", "bytes"]
    kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
             pa.list_(pa.int64())]
    out = [c.split()[0] for c in _NODE.split(", ")]

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            made: list[tuple] = []
            for node in shard_nodes(held):
                made.append(node)
                if len(made) == 20_000:
                    yield batch(made)
                    made.clear()
            if made:
                yield batch(made)
            held.clear()

        def batch(made: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(zip(*made), kinds)], out)

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in names)):
                held.append(row)
                if len(held) == SHARD:
                    yield from flush()
        yield from flush()

    return map_batches(dealt.select(*names), nodes, _NODE)


def _end_digests(ends: DataFrame) -> DataFrame:
    """ends (key, conv_id) -> key, sha: SHA-256 of the decimal ids, ascending, comma-joined.

    Chunks of ids are joined in parallel; a key's chunks then stream through one task in order,
    as its digest must, in memory for one chunk."""
    chunks = ends.groupBy("key", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(
        F.array_sort(F.collect_list("conv_id")).alias("ids"))
    chunks = chunks.select("key", "chunk", F.array_join(
        F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    chunks = chunks.repartition("key").sortWithinPartitions("key", "chunk")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None

        def batch(made: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in made], pa.binary()), pa.array([d for _, d in made])],
                ["key", "sha"])

        for b in batches:
            made = []
            for k, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist()):
                if k == key and digest is not None:
                    digest.update(b"," + ids.encode())
                    continue
                if digest is not None:
                    made.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(ids.encode())
            if made:
                yield batch(made)
        if digest is not None:
            yield batch([(key, digest.hexdigest())])

    return map_batches(chunks.select("key", "ids"), digests, "key binary, sha string")


def subtree_sums(nodes: DataFrame, sums: list[str], depth: int) -> DataFrame:
    """nodes (key, parent, the named numbers) of trees of at most the given depth -> key and the
    numbers summed over each node's subtree. A round doubles how far below a node it has summed,
    and its pointer to an ancestor with it."""
    state = nodes.select("key", F.col("parent").alias("up"), *sums)
    reach = 1
    while reach <= depth:
        live = state.where("up IS NOT NULL")
        add = live.groupBy(F.col("up").alias("key")).agg(*[F.sum(c).alias(f"_{c}") for c in sums])
        far = state.select(F.col("key").alias("up"), F.col("up").alias("far"))
        moved = live.join(far, "up").select("key", F.col("far").alias("up"), *sums)
        both = moved.unionByName(state.where("up IS NULL").select("key", "up", *sums))
        state = written(both.join(add, "key", "left").select("key", "up", *[
            (F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in sums]))
        reach *= 2
    return state.select("key", *sums)


def trie(turns: DataFrame, totals: DataFrame) -> DataFrame:
    """turns (conv_id, pos from 0 without gaps, dig, bytes) and totals (conv_id, total: its
    number of turns, 0 for one without) -> a row per distinct prefix, see prefix_trie()."""
    totals = written(totals)
    parts = written(_shards(_bands(turns, totals)))
    root = totals.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where(
        "n_convs > 0").select(F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"),
                              F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs",
                              F.lit(0).cast("long").alias("bytes"))
    found = parts.groupBy("key", "parent", "depth", "bytes").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"))
    found = found.unionByName(root)
    children = parts.select("key", "parent").distinct().groupBy(F.col("parent").alias("key")).agg(
        F.count("*").alias("n_children"))
    nodes = written(found.join(children, "key", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))).withColumns({
            "n_leaves": (F.col("n_children") == 0).cast("long"),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")}))
    depth = nodes.agg(F.coalesce(F.max("depth"), F.lit(0)).alias("d")).first().d
    sums = subtree_sums(nodes, ["n_leaves", "saved_tokens"], depth)
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    placed = nodes.where("parent IS NOT NULL").join(above, "parent").unionByName(
        nodes.where("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("long")))
    ends = parts.select("key", F.explode("ends").alias("conv_id")).unionByName(
        totals.where("total = 0").select(F.lit(ROOT).alias("key"), "conv_id"))
    return (placed.drop("n_leaves", "saved_tokens").join(sums, "key")
            .join(_end_digests(ends), "key", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                    "saved_tokens", F.coalesce("sha", F.lit(hashlib.sha256().hexdigest()))
                    .alias("ends_sha256")))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text, any others), rebuilt by with_family_heads() -> a
    row per distinct sequence of first turns, the empty one included: conv_id (the smallest that
    starts with it), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    Turns are ordered by turn, null first; equal ones by their digest, so repeated rows are
    repeated turns. Null roles and texts are empty. Rows without conv_id belong to no conversation
    and have no part. An empty table gives no rows."""
    turns = written(numbered_turns(conversations))
    return trie(*with_family_heads(turns))
