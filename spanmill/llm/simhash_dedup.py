"""SimHash near-duplicates through deletion-variant signatures.

Fingerprints that differ in at most d bits, cut into d // 2 + 1 segments, agree in one of
them up to one bit. Each fingerprint is therefore indexed under every segment with each of
its bits left out in turn, and fingerprints that share such a variant are compared in full.
A variant shared by very many fingerprints is not compared pairwise: its members are indexed
once more by variants of the bits that are still free, in halves, until a variant is small or
so few bits are free that its size is bounded. All of it is exact."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, written
from .components import components

#: XXH64 seed of a shingle's hash.
SEED = 42
#: Words of a shingle and bits that linked fingerprints may differ in.
SHINGLE, MAX_BITS = 3, 2
#: Bytes of a text that are cut into words at a time.
BLOCK = 4_000_000
#: A variant with more fingerprints is split further; fewer are compared pairwise.
SMALL = 256
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_blocks(data: bytes, size: int):
    """Lists of a text's words; each list begins with the SHINGLE - 1 words before it."""
    pos, tail = 0, []
    while pos < len(data):
        cut = _SPACE.search(data, pos + size)
        end = cut.start() if cut else len(data)
        words = tail + data[pos:end].split()
        yield words
        tail, pos = words[-(SHINGLE - 1):], end


def fingerprint(data: bytes | None) -> int:
    """64-bit SimHash of a UTF-8 text's word shingles, as a signed integer; no words: 0."""
    data = (data or b"").lower()
    ones, n, few = np.zeros(64, np.int64), 0, []
    for words in _word_blocks(data, BLOCK):
        if len(words) < SHINGLE:
            few = words
            continue
        few = []
        text = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1).tolist()
        spans = zip([0, *ends[:-SHINGLE]], ends[SHINGLE - 1:])
        h = np.fromiter((xxhash.xxh64_intdigest(text[a:z - 1], SEED) for a, z in spans),
                        np.uint64, len(words) - SHINGLE + 1)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
        n += len(h)
    if few and not n:
        h = np.array([xxhash.xxh64_intdigest(b" ".join(few), SEED)], np.uint64)
        return int(h.view(np.int64)[0])
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add a long column: the SimHash of each whole text (null: empty)."""
    ship(docs.sparkSession)

    def batch(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py()) for t in texts], pa.int64())

    return docs.withColumn(out, F.arrow_udf(batch, "long")(F.col(text).cast("binary")))


def _index(rows: DataFrame, width: int) -> DataFrame:
    """rows (fp, key, low) whose bits [low, low + width) are free: under the key of every
    variant of both halves. low is then the first bit of the other half, which stays free."""
    half = width // 2
    each = []
    for at, free in ((0, half), (half, 0)):
        for bit in range(half):
            mask = ((1 << half) - 1) & ~(1 << bit)
            kept = F.expr(f"shiftrightunsigned(fp, low + {at}) & {mask}L")
            each.append(F.struct(F.xxhash64("key", "low", F.lit(at * 64 + bit), kept).alias("key"),
                                 (F.col("low") + free).alias("low")))
    return rows.select("fp", F.explode(F.array(*each)).alias("x")).select("fp", "x.*")


def _pairs(buckets: DataFrame, max_bits: int) -> DataFrame:
    """Links within each key's fingerprints (a bounded number)."""
    near = lambda a: F.transform(
        F.filter("fps", lambda b: (b > a) & (F.bit_count(a.bitwiseXOR(b)) <= max_bits)),
        lambda b: F.struct(a.alias("a"), b.alias("b")))
    return (buckets.groupBy("key").agg(F.collect_set("fp").alias("fps"))
            .select(F.explode(F.flatten(F.transform("fps", near))).alias("l")).select("l.*"))


def links(fps: DataFrame, max_bits: int = MAX_BITS, small: int = SMALL) -> DataFrame:
    """fps (fp long, distinct) -> links (a, b), a < b, of all pairs that differ in 1 to
    max_bits bits (1 to 3: two segments), some of them more than once."""
    if not 1 <= max_bits <= 3:
        raise ValueError("two segments serve 1 to 3 differing bits")
    rows = _index(fps.select("fp", F.lit(0).cast("long").alias("key"), F.lit(0).alias("low")), 64)
    out = None
    for width in (32, 16, 8):
        sized = rows.withColumn("n", F.count("*").over(Window.partitionBy("key")))
        # 8 free bits and three left out: at most 2 ** 11 different fingerprints in a variant
        whole = (F.col("n") > 1) if width == 8 else F.col("n").between(2, small)
        found = _pairs(sized.where(whole), max_bits)
        out = found if out is None else out.unionByName(found)
        rows = _index(sized.where(F.col("n") > small).select("fp", "key", "low"), width)
    return out


def grouped(fps: DataFrame, max_bits: int = MAX_BITS, id_col: str = "doc_id") -> DataFrame:
    """fps (a written table with id_col and fingerprint) -> the same rows with root, one
    fingerprint of their component, and component_id, the smallest id of all rows that links
    of at most max_bits bits reach."""
    classes = fps.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(id_col).alias("least_id"))
    roots = components(links(classes, max_bits))
    member = written(classes.join(roots, classes["fp"] == roots["node"], "left")
                     .select("fp", "least_id", F.coalesce("root", "fp").alias("root")))
    least = member.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of = member.join(least, "root").select(F.col("fp").alias("fingerprint"), "root", "component_id")
    return fps.join(of, "fingerprint")


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """docs (doc_id, text, any other columns) -> (doc_id, fingerprint long, component_id), one
    row per row of docs.

    Null and wordless texts have fingerprint zero and are linked like any other. Repeated ids
    are rows of their own; a null id is a member but never names a component unless no member
    has an id. An empty table gives no rows."""
    fps = written(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", "fingerprint"))
    return grouped(fps, max_bits).select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The row of smallest doc_id (nulls last) of each component, with all columns of docs."""
    names = docs.columns
    packed = docs.select(F.struct(*[docs[c] for c in names]).alias("doc"), docs["text"])
    rows = written(with_fingerprint(packed).select(
        "doc", "fingerprint", F.monotonically_increasing_id().alias("row"),
        F.col("doc.doc_id").alias("doc_id")))
    member = grouped(rows.select("row", "doc_id", "fingerprint"), max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))  # row: ties of ids
    kept = member.groupBy("root").agg(first.alias("m")).select(F.col("m.row").alias("row"))
    return rows.join(kept, "row", "left_semi").select("doc.*")
