import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as PT
from tokenizers import Tokenizer

from spanmill.llm import bin_completion as B
from spanmill.llm.queries import QUERIES

PATH = PT.path("byte_bpe_50k.json")


def check_patterns(patterns, counts, capacity):
    used = Counter()
    for lengths, n in patterns:
        assert n > 0 and sum(lengths) <= capacity
        for k in lengths:
            used[k] += n
    assert used == Counter({k: c for k, c in counts.items() if c})
    return sum(n for _, n in patterns)


def optimum(items, capacity):
    """Fewest bins by exhaustive search (small inputs)."""
    items = sorted(items, reverse=True)
    best = len(items)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for room in set(bins):
            if room >= items[i]:
                rest = list(bins)
                rest[rest.index(room)] -= items[i]
                go(i + 1, rest)
        go(i + 1, [*bins, capacity - items[i]])

    go(0, [])
    return best


def test_small_packings_are_optimal():
    rnd = random.Random(5)
    worse = 0
    for _ in range(150):
        capacity = rnd.choice([10, 20, 31])
        items = [rnd.randint(1, capacity) for _ in range(rnd.randint(1, 11))]
        counts = Counter(items)
        best = optimum(items, capacity)
        assert B.lower_bound(counts, capacity) <= best
        size = check_patterns(B.pack(counts, capacity), counts, capacity)
        assert best <= size <= check_patterns(B.best_fit(counts, capacity), counts, capacity)
        worse += size > best
    assert worse <= 2  # fillings are limited to the fullest few


def test_large_histograms_reach_the_bound():
    rnd = random.Random(6)
    for scale in (1, 50, 10 ** 6):
        counts = {k: rnd.randint(0, 5) * scale for k in range(1, 1025)}
        size = check_patterns(B.pack(counts), counts, 1024)
        assert size <= B.lower_bound(counts) * 1.002 + 1
    assert check_patterns(B.pack({600: 10 ** 9, 1: 5}), {600: 10 ** 9, 1: 5}, 1024) == 10 ** 9
    assert check_patterns(B.pack({1: 2050}), {1: 2050}, 1024) == 3
    assert B.pack({}) == []


def check_pieces(rows, texts, capacity):
    """rows: the pieces; texts: (doc_id, text). Returns the number of sequences."""
    tok = Tokenizer.from_file(PATH)
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    want = Counter()
    for i, t in texts:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for p, (a, z) in enumerate(zip(cuts, cuts[1:])):
            want[i, p, a, z - a, zlib.crc32(ids[a:z].tobytes())] += 1
    crc = lambda r: getattr(r, "ids_crc32", None) or zlib.crc32(
        np.frombuffer(r.ids, "<u2").astype("<u4").tobytes())
    assert Counter((r.doc_id, r.piece, r.start, r.length, crc(r)) for r in rows) == want
    return len(by_seq)


def test_edge_documents(spark, docs, monkeypatch):
    rnd = random.Random(7)
    rows = [(1, None), (2, ""), (3, "x"), (3, "x"), (None, "no id"), (4, "word " * 5000),
            (5, "a" * 1023), (6, " ".join("ab" for _ in range(1023))), (7, "é😀 \n  z")]
    rows += [(100 + i, " ".join(rnd.choice("a bc def".split()) for _ in range(rnd.randint(1, 400))))
             for i in range(200)]
    table = docs([(*r, 9) for r in rows], ", piece long")
    for bucket in (B.BUCKET_ROWS, 10):
        monkeypatch.setattr(B, "BUCKET_ROWS", bucket)
        pieces = B.pack_documents(table, PATH)
        check_pieces(pieces.collect(), rows, 1024)
    small = B.pack_documents(table, PATH, 64)
    n = check_pieces(small.collect(), rows, 64)
    whole = B.sequences(small).collect()
    assert len(whole) == n and max(len(r.ids) for r in whole) <= 128
    assert B.pack_documents(docs([]), PATH).count() == 0


def test_whole_table(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = QUERIES["op10_bin_completion"](spark, sf_dir).collect()
    n = check_pieces(rows, texts, 1024)
    total = sum(r.length for r in rows)
    assert n <= -(-total // 1024) + 1
