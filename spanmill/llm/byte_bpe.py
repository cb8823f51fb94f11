"""Byte-level BPE encoding and decoding from a rank file, with a hierarchical-bitmap rank queue.

A pre-token is a linked list of parts. Each rank has a bucket of list positions whose part and
its right neighbour merge at that rank. A bitmap in words of 256 bits marks the ranks with a
bucket, a second level marks the words that are not zero; finding the first set bit of both gives
the next rank in constant time. Its bucket is worked off from left to right, and entries whose
parts have changed since are skipped. A pair is
entered only while its rank is below the left neighbour's and not above the right one's: the next to
merge is always such a pair. Every merge touches two neighbours, so a pre-token of n
bytes takes about n steps, however long it is.

A text is cut at single spaces, which never lie inside a pre-token unless white space follows;
each distinct chunk is encoded once per Python worker (bounded cache)."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import map_batches
from .encoders import MARKS

#: Chunks kept per worker; characters whose chunks are looked up together.
CACHE_CHUNKS, GROUP_CHARS = 600_000, 4_000_000


#: Rank of a pair that never merges.
NEVER = 1 << 60


class RankQueue:
    """Positions by rank; pop() gives the least rank's positions in ascending order."""

    BIT = [1 << i for i in range(256)]

    def __init__(self, ranks: int):
        self.words = [0] * ((ranks >> 8) + 1)
        self.upper = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(position)
            return
        self.buckets[rank] = [position]
        at = rank >> 8
        word = self.words[at]
        self.words[at] = word | self.BIT[rank & 255]
        if not word:
            self.upper |= 1 << at

    def pop(self) -> tuple[int, list[int]] | None:
        upper = self.upper
        if not upper:
            return None
        first = upper & -upper
        at = first.bit_length() - 1
        word = self.words[at]
        low = word & -word
        self.words[at] = word ^ low
        if word == low:
            self.upper = upper ^ first
        rank = at << 8 | low.bit_length() - 1
        bucket = self.buckets.pop(rank)
        if len(bucket) > 1:
            bucket.sort()
        return rank, bucket


class Vocabulary:
    """ranks: bytes -> id. encode_piece() merges one pre-token, bytes_of[id] decodes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for b, r in ranks.items():
            self.bytes_of[r] = b
        self.queue = RankQueue(len(self.bytes_of))  # empty between pre-tokens
        self.pairs = [[NEVER] * 256 for _ in range(256)]
        for b, r in ranks.items():
            if len(b) == 2:
                self.pairs[b[0]][b[1]] = r

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        rank_of, queue, pairs, n = self.ranks.get, self.queue, self.pairs, len(piece)
        push = queue.push
        end = list(range(1, n + 1))  # the part at i is piece[i:end[i]]
        left = list(range(-1, n - 1))
        now = [pairs[a][b] for a, b in zip(piece, piece[1:])]  # at which i's part and the next merge
        now.append(NEVER)
        before = NEVER
        for i, rank in enumerate(now):
            if before > rank <= now[i + 1]:
                push(rank, i)
            before = rank
        pop = queue.pop
        while queue.upper:
            rank, bucket = pop()
            for k, i in enumerate(bucket):
                if now[i] != rank:
                    continue  # stale: merged away, or one of the two parts has changed
                while True:
                    mid = end[i]
                    stop = end[mid]
                    end[i], after, was = stop, NEVER, now[mid]
                    now[mid] = NEVER
                    if stop < n:
                        left[stop] = i
                        after = rank_of(piece[i:end[stop]], NEVER)
                    now[i] = after
                    before, joined = left[i], NEVER
                    if before >= 0:
                        old = now[before]
                        now[before] = joined = rank_of(piece[before:stop], NEVER)
                        least = now[left[before]] if before else NEVER
                        if least > joined <= after and joined < NEVER:
                            push(joined, before)
                        elif old < least <= joined and least < NEVER:  # no longer held up by its right
                            second = left[left[before]]
                            if second < 0 or now[second] > least:
                                push(least, left[before])
                    follow = now[stop] if stop < n else NEVER
                    if joined > after <= follow and after < NEVER:
                        push(after, i)
                    if not (was <= follow < after and follow <= now[end[stop]]):
                        break
                    # no longer held up by its left; of the same rank, it is the next in order
                    if follow > rank or joined < rank:
                        push(follow, stop)
                        break
                    i = stop
                if joined < rank or after < rank:  # a lesser rank goes before the rest of the bucket
                    for rest in bucket[k + 1:]:
                        push(rank, rest)
                    break
        ranks = self.ranks
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def encode_chunk(self, text: str) -> list[int]:
        out: list[int] = []
        for piece in self.pattern.findall(text):
            out += self.encode_piece(piece.encode("utf-8"))
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return Vocabulary(ranks, pattern)


class TextEncoder:
    """Whole texts to little-endian 32-bit ids, distinct chunks once."""

    def __init__(self, vocab: Vocabulary, limit: int = CACHE_CHUNKS):
        self.vocab, self.limit = vocab, limit
        self.known: dict[str, bytes | None] = {}  # of " " + chunk
        self.words: dict[str, bytes] = {}  # of a pre-token

    def _pieces(self, text: str) -> list[str]:
        """The pattern's matches; a space, a word and marks need no search."""
        if text[1:].isalpha() and text[0] == " ":
            return [text]
        core = text.rstrip(MARKS)
        if text[:1] == " " and core[1:].isalpha():
            return [core, text[len(core):]]
        return self.vocab.pattern.findall(text)

    def _bytes(self, text: str) -> bytes:
        if len(self.words) > self.limit:
            self.words.clear()
        out = []
        for piece in self._pieces(text):
            ids = self.words.get(piece)
            if ids is None:
                merged = self.vocab.encode_piece(piece.encode("utf-8"))
                ids = struct.pack(f"<{len(merged)}I", *merged)
                if len(piece) < 64:
                    self.words[piece] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for text in texts:
            first, *rest = text.split(" ")
            if len(self.known) > self.limit:
                self.known.clear()
            known = self.known
            for c in set(rest):
                if c not in known:
                    # no safe cut where white space follows the space
                    known[c] = None if not c or c[0].isspace() else self._bytes(" " + c)
            try:
                out.append(self._bytes(first) + b"".join(map(known.__getitem__, rest)))
            except TypeError:
                out.append(self._bytes(text))
        return out


@lru_cache(maxsize=2)
def text_encoder(path: str, pattern: str) -> TextEncoder:
    """One per Python worker, so that later tasks find the chunks of earlier ones."""
    return TextEncoder(vocabulary(path, pattern))


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """docs (doc_id, text, any others) -> doc_id, ids (binary, little-endian unsigned 32-bit),
    one row per row of docs. Null and empty texts have no ids; special strings are text."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path, pattern)
        for b in batches:
            ids = encoder.encode([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.binary())],
                                             ["doc_id", "ids"])

    return map_batches(docs.select("doc_id", "text"), encode, "doc_id long, ids binary")


def digests(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """rows (doc_id, ids) -> doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas)
    and decoded_sha256 (of the bytes that the ids decode to)."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        number = [str(i) for i in range(len(vocab.bytes_of))]
        for b in batches:
            counts, of_ids, of_bytes = [], [], []
            for data in b.column("ids").to_pylist():
                ids = np.frombuffer(data, "<u4").tolist()
                counts.append(len(ids))
                joined = ",".join(map(number.__getitem__, ids))
                of_ids.append(hashlib.sha256(joined.encode()).hexdigest())
                of_bytes.append(hashlib.sha256(vocab.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                 pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(rows, digest, "doc_id long, n_tokens long, ids_sha256 string, "
                                     "decoded_sha256 string")
