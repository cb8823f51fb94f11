"""Whole-text encoding with a public tokenizer, through a bounded cache of chunks.

A text is cut at single spaces. For a byte-level vocabulary whose pattern binds one space
to the word behind it, such a cut never lies inside a token, unless white space follows the
space; those rare texts are encoded in one piece by the library, as are texts that hold one of
the vocabulary's special strings. For a vocabulary that drops white space every space is such a
cut. Each distinct chunk is encoded by the library once and kept as little-endian unsigned
32-bit ids, so a document is a join of byte strings."""

from __future__ import annotations

import os
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

#: Chunks kept per Python worker (about 150 MB); beyond it a group's new chunks are forgotten.
CACHE_CHUNKS = 700_000
#: Characters whose unknown chunks are encoded in one call.
GROUP_CHARS = 4_000_000
#: A run of these behind a word is a piece of its own in either pattern.
MARKS = ".,!?;:*#$%&|)"
#: Letters below this are Latin; their lower case is one letter, whatever stands beside it,
#: but for the second one here.
LATIN_END, DOTTED = "\u0250", "\u0130"


def byte_letters() -> dict[int, str]:
    """Byte -> letter of byte-level vocabularies: printable bytes stand for themselves, the
    others follow from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _latin(word: str) -> bool:
    return word.isalpha() and max(word) < LATIN_END and DOTTED not in word


class ChunkEncoder:
    """encode(texts) gives each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, drops_space: bool, limit: int = CACHE_CHUNKS):
        self.tok, self.drops_space, self.limit = tokenizer(path), drops_space, limit
        self.model, self.letters = self.tok.model, byte_letters()
        #: strings that the library cuts a text at before anything else
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.heads: dict[str, bytes | None] = {}
        self.rest: dict[str, bytes | None] = self.heads if drops_space else {}
        self.marks: dict[str, bytes] = {}
        self.newline = self._whole("\n")

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str, lead: str) -> bytes:
        """Ids of one run of Latin letters: a single piece of the pattern, so the library's
        merge model can take it without the steps before it."""
        if self.drops_space:
            word = unicodedata.normalize("NFC", word).lower()
        piece = (lead + word).encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _split(self, known: dict, c: str, lead: str) -> bytes | None:
        """Ids of a chunk that is a word, a word and marks, or lines of such; else None."""
        if c.isalpha():
            return self._word(c, lead) if _latin(c) else None
        core = c.rstrip(MARKS)
        if core and _latin(core):
            if (ids := known.get(core)) is None:
                ids = known[core] = self._word(core, lead)
            if (tail := self.marks.get(c[len(core):])) is None:
                if len(self.marks) > 10_000:
                    self.marks.clear()
                tail = self.marks[c[len(core):]] = self._whole(c[len(core):])
            return ids + tail
        above, cut, below = c.partition("\n")
        if cut and above and below and not above[-1].isspace() and not below[0].isspace():
            first = known.get(above) or self._split(known, above, lead)
            heads = self.heads
            second = first and (heads.get(below) or self._split(heads, below, ""))
            return first + self.newline + second if second else None
        return None

    def _learn(self, known: dict, chunks: set, lead: str) -> None:
        mixed = []
        for c in chunks:
            if c in known:
                continue
            if not self.drops_space and (not c or c[0].isspace()):
                known[c] = None  # white space around the cut: not a safe one
            elif (ids := self._split(known, c, lead)) is not None:
                known[c] = ids
            else:
                mixed.append(c)
        encoded = self.tok.encode_batch_fast([lead + c for c in mixed], add_special_tokens=False)
        for c, e in zip(mixed, encoded):
            known[c] = np.array(e.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        i = 0
        while i < len(texts):
            group, chars, whole = [], 0, {}
            while i < len(texts) and (not group or chars + len(texts[i]) <= GROUP_CHARS):
                if any(s in texts[i] for s in self.special):
                    whole[len(out) + len(group)] = texts[i]
                group.append([""] if len(out) + len(group) in whole else texts[i].split(" "))
                chars += len(texts[i])
                i += 1
            out += self._group(group)
            for k, text in whole.items():
                out[k] = self._whole(text)
        return out

    def _group(self, group: list[list[str]]) -> list[bytes]:
        first = {p[0] for p in group}
        later = set().union(*(p[1:] for p in group))
        if self.drops_space:
            later |= first
        heads, rest = self.heads, self.rest
        if len(rest) + len(later) > self.limit:  # full: new chunks serve this group alone
            rest = {c: rest[c] for c in later if c in rest}
            if len(rest) < len(later) // 2:  # other texts than before: start anew
                self.rest.clear()
            heads = rest if self.drops_space else heads
        if not self.drops_space:
            if len(heads) + len(first) > self.limit:
                heads.clear()
            self._learn(heads, first, "")
        self._learn(rest, later, "" if self.drops_space else " ")
        out = []
        for p in group:
            try:
                out.append(heads[p[0]] + b"".join(map(rest.__getitem__, p[1:])))
            except TypeError:
                out.append(self._whole(" ".join(p)))
        return out


@lru_cache(maxsize=4)
def chunk_encoder(path: str, drops_space: bool) -> ChunkEncoder:
    """One per Python worker, so that later tasks find the chunks of earlier ones."""
    return ChunkEncoder(path, drops_space)


def packed_ids(ids: bytes, end: int, width: int) -> bytes:
    """Little-endian 32-bit ids with the end id behind them, in width bytes each."""
    data = np.frombuffer(ids + struct.pack("<I", end), "<u4")
    return ids + struct.pack("<I", end) if width == 4 else data.astype("<u2").tobytes()


def with_ids(docs: DataFrame, path: str, drops_space: bool, end: int, width: int,
             text: str = "text", out: str = "ids") -> DataFrame:
    """Add a binary column: the ids of each whole text (null: empty) and the end id."""
    ship(docs.sparkSession)

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = chunk_encoder(path, drops_space)
        for texts in batches:
            ids = encoder.encode([t or "" for t in texts.to_pylist()])
            yield pa.array([packed_ids(x, end, width) for x in ids], pa.binary())

    # the hints are read at run time
    encode.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(out, F.arrow_udf(encode, "binary")(F.col(text)))


def crc32_wide(ids: str) -> Column:
    """Unsigned crc32 of 16-bit ids widened to little-endian unsigned 32-bit integers."""
    def crc(batch: pa.Array) -> pa.Array:
        return pa.array([zlib.crc32(np.frombuffer(x.as_py(), "<u2").astype("<u4").tobytes())
                         for x in batch], pa.int64())

    crc.__annotations__ = {"batch": pa.Array, "return": pa.Array}
    return F.arrow_udf(crc, "long")(F.col(ids))
