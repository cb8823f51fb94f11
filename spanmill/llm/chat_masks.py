"""Chat formatting with offset-aligned loss masks.

A conversation is rendered once, turn by turn, and encoded once with character offsets. Its
turns' spans and its tokens' spans are both sorted, so a binary search per turn finds the tokens
that lie in it. Control strings are tokens of their own and cannot occur inside a text: every
``<`` followed by backslashes and ``|`` gets one more backslash, which reading takes away again.

Turns stream through a task in order, so a conversation needs memory for one part at a time: a
part ends with the turn that brings it to PART_CHARS characters. Control tokens separate turns,
so the parts' tokens joined are those of the whole conversation."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches
from .encoders import byte_letters

#: The template's control strings.
START, SEP, FINISH = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Role whose texts are learned; characters of a part.
LEARNED, PART_CHARS = "assistant", 1_000_000
_MORE = re.compile(r"<(\\*)\|")
_LESS = re.compile(r"<(\\*)\\\|")
_TURN = re.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return _MORE.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _LESS.sub(r"<\1|", text)


@lru_cache(maxsize=2)
def chat_tokenizer(path: str):
    """The vocabulary with the control strings as special tokens behind its last id."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.add_special_tokens([START, SEP, FINISH])
    return t


@lru_cache(maxsize=2)
def id_bytes(path: str) -> list[bytes]:
    """Bytes of each id; a special token's are its string's."""
    t = chat_tokenizer(path)
    letters = {c: b for b, c in byte_letters().items()}
    special = {t.token_to_id(s): s for s in (START, SEP, FINISH)}
    special |= {i: a.content for i, a in t.get_added_tokens_decoder().items()}
    out = []
    for i in range(t.get_vocab_size()):
        token = t.id_to_token(i) or ""
        out.append(special[i].encode() if i in special else bytes(letters[c] for c in token))
    return out


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(role, text) pairs -> the formatted string and the spans of the learned texts in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        if role == LEARNED and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        out.append(f"{head}{body}{FINISH}\n")
        at += len(out[-1])
    return "".join(out), spans


def loss_mask(offsets: list[tuple[int, int]], spans: list[tuple[int, int]]) -> np.ndarray:
    """1 for each token whose offsets meet one of the sorted spans, by binary search."""
    mask = np.zeros(len(offsets), np.uint8)
    if not offsets or not spans:
        return mask
    tokens, turns = np.array(offsets), np.array(spans)
    first = np.searchsorted(tokens[:, 1], turns[:, 0], side="right")
    last = np.searchsorted(tokens[:, 0], turns[:, 1], side="left")
    for a, z in zip(first, last):
        mask[a:z] = 1
    return mask


def format_chats(turns: DataFrame, path: str) -> DataFrame:
    """turns (conv_id, turn, role, text, any others) -> conv_id, part, formatted, ids (binary,
    little-endian unsigned 32-bit), loss (binary, one byte a token), a conversation's parts in
    order behind each other within one partition.

    Null roles and texts are empty; turns are ordered by turn (null first), equal ones by role
    and text, so repeated rows are repeated turns. A null conv_id is a conversation too. An empty
    table gives no rows."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = chat_tokenizer(path)
        held: list[tuple[object, int, str, bytes, bytes]] = []
        conv, part, chars, waiting = object(), 0, 0, []

        def close():
            nonlocal part, chars, waiting
            text, spans = render(waiting)
            e = tok.encode(text, add_special_tokens=False)
            held.append((conv, part, text, np.array(e.ids, "<u4").tobytes(),
                         loss_mask(e.offsets, spans).tobytes()))
            part, chars, waiting = part + 1, 0, []

        def flush():
            names = ["conv_id", "part", "formatted", "ids", "loss"]
            kinds = [pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary()]
            batch = pa.RecordBatch.from_arrays(
                [pa.array([h[i] for h in held], k) for i, k in enumerate(kinds)], names)
            held.clear()
            return batch

        for b in batches:
            for c, role, text in zip(*(b.column(x).to_pylist() for x in ("conv_id", "role", "text"))):
                if c != conv and waiting:
                    close()
                if c != conv:
                    conv, part = c, 0
                waiting.append((role, text))
                chars += len(role) + len(text)
                if chars >= PART_CHARS:
                    close()
                if sum(len(h[2]) for h in held[-1:]) >= PART_CHARS or len(held) >= 500:
                    yield flush()
        if waiting:
            close()
        if held:
            yield flush()

    return map_batches(rows, parts, "conv_id long, part int, formatted string, ids binary, "
                                    "loss binary")


def learned_texts(ids: bytes, loss: bytes, path: str) -> list[str]:
    """The texts under a part's mask: every run of masked tokens, decoded and unescaped."""
    table, ids = id_bytes(path), np.frombuffer(ids, "<u4")
    mask = np.frombuffer(loss, np.uint8).astype(np.int8)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
    return [unescape(b"".join(map(table.__getitem__, ids[a:z].tolist())).decode("utf-8"))
            for a, z in zip(edge[::2].tolist(), edge[1::2].tolist())]


def digests(formatted: DataFrame, path: str) -> DataFrame:
    """format_chats() output (its partitions untouched) -> per conversation: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from the output."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()),
                        ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, out = object(), None, []

        def close():
            out.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(),
                        state[4]))

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)],
                schema=schema)
            out.clear()
            return batch

        for b in batches:
            for c, text, ids, loss in zip(*(b.column(x).to_pylist() for x in (
                    "conv_id", "formatted", "ids", "loss"))):
                if c != conv:
                    if state:
                        close()
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in _TURN.findall(text):
                    state[0] += 1
                    state[1].update(f"{unescape(role)}\n{unescape(body)}\n".encode())
                for learned in learned_texts(ids, loss, path):
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(text)
            if len(out) >= 1000:
                yield flush()
        if state:
            close()
        if out:
            yield flush()

    return map_batches(formatted, read, "conv_id long, n_turns long, turns_sha256 string, "
                       "loss_chars long, loss_sha256 string, formatted_chars long")
