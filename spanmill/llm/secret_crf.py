"""Secrets: three fixed patterns, and a linear-chain conditional random field that tags tokens as
the begin, the inside or the outside of a secret.

A token is a run of letters and digits or one other character, with the white space before it. Its
features are its own shape, the tokens up to four before and one after it, and figures of the
whole text. The field is trained in numpy on windows of the corpus itself: around what the fixed
patterns find and from hash-chosen other places, at most SAMPLE of each. Windows with a secret are
repeated with other values, key words and separators, so that tags follow from shape and
surroundings rather than from the patterns; values exchanged for plain words are outside.

Decoding is exact but touches few tokens. Scores are taken relative to the path that is outside
everywhere. A token's bound is its best inside score plus the best inside transition; in a best
path no beginning of a secret may sum to less than a constant, so the Viterbi recursion only runs
where such sums can lie, and every other token is outside."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, written

#: The kinds in their order within one start; the last one is the field's own.
KINDS = ["assign", "access", "hex", "crf"]
BASE = KINDS[:3]
#: The base patterns. Case is ignored for ASCII letters only.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.A | re.I)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]{14,}"), re.compile(r"[0-9a-f]{16,}")
#: What the training windows are found by, for the engine.
LIKELY = (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{14}|"
          r"[0-9a-f]{16}")
#: Windows of each kind in the fit, characters before and after a secret; fewest and most copies of
#: a window with a secret, and how many such copies there should be in all.
SAMPLE, BEFORE, AFTER, COPIES, COPIED = 800, 160, 60, (4, 24), 4000
#: Windows' tokens of a name that make it a feature.
LEAST = 3
BUCKETS, EPOCHS, BATCH, RATE, DECAY, TOKENS = 1 << 16, 4, 32, 0.2, 1e-5, 96
#: Tokens remembered by a Python worker; characters of a text that are read at a time.
KNOWN, BLOCK = 400_000, 500_000
#: Neighbours whose identity is a feature.
AROUND = (-4, -3, -2, -1, 1)
OUT, BEGIN, IN = 0, 1, 2
_HEX_BYTES = np.isin(np.arange(256), list(b"0123456789abcdef"))
_TOKEN = re.compile(r"\s*(?:[^\W_]+|[^\w\s]|_)")
#: Key words and separators that copies of a window use.
NAMES = ["password", "passwd", "secret", "token", "api_key", "apikey", "pwd", "pass", "auth",
         "credential", "private_key", "client_secret", "access_key", "bearer", "passphrase"]
JOINS = [" = \"", "=\"", ": \"", " = '", "=", ": ", " := ", " => \"", " "]
_UPPER, _LOWER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABETS = ["0123456789abcdef", "0123456789ABCDEF", _UPPER + _DIGIT, _LOWER + _DIGIT,
             _UPPER + _LOWER + _DIGIT, _UPPER + _LOWER + _DIGIT + "+/",
             _UPPER + _LOWER + _DIGIT + "-_", _UPPER + _LOWER + _DIGIT + "!@#$%"]


def _may_hold_hex(text: str) -> bool:
    """Whether 16 of HEX's characters stand side by side, by doubling the length tested."""
    run = _HEX_BYTES[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]
    for step in (1, 2, 4, 8):
        run = run[:-step] & run[step:]
    return bool(run.any())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns' matches, sorted. Each pattern has a cheap test
    that no text it matches fails."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    if len(text) > 15 and _may_hold_hex(text):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _bucket(n: int) -> int:
    """Half octaves."""
    return n if n < 4 else 2 * n.bit_length() + (n >> (n.bit_length() - 2) & 1)


def _kind(c: str) -> str:
    return "d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c


def _shape(core: str) -> str:
    """Runs of digits, upper and lower case, at most five of them, and how many there are."""
    runs, before = [], ""
    for c in core[:200]:
        if (k := _kind(c)) != before:
            runs.append(k)
            before = k
    return "".join(runs[:5]) + (f"+{min(len(runs), 20) // 3}" if len(runs) > 5 else "")


def _hash(*parts: object) -> int:
    return 1 + zlib.crc32(" ".join(map(str, parts)).encode("utf-8", "surrogatepass")) % (BUCKETS - 1)


def token_class(token: str) -> tuple[str, tuple]:
    """A token's name (what its neighbours may go by) and its class (what it looks like)."""
    core = token.lstrip()
    n = len(core)
    space = "-" if n == len(token) else "s" if token[0] == " " else "n" if "\n" in token[:-n] else "s"
    alpha = core.isalpha()
    size = n if n < 8 else 5 + _bucket(min(n, 512))
    if alpha and n < 12:  # most words
        if core.islower():
            return core, ("x", size, "-", space, -1, 0)
        if core.istitle():
            return core.lower(), ("Xx", size, "-", space, -1, 0)
    shape, low, same = _shape(core), core[:40].lower(), "-"
    if n > 7:
        same = "hex" if not core.strip("0123456789abcdef") else "HEX" if not core.strip(
            "0123456789ABCDEF") else "-"
    vowels = sum(map(low.count, "aeiou")) * 5 // min(n, 40) if alpha and n > 11 else -1
    odd = int((not alpha and not core.isdigit() and n > 3) or n > 24)
    name = low if alpha and n <= 16 or n == 1 else ""
    return name, (shape, size, same, space, vowels, odd)


def class_features(kind: tuple) -> tuple[list[int], list[list[int]]]:
    """Feature numbers of a token of this class: its own, and those it gives a token that has it
    at each place AROUND."""
    shape, size, same, space, vowels, odd = kind
    own = [_hash("b"), _hash("s", shape), _hash("n", size), _hash("sn", shape, size),
           _hash("h", same, size), _hash("l", space), _hash("ls", space, shape),
           _hash("v", vowels, size), _hash("o", odd, space)]
    around = [[_hash("as", k, shape, size > 12)] + ([_hash("al", k, space)] if k == 1 else [])
              for k in AROUND]
    return own, around


def name_features(name: str) -> tuple[list[int], list[list[int]]]:
    """The same of a token's name."""
    return [_hash("w", name)], [[_hash("a", k, name)] for k in AROUND]


def file_features(text: str) -> tuple[list[int], list[int]]:
    """Feature numbers of a whole text, for usual and for unusual tokens."""
    n = max(len(text), 1)
    times = np.bincount(np.frombuffer(text.encode("latin-1", "replace"), np.uint8), minlength=256)
    facts = [(name, min(_bucket(int(times[list(chars)].sum()) * scale // n), 9)) for name, chars, scale in (
        ("=", b"=", 2000), (":", b":", 2000), ("{;", b"{;", 2000), ("n", b"\n", 1000),
        ("0", b"0123456789", 500))]
    return ([_hash("f", *f, 0) for f in facts], [_hash("f", *f, 1) for f in facts])


def tokens_of(text: str) -> list[tuple[int, int, str]]:
    """(start, end, token with its leading white space); start is behind that space."""
    return [(m.end() - len(m.group().lstrip()), m.end(), m.group()) for m in _TOKEN.finditer(text)]


def _sequence(text: str, spans: list[tuple[int, int]], whole: tuple[list[int], list[int]],
              names: set[str]):
    """Feature lists and tags of a window's tokens; spans are the secrets in it."""
    toks = tokens_of(text)[:TOKENS]
    seen = []
    for _, _, token in toks:
        name, kind = token_class(token)
        own, around = class_features(kind)
        more, beside = name_features(name if name in names else "")
        seen.append((own + more + whole[kind[-1]], [x + y for x, y in zip(around, beside)]))
    rows, tags = [], []
    for i, (start, end, _) in enumerate(toks):
        feats = seen[i][0]
        for j, k in enumerate(AROUND):
            feats = feats + (seen[i + k][1][j] if 0 <= i + k < len(toks) else [_hash("edge", k)])
        tag = OUT
        for a, z in spans:
            if start < z and end > a:
                tag = BEGIN if start <= a else IN
        rows.append(feats)
        tags.append(tag)
    return rows, tags


def _value(r: random.Random) -> str:
    letters = r.choice(ALPHABETS)
    value = "".join(r.choice(letters) for _ in range(r.choice((12, 16, 20, 24, 32, 40, 64))))
    if r.random() < 0.2:
        value = ".".join(value[k:k + 12] for k in range(0, len(value), 12))
    if "/" in letters and r.random() < 0.5:
        value += "=="
    return value if any(c in _DIGIT for c in value) else value + r.choice(_DIGIT)


def _number(r: random.Random) -> str:
    """Something of digits that is no secret: an order number, a date, a version, a book's number."""
    sizes = r.choice(((8,), (11,), (16,), (4, 2, 2), (3, 1, 2, 6, 1), (1, 2, 3), (3, 3, 4), (4, 4, 4, 4)))
    return r.choice(".- ").join("".join(r.choice(_DIGIT) for _ in range(n)) for n in sizes)


def _windows(text: str, spans: list[tuple[int, int]], key: int | None, copies: int):
    """A window as it is and its copies: (text, secrets). key is where its key word starts."""
    yield text, spans
    if key is None or len(spans) != 1:
        return
    (a, z), r = spans[0], random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    plain = [w for w in re.findall(r"[^\W\d_]{2,}", text[:key])] or ["value"]
    tail = text[z + (text[z:z + 1] in "\"'"):]
    for c in range(copies):
        join, name = r.choice(JOINS), r.choice(NAMES)
        name = r.choice((name, name.upper(), name.capitalize()))
        secret = c % 4 != 3  # every fourth copy has a plain word where the secret was
        value = _value(r) if secret else " ".join(r.choice(plain) for _ in range(r.randrange(1, 4)))
        quote = join[-1] if join[-1] in "\"'" else ""
        at = key + len(name) + len(join)
        yield (text[:key] + name + join + value + quote + tail,
               [(at, at + len(value))] if secret else [])
    for _ in range(copies // 2):
        yield (text[:key] + " ".join(r.choice(plain) for _ in range(3)) + r.choice((" ", ": ", " = "))
               + _number(r) + tail, [])


def _training_rows(docs: DataFrame, limit: int) -> list:
    """Up to ``limit`` windows around base spans and as many others, the same ones whatever the
    partitions: ordered by a hash of their content."""
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text")).where("text <> ''").withColumn(
        "h", F.xxhash64("text"))
    edge = rows.select("h").orderBy("h").limit(limit).agg(F.max("h").alias("h")).first().h
    if edge is None:
        return []
    rows = rows.select("text", "h", (F.col("h") <= edge).alias("other")).where(
        F.col("other") | F.col("text").rlike(LIKELY))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "secret", "text", "start", "end", "key", "facts"]
        for b in batches:
            for text, h, other in zip(*(b.column(c).to_pylist() for c in ("text", "h", "other"))):
                out, facts = [], sum(file_features(text), [])
                secrets = [(m.start(2), m.end(2), m.start()) for m in ASSIGN.finditer(text)
                           if m.end(2) - m.start(2) >= 12]
                named = {(a, z) for a, z, _ in secrets}
                secrets += [(a, z, None) for a, k, z in base_spans(text) if k and not text[a:z].isdigit()
                            and not any(x <= a and z <= y for x, y in named)]
                for a, z, key in secrets:
                    at = max(0, (a if key is None else key) - BEFORE)
                    cut = text[at:min(z, a + 400) + AFTER]
                    out.append((xxhash.xxh64_intdigest(cut) >> 1, True, cut, a - at,
                                min(z, a + 400) - at, None if key is None else key - at, facts))
                if other and not secrets:
                    at = h % max(len(text) - BEFORE - 2 * AFTER, 1)
                    cut = text[at:at + BEFORE + 2 * AFTER]
                    out.append((xxhash.xxh64_intdigest(cut) >> 1, False, cut, 0, 0, None, facts))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, k) for v, k in zip(zip(*out), (
                            pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.int64(),
                            pa.list_(pa.int64())))], names)

    found = written(map_batches(rows, windows, "h long, secret boolean, text string, start long, "
                                               "end long, key long, facts array<long>"))
    order = ["h", "start", "end"]
    picked = []
    for secret in (True, False):
        some = found.where(F.col("secret") == secret).dropDuplicates(order)
        picked += some.orderBy(*order).limit(limit).collect()
    return picked


class Field:
    """Weights of a feature per tag, and of transitions, of a linear-chain field."""

    def __init__(self) -> None:
        self.w = np.zeros((BUCKETS, 3))
        self.t = np.zeros((3, 3))  # an outside tag stands before and behind every sequence
        self.names: set[str] = set()  # names that are features; the others are one

    def log_likelihood(self, feats: np.ndarray, tags: np.ndarray, length: np.ndarray):
        """feats (b, n, f; 0 is none), tags (b, n), length (b) -> the batch's log likelihood, its
        gradient by the emissions (b, n, 3) and by the transitions."""
        b, n = tags.shape
        e = self.w[feats].sum(2)
        valid = np.arange(n) < length[:, None]
        alpha, beta = np.zeros((n, b, 3)), np.zeros((n, b, 3))
        alpha[0] = self.t[OUT] + e[:, 0]
        for i in range(1, n):
            step = _logsum(alpha[i - 1][:, :, None] + self.t, 1) + e[:, i]
            alpha[i] = np.where(valid[:, i, None], step, alpha[i - 1])
        z = _logsum(alpha[-1] + self.t[:, OUT], 1)
        beta[-1] = self.t[:, OUT]
        for i in range(n - 2, -1, -1):
            step = _logsum(self.t + (e[:, i + 1] + beta[i + 1])[:, None, :], 2)
            beta[i] = np.where(valid[:, i + 1, None], step, self.t[:, OUT])
        p = np.exp(alpha + beta - z[:, None]).transpose(1, 0, 2) * valid[:, :, None]
        rows, cols = np.nonzero(valid)
        grad = -p
        grad[rows, cols, tags[rows, cols]] += 1
        dt = np.zeros((3, 3))
        score = np.where(valid, np.take_along_axis(e, tags[:, :, None], 2)[:, :, 0], 0).sum(1)
        before = np.concatenate([np.zeros((b, 1), tags.dtype), tags[:, :-1]], 1)
        score += np.where(valid, self.t[before, tags], 0).sum(1)
        np.add.at(dt, (before[valid], tags[valid]), 1)
        last = tags[np.arange(b), length - 1]
        score += self.t[last, OUT]
        np.add.at(dt, (last, np.zeros_like(last)), 1)
        dt[OUT] -= p[:, 0].sum(0)
        for i in range(1, n):
            pair = np.exp(alpha[i - 1][:, :, None] + self.t + (e[:, i] + beta[i])[:, None, :]
                          - z[:, None, None])
            dt -= (pair * valid[:, i, None, None]).sum(0)
        dt[:, OUT] -= p[np.arange(b), length - 1].sum(0)
        return float((score - z).sum()), grad, dt

    def fit(self, sequences: list[tuple[list[list[int]], list[int]]]) -> Field:
        """Adaptive gradient steps over the sequences in a fixed shuffled order."""
        sequences = [s for s in sequences if s[1]]
        order, square, tsquare = random.Random(7), np.full((BUCKETS, 3), 1e-6), np.full((3, 3), 1e-6)
        for _ in range(EPOCHS):
            order.shuffle(sequences)
            for at in range(0, len(sequences), BATCH):
                part = sequences[at:at + BATCH]
                length = np.array([len(t) for _, t in part])
                width = max(len(f) for rows, _ in part for f in rows)
                feats = np.zeros((len(part), length.max(), width), np.int64)
                tags = np.zeros((len(part), length.max()), np.int64)
                for i, (rows, t) in enumerate(part):
                    tags[i, :len(t)] = t
                    for j, f in enumerate(rows):
                        feats[i, j, :len(f)] = f
                _, grad, dt = self.log_likelihood(feats, tags, length)
                used, place = np.unique(feats, return_inverse=True)
                step = np.stack([np.bincount(place.reshape(-1), np.repeat(grad[:, :, k].reshape(-1), width),
                                             len(used)) for k in range(3)], 1) / len(part)
                step -= DECAY * self.w[used]
                square[used] += step * step
                self.w[used] += RATE * step / np.sqrt(square[used])
                self.w[0] = 0
                tsquare += (dt / len(part)) ** 2
                self.t = np.clip(self.t + RATE * dt / len(part) / np.sqrt(tsquare), -6, 6)
        return self


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def train(docs: DataFrame, limit: int = SAMPLE) -> Field | None:
    """The field fitted on at most ``limit`` windows with a base span and as many without, or
    None if no text has a base span that tells anything."""
    rows = _training_rows(docs, limit)
    named = sum(r.key is not None for r in rows)
    if not any(r.secret for r in rows):
        return None
    copies = min(max(COPIED // max(named, 1), COPIES[0]), COPIES[1])
    sequences, field = [], Field()
    seen = Counter(token_class(t)[0] for r in rows for t in _TOKEN.findall(r.text))
    field.names = {n for n, times in seen.items() if times >= LEAST} | set(
        n.lower() for n in NAMES if n.isalpha())
    for r in rows:
        half = len(r.facts) // 2
        whole = list(r.facts[:half]), list(r.facts[half:])
        spans = [(r.start, r.end)] if r.secret else []
        sequences += [_sequence(t, s, whole, field.names) for t, s in _windows(r.text, spans, r.key, copies)]
    return field.fit(sequences)


def viterbi(e: np.ndarray, t: np.ndarray) -> list[int]:
    """Best tags of a sequence with emissions e (n, 3), outside before and behind it."""
    score, back = (t[OUT] + e[0]).tolist(), []
    steps = t.T.tolist()
    for row in e[1:].tolist():
        froms, now = [], []
        for s in range(3):
            a, b, c = score[0] + steps[s][0], score[1] + steps[s][1], score[2] + steps[s][2]
            k = 0 if a >= b and a >= c else 1 if b >= c else 2
            froms.append(k)
            now.append((a, b, c)[k] + row[s])
        back.append(froms)
        score = now
    final = [score[s] + float(t[s, OUT]) for s in range(3)]
    tags = [max(range(3), key=lambda s: (final[s], -s))]
    for froms in reversed(back):
        tags.append(froms[tags[-1]])
    return tags[::-1]


class _Numbers(dict):
    """Token -> its row; a new one is made by the given function."""

    def __init__(self, make) -> None:
        self.make = make

    def __missing__(self, token: str) -> int:
        return self.make(token)


class Tagger:
    """Decoding with a fitted field; tokens seen before are looked up."""

    def __init__(self, field: Field) -> None:
        self.w = (field.w - field.w[:, OUT:OUT + 1])[:, 1:].astype(np.float64)
        self.t = field.t - field.t[OUT, OUT]
        inner = float(self.t[1:, 1:].max())
        into, out = self.t[OUT, 1:], self.t[1:, OUT]
        self.inner = inner
        self.slack = max(float(into.max() - into.min()), float(out.max() - out.min()),
                         float(into.max() + out.max()) - inner, 0.0)
        self.edge = np.array([self.w[_hash("edge", k)] for k in AROUND])
        self.numbers = _Numbers(self._number)
        self.table = np.zeros((KNOWN, 1 + len(AROUND), 2))
        self.odd = np.zeros(KNOWN, np.int8)
        self.classes: dict[tuple, np.ndarray] = {}
        self.named = {n: self._sums(name_features(n)) for n in ["", *sorted(field.names)]}

    def _sums(self, feats: tuple[list[int], list[list[int]]]) -> np.ndarray:
        return np.array([self.w[f].sum(0) for f in (feats[0], *feats[1])])

    def _number(self, token: str) -> int:
        n = self.numbers[token] = len(self.numbers)
        if n == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.odd = np.concatenate([self.odd, np.zeros_like(self.odd)])
        name, kind = token_class(token)
        if (row := self.classes.get(kind)) is None:
            if len(self.classes) > KNOWN:
                self.classes.clear()
            row = self.classes[kind] = self._sums(class_features(kind))
        named = self.named.get(name)
        self.table[n] = row + (self.named[""] if named is None else named)
        self.odd[n] = kind[-1]
        return n

    def emissions(self, tokens: list[str], whole: np.ndarray) -> np.ndarray:
        """(n, 2): begin and inside against outside. whole (2, 2) is the file's share."""
        if len(self.numbers) > KNOWN // 2:
            self.numbers.clear()
        ids = np.fromiter(map(self.numbers.__getitem__, tokens), np.int64, len(tokens))
        parts = self.table[ids]
        e = parts[:, 0] + whole[self.odd[ids]]
        n = len(ids)
        for j, k in enumerate(AROUND):
            if k < 0:
                e[-k:] += parts[:n + k, 1 + j] if n + k > 0 else 0
                e[:-k] += self.edge[j]
            else:
                e[:n - k] += parts[k:, 1 + j]
                e[max(n - k, 0):] += self.edge[j]
        return e

    def regions(self, e: np.ndarray) -> list[tuple[int, int]]:
        """Disjoint ranges outside of which a best path has no secret."""
        bound = e.max(1) + self.inner
        out: list[tuple[int, int]] = []
        end = 0
        for a in np.flatnonzero(bound >= -self.slack).tolist():
            if a < end:
                continue
            sum_, z = 0.0, a
            while z < len(bound):
                sum_ = max(sum_, 0.0) + float(bound[z])
                if sum_ < -self.slack:
                    break
                z += 1
            out.append((a, z))
            end = z
        return out

    def tags(self, e: np.ndarray) -> list[tuple[int, int]]:
        """(first token, one past the last) of each secret of the best path."""
        spans = []
        for a, z in self.regions(e):
            full = np.zeros((z - a, 3))
            full[:, 1:] = e[a:z]
            open_ = None
            for i, tag in enumerate([*viterbi(full, self.t), OUT]):
                if open_ is not None and tag != IN:
                    spans.append((open_, a + i))
                    open_ = None
                if tag != OUT and open_ is None:
                    open_ = a + i
        return spans

    def secrets(self, text: str) -> list[tuple[int, int]]:
        """(start, end) of the secrets in a text, in code points. A long text is read in blocks;
        a block ends before a region that its end may cut."""
        facts = file_features(text)
        whole = np.array([self.w[f].sum(0) for f in facts])
        found, at, size = [], 0, BLOCK
        context: list[str] = []  # tokens before the block
        while at < len(text):
            # white space at the end would be tried from each of its characters
            tokens = _TOKEN.findall(text[at:at + size].rstrip())
            final = at + size >= len(text)
            seen = context + tokens
            if not final:
                seen = seen[:-1]  # the last one may be cut
            e = self.emissions(seen, whole) if seen else np.zeros((0, 2))
            origin = at - sum(map(len, context))
            stop = len(seen)
            if not final:  # the last tokens lack a neighbour, and a region may go on
                stop = len(seen) - 1
                for a, z in self.regions(e):
                    if a < stop <= z:
                        stop = a
                if stop <= len(context) + len(AROUND):
                    size *= 2
                    continue
            first = len(context) if context else 0
            spans = self.tags(e[first:stop])
            ends = np.cumsum([len(t) for t in seen]) if spans or not final else None
            for a, z in spans:
                a, z = a + first, z + first
                core = len(seen[a].lstrip())
                found.append((origin + int(ends[a]) - core, origin + int(ends[z - 1])))
            if final:
                break
            at = origin + int(ends[stop - 1])
            context, size = seen[max(0, stop - 4):stop], BLOCK
        return found


def all_spans(text: str, tagger: Tagger | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans and of the field's that lie in none of them."""
    base = base_spans(text)
    more, i, reach = [], 0, 0
    for a, z in tagger.secrets(text) if tagger else []:
        while i < len(base) and base[i][0] <= a:
            reach = max(reach, base[i][2])
            i += 1
        if z > reach:
            more.append((a, 3, z))
    return sorted(base + more)


_TAGGERS: dict[int, Tagger] = {}


def _tagger(key: int, field: Field | None) -> Tagger | None:
    if field is None:
        return None
    if key not in _TAGGERS:
        _TAGGERS.clear()
        _TAGGERS[key] = Tagger(field)
    return _TAGGERS[key]


def find(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """docs (doc_id, text, any others) -> doc_id, spans (array of kind, start, end by start and
    then kind; code points, end exclusive), one row per row of docs.

    Without a field one is trained on docs. Null and empty texts have no spans, repeated rows are
    searched like any other, an empty table gives no rows; if no text has a base span, none are
    added. Spans of different kinds may overlap; one of the field that lies inside a base span is
    not reported again."""
    rows = docs.select("doc_id", "text")
    field = field or train(rows)
    key = 0 if field is None else zlib.crc32(field.w.tobytes() + field.t.tobytes())  # a fit's mark
    shared = rows.sparkSession.sparkContext.broadcast(field)  # BUCKETS x 3 numbers

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _tagger(key, shared.value)
        for b in batches:
            made = [all_spans(t, tagger) if t else [] for t in b.column("text").to_pylist()]
            flat = [s for m in made for s in m]
            offsets = np.concatenate([[0], np.cumsum([len(m) for m in made])]).astype(np.int32)
            each = pa.StructArray.from_arrays(
                [pa.array([KINDS[s[1]] for s in flat], pa.string()),
                 pa.array([s[0] for s in flat], pa.int64()),
                 pa.array([s[2] for s in flat], pa.int64())], ["kind", "start", "end"])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), each)],
                ["doc_id", "spans"])

    doc_id = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, spans, f"doc_id {doc_id}, spans array<struct<kind:string,"
                                    "start:bigint,end:bigint>>")


def digest(spans: Column, base_only: bool = False) -> Column:
    """kind:start:end of the spans, joined by commas."""
    chosen = F.filter(spans, lambda s: s["kind"] != KINDS[-1]) if base_only else spans
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
