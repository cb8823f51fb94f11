"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's vector is the sum of two rows under independent hashes of the word and one under a
hash of its prefix, so unseen words share little by chance and inflections share much. Filters
of several widths slide over a text; each filter's maximum over the whole text goes into a
logistic unit. The cutoff that separates the classes best is found for each language on all
learnable labelled rows that the fit has not seen and moved to 0.7; a text's language is guessed
from its own function words, as the score must follow from the text alone.

The fit takes a bounded sample of labelled rows (SAMPLE of each label, texts of up to
SAMPLE_WORDS words); calibration takes every other labelled row and scoring every row, both with
the whole text."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sketches import bucket_filter
from .common import map_batches, ship, solid, written

#: Labelled rows of each label in the fit, and the longest text among them, in words.
SAMPLE, SAMPLE_WORDS = 4000, 4000
#: Rows of each hash table, embedding width, filters of each width.
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 18, 8, 8, (1, 2, 3)
EPOCHS, BATCH, RATE, PREFIX = 4, 32, 0.05, 5
#: A score from here on means toxic; every language's best cutoff is moved here.
CUTOFF = 0.7
#: Toxic rows of a language below which the common cutoff serves it.
LEAST_ROWS = 15
#: Logits are counted in steps of 1 / STEPS, up to LIMIT on either side.
STEPS, LIMIT = 256, 30
#: Words remembered by a Python worker; characters of a text that are read at a time.
KNOWN_WORDS, BLOCK = 150_000, 300_000
#: Common function words, for guessing a text's language.
FUNCTION_WORDS = {
    "de": ["der", "die", "das", "und", "ist", "von", "mit", "den", "nicht", "ein"],
    "en": ["the", "of", "and", "to", "is", "that", "for", "was", "with", "are"],
    "es": ["el", "los", "las", "que", "y", "en", "por", "del", "una", "con"],
    "fr": ["le", "les", "et", "des", "un", "une", "est", "dans", "pour", "du"],
}
_WORD = re.compile(r"[^\W\d_]+")


def _blocks(text: str):
    """Lists of a text's lower-cased words, each with the two words before it in front, how
    many these are, and whether the list is the last."""
    pos, tail = 0, []
    while pos < len(text):
        end = min(pos + BLOCK, len(text))
        while end < len(text) and text[end].isalpha():
            end += 1
        words = tail + _WORD.findall(text[pos:end].lower())
        yield words, len(tail), end == len(text)
        tail, pos = words[-2:], end


def _rows(word: str) -> tuple[int, int, int]:
    h = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"), 1)
    prefix = xxhash.xxh64_intdigest(word[:PREFIX].encode("utf-8", "replace"), 2)
    return h % BUCKETS, (h >> 32) % BUCKETS, prefix % BUCKETS


def guess_language(counts: dict[str, int]) -> str:
    """The language with most function words in counts (word: times); none: empty."""
    seen = {k: sum(counts.get(w, 0) for w in ws) for k, ws in FUNCTION_WORDS.items()}
    best = max(seen, key=lambda k: seen[k])
    return best if seen[best] else ""


class Model:
    """Parameters after the fit and the calibration."""

    def __init__(self, tables, filters, bias, out, out_bias, shift):
        self.tables, self.filters, self.bias = tables, filters, bias
        self.out, self.out_bias, self.shift = out, out_bias, shift

    def scorer(self):
        """A function text -> score that remembers the words it has met."""
        logit = self.logits()

        def score(text: str | None) -> float:
            z, lang = logit(text)
            z += self.shift.get(lang, self.shift[""])
            return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        return score

    def logits(self):
        """A function text -> logit without shift, guessed language."""
        # column blocks: one for each place within each filter width
        places = [w[k] for w in self.filters for k in range(len(w))]
        project = np.concatenate(places, axis=1).astype(np.float32)
        function = sorted({w for ws in FUNCTION_WORDS.values() for w in ws})
        known: dict[str, int] = {}
        matrix = np.zeros((KNOWN_WORDS, project.shape[1]), np.float32)  # memory as it fills

        def learn(words):
            nonlocal matrix
            new = [w for w in words if w not in known]
            if not new:
                return
            at = np.array([_rows(w) for w in new])
            vectors = sum(t[at[:, j]] for j, t in enumerate(self.tables)) @ project
            end = len(known) + len(new)
            if end > len(matrix):
                matrix = np.concatenate([matrix, np.zeros((end, project.shape[1]), np.float32)])
            matrix[len(known):end] = vectors
            known.update(zip(new, range(len(known), end)))

        learn(function)  # the first rows

        def logit(text: str | None) -> tuple[float, str]:
            top = np.full((len(WIDTHS), FILTERS), -np.inf, np.float32)
            seen = np.zeros(len(function), np.int64)
            for words, repeated, last in _blocks(text or ""):
                if not words:
                    continue
                own = set(words)
                if len(known) + len(own) > KNOWN_WORDS:
                    known.clear()
                    learn(function)
                learn(own)
                ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                x = np.concatenate([matrix[ids], np.zeros((max(WIDTHS) - 1, project.shape[1]),
                                                          np.float32)])
                at = 0
                for i, width in enumerate(WIDTHS):
                    # windows that run over a list's end begin the next list too
                    n = len(words) if last else len(words) - width + 1
                    if n > 0:
                        z = sum(x[k:k + n, (at + k) * FILTERS:(at + k + 1) * FILTERS]
                                for k in range(width))
                        top[i] = np.maximum(top[i], z.max(0))
                    at += width
                mine = ids[repeated:]
                seen += np.bincount(mine[mine < len(function)], minlength=len(function))
            features = np.maximum(np.where(np.isfinite(top), top, 0) + self.bias, 0).ravel()
            lang = guess_language(dict(zip(function, seen.tolist())))
            return float(features @ self.out + self.out_bias), lang

        return logit


def _forward(tables, filters, bias, x_ids):
    x = tables[0][x_ids[:, 0]] + tables[1][x_ids[:, 1]] + tables[2][x_ids[:, 2]]
    n = len(x)
    x = np.concatenate([x, np.zeros((max(WIDTHS) - 1, DIM), np.float32)])
    tops, args = [], []
    for w in filters:
        z = sum(x[k:k + n] @ w[k] for k in range(len(w)))
        a = z.argmax(0)
        args.append(a)
        tops.append(z[a, np.arange(FILTERS)])
    return x, np.stack(tops) + bias, args


def fitted(place: int) -> bool:
    """Whether the row at a place of the sample enters the fit."""
    return place % 3 != 0


def fit(rows: list[tuple[np.ndarray, int, str]], seed: int = 7) -> Model:
    """rows: (table rows of the words, one line each; label; guessed language).

    A third of the rows is held back (see fitted()) and calibrates the cutoffs, the others are
    fitted. With no rows of one label every score is one half."""
    rng = np.random.default_rng(seed)
    rows = [r for r in rows if len(r[0])]
    train, hold = [r for i, r in enumerate(rows) if fitted(i)], rows[::3]
    labels = np.array([y for _, y, _ in train], np.int64)
    tables = [np.zeros((BUCKETS, DIM), np.float32) for _ in range(3)]  # unmet rows stay zero
    filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    bias, out = np.zeros((len(WIDTHS), FILTERS), np.float32), np.full(
        len(WIDTHS) * FILTERS, 0.3, np.float32)
    if not len(labels) or labels.min() == labels.max():
        return Model(tables, filters, bias, out * 0, 0.0, {"": 0.0})
    # start: the first coordinate is a row's log odds among the labels, the rest is small noise
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    for j, t in enumerate(tables):
        seen = np.zeros((2, BUCKETS))
        for ids, y, _ in train:
            seen[y, np.unique(ids[:, j])] += 1
        odds = np.log((seen[1] + 0.5) / (n1 + 1)) - np.log((seen[0] + 0.5) / (n0 + 1))
        met = seen.sum(0) > 0
        t[met, 0] = np.clip(odds[met] / 3, -1.5, 1.5)
        t[met, 1:] = rng.normal(0, 0.02, (met.sum(), DIM - 1))
    for w in filters:
        w[:, 0, :] = np.abs(w[:, 0, :]) + 0.1
    out_bias = np.float32(-1.0)
    speed = {"t": [np.full((BUCKETS, 1), 0.1, np.float32) for _ in range(3)],
             "f": [np.full_like(w, 0.1) for w in filters], "b": np.full_like(bias, 0.1),
             "o": np.full_like(out, 0.1), "ob": 0.1}
    weight = {1: 0.5 / n1 * len(labels), 0: 0.5 / n0 * len(labels)}
    for _ in range(EPOCHS):
        order = rng.permutation(len(train))
        for start in range(0, len(order), BATCH):
            gf, gb, go, gob = [np.zeros_like(w) for w in filters], np.zeros_like(bias), 0, 0
            touched: list[tuple[np.ndarray, np.ndarray]] = []
            for i in order[start:start + BATCH]:
                ids, y, _ = train[i]
                x, tops, args = _forward(tables, filters, bias, ids)
                feats = np.maximum(tops, 0)
                z = feats.ravel() @ out + out_bias
                d = np.float32((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight[y] / BATCH)
                go, gob = go + d * feats.ravel(), gob + d
                back = (d * out).reshape(tops.shape) * (tops > 0)
                gb += back
                for j, (w, a) in enumerate(zip(filters, args)):
                    for k in range(len(w)):
                        gf[j][k] += x[a + k].T * back[j]
                        inside = a + k < len(ids)
                        touched.append((ids[(a + k)[inside]], (w[k] * back[j]).T[inside]))
            speed["o"] += go ** 2
            out -= RATE * go / np.sqrt(speed["o"])
            speed["ob"] += gob ** 2
            out_bias -= np.float32(RATE * gob / np.sqrt(speed["ob"]))
            speed["b"] += gb ** 2
            bias -= RATE * gb / np.sqrt(speed["b"])
            for w, g, s in zip(filters, gf, speed["f"]):
                s += g ** 2
                w -= RATE * g / np.sqrt(s)
            at = np.concatenate([a for a, _ in touched])
            grad = np.concatenate([g for _, g in touched])
            for j, t in enumerate(tables):
                uniq, where = np.unique(at[:, j], return_inverse=True)
                g = np.zeros((len(uniq), DIM), np.float32)
                np.add.at(g, where, grad)
                speed["t"][j][uniq] += (g ** 2).mean(1, keepdims=True)
                t[uniq] -= RATE * g / np.sqrt(speed["t"][j][uniq])
    model = Model(tables, filters, bias, out, float(out_bias), {"": 0.0})
    model.shift = _shifts(model, hold or train)
    return model


def _shifts(model: Model, rows) -> dict[str, float]:
    """shifts_of() the given rows of fit()."""
    counts: dict[tuple[str, int, int], int] = {}
    for ids, label, lang in rows:
        tops = _forward(model.tables, model.filters, model.bias, ids)[1]
        z = float(np.maximum(tops, 0).ravel() @ model.out + model.out_bias)
        at = lang, _step(z), int(label)
        counts[at] = counts.get(at, 0) + 1
    return shifts_of([(*k, n) for k, n in counts.items()])


def _step(z: float) -> int:
    return int(np.floor(min(max(z, -LIMIT), LIMIT) * STEPS))


def shifts_of(counts: list[tuple[str, int, int, int]]) -> dict[str, float]:
    """counts (language, step of the logit, label, rows) -> by language, what to add to a logit
    so that its best cutoff comes to lie at CUTOFF.

    Best: most toxic rows found, a clean one taken for toxic counting three times as a share;
    among equals the middle of the widest gap."""
    def best(mine: dict[int, list[int]]) -> float:
        steps = sorted(mine, reverse=True)
        clean, toxic = np.array([mine[k] for k in steps], np.int64).T
        gain = np.cumsum(toxic) / toxic.sum() - 3 * (np.cumsum(clean) / clean.sum())
        k = np.flatnonzero(gain >= gain.max() - 1e-12)[-1]
        below = steps[k + 1] if k + 1 < len(steps) else steps[k] - STEPS
        return (steps[k] + below + 1) / 2 / STEPS  # between the middles of the two steps

    found: dict[str, dict[int, list[int]]] = {"": {}}
    for lang, step, label, n in counts:
        for k in {"", lang}:
            found.setdefault(k, {}).setdefault(step, [0, 0])[label] += n
    goal = float(np.log(CUTOFF / (1 - CUTOFF)))
    shift = {"": 0.0}
    for k in sorted(found):
        rows = np.array(list(found[k].values()), np.int64).reshape(-1, 2).sum(0)
        if rows.min() >= (LEAST_ROWS if k else 1):
            shift[k] = goal - best(found[k])
    return shift


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def learnable(labels: DataFrame) -> DataFrame:
    """labels -> _id, _toxic: a row for each labelled document that may be learned from."""
    return (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
            .groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_toxic"))
            .where(~held_out(F.col("_id"))))


def labelled_sample(docs: DataFrame, marks: DataFrame) -> list[tuple[int, tuple[np.ndarray, int, str]]]:
    """Ids and rows for fit(): the first SAMPLE of each label by a hash of the id; of the rows of
    one id, the one whose text has the least hash."""
    first = None
    for y in (0, 1):
        part = marks.where(F.col("_toxic") == y).orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE)
        first = part if first is None else first.unionByName(part)
    texts = (docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
             .join(F.broadcast(first), "_id"))  # 2 * SAMPLE rows of two numbers
    texts = (texts.groupBy("_id").agg(F.min(F.struct(F.xxhash64("text"), "text", "_toxic")).alias("x"))
             .select("_id", "x.text", "x._toxic"))

    def rows(batches):
        for b in batches:
            out = []
            for i, text, y in zip(*(b.column(c).to_pylist() for c in ("_id", "text", "_toxic"))):
                words = _WORD.findall(text.lower()) if len(text) <= 40 * SAMPLE_WORDS else []
                if 0 < len(words) <= SAMPLE_WORDS:
                    counts: dict[str, int] = {}
                    for w in words:
                        counts[w] = counts.get(w, 0) + 1
                    where = {w: _rows(w) for w in counts}
                    ids = np.array([where[w] for w in words], "<i4")
                    out.append((i, ids.tobytes(), int(y), guess_language(counts)))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("id", "ids", "y", "lang"), r)) for r in out],
                pa.schema([("id", pa.int64()), ("ids", pa.binary()), ("y", pa.int32()),
                           ("lang", pa.string())]))

    found = map_batches(texts, rows, "id long, ids binary, y int, lang string").collect()
    found.sort(key=lambda r: (zlib.crc32(str(r.id).encode(), 99), r.id, bytes(r.ids)))
    return [(r.id, (np.frombuffer(bytes(r.ids), "<i4").reshape(-1, 3), r.y, r.lang)) for r in found]


def logit_column(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Logit without shift (z) and guessed language (lang) of each whole text as a column; the
    model's size does not depend on data."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    def logits(batches):
        logit = sent.value.logits()
        for texts in batches:
            z, lang = zip(*(logit(t.as_py()) for t in texts)) if len(texts) else ((), ())
            yield pa.StructArray.from_arrays(
                [pa.array(z, pa.float64()), pa.array(lang, pa.string())], ["z", "lang"])

    from collections.abc import Iterator

    logits.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(logits, "z double, lang string")(F.col(text))


def _fitted(docs: DataFrame, marks: DataFrame) -> tuple[Model, list]:
    sample = labelled_sample(docs, marks)
    return fit([row for _, row in sample]), sample


def _calibrate(model: Model, logits: DataFrame, marks: DataFrame, sample: list) -> None:
    """Set the shifts from logits (_id, _l) of all learnable labelled rows outside the fit."""
    counts = calibration_counts(logits, marks, sample)
    if {y for _, _, y, _ in counts} == {0, 1}:
        model.shift = shifts_of(counts)


def _score(model: Model) -> Column:
    shifts = F.create_map(*[F.lit(x) for kv in model.shift.items() for x in kv])
    z = F.col("_l.z") + F.coalesce(F.try_element_at(shifts, F.col("_l.lang")), F.lit(model.shift[""]))
    clipped = F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))
    return (1 / (1 + F.exp(-clipped))).alias("score")


def calibration_counts(logits: DataFrame, marks: DataFrame,
                       sample: list) -> list[tuple[str, int, int, int]]:
    """logits (_id, _l) -> the counts for shifts_of() over all rows that marks name and the fit
    has not seen. What is gathered is bounded by languages, steps and labels."""
    seen = logits.sparkSession.createDataFrame(
        sorted({(i,) for k, (i, _) in enumerate(sample) if fitted(k)}), "_id long")
    others = (marks.where(F.col("_toxic").isin(0, 1))
              .join(F.broadcast(seen), "_id", "left_anti"))  # 2 * SAMPLE ids at most
    step = F.floor(F.greatest(F.least("_l.z", F.lit(float(LIMIT))), F.lit(float(-LIMIT))) * STEPS)
    found = (logits.join(others, "_id")
             .groupBy(F.col("_l.lang").alias("lang"), step.alias("step"), "_toxic").count())
    return [tuple(r) for r in found.collect()]


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs (doc_id, text, any others) and labels (doc_id, toxic 0/1) -> doc_id, held_out,
    score, one row per row of docs.

    Null and empty texts are scored like a text without words. Labels are combined by maximum
    when repeated; labels that are null, held out or of no document are not learned from. Too
    few labels give the score one half, an empty table gives no rows."""
    marks = learnable(labels)
    model, sample = _fitted(docs, marks)
    rows = docs.select("doc_id", "text")
    # texts are read through the classifier once; the written logits choose the cutoffs
    rows = written(rows.withColumn("_l", logit_column(rows, model)).drop("text"))
    if model.out.any():  # else there was nothing to fit
        _calibrate(model, rows.select(F.col("doc_id").alias("_id"), "_l"), marks, sample)
    return rows.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                       _score(model))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs scored below CUTOFF, with all their columns.

    Labelled rows are scored for the cutoffs first; then all documents pass in one stage, without
    being written or shuffled here. A bucket filter of bounded size takes the rows without a label
    out, all but a few, before they are scored; the labels are joined to logits, not to texts."""
    marks = learnable(labels)
    model, sample = _fitted(docs, marks)
    if model.out.any():
        rows = docs.select(F.col("doc_id").alias("_id"), "text").withColumn("h", F.xxhash64("_id"))
        rows = bucket_filter(rows, marks.withColumn("h", F.xxhash64("_id"))).drop("h")
        logits = written(rows.withColumn("_l", logit_column(rows, model)).drop("text"))
        _calibrate(model, logits, marks, sample)
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    found = packed.withColumn("_l", solid(logit_column(packed, model, "doc.text")))
    return found.where(_score(model) < CUTOFF).select("doc.*")
