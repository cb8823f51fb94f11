import random
import zlib

import numpy as np
import pytest

from spanmill.llm import toxicity_cnn as T
from spanmill.llm.queries import QUERIES

BAD = {"en": ["scum", "idiot", "moron"], "de": ["trottel", "depp", "idiotin"]}
FILL = {"en": "the of and river stone to tree is that lamp walks".split(),
        "de": "der die und baum stein ist von haus mit lampe geht".split()}


def corpus(n, seed):
    rnd, out = random.Random(seed), []
    for i in range(n):
        lang = rnd.choice(["en", "en", "de"])
        words = [rnd.choice(FILL[lang]) + rnd.choice(["", "", "s", "en"])
                 for _ in range(rnd.randint(3, 80))]
        toxic = rnd.random() < 0.25
        if toxic:
            for _ in range(rnd.randint(1, 3)):
                words.insert(rnd.randrange(len(words) + 1), rnd.choice(BAD[lang]))
        label = toxic ^ (rnd.random() < 0.03)
        out.append((i, " ".join(words), int(toxic), int(label)))
    return out


def auc(scores, labels):
    order = np.argsort(scores)
    rank = np.empty(len(scores))
    rank[order] = np.arange(len(scores))
    y = np.array(labels, bool)
    return (rank[y].mean() - (y.sum() - 1) / 2) / (~y).sum()


@pytest.fixture(scope="module")
def toy():
    rows = corpus(1500, 1)

    def prepared(text):
        words = T._WORD.findall(text.lower())
        counts = {w: words.count(w) for w in set(words)}
        return np.array([T._rows(w) for w in words]), T.guess_language(counts)
    data = [(prepared(t)[0], y, prepared(t)[1]) for _, t, _, y in rows]
    return T.fit(data)


def test_held_out_accuracy(toy):
    score = toy.scorer()
    rows = corpus(600, 2)
    scores = [score(t) for _, t, _, _ in rows]
    truth = [y for _, _, y, _ in rows]
    assert auc(scores, truth) > 0.97
    wrong = sum((s >= T.CUTOFF) != bool(y) for s, y in zip(scores, truth))
    assert wrong < 0.05 * len(rows)
    assert set(toy.shift) >= {"", "en", "de"}


def test_blocks_and_forgetting_change_nothing(toy, monkeypatch):
    rows = corpus(40, 3)
    long_text = " ".join(t for _, t, _, _ in rows)
    want = [toy.scorer()(t) for t in [long_text, *(t for _, t, _, _ in rows)]]
    monkeypatch.setattr(T, "BLOCK", 50)
    monkeypatch.setattr(T, "KNOWN_WORDS", 45)
    score = toy.scorer()
    got = [score(t) for t in [long_text, *(t for _, t, _, _ in rows)]]
    assert np.allclose(got, want, atol=1e-5)


def test_a_score_is_the_model_written_out(toy):
    text = "the of and you scum"
    words = text.split()
    x = np.array([sum(t[r] for t, r in zip(toy.tables, T._rows(w))) for w in words])
    x = np.concatenate([x, np.zeros((2, T.DIM))])
    feats = []
    for j, w in enumerate(toy.filters):
        z = [sum(x[i + k] @ w[k] for k in range(len(w))) for i in range(len(words))]
        feats.append(np.maximum(np.max(z, 0) + toy.bias[j], 0))
    z = np.concatenate(feats) @ toy.out + toy.out_bias + toy.shift["en"]
    assert abs(toy.scorer()(text) - 1 / (1 + np.exp(-z))) < 1e-4


def test_edge_rows(spark, docs):
    rows = [(i, t) for i, t, _, _ in corpus(300, 4)]
    labels = [(i, 1, y) for i, _, _, y in corpus(300, 4)] + [(0, 1, None), (10 ** 9, 1, 1), (None, 1, 1)]
    rows += [(1000, None), (1001, ""), (1002, "1 2 ..."), (None, "scum"), (1003, "é " * 5), (1, "twice")]
    table = docs([(*r, "x") for r in rows], ", score string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = T.scored(table, marks).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    kept = T.keep_clean(table, marks)
    assert kept.columns == table.columns
    assert kept.count() == sum(r.score < T.CUTOFF for r in got)
    none = T.scored(table, marks.where("toxic = 7")).collect()
    assert {r.score for r in none} == {0.5} and T.scored(docs([]), marks).count() == 0


def test_cutoffs_follow_all_labelled_rows(spark, docs, monkeypatch):
    """Languages and texts beyond the sample calibrate too, and no row of the fit does."""
    rows = [(i, t) for i, t, _, _ in corpus(900, 5)]
    labels = [(i, 1, y) for i, _, _, y in corpus(900, 5)]
    long_text = "the of and river stone " * 40
    rows += [(2000 + i, long_text + ("scum" if i % 2 else "")) for i in range(60)]
    labels += [(2000 + i, 1, i % 2) for i in range(60)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    monkeypatch.setattr(T, "SAMPLE", 60)
    monkeypatch.setattr(T, "SAMPLE_WORDS", 120)
    table, seen = docs(rows), []
    shifts_of = T.shifts_of
    monkeypatch.setattr(T, "shifts_of", lambda counts: seen.append(counts) or shifts_of(counts))
    scores = T.scored(table, marks).collect()
    sample = T.labelled_sample(table, T.learnable(marks))
    model = T.fit([row for _, row in sample])
    used = {i for k, (i, _) in enumerate(sample) if T.fitted(k)}
    logit, texts, want = model.logits(), dict(rows), {}
    for i, _, y in labels:
        if zlib.crc32(str(i).encode()) % 3 != 1 and i not in used:
            z, lang = logit(texts[i])
            want[lang, y] = want.get((lang, y), 0) + 1
    got = {}  # seen: the sample's third, all rows, and the third again by the fit above
    for lang, _, y, n in seen[1]:
        got[lang, y] = got.get((lang, y), 0) + n
    assert got == want and sum(want.values()) > 400  # the sample's third has at most 40
    # 120 rows of the sample, a third of them held back, leave no 15 toxic rows to German
    assert "de" not in shifts_of(seen[-1]) and want["de", 1] >= T.LEAST_ROWS
    model.shift = shifts_of(seen[1])
    assert set(model.shift) >= {"", "en", "de"}
    score = model.scorer()
    assert np.allclose([r.score for r in scores], [score(texts[r.doc_id]) for r in scores], atol=1e-5)


def test_shifts_of_counts():
    goal = np.log(T.CUTOFF / (1 - T.CUTOFF))
    got = T.shifts_of([("en", 512, 1, 20), ("en", 0, 0, 30), ("de", 256, 1, 14), ("de", -256, 0, 99)])
    assert set(got) == {"", "en"}  # too few toxic rows of German
    assert abs(got["en"] - (goal - (256 + 0.5) / T.STEPS)) < 1e-12
    assert T.shifts_of([("en", 3, 1, 20)]) == {"": 0.0} == T.shifts_of([])


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op7_toxicity_cnn"](spark, sf).join(
        spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left").collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [r for r in got if r.held_out and r.toxic is not None]
    assert auc([r.score for r in held], [r.toxic for r in held]) > 0.75
    assert all(r.predicted == int(r.score >= 0.7) for r in got)
