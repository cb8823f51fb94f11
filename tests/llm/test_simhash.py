import random

import numpy as np
import xxhash

from spanmill.llm import simhash_dedup as S
from spanmill.llm.components import components


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or (
        [b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(fps):
    """fps: list of unsigned ints -> index of the least member reachable, per row."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40, 70)] + [(7, k) for k in range(200, 260)] + [(3, 3)]
    got = {r.node: r.root for r in components(
        spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 40 for i in range(40, 71)}, 7: 7, **{k: 7 for k in range(200, 260)}}


def test_links_equal_all_pairs_even_when_variants_are_hot(spark):
    rnd = random.Random(5)
    base = rnd.getrandbits(64)
    fps = {base}
    for _ in range(300):
        x = rnd.choice(sorted(fps))
        for b in rnd.sample(range(64), rnd.randint(1, 3)):
            x ^= 1 << b
        fps.add(x)
    fps |= {rnd.getrandbits(64) for _ in range(100)} | {0, (1 << 64) - 1, 1, 3, 7}
    want = {(signed(a), signed(b)) for a in fps for b in fps
            if signed(a) < signed(b) and (a ^ b).bit_count() <= 2}
    table = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    for small in (256, 3):
        got = {(r.a, r.b) for r in S.links(table, small=small).collect()}
        assert got == want


def test_edge_rows_against_brute_force(spark, docs):
    rnd = random.Random(1)
    long_text = " ".join(rnd.choice("ab cd ef gh ij kl".split()) + str(i) for i in range(3000))
    near = long_text.replace("7 ", "7x ", 1)
    rows = [(5, "one two three four"), (4, "ONE\ttwo\nthree four"), (9, None), (2, ""), (3, " \n"),
            (7, long_text), (8, near), (7, long_text), (None, "solo words here now"), (11, "x"),
            (12, "x y"), (13, "É ß one two"), (14, "é ß one two")]
    got = S.near_duplicates(docs([(*r, "extra") for r in rows], ", fingerprint string")).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(fps)
    least = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted((str(i), signed(f), str(least.get(r))) for (i, _), f, r in zip(rows, fps, roots))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    kept = S.keep_one(docs([(*r, "extra") for r in rows], ", fingerprint string"))
    assert kept.columns[-1] == "fingerprint" and kept.count() == len(set(roots))
    assert S.near_duplicates(docs([])).count() == 0 and S.keep_one(docs([])).count() == 0


def test_blocks_do_not_change_a_fingerprint(monkeypatch):
    text = " ".join(f"w{i % 97}x{i % 13}" for i in range(500))
    whole = S.fingerprint(text.encode())
    monkeypatch.setattr(S, "BLOCK", 40)
    assert S.fingerprint(text.encode()) == whole == signed(brute_fingerprint(text))


def test_whole_table_against_brute_force(spark, sf_dir):
    from spanmill.llm.queries import QUERIES
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts.sort()
    fps = [brute_fingerprint(t) for _, t in texts]
    roots = brute_components(fps)
    want = {i: (f"{f:016x}", texts[r][0]) for (i, _), f, r in zip(texts, fps, roots)}
    got = {r.doc_id: (r.fingerprint, r.component_id)
           for r in QUERIES["op8_simhash_dedup"](spark, sf_dir).collect()}
    assert got == want
    assert np.unique([f for f, _ in want.values()]).size < len(want)
