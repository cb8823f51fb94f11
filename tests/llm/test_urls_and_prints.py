import hashlib
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from spanmill.llm import queries as Q
from spanmill.llm import url_cascade as U
from spanmill.llm import weighted_fingerprints as W

# URL filter


def brute_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest, re.S).group()
    path = re.match(r"[^?#]*", rest[len(host):], re.S).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def brute_rule(host, path, rules):
    best = None
    for text, says in rules:
        domain, slash, below = text.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith(slash + below):
            if best is None or len(text) > len(best[0]):
                best = (text, says)
    return best or (None, None)


URLS = [None, "", "no scheme", "http://", "HTTP://Example.NET/en/x", "https://a.b.example.net/en", "x://net/",
        "http://example.com/de/1?q#f", "http://example.com?x=/de/", "http://é.ORG/fr/ü", "http://org#/fr/",
        "a://b://c/d", "http://notexample.com/de/", "http://net", "http://m.casino-win.example.com/en/1",
        "http://\nx/y", "http://casino-win.example.com/"]


def test_split_and_rules(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(4, URLS[4], "x"), (None, URLS[7], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    listed = spark.createDataFrame([("example.com",), ("é.org/fr/ü",), (None,), ("elsewhere",)], "key string")
    got = U.judge(pages, Q.URL_RULES, listed).collect()
    want = []
    for i, u, _ in rows:
        host, path = brute_split(u)
        rule, says = brute_rule(host, path, Q.URL_RULES)
        says = says or ("block" if host + path in ("example.com", "é.org/fr/ü") else "allow")
        want.append(str((i, host, path, rule, says)))
    assert sorted(str(tuple(r)) for r in got) == sorted(want)
    assert U.judge(pages.limit(0), Q.URL_RULES, listed).count() == 0
    assert {r.verdict for r in U.judge(pages, [], listed.limit(0)).collect()} == {"allow"}


def test_cascade_is_exact(spark, monkeypatch):
    monkeypatch.setattr(U, "KEY_BITS", 3)  # many false positives, so many levels
    rnd = random.Random(3)
    keys = [f"host{rnd.randrange(10 ** 6)}.example/{i}" for i in range(4000)]
    listed = set(rnd.sample(keys, 700))
    table = spark.createDataFrame([(k,) for k in keys for _ in range(1 + (k < "host2"))], "key string")
    marks = spark.createDataFrame([(k,) for k in [*listed, "not in the corpus"]], "key string")
    for shard_bits in (U.SHARD_BITS, 700):
        monkeypatch.setattr(U, "SHARD_BITS", shard_bits)
        cascades = U.build(table, marks)
        assert max(len(c.filters) for c in cascades) > 3
        assert (len(cascades) == 1) == (shard_bits > 700)
        rows = table.distinct().select("key", *U.key_hashes(F.col("key")))
        got = {r.key: r.listed for r in U.is_listed(rows, cascades, ["key"]).collect()}
        assert got == {k: k in listed for k in set(keys)}


# fingerprints


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]


def weights(text):
    out = {}
    for w in words(text):
        out[w] = out.get(w, 0) + len(w)
    return out


def jaccard(a, b):
    a, b = weights(a), weights(b)
    keys = {*a, *b}
    top = sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / top if top else 1.0


def brute_edit(text, following):
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def check_prints(rows, got):
    """rows (doc_id, text) in order."""
    assert len(got) == len(rows)
    texts = [t or "" for _, t in rows]
    off = []
    for k, ((i, _), r) in enumerate(zip(rows, got)):
        nxt = texts[(k + 1) % len(texts)]
        other = brute_edit(texts[k], nxt)
        assert (r.doc_id, r.n_chars) == (i, len(texts[k]))
        assert r.edited_sha256 == hashlib.sha256(other.encode()).hexdigest()
        assert len(r.fingerprint) == len(r.edited_fingerprint) == W.SAMPLES * W.DIGITS
        assert (r.fingerprint == r.edited_fingerprint) >= (other == texts[k])
        for near, truth in ((r.near_edited, jaccard(texts[k], other)), (r.near_next, jaccard(texts[k], nxt))):
            off.append(near - truth)
            assert abs(near - truth) < 5 * math.sqrt(0.25 / W.SAMPLES) + 1e-9
    same = {}
    for t, r in zip(texts, got):
        assert same.setdefault(t, r.fingerprint) == r.fingerprint
    return np.array(off)


def test_gamma_quantiles(spark):
    q = np.array(W.gamma_table(spark).first().r)
    assert abs(q.mean() - 2) < 0.01 and abs(q.var() - 2) < 0.05 and (np.diff(q) > 0).all()


def test_edge_rows(spark, docs, monkeypatch):
    rnd = random.Random(2)
    vocab = [f"w{i}" * (1 + i % 4) for i in range(300)]
    rows = [(-5, None), (-4, ""), (-3, " \n "), (-2, "one"), (-1, "é😀 ß"), (0, "one"), (7, "x y x y x y")]
    rows += [(10 + 3 * i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 300)))) for i in range(120)]
    rows += [(10 ** 15, "far " * 4000), (10 ** 15 + 1, "far " * 3000 + "near " * 1000)]
    for size in (W.RANGE_ROWS, 3):
        monkeypatch.setattr(W, "RANGE_ROWS", size)
        got = W.fingerprints(docs([(*r, 1) for r in rows], ", part string")).collect()
        off = check_prints(rows, sorted(got, key=lambda r: r.doc_id))
        assert abs(off.mean()) < 0.02
    twice = W.fingerprints(docs([(1, "a b"), (1, "a b"), (None, "c"), (1, "a c")])).collect()
    assert sorted(r.n_chars for r in twice) == [1, 3, 3, 3]
    alone = W.fingerprints(docs([(1, "a b c d")])).collect()
    assert alone[0].near_next == 1.0
    assert W.fingerprints(docs([])).count() == 0


def test_whole_table(spark, sf_dir):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    got = sorted(Q.QUERIES["op6_weighted_fingerprints"](spark, sf_dir).collect(), key=lambda r: r.doc_id)
    off = check_prints(rows, got)
    assert abs(off.mean()) < 0.02 and math.sqrt((off ** 2).mean()) < 0.07
