import hashlib
import math
import re

import regex

from spanmill.llm import weak_pii as P
from spanmill.llm.queries import QUERIES

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    s = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        s += x - 9 * (x > 9)
    return s % 10 == 0


def brute(text):
    out = []
    for k, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": all(int(x) <= 255 for x in m.group().split("."))
                if kind == "ip" else True, "card": 12 <= len(d) <= 19 and luhn(d),
                    "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


EDGE = [
    None, "", "no data", "a@b.c", "a@b.c_d@e.f", "x@@y.z q@r.s.t.", "a@b a.b@c-d.e", "é😀 mail a@b.co é",
    "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.001.2.3 1.2.3", "1..2.3.4.5", "9.1.2.3.444",
    "4111 1111 1111 1111", "4111-1111-1111-1111x", "4111 1111 1111 1112", "1 -2 4111111111111111",
    "4111111111111111 4111111111111111", "0000000000000000", "12345", "+1 (980) 555-6268",
    "+1234567 +12345678901234567 ++49 30 123456-", "+1(((((((((", "+49 151 23456789\n+49 151 23456789",
    "1" * 5000, "a" * 20000 + "@x.y", "a@" + "b." * 3000 + "c", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1",
    "tel +1 212 555 0100, mail a@b.org, ip 10.0.0.1, card 4111111111111111",
    "1 " * 6000, "(980) 555-6268 and 980-555-6268", "ssn 123-45-6789", 'token = "0b96a8c8d79c4a50"',
]


def test_base_spans_of_edge_texts(spark, docs):
    rows = list(enumerate(EDGE)) + [(3, "a@b.c"), (None, "c@d.e")]
    table = docs([(*r, "x") for r in rows], ", spans string")
    got = [(r.doc_id, [(s.start, s.k, s.end, s.kind) for s in r.spans if s.base])
           for r in P.find(table).collect()]
    assert sorted(map(str, got)) == sorted(str((i, brute(t))) for i, t in rows)
    hidden = {r.doc_id: r for r in P.masked(table).collect()}
    assert P.masked(table).columns == table.columns and len(hidden) == len(EDGE) + 1
    assert hidden[28].text == "tel <phone>, mail <email>, ip <ip>, card <card>"
    assert hidden[0].text is None and hidden[1].text == "" and hidden[2].text == "no data"
    assert hidden[7].text == "é😀 mail <email> é" and hidden[7].n_chars == len(hidden[7].text)
    assert P.find(docs([])).count() == 0 and P.masked(docs([])).count() == 0


def test_estimation_finds_a_bad_voter():
    # three voters of 90 % and one that guesses; kinds with few and with many real spans
    patterns = {}
    for kind, real in (("secret", 0.2), ("ssn", 0.7)):
        for votes in [(a, b, c, d) for a in (-1, 1) for b in (-1, 1) for c in (-1, 1)
                      for d in (-1, 1)]:
            for y, share in ((1, real), (-1, 1 - real)):
                p = share
                for v in votes[:3]:
                    p *= 0.9 if v == y else 0.1
                patterns[kind, *votes] = patterns.get((kind, *votes), 0) + 5000 * p
    got = P.reliabilities(patterns)
    for (kind, *votes), p in got.items():
        if len(set(votes[:3])) == 1:
            assert (p > 0.9) == (votes[0] == 1)
        assert abs(p - got[kind, *votes[:3], -votes[3]]) < 0.02
    weights = P.train_classifier({(*k, 1, 2, 0, 2): c for k, c in patterns.items()})
    assert weights["strict1"] > weights["context1"] + 0.5


def test_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op1_weak_pii"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        spans = brute(texts[r.doc_id])
        digest = ",".join(f"{k}:{a}:{z}" for a, _, z, k in spans)
        assert r.base_sha256 == hashlib.sha256(digest.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(s[3] == k for s in spans) for k in RULES]
        assert not spans or set(digest.split(",")) <= set(r.spans.split(","))


def votes_of(kind, value, before):
    """The labelers' votes on a looser candidate and what the classifier sees, in plain Python."""
    digits, kinds = re.sub("[^0-9]", "", value), len(set(value.lower()))
    yes = lambda hit: 1 if hit else -1
    checksum = {"account": yes(kinds >= 6), "secret": yes(kinds >= 12 and bool(re.search("[0-9]", value)))}
    context = -1 if re.search(P.AGAINST, before) else int(bool(re.search(P.CUES[kind], before)))
    place = 0 if not before else 1 if before[-1] == "\n" else 2 if before[-1] == " " else 3
    return (kind, yes(re.search(P.STRICT[kind], value)), checksum.get(kind, 0),
            yes(re.search(P.GAZETTEER[kind], value)), context,
            min(len(value) // 8, 4), 4 * len(digits) // len(value), int(bool(re.search("[A-Z]", value))), place)


def loose(text):
    """(start, place in KINDS, end, kind, pattern) of the looser candidates."""
    for k, kind in enumerate(P.KINDS[4:], 4):
        end = 0
        for m in regex.finditer(P.PATTERNS[kind][1], text or ""):
            d = re.sub("[^0-9]", "", m.group())
            before = text[max(end, m.start() - P.BEFORE):m.start()]
            end = m.end()
            if kind != "account" or 12 <= len(d) <= 19 and not luhn(d):
                yield m.start(), k, m.end(), kind, votes_of(kind, m.group(), before)


LOOSE = ["token = \"0b96a8c8d79c4a500b96a8c8d79c4a50\" and x", "secret: 'aaaaaaaaaaaaaaaa'", "auth=\"" + "aZ9" * 400 + "\"",
         "password = \"changeme-example\"", "card 4111111111111112", "order 0000 0000 0000 0001",
         "konto 4929963689861573\n4929963689861573", "123456789012", "iban DE89370400440532013000, x",
         "ssn 123-45-6789 or 212-45-6789", "tel (212) 555-1234", "call 999-555-0123", "version 5399999999999999",
         "+4915123456789012", "1.4929963689861573 4929963689861573.5"]


def test_all_spans_against_plain_python(spark, docs):
    """Candidates, votes and the classifier's decisions, restated; the fit itself is the module's."""
    from collections import Counter

    texts = LOOSE * 3 + EDGE + ["see " + t + " end" for t in LOOSE]
    counts = Counter()
    for t in texts:
        counts.update(p for *_, p in loose(t))
    scanned = P.written(P.scan(docs(list(enumerate(texts))), ["doc_id"]))
    spans = P.written(P.candidates(scanned))
    rows = spans.where("valid").where(~P.F.col("kind").isin(*P.BASE)).groupBy("kind", *P.VOTERS, *P.SEEN).count()
    assert {tuple(r)[:-1]: r["count"] for r in rows.collect()} == counts
    assert {k for k, *_ in counts} == set(P.KINDS[4:]) and len(counts) > 15

    groups = spans.where(P.F.col("valid") | P.F.col("kind").isin(*P.BASE)).groupBy(
        "kind", *P.VOTERS, *P.SEEN).count().collect()
    weights = P.train_classifier({tuple(r)[:-1]: float(r["count"]) for r in groups})
    chosen = lambda p: 1 / (1 + math.exp(-sum(weights[f] for f in P._features(p)))) >= P.ACCEPT
    got = {r.doc_id: [(s.start, s.k, s.end) for s in r.spans] for r in P.find(docs(list(enumerate(texts)))).collect()}
    taken = 0
    for i, t in enumerate(texts):
        more = [(a, k, z) for a, k, z, _, p in loose(t) if chosen(p)]
        taken += len(more)
        assert got[i] == sorted([(a, k, z) for a, k, z, _ in brute(t)] + more)
    assert 0 < taken < sum(counts.values())


def test_votes_disagree_and_some_candidates_are_rejected(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    spans = P.written(P.candidates(P.written(P.scan(docs, ["doc_id"])))).where("kind = 'account' and valid")
    assert spans.select(*P.VOTERS).distinct().count() >= 3
    found = QUERIES["op1_weak_pii"](spark, "/root/testdata/sf0.1").agg({"n_other": "sum"}).first()[0]
    assert 0 < found < spans.count() + 166
