import hashlib
import random
import zlib
from collections import defaultdict

from spanmill.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"


def sort_key(row):
    _, turn, role, text = row
    role, text = role or "", text or ""
    mark = f"{len(role.encode())}:{role}{text}"
    return turn is not None, turn or 0, hashlib.sha256(mark.encode()).digest()


def rebuilt(rows):
    convs = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            convs[r[0]].append(r)
    own = {c: [(r[2] or "", r[3] or "") for r in sorted(v, key=sort_key)] for c, v in convs.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    base = {c: c - (c % 5 if c >= 0 else -(-c % 5)) for c in own}
    return {c: own.get(base[c], [])[:h[c]] + own[c][h[c]:] for c in own}


def brute(convs):
    """{conv_id: [(role, text), ...]} -> the result rows."""
    nodes = defaultdict(list)
    for c, t in convs.items():
        for d in range(len(t) + 1):
            nodes[tuple(t[:d])].append(c)
    leaves, saved, kids = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    for p, m in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1].encode()) if p else 0)
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else -1, len(m), kids[p], leaves[p],
                   saved[p], hashlib.sha256(",".join(map(str, sorted(
                       c for c in m if len(convs[c]) == len(p)))).encode()).hexdigest())
                  for p, m in nodes.items())


def found(df):
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in map(tuple, df.collect()))


def chats(seed, convs=60):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(r.randrange(1, 12)):
            rows.append((c, t if r.random() < 0.95 else None, r.choice(["user", "assistant", None]),
                         r.choice(["hi", "é😀", "", None, "ok", "long " * 9])))
    same = [("user", "hello"), ("assistant", "hi"), ("user", "more")]
    for c in range(100, 160):  # a large group of equal conversations
        rows += [(c, t, *x) for t, x in enumerate(same)]
    return rows + [(None, 0, "user", "lost"), (7, 3, "user", "twice"), (7, 3, "user", "twice"),
                   (7, 3, "user", "other"), (-7, 0, "user", "below"), (10**15, 0, "user", "far")]


def test_against_a_plain_trie(spark, monkeypatch):
    rows = chats(1)
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rebuilt(rows))
    assert any(not t for t in rebuilt(rows).values())  # a conversation without turns
    assert found(P.prefix_trie(df)) == want
    monkeypatch.setattr(P, "CHUNK_BITS", 2)
    monkeypatch.setattr(P, "SHARD", 5)
    assert found(P.prefix_trie(df.repartition(13))) == want


def test_long_conversations_in_bands(spark, monkeypatch):
    monkeypatch.setattr(P, "GROUP", 2)
    r = random.Random(2)
    turns = [(r.choice("ua"), r.choice("xyz")) for _ in range(700)]
    convs = {c: list(turns[:n]) for c, n in enumerate(
        (1, 63, 64, 65, 127, 128, 129, 256, 257, 320, 321, 500, 700, 700))}
    convs[20] = turns[:400] + [("u", "other")] * 130
    convs[21] = turns[:384] + [("u", "other")] * 64
    convs[22] = [("u", "begins otherwise")] + turns[1:300]
    rows = [(c, t, *x) for c, v in convs.items() for t, x in enumerate(v)]
    got = P.prefix_trie(spark.createDataFrame(rows, SCHEMA))
    assert found(got) == brute(rebuilt(rows))


def test_shards_of_one_prefix():
    rows = [(c, 0, b"", None, True, [b"a", b"b"][:1 + c % 2], [3, 4][:1 + c % 2]) for c in range(9, 0, -1)]
    nodes = {(n[2], n[0]): n for n in P.shard_nodes(rows)}
    (one, two) = sorted(nodes.values(), key=lambda n: n[2])
    assert one[2:] == (1, 1, 9, 3, [2, 4, 6, 8]) and two[2:] == (2, 1, 5, 4, [1, 3, 5, 7, 9])
    assert two[1] == one[0] and one[1] == b"" and list(P.shard_nodes([])) == []


def test_empty_and_extra_columns(spark):
    assert P.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert P.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0
    rows = [(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "assistant", "b" * 100_000)]
    extra = spark.createDataFrame([(*r, "x", 1, 2) for r in rows],
                                  SCHEMA + ", key string, depth long, pos long")
    assert found(P.prefix_trie(extra)) == brute(rebuilt(rows))


def test_sums_over_a_chain_and_a_star(spark):
    nodes = [(0, None, 1)] + [(k, k - 1, 1) for k in range(1, 40)] + [(k, 0, 1) for k in range(40, 90)]
    df = spark.createDataFrame([(bytes([k]), None if p is None else bytes([p]), v)
                                for k, p, v in nodes], "key binary, parent binary, n long")
    got = {r.key[0]: r.n for r in P.subtree_sums(df, ["n"], 39).collect()}
    assert got == {0: 90} | {k: 40 - k for k in range(1, 40)} | {k: 1 for k in range(40, 90)}
