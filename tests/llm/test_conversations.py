import hashlib
import random
import zlib
from collections import defaultdict

from claimwright.llm import conversations as c


def brute(rows):
    """Nodes from the rebuilt texts themselves."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append((turn is not None, turn or 0, *[hashlib.md5(x.encode()).hexdigest() for x in (role, text)], role, text))
    own = {k: [t[-2:] for t in sorted(v)] for k, v in turns.items()}
    rebuilt = {}
    for k, v in own.items():
        h = zlib.crc32(str(k).encode()) % 6
        rebuilt[k] = tuple(own.get(k - k % 100, [])[:h] + v[h:])
    members = defaultdict(list)
    for k in sorted(rebuilt):
        for d in range(len(rebuilt[k]) + 1):
            members[rebuilt[k][:d]].append(k)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        saved[node] = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(saved[x] for x in below)
    return sorted(
        (
            m[0], len(n), members[n[:-1]][0] if n else -1, len(m), len(children[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(str(k) for k in m if len(rebuilt[k]) == len(n)).encode()).hexdigest(),
        )
        for n, m in members.items()
    )


def got(frame):
    rows = [tuple(-1 if x is None else x for x in r) for r in c.prefix_trie(frame.sparkSession, frame).collect()]
    return sorted(rows)


SCHEMA = "conv_id long, turn long, role string, text string, depth int, k1 string"


def conversations():
    rnd = random.Random(8)
    rows = []
    for conv in rnd.sample(range(1, 420), 180) + [0, 200]:
        for turn in range(rnd.randint(1, 9)):
            rows.append((conv, turn, rnd.choice(["user", "assistant"]) if turn > 1 else "user", f"t{turn}é" * rnd.choice([1, 1, 1, 2])))
    rows += [(500 + i, t, "user", "same") for i in range(60) for t in range(4)]  # copies
    rows += [(3, None, None, None), (3, None, "user", None), (700, 0, "", ""), (700, 0, "", ""), (701, 5, "a", "bc"), (702, 5, "ab", "c"), (None, 1, "user", "lost")]
    rows += [(800, t, "user", "long") for t in range(150)] + [(803, t, "user", "long") for t in range(150)] + [(900, 0, "x", "y" * 100_000)]
    rnd.shuffle(rows)
    return rows


def test_trie_equals_brute_force(spark, monkeypatch):
    rows = conversations()
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(7)
    want = brute(rows)
    assert got(frame) == want
    monkeypatch.setattr(c, "PIECE", 16)
    assert got(frame) == want


def test_collisions_are_found_and_done_again(spark, monkeypatch):
    rows = conversations()[:200]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    tried = []
    real = c.fingerprinted

    def weak(session, turns, attempt):
        tried.append(attempt)
        found = real(session, turns, attempt)
        return found if attempt else found.selectExpr("conv_id", "place", "size", *[f"place % 2 as s{i}" for i in range(4)])

    monkeypatch.setattr(c, "fingerprinted", weak)
    assert got(frame) == brute(rows) and tried == [0, 1]


def test_empty_and_turnless(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(None, 0, "a", "b", 1, "x")], SCHEMA)) == []
    alone = next(k for k in range(1, 100) if zlib.crc32(str(k).encode()) % 6 > 1)
    rows = [(alone, 0, "user", "gone")]
    assert got(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)) == brute(rows)
