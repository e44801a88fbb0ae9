import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from guildbook.llm import op11_prefixes as op
from tests.oracle import compare

SCHEMA = "conv_id long, turn long, role string, text string"


def token(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def brute(rows):
    """All nodes of (conv_id, turn, role, text), by dictionaries of prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), token(role, text), (role, text)))
    own = {c: [x[2] for x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    out, kids = {}, defaultdict(int)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    for path in members:
        below = [p for p in members if p[: len(path)] == path]
        out[path] = (
            members[path][0], len(path), members[path[:-1]][0] if path else None, len(members[path]), kids[path], sum(not kids[p] for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p), hashlib.sha256(",".join(map(str, ends[path])).encode()).hexdigest(),
        )
    return sorted(out.values(), key=str)


def got(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", n long, token string, depth int").repartition(parts)
    return sorted(map(tuple, op.prefix_trie(df).collect()), key=str)


def some(seed, convs, turns, texts):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "bot"]) if t % 3 else "user", "ü" * rng.randrange(texts) + "x" * (t % 2)) for c in convs for t in range(rng.randrange(turns))]


@pytest.mark.parametrize("block", [64, 2, 1])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(op, "BLOCK", block)
    monkeypatch.setattr(op, "CHUNK", 3)
    rows = some(1, [*range(60), 101, 103, 104, 203], 9, 2)
    rows += [(c, t, "user", f"copy {t}") for c in range(300, 330) for t in range(6)]  # a large group of copies
    rows += [(5, 2, "user", "a"), (5, 2, "user", "a"), (5, 2, "bot", "b"), (5, None, None, None), (5, None, "z", ""), (None, 1, "user", "nobody")]
    assert got(spark, rows) == brute(rows)


def test_long_shared_conversations(spark, monkeypatch):
    """Blocks that are shared, that end at a block's edge, and that one conversation alone goes on with."""
    monkeypatch.setattr(op, "BLOCK", 4)
    rows = []
    for c, n in ((1000, 30), (1001, 30), (1002, 8), (1003, 12), (1004, 13), (1005, 17), (1010, 8), (1015, 9)):
        rows += [(c, t, "user", "same" if t < 20 or c != 1001 else "other") for t in range(n)]
    assert got(spark, rows) == brute(rows)


def test_one_shard_and_many(spark):
    rows = some(2, range(40), 8, 2)
    want = brute(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "37"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert got(spark, rows) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_turnless_and_empty(spark):
    # 106: crc32 mod 9 of its number may be beyond its turns, and 105 is absent.
    rows = [(c, 0, "user", "one") for c in (101, 106, 107, 111, 112)]
    assert got(spark, rows) == brute(rows)
    assert any(r[1] == 0 for r in got(spark, rows))
    assert got(spark, []) == []


def test_query_against_sql(spark):
    compare(spark, "op11_prefixes", op.op11_prefixes, op.SQL, "/root/testdata/sf0.01")


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, op.op11_prefixes(spark, sf).collect()), key=str) == brute(rows)
