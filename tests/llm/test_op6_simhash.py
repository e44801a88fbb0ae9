import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from guildbook.llm import op6_simhash as op
from guildbook.llm.components import components, forest


def brute_fingerprint(text):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).translate({c: " " for c in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """Least id reachable, for a dict id -> fingerprint."""
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    values = np.array([fps[i] for i in ids], np.uint64)
    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[k]) <= 2):
            a, b = sorted((find(i), find(ids[j])))
            root[b] = a
    return {i: find(i) for i in ids}


def test_fingerprints(spark):
    texts = ["", "  \t", "One", "one two", "One TWO three É", "a b c d e f g " * 50, "x" * 10000, "a b c\x0bd e"]
    for t in texts:
        assert op.fingerprint(t.encode()) == brute_fingerprint(t), t
    assert spark.sql("select xxhash64('one two')").first()[0] == np.uint64(xxhash.xxh64_intdigest(b"one two", 42)).astype(np.int64)


@pytest.mark.parametrize("shards", [1, 7, 64])
def test_shards_find_every_link(shards):
    rng = np.random.default_rng(shards)
    base = rng.integers(0, 2**63, 60).astype(np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (60, 30, 3)).astype(np.uint64)
    fps = np.unique(np.concatenate([base, (base[:, None] ^ np.bitwise_xor.reduce(flips, axis=2)).ravel()]))
    nodes = op.plant(fps[::3], shards)
    home = np.full(len(fps), -1)
    routed = op.route(fps, nodes)
    for which, shard, at_home in routed:
        assert (home[which[at_home]] == -1).all()
        home[which[at_home]] = shard
    assert (home >= 0).all()
    pairs = []
    for which, shard, at_home in routed:
        later = home[which] < shard
        pairs.append(op.shard_links(fps[which[at_home]], fps[which[~at_home & later]]))
    stars = {int(a): int(b) for a, b in forest(np.concatenate(pairs))}
    want = brute_components({int(f): int(f) for f in fps})
    assert {int(f): stars.get(int(f), int(f)) for f in fps} == want


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    fps = {i: brute_fingerprint(t) for i, t in docs.items()}
    want = brute_components(fps)
    got = op.op6_simhash(spark, sf).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{fps[i]:016x}", want[i]) for i in docs}
    assert len(got) == len(docs)


def test_defined_cases(spark):
    rows = [(1, None, 7), (2, "", 7), (3, "a b c d", 7), (3, "a b c d", 7), (None, "a b c d", 7)]
    got = op.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp long")).collect()
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in got) == [("1", 1), ("2", 1), ("3", 3), ("3", 3), ("None", 3)]
    assert op.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_paths_and_stars(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(5, 5), (200, 150)]
    got = components(spark.createDataFrame(pairs, "a long, b long"), "n").collect()
    assert {r["n"]: r["root"] for r in got} == {i: 0 for i in range(41)} | {i: 100 for i in [*range(100, 160), 200]}
    assert components(spark.createDataFrame([], "a long, b long").select(F.col("a"), F.col("b")), "n").count() == 0
