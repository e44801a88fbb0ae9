import duckdb
import numpy as np
import pytest

from guildbook.llm import op5_substrings as op
from guildbook.llm.fm_index import FMIndex

SCHEMA = "doc_id long, text string, digest string, start int"


def brute(rows):
    """n_words, kept words per (doc_id, text), in order of doc_id."""
    first, out = {}, {}
    docs = sorted(dict.fromkeys((i, t or "") for i, t in rows))
    words = {d: [x.decode() for x in d[1].encode().split()] for d in docs}
    for d in docs:
        for s in range(len(words[d]) - 19):
            first.setdefault(tuple(words[d][s : s + 20]), (d, s))
    for d in docs:
        gone = set()
        for s in range(len(words[d]) - 19):
            if first[tuple(words[d][s : s + 20])] != (d, s):
                gone.update(range(s, s + 20))
        out[d] = [x for k, x in enumerate(words[d]) if k not in gone]
    return words, out


def sample_rows():
    rng = np.random.default_rng(5)
    word = lambda n: [f"w{k}" for k in rng.integers(0, 400, n)]
    shared = [word(int(n)) for n in rng.integers(12, 70, 12)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(int(rng.integers(1, 5))):
            parts += word(int(rng.integers(0, 40))) + shared[int(rng.integers(0, 12))]
        rows.append((i, " ".join(parts)))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (201, rows[3][1]), (202, None), (203, ""), (204, "a b c"), (205, "a b c"), (206, "x " * 500), (207, "x\t" * 300 + "é" * 5000)]
    return rows


@pytest.mark.parametrize("hot", [256, 3])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(op, "HOT", hot)
    rows = sample_rows()
    words, kept = brute(rows)
    want = sorted((i, len(words[i, t or ""]), len(words[i, t or ""]) - len(kept[i, t or ""]), __import__("hashlib").sha256(" ".join(kept[i, t or ""]).encode()).hexdigest()) for i, t in rows)
    df = spark.createDataFrame([(i, t, "d", 0) for i, t in rows], SCHEMA)
    assert sorted(map(tuple, op.counted(df.repartition(3)).collect())) == want
    if hot == 256:
        texts = sorted((r["doc_id"], r["text"] and r["text"].split()) for r in op.drop_repeats(df).collect())
        assert [(i, t or []) for i, t in texts] == sorted((i, kept[i, t or ""]) for i, t in rows)


def test_equal_windows_of_a_hot_anchor_never_meet_in_a_task(spark, monkeypatch):
    monkeypatch.setattr(op, "HOT", 3)
    monkeypatch.setattr(op, "LEAST", 1)
    rng = np.random.default_rng(6)
    word = lambda n: [f"w{k}" for k in rng.integers(0, 4000, n)]
    line = word(24)
    rows = [(i, " ".join(word(25) + line + word(25))) for i in range(40)]
    most = spark.sparkContext.accumulator(0)
    search = op.search

    def watched(pdf):
        most.add(len(pdf))
        return search(pdf)

    monkeypatch.setattr(op, "search", watched)
    words, kept = brute(rows)
    got = {r["doc_id"]: r["n_removed"] for r in op.counted(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: len(words[i, t]) - len(kept[i, t]) for i, t in rows} and sum(got.values()) == 39 * 24
    # All passages around the line have hot anchors or stand once: none of their windows comes to a search.
    assert most.value <= 3


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    assert sorted(map(tuple, op.op5_substrings(spark, sf).collect())) == sorted(con.execute(op.SQL).fetchall())


def test_empty(spark):
    assert op.counted(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_index_counts_every_pattern():
    rng = np.random.default_rng(2)
    text = np.concatenate([np.append(rng.integers(1, 6, 40), 0) for _ in range(12)])
    index = FMIndex(text, 6, 5, np.arange(len(text)))
    begin, length = np.arange(12) * 41, np.full(12, 40)
    seen = 0
    for _, place, low, high in index.windows(text, begin, length):
        assert index.least(low, high).tolist() == [index.value[a:b].min() for a, b in zip(low, high, strict=True)]
        for p, a, b in zip(place, low, high, strict=True):
            want = sum(np.array_equal(text[k : k + 5], text[p : p + 5]) for k in range(len(text) - 4))
            assert b - a == want
            assert all(np.array_equal(text[k : k + 5], text[p : p + 5]) for k in index.value[a:b])
            seen += 1
    assert seen == 12 * 36


def test_ids_beyond_floats_beside_a_null(spark):
    rng = np.random.default_rng(9)
    common = [f"c{k}" for k in rng.integers(0, 900, 60)]
    rows = [(i, " ".join([f"a{k}"] + common[k : k + 40] + [f"b{k}"])) for k, i in enumerate([2**60 + 1, 2**60 + 2, None, 2**60 + 3, -(2**62) - 1])]
    _, want = brute([(-(2**63) if i is None else i, t) for i, t in rows])
    got = {r["doc_id"]: r["n_words"] - r["n_removed"] for r in op.counted(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {-(2**63) if i is None else i: n for i, n in got.items()} == {i: len(words) for (i, _), words in want.items()}


def test_words_whose_sums_over_powers_are_equal(spark):
    a = "".join("ab"[bin(k).count("1") % 2] for k in range(2048))
    b = a.translate(str.maketrans("ab", "ba"))
    rest = [f"w{k}" for k in range(19)]
    rows = [(1, " ".join([a, *rest])), (2, " ".join([b, *rest])), (3, " ".join([b, *rest]))]
    got = {r["doc_id"]: r["n_removed"] for r in op.counted(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 0, 3: 20}
