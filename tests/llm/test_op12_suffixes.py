import hashlib
import pathlib
import random

import numpy as np
import pytest

from guildbook.llm import op12_suffixes as op
from guildbook.llm.common import shared_folder
from tests.oracle import compare

WIDTH = 50


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, kept) by a dictionary of all windows; null doc_id is the least."""
    rows = [(d, (t or "").encode()) for d, t in rows]
    low = {}
    key = lambda d: (d is not None, d or 0)
    for d, t in rows:
        for s in range(len(t) - WIDTH + 1):
            w = t[s : s + WIDTH]
            low[w] = min(low.get(w, key(d)), key(d))
    out = []
    for d, t in rows:
        gone = [False] * len(t)
        for s in range(len(t) - WIDTH + 1):
            if low[t[s : s + WIDTH]] < key(d):
                gone[s : s + WIDTH] = [True] * WIDTH
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "o", 5, [1]) for r in rows], "doc_id long, text string, ord string, mark int, spans array<int>").repartition(parts)
    found = op.drop_repeats(df).collect()
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in found), key=str)


def prose(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gämma", "delta", "eins", "zwei", "über", "x", "yy", "漢字"]) for _ in range(n))


def some(seed, n):
    """Documents that share passages, cut anywhere, with near copies and whole copies."""
    rng = random.Random(seed)
    shared = [prose(rng, 30) for _ in range(6)]
    rows = []
    for d in range(n):
        text = prose(rng, 12) + str(rng.random())
        for _ in range(rng.randrange(3)):
            p = rng.choice(shared)
            a = rng.randrange(len(p))
            text += p[a : a + rng.randrange(40, 140)] + str(rng.random())
        rows.append((d, text))
    rows += [(n + k, rows[k][1]) for k in range(0, n, 4)] + [(2 * n + k, rows[k][1].replace("alpha", "alphb", 1)) for k in range(0, n, 3)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [256, 1])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(op, "HOT", hot)
    rows = some(1, 60)
    rows += [(None, rows[3][1]), (None, "short"), (500, None), (501, ""), (502, rows[5][1]), (502, rows[5][1]), (502, rows[6][1] + rows[5][1]), (-(2**62), rows[9][1][:70]), (2**60 + 1, rows[9][1]), (2**60 + 2, rows[9][1])]
    assert got(spark, rows) == brute(rows)


def test_periods_and_ties(spark):
    """Long runs of one byte and of short periods: equal grams everywhere, and windows that overlap themselves."""
    rows = [(1, "-" * 700), (2, "x" + "-" * 400 + "y"), (3, "ab" * 300), (4, "b" + "ab" * 40 + "c"), (5, "-" * 49), (6, "-" * 50), (7, "q" * 300), (8, "ab" * 24 + "-" * 60)]
    assert got(spark, rows) == brute(rows)


def test_lengths_at_the_bound(spark):
    rng = random.Random(3)
    letters = "".join(rng.choice("abcdefghij") for _ in range(200))
    rows = [(1, letters), (2, "!" + letters[20:69] + "?"), (3, "+" + letters[20:70] + "?"), (4, letters[100:150]), (5, letters[150:]), (6, letters[:49]), (7, "ü" * 25), (8, "ü" * 24 + "u")]
    want = brute(rows)
    assert got(spark, rows) == want
    assert {r[0]: r[2] for r in want} == {1: 0, 2: 0, 3: 50, 4: 50, 5: 50, 6: 0, 7: 0, 8: 0}


def test_long_text_in_parts(spark, monkeypatch):
    monkeypatch.setattr(op, "STEP", 300)
    rows = some(5, 20)
    rows = [(d, t * 3) for d, t in rows] + [(900, "".join(t for _, t in rows))]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", range(4))
def test_common_prefixes(seed):
    """Neighbours in suffix order are apart exactly where their common prefix is shorter than the width."""
    rng = np.random.default_rng(seed)
    words = [bytes(rng.integers(97, 97 + 1 + seed, rng.integers(1, 90)).tolist()) for _ in range(40)]
    words += [words[k] for k in range(0, 40, 3)]
    text = np.frombuffer(b"".join(w + b"\xff" for w in words), np.uint8)
    order = op.suffixes(text)
    tail = text.tobytes()
    cut = [tail[p : p + 64] for p in order]
    assert cut == sorted(cut)
    known = op.apart(text, order, WIDTH)
    for i in range(1, len(text)):
        a, b = tail[order[i - 1] :][:WIDTH], tail[order[i] :][:WIDTH]
        if b"\xff" not in a or b"\xff" not in b:
            assert known[i] == (a != b or len(a) < WIDTH), (i, a, b)


def test_a_hot_passage(spark):
    rng = random.Random(8)
    line = "this very common line of a licence stands in every document of the table, whatever else it says. "
    rows = [(d, prose(rng, 3) + str(rng.random()) + line + str(rng.random())) for d in range(400)]
    assert got(spark, rows) == brute(rows)


def test_anchors_travel_in_lists(spark, monkeypatch):
    """Rows between documents and anchors follow blocks and shares, not the number of anchors."""
    rows, sizes, write = some(11, 40), {}, op.staged

    def counted(df, label):
        out = write(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(op, "staged", counted)
    monkeypatch.setattr(op, "LEAST", 3)
    assert got(spark, rows) == brute(rows)
    assert 0 < sizes["anchors"] <= 9 and sizes["passages"] > 100


def written(spark, monkeypatch, rows):
    """Rows of each table that is written on the way, and the result."""
    sizes, write = {}, op.staged

    def counted(df, label):
        out = write(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(op, "staged", counted)
    return sizes, got(spark, rows)


def test_common_phrases_are_cut_by_longer_anchors(spark, monkeypatch):
    """A phrase in many contexts is not cut into all its windows, of which a larger table has more and more."""
    rng = random.Random(21)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    phrase = letters(38)
    rows = [(d, letters(60) + phrase + letters(60)) for d in range(300)]
    rows += [(300 + d, letters(40) + rows[d][1][20:120] + letters(40)) for d in range(0, 300, 10)]
    monkeypatch.setattr(op, "HOT", 64)
    sizes, found = written(spark, monkeypatch, rows)
    assert found == brute(rows) and sum(r[2] for r in found) > 30 * 90
    assert 300 < sizes["parts"] < 5 * len(rows), sizes


def test_whole_copies_have_no_passages(spark, monkeypatch):
    """Of equal texts only the first one's anchors are looked for; null doc_id is the least, and repeated rows are no copies."""
    rng = random.Random(22)
    texts = [prose(rng, 40) + str(k) for k in range(5)]
    rows = [(10 * k + d, texts[k]) for k in range(5) for d in range(8)] + [(None, texts[0]), (10, texts[1]), (90, "short"), (91, "short"), (92, "q" * 50), (93, "q" * 50)]
    sizes, found = written(spark, monkeypatch, rows)
    assert found == brute(rows)
    assert sizes["copies"] == 8 + 4 * 7 + 1 and sizes["passages"] < 40


def test_written_tables_go_when_they_are_used(spark):
    """Beside the spans that go, nothing stays on disk before the texts are cut."""
    folder = pathlib.Path(shared_folder(spark).removeprefix("file://")) / "guildbook"
    before = set(folder.glob("*"))
    spans = op.lost_spans(op.keyed(spark.createDataFrame(some(12, 40), "doc_id long, text string")))
    assert spans.count() > 0
    assert [p.name.split("-")[0] for p in set(folder.glob("*")) - before] == ["lost"]


def test_query_against_sql(spark):
    compare(spark, "op12_suffixes", op.op12_suffixes, op.SQL, "/root/testdata/sf0.001")


def test_empty(spark):
    assert got(spark, []) == [] == brute([])
    assert got(spark, [(1, None), (2, "")]) == brute([(1, None), (2, "")])
