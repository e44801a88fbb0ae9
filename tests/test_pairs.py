"""Pairs by keys and tokens against all pairs, and how many are tried."""

import random

import pytest
from pyspark.sql import functions as F

from guildbook.operators import match as m
from guildbook.operators import pairs as pr

EXACT, NAME = {"site": 0.3, "city": 0.1, "state": 0.1}, ("name", 0.5)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for k, y in enumerate(b, 1):
            before, row[k] = row[k], before + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


def score(a, b, exact, fuzzy):
    total = points = 0.0
    for f, w in (exact | fuzzy).items():
        if a[f] and b[f]:
            total += w
            points += w * ((a[f].lower() == b[f].lower()) if f in exact else 2 * lcs(a[f], b[f]) / (len(a[f]) + len(b[f])))
    return points / total if total else 0.0


def companies(seed, n):
    """One block: names of one first word, short and long, with small changes; fields that are missing now and then."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(k))
    names = ["acme " + " ".join(word(rng.randrange(2, 9)) for _ in range(rng.randrange(1, 4))) for _ in range(n // 3)] + ["acme", "acme a", "acme é", "acme 漢字"]
    out = []
    for i in range(n):
        name = list(rng.choice(names))
        for _ in range(rng.randrange(3)):
            k = rng.randrange(len(name))
            name[k : k + rng.randrange(2)] = rng.choice(["", "x", "yz"])
        out.append({"id": i, "name": rng.choice(["".join(name)] * 9 + [None]), "site": rng.choice(["a.com", "B.com", "b.com", "", None]), "city": rng.choice(["Akron", "akron", "Gary", ""]), "state": rng.choice(["OH", "IN", None]), "word": "acme"})
    return out


@pytest.mark.parametrize(("small", "threshold"), [(0, 0.85), (0, 0.6), (64, 0.85), (5, 0.7)])
def test_no_pair_is_lost(spark, monkeypatch, small, threshold):
    monkeypatch.setattr(pr, "SMALL", small)
    rows = companies(3, 160)
    df = spark.createDataFrame(rows, "id int, name string, site string, city string, state string, word string")
    got = {(r["u"], r["v"]): r["score"] for r in m.candidate_pairs(df, "id", ["site", "word"], EXACT, NAME, threshold).collect()}
    want = {(a["id"], b["id"]): s for a in rows for b in rows if a["id"] < b["id"] and (s := score(a, b, EXACT, dict([NAME]))) >= threshold - 1e-9}
    assert got.keys() == want.keys() and want and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_two_fuzzy_fields(spark, monkeypatch):
    monkeypatch.setattr(pr, "SMALL", 0)
    rng = random.Random(5)
    rows = [{"id": r["id"], "domain": (r["site"] or "").lower() or None, "name": r["name"], "phone": rng.choice(["5551234567", "5559876543", None]), "address": rng.choice(["1 main st akron", "1 main street akron", "99 oak ave", "", None]), "block": "x"} for r in companies(6, 90)]
    df = spark.createDataFrame(rows, "id long, domain string, name string, phone string, address string, block string")
    got = {(r["u"], r["v"]) for r in m.score_entity_pairs(df, "id", ["block"]).collect()}
    exact, fuzzy = {f: m.ENTITY_WEIGHTS[f] for f in ("domain", "phone")}, {f: m.ENTITY_WEIGHTS[f] for f in ("name", "address")}
    assert got == {(a["id"], b["id"]) for a in rows for b in rows if a["id"] < b["id"] and score(a, b, exact, fuzzy) >= 0.85 - 1e-9}


def test_tried_pairs_of_a_hot_block(spark):
    """A block with all rows, as where all names begin alike: pairs tried grow with the rows, not with their square."""
    tried = []
    for n in (600, 1200):
        rng = random.Random(n)
        word = lambda k, rng=rng: "".join(rng.choice("abcdefghiklmnoprstuvwyz") for _ in range(k))
        rows = [(i, f"acme {word(7)} {word(6)} {word(5)}", f"firm{i // 2}.com" if i % 10 else None, f"city{i % 40}", "OH", "acme") for i in range(n)]
        df = spark.createDataFrame(rows, "ord int, name string, site string, city string, state string, word string")
        tried.append(pr.tried_pairs(df, ["word"], {f: F.lower(f) for f in EXACT}, (EXACT, dict([NAME])), 0.85).count())
    assert tried[1] < 3 * tried[0] and tried[1] < 1200 * 1199 / 2 / 50, tried


def test_cases_of_two_masks():
    exact, fuzzy = {"a": 0.5}, {"n": 0.5}
    # Both have both: the exact field must be equal, and the name 0.7 alike; without exact fields the name decides.
    assert [(e, k, round(s, 6)) for e, k, s in pr.cases(3, 3, exact, fuzzy, 0.85)] == [(1, 1, 0.7)]
    assert [(e, k, round(s, 6)) for e, k, s in pr.cases(3, 2, exact, fuzzy, 0.85)] == [(0, 1, 0.85)]
    assert pr.cases(1, 3, exact, fuzzy, 0.85) == [(1, None, 0.0)] and pr.cases(1, 2, exact, fuzzy, 0.85) == []
