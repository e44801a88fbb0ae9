import numpy as np
import pytest

import corpus_pipeline as cp
from guildbook.llm import op6_simhash, op9_quality, op10_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in cp.STAGES:
        docs.append(cp.staged(stage(spark, docs[-1], SF), "test"))
    return docs


def test_columns_and_classifier(spark, stages):
    for d in stages[1:-1]:
        assert d.columns == stages[0].columns
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r["doc_id"] for r in stages[1].collect()}
    weights = op9_quality.fit(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    rows = stages[0].collect()
    scores = op9_quality.score([r["text"].encode() for r in rows], weights)
    assert left == {r["doc_id"] for r, s in zip(rows, scores, strict=True) if s >= 0.3}
    assert np.mean([i in left for i, q in labels.items() if q == 1]) > 0.95


def test_one_of_each_near_duplicate_group_stays(stages):
    from tests.llm.test_op6_simhash import brute_components, brute_fingerprint

    before = {r["doc_id"]: r["text"] for r in stages[1].collect()}
    least = brute_components({i: brute_fingerprint(t) for i, t in before.items()})
    assert sorted(r["doc_id"] for r in stages[2].collect()) == sorted(i for i in before if least[i] == i)
    assert op6_simhash.DISTANCE == 2


def test_documents_without_an_id_of_their_own_stay(spark):
    from tests.llm.test_op6_simhash import brute_components, brute_fingerprint

    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 5000, 60)) for _ in range(12)]
    rows = [(None, t, "en") for t in texts[:5]] + [(7, t, "en") for t in texts[5:9]] + [(7, texts[9], "en")] * 2
    rows += [(1, texts[0], "en"), (2, texts[5], "en"), (None, texts[10], "en"), (None, texts[10], "en"), (9, texts[10], "en"), (9, texts[11], "en"), (3, None, "en"), (3, "", "en")]
    least = brute_components({i: brute_fingerprint(t) for i, (_, t, _) in enumerate(rows)})
    groups = {}
    for i, (doc, text, _) in enumerate(rows):
        groups.setdefault(least[i], []).append((doc is None, doc or 0, text or ""))
    got = cp.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3), SF)
    assert got.columns == ["doc_id", "text", "lang"]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in got.collect()) == sorted(min(g) for g in groups.values())
    assert len(groups) == 13


def test_repeated_passages_go(stages):
    from tests.llm.test_op5_substrings import brute

    before = [(r["doc_id"], r["text"]) for r in stages[2].collect()]
    _, kept = brute(before)
    after = {r["doc_id"]: r for r in stages[3].collect()}
    assert {i: (r["text"] or "").split() for i, r in after.items()} == {i: [*kept[i, t]] for i, t in before}
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_secrets_are_out(stages):
    from tests.llm.test_op4_secrets import brute

    before = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    after = {r["doc_id"]: r["text"] for r in stages[4].collect()}
    assert before.keys() == after.keys()
    for i, t in before.items():
        assert (after[i] == t) == (not brute(t)[0])
        assert not any(x[0] == "hex" for x in brute(after[i])[0])


def test_pieces_fill_sequences(stages):
    from tests.llm.test_op10_packing import check_packing

    check_packing([(r["doc_id"], r["text"]) for r in stages[4].collect()], stages[5].collect(), op10_packing.default_path())


WORDS = [f"w{k}" for k in range(4000)]
CLASHES = ["_score", "_spans", "_key", "_mark", "_id", "_blob", "_stay", "_lost", "score", "mark", "spans", "blob", "residue", "places", "hit", "n_words", "quality", "row", "piece", "group", "shard", "fp"]


def odd_docs(spark, clashes):
    """Documents with nulls in every column, an empty and a long text, repeated rows, and columns that clash with working names."""
    rng = np.random.default_rng(12)
    text = lambda n: " ".join(rng.choice(WORDS, n))
    passage, secret = text(60), "password = abcdef0123456789abcdef"
    rows = [(i, text(80)) for i in range(20)] + [(None, text(80)), (7, text(80)), (None, None), (30, None), (31, ""), (32, text(60_000))]
    rows += [(40, text(30) + " " + passage + " " + text(30)), (41, text(30) + " " + passage + " " + text(30)), (42, f"{text(40)} {secret} {text(40)}"), (43, f"é {secret}")]
    rows += [rows[3], rows[3], (50, rows[4][1])]
    return spark.createDataFrame([(i, t, None if k % 3 else "en", None, len(t or ""), *[f"c{k}" for _ in clashes]) for k, (i, t) in enumerate(rows)],
                                 ", ".join(["doc_id long, text string, lang string, source string, n_chars int", *[f"`{c}` string" for c in clashes]])).repartition(3)


@pytest.mark.parametrize("stage", range(len(cp.STAGES)))
def test_a_stage_on_odd_tables(spark, stage):
    """Clashing columns change nothing and stay as they are; nulls, empty and long texts and repeated rows pass; empty tables give none."""
    own = ["doc_id", "text"] if stage < 4 else ["doc_id", "piece", "start", "length", "ids_crc32"]
    key = lambda r: tuple((v is None, v or 0 if not isinstance(v, str) else v) for v in r)
    plain, extra = odd_docs(spark, []), odd_docs(spark, CLASHES)
    want, got = cp.STAGES[stage][1](spark, plain, SF), cp.STAGES[stage][1](spark, extra, SF)
    assert want.count() > 0
    assert sorted(map(tuple, want.select(*own).collect()), key=key) == sorted(map(tuple, got.select(*own).collect()), key=key)
    if stage < 4:
        assert got.columns == extra.columns
        assert all(len({r[c] for c in CLASHES}) == 1 for r in got.collect())
    assert cp.STAGES[stage][1](spark, extra.limit(0), SF).count() == 0


def test_ties_at_the_cutoff_stay(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one text"), (2, "one text"), (3, "one text")], "doc_id long, text string")
    weights = np.zeros(op9_quality.SLOTS + 1, np.float32)
    monkeypatch.setattr(op9_quality, "fit", lambda *_: weights)
    monkeypatch.setattr(op9_quality, "CUTOFF", 0.5)
    assert cp.keep_quality(spark, docs, SF).count() == 3
