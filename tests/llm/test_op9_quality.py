import zlib

import numpy as np

from guildbook.llm import op9_quality as op

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in op.op9_quality(spark, SF).collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    rows = [r for r in rows if r["doc_id"] in labels]
    y, p = np.array([labels[r["doc_id"]] for r in rows]), np.array([r["score"] for r in rows])
    order = np.argsort(np.argsort(p))
    good, bad = (y == 1).sum(), (y == 0).sum()
    area = (order[y == 1].sum() - good * (good - 1) / 2) / (good * bad)
    assert area > 0.98 and (p[y == 1] >= 0.3).mean() > 0.98 and (p[y == 0] < 0.3).mean() > 0.85


def test_labels_and_names_are_no_inputs(spark):
    """The same text gets the same score under any id, language and source."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    weights = op.fit(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    rows = spark.createDataFrame([(1, "some text here", "en", "a"), (2, "some text here", "de", None)], "doc_id long, text string, lang string, source string")
    assert len({r["score"] for r in op.score_documents(rows, weights).collect()}) == 1


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, "a b", 0), (2, None, 0), (3, "", 0), (3, "", 0), (None, "x" * 50000, 0), (4, "\x0b \n", 0)], "doc_id long, text string, quality int")
    for labels in ([], [(1, 1), (1, 0), (2, None), (None, 1)], [(i, i % 2) for i in range(9)]):
        weights = op.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        got = op.score_documents(docs, weights).collect()
        assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert op.score_documents(docs.limit(0), weights).count() == 0


def test_features_are_counted_per_text():
    one = [op.features([t.encode()])[0].tolist() for t in ("a b a", "", "$$ x")]
    slot, at = op.features([b"a b a", b"", b"$$ x"])
    assert [slot[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == one
    assert len(one[0]) == 3 + 3 + 2 + 1
