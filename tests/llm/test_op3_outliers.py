import re

import numpy as np

from guildbook.llm import op3_outliers as op


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    repeated = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    out = [len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated)]
    return [*out, len(words) < 10 or 100 * len(repeated) > 20 * len(words)]


def test_counts():
    texts = ["", "a b c d e a b c d e", "x", "a\n\na\n \na\n", "é é é é é é é é", "# * $", "one two " * 3000, "w" * 50000, "\x0b\x0c a"]
    got = op.count_texts([t.encode() for t in texts])
    assert [[int(got[c][i]) for c in op.COUNTS] for i in range(len(texts))] == [brute(t)[:5] for t in texts]


def test_query_on_whole_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op.op3_outliers(spark, sf).collect()
    assert {r["doc_id"]: [r[c] for c in op.COUNTS] + [r["base_failed"]] for r in got} == {i: brute(t) for i, t in docs.items()}
    assert len(got) == len(docs) and not any(r["kept"] and r["base_failed"] for r in got)


def test_outliers_of_their_group_go(spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(chr(97 + k) for k in rng.integers(0, 26, rng.integers(3, 9)))
    rows = [(i, " ".join(word() for _ in range(int(rng.integers(60, 240)))), None if i % 2 else "en", "s", "x") for i in range(300)]
    rows += [(1000 + i, " ".join(word() + "$#*%|" for _ in range(120)), "en", "s", "x") for i in range(8)]
    rows += [(2000, None, "en", "rare", "x"), (2001, "", None, None, "x")]
    got = {r["doc_id"]: r["kept"] for r in op.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, grp string")).collect()}
    assert not any(got[1000 + i] for i in range(8)) and not got[2000] and not got[2001]
    assert np.mean([got[i] for i in range(300)]) > 0.98


def plain_estimate(x):
    """Minimum covariance determinant of the rows of x, by sorted distances."""
    floor = np.square(op.FLOOR)

    def fit(part, wider):
        scatter = wider * np.cov(part.T, bias=True)
        scatter[np.diag_indices(op.P)] = np.maximum(np.diag(scatter), floor)
        return part.mean(axis=0), scatter

    quarters = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    best = None
    for centre, scatter in ((quarters[1], np.diag(np.maximum(np.square((quarters[2] - quarters[0]) / 1.349), floor))), fit(x, 1)):
        for _ in range(20):
            far = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(scatter), x - centre)
            centre, scatter = fit(x[np.argsort(far)[: int(np.ceil(0.75 * len(x)))]], op.CONSISTENCY)
        if best is None or np.linalg.slogdet(scatter)[1] < best[0]:
            best = np.linalg.slogdet(scatter)[1], centre, scatter
    return best[1:]


def made(spark, n, odd):
    """n texts of plain words, and texts with a share of symbols or of repeated lines."""
    rng = np.random.default_rng(6)
    word = lambda: "".join(chr(97 + k) for k in rng.integers(0, 26, rng.integers(3, 9)))
    text = lambda: "\n".join(" ".join(word() for _ in range(12)) for _ in range(int(rng.integers(6, 24))))
    rows = [(i, text(), "en", "s") for i in range(n)]
    for k, share in enumerate(odd):
        t = text()
        junk = "".join(rng.choice(list("#*$%&|<>"), int(share * len(t))))
        rows.append((10_000 + k, t + " " + junk, "en", "s"))
        lines = [" ".join(word() for _ in range(3)) for _ in range(40)]
        rows.append((20_000 + k, "\n".join([*lines[: int(40 * (1 - share))], *([lines[0]] * int(40 * share))]), "en", "s"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_symbols_and_repeated_lines_from_fifteen_percent_on_go(spark):
    got = {r["doc_id"]: r["kept"] for r in op.judge(made(spark, 400, [0.15, 0.2, 0.25, 0.3])).collect()}
    assert not any(kept for i, kept in got.items() if 10_000 <= i < 20_000)
    assert not any(kept for i, kept in got.items() if i >= 20_000)
    assert np.mean([kept for i, kept in got.items() if i < 10_000]) > 0.99


def test_against_a_plain_estimate(spark):
    rows = op.count_documents(made(spark, 600, [0.02, 0.05, 0.1, 0.15, 0.2])).withColumn("base_failed", op.base_failed()).withColumn("v", op.vector()).collect()
    fine = np.array([r["v"] for r in rows if not r["base_failed"]])
    centre, scatter = plain_estimate(fine)
    want = {r["doc_id"]: float((np.array(r["v"]) - centre) @ np.linalg.inv(scatter) @ (np.array(r["v"]) - centre)) for r in rows}
    got = {r["doc_id"]: r for r in op.judge(made(spark, 600, [0.02, 0.05, 0.1, 0.15, 0.2])).collect()}
    # Buckets of the distance take a few rows more than the nearest share.
    assert np.median([abs(got[i]["distance2"] / d - 1) for i, d in want.items() if d > 1]) < 0.1
    clear = [i for i, d in want.items() if not 0.8 * op.CUTOFF < d < 1.25 * op.CUTOFF]
    assert len(clear) > 0.98 * len(want)
    assert all(got[i]["kept"] == (want[i] <= op.CUTOFF and not got[i]["base_failed"]) for i in clear)


def test_groups_count_usable_rows_only(spark):
    """A group of many rows that fail the base rule and few others is pooled, so its few rows make no model of their own."""
    rng = np.random.default_rng(2)
    text = lambda: " ".join(f"word{k}" for k in rng.integers(0, 5000, 80))
    rows = [(i, text(), "en", "big") for i in range(100)] + [(1000 + i, "few words", "en", "small") for i in range(70)] + [(2000 + i, text(), "en", "small") for i in range(2)]
    got = {r["doc_id"]: r for r in op.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[2000 + i]["kept"] for i in range(2)) and not any(got[1000 + i]["kept"] for i in range(70))


def test_quantiles():
    assert abs(op.chi_square_quantile(0.95, 5) - 11.0705) < 1e-3 and abs(op.chi_square_quantile(0.999, 5) - 20.515) < 1e-2
    assert abs(op.chi_square(14.067, 7) - 0.95) < 1e-4


def test_small_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string"
    rows = [(i, "these are some ten words of text that are fine " * 1, "en", "s") for i in range(3)]
    assert [r["kept"] for r in op.judge(spark.createDataFrame(rows, schema)).collect()] == [True] * 3
    assert op.judge(spark.createDataFrame([], schema)).count() == 0
