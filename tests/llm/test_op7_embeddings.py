import duckdb
import numpy as np

from guildbook.llm import op7_embeddings as op


def brute(rows):
    """n_links and component by all pairs, for rows (vec_id, vector)."""
    good = [k for k, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.any(v)]
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for p, k in enumerate(good):
        for j in good[:p]:
            a, b = np.array(rows[k][1], float), np.array(rows[j][1], float)
            if len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.95:
                n[k] += 1
                n[j] += 1
                root[find(k)] = find(j)
    least = {}
    for k in range(len(rows)):
        least[find(k)] = min(least.get(find(k), rows[k][0]), rows[k][0])
    return sorted((rows[k][0], n[k], least[find(k)]) for k in range(len(rows)))


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK", 16)
    rng = np.random.default_rng(1)
    base = rng.standard_normal((12, 16))
    rows = [(i, (base[i % 12] + rng.standard_normal(16) * (0.05 + 0.02 * (i % 9))).astype(np.float32).tolist()) for i in range(240)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(3, rows[3][1])]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [None] + [1.0] * 15), (2005, [float("inf")] + [1.0] * 15)]
    df = spark.createDataFrame([(i, v, "z", 1) for i, v in rows], "vec_id long, embedding array<float>, key string, id int")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in op.near_duplicates(df).collect())
    assert got == brute(rows)


def test_vectors_link_among_those_of_one_length(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((6, 16))
    rows = [(i, (base[i % 6] + rng.standard_normal(16) * 0.05).tolist()) for i in range(60)]
    rows += [(100, [1.0] * 17), (101, [1.0] * 9), (102, [2.0] * 9), (103, [1.0] * 16 + [None])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for parts in (1, 3):
        got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in op.near_duplicates(df.repartition(parts)).collect())
        assert got == brute(rows)


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = sorted(map(tuple, op.op7_embeddings(spark, sf).collect()))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    assert got == sorted(con.execute(op.SQL).fetchall())


def test_empty(spark):
    assert op.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_the_bound_itself(spark):
    """A pair at exactly 0.95 links, one just below doesn't: 19/20 and 0.9499."""
    rows = [(1, [1.0, 0.0]), (2, [19.0, float(np.sqrt(39.0))]), (3, [0.0, -1.0]), (4, [float(np.sqrt(1 - 0.9499**2)), -0.9499])]
    cosine = lambda a, b: np.dot(a, b) / np.sqrt(np.dot(a, a)) / np.sqrt(np.dot(b, b))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in op.near_duplicates(df, cosine=min(0.95, cosine(rows[0][1], rows[1][1]))).collect()}
    assert got == {1: 1, 2: 1, 3: 0, 4: 0}


def test_sides_do_not_depend_on_the_company():
    rng = np.random.default_rng(5)
    m = op.at_length_one(rng.standard_normal((300, 64)))
    whole = op.sides(m, 9, 7)
    for k in (1, 2, 17):
        assert np.array_equal(np.concatenate([op.sides(m[a : a + k], 9, 7) for a in range(0, 300, k)]), whole)
    assert np.array_equal(op.sides(m, 9, 3), whole[:, :3])
