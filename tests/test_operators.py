import json
import random

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from guildbook.operators import match as m
from guildbook.operators.store import new_folder
from guildbook.sources import records as r
from guildbook.streaming import streams

c = F.col


def greedy(edges):
    """Clusters of a scan in order: the lowest unclaimed node takes its unclaimed neighbours."""
    near = {}
    for u, v in edges:
        near.setdefault(u, set()).add(v)
        near.setdefault(v, set()).add(u)
    leader = {}
    for n in sorted(near):
        if n not in leader:
            leader[n] = n
            for x in near[n]:
                leader.setdefault(x, n)
    return leader


def test_greedy_clusters_equal_the_scan(spark):
    rng = random.Random(1)
    edges = sorted({tuple(sorted(rng.sample(range(60), 2))) for _ in range(90)})
    for parts in (1, 4):
        got = m.leader_clusters(spark.createDataFrame(edges, "u int, v int").repartition(parts)).collect()
        assert {x["node"]: x["leader"] for x in got} == greedy(edges)
    chain = [(i, i + 1) for i in range(12)]
    assert {x["node"]: x["leader"] for x in m.leader_clusters(spark.createDataFrame(chain, "u int, v int")).collect()} == greedy(chain)


def test_pruned_pairs_equal_all_pairs(spark):
    rng = random.Random(2)
    names = ["acme tool", "acme tools", "acme tool works", "apex gear", "apex gears", "zeta"]
    rows = [(i, rng.choice(names), rng.choice(["", "a.com", "b.com", None]), rng.choice(["x", "y", ""]), rng.choice(["OH", "MI", ""])) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, name string, site string, city string, state string").withColumn("word", F.substring_index("name", " ", 1))
    got = {(x["u"], x["v"]): x["score"] for x in m.candidate_pairs(df, "id", ["site", "word"], {"site": 0.3, "city": 0.1, "state": 0.1}, ("name", 0.5)).collect()}

    def score(a, b):
        total = points = 0.0
        for k, w in ((1, 0.5), (2, 0.3), (3, 0.1), (4, 0.1)):
            if a[k] and b[k]:
                total += w
                if k == 1:
                    points += w * (1.0 if a[1] == b[1] else 2 * lcs(a[1], b[1]) / (len(a[1]) + len(b[1])))
                else:
                    points += w * (a[k] == b[k])
        return points / total if total else 0.0

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for k, y in enumerate(b, 1):
                before, row[k] = row[k], before + 1 if x == y else max(row[k], row[k - 1])
        return row[-1]

    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and (a[2] and a[2] == b[2] or a[1].split()[0] == b[1].split()[0]) and score(a, b) >= 0.85}
    assert set(got) == want and all(abs(v - score(rows[a], rows[b])) < 1e-9 for (a, b), v in got.items())


def test_records_and_rejects(spark):
    folder = new_folder(spark, "lines")
    spark.createDataFrame([('{"a": 1, "b": "x"}',), ("",), ("{broken",), ('{"a": 2}',)], "value string").coalesce(1).write.text(folder)
    schema = StructType([StructField("a", IntegerType()), StructField("b", StringType())])
    good, bad = r.read_records(spark, folder, schema)
    assert sorted((x["a"], x["b"]) for x in good.collect()) == [(1, "x"), (2, None)] and [x["value"] for x in bad.collect()] == ["{broken"]
    ok, wrong = r.split_rejects(good, {"b missing": c("b").isNull()})
    assert ok.count() == 1 and wrong.first()["errors"] == ["b missing"]
    out = new_folder(spark, "rejects")
    r.write_rejects(wrong, out, F.lit("2024-01-01"))
    assert spark.read.json(out).first()["a"] == 2
    r.write_records(ok, out + "-ok")
    assert json.loads(spark.read.text(out + "-ok").first()["value"]) == {"a": 1, "b": "x"}


def test_csv_ranks_and_exports(spark):
    folder = new_folder(spark, "csv")
    spark.createDataFrame([("company_name,quality_score,employee_count,contacts,tech_stack,associations",), ("Acme,80,x,Jo Doe <j@a.com>; Al,A; B,PMA",)], "value string").coalesce(1).write.text(folder)
    row = r.read_company_csv(spark, folder).first()
    assert row["quality_score"] == 80 and row["employee_count"] == 0 and [tuple(x) for x in row["contacts"]] == [("Jo Doe", "j@a.com"), ("Al", None)] and row["tech_stack"] == ["A", "B"]
    df = r.export_rows(r.read_company_csv(spark, folder), ["tech_stack", "associations"])
    assert df.first()["contact_name"] == "Jo Doe" and df.first()["tech_stack"] == "A; B"
    assert r.explode_contacts(r.read_company_csv(spark, folder), ["company_name"]).count() == 2
    ranked = spark.createDataFrame([("PMA", 2, "x"), ("PMA", 1, "y"), ("NEMA", 1, "z"), ("NEMA", 0, "w")], "a string, rank int, v string")
    assert sorted(x["v"] for x in r.load_by_source_rank(ranked, "a", "rank").collect()) == ["w", "y"]


def test_streams(spark):
    folder, out = new_folder(spark, "stream-in"), new_folder(spark, "stream-out")
    schema = "url string, content_hash string, n int"
    for k, h in enumerate(["a", "a", "b"]):
        spark.createDataFrame([("u", h, k), ("v", "same", k)], schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        streams.run_now(streams.baseline_stream(stream), out + "-state", lambda b, n: b.write.mode("append").parquet(out))
        streams.upsert_stream(stream, out + "-table", out + "-check", "url", "n", ["content_hash"]).awaitTermination()
    last = {x["url"]: x["change_count"] for x in spark.read.parquet(out).groupBy("url").agg(F.max("change_count").alias("change_count")).collect()}
    assert last == {"u": 1, "v": 0}
    assert {x["url"]: x["content_hash"] for x in spark.read.parquet(out + "-table/version=2").collect()} == {"u": "b", "v": "same"}


def test_uncapped_tiers_are_listed_whole(spark):
    from guildbook.operators.report import tier_lists

    rows = [(i, f"Tier {i % 3 + 1}", i * 7 % 40, i * 3 % 11) for i in range(600)]
    df = spark.createDataFrame(rows, "company_id int, tier string, icp_score int, quality_score int").repartition(5)
    got = sorted((x["tier"], x["rank"], x["company_id"]) for x in tier_lists(df, {"Tier 1": 5, "Tier 2": 20}, ("Tier 3",)).collect())
    want = []
    for tier, most in (("Tier 1", 5), ("Tier 2", 20), ("Tier 3", 200)):
        own = sorted((-s, -q, i) for i, t, s, q in rows if t == tier)[:most]
        want += [(tier, k + 1, i) for k, (_, _, i) in enumerate(own)]
    assert got == want
