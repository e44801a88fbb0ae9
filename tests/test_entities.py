"""Entities over runs, and upserts by two keys, on odd rows."""

from pyspark.sql import functions as F

from guildbook.operators import entities as en
from guildbook.operators import joins as j
from guildbook.operators import match as m

SCHEMA = "row long, company_name string, domain string, city string, employee_count_min int, quality_score int, association string, provenance string, name string, phone string, address string"


def find(rows):
    keys = rows.select("ord", "domain", F.lower("company_name").alias("name"), F.lit("").alias("phone"), F.lit("").alias("address"))
    return m.score_entity_pairs(keys, "ord", ["domain", "name"])


def run(spark, rows, existing=None, strategy="merge_all"):
    df = spark.createDataFrame([(*r, "n", "p", "a") for r in rows], SCHEMA).drop("name", "phone", "address")
    return {k: v.collect() if k != "entities" else v for k, v in en.resolve(df, existing, find, "row", ["domain", "city", "employee_count_min"], strategy).items()}


def test_ids_stay_and_groups_merge(spark):
    first = run(spark, [(1, "Acme", "a.com", None, 5, 50, "B", "p1"), (2, "acme", "a.com", "Akron", 9, 0, "A", None), (3, "Zeta", "z.com", None, None, None, None, "p3")])
    old = {r["company_name"]: r for r in first["entities"].collect()}
    # Without a score the completeness counts: all four fields are 100, more than 50.
    acme = old["acme"]
    assert (acme["city"], acme["employee_count_min"], acme["quality_score"], acme["associations"], acme["provenance"], acme["records"]) == ("Akron", 9, 50, ["A", "B"], ["p1"], 2)
    assert [tuple(r) for r in first["aliases"]] == [(acme["entity_id"], "Acme")]
    second = run(spark, [(10, "ACME", "a.com", "Gary", 1, 99, "C", "p10"), (11, "New", None, "", 0, 1, "", ""), (12, None, None, None, None, None, None, None)], first["entities"])
    now = {r["company_name"]: r for r in second["entities"].collect()}
    assert now["ACME"]["entity_id"] == acme["entity_id"] and now["Zeta"]["entity_id"] == old["Zeta"]["entity_id"]
    assert now["ACME"]["city"] == "Gary" and now["ACME"]["employee_count_min"] == 9 and now["ACME"]["associations"] == ["A", "B", "C"] and now["ACME"]["provenance"][0] == "p10" and now["ACME"]["records"] == 3
    assert {r["row"] for r in second["members"]} == {10, 11, 12} and len(now) == 4 and second["merges"] == []


def test_a_row_that_meets_two_entities(spark):
    first = run(spark, [(1, "Acme", "a.com", None, 1, 5, None, None), (2, "Acme", "b.com", None, 1, 5, None, None)])
    ids = {r["domain"]: r["entity_id"] for r in first["entities"].collect()}
    assert len(ids) == 2
    second = run(spark, [(7, "Acme", None, None, 1, 9, None, None)], first["entities"], "keep_best")
    assert [tuple(r) for r in second["merges"]] == [(ids["a.com"], ids["b.com"], 7)] and second["entities"].count() == 2
    assert run(spark, [], first["entities"])["entities"].count() == 2


def test_two_keys_of_an_upsert(spark):
    old = spark.createDataFrame([(1, "a.com", "x"), (2, "b.com", "y"), (3, "a.com", "z"), (4, None, "w"), (2**60 + 1, "big.com", "v")], "id long, domain string, v string")
    batch = [(2, "a.com", "dom", 1), (4, " ", "id", 1), (4, None, None, 2), (9, "new.com", "n1", 1), (8, "new.com", None, 0), (9, None, "alone", 5), (None, None, "q", 1), (None, None, "q", 1), (None, "big.com", "V", None)]
    got = sorted(map(tuple, j.upsert_companies(old, spark.createDataFrame(batch, "id long, domain string, v string, turn int"), ["v"]).collect()), key=str)
    want = [(1, "a.com", "dom", "updated"), (2, "b.com", "y", "kept"), (3, "a.com", "z", "kept"), (4, None, "id", "updated"), (2**60 + 1, "big.com", "V", "updated"), (8, "new.com", "n1", "added"), (9, None, "alone", "added"), (None, None, "q", "added"), (None, None, "q", "added")]
    assert got == sorted(want, key=str)
    assert j.upsert_companies(old.limit(0), spark.createDataFrame(batch, "id long, domain string, v string, turn int").limit(0), ["v"]).count() == 0
