"""Facts of organisations on odd pages; chains of leaders."""

import json
import random

import pytest
from pyspark.sql import functions as F

from guildbook.functions import events as ev
from guildbook.functions import tables
from guildbook.operators import contracts as ct
from guildbook.operators import exports as ex
from guildbook.operators import graph as g
from guildbook.operators import joins as j
from guildbook.operators import match as m
from guildbook.operators import organisations as og
from tests.test_operators import greedy


def test_odd_blocks(spark):
    rows = [
        (1, ['[{"@type": "Organization", "foundingDate": "since 2031"}]', "[]", "7", "null"]),
        (2, ['{"@graph": {"@type": "Organization", "telephone": "1"}}', '{"@type": "Organization", "sameAs": [1, "http://LINKEDIN.com/company/x"]}']),
        ((1 << 60) + 1, ['{"@type": "Organization", "numberOfEmployees": -0.0, "telephone": "t", "address": ["a"], "geo": {"lat": 0, "long": 1}}']),
        (None, ['{"@type": "Organization", "telephone": "n"}']),
        (4, []), (5, None), (6, [None, "", "{"]),
    ]
    df = spark.createDataFrame(rows, "id long, blocks array<string>")
    got = {r["id"]: {k: v for k, v in r.asDict().items() if v is not None and k not in ("id", "schema_type")} for r in og.organisation_facts(df, "id", "blocks").collect()}
    assert got == {1: {"founded": 2031}, 2: {"linkedin_url": "http://LINKEDIN.com/company/x"}, (1 << 60) + 1: {"employees": 0, "phone": "t"}, None: {"phone": "n"}}
    assert [tuple(r) for r in og.organisation_firmographics(df, "id", "blocks").collect()] == [((1 << 60) + 1, 0, 0, None, None, None, "schema_org")]
    assert og.organisation_facts(df.filter("id = 9"), "id", "blocks").count() == 0


@pytest.mark.parametrize(("seed", "nodes", "edges"), [(1, 40, 30), (2, 60, 110), (3, 200, 260)])
def test_leaders_of_random_graphs(spark, seed, nodes, edges):
    rng = random.Random(seed)
    pairs = sorted({tuple(sorted(rng.sample(range(nodes), 2))) for _ in range(edges)} | {(nodes + i, nodes + i + 1) for i in range(9)})
    got = {r["node"]: r["leader"] for r in m.leader_clusters(spark.createDataFrame(pairs, "u int, v int")).collect()}
    assert got == greedy(pairs)


def test_rounds_of_a_chain_grow_with_the_logarithm(spark, monkeypatch):
    made = []
    whole = m.written
    monkeypatch.setattr(m, "written", lambda df, label: (made.append(label), whole(df, label))[1])
    # A chain whose every third node also meets the node two before it: terms with two nodes, and chains between them.
    for n in (32, 256):
        made.append(n)
        edges = [(k, k + 1) for k in range(n)] + [(k, k + 2) for k in range(0, n - 2, 3)]
        got = {r["node"]: r["leader"] for r in m.leader_clusters(spark.createDataFrame(edges, "u int, v int")).collect()}
        assert got == greedy(edges)
    short, long = made[1 : made.index(256)], made[made.index(256) + 1 :]
    assert len(long) < len(short) + 30, (len(short), len(long))


def test_member_tables(spark):
    rows = [
        ([["Member Name", "ST", "Year Joined", "x"], [" Acme ", "OH", "1999", "?"], ["", "MI", "2000", ""], ["Short"], ["Zeta", None, "", ""]], [{"company_name": "Acme", "state": "OH", "member_since": "1999"}, {"company_name": "Zeta"}]),
        ([["Name", "Type"], ["Acme", "Gold"]], []),
        ([["City", "State"], ["Gary", "IN"]], []),
        ([["Company", "Name", "Web"], ["First", "Second", "a.com"], ["Only", "", "b.com"]], [{"company_name": "Second", "website": "a.com"}, {"company_name": "Only", "website": "b.com"}]),
        ([["Name", "City"]], []), ([], []), (None, []),
    ]
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(rows)], "i int, x array<array<string>>").orderBy("i")
    assert [r[0] for r in df.select(ev.member_rows(F.col("x"))).collect()] == [want for _, want in rows]


def test_contracts_of_odd_records(spark):
    texts = {None: ["record: no JSON"], "": ["record: no JSON"], "null": ["record: no object"], '{"company_name": "F"}': [], "{}": ["company_name: missing"],
             '{"company_name": 5, "year_founded": 1799, "tech_stack": {"a": 1}, "created_at": null, "latitude": null}': ["company_name: no string", "year_founded: below 1800", "tech_stack: no array", "created_at: no string"],
             '{"company_name": "é", "contacts": [], "quality_score": 1e2, "quality_grade": null}': []}
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, record string")
    got = {r["i"]: r["v"] for r in df.select("i", ct.violations(F.col("record"), tables.COMPANY_FIELDS).alias("v")).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())
    good, bad = ct.split_by_contract(df, "record", tables.COMPANY_FIELDS)
    assert {r["i"] for r in good.collect()} == {3, 6} and bad.count() == 5


def test_exports_of_odd_records(spark):
    df = spark.createDataFrame([(1, None, None, {"k": "v"}), (2, [], ["a", "b"], None)], "id int, contacts array<struct<email string>>, tech_stack array<string>, more map<string,string>")
    rows = [r.asDict() for r in ex.export_table(df, "all").orderBy("id").collect()]
    assert rows[0] | {"more": json.loads(rows[0]["more"])} == {"id": 1, "contact_count": None, "primary_contact_name": None, "primary_contact_email": None, "primary_contact_title": None, "tech_stack": None, "more": {"k": "v"}}
    assert rows[1]["contact_count"] is None and rows[1]["tech_stack"] == "a; b"
    for kind, names in tables.EXPORT_COLUMNS.items():
        assert ex.export_table(df, kind).columns == names
    assert ex.export_fields(df, tables.HUBSPOT_FIELDS, "s", F.current_date()).columns == ["Data_Source__c", "Import_Date__c"]


def test_graph_formats(spark):
    nodes = spark.createDataFrame([("a", "COMPANY", "A"), ("e", "EVENT", None)], "id string, kind string, name string")
    edges = spark.createDataFrame([("a", "e", "SPONSOR")], "source string, target string, kind string")
    read = lambda how: {(r["part"], r["element"]) for r in g.export_graph(nodes, edges, how).collect()}
    assert read("json") == {("node", '{"id":"a","kind":"COMPANY","name":"A"}'), ("node", '{"id":"e","kind":"EVENT"}'), ("edge", '{"source":"a","target":"e","kind":"SPONSOR"}')}
    assert ("edge", '{"data":{"id":"a|SPONSOR|e","source":"a","target":"e","label":"SPONSOR"}}') in read("cytoscape")
    assert ("edge", '{"id":"a|SPONSOR|e","source":"a","target":"e","type":"SPONSOR","weight":1.0}') in read("gephi") and ("node", '{"id":"a","label":"A","type":"COMPANY"}') in read("gephi")
    with pytest.raises(ValueError):
        read("dot")


def test_cross_reference_of_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None, "x", None), (2, "Acme", "", "", ""), (3, "Acme", "http://a.com", "Gary", None), (4, "Acme", "a.com", None, "IN")], "company_id int, company_name string, website string, city string, state string")
    dns, none = spark.createDataFrame([("a.com", False)], "domain string, mx boolean"), spark.createDataFrame([], "domain string, found boolean")
    places = spark.createDataFrame([("Acme", "Gary", None, [None, "Zeta", "The Acme Co"]), ("Acme", None, None, ["Acme"]), ("Acme", None, "IN", [])], "company_name string, city string, state string, results array<string>")
    got = {r["company_id"]: (r["dns_mx_valid"], r["places_matched"], r["validation_score"], r["issues"]) for r in j.cross_reference(df, dns, places, none).collect()}
    assert got == {1: (None, None, 50, []), 2: (None, None, 50, []), 3: (False, True, 50, ["invalid_domain"]), 4: (False, False, 20, ["invalid_domain", "address_not_found"])}
