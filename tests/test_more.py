"""Operators without SQL of their own, against plain Python."""

import re

from pyspark.sql import functions as F

from guildbook.functions import page_tables
from guildbook.operators import discovery as d
from guildbook.operators import joins as j
from guildbook.operators import match as m
from guildbook.operators import pages as p
from guildbook.operators import select as sel
from guildbook.plans import q_more, registry

SF = "/root/testdata/sf0.001"
c = F.col


def likeness(a, b):
    """Twice the longest common subsequence by the sum of lengths."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for k, y in enumerate(b, 1):
            before, row[k] = row[k], before + 1 if x == y else max(row[k], row[k - 1])
    return 2 * row[-1] / (len(a) + len(b)) if a or b else 1.0


def test_entity_pairs_against_all_pairs(spark):
    rows = [r.asDict() for r in q_more._entities(spark, SF).collect()]
    want, w = {}, m.ENTITY_WEIGHTS
    for a in rows:
        for b in rows:
            if a["company_id"] < b["company_id"] and any(a[x] and a[x] == b[x] for x in ("domain", "phone")):
                both = {f for f in w if a[f] and b[f]}
                points = sum(w[f] for f in ("domain", "phone") if f in both and a[f] == b[f]) + sum(w[f] * likeness(a[f], b[f]) for f in ("name", "address") if f in both)
                score = points / sum(w[f] for f in both)
                if score >= 0.85 - 1e-9:
                    want[a["company_id"], b["company_id"]] = round(score, 6)
    got = {(r["u"], r["v"]): r["score"] for r in q_more.entity_pairs(spark, SF).collect()}
    assert got == want and got


def test_duplicate_stats(spark):
    rows = spark.range(10).select(c("id"))
    clusters = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (5, 5), (6, 5)], "node long, leader long")
    assert m.dedupe_stats(rows, clusters).first().asDict() == {"records": 10, "kept": 7, "groups": 2, "merged": 3, "largest": 3}
    assert registry.queries()["duplicate_stats"](spark, SF).first()["records"] == 150


def test_long_chains_end(spark):
    edges = [(k, k + 1) for k in range(70)]
    got = {r["node"]: r["leader"] for r in m.leader_clusters(spark.createDataFrame(edges, "u int, v int")).collect()}
    assert got == {k: k - k % 2 for k in range(71)}


def signals(text, aliases, window=150, most=100):
    out = []
    for name, group in aliases.items():
        for x in re.finditer(rf"\b({'|'.join(sorted(group, key=len, reverse=True))})\b", text.lower()):
            a, b = max(0, x.start() - window), min(len(text), x.end() + window)
            context = ("..." if a else "") + re.sub(r"\s+", " ", text[a:b].strip()) + ("..." if b < len(text) else "")
            points = {k: sum(2 if re.search(q, context.lower()) else 1 if re.search(q, text.lower()[:2000]) else 0 for q in near) for k, near in page_tables.SIGNAL_KINDS.items()}
            best = max(points, key=points.get)
            sure = min(95, 80 + 5 * sum(word in context.lower() for word in page_tables.SURE_WORDS))
            out.append((name, x.start(), context, best if points[best] else "MEMBER_USAGE", sure / 100))
    return out[:most]


def test_mined_signals_against_plain_search(spark):
    aliases = {"epicor": ["epicor", "epicor kinetic"], "sap": ["sap"], "plex": ["plex systems", "plex"]}
    texts = [
        "We run Epicor Kinetic since 2010. Our ERP system is  Epicor. " + "x " * 200 + "epicor booth at the show, SAP certified partner",
        "plex", "none here", "Plex Systems case study; " * 60 + "SAP news", "é😀 using sap software implementation " + "y" * 300,
    ]
    got = p.mine_signals(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "id", "text", aliases).collect()
    for i, text in enumerate(texts):
        rows = sorted((r["competitor"], r["at"], r["context"], r["kind"], r["confidence"]) for r in got if r["id"] == i)
        assert rows == sorted(signals(text, aliases)), text
    assert len(p.mine_signals(spark.createDataFrame([(1, "sap " * 300)], "id int, text string"), "id", "text", aliases).collect()) == 100


def test_directory_texts(spark):
    text = "Members 2024\nx\n\nAcme Corp\n(555)123-4567 info@acme.com\nSales@Acme.com\nwww.acme.com\nSouth Bend, IN 46601\n\n12\nx\n\nSolo\n\nBeta LLC\n555.222.3333\nhttps://beta.io/x\nAkron OH"
    got = [tuple(r)[2:] for r in p.text_blocks(spark.createDataFrame([(1, text)], "id int, text string"), "id", "text").orderBy("block").collect()]
    # A line that is a phone gives nothing else.
    assert got == [("Acme Corp", "5551234567", "sales@acme.com", "www.acme.com", "South Bend", "IN"), ("Beta LLC", "5552223333", None, "https://beta.io", "Akron", "OH")]


def test_mail_hosts_by_preference_and_whole_tables(spark):
    df = spark.createDataFrame([(["mx.other.net", "a.mimecast.com", "b.google.com"], "acme.com"), (["mail.acme.com.host"], "acme.com"), (["x.y"], "acme.com"), ([], "acme.com")], "h array<string>, d string")
    assert [r[0] for r in df.select(p.mail_provider(c("h"), c("d"))).collect()] == ["Mimecast", "Self-hosted", "Other", None]
    one = spark.range(1)
    assert one.select(p.dmarc(F.lit("v=DMARC1; p=none"))["policy"]).first()[0] == "Monitoring (none)"
    assert one.select(p.spf_services(F.lit("v=spf1 include:cust-spf.exacttarget.com include:knowbe4.com"))).first()[0] == ["Salesforce Marketing Cloud", "KnowBe4"]
    found = one.select(p.fingerprint_tech(F.lit("<script src='https://js.hs-analytics.net/x'></script>__NEXT"), F.lit("PHP/8"), F.lit("nginx/1"))).first()[0]
    assert found == ["HubSpot", "Next.js", "PHP", "Nginx"] and one.select(p.site_system(F.lit("Wix.com Website Builder"))).first()[0] == "Wix"
    assert one.select(p.capabilities(F.lit("wire EDM, CMM, anodized, black oxide, heat treatment"))).first()[0] == ["heat treating", "black oxide", "wire EDM", "EDM", "CMM inspection"]
    assert (len(page_tables.SPF_SERVICES), len(page_tables.CAPABILITIES), len(page_tables.ERP_WORDS)) == (37, 60, 15)


def test_facts_go_on_to_the_next_pattern(spark):
    texts = ["0 employees, a team of 40. Established 1700; 1999 - present. $20 widgets; revenue of $3.5 million", "900,000 employees", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [tuple(r[0]) for r in df.select(p.about_facts(c("t"))).collect()] == [(40, 1999, 3_500_000), (None, None, None), (None, None, None)]


def test_methods_that_find_nothing_put_out_what_was_there(spark):
    df = spark.createDataFrame([(1, "a", "n", None, "old"), (2, "a", "n", None, "old"), (3, None, None, None, "old"), (4, "a", "n", "SAP", "old")], "k int, domain string, name string, erp_system string, tech_source string")
    site = spark.createDataFrame([(1, None, "website"), (4, "Plex", "website")], "k int, erp_system string, tech_source string")
    jobs = spark.createDataFrame([(2, None, "jobs")], "k int, erp_system string, tech_source string")
    got = {r["k"]: (r["erp_system"], r["tech_source"]) for r in j.tech_waterfall(df, "k", [("site", site, "domain"), ("jobs", jobs, "name")]).collect()}
    assert got == {1: (None, "old"), 2: (None, "jobs"), 3: (None, "old"), 4: ("SAP", "old")}


def test_filters_and_rejects(spark):
    rows = [(1, "A", 70, "PMA", 1, "x@y", "SAP", "OH", "auto"), (2, "B", 50, "PMA", 0, "", "", "TX", "auto"), (3, "", None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "company_id int, company_name string, quality_score int, associations string, n_contacts int, email string, erp_system string, state string, industry string")
    ids = lambda x: sorted(r["company_id"] for r in x.collect())
    assert ids(sel.filter_export(df)) == [1, 2, 3] and ids(sel.filter_export(df, states=["OH", "TX"])) == [1] and ids(sel.filter_export(df, min_quality=40, associations=["PMA"])) == [1, 2]
    assert ids(sel.filter_export(df, has_email=True, has_erp=True, has_contacts=True, industries=["auto"])) == [1]
    assert ids(sel.by_name(df, "b")) == [2] and ids(sel.lookup(df, "state", "OH")) == [1]
    good, bad = sel.split_rejects(df, "company_id", {"no name": c("company_name") == "", "low": c("quality_score") < 60})
    assert ids(good) == [1] and {r["company_id"]: r["violations"] for r in bad.collect()} == {2: ["low"], 3: ["no name"]}


def test_links_of_all_kinds(spark):
    base = "https://a.org/dir/list.html?q=1#x"
    hrefs = {"/m/1": "https://a.org/m/1", "p.html": "https://a.org/dir/p.html", "?page=2": "https://a.org/dir/list.html?page=2", "//b.org/x": "https://b.org/x", "http://c.org": "http://c.org"}
    df = spark.createDataFrame([(h, base) for h in hrefs] + [("x", "https://a.org")], "h string, b string")
    assert [r[0] for r in df.select(d.resolve(c("h"), c("b"))).collect()] == [*hrefs.values(), "https://a.org/x"]
