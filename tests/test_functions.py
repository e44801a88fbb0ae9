from pyspark.sql import functions as F

from guildbook.functions import scores as s
from guildbook.functions import text as t
from guildbook.functions.similar import _lcs, indel_ratio
from guildbook.operators import pages as p

c = F.col


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_names(spark):
    got = values(spark, [("Acme Co., Inc.",), ("Müller GmbH",), ("Acme Mfg. LLC",), (None,), ("  A  B Corp.",)], "n string", t.normalize_name(c("n")), t.merge_key(c("n")), t.strip_one_suffix(c("n")))
    assert got[0] == ("acme co", "acmecoinc", "acme co.") and got[1][0] == "müller" and got[3] == ("", "", "") and got[4][0] == "a b"
    assert values(spark, [("Acme Intl Mfg Inc",)], "n string", t.deep_normalize_name(c("n"))) == [("acme international manufacturing",)]


def test_urls(spark):
    got = values(spark, [("HTTP://x",), ("https://www.Acme.com:8080/a/b/?q=1#f",), ("acme.co.uk",), ("",)], "u string", t.extract_domain(c("u")), t.normalize_url(c("u")), t.bare_domain(c("u")))
    assert got[1] == ("acme.com:8080", "https://acme.com:8080/a/b", "acme.com:8080")
    assert got[2] == ("acme.co.uk", "https://acme.co.uk", "acme.co.uk") and got[3][:2] == ("", "")


def test_parsers(spark):
    got = values(spark, [("$12.5M", "1,050-99", "Akron, oh", "VP of IT")], "m string, e string, p string, t string", t.parse_money(c("m")), t.parse_employee_range(c("e")), t.parse_field(c("p"), "city"), t.parse_field(c("p"), "state"), t.title_priority(c("t")))
    assert got[0][0] == 12500000 and got[0][1]["least"] == 1050 and got[0][2:] == ("Akron", "OH", 1)
    assert values(spark, [("Jane Q. O'Brien", "a.com"), ("Madonna", "a.com")], "n string, d string", t.email_candidates(c("n"), c("d")))[0][0] == ["jane.obrien@a.com", "jobrien@a.com", "jane@a.com", "janeobrien@a.com", "jane_obrien@a.com", "obrien.jane@a.com"]
    assert values(spark, [("Jane Doe",), ("Contact Us",), ("jane doe",)], "n string", t.looks_like_person(c("n"))) == [(True,), (False,), (False,)]


def test_similarity(spark):
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for k, y in enumerate(b, 1):
                before, row[k] = row[k], before + 1 if x == y else max(row[k], row[k - 1])
        return row[-1]

    for a, b in [("kitten", "sitting"), ("abcabc", "cbacba"), ("", "x"), ("same", "same"), ("aaaa", "aa")]:
        assert _lcs(a, b) == plain(a, b)
    assert values(spark, [("acme", "acmes"), ("", "a"), ("x", "x")], "a string, b string", indel_ratio("a", "b")) == [(8 / 9,), (0.0,), (1.0,)]
    assert values(spark, [("a b c", "b c d")], "a string, b string", t.word_jaccard(c("a"), c("b")), t.names_match(c("a"), c("b"))) == [(0.5, True)]


def test_grades_and_markets(spark):
    got = values(spark, [(90,), (89,), (60,), (59,)], "s int", s.grade(c("s")))
    assert [x[0] for x in got] == ["A", "B", "D", "F"]
    assert values(spark, [(50, 60.0), (20, 50.0), (5, 1.0), (4, 99.0)], "n int, a double", s.classify_market(c("n"), c("a"))) == [("Hot Market",), ("Opportunity Market",), ("Emerging",), ("Developing",)]


def test_page_facts(spark):
    html = '<html><head><title>T</title><meta name="generator" content="WordPress 6"></head><body><h1>Our  team</h1><a href="https://acme.com/x">Acme*</a><a href="https://facebook.com/a">F</a><script src="https://www.googletagmanager.com/x"></script></body></html>'
    df = spark.createDataFrame([(1, "https://www.pma.org/members/", html)], "page_id int, url string, html string")
    parsed = p.parse_page(df, ["page_id", "url"])
    row = parsed.first()
    assert (row["title"], row["h1"], row["generator"], len(row["anchors"])) == ("T", ["Our team"], "WordPress 6", 2)
    assert [tuple(r) for r in p.external_members(parsed, "page_id", "url").collect()] == [(1, "acme.com", "Acme", "https://acme.com/x")]
    text = "ISO 9001 and AS9100 certified; CNC  turning. Founded in 1975, 1,200 employees. Call (555) 123-4567."
    got = values(spark, [(text,)], "t string", p.certifications(c("t")), p.capabilities(c("t")), p.about_facts(c("t")), p.phones(c("t")))[0]
    assert got[0] == ["ISO 9001", "AS9100"] and got[1] == ["CNC turning"] and (got[2]["employees"], got[2]["founded"]) == (1200, 1975) and got[3] == ["5551234567"]
    dns = values(spark, [(["mx1.acme.com"], "v=DMARC1; p=reject; rua=mailto:a@b.c", "include:_spf.google.com include:sendgrid.net")], "h array<string>, d string, s string", p.mail_provider(c("h"), F.lit("acme.com")), p.dmarc(c("d")), p.spf_services(c("s")))[0]
    assert dns[0] == "Self-hosted" and tuple(dns[1]) == ("Strict (reject)", "a@b.c") and dns[2] == ["Google Workspace", "SendGrid"]


def test_signals_have_places(spark):
    text = "We run Epicor since 2010. Epicor is our ERP. " + "x " * 200 + "epicor booth"
    got = p.mine_signals(spark.createDataFrame([(1, text)], "id int, text string"), "id", "text", {"epicor": ["epicor"]}).orderBy("at").collect()
    assert [r["at"] for r in got] == [i for i in range(len(text)) if text.lower().startswith("epicor", i)]
    assert got[0]["kind"] == "MEMBER_USAGE" and got[2]["kind"] == "EXHIBITOR"
