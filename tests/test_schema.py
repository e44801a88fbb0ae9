"""Selectors and records by a schema, participants: odd pages."""

import time

import pytest
from pyspark.sql import functions as F

from guildbook.functions import schemas
from guildbook.operators import event_pages as ep
from guildbook.operators import matcher
from guildbook.operators import pages as pg
from guildbook.operators import participants as pa
from guildbook.operators import people as pe
from guildbook.operators import schema as sc
from guildbook.operators.people import Elements


def page(html):
    p = Elements()
    p.feed(html)
    p.close()
    return p


def test_selectors():
    p = page("<div class='a b' id=x><p><a href='http://q.com/1' rel=ext>1</a></p></div><a href='/2'>2</a><p class=c-d>3")
    ids = lambda s: [p.text(i) for i in sc.select(p, s)]
    assert ids("a") == ["1", "2"] and ids("div a") == ["1"] and ids(".a.b a[rel=ext]") == ["1"] and ids("#x p a") == ["1"] and ids("p div a") == []
    assert ids("a[href^='/']") == ["2"] and ids("a[href$='1'], .c-d") == ["1", "3"] and ids("a[href*='q.com']:not([rel])") == [] and ids("a:not([rel='ext'])") == ["2"]
    assert ids("div > p") == ["1"] and ids("div > a") == [] and ids("p > a[rel]") == ["1"] and ids("//div//a") == ["1"] and ids("/div/p/a") == ["1"] and ids("//p[2]") == [] and ids("//a[@rel='ext']") == ["1"]
    for odd in ("a >", "a:hover", "//", "//a[text()='x']", "> a"):
        with pytest.raises(ValueError):
            sc.select(p, odd)


def test_records_of_odd_pages(spark):
    schema = {"company_name": {"selectors": ["h1", "b"]}, "tier": {"selectors": ["i"], "mapping": {"g": "gold"}, "enum": ["Gold"], "default": "none"}}
    rows = [(1, None), (2, ""), (3, "<h1></h1><b>B"), (4, "<h1>A</h1><i>g</i>"), (4, "<h1>A</h1><i>other</i>"), (5, "<b>" * 3000 + "deep")]
    df = spark.createDataFrame(rows, "k int, html string")
    got = sorted((r["k"], r["company_name"], r["tier"]) for r in sc.extract_by_schema(df, "k", schema).collect())
    assert got == [(3, "B", "none"), (4, "A", "Gold"), (4, "A", "other"), (5, "deep", "none")]
    assert sc.extract_by_schema(df.limit(0), "k", schema).count() == 0 and sc.extended({"a": 1}, {"a": 2, "b": 3}) == {"a": 1, "b": 3}


def test_participants_of_odd_pages(spark):
    gold = "<div class='gold'><a href='/x'>Firm A</a></div>"
    rows = [(1, None, None, None), (2, "http://a.org/l", "SPONSORS_LIST", gold + gold), (3, "http://a.org/l", "PARTICIPANTS_LIST", "<p>our vendors</p><table><tr><th>N</th></tr><tr><td>Firm B</td></tr></table>"), (4, "u", "OTHER", gold), (5, "http://a.org/l", "SPONSORS_LIST", "<div id='sponsors'><a href='/y'>Firm C</a></div>")]
    df = spark.createDataFrame(rows, "k int, url string, kind string, html string")
    got = sorted((r["k"], r["kind"], r["tier"], r["company_name"], r["website"]) for r in pa.extract_participants(df, "k", "url", "kind").collect())
    assert got == [(2, "SPONSOR", "GOLD", "Firm A", "http://a.org/x"), (3, "EXHIBITOR", None, "Firm B", None), (5, "SPONSOR", "OTHER", "Firm C", "http://a.org/y")]


def test_events_of_odd_pages(spark):
    rows = [(1, None, None, None), (2, "http://a.org/e", "EVENT_DETAIL", None), (3, "http://a.org/e", "EVENTS_LIST", ""), (4, "http://a.org/e", "EVENT_DETAIL", "<script type='application/ld+json'>{broken</script><title>Steel Expo | Site</title>"), (5, "http://a.org/e", "EVENTS_LIST", "<table><tr><th>N</th></tr><tr><td><a href='/1'>First Seminar</a></td></tr><tr><td>no link</td></tr></table>")]
    df = spark.createDataFrame(rows, "k int, url string, kind string, html string")
    got = sorted((r["k"], r["title"], r["event_type"], r["event_url"], r["start_date"]) for r in ep.extract_events(df, "k", "url", "kind").collect())
    assert got == [(4, "Steel Expo", "TRADE_SHOW", "http://a.org/e", None), (5, "First Seminar", "WORKSHOP", "http://a.org/1", None)]


def test_paths_take_text_and_attributes(spark):
    html = "<html><body><div class='box big'><h2>One <i>inner</i> tail</h2><a href='/x'>X</a><a href='/y'>Y</a></div><p> two </p></body></html>"
    fields = {
        "company_name": ["//div[contains(@class, 'big')]/h2"], "b": ["//a[2]/@href"], "c": ["//a[@href='/y']/text()"], "d": ["/html/body/p"], "e": ["//table", "//div/*[@href]/@href"], "f": ["//i/b", "h2"],
    }
    df = spark.createDataFrame([(1, html)], "k int, html string")
    row = sc.extract_by_schema(df, "k", {n: {"selectors": s} for n, s in fields.items()}).first()
    assert row[2:] == ("One ", "/y", "Y", " two ", "/x", "Oneinnertail")


def test_keys_beyond_floats_beside_a_null(spark):
    html = "<h1>Firm</h1><div class='team-member'><h3>Ann Lee</h3></div><a href='http://b.com'>B</a>"
    df = spark.createDataFrame([(2**60 + 1, "http://a.org", "EVENT_DETAIL", html), (None, "http://a.org", "EVENT_DETAIL", html)], "k long, url string, kind string, html string")
    want = {2**60 + 1, None}
    got = [
        sc.extract_by_schema(df, "k", {"company_name": {"selectors": ["h1"]}}), pe.extract_people(df, "k"), pg.parse_page(df, ["k"]), ep.extract_events(df, "k", "url", "kind"),
        pa.extract_participants(df.withColumn("kind", F.lit("SPONSORS_LIST")).withColumn("html", F.lit("<div class='gold'><a href='/x'>Firm A</a></div>")), "k", "url", "kind"),
    ]
    assert all({r["k"] for r in x.collect()} == want for x in got)


def test_lists_take_the_links_where_they_are_more(spark):
    item = "<li><b>{}</b></li>"
    link = "<a href='https://f{0}.com'>Firm {0}</a>"
    rows = [(1, "http://a.org", f"<div><ul>{item.format('A')}{item.format('B')}</ul></div>{link.format(1)}"), (2, "http://a.org", f"<ul>{item.format('C')}</ul>{link.format(1)}{link.format(2)}"), (3, "http://a.org", f"{link.format(3)}"), (4, None, None)]
    df = spark.createDataFrame(rows, "k int, url string, html string")
    schema = {"company_name": {"selectors": ["b"]}, "website": {"selectors": ["a"], "extract": "href"}}
    got = sorted((r["k"], r["how"], r["company_name"], r["website"]) for r in sc.directory_records(df, "k", "url", schema, "li").collect())
    assert got == [(1, "schema", "A", None), (1, "schema", "B", None), (2, "links", "Firm 1", "https://f1.com"), (2, "links", "Firm 2", "https://f2.com"), (3, "links", "Firm 3", "https://f3.com")]
    boxed = sc.directory_records(df.withColumn("html", F.concat(F.lit("<ul><li><b>Out</b></li></ul><section>"), "html", F.lit("</section>"))), "k", "url", schema, "li", container="section")
    assert {r["company_name"] for r in boxed.filter("k = 1").collect()} == {"A", "B"}


def test_time_is_linear_in_a_page():
    """A page of four megabytes with many elements, open tags and ends without a beginning; some 40 selectors."""
    html = "<div class='a'>" * 2000 + "<section class='profile-header'><h1>x</h1></section><p><b>some words of text</i></b><a href='http://q.com/1'>q</a></p>" * 38_000
    selectors = tuple(s for f in schemas.DEFAULT.values() for s in f["selectors"])
    took = []
    for n in (len(html) // 8, len(html) // 2):
        began = time.perf_counter()
        page = matcher.read(html[:n], matcher.rules(selectors))
        assert page.value(selectors.index("h1")) == "x"
        took.append(time.perf_counter() - began)
    assert took[1] < 8 * took[0] + 1
    assert sc.select(page, ".profile-header h1") == page.found(selectors.index(".profile-header h1"))
