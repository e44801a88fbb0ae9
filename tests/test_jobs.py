"""Postings, answers of providers and team pages: odd rows."""

from pyspark.sql import functions as F

from guildbook.operators import jobs as jb
from guildbook.operators import payloads as pl
from guildbook.operators import people as pe

c = F.col


def test_mentions(spark):
    jobs = spark.createDataFrame([(1, n, f"Title {n}", "We use SYSPRO. syspro!") for n in range(18)] + [(2, 1, None, "Plex ERP"), (2, 2, "SAP B1 and Syspro", None), (3, 1, None, None)], "k int, o int, title string, snippet string")
    got = [r.asDict() for r in jb.job_mentions(jobs, "k", "o").orderBy("k", "rank").collect()]
    assert [r["job_title"] for r in got if r["k"] == 1] == [f"Title {n}" for n in range(15)] and got[0]["context"] == "...title 0 we use syspro. syspro!..."
    assert [(r["vendor"], r["job_title"]) for r in got if r["k"] == 2] == [("plex", None), ("sap", "SAP B1 and Syspro"), ("syspro", "SAP B1 and Syspro")]
    assert {r["k"]: (r["vendor"], r["mentions"]) for r in jb.primary_vendor(jobs, "k", "o").collect()} == {1: ("syspro", 36), 2: ("plex", 1)}
    assert jb.hiring_titles(jobs, "k", "o", 3).count() == 4
    assert jb.job_mentions(jobs.limit(0), "k", "o").count() == 0


def test_cards_and_answers_that_are_broken(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "{"), (4, "[]"), (5, "{}")], "k int, raw string")
    assert jb.job_cards(df.withColumnRenamed("raw", "html"), "k").count() == 0
    assert pl.provider_contacts(df, "k", "raw", "hunter").count() == 0 and pl.provider_contacts(df, "k", "raw", "apollo").count() == 0
    for provider in ("clearbit", "apollo", "zoominfo"):
        rows = pl.firmographics(df, "k", "raw", provider).collect()
        assert len(rows) == 5 and not any(r["employee_count_min"] for r in rows)
    assert all(not r["tech_stack"] and r["erp_system"] is None for r in pl.technologies(df, "k", "raw").collect())


def test_people(spark):
    html = "<div class='leader'><h3>One</h3><b>x</b><p>Owner<br>of it</p><strong>Ann B. Lee</strong><div class='leader'><h3>Bo Ray</h3><p>CFO</p></div>"
    got = pe.people_of(html)
    assert [(x["name"], x["title"]) for x in got] == [("Ann B. Lee", "Ownerof it"), ("Bo Ray", "CFO")]
    text = ", ".join(f"Ann Lee, Director of {n}" for n in range(12))
    assert len(pe.people_of(f"<p>{text}</p>")) == 10 and pe.people_of("<script>Ann Lee, CEO</script>") == [] and pe.people_of("") == []
    df = spark.createDataFrame([(1, None), (2, html), (2, html)], "k int, html string")
    assert pe.extract_people(df, "k").count() == 4
    titles = spark.createDataFrame([("VP of it",), ("Welder",), (None,), ("",), ("ceo " * 30,)], "t string")
    assert [r[0] for r in titles.select(jb.looks_like_title(c("t"))).collect()] == [True, False, False, False, False]
