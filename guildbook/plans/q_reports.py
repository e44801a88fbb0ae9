"""Queries of aggregates, windows and rankings, each with independent SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from guildbook.functions import scores as s
from guildbook.functions import tables
from guildbook.functions import text as t
from guildbook.operators import report as r
from guildbook.plans.frames import frame, table, with_frames
from guildbook.plans.q_rows import _LIST, ICP_HEAD, SCORED_HEAD

c = F.col

def assoc():
    return t.text_list(c("associations"))


def _icp(spark, sf):
    df = frame(spark, sf, "companies").withColumns(s.icp_dimensions())
    df = df.withColumn("icp_score", F.least(F.lit(100), s.total([c(k) for k in s.icp_dimensions()])))
    return df.withColumn("tier", s.assign_tier(c("icp_score"), c("n_contacts") > 0, c("quality_score"))).withColumn("competitor", s.detect_competitor(s.all_text()))


def _scored(spark, sf):
    df = frame(spark, sf, "companies").withColumns({"completeness": s.completeness(), "accuracy": s.accuracy(), "freshness": s.freshness(c("days_old")), "source_reliability": s.source_reliability()})
    return df.withColumn("score", s.quality_score()).withColumn("letter", s.grade(c("score")))


def grade_distribution(spark, sf):
    return r.distribution(_scored(spark, sf), "letter")


def state_top(spark, sf):
    return r.distribution(frame(spark, sf, "companies"), "state", top=5)


def providers_other(spark, sf):
    return r.top_k_other(frame(spark, sf, "companies"), "email_provider", 3)


def tech_distribution(spark, sf):
    return r.array_distribution(frame(spark, sf, "companies"), t.text_list(c("tech_stack")))


FIELDS = {"website": "string", "phone": "string", "email": "string", "erp_system": "string", "employee_count_min": "number", "year_founded": "number"}


def coverage(spark, sf):
    return r.field_coverage(frame(spark, sf, "companies"), {f: t.has_value(c(f), k) for f, k in FIELDS.items()})


def summary(spark, sf):
    return _scored(spark, sf).agg(
        F.count("*").alias("companies"), F.bround(F.avg("score"), 1).alias("average"), r.upper_median("score").cast("int").alias("median"),
        F.count_if(c("n_contacts") > 0).alias("with_contacts"), F.count_if(t.has_value(c("erp_system"))).alias("with_erp"),
    )


def by_association(spark, sf):
    df = frame(spark, sf, "companies").select("company_id", "website", "phone", "n_contacts", "quality_score", F.explode_outer(F.when(F.size(assoc()) > 0, assoc())).alias("a"))
    share = lambda x: F.round(100.0 * F.count_if(x) / F.count("*"), 6)
    return df.groupBy(F.coalesce("a", F.lit("none")).alias("association")).agg(
        F.count("*").alias("companies"), share(t.has_value(c("website"))).alias("website_pct"), share(t.has_value(c("phone"))).alias("phone_pct"), share(c("n_contacts") > 0).alias("contacts_pct"), F.round(F.avg("quality_score"), 6).alias("avg_quality")
    )


def by_state(spark, sf):
    df = _icp(spark, sf).filter(c("state") != "")
    top = r.top_per_group(df.select("state", F.explode(assoc()).alias("a")), ["state"], "a").select("state", c("a").alias("top_association"))
    out = df.groupBy("state").agg(F.count("*").alias("companies"), F.round(F.avg("icp_score"), 6).alias("avg_icp"), F.round(F.avg("quality_score"), 6).alias("avg_quality"))
    return out.join(top, "state", "left").withColumn("market", s.classify_market(c("companies"), c("avg_icp")))


def association_overlap(spark, sf):
    return r.overlap(frame(spark, sf, "companies"), assoc(), "company_id")


def score_histogram(spark, sf):
    return r.histogram(_scored(spark, sf), "score")


def tier_summary(spark, sf):
    """All four tiers, those without companies too."""
    tiers = spark.createDataFrame([(x,) for x in ("Tier 1", "Tier 2", "Tier 3", "Unqualified")], "tier string")
    got = _icp(spark, sf).groupBy("tier").agg(F.count("*").alias("n"), F.round(F.avg("icp_score"), 6).alias("avg_icp"), F.count_if(t.has_value(c("website"))).alias("with_website"))
    return tiers.join(got, "tier", "left").select("tier", F.coalesce("n", F.lit(0)).alias("n"), "avg_icp", F.coalesce("with_website", F.lit(0)).alias("with_website"))


def tier_lists(spark, sf):
    return r.tier_lists(_icp(spark, sf), {"Tier 1": 50, "Tier 2": 200}).select("tier", "rank", "company_id", "icp_score")


def all_tier_lists(spark, sf):
    """The lists of tiers 1 and 2, and all of tier 3."""
    return r.tier_lists(_icp(spark, sf).select("tier", "company_id", "icp_score", "quality_score"), {"Tier 1": 50, "Tier 2": 200}, ("Tier 3",)).select("tier", "rank", "company_id", "icp_score")


#: All that an association's companies may have: nothing, or a competitor of the table.
RIVALS = ["greenfield", *[name.title() for name in tables.COMPETITORS]]


def competitive_pressure(spark, sf):
    """Association by competitor, greenfield among them, and the strongest competitor."""
    df = _icp(spark, sf).select(F.explode(assoc()).alias("association"), F.when(c("competitor") == "", "greenfield").otherwise(c("competitor")).alias("rival"))
    wide = df.groupBy("association").pivot("rival", RIVALS).count().na.fill(0)
    strongest = r.top_per_group(df.filter(c("rival") != "greenfield"), ["association"], "rival").select("association", c("rival").alias("strongest"))
    return wide.join(strongest, "association", "left")


def email_infrastructure(spark, sf):
    df = frame(spark, sf, "companies").withColumn("provider", F.coalesce(F.nullif("email_provider", F.lit("")), F.lit("Unknown")))
    middle = (F.coalesce("employee_count_min", F.lit(0)) + F.coalesce("employee_count_max", F.lit(0))) / 2
    return df.groupBy("provider").agg(F.count("*").alias("n"), F.round(F.avg(F.when(middle > 0, middle)), 6).alias("people"), F.count_if(c("spf_services") != "").alias("with_spf"))


def gap_analysis(spark, sf):
    df = _icp(spark, sf).filter(c("tier") == "Tier 2")
    return r.field_coverage(df, {f: ~t.has_value(c(f), k) for f, k in FIELDS.items()}).withColumnRenamed("filled", "missing")


def kpis(spark, sf):
    df = _icp(spark, sf)
    share = lambda x: F.round(100.0 * F.count_if(x) / F.count("*"), 6)
    return df.agg(F.count("*").alias("companies"), share(c("quality_score") >= 70).alias("good_pct"), share(c("enrichment_status") == "complete").alias("done_pct"), share(c("competitor") == "").alias("greenfield_pct"), F.count_if(c("tier") == "Tier 1").alias("tier1"))


def competitor_report(spark, sf):
    df = frame(spark, sf, "signals")
    return df.groupBy("competitor", "signal_type").agg(F.count("*").alias("n"), F.count_distinct("company_id").alias("companies"), F.count_distinct("event_id").alias("events"), F.round(F.avg("confidence"), 6).alias("confidence"), F.max("detected_at").cast("string").alias("last_seen"))


def company_summary(spark, sf):
    """Memberships and contacts are summed each on its own before the join, so no row is multiplied."""
    m = frame(spark, sf, "memberships").groupBy("company_id").agg(F.array_join(F.array_sort(F.collect_set("association")), ",").alias("associations"))
    k = frame(spark, sf, "contacts").groupBy("company_id").agg(F.count("*").alias("contacts"))
    base = frame(spark, sf, "companies").select("company_id", "company_name")
    return base.join(m, "company_id", "left").join(k, "company_id", "left").select("company_id", "company_name", F.coalesce("associations", F.lit("")).alias("associations"), F.coalesce("contacts", F.lit(0)).alias("contacts"))


def event_summary(spark, sf):
    kinds = {"SPONSOR": "sponsors", "EXHIBITOR": "exhibitors", "ATTENDEE": "attendees"}
    return frame(spark, sf, "participants").groupBy("event_id").agg(*[F.count_distinct(F.when(c("kind") == k, c("company_id"))).alias(n) for k, n in kinds.items()])


def top_contacts(spark, sf):
    """First contact per address or name, then target titles only, the best five of a company."""
    df = frame(spark, sf, "contacts").withColumn("key", F.lower(F.coalesce("email", "name"))).withColumn("priority", t.title_priority(c("title")))
    first = df.groupBy("company_id", "key").agg(F.min_by(F.struct("contact_id", "name", "title", "priority"), "contact_id").alias("x")).select("company_id", "x.*")
    return r.latest(first.filter(c("priority") < 999), "company_id", [c("priority"), c("contact_id")], 5).select("company_id", "rank", "contact_id", "title", "priority")


def latest_contacts(spark, sf):
    return r.latest(frame(spark, sf, "contacts"), "company_id", [F.desc("seen_at"), c("contact_id")], 2).select("company_id", "rank", "contact_id")


def daily_quota(spark, sf):
    """At most three requests per domain (kind of event) and day."""
    return r.daily_quota(table(spark, sf, "events"), "event_type", "ts", "event_id", 3).select("event_id", "event_type", "rank")


def next_urls(spark, sf):
    return table(spark, sf, "events").orderBy(F.desc(c("user_id") % 10), "ts", "event_id").limit(25).select("event_id", (c("user_id") % 10).alias("priority"))


def probes(spark, sf):
    df = table(spark, sf, "events").select(c("user_id").cast("string").alias("domain"), c("event_id").alias("turn"), F.concat(F.lit("p"), (c("event_id") % 6).cast("string")).alias("address"), F.when(c("event_type") == "click", "verified").when(c("event_type") == "error", "inconclusive").otherwise("rejected").alias("outcome"))
    return r.probe_summary(df)


COUNT_SQL = "count(*) AS n"
QUERIES = {
    "grade_distribution": (grade_distribution, with_frames(SCORED_HEAD + "SELECT letter AS value, count(*) AS n FROM scored GROUP BY 1", "companies")),
    "state_top": (state_top, with_frames("SELECT CASE WHEN trim(state) <> '' THEN state ELSE 'Unknown' END AS value, count(*) AS n FROM companies GROUP BY 1 ORDER BY n DESC, value LIMIT 5", "companies")),
    "providers_other": (providers_other, with_frames("WITH n AS (SELECT CASE WHEN email_provider = '' THEN 'Unknown' ELSE email_provider END AS value, count(*) AS n FROM companies GROUP BY 1), k AS (SELECT *, row_number() OVER (ORDER BY n DESC, value) AS i FROM n) SELECT CASE WHEN i <= 3 THEN value ELSE 'Other' END AS value, sum(n)::BIGINT AS n FROM k GROUP BY 1", "companies")),
    "tech_distribution": (tech_distribution, with_frames(f"SELECT value, count(*) AS n FROM (SELECT unnest({_LIST.format('tech_stack')}) AS value FROM companies) GROUP BY 1", "companies")),
    "field_coverage": (coverage, with_frames(" UNION ALL ".join(f"SELECT '{f}' AS field, count(*) FILTER ({'trim(' + f + ') <> ' + chr(39) * 2 if k == 'string' else f + ' IS NOT NULL'}) AS filled, round(100.0 * count(*) FILTER ({'trim(' + f + ') <> ' + chr(39) * 2 if k == 'string' else f + ' IS NOT NULL'}) / count(*), 6) AS percent FROM companies" for f, k in FIELDS.items()), "companies")),
    "summary": (summary, with_frames(SCORED_HEAD + "SELECT count(*) AS companies, round_even(avg(score), 1) AS average, (SELECT list_sort(list(score))[count(*) // 2 + 1] FROM scored) AS median, count(*) FILTER (n_contacts > 0) AS with_contacts, count(*) FILTER (trim(erp_system) <> '') AS with_erp FROM scored", "companies")),
    "by_association": (by_association, with_frames(f"WITH x AS (SELECT *, unnest(CASE WHEN len({_LIST.format('associations')}) = 0 THEN ['none'] ELSE {_LIST.format('associations')} END) AS association FROM companies) SELECT association, count(*) AS companies, round(100.0 * count(*) FILTER (trim(website) <> '') / count(*), 6) AS website_pct, round(100.0 * count(*) FILTER (trim(phone) <> '') / count(*), 6) AS phone_pct, round(100.0 * count(*) FILTER (n_contacts > 0) / count(*), 6) AS contacts_pct, round(avg(quality_score), 6) AS avg_quality FROM x GROUP BY 1", "companies")),
    "by_state": (by_state, with_frames(ICP_HEAD + ", s AS (SELECT state, count(*) AS companies, round(avg(icp_score), 6) AS avg_icp, round(avg(quality_score), 6) AS avg_quality FROM icp WHERE state <> '' GROUP BY 1), a AS (SELECT state, a, count(*) AS n FROM (SELECT state, unnest(assoc) AS a FROM icp) GROUP BY 1, 2), b AS (SELECT state, a FROM (SELECT *, row_number() OVER (PARTITION BY state ORDER BY n DESC, a) AS i FROM a) WHERE i = 1) SELECT s.*, b.a AS top_association, CASE WHEN companies >= 50 AND avg_icp >= 60 THEN 'Hot Market' WHEN companies >= 20 AND avg_icp >= 50 THEN 'Opportunity Market' WHEN companies >= 5 THEN 'Emerging' ELSE 'Developing' END AS market FROM s LEFT JOIN b USING (state)", "companies")),
    "association_overlap": (association_overlap, with_frames(f"WITH x AS (SELECT DISTINCT company_id, unnest({_LIST.format('associations')}) AS a FROM companies) SELECT p.a, q.a AS b, count(*) AS shared FROM x p JOIN x q USING (company_id) GROUP BY 1, 2", "companies")),
    "score_histogram": (score_histogram, with_frames(SCORED_HEAD + "SELECT least(score // 10, 9)::INT AS bucket, count(*) AS n FROM scored GROUP BY 1", "companies")),
    "tier_summary": (tier_summary, with_frames(ICP_HEAD + "SELECT t.tier, count(company_id) AS n, round(avg(icp_score), 6) AS avg_icp, count(*) FILTER (trim(website) <> '') AS with_website FROM (VALUES ('Tier 1'), ('Tier 2'), ('Tier 3'), ('Unqualified')) t(tier) LEFT JOIN icp ON icp.tier = t.tier GROUP BY 1", "companies")),
    "tier_lists": (tier_lists, with_frames(ICP_HEAD + "SELECT tier, rank::INT AS rank, company_id, icp_score FROM (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY icp_score DESC, quality_score DESC, company_id) AS rank FROM icp) WHERE tier = 'Tier 1' AND rank <= 50 OR tier = 'Tier 2' AND rank <= 200", "companies")),
    "all_tier_lists": (all_tier_lists, with_frames(ICP_HEAD + "SELECT tier, rank::INT AS rank, company_id, icp_score FROM (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY icp_score DESC, quality_score DESC, company_id) AS rank FROM icp) WHERE tier = 'Tier 1' AND rank <= 50 OR tier = 'Tier 2' AND rank <= 200 OR tier = 'Tier 3'", "companies")),
    "competitive_pressure": (competitive_pressure, with_frames(ICP_HEAD + ", x AS (SELECT unnest(assoc) AS association, CASE competitor WHEN '' THEN 'greenfield' ELSE competitor END AS rival FROM icp), b AS (SELECT association, rival, row_number() OVER (PARTITION BY association ORDER BY count(*) DESC, rival) AS i FROM x WHERE rival <> 'greenfield' GROUP BY 1, 2) SELECT x.association, " + ", ".join(f"count(*) FILTER (x.rival = '{n}') AS \"{n}\"" for n in RIVALS) + ", any_value(b.rival) AS strongest FROM x LEFT JOIN b ON b.association = x.association AND b.i = 1 GROUP BY 1", "companies")),
    "email_infrastructure": (email_infrastructure, with_frames("SELECT CASE email_provider WHEN '' THEN 'Unknown' ELSE email_provider END AS provider, count(*) AS n, round(avg(nullif((coalesce(employee_count_min, 0) + coalesce(employee_count_max, 0)) / 2, 0)), 6) AS people, count(*) FILTER (spf_services <> '') AS with_spf FROM companies GROUP BY 1", "companies")),
    "gap_analysis": (gap_analysis, with_frames(ICP_HEAD + " UNION ALL ".join(f"SELECT '{f}' AS field, count(*) FILTER ({'coalesce(trim(' + f + '), ' + chr(39) * 2 + ') = ' + chr(39) * 2 if k == 'string' else f + ' IS NULL'}) AS missing, round(100.0 * count(*) FILTER ({'coalesce(trim(' + f + '), ' + chr(39) * 2 + ') = ' + chr(39) * 2 if k == 'string' else f + ' IS NULL'}) / count(*), 6) AS percent FROM icp WHERE tier = 'Tier 2'" for f, k in FIELDS.items()), "companies")),
    "kpis": (kpis, with_frames(ICP_HEAD + "SELECT count(*) AS companies, round(100.0 * count(*) FILTER (quality_score >= 70) / count(*), 6) AS good_pct, round(100.0 * count(*) FILTER (enrichment_status = 'complete') / count(*), 6) AS done_pct, round(100.0 * count(*) FILTER (competitor = '') / count(*), 6) AS greenfield_pct, count(*) FILTER (tier = 'Tier 1') AS tier1 FROM icp", "companies")),
    "competitor_report": (competitor_report, with_frames("SELECT competitor, signal_type, count(*) AS n, count(DISTINCT company_id) AS companies, count(DISTINCT event_id) AS events, round(avg(confidence), 6) AS confidence, CASE WHEN max(detected_at) = date_trunc('second', max(detected_at)) THEN strftime(max(detected_at), '%Y-%m-%d %H:%M:%S') ELSE rtrim(strftime(max(detected_at), '%Y-%m-%d %H:%M:%S.%f'), '0') END AS last_seen FROM signals GROUP BY 1, 2", "signals")),
    "company_summary": (company_summary, with_frames("SELECT company_id, company_name, coalesce((SELECT string_agg(association, ',' ORDER BY association) FROM memberships m WHERE m.company_id = c.company_id), '') AS associations, (SELECT count(*) FROM contacts k WHERE k.company_id = c.company_id) AS contacts FROM companies c", "companies", "memberships", "contacts")),
    "event_summary": (event_summary, with_frames("SELECT event_id, count(DISTINCT company_id) FILTER (kind = 'SPONSOR') AS sponsors, count(DISTINCT company_id) FILTER (kind = 'EXHIBITOR') AS exhibitors, count(DISTINCT company_id) FILTER (kind = 'ATTENDEE') AS attendees FROM participants GROUP BY 1", "participants")),
    "top_contacts": (top_contacts, with_frames("WITH p AS (SELECT *, CASE WHEN regexp_matches(lower(title), 'vp?\\s*(of\\s*)?it|it director|director.*\\bit\\b|chief information officer|cio|coo') THEN 1 WHEN regexp_matches(lower(title), 'ceo|chief executive|president|owner|cfo|controller') THEN 2 WHEN contains(lower(title), 'plant manager') THEN 3 ELSE 999 END AS priority, row_number() OVER (PARTITION BY company_id, lower(coalesce(email, name)) ORDER BY contact_id) AS f FROM contacts), q AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY priority, contact_id) AS rank FROM p WHERE f = 1 AND priority < 999) SELECT company_id, rank::INT AS rank, contact_id, title, priority FROM q WHERE rank <= 5", "contacts")),
    "latest_contacts": (latest_contacts, with_frames("SELECT company_id, rank::INT AS rank, contact_id FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY seen_at DESC, contact_id) AS rank FROM contacts) WHERE rank <= 2", "contacts")),
    "daily_quota": (daily_quota, "SELECT event_id, event_type, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY event_type, date_trunc('day', ts) ORDER BY ts, event_id) AS rank FROM events) WHERE rank <= 3"),
    "next_urls": (next_urls, "SELECT event_id, user_id % 10 AS priority FROM events ORDER BY user_id % 10 DESC, ts, event_id LIMIT 25"),
    "probe_summary": (probes, "WITH p AS (SELECT user_id::VARCHAR AS domain, event_id AS turn, 'p' || (event_id % 6) AS address, CASE event_type WHEN 'click' THEN 'verified' WHEN 'error' THEN 'inconclusive' ELSE 'rejected' END AS outcome FROM events), q AS (SELECT *, row_number() OVER w AS i, coalesce(sum(CASE WHEN outcome = 'inconclusive' THEN 1 ELSE 0 END) OVER (PARTITION BY domain ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM p WINDOW w AS (PARTITION BY domain ORDER BY turn)) SELECT domain, count(*) AS probes, count(*) FILTER (outcome = 'verified') AS verified, arg_min(address, turn) FILTER (outcome = 'verified') AS first, bool_or(outcome = 'inconclusive') AS blocked FROM q WHERE i <= 3 AND b = 0 GROUP BY 1"),
}
