"""Queries of selections, entity pairs, providers, intelligence, runs and discovery, each with SQL written by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from guildbook.functions import scores as s
from guildbook.functions import tables
from guildbook.functions import text as t
from guildbook.operators import discovery as d
from guildbook.operators import graph as g
from guildbook.operators import intel as i
from guildbook.operators import joins as j
from guildbook.operators import match as m
from guildbook.operators import pages as p
from guildbook.operators import select as sel
from guildbook.plans.frames import frame, table, with_frames
from guildbook.plans.q_reports import _icp, _scored
from guildbook.plans.q_rows import _LIST, DOMAIN_SQL, ICP_HEAD, SCORED_HEAD, _quote

c = F.col


def search_page(spark, sf):
    return sel.search(frame(spark, sf, "companies"), state="OH", min_quality=40, limit=25, offset=5).select("company_id", "quality_score")


def gated(spark, sf):
    return sel.quality_gate(frame(spark, sf, "companies"), 60).select("company_id", "quality_score")


def full_contract(spark, sf):
    """Companies with faults put in: sites without a scheme, addresses without @, upside-down numbers of employees, scores beyond the range."""
    k = c("company_id")
    df = frame(spark, sf, "companies").withColumns({
        "website": F.when(k % 6 == 1, F.regexp_replace("website", "^https?://", "")).otherwise(c("website")), "email": F.when(k % 8 == 3, F.replace("email", F.lit("@"), F.lit(" at "))).otherwise(c("email")),
        "employee_count_max": F.when(k % 9 == 2, 1).otherwise(c("employee_count_max")), "quality_score": F.when(k % 50 == 0, 101).otherwise(c("quality_score")), "company_name": F.when(k % 70 == 0, " ").otherwise(c("company_name")),
    })
    return sel.check_contract(df, "company_id", sel.company_contract())


def provenance(spark, sf):
    df = frame(spark, sf, "companies").select("company_id", F.when(c("company_id") % 3 == 0, "").otherwise(c("website")).alias("source_url"), F.when(c("company_id") % 4 != 0, F.lit("2024-01-01")).alias("extracted_at"), F.when(c("company_id") % 5 == 0, "crawl").alias("provenance"))
    return sel.check_provenance(df, "company_id")


def missing_labels(spark, sf):
    return sel.require_labels(frame(spark, sf, "companies"), "company_id", ["erp_system", "membership_tier", "naics_code"])


def lookups(spark, sf):
    """The companies of one site, and the sponsors of one event."""
    companies = sel.by_domain(frame(spark, sf, "companies"), "firm9.com").select(F.lit("domain").alias("what"), "company_id")
    return companies.unionByName(sel.participants_of(frame(spark, sf, "participants"), 7, "SPONSOR").select(F.lit("sponsor").alias("what"), "company_id"))


def phone_work(spark, sf):
    return sel.work_priority(frame(spark, sf, "companies")).select("company_id", "priority")


def _entities(spark, sf):
    n = t.deep_normalize_name(c("company_name"))
    return frame(spark, sf, "companies").select("company_id", "company_name", t.extract_domain(c("website")).alias("domain"), n.alias("name"), F.coalesce(t.last_ten(c("phone")), F.lit("")).alias("phone"), t.normalize_address(c("city"), c("state")).alias("address"))


def entity_pairs(spark, sf):
    pairs = m.score_entity_pairs(_entities(spark, sf), "company_id", ["domain", "phone"])
    return pairs.select("u", "v", F.round("score", 6).alias("score"))


def duplicate_stats(spark, sf):
    df = _entities(spark, sf)
    return m.dedupe_stats(df, m.leader_clusters(m.score_entity_pairs(df, "company_id", ["domain", "phone"])))


def tech_found(spark, sf):
    df = frame(spark, sf, "companies").select("company_id", F.nullif(t.extract_domain(c("website")), F.lit("")).alias("domain"), "company_name", F.nullif("erp_system", F.lit("")).alias("erp_system"))
    k = c("company_id")
    site = df.filter(k % 2 == 0).select("company_id", F.when(k % 4 == 0, "SAP").alias("erp_system"), F.lit("website").alias("tech_source"))
    jobs = df.filter(k % 3 == 0).select("company_id", F.when(k % 9 == 0, "Plex").alias("erp_system"), F.lit("job_postings").alias("tech_source"))
    return j.tech_waterfall(df, "company_id", [("site", site, "domain"), ("jobs", jobs, "company_name")]).select("company_id", "erp_system", "tech_source")


def found_contacts(spark, sf):
    people = frame(spark, sf, "contacts").select("company_id", c("contact_id").alias("turn"), "name", "title", "email")
    providers = [("apollo", people.filter("turn % 2 = 0")), ("website", people.filter("turn % 3 = 0")), ("hunter", people)]
    return j.contacts_from_providers(frame(spark, sf, "companies"), "company_id", providers, t.title_priority(c("title")), few=3)


def contacts_upserted(spark, sf):
    contacts = frame(spark, sf, "contacts")
    one = contacts.filter("email is not null").groupBy("company_id", "email").agg(F.min("contact_id").alias("contact_id"), F.min_by("title", "contact_id").alias("title"))
    batch = contacts.filter("email is not null and contact_id % 2 = 0").select((c("contact_id") + 10_000_000).alias("contact_id"), "company_id", F.upper("email").alias("email"), F.concat(F.lit("New "), c("title")).alias("title"), c("contact_id").alias("turn"))
    target = one.filter("contact_id % 4 < 3").select("contact_id", "company_id", "email", "title")
    return j.upsert_contacts(target, batch, ["title"]).select("contact_id", "company_id", F.lower("email").alias("email"), "title")


def detection_sources(spark, sf):
    return _icp(spark, sf).select("company_id", "competitor", i.detection_source().alias("source"))


def recommendations(spark, sf):
    return _icp(spark, sf).select("company_id", i.recommend_campaign().alias("campaign"), i.recommend_approach().alias("approach"))


def _rivals(spark, sf):
    """Suppliers as tracked competitors: a name of the table, a level of threat, and where they show up."""
    names = F.array(*[F.lit(n.title()) for n in tables.COMPETITORS])
    k = c("s_suppkey")
    return table(spark, sf, "supplier").select(k.alias("rival"), F.concat(F.get(names, (k % len(tables.COMPETITORS)).cast("int")), F.when(k % 2 == 0, " Inc").otherwise("")).alias("name"), F.when(k % 7 == 0, "HIGH").when(k % 7 == 1, "MEDIUM").otherwise("LOW").alias("threat_level"), F.when(k % 3 == 0, "fabtech, pack expo").when(k % 3 == 1, "IMTS booth").otherwise("npe").alias("presence"))


def event_threats(spark, sf):
    k = c("event_id")
    shows = F.array(*[F.lit(x) for x in ("Fabtech show", "IMTS day", "Pack Expo East", "NPE", "Local fair")])
    events = frame(spark, sf, "trade_events").select("event_id", F.get(shows, (k % 5).cast("int")).alias("event_name"), F.when(k % 3 == 0, "HIGH").when(k % 3 == 1, "MEDIUM").otherwise("LOW").alias("priority"), F.when(k % 2 == 0, "NO ERP Competition").otherwise("").alias("notes"))
    return i.event_threat(events, _rivals(spark, sf)).drop("notes", "event_name", "priority")


def competitor_accounts(spark, sf):
    return i.competitor_accounts(_rivals(spark, sf).select("name").distinct(), _icp(spark, sf))


def competitor_rows(spark, sf):
    return i.competitor_matrix(_icp(spark, sf)).select("competitor", "company_id", "icp_score")


def _runs(spark, sf):
    """Orders as jobs: what they asked for, what was done, when they began and ended."""
    k = c("o_orderkey")
    start = F.to_timestamp(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf, "orders").select(k.alias("job_id"), F.concat(F.lit("A"), (k % 7).cast("string")).alias("association"), (k % 50).alias("total_items"), (k % 50 - k % 3).alias("processed_items"), start.alias("started_at"), F.when(k % 4 != 0, start + F.make_dt_interval(mins=(k % 500).cast("int"))).alias("completed_at"), (k % 7 != c("o_custkey") % 9).alias("success"))


def job_progress(spark, sf):
    return i.job_summary(_runs(spark, sf), F.lit("2030-01-01 00:00:00").cast("timestamp")).select("job_id", "progress_percent", "duration_seconds")


def run_errors(spark, sf):
    return i.extraction_errors(_runs(spark, sf))


def phase_totals(spark, sf):
    e = table(spark, sf, "events")
    history = e.select(c("user_id").alias("job_id"), c("event_type").alias("phase"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("started_at"), (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=(c("event_id") % 90).cast("int"))).alias("ended_at"), (c("event_id") % 200).alias("pages"), (c("event_id") % 30).alias("companies"))
    return i.phase_stats(history)


def tech_adoption(spark, sf):
    return i.tech_adoption(frame(spark, sf, "companies"))


def cms_adoption(spark, sf):
    return i.cms_adoption(frame(spark, sf, "companies"))


def maturity_summary(spark, sf):
    known = t.has_value(c("tech_stack")) | t.has_value(c("cms"))
    df = _icp(spark, sf).withColumn("maturity", s.tech_maturity())
    return i.maturity_summary(df.withColumn("tech_tier", s.tech_tier(F.when(known, c("maturity")).otherwise(0), known)))


def grade_vs_icp(spark, sf):
    both = _scored(spark, sf).select("company_id", "letter").join(_icp(spark, sf).select("company_id", "icp_score"), "company_id")
    return i.grade_vs_icp(both)


def updated_graph(spark, sf):
    """Counts of nodes by kind after a second version of some companies came in."""
    parts = [frame(spark, sf, n) for n in ("companies", "memberships", "trade_events", "participants", "signals")]
    companies, memberships, events, participants, signals = parts
    old = g.build_nodes(companies.filter("company_id % 2 = 0"), memberships, events, signals), g.build_edges(memberships, events, participants, signals)
    new = g.build_nodes(companies.filter("company_id % 3 = 0").withColumn("company_name", F.lit("renamed")), memberships.limit(0), events.limit(0), signals.limit(0)), old[1].filter("kind = 'SPONSOR'")
    nodes, edges = g.update_graph(old, new)
    renamed = g.nodes_by_type(nodes, "company").filter("name = 'renamed'").agg(F.lit("renamed").alias("kind"), F.count("*").alias("n"))
    return g.count_by_type(nodes).unionByName(renamed).unionByName(edges.agg(F.lit("edges").alias("kind"), F.count("*").alias("n")))


def _sites(spark, sf):
    return p.parse_page(frame(spark, sf, "sites"), ["page_id", "url"])


def member_links(spark, sf):
    return d.member_links(_sites(spark, sf), "page_id", "url")


def pagination(spark, sf):
    df = _sites(spark, sf).withColumn("pagination", d.detect_pagination())
    return df.select("page_id", "pagination.kind", "pagination.param", "pagination.counts")


def further_pages(spark, sf):
    df = _sites(spark, sf).withColumn("pagination", d.detect_pagination())
    return d.page_urls(df, "page_id", "url", 3)


def directories(spark, sf):
    return _sites(spark, sf).select("page_id", d.looks_like_directory().alias("directory"), d.estimate_members().alias("members"))


def page_types(spark, sf):
    return d.classify_page(_sites(spark, sf), "url").select("page_id", "page_type", "confidence", "extractor")


def linked_firms(spark, sf):
    return p.external_members(_sites(spark, sf), "page_id", "url")


def robots(spark, sf):
    """Hosts of even nations forbid their member pages; those of the others have no robots.txt."""
    sites = frame(spark, sf, "sites")
    texts = sites.filter("nation % 2 = 0").select(d.host(c("url")).alias("host")).distinct().withColumn("robots_txt", F.lit("User-agent: *\nDisallow: /members\nCrawl-delay: 3\nSitemap: https://a.org/map.xml"))
    out = d.robots_verdict(sites.select("page_id", "url"), texts, "url")
    return out.select("page_id", "allowed", "crawl_delay", F.array_join("sitemaps", ",").alias("sitemaps"))


def company_facts(spark, sf):
    facts, found = p.about_facts(c("text")), p.systems_from_text(c("text"))
    return frame(spark, sf, "statements").select("company_id", facts["employees"].alias("employees"), facts["founded"].alias("founded"), facts["revenue"].alias("revenue"), found["erp"].alias("erp"), found["crm"].alias("crm"))


_J = "CASE WHEN s_suppkey % 2 = 0 THEN ' Inc' ELSE '' END"
_RIVALS = f"rivals AS (SELECT s_suppkey AS k, ([{', '.join(_quote(n.title()) for n in tables.COMPETITORS)}])[s_suppkey % {len(tables.COMPETITORS)} + 1] || {_J} AS name, CASE s_suppkey % 7 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END AS level, CASE s_suppkey % 3 WHEN 0 THEN 'FABTECH, PACK EXPO' WHEN 1 THEN 'IMTS BOOTH' ELSE 'NPE' END AS presence FROM supplier)"
_SHARES = "greatest(tech_maturity / 25, tech_gap / 15, assoc_engagement / 15, size_fit / 20, geo_fit / 15)"
_TOP1 = f"CASE {_SHARES} WHEN tech_maturity / 25 THEN 'tech_maturity' WHEN tech_gap / 15 THEN 'tech_gap' WHEN assoc_engagement / 15 THEN 'assoc_engagement' WHEN size_fit / 20 THEN 'size_fit' ELSE 'geo_fit' END"
_TOP2 = f"CASE {_SHARES} WHEN tech_maturity / 25 THEN 'tech_maturity' WHEN size_fit / 20 THEN 'size_fit' WHEN geo_fit / 15 THEN 'geo_fit' WHEN tech_gap / 15 THEN 'tech_gap' ELSE 'assoc_engagement' END"
_IN = lambda name, lists: "CASE lower(competitor) " + " ".join(f"WHEN {_quote(n)} THEN " + " OR ".join(f"contains({name}, {_quote(a)})" if not lists else f"len(list_filter({name}, lambda x: contains(x, {_quote(a)}))) > 0" for a in al) for n, al in tables.COMPETITORS.items()) + " ELSE false END"
_RUNS = "runs AS (SELECT o_orderkey AS job_id, 'A' || (o_orderkey % 7) AS association, o_orderkey % 50 AS total, o_orderkey % 50 - o_orderkey % 3 AS done, date_trunc('day', o_orderdate)::TIMESTAMP AS started_at, CASE WHEN o_orderkey % 4 <> 0 THEN date_trunc('day', o_orderdate)::TIMESTAMP + to_minutes((o_orderkey % 500)::INT) END AS completed_at, o_orderkey % 7 <> o_custkey % 9 AS success FROM orders)"
_MAT = "CASE WHEN contains(lower(cms), 'drupal') THEN 10 WHEN contains(lower(cms), 'wordpress') THEN 8 WHEN contains(lower(cms), 'wix') THEN 6 WHEN cms <> '' THEN 4 ELSE 0 END + CASE WHEN list_contains(tech, 'google analytics') THEN CASE WHEN list_contains(tech, 'google tag manager') THEN 8 ELSE 6 END ELSE 0 END + CASE WHEN list_contains(tech, 'cloudflare') THEN 20 ELSE 0 END + CASE WHEN list_contains(tech, 'jquery') THEN 6 ELSE 0 END + CASE WHEN list_has_any(spf, ['hubspot', 'marketo', 'pardot']) THEN 20 WHEN list_has_any(spf, ['mailchimp', 'sendgrid']) THEN 10 ELSE 0 END"
_CATEGORY = "CASE " + " ".join(f"WHEN technology IN ({', '.join(map(_quote, v))}) THEN {_quote(k)}" for k, v in i.CATEGORIES.items()) + " ELSE 'Other' END"
_ENT = f"e AS (SELECT company_id AS k, {DOMAIN_SQL} AS domain, CASE WHEN length(regexp_replace(phone, '[^0-9]', '', 'g')) >= 10 THEN right(regexp_replace(phone, '[^0-9]', '', 'g'), 10) ELSE '' END AS phone FROM companies)"
_BASE = "CASE k % 4 WHEN 0 THEN 'https://assoc' || n || '.org/' WHEN 1 THEN 'https://assoc' || n || '.org/events/' WHEN 2 THEN 'https://assoc' || n || '.org/pages/' ELSE 'https://assoc' || n || '.org/' END"
_SITE = "s AS (SELECT c_custkey AS k, c_nationkey AS n FROM customer)"

QUERIES = {
    "search_page": (search_page, with_frames("SELECT company_id, quality_score FROM companies WHERE state = 'OH' AND quality_score >= 40 ORDER BY quality_score DESC, company_id LIMIT 25 OFFSET 5", "companies")),
    "quality_gate": (gated, with_frames("SELECT company_id, quality_score FROM companies WHERE quality_score >= 60", "companies")),
    "company_contract": (full_contract, with_frames("SELECT company_id, 'company_name missing' AS violation FROM companies WHERE company_id % 70 = 0 UNION ALL SELECT company_id, 'website without scheme' FROM companies WHERE company_id % 6 = 1 AND website <> '' UNION ALL SELECT company_id, 'employee_count_max below min' FROM companies WHERE (company_id % 9 = 2 AND employee_count_min > 1) OR (company_id % 9 <> 2 AND employee_count_max > 0 AND employee_count_max < employee_count_min) UNION ALL SELECT company_id, 'quality_score out of range' FROM companies WHERE company_id % 50 = 0 UNION ALL SELECT company_id, 'email without @' FROM companies WHERE company_id % 8 = 3 AND email <> ''", "companies")),
    "provenance_gaps": (provenance, with_frames("SELECT company_id, 'source_url' AS missing FROM companies WHERE company_id % 5 <> 0 AND (company_id % 3 = 0 OR coalesce(website, '') = '') UNION ALL SELECT company_id, 'extracted_at' FROM companies WHERE company_id % 5 <> 0 AND company_id % 4 = 0", "companies")),
    "missing_labels": (missing_labels, with_frames("SELECT company_id, 'erp_system' AS missing FROM companies WHERE erp_system = '' UNION ALL SELECT company_id, 'membership_tier' FROM companies WHERE membership_tier = '' UNION ALL SELECT company_id, 'naics_code' FROM companies WHERE naics_code = ''", "companies")),
    "lookups": (lookups, with_frames("SELECT 'domain' AS what, company_id FROM companies WHERE regexp_matches(website, '^https?://(www\\.)?firm9\\.com(/|$)') UNION ALL SELECT 'sponsor', company_id FROM participants WHERE event_id = 7 AND kind = 'SPONSOR'", "companies", "participants")),
    "phone_work": (phone_work, with_frames("SELECT company_id, CASE WHEN phone IS NULL AND city = '' THEN 0 WHEN phone IS NULL THEN 1 ELSE 2 END AS priority FROM companies WHERE phone IS NULL OR city = ''", "companies")),
    "entity_pairs": (entity_pairs, None),
    "duplicate_stats": (duplicate_stats, None),
    "tech_found": (tech_found, with_frames(f"WITH x AS (SELECT company_id AS k, nullif({DOMAIN_SQL}, '') AS dom, nullif(erp_system, '') AS erp FROM companies) SELECT k AS company_id, CASE WHEN erp IS NOT NULL THEN erp WHEN dom IS NOT NULL AND k % 4 = 0 THEN 'SAP' WHEN k % 9 = 0 THEN 'Plex' END AS erp_system, CASE WHEN erp IS NOT NULL THEN NULL WHEN dom IS NOT NULL AND k % 4 = 0 THEN 'website' WHEN k % 3 = 0 THEN 'job_postings' END AS tech_source FROM x", "companies")),
    "found_contacts": (found_contacts, with_frames("WITH p AS (SELECT *, 0 AS r, 'apollo' AS provider FROM contacts WHERE contact_id % 2 = 0 UNION ALL SELECT *, 1, 'website' FROM contacts WHERE contact_id % 3 = 0 UNION ALL SELECT *, 2, 'hunter' FROM contacts), f AS (SELECT p.*, row_number() OVER (PARTITION BY p.company_id, coalesce(lower(p.email), 'name:' || lower(p.name)) ORDER BY r, contact_id) AS n FROM p JOIN companies k ON k.company_id = p.company_id AND k.n_contacts = 0), t AS (SELECT *, CASE title WHEN 'Chief Executive Officer' THEN 2 WHEN 'Activity Coordinator' THEN 1 WHEN 'Plant Manager' THEN 3 WHEN 'Owner' THEN 2 WHEN 'VP of Finance' THEN 999 WHEN 'IT Manager' THEN 999 WHEN 'Intern' THEN 999 ELSE 999 END AS q FROM f WHERE n = 1), w AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY q, r, contact_id, name) AS rank FROM t WHERE q < 999) SELECT company_id, rank::INT AS rank, provider, name, title, email FROM w WHERE rank <= 3", "companies", "contacts")),
    "contacts_upserted": (contacts_upserted, with_frames("WITH o AS (SELECT company_id, lower(email) AS email, min(contact_id) AS contact_id, arg_min(title, contact_id) AS title FROM contacts WHERE email IS NOT NULL GROUP BY 1, 2), t AS (SELECT * FROM o WHERE contact_id % 4 < 3), b AS (SELECT company_id, lower(email) AS email, max(contact_id) + 10000000 AS contact_id, 'New ' || arg_max(title, contact_id) AS title FROM contacts WHERE email IS NOT NULL AND contact_id % 2 = 0 GROUP BY 1, 2) SELECT coalesce(t.contact_id, b.contact_id) AS contact_id, company_id, email, coalesce(b.title, t.title) AS title FROM t FULL JOIN b USING (company_id, email)", "contacts")),
    "detection_sources": (detection_sources, with_frames(ICP_HEAD + f"SELECT company_id, competitor, CASE WHEN competitor = '' THEN NULL WHEN {_IN('erp', False)} THEN 'erp_system' WHEN {_IN('tech', True)} THEN 'tech_stack' WHEN {_IN('spf', True)} THEN 'spf_services' ELSE 'tech_stack' END AS source FROM icp", "companies")),
    "recommendations": (recommendations, with_frames(ICP_HEAD + f""", r AS (SELECT *, {_TOP1} AS t1, {_TOP2} AS t2 FROM icp) SELECT company_id,
  CASE WHEN competitor <> '' THEN 'Competitive Displacement' WHEN t1 = 'tech_maturity' THEN CASE WHEN contains(ep, 'microsoft') THEN 'Microsoft Ecosystem' WHEN ep IN ('self-hosted', 'other') THEN 'Legacy Transformation' ELSE 'Tech Modernization' END WHEN t1 = 'tech_gap' AND tech_gap >= 12 THEN 'Greenfield ERP' WHEN t1 = 'assoc_engagement' AND assoc_engagement >= 10 THEN 'Association Blitz' ELSE 'Multi-touch Nurture' END AS campaign,
  CASE WHEN competitor <> '' THEN 'Competitive displacement — lead with migration from ' || competitor WHEN t2 = 'tech_gap' AND tech_gap >= 12 THEN 'Greenfield ERP opportunity — lead with first-ERP value story' WHEN t2 = 'tech_maturity' AND contains(ep, 'microsoft') THEN 'ABM 1:1 — Microsoft ecosystem modernization, Dynamics displacement angle' WHEN t2 = 'tech_maturity' AND ep = 'self-hosted' THEN 'Digital transformation — legacy IT modernization campaign' WHEN t2 = 'size_fit' AND size_fit >= 18 THEN 'ABM 1:1 — perfect mid-market fit, personalized executive outreach' WHEN t2 = 'assoc_engagement' AND assoc_engagement >= 12 THEN 'Association-centric — leverage peer trust and event presence' WHEN t2 = 'geo_fit' AND geo_fit >= 12 THEN 'Regional campaign — local manufacturing cluster outreach' ELSE 'ABM 1:few — multi-touch nurture sequence' END AS approach FROM r""", "companies")),
    "event_threats": (event_threats, with_frames(f"WITH {_RIVALS}, v AS (SELECT event_id, (['FABTECH', 'IMTS', 'PACK EXPO', 'NPE', 'none'])[event_id % 5 + 1] AS show, event_id % 3 AS prio, event_id % 2 = 0 AS quiet FROM trade_events), x AS (SELECT v.*, coalesce((SELECT bool_or(contains(presence, v.show)) FROM rivals WHERE level = 'HIGH'), false) AS high, coalesce((SELECT bool_or(contains(presence, v.show)) FROM rivals WHERE level = 'MEDIUM'), false) AS mid FROM v) SELECT event_id, CASE WHEN high THEN 'HIGH' WHEN mid THEN 'MEDIUM' ELSE 'LOW' END AS threat, CASE prio WHEN 0 THEN CASE WHEN high THEN 'SPONSOR' ELSE 'EXHIBIT' END WHEN 1 THEN 'ATTEND' ELSE 'SKIP' END AS recommendation, CASE prio WHEN 0 THEN CASE WHEN high THEN '$$$' ELSE '$$' END WHEN 1 THEN '$' ELSE 'Free' END AS budget, (['High', 'Medium', 'Low'])[prio + 1] AS roi FROM x", "trade_events")),
    "competitor_accounts": (competitor_accounts, with_frames(ICP_HEAD + f", {_RIVALS}, q1 AS (SELECT DISTINCT name FROM rivals), f1 AS (SELECT DISTINCT competitor FROM icp WHERE competitor <> ''), h1 AS (SELECT name, first(competitor ORDER BY name <> competitor, competitor) AS competitor FROM q1 JOIN f1 ON contains(lower(name), lower(competitor)) OR contains(lower(competitor), lower(name)) GROUP BY name), n1 AS (SELECT competitor, count(*) AS companies FROM icp GROUP BY 1), a1 AS (SELECT competitor, a, count(*) AS n FROM (SELECT competitor, unnest(assoc) AS a FROM icp) GROUP BY 1, 2), b1 AS (SELECT *, row_number() OVER (PARTITION BY competitor ORDER BY n DESC, a) AS r FROM a1), l1 AS (SELECT competitor, string_agg(a, '; ' ORDER BY r) AS associations FROM b1 WHERE r <= 3 GROUP BY 1) SELECT name, coalesce(companies, 0) AS companies, coalesce(associations, '') AS associations FROM q1 LEFT JOIN h1 USING (name) LEFT JOIN n1 USING (competitor) LEFT JOIN l1 USING (competitor)", "companies")),
    "competitor_rows": (competitor_rows, with_frames(ICP_HEAD + "SELECT competitor, company_id, icp_score FROM icp WHERE competitor <> '' ORDER BY 1, 3 DESC, 2", "companies")),
    "job_progress": (job_progress, f"WITH {_RUNS} SELECT job_id, CASE WHEN total > 0 THEN round(100.0::DOUBLE * done / total, 1) ELSE 0 END::DOUBLE AS progress_percent, date_diff('second', started_at, coalesce(completed_at, TIMESTAMP '2030-01-01')) AS duration_seconds FROM runs"),
    "run_errors": (run_errors, f"WITH {_RUNS} SELECT association, count(*) AS runs, count(*) FILTER (NOT success) AS failed, round(avg(CASE WHEN success THEN 0.0 ELSE 1.0 END)::DOUBLE, 6) AS error_rate, avg(CASE WHEN success THEN 0.0 ELSE 1.0 END) > 0.1 AS failing FROM runs GROUP BY ROLLUP (association)"),
    "phase_totals": (phase_totals, "SELECT user_id AS job_id, event_type AS phase, count(*) AS runs, sum(60 * (event_id % 90))::BIGINT AS seconds, max(event_id % 200) AS pages, max(event_id % 30) AS companies FROM events GROUP BY 1, 2"),
    "tech_adoption": (tech_adoption, with_frames(f"WITH x AS (SELECT unnest({_LIST.format('tech_stack')}) AS technology FROM companies), n AS (SELECT technology, count(*) AS n FROM x GROUP BY 1) SELECT technology, n, round(100.0::DOUBLE * n / greatest((SELECT count(*) FILTER (len({_LIST.format('tech_stack')}) > 0 OR cms <> '' OR email_provider <> '') FROM companies), 1), 4) AS pct, {_CATEGORY} AS category FROM n", "companies")),
    "cms_adoption": (cms_adoption, with_frames("SELECT cms, n, CASE WHEN n >= 100 THEN 'Dominant' WHEN n >= 30 THEN 'Common' WHEN n >= 10 THEN 'Niche' ELSE 'Rare' END AS adoption FROM (SELECT cms, count(*) AS n FROM companies WHERE cms <> '' GROUP BY 1)", "companies")),
    "maturity_summary": (maturity_summary, with_frames(ICP_HEAD + f", k AS (SELECT *, CASE WHEN len(tech) = 0 AND cms = '' THEN 'Unknown' WHEN {_MAT} >= 70 THEN 'Modern' WHEN {_MAT} >= 40 THEN 'Transitional' ELSE 'Legacy' END AS tech_tier FROM icp), a AS (SELECT tech_tier, a, count(*) AS n FROM (SELECT tech_tier, unnest(assoc) AS a FROM k) GROUP BY 1, 2), b AS (SELECT tech_tier, first(a ORDER BY n DESC, a) AS a FROM a GROUP BY 1) SELECT tech_tier, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM k), 4) AS pct, round(avg(icp_score), 4) AS avg_icp, coalesce(any_value(b.a), '') AS top_association FROM k LEFT JOIN b USING (tech_tier) GROUP BY 1", "companies")),
    "grade_vs_icp": (grade_vs_icp, with_frames(SCORED_HEAD + ", " + ICP_HEAD[5:] + "SELECT letter, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM scored), 4) AS pct, round(avg(icp_score), 4) AS avg_icp FROM (SELECT company_id, letter FROM scored) JOIN (SELECT company_id, icp_score FROM icp) USING (company_id) GROUP BY 1", "companies")),
    "updated_graph": (updated_graph, with_frames("SELECT 'company' AS kind, count(*) AS n FROM companies WHERE company_id % 2 = 0 OR company_id % 3 = 0 UNION ALL SELECT 'renamed', count(*) FROM companies WHERE company_id % 3 = 0 UNION ALL SELECT 'association', count(DISTINCT association) FROM memberships UNION ALL SELECT 'event', count(DISTINCT event_id) FROM trade_events UNION ALL SELECT 'competitor', count(DISTINCT competitor) FROM signals UNION ALL SELECT 'edges', (SELECT count(*) FROM (SELECT DISTINCT association, company_id FROM memberships)) + (SELECT count(*) FROM trade_events) + (SELECT count(*) FROM (SELECT DISTINCT event_id, company_id, kind FROM participants)) + (SELECT count(*) FROM (SELECT DISTINCT company_id, competitor FROM signals))", "companies", "memberships", "trade_events", "participants", "signals")),
    "member_links": (member_links, f"WITH {_SITE} SELECT k AS page_id, unnest(['https://assoc' || n || '.org/member/' || k, {_BASE} || 'profile-' || k || '.html', {_BASE} || 'card?id=' || k, 'https://assoc' || n || '.org/row/' || k]) AS member_url FROM s"),
    "pagination": (pagination, f"WITH {_SITE} SELECT k AS page_id, (['query', 'path', 'more', 'query', 'none'])[k % 5 + 1] AS kind, CASE k % 5 WHEN 0 THEN 'page' WHEN 3 THEN 'offset' END AS param, CASE k % 5 WHEN 0 THEN 'page' WHEN 3 THEN 'offset' END AS counts FROM s"),
    "further_pages": (further_pages, f"WITH {_SITE}, u AS (SELECT k, 'https://assoc' || n || '.org' || (['/members', '/events/', '/pages/list.html', '/sponsors'])[k % 4 + 1] AS url FROM s), g AS (SELECT *, unnest([1, 2, 3]) AS page FROM u) SELECT k AS page_id, page, CASE k % 5 WHEN 0 THEN url || '?page=' || page WHEN 3 THEN url || '?offset=' || (page - 1) * 100 WHEN 1 THEN rtrim(url, '/') || '/page/' || page ELSE url END AS page_url FROM g WHERE k % 5 IN (0, 1, 3) OR page = 1"),
    "directories": (directories, f"WITH {_SITE} SELECT k AS page_id, true AS directory, CASE WHEN k % 300 >= 10 THEN k % 300 ELSE 0 END::INT AS members FROM s"),
    "page_types": (page_types, f"WITH {_SITE} SELECT k AS page_id, (['MEMBER_DIRECTORY', 'EVENTS_LIST', 'OTHER', 'SPONSORS_LIST'])[k % 4 + 1] AS page_type, ([0.98, 0.98, 0.2, 0.98])[k % 4 + 1]::DOUBLE AS confidence, (['extraction.directory_parser', 'extraction.event_extractor', NULL, 'extraction.event_participant_extractor'])[k % 4 + 1] AS extractor FROM s"),
    "linked_firms": (linked_firms, f"WITH {_SITE} SELECT k AS page_id, 'firm' || k || '.com' AS host, 'Firm ' || k AS name, 'http://firm' || k || '.com/x' AS website FROM s UNION ALL SELECT k, 'other.org', 'Elsewhere', 'https://other.org/member/9' FROM s"),
    "robots_verdicts": (robots, f"WITH {_SITE} SELECT k AS page_id, NOT (n % 2 = 0 AND k % 4 = 0) AS allowed, CASE WHEN n % 2 = 0 THEN 3.0::DOUBLE END AS crawl_delay, CASE WHEN n % 2 = 0 THEN 'https://a.org/map.xml' ELSE '' END AS sitemaps FROM s"),
    "company_facts": (company_facts, "SELECT c_custkey AS company_id, CASE c_custkey % 4 WHEN 0 THEN nullif(c_custkey, 0) WHEN 1 THEN c_custkey + 20 WHEN 2 THEN CASE WHEN c_custkey < 1000 THEN c_custkey ELSE (c_custkey % 1000) END END AS employees, CASE c_custkey % 3 WHEN 0 THEN 1850 + c_custkey % 150 WHEN 1 THEN 1900 + c_custkey % 100 END::INT AS founded, CASE c_custkey % 5 WHEN 0 THEN (1 + c_custkey % 90) * 1000000 + 500000 WHEN 1 THEN CASE WHEN 50000 + c_custkey >= 100000 THEN 50000 + c_custkey END END::BIGINT AS revenue, CASE c_custkey % 6 WHEN 0 THEN 'Epicor' WHEN 2 THEN 'Sage' WHEN 4 THEN 'Global Shop Solutions' WHEN 5 THEN 'SAP' END AS erp, CASE c_custkey % 6 WHEN 1 THEN 'Salesforce' END AS crm FROM customer"),
}
