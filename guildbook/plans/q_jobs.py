"""Queries of postings, providers' answers and team pages, each with SQL written by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from guildbook.functions import schemas
from guildbook.operators import event_pages as ep
from guildbook.operators import jobs as jb
from guildbook.operators import payloads as pl
from guildbook.operators import participants as pa
from guildbook.operators import people as pe
from guildbook.operators import schema as sc
from guildbook.plans.frames import frame, with_frames

c = F.col


def erp_mentions(spark, sf):
    return jb.job_mentions(frame(spark, sf, "postings"), "company_id", "job_id")


def erp_vendors(spark, sf):
    return jb.primary_vendor(frame(spark, sf, "postings"), "company_id", "job_id")


def posted_systems(spark, sf):
    return jb.job_tech(frame(spark, sf, "postings"), "company_id", "job_id")


def hiring_titles(spark, sf):
    return jb.hiring_titles(frame(spark, sf, "postings"), "company_id", "job_id")


def job_cards(spark, sf):
    return jb.job_cards(frame(spark, sf, "result_pages"), "page_id")


def provider_firmographics(spark, sf):
    raw = frame(spark, sf, "payloads")
    rows = [pl.firmographics(raw.filter(c("provider") == p), "company_id", "raw", p) for p in ("clearbit", "apollo", "zoominfo")]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def provider_technologies(spark, sf):
    rows = pl.technologies(frame(spark, sf, "payloads").filter("provider = 'builtwith'"), "company_id", "raw")
    return rows.withColumn("tech_stack", F.concat_ws("|", "tech_stack"))


def provider_people(spark, sf):
    raw = frame(spark, sf, "payloads")
    return pl.provider_contacts(raw.filter("provider = 'apollo_people'"), "company_id", "raw", "apollo").unionByName(pl.provider_contacts(raw.filter("provider = 'hunter'"), "company_id", "raw", "hunter"))


def team_people(spark, sf):
    people = pe.extract_people(frame(spark, sf, "team_pages"), "page_id")
    return people.withColumn("titled", jb.looks_like_title(c("title")))


def event_participants(spark, sf):
    return pa.extract_participants(frame(spark, sf, "event_pages"), "page_id", "url", "page_type")


def profile_records(spark, sf):
    return sc.extract_by_schema(frame(spark, sf, "profiles").filter("page_id % 3 <> 2"), "page_id", schemas.DEFAULT)


def listed_records(spark, sf):
    pages = frame(spark, sf, "profiles").filter("page_id % 3 = 2")
    return sc.extract_by_schema(pages, "page_id", sc.extended(schemas.PMA, schemas.DEFAULT), item=schemas.PMA_ITEM).select("page_id", "turn", "company_name", "city", "state", "country", "profile_url", "member_id")


def page_events(spark, sf):
    events = ep.extract_events(frame(spark, sf, "event_sites"), "page_id", "url", "page_type")
    return events.withColumns({name: c(name).cast("string") for name in ("start_date", "end_date")})


#: What the eight texts of the postings hold, told by hand: number of the text, vendor, word, its turn in the table, places.
_HELD = """held(i, vendor, keyword, turn, n) AS (VALUES (0, 'epicor', 'epicor', 0, 3), (0, 'epicor', 'epicor kinetic', 1, 1), (0, 'epicor', 'epicor erp', 4, 1), (1, 'oracle', 'jd edwards', 12, 1), (1, 'netsuite', 'netsuite', 16, 2),
  (1, 'netsuite', 'oracle netsuite', 17, 1), (3, 'infor', 'infor visual', 22, 1), (3, 'visual manufacturing', 'infor visual', 53, 1), (4, 'sage', 'sage 100', 34, 2), (4, 'plex', 'plex erp', 32, 1),
  (6, 'e2 shop system', 'e2 shop', 54, 1), (6, 'shoptech', 'shoptech', 56, 1), (6, 'shoptech', 'e2 shop system', 57, 1))"""
_J = f"WITH {_HELD}, h AS (SELECT p.*, vendor, keyword, turn, n, lower(title || ' ' || snippet) AS t, strpos(lower(title || ' ' || snippet), keyword) AS pos FROM postings p JOIN held ON i = job_id % 8)"
_CONTEXT = "'...' || trim(substr(t, greatest(1, pos - 60), pos + length(keyword) + 60 - greatest(1, pos - 60))) || '...'"
_SYSTEMS = "VALUES (0, 'crm', 'salesforce'), (1, 'cad', 'solidworks'), (1, 'cad', 'mastercam'), (2, 'bi', 'power bi'), (2, 'bi', 'tableau'), (5, 'quality', 'qms'), (5, 'warehouse', 'wms'), (7, 'plm', 'windchill'), (7, 'plm', 'ptc windchill')"

QUERIES = {
    "erp_mentions": (erp_mentions, with_frames(_J + f", f AS (SELECT company_id, vendor, keyword, title, arg_min({_CONTEXT}, job_id) AS context, min(job_id) AS job, min(turn) AS turn FROM h GROUP BY 1, 2, 3, 4), r AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY job, turn, title)::INT AS rank FROM f) SELECT company_id, rank, vendor, keyword, title AS job_title, context FROM r WHERE rank <= 15", "postings")),
    "erp_vendors": (erp_vendors, with_frames(_J + ", s AS (SELECT company_id, vendor, sum(n)::BIGINT AS mentions, min(job_id * 100 + turn) AS met FROM h GROUP BY 1, 2) SELECT company_id, vendor, mentions FROM s QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY mentions DESC, met) = 1", "postings")),
    "posted_systems": (posted_systems, with_frames(f"WITH s(i, category, keyword) AS ({_SYSTEMS}) SELECT DISTINCT company_id, category, keyword FROM postings JOIN s ON i = job_id % 8", "postings")),
    "hiring_titles": (hiring_titles, with_frames("WITH f AS (SELECT company_id, title, min(job_id) AS job FROM postings GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY job)::INT AS rank FROM f) SELECT company_id, rank, title FROM r WHERE rank <= 20", "postings")),
    "job_cards": (job_cards, """SELECT k AS page_id, 0 AS turn, 'Planner ' || k AS title, 'Firm ' || k AS employer, 'Akron, OH' AS location, 'Runs the plan daily' AS snippet, '3 days ago' AS posted, '$' || k || ' an hour' AS salary, k % 2 = 0 AS urgent FROM (SELECT c_custkey AS k FROM customer) WHERE k % 4 <> 3
UNION ALL SELECT k, 1, 'Welder', 'Short ' || k, '', '', '', CASE WHEN k % 3 = 0 THEN 'by shift' ELSE '' END, false FROM (SELECT c_custkey AS k FROM customer) WHERE k % 4 <> 3"""),
    "provider_firmographics": (provider_firmographics, """WITH s AS (SELECT c_custkey AS k FROM customer)
SELECT k AS company_id, k AS employee_count_min, k AS employee_count_max, CASE k % 3 WHEN 0 THEN k * 1000000 + 500000 WHEN 1 THEN k * 1000 END::BIGINT AS revenue_min_usd, (1900 + k % 100)::INT AS year_founded, '3327' AS naics_code, 'Metal' AS industry, CASE WHEN k % 2 = 0 THEN 'https://linkedin.com/company/firm' || k END AS linkedin_url, 'clearbit' AS firmographic_source FROM s WHERE k % 5 = 0
UNION ALL SELECT k, k, k, NULL, NULL, NULL, 'Tools', 'https://linkedin.com/company/a' || k, 'apollo' FROM s WHERE k % 5 = 1
UNION ALL SELECT k, k, k, CASE WHEN k % 2 = 0 THEN 12500000 ELSE 0 END, 1950, '3328', NULL, NULL, 'zoominfo' FROM s WHERE k % 5 = 2"""),
    "provider_technologies": (provider_technologies, """SELECT k AS company_id, CASE WHEN k % 2 = 0 THEN 'nginx|Epicor|HubSpot|Plex' ELSE '' END AS tech_stack, CASE WHEN k % 2 = 0 THEN 'Plex' END AS erp_system, CASE WHEN k % 2 = 0 THEN 'HubSpot' END AS crm_system, 'builtwith' AS tech_source FROM (SELECT c_custkey AS k FROM customer) WHERE k % 5 = 3"""),
    "provider_people": (provider_people, """WITH s AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 5 = 4)
SELECT k AS company_id, 0 AS turn, 'Pat ' || k AS name, 'Owner' AS title, 'pat@f.com' AS email, '555-' || k AS phone, NULL::VARCHAR AS linkedin_url, 'apollo' AS source FROM s WHERE k % 2 = 0 UNION ALL SELECT k, 1, 'Lee', NULL, NULL, NULL, 'https://linkedin.com/in/lee', 'apollo' FROM s WHERE k % 2 = 0
UNION ALL SELECT k, 0, 'Kim Roy', 'CFO', 'kim@f.com', NULL, NULL, 'hunter' FROM s WHERE k % 2 = 1 UNION ALL SELECT k, 1, NULL, NULL, 'info@f.com', '5551234567', NULL, 'hunter' FROM s WHERE k % 2 = 1"""),
    "team_people": (team_people, """WITH s AS (SELECT c_custkey AS k FROM customer)
SELECT k AS page_id, 0 AS turn, 'Ann Lee' AS name, 'Plant Manager' AS title, 'ann' || k || '@firm.com' AS email, '+13305550100' AS phone, 'https://www.linkedin.com/in/ann' AS linkedin_url, true AS titled FROM s WHERE k % 3 = 0
UNION ALL SELECT k, 1, 'Bo Ray', NULL, NULL, NULL, NULL, false FROM s WHERE k % 3 = 0
UNION ALL SELECT k, 0, 'Cy Fox', 'Vice President of Sales', NULL, NULL, NULL, true FROM s WHERE k % 3 = 1
UNION ALL SELECT k, 0, 'Dee Day', 'Chief Engineer', NULL, NULL, NULL, true FROM s WHERE k % 3 = 2"""),
    "event_participants": (event_participants, """WITH s AS (SELECT c_custkey AS k, 'https://show' || c_nationkey || '.org' AS b FROM customer)
SELECT k AS page_id, 'SPONSOR' AS kind, 'GOLD' AS tier, 'Firm ' || k AS company_name, 'https://firm' || k || '.com' AS website, NULL::VARCHAR AS booth, NULL::VARCHAR AS category, NULL::VARCHAR AS speaker, NULL::VARCHAR AS title, NULL::VARCHAR AS topic FROM s WHERE k % 5 = 0
UNION ALL SELECT k, 'SPONSOR', 'GOLD', 'Other Firm', b || '/away', NULL, NULL, NULL, NULL, NULL FROM s WHERE k % 5 = 0
UNION ALL SELECT k, 'SPONSOR', 'SILVER', 'Silver Firm', b || '/event/s.html', NULL, NULL, NULL, NULL, NULL FROM s WHERE k % 5 = 0
UNION ALL SELECT k, 'EXHIBITOR', NULL, 'Firm ' || k, NULL, (100 + k % 900)::VARCHAR, 'Metal', NULL, NULL, NULL FROM s WHERE k % 5 = 1
UNION ALL SELECT k, 'EXHIBITOR', NULL, 'Bolts', 'http://b.com', 'B12', NULL, NULL, NULL, NULL FROM s WHERE k % 5 = 1
UNION ALL SELECT k, 'EXHIBITOR', NULL, 'Item ' || k, NULL, k::VARCHAR, 'Tools', NULL, NULL, NULL FROM s WHERE k % 5 = 2
UNION ALL SELECT k, 'SPEAKER', NULL, 'Firm ' || k, NULL, NULL, NULL, 'Ann Lee', 'Head of Sales', 'Steel' FROM s WHERE k % 5 = 3
UNION ALL SELECT k, 'SPEAKER', NULL, 'Unknown', NULL, NULL, NULL, 'Bo Ray', NULL, NULL FROM s WHERE k % 5 = 3"""),
    "profile_records": (profile_records, """SELECT k AS page_id, 0 AS turn, 'Firm' || k AS company_name, 'https://facebook.com/f' AS website, 'New York' AS city, 'OH' AS state, 'United States' AS country, '3305550100' AS phone, 'mailto:info@firm.com' AS email, 'Gold' AS membership_tier, '1987' AS member_since, NULL::VARCHAR AS description
FROM (SELECT c_custkey AS k FROM customer) WHERE k % 3 = 0 OR k % 3 = 1 AND k % 2 = 1"""),
    "listed_records": (listed_records, """WITH s AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 = 2)
SELECT k AS page_id, 0 AS turn, 'Firm ' || k AS company_name, 'Akron' AS city, 'OH' AS state, 'United States' AS country, '/profile.asp?id=' || k AS profile_url, k::VARCHAR AS member_id FROM s UNION ALL SELECT k, 2, 'Second', NULL, NULL, 'United States', NULL, NULL FROM s"""),
    "page_events": (page_events, """WITH s AS (SELECT c_custkey AS k, 'https://show' || c_nationkey || '.org/' AS b FROM customer)
SELECT k AS page_id, 0 AS turn, 'Expo ' || k AS title, 'TRADE_SHOW' AS event_type, '2025-03-04' AS start_date, '2025-03-06' AS end_date, 'Hall 1' AS venue, 'Akron' AS city, 'OH' AS state, 'US' AS country, false AS virtual, b || 'events/x.html' AS event_url, b || 'join' AS registration_url FROM s WHERE k % 4 = 0
UNION ALL SELECT k, 0, 'Welding Workshop ' || k, 'WORKSHOP', '2025-03-04', '2025-03-06', NULL, 'Toledo', 'OH', 'United States', false, b || 'events/x.html', NULL FROM s WHERE k % 4 = 1
UNION ALL SELECT k, 0, 'Steel Summit', 'CONFERENCE', '2025-05-02', NULL, 'Online', NULL, NULL, 'United States', true, b || 'events/s' || k || '.html', NULL FROM s WHERE k % 4 = 2
UNION ALL SELECT k, 1, 'Annual Dinner', 'OTHER', NULL, NULL, NULL, NULL, NULL, 'United States', false, b || 'two', NULL FROM s WHERE k % 4 = 2"""),
}
