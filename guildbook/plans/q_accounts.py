"""Queries of account joins, with independent SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from guildbook.functions import text as t
from guildbook.operators import accounts as a
from guildbook.plans.frames import frame, with_frames
from guildbook.plans.q_reports import _icp
from guildbook.plans.q_rows import _LIST, ICP_HEAD, _quote

c = F.col
FRAGMENTS = {"PMA": ["steel", "tin"], "AGMA": ["copper"], "NEMA": ["brass", "nickel"]}
KEYWORDS = {"auto": ["PMA", "NEMA"], "machine": ["PMA", "AGMA"], "build": ["AIA"], "house": []}
_KEY = "regexp_replace(lower(company_name), '[^a-z0-9]', '', 'g')"


def registry_matches(spark, sf):
    """A registry of every third company's name, without its last letters."""
    df = frame(spark, sf, "companies")
    k = t.merge_key(c("company_name"))
    registry = df.filter("company_id % 3 = 0").select(F.when(c("company_id") % 2 == 0, k).otherwise(F.rtrim(k, F.lit("inc"))).alias("reg_key"), "company_id").groupBy("reg_key").agg(F.min("company_id").alias("cik"))
    return a.match_registry(df, registry, "company_id", "company_name")


def job_matches(spark, sf):
    df = frame(spark, sf, "companies").select("company_id", "company_name")
    jobs = frame(spark, sf, "contacts").select("company_id", c("contact_id").alias("job"), F.when(c("contact_id") % 3 == 0, "").when(c("contact_id") % 3 == 1, "Altax Precision Works").otherwise("Zeta").alias("employer"), F.lit("welder wanted").alias("snippet"))
    return a.match_jobs(df, jobs, "company_id", "company_name").select("company_id", "job")


def event_overlap(spark, sf):
    events = frame(spark, sf, "trade_events").select(c("title").alias("event_name"), c("event_id").alias("turn"))
    return a.event_overlap(frame(spark, sf, "companies"), events, FRAGMENTS, ["small"], "company_id", "associations")


def event_reach(spark, sf):
    events = frame(spark, sf, "companies").select(c("company_id").alias("event_id"), "industry")
    return a.event_reach(events, frame(spark, sf, "memberships"), KEYWORDS)


def decision_makers(spark, sf):
    return a.decision_makers(frame(spark, sf, "contacts"), "company_id", "contact_id", t.title_priority(c("title"))).select("company_id", c("turn").alias("contact_id"), "title")


def dashboard_rows(spark, sf):
    return a.dashboard_rows(_icp(spark, sf))


_TRIMS = " UNION ALL ".join([f"SELECT company_id, 0 AS turn, {_KEY} AS reg_key FROM companies"] + [f"SELECT company_id, {i}, rtrim({_KEY}, '{e}') FROM companies WHERE ends_with({_KEY}, '{e}') AND rtrim({_KEY}, '{e}') <> {_KEY}" for i, e in enumerate(a.ENDINGS, 1)])
_STOP = ", ".join(map(_quote, a.STOP_WORDS))
QUERIES = {
    "registry_matches": (registry_matches, with_frames(f"WITH r AS (SELECT CASE WHEN company_id % 2 = 0 THEN {_KEY} ELSE rtrim({_KEY}, 'inc') END AS reg_key, min(company_id) AS cik FROM companies WHERE company_id % 3 = 0 GROUP BY 1), v AS ({_TRIMS}), m AS (SELECT v.company_id, v.reg_key, r.cik, row_number() OVER (PARTITION BY v.company_id ORDER BY turn) AS i FROM v JOIN r USING (reg_key)) SELECT company_id, reg_key, cik FROM m WHERE i = 1", "companies")),
    "job_matches": (job_matches, with_frames(f"WITH j AS (SELECT company_id, contact_id AS job, CASE contact_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'altax precision works' ELSE 'zeta' END AS e FROM contacts) SELECT company_id, job FROM companies JOIN j USING (company_id) WHERE contains(e, lower(company_name)) OR contains(lower(company_name), e) OR len(list_filter(list_slice(list_filter(regexp_split_to_array(lower(company_name), '[\\s,./&\\-()]+'), lambda w: length(w) > 3 AND w NOT IN ({_STOP})), 1, 2), lambda w: contains(e, w))) > 0", "companies", "contacts")),
    "event_overlap": (event_overlap, with_frames(f"WITH c AS (SELECT company_id, {_LIST.format('associations')} AS assoc FROM companies), f AS (SELECT company_id, f FROM (SELECT company_id, unnest(assoc) AS a FROM c) JOIN (VALUES {', '.join(f'({_quote(k)}, {_quote(x)})' for k, v in FRAGMENTS.items() for x in v)}) m(k, f) ON starts_with(upper(a), k)), g AS (SELECT * FROM f UNION SELECT company_id, 'small' FROM c WHERE len(assoc) > 0 AND company_id NOT IN (SELECT company_id FROM f)), h AS (SELECT company_id, title, min(event_id) AS turn FROM g JOIN trade_events ON contains(lower(title), f) GROUP BY 1, 2) SELECT company_id, coalesce(string_agg(title, '; ' ORDER BY turn, title), '') AS events FROM companies LEFT JOIN h USING (company_id) GROUP BY 1", "companies", "trade_events")),
    "event_reach": (event_reach, with_frames("WITH k AS (SELECT association, count(DISTINCT company_id) AS members FROM memberships GROUP BY 1), n AS (SELECT DISTINCT company_id, association FROM companies JOIN (VALUES " + ", ".join(f"({_quote(k)}, {_quote(x)})" for k, v in KEYWORDS.items() for x in v) + ") m(k, association) ON contains(lower(industry), k)) SELECT c.company_id AS event_id, coalesce(sum(members), 0)::BIGINT AS reach FROM companies c LEFT JOIN n USING (company_id) LEFT JOIN k USING (association) GROUP BY 1", "companies", "memberships")),
    "decision_makers": (decision_makers, with_frames("WITH f AS (SELECT *, row_number() OVER (PARTITION BY company_id, lower(name) ORDER BY contact_id) AS i, title IN ('Chief Executive Officer', 'Activity Coordinator', 'Plant Manager', 'Owner') AS good FROM contacts), g AS (SELECT *, bool_or(good) OVER (PARTITION BY company_id) AS any_good, row_number() OVER (PARTITION BY company_id ORDER BY contact_id) AS r FROM f WHERE i = 1) SELECT company_id, contact_id, title FROM g WHERE good OR (NOT any_good AND r <= 10)", "contacts")),
    "dashboard_rows": (dashboard_rows, with_frames(ICP_HEAD + f"SELECT company_id, company_name, coalesce(trim(website), '') AS website, trim(city) AS city, trim(state) AS state, coalesce(trim(phone), '') AS phone, array_to_string(list_slice({_LIST.format('tech_stack')}, 1, 8), ';') AS tech, array_to_string(list_slice({_LIST.format('spf_services')}, 1, 6), ';') AS spf, quality_score, icp_score, tier, competitor, CASE WHEN employee_count_max > 0 THEN CASE WHEN employee_count_min > 0 THEN employee_count_min || '-' || employee_count_max ELSE '<' || employee_count_max END WHEN employee_count_min > 0 THEN employee_count_min || '+' ELSE '' END AS people FROM icp", "companies")),
}
