"""Queries of column functions, row scores and filters, each with independent SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from guildbook.functions import scores as s
from guildbook.functions import tables
from guildbook.functions import text as t
from guildbook.plans.frames import frame, with_frames

c = F.col


def _quote(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _suffix_sql(column: str, patterns: list[str]) -> str:
    for p in patterns:
        column = f"regexp_replace({column}, {_quote(p)}, '')"
    return column


_SQUEEZE = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"
_CLEAN = _SQUEEZE.format("regexp_replace({}, '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g')")
NORMAL_SQL = _CLEAN.format(_suffix_sql("lower(company_name)", tables.SUFFIXES))
DOMAIN_SQL = "CASE WHEN coalesce(website, '') = '' THEN '' ELSE regexp_replace(lower(regexp_extract(CASE WHEN regexp_matches(website, '^https?://') THEN website ELSE 'https://' || website END, '^https?://([^/?#]*)', 1)), '^www\\.', '') END"


def names(spark, sf):
    df = frame(spark, sf, "companies")
    n = c("company_name")
    return df.select("company_id", t.normalize_name(n).alias("f1"), t.deep_normalize_name(n).alias("f2"), t.normalize_name_script(n).alias("f3"), t.merge_key(n).alias("f4"), t.strip_one_suffix(n).alias("f5"))


NAMES_SQL = with_frames(
    f"""SELECT company_id, {NORMAL_SQL} AS f1,
  {_CLEAN.format("(SELECT string_agg(CASE w " + " ".join(f"WHEN {_quote(k)} THEN {_quote(v)}" for k, v in tables.ABBREVIATIONS.items()) + " ELSE w END, ' ' ORDER BY i) FROM (SELECT unnest(string_split(" + _SQUEEZE.format(_suffix_sql("trim(lower(company_name))", tables.DEEP_SUFFIXES)) + ", ' ')) AS w, generate_subscripts(string_split(" + _SQUEEZE.format(_suffix_sql("trim(lower(company_name))", tables.DEEP_SUFFIXES)) + ", ' '), 1) AS i))")} AS f2,
  {_CLEAN.format("regexp_replace(lower(trim(company_name)), '" + r"\b(inc\.?|incorporated|corp\.?|corporation|llc|l\.l\.c\.?|ltd\.?|limited|co\.?|company|plc|gmbh|ag|sa|nv|bv|holdings|group)$" + "', '')")} AS f3,
  regexp_replace(lower(company_name), '[^a-z0-9]', '', 'g') AS f4,
  lower(trim(CASE {" ".join(f"WHEN ends_with(company_name, {_quote(x)}) THEN left(company_name, length(company_name) - {len(x)})" for x in t.WRITTEN_SUFFIXES)} ELSE company_name END)) AS f5
FROM companies""",
    "companies",
)


def urls(spark, sf):
    df = frame(spark, sf, "companies")
    w = c("website")
    return df.select("company_id", t.extract_domain(w).alias("domain"), t.normalize_url(w).alias("url"), t.bare_domain(w).alias("bare"), t.last_ten(c("phone")).alias("phone10"), t.normalize_address(c("city"), c("state")).alias("address"))


URLS_SQL = with_frames(
    f"""SELECT company_id, {DOMAIN_SQL} AS domain,
  CASE WHEN coalesce(website, '') = '' THEN '' ELSE regexp_extract(website, '^(https?)://', 1) || '://' || ({DOMAIN_SQL}) || regexp_replace(regexp_extract(website, '^https?://[^/?#]*([^?#]*)', 1), '/+$', '') END AS url,
  regexp_replace(regexp_extract(coalesce(website, ''), '^(?:https?://)?([^/]*)', 1), '^www\\.', '') AS bare,
  CASE WHEN length(regexp_replace(phone, '[^0-9]', '', 'g')) >= 10 THEN right(regexp_replace(phone, '[^0-9]', '', 'g'), 10) END AS phone10,
  concat_ws(' ', nullif(lower(city), ''), nullif(lower(state), '')) AS address
FROM companies""",
    "companies",
)


def parsed_fields(spark, sf):
    """Named parsers over texts like those that pages give."""
    df = frame(spark, sf, "companies").select("company_id", F.concat(c("city"), F.lit(", "), c("state")).alias("place"), F.concat(F.lit("profile?id="), c("company_id")).alias("link"), "email", F.concat(F.lit("$"), (c("company_id") % 40).cast("string"), F.lit(".5M")).alias("money"), "employee_count_min", "employee_count_max")
    return df.select("company_id", t.parse_field(c("place"), "city").alias("city"), t.parse_field(c("place"), "state").alias("state"), t.parse_field(c("link"), "member_id").alias("member"), t.parse_field(c("email"), "email").alias("email"), t.parse_money(c("money")).alias("usd"), t.employee_label(c("employee_count_min"), c("employee_count_max")).alias("people"))


PARSED_SQL = with_frames(
    """SELECT company_id, city, left(upper(state), 2) AS state, company_id::VARCHAR AS member, nullif(lower(email), '') AS email, (company_id % 40) * 1000000 + 500000 AS usd,
  CASE WHEN coalesce(employee_count_min, 0) <> 0 AND coalesce(employee_count_max, 0) <> 0 AND employee_count_min <> employee_count_max THEN format('{:,}', employee_count_min) || '-' || format('{:,}', employee_count_max)
    WHEN coalesce(employee_count_max, 0) <> 0 THEN format('{:,}', employee_count_max) WHEN coalesce(employee_count_min, 0) <> 0 THEN format('{:,}', employee_count_min) || '+' ELSE '' END AS people
FROM companies""",
    "companies",
)


def scored(spark, sf):
    df = frame(spark, sf, "companies").withColumns({"completeness": s.completeness(), "accuracy": s.accuracy(), "freshness": s.freshness(c("days_old")), "source_reliability": s.source_reliability()})
    df = df.withColumn("score", s.quality_score()).withColumn("letter", s.grade(c("score")))
    return df.select("company_id", *[F.round(c(k), 4).alias(k) for k in ("completeness", "accuracy", "source_reliability")], c("freshness").cast("int").alias("freshness"), "score", "letter")


_V = "(CASE WHEN {} THEN 1 ELSE 0 END)"
_HAS = lambda x: f"coalesce(trim({x}), '') <> ''"
_SCORE_OF = "CASE {} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in tables.SOURCE_SCORES.items()) + " ELSE 50 END"
_NAMED = " + ".join(_V.format(x) for x in ("firmographic_source <> ''", "tech_source <> ''", "in_association"))
_SUM = " + ".join(f"(CASE WHEN {f} <> '' THEN {_SCORE_OF.format(f)} ELSE 0 END)" for f in ("firmographic_source", "tech_source")) + " + (CASE WHEN in_association THEN 60 ELSE 0 END)"
PARTS_SQL = f"""SELECT *,
  ({" + ".join(_V.format(_HAS(f)) for f in tables.REQUIRED_FIELDS)}) / 4.0 * 60 + ({" + ".join(_V.format(x) for x in ["employee_count_min IS NOT NULL", "revenue_min_usd IS NOT NULL", _HAS("erp_system"), "n_contacts > 0", "year_founded IS NOT NULL", _HAS("naics_code"), _HAS("industry"), _HAS("phone"), _HAS("email")])}) / 9.0 * 40 AS completeness,
  CASE WHEN dns_mx_valid IS NULL AND google_places_matched IS NULL AND linkedin_found IS NULL THEN 60.0 ELSE greatest(0.0, least(100.0, CASE WHEN validation_score IS NULL THEN b ELSE (b + validation_score) / 2 END)) END AS accuracy,
  CASE WHEN days_old IS NULL THEN 50 WHEN days_old <= 7 THEN 100 WHEN days_old <= 30 THEN 90 WHEN days_old <= 90 THEN 75 WHEN days_old <= 180 THEN 60 WHEN days_old <= 365 THEN 40 ELSE 20 END AS freshness,
  CASE WHEN ({_NAMED}) = 0 THEN 50.0 ELSE least(100.0, ({_SUM})::DOUBLE / ({_NAMED}) + least(10, 2 * ({_NAMED}))) END AS source_reliability
FROM (SELECT *, 60 + CASE WHEN dns_mx_valid THEN 20 WHEN NOT dns_mx_valid THEN -20 ELSE 0 END + CASE WHEN google_places_matched THEN 15 WHEN NOT google_places_matched THEN -10 ELSE 0 END + CASE WHEN linkedin_found THEN 5 ELSE 0 END AS b FROM companies)"""
SCORED_HEAD = f"WITH parts AS ({PARTS_SQL}), sc AS (SELECT *, greatest(0, least(100, round_even(completeness::DOUBLE * 0.30::DOUBLE + accuracy::DOUBLE * 0.40::DOUBLE + freshness * 0.15::DOUBLE + source_reliability::DOUBLE * 0.15::DOUBLE, 0)))::INT AS score FROM parts), scored AS (SELECT *, CASE WHEN score >= 90 THEN 'A' WHEN score >= 80 THEN 'B' WHEN score >= 70 THEN 'C' WHEN score >= 60 THEN 'D' ELSE 'F' END AS letter FROM sc) "
SCORED_SQL = with_frames(SCORED_HEAD + "SELECT company_id, round(completeness::DOUBLE, 4) AS completeness, round(accuracy::DOUBLE, 4) AS accuracy, round(source_reliability::DOUBLE, 4) AS source_reliability, freshness, score, letter FROM scored", "companies")


def icp(spark, sf):
    df = frame(spark, sf, "companies").withColumns(s.icp_dimensions())
    total = s.total([c(k) for k in s.icp_dimensions()])
    df = df.withColumn("icp_score", F.least(F.lit(100), total)).withColumn("tier", s.assign_tier(c("icp_score"), c("n_contacts") > 0, c("quality_score")))
    return df.select("company_id", *s.icp_dimensions(), "icp_score", "tier", s.detect_competitor(s.all_text()).alias("competitor"))


_LIST = "list_filter(list_transform(string_split(coalesce({}, ''), ';'), lambda x: trim(x)), lambda x: x <> '')"
_LOW = "list_transform(" + _LIST + ", lambda x: lower(x))"
_ANY = lambda arr, *n: f"list_has_any({arr}, [{', '.join(_quote(x) for x in n)}])"
RIVAL_SQL = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(txt, {_quote(a)})" for a in aliases) + f" THEN {_quote(name.title())}" for name, aliases in tables.COMPETITORS.items()) + " ELSE '' END"
ICP_HEAD = f"""WITH l AS (SELECT *, {_LOW.format("tech_stack")} AS tech, {_LOW.format("spf_services")} AS spf, {_LIST.format("associations")} AS assoc, lower(email_provider) AS ep, lower(trim(erp_system)) AS erp,
  CASE WHEN employee_count_max <> 0 THEN employee_count_max ELSE coalesce(employee_count_min, 0) END AS people, upper(trim(state)) AS st FROM companies),
m AS (SELECT *, concat_ws(' ', CASE WHEN len(tech || spf) > 0 THEN array_to_string(tech || spf, ' ') END, erp) AS txt0 FROM l), n AS (SELECT *, txt0 AS txt FROM m),
o AS (SELECT *, {RIVAL_SQL} AS competitor FROM n),
d AS (SELECT *,
  least(25, CASE WHEN contains(ep, 'microsoft 365') THEN 10 WHEN contains(ep, 'proofpoint') OR contains(ep, 'mimecast') THEN 8 WHEN contains(ep, 'google workspace') THEN 5 WHEN ep IN ('self-hosted', 'self-hosted (on-premise)', 'other') THEN 12 WHEN ep = '' THEN 3 ELSE 0 END
    + CASE WHEN {_ANY("spf", "salesforce", "pardot")} THEN 5 WHEN {_ANY("spf", "hubspot", "marketo", "activecampaign")} THEN 3 ELSE 0 END
    + CASE WHEN {_ANY("spf", "mailchimp", "constant contact", "sendgrid", "amazon ses")} THEN 2 ELSE 0 END + CASE WHEN {_ANY("tech", "cloudflare", "akamai", "amazon cloudfront")} THEN 2 ELSE 0 END) AS tech_maturity,
  CASE WHEN people BETWEEN 50 AND 500 THEN 20 WHEN people >= 25 AND people < 50 THEN 15 WHEN people > 500 AND people <= 1000 THEN 12 WHEN people >= 10 AND people < 25 THEN 8 WHEN people > 1000 THEN 5 WHEN people = 0 THEN 10 ELSE 0 END AS size_fit,
  CASE WHEN st IN ({", ".join(map(_quote, tables.HIGH_STATES))}) THEN 15 WHEN st IN ({", ".join(map(_quote, tables.MED_STATES))}) THEN 12 WHEN length(st) = 2 THEN 10 WHEN st <> '' THEN 5 ELSE 7 END AS geo_fit,
  CASE WHEN len(assoc) >= 3 THEN 15 WHEN len(assoc) = 2 THEN 12 WHEN len(assoc) = 1 THEN CASE WHEN upper(assoc[1]) IN ({", ".join(map(_quote, tables.HIGH_ASSOCIATIONS))}) THEN 10 ELSE 7 END ELSE 0 END AS assoc_engagement,
  CASE WHEN erp = '' AND competitor = '' THEN 15 WHEN competitor <> '' THEN 5 ELSE 0 END AS tech_gap,
  least(10, CASE WHEN n_contacts > 0 THEN 4 ELSE 0 END + CASE WHEN coalesce(phone, '') <> '' THEN 2 ELSE 0 END + CASE WHEN enrichment_status = 'complete' THEN 2 ELSE 0 END + CASE WHEN quality_score >= 80 THEN 2 ELSE 0 END) AS data_quality FROM o),
e AS (SELECT *, least(100, tech_maturity + size_fit + geo_fit + assoc_engagement + tech_gap + data_quality) AS icp_score FROM d),
icp AS (SELECT *, CASE WHEN icp_score >= 75 AND n_contacts > 0 AND quality_score >= 70 THEN 'Tier 1' WHEN icp_score >= 55 THEN 'Tier 2' WHEN icp_score >= 35 THEN 'Tier 3' ELSE 'Unqualified' END AS tier FROM e) """
ICP_SQL = with_frames(ICP_HEAD + "SELECT company_id, tech_maturity, size_fit, geo_fit, assoc_engagement, tech_gap, data_quality, icp_score, tier, competitor FROM icp", "companies")


def segments(spark, sf):
    df = frame(spark, sf, "companies")
    hits = F.array_compact(F.array(*[F.when(rule, name) for name, rule in s.segment_rules().items()]))
    return df.select("company_id", "quality_score", F.explode(hits).alias("segment"))


_HOLDS = lambda arr, *p: "len(list_filter(" + arr + ", lambda x: " + " OR ".join(f"contains(x, {_quote(a)})" for a in p) + ")) > 0"
_SEGMENTS = {
    "Salesforce Users": _ANY("spf", "salesforce", "pardot"),
    "Legacy Email (On-Prem)": "ep IN ('self-hosted', 'self-hosted (on-premise)', 'other', '')",
    "Microsoft 365 Stack": "email_provider = 'Microsoft 365'",
    "Marketing Automation Users": _ANY("spf", *tables.MARKETING),
    "Small Manufacturers": "coalesce(employee_count_max, 0) BETWEEN 1 AND 100 AND coalesce(trim(website), '') <> ''",
    "Large Manufacturers": "employee_count_min >= 500",
    "PMA Premium Members": "upper(membership_tier) IN ('PLATINUM', 'GOLD')",
    "WordPress Manufacturers": "contains(lower(cms), 'wordpress')",
    "Cloudflare CDN Users": _HOLDS("tech", "cloudflare"),
    "WooCommerce (eCommerce)": _HOLDS("tech", "woocommerce"),
    "Multi-Association Members": "len(assoc) >= 2",
    "Analytics-Mature": _HOLDS("tech", "google analytics") + " AND " + _HOLDS("tech", "google tag manager", "adobe", "hotjar", "heap", "mixpanel", "segment"),
    "No Email Provider": "ep = '' AND coalesce(trim(website), '') <> ''",
    "Security-Conscious": "ep IN ('proofpoint', 'mimecast', 'barracuda')",
    "Publicly Traded": "publicly_traded",
}
SEGMENTS_SQL = with_frames(ICP_HEAD + " UNION ALL ".join(f"SELECT company_id, quality_score, {_quote(k)} AS segment FROM icp WHERE {v}" for k, v in _SEGMENTS.items()), "companies")


def export_filter(spark, sf):
    """At least 60 points, in one of two associations, with contacts and an ERP, in given states."""
    df = frame(spark, sf, "companies")
    member = F.arrays_overlap(t.text_list(c("associations")), F.array(F.lit("PMA"), F.lit("NTMA")))
    return df.filter((c("quality_score") >= 60) & member & (c("n_contacts") > 0) & t.has_value(c("erp_system")) & c("state").isin("OH", "TX", "MI", "CA")).select("company_id", "state", "quality_score", "erp_system")


EXPORT_SQL = with_frames(f"SELECT company_id, state, quality_score, erp_system FROM companies WHERE quality_score >= 60 AND list_has_any({_LIST.format('associations')}, ['PMA', 'NTMA']) AND n_contacts > 0 AND trim(erp_system) <> '' AND state IN ('OH', 'TX', 'MI', 'CA')", "companies")


def contract_check(spark, sf):
    """Violations of the contract of companies, one row each."""
    df = frame(spark, sf, "companies")
    rules = {
        "website missing": ~t.has_value(c("website")),
        "state not two letters": ~c("state").rlike("^[A-Z]{2}$"),
        "score out of range": ~c("quality_score").between(0, 80),
        "year out of range": c("year_founded") > 2015,
        "email without @": (c("email") != "") & ~c("email").contains("@"),
    }
    return df.select("company_id", F.explode(F.array_compact(F.array(*[F.when(bad, name) for name, bad in rules.items()]))).alias("violation"))


CONTRACT_SQL = with_frames(
    """SELECT company_id, 'website missing' AS violation FROM companies WHERE coalesce(trim(website), '') = ''
UNION ALL SELECT company_id, 'state not two letters' FROM companies WHERE NOT regexp_full_match(state, '[A-Z]{2}')
UNION ALL SELECT company_id, 'score out of range' FROM companies WHERE quality_score NOT BETWEEN 0 AND 80
UNION ALL SELECT company_id, 'year out of range' FROM companies WHERE year_founded > 2015
UNION ALL SELECT company_id, 'email without @' FROM companies WHERE email <> '' AND NOT contains(email, '@')""",
    "companies",
)


def work_split(spark, sf):
    """What is left to look up, and in which order; gaps as text."""
    df = frame(spark, sf, "companies")
    state = F.when(c("enrichment_status") == "complete", "done").when(t.extract_domain(c("website")) == "", "no_domain").when(t.has_value(c("tech_stack")), "dns_only").otherwise("full")
    gap = F.array_join(F.array_compact(F.array(F.when(~t.has_value(c("website")), "website"), F.when(~t.has_value(c("phone")), "phone"), F.when(c("n_contacts") == 0, "contacts"), F.when(~t.has_value(c("erp_system")), "erp"))), ", ")
    rank = F.when(~t.has_value(c("phone")) & ~t.has_value(c("city")), 0).when(~t.has_value(c("phone")), 1).when(~t.has_value(c("city")), 2).otherwise(3)
    return df.select("company_id", state.alias("work"), gap.alias("gaps"), rank.alias("priority"))


WORK_SQL = with_frames(
    f"""SELECT company_id, CASE WHEN enrichment_status = 'complete' THEN 'done' WHEN ({DOMAIN_SQL}) = '' THEN 'no_domain' WHEN trim(tech_stack) <> '' THEN 'dns_only' ELSE 'full' END AS work,
  concat_ws(', ', CASE WHEN coalesce(trim(website), '') = '' THEN 'website' END, CASE WHEN coalesce(trim(phone), '') = '' THEN 'phone' END, CASE WHEN n_contacts = 0 THEN 'contacts' END, CASE WHEN trim(erp_system) = '' THEN 'erp' END) AS gaps,
  CASE WHEN coalesce(phone, '') = '' AND city = '' THEN 0 WHEN coalesce(phone, '') = '' THEN 1 WHEN city = '' THEN 2 ELSE 3 END AS priority FROM companies""",
    "companies",
)


def security_scores(spark, sf):
    df = frame(spark, sf, "companies")
    policy = F.when(c("company_id") % 4 == 0, F.lit(None)).when(c("company_id") % 4 == 1, "Strict (reject)").when(c("company_id") % 4 == 2, "Moderate (quarantine)").otherwise("None")
    score = s.email_security_score(c("dns_mx_valid"), c("email_provider"), c("spf_services") != "", policy)
    maturity = s.tech_maturity()
    return df.select("company_id", score.alias("security"), maturity.alias("maturity"), s.tech_tier(maturity, t.has_value(c("tech_stack"))).alias("tech_tier"), t.title_priority(c("industry")).alias("priority"))


SECURITY_SQL = with_frames(
    ICP_HEAD
    + f"""SELECT company_id, least(100, CASE WHEN dns_mx_valid THEN 20 ELSE 0 END + CASE WHEN email_provider NOT IN ('', 'Self-hosted', 'Other') THEN 15 ELSE 0 END + CASE WHEN spf_services <> '' THEN 25 ELSE 0 END
    + CASE company_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 40 WHEN 2 THEN 35 ELSE 25 END) AS security, mat AS maturity,
  CASE WHEN trim(tech_stack) = '' THEN 'Unknown' WHEN mat >= 70 THEN 'Modern' WHEN mat >= 40 THEN 'Transitional' ELSE 'Legacy' END AS tech_tier, 999 AS priority
FROM (SELECT *, CASE WHEN contains(lower(cms), 'drupal') THEN 10 WHEN contains(lower(cms), 'wordpress') THEN 8 WHEN contains(lower(cms), 'wix') THEN 6 WHEN cms <> '' THEN 4 ELSE 0 END
  + CASE WHEN {_ANY("tech", "google analytics")} THEN CASE WHEN {_ANY("tech", "google tag manager")} THEN 8 ELSE 6 END ELSE 0 END + CASE WHEN {_ANY("tech", "cloudflare")} THEN 20 ELSE 0 END
  + CASE WHEN {_ANY("tech", "jquery")} THEN 6 ELSE 0 END + CASE WHEN {_ANY("spf", "hubspot", "marketo", "pardot")} THEN 20 WHEN {_ANY("spf", "mailchimp", "sendgrid")} THEN 10 ELSE 0 END AS mat FROM icp)""",
    "companies",
)


def campaigns(spark, sf):
    df = frame(spark, sf, "companies").withColumns(s.icp_dimensions())
    df = df.withColumn("icp_score", F.least(F.lit(100), s.total([c(k) for k in s.icp_dimensions()])))
    hits = F.array_compact(F.array(*[F.when(rule, name) for name, rule in s.campaign_rules().items()]))
    rows = df.select("icp_score", "n_contacts", F.explode(hits).alias("campaign"))
    return rows.groupBy("campaign").agg(F.count("*").alias("targets"), F.count_if(c("n_contacts") > 0).alias("with_contacts"), F.round(F.avg("icp_score"), 6).alias("avg_icp"))


_CAMPAIGNS = {
    "microsoft": "contains(ep, 'microsoft 365')", "legacy_mail": "ep IN ('self-hosted', 'self-hosted (on-premise)', 'other')", "salesforce": _ANY("spf", "salesforce", "pardot"),
    "association": "list_contains(assoc, 'PMA')", "greenfield": "erp = '' AND competitor = '' AND coalesce(employee_count_max, 0) + coalesce(employee_count_min, 0) > 0", "competitive": "competitor <> ''",
}
CAMPAIGNS_SQL = with_frames(
    ICP_HEAD + ", t AS (" + " UNION ALL ".join(f"SELECT icp_score, n_contacts, {_quote(k)} AS campaign FROM icp WHERE {v}" for k, v in _CAMPAIGNS.items()) + ") SELECT campaign, count(*) AS targets, count(*) FILTER (n_contacts > 0) AS with_contacts, round(avg(icp_score), 6) AS avg_icp FROM t GROUP BY campaign",
    "companies",
)

QUERIES = {
    "names": (names, NAMES_SQL), "urls": (urls, URLS_SQL), "parsed_fields": (parsed_fields, PARSED_SQL), "quality_scores": (scored, SCORED_SQL), "icp_scores": (icp, ICP_SQL),
    "segments": (segments, SEGMENTS_SQL), "export_filter": (export_filter, EXPORT_SQL), "contract_check": (contract_check, CONTRACT_SQL), "work_split": (work_split, WORK_SQL),
    "security_scores": (security_scores, SECURITY_SQL), "campaign_overview": (campaigns, CAMPAIGNS_SQL),
}
