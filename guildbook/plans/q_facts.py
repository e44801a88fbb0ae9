"""Queries of facts of organisations, exports, checks and contacts, each with SQL written by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from guildbook.functions import events as ev
from guildbook.functions import scores as s
from guildbook.functions import tables
from guildbook.functions import text as t
from guildbook.operators import accounts as ac
from guildbook.operators import contracts as ct
from guildbook.operators import event_pages as ep
from guildbook.operators import exports as ex
from guildbook.operators import graph as g
from guildbook.operators import joins as j
from guildbook.operators import organisations as og
from guildbook.operators import pages as pg
from guildbook.plans.frames import frame, with_frames

c = F.col


def _organisations(spark, sf):
    return pg.parse_page(frame(spark, sf, "organisation_pages"), ["page_id"], "html").select("page_id", "blocks")


def organisation_facts(spark, sf):
    return og.organisation_facts(_organisations(spark, sf), "page_id", "blocks")


FACTS_SQL = with_frames(
    """SELECT page_id, CASE k WHEN 1 THEN 'LocalBusiness' WHEN 2 THEN 'Store' WHEN 3 THEN 'Corporation' ELSE 'Organization' END AS schema_type,
  CASE k WHEN 0 THEN '555-0' || page_id WHEN 1 THEN '5550100' WHEN 6 THEN '3' END AS phone, CASE k WHEN 0 THEN 'https://firm.com' END AS url, CASE k WHEN 0 THEN 1950 END AS founded,
  CASE k WHEN 0 THEN page_id + 1 WHEN 1 THEN 1010 + page_id % 90 END AS employees, CASE k WHEN 4 THEN 'AB' END AS description,
  CASE k WHEN 0 THEN '1 Main St' WHEN 1 THEN '2 Oak Ave, Gary' WHEN 6 THEN '3 Elm' END AS street, CASE k WHEN 0 THEN 'Akron' WHEN 6 THEN 'Gary' END AS city,
  CASE k WHEN 0 THEN 'OH' WHEN 4 THEN 'TX' WHEN 6 THEN 'MI' END AS state, CASE k WHEN 0 THEN '44301' END AS zip, CASE k WHEN 0 THEN 'US' END AS country,
  CASE k WHEN 0 THEN 41.5::DOUBLE END AS latitude, CASE k WHEN 0 THEN (-81.25)::DOUBLE END AS longitude, CASE k WHEN 3 THEN 'https://Maps.google.com/' || page_id END AS map_url,
  CASE k WHEN 0 THEN 'https://www.LinkedIn.com/company/f' || page_id WHEN 1 THEN 'https://linkedin.com/company/one' END AS linkedin_url
FROM (SELECT page_id, page_id % 8 AS k FROM organisation_pages) WHERE k IN (0, 1, 3, 4, 6)
UNION ALL SELECT page_id, 'Store', NULL, NULL, NULL, 1200, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM organisation_pages WHERE page_id % 8 = 2""",
    "organisation_pages",
)


def organisation_firmographics(spark, sf):
    return og.organisation_firmographics(_organisations(spark, sf), "page_id", "blocks", F.lit(2025))


FIRMOGRAPHICS_SQL = with_frames(
    """SELECT page_id, people AS employee_count_min, people AS employee_count_max, CASE k WHEN 0 THEN 1950 WHEN 2 THEN 1999 END AS year_founded, CASE k WHEN 0 THEN 'Akron' WHEN 2 THEN 'Tulsa' WHEN 6 THEN 'Gary' END AS city,
  CASE k WHEN 0 THEN 'Ohio' WHEN 4 THEN 'tx' END AS state, 'schema_org' AS firmographic_source
FROM (SELECT page_id, page_id % 8 AS k, CASE page_id % 8 WHEN 0 THEN page_id + 1 WHEN 2 THEN page_id END AS people FROM organisation_pages) WHERE k IN (0, 2, 4, 6)""",
    "organisation_pages",
)


def record_contract(spark, sf):
    return ct.check_records(frame(spark, sf, "contract_records"), "record_id", "record", tables.COMPANY_FIELDS)


def _said(k: int, texts: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT record_id, {i} AS turn, '{x}' AS violation FROM contract_records WHERE record_id % 7 = {k}" for i, x in enumerate(texts))


CONTRACT_SQL = with_frames(
    "SELECT record_id, (row_number() OVER (PARTITION BY record_id ORDER BY t) - 1)::INT AS turn, violation FROM ("
    + " UNION ALL ".join(f"SELECT record_id, {t} AS t, '{x}' AS violation FROM contract_records WHERE record_id % 7 = 1 AND {when}" for t, x, when in [(0, "company_name: shorter than 1", "true"), (1, "state: longer than 50", "record_id % 2 = 1"), (2, "year_founded: above 2030", "true"), (3, "quality_score: above 100", "record_id % 200 > 100"), (4, "quality_grade: not one of the values", "true")])
    + ") UNION ALL " + _said(2, ["company_name: no string", "country: no string", "employee_count_min: below 0", "quality_score: no integer", "also: unknown", "extra: unknown"])
    + " UNION ALL " + _said(3, ["company_name: missing", "associations[1]: no string", "contacts[0].full_name: shorter than 1", "contacts[0].confidence_score: above 1", "contacts[1].full_name: missing", "contacts[1].email_verified: no boolean", "contacts[1].nick: unknown", "contacts[2]: no object"])
    + " UNION ALL " + _said(4, ["latitude: no number", "revenue_min_usd: no integer", "provenance[0].source_type: not one of the values", "provenance[0].confidence: below 0", "provenance[1].source_url: missing", "provenance[1].extracted_by: missing", "provenance[1].page_type: not one of the values"])
    + " UNION ALL " + _said(5, ["record: no object"]) + " UNION ALL " + _said(6, ["record: no JSON"]),
    "contract_records",
)


def contact_facts(spark, sf):
    return frame(spark, sf, "contact_pages").select("page_id", pg.contact_facts(c("html"), c("text")).alias("_x")).select("page_id", "_x.*")


CONTACT_SQL = with_frames(
    """SELECT page_id, CASE k WHEN 0 THEN '+1 (330) 555-0100' WHEN 1 THEN '330.555.0199' END AS phone, CASE k WHEN 0 THEN 'm ' || (10 + page_id % 90) || ' North Main Street' END AS street,
  CASE k WHEN 0 THEN 'New Berlin' WHEN 1 THEN 'Fort Wayne' END AS city, CASE k WHEN 0 THEN 'WI' WHEN 1 THEN 'IN' END AS state, CASE k WHEN 0 THEN '53151-1234' WHEN 1 THEN '46801' WHEN 2 THEN '90210' END AS zip,
  CASE k WHEN 0 THEN 1200 WHEN 1 THEN 1 + page_id END AS employees, CASE k WHEN 0 THEN 1950 END AS founded,
  CASE k WHEN 0 THEN 'https://www.google.com/maps/embed?k=' || page_id WHEN 1 THEN '//maps.google.com/x' END AS map_url
FROM (SELECT page_id, page_id % 5 AS k FROM contact_pages)""",
    "contact_pages",
)


def _records(spark, sf):
    """Companies as nested records."""
    people = F.when(c("company_id") % 3 == 0, F.array(F.struct(F.lit("Ann Lee").alias("full_name"), c("email"), F.lit(None).cast("string").alias("title")))).otherwise(F.array().cast("array<struct<full_name:string,email:string,title:string>>"))
    df = frame(spark, sf, "companies").select("company_id", "company_name", "website", "city", "state", "employee_count_min", "revenue_min_usd", "industry", "erp_system", "quality_score", t.text_list(c("associations")).alias("associations"), people.alias("contacts"))
    return df.withColumns({"certificates": F.array(F.lit("ISO 9001"), F.lit('a"b')), "geo": F.struct((c("company_id") / 2).alias("lat"), F.lit("x").alias("kind")), "provenance": F.lit("crawl"), "extracted_at": F.lit("2024-05-06 07:08:09").cast("timestamp")})


def company_export(spark, sf):
    return ex.export_table(_records(spark, sf), "companies")


def other_export(spark, sf):
    return ex.export_table(_records(spark, sf).select("company_id", "certificates", "geo", "contacts", "extracted_at"), "other")


def crm_exports(spark, sf):
    """One row for each field that a company has in the two sales systems."""
    day, rows = F.lit("2024-05-06").cast("date"), _records(spark, sf)

    def long(mapping, system):
        out = ex.export_fields(rows, mapping, "Guild", day)
        named = [n for n in out.columns if n not in ("Data_Source__c", "Import_Date__c")]
        pairs = F.inline(F.array(*[F.struct(F.lit(n).alias("field"), c(f"`{n}`").cast("string").alias("value")) for n in named]))
        return out.select(F.lit(system).alias("system"), c("Data_Source__c").alias("source"), c("Import_Date__c").alias("day"), pairs).groupBy("system", "source", "day", "field").agg(F.count("value").alias("filled"), F.min("value").alias("least"), F.max("value").alias("most"))

    return long(tables.SALESFORCE_FIELDS, "salesforce").unionByName(long(tables.HUBSPOT_FIELDS, "hubspot"))


_TEXT_FIELDS = {"company_name": ("Account Name", "name"), "website": ("Website", "website"), "city": ("BillingCity", "city"), "state": ("BillingState", "state"), "employee_count_min": ("NumberOfEmployees", "numberofemployees"), "revenue_min_usd": ("AnnualRevenue", "annualrevenue"), "industry": ("Industry", "industry"), "erp_system": ("ERP_System__c", "erp_system"), "assoc": ("Associations__c", None), "quality_score": ("Data_Quality_Score__c", None)}
_JOINED = "array_to_string(list_filter(list_transform(string_split(associations, ';'), lambda x: trim(x)), lambda x: x <> ''), '; ')"
CRM_SQL = with_frames(
    f"WITH r AS (SELECT *, {_JOINED} AS assoc FROM companies) "
    + " UNION ALL ".join(f"SELECT '{system}' AS system, 'Guild' AS source, '2024-05-06' AS day, '{names[i]}' AS field, count({f}) AS filled, min({f}::VARCHAR) AS least, max({f}::VARCHAR) AS most FROM r" for i, system in enumerate(("salesforce", "hubspot")) for f, names in _TEXT_FIELDS.items() if names[i]),
    "companies",
)
EXPORT_SQL = with_frames(
    f"""SELECT company_name, website, NULL AS domain, city, state, NULL AS country, employee_count_min, NULL AS employee_count_max, revenue_min_usd, industry, NULL AS naics_code, erp_system, NULL AS crm_system, {_JOINED} AS associations, quality_score, NULL AS quality_grade,
  CASE WHEN company_id % 3 = 0 THEN 1 END AS contact_count, CASE WHEN company_id % 3 = 0 THEN 'Ann Lee' END AS primary_contact_name, CASE WHEN company_id % 3 = 0 THEN email END AS primary_contact_email, NULL AS source_url, '2024-05-06T07:08:09' AS extracted_at FROM companies""",
    "companies",
)
OTHER_SQL = with_frames(
    """SELECT company_id, '["ISO 9001","a\\"b"]' AS certificates, company_id / 2 AS geo_lat, 'x' AS geo_kind, CASE WHEN company_id % 3 = 0 THEN 1 END AS contact_count, CASE WHEN company_id % 3 = 0 THEN 'Ann Lee' END AS primary_contact_name,
  CASE WHEN company_id % 3 = 0 THEN email END AS primary_contact_email, CASE WHEN company_id % 3 = 0 THEN '' END AS primary_contact_title, '2024-05-06T07:08:09' AS extracted_at FROM companies""",
    "companies",
)


def _referenced(spark, sf):
    """Companies with look-ups: every third domain has no mail server, names of places come sixth, in another form, or not at all."""
    df = frame(spark, sf, "companies").select("company_id", F.concat(F.lit("Firm"), "company_id", F.lit(" Works Inc")).alias("company_name"), F.when(c("company_id") % 6 > 0, F.concat(F.lit("http://f"), "company_id", F.lit(".com"))).alias("website"), F.when(c("company_id") % 7 > 0, "Akron").alias("city"), F.lit("").alias("state"))
    sites = df.filter("company_id % 6 > 0").select(t.extract_domain(c("website")).alias("domain"), "company_id")
    others = F.array_repeat(F.lit("Zeta Bakery"), 5)
    met = F.concat(F.lit("FIRM"), "company_id", F.lit(" works"))
    results = F.when(c("company_id") % 4 == 0, F.array(F.lit("Zeta Bakery"), met)).when(c("company_id") % 4 == 1, F.concat(others, F.array(met))).when(c("company_id") % 4 == 2, F.array().cast("array<string>"))
    places = df.select("company_name", "city", "state", results.alias("results")).filter("results is not null")
    return j.cross_reference(df, sites.filter("company_id % 5 > 0").select("domain", (c("company_id") % 3 > 0).alias("mx")), places, sites.filter("company_id % 2 = 1").select("domain", (c("company_id") % 9 > 0).alias("found")))


def cross_references(spark, sf):
    return _referenced(spark, sf).select("company_id", "domain", "dns_mx_valid", "places_matched", "linkedin_found", "validation_score", F.array_join("issues", ",").alias("issues"))


def cross_reference_stats(spark, sf):
    return j.validation_stats(_referenced(spark, sf))


_REFERENCED = """WITH r AS (SELECT company_id, CASE WHEN company_id % 6 > 0 THEN 'f' || company_id || '.com' END AS domain, CASE WHEN company_id % 6 > 0 AND company_id % 5 > 0 THEN company_id % 3 > 0 END AS dns_mx_valid,
  CASE WHEN company_id % 7 > 0 AND company_id % 4 < 3 THEN company_id % 4 = 0 END AS places_matched, CASE WHEN company_id % 6 > 0 AND company_id % 2 = 1 THEN company_id % 9 > 0 END AS linkedin_found FROM companies) """
CROSS_SQL = with_frames(_REFERENCED + "SELECT *, 50 + CASE WHEN dns_mx_valid THEN 20 WHEN NOT dns_mx_valid THEN -20 ELSE 0 END + CASE WHEN places_matched THEN 20 WHEN NOT places_matched THEN -10 ELSE 0 END + CASE WHEN linkedin_found THEN 10 ELSE 0 END AS validation_score, concat_ws(',', CASE WHEN NOT dns_mx_valid THEN 'invalid_domain' END, CASE WHEN NOT places_matched THEN 'address_not_found' END) AS issues FROM r", "companies")
CROSS_STATS_SQL = with_frames(_REFERENCED + "SELECT count(*) FILTER (dns_mx_valid) AS dns_valid, count(*) FILTER (NOT dns_mx_valid) AS dns_invalid, count(*) FILTER (dns_mx_valid IS NULL) AS dns_skipped, count(*) FILTER (places_matched) AS places_matched, count(*) FILTER (NOT places_matched) AS places_unmatched, count(*) FILTER (places_matched IS NULL) AS places_skipped FROM r", "companies")


def _run_rows(spark, sf):
    """Companies as rows of a whole run, with lists and further sources."""
    people = F.when(c("n_contacts") > 1, F.array(F.lit("Ann"))).otherwise(F.array().cast("array<string>"))
    df = frame(spark, sf, "companies").withColumns({f: t.text_list(c(f)) for f in ("tech_stack", "spf_services", "associations")} | {"contacts": people})
    return df.withColumns({
        "domain": F.when(c("company_id") % 2 == 0, "own.com"), "has_mx": F.when(c("company_id") % 4 > 0, c("company_id") % 4 == 1), "country": F.when(c("company_id") % 3 == 0, "US"),
        "enrichment_source": F.get(F.array(F.lit("xlsx_seed"), F.lit("website_scrape"), F.lit(""), F.lit("paper"), F.lit(None)), (c("company_id") % 5).cast("int")), "source_url": F.when(c("company_id") % 6 == 0, "file:xlsx_seed/1").when(c("company_id") % 6 == 1, "http://x"),
    })


def run_scores(spark, sf):
    df = _run_rows(spark, sf).withColumns({"completeness": s.run_completeness(), "accuracy": s.run_accuracy(), "freshness": s.freshness(c("days_old")), "source_reliability": s.run_source_reliability()})
    df = df.withColumn("score", s.quality_score())
    return df.select("company_id", F.round("completeness", 4).alias("completeness"), "accuracy", F.round("source_reliability", 4).alias("source_reliability"), "score", s.grade(c("score")).alias("letter"))


def field_points(spark, sf):
    df = _run_rows(spark, sf)
    return df.select("company_id", s.field_points(df.schema).alias("points"))


_N = "(CASE WHEN {} THEN 1 ELSE 0 END)"
_ADD = lambda tests: " + ".join(_N.format(x) for x in tests)
_SOME = lambda f: f"coalesce(trim({f}), '') <> ''"
_MANY = lambda f: f"len(list_filter(string_split(coalesce({f}, ''), ';'), lambda x: trim(x) <> '')) > 0"
_TRUST = "(CASE {0} WHEN 'clearbit' THEN 95 WHEN 'zoominfo' THEN 90 WHEN 'apollo' THEN 85 WHEN 'builtwith' THEN 80 WHEN 'website' THEN 70 WHEN 'website_scrape' THEN 70 WHEN 'job_postings' THEN 65 WHEN 'association' THEN 60 WHEN 'xlsx_seed' THEN 55 ELSE 50 END)"
_RUN = f"""WITH r AS (SELECT *, CASE company_id % 5 WHEN 0 THEN 'xlsx_seed' WHEN 1 THEN 'website_scrape' WHEN 2 THEN '' WHEN 3 THEN 'paper' END AS third, len(list_filter(string_split(associations, ';'), lambda x: trim(x) <> '')) AS members FROM companies),
x AS (SELECT *, ({_ADD(["firmographic_source <> ''", "tech_source <> ''", "third <> ''", "company_id % 6 = 0"])}) + members AS named,
  (CASE WHEN firmographic_source <> '' THEN {_TRUST.format("firmographic_source")} ELSE 0 END) + (CASE WHEN tech_source <> '' THEN {_TRUST.format("tech_source")} ELSE 0 END) + (CASE WHEN third <> '' THEN {_TRUST.format("third")} ELSE 0 END) + (CASE WHEN company_id % 6 = 0 THEN 55 ELSE 0 END) + 60 * members AS trust FROM r),
y AS (SELECT *, ({_ADD([_SOME(f) for f in ("company_name", "website", "city", "state")])})::DOUBLE / 4 * 60 + ({_ADD(["employee_count_min IS NOT NULL", "revenue_min_usd IS NOT NULL", _SOME("erp_system"), "year_founded IS NOT NULL", _SOME("naics_code"), _SOME("industry"), _SOME("phone"), _SOME("email"), "n_contacts > 1", _SOME("email_provider"), _MANY("tech_stack"), _MANY("spf_services")])})::DOUBLE / 12 * 40 AS completeness,
  greatest(0, least(100, 60 + 10 * ({_ADD([_SOME("website") + " OR company_id % 2 = 0", "enrichment_status = 'complete'", "company_id % 4 = 1"])}) + CASE WHEN dns_mx_valid THEN 5 WHEN NOT dns_mx_valid THEN -15 ELSE 0 END)) AS accuracy,
  CASE WHEN days_old IS NULL THEN 50 WHEN days_old <= 7 THEN 100 WHEN days_old <= 30 THEN 90 WHEN days_old <= 90 THEN 75 WHEN days_old <= 180 THEN 60 WHEN days_old <= 365 THEN 40 ELSE 20 END AS fresh,
  CASE WHEN named = 0 THEN 50.0::DOUBLE ELSE least(100.0::DOUBLE, trust::DOUBLE / named + least(10, 2 * named)) END AS source_reliability FROM x),
z AS (SELECT *, greatest(0, least(100, round_even(completeness * 0.30::DOUBLE + accuracy * 0.40::DOUBLE + fresh * 0.15::DOUBLE + source_reliability * 0.15::DOUBLE, 0)))::INT AS score FROM y) """
RUN_SQL = with_frames(_RUN + "SELECT company_id, round(completeness, 4) AS completeness, accuracy, round(source_reliability, 4) AS source_reliability, score, CASE WHEN score >= 90 THEN 'A' WHEN score >= 80 THEN 'B' WHEN score >= 70 THEN 'C' WHEN score >= 60 THEN 'D' ELSE 'F' END AS letter FROM z", "companies")
POINTS_SQL = with_frames(
    "SELECT company_id, 20 * " + _N.format(_SOME("company_name")) + " + 15 * " + _N.format(_SOME("website")) + " + 10 * " + _N.format("company_id % 2 = 0") + " + " + " + ".join(f"5 * {_N.format(x)}" for x in [_SOME("city"), _SOME("state"), _SOME("industry"), "employee_count_min > 0", "revenue_min_usd > 0", _SOME("erp_system")])
    + " + 3 * " + _N.format("company_id % 3 = 0") + " + 10 * " + _N.format(_MANY("tech_stack")) + " + 4 * " + _N.format("n_contacts > 1") + " AS points FROM companies",
    "companies",
)


def short_domains(spark, sf):
    host = F.concat(F.get(F.array(F.lit("WWW.a"), F.lit("shop.north.b"), F.lit("c"), F.lit("")), (c("company_id") % 4).cast("int")), "company_id", F.get(F.array(F.lit(".com"), F.lit(".co.uk"), F.lit("")), (c("company_id") % 3).cast("int")))
    return frame(spark, sf, "companies").select("company_id", host.alias("host")).select("company_id", t.last_two_labels(c("host")).alias("two"), t.bare_domain(c("host")).alias("by_country"))


_HOST = "CASE company_id % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'b' WHEN 2 THEN 'c' ELSE '' END || company_id"
SHORT_SQL = with_frames(
    f"""SELECT company_id, CASE company_id % 3 WHEN 0 THEN h || '.com' WHEN 1 THEN 'co.uk' ELSE CASE company_id % 4 WHEN 0 THEN 'www.' WHEN 1 THEN 'north.' ELSE '' END || h END AS two,
  CASE company_id % 3 WHEN 0 THEN h || '.com' WHEN 1 THEN h || '.co.uk' ELSE CASE company_id % 4 WHEN 1 THEN 'north.' ELSE '' END || h END AS by_country FROM (SELECT company_id, {_HOST} AS h FROM companies)""",
    "companies",
)


def member_tables(spark, sf):
    """Tables of members, of things that aren't, and with headers twice."""
    k = c("company_id").cast("string")
    row = lambda *x: F.array(*[y if not isinstance(y, str) else F.lit(y) for y in x])
    tables_ = [F.array(row("Member Name", " ST ", "Year Joined"), row(F.concat(F.lit(" Firm "), k), "OH", "1999"), row("", "MI", "2000"), row("Short")), F.array(row("Name", "Type"), row("Acme", "Gold")), F.array(row("Company", "Name", "Web"), row("First", k, "a.com"), row("Only", "", ""))]
    df = frame(spark, sf, "companies").select("company_id", F.get(F.array(*tables_), (c("company_id") % 3).cast("int")).alias("_t"))
    return df.select("company_id", F.posexplode(ev.member_rows(c("_t"))).alias("turn", "_m")).select("company_id", "turn", *[c("_m")[f].alias(f) for f in ("company_name", "state", "member_since", "website")])


MEMBERS_SQL = with_frames(
    """SELECT company_id, 0 AS turn, CASE company_id % 3 WHEN 0 THEN 'Firm ' || company_id ELSE company_id::VARCHAR END AS company_name, CASE company_id % 3 WHEN 0 THEN 'OH' END AS state, CASE company_id % 3 WHEN 0 THEN '1999' END AS member_since, CASE company_id % 3 WHEN 2 THEN 'a.com' END AS website
FROM companies WHERE company_id % 3 <> 1 UNION ALL SELECT company_id, 1, 'Only', NULL, NULL, NULL FROM companies WHERE company_id % 3 = 2""",
    "companies",
)


def dated_events(spark, sf):
    return ep.extract_events(frame(spark, sf, "dated_events"), "page_id", "url", "page_type").select("page_id", c("start_date").cast("string").alias("start_date"), c("end_date").cast("string").alias("end_date"))


DATED_SQL = with_frames(
    """SELECT page_id, CASE page_id % 8 WHEN 0 THEN '2025-03-04' WHEN 1 THEN '2025-04-13' WHEN 2 THEN '2025-03-04' WHEN 5 THEN '2025-10-' || (10 + page_id % 20) WHEN 7 THEN NULL ELSE '2025-05-02' END AS start_date,
  CASE page_id % 8 WHEN 0 THEN '2025-03-06' WHEN 1 THEN '2025-05-06' WHEN 2 THEN '2025-03-05' END AS end_date FROM dated_events""",
    "dated_events",
)


def exported_graph(spark, sf):
    """Firms and their associations for three programs that draw graphs."""
    f = lambda n: frame(spark, sf, n)
    nodes = g.build_nodes(f("companies"), f("memberships"), f("trade_events"), f("signals")).filter("kind in ('company', 'association')")
    edges = g.build_edges(f("memberships"), f("trade_events"), f("participants"), f("signals")).filter("kind = 'HAS_MEMBER'")
    parts = [g.export_graph(nodes, edges, how).select(F.lit(how).alias("format"), "part", "element") for how in ("json", "cytoscape", "gephi")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


GRAPH_SQL = with_frames(
    """WITH n AS (SELECT 'company:' || company_id AS id, 'company' AS kind, company_name AS name FROM companies UNION SELECT 'association:' || association, 'association', association FROM memberships),
e AS (SELECT 'association:' || association AS s, 'company:' || company_id AS t FROM memberships), j AS (SELECT *, s || '|HAS_MEMBER|' || t AS id FROM e)
SELECT 'json' AS format, 'node' AS part, '{"id":"' || id || '","kind":"' || kind || '","name":"' || name || '"}' AS element FROM n
UNION ALL SELECT 'json', 'edge', '{"source":"' || s || '","target":"' || t || '","kind":"HAS_MEMBER"}' FROM e
UNION ALL SELECT 'cytoscape', 'node', '{"data":{"id":"' || id || '","label":"' || name || '","type":"' || kind || '"}}' FROM n
UNION ALL SELECT 'cytoscape', 'edge', '{"data":{"id":"' || id || '","source":"' || s || '","target":"' || t || '","label":"HAS_MEMBER"}}' FROM j
UNION ALL SELECT 'gephi', 'node', '{"id":"' || id || '","label":"' || name || '","type":"' || kind || '"}' FROM n
UNION ALL SELECT 'gephi', 'edge', '{"id":"' || id || '","source":"' || s || '","target":"' || t || '","type":"HAS_MEMBER","weight":1.0}' FROM j""",
    "companies", "memberships",
)


def exported_records(spark, sf):
    """JSON records of companies, and the description of the export beside each."""
    rows = frame(spark, sf, "companies").select("company_id", "city", F.nullif("state", F.lit("")).alias("state"))
    records, about = ac.export_json(rows, "companies", F.lit("2024-05-06"))
    return records.join(F.broadcast(about), F.lit(True))


RECORDS_SQL = with_frames(
    """SELECT '{"company_id":' || company_id || ',"city":"' || city || '"' || CASE WHEN state <> '' THEN ',"state":"' || state || '"' ELSE '' END || '}' AS value, 'companies' AS export_type, '2024-05-06' AS exported_at, (SELECT count(*) FROM companies) AS record_count FROM companies""",
    "companies",
)

QUERIES = {
    "organisation_facts": (organisation_facts, FACTS_SQL),
    "run_scores": (run_scores, RUN_SQL), "field_points": (field_points, POINTS_SQL), "short_domains": (short_domains, SHORT_SQL), "member_tables": (member_tables, MEMBERS_SQL),
    "exported_graph": (exported_graph, GRAPH_SQL), "exported_records": (exported_records, RECORDS_SQL),
    "dated_events": (dated_events, DATED_SQL),
    "record_contract": (record_contract, CONTRACT_SQL), "contact_facts": (contact_facts, CONTACT_SQL),
    "company_export": (company_export, EXPORT_SQL), "other_export": (other_export, OTHER_SQL), "crm_exports": (crm_exports, CRM_SQL),
    "cross_references": (cross_references, CROSS_SQL), "cross_reference_stats": (cross_reference_stats, CROSS_STATS_SQL),
    "organisation_firmographics": (organisation_firmographics, FIRMOGRAPHICS_SQL),
}
