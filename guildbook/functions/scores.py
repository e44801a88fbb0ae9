"""Row rules: quality, fit, tiers, competitors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guildbook.functions import tables
from guildbook.functions.text import extract_domain, has_value, lookup, text_list

c = F.col


def one(condition: Column) -> Column:
    """1 where a condition holds, else 0, null among it."""
    return F.when(condition, 1).otherwise(0)


def total(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def filled(fields: dict[str, str]) -> Column:
    """How many fields have a value; fields: name -> kind."""
    return total([one(has_value(c(f), kind)) for f, kind in fields.items()])


def share_filled(required: dict[str, str], valuable: dict[str, str]) -> Column:
    """60 points for required fields, 40 for valuable ones."""
    return filled(required) / len(required) * 60 + filled(valuable) / len(valuable) * 40


REQUIRED = dict.fromkeys(tables.REQUIRED_FIELDS, "string")
VALUABLE = {"employee_count_min": "number", "revenue_min_usd": "number", "erp_system": "string", "n_contacts": "positive", "year_founded": "number", "naics_code": "string", "industry": "string", "phone": "string", "email": "string"}


def completeness() -> Column:
    """Of required and valuable fields; contacts count by their number."""
    valuable = total([one(c(f) > 0) if kind == "positive" else one(has_value(c(f), kind)) for f, kind in VALUABLE.items()])
    return filled(REQUIRED) / len(REQUIRED) * 60 + valuable / len(VALUABLE) * 40


def accuracy() -> Column:
    """60, moved by validations, and averaged with a validation score if there is one."""
    checked = c("dns_mx_valid").isNotNull() | c("google_places_matched").isNotNull() | c("linkedin_found").isNotNull()
    moved = (
        60
        + F.when(c("dns_mx_valid"), 20).when(~c("dns_mx_valid"), -20).otherwise(0)
        + F.when(c("google_places_matched"), 15).when(~c("google_places_matched"), -10).otherwise(0)
        + F.when(c("linkedin_found"), 5).otherwise(0)
    )
    blended = F.when(c("validation_score").isNull(), moved.cast("double")).otherwise((moved + c("validation_score")) / 2)
    return F.when(~checked, 60.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(100.0), blended)))


def freshness(days: Column) -> Column:
    return F.when(days.isNull(), 50).when(days <= 7, 100).when(days <= 30, 90).when(days <= 90, 75).when(days <= 180, 60).when(days <= 365, 40).otherwise(20)


def source_reliability() -> Column:
    """Mean trust of the sources named, and up to ten points for their number."""
    named = [F.when(c(f) != "", F.coalesce(lookup(tables.SOURCE_SCORES, c(f)), F.lit(50))) for f in ("firmographic_source", "tech_source")]
    named.append(F.when(c("in_association"), F.lit(tables.SOURCE_SCORES["association"])))
    known = F.array_compact(F.array(*named))
    n = F.size(known)
    mean = F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / n
    return F.when(n == 0, 50.0).otherwise(F.least(F.lit(100.0), mean + F.least(F.lit(10), n * 2)))


WEIGHTS = {"completeness": 0.30, "accuracy": 0.40, "freshness": 0.15, "source_reliability": 0.15}


def quality_score(weights: dict[str, float] = WEIGHTS) -> Column:
    """The weighted score from component columns, rounded half to even, 0 to 100."""
    mixed = total([c(k) * w for k, w in weights.items()])
    return F.greatest(F.lit(0), F.least(F.lit(100), F.bround(mixed, 0))).cast("int")


def grade(score: Column, bands: tuple[int, int, int, int] = (90, 80, 70, 60)) -> Column:
    a, b, d, e = bands
    return F.when(score >= a, "A").when(score >= b, "B").when(score >= d, "C").when(score >= e, "D").otherwise("F")


RUN_VALUABLE = {f: kind for f, kind in VALUABLE.items() if f != "n_contacts"} | {"contacts": "array", "email_provider": "string", "tech_stack": "array", "spf_services": "array"}


def run_completeness() -> Column:
    """As completeness, with twelve valuable fields; lists count if they hold something."""
    return share_filled(REQUIRED, RUN_VALUABLE)


def run_accuracy() -> Column:
    """60, with points for a domain, a finished enrichment and mail servers, and for or against their validation."""
    site = F.when(has_value(c("website")), c("website")).otherwise(c("domain"))
    sure = one(has_value(extract_domain(site))) * 10 + one(c("enrichment_status") == "complete") * 10 + one(c("has_mx")) * 10
    return F.greatest(F.lit(0), F.least(F.lit(100), 60 + sure + F.when(c("dns_mx_valid"), 5).when(~c("dns_mx_valid"), -15).otherwise(0)))


def run_source_reliability() -> Column:
    """Mean trust of three named sources, of each association, and of a seed sheet; up to ten points for their number."""
    trust = tables.RUN_SOURCE_SCORES
    named = F.array_compact(F.array(*[F.when(c(f) != "", F.coalesce(lookup(trust, c(f)), F.lit(50))) for f in ("firmographic_source", "tech_source", "enrichment_source")], F.when(c("source_url").contains("xlsx_seed"), trust["xlsx_seed"])))
    members = F.transform(F.filter(F.coalesce("associations", F.array().cast("array<string>")), lambda x: x != ""), lambda _: F.lit(trust["association"]))
    known = F.concat(named, members)
    n = F.size(known)
    mean = F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / n
    return F.when(n == 0, 50.0).otherwise(F.least(F.lit(100.0), mean + F.least(F.lit(10), n * 2)))


def field_points(schema: T.StructType) -> Column:
    """Points of the fields that hold something, 100 at most: texts that aren't blank, lists that aren't empty, numbers above zero. Fields
    that the rows lack give none."""

    def some(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.ArrayType):
            return F.size(c(f.name)) > 0
        return c(f.name) > 0 if isinstance(f.dataType, T.NumericType) else has_value(c(f.name))

    points = [one(some(f)) * tables.FIELD_POINTS[f.name] for f in schema if f.name in tables.FIELD_POINTS]
    return F.least(F.lit(100), total([F.lit(0), *points]))


def all_text() -> Column:
    """Technologies, mail services and ERP in one lower-case text."""
    return F.concat_ws(" ", F.transform(F.concat(text_list(c("tech_stack")), text_list(c("spf_services"))), lambda x: F.lower(x)), F.lower(F.trim(F.coalesce("erp_system", F.lit("")))))


def detect_competitor(text: Column) -> Column:
    """The first competitor of the table that is named anywhere in the text, in title case; empty if none is."""

    def first(text: Column) -> Column:
        out = None
        for name, aliases in tables.COMPETITORS.items():
            named = reduce(lambda a, b: a | b, [text.contains(a) for a in aliases])
            out = F.when(named, F.lit(name)) if out is None else out.when(named, F.lit(name))
        return out.otherwise("")

    return F.initcap(F.transform(F.array(text), first)[0])  # the text is made once, not for each alias


def icp_dimensions() -> dict[str, Column]:
    """Six parts of the fit score."""
    provider = F.lower(F.coalesce("email_provider", F.lit("")))
    low = lambda name: F.transform(text_list(c(name)), lambda x: F.lower(x))
    any_of = lambda arr, *names: F.arrays_overlap(arr, F.array(*[F.lit(n) for n in names]))
    spf, tech = low("spf_services"), low("tech_stack")
    mail = (
        F.when(provider.contains("microsoft 365"), 10)
        .when(provider.contains("proofpoint") | provider.contains("mimecast"), 8)
        .when(provider.contains("google workspace"), 5)
        .when(provider.isin("self-hosted", "self-hosted (on-premise)", "other"), 12)
        .when(provider == "", 3)
        .otherwise(0)
    )
    services = F.when(any_of(spf, "salesforce", "pardot"), 5).when(any_of(spf, "hubspot", "marketo", "activecampaign"), 3).otherwise(0)
    sends = one(any_of(spf, "mailchimp", "constant contact", "sendgrid", "amazon ses")) * 2
    cdn = one(any_of(tech, "cloudflare", "akamai", "amazon cloudfront")) * 2
    people = F.when(F.coalesce("employee_count_max", F.lit(0)) != 0, c("employee_count_max")).otherwise(F.coalesce("employee_count_min", F.lit(0)))
    state = F.upper(F.trim(F.coalesce("state", F.lit(""))))
    members = text_list(c("associations"))
    erp, text = F.lower(F.trim(F.coalesce("erp_system", F.lit("")))), all_text()
    rival = detect_competitor(text) != ""
    data = F.least(F.lit(10), one(c("n_contacts") > 0) * 4 + one(F.coalesce("phone", F.lit("")) != "") * 2 + one(c("enrichment_status") == "complete") * 2 + one(c("quality_score") >= 80) * 2)
    return {
        "tech_maturity": F.least(F.lit(25), mail + services + sends + cdn),
        "size_fit": F.when(people.between(50, 500), 20).when((people >= 25) & (people < 50), 15).when((people > 500) & (people <= 1000), 12).when((people >= 10) & (people < 25), 8).when(people > 1000, 5).when(people == 0, 10).otherwise(0),
        "geo_fit": F.when(state.isin(tables.HIGH_STATES), 15).when(state.isin(tables.MED_STATES), 12).when(F.length(state) == 2, 10).when(state != "", 5).otherwise(7),
        "assoc_engagement": F.when(F.size(members) >= 3, 15).when(F.size(members) == 2, 12).when(F.upper(F.get(members, F.lit(0))).isin(tables.HIGH_ASSOCIATIONS), 10).when(F.size(members) == 1, 7).otherwise(0),
        "tech_gap": F.when((erp == "") & ~rival, 15).when(rival, 5).otherwise(0),
        "data_quality": data,
    }


def assign_tier(icp: Column, has_contacts: Column, quality: Column) -> Column:
    return F.when((icp >= 75) & has_contacts & (quality >= 70), "Tier 1").when(icp >= 55, "Tier 2").when(icp >= 35, "Tier 3").otherwise("Unqualified")


def tech_maturity() -> Column:
    """Up to 20 points each for site system, analytics, delivery network, framework and mail marketing."""
    low = lambda name: F.transform(text_list(c(name)), lambda x: F.lower(x))
    tech, spf, cms = low("tech_stack"), low("spf_services"), F.lower(F.coalesce("cms", F.lit("")))
    any_of = lambda arr, *names: F.arrays_overlap(arr, F.array(*[F.lit(n) for n in names]))
    site = F.when(cms.contains("hubspot"), 14).when(cms.contains("drupal"), 10).when(cms.contains("wordpress"), 8).when(cms.contains("squarespace") | cms.contains("wix"), 6).when(cms != "", 4).otherwise(0)
    tags = any_of(tech, "google tag manager")
    analytics = (
        F.when(any_of(tech, "adobe dtm", "adobe launch"), F.when(tags, 12).otherwise(10))
        .when(any_of(tech, "hotjar", "heap"), F.when(tags, 10).otherwise(8))
        .when(any_of(tech, "google analytics"), F.when(tags, 8).otherwise(6))
        .otherwise(0)
    )
    network = F.when(any_of(tech, "cloudflare", "akamai", "amazon cloudfront"), 20).otherwise(0)
    framework = F.when(any_of(tech, "react", "angular", "vue.js", "next.js", "nuxt.js"), 20).when(any_of(tech, "jquery"), 6).otherwise(0)
    mail = F.when(any_of(spf, "hubspot", "marketo", "pardot"), 20).when(any_of(spf, "mailchimp", "sendgrid"), 10).otherwise(0)
    return F.least(F.lit(100), site + analytics + network + framework + mail)


def tech_tier(score: Column, known: Column) -> Column:
    return F.when(~known, "Unknown").when(score >= 70, "Modern").when(score >= 40, "Transitional").otherwise("Legacy")


def email_security_score(mx: Column, provider: Column, spf: Column, policy: Column) -> Column:
    """MX 20, a professional provider 15, SPF 25, DMARC 25 and 15 or 10 for its policy."""
    professional = (F.coalesce(provider, F.lit("")) != "") & ~provider.isin("Self-hosted", "Other")
    dmarc = F.when(policy.isNull(), 0).when(policy == "Strict (reject)", 40).when(policy == "Moderate (quarantine)", 35).otherwise(25)
    return F.least(F.lit(100), one(mx) * 20 + one(professional) * 15 + one(spf) * 25 + dmarc)


def classify_market(count: Column, average: Column) -> Column:
    return F.when((count >= 50) & (average >= 60), "Hot Market").when((count >= 20) & (average >= 50), "Opportunity Market").when(count >= 5, "Emerging").otherwise("Developing")


def hiring_signal(jobs: Column, urgent: Column) -> Column:
    return F.when(jobs == 0, "none").when((jobs >= 10) | (urgent >= 2), "high").when(jobs >= 4, "active").otherwise("low")


def segment_rules() -> dict[str, Column]:
    """The fifteen segments; a company may be in many."""
    low = lambda name: F.transform(text_list(c(name)), lambda x: F.lower(x))
    tech, spf, provider = low("tech_stack"), low("spf_services"), F.lower(F.coalesce("email_provider", F.lit("")))
    any_of = lambda arr, *names: F.arrays_overlap(arr, F.array(*[F.lit(n) for n in names]))
    holds = lambda arr, *parts: F.exists(arr, lambda x: reduce(lambda a, b: a | b, [x.contains(p) for p in parts]))
    site = F.trim(F.coalesce("website", F.lit(""))) != ""
    most, least = F.coalesce("employee_count_max", F.lit(0)), F.coalesce("employee_count_min", F.lit(0))
    return {
        "Salesforce Users": any_of(spf, "salesforce", "pardot"),
        "Legacy Email (On-Prem)": provider.isin("self-hosted", "self-hosted (on-premise)", "other", ""),
        "Microsoft 365 Stack": F.coalesce("email_provider", F.lit("")) == "Microsoft 365",
        "Marketing Automation Users": any_of(spf, *tables.MARKETING),
        "Small Manufacturers": (most > 0) & (most <= 100) & site,
        "Large Manufacturers": least >= 500,
        "PMA Premium Members": F.upper(F.coalesce("membership_tier", F.lit(""))).isin("PLATINUM", "GOLD"),
        "WordPress Manufacturers": F.lower(F.coalesce("cms", F.lit(""))).contains("wordpress"),
        "Cloudflare CDN Users": holds(tech, "cloudflare"),
        "WooCommerce (eCommerce)": holds(tech, "woocommerce"),
        "Multi-Association Members": F.size(text_list(c("associations"))) >= 2,
        "Analytics-Mature": holds(tech, "google analytics") & holds(tech, "google tag manager", "adobe", "hotjar", "heap", "mixpanel", "segment"),
        "No Email Provider": (provider == "") & site,
        "Security-Conscious": provider.isin("proofpoint", "mimecast", "barracuda"),
        "Publicly Traded": c("publicly_traded"),
    }


def campaign_rules() -> dict[str, Column]:
    """Six campaigns' targets."""
    low = F.transform(text_list(c("spf_services")), lambda x: F.lower(x))
    provider, rival = F.lower(F.coalesce("email_provider", F.lit(""))), detect_competitor(all_text())
    people = F.coalesce("employee_count_max", F.lit(0)) + F.coalesce("employee_count_min", F.lit(0))
    return {
        "microsoft": provider.contains("microsoft 365"),
        "legacy_mail": provider.isin("self-hosted", "self-hosted (on-premise)", "other"),
        "salesforce": F.arrays_overlap(low, F.array(F.lit("salesforce"), F.lit("pardot"))),
        "association": F.array_contains(text_list(c("associations")), "PMA"),
        "greenfield": (F.trim(F.coalesce("erp_system", F.lit(""))) == "") & (rival == "") & (people > 0),
        "competitive": rival != "",
    }
