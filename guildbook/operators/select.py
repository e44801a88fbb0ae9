"""Filters, checks and look-ups over tables of companies, contacts and participants."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guildbook.functions.text import extract_domain, has_value, text_list

c = F.col


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def filter_export(
    df: DataFrame,
    min_quality: float | None = None,
    associations: list[str] | None = None,
    has_contacts: bool = False,
    has_email: bool = False,
    has_erp: bool = False,
    states: list[str] | None = None,
    industries: list[str] | None = None,
) -> DataFrame:
    """Rows that meet every filter given. As soon as one is given, min_quality is 60 unless it is given too."""
    rules = []
    if associations:
        rules.append(F.arrays_overlap(text_list(c("associations")), F.array(*[F.lit(a) for a in associations])))
    if has_contacts:
        rules.append(c("n_contacts") > 0)
    if has_email:
        rules.append(has_value(c("email")))
    if has_erp:
        rules.append(has_value(c("erp_system")))
    if states:
        rules.append(c("state").isin(states))
    if industries:
        rules.append(c("industry").isin(industries))
    if rules or min_quality is not None:
        rules.append(F.coalesce(c("quality_score"), F.lit(0)) >= (60 if min_quality is None else min_quality))
    return df.filter(_all(rules))


def search(df: DataFrame, state: str | None = None, industry: str | None = None, erp: str | None = None, min_quality: float | None = None, limit: int = 100, offset: int = 0) -> DataFrame:
    """A page of the rows that equal what is given, best quality first, then by company_id."""
    rules = [c(name) == value for name, value in (("state", state), ("industry", industry), ("erp_system", erp)) if value is not None]
    if min_quality is not None:
        rules.append(c("quality_score") >= min_quality)
    return df.filter(_all(rules)).orderBy(F.desc("quality_score"), "company_id").offset(offset).limit(limit)


def quality_gate(df: DataFrame, min_score: float = 60) -> DataFrame:
    """Rows of at least min_score; without a score none."""
    return df.filter(F.coalesce(c("quality_score"), F.lit(0)) >= min_score)


def _listed(df: DataFrame, key: str, rules: dict[str, Column], name: str) -> DataFrame:
    return df.select(key, F.explode(F.array_compact(F.array(*[F.when(bad, label) for label, bad in rules.items()]))).alias(name))


def check_contract(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """A row for each rule that a record breaks. rules: what is wrong, and when it is; unknown doesn't count."""
    return _listed(df, key, {label: F.coalesce(bad, F.lit(False)) for label, bad in rules.items()}, "violation")


def split_rejects(df: DataFrame, key: str, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Records that break no rule, and the others with their violations."""
    broken = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), label) for label, bad in rules.items()]))
    marked = df.withColumn("violations", broken)
    return marked.filter(F.size("violations") == 0).drop("violations"), marked.filter(F.size("violations") > 0)


def company_contract() -> dict[str, Column]:
    """Required fields, lengths and ranges of a company record."""
    name = F.trim(F.coalesce("company_name", F.lit("")))
    return {
        "company_name missing": name == "",
        "company_name too long": F.length(name) > 255,
        "website without scheme": has_value(c("website")) & ~c("website").rlike("^https?://"),
        "state too long": F.length("state") > 50,
        "employee_count_min below 0": c("employee_count_min") < 0,
        "employee_count_max below min": (c("employee_count_max") > 0) & (c("employee_count_max") < c("employee_count_min")),
        "year_founded out of range": ~c("year_founded").between(1800, 2100),
        "quality_score out of range": ~c("quality_score").between(0, 100),
        "email without @": has_value(c("email")) & ~c("email").contains("@"),
    }


def check_provenance(df: DataFrame, key: str) -> DataFrame:
    """What a record lacks of its origin: source_url and extracted_at, each unless it has a provenance."""
    known = has_value(c("provenance"))
    return _listed(df, key, {f: ~has_value(c(f)) & ~known for f in ("source_url", "extracted_at")}, "missing")


def require_labels(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """A row for each of the fields that a record lacks."""
    return _listed(df, key, {f: ~has_value(c(f)) for f in fields}, "missing")


def needs_enrichment() -> Column:
    """What is left to look up for a company: nothing, its name service only, all, or nothing that could be."""
    return F.when(c("enrichment_status") == "complete", "done").when(extract_domain(c("website")) == "", "no_domain").when(has_value(c("tech_stack")), "dns_only").otherwise("full")


def work_priority(df: DataFrame, address: str = "city", limit: int | None = None) -> DataFrame:
    """Companies that lack a phone or an address, in the order of what they lack (0: both, 1: phone, 2: address); others are done."""
    no_phone, no_place = ~has_value(c("phone")), ~has_value(c(address))
    ranked = df.withColumn("priority", F.when(no_phone & no_place, 0).when(no_phone, 1).when(no_place, 2).otherwise(3)).filter("priority < 3")
    ordered = ranked.orderBy("priority", "company_id")
    return ordered if limit is None else ordered.limit(limit)


def enrichment_gaps() -> Column:
    """The fields that a company lacks, as one text."""
    lacking = {"website": ~has_value(c("website")), "phone": ~has_value(c("phone")), "contacts": c("n_contacts") == 0, "erp": ~has_value(c("erp_system"))}
    return F.array_join(F.array_compact(F.array(*[F.when(bad, name) for name, bad in lacking.items()])), ", ")


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Rows whose field equals the value; the filter reaches the scan."""
    return df.filter(c(key) == value)


def by_domain(df: DataFrame, domain: str) -> DataFrame:
    return df.filter(extract_domain(c("website")) == domain.lower())


def by_name(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.lower("company_name") == name.lower())


def participants_of(df: DataFrame, event_id, kind: str | None = None) -> DataFrame:
    """An event's participants, or those of one kind, such as its sponsors."""
    rows = df.filter(c("event_id") == event_id)
    return rows if kind is None else rows.filter(c("kind") == kind)
