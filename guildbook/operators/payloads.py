"""Answers of data providers, as raw JSON in a column, into flat columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col

#: What is read of each provider's answer.
SCHEMAS = {
    "clearbit": "metrics struct<employees:long,estimatedAnnualRevenue:string>, foundedYear int, category struct<naicsCode:string,industry:string>, linkedin struct<handle:string>",
    "apollo": "organization struct<estimated_num_employees:long,founded_year:int,industry:string,linkedin_url:string>",
    "zoominfo": "data array<struct<employeeCount:long,revenueInMillions:double,yearFounded:int,naicsCode:string>>",
    "builtwith": "Results array<struct<Result:struct<Paths:array<struct<Technologies:array<struct<Name:string,Categories:array<string>>>>>>>>",
    "apollo_people": "people array<struct<name:string,title:string,email:string,phone_numbers:array<struct<number:string>>,linkedin_url:string>>",
    "hunter": "data struct<emails:array<struct<value:string,first_name:string,last_name:string,position:string,phone_number:string,linkedin:string>>>",
}


def _parsed(df: DataFrame, key: str, raw: str, provider: str) -> DataFrame:
    return df.select(key, F.from_json(c(raw), SCHEMAS[provider]).alias("x"))


def _revenue(text: Column) -> Column:
    """The first number of a text with its unit (K, M or B) as a whole number."""
    pattern = r"(?i)\$?(\d+(?:\.\d+)?)\s*([MBK])?"
    number, unit = F.regexp_extract(text, pattern, 1), F.upper(F.regexp_extract(text, pattern, 2))
    times = F.when(unit == "B", 1e9).when(unit == "M", 1e6).when(unit == "K", 1e3).otherwise(1.0)
    return F.when(number != "", number.try_cast("double") * times).cast("long")


def firmographics(df: DataFrame, key: str, raw: str, provider: str) -> DataFrame:
    """(key, employee_count_min, employee_count_max, revenue_min_usd, year_founded, naics_code, industry, linkedin_url,
    firmographic_source) of clearbit, apollo or zoominfo; what a provider doesn't tell is null (zoominfo's revenue: 0)."""
    none = F.lit(None).cast("string")
    first = F.get("x.data", F.lit(0))
    handle = F.nullif(c("x.linkedin.handle"), F.lit("")) if provider == "clearbit" else None
    employees, revenue, year, naics, industry, link = {
        "clearbit": lambda: (c("x.metrics.employees"), _revenue(c("x.metrics.estimatedAnnualRevenue")), c("x.foundedYear"), c("x.category.naicsCode"), c("x.category.industry"), F.concat(F.lit("https://linkedin.com/company/"), handle)),
        "apollo": lambda: (c("x.organization.estimated_num_employees"), none, c("x.organization.founded_year"), none, c("x.organization.industry"), c("x.organization.linkedin_url")),
        "zoominfo": lambda: (first["employeeCount"], F.coalesce(first["revenueInMillions"], F.lit(0.0)) * 1e6, first["yearFounded"], first["naicsCode"], none, none),
    }[provider]()
    return _parsed(df, key, raw, provider).select(
        key, employees.alias("employee_count_min"), employees.alias("employee_count_max"), revenue.cast("long").alias("revenue_min_usd"), year.alias("year_founded"),
        naics.alias("naics_code"), industry.alias("industry"), link.alias("linkedin_url"), F.lit(provider).alias("firmographic_source"),
    )


def technologies(df: DataFrame, key: str, raw: str, most: int = 20) -> DataFrame:
    """(key, tech_stack, erp_system, crm_system, tech_source): the first `most` names of all results' paths, and the last names whose
    categories speak of ERP and of CRM."""
    paths = F.flatten(F.transform(F.coalesce("x.Results", F.array()), lambda r: F.coalesce(r["Result"]["Paths"], F.array())))
    found = _parsed(df, key, raw, "builtwith").select(key, F.flatten(F.transform(paths, lambda p: F.coalesce(p["Technologies"], F.array()))).alias("t"))
    last = lambda word: F.try_element_at(F.filter("t", lambda x: F.exists(F.coalesce(x["Categories"], F.array()), lambda k: k.contains(word))), F.lit(-1))["Name"]
    return found.select(key, F.slice(F.transform("t", lambda x: x["Name"]), 1, most).alias("tech_stack"), last("ERP").alias("erp_system"), last("CRM").alias("crm_system"), F.lit("builtwith").alias("tech_source"))


def provider_contacts(df: DataFrame, key: str, raw: str, provider: str) -> DataFrame:
    """(key, turn, name, title, email, phone, linkedin_url, source): a row for each person of apollo or hunter."""
    if provider == "apollo":
        rows = _parsed(df, key, raw, "apollo_people").select(key, F.posexplode("x.people").alias("turn", "p"))
        name, title, email, phone, link = c("p.name"), c("p.title"), c("p.email"), F.get("p.phone_numbers", F.lit(0))["number"], c("p.linkedin_url")
    else:
        rows = _parsed(df, key, raw, provider).select(key, F.posexplode("x.data.emails").alias("turn", "p"))
        some = lambda x: F.nullif(x, F.lit(""))
        name = some(F.trim(F.concat_ws(" ", "p.first_name", "p.last_name")))
        title, email, phone, link = some(c("p.position")), c("p.value"), some(c("p.phone_number")), some(c("p.linkedin"))
    return rows.select(key, "turn", name.alias("name"), title.alias("title"), email.alias("email"), phone.alias("phone"), link.alias("linkedin_url"), F.lit(provider).alias("source"))
