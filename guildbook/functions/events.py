"""Dates and places of events, and table headers, from texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from guildbook.functions.tables import STATE_CODES

# Month names; the first three letters tell them apart.
MONTHS = {"jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12}
_MONTH = r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?"
# Headers of member tables and the fields they hold.
HEADERS = {
    "company": "company_name", "company name": "company_name", "name": "company_name", "member": "company_name", "member name": "company_name",
    "organization": "company_name", "city": "city", "state": "state", "st": "state", "province": "state", "country": "country", "phone": "phone",
    "telephone": "phone", "email": "email", "e-mail": "email", "website": "website", "web": "website", "url": "website",
    "membership": "membership_tier", "membership type": "membership_tier", "type": "membership_tier", "joined": "member_since", "member since": "member_since",
    "year joined": "member_since",
}
# A table of members has a name and one of these.
BESIDE_A_NAME = ["city", "state", "phone", "email", "website"]


def _month(c: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])[F.lower(F.left(c, F.lit(3)))]


def _date(year: Column, month: Column, day: Column) -> Column:
    """A date of texts or numbers, null for what is none."""
    return F.try_to_timestamp(F.concat(year.cast("string"), F.lit("-"), month.cast("string"), F.lit("-"), day.cast("string")), F.lit("yyyy-M-d")).cast("date")


def told_date(text: Column) -> Column:
    """The date that a tag or structured data states, whatever time follows: 2025-03-04, 2025/3/4, 20250304, March 4, 2025, 4th of Mar 2025,
    3/4/2025 (the month first, unless it can't be one). Other texts, and days that don't exist, are null."""
    t = F.regexp_replace(F.trim(text), r"(?i)^(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?,?\s+", "")
    got = lambda p, k: F.nullif(F.regexp_extract(t, p, k), F.lit(""))
    after = r"(?:\D.*)?$"
    year_first, plain = r"(?s)^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})" + after, r"(?s)^(\d{4})(\d{2})(\d{2})" + after
    month_first, day_first = "(?s)^" + _MONTH + r"\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})" + after, r"(?s)^(\d{1,2})(?:st|nd|rd|th)?(?:\s+of)?\s+" + _MONTH + r",?\s+(\d{4})" + after
    numbers = r"(?s)^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})" + after
    iso = F.coalesce(*[_date(got(p, 1), got(p, 2), got(p, 3)) for p in (year_first, plain)])
    words = F.coalesce(_date(got(month_first, 3), _month(got(month_first, 1)), got(month_first, 2)), _date(got(day_first, 3), _month(got(day_first, 2)), got(day_first, 1)))
    first, second = got(numbers, 1), got(numbers, 2)
    return F.coalesce(iso, words, _date(got(numbers, 3), first, second), _date(got(numbers, 3), second, first))


def event_dates(text: Column) -> Column:
    """(start, end): a range of days, a range over months, else the first two single dates, in the first 2000 characters."""
    t = F.left(text, F.lit(2000))
    days, months = _MONTH + r"\s+(\d{1,2})\s*[-–]\s*(\d{1,2}),?\s+(\d{4})", _MONTH + r"\s+(\d{1,2})\s*[-–]\s*([a-z]+)\s+(\d{1,2}),?\s+(\d{4})"
    d = lambda p, k: F.regexp_extract(t, p, k)
    one = F.struct(_date(d(days, 4), _month(d(days, 1)), d(days, 2)).alias("start"), _date(d(days, 4), _month(d(days, 1)), d(days, 3)).alias("end"))
    two = F.struct(_date(d(months, 5), _month(d(months, 1)), d(months, 2)).alias("start"), _date(d(months, 5), _month(d(months, 3)), d(months, 4)).alias("end"))
    word, iso = _MONTH + r"\s+(\d{1,2}),?\s+(\d{4})", r"(\d{4})[-/](\d{1,2})[-/](\d{1,2})"
    words = F.transform(F.regexp_extract_all(t, F.lit(word), F.lit(0)), lambda x: _date(F.regexp_extract(x, word, 3), _month(F.regexp_extract(x, word, 1)), F.regexp_extract(x, word, 2)))
    isos = F.transform(F.regexp_extract_all(t, F.lit(iso), F.lit(0)), lambda x: _date(F.regexp_extract(x, iso, 1), F.regexp_extract(x, iso, 2), F.regexp_extract(x, iso, 3)))
    pair = lambda a: F.struct(F.get(a, F.lit(0)).alias("start"), F.get(a, F.lit(1)).alias("end"))
    return F.when(t.rlike(days), one).when(t.rlike(months), two).when(F.size(words) > 0, pair(words)).otherwise(pair(isos))


def location(text: Column) -> Column:
    """(venue, city, state, virtual): "City, ST", a state's full name, else the text itself if it is short."""
    t = F.trim(text)
    codes, names = "|".join(STATE_CODES.values()), "|".join(n.title() for n in STATE_CODES)
    place = rf"([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*),?\s*({codes})\b"
    city, code, full = F.regexp_extract(t, place, 1), F.regexp_extract(t, place, 2), F.regexp_extract(t, f"({names})", 1)
    state = F.when(code != "", code).when(full != "", F.create_map(*[F.lit(x) for n, s in STATE_CODES.items() for x in (n.title(), s)])[full])
    return F.struct(
        F.when(state.isNull() & (F.length(t) < 100), t).alias("venue"), F.when(code != "", city).alias("city"), state.alias("state"), F.lower(t).rlike("virtual|online|webinar").alias("virtual")
    )


def address_block(text: Column) -> Column:
    """(street, city, state, zip) of lines that end with "CITY, ST ZIP"."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    last, pattern = F.element_at(F.when(F.size(lines) > 0, lines).otherwise(F.array(F.lit(""))), -1), r"^(.*?),?\s+([A-Z]{2})\s+(\d{5}(?:-\d{4})?)$"
    got = lambda k: F.nullif(F.regexp_extract(last, pattern, k), F.lit(""))
    street = F.array_join(F.slice(lines, 1, F.greatest(F.size(lines) - 1, F.lit(0))), ", ")
    return F.struct(F.nullif(street, F.lit("")).alias("street"), F.initcap(got(1)).alias("city"), got(2).alias("state"), got(3).alias("zip"))


def map_headers(header: Column, values: Column) -> Column:
    """A row of a member table as a map of fields; headers without a field, and empty values, are left out."""
    table = F.create_map(*[F.lit(x) for pair in HEADERS.items() for x in pair])
    fields = F.transform(header, lambda h: table[F.lower(F.trim(h))])
    # Of two headers with one field the last value that isn't empty stands.
    pairs = F.filter(F.arrays_zip(fields.alias("field"), F.transform(values, lambda v: F.trim(v)).alias("value")), lambda p: p["field"].isNotNull() & (p["value"] != ""))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["field"] == p["field"]))
    return F.map_from_entries(last)


def member_rows(table: Column) -> Column:
    """The members of a table (rows of texts, the first its header) as an array of maps: only of tables with a name and one field
    of BESIDE_A_NAME; rows of another length than the header, and rows without a name, are left out."""
    header = F.get(table, F.lit(0))
    known = F.create_map(*[F.lit(x) for pair in HEADERS.items() for x in pair])
    fields = F.transform(header, lambda h: known[F.lower(F.trim(h))])
    is_member = F.array_contains(fields, "company_name") & F.arrays_overlap(fields, F.array(*[F.lit(x) for x in BESIDE_A_NAME]))
    rows = F.transform(F.filter(F.slice(table, 2, F.greatest(F.size(table) - 1, F.lit(0))), lambda r: F.size(r) == F.size(header)), lambda r: map_headers(header, r))
    named = F.filter(rows, lambda m: F.map_contains_key(m, F.lit("company_name")))
    return F.when(F.coalesce(is_member, F.lit(False)), named).otherwise(F.array().cast("array<map<string,string>>"))
