"""Names, addresses, numbers and presence of values, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from guildbook.functions import tables

#: What Python's \w leaves out, in a form that Java and RE2 share.
NOT_WORD = r"[^\p{L}\p{N}_\s]"


def lookup(table: dict, key: Column) -> Column:
    """The table's value for a key, null if it has none."""
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[key]


def squeeze(c: Column) -> Column:
    """Blanks collapsed, none at the ends."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def has_value(c: Column, kind: str = "string") -> Column:
    """Present: not null, not a blank string, not an empty list; zero and false count."""
    if kind == "string":
        return F.coalesce(F.trim(c) != "", F.lit(False))
    return F.coalesce(F.size(c) > 0, F.lit(False)) if kind == "array" else c.isNotNull()


def truthy(c: Column, kind: str = "string") -> Column:
    """Python's truth: null, zero, false and what is empty are nothing."""
    if kind == "string":
        return F.coalesce(c != "", F.lit(False))
    return F.coalesce(F.size(c) > 0, F.lit(False)) if kind == "array" else F.coalesce(c.cast("double") != 0, F.lit(False))


def normalize_name(c: Column) -> Column:
    """Lower case, one legal suffix of each group off the end, no punctuation, single blanks."""
    c = F.lower(F.coalesce(c, F.lit("")))
    for pattern in tables.SUFFIXES:
        c = F.regexp_replace(c, pattern, "")
    return squeeze(F.regexp_replace(c, NOT_WORD, ""))


def deep_normalize_name(c: Column) -> Column:
    """Every kind of legal suffix off the end, abbreviations spelled out."""
    c = F.trim(F.lower(F.coalesce(c, F.lit(""))))
    for pattern in tables.DEEP_SUFFIXES:
        c = F.regexp_replace(c, pattern, "")
    words = F.transform(F.split(squeeze(c), " "), lambda w: F.coalesce(lookup(tables.ABBREVIATIONS, w), w))
    return squeeze(F.regexp_replace(F.array_join(words, " "), NOT_WORD, ""))


def normalize_name_script(c: Column) -> Column:
    """One suffix off the end by a single pattern, holdings and group among them."""
    pattern = r"\b(inc\.?|incorporated|corp\.?|corporation|llc|l\.l\.c\.?|ltd\.?|limited|co\.?|company|plc|gmbh|ag|sa|nv|bv|holdings|group)$"
    return squeeze(F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), pattern, ""), NOT_WORD, ""))


def merge_key(c: Column) -> Column:
    """Letters and digits of ASCII only."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")


# Suffixes as written, in the order they are tried.
WRITTEN_SUFFIXES = [
    ", Inc.", ", Inc", " Inc.", " Inc", ", LLC", " LLC", ", Ltd.", ", Ltd", " Ltd.", " Ltd", ", L.P.", " L.P.", " Corp.", " Corp", " Corporation", " Company",
    " Co.", ", Co.", " & Co.", " Group", " Holdings",
]


def strip_one_suffix(c: Column, suffixes: list[str] = WRITTEN_SUFFIXES) -> Column:
    """The first suffix of the list that the name ends with, off, once; the rest in lower case."""
    c = F.trim(F.coalesce(c, F.lit("")))
    return F.lower(F.trim(F.coalesce(*[F.when(c.endswith(s), F.left(c, F.length(c) - len(s))) for s in suffixes], c)))


def with_scheme(c: Column) -> Column:
    return F.when(c.rlike("^https?://"), c).otherwise(F.concat(F.lit("https://"), c))


def extract_domain(c: Column) -> Column:
    """Host in lower case without a leading www., the port kept; empty for nothing."""
    host = F.lower(F.regexp_extract(with_scheme(F.coalesce(c, F.lit(""))), r"^https?://([^/?#]*)", 1))
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("")).otherwise(F.regexp_replace(host, r"^www\.", ""))


def normalize_url(c: Column) -> Column:
    """Scheme, clean host, path without slashes at its end; no query, no fragment."""
    full = with_scheme(F.coalesce(c, F.lit("")))
    path = F.regexp_replace(F.regexp_extract(full, r"^https?://[^/?#]*([^?#]*)", 1), "/+$", "")
    out = F.concat(F.regexp_extract(full, "^(https?)://", 1), F.lit("://"), extract_domain(c), path)
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("")).otherwise(out)


def last_two_labels(host: Column) -> Column:
    """The last two labels of a host in lower case, whatever the country; null as empty."""
    labels = F.split(F.lower(F.coalesce(host, F.lit(""))), r"\.")
    return F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), 2), ".")


def bare_domain(c: Column, country_codes: list[str] = tables.COUNTRY_CODES) -> Column:
    """The last two labels of a host, three under some country codes."""
    host = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    host = F.regexp_replace(F.regexp_extract(host, r"^(?:[a-z][a-z0-9+.-]*://)?([^/]*)", 1), r"^www\.", "")
    labels = F.split(host, r"\.")
    last = lambda n: F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - n + 1), n), ".")
    return F.when(F.element_at(labels, -1).isin(*country_codes), last(3)).otherwise(last(2))


def digits(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[^0-9]", "")


def last_ten(c: Column) -> Column:
    """The last ten digits of a phone number of at least ten, else null."""
    d = digits(c)
    return F.when(F.length(d) >= 10, F.right(d, F.lit(10)))


def normalize_address(city: Column, state: Column, full: Column | None = None) -> Column:
    parts = [F.when(city != "", F.lower(city)), F.when(state != "", F.lower(state))]
    if full is not None:
        parts.append(F.when(full != "", F.regexp_replace(F.lower(full), NOT_WORD, "")))
    return F.concat_ws(" ", *parts)


def parse_field(c: Column, parser: str) -> Column:
    """A named parser of extracted text; what can't be parsed is null."""
    text = F.when(c != "", c)
    rest = F.trim(F.regexp_extract(text, r"^(.*),[^,]*$", 1))
    year = F.regexp_extract(text, r"((?:19|20)\d{2})", 1)
    member = F.regexp_extract(text, r"[?&]id=(\d+)", 1)
    return {
        "title_case": F.initcap(F.trim(text)),
        "state_code": F.coalesce(lookup(tables.STATE_CODES, F.lower(F.trim(text))), F.when(F.length(text) >= 2, F.upper(F.left(text, F.lit(2)))).otherwise(text)),
        "year": F.when(year != "", year),
        "phone": F.regexp_replace(text, r"[^\d+]", ""),
        "email": F.when(text.contains("@"), F.lower(F.trim(text))),
        "url": F.when(text.startswith("http"), text).otherwise(F.concat(F.lit("https://"), text)),
        "integer": F.regexp_replace(text, r"[^\d]", ""),
        "city": F.when(text.contains(","), F.initcap(rest)),
        "state": F.when(text.contains(","), F.left(F.upper(F.trim(F.substring_index(text, ",", -1))), F.lit(2))),
        "member_id": F.when(member != "", member),
    }[parser]


def parse_money(c: Column) -> Column:
    """$12.5M as 12500000: the first number, with K, M or B."""
    found = lambda k: F.regexp_extract(c, r"(?i)\$?(\d+(?:\.\d+)?)\s*([MBK])?", k)
    scale = F.when(F.upper(found(2)) == "K", 1e3).when(F.upper(found(2)) == "M", 1e6).when(F.upper(found(2)) == "B", 1e9).otherwise(1.0)
    return F.when(found(1) != "", F.floor(found(1).cast("double") * scale).cast("long"))


def parse_employee_range(c: Column) -> Column:
    """(least, most) of "50-99"; only the least of "500+"."""
    bare = F.regexp_replace(F.coalesce(c, F.lit("")), ",", "")
    low, high = F.regexp_extract(bare, r"(\d+)", 1), F.regexp_extract(bare, r"\d+\s*-\s*(\d+)", 1)
    return F.struct(F.when(low != "", low).cast("int").alias("least"), F.when(high != "", high).cast("int").alias("most"))


def employee_label(low: Column, high: Column) -> Column:
    """The range with thousands separators; "500+" without an upper end."""
    low, high, shown = F.coalesce(low, F.lit(0)), F.coalesce(high, F.lit(0)), lambda c: F.format_number(c, 0)
    return F.when((low != 0) & (high != 0) & (low != high), F.concat(shown(low), F.lit("-"), shown(high))).when(high != 0, shown(high)).when(low != 0, F.concat(shown(low), F.lit("+"))).otherwise("")


def word_jaccard(a: Column, b: Column) -> Column:
    """Shared words over all words of two texts; 0 if one has none."""
    of = lambda c: F.array_distinct(F.filter(F.split(squeeze(c), " "), lambda w: w != ""))
    union = F.size(F.array_union(of(a), of(b)))
    return F.when((F.size(of(a)) == 0) | (F.size(of(b)) == 0), 0.0).otherwise(F.size(F.array_intersect(of(a), of(b))) / union)


def names_match(a: Column, b: Column) -> Column:
    """Equal without suffixes, one within the other, or half of the shorter's words shared."""
    a, b = normalize_name(a), normalize_name(b)
    words = lambda c: F.array_distinct(F.split(c, " "))
    shared = F.size(F.array_intersect(words(a), words(b))) / F.least(F.size(words(a)), F.size(words(b)))
    return (a != "") & (b != "") & ((a == b) | a.contains(b) | b.contains(a) | (shared >= 0.5))


def text_list(c: Column, separator: str = ";") -> Column:
    """A joined list as an array of its trimmed parts that aren't empty."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), separator), lambda x: F.trim(x)), lambda x: x != "")


# Title patterns and their priority, in order; loose on purpose.
TITLE_PRIORITY = [
    (r"chief information officer|cio", 1), (r"vp?\s*(of\s*)?information technology|vp?\s*(of\s*)?it", 1), (r"it director|director.*\bit\b", 1),
    (r"erp manager|erp administrator", 1), (r"chief operating officer|coo", 1), (r"vp?\s*(of\s*)?operations", 1), (r"chief financial officer|cfo", 2),
    (r"controller|comptroller", 2), (r"ceo|chief executive", 2), (r"president", 2), (r"owner", 2), (r"plant manager", 3),
    (r"vp?\s*(of\s*)?manufacturing", 3), (r"director.*manufacturing", 3), (r"director.*operations", 3),
]
# Keywords of event types and of sponsor tiers, in order.
EVENT_TYPES = {
    "CONFERENCE": ["conference", "summit", "symposium", "congress"], "TRADE_SHOW": ["trade show", "expo", "exhibition", "show"],
    "WEBINAR": ["webinar", "online event", "virtual event", "web conference"], "WORKSHOP": ["workshop", "training", "seminar", "course"],
    "NETWORKING": ["networking", "mixer", "meet and greet", "social"], "ANNUAL_MEETING": ["annual meeting", "annual conference", "annual event"],
    "TRAINING": ["training", "certification", "education"],
}
SPONSOR_TIERS = {
    "PLATINUM": ["platinum", "diamond", "premier", "presenting", "title"], "GOLD": ["gold"], "SILVER": ["silver"], "BRONZE": ["bronze"],
    "PARTNER": ["partner", "strategic", "associate"], "MEDIA": ["media", "press"],
}
# Words that are no one's name.
NO_NAMES = ["Read", "More", "View", "Contact", "About", "Meet", "Our", "Team", "The", "Click", "Here", "Learn", "Get", "Visit", "See", "Home"]


def first_match(text: Column, patterns: list[tuple[str, object]], default) -> Column:
    """The value of the first pattern that a text matches."""
    out = F
    for pattern, value in patterns:
        out = out.when(text.rlike(pattern), value)
    return out.otherwise(default)


def first_word(text: Column, groups: dict[str, list[str]], default: str | None) -> Column:
    """The first group of which a text holds a word."""
    out = F
    for name, words in groups.items():
        held = text.contains(words[0])
        for w in words[1:]:
            held = held | text.contains(w)
        out = out.when(held, name)
    return out.otherwise(default)


def title_priority(c: Column) -> Column:
    """1 to 3 by the first pattern that a title matches, else 999."""
    return first_match(F.lower(F.coalesce(c, F.lit(""))), TITLE_PRIORITY, 999)


def event_type(title: Column, text: Column) -> Column:
    return first_word(F.lower(F.concat_ws(" ", title, text)), EVENT_TYPES, "OTHER")


def sponsor_tier(text: Column) -> Column:
    return first_word(F.lower(text), SPONSOR_TIERS, None)


def looks_like_person(c: Column) -> Column:
    """Two to five words, those of more than a letter with a capital, none of the words that are no name."""
    words = F.split(squeeze(F.coalesce(c, F.lit(""))), " ")
    capital = F.forall(words, lambda w: (F.length(w) <= 1) | w.rlike(r"^\p{Lu}"))
    return F.size(words).between(2, 5) & capital & ~F.arrays_overlap(words, F.array(*[F.lit(s) for s in NO_NAMES]))


def email_candidates(name: Column, domain: Column) -> Column:
    """Six usual forms of a person's address at a domain, the likeliest first; none for a name of one word."""
    words = F.split(squeeze(F.coalesce(name, F.lit(""))), " ")
    only = lambda w: F.regexp_replace(F.lower(w), "[^a-z]", "")
    first, last, initial = only(words[0]), only(F.element_at(words, -1)), only(F.left(words[0], F.lit(1)))
    forms = [F.concat(first, F.lit("."), last), F.concat(initial, last), first, F.concat(first, last), F.concat(first, F.lit("_"), last), F.concat(last, F.lit("."), first)]
    usable = (F.size(words) >= 2) & (first != "") & (last != "") & (domain != "")
    return F.when(usable, F.array(*[F.concat(x, F.lit("@"), domain) for x in forms])).otherwise(F.expr("cast(array() as array<string>)"))
