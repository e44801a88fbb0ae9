"""Facts from a table of fetched pages or texts: kinds of pages, access, technologies, mentions, contacts, links."""

from __future__ import annotations

import hashlib
import re
from functools import reduce
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guildbook.functions import page_tables, tables
from guildbook.functions.text import extract_domain, squeeze
from guildbook.operators.per_page import each_page

c = F.col


def labels(pairs: list[tuple[Column, str]]) -> Column:
    """The labels whose conditions hold, each once."""
    return F.array_distinct(F.array_compact(F.array(*[F.when(held, label) for held, label in pairs])))


def html_to_text(html: Column) -> Column:
    """Styles, scripts and tags out, blanks collapsed."""
    out = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    return squeeze(F.regexp_replace(out, "(?s)<[^>]*>", " "))


def url_path(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-z]+://[^/?#]*([^?#]*)", 1))


def classify_by_url(url: Column) -> Column:
    """(kind, confidence): the first kind whose patterns the path meets."""
    path, out = url_path(url), F
    for kind, pattern in tables.PATH_KINDS.items():
        out = out.when(path.rlike(pattern), kind)
    kind = out.otherwise("OTHER")
    return F.struct(kind.alias("kind"), F.when(kind == "OTHER", 0.1).otherwise(0.4).alias("confidence"))


def access_flags(html: Column, status: Column | None = None) -> Column:
    """Whether a page wants a login or payment or forbids collecting, and the verdict."""
    low = F.lower(html)
    held = lambda phrases: reduce(lambda a, b: a | b, [low.contains(p) for p in phrases])
    login = held(tables.LOGIN_PHRASES) | low.rlike(r'<input[^>]*type=["\']?password')
    pay, terms = held(tables.PAYWALL_PHRASES), reduce(lambda a, b: a | b, [low.rlike(p) for p in tables.TERMS])
    denied = F.coalesce(status.isin(401, 403), F.lit(False)) if status is not None else F.lit(False)
    verdict = F.when(denied, "denied").when(login, "login").when(pay, "paywall").when(terms, "terms").otherwise("open")
    return F.struct(login.alias("login"), pay.alias("paywall"), terms.alias("terms"), verdict.alias("verdict"))


def fingerprint_tech(html: Column, powered_by: Column | None = None, server: Column | None = None) -> Column:
    """Technologies that a page's text and the two response headers show, each once."""
    sources = [(F.lower(html), page_tables.TECHNOLOGIES)]
    sources += [(F.lower(header), parts) for header, parts in ((powered_by, page_tables.POWERED_BY), (server, page_tables.SERVERS)) if header is not None]
    return labels([(text.contains(part), name) for text, parts in sources for part, name in parts.items()])


def site_system(generator: Column) -> Column:
    """The site system that a generator tag names; null if none is known."""
    low, out = F.lower(generator), F
    for part, name in page_tables.GENERATORS.items():
        out = out.when(low.contains(part), name)
    return out.otherwise(F.lit(None).cast("string"))


def certifications(text: Column) -> Column:
    return labels([(text.rlike(p), name) for p, name in page_tables.CERTIFICATES.items()])


def capabilities(text: Column) -> Column:
    return labels([(text.rlike(p), name) for p, name in page_tables.CAPABILITIES.items()])


def mail_provider(hosts: Column, domain: Column) -> Column:
    """The provider of the first mail host, in order of preference, that is known; self-hosted if a host's name holds the own domain."""
    known = F.array_compact(F.transform(hosts, lambda h: reduce(lambda o, kv: o.when(F.lower(h).contains(kv[0]), kv[1]), page_tables.MAIL_HOSTS.items(), F).otherwise(F.lit(None).cast("string"))))
    own = F.exists(hosts, lambda h: F.lower(h).contains(domain))
    return F.when(F.size(hosts) == 0, None).when(F.size(known) > 0, F.get(known, F.lit(0))).when(own, "Self-hosted").otherwise("Other")


def spf_services(txt: Column) -> Column:
    return labels([(F.lower(txt).contains(part), name) for part, name in page_tables.SPF_SERVICES.items()])


def dmarc(txt: Column) -> Column:
    """(policy, report address) of a DMARC record."""
    policy = F.lower(F.regexp_extract(txt, r"(?i)\bp=(none|quarantine|reject)", 1))
    named = reduce(lambda out, kv: out.when(policy == kv[0], kv[1]), page_tables.DMARC_POLICIES.items(), F)
    return F.struct(named.alias("policy"), F.nullif(F.regexp_extract(txt, r"(?i)rua=mailto:([^;,\s]+)", 1), F.lit("")).alias("report"))


def about_facts(text: Column) -> Column:
    """Employees (1 to 500,000), year of foundation (1800 on) and revenue (100,000 on): the first pattern whose first match is in range."""
    low = F.lower(text)
    found = lambda p: F.try_to_number(F.replace(F.regexp_extract(low, p, 1), F.lit(","), F.lit("")), F.lit("999999999")).cast("long")
    within = lambda x, a, b: F.when(x.between(a, b), x)
    people = F.coalesce(*[within(found(p), 1, 500_000) for p in page_tables.PEOPLE_PATTERNS])
    year = F.coalesce(*[within(found(p), 1800, F.year(F.current_date())) for p in page_tables.YEAR_PATTERNS])

    def money(p):
        unit = F.left(F.regexp_extract(low, p, 2), F.lit(1))
        return (F.try_to_number(F.regexp_extract(low, p, 1), F.lit("999999999999.999999")).cast("double") * F.when(unit == "b", 1e9).when(unit == "m", 1e6).otherwise(1.0)).cast("long")

    revenue = F.coalesce(*[within(money(p), 100_000, 1 << 62) for p in page_tables.REVENUE_PATTERNS])
    return F.struct(people.alias("employees"), year.cast("int").alias("founded"), revenue.alias("revenue"))


def phones(text: Column) -> Column:
    """US phone numbers of ten or eleven digits, in order."""
    found = F.regexp_extract_all(text, F.lit(r"(?<![\d])(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]\d{4}(?!\d)"), F.lit(0))
    bare = F.transform(found, lambda x: F.regexp_replace(x, r"\D", ""))
    return F.filter(bare, lambda x: F.length(x).isin(10, 11))


def count_mentions(df: DataFrame, key: str, text: Column, aliases: dict[str, list[str]]) -> DataFrame:
    """(key, competitor, mentions) of texts that name one. One test for all aliases comes first, so most texts are left at once."""
    every = "|".join(a for group in aliases.values() for a in group)
    hits = df.select(key, F.lower(text).alias("_t")).filter(c("_t").rlike(rf"\b({every})\b"))
    counts = F.array(*[F.struct(F.lit(n).alias("competitor"), F.regexp_count("_t", F.lit(rf"\b({'|'.join(sorted(group, key=len, reverse=True))})\b")).alias("mentions")) for n, group in aliases.items()])
    return hits.select(key, F.inline(counts)).filter("mentions > 0")


def mine_signals(df: DataFrame, key: str, text: str, aliases: dict[str, list[str]], window: int = 150, most: int = 100, exact: list[str] | None = None) -> DataFrame:
    """A row for every mention, at most `most` per text in the order of competitors, then places: the text about it (with dots where it
    is cut), the kind of signal by patterns near by (2 points each) and at the start of the text (1 point), and a confidence (0.7, 0.1
    more for an alias as such, 0.05 for each sure word near by, at most 0.95). The texts are read once for all competitors, and their starts once for
    all mentions."""
    low = F.lower(c(text))
    patterns = {name: rf"\b({'|'.join(sorted(group, key=len, reverse=True))})\b" for name, group in aliases.items()}
    held = df.select(key, c(text).alias("_text"), low.alias("_low")).filter(c("_low").rlike("|".join(f"(?:{p})" for p in patterns.values())))

    def hits(turn: int, name: str, pattern: str) -> Column:
        """Places of one competitor's mentions: the text before the n-th is what lies between the mentions before it, and these."""
        gaps = F.transform(F.split("_low", pattern, -1), lambda p: F.length(p))
        found = F.regexp_extract_all("_low", F.lit(pattern), F.lit(0))
        whole = F.array(F.struct(gaps.alias("g"), found.alias("f")))

        def places(x):
            before = lambda i: F.aggregate(F.slice(x["g"], 1, i + 1), F.lit(0), lambda a, y: a + y) + F.aggregate(F.slice(x["f"], 1, i), F.lit(0), lambda a, y: a + F.length(y))
            return F.transform(F.slice(x["f"], 1, most), lambda hit, i: F.struct(F.lit(turn).alias("turn"), before(i).alias("at"), F.lit(name).alias("competitor"), hit.alias("hit")))

        return F.flatten(F.transform(whole, places))

    near_by = [p for near in page_tables.SIGNAL_KINDS.values() for p in near]
    held = held.withColumn("_head", F.left("_low", F.lit(2000))).withColumn("_heads", F.array(*[c("_head").rlike(p) for p in near_by])).drop("_head")
    every = F.slice(F.concat(*[hits(i, name, p) for i, (name, p) in enumerate(patterns.items())]), 1, most)
    rows = held.select(key, "_text", "_heads", F.inline(every))
    begin, end = F.greatest(F.lit(0), c("at") - window), F.least(F.length("_text"), c("at") + F.length("hit") + window)
    context = squeeze(F.substring(c("_text"), begin + 1, end - begin))
    context = F.concat(F.when(begin > 0, "...").otherwise(""), context, F.when(end < F.length("_text"), "...").otherwise(""))
    out = rows.withColumn("context", context).withColumn("_near", F.lower("context"))
    kinds = []
    for i, (kind, near) in enumerate(page_tables.SIGNAL_KINDS.items()):
        points = reduce(lambda a, b: a + b, [F.when(c("_near").rlike(p), 2).when(c("_heads")[near_by.index(p)], 1).otherwise(0) for p in near])
        kinds.append(F.struct(points.alias("points"), F.lit(-i).alias("turn"), F.lit(kind).alias("kind")))
    best = F.array_max(F.array(*kinds))
    named = c("hit").isin(exact if exact is not None else [a for group in aliases.values() for a in group])
    sure = reduce(lambda a, b: a + b, [F.when(c("_near").contains(w), 5).otherwise(0) for w in page_tables.SURE_WORDS])
    confidence = F.least(F.lit(95), 70 + F.when(named, 10).otherwise(0) + sure) / 100.0
    return out.withColumn("_best", best).select(key, "competitor", "at", "context", F.when(c("_best.points") > 0, c("_best.kind")).otherwise("MEMBER_USAGE").alias("kind"), confidence.cast("double").alias("confidence"))


def _most_named(low: Column, table: dict[str, list[str]]) -> Column:
    """The name whose words occur most, two at least; the first of the table on ties."""
    counted = []
    for i, (name, words) in enumerate(table.items()):
        n = reduce(lambda a, b: a + b, [(F.length(low) - F.length(F.replace(low, F.lit(w.lower()), F.lit("")))) / len(w) for w in words])
        counted.append(F.struct(n.cast("int").alias("n"), F.lit(-i).alias("turn"), F.lit(name).alias("name")))
    best = F.array_max(F.array(*counted))
    return F.when(best["n"] >= 2, best["name"])


def erp_from_text(text: Column) -> Column:
    """The ERP vendor that a text names most, twice at least."""
    return _most_named(F.lower(text), page_tables.ERP_WORDS)


def systems_from_text(text: Column) -> Column:
    """(erp, crm): the CRM vendor only where no ERP is found."""
    erp = erp_from_text(text)
    return F.struct(erp.alias("erp"), F.when(erp.isNull(), _most_named(F.lower(text), page_tables.CRM_WORDS)).alias("crm"))


def text_blocks(df: DataFrame, key: str, text: str) -> DataFrame:
    """Entries of a plain-text directory: blocks between blank lines, the first line the name. Each other line gives one thing: a phone,
    else an email, else a website, else a place ("City, ST"); of several lines the last counts."""
    blocks = df.select(key, F.posexplode(F.split(c(text), r"\n\s*\n")).alias("block", "_b")).withColumn("_lines", F.transform(F.split(F.trim("_b"), "\n"), lambda x: F.trim(x)))
    blocks = blocks.filter((F.size("_lines") >= 2) & ~c("_lines")[0].rlike(r"(?i)^(page|member|directory|table)") & ~c("_lines")[0].rlike(r"^\d+$") & (c("_lines")[0] != ""))
    rules = {name: page_tables.LINES[name] for name in ("phone", "email", "website", "place")}

    def kind_of(line: Column) -> Column:
        return reduce(lambda out, kv: out.when(line.rlike(kv[1]), kv[0]), rules.items(), F).otherwise("")

    lines = F.transform(F.slice("_lines", 2, F.size("_lines")), lambda x: F.struct(kind_of(x).alias("kind"), x.alias("line")))
    blocks = blocks.withColumn("_kinds", lines)
    last = lambda kind: F.try_element_at(F.filter("_kinds", lambda x: x["kind"] == kind), F.lit(-1))["line"]
    place = last("place")
    return blocks.select(
        key, "block", c("_lines")[0].alias("name"),
        F.regexp_replace(F.regexp_extract(last("phone"), rules["phone"], 0), r"\D", "").alias("phone"),
        F.lower(F.regexp_extract(last("email"), rules["email"], 0)).alias("email"),
        F.regexp_extract(last("website"), rules["website"], 0).alias("website"),
        F.trim(F.regexp_extract(place, rules["place"], 1)).alias("city"), F.regexp_extract(place, rules["place"], 2).alias("state"),
    )


class _Page(HTMLParser):
    """Collects what the page operators read: title, headings, anchors, tags with classes, structured data, visible text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.h1, self.anchors, self.tags, self.meta, self.blocks, self.text = "", [], [], [], {}, [], []
        self.counts: dict[str, int] = {}
        self.boxes: list[bool] = []  # of each open element whether it or one around it is a box of members
        self.label_of_button: list[str] = []
        self.row_links = -1  # links so far in the table row at hand
        self.open: list[str] = []
        self.href: str | None = None
        self.label: list[str] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        self.tags.append(f"{tag}.{'.'.join(sorted((a.get('class') or '').split()))}")
        classes = a.get("class") or ""
        names = [tag, *[k for k, p in CLASS_KINDS.items() if classes and p.search(classes)]]
        if classes and tag in ("li", "tr", "div"):
            names += ["classed", f"classed {tag}"]
        if tag == "form" and re.search("register|signup|rsvp", a.get("action") or "", re.I):
            names.append("sign_up")
        if "data-infinite-scroll" in a or "data-next-page" in a:
            names.append("endless")
        for name in names:
            self.counts[name] = self.counts.get(name, 0) + 1
        if tag == "tr":
            self.row_links = 0
        if tag == "meta":
            self.meta[a.get("name") or a.get("property") or ""] = a.get("content") or ""
        elif tag == "a":
            self.href, self.label, self.marks = a.get("href"), [], (classes, bool(self.boxes and self.boxes[-1]), self.row_links == 0)
            self.row_links += self.row_links >= 0 and self.href is not None
        if tag not in ("meta", "br", "img", "link", "input", "hr"):
            self.open.append(tag)
            self.boxes.append("box" in names or bool(self.boxes and self.boxes[-1]))
            if tag == "script" and a.get("type") == "application/ld+json":
                self.open[-1] = "ld"
            if tag == "h1":
                self.h1.append("")

    def handle_endtag(self, tag):
        if tag == "a" and self.href is not None:
            classes, boxed, first = self.marks
            self.anchors.append({"href": self.href, "text": " ".join("".join(self.label).split()), "classes": classes, "boxed": boxed, "row_first": first})
            self.href = None
        if tag == "button" and re.search(r"(load|show|view)\s*more", "".join(self.label_of_button), re.I):
            self.counts["more"] = self.counts.get("more", 0) + 1
        if tag == "tr":
            self.row_links = -1
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k] == tag or tag == "script" and self.open[k] == "ld":
                del self.open[k:], self.boxes[k:]
                break

    def handle_data(self, data):
        if "ld" in self.open:
            self.blocks.append(data)
        elif "script" in self.open or "style" in self.open:
            return
        elif "title" in self.open:
            self.title += data
        else:
            if "h1" in self.open and self.h1:
                self.h1[-1] += data
            if self.href is not None:
                self.label.append(data)
            if "button" in self.open:
                self.label_of_button.append(data)
            if data.strip():
                self.text.append(" ".join(data.split()))


#: Kinds of elements by their classes.
CLASS_KINDS = {
    "box": re.compile("member-|company-|directory-|listing-|result-", re.I), "card": re.compile("member|company|listing|result|profile-card", re.I),
    "listed": re.compile("member|company|listing|result", re.I), "directory": re.compile("member|company|directory", re.I), "event": re.compile("event|conference|webinar|calendar", re.I),
    "sponsor": re.compile("platinum|gold|silver|bronze|sponsor", re.I), "exhibitor": re.compile("exhibitor|booth", re.I),
}
ANCHOR = "struct<href:string,text:string,classes:string,boxed:boolean,row_first:boolean>"
PARSED = f"title string, h1 array<string>, anchors array<{ANCHOR}>, structure string, blocks array<string>, generator string, text string, counts map<string,int>"


def parse_page(df: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """Each page parsed once; other operators read the columns. Null pages are empty."""

    def one(text):
        p = _Page()
        p.feed(text or "")
        p.close()
        yield " ".join(p.title.split()), [" ".join(x.split()) for x in p.h1], p.anchors, hashlib.sha256("|".join(p.tags).encode()).hexdigest(), p.blocks, p.meta.get("generator", ""), " ".join(p.text), p.counts

    return each_page(df, keys, [html], one, PARSED)


def external_members(parsed: DataFrame, key: str, url: str) -> DataFrame:
    """Links to other hosts with their texts, the first of each host on a page; social networks left out."""
    social = "facebook|twitter|linkedin|instagram|youtube|pinterest|google"
    links = parsed.select(key, extract_domain(c(url)).alias("_own"), F.posexplode("anchors").alias("turn", "a"))
    links = links.select(key, "_own", "turn", c("a.text").alias("name"), c("a.href").alias("website")).filter(c("website").rlike("^https?://"))
    links = links.withColumn("host", extract_domain(c("website"))).filter((c("host") != c("_own")) & ~c("host").rlike(social) & (c("name") != ""))
    return links.groupBy(key, "host").agg(F.min_by(F.struct("name", "website"), "turn").alias("x")).select(key, "host", F.regexp_replace("x.name", r"[*†‡]+$", "").alias("name"), "x.website")


def contact_facts(html: Column, text: Column) -> Column:
    """Phone, address, employees, year of foundation and map link of a page. The address: that of the first <address> with over ten letters;
    without a city there, the first "City, ST 12345" of the text whose city has at most 22 letters and three words; else only a ZIP."""
    squeezed = lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))
    none = lambda x: F.nullif(x, F.lit(""))
    boxes = F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<address[^>]*>(.*?)</address>"), F.lit(1)), lambda x: squeezed(F.regexp_replace(x, "<[^>]+>", " ")))
    box = F.get(F.filter(boxes, lambda x: F.length(x) > 10), F.lit(0))
    place = page_tables.PLACE_PATTERN
    street_at, street = F.regexp_instr(box, F.lit(page_tables.STREET_PATTERN)), F.regexp_extract(box, page_tables.STREET_PATTERN, 0)
    begin = F.greatest(F.lit(1), street_at - 2)
    around = F.trim(F.substring(box, begin, street_at + F.length(street) + 30 - begin))
    parts = F.arrays_zip(*[F.regexp_extract_all(text, F.lit(place), F.lit(k)).alias(n) for k, n in ((1, "city"), (2, "state"), (3, "zip"))])
    fits = lambda p: (p["zip"] != "") & F.length(F.trim(p["city"])).between(2, 22) & (F.size(F.split(squeezed(p["city"]), " ")) <= 3)
    told = F.get(F.filter(parts, fits), F.lit(0))
    in_box = none(F.trim(F.regexp_extract(box, place, 1)))
    where = lambda k, n: F.when(in_box.isNotNull(), none(F.regexp_extract(box, place, k))).otherwise(told[n])
    number = lambda p, low, high: F.get(F.filter(F.transform(F.regexp_extract_all(text, F.lit(p), F.lit(1)), lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("int")), lambda x: x.between(low, high)), F.lit(0))
    called = F.filter(F.regexp_extract_all(text, F.lit(page_tables.PHONE_PATTERN), F.lit(0)), lambda x: F.length(F.regexp_replace(x, r"\D", "")).isin(10, 11))
    return F.struct(
        F.trim(F.get(called, F.lit(0))).alias("phone"),
        F.when(street_at > 0, F.left(F.trim(F.element_at(F.split(around, r"\|"), 1)), F.lit(100))).alias("street"),
        F.initcap(squeezed(F.coalesce(in_box, told["city"]))).alias("city"),
        F.upper(where(2, "state")).alias("state"),
        F.coalesce(where(3, "zip"), told["zip"], none(F.regexp_extract(text, page_tables.ZIP_PATTERN, 1))).alias("zip"),
        number(page_tables.STAFF_PATTERN, 1, 500_000).alias("employees"),
        number(page_tables.FOUNDED_PATTERN, 1800, 2024).alias("founded"),
        F.coalesce(*[none(F.regexp_extract(html, p, 1)) for p in page_tables.MAP_PATTERNS]).alias("map_url"),
    )
