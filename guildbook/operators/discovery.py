"""What a parsed page leads to: member links, further pages, and what kind of page it is."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guildbook.functions import page_tables
from guildbook.operators.pages import classify_by_url

c = F.col


def resolve(href: Column, base: Column) -> Column:
    """A link as an address of its own, from the page it stands on. Steps up ("..") are left as they are."""
    root, folder = F.regexp_extract(base, r"^([a-z]+://[^/?#]*)", 1), F.regexp_extract(base, r"^([a-z]+://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    inside = F.when(folder == root, F.concat(root, F.lit("/"))).otherwise(folder)
    return (
        F.when(href.rlike("(?i)^[a-z][a-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, "^([a-z]+:)", 1), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("?"), F.concat(page, href))
        .otherwise(F.concat(inside, href))
    )


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://([^/?#]*)", 1)


def member_links(parsed: DataFrame, key: str, url: str) -> DataFrame:
    """(key, member_url): links within the page's host that a member's path, the link's class, a box of members around it, or its place
    as the first in a table row speak for; each once."""
    a = parsed.select(key, c(url).alias("_base"), F.explode("anchors").alias("a")).select(key, "_base", "a.*")
    skip = reduce(lambda x, y: x | y, [F.lower("href").rlike(p) for p in page_tables.SKIP_LINKS])
    member = c("href").rlike("(?i)/member/|/company/|/profile/|/organization/") | c("classes").rlike("(?i)member|company|profile|listing") | c("boxed") | c("row_first")
    links = a.filter(~skip & member).select(key, "_base", resolve(c("href"), c("_base")).alias("member_url"))
    return links.filter(host(c("member_url")) == host(c("_base"))).select(key, "member_url").distinct()


def detect_pagination() -> Column:
    """(kind, param, counts) of a parsed page: how further pages are addressed. kind: query, path, endless, more or none; counts:
    what the parameter counts (page, count or offset)."""
    links = F.transform("anchors", lambda x: x["href"])
    first = lambda pattern: F.get(F.filter(links, lambda h: h.rlike(pattern)), F.lit(0))
    said = lambda pattern: F.get(F.filter("anchors", lambda x: x["text"].rlike(pattern)), F.lit(0))["href"]
    out = lambda kind, param=None, counts=None: F.struct(F.lit(kind).alias("kind"), (F.lit(None).cast("string") if param is None else param).alias("param"), F.lit(counts).cast("string").alias("counts"))
    queries = [(r"\?(page|p)=\d+", "page"), (r"\?(n|count|limit)=\d+", "count"), (r"\?(offset)=\d+", "offset")]
    rules = [(first(p).isNotNull(), out("query", F.regexp_extract(first(p), p, 1), counts)) for p, counts in queries]
    rules.append((first(r"/page[-/]?\d+").isNotNull(), out("path")))
    rules.append((F.coalesce(c("counts")["endless"], F.lit(0)) > 0, out("endless")))
    more = F.exists("anchors", lambda x: x["text"].rlike(r"(?i)(load|show|view)\s*more"))
    rules.append(((F.coalesce(c("counts")["more"], F.lit(0)) > 0) | more, out("more")))
    ahead = said("(?i)^next$|^>$|^>>$")
    rules.append((ahead.rlike("[?&](page|p)=") & F.lower(ahead).contains("page"), out("query", F.regexp_extract(ahead, "[?&](page|p)=", 1), "page")))
    return reduce(lambda x, rule: x.when(*rule), rules, F).otherwise(out("none"))


def page_urls(df: DataFrame, key: str, url: str, pages: int, step: int = 100) -> DataFrame:
    """(key, page, page_url) of the first pages of every directory, by its column `pagination` (detect_pagination). Directories without
    pages have one."""
    p = c("pagination")
    many = p["kind"].isin("query", "path")
    rows = df.select("*", F.explode(F.sequence(F.lit(1), F.when(many, pages).otherwise(1))).alias("page"))
    n = F.when(p["counts"] == "offset", (c("page") - 1) * step).when(p["counts"] == "count", c("page") * step).otherwise(c("page")).cast("string")
    bare, query = F.regexp_extract(c(url), r"^([^?#]*)", 1), F.regexp_extract(c(url), r"\?([^#]*)", 1)
    others = F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.startswith(F.concat(p["param"], F.lit("="))))
    asked = F.concat(bare, F.lit("?"), F.array_join(F.concat(others, F.array(F.concat(p["param"], F.lit("="), n))), "&"))
    stepped = F.concat(F.regexp_replace(F.regexp_replace(c(url), r"/page[-/]?\d+", ""), "/+$", ""), F.lit("/page/"), n)
    return rows.select(key, "page", F.when(p["kind"] == "query", asked).when(p["kind"] == "path", stepped).otherwise(c(url)).alias("page_url"))


def _count(name: str) -> Column:
    return F.coalesce(c("counts")[name], F.lit(0))


def looks_like_directory() -> Column:
    """At least two of four: it says so, many links, an element of members, many elements with classes."""
    low = F.lower("text")
    signs = [low.contains("member") & (low.contains("directory") | low.contains("list")), F.size("anchors") > 20, _count("directory") > 0, _count("classed") > 10]
    return reduce(lambda a, b: a + b, [F.when(x, 1).otherwise(0) for x in signs]) >= 2


def estimate_members() -> Column:
    """A number that the text gives (10 to 50,000; the first pattern in range), else the number of elements like members."""
    low = F.lower("text")
    told = [F.try_to_number(F.regexp_extract(low, p, 1), F.lit("999999999")).cast("int") for p in (r"(\d{1,5})\s*members?", r"showing\s*(\d{1,9})", r"total[:\s]+(\d{1,9})", r"(\d{1,9})\s*results?", r"(\d{1,9})\s*companies")]
    explicit = F.coalesce(*[F.when(x.between(10, 50_000), x) for x in told])
    counted = F.when(_count("listed") >= 10, _count("listed")).when(_count("tr") > 5, _count("tr") - 1).when(_count("classed li") >= 10, _count("classed li")).otherwise(0)
    return F.coalesce(explicit, counted)


def classify_page(parsed: DataFrame, url: str) -> DataFrame:
    """parsed with page_type, confidence and extractor: words in title (0.3), headings (0.25) and the first 5,000 characters (0.1) and
    the elements of the page against the kind that its address tells. Both agreeing sum up to 0.98; else the surer one stands."""
    title, heads, body = F.lower("title"), F.lower(F.array_join("h1", " ")), F.lower(F.left("text", F.lit(5000)))
    add = lambda parts: reduce(lambda a, b: a + b, parts)
    few = F.when(_count("event") > 3, "EVENTS_LIST").when(_count("event") > 0, "EVENT_DETAIL").otherwise("")
    extra = {  # in hundredths
        "MEMBER_DIRECTORY": F.when(_count("li") > 20, 20).otherwise(0) + F.when(_count("card") > 5, 25).otherwise(0),
        "MEMBER_DETAIL": F.when(_count("card") == 1, 30).otherwise(0),
        "EVENTS_LIST": F.when(few == "EVENTS_LIST", 25).otherwise(0),
        "EVENT_DETAIL": F.when(few == "EVENT_DETAIL", 20).otherwise(0) + F.when(_count("sign_up") > 0, 20).otherwise(0),
        "EXHIBITORS_LIST": F.when(_count("exhibitor") > 0, 30).otherwise(0),
        "SPONSORS_LIST": F.when(_count("sponsor") > 0, 30).otherwise(0),
        "PARTICIPANTS_LIST": F.lit(0),
    }
    scores = []
    for i, (kind, words) in enumerate(page_tables.PAGE_WORDS.items()):
        points = add([F.when(title.contains(w), 30).otherwise(0) + F.when(heads.contains(w), 25).otherwise(0) + F.when(body.contains(w), 10).otherwise(0) for w in words]) + extra[kind]
        scores.append(F.struct(points.alias("points"), F.lit(-i).alias("turn"), F.lit(kind).alias("kind")))
    # The scores are computed once, as a column, and read twice.
    rows = parsed.withColumn("_best", F.array_max(F.array(*scores))).withColumn("_path", classify_by_url(c(url)))
    content = F.when(c("_best.points") > 0, c("_best.kind")).otherwise("OTHER")
    sure = F.when(c("_best.points") > 0, F.least(F.lit(95), c("_best.points"))).otherwise(10)
    told = F.round(100 * c("_path.confidence")).cast("int")
    kind = F.when((c("_path.kind") == content) | (told >= sure), c("_path.kind")).otherwise(content)
    confidence = F.when(c("_path.kind") == content, F.least(F.lit(98), told + sure)).otherwise(F.greatest(told, sure)) / 100.0
    rows = rows.withColumn("page_type", kind).withColumn("confidence", confidence.cast("double"))
    extractor = reduce(lambda out, kv: out.when(c("page_type") == kv[0], kv[1]), page_tables.EXTRACTORS.items(), F).otherwise(F.lit(None).cast("string"))
    return rows.withColumn("extractor", extractor).drop("_best", "_path")


def type_distribution(classified: DataFrame) -> DataFrame:
    return classified.groupBy("page_type").agg(F.count("*").alias("n"))


def robots_verdict(urls: DataFrame, robots: DataFrame, url: str, agent: str = "*") -> DataFrame:
    """urls with allowed, crawl_delay and sitemaps by the robots.txt of their host (robots: host, robots_txt); hosts without one allow all.
    A text is parsed once per batch."""

    @F.pandas_udf("allowed boolean, crawl_delay double, sitemaps array<string>")
    def judge(url: pd.Series, text: pd.Series) -> pd.DataFrame:
        from urllib.robotparser import RobotFileParser

        parsers: dict[str | None, RobotFileParser] = {}
        rows = []
        for u, t in zip(url, text, strict=True):
            if t not in parsers:
                parsers[t] = RobotFileParser()
                parsers[t].parse((t or "").splitlines())
            p = parsers[t]
            delay = p.crawl_delay(agent)
            rows.append((p.can_fetch(agent, u or ""), None if delay is None else float(delay), p.site_maps() or []))
        return pd.DataFrame(rows, columns=["allowed", "crawl_delay", "sitemaps"])

    keyed = urls.withColumn("_host", host(c(url))).join(robots.select(c("host").alias("_host"), "robots_txt"), "_host", "left")
    return keyed.withColumn("_v", judge(c(url), c("robots_txt"))).select(*urls.columns, "_v.*")
