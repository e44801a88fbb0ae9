"""Sponsors, exhibitors and speakers of event pages. A helper finds the elements; names, tiers, booths and firms are read by columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guildbook.functions.text import SPONSOR_TIERS
from guildbook.operators.discovery import resolve
from guildbook.operators.people import Elements
from guildbook.operators.per_page import each_page

c = F.col

# Words by which a page of participants shows its kind, in order.
KIND_WORDS = {"SPONSOR": ["sponsor"], "EXHIBITOR": ["exhibitor", "booth", "vendor"], "SPEAKER": ["speaker", "presenter", "panelist"]}
RAW = "turn int, kind string, tier string, source string, name string, href string, cells array<string>, text string, category string, title string, company string, topic string"
COLUMNS = [x.split()[0] for x in RAW.split(", ")]


def clean_sponsor_name(name: Column) -> Column:
    """A name without words such as logo; null beyond 2 to 200 characters or if it is only such a word."""
    out = F.trim(F.regexp_replace(name, r"(?i)\s*(logo|image|sponsor|partner)\s*", ""))
    return F.when(F.length(out).between(2, 200) & (F.lower(out) != "photo"), out)


class _Event(Elements):
    """Finds the parts of one page that speak of participants."""

    def within(self, i: int, tags: set[str]) -> list[int]:
        return [k for k in range(i + 1, self.rows[i]["last"]) if self.rows[k]["tag"] in tags]

    def marked(self, pattern: str, span: range | None = None, attribute: str = "class") -> list[int]:
        return [k for k in span or range(len(self.rows)) if re.search(pattern, self.rows[k]["attrs"].get(attribute, ""), re.I)]

    def around(self, i: int, tags: set[str]) -> int | None:
        k = self.rows[i]["parent"]
        while k is not None and self.rows[k]["tag"] not in tags:
            k = self.rows[k]["parent"]
        return k

    def after(self, i: int, tags: set[str]) -> int | None:
        """The next element of these tags beside one."""
        parent = self.rows[i]["parent"]
        k, end = self.rows[i]["last"], len(self.rows) if parent is None else self.rows[parent]["last"]
        while k < end:
            if self.rows[k]["tag"] in tags:
                return k
            k = self.rows[k]["last"]
        return None

    def named(self, i: int, tags: set[str]) -> str | None:
        return next((self.text(k) for k in self.within(i, tags)), None)

    def classed(self, i: int, pattern: str) -> str | None:
        return next((self.text(k) for k in self.marked(pattern, range(i + 1, self.rows[i]["last"]))), None)

    def whole(self, i: int) -> str:
        return "".join(self.pieces[self.rows[i]["from"] : self.rows[i]["to"]])

    def firms(self, box: int, tier: str):
        for k in self.within(box, {"img", "a"}):
            row = self.rows[k]
            if row["tag"] == "a":
                yield {"kind": "SPONSOR", "tier": tier, "source": "link", "name": self.text(k), "href": row["attrs"].get("href")}
            else:
                link = self.around(k, {"a"})
                yield {"kind": "SPONSOR", "tier": tier, "source": "image", "name": row["attrs"].get("alt", ""), "href": None if link is None else self.rows[link]["attrs"].get("href")}

    def sponsors(self):
        heads = [i for i, r in enumerate(self.rows) if r["tag"] in {"h1", "h2", "h3", "h4", "h5", "div", "span"} and r["last"] == i + 1]
        found = []
        for tier, words in SPONSOR_TIERS.items():
            word = "|".join(words)
            boxes = set(self.marked(word))
            for i in heads:
                if re.search(rf"\b({word})\b", self.text(i), re.I):
                    box = self.around(i, {"section", "div"})
                    boxes.add(self.after(i, {"div", "ul", "section"}) if box is None else box)
            found += [x for box in sorted(boxes - {None}) for x in self.firms(box, tier)]
        if not found:
            box = next(iter(self.marked("sponsor") or self.marked("sponsor", attribute="id")), None)
            found = [] if box is None else list(self.firms(box, "OTHER"))
        return found

    def exhibitors(self):
        lines = [r for i, row in enumerate(self.rows) if row["tag"] == "table" for r in self.within(i, {"tr"})[1:]]
        found = []
        for r in lines:
            cells = [self.text(k) for k in self.within(r, {"td", "th"})]
            if cells and len(cells[0]) >= 2:
                found.append({"kind": "EXHIBITOR", "source": "row", "name": cells[0], "cells": cells, "href": self.link(r, lambda h: "http" in h)})
        if found:
            return found
        items = {k for i in self.marked("exhibitor") for k in self.within(i, {"li", "div", "article"})}
        for i in sorted(items or self.marked("exhibitor[-_]?card|vendor[-_]?card|booth[-_]?info")):
            name = self.named(i, {"h3", "h4", "h5", "strong", "b"}) or self.named(i, {"a"})
            if name and len(name) >= 2:
                found.append({"kind": "EXHIBITOR", "source": "item", "name": name, "text": self.whole(i), "category": self.classed(i, "category|type"), "href": self.link(i, lambda h: re.match("https?://", h))})
        return found

    def speakers(self):
        cards = self.marked("speaker[-_]?card|presenter") or [i for i in self.marked("speaker") if self.rows[i]["tag"] in {"article", "div"}]
        for i in cards:
            name = self.classed(i, "name|title") or self.named(i, {"h3", "h4", "h5"})
            if name and len(name) >= 2:
                yield {"kind": "SPEAKER", "source": "card", "name": name, "title": self.classed(i, "title|position|role"), "company": self.classed(i, "company|organization"), "topic": self.classed(i, "presentation|session|topic")}


def _found(page_type: str | None, html: str) -> list[dict]:
    page = _Event()
    page.feed(html)
    page.close()
    parts = {"SPONSOR": page.sponsors, "EXHIBITOR": page.exhibitors, "SPEAKER": page.speakers}
    kind = (page_type or "").removesuffix("S_LIST")
    if kind == "PARTICIPANT":
        low = "".join(page.pieces).lower()
        kind = next((k for k, words in KIND_WORDS.items() if any(w in low for w in words)), kind)
        if kind == "PARTICIPANT":
            return [*page.sponsors(), *page.exhibitors(), *page.speakers()]
    return list(parts[kind]()) if kind in parts else []


def extract_participants(pages: DataFrame, key: str, url: str, page_type: str, html: str = "html") -> DataFrame:
    """(key, kind, tier, company_name, website, booth, category, speaker, title, topic): sponsors by tier (images' texts, then links),
    exhibitors (table rows, else items and cards) and speakers ("Title at Company"), by the page's type (SPONSORS_LIST, EXHIBITORS_LIST,
    SPEAKERS_LIST, PARTICIPANTS_LIST: its words tell). Each sponsor once per tier and page, other equal rows too. Nulls have none."""
    one = lambda base, what, text: [(base, turn, *[x.get(name) for name in COLUMNS[1:]]) for turn, x in enumerate(_found(what, text or ""))]
    raw = each_page(pages, [key], [url, page_type, html], one, f"_base string, {RAW}")
    sponsor, link = c("kind") == "SPONSOR", c("source") == "link"
    raw = raw.filter(~sponsor | (F.length("name") > 2) & ~(link & c("name").rlike("^(http|www)")))
    name = F.when(sponsor & ~link, clean_sponsor_name(c("name"))).otherwise(c("name"))
    in_cell = lambda x: F.when(x.rlike(r"(?i)(booth|stand)\s*#?\s*(\w+)"), F.regexp_extract(x, r"(?i)(?:booth|stand)\s*#?\s*(\w+)", 1)).when(x.rlike(r"^[A-Z]?\d{1,4}[A-Z]?$"), x)
    booth = F.when(c("source") == "row", F.get(F.array_compact(F.transform("cells", in_cell)), F.lit(0))).otherwise(F.nullif(F.regexp_extract("text", r"(?i)(?:booth|stand)\s*#?\s*[:\-]?\s*(\w+)", 1), F.lit("")))
    last = F.try_element_at("cells", F.lit(-1))
    category = F.when(c("source") == "row", F.when((F.size("cells") > 2) & (F.length(last) <= 100), last)).otherwise(c("category"))
    at = F.split("title", " at ")
    split = (c("kind") == "SPEAKER") & (F.coalesce("company", F.lit("")) == "") & F.coalesce(F.size(at) > 1, F.lit(False))
    firm = F.when(c("kind") != "SPEAKER", name).when(split, F.trim(F.get(at, F.lit(1)))).otherwise(F.coalesce(F.nullif("company", F.lit("")), F.lit("Unknown")))
    site = F.when(link, resolve(c("href"), c("_base"))).when(sponsor, F.when(c("href").startswith("http"), c("href"))).otherwise(c("href"))
    rows = raw.select(
        key, "turn", "kind", "tier", firm.alias("company_name"), site.alias("website"), booth.alias("booth"), category.alias("category"), F.when(c("kind") == "SPEAKER", c("name")).alias("speaker"),
        F.when(split, F.trim(F.get(at, F.lit(0)))).otherwise(c("title")).alias("title"), "topic",
    ).filter("company_name is not null")
    rest = ["website", "booth", "category", "speaker", "title", "topic"]
    same = [c(key), c("kind"), c("tier"), F.lower("company_name").alias("_low"), F.when(~sponsor, c("turn")).alias("_turn")]
    once = rows.groupBy(*same).agg(F.min_by(F.struct("company_name", *rest), "turn").alias("x"))
    return once.select(key, "kind", "tier", "x.*")
