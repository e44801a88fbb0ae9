"""Events out of pages: one of a page of its own, several of a list. A helper finds the texts; columns read dates, places and kinds."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guildbook.functions import events as ev
from guildbook.functions.text import event_type
from guildbook.operators.discovery import resolve
from guildbook.operators.participants import _Event
from guildbook.operators.per_page import each_page

c = F.col

# Classes of containers, in order, and words of links for registration, in order.
CONTAINERS = ["event[-_]?item|event[-_]?card|event[-_]?listing", "calendar[-_]?item|calendar[-_]?event"]
REGISTER = ["register", "sign up", "rsvp", "attend", "buy ticket"]
FIELDS = ["title", "start", "end", "dates", "place", "about", "link", "data"]


class _Page(_Event):
    """Elements, the first block of structured data, and what is asked of single events and lists."""

    data: str | None = None

    def handle_data(self, data):
        if self.open and self.data is None and (row := self.rows[self.open[-1]])["tag"] == "script" and row["attrs"].get("type") == "application/ld+json":
            self.data = data
        super().handle_data(data)

    def meta(self, name: str, by: str = "property") -> str | None:
        return next((r["attrs"].get("content") or None for r in self.rows if r["tag"] == "meta" and r["attrs"].get(by) == name), None)

    def first(self, pattern: str) -> str | None:
        return next((self.whole(i) for i in self.marked(pattern)), None)

    def tagged(self, tag: str, after: int = 0) -> int | None:
        return next((i for i in range(after, len(self.rows)) if self.rows[i]["tag"] == tag), None)

    def single(self) -> dict:
        head, name = self.tagged("h1"), self.tagged("title")
        title = self.meta("og:title") or (self.text(head) if head is not None else None if name is None else re.sub(r"\s*[-|]\s*.+$", "", self.text(name)).strip())
        below = None if head is None else self.tagged("p", head)
        links = [(self.text(i).lower(), r["attrs"].get("href")) for i, r in enumerate(self.rows) if r["tag"] == "a"]
        return {
            "title": title, "start": self.meta("event:start_time") or self.meta("startDate"), "end": self.meta("event:end_time") or self.meta("endDate"),
            "dates": self.first("date|when|time") or "".join(self.pieces), "place": self.first("location|venue|place|address"),
            "about": self.meta("description", "name") or self.first("description|summary|about") or (None if below is None else self.text(below)),
            "link": next((href for word in REGISTER for text, href in links if word in text and href), None), "data": self.data,
        }

    def boxes(self) -> list[int]:
        tags = {"div", "article", "li"}
        for some in [*(self.marked(p) for p in CONTAINERS), [i for i, r in enumerate(self.rows) if "data-event" in r["attrs"]], self.marked("Event", attribute="itemtype")]:
            if len(some := [i for i in some if self.rows[i]["tag"] in tags]) >= 2:
                return some
        for i, r in enumerate(self.rows):
            if r["tag"] == "table" and len(lines := self.within(i, {"tr"})) >= 3:
                return lines[1:]
        return next((items for i in self.marked("event|calendar") if self.rows[i]["tag"] in {"ul", "ol"} and len(items := self.within(i, {"li"})) >= 2), [])

    def listed(self):
        for i in self.boxes():
            heads = self.within(i, {"h1", "h2", "h3", "h4"})
            named = set(self.marked("title|name", range(i + 1, self.rows[i]["last"])))
            links = self.within(i, {"a"})
            k = next(iter([x for x in self.within(i, {"h1", "h2", "h3", "h4", "a"}) if x in named] or heads or links), None)
            if k is not None and len(self.text(k)) >= 3:
                link = k if self.rows[k]["tag"] == "a" else next(iter(links), None)
                text = self.whole(i)
                yield {"title": self.text(k), "dates": text, "place": self.classed(i, "location|venue|place"), "about": text, "link": None if link is None else self.rows[link]["attrs"].get("href")}


def _told(path: str) -> Column:
    return F.nullif(F.get_json_object("data", path), F.lit(""))


def extract_events(pages: DataFrame, key: str, url: str, page_type: str, html: str = "html") -> DataFrame:
    """(key, turn, title, event_type, start_date, end_date, venue, city, state, country, virtual, event_url, registration_url): of a page of
    its own (EVENT_DETAIL) one event, by structured data, else by tags and texts; of a list (EVENTS_LIST) one for each container. Dates are
    those of structured data, else of tags, else of the text; a start or an end that can't be read leaves both to the next. Events without a
    title, other pages and nulls give no rows."""

    def one(base, what, text):
        page = _Page()
        page.feed(text or "")
        page.close()
        return [(base, what, turn, *[x.get(f) for f in FIELDS]) for turn, x in enumerate([page.single()] if what == "EVENT_DETAIL" else page.listed())]

    asked = pages.filter(c(page_type).isin("EVENT_DETAIL", "EVENTS_LIST"))
    raw = each_page(asked, [key], [url, page_type, html], one, "_base string, _kind string, turn int, " + ", ".join(f"`{f}` string" for f in FIELDS))
    def span(start, end):
        """The dates of a start and an end, null if one of them can't be read."""
        begun, over = ev.told_date(start), ev.told_date(end)
        return F.when(begun.isNotNull() & (end.isNull() | over.isNotNull()), F.struct(begun.alias("start"), over.alias("end")))

    read, there, own = ev.event_dates(F.coalesce("dates", F.lit(""))), ev.location(c("place")), _told("$.location").startswith("{")
    dates = F.coalesce(span(_told("$.startDate"), _told("$.endDate")), span(c("start"), c("end")), read)
    rows = raw.withColumns({"_dates": dates, "_place": there, "_own": F.coalesce(own, F.lit(False)), "title": F.coalesce(_told("$.name"), c("title"))}).filter("title <> ''")
    part = lambda path, other: F.when(c("_own"), _told(path)).otherwise(other)
    single = c("_kind") == "EVENT_DETAIL"
    virtual = F.when(c("_own"), F.lower(_told("$.location")).contains("virtual")).otherwise(F.coalesce("_place.virtual", F.lit(False)))
    return rows.select(
        key, "turn", "title", event_type(c("title"), F.left(c("about"), F.when(single, 500).otherwise(F.length("about")))).alias("event_type"),
        c("_dates.start").alias("start_date"), c("_dates.end").alias("end_date"),
        part("$.location.name", c("_place.venue")).alias("venue"), part("$.location.address.addressLocality", c("_place.city")).alias("city"), part("$.location.address.addressRegion", c("_place.state")).alias("state"),
        F.coalesce(part("$.location.address.addressCountry", F.lit(None).cast("string")), F.lit("United States")).alias("country"), virtual.alias("virtual"),
        F.when(single, c("_base")).otherwise(resolve(c("link"), c("_base"))).alias("event_url"), F.when(single, resolve(c("link"), c("_base"))).alias("registration_url"),
    )
