"""People of team pages: from cards, else from the text."""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import DataFrame

from guildbook.functions import job_tables
from guildbook.operators.per_page import each_page

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Elements(HTMLParser):
    """The elements of a page in order, each with the last element and the last piece of text inside."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.pieces: list[str] = []
        self.open: list[int] = []
        self.there: dict[str, int] = {}  # open elements by tag, so that an end without a beginning costs no search

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        row = {"tag": tag, "attrs": a, "classes": a.get("class", "").split(), "parent": self.open[-1] if self.open else None, "from": len(self.pieces), "last": None, "to": None}
        self.rows.append(row)
        self.added(row, len(self.rows) - 1)
        if tag in VOID:
            self._shut(len(self.rows) - 1)
        else:
            self.open.append(len(self.rows) - 1)
            self.there[tag] = self.there.get(tag, 0) + 1

    def added(self, row: dict, i: int) -> None:
        """Called with each new element, before it can end."""

    def _shut(self, i: int):
        self.rows[i]["last"], self.rows[i]["to"] = len(self.rows), len(self.pieces)

    def handle_endtag(self, tag):
        if not self.there.get(tag):
            return
        while self.open:
            i = self.open.pop()
            self.there[self.rows[i]["tag"]] -= 1
            self._shut(i)
            if self.rows[i]["tag"] == tag:
                return

    def handle_data(self, data):
        if not self.open or self.rows[self.open[-1]]["tag"] not in ("script", "style"):
            self.pieces.append(data)

    def close(self):
        super().close()
        while self.open:
            self._shut(self.open.pop())

    def inside(self, i: int, place: str) -> int | None:
        """The first element of a tag, or with a leading dot of a class, inside another."""
        for k in range(i + 1, self.rows[i]["last"]):
            row = self.rows[k]
            if row["tag"] == place or place[0] == "." and place[1:] in row["classes"]:
                return k
        return None

    def text(self, i: int) -> str:
        return "".join(x.strip() for x in self.pieces[self.rows[i]["from"] : self.rows[i]["to"]])

    def link(self, i: int, test) -> str | None:
        return next((r["attrs"]["href"] for r in self.rows[i + 1 : self.rows[i]["last"]] if r["tag"] == "a" and test(r["attrs"].get("href", ""))), None)


def _titled(text: str) -> bool:
    return 0 < len(text) <= 100 and any(w in text.lower() for w in job_tables.TITLE_WORDS)


def _person(page: Elements, i: int) -> dict | None:
    named = ((k, page.text(k)) for place in job_tables.NAME_PLACES if (k := page.inside(i, place)) is not None)
    name = next((text for _, text in named if len(text.split()) >= 2 and len(text) < 50), None)
    if name is None:
        return None
    head = page.inside(i, job_tables.NAME_PLACES[0])
    titles = (page.text(k) for place in job_tables.TITLE_PLACES if (k := page.inside(i, place)) is not None and k != head)
    mail = (page.link(i, lambda h: h.startswith("mailto:")) or "").replace("mailto:", "").split("?")[0].lower()
    phone = re.sub(r"[^\d+]", "", page.link(i, lambda h: h.startswith("tel:")) or "")
    return {
        "name": name, "title": next((t for t in titles if _titled(t)), None), "email": mail if "@" in mail else None,
        "phone": phone if len(phone) >= 10 else None, "linkedin_url": page.link(i, lambda h: "linkedin.com" in h),
    }


def people_of(html: str) -> list[dict]:
    """The people of one page."""
    page = Elements()
    page.feed(html)
    page.close()
    for word, whole in job_tables.PERSON_CARDS:
        cards = [i for i, r in enumerate(page.rows) if (word in r["classes"] if whole else word in r["attrs"].get("class", ""))]
        if found := [x for i in cards if (x := _person(page, i))]:
            return found
    pairs = re.findall(job_tables.NAME_AND_TITLE, "".join(page.pieces))
    return [{"name": n.strip(), "title": t.strip(), "email": None, "phone": None, "linkedin_url": None} for n, t in pairs if _titled(t)][:10]


def extract_people(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, turn, name, title, email, phone, linkedin_url): people of each page, from the first kind of card that gives any, else up to
    ten from its text ("Name, Title"). A card has a name of two words at least. Null pages have none. Cards within cards count apart."""
    one = lambda text: [(turn, *x.values()) for turn, x in enumerate(people_of(text or ""))]
    return each_page(pages, [key], [html], one, "turn int, name string, title string, email string, phone string, linkedin_url string")
