"""Records out of pages by a schema: selectors find the texts inside tasks, columns parse them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guildbook.functions.text import parse_field
from guildbook.operators.matcher import read, rules
from guildbook.operators.pages import external_members, parse_page
from guildbook.operators.people import Elements
from guildbook.operators.per_page import each_page

c = F.col


def select(page: Elements, selector: str, box: int | None = None) -> list[int]:
    """The elements, in order, that a selector means, inside one or in the whole parsed page: tag, .class, #id, [attribute] with =, *=, ^=,
    $=, ~=, :not(...), steps down, > for children, and commas; or a path (see matcher)."""
    found, own, around, nth = rules((selector,)), [], [], {}
    out = []
    for i, row in enumerate(page.rows):
        up = row["parent"]
        row["nth"] = nth[up, row["tag"]] = nth.get((up, row["tag"]), 0) + 1
        met, hit = found.meet(row, *((0, 0) if up is None else (own[up], around[up])), up is None)
        own.append(met)
        around.append(met | (0 if up is None else around[up]))
        if hit and (box is None or box < i < page.rows[box]["last"]):
            out.append(i)
    return out


def extended(schema: dict, base: dict) -> dict:
    """A schema over its base: fields of the same name are replaced."""
    return base | schema


def _column(name: str, field: dict, listed: bool) -> Column:
    out = c(name)
    if parser := field.get("parser"):
        out = parse_field(out, parser)
    for said, meant in field.get("mapping", {}).items():
        out = F.when(c(name) == said, meant).otherwise(out) if not field.get("parser") else F.when(out == said, meant).otherwise(out)
    if not listed and field.get("enum"):
        known = F.get(F.filter(F.array(*[F.lit(x) for x in field["enum"]]), lambda x: F.lower(x) == F.lower(out)), F.lit(0))
        out = F.when(out.isin(field["enum"]), out).otherwise(F.coalesce(known, out))
    return F.coalesce(F.nullif(out, F.lit("")), F.lit(field.get("default")).cast("string")).alias(name)


def extract_by_schema(pages: DataFrame, key: str, schema: dict, item: str | None = None, html: str = "html", required: str = "company_name", container: str | None = None) -> DataFrame:
    """(key, turn, the schema's fields): one record per page, or with `item` (a selector) one per item, of the first element of `container`
    if the page has it. Of a field's selectors (of CSS, or paths that begin with /) the first with a value counts; then its parser, mapping,
    names of an enum in any case (pages only) and default. Records without the required field go; null pages have none. All selectors are
    matched in the one walk that parses a page; one that can't be read is told at once."""
    names, asked = list(schema), [s for f in schema.values() for s in f["selectors"]]
    found = rules(tuple(dict.fromkeys([*asked, *[s for s in (item, container) if s]])))
    number = {s: k for k, s in enumerate(found.selectors)}

    def one(text):
        page = read(text or "", found)
        boxes = [None]
        if item is not None:
            holder = page.found(number[container]) if container else []
            boxes = page.found(number[item], holder[0] if holder else None)
        for turn, box in enumerate(boxes):
            yield turn, *[next((v for s in f["selectors"] if (v := page.value(number[s], f.get("extract"), box))), None) for f in schema.values()]

    raw = each_page(pages, [key], [html], one, "turn int, " + ", ".join(f"`{n}` string" for n in names))
    return raw.select(key, "turn", *[_column(n, f, item is not None) for n, f in schema.items()]).filter(c(required).isNotNull())


def directory_records(pages: DataFrame, key: str, url: str, schema: dict, item: str, html: str = "html", container: str | None = None) -> DataFrame:
    """The records of a list page by a schema, or where they are more the links to other firms' sites (their text is the name): (key, turn,
    how, the schema's fields). Both are counted by key over narrow rows."""
    listed = extract_by_schema(pages, key, schema, item, html, container=container).withColumn("how", F.lit("schema"))
    links = external_members(parse_page(pages.select(key, url, html), [key, url], html), key, url)
    links = links.select(key, F.row_number().over(Window.partitionBy(key).orderBy("host")).cast("int").alias("turn"), *[c({"company_name": "name", "website": "website"}[n]).alias(n) for n in ("company_name", "website") if n in schema], F.lit("links").alias("how"))
    both = listed.unionByName(links, allowMissingColumns=True)
    n = lambda how: F.count_if(c("how") == how).over(Window.partitionBy(key))
    return both.withColumn("_links", n("links") > n("schema")).filter(c("_links") == (c("how") == "links")).select(key, "turn", "how", *list(schema))
