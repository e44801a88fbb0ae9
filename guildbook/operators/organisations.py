"""Facts of organisations from the structured data of pages, as variants: lists and graphs, numbers as texts, addresses of two forms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guildbook.functions import page_tables

c = F.col
FACTS = ["schema_type", "phone", "url", "founded", "employees", "description", "street", "city", "state", "zip", "country", "latitude", "longitude", "map_url", "linkedin_url"]
PLACE = ["city", "state", "zip", "country"]


def _get(of: Column, *keys: str, kind: str = "string") -> Column:
    """The value at a path, if it can be read as the kind; empty texts count as none."""
    found = F.try_variant_get(of, "$" + "".join(f"['{k}']" for k in keys), kind)
    return F.nullif(found, F.lit("")) if kind == "string" else found


def _is(x: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(x).startswith(kind), F.lit(False))


def _text(of: Column, *keys: str) -> Column:
    """A text or a number at a path, without blanks at its ends; lists and objects are none."""
    whole = _get(of, *keys, kind="variant")
    return F.when(~_is(whole, "OBJECT") & ~_is(whole, "ARRAY"), F.nullif(F.regexp_replace(_get(of, *keys), r"^\s+|\s+$", ""), F.lit("")))


def _whole_number(text: Column) -> Column:
    """12, "1,200" and 12.7 as whole numbers."""
    return F.floor(F.replace(text, F.lit(","), F.lit("")).try_cast("double")).cast("long")


def items(df: DataFrame, key: str, blocks: str) -> DataFrame:
    """(key, place, item) for each object of each block: the block itself, or the members of its list or its @graph. place: (block, turn).
    Blocks that are no JSON, even without control characters, give none; null or empty lists of blocks neither."""
    each = df.select(key, F.posexplode(blocks).alias("block", "_raw")).withColumn("_bare", F.regexp_replace("_raw", r"[\x00-\x08\x0b\x0c\x0e-\x1f]", ""))
    each = each.withColumn("_v", F.coalesce(F.try_parse_json("_raw"), F.try_parse_json("_bare"))).filter(c("_v").isNotNull())
    listed = lambda *path: F.try_variant_get("_v", "$" + "".join(path), "array<variant>")
    graph = _is(F.try_variant_get("_v", "$['@graph']", "variant"), "ARRAY")
    members = F.when(_is(c("_v"), "ARRAY"), listed()).when(graph, listed("['@graph']")).otherwise(F.array("_v"))
    out = each.select(key, "block", F.posexplode(members).alias("turn", "item"))
    return out.filter(_is(c("item"), "OBJECT")).select(key, F.struct("block", "turn").alias("place"), "item")


def _kinds(item: Column) -> Column:
    """The types of an item, one or several."""
    one = _get(item, "@type")
    return F.coalesce(F.filter(F.try_variant_get(item, "$['@type']", "array<string>"), lambda x: x.isNotNull()), F.when(one.isNotNull(), F.array(one)), F.array().cast("array<string>"))


def _one_of(kind: Column, names: list[str]) -> Column:
    return F.coalesce(reduce(lambda a, b: a | b, [kind.contains(n) for n in names]), F.lit(False))


def facts(item: Column) -> dict[str, Column]:
    """FACTS of one item, each null where it has none."""
    people, there, geo = (_get(item, k, kind="variant") for k in ("numberOfEmployees", "address", "geo"))
    in_people = F.coalesce(*[_whole_number(_get(people, k)) for k in ("value", "maxValue", "minValue")])
    state = F.upper(_text(there, "addressRegion"))
    lat, lon = (F.coalesce(*[F.nullif(_get(geo, k).try_cast("double"), F.lit(0.0)) for k in names]) for names in (("latitude", "lat"), ("longitude", "lng", "long")))
    chart = F.coalesce(_text(item, "hasMap"), _text(item, "map"))
    links = F.coalesce(F.try_variant_get(item, "$.sameAs", "array<string>"), F.array(_get(item, "sameAs")))
    placed = lat.isNotNull() & lon.isNotNull()
    return {
        "schema_type": F.get(_kinds(item), F.lit(0)),
        "phone": _text(item, "telephone"),
        "url": _text(item, "url"),
        "founded": F.nullif(F.regexp_extract(_get(item, "foundingDate"), r"\b(?:19|20)\d{2}\b", 0), F.lit("")).cast("int"),
        "employees": F.when(_is(people, "OBJECT"), in_people).otherwise(_whole_number(_text(item, "numberOfEmployees"))),
        "description": F.left(_text(item, "description"), F.lit(300)),
        "street": F.when(_is(there, "OBJECT"), _text(there, "streetAddress")).otherwise(_text(item, "address")),
        "city": _text(there, "addressLocality"),
        "state": F.left(state, F.lit(2)),
        "zip": _text(there, "postalCode"),
        "country": _text(there, "addressCountry"),
        "latitude": F.when(placed, lat),
        "longitude": F.when(placed, lon),
        "map_url": F.when(F.lower(chart).rlike("google|maps"), chart),
        "linkedin_url": F.get(F.filter(links, lambda x: F.lower(x).contains("linkedin.com/company")), F.lit(0)),
    }


def organisation_facts(df: DataFrame, key: str, blocks: str) -> DataFrame:
    """FACTS of each page that has an organisation: of each fact the first of its organisations' in order. Addresses are looked at until one
    has a street. Pages without an organisation are left out."""
    rows = items(df, key, blocks).withColumn("_kind", F.get(_kinds(c("item")), F.lit(0))).filter(_one_of(c("_kind"), page_tables.ORGANISATIONS))
    rows = rows.select(key, "place", *[x.alias(n) for n, x in facts(c("item")).items()])
    last = F.min(F.when(c("street").isNotNull(), c("place"))).over(Window.partitionBy(key))
    rows = rows.withColumn("_last", last)
    seen = {f: c(f) if f not in PLACE else F.when(c("_last").isNull() | (c("place") <= c("_last")), c(f)) for f in FACTS}
    return rows.groupBy(key).agg(*[F.min_by(x, F.when(x.isNotNull(), c("place"))).alias(f) for f, x in seen.items()])


def organisation_firmographics(df: DataFrame, key: str, blocks: str, this_year: Column | None = None) -> DataFrame:
    """Employees (least and most), year of foundation (1800 to this year), city and state of each page's first organisation or corporation that
    tells one of them."""
    year_now = F.year(F.current_date()) if this_year is None else this_year
    people, there = (_get(c("item"), k, kind="variant") for k in ("numberOfEmployees", "address"))
    told = _get(people, "value")
    count = F.when(_is(people, "OBJECT"), F.when(told.rlike(r"^[0-9]+$"), told.try_cast("long"))).when(~_is(people, "STRING"), F.floor(_get(people).try_cast("double")).cast("long"))
    year = F.nullif(F.regexp_extract(_get(c("item"), "foundingDate"), r"\d{4}", 0), F.lit("")).cast("int")
    rows = items(df, key, blocks).filter(_one_of(F.array_join(_kinds(c("item")), " "), page_tables.CORPORATIONS))
    rows = rows.select(key, "place", count.alias("employee_count_min"), count.alias("employee_count_max"), F.when(year.between(1800, year_now), year).alias("year_founded"), _get(there, "addressLocality").alias("city"), _get(there, "addressRegion").alias("state"))
    fields = ["employee_count_min", "employee_count_max", "year_founded", "city", "state"]
    rows = rows.filter(F.coalesce(*[c(f).cast("string") for f in fields]).isNotNull())
    return rows.groupBy(key).agg(F.min_by(F.struct(*fields), "place").alias("_x")).select(key, "_x.*", F.lit("schema_org").alias("firmographic_source"))
