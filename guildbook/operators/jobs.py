"""Job postings: cards out of fetched pages, systems that postings name, titles that are sought."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guildbook.functions import job_tables
from guildbook.functions.text import squeeze

c = F.col

_CARD = "struct<title:string,displayTitle:string,company:string,truncatedCompany:string,formattedLocation:string,formattedRelativeTime:string,urgentlyHiring:boolean,snippet:string,extractedSalary:string,salarySnippet:string>"
_CARDS = f"struct<metaData:struct<mosaicProviderJobCardsModel:struct<results:array<{_CARD}>>>>"


def _filled(*values: Column) -> Column:
    """The first value that holds something, trimmed; an empty text without one."""
    return F.trim(F.coalesce(*[F.when(~v.isin("", "{}"), v) for v in values], F.lit("")))


def job_cards(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, turn, title, employer, location, snippet, posted, salary, urgent): the cards of the JSON blob that a page of search results
    carries. Cards without a title, and pages without a blob or with a broken one, give no rows."""
    blob = F.regexp_extract(c(html), r'(?s)window\.mosaic\.providerData\["mosaic-provider-jobcards"\]\s*=\s*(\{.*?\});', 1)
    cards = pages.filter(F.contains(c(html), F.lit("mosaic-provider-jobcards"))).select(key, F.from_json(blob, _CARDS).alias("_b"))
    rows = cards.select(key, F.posexplode("_b.metaData.mosaicProviderJobCardsModel.results").alias("turn", "x"))
    pay = _filled(c("x.extractedSalary"), c("x.salarySnippet"))
    return rows.select(
        key, "turn", _filled(c("x.title"), c("x.displayTitle")).alias("title"), _filled(c("x.company"), c("x.truncatedCompany")).alias("employer"),
        _filled(c("x.formattedLocation")).alias("location"), F.left(squeeze(F.regexp_replace(F.coalesce("x.snippet", F.lit("")), "<[^>]+>", " ")), F.lit(600)).alias("snippet"),
        _filled(c("x.formattedRelativeTime")).alias("posted"), F.when(pay.startswith("{"), _filled(F.get_json_object(pay, "$.text"))).otherwise(pay).alias("salary"),
        F.coalesce("x.urgentlyHiring", F.lit(False)).alias("urgent"),
    ).filter("title <> ''")


def _posting() -> Column:
    return F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("snippet", F.lit(""))))


def _hits(jobs: DataFrame, key: str, order: str, table: dict[str, list[str]]) -> DataFrame:
    """A row for each posting and word of a table in it, with the number of places. One test for all words comes first."""
    words = [(name, w) for name, group in table.items() for w in group]
    every = "|".join(rf"\Q{w}\E" for _, w in words)
    held = jobs.select(key, c(order).alias("_order"), "title", _posting().alias("_t")).filter(c("_t").rlike(every))
    found = [F.struct(F.lit(i).alias("_turn"), F.lit(name).alias("name"), F.lit(w).alias("keyword"), F.floor((F.length("_t") - F.length(F.replace("_t", F.lit(w)))) / len(w)).alias("n")) for i, (name, w) in enumerate(words)]
    return held.select(key, "_order", "title", "_t", F.inline(F.filter(F.array(*found), lambda x: x["n"] > 0)))


def job_mentions(jobs: DataFrame, key: str, order: str, most: int = 15, about: int = 60) -> DataFrame:
    """(key, rank, vendor, keyword, job_title, context): ERP words in postings, each (vendor, keyword, title) of a company once, with the
    text about its first place; the first `most` by posting, then by the table's order. Partial aggregation and a ranked window with a
    limit keep a company with very many postings apart from one task's memory."""
    hits = _hits(jobs, key, order, job_tables.ERP_POSTING_WORDS)
    at = F.position(c("keyword"), c("_t"))
    begin = F.greatest(F.lit(1), at - about)
    context = F.concat(F.lit("..."), F.trim(F.substring(c("_t"), begin, at + F.length("keyword") + about - begin)), F.lit("..."))
    firsts = hits.withColumn("context", context).groupBy(key, c("name").alias("vendor"), "keyword", c("title").alias("job_title")).agg(F.min(F.struct("_order", "_turn", "context")).alias("x"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy("x._order", "x._turn", "job_title"))
    return firsts.withColumn("rank", rank).filter(c("rank") <= most).select(key, "rank", "vendor", "keyword", "job_title", c("x.context").alias("context"))


def primary_vendor(jobs: DataFrame, key: str, order: str) -> DataFrame:
    """(key, vendor, mentions): the vendor with most places in all postings of a company; of equals the one met first."""
    hits = _hits(jobs, key, order, job_tables.ERP_POSTING_WORDS)
    sums = hits.groupBy(key, c("name").alias("vendor")).agg(F.sum("n").alias("mentions"), F.min(F.struct("_order", "_turn")).alias("first"))
    best = sums.groupBy(key).agg(F.min(F.struct((-c("mentions")).alias("less"), "first", "vendor")).alias("x"))
    return best.select(key, "x.vendor", (-c("x.less")).alias("mentions"))


def job_tech(jobs: DataFrame, key: str, order: str) -> DataFrame:
    """(key, category, keyword): words of other systems in a company's postings, each once. A word is looked for in each posting; words
    that would only arise where two postings touch are not found."""
    return _hits(jobs, key, order, job_tables.SYSTEM_POSTING_WORDS).select(key, c("name").alias("category"), "keyword").distinct()


def hiring_titles(jobs: DataFrame, key: str, order: str, most: int = 20) -> DataFrame:
    """(key, rank, title): the first `most` different titles that a company seeks."""
    firsts = jobs.select(key, F.trim("title").alias("title"), order).filter("title <> ''").groupBy(key, "title").agg(F.min(order).alias("_first"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy("_first", "title"))
    return firsts.withColumn("rank", rank).filter(c("rank") <= most).select(key, "rank", "title")


def looks_like_title(title: Column) -> Column:
    """Whether a text of at most 100 characters holds a word of job titles."""
    low = F.lower(title)
    return F.coalesce((F.length(title).between(1, 100)) & reduce(lambda a, b: a | b, [low.contains(w) for w in job_tables.TITLE_WORDS]), F.lit(False))
