"""Competitors, recommendations, events and runs: what reports for sales and operations are made from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guildbook.functions import tables
from guildbook.functions.text import text_list
from guildbook.operators.accounts import events_for_competitor
from guildbook.operators.within import held_in

c = F.col

# Trade shows whose names are looked for in events and in competitors' presence.
SHOWS = ["IMTS", "FABTECH", "PACK EXPO", "NPE", "SOCMA", "PMA", "AUTOMATE"]
# The most that each part of the fit score can reach, in the order in which equal shares are decided.
CAMPAIGN_PARTS = {"tech_maturity": 25, "tech_gap": 15, "assoc_engagement": 15, "size_fit": 20, "geo_fit": 15}
APPROACH_PARTS = {"tech_maturity": 25, "size_fit": 20, "geo_fit": 15, "tech_gap": 15, "assoc_engagement": 15}
# Technologies by category.
CATEGORIES = {
    "Analytics": ["Google Analytics", "Google Tag Manager", "Hotjar", "Mixpanel", "Segment", "Adobe DTM"],
    "CMS": ["WordPress", "Drupal", "Joomla", "Wix", "Squarespace"],
    "CDN": ["Cloudflare", "Akamai", "Fastly"],
    "Framework": ["React", "Angular", "Vue.js", "jQuery", "Next.js", "Bootstrap"],
    "Email/Marketing": ["HubSpot", "Marketo", "Mailchimp", "Pardot"],
}


def detection_source() -> Column:
    """Which field names the competitor in column `competitor` (title case): the ERP, a technology or a mail service, in this order.
    The technologies where none does; null without a competitor."""
    low = lambda name: F.transform(text_list(c(name)), lambda x: F.lower(x))
    erp, out = F.lower(F.coalesce("erp_system", F.lit(""))), F.when(c("competitor") == "", F.lit(None).cast("string"))
    held = lambda arr, aliases: F.exists(arr, lambda x: reduce(lambda a, b: a | b, [x.contains(y) for y in aliases]))
    for name, aliases in tables.COMPETITORS.items():
        here = F.lower("competitor") == name
        out = out.when(here & reduce(lambda a, b: a | b, [erp.contains(x) for x in aliases]), "erp_system")
        out = out.when(here & held(low("tech_stack"), aliases), "tech_stack").when(here & held(low("spf_services"), aliases), "spf_services")
    return out.otherwise("tech_stack")


def strongest(parts: dict[str, int]) -> Column:
    """The part of the fit score with the greatest share of its maximum; the first on ties."""
    return F.array_max(F.array(*[F.struct((c(name) / most).alias("share"), F.lit(-i).alias("turn"), F.lit(name).alias("name")) for i, (name, most) in enumerate(parts.items())]))["name"]


def recommend_campaign() -> Column:
    """The campaign for a company with columns of the fit score's parts, competitor and email_provider."""
    mail, top = F.lower(F.coalesce("email_provider", F.lit(""))), strongest(CAMPAIGN_PARTS)
    tech = F.when(mail.contains("microsoft") | mail.contains("m365"), "Microsoft Ecosystem").when(mail.isin("self-hosted", "self-hosted (on-premise)", "other"), "Legacy Transformation").otherwise("Tech Modernization")
    return (
        F.when(c("competitor") != "", "Competitive Displacement")
        .when(top == "tech_maturity", tech)
        .when((top == "tech_gap") & (c("tech_gap") >= 12), "Greenfield ERP")
        .when((top == "assoc_engagement") & (c("assoc_engagement") >= 10), "Association Blitz")
        .otherwise("Multi-touch Nurture")
    )


def recommend_approach() -> Column:
    """How to go about a company, as one line."""
    mail, top = F.lower(F.coalesce("email_provider", F.lit(""))), strongest(APPROACH_PARTS)
    return (
        F.when(c("competitor") != "", F.concat(F.lit("Competitive displacement — lead with migration from "), F.initcap("competitor")))
        .when((top == "tech_gap") & (c("tech_gap") >= 12), "Greenfield ERP opportunity — lead with first-ERP value story")
        .when((top == "tech_maturity") & mail.contains("microsoft"), "ABM 1:1 — Microsoft ecosystem modernization, Dynamics displacement angle")
        .when((top == "tech_maturity") & mail.isin("self-hosted", "self-hosted (on-premise)"), "Digital transformation — legacy IT modernization campaign")
        .when((top == "size_fit") & (c("size_fit") >= 18), "ABM 1:1 — perfect mid-market fit, personalized executive outreach")
        .when((top == "assoc_engagement") & (c("assoc_engagement") >= 12), "Association-centric — leverage peer trust and event presence")
        .when((top == "geo_fit") & (c("geo_fit") >= 12), "Regional campaign — local manufacturing cluster outreach")
        .otherwise("ABM 1:few — multi-touch nurture sequence")
    )


def event_threat(events: DataFrame, competitors: DataFrame) -> DataFrame:
    """Per event: the threat by competitors present at the same show, and what to do. The shows are a fixed list, so competitors
    are folded to one row that says of each show whether competitors of a level name it."""
    up = F.upper(F.coalesce("presence", F.lit("")))
    flags = [F.coalesce(F.bool_or((F.upper("threat_level") == level) & up.contains(show)), F.lit(False)).alias(f"{level} {show}") for level in ("HIGH", "MEDIUM") for show in SHOWS]
    shows = competitors.agg(*flags)  # one row
    title = F.upper("event_name")
    at = lambda level: reduce(lambda a, b: a | b, [title.contains(show) & c(f"`{level} {show}`") for show in SHOWS])
    high, medium = at("HIGH"), at("MEDIUM")
    joined = events.join(F.broadcast(shows), F.lit(True)).withColumns({"_high": high, "_medium": medium})
    first, quiet = c("priority") == "HIGH", F.coalesce(c("notes").contains("NO ERP Competition"), F.lit(False))
    pick = lambda *v: F.when(first & c("_high"), v[0]).when(first & quiet, v[1]).when(first, v[2]).when(c("priority") == "MEDIUM", v[3]).otherwise(v[4])
    return joined.select(
        *events.columns,
        F.when(c("_high"), "HIGH").when(c("_medium"), "MEDIUM").otherwise("LOW").alias("threat"),
        pick("SPONSOR", "EXHIBIT", "EXHIBIT", "ATTEND", "SKIP").alias("recommendation"),
        pick("$$$", "$$", "$$", "$", "Free").alias("budget"),
        pick("High", "High", "High", "Medium", "Low").alias("roi"),
    )


def threatened_events(events: DataFrame, competitors: DataFrame) -> DataFrame:
    """(event_name, competitor) of events of high priority and competitors of a high or emerging threat whose presence text holds a word of
    the event's name, of four letters or more; in any case, each pair once."""
    words = events.filter(F.upper("priority") == "HIGH").select("event_name", F.explode(F.filter(F.split(F.upper("event_name"), r"\s+"), lambda w: F.length(w) > 3)).alias("_w")).distinct()
    who = competitors.filter(F.upper("threat_level").isin("HIGH", "EMERGING")).select("competitor").distinct()
    texts = competitors.join(who, "competitor").select("competitor", F.upper("presence").alias("_p")).distinct()
    return held_in(words, "_w", texts, "_p").select("event_name", "competitor").distinct()


def most_threatened(events: DataFrame, competitors: DataFrame, few: int = 3) -> DataFrame:
    """The events with most such competitors, names on ties: (event_name, competitors)."""
    return threatened_events(events, competitors).groupBy("event_name").agg(F.count("*").alias("competitors")).orderBy(F.desc("competitors"), "event_name").limit(few)


def competitor_accounts(competitors: DataFrame, detected: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Per tracked competitor: how many companies it was detected at, their three most frequent associations (ties by name), and with
    `events` (and a column presence) the events that its presence text names. Names meet names by their pieces, companies by equality."""
    known = detected.filter(c("competitor") != "").select("company_id", c("competitor").alias("_found"), text_list(c("associations")).alias("_lists"))
    names = known.select("_found").distinct()
    own, others = competitors.select("name", F.lower("name").alias("_n")).distinct(), names.select("_found", F.lower("_found").alias("_f"))
    pairs = held_in(own, "_n", others, "_f").select("name", "_found").unionByName(held_in(others, "_f", own, "_n").select("name", "_found"))
    # The exact name first, then any that holds the other, in order of names.
    chosen = pairs.groupBy("name").agg(F.min_by("_found", F.struct(F.initcap("name") != c("_found"), "_found")).alias("_found"))
    counts = known.groupBy("_found").agg(F.count("*").alias("companies"))
    lists = known.select("_found", F.explode("_lists").alias("a")).groupBy("_found", "a").agg(F.count("*").alias("n"))
    first = lists.withColumn("_r", F.row_number().over(Window.partitionBy("_found").orderBy(F.desc("n"), "a"))).filter("_r <= 3")
    top = first.groupBy("_found").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "a"))), lambda x: x["a"]), "; ").alias("associations"))
    out = competitors.select("name").join(chosen, "name", "left").join(counts, "_found", "left").join(top, "_found", "left")
    columns = ["name", F.coalesce("companies", F.lit(0)).alias("companies"), F.coalesce("associations", F.lit("")).alias("associations")]
    if events is None:
        return out.select(columns)
    named = events_for_competitor(competitors.select(c("name").alias("competitor"), "presence"), events).select(c("competitor").alias("name"), c("events").alias("_events"))
    return out.join(named, "name", "left").select(*columns, F.coalesce("_events", F.lit("")).alias("events"))


def competitor_matrix(df: DataFrame) -> DataFrame:
    """Companies with a competitor, by competitor, then by fit."""
    return df.filter(c("competitor") != "").orderBy("competitor", F.desc("icp_score"), "company_id")


def job_summary(jobs: DataFrame, as_of: Column) -> DataFrame:
    """Progress in per cent and seconds so far of every job."""
    progress = F.when(c("total_items") > 0, F.round(100.0 * c("processed_items") / c("total_items"), 1)).otherwise(0.0)
    seconds = F.unix_timestamp(F.coalesce(c("completed_at"), as_of)) - F.unix_timestamp("started_at")
    return jobs.withColumn("progress_percent", progress).withColumn("duration_seconds", seconds)


def phase_stats(history: DataFrame) -> DataFrame:
    """Per job and phase: how often it ran, how long in all, and what it had counted at its end."""
    seconds = F.unix_timestamp("ended_at") - F.unix_timestamp("started_at")
    return history.groupBy("job_id", "phase").agg(F.count("*").alias("runs"), F.sum(seconds).alias("seconds"), F.max("pages").alias("pages"), F.max("companies").alias("companies"))


def extraction_errors(results: DataFrame, threshold: float = 0.10) -> DataFrame:
    """Share of failed runs per association and, with association null, overall; and whether it is beyond the threshold."""
    rate = F.avg(F.when(c("success"), 0.0).otherwise(1.0))
    rolled = results.rollup("association").agg(F.count("*").alias("runs"), F.count_if(~c("success")).alias("failed"), F.round(rate, 6).alias("error_rate"))
    return rolled.withColumn("failing", c("error_rate") > threshold)


def tech_adoption(df: DataFrame) -> DataFrame:
    """Per technology: companies, share of the companies with any technology, site system or mail provider, and category."""
    tech = text_list(c("tech_stack"))
    enriched = (F.size(tech) > 0) | (F.coalesce("cms", F.lit("")) != "") | (F.coalesce("email_provider", F.lit("")) != "")
    total = df.agg(F.count_if(enriched).alias("_total"))  # one row
    counts = df.select(F.explode(tech).alias("technology")).groupBy("technology").agg(F.count("*").alias("n"))
    category = reduce(lambda out, kv: out.when(c("technology").isin(kv[1]), kv[0]), CATEGORIES.items(), F).otherwise("Other")
    return counts.join(F.broadcast(total), F.lit(True)).select("technology", "n", F.round(100.0 * c("n") / F.greatest("_total", F.lit(1)), 4).alias("pct"), category.alias("category"))


def cms_adoption(df: DataFrame) -> DataFrame:
    """Per site system: companies, and whether it is dominant, common, a niche or rare."""
    rows = df.select(F.trim("cms").alias("cms")).filter(c("cms") != "").groupBy("cms").agg(F.count("*").alias("n"))
    return rows.withColumn("adoption", F.when(c("n") >= 100, "Dominant").when(c("n") >= 30, "Common").when(c("n") >= 10, "Niche").otherwise("Rare"))


def maturity_summary(df: DataFrame) -> DataFrame:
    """Per tier of tech_tier: companies, share, mean fit, and the most frequent association (the first by name on ties)."""
    members = df.select("tech_tier", F.explode(text_list(c("associations"))).alias("a")).groupBy("tech_tier", "a").agg(F.count("*").alias("n"))
    top = members.groupBy("tech_tier").agg(F.min_by("a", F.struct(-c("n"), "a")).alias("top_association"))
    sums = df.groupBy("tech_tier").agg(F.count("*").alias("n"), F.round(F.avg("icp_score"), 4).alias("avg_icp"))
    whole = sums.agg(F.sum("n").alias("_all"))
    out = sums.join(F.broadcast(whole), F.lit(True)).join(top, "tech_tier", "left")
    return out.select("tech_tier", "n", F.round(100.0 * c("n") / c("_all"), 4).alias("pct"), "avg_icp", F.coalesce("top_association", F.lit("")).alias("top_association"))


def grade_vs_icp(df: DataFrame) -> DataFrame:
    """Per grade: companies, share and mean fit."""
    sums = df.groupBy("letter").agg(F.count("*").alias("n"), F.round(F.avg("icp_score"), 4).alias("avg_icp"))
    whole = sums.agg(F.sum("n").alias("_all"))
    return sums.join(F.broadcast(whole), F.lit(True)).select("letter", "n", F.round(100.0 * c("n") / c("_all"), 4).alias("pct"), "avg_icp")
