"""Joins around accounts: registries, job cards, events by association, threats, dashboard rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guildbook.functions.text import merge_key, text_list
from guildbook.operators.within import held_in

c = F.col
# Endings tried on names that the registry doesn't have, in order.
ENDINGS = ["inc", "corp", "corporation", "llc", "ltd", "co", "company", "incorporated", "limited", "group", "holdings"]
# Words of names that say nothing.
STOP_WORDS = ["inc", "corp", "llc", "ltd", "co", "company", "the", "and", "group", "solutions", "systems", "services", "industries", "manufacturing", "international", "technologies", "technology"]


def match_registry(df: DataFrame, registry: DataFrame, key: str, name: str) -> DataFrame:
    """Companies found in a registry (columns reg_key and others) by the exact key, else by the first ending whose letters,
    trimmed off the end as a set, leave a known key. Both are one equi-join on ranked variants of the key."""
    k = merge_key(c(name))
    variants = [F.struct(F.lit(0).alias("turn"), k.alias("reg_key"))]
    for turn, ending in enumerate(ENDINGS, 1):
        cut = F.rtrim(k, F.lit(ending))
        variants.append(F.when(k.endswith(ending) & (cut != k), F.struct(F.lit(turn).alias("turn"), cut.alias("reg_key"))))
    tried = df.select(key, F.inline(F.array_compact(F.array(*variants))))
    rest = [x for x in registry.columns if x != "reg_key"]
    found = tried.join(registry, "reg_key").groupBy(key).agg(F.min_by(F.struct("reg_key", *rest), "turn").alias("x"))
    return found.select(key, "x.*")


def job_matches(company: Column, employer: Column, snippet: Column) -> Column:
    """Whether a job card belongs to a company: names within each other, one of its first two telling words in the employer's
    name, its name in the text, or no employer given."""
    name, boss = F.lower(F.trim(company)), F.lower(F.trim(employer))
    words = F.filter(F.split(name, r"[\s,./&\-()]+"), lambda w: (F.length(w) > 3) & ~w.isin(STOP_WORDS))
    told = F.exists(F.slice(words, 1, 2), lambda w: boss.contains(w))
    return boss.contains(name) | name.contains(boss) | told | F.lower(snippet).contains(name)


def match_jobs(companies: DataFrame, jobs: DataFrame, key: str, name: str) -> DataFrame:
    """Job cards of each company's own search that belong to it."""
    return companies.join(jobs, key).filter(job_matches(c(name), c("employer"), c("snippet")))


def event_overlap(df: DataFrame, events: DataFrame, fragments: dict[str, list[str]], default: list[str], key: str, associations: str) -> DataFrame:
    """The events that an account's associations lead to, in the events' order, joined. Associations go by prefix; those without
    fragments of their own get the default ones.

    Events of one name count once, at their first turn, before anything meets them. Accounts with the same fragments have the same
    events: the text is made once for each set of fragments, of which there are at most two to the power of their number."""
    code = lambda a: F.upper(F.trim(a))
    lists = F.flatten(F.transform(text_list(c(associations)), lambda a: F.flatten(F.array(*[F.when(code(a).startswith(k), F.array(*[F.lit(x.lower()) for x in v])).otherwise(F.expr("cast(array() as array<string>)")) for k, v in fragments.items()]))))
    wanted = F.when(F.size(lists) > 0, lists).otherwise(F.array(*[F.lit(x.lower()) for x in default]))
    wanted = F.when(F.size(text_list(c(associations))) > 0, F.array_sort(F.array_distinct(wanted))).otherwise(F.expr("cast(array() as array<string>)"))
    keyed = df.select(key, F.array_join(wanted, "\x00").alias("_set"))
    sets = keyed.select("_set").distinct()
    kinds = sorted({x.lower() for v in [*fragments.values(), default] for x in v})
    named = events.groupBy("event_name").agg(F.min("turn").alias("turn"))
    known = named.select("event_name", "turn", F.explode(F.array_compact(F.array(*[F.when(F.lower("event_name").contains(x), F.lit(x)) for x in kinds]))).alias("_f"))
    hits = sets.select("_set", F.explode(F.split("_set", "\x00")).alias("_f")).join(known, "_f").select("_set", "event_name", "turn").distinct()
    texts = hits.groupBy("_set").agg(F.array_sort(F.collect_list(F.struct("turn", "event_name"))).alias("x"))
    texts = texts.select("_set", F.array_join(F.transform("x", lambda e: e["event_name"]), "; ").alias("events"))
    return keyed.join(texts, "_set", "left").select(key, F.coalesce("events", F.lit("")).alias("events"))


def event_reach(events: DataFrame, memberships: DataFrame, keywords: dict[str, list[str]]) -> DataFrame:
    """Per event the members of all associations that its industry's keywords name."""
    counts = memberships.groupBy("association").agg(F.count_distinct("company_id").alias("members"))
    none = F.expr("cast(array() as array<string>)")
    named = F.array_distinct(F.flatten(F.array(*[F.when(F.lower("industry").contains(k), F.array(*[F.lit(a) for a in v])).otherwise(none) for k, v in keywords.items() if v])))
    parts = events.select("event_id", F.explode(named).alias("association")).join(counts, "association", "left")
    sums = parts.groupBy("event_id").agg(F.coalesce(F.sum("members"), F.lit(0)).alias("reach"))
    return events.select("event_id").join(sums, "event_id", "left").select("event_id", F.coalesce("reach", F.lit(0)).alias("reach"))


def words_of_event(name: Column) -> Column:
    return F.filter(F.split(F.lower(F.replace(name, F.lit("/"), F.lit(" "))), r"\s+"), lambda w: F.length(w) > 2)


def events_for_competitor(competitors: DataFrame, events: DataFrame) -> DataFrame:
    """(competitor, events): names of the events of which a word of three letters or more occurs in a competitor's presence text."""
    words = events.select("event_name", F.explode(words_of_event(c("event_name"))).alias("_w")).distinct()
    hits = held_in(words, "_w", competitors.select("competitor", F.lower("presence").alias("_p")).distinct(), "_p").select("competitor", "event_name").distinct()
    return hits.groupBy("competitor").agg(F.array_join(F.array_sort(F.collect_set("event_name")), "; ").alias("events"))


def decision_makers(contacts: DataFrame, key: str, order: str, priority: Column, few: int = 10) -> DataFrame:
    """A company's contacts with target titles, or its first ten if there are none; the first of each name."""
    first = contacts.withColumn("_p", priority).groupBy(key, F.lower("name").alias("_n")).agg(F.min_by(F.struct(order, "name", "title", "_p"), order).alias("x")).select(key, "x.*")
    listed = first.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(c(order).alias("turn"), "name", "title", "_p"))).alias("all"))
    good = F.filter("all", lambda x: x["_p"] < 999)
    return listed.select(key, F.inline(F.when(F.size(good) > 0, good).otherwise(F.slice("all", 1, few)))).drop("_p")


def dashboard_rows(df: DataFrame) -> DataFrame:
    """Narrow rows for a front end: trimmed texts, the first eight technologies and six services; by fit, then quality."""
    text = lambda x: F.trim(F.coalesce(c(x), F.lit(""))).alias(x)
    people = F.when(c("employee_count_max") > 0, F.when(c("employee_count_min") > 0, F.concat_ws("-", "employee_count_min", "employee_count_max")).otherwise(F.concat(F.lit("<"), c("employee_count_max")))).when(c("employee_count_min") > 0, F.concat(c("employee_count_min"), F.lit("+"))).otherwise("")
    rows = df.select("company_id", "company_name", text("website"), text("city"), text("state"), text("phone"), F.array_join(F.slice(text_list(c("tech_stack")), 1, 8), ";").alias("tech"), F.array_join(F.slice(text_list(c("spf_services")), 1, 6), ";").alias("spf"), "quality_score", "icp_score", "tier", "competitor", people.alias("people"))
    return rows.orderBy(F.desc("icp_score"), F.desc("quality_score"), "company_id")


def export_json(df: DataFrame, kind: str, exported_at: Column) -> tuple[DataFrame, DataFrame]:
    """Records as JSON lines, and a row that describes them."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value")), df.agg(F.lit(kind).alias("export_type"), exported_at.alias("exported_at"), F.count("*").alias("record_count"))
