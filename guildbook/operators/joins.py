"""Joins of company tables: waterfalls of providers, overlays, cross-references, incremental sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guildbook.functions.text import extract_domain, has_value, names_match
from guildbook.operators.store import written

c = F.col


def last_per_key(df: DataFrame, key: str, order: str, fields: list[str]) -> DataFrame:
    """The last row of each key, by one aggregate."""
    return df.groupBy(key).agg(F.max_by(F.struct(*fields), c(order)).alias("_x")).select(key, "_x.*")


def waterfall(df: DataFrame, key: str, providers: list[tuple[str, DataFrame]], fields: list[str], done: Column) -> DataFrame:
    """The first provider that has a row for the key gives all fields; rows that are done already are left alone.
    Providers: (name, frame of key and fields). Null keys join nothing."""
    out = df.withColumn("_done", done)
    for name, p in providers:
        out = out.join(p.select(c(key).alias(f"_{name}"), F.struct(*fields).alias(f"_{name}_x")), c(key) == c(f"_{name}"), "left")
    pick = F.coalesce(*[c(f"_{name}_x") for name, _ in providers])
    source = F.coalesce(*[F.when(c(f"_{name}").isNotNull(), name) for name, _ in providers])
    kept = [f for f in df.columns if f not in fields]
    return out.select(*kept, *[F.when(c("_done"), c(f)).otherwise(pick[f]).alias(f) if f in df.columns else F.when(~c("_done"), pick[f]).alias(f) for f in fields], F.when(~c("_done"), source).alias("source"))


def overlay(df: DataFrame, updates: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Values of the updates over the original where they aren't empty."""
    u = updates.select(c(key).alias("_k"), *[c(f).alias(f"_{f}") for f in fields])
    joined = df.join(u, c(key) == c("_k"), "left")
    new = {f: F.coalesce(F.when(c(f"_{f}").cast("string") != "", c(f"_{f}")), c(f)) for f in fields}
    return joined.select(*[new[f].alias(f) if f in new else c(f) for f in df.columns])


def merge_enriched(enriched: DataFrame, base: DataFrame, key: str, order: str, gaps: list[str]) -> DataFrame:
    """Base rows drive; the last enriched row of a key fills their gaps; enriched rows without a base row come behind, the
    first of each key."""
    last = last_per_key(enriched, key, order, gaps).select(c(key).alias("_k"), *[c(f).alias(f"_{f}") for f in gaps])
    joined = base.join(last, c(key) == c("_k"), "left")
    filled = joined.select(key, *[F.coalesce(F.when(c(f).cast("string") != "", c(f)), c(f"_{f}")).alias(f) for f in gaps], F.lit("base").alias("origin"))
    only = enriched.join(base.select(key).distinct(), key, "left_anti").groupBy(key).agg(F.min_by(F.struct(*gaps), c(order)).alias("_x")).select(key, "_x.*", F.lit("enriched").alias("origin"))
    return filled.unionByName(only)


def full_fill(a: DataFrame, b: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Both sides by key; the left value where it is one, else the right."""
    joined = a.alias("a").join(b.alias("b"), c(f"a.{key}") == c(f"b.{key}"), "full_outer")
    return joined.select(F.coalesce(c(f"a.{key}"), c(f"b.{key}")).alias(key), *[F.coalesce(F.when(c(f"a.{f}").cast("string") != "", c(f"a.{f}")), c(f"b.{f}")).alias(f) for f in fields])


def crossref(df: DataFrame, dns: DataFrame, places: DataFrame) -> DataFrame:
    """Look-ups by domain and by name: flags, a score about 50 and a list of issues."""
    out = df.join(dns, "domain", "left").join(places, "company_id", "left")
    score = 50 + F.when(c("mx"), 20).when(~c("mx"), -20).otherwise(0) + F.when(c("place"), 15).when(~c("place"), -10).otherwise(0)
    issues = F.array_compact(F.array(F.when(~c("mx"), "no mail server"), F.when(~c("place"), "no place found"), F.when(c("mx").isNull(), "domain not checked")))
    return out.withColumn("score", score).withColumn("issues", F.array_join(issues, "; "))


def anti_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return df.join(done.select(key).distinct(), key, "left_anti")


def mark_new(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    known = existing.select(c(key).alias("_k")).distinct()
    return df.join(known, c(key) == c("_k"), "left").withColumn("is_new", c("_k").isNull()).drop("_k")


def tam(expected: DataFrame, memberships: DataFrame) -> DataFrame:
    """Expected against known members: share, gap, status."""
    got = memberships.groupBy("association").agg(F.count_distinct("company_id").alias("known"))
    share = F.round(100.0 * c("known") / c("expected"), 6)
    out = expected.join(got, "association", "left").withColumn("known", F.coalesce("known", F.lit(0)))
    return out.withColumn("percent", share).withColumn("gap", F.greatest(F.lit(0), c("expected") - c("known"))).withColumn("status", F.when(c("percent") >= 80, "covered").when(c("percent") >= 30, "partial").otherwise("open"))


def upsert(target: DataFrame, batch: DataFrame, key: str, order: str, fields: list[str]) -> DataFrame:
    """The batch over the target: per key and field the last value that isn't null; new keys are added."""
    news = batch.groupBy(key).agg(*[F.max_by(f, F.when(c(f).isNotNull(), c(order))).alias(f"_{f}") for f in fields]).withColumnRenamed(key, "_k")
    joined = target.join(news, c(key) == c("_k"), "full_outer")
    return joined.select(F.coalesce(c(key), c("_k")).alias(key), *[F.coalesce(c(f"_{f}"), c(f)).alias(f) for f in fields])


def upsert_companies(target: DataFrame, batch: DataFrame, fields: list[str], order: str = "turn", id_: str = "id", domain: str = "domain") -> DataFrame:
    """Companies with a batch laid over them: (id, domain, fields) of every company after it, and `how` (kept, updated, added).

    A row of the batch meets the company of its domain, else that of its id, both as the table was before the batch; where they are two,
    that of the domain wins. Of several companies with one domain the least id is met. Rows that meet none come in as new companies: one
    for each domain, rows without domain one for each id, and rows without both one each; a new company's id is the first of its rows that is
    one. Of several rows the last value that isn't null counts, for the domain too; the id stays. Domains are compared as they are, and
    empty ones are none. A batch row without `order` counts as the first."""
    filled = lambda x: F.nullif(F.trim(c(x).cast("string")), F.lit(""))
    rows = batch.select(c(id_).alias("_id"), filled(domain).alias("_domain"), F.coalesce(c(order), F.lit(-(2**62))).alias("_turn"), *[c(f).alias(f"_{f}") for f in fields])
    by_domain = target.filter(filled(domain).isNotNull()).groupBy(filled(domain).alias("_domain")).agg(F.min(id_).alias("_first"))
    met = rows.join(by_domain, "_domain", "left")
    by_id = target.filter(c(id_).isNotNull()).select(c(id_).alias("_id"), F.lit(True).alias("_known")).distinct()
    met = met.join(by_id, "_id", "left").withColumn("_meets", F.coalesce("_first", F.when(c("_known"), c("_id"))))
    # A key for each company that is met or made: rows of one key are one company.
    key = F.when(c("_meets").isNotNull(), F.concat(F.lit("old:"), c("_meets").cast("string"))).when(c("_domain").isNotNull(), F.concat(F.lit("domain:"), "_domain")).when(c("_id").isNotNull(), F.concat(F.lit("id:"), c("_id").cast("string"))).otherwise(F.concat(F.lit("row:"), F.uuid()))
    met = written(met.withColumn("_key", key), "met")
    last = lambda x: F.max_by(c(x), F.when(c(x).isNotNull(), F.struct("_turn", c(x)))).alias(x)
    news = met.groupBy("_key").agg(F.first("_meets").alias("_meets"), F.min_by("_id", F.when(c("_id").isNotNull(), F.struct("_turn", "_id"))).alias("_id"), last("_domain"), *[last(f"_{f}") for f in fields])
    old = target.join(news.filter(c("_meets").isNotNull()).drop("_id", "_key"), c(id_) == c("_meets"), "left")
    old = old.select(c(id_).alias(id_), F.coalesce("_domain", domain).alias(domain), *[F.coalesce(f"_{f}", f).alias(f) for f in fields], F.when(c("_meets").isNull(), "kept").otherwise("updated").alias("how"))
    new = news.filter(c("_meets").isNull()).select(c("_id").alias(id_), c("_domain").alias(domain), *[c(f"_{f}").alias(f) for f in fields], F.lit("added").alias("how"))
    return old.unionByName(new)


def audit_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """A row for every field that differs, rows that came and went among them."""
    side = lambda df, p: df.select(c(key).alias(f"{p}k"), *[c(f).cast("string").alias(f"{p}{f}") for f in fields])
    joined = side(old, "o_").join(side(new, "n_"), c("o_k") == c("n_k"), "full_outer")
    rows = F.array(*[F.struct(F.lit(f).alias("field"), c(f"o_{f}").alias("old_value"), c(f"n_{f}").alias("new_value")) for f in fields])
    return joined.select(F.coalesce("o_k", "n_k").alias(key), F.inline(rows)).filter(~c("old_value").eqNullSafe(c("new_value")))


def enqueue(new: DataFrame, known: list[DataFrame], key: str, order: str) -> DataFrame:
    """New keys that are in none of the known sets, the first row of each."""
    out = reduce(lambda d, k: d.join(k.select(key).distinct(), key, "left_anti"), known, new)
    rest = [f for f in new.columns if f != key]
    return out.groupBy(key).agg(F.min_by(F.struct(*rest), c(order)).alias("_x")).select(key, "_x.*")


def tech_waterfall(df: DataFrame, key: str, methods: list[tuple[str, DataFrame, str]], found: str = "erp_system", skip: bool = True) -> DataFrame:
    """Detection methods in order until one yields `found`; without any, the result of the last method that had one stands, even
    without it. methods: (name, frame of key, found and other fields, the column of df that the method needs). Rows that have
    `found` already are left alone if skip."""
    fields = [f for f in methods[0][1].columns if f != key]
    filled = lambda x: F.coalesce(x, F.lit("")) != ""
    done = filled(c(found)) if skip and found in df.columns else F.lit(False)
    out = df
    for name, p, _ in methods:
        out = out.join(p.select(c(key).alias(f"_{name}"), F.struct(*fields).alias(f"_{name}_x")), c(key) == c(f"_{name}"), "left")
    usable = {name: F.when(filled(c(need)), c(f"_{name}_x")) for name, _, need in methods}
    hit = F.coalesce(*[F.when(filled(x[found]), x) for x in usable.values()])
    # A method that ran without a result puts out what the ones before it gave.
    last = None
    for name, _, need in methods:
        last = F.when(filled(c(need)), usable[name]) if last is None else F.when(filled(c(need)), usable[name]).otherwise(last)
    result = F.when(~done, F.coalesce(hit, last))
    new = {f: F.when(result.isNotNull(), result[f]).otherwise(c(f)) if f in df.columns else result[f] for f in fields}
    return out.select(*[new[f].alias(f) if f in new else c(f) for f in df.columns], *[new[f].alias(f) for f in fields if f not in df.columns])


def contacts_from_providers(companies: DataFrame, key: str, providers: list[tuple[str, DataFrame]], priority: Column, few: int = 10) -> DataFrame:
    """Contacts of all providers for the companies without any (column n_contacts): the first of each address, else of each name, in the
    order of the providers; only those with a target title (priority below 999), best first, at most few per company.
    providers: (name, frame of key, turn, name, title, email)."""
    open_ = companies.filter(F.coalesce("n_contacts", F.lit(0)) == 0).select(key)
    rows = None
    for rank, (name, p) in enumerate(providers):
        part = p.select(key, F.lit(rank).alias("_rank"), F.lit(name).alias("provider"), "turn", "name", "title", "email")
        rows = part if rows is None else rows.unionByName(part)
    who = F.coalesce(F.nullif(F.lower(F.trim("email")), F.lit("")), F.concat(F.lit("name:"), F.lower(F.trim("name"))))
    firsts = rows.join(open_, key).withColumn("_who", who).groupBy(key, "_who").agg(F.min_by(F.struct("_rank", "turn", "provider", "name", "title", "email"), F.struct("_rank", "turn", "name")).alias("x")).select(key, "x.*")
    ranked = firsts.withColumn("_p", priority).filter("_p < 999")
    order = Window.partitionBy(key).orderBy("_p", "_rank", "turn", "name")
    return ranked.withColumn("rank", F.row_number().over(order)).filter(c("rank") <= few).select(key, "rank", "provider", "name", "title", "email")


def upsert_contacts(target: DataFrame, batch: DataFrame, fields: list[str]) -> DataFrame:
    """Contacts with a batch laid over them: a batch row (contact_id, company_id, email, turn and fields) meets a contact of the same
    company and address, or, without an address, the contact of its id; the last of several wins, and new ones come in."""
    who = lambda prefix="": F.when(F.coalesce(F.trim(c(prefix + "email")), F.lit("")) != "", F.concat_ws("|", F.lit("mail"), c(prefix + "company_id").cast("string"), F.lower(F.trim(c(prefix + "email"))))).otherwise(F.concat_ws("|", F.lit("id"), c(prefix + "contact_id").cast("string")))
    last = batch.withColumn("_key", who()).groupBy("_key").agg(F.max_by(F.struct("contact_id", "company_id", "email", *fields), c("turn")).alias("n"))
    old = target.withColumn("_key", who())
    both = old.join(last, "_key", "full_outer")
    kept = lambda f: F.coalesce(c(f"n.{f}"), c(f)).alias(f)
    return both.select(F.coalesce(c("contact_id"), c("n.contact_id")).alias("contact_id"), F.coalesce(c("company_id"), c("n.company_id")).alias("company_id"), F.coalesce(c("email"), c("n.email")).alias("email"), *[kept(f) for f in fields])


def cross_reference(df: DataFrame, dns: DataFrame, places: DataFrame, linkedin: DataFrame) -> DataFrame:
    """Companies against look-ups: mail servers and LinkedIn pages by domain, places by (name, city, state), of which the first five results
    are compared by name. dns: domain, mx. places: company_name, city, state, results (names). linkedin: domain, found. Each of those has one
    row per key; what wasn't looked up stays null. Companies without city and state aren't looked for among places."""
    out = df.withColumn("domain", F.nullif(extract_domain(c("website")), F.lit("")))
    out = out.join(dns.select("domain", c("mx").alias("dns_mx_valid")), "domain", "left").join(linkedin.select("domain", c("found").alias("linkedin_found")), "domain", "left")
    asked = has_value(c("company_name")) & (has_value(c("city")) | has_value(c("state")))
    text = lambda x: F.coalesce(F.trim(c(x)), F.lit(""))
    keys = ["company_name", "city", "state"]
    known = places.select(*[text(k).alias(f"_{k}") for k in keys], "results")
    out = out.join(known, reduce(lambda a, b: a & b, [text(k) == c(f"_{k}") for k in keys]) & asked, "left").drop(*[f"_{k}" for k in keys])
    met = F.exists(F.slice("results", 1, 5), lambda x: F.coalesce(names_match(c("company_name"), x), F.lit(False)))
    out = out.withColumn("places_matched", F.when(c("results").isNotNull(), met)).drop("results")
    points = lambda x, yes, no: F.when(c(x), yes).when(~c(x), no).otherwise(0)
    score = 50 + points("dns_mx_valid", 20, -20) + points("places_matched", 20, -10) + points("linkedin_found", 10, 0)
    issues = F.array_compact(F.array(F.when(~c("dns_mx_valid"), "invalid_domain"), F.when(~c("places_matched"), "address_not_found")))
    return out.withColumn("validation_score", F.least(F.lit(100), F.greatest(F.lit(0), score))).withColumn("issues", issues)


def validation_stats(df: DataFrame) -> DataFrame:
    """One row: how many look-ups of mail servers and places were good, bad or left out."""
    counts = []
    for x, good, bad, left_out in (("dns_mx_valid", "dns_valid", "dns_invalid", "dns_skipped"), ("places_matched", "places_matched", "places_unmatched", "places_skipped")):
        counts += [F.count_if(c(x)).alias(good), F.count_if(~c(x)).alias(bad), F.count_if(c(x).isNull()).alias(left_out)]
    return df.agg(*counts)
