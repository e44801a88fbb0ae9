"""Entities that stay from run to run: new rows join those that are there, the rest make new ones; aliases, merges and provenance."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guildbook.operators.match import leader_clusters
from guildbook.operators.store import written

c = F.col
#: Fields of which the greater number stays, where both are numbers.
GREATEST = ["employee_count_min", "employee_count_max", "revenue_min_usd", "quality_score"]


def _something(df: DataFrame, field: str) -> Column:
    """Whether a value is neither null nor empty nor zero."""
    kind = df.schema[field].dataType.simpleString()
    if kind.startswith("array"):
        return F.coalesce(F.size(field) > 0, F.lit(False))
    return F.coalesce(c(field) != (F.lit("") if kind == "string" else F.lit(0).cast(kind)), F.lit(False))


def completeness(df: DataFrame, fields: list[str]) -> Column:
    """Percent of the fields that are something."""
    held = reduce(lambda a, b: a + b, [_something(df, f).cast("int") for f in fields])
    return F.floor(held * 100 / len(fields)).cast("int")


def resolve(new: DataFrame, existing: DataFrame | None, find: Callable[[DataFrame], DataFrame], row: str, fields: list[str], strategy: str = "keep_best", filled: list[str] | None = None) -> dict[str, DataFrame]:
    """New rows against the entities of earlier runs. new: row (a unique number), company_name, quality_score, fields, association and
    provenance (strings). existing: the entities that an earlier run gave. find: pairs (u, v) of a table with a column ord that match.

    Groups are those of a scan that takes existing entities first, then new rows, each in order (see leader_clusters). The group's entity
    is the existing one that leads it, or a new one; so an id never changes. The record with the best score (quality_score, else completeness
    over `filled`; the first on ties) is the base. keep_best takes it as it is; merge_all fills what it lacks from the others, best first,
    and takes the greater of numbers (GREATEST). Associations are united and sorted, provenance is joined, best first. Gives

    entities: entity_id, at, company_name, quality_score, fields, associations, provenance, records (of this run's group and before)
    aliases: entity_id, alias: other names of the group, and those that the entity had
    members: row, entity_id of new rows
    merges: kept, merged, through: existing entities that are one now (through is null), or that one new row meets (nothing is merged then).

    No group is collected but for the lists that an entity consists of. Rows without name or score are rows like others."""
    if strategy not in ("keep_best", "merge_all"):
        raise ValueError(f"no such strategy: {strategy}")
    common = ["company_name", "quality_score", *fields]
    node = lambda fresh, at: F.struct(F.lit(fresh).alias("fresh"), at.cast("long").alias("at"))
    listed = lambda x: F.when(F.coalesce(c(x), F.lit("")) != "", F.array(x)).otherwise(F.array().cast("array<string>"))
    every = new.select(node(1, c(row)).alias("ord"), F.lit(None).cast("string").alias("entity_id"), *common, listed("association").alias("associations"), listed("provenance").alias("provenance"), F.lit(1).cast("long").alias("records"), *[x for x in new.columns if x not in [row, *common, "association", "provenance"]])
    if existing is not None:
        old = existing.withColumn("ord", node(0, c("at"))).drop("at")
        every = every.unionByName(old, allowMissingColumns=True)
    every = written(every, "every")
    pairs = written(find(every).select("u", "v"), "matches")
    groups = leader_clusters(pairs).select(c("node").alias("ord"), "leader")
    score = F.when(_something(every, "quality_score"), c("quality_score")).otherwise(completeness(every, filled or ["company_name", *fields]))
    keyed = every.join(groups, "ord", "left").withColumn("leader", F.coalesce("leader", "ord")).withColumn("rank", F.struct((-score).alias("minus"), "ord"))
    keyed = written(keyed.withColumn("own_id", F.coalesce("entity_id", F.concat(F.lit("e"), F.substring(F.sha2(F.concat_ws("\x00", c("ord.at").cast("string"), F.coalesce("company_name", F.lit(""))), 256), 1, 16)))), "keyed")
    ids = keyed.filter(c("ord") == c("leader")).select("leader", c("own_id").alias("lead_id"), c("ord.at").alias("at"))

    value = []
    for f in common:
        best = F.min_by(c(f), c("rank"))
        if strategy == "merge_all" and f != "company_name":
            best = F.min_by(c(f), F.when(_something(keyed, f), c("rank")))
            if f in GREATEST:
                best = F.max(f)
        value.append(best.alias(f))
    parts = lambda x: F.transform(F.array_sort(F.collect_list(F.struct("rank", x))), lambda y: y[x])
    whole = keyed.groupBy("leader").agg(*value, F.array_sort(F.array_distinct(F.flatten(F.collect_list("associations")))).alias("associations"), F.flatten(parts("provenance")).alias("provenance"), F.sum("records").alias("records"))
    entities = written(whole.join(ids, "leader").select(c("lead_id").alias("entity_id"), "at", *common, "associations", "provenance", "records"), "entities")

    placed = keyed.join(ids.select("leader", "lead_id"), "leader")
    named = placed.select(c("lead_id").alias("entity_id"), c("company_name").alias("alias")).filter(F.coalesce("alias", F.lit("")) != "").distinct()
    aliases = named.join(entities.select("entity_id", "company_name"), "entity_id").filter(F.coalesce(c("alias") != c("company_name"), F.lit(True))).select("entity_id", "alias")
    members = placed.filter("ord.fresh = 1").select(c("ord.at").alias(row), c("lead_id").alias("entity_id"))
    old_pairs = pairs.filter("u.fresh = 0")
    known = keyed.filter("ord.fresh = 0").select(c("ord").alias("v"), c("entity_id").alias("merged"))
    joined = placed.filter("ord.fresh = 0 and ord <> leader").select(c("lead_id").alias("kept"), c("entity_id").alias("merged"), F.lit(None).cast("long").alias("through"))
    met = old_pairs.filter("v.fresh = 1").select(c("u").alias("v"), c("v").alias("row")).join(known, "v")
    lead = placed.filter("ord.fresh = 1").select(c("ord").alias("row"), c("lead_id").alias("kept"))
    met = met.join(lead, "row").filter(c("merged") != c("kept")).select("kept", "merged", c("row.at").alias("through"))
    return {"entities": entities, "aliases": aliases, "members": members, "merges": joined.unionByName(met)}


def alias_table(runs: list[DataFrame], entities: DataFrame) -> DataFrame:
    """(entity_id, alias) over several runs, without what is an entity's name now."""
    both = reduce(lambda a, b: a.unionByName(b), [r.select("entity_id", "alias") for r in runs]).distinct()
    now = entities.select("entity_id", c("company_name").alias("now"))
    return both.join(now, "entity_id", "left").filter(c("now").isNull() | (c("now") != c("alias"))).select("entity_id", "alias")
