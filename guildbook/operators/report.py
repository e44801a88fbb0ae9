"""Summaries behind reports: distributions, coverage, density, overlap, rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guildbook.operators.store import written

c = F.col


def distribution(df: DataFrame, column: str, default: str = "Unknown", top: int | None = None) -> DataFrame:
    """Rows per value; blank counts as the default; with top, the most frequent ones, ties by name."""
    out = df.groupBy(F.coalesce(F.when(F.trim(c(column)) != "", c(column)), F.lit(default)).alias("value")).agg(F.count("*").alias("n"))
    return out.orderBy(F.desc("n"), "value").limit(top) if top else out


def array_distribution(df: DataFrame, column: Column) -> DataFrame:
    return df.select(F.explode(column).alias("value")).groupBy("value").agg(F.count("*").alias("n"))


def top_k_other(df: DataFrame, column: str, k: int, default: str = "Unknown") -> DataFrame:
    """The k most frequent values and the rest as Other. The counts are ranked, never the rows."""
    counts = distribution(df, column, default)
    best = counts.orderBy(F.desc("n"), "value").limit(k)
    rest = counts.join(F.broadcast(best.select("value")), "value", "left_anti").agg(F.sum("n").alias("n")).filter("n is not null")
    return best.unionByName(rest.select(F.lit("Other").alias("value"), "n")).groupBy("value").agg(F.sum("n").alias("n"))


def field_coverage(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """Share of rows that have each field, in one pass."""
    row = df.agg(F.count("*").alias("rows"), *[F.count_if(present).alias(f) for f, present in fields.items()])
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), c(f).alias("filled")) for f in fields])
    return row.select("rows", F.inline(pairs)).select("field", "filled", F.round(100.0 * c("filled") / c("rows"), 6).alias("percent"))


def upper_median(column: str) -> Column:
    """The element at n // 2 of the sorted values."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {column} DESC)")


def top_per_group(df: DataFrame, group: list[str], value: str, k: int = 1) -> DataFrame:
    """The most frequent values of each group with their counts, ties by name."""
    counts = df.groupBy(*group, value).agg(F.count("*").alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("n"), value))).filter(c("rank") <= k)


def overlap(df: DataFrame, array: Column, key: str) -> DataFrame:
    """For each two values of a list column how many keys have both; the diagonal counts keys."""
    pairs = df.select(key, F.array_distinct(array).alias("v")).select(key, "v", F.explode("v").alias("a")).select("a", F.explode("v").alias("b"))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("shared"))


def histogram(df: DataFrame, score: str) -> DataFrame:
    """Ten buckets of a score from 0 to 100."""
    bucket = F.greatest(F.lit(0), F.least(F.floor(c(score) / 10), F.lit(9))).cast("int")
    return df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def latest(df: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(c("rank") <= k)


def tier_lists(df: DataFrame, caps: dict[str, int], whole: tuple[str, ...] = ()) -> DataFrame:
    """Companies ranked in their tier by fit, quality, id; tiers with a cap keep so many, those in whole keep all.

    Capped tiers are cut by a top-k before they are ranked; whole ones are sorted by ranges and ranked in each range, behind
    the rows of the ranges before it. So a tier's rows never meet in one task. The rows are written first: each list reads them, and
    the scores behind them are dear."""
    df = written(df, "ranked")
    order = [F.desc("icp_score"), F.desc("quality_score"), "company_id"]
    parts = [df.filter(c("tier") == tier).orderBy(*order).limit(cap) for tier, cap in caps.items()]
    parts = [p.withColumn("rank", F.row_number().over(Window.partitionBy("tier").orderBy(*order)).cast("long")) for p in parts]
    if whole:
        ranged = df.filter(c("tier").isin(*whole)).repartitionByRange("tier", *order)
        ranged = written(ranged.withColumn("_range", F.spark_partition_id()), "tiers")
        before = F.sum("_n").over(Window.partitionBy("tier").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
        offsets = ranged.groupBy("tier", "_range").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(before, F.lit(0)))
        within = F.row_number().over(Window.partitionBy("tier", "_range").orderBy(*order))
        ranked = ranged.join(offsets, ["tier", "_range"]).withColumn("rank", within + c("_before"))
        parts.append(ranked.select(*df.columns, "rank"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("rank", c("rank").cast("int"))


def daily_quota(df: DataFrame, domain: str, ts: str, tie: str, limit: int) -> DataFrame:
    """The first requests of each domain and day, up to the limit."""
    day = F.date_trunc("day", c(ts))
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(domain, day).orderBy(ts, tie))).filter(c("rank") <= limit)


def probe_summary(df: DataFrame, most: int = 3) -> DataFrame:
    """Per domain what its address probes gave: at most so many, and none after the first inconclusive one."""
    w = Window.partitionBy("domain").orderBy("turn")
    before = F.sum(F.when(c("outcome") == "inconclusive", 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    used = df.withColumn("rank", F.row_number().over(w)).withColumn("before", F.coalesce(before, F.lit(0))).filter((c("rank") <= most) & (c("before") == 0))
    good = c("outcome") == "verified"
    return used.groupBy("domain").agg(
        F.count("*").alias("probes"), F.count_if(good).alias("verified"), F.min_by(F.when(good, c("address")), F.when(good, c("turn"))).alias("first"),
        F.bool_or(c("outcome") == "inconclusive").alias("blocked"),
    )
