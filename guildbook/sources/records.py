"""Reading and writing records: JSON lines, CSV, exports for sales systems, rejects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from guildbook.functions.text import text_list

c = F.col
CORRUPT = "_corrupt_record"


def read_records(spark: SparkSession, paths, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """JSON lines: good rows, and broken lines as they are. Blank lines are neither."""
    full = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    lines = spark.read.text(paths).filter(F.trim("value") != "")
    parsed = lines.select(F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"), "value")
    good = parsed.filter(c(f"r.{CORRUPT}").isNull()).select(*[c(f"r.{f.name}") for f in schema.fields])
    return good, parsed.filter(c(f"r.{CORRUPT}").isNotNull()).select("value")


def read_company_csv(spark: SparkSession, path) -> DataFrame:
    """CSV with a header: numbers with 0 for what is none, "Name <mail>; ..." as contacts, joined lists as arrays."""
    df = spark.read.option("header", True).csv(path)
    number = lambda name: F.coalesce(F.expr(f"try_cast({name} as int)"), F.lit(0)).alias(name)
    one = lambda x: F.struct(F.trim(F.regexp_replace(x, "<.*", "")).alias("name"), F.nullif(F.regexp_extract(x, "<([^>]*)>", 1), F.lit("")).alias("email"))
    special = {"quality_score": number("quality_score"), "employee_count": number("employee_count"), "contacts": F.transform(text_list(c("contacts")), one).alias("contacts")}
    special |= {k: text_list(c(k)).alias(k) for k in ("tech_stack", "associations")}
    return df.select(*[special[x] if x in special else c(x) for x in df.columns])


def load_by_source_rank(df: DataFrame, group: str, rank: str) -> DataFrame:
    """Rows of each group's best source only; rank 0 always stays. One small aggregate and a join."""
    best = df.filter(c(rank) > 0).groupBy(group).agg(F.min(rank).alias("_best"))
    covered = df.filter(c(rank) == 0).select(group).distinct().withColumn("_covered", F.lit(True))
    out = df.join(best, group, "left").join(covered, group, "left")
    return out.filter((c(rank) == 0) | (c("_covered").isNull() & (c(rank) == c("_best")))).drop("_best", "_covered")


def export_rows(df: DataFrame, lists: list[str] = ()) -> DataFrame:
    """Flat rows of an export: number of contacts, the first one's fields, lists joined."""
    first = F.get(c("contacts"), F.lit(0))
    flat = df.withColumns({"contact_count": F.size("contacts"), "contact_name": first["name"], "contact_email": first["email"]} | {k: F.array_join(k, "; ") for k in lists})
    return flat.drop("contacts")


def export_crm(df: DataFrame, mapping: dict[str, str], source: str, imported: Column) -> DataFrame:
    """Only mapped fields, under the names of the sales system, with source and date."""
    return df.select(*[c(a).alias(b) for a, b in mapping.items()], F.lit(source).alias("LeadSource"), imported.alias("ImportDate"))


def split_rejects(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all checks, and the others with what is wrong."""
    wrong = F.array_compact(F.array(*[F.when(bad, name) for name, bad in checks.items()]))
    marked = df.withColumn("errors", wrong)
    return marked.filter(F.size("errors") == 0).drop("errors"), marked.filter(F.size("errors") > 0)


def write_rejects(rejects: DataFrame, folder: str, day: Column) -> None:
    rejects.withColumn("day", day).write.mode("append").partitionBy("day").json(folder)


def write_records(df: DataFrame, folder: str) -> None:
    """JSON lines; Spark's committer shows them all at once."""
    df.write.mode("overwrite").json(folder)


def explode_contacts(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(*keep, F.inline("contacts"))


def import_members(df: DataFrame, name: str, code: str, extra: dict[str, str]) -> DataFrame:
    """A member sheet as records: trimmed texts, rows without a name out."""
    text = lambda x: F.trim(F.coalesce(c(x).cast("string"), F.lit("")))
    return df.select(text(name).alias("company_name"), *[text(a).alias(b) for a, b in extra.items()], F.lit(code).alias("association")).filter("company_name <> ''")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
