"""Flat tables out of nested records: columns of each kind of export, fields of sales systems, JSON with a description."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guildbook.functions import tables

c = F.col
JOINED, LEFT_OUT = ["associations", "tech_stack"], ["provenance", "_meta"]


def flattened(df: DataFrame) -> DataFrame:
    """Records without nested values. Contacts become their number and the first one's name, mail and title (all null if there are none);
    associations and technologies are joined; other lists and maps are JSON; a record within becomes columns key_field; times are ISO
    texts. What tells a record's origin is left out."""
    out = []
    for f in df.schema:
        x = c(f"`{f.name}`")
        if f.name in LEFT_OUT:
            continue
        if f.name == "contacts" and isinstance(f.dataType, T.ArrayType):
            some, first = F.size(x) > 0, F.get(x, F.lit(0))
            has = set(f.dataType.elementType.names) if isinstance(f.dataType.elementType, T.StructType) else set()
            out.append(F.when(some, F.size(x)).alias("contact_count"))
            out += [(F.when(some, F.coalesce(first[k], F.lit(""))) if k in has else F.when(some, "")).alias(f"primary_contact_{n}") for n, k in (("name", "full_name"), ("email", "email"), ("title", "title"))]
        elif isinstance(f.dataType, T.ArrayType):
            out.append((F.array_join(x, "; ") if f.name in JOINED else F.to_json(x)).alias(f.name))
        elif isinstance(f.dataType, T.StructType):
            out += [x[k].alias(f"{f.name}_{k}") for k in f.dataType.names]
        elif isinstance(f.dataType, T.MapType):
            out.append(F.to_json(x).alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss").alias(f.name))
        else:
            out.append(x)
    return df.select(*out)


def export_table(df: DataFrame, kind: str) -> DataFrame:
    """The columns of a kind of export, in its order; those that the records lack are null. Of another kind: all columns."""
    flat = flattened(df)
    names = tables.EXPORT_COLUMNS.get(kind, flat.columns)
    return flat.select(*[c(f"`{n}`") if n in flat.columns else F.lit(None).cast("string").alias(n) for n in names])


def export_fields(df: DataFrame, mapping: dict[str, str], source: str, day: Column) -> DataFrame:
    """Only mapped fields that the records have, under the names of the sales system, with the source and the day."""
    flat = flattened(df)
    return flat.select(*[c(f"`{a}`").alias(b) for a, b in mapping.items() if a in flat.columns], F.lit(source).alias("Data_Source__c"), F.date_format(day, "yyyy-MM-dd").alias("Import_Date__c"))
