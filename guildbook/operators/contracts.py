"""Records of JSON held against a description of their fields: types, ranges, lengths, values, unknown fields, lists of nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col
NUMBER = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT)"
KINDS = {"string": "^STRING", "boolean": "^BOOLEAN", "number": NUMBER, "integer": NUMBER, "array": "^ARRAY", "object": "^OBJECT"}


def _judge(x: Column, rule: dict, name: Column) -> Column:
    """What is wrong with one value that is there: an array of texts."""
    kind = F.schema_of_variant(x)
    is_kind = kind.rlike(KINDS[rule["type"]])
    number, text = F.try_variant_get(x, "$", "double"), F.try_variant_get(x, "$", "string")
    if rule["type"] == "integer":
        is_kind &= number == F.floor(number)
    wrong = [
        (number < rule["least"], f"below {rule['least']}") if "least" in rule else None,
        (number > rule["most"], f"above {rule['most']}") if "most" in rule else None,
        (F.length(text) < rule["shortest"], f"shorter than {rule['shortest']}") if "shortest" in rule else None,
        (F.length(text) > rule["longest"], f"longer than {rule['longest']}") if "longest" in rule else None,
        (~text.isin(rule["one_of"]), "not one of the values") if "one_of" in rule else None,
    ]
    said = lambda what: F.concat(name, F.lit(f": {what}"))
    found = F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(bad, said(what)) for bad, what in filter(None, wrong)]))
    items = rule.get("items")
    if items is not None:
        at = lambda i: F.concat(name, F.lit("["), i.cast("string"), F.lit("]"))
        one = (lambda y, i: _judge(y, items, at(i))) if isinstance(items.get("type"), str) else (lambda y, i: _fields(y, items, at(i)))
        found = F.flatten(F.transform(F.try_variant_get(x, "$", "array<variant>"), one))
    judged = F.when(is_kind, found).otherwise(F.array(said(f"no {rule['type']}")))
    return F.when(kind == "VOID", F.array().cast("array<string>") if rule.get("null") else F.array(said(f"no {rule['type']}"))).otherwise(judged)


def _fields(record: Column, fields: dict[str, dict], name: Column | None) -> Column:
    """What is wrong with a record: its fields in the order of the description, then its unknown fields by name."""
    full = lambda f: F.lit(f) if name is None else F.concat(name, F.lit(f".{f}"))
    parts = []
    for f, rule in fields.items():
        x = F.try_variant_get(record, f"$['{f}']", "variant")
        missing = F.array(F.concat(full(f), F.lit(": missing"))) if rule.get("needed") else F.array().cast("array<string>")
        parts.append(F.when(x.isNull(), missing).otherwise(_judge(x, rule, full(f))))
    keys = F.map_keys(F.try_variant_get(record, "$", "map<string,variant>"))
    unknown = F.transform(F.array_sort(F.filter(keys, lambda k: ~k.isin(list(fields)))), lambda k: F.concat(*([] if name is None else [name, F.lit(".")]), k, F.lit(": unknown")))
    whole = F.lit("record") if name is None else name
    return F.when(F.schema_of_variant(record).startswith("OBJECT"), F.flatten(F.array(*parts, unknown))).otherwise(F.array(F.concat(whole, F.lit(": no object"))))


def violations(record: Column, fields: dict[str, dict]) -> Column:
    """All violations of a JSON text, in order, as an array; a null text, or one that isn't JSON, has one."""
    parsed = F.try_parse_json(record)
    return F.when(parsed.isNull(), F.array(F.lit("record: no JSON"))).otherwise(_fields(parsed, fields, None))


def check_records(df: DataFrame, key: str, record: str, fields: dict[str, dict]) -> DataFrame:
    """A row for each violation of each record: key, turn (from 0) and violation."""
    return df.select(key, F.posexplode(violations(c(record), fields)).alias("turn", "violation"))


def split_by_contract(df: DataFrame, record: str, fields: dict[str, dict]) -> tuple[DataFrame, DataFrame]:
    """Rows whose record has no violation, and the others with their violations."""
    marked = df.withColumn("violations", violations(c(record), fields))
    return marked.filter(F.size("violations") == 0).drop("violations"), marked.filter(F.size("violations") > 0)
