"""Regex matches with their places, in Spark's own string functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """One kind of span. pattern: a Java regex that never matches the empty string and never backtracks over long runs.
    needs: a literal that every match holds (a cheap test before the regex), or an empty string."""

    kind: str
    pattern: str
    needs: str = ""


def let(value: Column, body) -> Column:
    """body(value), with value computed once: a column that a lambda names is computed again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, fold, zero: int, block: int = 128) -> Column:
    """The running fold (a sum or a maximum) of an array of ints, one result per element. Done in blocks, whose totals are folded
    afterwards: an array that grows inside a fold is copied at each step, so one fold over all would take quadratic time."""
    none = F.expr("cast(array() as array<int>)")
    begin = F.struct(F.lit(zero).cast("int").alias("now"), none.alias("all"))

    def step(acc, x):
        now = fold(acc["now"], x)
        return F.struct(now.alias("now"), F.array_append(acc["all"], now).alias("all"))

    def blocks(v):
        count = F.ceil(F.size(v) / block).cast("int")
        places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(none)
        return F.transform(places, lambda k: F.aggregate(F.slice(v, k * block + 1, F.lit(block)), begin, step))

    def whole(b):
        totals = F.aggregate(F.transform(b, lambda x: x["now"]), begin, step, lambda acc: acc["all"])
        return let(totals, lambda t: F.flatten(F.transform(b, lambda x, i: F.transform(x["all"], lambda y: F.when(i == 0, y).otherwise(fold(F.get(t, i - 1), y))))))

    return let(values, lambda v: let(blocks(v), whole))


def with_matches(df: DataFrame, text: str, rules: list[Rule], before: int = 1, after: int = 1) -> DataFrame:
    """Adds for each rule a column `kind` of array<struct<at,to,hit,before,after>>: the leftmost non-overlapping matches in
    code points (end exclusive), with the text just before and after, as far as the neighbouring match.

    The pieces between the matches come from split(), the matches from regexp_extract_all(); a running sum of both lengths
    gives the places. Null text has no matches."""
    none = F.expr("cast(array() as array<string>)")
    no_gaps = F.expr("cast(array() as array<struct<n:int,tail:string,head:string>>)")

    def matches(rule: Rule) -> Column:
        quick = F.col(text).contains(rule.needs) if rule.needs else F.col(text).isNotNull()
        hits = F.when(quick, F.regexp_extract_all(F.col(text), F.lit(rule.pattern), F.lit(0))).otherwise(none)
        pieces = F.transform(F.split(F.col(text), rule.pattern, -1), lambda p: F.struct(F.length(p).alias("n"), F.right(p, F.lit(before)).alias("tail"), F.left(p, F.lit(after)).alias("head")))

        def placed(hit, gap):
            # A match begins behind all gaps up to it and all matches before it.
            steps = F.transform(hit, lambda x, i: gap[i]["n"] + F.when(i == 0, F.lit(0)).otherwise(F.length(F.get(hit, i - 1))))
            return let(
                running(steps, lambda a, b: a + b, 0),
                lambda at: F.transform(hit, lambda x, i: F.struct(at[i].alias("at"), (at[i] + F.length(x)).alias("to"), x.alias("hit"), gap[i]["tail"].alias("before"), gap[i + 1]["head"].alias("after"))),
            )

        return let(hits, lambda hit: let(F.when(F.size(hit) > 0, pieces).otherwise(no_gaps), lambda gap: placed(hit, gap)))

    return df.withColumns({r.kind: matches(r) for r in rules})


def joined(spans: Column, kinds: list[str]) -> Column:
    """kind:start:end, comma-joined, of an array of structs with rank (place in kinds), at and to."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["rank"]], s["at"].cast("string"), s["to"].cast("string"))), ",")
