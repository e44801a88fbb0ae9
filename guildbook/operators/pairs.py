"""Pairs of rows whose weighted likeness may reach a bound, without all pairs of a block.

What a pair can reach follows from which fields both rows have and which of the exact ones are equal. For each such case that can reach
the bound the equal values are a key (with the block and with what either row has), and the case leaves a least likeness of the
first fuzzy field. Small groups of a key are paired at once. In large ones the texts' tokens are an inverted index: of two texts as like
as that, the rarest tokens meet (prefixes whose lengths follow from the likeness), so a pair is found without losing any.

Tokens are pairs of neighbouring characters with their count so far. With a characters deleted and b inserted, at most 2a + b pairs
of a text are lost, so texts x and y of likeness s share (1.5 s - 1)(|x| + |y|) - 1 at least. Texts so short that this says
nothing are found among each other by single characters, of which s(|x| + |y|) / 2 are shared.

Keys and tokens are hashes: where two are equal by chance more is tried, and nothing is lost. A text's tokens are made where it is met and
never sorted or sent as lists; tables are joined by merging, as files of few bytes hold many rows, too many for a broadcast.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guildbook.operators.store import written

c = F.col
TOLERANCE = 1e-9
#: Rows of a key up to which they are paired at once.
SMALL = 64
#: Rows of a join's side in one task, so that what it sorts doesn't grow with the table.
PER_TASK = 250_000
#: Classes of tokens whose frequencies are counted.
CLASSES = 1 << 16


def present(field: Column) -> Column:
    return F.coalesce(field.cast("string"), F.lit("")) != ""


def cases(own: int, other: int, exact: dict[str, float], fuzzy: dict[str, float], threshold: float) -> list[tuple[int, int | None, float]]:
    """For rows that have the fields of two masks (bits in the order exact, fuzzy): the sets of equal fields that can reach the
    threshold, the fuzzy field that must be like (its place, None if there is none), and how like at least."""
    names, weights = [*exact, *fuzzy], [*exact.values(), *fuzzy.values()]
    both = [k for k in range(len(names)) if own & other & 1 << k]
    total = sum(weights[k] for k in both)
    if not total:
        return []
    like = [k for k in both if k >= len(exact)]
    out = []
    for chosen in product((False, True), repeat=len(both) - len(like)):
        equal = [k for k, yes in zip(both, chosen, strict=False) if yes]
        points = sum(weights[k] for k in equal)
        need = (threshold - TOLERANCE) * total - points
        rest = sum(weights[k] for k in like)
        if rest + TOLERANCE < need:
            continue
        least = min(1.0, (need - (rest - weights[like[0]])) / weights[like[0]]) if like else 0.0
        out.append((sum(1 << k for k in equal), like[0] if like and least > 0 else None, max(0.0, least)))
    return out


def keyed(df: DataFrame, blocks: list[str], exact: dict[str, Column], weights: tuple[dict[str, float], dict[str, float]], threshold: float) -> DataFrame:
    """(ord, key, role, twin, field, need) of rows (ord, exact and fuzzy fields, blocks); field: the fuzzy field that must be like."""
    names = [*weights[0], *weights[1]]
    mask = reduce(lambda a, b: a + b, [F.when(present(c(n)), 1 << k).otherwise(0) for k, n in enumerate(names)])
    rows = df.withColumn("mask", mask)
    masks = [r["mask"] for r in rows.select("mask").distinct().collect()]  # at most two to the power of the number of fields
    plans = [(a, min(a, b), max(a, b), e, None if k is None else names[k], s) for a in masks for b in masks for e, k, s in cases(a, b, *weights, threshold)]
    plan = df.sparkSession.createDataFrame(plans, "mask int, low int, high int, equal int, field string, need double")
    value = F.concat_ws("\x01", *[F.when(c("equal").bitwiseAND(1 << k) != 0, exact[n]) for k, n in enumerate(weights[0])])
    block = F.explode(F.array(*[F.struct(F.lit(b).alias("name"), c(b).cast("string").alias("value")) for b in blocks]))
    rows = rows.withColumn("block", block).filter(present(c("block.value"))).join(F.broadcast(plan), "mask")  # a few hundred rows at most
    key = F.xxhash64("block.name", "block.value", "low", "high", "equal", value)
    return rows.select("ord", key.alias("key"), F.when(c("mask") == c("low"), 0).otherwise(1).alias("role"), (c("low") == c("high")).alias("twin"), "field", "need")


_MET = "a.key = b.key AND a.ord <> b.ord AND (a.twin AND a.ord < b.ord OR NOT a.twin AND a.role = 0 AND b.role = 1)"


def tokens(text: str) -> tuple[list[int], list[int]]:
    """Hashes of a text's pairs of neighbouring characters, and of its characters, each with its count so far."""
    out = []
    for parts in ([text[i : i + 2] for i in range(len(text) - 1)], text):
        seen: dict[str, int] = {}
        hashes = []
        for t in parts:
            seen[t] = nth = seen.get(t, 0) + 1
            hashes.append(zlib.crc32(f"{t}\x00{nth}".encode("utf-8", "surrogatepass")))
        out.append(hashes)
    return out[0], out[1]


def dealt(df: DataFrame, rows: int, key: str) -> DataFrame:
    """df by a key in as many parts as its rows need; by itself Spark puts short rows of many parts in one, up to one for each core."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // PER_TASK)), key)


def frequencies(df: DataFrame, fields: list[str]) -> np.ndarray:
    """How often tokens of each class are in the texts, CLASSES numbers whatever the table's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.zeros(CLASSES, np.int64)
        for batch in batches:
            for column in batch.columns:
                found = [x for text in column.to_pylist() if text for part in tokens(text) for x in part]
                often += np.bincount(np.array(found, np.int64) % CLASSES, minlength=CLASSES)
        at = np.flatnonzero(often)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(often[at])], ["class", "often"])

    counted = df.select(*[c(f).cast("string") for f in fields]).mapInArrow(run, "class long, often long").groupBy("class").agg(F.sum("often").alias("often"))
    often = np.zeros(CLASSES, np.int64)
    for row in counted.collect():
        often[row["class"]] = row["often"]
    return often


def rarest(text: str, need: float, often: np.ndarray) -> list[int]:
    """The tokens of a text by which all texts find it that are as like as needed: all texts have one order of tokens, rare classes first."""
    n = len(text)
    order = lambda found: sorted(found, key=lambda x: (often[x % CLASSES], x))
    first = lambda found, most: order(found)[: max(0, min(len(found), len(found) - most + 1))]
    pairs, chars = tokens(text)
    shared = math.ceil((need * 1.5 - 1) * 2 * n / (2 - need) - 1 - TOLERANCE)
    return first(pairs, max(shared, 1)) + (first(chars, math.ceil(need * n / (2 - need) - TOLERANCE)) if shared < 1 else [])


def indexed(large: DataFrame, often: np.ndarray) -> DataFrame:
    """A row for each chosen token of large (ord, key, role, twin, need, text), with the length n in the place of the text."""
    kept = ["ord", "key", "role", "twin", "need"]
    schema = T.StructType([large.schema[x] for x in kept] + [T.StructField("n", T.IntegerType()), T.StructField("token", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[tuple[str, float], list[int]] = {}
            lists, texts = [], batch.column("text").to_pylist()
            for x in zip(texts, batch.column("need").to_pylist(), strict=True):
                if x not in known:
                    known[x] = rarest(*x, often)
                lists.append(known[x])
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            rows = pa.array(np.repeat(np.arange(len(lists)), sizes))
            n = np.repeat(np.fromiter(map(len, texts), np.int32, len(texts)), sizes)
            flat = np.fromiter((t for x in lists for t in x), np.int64, int(sizes.sum()))
            yield pa.RecordBatch.from_arrays([*[batch.column(x).take(rows) for x in kept], pa.array(n), pa.array(flat)], schema.names)

    return large.select(*kept, "text").mapInArrow(run, schema)


def tried_pairs(df: DataFrame, blocks: list[str], exact: dict[str, Column], weights: tuple[dict[str, float], dict[str, float]], threshold: float) -> DataFrame:
    """(u, v), u < v, once each: every pair of rows (ord, fields, blocks) that shares a block and reaches the threshold, and some more."""
    rows = written(keyed(df, blocks, exact, weights, threshold), "keys")
    rows = dealt(rows, rows.count(), "key")
    size = rows.groupBy("key").agg(F.count("*").alias("size"), F.max("role").alias("top"), F.min("role").alias("least"), F.bool_or("twin").alias("one"))
    size = size.filter("size > 1 and (one or top <> least)").select("key", (c("size") > SMALL).alias("large"))
    rows = written(rows.join(size.hint("merge"), "key"), "shared")
    order = lambda x: x.select(F.least("a.ord", "b.ord").alias("u"), F.greatest("a.ord", "b.ord").alias("v"))
    small = rows.filter(~c("large") | c("field").isNull()).select("ord", "key", "role", "twin")
    small = dealt(small, small.count(), "key")
    found = order(small.alias("a").join(small.hint("merge").alias("b"), F.expr(_MET)))

    fuzzy = list(weights[1])
    text = F.coalesce(*[F.when(c("field") == f, c(f).cast("string")) for f in fuzzy])
    large = rows.filter(c("large") & c("field").isNotNull())
    n = large.count()
    large = dealt(large, n, "ord").join(dealt(df.select("ord", *fuzzy), n, "ord").hint("merge"), "ord").withColumn("text", text).filter(present(c("text")))
    large = written(large.select("ord", "key", "role", "twin", "need", "text"), "large")
    same = ["key", "role", "twin", "need", "text"]
    texts = written(large.groupBy(*same).agg((F.count("*") > 1).alias("several")).withColumn("at", F.monotonically_increasing_id()), "texts")
    members = written(dealt(large, n, "key").join(dealt(texts, n, "key").hint("merge"), same).select("at", "ord"), "members")
    alike = _alike(texts, frequencies(df, fuzzy))
    side = lambda name, at: dealt(members, n, "at").select(c("at").alias(at), c("ord").alias(name)).hint("merge")
    met = dealt(dealt(alike, n, "x").join(side("a", "x"), "x"), n, "y").join(side("b", "y"), "y").filter("a <> b and (x <> y or a < b)")
    found = found.unionByName(met.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")))
    return written(found.distinct(), "tried")


def _alike(texts: DataFrame, often: np.ndarray) -> DataFrame:
    """(x, y), once each: the texts of one key that are as like as it needs, by the edit distance that this leaves; a text of several rows
    of one kind is like itself. Rows of one key and text are one text here, so that its tokens meet once and not for each pair of rows."""
    index = indexed(texts.withColumnRenamed("at", "ord"), often).withColumn("key", F.xxhash64("key", "token")).drop("token")
    index = written(index, "index")
    index = dealt(index, index.count(), "key")
    near = F.expr("least(a.n, b.n) * (2 - a.need) >= a.need * greatest(a.n, b.n) - 1e-9")
    met = index.alias("a").join(index.hint("merge").alias("b"), F.expr(_MET) & near)
    met = written(met.select(c("a.ord").alias("x"), c("b.ord").alias("y")).distinct(), "met")
    n = max(met.count(), texts.count())
    side = lambda at, *more: dealt(texts.select(c("at").alias(at), c("text").alias(f"text_{at}"), *more), n, at).hint("merge")
    both = dealt(dealt(met, n, "x").join(side("x", "need"), "x"), n, "y").join(side("y"), "y")
    a, b = c("text_x"), c("text_y")
    both = both.filter(F.levenshtein(a, b) <= F.floor((1 - c("need")) * (F.length(a) + F.length(b)) + TOLERANCE)).select("x", "y")
    return written(both.unionByName(texts.filter("twin and several").select(c("at").alias("x"), c("at").alias("y"))), "alike")


def with_rows(pairs: DataFrame, df: DataFrame, columns: list[str]) -> DataFrame:
    """Written pairs with the columns of both rows of a written table, as a_... and b_...."""
    n = max(pairs.count(), df.count())
    side = lambda at, name: dealt(df.select(c("ord").alias(at), *[c(x).alias(f"{name}_{x}") for x in columns]), n, at).hint("merge")
    return dealt(dealt(pairs, n, "u").join(side("u", "a"), "u"), n, "v").join(side("v", "b"), "v")
