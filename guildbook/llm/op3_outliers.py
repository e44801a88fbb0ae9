"""Quality rules and robust multivariate outliers.

Base rules count words, symbols and repetitions of every whole text. Their transformed statistics are vectors; per language
and source a minimum-covariance-determinant estimate of centre and scatter is made from all rows of the group, and a row
whose Mahalanobis distance is beyond the cutoff goes.

The estimate concentrates step by step from two starts (median and spread of each statistic; mean and covariance of all):
distances to the present estimate, the nearest share of rows, their mean and covariance, again. A step is one aggregation:
moments per group and bucket of the distance, which Spark sums on the map side whatever a group's size; a group's few hundred
buckets then give the nearest rows' moments. Steps go on until no determinant changes. The start with the smaller determinant
wins. No group is gathered anywhere.

The scatter of the nearest rows is too narrow for all rows; the consistency factor for normal data widens it, and the cutoff is
the quantile of the chi-square distribution with as many degrees of freedom as there are statistics. Only a variance below the
floor of its statistic is raised to that floor, so that a statistic that hardly varies in a group (no symbols in most texts)
doesn't reject every other value.

Groups of less than MIN_ROWS rows that pass the base rule are pooled by language, and then over all; if that is still too small,
all are kept.

Defined cases: null and empty texts have no words and fail the base rule; null language and null source are groups; every
row gives one row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guildbook.llm.common import staged, table
from guildbook.llm.words import Words, mix, slices, texts_of, windows

MIN_WORDS, REPEATED_SHARE, WINDOW = 10, 20, 5
#: Share of a group's rows the estimate rests on, most steps, rows a group needs, and the share of normal rows that are kept.
NEAREST, STEPS, MIN_ROWS, KEPT = 0.75, 20, 60, 0.9999
#: The statistics, and the least spread of each. Lines are few, so their share is taken of LINES more: one of five isn't a fault.
STATISTICS = ("log_words", "word_length", "symbols", "repeated_lines", "repeated_words")
FLOOR, LINES = (0.5, 0.12, 0.05, 0.06, 0.15), 20
P = len(STATISTICS)
BUCKETS = 12  # per factor e of the squared distance



def chi_square(x: float, degrees: int) -> float:
    """The distribution function for an odd number of degrees of freedom."""
    total, term = 0.0, 1.0
    for k in range((degrees - 1) // 2):
        total += term
        term *= x / (2 * k + 3)
    return math.erf(math.sqrt(x / 2)) - math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * total


def chi_square_quantile(share: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < share else (low, middle)
    return (low + high) / 2


#: What widens the scatter of the nearest rows to that of all, and the cutoff on the squared distance.
CONSISTENCY = NEAREST / chi_square(chi_square_quantile(NEAREST, P), P + 2)
CUTOFF = chi_square_quantile(KEPT, P)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def count_texts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    w = Words(texts)
    ones = np.ones(len(w.begin), np.int64)
    within = w.kinds > 0
    # Windows of five words of one text that occur twice in it: equal hashes, text by text.
    h = windows(w.hashes(), WINDOW)
    doc = w.doc[: len(h)]
    inside = np.flatnonzero(doc == w.doc[WINDOW - 1 :][: len(h)]) if len(h) else np.zeros(0, np.int64)
    keys = mix(h[inside] + mix(doc[inside].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    equal = keys[order][1:] == keys[order][:-1]
    twice = inside[order[np.append(equal, False) | np.append([False], equal)[: len(order)]]] if len(order) else inside
    cover = np.zeros(len(w.begin) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    repeated = (np.cumsum(cover[:-1]) > 0).astype(np.int64)

    def dup_lines(t: bytes) -> int:
        lines = [x for x in t.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
        return len(lines) - len(set(lines))

    return {
        "n_words": w.per_text(ones),
        "word_chars": w.bytes_per_text(within & ((w.buf & 0xC0) != 0x80)),
        "n_symbols": w.bytes_per_text(_SYMBOL[w.buf]),
        "n_dup_lines": np.array([dup_lines(t) for t in texts], np.int64),
        "n_repeat_words": w.per_text(repeated),
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def count_documents(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every row."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                got = count_texts(texts_of(part))
                lines = [t.count(b"\n") + 1 for t in texts_of(part)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("doc_id", "lang", "source")], *[pa.array(got[c]) for c in COUNTS], pa.array(lines, pa.int64())], ["doc_id", "lang", "source", *COUNTS, "n_lines"])

    types = {c: docs.schema[c].dataType.simpleString() for c in ("doc_id", "lang", "source")}
    schema = ", ".join([*[f"{c} {t}" for c, t in types.items()], *[f"{c} long" for c in COUNTS], "n_lines long"])
    return docs.select("doc_id", "lang", "source", "text").mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_SHARE * F.col("n_words"))


def vector() -> Column:
    """Logarithms of the sizes, and square roots of the shares."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return F.array(
        F.log(words.cast("double")),
        F.log(F.greatest(F.col("word_chars") / words, F.lit(0.5))),
        F.sqrt(F.col("n_symbols") / (F.col("word_chars") + 1)),
        F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + LINES)),
        F.sqrt(F.col("n_repeat_words") / words),
    )


def _groups(rows: DataFrame) -> DataFrame:
    """rows with `grp`: language and source, or what a group with few usable rows is pooled into; null where even all are too few."""
    usable = rows.filter(~F.col("base_failed"))
    sized = usable.groupBy("lang", "source").agg(F.count("*").alias("n"))
    names = sized.withColumn("small", F.col("n") < MIN_ROWS)
    by_lang = names.filter("small").groupBy("lang").agg(F.sum("n").alias("m"))
    total = usable.count()
    names = staged(names, "sizes").alias("s").join(by_lang.alias("l"), F.col("s.lang").eqNullSafe(F.col("l.lang")), "left").select("s.lang", "s.source", "small", "m")
    whole = F.to_json(F.struct(F.lit(2).alias("k"))) if total >= MIN_ROWS else F.lit(None).cast("string")
    grp = (
        F.when(~F.col("small"), F.to_json(F.struct(F.lit(0).alias("k"), F.col("lang"), F.col("source"))))
        .when(F.col("m") >= MIN_ROWS, F.to_json(F.struct(F.lit(1).alias("k"), F.col("lang"))))
        .otherwise(whole)
    )
    names = staged(names.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), grp.alias("grp")), "groups")
    return rows.join(names, rows["lang"].eqNullSafe(names["_lang"]) & rows["source"].eqNullSafe(names["_source"]), "left").drop("_lang", "_source")


_PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
MODEL = "grp string, start int, centre array<double>, inverse array<double>, logdet double, n long"


def _moments() -> list[Column]:
    x = [F.col("v")[i] for i in range(P)]
    return [F.array(*[F.sum(a) for a in x]).alias("s"), F.array(*[F.sum(x[i] * x[j]) for i, j in _PAIRS]).alias("q"), F.count("*").alias("n")]


def _estimate(n: float, s: np.ndarray, q: np.ndarray, wider: float = 1.0) -> tuple[np.ndarray, np.ndarray, float]:
    """Centre, inverse of the scatter (times wider) and the logarithm of its determinant; variances below the floor are raised to it."""
    centre = s / n
    scatter = np.zeros((P, P))
    for (i, j), x in zip(_PAIRS, q, strict=True):
        scatter[i, j] = scatter[j, i] = wider * (x / n - centre[i] * centre[j])
    scatter[np.diag_indices(P)] = np.maximum(np.diag(scatter), np.square(FLOOR))
    sign, logdet = np.linalg.slogdet(scatter)
    if sign <= 0 or not np.isfinite(logdet):
        scatter = np.diag(np.diag(scatter).clip(1e-6))
        logdet = float(np.log(np.diag(scatter)).sum())
    return centre, np.linalg.inv(scatter), float(logdet)


def distance(v: Column, centre: Column, inverse: Column) -> Column:
    """Squared Mahalanobis distance."""
    d = [v[i] - centre[i] for i in range(P)]
    return sum((d[i] * d[j] * inverse[i * P + j] for i in range(P) for j in range(P)), F.lit(0.0))


def _nearest(pdf: pd.DataFrame) -> pd.DataFrame:
    """The estimate from the nearest rows of one group: its buckets in order of distance until there are enough."""
    pdf = pdf.sort_values("bucket")
    n = pdf["n"].to_numpy()
    last = int(np.searchsorted(np.cumsum(n), NEAREST * n.sum()))
    take = slice(0, last + 1)
    centre, inverse, logdet = _estimate(n[take].sum(), np.stack(pdf["s"])[take].sum(axis=0), np.stack(pdf["q"])[take].sum(axis=0), CONSISTENCY)
    return pd.DataFrame({"grp": pdf["grp"].iloc[:1], "start": pdf["start"].iloc[:1], "centre": [centre.tolist()], "inverse": [inverse.ravel().tolist()], "logdet": [logdet], "n": [int(n.sum())]})


def _starts(rows: DataFrame) -> DataFrame:
    """For each group the model of each start."""
    middle = [F.percentile_approx(F.col("v")[i], F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(1000)).alias(f"m{i}") for i in range(P)]

    def run(pdfs):
        for pdf in pdfs:
            out = []
            for r in pdf.to_dict("records"):
                quarters = np.stack([r[f"m{i}"] for i in range(P)])
                spread = (quarters[:, 2] - quarters[:, 0]) / 1.349
                plain = np.diag(1 / np.maximum(np.square(spread), np.square(FLOOR)))
                out.append((r["grp"], 0, quarters[:, 1].tolist(), plain.ravel().tolist(), 0.0, r["n"]))
                centre, inverse, _ = _estimate(r["n"], np.array(r["s"]), np.array(r["q"]))
                out.append((r["grp"], 1, centre.tolist(), inverse.ravel().tolist(), 0.0, r["n"]))
            yield pd.DataFrame(out, columns=["grp", "start", "centre", "inverse", "logdet", "n"])

    return rows.groupBy("grp").agg(*_moments(), *middle).mapInPandas(run, MODEL)


def robust_models(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Per group the estimate of centre and inverse scatter. rows: grp and v."""
    models = staged(_starts(rows), "models")
    for _ in range(steps):
        far = distance(F.col("v"), F.col("centre"), F.col("inverse"))
        bucket = F.floor(BUCKETS * F.log(F.greatest(far, F.lit(1e-4)))).cast("int")
        placed = rows.join(models.select("grp", "start", "centre", "inverse"), "grp").select("grp", "start", "v", bucket.alias("bucket"))
        sums = placed.groupBy("grp", "start", "bucket").agg(*_moments())
        before = models.select("grp", "start", F.col("logdet").alias("was"))
        models = staged(sums.groupBy("grp", "start").applyInPandas(_nearest, MODEL), "models")
        if models.join(before, ["grp", "start"]).filter(F.abs(F.col("logdet") - F.col("was")) > 1e-3).isEmpty():
            break
    return models.groupBy("grp").agg(F.min_by(F.struct("centre", "inverse"), F.struct("logdet", "start")).alias("m")).select("grp", "m.centre", "m.inverse")


def judge(docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text, lang, source): doc_id, counts, base_failed, distance2 and kept."""
    counted = staged(count_documents(docs).withColumn("base_failed", base_failed()), "counts")
    rows = staged(_groups(counted).withColumn("v", vector()), "vectors")
    # Rows that the base rule rejects anyway don't take part in the estimates.
    models = staged(robust_models(rows.filter(~F.col("base_failed") & F.col("grp").isNotNull()).select("grp", "v")), "estimates")
    judged = rows.join(models, "grp", "left").withColumn("distance2", distance(F.col("v"), F.col("centre"), F.col("inverse")))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance2") <= CUTOFF, F.lit(True))
    return judged.select("doc_id", *COUNTS, "base_failed", "distance2", kept.alias("kept"))


def op3_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).drop("distance2")
