"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

Features of a text are its words (runs of letters and digits, runs of symbols), pairs of neighbouring words and n-grams of
word shapes, hashed into a fixed number of slots; a slot's value is its share of the text's features. A score is the sparse
dot product of these shares with the weights, through the logistic function.

Training reads a bounded sample of labelled rows (max_rows, the first by a hash of doc_id, from those whose crc32 mod 5 is
not 0); the labels' table is cut to that bound before it is broadcast to the documents. The weights are one array of fixed
size. Scoring is a map over whole texts, without a shuffle.

Defined cases: null and empty texts get the score of the constant alone; rows without doc_id are not held out; several labels
of one doc_id count as their smallest; null labels don't count; without labels, or with one class only, the score is the share
of good labels (0.5 without any); every row gives one row; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guildbook.llm.common import table
from guildbook.llm.words import Words, mix, slices, texts_of, windows

SLOTS = 1 << 18
MAX_ROWS = 8000
CUTOFF = 0.3
#: FTRL: learning rate, its offset, and the weights of the absolute and the squared penalty; passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.002, 0.01, 4
SCALE = 8.0

#: Classes of bytes: blank, letter or digit, other symbol.
KIND = np.full(256, 2, np.uint8)
KIND[[*b" \t\n\x0b\x0c\r"]] = 0
KIND[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", *range(128, 256)]] = 1
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1


def features(texts: list[bytes], slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all features of all texts in order, and where each text's begin (with the end appended)."""
    w = Words(texts, KIND)
    if not len(w.begin):
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    h = w.hashes()
    length = w.end - w.begin
    upper = np.add.reduceat(_UPPER[w.buf], w.begin)
    digit = np.add.reduceat(_DIGIT[w.buf], w.begin)
    symbol = w.kinds[w.begin] == 2
    again = np.append(False, h[1:] == h[:-1])
    shape = (_UPPER[w.buf[w.begin]] + 2 * ((upper == length) & (length > 1)) + 4 * (digit > 0) + 8 * symbol + 16 * again + 32 * np.minimum(length // 4, 3)).astype(np.uint64)
    shape = mix(shape + np.uint64(1))
    kinds = [h, shape, windows(h, 2) + np.uint64(2), windows(shape, 3) + np.uint64(3)]
    out, doc = [], []
    for k, (values, n) in enumerate(zip(kinds, (1, 1, 2, 3), strict=True)):
        inside = w.doc[: len(values)] == w.doc[n - 1 :][: len(values)]
        out.append((mix(values[inside] + np.uint64(k)) % np.uint64(slots)).astype(np.int64))
        doc.append(w.doc[: len(values)][inside])
    doc_all = np.concatenate(doc)
    order = np.argsort(doc_all, kind="stable")
    return np.concatenate(out)[order], np.searchsorted(doc_all[order], np.arange(len(texts) + 1))


def train(texts: list[bytes], labels: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Weights of the slots and, last, the constant."""
    weights = np.zeros(slots + 1, np.float32)
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    weights[slots] = math.log(share / (1 - share))
    if len(set(labels.tolist())) < 2:
        return weights
    rows = []
    for k in range(0, len(texts), 64):
        slot, at = features(texts[k : k + 64], slots)
        for a, b in zip(at[:-1], at[1:], strict=True):
            ids, counts = np.unique(slot[a:b], return_counts=True)
            rows.append((ids.astype(np.int32), (SCALE * counts / max(1, b - a)).astype(np.float32)))
    z, n = np.zeros(slots), np.zeros(slots)
    z0 = n0 = 0.0
    base = float(weights[slots])

    def now(zs, ns):
        return np.where(np.abs(zs) <= L1, 0.0, (np.sign(zs) * L1 - zs) / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    for turn in range(PASSES):
        for i in np.random.default_rng(turn).permutation(len(rows)):
            ids, x = rows[i]
            zs, ns = z[ids], n[ids]
            w = now(zs, ns)
            w0 = -z0 / ((BETA + math.sqrt(n0)) / ALPHA)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, base + w0 + float(w @ x)))))
            g = (p - labels[i]) * x
            g2 = g * g
            z[ids] = zs + g - (np.sqrt(ns + g2) - np.sqrt(ns)) / ALPHA * w
            n[ids] = ns + g2
            g0 = p - labels[i]
            z0 += g0 - (math.sqrt(n0 + g0 * g0) - math.sqrt(n0)) / ALPHA * w0
            n0 += g0 * g0
    weights[:slots] = now(z, n)
    weights[slots] = base - z0 / ((BETA + math.sqrt(n0)) / ALPHA)
    return weights


def score(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    slot, at = features(texts, len(weights) - 1)
    total = np.concatenate([[0.0], np.cumsum(weights[slot], dtype=np.float64)])
    mean = (total[at[1:]] - total[at[:-1]]) / np.maximum(1, np.diff(at))
    return 1 / (1 + np.exp(-np.clip(float(weights[-1]) + SCALE * mean, -30, 30)))


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> np.ndarray:
    """Weights from a bounded sample of the labelled rows that are not held out."""
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = F.xxhash64("doc_id")
    # max_rows rows of two numbers: small enough for a broadcast whatever the input.
    sample = usable.orderBy(order, "doc_id").limit(max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "quality")
    # One text per sampled doc_id, the one with the least digest, so that repeated ids don't grow the sample.
    rows = rows.groupBy("doc_id", "quality").agg(F.min_by("text", F.sha2("text", 256)).alias("text")).select("doc_id", "text", "quality")

    def learn(pdfs):
        pdf = pd.concat([*pdfs, pd.DataFrame({"doc_id": [], "text": [], "quality": []})])
        pdf = pdf.sort_values(["doc_id", "text"], kind="stable").head(max_rows)
        weights = train([t.encode() for t in pdf["text"]], pdf["quality"].to_numpy(np.float64))
        yield pd.DataFrame({"weights": [weights.tobytes()]})

    found = rows.repartition(1).mapInPandas(learn, "weights binary").collect()
    return np.frombuffer(found[0]["weights"], np.float32) if found else train([], np.zeros(0))


def score_documents(docs: DataFrame, weights: np.ndarray, columns: list[str] | None = None, score_name: str = "score") -> DataFrame:
    """The given columns of docs (doc_id if none are given) and the score of text."""
    columns = columns or ["doc_id"]
    held = docs.sparkSession.sparkContext.broadcast(weights)
    kept = docs.select(*dict.fromkeys([*columns, "text"]))

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                scores = score(texts_of(part), held.value)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], pa.array(scores)], [*columns, score_name])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns) + f", `{score_name}` double"
    return kept.mapInArrow(run, schema)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))
