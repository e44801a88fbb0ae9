"""Whitening of embeddings by spectral divide and conquer on polar decompositions (QDWH).

Three passes over the vectors: whole-number sums per dimension (so the mean is exact), the covariance of the centred vectors
(each task adds up one matrix, Spark adds up the tasks' rows), and the projection of every vector on the components found. What
reaches the driver is one matrix per length of vector, whose size depends on the number of dimensions only.

Components come from that matrix without an eigenvalue routine: the polar factor of the matrix less a shift, by dynamically weighted
Halley steps, is +1 on the components above the shift and -1 on those below. Half of its sum with the identity projects on the
upper ones; an orthonormal basis of its range and one of the complement split the matrix in two, and the parts are split again until
they are single components. Upper parts are split first, so that it can end when the wanted components are there.

Defined cases: rows whose vector is null or holds null, NaN, infinite or very large (2^30 and more) entries go; vectors of each length are
whitened on their own, those of length zero have no components; repeated rows and rows without vec_id count like any other; a component
without variance (or below 1e-12 of the greatest) has null whitened values; equal variances give any basis of their components; no table
may have lengths whose squares sum to more than MOST_CELLS (ValueError); empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guildbook.llm.common import staged, table

#: Components returned, steps of 1/SCALE that entries are cut to, what is added, and the entries that are too large.
KEEP, SCALE, OFFSET, LARGE = 8, 1024, 100_000, 2.0**30
#: Cells of all matrices together, and the share of the greatest variance below which a component has none.
MOST_CELLS, NOTHING = 1 << 25, 1e-12


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGE))


def _blocks(batch: pa.RecordBatch):
    """For each length of vector in a batch: the length, which rows, and their entries as a matrix of whole numbers."""
    lists = batch.column("vector")
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    for d in np.unique(lengths[lengths > 0]).tolist():
        which = np.flatnonzero(lengths == d)
        entries = lists.take(pa.array(which)).flatten().to_numpy(zero_copy_only=False)
        yield d, which, np.floor(SCALE * entries.reshape(-1, d)).astype(np.int64) + OFFSET


def totals(vectors: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """For each length the number of vectors and the exact sum per dimension."""

    def run(batches):
        for batch in batches:
            for d, which, x in _blocks(batch):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, len(which))), pa.array(x.sum(axis=0))], ["d", "i", "n", "total"])

    sums = vectors.select("vector").mapInArrow(run, "d int, i int, n long, total long")
    sums = sums.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    lengths = [r["d"] for r in sums.filter("i = 0").select("d").collect()]
    if sum(d * d for d in lengths) > MOST_CELLS:
        raise ValueError(f"vectors of {len(lengths)} lengths up to {max(lengths)}: their matrices have more than {MOST_CELLS} cells")
    out: dict[int, tuple[int, list[int]]] = {d: (0, [0] * d) for d in lengths}
    for r in sums.collect():
        out[r["d"]][1][r["i"]] = int(r["total"])
        out[r["d"]] = (r["n"], out[r["d"]][1])
    return out


def covariances(vectors: DataFrame, sums: dict[int, tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """For each length the covariance, divisor n, of vectors centred before they are multiplied."""
    means = {d: np.array([s / n for s in total]) for d, (n, total) in sums.items()}

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in _blocks(batch):
                centred = x - means[d]
                held[d] = held.get(d, 0) + centred.T @ centred
        for d, m in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)), pa.array(list(m), pa.list_(pa.float64()))], ["d", "i", "row"])

    cells = vectors.select("vector").mapInArrow(run, "d int, i int, row array<double>").select("d", "i", F.posexplode("row").alias("j", "v"))
    out = {d: np.zeros((d, d)) for d in sums}
    for r in cells.groupBy("d", "i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["d"]][r["i"], r["j"]] = r["v"] / sums[r["d"]][0]
    return {d: (m + m.T) / 2 for d, m in out.items()}


def polar(a: np.ndarray, most: int = 20) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix's polar decomposition: its eigenvalues turn into their signs. Each step has the
    weights that are best for singular values between `low` and 1; badly conditioned steps go by QR, the others by Cholesky."""
    x = a / np.linalg.norm(a)
    low, eye = np.finfo(float).eps, np.eye(len(a))
    for _ in range(most):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2) if low < 1 else 0.0
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q = np.linalg.qr(np.concatenate([np.sqrt(wc) * x, eye]))[0]
            after = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[: len(a)] @ q[len(a) :].T)
        else:
            half = np.linalg.solve(np.linalg.cholesky(eye + wc * (x.T @ x)), x.T)
            after = wb / wc * x + (wa - wb / wc) * np.linalg.solve(np.linalg.cholesky(eye + wc * (x.T @ x)).T, half).T
        after = (after + after.T) / 2
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        moved, x = np.linalg.norm(after - x), after
        if 1 - low < 1e-15 and moved < 1e-5:
            break
    return x


def _split(a: np.ndarray, small: float) -> tuple[np.ndarray, int] | None:
    """An orthonormal basis whose first k vectors span the components above some shift; None if no shift tells any apart."""
    m = len(a)
    middle = np.trace(a) / m
    spread = np.linalg.norm(a - middle * np.eye(m)) / np.sqrt(m)  # the deviation of the eigenvalues
    start = np.random.default_rng(m).standard_normal((m, m))
    for shift in (0.0, 0.23, -0.23, 0.51, -0.51, 0.11, -0.11, 0.83, -0.83, 0.37, -0.37):
        projector = (polar(a - (middle + shift * spread) * np.eye(m)) + np.eye(m)) / 2
        k = round(float(np.trace(projector)))
        if not 0 < k < m:
            continue
        upper = np.linalg.qr(projector @ np.linalg.qr(projector @ start[:, :k])[0])[0]
        basis = np.linalg.qr(np.concatenate([upper, start[:, k:]], axis=1))[0]
        if np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k]) <= small:
            return basis, k
    return None


def components(v: np.ndarray, keep: int = KEEP) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues of a covariance, falling, and their unit vectors as columns."""
    small = 1e-13 * max(float(np.linalg.norm(v)), 1e-300)
    values, vectors, todo = [], [], [(v, np.eye(len(v)))]
    while todo and len(values) < keep:
        a, basis = todo.pop()
        found = None if len(a) == 1 or np.linalg.norm(a - np.diag(np.diag(a))) <= small else _split(a, small * 10)
        if found is None:  # single, or equal as far as numbers go
            order = np.argsort(-np.diag(a), kind="stable")
            values.extend(np.diag(a)[order])
            vectors.extend(basis[:, order].T)
            continue
        q, k = found
        turned = q.T @ a @ q
        for part in (slice(k, None), slice(0, k)):  # the upper part is on top
            todo.append(((turned[part, part] + turned[part, part].T) / 2, basis @ q[:, part]))
    return np.array(values[:keep]), np.array(vectors[:keep]).T


def _deviations(x: np.ndarray, n: int, total: list[int]) -> list[int]:
    """The sum over dimensions of (n * x - S)^2, exact: by machine words where they suffice."""
    most = float(n) * float(np.abs(x).max(initial=0)) + max(map(abs, total))
    if most < 2.0**62:
        away = n * x - np.array(total, np.int64)
        if float(np.abs(away).max(initial=0)) ** 2 * x.shape[1] < 2.0**62:
            return (away * away).sum(axis=1).tolist()
    away = n * x.astype(object) - np.array(total, object)
    return (away * away).sum(axis=1).tolist()


def whitened(vectors: DataFrame, columns: list[str], keep: int = KEEP) -> tuple[DataFrame, DataFrame]:
    """(columns, d, deviation decimal(38,0), z array<double>) of every row of vectors (columns and vector), and a small table of what
    was fitted: (d, component, n, explained, identity_error)."""
    spark = vectors.sparkSession
    sums = totals(vectors)
    models = {}
    for d, v in covariances(vectors, sums).items():
        n, total = sums[d]
        values, axes = components(v, keep)
        there = values > NOTHING * max(float(values[0]), 0.0)
        scale = np.where(there, 1 / np.sqrt(np.where(there, values, 1.0)), np.nan)
        models[d] = (n, total, np.array([s / n for s in total]), axes * scale, values, float(np.trace(v)))
    sent = spark.sparkContext.broadcast({d: m[:4] for d, m in models.items()})
    kind = pa.list_(pa.float64())

    def run(batches):
        for batch in batches:
            lengths, deviation, z = [0] * batch.num_rows, [None] * batch.num_rows, [None] * batch.num_rows
            for d, which, x in _blocks(batch):
                n, total, mean, axes = sent.value[d]
                rows = [[None if np.isnan(c) else c for c in r] if np.isnan(r).any() else r for r in (x - mean) @ axes]
                for k, dev, row in zip(which.tolist(), _deviations(x, n, total), rows, strict=True):
                    lengths[k], deviation[k], z[k] = d, dev if dev < 10**38 else None, row
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(lengths, pa.int32()), pa.array(deviation, pa.decimal128(38, 0)), pa.array(z, kind)], [*columns, "d", "deviation", "z"])

    types = ", ".join(f"`{c}` {vectors.schema[c].dataType.simpleString()}" for c in columns)
    wide = staged(vectors.mapInArrow(run, f"{types}, d int, deviation decimal(38,0), z array<double>"), "whitened")
    pairs = [(i, j) for i in range(keep) for j in range(i, keep)]
    # Spark's own covariance is centred as it goes, and leaves nulls out.
    errors = {}
    for r in wide.groupBy("d").agg(*[F.covar_pop(F.get("z", F.lit(i)), F.get("z", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs]).collect():
        found = [abs(r[f"c{i}_{j}"] - (i == j)) for i, j in pairs if r[f"c{i}_{j}"] is not None]
        errors[r["d"]] = max(found, default=None)
    fitted = [(d, i + 1, m[0], float(e) / m[5] if m[5] > 0 else None, errors.get(d)) for d, m in models.items() for i, e in enumerate(m[4])]
    return wide, spark.createDataFrame(fitted, "d int, component int, n long, explained double, identity_error double")


def whiten(rows: DataFrame, columns: list[str], vector: str = "embedding", keep: int = KEEP) -> DataFrame:
    """Per row with a usable vector and component: columns, component, n, deviation (decimal), whitened, explained, identity_error."""
    vectors = rows.filter(usable(F.col(vector))).select(*columns, F.col(vector).cast("array<double>").alias("vector"))
    wide, fitted = whitened(vectors, columns, keep)
    long = wide.select(*columns, "d", "deviation", F.posexplode("z").alias("place", "whitened")).withColumn("component", F.col("place") + 1)
    # At most `keep` rows for each length of vector.
    return long.join(F.broadcast(fitted), ["d", "component"]).select(*columns, "component", "n", "deviation", "whitened", "explained", "identity_error")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deviation is null where it is beyond 64 bits."""
    return whiten(table(spark, sf_dir, "embeddings"), ["vec_id"]).withColumn("deviation", F.col("deviation").try_cast("long"))
