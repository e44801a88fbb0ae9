"""Near-duplicate embeddings: random-hyperplane sign hashing in several tables, exact cosine, connected components.

Equal vectors fall together first, with their number. In each of several tables a vector's key is the sides it lies on of
that table's random hyperplanes; vectors with one key are compared exactly, as blocks of matrix products in double
precision. A pair that meets in several tables counts in the first only. Buckets return links per vector and a spanning
forest, never all pairs. The numbers of planes and tables follow from the number of vectors and from the recall asked for
at the cosine bound itself; pairs above the bound are found more surely.

Buckets are worked on many to a call. One beyond BLOCK vectors is split into blocks, and each pair of blocks counts as a bucket of
its own. Vectors travel in single precision where that is exact, and are brought to length one in double precision on arrival.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite numbers link with nothing (n_links 0, their own
component, kept); vectors link among those with as many components only; repeated rows are vectors of their own; null vec_id
has links but is the least of a component only alone; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guildbook.llm.common import staged, table
from guildbook.llm.components import components, forest

COSINE, RECALL = 0.95, 0.9995
#: Vectors that a bucket should hold on average, and the most in one block.
BUCKET, BLOCK = 192, 1024
#: Rows of buckets that one call works on, on average.
PER_CALL = 8192
SEED = 7


def shape_of(n: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Planes per table and tables: for n vectors about BUCKET to a bucket of evenly spread ones, and the recall at the bound."""
    same = 1 - math.acos(cosine) / math.pi
    planes = max(6, min(24, round(math.log2(max(2, n) / BUCKET))))
    return planes, math.ceil(math.log(1 - recall) / math.log(1 - same**planes))


def at_length_one(m: np.ndarray) -> np.ndarray:
    """Rows of finite numbers, not all zero, brought to length one; each row by itself, so that it comes out alike everywhere."""
    m = m / np.abs(m).max(axis=1, initial=0)[:, None]
    return m / np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]


def rows_of(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each number of components: which rows hold a usable vector, those vectors, and the same at length one."""
    lists, by_width = column.to_pylist(), {}
    for i, x in enumerate(lists):
        if x and None not in x:
            by_width.setdefault(len(x), []).append(i)
    for width, good in by_width.items():
        m = np.array([lists[i] for i in good], np.float64).reshape(len(good), width)
        with np.errstate(all="ignore"):
            largest = np.abs(m).max(axis=1, initial=0)
            fine = np.isfinite(largest) & (largest > 0)
        yield np.array(good, np.int64)[fine], m[fine], at_length_one(m[fine])


def pack(vector: np.ndarray) -> bytes:
    """A vector in bytes: in single precision behind a 4 if that loses nothing, else in double precision behind an 8."""
    with np.errstate(all="ignore"):
        short = vector.astype(np.float32)
    return b"\x04" + short.tobytes() if (short == vector).all() else b"\x08" + vector.tobytes()


def unpack(packed: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each number of components: which of the packed vectors have it, and these at length one."""
    widths = np.array([(len(p) - 1) // p[0] for p in packed], np.int64)
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        short = np.array([packed[i][0] == 4 for i in at])
        m = np.empty((len(at), width))
        for kind, mask in ((np.float32, short), (np.float64, ~short)):
            if mask.any():
                m[mask] = np.frombuffer(b"".join([packed[i][1:] for i in at[mask]]), kind).reshape(-1, width)
        yield at, at_length_one(m)


def classes(vectors: DataFrame) -> DataFrame:
    """vec_id and key, a digest of the vector at length one, null where it is unusable; raw, the vector as pack() has it."""
    import hashlib

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                keys, out = [None] * part.num_rows, [None] * part.num_rows
                for which, raw, units in rows_of(part.column("embedding")):
                    for i, r, u in zip(which.tolist(), raw, units, strict=True):
                        out[i] = pack(r)
                        keys[i] = hashlib.blake2b(u.tobytes(), digest_size=16).digest()
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(keys, pa.binary()), pa.array(out, pa.binary())], ["vec_id", "key", "raw"])

    return vectors.select("vec_id", "embedding").mapInArrow(run, f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, key binary, raw binary")


def sides(units: np.ndarray, planes: int, tables: int) -> np.ndarray:
    """Each unit vector's key in each table; the first tables are the same whatever their number. Sums of products are taken one by
    one, so that a vector near a plane gets the same side in every call, whatever vectors are beside it."""
    normals = np.random.Generator(np.random.PCG64(SEED)).standard_normal((tables * planes, units.shape[1]))
    out, weights = np.zeros((len(units), tables), np.int64), 1 << np.arange(planes, dtype=np.int64)
    columns = np.ascontiguousarray(units.T)
    for t in range(tables):
        dots = np.zeros((planes, len(units)))
        for k in range(units.shape[1]):  # component after component
            dots += normals[t * planes : (t + 1) * planes, k, None] * columns[k]
        out[:, t] = weights @ (dots > 0)
    return out


def bucket_links(m: np.ndarray, left: np.ndarray, right: np.ndarray | None, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of m, one of left and one of right (or two of left), whose cosine reaches the bound."""
    other = left if right is None else right
    found_i, found_j = [], []
    for k in range(0, len(left), 512):
        i, j = np.nonzero(m[left[k : k + 512]] @ m[other].T >= cosine)
        i += k
        if right is None:
            i, j = i[i < j], j[i < j]
        found_i.append(left[i])
        found_j.append(other[j])
    return np.concatenate(found_i), np.concatenate(found_j)


def first_meetings(m: np.ndarray, i: np.ndarray, j: np.ndarray, which: np.ndarray, planes: int) -> np.ndarray:
    """Of pairs of rows found in table `which`, those that no earlier table brought together."""
    keep = np.ones(len(i), bool)
    later = np.flatnonzero(which > 0)
    if not len(later):
        return keep
    rows = np.unique(np.concatenate([i[later], j[later]]))
    keys = sides(m[rows], planes, int(which.max()))
    for k in range(0, len(later), 50_000):
        at = later[k : k + 50_000]
        equal = keys[np.searchsorted(rows, i[at])] == keys[np.searchsorted(rows, j[at])]
        keep[at] = ~(equal & (np.arange(keys.shape[1]) < which[at, None])).any(axis=1)
    return keep


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links and component_id of every row of vectors (vec_id, embedding)."""
    rows = staged(classes(vectors), "units")
    usable = rows.filter("key is not null")
    distinct = staged(usable.groupBy("key").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("raw").alias("raw")), "vectors")
    distinct = staged(distinct.withColumn("id", F.monotonically_increasing_id()), "numbered")
    planes, tables = shape_of(distinct.count(), cosine, recall)

    def deal(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 2048):
                part = batch.slice(k, 2048)
                for own, units in unpack(part.column("raw").to_pylist()):
                    keys = sides(units, planes, tables)
                    for t in range(tables):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(own), t, np.int32)), pa.array(keys[:, t]), part.column("id").take(pa.array(own))], ["which", "side", "id"]
                        )

    dealt = staged(distinct.select("id", "raw").mapInArrow(deal, "which int, side long, id long"), "dealt")
    # Buckets of one vector have no pairs and go; of large ones there are few: at most rows x tables / BLOCK.
    sizes = staged(dealt.groupBy("which", "side").count().filter("count > 1"), "buckets")
    spread = dealt.join(sizes, ["which", "side"]).withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int"))
    spread = spread.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # A task is a pair of blocks (x <= y); a vector of block `own` goes to all pairs that hold it.
    spread = spread.withColumn("pair", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, "own").alias("x"), F.greatest(o, "own").alias("y")))))
    spread = staged(spread.select("which", "side", "pair.x", "pair.y", "own", "id"), "spread")
    calls = max(1, -(-spread.count() // PER_CALL))
    carried = spread.join(distinct.select("id", "copies", "raw"), "id").withColumn("call", F.pmod(F.xxhash64("which", "side", "x", "y"), F.lit(calls)))

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["which", "side", "x", "y", "own"], kind="stable", ignore_index=True)
        ids, copies = pdf["id"].to_numpy(), pdf["copies"].to_numpy()
        table_, side, x, y, own = (pdf[c].to_numpy() for c in ("which", "side", "x", "y", "own"))
        gained, pairs = [], []
        for at, m in unpack(pdf["raw"].tolist()):  # vectors of other lengths link among themselves only
            cut = np.flatnonzero(np.append(True, (table_[at][1:] != table_[at][:-1]) | (side[at][1:] != side[at][:-1]) | (x[at][1:] != x[at][:-1]) | (y[at][1:] != y[at][:-1])))
            found_i, found_j = [], []
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(at)], strict=True):
                here = np.arange(a, b)
                if x[at[a]] == y[at[a]]:
                    i, j = bucket_links(m, here, None, cosine)
                else:
                    first = own[at[here]] == x[at[a]]
                    i, j = bucket_links(m, here[first], here[~first], cosine)
                found_i.append(i)
                found_j.append(j)
            i, j = np.concatenate(found_i), np.concatenate(found_j)
            new = first_meetings(m, i, j, table_[at[i]], planes)
            i, j = at[i[new]], at[j[new]]
            gained += [(ids[i], copies[j]), (ids[j], copies[i])]
            pairs.append(np.stack([ids[i], ids[j]], axis=1))
        nodes, which = np.unique(np.concatenate([g[0] for g in gained]), return_inverse=True)
        total = np.bincount(which, np.concatenate([g[1] for g in gained]), len(nodes)).astype(np.int64)
        star = {int(a): int(b) for a, b in forest(np.concatenate(pairs))}
        return pd.DataFrame({"id": nodes, "links": total, "up": [star.get(int(v), int(v)) for v in nodes]})

    found = staged(carried.groupBy("call").applyInPandas(meet, "id long, links long, up long"), "links")
    linked = found.groupBy("id").agg(F.sum("links").alias("links"))
    placed = staged(components(found.select(F.col("id").alias("a"), F.col("up").alias("b")), "id"), "components")
    named = staged(distinct.join(staged(linked, "counts"), "id", "left").join(placed, "id", "left").select("key", "copies", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "id").alias("root")), "named")
    ids = staged(named.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    named = staged(named.join(ids, "root").select("key", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"), "answers")
    out = rows.select("vec_id", "key").join(named, "key", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


SQL = """
WITH RECURSIVE
v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
x AS (SELECT vec_id, unnest(e) AS x FROM v),
fine AS (SELECT vec_id FROM x GROUP BY vec_id HAVING count(*) = count(x) AND bool_and(isfinite(x)) AND bool_or(x <> 0)),
good AS (SELECT vec_id, e FROM v JOIN fine USING (vec_id)),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(vec_id, other) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other),
comp AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN comp c USING (vec_id) LEFT JOIN n USING (vec_id)
"""
