"""SimHash near-duplicates by vantage-point trees.

Each text gets a 64-bit fingerprint; rows with one fingerprint fall together before anything else. A tree over a bounded
sample of the fingerprints cuts the Hamming space into shards: a node sends what lies within its radius of its vantage point
to one side and the rest to the other. Every fingerprint has one home shard. It is also sent to each later shard that its
ball of the linking distance reaches over (the triangle bound tells which), so every close pair meets in a shard. Inside a
shard the tree goes on, down to leaves of a few fingerprints, which are compared exactly, in blocks. A shard returns only
a spanning forest of its links; components over the shards are joined by components().

The number of shards grows with the number of fingerprints, so a shard's size doesn't. A shard that is still too large (a
dense group) is split by its visitors: its homes go to several tasks, each visitor to one.

Defined cases: null and empty texts have fingerprint zero, linked like any other; texts of one or two words are one shingle;
every row gives one row; null doc_id stays null and is the smallest of a component only if there is no other; empty tables
give no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guildbook.llm.common import staged, table
from guildbook.llm.components import components, forest
from guildbook.llm.words import slices, texts_of

SHINGLE, SEED, DISTANCE = 3, 42, 2
#: Fingerprints in a shard on average, and the least and most numbers of shards; the sample that the shards are fitted on.
PER_SHARD, LEAST, MOST, SAMPLE = 12_000, 64, 1 << 16, 40_000
#: Where a shard's tree stops and compares all; share of visitors on both sides that makes a cut useless.
LEAF, USELESS = 96, 0.85


def fingerprint(text: bytes) -> int:
    """Bits set in more than half of the XXH64 hashes of the word shingles."""
    words = text.lower().split()  # of bytes: lowers A-Z only, splits at the six blanks
    if not words:
        return 0
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = [0, *(ends[: -SHINGLE] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begins, ends[SHINGLE - 1 :].tolist(), strict=True)], "<u8")
    bits = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):
        bits += np.unpackbits(hashes[k : k + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the fingerprint as a long) of every row."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                fps = np.array([fingerprint(t) for t in texts_of(part)], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fps)], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def plant(fps: np.ndarray, shards: int) -> list[tuple[int, int, int, int]]:
    """The top of the tree, fitted on a sample: nodes (vantage point, radius, inside, outside); a child below zero is shard -1 - child.
    The largest part is cut next, until there are so many shards or no cut separates."""
    nodes: list[list[int]] = []
    parts: list[tuple[np.ndarray, int, int]] = [(fps, -1, 0)]  # fingerprints, parent node, side
    done: list[tuple[int, int]] = []
    while parts:
        if len(parts) + len(done) >= shards:
            break
        k = max(range(len(parts)), key=lambda i: len(parts[i][0]))
        own, parent, side = parts.pop(k)
        best = None
        for v in own[:: max(1, len(own) // 5)][:5].tolist() if len(own) >= 8 else []:
            d = apart(own, np.uint64(v)).astype(int)
            radius = int(np.median(d))
            if d.max() == d.min():
                continue
            radius = min(radius, int(d.max()) - 1)
            both = float(((d > radius - DISTANCE) & (d <= radius + DISTANCE)).mean())
            lean = abs(float((d <= radius).mean()) - 0.5)
            if best is None or both + lean < best[0]:
                best = both + lean, both, v, radius, d
        if best is None or best[1] > USELESS:
            done.append((parent, side))
            continue
        _, _, v, radius, d = best
        nodes.append([v, radius, 0, 0])
        here = len(nodes) - 1
        if parent >= 0:
            nodes[parent][2 + side] = here
        parts += [(own[d <= radius], here, 0), (own[d > radius], here, 1)]
    for shard, (parent, side) in enumerate([*done, *[(p, s) for _, p, s in parts]]):
        if parent >= 0:
            nodes[parent][2 + side] = -1 - shard
    return [tuple(n) for n in nodes]


def route(fps: np.ndarray, nodes: list[tuple[int, int, int, int]], reach: int = DISTANCE) -> list[tuple[np.ndarray, int, np.ndarray]]:
    """(places in fps, shard, whether at home) for every shard that a fingerprint's ball touches."""
    out, todo = [], [(0 if nodes else -1, np.arange(len(fps)), np.ones(len(fps), bool))]
    while todo:
        node, which, home = todo.pop()
        if not len(which):
            continue
        if node < 0:
            out.append((which, -1 - node, home))
            continue
        v, radius, inside, outside = nodes[node]
        d = apart(fps[which], np.uint64(v)).astype(int)
        near, far = d - reach <= radius, d + reach > radius
        todo += [(inside, which[near], home[near] & (d[near] <= radius)), (outside, which[far], home[far] & (d[far] > radius))]
    return out


def shard_links(home: np.ndarray, visitor: np.ndarray, among: bool = True, reach: int = DISTANCE) -> np.ndarray:
    """A spanning forest of the links between homes and visitors and, if among, between homes: pairs of fingerprints."""
    edges: list[np.ndarray] = []
    held = 0

    def add(pairs: np.ndarray) -> None:
        nonlocal edges, held
        edges.append(pairs)
        held += len(pairs)
        if held > 400_000:
            edges = [forest(np.concatenate(edges))]
            held = len(edges[0])

    todo = [(np.sort(home), np.sort(visitor))]
    while todo:
        own, other = todo.pop()
        if not len(own):
            continue
        cut = None
        if len(own) > LEAF:
            for v in own[:: max(1, len(own) // 3)][:3]:
                d = apart(own, v).astype(int)
                if d.max() > d.min():
                    radius = min(int(np.median(d)), int(d.max()) - 1)
                    both = ((d > radius - reach) & (d <= radius + reach)).mean()
                    if both <= USELESS and (cut is None or both < cut[0]):
                        cut = both, v, radius, d
        if cut is None:
            block = max(1, 2_000_000 // len(own))
            for against, within in ((own, True), (other, False)):
                for k in range(0, len(against) if among or not within else 0, block):
                    part = against[k : k + block]
                    i, j = np.nonzero(apart(part[:, None], own[None, :]) <= reach)
                    if within:
                        i, j = i[i + k < j], j[i + k < j]
                    if len(i):
                        add(np.stack([part[i], own[j]], axis=1))
            continue
        _, v, radius, d = cut
        e = apart(other, v).astype(int)
        inside, outside = d <= radius, d > radius
        near = outside & (d - reach <= radius) & among
        # Homes outside that reach in are visitors inside; the pairs between both sides are all found there.
        todo.append((own[inside], np.concatenate([other[e - reach <= radius], own[near]])))
        todo.append((own[outside], other[e + reach > radius]))
    return forest(np.concatenate(edges)) if edges else np.zeros((0, 2), np.uint64)


def links(fps: DataFrame) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that join the same components as all links do."""
    fps = fps.select("fp")
    spark, n = fps.sparkSession, fps.count()
    shards = int(min(MOST, max(LEAST, -(-n // PER_SHARD))))
    share = min(1.0, 1.2 * SAMPLE / max(1, n))
    # The sample's rows are bounded by SAMPLE; those with the smallest hashes, so every run draws the same.
    few = fps.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE)
    sample = np.array([r["fp"] for r in few.collect()], np.int64).view(np.uint64)
    nodes = plant(sample, shards)
    held = spark.sparkContext.broadcast(nodes)

    def send(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 20_000):
                own = batch.slice(k, 20_000).column("fp").to_numpy(zero_copy_only=False)
                routed = route(own.view(np.uint64), held.value)
                home_of = np.zeros(len(own), np.int64)
                for which, shard, home in routed:
                    home_of[which[home]] = shard
                for which, shard, home in routed:
                    # A pair of two shards meets in the later one only.
                    kept = home | (home_of[which] < shard)
                    m = int(kept.sum())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(m, shard, np.int64)), pa.array(own[which[kept]]), pa.array(home[kept])], ["shard", "fp", "home"])

    sent = staged(fps.mapInArrow(send, "shard long, fp long, home boolean"), "routed")
    # A row for each shard: at most MOST.
    sizes = sent.groupBy("shard").agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("visitors"))
    heavy = {r["shard"]: -(-max(r["visitors"], r["homes"]) // (4 * PER_SHARD)) for r in sizes.filter((F.col("visitors") > 4 * PER_SHARD) | (F.col("homes") > 4 * PER_SHARD)).collect()}
    if heavy:
        tasks = F.coalesce(F.create_map(*[F.lit(int(x)) for pair in heavy.items() for x in pair])[F.col("shard").cast("int")], F.lit(1))
    else:
        tasks = F.lit(1)
    # In a split shard every home goes to all tasks, and each home and visitor is compared with them in one task.
    sent = sent.withColumn("tasks", tasks).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("tasks")).cast("int"))
    sent = sent.withColumn("task", F.explode(F.when(F.col("home"), F.sequence(F.lit(0), F.col("tasks") - 1)).otherwise(F.array("own"))))

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy().view(np.uint64)
        home, split = pdf["home"].to_numpy(), int(pdf["tasks"].iloc[0])
        if split == 1:
            pairs = shard_links(fp[home], fp[~home])
        else:
            mine = home & (pdf["own"].to_numpy() == int(pdf["task"].iloc[0]))
            pairs = shard_links(fp[home], np.concatenate([fp[~home], fp[mine]]), among=False)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        return pd.DataFrame(pairs.view(np.int64), columns=["a", "b"])

    return sent.groupBy("shard", "task").applyInPandas(meet, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id of every row of docs (doc_id, text)."""
    rows = staged(fingerprints(docs), "fingerprints")
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = components(links(distinct), "fp")  # fp, root: only of fingerprints with links
    # Ids of components: the smallest doc_id of all their fingerprints.
    placed = staged(distinct.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least"), "placed")
    ids = staged(placed.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    named = staged(placed.select("fp", "root").join(ids, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
