"""The trie of conversations' prefixes, by splitters and a skeleton.

A turn becomes a token, 16 bytes of a digest of role and text, before anything is shuffled. Conversations are sorted by (path of
tokens, conv_id) over shards, cut at splitters taken from a sample; the sample decides the balance only. A node whose members lie in
several shards is a prefix of a splitter, so the trie of the splitters' paths (the skeleton, broadcast, at most MOST_SHARDS paths of BLOCK
tokens) holds them all. Each shard walks its sorted rows once with a stack and finishes every other node; of skeleton nodes it gives partial
sums, which are reduced by Spark and then carried up the skeleton. Members that end at a skeleton node are sent on in chunks, sorted, and
digested as a stream. Copies of one conversation are cut by conv_id, so a large group lies in many shards.

Conversations are cut in blocks of BLOCK turns, so rows stay bounded. A later block is a trie of its own below the node where it begins,
and hands children, leaves and savings up to it; the deepest blocks come first. A conversation that shares none of its further turns is
written down turn by turn, so the number of rounds follows the longest shared prefix. The turns of a conversation are numbered by a
sort over ranges of (conv_id, turn), which may cut a conversation, and by the counts of the ranges before.

Defined cases: rows without conv_id are left out; null role and text are empty; of turns with one number, repeated rows too, all count, in
the order of their tokens; turnless conversations end at the root; no conversations give no nodes; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from guildbook.llm.common import staged, table

#: Turns in a block, bytes of a token, shards at most, sampled rows for each shard and at most, ids in a chunk of members.
BLOCK, TOKEN, MOST_SHARDS, SAMPLE, MOST_SAMPLE, CHUNK = 64, 16, 2000, 20, 20_000, 1024
NO_MEMBERS = hashlib.sha256(b"").hexdigest()
#: Turns taken over from the first conversation of a group: crc32 mod HEADS, groups of GROUP.
HEADS, GROUP = 9, 5


def _shards(spark: SparkSession) -> int:
    return min(MOST_SHARDS, int(spark.conf.get("spark.sql.shuffle.partitions")))


def tokens(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, token, bytes): what is left of a turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    return rows.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.substring(digest, 1, TOKEN).alias("token"), F.octet_length(text).cast("long").alias("bytes"))


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, at, token, bytes): at is the place of a turn in its conversation, from 0. A sorted range may begin or end inside a
    conversation; what stands in the ranges before is added, from one row for each range at most."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "token"]

    def run(batches):
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("conv_id").to_numpy()
            place = np.arange(len(ids))
            new = np.append(ids[0] != last, ids[1:] != ids[:-1])
            begin = np.maximum.accumulate(np.where(new, place, 0))
            at = place - begin + np.where(np.cumsum(new) == 0, count, 0)
            last, count = ids[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(np.full(len(ids), part, np.int32)), pa.array(at), batch.column("token"), batch.column("bytes")], ["conv_id", "part", "at", "token", "bytes"])

    dealt = turns.repartitionByRange(_shards(turns.sparkSession), *order).sortWithinPartitions(*order)
    rows = staged(dealt.mapInArrow(run, "conv_id long, part int, at long, token binary, bytes long"), "numbered")
    before = F.sum("count").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = rows.groupBy("conv_id", "part").count().withColumn("before", before).filter("before > 0").select("conv_id", "part", "before")
    # Only a range's first conversation can have begun in a range before: one row for each range.
    moved = rows.join(F.broadcast(shifts), ["conv_id", "part"], "left")
    return moved.select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("at"), "token", "bytes")


def _items(*names: str) -> Column:
    return F.array_sort(F.collect_list(F.struct(*names)))


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of conversations (conv_id, turn, role, text): (conv_id, n) and (conv_id, block, tokens, bytes) of the rebuilt ones."""
    turns = staged(numbered(staged(tokens(rows), "tokens")), "turns")
    own = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    own = own.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).withColumn("head", F.col("conv_id") - F.col("conv_id") % GROUP)
    heads = turns.filter((F.col("at") < HEADS - 1) & (F.col("conv_id") % GROUP == 0)).groupBy(F.col("conv_id").alias("head")).agg(_items("at", "token", "bytes").alias("first"))
    taken = F.slice(F.coalesce("first", F.expr("array()").cast("array<struct<at:bigint,token:binary,bytes:bigint>>")), F.lit(1), F.col("h").cast("int"))
    convs = own.join(heads, "head", "left").select("conv_id", "own", "h", taken.alias("first")).withColumn("k", F.size("first").cast("long"))
    convs = staged(convs.withColumn("n", F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "convs")
    front = convs.select("conv_id", F.explode("first").alias("x")).select("conv_id", (F.col("x.at") + 1).alias("d"), "x.token", "x.bytes")
    back = turns.join(convs.select("conv_id", "h", "k"), "conv_id").filter("at >= h").select("conv_id", (F.col("at") - F.col("h") + F.col("k") + 1).alias("d"), "token", "bytes")
    blocks = front.unionByName(back).groupBy("conv_id", F.floor((F.col("d") - 1) / BLOCK).alias("block")).agg(_items("d", "token", "bytes").alias("x"))
    path = F.aggregate("x", F.lit(b""), lambda all_, x: F.concat(all_, x["token"]))
    return convs.select("conv_id", "n"), staged(blocks.select("conv_id", "block", path.alias("tokens"), F.col("x.bytes").alias("bytes")), "blocks")


class Skeleton:
    """The trie of the splitters' paths: the number of each node by its parent's number and its token."""

    def __init__(self, paths: list[bytes]):
        self.below: dict[tuple[int, bytes], int] = {}
        self.parents: list[int] = []
        for path in paths:
            up = -1
            for i in range(0, len(path), TOKEN):
                step = (up, path[i : i + TOKEN])
                if step not in self.below:
                    self.below[step] = len(self.parents)
                    self.parents.append(up)
                up = self.below[step]


class Node:
    """A node on the stack of a shard's walk. number: in the skeleton, or None for one that the shard finishes."""

    __slots__ = ("as_parent", "bytes", "ends", "first", "key", "kids", "leaves", "members", "n", "number", "parent", "saved")

    def __init__(self, key: int, number: int | None, parent: int | None, size: int, as_parent: int | None):
        self.key, self.number, self.parent, self.bytes, self.as_parent = key, number, parent, size, as_parent
        self.n = self.kids = self.leaves = self.saved = 0
        self.first: int | None = None
        self.members: list[int] = []
        self.ends = None if number is not None else hashlib.sha256()


_NODE = pa.schema([("key", pa.int64()), ("parent", pa.int64()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("bytes", pa.int64()), ("as_parent", pa.int64()), ("members", pa.list_(pa.int64()))])
_NODE_SQL = "key long, parent long, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, bytes long, as_parent long, members array<long>"


def walk(batches, skeleton: Skeleton, depth: int):
    """Rows of _NODE from one task's rows, sorted by (shard, path, conv_id). depth: of the nodes where paths begin."""
    stack: list[Node] = []
    out: list[tuple] = []
    shard, path, made = None, b"", 0

    def members(node: Node) -> None:
        out.append((node.key, None, None, None, None, None, None, None, None, None, None, node.members))
        node.members = []

    def close() -> None:
        node, at = stack.pop(), depth + len(stack)
        up = stack[-1] if stack else None
        if up:
            up.n += node.n
            up.first = node.first if up.first is None else min(up.first, node.first)
        as_parent = node.first if node.as_parent is None else node.as_parent
        if node.number is not None:
            if node.members:
                members(node)
            out.append((node.key, node.parent, at, node.first, node.n, node.kids, node.leaves, node.saved, None, node.bytes, as_parent, None))
            return
        leaves, saved = node.leaves if node.kids else 1, node.saved + (node.n - 1) * node.bytes
        out.append((node.key, node.parent, at, node.first, node.n, node.kids, leaves, saved, node.ends.hexdigest(), node.bytes, as_parent, None))
        if up:
            up.kids, up.leaves, up.saved = up.kids + 1, up.leaves + leaves, up.saved + saved

    def flush():
        done = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _NODE, strict=True)], schema=_NODE)
        out.clear()
        return done

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("shard", "path", "sizes", "conv_id", "ends", "top_first", "kids", "leaves", "saved")), strict=True):
            now, conv = row[1], row[3]
            same = 0
            if row[0] == shard:
                most = min(len(path), len(now))
                same = most if path[:most] == now[:most] else next(i for i in range(0, most, TOKEN) if path[i : i + TOKEN] != now[i : i + TOKEN])
            while len(stack) * TOKEN > same:
                close()
            for i in range(same, len(now), TOKEN):
                up = stack[-1] if stack else None
                number = skeleton.below.get((up.number if up else -1, now[i : i + TOKEN])) if up is None or up.number is not None else None
                key = -1 - number if number is not None else (row[0] << 44) + (made := made + 1)
                stack.append(Node(key, number, up.key if up else None, row[2][i // TOKEN - 1] if i else 0, None if up else row[5]))
            shard, path, node = row[0], now, stack[-1]
            node.n += 1
            node.first = conv if node.first is None else min(node.first, conv)
            node.kids, node.leaves, node.saved = node.kids + row[6], node.leaves + row[7], node.saved + row[8]
            if row[4]:
                if node.ends is None:
                    node.members.append(conv)
                    if len(node.members) >= CHUNK:
                        members(node)
                else:
                    node.ends.update(b"%d" % conv if not node.members else b",%d" % conv)
                    node.members = [conv]  # not the first any more
            if len(out) >= 4096:
                yield flush()
    while stack:
        close()
    if out:
        yield flush()


def _digests(batches):
    """(key, ends_sha256) of chunks of members sorted by (key, first member)."""
    key, digest = None, None
    for batch in batches:
        done = []
        for k, chunk in zip(batch.column("key").to_pylist(), batch.column("members").to_pylist(), strict=True):
            if k != key:
                if digest is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(",".join(map(str, chunk)).encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], ["key", "ends_sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])


def _carried_up(partial: list, skeleton: Skeleton) -> list[tuple]:
    """Whole rows of the skeleton's nodes from their reduced partial sums: each node is done after those below it, whose numbers are
    greater. As many nodes as the skeleton has, whatever the number of conversations."""
    rows = {-1 - r["key"]: r.asDict() for r in partial}
    for number in sorted(rows, reverse=True):
        r, up = rows[number], rows.get(skeleton.parents[number])
        r["n_leaves"] = r["n_leaves"] if r["n_children"] else 1
        r["saved_tokens"] += (r["n_convs"] - 1) * r["bytes"]
        if up:
            for name, more in (("n_children", 1), ("n_leaves", r["n_leaves"]), ("saved_tokens", r["saved_tokens"])):
                up[name] += more
    names = ["key", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "as_parent"]
    return [tuple(r[n] for n in names) for r in rows.values()]


def trie(rows: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """Nodes below the beginnings of paths, and those beginnings. rows: path (its first token names the beginning), sizes (bytes of the
    other tokens), conv_id, ends, top_first (conv_id of the beginning as a parent; null: its least member), and the kids, leaves and
    saved that the path's last node has from deeper blocks."""
    spark, shards = rows.sparkSession, _shards(rows.sparkSession)
    rows = staged(rows, "paths")
    sample = rows.select("path", "conv_id").orderBy(F.xxhash64("conv_id")).limit(min(MOST_SAMPLE, SAMPLE * shards)).collect()
    ordered = sorted((bytes(r["path"]), r["conv_id"]) for r in sample)
    splitters = sorted({ordered[k * len(ordered) // shards] for k in range(1, shards)}) if ordered else []
    # Bounded by MOST_SHARDS paths of BLOCK tokens, whatever the input.
    sent = spark.sparkContext.broadcast((splitters, Skeleton([p for p, _ in splitters])))
    skeleton = sent.value[1]

    def deal(batches):
        for batch in batches:
            found = [bisect_right(sent.value[0], x) for x in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())], [*batch.schema.names, "shard"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    dealt = rows.mapInArrow(deal, f"{types}, shard int").repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    found = staged(dealt.mapInArrow(lambda batches: walk(batches, sent.value[1], depth), _NODE_SQL), "nodes")
    done = found.filter("key >= 0").select("key", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "as_parent")
    parts = found.filter("key < 0 and members is null").groupBy("key").agg(*[F.min(c).alias(c) for c in ("parent", "depth", "conv_id", "as_parent", "bytes")], *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    whole = spark.createDataFrame(_carried_up(parts.collect(), skeleton), "key long, parent long, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, as_parent long")
    chunks = found.filter("members is not null").select("key", F.col("members")[0].alias("least"), "members")
    ends = chunks.repartition(shards, "key").sortWithinPartitions("key", "least").mapInArrow(_digests, "key long, ends_sha256 string")
    whole = whole.join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_MEMBERS)))
    every = staged(done.unionByName(whole), "trie")
    parents = every.select(F.col("key").alias("parent"), F.col("as_parent").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    below = every.filter("parent is not null").drop("as_parent").join(parents, "parent").select(columns)
    return below, every.filter("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long")).select(columns)


def prefix_trie(rows: DataFrame) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, blocks = rebuilt(rows)
    top = F.lit(bytes(TOKEN))
    # Level 0 has all conversations; level r those that share their first r blocks with another one that goes on.
    levels = [convs.select("conv_id", "n", top.alias("top"), F.lit(None).cast("long").alias("top_first"))]
    alone, heads = [], []
    while True:
        r = len(levels)
        long = levels[-1].filter(F.col("n") >= BLOCK * r).join(blocks.filter(F.col("block") == r - 1).select("conv_id", "tokens"), "conv_id")
        long = staged(long.select("conv_id", "n", F.substring(F.unhex(F.sha2(F.concat("top", "tokens"), 256)), 1, TOKEN).alias("top")), "long")
        if long.isEmpty():
            break
        on = F.when(F.col("n") > BLOCK * r, F.col("conv_id"))
        tops = staged(long.groupBy("top").agg(F.min("conv_id").alias("top_first"), F.count(on).alias("more"), F.min(on).alias("head")).filter("more > 0"), "tops")
        going = staged(long.filter(F.col("n") > BLOCK * r).join(tops, "top"), "going")
        alone.append(going.filter("more = 1").select("conv_id", "n", F.lit(BLOCK * r).cast("long").alias("from"), "top_first"))
        heads.append(going.select("conv_id", (F.col("more") == 1).alias("single")))
        levels.append(going.filter("more > 1").select("conv_id", "n", "top", "top_first"))
        if levels[-1].isEmpty():
            levels.pop()
            break
    out, carried = [], None
    for r in reversed(range(len(levels))):
        held = levels[r].join(blocks.filter(F.col("block") == r).select("conv_id", "tokens", "bytes"), "conv_id", "left")
        if r < len(heads):
            held = held.join(heads[r], "conv_id", "left")
            one = F.when(F.col("single"), 1).otherwise(0).cast("long")
            more = held.withColumns({"kids": one, "leaves": one, "saved": F.lit(0).cast("long")}).drop("single")
            if carried is not None:
                got = carried.select("conv_id", F.col("n_children").alias("c_kids"), F.col("n_leaves").alias("c_leaves"), F.col("saved_tokens").alias("c_saved"))
                more = more.join(got, "conv_id", "left").withColumns({c: F.coalesce(f"c_{c}", c) for c in ("kids", "leaves", "saved")})
            held = more
        else:
            held = held.withColumns({c: F.lit(0).cast("long") for c in ("kids", "leaves", "saved")})
        path = F.concat("top", F.coalesce("tokens", F.lit(b"")))
        ends = F.col("n") <= BLOCK * (r + 1)
        below, carried = trie(held.select("conv_id", path.alias("path"), F.coalesce("bytes", F.array().cast("array<bigint>")).alias("sizes"), ends.alias("ends"), "top_first", "kids", "leaves", "saved"), BLOCK * r)
        out.append(below)
    out.append(carried)  # the root
    for tails in alone:
        # Turns that no other conversation shares, one node each.
        d = F.explode(F.sequence(F.col("from") + 1, F.col("n")))
        turn = tails.select("conv_id", "n", "from", "top_first", d.alias("depth"))
        last = F.col("depth") == F.col("n")
        one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
        parent = F.when(F.col("depth") == F.col("from") + 1, F.col("top_first")).otherwise(F.col("conv_id"))
        out.append(turn.select("conv_id", "depth", parent.alias("parent_conv_id"), one.alias("n_convs"), F.when(last, none).otherwise(one).alias("n_children"), one.alias("n_leaves"), none.alias("saved_tokens"), F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NO_MEMBERS)).alias("ends_sha256")))
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def op11_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


SQL = r"""
WITH turns AS (
  SELECT conv_id AS c, turn, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS tok, strlen(coalesce(text, ''))::BIGINT AS size
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, list(tok ORDER BY turn NULLS FIRST, tok) AS toks, list(size ORDER BY turn NULLS FIRST, tok) AS sizes,
    xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(c::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda s, o: CASE WHEN o >= 0 THEN xor(s, o) WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384::BIGINT) ELSE s >> 1 END), 4294967295::BIGINT) % 9 AS h
  FROM turns GROUP BY c),
built AS (
  SELECT o.c, list_concat(list_slice(coalesce(b.toks, []), 1, o.h), list_slice(o.toks, o.h + 1, len(o.toks))) AS toks,
    list_concat(list_slice(coalesce(b.sizes, []), 1, o.h), list_slice(o.sizes, o.h + 1, len(o.sizes))) AS sizes
  FROM own o LEFT JOIN own b ON b.c = o.c - o.c % 5),
steps AS (SELECT c, toks, sizes, unnest(generate_series(0, len(toks))) AS d FROM built),
node AS (
  SELECT array_to_string(list_slice(toks, 1, d), ',') AS p, d, CASE WHEN d > 0 THEN array_to_string(list_slice(toks, 1, d - 1), ',') END AS up, min(c) AS conv_id, count(*) AS n_convs,
    any_value(list_slice(toks, 1, d)) AS way, CASE WHEN d > 0 THEN any_value(sizes[d]) ELSE 0 END AS size, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = len(toks)) AS ends
  FROM steps GROUP BY 1, 2, 3),
kids AS (SELECT up AS p, count(*) AS n_children FROM node WHERE up IS NOT NULL GROUP BY 1),
whole AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM node n LEFT JOIN kids k USING (p)),
spread AS (SELECT n_children, n_convs, size, way, unnest(generate_series(0, d)) AS k FROM whole),
sums AS (SELECT array_to_string(list_slice(way, 1, k), ',') AS p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens FROM spread GROUP BY 1)
SELECT w.conv_id, w.d::BIGINT AS depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(w.ends, '')) AS ends_sha256
FROM whole w JOIN sums s ON s.p = w.p LEFT JOIN node u ON u.p = w.up
"""
