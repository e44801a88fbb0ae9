"""Tables in buckets kept by a stream, and snapshots in the order of time."""

import random

from pyspark.sql import functions as F

from guildbook.operators.store import new_folder
from guildbook.streaming import streams


def test_only_touched_buckets_are_written(spark):
    table, store = new_folder(spark, "table"), None
    schema = "k long, v string, n int"
    rng = random.Random(1)
    want, seen = {}, []
    batches = [[(k, f"v{k}", 0) for k in range(200)]] + [[(rng.randrange(220) if i < 4 else None, f"b{b}", i) for i in range(5)] for b in range(1, 6)]
    for number, rows in enumerate(batches):
        want |= {k: v for k, v, _ in sorted(rows, key=lambda r: r[2]) if k is not None}
        for _ in range(2):  # a batch that is run again
            streams.upsert_batch(spark.createDataFrame(rows, schema), number, table, "k", "n", ["v"], buckets=16, keep=2)
        seen.append(dict(want))
        assert {r["k"]: r["v"] for r in streams.read_table(spark, table).collect()} == want
        store, path = streams._files(spark, table)
        written = [x.getPath().getName() for x in store.globStatus(path(f"{table}/version={number}/bucket=*"))]
        assert len(written) <= (16 if number == 0 else 5)
    assert streams._versions(spark, table) == [4, 5]
    assert {r["k"]: r["v"] for r in streams.read_table(spark, table, 4).collect()} == seen[4]
    # No file is left that neither manifest names.
    named = {(b, v) for k in (4, 5) for b, v in streams._manifest(spark, table, k).items()}
    there = {(int(x.getPath().getName().split("=")[1]), int(x.getPath().getParent().getName().split("=")[1])) for x in store.globStatus(path(f"{table}/version=*/bucket=*"))}
    assert there == named


def test_an_empty_batch_and_no_table(spark):
    table = new_folder(spark, "table")
    streams.upsert_batch(spark.createDataFrame([], "k long, v string, n int"), 0, table, "k", "n", ["v"])
    assert streams._versions(spark, table) == []
    streams.upsert_batch(spark.createDataFrame([(1, "a", 1)], "k long, v string, n int"), 3, table, "k", "n", ["v"])
    assert [tuple(r) for r in streams.read_table(spark, table).select("k", "v").collect()] == [(1, "a")]


def test_snapshots_out_of_order(spark):
    """Batches in any order, within the delay, give what a run in the order of time gives."""
    before = spark.conf.get(streams.ROCKS[0], None)
    spark.conf.set(*streams.ROCKS)
    try:
        schema = "url string, content_hash string, ts timestamp"
        rng = random.Random(3)
        rows = [(u, rng.choice(["a", "b", None]), 1_700_000_000 + 60 * t) for u in ("x", "y") for t in range(30)] + [("x", "a", 1_700_000_000), (None, "a", 1_700_000_000)]
        want = []
        for u in ("x", "y"):
            last, changes = None, 0
            for _, content in sorted((t, h or "") for v, h, t in rows if v == u):
                changed = last is not None and content != last
                changes, last = changes + changed, content
                want.append((u, content, changes, changed))
        rng.shuffle(rows)
        folder, out, check = new_folder(spark, "in"), new_folder(spark, "out"), new_folder(spark, "check")
        late = [("end", "z", 1_700_000_000 + 10**6), ("end", "z", 1_700_000_000 + 2 * 10**6)]
        for k, part in enumerate([rows[::2], rows[1::2], late[:1], late[1:]]):
            spark.createDataFrame([(u, h, t) for u, h, t in part], "url string, content_hash string, t long").select("url", "content_hash", F.timestamp_seconds("t").alias("ts")).coalesce(1).write.mode("append").parquet(folder)
            stream = spark.readStream.schema(schema).parquet(folder)
            streams.run_now(streams.snapshot_changes(stream, delay="2 hours", idle_ms=3_600_000), check, lambda b, n: b.write.mode("append").parquet(out))
        got = [(r["url"], r["content_hash"], r["change_count"], r["changed"]) for r in spark.read.parquet(out).filter("url <> 'end'").orderBy("url", "at", "content_hash").collect()]
        assert got == want
    finally:
        spark.conf.unset(streams.ROCKS[0]) if before is None else spark.conf.set(streams.ROCKS[0], before)
