"""Jobs whose work must grow with their rows, on tables where the product of two sides would not end."""

import random
import threading

import pyarrow as pa
from pyspark.sql import functions as F

from guildbook.functions import scores as s
from guildbook.operators import accounts as a
from guildbook.operators import graph as g
from guildbook.operators import pages as p
from guildbook.operators import pairs as pr
from guildbook.operators import report as r
from guildbook.streaming import streams


def within(spark, seconds, job):
    timer = threading.Timer(seconds, spark.sparkContext.cancelAllJobs)
    timer.start()
    try:
        return job()
    finally:
        timer.cancel()


def test_events_of_one_name_meet_accounts_once(spark):
    accounts = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, "PMA;AGMA").when(F.col("id") % 4 == 1, "ZZ").otherwise("").alias("members"))
    events = spark.range(400_000).select(F.when(F.col("id") % 2 == 0, "Steel show").when(F.col("id") % 4 == 1, "Tin and steel").otherwise("Small fair").alias("event_name"), (F.lit(7_000_000) - F.col("id")).alias("turn"))
    out = within(spark, 60, lambda: a.event_overlap(accounts, events, {"PMA": ["steel", "tin"]}, ["small"], "id", "members").groupBy("events").count().collect())
    assert {x["events"]: x["count"] for x in out} == {"Steel show; Tin and steel": 10_000, "Small fair": 5_000, "": 5_000}


def test_tiers_score_their_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def score(k):
        seen.add(1)
        return k % 100

    df = spark.range(200).select(F.col("id").alias("company_id"), score("id").alias("icp_score"), F.lit(1).alias("quality_score")).withColumn("tier", F.when(F.col("icp_score") >= 50, "a").otherwise("b"))
    assert r.tier_lists(df, {"a": 5}, ("b",)).count() == 105
    assert seen.value == 200


class _Kept:
    """A state of one key that counts how often it is asked."""

    def __init__(self, calls):
        self.value, self.calls = [], calls

    def exists(self):
        self.calls.append("exists")
        return bool(self.value)

    def get(self):
        self.calls.append("get")
        return self.value[0] if self.one else iter(self.value)

    def update(self, value):
        self.calls.append("update")
        self.value = [value]

    def put(self, rows):
        self.calls.append("put")
        self.value = list(rows)

    def appendList(self, rows):
        self.calls.append("append")
        self.value += rows

    def clear(self):
        self.calls.append("clear")
        self.value = []


def test_snapshots_of_one_url_ask_the_state_a_few_times():
    calls, timers = [], []

    class Handle:
        def getValueState(self, *_):
            out = _Kept(calls)
            out.one = True
            return out

        def getListState(self, *_):
            out = _Kept(calls)
            out.one = False
            return out

        def registerTimer(self, at):
            timers.append(at)

    class Now:
        getCurrentWatermarkInMs = getExpiryTimeInMs = lambda self: 900

    p = streams._Snapshots(None)
    p.init(Handle())
    rows = [{"at": 999 - k, "content": "ab"[k // 10 % 2]} for k in range(1000)]
    assert list(p.handleInputRows(("u",), iter(rows), Now())) == []
    out = list(p.handleExpiredTimer(("u",), Now(), Now()))
    assert [r["at"] for r in out] == list(range(901)) and out[-1]["change_count"] == 90
    assert timers == [0, 901] and len(calls) < 10, (timers, calls)


def test_meets_of_a_company_over_several_batches():
    """A company's rows in two batches count together, and of each set the best stand for all."""
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())))], ["n", "set", "others", "sets"])
    rows = [(1, 0, [1, 2, 3], [0, 7, 7]), (1, 0, [1, 4], [0, 0]), (1, 0, [3, 1], [7, 0]), (1, 0, [5, 1], [7, 0]), (2, 7, [2], [7]), (3, 7, [1, 3], [0, 7])]
    want = [(1, 0, 0, 4, 1, 1), (1, 0, 7, 3, 2, 3), (1, 0, 7, 2, 1, 3), (3, 7, 0, 1, 1, 1)]
    for cut in range(len(rows) + 1):
        got = [tuple(r.values()) for b in g._shared([batch(rows[:cut]), batch(rows[cut:])], 2) for r in b.to_pylist()]
        assert sorted(got) == sorted(want), cut


def test_shared_events_against_all_pairs(spark):
    rng = random.Random(4)
    at = {(f"c{rng.randrange(60)}", f"e{rng.randrange(25)}") for _ in range(260)} | {(f"c{k}", "all") for k in range(0, 60, 2)} | {(f"c{k}", "some") for k in range(0, 60, 3)}
    edges = spark.createDataFrame([(u, e, "SPONSOR") for u, e in at], "source string, target string, kind string")
    got = {(r["id"], r["rank"]): (r["related"], r["other"], r["shared"]) for r in g.all_related(edges, few=4, heavy=12).collect()}
    events = {u: {e for v, e in at if v == u} for u, _ in at}
    want = {}
    for u in events:
        met = sorted((-len(events[u] & events[v]), v) for v in events if v != u and events[u] & events[v])
        want |= {(u, k): (len(met), v, -n) for k, (n, v) in enumerate(met[:4], 1)}
    assert got == want


def test_a_text_is_made_once_for_all_competitors(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(k):
        seen.add(1)
        return ["odoo and sap", "none", "plex", None][k % 4]

    got = spark.range(40).select(s.detect_competitor(text("id")).alias("x")).groupBy("x").count().collect()
    assert {r["x"]: r["count"] for r in got} == {"Odoo": 10, "Plex": 10, "": 20} and seen.value == 40
    code = spark.range(1).select(s.detect_competitor(F.concat(F.lit("marker"), F.col("id").cast("string"))).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert code.count("marker") == 1, code


def test_edges_are_made_once_for_all_steps(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def end(k):
        seen.add(1)
        return f"n{k + 1}"

    edges = spark.range(20).select(F.concat(F.lit("n"), "id").alias("source"), end("id").alias("target"), F.lit("K").alias("kind"))
    got = {(r["id"], r["depth"]) for r in g.neighbors(edges, "n5", 3, ["K"]).collect()}
    assert got == {("n4", 1), ("n6", 1), ("n3", 2), ("n7", 2), ("n2", 3), ("n8", 3)} and seen.value == 20


def test_the_start_of_a_text_is_searched_once_for_all_mentions(spark):
    out = p.mine_signals(spark.createDataFrame([(1, "news " + "sap " * 50)], "id int, text string"), "id", "text", {"sap": ["sap"]})
    assert "2000" not in out._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert {r["kind"] for r in out.collect()} == {"PRESS_RELEASE"} and out.count() == 50


def test_equal_texts_of_a_key_are_indexed_once(spark, monkeypatch):
    sizes, real = [], pr.indexed
    monkeypatch.setattr(pr, "indexed", lambda large, often: sizes.append(large.count()) or real(large, often))
    rows = [(i, f"acme {'abc'[i % 3] * 9} works", None if i % 2 else "a.com", "Akron", "OH", "acme") for i in range(600)]
    df = spark.createDataFrame(rows, "ord int, name string, site string, city string, state string, word string")
    tried = pr.tried_pairs(df, ["word"], {x: F.col(x) for x in ("site", "city", "state")}, ({"site": 0.3, "city": 0.1, "state": 0.1}, {"name": 0.5}), 0.85)
    want = {(a, b) for a in range(600) for b in range(a + 1, 600) if a % 3 == b % 3}
    got = [(r["u"], r["v"]) for r in tried.collect()]
    assert want <= set(got) and len(set(got)) == len(got) and sizes[0] < 100
