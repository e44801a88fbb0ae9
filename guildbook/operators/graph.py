"""Graph tables: nodes and edges of associations, companies, events and competitors, their metrics and neighbourhoods."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from guildbook.operators.store import written

c = F.col


def node_id(kind: str, key) -> F.Column:
    """A stable id: kind and key in one."""
    return F.concat(F.lit(f"{kind}:"), key.cast("string"))


def build_nodes(companies: DataFrame, memberships: DataFrame, events: DataFrame, signals: DataFrame) -> DataFrame:
    row = lambda df, kind, key, name: df.select(node_id(kind, key).alias("id"), F.lit(kind).alias("kind"), name.cast("string").alias("name")).distinct()
    return (
        row(companies, "company", c("company_id"), c("company_name"))
        .unionByName(row(memberships, "association", c("association"), c("association")))
        .unionByName(row(events, "event", c("event_id"), c("title")))
        .unionByName(row(signals, "competitor", c("competitor"), F.initcap("competitor")))
    )


def build_edges(memberships: DataFrame, events: DataFrame, participants: DataFrame, signals: DataFrame) -> DataFrame:
    edge = lambda df, source, target, kind: df.select(source.alias("source"), target.alias("target"), kind.alias("kind"))
    return (
        edge(memberships, node_id("association", c("association")), node_id("company", c("company_id")), F.lit("HAS_MEMBER"))
        .unionByName(edge(events, node_id("association", c("organizer")), node_id("event", c("event_id")), F.lit("HOSTS_EVENT")))
        .unionByName(edge(participants, node_id("company", c("company_id")), node_id("event", c("event_id")), c("kind")))
        .unionByName(edge(signals, node_id("company", c("company_id")), node_id("competitor", c("competitor")), F.lit("MENTIONED_COMPETITOR")))
        .distinct()
    )


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Ends of edges at each node, zero for nodes without any; an edge to itself counts twice."""
    ends = edges.select(F.explode(F.array("source", "target")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
    return nodes.join(ends, "id", "left").select("id", "kind", F.coalesce("degree", F.lit(0)).alias("degree"))


def metrics(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    d = degrees(nodes, edges)
    n = d.agg(F.count("*").alias("nodes"), F.avg("degree").alias("avg_degree"), F.max("degree").alias("max_degree"), F.min("degree").alias("min_degree"))
    e = edges.agg(F.count("*").alias("edges"))
    return n.join(F.broadcast(e), F.lit(True)).select("nodes", "edges", F.round("avg_degree", 6).alias("avg_degree"), "max_degree", "min_degree", F.round(2.0 * c("edges") / (c("nodes") * (c("nodes") - 1)), 9).alias("density"))


def neighbors(edges: DataFrame, start: str, depth: int, kinds: list[str] | None = None) -> DataFrame:
    """(id, depth) within `depth` steps, in either direction, breadth first. Each step is a join of the frontier with the edges,
    which are made once."""
    if kinds:
        edges = edges.filter(c("kind").isin(kinds))
    edges = written(edges.select("source", "target"), "edges")
    both = edges.select(c("source").alias("id"), c("target").alias("next")).unionByName(edges.select(c("target").alias("id"), c("source").alias("next")))
    seen = edges.sparkSession.createDataFrame([(start, 0)], "id string, depth int")
    frontier = seen
    for step in range(1, depth + 1):
        found = frontier.select("id").join(both, "id").select(c("next").alias("id")).distinct()
        frontier = written(found.join(seen.select("id"), "id", "left_anti").withColumn("depth", F.lit(step)), "frontier")
        seen = written(seen.unionByName(frontier), "seen")
    return seen.filter("depth > 0")


def related_companies(edges: DataFrame, company: str) -> DataFrame:
    """Companies at the same events as one company, with the number of shared events. Only its own events are joined."""
    parts = edges.filter(c("kind").isin("SPONSOR", "EXHIBITOR", "ATTENDEE"))
    own = parts.filter(c("source") == company).select("target").distinct()
    return parts.join(own, "target").filter(c("source") != company).groupBy(c("source").alias("id")).agg(F.count_distinct("target").alias("shared"))


#: Companies at an event beyond which its pairs are not listed.
HEAVY = 200


def _shared(batches: Iterable[pa.RecordBatch], few: int) -> Iterator[pa.RecordBatch]:
    """Of rows (n, set, others, sets) in the order of n, a company at one event with those who are there: per company and set of the others the
    `few` that it meets most often (least number on ties) and how many there are. A company whose rows go on in the next batch waits
    for it, with a number for each other company, not for each meeting."""
    names = ["n", "set", "with", "other", "light", "met"]

    def counted(n, own, other, with_, times):
        order = np.lexsort((other, n))
        n, own, other, with_, times = n[order], own[order], other[order], with_[order], times[order]
        first = np.flatnonzero(np.r_[True, (n[1:] != n[:-1]) | (other[1:] != other[:-1])]) if len(n) else np.zeros(0, np.int64)
        return n[first], own[first], other[first], with_[first], np.add.reduceat(times, first) if len(first) else times

    def best(n, own, other, with_, times):
        order = np.lexsort((other, -times, with_, n))
        n, own, other, with_, times = n[order], own[order], other[order], with_[order], times[order]
        first = np.flatnonzero(np.r_[True, (n[1:] != n[:-1]) | (with_[1:] != with_[:-1])])
        sizes = np.diff(np.r_[first, len(n)])
        kept = np.arange(len(n)) - np.repeat(first, sizes) < few
        return pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in (n, own, with_, other, times, np.repeat(sizes, sizes))], names)

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column("others")
        sizes = np.diff(lists.offsets.to_numpy())
        n, own = (np.repeat(batch.column(x).to_numpy(), sizes) for x in ("n", "set"))
        other, with_ = lists.flatten().to_numpy(), batch.column("sets").flatten().to_numpy()
        apart = n != other
        now = [n[apart], own[apart], other[apart], with_[apart], np.ones(int(apart.sum()), np.int64)]
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now, strict=True)]
        now = counted(*now)
        if not len(now[0]):
            held = None
            continue
        done = now[0] != now[0][-1]
        held = [x[~done] for x in now]
        if done.any():
            yield best(*[x[done] for x in now])
    if held is not None:
        yield best(*held)


def all_related(edges: DataFrame, few: int = 10, heavy: int = HEAVY) -> DataFrame:
    """(id, related, rank, other, shared): for every company the number of companies that share an event with it, and the `few` that share
    most (least id on ties). Companies without any have no row.

    Companies get numbers in the order of their ids. At events of up to `heavy` companies each company gets the list of those who are there, so
    the lists grow with the edges, and meets are counted in the task that has its lists. Companies at the same set of larger events
    are one class: classes meet by their events, a class counts by its size, and its first members by id stand for it. That is enough:
    a member that is left out shares no more than those before it. For the same reason a company keeps `few` of each class that it meets at small
    events, and their number: what they share at larger events is the same for all of the class."""
    at = edges.filter(c("kind").isin("SPONSOR", "EXHIBITOR", "ATTENDEE")).select(c("source").alias("id"), c("target").alias("event")).distinct()
    at = written(at, "visits")
    size = at.groupBy("event").agg((F.count("*") > heavy).alias("heavy"))
    at = written(at.join(size, "event"), "attended")
    sets = at.groupBy("id").agg(F.array_sort(F.collect_list(F.when(c("heavy"), c("event")))).alias("set"))
    sets = written(sets.orderBy("id").withColumn("n", F.monotonically_increasing_id()), "sets")
    classes = sets.filter(F.size("set") > 0).groupBy("set").agg(F.count("*").alias("size"))
    classes = written(classes.withColumn("class", F.monotonically_increasing_id() + 1), "classes")
    who = written(sets.join(classes.select("set", "class"), "set", "left").select("id", "n", F.coalesce("class", F.lit(0)).alias("set")), "numbers")

    there = at.filter(~c("heavy")).select("id", "event").join(who, "id").groupBy("event").agg(F.collect_list(F.struct("n", "set")).alias("x"))
    there = there.select(c("x.n").alias("others"), c("x.set").alias("sets"), F.explode("x").alias("y"))
    there = there.select("y.n", "y.set", "others", "sets").repartition("n").sortWithinPartitions("n")
    light = there.mapInArrow(lambda batches: _shared(batches, few), "n long, set long, with long, other long, light long, met long")
    light = written(light, "light")

    flat = classes.select(c("class").alias("set"), "size", F.explode("set").alias("event"))
    met = flat.alias("a").join(flat.alias("b"), F.expr("a.event = b.event")).groupBy(c("a.set").alias("set"), c("b.set").alias("with")).agg(F.count("*").alias("over"), F.max("b.size").alias("size"))
    met = written(met, "met")
    pairs = written(light.join(met.select("set", "with", "over"), ["set", "with"], "left").withColumn("over", F.coalesce("over", F.lit(0))), "pairs")
    alone = pairs.filter("over = 0").groupBy("n", "with").agg(F.first("met").alias("met")).groupBy("n").agg(F.sum("met").alias("_light"))
    many = met.groupBy("set").agg((F.sum("size") - 1).alias("_heavy"))
    counted = who.join(many, "set", "left").join(alone, "n", "left").select("n", "id", (F.coalesce("_heavy", F.lit(0)) + F.coalesce("_light", F.lit(0))).alias("related"))

    first = Window.partitionBy("set").orderBy("n")
    heads = who.filter("set > 0").withColumn("_r", F.row_number().over(first)).filter(c("_r") <= few + 1).select(c("set").alias("with"), c("n").alias("other"))
    best = Window.partitionBy("set").orderBy(F.desc("over"), "other")
    of_class = met.join(heads, "with").withColumn("_r", F.row_number().over(best)).filter(c("_r") <= few + 1).select("set", "other", c("over").alias("shared"))
    by_class = who.join(written(of_class, "tops"), "set").filter("n <> other").select("n", "other", "shared")
    both = by_class.unionByName(pairs.select("n", "other", (c("light") + c("over")).alias("shared"))).groupBy("n", "other").agg(F.max("shared").alias("shared"))
    ranked = both.withColumn("rank", F.row_number().over(Window.partitionBy("n").orderBy(F.desc("shared"), "other"))).filter(c("rank") <= few)
    names = who.select(c("n").alias("other"), c("id").alias("_name"))
    return ranked.join(counted, "n").join(names, "other").select("id", "related", "rank", c("_name").alias("other"), "shared")


def export_graph(nodes: DataFrame, edges: DataFrame, format: str = "cytoscape") -> DataFrame:
    """(part, element): nodes and edges as JSON texts, one row each. json: the rows as they are; cytoscape: elements of a graph viewer;
    gephi: nodes and edges with labels, types and a weight (of edges without a confidence 1)."""
    label = c("kind").alias("type")
    weight = (c("confidence") if "confidence" in edges.columns else F.lit(1.0)).cast("double").alias("weight")
    name, link = F.concat_ws("|", "source", "kind", "target").alias("id"), c("kind").alias("label")
    if format == "json":
        n, e = F.struct(*nodes.columns), F.struct(*edges.columns)
    elif format == "cytoscape":
        n, e = (F.struct(F.struct(*x).alias("data")) for x in (["id", c("name").alias("label"), label], [name, "source", "target", link]))
    elif format == "gephi":
        n, e = F.struct("id", c("name").alias("label"), label), F.struct(name, "source", "target", label, weight)
    else:
        raise ValueError(f"no format of graphs: {format}")
    part = lambda df, what, x: df.select(F.lit(what).alias("part"), F.to_json(x).alias("element"))
    return part(nodes, "node", n).unionByName(part(edges, "edge", e))


def update_graph(old: tuple[DataFrame, DataFrame], new: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of both graphs: of nodes with one id the new one stands, equal edges are one."""
    both = old[0].withColumn("_turn", F.lit(0)).unionByName(new[0].withColumn("_turn", F.lit(1)))
    nodes = both.groupBy("id").agg(F.max_by(F.struct("kind", "name"), "_turn").alias("x")).select("id", "x.kind", "x.name")
    return nodes, old[1].unionByName(new[1]).distinct()


def nodes_by_type(nodes: DataFrame, kind: str) -> DataFrame:
    return nodes.filter(c("kind") == kind)


def count_by_type(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("kind").agg(F.count("*").alias("n"))

