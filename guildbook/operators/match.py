"""Finding and merging duplicate companies: blocking, pruned fuzzy scores, greedy clusters, survivorship."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guildbook.functions.similar import indel_ratio
from guildbook.operators.pairs import TOLERANCE, present, tried_pairs, with_rows
from guildbook.operators.store import written

c = F.col
THRESHOLD = 0.85
WEIGHTS = {"name": 0.5, "domain": 0.3, "city": 0.1, "state": 0.1}


def scored(df: DataFrame, ord_: str, blocks: list[str], exact: dict[str, float], fuzzy: dict[str, float], threshold: float, fold: bool) -> DataFrame:
    """(u, v, score) of the pairs (u < v by ord_) that share a block and reach the threshold: exact fields count if equal (fold: without
    case), fuzzy ones by their likeness; a mean over the fields that both rows have. Pairs are tried where their fields leave it possible (see
    pairs); what they then leave for the fuzzy fields is held against the edit distance, and only survivors meet the fuzzy ratio."""
    fields, weights = [*exact, *fuzzy], exact | fuzzy
    rows = written(df.select(c(ord_).alias("ord"), *[c(x) for x in dict.fromkeys([*fields, *blocks])]), "rows")
    value = lambda x: F.lower(x.cast("string")) if fold else x.cast("string")
    tried = tried_pairs(rows, blocks, {f: value(c(f)) for f in exact}, (exact, fuzzy), threshold)
    pairs = with_rows(tried, rows, list(dict.fromkeys([*fields, *blocks])))
    met = reduce(lambda x, y: x | y, [(c(f"a_{b}") == c(f"b_{b}")) & present(c(f"a_{b}")) for b in blocks])
    both = {f: present(c(f"a_{f}")) & present(c(f"b_{f}")) for f in fields}
    total = reduce(lambda x, y: x + y, [F.when(both[f], w).otherwise(0.0) for f, w in weights.items()])
    equal = reduce(lambda x, y: x + y, [F.when(both[f] & (value(c(f"a_{f}")) == value(c(f"b_{f}"))), w).otherwise(0.0) for f, w in exact.items()])
    most = reduce(lambda x, y: x + y, [F.when(both[f], w).otherwise(0.0) for f, w in fuzzy.items()])
    pairs = pairs.filter(met).select("u", "v", equal.alias("equal"), total.alias("total"), most.alias("most"), *[c(f"{side}_{f}") for f in fuzzy for side in "ab"], *[both[f].alias(f"both_{f}") for f in fuzzy])
    for f, w in fuzzy.items():
        # Least likeness that still reaches the threshold, as a limit on the edit distance: indel ratio >= s needs
        # levenshtein <= (1 - s) * (len a + len b).
        need, x, y = (F.lit(threshold) * c("total") - c("equal") - (c("most") - w)) / w, c(f"a_{f}"), c(f"b_{f}")
        pairs = pairs.filter(~c(f"both_{f}") | (F.levenshtein(x, y) <= F.floor((1 - need) * (F.length(x) + F.length(y)) + TOLERANCE)))
    like = reduce(lambda x, y: x + y, [F.when(c(f"both_{f}"), w * indel_ratio(f"a_{f}", f"b_{f}")).otherwise(0.0) for f, w in fuzzy.items()])
    return pairs.withColumn("score", (c("equal") + like) / c("total")).filter(c("score") >= threshold - TOLERANCE).select("u", "v", "score")


def candidate_pairs(df: DataFrame, ord_: str, blocks: list[str], exact: dict[str, float], name: tuple[str, float], threshold: float = THRESHOLD) -> DataFrame:
    """Scored pairs of companies: exact fields without case, and a fuzzy name."""
    return scored(df, ord_, blocks, exact, dict([name]), threshold, fold=True)


ENTITY_WEIGHTS = {"domain": 0.40, "name": 0.35, "phone": 0.10, "address": 0.15}


def score_entity_pairs(df: DataFrame, ord_: str, blocks: list[str], weights: dict[str, float] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Scored pairs of rows with domain, name, phone (last ten digits) and address: domain and phone count if equal, name and address by
    their likeness."""
    w = weights or ENTITY_WEIGHTS
    return scored(df, ord_, blocks, {f: w[f] for f in ("domain", "phone")}, {f: w[f] for f in ("name", "address")}, threshold, fold=False)


def dedupe_stats(rows: DataFrame, clusters: DataFrame) -> DataFrame:
    """One row: records before and after, groups of duplicates, and rows that went into another."""
    groups = clusters.groupBy("leader").agg(F.count("*").alias("n"))
    sums = groups.agg(F.count("*").alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("grouped"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"))
    counted = rows.agg(F.count("*").alias("records"))
    return counted.join(F.broadcast(sums), F.lit(True)).select("records", (c("records") - c("grouped") + c("groups")).alias("kept"), "groups", (c("grouped") - c("groups")).alias("merged"), "largest")


def _ends(alias: DataFrame) -> DataFrame:
    """alias(v, u, want): v leads iff u's leading is want. The same with u at the end of each chain; a jump halves the chains."""
    while True:
        after = alias.select(c("v").alias("u"), c("u").alias("end"), c("want").alias("then"))
        jumped = alias.join(after, "u", "left").select("v", F.coalesce("end", "u").alias("u"), (c("want") == F.coalesce("then", F.lit(True))).alias("want"), c("end").isNotNull().alias("moved"))
        jumped = written(jumped, "jumped")
        alias = jumped.drop("moved")
        if jumped.filter("moved").isEmpty():
            return alias


def leading(edges: DataFrame) -> DataFrame:
    """(node, leads) for every node of the edges (u < v): a node leads iff no lower neighbour does.

    terms(v, u, want) holds the open nodes: v leads iff each u's leading is want. A round puts in what was decided in the last one. A node with
    a term that fails, or with both wants of one u, doesn't lead; one without terms leads; both leave with their terms. A node with one
    term left only repeats or negates another: it leaves too, and those that ask for it ask for the end of its chain, found by jumps. So
    the rounds of a chain grow with the logarithm of its length. The lowest open node is decided in each round, so the rounds end."""
    terms = written(edges.select("v", "u").distinct().withColumn("want", F.lit(False)), "terms")
    lowest = edges.select(c("u").alias("v")).distinct().join(edges.select("v").distinct(), "v", "left_anti")
    now = written(lowest.select("v", F.lit(True).alias("leads")), "decided")
    decided, aliases = [now], []
    while not terms.isEmpty():
        met = terms.join(now.select(c("v").alias("u"), "leads"), "u", "left").groupBy("v", "u").agg(F.bool_and("want").alias("least"), F.bool_or("want").alias("want"), F.first("leads").alias("leads"))
        met = written(met.select("v", "u", "want", (c("least") != c("want")).alias("both"), "leads"), "met")
        failed = c("both") | F.coalesce(c("leads") != c("want"), F.lit(False))
        left = F.when(c("leads").isNull(), 1)
        judged = written(met.groupBy("v").agg(F.bool_or(failed).alias("failed"), F.count(left).alias("left"), F.max(F.when(c("leads").isNull(), F.struct("u", "want"))).alias("one")), "judged")
        now = judged.filter("failed or left = 0").select("v", (~c("failed")).alias("leads"))
        decided.append(now)
        alias = judged.filter("not failed and left = 1").select("v", "one.u", "one.want")
        if not alias.isEmpty():
            alias = _ends(alias)
            aliases.append(alias)
        rest = met.filter("leads is null").join(judged.filter("not failed and left > 1").select("v"), "v").select("v", "u", "want")
        ends = alias.select(c("v").alias("u"), c("u").alias("end"), c("want").alias("then"))
        moved = rest.join(ends, "u", "left").select("v", F.coalesce("end", "u").alias("u"), (c("want") == F.coalesce("then", F.lit(True))).alias("want"))
        terms = written(moved.distinct(), "terms")
    for alias in reversed(aliases):  # chains end at nodes that were decided, or left after theirs
        known = reduce(DataFrame.unionByName, decided).select(c("v").alias("u"), "leads")
        decided.append(written(alias.join(known, "u").select("v", (c("leads") == c("want")).alias("leads")), "decided"))
    return reduce(DataFrame.unionByName, decided).withColumnRenamed("v", "node")


def leader_clusters(edges: DataFrame) -> DataFrame:
    """(node, leader) for every node of the edges (u < v): the greedy clusters of a scan in order, which is not transitive.

    A node is a leader iff no lower neighbour is one; a member belongs to its lowest leader."""
    edges = written(edges.select("u", "v"), "edges")
    state = written(leading(edges), "state")
    member = edges.join(state.filter("leads").select(c("node").alias("u")), "u").groupBy("v").agg(F.min("u").alias("leader"))
    return state.filter("leads").select("node", c("node").alias("leader")).unionByName(state.filter("not leads").join(member.withColumnRenamed("v", "node"), "node").select("node", "leader"))


def first_truthy(field: str, kind: Column, ord_: str = "ord") -> Column:
    """The first value in order that isn't nothing."""
    return F.min_by(F.when(kind, c(field)), F.when(kind, c(ord_)))


def merge_clusters(df: DataFrame, clusters: DataFrame, ord_: str, firsts: dict[str, Column], maxima: list[str], unions: dict[str, Column]) -> DataFrame:
    """One row per cluster: first value that is something, greatest of numbers, sorted unions of lists, how many were merged.
    Rows outside any cluster keep themselves; only clustered rows are shuffled by cluster."""
    df = df.withColumn("ord", c(ord_))
    keyed = df.join(clusters.withColumnRenamed("node", "ord"), "ord", "left").withColumn("leader", F.coalesce("leader", "ord"))
    return keyed.groupBy("leader").agg(
        *[first_truthy(f, present).alias(f) for f, present in firsts.items()],
        *[F.max(f).alias(f) for f in maxima],
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(x)))).alias(f) for f, x in unions.items()],
        F.count("*").alias("merged_from_count"),
    )


def first_per_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_n = 1").drop("_n")


def resolve_entities(pairs_clusters: DataFrame, df: DataFrame, ord_: str, score: str) -> DataFrame:
    """Canonical record of each cluster (the best score, the first on ties), its other names, and all sources."""
    keyed = df.withColumn("ord", c(ord_)).join(pairs_clusters.withColumnRenamed("node", "ord"), "ord", "left").withColumn("leader", F.coalesce("leader", "ord"))
    best = F.max_by(F.struct("ord", "company_name"), F.struct(c(score), -c("ord")))
    out = keyed.groupBy("leader").agg(best.alias("best"), F.collect_set("company_name").alias("names"), F.count("*").alias("records"))
    return out.select("leader", c("best.ord").alias("canonical"), c("best.company_name").alias("name"), F.array_sort(F.array_remove("names", c("best.company_name"))).alias("aliases"), "records")
