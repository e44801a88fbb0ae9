"""Personal data by weak supervision, in DataFrame functions only.

Regexes propose spans. Four labelers vote on each: its shape, a gazetteer, the words around it and its edges.
Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is, without any labels; the
posteriors it gives train a span classifier (naive Bayes over votes, length and share of digits), which decides on every
span beyond the base ones. Base spans (the four kinds with a checkable form) always stay.

The text is scanned once, in place: no text is shuffled. Only vote patterns are aggregated (at most kinds x 3^4 x buckets
rows, whatever the input), and only the model's few hundred numbers come to the driver.

Defined cases: null or empty text has no spans; repeated rows each give their own row; an empty table gives no rows; extra
columns are ignored; a span kind without candidates gets no model and no spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guildbook.llm.common import staged, table
from guildbook.llm.spans import Rule, joined, let, with_matches

# Given names of the gazetteer.
GIVEN_NAMES = """James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph
Jessica Thomas Sarah Karen Charles Lisa Daniel Nancy Matthew Anthony Margaret Mark Sandra Ashley Steven Kimberly Paul Emily
Andrew Donna Joshua Michelle Carol Hans Karl Klaus Greta Anna Maria Jose Juan Carlos Lucia Pierre Jean Claire Luc""".split()
# Top-level domains of the gazetteer.
TOP_LEVEL = "com org net edu gov mil info biz io co us uk de fr es it eu ch at nl be se no dk fi pl pt ca au nz jp cn in br mx ru".split()
# Calling codes of the gazetteer.
CALLING = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 351 352 353 354 358 420 421".split()

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_LOCAL = "A-Za-z0-9._%+-"
BASE = [
    Rule("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Rule("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    Rule("card", r"[0-9](?:[\x20-]?+[0-9])++"),
    Rule("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
]
MORE = [
    Rule("spelled_email", r"(?:\G|(?<![A-Za-z0-9._-]))[A-Za-z0-9._-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?[\[(]dot[\])]\x20?[A-Za-z0-9-]++)++", "at"),
    Rule("local_phone", r"(?<![0-9(+-])\([0-9]{3}\)\x20?[0-9]{3}[-.\x20][0-9]{4}(?![0-9-])|(?<![0-9(+.-])[0-9]{3}([-.])[0-9]{3}\1[0-9]{4}(?![0-9.-])"),
    Rule("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-"),
    Rule("name", r"(?<![\p{L}\p{N}])(?:" + "|".join(GIVEN_NAMES) + r")\x20[A-Z][a-z]{1,30}(?![\p{L}\p{N}])"),
]
KINDS = [r.kind for r in BASE + MORE]

#: Words before a span that speak for a kind, and words that speak against any.
CUES = {
    "email": "mail|contact|write|reply|address",
    "ip": "ip|host|server|client|address|login",
    "card": "card|visa|master|credit|debit|pay|amex",
    "phone": "phone|tel|call|fax|mobile|cell|contact",
    "spelled_email": "mail|contact|write|reply|address",
    "local_phone": "phone|tel|call|fax|mobile|cell|contact",
    "ssn": "ssn|social|security|tax",
    "name": "mr|mrs|ms|dr|name|contact|by|signed|dear|sincerely|regards",
}
AGAINST = "version|release|isbn|order|invoice|part|serial|model|section|figure|table|street|avenue|saint"

LABELERS, VOTES, LENGTHS, DIGITS = 4, 3, 8, 5
ABSTAIN, NO, YES = 0, 1, 2
#: What EM starts from and is held near: chances of abstaining, of no and of yes for a true span; no and yes change places for a false one.
START = (0.3, 0.15, 0.55)
PSEUDO, ROUNDS = 2.0, 25


def valid(kind: str, hit: Column) -> Column:
    """Whether a match of a base kind counts."""
    bare = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        return hit.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(bare).between(16, 19), F.call_function("luhn_check", bare)).otherwise(False)
    if kind == "phone":
        return F.length(bare).between(8, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, NO).when(yes, YES).otherwise(ABSTAIN)


def _shape(kind: str, s: Column) -> Column:
    if kind in [r.kind for r in BASE]:
        good = valid(kind, s["hit"])
        return _vote(good, ~good)
    if kind == "name":
        return _vote(F.lit(False), s["after"].rlike(r"^\x20(?:Street|Avenue|Road|University|Inc|Ltd)"))
    return F.lit(YES)


def _gazetteer(kind: str, s: Column) -> Column:
    hit = s["hit"]
    if kind in ("email", "spelled_email"):
        known = F.lower(F.regexp_extract(hit, r"([A-Za-z0-9-]+)$", 1)).isin(TOP_LEVEL)
        return _vote(known, ~known)
    if kind == "ip":
        odd = hit.rlike(r"^0*(?:0|127|22[4-9]|2[3-5][0-9])\.")
        return _vote(~odd, odd)
    if kind == "card":
        known = F.regexp_replace(hit, "[^0-9]", "").rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|35)")
        return _vote(known, ~known)
    if kind == "phone":
        known = F.regexp_replace(hit, "[^0-9]", "").rlike("^(?:" + "|".join(CALLING) + ")")
        return _vote(known, ~known)
    if kind == "local_phone":
        odd = F.regexp_replace(hit, "[^0-9]", "").rlike("^(?:[01]|...[01])")
        return _vote(F.lit(False), odd)
    if kind == "ssn":
        return _vote(F.lit(False), hit.rlike("^(?:000|666|9)|-00-|-0000$"))
    return F.lit(YES)


def _context(kind: str, s: Column) -> Column:
    before = F.lower(s["before"])
    return _vote(before.rlike(rf"(?<![a-z])(?:{CUES[kind]})[a-z]{{0,3}}[^a-z0-9]{{1,6}}$"), before.rlike(rf"(?<![a-z])(?:{AGAINST})[^a-z0-9]{{0,6}}$"))


def _edges(s: Column) -> Column:
    glued = s["before"].rlike(r"[\p{L}\p{N}_/=]$") | s["after"].rlike(r"^[\p{L}\p{N}_/=]")
    apart = s["before"].rlike(r"(?:^|[\x20\n\t(:,;<])$") & s["after"].rlike(r"^(?:$|[\x20\n\t),.;:>?!])")
    return _vote(apart, glued)


def _features(kind: str, s: Column) -> list[Column]:
    """Votes of the four labelers, then buckets of the length and of the share of digits."""
    length = F.length(s["hit"])
    digits = F.length(F.regexp_replace(s["hit"], "[^0-9]", ""))
    buckets = [F.least(F.lit(LENGTHS - 1), F.floor(length / 5)).cast("int"), F.least(F.lit(DIGITS - 1), F.floor(DIGITS * digits / length)).cast("int")]
    return [_shape(kind, s), _gazetteer(kind, s), _context(kind, s), _edges(s), *buckets]


def candidates(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id and spans, an array of (rank, at, to, base, f), f being the features."""
    found = with_matches(docs.select("doc_id", "text"), "text", BASE + MORE, before=48, after=12)
    base_kinds = {r.kind for r in BASE}

    def rows(kind: str) -> Column:
        def one(s):
            base = valid(kind, s["hit"]) if kind in base_kinds else F.lit(False)
            return F.struct(F.lit(KINDS.index(kind)).alias("rank"), s["at"].alias("at"), s["to"].alias("to"), base.alias("base"), F.array(*[f.cast("int") for f in _features(kind, s)]).alias("f"))

        return F.transform(F.col(kind), one)

    return found.select("doc_id", let(F.concat(*[rows(k) for k in KINDS]), lambda spans: _clear(spans)).alias("spans"))


def _clear(spans: Column, block: int = 64) -> Column:
    """spans without those that lie over a base one. The base spans are looked through in blocks, of which only those that reach to
    a span are opened."""
    sure = F.array_sort(F.transform(F.filter(spans, lambda s: s["base"]), lambda s: F.struct(s["at"], s["to"])))

    def blocks(s):
        count = F.ceil(F.size(s) / block).cast("int")
        places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.expr("cast(array() as array<int>)"))
        parts = F.transform(places, lambda k: F.slice(s, k * block + 1, F.lit(block)))
        return F.transform(parts, lambda p: F.struct(p[0]["at"].alias("at"), F.array_max(F.transform(p, lambda x: x["to"])).alias("to"), p.alias("all")))

    def over(a, b):
        return (a["at"] < b["to"]) & (b["at"] < a["to"])

    return let(let(sure, blocks), lambda bs: F.filter(spans, lambda s: s["base"] | ~F.exists(bs, lambda b: over(b, s) & F.exists(b["all"], lambda x: over(x, s)))))


def _em(patterns: Column) -> Column:
    """Reliabilities of the labelers of one kind. patterns: array<struct<v: array<int>, n: double>>, v holding for each labeler
    3 * labeler + vote. A fold of ROUNDS steps over struct<prior, pos, neg>, pos and neg being chances at the same places."""
    cells = F.sequence(F.lit(0), F.lit(LABELERS * VOTES - 1))
    pos0 = F.array(*[F.lit(START[i % VOTES]) for i in range(LABELERS * VOTES)])
    neg0 = F.array(*[F.lit((START[0], START[2], START[1])[i % VOTES]) for i in range(LABELERS * VOTES)])
    total = F.aggregate(patterns, F.lit(0.0), lambda a, p: a + p["n"])

    def belief(p, s):
        odds = F.aggregate(p["v"], F.log(s["prior"] / (1 - s["prior"])), lambda a, i: a + F.log(s["pos"][i] / s["neg"][i]))
        return 1 / (1 + F.exp(-odds))

    def step(s, _):
        def weighed(p):
            return p["n"] * belief(p, s)

        def cell(start, weight):
            whole = F.aggregate(patterns, F.lit(PSEUDO), lambda a, p: a + weight(p))
            return F.transform(cells, lambda i: F.aggregate(F.filter(patterns, lambda p: F.array_contains(p["v"], i)), PSEUDO * start[i], lambda a, p: a + weight(p)) / whole)

        true = F.aggregate(patterns, F.lit(1.0), lambda a, p: a + weighed(p))
        return F.struct((true / (total + 2)).alias("prior"), cell(pos0, weighed).alias("pos"), cell(neg0, lambda p: p["n"] - weighed(p)).alias("neg"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.struct(F.lit(0.5).alias("prior"), pos0.alias("pos"), neg0.alias("neg")), step)


def train(found: DataFrame) -> DataFrame:
    """The span classifier: (rank, place, value, weight), the log odds that a feature's value adds; place -1 is the constant."""
    patterns = found.select(F.explode("spans").alias("s")).groupBy(F.col("s.rank").alias("rank"), F.col("s.f").alias("f")).agg(F.count("*").cast("double").alias("n"))
    votes = F.transform(F.slice("f", 1, LABELERS), lambda v, i: (i * VOTES + v).cast("int"))
    voted = patterns.groupBy("rank", votes.alias("v")).agg(F.sum("n").alias("n"))
    models = voted.groupBy("rank").agg(F.collect_list(F.struct("v", "n")).alias("p")).select("rank", _em(F.col("p")).alias("m"))
    # The few kinds' models fit in a broadcast whatever the input: at most len(KINDS) rows.
    odds = F.aggregate(votes, F.log(F.col("m.prior") / (1 - F.col("m.prior"))), lambda a, i: a + F.log(F.col("m.pos")[i] / F.col("m.neg")[i]))
    judged = patterns.join(F.broadcast(models), "rank").withColumn("r", 1 / (1 + F.exp(-odds)))
    whole = judged.groupBy("rank").agg(F.sum(F.col("n") * F.col("r")).alias("all_yes"), F.sum(F.col("n") * (1 - F.col("r"))).alias("all_no"))
    cells = judged.select("rank", "n", "r", F.posexplode("f").alias("place", "value")).groupBy("rank", "place", "value").agg(F.sum(F.col("n") * F.col("r")).alias("yes"), F.sum(F.col("n") * (1 - F.col("r"))).alias("no"))
    weights = cells.join(F.broadcast(whole), "rank").select("rank", "place", "value", F.log((F.col("yes") + 0.5) / (F.col("all_yes") + 1) * (F.col("all_no") + 1) / (F.col("no") + 0.5)).alias("weight"))
    return weights.unionByName(whole.select("rank", F.lit(-1).alias("place"), F.lit(0).alias("value"), F.log((F.col("all_yes") + 0.5) / (F.col("all_no") + 0.5)).alias("weight")))


def find_pii(docs: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id and spans, an array of (rank, at, to, base) by kind and start; rank is the
    place in KINDS, at and to are code points, end exclusive."""
    found = staged(candidates(docs), "pii")
    # At most len(KINDS) x (4 labelers x 3 votes + buckets + 1) numbers.
    weights = {(r["rank"], r["place"], r["value"]): r["weight"] for r in train(found).collect()}
    places = LABELERS + 3  # the constant, the votes, two buckets
    width = max(VOTES, LENGTHS, DIGITS)
    model = F.array(*[F.lit(float(weights.get((rank, place - 1, value), 0.0))) for rank in range(len(KINDS)) for place in range(places) for value in range(width)])

    def sure(s):
        first = s["rank"] * places
        odds = F.aggregate(F.transform(s["f"], lambda v, i: model[(first + i + 1) * width + v]), model[first * width], lambda a, w: a + w)
        return s["base"] | (1 / (1 + F.exp(-odds)) >= threshold)

    kept = F.array_sort(F.transform(F.filter("spans", sure), lambda s: F.struct(s["rank"], s["at"], s["to"], s["base"])))
    return found.select("doc_id", kept.alias("spans"))


def count(kind: str) -> Column:
    """How many of the array column sure are of a kind."""
    rank = KINDS.index(kind)
    return F.size(F.filter("sure", lambda s: s["rank"] == rank))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents")).withColumn("sure", F.filter("spans", lambda s: s["base"]))
    counts = [count(kind.kind).cast("long").alias(f"n_{kind.kind}") for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("sure"), KINDS), 256).alias("base_sha256"), joined(F.col("spans"), KINDS).alias("spans"))
