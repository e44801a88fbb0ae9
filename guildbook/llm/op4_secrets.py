"""Secrets by an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its content. The ledger is a Parquet table of (blob, rules, spans):
what a rule version found in a blob. A scan looks up the given versions, scans each blob once that the ledger lacks under
the rule version in use, appends what it finds (an empty list too, so that clean blobs are not scanned again) and joins the
ledger's findings back to all paths.

Copies fall together by their digest before any text moves, so a blob with a million paths is scanned once; the join back
is on digests only, and both its sides are plain tables, so that Spark can split a hot digest. Texts whose digest can't be one
of the unseen (told by a bounded broadcast of digest residues) stay where they are; only the others are shuffled, to meet the
row that was chosen for their blob. Two scans at once may both append a blob; readers take one of its rows.

Defined cases: null text counts as empty; null doc_id is a path like any other; repeated rows each get their row; empty
tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from guildbook.llm.common import new_folder, staged, table, unused
from guildbook.llm.spans import Rule, joined, with_matches

RULES = "1"
_ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
BASE = [Rule("assign", _ASSIGN + r"[A-Za-z0-9+/_.=-]++"), Rule("access", r"AKIA[A-Z0-9]++", "AKIA"), Rule("hex", r"[0-9a-f]{16,}+")]
MORE = [
    Rule("private_key", r"-----BEGIN\x20(?:[A-Z]+\x20)?PRIVATE\x20KEY-----", "PRIVATE KEY-----"),
    Rule("code_host", r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36,}+", "_"),
    Rule("chat", r"(?<![A-Za-z0-9])xox[baprs]-[A-Za-z0-9-]{10,}+", "xox"),
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", "eyJ"),
]
KINDS = [r.kind for r in BASE + MORE]
#: Residues of digests that are told to all tasks before texts are shuffled.
RESIDUES = 1 << 20
LEDGER = "blob binary, rules string, spans array<struct<at:int,rank:int,to:int>>"


def _counts(kind: str, hit: Column) -> Column:
    if kind == "assign":
        return F.length(F.regexp_replace(hit, f"^{_ASSIGN}", "")) >= 12
    return F.length(hit) >= 18 if kind == "access" else F.lit(True)


def scan_blobs(blobs: DataFrame) -> DataFrame:
    """blob and its spans, ordered by start, then kind."""
    found = with_matches(blobs.select("blob", "text"), "text", BASE + MORE)

    def rows(kind: str) -> Column:
        good = F.filter(F.col(kind), lambda s: _counts(kind, s["hit"]))
        return F.transform(good, lambda s: F.struct(s["at"].alias("at"), F.lit(KINDS.index(kind)).alias("rank"), s["to"].alias("to")))

    return found.select("blob", F.array_sort(F.concat(*[rows(k) for k in KINDS])).alias("spans"))


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(LEDGER).parquet(folder) if there else spark.createDataFrame([], LEDGER)


def unseen(versions: DataFrame, ledger: DataFrame, rules: str) -> DataFrame:
    """One (doc_id, blob) for each blob that the ledger lacks under these rules."""
    known = ledger.filter(F.col("rules") == rules).select("blob")
    return versions.groupBy("blob").agg(F.min("doc_id").alias("doc_id")).join(known, "blob", "left_anti")


def update_ledger(docs: DataFrame, folder: str, rules: str = RULES) -> DataFrame:
    """Scan what is new in docs (doc_id, text), append it to the ledger in folder, return (doc_id, blob) of every row."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("blob", F.unhex(F.sha2("text", 256)))
    versions = staged(docs.select("doc_id", "blob"), "versions")
    new = staged(unseen(versions, _ledger(docs.sparkSession, folder), rules), "unseen")
    chosen = new.select(F.col("doc_id").alias("chosen_id"), F.col("blob").alias("chosen_blob")).hint("shuffle_hash")
    # At most RESIDUES rows of one number, whatever the input.
    residue = lambda blob: F.pmod(F.xxhash64(blob), F.lit(RESIDUES)).cast("int")
    hopeful = staged(new.select(residue("blob").alias("residue")).distinct(), "residues")
    docs = docs.withColumn("residue", residue("blob")).join(F.broadcast(hopeful), "residue", "left_semi")
    blobs = docs.join(chosen, docs["doc_id"].eqNullSafe(chosen["chosen_id"]) & (docs["blob"] == chosen["chosen_blob"]), "left_semi")
    found = scan_blobs(blobs).dropDuplicates(["blob"])  # repeated rows of one path hold the same blob
    found.select("blob", F.lit(rules).alias("rules"), "spans").write.mode("append").parquet(folder)
    return versions


def known(spark: SparkSession, folder: str, rules: str = RULES) -> DataFrame:
    """blob and spans, one row per blob that was scanned under these rules."""
    ledger = spark.read.schema(LEDGER).parquet(folder).filter(F.col("rules") == rules)
    return ledger.groupBy("blob").agg(F.first("spans").alias("spans"))


def findings(versions: DataFrame, folder: str, rules: str = RULES) -> DataFrame:
    """doc_id, blob, spans of every version."""
    return versions.join(known(versions.sparkSession, folder, rules), "blob", "left")


def scan(docs: DataFrame, folder: str, rules: str = RULES) -> DataFrame:
    return findings(update_ledger(docs, folder, rules), folder, rules)


@F.udf(StringType(), useArrow=True)
def _redacted(text: str | None, spans: list | None, mark: str) -> str | None:
    """text with its spans (in order of their starts) put out; Python slices a text in linear time, SQL counts code points anew."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for s in spans:
        if s["at"] >= at:
            out += [text[at : s["at"]], mark]
        at = max(at, s["to"])
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, folder: str, mark: str = "[SECRET]", rules: str = RULES) -> DataFrame:
    """docs with every secret in text put out by mark; overlapping spans become one mark. Null texts stay null; all columns stay."""
    update_ledger(docs, folder, rules)
    key, blob, spans = unused(docs.columns, "_key", "_blob", "_spans")
    ledger = known(docs.sparkSession, folder, rules).filter(F.size("spans") > 0).select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    keyed = docs.withColumn(key, F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    joined_ = keyed.join(ledger, F.col(key) == F.col(blob), "left")
    # Only texts with spans go through Python.
    new = _redacted(F.when(F.col(spans).isNotNull(), F.col("text")), F.col(spans), F.lit(mark))
    return joined_.withColumn("text", F.when(F.col(spans).isNull(), F.col("text")).otherwise(new)).select(*docs.columns)


def count(kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.size(F.filter("sure", lambda s: s["rank"] == rank))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), new_folder(spark, "ledger"))
    found = found.withColumn("sure", F.filter("spans", lambda s: s["rank"] < len(BASE)))
    counts = [count(r.kind).cast("long").alias(f"n_{r.kind}") for r in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("sure"), KINDS), 256).alias("base_sha256"), joined(F.col("spans"), KINDS).alias("spans"))
