"""From documents to packed sequences: five stages, each a table that the next one reads.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. run()
writes every stage's result as Parquet in the shared folder and reads it again, so that a lost executor costs one stage's
partition at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guildbook.llm import op4_secrets, op5_substrings, op6_simhash, op9_quality, op10_packing
from guildbook.llm.common import new_folder, same, staged, table, unused


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Null and empty texts get the score of the constant alone; without labels all rows
    have one score; ties at the cutoff stay; repeated rows are judged alike."""
    weights = op9_quality.fit(docs, table(spark, sf_dir, "labels"))
    (score,) = unused(docs.columns, "_score")
    scored = op9_quality.score_documents(docs, weights, docs.columns, score)
    return scored.filter(F.col(score) >= op9_quality.CUTOFF).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays (null after all others, then the smallest
    mark of the text); of its repeated rows, equal in doc_id and text, one. Null and empty texts are one group."""
    mark, kept_id, kept = unused(docs.columns, "_mark", "_id", "_stay")
    keyed = docs.withColumn(mark, F.xxhash64(F.unhex(F.sha2("text", 256))))
    # A row is named by its doc_id and its text, as neither null nor repeated ids tell documents apart.
    name = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(mark).alias("mark"))
    found = op6_simhash.near_duplicates(keyed.select(name.alias("doc_id"), "text"))
    stay = found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id.id").alias(kept_id), F.col("doc_id.mark").alias(kept))
    stay = staged(stay.distinct(), "stay")
    left = keyed.join(stay.hint("shuffle_hash"), same((keyed["doc_id"], stay[kept_id]), (keyed[mark], stay[kept])), "left_semi")
    return left.dropDuplicates(["doc_id", mark]).select(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that occurred earlier go; no document does. The order is that of doc_id (null first), then start; whole
    copies get an empty text, null texts stay null."""
    return _measured(op5_substrings.drop_repeats(docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are put out by a mark, overlapping ones by one; no document goes, null texts stay null."""
    return _measured(op4_secrets.redact(docs, new_folder(spark, "ledger")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences; null texts count as empty, and each row has pieces of its own."""
    return op10_packing.pack_documents(docs, op10_packing.default_path())


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack),
]

#: No SQL: the classifier, XXH64 fingerprints and the tokenizer are beyond DuckDB. tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
