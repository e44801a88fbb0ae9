"""A deterministic sharded WARC writer, and a reader of what it wrote.

Writing: the shards' bounds on page_id come from exact running sums of payload bytes, so the same pages give the same files
whatever the partitions. The bounds are one number for each shard of at least SHARD bytes, and at most MOST_SHARDS of
them, as shards grow with the table beyond that; so they are small enough for a broadcast. A column tells each page's shard by
binary search, and one shuffle deals every shard to a task of its own, with one small row for each page that repeats an earlier
payload; a task merges both streams in order of page_id, so no page is joined or held. It writes a gzip member per record and
rolls to the next file by compressed size. Headers and digests are made anew.

Files are written under names of the attempt. Spark keeps the list of the files of the attempts that succeeded; tasks then rename
those, and the list of their final names is the manifest, which appears in one rename. A folder with a manifest is refused at once;
files that an ended run without manifest left there are replaced, and its unfinished manifest is dropped. Readers go by the manifest
only and hold each file's digest against it, so a lost task or driver leaves nothing that counts. The driver holds no list of files.

Defined cases: null html counts as an empty payload; pages without page_id are written without a page number, in shards of their
own after all others, dealt by their payload; of repeated rows with one page_id the first written is the response and the others
refer to it; an empty table gives a manifest without files and no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from guildbook.llm.common import new_folder, staged, table

#: Payloads of fewer bytes are never revisits. Least bytes of payload to a shard, compressed bytes to a file. Beyond MOST_SHARDS shards
#: (half a terabyte) shards grow with the table, so that the compressed size cuts the files; below, tasks are kept small.
SMALLEST, SHARD, ROLL = 100, 32 << 20, 256 << 20
#: Rows of a range on average and the most ranges, while bounds are looked for; the most shards.
ROWS, RANGES, MOST_SHARDS = 1_000_000, 1 << 12, 1 << 14
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "manifest"
FILES = "final string, written string, records long, bytes long, sha256 string"


def record_id(page_id: int | None, digest: str, nth: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {nth}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str, nth: int) -> bytes:
    """One WARC record, its headers made anew."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest, nth)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {(url or 'about:blank').replace(chr(13), '').replace(chr(10), '')}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"Page-Number: {page_id}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest, 0)}", f"Refers-To-Page-Number: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder as Spark names it, and the folder's path there."""
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1) if folder.startswith("s3a://") else folder)


class Digested:
    """A stream that takes the digest of what is read from it."""

    def __init__(self, stream):
        self.stream, self.sha = stream, hashlib.sha256()

    def read(self, size: int) -> bytes:
        data = self.stream.read(size)
        self.sha.update(data)
        return data


def file_digest(where: fs.FileSystem, path: str) -> str:
    with where.open_input_stream(path, compression=None) as stream:
        digested = Digested(stream)
        while digested.read(1 << 20):
            pass
    return digested.sha.hexdigest()


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file of gzip members, one member in memory at a time."""
    held = stream.read(1 << 20)
    while held:
        unzip, data = zlib.decompressobj(31), []
        while not unzip.eof:
            if not held:
                raise ValueError("a record breaks off")
            data.append(unzip.decompress(held))
            held = unzip.unused_data if unzip.eof else stream.read(1 << 20)
        held = held or stream.read(1 << 20)
        head, _, rest = b"".join(data).partition(b"\r\n\r\n")
        headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        block = rest[: int(headers["Content-Length"])]
        if hashlib.sha256(block).hexdigest() != headers["WARC-Block-Digest"].removeprefix("sha256:"):
            raise ValueError("a block doesn't match its digest")
        yield headers, block


def shard_bounds(pages: DataFrame, size: int = SHARD) -> np.ndarray:
    """The least page_id of each shard but the first: shards of about `size` bytes. pages: page_id and bytes.

    Narrow rows are sorted by range once. The bytes of all smaller ids, which don't depend on how the ranges were cut, tell an id's
    shard: sums of whole ranges (at most RANGES numbers) and a running sum within each."""
    named = pages.filter("page_id is not null")
    ranges = max(1, min(RANGES, named.count() // ROWS))
    rows = staged(named.repartitionByRange(ranges, "page_id").withColumn("range", F.spark_partition_id()), "ranges")
    sums = {r["range"]: r["bytes"] for r in rows.groupBy("range").agg(F.sum("bytes").alias("bytes")).collect()}
    upto, offsets = 0, []
    for k in sorted(sums):
        offsets.append((k, upto))
        upto += sums[k]
    offset = pages.sparkSession.createDataFrame(offsets, "range int, upto long")
    before = F.coalesce(F.sum("bytes").over(Window.partitionBy("range").orderBy("page_id").rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("before", before).join(F.broadcast(offset), "range").groupBy(F.floor((F.col("upto") + F.col("before")) / size).alias("shard")).agg(F.min("page_id").alias("least"))
    return np.sort(placed.select("least").toArrow().column(0).to_numpy())[1:]  # a number for each shard


def write_archives(pages: DataFrame, folder: str, shard: int = SHARD, roll: int = ROLL) -> DataFrame:
    """Write a record per row of pages (page_id, url, html) under folder; returns the manifest (final, records, bytes, sha256)."""
    spark = pages.sparkSession
    path, hadoop = _hadoop(spark, folder)
    if hadoop.exists(path(f"{folder}/{MANIFEST}")):
        raise FileExistsError(f"{folder} has a manifest already")
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    keys = staged(pages.select("page_id", F.octet_length("html").cast("long").alias("bytes"), F.unhex(F.sha2("html", 256)).alias("digest")), "keys")
    firsts = keys.filter(F.col("bytes") >= SMALLEST).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null").drop("n")
    firsts = staged(firsts, "firsts")
    # page_id -> the response that it revisits, only of repeated payloads.
    refs = keys.filter(F.col("bytes") >= SMALLEST).join(firsts, "digest").select("page_id", "first", "digest")
    total, nameless = keys.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("page_id").isNull(), F.col("bytes") + 1)), F.lit(0))).first()
    size = max(shard, -(-total // MOST_SHARDS))
    cuts = spark.sparkContext.broadcast(shard_bounds(keys.select("page_id", "bytes"), size))
    named, rest = len(cuts.value) + 1, -(-nameless // size)

    @F.pandas_udf("int")
    def shard_of(page_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts.value, page_id.to_numpy(), "right").astype(np.int32))

    empty = F.lit(None)
    both = pages.select("page_id", F.lit(1).alias("what"), empty.cast("long").alias("first"), "url", "html", empty.cast("binary").alias("digest"), F.unhex(F.sha2("html", 256)).alias("of")).unionByName(
        refs.select("page_id", F.lit(0).alias("what"), "first", empty.cast("string").alias("url"), empty.cast("string").alias("html"), "digest", F.col("digest").alias("of"))
    )
    apart = F.lit(named) + F.pmod(F.xxhash64("of"), F.lit(max(1, rest))).cast("int")
    both = both.withColumn("shard", F.when(F.col("page_id").isNull(), apart).otherwise(shard_of(F.coalesce("page_id", F.lit(0))))).drop("of")
    dealt = both.repartitionById(named + rest, "shard").sortWithinPartitions("shard", F.col("page_id").asc_nulls_last(), "what", "url", "html")

    def write(batches):
        context = TaskContext.get()
        attempt = f"{context.partitionId()}-{context.taskAttemptId()}"
        where, root = file_system(folder)
        where.create_dir(root, recursive=True)
        out, state, now = None, {}, None
        refs_of: dict[bytes, int] = {}
        page, seen = object(), {}  # how often the page at hand had a payload

        def finish():
            nonlocal out
            if out is None:
                return None
            out.close()
            out = None
            return (state["final"], state["name"], state["records"], state["bytes"], state["sha"].hexdigest())

        done = []
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "what", "first", "url", "html", "digest", "shard")]
            for k in range(batch.num_rows):
                page_id, what, first, url, html, digest, shard_no = (c[k].as_py() for c in columns)
                if shard_no != now:
                    if (f := finish()) is not None:
                        done.append(f)
                    now, number = shard_no, 0
                if page_id != page:
                    page, seen, refs_of = page_id, {}, {}
                if what == 0:
                    refs_of[digest] = first
                    continue
                payload = html.encode()
                sha = hashlib.sha256(payload)
                first = refs_of.get(sha.digest())
                nth = seen.get(sha.digest(), 0)
                seen[sha.digest()] = nth + 1
                target = first if first is not None and (first != page_id or nth > 0) else None
                if out is not None and state["bytes"] >= roll:
                    done.append(finish())
                    number += 1
                if out is None:
                    final = f"shard-{shard_no:07d}-{number:05d}.warc.gz"
                    state = {"final": final, "name": f"_writing-{attempt}-{final}", "records": 0, "bytes": 0, "sha": hashlib.sha256()}
                    out = where.open_output_stream(f"{root}/{state['name']}", compression=None)
                squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = squeeze.compress(record(page_id, url, payload, target, sha.hexdigest(), nth)) + squeeze.flush()
                out.write(data)
                state["sha"].update(data)
                state["records"] += 1
                state["bytes"] += len(data)
        if (f := finish()) is not None:
            done.append(f)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*done, strict=True)], ["final", "written", "records", "bytes", "sha256"])

    return _commit(staged(dealt.mapInArrow(write, FILES), "files"), folder)


def _hadoop(spark: SparkSession, folder: str):
    """Hadoop's class of paths, and the file system of a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path, path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _commit(files: DataFrame, folder: str) -> DataFrame:
    """Give the listed files their final names, in tasks, and publish the list as the manifest."""

    def publish(batches):
        where, root = file_system(folder)
        for batch in batches:
            for written, final, sha in zip(*[batch.column(x).to_pylist() for x in ("written", "final", "sha256")], strict=True):
                there = [x.type != fs.FileType.NotFound for x in where.get_file_info([f"{root}/{written}", f"{root}/{final}"])]
                if there[0]:
                    if there[1]:  # left by a run that ended before its manifest
                        where.delete_file(f"{root}/{final}")
                    where.move(f"{root}/{written}", f"{root}/{final}")
                elif not there[1] or file_digest(where, f"{root}/{final}") != sha:  # else an earlier try of this task renamed it
                    raise OSError(f"{written} is gone, and {final} isn't the same file")
            yield batch.select(["final", "records", "bytes", "sha256"])

    spark = files.sparkSession
    spread = files.repartition(max(1, min(files.count(), 1 << 14)))
    path, where = _hadoop(spark, folder)
    spread.mapInArrow(publish, "final string, records long, bytes long, sha256 string").write.mode("overwrite").parquet(f"{folder}/_{MANIFEST}")
    if not where.rename(path(f"{folder}/_{MANIFEST}"), path(f"{folder}/{MANIFEST}")):
        raise OSError(f"{folder} has a manifest already")
    for left in where.globStatus(path(f"{folder}/_writing-*")):  # of attempts that failed
        where.delete(left.getPath(), False)
    return spark.read.parquet(f"{folder}/{MANIFEST}")


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to. A response's payload is read and its digest
    taken anew; a revisit tells its payload's size and digest in its headers. Files are streamed, a record at a time."""
    types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}

    def read(batches):
        where, root = file_system(folder)
        for batch in batches:
            for final, sha in zip(batch.column("final").to_pylist(), batch.column("sha256").to_pylist(), strict=True):
                rows = []
                with where.open_input_stream(f"{root}/{final}", compression=None) as stream:
                    digested = Digested(stream)
                    for headers, block in read_records(digested):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        told = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                        size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
                        kind = headers["WARC-Type"]
                        digest = told if kind == "revisit" else hashlib.sha256(payload).hexdigest()
                        if digest != told or (kind == "response" and len(payload) != size):
                            raise ValueError("a payload doesn't match its record's headers")
                        page, first = headers.get("Page-Number"), headers.get("Refers-To-Page-Number")
                        rows.append((page and int(page), size, digest, kind, first and int(first)))
                if digested.sha.hexdigest() != sha:
                    raise ValueError(f"{final} doesn't match its digest in the manifest")
                columns = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], list(types))

    spread = manifest.select("final", "sha256").repartition(max(1, min(manifest.count(), 1 << 16)))
    return spread.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    return read_archives(spark, folder, write_archives(table(spark, sf_dir, "pages"), folder))


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM f
"""
