import os

import duckdb
import pytest

from guildbook.llm import op2_warc as op
from guildbook.llm.common import new_folder


def write(spark, rows, **sizes):
    folder = new_folder(spark, "warc-test")
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, first int")
    manifest = op.write_archives(df, folder, **sizes)
    got = sorted(map(tuple, op.read_archives(spark, folder, manifest).collect()), key=str)
    return folder, sorted(map(tuple, manifest.collect())), got


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf}/pages.parquet'")
    want = sorted(con.execute(op.SQL).fetchall(), key=str)
    assert sorted(map(tuple, op.op2_warc(spark, sf).collect()), key=str) == want


def test_rolls_and_is_deterministic(spark):
    long = "<p>é</p>" * 50
    rows = [(i, f"http://x/{i}", long + str(i % 40), "d", 1) for i in range(300)]
    _, first, got = write(spark, rows, shard=20_000, roll=3_000)
    _, second, again = write(spark, rows[::-1], shard=20_000, roll=3_000)
    assert first == second and got == again
    assert len(first) > 8 and sum(f[1] for f in first) == 300
    assert {r[0]: (r[3], r[4]) for r in got} == {i: ("response", None) if i < 40 else ("revisit", i % 40) for i in range(300)}


def test_defined_cases(spark):
    long = "y" * 200
    rows = [(1, None, None, "d", 1), (2, "u", "", "d", 1), (3, "u", "short", "d", 1), (4, "u", "short", "d", 1), (5, "u", long, "d", 1), (5, "u", long, "d", 1), (6, "u\r\nX: 1", long, "d", 1), (None, "u", "no id", "d", 1), (5, "a", "z" * 300, "d", 1)]
    _, _, got = write(spark, rows)
    assert sorted((r[:2] + r[3:] for r in got), key=str) == sorted(
        [
            (1, 0, "response", None), (2, 0, "response", None), (3, 5, "response", None), (4, 5, "response", None), (None, 5, "response", None),
            (5, 200, "response", None), (5, 200, "revisit", 5), (5, 300, "response", None), (6, 200, "revisit", 5),
        ],
        key=str,
    )
    assert len(got) == len(rows)


def test_empty(spark):
    assert write(spark, [])[1:] == ([], [])


def test_pages_without_id_and_clustered_ids(spark):
    """Nameless pages fill several shards; ids far apart and close together are cut into shards of about one size."""
    rows = [(None, "u", f"page {i} " * 40, "d", 1) for i in range(200)] + [(None, "u", "same " * 40, "d", 1)] * 3
    rows += [(10**15 + i, "u", f"text {i} " * 40, "d", 1) for i in range(200)] + [(i, "u", f"word {i} " * 40, "d", 1) for i in range(200)]
    _, files, got = write(spark, rows, shard=20_000, roll=10**9)
    assert len(got) == len(rows) and all(r[3] == "response" for r in got)
    assert len(files) > 10 and max(f[1] for f in files) < 120
    shards = spark.createDataFrame([(10**15 + i, 400) for i in range(200)] + [(i, 400) for i in range(200)], "page_id long, bytes long")
    assert op.shard_bounds(shards, 20_000).tolist() == [50, 100, 150, *(10**15 + k for k in (0, 50, 100, 150))]
    assert op.shard_bounds(shards.repartition(7), 20_000).tolist() == op.shard_bounds(shards, 20_000).tolist()


def left_over(folder):
    """As a run leaves a folder that ends after its renames: final files, a manifest under its unfinished name."""
    os.rename(f"{folder}/{op.MANIFEST}", f"{folder}/_{op.MANIFEST}")


def test_files_of_an_ended_run_are_replaced(spark):
    schema = "page_id long, url string, html string"
    first = spark.createDataFrame([(1, "u", "a" * 150), (2, "u", "b" * 151)], schema)
    second = spark.createDataFrame([(1, "u", "c" * 200), (2, "u", "d" * 201)], schema)
    folder = new_folder(spark, "warc-test")
    op.write_archives(first, folder)
    left_over(folder.removeprefix("file://"))
    manifest = op.write_archives(second, folder)
    assert sorted(r["payload_bytes"] for r in op.read_archives(spark, folder, manifest).collect()) == [200, 201]
    with pytest.raises(FileExistsError):
        op.write_archives(first, folder)


def test_a_file_that_the_manifest_does_not_name_fails(spark):
    schema = "page_id long, url string, html string"
    folder, other = new_folder(spark, "warc-test"), new_folder(spark, "warc-test")
    manifest = op.write_archives(spark.createDataFrame([(1, "u", "a" * 150)], schema), folder)
    name = op.write_archives(spark.createDataFrame([(1, "u", "b" * 150)], schema), other).first()["final"]
    os.replace(f"{other.removeprefix('file://')}/{name}", f"{folder.removeprefix('file://')}/{name}")
    with pytest.raises(Exception, match="doesn't match its digest in the manifest"):
        op.read_archives(spark, folder, manifest).collect()
