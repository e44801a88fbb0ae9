"""Removal of repeated passages through a compressed FM-index per shard.

A window of WIDTH words that also starts earlier (smaller doc_id, or earlier in the same document) goes. Equal windows must
meet in one shard, so shards are made by content: each window is anchored at its least-hashed GRAM words, which are the same
wherever the window stands. Anchors that occur once can't belong to a repeated window and drop out, with most of the text.
Neighbouring windows with one anchor form a passage. Equal passages fall together before anything else (all but the first
are repeats as they are). The distinct passages of a shard are indexed: their words' Burrows-Wheeler transform in a wavelet
tree. Every passage is then streamed through its shard's index by backward search, which gives the range of each window of
full width; windows whose range holds an earlier start (the least one in the range decides) are reported, and go.

Identical texts are set apart by digest at the start: the first one stays in the search, the others are repeats as a whole.
An anchor with very many distinct passages (a common phrase in many contexts) is split into its single windows. Equal ones fall
together by digest in a partial aggregate, and all but the first are repeats; as no other anchor has such windows, nothing is left
to search for. All joins on hot keys are between written tables, so that Spark can split them.

Defined cases: null and empty texts have no words; texts shorter than a window stay; every row gives one row, and repeated
rows (same doc_id and text) are one document; null doc_id comes before all others; of different texts under one doc_id the
order is by start, then a hash of the text; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guildbook.llm.common import same, staged, table, unused
from guildbook.llm.fm_index import FMIndex
from guildbook.llm.words import Words, slices, texts_of, windows

WIDTH, GRAM = 20, 10
#: Words in a shard on average, the least number of shards, and the distinct passages beyond which an anchor is split.
PER_SHARD, LEAST, HOT = 150_000, 64, 256
NO_ID = -(1 << 63)


def anchors_of(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First words of all windows, the place of each one's anchor, and the hashes of all grams and of all windows."""
    h = w.hashes(apart=True)
    grams, wide = windows(h, GRAM), windows(h, WIDTH)
    start = np.flatnonzero(w.doc[: len(wide)] == w.doc[WIDTH - 1 :][: len(wide)]) if len(wide) else np.zeros(0, np.int64)
    if not len(start):
        return start, start, grams, wide
    choice = np.lib.stride_tricks.sliding_window_view(grams, WIDTH - GRAM + 1)
    return start, start + choice[start].argmin(axis=1), grams, wide


def mark(text: Column) -> Column:
    """The hash of a text's digest, as describe() has it."""
    return F.xxhash64(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)))


def describe(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, digest of the text, n_words, digest of the words, and the anchors with their places."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                texts = texts_of(part)
                w = Words(texts)
                _, at, grams, _ = anchors_of(w)
                at = np.unique(at)
                doc = w.doc[at]
                offsets = pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                        pa.array(np.diff(w.first).astype(np.int64)),
                        pa.array([hashlib.sha256(b" ".join(t.split())).hexdigest() for t in texts]),
                        pa.ListArray.from_arrays(offsets, pa.array(grams[at].view(np.int64) if len(at) else np.zeros(0, np.int64))),
                        pa.ListArray.from_arrays(offsets, pa.array((at - w.first[doc]).astype(np.int32))),
                    ],
                    ["doc_id", "digest", "n_words", "words_sha256", "anchors", "places"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, digest binary, n_words long, words_sha256 string, anchors array<long>, places array<int>")


def passages(docs: DataFrame) -> DataFrame:
    """Runs of windows with one repeated anchor. docs: doc_id, mark, text and places, the places of repeated anchors."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                texts = texts_of(part)
                w = Words(texts)
                start, at, grams, wide = anchors_of(w)
                wanted = np.zeros(len(w.begin) + 1, bool)
                for k, places in enumerate(part.column("places").to_pylist()):
                    wanted[np.array(places, np.int64) + w.first[k]] = True
                cut = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1))) if len(at) else at
                last = np.append(cut[1:], len(at)) - 1
                keep = wanted[at[cut]] if len(cut) else np.zeros(0, bool)
                cut, last = cut[keep], last[keep]
                a, b = start[cut], start[last]  # first words of a passage's first and last windows
                # Two hashes that tell passages apart: of the first and last windows with the length, and of all windows.
                total = np.concatenate([[np.uint64(0)], np.cumsum(wide, dtype=np.uint64)])
                ends = wide[a] + np.uint64(31) * wide[b] + (b - a).astype(np.uint64) if len(a) else np.zeros(0, np.uint64)
                sums = total[b + 1] - total[a] if len(a) else np.zeros(0, np.uint64)
                doc = w.doc[a]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(doc)),
                        part.column("mark").take(pa.array(doc)),
                        pa.array(grams[at[cut]].view(np.int64) if len(a) else np.zeros(0, np.int64)),
                        pa.array(ends.view(np.int64)),
                        pa.array(sums.view(np.int64)),
                        pa.array((a - w.first[doc]).astype(np.int64)),
                        pa.array((b - a + WIDTH).astype(np.int64)),
                        pa.array([b" ".join(w.buf[w.begin[i] : w.end[j + WIDTH - 1]].tobytes().split()).decode() for i, j in zip(a.tolist(), b.tolist(), strict=True)], pa.string()),
                    ],
                    ["doc_id", "mark", "anchor", "h1", "h2", "start", "n", "words"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {id_type}, mark long, anchor long, h1 long, h2 long, start long, n long, words string")


def search(passages: pa.Table) -> pa.Table:
    """The repeats that one shard's passages hold: doc_id, mark, begin and end (in words) of windows that start earlier elsewhere.
    Words are numbered by their bytes; doc_ids stay in Arrow, as they would not survive as floats beside a null."""
    texts = [t.encode() for t in passages.column("words").to_pylist()]
    w = Words(texts)
    words = pa.array(b" ".join(texts).split(), pa.binary()).dictionary_encode()
    known, symbol = words.dictionary, words.indices.to_numpy().astype(np.int64)
    length = np.diff(w.first)
    begin = w.first[:-1] + np.arange(len(length))  # a 0 behind each passage
    text = np.zeros(len(symbol) + len(length), np.int64)
    text[np.arange(len(symbol)) + w.doc] = symbol + 1
    # Order of all places: by document, start, mark.
    passage = np.repeat(np.arange(len(length)), length + 1)
    inside = np.arange(len(text)) - begin[passage]
    marks, first = passages.column("mark").to_numpy(), passages.column("start").to_numpy()
    ids = pc.fill_null(passages.column("doc_id").cast(pa.int64()), NO_ID).to_numpy()
    order = np.lexsort((marks[passage], first[passage] + inside, ids[passage]))
    turn = np.empty(len(text), np.int64)
    turn[order] = np.arange(len(text))
    index = FMIndex(text, len(known) + 1, WIDTH, turn)
    # Every window of every passage is looked up by backward search; the least turn in its range tells whether it starts earlier.
    which, place, low, high = (np.concatenate(x) for x in zip((np.zeros(0, np.int64),) * 4, *index.windows(text, begin, length), strict=True))
    late = index.least(low, high) < turn[place]
    which, offset = which[late], inside[place[late]]
    at = np.lexsort((offset, which))
    which, offset = which[at], offset[at]
    cut = np.flatnonzero(np.append(True, (which[1:] != which[:-1]) | (offset[1:] != offset[:-1] + 1))) if len(which) else which
    last = np.append(cut[1:], len(which)) - 1 if len(which) else which
    rows = which[cut]
    return pa.table({"doc_id": passages.column("doc_id").take(pa.array(rows)), "mark": marks[rows], "begin": first[rows] + offset[cut], "end": first[rows] + offset[last] + WIDTH})


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of docs (doc_id, text): the description of every row; (doc_id, mark) of rows that repeat an earlier text as a whole;
    and (doc_id, mark, spans) of the others that lose words, spans being (begin, end) in words. A mark is a hash of the text,
    which tells the texts of one doc_id apart in eight bytes."""
    base = staged(describe(docs).withColumn("mark", F.xxhash64("digest")), "described")
    texts = staged(base.groupBy("digest").agg(F.min(F.struct("doc_id")).alias("first"), F.count("*").alias("n")).filter("n > 1").select(F.col("digest").alias("same"), F.col("first.doc_id").alias("first_id")), "texts")
    copies = staged(base.join(texts, base["digest"] == texts["same"]).filter(~F.col("doc_id").eqNullSafe(F.col("first_id"))).select("doc_id", "mark").distinct(), "copies")

    flat = base.select("doc_id", "mark", F.explode(F.arrays_zip("anchors", "places")).alias("x")).select("doc_id", "mark", F.col("x.anchors").alias("anchor"), F.col("x.places").alias("place"))
    twice = staged(flat.groupBy("anchor").count().filter("count > 1").select("anchor"), "anchors")
    hits = staged(flat.join(twice, "anchor").groupBy("doc_id", "mark").agg(F.collect_list("place").alias("places")), "hits")
    hits = hits.join(copies, same((hits["doc_id"], copies["doc_id"]), (hits["mark"], copies["mark"])), "left_anti")
    hits = staged(hits.select(F.col("doc_id").alias("hit_id"), F.col("mark").alias("hit"), "places"), "hits")
    keyed = docs.select("doc_id", "text").withColumn("mark", mark(F.col("text")))
    held = keyed.join(hits.hint("shuffle_hash"), same((keyed["doc_id"], hits["hit_id"]), (keyed["mark"], hits["hit"]))).select("doc_id", "mark", "text", "places")
    found = staged(passages(held), "passages")

    firsts = found.groupBy("anchor", "h1", "h2", "n").agg(F.min(F.struct("doc_id", "start", "mark")).alias("first"), F.max("words").alias("words"))
    firsts = staged(firsts.select("anchor", "h1", "h2", "n", "first.doc_id", "first.start", "first.mark", "words"), "firsts")
    f = firsts.select(F.col("h1").alias("f1"), F.col("h2").alias("f2"), F.col("n").alias("fn"), F.col("anchor").alias("fa"), F.col("doc_id").alias("f_id"), F.col("start").alias("f_start"), F.col("mark").alias("f_mark"))
    o = found.select("doc_id", "mark", "anchor", "h1", "h2", "n", "start")
    later = o.join(f, (o["anchor"] == f["fa"]) & (o["h1"] == f["f1"]) & (o["h2"] == f["f2"]) & (o["n"] == f["fn"]))
    later = later.filter(~same((F.col("doc_id"), F.col("f_id")), (F.col("start"), F.col("f_start")), (F.col("mark"), F.col("f_mark"))))
    later = later.select("doc_id", "mark", F.col("start").alias("begin"), (F.col("start") + F.col("n")).alias("end"))

    shards = max(LEAST, -(-int(firsts.agg(F.sum("n")).first()[0] or 0) // PER_SHARD))
    hot = staged(firsts.groupBy("anchor").count().filter(F.col("count") > HOT).select("anchor", F.lit(True).alias("hot")), "hot")
    split = firsts.join(hot, "anchor", "left")
    dealt = split.filter("hot is null").select("doc_id", "mark", "start", "words", F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"))
    single = split.filter("hot").select("doc_id", "mark", "start", F.split("words", " ").alias("w"), F.explode(F.sequence(F.lit(0), F.col("n") - WIDTH)).alias("o"))
    window = F.unhex(F.md5(F.array_join(F.slice("w", F.col("o").cast("int") + 1, WIDTH), " ")))
    single = staged(single.select("doc_id", "mark", (F.col("start") + F.col("o")).alias("start"), window.alias("window")), "windows")
    heads = single.groupBy("window").agg(F.min(F.struct("doc_id", "start", "mark")).alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    heads = staged(heads.select(F.col("window").alias("same"), F.col("first.doc_id").alias("f_id"), F.col("first.start").alias("f_start"), F.col("first.mark").alias("f_mark")), "heads")
    again = single.join(heads, single["window"] == heads["same"])
    again = again.filter(~same((F.col("doc_id"), F.col("f_id")), (F.col("start"), F.col("f_start")), (F.col("mark"), F.col("f_mark"))))
    again = again.select("doc_id", "mark", F.col("start").alias("begin"), (F.col("start") + WIDTH).alias("end"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    inside = dealt.groupBy("shard").applyInArrow(search, f"doc_id {id_type}, mark long, begin long, end long")
    lost = later.unionByName(again).unionByName(inside).groupBy("doc_id", "mark").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    return base, copies, staged(lost, "lost")


def _mask(n: int, spans: list[dict]) -> np.ndarray:
    """Which of n words stay."""
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, [s["begin"] for s in spans], 1)
    np.add.at(cover, [s["end"] for s in spans], -1)
    return np.cumsum(cover[:-1]) == 0


def _with_spans(docs: DataFrame, lost: DataFrame, how: str) -> tuple[DataFrame, str]:
    """docs with the spans that each row loses, and the name of their column."""
    m, i, l, spans = unused(docs.columns, "_mark", "_id", "_lost", "_spans")
    keyed = docs.withColumn(m, mark(F.col("text")))
    lost = lost.select(F.col("doc_id").alias(i), F.col("mark").alias(l), F.col("spans").alias(spans))
    return keyed.join(lost.hint("shuffle_hash"), same((keyed["doc_id"], lost[i]), (keyed[m], lost[l])), how).select(*docs.columns, spans), spans


def counted(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_removed, kept_sha256."""
    base, copies, lost = repeats(docs)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(texts_of(batch), batch.column("_spans").to_pylist(), strict=True):
                words = text.split()
                stay = _mask(len(words), spans)
                rows.append((len(words), len(words) - int(stay.sum()), hashlib.sha256(b" ".join([x for x, k in zip(words, stay.tolist(), strict=True) if k])).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    part = _with_spans(docs.select("doc_id", "text"), lost, "inner")[0].mapInArrow(run, f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string")
    marks = copies.withColumn("copy", F.lit(True)).unionByName(lost.select("doc_id", "mark", F.lit(False).alias("copy")))
    marks = marks.select(F.col("doc_id").alias("m_id"), F.col("mark").alias("m_mark"), "copy")
    rest = base.select("doc_id", "mark", "n_words", "words_sha256")
    rest = rest.join(marks, same((rest["doc_id"], marks["m_id"]), (rest["mark"], marks["m_mark"])), "left").filter("copy is null or copy")
    gone = F.col("copy").isNotNull() & (F.col("n_words") >= WIDTH)
    whole = rest.select(
        "doc_id", "n_words", F.when(gone, F.col("n_words")).otherwise(F.lit(0)).cast("long").alias("n_removed"), F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.col("words_sha256")).alias("kept_sha256")
    )
    return whole.unionByName(part)


def drop_repeats(docs: DataFrame) -> DataFrame:
    """docs with repeated windows cut out of text, white space between kept words as it was; whole copies get an empty text."""
    _, copies, lost = repeats(docs)
    spans = lost.unionByName(copies.select("doc_id", "mark", F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.lit(-1).cast("long").alias("end"))).alias("spans")))
    columns = docs.columns
    place = columns.index("text")

    def cut(text: str | None, spans: list[dict] | None) -> str | None:
        if not spans or text is None:
            return text
        w = Words([text.encode()])
        n = len(w.begin)
        if spans[0]["end"] < 0:
            return "" if n >= WIDTH else text
        stay = _mask(n, spans)
        if stay.all():
            return text
        buf, out, at = w.buf.tobytes()[:-1], [], 0
        edges = np.flatnonzero(np.diff(np.concatenate([[True], stay, [True]]).astype(np.int8)))
        for a, b in edges.reshape(-1, 2).tolist():  # words a to b go, with the white space behind them
            out.append(buf[at : w.begin[a]])
            at = int(w.begin[b]) if b < n else len(buf)
        out.append(buf[at:])
        return b"".join(out).decode().rstrip(" ") if at == len(buf) else b"".join(out).decode()

    def run(batches):
        for batch in batches:
            texts = [cut(t, s) for t, s in zip(batch.column("text").to_pylist(), batch.column(name).to_pylist(), strict=True)]
            arrays = [batch.column(c) for c in columns]
            arrays[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, columns)

    held, name = _with_spans(docs, spans, "left")
    return held.mapInArrow(run, docs.schema)


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(table(spark, sf_dir, "documents"))


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(generate_series(1, len(ws) - 19)) AS s, ws FROM w WHERE len(ws) >= 20),
k AS (SELECT doc_id, s, array_to_string(list_slice(ws, s, s + 19), ' ') AS win FROM p),
r AS (SELECT doc_id, s, row_number() OVER (PARTITION BY win ORDER BY doc_id, s) AS nth FROM k),
c AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + 19)) AS i FROM r WHERE nth > 1),
t AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS i FROM w),
g AS (SELECT t.doc_id, count(*) AS n_removed FROM t JOIN c USING (doc_id, i) GROUP BY t.doc_id),
kept AS (SELECT t.doc_id, string_agg(t.word, ' ' ORDER BY t.i) AS kept FROM t ANTI JOIN c USING (doc_id, i) GROUP BY t.doc_id)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(g.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
