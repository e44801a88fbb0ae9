"""Removal of repeated byte strings through suffix arrays, by interval expansion bounded by a threshold.

A byte goes if it lies in a string of WIDTH bytes that also starts in a document with a smaller doc_id. Equal strings must meet, so they
are routed by content: the anchor of a window is the least hash of its grams of GRAM bytes, whatever stands around it. Anchors that one
document alone has can't belong to a repeat and drop out, with most of the text. Neighbouring windows with one anchor form a passage. Of equal
texts only the least doc_id's gets so far; the others lose all bytes, if they have a window.
Where all passages of an anchor are equal, the least doc_id keeps its bytes and the others lose them; of equal passages otherwise, the
first one stays for the others too. The distinct passages of a shard's anchors then make one text, whose suffixes are sorted to 64 bytes
for its Burrows-Wheeler transform. From the intervals of strings of 16 bytes, breadth first, those of all longer strings follow by backward
extension; the right end of each new one is a place where the common prefix of two neighbours has just this length. So the common
prefixes appear by increasing value, and expansion stops at WIDTH: neighbours that are still together then share WIDTH bytes, and in each
such group all but the least doc_id go.

An anchor with more than HOT distinct passages (a common phrase in many contexts) would make a shard too large. Its passages are cut by
the anchors of their windows once more, now of LONG bytes: such a string has far fewer contexts, and most belong to one document
and drop out. Where all pieces of such an anchor are equal, they are judged as passages are; the others are cut into their single
windows, of which equal ones fall together by digest. So the common phrases of a larger corpus, which are more, cost little more. What
a passage loses, all equal ones of the same doc_id lose too. Texts meet their anchors, passages and spans by joins, which Spark
can split where a key is hot.

Defined cases: null and empty texts have no bytes; texts shorter than WIDTH stay; every row gives one row; rows with one doc_id don't count
as repeats of each other; null doc_id (and -2^63) comes before all others; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guildbook.llm.common import discard, staged, table
from guildbook.llm.words import mix, slices, texts_of

WIDTH, GRAM, LONG = 50, 20, 40
#: Windows in a passage at most, bytes in a shard on average, the least number of shards, distinct passages beyond which an anchor is cut.
RUN, PER_SHARD, LEAST, HOT = 128, 250_000, 64, 2048
#: Bytes of text in a block of documents on average, and bytes of text to a share of the anchors (which has about one for 16 bytes).
PER_BLOCK, PER_SHARE = 4_000_000, 16_000_000
#: Bytes that are looked at together, few enough for a core's cache, and anchors of a block that are held before equal ones fall together.
STEP, HELD = 1 << 18, 1 << 20
NO_ID = -(1 << 63)
#: In the place of a span: all bytes.
ALL = -1
#: Ends a passage; no byte of UTF-8 has this value.
END = 255

_RANDOM = np.random.Generator(np.random.PCG64(50_20))
_OF_BYTE = _RANDOM.integers(0, 2**64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15


def _grams(of_byte: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n neighbouring bytes, from those of half as many."""
    if n == 1:
        return of_byte
    half = _grams(of_byte, n // 2)
    k = n // 2
    out = half[:-k] * np.uint64(pow(_BASE, k, 1 << 64)) + half[k:]
    return out if n % 2 == 0 else out[:-1] * np.uint64(_BASE) + of_byte[n - 1 :][: len(out) - 1]


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """The least of each n neighbouring values."""
    size, out = 1, values
    while 2 * size <= n:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[: len(out) - (n - size)], out[n - size :]) if n > size else out


def runs(texts: list[bytes], gram: int = GRAM) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of neighbouring windows with one anchor: which text, first window, number of windows, anchor. A long text is looked at in
    parts that overlap by a window, so that memory doesn't grow with it; where they begin depends on the text alone."""
    held, size = [], 0
    for doc, text in enumerate(texts):
        for offset in range(0, len(text) - WIDTH + 1, STEP):
            part = text[offset : offset + STEP + WIDTH - 1]
            held.append((doc, offset, part))
            size += len(part)
            if size >= STEP:
                yield _runs(held, gram)
                held, size = [], 0
    if held:
        yield _runs(held, gram)


def _runs(parts: list[tuple[int, int, bytes]], gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    buf = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
    lengths = np.fromiter((len(p[2]) for p in parts), np.int64, len(parts))
    begin = np.cumsum(lengths) - lengths
    anchors = _least(_grams(_OF_BYTE[buf], gram), WIDTH - gram + 1)
    new = np.append(True, anchors[1:] != anchors[:-1])
    new[begin] = True  # no part is shorter than a window
    count = lengths - WIDTH + 1
    stop = begin + count  # windows from here to the next part lie in two parts
    new[stop[:-1]] = True
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(anchors)))
    part = np.searchsorted(begin, first, "right") - 1
    inside = first < stop[part]
    first, n, part = first[inside], n[inside], part[inside]
    if n.max(initial=0) > RUN:
        times = -(-n // RUN)
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        first, part, n = np.repeat(first, times) + nth * RUN, np.repeat(part, times), np.minimum(np.repeat(n, times) - nth * RUN, RUN)
    doc, offset = (np.fromiter((p[k] for p in parts), np.int64, len(parts)) for k in (0, 1))
    return doc[part], first - begin[part] + offset[part], n, mix(anchors[first])


def keyed(docs: DataFrame) -> DataFrame:
    """(ord, mark, twin, text): ord is doc_id with null as the least; mark, from a digest, tells the texts of one doc_id apart, and with twin
    all texts."""
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("ord"), F.xxhash64(digest).alias("mark"), F.xxhash64(F.lit(1), digest).alias("twin"), "text")


def copies_of(names: DataFrame) -> DataFrame:
    """(ord, mark) of the texts that are whole copies of one with a smaller ord."""
    least = names.groupBy("mark", "twin").agg(F.min("ord").alias("low"), F.max("ord").alias("high")).filter("low < high").select("mark", "twin", "low")
    return staged(names.join(least, ["mark", "twin"]).filter("ord > low").select("ord", "mark").distinct(), "copies")


def _longs(*columns: np.ndarray) -> list[pa.Array]:
    return [pa.array(c.astype(np.int64, copy=False)) for c in columns]


def digests(strings: list[bytes]) -> np.ndarray:
    """A digest of each string, as two longs."""
    return np.frombuffer(b"".join([hashlib.blake2b(x, digest_size=16).digest() for x in strings]), np.int64).reshape(-1, 2)


def merged(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors in order, each once, with the least and the greatest ord."""
    anchor, low, high = (np.concatenate(c) for c in zip(*rows, strict=True))
    order = np.argsort(anchor)
    anchor = anchor[order]
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    return anchor[first], np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)


def by_block(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Parts of a batch of one block each; rows of a block lie together."""
    for part in slices(batch):
        block = part.column("block").to_numpy()
        begin = np.flatnonzero(np.append(True, block[1:] != block[:-1])).tolist()
        for a, b in zip(begin, [*begin[1:], len(block)], strict=True):
            yield int(block[a]), part.slice(a, b - a)


def lists(anchors: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Neighbouring parts of an array as one binary value each; ends: where each begins, and the end of the last."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * 8).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(anchors))])


def without(part: pa.RecordBatch, copies: set[tuple[int, int]]) -> pa.RecordBatch:
    """Rows of a block that have a text and are no copy; the names of copies are rows without text, which come first."""
    name = list(zip(part.column("ord").to_pylist(), part.column("mark").to_pylist(), strict=True))
    plain = part.column("text").is_valid().to_pylist()
    copies.update(n for n, p in zip(name, plain, strict=True) if not p)
    return part.filter(pa.array([p and n not in copies for n, p in zip(name, plain, strict=True)], pa.bool_()))


def repeated_anchors(docs: DataFrame, shares: int) -> DataFrame:
    """(block, anchors): for each block of docs, in lists of 8 bytes each, its anchors that several documents have. Rows of one doc_id that
    lie in different blocks count as several. A block sends each of its anchors once to the share of the anchor, and twice if two of its
    documents have it; what a share gets twice is repeated."""

    def sent(block, rows):
        anchor, low, high = rows
        times = 1 + (low < high)
        share = ((anchor >> np.uint64(32)) * np.uint64(shares)) >> np.uint64(32)
        ends = np.append(0, np.cumsum(times))[np.searchsorted(share, np.arange(shares + 1, dtype=np.uint64))]
        some = np.flatnonzero(ends[1:] > ends[:-1])
        found = lists(np.repeat(anchor, times), ends).take(pa.array(some))
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(np.full(len(some), block), pa.int32()), found], ["share", "block", "anchors"])

    def deal(batches):
        now, rows, copies, held = None, [], set(), 0
        for batch in batches:
            for block, part in by_block(batch):
                if block != now:
                    if rows:
                        yield sent(now, merged(rows))
                    now, rows, copies, held = block, [], set(), 0
                part = without(part, copies)
                ords = part.column("ord").to_numpy()
                for doc, _, _, anchor in runs(texts_of(part)):
                    rows.append((anchor, ords[doc], ords[doc]))
                    held += len(anchor)
                    if held > HELD:
                        rows, held = [merged(rows)], 0
        if rows:
            yield sent(now, merged(rows))

    def again(share: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint64) for x in share.column("anchors").to_pylist()]
        every = np.concatenate(parts)
        order = np.sort(every)
        twice = order[1:][order[1:] == order[:-1]]
        at = np.minimum(np.searchsorted(twice, every), len(twice) - 1)
        keep = twice[at] == every if len(twice) else np.zeros(len(every), bool)
        ends = np.append(0, np.cumsum(keep))[np.append(0, np.cumsum([len(p) for p in parts]))]
        return pa.table({"block": share.column("block"), "anchors": lists(every[keep], ends)}).filter(pa.array(ends[1:] > ends[:-1]))

    found = docs.mapInArrow(deal, "share int, block int, anchors binary").groupBy("share").applyInArrow(again, "block int, anchors binary")
    return staged(found, "anchors")


def passages(docs: DataFrame, copies: DataFrame, size: int) -> DataFrame:
    """(anchor, k1, k2, ord, mark, span) of all passages whose anchor other documents have; k1 and k2 are a digest of the passage's bytes,
    and a span is its first byte times 256 and the number of its bytes. copies: (ord, mark) of texts to leave out; size: bytes of all texts.

    Documents are dealt to blocks by their key, and whole lists of anchors go from blocks to shares of all anchors and back."""
    blocks, shares = (max(LEAST, -(-size // n)) for n in (PER_BLOCK, PER_SHARE))
    docs = docs.filter(F.octet_length("text") >= WIDTH).select("ord", "mark", "text").unionByName(copies, allowMissingColumns=True)
    docs = docs.withColumn("block", F.pmod(F.xxhash64("ord", "mark"), F.lit(blocks)).cast("int"))
    first = F.col("text").isNotNull()
    anchors = repeated_anchors(docs.repartition("block").sortWithinPartitions("block", first), shares)

    def run(batches):
        now, lists, wanted, gone = None, [], None, set()
        for batch in batches:
            for block, part in by_block(batch):
                if block != now:
                    now, lists, wanted, gone = block, [], None, set()
                lists += [np.frombuffer(x, np.uint64) for x in part.column("anchors").drop_null().to_pylist()]
                part = without(part.filter(part.column("anchors").is_null()), gone)
                if not part.num_rows or not lists:
                    continue
                wanted = np.sort(np.concatenate(lists)) if wanted is None else wanted
                texts, ords, marks = texts_of(part), part.column("ord").to_numpy(), part.column("mark").to_numpy()
                for doc, first, n, anchor in runs(texts):
                    keep = wanted[np.minimum(np.searchsorted(wanted, anchor), len(wanted) - 1)] == anchor
                    doc, first, n, anchor = doc[keep], first[keep], n[keep] + WIDTH - 1, anchor[keep].view(np.int64)
                    pair = digests([texts[k][a : a + m] for k, a, m in zip(doc.tolist(), first.tolist(), n.tolist(), strict=True)])
                    yield pa.RecordBatch.from_arrays(_longs(anchor, pair[:, 0], pair[:, 1], ords[doc], marks[doc], first * 256 + n), ["anchor", "k1", "k2", "ord", "mark", "span"])

    # The lists and the copies of a block come before its texts.
    held = docs.unionByName(anchors, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", first)
    found = staged(held.mapInArrow(run, "anchor long, k1 long, k2 long, ord long, mark long, span long"), "passages")
    discard(anchors)
    return found


def eights(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number, with zeros after the end."""
    padded = np.append(text, np.zeros(8, np.uint8)).astype(np.uint64)
    key = np.zeros(len(text), np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : k + len(text)]
    return key


def suffixes(text: np.ndarray) -> np.ndarray:
    """The places of a text in the order of its suffixes' first 64 bytes, by doubling from the order of 8. What is alone with its bytes
    has its place and isn't sorted again."""
    n, key, step = len(text), eights(text), 8
    order = np.argsort(key)
    key = key[order]
    new = np.append(True, key[1:] != key[:-1])
    rank = np.zeros(n + 64, np.int64)  # from 1; what begins after the end has 0
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(1, n + 1), 0))
    tied = np.flatnonzero(~(new & np.append(new[1:], True)))
    while step < 64 and len(tied):
        places = order[tied]
        key = rank[places] * (n + 1) + rank[places + step]
        by = np.argsort(key)
        key, places = key[by], places[by]
        order[tied] = places  # a group's places are its ranks' own, as they come first in the key
        new = np.append(True, key[1:] != key[:-1])
        rank[places] = np.maximum.accumulate(np.where(new, tied + 1, 0))
        tied = tied[~(new & np.append(new[1:], True))]
        step *= 2
    return order


def apart(text: np.ndarray, order: np.ndarray, width: int) -> np.ndarray:
    """For each place in the order of suffixes whether its common prefix with the one before is shorter than width, which is 16 to 63.

    The intervals of strings of 16 bytes follow from the order. An interval is extended to the left by each byte of the transform in it:
    the first and the last place with that byte are the ends of the longer string's interval. An interval goes on if it gives its right
    end a value for the first time. Strings aren't extended by END: END can't be the left one of two neighbours that differ there, as
    it is the greatest byte."""
    n = len(text)
    bwt = text[order - 1]
    by_byte = np.argsort(bwt, kind="stable")
    to = np.empty(n, np.int64)  # where the suffix one byte longer is
    to[by_byte] = np.arange(n)
    same = bwt[by_byte[1:]] == bwt[by_byte[:-1]]
    before, after = np.full(n, -1), np.full(n, n)  # the nearest places with the same byte
    before[by_byte[1:][same]] = by_byte[:-1][same]
    after[by_byte[:-1][same]] = by_byte[1:][same]
    plain = bwt != END
    known = np.ones(n + 1, bool)
    key = np.append(eights(text), np.zeros(8, np.uint64))
    left, right = key[order], key[order + 8]
    known[1:n] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    ends = np.flatnonzero(known)
    low, high = ends[:-1], ends[1:]
    for _ in range(16, width):
        size = high - low
        alone = low[size == 1]  # its only byte extends it
        alone = to[alone[plain[alone]]]
        low, high, size = low[size > 1], high[size > 1], size[size > 1]
        at = np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)
        keep = plain[at]
        at, begin, end = at[keep], np.repeat(low, size)[keep], np.repeat(high, size)[keep]
        # Intervals of strings of one length are apart, so their sorted ends belong together.
        low, high = np.sort(to[at[before[at] < begin]]), np.sort(to[at[after[at] >= end]]) + 1
        low, high = np.append(low, alone), np.append(high, alone + 1)
        new = ~known[high]
        low, high = low[new], high[new]
        known[high] = True
        if not len(low):
            break
    return known[:n]


def search(passages: pa.Table) -> pa.Table:
    """What passages (kind, ord, bytes) of one shard lose to those of smaller ord: kind, first byte and number of bytes."""
    texts = passages.column("bytes").to_pylist()
    kinds, ords = passages.column("kind").to_numpy(), passages.column("ord").to_numpy()
    text = np.frombuffer(b"".join([t + b"\xff" for t in texts]), np.uint8)
    length = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    begin = np.cumsum(length) - length
    order = suffixes(text)
    cut = np.flatnonzero(apart(text, order, WIDTH))
    passage = np.repeat(np.arange(len(texts)), length)
    inside = np.arange(len(text)) - begin[passage]
    whole = (inside + WIDTH < length[passage])[order]  # windows that don't reach beyond their passage
    turn = np.unique(ords, return_inverse=True)[1][passage][order]
    least = np.minimum.reduceat(np.where(whole, turn, len(texts)), cut)
    late = np.sort(order[whole & (turn > np.repeat(least, np.diff(np.append(cut, len(text)))))])
    new = np.flatnonzero(np.append(True, (late[1:] != late[:-1] + 1) | (passage[late[1:]] != passage[late[:-1]]))) if len(late) else late
    last = late[np.append(new[1:], len(late)) - 1] if len(late) else late
    return pa.table({"kind": kinds[passage[late[new]]], "at": inside[late[new]], "n": last - late[new] + WIDTH})


def lost_spans(docs: DataFrame) -> DataFrame:
    """(ord, mark, spans) of the keyed documents that lose bytes; the only span of a whole copy is ALL."""
    names = staged(docs.select("ord", "mark", "twin", F.octet_length("text").alias("n")).filter(F.col("n") >= WIDTH), "names")
    copies = copies_of(names)
    found = passages(docs, copies, int(names.agg(F.sum("n")).first()[0] or 0))
    groups = found.groupBy("anchor").agg(F.min("ord").alias("low"), *[f(k).alias(f"{n}_{k}") for k in ("k1", "k2") for f, n in ((F.min, "a"), (F.max, "b"))])
    groups = staged(groups.select("anchor", "low", ((F.col("a_k1") == F.col("b_k1")) & (F.col("a_k2") == F.col("b_k2"))).alias("pure")), "groups")
    pure = found.join(groups.filter("pure").select("anchor", "low"), "anchor").filter("ord > low").select("ord", "mark", "span")

    # Anchors with several kinds of passage: of equal ones the least doc_id's stands for all, and the kinds are looked at in shards.
    mixed = staged(found.join(groups.filter("not pure").select("anchor"), "anchor"), "mixed")
    kinds = mixed.groupBy("anchor", "k1", "k2").agg(F.min(F.struct("ord", "mark", "span")).alias("x")).select("anchor", "k1", "k2", "x.*")
    kinds = staged(kinds.withColumn("kind", F.monotonically_increasing_id()), "kinds")
    met = mixed.join(kinds.select("anchor", "k1", "k2", "kind", F.col("ord").alias("low")), ["anchor", "k1", "k2"])
    met = staged(met.select("kind", "ord", "mark", "span", (F.col("ord") > F.col("low")).alias("copy")), "met")
    discard(mixed)

    shards = max(LEAST, -(-int(kinds.agg(F.sum(F.col("span") % 256)).first()[0] or 0) // PER_SHARD))
    hot = kinds.groupBy("anchor").count().filter(F.col("count") > HOT).select("anchor", F.lit(True).alias("hot"))
    shard = F.when(F.col("hot"), -1).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(shards))).cast("int")
    sent = kinds.join(hot, "anchor", "left").select("ord", "mark", F.struct("kind", "span", shard.alias("shard")).alias("x"))
    sent = staged(sent.groupBy("ord", "mark").agg(F.collect_list("x").alias("wanted")), "wanted")
    discard(kinds)
    fields = [("shard", pa.int32()), ("anchor", pa.int64()), ("kind", pa.int64()), ("ord", pa.int64()), ("at", pa.int64()), ("bytes", pa.binary())]

    def rows(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True), fields, strict=True)], [n for n, _ in fields])

    def pieces(common):
        """Passages of common anchors (kind, ord, bytes) by the longer anchors of their windows."""
        texts = [x[2] for x in common]
        for doc, first, n, anchor in runs(texts, LONG):
            for d, a, m, x in zip(doc.tolist(), first.tolist(), (n + WIDTH - 1).tolist(), anchor.view(np.int64).tolist(), strict=True):
                yield -1, x, *common[d][:2], a, texts[d][a : a + m]

    def cut(batches):
        for batch in batches:
            out, common = [], []
            for o, text, wanted in zip(batch.column("ord").to_pylist(), texts_of(batch), batch.column("wanted").to_pylist(), strict=True):
                for x in wanted:
                    first, n = divmod(x["span"], 256)
                    if x["shard"] >= 0:
                        out.append((x["shard"], None, x["kind"], o, 0, text[first : first + n]))
                    else:
                        common.append((x["kind"], o, text[first : first + n]))
                if len(out) + len(common) > 20_000:
                    yield rows([*out, *pieces(common)])
                    out, common = [], []
            if out or common:
                yield rows([*out, *pieces(common)])

    def single(batches):
        for batch in batches:
            texts, (kind, o, at) = batch.column("bytes").to_pylist(), (batch.column(c).to_numpy() for c in ("kind", "ord", "at"))
            n = np.fromiter(map(len, texts), np.int64, len(texts)) - WIDTH + 1
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            pair = digests([t[a : a + WIDTH] for t, m in zip(texts, n.tolist(), strict=True) for a in range(m)])
            yield pa.RecordBatch.from_arrays(_longs(pair[:, 0], pair[:, 1], np.repeat(kind, n), np.repeat(o, n), np.repeat(at, n) + inside), ["k1", "k2", "kind", "ord", "at"])

    parts = docs.join(sent.hint("shuffle_hash"), ["ord", "mark"]).select("ord", "text", "wanted")
    parts = staged(parts.mapInArrow(cut, "shard int, anchor long, kind long, ord long, at long, bytes binary"), "parts")
    discard(sent)
    piece = parts.filter("shard < 0").drop("shard").withColumn("k", F.xxhash64(F.unhex(F.sha2("bytes", 256))))
    long = piece.groupBy("anchor").agg(F.min("ord").alias("low"), F.max("ord").alias("high"), (F.min("k") == F.max("k")).alias("pure")).filter("low < high")
    long = staged(long.select("anchor", "low", "pure"), "long")
    whole = piece.join(long.filter("pure").select("anchor", "low"), "anchor").filter("ord > low").select("kind", "at", F.octet_length("bytes").cast("long").alias("n"))
    windows = piece.join(long.filter("not pure").select("anchor"), "anchor").select("kind", "ord", "at", "bytes")
    windows = staged(windows.mapInArrow(single, "k1 long, k2 long, kind long, ord long, at long"), "windows")
    least = windows.groupBy("k1", "k2").agg(F.min("ord").alias("low"), F.max("ord").alias("high")).filter("low < high").select("k1", "k2", "low")
    again = windows.join(least, ["k1", "k2"]).filter("ord > low").select("kind", "at", F.lit(WIDTH).cast("long").alias("n"))
    # Repeated rows of documents send their passages again; they fall together before a shard gets them.
    alone = parts.filter("shard >= 0").groupBy("shard", "kind", "ord").agg(F.max("bytes").alias("bytes"))
    verdicts = staged(again.unionByName(whole).unionByName(alone.groupBy("shard").applyInArrow(search, "kind long, at long, n long")).distinct(), "verdicts")
    discard(parts, long, windows)
    own = met.filter("not copy").select("kind", "ord", "mark", "span").distinct()
    own = own.join(verdicts, "kind").select("ord", "mark", ((F.shiftright("span", 8) + F.col("at")) * 256 + F.col("n")).alias("span"))
    every = pure.unionByName(met.filter("copy").select("ord", "mark", "span")).unionByName(own)
    every = every.unionByName(copies.withColumn("span", F.lit(ALL).cast("long")))
    lost = staged(every.groupBy("ord", "mark").agg(F.collect_set("span").alias("spans")), "lost")
    discard(names, copies, found, groups, met, verdicts)
    return lost


def kept(text: bytes, spans: list[int] | None) -> tuple[bytes, int]:
    """What stays of a text, and the number of maximal runs that go."""
    if not spans:
        return text, 0
    cover = np.zeros(len(text) + 1, np.int32)
    if spans == [ALL]:
        return b"", 1
    packed = np.array(spans, np.int64)
    np.add.at(cover, packed // 256, 1)
    np.add.at(cover, packed // 256 + packed % 256, -1)
    gone = np.cumsum(cover[:-1]) > 0
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int((gone & ~np.append(False, gone[:-1])).sum())


def drop_repeats(docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_bytes, n_removed, n_spans and kept, the remaining bytes (not always whole characters)."""
    rows = keyed(docs)
    spans = lost_spans(rows)

    def run(batches):
        for batch in batches:
            texts = texts_of(batch)
            done = [kept(t, s) for t, s in zip(texts, batch.column("spans").to_pylist(), strict=True)]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            left = np.fromiter((len(d[0]) for d in done), np.int64, len(done))
            arrays = [batch.column("doc_id"), *_longs(sizes, sizes - left), pa.array([d[1] for d in done], pa.int64()), pa.array([d[0] for d in done], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    held = rows.withColumn("doc_id", F.when(F.col("ord") > NO_ID, F.col("ord"))).join(spans.hint("shuffle_hash"), ["ord", "mark"], "left")
    return held.select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op12_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, ''))::BIGINT AS n_bytes FROM documents),
s AS (SELECT doc_id, unnest(generate_series(0, n_bytes - 50)) AS s, x FROM d WHERE n_bytes >= 50),
w AS (SELECT doc_id, s, substr(x, 2 * s + 1, 100) AS win FROM s),
f AS (SELECT win, min(doc_id) AS low FROM w GROUP BY win HAVING min(doc_id) < max(doc_id)),
r AS (SELECT doc_id, s FROM w JOIN f USING (win) WHERE doc_id > low),
e AS (SELECT doc_id, s, s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS gap FROM r),
g AS (SELECT doc_id, s, sum(CASE WHEN gap <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS nth FROM e),
m AS (SELECT doc_id, nth, min(s) AS a, max(s) + 50 AS b FROM g GROUP BY 1, 2),
c AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM m GROUP BY 1),
p AS (SELECT doc_id, nth AS i, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY nth), 0) AS a, a AS b FROM m
      UNION ALL SELECT doc_id, max(nth) + 1, max(b), NULL FROM m GROUP BY 1),
k AS (SELECT p.doc_id, string_agg(CASE WHEN p.b IS NULL THEN substr(d.x, 2 * p.a + 1) ELSE substr(d.x, 2 * p.a + 1, 2 * (p.b - p.a)) END, '' ORDER BY p.i) AS kept FROM p JOIN d USING (doc_id) GROUP BY 1)
SELECT d.doc_id, d.n_bytes, coalesce(c.n_removed, 0) AS n_removed, coalesce(c.n_spans, 0) AS n_spans, sha256(unhex(coalesce(k.kept, d.x))) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)
"""
