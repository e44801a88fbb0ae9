"""Best-fit packing of documents into sequences, improved by swap-based local search.

Documents become pieces of at most `capacity` tokens. Pieces are dealt over groups of a fixed size by a hash of their row number
(given once, when they are written, so repeated rows and rows without doc_id spread like all others); each group is packed best fit, longest first, and then improved: the emptiest bin gives its pieces away by moves, by swaps of one
for one and of two for one with other underfull bins, each step raising the sum of squared fills, until the bin is empty or
no step is left. Bins that stay clearly underfull are opened again and repacked together over the groups, so that a group's
remainder doesn't cost a bin of its own.

Texts are tokenized where they lie; only piece lengths and checksums are shuffled. No group grows with the input.

Defined cases: null text counts as empty (its only token is the end mark); every row gives pieces of its own; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guildbook.llm.common import BLANKS, Remembered, staged, table
from guildbook.llm.words import mix, slices

CAPACITY, END = 2048, 0
#: Pieces in a group; bins filled less than this share are opened again; words a worker remembers.
GROUP, OPEN, REMEMBERED = 3000, 0.985, 300_000
#: Bytes of the longest word that is remembered, and characters of text that are worked on at once.
LONGEST, PART = 64, 4_000_000
#: Bins in a row that may fail to empty before the search ends; None tries every bin.
FAILURES = 6


#: Classes of bytes of a lower-cased text: blanks, letters (every byte beyond ASCII is part of one), digits, all others.
KIND = np.full(256, 3, np.uint8)
KIND[list(BLANKS.encode())] = 0
KIND[[*b"abcdefghijklmnopqrstuvwxyz", *range(128, 256)]] = 1
KIND[list(b"0123456789")] = 2
_QUOTE = ord("'")
#: The character that a byte-level vocabulary writes for each byte: printable Latin-1 for itself, the others from U+0100 on.
_PLAIN = [b for b in range(256) if chr(b).isprintable() and chr(b) not in " \xa0\xad"]
SPELLED = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}


def cut_words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the words that the tokenizer's pattern finds in a lower-cased text that ends with three blanks: runs of
    letters, single digits, runs of other characters, and a quote with s, t, m, d, re, ve or ll behind it."""
    kinds = KIND[buf]
    edge = np.append(True, kinds[1:] != kinds[:-1]) | (kinds == 2)
    q = np.flatnonzero(buf == _QUOTE)
    q = q[edge[q]]  # within a run of others a quote begins nothing
    one, two = buf[q + 1], buf[q + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    edge[q[short | long] + 1] = False
    edge[q[short] + 2] = True
    edge[q[long] + 3] = True
    begin = np.flatnonzero(edge)
    end = np.append(begin[1:], len(buf))
    inside = kinds[begin] > 0
    return begin[inside], end[inside]


def keys_of(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit key of each word, eight bytes at a time; buf has eight bytes more than the words."""
    eight = np.ndarray((len(buf) - 7,), "<u8", buf, 0, (1,))
    length = end - begin
    key = mix(length.astype(np.uint64))
    which = np.flatnonzero(length <= LONGEST)
    for at in range(0, LONGEST, 8):
        left = length[which] - at
        part = eight[begin[which] + at]
        short = left < 8
        part[short] &= (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
        key[which] = mix(key[which] ^ part)
        which = which[left > 8]
        if not len(which):
            break
    for i in np.flatnonzero(length > LONGEST).tolist():
        key[i] = xxhash.xxh64_intdigest(buf[begin[i] : end[i]].tobytes())
    return key


class Pieces:
    """Tokenizes word by word, as the tokenizer's own pattern cuts lower-cased text. The distinct words of a batch are found by
    arrays, and each is encoded once as long as it is remembered. Texts with characters beyond Latin letters and ASCII are cut at
    white space instead, which no word spans."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.four = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size())]
        #: Ids in little-endian bytes, of words by key and of chunks of odd texts.
        self.known, self.chunks = Remembered(REMEMBERED), Remembered(REMEMBERED // 4)
        self.end = np.array([END], "<u4").tobytes()
        self.added = [x["content"] for x in json.loads(self.tokenizer.to_str())["added_tokens"]]
        # The dotted capital I becomes two characters in lower case.
        self.odd = re.compile("[^\t-\r -~À-ÖØ-öø-\u012f\u0131-\u024f]")
        self.blank = re.compile("[\t-\r ]")

    def _word(self, word: bytes) -> bytes:
        """Ids of one word of the pattern, by the tokenizer's model alone; it spells bytes as the byte-level step does."""
        spelled = word.decode() if word.isascii() else word.decode("latin-1").translate(SPELLED)
        return b"".join([self.four[t.id] for t in self.model.tokenize(spelled)])

    def _encode(self, words: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _odd(self, text: str) -> bytes:
        chunks = [c.decode() for c in text.encode().split()]
        self.chunks.trim()
        fresh = self.chunks.fresh(chunks)
        self.chunks.update(zip(fresh, self._encode(fresh), strict=True))
        out = b"".join([self.chunks[c] for c in chunks])
        for c in fresh:
            if len(c) > LONGEST:
                del self.chunks[c]
        return out

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts of ASCII and Latin letters."""
        raw = [t.lower().encode() for t in texts]
        buf = np.frombuffer(b"\n".join(raw) + b"\n" * 8, np.uint8)
        begin, end = cut_words(buf)
        keys, first, place = np.unique(keys_of(buf, begin, end), return_index=True, return_inverse=True)
        known = self.known
        known.trim()
        keys = keys.tolist()
        of_word = list(map(known.get, keys))
        lacking = [i for i, ids in enumerate(of_word) if ids is None]
        at = first[lacking]
        whole = buf.tobytes()
        for i, a, b in zip(lacking, begin[at].tolist(), end[at].tolist(), strict=True):
            ids = known.old.get(keys[i])
            of_word[i] = ids = self._word(whole[a:b]) if ids is None else ids
            if b - a <= LONGEST:
                known[keys[i]] = ids
        # Ids of all words in order, by arrays; where each text's end.
        size = np.fromiter(map(len, of_word), np.int64, len(of_word)) // 4
        origin = np.cumsum(size) - size
        count = size[place]
        upto = np.concatenate([[0], np.cumsum(count)])
        ids = np.frombuffer(b"".join(of_word), "<u4")[np.arange(upto[-1]) + np.repeat(origin[place] - upto[:-1], count)].tobytes()
        starts = np.cumsum([0, *[len(r) + 1 for r in raw]])
        cut = 4 * upto[np.searchsorted(begin, starts)]
        return [ids[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text and the end mark, as little-endian unsigned 32-bit numbers. Long texts are worked on in parts that
        end before a blank, so that memory grows with the ids alone."""
        out: list[list[bytes]] = [[] for _ in texts]
        held, owners, size = [], [], 0

        def flush() -> None:
            nonlocal held, owners, size
            for i, ids in zip(owners, self._plain(held) if held else [], strict=True):
                out[i].append(ids)
            held, owners, size = [], [], 0

        for i, text in enumerate(texts):
            if not text:
                continue
            if self.odd.search(text) or any(x in text for x in self.added):
                out[i].append(self._odd(text))
                continue
            at = 0
            while at < len(text):
                to = self.blank.search(text, at + PART)
                to = to.start() if to else len(text)
                held.append(text[at:to])
                owners.append(i)
                size += to - at
                at = to
                if size >= PART:
                    flush()
        flush()
        return [b"".join([*parts, self.end]) for parts in out]


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def cut_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces: doc_id, piece, start, length, ids_crc32."""
    width = 4 * capacity
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        tool = pieces_of(path)
        for whole in batches:
            for batch in slices(whole, most=2 * PART):
                rows: list[tuple[int, int, int, int, int]] = []
                for i, ids in enumerate(tool.encode(batch.column("text").to_pylist())):
                    rows += [(i, k, k * capacity, min(width, len(ids) - at) // 4, zlib.crc32(ids[at : at + width])) for k, at in enumerate(range(0, len(ids), width))]
                which, piece, start, length, crc = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(which)), pa.array(piece.astype(np.int32)), *map(pa.array, (start, length, crc))], ["doc_id", "piece", "start", "length", "ids_crc32"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


class Bins:
    """Bins of one group while they are packed."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.items: list[list[int]] = []
        self.fill: list[int] = []
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0  # a bit for each amount of room that some bin has

    def _file(self, b: int) -> None:
        room = self.capacity - self.fill[b]
        self.by_room[room].append(b)
        self.rooms |= 1 << room

    def best_fit(self, i: int) -> None:
        n = self.lengths[i]
        fits = self.rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = self.by_room[room].pop()
            if not self.by_room[room]:
                self.rooms &= ~(1 << room)
        else:
            b = len(self.items)
            self.items.append([])
            self.fill.append(0)
        self.items[b].append(i)
        self.fill[b] += n
        self._file(b)

    def improve(self, failures_allowed: int | None = FAILURES) -> None:
        """Empty the emptiest bins by moves and swaps, as long as the room elsewhere could take them."""
        alive = {b for b in range(len(self.items)) if self.items[b]}
        failures = 0
        kept: set[int] = set()
        while failures_allowed is None or failures < failures_allowed:
            under = [b for b in alive if self.fill[b] < self.capacity]
            givers = [b for b in under if b not in kept]
            if not givers:
                return
            giver = min(givers, key=lambda b: (self.fill[b], b))
            takers = {b: self.capacity - self.fill[b] for b in under if b != giver}
            if sum(takers.values()) < self.fill[giver]:
                return
            if self._give_away(giver, takers):
                alive.discard(giver)
                failures = 0
            else:
                kept.add(giver)
                failures += 1

    def _give_away(self, giver: int, takers: dict[int, int]) -> bool:
        lengths = self.lengths
        holders: dict[int, set[tuple[int, int]]] = {}  # length -> (bin, piece) of takers
        by_room: dict[int, set[int]] = {}
        for b, room in takers.items():
            by_room.setdefault(room, set()).add(b)
            for i in self.items[b]:
                holders.setdefault(lengths[i], set()).add((b, i))

        def change(b: int, out: int | None, into: list[int]) -> None:
            room = takers[b]
            by_room[room].discard(b)
            if out is not None:
                self.items[b].remove(out)
                holders[lengths[out]].discard((b, out))
                room += lengths[out]
            for i in into:
                self.items[b].append(i)
                holders.setdefault(lengths[i], set()).add((b, i))
                room -= lengths[i]
            takers[b] = room
            self.fill[b] = self.capacity - room
            by_room.setdefault(room, set()).add(b)
            gone = {*into}
            self.items[giver] = [i for i in self.items[giver] if i not in gone] + ([] if out is None else [out])
            self.fill[giver] = sum(lengths[i] for i in self.items[giver])

        def move() -> bool:
            for i in sorted(self.items[giver], key=lambda i: -lengths[i]):
                for room in range(lengths[i], self.capacity + 1):
                    if by_room.get(room):
                        change(min(by_room[room]), None, [i])
                        return True
            return False

        def swap() -> bool:
            """One piece, or two, for a shorter one of a taker; the step that fills a bin most. Pieces of one length are alike, so
            the gifts are those of distinct lengths, of which a bin holds few (their sum is at most the capacity)."""
            alike: dict[int, list[int]] = {}
            for i in self.items[giver]:
                alike.setdefault(lengths[i], []).append(i)
            sizes = sorted(alike, reverse=True)
            pairs = [(m + n, [alike[m][0], alike[n][0]]) for k, m in enumerate(sizes) for n in sizes[k + 1 :]]
            gifts = [(n, [alike[n][0]]) for n in sizes] + pairs + [(2 * n, alike[n][:2]) for n in sizes if len(alike[n]) > 1]
            most = max(takers.values(), default=0)
            for gain in range(most, 0, -1):
                for n, into in gifts:
                    found = [x for x in holders.get(n - gain, ()) if takers[x[0]] >= gain] if n > gain else []
                    if found:
                        change(*min(found), into)
                        return True
            return False

        # Each step fills the others more, so there are at most as many as the giver holds tokens.
        while self.items[giver]:
            if not move() and not swap():
                return False
        return True


def pack(lengths: np.ndarray, capacity: int = CAPACITY, failures: int | None = FAILURES) -> tuple[np.ndarray, np.ndarray]:
    """A bin number and an offset for each piece."""
    bins = Bins([int(n) for n in lengths], capacity)
    for i in np.argsort(-lengths, kind="stable"):
        bins.best_fit(int(i))
    if len(bins.items) > -(-int(lengths.sum()) // capacity):
        bins.improve(failures)
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for b, items in enumerate(x for x in bins.items if x):
        at = 0
        for i in items:
            number[i], offset[i] = b, at
            at += bins.lengths[i]
    return number, offset


def _pack_groups(pieces: DataFrame, capacity: int, turn: int) -> DataFrame:
    """Packs each group on its own. sequence_id: the group's number and the bin's, and which turn made it. Rows stay in Arrow, as
    doc_ids beyond 2^53 would not survive as floats beside a null."""

    def run(held: pa.Table) -> pa.Table:
        held = held.take(pa.array(np.lexsort((held.column("row").to_numpy(), -held.column("length").to_numpy()))))
        length = held.column("length").to_numpy()
        number, offset = pack(length, capacity)
        fill = np.bincount(number, length).astype(np.int64)[number]
        sequence = (held.column("group").to_numpy() * 2 + turn) * (1 << 24) + number
        for name, column in (("sequence_id", sequence), ("offset", offset), ("fill", fill)):
            held = held.append_column(name, pa.array(column))
        return held

    names = [f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields]
    return pieces.groupBy("group").applyInArrow(run, ", ".join([*names, "sequence_id long", "offset long", "fill long"]))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Per piece of docs (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    # Once written, a piece's row number tells it from all others, equal ones and those without doc_id too.
    pieces = staged(cut_documents(docs, path, capacity).withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = pieces.filter(F.col("length") == capacity)  # sequences of their own
    rest = pieces.filter(F.col("length") < capacity)
    spread = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(max(1, -(-n // group)))).cast("long")
    first = staged(_pack_groups(rest.withColumn("group", spread(rest.count(), 1)), capacity, 0), "packed")
    low = F.col("fill") < OPEN * capacity
    open_ = first.filter(low).drop("sequence_id", "offset", "fill", "group")
    again = _pack_groups(open_.withColumn("group", spread(first.filter(low).count(), 2)), capacity, 1)
    # Full pieces: numbers below zero.
    alone = full.withColumn("sequence_id", -1 - F.col("row")).withColumn("offset", F.lit(0).cast("long"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return alone.select(columns).unionByName(first.filter(~low).select(columns)).unionByName(again.select(columns))


def op10_packing(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), path or default_path())


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


