"""BPE encoding and decoding by prefix-sharing trie traversal.

A text is cut into words by the tokenizer's pattern. The distinct words of a batch are taken in order, which walks their
trie depth first: going from one word to the next keeps the states of the prefix they share. The state at a trie node is
the last token of the encoding of that prefix; it is the one token that ends there and whose border with the last token
before it no merge crosses. A word's ids are read off backwards from its node. So the encoding of a shared prefix is
computed once in a batch, and a word's encoding once as long as it is remembered.

The work is a map over rows: no shuffle, and memory bounded by the caches' size and the longest text.

Defined cases: null text counts as empty (no ids, the digests of nothing); every row gives one row; empty tables give none;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from guildbook.llm.common import Remembered, table
from guildbook.llm.words import slices

# Fixed value: the word pattern of the byte-level vocabulary.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words remembered by a worker, and the longest that is remembered.
REMEMBERED, LONGEST = 800_000, 64
NEVER = 1 << 60


def _bytes_of_characters() -> dict[str, int]:
    """The byte that each character of the vocabulary's spelling stands for: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and chr(b) not in " \xa0\xad"]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


def shared_prefixes(words: list[bytes], width: int = 32) -> list[int]:
    """How many bytes each word shares with the one before it; equality is told by arrays for the first `width` bytes."""
    if not words:
        return []
    table = np.array([w[:width] for w in words], f"S{width}").view(np.uint8).reshape(len(words), width)
    differs = table[1:] != table[:-1]
    out = [0, *np.where(differs.any(axis=1), differs.argmax(axis=1), width).tolist()]
    for i in range(1, len(words)):
        a, b = words[i - 1], words[i]
        most = min(len(a), len(b))
        if out[i] >= most:  # zero bytes at a word's end look like its padding
            out[i] = most
        elif out[i] == width:
            while out[i] < most and a[out[i]] == b[out[i]]:
                out[i] += 1
    return out


class Vocabulary:
    """A byte-level BPE vocabulary read from a file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of = _bytes_of_characters()
        spell = lambda s: bytes(of[c] for c in s)
        self.id_of = {spell(t): i for t, i in spec["model"]["vocab"].items()}
        self.bytes_of = {i: t for t, i in self.id_of.items()}
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        #: When a pair of ids merges, and for a token made by a merge: when, from what left and what right token.
        self.merges: dict[tuple[int, int], int] = {}
        self.born: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for when, pair in enumerate(spec["model"]["merges"]):
            left, right = (spell(x) for x in (pair if isinstance(pair, list) else pair.split(" ")))
            a, b, made = self.id_of[left], self.id_of[right], self.id_of[left + right]
            self.merges[a, b] = when
            self.born[made], self.halves[made] = when, (a, b)
        self.size_of = {i: len(t) for t, i in self.id_of.items()}
        self.said = {i: f",{i}" for i in self.bytes_of}
        self._apart: dict[int, bool] = {}
        self._build_suffixes()

    def _build_suffixes(self) -> None:
        """The automaton that tells which tokens end at each byte: a trie of all tokens, and from each node the node of its longest
        proper suffix. ends[node]: (size, id) of the tokens that are suffixes of what led to the node, the longest first."""
        self._down: dict[int, int] = {}
        self._suffix, self.ends = [0], [()]
        own, spelled = {}, [(0, b"")]
        for token in sorted(self.id_of, key=len):
            node = 0
            for byte in token:
                key = node << 8 | byte
                node = self._down.get(key, -1)
                if node < 0:
                    node = self._down[key] = len(self._suffix)
                    self._suffix.append(0)
                    self.ends.append(())
                    spelled.append((key >> 8, key & 255))
            own[node] = (len(token), self.id_of[token])
        depth = [0] * len(spelled)
        for node in range(1, len(spelled)):  # parents come before their children
            depth[node] = depth[spelled[node][0]] + 1
        for node in sorted(range(1, len(spelled)), key=depth.__getitem__):
            parent, byte = spelled[node]
            self._suffix[node] = self._step(self._suffix[parent], byte) if parent else 0
            self.ends[node] = ((own[node],) if node in own else ()) + self.ends[self._suffix[node]]
        #: Steps between nodes as they were found.
        self.moves: dict[int, int] = {}

    def _step(self, node: int, byte: int) -> int:
        while True:
            found = self._down.get(node << 8 | byte)
            if found is not None:
                return found
            if not node:
                return 0
            node = self._suffix[node]

    def apart(self, a: int, b: int) -> bool:
        """Whether BPE leaves the border between two neighbouring tokens a and b.

        Plays the merges inside a and b backwards, the latest first. Of two equal merges the left one comes first. At each
        moment the tokens x and y face each other over the border, until x or y goes into a longer token (x_until, y_until);
        if x and y merge before that, the border falls."""
        x, y, x_until, y_until = a, b, NEVER, NEVER
        born, out = self.born, True
        while True:
            when = self.merges.get((x, y), NEVER)
            if when < x_until and when <= y_until and when < NEVER:
                out = False
                break
            x_born, y_born = born.get(x, -1), born.get(y, -1)
            if x_born < 0 and y_born < 0:
                break
            if x_born > y_born:
                x, x_until = self.halves[x][1], x_born
            else:
                y, y_until = self.halves[y][0], y_born
        if len(self._apart) > 2_000_000:
            self._apart.clear()
        self._apart[a << 32 | b] = out
        return out

    def encode_sorted(self, words: list[bytes]) -> Iterator[list[int]]:
        """Ids of each of the distinct words, given in order: one depth-first walk over their trie."""
        ends, moves, known, size = self.ends, self.moves, self._apart, self.size_of
        if len(moves) > 2_000_000:
            moves.clear()
        # last[k]: the last token of the encoding of the first k bytes of the word at hand; node[k]: where the automaton stands then.
        last, node = [-1], [0]
        for word, shared in zip(words, shared_prefixes(words), strict=True):
            del last[shared + 1 :], node[shared + 1 :]
            here = node[shared]
            for end in range(shared, len(word)):
                key = here << 8 | word[end]
                here = moves.get(key, -1)
                if here < 0:
                    here = moves[key] = self._step(key >> 8, word[end])
                node.append(here)
                for n, token in ends[here]:
                    if n > end:  # the whole prefix is one token
                        last.append(token)
                        break
                    left = last[end + 1 - n]
                    good = known.get(left << 32 | token)
                    if good or (good is None and self.apart(left, token)):
                        last.append(token)
                        break
            ids, end = [], len(word)
            while end:
                ids.append(last[end])
                end -= size[last[end]]
            ids.reverse()
            yield ids


class Codec:
    """Encodes texts word by word, through a memory of words."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.words = regex.compile(WORDS)
        #: The same pattern for texts of ASCII and Latin letters only, in the quicker of the two regex libraries.
        self.odd = re.compile("[^\t-\r -~À-ÖØ-öø-\u024f]")
        latin, blank = "A-Za-zÀ-ÖØ-öø-\u024f", "\t-\r "  # spelled out: the library's \s has U+001C to U+001F too
        self.latin = re.compile(rf" ?[{latin}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^{blank}{latin}0-9]+|[{blank}]+(?![^{blank}])|[{blank}]+")
        self.added = re.compile("(" + "|".join(sorted(map(re.escape, self.vocabulary.added), key=len, reverse=True)) + ")") if self.vocabulary.added else None
        #: word -> its ids in decimals, each behind a comma
        self.known = Remembered(REMEMBERED)
        #: word -> the bytes its ids decode to, where they aren't the word itself
        self.spelled: dict[str, bytes] = {}

    def _cut(self, text: str) -> list[str]:
        return (self.words if not text.isascii() and self.odd.search(text) else self.latin).findall(text)

    def learn(self, words: list[str]) -> None:
        """Encode distinct words that are not known yet, in one walk over their trie, and decode them again."""
        words = sorted(words)  # in order of their bytes too
        known, spell, said = self.known, self.vocabulary.bytes_of, self.vocabulary.said
        for w, ids in zip(words, self.vocabulary.encode_sorted([w.encode() for w in words]), strict=True):
            known[w] = "".join([said[i] for i in ids])
            decoded = b"".join([spell[i] for i in ids])
            if decoded != w.encode():
                self.spelled[w] = decoded

    def encode_batch(self, texts: list[str | None]) -> list[tuple[int, str, bytes]]:
        """For each text: number of ids, ids in decimals joined by commas, and the bytes they decode to."""
        known = self.known
        known.trim()
        cut, seen = [], set()
        for text in texts:
            parts = self.added.split(text or "") if self.added else [text or ""]
            words = [w for k, part in enumerate(parts) if part for w in ([part] if k % 2 else self._cut(part))] if len(parts) > 1 else self._cut(parts[0])
            cut.append(words)
            seen.update(words)
        for token, i in self.vocabulary.added.items():
            known[token] = f",{i}"
        self.spelled.clear()
        fresh = known.fresh(seen)
        self.learn(fresh)
        out = []
        for words in cut:
            ids = "".join([known[w] for w in words])
            if self.spelled:
                decoded = b"".join([self.spelled[w] if w in self.spelled else w.encode() for w in words])
            else:
                decoded = "".join(words).encode()
            out.append((ids.count(","), ids[1:], decoded))
        # Odd words are learned anew each time, and long ones are not worth the memory.
        for w in fresh:
            if len(w) > LONGEST or w in self.spelled:
                del known[w]
        return out


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Per row of docs (doc_id, text): number of ids and digests of the ids and of the text they decode to."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                got = codec(path).encode_batch(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([n for n, _, _ in got], pa.int64()),
                        pa.array([hashlib.sha256(ids.encode()).hexdigest() for _, ids, _ in got], pa.string()),
                        pa.array([hashlib.sha256(decoded.decode("utf-8", "replace").encode()).hexdigest() for _, _, decoded in got], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return encode_documents(table(spark, sf_dir, "documents"), path)
