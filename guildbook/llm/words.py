"""Words of many texts at once: their places and 64-bit hashes, by numpy over one buffer of UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from guildbook.llm.common import BLANKS

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
#: A random number for each byte value, and the odd base of the polynomial.
_OF_BYTE = _RANDOM.integers(0, 2**64, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)

IS_BLANK = np.zeros(256, bool)
IS_BLANK[list(BLANKS.encode())] = True
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of the base, modulo 2^64."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 2 * len(_powers), 4096), _BASE, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the finishing step of splitmix)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _mix_in_place(h: np.ndarray) -> None:
    """mix() with one array beside the given one, for long arrays."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, None)):
        h ^= h >> np.uint64(shift)
        if factor:
            h *= np.uint64(factor)


class Words:
    """Words of a list of texts in UTF-8. kind: a class for each byte value, 0 between words; a word is a run of one class.
    begin, end: places in buf; doc: which text; first: for each text its first word, and the number of words at the end."""

    def __init__(self, texts: list[bytes], kind: np.ndarray | None = None):
        kind = (~IS_BLANK).astype(np.uint8) if kind is None else kind
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_begin = np.concatenate([[0], np.cumsum(lengths + 1)])
        kinds = kind[self.buf]
        edge = np.flatnonzero(np.diff(kinds, prepend=0))  # the last byte is between words, so every word ends
        on = kinds[edge] > 0
        self.begin = edge[on]
        ends = np.append(edge, len(self.buf))[1:]
        self.end = ends[on]
        self.doc = np.searchsorted(self.text_begin, self.begin, "right") - 1
        self.first = np.searchsorted(self.begin, self.text_begin)
        self.kinds = kinds

    def per_text(self, of_word: np.ndarray) -> np.ndarray:
        """Sums of a number per word over each text."""
        total = np.concatenate([[0], np.cumsum(of_word)])
        return total[self.first[1:]] - total[self.first[:-1]]

    def bytes_per_text(self, of_byte: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(of_byte, dtype=np.int64)])
        return total[self.text_begin[1:]] - total[self.text_begin[:-1]]

    def hashes(self, apart: bool = False) -> np.ndarray:
        """A 64-bit hash of each word. apart: each byte is mixed with its place before the sum, so that no two words are known to fall
        together; sums over powers of a base alone are equal for some pairs of words of 1,024 letters and more."""
        if not len(self.begin):
            return np.zeros(0, np.uint64)
        lengths = self.end - self.begin
        place = np.arange(len(self.buf)) - np.repeat(np.append([0], self.begin), np.diff(np.concatenate([[0], self.begin, [len(self.buf)]])))
        if apart:
            terms = place.view(np.uint64)
            terms *= _BASE
            terms += _OF_BYTE[self.buf]
            _mix_in_place(terms)
        else:
            terms = _OF_BYTE[self.buf] * powers(int(place.max()) + 1)[place]
        terms[self.kinds == 0] = 0
        sums = np.add.reduceat(terms, self.begin)
        return mix(sums + lengths.astype(np.uint64))


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n neighbouring hashes; the last n - 1 places are missing."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for k, p in enumerate(powers(n)):
        out += h[k : k + m] * p
    return mix(out)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about so many bytes of text each."""
    begin, held = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        held += n or 0
        if held >= most:
            yield batch.slice(begin, i + 1 - begin)
            begin, held = i + 1, 0
    if begin < batch.num_rows:
        yield batch.slice(begin)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts in UTF-8, null as empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]
