"""Vectorised words: 64-bit hashes of the words of many texts, with NumPy over their UTF-8 bytes.

No Python string is made for a word. Texts are taken in blocks of about half a megabyte, cut at
separators, so that memory stays bounded for any length of text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

BLOCK_BYTES = 1 << 19
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def _table(separators: Iterable[int]) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(separators)] = True
    return mask


#: Space and the controls from tab to carriage return end a word.
WHITESPACE = _table([0x20, *range(0x09, 0x0E)])
#: Any ASCII byte but letters and digits ends a word; bytes of other characters belong to words.
PUNCTUATION = _table([b for b in range(128) if not chr(b).isalnum()])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_powers = np.ones(1, np.uint64)


def _pow(n: int) -> np.ndarray:
    """The first n powers of the base modulo 2^64."""
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers))
        steps = np.full(size, _BASE, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Words:
    """The words of one block.

    ``hashes``; ``doc``, the index of each word's text; ``chars``, the words' lower-cased bytes, with ``starts`` and
    ``lens`` into them; ``raw``, the block's bytes, with ``at``, where words begin; parts of the texts ``docs`` begin at ``bounds``.
    """

    __slots__ = ("hashes", "doc", "chars", "starts", "lens", "sep", "raw", "at", "bounds", "docs")

    def __init__(self, raw: np.ndarray, bounds: np.ndarray, docs: np.ndarray, separators: np.ndarray):
        sep = separators[raw]
        inside = ~sep
        first = inside.copy()
        first[1:] &= sep[:-1]
        at = np.flatnonzero(first)
        low = _LOWER[raw]
        self.raw, self.sep, self.at, self.bounds, self.docs = raw, sep, at, bounds, docs
        self.chars = low[inside]
        before = np.cumsum(inside)
        self.starts = before[at] - 1
        self.lens = np.diff(np.append(self.starts, len(self.chars)))
        self.doc = docs[np.searchsorted(bounds, at, side="right") - 1]
        self.hashes = self._hash(self.chars, self.starts, self.lens)

    @staticmethod
    def _hash(chars: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.uint64)
        place = np.arange(len(chars)) - np.repeat(starts, lens)
        terms = (chars.astype(np.uint64) + _U(1)) * _pow(int(lens.max()))[place]
        return mix(np.add.reduceat(terms, starts) + lens.astype(np.uint64))

    def prefixes(self, n: int) -> np.ndarray:
        """Hashes of the first n bytes of each word; 0 for words of fewer."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        long = self.lens >= n
        out = np.zeros(len(self.starts), np.uint64)
        if long.any():
            places = self.starts[long][:, None] + np.arange(n)[None, :]
            terms = (self.chars[places].astype(np.uint64) + _U(1)) * _pow(n)[:n]
            out[long] = mix(terms.sum(axis=1, dtype=np.uint64) + _U(n))
        return out


def hash_of(word: str | bytes) -> int:
    """The hash of one word, as ``Words`` has it."""
    raw = word.encode("utf-8", "surrogatepass") if isinstance(word, str) else word
    chars = _LOWER[np.frombuffer(raw, np.uint8)]
    return int(Words._hash(chars, np.zeros(1, np.int64), np.array([len(chars)]))[0])


def _pieces(texts: list[bytes], separators: np.ndarray) -> Iterator[list[tuple[int, memoryview | bytes]]]:
    """Lists of (index, part of a text), of about a block each; parts end at separators."""
    held: list[tuple[int, bytes]] = []
    size = 0
    ends = {int(b) for b in np.flatnonzero(separators)}
    for i, text in enumerate(texts):
        at = 0
        while len(text) - at > BLOCK_BYTES:
            stop = at + BLOCK_BYTES
            while stop < len(text) and text[stop] not in ends:
                stop += 1
            held.append((i, text[at:stop]))
            yield held
            held, size, at = [], 0, stop
        held.append((i, text[at:] if at else text))
        size += len(text) - at
        if size >= BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def blocks(texts: list[str | bytes | None], separators: np.ndarray = WHITESPACE) -> Iterator[Words]:
    """The words of ``texts`` (null: empty), block by block; the texts' order is kept."""
    raw = [b"" if t is None else t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass") for t in texts]
    for pieces in _pieces(raw, separators):
        joined = np.frombuffer(b" ".join([p for _, p in pieces]), np.uint8)
        sizes = np.array([len(p) for _, p in pieces]) + 1
        bounds = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        yield Words(joined, bounds, np.array([i for i, _ in pieces]), separators)


def word_hashes(texts: list[str | bytes | None], separators: np.ndarray = WHITESPACE) -> tuple[np.ndarray, np.ndarray]:
    """All word hashes in order, and the offsets of the texts among them (one more than texts)."""
    parts, counts = [], np.zeros(len(texts), np.int64)
    for block in blocks(texts, separators):
        parts.append(block.hashes)
        counts += np.bincount(block.doc, minlength=len(texts))
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(counts)])
