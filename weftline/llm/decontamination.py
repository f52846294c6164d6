"""Benchmark decontamination by latent semantic retrieval and checks of the retrieved passages.

Documents and benchmark items are cut into passages of ``WINDOW`` words, each ``STRIDE`` words
after the last. The weight of a benchmark word is its inverse document frequency over *all* documents,
where a word that many copies of one passage repeat counts by the number of different words it follows
(a mergeable bitmap), so that a leaked passage doesn't become common by leaking; all other words are
weighed by hash buckets.

The latent space comes from a randomised SVD of the TF-IDF passages of the benchmark and of *all*
documents, both halves of equal weight. The words of the documents are written once, by the pass that
counts them; two passes over them follow. The first finds the range: passages with random signs are added up in
lines (``FOLD`` to a line, every passage in one), whose products stand for the passages' own on average. The
second is exact: it sums the products of all passages within that range, and the singular vectors are its.
Its terms are the benchmark's words and ``OTHERS`` buckets of all other words, so words that stand with
the same words come to lie together. (In the fit alone, words go by 32 bits of their hashes.) Its rank, ``RANK``
and half the number of benchmark passages at most, makes it generalise; its directions count alike. Tasks
multiply their rows by a thin matrix, and the sums of these products are all that the driver sees.
Passages of documents with at least ``LIVE`` of their weight in words that the space has learned are
compared with the benchmark's by cosine.

Candidates are confirmed on the words around them: a longest common subsequence of at least ``SAME`` of
the item's words; or of ``ALIKE`` together with the item's answer (its last sentence); or, for the paraphrases
that only the latent space finds, of ``LOOSE`` together with the answer.

A reduced space can't promise recall for whole items, short ones above all. So passages with enough
*markers* of an item are candidates too: its rarest words, ``SURE`` more than the check lets miss, of which
``SURE`` must be there. So are passages where an answer begins.
Others cannot pass the first or second rule, so nothing that these would confirm is lost before them.

One pass over the documents counts the words of the whole benchmark (one for each ``TERMS`` distinct
words). The benchmark is then worked on in blocks of at most ``PASSAGES`` passages, so what is broadcast
has a bound; each block is one pass, and two over the written words. The driver holds one block and 16 bytes a distinct benchmark word.

Defined results: a null or empty text is clean; an item without words is contained in nothing; items with
null, repeated or string ids are all checked, and ids come back in their own type; an item of over
``PASSAGES`` passages is checked in parts of that size, each under the item's id; rows with null or repeated
ids are checked each; empty tables give clean documents, or none.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from weftline.llm.runtime import settle, shuffle_partitions, small_batches
from weftline.llm.words import PUNCTUATION, mix, word_hashes

WINDOW = 32
STRIDE = 16
PASSAGES = 4096
RANK = 128
EXTRA = 8
LIVE = 0.3
COSINE = 0.7
SAME = 0.8
ALIKE = 0.5
LOOSE = 0.25
SURE = 3
TERMS = 1 << 21
BUCKETS = 1 << 16
OTHERS = 1 << 13
HEAVIEST = 8.0
#: A word outside the benchmark weighs less than the most only if its bucket is in more than this share of the documents.
COMMON = 0.02
_ROWS = 64
#: Passages whose latent vectors are made together.
AT_ONCE = 512
#: Halves of passages that the fit takes together.
TOGETHER = 2048
#: Lines and cells of a sketch at most, and the halves of passages that are folded into a line.
LINES = 1024
CELLS = 1 << 21
FOLD = 64


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in lower case, and the offsets of the texts."""
    return word_hashes([t and t.lower() for t in texts], PUNCTUATION)


@dataclass
class Item:
    key: object
    words: np.ndarray
    answer: np.ndarray


@dataclass
class Terms:
    """Benchmark words, sorted by hash, with weights, and the weights of the buckets of all other words."""

    hashes: np.ndarray
    weight: np.ndarray
    other: np.ndarray

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The term of each word, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        # Most words are in a bucket without any term.
        near = np.flatnonzero((np.bincount(bucket(self.hashes), minlength=BUCKETS) > 0)[bucket(hashes)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[near]), len(self.hashes) - 1)
        out = np.full(len(hashes), -1)
        out[near] = np.where(self.hashes[at] == hashes[near], at, -1)
        return out

    def weigh(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The term (or -1), the row of the latent space, and the weight of each word."""
        term, cell = self.find(hashes), bucket(hashes)
        own = term >= 0
        weight = np.where(own, self.weight[term] if len(self.weight) else 0.0, self.other[cell]).astype(np.float32)
        return term, np.where(own, term, len(self.hashes) + cell * OTHERS // BUCKETS), weight

    def only(self, hashes: np.ndarray) -> Terms:
        """These words alone."""
        return Terms(hashes, self.weight[self.find(hashes)], self.other)


@dataclass
class Markers:
    """Marker words of the items, of which ``need`` must be there, and the hashes of the answers' first three words."""

    need: np.ndarray
    posted: np.ndarray  # items by term, and where each term's begin
    first: np.ndarray
    answers: np.ndarray  # sorted, with their items
    answer_of: np.ndarray


@dataclass
class Model:
    items: list[Item]
    terms: Terms
    space: np.ndarray  # terms and other buckets x rank
    known: np.ndarray  # which of these rows the space has learned
    passages: np.ndarray  # benchmark passages x rank, of unit length
    item_of: np.ndarray
    markers: Markers


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)


def windows(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, end) of the passages of texts with these offsets."""
    size = np.diff(ends)
    n = np.where(size > 0, np.maximum(1, -(-(size - (WINDOW - STRIDE)) // STRIDE)), 0)
    text = np.repeat(np.arange(len(size)), n)
    first = ends[:-1][text] + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * STRIDE
    return text, first, np.minimum(first + WINDOW, ends[1:][text])


def items_of(rows: Iterable[tuple[object, str | None]]) -> Iterator[Item]:
    """Items with words, long ones in parts; the answer is the last sentence, if it has three words and isn't all."""
    for key, text in rows:
        words, _ = _words([text])
        parts = [p for p in re.split(r"[.!?\n]+", text or "") if p.strip()]
        last, _ = _words([parts[-1] if parts else ""])
        answer = last if 3 <= len(last) < len(words) else last[:0]
        longest = PASSAGES * STRIDE
        for at in range(0, len(words), longest):
            yield Item(key, words[at : at + longest], answer if len(words) <= longest else answer[:0])


def blocks_of(items: Iterable[Item]) -> Iterator[list[Item]]:
    held, size = [], 0
    for item in items:
        n = max(1, -(-len(item.words) // STRIDE))
        if held and size + n > PASSAGES:
            yield held
            held, size = [], 0
        held.append(item)
        size += n
    if held:
        yield held


def threes(words: np.ndarray) -> np.ndarray:
    """The hashes of each word with the two after it."""
    prime = np.uint64(0x9FB21C651E98DF25)
    return mix((words[:-2] * prime + words[1:-1]) * prime + words[2:]) if len(words) > 2 else np.zeros(0, np.uint64)


def markers(items: list[Item], terms: Terms) -> Markers:
    """Of n words of which m must be found, at least k of any n - m + k are found."""
    pairs, need = [], np.zeros(len(items), np.int64)
    for i, item in enumerate(items):
        term = terms.find(item.words)
        must = int(np.ceil(SAME * len(term) - 1e-9))
        need[i] = min(SURE, must)
        chosen = np.unique(term[np.argsort(-terms.weight[term], kind="stable")[: len(term) - must + need[i]]])
        pairs.append(np.stack([chosen, np.full(len(chosen), i)]))
    term, item = np.concatenate(pairs, axis=1)
    order = np.argsort(term, kind="stable")
    answered = [i for i, x in enumerate(items) if len(x.answer)]
    answers = np.array([threes(items[i].answer[:3])[0] for i in answered], np.uint64)
    place = np.argsort(answers, kind="stable")
    return Markers(need, item[order], np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(terms.hashes)))]), answers[place], np.array(answered, np.int64)[place])


def counted(docs: DataFrame, hashes: np.ndarray, text_col: str, low: int = 0) -> DataFrame:
    """Counts (cell, n, after) of the terms from ``low`` and of the buckets of all other words; for the first terms also a row of ``words``, the upper halves of their hashes, for each text."""
    own = hashes[low : low + TERMS]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS + len(own) + 1, np.int64)
        after = np.zeros((BUCKETS + len(own) + 1) * 64, bool)
        terms = Terms(own, np.zeros(0), np.zeros(0))
        for batch in batches:
            texts = batch.column(0).to_pylist()
            found, ends = _words(texts)
            seen[-1] += len(texts)
            if not len(found):
                continue
            doc = np.repeat(np.arange(len(texts)), np.diff(ends))
            term = terms.find(found)
            cell = np.where(term >= 0, BUCKETS + term, bucket(found))
            once = np.sort(doc * np.int64(len(seen)) + cell)
            once = once[np.concatenate([[True], once[1:] != once[:-1]])]
            seen += np.bincount(once % len(seen), minlength=len(seen))
            mine = np.flatnonzero(term >= 0)
            after[(cell[mine] << 6) | (mix(found[np.maximum(mine - 1, 0)]) & np.uint64(63)).astype(np.int64)] = True
            if not low:
                full = np.flatnonzero(np.diff(ends))
                words = pa.Array.from_buffers(pa.binary(), len(full), [None, pa.py_buffer((4 * np.append(ends[full], ends[-1])).astype(np.int32)), pa.py_buffer((found >> np.uint64(32)).astype(np.uint32))])
                yield pa.RecordBatch.from_arrays([pa.nulls(len(full), pa.int32()), pa.nulls(len(full), pa.int64()), pa.nulls(len(full), pa.int64()), words], names)
        full = np.flatnonzero(seen)
        bits = np.packbits(after.reshape(-1, 64)[full], axis=1).view(np.int64)[:, 0]
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(seen[full]), pa.array(bits), pa.nulls(len(full), pa.binary())], names)

    names = ["cell", "n", "after", "words"]
    return docs.select(text_col).mapInArrow(count, "cell int, n bigint, after bigint, words binary")


def weights(counts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The weights of so many terms and of the buckets of all other words."""
    # One row for each cell, of which there is a fixed number.
    cells = counts.where("cell IS NOT NULL").groupBy("cell").agg(F.sum("n").alias("n"), F.expr("bit_or(after)").alias("after")).toArrow()
    n, follows = np.zeros(BUCKETS + size + 1), np.zeros(BUCKETS + size + 1)
    at = cells.column("cell").to_numpy()
    n[at] = cells.column("n").to_numpy()
    bits = np.unpackbits(cells.column("after").to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=1)
    follows[at] = np.where(bits < 48, -64 * np.log1p(-np.minimum(bits, 48) / 64), np.inf)
    total = n[-1]
    most = min(HEAVIEST, np.log1p(total))
    terms = np.minimum(n[BUCKETS:-1], np.maximum(follows[BUCKETS:-1], 1))
    share = n[:BUCKETS] / max(total, 1)
    return np.clip(np.log((total + 1) / (terms + 1)), 0, most), np.where(share > COMMON, np.minimum(most, -np.log(np.maximum(share, 1e-12))), most)


def read_all(docs: DataFrame, hashes: np.ndarray, text_col: str) -> tuple[Terms, DataFrame]:
    """Weights over all documents, and the words of every text (upper halves of their hashes), written for the passes of the fit."""
    small_batches(docs.sparkSession)
    first = settle(counted(docs, hashes, text_col), "document-words")
    parts = [weights(first if not low else counted(docs, hashes, text_col, low), len(hashes[low : low + TERMS])) for low in range(0, max(1, len(hashes)), TERMS)]
    return Terms(hashes, np.concatenate([w for w, _ in parts]), parts[0][1]), first.where("words IS NOT NULL").select("words")


def statistics(docs: DataFrame, hashes: np.ndarray, text_col: str) -> Terms:
    """Weights over all documents: document frequencies of the terms and of the buckets of all other words."""
    return read_all(docs, hashes, text_col)[0]


def _rows(found: np.ndarray, ends: np.ndarray, terms: Terms) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse passages (row, row of the space, weight) of texts' words, each of unit norm."""
    _, cell, weight = terms.weigh(found)
    _, first, end = windows(ends)
    mass = np.concatenate([[0], np.cumsum(weight.astype(np.float64) ** 2)])
    norm = np.sqrt(np.maximum(mass[end] - mass[first], 1e-12))
    size = end - first
    row = np.repeat(np.arange(len(first)), size)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
    return row, cell[at], (weight[at] / norm[row]).astype(np.float32)


def _sum_by(key: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows of each key, 0 .. size - 1; keys are in order."""
    out = np.zeros((size, rows.shape[1]), np.float32)
    if len(key):
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        out[key[first]] = np.add.reduceat(rows, first, axis=0)
    return out


def _dense(row: np.ndarray, cell: np.ndarray, value: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Latent vectors of the rows, which are in order."""
    return _sum_by(row, space[cell] * value[:, None], int(row[-1]) + 1 if len(row) else 0)


def _back(row: np.ndarray, cell: np.ndarray, value: np.ndarray, dense: np.ndarray, size: int) -> np.ndarray:
    """The product of the transposed sparse rows with ``dense``."""
    order = np.argsort(cell, kind="stable")
    return _sum_by(cell[order], dense[row[order]] * value[order, None], size)


def _gram(row: np.ndarray, cell: np.ndarray, value: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The transposed rows times the rows times ``basis``, a bounded number of passages at a time."""
    total = np.zeros(basis.shape, np.float32)
    cuts = np.searchsorted(row, np.arange(0, int(row[-1]) + 1 + AT_ONCE, AT_ONCE)) if len(row) else []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            part = row[a:b] - row[a], cell[a:b], value[a:b]
            total += _back(*part, _dense(*part, basis), len(basis))
    return total


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


@dataclass
class Halves:
    """Words in rows of ``STRIDE`` (the last of a text filled up with weight 0): a passage is such a half and the next of its text."""

    cell: np.ndarray
    weight: np.ndarray
    last: np.ndarray  # whether no other half of the text follows
    scale: np.ndarray  # one over the norm of the passage that begins here; 0 if none does


class Rows:
    """The rows of the space and the weights of words that are known by the upper halves of their hashes."""

    def __init__(self, terms: Terms):
        self.hashes = (terms.hashes >> np.uint64(32)).astype(np.uint32)
        self.weight = np.append(terms.weight, 0).astype(np.float32)
        self.other = terms.other.astype(np.float32)
        self.some = np.bincount(self.hashes >> np.uint32(16), minlength=BUCKETS) > 0

    def halves(self, words: np.ndarray, ends: np.ndarray) -> Halves:
        cell = (words >> np.uint32(16)).astype(np.int64)
        weight = self.other[cell]
        near = np.flatnonzero(self.some[cell])
        cell = cell * OTHERS // BUCKETS + len(self.hashes)
        if len(near):
            mine = words[near]
            at = np.minimum(np.searchsorted(self.hashes, mine), len(self.hashes) - 1)
            own = self.hashes[at] == mine
            cell[near[own]], weight[near[own]] = at[own], self.weight[at[own]]
        size = np.diff(ends)
        n = -(-size // STRIDE)
        after = np.cumsum(n)
        place = np.arange(len(words)) + np.repeat((after - n) * STRIDE - ends[:-1], size)
        out = Halves(np.zeros(n.sum() * STRIDE, np.int32), np.zeros(n.sum() * STRIDE, np.float32), np.zeros(n.sum(), bool), np.zeros(0))
        out.cell[place], out.weight[place] = cell, weight
        out.cell, out.weight = out.cell.reshape(-1, STRIDE), out.weight.reshape(-1, STRIDE)
        out.last[after[n > 0] - 1] = True
        mass = np.einsum("ij,ij->i", out.weight, out.weight)
        mass[:-1] += np.where(out.last[:-1], 0, mass[1:])
        begins = ~out.last | np.repeat(n == 1, n)
        out.scale = np.where(begins, 1 / np.sqrt(np.maximum(mass, 1e-12)), 0).astype(np.float32)
        return out


def _stretches(batches: Iterator[pa.RecordBatch], rows: Rows, most: int) -> Iterator[Halves]:
    """The halves of the texts, about ``most`` together (more, if a single batch of texts has them)."""
    held: list[Halves] = []
    size = 0

    def joined() -> Halves:
        return Halves(*(np.concatenate([getattr(h, k) for h in held]) for k in ("cell", "weight", "last", "scale")))

    for batch in batches:
        column = batch.column(0)
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) // 4
        if len(column):
            held.append(rows.halves(np.frombuffer(data, np.uint32, int(ends[-1]))[ends[0] :], ends - ends[0]))
            size += len(held[-1].last)
        if size >= most:
            yield joined()
            held, size = [], 0
    if held:
        yield joined()


def _folded(h: Halves, lines: int, size: int, rng: np.random.Generator) -> np.ndarray:
    """All passages of the halves, each with a random sign, added up in so many random lines: a sketch whose square is that of the passages on average."""
    line = rng.integers(0, lines, len(h.last)) * size
    value = h.scale * rng.choice(np.array([-1, 1], np.float32), len(h.last))
    more = np.flatnonzero(~h.last)
    at = np.concatenate([line[:, None] + h.cell, line[more, None] + h.cell[more + 1]])
    by = np.concatenate([value[:, None] * h.weight, value[more, None] * h.weight[more + 1]])
    return np.bincount(at.ravel(), by.ravel(), lines * size).astype(np.float32).reshape(lines, size)


def _seen(h: Halves, basis: np.ndarray) -> Iterator[np.ndarray]:
    """The passages of the halves times ``basis``, ``TOGETHER`` halves at a time."""
    for a in range(0, len(h.last), TOGETHER):
        b = min(a + TOGETHER, len(h.last))
        c = min(b + 1, len(h.last))
        each = np.matmul(h.weight[a:c, None, :], np.take(basis, h.cell[a:c], axis=0))[:, 0]
        out, more = each[: b - a].copy(), np.flatnonzero(~h.last[a:b])
        out[more] += each[more + 1]
        yield out * h.scale[a:b, None]


def latent_space(words: DataFrame, bench: tuple[np.ndarray, np.ndarray, np.ndarray], terms: Terms, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors over singular values (terms and buckets x rank), and each row's share of the vectors."""
    spark = words.sparkSession
    size = len(terms.hashes) + OTHERS
    wide = min(size, rank + EXTRA)
    lines = max(wide, min(LINES, CELLS // size))
    thin = np.linalg.qr(np.random.default_rng(6).standard_normal((size, wide)))[0].astype(np.float32)
    held = spark.sparkContext.broadcast((Rows(terms), thin))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, thin = held.value
        rng = np.random.default_rng([6, TaskContext.get().partitionId()])
        total, n = np.zeros((size, wide), np.float32), 0
        for halves in _stretches(batches, rows, FOLD * lines):
            for a in range(0, len(halves.last), FOLD * lines):
                # A passage over the cut begins in its first half, so one half more is there without beginning another.
                b = min(a + FOLD * lines, len(halves.last))
                c = min(b + 1, len(halves.last))
                scale = halves.scale[a:c].copy()
                scale[b - a :] = 0
                last = halves.last[a:c].copy()
                last[b - a :] = True
                folded = _folded(Halves(halves.cell[a:c], halves.weight[a:c], last, scale), lines, size, rng)
                total += folded.T @ (folded @ thin)
            n += int((halves.scale > 0).sum())
        if n:
            cuts = range(0, size, _ROWS)
            yield pa.RecordBatch.from_arrays([pa.array([-1, *cuts], pa.int32()), pa.array([np.array([n], np.float64).tobytes(), *(total[c : c + _ROWS].tobytes() for c in cuts)], pa.binary())], ["at", "cells"])

    def summed(task: Callable, kind: type) -> list[Row]:
        """The sums of what the tasks give for each place: a fixed number of rows, of the size of the basis together."""

        def add(group: pa.Table) -> pa.Table:
            at = group.column("at").slice(0, 1)
            cells = sum(np.frombuffer(x.as_py(), np.float64 if at[0].as_py() < 0 else kind) for x in group.column("cells"))
            return pa.table({"at": at, "cells": pa.array([cells.tobytes()], pa.binary())})

        # As many parts as there are tasks, which go by the cluster and not by the input.
        tasks = max(4 * spark.sparkContext.defaultParallelism, shuffle_partitions(spark))
        return words.coalesce(tasks).mapInArrow(task, "at int, cells binary").groupBy("at").applyInArrow(add, "at int, cells binary").collect()

    out, n = np.zeros((size, wide), np.float32), 0.0
    for r in summed(part, np.float32):
        if r["at"] < 0:
            n = float(np.frombuffer(r["cells"], np.float64)[0])
        else:
            out[r["at"] : r["at"] + _ROWS] += np.frombuffer(r["cells"], np.float32).reshape(-1, wide)
    # The benchmark has few passages; its half weighs as much as the documents'.
    own = np.float32(max(1.0, n / (int(bench[0][-1]) + 1)))
    basis = np.linalg.qr(out + own * _gram(*bench, thin))[0].astype(np.float32)
    held.unpersist()
    spread = spark.sparkContext.broadcast((Rows(terms), basis))

    def square(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, basis = spread.value
        total = np.zeros((wide, wide))
        for halves in _stretches(batches, rows, TOGETHER):
            for seen in _seen(halves, basis):
                total += seen.T @ seen
        yield pa.RecordBatch.from_arrays([pa.array(range(wide), pa.int32()), pa.array([x.tobytes() for x in total], pa.binary())], ["at", "cells"])

    seen = _dense(*bench, basis).astype(np.float64)
    whole = own * (seen.T @ seen)
    for r in summed(square, np.float64):
        whole[r["at"]] += np.frombuffer(r["cells"])
    spread.unpersist()
    values, vectors = np.linalg.eigh(whole)
    vectors = (basis @ vectors[:, ::-1][:, :rank]).astype(np.float32)
    scale = np.sqrt(np.maximum(values[::-1][:rank], 1e-9)).astype(np.float32)
    return np.ascontiguousarray(vectors / scale), (vectors**2).sum(axis=1)


def fit(words: DataFrame, items: list[Item], terms: Terms) -> Model:
    """The model of a block of items, given the words of all texts; ``terms`` holds the items' words alone."""
    bench = _rows(np.concatenate([i.words for i in items]), np.concatenate([[0], np.cumsum([len(i.words) for i in items])]), terms)
    item_of, first, _ = windows(np.concatenate([[0], np.cumsum([len(i.words) for i in items])]))
    space, share = latent_space(words, bench, terms, min(RANK, max(1, len(first) // 2)))
    return Model(items, terms, space, share >= share.mean(), _unit(_dense(*bench, space)), item_of, markers(items, terms))


def common(item: np.ndarray, region: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over the item's words."""
    places: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        places[w] = places.get(w, 0) | (1 << i)
    full = (1 << len(item)) - 1
    row = full
    for w in region.tolist():
        hit = places.get(w)
        if hit is not None:
            u = row & hit
            row = ((row + u) | (row - u)) & full
    return len(item) - row.bit_count()


def holds(region: np.ndarray, part: np.ndarray) -> bool:
    """Whether ``part`` stands in ``region`` word for word."""
    at = np.flatnonzero(region[: max(0, len(region) - len(part) + 1)] == part[0]) if len(part) else []
    return any((region[i : i + len(part)] == part).all() for i in at)


def confirm(out: dict[object, float], item: Item, region: np.ndarray, alike: float = ALIKE) -> None:
    """Enters the item, with the share of its words, if the region contains it."""
    share = common(item.words, region) / len(item.words)
    if share >= SAME or (share >= alike and len(item.answer) and holds(region, item.answer)):
        out[item.key] = max(out.get(item.key, 0), share)


def retrieved(cell: np.ndarray, weight: np.ndarray, ends: np.ndarray, model: Model) -> Iterator[tuple[int, int, int, int]]:
    """(text, first word, end, item) of the passages near one of the item's in the latent space, once each."""
    text, first, end = windows(ends)
    square = weight.astype(np.float64) ** 2
    mass = np.concatenate([[0], np.cumsum(square)])
    own = np.concatenate([[0], np.cumsum(np.where(model.known[cell], square, 0))])
    total = mass[end] - mass[first]
    live = np.flatnonzero((own[end] - own[first] >= LIVE * total) & (total > 0))
    for a in range(0, len(live), AT_ONCE):
        part = live[a : a + AT_ONCE]
        size = end[part] - first[part]
        row = np.repeat(np.arange(len(part)), size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[part], size)
        cosine = _unit(_dense(row, cell[at], weight[at], model.space)) @ model.passages.T
        w, p = np.nonzero(cosine >= COSINE)
        for x, i in np.unique(np.stack([w, model.item_of[p]], axis=1), axis=0).tolist():
            yield int(text[part[x]]), int(first[part[x]]), int(end[part[x]]), i


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers first .. first + n - 1 of every entry."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def marked(found: np.ndarray, term: np.ndarray, ends: np.ndarray, model: Model) -> Iterator[tuple[int, int, float, list[tuple[int, int]]]]:
    """(text, item, least share, regions) of the stretches of ``STRIDE`` words with an answer, or with enough markers of the item around.

    Regions are the surroundings, as the check takes them, of the passages whose surroundings reach into the stretch.
    """
    m = model.markers
    long = np.array([len(i.words) for i in model.items])

    def stretches(at: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, ...]:
        """Text, item, first and last passage of each stretch, and where its regions begin and end."""
        text = np.searchsorted(ends, at, side="right") - 1
        text, item, block = np.unique(np.stack([text, item, (at - ends[text]) // STRIDE]), axis=1)
        size, n = np.diff(ends)[text], long[item]
        last = np.maximum(1, -(-(size - (WINDOW - STRIDE)) // STRIDE)) - 1
        k0, k1 = np.maximum(0, (block * STRIDE - WINDOW - n) // STRIDE + 1), np.minimum(last, (block * STRIDE + STRIDE - 1 + n) // STRIDE)
        return text, item, k0, k1, ends[text] + np.maximum(0, k0 * STRIDE - n), ends[text] + np.minimum(size, k1 * STRIDE + WINDOW + n)

    n = np.where(term >= 0, np.diff(m.first)[term], 0)
    at = np.flatnonzero(n)
    item, at = m.posted[_ranges(m.first[term[at]], n[at])], np.repeat(at, n[at])
    hits = np.sort(item * len(found) + at)
    rows = stretches(at, item)
    enough = np.searchsorted(hits, rows[1] * len(found) + rows[5]) - np.searchsorted(hits, rows[1] * len(found) + rows[4]) >= m.need[rows[1]]
    three = threes(found)
    low = np.searchsorted(m.answers, three)
    n = np.searchsorted(m.answers, three, side="right") - low
    at = np.flatnonzero(n)
    for least, part in ((SAME, [x[enough] for x in rows]), (ALIKE, stretches(np.repeat(at, n[at]), m.answer_of[_ranges(low[at], n[at])]))):
        for t, i, a, b in zip(*(x.tolist() for x in part[:4]), strict=True):
            begin, size, n_ = int(ends[t]), int(ends[t + 1] - ends[t]), len(model.items[i].words)
            yield t, i, least, [(begin + max(0, x * STRIDE - n_), begin + min(size, x * STRIDE + WINDOW + n_)) for x in range(a, b + 1)]


def matches(texts: list[str | None], model: Model) -> list[list[tuple[object, float]]]:
    """For each text the (item, share of its words in common) of the items that it contains."""
    out: list[dict[object, float]] = [{} for _ in texts]
    found, ends = _words(texts)
    if not len(found):
        return [[] for _ in texts]
    term, cell, weight = model.terms.weigh(found)
    for t, first, end, i in retrieved(cell, weight, ends, model):
        item = model.items[i]
        if out[t].get(item.key, 0) < 1:
            confirm(out[t], item, found[max(ends[t], first - len(item.words)) : min(ends[t + 1], end + len(item.words))], LOOSE)
    for t, i, least, around in marked(found, term, ends, model):
        item = model.items[i]
        # All the words at once first.
        if out[t].get(item.key, 0) < 1 and common(item.words, found[around[0][0] : around[-1][1]]) / len(item.words) >= least:
            for low, high in around:
                confirm(out[t], item, found[low:high])
    return [list(x.items()) for x in out]


def vocabulary(benchmark: DataFrame, text_col: str) -> np.ndarray:
    """The hashes of the benchmark's distinct words, in order."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_words(batch.column(0).to_pylist())[0]).view(np.int64))], ["word"])

    return np.sort(benchmark.select(text_col).mapInArrow(words, "word bigint").distinct().toArrow().column("word").to_numpy().view(np.uint64))


def check(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, the ``keep`` columns, contaminated, items (array of item and share of its words) of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    own = benchmark.schema[item_col].dataType
    kind = T.ArrayType(T.StructType([T.StructField("item", own), T.StructField("share", T.DoubleType())]))
    arrow = to_arrow_type(kind)
    names = list(dict.fromkeys([id_col, *keep]))
    rows = docs.select(F.struct(*names).alias("row"), F.col(text_col).alias("text of it"), F.array().cast(kind).alias("items"))
    found = vocabulary(benchmark, item_text_col)
    if len(found):
        terms, words = read_all(docs, found, text_col)
        # Item by item from the executors: the driver holds one block at a time.
        pending = benchmark.select(item_col, item_text_col).orderBy(item_col, item_text_col).toLocalIterator()
        for i, block in enumerate(blocks_of(items_of(map(tuple, pending)))):
            rows = settle(rows, "decontaminated") if i else rows
            shared = spark.sparkContext.broadcast(fit(words, block, terms.only(np.unique(np.concatenate([x.words for x in block])))))
            out = rows.schema

            def run(batches: Iterator[pa.RecordBatch], shared=shared, out=out) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    new = matches(batch.column(1).to_pylist(), shared.value)
                    held = [{x["item"]: x["share"] for x in old} for old in batch.column(2).to_pylist()]
                    for old, more in zip(held, new, strict=True):
                        old.update((k, max(s, old.get(k, 0))) for k, s in more)
                    items = [[{"item": k, "share": s} for k, s in x.items()] for x in held]
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(items, arrow)], out.names)

            rows = rows.mapInArrow(run, out)
    return rows.select("row.*", (F.size("items") > 0).alias("contaminated"), F.array_sort("items").alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item."""
    whole = docs.select(id_col, text_col, F.struct(*docs.columns).alias("whole row"))
    return check(whole, benchmark, id_col=id_col, text_col=text_col, keep=("whole row",)).where(~F.col("contaminated")).select("whole row.*")
