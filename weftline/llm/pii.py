"""Personal data: exact base rules, and a skip-chain conditional random field that adds spans.

Nodes are the words with a digit or an at sign; labels are the kinds and none. Local potentials
are log-linear in the word's shape; neighbouring words share a chain potential; a word that repeats
an earlier one (equal characters, or equal long digits) shares a skip potential with its last
occurrence, however far, so edges stay as many as words. Words inside base spans are observed with
their kind. Loopy belief propagation, until messages rest (within ``REST``), makes labels agree over a
document of any length, and words whose marginal
for a kind is at least ``SURE`` become further spans, joined where they stand side by side.

All potentials are learned jointly, by the pseudo-likelihood of each word's label given its shape and
its neighbours' labels, from a bounded sample of texts (``SAMPLE`` at most, by a hash of id and text)
with the base rules as labels. Base spans never depend on them.

The work on a text is linear in its length: every rule passes over a character a bounded number of
times, edges are as many as words, and a sweep of messages goes once along all words and back.

Defined results: a null text is an empty one and has no spans; rows with null or repeated ids are
each scanned, and equal rows are learned from once; offsets count code points; an empty table gives an
empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.runtime import bounded_sample, small_batches

SAMPLE = 4000
SURE = 0.9
#: Messages that change less than this in a sweep are at rest.
REST = 1e-4
#: One sweep carries messages along any stretch of text, so only loops need many; these damp the ones that swing.
SWEEPS = 60
DAMPED_AFTER = 6
DAMPING = 0.5
KINDS = ("email", "ip", "card", "phone")
_N = len(KINDS) + 1

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No match can begin inside a run of digits that an earlier start would have matched too.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NODE = re.compile(r"[0-9@]")
_BREAK = re.compile(r"\s")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The matches of the email rule: every sign with the run of characters before it and the domain after it."""
    end, at = 0, text.find("@")
    while at >= 0:
        a = at
        # A sign isn't in a run, so no character is passed twice.
        while a > end and text[a - 1] in _LOCAL:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        end = m.end() if m else at + 1
        if m:
            yield a, end
        at = text.find("@", end)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base rules' matches, by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGITS.search(text) is None:
        return out
    if "." in text:
        # A bound on the parts' length keeps the conversion short.
        out.extend((1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        out.extend((3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_DIGITS.findall(m[0])) <= 15)
    return out


def nodes(text: str) -> list[tuple[int, int]]:
    """(start, end) of the words with a digit or an at sign, without signs at their ends."""
    out, at = [], _NODE.search(text)
    while at:
        a = at.start()
        while a > 0 and not text[a - 1].isspace():
            a -= 1
        stop = _BREAK.search(text, at.end())
        b = stop.start() if stop else len(text)
        first, last = a, b
        while first < last and not (text[first].isalnum() or text[first] in "+("):
            first += 1
        while last > first and not (text[last - 1].isalnum() or text[last - 1] == ")"):
            last -= 1
        if last > first:
            out.append((first, last))
        at = _NODE.search(text, b)
    return out


FEATURES = 27


def shape(word: str, near: bool) -> int:
    """The word's features as a bit set."""
    digits = _DIGITS.findall(word)
    n, dots = len(digits), word.count(".")
    bits = 1
    bits |= ("@" in word) << 1 | ("@" in word and "." in word.rpartition("@")[2]) << 2 | word.startswith("+") << 3
    bits |= 1 << (4 + sum(n > x for x in (0, 2, 4, 7, 10, 12, 15, 19)))  # 4 .. 12
    bits |= 1 << (13 + min(dots, 4))  # 13 .. 17
    bits |= any(c.isalpha() for c in word) << 18 | ("(" in word or ")" in word) << 19 | ("-" in word) << 20 | any(c in "=:;\"'" for c in word) << 21
    parts = word.split(".")
    bits |= (len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)) << 22
    bits |= (16 <= n <= 19 and luhn("".join(digits))) << 23 | (n == len(word)) << 24 | near << 25 | (len(word) > 24) << 26
    return bits


@dataclass
class Graph:
    """A document's nodes, their shapes, what the base rules say of them (0: nothing), and the two kinds of edges."""

    spans: list[tuple[int, int]]
    shapes: list[int]
    seen: list[int]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def covered(spans: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[int]:
    """For each span the kind, from 1, of the first base span (by start, then kind) that it overlaps, else 0."""
    of_kind = [sorted((a, b) for kind, a, b in base if kind == k) for k in range(len(KINDS))]
    at, out = [0] * len(KINDS), []
    for x, y in spans:
        first = None
        # Spans of one kind don't overlap, so one pointer a kind moves on with the words.
        for k, own in enumerate(of_kind):
            while at[k] < len(own) and own[at[k]][1] <= x:
                at[k] += 1
            if at[k] < len(own) and own[at[k]][0] < y and (first is None or own[at[k]][0] < first[0]):
                first = own[at[k]][0], k + 1
        out.append(first[1] if first else 0)
    return out


def graph(text: str, base: list[tuple[int, int, int]]) -> Graph:
    spans = nodes(text)
    chain = [(i - 1, i) for i in range(1, len(spans)) if spans[i][0] - spans[i - 1][1] <= 2]
    near = {j for _, j in chain}
    last: dict[str, int] = {}
    skip = set()
    for i, (a, b) in enumerate(spans):
        word = text[a:b].lower()
        digits = "".join(_DIGITS.findall(word))
        for key in {word, "#" + digits if len(digits) >= 7 else word}:
            if len(key) >= 6:
                if key in last and not (last[key] == i - 1 and i in near):
                    skip.add((last[key], i))
                last[key] = i
    return Graph(spans, [shape(text[a:b], i in near) for i, (a, b) in enumerate(spans)], covered(spans, base), chain, sorted(skip))


def _bits(shapes: list[int] | np.ndarray) -> np.ndarray:
    return (np.array(shapes, np.int64)[:, None] >> np.arange(FEATURES)) & 1


@dataclass
class Field:
    local: np.ndarray  # FEATURES x labels
    chain: np.ndarray  # labels x labels
    skip: np.ndarray

    def marginals(self, g: Graph) -> np.ndarray:
        """(nodes x labels) by sum-product over chain and skip edges."""
        own = _bits(g.shapes) @ self.local
        own = np.exp(own - own.max(axis=1, keepdims=True))
        seen = np.array(g.seen)
        own[seen > 0] = 0
        own[seen > 0, seen[seen > 0]] = 1
        pair = [np.exp(self.chain - self.chain.max())] * len(g.chain) + [np.exp(self.skip - self.skip.max())] * len(g.skip)
        edges = g.chain + g.skip
        # What each end of an edge hears from the other: at 2e the later end, at 2e + 1 the earlier.
        heard = np.full((2 * len(edges), _N), 1 / _N)
        onward: list[list[tuple[int, int, np.ndarray]]] = [[] for _ in g.spans]
        back: list[list[tuple[int, int, np.ndarray]]] = [[] for _ in g.spans]
        ears: list[list[int]] = [[] for _ in g.spans]
        for e, ((a, b), p) in enumerate(zip(edges, pair, strict=True)):
            for m, i, j, p_ in ((2 * e, a, b, p), (2 * e + 1, b, a, p.T)):
                if g.seen[i]:
                    # An observed word says the same for ever.
                    heard[m] = p_[g.seen[i]] / p_[g.seen[i]].sum()
                elif not g.seen[j]:
                    (onward if i == a else back)[i].append((m, m ^ 1, p_))
                if not g.seen[j]:
                    ears[j].append(m)
        # Words that hear someone and have someone to tell; the others are settled already.
        first, second = [i for i, x in enumerate(onward) if x], [i for i, x in reversed(list(enumerate(back))) if x]
        for sweep in range(SWEEPS if first else 0):
            moved = 0.0
            for nodes_, out in ((first, onward), (second, back)):
                for i in nodes_:
                    for m, other, p in out[i]:
                        told = own[i]
                        for x in ears[i]:
                            if x != other:
                                told = told * heard[x]
                        new = told @ p
                        new = new / new.sum()
                        if sweep >= DAMPED_AFTER:
                            new = DAMPING * heard[m] + (1 - DAMPING) * new
                        moved = max(moved, float(np.abs(new - heard[m]).max()))
                        heard[m] = new
            if moved < REST:
                break
        for i, xs in enumerate(ears):
            for x in xs:
                own[i] = own[i] * heard[x]
                own[i] /= own[i].sum()
        return own / own.sum(axis=1, keepdims=True)


def added_spans(text: str, base: list[tuple[int, int, int]], field: Field | None) -> list[tuple[int, int, int]]:
    """What the field adds: (kind number, start, end), clear of the base spans."""
    if field is None or _NODE.search(text) is None:
        return []
    g = graph(text, base)
    if not g.spans or all(g.seen) or not (g.skip or g.chain or base):
        # Words that nothing connects to an observed one keep what the base rules decided.
        return []
    odds = field.marginals(g)
    out: list[tuple[int, int, int]] = []
    for (a, b), seen, own in zip(g.spans, g.seen, odds, strict=True):
        kind = int(own[1:].argmax())
        if seen or own[kind + 1] < SURE:
            continue
        if out and out[-1][0] == kind and a - out[-1][2] <= 1:
            out[-1] = (kind, out[-1][1], b)
        else:
            out.append((kind, a, b))
    return out


def fitted(rows: list[tuple[int, int, tuple[int, ...], tuple[int, ...], float]]) -> Field:
    """Local, chain and skip potentials at once, by penalised pseudo-likelihood.

    A row is a word's shape, its label, how many chain and skip neighbours of each label it has, and how often that occurs.
    """
    x = np.concatenate([_bits([r[0] for r in rows]), np.array([r[2] for r in rows]), np.array([r[3] for r in rows])], axis=1).astype(float)
    truth, weight = np.eye(_N)[[r[1] for r in rows]], np.sqrt(np.array([r[4] for r in rows]))
    held = np.zeros((x.shape[1], _N))
    steps = np.zeros_like(held)
    for _ in range(400):
        score = x @ held
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        slope = x.T @ (weight[:, None] * (truth - p)) / weight.sum() - 1e-3 * held
        # Steps shrink where slopes have been steep; an edge has no direction, so its potential is symmetric.
        steps += slope**2
        held += 0.3 * slope / (np.sqrt(steps) + 1e-6)
        for a in (FEATURES, FEATURES + _N):
            held[a : a + _N] = np.clip((held[a : a + _N] + held[a : a + _N].T) / 2, -4, 4)
    return Field(held[:FEATURES], held[FEATURES : FEATURES + _N], held[FEATURES + _N :])


def learn(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Field | None:
    """Potentials from a sample's base spans; None if it has no node."""
    small_batches(docs.sparkSession)
    useful = docs.where(F.col(text_col).rlike("[0-9@]")).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen = bounded_sample(useful, sample, 9, "pii-sample").select("text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[tuple[int, int, tuple[int, ...], tuple[int, ...]]] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                g = graph(text, base_spans(text))
                near = np.zeros((2, len(g.spans), _N), int)
                for kind, edges in enumerate((g.chain, g.skip)):
                    for a, b in edges:
                        near[kind, a, g.seen[b]] += 1
                        near[kind, b, g.seen[a]] += 1
                held.update(zip(g.shapes, g.seen, map(tuple, near[0].tolist()), map(tuple, near[1].tolist()), strict=True))
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*(pa.array([list(k[i]) if i > 1 else k[i] for k in held], kind) for i, kind in enumerate(kinds)), pa.array(list(held.values()), pa.int64())], ["shape", "label", "chain", "skip", "n"])

    # The rows are at most the nodes of the bounded sample.
    rows = chosen.mapInArrow(count, "shape bigint, label bigint, chain array<bigint>, skip array<bigint>, n bigint").groupBy("shape", "label", "chain", "skip").agg(F.sum("n").alias("n")).collect()
    return fitted(sorted((r["shape"], r.label, tuple(r.chain), tuple(r.skip), float(r.n)) for r in rows)) if rows else None


def find(docs: DataFrame, field: Field | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, base and all spans of every row (arrays of kind, start, end), by start, then kind as listed."""
    return _map(docs, field, id_col, text_col, _SPANS, lambda base, full: ([_row(s) for s in base], [_row(s) for s in full]))


def digests(docs: DataFrame, field: Field | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, a count for each base kind, the digest of the base spans, and all spans as a string, by kind, then start."""
    join = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))

    def row(base: list, full: list) -> tuple:
        return (*(sum(s[0] == k for s in base) for k in range(len(KINDS))), hashlib.sha256(join(base).encode()).hexdigest(), join(full))

    fields = [*(T.StructField(f"n_{k}", T.LongType()) for k in KINDS), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    return _map(docs, field, id_col, text_col, fields, row)


_SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_SPANS = [T.StructField("base", _SPAN), T.StructField("spans", _SPAN)]


def _row(span: tuple[int, int, int]) -> dict:
    return {"kind": KINDS[span[0]], "start": span[1], "end": span[2]}


def _map(docs: DataFrame, field: Field | None, id_col: str, text_col: str, fields: list[T.StructField], row) -> DataFrame:
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    out = T.StructType([docs.schema[id_col], *fields])
    arrow = {"bigint": pa.int64(), "string": pa.string(), _SPAN.simpleString(): pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                found.append(row(base, sorted(base + added_spans(text or "", base, shared.value), key=lambda s: (s[1], s[0]))))
            columns = zip(*found, strict=True) if found else [[] for _ in fields]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), arrow[f.dataType.simpleString()]) for c, f in zip(columns, fields, strict=True))], out.names)

    return docs.select(id_col, text_col).mapInArrow(run, out)
