"""Language identification: script ranges, per-word scores, and Viterbi over the words.

Byte n-grams of words, with their ends marked, are counted for each language in all labelled
texts that are learned from; nothing is sampled. All values of lang are learned, up to
the ``LANGUAGES`` commonest (a parameter, ``languages``); the table of n-grams has ``CELLS`` cells at most, with
fewer buckets the more languages there are. A word's score for a language is the
sum of its n-grams' log probabilities, against the mean of the languages that the word's script
leaves; a script is open to a language that writes at least ``SCRIPT_SHARE`` of its words in it. A
Viterbi path with a penalty for each switch labels every word, so mixed texts fall into spans. The
text's language is the one whose spans hold most letters, and the score is their share.

Viterbi runs in lock step over blocks of ``STEP`` words: transfer matrices of all blocks at once,
then the blocks of each text in order, then the paths inside all blocks at once. With more than
``FEW`` languages, for which such matrices are large, it goes word by word over all texts at once.

Defined results: ``und`` with score 0 for a null text or one without a letter, and for every text
if nothing could be learned; rows with null or repeated ids are predicted like others, and rows
with a null id or language are not learned from; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.runtime import shuffle_partitions, small_batches
from weftline.llm.words import PUNCTUATION, Words, blocks, mix

LANGUAGES = 4096
BUCKETS = 1 << 16
CELLS = 1 << 25
FEW = 16
ORDERS = (1, 2, 3, 4, 5)
#: n-grams of several orders overlap; a word's summed evidence counts this much.
SCALE = 0.35
SWITCH = 8.0
SCRIPT_SHARE = 0.01
STEP = 64
_LETTER = re.compile(r"[^\W\d_]")

#: First code points of script ranges, with their scripts (0: Latin and all that is not listed).
_RANGES = [(0x0000, 0), (0x0370, 1), (0x0400, 2), (0x0530, 3), (0x0590, 4), (0x0600, 5), (0x0700, 0), (0x0900, 6), (0x0980, 7), (0x0E00, 8), (0x0E80, 0), (0x10A0, 9), (0x1100, 10), (0x1200, 11), (0x1E00, 0), (0x3040, 12), (0x3100, 0), (0x3400, 13), (0xA000, 0), (0xAC00, 10), (0xD7B0, 0), (0xF900, 13), (0xFB00, 0)]
SCRIPTS = 14
_STARTS = [a for a, _ in _RANGES]


def held_out(id_col: str) -> Column:
    """Whether a row belongs to the fold that nothing learns from; rows without an id do."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def script_of(word: bytes) -> int:
    """The script of a word's first non-ASCII letter, else Latin."""
    for ch in word.decode("utf-8", "ignore"):
        if ch > "\x7f" and ch.isalpha():
            return _RANGES[bisect_right(_STARTS, ord(ch)) - 1][1]
    return 0


@dataclass
class Distinct:
    """The distinct words of a block: where they first stand, n-gram buckets with each word's offsets, scripts, and which have letters."""

    inverse: np.ndarray
    buckets: np.ndarray
    word: np.ndarray
    script: np.ndarray
    letters: np.ndarray


def distinct(block: Words) -> Distinct:
    _, first, inverse = np.unique(block.hashes, return_index=True, return_inverse=True)
    lens = block.lens[first]
    # Each distinct word once, between an opening and a closing mark.
    size = lens + 2
    ends = np.cumsum(size)
    place = np.arange(ends[-1]) - np.repeat(ends - size, size)
    owner = np.repeat(np.arange(len(first)), size)
    inner = (place > 0) & (place <= lens[owner])
    text = np.where(place == 0, 2, 3).astype(np.uint64)
    text[inner] = block.chars[np.repeat(block.starts[first], lens) + place[inner] - 1]
    buckets, words = [], []
    rolled = np.zeros(len(text), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        rolled[: len(text) - n + 1] = rolled[: len(text) - n + 1] * np.uint64(0x100000001B3) + text[n - 1 :] + np.uint64(1)
        if n in ORDERS:
            ok = np.flatnonzero(place + n <= size[owner])
            if n == 1:
                ok = ok[inner[ok]]
            buckets.append((mix(rolled[ok] + np.uint64(n << 50)) & np.uint64(BUCKETS - 1)).astype(np.int64))
            words.append(owner[ok])
    high = np.add.reduceat((text > 127).astype(np.int64), ends - size) > 0
    script = np.zeros(len(first), np.int64)
    alpha = ((text >= 97) & (text <= 122)) | (text > 127)
    letters = np.add.reduceat((alpha & inner).astype(np.int64), ends - size)
    for i in np.flatnonzero(high):
        a = block.starts[first[i]]
        script[i] = script_of(block.chars[a : a + lens[i]].tobytes())
    return Distinct(inverse, np.concatenate(buckets), np.concatenate(words), script, letters)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # BUCKETS x languages, log probabilities
    allowed: np.ndarray  # SCRIPTS x languages

    def word_scores(self, d: Distinct) -> np.ndarray:
        """(distinct words x languages)."""
        n = len(d.letters)
        buckets = d.buckets & (len(self.table) - 1)
        raw = np.stack([np.bincount(d.word, weights=self.table[buckets, k], minlength=n) for k in range(len(self.languages))], axis=1) * SCALE
        open_ = self.allowed[d.script]
        some = open_.any(axis=1)
        mean = np.where(open_, raw, 0).sum(axis=1) / np.maximum(open_.sum(axis=1), 1)
        out = np.where(open_, raw - mean[:, None], -50.0)
        out[~some | (d.letters == 0)] = 0
        return out.astype(np.float32)


def viterbi(scores: np.ndarray, ends: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """The label of every word on each text's best path; ``ends``: offsets of the texts (one more than texts)."""
    n_labels = scores.shape[1]
    if n_labels == 1 or not len(scores):
        return np.zeros(len(scores), np.int64)
    if n_labels > FEW:
        return _word_by_word(scores, ends, penalty)
    sizes = np.diff(ends)
    per_text = -(-sizes // STEP)
    total = int(per_text.sum())
    text_of = np.repeat(np.arange(len(sizes)), per_text)
    rank = np.arange(total) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    begin = ends[:-1][text_of] + rank * STEP
    length = np.minimum(STEP, ends[1:][text_of] - begin)
    at = begin[:, None] + np.arange(STEP)[None, :]
    real = np.arange(STEP)[None, :] < length[:, None]
    steps = np.ascontiguousarray(np.where(real[:, :, None], scores[np.minimum(at, len(scores) - 1)], np.float32(0)).transpose(1, 0, 2))
    # What each block makes of each state that a text may enter it with.
    move = np.full((total, n_labels, n_labels), -np.inf, np.float32)
    move[:, np.arange(n_labels), np.arange(n_labels)] = 0
    for t in range(STEP):
        move = np.maximum(move, move.max(axis=2, keepdims=True) - np.float32(penalty)) + steps[t][:, None, :]
    # The blocks of each text in order.
    entry = np.zeros(total, np.int64)
    leave = np.zeros(total, np.int64)
    first = np.cumsum(per_text) - per_text
    value = np.zeros((len(sizes), n_labels), np.float64)
    back = np.zeros((total, n_labels), np.int64)
    order = np.argsort(-per_text, kind="stable")
    live = np.searchsorted(-per_text[order], -np.arange(1, int(per_text.max(initial=0)) + 1), side="right")
    for b, n in enumerate(live):
        texts = order[:n]
        ways = value[texts][:, :, None] + move[first[texts] + b]
        back[first[texts] + b] = ways.argmax(axis=1)
        value[texts] = ways.max(axis=1)
    state = value.argmax(axis=1)
    for b in range(len(live) - 1, -1, -1):
        texts = order[: live[b]]
        leave[first[texts] + b] = state[texts]
        state[texts] = back[first[texts] + b, state[texts]]
        entry[first[texts] + b] = state[texts]
    # The path inside every block, between the states it is entered and left with.
    came = np.zeros((STEP, total, n_labels), np.uint8)
    now = np.full((total, n_labels), -np.inf, np.float32)
    now[np.arange(total), entry] = 0
    own = np.arange(n_labels, dtype=np.uint8)[None, :]
    for t in range(STEP):
        most, which = now.max(axis=1) - np.float32(penalty), now.argmax(axis=1).astype(np.uint8)
        stay = now >= most[:, None]
        came[t] = np.where(stay, own, which[:, None])
        now = np.where(stay, now, most[:, None]) + steps[t]
    labels = np.zeros((total, STEP), np.int64)
    state = leave
    for t in range(STEP - 1, -1, -1):
        labels[:, t] = state
        state = came[t, np.arange(total), state].astype(np.int64)
    return labels[real]


def _word_by_word(scores: np.ndarray, ends: np.ndarray, penalty: float) -> np.ndarray:
    """As ``viterbi``, for any number of labels: the next word of all texts at once."""
    sizes, n_labels = np.diff(ends), scores.shape[1]
    order = np.argsort(-sizes, kind="stable")
    live = np.searchsorted(-sizes[order], -np.arange(1, int(sizes.max(initial=0)) + 1), side="right")
    value = np.zeros((len(sizes), n_labels))
    stay, which = np.zeros((len(scores), -(-n_labels // 8)), np.uint8), np.zeros(len(scores), np.int32)
    for t, n in enumerate(live):
        texts = order[:n]
        at, now = ends[texts] + t, value[texts]
        most, kept = now.max(axis=1) - penalty, now >= now.max(axis=1, keepdims=True) - penalty
        which[at], stay[at] = now.argmax(axis=1), np.packbits(kept, axis=1)
        value[texts] = np.where(kept, now, most[:, None]) + scores[at]
    labels, state = np.zeros(len(scores), np.int64), value.argmax(axis=1)
    for t in range(len(live) - 1, -1, -1):
        texts = order[: live[t]]
        at, now = ends[texts] + t, state[texts]
        labels[at] = now
        state[texts] = np.where(stay[at, now >> 3] >> (7 - (now & 7)) & 1, now, which[at])
    return labels


def _words(texts: list[str]) -> Iterator[Words]:
    return blocks([t.lower() for t in texts], PUNCTUATION)


def learn(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", languages: int = LANGUAGES) -> Model | None:
    """A model of the languages of the rows that aren't held out; None if there are none."""
    small_batches(docs.sparkSession)
    known = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    known = known.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages + 1).collect()
    if not counts:
        return None
    names = sorted(r.lang for r in counts[:languages])
    if len(counts) > languages:
        known = known.where(F.array_contains(F.lit(names), F.col("lang")))
    size = BUCKETS
    while size * len(names) > CELLS:
        size //= 2
    # As many partial tables as there are tasks, which go by the cluster and not by the input.
    chosen = known.select("lang", "text").coalesce(max(4 * docs.sparkSession.sparkContext.defaultParallelism, shuffle_partitions(docs.sparkSession)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in set(langs):
                mine = [t for k, t in zip(langs, texts, strict=True) if k == lang]
                for block in _words(mine):
                    if len(block.hashes):
                        d = distinct(block)
                        times = np.bincount(d.inverse, minlength=len(d.letters)) * (d.letters > 0)
                        grams[lang] = grams.get(lang, 0) + np.bincount(d.buckets & (size - 1), weights=times[d.word], minlength=size)
                        scripts[lang] = scripts.get(lang, 0) + np.bincount(d.script, weights=times, minlength=SCRIPTS)
        for lang, seen in grams.items():
            cells = np.concatenate([seen, scripts[lang]])
            full = np.flatnonzero(cells)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(full), pa.string()), pa.array(full, pa.int32()), pa.array(cells[full].astype(np.int64), pa.int64())], ["lang", "cell", "n"])

    # At most CELLS cells and the scripts', whatever the input.
    cells = chosen.mapInArrow(count, "lang string, cell int, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    table, scripts = np.zeros((size, len(names)), np.float32), np.zeros((SCRIPTS, len(names)))
    place = {k: i for i, k in enumerate(names)}
    column = np.array([place[k] for k in cells.column("lang").to_pylist()], np.int64)
    cell, n = cells.column("cell").to_numpy(), cells.column("n").to_numpy()
    gram = cell < size
    table[cell[gram], column[gram]] = n[gram]
    scripts[cell[~gram] - size, column[~gram]] = n[~gram]
    # Every order of n-grams has about as many occurrences, so one total serves all.
    total = table.sum(axis=0, dtype=np.float64) + 0.5 * size
    table += np.float32(0.5)
    np.log(table, out=table)
    table -= np.log(total).astype(np.float32)
    return Model(names, table, scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1))


def label(texts: list[str | None], model: Model | None) -> Iterator[tuple[str, float, list[tuple[int, int, str]]]]:
    """(language, score, spans) of each text; a span is its first word, its number of words and its language."""
    clean = [t or "" for t in texts]
    n = len(clean)
    weight = np.zeros((n, len(model.languages) if model else 1))
    parts: list[list[np.ndarray]] = [[] for _ in range(n)]
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if model is not None:
        for block in _words(clean):
            if len(block.hashes):
                d = distinct(block)
                held.append((block.doc, model.word_scores(d)[d.inverse], d.letters[d.inverse]))
    if held:
        doc, scores, letters = (np.concatenate([h[i] for h in held]) for i in range(3))
        ends = np.searchsorted(doc, np.arange(n + 1))
        labels = viterbi(scores, ends)
        weight = np.bincount(doc * len(model.languages) + labels, weights=letters, minlength=n * len(model.languages)).reshape(n, -1)
        parts = [labels[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    for i, text in enumerate(clean):
        if model is None or not weight[i].sum() or not _LETTER.search(text):
            yield "und", 0.0, []
            continue
        best = int(weight[i].argmax())
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(parts[i])) + 1, [len(parts[i])]])
        yield model.languages[best], float(weight[i][best] / weight[i].sum()), [(int(a), int(b - a), model.languages[parts[i][a]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def identify(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, the ``keep`` columns, held_out, lang_pred, score and spans (array of first word, words, lang) of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    own = dict.fromkeys([id_col, *keep])
    span = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("words", T.IntegerType()), T.StructField("lang", T.StringType())]))
    fields = [T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", span)]
    out = T.StructType([*(docs.schema[c] for c in own), *fields])
    kind = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(label(batch.column(len(own) + 1).to_pylist(), shared.value))
            spans = pa.array([[{"first": a, "words": b, "lang": c} for a, b, c in f[2]] for f in found], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(own) + 1], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), spans], out.names)

    return docs.select(*own, held_out(id_col).alias("held out"), F.col(text_col).alias("text of it")).mapInArrow(run, out)


def accepted(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in a known language; those without a letter (``und``) go, and only those if there is no model."""
    if model is None:
        return docs.where(F.col(text_col).rlike(r"\p{L}"))
    whole = docs.select(id_col, text_col, F.struct(*docs.columns).alias("whole row"))
    return identify(whole, model, id_col=id_col, text_col=text_col, keep=("whole row",)).where(F.col("lang_pred") != "und").select("whole row.*")
