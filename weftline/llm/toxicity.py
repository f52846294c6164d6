"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of a lexicon of words and word beginnings, closeness of its hits to
words of the second person, rates of capitals, punctuation and obfuscation. The lexicon has a
short fixed part and a part learned from labels: words and beginnings of 4 to 7 bytes that stand
in many more toxic than other texts.

Labels are learned from a bounded sample of the rows outside the held-out fold: the texts of at most
``POSITIVE`` and ``NEGATIVE`` ids, as many texts in all, weighted back to their true shares, and dealt into
three parts, one each for the lexicon (its ``LEXICON`` strongest keys), the trees and the calibration.
All rows are scored.

Defined results: a null text is an empty one and gets the score of its features (all zero); with no
labels of both kinds every score is 0; rows with null ids are scored and never learned from; of
several labels of one id a toxic one counts; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm import boosting
from weftline.llm.language_id import held_out
from weftline.llm.runtime import bounded_sample, settle, small_batches
from weftline.llm.words import PUNCTUATION, Words, blocks, hash_of

POSITIVE = 4000
NEGATIVE = 8000
LEXICON = 2048
PREFIXES = (4, 5, 6, 7)
LEAST_TEXTS = 3
LEAST_ODDS = 2.0

#: A fixed start of the lexicon: common insults of several languages.
INSULTS = ("idiot", "moron", "stupid", "scum", "trash", "loser", "pathetic", "disgusting", "worthless", "imbecile", "dumb", "jerk", "idiota", "estúpido", "basura", "imbécil", "débile", "crétin", "ordure", "dummkopf", "trottel", "abschaum", "vollidiot")
#: Words of the second person.
YOU = ("you", "your", "yours", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "sie", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "tú", "ti", "usted", "ustedes", "vosotros")

FEATURES = ("fixed", "learned", "learned_sum", "learned_most", "begun", "you", "near", "near_mean", "capitals", "shouted", "punctuation", "exclaimed", "digits", "mixed", "signs_inside", "stretched", "single", "length")

_byte = np.arange(256)
_UPPER = (_byte >= 65) & (_byte <= 90)
_LETTER = _UPPER | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 128)
_DIGIT = (_byte >= 48) & (_byte <= 57)
_SPACE = (_byte == 32) | ((_byte >= 9) & (_byte <= 13))
_SIGN = (_byte < 128) & (_byte > 32) & ~_LETTER & ~_DIGIT
_BANG = (_byte == 33) | (_byte == 63)
_MASKS = np.array([ord(c) for c in "*@$#%&^~|+="])
_MASK = np.isin(_byte, _MASKS)


@dataclass
class Lexicon:
    keys: np.ndarray  # sorted hashes
    odds: np.ndarray

    def look(self, hashes: np.ndarray) -> np.ndarray:
        """The odds of each hash; 0 if it isn't there."""
        if not len(self.keys):
            return np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.odds[at], 0.0)


_FIXED = Lexicon(np.sort(np.array([hash_of(w) for w in INSULTS], np.uint64)), np.ones(len(INSULTS)))
_YOU = np.sort(np.array([hash_of(w) for w in YOU], np.uint64))


def features(texts: list[str | None], lexicon: Lexicon) -> np.ndarray:
    """(texts x FEATURES)."""
    n = len(texts)
    sums = np.zeros((n, 20))
    most, near_most = np.zeros(n), np.zeros(n)

    def add(column: int, doc: np.ndarray, value: np.ndarray | None = None) -> None:
        sums[:, column] += np.bincount(doc, value, minlength=n)

    for b in blocks(texts, PUNCTUATION):
        size = np.diff(np.append(b.bounds, len(b.raw)))
        owner = np.repeat(b.docs, size)
        raw = b.raw
        for column, table in ((8, _LETTER), (9, _UPPER), (10, _SIGN), (11, _BANG), (12, _DIGIT), (19, ~_SPACE)):
            add(column, owner[table[raw]])
        # A masking sign between two letters, and three equal letters in a row, hide a word.
        if len(raw) > 2:
            inside = _MASK[raw[1:-1]] & _LETTER[raw[:-2]] & _LETTER[raw[2:]]
            add(14, owner[1:-1][inside])
            long = (raw[1:-1] == raw[:-2]) & (raw[1:-1] == raw[2:]) & _LETTER[raw[1:-1]]
            add(15, owner[1:-1][long])
        if not len(b.hashes):
            continue
        doc = b.doc
        digit = np.add.reduceat(_DIGIT[b.chars].astype(np.int64), b.starts)
        upper = _UPPER[raw[b.at]] & _UPPER[raw[np.minimum(b.at + b.lens - 1, len(raw) - 1)]] & (b.lens > 2)
        fixed, whole = _FIXED.look(b.hashes), lexicon.look(b.hashes)
        begun = np.zeros(len(b.hashes))
        for size_ in PREFIXES:
            begun = np.maximum(begun, lexicon.look(b.prefixes(size_)))
        hit = (fixed > 0) | (whole > 0) | (begun > 0)
        you = np.isin(b.hashes, _YOU)
        add(0, doc[fixed > 0])
        add(1, doc[whole > 0])
        add(2, doc, np.maximum(whole, begun))
        np.maximum.at(most, doc, np.maximum(whole, begun))
        add(4, doc[begun > 0])
        add(5, doc[you])
        add(13, doc[(digit > 0) & (digit < b.lens)])
        add(16, doc[b.lens == 1])
        add(17, doc)
        add(18, doc[upper])
        if hit.any() and you.any():
            at, yours = np.flatnonzero(hit), np.flatnonzero(you)
            after = np.searchsorted(yours, at)
            close = np.zeros(len(at))
            for side in (np.minimum(after, len(yours) - 1), np.maximum(after - 1, 0)):
                same = doc[yours[side]] == doc[at]
                close = np.maximum(close, np.where(same, 1 / (1 + np.abs(yours[side] - at)), 0))
            np.maximum.at(near_most, doc[at], close)
            add(7, doc[at], close)
    words, shown, letters = np.maximum(sums[:, 17], 1), np.maximum(sums[:, 19], 1), np.maximum(sums[:, 8], 1)
    hits = np.maximum(sums[:, 0] + sums[:, 1] + sums[:, 4], 1)
    return np.stack(
        [
            sums[:, 0] / words, sums[:, 1] / words, np.log1p(sums[:, 2]), most, sums[:, 4] / words, sums[:, 5] / words, near_most, sums[:, 7] / hits,
            sums[:, 9] / letters, sums[:, 18] / words, sums[:, 10] / shown, sums[:, 11] / shown, sums[:, 12] / shown, sums[:, 13] / words, sums[:, 14] / words, sums[:, 15] / shown, sums[:, 16] / words, np.log1p(sums[:, 17]),
        ],
        axis=1,
    )


def word_keys(block: Words) -> Iterator[np.ndarray]:
    """The words of a block and their beginnings, each as one key a word."""
    yield block.hashes
    for size in PREFIXES:
        yield block.prefixes(size)


@dataclass
class Model:
    lexicon: Lexicon
    trees: boosting.Trees | None

    def score(self, texts: list[str | None]) -> np.ndarray:
        return self.trees.probability(features(texts, self.lexicon)) if self.trees is not None else np.zeros(len(texts))


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", positive: int = POSITIVE, negative: int = NEGATIVE) -> Model:
    small_batches(docs.sparkSession)
    known = labels.where(~held_out(id_col) & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("y"))
    known = settle(known, "toxic-labels")
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return Model(Lexicon(np.zeros(0, np.uint64), np.zeros(0)), None)
    share = {1: min(1.0, positive / counts[1]), 0: min(1.0, negative / counts[0])}
    # One row for each id; at most positive + negative of them.
    chosen = [bounded_sample(known.where(F.col("y") == y), size, 4, "toxic-ids") for y, size in ((1, positive), (0, negative))]
    chosen = chosen[0].union(chosen[1]).withColumn("part", F.pmod(F.xxhash64("id", F.lit(44)), F.lit(10)).cast("int"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    # An id may stand for many rows.
    sample = bounded_sample(settle(texts, "toxic-texts"), positive + negative, 5, "toxic-sample").select("y", "part", "text")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, texts = np.array(batch.column(0).to_pylist(), np.int64), batch.column(1).to_pylist()
            found = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for block in blocks(texts, PUNCTUATION):
                for own in word_keys(block):
                    ok = own != 0
                    found[0].append(own[ok])
                    found[1].append(block.doc[ok])
            key, doc = np.concatenate(found[0]), np.concatenate(found[1])
            # Once for each text.
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            key, label = key[new], y[doc[new]]
            each, inverse = np.unique(key, return_inverse=True)
            pos = np.bincount(inverse, label, minlength=len(each)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(each.view(np.int64)), pa.array(pos), pa.array(np.bincount(inverse, minlength=len(each)) - pos)], ["key", "pos", "neg"])

    part = sample.where("part < 5")
    sizes = {r.y: r.n for r in part.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    odds = F.log((F.col("pos") + 0.5) / (sizes.get(1, 0) + 1.0)) - F.log((F.col("neg") + 0.5) / (sizes.get(0, 0) + 1.0))
    counted = part.select("y", "text").mapInArrow(keys, "key bigint, pos bigint, neg bigint").groupBy("key").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    top = counted.where(F.col("pos") >= LEAST_TEXTS).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS).orderBy(F.desc(F.col("odds") * F.log1p("pos")), "key").limit(LEXICON).collect()
    hashes = np.array([r.key for r in top], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    lexicon = Lexicon(hashes[order], np.array([r.odds for r in top])[order])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(2).to_pylist(), lexicon)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], ["y", "part", "x"])

    # The rest of the sample, as numbers: bounded as the sample is.
    got = sample.where("part >= 5").mapInArrow(rows, "y int, part int, x array<double>").toArrow()
    y, part_of = got.column("y").to_numpy().astype(float), got.column("part").to_numpy()
    x = np.array(got.column("x").to_pylist()).reshape(len(y), len(FEATURES))
    weight = np.where(y > 0, 1 / share[1], 1 / share[0])
    weight /= weight.mean() if len(weight) else 1
    order = np.lexsort((*x.T, y, part_of))
    x, y, weight, part_of = x[order], y[order], weight[order], part_of[order]
    trees, last = part_of < 8, part_of >= 8
    if len(set(y[trees])) < 2:
        return Model(lexicon, None)
    model = boosting.fit(x[trees], y[trees], weight[trees])
    if len(set(y[last])) == 2:
        model.knots = boosting.isotonic(model.margin(x[last]), y[last], weight[last])
    return Model(lexicon, model)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score and predicted of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    out = T.StructType([docs.schema[id_col], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.score(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32))], out.names)

    return docs.select(id_col, held_out(id_col).alias("held out"), F.col(text_col).alias("text of it")).mapInArrow(run, out)
