"""Token counts of whole texts by a map-side, two-tier lookup of pre-token lengths.

A token count is the sum of the lengths of a text's pre-tokens, as BPE merges never cross one.
Tier 1 is a compact table of the corpus's frequent pre-tokens with their lengths, broadcast;
it holds ``TABLE_ROWS`` entries at most, whatever the corpus holds. All pre-tokens of all texts are counted
for it where they are, as the tokenizer splits them (words with their space, first words, signs, digits,
runs of white space); only the summaries of tasks are added up. Tier 2 is a bounded cache in
each Python worker: a pre-token that both tiers miss is encoded once by the library and kept.
Pre-tokens are never shuffled. The tiers change only the speed: any pre-token's length is the
library's own.

Defined results: a null text counts as empty (0 bytes, 0 tokens); a null, repeated or clashing id
is carried through, one row out for each row in; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.runtime import small_batches

TABLE_ROWS = 1 << 17
CACHE_ROWS = 1 << 18
#: A pre-token goes into a task's summary if it has at least this share of the task's.
FREQUENT = 1 / (1 << 19)
_HELD = 1 << 17

# Letters whose class no version of Unicode doubts; a text with any other non-ASCII character is
# split by the library's own pre-tokenizer.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_SIGNS = "¡§«°»¿–—‘’“”…€"
_ODD = re.compile(f"[^\x00-\x7fÀ-ÖØ-öø-ɏ{_SIGNS}]")
_SPLIT = re.compile(
    rf"'(?:[sdmt]|ll|ve|re)| ?[{_LETTERS}]+| ?[0-9]+| ?[^ \t\n\r\f\v{_LETTERS}0-9]+|[ \t\n\r\f\v]+(?![^ \t\n\r\f\v])|[ \t\n\r\f\v]+"
)

_workers: dict[str, Encoder] = {}


class Encoder:
    """The tokenizer of a worker process, with its cache of pre-token lengths."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec.get("pre_tokenizer") or {}
        self.plain = (
            spec["model"]["type"] == "BPE" and spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", []))
        )
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.between = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.cache: dict[str, int] = {}

    def lengths(self, pieces: list[str]) -> list[int]:
        return [len(e.ids) for e in self.library.encode_batch(pieces, add_special_tokens=False)]

    def pieces(self, text: str) -> list[str]:
        if _ODD.search(text) is None:
            return _SPLIT.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def parts(self, text: str) -> tuple[list[str], int]:
        """The text between added tokens, and how many of these stand in it."""
        if self.between is None or self.between.search(text) is None:
            return [text], 0
        return [p for p in self.between.split(text) if p], len(self.between.findall(text))

    def count(self, texts: list[str], table: dict[str, int]) -> list[int]:
        if not self.plain:
            return self.lengths(texts)
        cache, out = self.cache, []
        for text in texts:
            parts, total = self.parts(text)
            for part in parts:
                found = list(map(table.get, pieces := self.pieces(part)))
                if None in found:
                    missed = [p for p, n in zip(pieces, found, strict=True) if n is None]
                    if new := [p for p in set(missed) if p not in cache]:
                        if len(cache) + len(new) > CACHE_ROWS:
                            cache.clear()
                            new = list(set(missed))
                        cache.update(zip(new, self.lengths(new), strict=True))
                    total += sum(map(cache.__getitem__, missed)) + sum(n for n in found if n is not None)
                else:
                    total += sum(found)
            out.append(total)
        return out


def encoder(path: str) -> Encoder:
    if path not in _workers:
        _workers[path] = Encoder(path)
    return _workers[path]


def frequent_pieces(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """(piece, n): the pre-tokens that hold at least ``FREQUENT`` of a task's, summed over all tasks.

    Every text is counted. A task keeps a lossy count of at most ``_HELD`` pre-tokens, so one over
    the share in the corpus is over it in some task and cannot be missed there.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        held: Counter[str] = Counter()
        seen = floor = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for part in own.parts(text or "")[0]:
                    pieces = own.pieces(part)
                    seen += len(pieces)
                    held.update(pieces)
            while len(held) > _HELD:
                floor += 1
                held = Counter({w: n for w, n in held.items() if n > floor})
        rows = [(w, n) for w, n in held.items() if n >= max(2, seen * FREQUENT)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], ["piece", "n"])

    return docs.select(text_col).mapInArrow(count, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))


def frequent_table(docs: DataFrame, tokenizer: str, text_col: str = "text") -> dict[str, int]:
    """Tier 1: the lengths of the ``TABLE_ROWS`` commonest pre-tokens; empty for a tokenizer that isn't split in advance."""
    here = encoder(tokenizer)
    if not here.plain:
        return {}
    pieces = [r.piece for r in frequent_pieces(docs, tokenizer, text_col).orderBy(F.desc("n"), "piece").limit(TABLE_ROWS).collect()]
    return dict(zip(pieces, here.lengths(pieces), strict=True))


def count_tokens(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """One row for each row of ``docs``: its id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens)."""
    spark = docs.sparkSession
    small_batches(spark)
    table = spark.sparkContext.broadcast(frequent_table(docs, tokenizer, text_col))
    out = T.StructType([docs.schema[id_col], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        own, lengths = encoder(tokenizer), table.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = own.count(texts, lengths)
            sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], out.names)

    return docs.select(id_col, text_col).mapInArrow(count, out)
