"""SentencePiece encoding and decoding through a table of distinct chunks.

In a model none of whose pieces has a whitespace marker after another character, no piece crosses
from a character to a following marker. A text then falls into *marked words*: a run of markers with
the characters up to the next run. Each distinct marked word is encoded by the library once in a
worker, and its ids are decoded by the library as they stand after another piece; a text's first word
also as it stands at the beginning, where the library gives up the marker that it put there itself. Ids,
their count and decoded texts are kept in bounded tables; a text's ids and its decoded text are those
of its words, joined by position. The words that a batch of texts lacks in the table go to the library at once.

The join is proved for each model and text and not assumed: the marker is a piece of its own (so no
word begins inside a run of bytes or unknown characters), no piece crosses, and the model's normaliser
leaves the text as it is but for the markers. Otherwise the whole text goes to the library's encode and decode.

Defined results: a null text is as an empty one (no ids, empty decoded text); ids, repeated and
null, are carried through, one row out for each row in; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from weftline.llm.runtime import small_batches

TABLE_ROWS = 1 << 18
#: Longer words don't stay in the tables.
LONG = 256
#: Texts whose words go to the library together.
AT_ONCE = 16
MARK = "▁"
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_workers: dict[str, Codec] = {}


class Codec:
    """A model of a worker process, with its table of distinct marked words."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.decode = lambda rows: model.decode(rows, num_threads=1) if rows else []
        crossing = re.compile(f"[^{MARK}]{MARK}")
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.mark = model.piece_to_id(MARK)
        known = self.mark != model.unk_id() and all(model.is_control(i) or not model.is_unused(i) for i in range(len(pieces)))
        self.by_chunk = known and not any(crossing.search(p) for p in pieces)
        #: Ids (decimal, comma-joined), their count, and what they decode to after a piece; what first words decode to.
        self.table: dict[str, tuple[str, int, str]] = {}
        self.firsts: dict[str, str] = {}

    def _encode(self, texts: str | list[str]) -> list:
        return self.model.encode(texts, add_bos=False, add_eos=False, enable_sampling=False, num_threads=1)

    def _segment(self, chunks: list[str]) -> None:
        """Puts marked words into the table."""
        # The model puts a marker of its own before a text; every chunk begins with one, so it gives its first up.
        ids = [x if c != MARK else [self.mark] for c, x in zip(chunks, self._encode([c[1:].replace(MARK, " ") for c in chunks]), strict=True)]
        before = [self.mark, self.mark]
        cut = len(self.decode([before])[0])
        after = self.decode([before + x for x in ids])
        self.table.update((c, (",".join(map(str, x)), len(x), back[cut:])) for c, x, back in zip(chunks, ids, after, strict=True))

    def _first(self, chunk: str) -> str:
        if (back := self.firsts.get(chunk)) is None:
            back = self.firsts[chunk] = self.decode([list(map(int, self.table[chunk][0].split(",")))])[0]
        return back

    def run(self, texts: list[str]) -> list[tuple[str, int, str]]:
        """Of each text the ids as decimals joined by commas, their count, and the decoded text."""
        cut: list[list[str] | None] = []
        for text in texts:
            marked = MARK + text.replace(" ", MARK)
            apart = self.by_chunk and MARK not in text and "\x00" not in text and (not text or self.model.normalize(text) == marked)
            cut.append(_CHUNK.findall(marked) if text and apart else None)
        table = self.table
        words = {c for chunks in cut if chunks for c in chunks}
        if missing := [c for c in words if c not in table]:
            if len(table) + len(missing) > TABLE_ROWS:
                table.clear()
                missing = list(words)
            self._segment(missing)
        out = []
        for text, chunks in zip(texts, cut, strict=True):
            if not text:
                out.append(("", 0, ""))
            elif chunks is None:
                ids = self._encode(text)
                out.append((",".join(map(str, ids)), len(ids), self.decode([ids])[0]))
            else:
                rows = [table[c] for c in chunks]
                out.append((",".join([r[0] for r in rows]), sum([r[1] for r in rows]), self._first(chunks[0]) + "".join([r[2] for r in rows[1:]])))
        for held in table, self.firsts:
            if len(held) > TABLE_ROWS:
                held.clear()
            for c in missing:
                if len(c) > LONG:
                    held.pop(c, None)
        return out


def codec(path: str) -> Codec:
    if path not in _workers:
        _workers[path] = Codec(path)
    return _workers[path]


def _map(docs: DataFrame, model: str, id_col: str, text_col: str, fields: list[T.StructField], row) -> DataFrame:
    small_batches(docs.sparkSession)
    out = T.StructType([docs.schema[id_col], *fields])
    kinds = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BooleanType(): pa.bool_(), T.ArrayType(T.IntegerType()): pa.list_(pa.int32())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = [row(r, t) for a in range(0, len(texts), AT_ONCE) for r, t in zip(own.run(texts[a : a + AT_ONCE]), texts[a : a + AT_ONCE], strict=True)]
            columns = zip(*found, strict=True) if found else [[] for _ in fields]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), kinds[f.dataType]) for c, f in zip(columns, fields, strict=True))], out.names)

    return docs.select(id_col, text_col).mapInArrow(run, out)


def encode(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, n_tokens and ids (array) of every row, the text that the ids decode to, and whether it is the row's own."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType()), T.StructField("round_trip", T.BooleanType())]
    return _map(docs, model, id_col, text_col, fields, lambda r, text: (r[1], list(map(int, r[0].split(","))) if r[0] else [], r[2], r[2] == text))


def encode_digests(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode``, with digests in place of the ids and the decoded text."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    digest = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
    return _map(docs, model, id_col, text_col, fields, lambda r, _: (r[1], digest(r[0]), digest(r[2])))


def decode(rows: DataFrame, model: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The id and the text of every row's ids, by the library; null ids give an empty text."""
    small_batches(rows.sparkSession)
    out = T.StructType([rows.schema[id_col], T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.decode([list(x or []) for x in batch.column(1).to_pylist()]), pa.string())], out.names)

    return rows.select(id_col, ids_col).mapInArrow(run, out)
