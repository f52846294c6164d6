import hashlib
import random
from collections import Counter

import pytest

from weftline.llm import sentencepiece_codec, token_counts
from weftline.llm.registry import tokenizer
from weftline.llm.runtime import table

ALPHABET = [*" \n\t\r\x0b\x0c\x1c\x1f\x85\xa0ab zé日1２½'\"<|>_-.,;　​▁😀ñß²ʼ\x00\x7f", "<|endoftext|>", "<s>", "</s>", "'s", "'ll", "  ", "▁▁"]


def fuzz(n=3000):
    rng = random.Random(7)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_counts_are_the_librarys():
    own = token_counts.Encoder(tokenizer("byte_bpe_50k.json"))
    assert own.plain
    texts = fuzz()
    expected = [len(e.ids) for e in own.library.encode_batch(texts, add_special_tokens=False)]
    assert own.count(texts, {}) == expected
    assert own.count(texts, {" a": 1, "a": 1, " ": 1}) == expected


def test_a_tokenizer_of_another_kind_counts_whole_texts():
    own = token_counts.Encoder(tokenizer("word_bpe_49k.json"))
    assert not own.plain and own.count(["Hello there"], {}) == own.lengths(["Hello there"])


def test_count_tokens(spark, odd, none):
    rows = token_counts.count_tokens(odd, tokenizer("byte_bpe_50k.json")).collect()
    assert len(rows) == odd.count()
    own = token_counts.encoder(tokenizer("byte_bpe_50k.json"))
    texts = [r.text or "" for r in odd.select("doc_id", "text").collect()]
    expected = sorted((len(t.encode()), n) for t, n in zip(texts, own.lengths(texts), strict=True))
    assert sorted((r.n_bytes, r.n_tokens) for r in rows) == expected
    assert all(r.over_limit == (r.n_tokens > 1024) for r in rows)
    assert token_counts.count_tokens(none, tokenizer("byte_bpe_50k.json")).count() == 0


def test_frequent_pieces_count_all_texts(spark):
    df = spark.createDataFrame([("the cat, the dog.",), ("the end. 12",), (None,), ("the 12",)], "text string")
    got = {r.piece: r.n for r in token_counts.frequent_pieces(df.coalesce(1), tokenizer("byte_bpe_50k.json")).collect()}
    assert got == {"the": 3, ".": 2, " 12": 2}


def test_the_table_holds_most_pre_tokens(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    own = token_counts.encoder(tokenizer("byte_bpe_50k.json"))
    held = token_counts.frequent_table(docs, tokenizer("byte_bpe_50k.json"))
    pieces = [p for r in docs.collect() for part in own.parts(r.text or "")[0] for p in own.pieces(part)]
    assert {".", ",", "\n"} <= set(held) and len(held) <= token_counts.TABLE_ROWS
    # Half of the distinct pre-tokens of these invented texts occur once or twice; of those that occur ten times, all are there.
    often = Counter(pieces)
    assert sum(p in held for p in pieces) > 0.85 * len(pieces) and all(p in held for p, n in often.items() if n >= 10)


def test_pieces_are_the_librarys():
    own = sentencepiece_codec.Codec(tokenizer("piece_bpe_32k.model"))
    assert own.by_chunk
    texts = fuzz()
    for text, got in zip(texts, own.run(texts), strict=True):
        ids = own.model.encode(text)
        assert got == (",".join(map(str, ids)), len(ids), own.model.decode(ids))


def test_decoded_texts_come_from_decode():
    own = sentencepiece_codec.Codec(tokenizer("piece_bpe_32k.model"))
    asked, real = [], own.decode
    own.decode = lambda rows: asked.extend(rows) or real(rows)
    assert own.run(["two words  and two"])[0][2] == "two words  and two"
    assert own._encode("two") in asked and [own.mark, own.mark, *own._encode("two")] in asked
    seen = len(asked)
    assert own.run(["two words", "two words two"])[1][2] == "two words two" and len(asked) == seen
    own.table.clear()
    own.firsts.clear()
    own.decode = lambda rows: [x.upper() for x in real(rows)]
    assert own.run(["two words"])[0][2] == "TWO WORDS"


def test_the_tables_are_bounded(monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "TABLE_ROWS", 4)
    own = sentencepiece_codec.Codec(tokenizer("piece_bpe_32k.model"))
    for text in ("a b c d e f g a b", "x y", "long" * 100 + " z", "a b"):
        ids = own.model.encode(text)
        assert own.run([text]) == [(",".join(map(str, ids)), len(ids), text)]
        assert len(own.table) <= 4 and len(own.firsts) <= 4 and all(len(c) <= sentencepiece_codec.LONG for c in own.table)


def test_a_text_that_does_not_come_back_is_told(spark):
    rows = spark.createDataFrame([(1, "a▁b"), (2, "a b")], "doc_id bigint, text string")
    assert {r.doc_id: r.round_trip for r in sentencepiece_codec.encode(rows, tokenizer("piece_bpe_32k.model")).collect()} == {1: False, 2: True}


def test_encode_and_decode(spark, odd, none):
    model = tokenizer("piece_bpe_32k.model")
    rows = sentencepiece_codec.encode(odd, model)
    assert rows.where("not round_trip").isEmpty()
    back = sentencepiece_codec.decode(rows, model).collect()
    assert sorted(r.decoded for r in back) == sorted(r.text or "" for r in odd.select("text").collect())
    empty = hashlib.sha256(b"").hexdigest()
    digests = {r.doc_id: r for r in sentencepiece_codec.encode_digests(odd, model).collect()}
    assert digests[2].ids_sha256 == digests[3].decoded_sha256 == empty and digests[2].n_tokens == 0
    assert sentencepiece_codec.encode(none, model).count() == 0


@pytest.mark.parametrize("text", ["", " ", "  a", "a ", "\n", "a\n b"])
def test_marks_at_the_ends(text):
    own = sentencepiece_codec.codec(tokenizer("piece_bpe_32k.model"))
    assert own.run([text])[0][0] == ",".join(map(str, own.model.encode(text)))
