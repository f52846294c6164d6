import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.llm import words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab éZ \t\n日.,9", max_size=60), max_size=8))
def test_hashes_tell_words_apart(texts):
    found, ends = words.word_hashes(texts)
    expected = [[w for w in "".join(c if c not in "\t\n\x0b\x0c\r" else " " for c in t).split(" ") if w] for t in texts]
    assert list(np.diff(ends)) == [len(w) for w in expected]
    low = [w.replace("Z", "z") for ws in expected for w in ws]
    assert [words.hash_of(w) for w in low] == found.tolist()
    assert len(set(low)) == len(set(found.tolist()))


def test_blocks_do_not_change_words(monkeypatch):
    texts = ["a bb ccc " * 50, None, "", "d" * 400, "e f"]
    whole = words.word_hashes(texts)
    monkeypatch.setattr(words, "BLOCK_BYTES", 64)
    cut = words.word_hashes(texts)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def test_prefixes():
    block = next(words.blocks(["idiotic id"], words.PUNCTUATION))
    assert block.prefixes(5)[0] == words.hash_of("idiot") and block.prefixes(5)[1] == 0
