import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from pairloom.llm.words import chunks, gram_hashes, hash_words, sliding_argmin, text_chunks, utf8
from tests.llm import brute


@given(st.text(alphabet="ab \t\n\x0b\x0c\r\x1c\x85  é", max_size=40))
@settings(max_examples=200, deadline=None)
def test_bytes_split_like_the_pattern(text):
    assert [w.decode() for w in text.encode().split()] == brute.words(text)


@given(st.lists(st.integers(0, 5), max_size=40), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_sliding_argmin(values, width):
    got = sliding_argmin(np.array(values, np.uint64), width).tolist()
    assert got == [i + values[i : i + width].index(min(values[i : i + width])) for i in range(len(values) - width + 1)]


def test_gram_hashes_tell_order():
    a, b = (gram_hashes(hash_words(w), 3) for w in ([b"x", b"y", b"z"], [b"z", b"y", b"x"]))
    assert len(a) == 1 and a[0] != b[0]
    assert len(gram_hashes(hash_words([b"x"]), 3)) == 0


@given(st.lists(st.none() | st.text(alphabet="aé ", max_size=9), max_size=12), st.integers(1, 20))
@settings(max_examples=200, deadline=None)
def test_text_chunks_are_the_chunks_of_all_texts(texts, limit):
    batch = pa.record_batch({"text": pa.array(texts, pa.string())})
    whole = utf8(batch, "text")
    assert list(text_chunks(batch, "text", limit)) == [(a, whole[a:b]) for a, b in chunks(whole, limit)]
