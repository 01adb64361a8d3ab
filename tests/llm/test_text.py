import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from acctpulse.llm import arrays
from acctpulse.llm.decontaminate import LOWER, UPPER, WORD

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB9 .é\n-", max_size=30)), max_size=8)


def plain_words(text):
    return re.findall(WORD, (text or "").translate(str.maketrans(UPPER, LOWER)))


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    words = arrays.Words(*arrays.utf8(pa.array(texts, pa.string())))
    for i, t in enumerate(texts):
        own = range(words.first[i], words.first[i + 1])
        assert [words.text(j, j + 1) for j in own] == plain_words(t)


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_a_hash_depends_on_the_word_alone(texts):
    whole = arrays.Words(*arrays.utf8(pa.array(texts, pa.string())))
    seen = {}
    for i in range(len(whole.hash)):
        assert seen.setdefault(whole.text(i, i + 1), whole.hash[i]) == whole.hash[i]
    for word, h in seen.items():
        assert arrays.Words(*arrays.utf8(pa.array([word]))).hash[0] == h
    assert len(set(seen.values())) == len(seen)


def test_shingles_stay_within_a_text():
    words = arrays.Words(*arrays.utf8(pa.array(["a b c", "d e", "a b c"])))
    h, doc, at = words.shingles(2)
    assert doc.tolist() == [0, 0, 1, 2, 2]
    assert h[0] == h[3] and h[1] == h[4] and len(set(h.tolist())) == 3
    assert words.shingles(4)[0].size == 0


def test_blocks_cover_all_rows_and_slices():
    batch = pa.RecordBatch.from_pydict({"t": pa.array(["x" * n for n in (0, 5, 90, 1, 0, 7)])})
    for cut in (batch, batch.slice(1, 4)):
        parts = list(arrays.blocks(cut, "t", 10))
        assert [x for p in parts for x in p["t"].to_pylist()] == cut["t"].to_pylist()
    data, offsets = arrays.utf8(batch.slice(1, 2)["t"])
    assert offsets.tolist() == [0, 5, 95] and len(data) == 95


def test_mix_has_no_collisions_on_small_numbers():
    assert len(np.unique(arrays.mix(np.arange(100_000, dtype=np.uint64)))) == 100_000
