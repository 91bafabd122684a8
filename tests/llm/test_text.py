import re

import numpy as np
import pyarrow as pa
import pytest

from ticketlens.llm import textutil as tu
from ticketlens.llm.queries import tokenizer_path

TEXTS = ["", " a b\tc", "Hello World, hello", None, "x", "é è ü", "long" * 2000 + " end", "\n\n", "A a A"]


@pytest.mark.parametrize("lower", [False, True])
def test_words_match_a_regex(lower):
    data, offsets = tu.text_buffer(pa.array(TEXTS))
    h, start, of = tu.words(data, offsets, lower=lower)
    want = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower() if lower else t or "") for t in TEXTS]
    assert np.diff(of).tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    assert h.tolist() == [tu.word_hash(w, lower) for w in flat]
    assert len(set(h.tolist())) == len(set(flat))


def test_slices_of_a_column_see_only_their_rows():
    column = pa.array(["zero zero", "one", None, "three three three"]).slice(1, 3)
    data, offsets = tu.text_buffer(column)
    assert offsets.tolist() == [0, 3, 3, 20]
    assert list(tu.slices(offsets, 4)) == [(0, 2), (2, 3)]


def test_subwords_equal_the_tokenizer_whatever_the_white_space():
    vocabulary = tu.Subwords(tokenizer_path())
    texts = ["", "a  b\n\nc", " x", "x ", "a b c", "é\n è  ", "don't stop<|endoftext|> now", "a\tb", "\n", "a \nb",
             "1 2\n3", "plain words here\nand there, again here"] * 2
    whole = [e.ids for e in vocabulary.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in vocabulary.encode(texts)] == whole
