import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tickyard.llm import bpe
from tickyard.llm.common import by_slices

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
SMALL = bpe.Bpe(PATH, run=40, memo=500)
PARTS = ["a", "b", "'s", "'ll", "'", " ", "  ", "\n", "\n\n", "\t", "é", "日本", "🙂", "1", "23", "!", "--", "the",
         "<|endoftext|>", "<|endof", "text|>", " of", "\xa0", "\x1c", "ab" * 50, " " * 60, "=", "aaaa", "\r\n"]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=40).map("".join)


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.lists(st.floats(0, 1), max_size=6))
def test_encoding_and_concatenation_equal_the_library(text, cuts):
    want = library(text)
    assert SMALL.encode(text).tolist() == want
    at = [0, *sorted(int(c * len(text)) for c in cuts), len(text)]
    parts = [SMALL.encode(text[a:b]) for a, b in zip(at, at[1:], strict=False)]
    assert SMALL.concat(parts).tolist() == want
    assert SMALL.decode(want) == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=30))
def test_decoding_any_ids(ids):
    assert SMALL.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXTS), max_size=8))
def test_batches(texts):
    ends, flat = SMALL.encode_all(pa.array(texts, pa.string()))
    got = [flat[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)]
    assert got == [library(t or "") for t in texts]


def test_unknown_words_go_to_the_library_together():
    one_by_one, fresh = [], bpe.Bpe(PATH)
    word = fresh._word
    fresh._word = lambda w: one_by_one.append(w) or word(w)
    text = "first " + " ".join(f"w{i}é's, q{i}\nz!" for i in range(5_000)) + " 日本 " + "x" * 3_000
    ends, flat = fresh.encode_all(pa.array([text]))
    assert ends.tolist() == [0, len(flat)] and flat.tolist() == library(text)
    assert one_by_one == ["first"]


def test_tasks_of_a_worker_share_the_words_they_met():
    bpe.held(PATH).encode_all(pa.array(["a sharedword met"]))
    assert " sharedword" in bpe.held(PATH).words


def test_a_task_that_does_not_encode_frees_the_encoder():
    bpe.held(PATH)
    assert list(by_slices(len, encodes=True)([])) == [] and bpe._held.cache_info().currsize == 1
    assert list(by_slices(len)([])) == [] and bpe._held.cache_info().currsize == 0


def test_long_unsplit_text():
    r = random.Random(1)
    text = "".join(r.choice("abcdeé") for _ in range(20_000))
    assert bpe.Bpe(PATH, run=100).encode(text).tolist() == library(text)


def test_join_of_disagreeing_sides_grows():
    left, right = SMALL.encode("x" + " " * 200), SMALL.encode(" " * 300 + "y")
    assert SMALL.join(left, right).tolist() == library("x" + " " * 500 + "y")
    assert SMALL.join(np.zeros(0, "<u4"), right).tolist() == right.tolist()


@pytest.mark.parametrize("leaf", [50, 16_384])
def test_rows(docs, leaf):
    want = sorted((r.doc_id is None, r.doc_id or 0, library(r.text or "")) for r in docs.collect())
    both = bpe.decode(bpe.encode(docs, PATH, leaf=leaf), PATH).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in both) == want
    texts = {(r.doc_id, r.text or "") for r in docs.collect()}
    assert {(r.doc_id, r.decoded) for r in both} == texts


def test_empty_table(no_docs):
    assert bpe.decode(bpe.encode(no_docs, PATH), PATH).collect() == []
