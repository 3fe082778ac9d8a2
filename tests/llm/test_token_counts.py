import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tickyard.llm import token_counts as C

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOK = Tokenizer.from_file(PATH)
TOK.no_truncation()
TOK.no_padding()


@pytest.fixture(scope="module")
def whole():
    return C.whole_tokens(PATH)


def library(text):
    return len(TOK.encode(text or "", add_special_tokens=False).ids)


def texts(n=250):
    r = random.Random(11)
    signs = "abcdefghij   \n\t.,;'sS0123456789éß日本語🙂́ \xa0\x85<|endoftext|>ſ؄\U0001f9ff"
    out = ["", " ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "don't we'll I'm 're", "x" * 30_000,
           "日" * 5_000, " " * 9_000 + "a", "\n\n\n a", "the quick brown fox " * 400, "0" * 3_000, "é́" * 3_000,
           "word" + " " * 40 + "word", "trailing  ", "\x00\x01 \x1c", "a؄b", "İstanbul ﬁ Ǆ"]
    for _ in range(n):
        out.append("".join(r.choice(signs) * r.choice([1, 1, 1, 2, 5]) for _ in range(r.randint(1, 120))))
    return out


def test_against_the_library(spark, whole):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "null key"), (3, None), (3, None), (4, "again")]
    clash = [(*r, 5, "x", True) for r in rows]
    df = spark.createDataFrame(clash, "doc_id bigint, text string, n_tokens int, key string, over_limit boolean").repartition(3)
    got = sorted((tuple(r) for r in C.counts(df, PATH).collect()), key=str)
    want = sorted(((k, len((t or "").encode()), library(t), library(t) > 1024) for k, t in rows), key=str)
    assert got == want
    assert C.counts(df.filter("false"), PATH).collect() == []
    assert any(r[3] for r in got) and not all(r[3] for r in got)


def test_proof(whole):
    """A proven string is one token of the library, alone and as a word of a text; a vocabulary
    string that merges otherwise is not in the set."""
    vocab = TOK.get_vocab(with_added_tokens=False)
    assert 40_000 < len(whole) <= len(vocab)
    r = random.Random(2)
    words = [w for w in whole if w[:1] == " " and w[1:].isalpha() and w.isascii()]
    for w in r.sample(sorted(words), 2_000):
        assert len(TOK.encode(w, add_special_tokens=False).ids) == 1
    a = Tokenizer.from_str(TOK.to_str()).model
    assert all(len(a.tokenize(t)) == 1 for t in r.sample(sorted(vocab), 500) if _text(t) in whole)


def _text(token):
    try:
        return bytes(C.byte_chars()[c] for c in token).decode()
    except UnicodeDecodeError:
        return None


def test_only_the_rest_is_merged(whole):
    counter = C.Counter(PATH, whole)
    assert counter.count_all(pa.array(["the cat sat on the mat and then the dog sat there"])).tolist() == [12]
    assert counter.merged == 0
    assert counter.count_all(pa.array(["the zxqvkj of the zxqvkj", None])).tolist() == [library("the zxqvkj of the zxqvkj"), 0]
    assert counter.merged == 1
