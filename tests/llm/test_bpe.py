import hashlib
import json
import random

import pytest
from tokenizers import Tokenizer

from linemend.llm.base import file_bytes, tokenizer_file
from linemend.llm.bpe import ByteBPE, MergeAutomaton, bpe_encode, compiled, definition_of

TEXTS = ["", " ", "  a  b   ", "it's I'LL don't", "<|endoftext|>x<|endoftext|>", "日本語 テスト 😀", "***** ****", "-" * 700, "a" * 3000, "été ção\r\n\t x", "\x00é", "don't<|endoftext", "12345 6.7"]


@pytest.fixture(scope="module")
def bpe():
    return ByteBPE(definition_of(file_bytes(tokenizer_file("byte_bpe_50k.json"))))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))


def ids(packed):
    return list(memoryview(packed).cast("I"))


def test_same_as_library(bpe, library):
    for t in TEXTS:
        want = library.encode(t, add_special_tokens=False).ids
        assert ids(bpe.encode_packed(t)) == want
        assert bpe.decode_packed(bpe.encode_packed(t)) == library.decode(want, skip_special_tokens=False)


def test_null_is_empty(bpe):
    assert bpe.encode_packed(None) == b""


def naive(word, ranks):
    parts = [bytes([b]) for b in word]
    while True:
        pairs = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        if not pairs:
            return parts
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_automaton_accepts_exactly_the_merged_sequence():
    """Every word over a small alphabet against merging by rank, pair by pair."""
    merges = [(b"a", b"a"), (b"a", b"b"), (b"aa", b"b"), (b"b", b"aa"), (b"ab", b"ab"), (b"c", b"ab"), (b"aa", b"aa")]
    vocab = {bytes([b]): i for i, b in enumerate(b"abc")}
    for x, y in merges:
        vocab[x + y] = len(vocab)
    automaton, ranks = MergeAutomaton(compiled(vocab, merges)), {m: i for i, m in enumerate(merges)}
    words = [b""]
    for _ in range(7):
        words = [w + bytes([c]) for w in words for c in b"abc"]
        for w in words:
            assert [automaton.labels[t] for t in automaton.encode(w)] == naive(w, ranks), w


def test_operator(spark, library):
    rows = [(i, t, "src", 5) for i, t in enumerate([*TEXTS, None, TEXTS[3]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, decoded int")
    out = {r.doc_id: r for r in bpe_encode(df).collect()}
    assert len(out) == len(rows)
    for i, t, *_ in rows:
        want = library.encode(t or "", add_special_tokens=False).ids
        r = out[i]
        assert (r.n_tokens, r.token_ids, r.decoded) == (len(want), want, t or "")
        assert r.ids_sha256 == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in want)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_empty_table_and_null_id(spark):
    schema = "doc_id long, text string"
    assert bpe_encode(spark.createDataFrame([], schema)).count() == 0
    r = bpe_encode(spark.createDataFrame([(None, "a b")], schema)).head()
    assert r.doc_id is None and r.n_tokens == 2


def test_refuses_other_vocabularies():
    with pytest.raises(ValueError):
        definition_of(json.dumps({"model": {"type": "WordPiece"}}).encode())


def test_very_long_word_and_text(bpe, library):
    """One word of 400,000 letters, and a text of as many words; linear, so seconds at most."""
    for t in ("abcdefghij" * 40_000, "ab" * 200_000 + "é", "one two " * 200_000):
        assert ids(bpe.encode_packed(t)) == library.encode(t, add_special_tokens=False).ids


def test_random_strings(bpe, library):
    rng = random.Random(3)
    for _ in range(1500):
        t = "".join(rng.choice(["a", "b", "e", "th", "er", " ", "  ", "\n", "é", "ß", "'s", "9", "==", "ing", "日", "😀"]) for _ in range(rng.randrange(1, 40)))
        assert ids(bpe.encode_packed(t)) == library.encode(t, add_special_tokens=False).ids
