import sentencepiece

from linemend.llm.base import file_bytes, tokenizer_file
from linemend.llm.token_count import Counts, pack, token_counts, unpack

TEXTS = ["", " ", "   ", "abc", " abc", "abc ", "a  b   c", "\n", "a\n\n b", "\n a", "▁x▁▁", "<s>hi</s> <unk>", "日本語 😀", "   \n  x\ty \r\n", "word,\nNext", "x" * 500, "a b " * 3000]


def test_same_as_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    rows = [(i, t, 1) for i, t in enumerate([*TEXTS, None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes int")
    out = {r.doc_id: r for r in token_counts(df, limit=100).collect()}
    for i, t, _ in rows:
        n = len(sp.encode(t or ""))
        assert (out[i].n_tokens, out[i].n_bytes, out[i].over_limit) == (n, len((t or "").encode()), n > 100), (t, n)


def test_sample_changes_nothing(spark):
    df = spark.createDataFrame([(i, f"w{i} the of {i % 7}") for i in range(50)], "doc_id long, text string")
    a = {tuple(r) for r in token_counts(df, sample_docs=1).collect()}
    assert a == {tuple(r) for r in token_counts(df, sample_docs=50).collect()}
    assert token_counts(df.limit(0)).count() == 0


def test_pack():
    entries = [("the", 1), ("été", 3), (" x", 2)]
    assert unpack(pack(entries)) == dict(entries)
    assert unpack(pack([])) == {}


def test_frequent_stay_after_clearing(monkeypatch):
    import linemend.llm.token_count as m

    monkeypatch.setattr(m, "CACHE", 4)
    c = Counts(file_bytes(tokenizer_file("piece_bpe_32k.model"))).keep({" the": 1})
    c.of("a b c d e f g h")
    assert c._frequent[" the"] == 1 and dict.get(c, " the") == 1
