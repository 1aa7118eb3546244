"""Token counts against the library on whole texts."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from keyloom.llm import tokens
from keyloom.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
SPECIAL = ["<|endoftext|>", "<|startoftext|>", "a<|EndOfText|>b", "x<|endoftext|>y"]


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def odd_text(rng, n):
    parts = [" ", "  ", "\t\n", "é", "́", " ́", "Σας", "ΣΑΣ ", "don't", "'S", "'ll1", "12a34", "漢字。かな、", "が。", "ガ゙。", "゙。", " ", " ", "🙂", "!!", "<|", *SPECIAL, "word", "İ", "ﬁ", "한국어", "é"]
    return "".join(rng.choice(parts) for _ in range(n))


def test_cut_texts_count_as_whole(whole, monkeypatch):
    rng = random.Random(5)
    for chars in (1, 3, 17):
        for _ in range(300):
            text = odd_text(rng, 30)
            parts = list(tokens.pieces(text, tokens.WORD_BOUNDARY, chars))
            assert "".join(parts) == text
            assert sum(tokens.counter(PATH)(parts)) == whole(text), (text, parts)


def test_token_counts(docs_of, whole):
    rng = random.Random(6)
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    data = [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, "one"), (5, "one"), (None, "no id"), (6, "a" * 100_000), (7, odd_text(rng, 20_000)), (8, "7" * 70_000)]
    got = tokens.token_counts(docs_of(data), PATH)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(k, len((t or "").encode()), n := whole(t), n > 2048) for k, t in data]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert tokens.token_counts(docs_of([]), PATH).collect() == []


def test_sentencepiece(docs_of):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    data = [(1, None), (2, "un texte"), (3, "a  b <s> c")]
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(docs_of(data), path, boundary=None).collect()}
    assert got == {k: len(model.encode(t or "")) for k, t in data}


def test_query(spark, whole):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((d, len((t or "").encode()), n := whole(t), n > 2048) for d, t in docs)
    assert sorted(map(tuple, QUERIES["op12_token_counts"](spark, sf).collect())) == want
