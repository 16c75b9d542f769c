import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tickflow.llm.pieces import MergeRounds, piece_round_trip
from tickflow.llm.token_counts import HeapCounter, token_counts

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "a", "  a", "x<|endoftext|> y", "<|endoftext|>", "a" * 3000, "ab" * 400, " " * 50, "\n\n\n", "the<0x0A>",
       "tab\there\r\n", "▁x ▁", "é́ ﬁ①", "a　b\xa0c d\x85e\x1cf", "\x00", "<s>hi</s><unk>", "😀😀 你好", "don't they'LL"]


@pytest.fixture(scope="module")
def texts():
    random.seed(5)
    alphabet = "ab e\n\t'sré<|>▁ 12ß你😀　\xa0.,!thing"
    return ODD + ["".join(random.choice(alphabet) for _ in range(random.randint(0, 80))) for _ in range(800)]


def test_heap_counts_equal_the_library(texts):
    lib = Tokenizer.from_file(BPE)
    mine = HeapCounter(BPE)
    assert [mine.count(t) for t in texts] == [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_heap_counts_of_every_kind_of_character():
    lib, mine = Tokenizer.from_file(BPE), HeapCounter(BPE)
    chars = [chr(c) for c in [*range(0x3100), *range(0x3100, 0x110000, 97)] if not 0xD800 <= c < 0xE000]
    probe = ["a" + c + "1 " + c + "b " + c + c for c in chars]
    assert [mine.count(t) for t in probe] == [len(e.ids) for e in lib.encode_batch(probe, add_special_tokens=False)]


def test_merge_rounds_equal_the_library(texts):
    lib, mine = sentencepiece.SentencePieceProcessor(model_file=PIECES), MergeRounds(PIECES)
    for t in texts:
        ids = lib.encode(t)
        assert mine.encode(t) == ids
        assert mine.decode(ids) == lib.decode(ids)
    for _ in range(500):  # ids that no text gives, with broken byte runs
        ids = [random.randint(1, 400) for _ in range(10)]
        assert mine.decode(ids) == lib.decode(ids)


def rows(spark, texts):
    data = [(i, t, 7) for i, t in enumerate(texts)] + [(None, "null id", 1), (1, None, 1), (1, None, 1)]
    return spark.createDataFrame(data, "doc_id long, text string, n_tokens int")


def test_queries_over_odd_texts(spark, texts):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = rows(spark, texts[:120])
    got = token_counts(docs, BPE, limit=20).collect()
    assert len(got) == 123 and {r.doc_id for r in got if r.n_bytes == 0} >= {0, 1}
    bpe = Tokenizer.from_file(BPE)
    for r in got:
        if r.doc_id is not None and r.n_bytes:
            t = texts[r.doc_id]
            n = len(bpe.encode(t, add_special_tokens=False).ids)
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 20)
    for r in piece_round_trip(docs, PIECES, keep_ids=True).collect():
        t = texts[r.doc_id] if r.doc_id is not None and r.n_tokens else ("null id" if r.doc_id is None else "")
        ids = lib.encode(t)
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded == lib.decode(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


def test_large_ids_beside_nulls_stay_exact(spark):
    big = 2**62 + 1
    docs = spark.createDataFrame([(big, "a b"), (None, "c"), (big + 1, None)], "doc_id long, text string")
    assert {r.doc_id for r in token_counts(docs, BPE).collect()} == {big, big + 1, None}
    assert {r.doc_id for r in piece_round_trip(docs, PIECES).collect()} == {big, big + 1, None}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts(docs, BPE).count() == 0 and piece_round_trip(docs, PIECES).count() == 0
