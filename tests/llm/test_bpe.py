import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewarden.llm import bpe
from tablewarden.llm.packing import vocabulary

VOCABULARY = vocabulary()

TEXTS = [
    "plain words, with marks; and it's\n\nlines\nhere", "  two  blanks \t tabs \n", "", "   ", " x", "<|endoftext|> hi<|endoftext|>",
    "ünï çödé \U0001f600  non-breaking　wide", "1234 5.6e7 a_b __ 'tis 's", "a" * 3000, "\x00 nul", "tab\tx y\r\nz",
    "漢字" * 900 + "，文字。" + "ab1" * 400, "mid<|endoftext|>dle <|endoftext", "x   ", "y", "né́e " * 5, " " * 5000,
    "né, là!\nÀ÷, ×!\n\nx\n y\n", "end\n", "\nx", "'S 's\n's",
]


def plain(name="byte_bpe_50k.json"):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(vocabulary(name))


def expected(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return ids, tokenizer.decode(ids, skip_special_tokens=False)


def test_words_are_encoded_apart():
    words, tokenizer = bpe.Words(VOCABULARY), plain()
    data = np.frombuffer("".join(TEXTS).encode(), np.uint8)
    offsets = np.append(0, np.cumsum([len(t.encode()) for t in TEXTS]))
    cuts = words.cuts(data, offsets)
    assert set(offsets) <= set(cuts)
    for text, a, b in zip(TEXTS, offsets, offsets[1:], strict=False):
        own = cuts[(cuts >= a) & (cuts <= b)]
        ids = [i for x, y in zip(own, own[1:], strict=False) for i in tokenizer.encode(data[x:y].tobytes().decode(), add_special_tokens=False).ids]
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_long_words_are_cut():
    cuts = bpe.Words(VOCABULARY).cuts(np.frombuffer(("漢字" * 900 + "，" + "文" * 900).encode(), np.uint8), np.array([0, 8103]))
    assert len(cuts) > 2


@pytest.mark.parametrize("block", [bpe.BLOCK_BYTES, 64])
def test_ids_and_texts(frame, monkeypatch, block):
    monkeypatch.setattr(bpe, "SHARE_BYTES", block)
    monkeypatch.setattr(bpe, "BLOCK_BYTES", block)
    docs = frame([(i, t) for i, t in enumerate([*TEXTS, None, "x   "])], "doc_id bigint, text string")
    got = {r.row.doc_id: (r.ids, r.decoded) for r in bpe.encode(docs, VOCABULARY, carry=["doc_id"]).collect()}
    assert got == {r.doc_id: expected(plain(), r.text) for r in docs.collect()}


def test_odd_documents(odd_docs):
    got = sorted(((r.row, r.ids, r.decoded) for r in bpe.encode(odd_docs, VOCABULARY).collect()), key=repr)
    assert got == sorted(((r, *expected(plain(), r.text)) for r in odd_docs.collect()), key=repr)


def test_no_documents(no_docs):
    assert bpe.encode(no_docs, VOCABULARY).count() == 0


def test_decoding_alone(frame):
    tokenizer = plain()
    lists = [tokenizer.encode(t).ids for t in TEXTS] + [[], [0, 1, 255, 128], [50256, 50256], [188, 122, 188]]
    rows = frame([(k, x) for k, x in enumerate(lists)] + [(-1, None), (-2, [64, None, 99_999, 65])], "k int, ids array<int>")
    got = {r.row.k: r.decoded for r in bpe.decode(rows, VOCABULARY).collect()}
    assert got == {k: tokenizer.decode(x, skip_special_tokens=False) for k, x in enumerate(lists)} | {-1: "", -2: "ab"}


def test_vocabularies_that_change_text_encode_it_whole(frame):
    name = "word_bpe_49k.json"
    words = bpe.Words(vocabulary(name))
    data = np.frombuffer(b"Some words, here", np.uint8)
    assert words.cuts(data, np.array([0, len(data)])).tolist() == [0, len(data)]
    with pytest.raises(ValueError, match="byte-level"):
        bpe.pieces(vocabulary(name))


def test_query(spark):
    rows = {r.doc_id: r for r in bpe.op13(spark, "/root/testdata/sf0.001").collect()}
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", F.lit(0)).collect()
    assert len(rows) == len(texts)
    tokenizer = plain()
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in texts:
        ids, decoded = expected(tokenizer, r.text)
        assert rows[r.doc_id][1:] == (len(ids), digest(",".join(map(str, ids))), digest(decoded))
