"""Token counts and SentencePiece against the libraries themselves."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from paxflow.llm.pieces import encode_texts, marked_words, processor
from paxflow.llm.queries import QUERIES
from paxflow.llm.tokens import encoded, pre_tokens, token_counts

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SF_DIR = "/root/testdata/sf0.001"

TEXTS = [
    None, "", " ", "  ", "   ", "\n", "\n\n", " \n ", "a", " a", "a ", "  a  b  ", "a\n b", "a \nb",
    "a\n\n  b \n \n c", "b\n ", "b \n", "\tx\t y", "don't  they'll 12 3½ ², ... !!!", "x y 　z",
    "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "<|endoftext|", "\x01 a \x01b", "\x00 a\x1f b",
    "é ü ß 漢字 ﬁ 😀😀 👩‍👩‍👧", "▁a ▁ b▁ c", "</s> <s> <unk>", "\x85 a \x1c b", "a\r\n b",
    "word " * 3000, "w" * 5000, "​ a", "é a", "1 234,567.89", "_a_ __b",
]


def rows(spark):
    data = [(i, t, "extra", t) for i, t in enumerate(TEXTS)] + [(3, "a", None, None)] * 2
    return spark.createDataFrame(data, "doc_id long, text string, ids string, batch string")


@pytest.mark.parametrize("text", [t for t in TEXTS if t])
def test_chunks_give_the_ids_of_the_text(text):
    whole = Tokenizer.from_file(BPE).encode(text, add_special_tokens=False).ids
    assert [i for e in encoded(pre_tokens(text, BPE), BPE) for i in e.ids] == whole
    model = processor(PIECES)
    assert [i for w in marked_words(text) for i in model.encode(w)] == model.encode(text)


def test_counts_of_edge_texts(spark):
    library = Tokenizer.from_file(BPE)
    found = token_counts(rows(spark), BPE, 5).collect()
    assert len(found) == len(TEXTS) + 2
    for r in found:
        text = TEXTS[r.doc_id] or ""
        wanted = {len(library.encode(t, add_special_tokens=False).ids) for t in (text, "a")}
        assert r.n_tokens in wanted and r.over_limit == (r.n_tokens > 5)
    assert {r.doc_id: r.n_bytes for r in found if r.doc_id != 3} == {
        i: len((t or "").encode()) for i, t in enumerate(TEXTS) if i != 3
    }


def test_pieces_of_edge_texts(spark):
    model = processor(PIECES)
    found = {r.doc_id: r for r in encode_texts(rows(spark), PIECES, ids=True).collect()}
    for i, text in enumerate(TEXTS):
        if i == 3:
            continue
        ids = model.encode(text or "", add_bos=True, add_eos=True)
        assert found[i].ids == ids and found[i].decoded == model.decode(ids)


def test_empty_table(spark):
    none = rows(spark).limit(0)
    assert token_counts(none, BPE, 5).count() == 0
    assert encode_texts(none, PIECES).count() == 0


def test_queries_equal_the_libraries(spark):
    library, model = Tokenizer.from_file(BPE), processor(PIECES)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    counts = QUERIES["op3_token_counts"](spark, SF_DIR).collect()
    assert len(counts) == len(texts)
    for r in counts:
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)
    pieces = QUERIES["op9_sentencepiece"](spark, SF_DIR).collect()
    assert len(pieces) == len(texts)
    for r in pieces:
        ids = model.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        raw = np.array(ids, "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(raw).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()
