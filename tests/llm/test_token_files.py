"""Directly addressable codes: round trips, random access, and the query against the library."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from paxflow.llm.queries import QUERIES
from paxflow.llm.token_files import Segment, encode, token_files

BPE = public_tokenizers.path("byte_bpe_50k.json")
SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("top", [1, 200, 256, 257, 50_257, 1 << 20, (1 << 32) - 1])
@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_round_trip_and_random_access(n, top):
    ids = np.random.default_rng(n + top).integers(0, top + 1, n).astype(np.uint32)
    segment = Segment(encode(ids))
    assert segment.n == n and np.array_equal(segment.ids(0, n), ids)
    for place in range(0, n, 37):
        assert segment[place] == ids[place]
        assert np.array_equal(segment.ids(place, min(n, place + 100)), ids[place : place + 100])


def brute(texts):
    library, start, out = Tokenizer.from_file(BPE), 0, []
    for doc, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_edge_rows(spark):
    data = [(5, "a b", "x"), (None, "n", "x"), (1, None, "x"), (5, "a b", "x"), (3, "", None), (2, "w " * 9000, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, segment string")
    found = sorted(map(tuple, token_files(docs, BPE).collect()), key=lambda r: r[1])
    assert found == brute(sorted(((d, t) for d, t, _ in data), key=lambda r: (r[0] is not None, r[0])))
    assert token_files(docs.limit(0), BPE).count() == 0


def test_query_equals_the_library(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = sorted(map(tuple, QUERIES["op7_token_files"](spark, SF_DIR).collect()))
    assert found == brute(sorted(map(tuple, docs)))
