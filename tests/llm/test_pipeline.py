"""The pipeline, stage by stage, against plain versions of each stage on its own input."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from paxflow.llm.queries import ORACLE
from tests.llm.test_shingle_join import brute
from workload.compare import connect

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and every stage's rows."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / "out")
        made = stage(spark, docs, SF_DIR)
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert made.columns == docs.columns, name
        made.write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def ids(rows):
    return [r.doc_id for r in rows]


def test_quality(steps):
    answer = connect(SF_DIR).execute(f"SELECT doc_id FROM ({ORACLE['op5_quality_rules']}) WHERE kept")
    assert sorted(ids(steps[1])) == sorted(r[0] for r in answer.fetchall())
    before = {r.doc_id: r for r in steps[0]}
    assert all(before[r.doc_id] == r for r in steps[1])


def test_exact(steps):
    last = {}
    for r in steps[1]:
        last[r.text] = max(last.get(r.text, r.doc_id), r.doc_id)
    assert sorted(ids(steps[2])) == sorted(last.values())


def test_near(steps):
    component = {doc: c for doc, _, c in brute([(r.doc_id, r.text) for r in steps[2]])}
    kept = [component[i] for i in ids(steps[3])]
    assert len(kept) == len(set(kept)) and set(kept) == set(component.values())


def test_mixture(spark, steps):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    before, after = set(ids(steps[3])), ids(steps[4])
    assert len(after) == len(set(after)) and set(after) <= before
    clean = {i for i in before if i in labels and labels[i].quality and not labels[i].toxic}
    assert len(clean - set(after)) <= 0.02 * len(clean)


def test_pieces_and_run(spark, steps):
    model = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in steps[4]}
    wanted = set()
    for doc, text in texts.items():
        own = model.encode(text, add_bos=True, add_eos=True)
        wanted.add(
            (
                doc,
                len(own),
                hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(model.decode(own).encode()).hexdigest(),
            )
        )
    assert set(map(tuple, steps[5])) == wanted and len(steps[5]) == len(wanted)
    assert set(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == wanted
