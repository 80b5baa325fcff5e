"""The chain against all sequences of tags; scores and spans on labelled and edge rows."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest

from paxflow.llm import queries
from paxflow.llm.toxic_spans import _spans, _sums, marginals, toxic_spans

SF = "/root/testdata/sf0.1"


def by_all_sequences(odds, start, steps):
    total, toxic = 0.0, np.zeros(len(odds))
    for tags in itertools.product((0, 1), repeat=len(odds)):
        score = start * tags[0] + odds @ np.array(tags)
        score += sum(steps[a, b] for a, b in itertools.pairwise(tags))
        total += np.exp(score)
        toxic += np.exp(score) * np.array(tags)
    return toxic / total, np.log(total)


@pytest.mark.parametrize("lengths", [[1], [3], [9, 1, 1, 7], [2] * 11, [12, 12, 12]])
def test_marginals_equal_those_over_all_sequences(lengths):
    draw = np.random.default_rng(sum(lengths))
    odds, steps, start = draw.normal(0, 3, sum(lengths)), draw.normal(0, 1, (2, 2)), 0.4
    ends = np.cumsum(lengths)
    first = np.zeros(ends[-1], bool)
    first[ends - lengths] = True
    plain = [by_all_sequences(odds[e - n : e], start, steps) for e, n in zip(ends, lengths)]
    found, _, total = _sums(odds, first, start, steps)
    assert np.allclose(found, np.concatenate([p for p, _ in plain]))
    assert np.isclose(total, sum(t for _, t in plain))


def test_expected_steps_are_the_slope_of_the_total():
    draw = np.random.default_rng(5)
    odds, steps, first = draw.normal(size=30), draw.normal(size=(2, 2)), np.zeros(30, bool)
    first[[0, 11, 12]] = True
    _, counts, total = _sums(odds, first, 0.3, steps)
    for i, j in itertools.product((0, 1), repeat=2):
        more = steps.copy()
        more[i, j] += 1e-6
        assert np.isclose((_sums(odds, first, 0.3, more)[2] - total) / 1e-6, counts[i, j], atol=1e-3)


def test_a_long_chain_does_not_underflow():
    odds = np.tile([-700.0, 700.0, 0.0], 40_000)
    first = np.zeros(len(odds), bool)
    first[0] = True
    p = marginals(odds, first, 0.0, np.zeros((2, 2)))
    assert p[1] > 0.99 and p[0] < 0.01 and np.isfinite(p).all()


def test_spans_are_runs():
    spans = _spans("you vile worm, go", np.array([0.1, 0.9, 0.7, 0.2]))
    assert [(s["start"], s["end"], s["probability"]) for s in spans] == [(4, 13, 0.9)]


def test_held_out_labels(spark):
    found = queries.op11_toxicity(spark, SF).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").toxic
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert found.score.between(0, 1).all()
    assert (found.predicted == (found.score >= 0.5)).all()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.index]).all()
    both = found.join(labels, how="inner")
    both = both[both.held_out]
    assert (both.predicted == both.toxic).mean() > 0.96
    assert both[both.toxic == 1].predicted.mean() > 0.8
    assert both[both.toxic == 0].predicted.mean() < 0.02


def test_labels_and_other_columns_are_no_input_of_a_score(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(400)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = toxic_spans(docs, labels).select("score").collect()
    held = labels.filter("crc32(cast(cast(doc_id as string) as binary)) % 5 != 0")
    moved = docs.selectExpr("doc_id", "text", "'x' AS source", "1 AS score", "2 AS spans")
    assert toxic_spans(moved, held).select("score").collect() == scores


def test_edge_rows(spark):
    vile = [(i, f"word number{i} and vilest thing{i} of them", 1) for i in range(100, 160)]
    mild = [(i, f"word number{i} and mildest thing{i} of them", 0) for i in range(200, 360)]
    texts = [(i, t) for i, t, _ in vile + mild]
    texts += [(1, None), (2, ""), (None, "vilest"), (3, "x" * 300_000), (4, "vilest " * 50_000), (1, None)]
    texts += [(5, "the vilest of all"), (6, "the mildest of all")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = [(i, 1, bad) for i, _, bad in vile + mild]
    labels += [(1, 1, None), (None, 1, 1), (150, 1, 0), (99_999, 0, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = toxic_spans(docs, labels).collect()
    assert len(rows) == len(texts)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[None].held_out and by_id[None].predicted == 1
    assert by_id[1].predicted == by_id[2].predicted == by_id[3].predicted == 0
    assert by_id[1].score == by_id[2].score and by_id[1].spans == []
    assert by_id[4].predicted == 1 and by_id[5].predicted == 1 and by_id[6].predicted == 0
    assert [("the vilest of all"[s.start : s.end]) for s in by_id[5].spans] == ["vilest"]
    none = toxic_spans(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {none[0].score} and none[0].score < 1e-6
    assert toxic_spans(docs.limit(0), labels).count() == 0
