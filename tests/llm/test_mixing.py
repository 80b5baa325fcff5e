"""Mixing: held-out accuracy, rates against a plain solver, totals, and edge rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from paxflow.llm.mixing import CLEAN, DOMAINS, WEIGHTS, features, fit, mix, mixed_rates, softmax

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels")]


def test_held_out_accuracy(spark):
    large = SF_DIR.replace("0.01", "0.1")
    docs, labels = (spark.read.parquet(f"{large}/{n}.parquet") for n in ("documents", "labels"))
    rows = docs.join(labels, "doc_id").select("doc_id", "text", "quality", "toxic").collect()
    rows.sort(key=lambda r: hash((r.doc_id, r.doc_id)))
    xs = [features(r.text.encode())[1] for r in rows]
    ys = np.array([2 if r.toxic else 0 if r.quality else 1 for r in rows])
    cut = len(xs) * 3 // 4
    model = fit(xs[:cut], ys[:cut])
    found = [softmax((model[x].sum(axis=0) + model[-1])[None])[0].argmax() for x in xs[cut:]]
    assert (np.array(found) == ys[cut:]).mean() >= 0.85  # a twentieth of the labels are drawn at random


def test_rates_equal_a_plain_solver(tables):
    rows = mixed_rates(*tables).toPandas()
    p = rows[[f"p_{d}" for d in DOMAINS]].to_numpy()
    t = rows.n_tokens.to_numpy().astype(float)
    totals = t @ p
    targets = np.array([WEIGHTS[d] for d in DOMAINS]) * totals[0] / WEIGHTS["good"]
    scale = ((p * t[:, None]).T @ p).diagonal()
    loss = lambda w: (((w * t) @ p - targets) ** 2 / scale).sum()
    w = np.ones(len(t))
    for _ in range(3000):
        w = np.maximum(0, w - p @ (((w * t) @ p - targets) / scale) / 3)
    assert (rows.rate >= 0).all()
    assert loss(rows.rate.to_numpy()) <= loss(w) + 1e-2 * loss(np.ones(len(t)))
    assert abs((rows.rate * t * p[:, 0]).sum() / targets[0] - 1) < 0.02
    assert ((rows.copies - rows.rate).abs() <= 1).all()
    drawn = (rows.copies * t * p[:, 0]).sum()
    assert abs(drawn / targets[0] - 1) < 0.1


def test_mixture_drops_toxic_and_keeps_clean_documents(spark):
    large = SF_DIR.replace("0.01", "0.1")
    docs, labels = (spark.read.parquet(f"{large}/{n}.parquet") for n in ("documents", "labels"))
    kept = mix(docs, labels, most=1.0)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert len(ids) == len(set(ids))
    insults = F.lower("text").rlike(r"(?s)(idiot|moron|scum|clown|trash).*(loser|stupid|worthless|pathetic)")
    toxic = {r.doc_id for r in docs.filter(insults).select("doc_id").collect()}
    clean = {r.doc_id for r in labels.filter("toxic = 0 AND quality = 1").collect()}
    assert len(clean - set(ids)) <= 0.01 * len(clean)
    assert len(toxic & set(ids)) <= 0.2 * len(toxic)


def test_edge_rows(spark):
    data = [(1, "good words here", "r"), (2, None, "r"), (3, "", None), (None, "x y", "r"), (1, "good words here", "r")]
    docs = spark.createDataFrame(data, "doc_id long, text string, rate string")
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 0), (None, 1, 1), (9, 1, None), (3, None, None)],
        "doc_id long, quality int, toxic int",
    )
    assert mixed_rates(docs, labels).count() == 5
    assert mixed_rates(docs, labels.limit(0)).filter(F.abs(F.col("p_good") - 1 / 3) < 1e-9).count() == 5
    assert mixed_rates(docs.limit(0), labels).count() == 0
    assert mix(docs, labels, most=1.0).columns == docs.columns


def test_kept_tokens_meet_the_targets_of_each_domain(spark):
    large = SF_DIR.replace("0.01", "0.1")
    docs, labels = (spark.read.parquet(f"{large}/{n}.parquet") for n in ("documents", "labels"))
    rows = mixed_rates(docs, labels, most=1.0).toPandas().set_index("doc_id")
    ids = [r.doc_id for r in mix(docs, labels, most=1.0).select("doc_id").collect()]
    assert len(ids) == len(set(ids))
    mass = rows[[f"p_{d}" for d in DOMAINS]].mul(rows.n_tokens, axis=0)
    total, kept = mass.sum(), mass.loc[ids].sum()
    for d in DOMAINS:  # with rates up to one a domain cannot have more than all its tokens
        target = min(total[f"p_{d}"], WEIGHTS[d] / WEIGHTS["good"] * total.p_good)
        assert abs(kept[f"p_{d}"] / target - 1) < 0.1, d
    assert set(rows.index[rows.p_good >= CLEAN]) <= set(ids)
