"""Mixing to target weights by soft membership.

A softmax classifier, fitted on a bounded sample of the labelled table, gives every document its
posterior over the domains ``good``, ``poor`` and ``toxic``. A document then counts towards each
domain with its tokens times its posterior, and distributed projected-gradient least squares fits a
nonnegative rate for each document so that the expected token totals of the domains meet their
targets. Starting from one, a rate moves against its posterior times the residuals, and is cut off
at zero; residuals are relative to a domain's own weight, so a rare domain counts as much as a
common one. With ``most`` rates are cut off there too (1 for a mixture without repeats). Each round is one aggregation over a narrow staged table; only the residuals, one number
per domain, pass through the driver. Rates are staged every few rounds, so a lost executor costs no
more than those.

Targets are shares of a budget in which the ``anchor`` domain is kept whole. Rates become copies by
a seeded, unbiased draw, so the token totals of the drawn rows meet the targets as those of the rates
do. With ``whole`` documents of at least that posterior of the anchor keep the rate one, and the
others are fitted to what these leave of the targets.

Bounds: at most ``LABELLED`` labelled documents, the first by a hash of their identifier, fit the
classifier. Everything else covers all documents and all labels' words.

Defined results: null or empty texts have no tokens and no words: they are rated by their prior.
Labels that are null count as good and not toxic; of several labels of a document the worst counts.
Without labels all posteriors are equal. Repeated rows are rated alike. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paxflow.llm.common import fresh, whole_text
from paxflow.plans.stage import staged

DOMAINS = ("good", "poor", "toxic")
#: Shares of the mixture; the anchor's tokens are kept whole. Labels are noisy: about one clean text
#: in fifteen is called toxic, so that share of expected tokens stays when every toxic text is gone.
WEIGHTS = {"good": 0.86, "poor": 0.07, "toxic": 0.07}
ANCHOR = "good"
#: Posterior of the anchor from which on ``mix`` keeps a document.
CLEAN = 0.8
LABELLED = 20_000
FEATURES = 1 << 18
#: Steps in which the dense figures of a text are told apart, and how many figures there are.
STEPS, FIGURES = 20, 4
#: Labelled documents a word must stand in to be learnt: at least, and one in so many.
RARE, RARE_SHARE = 5, 500
ROUNDS, STAGE_EVERY, SETTLED = 60, 10, 1e-5

MARKS = b"#*$%&|<>"
PUNCTUATION = bytes(set(range(33, 127)) - set(b"0123456789") - set(range(65, 91)) - set(range(97, 123)))


def features(text: bytes) -> tuple[int, np.ndarray]:
    """Number of words, and the hashed distinct words and stepped figures of a text."""
    words = text.lower().translate(None, PUNCTUATION).split()
    distinct = set(words)
    n = max(1, len(text))
    figures = (
        sum(map(text.count, (MARKS[i : i + 1] for i in range(len(MARKS))))) / n,
        (len(text) - len(text.translate(None, bytes(range(65, 91))))) / n,
        text.count(b"!") / n,
        1 - len(distinct) / max(1, len(words)),
    )
    dense = [i * STEPS + min(STEPS - 1, int(STEPS * x)) for i, x in enumerate(figures)]
    hashed = np.fromiter(map(hash, distinct), np.int64, len(distinct)) % (FEATURES - FIGURES * STEPS)
    return len(words), np.unique(np.concatenate([hashed + FIGURES * STEPS, dense])).astype(np.uint32)


def _featured(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if os.environ.get("PYTHONHASHSEED", "random") == "random":
        raise RuntimeError("workers need one PYTHONHASHSEED, which Spark sets by default")
    for block in rows:
        found = [features(t.as_py()) for t in block.column("raw")]
        columns = [
            block.column("doc_id"),
            block.column("digest"),
            pa.array([n for n, _ in found], pa.int64()),
            pa.array([x.tobytes() for _, x in found], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "digest", "n_tokens", "features"])


def fit(
    samples: list[np.ndarray],
    classes: np.ndarray,
    passes: int = 4,
    rate: float = 0.1,
    decay: float = 1e-2,
) -> np.ndarray:
    """Softmax regression with Adagrad steps on small batches; the last row is the bias."""
    weights = np.zeros((FEATURES + 1, len(DOMAINS)), np.float32)
    if not samples:
        return weights
    # Words of a few documents would only learn those documents' labels by heart.
    common = np.zeros(FEATURES, np.int32)
    for own in samples:  # each holds a feature once; all together would fill the driver
        common[own] += 1
    common = common >= max(RARE, len(samples) // RARE_SHARE)
    samples = [x[common[x]] for x in samples]
    squares = np.full(weights.shape, 1e-2, np.float32)
    draw = np.random.default_rng(0)
    for _ in range(passes):
        order = draw.permutation(len(samples))
        for start in range(0, len(order), 128):
            chosen = order[start : start + 128]
            own = [np.append(samples[i], FEATURES) for i in chosen]
            lengths = np.fromiter(map(len, own), np.int64, len(own))
            flat = np.concatenate(own)
            doc = np.repeat(np.arange(len(own)), lengths)
            scores = np.zeros((len(own), len(DOMAINS)))
            np.add.at(scores, doc, weights[flat])
            miss = softmax(scores)
            miss[np.arange(len(own)), classes[chosen]] -= 1
            used, place = np.unique(flat, return_inverse=True)
            steps = np.zeros((len(used), len(DOMAINS)))
            np.add.at(steps, place, miss[doc] / len(own))
            steps += decay * weights[used]
            squares[used] += steps**2
            weights[used] -= rate * steps / np.sqrt(squares[used])
    return weights


def softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def _posterior(model):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.value
        for block in rows:
            scores = np.zeros((block.num_rows, len(DOMAINS)))
            for i, raw in enumerate(block.column("features")):
                own = np.frombuffer(raw.as_py(), np.uint32)
                scores[i] = weights[own].sum(axis=0) + weights[FEATURES]
            found = softmax(scores) if block.num_rows else scores
            keep = [block.column(c) for c in ("doc_id", "digest", "n_tokens")]
            made = [pa.array(found[:, k], pa.float64()) for k in range(len(DOMAINS))]
            names = ["doc_id", "digest", "n_tokens", *(f"p_{d}" for d in DOMAINS)]
            yield pa.RecordBatch.from_arrays([*keep, *made], names=names)

    return run


def posteriors(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Staged: ``doc_id, digest, n_tokens`` and the posterior of each domain."""
    spark = docs.sparkSession
    text = whole_text(text_column)
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("digest"), text.cast("binary").alias("raw")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    made = rows.mapInArrow(_featured, f"doc_id {kind}, digest long, n_tokens long, features binary")
    made = staged(made, "mixing-features")
    toxic, quality = F.coalesce("toxic", F.lit(0)), F.coalesce("quality", F.lit(1))
    domain = F.when(toxic != 0, 2).when(quality == 0, 1).otherwise(0)
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(domain).alias("domain"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    sample = made.join(known, "doc_id").select("doc_id", "digest", "features", "domain")
    # In Arrow's own buffers: rows would hold every sample twice more in the driver.
    sample = sample.dropDuplicates(["doc_id"]).select("features", "domain", "doc_id").toArrow()
    ids = sample.column("doc_id").to_pylist()
    order = sorted(range(len(ids)), key=ids.__getitem__)
    raw = [x.as_buffer() for x in sample.column("features")]
    model = fit(
        [np.frombuffer(raw[i], np.uint32) for i in order],
        sample.column("domain").to_numpy().astype(np.int64)[order],
    )
    shared = spark.sparkContext.broadcast(model)
    columns = ", ".join(f"p_{d} double" for d in DOMAINS)
    found = made.mapInArrow(_posterior(shared), f"doc_id {kind}, digest long, n_tokens long, {columns}")
    return staged(found.withColumn("rate", F.lit(1.0)), "mixing-posteriors")


def _moved(pulls: list[np.ndarray], most: float, at: int, whole: float):
    """Rates after the given rounds: against posterior times residual, within bounds; those of
    documents that are kept whole stay."""

    def rates(block: pa.RecordBatch) -> np.ndarray:
        p = np.stack([block.column(f"p_{d}").to_numpy() for d in DOMAINS], axis=1)
        rate = block.column("rate").to_numpy()
        fixed = p[:, at] >= whole
        for pull in pulls:
            rate = np.where(fixed, rate, np.clip(rate - p @ pull, 0.0, most))
        return rate

    return rates


def fit_rates(
    rows: DataFrame, weights: dict[str, float], anchor: str, most: float, rounds: int, whole: float
) -> DataFrame:
    """``rows`` with the fitted ``rate``."""
    p = [F.col(f"p_{d}") for d in DOMAINS]
    t = F.col("n_tokens").cast("double")
    pairs = [(i, j) for i in range(len(DOMAINS)) for j in range(i, len(DOMAINS))]
    first = rows.agg(*[F.sum(t * x) for x in p], *[F.sum(t * p[i] * p[j]) for i, j in pairs]).first()
    totals = np.array([x or 0.0 for x in first[: len(DOMAINS)]])
    cross = np.zeros((len(DOMAINS), len(DOMAINS)))
    for (i, j), x in zip(pairs, first[len(DOMAINS) :]):
        cross[i, j] = cross[j, i] = x or 0.0
    wanted = np.array([weights[d] for d in DOMAINS])
    at = DOMAINS.index(anchor)
    targets = wanted * (totals[at] / wanted[at])
    own = np.maximum(cross.diagonal(), 1e-9)
    scale = np.linalg.eigvalsh(cross / np.sqrt(np.outer(own, own))).max() or 1.0
    pulls: list[np.ndarray] = []
    reached, last = totals, None
    for number in range(rounds):
        pulls.append((reached - targets) / own / scale)
        if last is not None and np.abs(pulls[-1] - last).max() < SETTLED:
            break
        last = pulls[-1]
        if len(pulls) >= STAGE_EVERY:
            rows, pulls = staged(_with_rate(rows, pulls, most, at, whole), "mixing-rates"), []
        reached = _reached(rows, pulls, most, at, whole)
    return _with_rate(rows, pulls, most, at, whole)


def _with_rate(
    rows: DataFrame, pulls: list[np.ndarray], most: float, at: int, whole: float
) -> DataFrame:
    rates = _moved(pulls, most, at, whole)

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            place = block.schema.get_field_index("rate")
            yield block.set_column(place, "rate", pa.array(rates(block), pa.float64()))

    return rows.mapInArrow(run, rows.schema)


def _reached(
    rows: DataFrame, pulls: list[np.ndarray], most: float, at: int, whole: float
) -> np.ndarray:
    rates = _moved(pulls, most, at, whole)

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(DOMAINS))
        for block in blocks:
            used = rates(block) * block.column("n_tokens").to_numpy()
            total += [used @ block.column(f"p_{d}").to_numpy() for d in DOMAINS]
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total], names=list(DOMAINS))

    parts = rows.mapInArrow(run, ", ".join(f"{d} double" for d in DOMAINS))
    return np.array([x or 0.0 for x in parts.agg(*[F.sum(d) for d in DOMAINS]).first()])


def mixed_rates(
    docs: DataFrame,
    labels: DataFrame,
    weights: dict[str, float] = WEIGHTS,
    anchor: str = ANCHOR,
    most: float = float("inf"),
    seed: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    rounds: int = ROUNDS,
    whole: float = float("inf"),
) -> DataFrame:
    """Per row: ``doc_id, n_tokens``, the posteriors, ``rate``, ``copies`` by a seeded draw, and the
    text's hash as ``digest``."""
    rows = posteriors(docs, labels, id_column, text_column)
    rows = fit_rates(rows, weights, anchor, most, rounds, whole)
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("digest")), F.lit(1 << 30))
    copies = F.floor(F.col("rate") + draw / F.lit(float(1 << 30))).cast("long")
    return rows.withColumn("copies", copies).select(
        "doc_id", "n_tokens", *(f"p_{d}" for d in DOMAINS), "rate", "copies", "digest"
    )


def mix(
    docs: DataFrame,
    labels: DataFrame,
    weights: dict[str, float] = WEIGHTS,
    anchor: str = ANCHOR,
    most: float = float("inf"),
    id_column: str = "doc_id",
    text_column: str = "text",
    seed: int = 0,
    whole: float = CLEAN,
) -> DataFrame:
    """The documents, all columns, each as often as a seeded draw by its rate says."""
    key = fresh(docs, "mixed_digest")
    rates = mixed_rates(
        docs, labels, weights, anchor, most, seed, id_column, text_column, whole=whole
    )
    times = rates.select(
        F.col("doc_id").alias("rated_id"),
        F.col("digest").alias("rated_digest"),
        F.col("copies").cast("int").alias("rated_times"),
    ).filter("rated_times > 0")
    times = times.dropDuplicates(["rated_id", "rated_digest"])
    named = docs.withColumn(key, F.xxhash64(whole_text(text_column)))
    match = named[id_column].eqNullSafe(times["rated_id"]) & (named[key] == times["rated_digest"])
    taken = named.join(times, match)
    again = F.explode(F.sequence(F.lit(1), F.col("rated_times")))
    return taken.select(*[named[c] for c in docs.columns], again.alias(key)).drop(key)
