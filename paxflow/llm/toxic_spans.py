"""Toxic spans by a linear-chain conditional random field.

Tokens carry one of two tags, clean or toxic. ``evidence`` labels tokens from documents that are
labelled: a word, or the beginning or end of words, that stands in toxic documents nearly alone (by
the lower Wilson bound, families of near copies counted once) makes its tokens toxic there. ``fit``
learns the field from those tokens: weights of a word, of its beginnings and ends and of its shape,
and of the steps from tag to tag. Forward and backward sums give each token's marginal probability
of being toxic; a document's score is a logistic function of the marginals, fitted on the same
documents, and its spans are the runs of tokens of at least one half.

Each text is scored whole, batch by batch inside Spark's tasks: the chain of a batch is laid out in
columns that numpy walks side by side, and a step into a new document forgets the last one, so the
length of a document changes neither the method nor the memory beyond its own tokens.

Bounds: at most ``SAMPLE`` toxic and as many clean labelled documents of at most ``SAMPLE_CHARS``
characters, the first by a hash of their identifier, are learnt from, in the driver. The model that
is broadcast holds at most ``FEATURES`` weights. Every document is scored whatever its length.

Defined results: a null or empty text has no tokens and gets the score of a text without toxic
tokens. A null identifier counts as the empty text and is never learnt from. Null labels are no
labels; of several labels of a document the worst counts. Without labels of both kinds every score is
the share of toxic labels (0 without any). Repeated rows are scored alike. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxflow.llm.common import whole_text

SAMPLE, SAMPLE_CHARS = 1_500, 20_000
FEATURES = 200_000
#: One document in so many is held out of learning.
FOLDS = 5
#: Lengths of the beginnings and ends that are features of words longer by two letters at least.
AFFIXES = (4, 5, 6)
#: Lower bound of the share of toxic documents among those with a feature that makes it evidence.
SURE = 0.6
#: Beginnings and ends are penalised more than whole words, which tell more.
ROUNDS, RIDGE, AFFIX_RIDGE, BEND = 30, 0.5, 3.0, 0.02
#: Words whose weight a worker remembers.
REMEMBERED = 300_000

TOKEN = re.compile(r"\w+")


@dataclass(frozen=True)
class Model:
    """Weights of features (toxic against clean), of steps between tags, and of the score."""

    weights: dict[str, float]
    bias: float
    start: float
    steps: np.ndarray
    score: np.ndarray


def word_features(word: str) -> list[str]:
    """Of one token as it stands in the text."""
    low = word.lower()
    long = [n for n in AFFIXES if n + 2 <= len(low)]
    found = ["=" + low, *["^" + low[:n] for n in long], *["$" + low[-n:] for n in long]]
    if len(word) > 1 and word.isupper():
        found.append("#upper")
    elif low.isdigit():
        found.append("#digits")
    return found


def marginals(odds: np.ndarray, first: np.ndarray, start: float, steps: np.ndarray) -> np.ndarray:
    """Probability of the toxic tag of each token of a chain; where ``first`` holds, a text begins.

    ``odds`` is each token's toxic weight less its clean one. The chain is cut into columns of one
    length: a walk down all columns at once finds what each does to the sums that enter it, these
    are carried across the columns, and two more walks give the sums at each token.
    """
    return _sums(odds, first, start, steps)[0]


def _sums(odds, first, start, steps):
    """Marginals, the expected count of each step from tag to tag, and the log of the total."""
    n = len(odds)
    if not n:
        return np.zeros(0), np.zeros((2, 2)), 0.0
    high = max(1, int(np.sqrt(n)))
    wide = -(-n // high)
    pad = high * wide - n
    grid = lambda x, fill: np.concatenate([x, np.full(pad, fill)]).reshape(wide, high).T.copy()
    # Scaled so that the larger of a token's two factors is one.
    toxic = np.exp(np.minimum(odds, 0))
    clean = np.exp(-np.maximum(odds, 0))
    e1, e0 = grid(toxic, 1.0), grid(clean, 1.0)
    new = grid(first.astype(bool), False)
    a = np.exp(steps)
    begin = np.exp(start)
    a00, a01 = np.where(new, 1.0, a[0, 0]) * e0, np.where(new, begin, a[0, 1]) * e1
    a10, a11 = np.where(new, 1.0, a[1, 0]) * e0, np.where(new, begin, a[1, 1]) * e1
    if pad:  # the tokens that fill the last column change nothing
        flat = np.arange(high * wide).reshape(wide, high).T >= n
        a00[flat], a01[flat], a10[flat], a11[flat] = 1.0, 0.0, 0.0, 1.0
    # What a column does as a whole, scaled.
    m00, m01, m10, m11 = np.ones(wide), np.zeros(wide), np.zeros(wide), np.ones(wide)
    for t in range(high):
        m00, m01, m10, m11 = (
            m00 * a00[t] + m01 * a10[t],
            m00 * a01[t] + m01 * a11[t],
            m10 * a00[t] + m11 * a10[t],
            m10 * a01[t] + m11 * a11[t],
        )
        size = m00 + m01 + m10 + m11
        m00, m01, m10, m11 = m00 / size, m01 / size, m10 / size, m11 / size
    into = np.empty((wide, 2))
    x = (1.0, 0.0)
    for c in range(wide):
        into[c] = x
        y = (x[0] * m00[c] + x[1] * m10[c], x[0] * m01[c] + x[1] * m11[c])
        size = y[0] + y[1]
        x = (y[0] / size, y[1] / size)
    out = np.empty((wide, 2))
    x = (0.5, 0.5)
    for c in range(wide - 1, -1, -1):
        out[c] = x
        y = (m00[c] * x[0] + m01[c] * x[1], m10[c] * x[0] + m11[c] * x[1])
        size = y[0] + y[1]
        x = (y[0] / size, y[1] / size)
    f0, f1 = np.empty((high, wide)), np.empty((high, wide))
    p0, p1 = into[:, 0], into[:, 1]
    total = 0.0
    for t in range(high):
        p0, p1 = p0 * a00[t] + p1 * a10[t], p0 * a01[t] + p1 * a11[t]
        size = p0 + p1
        p0, p1 = p0 / size, p1 / size
        f0[t], f1[t] = p0, p1
        total += np.log(size).sum()
    b0, b1 = np.empty((high, wide)), np.empty((high, wide))
    q0, q1 = out[:, 0], out[:, 1]
    for t in range(high - 1, -1, -1):
        b0[t], b1[t] = q0, q1
        q0, q1 = a00[t] * q0 + a01[t] * q1, a10[t] * q0 + a11[t] * q1
        size = q0 + q1
        q0, q1 = q0 / size, q1 / size
    line = lambda x: x.T.reshape(-1)[:n]
    f0, f1, b0, b1 = line(f0), line(f1), line(b0), line(b1)
    p = f1 * b1 / (f0 * b0 + f1 * b1)
    # Expected steps inside texts.
    inner = ~first[1:].astype(bool)
    g0, g1, h0, h1 = f0[:-1][inner], f1[:-1][inner], b0[1:][inner], b1[1:][inner]
    k0, k1 = clean[1:][inner], toxic[1:][inner]
    w = [g0 * a[0, 0] * k0 * h0, g0 * a[0, 1] * k1 * h1, g1 * a[1, 0] * k0 * h0, g1 * a[1, 1] * k1 * h1]
    size = w[0] + w[1] + w[2] + w[3]
    counts = np.array([(x / size).sum() for x in w]).reshape(2, 2)
    return p, counts, total + float(np.maximum(odds, 0).sum())


def evidence(texts: list[str], toxic: np.ndarray) -> set[str]:
    """Features that stand in toxic documents nearly alone, and in so many that of all features tried
    less than one would by chance. Near copies, found by one least hash of
    three words in a row, count as one document with their mean label."""
    family: dict[int, list[int]] = {}
    features = functools.cache(word_features)
    words = []
    for i, text in enumerate(texts):
        found = TOKEN.findall(text.lower())
        words.append(set(found))
        runs = (zlib.crc32(" ".join(found[j : j + 3]).encode()) for j in range(max(1, len(found) - 2)))
        family.setdefault(min(runs) if found else -1 - i, []).append(i)
    seen, bad = Counter(), Counter()
    for members in family.values():
        share = float(np.mean(toxic[members]))
        own = {f for w in set().union(*(words[i] for i in members)) for f in features(w)}
        seen.update(own)
        if share:
            for f in own:
                bad[f] += share
    z, share, tested = 1.96, sum(np.mean(toxic[m]) for m in family.values()) / max(1, len(family)), len(seen)
    sure = set()
    for f, k in bad.items():
        n = seen[f]
        p = k / n
        low = (p + z * z / (2 * n) - z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        if low < max(SURE, share):
            continue
        # How unlikely so many toxic documents are by chance, against the number of features tried.
        odds = k * np.log(p / share) + ((n - k) * np.log((1 - p) / (1 - share)) if n - k > 1e-9 else 0)
        if odds >= np.log(tested):
            sure.add(f)
    return sure


def labelled_tokens(texts: list[str], toxic: np.ndarray) -> list[tuple[list[str], np.ndarray]]:
    """Tokens and tags of the documents that can teach: clean ones, and toxic ones with evidence."""
    sure = evidence(texts, toxic)
    is_sure: dict[str, bool] = {}
    out = []
    for text, bad in zip(texts, toxic):
        words = TOKEN.findall(text)
        tags = np.zeros(len(words), bool)
        if bad:
            for i, w in enumerate(words):
                hit = is_sure.get(w)
                if hit is None:
                    hit = is_sure[w] = any(f in sure for f in word_features(w))
                tags[i] = hit
        out.append((words, tags))
    return out


def fit(tokens: list[tuple[list[str], np.ndarray]], labels: np.ndarray, weights: np.ndarray) -> Model:
    """The field of the most likely tags, and the score of the most likely labels.

    ``tokens`` are words and tags of each document, ``labels`` whether it is toxic, ``weights`` how many
    documents of the whole table it stands for. Toxic documents without a toxic token teach the
    score only.
    """
    share = float((labels * weights).sum() / weights.sum()) if len(labels) else 0.0
    prior = np.array([np.log((share + 1e-9) / (1 - share + 1e-9)), 0.0, 0.0])
    flat = Model({}, -30.0, 0.0, np.zeros((2, 2)), prior)
    if not 0 < share < 1:
        return flat
    learnt = [(w, t) for (w, t), bad in zip(tokens, labels) if len(w) and (t.any() or not bad)]
    if not any(t.any() for _, t in learnt):
        return flat
    kinds: dict[str, int] = {}
    ids = np.array([kinds.setdefault(w, len(kinds)) for words, _ in learnt for w in words], np.int64)
    tags = np.concatenate([t for _, t in learnt])
    first = np.zeros(len(ids), bool)
    first[np.cumsum([0, *[len(t) for _, t in learnt[:-1]]])] = True
    # Features of kinds of words; rare ones only where a toxic token has them.
    hot = np.bincount(ids[tags], minlength=len(kinds)) > 0
    often = np.bincount(ids, minlength=len(kinds))
    own = [word_features(w) for w in kinds]
    counts: Counter = Counter()
    for fs, n, h in zip(own, often, hot):
        for f in fs:
            counts[f] += int(n) * (1_000_000 if h else 1)
    names = {f: i for i, (f, n) in enumerate(counts.most_common(FEATURES)) if n >= 5}
    rows, cols = [], []
    for k, fs in enumerate(own):
        for f in fs:
            if f in names:
                rows.append(k)
                cols.append(names[f])
    rows, cols = np.array(rows, np.int64), np.array(cols, np.int64)
    # theta: weights of features, bias, start, four steps.
    size = len(names)
    theta = np.zeros(size + 6)
    theta[size] = np.log(tags.mean())
    at = np.zeros((2, 2))
    inner = ~first[1:]
    np.add.at(at, (tags[:-1][inner].astype(int), tags[1:][inner].astype(int)), 1)
    tagged = np.bincount(ids[tags], minlength=len(kinds))

    ridge = np.full(len(theta), RIDGE)
    ridge[[i for f, i in names.items() if f[0] in "^$"]] = AFFIX_RIDGE

    def loss(theta: np.ndarray) -> tuple[float, np.ndarray]:
        """Minus the log likelihood of the tags, with the ridge, and its gradient."""
        kind_odds = np.bincount(rows, theta[cols], len(kinds)) + theta[size]
        steps = theta[size + 2 :].reshape(2, 2)
        p, went, total = _sums(kind_odds[ids], first, theta[size + 1], steps)
        given = tagged @ kind_odds + tags[first].sum() * theta[size + 1] + (at * steps).sum()
        miss = np.bincount(ids, p, len(kinds)) - tagged
        gradient = ridge * theta
        gradient[:size] += np.bincount(cols, miss[rows], size)
        gradient[size] += miss.sum()
        gradient[size + 1] += p[first].sum() - tags[first].sum()
        gradient[size + 2 :] += (went - at).ravel()
        return total - given + 0.5 * theta @ (ridge * theta), gradient

    # Common features bend the loss most: in units of their bend the steps suit all.
    bend = np.bincount(cols, often[rows], size)
    unit = 1 / np.sqrt(ridge + BEND * np.concatenate([bend, np.full(6, len(ids))]))

    def scaled(u: np.ndarray) -> tuple[float, np.ndarray]:
        value, gradient = loss(u * unit)
        return value, gradient * unit

    theta = descend(scaled, theta / unit, ROUNDS) * unit
    learned = {f: float(theta[i]) for f, i in names.items() if abs(theta[i]) > 1e-3}
    model = Model(learned, float(theta[size]), float(theta[size + 1]), theta[size + 2 :].reshape(2, 2), prior)
    figures = _figures(model, [w for w, _ in tokens])
    return Model(model.weights, model.bias, model.start, model.steps, _logistic(figures, labels, weights))


def descend(loss, x: np.ndarray, rounds: int, memory: int = 8, settled: float = 1e-4) -> np.ndarray:
    """Limited-memory quasi-Newton steps with backtracking on a smooth convex loss."""
    value, slope = loss(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        way, coefficients = slope.copy(), []
        for move, turn, curve in reversed(past):
            c = (move @ way) / curve
            coefficients.append(c)
            way -= c * turn
        if past:
            move, turn, curve = past[-1]
            way *= curve / (turn @ turn)
        else:
            way /= max(1.0, float(np.abs(slope).max()))
        for (move, turn, curve), c in zip(past, reversed(coefficients)):
            way += (c - (turn @ way) / curve) * move
        pace, fall = 1.0, float(way @ slope)
        for _ in range(20):
            new, gradient = loss(x - pace * way)
            if new <= value - 1e-4 * pace * fall:
                break
            pace /= 2
        else:
            break
        move, turn = -pace * way, gradient - slope
        if move @ turn > 1e-12:
            past = [*past[1 - memory :], (move, turn, float(move @ turn))]
        done = value - new <= settled * abs(new)
        x, value, slope = x + move, new, gradient
        if done:
            break
    return x


def _logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted ridge logistic regression; a figure of toxic tokens that would lower scores has no
    weight."""
    beta, used = np.zeros(x.shape[1] + 1), list(range(x.shape[1]))
    while used:
        own = np.column_stack([np.ones(len(x)), x[:, used]])

        def loss(b: np.ndarray, own=own) -> tuple[float, np.ndarray]:
            z = own @ b
            slopes = np.append(0.0, b[1:])
            miss = weights * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
            value = (weights * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * slopes @ slopes
            return value, own.T @ miss + slopes

        found = descend(loss, np.zeros(own.shape[1]), 200, settled=1e-9)
        if (found[1:] >= 0).all():
            beta[[0, *[i + 1 for i in used]]] = found
            return beta
        used = [i for i, b in zip(used, found[1:]) if b >= 0]
    share = (weights * y).sum() / weights.sum()
    beta[0] = np.log(share / (1 - share))
    return beta


def _odds(model: Model, words: list[str], known: dict[str, float]) -> np.ndarray:
    fresh = {w for w in words if w not in known}
    if len(known) + len(fresh) > REMEMBERED:
        known.clear()
        fresh = set(words)
    weights = model.weights.get
    for w in fresh:
        known[w] = model.bias + sum([weights(f, 0.0) for f in word_features(w)])
    return np.fromiter(map(known.__getitem__, words), np.float64, len(words))


def _chain(model: Model, words: list[list[str]], known: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of all tokens, and where each document starts."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    flat = [w for own in words for w in own]
    first = np.zeros(len(flat), bool)
    first[starts[lengths > 0]] = True
    return marginals(_odds(model, flat, known), first, model.start, model.steps), starts


def _figures(model: Model, words: list[list[str]], p=None, starts=None) -> np.ndarray:
    """Per document: the log of one plus its expected toxic tokens, and its largest marginal."""
    if p is None:
        p, starts = _chain(model, words, {})
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    found = np.zeros((len(words), 2))
    some = lengths > 0
    if some.any():
        found[some, 0] = np.log1p(np.add.reduceat(p, starts[some]))
        found[some, 1] = np.maximum.reduceat(p, starts[some])
    return found


def _spans(text: str, p: np.ndarray) -> list[dict]:
    """Runs of toxic tokens: first and last offset (code points), and the largest marginal."""
    out: list[dict] = []
    last = -2
    for i, m in enumerate(TOKEN.finditer(text)):
        if p[i] < 0.5:
            continue
        if last == i - 1:
            out[-1]["end"] = m.end()
            out[-1]["probability"] = max(out[-1]["probability"], float(p[i]))
        else:
            out.append({"start": m.start(), "end": m.end(), "probability": float(p[i])})
        last = i
    return out


SPANS = "array<struct<start: int, end: int, probability: double>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))
#: Characters of texts that are scored as one chain, unless a single text is longer.
CHAIN = 4_000_000


def _scorer(shared):
    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value, {}
        for block in blocks:
            texts = block.column("raw").to_pylist()
            scores, spans, at = [], [], 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= CHAIN):
                    size += len(texts[end])
                    end += 1
                words = [TOKEN.findall(t) for t in texts[at:end]]
                p, starts = _chain(model, words, known)
                figures = _figures(model, words, p, starts)
                z = model.score[0] + figures @ model.score[1:]
                scores.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
                for i, own in enumerate(words):
                    part = p[starts[i] : starts[i] + len(own)]
                    spans.append(_spans(texts[at + i], part) if figures[i, 1] >= 0.5 else [])
                at = end
            columns = [
                block.column("doc_id"),
                pa.array(np.concatenate(scores) if scores else np.zeros(0)),
                pa.array(spans, _SPANS),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "spans"])

    return run


def held_out(id_column: str = "doc_id") -> Column:
    """Rows that are never learnt from: one in ``FOLDS`` by the checksum of the identifier's text."""
    name = F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % FOLDS == 0


def fit_model(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> Model:
    """Learns from a bounded sample of the labelled documents that are not held out."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.filter(~held_out()).groupBy("doc_id").agg(F.max(F.col("toxic") != 0).alias("bad"))
    sizes = {r["bad"]: r["n"] for r in known.groupBy("bad").agg(F.count("*").alias("n")).collect()}
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), whole_text(text_column).alias("raw"))
    short = rows.filter(F.length("raw") <= SAMPLE_CHARS)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = None
    for bad in (True, False):
        some = known.filter(F.col("bad") == bad).orderBy(*order).limit(SAMPLE)
        sample = some if sample is None else sample.unionByName(some)
    found = short.join(F.broadcast(sample), "doc_id")  # at most 2 * SAMPLE identifiers
    found = found.dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    toxic = np.array([r["bad"] for r in found], bool)
    taken = Counter(toxic.tolist())
    weights = np.array([sizes[b] / taken[b] for b in toxic.tolist()])
    texts = [r["raw"] for r in found]
    return fit(labelled_tokens(texts, toxic), toxic.astype(float), weights)


def toxic_spans(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted`` and the toxic ``spans`` of the text."""
    model = fit_model(docs, labels, id_column, text_column)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), whole_text(text_column).alias("raw"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(_scorer(shared), f"doc_id {kind}, score double, spans {SPANS}")
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "spans",
    )
