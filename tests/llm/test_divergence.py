"""The transducer against a sorted list, and the audit against a plain one in whole numbers."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from paxflow.llm.divergence import Transducer, divergence, shares, terms

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def words(n, seed):
    draw = random.Random(seed)
    return sorted({"".join(draw.choices("abäß漢z", k=draw.randint(1, 7))).encode() for _ in range(n)})


@pytest.mark.parametrize("n", [0, 1, 2, 50, 3000])
def test_places_and_terms(n):
    kept = words(n, n)
    machine = Transducer.load(Transducer.build(kept).dump())
    assert machine.size == len(kept)
    asked = kept + [w + b"a" for w in kept] + [w[:-1] for w in kept] + [b"q", b"", b"a" * 5000]
    place = {w: i for i, w in enumerate(kept)}
    assert machine.places(asked).tolist() == [place.get(w, -1) for w in asked]
    assert [machine.term(i) for i in range(len(kept))] == kept


def test_it_is_minimal():
    """As many states as there are different sets of endings."""
    kept = words(400, 7)
    endings = defaultdict(set)
    for w in kept:
        for i in range(len(w) + 1):
            endings[w[:i]].add(w[i:])
    assert len(Transducer.build(kept).final) == len({frozenset(e) for e in endings.values()})


def test_shares_are_exact():
    draw = random.Random(3)
    for _ in range(300):
        total = draw.randrange(1, 1 << 52)
        counts = [draw.randrange(0, total + 1) for _ in range(5)] + [0, total]
        kept = draw.randrange(1, 10**6)
        found = shares(np.array(counts), total, kept)
        assert found.tolist() == [1 + 10**9 * (c + 1) // (total + kept) for c in counts]


def test_terms_lower_only_ascii():
    text = "Aa_Z9Ärger@É`x{y}\x7f漢字\nİI"
    plain = [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text)]
    assert [t.decode() for t in terms(text.encode())] == plain


def plain(rows, least=3, top=200):
    docs = [(lang or "", source or "", [t for t in TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))]) for text, lang, source in rows]
    seen, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, found in docs:
        seen[lang].update(set(found))
        counts[lang, source].update(found)
    out = []
    for lang in seen:
        kept = sorted((t for t, n in seen[lang].items() if n >= least), key=str.encode)
        sources = sorted({s for k, s, _ in docs if k == lang}, key=str.encode)

        def share(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(sorted(pairs))]
            best = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(sorted(best)[:top])]
    return sorted(out)


def found(df, **how):
    return sorted(tuple(r) for r in divergence(df, **how).select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("cells", [1, 1 << 17])
def test_equals_a_plain_audit(spark, cells):
    draw = random.Random(9)
    pool = [w.decode() for w in words(900, 1)] + ["The", "the", "ÄRGER", "ärger"]
    rows = [
        (" ".join(draw.choices(pool, k=draw.randint(0, 60))), draw.choice(["en", "de", None]), draw.choice(["a", "B", "ä", None, "hot", "hot"]))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert found(df, cells=cells, top=15) == plain(rows, top=15)


def test_edge_rows(spark):
    rows = [(None, None, None), ("", "en", "a"), ("123 456", "en", "b"), (None, "en", None)]
    rows += [("same same term", "fr", "one")] * 3 + [("same other", "fr", None), ("x" * 200_000, "fr", "two")]
    rows += [("long" * 20_000, "es", "s")] * 3
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "text string, lang string, source string, value int, term string")
    assert found(df) == plain(rows)
    assert found(df.limit(0)) == []
