"""The metric-space join against all pairs, and its parts on families of near copies."""

from __future__ import annotations

import random
import re

import pytest

from paxflow.llm import shingle_join
from paxflow.llm.queries import QUERIES
from paxflow.llm.shingle_join import shingle_components

SF_DIR = "/root/testdata/sf0.01"


def shingle_set(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """Components by an inverted index over all shingles: every pair that shares one is compared."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders, pairs = {}, set()
    for i, own in enumerate(sets):
        for s in own:
            for j in holders.setdefault(s, []):
                pairs.add((j, i))
            holders[s].append(i)
    for j, i in pairs:
        if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(
        ((doc, len(own), least.get(find(i))) for i, ((doc, _), own) in enumerate(zip(rows, sets))),
        key=repr,
    )


def check(spark, rows, path):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS node", "1 AS row")
    docs.repartition(5).write.parquet(path)
    found = shingle_components(spark.read.parquet(path)).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)


def family(rng, size, edits, length=120):
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    for _ in range(size):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            at = rng.randrange(len(own))
            own[at : at + rng.randrange(3)] = [f"w{rng.randrange(10**6)}"] * rng.randrange(3)
        yield " ".join(own)


@pytest.mark.parametrize("seed,rows_per_lane", [(1, 2048), (2, 16)])
def test_families_and_chains(spark, tmp_path, monkeypatch, seed, rows_per_lane):
    monkeypatch.setattr(shingle_join, "REGION_ROWS", rows_per_lane)
    rng = random.Random(seed)
    texts = [t for size, edits in ((150, 12), (40, 5), (9, 20), (3, 3)) for t in family(rng, size, edits)]
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{passage} " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(n)) for n in range(0, 60, 3)]
    chain = [f"c{i}" for i in range(200)]
    texts += [" ".join(chain[i : i + 100]) for i in range(0, 90, 4)]
    texts += [None, "", " \t\n", "a", "A", "a b c d", "A B c D", "a b c d e", "a b c d f", "x " * 900]
    texts += [texts[0]] * 80
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    check(spark, [*zip(ids, texts), (None, texts[3]), (None, None), (7, texts[5]), (7, texts[5])], str(tmp_path / "d"))


def test_empty_table(spark, tmp_path):
    check(spark, [], str(tmp_path / "d"))


def test_query_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op8_shingle_join"](spark, SF_DIR).collect()
    assert sorted(map(tuple, found), key=repr) == brute([tuple(r) for r in docs])
