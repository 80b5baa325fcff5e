"""The trie against a plain one, with forests of a few rows, merged a few at a time."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from paxflow.llm.prefix_trie import _pieces, prefix_trie, rebuilt, sequences

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, family=20, most=4):
    """Nodes as a dictionary from prefixes to members."""
    told: dict[int, list] = {}
    order = lambda r: (r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).digest())
    for row in sorted((r for r in rows if r[0] is not None), key=order):
        told.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    whole = {}
    for c, turns in told.items():
        h = zlib.crc32(str(c).encode()) % most
        whole[c] = told.get(c - c % family, [])[:h] + turns[h:]
    members: dict[tuple, list[int]] = {}
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members.setdefault(tuple(whole[c][:d]), []).append(c)
    figures = {k: [0, 0, (len(m) - 1) * len(k[-1][1].split()) if k else 0] for k, m in members.items()}
    for k in sorted(members, key=len, reverse=True):
        own = figures[k]
        own[1] = own[1] or 1
        if k:
            above = figures[k[:-1]]
            above[0] += 1
            above[1] += own[1]
            above[2] += own[2]
    return sorted(
        (
            m[0],
            len(k),
            members[k[:-1]][0] if k else -1,
            len(m),
            *figures[k],
            hashlib.sha256(",".join(str(c) for c in m if len(whole[c]) == len(k)).encode()).hexdigest(),
        )
        for k, m in members.items()
    )


def found(df, **how):
    rows = prefix_trie(rebuilt(sequences(df), 20, 4), **how).select(COLUMNS).collect()
    return sorted(tuple(-1 if x is None else x for x in r) for r in rows)


def data(n, turns, seed, copies=0):
    draw = random.Random(seed)
    texts = ["", "a", "b c", "d  e\tf", "long " * 30]
    rows = []
    for c in range(n):
        for t in range(draw.randint(1, turns)):
            rows.append((c * 7 % 61 + 61 * (c // 61), t, draw.choice(["user", "", None]), draw.choice(texts)))
    same = [(0, "user", "b c"), (1, None, "a"), (2, "user", "copy")]
    return rows + [(10_000 + 20 * i, *turn) for i in range(copies) for turn in same]


@pytest.mark.parametrize("rows, fan", [(1, 2), (3, 2), (10, 3), (50_000, 64)])
def test_equals_a_plain_trie(spark, rows, fan):
    table = data(90, 5, seed=rows, copies=40)
    df = spark.createDataFrame(table, SCHEMA).repartition(3)
    assert found(df, rows=rows, fan=fan) == plain(table)


def test_long_conversations_and_prefixes(spark):
    long = [(100, t, "user", f"turn {t}") for t in range(3_000)]
    short = [(c, t, "user", f"turn {t}") for c in (200, 220, 240) for t in range(c // 2)]
    assert found(spark.createDataFrame(long + short, SCHEMA), rows=1, fan=2) == plain(long + short)


def test_edge_rows(spark):
    rows = [
        (1, None, None, None),
        (1, 0, "user", "x"),
        (1, 0, "user", "x"),
        (21, 3, "user", None),
        (None, 0, "user", "nobody"),
        (None, None, None, None),
        (-7, 0, "user", "y" * 100_000),
        (5, 2, "a", "b"),
        (5, 1, "ab", ""),
    ]
    rows += [(c, 0, "user", "only one") for c in range(41, 60)]  # some are rebuilt without a turn
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA + ", node string, depth int")
    expected = plain([r for r in rows if r[0] != -7])
    assert found(df.filter("conv_id IS NULL OR conv_id <> -7"), rows=2, fan=2) == expected
    negative = found(df, rows=2, fan=2)
    assert len(negative) == len(expected) + 1 - (zlib.crc32(b"-7") % 4 > 0)
    assert found(df.limit(0)) == []


def test_pieces_join_to_the_whole():
    ids = list(range(50_000))
    assert ",".join(_pieces(ids)) == ",".join(map(str, ids)) and len(_pieces(ids)) > 1
