"""Divergence of sources, over a vocabulary held in minimal acyclic transducers.

The terms of a language that enough of its documents hold are sorted across the cluster and cut into
slices; each slice becomes a minimal acyclic transducer (``Transducer``): an automaton that accepts
exactly its terms and adds up, along a term's path, the term's place in byte order. Then every text is
streamed again: its terms, added up per task, walk through their slice's transducer, and what
arrives is counted under its ordinal. Ordinals also break ties and are spelled back into terms.

With a group's count of a term c, its total N and V kept terms, p = 1 + floor(SCALE * (c + 1) / (N + V));
a term adds floor((p - q)^2 / q) to the divergence of p from q. All of it is in integers: p by long
division, so counts up to 2^53 are exact; p is at most SCALE + 1, so squares fit 64 bits.

Where things grow: slices are cut by all distinct terms that fall in their range, kept or not, and by the
number of groups of their language, so a slice's counts are at most ``CELLS`` numbers whatever the
corpus; a frequent term is added up per task and then per group before it reaches its slice. The
driver holds one row per slice (its first term) and one per group; the result has a row for every pair
of groups of a language. Counts of pairs leave a task as one square of sums per language.

Defined results: a null text, language or group is ''; repeated rows are documents of their own; a group
without terms still has its rows (of all V terms with p of a count of 0); without kept terms all
values of pairs are 0. Terms of any length are terms. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paxflow.llm.common import parts, whole_text
from paxflow.plans.stage import staged

SCALE = 1_000_000_000
#: Counts in a slice: terms times groups of the language; terms at least and at most.
CELLS, FEWEST, MOST = 1 << 17, 64, 1 << 14
#: Terms that a task counts before it hands them on.
COUNTED = 400_000

#: Bytes that end a term become blanks, capital ASCII letters small ones.
_LETTERS = [*range(65, 91), *range(97, 123), *range(128, 256)]
_TABLE = bytes((b + 32 if b < 91 else b) if b in _LETTERS else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and of what is not ASCII, capital ASCII letters made small."""
    return text.translate(_TABLE).split()


class Transducer:
    """A minimal acyclic transducer from terms to their places in byte order.

    Arcs lie in one sorted array of ``state * 256 + byte``; each has its target and what it adds: the
    terms that end in its state or go through smaller arcs. Built from sorted terms one by one: what
    the next term no longer shares with the last one is frozen, equal states being shared.
    """

    __slots__ = ("arcs", "targets", "adds", "final", "root", "size")

    def __init__(self, arcs, targets, adds, final, root, size):
        self.arcs, self.targets, self.adds = arcs, targets, adds
        self.final, self.root, self.size = final, root, size

    @classmethod
    def build(cls, sorted_terms: list[bytes]) -> Transducer:
        known: dict[tuple, int] = {}
        below: list[int] = []  # terms from each frozen state
        states: list[tuple] = []  # (final, (byte, target), ...)
        path: list[list] = [[False]]
        last = b""

        def freeze(state: list) -> int:
            key = tuple(state)
            found = known.get(key)
            if found is None:
                found = known[key] = len(states)
                states.append(key)
                below.append(int(key[0]) + sum([below[t] for _, t in key[1:]]))
            return found

        def shorten(depth: int) -> None:
            while len(path) > depth + 1:
                number = freeze(path.pop())
                path[-1].append((last[len(path) - 1], number))

        for term in sorted_terms:
            shared, most = 0, min(len(term), len(last))
            while shared < most and term[shared] == last[shared]:
                shared += 1
            shorten(shared)
            path += [[False] for _ in range(len(term) - shared)]
            path[-1][0] = True
            last = term
        shorten(0)
        root = freeze(path[0])
        arcs, targets, adds = [], [], []
        for number, (ends, *out) in enumerate(states):
            passed = int(ends)
            for byte, target in out:
                arcs.append(number * 256 + byte)
                targets.append(target)
                adds.append(passed)
                passed += below[target]
        final = np.array([s[0] for s in states], bool)
        return cls(
            np.array(arcs, np.int64), np.array(targets, np.int32), np.array(adds, np.int32), final, root, below[root]
        )

    def dump(self) -> bytes:
        head = np.array([len(self.arcs), len(self.final), self.root, self.size], np.int64)
        return b"".join(x.tobytes() for x in (head, self.arcs, self.targets, self.adds, self.final))

    @classmethod
    def load(cls, raw: bytes) -> Transducer:
        n, states, root, size = map(int, np.frombuffer(raw, np.int64, 4))
        arcs = np.frombuffer(raw, np.int64, n, 32)
        targets = np.frombuffer(raw, np.int32, n, 32 + 8 * n)
        adds = np.frombuffer(raw, np.int32, n, 32 + 12 * n)
        return cls(arcs, targets, adds, np.frombuffer(raw, bool, states, 32 + 16 * n), root, size)

    def places(self, found: list[bytes]) -> np.ndarray:
        """The ordinal of each term, -1 where it is not accepted; all terms walk side by side."""
        n = len(found)
        place = np.zeros(n, np.int64)
        lengths = np.fromiter(map(len, found), np.int64, n)
        starts = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(found), np.uint8)
        state = np.full(n, self.root, np.int64)
        live = np.arange(n)
        depth = 0
        while len(live):
            over = lengths[live] == depth
            if over.any():
                done = live[over]
                place[done[~self.final[state[done]]]] = -1
                live = live[~over]
                if not len(live):
                    break
            if not len(self.arcs):
                place[live] = -1
                break
            wanted = state[live] * 256 + flat[starts[live] + depth]
            at = np.minimum(np.searchsorted(self.arcs, wanted), len(self.arcs) - 1)
            hit = self.arcs[at] == wanted
            place[live[~hit]] = -1
            live, at = live[hit], at[hit]
            place[live] += self.adds[at]
            state[live] = self.targets[at]
            depth += 1
        return place

    def term(self, place: int) -> bytes:
        """The term of an ordinal."""
        out, state = bytearray(), self.root
        while not (self.final[state] and place == 0):
            first, end = np.searchsorted(self.arcs, (state * 256, state * 256 + 256))
            at = first + int(np.searchsorted(self.adds[first:end], place, side="right")) - 1
            place -= int(self.adds[at])
            out.append(int(self.arcs[at]) & 255)
            state = int(self.targets[at])
        return bytes(out)


def shares(counts: np.ndarray, totals, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / (total + kept)) by long division, three digits at a time."""
    divisor = np.asarray(totals, np.int64) + kept
    whole, rest = np.divmod(counts.astype(np.int64) + 1, divisor)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, divisor)
        whole = whole * 1000 + digit
    return whole + 1


def _seen(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of a language each term stands, added up per task."""
    seen: dict[str, Counter] = {}

    def flush() -> pa.RecordBatch:
        langs = [lang for lang, own in seen.items() for _ in range(len(own))]
        found = [t for own in seen.values() for t in own]
        docs = [n for own in seen.values() for n in own.values()]
        seen.clear()
        columns = [pa.array(langs, pa.string()), pa.array(found, pa.binary()), pa.array(docs, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "term", "docs"])

    for block in blocks:
        for lang, raw in zip(block.column("lang").to_pylist(), block.column("raw")):
            own = seen.setdefault(lang, Counter())
            own.update(set(terms(raw.as_py())))
            if len(own) > COUNTED:
                yield flush()
    yield flush()


def _built(least: int, limits: dict[str, int]):
    """Sorted (lang, term, docs) to slices: language, first term, number of kept terms, transducer."""

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, first, passed, kept = None, None, 0, []

        def close() -> pa.RecordBatch:
            made = Transducer.build(kept)
            columns = [[lang], [first], [len(kept)], [made.dump()]]
            types = [pa.string(), pa.binary(), pa.int64(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            return pa.RecordBatch.from_arrays(arrays, names=["lang", "first", "kept", "code"])

        for block in blocks:
            for own, term, docs in zip(*(block.column(c).to_pylist() for c in ("lang", "term", "docs"))):
                if own != lang or passed >= limits[own]:
                    if lang is not None:
                        yield close()
                    lang, first, passed, kept = own, term, 0, []
                passed += 1
                if docs >= least:
                    kept.append(term)
        if lang is not None:
            yield close()

    return run


def _counted(shared):
    """Occurrences of each term per group, added up per task, with the slice each term lies in."""

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts: dict[str, tuple[list[bytes], list[int]]] = shared.value
        groups: dict[tuple[str, str], Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), own in groups.items():
                starts, numbers = firsts.get(lang, ([], []))
                if not starts:
                    continue
                found = list(own)
                at = [numbers[max(0, bisect_right(starts, t) - 1)] for t in found]
                n = len(found)
                columns = [
                    pa.array(at, pa.int64()),
                    pa.array([source] * n, pa.string()),
                    pa.array(found, pa.binary()),
                    pa.array(list(own.values()), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["slice", "source", "term", "n"])
            groups.clear()

        size = 0
        for block in blocks:
            columns = (block.column(c).to_pylist() for c in ("lang", "source"))
            for lang, source, raw in zip(*columns, block.column("raw")):
                own = groups.setdefault((lang, source), Counter())
                before = len(own)
                own.update(terms(raw.as_py()))
                size += len(own) - before
                if size > COUNTED:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


COUNTS = "slice long, lang string, kept long, start long, code binary, source string, at binary, n binary, total long"


def _recounted(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by slice, its transducer first: the counts of each group by ordinal."""
    head, machine = None, None
    counts: dict[str, np.ndarray] = {}

    def close() -> Iterator[pa.RecordBatch]:
        if head is None:
            return
        sources = sorted(counts) or [None]
        at = [np.flatnonzero(counts[s]) if s is not None else np.zeros(0, np.int64) for s in sources]
        n = [counts[s][a] if s is not None else a for s, a in zip(sources, at)]
        columns = [
            *([x] * len(sources) for x in head),
            sources,
            [a.astype(np.int32).tobytes() for a in at],
            [x.astype(np.int64).tobytes() for x in n],
            [int(x.sum()) for x in n],
        ]
        # The transducer goes with the first row of its slice only.
        columns[4] = [head[4]] + [None] * (len(sources) - 1)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.binary(), pa.binary(), pa.int64())
        names = [c.split()[0] for c in COUNTS.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    for block in blocks:
        slices = block.column("slice").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(slices)) + 1), len(slices)] if len(slices) else [0]
        for low, high in zip(edges, edges[1:]):
            part = block.slice(low, high - low)
            code = part.column("code")[0].as_py()
            if code is not None:
                yield from close()
                head = [part.column(c)[0].as_py() for c in ("slice", "lang", "kept", "start", "code")]
                machine, counts = Transducer.load(code), {}
                part = part.slice(1)
                if not part.num_rows:
                    continue
            place = machine.places(part.column("term").to_pylist())
            n = part.column("n").to_numpy()
            source = part.column("source").dictionary_encode()
            index = source.indices.to_numpy()
            for i, name in enumerate(source.dictionary.to_pylist()):
                own = (index == i) & (place >= 0)
                if own.any():
                    sums = counts.setdefault(name, np.zeros(machine.size, np.int64))
                    np.add.at(sums, place[own], n[own])
    yield from close()


SCORES = "lang string, source string, part string, item binary, value long, place long"
_SCORES = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.binary()), ("value", pa.int64()), ("place", pa.int64())]
)


def _scored(shared, top: int):
    """Slices to sums of pairs per task and language, and each group's highest terms per slice."""

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, kept = shared.value  # language: ([sources], totals); language: number of kept terms
        sums: dict[str, np.ndarray] = {}
        for block in blocks:
            rows = block.to_pylist()
            for row in rows:
                lang, size, rest = row["lang"], row["kept"], row["rows"]
                if not size:
                    continue
                sources, totals = groups[lang]
                number = {s: i for i, s in enumerate(sources)}
                counts = np.zeros((len(sources), size), np.int64)
                for own in rest:
                    if own["source"] is not None:
                        at = np.frombuffer(own["at"], np.int32)
                        counts[number[own["source"]], at] = np.frombuffer(own["n"], np.int64)
                p = shares(counts, totals[:, None], kept[lang])
                pairs = sums.setdefault(lang, np.zeros((len(sources), len(sources)), np.int64))
                for g in range(len(sources)):
                    gap = p[g] - p
                    pairs[g] += (gap * gap // p).sum(axis=1)
                q = shares(counts.sum(axis=0), totals.sum(), kept[lang])
                machine = Transducer.load(next(own["code"] for own in rest if own["code"] is not None))
                spelt: dict[int, bytes] = {}
                found = []
                for g, source in enumerate(sources):
                    at = np.flatnonzero((counts[g] > 0) & (p[g] > q))
                    gap = p[g][at] - q[at]
                    value = gap * gap // q[at]
                    best = np.lexsort((at, -value))[:top]
                    for i in best:
                        place = int(at[i])
                        if place not in spelt:
                            spelt[place] = machine.term(place)
                        found.append((lang, source, "term", spelt[place], int(value[i]), row["start"] + place))
                if found:
                    arrays = [pa.array(c, f.type) for c, f in zip(zip(*found), _SCORES)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=_SCORES)
        for lang, pairs in sums.items():
            sources = groups[lang][0]
            for g, source in enumerate(sources):
                others = [o for o in range(len(sources)) if o != g]
                if others:
                    n = len(others)
                    columns = [[lang] * n, [source] * n, ["pair"] * n, [sources[o].encode() for o in others], pairs[g][others], [0] * n]
                    arrays = [pa.array(c, f.type) for c, f in zip(columns, _SCORES)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=_SCORES)

    return run


def divergence(
    docs: DataFrame,
    least: int = 3,
    top: int = 200,
    cells: int = CELLS,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
) -> DataFrame:
    """Per group of language and source: ``lang, source, part, item, value, rank``. Part ``pair`` has the
    divergence from every other source of the language, part ``term`` the ``top`` kept terms in which
    the group exceeds its language."""
    spark = docs.sparkSession
    rows = docs.select(
        whole_text(lang_column).alias("lang"),
        whole_text(source_column).alias("source"),
        whole_text(text_column).cast("binary").alias("raw"),
    )
    groups: dict[str, list[str]] = {}
    for r in rows.select("lang", "source").distinct().collect():  # a row per group
        groups.setdefault(r["lang"], []).append(r["source"])
    for own in groups.values():
        own.sort(key=str.encode)
    limits = {lang: min(MOST, max(FEWEST, cells // len(own))) for lang, own in groups.items()}

    # Pass one: terms and the documents they stand in, sorted, into transducers.
    seen = rows.select("lang", "raw").mapInArrow(_seen, "lang string, term binary, docs long")
    seen = seen.groupBy("lang", "term").agg(F.sum("docs").alias("docs"))
    seen = seen.repartitionByRange(parts(spark), "lang", "term").sortWithinPartitions("lang", "term")
    built = staged(
        seen.mapInArrow(_built(least, limits), "lang string, first binary, kept long, code binary"), "divergence-slices"
    )
    slices = sorted(  # a row per slice
        (r["lang"].encode(), bytes(r["first"]), r["kept"]) for r in built.select("lang", "first", "kept").collect()
    )
    kept: dict[str, int] = dict.fromkeys(groups, 0)
    firsts: dict[str, tuple[list[bytes], list[int]]] = {}
    numbered = []
    for number, (raw, first, n) in enumerate(slices):
        lang = raw.decode()
        numbered.append((number, lang, first, kept[lang]))
        starts, numbers = firsts.setdefault(lang, ([], []))
        starts.append(first)
        numbers.append(number)
        kept[lang] += n
    names = spark.createDataFrame(numbered, "slice long, lang string, first binary, start long")
    machines = built.join(names, ["lang", "first"])

    # Pass two: every text again, its terms through their slice's transducer.
    routes = spark.sparkContext.broadcast(firsts)
    counted = rows.mapInArrow(_counted(routes), "slice long, source string, term binary, n long")
    counted = counted.groupBy("slice", "source", "term").agg(F.sum("n").alias("n"))
    none = {c: F.lit(None) for c in ("lang", "kept", "start", "code", "source", "term", "n")}
    columns = ["slice", "lang", "kept", "start", "code", "source", "term", "n"]
    heads = machines.withColumns({c: none[c] for c in ("source", "term", "n")}).select(*columns)
    bodies = counted.withColumns({c: none[c] for c in ("lang", "kept", "start", "code")}).select(*columns)
    met = heads.unionByName(bodies).repartition(max(parts(spark), -(-len(slices) // 8)), "slice")
    met = met.sortWithinPartitions("slice", F.col("code").isNull())
    recounted = staged(met.mapInArrow(_recounted, COUNTS), "divergence-counts")

    totals = {lang: np.zeros(len(own), np.int64) for lang, own in groups.items()}
    sums = recounted.filter("source IS NOT NULL").groupBy("lang", "source").agg(F.sum("total").alias("n"))
    for r in sums.collect():  # a row per group
        totals[r["lang"]][groups[r["lang"]].index(r["source"])] = r["n"]

    # Slices again, with all totals known.
    shared = spark.sparkContext.broadcast(({lang: (own, totals[lang]) for lang, own in groups.items()}, kept))
    whole = recounted.groupBy("slice", "lang", "kept", "start").agg(
        F.collect_list(F.struct("source", "at", "n", "code")).alias("rows")
    )
    scored = staged(whole.mapInArrow(_scored(shared, top), SCORES), "divergence-scores")
    highest = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "place")
    best = scored.filter("part = 'term'").withColumn("rank", F.row_number().over(highest))
    best = best.filter(F.col("rank") <= top)
    pairs = scored.filter("part = 'pair'").groupBy("lang", "source", "part", "item")
    pairs = pairs.agg(F.sum("value").alias("value"))
    every = [(lang, s, o.encode()) for lang, own in groups.items() for s in own for o in own if s != o and not kept[lang]]
    if every:  # languages without kept terms
        zero = spark.createDataFrame(every, "lang string, source string, item binary")
        pairs = pairs.unionByName(zero.selectExpr("lang", "source", "'pair' AS part", "item", "0L AS value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(ranked))
    out = ["lang", "source", "part", F.col("item").cast("string").alias("item"), "value", "rank"]
    return pairs.select(*out).unionByName(best.select(*out))
