"""N-gram Jaccard join: documents whose word-shingle sets have a similarity of 0.75 or more, exactly.

The Jaccard distance is a metric, and the join works in that metric space:

1. *Sets.* A document is the set of hashes of its five-word shingles. Equal sets are one node.
2. *Pivots.* Linked documents share shingles among the rarest quarter or so of their sets (rarest by
   a fixed-size table of counts over the whole corpus; any order gives the same links). Per such
   shingle one document, the least of a random order, is the pivot of those that hold it. Taking
   ``SLACK`` more of a set than a link needs makes linked documents share that many shingles, so a
   document may leave the pivots it meets least often, as long as what both leave is less than that.
3. *Regions.* A document belongs to the region of each pivot it meets; those at a boundary are
   replicated to all their regions, so any two linked documents meet in some region. A region is
   then centred: what most members hold against the pivot is taken over by it. What stands in a
   region is a document's difference to that centre, ``D(x)``, whose size is its distance.
4. *Windows.* With ``F = 7 |D| - |set|`` two documents of a region are linked exactly when
   ``14 |D(x) & D(y)| >= F(x) + F(y)``. The triangle inequality settles most pairs by sizes: at or
   below zero they are linked whatever the differences hold (so is a document within the radius of
   the region's best placed member); and if the right side exceeds what the smaller difference can
   hold, they are not.
5. *Recursion.* What is left, documents outside that radius against those in their window, is
   joined in the same way one level down: differences take the place of sets, and two documents meet
   only at an element of the difference that both hold early enough to reach the bound. Those pairs
   are checked exactly. Large regions are spread over tasks by element.

Links give connected components by propagation of the smallest label with pointer jumping. Equal
sets met in one partition are one node from the start, so a group of copies costs one row per
partition. No step emits the pairs of a group, holds a group whole, or uses the driver but for two
tables of fixed size (counts, and a filter of the nodes that meet any other).

Defined results: a null text has no shingles, as has one without words: it is linked with nothing,
and its component is itself. Repeated rows are copies. A null identifier is never the smallest. An
empty table gives an empty result. Other columns are not read. The documents must be a stored table:
it is scanned three times, and row numbers must not change between.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paxflow.llm.chunks import pack, unpack
from paxflow.llm.common import fresh, parts, whole_text
from paxflow.plans.stage import staged

WORDS = 5
#: Part of its set that a document takes beyond the rarest quarter.
SLACK = 0.1
#: Counts in the fixed-size table of shingle frequencies, and the slices it is summed in.
TABLE_BITS = 22
SLICES = 64
LANES = 32
#: Members of a region that one task joins; larger regions are dealt by element.
REGION_ROWS = 2048

MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed random order of 64-bit numbers."""
    x = x.astype(np.uint64) + MIX[0]
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the shingles; of all words as one if they are fewer."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    width = min(WORDS, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        out = out * MIX[0] + hashes[k : len(hashes) - width + 1 + k]
    return np.unique(mixed(out))


def slack(n: int) -> int:
    """Rare shingles that two linked documents share at least, by the size of the smaller one."""
    return max(1, int(np.ceil(SLACK * n)))


def _fixed_hashes() -> None:
    if os.environ.get("PYTHONHASHSEED", "random") == "random":
        raise RuntimeError("workers need one PYTHONHASHSEED, which Spark sets by default")


def _sets(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
    _fixed_hashes()
    for block in rows:
        yield block.column(0).to_pylist(), [shingles(t.as_py()) for t in block.column(1)]


# Tables of fixed size, summed by slices.


def _slices(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    lane = TaskContext.get().partitionId() % LANES
    payload = [pack(own.tobytes()) for own in counts.reshape(SLICES, -1)]
    columns = [
        pa.array(range(SLICES), pa.int32()),
        pa.array([lane] * SLICES, pa.int32()),
        pa.array(payload, pa.binary()),
    ]
    yield pa.RecordBatch.from_arrays(columns, names=["slice", "lane", "counts"])


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(unpack(x.as_py())[0], np.int64) for x in table.column("counts"))
    return table.slice(0, 1).set_column(2, "counts", pa.array([pack(total.tobytes())], pa.binary()))


def fixed_table(rows: DataFrame, count, value) -> np.ndarray:
    """Sum what ``count`` makes of each partition: ``2 ** TABLE_BITS`` numbers, whatever the input.

    ``value`` makes a byte of each sum before it leaves the executors, as the driver holds all of them;
    that of zero is zero.
    """

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _slices(count(blocks))

    def valued(table: pa.Table) -> pa.Table:
        summed = _summed(table)
        sums = np.frombuffer(unpack(summed.column("counts")[0].as_py())[0], np.int64)
        return summed.set_column(2, "counts", pa.array([pack(value(sums).tobytes())], pa.binary()))

    schema = "slice int, lane int, counts binary"
    lanes = rows.mapInArrow(run, schema).groupBy("slice", "lane").applyInArrow(_summed, schema)
    whole = lanes.groupBy("slice").applyInArrow(valued, schema)
    out = np.zeros((SLICES, (1 << TABLE_BITS) // SLICES), np.uint8)
    for r in whole.collect():
        out[r["slice"]] = np.frombuffer(unpack(bytes(r["counts"]))[0], np.uint8)
    return out.ravel()


def _steps(counts: np.ndarray) -> np.ndarray:
    return np.minimum(255, 4 * np.log2(1 + counts)).astype(np.uint8)


def _some(counts: np.ndarray) -> np.ndarray:
    return (counts > 0).astype(np.uint8)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _frequencies(blocks: Iterator[pa.RecordBatch]) -> np.ndarray:
    counts, held, size = np.zeros(1 << TABLE_BITS, np.int64), [], 0
    for _, sets in _sets(blocks):
        held += sets
        size += sum(map(len, sets))
        if size > 1 << TABLE_BITS:
            counts += np.bincount(_bucket(np.concatenate(held)), minlength=len(counts))
            held, size = [], 0
    if held:
        counts += np.bincount(_bucket(np.concatenate(held)), minlength=len(counts))
    return counts


def _flags(blocks: Iterator[pa.RecordBatch]) -> np.ndarray:
    counts = np.zeros(1 << TABLE_BITS, np.int64)
    for block in blocks:
        counts[_bucket(mixed(block.column(0).to_numpy()))] = 1
    return counts


# Sets and their rarest shingles.


def _postings(classes, n_parts: int):
    """Per document a row; per part the rarest shingles of the partition's distinct sets."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = classes.value
        seen: dict[bytes, int] = {}
        keys, owners = [], []
        for ids, sets in _sets(rows):
            reps, digests = [], []
            for row, own in zip(ids, sets):
                if not len(own):
                    reps.append(None)
                    digests.append(None)
                    continue
                digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                rep = seen.setdefault(digest, row)
                reps.append(rep)
                digests.append(digest if rep == row else None)
                if rep == row:
                    ordered = rare[_bucket(own)].astype(np.uint64) << np.uint64(56)
                    ordered = np.sort(ordered | (own >> np.uint64(8)))
                    keys.append(ordered[: len(own) - -(-3 * len(own) // 4) + slack(len(own))])
                    owners.append(np.full(len(keys[-1]), row, np.int64))
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(reps, pa.int64()),
                    pa.array(list(map(len, sets)), pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([None] * n, pa.int32()),
                    pa.array([None] * n, pa.binary()),
                ],
                names=POSTING_NAMES,
            )
        if not keys:
            return
        joined, own = np.concatenate(keys), np.concatenate(owners)
        dealt = (mixed(joined) % np.uint64(n_parts)).astype(np.int64)
        order = np.lexsort((joined, dealt))
        ends = np.cumsum(np.bincount(dealt, minlength=n_parts))
        for part in range(n_parts):
            chosen = order[ends[part - 1] if part else 0 : ends[part]]
            if len(chosen):
                steps = np.diff(joined[chosen], prepend=np.uint64(0))
                steps = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()
                whose = np.ascontiguousarray(own[chosen].view(np.uint8).reshape(-1, 8).T).tobytes()
                values = [[None], [None], [None], [None], [part], [pack(steps, whose)]]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
                columns = [pa.array(v, k) for v, k in zip(values, kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=POSTING_NAMES)

    return run


POSTING_NAMES = ["row", "rep", "n", "digest", "part", "postings"]


def _column(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def _distinct(one: np.ndarray, two: np.ndarray) -> list[pa.Array]:
    """Distinct pairs and how often each stands there."""
    order = np.lexsort((two, one))
    one, two = one[order], two[order]
    new = np.ones(len(one), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    often = np.diff(np.append(np.flatnonzero(new), len(one)))
    return [pa.array(x, pa.int64()) for x in (one[new], two[new], often)]


def _stars(lanes: int):
    """Each document of a shingle's group with the group's pivot, packed by lane of documents."""

    def run(table: pa.Table) -> pa.Table:
        x, p, often = (a.to_numpy() for a in _met_pivots(table))
        lane = (mixed(x) % np.uint64(lanes)).astype(np.int64)
        order = np.argsort(lane, kind="stable")
        found, starts = np.unique(lane[order], return_index=True)
        payload = [
            pack(*(a[chosen].tobytes() for a in (x, p, often)))
            for chosen in np.split(order, starts[1:])[: len(found)]
        ]
        return pa.table([pa.array(found, pa.int64()), pa.array(payload, pa.binary())], ["lane", "pairs"])

    return run


def _counted(table: pa.Table) -> pa.Table:
    """Pairs of a lane from all parts, and how many shingles each shares."""
    blocks = [[np.frombuffer(b, np.int64) for b in unpack(r.as_py())] for r in table.column("pairs")]
    x, p, often = (np.concatenate(arrays) for arrays in zip(*blocks))
    order = np.lexsort((p, x))
    x, p, often = x[order], p[order], often[order]
    first = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (p[1:] != p[:-1])]))
    sums = np.add.reduceat(often, first)
    return pa.table([pa.array(a, pa.int64()) for a in (x[first], p[first], sums)], ["x", "p", "c"])


def _met_pivots(table: pa.Table) -> list[pa.Array]:
    keys, owners = [], []
    for payload in table.column("postings"):
        steps, whose = unpack(payload.as_py())
        keys.append(np.cumsum(_column(steps), dtype=np.uint64))
        owners.append(_column(whose).view(np.int64))
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.lexsort((mixed(owner), key))
    key, owner = key[order], owner[order]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    pivot = owner[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
    return _distinct(owner[owner != pivot], pivot[owner != pivot])


# Regions.


def _flagged(flags):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _fixed_hashes()
        wanted = flags.value
        for block in rows:
            ids = block.column(0).to_numpy()
            chosen = np.flatnonzero(wanted[_bucket(mixed(ids))]) if len(ids) else []
            texts = block.column(1)
            sets = [shingles(texts[int(i)].as_py()).tobytes() for i in chosen]
            columns = [pa.array(ids[chosen], pa.int64()), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "shingles"])

    return run


def _differences(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a document has and the pivot lacks, and the other way round; elements only where the
    region has other members."""
    for block in blocks:
        sizes, pivot_sizes, diffs, news, gones = [], [], [], [], []
        for own, other, many in zip(*(block.column(c) for c in ("own", "other", "many"))):
            x = np.frombuffer(own.as_py(), np.uint64)
            p = np.frombuffer(other.as_py(), np.uint64)
            new = np.setdiff1d(x, p, assume_unique=True)
            gone = np.setdiff1d(p, x, assume_unique=True)
            sizes.append(len(x))
            pivot_sizes.append(len(p))
            diffs.append(len(new) + len(gone))
            news.append(new.tobytes() if many.as_py() else None)
            gones.append(gone.tobytes() if many.as_py() else None)
        columns = [
            block.column("p"),
            block.column("x"),
            pa.array(sizes, pa.int64()),
            pa.array(pivot_sizes, pa.int64()),
            pa.array(diffs, pa.int64()),
            pa.array(news, pa.binary()),
            pa.array(gones, pa.binary()),
        ]
        names = ["p", "x", "size", "p_size", "diff", "new", "gone"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _spread(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Differences to the pivot by region and, for large regions, by lane of elements."""
    for block in blocks:
        out = []
        for r in block.to_pylist():
            lanes = np.uint64(-(-r["members"] // REGION_ROWS))
            both = [np.frombuffer(r[k], np.uint64) for k in ("new", "gone")]
            where = [(mixed(e) % lanes).astype(np.int64) for e in both]
            for lane in np.unique(np.concatenate(where)).tolist():
                own = [e[w == lane].tobytes() for e, w in zip(both, where)]
                out.append((r["p"], lane, r["members"], *own))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["p", "lane", "members", "new", "gone"])


def _majority(table: pa.Table) -> pa.Table:
    """Elements in which most members differ from the pivot."""
    most = table.column("members")[0].as_py() // 2
    out = {"p": table.column("p").slice(0, 1)}
    for name in ("new", "gone"):
        all_ = np.frombuffer(b"".join(x.as_py() for x in table.column(name)), np.uint64)
        elements, often = np.unique(all_, return_counts=True)
        out[f"most_{name}"] = pa.array([elements[often > most].tobytes()], pa.binary())
    return pa.table(out)


def _centred(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``D(x)``: differences to the centre, with the elements that it lacks first."""
    for block in blocks:
        diffs, deltas = [], []
        for row in zip(*(block.column(c) for c in ("new", "gone", "most_new", "most_gone"))):
            lists = [x.as_py() for x in row[2:]]
            most_new, most_gone = (np.frombuffer(b"".join(x or ()), np.uint64) for x in lists)
            new, gone = (np.frombuffer(x.as_py(), np.uint64) for x in row[:2])
            fresh_ = np.union1d(np.setdiff1d(new, most_new), np.setdiff1d(most_gone, gone))
            lost = np.union1d(np.setdiff1d(gone, most_gone), np.setdiff1d(most_new, new))
            diffs.append(len(fresh_) + len(lost))
            deltas.append(fresh_.tobytes() + lost.tobytes())
        columns = [*(block.column(c) for c in ("p", "x", "size", "near", "members"))]
        columns += [pa.array(diffs, pa.int64()), pa.array(deltas, pa.binary())]
        names = ["p", "x", "size", "near", "members", "diff", "delta"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _dealt(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The early elements of each difference, by region and, for large regions, by lane of elements."""
    names = ["p", "lane", "x", "f", "outer", "elements", "left"]
    for block in blocks:
        out = []
        for r in block.to_pylist():
            bound = r["best"] if r["outer"] else r["least_outer"]
            early = r["diff"] - max(1, -(-(r["f"] + bound) // 14)) + 1
            if early <= 0:
                continue
            elements = np.frombuffer(r["delta"], np.uint64, early)
            left = r["diff"] - np.arange(early)
            lanes = -(-r["members"] // REGION_ROWS)
            lane = (mixed(elements) % np.uint64(lanes)).astype(np.int64)
            for k in np.unique(lane).tolist():
                mine = lane == k
                out.append(
                    (r["p"], k, r["x"], r["f"], r["outer"], elements[mine].tobytes(), left[mine].tobytes())
                )
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
        columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _meetings(table: pa.Table) -> pa.Table:
    """Pairs that meet at an element early enough to share as many as a link needs."""
    elements = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("elements")]
    count = list(map(len, elements))
    x = np.repeat(table.column("x").to_numpy(), count)
    f = np.repeat(table.column("f").to_numpy(), count)
    outer = np.repeat(table.column("outer").to_numpy(zero_copy_only=False), count)
    left = np.concatenate([np.frombuffer(b.as_py(), np.int64) for b in table.column("left")])
    key, most = np.concatenate(elements), 14 * left - f
    while len(key):  # drop who can reach nobody at its element, until nobody is dropped
        order = np.lexsort((f, key))
        key, x, f, outer, most = key[order], x[order], f[order], outer[order], most[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.concatenate([first, [len(key)]]))
        least = np.repeat(f[first], size)
        second = np.where(size > 1, f[np.minimum(first + 1, len(f) - 1)], np.iinfo(np.int64).max)
        is_first = np.zeros(len(key), bool)
        is_first[first] = True
        other = np.where(is_first, np.repeat(second, size), least)
        reach = (other <= most) & (f <= np.repeat(np.maximum.reduceat(most, first), size))
        if reach.all():
            break
        key, x, f, outer, most = key[reach], x[reach], f[reach], outer[reach], most[reach]
    one, two = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(key):
        ends = np.concatenate([first[1:], [len(key)]])
        for a, b in zip(first.tolist(), ends.tolist()):
            fs, ms, own, out = f[a:b], most[a:b], x[a:b], outer[a:b]
            stop = np.searchsorted(fs, ms, "right")
            for i in range(b - a):
                j = np.flatnonzero((ms[: stop[i]] >= fs[i]) & (out[: stop[i]] | out[i]))
                j = j[own[j] < own[i]]
                one.append(own[j])
                two.append(np.full(len(j), own[i]))
    met = _distinct(np.concatenate(one), np.concatenate(two))[:2]
    pivot = pa.array([table.column("p")[0].as_py()] * len(met[0]), pa.int64())
    return pa.table([pivot, *met], ["p", "x", "y"])


def _shared(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks:
        ok = []
        for a, b, need in zip(*(block.column(c) for c in ("dx", "dy", "need"))):
            one, two = (np.frombuffer(d.as_py(), np.uint64) for d in (a, b))
            same = len(np.intersect1d(one, two, assume_unique=True))
            ok.append(14 * same >= need.as_py())
        chosen = pa.array(ok, pa.bool_())
        columns = [block.column("x").filter(chosen), block.column("y").filter(chosen)]
        yield pa.RecordBatch.from_arrays(columns, names=["u", "v"])


def _kept(stars: DataFrame) -> DataFrame:
    """Without the pivots a document meets least, so many that no linked pair loses all of its own.

    Linked documents share ``slack`` of the smaller one at least, which has three quarters of the
    larger one's size or more; each may leave less than half of that.
    """
    smaller = F.ceil(0.75 * F.col("n"))
    spare = F.floor((F.greatest(F.lit(1), F.floor(SLACK * smaller)) - 1) / 2)
    order = Window.partitionBy("x").orderBy("c", "p").rowsBetween(Window.unboundedPreceding, 0)
    left = F.sum("c").over(order)
    return stars.withColumn("left", left).filter(F.col("left") > spare).select("x", "p")


def region_links(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``u, v`` that connect what is linked, from the members of all regions."""
    many = stars.groupBy("p").agg((F.count("*") > 1).alias("many"))
    own = sets.select(F.col("node").alias("x"), F.col("shingles").alias("own"))
    other = sets.select(F.col("node").alias("p"), F.col("shingles").alias("other"))
    met = stars.join(many, "p").join(own.hint("merge"), "x").join(other.hint("merge"), "p")
    members = staged(
        met.select("p", "x", "own", "other", "many").mapInArrow(
            _differences,
            "p long, x long, size long, p_size long, diff long, new binary, gone binary",
        ),
        "region-members",
    ).withColumn("near", 7 * F.col("diff") <= F.col("size") + F.col("p_size"))
    to_pivot = members.filter("near").select(F.col("x").alias("u"), F.col("p").alias("v"))

    several = members.filter("new IS NOT NULL")
    sizes = several.groupBy("p").agg(F.count("*").alias("members"), F.min("near").alias("all_near"))
    # Where all are linked to the pivot there is nothing left to find.
    several = several.join(sizes.filter("NOT all_near"), "p")
    lanes = several.select("p", "members", "new", "gone").mapInArrow(
        _spread, "p long, lane long, members long, new binary, gone binary"
    )
    lanes = lanes.groupBy("p", "lane").applyInArrow(
        _majority, "p long, most_new binary, most_gone binary"
    )
    centres = lanes.groupBy("p").agg(
        F.collect_list("most_new").alias("most_new"), F.collect_list("most_gone").alias("most_gone")
    )
    several = staged(
        several.join(centres, "p", "left").mapInArrow(
            _centred,
            "p long, x long, size long, near boolean, members long, diff long, delta binary",
        ),
        "region-differences",
    ).withColumn("f", 7 * F.col("diff") - F.col("size"))
    regions = several.groupBy("p").agg(F.min(F.struct("f", "x", "near")).alias("best"))
    regions = regions.select(
        "p",
        F.col("best.f").alias("best"),
        F.col("best.x").alias("best_x"),
        F.col("best.near").alias("best_near"),
    )
    placed = several.join(regions, "p")
    sure = (F.col("f") + F.col("best") <= 0) & (F.col("x") != F.col("best_x"))
    to_best = placed.filter(sure).select(F.col("x").alias("u"), F.col("best_x").alias("v"))
    # The core is linked to the best placed member, directly or by way of the pivot.
    core = sure | (F.col("x") == F.col("best_x")) | (F.col("near") & F.col("best_near"))
    open_ = ~core
    least = placed.filter(open_).groupBy("p").agg(F.min("f").alias("least_outer"))
    window = placed.withColumn("outer", open_).join(least, "p")
    # The lower bound of the triangle inequality: the difference must hold what a link needs.
    window = window.filter(F.col("outer") | (F.col("f") + F.col("least_outer") <= 14 * F.col("diff")))
    # ``best`` may be a member's own: then no other is as well placed, and the bound is only safer.
    dealt = window.select(
        "p", "x", "f", "diff", "delta", "outer", "best", "least_outer", "members"
    ).mapInArrow(
        _dealt, "p long, lane long, x long, f long, outer boolean, elements binary, left binary"
    )
    meetings = dealt.groupBy("p", "lane").applyInArrow(_meetings, "p long, x long, y long").distinct()
    one = several.select("p", "x", F.col("f").alias("fx"), F.col("delta").alias("dx"))
    two = several.select("p", F.col("x").alias("y"), F.col("f").alias("fy"), F.col("delta").alias("dy"))
    checked = meetings.join(one.hint("merge"), ["p", "x"]).join(two.hint("merge"), ["p", "y"])
    checked = checked.select("x", "y", "dx", "dy", (F.col("fx") + F.col("fy")).alias("need"))
    inside = checked.mapInArrow(_shared, "u long, v long")
    return to_pivot.unionByName(to_best).unionByName(inside)


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that links reach, for every node that has a link."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    both = staged(both, "links")
    labels = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label"))
    labels = staged(labels.select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        seen = labels.select(F.col("node").alias("v"), F.col("label").alias("near"))
        near = both.join(seen, "v").groupBy(F.col("u").alias("node")).agg(F.min("near").alias("near"))
        step = labels.join(near, "node").select(
            "node", F.least("label", "near").alias("next"), F.col("label").alias("old")
        )
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        moved = step.join(jump, "next").select(
            "node", F.least("next", "far").alias("label"), "old"
        )
        labels = staged(moved, "labels")
        if labels.filter("label <> old").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")


def shingle_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id``."""
    found = _rows_with_components(docs, id_column, text_column)
    return found.select("doc_id", "n_shingles", "component_id")


def _rows_with_components(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Also ``row``, the row's number in the scan, and ``first_row``, that of one of its component."""
    spark = docs.sparkSession
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"),
        whole_text(text_column).cast("binary").alias("text"),
        F.col(id_column).alias("doc_id"),
    )
    texts = numbered.select("row", "text")
    classes = fixed_table(texts, _frequencies, _steps)
    n_parts = 2 * parts(spark)
    made = staged(
        texts.mapInArrow(
            _postings(spark.sparkContext.broadcast(classes), n_parts),
            "row long, rep long, n long, digest binary, part int, postings binary",
        ),
        "shingle-postings",
    )
    rows = made.filter("row IS NOT NULL")
    heads = rows.filter("digest IS NOT NULL").select("rep", "digest", "n")
    nodes = heads.groupBy("digest").agg(F.min("rep").alias("node"))
    nodes = staged(heads.join(nodes, "digest").select("rep", "node", "n"), "shingle-nodes")
    pairs = made.filter("part IS NOT NULL").select("part", "postings")
    packed = pairs.groupBy("part").applyInArrow(_stars(n_parts), "lane long, pairs binary")
    pairs = packed.groupBy("lane").applyInArrow(_counted, "x long, p long, c long")
    one = nodes.select(F.col("rep").alias("x"), F.col("node").alias("xn"), "n")
    two = nodes.select(F.col("rep").alias("p"), F.col("node").alias("pn"))
    stars = pairs.join(one, "x").join(two, "p").filter("xn <> pn")
    stars = stars.groupBy(F.col("xn").alias("x"), F.col("pn").alias("p"), "n")
    stars = staged(_kept(stars.agg(F.max("c").alias("c"))), "stars")
    ends = stars.select("x").unionByName(stars.select(F.col("p").alias("x")))
    flags = fixed_table(ends, _flags, _some).view(bool)
    sets = staged(
        texts.mapInArrow(
            _flagged(spark.sparkContext.broadcast(flags)), "node long, shingles binary"
        ),
        "shingle-sets",
    )
    labels = components(region_links(stars, sets))

    named = numbered.select("row", "doc_id").join(rows.select("row", "rep", "n"), "row")
    least = named.filter("rep IS NOT NULL").groupBy("rep").agg(F.min("doc_id").alias("least"))
    groups = nodes.drop("n").join(labels, "node", "left").join(least, "rep")
    groups = groups.select("rep", F.coalesce("label", "node").alias("label"), "least")
    whole = groups.groupBy("label").agg(F.min("least").alias("component_id"))
    groups = groups.join(whole, "label").select("rep", "component_id", F.col("label").alias("first_row"))
    # Rows without shingles have no group: a key of their own keeps them spread.
    spread = named.withColumn("key", F.coalesce("rep", -1 - F.col("row")))
    groups = groups.withColumnRenamed("rep", "key")
    return spread.join(groups, "key", "left").select(
        "row",
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("rep").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("first_row", "row").alias("first_row"),
    )


def one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents, all columns: of each component the one with the smallest identifier."""
    row = fresh(docs, "scan_row")
    found = _rows_with_components(docs, id_column, text_column).filter("doc_id <=> component_id")
    stay = found.groupBy("first_row").agg(F.min("row").alias(row)).select(row)
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    return numbered.join(stay, row, "left_semi").drop(row)
