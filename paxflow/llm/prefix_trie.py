"""The prefix trie of conversations, by union-find over sorted neighbours.

A conversation becomes the digests of all its prefixes (a prefix's digest is that of the prefix before
it and its last turn), so conversations that share their first turns share their first digests.
Sorted across the cluster by these, each subtree is a run of rows. In each partition the common
depths of neighbours are edges; taken in descending depth, each edge unites the components on its
sides, and the union is a branching node. Between a node and its child lie the nodes of a chain.

A node that is no prefix of the partition's first or last conversation is whole and leaves as a row.
The others form two spines: the partition's contracted forest. Forests of neighbouring partitions
are merged ``FAN`` at a time by the same union-find over their spines' ends, the nodes that are
closed by that leave, and so on until one forest is left. So a task holds the sequences of one
partition of about ``ROWS`` conversations, or the spines of ``FAN`` forests; copies, a common first
turn or a hot root are spread over all partitions that their rows lie in.

The conversations that end at a node are a run of identifiers in order. Where the run crosses
partitions its pieces, strings of bounded size, go through one digest in order, held as a stream.

Defined results: a null role or text is empty; turns are ordered by (turn, role, text) with null turns
first, so repeated rows are turns of their own; rows with a null conversation identifier are no
conversation; an empty table gives no nodes. Texts of any
length count by their digest: turns are equal if 128 bits of SHA-256 over role and text are. Other
columns are not read. A conversation's digests, 16 bytes a turn and prefix, are held as one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxflow.llm.common import WORD, parts, whole_text
from paxflow.plans.stage import staged

#: Conversations of a partition, forests that are merged at a time, characters of a piece of ends.
ROWS, FAN, PIECE = 50_000, 64, 1 << 16
#: Lanes over which the children of a node that spans partitions are spread to find their parent.
LANES = 32
DIGEST = 16
EMPTY = hashlib.sha256(b"").hexdigest()

NODES = (
    "node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
SPINE = "struct<depth: long, n: long, least: long, children: long, leaves: long, saved: long, ends: string>"
#: The forest of one run of partitions: its number, the digests and words of its first and last
#: sequence, and what its spine nodes hold beside their spine child.
FOREST = (
    "run long, first binary, first_words array<long>, last binary, last_words array<long>, "
    f"left array<{SPINE}>, right array<{SPINE}>"
)
PIECES = "part long, number long, ids string"
_SPINE = pa.struct(
    [(k, pa.int64()) for k in ("depth", "n", "least", "children", "leaves", "saved")] + [("ends", pa.string())]
)
_COLUMNS = [
    *[(k, pa.binary()) for k in ("node", "parent")],
    *[(k, pa.int64()) for k in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
    ("ends_sha256", pa.string()),
    ("run", pa.int64()),
    ("first", pa.binary()),
    ("first_words", pa.list_(pa.int64())),
    ("last", pa.binary()),
    ("last_words", pa.list_(pa.int64())),
    ("left", pa.list_(_SPINE)),
    ("right", pa.list_(_SPINE)),
    ("part", pa.int64()),
    ("number", pa.int64()),
    ("ids", pa.string()),
]
SCHEMA = pa.schema(_COLUMNS)
NODE_COLUMNS = [k for k, _ in _COLUMNS[:10]]
FOREST_COLUMNS = [k for k, _ in _COLUMNS[10:17]]
#: Rows that are batched on their way out of a task.
BATCH = 5_000


class Own:
    """What a node holds without its open child: members, least member, children, leaves and saved
    tokens below, and the digest of its ends, if known (``""``: not yet, in pieces)."""

    __slots__ = ("n", "least", "children", "leaves", "saved", "ends", "below")

    def __init__(self, n=0, least=None, children=0, leaves=0, saved=0, ends=None):
        self.n, self.least, self.children = n, least, children
        self.leaves, self.saved, self.ends = leaves, saved, ends
        self.below: list[int] = []  # rows that wait for this node's least member

    def add(self, other: Own) -> None:
        self.n += other.n
        if other.least is not None and (self.least is None or other.least < self.least):
            self.least = other.least
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        if self.ends is None or other.ends == "":
            self.ends = other.ends if other.ends is not None else self.ends
        self.below += other.below


class Sequence:
    """One key of a sorted list: prefix digests, words of each turn, and what it holds by depth."""

    __slots__ = ("key", "words", "own")

    def __init__(self, key: bytes, words, own: dict[int, Own]):
        self.key, self.words, self.own = key, words, own

    def __len__(self) -> int:
        return len(self.key) // DIGEST

    def node(self, depth: int) -> bytes:
        return self.key[(depth - 1) * DIGEST : depth * DIGEST] if depth else b""


def common_depth(a: Sequence, b: Sequence) -> int:
    """Turns that two sequences share: equal digests are equal prefixes, so a search by halves."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a.node(mid) == b.node(mid):
            low = mid
        else:
            high = mid - 1
    return low


def united(sequences: list[Sequence], close: bool = False):
    """Rows of the closed nodes, and the own figures of the left and right spine by depth.

    Components are runs of sequences; ``top`` is the depth a component has been raised to and ``state``
    the figures of its node there. With ``close`` nothing stays open.
    """
    n = len(sequences)
    depths = [common_depth(a, b) for a, b in zip(sequences, sequences[1:])]
    order = sorted(range(n - 1), key=depths.__getitem__, reverse=True)
    parent, high = list(range(n)), list(range(n))
    top = [len(s) for s in sequences]
    rest = [s.own for s in sequences]  # what is held further up, by depth
    state = [own.pop(depth, None) or Own() for own, depth in zip(rest, top)]
    rows: list[list] = []
    left: list[tuple[int, Own]] = []
    right: list[tuple[int, Own]] = []

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def finish(low: int, depth: int, own: Own) -> tuple[int, int]:
        """A closed node's row; its leaves and saved tokens."""
        s = sequences[low]
        leaves = own.leaves if own.children else 1
        saved = own.saved + ((own.n - 1) * int(s.words[depth - 1]) if depth else 0)
        for row in own.below:
            rows[row][4] = own.least
        ends = EMPTY if own.ends is None else own.ends or None
        above = s.node(depth - 1) if depth else None
        rows.append([s.node(depth), above, own.least, depth, None, own.n, own.children, leaves, saved, ends])
        return leaves, saved

    def lift(low: int, to: int) -> None:
        """Raise the component that begins at ``low`` through its chain up to depth ``to``."""
        while top[low] > to:
            depth, own = top[low], state[low]
            ends_left, ends_right = low == 0, high[low] == n - 1
            fresh = Own()
            if not close and (ends_left or ends_right):
                (left if ends_left else right).append((depth, own))
            else:
                leaves, saved = finish(low, depth, own)
                fresh = Own(own.n, own.least, 1, leaves, saved)
                fresh.below.append(len(rows) - 1)
            held = rest[low].pop(depth - 1, None)
            if held is not None:
                fresh.add(held)
            top[low], state[low] = depth - 1, fresh

    for edge in order:
        a, b = find(edge), edge + 1
        lift(a, depths[edge])
        lift(b, depths[edge])
        state[a].add(state[b])
        few, many = sorted((rest[a], rest[b]), key=len)
        for depth, own in few.items():
            if depth in many:
                many[depth].add(own)
            else:
                many[depth] = own
        rest[a] = many
        parent[b] = a
        high[a] = high[b]
    lift(0, 0)
    if close:
        finish(0, 0, state[0])
    else:
        left.append((0, state[0]))
    return rows, left, right


def _batches(rows: list[list]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), BATCH):
        columns = list(zip(*rows[at : at + BATCH]))
        arrays = [pa.array(c, field.type) for c, field in zip(columns, SCHEMA)]
        yield pa.RecordBatch.from_arrays(arrays, schema=SCHEMA)


def _node_rows(rows: list[list]) -> list[list]:
    return [[*row, *[None] * (len(SCHEMA) - len(row))] for row in rows]


def _forest_row(run: int, sequences: list[Sequence], left, right) -> list:
    spines = [
        [
            {"depth": d, "n": o.n, "least": o.least, "children": o.children, "leaves": o.leaves, "saved": o.saved, "ends": o.ends}
            for d, o in spine
        ]
        for spine in (left, right)
    ]
    first, last = sequences[0], sequences[-1]
    return [*[None] * 10, run, first.key, first.words, last.key, last.words, *spines, None, None, None]


def _sequences(forests: list[dict]) -> list[Sequence]:
    """The ends of forests that lie side by side, with what their spines hold."""
    out = []
    for forest in sorted(forests, key=lambda f: f["run"]):
        spines = [{x.pop("depth"): Own(**x) for x in forest[side]} for side in ("left", "right")]
        out.append(Sequence(forest["first"], forest["first_words"], spines[0]))
        if forest["last"] != forest["first"]:
            out.append(Sequence(forest["last"], forest["last_words"], spines[1]))
    return out


def _pieces(ids: list[int]) -> list[str]:
    """The identifiers as decimals with commas between them, in strings of bounded size."""
    step = PIECE // 20
    return [",".join(map(str, ids[i : i + step])) for i in range(0, len(ids), step)]


def _planted(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted partition: its closed nodes, its forest, and the ends that may go on elsewhere."""
    run = TaskContext.get().partitionId()
    sequences: list[Sequence] = []
    ids: list[int] = []
    pieces: list[list] = []

    def end(last: bool) -> None:
        if not sequences:
            return
        own = Own(len(ids), ids[0], ends="")
        if last or len(sequences) == 1:
            node = sequences[-1].node(len(sequences[-1]))
            made = enumerate(_pieces(ids))
            pieces.extend([node, *[None] * 16, run, i, text] for i, text in made)
        else:
            own.ends = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        sequences[-1].own[len(sequences[-1])] = own

    for block in blocks:
        for conv_id, key, words in zip(*(block.column(c).to_pylist() for c in ("conv_id", "key", "words"))):
            if not sequences or sequences[-1].key != key:
                end(last=False)
                sequences.append(Sequence(key, words, {}))
                ids = []
            ids.append(conv_id)
    if not sequences:
        return
    end(last=True)
    rows, left, right = united(sequences)
    yield from _batches(_node_rows(rows))
    yield from _batches([_forest_row(run, sequences, left, right), *pieces])


def _merged(close: bool, fan: int):
    def run(forests: pa.Table) -> pa.Table:
        rows = forests.to_pylist()
        sequences = _sequences(rows)
        nodes, left, right = united(sequences, close)
        out = _node_rows(nodes)
        if not close:
            out.append(_forest_row(rows[0]["run"] // fan, sequences, left, right))
        return pa.Table.from_batches(_batches(out), SCHEMA)

    return run


def _digested(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node over its pieces in order, which come in sorted; held as a stream."""
    names = ["node", "ends_sha256"]
    at, digest, first = None, None, True
    for block in blocks:
        nodes, ends = [], []
        for node, text in zip(block.column("node").to_pylist(), block.column("ids").to_pylist()):
            if node != at:
                if at is not None:
                    nodes.append(at)
                    ends.append(digest.hexdigest())
                at, digest, first = node, hashlib.sha256(), True
            digest.update((text if first else "," + text).encode())
            first = False
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(ends, pa.string())], names=names)
    if at is not None:
        last = [pa.array([at], pa.binary()), pa.array([digest.hexdigest()])]
        yield pa.RecordBatch.from_arrays(last, names=names)


def _keyed(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digests of a sequence's prefixes, each from the one before and the turn's own."""
    for block in blocks:
        keys = []
        for turns in block.column("digests").to_pylist():
            last, key = b"", []
            for turn in turns:
                last = hashlib.blake2b(last + turn, digest_size=DIGEST).digest()
                key.append(last)
            keys.append(b"".join(key))
        columns = [block.column("conv_id"), pa.array(keys, pa.binary()), block.column("words")]
        yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "key", "words"])


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, as digests and numbers of words."""
    role, text = whole_text("role"), whole_text("text")
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    turn = F.struct(
        F.col("turn").isNotNull().alias("known"),
        F.col("turn").alias("turn"),
        F.unhex(F.substring(F.sha2(told, 256), 1, 2 * DIGEST)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    rows = conversations.filter(F.col("conv_id").isNotNull())
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def rebuilt(convs: DataFrame, family: int, most: int) -> DataFrame:
    """Every conversation with its first ``h`` turns taken from the first of its family of
    ``family`` identifiers, ``h`` below ``most`` by the checksum of its own."""
    own: Column = F.col("conv_id")
    heads = convs.filter(own % family == 0).select(own.alias("base"), F.slice("turns", 1, most).alias("head"))
    told = convs.withColumn("base", own - own % family).join(heads, "base", "left")
    h = (F.crc32(own.cast("string").cast("binary")) % most).cast("int")
    none = F.expr("slice(turns, 1, 0)")
    head = F.slice(F.coalesce("head", none), F.lit(1), h)
    tail = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    return told.select("conv_id", F.concat(head, tail).alias("turns"))


def prefix_trie(convs: DataFrame, rows: int = ROWS, fan: int = FAN) -> DataFrame:
    """Per node of the trie of ``conv_id, turns`` (see ``sequences``): ``conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    spark = convs.sparkSession
    flat = convs.select(
        "conv_id", F.col("turns.digest").alias("digests"), F.col("turns.words").alias("words")
    )
    keyed = staged(flat.mapInArrow(_keyed, "conv_id long, key binary, words array<long>"), "trie-keys")
    number = max(parts(spark), -(-keyed.count() // rows))
    ordered = keyed.repartitionByRange(number, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    planted = staged(ordered.mapInArrow(_planted, f"{NODES}, {FOREST}, {PIECES}"), "trie-forests")
    forests, levels = planted.filter("run IS NOT NULL").select(*FOREST_COLUMNS), []
    count = forests.count()
    while True:
        close = count <= fan
        group = (F.col("run") * 0 if close else F.floor(F.col("run") / fan)).alias("group")
        merged = forests.groupBy(group).applyInArrow(_merged(close, fan), f"{NODES}, {FOREST}, {PIECES}")
        levels.append(staged(merged, "trie-merged"))
        if close:
            break
        forests = levels[-1].filter("run IS NOT NULL").select(*FOREST_COLUMNS)
        count = forests.count()
    inner = planted.filter("depth IS NOT NULL").select(*NODE_COLUMNS)
    outer = levels[0]
    for level in levels[1:]:
        outer = outer.unionByName(level)
    outer = outer.filter("depth IS NOT NULL").select(*NODE_COLUMNS)
    # Ends in pieces: nodes of the outer forest only, two a partition at most.
    pieces = planted.filter("ids IS NOT NULL").select("node", "part", "number", "ids")
    pieces = pieces.repartition("node").sortWithinPartitions("node", "part", "number")
    ends = pieces.select("node", "ids").mapInArrow(_digested, "node binary, ends_sha256 string")
    late = outer.filter("ends_sha256 IS NULL").drop("ends_sha256").join(ends, "node")
    outer = outer.filter("ends_sha256 IS NOT NULL").unionByName(late)
    # Parents in the outer forest, in lanes, since one of them may have most of all children.
    nodes = inner.unionByName(outer)
    waits = F.col("parent_conv_id").isNull() & (F.col("depth") > 0)
    lane = F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))).alias("lane")
    above = levels[0]
    for level in levels[1:]:
        above = above.unionByName(level)
    above = above.filter("depth IS NOT NULL").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("found"), lane
    )
    waiting = nodes.filter(waits).withColumn("lane", F.pmod(F.xxhash64("node"), F.lit(LANES)).cast("int"))
    waiting = waiting.join(above, ["parent", "lane"]).withColumn("parent_conv_id", F.col("found"))
    done = nodes.filter(~waits).select(*NODE_COLUMNS)
    return done.unionByName(waiting.select(*NODE_COLUMNS)).drop("node", "parent")
