"""A table of distinct chunks: every text is cut into chunks, each distinct chunk is worked on once
in the whole corpus, and its value is joined back to the texts that hold it.

1. Documents are cut in batches of about ``BATCH_BYTES``. A batch deals its distinct chunks to parts
   by hash and numbers them by (part, chunk); to each part goes one sorted, compressed request.
2. A part holds every request for its chunks. It works each distinct chunk out once and answers each
   batch in the order asked. However often a chunk occurs, a batch asks for it once, so hot chunks
   cost one short entry per batch.
3. The batches are cut again from the same scan, now as runs of chunk numbers, meet their answers and
   rebuild their documents. Cutting twice costs less disk than storing the runs; a batch whose
   chunks differ from those it asked for (a source that gives other rows when read again) is an
   error, never a wrong result.

Nothing is broadcast, and a task holds one batch or one part. The number of parts follows the
session's shuffle partitions. Texts are not shuffled, only their chunk numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from paxflow.llm.common import parts, whole_text

BATCH_BYTES = 24 << 20
PARTS_PER_PARTITION = 2


def pack(*blocks: bytes) -> bytes:
    """Several byte strings as one compressed one."""
    head = np.array([len(blocks), *map(len, blocks)], np.int64).tobytes()
    raw = head + b"".join(blocks)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(packed: bytes) -> list[bytes]:
    raw = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True)
    count = int(np.frombuffer(raw, np.int64, 1)[0])
    at, out = 8 * (count + 1), []
    for n in np.frombuffer(raw, np.int64, count, 8):
        out.append(raw[at : at + n])
        at += n
    return out


def pack_strings(strings: list[bytes]) -> tuple[bytes, bytes]:
    sizes = np.fromiter(map(len, strings), np.uint32, len(strings))
    return sizes.tobytes(), b"".join(strings)


def unpack_strings(sizes: bytes, joined: bytes) -> list[bytes]:
    ends = np.cumsum(np.frombuffer(sizes, np.uint32), dtype=np.int64).tolist()
    return [joined[a:b] for a, b in zip([0, *ends[:-1]], ends)] if ends else []


def planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers as their lowest bytes, then their next ones: compresses better."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def batches_of(
    rows: Iterator[pa.RecordBatch], most: int = BATCH_BYTES
) -> Iterator[tuple[list, list[str]]]:
    """Identifiers and texts of about ``most`` characters at a time; a longer text is a batch."""
    ids, texts, size = [], [], 0
    for block in rows:
        for doc, text in zip(block.column(0), block.column(1)):
            ids.append(doc.as_py())
            texts.append(text.as_py())
            size += len(texts[-1])
            if size >= most:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _batches(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list[str]]]:
    """Batches with a number made of the partition's and their place in it."""
    partition = 0

    def watched():
        nonlocal partition
        for block in rows:
            if block.num_rows:
                partition = block.column(2)[0].as_py()
            yield block

    for number, (ids, texts) in enumerate(batches_of(watched())):
        yield (partition << 24) + number, ids, texts


def _dealt(chunks: Iterator[str], n_parts: int) -> list[list[bytes]]:
    """Distinct chunks by part, sorted."""
    dealt: list[list[bytes]] = [[] for _ in range(n_parts)]
    for chunk in chunks:
        raw = chunk.encode()
        dealt[zlib.crc32(raw) % n_parts].append(raw)
    for own in dealt:
        own.sort()
    return dealt


def _mark(dealt: list[list[bytes]]) -> int:
    """A fingerprint of a batch's chunks."""
    mark = 0
    for own in dealt:
        mark = zlib.crc32(b"\0".join(own), mark)
    return mark


def _ask(split: Callable[[str], list[str]], n_parts: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, texts in _batches(rows):
            distinct: set[str] = set()
            for text in texts:
                distinct.update(split(text))
            dealt = _dealt(distinct, n_parts)
            mark = _mark(dealt)
            out = [(batch, part, mark, pack(*pack_strings(own))) for part, own in enumerate(dealt) if own]
            if out:
                columns = [pa.array(c, k) for c, k in zip(zip(*out), ASK_TYPES)]
                yield pa.RecordBatch.from_arrays(columns, names=ASK_NAMES)

    return run


def _runs(split: Callable[[str], list[str]], counted: bool, n_parts: int, id_type: pa.DataType):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, texts in _batches(rows):
            cut = [split(text) for text in texts]
            dealt = _dealt({chunk for chunks in cut for chunk in chunks}, n_parts)
            mark = _mark(dealt)
            place = {raw.decode(): i for i, raw in enumerate(r for own in dealt for r in own)}
            runs, times = [], []
            for chunks in cut:
                own = np.fromiter(map(place.__getitem__, chunks), np.uint32, len(chunks))
                if counted:
                    own, often = np.unique(own, return_counts=True)
                    times.append(often.astype(np.uint32))
                runs.append(own)
            joined = np.concatenate(runs)
            if counted:
                joined = np.diff(joined, prepend=np.uint32(0))
            payload = pack(
                planes(np.fromiter(map(len, runs), np.uint32, len(runs))),
                planes(joined),
                planes(np.concatenate(times)) if counted else b"",
                np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts)).tobytes(),
            )
            columns = [[batch], [-1], [mark], [payload]]
            columns = [pa.array(c, k) for c, k in zip(columns, ASK_TYPES)]
            columns.append(pa.array([ids], pa.list_(id_type)))
            yield pa.RecordBatch.from_arrays(columns, names=[*ASK_NAMES, "ids"])

    return run


def _answer(work: Callable[[list[str]], list[bytes]]):
    def run(table: pa.Table) -> pa.Table:
        asked = [unpack_strings(*unpack(x.as_py())) for x in table.column("payload")]
        seen: dict[bytes, int] = {}
        for words in asked:
            for word in words:
                if word not in seen:
                    seen[word] = len(seen)
        values = work([word.decode() for word in seen])
        payloads = [pack(*pack_strings([values[seen[w]] for w in words])) for words in asked]
        place = table.schema.get_field_index("payload")
        return table.set_column(place, "payload", pa.array(payloads, pa.binary()))

    return run


def _rebuild(finish, counted: bool):
    def run(table: pa.Table) -> pa.Table:
        if pa.compute.count_distinct(table.column("mark")).as_py() != 1:
            raise RuntimeError("the documents changed while they were read; store them first")
        docs, answers = None, []
        for part, payload, ids in zip(*(table.column(c) for c in ("part", "payload", "ids"))):
            if part.as_py() < 0:
                docs = (ids.values, unpack(payload.as_py()))
            else:
                answers.append((part.as_py(), payload))
        if docs is None:
            raise RuntimeError("the documents changed while they were read; store them first")
        values: list[bytes] = []
        for _, payload in sorted(answers, key=lambda x: x[0]):
            values += unpack_strings(*unpack(payload.as_py()))
        ids, (lengths, runs, times, n_bytes) = docs
        numbers = from_planes(runs)
        return finish(
            ids,
            from_planes(lengths).astype(np.int64),
            np.cumsum(numbers, dtype=np.uint32) if counted else numbers,
            from_planes(times),
            np.frombuffer(n_bytes, np.int64),
            values,
        )

    return run


ASK_NAMES = ["batch", "part", "mark", "payload"]
ASK_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]


def over_chunks(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    split: Callable[[str], list[str]],
    work: Callable[[list[str]], list[bytes]],
    finish,
    output: list[tuple[str, str]],
    counted: bool = False,
) -> DataFrame:
    """``finish(ids, lengths, runs, times, n_bytes, values)`` turns a batch into an Arrow table of
    the identifier (named ``doc_id``) and the ``output`` columns.

    ``runs`` holds the documents' chunk numbers one after another, ``lengths`` how many each has,
    ``values[number]`` the bytes that ``work`` made of a chunk. With ``counted`` a document holds
    each distinct chunk once and ``times`` tells how often.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        whole_text(text_column).alias("text"),
        F.spark_partition_id().alias("place"),
    )
    id_type = rows.schema["doc_id"].dataType
    n_parts = PARTS_PER_PARTITION * parts(docs.sparkSession)
    schema = T.StructType.fromDDL("batch long, part int, mark long, payload binary")
    asked = rows.mapInArrow(_ask(split, n_parts), schema)
    answers = asked.groupBy("part").applyInArrow(_answer(work), schema)
    own = T.StructType([*schema.fields, T.StructField("ids", T.ArrayType(id_type))])
    cut = rows.mapInArrow(_runs(split, counted, n_parts, to_arrow_type(id_type)), own)
    made = T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in output))
    result = T.StructType([T.StructField("doc_id", id_type), *made.fields])
    return (
        cut.unionByName(answers, allowMissingColumns=True)
        .groupBy("batch")
        .applyInArrow(_rebuild(finish, counted), result)
    )
