"""Token ids in directly addressable codes, in ascending order of identifiers.

An id is split in bytes, lowest first. Level 0 holds the lowest byte of every id of a segment; a
bitmap tells which ids go on, and those have their next byte in level 1, in the same order, and so
on. The place of an id in the next level is the rank of its bit, which a directory of counts every
``RANK_BITS`` bits gives without looking at what lies before, so any token, or any document, is read
without decoding a block.

Documents are range-partitioned and sorted by identifier (rows with equal identifiers in the order
they came in, so that a repeated one is split too), encoded, and written as rows of a table, each
row a segment of about ``SEGMENT_TOKENS`` ids with its documents. Spark commits the files, so a lost
task leaves nothing behind. Start positions are prefix sums over segments.

Defined results: a null text is empty and has the end id only; null identifiers come first; repeated
rows are written each; an empty table gives no segments; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from paxflow.llm.chunks import batches_of
from paxflow.llm.common import parts, running_starts, whole_text
from paxflow.llm.tokens import encode_texts
from paxflow.plans.stage import staging_path

RANK_BITS = 512
SEGMENT_TOKENS = 1 << 20
#: Characters of texts that are encoded together.
BATCH_CHARACTERS = 1 << 21


def encode(ids: np.ndarray) -> bytes:
    """A segment: the number of ids and levels, then per level its size, bytes, bits and ranks."""
    rest, levels = ids.astype(np.uint32), []
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little").tobytes()
        bits += bytes(-len(bits) % (RANK_BITS // 8))
        ones = np.bitwise_count(np.frombuffer(bits, np.uint8)).reshape(-1, RANK_BITS // 8)
        ranks = np.concatenate([[0], np.cumsum(ones.sum(axis=1, dtype=np.uint32))])
        levels.append((len(rest), (rest & 0xFF).astype(np.uint8).tobytes(), bits, ranks))
        rest = rest[more] >> 8
        if not len(rest):
            break
    out = [np.array([len(ids), len(levels)], np.uint32).tobytes()]
    for n, low, bits, ranks in levels:
        out += [np.array([n], np.uint32).tobytes(), low, bits, ranks.astype(np.uint32).tobytes()]
    return b"".join(out)


class Segment:
    """Random access to the ids of an encoded segment."""

    def __init__(self, raw: bytes):
        self.n, count = map(int, np.frombuffer(raw, np.uint32, 2))
        self.levels, at = [], 8
        for _ in range(count):
            n = int(np.frombuffer(raw, np.uint32, 1, at)[0])
            words = -(-n // RANK_BITS)
            low = np.frombuffer(raw, np.uint8, n, at + 4)
            at += 4 + n
            bits = np.frombuffer(raw, np.uint8, words * RANK_BITS // 8, at)
            at += len(bits)
            ranks = np.frombuffer(raw, np.uint32, words + 1, at)
            at += 4 * (words + 1)
            self.levels.append((low, bits, ranks))

    @staticmethod
    def rank(bits: np.ndarray, ranks: np.ndarray, place: int) -> int:
        """Bits set before ``place``: the directory's count and those of one word at most."""
        word, inside = divmod(place, RANK_BITS)
        start = word * RANK_BITS // 8
        full = bits[start : start + inside // 8]
        found = int(ranks[word]) + int(np.bitwise_count(full).sum())
        if inside % 8:
            found += (int(bits[start + inside // 8]) & ((1 << inside % 8) - 1)).bit_count()
        return found

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids at places ``start`` to ``stop`` (exclusive)."""
        out = np.zeros(stop - start, np.uint32)
        where = np.arange(stop - start)
        for shift, (low, bits, ranks) in enumerate(self.levels):
            out[where] |= low[start:stop].astype(np.uint32) << np.uint32(8 * shift)
            byte = start // 8
            more = np.unpackbits(bits[byte : -(-stop // 8)], bitorder="little")
            more = more[start - 8 * byte :][: stop - start].astype(bool)
            where = where[more]
            if not len(where):
                break
            start, stop = self.rank(bits, ranks, start), self.rank(bits, ranks, stop)
        return out

    def __getitem__(self, place: int) -> int:
        return int(self.ids(place, place + 1)[0])


def _segments(path: str, end_id: int, id_type: pa.DataType):
    schema = pa.schema(
        [
            ("segment", pa.int64()),
            ("n", pa.int64()),
            ("doc_ids", pa.list_(id_type)),
            ("lengths", pa.list_(pa.int64())),
            ("codes", pa.binary()),
        ]
    )
    end = np.array([end_id], "<u4").tobytes()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        ids, raw, held = [], [], 0

        def block():
            codes = encode(np.frombuffer(b"".join(raw), "<u4"))
            row = [[number], [held], [ids], [[len(r) // 4 for r in raw]], [codes]]
            columns = [pa.array(v, f.type) for v, f in zip(row, schema)]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for own, texts in batches_of(rows, BATCH_CHARACTERS):
            for doc, body in zip(own, encode_texts(texts, path)):
                ids.append(doc)
                raw.append(body + end)
                held += len(raw[-1]) // 4
                if held >= SEGMENT_TOKENS:
                    yield block()
                    number += 1
                    ids, raw, held = [], [], 0
        if ids:
            yield block()

    return run


def write_token_files(
    docs: DataFrame,
    target: str,
    path: str,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Encode all texts and write the segments under ``target``."""
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        whole_text(text_column).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    id_type = rows.schema["doc_id"].dataType
    ordered = rows.repartitionByRange(parts(docs.sparkSession), "doc_id", "row")
    ordered = ordered.sortWithinPartitions("doc_id", "row").select("doc_id", "text")
    made = ordered.mapInArrow(_segments(path, end_id, to_arrow_type(id_type)), _schema(id_type))
    made.write.option("compression", "none").parquet(target)


def _schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("segment", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(id_type)),
            T.StructField("lengths", T.ArrayType(T.LongType())),
            T.StructField("codes", T.BinaryType()),
        ]
    )


def _checked(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks:
        for segment, doc_ids, lengths, codes in zip(*block.columns):
            own, sizes = Segment(codes.as_buffer().to_pybytes()), lengths.values.to_numpy()
            ends = np.cumsum(sizes)
            sums = [
                zlib.crc32(own.ids(a, b).astype("<u4").tobytes())
                for a, b in zip((ends - sizes).tolist(), ends.tolist())
            ]
            columns = [
                pa.array([segment.as_py()] * len(sums), pa.int64()),
                doc_ids.values,
                pa.array(ends - sizes, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(sums, pa.int64()),
            ]
            names = ["segment", "doc_id", "place", "n_tokens", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def read_documents(spark: SparkSession, target: str, id_type: T.DataType) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    files = spark.read.schema(_schema(id_type)).parquet(target)
    result = T.StructType(
        [
            T.StructField("segment", T.LongType()),
            T.StructField("doc_id", id_type),
            T.StructField("place", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )
    found = files.select("segment", "doc_ids", "lengths", "codes").mapInArrow(_checked, result)
    starts = running_starts(files.select("segment", "n"), "segment", "shiftright({}, 24)")
    return found.join(starts, "segment").select(
        "doc_id", (F.col("start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(
    docs: DataFrame, path: str, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Write the files to the shared folder and read every document back from them."""
    spark = docs.sparkSession
    target = staging_path(spark, "token-files")
    write_token_files(docs, target, path, end_id, id_column, text_column)
    return read_documents(spark, target, docs.schema[id_column].dataType)
