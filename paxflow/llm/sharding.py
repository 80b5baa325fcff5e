"""Two-pass external shuffle into shards, in DataFrame operations only.

Pass one scatters the records uniformly into buckets that fit in memory, by a seeded hash of the
identifier. Pass two shuffles each bucket (Fisher-Yates with seeded draws) and writes it. The buckets
in order are one global random permutation of the table; shard ``s`` is its ``s``-th even slice, so
row counts of shards differ by one at most (law ``rows``) and slots have no gaps. The order is a
function of seed, identifiers and sizes alone: a lost task writes the same rows again.

The number of buckets follows from the table's bytes and rows, so a bucket's size does not grow with
the data. Neighbouring buckets travel in groups, so a task writes long runs of a few shards. Offsets
are prefix sums over buckets in two levels. Identifiers that repeat in more than a thousandth of all
rows (a thousand at most, so the list is bounded) are scattered by row as well.

Defined results: a null text has no bytes; a null identifier hashes as the empty string; repeated
rows each get a slot; an empty table gives no shards' rows; all columns are kept inside ``record``,
so no name can clash (their types must be orderable).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paxflow.llm.common import fresh, running_starts, whole_text
from paxflow.plans.stage import staged, staging_path

BUCKET_BYTES = 16 << 20
BUCKET_ROWS = 512
GROUP_BYTES = 8 << 20
ROW_OVERHEAD = 16
BROADCAST_ROWS = 200_000


def seeded(*keys: Column) -> Column:
    """60 random bits from the keys."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *keys)), 1, 15), 16, 10).cast("long")


def permutation(n: Column, seed: int, bucket: Column) -> Column:
    """Fisher-Yates: the numbers 1 to ``n`` in an order drawn for the bucket."""

    def swap(a: Column, i: Column) -> Column:
        j = 1 + F.pmod(seeded(F.lit(str(seed)), bucket.cast("string"), i.cast("string")), i)
        j = j.cast("int")
        return F.element_at(
            F.transform(
                F.array(j),
                lambda j: F.when(j == i, a).otherwise(
                    F.concat(
                        F.slice(a, F.lit(1), j - 1),
                        F.slice(a, i, F.lit(1)),
                        F.slice(a, j + 1, i - j - 1),
                        F.slice(a, j, F.lit(1)),
                        F.slice(a, i + 1, n),
                    )
                ),
            ),
            1,
        )

    steps = F.when(n > 1, F.sequence(n, F.lit(2), F.lit(-1))).otherwise(
        F.array().cast("array<int>")
    )
    return F.aggregate(steps, F.sequence(F.lit(1), n), swap)


def shuffle_to_shards(
    docs: DataFrame,
    path: str,
    n_shards: int,
    seed: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Write all records, globally shuffled, as ``record, slot`` under ``path/shard=``."""
    size = F.octet_length(whole_text(text_column)).cast("long") + ROW_OVERHEAD
    rows, total = docs.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    n_buckets = max(1, -(-total // BUCKET_BYTES), -(-rows // BUCKET_ROWS))
    grouped = max(1, GROUP_BYTES * n_buckets // max(total, 1))
    hot = max(BUCKET_ROWS, rows // 1000)
    often = docs.groupBy(id_column).agg(F.count("*").alias("n")).filter(F.col("n") > hot)
    hot_ids = [r[0] for r in often.select(id_column).collect()]
    columns = docs.columns
    name = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    key = seeded(F.lit(str(seed)), name)
    if hot_ids:  # their row numbers are stored, so that both passes see the same
        own = fresh(docs, "scatter_row")
        docs = staged(docs.withColumn(own, F.monotonically_increasing_id()), "shard-rows")
        repeated = F.col(id_column).isin([x for x in hot_ids if x is not None])
        if None in hot_ids:
            repeated = repeated | F.col(id_column).isNull()
        by_row = seeded(F.lit(str(seed)), name, F.col(own).cast("string"))
        key = F.when(F.coalesce(repeated, F.lit(False)), by_row).otherwise(key)
    bucket = F.pmod(key, F.lit(n_buckets))
    counts = docs.select(bucket.alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
    starts = staged(running_starts(counts, "bucket"), "shard-offsets")

    scattered = docs.select(
        bucket.alias("bucket"),
        F.struct(
            F.col(id_column).alias("id"),
            F.crc32(whole_text(text_column).cast("binary")).alias("crc"),
            F.struct(*[F.col(f"`{c}`") for c in columns]).alias("record"),
        ).alias("x"),
    ).withColumn("grp", F.expr(f"bucket div {grouped}"))
    gathered = (
        scattered.repartition("grp")
        .groupBy("grp", "bucket")
        .agg(F.sort_array(F.collect_list("x")).alias("xs"))
    )
    few = starts.count() <= BROADCAST_ROWS
    placed = gathered.join(F.broadcast(starts) if few else starts, "bucket")
    mixed = placed.withColumn("turn", permutation(F.size("xs"), seed, F.col("bucket")))
    out = mixed.select(
        "start",
        F.posexplode(F.expr("transform(turn, k -> element_at(xs, k).record)")).alias("p", "record"),
    )
    place = F.col("start") + F.col("p")
    shard = F.expr(f"((start + p) * {n_shards}L) div {max(rows, 1)}L")
    first = F.expr(f"(shard * {max(rows, 1)}L + {n_shards - 1}L) div {n_shards}L")
    out = out.withColumn("shard", shard.cast("int")).select(
        "record", (place - first).alias("slot"), "shard"
    )
    out.write.option("compression", "zstd").partitionBy("shard").parquet(path)


def sharded(
    docs: DataFrame, n_shards: int, seed: int = 0, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Write the shards to the shared folder and read them back: ``record, slot, shard``."""
    spark: SparkSession = docs.sparkSession
    path = staging_path(spark, "shards")
    shuffle_to_shards(docs, path, n_shards, seed, id_column, text_column)
    schema = T.StructType(
        [
            T.StructField("record", docs.schema),
            T.StructField("slot", T.LongType()),
            T.StructField("shard", T.IntegerType()),
        ]
    )
    return spark.read.schema(schema).parquet(path)
