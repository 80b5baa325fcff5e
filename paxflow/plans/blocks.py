"""Even row blocks for windows over ordered rows, whatever the size of a group.

A window partitioned by group sends a whole group to one task. The rows are instead sorted once across the cluster by (group, time, id) and cut into blocks of equal size;
each block also receives the last rows of the block before it, enough to fill every frame. A frame
never leaves its group because the group stays part of the window's partition key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from paxflow.plans.stage import staged

BLOCK = "_block"
POSITION = "_position"
OWNED = "_owned"

# Rows per block, whatever the size of the data: it bounds a task's memory, and being many times
# what frames look back at, keeps the share of repeated rows small.
BLOCK_ROWS = 20_000

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def row_blocks(
    df: DataFrame, keys: list[str], order: list[str], reach: int, block_rows: int | None = None
) -> DataFrame:
    """Adds ``_block``, ``_position`` and ``_owned``; repeats rows that the next block looks back at.

    ``order`` must be a total order within a group. ``reach`` is how many rows back a frame goes.
    """
    numbered = staged(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_serial", F.monotonically_increasing_id()),
        "row-order",
    ).withColumn("_part", F.shiftright("_serial", _ROW_BITS))

    # One row per partition of the sort: bounded by the session's shuffle partitions, so the
    # unpartitioned window and the broadcast below stay small however large the data is.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        numbered.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            "_part",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        )
    )
    size = block_rows or max(BLOCK_ROWS, 4 * reach)
    if size < reach:
        raise ValueError("a block must hold at least the rows a frame reaches back")

    placed = numbered.join(F.broadcast(starts), "_part").select(
        *df.columns,
        (F.col("_start") + F.col("_serial").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))).alias(
            POSITION
        ),
    )
    home = F.floor(F.col(POSITION) / F.lit(size))
    tail = F.col(POSITION) % F.lit(size) >= F.lit(size - reach)
    return (
        placed.withColumn("_home", home)
        .withColumn(
            BLOCK,
            F.explode(
                F.when(tail, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))
            ),
        )
        .withColumn(OWNED, F.col(BLOCK) == F.col("_home"))
        .drop("_home")
    )


def previous_value(
    df: DataFrame, keys: list[str], order: list[str], value: Column, name: str
) -> DataFrame:
    """Value of the row before, within the group."""
    spec = Window.partitionBy(BLOCK, *keys).orderBy(POSITION)
    return (
        row_blocks(df, keys, order, reach=1)
        .withColumn(name, F.lag(value, 1).over(spec))
        .where(OWNED)
        .drop(BLOCK, POSITION, OWNED)
    )
