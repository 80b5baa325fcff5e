"""Exact dedup: a tree-merge of sorted digest runs, in DataFrame operations only.

Every input partition is a run: its digests with their count and the identifier that stays. Runs
are merged ``FAN_IN`` at a time, round by round, until one is left; then the answer goes down the
same tree to the rows. A merge or a join is keyed by (digest, run), so a group that holds a third
of all rows is spread over as many runs as it came in and is never one task's work: after the
first round each run holds it once. Texts never leave the scan; what is shuffled is their digests.

A digest is verified by the text's byte length and a second hash: only texts that agree in all
three are one group, at every level.

Defined results: a null text is the empty text. A null identifier is the smallest one. Of rows that
repeat both identifier and text, one is kept. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paxflow.llm.common import fresh, whole_text
from paxflow.plans.stage import staged

#: Runs that one merge takes together.
FAN_IN = 8

KEY = ["text_sha256", "n_bytes", "check"]


def digest_runs(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One small row per document: identifier, digest, and the run (partition) it lies in."""
    text = whole_text(text_column)
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.sha2(text, 256).alias("text_sha256"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.xxhash64(text).alias("check"),
        F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("run"),
    )
    return staged(rows, "digest-rows")


def merge(level: DataFrame, best) -> DataFrame:
    """One round: ``FAN_IN`` neighbouring runs become one."""
    return level.groupBy(*KEY, F.expr(f"run div {FAN_IN}").cast("int").alias("run")).agg(
        best("best").alias("best"), F.sum("n").alias("n")
    )


def descend(level: DataFrame, upper: DataFrame) -> DataFrame:
    """Give each run of ``level`` what the run above it has found."""
    above = upper.select(*KEY, F.col("run").alias("above"), "best", "n")
    return (
        level.select(*KEY, "run", F.expr(f"run div {FAN_IN}").cast("int").alias("above"))
        .join(above, [*KEY, "above"])
        .select(*KEY, "run", "best", "n")
    )


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest"
) -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``keep`` names which identifier of equal texts stays, the ``largest`` or the ``smallest``.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep: 'largest' or 'smallest'")
    rows = digest_runs(docs, id_column, text_column)
    best = F.max if keep == "largest" else F.min
    runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    first = rows.groupBy(*KEY, "run").agg(
        best(F.struct("id", "row")).alias("best"), F.count("*").alias("n")
    )
    levels = [staged(first, "digest-level")]
    while runs > 1:
        levels.append(staged(merge(levels[-1], best), "digest-level"))
        runs = -(-runs // FAN_IN)
    found = levels.pop()
    while levels:
        found = descend(levels.pop(), found)
    return rows.join(found, [*KEY, "run"]).select(
        F.col("id").alias("doc_id"),
        F.col("best.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest"
) -> DataFrame:
    """The documents that stay, all columns; one of each group of equal texts.

    Rows that repeat identifier and text are reduced within their partition first.
    """
    digest = fresh(docs, "kept_digest")
    stay = exact_groups(docs, id_column, text_column, keep).filter("kept")
    stay = stay.select(F.col("doc_id").alias("stay_id"), F.col("text_sha256").alias("stay_digest"))
    named = docs.withColumn(digest, F.sha2(whole_text(text_column), 256))
    single = named.dropDuplicates([id_column, digest])
    match = single[id_column].eqNullSafe(stay["stay_id"]) & (single[digest] == stay["stay_digest"])
    return single.join(stay, match, "left_semi").drop(digest)
