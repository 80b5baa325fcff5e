"""Quality rules by cross-document line frequency, in DataFrame operations only.

Normalised lines are hashed and counted per host (the ``source`` column): in how many distinct
documents of the host does a line stand? Equal texts are one document there, so copies do not turn
their own lines into boilerplate. Lines above both limits are boilerplate, and a document that
would lose more than ``max_removed_share`` of its words with them is depleted and rejected. The same
pass works out the base figures of each text. ``without_boilerplate`` returns the texts without these
lines, by a count of documents that does not grow with the host.

Texts stay in the scan: one small row per document, with its lines' hashes, is staged. Counting
first combines (line, text) pairs and then lines, so neither a hot host nor a line that a third of
all documents share meets in one task. The table of frequent lines and the table of hosts are
broadcast only below ``BROADCAST_ROWS`` rows; beyond it they are joined by shuffle.

Defined results: a null text has no words and fails the base rules; a null host is a host of its
own; repeated rows are rated one by one; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxflow.llm.common import BLANKS, WORD, fresh, whole_text
from paxflow.plans.stage import staged

BROADCAST_ROWS = 200_000
WINDOW = 8


@dataclass(frozen=True)
class Limits:
    """A line is boilerplate of its host in at least ``min_documents`` and ``min_share`` of its
    distinct documents; the other values are the base rules."""

    min_documents: int = 20
    min_share: float = 0.1
    max_removed_share: float = 0.5
    min_words: int = 20
    max_repeat_percent: int = 30


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, also where lambdas use it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def repeated_words(words: Column) -> Column:
    """Words covered by ``WINDOW``-word windows that stand in the text twice or more."""

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twin(s: Column, x: Column, i: Column, step: int) -> Column:
            return F.coalesce(F.get(s, i + step)["h"] == x["h"], F.lit(False))

        starts = let(
            pairs,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(s, lambda x, i: twin(s, x, i, -1) | twin(s, x, i, 1)),
                    lambda x: x["i"],
                )
            ),
        )
        zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            starts,
            zero,
            lambda a, p: F.struct(
                p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")
            ),
            lambda a: a["n"],
        )

    def windows(hashed: Column) -> Column:
        last = F.size(hashed) - WINDOW
        return F.when(
            last >= 0,
            F.transform(
                F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                lambda i: F.xxhash64(*[F.get(hashed, i + k) for k in range(WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<bigint>"))

    return let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda hashed: let(
            windows(hashed),
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
                covered(h)
            ),
        ),
    ).cast("long")


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), BLANKS, " "))


def measured(
    docs: DataFrame, id_column: str, text_column: str, host_column: str
) -> DataFrame:
    """One staged row per document: base figures and hashed lines with their word counts."""
    text = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("doc_id"),
        F.col(host_column).cast("string").alias("host"),
        whole_text(text_column).alias("t"),
    )
    split = text.select(
        "*",
        words_of(F.col("t")).alias("words"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    )
    return staged(
        split.select(
            "row",
            "doc_id",
            "host",
            F.xxhash64("t").alias("digest"),
            F.size("words").cast("long").alias("n_words"),
            F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            repeated_words(F.col("words")).alias("n_repeat_words"),
            F.transform(
                "lines",
                lambda x: F.struct(
                    F.xxhash64(F.col("host"), normalised(x)).alias("k"),
                    F.size(words_of(x)).alias("w"),
                ),
            ).alias("lines"),
        ),
        "quality-rows",
    )


def _beside(df: DataFrame, small: DataFrame, on: str) -> DataFrame:
    """Join ``small``, a staged table, by broadcast only if its counted rows are few."""
    few = small.count() <= BROADCAST_ROWS
    return df.join(F.broadcast(small) if few else small, on)


#: Limits of ``without_boilerplate``: a count alone, so a large host does not raise it.
BY_COUNT = Limits(min_share=0.0)


def boilerplate_lines(rows: DataFrame, limits: Limits) -> DataFrame:
    """Per row and boilerplate line in it: its hash ``k`` and its words ``w``."""
    hosts = rows.select(F.xxhash64("host").alias("host_key"), "digest").distinct()
    hosts = staged(hosts.groupBy("host_key").agg(F.count("*").alias("host_docs")), "quality-hosts")
    lines = rows.select("digest", F.explode(F.array_distinct("lines.k")).alias("k")).distinct()
    common = lines.groupBy("k").agg(F.count("*").alias("line_docs"))
    common = staged(common.filter(F.col("line_docs") >= limits.min_documents), "quality-lines")
    stand = rows.select("row", F.xxhash64("host").alias("host_key"), F.explode("lines").alias("x"))
    stand = stand.select("row", "host_key", F.col("x.k").alias("k"), F.col("x.w").alias("w"))
    found = _beside(_beside(stand, common, "k"), hosts, "host_key")
    return found.filter(F.col("line_docs") >= limits.min_share * F.col("host_docs"))


def removed_words(rows: DataFrame, limits: Limits) -> DataFrame:
    """Per row that loses any: the words in its boilerplate lines."""
    return boilerplate_lines(rows, limits).groupBy("row").agg(F.sum("w").alias("removed_words"))


def without_boilerplate(
    docs: DataFrame,
    limits: Limits = BY_COUNT,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
) -> DataFrame:
    """All documents with all their columns, their texts without boilerplate lines."""
    rows = measured(docs, id_column, text_column, host_column)
    lost = boilerplate_lines(rows, limits).groupBy("row").agg(F.collect_set("k").alias("lost_lines"))
    lost = lost.join(rows.select("row", "doc_id", "host", "digest"), "row")
    lost = lost.dropDuplicates(["doc_id", "host", "digest"])
    digest = fresh(docs, "lost_digest")
    named = docs.withColumn(digest, F.xxhash64(whole_text(text_column)))
    host = named[host_column].cast("string")
    match = (
        named[id_column].eqNullSafe(lost["doc_id"])
        & (named[digest] == lost["digest"])
        & host.eqNullSafe(lost["host"])
    )
    left = F.filter(
        F.split(named[text_column], "\n"),
        lambda x: ~(x.rlike(WORD) & F.array_contains(lost["lost_lines"], F.xxhash64(host, normalised(x)))),
    )
    text = F.when(lost["lost_lines"].isNull(), named[text_column]).otherwise(F.array_join(left, "\n"))
    columns = [text.alias(c) if c == text_column else named[c] for c in docs.columns]
    return named.join(lost, match, "left").select(*columns)


def quality_rules(
    docs: DataFrame,
    limits: Limits = Limits(),
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
) -> DataFrame:
    """Per row: ``doc_id, n_words``, the base figures, ``base_failed, removed_words, kept``, and the
    text's hash as ``digest``."""
    rows = measured(docs, id_column, text_column, host_column)
    rated = rows.drop("lines", "host").join(removed_words(rows, limits), "row", "left")
    removed = F.coalesce("removed_words", F.lit(0)).cast("long")
    failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")
    )
    return rated.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        removed.alias("removed_words"),
        (~failed & (removed <= limits.max_removed_share * F.col("n_words"))).alias("kept"),
        "digest",
    )


def keep_good(
    docs: DataFrame,
    limits: Limits = Limits(),
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
) -> DataFrame:
    """The documents that the rules keep, with all their columns and their whole texts."""
    digest = fresh(docs, "rated_digest")
    kept = quality_rules(docs, limits, id_column, text_column, host_column).filter("kept")
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest"))
    named = docs.withColumn(digest, F.xxhash64(whole_text(text_column)))
    match = named[id_column].eqNullSafe(kept["kept_id"]) & (named[digest] == kept["kept_digest"])
    return named.join(kept.distinct(), match, "left_semi").drop(digest)
