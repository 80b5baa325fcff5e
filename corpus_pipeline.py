"""From raw documents to token ids: five stages, each written and read again.

``run`` reads ``documents`` (and ``labels`` for the mixture) and returns one row per document that
stays: its number of tokens and the digests of its ids and of the text decoded from them. The texts
of documents that stay are whole: the quality stage drops documents, not lines.

Defined results: a null text counts as empty, which the quality rules reject, as they do texts of fewer
than twenty words; repeated rows are exact copies, of which one stays; a null language or source is a
value of its own; an empty table gives an empty result; further columns of ``documents`` are carried to
the last stage, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from paxflow.llm.common import table
from paxflow.llm.exact_dedup import drop_exact_copies
from paxflow.llm.mixing import mix
from paxflow.llm.pieces import encode_texts
from paxflow.llm.quality import keep_good
from paxflow.llm.shingle_join import one_of_each
from paxflow.plans.stage import staged

#: SQL cannot state the near duplicates, the fitted classifier, nor the vocabulary.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates up to one, by a seeded draw: clean documents stay, no document is repeated."""
    return mix(docs, table(spark, sf_dir, "labels"), most=1.0)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing", mixture),
    ("sentencepiece", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline")
    return docs
