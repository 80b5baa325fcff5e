"""One query per operator over its whole table, and the SQL of those that SQL can state."""

from __future__ import annotations

import secrets
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paxflow.llm.common import table
from paxflow.llm.divergence import divergence
from paxflow.llm.exact_dedup import exact_groups
from paxflow.llm.html_text import main_text
from paxflow.llm.mixing import mixed_rates
from paxflow.llm.pieces import encode_texts
from paxflow.llm.prefix_trie import prefix_trie, rebuilt, sequences
from paxflow.llm.pseudonyms import replace_values
from paxflow.llm.quality import quality_rules
from paxflow.llm.sharding import sharded
from paxflow.llm.shingle_join import shingle_components
from paxflow.llm.token_files import token_files
from paxflow.llm.tokens import token_counts
from paxflow.llm.toxic_spans import toxic_spans
from paxflow.plans.stage import staged

#: Names the session's key of op6; a deployment sets it from its own secrets.
PSEUDONYM_KEY = "spark.paxflow.pseudonyms.key"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE["op1_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return mixed_rates(docs, labels).drop("digest")


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(table(spark, sf_dir, "documents"), path, limit=1024)


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("record.text", F.lit(""))
    return sharded(table(spark, sf_dir, "documents"), 40).select(
        F.col("record.doc_id").alias("doc_id"),
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("digest")


ORACLE["op5_quality_rules"] = r"""
WITH d AS (
    SELECT doc_id, source, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, i, list_slice(words, i, i + 7) AS w
    FROM d, unnest(range(1, len(words) - 6)) AS r(i)
), twice AS (
    SELECT doc_id, i FROM windows
    QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n
    FROM twice, unnest(range(0, 8)) AS s(k) GROUP BY doc_id
), hosts AS (
    SELECT source, count(DISTINCT t) AS host_docs FROM d GROUP BY source
), lines AS (
    SELECT doc_id, source, t, trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g')) AS line,
           len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w
    FROM (SELECT doc_id, source, t, unnest(lines) AS x FROM d)
), common AS (
    SELECT source, line FROM lines JOIN hosts USING (source) GROUP BY source, line, host_docs
    HAVING count(DISTINCT t) >= greatest(20, 0.1 * host_docs)
), removed AS (
    SELECT doc_id, sum(w)::BIGINT AS n FROM lines JOIN common USING (source, line) GROUP BY doc_id
), figures AS (
    SELECT doc_id, len(words) AS n_words,
           coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(covered.n, 0) AS n_repeat_words, coalesce(removed.n, 0) AS removed_words
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN removed USING (doc_id)
), rated AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM figures
)
SELECT *, NOT base_failed AND removed_words <= 0.5 * n_words AS kept FROM rated
"""


@query
def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(PSEUDONYM_KEY, None) or secrets.token_hex(32)  # else of this run alone
    docs, count = replace_values(table(spark, sf_dir, "documents"), key)
    return docs.select("doc_id", "text", count)


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files(table(spark, sf_dir, "documents"), path)


@query
def op8_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_components(table(spark, sf_dir, "documents"))


@query
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return encode_texts(table(spark, sf_dir, "documents"), path)


@query
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return toxic_spans(docs, labels).withColumn("n_spans", F.size("spans")).drop("spans")


@query
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


ORACLE["op12_divergence"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), occurrences AS (
    SELECT row, lang, source, term, count(*) AS n
    FROM (SELECT row, lang, source, unnest(terms) AS term FROM d) GROUP BY ALL
), kept AS (
    SELECT lang, term, sum(n)::HUGEINT AS n FROM occurrences GROUP BY lang, term HAVING count(*) >= 3
), sizes AS (
    SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang
), groups AS (
    SELECT DISTINCT lang, source FROM d
), counts AS (
    SELECT g.lang, g.source, k.term, coalesce(sum(o.n), 0)::HUGEINT AS n
    FROM groups g JOIN kept k ON k.lang = g.lang
    LEFT JOIN occurrences o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term GROUP BY ALL
), p AS (
    SELECT c.*, 1 + (1000000000 * (n + 1)) // (sum(n) OVER (PARTITION BY c.lang, source)::HUGEINT + v) AS p
    FROM counts c JOIN sizes s ON s.lang = c.lang
), pairs AS (
    SELECT a.lang, a.source, b.source AS item,
           coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // y.p) FROM p x JOIN p y ON y.lang = x.lang AND y.term = x.term
                     WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
), terms AS (
    SELECT p.lang, source, p.term AS item, (p - q) * (p - q) // q AS value
    FROM p JOIN (SELECT k.lang, term, 1 + (1000000000 * (n + 1)) // (total + v) AS q
                 FROM kept k JOIN sizes s ON s.lang = k.lang) l ON l.lang = p.lang AND l.term = p.term
    WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM pairs
UNION ALL
SELECT * FROM (
    SELECT lang, source, 'term' AS part, item, value::BIGINT AS value,
           row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM terms
) WHERE rank <= 200
"""


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = staged(sequences(table(spark, sf_dir, "conversations")), "conversations")
    return prefix_trie(rebuilt(convs, family=20, most=4))


ORACLE["op13_prefix_trie"] = r"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(
        [4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                                      lambda a, b: xor(a >> 1, 3988292384 * (a & 1))))) % 4 AS h
    FROM turns
), built AS (
    SELECT c.conv_id, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND pos <= h
    UNION ALL
    SELECT c.conv_id, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND pos > h
), whole AS (
    SELECT convs.conv_id, coalesce(q, []) AS q
    FROM convs LEFT JOIN (
        SELECT conv_id, list({'role': role, 'text': text} ORDER BY pos) AS q FROM built GROUP BY conv_id
    ) s ON s.conv_id = convs.conv_id
), members AS (
    SELECT conv_id, d, list_slice(q, 1, d) AS k, len(q) = d AS ends
    FROM (SELECT conv_id, q, unnest(range(0, len(q) + 1)) AS d FROM whole)
), nodes AS (
    SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM members GROUP BY k, d
), valued AS (
    SELECT *, CASE WHEN d = 0 THEN 0 ELSE
               (n_convs - 1) * len(regexp_extract_all(k[d].text, '[^ 	-
]+')) END AS saved
    FROM nodes
), below AS (
    SELECT list_slice(k, 1, e) AS k, e, count(*) FILTER (WHERE d = e + 1) AS n_children, sum(saved) AS saved_tokens
    FROM (SELECT k, d, saved, unnest(range(0, d + 1)) AS e FROM valued) GROUP BY 1, 2
), leaves AS (
    SELECT list_slice(k, 1, e) AS k, e, count(*) AS n_leaves
    FROM (SELECT k, e AS d, unnest(range(0, e + 1)) AS e FROM below WHERE n_children = 0) GROUP BY 1, 2
)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, b.n_children, l.n_leaves,
       b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM valued n JOIN below b ON b.e = n.d AND b.k = n.k JOIN leaves l ON l.e = n.d AND l.k = n.k
LEFT JOIN valued p ON p.d = n.d - 1 AND p.k = list_slice(n.k, 1, n.d - 1) AND n.d > 0
"""
