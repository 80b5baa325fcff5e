"""Holiday payloads stored as JSON text, and the city and zone dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paxflow.plans.stage import staged

_RECORDS = (
    "struct<total_count:int,results:array<struct<description:string,start_date:string,"
    "end_date:string,annee_scolaire:string,population:string,zones:string,location:string>>>"
)


def foreign_periods(payloads: DataFrame, text: str = "value") -> DataFrame:
    """(country, start, end) from one JSON text per country and chunk.

    The text is a list of periods or an object that holds it under ``holidays``. Entries that are
    no objects or lack a date are left out; texts that hold no such list are in
    :func:`rejected_payloads`.
    """
    entries = _entries(text)
    item = F.from_json("_entry", "struct<startDate:string,endDate:string>")
    # As a generator the entry is parsed once; the filter below cannot repeat it.
    return (
        payloads.select("country", F.explode(entries).alias("_entry"))
        .select("country", F.inline(F.array(item)))
        .select("country", day_of(F.col("startDate")).alias("start"), day_of(F.col("endDate")).alias("end"))
        .where(F.col("start").isNotNull() & F.col("end").isNotNull())
    )


def _bare(text: str) -> Column:
    return F.regexp_replace(F.col(text), r"^\s+|\s+$", "")


def _entries(text: str) -> Column:
    # A bare list is put into an object, so that each text is parsed once. Entries are taken as
    # text first: one malformed entry does not void its list.
    raw = _bare(text)
    wrapped = F.when(raw.startswith("["), F.concat(F.lit('{"holidays":'), raw, F.lit("}")))
    return F.from_json(F.coalesce(wrapped, raw), "struct<holidays:array<string>>")["holidays"]


def rejected_payloads(payloads: DataFrame, text: str = "value", french: bool = False) -> DataFrame:
    """The payloads that cannot be read, whole: malformed text or another kind of object."""
    found = F.from_json(_bare(text), _RECORDS)["results"] if french else _entries(text)
    return payloads.where(found.isNull())


def day_of(text: Column) -> Column:
    return F.substring_index(text, "T", 1).try_cast("date")


def zone_records(payloads: DataFrame, text: str = "value") -> DataFrame:
    """School-calendar records from JSON texts of the form {total_count, results: [...]}."""
    return payloads.select(
        F.inline(F.from_json(_bare(text), _RECORDS)["results"])
    )


def zone_pages(
    payloads: DataFrame, text: str = "value", key: str = "zone"
) -> tuple[DataFrame, DataFrame]:
    """(records, account) of a school calendar fetched in pages, several texts per ``key``.

    Each text is parsed once and staged. The records carry their ``key``. The account has a row per
    key: ``total_count`` as the service states it (the largest of its pages), the ``entries`` read,
    ``pages``, ``unreadable`` pages and ``complete``: all pages readable and as many entries as
    stated, so a page that was cut, lost or fetched twice shows.
    """
    parsed = staged(
        payloads.select(key, F.from_json(_bare(text), _RECORDS).alias("page")), "zone-pages"
    )
    results = F.col("page.results")
    account = parsed.groupBy(key).agg(
        F.max("page.total_count").alias("total_count"),
        F.sum(F.coalesce(F.size(F.coalesce(results, F.array())), F.lit(0))).alias("entries"),
        F.count(F.lit(1)).alias("pages"),
        F.count_if(results.isNull()).alias("unreadable"),
    )
    stated = F.coalesce(F.col("total_count") == F.col("entries"), F.lit(False))
    account = account.withColumn("complete", stated & (F.col("unreadable") == 0))
    return parsed.select(key, F.inline(results)), account


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its whole text and its name without extension as ``country``."""
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return spark.read.text(path, wholetext=True).select(
        "value", F.substring_index(name, ".", 1).alias("country")
    )


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Saved lookups: one JSON object, target -> {zone, is_holiday}."""
    saved = F.from_json("value", "map<string,struct<zone:string,is_holiday:string>>")
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(saved).alias("target", "found"))
        .select("target", "found.*")
    )


def write_zone_lookup(lookup: DataFrame, path: str) -> None:
    """Saved as the one object that :func:`read_zone_lookup` reads; a table of districts, far below
    a thousand rows."""
    found = F.struct("zone", F.col("is_holiday").cast("string").alias("is_holiday"))
    whole = lookup.agg(F.map_from_entries(F.collect_list(F.struct("target", found))).alias("m"))
    whole.select(F.to_json("m").alias("value")).write.mode("overwrite").text(path)
