"""The test tables read as movements, airports and holiday records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType

from paxflow.config import Roles

ROLES = Roles(
    time="ts",
    row_id="id",
    target="pax",
    reduced_target="reduced",
    flight="flight",
    seats="seats",
    terminal="terminal",
    direction="direction",
    previous_airport="previous",
    groups=("terminal", "flight"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digits(name: str) -> int:
    """Digits that a double column is compared by.

    Means of whole numbers often end in 5 after four digits but not after six.
    """
    return 6


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded half to even, so that two engines' last bits do not count.

    Scaled and rounded to whole numbers, which every engine does alike; adding 0 drops the sign of
    a negative zero.
    """
    columns = []
    for field in df.schema.fields:
        scale = f"{10 ** digits(field.name)}D"
        columns.append(
            f"rint(`{field.name}` * {scale}) / {scale} + 0D AS `{field.name}`"
            if isinstance(field.dataType, (DoubleType, FloatType))
            else f"`{field.name}`"
        )
    return df.selectExpr(*columns)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as movements to the microsecond."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        "ts",
        F.col("event_type").alias("terminal"),
        F.col("user_id").cast("string").alias("flight"),
        F.when(F.col("user_id") % 2 == 0, "Départ").otherwise("Arrivée").alias("direction"),
        F.rint("value").cast("int").alias("pax"),
        F.rint(F.col("value") / 50).cast("int").alias("reduced"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as movements on a day grain over seven years, with many ties."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderpriority").alias("terminal"),
        F.col("o_custkey").cast("string").alias("flight"),
        F.col("o_orderstatus").alias("direction"),
        F.rint(F.col("o_totalprice") / 1000).cast("int").alias("pax"),
        (F.col("o_custkey") % 200 + 50).cast("int").alias("seats"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in forecast of the events: a straight line through their value."""
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("flight"),
        "ts",
        (value * 0.9 + 5).alias("raw_pax"),
        (value / 60 - 1).alias("raw_reduced"),
        value,
    )


def school_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records of a school calendar, dates as ISO text."""
    ts = F.col("o_orderdate")
    iso = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
    week = F.expr("INTERVAL '7' DAY")
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_custkey") % 4 == 0, "")
        .otherwise(
            F.concat(
                F.lit("Zone "),
                F.substring(F.lit("ABC"), (F.col("o_custkey") % 3 + 1).cast("int"), F.lit(1)),
            )
        )
        .alias("zones"),
        F.col("o_orderpriority").alias("location"),
        F.when(F.col("o_orderstatus") == "F", "Vacances d'Hiver")
        .when(F.col("o_orderstatus") == "O", "Pont de l'Ascension")
        .otherwise("Début de l'Été")
        .alias("description"),
        F.date_format(ts, iso).alias("start_date"),
        F.date_format(ts + week, iso).alias("end_date"),
        F.year(ts).cast("string").alias("annee_scolaire"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("population"),
    )


def order_periods(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Each order as a period of up to five days of its priority or its customer's nation."""
    days = (F.col("o_orderkey") % 5).cast("int")
    start = F.to_date("o_orderdate")
    rows = table(spark, sf_dir, "orders")
    if key == "country":
        rows = rows.join(
            table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
        ).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        name = F.col("n_name")
    else:
        name = F.col("o_orderpriority")
    return rows.select(
        name.alias(key), start.alias("start"), F.date_add(start, days).alias("end")
    )


def nation_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as movements with the customer's nation as country."""
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderdate").alias("ts"),
            F.when(F.col("o_orderstatus") == "F", "Départ").otherwise("Arrivée").alias("direction"),
            F.when(
                F.col("n_nationkey") % 2 == 0, F.lpad(F.col("n_nationkey").cast("string"), 3, "N")
            )
            .otherwise(F.lpad(F.col("n_nationkey").cast("string"), 4, "X"))
            .alias("previous"),
            F.to_date("o_orderdate").alias("day"),
            F.col("n_name").alias("country"),
        )
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One airport per nation; the last nations have no ICAO code, the first ones are French."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.when(key < 23, F.lpad(key.cast("string"), 4, "X")).alias("icao"),
        F.lpad(key.cast("string"), 3, "N").alias("iata"),
        F.when(key < 8, "FR").when(key < 10, "GP").otherwise(F.col("n_name")).alias("country"),
        F.when(key < 3, "Brest / Guipavas")
        .when(key < 5, "Roissy Charles")
        .when(key < 8, "St Etienne")
        .when(key < 10, "Pointe a Pitre")
        .otherwise(F.col("n_name"))
        .alias("city"),
    )


def nation_holidays(spark: SparkSession, sf_dir: str, airport_country: bool) -> DataFrame:
    """One public holiday per nation and year."""
    key = F.col("n_nationkey")
    country = (
        F.when(key < 8, "FR").when(key < 10, "GP").otherwise(F.col("n_name"))
        if airport_country
        else F.col("n_name")
    )
    return table(spark, sf_dir, "nation").select(
        country.alias("country"),
        F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("year"),
        key,
    ).select(
        "country", F.make_date("year", (key % 12 + 1).cast("int"), (key + 1).cast("int")).alias("day")
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names dressed as airport cities, one form per remainder of the size."""
    name, kind = F.col("p_name"), F.col("p_size") % 8
    title = F.initcap(name)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.when(kind == 0, F.concat(F.lit("St "), title))
        .when(kind == 1, F.concat(title, F.lit(" / "), F.col("p_brand")))
        .when(kind == 2, F.concat(F.lit("Figari "), title))
        .when(kind == 3, F.concat(F.lit("Grande Pointe-"), title))
        .when(kind == 4, F.concat(F.lit("La Rochelle "), title))
        .when(kind == 5, F.lit("Brest-Guipavas"))
        .when(kind == 6, F.concat(F.lit("  Saint-Etienne "), title))
        .otherwise(F.replace(title, F.lit(" "), F.lit("-")))
        .alias("city"),
    )
