"""Raw vessel messages derived from a table of user events.

Every user becomes a vessel near one of the five default ports. Position, speed and course follow from
the event's numbers, and defects are planted by event id. All text is put together from integers, so it
is the same in any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portflow.sources.ports import DEFAULT_PORTS


def _decimal_text(number: Column, digits: int) -> Column:
    """An integer count of 10^-digits as decimal text."""
    scale = 10**digits
    whole = F.floor(number / scale).cast("string")
    return F.concat(whole, F.lit("."), F.lpad((number % scale).cast("string"), digits, "0"))


def _speed_text(kind: Column, event_id: Column, cents: Column) -> Column:
    stopped = (
        F.when(event_id % 10 == 0, "102.3").when(event_id % 13 == 0, "-1.0").otherwise("0.0")
    )
    return (
        F.when(kind == "error", stopped)
        .when(kind == "purchase", _decimal_text(cents, 3))
        .when(kind == "signup", F.when(event_id % 17 == 0, "").otherwise(_decimal_text(cents, 2)))
        .otherwise(_decimal_text(cents, 4))
    )


def messages_from_events(events: DataFrame) -> DataFrame:
    """Raw messages (seven of the source columns) with the ``event_id`` they come from and the number of the ``copy``."""
    event_id = F.col("event_id")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("bigint")
    ordinal = (F.col("user_id") % len(DEFAULT_PORTS)).cast("int") + 1
    port_lat = F.element_at(F.array(*[F.lit(round(p.latitude * 10_000)) for p in DEFAULT_PORTS]), ordinal)
    port_lon = F.element_at(F.array(*[F.lit(str(p.longitude)) for p in DEFAULT_PORTS]), ordinal)
    seen = F.when(event_id % 211 == 0, F.timestamp_add("YEAR", F.lit(100), F.col("ts"))).otherwise(F.col("ts"))
    cents = F.round(F.col("value") * 100).cast("bigint")
    messages = events.select(
        event_id,
        F.when(event_id % 97 == 0, "").otherwise((F.col("user_id") + 366_000_000).cast("string")).alias("MMSI"),
        F.translate(F.substring(seen.cast("string"), 1, 19), " ", "T").alias("BaseDateTime"),
        F.when(event_id % 89 == 0, "91.0").otherwise(_decimal_text(port_lat + (k - 50) * 50, 4)).alias("LAT"),
        F.when(event_id % 101 == 0, "").otherwise(port_lon).alias("LON"),
        _speed_text(F.col("event_type"), event_id, cents).alias("SOG"),
        F.floor(k * 36 / 10).cast("string").alias("COG"),
        (event_id % 360).cast("string").alias("Heading"),
    )
    # Every fiftieth event is sent again with another heading, every seventieth again byte by byte. ``copy`` tells the messages
    # of one event apart. Generating whole messages makes them plain columns for the plans above, as if read from a file.
    text = [name for name in messages.columns if name != "Heading"]

    def sent(heading: str | Column, copy: int) -> Column:
        return F.struct(*text, F.col(heading) if heading == "Heading" else F.lit(heading).alias("Heading"), F.lit(copy).alias("copy"))

    none = F.array().cast("array<struct<" + ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in messages.select(*text, "Heading").schema) + ",copy:int>>")
    again = F.when(event_id % 50 == 0, F.array(sent("511", 1))).otherwise(none)
    twin = F.when(event_id % 70 == 0, F.array(sent("Heading", 2))).otherwise(none)
    return messages.select(F.inline(F.concat(F.array(sent("Heading", 0)), again, twin)))


def read_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return messages_from_events(events).withColumn("source_file", F.lit("events.parquet"))
