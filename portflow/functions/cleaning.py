"""Column expressions that turn source text into typed values without ever raising."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\r\n\x0b\x0c"

# A time of day followed by Z or an offset.
_ZONED = r":\d{2}.*(Z|[+-]\d{2}(:?\d{2})?)\s*$"


def stripped(text: Column) -> Column:
    return F.trim(text, F.lit(_BLANKS))


def is_blank(text: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return F.coalesce(stripped(text), F.lit("")) == ""


def to_number(text: Column) -> Column:
    """Finite double, or null for blank or unreadable text.

    A number ends in a digit or a point. That rules out Java literals such as ``12d``, which Spark would
    read as numbers, and the spellings of infinity.
    """
    last = F.substring(F.rtrim(text), -1, 1)
    number = F.when(last <= "9", text.try_cast("double"))
    return F.nanvl(number, F.lit(None).cast("double"))


def to_event_time(text: Column) -> Column:
    """Zone-less timestamp from ISO text, null when unreadable; a stated offset is converted to UTC.

    Plain ``yyyy-mm-ddThh:mm:ss`` text is recognised by its shape and spared the pattern match. Text
    shorter than a full date is not a timestamp, though Spark would read ``2024`` as one.
    """
    local = text.try_cast("timestamp_ntz")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    in_utc = F.timestamp_add("MICROSECOND", F.unix_micros(text.try_cast("timestamp")), epoch)
    is_plain = (F.length(text) == 19) & (F.substring(text, 17, 1) == ":")
    any_iso = F.when(text.rlike(_ZONED), in_utc).otherwise(local)
    return F.when(is_plain, local).when(F.length(text) >= 10, any_iso)


def piped(columns: Iterable[Column]) -> Column:
    """Values joined by a pipe; a null counts as empty text instead of vanishing."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def piped_sha256(columns: Iterable[Column]) -> Column:
    return F.sha2(piped(columns), 256)
