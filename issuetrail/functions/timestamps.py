"""ISO-8601 text, instants and day counts. Texts are UTC whatever the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The text that stands for a missing time, and the output form.
MISSING = "N/A"
ISO_OUTPUT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

_CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
# A full date, then optionally a time of day and a zone. Bare years, months and times of day
# are kept out: the cast would accept them, and would complete "10:00" with today's date.
_FULL_DATE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
# Two readable forms the cast does not know: no dashes, and no seconds before a zone.
_COMPACT_DATE = r"^(\d{4})(\d{2})(\d{2})$"
_NO_SECONDS = r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})(?=Z|[+-]|$)"
# Without a zone a text is UTC, not the session's time.
_DATE_ONLY = r"^(\d{4}-\d{2}-\d{2})$"
_NO_ZONE = r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,9})?)$"

_MICROS_PER_DAY = 86_400_000_000


def parse_iso(text: Column) -> Column:
    """Instant of an ISO-8601 text; NULL when the text is missing or is not one. Nearly all texts are canonical, so that other forms are edited only if they occur."""
    dashed = F.regexp_replace(F.regexp_replace(text, _COMPACT_DATE, "$1-$2-$3"), _NO_SECONDS, "$1:00")
    zoned = F.regexp_replace(F.regexp_replace(dashed, _DATE_ONLY, "$1T00:00:00Z"), _NO_ZONE, "$1Z")
    edited = F.try_to_timestamp(F.regexp_extract(zoned, _FULL_DATE, 0))
    return F.when(text.rlike(_CANONICAL), F.try_to_timestamp(text)).otherwise(edited)


def utc_text(moment: Column) -> Column:
    """The instant in UTC to the second, without the session's time zone."""
    seconds = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.unix_seconds(moment))
    return F.concat(F.translate((F.expr("timestamp_ntz'1970-01-01 00:00:00'") + seconds).cast("string"), " ", "T"), F.lit("Z"))


def instant_of(normalized: Column) -> Column:
    """Instant of a text that ``normalize_iso`` made; NULL when that could not read it."""
    return F.try_to_timestamp(F.regexp_extract(normalized, _CANONICAL, 0))


def is_present(text: Column) -> Column:
    """Whether a time text says anything at all, readable or not."""
    return text.isNotNull() & ~F.regexp_replace(text, r"(?U)^\s+|\s+$", "").isin("", MISSING)


def normalize_iso(text: Column) -> Column:
    """UTC text to the second; unreadable text comes back with its blanks edited; NULL when missing."""
    blank_as_t = F.translate(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), " ", "T")
    return F.when(text.rlike(_CANONICAL), text).when(
        is_present(text), F.coalesce(utc_text(parse_iso(blank_as_t)), blank_as_t)
    )


def normalize_timestamps(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named text columns in normal form, with missing times written out as text."""
    return df.withColumns({c: F.coalesce(normalize_iso(F.col(c)), F.lit(MISSING)) for c in columns})


def whole_days(since: Column, until: Column) -> Column:
    """Complete 24-hour spans from ``since`` to ``until``, rounded towards the past."""
    micros = F.unix_micros(until) - F.unix_micros(since)
    return ((micros - F.pmod(micros, F.lit(_MICROS_PER_DAY))) / F.lit(_MICROS_PER_DAY)).cast("bigint")


def month_key(moment: Column) -> Column:
    return F.substring(utc_text(moment), 1, 7)
