"""Small text expressions: file names, links, blanks, numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An archive file is one hour, "YYYY-MM-DD-H"; the hour is not padded. The hour may also name the
# directory of the file, which is how Spark lays out an archive it writes itself.
_HOUR_STAMP = r"(\d{4}-\d{2}-\d{2}-\d{1,2})(?:\.json[^/]*|/[^/]*)$"


def decoded_path(path: Column) -> Column:
    """Plain form of a metadata path, which Spark gives URL-encoded; a plus sign stays one. Most paths have nothing to decode."""
    return F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def file_name(path: Column) -> Column:
    """Plain form of a metadata path, the same for every format: with one slash after the scheme where no host is named, as some write three."""
    plain = decoded_path(path)
    return F.when(path.contains(":///"), F.regexp_replace(plain, "^([a-z0-9]+):///", "$1:/")).otherwise(plain)


def _hour_stamp(path: Column) -> Column:
    """One expression for both parts of a stamp, so that a scan searches each row's path once; empty if there is none.

    A stamp is in the file's name or its directory's, so that nothing before these is searched.
    """
    return F.regexp_extract(F.substring_index(path, "/", -2), _HOUR_STAMP, 1)


def archive_date(path: Column) -> Column:
    return F.substring(_hour_stamp(path), 1, 10).try_cast("date")


def archive_hour(path: Column) -> Column:
    return F.substring(_hour_stamp(path), 12, 2).try_cast("int")


def identifier_from_file(file_name: Column) -> Column:
    return F.replace(decoded_path(file_name), F.lit(".json"), F.lit(""))


def is_filled(text: Column) -> Column:
    """Neither NULL nor empty; NULL counts as unmet in a filter."""
    return text != ""


def stripped(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_blank(text: Column) -> Column:
    return F.coalesce(stripped(text), F.lit("")) == ""


def number_or_zero(value: Column) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def issue_link(url: Column, repo: Column, number: Column) -> Column:
    """HTML link to an issue; missing parts are left empty, nothing is escaped."""
    u, r, n = (F.coalesce(c, F.lit("")) for c in (url, repo, number))
    return F.concat(F.lit('<a href="'), u, F.lit('" target="_blank">'), r, F.lit("#"), n, F.lit("</a>"))
