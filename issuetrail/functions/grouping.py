"""Grouping by long text keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

KEY_HASH = "key_hash"


def group_by_text(df: DataFrame, key: str, *within: str) -> GroupedData:
    """Groups by a text column, with its hash as the leading key. Drop ``KEY_HASH`` from the result.

    An aggregate that keeps a struct is sort-based. URLs share their first bytes, so a sort on them
    compares whole texts; behind a hash, eight bytes settle nearly every comparison. The text
    stays a key, so equal hashes of different texts do no harm.
    """
    return df.groupBy(F.xxhash64(key).alias(KEY_HASH), key, *within)
