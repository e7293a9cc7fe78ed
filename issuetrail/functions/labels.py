"""Issue labels: raw JSON text to lower-cased names, and the wanted-label test."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_names(raw: Column) -> Column:
    """Names of the objects in a JSON array, lower-cased; an empty array for anything else.

    The elements are read as text, because a typed read gives NULL for the whole array as soon
    as one element is not an object, and wraps a lone object into an array. The array is read as a field with another
    after it, which is met only if nothing follows the array.
    """
    read = F.from_json(F.concat(F.lit('{"labels":'), raw, F.lit(',"ended":true}')), "labels array<string>, ended boolean")
    elements = F.when(read["ended"], read["labels"])
    objects = F.filter(elements, lambda e: e.rlike(r"^\s*\{"))
    names = F.transform(objects, lambda e: F.lower(F.coalesce(F.get_json_object(e, "$.name"), F.lit(""))))
    none = F.array().cast("array<string>")
    return F.when(raw.rlike(r"^\s*\["), F.coalesce(names, none)).otherwise(none)


def has_wanted_label(names: Column, wanted: tuple[str, ...]) -> Column:
    """Whether any name contains any wanted word."""
    if not wanted:
        return F.lit(False)
    return F.exists(names, lambda n: reduce(or_, [n.contains(w.lower()) for w in wanted]))


def joined_labels(names: Column) -> Column:
    return F.array_join(F.coalesce(names, F.array().cast("array<string>")), ", ")
