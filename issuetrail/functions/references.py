"""Repository names and issue references found in text."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as an issue reference, and the address an issue lives at.
REFERENCE_PATTERN = r"(?iU)(?:https?://github\.com/[\w-]+/[\w-]+/issues/\d+)|(?:#\d+)"
SITE = "https://github.com/"


def tracked_repo(repo: Column, orgs: tuple[str, ...]) -> Column:
    """Whether the name is exactly ``org/name`` with a tracked org.

    Written as prefix tests, which a parquet scan can use to skip row groups.
    """
    if not orgs:
        return F.lit(False)
    return reduce(or_, [repo.startswith(f"{org}/") for org in orgs]) & ~repo.rlike("/.*/")


def references(text: Column) -> Column:
    """All distinct issue references in the whole text. Most of the time goes into the search, so a text that has neither a number sign nor an address is not searched."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(REFERENCE_PATTERN), 0))
    none = ~(text.contains("#") | text.contains("://"))
    return F.when(none, F.array().cast("array<string>")).otherwise(found)


def own_issue_prefix(pr_url: Column) -> Column:
    """Address prefix of the issues in a pull request's own repository; NULL for a short URL."""
    parts = F.split(pr_url, "/")
    return F.when(
        F.size(parts) >= 5,
        F.concat(F.lit(SITE), F.element_at(parts, -4), F.lit("/"), F.element_at(parts, -3), F.lit("/issues/")),
    )


def referenced_issue(reference: Column, prefix: Column) -> Column:
    """Issue URL of one reference: ``#n`` is in the pull request's repository, a URL stays as it is."""
    return F.when(reference.startswith("#"), F.concat(prefix, F.substr(reference, F.lit(2)))).otherwise(reference)
