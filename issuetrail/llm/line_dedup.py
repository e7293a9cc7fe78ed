"""Operator 10, line dedup: content-defined chunks of lines, and what runs reach beyond them; only the first occurrence in the corpus stays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from issuetrail.llm.common import MOST, table, written

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACED = "node long, version long, at int, size int, hash long"


def profile(rows: DataFrame, seed: int) -> DataFrame:
    """(node, version, widths, hashes): code points and 64-bit hashes of each text's lines, packed; rows: (node, version, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        salt = seed.to_bytes(8, "little")
        for batch in batches:
            widths, hashes = [], []
            for text in batch.pop("text"):
                lines = text.split("\n")
                widths.append(np.fromiter(map(len, lines), "<i4", len(lines)).tobytes())
                hashes.append(b"".join([hashlib.blake2b(line.encode(), digest_size=8, salt=salt).digest() for line in lines]))
            yield batch.assign(widths=widths, hashes=hashes)

    return rows.where("text is not null").select("node", "version", "text").mapInPandas(run, "node long, version long, widths binary, hashes binary")


class Lines:
    """The lines of some texts, one after the other, with a polynomial hash that rolls over the hashes of lines."""

    def __init__(self, widths: list[bytes], hashes: list[bytes]) -> None:
        counts = np.fromiter((len(w) // 4 for w in widths), np.int64, len(widths))
        self.text = np.repeat(np.arange(len(counts)), counts)
        self.first = np.repeat(np.cumsum(counts) - counts, counts)
        self.last = np.repeat(np.cumsum(counts) - 1, counts)
        self.n = len(self.text)
        self.at = np.arange(self.n)
        #: characters before each line, with a line feed after each
        self.chars = np.concatenate([[0], np.cumsum(np.frombuffer(b"".join(widths), "<i4").astype(np.int64) + 1)])
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(self.n, _BASE, np.uint64))
            self.inverse = np.cumprod(np.full(self.n, _INVERSE, np.uint64))
            terms = np.frombuffer(b"".join(hashes), "<u8") * powers
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])

    def rolled(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hashes of the runs from line `start` to line `end`, both included, wherever they stand."""
        with np.errstate(over="ignore"):
            found = (self.sums[end + 1] - self.sums[start]) * self.inverse[start]
            found ^= (end - start).astype(np.uint64)
            for shift in (30, 27, 31):
                found = (found ^ (found >> np.uint64(shift))) * np.uint64(0xBF58476D1CE4E5B9)
        return found ^ (found >> np.uint64(32))

    def width(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.chars[end + 1] - self.chars[start] - 1

    def chunks(self, divisor: int, least_chars: int) -> tuple[np.ndarray, np.ndarray]:
        """Chunks from each boundary to the next, both included, of so many characters.

        A line is a boundary where the hash rolling over it and the line after it is zero modulo the divisor, so boundaries move with the lines and
        not with what stands before them. The last line of a text is one as well.
        """
        inner = self.at[self.at < self.last]
        inner = inner[self.rolled(inner, inner + 1) % np.uint64(divisor) == 0]
        bounds = np.union1d(inner, self.last)
        start, end = bounds[:-1], bounds[1:]
        fine = (self.text[start] == self.text[end]) & (self.width(start, end) >= least_chars)
        return start[fine], end[fine]

    def windows(self, least_chars: int, long_line: int) -> tuple[np.ndarray, np.ndarray]:
        """The shortest runs of two lines or more, and so many characters, that begin or end at each line; and single lines of `long_line` characters.

        A run of so many characters is covered by the shortest ones inside it: by those that begin at its lines, and the one that ends at its last.
        """
        forward = np.maximum(self.at + 1, np.searchsorted(self.chars, self.chars[:-1] + 1 + least_chars) - 1)
        backward = np.minimum(self.at - 1, np.searchsorted(self.chars, self.chars[1:] - 1 - least_chars, "right") - 1)
        fine, back = forward <= self.last, backward >= self.first
        alone = self.width(self.at, self.at) >= long_line
        pairs = np.stack([np.concatenate([self.at[fine], backward[back], self.at[alone]]), np.concatenate([forward[fine], self.at[back], self.at[alone]])])
        start, end = np.unique(pairs, axis=1)
        return start, end

    def inside(self, runs: list, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which runs lie within one of the given (text, at, size)."""
        reach = np.full(self.n, -1)
        if runs:
            text, at, size = np.array(runs).T
            first = self.first[np.searchsorted(self.text, text)]
            np.maximum.at(reach, first + at, first + at + size - 1)
        # texts lie in order, so a reach from a text before never reaches into the next
        return np.maximum.accumulate(reach)[start] >= end


def _placed(profiles: DataFrame, choose, gone: bool) -> DataFrame:
    """The runs that `choose` finds in profiles, (node, version, at, size, hash); gone: profiles have the runs (at, size) to leave out with all inside."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lines = Lines(batch["widths"].tolist(), batch["hashes"].tolist())
            start, end = choose(lines)
            if gone:
                runs = [(i, r["at"], r["size"]) for i, found in enumerate(batch["gone"]) if found is not None for r in found]
                left = ~lines.inside(runs, start, end)
                start, end = start[left], end[left]
            text = lines.text[start]
            at, size = (start - lines.first[start]).astype(np.int32), (end - start + 1).astype(np.int32)
            hashes = lines.rolled(start, end).view(np.int64)
            yield pd.DataFrame({"node": batch["node"].to_numpy()[text], "version": batch["version"].to_numpy()[text], "at": at, "size": size, "hash": hashes})

    return profiles.mapInPandas(run, _PLACED)


def _repeated(runs: DataFrame) -> DataFrame:
    """(hash, node, version, at, size, is_first) of runs whose hash occurs in two places or more; runs: _placed, written."""
    place = F.struct("node", "version", "at")
    counted = runs.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    again = written(counted.where("first <> last").select("hash", "first"))
    return written(runs.join(again, "hash").select("hash", "node", "version", "at", "size", (place == F.col("first")).alias("is_first")))


def _listed(met: DataFrame) -> DataFrame:
    """(node, version, gone): the later occurrences in each text; as many as the text has lines, some times over."""
    return met.where(~F.col("is_first")).groupBy("node", "version").agg(F.collect_set(F.struct("at", "size")).alias("gone"))


def _told_apart(rows: DataFrame, met: DataFrame) -> bool:
    """Whether all runs that share a hash are the same, character by character: the least and the greatest are equal."""
    places = met.groupBy("node", "version").agg(F.collect_set(F.struct("hash", "at", "size")).alias("places"))
    # by shuffle at every size, so that small and large inputs go the same way
    texts = rows.join(places.hint("merge"), ["node", "version"]).select(F.split("text", "\n").alias("lines"), F.explode("places").alias("c"))
    run = F.array_join(F.slice("lines", F.col("c.at") + 1, F.col("c.size")), "\n")
    compared = texts.select("c.hash", run.alias("run")).groupBy("hash").agg((F.min("run") != F.max("run")).alias("differ"))
    return compared.where("differ").isEmpty()


def repeated_runs(rows: DataFrame, divisor: int, least_chars: int, long_line: int) -> DataFrame:
    """(node, version, gone): the runs (at, size) to take out of each text; rows: (node, version, text), equal rows once or more.

    First the content-defined chunks, which are few and of which long passages and copies of whole texts mostly consist. Then, where none was taken out, the
    shortest runs, which take matches on to the ends of what is repeated and find passages that no chunk fits in. What lies within a chunk that was taken out
    occurs where that chunk was first, so it needn't be counted again. Runs are counted by hash; the characters of those that occur again are then
    compared, and if two differ under a hash, all is done once more with other hashes.
    """
    seed = 0
    while True:
        profiles = written(profile(rows, seed))
        chunks = _repeated(written(_placed(profiles, lambda lines: lines.chunks(divisor, least_chars), gone=False)))
        left = profiles.join(written(_listed(chunks)), ["node", "version"], "left")
        ends = _repeated(written(_placed(left, lambda lines: lines.windows(least_chars, long_line), gone=True)))
        met = chunks.union(ends)
        if _told_apart(rows, met):
            return _listed(met)
        seed += 1


def _lines_of(runs: Column) -> Column:
    """The places of all lines of an array of (at, size)."""
    return F.array_distinct(F.flatten(F.transform(runs, lambda c: F.sequence(c["at"], c["at"] + c["size"] - 1))))


def remove_repeated(documents: DataFrame, divisor: int = 4, least_chars: int = 40, long_line: int = 200) -> DataFrame:
    """The documents' rows and columns with repeated runs of lines taken out of text, n_chars (if there is one) put right, and `removed_lines`.

    A line goes if it is in a run of two or more lines, of `least_chars` characters or more, that occurred before, or if it has `long_line`
    characters or more and occurred before: by doc_id (null last), then by the text's hash, then by place, also in the same document. Shorter repeated runs stay,
    and so does a single shorter line between others. The divisor of the chunks' boundaries decides how much is found by chunks and how much by the shortest
    runs, not what is found. A null text stays null; a text of which all lines go is empty; equal rows are one document and
    share its result; other columns are kept as they are; an empty table stays one. Of the ids, which are integers, 2^63 - 1 stands for null.
    """
    node, version, gone = "_lines_node", "_lines_version", "_lines_gone"
    more = [c for c in documents.columns if c not in ("doc_id", "text", "n_chars", "removed_lines")]
    sized = ["n_chars"] if "n_chars" in documents.columns else []
    tagged = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(MOST)).alias(node), F.xxhash64("text").alias(version), "text", *sized, *more)
    rows = tagged.select(F.col(node).alias("node"), F.col(version).alias("version"), "text")
    found = written(repeated_runs(rows, divisor, least_chars, long_line))
    found = found.select(F.col("node").alias(node), F.col("version").alias(version), F.col("gone").alias(gone))
    lines = F.split("text", "\n")
    tagged = tagged.join(found.hint("merge"), [node, version], "left").withColumn(gone, _lines_of(F.col(gone)))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: lines[i]), "\n"))
    result = tagged.withColumn("text", text).withColumn("removed_lines", F.coalesce(F.size(gone), F.lit(0)).cast("long"))
    result = result.withColumn("doc_id", F.when(F.col(node) != MOST, F.col(node)))
    if sized:
        size = F.when(F.col(gone).isNull(), F.col("n_chars")).otherwise(F.char_length("text"))
        result = result.withColumn("n_chars", size.cast(dict(documents.dtypes)["n_chars"]))
    return result.select(*[c for c in documents.columns if c != "removed_lines"], "removed_lines")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"), "removed_lines", "text")


#: The shortest runs of 40 characters; a line feed is a character, so none has more than 41 lines.
SQL = """
WITH lines AS (
    SELECT doc_id, string_split(text, chr(10)) AS l FROM documents
), placed AS (
    SELECT doc_id, l, unnest(range(len(l))) AS i FROM lines
), runs AS (
    SELECT doc_id, l, i, unnest(range(i + 1, least(i + 41, len(l)))) AS j FROM placed
), long_runs AS (
    SELECT doc_id, i, j, array_to_string(l[i + 1:j + 1], chr(10)) AS run FROM runs WHERE length(array_to_string(l[i + 1:j + 1], chr(10))) >= 40
), windows AS (
    SELECT doc_id, i, min(j) AS j, arg_min(run, j) AS run FROM long_runs GROUP BY doc_id, i
    UNION SELECT doc_id, max(i) AS i, j, arg_max(run, i) AS run FROM long_runs GROUP BY doc_id, j
    UNION SELECT doc_id, i, i AS j, l[i + 1] AS run FROM placed WHERE length(l[i + 1]) >= 200
), ranked AS (
    SELECT doc_id, i, j, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS nth FROM windows
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS i FROM ranked WHERE nth > 1
), kept AS (
    SELECT doc_id, string_agg(l[i + 1], chr(10) ORDER BY i) AS text, count(*) AS n
    FROM placed WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = placed.doc_id AND gone.i = placed.i) GROUP BY doc_id
)
SELECT doc_id, CAST(length(coalesce(k.text, '')) AS BIGINT) AS n_chars, CAST(len(l.l) - coalesce(k.n, 0) AS BIGINT) AS removed_lines, coalesce(k.text, '') AS text
FROM lines l LEFT JOIN kept k USING (doc_id)
"""
