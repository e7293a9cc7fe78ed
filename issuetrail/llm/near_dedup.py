"""Operator 4, SimHash near-dedup: fingerprints of word shingles, compared bit-sliced in blocks, and groups of linked documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from issuetrail.llm.common import MOST, ascii_lower, checkpointed, table, written
from issuetrail.llm.components import components
from issuetrail.llm.fingerprints import hex_words, shingled, votes

FULL = np.uint64(2**64 - 1)


def fingerprints(documents: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, version, print): the 64-bit SimHash of each document's word shingles, each occurrence voting once."""
    # a repeated row votes twice for the same bits, which changes none
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), ascii_lower(F.coalesce("text", F.lit(""))).alias("text"))
    found = votes(shingled(rows, "text", words), ["doc_id", "version"], [F.xxhash64("term")])
    return found.select("doc_id", "version", F.col("word_0").alias("print"))


def _planes(prints: np.ndarray) -> np.ndarray:
    """The prints stored vertically: 64 rows of words, bit j of word w of a row being that bit of print 64 w + j."""
    n = len(prints)
    bits = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    whole = np.zeros((64, -(-n // 64) * 64 + 64), np.uint8)
    whole[:, :n] = bits.T
    return np.packbits(whole, axis=1, bitorder="little").view("<u8")


def _packed(flags: np.ndarray, words: int) -> np.ndarray:
    whole = np.zeros(words * 64, np.uint8)
    whole[: len(flags)] = flags
    return np.packbits(whole, bitorder="little").view("<u8")


def sliced_links(prints: np.ndarray, left: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows at most `radius` bits apart, for prints in order of their blocks; left: how many rows of its block follow each row.

    Row r is compared with row r + s for all rows at once, s = 1, 2, ...: the planes are shifted by s and each plane of differences is added to
    bitwise counters by carry-save addition, so a word counts 64 distances. Words whose 64 comparisons have all gone past the radius,
    or past the end of their block, are abandoned.
    """
    planes = _planes(prints)
    count = radius.bit_length()
    for s in range(1, int(left.max(initial=0)) + 1):
        live = left >= s
        past = ~_packed(live, planes.shape[1] - 1)
        at = np.flatnonzero(past != FULL)
        past = past[at]
        # counters start so high that a carry out of the last one means more than the radius
        offset = (1 << count) - 1 - radius
        counters = [np.full(len(at), FULL if offset >> i & 1 else 0, np.uint64) for i in range(count)]
        word, bit = divmod(s, 64)
        for first in range(0, 64, 4):
            if not len(at):
                break
            own = planes[first : first + 4, at]
            low = planes[first : first + 4][:, np.minimum(at + word, planes.shape[1] - 1)] >> np.uint64(bit)
            if bit:
                low |= planes[first : first + 4][:, np.minimum(at + word + 1, planes.shape[1] - 1)] << np.uint64(64 - bit)
            differ = own ^ low
            for a, b in ((0, 1), (2, 3)):
                x, y = differ[a], differ[b]
                if count:
                    carry = (counters[0] & (x ^ y)) | (x & y)
                    counters[0] = counters[0] ^ x ^ y
                else:
                    carry = x | y
                for i in range(1, count):
                    counters[i], carry = counters[i] ^ carry, counters[i] & carry
                past |= carry
            open_ = past != FULL
            if np.count_nonzero(open_) < 0.75 * len(at):
                at, past = at[open_], past[open_]
                counters = [c[open_] for c in counters]
        if len(at):
            near = np.unpackbits((~past).astype("<u8").view(np.uint8).reshape(len(at), 8), axis=1, bitorder="little")
            which, offsets = np.nonzero(near)
            rows = at[which] * 64 + offsets
            yield rows, rows + s


def _forest(prints: np.ndarray, nodes: np.ndarray, left: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join linked nodes within their blocks: a tree for each group, not all its pairs."""
    parent = np.arange(len(prints))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in sliced_links(prints, left, radius):
        apart = parent[a] != parent[b]
        for x, y in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        while not np.array_equal(parent[parent], parent):
            parent = parent[parent]
    joined = np.flatnonzero(parent != np.arange(len(parent)))
    return nodes[joined], nodes[parent[joined]]


def whole_runs(batches: Iterator[pd.DataFrame], key: str, least: int) -> Iterator[pd.DataFrame]:
    """The rows again, in pieces of `least` rows or more that end where the key changes."""
    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size < least:
            continue
        rows = pd.concat(held, ignore_index=True)
        last = rows[key].to_numpy()
        cut = int(np.flatnonzero(last != last[-1])[-1]) + 1 if last[0] != last[-1] else 0
        if cut:
            yield rows.iloc[:cut]
        held, size = [rows.iloc[cut:]], len(rows) - cut
    if size:
        yield pd.concat(held, ignore_index=True)


def _compare(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_runs(batches, "bucket", 8192):
            bucket = rows["bucket"].to_numpy()
            ends = np.append(np.flatnonzero(bucket[1:] != bucket[:-1]), len(bucket) - 1)
            left = ends[np.searchsorted(ends, np.arange(len(bucket)))] - np.arange(len(bucket))
            u, v = _forest(rows["print"].to_numpy().view(np.uint64), rows["node"].to_numpy(), left, radius)
            yield pd.DataFrame({"u": u, "v": v})

    return run


def _blocked(rows: DataFrame, width: int, radius: int) -> tuple[DataFrame, int]:
    """Each row once for each of radius + 1 blocks of the `width` bits in its rest, and the new rest's width.

    Two prints that differ in at most `radius` of these bits agree on one block. The block joins the bucket; what remains of the rest moves together.
    """
    cuts = [round(width * i / (radius + 1)) for i in range(radius + 2)]
    rest, tables = F.col("rest"), []
    for t in range(radius + 1):
        low, high = cuts[t], cuts[t + 1]
        block = F.shiftrightunsigned(rest, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        below = rest.bitwiseAND(F.lit((1 << low) - 1))
        above = F.shiftleft(F.shiftrightunsigned(rest, high), low) if high < 64 else F.lit(0).cast("long")
        tables.append(F.struct(F.xxhash64("bucket", F.lit(t), block).alias("bucket"), above.bitwiseOR(below).alias("rest")))
    exploded = rows.select(F.explode(F.array(*tables)).alias("_t"), "print", "node")
    narrowest = min(high - low for low, high in zip(cuts, cuts[1:], strict=False))
    return exploded.select("_t.bucket", "_t.rest", "print", "node"), width - narrowest


def print_links(prints: DataFrame, radius: int = 3, block_rows: int = 2048) -> DataFrame:
    """Edges (u, v) that join the nodes of prints at most `radius` bits apart, through any number of them; prints: distinct (print, node).

    Buckets agree on a quarter of the bits and on a quarter of the rest (for a radius of 3). Buckets of more than `block_rows` prints, as many near copies
    make them, are split once more in the same lossless way, until the bits are used up; then the count of different prints is
    bounded by the bits left. Within a bucket all prints are compared bit-sliced, and a tree of its links is kept.
    """
    rows, width = prints.select(F.lit(0).cast("long").alias("bucket"), F.col("print").alias("rest"), "print", "node"), 64
    for _ in range(2):
        rows, width = _blocked(rows, width, radius)
    edges = None
    while True:
        rows = checkpointed(rows) if edges is not None else rows
        sizes = written(rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"))
        met = written(rows.join(sizes, "bucket"))
        split = width > 16
        small = met.where(F.col("size") <= block_rows) if split else met
        compared = small.select("bucket", "print", "node").repartition("bucket").sortWithinPartitions("bucket", "print")
        found = compared.mapInPandas(_compare(radius), "u long, v long")
        edges = found if edges is None else edges.union(found)
        hot = met.where(F.col("size") > block_rows).select("bucket", "rest", "print", "node")
        if not split or hot.isEmpty():
            return edges
        rows, width = _blocked(hot, width, radius)


def _rooted(documents: DataFrame, words: int, radius: int) -> DataFrame:
    """(doc_id, version, print, root): root is the same for all documents that links join."""
    prints = checkpointed(fingerprints(documents, words))
    classes = checkpointed(prints.select("print", F.col("print").alias("node")).distinct())
    hung = components(print_links(classes, radius)).select(F.col("u").alias("print"), F.col("v").alias("root"))
    return prints.join(hung, "print", "left").withColumn("root", F.coalesce("root", "print"))


def near_groups(documents: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, print, component_id): the smallest doc_id that each document reaches over links of at most `radius` differing bits.

    Null and word-less texts have the fingerprint zero and are linked like any other. Equal rows count once; rows that share an id but not the
    text are both kept, with their own fingerprints. A null id is never the smallest; a group without any id has a null component_id. Other
    columns are ignored; an empty table gives no rows.
    """
    rooted = _rooted(documents, words, radius)
    least = written(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    return rooted.join(least, "root").select("doc_id", "print", "component_id")


def deduplicate(documents: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """The rows of one document of each group: that of the smallest id, rows without an id last; of several texts under that id the one of the
    least hash. Equal rows of it are kept once. All columns are kept, whatever their names.
    """
    order = F.struct(F.coalesce("doc_id", F.lit(MOST)).alias("node"), "version")
    heads = _rooted(documents, words, radius).groupBy("root").agg(F.min(order).alias("head"))
    node, version = "_simhash_node", "_simhash_version"
    tagged = documents.withColumn(node, F.coalesce(F.col("doc_id").cast("long"), F.lit(MOST))).withColumn(version, F.xxhash64("text"))
    kept = tagged.join(heads.select(F.col("head.node").alias(node), F.col("head.version").alias(version)), [node, version], "left_semi")
    # the join has placed and sorted equal rows together
    return kept.dropDuplicates([node, version]).select(*documents.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", hex_words(F.col("print")).alias("fingerprint"), "component_id")
