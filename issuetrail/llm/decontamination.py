"""Operator 9, benchmark decontamination: documents that hold a passage of a benchmark, up to a share of edits.

CGK random walks turn edit distance into Hamming distance; bits sampled from the walks are hashed, several times over, so that windows of a
part's size that are near the part meet it under some key with the target recall. Parts are bounded, since walks drift further apart with each
edit: of an item's parts one has no more than its share of the edits. What meets is verified by the exact edit distance of the whole item.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from issuetrail.llm.common import MOST, pieces, table, written

#: Bytes of a seed at most.
SEED = 16
#: Bytes of a part of an item at most: the walks of longer ones drift too far apart.
PART = 200
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BITS = 22
#: A-Z in lower case, white space as one kind of character.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 32


def folded(text: str) -> np.ndarray:
    return _FOLD[np.frombuffer(text.encode(), np.uint8)]


def seed_size(sizes: Iterable[int], share: float) -> int:
    """Bytes of a seed, so that every item keeps one: k edits cut its n bytes into k + 1 runs, of which one has a (k + 1)th of the other n - k bytes."""
    return min([SEED, *(max(1, -(-(n - int(share * n)) // (int(share * n) + 1))) for n in sizes)])


def parts_of(size: int) -> list[tuple[int, int]]:
    """(start, stop) of the parts of an item, as equal as can be: k edits within a share of the item leave one with no more than that share of its own size."""
    n = -(-size // PART)
    return [(size * i // n, size * (i + 1) // n) for i in range(n)]


def seeds(data: np.ndarray, size: int = SEED) -> np.ndarray:
    """A hash of the `size` bytes, at most SEED, at each place."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    padded = np.zeros(-(-len(data) // 8) * 8 + 16, np.uint8)
    padded[: len(data)] = data
    eight = np.empty(len(padded) - 8, np.uint64)
    for k in range(8):
        part = padded[k : k + (len(eight) - k + 7) // 8 * 8].view("<u8")
        eight[k::8] = part
    # the first eight and the last eight, which overlap in a smaller seed
    first, last = eight[:n], eight[max(0, size - 8) : max(0, size - 8) + n]
    if size < 8:
        first = last = first & np.uint64((1 << 8 * size) - 1)
    mixed = (first * _A) ^ ((last * _B) >> np.uint64(3))
    mixed ^= mixed >> np.uint64(31)
    return mixed * _B


def walk_keys(texts: np.ndarray, sizes: np.ndarray, walks: np.ndarray, samples: np.ndarray) -> np.ndarray:
    """LSH keys (texts x repetitions) of rows of bytes, zero after each one's size.

    In a CGK walk of 3 n steps, each step writes the character at the cursor, and a coin for the step and character (walks) says whether the cursor moves
    on. A repetition's key hashes what its walk wrote at the sampled steps, given as shares of the whole walk.
    """
    rows = np.arange(len(texts))
    keys = np.empty((len(texts), len(walks)), np.uint64)
    steps = 3 * sizes
    for r, (coins, shares) in enumerate(zip(walks, samples, strict=True)):
        wanted = np.floor(shares[None, :] * steps[:, None]).astype(np.int64)
        written = np.zeros(wanted.shape, np.uint8)
        cursor = np.zeros(len(texts), np.int64)
        for j in range(int(wanted.max(initial=-1)) + 1):
            c = texts[rows, np.minimum(cursor, texts.shape[1] - 1)]
            hit = wanted == j
            if hit.any():
                written[hit] = np.broadcast_to(c[:, None], written.shape)[hit]
            cursor = cursor + coins[j % len(coins), c]
        key = np.full(len(texts), r + 1, np.uint64) * _B
        for s in range(written.shape[1]):
            key = (key ^ written[:, s]) * _A
            key ^= key >> np.uint64(29)
        keys[:, r] = key
    return keys


def holds(item: bytes, region: bytes, edits: int) -> bool:
    """Some substring of the region is at most so many edits (insertions, deletions, substitutions) from the item: bit-parallel columns."""
    if item in region:
        return True
    places: dict[int, int] = {}
    for i, c in enumerate(item):
        places[c] = places.get(c, 0) | 1 << i
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    up, down, score = full, 0, len(item)
    for c in region:
        eq = places.get(c, 0)
        x = eq | down
        d0 = (((x & up) + up) ^ up) | x
        right = down | (full & ~(d0 | up))
        left = d0 & up
        score += bool(right & top) - bool(left & top)
        if score <= edits:
            return True
        right = (right << 1) & full
        left = (left << 1) & full
        up = left | (full & ~(d0 | right))
        down = right & d0
    return False


class Block:
    """A bounded number of benchmark items, ready to be met."""

    def __init__(self, items: list[tuple[int, str]], share: float, recall: float, bits: int = 4) -> None:
        self.ids = [i for i, _ in items]
        self.texts = [folded(t) for _, t in items]
        self.share = share
        self.sizes = np.array([len(t) for t in self.texts])
        # items too short for an edit within the share
        self.short = [k for k, t in enumerate(self.texts) if int(share * len(t)) < 1]
        # (item, start, stop)
        self.parts = [(k, start, stop) for k, t in enumerate(self.texts) if int(share * len(t)) >= 1 for start, stop in parts_of(len(t))]
        self.part_sizes = np.array([stop - start for _, start, stop in self.parts], np.int64)
        self.seed = seed_size(self.part_sizes.tolist(), share)
        found = [(s, p, at) for p, (k, start, stop) in enumerate(self.parts) for at, s in enumerate(seeds(self.texts[k][start:stop], self.seed).tolist())]
        found.sort()
        self.seeds = np.array([f[0] for f in found], np.uint64)
        self.part = np.array([f[1] for f in found], np.int64)
        self.at = np.array([f[2] for f in found], np.int64)
        self.marks = np.zeros(1 << _BITS, bool)
        self.marks[(self.seeds >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        # After an edit the walks of two texts run apart for a while; with a share of k / n edits, steps differ at up to 6 k / n of the places.
        agree = max(0.05, 1 - 6 * share) ** bits
        repeats = max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))
        coins = np.random.default_rng(20240501)
        self.walks = coins.integers(0, 2, (repeats, 4096, 256), dtype=np.int64).astype(np.int8)
        self.samples = np.sort(coins.random((repeats, bits)) * 0.9, axis=1)
        self.table: dict[int, list[int]] = {}
        for some in range(0, len(self.parts), 4096):
            rows = self.keys([self.texts[k][start:stop] for k, start, stop in self.parts[some : some + 4096]]).tolist()
            for p, row in enumerate(rows, some):
                for key in row:
                    self.table.setdefault(key, []).append(p)

    def keys(self, texts: list[np.ndarray]) -> np.ndarray:
        width = max(map(len, texts))
        rows = np.zeros((len(texts), width + 1), np.uint8)
        for i, t in enumerate(texts):
            rows[i, : len(t)] = t
        return walk_keys(rows, np.array([len(t) for t in texts]), self.walks, self.samples)

    def met_by(self, texts: list[str]) -> list[set[int]]:
        """The items that each text holds."""
        found: list[set[int]] = [set() for _ in texts]
        parts = [t.encode() + b"\0" for t in texts]
        ends = np.cumsum([len(p) for p in parts])
        data = _FOLD[np.frombuffer(b"".join(parts), np.uint8)]
        for k in self.short:
            if len(self.texts[k]):
                for doc, (start, end) in enumerate(zip(ends - [len(p) for p in parts], ends, strict=True)):
                    if self.texts[k].tobytes() in data[start : end - 1].tobytes():
                        found[doc].add(self.ids[k])
        if not len(self.seeds):
            return found
        codes = seeds(data, self.seed)
        places = np.flatnonzero(self.marks[(codes >> np.uint64(64 - _BITS)).astype(np.int64)])
        codes = codes[places]
        low, high = np.searchsorted(self.seeds, codes, "left"), np.searchsorted(self.seeds, codes, "right")
        times = high - low
        places, low, times = places[times > 0], low[times > 0], times[times > 0]
        which = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        places = np.repeat(places, times)
        doc = np.searchsorted(ends, places, "right")
        first = np.append(0, ends[:-1])
        start = np.maximum(places - self.at[which], first[doc])
        size = self.part_sizes[self.part[which]]
        # each window once: its start and its size
        windows = np.unique(np.stack([start, size, doc], axis=1), axis=0) if len(start) else np.zeros((0, 3), np.int64)
        failed: set[tuple[int, int, int, int]] = set()
        for some in range(0, len(windows), 4096):
            part = windows[some : some + 4096]
            stops = np.minimum(part[:, 0] + part[:, 1], ends[part[:, 2]] - 1)
            keys = self.keys([data[a:b] for a, b in zip(part[:, 0], stops, strict=True)])
            for (begin, length, d), row in zip(part.tolist(), keys.tolist(), strict=True):
                for p in {p for key in row for p in self.table.get(key, ())}:
                    k, before, stop = self.parts[p]
                    if self.ids[k] in found[d]:
                        continue
                    size, floor, top = stop - before, int(first[d]), int(ends[d]) - 1
                    # the part first, which is short, and then the whole item around it
                    if size < self.sizes[k]:
                        edits = int(self.share * size)
                        near = data[max(begin - edits, floor) : min(begin + max(length, size) + edits, top)]
                        if not holds(self.texts[k][before:stop].tobytes(), near.tobytes(), edits):
                            continue
                    edits = int(self.share * self.sizes[k])
                    rest = max(length, size) + int(self.sizes[k]) - stop
                    begins, stops_ = max(begin - before - edits, floor), min(begin + rest + edits, top)
                    if (k, d, begins, stops_) in failed:
                        continue
                    if holds(self.texts[k].tobytes(), data[begins:stops_].tobytes(), edits):
                        found[d].add(self.ids[k])
                    else:
                        failed.add((k, d, begins, stops_))
        return found


def contaminated(documents: DataFrame, benchmark: DataFrame, share: float = 0.05, recall: float = 0.99, block_chars: int = 1_000_000) -> DataFrame:
    """The documents' rows and columns with `benchmark_items`: the sorted ids of the items (item_id, text) that each text holds.

    A text holds an item if a substring of it is at most `share` of the item's bytes away in edits, letter case (A-Z) and kinds of white space aside. Items are cut
    into parts of up to PART bytes, and windows of a part's size are looked at wherever a seed of it stands; the sampled walks then find those near
    a part with the given recall, at any length of the item, and an exact check of the whole item settles each. Items so short that the share leaves no edit (under 20 bytes at 0.05) must occur exactly; those of a null or empty
    text never do; one without an item_id counts, as a null among the ids. A null text holds none. Items are sent out in blocks of `block_chars`, one pass over the
    documents for each block; two blocks at most are in the driver's memory. Repeated items and rows do no harm; a column `benchmark_items` is replaced; empty tables give no rows, or no items.
    """
    items = benchmark.where("text is not null and text <> ''").select(F.coalesce(F.col("item_id").cast("long"), F.lit(MOST)).alias("item_id"), "text").distinct()
    blocks = _blocks(items, block_chars)
    first, second = next(blocks, []), next(blocks, None)
    kept = [c for c in documents.columns if c != "benchmark_items"]
    text = F.coalesce("text", F.lit(""))
    named = lambda ids: F.transform(ids, lambda i: F.when(i != MOST, i)).alias("benchmark_items")
    if second is None:
        met = documents.select(*kept, _meeting(documents, first, share, recall)(text).alias("_cgk_items"))
        return met.select(*kept, named(F.col("_cgk_items")))
    # each block in tasks of its own, which hold no other; only hits are joined
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit(MOST)).alias("_cgk_node"), F.xxhash64("text").alias("_cgk_version")]
    hits = [written(documents.select(*key, F.explode(_meeting(documents, block, share, recall)(text)).alias("_cgk_item"))) for block in chain([first, second], blocks)]
    names = ["_cgk_node", "_cgk_version"]
    found = written(reduce(DataFrame.union, hits).groupBy(*names).agg(F.array_sort(F.collect_set("_cgk_item")).alias("_cgk_items")))
    tagged = documents.select("*", *key).join(found, names, "left")
    return tagged.select(*kept, named(F.coalesce("_cgk_items", F.array().cast("array<bigint>"))))


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    block: list[tuple[int, str]] = []
    held = 0
    for item_id, text in items.orderBy("item_id", "text").toLocalIterator():
        if block and held + len(text) > block_chars:
            yield block
            block, held = [], 0
        block.append((item_id, text))
        held += len(text)
    if block:
        yield block


def _meeting(documents: DataFrame, block: list[tuple[int, str]], share: float, recall: float):
    sent = documents.sparkSession.sparkContext.broadcast(block)

    @F.pandas_udf("array<long>")
    def items_met(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ready = Block(sent.value, share, recall)
        for piece in pieces((pd.DataFrame({"text": part}) for part in texts), 4_000_000):
            yield pd.Series([sorted(ids) for ids in ready.met_by(piece["text"].tolist())], dtype=object)

    return items_met


def decontaminate(documents: DataFrame, benchmark: DataFrame, share: float = 0.05) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    clean = contaminated(documents, benchmark, share).where(F.size("benchmark_items") == 0)
    return clean.select(*documents.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contaminated(documents, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("benchmark_items") > 0).alias("contaminated"), "benchmark_items")
