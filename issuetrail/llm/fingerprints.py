"""Operator 1, document fingerprints: SimHash votes over weighted terms, and permuted block tables for near fingerprints.

A fingerprint is one or more 64-bit words. Everything here is column expressions and joins.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from issuetrail.llm.common import LEAST, ascii_lower, checkpointed, table, words, written

#: Two counters of 32 bits in one long: bits i and i + 32 of a hash are counted by one sum.
_PAIR = (1 << 32) | 1
_LOW = (1 << 32) - 1


def shingled(rows: DataFrame, text: str, size: int) -> DataFrame:
    """One row for each run of `size` words, as column `term`; a text of fewer words gives all of them as one, one without words a null."""
    listed = rows.withColumn("_words", words(F.col(text))).drop(text)
    last = F.greatest(F.size("_words") - size, F.lit(0))
    starts = F.when(F.size("_words") > 0, F.sequence(F.lit(0), last))
    each = listed.select("*", F.explode_outer(starts).alias("_at"))
    # try_element_at gives null past the end, and concat_ws leaves nulls out
    parts = [F.try_element_at("_words", F.col("_at") + (i + 1)) for i in range(size)]
    return each.withColumn("term", F.when(F.col("_at").isNotNull(), F.concat_ws(" ", *parts))).drop("_words", "_at")


def votes(terms: DataFrame, keys: list[str], hashes: list[Column], weight: Column | None = None) -> DataFrame:
    """SimHash of each key: (keys, word_0, word_1, ...), one word for each column of hashes.

    Each term's hash votes with its weight, a positive integer, for a bit that it has and against one that it lacks; a bit of the fingerprint is
    1 if it has over half the weight. Null terms don't vote; a key without votes gets zero words. A key that occurs twice with the
    same terms has the same fingerprint as if it occurred once. Sums combine before the shuffle: a row for each key and task.
    """
    weight = F.lit(1).cast("long") if weight is None else weight.cast("long")
    prepared = terms.select(*keys, F.when(F.col("term").isNotNull(), weight).alias("_w"), *[h.alias(f"_h{i}") for i, h in enumerate(hashes)])
    sums = [
        F.sum(F.shiftrightunsigned(f"_h{i}", bit).bitwiseAND(F.lit(_PAIR)) * F.col("_w")).alias(f"_s{i}_{bit}")
        for i in range(len(hashes))
        for bit in range(32)
    ]
    counted = prepared.groupBy(*keys).agg(F.coalesce(F.sum("_w"), F.lit(0)).alias("_all"), *sums)

    def word(i: int) -> Column:
        bits = []
        for bit in range(64):
            both = F.coalesce(F.col(f"_s{i}_{bit % 32}"), F.lit(0))
            count = F.shiftrightunsigned(both, 32) if bit >= 32 else both.bitwiseAND(F.lit(_LOW))
            value = 1 << bit if bit < 63 else LEAST
            bits.append(F.when(count * 2 > F.col("_all"), F.lit(value)).otherwise(F.lit(0).cast("long")))
        return reduce(Column.bitwiseOR, bits)

    return counted.select(*keys, *[word(i).alias(f"word_{i}") for i in range(len(hashes))])


def hex_words(*parts: Column) -> Column:
    return F.concat(*[F.lower(F.lpad(F.hex(part), 16, "0")) for part in parts])


def distance(left: list[Column], right: list[Column]) -> Column:
    """Bits in which two fingerprints differ."""
    return reduce(Column.__add__, [F.bit_count(a.bitwiseXOR(b)) for a, b in zip(left, right, strict=True)])


def likeness(left: list[Column], right: list[Column]) -> Column:
    """Estimate of the cosine of the two weighted term vectors, from 0 to 1: bits differ in proportion to the angle."""
    angle = distance(left, right) * F.lit(math.pi / (64 * len(left)))
    return F.greatest(F.lit(0.0), F.cos(angle))


def near_pairs(prints: DataFrame, names: list[str], radius: int) -> DataFrame:
    """All pairs of different fingerprints that differ in at most `radius` bits: (a_<name>, b_<name>, distance), a before b.

    prints: distinct fingerprints in the long columns `names`. The bits are cut into radius + 2 blocks of which at least two agree, so each
    pair of blocks is a permuted table: its rows meet on both blocks, and their distance is then counted. A pair that meets in
    several tables is kept by the first of them.
    """
    total = 64 * len(names)
    cuts = [round(total * i / (radius + 2)) for i in range(radius + 3)]

    def block(prefix: str, b: int) -> list[Column]:
        """The block's bits as masked words."""
        found = []
        for w, name in enumerate(names):
            mask = sum(1 << bit for bit in range(64) if cuts[b] <= 64 * w + bit < cuts[b + 1])
            if mask:
                found.append(F.col(prefix + name).bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)))
        return found

    tables = list(combinations(range(radius + 2), 2))
    keyed = prints.select(
        *names,
        F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.xxhash64(F.lit(t), *block("", a), *block("", b)).alias("key")) for t, (a, b) in enumerate(tables)])).alias("_k"),
    ).select("_k.t", "_k.key", *names)
    left = keyed.select("t", "key", *[F.col(n).alias(f"a_{n}") for n in names])
    right = keyed.select("t", "key", *[F.col(n).alias(f"b_{n}") for n in names])
    agree = [reduce(Column.__and__, [x == y for x, y in zip(block("a_", b), block("b_", b), strict=True)]) for b in range(radius + 2)]
    first = F.coalesce(*[F.when(agree[a] & agree[b], F.lit(t)) for t, (a, b) in enumerate(tables)])
    apart = distance([F.col(f"a_{n}") for n in names], [F.col(f"b_{n}") for n in names])
    before = F.struct(*[f"a_{n}" for n in names]) < F.struct(*[f"b_{n}" for n in names])
    met = left.join(right, ["t", "key"]).where(before & (apart <= radius) & (first == F.col("t")))
    return met.select(*[f"a_{n}" for n in names], *[f"b_{n}" for n in names], apart.alias("distance"))


def following(keys: DataFrame) -> DataFrame:
    """(k, v) -> (k, v, next_k, next_v): the next row by descending k, after the last the first. Each k is there once and not null.

    Keys are dealt out by ranges; within a range the next row is the one below, and the last of a range takes the head of the following one.
    """
    ranged = checkpointed(keys.repartitionByRange(F.desc("k")).withColumn("part", F.spark_partition_id()))
    heads = ranged.groupBy("part").agg(F.max(F.struct("k", "v")).alias("head"))
    # a row for each range, not for each key
    order = Window.orderBy(F.desc("head.k"))
    top = F.first("head").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("part", F.coalesce(F.lead("head").over(order), top).alias("after"))
    below = F.lead(F.struct("k", "v")).over(Window.partitionBy("part").orderBy(F.desc("k")))
    found = ranged.withColumn("below", below).join(heads, "part").withColumn("next", F.coalesce("below", "after"))
    return found.select("k", "v", F.col("next.k").alias("next_k"), F.col("next.v").alias("next_v"))


def fingerprint_texts(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """128-bit fingerprints (keys, word_0, word_1) of the texts: pairs of words vote, weighted by their length and frequency."""
    terms = shingled(rows.withColumn(text, ascii_lower(F.col(text))), text, 2)
    hashes = [F.xxhash64("term"), F.xxhash64("term", F.lit(1))]
    return votes(terms, keys, hashes, F.char_length("term"))


def fingerprint_edits(documents: DataFrame, radius: int = 3) -> DataFrame:
    """Fingerprints of documents (doc_id, text), of their edited texts, and how alike these and the neighbours are.

    The edited text has the last floor(n/2) code points replaced by the first as many (or all) of the next document by descending id.
    `near_texts` counts the other fingerprints of documents within `radius` bits. A null text is empty. Each row has its result, also rows that share an id; as the
    next document of another, the longest text of an id stands (among these, the one of the greatest hash). Rows without an id come last and
    count as one id in this. Other columns are ignored; an empty table gives no rows.
    """
    docs = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("k"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumns({"n": F.char_length("text").cast("long"), "h": F.xxhash64("text")})
    rows = checkpointed(docs.groupBy("k", "n", "h").agg(F.count("*").alias("times")))
    chosen = following(rows.groupBy("k").agg(F.max(F.struct("n", "h")).alias("v")))
    chosen = written(chosen.select("k", "next_k", F.col("next_v.h").alias("next_h")))
    # The texts are shuffled once: both joins ask for the same exchange, of which a hot key can be split.
    placed = docs.drop("n")
    wants = written(rows.join(chosen, "k").select(F.col("next_k").alias("k"), F.col("next_h").alias("h"), F.col("k").alias("to_k"), F.col("h").alias("to_h"), F.floor(F.col("n") / 2).cast("int").alias("half")))
    # a text is there once for each of its rows
    heads = placed.join(wants, ["k", "h"]).groupBy(F.col("to_k").alias("k"), F.col("to_h").alias("h")).agg(F.max(F.expr("left(text, half)")).alias("head"))
    n = F.char_length("text")
    kept = F.expr("left(text, char_length(text) - char_length(text) div 2)")
    both = placed.join(heads, ["k", "h"]).select("k", "h", n.cast("long").alias("n"), "text", F.concat(kept, "head").alias("edited"))
    both = both.withColumn("sha", F.sha2(F.col("edited").cast("binary"), 256))
    sides = both.select("k", "h", "n", "sha", F.posexplode(F.array("text", "edited")).alias("side", "text"))
    # the join has dealt texts out by k and h, so these sums need no shuffle
    prints = fingerprint_texts(sides, ["k", "h", "n", "sha", "side"])
    prints = prints.groupBy("k", "h", "n", "sha").agg(
        *[F.max(F.when(F.col("side") == side, F.col(f"word_{i}"))).alias(f"{name}_{i}") for side, name in enumerate(("own", "edited")) for i in (0, 1)]
    )
    prints = checkpointed(prints)
    pair = lambda name: [F.col(f"{name}_{i}") for i in (0, 1)]
    after = prints.select(F.col("k").alias("next_k"), F.col("h").alias("next_h"), F.col("own_0").alias("next_0"), F.col("own_1").alias("next_1"))
    after = written(chosen.join(after, ["next_k", "next_h"]).select("k", "next_0", "next_1"))
    near = near_pairs(prints.select("own_0", "own_1").distinct(), ["own_0", "own_1"], radius)
    ends = [near.select(F.col(f"{x}_own_0").alias("own_0"), F.col(f"{x}_own_1").alias("own_1")) for x in "ab"]
    links = written(ends[0].union(ends[1]).groupBy("own_0", "own_1").agg(F.count("*").alias("near")))
    found = prints.join(after, "k").join(rows.select("k", "h", "times"), ["k", "h"]).join(links, ["own_0", "own_1"], "left")
    found = found.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    return found.select(
        F.when(F.col("k") != LEAST, F.col("k")).alias("doc_id"),
        F.col("n").alias("n_chars"),
        F.col("sha").alias("edited_sha256"),
        hex_words(*pair("own")).alias("fingerprint"),
        hex_words(*pair("edited")).alias("edited_fingerprint"),
        likeness(pair("own"), pair("edited")).alias("near_edited"),
        likeness(pair("own"), pair("next")).alias("near_next"),
        F.coalesce("near", F.lit(0)).cast("long").alias("near_texts"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))
