"""Operator 11, ranked lexical search: tiles of item vocabulary times tiles of document impacts, multiplied densely, with the best of each tile."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from issuetrail.llm.common import MOST, table, written

#: Sums of whole numbers up to this are exact in float64.
EXACT = 2**53
#: The greatest impact that a term can have in a document: its frequency's share of 1,000 is below 1.
FULL = 1_000_000

#: What bytes of UTF-8 become: A-Z lower case, ASCII that is no digit or letter a space; bytes of other characters stay.
TERM_BYTES = bytes(b if chr(b).isalnum() or b > 0x7F else 0x20 for b in bytes(range(256)).lower())


def term_counts(text: str | None) -> Counter:
    counts = Counter(text.encode().translate(TERM_BYTES).split(b" ")) if text else Counter()
    counts.pop(b"", None)
    return counts


def counted_documents(documents: DataFrame) -> DataFrame:
    """(doc_id, n, terms, counts): how many terms a text has, the different ones with spaces between, and how often each occurs (packed 32-bit integers)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [term_counts(text) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "n": [sum(counts.values()) for counts in found],
                    "terms": [b" ".join(counts).decode() for counts in found],
                    "counts": [np.fromiter(counts.values(), "<i4", len(counts)).tobytes() for counts in found],
                }
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(run, "doc_id long, n long, terms string, counts binary")


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, term, repeats) of each different term of each row; `item` numbers the rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [term_counts(text) for text in batch.pop("text")]
            batch = batch.astype({"item_id": "Int64"}).loc[batch.index.repeat([len(counts) for counts in found])]
            if len(batch):
                yield batch.assign(term=[t.decode() for counts in found for t in counts], repeats=[c for counts in found for c in counts.values()])

    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), "text")
    return rows.mapInPandas(run, "item long, item_id long, term string, repeats long")


class _Block:
    """Items with their weights, as dense tiles over runs of the vocabulary, and the best documents so far."""

    def __init__(self, items: np.ndarray, terms: list[str], weights: np.ndarray, k: int, tile_terms: int) -> None:
        self.k = k
        self.items, at = np.unique(items, return_inverse=True)
        self.vocabulary = {term: i for i, term in enumerate(sorted(set(terms)))}
        column = np.array([self.vocabulary[term] for term in terms])
        most = np.zeros(len(self.vocabulary), np.int64)
        np.maximum.at(most, column, weights)
        # a tile ends where its greatest sum could reach the bound; a term beyond it alone is a tile that is multiplied in whole numbers
        self.tiles: list[tuple[int, np.ndarray]] = []
        start = total = 0
        for end in range(1, len(most) + 1):
            total += int(most[end - 1])
            if end == len(most) or end - start == tile_terms or (total + int(most[end])) * FULL >= EXACT:
                inside = (column >= start) & (column < end)
                tile = np.zeros((len(self.items), end - start), np.float64 if total * FULL < EXACT else np.int64)
                tile[at[inside], column[inside] - start] = weights[inside]
                self.tiles.append((start, tile))
                start, total = end, 0
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(self.items)
        self.least = np.ones(len(self.items), np.int64)

    def scores(self, lengths: np.ndarray, terms: list[str], counts: list[bytes]) -> np.ndarray:
        """The scores of all items for a tile of documents; lengths: m of each."""
        listed = [t.split(" ") if t else [] for t in terms]
        column = np.fromiter((self.vocabulary.get(t, -1) for doc in listed for t in doc), np.int64)
        doc = np.repeat(np.arange(len(listed)), [len(doc) for doc in listed])
        tf = np.frombuffer(b"".join(counts), "<i4").astype(np.int64)
        known = column >= 0
        column, doc, tf = column[known], doc[known], tf[known]
        impact = 1_000_000_000 * tf // (1000 * tf + 12 * lengths[doc])
        found = np.zeros((len(self.items), len(listed)), np.int64)
        for start, tile in self.tiles:
            inside = (column >= start) & (column < start + tile.shape[1])
            # only terms that these documents hold
            held, row = np.unique(column[inside] - start, return_inverse=True)
            impacts = np.zeros((len(held), len(listed)), tile.dtype)
            impacts[row, doc[inside]] = impact[inside]
            found += (tile[:, held] @ impacts).astype(np.int64)
        return found

    def meet(self, ids: np.ndarray, scores: np.ndarray) -> None:
        """Keeps the best of what was kept and these documents, equal scores by ascending id."""
        for i in np.flatnonzero((scores >= self.least[:, None]).any(1)):
            at = np.flatnonzero(scores[i] >= self.least[i])
            kept, docs = self.best[i]
            kept, docs = np.concatenate([kept, scores[i, at]]), np.concatenate([docs, ids[at]])
            order = np.lexsort((docs, -kept))[: self.k]
            self.best[i] = kept[order], docs[order]
            if len(order) == self.k:
                # an equal score may still come in by a smaller id
                self.least[i] = kept[order[-1]]

    def found(self) -> pd.DataFrame:
        rows = [(int(item), int(d), int(s)) for item, (scores, docs) in zip(self.items, self.best, strict=True) for s, d in zip(scores, docs, strict=True)]
        return pd.DataFrame(rows, columns=["item", "doc_id", "score"])


def ranked(documents: DataFrame, items: DataFrame, k: int = 20, block_terms: int = 16_384, block_items: int = 256, tile_terms: int = 2048, tile_documents: int = 512, shard_terms: int = 1_000_000) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the highest scores above 0 for each item, equal scores by ascending doc_id (null last).

    A null or empty text has no terms and never comes up; an item without a term that a document holds has no rows. Every row is an item or a document of its
    own, also if it repeats another's id: its ranks or its place then come up again. Other columns are ignored; an empty table on either side gives no rows.

    Texts are counted once. Items with their weights make blocks of about `block_terms` different terms and `block_items` items, documents shards of about
    `shard_terms` terms by a hash. Each block meets each shard in one task, which holds the block and a tile of documents; of each such meeting the best k of an
    item leave the task, with ties decided as in the end, so what the last ranking sorts doesn't grow with a shard.
    """
    counted = written(counted_documents(documents))
    n_docs, n_terms = counted.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = counted.where("n > 0").select(F.explode(F.split("terms", " ")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long") * F.col("repeats")
    listed = written(written(item_terms(items)).join(held, "term").select("item", "item_id", "term", weight.alias("weight")))
    n_rows, n_items = listed.agg(F.count("*"), F.count_distinct("item")).first()
    blocks, shards = 1 + max(n_rows // block_terms, n_items // block_items), 1 + n_terms // shard_terms

    triple = F.struct("item", "term", "weight")
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    packed = listed.groupBy(block.alias("block")).agg(F.collect_list(triple).alias("t"))
    nothing = {"doc_id": "long", "n": "long", "terms": "string", "counts": "binary"}
    sides = [
        packed.select(
            "block",
            F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
            F.col("t.item").alias("items"),
            F.array_join("t.term", " ").alias("item_terms"),
            F.col("t.weight").alias("weights"),
            *[F.lit(None).cast(kind).alias(name) for name, kind in nothing.items()],
        ),
        counted.where("n > 0").select(
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
            F.pmod(F.xxhash64("doc_id", "terms"), F.lit(shards)).cast("int").alias("shard"),
            F.lit(None).cast("array<long>"),
            F.lit(None).cast("string"),
            F.lit(None).cast("array<long>"),
            *nothing,
        ),
    ]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = best = None
        for batch in batches:
            starts = np.flatnonzero((batch["block"] != batch["block"].shift()) | (batch["shard"] != batch["shard"].shift()))
            for start, stop in zip(starts, [*starts[1:], len(batch)], strict=True):
                rows = batch.iloc[start:stop]
                if (rows["block"].iat[0], rows["shard"].iat[0]) != key:
                    if best:
                        yield best.found()
                    key, best = (rows["block"].iat[0], rows["shard"].iat[0]), None
                    if rows["items"].iat[0] is not None:
                        first = rows.iloc[0]
                        best = _Block(np.asarray(first["items"]), first["item_terms"].split(" "), np.asarray(first["weights"], np.int64), k, tile_terms)
                        rows = rows.iloc[1:]
                for at in range(0, len(rows) if best else 0, tile_documents):
                    tile = rows.iloc[at : at + tile_documents]
                    lengths = 75 + 25 * tile["n"].to_numpy(np.int64) * n_docs // n_terms
                    ids = tile["doc_id"].astype("Int64").fillna(MOST).to_numpy(np.int64)
                    best.meet(ids, best.scores(lengths, tile["terms"].tolist(), tile["counts"].tolist()))
        if best:
            yield best.found()

    dealt = sides[0].union(sides[1]).repartition("block", "shard").sortWithinPartitions("block", "shard", F.col("items").isNull(), "doc_id")
    found = dealt.mapInPandas(run, "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = written(listed.select("item", "item_id").distinct())
    return top.join(names, "item").select("item_id", "rank", F.when(F.col("doc_id") != MOST, F.col("doc_id")).alias("doc_id"), "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH terms AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), counted AS (
    SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL
), sizes AS (
    SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY 1
), totals AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counted, totals GROUP BY term, docs
), asked AS (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scored AS (
    SELECT a.item_id, c.doc_id, CAST(sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 12 * (75 + (25 * s.n * t.docs) // t.terms)))) AS BIGINT) AS score
    FROM asked a JOIN counted c USING (term) JOIN weights w USING (term) JOIN sizes s ON s.doc_id = c.doc_id, totals t GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
