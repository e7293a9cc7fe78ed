"""Operator 13, exact top-k search: vectors keyed by their nearest pivot and their distance from it, searched ring by ring."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from issuetrail.llm.common import folder, table, written

#: Sums of integers below this are exact in float64, in whatever order they are added.
EXACT = float(2**53)
FIELDS = "row long, vec_id long, dim int, pivot int, r double, norm double, v binary"


def _packed(vector: np.ndarray) -> bytes:
    """Whole numbers as 16-bit integers where they fit, else as float64, which holds them as they are."""
    return (vector.astype("<i2") if np.abs(vector).max(initial=0) < 2**15 else vector.astype("<f8")).tobytes()


def _unpacked(packed: list[bytes], dim: int) -> np.ndarray:
    kinds = np.fromiter((len(p) == 2 * dim for p in packed), bool, len(packed))
    found = np.empty((len(packed), dim))
    for short, kind in ((True, "<i2"), (False, "<f8")):
        at = np.flatnonzero(kinds == short)
        found[at] = np.frombuffer(b"".join(packed[i] for i in at), kind).reshape(len(at), dim)
    return found


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows with all others. Where a partial sum might not be exact in float64, in whole numbers of any size, ended at 64 bits."""
    norms = [np.sqrt((side**2).sum(1)).max(initial=0) for side in (left, right)]
    if norms[0] * norms[1] < EXACT:
        return (left @ right.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in side], object).reshape(side.shape) for side in (left, right)]
    found = [[min(max(sum(a * b for a, b in zip(x, y, strict=True)), -(2**63)), 2**63 - 1) for y in whole[1]] for x in whole[0]]
    return np.array(found, np.int64).reshape(len(left), len(right))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Of the sample, vectors that lie far from each other: each is the one farthest from those before."""
    chosen = [0] if len(sample) else []
    gap = np.full(len(sample), np.inf)
    while chosen and len(chosen) < min(count, len(sample)):
        with np.errstate(over="ignore"):
            gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(1))
        if not gap.max() > 0:
            break
        chosen.append(int(gap.argmax()))
    return sample[chosen]


def whole_numbers(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part: neither null nor with a null or non-finite component."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return embeddings.where(F.col("embedding").isNotNull() & finite).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (vectors**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * (vectors @ pivots.T)
    return np.sqrt(np.maximum(squares, 0))


def fit_pivots(vectors: DataFrame, count: int, sample: int) -> dict[int, np.ndarray]:
    """Pivots for each length of vectors, of the `sample` vectors that come first by a hash; a length that isn't in the sample gets the null vector as its pivot."""
    first = vectors.orderBy(F.xxhash64("embedding", "vec_id")).limit(sample).toPandas()["embedding"]
    by_dim: dict[int, list] = {}
    for vector in first:
        by_dim.setdefault(len(vector), []).append(np.floor(256 * np.asarray(vector)))
    return {dim: choose_pivots(np.stack(found), count) for dim, found in by_dim.items()}


def build_index(vectors: DataFrame, pivots: dict[int, np.ndarray], shelf_numbers: int) -> DataFrame:
    """A written table of all vectors (FIELDS, shelf): shelves hold vectors of one length and nearest pivot, next to each other by their distance from it.

    A shelf has about `shelf_numbers` components at most. Ties of distance, as of equal vectors, are cut apart too.
    """

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            dims = batch["embedding"].str.len().to_numpy()
            for dim in np.unique(dims):
                rows = batch[dims == dim]
                numbers = np.floor(256 * np.stack(rows["embedding"].to_list()))
                near = distances(numbers, pivots.get(dim, np.zeros((1, dim))))
                yield pd.DataFrame(
                    {
                        "vec_id": rows["vec_id"].astype("Int64"),
                        "dim": np.full(len(rows), dim, np.int32),
                        "pivot": near.argmin(1).astype(np.int32),
                        "r": near.min(1),
                        "norm": np.sqrt((numbers**2).sum(1)),
                        "v": [_packed(x) for x in numbers],
                    }
                )

    path = folder(vectors.sparkSession)
    numbers = vectors.agg(F.sum(F.size("embedding").cast("long"))).first()[0] or 0
    keyed = vectors.mapInPandas(assign, FIELDS.removeprefix("row long, "))
    keys = ["dim", "pivot", "r", "vec_id"]
    dealt = keyed.repartitionByRange(1 + numbers // shelf_numbers, *keys).sortWithinPartitions(*keys)
    shelf = F.concat_ws("/", F.spark_partition_id(), "dim", "pivot")
    dealt.select(F.monotonically_increasing_id().alias("row"), *keyed.columns, shelf.alias("shelf")).write.parquet(path)
    return vectors.sparkSession.read.schema(FIELDS + ", shelf string").parquet(path)


class _Shelf:
    """The vectors of a shelf in rings of neighbouring distances from its pivot, and the search through them."""

    def __init__(self, rows: pd.DataFrame, k: int, ring: int) -> None:
        self.k, self.ring, self.dim = k, ring, int(rows["dim"].iat[0])
        self.rows, self.ids = rows["row"].to_numpy(), rows["vec_id"].astype("Int64")
        # a null id comes after all others
        self.order = self.ids.fillna(2**63 - 1).to_numpy(np.int64)
        self.vectors = _unpacked(rows["v"].tolist(), self.dim)
        at = np.arange(0, len(rows), ring)
        r, norm = rows["key"].to_numpy(), rows["norm"].to_numpy()
        self.low, self.high = r[at], r[np.minimum(at + ring, len(rows)) - 1]
        self.norm = np.maximum.reduceat(norm, at)

    def bounds(self, norm: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """For each query and ring the greatest inner product that there can be.

        2 qx = |q|^2 + |x|^2 - |q - x|^2, and by the triangle inequality |q - x| is at least the gap between their distances from the pivot. Some room is for rounding.
        """
        gap = np.maximum(0, np.maximum(distance[:, None] - self.high, self.low - distance[:, None]))
        squares = (norm**2)[:, None] + self.norm**2
        # squares of numbers past 10^154 overflow; such a ring is never passed over
        return np.nan_to_num((squares - gap**2) / 2 + squares * 1e-9 + 1, nan=np.inf)

    def search(self, queries: pd.DataFrame) -> Iterator[tuple]:
        """(row, query_id, vec_id, score, found) of the best of the shelf for each query: rings in order of what they can hold, until no query can gain from the rest."""
        wanted = _unpacked(queries["v"].tolist(), self.dim)
        own = queries["row"].to_numpy()
        bound = self.bounds(queries["norm"].to_numpy(), queries["key"].to_numpy())
        least = queries["least"].fillna(-(2**63)).to_numpy(np.int64)
        best: list[list[tuple]] = [[] for _ in own]
        order = np.argsort(-bound.max(0))
        for step, i in enumerate(order):
            if (bound[:, order[step:]].max(1) < least).all():
                break
            open_ = np.flatnonzero(bound[:, i] >= least)
            if not len(open_):
                continue
            first = i * self.ring
            scores = products(wanted[open_], self.vectors[first : first + self.ring])
            for q, row in zip(open_[scores.max(1) >= least[open_]], scores[scores.max(1) >= least[open_]], strict=True):
                at = np.flatnonzero(row >= least[q])
                at = at[self.rows[first + at] != own[q]]
                if len(at) > self.k:
                    at = at[np.lexsort((self.order[first + at], -row[at]))[: self.k]]
                best[q] = sorted([*best[q], *((-int(row[j]), int(self.order[first + j]), first + int(j)) for j in at)])[: self.k]
                if len(best[q]) == self.k:
                    least[q] = max(least[q], -best[q][-1][0])
        for q, found in enumerate(best):
            for score, _, j in found:
                yield int(own[q]), queries["vec_id"].iat[q], self.ids.iat[j], -score, int(self.rows[j])


def search(index: DataFrame, wanted: DataFrame, k: int, ring: int, together: int = 256) -> DataFrame:
    """(row, query_id, vec_id, score, found): the best `k` of each shelf for each query that wants it; wanted: FIELDS, shelf, distance (from the shelf's pivot), least (score).

    A task holds one shelf and `together` queries at a time.
    """
    columns = ["row", "query_id", "vec_id", "score", "found"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, held, shelf = None, [], None
        for batch in batches:
            starts = np.flatnonzero((batch["shelf"] != batch["shelf"].shift()) | (batch["kind"] != batch["kind"].shift()))
            for start, stop in zip(starts, [*starts[1:], len(batch)], strict=True):
                rows = batch.iloc[start:stop]
                if rows["shelf"].iat[0] != name:
                    name, held, shelf = rows["shelf"].iat[0], [], None
                if rows["kind"].iat[0] == 0:
                    held.append(rows)
                    continue
                if shelf is None:
                    shelf, held = _Shelf(pd.concat(held, ignore_index=True), k, ring), []
                for first in range(0, len(rows), together):
                    found = pd.DataFrame(list(shelf.search(rows.iloc[first : first + together])), columns=columns)
                    yield found.astype({"query_id": "Int64", "vec_id": "Int64", "row": "int64", "score": "int64", "found": "int64"})

    own = index.select("shelf", F.lit(0).alias("kind"), F.col("r").alias("key"), "row", "vec_id", "dim", "norm", "v", F.lit(None).cast("long").alias("least"))
    asked = wanted.select("shelf", F.lit(1), "distance", "row", "vec_id", "dim", "norm", "v", "least")
    dealt = own.union(asked).repartition("shelf").sortWithinPartitions("shelf", "kind", "key", "row")
    return dealt.mapInPandas(run, "row long, query_id long, vec_id long, score long, found long")


def top_k(embeddings: DataFrame, k: int = 5, every: int = 50, pivots: int = 32, sample: int = 1024, shelf_numbers: int = 1 << 20, ring: int = 512) -> DataFrame:
    """(query_id, rank, vec_id, score): the k greatest integer inner products of floor(256 x) of each vector whose vec_id is divisible by `every` with all others.

    Ties go to the smaller vec_id (null last). Each row is a vector of its own, also with the id or the components of another: a query's candidates are all rows but its own,
    and rows that share an id are queries of their own. Vectors are compared with those of the same number of components. Vectors that are null, or hold a null
    or non-finite component, take no part; those without a vec_id are candidates only. Scores end at 64 bits. Other columns are ignored; an empty table, or a
    lone vector, gives no rows.

    Pivots are fitted on `sample` vectors; all are indexed. The first search is each query's own shelf; its k-th score is then the least that shelves elsewhere, and
    the rings in them, must be able to reach. The bounds are exact, so nothing is lost.
    """
    vectors = whole_numbers(embeddings)
    fitted = fit_pivots(vectors, pivots, sample)
    index = build_index(vectors, fitted, shelf_numbers)
    queries = index.where(F.col("vec_id") % every == 0)

    own = queries.withColumns({"distance": F.col("r"), "least": F.lit(None).cast("long")})
    near = written(search(index, own, k, ring))
    least = near.groupBy("row").agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, rows in batch.groupby("dim"):
                far = distances(_unpacked(rows["v"].tolist(), dim), fitted.get(dim, np.zeros((1, dim))))
                yield rows.assign(distances=list(far))

    spreading = queries.select(*index.columns).mapInPandas(spread, FIELDS + ", shelf string, distances array<double>")
    spreading = written(spreading.withColumnRenamed("shelf", "home").drop("pivot", "r").join(least, "row", "left"))
    each = spreading.select("*", F.posexplode("distances").alias("pivot", "distance")).drop("distances")
    shelves = written(index.groupBy("shelf", "dim", "pivot").agg(F.min("r").alias("low"), F.max("r").alias("high"), F.max("norm").alias("longest")))
    gap = F.greatest(F.lit(0.0), F.col("distance") - F.col("high"), F.col("low") - F.col("distance"))
    squares = F.col("norm") * F.col("norm") + F.col("longest") * F.col("longest")
    reach = (squares - gap * gap) / 2 + squares * 1e-9 + 1
    wanted = each.join(shelves, ["dim", "pivot"]).where((F.col("shelf") != F.col("home")) & (F.col("least").isNull() | (reach >= F.col("least"))))
    found = near.union(search(index, wanted, k, ring))
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "found")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


SQL = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(q.v, x.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors x ON q.vec_id % 50 = 0 AND x.vec_id <> q.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
