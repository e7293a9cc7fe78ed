"""Operator 2, toxicity: a linear-chain conditional random field tags toxic tokens; its marginals give document scores and offending offsets.

The labels are of documents. Token labels come from all training rows: a token of a toxic document is labelled if its form is strongly tied to
toxic documents and about as strongly as any other token of the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from issuetrail.llm.common import fold, pieces, table

#: Features of a token, each hashed into so many buckets: first four bytes, first six bytes, and ends with length.
BUCKETS, KINDS = 1 << 18, 3
_MIX = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Tokens:
    """Tokens of several texts: byte ranges in `data`, the text of each, and hashed features (KINDS columns)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    features: np.ndarray
    offsets: np.ndarray


def tokenize(texts: list[str]) -> Tokens:
    """Words (letters, digits, bytes over 127) in lower case."""
    encoded = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(e) + 1 for e in encoded])
    data = np.frombuffer(b"\n".join(encoded) + b"\n" + bytes(16), np.uint8).copy()
    data[(data >= 65) & (data <= 90)] += 32
    latin = np.flatnonzero(data[:-1] == 0xC3) + 1
    data[latin[(data[latin] >= 0x80) & (data[latin] <= 0x9E) & (data[latin] != 0x97)]] += 32
    word = _WORD[data]
    edges = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    text = np.searchsorted(offsets, starts, "right") - 1
    size = ends - starts

    def packed(first: np.ndarray, n: int) -> np.ndarray:
        value = np.zeros(len(first), np.uint64)
        for j in range(n):
            value = (value << np.uint64(8)) | np.where((first + j < ends) & (first + j >= starts), data[first + j], 0).astype(np.uint64)
        return value

    head, tail = packed(starts, 6), packed(np.maximum(ends - 6, 0), 6)
    four = np.where(size > 4, head >> np.uint64(16), head)
    hashed = []
    for kind, value in enumerate((four, head + np.uint64(1 << 50), (head * _MIX) ^ tail ^ (size.astype(np.uint64) << np.uint64(52)))):
        mixed = value * _MIX
        mixed ^= mixed >> np.uint64(29)
        hashed.append(((mixed * _MIX) >> np.uint64(46)).astype(np.int32) + kind * BUCKETS)
    return Tokens(data, starts, ends, text, np.stack(hashed, axis=1) if len(starts) else np.zeros((0, KINDS), np.int32), offsets)


@dataclass
class Model:
    """Weights of features for the toxic state, transition potentials, start weight, and the document score's logistic weights."""

    weights: np.ndarray
    moves: np.ndarray
    start: float
    document: np.ndarray
    rate: float


def _scan(step, first: np.ndarray, resets: np.ndarray, run: int = 128) -> np.ndarray:
    """values[t] = step(t, values[t - 1]), or first[t] where it resets, for all t: runs advance side by side, again until their joints agree."""
    n = len(first)
    rows = -(-n // run)
    grid = np.minimum(np.arange(rows * run).reshape(rows, run), n - 1)
    entry = first[grid[:, 0]]
    values = np.empty((rows, run))
    while True:
        before = entry
        for j in range(run):
            t = grid[:, j]
            before = np.where(resets[t], first[t], step(t, before))
            values[:, j] = before
        joined = np.concatenate([first[:1], values[:-1, -1]])
        if np.allclose(joined, entry, rtol=1e-9, atol=0):
            return values.reshape(-1)[:n]
        entry = joined


def forward_backward(emission: np.ndarray, begins: np.ndarray, moves: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginal probabilities of state 1, and the forward and backward ratios of state 1 to state 0, for chains that begin where told.

    emission: log potential of state 1 against state 0; moves: 2 x 2 potentials.
    """
    if not len(emission):
        return (np.zeros(0),) * 3
    x = np.exp(np.clip(emission, -30, 30))
    (a00, a01), (a10, a11) = moves
    forward = _scan(lambda t, f: x[t] * (a01 + f * a11) / (a00 + f * a10), x * np.exp(start), begins)
    # backwards: the token after t begins a chain -> 1
    last = np.append(begins[1:], True)[::-1]
    y = np.append(x[1:], 1.0)[::-1]
    reached = np.zeros(len(x))
    ones = np.ones(len(x))

    def back(t: np.ndarray, g: np.ndarray) -> np.ndarray:
        return (a10 + a11 * y[t] * g) / (a00 + a01 * y[t] * g)

    reached = _scan(back, ones, last)[::-1]
    odds = forward * reached
    return odds / (1 + odds), forward, reached


def _begins(text: np.ndarray) -> np.ndarray:
    return np.append(True, text[1:] != text[:-1]) if len(text) else np.zeros(0, bool)


def _summaries(marginals: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """What the score of a document rests on: a constant, the chance that any token is toxic, their count, their share. Marginals are
    squared first, so that thousands of faint ones in a long text don't add up to a sign."""
    sure = np.minimum(marginals, 1 - 1e-9) ** 2
    total = np.bincount(text, sure, n)
    none = np.bincount(text, np.log1p(-sure), n)
    size = np.maximum(np.bincount(text, minlength=n), 1)
    return np.stack([np.ones(n), -np.expm1(none), np.log1p(total), total / size], axis=1)


def train_chain(tokens: Tokens, labels: np.ndarray, rounds: int = 40, ridge: float = 0.02) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights, transition potentials and start weight that make the token labels likely; full gradients with adaptive steps."""
    begins = _begins(tokens.text)
    follows = ~begins[1:]
    # weights only for features that occur
    used, index = np.unique(tokens.features, return_inverse=True)
    index = index.reshape(tokens.features.shape)
    theta = np.zeros(len(used) + 5)
    theta[-5] = -2.0
    squares = np.full(len(theta), 1e-6)
    y = labels.astype(float)
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[:-1][follows], labels[1:][follows]), 1)
    for _ in range(rounds):
        bias, start, moves = theta[-5], theta[-4], np.array([[1.0, np.exp(theta[-3])], [np.exp(theta[-2]), np.exp(theta[-1])]])
        emission = theta[:-5][index].sum(axis=1) + bias
        p, f, g = forward_backward(emission, begins, moves, start)
        x = np.exp(np.clip(emission, -30, 30))
        before, here = f[:-1][follows], (x * g)[1:][follows]
        pair = np.stack([np.ones_like(before), moves[0, 1] * here, moves[1, 0] * before, moves[1, 1] * before * here])
        expected = (pair / pair.sum(axis=0)).sum(axis=1)
        wrong = y - p
        gradient = np.empty_like(theta)
        gradient[:-5] = sum(np.bincount(index[:, k], wrong, len(used)) for k in range(KINDS)) - ridge * theta[:-5]
        gradient[-5], gradient[-4] = wrong.sum(), wrong[begins].sum()
        gradient[-3:] = seen.reshape(-1)[1:] - expected[1:] - theta[-3:]
        squares += gradient**2
        theta += 0.7 * gradient / np.sqrt(squares)
    weights = np.zeros(BUCKETS * KINDS, np.float32)
    weights[used] = theta[:-5]
    weights += np.float32(theta[-5] / KINDS)
    return weights, np.array([[1.0, np.exp(theta[-3])], [np.exp(theta[-2]), np.exp(theta[-1])]]), float(theta[-4])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, rounds: int = 25) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x.T * (p * (1 - p) + 1e-9)) @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return w


def _feature_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many toxic and clean texts have each feature: a row for each feature of the task's texts."""
    counts = np.zeros((2, BUCKETS * KINDS), np.int64)
    for batch in pieces(batches):
        tokens = tokenize(batch["text"].tolist())
        pairs = np.unique(tokens.text[:, None].astype(np.int64) * (BUCKETS * KINDS) + tokens.features)
        toxic = batch["toxic"].to_numpy()[pairs // (BUCKETS * KINDS)]
        for label in (0, 1):
            counts[label] += np.bincount(pairs[toxic == label] % (BUCKETS * KINDS), minlength=BUCKETS * KINDS)
    some = np.flatnonzero(counts.any(axis=0))
    yield pd.DataFrame({"feature": some, "clean": counts[0, some], "toxic": counts[1, some]})


def _ties(found: pd.DataFrame, clean: int, toxic: int) -> np.ndarray:
    """How strongly each feature is tied to toxic texts: the likelihood ratio of a text with it being toxic, zero if it is no sign of it."""
    k, n = found["toxic"].to_numpy(float), found["clean"].to_numpy(float)
    share, base = k / np.maximum(k + n, 1), toxic / max(clean + toxic, 1)
    ratio = 2 * (k * np.log(np.maximum(share, 1e-12) / base) + np.where(n > 0, n * np.log(np.maximum(1 - share, 1e-12) / (1 - base)), 0))
    ties = np.zeros(BUCKETS * KINDS)
    ties[found["feature"].to_numpy()] = np.where(k / toxic > 10 * (n + 0.5) / clean, ratio, 0)
    return ties


def _fitting(drawn: list[Row], most_chars: int) -> Iterator[Row]:
    """Of drawn rows, in their order, those whose texts have room."""
    for row in drawn:
        if row["chars"] <= most_chars:
            most_chars -= row["chars"]
            yield row


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = 1500, sample_chars: int = 4_000_000, least_tie: float = 18.0) -> Model:
    """A model of documents (doc_id, text) and labels (doc_id, toxic), learned from the rows given.

    The ties of features to toxic documents are counted over all labelled rows. The chain is then fitted on a bounded sample of texts of any length: of each
    label the `sample_rows` different rows of the least hashed ids, passing over those that would bring it beyond `sample_chars` characters altogether. Rows without a
    text or a label don't take part; of several labels of an id the toxic one counts. Without both labels, among all or in the sample, the score is the rate of
    toxic labels.
    """
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    rows = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    # labels grow with the corpus: the same join at every size, never a broadcast
    joined = rows.join(marks.hint("merge"), "doc_id").select("text", "toxic")
    totals = {r["toxic"]: r["n"] for r in rows.select("doc_id").join(marks, "doc_id").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    if not clean or not toxic:
        return Model(np.zeros(0), np.ones((2, 2)), 0.0, np.zeros(4), 1.0 if toxic else 0.0)
    counts = joined.mapInPandas(_feature_counts, "feature long, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    signs = counts.where(F.col("toxic") >= 2).where(F.col("toxic") / toxic > 10 * (F.col("clean") + 0.5) / clean)
    # at most BUCKETS * KINDS rows
    found = pd.DataFrame([tuple(r) for r in signs.select("feature", "clean", "toxic").collect()], columns=["feature", "clean", "toxic"])
    ties = _ties(found.astype("int64"), clean, toxic)
    sized = rows.select("doc_id", F.char_length("text").alias("chars"), F.xxhash64("text").alias("mark")).join(marks, "doc_id").distinct()
    wanted = []
    for label in (0, 1):
        drawn = sized.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id", "chars", "mark").limit(sample_rows).collect()
        wanted += [(r["doc_id"], r["mark"], label) for r in _fitting(drawn, sample_chars)]
    if len({label for *_, label in wanted}) < 2:
        return Model(np.zeros(0), np.ones((2, 2)), 0.0, np.zeros(4), toxic / (clean + toxic))
    # at most 2 * sample_rows rows
    chosen = F.broadcast(documents.sparkSession.createDataFrame(wanted, "doc_id long, mark long, toxic int"))
    met = rows.withColumn("mark", F.xxhash64("text")).join(chosen, ["doc_id", "mark"])
    sample = met.dropDuplicates(["doc_id", "mark"]).orderBy("doc_id", "mark").collect()
    tokens = tokenize([r["text"] for r in sample])
    marked = np.array([r["toxic"] for r in sample])
    tie = ties[tokens.features].max(axis=1)
    most = np.zeros(len(sample))
    np.maximum.at(most, tokens.text, tie)
    token_labels = ((marked[tokens.text] == 1) & (tie >= least_tie) & (tie >= 0.1 * most[tokens.text])).astype(np.int64)
    weights, moves, start = train_chain(tokens, token_labels)
    p, _, _ = forward_backward(weights[tokens.features].sum(axis=1), _begins(tokens.text), moves, start)
    document = logistic(_summaries(p, tokens.text, len(sample)), marked.astype(float))
    return Model(weights, moves, start, document, toxic / (clean + toxic))


def _scored(model: Model, texts: list[str]) -> tuple[np.ndarray, list[list[list[int]]]]:
    """Scores, and the toxic tokens' ranges of code points, of texts."""
    n = len(texts)
    if not len(model.weights):
        return np.full(n, model.rate), [[] for _ in texts]
    tokens = tokenize(texts)
    p, _, _ = forward_backward(model.weights[tokens.features].sum(axis=1), _begins(tokens.text), model.moves, model.start)
    scores = 1 / (1 + np.exp(-np.clip(_summaries(p, tokens.text, n) @ model.document, -30, 30)))
    spans: list[list[list[int]]] = [[] for _ in texts]
    hits = np.flatnonzero(p >= 0.5)
    if len(hits):
        points = np.cumsum((tokens.data & 0xC0) != 0x80)
        base = points[tokens.offsets[:-1]]
        for i in hits.tolist():
            doc = tokens.text[i]
            first = int(points[tokens.starts[i]] - base[doc])
            spans[doc].append([first, first + int(points[tokens.ends[i] - 1] - points[tokens.starts[i]]) + 1])
    return scores, spans


def score(documents: DataFrame, model: Model) -> DataFrame:
    """The documents' rows and columns with toxicity (0 to 1) and toxic_spans (ranges of code points); texts are scored whole.

    A null text is empty; a text without words gets the score of a document with no toxic token. Columns of these two names are replaced.
    """
    # plain arrays: BUCKETS * KINDS floats, whatever the corpus
    sent = documents.sparkSession.sparkContext.broadcast((model.weights, model.moves, model.start, model.document, model.rate))

    @F.pandas_udf("toxicity double, toxic_spans array<array<int>>")
    def tagged(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Model(*sent.value)
        for piece in pieces(pd.DataFrame({"text": part}) for part in texts):
            scores, spans = _scored(model, piece["text"].tolist())
            yield pd.DataFrame({"toxicity": scores, "toxic_spans": spans})

    kept = [c for c in documents.columns if c not in ("toxicity", "toxic_spans", "_tagged")]
    found = documents.select(*kept, tagged(F.coalesce("text", F.lit(""))).alias("_tagged"))
    return found.select(*kept, "_tagged.toxicity", "_tagged.toxic_spans")


def held_out() -> Column:
    return fold(F.col("doc_id"), 3) == 1


def reject_toxic(documents: DataFrame, labels: DataFrame, limit: float = 0.7) -> DataFrame:
    """The documents that score under the limit, by a model fitted on those of them that are labelled and not held out; all columns stay."""
    model = fit(documents.where(~held_out()), labels)
    return score(documents, model).where(F.col("toxicity") < limit).select(*documents.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(documents.where(~held_out()), table(spark, sf_dir, "labels"))
    scored = score(documents, model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("toxicity").alias("score"),
        F.when(F.col("toxicity") >= 0.7, 1).otherwise(0).alias("predicted"),
        "toxic_spans",
    )
