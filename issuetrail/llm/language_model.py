"""Operator 3, LM scoring: prediction by partial matching over bytes, with escape estimation and symbol exclusion, beside a word baseline.

The trie is a table of n-grams: a context of up to ORDER symbols and the symbol after it, as a number of nine bits a symbol, the newest lowest.
Symbol 0 stands before and after a text, bytes are 1 to 256. N-grams of the longest contexts are counted over all training texts; shorter
contexts are sums over longer ones, so a context's symbols are a subset of those of its suffix. The trie stays a distributed table, whole: each n-gram
of the documents gets its probability there, by a join per context length. Tasks are sent those of the most frequent n-grams; others meet theirs in a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from issuetrail.llm.common import LEAST, ascii_lower, checkpointed, fold, pieces, table, written

ORDER, SYMBOL, ALPHABET = 5, 9, 257
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Symbols that are part of a word: all but the end and ASCII white space.
_IN_WORD = np.ones(1 << SYMBOL, bool)
_IN_WORD[[0, 33, *range(10, 15)]] = False


def events(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram of each event (bytes of the texts, A-Z in lower case, and an end after each), and where each text's events begin."""
    parts = [_LOWER[np.frombuffer(t.encode(), np.uint8)] for t in texts]
    sizes = np.array([len(p) for p in parts])
    starts = np.cumsum(np.append(0, sizes[:-1] + order))
    symbols = np.zeros(int(sizes.sum()) + order * (len(parts) + 1), np.int64)
    for p, s in zip(parts, starts.tolist(), strict=True):
        symbols[order + s : order + s + len(p)] = p
        symbols[order + s : order + s + len(p)] += 1
    n = len(symbols) - order
    grams = np.zeros(n, np.int64)
    for j in range(order + 1):
        grams <<= SYMBOL
        grams |= symbols[j : j + n]
    own = np.zeros(n + 1, np.int32)
    own[starts] += 1
    own[np.minimum(starts + sizes + 1, n)] -= 1
    return grams[np.cumsum(own[:n]) > 0], np.cumsum(np.append(0, sizes[:-1] + 1))


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of the longest n-grams of a task's texts, in training (n) and in all (met), one row or two for each and each few pieces."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> pd.DataFrame:
        marked = np.concatenate([g for g, _ in held])
        counts = np.concatenate([c for _, c in held])
        order = np.argsort(marked, kind="stable")
        marked, counts = marked[order], counts[order]
        first = np.flatnonzero(np.append(True, marked[1:] != marked[:-1]))
        marked, met = marked[first], np.add.reduceat(counts, first)
        return pd.DataFrame({"gram": marked >> 1, "n": met * (marked & 1), "met": met})

    for piece in pieces(batches):
        grams, starts = events(piece["text"].tolist())
        learned = np.repeat(piece["learned"].to_numpy().astype(np.int64), np.diff(np.append(starts, len(grams))))
        held.append(np.unique(grams << 1 | learned, return_counts=True))
        if sum(len(g) for g, _ in held) > 3_000_000:
            yield merged()
            held.clear()
    if held:
        yield merged()


def resolve(texts: DataFrame) -> DataFrame:
    """(gram, met, score) for each different n-gram of the longest contexts in texts (text, learned): how often it occurs, and log10 of the probability of
    its last symbol after its context, by all n-grams of the texts that are learned.

    The rules are those of Trie, from the shortest context up. Each row of a level has n, its count in training; of its context, the total and the kinds;
    free, its score where no longer context is known; and escaped, what follows an escape from its own context. A row joins its suffix, and
    sums over a context's rows, of which there are at most ALPHABET.
    """
    levels = [checkpointed(texts.mapInPandas(_counted, "gram long, n long, met long").groupBy("gram").agg(F.sum("n").alias("n"), F.sum("met").alias("met")))]
    for length in range(ORDER - 1, -1, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << SYMBOL * (length + 1)) - 1)).alias("gram")
        levels.append(checkpointed(levels[-1].groupBy(shorter).agg(F.sum("n").alias("n"), F.sum("met").alias("met"))))
    levels.reverse()
    seen = F.col("n") > 0
    log = lambda c: F.log10(c.cast("double"))
    below = None
    for length, level in enumerate(levels):
        context = Window.partitionBy(F.shiftright("gram", SYMBOL))
        if length:
            low = F.col("gram").bitwiseAND(F.lit((1 << SYMBOL * length) - 1))
            names = [F.col(c).alias(f"low_{c}") for c in ("gram", "n", "total", "kinds", "free", "escaped")]
            level = level.join(below.select(*names), low == F.col("low_gram"))
        level = level.select("*", F.sum("n").over(context).alias("total"), F.sum(seen.cast("long")).over(context).alias("kinds"))
        whole = log(F.col("total") + F.col("kinds"))
        if length:
            level = level.withColumn("shared", F.sum(F.when(seen, F.col("low_n")).otherwise(0)).over(context))
            # what the suffix has beside this context's symbols
            rest_kinds = F.col("low_kinds") - F.col("kinds")
            rest = log(F.greatest(F.col("low_total") - F.col("shared") + rest_kinds, F.lit(1)))
            passed = F.when(rest_kinds > 0, log(F.greatest(rest_kinds, F.lit(1))) - rest).otherwise(0.0)
            escaped = F.when(F.col("low_n") > 0, log(F.col("low_n")) - rest).otherwise(passed + F.col("low_escaped"))
            unknown = F.col("low_free")
        else:
            escaped = -log(F.greatest(F.lit(ALPHABET) - F.col("kinds"), F.lit(1)))
            unknown = F.lit(-float(np.log10(ALPHABET)))
        free = F.when(F.col("total") == 0, unknown).when(seen, log(F.col("n")) - whole)
        free = free.otherwise(log(F.greatest(F.col("kinds"), F.lit(1))) - whole + escaped)
        below = level.select("gram", "n", "met", "total", "kinds", free.alias("free"), escaped.alias("escaped"))
    return below.select("gram", "met", F.col("free").alias("score"))


class Lookup:
    """A hash table from numbers to their places, with linear probing, for whole arrays at a time."""

    def __init__(self, keys: np.ndarray) -> None:
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.places = np.zeros(1 << self.bits, np.int32)
        waiting, slots = np.arange(len(keys)), self._slots(keys)
        while len(waiting):
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[waiting[free]]
            self.places[slots[free]] = waiting[free]
            left = self.keys[slots] != keys[waiting]
            waiting, slots = waiting[left], (slots[left] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for one that isn't there."""
        slots = self._slots(keys)
        seen = self.keys[slots]
        found = np.where(seen == keys, self.places[slots], -1)
        open_ = np.flatnonzero((seen != keys) & (seen != -1))
        while len(open_):
            slots_ = (slots[open_] + 1) & self.mask
            slots[open_] = slots_
            seen = self.keys[slots_]
            hit = seen == keys[open_]
            found[open_[hit]] = self.places[slots_[hit]]
            open_ = open_[~hit & (seen != -1)]
        return found


class Trie:
    """The model in memory, which `resolve` is checked against. Log probabilities by method C: a context of t events and d different symbols escapes with d / (t + d); symbols of the longer
    contexts that were escaped from are excluded."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.order = len(levels) - 1
        mark = lambda k: np.int64(1) << SYMBOL * (k + 1)  # noqa: E731  tells lengths apart
        self.grams = Lookup(np.concatenate([g | mark(k) for k, (g, _) in enumerate(levels)]))
        counts = np.concatenate([n for _, n in levels]).astype(float)
        self.log_count = np.log10(counts)
        contexts, totals, kinds, rests, rest_kinds, of = [], [], [], [], [], []
        seen = 0
        lower: np.ndarray | None = None
        for k, (g, n) in enumerate(levels):
            own, index = np.unique(g >> SYMBOL, return_inverse=True)
            total, kind = np.bincount(index, n, len(own)), np.bincount(index, minlength=len(own)).astype(float)
            if k and len(own):
                # what the suffix has beside this context's symbols
                low = (1 << SYMBOL * k) - 1
                suffix = np.searchsorted(lower, own & ((1 << SYMBOL * (k - 1)) - 1))
                shared = levels[k - 1][1][np.searchsorted(levels[k - 1][0], g & low)]
                rests.append(totals[-1][suffix] - np.bincount(index, shared, len(own)))
                rest_kinds.append(kinds[-1][suffix] - kind)
            else:
                rests.append(np.zeros(len(own)))
                rest_kinds.append(np.zeros(len(own)))
            contexts.append(own | mark(k - 1) if k else own | 1)
            totals.append(total)
            kinds.append(kind)
            of.append(index + seen)
            seen += len(own)
            lower = own
        self.contexts = Lookup(np.concatenate(contexts))
        total, kind, rest, rest_kind = (np.concatenate(x) for x in (totals, kinds, rests, rest_kinds))
        whole = np.log10(np.maximum(total + kind, 1))
        self.escape = np.log10(np.maximum(kind, 1)) - whole
        self.rest = np.log10(np.maximum(rest + rest_kind, 1))
        # a suffix with nothing left is passed through for nothing
        self.rest_escape = np.where(rest_kind > 0, np.log10(np.maximum(rest_kind, 1)) - self.rest, 0.0)
        self.whole = self.log_count - whole[np.concatenate(of)] if len(counts) else self.log_count
        self.unseen = -np.log10(max(1, ALPHABET - (int(kinds[0][0]) if len(kinds[0]) else 0)))

    def score(self, grams: np.ndarray) -> np.ndarray:
        """log10 of the probability of each n-gram's last symbol after its context."""
        found = self.grams.find(grams | (1 << SYMBOL * (self.order + 1)))
        result = np.where(found >= 0, self.whole[found] if len(self.whole) else 0.0, 0.0)
        at = np.flatnonzero(found < 0)
        left = grams[at]
        last = np.full(len(at), -1)
        for k in range(self.order, -1, -1):
            gram = left & ((1 << SYMBOL * (k + 1)) - 1)
            if k < self.order:
                found = self.grams.find(gram | (1 << SYMBOL * (k + 1)))
                hit = found >= 0
                escaped = last[hit] >= 0
                place = found[hit]
                result[at[hit]] += np.where(escaped, self.log_count[place] - self.rest[last[hit]], self.whole[place]) if len(place) else 0.0
                at, left, last, gram = at[~hit], left[~hit], last[~hit], gram[~hit]
            context = self.contexts.find((gram >> SYMBOL) | (1 << SYMBOL * k))
            known = context >= 0
            step = np.where(last >= 0, self.rest_escape[last], self.escape[context]) if len(self.escape) else np.zeros(len(last))
            result[at] += np.where(known, step, 0.0)
            last = np.where(known, context, last)
        result[at] += self.unseen
        return result


def _split(texts: DataFrame, *keys: str) -> DataFrame:
    """(keys, word): a row for each word of `text`, A-Z in lower case."""
    # by one character, texts are split without a regular expression; empty words go
    spaced = reduce(lambda text, blank: F.replace(text, F.lit(blank), F.lit(" ")), "\t\n\v\f\r", F.col("text"))
    each = texts.select(*keys, F.explode(F.split(spaced, " ")).alias("word")).where("word <> ''")
    return each.withColumn("word", F.when(F.lower("word") == F.col("word"), F.col("word")).otherwise(ascii_lower(F.col("word"))))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over texts (text)."""
    return _split(texts).groupBy("word").agg(F.count("*").alias("c"))


def least_count(counts: DataFrame, count: str, most: int) -> int:
    """The least count that at most `most` rows reach; large counts are told apart by their first nine binary digits."""
    step = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.floor(F.log2(count)).cast("int") - 8, F.lit(0)))
    rounded = counts.groupBy((F.col(count) - F.col(count) % step).alias("n")).agg(F.count("*").alias("rows"))
    least, total = 1 << 62, 0
    for row in rounded.orderBy(F.desc("n")).collect():
        total += row["rows"]
        if total > most:
            break
        least = row["n"]
    return least


def score(documents: DataFrame, training, most_grams: int = 2_000_000, head_words: int = 1 << 17) -> DataFrame:
    """Code lengths of whole texts under a pretrained model, for each row of documents (doc_id, text); training: a condition for rows to learn from.

    (doc_id, version, n_tokens, n_known, train_tokens, base_score, score): log10 probabilities by words and by the byte model. A null text is empty and
    has one token, the end. Null ids take part; equal rows stay and each counts in training. Without training rows the byte model
    is uniform. Other columns are ignored; an empty table gives no rows.

    The whole trie is used. Probabilities of the `most_grams` most frequent n-grams, and counts of frequent words, at most `head_words` of at most
    64 bytes, are sent to all tasks; all other n-grams and words meet theirs in a join, so neither number changes a result.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.select(F.coalesce("doc_id", F.lit(LEAST)).alias("key"), F.xxhash64("text").alias("version"), "doc_id", "text")
    learned = docs.where(training).select("text")
    told = F.coalesce(training, F.lit(False)).alias("learned")
    grams = checkpointed(resolve(docs.select("text", told)))
    sent = F.col("met") >= least_count(grams, "met", most_grams)
    frequent_grams = grams.where(sent).select("gram", "score").toArrow()
    other_grams = grams.where(~sent).select("gram", F.col("score").alias("each"))
    counts = checkpointed(word_counts(learned))
    ends = learned.count()
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    all_tokens, kinds = sums["n"] + ends, sums["v"] + bool(ends)
    short = F.octet_length("word") <= 64
    frequent = short & (F.col("c") >= least_count(counts.where(short), "c", head_words))
    head, tail = counts.where(frequent), counts.where(~frequent)
    met = _split(docs, "key", "version").join(F.broadcast(head), "word", "left")
    gain = F.log10(F.col("c") + 1)
    known = F.sum(F.when(F.col("c").isNotNull(), 1).otherwise(0))
    common = met.groupBy("key", "version").agg(F.sum(gain).alias("gain"), known.alias("known"), F.count("*").alias("met"))
    rare = met.where("c is null").select("key", "version", "word").join(tail, "word").groupBy("key", "version").agg(F.sum(gain).alias("rare_gain"), F.count("*").alias("rare"))
    # most_grams at most
    model = documents.sparkSession.sparkContext.broadcast([frequent_grams.column(c).to_numpy() for c in ("gram", "score")])

    @F.pandas_udf("score double, n long, others array<struct<gram: long, times: long>>")
    def code_length(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known_grams, scores = model.value
        ready, scores = Lookup(known_grams), np.append(scores, 0.0)
        for piece in pieces((pd.DataFrame({"text": part}) for part in texts), 1_000_000):
            grams, starts = events(piece["text"].tolist())
            symbol = (1 << SYMBOL) - 1
            begins = _IN_WORD[grams & symbol] & ~_IN_WORD[(grams >> SYMBOL) & symbol]
            found = ready.find(grams)
            missed = np.flatnonzero(found < 0)
            cuts = np.searchsorted(missed, starts[1:])
            others = [[{"gram": g, "times": t} for g, t in zip(*(x.tolist() for x in np.unique(grams[own], return_counts=True)), strict=True)] for own in np.split(missed, cuts)]
            yield pd.DataFrame({"score": np.add.reduceat(scores[found], starts), "n": np.add.reduceat(begins.astype(np.int64), starts), "others": others})

    rows = docs.select("key", "version", "doc_id", code_length("text").alias("own")).select("key", "version", "doc_id", "own.*")
    # read from the checkpoint, a row keeps its number
    rows = checkpointed(rows.withColumn("row", F.monotonically_increasing_id()))
    missed = rows.select("row", F.explode("others").alias("o")).select("row", "o.*").join(written(other_grams), "gram")
    missed = missed.groupBy("row").agg(F.sum(F.col("each") * F.col("times")).alias("other_score"))
    found = rows.join(missed, "row", "left").join(common, ["key", "version"], "left").join(rare, ["key", "version"], "left")
    zero = F.lit(0.0)
    # equal rows have been summed together
    copies = F.greatest(F.col("met") / F.greatest("n", F.lit(1)), F.lit(1.0))
    gains = (F.coalesce("gain", zero) + F.coalesce("rare_gain", zero)) / F.coalesce(copies, F.lit(1.0))
    knowns = ((F.coalesce("known", F.lit(0)) + F.coalesce("rare", F.lit(0))) / F.coalesce(copies, F.lit(1.0))).cast("long")
    n_tokens = (F.col("n") + 1).cast("long")
    base = gains + F.log10(F.lit(float(ends + 1))) - n_tokens * F.log10(F.lit(float(all_tokens + kinds + 1)))
    return found.select(
        "doc_id", "version", n_tokens.alias("n_tokens"), (knowns + int(ends > 0)).alias("n_known"), F.lit(int(all_tokens)).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("score") + F.coalesce("other_score", zero)).alias("score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 7) == 2
    scored = score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
