"""Operator 7, PII: base expressions give seeds; bootstrapped contextual extraction finds further identifiers by the patterns seeds stand in.

A pattern is the word beside an identifier together with the identifier's shape. Patterns and instances form a graph whose scores are
passed to and fro: a pattern is as good as its instances are known, an instance is as likely as its patterns are good.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from issuetrail.llm.common import checkpointed, pieces, table, written

KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"[A-Za-z0-9._%+-]"
_DOMAIN = r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
# A run of local characters leads to one @ only, and a run of digits to one dot: later starts in a run that failed needn't be tried.
_EMAIL_HERE = re.compile(_LOCAL + "++" + _DOMAIN)
_EMAIL = re.compile(f"(?<!{_LOCAL}){_LOCAL}++{_DOMAIN}")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_MAY_BE = re.compile("[0-9@]")
_LETTERS = re.compile(r"[^\W\d_]")
_TOKEN = re.compile(r"(?<!\S)\S+")
#: An unknown identifier, for the method: a token with a digit or an @, of so many characters without the marks around it, or digits in the form of a card.
SIZES = (6, 64)
_MARKS = "\"'`(),;:<>[]{}#$&%*!?|=."


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, index of the kind), in code points, by start and kind."""
    found = []
    at = text.find("@")
    pos = 0
    while at >= 0:
        # after a match the next may begin at once, in the middle of a run
        m = _EMAIL_HERE.match(text, pos) or _EMAIL.search(text, pos)
        if not m:
            break
        found.append((m.start(), m.end(), 0))
        pos = m.end()
        at = text.find("@", pos)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in m[0].split(".")):
                found.append((m.start(), m.end(), 1))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = re.sub(r"[\x20-]", "", m[0])
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    found.append((m.start(), m.end(), 2))
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda span: (span[0], span[2]))


def _shape(token: str) -> str:
    """Digits by their number, letters by their case: what an identifier looks like."""
    shape = re.sub(r"[0-9]+", lambda m: f"9{{{len(m[0])}}}", token)
    if not shape.isascii():
        shape = _LETTERS.sub(lambda m: "A" if m[0].isupper() else "a", shape)
    return re.sub(r"(?<!\{)[a-z]+", "a", re.sub(r"[A-Z]+", "A", shape))


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, str, str, int | None]]:
    """(start, end, instance, pattern, kind) twice for each identifier, with its left and its right word; kind: the base span's that it is.

    Base spans are identifiers as they stand, with what is inside; others that overlap one are left out.
    """
    if not _MAY_BE.search(text):
        return []
    tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    starts = [start for start, _ in tokens]
    covered: list[list[int]] = []
    for start, end, _ in base:
        if covered and start < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    covered_ends = [end for _, end in covered]
    found = []

    def free(start: int, end: int) -> bool:
        i = bisect_right(covered_ends, start)
        return i == len(covered) or covered[i][0] >= end

    def add(start: int, end: int, left: str, right: str, kind: int | None) -> None:
        core = text[start:end]
        for side, word in (("<", left), (">", right)):
            context = _DIGIT.sub("0", word[-32:] if side == "<" else word[:32]).lower()
            found.append((start, end, core.lower(), f"{side} {context} {_shape(core)}", kind))

    def add_within(start: int, end: int, kind: int | None) -> None:
        """A span that need not be a token: what else its first and last token hold is a word, unless it is marks."""
        i, j = max(0, bisect_right(starts, start) - 1), max(0, bisect_left(starts, end) - 1)
        left = text[max(tokens[i][0], start - 4 * SIZES[1]) : start]
        right = text[end : min(tokens[j][1], end + 4 * SIZES[1])]
        if not left.strip(_MARKS) and not left.endswith("="):
            left = text[tokens[i - 1][0] : tokens[i - 1][1]] if i else "^"
        if not right.strip(_MARKS):
            right = text[tokens[j + 1][0] : tokens[j + 1][1]] if j + 1 < len(tokens) else "$"
        add(start, end, left, right, kind)

    for start, end, kind in base:
        add_within(start, end, kind)
    for m in _CARD.finditer(text):
        if " " in m[0] and 12 <= sum(c.isdigit() for c in m[0]) <= 19 and free(m.start(), m.end()):
            add_within(m.start(), m.end(), None)
    for i, (start, end) in enumerate(tokens):
        if end - start > 4 * SIZES[1] or not _MAY_BE.search(text, start, end):
            continue
        left = text[tokens[i - 1][0] : tokens[i - 1][1]] if i else "^"
        token = text[start:end]
        if "=" in token.rstrip(_MARKS):
            cut = token.rstrip(_MARKS).rindex("=") + 1
            left, token, start = token[:cut], token[cut:], start + cut
        core = token.lstrip(_MARKS)
        start += len(token) - len(core)
        core = core.rstrip(_MARKS)
        if not SIZES[0] <= len(core) <= SIZES[1] or not free(start, start + len(core)):
            continue
        right = text[tokens[i + 1][0] : tokens[i + 1][1]] if i + 1 < len(tokens) else "$"
        add(start, start + len(core), left, right, None)
    return found


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in pieces(batches):
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            base = base_spans(text)
            counts = [sum(kind == k for _, _, kind in base) for k in range(len(KINDS))]
            written = ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in base)
            spans = [{"start": s, "kind": k, "end": e} for s, e, k in base]
            may_be = [dict(zip(("start", "end", "instance", "pattern", "kind"), c, strict=True)) for c in candidates(text, base)]
            rows.append((doc_id, *counts, hashlib.sha256(written.encode()).hexdigest(), spans, may_be))
        yield pd.DataFrame(rows, columns=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "base", "candidates"])


_EXTRACTED = (
    "doc_id string, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base array<struct<start int, kind int, end int>>, "
    "candidates array<struct<start int, end int, instance string, pattern string, kind int>>"
)


def good_patterns(found: DataFrame, rounds: int = 3, least: float = 0.8, seeds: int = 3) -> DataFrame:
    """(pattern, kind, score) of patterns that score `least` or more and hold `seeds` different seeds or more; kind is that of most of these.

    found: (instance, pattern, kind), kind null where no base span is met. Edges, not occurrences, count: an instance that is repeated is one.
    A pattern's score is the sum of its instances' over their number and one more; an instance's is the chance that any of its
    patterns is right, and 1 for seeds. All sums combine before the shuffle, so a pattern or instance of many rows is a row for each task.
    """
    edges = written(found.groupBy("pattern", "instance").agg(F.max("kind").alias("kind")))
    scored = edges.withColumn("known", F.when(F.col("kind").isNotNull(), 1.0).otherwise(0.0))
    for turn in range(rounds):
        patterns = scored.groupBy("pattern").agg((F.sum("known") / (F.count("*") + 1)).alias("score"))
        if turn == rounds - 1:
            break
        weighed = edges.join(written(patterns), "pattern")
        # 1 - product of (1 - score): as a sum of logarithms
        chance = 1 - F.exp(F.sum(F.log1p(-F.least("score", F.lit(0.999999)))))
        instances = weighed.groupBy("instance").agg(F.when(F.max("kind").isNotNull(), 1.0).otherwise(chance).alias("known"))
        scored = written(edges.join(written(instances), "instance"))
    held = edges.where("kind is not null").groupBy("pattern", "kind").agg(F.count("*").alias("n"))
    held = held.groupBy("pattern").agg(F.sum("n").alias("seeds"), F.max(F.struct("n", "kind")).alias("most"))
    good = patterns.join(held.where(F.col("seeds") >= seeds), "pattern").where(F.col("score") >= least)
    return good.select("pattern", F.col("most.kind").alias("kind"), "score")


def find(documents: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found) for each row of documents (doc_id, text), whole texts.

    Counts and digest are of the base spans; spans has these and what the patterns found beside them (n_found), which never overlaps them. Spans
    are kind:start:end by start, then kind, comma-joined, in code points. What the method may find is an identifier of 6 to 64 characters, without the marks
    around it, in a token of up to 256, or digits in the form of a card; of the words beside it the 32 characters nearest to it make the pattern. A null text is empty and has none; a null id stays; repeated rows are
    repeated in the result but count once as instances; other columns are ignored; an empty table gives no rows.
    """
    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # read from the checkpoint, a row keeps its number
    extracted = checkpointed(rows.mapInPandas(_extract, _EXTRACTED).withColumn("row", F.monotonically_increasing_id()))
    met = extracted.select("row", "base", F.explode("candidates").alias("c")).select("row", "base", "c.*")
    good = good_patterns(met.select("instance", "pattern", "kind"))
    free = ~F.exists("base", lambda b: (b["start"] < F.col("end")) & (F.col("start") < b["end"]))
    new = met.where("kind is null").drop("kind").where(free).join(written(good), "pattern")
    # both sides' patterns may find it: once, with the better one's kind
    new = new.groupBy("row", "start", "end").agg(F.max(F.struct("score", "kind")).alias("best"))
    more = new.groupBy("row").agg(F.collect_list(F.struct("start", F.col("best.kind").alias("kind"), "end")).alias("more"))
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast("array<struct<start int, kind int, end int>>"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    texts = F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string")))
    return extracted.join(more, "row", "left").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[f"n_{k}" for k in KINDS],
        "base_sha256",
        F.array_join(texts, ",").alias("spans"),
        F.coalesce(F.size("more"), F.lit(0)).cast("long").alias("n_found"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
