"""Operator 6, chat formatting: a finite-state machine over roles emits text segments with loss flags from a declarative template."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from issuetrail.llm.common import table


@dataclass(frozen=True)
class Template:
    """How turns are written. `names`: what stands for known roles; `after`: which roles may follow each state, None being the start."""

    opening: str = "### "
    named: str = ": "
    close: str = "</turn>"
    names: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"})
    controls: tuple[str, ...] = ("###", "</turn>")
    trained: tuple[str, ...] = ("assistant",)
    after: dict[str | None, tuple[str, ...]] = field(
        default_factory=lambda: {None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user", "tool"), "tool": ("assistant",)}
    )
    last: tuple[str, ...] = ("assistant",)

    def escape(self, text: str, *more: str) -> str:
        """Each backslash and each control string with a backslash before it."""
        return re.sub("|".join(map(re.escape, ("\\", *self.controls, *more))), lambda m: "\\" + m[0], text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)

    def header(self, role: str) -> str:
        """Known roles by name; any other after an equals sign, with colons escaped too, so that it can be read back."""
        return self.opening + (self.names.get(role) or "=" + self.escape(role, ":")) + self.named

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        return [(self.header(role), False), (self.escape(text), role in self.trained), (self.close, False)]


class Reader:
    """Reads turns back from formatted text that arrives in pieces."""

    def __init__(self, template: Template) -> None:
        self.template, self.held = template, ""
        self.roles = {name: role for role, name in template.names.items()}

    def _until(self, mark: str, start: int) -> int:
        """Where the mark stands unescaped, at `start` or later; -1 if not yet."""
        for m in re.finditer(r"\\.|" + re.escape(mark), self.held[start:], re.DOTALL):
            if m[0] == mark:
                return start + m.start()
        return -1

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        self.held += piece
        t = self.template
        while self.held:
            if not self.held.startswith(t.opening):
                if t.opening.startswith(self.held):
                    return
                raise ValueError("no turn begins here")
            named = self._until(t.named, len(t.opening))
            end = self._until(t.close, named + len(t.named)) if named >= 0 else -1
            if end < 0:
                return
            name, text = self.held[len(t.opening) : named], self.held[named + len(t.named) : end]
            self.held = self.held[end + len(t.close) :]
            yield self.roles[name] if name in self.roles else t.unescape(name[1:]), t.unescape(text)


def _conversations(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[bool, list[tuple]]]:
    """Rows in pieces of one conversation; the flag says that a piece begins one."""
    before = object()
    for batch in batches:
        ids = batch["conv_id"].astype(object).where(batch["conv_id"].notna(), None).tolist()
        rows = list(zip(ids, *[batch[c].tolist() for c in batch.columns if c != "conv_id"], strict=True))
        start = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or ids[i] != ids[start]:
                yield ids[start] != before, rows[start:i]
                before, start = ids[start], i


def format_turns(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """(conv_id, at, role, follows, texts, losses) for each turn of conversations (conv_id, turn, role, text), in order within partitions.

    texts and losses are the turn's segments: header, escaped text, close mark, and whether a loss is taken on each. `at` counts from 0;
    `follows`: the state machine allows the role there. A null text or role is empty; a null role or one that the template does not know never follows.
    Turns are in order of turn (null first), then role, then text, so ties and repeated rows have a defined order; rows without a conv_id
    are one conversation. Other columns are ignored; an empty table gives no rows. A conversation's rows stream through one task and are never held
    together.
    """
    template = template or Template()

    columns = ["conv_id", "at", "role", "follows", "texts", "losses"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, at, made, size = None, 0, [], 0
        for begins, rows in _conversations(batches):
            if begins:
                state, at = None, 0
            for conv_id, role, text in rows:
                follows = role in template.after.get(state, ())
                segments = template.segments(role, text)
                made.append((conv_id, at, role, follows, [s for s, _ in segments], [loss for _, loss in segments]))
                state, at, size = role, at + 1, size + len(text)
                if len(made) >= 2000 or size > 4_000_000:
                    yield pd.DataFrame(made, columns=columns).astype({"conv_id": "Int64"})
                    made, size = [], 0
        if made:
            yield pd.DataFrame(made, columns=columns).astype({"conv_id": "Int64"})

    empty = F.lit("")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    placed = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")
    return placed.mapInPandas(run, "conv_id long, at long, role string, follows boolean, texts array<string>, losses array<boolean>")


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Digests of each conversation, from the formatted text and its loss mask alone; formatted: rows of format_turns in its order.

    conv_id, n_turns, turns_sha256 (of role, newline, text, newline per turn), loss_chars and loss_sha256 (of the unescaped text
    under the mask), formatted_chars, and valid: the roles read back are a whole path of the state machine.
    """
    template = template or Template()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, out = None, []
        for begins, rows in _conversations(batches):
            if begins:
                if found:
                    out.append(done(found))
                if len(out) >= 1000:
                    yield framed(out)
                    out = []
                found = {"conv_id": rows[0][0], "n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "all": 0, "state": None, "valid": True, "reader": Reader(template)}
            for _, texts, losses in rows:
                for text, loss in zip(texts, losses, strict=True):
                    found["all"] += len(text)
                    if loss:
                        plain = template.unescape(text)
                        found["chars"] += len(plain)
                        found["loss"].update(plain.encode())
                for role, text in found["reader"].feed("".join(texts)):
                    found["n"] += 1
                    found["turns"].update(f"{role}\n{text}\n".encode())
                    found["valid"] &= role in template.after.get(found["state"], ())
                    found["state"] = role
        if found:
            yield framed([*out, done(found)])

    def framed(rows: list[tuple]) -> pd.DataFrame:
        columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
        return pd.DataFrame(rows, columns=columns).astype({"conv_id": "Int64"})

    def done(x: dict) -> tuple:
        if x["reader"].held:
            raise ValueError("the formatted text ends within a turn")
        return (x["conv_id"], x["n"], x["turns"].hexdigest(), x["chars"], x["loss"].hexdigest(), x["all"], x["valid"] and x["state"] in template.last)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
    return formatted.select("conv_id", "texts", "losses").mapInPandas(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return read_back(format_turns(rows.union(more)))


#: Escaped text is as long as the text, one more for each backslash and control string; the system prompt's rules are one row a transition.
SQL = r"""
WITH rows AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, t.turn, t.role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)
), steps AS (
    SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS next FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
), allowed(before, role) AS (
    VALUES ('', 'system'), ('', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user'), ('assistant', 'tool'), ('tool', 'assistant')
), checked AS (
    SELECT s.*, a.role IS NOT NULL AND (s.next IS NOT NULL OR s.role = 'assistant') AS fine,
        length(regexp_replace(s.text, '(\\|###|</turn>)', '\\\1', 'g')) + length(s.role) + length('### : </turn>') AS written
    FROM steps s LEFT JOIN allowed a ON a.before = coalesce(s.before, '') AND a.role = s.role
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(written) AS BIGINT) AS formatted_chars, bool_and(fine) AS valid
FROM checked GROUP BY conv_id
"""
