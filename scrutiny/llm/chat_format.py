"""Conversations as budgeted training windows with a loss mask.

A turn is written as ``<s>[role] text </s>`` and a line end. Control strings inside roles and
texts get a backslash after their first character and backslashes are doubled, so a window
can be read back without loss and no text can pose as a turn.

Windows. The running sums of the turns' tokens choose spans of whole turns: each window takes
as many new turns as its budget holds beside the system turn and the last ``history`` turns
before them, which are repeated for context (fewer of them, the oldest dropped first, where the
next turn would not fit). Tokens are those of the turns as they are written. Only assistant
texts that are new in a window are under its loss mask; repeated ones are masked out, so over
all windows each assistant text counts once, in order. A turn that doesn't fit the budget
beside the system turn gets a window of its own with it, the only kind of window over it.

Turns are dealt by conversation and read in order; a task holds one window at a time, so a
conversation of any length needs no more memory than its largest window. (Its digest is
sequential by definition, so one task has to read it.)

Defined results: a null text or role is empty; turns with equal numbers are ordered by role
and text and all kept; rows without a conversation form one of their own; an empty table gives
no window. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutiny.llm.common import partitions, text_slices, texts_of
from scrutiny.llm.encoding import encoder

#: Fixed values of the template.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
CONTROLS = re.compile("|".join(map(re.escape, CONTROL)))
TURN = re.compile(r"<s>\[((?:[^\]\\]|\\.)*)\] (.*?) </s>\n", re.DOTALL)
WINDOWS = ("conv_id bigint, window long, formatted string, n_repeated int, n_tokens bigint, "
           "loss array<struct<start:bigint,stop:bigint>>")


def escaped(text: str) -> str:
    return CONTROLS.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def head(role: str) -> str:
    return "<s>[" + escaped(role).replace("]", "\\]") + "] "


def written(role: str, text: str) -> str:
    return head(role) + escaped(text) + " </s>\n"


@dataclass
class Turn:
    role: str
    text: str
    tokens: int


@dataclass
class Windows:
    """Collects the turns of one conversation and gives out full windows."""

    budget: int
    history: int
    number: int = 0
    system: Turn | None = None
    recent: list[Turn] = field(default_factory=list)  # the last turns given out
    repeated: list[Turn] = field(default_factory=list)  # context of the open window
    new: list[Turn] = field(default_factory=list)
    used: int = 0  # running sum of the open window's tokens

    def context(self, turn: Turn) -> list[Turn]:
        """What a window that starts with ``turn`` repeats: history up to half the budget, that fits."""
        if not self.number:
            return []
        fits = self.budget - turn.tokens - (self.system.tokens if self.system else 0)
        out, room = [], self.budget // 2 - (self.system.tokens if self.system else 0)
        room = min(room, fits)
        for old in reversed(self.recent):
            room -= old.tokens
            if room < 0 or old is self.system:
                break
            out.insert(0, old)
        return [self.system, *out] if self.system else out

    def add(self, turn: Turn) -> Iterator[dict]:
        if self.new and self.used + turn.tokens > self.budget:
            yield self.window()
        if not self.new:
            self.repeated = self.context(turn)
            self.used = sum(t.tokens for t in self.repeated)
        if not self.number and not self.new and turn.role == "system":
            self.system = turn
        self.new.append(turn)
        self.used += turn.tokens

    def window(self) -> dict:
        repeated = self.repeated
        parts, loss, at = [], [], 0
        for k, turn in enumerate([*repeated, *self.new]):
            start, body = head(turn.role), escaped(turn.text)
            if k >= len(repeated) and turn.role == "assistant":
                loss.append({"start": at + len(start), "stop": at + len(start) + len(body)})
            parts += [start, body, " </s>\n"]
            at += len(start) + len(body) + 6
        out = {"window": self.number, "formatted": "".join(parts), "n_repeated": len(repeated),
               "n_tokens": self.used, "loss": loss}
        self.recent = [*self.recent, *self.new][-self.history:] if self.history else []
        self.new, self.number = [], self.number + 1
        return out


def format_windows(turns: DataFrame, tokenizer: str, budget: int = 1024, history: int = 2) -> DataFrame:
    """A row for each window: ``conv_id, window, formatted, n_repeated, n_tokens, loss``.

    ``loss`` holds spans of code points of ``formatted``.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in text_slices(batches, "text"):
            roles = texts_of(batch, "role")
            n = enc.lengths([written(r, t) for r, t in zip(roles, texts_of(batch))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())],
                                             ["conv_id", "turn", "role", "text", "tokens"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: Windows | None = None
        conv: tuple | None = None
        for batch in text_slices(batches, "text"):
            out: list[dict] = []
            for key, role, text, tokens in zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id", "role", "text", "tokens"))):
                if conv != (key,):
                    if open_ is not None:
                        out.append(open_.window() | {"conv_id": conv[0]})
                    open_, conv = Windows(budget, history), (key,)
                out += [w | {"conv_id": key} for w in open_.add(Turn(role or "", text or "", tokens))]
            yield window_batch(out)
        if open_ is not None:
            yield window_batch([open_.window() | {"conv_id": conv[0]}])

    each = turns.select(*(F.col(c).cast(k).alias(c) for c, k in (
        ("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string"))))
    return (each.mapInArrow(count, "conv_id bigint, turn bigint, role string, text string, tokens bigint")
            .repartition(partitions(turns.sparkSession), "conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(fill, WINDOWS))


def window_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema([
        ("conv_id", pa.int64()), ("window", pa.int64()), ("formatted", pa.string()),
        ("n_repeated", pa.int32()), ("n_tokens", pa.int64()),
        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]))


def parsed(formatted: str) -> list[tuple[str, str]]:
    """The turns of a window."""
    out, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"not a turn: {formatted[at:at + 60]!r}")
        out.append((unescaped(m[1]), unescaped(m[2])))
        at = m.end()
    return out


class Digest:
    """What a conversation's windows hold, read in order."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, n_repeated: int, loss: list[dict]) -> None:
        for role, text in parsed(formatted)[n_repeated:]:
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        for span in loss:
            text = unescaped(formatted[span["start"]:span["stop"]])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.chars += len(formatted)

    def row(self, conv_id) -> dict:
        return {"conv_id": conv_id, "n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(),
                "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(),
                "formatted_chars": self.chars}


def read_digests(windows: DataFrame) -> DataFrame:
    """What each conversation's windows say, read back from the written text alone."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Digest | None = None
        conv: tuple | None = None
        for batch in text_slices(batches, "formatted"):
            out = []
            for r in batch.to_pylist():
                if conv != (r["conv_id"],):
                    if now is not None:
                        out.append(now.row(conv[0]))
                    now, conv = Digest(), (r["conv_id"],)
                now.add(r["formatted"], r["n_repeated"], r["loss"])
            yield digest_batch(out)
        if now is not None:
            yield digest_batch([now.row(conv[0])])

    return (windows.select("conv_id", "window", "formatted", "n_repeated", "loss")
            .repartition(partitions(windows.sparkSession), "conv_id")
            .sortWithinPartitions("conv_id", "window")
            .mapInArrow(rows, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                              "loss_sha256 string, formatted_chars bigint"))


def digest_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]))


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -1, whose texts are made of control strings."""
    text = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)],
                                 "conv_id bigint, turn bigint, role string, text string")
