"""Chat formatting by event-sourced reconstruction.

A log of events is partitioned by conversation and sorted by message and sequence; the events of a message are folded
into its final text one after the other, so a task holds one message at a time. The messages of a partition are then
sorted by place and streamed as rendered fragments whose concatenation is the formatted conversation, so no task holds
a conversation, however long, and the log crosses the network once.

Events are `message` (starts a message with a text), `delta` (appends), `edit` (replaces the text), `regenerate` (drops
the text, later deltas give the new one) and `delete` (drops the message). Template of a turn:

    ### role: text </turn>\n

In roles and texts a backslash is put before each backslash, `#`, `<` and, in roles, `:`, so that neither `### ` nor
` </turn>` can stand in them and reading back is exact. The loss mask covers the escaped texts of assistant turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAD, ROLE_END, TURN_END = "### ", ": ", " </turn>\n"
LOSS_ROLE = "assistant"
_ROLE_UNSAFE, _TEXT_UNSAFE, _ESCAPED = re.compile(r"[\\#<:]"), re.compile(r"[\\#<]"), re.compile(r"\\(.)", re.S)
EVENTS = ("message", "delta", "edit", "regenerate", "delete")


def render(role: str, text: str) -> str:
    return HEAD + _ROLE_UNSAFE.sub(r"\\\g<0>", role) + ROLE_END + _TEXT_UNSAFE.sub(r"\\\g<0>", text) + TURN_END


def parse(formatted: str) -> tuple[list[tuple[str, str, int, int]], str]:
    """Turns (role, text, start and end of the escaped text) of the whole turns a string begins with, and the rest."""
    out, at = [], 0
    while (stop := _find(formatted, TURN_END, at)) >= 0:
        colon = _find(formatted, ROLE_END, at)
        start = colon + len(ROLE_END)
        if not formatted.startswith(HEAD, at) or not at < colon < start <= stop:
            raise ValueError(f"no turn at {at}")
        out.append((_ESCAPED.sub(r"\1", formatted[at + len(HEAD) : colon]), _ESCAPED.sub(r"\1", formatted[start:stop]), start, stop))
        at = stop + len(TURN_END)
    return out, formatted[at:]


def _find(text: str, mark: str, at: int) -> int:
    """Where a mark stands that no backslash escapes. Only its first character that is ever escaped need be looked at."""
    lead = len(mark) - len(mark.lstrip(" "))
    while (k := text.find(mark, at)) >= 0:
        inner, back = k + lead, 0
        while inner - back > 0 and text[inner - back - 1] == "\\":
            back += 1
        if back % 2 == 0:
            return k
        at = k + 1
    return -1


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, message_id, seq, event, role, text) -> (conv_id, place, message_id, role, text): final messages.

    place is the sequence number of a message's first event. Nulls: no text is an empty one, no role an empty one, a
    null event is `message`, a null seq comes first. Ties in seq go by event order above, then role and text; equal
    rows are events of their own. A message whose last word is `delete` is left out; a delta, edit or regeneration of
    a message that never started starts it. Rows of a conversation stay in one partition. Other columns are ignored; a
    message's text is held whole by one task, a conversation's never is. An empty log gives an empty table.
    """
    order = F.coalesce(F.array_position(F.array(*map(F.lit, EVENTS)), F.coalesce("event", F.lit("message"))), F.lit(0)).cast("int")
    rows = events.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("message_id").cast("string").alias("message_id"),
        F.col("seq").cast("long").alias("seq"),
        order.alias("event"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    keys = ["conv_id", "message_id"]
    rows = rows.repartition("conv_id").sortWithinPartitions(*keys, "seq", "event", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, place, role, parts, live = None, None, "", [], False
        done: list[tuple] = []
        for batch in batches:
            for conv, message, seq, event, who, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (conv, message) != key:
                    if live:
                        done.append((*key, place, role, "".join(parts)))
                    key, place, role, parts, live = (conv, message), seq, who, [], True
                if event == 5:
                    live, parts = False, []
                    continue
                if not live:
                    live, role = True, who
                if event == 2:
                    parts.append(text)
                else:
                    parts = [] if event == 4 else [text]
                role = who or role
            if done:
                yield _messages(done)
                done = []
        if live:
            done.append((*key, place, role, "".join(parts)))
        if done:
            yield _messages(done)

    return rows.mapInArrow(run, "conv_id long, message_id string, place long, role string, text string")


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = ["conv_id", "message_id", "place", "role", "text"], [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def fragments(messages: DataFrame, dealt: bool = False) -> DataFrame:
    """(conv_id, ordinal, at, fragment, loss_start, loss_end) in conversation order within each partition.

    fragment is a rendered turn, at its first code point in the conversation, loss_start and loss_end the masked code
    points of the conversation (equal for turns without loss). Messages of equal place go by role, text, message_id. dealt
    says that a conversation's messages are in one partition already, as fold() leaves them.
    """
    rows = (messages if dealt else messages.repartition("conv_id")).sortWithinPartitions("conv_id", "place", "role", "text", "message_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, ordinal, at = object(), 0, 0
        for batch in batches:
            out: list[tuple] = []
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 3, 4)), strict=True):
                if c != conv:
                    conv, ordinal, at = c, 0, 0
                turn = render(role, text)
                end = at + len(turn) - len(TURN_END)
                start = at + len(render(role, "")) - len(TURN_END) if role == LOSS_ROLE else end
                out.append((c, ordinal, at, turn, start, end))
                ordinal, at = ordinal + 1, at + len(turn)
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    ["conv_id", "ordinal", "at", "fragment", "loss_start", "loss_end"],
                )

    return rows.mapInArrow(run, "conv_id long, ordinal long, at long, fragment string, loss_start long, loss_end long")


def format_log(events: DataFrame) -> DataFrame:
    """fragments() of fold(): an empty log gives an empty table; columns beside those named are ignored."""
    return fragments(fold(events), dealt=True)


def digest(formatted: DataFrame) -> DataFrame:
    """What reads back from the fragments of format_log: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The fragments of a conversation are read as one stream: turns are parsed where they end, not where a fragment
    does, and masked code points are taken by their place in the conversation.
    """
    rows = formatted.select("conv_id", "ordinal", "fragment", "loss_start", "loss_end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: _Reader | None = None
        for batch in batches:
            done = []
            for conv, _, fragment, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or conv != state.conv:
                    done += [state.result()] if state else []
                    state = _Reader(conv)
                state.read(fragment, start, end)
            if done:
                yield _digests(done)
        if state:
            yield _digests([state.result()])

    # the rows come partitioned by conversation and sorted, as fragments() leaves them
    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


class _Reader:
    def __init__(self, conv: int | None):
        self.conv, self.turns, self.chars, self.loss = conv, 0, 0, 0
        self.all, self.masked, self.rest = hashlib.sha256(), hashlib.sha256(), ""

    def read(self, fragment: str, start: int, end: int) -> None:
        masked = _ESCAPED.sub(r"\1", fragment[start - self.chars : end - self.chars])
        self.loss += len(masked)
        self.masked.update(masked.encode("utf-8", "surrogatepass"))
        self.chars += len(fragment)
        turns, self.rest = parse(self.rest + fragment)
        for role, text, _, _ in turns:
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))

    def result(self) -> tuple:
        if self.rest:
            raise ValueError(f"conversation {self.conv} ends inside a turn")
        return self.conv, self.turns, self.all.hexdigest(), self.loss, self.masked.hexdigest(), self.chars


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def message_log(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) as a log of one `message` event a row; repeated rows are messages of their own."""
    own = F.monotonically_increasing_id().cast("string")
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        own.alias("message_id"),
        F.col("turn").cast("long").alias("seq"),
        F.lit("message").alias("event"),
        "role",
        "text",
    )


def streamed_log(conversations: DataFrame) -> DataFrame:
    """conversations as the log of a chat service that ends in the same messages.

    By turn a message is sent whole (0 of 4), streamed in thirds (1), drafted and edited (2), or drafted, streamed,
    regenerated and streamed again (3); every seventh turn one more message is sent and deleted. A message's events lie
    in the log from its turn on, among those of later messages.
    """
    text, turn = F.coalesce("text", F.lit("")), F.coalesce("seq", F.lit(0).cast("long"))
    third = F.ceil(F.char_length(text) / 3).cast("int")
    cut = lambda k: F.substring(text, third * k + 1, third)
    event = lambda k, kind, said: F.struct(F.lit("").alias("mark"), (F.col("seq") + k).alias("seq"), F.lit(kind).alias("event"), said.alias("text"))
    deltas = lambda first: [event(first + k, "delta", cut(k)) for k in range(3)]
    draft, none = F.lit("a draft </turn> that goes"), F.lit("")
    way = F.pmod(turn, F.lit(4))
    events = (
        F.when(way == 1, F.array(event(0, "message", none), *deltas(1)))
        .when(way == 2, F.array(event(0, "message", draft), event(5, "edit", text)))
        .when(way == 3, F.array(event(0, "message", draft), event(1, "delta", draft), event(2, "regenerate", none), *deltas(3)))
        .otherwise(F.array(event(0, "message", text)))
    )
    gone = F.transform(F.array(event(0, "message", draft), event(4, "delete", none)), lambda e: e.withField("mark", F.lit("gone")))
    events = F.concat(events, F.when(F.pmod(turn, F.lit(7)) == 0, gone).otherwise(F.slice(gone, 1, 0)))
    rows = message_log(conversations).select("conv_id", "message_id", "role", F.explode(events).alias("e"))
    return rows.select("conv_id", F.concat("message_id", "e.mark").alias("message_id"), "e.seq", "e.event", "role", "e.text")
