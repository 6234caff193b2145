"""Chat formatting by incremental rendering.

A template is a black box that renders a list of turns. Successive prefixes
of a conversation are rendered; what one more turn appends is that turn's
span. A template whose output for a longer prefix does not start with its
output for the shorter one rewrites history, which is reported. The text
inside a span is found by rendering two probes in its place.

Long conversations go through in windows of ``WINDOW`` turns, each rendered
behind the window before it; a template is told the position of the first turn
it gets. Whenever a conversation has doubled, and at its end, all its turns are
rendered at once and compared with what the windows gave, so that the work
stays in proportion to the conversation. What a template rewrites farther back
than a window, and restores before the next such comparison, is not found.
"""

from __future__ import annotations

import hashlib
import os.path
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterloom.llm.batches import slices

Turn = tuple[str, str]
Template = Callable[[list[Turn], int], str]

WINDOW = 16

#: Strings that steer common chat models; never left whole inside a text.
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<\|im_start\|>((?:[^\\\n]|\\.)*)\n(.*?)<\|im_end\|>\n", re.DOTALL)

RESULT = (
    "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, rewrites_history boolean"
)


def escape(text: str) -> str:
    """A backslash doubles; one more goes behind the first character of every control string."""
    return _CONTROL.sub(lambda m: f"{m.group()[0]}\\{m.group()[1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def marked_turns(turns: list[Turn], first: int) -> str:
    """The built-in template: every turn between markers, its role on the first line."""
    return "".join(
        f"<|im_start|>{escape(role).replace('\n', '\\\n')}\n{escape(text)}<|im_end|>\n" for role, text in turns
    )


def read_turns(formatted: str) -> list[Turn]:
    """Roles and texts back from what ``marked_turns`` has rendered."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


@dataclass
class Span:
    """Where a turn and the text inside it stand in the output, ends exclusive."""

    start: int
    end: int
    text_start: int
    text_end: int


def turn_span(template: Template, turns: list[Turn], first: int, before: str, after: str) -> Span | None:
    """Span of the last turn, or None where the template has changed earlier output."""
    if not after.startswith(before):
        return None
    role = turns[-1][0]
    one, two = (template([*turns[:-1], (role, probe)], first) for probe in ("a", "b"))
    head = len(os.path.commonprefix([one, two]))
    tail = len(os.path.commonprefix([one[:head:-1], two[:head:-1]]))
    if head < len(before) or head + tail > len(after):
        return None
    return Span(len(before), len(after), head, len(after) - tail)


def render_window(template: Template, turns: list[Turn], first: int) -> tuple[str, list[Span | None]]:
    """Output for a window of turns, and the span of each."""
    spans, before = [], ""
    for size in range(1, len(turns) + 1):
        after = template(turns[:size], first)
        spans.append(turn_span(template, turns[:size], first, before, after))
        before = after
    return before, spans


@dataclass
class Window:
    """Output of a window of turns, the span of each in it, and whether earlier output was changed."""

    first: int
    turns: list[Turn]
    formatted: str
    spans: list[Span | None]

    @property
    def rewrites(self) -> bool:
        return None in self.spans


def render_after(template: Template, before: list[Turn], turns: list[Turn], first: int) -> Window:
    """A window of turns, rendered behind the turns before it; ``first`` is the position of its first turn."""
    start = template(before, first - len(before)) if before else ""
    spans, shorter = [], start
    for size in range(1, len(turns) + 1):
        prefix = [*before, *turns[:size]]
        longer = template(prefix, first - len(before))
        span = turn_span(template, prefix, first - len(before), shorter, longer)
        spans.append(span and Span(*(at - len(start) for at in (span.start, span.end, span.text_start, span.text_end))))
        shorter = longer
    if shorter.startswith(start):
        return Window(first, turns, shorter[len(start) :], spans)
    # The turns before are no longer what they were: the window by itself, without spans.
    return Window(first, turns, template(turns, first), [None] * len(turns))


class Conversation:
    """A conversation that comes turn by turn; holds its turns and their output."""

    def __init__(self, conv: int | None, template: Template):
        self.conv, self.template = conv, template
        self.turns: list[Turn] = []
        self.windows: list[Window] = []
        self.checked = 0

    def add(self, role: str, text: str) -> None:
        self.turns.append((role, text))
        if len(self.turns) % WINDOW == 0:
            self.flush()
            if len(self.windows) >= 2 * self.checked:
                self.check()

    def flush(self) -> None:
        first = len(self.windows) * WINDOW
        before = self.turns[max(0, first - WINDOW) : first]
        self.windows.append(render_after(self.template, before, self.turns[first:], first))

    def check(self) -> None:
        """Compare with all turns rendered at once; from the first difference on, no span holds."""
        self.checked = len(self.windows)
        if len(self.windows) == 1:
            return
        formatted = "".join(window.formatted for window in self.windows)
        whole = self.template(self.turns, 0)
        if whole == formatted:
            return
        same, at = len(os.path.commonprefix([whole, formatted])), 0
        for window in self.windows:
            at += len(window.formatted)
            if at > same or window is self.windows[-1]:
                window.spans = [None] * len(window.turns)

    def finished(self) -> list[Window]:
        if len(self.turns) % WINDOW:
            self.flush()
        if self.checked < len(self.windows):
            self.check()
        return self.windows

    def result(self) -> dict:
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n_turns = loss_chars = formatted_chars = 0
        windows = self.finished()
        for window in windows:
            read = read_turns(window.formatted)
            formatted_chars += len(window.formatted)
            n_turns += len(read)
            for role, text in read:
                turns.update(f"{role}\n{text}\n".encode())
            for (role, _), span in zip(window.turns, window.spans):
                if role == "assistant" and span:
                    trained = unescape(window.formatted[span.text_start : span.text_end])
                    loss_chars += len(trained)
                    loss.update(trained.encode())
        return {
            "conv": self.conv,
            "n_turns": n_turns,
            "turns_sha256": turns.hexdigest(),
            "loss_chars": loss_chars,
            "loss_sha256": loss.hexdigest(),
            "formatted_chars": formatted_chars,
            "rewrites_history": any(window.rewrites for window in windows),
        }


RESULT_SCHEMA = pa.schema(
    [
        ("conv", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("rewrites_history", pa.bool_()),
    ]
)


def conversations_in_batches(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done = None, []
        for batch in slices(batches, 1024):
            for conv, role, text in zip(*(batch[name].to_pylist() for name in ("conv", "role", "text"))):
                if current is None or current.conv != conv:
                    if current is not None:
                        done.append(current.result())
                    current = Conversation(conv, template)
                current.add(role or "", text or "")
            if done:
                yield pa.RecordBatch.from_pylist(done, RESULT_SCHEMA)
                done = []
        if current is not None:
            yield pa.RecordBatch.from_pylist([current.result()], RESULT_SCHEMA)

    return run


def windows_in_batches(template: Template):
    """Each window of turns as a row of formatted text with the spans of its loss mask."""

    def rows(conversation: Conversation) -> Iterator[dict]:
        for window in conversation.finished():
            trained = [span for (role, _), span in zip(window.turns, window.spans) if role == "assistant" and span]
            yield {
                "conv": conversation.conv,
                "first_turn": window.first,
                "formatted": window.formatted,
                "loss_spans": [{"start": s.text_start, "end": s.text_end} for s in trained],
                "rewrites_history": window.rewrites,
            }

    kind = pa.schema(
        [
            ("conv", pa.int64()),
            ("first_turn", pa.int64()),
            ("formatted", pa.string()),
            ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ("rewrites_history", pa.bool_()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for batch in slices(batches, 1024):
            done = []
            for conv, role, text in zip(*(batch[name].to_pylist() for name in ("conv", "role", "text"))):
                if current is None or current.conv != conv:
                    done += rows(current) if current is not None else ()
                    current = Conversation(conv, template)
                current.add(role or "", text or "")
            if done:
                yield pa.RecordBatch.from_pylist(done, kind)
        if current is not None:
            yield pa.RecordBatch.from_pylist(list(rows(current)), kind)

    return run


def _ordered(df: DataFrame) -> DataFrame:
    """Turns of a conversation one after another in one partition, sorted outside Python."""
    rows = df.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")


def format_conversations(df: DataFrame, template: Template = marked_turns) -> DataFrame:
    """Formatted text and loss spans (code points) per window of turns.

    Needs columns conv_id, turn, role, text; others are ignored. Turns go by
    ``turn``; equal ones by role, then text, repeated rows stay. A missing
    role or text is empty, a missing conv_id is a conversation of its own, a
    missing turn comes first. ``loss_spans`` mark the texts of assistants.
    ``rewrites_history`` tells that the template changed what it had rendered
    for a shorter prefix, or renders the whole conversation otherwise than its
    windows; such turns get no span. Memory: a conversation and its output.
    """
    schema = (
        "conv long, first_turn long, formatted string, "
        "loss_spans array<struct<start:long,end:long>>, rewrites_history boolean"
    )
    found = _ordered(df).mapInArrow(windows_in_batches(template), schema)
    return found.withColumnRenamed("conv", "conv_id")


def conversation_digests(df: DataFrame, template: Template = marked_turns) -> DataFrame:
    """One row per conversation with digests read back from the formatted output.

    Rows are taken as by ``format_conversations``; the template must render
    what ``read_turns`` reads, from which turns are also counted. A task holds
    one conversation and its output.
    """
    found = _ordered(df).mapInArrow(conversations_in_batches(template), RESULT)
    return found.withColumnRenamed("conv", "conv_id")
