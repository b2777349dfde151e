"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) to a string. Successive prefixes of a conversation are rendered; what a
prefix adds to the one before is its last turn's span. A prefix that does not begin with the output before it shows a template
that rewrites history. Where the text stands inside a span is found by rendering the turn with probe texts.
"""

from __future__ import annotations

import hashlib
import math
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Template = Callable[[list[tuple[str, str]]], str]
# Every prefix is rendered whole up to so many turns, as long as the prefixes of a conversation have not more characters than this.
WHOLE_TURNS = 256
WHOLE_CHARS = 1 << 22
# From there on a conversation is rendered in windows of so many turns, each begun with its first turn and the turn before it.
WINDOW = 32
START, MIDDLE, END = "### ", ": ", "</turn>\n"
_ESCAPES = {"\\": "\\\\", "#": "\\h", "<": "\\l", ":": "\\c", "\n": "\\n"}
_BACK = {v: k for k, v in _ESCAPES.items()}
_IN_TEXT = str.maketrans({k: _ESCAPES[k] for k in "\\#<"})
_IN_ROLE = str.maketrans(_ESCAPES)


def escape(text: str) -> str:
    """No control string can stand in the result."""
    return text.translate(_IN_TEXT)


def unescape(text: str) -> str:
    return re.sub(r"\\.", lambda m: _BACK.get(m[0], m[0]), text, flags=re.S)


class Turn(tuple):
    """(role, text) with room for a template to keep what it makes of the turn; that goes with the conversation."""

    formatted: str | None = None


def _format(message: tuple[str, str]) -> str:
    known = getattr(message, "formatted", None)
    if known is None:
        role, text = message
        known = f"{START}{role.translate(_IN_ROLE)}{MIDDLE}{escape(text)}{END}"
        if isinstance(message, Turn):
            message.formatted = known
    return known


def turn_template(messages: list[tuple[str, str]]) -> str:
    """``### role: text</turn>`` and a line end for every turn; control strings inside are escaped reversibly."""
    return "".join(map(_format, messages))


@dataclass(frozen=True)
class Span:
    """A turn's part of the output: its text, where that begins, and the bounds of the message text in it."""

    piece: str
    start: int
    text_start: int
    text_end: int


class RewritesHistory(ValueError):
    """A longer prefix changed the output of a shorter one."""


def spans(
    messages: Iterator[tuple[str, str]] | list[tuple[str, str]],
    template: Template,
    whole_turns: float = WHOLE_TURNS,
    whole_chars: float = WHOLE_CHARS,
) -> Iterator[Span]:
    """Spans of successive turns.

    Up to ``whole_turns`` turns (where the prefixes come to more than ``whole_chars`` characters: up to WINDOW turns) each prefix is
    rendered whole, so any template that changes an earlier part raises, and turns may depend on all before them; with both
    infinite, as ``render`` asks, that holds at every length, and work grows with the square of a conversation. Of longer ones
    only the first turn, the turn before and a window are held. That a template renders a turn alike behind these is then checked at
    every window by rendering the turn in both places; one that does not raises as well.
    """
    held: list[tuple[str, str]] = []
    whole, rendered = True, 0
    done = template([])
    at = len(done)
    for message in map(Turn, messages):
        longest = whole_turns if whole and rendered <= whole_chars else WINDOW
        if len(held) > max(longest, 2):
            before = template(held[:-1])
            head, both = template(held[:1]), template([held[0], held[-1]])
            if not both.startswith(head) or done[len(before) :] != both[len(head) :]:
                raise RewritesHistory("a turn is rendered differently in another place")
            held, done, whole = [held[0], held[-1]], both, False
        longer = template([*held, message])
        if not longer.startswith(done):
            raise RewritesHistory("a longer prefix changes the output before it")
        piece = longer[len(done) :]
        probes = [template([*held, (message[0], t)])[len(done) :] for t in ("A", "B")]
        head_chars = len(os.path.commonprefix(probes))
        tail = len(probes[0]) - head_chars - 1
        yield Span(piece, at, at + head_chars, at + len(piece) - tail)
        at += len(piece)
        rendered += len(longer)
        held.append(message)
        done = longer


def render(conversations: DataFrame, template: Template = turn_template, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per turn, in order inside its partition: (conv_id, turn_no, piece, start, text_start, text_end, loss).

    The pieces of a conversation, put together, are its formatted text; positions are code points of that text. Turns are ordered
    by turn (null first), then role and text; each prefix is rendered whole, whatever a conversation's length. Null roles and
    texts are empty; rows without conv_id are one conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _by_key(batches, "conv_id"):
            out: list = []
            turns = ((r["role"] or "", r["text"] or "") for r in rows)
            roles: list[str] = []

            def noted():
                for role, text in turns:
                    roles.append(role)
                    yield role, text

            for number, s in enumerate(spans(noted(), template, math.inf, math.inf)):
                out.append((key, number, s.piece, s.start, s.text_start, s.text_end, roles[-1] in loss_roles))
                if len(out) >= 512:
                    yield _turn_batch(out)
                    out = []
            if out:
                yield _turn_batch(out)

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(
        run, "conv_id bigint, turn_no bigint, piece string, start bigint, text_start bigint, text_end bigint, loss boolean"
    )


def _turn_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
    names = ["conv_id", "turn_no", "piece", "start", "text_start", "text_end", "loss"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def _by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, Iterator[dict]]]:
    """Successive runs of equal keys over sorted batches, read as a stream."""

    def flat():
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                yield from batch.slice(at, 512).to_pylist()

    rows = flat()
    ahead = next(rows, None)
    while ahead is not None:
        now = ahead[key]

        def group():
            nonlocal ahead
            while ahead is not None and ahead[key] == now:
                row, ahead = ahead, next(rows, None)
                yield row

        own = group()
        yield now, own
        for _ in own:  # what the reader left
            pass


def read_back(rendered: DataFrame) -> DataFrame:
    """Parse the formatted text of every conversation and digest what it says.

    Needs ``render``'s order. (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars): turns are read from
    the text alone, the loss text is cut out of it by the mask's positions and unescaped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _by_key(batches, "conv_id"):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n = loss_chars = length = 0
            text, at = "", 0  # what is not parsed yet, and where it begins
            for r in rows:
                text += r["piece"]
                length += len(r["piece"])
                if r["loss"]:
                    told = unescape(text[r["text_start"] - at : r["text_end"] - at])
                    loss.update(told.encode("utf-8", "surrogatepass"))
                    loss_chars += len(told)
                while (end := text.find(END)) >= 0:
                    role, _, body = text[len(START) : end].partition(MIDDLE)
                    turns.update(f"{unescape(role)}\n{unescape(body)}\n".encode("utf-8", "surrogatepass"))
                    n += 1
                    at += end + len(END)
                    text = text[end + len(END) :]
            if text:
                raise ValueError("the formatted text ends inside a turn")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key], pa.int64()),
                    pa.array([n], pa.int64()),
                    pa.array([turns.hexdigest()]),
                    pa.array([loss_chars], pa.int64()),
                    pa.array([loss.hexdigest()]),
                    pa.array([length], pa.int64()),
                ],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return rendered.mapInArrow(
        run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )
