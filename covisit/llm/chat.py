"""Chat formatting whose output a deterministic parser reads back to the same turns.

    conversation = turn*        turn = "<|im_start|>" role "\\n" text "<|im_end|>" "\\n"

A turn is rendered as it is, parsed, and compared with its source; where they differ, its role and
text are escaped once more. Escaping puts a backslash into each "<", backslashes, "|" and, in roles,
before a line feed or backslash; unescaping takes one out, so texts that hold no such string, nearly
all, stay as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values of the template
START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """Role, text, and the place of the text (still escaped) of each turn; ValueError if it isn't a conversation."""
    turns, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if not m or any(x in part for x in (START, END) for part in m.groups()):
            raise ValueError(f"no turn at {at}")
        turns.append((_unescape_role(m[1]), unescape(m[2]), m.start(2), m.end(2)))
        at = m.end()
    return turns


def render_turn(role: str, text: str) -> str:
    """The turn in a form that parses back to it."""
    shown_role, shown = role, text
    while True:
        piece = f"{START}{shown_role}\n{shown}{END}\n"
        try:
            back = [t[:2] for t in parse(piece)]
        except ValueError:
            back = []
        if back == [(role, text)]:
            return piece
        if shown_role != role or shown != text:
            raise AssertionError("an escaped turn reads back as it was")
        shown_role, shown = _escape_role(role), escape(text)


_PIECES = "conv_id long, place long, piece string, start long, loss_start long, loss_end long"


def format_conversations(conversations: DataFrame) -> DataFrame:
    """A row for each turn, in its place: ``piece``, its ``start`` in the conversation's formatted text (the
    pieces in a row), and from ``loss_start`` to ``loss_end`` what is under the loss mask (null for other roles).

    Turns are ordered by turn, then role and text; a null text or role is empty, null ids are one
    conversation. Rows of a conversation come sorted and are streamed, so no conversation is held in memory.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, place, at = object(), 0, 0
        for batch in batches:
            out = []
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv_id != current:
                    current, place, at = conv_id, 0, 0
                piece = render_turn(role, text)
                _, _, a, b = parse(piece)[0]
                mask = (at + a, at + b) if role == LOSS_ROLE else (None, None)
                out.append((conv_id, place, piece, at, *mask))
                place, at = place + 1, at + len(piece)
            columns = zip(*out) if out else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.string()] + [pa.int64()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in _PIECES.split(", ")])

    return rows.mapInArrow(run, _PIECES)


_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(pieces: DataFrame) -> DataFrame:
    """What a reader of the formatted text finds, per conversation: counts and digests of turns and of masked text."""
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def closed() -> pa.RecordBatch:
            row = (current, state["turns"], state["all"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["size"])
            return pa.RecordBatch.from_pylist([dict(zip([x.split()[0] for x in _DIGESTS.split(", ")], row))], schema=kinds)

        kinds = pa.schema([(x.split()[0], pa.int64() if x.endswith("long") else pa.string()) for x in _DIGESTS.split(", ")])
        for batch in batches:
            for conv_id, piece, start, a, b in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "piece", "start", "loss_start", "loss_end"))):
                if state is None or conv_id != current:
                    if state is not None:
                        yield closed()
                    current, state = conv_id, {"turns": 0, "chars": 0, "size": 0, "all": hashlib.sha256(), "loss": hashlib.sha256()}
                for role, text, _, _ in parse(piece):
                    state["turns"] += 1
                    state["all"].update(f"{role}\n{text}\n".encode())
                state["size"] += len(piece)
                if a is not None:
                    masked = unescape(piece[a - start : b - start])
                    state["chars"] += len(masked)
                    state["loss"].update(masked.encode())
        if state is not None:
            yield closed()

    return ordered.mapInArrow(run, _DIGESTS)
