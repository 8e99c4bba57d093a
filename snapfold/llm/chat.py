"""Chat formatting with typed content parts.

A turn's content is a list of typed parts: text, image, audio, document.  A visitor
flattens them, in order, into one string: text is escaped, every other part becomes a
placeholder, and its attachment reference is recorded with its place and the number of
tokens that it will expand to.  A conversation is its turns in order:

    <s>[INST]role[/INST]content</s>

Control strings inside texts and roles are escaped reversibly: backslashes are doubled,
and a backslash is put behind the first character of every control string, so that no
control string is left.  Text parts that follow each other are escaped as the one text
they make, so a control string spread over several of them is found too.  `read_parts` takes a
formatted conversation apart again: into texts, whose parts are joined, and placeholders, which a
text that only looks like one is not taken for.

The loss mask is a list of [start, end) ranges of code points, one per text part of an
assistant turn.

Rows are ordered by turn, null first; ties by role, then by content.  Null text or parts:
empty content.  Null role: empty.  Rows without a conv_id form one conversation.  Repeated
rows are repeated turns.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, ROLE, SAID, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
PLACEHOLDERS = ("<image ", "<audio ", "<document ")
CONTROL = (OPEN, CLOSE, ROLE, SAID, *PLACEHOLDERS)
ASSISTANT = "assistant"

# Tokens an attachment expands to, by the measure its part carries.
IMAGE_PATCH = 14  # pixels of a patch's side, one token each
AUDIO_RATE = 25  # tokens a second
PAGE_TOKENS = 512  # tokens a page

_control = re.compile("|".join(map(re.escape, CONTROL)))
_turn = re.compile(
    f"{re.escape(OPEN)}{re.escape(ROLE)}(.*?){re.escape(SAID)}(.*?){re.escape(CLOSE)}", re.DOTALL
)

_placeholder = re.compile("<(image|audio|document) ([0-9]+)>")

PART = "struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
FORMATTED = (
    "conv_id {id}, n_turns bigint, formatted string, loss array<struct<start: bigint, end: bigint>>, "
    "attachments array<struct<kind: string, ref: string, at: bigint, tokens: bigint>>"
)


def escape(text: str) -> str:
    return _control.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def escape_parts(texts: list[str]) -> list[str]:
    """The escaped join of the texts, cut where they border."""
    whole = "".join(texts)
    # Behind which characters of the join a backslash more stands.
    added = sorted([m.start() for m in _control.finditer(whole)] + [m.start() for m in re.finditer(r"\\", whole)])
    out, at, done = [], 0, 0
    escaped = escape(whole)
    for text in texts:
        at += len(text)
        end = at + bisect.bisect_left(added, at)
        out.append(escaped[done:end])
        done = end
    return out


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


@dataclass
class Flattener:
    """Visits the parts of one conversation; holds what it has written so far."""

    pieces: list[str] = field(default_factory=list)
    length: int = 0
    turns: int = 0
    loss: list[dict] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def put(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)

    def turn(self, role: str | None, parts: list[dict]) -> None:
        self.turns += 1
        self.put(f"{OPEN}{ROLE}{escape(role or '')}{SAID}")
        for kind, run in groupby(parts, key=lambda part: part["type"]):
            visit = getattr(self, f"visit_{kind}", None)
            if visit is None:
                raise ValueError(f"unknown content part: {kind!r}")
            if kind == "text":
                visit(list(run), role == ASSISTANT)
            else:
                for part in run:
                    visit(part)
        self.put(CLOSE)

    def visit_text(self, parts: list[dict], learned: bool) -> None:
        for text in escape_parts([part["text"] or "" for part in parts]):
            start = self.length
            self.put(text)
            if learned:
                self.loss.append({"start": start, "end": self.length})

    def visit_image(self, part: dict) -> None:
        sides = [math.ceil((part[x] or 0) / IMAGE_PATCH) for x in ("width", "height")]
        self._attach("image", part, sides[0] * sides[1])

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil((part["seconds"] or 0) * AUDIO_RATE))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part["pages"] or 0) * PAGE_TOKENS)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append({"kind": kind, "ref": part["ref"], "at": self.length, "tokens": tokens})
        self.put(f"<{kind} {len(self.attachments)}>")

    def row(self, conv_id) -> dict:
        return {
            "conv_id": conv_id, "n_turns": self.turns, "formatted": "".join(self.pieces),
            "loss": self.loss, "attachments": self.attachments,
        }


def read_parts(formatted: str) -> list[tuple[str, list[tuple[str, str]]]]:
    """(role, parts) of every turn; a part is ("text", the text) or (its kind, the attachment's number)."""
    out = []
    for turn in _turn.finditer(formatted):
        # Escaped text holds no placeholder's beginning, so every one found is real.
        parts, at = [], 0
        for place in _placeholder.finditer(turn[2]):
            if place.start() > at:
                parts.append(("text", unescape(turn[2][at : place.start()])))
            parts.append((place[1], place[2]))
            at = place.end()
        if at < len(turn[2]):
            parts.append(("text", unescape(turn[2][at:])))
        out.append((unescape(turn[1]), parts))
    return out


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn; attachments are left out (`read_parts` has them)."""
    return [(role, "".join(x for kind, x in parts if kind == "text")) for role, parts in read_parts(formatted)]


def text_parts(text: Column) -> Column:
    """A plain text as the list of one text part; null: the empty list."""
    nothing = F.array().cast(f"array<{PART}>")
    part = F.struct(
        F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
    )
    return F.when(text.isNull(), nothing).otherwise(F.array(part))


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss, attachments.

    `turns` has conv_id, turn, role, and `parts` (an array of PART) or else `text`.
    One conversation is one training text and is put together by one task, in
    turn order; tasks hold one conversation at a time.
    """
    parts = F.col("parts") if "parts" in turns.columns else text_parts(F.col("text"))
    rows = turns.select("conv_id", "turn", "role", parts.alias("parts"))
    schema = FORMATTED.format(id=rows.schema["conv_id"].dataType.simpleString())
    # Parts as text break ties: structs with nulls need a total order.
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", F.col("parts").cast("string"))

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chat, done, size = None, None, [], 0
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in ("conv_id", "role", "parts")}
                if chat is None or row["conv_id"] != now:
                    if chat is not None:
                        done.append(chat.row(now))
                        size += chat.length
                    now, chat = row["conv_id"], Flattener()
                    if size > 4 << 20 or len(done) >= 2000:
                        yield pa.RecordBatch.from_pylist(done, schema=arrow)
                        done, size = [], 0
                chat.turn(row["role"], row["parts"] or [])
        if chat is not None:
            done.append(chat.row(now))
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=arrow)

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    attached = pa.list_(
        pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())])
    )
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = pa.schema(
        [("conv_id", to_arrow_type(rows.schema["conv_id"].dataType)), ("n_turns", pa.int64()),
         ("formatted", pa.string()), ("loss", span), ("attachments", attached)]
    )
    return rows.mapInArrow(put_together, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the output."""
    import hashlib

    conv_type = formatted.schema["conv_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {
                k: [] for k in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
            }
            for text, spans in zip(batch.column("formatted"), batch.column("loss"), strict=True):
                text = text.as_py()
                said = read_turns(text)
                learned = "".join(unescape(text[s["start"] : s["end"]]) for s in spans.as_py())
                whole = "".join(f"{role}\n{content}\n" for role, content in said)
                out["n_turns"].append(len(said))
                out["turns_sha256"].append(hashlib.sha256(whole.encode()).hexdigest())
                out["loss_chars"].append(len(learned))
                out["loss_sha256"].append(hashlib.sha256(learned.encode()).hexdigest())
                out["formatted_chars"].append(len(text))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = [batch.column("conv_id"), *(pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", *out])

    return formatted.select("conv_id", "formatted", "loss").mapInArrow(
        read,
        f"conv_id {conv_type}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
    )
