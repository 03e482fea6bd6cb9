"""Chat formatting: a role machine and a declarative template give segments with loss flags.

A template names the control strings, the segments of a turn and the turns that may
follow each other. The machine walks the turns of a conversation in order, marks a
turn that its predecessor does not allow and emits the segments of every turn; a
segment says whether it counts for the loss. Control strings inside texts are escaped
reversibly, so the output can be read back.
"""

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The control strings of the common chat mark-up.
START, END = "<|im_start|>", "<|im_end|>"


@dataclass(frozen=True)
class Template:
    """What a turn looks like and which turn may follow which.

    ``segments``: parts of a turn with their loss rule; ``{role}`` and ``{text}`` stand
    for the escaped values, the rule ``"loss_roles"`` flags the part for those roles.
    ``follows``: the roles allowed after a role, "" being the start.
    """

    segments: tuple = ((START + "{role}\n", False), ("{text}", "loss_roles"), (END + "\n", False))
    loss_roles: tuple = ("assistant",)
    follows: dict = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )


def escape(text: str) -> str:
    """Backslashes are doubled and ``<|`` is parted by one: no control string is left."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def escape_role(role: str) -> str:
    """As ``escape``; a line break, which ends a role, becomes backslash and n."""
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.S)


def turn_segments(template: Template, role: str, text: str) -> list[tuple[str, bool]]:
    """The segments of one turn; empty ones are left out."""
    out = []
    for shape, rule in template.segments:
        part = shape.replace("{role}", escape_role(role)) if "{role}" in shape else shape
        part = part.replace("{text}", escape(text)) if "{text}" in shape else part
        if part:
            out.append((part, role in template.loss_roles if rule == "loss_roles" else rule))
    return out


class RoleMachine:
    """Walks the roles of one conversation; a refused turn still becomes the state."""

    def __init__(self, template: Template):
        self.follows, self.state = template.follows, ""

    def step(self, role: str) -> bool:
        allowed = role in self.follows.get(self.state, ())
        self.state = role
        return allowed


_SEGMENTS = "conv_id bigint, position bigint, allowed boolean, segment string, loss boolean"


def format_chat(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, position, allowed, segment, loss``: the formatted text as segments in order.

    ``turns`` has ``conv_id, turn, role, text``; other columns are ignored. Rows go in
    order of turn, equal turns by role and text, null turns first. A null role or text
    counts as empty; rows with a null id form one conversation. Rows of a conversation
    are neighbours, in order, in one partition; the shuffle spreads the
    conversations, and a task streams its rows with one turn in memory, so a
    conversation may be of any length. An empty table gives no rows.
    """
    schema = pa.schema(
        [("conv_id", pa.int64()), ("position", pa.int64()), ("allowed", pa.bool_()), ("segment", pa.string()), ("loss", pa.bool_())]
    )

    def run(batches):
        current, machine, position = object(), None, 0
        for batch in batches:
            rows = []
            for conv, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if conv != current:
                    current, machine, position = conv, RoleMachine(template), 0
                allowed = machine.step(role)
                for segment, loss in turn_segments(template, role, text):
                    rows.append((conv, position, allowed, segment, loss))
                position += 1
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind.type) for column, kind in zip(zip(*rows), schema)], schema=schema
                )

    ordered = (
        turns.select(
            F.col("conv_id").cast("bigint").alias("conv_id"),
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )
    return ordered.mapInArrow(run, _SEGMENTS)


class _Reader:
    """Reads one conversation back from its formatted text, a segment at a time."""

    TURN = re.compile(
        re.escape(START) + r"(?P<role>[^\n]*)\n(?P<text>.*)" + re.escape(END) + r"\n", re.S
    )

    def __init__(self, conv):
        self.conv, self.buffer, self.allowed = conv, "", True
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def take(self, segment, loss, allowed):
        self.chars += len(segment)
        self.allowed &= allowed
        if loss:
            plain = unescape(segment)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode())
        self.buffer += segment
        # Escaped texts hold no control string, so this is the end of a turn.
        if segment.endswith(END + "\n"):
            turn = self.TURN.fullmatch(self.buffer)
            role, text = unescape_role(turn["role"]), unescape(turn["text"])
            self.all.update(f"{role}\n{text}\n".encode())
            self.turns += 1
            self.buffer = ""

    def row(self):
        return (
            self.conv, self.turns, self.all.hexdigest(), self.loss_chars,
            self.loss.hexdigest(), self.chars, self.allowed,
        )


_READ = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    "loss_sha256 string, formatted_chars bigint, order_valid boolean"
)


def read_back(segments: DataFrame) -> DataFrame:
    """One row per conversation from the output of ``format_chat`` (default template).

    ``n_turns``, ``turns_sha256`` over role, line break, text, line break of every turn
    as read from the formatted text, ``loss_chars`` and ``loss_sha256`` of the unescaped
    text under the loss flags, ``formatted_chars`` and ``order_valid``. It relies on the
    order of the rows and moves none. Digests are kept running, in constant memory.
    """
    schema = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
         ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("order_valid", pa.bool_())]
    )

    def out(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind.type) for column, kind in zip(zip(*rows), schema)], schema=schema
        )

    def run(batches):
        reader = None
        for batch in batches:
            done = []
            for conv, position, allowed, segment, loss in zip(*[c.to_pylist() for c in batch.columns]):
                if reader is None or conv != reader.conv:
                    if reader is not None:
                        done.append(reader.row())
                    reader = _Reader(conv)
                reader.take(segment, loss, allowed)
            if done:
                yield out(done)
        if reader is not None:
            yield out([reader.row()])

    return segments.select("conv_id", "position", "allowed", "segment", "loss").mapInArrow(run, _READ)
