"""Chat formatting from event logs.

A conversation is a log of events: ``start`` opens a message with its role,
``delta`` appends streamed text, ``edit`` replaces the text, ``regenerate`` throws
away what was streamed so far. Events are partitioned by conversation and
message, sorted by sequence and folded into final messages one row at a time, so
a conversation that holds a third of all events is folded by many tasks. Each
message is then rendered on its own: a formatted conversation is its segments in
order. Reading back streams through the segments of a conversation and keeps a
few counters and digests, never the whole text.

Template: ``[INST] text [/INST]`` for users, `` text </s>`` for assistants,
``<<SYS>>\\ntext\\n<</SYS>>`` for systems and ``[ROLE]name[/ROLE] text [/END]`` for any
other role. Inside names and texts a backslash is doubled and a control string
gets one after its first character (``[\\INST]``), so no control string survives
and the text can be told back exactly. Assistant texts are under the loss mask.

Defined cases: null text and null role count as empty; rows of equal turn are
ordered by role and text; repeated rows are separate messages; a null turn comes
first, a null conversation id is a conversation; an empty text is an empty
message; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CONTROLS = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[/END]", "<s>", "</s>")
DELTA_CHARS = 512
EVENTS = "conv_id long, turn long, tie int, seq long, kind string, role string, text string"
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_BATCH = 4096
#: role: text before, text after
TEMPLATE = {"user": ("[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("<<SYS>>\n", "\n<</SYS>>")}


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The segment of a message and the part of it under the loss mask (start, end)."""
    if role in TEMPLATE:
        head, tail = TEMPLATE[role]
    else:
        head, tail = f"[ROLE]{escape(role)}[/ROLE] ", " [/END]"
    body = escape(text)
    end = len(head) + len(body) if role == "assistant" else len(head)
    return head + body + tail, len(head), end


def parse(segment: str) -> tuple[str, str]:
    """Role and text of a segment."""
    for role, (head, tail) in TEMPLATE.items():
        if segment.startswith(head) and segment.endswith(tail) and len(segment) >= len(head) + len(tail):
            return role, unescape(segment[len(head):-len(tail)])
    name, _, rest = segment.removeprefix("[ROLE]").partition("[/ROLE] ")
    return unescape(name), unescape(rest.removesuffix(" [/END]"))


def event_log(conversations: DataFrame, *, chars: int = DELTA_CHARS) -> DataFrame:
    """The events behind stored turns: users send half a text and edit it to the whole,
    assistants stream half an answer, regenerate it and stream the whole, others stream."""
    of_turn = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.row_number().over(of_turn))
    size = F.char_length("text")
    pieces = F.greatest(F.ceil(size / chars), F.lit(1)).cast("int")
    half = F.floor(size / 2).cast("int")

    def event(seq, kind: str, text):
        return F.struct(seq.cast("long").alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))

    streamed = F.transform(F.sequence(F.lit(0), pieces - 1), lambda i: event(i + 3, "delta", F.substring(F.col("text"), i * chars + 1, F.lit(chars))))
    begun = F.array(event(F.lit(0), "start", F.lit("")), event(F.lit(1), "delta", F.substring(F.col("text"), F.lit(1), half)))
    events = F.when(F.col("role") == "user", F.concat(begun, F.array(event(F.lit(2), "edit", F.col("text"))))).when(
        F.col("role") == "assistant", F.concat(begun, F.array(event(F.lit(2), "regenerate", F.lit(""))), streamed)).otherwise(
        F.concat(F.array(event(F.lit(0), "start", F.lit(""))), streamed))
    return rows.select("conv_id", "turn", "tie", "role", F.explode(events).alias("e")).select(
        "conv_id", "turn", "tie", "e.seq", "e.kind", "role", "e.text")


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, role, parts, done = None, "", [], []

    def emit() -> pa.RecordBatch:
        rows = [(*k, *render(r, t)) for k, r, t in done]
        done.clear()
        columns = list(zip(*rows, strict=True)) or [()] * 6
        types = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                          names=["conv_id", "turn", "tie", "segment", "loss_start", "loss_end"])

    for batch in batches:
        for e in batch.to_pylist():
            this = (e["conv_id"], e["turn"], e["tie"])
            if this != key or e["kind"] == "start":
                if key is not None:
                    done.append((key, role, "".join(parts)))
                key, role, parts = this, e["role"] or "", []
            if e["kind"] in ("edit", "regenerate"):
                parts = []
            parts.append(e["text"] or "")
        if len(done) >= _BATCH:
            yield emit()
    if key is not None:
        done.append((key, role, "".join(parts)))
    yield emit()


def format_events(events: DataFrame) -> DataFrame:
    """Fold a log (``conv_id, turn, tie, seq, kind, role, text``) and render it: one row per
    message with ``conv_id, turn, tie, segment, loss_start, loss_end`` (code points in the segment)."""
    keys = ["conv_id", "turn", "tie"]
    dealt = events.select(*keys, "seq", "kind", "role", "text").repartition(*keys).sortWithinPartitions(*keys, "seq")
    return dealt.mapInArrow(_fold, "conv_id long, turn long, tie int, segment string, loss_start long, loss_end long")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, out = None, []

    def close() -> None:
        if current is not None:
            conv, n, turns, chars, loss, size = current
            out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))

    def emit() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 6
        out.clear()
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        for r in batch.to_pylist():
            if current is None or r["conv_id"] != current[0]:
                close()
                current = [r["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = parse(r["segment"])
            current[1] += 1
            current[2].update(f"{role}\n{text}\n".encode())
            masked = unescape(r["segment"][r["loss_start"]:r["loss_end"]])
            current[3] += len(masked)
            current[4].update(masked.encode())
            current[5] += len(r["segment"])
        if len(out) >= _BATCH:
            yield emit()
    close()
    yield emit()


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation what its formatted text says: turns, loss text, sizes."""
    dealt = segments.select("conv_id", "turn", "tie", "segment", "loss_start", "loss_end").repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "tie")
    return dealt.mapInArrow(_read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
