"""Event-sourced chat formatting: logs are partitioned by conversation, sorted by sequence, folded and rendered.

An event is (conv_id, seq, kind, message, role, text). Kinds: `message` starts a message; `delta` adds text to the one
it names, starting it if need be; `edit` replaces its text; `regenerate` drops what follows it and empties it, so that
later deltas write it anew; `delete` removes it. Events that name no message start their own (a delta then goes to the
last message). The rendered form marks turns; control characters inside texts and roles are escaped, reversibly, so no
text can forge a turn.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, small_batches

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>\n"
LEARNED = "assistant"
_OUT = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
_BACK = {"\\": "\\", "l": "<", "b": "["}
_CONTROL, _ESCAPED = re.compile(r"[\\<\[]"), re.compile(r"\\([\\lb])")
_RENDERED = re.compile(r"<\|turn\|>([^<]*)<\|says\|>([^<]*)<\|end\|>\n")


def escape(text: str) -> str:
    """No control string starts inside the result: it holds neither `<` nor `[`."""
    return _CONTROL.sub(lambda m: _OUT[m[0]], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m[1]], text)


def fold(events) -> list[list[str]]:
    """Final [role, text parts...] messages of one conversation's sorted (kind, message, role, text) events."""
    messages: list[list] = []
    by_name: dict = {}
    for kind, name, role, text in events:
        kind, text = kind or "message", text or ""
        at = by_name.get(name) if name is not None else (messages[-1] if kind != "message" and messages else None)
        if kind == "message" or (at is None and kind in ("delta", "edit")):
            at = [role or "", [text]]
            messages.append(at)
            if name is not None:
                by_name[name] = at
        elif at is None:
            continue
        elif kind == "delta":
            at[1].append(text)
        elif kind == "edit":
            at[1] = [text]
        else:
            k = next(i for i, m in enumerate(messages) if m is at)
            gone = messages[k + 1:] if kind == "regenerate" else [at]
            if kind == "regenerate":
                at[1] = [text]
            messages = [m for m in messages if not any(m is g for g in gone)]
            by_name = {n: m for n, m in by_name.items() if not any(m is g for g in gone)}
    return [[role, "".join(parts)] for role, parts in messages]


def render(messages: list[list[str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and its loss mask: spans of code points that hold assistant texts."""
    out, spans, at = [], [], 0
    for role, text in messages:
        head, body = f"{TURN}{escape(role)}{SAYS}", escape(text)
        if role == LEARNED:
            spans.append((at + len(head), at + len(head) + len(body)))
        out.append(f"{head}{body}{END}")
        at += len(out[-1])
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts read back from a formatted conversation."""
    found, at = [], 0
    for m in _RENDERED.finditer(formatted):
        if m.start() != at:
            raise ValueError("not a formatted conversation")
        found.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError("not a formatted conversation")
    return found


_OUT_SCHEMA = "conv_id long, formatted string, loss_spans array<array<long>>"
_ARROW = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("loss_spans", pa.list_(pa.list_(pa.int64())))])


def format_chats(events: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans.

    Null texts and roles count as empty, a null kind as `message`; a null conv_id is a conversation of its own; events
    without seq come first. Ties of seq are ordered by message, kind, role and text, so any partitioning gives the same
    result; repeated `message` events stay repeated turns. An empty log gives no rows; other columns are ignored. The fold streams over the
    sorted partition: a task holds one conversation's messages, which its output row holds anyway."""
    small_batches(events.sparkSession, 4096)
    logs = events.select("conv_id", "seq", "kind", "message", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "seq", "message", "kind", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, log, done, size = None, [], [], 0

        def flush():
            rows = [[k, *render(m)] for k, m in done]
            cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, _ARROW, strict=True)], schema=_ARROW)

        started = False
        for batch in batches:
            for conv, _, kind, message, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if started and conv != key:
                    done.append((key, fold(log)))
                    log = []
                    if size > 1 << 24:
                        yield flush()
                        size = 0
                started, key = True, conv
                log.append((kind, message, role, text))
                size += len(text or "")
        if started:
            done.append((key, fold(log)))
        if done:
            yield flush()

    return logs.mapInArrow(lean(run), _OUT_SCHEMA)


def from_turns(turns: DataFrame) -> DataFrame:
    """Events of finished turns: every row is a message of its own, in the order of `turn`."""
    return turns.select("conv_id", F.col("turn").alias("seq"), F.lit("message").alias("kind"), F.lit(None).cast("string").alias("message"), "role", "text")


_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader gets back from the formatted text and its mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                turns = parse(text)
                whole = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode("utf-8", "surrogatepass")).hexdigest()
                learned = "".join(unescape(text[a:b]) for a, b in spans)
                rows.append((conv, len(turns), whole, len(learned), hashlib.sha256(learned.encode("utf-8", "surrogatepass")).hexdigest(), len(text)))
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.mapInArrow(lean(run), _DIGESTS)
