"""Chat formatting with a template that is only ever called, and spans read off its outputs."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import pick

Turn = tuple[str, str]
Template = Callable[[Sequence[Turn]], str]


def escape(text: str) -> str:
    """Text in which ``<|`` can't occur; ``unescape`` gives the text back."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def escape_role(role: str) -> str:
    """A role on one line."""
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.S)


def chatml(turns: Sequence[Turn]) -> str:
    """``<|im_start|>role``, the text and ``<|im_end|>`` for each turn."""
    return "".join([f"<|im_start|>{escape_role(r)}\n{escape(t)}<|im_end|>\n" for r, t in turns])


@dataclass(frozen=True)
class Span:
    """A turn in the output: where it starts, where its text does, where that ends, and the turn."""

    start: int
    text_start: int
    text_end: int
    end: int


@dataclass(frozen=True)
class Rendered:
    """The output for a conversation, a span per turn, and the first turn that rewrote history."""

    output: str
    spans: tuple[Span, ...]
    rewritten_at: int | None


def _common(a: str, b: str) -> int:
    """Length of the longest common prefix, by halving."""
    if a == b:
        return len(a)
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a.startswith(b[:mid]):
            lo = mid
        else:
            hi = mid - 1
    return lo


def render(turns: Sequence[Turn], template: Template = chatml) -> Rendered:
    """Render each prefix of the turns and compare consecutive outputs.

    What an output adds to the one before is the span of its last turn. Two further outputs, with the
    last text replaced by one letter or another, first differ where that text starts; what follows
    the letter is as long as what follows the text. A template may keep nothing or change anything: an
    output that doesn't begin with the one before has rewritten history, and its number is reported.
    The spans of the turns before it then no longer hold, and none are given.
    """
    before, spans, rewritten = template(()), [], None
    for i in range(len(turns)):
        role = turns[i][0]
        output = template(turns[:i + 1])
        if rewritten is None and not output.startswith(before):
            rewritten = i
        if rewritten is None:
            probes = [template([*turns[:i], (role, letter)]) for letter in "xy"]
            head = _common(*probes)
            tail = len(probes[0]) - head - 1
            spans.append(Span(len(before), head, len(output) - tail, len(output)))
        before = output
    return Rendered(before, tuple(spans) if rewritten is None else (), rewritten)


def conversations(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, turns): the rows of each conversation by turn; of equal turns, by role and text.

    A null text or role is empty; a null turn comes first. What one task holds of a conversation is
    what its formatted text holds.
    """
    picked = pick(rows, key=key, turn=turn, role=role, text=text)
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return picked.groupBy("key").agg(F.array_sort(F.collect_list(one)).alias("turns")).select(F.col("key").alias(key), "turns")


_SPAN = pa.struct([(n, pa.int64()) for n in ("start", "text_start", "text_end", "end")] + [("loss", pa.bool_())])


def format_chats(chats: DataFrame, key: str = "conv_id", template: Template = chatml,
                 trained: Sequence[str] = ("assistant",)) -> DataFrame:
    """(key, formatted, spans, rewritten_at) for each conversation (key, turns).

    A span has start, text_start, text_end, end (code points of ``formatted``, ends exclusive) and
    loss, whether its role is ``trained``: the loss mask is the text of those spans. ``rewritten_at``
    is the first turn at which the template rewrote history, else null. No turns: the template's
    output for none. Rendering takes time with the square of a conversation's turns.
    """
    picked = pick(chats, key=key, turns="turns")
    kind = picked.schema["key"].dataType.simpleString()
    schema = f"key {kind}, formatted string, spans array<struct<start long, text_start long, text_end long, end long, loss boolean>>, rewritten_at long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                done, spans = [], []
                for turns in part.column(1).to_pylist():
                    given = [(t["role"], t["text"]) for t in turns]
                    r = render(given, template)
                    done.append(r)
                    spans.append([
                        {"start": s.start, "text_start": s.text_start, "text_end": s.text_end, "end": s.end, "loss": g[0] in trained}
                        for s, g in zip(r.spans, given)
                    ])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([r.output for r in done], pa.string()),
                     pa.array(spans, pa.list_(_SPAN)), pa.array([r.rewritten_at for r in done], pa.int64())],
                    ["key", "formatted", "spans", "rewritten_at"],
                )

    return picked.mapInArrow(run, schema).withColumnRenamed("key", key)
