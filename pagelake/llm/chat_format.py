"""Chat formatting by incremental rendering of a template that is treated as a black box.

A template is a function from turns to one string. The prefixes of a conversation are rendered one after the
other; where each output extends the one before, what it adds is the new turn's span. An output that does not
extend the one before shows a template that rewrites history: such a conversation gets no spans and no loss.
Where a turn's text lies inside its span is found in the same way, by rendering the turn with two
one-character texts: what both share before and after is the template's.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import slices

Turn = tuple[str, str]  # role, text
Render = Callable[[Sequence[Turn]], str]

# The strings that have a meaning in the default template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
# Escaping puts one backslash more after a control string's first character than the text has there.
_ESCAPE = re.compile("|".join(rf"(?<={re.escape(c[0])})(?=\\*{re.escape(c[1:])})" for c in CONTROLS))
_UNESCAPE = re.compile("|".join(rf"(?<={re.escape(c[0])})\\(?=\\*{re.escape(c[1:])})" for c in CONTROLS))
LOSS_ROLES = ("assistant",)
# Two texts of one character that no template treats as white space or markup.
PROBES = ("x", "y")
BATCH_CHARS = 4 << 20
# Turns that the default template remembers.
TURNS = 1 << 14


def escape(text: str) -> str:
    """``text`` without control strings; ``unescape`` gives it back."""
    return _ESCAPE.sub(r"\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub("", text)


@lru_cache(TURNS)
def marked_turn(role: str, text: str) -> str:
    text = escape(text)
    if role == "user":
        return f"<s>[INST] {text} [/INST]"
    if role == "assistant":
        return f" {text}</s>"
    if role == "system":
        return f"<s><<SYS>>\n{text}\n<</SYS>>\n\n"
    return f"<s>[ROLE]{escape(role)}[/ROLE] {text}</s>"


def default_template(turns: Sequence[Turn]) -> str:
    """``<s>[INST] … [/INST]`` for users, `` …</s>`` for assistants, marked system and other turns, in any order.

    Turns are marked once and remembered, as every prefix of a conversation holds the turns before.
    """
    return "".join([marked_turn(role, text) for role, text in turns])


_READ = re.compile(
    r"<s>\[INST\] (?P<user>.*) \[/INST\]|<s><<SYS>>\n(?P<system>.*)\n<</SYS>>\n\n|<s>\[ROLE\](?P<role>.*?)\[/ROLE\] (?P<other>.*)</s>| (?P<assistant>.*)</s>", re.S)


def read_turn(span: str) -> Turn:
    """Role and text of one turn of the default template, from its span of the output."""
    found = _READ.fullmatch(span)
    if found is None:
        raise ValueError(f"not a turn: {span[:80]!r}")
    for role in ("user", "system", "assistant"):
        if (text := found[role]) is not None:
            return role, unescape(text)
    return unescape(found["role"]), unescape(found["other"])


@dataclass(frozen=True)
class Formatted:
    """``text``; ``starts`` of the turns' spans, the last ends with the text; ``loss`` as (turn, start, end)."""

    text: str
    starts: list[int] | None
    loss: list[tuple[int, int, int]]
    rewritten_at: int | None


def shared_start(a: str, b: str, known: int = 0) -> int:
    """Characters that ``a`` and ``b`` share from the left; the first ``known`` are."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def shared_end(a: str, b: str, least: int = 0) -> int:
    """Characters that ``a[least:]`` and ``b[least:]`` share from the right."""
    return shared_start(a[least:][::-1], b[least:][::-1])


def text_place(earlier: Sequence[Turn], role: str, render: Render, before: str) -> tuple[str, str] | None:
    """What the template puts before and after the text of a turn, if it puts it in one piece."""
    a, b = (render([*earlier, (role, probe)]) for probe in PROBES)
    if not (a.startswith(before) and b.startswith(before)):
        return None
    head = shared_start(a, b, len(before))
    tail = shared_end(a, b, head)
    whole = len(a) == len(b) == head + tail + len(PROBES[0])
    return (a[:head], a[head + len(PROBES[0]):]) if whole else None


def fits(out: str, head: str, tail: str) -> bool:
    return len(out) >= len(head) + len(tail) and out.startswith(head) and out.endswith(tail)


def locate(turns: Sequence[Turn], render: Render, loss_roles: Iterable[str] = LOSS_ROLES) -> Formatted:
    """Renders ``turns[:1], turns[:2], …`` and compares consecutive outputs.

    ``rewritten_at`` is the first turn whose arrival changes the output before it, or whose text does not stand in
    its span as one piece; from then on nothing is located, and no text is under the loss.
    """
    before, starts, loss = "", [], []
    for i, (role, _) in enumerate(turns):
        out = render(turns[: i + 1])
        if not out.startswith(before):
            return Formatted(render(turns), None, [], i)
        if role in loss_roles:
            place = text_place(turns[:i], role, render, before)
            if place is None or not fits(out, *place):
                return Formatted(render(turns), None, [], i)
            loss.append((i, len(place[0]), len(out) - len(place[1])))
        starts.append(len(before))
        before = out
    return Formatted(before, starts, loss, None)


SCHEMA = (
    "conv_id {id}, formatted string, n_turns long, "
    "spans array<struct<start:long,end:long>>, loss array<struct<turn:long,start:long,end:long>>, rewritten_at long"
)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[Turn]]]:
    """(conv_id, turns) of rows that are sorted by conversation; one may go over any number of batches."""
    current, turns, any_rows = None, [], False
    for batch in batches:
        for conv, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if any_rows and conv != current:
                yield current, turns
                turns = []
            current, any_rows = conv, True
            turns.append((role or "", text or ""))
    if any_rows:
        yield current, turns


def format_conversations(
    conversations: DataFrame, render: Render = default_template, loss_roles: Sequence[str] = LOSS_ROLES,
) -> DataFrame:
    """``conv_id, formatted, n_turns, spans, loss, rewritten_at`` of ``conversations(conv_id, turn, role, text)``.

    ``spans`` and ``loss`` are code point ranges of ``formatted``, one span per turn and one loss range per turn of
    ``loss_roles``; both are empty where the template rewrites history. Rows of one conversation go by
    turn, rows of one turn by role and text; null turns come first; repeated rows are turns of their own. Null roles and texts count as empty,
    rows without conv_id as one conversation. Other columns are not read. A table without rows gives none.

    A conversation is one row of the result, so its rows meet in one task, where they are read as a stream of
    sorted rows: a task holds one conversation at a time. Rendering every prefix costs the square of a
    conversation's turns, which is what treating the template as a black box takes.
    """
    narrow = conversations.select("conv_id", F.col("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    keys = ["conv_id", "turn", "role", "text"]
    rows = narrow.repartition("conv_id").sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys]).select("conv_id", "role", "text")
    id_type = conversations.schema["conv_id"].dataType
    schema = SCHEMA.format(id=id_type.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "formatted", "n_turns", "spans", "loss", "rewritten_at"]
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        mask = pa.list_(pa.struct([("turn", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
        out, size, kind = [], 0, None

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out))
            types = [kind, pa.string(), pa.int64(), span, mask, pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for b in batches:
                kind = b.schema.field(0).type
                yield b

        for conv, turns in _conversations(typed()):
            f = locate(turns, render, loss_roles)
            ends = [*(f.starts or [])[1:], len(f.text)]
            spans = [{"start": a, "end": b} for a, b in zip(f.starts or [], ends)]
            out.append((conv, f.text, len(turns), spans, [dict(zip(("turn", "start", "end"), x)) for x in f.loss], f.rewritten_at))
            size += len(f.text)
            if size >= BATCH_CHARS:
                yield batch()
                out, size = [], 0
        if out:
            yield batch()

    return rows.mapInArrow(run, schema)


def read_back(formatted: DataFrame, read: Callable[[str], Turn] = read_turn) -> DataFrame:
    """``conv_id, turns, loss_text`` from the output and its spans alone; ``turns`` is an array of (role, text)."""
    id_type = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for batch in batches:
            texts, spans, loss = (batch.column(k).to_pylist() for k in (1, 2, 3))
            for part in slices(texts, BATCH_CHARS):
                turns = [[dict(zip(("role", "text"), read(texts[i][s["start"]: s["end"]]))) for s in spans[i]] for i in part]
                under = ["".join(unescape(texts[i][x["start"]: x["end"]]) for x in loss[i]) for i in part]
                columns = [batch.column(0).slice(part.start, len(part)), pa.array(turns, turn), pa.array(under, pa.string()),
                           pa.array([len(texts[i]) for i in part], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["conv_id", "turns", "loss_text", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "spans", "loss").mapInArrow(
        run, f"conv_id {id_type}, turns array<struct<role:string,text:string>>, loss_text string, formatted_chars long")


def digests(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from the output."""
    back = read_back(format_conversations(conversations))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")
