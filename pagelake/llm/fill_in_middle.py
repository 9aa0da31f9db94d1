"""Fill-in-the-middle: texts cut in three, their parts exchanged in place by rotations.

A text's UTF-8 bytes lie in one bytearray. Two cuts are found by a scan, the three sentinels are inserted
there, and adjacent segments change places by three reversals each, so no second copy of a text is made.
The same rotations, run backwards, restore the text exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.llm.common import slices, utf8

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"
# Of 100 texts so many are transformed, and of these so many start with the suffix.
FIM_PERCENT, SPM_PERCENT = 90, 20
# Bytes that a scan or a reversal works on at a time, and text that a task turns at a time.
STEP = 1 << 20
BATCH_BYTES = 4 << 20


def reverse(view: np.ndarray, start: int, end: int, step: int = STEP) -> None:
    """Reverses ``view[start:end]`` in place, swapping blocks of at most ``step`` bytes from both ends."""
    while end - start > 1:
        n = min(step, (end - start) // 2)
        left = view[start: start + n][::-1].copy()
        view[start: start + n] = view[end - n: end][::-1]
        view[end - n: end] = left
        start, end = start + n, end - n


def rotate(view: np.ndarray, start: int, cut: int, end: int) -> int:
    """Exchanges ``view[start:cut]`` and ``view[cut:end]`` by three reversals; returns the new cut.

    Rotating again at the returned cut undoes it.
    """
    reverse(view, start, cut)
    reverse(view, cut, end)
    reverse(view, start, end)
    return start + end - cut


def unit_starts(data: bytes, at: int, end: int, after_letter: bool) -> tuple[np.ndarray, bool]:
    """Where units start within ``data[at:end]``, and whether its last byte is a letter.

    A unit is a run of ASCII letters or any other single character.
    """
    view = np.frombuffer(data, np.uint8, end - at, at)
    letter = (view | 0x20) - np.uint8(0x61) < 26
    before = np.empty_like(letter)
    before[:1], before[1:] = after_letter, letter[:-1]
    return ~(letter & before) & (view & 0xC0 != 0x80), bool(letter[-1]) if len(letter) else after_letter


def count_units(data: bytes, step: int = STEP) -> int:
    total, after = 0, False
    for at in range(0, len(data), step):
        starts, after = unit_starts(data, at, min(at + step, len(data)), after)
        total += int(np.count_nonzero(starts))
    return total


def byte_offsets(data: bytes, units: list[int], step: int = STEP) -> list[int]:
    """The byte at which each of ``units`` (ascending numbers of units from the left) ends."""
    out, total, after, at = [], 0, False, 0
    while len(out) < len(units) and at < len(data):
        starts, after = unit_starts(data, at, min(at + step, len(data)), after)
        where = np.flatnonzero(starts)
        while len(out) < len(units) and units[len(out)] - total < len(where):
            out.append(at + int(where[units[len(out)] - total]))
        total, at = total + len(where), at + step
    return out + [len(data)] * (len(units) - len(out))


def count_chars(data: bytes | bytearray, start: int, end: int, step: int = STEP) -> int:
    """Code points in ``data[start:end]``."""
    return sum(int(np.count_nonzero(np.frombuffer(data, np.uint8, min(step, end - at), at) & 0xC0 != 0x80)) for at in range(start, end, step))


def transform(data: bytes, first: int, last: int, form: str) -> bytes:
    """The text cut at bytes ``first`` and ``last``, its parts marked and put in the order of ``form``."""
    if form == PLAIN:
        return data
    buffer = bytearray(data)
    for at, sentinel in ((last, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel
    first, last = first + 3, last + 6
    view = np.frombuffer(buffer, np.uint8)
    cut = rotate(view, first, last, len(buffer))  # suffix before middle
    if form == SPM:
        rotate(view, 0, first, cut)  # suffix before prefix
    del view
    return bytes(buffer)


def restore_text(output: bytes, form: str) -> bytes:
    """The text that ``transform`` was given."""
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    head, middle = (PREFIX, buffer.find(MIDDLE)) if form == SPM else (SUFFIX, buffer.find(MIDDLE))
    inner = buffer.find(head)
    if inner < 0 or middle < 0:
        raise ValueError(f"no {form} text")
    view = np.frombuffer(buffer, np.uint8)
    if form == SPM:
        inner = rotate(view, 0, inner, middle)
    last = rotate(view, inner, middle, len(buffer))
    del view
    for at in (last, inner, 0):
        del buffer[at: at + 3]
    return bytes(buffer)


def draws(id_col: str) -> list[Column]:
    """Four numbers below 2**32 from the row's id; a null id draws as an empty one."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``n, form, prefix_chars, middle_chars, output``.

    ``n`` counts the units ``[A-Za-z]+|[^A-Za-z]`` of the whole text; the cuts fall after ``h1 % (n + 1)`` and
    ``h2 % (n + 1)`` of them, the lesser first. ``form`` is ``psm`` (prefix, suffix, middle), ``spm`` (suffix,
    prefix, middle) or ``plain`` (unchanged, lengths null): for empty texts, texts that hold a sentinel, and
    one in ten others. A null text counts as empty, a null id as an empty one. Every row is turned by itself:
    repeated rows, ids used twice and texts of any length are all kept, in order; a row holds its text about twice.
    Columns of ``docs`` with one of the new names are replaced.
    """
    new = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
           T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())]
    names = [f.name for f in new]
    drawn = docs.withColumn("__fim_draws", F.array(*draws(id_col))).drop(*[n for n in names if n not in (id_col, text_col)])
    kept = [f for f in drawn.schema.fields if f.name != "__fim_draws" and f.name not in names]
    schema = T.StructType([*kept, *new])

    def one(data: bytes, h: list[int]) -> tuple[int, str, int | None, int | None, bytes]:
        n = count_units(data)
        if not data or h[2] % 100 >= FIM_PERCENT or any(s in data for s in SENTINELS):
            return n, PLAIN, None, None, data
        first, last = byte_offsets(data, sorted((h[0] % (n + 1), h[1] % (n + 1))))
        form = SPM if h[3] % 100 < SPM_PERCENT else PSM
        return n, form, count_chars(data, 0, first), count_chars(data, first, last), transform(data, first, last, form)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            sizes = batch.column(at(text_col))
            drawn_at = batch.column(at("__fim_draws"))
            texts = utf8(sizes)
            for part in slices(texts, BATCH_BYTES):
                rows = [one(texts[i], drawn_at[i].as_py()) for i in part]
                out = batch.slice(part.start, len(part))
                columns = [out.column(at(f.name)) for f in kept]
                cols = list(zip(*rows))
                columns += [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()),
                            pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    return drawn.mapInArrow(run, schema)


def restore(df: DataFrame, output_col: str = "output", form_col: str = "form", restored_col: str = "restored") -> DataFrame:
    """``df`` with ``restored_col``: the text rebuilt from output and form alone; a null output gives an empty text."""
    df = df.drop(restored_col)
    schema = T.StructType([*df.schema.fields, T.StructField(restored_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(batch.schema.get_field_index(output_col)))
            forms = batch.column(batch.schema.get_field_index(form_col)).to_pylist()
            for part in slices(texts, BATCH_BYTES):
                out = batch.slice(part.start, len(part))
                back = pa.array([restore_text(texts[i], forms[i] or PLAIN) for i in part], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*out.columns, back], [*out.schema.names, restored_col])

    return df.mapInArrow(run, schema)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the digests of output and restored text, of every row."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    both = restore(fill_in_middle(narrow).drop("text"))
    return both.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
