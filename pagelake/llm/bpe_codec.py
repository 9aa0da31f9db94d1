"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches."""

from __future__ import annotations

import base64
import codecs
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.llm.spaced import SpacedEncoder

BATCH_BYTES = 4 << 20


def byte_to_char() -> dict[int, str]:
    """Each byte as a printable character: printable Latin-1 as itself, the rest from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return {b: chr(b) if b in printable else chr(next(rest)) for b in range(256)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The pair each longer token is merged from: what lower ranks alone leave of its bytes."""
    out = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        parts = [token[i: i + 1] for i in range(len(token))]
        while len(parts) > 2:
            pairs = [(r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1], rank)) < rank]
            if not pairs:
                raise ValueError(f"token {rank} can't be reached by merging lower ranks")
            _, i = min(pairs)
            parts[i: i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) == 2:
            out.append((parts[0], parts[1]))
    return out


def tokenizer_of(ranks: dict[bytes, int], pattern: str):
    """A tokenizers-library BPE with these ranks; each match of ``pattern`` is encoded apart."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    table = byte_to_char()
    chars = lambda token: "".join(table[b] for b in token)
    model = models.BPE(vocab={chars(t): r for t, r in ranks.items()}, merges=[(chars(a), chars(b)) for a, b in merges_of(ranks)], ignore_merges=True)
    tok = Tokenizer(model)
    tok.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return tok


class _MatchedTokenizer:
    """The library's tokenizer, with matches found by the regex module where Unicode tables may differ.

    The library's own pattern engine knows fewer letters than current Unicode; up to
    U+052F both agree.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        from tokenizers import pre_tokenizers

        self.plain = tokenizer_of(ranks, pattern)
        self.matched = tokenizer_of(ranks, pattern)
        self.matched.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pattern, self.beyond = regex.compile(pattern), regex.compile("[԰-\U0010FFFF]")

    def encode(self, text: str, add_special_tokens: bool = False):
        if not self.beyond.search(text):
            return self.plain.encode(text, add_special_tokens=False)
        found = list(self.pattern.finditer(text))
        ids, offsets = [], []
        for m, e in zip(found, self.matched.encode_batch([m.group() for m in found], add_special_tokens=False)):
            ids += e.ids
            offsets += [(a + m.start(), b + m.start()) for a, b in e.offsets]
        return _Encoded(ids, offsets)


class _Encoded:
    def __init__(self, ids: list[int], offsets: list[tuple[int, int]]):
        self.ids, self.offsets = ids, offsets


_codecs: dict[tuple[str, str], tuple] = {}


def codec(path: str, pattern: str) -> tuple[_MatchedTokenizer, SpacedEncoder, list[bytes]]:
    """(tokenizer, encoder, bytes by id), made once per worker."""
    if (path, pattern) not in _codecs:
        ranks = read_ranks(path)
        tok = _MatchedTokenizer(ranks, pattern)
        _codecs[path, pattern] = (tok, SpacedEncoder(tok), decode_table(ranks))
    return _codecs[path, pattern]


def decode_table(ranks: dict[bytes, int]) -> list[bytes]:
    """The bytes of each id, by way of the characters that stand for them in the vocabulary."""
    forward = byte_to_char()
    back = {c: b for b, c in forward.items()}
    vocab = {r: "".join(forward[b] for b in t) for t, r in ranks.items()}
    return [bytes(back[c] for c in vocab.get(i, "")) for i in range(max(vocab) + 1)]


def decode_stream(ids: Iterable[int], table: list[bytes]) -> Iterator[str]:
    """Text of ids as they come; a character split over ids is held until it is whole."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for i in ids:
        if text := decoder.decode(table[i]):
            yield text
    if text := decoder.decode(b"", final=True):
        yield text


def texts_of(column: pa.Array) -> Iterator[tuple[range, list[str]]]:
    """The texts of an Arrow column, null as empty, in parts of about BATCH_BYTES: only one part at a time is made of Python strings."""
    for part in parts_of(column):
        yield part, [t or "" for t in column.slice(part.start, len(part)).to_pylist()]


def parts_of(column: pa.Array) -> Iterator[range]:
    """Consecutive row ranges of about BATCH_BYTES each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + BATCH_BYTES, "right")))
        yield range(start, end)
        start = end


def decoded_of(ids: Iterable[bytes | None], table: Sequence[bytes]) -> pa.Array:
    """The bytes of each row's ids; null ids give none."""
    piece = table.__getitem__
    return pa.array([b"".join(map(piece, np.frombuffer(i or b"", "<u4").tolist())) for i in ids], pa.binary())


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids",
           offsets_col: str | None = None, bytes_col: str | None = None) -> DataFrame:
    """``docs`` with ``ids_col``: the text's ids as little-endian 32-bit integers.

    ``offsets_col`` adds the code point span of every id, ``bytes_col`` what ``decode`` makes of the ids, in the same
    pass: a worker of its own for that would hold all of its batches and tables beside this one. Null and empty texts have no ids. Texts of
    any length are whole; a batch is worked through in parts of about 4 MB. Only the text column
    goes through Python with the others unchanged; rows keep their order.
    """
    drop = [c for c in docs.columns if c in (ids_col, offsets_col, bytes_col)]
    docs = docs.drop(*drop)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids_col, T.BinaryType())])
    if offsets_col:
        schema = schema.add(offsets_col, T.ArrayType(T.ArrayType(T.IntegerType())))
    if bytes_col:
        schema = schema.add(bytes_col, T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, encoder, table = codec(path, pattern)
        for batch in batches:
            for part, texts in texts_of(batch.column(batch.schema.get_field_index(text_col))):
                out = batch.slice(part.start, len(part))
                if offsets_col:
                    found = [tok.encode(t) for t in texts]
                    ids = [np.asarray(e.ids, "<u4").tobytes() for e in found]
                else:
                    ids = encoder.encode(texts)
                columns = [*out.columns, pa.array(ids, pa.binary())]
                names = [*out.schema.names, ids_col]
                if offsets_col:
                    columns.append(pa.array([[list(o) for o in e.offsets] for e in found], pa.list_(pa.list_(pa.int32()))))
                    names.append(offsets_col)
                if bytes_col:
                    columns.append(decoded_of(ids, table))
                    names.append(bytes_col)
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``df`` with ``bytes_col``: the bytes of ``ids_col``; null ids give none.

    A cut between ids may split a character, so bytes and not text are returned; ``decode_stream``
    gives text from ids that arrive in parts.
    """
    df = df.drop(bytes_col)
    schema = T.StructType([*df.schema.fields, T.StructField(bytes_col, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = codec(path, pattern)[2]
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col))
            for part in parts_of(ids):
                out = batch.slice(part.start, len(part))
                found = decoded_of(ids.slice(part.start, len(part)).to_pylist(), table)
                yield pa.RecordBatch.from_arrays([*out.columns, found], [*out.schema.names, bytes_col])

    return df.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", also: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, repeats included, and the columns ``also`` names."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *also)
    both = encode(narrow, path, pattern, bytes_col="decoded").drop("text")
    return both.select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), *also)
