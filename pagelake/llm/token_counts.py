"""Token counts: huge documents in overlapping chunks, spliced where both encodings provably agree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import slices
from pagelake.llm.spaced import SpacedEncoder

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 512
# Added tokens and look-ahead reach no further than this from the end of a chunk.
GUARD_CHARS = 64
BATCH_BYTES = 4 << 20
TOKEN_LIMIT = 1024


def token_starts(tokenizer, text: str, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Offset of each token of ``text``, and the offsets at which a match of the split pattern starts."""
    e = tokenizer.encode(text, add_special_tokens=False)
    starts = np.fromiter((o[0] for o in e.offsets), np.int64, len(e.offsets)) + base
    words = np.asarray([-1 if w is None else w for w in e.word_ids], np.int64)
    fresh = np.ones(len(words), bool)
    fresh[1:] = (words[1:] != words[:-1]) | (words[1:] < 0)
    return starts, starts[fresh]


def splice(left: np.ndarray, right: np.ndarray, end: int) -> int | None:
    """The first offset from which both encodings provably are the same up to the guard before ``end``.

    Matching goes from left to right and looks at nothing before its start, so once a match starts at
    the same offset in both, all later ones agree, and each is encoded by itself. The last
    three matches of the left chunk may be cut short by its end and don't count.
    """
    last = min(end - GUARD_CHARS, left[-4] if len(left) > 3 else -1)
    common = np.intersect1d(left[left <= last], right[1:])
    return int(common[0]) if len(common) else None


def count_tokens(tokenizer, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of ``text``; at most a few chunks are encoded at a time."""
    total, start, size = 0, 0, chunk
    tokens, words = token_starts(tokenizer, text[:size], 0)
    end = min(size, len(text))
    while end < len(text):
        width, at = overlap, None
        while at is None and width < end - start:
            begin = end - width
            next_end = min(begin + chunk + width, len(text))
            next_tokens, next_words = token_starts(tokenizer, text[begin:next_end], begin)
            at = splice(words, next_words, end)
            width *= 2
        if at is None:  # the whole chunk agrees nowhere: a larger one from the same proven start
            size *= 2
            end = min(start + size, len(text))
            tokens, words = token_starts(tokenizer, text[start:end], start)
            continue
        total += int(np.count_nonzero(tokens < at))
        start, end, size = at, next_end, chunk
        tokens, words = next_tokens[next_tokens >= at], next_words[next_words >= at]
    return total + len(tokens)


_tokenizers: dict[str, tuple] = {}


def counter(path: str):
    """A function from texts to token counts, made once per worker, for a .json or .model file."""
    if path not in _tokenizers:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _tokenizers[path] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            spaced = SpacedEncoder(tok)

            def count(texts: list[str]) -> list[int]:
                short = iter(spaced.encode([t for t in texts if len(t) <= CHUNK_CHARS]))
                return [len(next(short)) // 4 if len(t) <= CHUNK_CHARS else count_tokens(tok, t) for t in texts]

            _tokenizers[path] = count
    return _tokenizers[path]


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row; null texts are empty, repeats stay, an empty table gives an empty result.

    Texts above ``CHUNK_CHARS`` characters go by overlapping chunks, however long they are; other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = np.zeros(len(texts), np.int64)
            for part in slices(texts, BATCH_BYTES):
                n[part.start: part.stop] = count(texts[part.start: part.stop])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n)], ["doc_id", "n_bytes", "n_tokens"])

    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    return sized.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
