"""Encoding Arrow batches through a tokenizer of the tokenizers library, each distinct word once.

A blank with text right before and after it always starts a match of the usual byte-level
patterns, so the text may be cut there and the parts encoded apart. Frequent parts
are remembered; the rest of a batch is encoded in a few joined calls and split by offsets.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# White space other than single blanks and line ends; texts with it are encoded as they are.
_OTHER_SPACE = re.compile("[\t\r\v\f\x1c-\x1f\x85\xa0  -     　]")
JOINED = 4096


def separable(text: str) -> bool:
    """Whether every blank of ``text`` is such a cut."""
    return not ("  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " " or _OTHER_SPACE.search(text))


class SpacedEncoder:
    """ids of texts as little-endian 32-bit integers; equal to encoding each whole text.

    ``remember`` bounds the table of known parts; once full it stays as it is.
    """

    def __init__(self, tokenizer, remember: int = 300_000):
        self.tokenizer, self.remember, self.known = tokenizer, remember, {}

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _parts(self, parts: Iterable[str]) -> dict[str, bytes]:
        """ids of " " + part for each part."""
        parts, out = list(parts), {}
        for at in range(0, len(parts), JOINED):
            some = parts[at: at + JOINED]
            encoded = self.tokenizer.encode(" " + " ".join(some), add_special_tokens=False)
            ids = np.asarray(encoded.ids, "<u4")
            starts = np.cumsum([0] + [len(p) + 1 for p in some])
            where = np.searchsorted(np.fromiter((o[0] for o in encoded.offsets), np.int64, len(ids)), starts)
            data, where = ids.tobytes(), (where * 4).tolist()
            for part, a, b in zip(some, where, where[1:]):
                out[part] = data[a:b]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        known = self.known
        split = [t.split(" ") if separable(t) else None for t in texts]
        missing = {p for parts in split if parts for p in parts[1:] if p not in known}
        new = self._parts(missing)
        if len(known) < self.remember:
            known.update(new)
            table = known
        else:
            table = _Two(new, known)
        out = []
        for text, parts in zip(texts, split):
            if parts is None:
                out.append(self.whole(text))
            else:
                out.append(self.whole(parts[0]) + b"".join(map(table.__getitem__, parts[1:])))
        return out


class _Two(dict):
    """A table in front of another."""

    def __init__(self, front: dict, back: dict):
        super().__init__(front)
        self.back = back

    def __missing__(self, key):
        return self.back[key]
