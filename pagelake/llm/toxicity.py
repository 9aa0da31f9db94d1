"""Toxicity: a factorization machine over hashed terms.

score = logistic(b + sum of w[t] + sum over pairs of <v[s], v[t]>) over the terms of a text's distinct
words. The pair term learns what a sum of weights can't: an insult that counts beside another term and not
alone. Only labelled rows whose crc32(id) mod 5 is not 0 are learnt from.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import written

# Model size and what it is fitted on: at most so many labelled rows of each class, the least by hash of their id.
BUCKETS = 1 << 18
FACTORS = 6
ROWS_PER_CLASS = 8000
EPOCHS = 50
PREFIXES = (3, 4, 5, 6, 7)
FOLDS = 5
# Terms are fitted if the classes' shares of texts with them differ by so many standard errors, over so many texts;
# and, as a pair may tell what neither of its terms does, so many of the commonest terms whatever they tell.
MIN_Z = 5.0
MIN_TEXTS = 8
COMMON = 512
# Rows per fitting step, and words a task remembers while it scores.
STEP_ROWS = 256
REMEMBER = 200_000
_LETTERS = re.compile(r"[^\W\d_]+")


def terms(word: str) -> tuple[int, ...]:
    """Hashed terms of a lower-case word: the word and its beginnings."""
    return tuple(zlib.crc32(t.encode()) % BUCKETS for t in (f"={word}", *(word[:n] for n in PREFIXES if len(word) >= n)))


def distinct_words(text: str) -> set[str]:
    return set(_LETTERS.findall(text.lower()))


class Model:
    """b, and by bucket a row of weight, factors and the sum of squared factors; other buckets add nothing."""

    def __init__(self, b: float, buckets: list[int], w: np.ndarray, v: np.ndarray):
        self.b, self.index = b, {bucket: i for i, bucket in enumerate(buckets)}
        self.table = np.concatenate([w[:, None], v, (v * v).sum(1)[:, None]], axis=1)

    def row(self, word: str) -> np.ndarray | None:
        """What a word adds; None where it adds nothing."""
        row = None
        for t in terms(word):
            if (i := self.index.get(t)) is not None:
                row = self.table[i] if row is None else row + self.table[i]
        return row

    def logit(self, total: np.ndarray) -> np.ndarray:
        return self.b + total[..., 0] + 0.5 * ((total[..., 1:-1] ** 2).sum(-1) - total[..., -1])


class _Known(dict):
    """By word the place of its row in a table; place 0 adds nothing. Starts anew when it holds REMEMBER words."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.used, self.table = model, 1, np.zeros((1024, model.table.shape[1]))

    def __missing__(self, word: str) -> int:
        row, at = self.model.row(word), 0
        if row is not None:
            if self.used == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            at, self.used = self.used, self.used + 1
            self.table[at] = row
        self[word] = at
        return at

    def total(self, words: set[str]) -> np.ndarray:
        if len(self) > REMEMBER:
            self.clear()
            self.used = 1
        places = list(map(self.__getitem__, words))
        return self.table[places].sum(0) if places else np.zeros(self.table.shape[1])


def chosen_buckets(taken: DataFrame, least: float = MIN_Z, common: int = COMMON) -> list[int]:
    """The buckets to fit: those whose share of texts differs between the classes by ``least`` standard errors, and the
    ``common`` ones with the most texts; none if a class is missing."""
    n = {r.toxic: r.n for r in taken.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return []

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for ids, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[label][np.unique(np.frombuffer(ids, "<i4"))] += 1
        found = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(seen[0][found]), pa.array(seen[1][found])], ["bucket", "c0", "c1"])

    # At most a row per bucket reaches the driver.
    counts = taken.select("ids", "toxic").mapInArrow(counted, "bucket long, c0 long, c1 long").groupBy("bucket").agg(
        F.sum("c0").alias("c0"), F.sum("c1").alias("c1")).toArrow()
    bucket, c0, c1 = (counts[name].to_numpy() for name in ("bucket", "c0", "c1"))
    p = (c0 + c1) / (n[0] + n[1])
    error = np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n[0] + 1 / n[1]))
    telling = bucket[(c0 + c1 >= MIN_TEXTS) & (np.abs(c1 / n[1] - c0 / n[0]) >= least * error)]
    return np.union1d(telling, bucket[np.lexsort((bucket, -(c0 + c1)))[:common]]).tolist()


def fit(samples: list[tuple[np.ndarray, int]], chosen: list[int], epochs: int = EPOCHS, rate: float = 0.2, decay: float = 1e-3, seed: int = 7) -> Model:
    """Adagrad on the logistic loss over the buckets ``chosen``, classes weighed alike. ``samples``: (places in ``chosen``, 0 or 1)."""
    rng = np.random.default_rng(seed)
    y = np.array([s[1] for s in samples], float)
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(float(np.log(share / (1 - share))), [], np.zeros(0), np.zeros((0, FACTORS)))
    rows = [flat for flat, _ in samples]
    n, lengths = len(chosen), np.array([len(r) for r in rows])
    a, e, b = np.zeros(n), rng.normal(0, 0.05, (n, FACTORS)), 0.0
    ga, ge, gb = np.full(n, 1e-3), np.full((n, FACTORS), 1e-3), 1e-3
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // STEP_ROWS)):
            flat = np.concatenate([rows[i] for i in part])
            doc = np.repeat(np.arange(len(part)), lengths[part])
            add = lambda x: np.bincount(doc, x, len(part))
            s = np.stack([add(e[flat, f]) for f in range(FACTORS)], axis=1)
            z = b + add(a[flat]) + 0.5 * ((s * s).sum(1) - add((e[flat] ** 2).sum(1)))
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) * weight[part] / len(part)
            da = np.bincount(flat, g[doc], n) + decay * a / len(part)
            ga += da * da
            a -= rate * da / np.sqrt(ga)
            for f in range(FACTORS):
                de = np.bincount(flat, g[doc] * (s[doc, f] - e[flat, f]), n) + decay * e[:, f] / len(part)
                ge[:, f] += de * de
                e[:, f] -= 0.5 * rate * de / np.sqrt(ge[:, f])
            gb += g.sum() ** 2
            b -= rate * g.sum() / np.sqrt(gb)
    return Model(float(b), chosen, a, e)


def sample(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> tuple[list[tuple[np.ndarray, int]], list[int]]:
    """The rows to learn from, as (places of their chosen terms, label), and the chosen buckets.

    Their number is bounded by the parameter. Executors count the terms, and only the
    chosen ones reach the driver.
    """
    learnt = labels.filter(F.col("toxic").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % FOLDS != 0))
    # One label per document; those with both tell nothing.
    known = learnt.groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").cast("int").alias("most")).filter("toxic = most").drop("most")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = known.filter("toxic = 1").orderBy(*order).limit(rows_per_class).union(known.filter("toxic = 0").orderBy(*order).limit(rows_per_class))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = []
            for text in batch.column(0).to_pylist():
                flat = np.fromiter((t for x in sorted(distinct_words(text or "")) for t in terms(x)), "<i4")
                ids.append(flat.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), batch.column(1), batch.column(2)], ["ids", "toxic", "doc_id"])

    taken = written(docs.select("doc_id", "text").join(ids, "doc_id").select("text", "toxic", "doc_id").mapInArrow(
        run, f"ids binary, toxic int, doc_id {id_type}"), "toxicity-sample")
    chosen = chosen_buckets(taken)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(BUCKETS, -1, "<i4")
        place[chosen] = np.arange(len(chosen))
        for batch in batches:
            found = [(p := place[np.frombuffer(x, "<i4")])[p >= 0].tobytes() for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column(1), batch.column(2)], ["ids", "toxic", "doc_id"])

    rows = taken.mapInArrow(placed, f"ids binary, toxic int, doc_id {id_type}").collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.ids)))
    return [(np.frombuffer(bytes(r.ids), "<i4"), r.toxic) for r in rows], chosen


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row, by its text alone; empty and null texts get the model's base score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        known = _Known(m)

        def logit(text: str) -> float:
            return float(m.logit(known.total(distinct_words(text))))

        for batch in batches:
            z = np.array([logit(t or "") for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())], ["doc_id", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``.

    Rows without label are scored like any other, repeated rows and ids each for themselves; a null text counts as empty, a null
    id as an empty one. Other columns are not read. Labels of a document may repeat; where they differ, or are null, it isn't
    learnt from. With no label of either class the score is the labelled share of 1. A task holds the distinct words of one text.
    """
    model = fit(*sample(docs, labels, rows_per_class))
    return score(docs, model).select(
        "doc_id", (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
