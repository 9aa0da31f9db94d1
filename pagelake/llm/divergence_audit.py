"""Source divergence audit by chunk factorization.

White-space chunks are counted per document, each distinct chunk is tokenized once, and its terms are joined
back. Chunks count in lower case and without what stands around their first and last term, which leaves their terms as they are and
makes far fewer of them distinct. Occurrences of a term are sums over its chunks. Its documents are not: one may hold several of its
chunks. Two bounds settle most terms, since a term has at least the documents of its commonest chunk and at
most the sum over its chunks; only where the limit lies between both are single documents compared, in a second pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagelake.llm.common import pieces, slices, utf8, written
from pagelake.session import BucketedTable, new_scratch

MIN_DOCS, TOP_TERMS, SMOOTHING = 30, 50, 5
# A term: a run of ASCII letters and of characters beyond ASCII; only A-Z are lower-cased.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
# ASCII without letters: no term has any of it.
NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]"
AROUND = "".join(chr(b) for b in range(128) if not chr(b).isalpha())
# Counts that a task keeps summed up before it sends them on, so many rows at a time, and text whose words it holds at a time.
SUM_BYTES, BATCH_ROWS, SLICE_BYTES = 64 << 20, 1 << 16, 4 << 20
GROUP_COLUMNS = ["group", "chunk", "docs", "n"]
# Bits of a filter per chunk, and at most; beyond that it only lets more rows through.
BITS_PER_KEY, MOST_BITS, PROBES = 12, 1 << 26, 4
# Counts in one matrix of sources and terms, terms in it at least, and sources compared with all others by one task.
CELLS, LEAST_TERMS, TILE = 1 << 15, 64, 256


def normal(docs: DataFrame) -> DataFrame:
    """lang, source, text; null counts as empty."""
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def chunks_of(texts: pa.Array, wanted: Callable[[pa.Array], np.ndarray] | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct chunks, and by text and place among them, in that order, how often the text holds the chunk.

    A chunk is a lower-case word from its first term to its last, so words without a term have none. ``wanted`` says
    which of the distinct chunks count.
    """
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    row = np.repeat(np.arange(len(texts)), np.diff(words.offsets.to_numpy()))
    found = pc.ascii_trim(words.flatten(), AROUND).dictionary_encode()
    chunks, at = found.dictionary, found.indices.to_numpy()
    use = pc.not_equal(chunks, "").to_numpy(zero_copy_only=False)
    if wanted is not None:
        use &= wanted(chunks)
    if not use.all():
        row, at = row[use[at]], at[use[at]]
    each, times = np.unique(row * max(1, len(chunks)) + at, return_counts=True)
    return chunks, *np.divmod(each, max(1, len(chunks))), times


def summed(tables: list[pa.Table], keys: list[str]) -> pa.Table:
    """One table of tables that have a row per ``keys``, their other columns summed."""
    if len(tables) == 1:
        return tables[0]
    values = [c for c in tables[0].column_names if c not in keys]
    sums = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([(c, "sum") for c in values])
    return sums.select([*keys, *(f"{c}_sum" for c in values)]).rename_columns([*keys, *values])


def sliced(column: pa.Array) -> Iterator[tuple[range, list[pa.Array]]]:
    """Consecutive texts of about SLICE_BYTES; one longer than that comes alone, in pieces."""
    texts = utf8(column)
    for part in slices(texts, SLICE_BYTES):
        if len(texts[part.start]) > SLICE_BYTES:
            yield part, [pa.array([piece], pa.string()) for piece in pieces(texts[part.start])]
        else:
            yield part, [column.slice(part.start, len(part)).cast(pa.string())]


def chunks_by_group(group: np.ndarray, texts: list[pa.Array]) -> pa.Table:
    """group, chunk, docs, n of texts whose groups are given, or of one text in pieces."""
    if len(texts) == 1:
        chunks, row, at, times = chunks_of(texts[0])
        every, place, docs = np.unique(group[row] * max(1, len(chunks)) + at, return_inverse=True, return_counts=True)
        of, at = np.divmod(every, max(1, len(chunks)))
        n = np.bincount(place, times, len(every)).astype(np.int64)
        return pa.table([pa.array(of), chunks.take(pa.array(at)), pa.array(docs), pa.array(n)], GROUP_COLUMNS)
    held = pa.table([pa.array([], pa.string()), pa.array([], pa.int64())], ["chunk", "n"])
    for piece in texts:
        chunks, _, at, times = chunks_of(piece)
        held = summed([held, pa.table([chunks.take(pa.array(at)), pa.array(times)], ["chunk", "n"])], ["chunk"])
    one = np.ones(len(held), np.int64)
    return pa.table([pa.array(one * group[0]), held["chunk"], pa.array(one), held["n"]], GROUP_COLUMNS)


def chunk_counts(docs: DataFrame) -> DataFrame:
    """lang, source, chunk, docs, n: documents with the chunk, and its occurrences.

    A task sums up what it reads, so a chunk that stands everywhere sends a row per group and SUM_BYTES of counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        sums: list[pa.Table] = []

        def sent() -> Iterator[pa.RecordBatch]:
            langs, sources = (pa.array(names, pa.string()) for names in zip(*groups))
            for part in sums[0].to_batches(max_chunksize=BATCH_ROWS):
                group, *rest = part.columns
                yield pa.RecordBatch.from_arrays([langs.take(group), sources.take(group), *rest], ["lang", "source", *GROUP_COLUMNS[1:]])

        for batch in batches:
            group = np.array([groups.setdefault(g, len(groups)) for g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())], np.int64)
            for part, texts in sliced(batch.column(2)):
                sums.append(chunks_by_group(group[part.start:part.stop], texts))
                if sum(table.nbytes for table in sums) > 2 * SUM_BYTES:
                    sums = [summed(sums, GROUP_COLUMNS[:2])]
                    if sums[0].nbytes > SUM_BYTES:
                        yield from sent()
                        sums = []
        if sums:
            sums = [summed(sums, GROUP_COLUMNS[:2])]
            # A Python worker stays for later tasks; what Arrow holds beyond the sums goes back.
            pa.default_memory_pool().release_unused()
            yield from sent()
            sums = []
        pa.default_memory_pool().release_unused()

    parts = docs.mapInArrow(run, "lang string, source string, chunk string, docs long, n long")
    # Rows of a chunk meet where its bucket is written.
    return parts.repartition("chunk").groupBy("chunk", "lang", "source").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def tokenized(chunks: DataFrame) -> DataFrame:
    """lang, chunk, docs, term, k: each distinct chunk tokenized once, its terms and how often it holds each with its documents by language."""
    by_lang = chunks.groupBy("chunk", "lang").agg(F.sum("docs").alias("docs"))
    # Most chunks are a term as they stand, which is cheaper to see than to extract.
    terms = F.when(F.col("chunk").rlike(NO_TERM), F.regexp_extract_all("chunk", F.lit(TERM), F.lit(0))).otherwise(F.array("chunk"))
    each = by_lang.groupBy("chunk").agg(F.collect_list(F.struct("lang", "docs")).alias("ls")).select("chunk", "ls", terms.alias("ts"))
    counted = F.when(F.size("ts") < 2, F.transform("ts", lambda t: F.struct(t.alias("term"), F.lit(1).alias("k")))).otherwise(
        F.transform(F.array_distinct("ts"), lambda t: F.struct(t.alias("term"), F.size(F.filter("ts", lambda x: x == t)).alias("k"))))
    terms = each.select("chunk", "ls", F.explode(counted).alias("_t"))
    return terms.select("chunk", "_t.term", "_t.k", F.explode("ls").alias("_l")).select("_l.lang", "chunk", "_l.docs", "term", "k")


def filter_bits(chunks: DataFrame) -> bytes:
    """A Bloom filter of ``chunk``, of a size that follows their number up to MOST_BITS; executors make it."""
    n, bits = chunks.count(), 1 << 12
    while bits < min(MOST_BITS, n * BITS_PER_KEY):
        bits *= 2
    h, step = F.xxhash64("chunk"), F.shiftrightunsigned(F.xxhash64("chunk"), 32)
    places = F.array(*[(h + step * i).bitwiseAND(F.lit(bits - 1)) for i in range(PROBES)])
    set_bits = chunks.select(F.explode(places).alias("at")).select(
        F.expr("shiftright(at, 6)").alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
    words = set_bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(bits // 64, "<i8")
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    return table.tobytes()


def possibly_in(chunks: list[bytes], filter_: bytes) -> list[bytes]:
    """The chunks that the filter may hold; none that it holds is missing."""
    import xxhash

    table = np.frombuffer(filter_, np.uint8)
    h = np.fromiter((xxhash.xxh64_intdigest(c, 42) for c in chunks), np.uint64, len(chunks))
    step, mask, found = h >> np.uint64(32), np.uint64(len(table) * 8 - 1), np.ones(len(chunks), bool)
    for _ in range(PROBES):
        at = h & mask
        found &= (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        h = h + step
    return [chunks[i] for i in np.flatnonzero(found)]


def holders(docs: DataFrame, wanted: bytes) -> DataFrame:
    """lang, chunk, row: the documents that hold chunks of the filter; ``row`` tells a document from others of this scan."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def wanted_of(chunks: pa.Array) -> np.ndarray:
        found = possibly_in(chunks.cast(pa.binary()).to_pylist(), shared.value)
        return pc.is_in(chunks, pa.array(found, pa.binary()).cast(chunks.type)).to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part, texts in sliced(batch.column(1)):
                for some in texts:
                    chunks, row, at, _ = chunks_of(some, wanted_of)
                    row += part.start
                    yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()).take(pa.array(row)), chunks.take(pa.array(at)), pa.array(first + row)], ["lang", "chunk", "row"])
            first += len(batch)
        pa.default_memory_pool().release_unused()

    return docs.select("lang", "text").mapInArrow(run, "lang string, chunk string, row long")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS, label: str = "divergence") -> DataFrame:
    """lang, source, term, n: occurrences of the terms that at least ``min_docs`` documents of a language hold."""
    with BucketedTable(docs.sparkSession, new_scratch(docs.sparkSession, f"{label}-chunks"), ["chunk"]) as table:
        table.append(chunk_counts(docs), placed=True)
        chunks = table.read()
        joined = written(tokenized(chunks), f"{label}-joined")
        bounds = joined.groupBy("lang", "term").agg(F.max("docs").alias("least"), F.sum("docs").alias("most")).filter(F.col("most") >= min_docs)
        # Of few rows by key and many, the many need no sort.
        possible = written(joined.join(bounds.hint("shuffle_hash"), ["lang", "term"]).select("lang", "chunk", "term", "k", (F.col("least") >= min_docs).alias("sure")), f"{label}-terms")
        unsure = possible.filter("not sure").select("lang", "chunk", "term", "k")
        held = holders(docs, filter_bits(unsure.select("chunk").distinct())).join(unsure.drop("k"), ["lang", "chunk"]).select("lang", "term", "row").distinct()
        enough = held.groupBy("lang", "term").agg(F.count("*").alias("docs")).filter(F.col("docs") >= min_docs)
        kept = possible.filter("sure").drop("sure").unionByName(unsure.join(enough.select("lang", "term"), ["lang", "term"], "left_semi"))
        # One row per chunk, with its languages and terms, meets the counts in their buckets.
        by_chunk = kept.groupBy("chunk").agg(F.collect_list(F.struct("lang", "term", "k")).alias("ts"))
        met = chunks.join(by_chunk.hint("shuffle_hash"), "chunk").select("lang", "source", "n", F.explode("ts").alias("_t")).filter(F.col("_t.lang") == F.col("lang"))
        counts = met.groupBy("lang", "source", F.col("_t.term").alias("term")).agg(F.sum(F.col("n") * F.col("_t.k")).alias("n"))
        return written(counts, f"{label}-counts")


def share(n: str, total: str, terms: str) -> Column:
    """1 + floor(10**9 * (n + 5) / (total + 5 * terms)), by long division in base 1000: exact while 1000 times the divisor is a bigint."""
    divisor = f"({total} + {SMOOTHING} * {terms})"
    rest, out = f"({n} + {SMOOTHING})", "1"
    for i, unit in enumerate((10**9, 10**6, 10**3, 1)):
        rest = f"({rest} * 1000)" if i else rest
        out, rest = f"{out} + ({rest} div {divisor}) * {unit}L", f"({rest} % {divisor})"
    return F.expr(out)


def shares(n: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """``share`` of arrays."""
    divisor = total + SMOOTHING * terms
    rest, out = n + SMOOTHING, np.ones_like(n)
    for i, unit in enumerate((10**9, 10**6, 10**3, 1)):
        quotient, rest = np.divmod(rest * 1000 if i else rest, divisor)
        out += quotient * unit
    return out


def distances(cells: pa.Table, sources: pa.Table, tile_size: int = TILE) -> pa.Table:
    """lang, a, b, value: over the terms of ``cells``, the sum of differences between sources a < b, a within one tile."""
    order = np.argsort(sources["sid"].to_numpy())
    lang, tile, terms = sources["lang"][0].as_py(), sources["tile"][0].as_py(), sources["terms"][0].as_py()
    total = sources["total"].to_numpy()[order]
    names = cells["term"].combine_chunks().dictionary_encode() if len(cells) else None
    counts = np.zeros((len(total), len(names.dictionary) if names is not None else 0), np.int64)
    if names is not None:
        counts[cells["at"].to_numpy(), names.indices.to_numpy()] = cells["n"].to_numpy()
    p = shares(counts, total[:, None], terms) if terms else counts
    a, b, value = [], [], []
    for i in range(tile * tile_size, min((tile + 1) * tile_size, len(total) - 1)):
        a.append(np.full(len(total) - i - 1, i))
        b.append(np.arange(i + 1, len(total)))
        value.append(np.abs(p[i + 1:] - p[i]).sum(axis=1))
    cols = [np.concatenate([np.empty(0, np.int64), *x]).astype(np.int64) for x in (a, b, value)]
    return pa.table([pa.repeat(lang, len(cols[0])), *map(pa.array, cols)], ["lang", "a", "b", "value"])


def divergence_audit(
    docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, cells: int = CELLS, tile: int = TILE,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` of ``docs(lang, source, text)``.

    Part ``pair`` ranks a source's distance to each other source of its language, part ``term`` the terms by
    which it exceeds its language most, the first ``top_terms``. Ties go by item in UTF-8 order.

    Sources are compared in matrices of about ``cells`` counts, ``tile`` sources against all others at a time.
    Null lang, source and text count as empty. Every row is a document of its own, repeated ones too; other
    columns are not read. Groups without any kept term are compared like others; in a language without any,
    distances are 0. A table without rows gives none. Texts of any length are cut into chunks piece by piece, a
    task holds the distinct chunks of one document at least; a chunk is held whole.
    """
    docs = normal(docs)
    counts = kept_terms(docs, min_docs)
    by_lang = Window.partitionBy("lang").orderBy("source")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    terms = counts.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("terms"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(terms, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms"),
        (F.row_number().over(by_lang) - 1).cast("long").alias("sid"))
    groups = written(groups, "divergence-groups")
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources"), F.sum("total").alias("lang_total")).join(groups.select("lang", "terms").distinct(), "lang").select(
        "lang", "lang_total", F.ceil(F.col("sources") / tile).alias("tiles"), F.expr(f"greatest(1L, ceil(terms / greatest({LEAST_TERMS}L, {cells} div sources)))").alias("buckets"))

    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    here = groups.join(langs, "lang")
    left = counts.join(here, ["lang", "source"]).select(
        "lang", "term", "n", F.col("sid").alias("at"), F.pmod(F.xxhash64("term"), F.col("buckets")).alias("bucket"), every.alias("tile"))
    right = here.select("lang", "sid", "total", "terms", "buckets", every.alias("tile")).select(
        "lang", "sid", "total", "terms", "tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)).alias("bucket"))
    keys = ["lang", "bucket", "tile"]
    parts = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda a, b: distances(a, b, tile), "lang string, a long, b long, value long")
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.select("lang", "value", F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("_p"))
    pairs = both.select("lang", "value", "_p.x", "_p.y").join(
        groups.select("lang", "source", F.col("sid").alias("x")), ["lang", "x"]).join(
        groups.select("lang", F.col("source").alias("item"), F.col("sid").alias("y")), ["lang", "y"])

    lang_counts = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    of_lang = counts.join(lang_counts.hint("shuffle_hash"), ["lang", "term"]).join(here, ["lang", "source"])
    excess = of_lang.withColumn("value", share("n", "total", "terms") - share("lang_n", "lang_total", "terms")).filter("value > 0")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    out = [
        found.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
        for part, found in (("pair", pairs), ("term", excess.withColumnRenamed("term", "item")))
    ]
    return out[0].unionByName(out[1].filter(F.col("rank") <= top_terms))
