"""Quality rules: adaptive thresholds from mergeable quantile sketches, DataFrame functions only.

The sketch of a measure is a table of counts by bucket: values below 64 are their own
bucket, larger ones keep their six leading bits, so a quantile is off by one part in 32 at
most. Sketches merge by adding counts, which is how a (lang, source) cell with few documents
takes the sketch of its language, or of everything, and which lets partial sums run before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagelake.llm.common import ASCII_SPACE, WORD_GAP, fresh, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CELL = 50
# By measure: the least fence, in thousandths. A fence is never below it.
MEASURES = {"symbols_pm": 20, "dup_lines_pm": 500}
SPREADS = 6


def words_of(text: str) -> Column:
    return F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), WORD_GAP), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column) -> Column:
    """Words covered by a 3-word window that the same array holds twice or more.

    Window hashes (64 bits) are sorted with their positions; equal neighbours are
    repeats, and the union of their spans is summed over the sorted positions.
    """
    def windows(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i")))

    def repeated(s):
        n = F.size(s)
        same = lambda a, b: (a >= 0) & (b < n) & (F.get(s, a)["h"] == F.get(s, b)["h"])
        return F.transform(F.filter(s, lambda x, k: same(k - 1, k) | same(k, k + 1)), lambda x: x["i"])

    def covered(p):
        return F.aggregate(p, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
                           lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
                           lambda a: a["n"])

    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(
        let(words, lambda w: covered(F.sort_array(let(F.sort_array(windows(w)), repeated)))))


def measured(docs: DataFrame, text_col: str = "text", names: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_text_lines; row-local."""
    name = lambda c: (names or {}).get(c, c)
    text = F.coalesce(F.col(text_col), F.lit(""))
    worded = let(F.filter(F.split(text, "\n", -1), lambda x: F.length(F.trim(x, F.lit(ASCII_SPACE))) > 0),
                 lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
    counts = let(words_of(text_col), lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("r")))
    w, x = fresh(docs, "llm_words", "llm_lines")
    return (
        docs.withColumns({
            w: counts, x: worded,
            name("word_chars"): F.length(F.translate(text, ASCII_SPACE, "")).cast("long"),
            name("n_symbols"): (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        })
        .withColumns({
            name("n_words"): F.col(w)["n"].cast("long"), name("n_repeat_words"): F.col(w)["r"],
            name("n_text_lines"): F.col(x)["n"].cast("long"), name("n_dup_lines"): (F.col(x)["n"] - F.col(x)["d"]).cast("long"),
        })
        .drop(w, x)
    )


BASE_FAILED = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)"
MEASURE_SQL = {
    "symbols_pm": "1000 * n_symbols div greatest(word_chars, 1)",
    "dup_lines_pm": "1000 * n_dup_lines div greatest(n_text_lines, 1)",
}
# Lower end of the bucket of v: all but the six leading bits cleared.
BUCKET_SQL = "shiftleft(shiftright(v, greatest(length(bin(v)) - 6, 0)), greatest(length(bin(v)) - 6, 0))"


def sketches(metrics: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): the counts of every cell."""
    values = F.explode(F.map_from_arrays(F.array(*map(F.lit, MEASURE_SQL)), F.array(*map(F.expr, MEASURE_SQL.values()))))
    return (
        metrics.select("lang", "source", values.alias("measure", "v"))
        .groupBy("lang", "source", "measure", F.expr(BUCKET_SQL).alias("bucket")).agg(F.count("*").alias("n"))
    )


def thresholds(cells: DataFrame) -> DataFrame:
    """(lang, source, symbols_pm, dup_lines_pm): the fences of each cell.

    fence = median + 6 (median - first quartile), never below the least fence. Half of a cell may
    be junk before its own junk moves the median. Cells of fewer than 50 documents use the
    merged sketch of the language, languages of fewer that of everything.
    """
    each = cells.groupBy("lang", "source", "measure", "bucket").agg(F.sum("n").alias("n"), F.lit(0).alias("level"))
    lang = each.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("n"))
    merged = each.select("level", "lang", "source", "measure", "bucket", "n").unionByName(
        lang.select(F.lit(1).alias("level"), "lang", F.lit(None).cast("string").alias("source"), "measure", "bucket", "n")
    ).unionByName(
        lang.groupBy("measure", "bucket").agg(F.sum("n").alias("n")).select(
            F.lit(2).alias("level"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), "measure", "bucket", "n"))
    whole = Window.partitionBy("level", "lang", "source", "measure")
    upto = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(whole)})
    at = lambda p: F.min(F.when(F.expr(f"100 * upto >= {p} * total"), F.col("bucket")))
    quantiles = ranked.groupBy("level", "lang", "source", "measure").agg(at(25).alias("q25"), at(50).alias("q50"), F.max("total").alias("docs"))
    least = F.element_at(F.create_map(*[F.lit(x) for kv in MEASURES.items() for x in kv]), F.col("measure"))
    fence = F.greatest(least.cast("long"), F.expr(f"q50 + {SPREADS} * (q50 - q25)")).alias("fence")
    wide = lambda level: quantiles.filter(F.col("level") == level).select("lang", "source", "measure", "docs", fence)
    cell, by_lang, every = wide(0), wide(1), wide(2)
    joined = (
        cell.join(by_lang.select(F.col("lang").alias("l"), F.col("measure").alias("m"), F.col("docs").alias("ld"), F.col("fence").alias("lf")),
                  F.col("lang").eqNullSafe(F.col("l")) & (F.col("measure") == F.col("m")))
        .join(every.select(F.col("measure").alias("e"), F.col("fence").alias("ef")), F.col("measure") == F.col("e"))
        .select("lang", "source", "measure",
                F.when(F.col("docs") >= MIN_CELL, F.col("fence")).when(F.col("ld") >= MIN_CELL, F.col("lf")).otherwise(F.col("ef")).alias("fence"))
    )
    return joined.groupBy("lang", "source").agg(*[F.max(F.when(F.col("measure") == m, F.col("fence"))).alias(f"{m}_fence") for m in MEASURES])


def judged(metrics: DataFrame) -> DataFrame:
    """``metrics`` with base_failed, the cell's fences and kept. Null lang or source is a cell of its own."""
    fences = written(thresholds(sketches(metrics)), "quality-fences")
    f = fences.select(F.col("lang").alias("f_lang"), F.col("source").alias("f_source"), *[f"{m}_fence" for m in MEASURES])
    within = " AND ".join(f"{sql} <= {m}_fence" for m, sql in MEASURE_SQL.items())
    return (
        metrics.join(f, F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(F.col("f_source")), "left")
        .drop("f_lang", "f_source")
        .withColumn("base_failed", F.expr(BASE_FAILED))
        .withColumn("kept", F.expr(f"NOT base_failed AND {within}"))
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """Measures and verdict of every row of (doc_id, text, lang, source); null texts have no words."""
    metrics = written(measured(docs.select("doc_id", "text", "lang", "source")).drop("text"), "quality-measures")
    return judged(metrics)


def quality_filter(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with its columns as they are.

    The measured rows are written once; the sketches read only the measures of that table, and
    the fences, a row per cell, join it without moving texts.
    """
    inner = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_text_lines", "base_failed", "kept"]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    metrics = written(measured(docs.select(row, "text", "lang", "source")).drop("text"), "quality-rows")
    assert not set(inner) & {"row", "lang", "source"}
    return judged(metrics).filter("kept").select("row.*")
