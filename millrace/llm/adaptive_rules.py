"""Quality rules whose limits come from the data: mergeable quantile sketches per language and source.

Each text gives a few measures as whole numbers. Their distribution per language and source is
sketched as a histogram of log-linear bins (exact up to ``EXACT``, then ``EXACT / 2`` bins for each doubling, so
a quantile is known to about ``2 / EXACT`` of itself). Such sketches merge by adding counts, so a hot source is
counted on the map side, and the sketches of a language and of all texts are merged out of the same rows.

A limit is a fence ``REACH`` times the inner spread from the median. The spread is the distance of the
quartile from the median, which junk cannot move while it is less than a quarter of the texts; where even
the quartile is the median, as of rare symbols, it is that of the outer tenth, which
holds while junk is less than a tenth of all texts. A group without either takes the limit of its
language, a language without either that of all texts, and there the spread is at least one step of the measure. A share's limit
is never looser than that of the language or of all texts, so that a source full of junk does not set its own; the length of
words is a matter of style, and each group's own. A group or language with fewer than ``LEAST`` texts takes the next wider limits. Texts are joined with their group's limits.

All steps are DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import scratch

EXACT = 64
LEAST = 200
#: seven times the distance from median to quartile is the outer fence of a box plot, three box lengths beyond the box
REACH = 7
ALL = ["_all"]
#: measure: side of its fence, and whether wider limits bind it
FENCES = {
    "symbol_permille": ("high", True),
    "dup_line_permille": ("high", True),
    "repeat_word_permille": ("high", True),
    "mean_word_decichars": ("high", False),
    "mean_word_low": ("low", False),
}
SPACES = "\t\n\x0b\x0c\r"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Runs of characters other than space and the control characters 9 to 13."""
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")


def repeated_words(found: Column) -> Column:
    """Words in five-word windows that occur twice or more in the text, first occurrences included."""
    def windows(w: Column) -> Column:
        return F.transform(F.slice(w, 1, F.size(w) - 4), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2), F.get(w, i + 3), F.get(w, i + 4)))

    def covered(places: Column) -> Column:
        """Words that windows at these sorted places cover: five each, less the overlap with the next."""
        gaps = F.zip_with(places, F.slice(places, F.lit(2), F.size(places)), lambda a, b: F.least(F.coalesce(b - a, F.lit(5)), F.lit(5)))
        return F.aggregate(gaps, F.lit(0), lambda s, g: s + g)

    def counted(hashes: Column) -> Column:
        def paired(order: Column) -> Column:
            # Sorted by hash, a window repeats if a neighbour has its hash.
            same = lambda i, j: F.get(order, i)["h"].eqNullSafe(F.get(order, j)["h"])
            twice = F.filter(order, lambda x, i: same(i, i + 1) | ((i > 0) & same(i, i - 1)))
            return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(pairs, paired))

    return F.when(F.size(found) < 6, F.lit(0)).otherwise(let(windows(found), counted))


def measured(documents: DataFrame) -> DataFrame:
    """Counts of each whole text; a null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select("doc_id", "lang", "source", text.alias("_text"))
    rows = rows.select(
        "doc_id", "lang", "source",
        let(words(F.col("_text")), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).cast("long").alias("n_repeat_words"))).alias("_w"),
        F.regexp_count(F.col("_text"), F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(F.filter(F.split(F.col("_text"), "\n"), lambda x: F.btrim(x, F.lit(" " + SPACES)) != ""),
            lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("_l"),
    )
    return rows.select("doc_id", "lang", "source", "_w.*", "n_symbols", "_l.*")


def share(part: str, whole: str, scale: int) -> Column:
    """A whole number: ``part`` per ``scale`` of ``whole``; zero of nothing."""
    return F.when(F.col(whole) > 0, F.expr(f"({part} * {scale}) div {whole}")).otherwise(F.lit(0)).cast("long")


#: part, whole and scale
MEASURES = {
    "symbol_permille": ("n_symbols", "word_chars", 1000),
    "dup_line_permille": ("n_dup_lines", "n_lines", 1000),
    "repeat_word_permille": ("n_repeat_words", "n_words", 1000),
    "mean_word_decichars": ("word_chars", "n_words", 10),
    "mean_word_low": ("word_chars", "n_words", 10),
}
#: What a text is not judged for: one symbol, one repeated line, one window with its copy hold no pattern yet,
#: however large their share of a short text is.
SINGLE = {"n_symbols": 1, "n_dup_lines": 1, "n_repeat_words": 10}


def bin_of(value: Column) -> Column:
    """Bin number of a whole number from 0 on: itself below ``EXACT``, then by its leading bits."""
    bits = EXACT.bit_length() - 1
    extra = F.greatest(F.length(F.bin(value)) - bits, F.lit(0))
    return (extra * (EXACT // 2) + F.call_function("shiftright", value.cast("int"), extra)).cast("int")


def low_end(number: Column) -> Column:
    """Least value of a bin."""
    half = EXACT // 2
    extra = F.greatest((number / half).cast("int") - 1, F.lit(0))
    return F.call_function("shiftleft", number - extra * half, extra).cast("long")


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, measure, bin, c): one histogram for each group and measure."""
    kept = rows.select("lang", "source", *[share(*MEASURES[m]).alias(m) for m in MEASURES])
    long = kept.unpivot(["lang", "source"], list(MEASURES), "measure", "value")
    return long.groupBy("lang", "source", "measure", bin_of(F.col("value")).alias("bin")).agg(F.count(F.lit(1)).alias("c"))


def quantiles(histogram: DataFrame, keys: list[str]) -> DataFrame:
    """Median, quartile and outer tenth of each measure on its fence's side, and the number of texts, by ``keys``."""
    merged = histogram.groupBy(*keys, "measure", "bin").agg(F.sum("c").alias("c"))
    # A group has at most as many rows as a histogram has bins.
    upto = Window.partitionBy(*keys, "measure").orderBy("bin")
    ranked = merged.withColumns({"upto": F.sum("c").over(upto), "total": F.sum("c").over(Window.partitionBy(*keys, "measure"))})
    high = F.col("measure").isin([m for m in FENCES if FENCES[m][0] == "high"])
    at = lambda percent: low_end(F.min(F.when(F.col("upto") * 100 >= F.col("total") * percent, F.col("bin"))))
    return ranked.groupBy(*keys, "measure", "total").agg(
        at(F.lit(50)).alias("median"), at(F.when(high, 75).otherwise(25)).alias("quartile"), at(F.when(high, 90).otherwise(10)).alias("tenth"))


def fences(histogram: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each value of ``keys``: the number of texts ``_n`` and each measure's own fence, null without a spread."""
    quartile, tenth = (F.abs(F.col(x) - F.col("median")) for x in ("quartile", "tenth"))
    spread = F.when(quartile > 0, quartile).when(tenth > 0, tenth)
    if keys == ALL:
        spread = F.coalesce(spread, F.lit(1))
    wide = []
    for m, (side, _) in FENCES.items():
        fence = F.col("median") + (REACH if side == "high" else -REACH) * spread
        wide.append(F.max(F.when(F.col("measure") == m, fence)).alias(m))
    return quantiles(histogram, keys).groupBy(*keys).agg(F.max("total").alias("_n"), *wide)


def limits(rows: DataFrame) -> DataFrame:
    """(lang, source, and a limit for each measure), for each group of ``rows``."""
    spark = rows.sparkSession
    path = scratch(spark, "quality-sketches")
    sketches(rows).write.parquet(path)
    found = spark.read.parquet(path)
    whole = fences(found.withColumns({k: F.lit(0) for k in ALL}), ALL).select(F.struct(*FENCES)).scalar()  # one row
    enough = F.col("_n") >= LEAST

    def within(m: str, wider: Column) -> Column:
        """The group's fence, or the wider limit; for shares the lower of the two (``least`` passes over nulls)."""
        return (F.least if FENCES[m][1] else F.coalesce)(F.when(enough, F.col(m)), wider)

    by_lang = fences(found, ["lang"]).select(F.col("lang").alias("_lang"), *[within(m, whole[m]).alias(f"_{m}") for m in FENCES])
    joined = fences(found, ["lang", "source"]).join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")))
    return joined.select("lang", "source", *[within(m, F.col(f"_{m}")).alias(f"_limit_{m}") for m in FENCES])


def judged(documents: DataFrame) -> DataFrame:
    """One row per row of ``documents``: ``doc_id``, the counts, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than ten words, or over a fifth of them in repeated windows. Others are
    kept unless a measure lies beyond its group's limit. Null and empty texts have no words and fail;
    a null language or source is a group like any other. Rows that repeat are judged alike. Texts of any length are measured
    whole; other columns of ``documents`` are not read.
    """
    spark = documents.sparkSession
    path = scratch(spark, "quality-measures")
    measured(documents).write.parquet(path)
    rows = spark.read.parquet(path)
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    rows = rows.withColumn("base_failed", failed)
    # Texts that fail anyway do not shape the limits.
    found = limits(rows.where("NOT base_failed")).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = rows.join(found, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    inside = F.lit(True)
    for m, (side, _) in FENCES.items():
        part, total, scale = MEASURES[m]
        value = share(f"greatest({part} - {SINGLE.get(part, 0)}, 0)", total, scale)
        inside = inside & F.coalesce((value <= F.col(f"_limit_{m}")) if side == "high" else (value >= F.col(f"_limit_{m}")), F.lit(True))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & inside).alias("kept"))
