"""URL filters: host and path rules, and a character language-model ratio for what no rule judges.

Two variable-order Markov models over characters, one of accepted and one of rejected URLs, are
counted from whole URLs that the rules judge: query and fragment too, and what has no ``://``. A model keeps
every gram (a character and up to ``ORDER`` before it) that it has seen, so rare ones count at any
input size. Probabilities are interpolated down to a uniform base by Witten-Bell weights.

The log probability of a URL is a sum over its substrings: each kept context adds the weight of
the shorter one, each kept gram corrects what the shorter one estimates. Scoring is therefore one
explosion, one join with a weight per substring, and one sum that starts in the task that reads the
URL. Up to ``MOST_BROADCAST`` weights are broadcast. Beyond that only those of frequent grams are, which make up
at least ``1 / GRAMS`` of a model's characters (at most ``GRAMS`` of each length and model); the substrings
that are none of these are joined with the other weights by shuffle. A score is the
difference of both models' log probabilities by predicted character (but for a constant, which the
threshold takes up); URLs kept out of the counts set the threshold that parts them with the least error.

All steps are DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import scratch

ORDER = 4
GRAMS = 20_000
MOST_BROADCAST = 2 * (ORDER + 1) * GRAMS
ALPHABET = 65_536  # characters that the base is spread over
BEGIN, END = "\x02", "\x03"
BIN, BINS = 0.005, 2000  # width and number, on each side of zero, of the bins that calibrate
HELD_OUT = 5  # one judged URL in so many calibrates
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]  # verdict (allow or block), host, path


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; empty if there is none."""
    return F.translate(F.regexp_extract(_after(url), "^([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    """From the host's end to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1)


def full(url: Column) -> Column:
    """The URL as the models see it: all of it, its host in lower case; empty for a null."""
    before = F.when(F.instr(url, "://") > 0, F.left(url, F.instr(url, "://") + 2)).otherwise(url)
    return F.coalesce(F.concat(before, host(url), F.substr(_after(url), F.length(host(url)) + 1)), F.lit(""))


def judged(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, and the ``rule`` and its ``ruling`` that fit, or nulls.

    A rule fits its host and the hosts below it if the path starts with the rule's; the longest
    wins, of equals the one with the longer host, then a block. Columns of these names are replaced.
    """
    rows = pages.withColumns({"host": host(F.col(url)), "path": path(F.col(url))})
    none = F.lit(None).cast("struct<size:int,host:int,ruling:string,rule:string>")
    fits = [
        F.when(
            ((F.col("host") == h) | F.endswith(F.col("host"), F.lit("." + h))) & F.startswith(F.col("path"), F.lit(p)),
            F.struct(F.lit(len(h + p)).alias("size"), F.lit(len(h)).alias("host"), F.lit(v).alias("ruling"), F.lit(h + p).alias("rule")))
        for v, h, p in rules
    ]
    rows = rows.withColumn("_best", F.greatest(*fits, none, none))
    return rows.withColumns({"rule": F.col("_best.rule"), "ruling": F.col("_best.ruling")}).drop("_best")


def _grams(rows: DataFrame, *others: str) -> DataFrame:
    """One row per substring of ``_text`` of up to ``ORDER`` + 1 characters; the beginning is no gram of its own."""
    text = F.col("_text")
    upto = lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(ORDER + 1), F.length(text) - i + 1)), lambda n: F.substr(text, i, n))
    return rows.select(*others, F.explode(F.flatten(F.transform(F.sequence(F.lit(1), F.length(text)), upto))).alias("gram"))


def weights(urls: DataFrame) -> DataFrame:
    """(gram, weight, frequent): what each substring adds to the difference, from ``_text`` and ``accepted`` of
    ``urls``, and whether it may be broadcast.

    Empty if a class has no URL.
    """
    sides = {"a": F.col("accepted"), "r": ~F.col("accepted")}
    size = F.length("_text") - 1
    counts = _grams(urls, "accepted").where(F.col("gram") != BEGIN).groupBy("gram").agg(
        *[F.count(F.when(on, 1)).alias(f"c_{s}") for s, on in sides.items()])
    frequent = F.lit(False)
    for s, on in sides.items():
        total = urls.agg(F.sum(F.when(on, size))).scalar()
        frequent = frequent | F.coalesce(F.col(f"c_{s}") * GRAMS >= F.greatest(total, F.lit(1)), F.lit(False))
    counts = counts.withColumns({"frequent": frequent, "n": F.length("gram")} | {f"c_{s}": F.nullif(f"c_{s}", F.lit(0)) for s in sides})
    within = Window.partitionBy(F.expr("left(gram, n - 1)"))
    counts = counts.withColumns({f"{k}_{s}": v for s in sides for k, v in (
        ("kinds", F.count(f"c_{s}").over(within)), ("all", F.sum(f"c_{s}").over(within)))})
    stored = scratch(urls.sparkSession, "url-grams")
    counts.write.parquet(stored)
    counts = urls.sparkSession.read.parquet(stored)

    def backoff(s: str) -> Column:
        return F.col(f"kinds_{s}") / (F.col(f"all_{s}") + F.col(f"kinds_{s}"))

    def smoothed(s: str, lower: Column) -> Column:
        own = F.col(f"c_{s}") / (F.col(f"all_{s}") + F.col(f"kinds_{s}"))
        return F.when(F.col(f"c_{s}").isNotNull(), own + backoff(s) * lower)

    base = F.lit(1.0 / ALPHABET)
    level = counts.where("n = 1").withColumns({f"low_{s}": base for s in sides})
    done = None
    for k in range(1, ORDER + 2):
        level = level.withColumns({f"p_{s}": smoothed(s, F.col(f"low_{s}")) for s in sides})
        corrections = {s: F.coalesce(F.log(F.col(f"p_{s}") / (backoff(s) * F.col(f"low_{s}"))), F.lit(0.0)) for s in sides}
        part = level.select("gram", (corrections["a"] - corrections["r"]).alias("weight"), "frequent")
        done = part if done is None else done.unionByName(part)
        if k <= ORDER:
            lower = level.select(F.col("gram").alias("_suffix"), *[F.col(f"p_{s}").alias(f"low_{s}") for s in sides])
            level = counts.where(F.col("n") == k + 1).join(lower, F.expr(f"right(gram, {k})") == F.col("_suffix")).drop("_suffix")
    contexts = counts.where("n > 1").groupBy(F.expr("left(gram, n - 1)").alias("gram")).agg(
        *[F.max(F.when(F.col(f"kinds_{s}") > 0, F.log(backoff(s)))).alias(f"b_{s}") for s in sides])
    # A context is a gram as well, but for the beginning, which every URL has.
    contexts = contexts.select("gram", (F.coalesce("b_a", F.lit(0.0)) - F.coalesce("b_r", F.lit(0.0))).alias("weight"), (F.col("gram") == BEGIN).alias("frequent"))
    return done.unionByName(contexts).groupBy("gram").agg(F.sum("weight").alias("weight"), F.max("frequent").alias("frequent"))


def filtered(pages: DataFrame, rules: Sequence[Rule], url: str = "url", key: str = "page_id") -> DataFrame:
    """One row per row of ``pages``: ``key``, ``host``, ``path``, ``rule``, ``score`` and ``verdict``.

    The verdict is the rule's; else ``allow`` if the score reaches the threshold, else ``block``. Without
    an accepted or a rejected URL to learn from there is no threshold, and what no rule judges is
    allowed. A null URL has an empty host and path and is scored as such. Repeated rows stay; other
    columns are not read.
    """
    spark = pages.sparkSession
    rows = judged(pages.select(F.col(key).alias("_key"), F.col(url).alias("_url")), rules, "_url")
    rows = rows.withColumn("_text", F.concat(F.lit(BEGIN), full(F.col("_url")), F.lit(END)))
    held = F.pmod(F.crc32("_text"), F.lit(HELD_OUT)) == 0
    learned = rows.where(F.col("ruling").isNotNull() & ~held).select("_text", (F.col("ruling") == "allow").alias("accepted"))
    found = scratch(spark, "url-weights")
    weights(learned).write.parquet(found)
    table = spark.read.parquet(found)
    wide = rows.select(F.monotonically_increasing_id().alias("_row"), "_key", "host", "path", "rule", "ruling", held.alias("held"), "_text")
    keys = ["_row", "_key", "host", "path", "rule", "ruling", "held"]
    wide = wide.withColumn("_size", F.length("_text") - 1)
    few = table.count() <= MOST_BROADCAST
    if not few:
        numbered = scratch(spark, "url-rows")  # so that numbers stay the same
        wide.write.parquet(numbered)
        wide = spark.read.parquet(numbered)
    frequent = F.broadcast((table if few else table.where("frequent")).select("gram", "weight"))
    hits = _grams(wide, *keys, "_size").join(frequent, "gram", "left")
    sums = hits.groupBy(*keys, "_size").agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("_sum"))
    if not few:
        others = _grams(wide, "_row").join(frequent, "gram", "left_anti").join(table.where("NOT frequent").hint("shuffle_merge"), "gram")
        sums = sums.join(others.groupBy("_row").agg(F.sum("weight").alias("_more")), "_row", "left")
        sums = sums.withColumn("_sum", F.col("_sum") + F.coalesce("_more", F.lit(0.0)))
    scores = sums.select(*keys, (F.col("_sum") / F.col("_size")).alias("score"))
    stored = scratch(spark, "url-scores")
    scores.write.parquet(stored)
    scores = spark.read.parquet(stored)

    bin_ = F.greatest(F.lit(-BINS), F.least(F.lit(BINS), F.floor(F.col("score") / BIN))).cast("int")
    sure = scores.where("held AND ruling IS NOT NULL").groupBy(bin_.alias("bin")).agg(
        F.count(F.when(F.col("ruling") == "allow", 1)).alias("a"), F.count(F.when(F.col("ruling") == "block", 1)).alias("r"))
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # over at most 2 * BINS + 1 rows
    whole = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = lambda c: F.try_divide(F.coalesce(F.sum(c).over(below), F.lit(0)), F.sum(c).over(whole))
    error = share("a") + 1 - share("r")  # null if a class is missing
    cuts = sure.select("bin", error.alias("error"))
    threshold = cuts.where("error IS NOT NULL").agg(F.min(F.struct("error", "bin"))["bin"] * BIN).scalar()
    verdict = F.coalesce("ruling", F.when(F.col("score") >= F.coalesce(threshold, F.lit(float("-inf"))), "allow").otherwise("block"))
    return scores.select(F.col("_key").alias(key), "host", "path", "rule", "score", verdict.alias("verdict"))
