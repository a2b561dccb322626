"""Quality rules whose thresholds are learned from the corpus, for each language and source.

Every text is measured once, by built-in functions only: words, code points in words, symbols, repeated lines, and words in repeated
8-word windows. Ratios of these are the metrics. A metric's distribution in a (language, source) is a sketch of counts by logarithmic
bucket (Masson, Rim and Lee, 2019): the quantiles it gives are within ACCURACY of a true one, and two sketches merge by adding
counts, exactly and in any order. So the sketches of all sources of a language make the language's, and those make that of the corpus,
without another pass; results don't depend on partitions.

A threshold is a fence: the upper quartile and three times the quartiles' distance above it (Tukey, 1977), for word length one below the
lower quartile too. A distance counts as at least METRICS' least spread, as many metrics are 0 in most documents. A source with
fewer than LEAST documents takes its language's fences, a language with fewer those of the corpus, and a corpus with fewer has none.
The fences are joined to the documents, whose verdict they decide.

Cases: null text has no words; it fails the base rules, as do all texts under 20 words. Documents without words aren't in the sketches. A null
language or source is a language or source of its own. Repeated rows are documents each. Windows are compared by a 64-bit hash inside one
text. Very long texts are measured whole, as arrays of their words in their row. Other columns are not looked at; `drop_low_quality`
passes them on, whatever their names. An empty table gives an empty result."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import as_table, join_counted, struct_of_all

SEPARATORS = "\t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"
WORD = r"[^\x20\x09-\x0D]"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30

#: Relative error of a sketch's quantiles, the fence's width in quartile distances, and the documents that a group's own fences take.
ACCURACY, REACH, LEAST = 0.01, 3.0, 100
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
#: The bucket of 0, below all others.
ZERO = -1_000_000


@dataclass(frozen=True)
class Metric:
    name: str
    part: str
    whole: str
    least_spread: float
    low: bool


METRICS = (
    Metric("word_length", "word_chars", "n_words", 0.5, True),
    Metric("symbols", "n_symbols", "n_words", 0.04, False),
    Metric("dup_lines", "n_dup_lines", "n_lines", 0.15, False),
    Metric("repeats", "n_repeat_words", "n_words", 0.08, False),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def words_of(text: Column) -> Column:
    blank = text
    for c in SEPARATORS:
        blank = F.replace(blank, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(blank, " "), "")


def neighbours(runs: str, apart: int) -> Column:
    """A hash of each entry with the one so far behind it; none where too few are left."""
    n = F.greatest(F.size(runs) - apart, F.lit(0))
    return F.zip_with(F.slice(runs, 1, n), F.slice(runs, apart + 1, n), lambda a, b: F.xxhash64(a, b))


def measured(docs: DataFrame, *keep: Column) -> DataFrame:
    """keep and MEASURES. Each step is a projection of its own, so that arrays which are used twice are made once."""
    names = [f"keep{i}" for i in range(len(keep))]
    out = docs.select(*(c.alias(n) for c, n in zip(keep, names, strict=True)), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    out = out.select(*names, words_of(F.col("text")).alias("w"), F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"), F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    size = lambda c: F.size(c).cast("long")
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    out = out.select(*names, size("w").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"), "n_symbols", size("lines").alias("n_lines"), (size("lines") - size(F.array_distinct("lines"))).alias("n_dup_lines"), F.col("w").alias("run"))
    for apart in (1, 2, 4):  # hashes of two words, of four, and of a window
        out = out.select(*names, *counts, neighbours("run", apart).alias("run"))
    # Only a text with a repeated window has its windows sorted, each with its place.
    placed = F.when(F.size(F.array_distinct("run")) < F.size("run"), F.sort_array(F.transform("run", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    out = out.withColumn("placed", placed).drop("run")
    same = lambda x, k: (k >= 0) & (k < F.size("placed")) & (F.get("placed", k)["h"] == x["h"])
    starts = F.sort_array(F.transform(F.filter("placed", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))
    out = out.withColumn("starts", starts).drop("placed")
    # A start adds the words between it and the one before, a window's at most.
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate("starts", state, lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])
    return out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).select(*names, *MEASURES)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def ratio(m: Metric) -> Column:
    """Null if there is nothing to divide by."""
    return F.try_divide(F.col(m.part).cast("double"), F.col(m.whole).cast("double"))


def bucket(x: Column) -> Column:
    return F.when(x > 0, F.ceil(F.ln(x) / F.lit(math.log(GAMMA))).cast("int")).when(x == 0, ZERO)


def value_of(b: Column) -> Column:
    """The value that a bucket stands for, within ACCURACY of all it holds."""
    return F.when(b == ZERO, F.lit(0.0)).otherwise(2 * F.pow(F.lit(GAMMA), b) / (GAMMA + 1))


def sketches(measures: DataFrame) -> DataFrame:
    """lang, source, metric, bucket, n: a sketch for each group and metric. Counted where the rows are; a row for each bucket is shuffled."""
    each = F.explode(F.array(*(F.struct(F.lit(m.name).alias("metric"), bucket(ratio(m)).alias("bucket")) for m in METRICS)))
    return measures.where("n_words > 0").select("lang", "source", each.alias("m")).groupBy("lang", "source", "m.metric", "m.bucket").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, *by: str) -> DataFrame:
    """Sketches of coarser groups: counts added up."""
    return sketch.groupBy(*by, "metric", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, *by: str) -> DataFrame:
    """by, metric, docs, q1, q3. A group's buckets are as many as the logarithm of its range."""
    order = Window.partitionBy(*by, "metric").orderBy("bucket")
    counted = sketch.withColumns({"upto": F.sum("n").over(order), "docs": F.sum("n").over(Window.partitionBy(*by, "metric"))})
    at = lambda p: F.min(F.when(F.col("upto") >= F.ceil(F.col("docs") * F.lit(p)), F.col("bucket")))
    found = counted.groupBy(*by, "metric").agg(F.max("docs").alias("docs"), at(0.25).alias("b1"), at(0.75).alias("b3"))
    return found.select(*by, "metric", "docs", value_of(F.col("b1")).alias("q1"), value_of(F.col("b3")).alias("q3"))


def fences(sketch: DataFrame, reach: float = REACH, least: int = LEAST) -> DataFrame:
    """lang, source and, for each metric, its low and high fence. sketch: a written table."""
    groups = sketch.select("lang", "source", "metric").distinct()
    own, langs, whole = quartiles(sketch, "lang", "source"), quartiles(merged(sketch, "lang"), "lang"), quartiles(merged(sketch))
    enough = lambda df, name: df.where(F.col("docs") >= least).select(*(c for c in ("lang", "source") if c in df.columns), "metric", F.struct("q1", "q3").alias(name))
    g, o, lg, w = groups.alias("g"), enough(own, "own").alias("o"), enough(langs, "of_lang").alias("l"), enough(whole, "of_all").alias("w")
    joined = g.join(o, F.expr("g.lang <=> o.lang and g.source <=> o.source and g.metric = o.metric"), "left").join(lg, F.expr("g.lang <=> l.lang and g.metric = l.metric"), "left").join(w, F.expr("g.metric = w.metric"), "left")
    q = joined.select("g.lang", "g.source", "g.metric", F.coalesce("own", "of_lang", "of_all").alias("q"))
    each = []
    for m in METRICS:
        reach_of = reach * F.greatest(F.col("q.q3") - F.col("q.q1"), F.lit(m.least_spread))
        mine = F.col("metric") == m.name
        each.append(F.max(F.when(mine, F.col("q.q3") + reach_of)).alias(f"{m.name}_high"))
        if m.low:
            each.append(F.max(F.when(mine, F.col("q.q1") - reach_of)).alias(f"{m.name}_low"))
    return q.groupBy("lang", "source").agg(*each)


def within() -> Column:
    """Whether every metric is inside its fences; a missing fence or metric lets pass."""
    out = F.lit(True)
    for m in METRICS:
        out = out & F.coalesce(ratio(m) <= F.col(f"{m.name}_high"), F.lit(True))
        if m.low:
            out = out & F.coalesce(ratio(m) >= F.col(f"{m.name}_low"), F.lit(True))
    return out


def with_fences(measures: DataFrame, limits: DataFrame) -> DataFrame:
    """Documents with their group's fences; broadcast if these are counted to be few."""
    limits = limits.withColumnsRenamed({"lang": "limit_lang", "source": "limit_source"})
    return join_counted(measures, limits, F.expr("lang <=> limit_lang and source <=> limit_source"), "left", F.lit(64)).drop("limit_lang", "limit_source")


def judged(measures: DataFrame, reach: float = REACH, least: int = LEAST) -> DataFrame:
    """Adds base_failed and kept. measures: lang, source, MEASURES and what else there is; a written table, as it is read twice."""
    limits = as_table(fences(as_table(sketches(measures), "sketches"), reach, least), "fences")
    return with_fences(measures, limits).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & within())


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, the verdict, and the metrics that decided it."""
    kept = as_table(measured(docs, F.col("doc_id"), F.col("lang"), F.col("source")).withColumnsRenamed({"keep0": "doc_id", "keep1": "lang", "keep2": "source"}), "measures")
    return judged(kept).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def drop_low_quality(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns. Their rows don't wait in a table: texts are measured again beside them."""
    small = as_table(measured(docs, F.col("lang"), F.col("source")).withColumnsRenamed({"keep0": "lang", "keep1": "source"}), "measures")
    limits = as_table(fences(as_table(sketches(small), "sketches")), "fences")
    again = measured(docs, F.col("lang"), F.col("source"), struct_of_all(docs)).withColumnsRenamed({"keep0": "lang", "keep1": "source", "keep2": "row"})
    return with_fences(again, limits).where(~base_failed() & within()).select("row.*")
