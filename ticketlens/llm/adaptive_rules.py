"""Quality rules with adaptive thresholds, all in DataFrame functions.

Each document gets a few measures. Per language and source, mergeable quantile sketches (KLL)
describe how the measures are spread; a document fails when a measure lies far outside its group's
middle half. Sketches of small groups are merged up to their language, and those of small languages
up to the whole corpus, so every threshold rests on enough documents.

Scale: the measures (a few numbers a document, no text) are written once. Sketches are combined map
side, so a source with a third of all rows sends one sketch per task. Thresholds are one row per
(language, source), joined back to the measures; adaptive execution splits a hot source.

Defined cases: a null or empty text has no words, which fails the base rules; null language or
source form groups of their own; repeated rows are judged each, alike; a very long text is measured
whole like any other; a measure that ties with its threshold passes; an empty table gives an empty result. Columns that the operator adds replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.cluster import unused_prefix
from ticketlens.session import materialise

BLANKS = r"[\x20\x09-\x0D]"
WORDS = r"[^\x20\x09-\x0D]+"
SKETCH_K = 1024  # rank error of about 0.1 %
LEAST_ROWS = 100  # documents that a threshold has to rest on
FENCE = 3.0  # distances of the quartiles beyond which a measure is an outlier
#: Measure -> least distance of the quartiles that counts, and the allowance for short texts
#: (divided by the root of the word count, as the spread of a mean is). The least distances are small,
#: so that a measure can reject what the base rules pass, also in a group that is clean throughout.
MEASURES = {"word_length": (0.5, 8.0), "symbol_share": (0.05, 0.3), "dup_line_share": (0.05, 0.0),
            "repeat_share": (0.02, 0.0)}
LOWER_TOO = ("word_length",)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row. (A column that is only named inside a
    lambda would be inlined there and computed for each element.)"""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(words: Column) -> Column:
    """Words in five-word windows that the text holds at least twice, the first included."""

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            twin = F.filter(s, lambda x, j: (x["h"] == F.get(s, j - 1)["h"])
                            | (x["h"] == F.get(s, j + 1)["h"]))
            return F.sort_array(F.transform(twin, lambda x: x["i"]))

        def spread(p: Column) -> Column:
            steps = F.transform(p, lambda x, j: F.least(F.lit(5), F.coalesce(F.get(p, j + 1) - x, F.lit(5))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        return _let(_let(pairs, places), spread)

    def count(hashes: Column) -> Column:
        same = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(same, F.lit(0).cast("long")).otherwise(covered(hashes))

    def five(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - 5)
        return F.transform(places, lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(5))))

    word_hashes = F.transform(words, lambda x: F.xxhash64(x))
    return F.when(F.size(words) < 6, F.lit(0).cast("long")).otherwise(_let(_let(word_hashes, five), count))


def base_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its text but with word and line counts, and whether the base rules fail."""
    kept = [c for c in docs.columns if c.lower() != text_col.lower()]
    text = F.coalesce(F.col(text_col), F.lit(""))
    solid_lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORDS))

    def digest(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), _repeated_words(w).alias("n_repeat_words"))

    def dups(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"),
                        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    all_words = F.filter(F.split(text, BLANKS + "+"), lambda x: x != "")
    pre = unused_prefix(docs)
    made = {pre + "w": _let(all_words, digest), pre + "l": _let(solid_lines, dups),
            "word_chars": (F.length(text) - F.regexp_count(text, F.lit(BLANKS))).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long")}
    names = {*made, "n_words", "n_repeat_words", "n_lines", "n_dup_lines", "base_failed"}
    rest = [c for c in kept if c.lower() not in names]
    out = docs.select(*rest, *(v.alias(k) for k, v in made.items()))
    out = out.select(*rest, f"{pre}w.n_words", "word_chars", "n_symbols", f"{pre}l.n_lines", f"{pre}l.n_dup_lines",
                     f"{pre}w.n_repeat_words")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def _with_shares(rows: DataFrame) -> DataFrame:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return rows.withColumns({
        "word_length": F.col("word_chars") / n, "symbol_share": F.col("n_symbols") / n,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / n})


def thresholds(rows: DataFrame, groups: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """Quartiles of each measure per group, from sketches merged up where a group is small."""
    lang, source = groups
    passed = rows.where(~F.col("base_failed"))
    fine = passed.groupBy(lang, source).agg(
        F.count(F.lit(1)).alias("n"), *(F.kll_sketch_agg_double(m, F.lit(SKETCH_K)).alias(m) for m in MEASURES))
    fine = materialise(fine, "sketches")

    def merged(*keys: str) -> DataFrame:
        return fine.groupBy(*keys).agg(F.sum("n").alias("n"),
                                       *(F.kll_merge_agg_double(m, F.lit(SKETCH_K)).alias(m) for m in MEASURES))

    def quartiles(df: DataFrame, level: str, *keys: str) -> DataFrame:
        ranks = F.array(F.lit(0.25), F.lit(0.75))
        return df.select(*(F.col(k).alias(f"{level}_{k}") for k in keys),
                         F.when(F.col("n") >= LEAST_ROWS, F.struct(
                             *(F.kll_sketch_get_quantile_double(m, ranks).alias(m) for m in MEASURES))).alias(level))

    whole = quartiles(merged(), "whole").withColumn("one", F.lit(1))
    by_lang = quartiles(merged(lang), "by_lang", lang)
    by_both = quartiles(fine, "by_both", lang, source)
    out = by_both.join(by_lang, F.col(f"by_both_{lang}").eqNullSafe(F.col(f"by_lang_{lang}")), "left")
    out = out.withColumn("one", F.lit(1)).join(whole, "one", "left")  # one row on the right
    return out.select(F.col(f"by_both_{lang}").alias("t_lang"), F.col(f"by_both_{source}").alias("t_source"),
                      F.coalesce("by_both", "by_lang", "whole").alias("t"))


def judge(docs: DataFrame, text_col: str = "text", groups: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """Measures of each document, the names of the measures out of bounds, and ``kept``.

    Where a group, its language and the whole corpus are all too small, only the base rules hold."""
    rows = materialise(_with_shares(base_measures(docs, text_col)), "measures")
    lang, source = groups
    pre = unused_prefix(rows)
    a, b, t = (pre + c for c in ("lang", "source", "t"))
    table = thresholds(rows.select(*groups, "base_failed", *MEASURES), groups).toDF(a, b, t)
    out = rows.join(table, F.col(lang).eqNullSafe(F.col(a)) & F.col(source).eqNullSafe(F.col(b)), "left")
    root = F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    broken = []
    for m, (least, allowance) in MEASURES.items():
        low, high = F.col(t)[m][0], F.col(t)[m][1]
        reach = FENCE * F.greatest(high - low, F.lit(least)) + F.lit(allowance) / root
        bad = F.col(m) > high + reach
        if m in LOWER_TOO:
            bad = bad | (F.col(m) < low - reach)
        broken.append(F.when(F.coalesce(bad, F.lit(False)), F.lit(m)))
    out = out.withColumn("broken", F.array_compact(F.array(*broken)))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0)).drop(a, b, t)
