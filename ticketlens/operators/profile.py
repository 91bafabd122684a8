"""Column profiling (describe, schema, nulls, duplicates, numeric and categorical profiles).

Quantiles and modes are exact and computed from a *frequency table* — one row per distinct
(column, value) with its count, built by a partially aggregated group-by — instead of Spark's
``percentile``/``mode`` aggregates, whose value→count maps are merged in a single task for a global
aggregate. Nothing sorts that table: quantile sketches bracket the ranks, exact counts check the brackets,
and only the values inside them are range-sorted (:func:`ticketlens.operators.ids.with_running_total`).
Most common values are proposed by heavy-hitter summaries and settled by an exact recount.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from ticketlens.functions.money import round2
from ticketlens.operators.ids import range_tagged, with_running_total
from ticketlens.session import materialise

QUARTILES = (0.25, 0.5, 0.75)
HEAVY = 512  # values a column that a summary of heavy hitters proposes
TRACKED = 2048  # counters a column in a summary
SKETCH_K = 2048  # size of a quantile sketch: a rank error of some 0.1 %
BRACKET = 0.005  # how far above and below a rank its bracket reaches
FREQ_ORDER = ["column_name", "exact", "approx"]


def _stack(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, exact, approx) for every row × numeric column, as one generator step (no
    shuffle). Whole numbers and decimals go to ``exact`` with all their digits, floating-point
    values to ``approx`` as they are, so no two different values become one."""
    types = {f.name: f.dataType for f in df.schema.fields}
    scale = max((t.scale for t in (types[c] for c in cols) if isinstance(t, DecimalType)), default=0)
    exact_type, parts = f"decimal(38,{scale})", []
    for c in cols:
        floating = isinstance(types[c], (DoubleType, FloatType))
        parts.append(F.struct(
            F.lit(c).alias("column_name"),
            (F.lit(None) if floating else F.col(c)).cast(exact_type).alias("exact"),
            (F.col(c) if floating else F.lit(None)).cast("double").alias("approx")))
    return df.select(F.inline(F.array(*parts)))


def frequency_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, exact, approx, cnt) for every distinct value of every column, nulls included."""
    return _stack(df, cols).groupBy(*FREQ_ORDER).agg(F.count(F.lit(1)).alias("cnt"))


def _present():
    return F.col("exact").isNotNull() | F.col("approx").isNotNull()


def _as_double(exact, approx):
    return F.coalesce(exact.cast("double"), approx)


def quantile_brackets(df: DataFrame, cols: list[str], probs=QUARTILES, margin: float = BRACKET) -> DataFrame:
    """(column_name, p, lo, hi): values that the quantiles very probably lie between, one row a column and
    probability. One scan of the rows; a task sends one mergeable sketch a column. A column without
    values has no bounds."""
    value = [F.nullif(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in cols]
    found = df.agg(*[F.kll_sketch_agg_double(v, F.lit(SKETCH_K)).alias(f"s{i}") for i, v in enumerate(value)],
                   *[F.count(v).alias(f"n{i}") for i, v in enumerate(value)])
    found = materialise(found, "sketches")

    def bound(i: int, rank: float):
        return F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", F.lit(min(max(rank, 0.0), 1.0))))

    return found.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.lit(p).cast("decimal(10,4)").alias("p"),
        bound(i, p - margin).alias("lo"), bound(i, p + margin).alias("hi")) for i, c in enumerate(cols) for p in probs])))


def exact_quantiles(freq: DataFrame, brackets: DataFrame) -> DataFrame:
    """(column_name, p, quantile) with linear interpolation between order statistics (pandas /
    ``percentile`` semantics), in decimal arithmetic for exact columns. ``freq`` is a written frequency table in
    any order, read a few times; nulls don't count.

    Selection by bracketing: the values below and inside each bracket are counted exactly; a bracket that
    doesn't hold its ranks is opened to all values; and only the values inside brackets are sorted."""
    present = freq.where(_present()).withColumn("_d", _as_double(F.col("exact"), F.col("approx")))
    # no bounds, or bounds that don't hold the ranks: all values (NaN is above infinity)
    lo, hi = F.coalesce("lo", F.lit(float("-inf"))), F.coalesce("hi", F.lit(float("nan")))
    wide = F.broadcast(brackets.withColumns({"lo": lo, "hi": hi}))  # columns × probabilities rows
    counts = present.join(wide, "column_name").groupBy("column_name", "p", "lo", "hi").agg(
        F.sum("cnt").alias("_n"), F.sum(F.when(F.col("_d") < F.col("lo"), F.col("cnt")).otherwise(0)).alias("_below"),
        F.sum(F.when(F.col("_d").between(F.col("lo"), F.col("hi")), F.col("cnt")).otherwise(0)).alias("_inside"))
    counts = (counts.withColumn("_at", F.col("p") * (F.col("_n") - 1))
              .withColumn("_lo", F.floor("_at").cast("long")).withColumn("_hi", F.ceil("_at").cast("long"))
              .withColumn("_frac", F.col("_at") - F.col("_lo"))
              .withColumn("_held", (F.col("_below") <= F.col("_lo")) & (F.col("_hi") < F.col("_below") + F.col("_inside"))))
    targets = materialise(counts.select(
        "column_name", "p", "_lo", "_hi", "_frac", "_held", F.when(F.col("_held"), F.col("_below")).otherwise(0).alias("_below"),
        F.when(F.col("_held"), F.col("lo")).otherwise(float("-inf")).alias("lo"),
        F.when(F.col("_held"), F.col("hi")).otherwise(float("nan")).alias("hi")), "targets")
    keys = ["column_name", "p", "exact", "approx"]
    inside = present.join(F.broadcast(targets.select("column_name", "p", "lo", "hi")), "column_name").where(
        F.col("_d").between(F.col("lo"), F.col("hi"))).select(*keys, "cnt")
    cum = with_running_total(range_tagged(inside, keys), keys, "cnt", "_before", tagged=True)
    starts = cum.groupBy("column_name", "p").agg(F.min("_before").alias("_start"))  # a row a target
    known = F.broadcast(targets.join(F.broadcast(starts), ["column_name", "p"]))
    joined = cum.join(known, ["column_name", "p"])
    # rank r (0-based) sits in the row that _below + _before - _start … + cnt holds
    first = F.col("_below") + F.col("_before") - F.col("_start")
    last = first + F.col("cnt")
    hit_lo = (first <= F.col("_lo")) & (F.col("_lo") < last)
    hit_hi = (first <= F.col("_hi")) & (F.col("_hi") < last)
    picked = joined.where(hit_lo | hit_hi).groupBy("column_name", "p", "_frac").agg(*[
        F.max(F.when(hit, F.col(kind))).alias(f"{side}_{kind}")
        for side, hit in (("lo", hit_lo), ("hi", hit_hi)) for kind in ("exact", "approx")])
    exact = F.col("lo_exact") + (F.col("hi_exact") - F.col("lo_exact")) * F.col("_frac")
    approx = F.col("lo_approx") + (F.col("hi_approx") - F.col("lo_approx")) * F.col("_frac").cast("double")
    return picked.select("column_name", "p", _as_double(exact, approx).alias("quantile"))


def _at_top(freq: DataFrame) -> DataFrame:
    """The frequency rows whose count is their column's largest (one broadcast row a column)."""
    top = freq.groupBy("column_name").agg(F.max("cnt").alias("mode_count"))
    return freq.join(F.broadcast(top), "column_name").where(F.col("cnt") == F.col("mode_count"))


def lowest_modes(freq: DataFrame) -> DataFrame:
    """(column_name, mode, mode_count): most frequent value, the lowest one on ties."""
    return _at_top(freq).groupBy("column_name", "mode_count").agg(
        _as_double(F.min("exact"), F.min("approx")).alias("mode")).select("column_name", "mode", "mode_count")


def all_modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """Every tied mode, one row each (Q8): (column_name, mode, mode_count). Ties are told by the
    whole values and shown with 2 decimals."""
    freq = materialise(frequency_table(df, cols), "frequencies").where(_present())
    return (_at_top(freq).select("column_name", round2(_as_double(F.col("exact"), F.col("approx"))).alias("mode"),
                                 "mode_count").orderBy("column_name", "mode"))


def _numeric_tables(df: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(per-column stats, wide quartiles, lowest modes), all from one frequency table.

    The source is scanned twice: for the sketches that bracket the quartiles, and for the (column, value) →
    count table (null values included), a hash aggregate that is written once in no order. Counts, totals,
    min/max, the two-pass sample standard deviation, the modes and the exact quartiles are aggregates over it."""
    brackets = quantile_brackets(df, cols)
    freq_all = materialise(frequency_table(df, cols), "frequencies")
    freq = freq_all.where(_present())
    nn = F.when(_present(), F.col("cnt"))
    stats = freq_all.groupBy("column_name").agg(
        F.sum("cnt").alias("rows"), F.coalesce(F.sum(nn), F.lit(0)).alias("non_null"),
        _as_double(F.sum(F.col("exact") * F.col("cnt")), F.sum(F.col("approx") * F.col("cnt"))).alias("total"),
        _as_double(F.min("exact"), F.min("approx")).alias("min"),
        _as_double(F.max("exact"), F.max("approx")).alias("max"))
    stats = stats.withColumn("mean", F.try_divide(F.col("total"), F.col("non_null").cast("double")))
    off = _as_double(F.col("exact"), F.col("approx")) - F.col("mean")
    dev = freq.join(F.broadcast(stats.select("column_name", "mean")), "column_name").groupBy(
        "column_name").agg(F.sum(F.col("cnt") * off * off).alias("_ss"))
    stats = (stats.join(F.broadcast(dev), "column_name", "left")
             .withColumn("std", F.when(F.col("non_null") > 1, F.sqrt(
                 F.col("_ss") / (F.col("non_null") - 1).cast("double")))))
    quant = exact_quantiles(freq_all, brackets)
    wide = quant.groupBy("column_name").agg(*[
        F.max(F.when(F.col("p") == F.lit(p).cast("decimal(10,4)"), F.col("quantile"))).alias(n)
        for p, n in zip(QUARTILES, ("q1", "q2", "q3"))])
    return stats, wide, lowest_modes(freq)


def describe(df: DataFrame, cols: list[str], digits: int | None = 2) -> DataFrame:
    """pandas ``describe()`` of numeric columns, one row per column (Q1): count (non-null), mean,
    sample std, min, exact 25/50/75 % (linear), max — with ``digits`` decimals, or as they are."""
    m, wide, _ = _numeric_tables(df, cols)
    j = m.join(F.broadcast(wide), "column_name", "left")

    def shown(c: str):
        if digits is None:
            return F.col(c)
        return F.round(F.col(c).cast("decimal(38,12)"), digits).cast("double")

    return j.select(
        "column_name", F.col("non_null").alias("count"), shown("mean").alias("mean"), shown("std").alias("std"),
        shown("min").alias("min"), shown("q1").alias("p25"), shown("q2").alias("p50"), shown("q3").alias("p75"),
        shown("max").alias("max")).orderBy("column_name")


def numeric_profile(df: DataFrame, cols: list[str], skip_quartiles_for=()) -> DataFrame:
    """Statistics of numeric columns (Q7): rows (incl. nulls), total, mean, median, lowest mode,
    Q1–Q3, IQR, sample std, min, max; 2 decimals as printed upstream.
    ``skip_quartiles_for`` nulls the quartiles of date-like columns (the revised notebook)."""
    m, wide, modes = _numeric_tables(df, cols)
    j = (m.join(F.broadcast(wide), "column_name", "left")
         .join(F.broadcast(modes), "column_name", "left"))
    skip = F.lower("column_name").isin([s.lower() for s in skip_quartiles_for]) \
        if skip_quartiles_for else F.lit(False)

    def q(c):
        return F.when(~skip, round2(c))

    return j.select(
        "column_name", F.col("rows").alias("count"), round2("total").alias("total"), round2("mean").alias("mean"),
        round2("q2").alias("median"), round2("mode").alias("mode"),
        q(F.col("q1")).alias("q1"), q(F.col("q2")).alias("q2"), q(F.col("q3")).alias("q3"),
        q(F.col("q3") - F.col("q1")).alias("iqr"),
        round2("std").alias("std"), round2("min").alias("min"), round2("max").alias("max"),
    ).orderBy("column_name")


def null_counts(df: DataFrame, with_percent: bool = False) -> DataFrame:
    """Nulls per column in one pass (Q3), optionally with 100·nulls/rows (Q4)."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    long = one.select(F.col("_rows"), F.inline(F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"),
                 F.col(f"_n{i}").alias("null_count")) for i, c in enumerate(cols)])))
    if with_percent:
        long = long.withColumn("null_pct", F.try_divide(F.lit(100.0) * F.col("null_count"),
                                                        F.col("_rows").cast("double")))
    return long.drop("_rows").orderBy("ordinal")


def schema_profile(df: DataFrame) -> DataFrame:
    """info()/dtypes/shape (Q2): one row per column with its type, non-null count, the row count
    and the column count."""
    fields = df.schema.fields
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count(F.col(f"`{f.name}`")).alias(f"_c{i}") for i, f in enumerate(fields)])
    return one.select(F.inline(F.array(*[F.struct(
        F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"),
        F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f"_c{i}").alias("non_null_count"),
        F.col("_rows").alias("row_count"), F.lit(len(fields)).alias("column_count"))
        for i, f in enumerate(fields)]))).orderBy("ordinal")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row (Q6): Σ(count − 1) over groups of identical rows."""
    g = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def _stack_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, value) for every row and column, values as text."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols])))


def heavy_hitters(df: DataFrame, cols: list[str], keep: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """One row a column: ``column_name, rows, non_null`` and ``candidates``, at most ``keep`` values that
    may be its most common ones. One scan; a task sends one mergeable summary of ``tracked`` counters a
    column, whatever the number of values."""
    found = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(cols)], *[
        F.expr(f"approx_top_k(cast(`{c}` as string), {keep}, {tracked})").alias(f"t{i}") for i, c in enumerate(cols)])
    per_column = [F.struct(F.lit(c).alias("column_name"), F.col("rows"), F.col(f"n{i}").alias("non_null"),
                           F.transform(f"t{i}", lambda x: x["item"]).alias("candidates")) for i, c in enumerate(cols)]
    return materialise(found.select(F.inline(F.array(*per_column))), "heavy")


def recount(df: DataFrame, heavy: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, value, cnt): exact counts of the candidates. They are at most ``keep`` a column, so
    they are broadcast, and a task sends one row a candidate."""
    wanted = heavy.select("column_name", F.explode("candidates").alias("value")).where("value is not null")
    found = _stack_text(df, cols).join(F.broadcast(wanted), ["column_name", "value"])
    return materialise(found.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("cnt")), "recount")


def categorical_summary(df: DataFrame, cols: list[str], keep: int = HEAVY, tracked: int = TRACKED,
                        stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """(frequency table as text, per-column summary: total_count (all rows), unique_values,
    most_common (highest count, lowest value on ties) and most_common_count). A column without any
    value has 0 unique values and no most common one.

    A summary of heavy hitters proposes values and an exact recount settles them: candidates that
    hold all non-null rows are all the values there are. A column they don't settle is counted whole, in a
    hash aggregate of such columns only, so its many values never crowd the others out of the tasks'
    hash maps. Nothing is sorted value by value: the lowest of the most common values is an
    aggregate without keys, one row a task. Nor are such counts written, unless ``stored`` asks for it because
    the caller reads table and summary."""
    heavy = heavy_hitters(df, cols, keep, tracked)
    counted = recount(df, heavy, cols)
    held = counted.groupBy("column_name").agg(F.sum("cnt").alias("held"))
    sums = heavy.select("column_name", "rows", "non_null").join(F.broadcast(held), "column_name", "left").collect()  # a row a column
    whole = sorted((r.column_name for r in sums if r.non_null > (r.held or 0)), key=cols.index)
    rows = {r.column_name: r.rows for r in sums}

    freq = counted.where(~F.col("column_name").isin(whole)) if whole else counted
    settled = [c for c in cols if c not in whole]
    parts = [_least_of_most(freq, settled, rows)] if settled else []
    if whole:
        rest = _stack_text(df, whole).where("value is not null").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("cnt"))
        rest = materialise(rest, "counts") if stored else rest
        parts.append(_least_of_most(rest, whole, rows))
        freq = freq.unionByName(rest)
    return freq, parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _least_of_most(freq: DataFrame, cols: list[str], rows: dict[str, int]) -> DataFrame:
    """The summary of :func:`categorical_summary` from exact counts. One aggregate without grouping keys:
    Spark keeps the texts in one buffer a task, where a grouped one would sort its input."""
    mine = [F.col("column_name") == F.lit(c) for c in cols]
    order = F.struct(-F.col("cnt"), F.col("value"))
    one = freq.agg(*[F.count_if(m).alias(f"u{i}") for i, m in enumerate(mine)],
                   *[F.min(F.when(m, order)).alias(f"b{i}") for i, m in enumerate(mine)])
    return one.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.lit(rows[c]).alias("total_count"), F.col(f"u{i}").alias("unique_values"),
        (-F.col(f"b{i}")["col1"]).alias("most_common_count"), F.col(f"b{i}")["value"].alias("most_common"))
        for i, c in enumerate(cols)])))


def categorical_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Statistics of categorical columns (Q9): every value's count with the column's
    total rows, number of unique values and most common value."""
    freq, summary = categorical_summary(df, cols, stored=True)
    return (freq.join(F.broadcast(summary), "column_name")
            .select("column_name", "value", F.col("cnt").alias("count"), "total_count",
                    "unique_values", "most_common", "most_common_count")
            .orderBy("column_name", F.desc("count"), "value"))


def distinct_count_per_column(df: DataFrame, cols: list[str]) -> DataFrame:
    """Unique values and the most common value with its count, per column."""
    _, summary = categorical_summary(df, cols)
    return summary.select("column_name", "unique_values", "most_common", "most_common_count") \
        .orderBy("column_name")


def most_common_values(df: DataFrame, cols: list[str], keep: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """``column_name, most_common, most_common_count`` alone, lowest value on ties. A column is settled
    by the recount where its best candidate has more rows than all that is no candidate's: no other
    value can reach it. Only the columns left open are counted value by value."""
    heavy = heavy_hitters(df, cols, keep, tracked)
    counted = recount(df, heavy, cols)
    held = counted.groupBy("column_name").agg(F.sum("cnt").alias("held"), F.max("cnt").alias("best"))
    sums = heavy.select("column_name", "rows", "non_null").join(F.broadcast(held), "column_name", "left").collect()  # a row a column
    left = {r.column_name: r.non_null - (r.held or 0) for r in sums}
    best = {r.column_name: r.best or 0 for r in sums}
    rows = {r.column_name: r.rows for r in sums}
    whole = [c for c in cols if left[c] and best[c] <= left[c]]
    settled = [c for c in cols if c not in whole]
    out = _least_of_most(counted, settled, rows) if settled else None
    if whole:
        rest = _stack_text(df, whole).where("value is not null").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("cnt"))
        rest = _least_of_most(rest, whole, rows)
        out = rest if out is None else out.unionByName(rest)
    return out.select("column_name", "most_common", "most_common_count").orderBy("column_name")


def position_index(df: DataFrame, keys: list[str]) -> DataFrame:
    """The order's key columns alone, in order (nulls first), with their range (``_pid``) and place in it
    (``_place``), written once: what finds a row by its position. ``keys`` should make rows unique."""
    tagged = range_tagged(df.select(*keys), [F.asc_nulls_first(k) for k in keys])
    return tagged.withColumn("_place", F.col("_pos") - F.shiftleft(F.col("_pid").cast("long"), 33)).drop("_pos")


def keys_at(index: DataFrame, positions: list[int]) -> DataFrame:
    """(position, keys) at 0-based positions. The ranges' offsets (one row a range) tell which ranges hold
    them; only those are read."""
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = index.groupBy("_pid").agg(F.count(F.lit(1)).alias("n"))
    offsets = offsets.select("_pid", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
    at = F.explode(F.array(*[F.lit(p).cast("long") for p in positions])).alias("position")
    wanted = offsets.select("_pid", "off", "n", at).where("position >= off and position < off + n").collect()  # a row a position
    place = {f"{r['_pid']} {r.position - r.off}": r.position for r in wanted} or {"": -1}
    found = index.where(F.col("_pid").isin([int(x.split(" ")[0] or -1) for x in place]))
    position = F.create_map(*[F.lit(x) for pair in place.items() for x in pair])[F.concat_ws(" ", "_pid", "_place")]
    return found.withColumn("position", position).where("position is not null").drop("_pid", "_place")


def row_at_position(df: DataFrame, keys: list[str], positions: list[int]) -> DataFrame:
    """Rows at 0-based positions of the order by ``keys``, nulls first (Q10), which should make rows unique.
    Only the key columns are shuffled and written (:func:`position_index`); the few keys found are
    broadcast to the rows, which are read where they are. One way for all positions."""
    at = keys_at(position_index(df, keys), positions)
    named = at.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = functools.reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return df.join(F.broadcast(named), same).drop(*(f"_key_{k}" for k in keys)).orderBy("position")


def head_n(df: DataFrame, order_by: list, n: int = 5) -> DataFrame:
    """First n rows of a stated order (Q11) — top-k, not a sort of everything."""
    return df.orderBy(*order_by).limit(n)
