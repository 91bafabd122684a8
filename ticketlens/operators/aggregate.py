"""Grouping operators.

Every aggregation here is a hash aggregate with a map-side partial step, so a hot key (one value
holding a third of all rows) is combined inside each map task before the shuffle and never lands
in one task as raw rows. Frames that are windowed without a partition key (shares of a total) are
already aggregated: one row per group of a categorical key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.functions.money import money_mean, money_sum, percent_of

#: The most columns a pivot may have.
PIVOT_LABELS = 100


def value_counts(df: DataFrame, col: str, count_col: str = "count",
                 value_col: str | None = None) -> DataFrame:
    """Frequency of each non-null value, most frequent first (ties: value ascending) (A1)."""
    out = value_col or col
    return (df.where(F.col(col).isNotNull())
            .groupBy(F.col(col).alias(out))
            .agg(F.count(F.lit(1)).alias(count_col))
            .orderBy(F.desc(count_col), F.asc(out)))


def group_count(df: DataFrame, keys: list[str], count_col: str, dropna: bool = True) -> DataFrame:
    """Rows per key; null keys dropped as a pandas groupby does."""
    src = df.na.drop(subset=keys) if dropna else df
    return src.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).orderBy(*keys)


def group_sum(df: DataFrame, keys: list[str], value: str, out_col: str,
              dropna: bool = True) -> DataFrame:
    """Exact money sum per key, as double."""
    src = df.na.drop(subset=keys) if dropna else df
    return src.groupBy(*keys).agg(money_sum(value).alias(out_col)).orderBy(*keys)


def group_mean(df: DataFrame, keys: list[str], value: str, out_col: str) -> DataFrame:
    """Mean per key = double(exact sum) / count (A10)."""
    return (df.na.drop(subset=keys).groupBy(*keys)
            .agg(money_mean(value).alias(out_col)).orderBy(*keys))


def having_count(df: DataFrame, keys: list[str], count_col: str, min_count: int = 1,
                 limit: int | None = None) -> DataFrame:
    """GROUP BY keys HAVING COUNT(*) > min_count ORDER BY count DESC [LIMIT n].
    Null keys form a group, as in SQL. Ties are ordered by the keys so LIMIT is deterministic."""
    out = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
           .where(F.col(count_col) > min_count)
           .orderBy(F.desc(count_col), *[F.asc_nulls_first(k) for k in keys]))
    return out.limit(limit) if limit is not None else out


def with_share(df: DataFrame, value_col: str, share_col: str = "share_pct") -> DataFrame:
    """Percent of the column total on an aggregated frame (A21). The frame has one row per group
    of a categorical key, so the unpartitioned window is over a handful of rows."""
    total = F.sum(F.col(value_col)).over(Window.partitionBy())
    return df.withColumn(share_col, percent_of(F.col(value_col), total))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """ORDER BY … LIMIT k → TakeOrderedAndProject (per-task top-k, then a k-row merge)."""
    return df.orderBy(*order).limit(k)


def category_domain(df: DataFrame, col: str, out_col: str | None = None) -> DataFrame:
    """Closed value domain of a categorical column: its distinct non-null values."""
    out = out_col or col
    return df.where(F.col(col).isNotNull()).select(F.col(col).alias(out)).distinct()


def domain_product(df: DataFrame, cols: list[str]) -> DataFrame:
    """All combinations of the domains of ``cols`` (pandas ``observed=False`` on several category
    keys). Each domain is gathered as a sorted set of its distinct values (bounded by the
    category's size, merged from map-side partial sets) and expanded with ``explode`` — no join."""
    sets = df.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in cols])
    out = sets
    for c in cols:
        out = out.withColumn(c, F.explode(c))
    return out


def pivot_labels(df: DataFrame, col: str, known: list[str] | None = None, most: int = PIVOT_LABELS) -> list[str]:
    """The labels a pivot on ``col`` has columns for: the known ones first, then all others that occur, in
    order. One distinct with a map-side step, of which the driver gets at most ``most`` + 1 rows; a
    column with more labels raises, as it is no category."""
    known = list(known or [])
    found = df.where(F.col(col).isNotNull() & ~F.col(col).isin(known)).select(F.col(col).cast("string").alias(col)).distinct()
    labels = [r[0] for r in found.limit(most + 1).collect()]
    if len(known) + len(labels) > most:
        raise ValueError(f"{col} has more than {most} labels: too many for the columns of a pivot")
    return known + sorted(labels)


def label_columns(labels: list[str], taken: list[str]) -> dict[str, str]:
    """A column name for each label, none twice: ``off_peak``, and ``off_peak_2`` for another label of that form."""
    names, used = {}, {t.lower() for t in taken}
    for label in labels:
        name, k = snake(label) or "blank", 1
        while name in used:
            k += 1
            name = f"{snake(label) or 'blank'}_{k}"
        used.add(name)
        names[label] = name
    return names


def pivot_sum(df: DataFrame, row_key: str, col_key: str, values: list[str], value: str,
              prefix: str = "") -> DataFrame:
    """pivot_table(values=value, index=row_key, columns=col_key, aggfunc='sum'); a missing cell is
    null (A13). ``values`` are the labels of :func:`pivot_labels`."""
    named = label_columns(values, [row_key])
    groups = df.na.drop(subset=[row_key, col_key]).groupBy(row_key)
    p = groups.pivot(col_key, values).agg(F.sum(value).cast("double")) if values else groups.agg(F.lit(1).alias("_")).drop("_")
    return p.select(row_key, *[F.col(f"`{v}`").alias(prefix + named[v]) for v in values]).orderBy(row_key)


def snake(label: str) -> str:
    """Column-name form of a category label: ``Off-Peak`` → ``off_peak``."""
    return "".join(ch if ch.isalnum() else "_" for ch in label.strip().lower())
