"""Mixing sources to target weights by weighted fair queueing.

Every source queues its documents in a shuffled order (a hash of id and text; a second, newly shuffled
round where the target is above the source's size). A document's virtual finish time is its source's
cumulative words divided by the source's target, and the mix is all queues merged by virtual time,
cut where the total budget is used up. Within a source the documents taken are therefore a prefix of
its queue, so a cut (round, hash) per source tells for every document how often it is taken.

Scale: only (id, source, size) is read into the queues. A source of any size is split into buckets
of the shuffle hash; cumulative words are a sum over buckets plus one within a bucket, and the budget
is found from a histogram over ranges of virtual time with one range sorted. Texts are never
shuffled: documents meet the one row per source of the cuts. What grows in one task is one row per
source, per range, or per bucket of a source.

Defined cases: a null or empty text has size 0 and takes nothing; a null source is a source, the last
in order; a very long text is one document as any other; rows of one id (or none) have places of their
own by their texts, and rows that repeat id and text by their place in the table, so each is taken or
left for itself and targets hold; all-empty or no input gives targets of 0; columns that the operator
adds replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.cluster import unused_prefix
from ticketlens.session import materialise

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST_ROUNDS = 2
BUCKET_ROWS = 2_000  # documents of a bucket, about


def words_in(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def keyed(rows: DataFrame, id_col: str = "doc_id", tie: Column | None = None, key_col: str = "key") -> DataFrame:
    """``rows`` with a key of their own: a hash of id and ``tie`` (of the text, say), and of their place in the
    table where these repeat."""
    known = F.xxhash64(F.col(id_col)) if tie is None else F.xxhash64(F.col(id_col), tie)
    rows = rows.withColumn(key_col, known)
    again = rows.groupBy(key_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key_col)
    again = materialise(again, "repeats")
    if again.isEmpty():
        return rows
    pre = unused_prefix(rows)
    # written once, so that a row has the same place for all who read it
    numbered = materialise(rows.withColumn(pre + "nth", F.monotonically_increasing_id()), "numbered")
    found = numbered.join(again.select(F.col(key_col).alias(pre + "key")), F.col(key_col) == F.col(pre + "key"), "left")
    own = F.when(F.col(pre + "key").isNotNull(), F.xxhash64(F.col(key_col), F.col(pre + "nth"))).otherwise(F.col(key_col))
    return found.withColumn(key_col, own).drop(pre + "nth", pre + "key")


def _place(key: Column, turn: int, seed: int) -> Column:
    """A document's place in its source's queue in round ``turn``."""
    return F.struct(F.lit(turn).alias("turn"), F.xxhash64(key, F.lit(turn), F.lit(seed)).alias("u"))


def _bucket(place: Column, buckets: Column) -> Column:
    """The part of its source's queue that a document is in: a split by the shuffle hash."""
    return F.pmod(F.shiftrightunsigned(place, 24), buckets)


def targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET,
            most: float = MOST_ROUNDS) -> DataFrame:
    """Per source its size and target words, and the buckets its queue is cut into. Targets share ``budget`` times all words by weight, none
    above ``most`` times its source: sources in order of the level at which they are full, the level
    reached by all others."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"),
                                       F.floor(F.count(F.lit(1)) / BUCKET_ROWS).alias("buckets") + 1)
    sizes = sizes.toDF("source", "source_size", "buckets")
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights)).cast("int"))
    out = sizes.withColumn("weight", weight).withColumn("full", most * F.col("source_size"))
    out = out.withColumn("fills", F.col("full") / F.col("weight"))
    order = Window.orderBy("fills", F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    from_here = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = budget * F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    out = out.withColumn("level", left / F.sum("weight").over(from_here))
    # levels after the first one that isn't full are lower
    reached = F.max(F.when(F.col("level") <= F.col("fills"), F.col("level"))).over(everything)
    share = F.coalesce(reached * F.col("weight"), F.col("full"))
    return out.select("source", "source_size", F.least("full", share).alias("target"), "buckets")


def cuts(rows: DataFrame, seed: int = 17, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET,
         most: int = MOST_ROUNDS) -> DataFrame:
    """Per source: ``source_size``, ``target`` and ``cut``, the last place taken from its queue.
    ``rows`` has (key, source, size), see :func:`keyed`, and is read several times."""
    rows = rows.select("key", "source", "size")
    wanted = materialise(targets(rows, weights, budget, most), "targets")
    n = rows.count()
    total = budget * (rows.agg(F.sum("size")).first()[0] or 0)
    known = wanted.select(F.col("source").alias("s"), "source_size", "target", "buckets")
    queue = rows.join(known, F.col("source").eqNullSafe(F.col("s"))).where("target > 0 and size > 0")
    rounds = F.array(*(_place(F.col("key"), k, seed) for k in range(most)))
    queue = queue.select("source", "source_size", "target", "size", "buckets", F.explode(rounds).alias("place"))
    queue = queue.where(F.col("place.turn") * F.col("source_size") < F.col("target"))
    queue = queue.withColumn("bucket", _bucket(F.col("place.u"), F.col("buckets"))).drop("buckets")
    keys = ["source", "place.turn", "bucket"]
    sums = queue.groupBy("source", F.col("place.turn").alias("turn"), "bucket").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source").orderBy("turn", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), "turn", F.col("bucket").alias("b"),
                       F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    queue = queue.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("place.turn") == F.col("turn"))
                       & (F.col("bucket") == F.col("b")))
    # a bucket is a set of hashes, so its documents stand together in the queue's order
    within = Window.partitionBy(*keys).orderBy("place.u").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    finish = (F.col("before") + F.sum("size").over(within)) / F.col("target")
    queue = queue.select("source", "place", "size", "bucket", finish.alias("finish"))
    ranges = n // (8 * BUCKET_ROWS) + 1024
    queue = queue.withColumn("range", F.least(F.floor(F.col("finish") * ranges), F.lit(4 * ranges)).cast("long"))
    queue = materialise(queue, "queue")
    per_range = queue.groupBy("range").agg(F.sum("size").alias("n"))
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    full = per_range.withColumn("upto", F.sum("n").over(upto)).where(F.col("upto") > total)
    edge = full.orderBy("range").limit(1).first()  # the range in which the budget ends
    if edge is None:
        taken = queue
    else:
        running = F.sum("size").over(Window.orderBy("finish", "place").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        last = queue.where(F.col("range") == edge["range"]).withColumn("upto", running + (edge["upto"] - edge["n"]))
        taken = queue.where(F.col("range") < edge["range"]).unionByName(
            last.where(F.col("upto") <= total).drop("upto"))
    ordered = F.struct("place.turn", "bucket", "place.u")
    cut = taken.groupBy("source").agg(F.max(ordered).alias("cut"))
    cut = cut.select(F.col("source").alias("s"), "cut")
    out = wanted.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    return materialise(out, "cuts")


def copies(docs: DataFrame, cut: DataFrame, seed: int = 17, most: int = MOST_ROUNDS, key_col: str = "key",
           source_col: str = "source") -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``copies``, how often the mix takes each row."""
    added = ("source_size", "target", "copies")
    kept = [c for c in docs.columns if c.lower() not in added]
    pre = unused_prefix(docs)
    known = cut.select(*(F.col(c).alias(pre + c) for c in ("source", "source_size", "target", "cut", "buckets")))
    out = docs.select(*kept).join(known, F.col(source_col).eqNullSafe(F.col(pre + "source")), "left")
    times = F.lit(0)
    for k in range(most):
        place = _place(F.col(key_col), k, seed)
        at = F.struct(place["turn"], _bucket(place["u"], F.col(pre + "buckets")), place["u"])
        times = times + F.when(at <= F.col(pre + "cut"), 1).otherwise(0)
    return out.select(*kept, F.col(pre + "source_size").alias("source_size"), F.col(pre + "target").alias("target"),
                      times.alias("copies"))


def mix(docs: DataFrame, seed: int = 17, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", weights: Sequence[float] = WEIGHTS, budget: float = BUDGET) -> DataFrame:
    """The mixed documents: rows of ``docs`` as often as they are taken."""
    added = ("source_size", "target", "copies")  # replaced by copies(): the columns that go by the names
    pre = unused_prefix(docs)
    own = {c: pre + c for c in docs.columns if c.lower() in added}
    key, again = pre + "key", pre + "again"
    known = F.xxhash64(F.col(id_col), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    wanted = [F.col(key).alias("key"), F.col(source_col).alias("source"), words_in(F.col(text_col)).alias("size")]
    rows = docs.withColumn(key, known)
    sizes = materialise(rows.select(*wanted), "sizes")  # words are counted once
    if not sizes.groupBy("key").count().where("count > 1").isEmpty():  # id and text repeat
        rows = keyed(docs, id_col, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), key)
        sizes = materialise(rows.select(*wanted), "sizes")
    cut = cuts(sizes, seed, weights, budget)
    out = copies(rows.withColumnsRenamed(own), cut, seed, key_col=key, source_col=own.get(source_col, source_col))
    out = out.where("copies > 0").withColumn(again, F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select(*(F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns))
