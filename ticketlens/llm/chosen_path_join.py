"""Near-duplicate join on word shingles by chosen paths.

Two documents are linked when the Jaccard similarity of their sets of five-word shingles is at least
0.8. Equal sets are one node. A set is embedded as ``WIDTH`` minhash tokens; a run then splits the
nodes recursively: at every tree node one or two (on average 1 / threshold) of the tokens' places are
drawn by a hash of the path, and the nodes that hold the same token there go down together. Buckets of
at most ``LIMIT`` nodes are compared by brute force; runs are repeated until a pair at the threshold is
missed by all of them with a probability below ``1 - recall`` at the depth that its buckets reached:
nodes whose buckets were all small stop after the runs that the first level asks for.

What leaves the buckets is not their pairs but, per bucket, stars that connect what looks similar
(well below the threshold). The groups so connected are then verified exactly: all pairs of a group's
whole shingle sets, in blocks, which yields the number of links of each node and the classes (linked
directly or through others) without a row per pair.

A larger bucket of up to ``WHOLE`` nodes is compared block against block. One beyond that, at least half
of whose members look like one of them (a group of near copies), is one group at once: an edge from each member to
that one, and the exact verification does the rest. Others are split on, as deep as the logarithm of
the largest one asks; the few that are still large there, neither near copies nor parted, are compared
block against block as well. A block's own bucket connects its members, and two blocks give one edge for
each pair of what they have connected, so edges don't multiply with the blocks.

Scale: the only pass over all texts makes 128 numbers a document. Paths are pairs of 64-bit numbers;
copies are one node beforehand. Edges a node: one for each bucket it is in, and so its runs times a
constant, however large its group. A path with very many nodes is met by its size in a join of two
written tables, which Spark can split. Whole shingle sets are made only for nodes in a group: a Bloom
filter of bounded size picks their documents, and a join makes that exact. A set is sent once for each
block of its group (``BLOCK`` sets or ``BLOCK_SHINGLES`` shingles): that, and the comparisons, is the
price of exact numbers of links. Iterations write tables in the shared folder.

Defined cases: a text of one to four words is one shingle; a very long text is one set as any other; null texts and texts without words have no
shingles, and each is a class of its own without links; equal sets are told by 64-bit sums of hashed
shingles; repeated rows are copies; a null id comes last in a class; empty tables give an empty
result. Extra columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlens.llm import bloom as bl
from ticketlens.llm import textutil as tu
from ticketlens.llm.cluster import unused_prefix
from ticketlens.session import materialise

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.999
WIDTH = 128
LIMIT = 2048
WHOLE = 4 * LIMIT  # buckets up to this are compared whole, block by block; larger ones are split on
DEEPEST: int | None = None  # levels; None: by the logarithm of the largest bucket
HUBS = 4  # members that a large bucket's others are held against
MOSTLY = 0.5  # part of a large bucket that looks like one of these, if it is a group
BLOCK = 512
BLOCK_SHINGLES = 1 << 20
_U = np.uint64
_FACTORS = np.random.default_rng(5).integers(1, 2**63, WIDTH, dtype=np.uint64) * _U(2) + _U(1)
_TERMS = np.random.default_rng(6).integers(1, 2**63, WIDTH, dtype=np.uint64)


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingles of each text) for slices of a column."""
    data, offsets = tu.text_buffer(column)
    for lo, hi in tu.slices(offsets):
        h, _, of = tu.words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        fives = tu.windows(h, SHINGLE)
        out = []
        for a, b in zip(of[:-1].tolist(), of[1:].tolist()):
            if b - a >= SHINGLE:
                s = np.sort(fives[a:b - SHINGLE + 1])
                out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
            else:
                out.append(tu.windows(h[a:b], b - a) ^ _U(b - a) if b > a else fives[:0])
        yield lo, out


def fingerprint(shingles: np.ndarray) -> int:
    """A 64-bit sum that names the set."""
    with np.errstate(over="ignore"):
        return int((tu.mix(shingles ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U) + _U(len(shingles))).view(np.int64))


def minhashes(shingles: np.ndarray) -> np.ndarray:
    least = np.full(WIDTH, np.iinfo(np.uint64).max, _U)
    with np.errstate(over="ignore"):
        for lo in range(0, len(shingles), 2048):
            least = np.minimum(least, (shingles[lo:lo + 2048, None] * _FACTORS + _TERMS).min(0))
    return (least >> _U(32)).astype(np.uint32).view(np.int32)


def _low_bytes(sig: np.ndarray) -> list[bytes]:
    raw = sig.astype(np.uint8).tobytes()
    return [raw[i:i + WIDTH] for i in range(0, len(raw), WIDTH)]


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its set's size, fingerprint, minhash tokens (``sig``) and their low bytes (``low``)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"))
    schema = T.StructType([rows.schema["doc_id"], rows.schema["text_hash"], T.StructField("n", T.IntegerType()),
                           T.StructField("fp", T.LongType()), T.StructField("sig", T.ArrayType(T.IntegerType())),
                           T.StructField("low", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, sets in shingle_sets(b["text"]):
                k = len(sets)
                sig = np.concatenate([minhashes(s) for s in sets])
                lists = pa.ListArray.from_arrays(np.arange(k + 1, dtype=np.int32) * WIDTH, sig)
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"].slice(lo, k), b["text_hash"].slice(lo, k), pa.array([len(s) for s in sets], pa.int32()),
                     pa.array([fingerprint(s) for s in sets]), lists, pa.array(_low_bytes(sig), pa.binary())], schema.names)

    return rows.mapInArrow(run, schema)


def _by_group(rows: DataFrame, keys: list[str], fn: Callable[[pa.RecordBatch, np.ndarray], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``fn(rows, group bounds)`` over whole groups, many at a time. Groups are small by construction;
    one that reaches over Arrow batches is carried."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for b in batches:
            if not len(b):
                continue
            bounds = _bounds(b, keys)
            if rest and _same(rest[-1], b, keys):
                if len(bounds) == 2:
                    rest.append(b)
                    continue
                rest.append(b.slice(0, bounds[1]))
                b, bounds = b.slice(bounds[1]), bounds[1:] - bounds[1]
            if rest:
                whole = pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
                yield from fn(whole, _bounds(whole, keys))
            if len(bounds) > 2:
                yield from fn(b.slice(0, bounds[-2]), bounds[:-1])
            rest = [b.slice(bounds[-2])]
        if rest:
            whole = pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
            yield from fn(whole, _bounds(whole, keys))

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _bounds(b: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    new = np.zeros(len(b), bool)
    for k in keys:
        v = b[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.concatenate(([0], np.flatnonzero(new), [len(b)]))


def _same(a: pa.RecordBatch, b: pa.RecordBatch, keys: list[str]) -> bool:
    return all(a[k][len(a) - 1] == b[k][0] for k in keys)


def _roots(near: np.ndarray) -> np.ndarray:
    """For matrices (groups, g, g) of neighbours, the least index that each index is connected to."""
    g = near.shape[-1]
    near = near | np.eye(g, dtype=bool)
    root = np.broadcast_to(np.arange(g, dtype=np.int32), near.shape[:2]).copy()
    while True:
        least = np.where(near, root[:, None, :], np.int32(g)).min(2)
        least = np.take_along_axis(least, least, 1)
        if (least == root).all():
            return root
        root = least


def _alike(low: np.ndarray) -> np.ndarray:
    """Numbers of equal places of all pairs, for a matrix (groups, g, WIDTH)."""
    same = np.zeros((len(low), low.shape[1], low.shape[1]), np.uint8)
    for column in np.moveaxis(low, 2, 0):
        same += column[:, :, None] == column[:, None, :]
    return same


def _stars(similar: float):
    """Per bucket, edges from each node to the least one it is connected to by similar tokens. Of a bucket
    of two blocks (``part``), whose members are connected by their blocks' own buckets, only edges
    between what is connected there."""

    def run(b: pa.RecordBatch, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        fp, part = b["fp"].to_numpy(), b["part"].to_numpy()
        low = np.frombuffer(b"".join(x.as_py() for x in b["low"]), np.uint8).reshape(-1, WIDTH)
        size = np.diff(bounds)
        for g in np.unique(size[size > 1]).tolist():
            first = bounds[:-1][size == g]
            step = max(1, (1 << 18) // (g * g))
            for lo in range(0, len(first), step):
                at = first[lo:lo + step, None] + np.arange(g)
                near = _alike(np.ascontiguousarray(low[at])) >= similar * WIDTH
                local = _roots(near)
                root = np.take_along_axis(at, local, 1)
                far = root != at
                own = part[at]
                if (own != own[:, :1]).any():  # two blocks: one edge for what each has connected
                    inside = _roots(near & (own[:, :, None] == own[:, None, :]))
                    far &= (inside == np.arange(g)) | (own == own[:, :1]).all(1)[:, None]
                if far.any():
                    yield pa.RecordBatch.from_arrays([pa.array(fp[at[far]]), pa.array(fp[root[far]])], ["a", "b"])

    return run


def _children(path: Column, sig: Column, threshold: float) -> Column:
    """The tree nodes below ``path`` that a set goes to: one or more places, 1 / threshold on average, drawn
    by the path."""
    places = [F.pmod(F.xxhash64(path, F.lit(k)), F.lit(WIDTH)).cast("int") for k in range(math.ceil(1 / threshold))]
    parts = 1 << 20
    more = F.pmod(F.xxhash64(path, F.lit(-1)), F.lit(parts)) < int(parts * (1 / threshold - math.floor(1 / threshold)))
    down = F.array_distinct(F.array(*(F.xxhash64(path, i, F.get(sig, i)) for i in places)))
    if len(places) == math.floor(1 / threshold):
        return F.explode(down)
    return F.explode(F.when(more, down).otherwise(F.slice(down, 1, len(places) - 1)))


def _kept_together(depth: int, threshold: float) -> float:
    """Chance that one run brings a pair at the threshold to a common bucket ``depth`` levels down."""
    q, fewest = 1.0, math.floor(1 / threshold)
    more = 1 / threshold - fewest
    for _ in range(depth):
        x = threshold * q
        q = (1 - more) * (1 - (1 - x) ** fewest) + more * (1 - (1 - x) ** (fewest + 1))
    return q


def _runs(depth: int, recall: float, threshold: float) -> int:
    """Runs until a pair at the threshold has met with the chance ``recall``."""
    miss = 1 - _kept_together(depth, threshold)
    return 1 if miss <= 0 else math.ceil(math.log(1 - recall) / math.log(miss))


def _buckets(nodes: DataFrame, recall: float, similar: float, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(bucket, fp, part) of all runs, every bucket small or two blocks of a larger one, and the edges (a, b)
    of very large buckets that are one group."""
    out = nodes.select(F.col("fp").alias("bucket"), "fp", F.lit(0).alias("part")).limit(0)
    edges = nodes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    active, done, counted = nodes, 0, 1  # runs are counted for buckets down to the level ``counted``
    while True:
        upto = _runs(counted, recall, threshold)
        if upto <= done:
            return out, edges
        runs = F.explode(F.sequence(F.lit(done), F.lit(upto - 1)))
        level = active.select(runs.alias("run"), "fp", "sig").select(
            _children(F.xxhash64("run"), F.col("sig"), threshold).alias("p"), "fp")
        depth, deepest, deeper = 1, None, None
        while True:
            sizes = materialise(level.groupBy("p").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
            largest = sizes.agg(F.max("size")).first()[0] or 0
            level = materialise(level.join(sizes, "p"), "level")
            out = out.unionByName(level.where(F.col("size") <= LIMIT).select(F.col("p").alias("bucket"), "fp", F.lit(0).alias("part")))
            if largest > LIMIT:
                out = out.unionByName(_blocks(level.where((F.col("size") > LIMIT) & (F.col("size") <= WHOLE))))
            if largest <= WHOLE:
                break
            deepest = deepest or DEEPEST or 2 + math.ceil(2 * math.log2(largest / WHOLE))
            large = level.where(F.col("size") > WHOLE)
            groups = _groups(large, nodes, similar)
            edges = edges.unionByName(large.join(groups, "p").where("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b")))
            rest = large.join(groups, "p", "left_anti")
            if depth >= deepest:
                out = out.unionByName(_blocks(rest))
                break
            rest = materialise(rest.select("p", "fp"), "rest")
            if rest.isEmpty():
                break
            if depth == counted:  # what is met below this level needs more runs
                deeper = rest.select("fp").distinct()
            level = rest.join(nodes.select("fp", "sig"), "fp").select(_children(F.col("p"), F.col("sig"), threshold).alias("p"), "fp")
            depth += 1
        if deeper is None:
            return out, edges
        active = materialise(nodes.join(deeper, "fp", "left_semi"), "active")
        done, counted = upto, depth


def _groups(large: DataFrame, nodes: DataFrame, similar: float) -> DataFrame:
    """(p, hub) of the large buckets most of whose members have tokens similar to those of one, the hub."""
    sigs = nodes.select("fp", "sig")
    drawn = [F.min_by("fp", F.xxhash64("p", "fp", F.lit(k))).alias(f"h{k}") for k in range(HUBS)]
    hubs = large.groupBy("p").agg(*drawn)
    for k in range(HUBS):
        hubs = hubs.join(sigs.select(F.col("fp").alias(f"h{k}"), F.col("sig").alias(f"s{k}")), f"h{k}")
    hubs = materialise(hubs, "hubs")  # a row a large bucket

    def looks(k: int) -> Column:
        same = F.size(F.filter(F.zip_with("sig", f"s{k}", lambda x, y: x == y), lambda x: x))
        return F.count_if(same >= similar * WIDTH).alias(f"n{k}")

    held = large.select("p", "fp").join(sigs, "fp").join(hubs.drop(*(f"h{k}" for k in range(HUBS))), "p")
    held = held.groupBy("p").agg(F.count(F.lit(1)).alias("size"), *(looks(k) for k in range(HUBS)))
    best = F.greatest(*(F.struct(F.col(f"n{k}").alias("n"), F.col(f"h{k}").alias("h")) for k in range(HUBS)))
    found = held.join(hubs.select("p", *(f"h{k}" for k in range(HUBS))), "p").select("p", "size", best.alias("best"))
    return materialise(found.where(F.col("best.n") >= MOSTLY * F.col("size")).select("p", F.col("best.h").alias("hub")), "groups")


def _blocks(large: DataFrame) -> DataFrame:
    """Large buckets cut into blocks, each block with itself and each other one as a bucket."""
    n = F.ceil(F.col("size") / (LIMIT // 2)).cast("int")
    own = large.select("p", "fp", n.alias("n"), F.pmod(F.xxhash64("p", "fp"), n).cast("int").alias("block"))
    pairs = own.select("p", "fp", "block", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("meets"))
    return pairs.select(F.xxhash64("p", F.least("block", "meets"), F.greatest("block", "meets")).alias("bucket"), "fp",
                        F.col("block").alias("part"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the graph's connected components, root their least node: nodes take the least
    label around them, and labels are followed a step, until nothing changes."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialise(both.distinct(), "edges")
    labels = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("root"))
    labels = materialise(labels, "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(
            F.min("root").alias("around"))
        step = labels.join(around.select(F.col("a").alias("node"), "around"), "node").select(
            "node", F.col("root").alias("old"), F.least("root", "around").alias("root"))
        step = materialise(step, "labels")
        jump = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        new = materialise(step.join(jump, "root").select("node", "old", F.least("root", "next").alias("root")), "labels")
        changed = not new.where("root <> old").isEmpty()
        labels = new.select("node", "root")
        if not changed:
            return labels


def _linked(threshold: float):
    """Exact similarities within a block, or between two blocks, of a group: per node its links and
    the least node of the block that it is connected to."""

    def run(b: pa.RecordBatch, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        fp, block, lo, hi = (b[c].to_numpy() for c in ("fp", "block", "lo", "hi"))
        sets = [np.frombuffer(x.as_buffer(), _U) for x in b["shingles"]]
        out = ([], [], [])
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            near = similar(sets[s:e], threshold)
            if lo[s] != hi[s]:  # pairs within a block are counted where it meets itself
                near &= block[s:e, None] != block[None, s:e]
            links = near.sum(1)
            root = _roots(near[None])[0]
            hit = np.flatnonzero(links)
            for column, values in zip(out, (fp[s:e][hit], links[hit], fp[s:e][root[hit]])):
                column.append(values)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["fp", "links", "root"])

    return run


def similar(sets: list[np.ndarray], threshold: float = THRESHOLD) -> np.ndarray:
    """Which pairs of sets are at least as similar as the threshold (a symmetric matrix)."""
    k, n = len(sets), np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(k), n)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.concatenate(([True], every[1:] != every[:-1]))
    which = np.cumsum(new) - 1
    shared = np.bincount(which)[which] > 1
    place = np.cumsum(new & shared)[shared] - 1
    owner = owner[shared]
    common = np.zeros((k, k), np.float32)
    total = int(place[-1]) + 1 if len(place) else 0
    for lo in range(0, total, 4096):
        a, z = np.searchsorted(place, (lo, lo + 4096))
        holds = np.zeros((k, min(4096, total - lo)), np.float32)
        holds[owner[a:z], place[a:z] - lo] = 1
        common += holds @ holds.T
    union = n[:, None] + n[None, :] - common
    near = common >= threshold * union - 1e-6
    np.fill_diagonal(near, False)
    return near


def candidates(nodes: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Edges (a, b) between nodes (fp, sig, low) that connect all pairs at the threshold, and more."""
    similar = threshold - 4 * math.sqrt(threshold * (1 - threshold) / WIDTH)
    buckets, near = _buckets(nodes, recall, similar, threshold)
    bucketed = buckets.join(nodes.select("fp", "low"), "fp").select("bucket", "fp", "part", "low")
    return _by_group(bucketed, ["bucket"], _stars(similar), "a long, b long").unionByName(near)


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
         recall: float = RECALL) -> DataFrame:
    """One row per document: ``doc_id, text_hash, n_shingles, fp, class_id`` (the least id of its class),
    ``n_links`` (other shingle sets that its own is linked to), ``n_copies`` (documents with its set)
    and ``stays`` (whether it is its class's document with the least id)."""
    rows = materialise(signatures(docs, id_col, text_col), "signatures")
    nodes = rows.where("n > 0").groupBy("fp").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies"), F.first("n").alias("n"),
        F.first("sig").alias("sig"), F.first("low").alias("low"))
    nodes = materialise(nodes, "nodes")
    group = components(candidates(nodes, threshold, recall).distinct())

    members = nodes.select("fp", "first_id", "n").join(group.select(F.col("node").alias("fp"), F.col("root").alias("g")), "fp")
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = materialise(members.groupBy("g").agg(blocks.alias("blocks")), "sizes")
    members = materialise(members.drop("n").join(sizes, "g"), "members")
    chosen = docs.sparkSession.sparkContext.broadcast(bl.build(members.select(F.xxhash64("first_id").alias("h"))))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(bl.may_hold(chosen.value, b["h"].to_numpy().view(_U))))
            for _, sets in shingle_sets(b["text"]):
                yield pa.RecordBatch.from_arrays([pa.array([fingerprint(s) for s in sets], pa.int64()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], ["fp", "shingles"])

    texts = docs.select(F.xxhash64(F.col(id_col)).alias("h"), F.col(text_col).alias("text"))
    whole = texts.mapInArrow(sets_of, "fp long, shingles binary").join(members, "fp").dropDuplicates(["fp"])
    whole = whole.select("fp", "shingles", "g", F.pmod(F.xxhash64("fp"), "blocks").cast("int").alias("block"),
                         F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("meets"))
    whole = whole.select("fp", "shingles", "g", "block", F.least("block", "meets").alias("lo"),
                         F.greatest("block", "meets").alias("hi"))
    linked = materialise(_by_group(whole, ["g", "lo", "hi"], _linked(threshold), "fp long, links long, root long"), "links")
    links = linked.groupBy("fp").agg(F.sum("links").alias("n_links"))
    classes = components(linked.where("fp <> root").select(F.col("fp").alias("a"), F.col("root").alias("b")).distinct())

    of = nodes.select("fp", "first_id", "n_copies").join(
        classes.select(F.col("node").alias("fp"), "root"), "fp", "left").join(links, "fp", "left")
    of = of.withColumn("root", F.coalesce("root", "fp"))
    heads = of.groupBy("root").agg(F.min("first_id").alias("class_id"),
                                   F.min(F.struct(F.col("first_id").isNull().alias("z"), "first_id", "fp"))["fp"].alias("head"))
    of = of.join(heads, "root").select("fp", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                                       "n_copies", "head")
    out = rows.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "fp").join(of, "fp", "left")
    empty = F.col("n_shingles") == 0
    stays = empty | ((F.col("fp") == F.col("head")) & F.col("doc_id").eqNullSafe(F.col("class_id")))
    return out.select("doc_id", "text_hash", F.col("n_shingles").cast("long").alias("n_shingles"), "fp",
                      F.when(empty, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.when(empty, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
                      F.when(empty, F.lit(1)).otherwise(F.col("n_copies")).cast("long").alias("n_copies"),
                      stays.alias("stays"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, with one document of each class: the one with the
    least id. Rows that repeat it, id and text, stay once."""
    found = materialise(join(docs, id_col, text_col, threshold), "classes")
    n = found.where("n_shingles > 0").groupBy("doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("n"), F.max("stays").alias("stays"))
    a, b = (unused_prefix(docs) + c for c in ("id", "hash"))
    leave = n.where("not stays or n > 1").select(F.col("doc_id").alias(a), F.col("text_hash").alias(b))
    same = F.col(id_col).eqNullSafe(F.col(a)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(b))
    out = docs.join(leave, same, "left_anti")
    again = n.where("stays and n > 1").select(F.col("doc_id").alias(a), F.col("text_hash").alias(b))
    if again.isEmpty():
        return out
    once = docs.join(again, same, "left_semi")
    return out.unionByName(once.dropDuplicates([id_col, text_col]))
