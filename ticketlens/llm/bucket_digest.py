"""Document fingerprints: quartile digests of hashed byte triplets.

All triplets of neighbouring bytes of a text are hashed into 128 buckets and counted. A bucket's two
bits tell in which quarter of the text's own counts its count lies (above how many of the three
quartiles), a byte tells the length on a logarithmic scale; both are written as 66 hex digits. Two
digests differ by the sum of their buckets' steps plus a bounded step for the length, and the sum is
bounded at ``FARTHEST``, about what unrelated texts reach; likeness is 1 at no difference and 0 at the bound.

The edited text of a document has the last half of its code points replaced by the first as many of
the next document in ascending order of ids (after the last: the first), so its digest shows how
likeness falls with an edit.

Scale: the texts are range-shuffled by id once, and a task streams through its sorted range, holding
one row and one slice of texts. Only the first and the last row of a range keep their texts in the
written table, and each last row meets the first one of the next range by an equi-join; the order of
the ranges is a window over one number a range. Digests are compared row by row, never in pairs of all.

Defined cases: a null text is an empty one; texts without a triplet (under 3 bytes) count as one
triplet, padded, and empty ones have none; null ids come first; rows of one id are in the order of a hash of
their texts, exact repeats follow each other; a single document is its own next one; an empty table
gives an empty result; a very long text is a slice of its own; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlens.llm import textutil as tu
from ticketlens.llm.cluster import ship_code
from ticketlens.session import materialise

BUCKETS = 128
LENGTH_BASE = 1.1  # texts a tenth longer differ by a step
LENGTH_STEPS = 12  # the most that lengths add
FARTHEST = 160 + LENGTH_STEPS  # 128 buckets of four equally likely codes differ by 160 on average
SLICE_BYTES = 1 << 20
_TABLES = np.random.default_rng(303).integers(0, BUCKETS, (3, 256), dtype=np.uint8)


def digests(texts: pa.Array) -> np.ndarray:
    """A row of bytes for each text: the codes of its buckets, four to a byte, then its length's."""
    data, offsets = tu.text_buffer(texts)
    size, n = np.diff(offsets), len(texts)
    counts = np.zeros((n, BUCKETS), np.int64)
    for lo, hi in tu.slices(offsets, SLICE_BYTES):
        part = data[offsets[lo]:offsets[hi]]
        if len(part) > 2:
            bucket = _TABLES[0][part[:-2]] ^ _TABLES[1][part[1:-1]] ^ _TABLES[2][part[2:]]
            own = np.maximum(size[lo:hi] - 2, 0)
            begin = np.repeat(offsets[lo:hi] - offsets[lo] - (np.cumsum(own) - own), own) + np.arange(own.sum())
            key = np.repeat(np.arange(hi - lo) * BUCKETS, own) + bucket[begin]
            counts[lo:hi] = np.bincount(key, minlength=(hi - lo) * BUCKETS).reshape(-1, BUCKETS)
    for i in np.flatnonzero((size > 0) & (size < 3)).tolist():
        b = [*data[offsets[i]:offsets[i + 1]].tolist(), 0, 0]
        counts[i, _TABLES[0][b[0]] ^ _TABLES[1][b[1]] ^ _TABLES[2][b[2]]] = 1
    quartiles = np.sort(counts, axis=1)[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    code = (counts[:, :, None] > quartiles[:, None, :]).sum(2).astype(np.uint8)
    packed = code[:, 0::4] | code[:, 1::4] << 2 | code[:, 2::4] << 4 | code[:, 3::4] << 6
    length = np.where(size > 0, 1 + np.log(np.maximum(size, 1)) / np.log(LENGTH_BASE), 0).clip(0, 255).astype(np.uint8)
    return np.concatenate([packed, length[:, None]], axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness (0 to 1) of the digests in two equally long matrices, row by row."""
    steps = np.zeros(len(a), np.int64)
    for shift in (0, 2, 4, 6):
        x, y = (m[:, :-1].astype(np.int16) >> shift & 3 for m in (a, b))
        steps += np.abs(x - y).sum(1)
    lengths = np.abs(a[:, -1].astype(np.int64) - b[:, -1])
    return 1 - np.minimum(steps + np.minimum(lengths, LENGTH_STEPS), FARTHEST) / FARTHEST


def hex_digits(digest: np.ndarray) -> list[str]:
    return [d.tobytes().hex() for d in digest]


def compare(first: str, second: str) -> float:
    """Likeness of two fingerprints as written."""
    a, b = (np.frombuffer(bytes.fromhex(x), np.uint8)[None] for x in (first, second))
    return float(likeness(a, b)[0])


def spliced(text: str, following: str) -> str:
    """``text`` with the last half of its code points replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every document, without any shuffle."""
    ship_code(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.char_length(text).cast("long").alias("n_chars"), text.alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_chars", T.LongType()), T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array(hex_digits(digests(b["text"])), pa.string())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["n_chars"], found], schema.names)

    return rows.mapInArrow(run, schema)


_FIELDS = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def _compared(ids: pa.Array, texts: list[str], own: np.ndarray, following: list[str], after: np.ndarray) -> list[pa.Array]:
    """The result's columns for rows whose next document is known."""
    edited = [spliced(a, b) for a, b in zip(texts, following)]
    raw = pa.array(edited, pa.large_string())
    changed = digests(raw)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in edited]
    return [ids, pa.array([len(x) for x in texts], pa.int64()), pa.array(sha, pa.string()), pa.array(hex_digits(own), pa.string()),
            pa.array(hex_digits(changed), pa.string()), pa.array(likeness(own, changed)), pa.array(likeness(own, after))]


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited`` and
    ``near_next``: the likeness of its fingerprint to its edited text's and to the next document's."""
    ship_code(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    key = rows.schema["doc_id"]
    result = T.StructType([key, T.StructField("n_chars", T.LongType()), *(T.StructField(c, T.StringType()) for c in _FIELDS[1:4]),
                           *(T.StructField(c, T.DoubleType()) for c in _FIELDS[4:])])
    edges = [T.StructField("part", T.IntegerType()), T.StructField("first_text", T.StringType()), T.StructField("last_text", T.StringType())]
    schema = T.StructType([*result, *edges])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, held_digest, held_first, first = None, None, None, True

        def row(columns, first_texts, last_texts):
            n = len(columns[0])
            return pa.RecordBatch.from_arrays([*columns, pa.array([part] * n, pa.int32()), pa.array(first_texts, pa.string()),
                                               pa.array(last_texts, pa.string())], schema.names)

        for b in batches:
            _, offsets = tu.text_buffer(b["text"])
            for lo, hi in tu.slices(offsets, SLICE_BYTES):
                column = b["text"].slice(lo, hi - lo)
                own, texts, ids = digests(column), column.to_pylist(), b["doc_id"].slice(lo, hi - lo)
                opening = [texts[0] if first else None] + [None] * (len(texts) - 1)
                first = False
                if held is not None:
                    ids = pa.concat_arrays([held[0], ids])
                    texts, own, opening = [held[1], *texts], np.concatenate([held_digest, own]), [held_first, *opening]
                if len(texts) > 1:
                    yield row(_compared(ids.slice(0, len(texts) - 1), texts[:-1], own[:-1], texts[1:], own[1:]),
                              opening[:-1], [None] * (len(texts) - 1))
                held, held_digest, held_first = (ids.slice(len(texts) - 1), texts[-1]), own[-1:], opening[-1]
        if held is not None:  # the range's last row: what comes next is in another range
            blank = [pa.nulls(1, pa.string())] * 3 + [pa.nulls(1, pa.float64())] * 2
            yield row([held[0], pa.array([len(held[1])], pa.int64()), *blank], [held_first], [held[1]])

    ranged = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(F.asc_nulls_first("doc_id"), F.asc("tie"))
    ranged = ranged.sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc("tie")).select("doc_id", "text")
    found = materialise(ranged.mapInArrow(run, schema), "digests")

    openings = found.where("first_text is not null").select("part", F.col("first_text").alias("following"))
    order = Window.orderBy("part")  # one number a range
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turns = openings.select("part").withColumn("next", F.coalesce(F.lead("part").over(order), F.min("part").over(whole)))
    last = found.where("last_text is not null").select("doc_id", F.col("last_text").alias("text"), "part")
    last = last.join(turns, "part").join(openings.withColumnRenamed("part", "next"), "next").select("doc_id", "text", "following")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, after = digests(b["text"]), digests(b["following"])
            columns = _compared(b["doc_id"], b["text"].to_pylist(), own, b["following"].to_pylist(), after)
            yield pa.RecordBatch.from_arrays(columns, result.names)

    return found.where("last_text is null").select(*result.names).unionByName(last.mapInArrow(finish, result))
