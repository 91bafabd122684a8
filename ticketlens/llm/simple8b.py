"""Token ids in word-aligned files: Simple-8b coding with per-block offsets.

A 64-bit word holds a selector in its top four bits and a varying count of ids, each of the width
that selector stands for, in the other 60 (first id lowest). Ids of more than 60 bits are escapes:
the word names a place in the row's list of raw ids. Ids are coded in blocks of ``BLOCK``, and the
word offset of each block is stored, so any block can be read alone and whole rows are decoded
without a loop over words.

A data set is a folder of Parquet files; a row is a segment of whole documents:
``shard, shard_start, n_ids, doc_id[], doc_len[], words, block_words, escapes``. Shards are ranges of
document ids in ascending order, so an id's global place is its shard's offset (one number a shard)
plus its place in the shard.

Scale: one range shuffle of the texts, sorted within tasks (Spark spills); ids are made in slices of
about 8 megabytes of text, coded in slices of a quarter megabyte, and written at once. A repeated id is also ranged by its text.

Defined cases: a null or empty text has only the end id; null ids sort first; repeated rows are kept
each, those of one id in an order given by their texts; an empty table gives an empty data set.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlens.llm import textutil as tu

BLOCK = 256
ENCODED_BYTES = 1 << 23  # texts whose ids are made at once
#: Selector -> ids in a word, bits of each.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
BITS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 64])
ESCAPE = 14
_U = np.uint64


def _widths(ids: np.ndarray) -> np.ndarray:
    high = ids >> _U(32)
    low = np.frexp((ids & _U(0xFFFFFFFF)).astype(np.float64))[1]
    return np.where(high > 0, 32 + np.frexp(high.astype(np.float64))[1], low).astype(np.uint8)


def _widest(width: np.ndarray) -> dict[int, np.ndarray]:
    """For each count of a selector, the widest of as many ids from each place on."""
    most = {1: width}

    def joined(a: int, b: int) -> None:
        out = most[a].copy()
        out[:-a] = np.maximum(out[:-a], most[b][a:])
        most[a + b] = out

    for a, b in ((1, 1), (2, 1), (2, 2), (4, 1), (4, 2), (4, 3), (4, 4), (8, 2), (8, 4), (8, 7),
                 (12, 8), (15, 15), (30, 30)):
        if len(width) > a:
            joined(a, b)
        else:
            most[a + b] = most[a]
    return most


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, word offset of each block, raw ids of the escapes). Each word takes as many ids as
    fit; all blocks are walked in step."""
    ids = np.ascontiguousarray(ids, _U)
    n = len(ids)
    starts = np.arange(0, n, BLOCK)
    if not n:
        return np.empty(0, _U), np.empty(0, np.uint32), np.empty(0, _U)
    most = _widest(_widths(ids))
    left = np.minimum(BLOCK - np.arange(n) % BLOCK, n - np.arange(n)).astype(np.int16)
    best = np.full(n, ESCAPE, np.uint8)
    for s in range(13, -1, -1):  # later ones hold more ids
        c = int(COUNTS[s])
        best[(most[c] <= BITS[s]) & (left >= c)] = s
    ends = np.minimum(starts + BLOCK, n)
    at, block, found = starts.copy(), np.arange(len(starts)), []
    per_block = np.zeros(len(starts), np.int64)
    while len(block):
        found.append((block, at))
        per_block[block] += 1
        at = at + COUNTS[best[at]]
        more = at < ends[block]
        block, at = block[more], at[more]
    offsets = np.cumsum(per_block) - per_block
    places = np.empty(int(per_block.sum()), np.int64)
    for step, (block, at) in enumerate(found):
        places[offsets[block] + step] = at
    chosen = best[places]
    words = chosen.astype(_U) << _U(60)
    for s in np.unique(chosen):
        of = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            escapes = ids[places[of]]
            words[of] |= np.arange(len(of), dtype=_U)
            continue
        for j in range(COUNTS[s]):
            words[of] |= ids[places[of] + j] << _U(j * BITS[s])
    return words, offsets.astype(np.uint32), escapes if (chosen == ESCAPE).any() else np.empty(0, _U)


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids of consecutive words, all words of a selector at once."""
    chosen = (words >> _U(60)).astype(np.int64)
    counts = COUNTS[chosen]
    begin = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), _U)
    payload = words & _U((1 << 60) - 1)
    for s in np.unique(chosen):
        of = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            out[begin[of]] = escapes[payload[of].astype(np.int64)]
            continue
        mask = _U((1 << int(BITS[s])) - 1)
        for j in range(COUNTS[s]):
            out[begin[of] + j] = (payload[of] >> _U(j * BITS[s])) & mask
    return out


def unpack_blocks(words: np.ndarray, block_words: np.ndarray, escapes: np.ndarray, first: int,
                  last: int) -> np.ndarray:
    """The ids of blocks ``first`` to ``last - 1`` only."""
    ends = np.append(block_words, len(words)).astype(np.int64)
    return unpack(words[ends[first]:ends[last]], escapes)


def _file_schema(key: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("shard_start", T.LongType()),
        T.StructField("n_ids", T.LongType()), T.StructField("doc_id", T.ArrayType(key)),
        T.StructField("doc_len", T.ArrayType(T.LongType())), T.StructField("words", T.BinaryType()),
        T.StructField("block_words", T.BinaryType()), T.StructField("escapes", T.BinaryType())])


def write_documents(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0,
                    id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id``, and write the ids in ascending order of
    ``id_col`` to ``folder``."""
    rows = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = _file_schema(rows.schema["key"].dataType)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = tu.subwords(tokenizer_path)
        shard, start = TaskContext.get().partitionId(), 0
        for b in batches:
            _, offsets = tu.text_buffer(b["text"])
            for first, last in tu.slices(offsets, ENCODED_BYTES):  # distinct chunks of each are encoded once
                found, size = vocabulary.encode_column(b["text"].slice(first, last - first))
                ends = np.append(0, np.cumsum(size))
                for lo, hi in tu.slices(offsets[first:last + 1] - offsets[first]):
                    n = hi - lo
                    ids = np.insert(found[ends[lo]:ends[hi]], ends[lo + 1:hi + 1] - ends[lo], end_id)
                    words, block_words, escapes = pack(ids)
                    one = np.array([0, n], np.int32)
                    columns = [pa.array([shard], pa.int32()), pa.array([start]), pa.array([len(ids)]),
                               pa.ListArray.from_arrays(one, b["key"].slice(first + lo, n)),
                               pa.ListArray.from_arrays(one, pa.array(size[lo:hi] + 1)),
                               *(pa.array([x.tobytes()], pa.binary()) for x in (words, block_words, escapes))]
                    yield pa.RecordBatch.from_arrays(columns, schema.names)
                    start += len(ids)

    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie")
    rows.select("key", "text").mapInArrow(encode, schema).write.parquet(folder)


def read_documents(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """One row per document, read back from the files: ``doc_id``, ``start`` (ids of all documents
    before it), ``n_tokens``, ``ids_crc32`` and, on demand, ``ids`` (little-endian unsigned 32-bit)."""
    segments = spark.read.parquet(folder)
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # one row per file
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    key = segments.schema["doc_id"].dataType.elementType
    fields = [T.StructField("doc_id", key), T.StructField("start", T.LongType()),
              T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    schema = T.StructType([*fields, *[T.StructField("ids", T.BinaryType())] * with_ids])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                words, escapes = (np.frombuffer(b[c][i].as_buffer(), _U) for c in ("words", "escapes"))
                raw = unpack(words, escapes).astype("<u4").tobytes()
                lengths = b["doc_len"][i].values.to_numpy()
                ends = np.cumsum(lengths)
                texts = [raw[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
                columns = [b["doc_id"][i].values, pa.array(b["first"][i].as_py() + ends - lengths),
                           pa.array(lengths), pa.array([zlib.crc32(x) for x in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [*columns, *[pa.array(texts, pa.binary())] * with_ids], schema.names)

    rows = segments.join(shards, "shard").withColumn("first", F.col("offset") + F.col("shard_start"))
    return rows.select("first", "doc_id", "doc_len", "words", "escapes").mapInArrow(decode, schema)
