"""Target-distribution importance resampling over hashed word n-grams.

Every run of 1 to ``max_n`` consecutive words is a feature, hashed into ``buckets`` by the CRC-32 of
its UTF-8 bytes. A bucket's gain is the scaled, floored log ratio of its smoothed share in the target
texts to that in the corpus; a document's weight is the floored mean of its features' gains. Weight
plus Gumbel noise (a hash of the id) is the score, and the documents of highest score are drawn:
sampling without replacement in proportion to exp(weight / 1000).

Tasks run Arrow kernels on slices of a batch: ``ascii_lower``, ``split_pattern_regex`` at all that is
no letter or digit, ``list_flatten``, ``dictionary_encode``. Runs of n words are pairs of shifted
dictionary indices (the run of n - 1 words before, the next word); only the distinct pairs get a text
and a CRC, which ``take`` deals back to the places. Gains are summed by text with ``reduceat``.

Scale: features are made once; each document's bucket numbers are written (two bytes a feature up to
65,536 buckets) and read again when the gains are known, so texts are read once and never shuffled.
What a task emits of its counts is at most one row a bucket. The driver gets one row a bucket, whose
number is a parameter. Ranks need no global window: scores are whole numbers from a narrow range, so a
table of their counts gives the least score that is drawn, and only the drawn rows and those tied with
them are range-sorted.

Defined cases: null texts and texts without words have no features, weight 0, and are never drawn;
a null id is hashed as an empty text and comes first among ties; of rows with one id and score, texts
decide by their hash, and exact repeats share places in some order; empty tables give an empty result; very
long texts are one slice each; columns that the operator adds replace columns of the same name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlens.llm import textutil as tu
from ticketlens.llm.cluster import ship_code
from ticketlens.operators.ids import with_contiguous_id
from ticketlens.session import materialise

BUCKETS = 10_000
MAX_N = 1
SEED = 2024
SHARE = (10, 100)  # of the eligible documents, drawn
LEAST_WORDS = 20
SLICE_BYTES = 1 << 22
#: Fixed value: what separates words after lower-casing.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SHORT = 32  # longer features are hashed one by one


def crc32_of(texts: pa.Array) -> np.ndarray:
    """CRC-32 of the UTF-8 bytes of each text: table steps over all short ones at once."""
    data, offsets = tu.text_buffer(texts)
    size = np.diff(offsets)
    out = np.zeros(len(size), np.uint32)
    short = np.flatnonzero(size <= _SHORT)
    short = short[np.argsort(size[short], kind="stable")]
    state = np.full(len(short), 0xFFFFFFFF, np.uint32)
    lengths, begins = size[short], offsets[:-1][short]
    for j in range(int(lengths[-1]) if len(short) else 0):
        a = int(np.searchsorted(lengths, j, "right"))  # those with a byte at place j
        s = state[a:]
        state[a:] = _CRC[(s ^ data[begins[a:] + j]) & 255] ^ (s >> np.uint32(8))
    out[short] = ~state
    raw = data.tobytes() if (size > _SHORT).any() else b""
    for i in np.flatnonzero(size > _SHORT).tolist():
        out[i] = zlib.crc32(raw[offsets[i]:offsets[i + 1]])
    return out


def _crc_table() -> np.ndarray:
    """The table of the reflected polynomial 0xEDB88320."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & np.uint32(1), (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_CRC = _crc_table()


def feature_buckets(texts: pa.Array, max_n: int = MAX_N, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, text by text; features of each text; words of each text)."""
    # own offsets from 0 on: after a cast, a slice keeps those of the whole column, which ``ascii_lower`` misreads
    data, offsets = tu.text_buffer(texts)
    texts = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=SEPARATORS)
    words = pc.list_flatten(parts)
    of = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    real = pc.greater(pc.binary_length(words), 0)  # separators at an end leave empty parts
    words, of = words.filter(real), of[real.to_numpy(zero_copy_only=False)]
    coded = pc.dictionary_encode(words)
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n_words = np.bincount(of, minlength=len(texts))
    run, names = code, coded.dictionary
    found, owner = [], []
    for n in range(1, max_n + 1):
        if n > 1:
            # the run of n - 1 words at a place with the word that follows it, within one text
            inside = of[:len(run) - 1] == of[n - 1:]
            pairs = run[:-1] * np.int64(len(coded.dictionary)) + code[n - 1:]
            pairs = np.where(inside, pairs, -1)
            distinct, at = np.unique(pairs, return_inverse=True)
            head = names.take(pa.array(np.maximum(distinct, 0) // max(len(coded.dictionary), 1)))
            tail = coded.dictionary.take(pa.array(np.maximum(distinct, 0) % max(len(coded.dictionary), 1)))
            run, names = at, pc.binary_join_element_wise(head, tail, pa.scalar(" ", pa.large_string()))
        else:
            inside = np.ones(len(run), bool)
        bucket = (crc32_of(names) % np.uint32(buckets)).astype(np.uint32)
        found.append(bucket[run[inside]])
        owner.append(of[:len(run)][inside])
        if len(run) < 2:
            break
    if len(found) > 1:
        order = np.argsort(np.concatenate(owner), kind="stable")
        return np.concatenate(found)[order], np.bincount(np.concatenate(owner), minlength=len(texts)), n_words
    return found[0], n_words, n_words


def _sliced(column: pa.Array) -> Iterator[pa.Array]:
    _, offsets = tu.text_buffer(column)
    for lo, hi in tu.slices(offsets, SLICE_BYTES):
        yield column.slice(lo, hi - lo)


def _width(buckets: int) -> np.dtype:
    return np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")


def featured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_n: int = MAX_N,
             buckets: int = BUCKETS) -> DataFrame:
    """Per document ``doc_id, tie`` (a hash of the text)``, n_words, n_features`` and its features' buckets."""
    ship_code(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tie"),
                       F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], rows.schema["tie"], T.StructField("n_words", T.LongType()),
                           T.StructField("n_features", T.LongType()), T.StructField("features", T.BinaryType())])
    kind = _width(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for texts in _sliced(b["text"]):
                k = len(texts)
                found, n, n_words = feature_buckets(texts, max_n, buckets)
                raw = pa.py_buffer(found.astype(kind).tobytes())
                ends = np.concatenate(([0], np.cumsum(n * kind.itemsize))).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), k, [None, pa.py_buffer(ends.tobytes()), raw])
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(at, k), b["tie"].slice(at, k), pa.array(n_words.astype(np.int64)),
                                                  pa.array(n.astype(np.int64)), packed], schema.names)
                at += k

    return rows.mapInArrow(run, schema)


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features each bucket holds: summed in tasks, then in Spark; one row a bucket reaches the driver."""
    kind = _width(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            held = b["features"]
            ends = np.frombuffer(held.buffers()[1], np.int32)[held.offset:held.offset + len(held) + 1]
            data = held.buffers()[2]
            if data is not None and len(held):
                total += np.bincount(np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].view(kind), minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int64)), pa.array(total[hit])], ["bucket", "n"])

    sums = features.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():  # at most ``buckets`` rows
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of a bucket's smoothed share in the target to that in the source."""
    s, t = source.astype(float), target.astype(float)
    ratio = (t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def noise(id_col: Column, seed: int = SEED) -> Column:
    """Gumbel noise from a hash of the id, in thousandths, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def weigh(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, tie, n_words, n_features, weight``: the floored mean gain of each document's features."""
    shared = features.sparkSession.sparkContext.broadcast(gain)
    kind = _width(len(gain))
    kept = ["doc_id", "tie", "n_words", "n_features"]
    schema = T.StructType([*(features.schema[c] for c in kept), T.StructField("weight", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b["n_features"].to_numpy()
            raw = b"".join(x.as_py() for x in b["features"])
            weight = np.zeros(len(n), np.int64)
            some = n > 0
            if some.any():
                values = shared.value.take(np.frombuffer(raw, kind))
                begin = (np.cumsum(n) - n)[some]
                weight[some] = np.add.reduceat(values, begin) // n[some]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in kept), pa.array(weight)], schema.names)

    return features.select(*kept, "features").mapInArrow(run, schema)


def ranked(scored: DataFrame, eligible: Column, share: tuple[int, int] = SHARE) -> DataFrame:
    """``scored`` (with doc_id, tie, score) and ``rank``: 1, 2, 3 ... of the floor(share) highest scores
    among the eligible rows, ties to smaller ids; null for all others."""
    scored = materialise(scored.withColumn("may", F.coalesce(eligible, F.lit(False))), "scored")
    per_score = scored.where("may").groupBy("score").agg(F.count(F.lit(1)).alias("n"))  # a row a whole score
    upto = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = per_score.select("score", F.sum("n").over(upto).alias("upto"), F.sum("n").over(total).alias("all"))
    drawn = F.floor(F.col("all") * share[0] / share[1]).cast("long")
    cut = sums.withColumn("k", drawn).where("upto >= k and k > 0").agg(F.max("score").alias("cut"), F.max("k").alias("k")).first()
    nothing = F.lit(None).cast("long")
    if cut.k is None:
        return scored.drop("may", "tie").withColumn("rank", nothing)
    near = F.col("may") & (F.col("score") >= cut.cut)
    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("tie")]
    first = with_contiguous_id(scored.where(near), order, "rank")
    first = first.withColumn("rank", F.when(F.col("rank") <= cut.k, F.col("rank")))
    return first.unionByName(scored.where(~near).withColumn("rank", nothing)).drop("may", "tie")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             max_n: int = MAX_N, buckets: int = BUCKETS, seed: int = SEED, share: tuple[int, int] = SHARE,
             least_words: int = LEAST_WORDS) -> DataFrame:
    """Every document's ``doc_id, n_features, weight, score, rank``; those with a rank are the sample."""
    features = materialise(featured(docs, id_col, text_col, max_n, buckets), "features")
    wanted = featured(target.select(F.lit(0).alias("doc_id"), F.col(target_text).alias("text")), max_n=max_n, buckets=buckets)
    gain = gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets))
    scored = weigh(features, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    out = ranked(scored, F.col("n_words") >= least_words, share)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def sample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **kwargs) -> DataFrame:
    """The drawn rows of ``docs``, all columns as they are (ids must be unique and present)."""
    drawn = resample(docs, target, id_col, **kwargs).where("rank is not null").select(F.col("doc_id").alias(id_col))
    return docs.join(drawn, id_col, "left_semi")
