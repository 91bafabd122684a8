import hashlib
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from ticketlens.llm import bucket_digest as bd
from ticketlens.llm import centroid_cluster as cc
from ticketlens.llm import importance_resample as ir
from ticketlens.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _grams(text, max_n):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def _resampled(docs, items, max_n, buckets, least, share):
    """The operator's rows by plain Python."""
    def counts(texts):
        c = [0] * buckets
        for t in texts:
            for g in _grams(t, max_n)[1]:
                c[zlib.crc32(g.encode()) % buckets] += 1
        return c
    s, t = counts(x for _, x in docs), counts(items)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, x in docs:
        w, g = _grams(x, max_n)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)])
    may = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    rank = {id(r): k + 1 for k, r in enumerate(may[:len(may) * share[0] // share[1]])}
    return [(r[0], r[1], r[2], r[3], rank.get(id(r))) for r in rows]


def _tuples(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("max_n,buckets", [(1, 50), (2, 1000), (3, 100_000)])
def test_resampling_equals_plain_python(spark, max_n, buckets):
    rnd = random.Random(max_n)
    words = ["Alpha", "beta", "GAMMA", "d3lta", "über", "ÉCLAIR", "x" * 40, "z"]
    docs = [(i, rnd.choice(["", "  ", "!"]) + rnd.choice([" ", ", ", "\n", "--"]).join(rnd.choices(words, k=rnd.randrange(60))) + rnd.choice(["", "."]))
            for i in range(120)]
    docs += [(500, None), (501, ""), (502, "?!"), (503, "beta " * 3000), (504, "y" * 50_000)]
    items = ["beta z z gamma", "z beta über", None, ""]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).withColumn("score", F.lit("own")).withColumn("RANK", F.lit(1))
    got = ir.resample(frame, spark.createDataFrame([(t,) for t in items], "text string"), max_n=max_n, buckets=buckets, share=(30, 100))
    assert _tuples(got) == sorted(_resampled(docs, items, max_n, buckets, 20, (30, 100)), key=str)


def test_resampling_ties_and_repeats(spark):
    docs = [(7, "a b c " * 10)] * 40 + [(None, "a b c " * 10)] * 3 + [(None, "only few words")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = ir.resample(frame, frame.limit(0), share=(50, 100)).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 22))
    assert len({(r.doc_id, r.score) for r in got}) == 2 or len({r.score for r in got if r.doc_id is None}) == 2
    whole = ir.sample(spark.createDataFrame([(i, "a b c " * 10, i) for i in range(50)], "doc_id long, text string, extra int"), frame)
    assert whole.columns == ["doc_id", "text", "extra"] and whole.count() == 5


def test_resampling_odd_input(spark, odd_docs, no_docs):
    got = ir.resample(odd_docs, odd_docs)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and got.count() == 10
    assert [t for _, t in got.dtypes] == ["bigint"] * 5
    assert all(r.weight == 0 for r in got.collect() if r.n_features == 0)
    assert ir.resample(no_docs, odd_docs).count() == 0


@pytest.mark.parametrize("max_n", [1, 2])
def test_features_of_slices_of_a_column(max_n):
    texts = ["Alpha beta gamma", "", None, "über Z z", "beta 12!", None, "d3lta", "ÉCLAIR x, y"]
    full = [t or "z z" for t in texts]
    for column in (pa.array(x, kind) for kind in (pa.string(), pa.large_string()) for x in ([*texts, None], [*full, ""])):
        for lo, hi in ((0, 9), (0, 3), (3, 5), (3, 9), (4, 5), (5, 6), (6, 8), (9, 9)):  # with nulls and without
            found, n, n_words = ir.feature_buckets(column.slice(lo, hi - lo), max_n, 1000)
            want = [_grams(t, max_n) for t in column.to_pylist()[lo:hi]]
            ends = [0, *n.cumsum().tolist()]
            assert n_words.tolist() == [len(w) for w, _ in want]
            assert [sorted(found[a:b].tolist()) for a, b in zip(ends, ends[1:])] == [
                sorted(zlib.crc32(g.encode()) % 1000 for g in grams) for _, grams in want]


def test_resampling_of_more_text_than_a_slice(spark):
    rnd = random.Random(5)
    docs = [(i, " ".join(rnd.choices(["alpha", "BETA", "gamma", "d3lta", "é"], k=9000))) for i in range(200)]  # 10 MB in one task
    items = ["beta beta", "gamma"]
    got = ir.resample(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), spark.createDataFrame([(t,) for t in items], "text string"))
    assert _tuples(got) == sorted(_resampled(docs, items, 1, 10_000, 20, (10, 100)), key=str)


def test_crc_of_short_and_long_texts():
    texts = ["", "a", "ü" * 16, "ü" * 17, "b" * 33, "c" * 5000, "two words"]
    assert ir.crc32_of(pa.array(texts)).tolist() == [zlib.crc32(t.encode()) for t in texts]


def _clustered(rows, k, rounds):
    """Lloyd's rounds by plain Python integers."""
    kept = [(i, [math.floor(256 * float(np.float64(c))) for c in x]) for i, x in rows
            if x is not None and len(x) == 4 and all(c is not None and math.isfinite(c) for c in x)]
    named = sorted(kept, key=lambda r: hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest())
    cents = [x for _, x in named[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        cents = [[sum(c) // len(groups[j]) for c in zip(*groups[j])] if j in groups else c for j, c in enumerate(cents)]
    out = [(i, nearest(x)) for i, x in kept]
    per = {}
    for _, (d, j) in out:
        per[j] = per.get(j, 0) + d
    return [(i, j, d, per[j], sum(per.values()), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest()) for i, (d, j) in out]


def test_clusters_equal_plain_python(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(rnd.choice([-1, 0, 2]), 0.2) for _ in range(4)]) for i in range(300)]
    rows += [(1000 + i, [0.5, -0.5, 0.25, 0.0]) for i in range(200)]  # one vector with a third of all rows
    rows += [(2000, None), (2001, [1.0]), (2002, [1.0, None, 2.0, 3.0]), (2003, [1.0, float("nan"), 2.0, 3.0]),
             (2004, [1.0, float("inf"), 2.0, 3.0]), (2005, []), (None, [0.1, 0.2, 0.3, 0.4]), (5, rows[5][1]), (2006, [-0.001] * 4)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7).withColumn("cluster", F.lit("own"))
    for k, rounds in ((9, 3), (2, 0), (600, 1)):
        got = cc.cluster(frame, k=k, rounds=rounds, dimensions=4)
        assert _tuples(got) == sorted(_clustered(rows, k, rounds), key=str)


def test_clusters_of_nothing_and_of_far_numbers(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    got = cc.cluster(none, dimensions=2)
    assert got.count() == 0 and got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    far = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 0.0])], "vec_id long, embedding array<float>")
    rows = cc.cluster(far, k=1, rounds=0, dimensions=2).collect()
    assert sorted(r.distance for r in rows) == [0, (2 * cc.BOUND) ** 2]


def _digest(text):
    """A fingerprint by plain Python."""
    b = text.encode()
    if 0 < len(b) < 3:
        b = (b + b"\0\0")[:3]
    counts = [0] * bd.BUCKETS
    for i in range(len(b) - 2):
        counts[bd._TABLES[0][b[i]] ^ bd._TABLES[1][b[i + 1]] ^ bd._TABLES[2][b[i + 2]]] += 1
    q = [sorted(counts)[j] for j in (31, 63, 95)]
    codes = [sum(c > x for x in q) for c in counts]
    size = len(text.encode())
    length = min(255, int(1 + math.log(size) / math.log(bd.LENGTH_BASE))) if size else 0
    return bytes(sum(codes[4 * i + j] << 2 * j for j in range(4)) for i in range(32)).hex() + f"{length:02x}", codes, length


def _likeness(a, b):
    steps = sum(abs(x - y) for x, y in zip(a[1], b[1])) + min(abs(a[2] - b[2]), bd.LENGTH_STEPS)
    return 1 - min(steps, bd.FARTHEST) / bd.FARTHEST


def _edits(docs):
    out = []
    for (i, t), (_, after) in zip(docs, docs[1:] + docs[:1]):
        edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        a, b, c = _digest(t), _digest(edited), _digest(after)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a[0], b[0], _likeness(a, b), _likeness(a, c)))
    return out


def test_digest_query_equals_plain_python(spark):
    docs = pd.read_parquet(f"{SF001}/documents.parquet").sort_values("doc_id")
    got = sorted(map(tuple, QUERIES["op13_bucket_digest"](spark, SF001).collect()))
    want = _edits(list(zip(docs.doc_id.tolist(), docs.text.fillna("").tolist())))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], atol=1e-12)
    assert np.mean([r[5] > r[6] for r in got]) > 0.95


def test_digests_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(bd, "SLICE_BYTES", 50)
    rnd = random.Random(3)
    docs = [(i, "".join(rnd.choices("abcdé ß語\n", k=rnd.randrange(90)))) for i in range(70)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame([*docs, (70, None)], "doc_id long, text string").repartition(3)
        got = sorted(map(tuple, bd.compare_edits(frame.withColumn("part", F.lit(1)).withColumn("tie", F.lit(2))).collect()))
        one = bd.compare_edits(frame.where("doc_id = 3")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = _edits([*docs, (70, "")])
    assert [r[:5] for r in got] == [r[:5] for r in want] and np.allclose([r[5:] for r in got], [r[5:] for r in want])
    assert [tuple(r)[:5] for r in one] == [r[:5] for r in _edits([docs[3]])]


def test_digests_of_odd_input(spark, odd_docs, no_docs):
    rows = bd.compare_edits(odd_docs).collect()
    assert len(rows) == 10 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    same = [r.fingerprint for r in rows if r.doc_id == 1]
    assert len(same) == 2 and len(set(same)) == 1
    assert bd.compare_edits(no_docs).count() == 0 and bd.fingerprints(no_docs).count() == 0
    plain = {(r.doc_id, r.n_chars, r.fingerprint) for r in bd.fingerprints(odd_docs).collect()}
    assert plain == {(r.doc_id, r.n_chars, r.fingerprint) for r in rows}
    a, b = (r.fingerprint for r in rows if r.doc_id in (5, 6))
    assert bd.compare(a, a) == 1 and 0 <= bd.compare(a, b) < 1
