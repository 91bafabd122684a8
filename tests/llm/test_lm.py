import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from ticketlens.llm import attention_lm as a
from ticketlens.llm.queries import QUERIES, tokenizer_path
from tests.conftest import SF001
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    m = a.Model.start(rng.integers(0, 9, (a.CLASSES, a.CLASSES)).astype(float))
    for t in m.w.values():
        t += rng.normal(0, 0.3, t.shape).astype(np.float32)
    return m


def test_gradient_is_the_slope(model):
    rng = np.random.default_rng(2)
    w = rng.integers(0, a.CLASSES, (3, a.SPAN + 1))
    real = np.ones((3, a.SPAN), bool)
    real[1, 5:] = False

    def loss():
        return -(model.log10_next(w[:, :-1], w[:, 1:], 0) * real).sum() * math.log(10) / real.sum()

    g = model.gradient(w[:, :-1], w[:, 1:], real)
    c = int(w[0, 3])
    for name, at in (("last", (c, int(w[0, 4]))), ("q", (c, 2)), ("k", (c, 3)), ("v", (c, 1)), ("out", (4, int(w[0, 4]))),
                     ("back", (1,))):
        eps, old = 1e-2, model.w[name][at]
        model.w[name][at] = old + eps
        up = loss()
        model.w[name][at] = old - eps
        down = loss()
        model.w[name][at] = old
        assert g[name][at] == pytest.approx((up - down) / (2 * eps), abs=2e-4, rel=0.05), name


def test_gradient_is_that_of_products_with_ones_and_zeros(model):
    rng = np.random.default_rng(4)
    w, one = rng.integers(0, 40, (a.BATCH, a.SPAN + 1)), np.eye(a.CLASSES)  # most classes have no place
    c, y, real = w[:, :-1], w[:, 1:], rng.random((a.BATCH, a.SPAN)) < 0.9
    t = {n: x.astype(float) for n, x in model.w.items()}
    scores = np.einsum("nik,njk->nij", t["q"][c], t["k"][c]) / a.WIDTH**0.5 + t["back"][a._BACK]
    s = np.exp(np.where(a._CAUSAL, scores, -np.inf))
    s /= s.sum(2, keepdims=True)
    got = s @ t["v"][c]
    p = np.exp(got @ t["out"] + t["last"][c])
    d = (p / p.sum(2, keepdims=True) - one[y]) * real[:, :, None] / real.sum()
    da = d @ t["out"].T
    ds = np.einsum("nik,njk->nij", da, t["v"][c])
    ds = s * (ds - (s * ds).sum(2, keepdims=True))
    want = {"last": np.einsum("nic,nid->cd", one[c], d), "out": np.einsum("nik,nid->kd", got, d),
            "q": np.einsum("nic,nij,njk->ck", one[c], ds, t["k"][c], optimize=True) / a.WIDTH**0.5,
            "k": np.einsum("njc,nij,nik->ck", one[c], ds, t["q"][c], optimize=True) / a.WIDTH**0.5,
            "v": np.einsum("njc,nij,nik->ck", one[c], s, da, optimize=True),
            "back": np.bincount(a._BACK[a._CAUSAL], ds.sum(0)[a._CAUSAL], a.SPAN)}
    g = model.gradient(c, y, real)
    assert g.keys() == want.keys()
    for n, x in want.items():
        assert np.allclose(g[n], x, rtol=1e-3, atol=1e-6), n


def test_a_step_takes_little_new_memory(model):
    rng = np.random.default_rng(5)
    w, real = rng.integers(0, a.CLASSES, (a.BATCH, a.SPAN + 1)), np.ones((a.BATCH, a.SPAN), bool)
    model.gradient(w[:, :-1], w[:, 1:], real)
    tracemalloc.start()
    model.gradient(w[:, :-1], w[:, 1:], real)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * 4 * a.BATCH * a.SPAN * a.CLASSES  # logits, one-hot classes and their slopes took more


def test_causal_and_every_id_scored_once(model):
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 50, 1000).astype(float)
    of = a.Vocabulary.classes(counts, np.arange(1000) % 2 == 0)
    after, ids = rng.integers(0, a.CLASSES, 500), rng.integers(0, 1000, 500)
    voc = a.Vocabulary.fit(of, counts, after, ids, np.ones(500))
    assert np.allclose([(10.0 ** voc.inside[3][voc.place[of == c]]).sum()
                        for c in np.unique(of)], 1, atol=1e-4)
    lengths = [0, 1, 5, a.SPAN - 1, a.SPAN, a.SPAN + 1, 100, 77]
    texts = [np.concatenate(([999], rng.integers(0, 999, n), [999])) for n in lengths]
    flat, starts = np.concatenate(texts), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    got = a._score_slice(model, voc, flat, starts)
    for t, score in zip(texts, got):
        want, n = 0.0, len(t) - 1
        for place in range(n):  # the window in which this place is scored
            k = 0 if place < a.SPAN else (place - a.SPAN) // a.STRIDE + 1
            context = t[k * a.STRIDE:place + 1]
            window = np.zeros((1, a.SPAN), np.int64)
            window[0, :len(context)] = of[context]  # what follows is zero: it must not matter
            y = np.full((1, a.SPAN), of[t[place + 1]])
            want += model.log10_next(window, y, 0)[0, len(context) - 1] + voc.inside[of[t[place]], voc.place[t[place + 1]]]
        assert score == pytest.approx(want, rel=1e-4)


def test_every_id_of_long_texts_is_learnt(spark):
    sub = a.tu.subwords(tokenizer_path())
    texts = ["", "one", "the river ran past the old mill " * 300, "over the stones where children used to play " * 7]
    ids, of = a._ids(sub, pa.array(texts), sub.size)
    rows = a._learn_pass(spark.createDataFrame([(t,) for t in texts], "text string"), tokenizer_path()).where("kind = 2")
    got = [np.frombuffer(r.window, "<u4") for r in rows.collect()]
    assert all(len(w) <= a.SPAN + 1 for w in got)
    learnt = Counter(np.concatenate([w[1:] for w in got]).tolist())
    assert learnt == Counter(np.delete(ids, of[:-1]).tolist())


def test_query_against_brute_force(spark):
    got = QUERIES["op3_attention_lm"](spark, SF001).toPandas().set_index("doc_id")
    texts = pd.read_parquet(f"{SF001}/documents.parquet").set_index("doc_id").text
    def low(t):
        return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    words = {i: [*re.findall(r"[^\x20\x09-\x0D]+", low(t)), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    c = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in words.items():
        r = got.loc[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel=1e-9)
        assert r.score < 0


def test_model_prefers_text_of_its_corpus(spark):
    texts = pd.read_parquet(f"{SF001}/documents.parquet").text.dropna().tolist()
    rows = [(i, t, True) for i, t in enumerate(texts[:150])]
    sample = [t for t in texts[150:] if 40 < len(t.split()) < 400][:20]
    rng = np.random.default_rng(5)
    rows += [(1000 + i, t, False) for i, t in enumerate(sample)]
    rows += [(2000 + i, "".join(rng.permutation(list(t))), False) for i, t in enumerate(sample)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    out = {r.doc_id: r.score for r in a.score(docs, F.col("learn"), tokenizer_path()).collect()}
    assert all(out[1000 + i] > out[2000 + i] for i in range(len(sample)))


def test_odd_input(spark, odd_docs, no_docs):
    out = a.score(odd_docs, F.col("doc_id") < 5, tokenizer_path())
    assert [c.lower() for c in out.columns].count("score") == 1
    rows = out.collect()
    assert len(rows) == 10 and all(r.score < 0 or math.isclose(r.score, 0) for r in rows)
    assert sorted(r.n_tokens for r in rows)[:4] == [1, 1, 1, 1]  # null, empty and blank texts: the end
    nothing = a.score(odd_docs, F.lit(False), tokenizer_path()).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in nothing} == {(0, 0, 0.0)}
    assert a.score(no_docs, F.lit(True), tokenizer_path()).count() == 0
