import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from ticketlens.llm import fair_mix as fm
from ticketlens.llm import license_templates as lt
from ticketlens.llm import simple8b as s8
from ticketlens.llm import textutil as tu
from ticketlens.llm.queries import QUERIES, tokenizer_path
from ticketlens.session import scratch_path
from tests.conftest import SF001


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=700))
def test_coding_is_reversible(ids):
    ids = np.array(ids, np.uint64)
    words, blocks, escapes = s8.pack(ids)
    assert (s8.unpack(words, escapes) == ids).all()
    for b in range(len(blocks)):
        assert (s8.unpack_blocks(words, blocks, escapes, b, b + 1) == ids[b * s8.BLOCK:(b + 1) * s8.BLOCK]).all()
    assert len(words) <= len(ids)


def test_words_hold_as_many_ids_as_fit():
    assert len(s8.pack(np.zeros(240, np.uint64))[0]) == 4  # 60 ids of one bit
    assert len(s8.pack(np.full(256, 50_000, np.uint64))[0]) == 86  # three of 20 bits
    assert len(s8.pack(np.full(10, 2**60, np.uint64))[2]) == 10


def test_files_read_back_in_order(spark):
    docs = pd.read_parquet(f"{SF001}/documents.parquet").sort_values("doc_id")
    got = QUERIES["op8_simple8b"](spark, SF001).toPandas().sort_values("start").reset_index(drop=True)
    encode = tu.Subwords(tokenizer_path()).tokenizer.encode
    ids = [np.array(encode(t or "", add_special_tokens=False).ids + [0], "<u4") for t in docs.text]
    assert got.doc_id.tolist() == docs.doc_id.tolist()
    assert got.n_tokens.tolist() == [len(x) for x in ids]
    assert got.start.tolist() == np.cumsum([0] + [len(x) for x in ids[:-1]]).tolist()
    assert got.ids_crc32.tolist() == [zlib.crc32(x.tobytes()) for x in ids]


def test_files_of_odd_input(spark, odd_docs, no_docs):
    for df, n in ((odd_docs, 10), (no_docs, 0)):
        folder = scratch_path(spark, "ids")
        s8.write_documents(df, folder, tokenizer_path(), end_id=50256)
        rows = s8.read_documents(spark, folder).orderBy("start").collect()
        assert len(rows) == n
        at = 0
        for r in rows:
            assert r.start == at and len(r.ids) == 4 * r.n_tokens
            assert np.frombuffer(r.ids, "<u4")[-1] == 50256
            at += r.n_tokens
    assert [r.doc_id for r in rows] == []


def test_phrases_equal_a_search_in_words(spark):
    texts = ["GNU General Public License", "the apache\nlicense, Apache-License", "cc by; CC BY mit license", "mit", None, "",
             "gnu general public", "é MIT LICENSE é", "cc", "by cc by"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in lt.scan(docs).collect():
        t = re.sub("[A-Z]", lambda m: m[0].lower(), texts[r.doc_id] or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
        hits = [(i, label) for p, label in lt.PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        at = [i for i, _ in hits]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in hits})) and 0 <= r.score <= 1


def test_templates_accept_mandatory_wording_only():
    a = lt.compile_template("x", "one two <<opt>>maybe <<opt>>deep <<end>>three <<end>>four <<var:2>> five")

    def end(text):
        return a.run([tu.word_hash(w) for w in text.split()], 0)

    assert end("one two four five") == 4 and end("one two maybe three four x five") == 7
    assert end("one two maybe deep three four x y five and more") == 9
    for wrong in ("one two maybe four five", "one two four x y z five", "one four five", "two four five", ""):
        assert end(wrong) == -1
    with pytest.raises(ValueError):
        lt.compile_template("y", "<<opt>>a <<end>>b")


def test_license_texts_and_near_misses(spark):
    mit = re.sub(r"<<[^>]*>>", " ", dict(lt.TEMPLATES)["text-mit"])
    docs = spark.createDataFrame([(0, "Copyright X\n" + mit.replace("SHALL THE", "SHALL THE NICE AUTHORS")),
                                  (1, mit.replace("free of charge", "for a fee")),
                                  (2, "Licensed under the Apache License, Version 2.0."), (3, "Licensed under CC BY-NC 4.0.")],
                                 "doc_id long, text string")
    got = {r.doc_id: r for r in lt.scan(docs).collect()}
    assert "text-mit" in got[0].labels and got[0].score > 0.9 and "text-mit" not in got[1].labels
    assert got[2].labels == "apache,notice-apache-2.0" and got[3].labels == "cc-by,notice-cc"
    assert got[0].spans[0].label == "text-mit" and got[0].spans[0].first_word == 2


def test_cut_or_altered_license_texts_are_not_accepted(spark):
    whole = {label: re.sub(r"<<opt>>|<<end>>", " ", re.sub(r"<<var:\d+>>", " 1 ", text)) for label, text in lt.TEMPLATES if label.startswith("text")}
    docs = [(f"{k} whole", t) for k, t in whole.items()] + [(f"{k} cut", " ".join(t.split()[:-1])) for k, t in whole.items()]
    docs += [(f"{k} altered", " ".join(t.split()[:-6] + ["never"] + t.split()[-5:])) for k, t in whole.items()]
    for r in lt.scan(spark.createDataFrame(docs, "doc_id string, text string")).collect():
        assert (r.doc_id.split(" ")[0] in r.labels) == r.doc_id.endswith("whole"), r.doc_id


def test_a_long_text_of_lead_words_costs_its_length():
    import time
    took = []
    for n in (500, 4000):
        column = pa.array([" licensed under the" * n])
        a = [lt.compile_template(label, text) for label, text in lt.TEMPLATES]
        data, offsets = tu.text_buffer(column)
        h, _, of = tu.words(data, offsets, tu.NOT_ALNUM, lower=True)
        began = time.perf_counter()
        for x in a:
            for at in lt._places(h, of, x.lead)[0].tolist():
                x.run(h[at:min(len(h), at + x.longest)].tolist(), 0)
        took.append(time.perf_counter() - began)
    assert took[1] < 24 * took[0]  # eight times the places; 64 times if each copied the rest of the text


def test_licenses_of_odd_input(spark, odd_docs, no_docs):
    out = lt.scan(odd_docs)
    assert [c.lower() for c in out.columns].count("labels") == 1 and out.count() == 10
    assert {r.score for r in out.collect()} == {0.0} and lt.scan(no_docs).count() == 0


def _water(sizes, weights, total):
    """Shares by weight; who is above twice its size gets that, and the rest is shared again."""
    targets, free = {}, dict(sizes)
    left = total
    while free:
        w = sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / w > 2 * sizes[s]}
        if not over:
            return {**targets, **{s: left * weights[s] / w for s in free}}
        for s in over:
            targets[s] = 2.0 * sizes[s]
            left -= targets[s]
            free.pop(s)
    return targets


def test_mix_of_the_given_documents(spark):
    got = QUERIES["op10_fair_mix"](spark, "/root/testdata/sf0.01").toPandas()
    docs = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in zip(docs.doc_id, docs.text)}
    assert got.set_index("doc_id")["size"].to_dict() == size
    got["source"] = got.doc_id.map(docs.set_index("doc_id").source)
    names = sorted(docs.source.unique())
    sizes = got.groupby("source")["size"].sum().to_dict()
    want = _water(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, 1.5 * sum(sizes.values()))
    for s, rows in got.groupby("source"):
        assert rows.source_size.iloc[0] == sizes[s] and rows.target.iloc[0] == pytest.approx(want[s])
        assert abs(rows.taken.sum() - want[s]) <= 2 * rows["size"].max()
    assert (got.taken <= 2 * got["size"]).all() and got.taken.sum() <= 1.5 * sum(sizes.values())
    again = QUERIES["op10_fair_mix"](spark, "/root/testdata/sf0.01").toPandas()
    assert got.set_index("doc_id").taken.to_dict() == again.set_index("doc_id").taken.to_dict()


def test_taken_documents_are_those_of_a_merged_queue(spark, monkeypatch):
    monkeypatch.setattr(fm, "BUCKET_ROWS", 7)
    rng = np.random.default_rng(3)
    rows = [(i, "hot" if i % 3 else f"s{i % 5}", int(rng.integers(1, 90))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    df = fm.keyed(df)
    cut = fm.cuts(df)
    got = {r.doc_id: r.copies for r in fm.copies(df, cut).collect()}
    # per source, what is taken is a prefix of its queue; the sources' last virtual times are alike
    target = {r.source: r.target for r in cut.collect()}
    taken = {s: sum(got[i] * n for i, t, n in rows if t == s) for s in target}
    assert sum(taken.values()) <= 1.5 * sum(n for _, _, n in rows)
    ends = [taken[s] / target[s] for s in target]
    assert max(ends) - min(ends) < 2 * 90 / min(target.values())
    texts = spark.createDataFrame([(i, s, "w " * n) for i, s, n in rows], "doc_id long, source string, text string")
    keys = fm.keyed(texts.withColumn("size", fm.words_in(F.col("text"))), tie=F.xxhash64("text"))
    want = {r.doc_id: r.copies for r in fm.copies(keys, fm.cuts(keys)).collect()}
    counts = {r.doc_id: r["count"] for r in fm.mix(texts).groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in want.items() if n}


def _queue(rows, seed=17):
    """(taken words, cut places) of (key, source, size) rows by one merged queue in plain Python."""
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    target = _water(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}, 1.5 * sum(sizes.values()))
    return target


@pytest.mark.parametrize("same_text", [True, False])
def test_rows_of_one_id_are_taken_each_for_itself(spark, same_text):
    rows = [(None if i % 2 else 7, "hot", "w " * 100 if same_text else f"v{i} " + "w " * 99) for i in range(300)]
    rows += [(1000 + i, "cold", "w " * 100) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(6)
    mixed = fm.mix(df).groupBy("source").count().collect()
    taken = {r.source: 100 * r["count"] for r in mixed}
    target = _queue([(i, s, 100) for i, s, _ in rows])
    assert sum(taken.values()) <= 1.5 * 35_000
    assert all(abs(taken[s] - target[s]) <= 200 for s in target), (taken, target)


def test_the_queue_replayed_in_plain_python(spark):
    rng = np.random.default_rng(5)
    rows = [(i, f"s{i % 3}", int(rng.integers(0, 60))) for i in range(150)]
    df = fm.keyed(spark.createDataFrame(rows, "doc_id long, source string, size long"))
    got = {r.doc_id: r.copies for r in fm.copies(df, fm.cuts(df)).collect()}
    target = _queue(rows)
    places = df.select("doc_id", *(F.xxhash64("key", F.lit(k), F.lit(17)).alias(f"u{k}") for k in range(2))).collect()
    u = {r.doc_id: (r.u0, r.u1) for r in places}
    buckets = {r.source: r.buckets for r in fm.targets(df).collect()}
    events = []
    for s in target:
        done, size_of = 0, sum(n for _, t, n in rows if t == s)
        for turn in (0, 1):
            if turn * size_of >= target[s]:
                continue
            for i, n in sorted(((i, n) for i, t, n in rows if t == s and n),
                               key=lambda r: (((u[r[0]][turn] & (2**64 - 1)) >> 24) % buckets[s], u[r[0]][turn])):
                done += n
                events.append((done / target[s], turn, i, n))
    events.sort()
    budget, want = 1.5 * sum(n for _, _, n in rows), {i: 0 for i, _, _ in rows}
    for _, _, i, n in events:
        if budget < n:
            break
        budget -= n
        want[i] += 1
    assert {i: got[i] for i, _, n in rows if n} == {i: want[i] for i, _, n in rows if n}


def test_mix_of_odd_input(spark, odd_docs, no_docs):
    out = fm.mix(odd_docs)
    assert out.columns == odd_docs.columns and out.count() > 0
    assert fm.mix(no_docs).count() == 0
    empty = odd_docs.where("doc_id in (2, 3, 4)")
    assert fm.mix(empty).count() == 0
    sizes = empty.selectExpr("doc_id", "source", "0L AS size")
    assert {r.target for r in fm.targets(sizes).collect()} == {0.0}
