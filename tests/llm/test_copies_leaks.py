import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ticketlens.llm import chosen_path_join as cp
from ticketlens.llm import template_decontam as td
from ticketlens.llm.queries import QUERIES
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _shingles(t):
    w = WORD.findall(t or "")
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def _classes(docs):
    """(class, links, copies) of each id by comparing all pairs."""
    nodes = {}
    for i, t in docs:
        nodes.setdefault(_shingles(t), []).append(i)
    sets = [s for s in nodes if s]
    root, links = list(range(len(sets))), [0] * len(sets)

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a in range(len(sets)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    out = {i: (i, 0, 1) for i in nodes.get(frozenset(), [])}
    ids = {}
    for a, s in enumerate(sets):
        ids.setdefault(find(a), []).extend(nodes[s])
    for a, s in enumerate(sets):
        for i in nodes[s]:
            out[i] = (min(ids[find(a)]), links[a], len(nodes[s]))
    return out


def _near_copies():
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    docs, passage = [], rnd.choices(words, k=60)
    for g in range(6):  # a group of 180 near copies, larger than a bucket and a block, and small ones
        base = rnd.choices(words, k=90)
        for _ in range(180 if g == 0 else 5):
            t = list(base)
            for _ in range(rnd.randrange(4)):
                t[rnd.randrange(len(t))] = rnd.choice(words)
            docs.append(" ".join(t))
    docs += [" ".join(passage + rnd.choices(words, k=60)) for _ in range(120)]  # share a passage only
    docs += ["a b c", "a b c", "a b", "", None, " \n", "one two three four five"]
    docs += docs[:3] * 4
    order = list(range(len(docs)))
    rnd.shuffle(order)
    return [(k, docs[i]) for k, i in enumerate(order)]


def test_join_finds_every_link_class_and_copy(spark):
    docs = _near_copies()
    found = cp.join(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in found} == _classes(docs)
    assert {r.doc_id for r in found if r.stays} == {c for c, _, _ in _classes(docs).values()}


def test_pairs_in_large_buckets_of_documents_unlike_each_other(spark, monkeypatch):
    monkeypatch.setattr(cp, "LIMIT", 16)
    monkeypatch.setattr(cp, "WHOLE", 32)
    monkeypatch.setattr(cp, "DEEPEST", 1)
    signatures = cp.signatures  # tokens of two bits: a quarter of all nodes share each one
    monkeypatch.setattr(cp, "signatures", lambda *x: signatures(*x).withColumn(
        "sig", F.transform("sig", lambda t: t.bitwiseAND(3))))
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    docs = [rnd.choices(words, k=60) for _ in range(800)]
    docs += [[*d[:-3], "x", "y", "z"] for d in docs[:20]]
    docs = [(i, " ".join(d)) for i, d in enumerate(docs)]
    rows = {r.doc_id: r for r in cp.join(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    assert {i for i, r in rows.items() if r.n_links} == {*range(20), *range(800, 820)}
    assert all(rows[i].class_id == rows[i + 800].class_id == i for i in range(20))


def _groups_around_a_passage(n):
    """n documents: near copies with up to a quarter of their words changed, and others that share half their text."""
    rnd = random.Random(n)
    words = [f"w{i}" for i in range(5000)]
    base = rnd.choices(words, k=120)
    docs = []
    for k in range(n):
        if k % 2:
            t = list(base)
            for _ in range(rnd.randrange(8)):
                t[rnd.randrange(len(t))] = rnd.choice(words)
        else:
            t = base[:80] + rnd.choices(words, k=30)
        docs.append((k, " ".join(t)))
    return docs


@pytest.mark.parametrize("limit,whole,n", [(1024, 1024, 700), (256, 4096, 2100), (512, 512, 2100)])
def test_edges_grow_with_the_documents_not_their_square(spark, monkeypatch, limit, whole, n):
    """Compared whole, block by block, and split on."""
    monkeypatch.setattr(cp, "LIMIT", limit)
    monkeypatch.setattr(cp, "WHOLE", whole)
    rows = cp.signatures(spark.createDataFrame(_groups_around_a_passage(n), "doc_id long, text string").repartition(4))
    nodes = cp.materialise(rows.groupBy("fp").agg(F.first("sig").alias("sig"), F.first("low").alias("low")), "nodes")
    edges = cp.materialise(cp.candidates(nodes), "edges")
    assert edges.count() < 12 * n  # a bucket a run, and somewhat more where it is split
    assert edges.where("a = b").isEmpty()


@pytest.mark.parametrize("limit,whole", [(100, 4000), (150, 150)])
def test_links_of_near_copies_among_documents_with_their_passage(spark, monkeypatch, limit, whole):
    monkeypatch.setattr(cp, "LIMIT", limit)
    monkeypatch.setattr(cp, "WHOLE", whole)
    docs = _groups_around_a_passage(500)
    found = cp.join(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in found} == _classes(docs)


def test_similar_pairs_of_sets():
    import numpy as np
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 40, 30).astype(np.uint64)) for _ in range(40)]
    got = cp.similar(sets, 0.5)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            n = len(np.intersect1d(a, b))
            assert got[i, j] == (i != j and n >= 0.5 * (len(a) + len(b) - n))


def test_components_follow_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101)]
    got = {r.node: r.root for r in cp.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}


def test_copies_in_odd_input(spark, odd_docs, no_docs):
    found = cp.join(odd_docs).collect()
    assert len(found) == 10 and sum(r.n_shingles == 0 for r in found) == 4
    kept = cp.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    # the repeated row stays once; the near copy without an id follows it
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["1", "2", "3", "4", "5", "6", "7", "None"]
    assert cp.join(no_docs).count() == 0 and cp.keep_one(no_docs).count() == 0


ITEM = ("A train leaves the old station at 9 with 120 passengers and travels 300 km to the coast where Anna "
        "waits for Ben with 3 large bags and 2 tickets for the evening show")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, ITEM), (2, "what is the capital of that far country"), (3, "too short"), (4, None)],
                                 "item_id long, text string")


def test_templates_find_exchanged_values(spark, benchmark):
    other = (ITEM.replace("120", "85").replace("300 km", "410 miles").replace("Anna", "Carla").replace("Ben", "Dave")
             .replace(" 9 ", " 7 "))
    docs = [(0, "Unrelated words here. " + ITEM + " and then more."), (1, "Before.\n" + other + "\nAfter that."),
            (2, ITEM.replace("old", "new").replace("large", "small")),  # other wording in the middle
            (3, "a long text about trains that leave stations with passengers at some time of the day"),
            (4, "So what is the capital of that far country"), (5, ITEM.replace("Ben", "Anna")), (6, None), (7, ""),
            (8, " ".join(ITEM.split()[:9]))]
    found = td.find(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    got = {(r.key.id, r.item_id): r for r in found}
    assert {(0, 1), (1, 1), (4, 2)} <= set(got) and {k[0] for k in got} <= {0, 1, 2, 4, 5}
    assert got[(0, 1)].n_changed == 0 and got[(1, 1)].n_changed >= 4
    assert got[(0, 1)].n_words >= 25
    assert (5, 1) not in got or got[(5, 1)].n_words < 25  # one value for two names is no instance


def test_templates_find_colliding_values(spark, benchmark):
    other = ITEM.replace("120", "85").replace(" 9 ", " 7 ").replace("300", "410").replace("Anna", "Carla")
    item = "Yesterday the careful farmer sold 3 bags of red apples and 3 baskets of fresh pears at the market"
    docs = [(0, ITEM.replace("2 tickets", "3 tickets")), (1, ITEM.replace("Ben", "Anna")),  # one value changed to another's
            (2, other.replace("3 large", "4 large").replace("2 tickets", "4 tickets")),  # two quantities, one new value
            (3, item.replace("3 bags", "4 bags").replace("3 baskets", "5 baskets")),  # one value of two quantities
            (4, other.replace("Anna", "Dave").replace("Carla", "Dave").replace("Ben", "Dave"))]
    items = benchmark.unionByName(spark.createDataFrame([(5, item)], "item_id long, text string"))
    found = {(r.key.id, r.item_id): r for r in td.find(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert set(found) == {(0, 1), (1, 1), (2, 1), (3, 5)}  # Anna and Ben can't both be Dave
    assert (found[(0, 1)].n_changed, found[(1, 1)].n_changed, found[(3, 5)].n_changed) == (1, 1, 2)


def test_short_and_number_heavy_items_are_found(spark):
    items = ["What is 12 plus 15 times 3?", "Convert 5 km to miles and 3 kg to pounds", "Prime numbers under 9", "Serendipity",
             "Ada asks Bob, Cy, 3 4, Dee: who of them has 7 of the 9 keys?", "Lakes of Finland by depth, 1 2 and 3 m or so"]
    docs = ["He wrote What is 12 plus 15 times 3? on it", "now convert 5 KM to miles and 3 kg to pounds please",
            "all prime numbers under 9 are", "by serendipity only", "Then ADA ASKS BOB, CY, 3 4, DEE: WHO OF THEM HAS 7 OF THE 9 KEYS?",
            "a list of lakes of Finland by depth, 1 2 and 3 m or so", "Convert 8 miles to miles and 2 lb to pounds",
            "What is 12 plus 15 times", "prime numbers under 11", "serendipitous", "lakes of Finland by depth, 1 2 and 3 m or"]
    frames = [spark.createDataFrame(list(enumerate(x)), f"{c} long, text string") for c, x in (("item_id", items), ("doc_id", docs))]
    found = {(r.key.id, r.item_id): r for r in td.find(frames[1], frames[0]).collect()}
    assert set(found) == {(i, i) for i in range(6)} | {(6, 1)}
    assert found[(6, 1)].n_changed == 4 and all(found[(i, i)].n_changed == 0 for i in range(6))


def test_short_items_are_found_with_other_numbers(spark):
    items = ["What is 12 plus 15 times 3?", "How many km are 7 miles?", "12 + 7 = 19", "Is 9 prime"]
    docs = ["first: what is 9 plus 4 times 2? think", "what is 9 plus 4 minus 2", "what is nine plus 4 times 2", "what was 9 plus 4 times 2",
            "what is 9 plus 4 times", "how many km are 30 miles", "13 + 8 = 21", "is 11 prime", "how many miles are 30 km"]
    frames = [spark.createDataFrame(list(enumerate(x)), f"{c} long, text string") for c, x in (("item_id", items), ("doc_id", docs))]
    found = {(r.key.id, r.item_id): r.n_changed for r in td.find(frames[1], frames[0]).collect()}
    assert found == {(0, 0): 3, (5, 1): 1}


def test_query_equals_windows_of_words(spark):
    got = {(r.doc_id, r.item_id) for r in QUERIES["op7_template_decontam"](spark, SF001).collect()}
    docs = pd.read_parquet(f"{SF001}/documents.parquet")
    items = pd.read_parquet(f"{SF001}/benchmark.parquet")
    windows = {}
    for i, t in zip(items.item_id, items.text):
        w = WORD.findall(t)
        for j in range(len(w) - 12):
            windows.setdefault(tuple(w[j:j + 13]), set()).add(i)
    want = set()
    for i, t in zip(docs.doc_id, docs.text):
        w = WORD.findall(t or "")
        for j in range(len(w) - 12):
            want |= {(i, k) for k in windows.get(tuple(w[j:j + 13]), ())}
    assert want and want <= got and len(got) <= len(want) + 1


def test_leaks_in_odd_input(spark, benchmark, odd_docs, no_docs):
    kept = td.drop_contaminated(odd_docs, benchmark)
    assert kept.columns == odd_docs.columns and kept.count() == 10
    assert td.find(no_docs, benchmark).count() == 0 and td.drop_contaminated(no_docs, benchmark).count() == 0
    assert td.find(odd_docs, benchmark.where("item_id > 2")).count() == 0
    twice = spark.createDataFrame([(None, ITEM), (None, ITEM), (None, "clean text of some words")], "doc_id long, text string")
    assert [r.text for r in td.drop_contaminated(twice, benchmark).collect()] == ["clean text of some words"]
