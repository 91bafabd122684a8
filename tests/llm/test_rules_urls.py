import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from ticketlens.llm import adaptive_rules as ar
from ticketlens.llm import url_reputation as ur
from ticketlens.llm.queries import ORACLES, QUERIES
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _base(t):
    t = t or ""
    w = WORD.findall(t)
    n = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if n[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_base_counts_of_random_texts(spark):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(["a ", "b ", "cc ", "\n", "#", "é ", "\t", "a b a b c "]) for _ in range(rnd.randrange(120)))
             for _ in range(300)] + [None, "", "a a a a a a", "a b c d e a b c d e"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in ar.base_measures(docs).collect():
        want = _base(texts[r.doc_id])
        assert tuple(r[c] for c in NAMES) == want, texts[r.doc_id]
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def test_verdicts_follow_each_groups_quartiles(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(900):  # two languages with words of different lengths, one small source
        lang, source = ("en", "s1") if i % 2 else ("xx", "s2" if i % 20 else "tiny")
        size = 4 if lang == "en" else 9
        words = ["".join(rnd.choices("abcdefgh", k=max(1, size + rnd.randrange(-2, 3)))) for _ in range(60)]
        rows.append((i, " ".join(words), lang, source))
    rows.append((1000, " ".join("".join(rnd.choices("abcdefgh", k=9)) for _ in range(60)), "en", "s1"))
    rows.append((1001, " ".join(rnd.choice("abcdefgh") * 4 + "%%%" for _ in range(60)), "en", "s1"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r for r in ar.judge(docs).collect()}
    assert {i for i, r in out.items() if not r.kept} == {1000, 1001}
    assert out[1000].broken == ["word_length"] and "symbol_share" in out[1001].broken
    t = {(r.t_lang, r.t_source): r.t for r in ar.thresholds(ar._with_shares(ar.base_measures(docs))).collect()}
    lengths = [len("".join(x[1].split())) / 60 for x in rows if x[2] == "en"]
    low, high = np.quantile(lengths, [0.25, 0.75], method="inverted_cdf")
    assert t[("en", "s1")].word_length == pytest.approx([low, high], abs=0.02)
    lengths = [len("".join(x[1].split())) / 60 for x in rows if x[2] == "xx"]
    low, high = np.quantile(lengths, [0.25, 0.75], method="inverted_cdf")
    assert t[("xx", "tiny")].word_length == pytest.approx([low, high], abs=0.02)  # too small: its language's


def test_each_measure_alone_rejects(spark):
    rnd = random.Random(3)

    def words(n, size=5):
        return ["".join(rnd.choices("abcdefgh", k=max(1, size + rnd.randrange(-2, 3)))) for _ in range(n)]
    rows = [(i, "\n".join(" ".join(words(3)) for _ in range(40)), "en", "s") for i in range(200)]
    lines = [" ".join(words(3)) for _ in range(18)]
    odd = {"word_length": " ".join(words(120, 12)), "symbol_share": " ".join(w + "%" * (i % 2) for i, w in enumerate(words(120))),
           # nearly half of the lines are copies of a short one; 12 % of the words lie in a passage that comes twice
           "dup_line_share": "\n".join(f"{x}\nab cd" if i % 2 else f"{x} {' '.join(words(2))}\nab cd" for i, x in enumerate(lines)),
           "repeat_share": " ".join((p := words(7)) + words(53) + p + words(53))}
    rows += [(1000 + k, t, "en", "s") for k, t in enumerate(odd.values())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r for r in ar.judge(docs).collect()}
    assert not any(r.base_failed for r in out.values()) and {i for i, r in out.items() if not r.kept} == {*range(1000, 1004)}
    assert [out[1000 + k].broken for k in range(4)] == [[m] for m in odd]


def test_rules_on_odd_input(spark, odd_docs, no_docs):
    out = ar.judge(odd_docs).collect()
    assert len(out) == 10 and sum(r.kept for r in out) == 3
    assert {r.doc_id for r in out if r.kept} == {1, None}
    assert ar.judge(no_docs).count() == 0


def test_url_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    want = con.execute(ORACLES["op6_url_reputation"])
    names = [d[0] for d in want.description]
    got = QUERIES["op6_url_reputation"](spark, SF001).select(*names).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


def test_hosts_paths_and_longest_rules(spark):
    urls = ["http://A.Example.ORG/es/1?x#y", "https://example.org/en/1", "x://org", "no scheme", None, "http://notexample.org/es/",
            "http://com/fr/", "http://b.com/de/x", "a://b://c/d", "http://x.net#/org/", "http:///en", "HTTP://ÉX.com/fr/é"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = spark.createDataFrame([("allow", "org/"), ("block", "example.org/es/"), ("block", "com/de/"), ("allow", "com/fr/")],
                                  "verdict string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in ur.judge(pages, rules).collect()}
    assert got[0] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[1] == ("example.org", "/en/1", "org/", "allow")
    assert got[2] == ("org", "", None, "allow") and got[3] == got[4] == ("", "", None, "allow")
    assert got[5] == ("notexample.org", "/es/", "org/", "allow")
    assert got[6][2:] == ("com/fr/", "allow") and got[7][2:] == ("com/de/", "block")
    assert got[8] == ("b:", "//c/d", None, "allow") and got[9] == ("x.net", "", None, "allow")
    assert got[10] == ("", "/en", None, "allow") and got[11][0] == "Éx.com"
    assert ur.judge(pages.where("page_id > 99"), rules).count() == 0


def test_reputation_shrinks_and_blocks_only_what_is_surely_bad(spark):
    rows = [(f"http://bad.example.com/{i}", True) for i in range(60)] + [("http://new.example.com/", True)]
    rows += [(f"http://h{i % 20}.good.org/{i}", False) for i in range(400)] + [("http://unseen.good.org/", None)]
    rows += [("http://www.site.co.uk/", None), ("http://10.0.0.1/", None)]
    pages = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, bad boolean")
    none = spark.createDataFrame([], "verdict string, rule string")
    from pyspark.sql import functions as F
    got = {r.host: r for r in ur.judge(pages, none, F.col("bad")).collect()}
    assert got["bad.example.com"].verdict == "block" and got["new.example.com"].bad_rate > got["unseen.good.org"].bad_rate
    assert all(r.verdict == "allow" for h, r in got.items() if h.endswith("good.org"))
    assert got["bad.example.com"].bad_rate_low <= got["bad.example.com"].bad_rate
    domain, suffix = ur.domain_and_suffix(F.col("host"))
    d = {r.host: (r.d, r.s) for r in spark.createDataFrame([(h,) for h in got], "host string")
         .select("host", domain.alias("d"), suffix.alias("s")).collect()}
    assert d["www.site.co.uk"] == ("site.co.uk", "co.uk") and d["10.0.0.1"] == ("10.0.0.1", "10.0.0.1")
    assert d["h1.good.org"] == ("good.org", "org")


def test_urls_of_odd_tables(spark):
    from pyspark.sql import functions as F
    long_path, long_host = "/a" * 60_000, "h" * 40_000 + ".org"
    urls = [f"http://x.net{long_path}", f"http://{long_host}/p", "http://x.net/1", "http://x.net/1"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns(
        {c: F.lit("own") for c in ("Host", "path", "verdict", "bad", "n", "domain", "rules", "order")})
    rules = spark.createDataFrame([("block", f"{long_host}/p")], "verdict string, rule string")
    rows = {r.page_id: r for r in ur.judge(pages.unionByName(pages.where("page_id = 3")), rules).collect()}
    out = ur.judge(pages, rules)
    assert [c.lower() for c in out.columns].count("host") == 1 and out.count() == 4 and {"bad", "n", "domain"} <= set(out.columns)
    assert rows[0].path == long_path and rows[1].host == long_host and rows[1].verdict == "block"
    assert rows[2].verdict == rows[3].verdict == "allow" and rows[2].n == "own"
