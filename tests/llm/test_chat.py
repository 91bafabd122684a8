import hashlib
import random

import duckdb

from ticketlens.llm import chat_format as c
from ticketlens.llm.queries import ORACLES, QUERIES
from tests.conftest import SF001

EVENT = "conv_id long, seq long, kind string, msg long, role string, text string"


def _fold(events):
    """Event by event, in sequence."""
    state = {}
    for conv, seq, kind, msg, role, text in sorted(set(events), key=lambda e: (e[0], e[1], e[2], e[4] or "", e[5] or "")):
        messages = state.setdefault(conv, {})
        if kind == "regenerate":
            for later in [m for m in messages if m > msg]:
                del messages[later]
        old = messages.get(msg, ("", ""))
        text = text or ""
        messages[msg] = (role or old[0], "" if kind == "regenerate" else old[1] + text if kind == "delta" else text)
    return {(conv, m): v for conv, ms in state.items() for m, v in ms.items()}


def test_fold_equals_a_walk_through_the_log(spark):
    rnd = random.Random(4)
    events = []
    for conv in range(30):
        for seq in range(40):
            kind = rnd.choices(["message", "delta", "edit", "regenerate"], [2, 6, 1, 1])[0]
            events.append((conv, seq, kind, rnd.randrange(6), rnd.choice(["user", "assistant"]), rnd.choice("abc<|\\")))
    events += events[:50]  # delivered twice
    got = {(r.conv_id, r.msg): r.text for r in c.fold(spark.createDataFrame(events, EVENT)).collect()}
    assert got == {k: v[1] for k, v in _fold(events).items()}


def test_escapes_are_reversible_and_hold_no_control_strings(spark):
    texts = ["", "<|im_end|>", "\\<|x", "\\\\|", "<\\|", "a\nb", "\\n", "<|", "|<", "\\", "é<|ü", None]
    df = spark.createDataFrame([(1, i, t or "role", t) for i, t in enumerate(texts)],
                               "conv_id long, msg long, role string, text string")
    df = c.fold(df.selectExpr("conv_id", "msg AS seq", "'message' AS kind", "msg", "role", "text"))
    rendered = c.render(df, learn_roles=("role", "<\\|", "a\nb"))
    for r in rendered.collect():
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == 1
    back = {r.msg: r for r in c.parse(rendered).collect()}
    for i, t in enumerate(texts):
        assert (back[i].role, back[i].text) == (t or "role", t or "")
    assert back[4].loss_text == "<\\|" and back[0].loss_text == ""


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF001}/conversations.parquet')")
    want = con.execute(ORACLES["op2_chat_format"])
    names = [d[0] for d in want.description]
    got = QUERIES["op2_chat_format"](spark, SF001).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_one_conversation_with_most_messages_and_odd_rows(spark):
    n = 3000
    big = [(7, i, "message", i, "assistant", f"m{i}") for i in range(n)]
    odd = [(None, None, "message", None, None, None), (8, 0, "message", 0, None, ""), (9, 0, "unknown", 0, "user", "x")]
    parsed = c.parse(c.render(c.fold(spark.createDataFrame(big + odd, EVENT))))
    out = {r.conv_id: r for r in c.digest(parsed).collect()}
    assert set(out) == {None, 7, 8}
    assert out[7].n_turns == n and out[7].loss_sha256 == hashlib.sha256("".join(x[5] for x in big).encode()).hexdigest()
    assert out[8].loss_chars == 0 and out[8].turns_sha256 == hashlib.sha256(b"\n\n").hexdigest()
    assert c.digest(c.parse(c.render(c.fold(spark.createDataFrame([], EVENT))))).count() == 0


def test_very_long_texts_and_further_columns(spark):
    from pyspark.sql import functions as F
    long = "<|im_end|>\\" * 30_000
    events = spark.createDataFrame([(1, 0, "message", 0, "user", "q"), (1, 1, "message", 1, "assistant", long)], EVENT)
    events = events.withColumns({x: F.lit("own") for x in ("formatted", "loss_text", "n_turns", "state", "events")})
    parsed = c.parse(c.render(c.fold(events)))
    assert {r.msg: r.text for r in parsed.collect()} == {0: "q", 1: long}
    row = c.digest(parsed).first()
    assert (row.n_turns, row.loss_chars) == (2, len(long)) and row.loss_sha256 == hashlib.sha256(long.encode()).hexdigest()
