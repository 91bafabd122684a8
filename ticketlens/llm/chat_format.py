"""Chat formatting by event sourcing: logs of streamed messages become final, rendered messages.

An event is ``(conv_id, seq, kind, msg, role, text)``. ``msg`` names a message and orders it within
its conversation. Kinds: ``message`` and ``edit`` set the message's text, ``delta`` adds to it,
``regenerate`` empties it (deltas follow) and withdraws everything before it in all later messages of
the conversation. Any other kind is ignored. An exact repetition of an event is one event (delivered
twice).

A message is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles ``\\`` becomes
``\\\\`` and ``<|`` becomes ``<\\|``, so no text can hold a control string, and reading back is exact.
Rows are one per message with the place of its loss mask; a conversation's text is their
concatenation in order, so a conversation of any length is never one value.

Scale: events are partitioned by conversation and message, so a conversation with a third of all
events is split; only one message's events meet, and they make up one string anyway. Regenerations
are aggregated first. The sequential digests of whole conversations stream through sorted
partitions in constant memory.

Defined cases: null texts are empty, null roles empty strings; null conversations form one
conversation; null sequence numbers come first; events that tie on the sequence are taken in order
of kind, role and text; a very long text is one message's string as any other; other columns may come along under any
name; a message whose events were all withdrawn is gone; empty input, empty output.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
KINDS = ("message", "edit", "delta", "regenerate")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    parts = F.transform(F.split(role, r"\\\\"), lambda p: F.replace(  # cut at doubled backslashes
        F.replace(p, F.lit("\\|"), F.lit("|")), F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, msg, role, text)`` of event logs."""
    rows = events.where(F.col("kind").isin(*KINDS)).select(
        "conv_id", "msg", "seq", "kind", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    # a regeneration withdraws what came before it in later messages: the latest one of any earlier
    # message counts, found over one row per message of conversations that have any
    again = rows.where("kind = 'regenerate'").groupBy("conv_id").agg(F.max("seq").alias("last"))
    per_message = rows.join(again.select(F.col("conv_id").alias("c")),
                            F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")
    per_message = per_message.groupBy("conv_id", "msg").agg(
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("regenerated"))
    earlier = Window.partitionBy("conv_id").orderBy("msg").rowsBetween(Window.unboundedPreceding, -1)
    limits = per_message.select(F.col("conv_id").alias("c"), F.col("msg").alias("m"),
                                F.max("regenerated").over(earlier).alias("limit")).where("limit is not null")
    live = rows.join(limits, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("msg").eqNullSafe(F.col("m")), "left")
    live = live.where("limit is null or seq > limit")
    log = F.sort_array(F.collect_set(F.struct("seq", "kind", "role", "text")))
    whole = live.groupBy("conv_id", "msg").agg(log.alias("log"))
    places = F.transform("log", lambda e, i: F.when(e["kind"] != "delta", i).otherwise(-1))
    whole = whole.withColumn("since", F.greatest(F.array_max(places), F.lit(0)))
    kept = F.slice("log", F.col("since") + 1, F.size("log"))
    named = F.reverse(F.filter("log", lambda e: e["role"] != ""))
    role = F.coalesce(F.get(named, F.lit(0))["role"], F.lit(""))
    parts = F.transform(kept, lambda e: F.when(e["kind"] == "regenerate", F.lit("")).otherwise(e["text"]))
    return whole.select("conv_id", "msg", role.alias("role"), F.array_join(parts, "").alias("text"))


def render(messages: DataFrame, learn_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``(conv_id, msg, formatted, loss_start, loss_chars)``: a message's rendered text and the place
    (code points, from 0) of the part under the loss mask; no part (0 characters) for other roles."""
    head = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    learns = F.col("role").isin(*learn_roles)
    return messages.select("conv_id", "msg", F.concat(head, body, F.lit(END)).alias("formatted"),
                           F.length(head).cast("long").alias("loss_start"),
                           F.when(learns, F.length(body)).otherwise(0).cast("long").alias("loss_chars"))


def parse(rendered: DataFrame) -> DataFrame:
    """Roles, texts and the unescaped part under the loss mask, read back from rendered messages."""
    pattern = r"(?s)\A<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n\z"
    part = F.substr("formatted", (F.col("loss_start") + 1).cast("int"), F.col("loss_chars").cast("int"))
    return rendered.select("conv_id", "msg", _unescape_role(F.regexp_extract("formatted", pattern, 1)).alias("role"),
                           unescape(F.regexp_extract("formatted", pattern, 2)).alias("text"),
                           unescape(part).alias("loss_text"),
                           F.length("formatted").cast("long").alias("formatted_chars"))


def digest(parsed: DataFrame) -> DataFrame:
    """Counts and SHA-256 digests of each conversation, its messages in order. A digest runs through
    all of a conversation's text in sequence, so that is streamed; nothing of it is held."""
    columns = ["conv_id", "role", "text", "loss_text", "formatted_chars"]
    rows = parsed.repartition("conv_id").sortWithinPartitions("conv_id", "msg").select(*columns)
    conv = rows.schema["conv_id"].dataType.simpleString()
    schema = (f"conv_id {conv}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for b in batches:
            done = []
            for c, role, text, loss, size in zip(*(b[k].to_pylist() for k in columns)):
                if state is None or state[0] != c:
                    if state is not None:
                        done.append(state)
                    state = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[3] += len(loss)
                state[4].update(loss.encode())
                state[5] += size
            yield out(done, b)
        if state is not None:
            yield out([state], b)

    def out(states: list, like: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(c, n, t.hexdigest(), k, h.hexdigest(), f) for c, n, t, k, h, f in states]
        types = [like["conv_id"].type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    return rows.mapInArrow(run, schema)
