"""Benchmark decontamination by templates.

Texts become streams of canonical words: numbers, names (capitalised inside a sentence) and units
after a number turn into typed placeholders, everything else is lower-cased. Windows of the stream
are hash-joined with the windows of the benchmark items; hits that lie on one alignment of a document
and an item are put together. The alignment counts if its windows without a changed slot hold enough
words, whatever the others say, or if every slot of the item has one value throughout the document's
passage. Names must differ where the item's do; numbers and units may get the same value, and one
number before different words is a slot for each. So a passage is found verbatim, also with single
values changed, and when its numbers, names or units were exchanged consistently.

Next to the templates, the lower-cased words as they stand are looked up the same way, whatever their
slots and capitals, so that verbatim copies are found also of short items and of those full of numbers.

Scale: documents stay where they are. Their windows meet a Bloom filter of the benchmark's windows,
of a fixed largest size (``bloom.MOST_BITS``, whatever the benchmark's size), in numpy, and only hits leave
as rows, which are then joined exactly. A passage copied into a third of all documents is a hot
window hash; the benchmark side is broadcast where it is measured small, else adaptive execution
splits the hot hash. An alignment has at most as many windows as its item.

Defined cases: null or empty texts have no windows and are clean; items of fewer than ``MATCHED`` words
must be there whole, down to one word, and are templates from ``LEAST_WORDS`` words on, ``LEAST_WHOLE`` of them
literal, whatever slots the others are; a longer item that is short of ``LEAST_WORDS`` literal words in each
window is looked for as it stands only; a very long text is cut into windows as any other; columns of any
name may come along; repeated rows are found each, alike; a null id is an id;
empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlens.llm import bloom as bl
from ticketlens.llm import textutil as tu
from ticketlens.llm.cluster import unused_prefix
from ticketlens.session import materialise

WINDOW = 8  # words of a window
LEAST_WORDS = 5  # literal words that a template's window needs, and words of the shortest template
LEAST_WHOLE = 3  # literal words that a whole short item needs as a template: its slots' kinds and order tell the rest
MATCHED = 13  # words in one alignment that make a match, or the whole item

#: Units that are placeholders when they follow a number.
UNITS = ("mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t lb lbs oz pound pounds ton tons gram "
         "grams kilogram kilograms ms s sec second seconds min minute minutes h hour hours day days week weeks month "
         "months year years ml l liter liters litre litres gallon gallons c f k celsius fahrenheit percent cent cents "
         "dollar dollars euro euros usd eur gbp w kw kwh v hz khz mhz ghz mb gb tb meter meters metre metres kilometer "
         "kilometers centimeter centimeters").split()
_U = np.uint64
NUMBER, NAME, UNIT = (_U(x) for x in (0x4E554D, 0x4E414D, 0x554E54))
PLAIN = _U(0x504C41494E)  # tells hashes of plain windows from those of templates
KINDS = 3  # the bits of a slot's value that tell its kind
OF_NUMBER, OF_UNIT, OF_NAME = 1, 2, 3
_DIGIT = np.zeros(256, np.int32)
_DIGIT[48:58] = 1
_ENDS = np.zeros(256, np.int32)
_ENDS[list(b".!?:\n\"")] = 1
_UNIT_HASHES = np.sort(np.array([tu.word_hash(u) for u in UNITS], _U))


def canonical(buf: np.ndarray, h: np.ndarray, start: np.ndarray,
              of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(canonical word, slot value or 0, its first word, first canonical word of each text plus the end)
    of lower-cased words. Neighbouring numbers, and neighbouring names, are one slot."""
    if not len(h):
        return h, h, start, of
    digits = np.concatenate(([0], np.cumsum(_DIGIT[buf])))
    ends = np.concatenate(([0], np.cumsum(_ENDS[buf])))
    last = np.append(start[1:], len(buf))
    first_of_text = np.zeros(len(h), bool)
    first_of_text[of[:-1][of[:-1] < of[1:]]] = True
    prior = np.concatenate(([0], start[:-1]))
    number = digits[last] > digits[start]  # only separators lie between a word's end and the next
    opens = first_of_text | (ends[start] > ends[prior])
    one, two = buf[start], buf[np.minimum(start + 1, len(buf) - 1)]
    capital = ((one >= 65) & (one <= 90)) | ((one == 0xC3) & (two >= 0x80) & (two <= 0x9E))
    name = capital & ~opens & ~number
    after_number = np.concatenate(([False], number[:-1])) & ~first_of_text
    place = np.minimum(np.searchsorted(_UNIT_HASHES, h), len(_UNIT_HASHES) - 1)
    unit = after_number & ~number & (_UNIT_HASHES[place] == h)
    name &= ~unit
    word = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, h)))
    slot = number | unit | name
    joins = slot & ~first_of_text & (number | name) & np.concatenate(([False], word[1:] == word[:-1]))
    keep = np.flatnonzero(~joins)
    with np.errstate(over="ignore"):
        order = np.arange(len(h)) - np.repeat(keep, np.diff(keep, append=len(h)))
        value = np.add.reduceat(h * (_U(2) * order.astype(_U) + _U(1)), keep)
    kind = np.select([number[keep], unit[keep], name[keep]], [_U(OF_NUMBER), _U(OF_UNIT), _U(OF_NAME)], _U(0))
    value = np.where(kind > 0, tu.mix(value) & ~_U(KINDS) | kind, _U(0))
    kept_of = np.searchsorted(keep, of)
    return word[keep], value, keep, kept_of


def quantities(word: np.ndarray, value: np.ndarray, of: np.ndarray) -> np.ndarray:
    """What each slot stands for (0 for literals): its value, for numbers together with the next word."""
    follows = np.append(word[1:], _U(0))
    follows[of[1:][of[1:] > 0] - 1] = 0
    with np.errstate(over="ignore"):
        both = tu.mix(value + tu.mix(follows)) & ~_U(KINDS) | _U(OF_NUMBER)
    return np.where((value & _U(KINDS)) == _U(OF_NUMBER), both, value)


def _rows(column: pa.Array, sizes, bloom: bytes | None) -> Iterator[tuple]:
    """Slices of texts as (first row, text index, plain, first word, its place among the canonical words,
    n words, size, hash, slots, what the slots stand for) of their windows of the ``sizes`` (plain, size);
    with a filter only the windows that it may hold."""
    data, offsets = tu.text_buffer(column)
    for lo, hi in tu.slices(offsets):
        buf = data[offsets[lo]:offsets[hi]]
        h, start, of = tu.words(buf, offsets[lo:hi + 1] - offsets[lo], tu.NOT_ALNUM, lower=True)
        word, value, keep, kept_of = canonical(buf, h, start, of)
        literal = np.concatenate(([0], np.cumsum(value == 0)))
        stands = quantities(word, value, kept_of)
        for plain, size in sizes:
            words, ends = (h, of) if plain else (word, kept_of)
            at = tu.window_starts(ends, size)
            if not plain:
                at = at[literal[at + size] - literal[at] >= LEAST_WHOLE]
            hashes = tu.windows(words, size)[at] ^ _U(size) if len(at) else np.empty(0, _U)
            if plain:
                hashes ^= PLAIN
            if bloom is not None:
                hit = np.flatnonzero(bl.may_hold(bloom, hashes))
                at, hashes = at[hit], hashes[hit]
            text = np.searchsorted(ends, at, "right") - 1
            inside = at[:, None] + np.arange(size)
            slots = (np.zeros(inside.shape, _U),) * 2 if plain else (value[inside], stands[inside])
            first = np.searchsorted(keep, at, "right") - 1 if plain else at
            yield lo, text, plain, at - ends[text], first - kept_of[text], (ends[1:] - ends[:-1])[text], size, hashes, *slots


_WINDOW_FIELDS = [T.StructField("hash", T.LongType()), T.StructField("plain", T.BooleanType()),
                  T.StructField("size", T.IntegerType()), T.StructField("at", T.LongType()),
                  T.StructField("first", T.LongType()), T.StructField("n_words", T.LongType()),
                  T.StructField("slots", T.ArrayType(T.LongType())), T.StructField("stands", T.ArrayType(T.LongType()))]


def _window_batch(key: pa.Array, found: tuple, names: list[str]) -> pa.RecordBatch:
    lo, text, plain, at, first, n, size, h, *slots = found
    ends = np.arange(len(h) + 1, dtype=np.int32) * size
    lists = [pa.ListArray.from_arrays(ends, x.ravel().view(np.int64)) for x in slots]
    return pa.RecordBatch.from_arrays(
        [key.take(pa.array(text + lo)), pa.array(h.view(np.int64)), pa.array(np.full(len(h), plain, bool)),
         pa.array(np.full(len(h), size, np.int32)), *(pa.array(x.astype(np.int64)) for x in (at, first, n)), *lists], names)


def _window_table(texts: DataFrame, sizes, bloom=None) -> DataFrame:
    schema = T.StructType([texts.schema["key"], *_WINDOW_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if bloom is None else bloom.value
        for b in batches:
            for found in _rows(b["text"], sizes, bits):
                if len(found[7]):
                    yield _window_batch(b["key"], found, schema.names)

    return texts.select("key", "text").mapInArrow(run, schema)


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Windows of the benchmark items, plain and as templates. An item shorter than a window is one plain
    window of its length, and one shorter than ``MATCHED``, which must be found whole, one template."""
    texts = benchmark.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sizes = [(True, k) for k in range(1, WINDOW + 1)] + [(False, k) for k in range(LEAST_WORDS, MATCHED)]
    long_item = F.col("n_words") >= F.when(F.col("plain"), WINDOW).otherwise(MATCHED)
    rows = _window_table(texts, sizes)
    literals = F.size(F.filter("slots", lambda x: x == 0))
    enough = F.col("plain") | (literals >= F.when(F.col("size") == F.col("n_words"), LEAST_WHOLE).otherwise(LEAST_WORDS))
    return materialise(rows.where(((F.col("size") == F.col("n_words")) | (long_item & (F.col("size") == WINDOW))) & enough), "items")


def document_key(id_col: Column, text_col: Column) -> Column:
    """A document's id together with a hash of its text, for rows that share an id."""
    return F.struct(id_col.alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_hash"))


def _covered(windows: Column) -> Column:
    """Words inside windows (sorted by their start), and those of the longest unbroken passage."""
    zero = F.lit(0).cast("long")
    state = F.struct(zero.alias("n"), zero.alias("upto"), zero.alias("begin"), zero.alias("longest"))

    def add(a: Column, w: Column) -> Column:
        end = (w["item_at"] + w["size"]).cast("long")  # no window ends before the one before it
        begin = F.when(w["item_at"] > a["upto"], w["item_at"]).otherwise(a["begin"])
        return F.struct((a["n"] + end - F.greatest(a["upto"], w["item_at"])).alias("n"), end.alias("upto"),
                        begin.alias("begin"), F.greatest(a["longest"], end - begin).alias("longest"))

    return F.aggregate(windows, state, add)


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document, item and alignment that match: ``key``, ``item_id``, ``first_word`` (the
    passage's place among the document's canonical words), ``n_words`` (canonical words inside matched
    windows; where the slots contradict each other or only plain windows match, the longest unbroken
    passage without a change),
    ``n_slots`` and ``n_changed`` (pairs of an item's slot and what the document fills it with, and
    how many of them differ)."""
    items = item_windows(benchmark, item_col, item_text_col)
    bloom = docs.sparkSession.sparkContext.broadcast(bl.build(items.select("hash")))
    sizes = sorted(map(tuple, items.select("plain", "size").distinct().collect()))  # at most sixteen
    texts = docs.select(document_key(F.col(id_col), F.col(text_col)).alias("key"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    hits = _window_table(texts, sizes, bloom)
    known = items.select(F.col("key").alias("item_id"), "hash", "plain", "size", F.col("at").alias("item_at"),
                         F.col("first").alias("item_first"), F.col("n_words").alias("item_words"), F.col("slots").alias("item_slots"), "stands")
    pairs = hits.select("key", "hash", "plain", "size", "at", "first", "slots").join(known, ["hash", "plain", "size"])
    zipped = F.arrays_zip(F.col("item_slots").alias("item"), F.col("slots").alias("doc"), F.col("stands").alias("stands"))
    pairs = pairs.withColumns({"filled": F.filter(zipped, lambda s: (s["item"] != 0) | (s["doc"] != 0)),
                               "same": F.col("item_slots") == F.col("slots"), "shift": F.col("at") - F.col("item_at")})
    window = F.struct("item_at", "size")
    one = pairs.groupBy("key", "item_id", "plain", "shift").agg(
        F.array_sort(F.collect_set(window)).alias("windows"),
        F.array_sort(F.collect_set(F.when(F.col("same"), window))).alias("unchanged"), F.max("item_words").alias("item_words"),
        F.min("first").alias("first_word"), F.min("item_first").alias("item_first"),
        F.array_distinct(F.flatten(F.collect_set("filled"))).alias("filled"))
    one = one.withColumns({"windows": _covered(F.col("windows")), "unchanged": _covered(F.col("unchanged"))})
    names = F.array_distinct(F.transform(F.filter("filled", lambda s: s["item"].bitwiseAND(KINDS) == OF_NAME),
                                         lambda s: F.struct(s["item"], s["doc"])))
    one_value = F.size(F.array_distinct(F.transform("filled", lambda s: s["stands"]))) == F.size(
        F.array_distinct(F.transform("filled", lambda s: F.struct(s["stands"], s["doc"]))))
    own_names = F.size(F.array_distinct(F.transform(names, lambda s: s["doc"]))) == F.size(names)
    least = F.least(F.lit(MATCHED), F.col("item_words"))
    one = one.withColumn("consistent", one_value & own_names).where(
        (F.col("consistent") & (F.col("windows.n") >= least)) | (F.col("unchanged.n") >= least))
    filled = F.array_distinct(F.transform("filled", lambda s: F.struct(s["item"].alias("item"), s["doc"].alias("doc"))))
    n_words = F.when(F.col("consistent") & ~F.col("plain"), F.col("windows.n")).otherwise(F.col("unchanged.longest"))
    one = one.withColumn("filled", filled).select(
        "key", "item_id", (F.col("first_word") - F.col("item_first")).alias("shift"),
        F.struct((~F.col("plain")).alias("template"), "first_word", n_words.alias("n_words"), F.size("filled").alias("n_slots"),
                 F.size(F.filter("filled", lambda s: s["item"] != s["doc"])).alias("n_changed")).alias("found"))
    # a passage that was found both ways shows as its template
    one = one.groupBy("key", "item_id", "shift").agg(F.max("found").alias("found"))
    return one.select("key", "item_id", *(f"found.{c}" for c in ("first_word", "n_words", "n_slots", "n_changed")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, in which no item was found."""
    found = materialise(find(docs, benchmark, id_col, text_col).select("key").distinct(), "contaminated")
    a, b = (unused_prefix(docs) + c for c in ("id", "hash"))
    found = found.select(F.col("key.id").alias(a), F.col("key.text_hash").alias(b))
    key = document_key(F.col(id_col), F.col(text_col))
    return docs.join(found, key["id"].eqNullSafe(F.col(a)) & (key["text_hash"] == F.col(b)), "left_anti")
