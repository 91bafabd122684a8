"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees on one feature at a time are boosted in a cycle over the features, so everything they
learn adds up to one lookup table per feature; then a few feature pairs get two-dimensional tables
from the residuals. Scoring is a sum of table entries (bin additions) over a batch of documents.

Scale: one pass computes the features of at most ``max_train`` labelled documents (the documented
bound of the fit; labels above it are thinned by a hash of the id), the model is fitted on the
driver from those few numbers a row, and a second pass scores every document in place. No text is
shuffled, and a model is some kilobytes.

Defined cases: a null text counts as an empty one, which has all-zero features and is scored like
any other; a very long text is one set of features as any; repeated documents are scored each, and of rows
with one labelled id the text of least hash is learnt from; several labels of one id become the larger one; a
null label or id is no label; without labels of both classes the score is the smoothed share of
good labels; an empty table gives an empty result. Added columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlens.llm import textutil as tu

FEATURES = ("log_words", "word_bytes", "symbols", "upper", "bangs", "digits", "distinct_words",
            "next_repeat", "window_repeat", "line_repeat", "short_words", "long_words", "capitals",
            "line_words", "non_ascii", "punctuation")
MAX_TRAIN = 40_000

_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True


def _bytes_in(chars: bytes) -> np.ndarray:
    table = np.zeros(256, np.int32)
    table[list(chars)] = 1
    return table


_COUNTED = {"symbols": _bytes_in(b"#*$%&|<>~^=+_@{}[]\\/"),
            "upper": _bytes_in(bytes(range(65, 91))), "bangs": _bytes_in(b"!?"),
            "digits": _bytes_in(b"0123456789"), "non_ascii": _bytes_in(bytes(range(128, 256))),
            "punctuation": _bytes_in(b".,;:")}


def features(column: pa.Array) -> np.ndarray:
    """One row of :data:`FEATURES` for each whole text."""
    data, offsets = tu.text_buffer(column)
    out = np.zeros((len(offsets) - 1, len(FEATURES)))
    for lo, hi in tu.slices(offsets):
        _features(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], out[lo:hi])
    return out


def _features(buf: np.ndarray, offsets: np.ndarray, out: np.ndarray) -> None:
    size = np.diff(offsets)
    h, start, of = tu.words(buf, offsets)
    if not len(h):
        return
    n = np.diff(of)
    some = np.maximum(n, 1)
    column = dict(zip(FEATURES, out.T))

    def per_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values)))
        return total[at[1:]] - total[at[:-1]]

    solid = per_text((~tu.SPACES)[buf].astype(np.int32), offsets)
    column["log_words"][:] = np.log1p(n)
    column["word_bytes"][:] = solid / some
    for name, table in _COUNTED.items():
        column[name][:] = per_text(table[buf], offsets) / np.maximum(solid, 1)
    edge = np.append(start, len(buf))
    length = np.diff(edge)  # up to the next word: a byte too long mostly, alike for all texts
    column["short_words"][:] = per_text((length <= 4).astype(np.int32), of) / some
    column["long_words"][:] = per_text((length >= 14).astype(np.int32), of) / some
    initial = buf[start]
    column["capitals"][:] = per_text(((initial >= 65) & (initial <= 90)).astype(np.int32), of) / some
    same = np.append(h[1:] == h[:-1], False)
    same[of[1:][of[1:] > 0] - 1] = False
    column["next_repeat"][:] = per_text(same.astype(np.int32), of) / some
    lines, _, line_of = tu.words(buf, offsets, _NEWLINE)
    column["line_words"][:] = np.log1p(n / np.maximum(np.diff(line_of), 1))
    fives = tu.windows(h, 5)
    for i in range(len(size)):
        a, b = of[i], of[i + 1]
        if b - a > 1:
            column["distinct_words"][i] = _distinct(h[a:b]) / (b - a)
        if b - a > 5:
            column["window_repeat"][i] = 1 - _distinct(fives[a:b - 4]) / (b - a - 4)
        a, b = line_of[i], line_of[i + 1]
        if b - a > 1:
            column["line_repeat"][i] = 1 - _distinct(lines[a:b]) / (b - a)


def _distinct(h: np.ndarray) -> int:
    h = np.sort(h)
    return 1 + int((h[1:] != h[:-1]).sum())


@dataclass
class Gam:
    """The fitted model: bin edges and a table per feature, tables of feature pairs, an intercept."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features: a sum of table entries."""
        total = np.full(len(x), self.intercept)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, f], "right")]
        for f, g, ef, eg, table in self.pairs:
            total += table[np.searchsorted(ef, x[:, f], "right"), np.searchsorted(eg, x[:, g], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _split(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, int]:
    """Gain and place of the best cut of a histogram of gradients and curvatures."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - g.sum() ** 2 / (h.sum() + l2)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _shallow_tree(g: np.ndarray, h: np.ndarray, l2: float) -> np.ndarray:
    """Leaf value per bin of a depth-two tree."""
    out = np.empty(len(g))
    _, cut = _split(g, h, l2)
    for lo, hi in ((0, cut), (cut, len(g))):
        if hi > lo:
            _, inner = _split(g[lo:hi], h[lo:hi], l2)
            for a, b in ((lo, lo + inner), (lo + inner, hi)):
                if b > a:
                    out[a:b] = g[a:b].sum() / (h[a:b].sum() + l2)
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 120, rate: float = 0.2, bins: int = 32,
        n_pairs: int = 6, pair_rounds: int = 40, pair_bins: int = 8, l2: float = 2.0) -> Gam:
    """Boost the tables in a cycle over features, then over the strongest pairs."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Gam(float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    model.edges = [_edges(x[:, f], bins) for f in range(x.shape[1])]
    at = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    logit = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for f, index in enumerate(at):
            size = len(model.tables[f])
            if size > 1:
                g, h = slopes()
                step = rate * _shallow_tree(np.bincount(index, g, size), np.bincount(index, h, size), l2)
                model.tables[f] += step
                logit += step[index]
    g, h = slopes()
    coarse = [_edges(x[:, f], pair_bins) for f in range(x.shape[1])]
    where = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(coarse)]
    found = []
    for f in range(x.shape[1]):
        for k in range(f + 1, x.shape[1]):
            shape = (len(coarse[f]) + 1, len(coarse[k]) + 1)
            flat = where[f] * shape[1] + where[k]
            gs, hs = (np.bincount(flat, v, shape[0] * shape[1]) for v in (g, h))
            found.append((float((gs**2 / (hs + l2)).sum()), f, k, shape, flat))
    found.sort(key=lambda v: (-v[0], v[1], v[2]))
    chosen = [(f, k, shape, flat, np.zeros(shape)) for _, f, k, shape, flat in found[:n_pairs]]
    for _ in range(pair_rounds):
        for f, k, shape, flat, table in chosen:
            g, h = slopes()
            gs, hs = (np.bincount(flat, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))
            _, cut = _split(gs.sum(1), hs.sum(1), l2)
            step = np.zeros(shape)
            for a, b in ((0, cut), (cut, shape[0])):
                if b > a:
                    step[a:b] = rate * _shallow_tree(gs[a:b].sum(0), hs[a:b].sum(0), l2)
            table += step
            logit += step.ravel()[flat]
    model.pairs = [(f, k, coarse[f], coarse[k], table) for f, k, _, _, table in chosen]
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", learn_from=None, max_train: int = MAX_TRAIN) -> Gam:
    """Fit on labelled documents. ``learn_from(id column)`` keeps ids out of training;
    ``max_train`` bounds the number of labels used (expected number, thinned by a hash)."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    marks = marks.where("id is not null and y is not null")
    if learn_from is not None:
        marks = marks.where(learn_from(F.col("id")))
    marks = marks.groupBy("id").agg(F.max("y").alias("y"))
    n = marks.count()
    parts = 1 << 30
    keep = min(parts, int(parts * max_train / max(n, 1)))
    marks = marks.where(F.pmod(F.xxhash64("id"), F.lit(parts)) < keep)
    # bounded by max_train rows of two numbers, whatever the size of the labels
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(marks), "id")
    rows = rows.withColumn("h", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    schema = T.StructType([rows.schema["id"], *T._parse_datatype_string("h long, y int, x array<double>").fields])
    # a label is learnt from one text, the one of least hash, however many rows have its id
    found = rows.select("id", "h", "text", "y").mapInArrow(_feature_rows, schema)
    rows = found.groupBy("id").agg(F.first("y").alias("y"), F.min_by("x", "h").alias("x")).select("y", "x").toArrow()
    x = np.array(rows["x"].combine_chunks().flatten()).reshape(-1, len(FEATURES))
    y = rows["y"].to_numpy().astype(float)
    order = np.lexsort([*x.T, y])  # rows arrive in any order: a fixed one gives the same model
    return fit(x[order], y[order])


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = features(b["text"])
        rows = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], x.ravel())
        yield pa.RecordBatch.from_arrays([b["id"], b["h"], b["y"], rows], ["id", "h", "y", "x"])


def score(docs: DataFrame, model: Gam, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` without its text but with the score of each row's whole text."""
    kept = [c for c in docs.columns if c.lower() not in (text_col.lower(), out_col.lower())]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(out_col, T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = pa.array(model.score(features(b[text_col])))
            yield pa.RecordBatch.from_arrays([*(b[c] for c in kept), scores], [*kept, out_col])

    return docs.select(*kept, text_col).mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Gam, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score is at least ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(model.score(features(b[text_col])) >= least))

    return docs.mapInArrow(run, docs.schema)
