"""Language-model scoring with a small causal self-attention model trained in numpy.

Texts are ids of a public subword vocabulary. Ids fall into ``CLASSES`` classes (frequent ids are
classes of their own, the rest share a few by kind and frequency); the model predicts the next id's
class by one attention head over the window plus a table of the last class, and an id within its
class by its frequency after the last class. Texts are scored in windows of ``SPAN`` ids that overlap by ``SPAN - STRIDE``:
each id (and the end) is scored once, the later windows' first ids only being context, with all
windows of a batch masked and multiplied together.

Word counts of the corpus come along as a base score: add-one unigram log-probabilities.

Scale: one pass counts words and ids of all learning texts and cuts each whole text into training
windows, so that every id is predicted once a round, however long its text is. Training is local:
every partition of windows trains its own copy of some thousand weights, copies are averaged, and
that repeats. A second pass scores all texts. Texts are never shuffled. A word's count reaches the
documents in one of two exact ways: the most frequent words (at most ``HOT_WORDS``, found from a
histogram) as a sorted array on every worker, all others by a join of the documents' rare words with
the counts, which has no hot keys as those are gone. Ids and weights on the driver are bounded by the
vocabulary and the model.

Defined cases: a null or empty text has only its end; repeated rows are counted and scored each;
without learning texts every count is 0 and the model is uniform over classes; an empty table gives
an empty result. Words are told by 64-bit hashes. Added columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlens.llm import textutil as tu
from ticketlens.llm.cluster import unused_prefix
from ticketlens.session import materialise

CLASSES = 128
SHARED = 16  # classes of the rarer ids
WIDTH = 16
SPAN, STRIDE = 32, 24
HOT_WORDS = 1 << 19
ROUNDS = 3
PRIOR = 20.0  # weight of an id's overall frequency against that after one class
BATCH = 64  # windows of a training step
AT_ONCE = 128  # windows scored together: their logits stay in a core's cache
TEXT_BYTES = 1 << 20  # texts whose words are told apart together
FLUSH = 1 << 22  # words or pairs of ids counted together in a task
END_WORD = 1  # the key of a text's end among word hashes
_U = np.uint64
_CAUSAL = np.tril(np.ones((SPAN, SPAN), bool))
_BACK = np.clip(np.arange(SPAN)[:, None] - np.arange(SPAN)[None, :], 0, None)


@dataclass
class Vocabulary:
    """Class of each id, the place of each id among those that were seen (unseen ids share one place
    per class), and log10 probability of a place's ids within their class after each class."""

    of: np.ndarray
    place: np.ndarray
    inside: np.ndarray

    @staticmethod
    def classes(counts: np.ndarray, led: np.ndarray) -> np.ndarray:
        """``led`` marks ids that start with a blank."""
        n = len(counts)
        order = np.lexsort((np.arange(n), -counts))
        own = min(CLASSES - SHARED, n)
        of = np.empty(n, np.int64)
        of[order[:own]] = np.arange(own)
        bands = SHARED // 2
        for k, kind in enumerate((led, ~led)):
            rest = order[own:][kind[order[own:]]]
            mass = np.cumsum(counts[rest] + 0.5)
            band = np.minimum((mass - 0.5) / max(mass[-1] if len(mass) else 1.0, 1.0) * bands, bands - 1).astype(int)
            of[rest] = own + k * bands + band
        return of

    @staticmethod
    def fit(of: np.ndarray, counts: np.ndarray, after: np.ndarray, ids: np.ndarray, n: np.ndarray) -> Vocabulary:
        """``n`` counts how often ``ids`` follow an id of class ``after``."""
        known = np.union1d(np.flatnonzero(counts), ids)
        place = len(known) + of  # behind the seen ids, one place per class
        place[known] = np.arange(len(known))
        share = (counts + 0.5) / np.bincount(of, counts + 0.5, CLASSES)[of]
        classes = np.concatenate((of[known], np.arange(CLASSES)))
        unseen = np.ones(CLASSES)  # classes without unseen ids: never looked up
        unseen[of[place >= len(known)]] = share[place >= len(known)]
        shares = np.concatenate((share[known], unseen))
        inside = np.empty((CLASSES, len(classes)), np.float32)
        for c in range(CLASSES):
            mine = after == c
            seen = np.bincount(place[ids[mine]], n[mine], len(classes))
            inside[c] = np.log10((seen + PRIOR * shares) / (np.bincount(classes, seen, CLASSES) + PRIOR)[classes])
        return Vocabulary(of, place, inside)


@dataclass
class Model:
    """Weights by name: ``last`` (class to logits), ``q``, ``k``, ``v`` (class to vectors), ``out`` and
    ``back`` (a score for each distance)."""

    w: dict[str, np.ndarray]

    SHAPES = (("last", (CLASSES, CLASSES)), ("q", (CLASSES, WIDTH)), ("k", (CLASSES, WIDTH)),
              ("v", (CLASSES, WIDTH)), ("out", (WIDTH, CLASSES)), ("back", (SPAN,)))

    @staticmethod
    def start(following: np.ndarray) -> Model:
        """``following`` counts how often each class follows each class; attention adds nothing yet."""
        rng = np.random.default_rng(11)
        w = {name: rng.normal(0, 0.3, shape).astype(np.float32) for name, shape in Model.SHAPES}
        share = (following.sum(0) + 1) / (following.sum(0) + 1).sum()
        table = following + 5 * share
        w["last"] = np.log(table / table.sum(1, keepdims=True)).astype(np.float32)
        w["out"] *= 0
        w["back"] *= 0
        return Model(w)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w[n].ravel() for n, _ in Model.SHAPES])

    @staticmethod
    def parts(values: np.ndarray) -> dict[str, np.ndarray]:
        w, at = {}, 0
        for name, shape in Model.SHAPES:
            size = int(np.prod(shape))
            w[name] = values[at:at + size].reshape(shape)
            at += size
        return w

    @staticmethod
    def from_flat(values: np.ndarray) -> Model:
        return Model(Model.parts(values.astype(np.float32)))

    def attend(self, c: np.ndarray, skip: int = 0) -> tuple[np.ndarray, ...]:
        """What each place of windows of classes (n, SPAN), but for the first ``skip``, gathers by
        masked attention, the unscaled attention and its sums."""
        q = (self.w["q"] * np.float32(WIDTH**-0.5)).take(c[:, skip:], 0)
        s = np.matmul(q, _columns(self.w["k"], c))
        np.minimum(s, 30, out=s)
        np.exp(s, out=s)
        s *= np.where(_CAUSAL, np.exp(np.clip(self.w["back"], -20, 20))[_BACK], 0).astype(np.float32)[skip:]
        a = np.matmul(s, _with_one(self.w["v"]).take(c, 0))  # the one gathers the sum
        return a[:, :, :-1] / a[:, :, -1:], s, a[:, :, -1:]

    def logits(self, gathered: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Logits of the next class after places (n, WIDTH) of class ``c``, 60 at most, in memory that the
        next call uses again."""
        out = np.matmul(gathered, self.w["out"], out=_room("logits", len(c)))
        out += self.w["last"].take(c, 0, out=_room("last", len(c)), mode="clip")
        # what is gathered is a mean of rows of v, so no logit is above this
        if self.w["last"].max() + (np.abs(self.w["v"]).max(0) @ np.abs(self.w["out"])).max() > 59:
            np.minimum(out, 60, out=out)
        return out

    def log10_next(self, c: np.ndarray, y: np.ndarray, skip: int) -> np.ndarray:
        """log10 probability of the class ``y`` after each place but the first ``skip``."""
        logits = self.logits(self.attend(c, skip)[0].reshape(-1, WIDTH), c[:, skip:].ravel())
        picked = logits[np.arange(len(logits)), y[:, skip:].ravel()]
        np.exp(logits, out=logits)
        total = (logits @ np.ones((CLASSES, 1), np.float32)).ravel()
        return ((picked - np.log(total)) / np.float32(np.log(10))).reshape(len(c), -1)

    def gradient(self, c: np.ndarray, y: np.ndarray, real: np.ndarray) -> dict[str, np.ndarray]:
        """Slopes of the mean loss of the ``real`` places. Places are put in the order of their classes:
        those of one class are a stretch, so what is summed by class needs no products with ones and zeros."""
        a, s, total = self.attend(c)
        order = np.argsort(c.ravel().astype(np.int16), kind="stable")
        n = np.bincount(c.ravel(), minlength=CLASSES)
        seen, ends = np.flatnonzero(n), np.cumsum(n)[n > 0]
        begin = ends - n[seen]
        a, y = a.reshape(-1, WIDTH).take(order, 0), y.ravel()[order]

        p = self.logits(a, c.ravel()[order])  # then not divided by the row's sum: ``weight`` does that
        np.exp(p, out=p)
        da = _with_one(self.w["out"].T).T @ p.T  # a row for each of the vector's places; the last one sums p
        sums = da[-1].copy()
        p.reshape(-1)[np.arange(0, p.size, CLASSES) + y] -= sums
        weight = (real.ravel()[order] / max(real.sum(), 1)).astype(np.float32) / sums
        a = np.ascontiguousarray(a.T)
        da[:-1] -= self.w["out"].take(y, 1) * sums
        da[:-1] *= weight
        np.negative((da[:-1] * a).sum(0), out=da[-1])
        da /= total.ravel()[order]

        d = np.empty((len(order), WIDTH + 1), np.float32)
        d[order] = da.T
        d = d.reshape(*c.shape, WIDTH + 1)
        ds = np.matmul(d, _columns(_with_one(self.w["v"]), c))
        ds *= s
        scale = np.float32(WIDTH**-0.5)
        parts = {"q": np.matmul(ds, self.w["k"].take(c, 0)) * scale,
                 "k": np.matmul(ds.transpose(0, 2, 1), (self.w["q"] * scale).take(c, 0)),
                 "v": np.matmul(s.transpose(0, 2, 1), d[:, :, :-1])}
        g = {n: np.zeros_like(self.w[n]) for n in ("last", *parts)}
        for n, t in parts.items():
            g[n][seen] = np.add.reduceat(t.reshape(-1, WIDTH).take(order, 0), begin, axis=0)
        for k, lo, hi in zip(seen.tolist(), begin.tolist(), ends.tolist()):
            np.dot(weight[lo:hi], p[lo:hi], out=g["last"][k])
        a *= weight
        g["out"] = a @ p
        g["back"] = np.bincount(_BACK[_CAUSAL], ds.sum(0)[_CAUSAL], SPAN).astype(np.float32)
        return g

    def train(self, windows: np.ndarray, real: np.ndarray, rate: float, seed: int) -> None:
        """One walk over windows of SPAN + 1 classes (Adam)."""
        order = np.random.default_rng(seed).permutation(len(windows))
        t = self.flat()
        self.w = Model.parts(t)  # views: a step changes all weights at once
        m, v, x = np.zeros_like(t), np.zeros_like(t), np.empty_like(t)
        steps = -(-len(order) // BATCH)
        for step in range(steps):
            of = order[step * BATCH:(step + 1) * BATCH]
            slopes = self.gradient(windows[of, :-1], windows[of, 1:], real[of, 1:])
            g = np.concatenate([slopes[n].ravel() for n, _ in Model.SHAPES])
            now = rate * (1 - 0.9 * step / steps)
            np.subtract(g, m, out=x)
            x *= np.float32(0.1)
            m += x
            g *= g
            g -= v
            g *= np.float32(0.01)
            v += g
            np.multiply(v, np.float32(1 / (1 - 0.99 ** (step + 1))), out=x)
            np.sqrt(x, out=x)
            x += np.float32(1e-7)
            np.divide(m, x, out=x)
            x *= np.float32(now / (1 - 0.9 ** (step + 1)))
            t -= x


_ROOM: dict[str, np.ndarray] = {}


def _room(name: str, rows: int) -> np.ndarray:
    """A worker's memory for logits, kept: new memory each time costs more than what is computed in it."""
    if name not in _ROOM or len(_ROOM[name]) < rows:
        _ROOM[name] = np.empty((rows, CLASSES), np.float32)
    return _ROOM[name][:rows]


def _columns(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The rows of a table for windows of classes (n, SPAN), as columns of a matrix a window."""
    return table.T.take(c, 1).transpose(1, 0, 2)


def _with_one(table: np.ndarray) -> np.ndarray:
    return np.concatenate((table, np.ones((len(table), 1), np.float32)), 1)


def _ids(vocabulary: tu.Subwords, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts, each led and closed by the end id, with the first place of each plus the end."""
    ids, n = vocabulary.encode_column(texts)
    ends = np.cumsum(n)
    ids = np.insert(ids.astype(np.int64), np.stack([ends - n, ends], 1).ravel(), end)
    return ids, np.concatenate(([0], np.cumsum(n + 2)))


def _training_windows(ids: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first id, end) of windows of at most SPAN + 1 ids, one every SPAN ids of each text: together they
    hold each id but a text's first once as the next one."""
    n = np.maximum(-(-(np.diff(of) - 1) // SPAN), 1)
    nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    begin = np.repeat(of[:-1], n) + nth * SPAN
    return begin, np.minimum(begin + SPAN + 1, np.repeat(of[1:], n))


def _learn_pass(texts: DataFrame, tokenizer_path: str) -> DataFrame:
    """Counts of words (kind 0), ids (kind 1) and neighbouring ids (kind 3), and all training
    windows of ids (kind 2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = tu.subwords(tokenizer_path)
        ids_seen = np.zeros(vocabulary.size + 1, np.int64)
        for b in batches:
            data, offsets = tu.text_buffer(b["text"])
            hashes, pairs = [np.full(len(b), END_WORD, _U)], []
            for lo, hi in tu.slices(offsets, TEXT_BYTES):
                if sum(map(len, hashes)) > FLUSH:
                    yield counted(0, hashes)
                if sum(map(len, pairs)) > FLUSH:
                    yield counted(3, pairs)
                hashes.append(tu.words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], lower=True)[0])
                ids, of = _ids(vocabulary, b["text"].slice(lo, hi - lo), vocabulary.size)
                ids_seen += np.bincount(ids, minlength=len(ids_seen))
                pair = ids[:-1] * len(ids_seen) + ids[1:]
                pairs.append(np.delete(pair, of[1:-1] - 1))  # not from one text to the next
                raw, (begin, end) = ids.astype("<u4").tobytes(), _training_windows(ids, of)
                cuts = [raw[4 * a:4 * z] for a, z in zip(begin.tolist(), end.tolist())]
                for at in range(0, len(cuts), 1 << 14):
                    parts = cuts[at:at + (1 << 14)]
                    yield rows(2, np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64), parts)
            yield counted(0, hashes)
            yield counted(3, pairs)
        seen = np.flatnonzero(ids_seen)
        yield rows(1, seen, ids_seen[seen])

    def counted(kind: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate([np.empty(0, np.int64 if kind else _U), *parts]), return_counts=True)
        parts.clear()
        return rows(kind, keys.view(np.int64), n)

    def rows(kind: int, keys: np.ndarray, n: np.ndarray, windows: list[bytes] | None = None) -> pa.RecordBatch:
        last = pa.nulls(len(keys), pa.binary()) if windows is None else pa.array(windows, pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int8)), pa.array(keys), pa.array(n), last],
                                          ["kind", "key", "n", "window"])

    return texts.mapInArrow(run, "kind tinyint, key long, n long, window binary")


def _average_round(windows: DataFrame, model: Model, of: np.ndarray, rate: float, seed: int) -> Model:
    """Every partition trains a copy on its own windows; the copies' mean, weighted by windows."""
    start = model.flat()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, seen = Model.from_flat(start), 0
        for k, b in enumerate(batches):  # a batch is some thousand windows
            if not len(b):
                continue
            data, offsets = tu.text_buffer(b["window"].cast(pa.binary()))
            real = np.arange(SPAN + 1) < (np.diff(offsets) // 4)[:, None]
            ids = np.zeros(real.shape, np.int64)
            ids[real] = np.frombuffer(data.tobytes(), "<u4")
            mine.train(of[ids], real, rate, seed + k)
            seen += len(b)
        if seen:
            values = mine.flat().astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values * seen),
                                              pa.array(np.full(len(values), seen, np.int64))], ["place", "value", "seen"])

    sums = windows.select("window").mapInArrow(run, "place int, value double, seen long").groupBy("place").agg(
        (F.sum("value") / F.sum("seen")).alias("value")).toPandas()  # one row per weight
    if not len(sums):
        return model
    values = np.empty(len(start))
    values[sums["place"].to_numpy()] = sums["value"].to_numpy()
    return Model.from_flat(values)


def _score_slice(model: Model, vocabulary: Vocabulary, ids: np.ndarray, of: np.ndarray) -> np.ndarray:
    """log10 probability of each text's ids and end. Each id is scored in one window: the first window
    of a text scores all its places, the others all but the ``SPAN - STRIDE`` that are context."""
    classes, places = vocabulary.of[ids], vocabulary.place[ids]
    n = np.diff(of) - 1  # targets: all but the leading end id
    out = np.zeros(len(n))
    later = np.maximum(0, -(-(n - SPAN) // STRIDE))
    nth = np.arange(int(later.sum())) - np.repeat(np.cumsum(later) - later, later) + 1
    groups = ((np.arange(len(n)), np.zeros(len(n), np.int64), 0),
              (np.repeat(np.arange(len(n)), later), nth * STRIDE, SPAN - STRIDE))
    # a window may reach over its text's end: nothing scored looks there, and what is there isn't scored
    tail = np.zeros(SPAN + 1, np.int64)
    now, then, which = (np.lib.stride_tricks.sliding_window_view(np.concatenate((x, tail)), SPAN)
                        for x in (classes, classes[1:], places[1:]))
    for texts, begins, skip in groups:
        for lo in range(0, len(texts), AT_ONCE):
            text, begin = texts[lo:lo + AT_ONCE], begins[lo:lo + AT_ONCE]
            at = of[text] + begin
            c = now[at]
            logs = model.log10_next(c, then[at], skip)
            logs += vocabulary.inside[c[:, skip:], which[at, skip:]]
            left = n[text] - begin
            if (left < SPAN).any():
                logs *= np.arange(skip, SPAN) < left[:, None]
            out += np.bincount(text, logs.sum(1, dtype=np.float64), len(n))
    return out


def score(docs: DataFrame, learns: Column, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` without its text but with ``n_tokens, n_known, train_tokens, base_score, score``, learnt
    from the rows for which ``learns`` is true."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = materialise(_learn_pass(docs.where(learns).select(text.alias("text")), tokenizer_path), "learn")
    counts = materialise(raw.where("kind <> 2").groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    words = counts.where("kind = 0").select("key", "n")
    # words by the magnitude of their counts: at most 64 rows
    sizes = words.groupBy(F.floor(F.log2("n")).alias("b")).agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n")).collect()
    total, distinct = sum(r["n"] for r in sizes), sum(r["v"] for r in sizes)
    least, held = 64, 0
    for r in sorted(sizes, key=lambda r: -r["b"]):
        if held + r["v"] > HOT_WORDS:
            break
        least, held = r["b"], held + r["v"]
    hot = words.where(F.col("n") >= F.lit(2.0**least)).toPandas() if held else None
    keys = np.empty(0, _U) if hot is None else hot["key"].to_numpy(np.int64).view(_U)
    order = np.argsort(keys)
    hot_keys = keys[order]
    hot_counts = np.empty(0) if hot is None else hot["n"].to_numpy(np.float64)[order]

    known_ids = counts.where("kind = 1").toPandas()  # at most one row per id of the vocabulary
    sub = tu.subwords(tokenizer_path)
    id_counts = np.zeros(sub.size + 1)
    id_counts[known_ids["key"].to_numpy(np.int64)] = known_ids["n"].to_numpy(np.float64)
    id_counts[sub.size] /= 2  # the end id leads and closes each text
    of, size = Vocabulary.classes(id_counts, np.append(sub.leads["Ġ"], False)), sub.size + 1

    def after_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b["key"].to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(of[keys // size] * size + keys % size), b["n"]], ["key", "n"])

    # at most one row per class and id
    pairs = counts.where("kind = 3").select("key", "n").mapInArrow(after_class, "key long, n long")
    pairs = pairs.groupBy("key").agg(F.sum("n").alias("n")).toPandas().sort_values("key")
    after, ids = np.divmod(pairs["key"].to_numpy(np.int64), size)
    n = pairs["n"].to_numpy(np.float64)
    vocabulary = Vocabulary.fit(of, id_counts, after, ids, n)
    following = np.zeros((CLASSES, CLASSES))
    np.add.at(following, (after, of[ids]), n)
    model = Model.start(following)
    windows = raw.where("kind = 2")
    for k in range(ROUNDS):
        model = _average_round(windows, model, of, 0.02 / (1 + k), 100 * k)

    shared = spark.sparkContext.broadcast((hot_keys, hot_counts, vocabulary, model.flat()))
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    kept = [c for c in docs.columns if c.lower() not in added and c.lower() != text_col.lower()]
    pre = unused_prefix(docs)
    fields = [*(docs.schema[c] for c in kept), T.StructField(pre + "row", T.LongType()),
              T.StructField("n_tokens", T.LongType()), T.StructField(pre + "known", T.LongType()),
              T.StructField(pre + "sum", T.DoubleType()), T.StructField("score", T.DoubleType()),
              T.StructField(pre + "rare", T.ArrayType(T.LongType()))]
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n_of, classes, flat = shared.value
        net, sub = Model.from_flat(flat), tu.subwords(tokenizer_path)
        row = TaskContext.get().partitionId() << 33
        logs = np.log10(n_of + 1)
        for b in batches:
            data, offsets = tu.text_buffer(b[pre + "text"])
            for lo, hi in tu.slices(offsets, TEXT_BYTES):
                h, _, of = tu.words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], lower=True)
                n = np.diff(of)
                ends = of[1:]  # the end is one more word of each text
                h = np.insert(h, ends, _U(END_WORD))
                of = of + np.arange(len(of))
                text = np.repeat(np.arange(hi - lo), n + 1)
                place = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
                is_hot = keys[place] == h if len(keys) else np.zeros(len(h), bool)
                sums = np.bincount(text[is_hot], logs[place[is_hot]], hi - lo).astype(np.float64)
                rare = np.concatenate(([0], np.cumsum(np.bincount(text[~is_hot], minlength=hi - lo)))).astype(np.int32)
                ids, id_of = _ids(sub, b[pre + "text"].slice(lo, hi - lo), sub.size)
                columns = [np.arange(row, row + hi - lo), n + 1, np.bincount(text[is_hot], minlength=hi - lo), sums,
                           _score_slice(net, classes, ids, id_of)]
                row += hi - lo
                yield pa.RecordBatch.from_arrays(
                    [*(b[c].slice(lo, hi - lo) for c in kept), *(pa.array(c) for c in columns),
                     pa.ListArray.from_arrays(rare, h[~is_hot].view(np.int64))], schema.names)

    rows = docs.select(*kept, text.alias(pre + "text")).mapInArrow(run, schema)
    rows = materialise(rows, "scores")
    others = words.where(F.col("n") < F.lit(2.0**least)) if held else words
    rare = rows.select(F.col(pre + "row").alias("row"), F.explode(pre + "rare").alias("key")).join(others, "key")
    rare = rare.groupBy("row").agg(F.count(F.lit(1)).alias(pre + "more_known"),
                                   F.sum(F.log10(F.col("n") + 1)).alias(pre + "more"))
    out = rows.drop(pre + "rare").join(rare.withColumnRenamed("row", pre + "row"), pre + "row", "left")
    base = (F.col(pre + "sum") + F.coalesce(pre + "more", F.lit(0.0))
            - F.col("n_tokens") * F.lit(float(np.log10(total + distinct + 1))))
    n_known = F.col(pre + "known") + F.coalesce(pre + "more_known", F.lit(0))
    return out.select(*kept, "n_tokens", n_known.alias("n_known"),
                      F.lit(int(total)).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
