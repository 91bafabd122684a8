"""Vectorised text helpers for Arrow batches: words as 64-bit hashes, word windows, subword ids.

A batch's texts are one UTF-8 buffer with offsets, so splitting and hashing words is a handful of
numpy passes over bytes instead of a Python loop over words. Every helper treats a null text as an
empty one and reads whole texts.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18  # texts handled at once, so that temporary arrays stay in a core's cache

#: Separator bytes of `[^\x20\x09-\x0D]+`.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Separator bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z (so A-Z are kept).
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

_U = np.uint64
_POWERS = np.ones(4096, _U)
with np.errstate(over="ignore"):
    for _i in range(1, len(_POWERS)):
        _POWERS[_i] = _POWERS[_i - 1] * _U(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_BYTES_LOWER = _BYTES.copy()
_BYTES_LOWER[65:91] = _BYTES[97:123]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values, so that all bits depend on all bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
        return (h ^ (h >> _U(29))) * _U(0xA0761D6478BD642F) ^ (h >> _U(17))


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``size`` bytes (a longer text stands alone)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def words(buf: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES,
          lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, byte position of each word, first word index of each text plus the end).

    The hash is a polynomial over bytes modulo 2**64 with random byte values: equal words always
    agree, and different ones disagree but for a chance of about 2**-58."""
    keep = ~separators[buf]
    first = keep.copy()
    first[1:] &= ~keep[:-1]
    begin = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begin] = keep[begin]
    start = np.flatnonzero(first)
    of_text = np.searchsorted(start, offsets)
    if not len(start):
        return np.empty(0, _U), start, of_text
    lens = np.diff(start, append=len(buf))
    place = np.arange(start[0], len(buf), dtype=np.int64) - np.repeat(start, lens)
    body = buf[start[0]:]
    value = (_BYTES_LOWER if lower else _BYTES)[body]
    value[~keep[start[0]:]] = 0
    value *= _POWERS[place & 4095]
    return mix(np.add.reduceat(value, start - start[0])), start, of_text


def word_hash(word: str, lower: bool = True) -> int:
    """The hash :func:`words` gives to one word."""
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(words(raw, np.array([0, len(raw)]), np.zeros(256, bool), lower)[0][0])


_PLACE = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                          0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD,
                          0xC4CEB9FE1A85EC53, 0xD6E8FEB86659FD93)]


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all ``size`` consecutive entries (also across texts; callers mask those)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, _U)
    out = np.zeros(n, _U)
    with np.errstate(over="ignore"):
        for j in range(size):
            out = mix(out ^ (h[j:j + n] * _PLACE[j % 8])) if j % 4 == 3 else out + h[j:j + n] * _PLACE[j % 8]
    return mix(out)


def window_starts(of_text: np.ndarray, size: int) -> np.ndarray:
    """Indices of the windows that lie within one text."""
    n = np.maximum(np.diff(of_text) - size + 1, 0)
    total = int(n.sum())
    skip = np.cumsum(n) - n
    return np.arange(total) - np.repeat(skip, n) + np.repeat(of_text[:-1], n)


#: White space other than the single blanks and newlines that chunks are cut at, as a pattern, and
#: blanks and newlines at an end or next to each other.
_ODD_SPACE = "[" + "".join(f"\\x{{{i:X}}}" for i in range(0x3001) if chr(i).isspace() and chr(i) not in " \n") + "]"
_ODD_SPACE += "|^[ \n]|[ \n][ \n]|[ \n]$"
_CACHE_ENTRIES = 400_000
_TAIL = ".,;:!?)"  # marks that are tokens of their own behind a letter, at a chunk's end
_LETTER = "[A-Za-zÀ-ÖØ-öø-ɏ]$"
_LARGE = pa.large_string()


class Subwords:
    """Ids of a public byte-level BPE vocabulary, as `tokenizers` gives them.

    A byte-level BPE never merges across the start of a single white space that follows a
    non-space, so a text is the concatenation of its blank- or newline-led chunks; nor does it merge
    the marks at a chunk's end with a letter before them. A column's chunks are dictionary-encoded by
    Arrow, so Python sees each distinct one once, and ids are dealt back by numpy. What has been
    encoded is kept for later columns in two generations (``_CACHE_ENTRIES`` each; entries met again
    move to the newer one, the older is dropped when that is full). Texts with other white space, or
    with runs of it, are encoded whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        size = self.tokenizer.get_vocab_size()
        self.size = size
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.leads = {c: np.array([x[:1] == c for x in names]) for c in ("Ġ", "Ċ")}
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: list[str], chunks: list[str], lead: str) -> None:
        """Encode new chunks, all of which start with the same white space."""
        for lo in range(0, len(chunks), 500):
            part, named = chunks[lo:lo + 500], keys[lo:lo + 500]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, "<u4")
            cut = np.flatnonzero(self.leads[lead][ids])
            if len(cut) != len(part):  # not a vocabulary of the expected kind: one by one
                self.recent.update(zip(named, self._whole(part)))
                continue
            raw, ends = ids.tobytes(), (cut * 4).tolist()
            self.recent.update((c, raw[a:b]) for c, a, b in zip(named, ends, [*ends[1:], len(raw)]))

    def _known(self, keys: list[str]) -> None:
        """See to it that ``recent`` has the ids of every key: a chunk with its newline, a chunk with
        a carriage return for no white space before it, or a chunk without its blank."""
        if len(self.recent) > _CACHE_ENTRIES:
            self.recent, self.older = {}, self.recent
        older, recent = self.older, self.recent
        missing = [c for c in keys if c not in recent]
        recent.update((c, older[c]) for c in missing if c in older)
        missing = [c for c in missing if c not in older]
        bare, lines = [c for c in missing if c[0] == "\r"], [c for c in missing if c[0] == "\n"]
        recent.update(zip(bare, self._whole([c[1:] for c in bare])))
        self._learn(lines, lines, "Ċ")
        led = [c for c in missing if c[0] not in "\r\n"]
        self._learn(led, [" " + c for c in led], "Ġ")

    def _chunk_ids(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of distinct chunks one after the other, how many ids each has)."""
        bodies = pc.utf8_rtrim(names, characters=_TAIL)
        bodies = pc.if_else(pc.match_substring_regex(bodies, _LETTER), bodies, names)
        marks = pc.subtract(pc.binary_length(names), pc.binary_length(bodies)).to_numpy(zero_copy_only=False)
        coded = pc.dictionary_encode(bodies)
        keys = _strings(coded.dictionary)
        marked = np.flatnonzero(marks)
        tails = ["\r" + x[-n:] for x, n in zip(_strings(names.take(pa.array(marked))), marks[marked].tolist())]
        kinds = {x: len(keys) + i for i, x in enumerate(dict.fromkeys(tails))}
        keys += kinds
        self._known(keys)
        parts = list(map(self.recent.__getitem__, keys))
        pool, size = np.frombuffer(b"".join(parts), "<u4"), np.array(list(map(len, parts)), np.int64) // 4
        # each chunk is its body and, if it has marks, their stretch
        at = np.insert(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), marked + 1, [kinds[x] for x in tails])
        ids, sizes = _dealt(pool, size, at)
        total = size[coded.indices.to_numpy(zero_copy_only=False)]
        total[marked] += size[[kinds[x] for x in tails]] if len(marked) else 0
        return ids, total

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, how many ids each has); a null is an empty text."""
        texts = pc.fill_null(texts.cast(_LARGE), "")
        odd = pc.match_substring_regex(texts, _ODD_SPACE)
        plain = pc.if_else(odd, "", texts)
        # the first chunk has no white space before it: a carriage return, which plain texts lack, marks it
        marked = pc.binary_join_element_wise(pa.scalar("\r", _LARGE), plain, pa.scalar("", _LARGE))
        lists = pc.split_pattern(pc.replace_substring(marked, "\n", " \n"), " ")
        coded = pc.dictionary_encode(pc.list_flatten(lists))
        pool, size = self._chunk_ids(coded.dictionary)
        at = coded.indices.to_numpy(zero_copy_only=False)
        ids, sizes = _dealt(pool, size, at)
        ends = np.append(0, np.cumsum(sizes))[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        lengths = np.diff(ends)
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if not len(whole):
            return ids, lengths
        raw = self._whole(texts.take(pa.array(whole)).to_pylist())
        pool = np.concatenate([ids, np.frombuffer(b"".join(raw), "<u4")])
        starts, sizes = ends[:-1].copy(), lengths.copy()
        sizes[whole] = [len(x) // 4 for x in raw]
        starts[whole] = len(ids) + np.cumsum(sizes[whole]) - sizes[whole]
        return pool[_ragged(starts, sizes)], sizes

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        ids, lengths = self.encode_column(pa.array(texts, pa.string()))
        raw, ends = ids.tobytes(), np.cumsum(lengths * 4).tolist()
        return [raw[e - n:e] for e, n in zip(ends, (lengths * 4).tolist())]


def _strings(column: pa.Array) -> list[str]:
    """The texts of a column without blanks in them, by one decoding of all."""
    ended = pc.binary_join_element_wise(column, pa.scalar("", _LARGE), pa.scalar(" ", _LARGE))
    data, _ = text_buffer(ended)
    return data.tobytes().decode().split(" ")[:-1]


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of stretches of ``sizes`` from ``starts`` on, one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _dealt(pool: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches ``at`` of a pool of stretches of the given sizes, one after the other."""
    starts, sizes = (np.cumsum(size) - size)[at], size[at]
    return pool[_ragged(starts, sizes)], sizes


_LOADED: dict[str, Subwords] = {}


def subwords(path: str) -> Subwords:
    """The worker's copy of a vocabulary (loaded once per Python worker)."""
    if path not in _LOADED:
        _LOADED[path] = Subwords(path)
    return _LOADED[path]
