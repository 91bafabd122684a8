"""License scan by template markup.

A template is licence wording with optional and replaceable regions:
``<<opt>>...<<end>>`` may be left out as a whole (and may be nested), ``<<var:n>>`` stands for up to
``n`` words of any kind. Templates are compiled to automata over words (lower-cased runs of letters
and digits), and a text is accepted where the mandatory wording occurs word for word. Short phrases
are found as consecutive words besides.

Scale: one pass over the texts, nothing is shuffled or gathered. Words are hashed in numpy; automata
run in Python, but only from places where a template's first words stand.

Defined cases: a null or empty text has no words, no places, empty labels and score 0; repeated rows
are scanned each; a very long text is scanned in one go, and each place where a template may begin costs
at most the template's length; of stretches from one place the longest counts (ties of templates: all); an empty table gives an empty result. Columns that the operator adds replace
columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ticketlens.llm import textutil as tu

#: Phrases and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"),
           ("mit license", "mit"))

#: Wording of public licences and notices, with markup. A template starts with
#: mandatory words.
TEMPLATES = (
    ("notice-gpl", """licensed under the <<opt>>terms of the <<end>>GNU <<opt>>Lesser <<end>><<opt>>Affero <<end>>General
     Public License <<opt>>as published by the Free Software Foundation <<end>>version <<var:2>>"""),
    ("notice-apache-2.0", """licensed under the Apache License Version 2.0 <<opt>>the License <<end>><<opt>>you may not
     use this file except in compliance with the License You may obtain a copy of the License at
     http www apache org licenses LICENSE 2.0 <<end>><<opt>>Unless required by applicable law or agreed to in writing
     software distributed under the License is distributed on an AS IS BASIS WITHOUT WARRANTIES OR CONDITIONS OF ANY
     KIND either express or implied See the License for the specific language governing permissions and limitations
     under the License<<end>>"""),
    ("notice-cc", """licensed under <<opt>>a <<end>><<opt>>the <<end>>CC BY <<opt>>NC <<end>><<opt>>SA <<end>><<opt>>ND <<end>><<var:2>>"""),
    ("notice-cc", """licensed under a Creative Commons Attribution <<opt>>NonCommercial <<end>><<opt>>ShareAlike <<end>>
     <<opt>>NoDerivatives <<end>><<var:2>> <<opt>>International <<end>>License"""),
    ("notice-mit", "released under the <<opt>>terms of the <<end>>MIT License"),
    ("text-mit", """Permission is hereby granted free of charge to any person obtaining a copy of this software and
     associated documentation files the Software to deal in the Software without restriction including without
     limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the Software
     and to permit persons to whom the Software is furnished to do so subject to the following conditions
     The above copyright notice and this permission notice <<opt>>including the next paragraph <<end>>shall be included
     in all copies or substantial portions of the Software THE SOFTWARE IS PROVIDED AS IS WITHOUT WARRANTY OF ANY
     KIND EXPRESS OR IMPLIED INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY FITNESS FOR A PARTICULAR
     PURPOSE AND NONINFRINGEMENT IN NO EVENT SHALL THE <<var:8>> BE LIABLE FOR ANY CLAIM DAMAGES OR OTHER LIABILITY
     WHETHER IN AN ACTION OF CONTRACT TORT OR OTHERWISE ARISING FROM OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE
     OR OTHER DEALINGS IN THE SOFTWARE"""),
    ("text-isc", """Permission to use copy modify and <<opt>>or <<end>>distribute this software for any purpose with or
     without fee is hereby granted provided that the above copyright notice and this permission notice appear in all
     copies THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
     ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL DIRECT
     INDIRECT OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE DATA OR PROFITS WHETHER IN AN
     ACTION OF CONTRACT NEGLIGENCE OR OTHER TORTIOUS ACTION ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
     THIS SOFTWARE"""),
    ("text-bsd", """Redistribution and use in source and binary forms with or without modification are permitted provided
     that the following conditions are met <<var:1>> Redistributions of source code must retain the above copyright
     notice this list of conditions and the following disclaimer <<var:1>> Redistributions in binary form must reproduce
     the above copyright notice this list of conditions and the following disclaimer in the documentation and or other
     materials provided with the distribution <<opt>><<var:1>> Neither the name of <<var:10>> nor the names of its
     contributors may be used to endorse or promote products derived from this software without specific prior written
     permission <<end>>THIS SOFTWARE IS PROVIDED BY THE <<var:8>> AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES INCLUDING BUT
     NOT LIMITED TO THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED IN NO
     EVENT SHALL THE <<var:8>> BE LIABLE FOR ANY DIRECT INDIRECT INCIDENTAL SPECIAL EXEMPLARY OR CONSEQUENTIAL DAMAGES
     INCLUDING BUT NOT LIMITED TO PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES LOSS OF USE DATA OR PROFITS OR BUSINESS
     INTERRUPTION HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY WHETHER IN CONTRACT STRICT LIABILITY OR TORT INCLUDING
     NEGLIGENCE OR OTHERWISE ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
     DAMAGE"""),
    ("text-zlib", """This software is provided as is without any express or implied warranty In no event will the authors
     be held liable for any damages arising from the use of this software Permission is granted to anyone to use this
     software for any purpose including commercial applications and to alter it and redistribute it freely subject to the
     following restrictions <<var:1>> The origin of this software must not be misrepresented you must not claim that you
     wrote the original software If you use this software in a product an acknowledgment in the product documentation
     would be appreciated but is not required <<var:1>> Altered source versions must be plainly marked as such and must not
     be misrepresented as being the original software <<var:1>> This notice may not be removed or altered from any source
     distribution"""),
    ("text-unlicense", """This is free and unencumbered software released into the public domain Anyone is free to
     copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary
     for any purpose commercial or non commercial and by any means"""),
    ("notice-gpl", """This program is free software you can redistribute it and or modify it under the terms of the GNU
     General Public License as published by the Free Software Foundation either version <<var:2>> of the License or at
     your option any later version"""),
)

_MARKUP = re.compile(r"<<(opt|end|var:(\d+))>>|([0-9A-Za-z\x80-\U0010ffff]+)")


@dataclass
class Automaton:
    """States 0..n with edges on one word, on any word, or on none; the last state accepts."""

    label: str
    on_word: list[dict[int, set[int]]] = field(default_factory=list)
    on_any: list[set[int]] = field(default_factory=list)
    free: list[set[int]] = field(default_factory=list)
    lead: list[int] = field(default_factory=list)

    @property
    def longest(self) -> int:
        """No match has more words than there are states."""
        return len(self.free)

    def _state(self) -> int:
        for table, kind in ((self.on_word, dict), (self.on_any, set), (self.free, set)):
            table.append(kind())
        return len(self.free) - 1

    def closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for t in self.free[todo.pop()] - states:
                states.add(t)
                todo.append(t)
        return states

    def run(self, words: list[int], start: int) -> int:
        """End of the longest accepted stretch from ``start``, or -1."""
        states, end, last = self.closure({0}), -1, len(self.free) - 1
        for at in range(start, len(words) + 1):
            if last in states:
                end = at
            if at == len(words) or not states:
                break
            word = words[at]
            step: set[int] = set()
            for s in states:
                step |= self.on_word[s].get(word, set()) | self.on_any[s]
            states = self.closure(step)
        return end


def compile_template(label: str, text: str) -> Automaton:
    """The automaton of a template; ``lead`` holds the mandatory words it starts with."""
    out = Automaton(label)
    at, opened, leading = out._state(), [], True
    for kind, most, word in _MARKUP.findall(text):
        if word:
            h, to = tu.word_hash(word), out._state()
            out.on_word[at].setdefault(h, set()).add(to)
            if leading and len(out.lead) < 3:
                out.lead.append(h)
            at = to
        elif kind == "opt":
            opened.append(at)
            leading = False
        elif kind == "end":
            to = out._state()
            out.free[at].add(to)
            out.free[opened.pop()].add(to)
            at = to
        else:
            leading, first = False, at
            ends = [first]
            for _ in range(int(most)):
                to = out._state()
                out.on_any[at].add(to)
                ends.append(to)
                at = to
            to = out._state()
            for e in ends:
                out.free[e].add(to)
            at = to
    if opened or not out.lead:
        raise ValueError(f"template {label}: unclosed region, or no mandatory words at its start")
    return out


def _places(h: np.ndarray, of: np.ndarray, phrase: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Word indices where the phrase stands within one text, and the texts' indices."""
    at = np.flatnonzero(h == np.uint64(phrase[0]))
    at = at[at + len(phrase) <= len(h)]
    for j, p in enumerate(phrase[1:], 1):
        at = at[h[at + j] == np.uint64(p)]
    text = np.searchsorted(of, at, "right") - 1
    inside = at + len(phrase) <= of[text + 1]
    return at[inside], text[inside]


ADDED = {"n_words": T.LongType(), "n_base": T.LongType(), "first_word": T.LongType(), "last_word": T.LongType(),
         "base_labels": T.StringType(), "labels": T.StringType(), "score": T.DoubleType(),
         "spans": T.ArrayType(T.StructType([T.StructField("label", T.StringType()),
                                            T.StructField("first_word", T.LongType()),
                                            T.StructField("n_words", T.LongType())]))}


def scan(docs: DataFrame, text_col: str = "text", phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """``docs`` without its text but with the phrases' places, the labels of phrases and templates,
    the templates' spans, and as score the share of words inside phrases or accepted templates."""
    kept = [c for c in docs.columns if c.lower() not in ADDED and c.lower() != text_col.lower()]
    schema = T.StructType([*(docs.schema[c] for c in kept), *(T.StructField(k, v) for k, v in ADDED.items())])
    wanted = [([tu.word_hash(w) for w in text.split()], label) for text, label in phrases]
    automata = [compile_template(label, text) for label, text in templates]
    span_type = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())]))

    def look(buf: np.ndarray, offsets: np.ndarray) -> dict[str, list]:
        h, _, of = tu.words(buf, offsets, tu.NOT_ALNUM, lower=True)
        n = len(offsets) - 1
        hits: dict[int, list[tuple[int, str, int]]] = {}
        spans: dict[int, list[tuple[int, str, int]]] = {}
        for phrase, label in wanted:
            for at, text in zip(*(x.tolist() for x in _places(h, of, phrase))):
                hits.setdefault(text, []).append((at - int(of[text]), label, len(phrase)))
        for a in automata:
            for at, text in zip(*(x.tolist() for x in _places(h, of, a.lead))):
                end = a.run(h[at:min(int(of[text + 1]), at + a.longest)].tolist(), 0)
                if end > 0:
                    spans.setdefault(text, []).append((at - int(of[text]), a.label, end))
        out: dict[str, list] = {k: [] for k in ADDED}
        for i in range(n):
            size, found, whole = int(of[i + 1] - of[i]), hits.get(i, ()), sorted(spans.get(i, ()))
            covered = {w for at, _, k in (*found, *whole) for w in range(at, at + k)}
            base = {label for _, label, _ in found}
            row = (size, len(found), min((x[0] for x in found), default=None),
                   max((x[0] for x in found), default=None), ",".join(sorted(base)),
                   ",".join(sorted(base | {x[1] for x in whole})), len(covered) / max(size, 1),
                   [{"label": x[1], "first_word": x[0], "n_words": x[2]} for x in whole])
            for k, v in zip(ADDED, row):
                out[k].append(v)
        return out

    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), span_type]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = tu.text_buffer(b[text_col])
            for lo, hi in tu.slices(offsets):
                found = look(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays(
                    [*(b[c].slice(lo, hi - lo) for c in kept),
                     *(pa.array(found[k], t) for k, t in zip(ADDED, types))], schema.names)

    return docs.select(*kept, text_col).mapInArrow(run, schema)
