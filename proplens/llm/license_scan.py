"""License scan by template-markup matching.

A template is a license's wording with markup: ``<<opt>> ... <<end>>`` encloses words that may be missing, ``<<any:N>>``
stands for up to N replaceable words (names, years).  Each template is compiled to an automaton over words, which accepts
a stretch of text whose mandatory wording stands there exactly, in order.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Bytes of text whose words are counted at once.
BLOCK_BYTES = 4 << 20

#: Whole wordings that must stand as their licenses state them.  Fixed values.
MIT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
    "and this permission notice <<opt>>including the next paragraph<<end>> shall be included in all copies or "
    "substantial portions of the software the software is provided as is without warranty of any kind express or implied "
    "including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement "
    "in no event shall the <<any:6>> be liable for any claim damages or other liability whether in an action of contract "
    "tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software")
BSD_CONDITIONS = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met <<any:1>> redistributions of source code must retain the above copyright notice this "
    "list of conditions and the following disclaimer <<any:1>> redistributions in binary form must reproduce the above "
    "copyright notice this list of conditions and the following disclaimer in the documentation and or other materials "
    "provided with the distribution")
BSD_THIRD = (
    "<<any:1>> neither the name of <<any:12>> nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission")
BSD_DISCLAIMER = (
    "this software is provided by <<any:8>> as is and any express or implied warranties including but not limited to the "
    "implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall "
    "<<any:8>> be liable for any direct indirect incidental special exemplary or consequential damages including but not "
    "limited to procurement of substitute goods or services loss of use data or profits or business interruption however "
    "caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise "
    "arising in any way out of the use of this software even if advised of the possibility of such damage")
ISC = (
    "permission to use copy modify and <<opt>>or<<end>> distribute this software for any purpose with or without fee is "
    "hereby granted provided that the above copyright notice and this permission notice appear in all copies the software "
    "is provided as is and <<any:8>> disclaims all warranties with regard to this software including all implied "
    "warranties of merchantability and fitness in no event shall <<any:8>> be liable for any special direct indirect or "
    "consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of "
    "contract negligence or other tortious action arising out of or in connection with the use or performance of this "
    "software")
APACHE_NOTICE = (
    "licensed under the apache license version 2 0 the license you may not use <<any:2>> except in compliance with the "
    "license you may obtain a copy of the license at <<any:1>> www apache org licenses license 2 0 unless required by "
    "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
    "without warranties or conditions of any kind either express or implied see the license for the specific language "
    "governing permissions and limitations under the license")
MPL_NOTICE = (
    "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
    "distributed with this file you can obtain one at <<any:1>> mozilla org mpl 2 0")


def gnu_notice(kind: str, version: str) -> str:
    """The notice of a GNU license, whose name and version alone differ."""
    name = f"gnu {kind}general public license"
    return (f"free software you can redistribute it and or modify it under the terms of the {name} as published by the "
            f"free software foundation <<opt>>either<<end>> version {version} of the license <<opt>>or at your option any "
            "later version<<end>> <<any:3>> is distributed in the hope that it will be useful but without any warranty "
            "without even the implied warranty of merchantability or fitness for a particular purpose see the "
            f"{name} for more details <<opt>>you should have received a copy of the {name} along with <<any:3>> if not "
            "see <<any:1>> www gnu org licenses<<end>>")


def gnu_line(kind: str, version: str) -> str:
    return (f"<<opt>>this <<any:3>> is<<end>> licensed under the gnu {kind}general public license <<opt>>as published by "
            f"the free software foundation<<end>> <<opt>>either<<end>> version {version} <<opt>>of the license<<end>> "
            "<<opt>>or <<opt>>at your option<<end>> any later version<<end>>")


def commons_line(short: str, words: str) -> list[str]:
    return [f"licensed under <<opt>>a<<end>> <<opt>>the<<end>> cc {short} 4 0",
            f"<<opt>>licensed under <<opt>>a<<end>> <<opt>>the<<end>><<end>> creative commons {words} 4 0 international "
            "<<opt>>public<<end>> license"]


#: Label, words of a GNU license's kind, version.
GNU = (("gpl-2.0", "", "2"), ("gpl-3.0", "", "3"), ("lgpl-2.1", "lesser ", "2 1"), ("lgpl-3.0", "lesser ", "3"),
       ("agpl-3.0", "affero ", "3"))
#: Label, short name, words of a Creative Commons license.
COMMONS = (("cc-by-4.0", "by", "attribution"), ("cc-by-sa-4.0", "by sa", "attribution sharealike"),
           ("cc-by-nc-4.0", "by nc", "attribution noncommercial"))
#: Label and wording: whole licenses, whole notices, and the one-line statements that name a license and its version.
TEMPLATES = (
    ("mit", MIT), ("isc", ISC), ("bsd-2-clause", f"{BSD_CONDITIONS} {BSD_DISCLAIMER}"),
    ("bsd-3-clause", f"{BSD_CONDITIONS} {BSD_THIRD} {BSD_DISCLAIMER}"), ("apache-2.0", APACHE_NOTICE),
    ("mpl-2.0", MPL_NOTICE),
    ("mit", "released under the <<opt>>terms of the<<end>> mit license"),
    ("apache-2.0", "<<opt>>this <<any:3>> is<<end>> licensed under the apache license <<opt>>version<<end>> 2 0"),
    *[(label, wording(kind, version)) for label, kind, version in GNU for wording in (gnu_notice, gnu_line)],
    *[(label, wording) for label, short, words in COMMONS for wording in commons_line(short, words)],
)


class Automaton:
    """Words lead from state to state; ``skips`` are the states reached without a word, ``anys`` those by any word."""

    def __init__(self, wording: str):
        self.words: list[dict[bytes, int]] = [{}]
        self.skips: list[list[int]] = [[]]
        self.anys: list[int | None] = [None]
        state, opened = 0, []
        mandatory: set[bytes] = set()
        for mark, word in re.findall(r"<<(opt|end|any:\d+)>>|([^<\s]+)", wording):
            if mark == "opt":
                opened.append(state)
            elif mark == "end":
                if not opened:
                    raise ValueError(f"<<end>> without <<opt>>: {wording}")
                self.skips[opened.pop()].append(state)
            elif mark:
                for _ in range(int(mark[4:])):
                    begin, state = state, self._state()
                    self.anys[begin] = state
                    self.skips[begin].append(state)
            else:
                begin, state = state, self._state()
                self.words[begin][word.encode()] = state
                if not opened:
                    mandatory.add(word.encode())
        if opened or not mandatory:
            raise ValueError(f"open <<opt>>, or no mandatory word: {wording}")
        self.last = state
        self.mandatory = mandatory
        self.starts = {w for s in self._closed({0}) for w in self.words[s]}
        if any(self.anys[s] is not None for s in self._closed({0})) or self.last in self._closed({0}):
            raise ValueError(f"a template begins with a word of its own: {wording}")

    def _state(self) -> int:
        self.words.append({})
        self.skips.append([])
        self.anys.append(None)
        return len(self.words) - 1

    def _closed(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for s in self.skips[todo.pop()]:
                if s not in out:
                    out.add(s)
                    todo.append(s)
        return out

    def longest(self, words: list[bytes], begin: int) -> int | None:
        """End of the longest accepted stretch from ``begin``."""
        states, end = self._closed({0}), None
        for i in range(begin, len(words)):
            step = {self.words[s][words[i]] for s in states if words[i] in self.words[s]}
            step |= {self.anys[s] for s in states if self.anys[s] is not None}
            if not step:
                break
            states = self._closed(step)
            if self.last in states:
                end = i + 1
        return end


def find_phrases(words: list[bytes], phrases: dict[bytes, list[tuple[list[bytes], str]]]) -> list[tuple[int, int, str]]:
    """(begin, end, label) of every place where a phrase stands; phrases by their first word."""
    return [(i, i + len(p), label) for i, w in enumerate(words) if w in phrases
            for p, label in phrases[w] if words[i:i + len(p)] == p]


def find_templates(words: list[bytes], automata: list[tuple[str, Automaton]]) -> list[tuple[int, int, str]]:
    """(begin, end, label) of accepted stretches, the longest from each place where one begins."""
    have, starts = set(words), defaultdict(list)
    for label, a in automata:
        if a.mandatory <= have:
            for w in a.starts:
                starts[w].append((label, a))
    return [(i, end, label) for i, w in enumerate(words) if w in starts
            for label, a in starts[w] if (end := a.longest(words, i)) is not None]


def word_counts(text: pa.Array) -> np.ndarray:
    """Plain words of each text, counted on the bytes of all."""
    raw = text.cast(pa.binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset:raw.offset + len(raw) + 1].astype(np.int64)
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    word = _IS_WORD[data]
    begins = word & ~np.r_[False, word[:-1]] if len(data) else word
    inner = offsets[:-1][offsets[:-1] < len(data)]
    begins[inner] = word[inner]
    return np.diff(np.r_[0, np.cumsum(begins)][offsets])


def scan_licenses(docs: DataFrame, phrases: tuple = (("mit license", "mit"), ("apache license", "apache"),
                                                     ("general public license", "gpl")),
                  templates: tuple = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Base counts all places of the phrases, each place of each phrase once; first and last are the smallest and largest
    start.  Spans are the stretches that templates accept, with their label, and labels names both kinds.  Score is the
    share of words that stand in a phrase or a span.  Null and empty texts have no words, no places and score 0.
    Whole texts are read, and a row is judged by itself, so ties and repeats don't matter.  An empty table gives no rows.
    """
    by_first: dict[bytes, list] = defaultdict(list)
    for phrase, label in phrases:
        by_first[phrase.encode().split()[0]].append((phrase.encode().split(), label))
    automata = [(label, Automaton(wording)) for label, wording in templates]
    # A text without all words of some phrase, or some template's mandatory ones, has nothing to find.
    needs = [set(p.encode().split()) for p, _ in phrases] + [a.mandatory for _, a in automata]
    longest = {max(sorted(n), key=len) for n in needs}

    def judge(text: str | None, n: int) -> dict:
        found = {"n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0,
                 "spans": []}
        low = text.encode().lower() if n else b""
        if not any(w in low for w in longest):
            return found
        words = _WORD.findall(low)
        base, spans = find_phrases(words, by_first), find_templates(words, automata)
        if base:
            found |= {"n_base": len(base), "first_word": min(b[0] for b in base), "last_word": max(b[0] for b in base)}
        found["base_labels"] = ",".join(sorted({b[2] for b in base}))
        found["labels"] = ",".join(sorted({b[2] for b in base + spans}))
        inside = np.zeros(len(words) + 1, np.int64)
        for begin, end, _ in base + spans:
            inside[begin] += 1
            inside[end] -= 1
        found["score"] = float((np.cumsum(inside[:-1]) > 0).mean())
        found["spans"] = [{"begin": b, "end": e, "label": x} for b, e, x in sorted(spans)]
        return found

    kind = pa.struct([("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                      ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                      ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("label", pa.string())])))])

    def run(batches):
        for batch in batches:
            size = np.cumsum(pa.compute.binary_length(batch["text"].fill_null("")).to_numpy(), dtype=np.int64)
            begin = 0
            while begin < batch.num_rows:
                stop = max(begin + 1, int(np.searchsorted(size, (size[begin - 1] if begin else 0) + BLOCK_BYTES, "right")))
                b = batch.slice(begin, stop - begin)
                begin = stop
                n = word_counts(b["text"].fill_null(""))
                found = pa.array([judge(t.as_py(), k) for t, k in zip(b["text"], n)], kind)
                yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(n), *found.flatten()],
                                                 ["doc_id", "n_words", *(f.name for f in kind)])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, n_base long, first_word long, "
                                "last_word long, base_labels string, labels string, score double, "
                                "spans array<struct<begin:long,end:long,label:string>>")
