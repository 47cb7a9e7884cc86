"""License scans by template markup compiled into token automata.

A template is a line of words with marked regions:

- ``<<opt>> ... <</opt>>``: the region may be absent;
- ``<<var N>>``: any words, at most N of them, stand in its place.

All other words are mandatory and must match exactly. A template compiles into
a small automaton over words: a state after each mandatory word, skips for
optional regions, counted any-word steps for replaceable ones. A template opens
with at least two mandatory words; places where those stand are found by plain
search, and the automaton runs from there only.

A null or empty text has no words, no labels and score 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words

# Phrases and labels of the base scan.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Wording that several BSD-style texts share; clause marks (1, a) are replaceable.
_BSD_OPEN = ("redistribution and use in source and binary forms with or without modification are permitted <<var 10>> "
             "provided that the following conditions are met")
_BSD_TWO = (" <<var 1>> redistributions of source code must retain the above copyright notice <<var 4>> this list of conditions and "
            "the following disclaimer <<var 12>> <<var 1>> redistributions in binary form must reproduce the above copyright "
            "notice this list of conditions and the following disclaimer in the documentation and or other materials "
            "provided with the distribution")
# The endorsement clause forbids in one of these wordings; each is a template of its own, so that none of the words
# that carry the sense is optional.
_BSD_PROMOTE = " used to endorse or promote products derived from this software without specific prior written permission"
_BSD_NAMES = tuple(f" <<var 1>> {forbids}{_BSD_PROMOTE}" for forbids in (
    "neither the name <<var 20>> may be", "neither the names <<var 20>> may be",
    "the name <<var 20>> may not be", "the names <<var 20>> may not be"))
_BSD_ADVERT = (" <<var 1>> all advertising materials mentioning features or use of this software must display the following "
               "acknowledgement <<var 30>>")
_BSD_END = (" this software is provided <<var 10>> as is and any express or implied warranties including but not limited to "
            "the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event "
            "shall <<var 12>> be liable for any direct indirect incidental special exemplary or consequential damages "
            "including but not limited to procurement of substitute goods or services loss of use data or profits or "
            "business interruption however caused and on any theory of liability whether in contract strict liability or "
            "tort including negligence or otherwise arising in any way out of the use of this software even if advised of "
            "the possibility of such damage")
_MIT_OPEN = ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
             "documentation files <<var 4>> to deal in <<var 2>> software without restriction including without "
             "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of")
_ISC_OPEN = ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
             "granted provided that the above copyright notice and this permission notice appear in all copies")
_UNLICENSE_OPEN = "this is free and unencumbered software released into the public domain"

# Further templates (label, kind, wording). The wording is that of the public licenses: a text has
# all its mandatory wording, an excerpt only its opening.
TEMPLATES = (
    ("mit", "excerpt", _MIT_OPEN),
    ("mit", "text", _MIT_OPEN +
     " the software and to permit persons to whom the software is furnished to do so subject to the following "
     "conditions the above copyright notice and this permission notice <<var 4>> shall be included in all copies or "
     "substantial portions of the software the software is provided as is without warranty of any kind express or "
     "implied including but not limited to the warranties of merchantability fitness for a particular purpose and "
     "noninfringement in no event shall <<var 12>> be liable for any claim damages or other liability whether in an "
     "action of contract tort or otherwise arising from out of or in connection with the software or the use or other "
     "dealings in the software"),
    ("isc", "excerpt", _ISC_OPEN),
    ("isc", "text", _ISC_OPEN +
     " the software is provided as is and <<var 12>> all warranties with regard to this software including all implied "
     "warranties of merchantability and fitness in no event shall <<var 12>> be liable for any special direct indirect "
     "or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action "
     "of contract negligence or other tortious action arising out of or in connection with the use or performance of "
     "this software"),
    ("bsd", "excerpt", _BSD_OPEN),
    ("bsd-2", "text", _BSD_OPEN + _BSD_TWO + _BSD_END),
    *[("bsd-3", "text", _BSD_OPEN + _BSD_TWO + names + _BSD_END) for names in _BSD_NAMES],
    *[("bsd-4", "text", _BSD_OPEN + _BSD_TWO + _BSD_ADVERT + names + _BSD_END) for names in _BSD_NAMES],
    ("apache-2", "notice",
     "licensed under the apache license <<opt>>version<</opt>> 2 0 the license you may not use this file except in "
     "compliance with the license"),
    ("gpl-3", "notice", "gnu general public license <<opt>>as published by the free software foundation<</opt>> "
                        "<<opt>>either<</opt>> version 3"),
    ("gpl-2", "notice", "gnu general public license <<opt>>as published by the free software foundation<</opt>> "
                        "<<opt>>either<</opt>> version 2"),
    ("lgpl", "notice", "gnu lesser general public license"),
    ("agpl", "notice", "gnu affero general public license"),
    ("mpl-2", "notice", "mozilla public license <<opt>>v<</opt>> <<opt>>version<</opt>> 2 0"),
    ("unlicense", "excerpt", _UNLICENSE_OPEN),
    ("unlicense", "text", _UNLICENSE_OPEN +
     " anyone is free to copy modify publish use compile sell or distribute this software either in source code form or "
     "as a compiled binary for any purpose commercial or non commercial and by any means in jurisdictions that recognize "
     "copyright laws the author or authors of this software dedicate any and all copyright interest in the software to "
     "the public domain we make this dedication for the benefit of the public at large and to the detriment of our heirs "
     "and successors we intend this dedication to be an overt act of relinquishment in perpetuity of all present and "
     "future rights to this software under copyright law the software is provided as is without warranty of any kind "
     "express or implied including but not limited to the warranties of merchantability fitness for a particular purpose "
     "and noninfringement in no event shall the authors be liable for any claim damages or other liability whether in an "
     "action of contract tort or otherwise arising from out of or in connection with the software or the use or other "
     "dealings in the software"),
    ("cc0", "notice", "cc0 1 0 <<opt>>universal<</opt>> <<opt>>cc0 1 0<</opt>> public domain dedication"),
    ("cc0", "notice", "cc0 1 0 universal"),
    ("cc-by-sa", "notice", "creative commons attribution sharealike <<var 5>> license"),
    ("cc-by-nc", "notice", "creative commons attribution noncommercial <<var 6>> license"),
    ("cc-by", "notice", "creative commons attribution <<opt>>1 0<</opt>> <<opt>>2 0<</opt>> <<opt>>2 5<</opt>> "
                        "<<opt>>3 0<</opt>> <<opt>>4 0<</opt>> <<opt>>generic<</opt>> <<opt>>unported<</opt>> "
                        "<<opt>>international<</opt>> <<opt>>public<</opt>> license"),
    ("cc-by-sa", "phrase", "cc by sa"),
)
WEIGHT = {"text": 1.0, "notice": 0.8, "excerpt": 0.6, "phrase": 0.5}
_REGION = re.compile(rb"<<\s*(/?opt|var\s+\d+)\s*>>|([^\s<>]+)")


class TokenAutomaton:
    """One template: ``steps[s]`` are (word or None for any, next); ``skips[s]`` cost no word."""

    def __init__(self, template: str):
        self.steps: list[list[tuple[bytes | None, int]]] = [[]]
        self.skips: list[list[int]] = [[]]
        opened: list[int] = []
        at, self.anchor, plain = 0, [], True
        for m in _REGION.finditer(template.encode()):
            region, word = m.groups()
            if word is not None:
                nxt = self._state()
                self.steps[at].append((word, nxt))
                if plain:
                    self.anchor.append(word)
                at = nxt
                continue
            plain = False
            if region == b"opt":
                opened.append(at)
            elif region == b"/opt":
                if not opened:
                    raise ValueError("optional region ends before it begins")
                self.skips[opened.pop()].append(at)
            else:
                ends = [at]
                for _ in range(int(region.split()[1])):
                    nxt = self._state()
                    self.steps[ends[-1]].append((None, nxt))
                    ends.append(nxt)
                at = self._state()
                for e in ends:
                    self.skips[e].append(at)
        if opened or len(self.anchor) < 2:
            raise ValueError("a template opens with two mandatory words and closes its optional regions")
        self.accept = at
        self.needle = b" " + b" ".join(self.anchor) + b" "

    def _state(self) -> int:
        self.steps.append([])
        self.skips.append([])
        return len(self.steps) - 1

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.skips[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def match(self, words: list[bytes], start: int) -> int | None:
        """End of the shortest accepted stretch from ``start``; None where mandatory wording fails."""
        states = self._closed({0})
        for at in range(start, len(words)):
            if self.accept in states:
                return at
            word = words[at]
            states = self._closed({nxt for s in states for need, nxt in self.steps[s] if need is None or need == word})
            if not states:
                return None
        return len(words) if self.accept in states else None


@dataclass(frozen=True)
class Compiled:
    label: str
    kind: str
    base: bool
    automaton: TokenAutomaton


def compile_all(base=BASE, templates=TEMPLATES) -> list[Compiled]:
    return [Compiled(label, "phrase", True, TokenAutomaton(t)) for label, t in base] + [
        Compiled(label, kind, False, TokenAutomaton(t)) for label, kind, t in templates]


def places(words: list[bytes], compiled: list[Compiled]) -> Iterator[tuple[Compiled, int, int]]:
    """(template, first word, end) of every accepted place."""
    joined = b" " + b" ".join(words) + b" "
    for c in compiled:
        at, counted, word = joined.find(c.automaton.needle), 0, 0
        while at >= 0:
            word += joined.count(b" ", counted, at)
            counted = at
            end = c.automaton.match(words, word)
            if end is not None:
                yield c, word, end
            at = joined.find(c.automaton.needle, at + 1)


_SCHEMA_SQL = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
               "labels string, score double, spans array<struct<label:string,start:long,end:long>>")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE, templates=TEMPLATES) -> DataFrame:
    """Licenses of every document.

    n_base counts all places of base phrases; first_word and last_word are
    their smallest and largest first words. labels also has those of the
    templates, spans all accepted places. score is the weight of the strongest
    kind accepted: 1 for a license text, 0.8 for a notice, 0.6 for an
    excerpt of a text, 0.5 for a phrase.
    """
    compiled = compile_all(base, templates)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        for batch in it:
            rows = []
            for text in batch.column(1):
                words = alnum_words(text.as_py())
                found = list(places(words, compiled))
                own = [(c, a) for c, a, _ in found if c.base]
                rows.append((
                    len(words), len(own), min((a for _, a in own), default=None),
                    max((a for _, a in own), default=None), ",".join(sorted({c.label for c, _ in own})),
                    ",".join(sorted({c.label for c, _, _ in found})),
                    max((WEIGHT[c.kind] for c, _, _ in found), default=0.0),
                    [{"label": c.label, "start": a, "end": e} for c, a, e in sorted(found, key=lambda x: x[1:])]))
            columns = [pa.array(col, t) for col, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, _SCHEMA_SQL)


def report(docs: DataFrame, **options) -> DataFrame:
    """The digest columns of :func:`scan`, one row a document."""
    return scan(docs, **options).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
