import pytest

from dimsmith.llm import license_templates as op

from . import brute
from .helpers import bag


@pytest.mark.parametrize("table", ["hard", "small"])
def test_base_columns_equal_brute_force(request, table):
    rows = request.getfixturevalue(f"{table}_rows")
    got = op.report(request.getfixturevalue(table)).collect()
    assert bag((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == bag(
        (d, *brute.licenses(t, op.BASE)) for d, t in rows)
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_empty_table(none):
    assert op.report(none).collect() == []


def words(text):
    return text.lower().encode().split()


def test_optional_and_replaceable_regions():
    a = op.TokenAutomaton("one two <<opt>>three <<opt>>four<</opt>><</opt>> <<var 2>> end")
    for text, end in [("one two end", 3), ("one two three end", 4), ("one two three four end", 5), ("one two x y end", 5),
                      ("one two x y z end", None), ("one two three x y end", 6), ("one two", None), ("one end", None)]:
        assert a.match(words(text), 0) == end, text


def test_mandatory_wording_is_exact():
    full = dict((t[0], t[2]) for t in op.TEMPLATES if t[1] == "text")["mit"].replace("<<var 4>>", "files the")
    full = full.replace("<<var 2>>", "this")
    compiled = op.compile_all()
    labels = lambda text: {c.label for c, _, _ in op.places(words(text), compiled)}
    assert labels("intro " + full + " the software") == {"mit"}
    assert labels(full.replace("charge", "fee")) == set()
    assert labels("gnu general public license as published by the free software foundation either version 3") == {"gpl-3"}
    assert labels("gnu general public license version 4") == set()


def test_bad_templates_are_refused():
    for bad in ("one", "one <<opt>>two<</opt>>", "one two <<opt>> three", "one two <</opt>>"):
        with pytest.raises(ValueError):
            op.TokenAutomaton(bad)


def test_all_places_are_counted():
    compiled = op.compile_all()
    text = "cc by nc cc by nc x under the mit license under the mit license"
    assert [(c.label, a) for c, a, _ in op.places(words(text), compiled) if c.base] == [
        ("mit", 7), ("mit", 11), ("cc-by-nc", 0), ("cc-by-nc", 3)]


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
BSD_TWO = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
ADVERT = """3. All advertising materials mentioning features or use of this software must display the following
acknowledgement: This product includes software developed by the organization.
"""
NAMES = """4. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
"""
BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
# Fixed values above: wording of the public licences.
MAY_NOT = NAMES.replace("Neither the name", "The name").replace(" nor the names of its contributors may be", " may not be")
OWN_CLAUSE = "The Software shall be used for Good, not Evil.\n"
CC = "Creative Commons Attribution"


@pytest.mark.parametrize("text, labels, score", [
    (MIT, {"mit"}, 1.0),
    (MIT.replace("THE SOFTWARE IS", OWN_CLAUSE + "THE SOFTWARE IS", 1), {"mit"}, 0.6),  # the JSON licence
    (ISC, {"isc"}, 1.0), (ISC.replace("SPECIAL", "OTHER"), {"isc"}, 0.6),
    (BSD_TWO + BSD_END, {"bsd", "bsd-2"}, 1.0), (BSD_TWO + NAMES + BSD_END, {"bsd", "bsd-3"}, 1.0),
    (BSD_TWO + ADVERT + NAMES + BSD_END, {"bsd", "bsd-4"}, 1.0), (BSD_TWO + OWN_CLAUSE + BSD_END, {"bsd"}, 0.6),
    (BSD_TWO + MAY_NOT + BSD_END, {"bsd", "bsd-3"}, 1.0), (BSD_TWO + ADVERT + MAY_NOT + BSD_END, {"bsd", "bsd-4"}, 1.0),
    (BSD_TWO + MAY_NOT.replace("may not", "may") + BSD_END, {"bsd"}, 0.6),                  # endorsement is allowed
    (BSD_TWO + NAMES.replace("Neither the name", "The name") + BSD_END, {"bsd"}, 0.6),      # so it is here
    (BSD_TWO + "may be used to endorse or promote products derived from this software without specific prior written "
     "permission" + BSD_END, {"bsd"}, 0.6),
    (f"{CC}-ShareAlike 4.0 International License", {"cc-by-sa"}, 0.8),
    (f"{CC}-NonCommercial-ShareAlike 4.0 International License", {"cc-by-nc"}, 0.8),
    (f"{CC} 3.0 Unported License", {"cc-by"}, 0.8), (f"{CC}-NoDerivatives 4.0 International License", set(), 0.0),
    ("CC0 1.0 Universal (CC0 1.0) Public Domain Dedication", {"cc0"}, 0.8),
])
def test_official_texts_and_near_misses(text, labels, score):
    found = [c for c, _, _ in op.places(op.alnum_words("Copyright 2020 X\n" + text + "\nend"), op.compile_all())]
    assert {c.label for c in found} == labels
    assert max((op.WEIGHT[c.kind] for c in found), default=0.0) == score
