"""License automata against a recursive matcher and the base contract."""

import random
import re

import pytest
from common_rows import LONG, frame, ids

from envlake.llm.license_scan import TEMPLATES, Automaton, Scanner, Template, _parse, scan_licenses, words_of


def slow_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def ends(parts, words, at):
    """All ends of matches of the parsed parts that begin at ``at``."""
    if not parts:
        return {at}
    head, rest = parts[0], parts[1:]
    if isinstance(head, bytes):
        return ends(rest, words, at + 1) if at < len(words) and words[at] == head else set()
    if head[0] == "opt":
        return ends(rest, words, at) | {e for m in ends(head[1], words, at) for e in ends(rest, words, m)}
    _, low, high, allowed = head
    out = set()
    for n in range(low, high + 1):
        if at + n <= len(words) and all(allowed is None or w in allowed for w in words[at:at + n]):
            out |= ends(rest, words, at + n)
    return out


def test_automata_match_like_the_recursive_definition():
    rnd = random.Random(2)
    markups = ["a b", "a [[b]] c", "[[a]] b [[c [[d]]]]", "a {{v:1-2}} c", "a {{v:0-2:b|c}} d", "[[x {{v:1-1:a}}]] b c"]
    for markup in markups:
        auto, parts = Automaton(markup), _parse(markup)
        for _ in range(300):
            words = [rnd.choice([b"a", b"b", b"c", b"d", b"x"]) for _ in range(rnd.randrange(9))]
            for i in range(len(words)):
                found = ends(parts, words, i) - {i}
                assert auto.longest(words, i) == max(found, default=0), (markup, words, i)


def test_bad_markup_is_refused():
    for markup in ("a [[b", "a ]] b", "[[a]]", "{{v:2-1}} a", "[[a]] {{v:0-2}}"):
        with pytest.raises(ValueError):
            Automaton(markup)


def test_base_columns_follow_the_contract(spark):
    texts = ["Released under the MIT License. UNDER THE\nMIT LICENSE", "Apache License, Version 2.0 apache license version 2", "cc-by-nc CC BY NC 4.0",
             "nothing", "under the mit", None, "", "x\x7fy éa under the mit license", "the apache license version 20"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in scan_licenses(df).collect()}
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    for i, t in enumerate(texts):
        w = slow_words(t)
        places = [(k, lab) for p, lab in phrases.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        r = got[i]
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert r.first_word == min((k for k, _ in places), default=None) and r.last_word == max((k for k, _ in places), default=None)
        assert r.base_labels == ",".join(sorted({lab for _, lab in places}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert got[1].labels == "apache-2" and got[8].labels == ""


def test_words_and_prefilter_lose_nothing():
    rnd = random.Random(4)
    vocab = sorted({w.decode() for t in TEMPLATES for p in [_parse(t.markup)] for w in p if isinstance(w, bytes)} | {"zz", "2", "4", "é"})
    scanner = Scanner(TEMPLATES)
    for _ in range(400):
        text = rnd.choice([" ", "-", ", "]).join(rnd.choice(vocab) for _ in range(rnd.randrange(30))).title()
        words = words_of(text.encode())
        assert words == [w.encode() for w in slow_words(text)]
        n, hits = scanner.scan(text.encode())
        want = sorted((t.label, i, max(e)) for t in TEMPLATES for i in range(len(words)) if (e := ends(_parse(t.markup), words, i) - {i}))
        assert n == len(words) and sorted((h.label, h.start, h.end) for h in hits) == want


MIT = """Copyright (c) 2021 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""
NOTICE = """# Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
# You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
# software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and limitations under the License."""


def test_license_bodies_match_with_other_names_and_not_with_other_wording():
    scanner = Scanner(TEMPLATES)
    labels = lambda t: {h.label for h in scanner.scan(t.encode())[1]}
    assert labels(MIT) == {"mit"}
    assert labels("x " + MIT.replace("THE AUTHORS OR COPYRIGHT HOLDERS", "Ann Other")) == {"mit"}
    assert labels(MIT.replace("sublicense", "lend")) == set()
    assert labels(BSD) == {"bsd-3"} and labels(BSD.replace("the copyright holder nor", "Example Ltd nor")) == {"bsd-3"}
    clause = BSD.index("3. Neither"), BSD.index("THIS SOFTWARE")
    assert labels(BSD[:clause[0]] + BSD[clause[1]:]) == {"bsd-2"}
    whole = [h for h in scanner.scan(NOTICE.encode())[1] if h.end - h.start > 50]
    assert labels(NOTICE) == {"apache-2"} and len(whole) == 1 and (whole[0].start, whole[0].end) == (0, len(words_of(NOTICE.encode())))


def test_sql_gives_the_same_rows(spark, tmp_path):
    import duckdb

    from envlake.llm.license_scan import ORACLE
    texts = [MIT, BSD, NOTICE, "prefix " + MIT + " under the MIT license " + BSD, "cc by nc 4.0", "", None, MIT.replace("sublicense", "lend")]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = sorted(map(tuple, scan_licenses(df).drop("hits").collect()))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(x) for x in enumerate(texts)])
    assert got == sorted(con.execute(ORACLE).fetchall())


def test_awkward_rows(spark):
    got = scan_licenses(frame(spark))
    assert ids(got) == ids(frame(spark))
    by = {r.doc_id: r for r in got.collect() if r.doc_id in (2, 5)}
    assert (by[2].n_words, by[2].labels, by[2].score) == (0, "", 0.0) and by[5].n_words == len(LONG.split())
    assert scan_licenses(frame(spark, [])).count() == 0
    own = scan_licenses(frame(spark), (Template("first", "a first {{x:1-2}} text"),)).where("labels = 'first'")
    assert [r.doc_id for r in own.collect()] == [1]
