"""License scans by template markup.

A template is license wording with two kinds of marked regions:

* ``[[ ... ]]`` - optional wording, which may stand or not (regions nest);
* ``{{name:min-max}}`` or ``{{name:min-max:a|b}}`` - replaceable wording: that
  many words of any kind, or only of those listed.

All other words are mandatory and must match exactly, in order, without gaps.
A template is compiled into a token automaton: states over words, with a free
step past every optional region. Texts are scanned whole; automata start only
at a word that can begin a template, and several run side by side.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envlake.llm.common import small_batches

#: ASCII other than 0-9 and a-z (after lowering) separates words; other code points are word characters.
_BREAKS = bytes.maketrans(bytes(c for c in range(128) if not chr(c).isdigit() and not "a" <= chr(c) <= "z"),
                          b" " * (128 - 36))


@dataclass(frozen=True)
class Template:
    label: str
    markup: str
    #: A phrase counts in n_base, n_base's words and base_labels.
    base: bool = False


TEMPLATES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
    Template("mit", "[[released]] [[licensed]] under [[the terms of]] the mit [[software]] license"),
    Template("apache-2", "[[licensed under]] [[the]] apache [[software]] license [[version]] {{v:1-1:2}} [[0]]"),
    Template("gpl-2", "gnu general public license [[as published by the free software foundation either]] version 2"),
    Template("gpl-3", "gnu general public license [[as published by the free software foundation either]] version 3"),
    Template("lgpl", "gnu {{kind:1-1:lesser|library}} general public license [[as published by the free software foundation either]] version {{v:1-1:2|3}}"),
    Template("agpl-3", "gnu affero general public license [[as published by the free software foundation either]] version 3"),
    Template("mpl-2", "mozilla public license [[v]] [[version]] 2"),
    Template("bsd", "[[the]] bsd {{n:1-1:2|3|4}} clause license"),
    Template("cc-by", "[[licensed under]] cc by {{version:1-1:1|2|3|4}} [[0]]"),
    Template("cc-by-sa", "[[licensed under]] cc by sa [[{{version:1-1:1|2|3|4}} [[0]]]]"),
    Template("cc-by-nd", "[[licensed under]] cc by nd [[{{version:1-1:1|2|3|4}} [[0]]]]"),
    Template("cc-by-nc", "[[licensed under]] [[creative commons]] cc by nc {{version:1-1:1|2|3|4}} [[0]]"),
    Template("cc0", "cc0 [[1 0]] [[universal]] public domain dedication"),
    Template("copyright", "copyright [[c]] {{holder:1-6}} all rights reserved"),
    Template("all-rights-reserved", "all rights reserved"),
    # The wording of licenses and of their notices in files. Names, numbers of
    # clauses and addresses may differ; all else is mandatory.
    Template("mit", """permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation the rights to use
        copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is
        furnished to do so subject to the following conditions the above copyright notice and this permission notice
        [[including the next paragraph]] shall be included in all copies or substantial portions of the software the software is
        provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
        fitness for a particular purpose and noninfringement in no event shall {{holders:1-12}} be liable for any claim damages or other
        liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or
        other dealings in the software"""),
    Template("isc", """permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby
        granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is
        and {{author:1-12}} {{verb:1-1:disclaim|disclaims}} all warranties with regard to this software including all implied warranties of
        merchantability and fitness in no event shall {{holder:1-12}} be liable for any special direct indirect or consequential damages or
        any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious
        action arising out of or in connection with the use or performance of this software"""),
    Template("bsd-2", """redistribution and use in source and binary forms with or without modification are permitted provided that the
        following conditions are met [[1]] redistributions of source code must retain the above copyright notice this list of conditions
        and the following disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions
        and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided
        by {{holders:1-12}} as is and any express or implied warranties including but not limited to the implied warranties of
        merchantability and fitness for a particular purpose are disclaimed"""),
    Template("bsd-3", """redistribution and use in source and binary forms with or without modification are permitted provided that the
        following conditions are met [[1]] redistributions of source code must retain the above copyright notice this list of conditions
        and the following disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions
        and the following disclaimer in the documentation and or other materials provided with the distribution [[3]] neither the name of
        {{owner:1-12}} nor the names of {{whose:1-3}} contributors may be used to endorse or promote products derived from this software
        without specific prior written permission this software is provided by {{holders:1-12}} as is and any express or implied
        warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are
        disclaimed"""),
    Template("apache-2", """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the
        license you may obtain a copy of the license at {{address:1-10}} unless required by applicable law or agreed to in writing software
        distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or
        implied see the license for the specific language governing permissions and limitations under the license"""),
    Template("mpl-2", """this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not
        distributed with this file you can obtain one at {{address:1-8}}"""),
    Template("zlib", """this software is provided as is without any express or implied warranty in no event will {{holders:1-12}} be held
        liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose
        including commercial applications and to alter it and redistribute it freely subject to the following restrictions [[1]] the origin
        of this software must not be misrepresented you must not claim that you wrote the original software"""),
    Template("unlicense", """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use
        compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non
        commercial and by any means"""),
)


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text, A-Z lowered."""
    return (text or b"").lower().translate(_BREAKS).split()


def _parse(markup: str) -> list:
    """Nested lists: a word, ``("var", min, max, words or None)``, or ``("opt", [...])``."""
    stack: list[list] = [[]]
    for t in re.findall(r"\[\[|\]\]|\{\{[^}]*\}\}|[^\s\[\]{}]+", markup):
        if t == "[[":
            stack.append([])
        elif t == "]]":
            if len(stack) == 1:
                raise ValueError(f"unopened ]] in {markup!r}")
            region = stack.pop()
            stack[-1].append(("opt", region))
        elif t.startswith("{{"):
            _, span, *allowed = t[2:-2].split(":")
            low, high = map(int, span.split("-"))
            if not 0 <= low <= high or not high:
                raise ValueError(f"bad region {t!r}")
            stack[-1].append(("var", low, high, frozenset(w.encode() for w in allowed[0].split("|")) if allowed else None))
        else:
            stack[-1].extend(words_of(t.encode()))
    if len(stack) > 1:
        raise ValueError(f"unclosed [[ in {markup!r}")
    return stack[0]


class Automaton:
    """Word automaton of one template. ``steps[state]`` lists ``(words, next)``
    (``None``: any word); ``free[state]`` are states reached without a word."""

    def __init__(self, markup: str):
        self.steps: list[list] = [[]]
        self.free: list[set[int]] = [set()]
        self.final = self._add(_parse(markup), 0)
        self.closed = [self._closure(s) for s in range(len(self.steps))]
        begin = [w for s in self.closed[0] for w, _ in self.steps[s]]
        if self.final in self.closed[0] or not begin:
            raise ValueError(f"template without mandatory words: {markup!r}")
        #: Words that can begin a match; None: any.
        self.begin = None if None in begin else frozenset().union(*begin)

    def _state(self) -> int:
        self.steps.append([])
        self.free.append(set())
        return len(self.steps) - 1

    def _add(self, parts: list, at: int) -> int:
        for p in parts:
            if isinstance(p, bytes):
                to = self._state()
                self.steps[at].append((frozenset([p]), to))
                at = to
            elif p[0] == "opt":
                to = self._add(p[1], at)
                end = self._state()
                self.free[at].add(end)
                self.free[to].add(end)
                at = end
            else:
                _, low, high, allowed = p
                skips = []
                for i in range(high):
                    if i >= low:
                        skips.append(at)
                    to = self._state()
                    self.steps[at].append((allowed, to))
                    at = to
                for s in skips:
                    self.free[s].add(at)
        return at

    def _closure(self, s: int) -> frozenset[int]:
        seen, todo = {s}, [s]
        while todo:
            for x in self.free[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        return frozenset(seen)

    def longest(self, words: list[bytes], at: int) -> int:
        """End of the longest match that starts at word ``at``; 0 if none does."""
        live, best = self.closed[0], 0
        for i in range(at, len(words)):
            w, new = words[i], set()
            for s in live:
                for allowed, to in self.steps[s]:
                    if allowed is None or w in allowed:
                        new |= self.closed[to]
            if not new:
                break
            if self.final in new:
                best = i + 1
            live = new
        return best


@dataclass(frozen=True)
class Hit:
    label: str
    start: int
    end: int
    base: bool


class Scanner:
    """All templates, reached by the words that can begin them."""

    def __init__(self, templates: tuple[Template, ...]):
        self.automata = [(t, Automaton(t.markup)) for t in templates]
        self.any_word = [x for x in self.automata if x[1].begin is None]
        self.by_word: dict[bytes, list] = {}
        for x in self.automata:
            for w in x[1].begin or ():
                self.by_word.setdefault(w, []).append(x)
        # A text in which none of these stands has no match: one mandatory word a template.
        self.rare = [max((p for p in _parse(t.markup) if isinstance(p, bytes)), key=len, default=b"") for t in templates]

    def scan(self, text: bytes | None) -> tuple[int, list[Hit]]:
        """The number of words, and every place where a template matches (the longest from each start)."""
        words = words_of(text)
        low = (text or b"").lower()
        live = {id(a) for (t, a), w in zip(self.automata, self.rare) if w in low}
        if not live:
            return len(words), []
        hits, known = [], self.by_word.keys()
        starts = range(len(words)) if self.any_word else [i for i, w in enumerate(words) if w in known]
        for i in starts:
            for t, a in (*self.by_word.get(words[i], ()), *self.any_word):
                if id(a) in live and (end := a.longest(words, i)):
                    hits.append(Hit(t.label, i, end, t.base))
        return len(words), hits


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """License wording of every text, one row a row of ``docs``.

    ``id_col, n_words, n_base, first_word, last_word, base_labels, labels, score,
    hits``: ``n_base`` counts all places of base templates, ``first_word`` and
    ``last_word`` are the smallest and largest start among them (null: none),
    labels are distinct, sorted and comma-joined, ``hits`` lists
    ``label, start, end`` (words, end exclusive) of all templates, and ``score``
    is the share of the text's words that matched wording covers.

    A null or empty text has no words and a score of 0. Texts are never cut.
    Null or repeated ids and repeated rows keep their own row; further columns
    are ignored; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    src = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("binary").alias("__text"))
    Scanner(templates)  # bad markup fails here, not in a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for b in batches:
            out: dict[str, list] = {n: [] for n in ("n_words", "n_base", "first_word", "last_word",
                                                    "base_labels", "labels", "score", "hits")}
            for text in b.column("__text").to_pylist():
                n, hits = scanner.scan(text)
                base = [h.start for h in hits if h.base]
                covered = np.zeros(n + 1, np.int64)
                for h in hits:
                    covered[h.start] += 1
                    covered[h.end] -= 1
                out["n_words"].append(n)
                out["n_base"].append(len(base))
                out["first_word"].append(min(base, default=None))
                out["last_word"].append(max(base, default=None))
                out["base_labels"].append(",".join(sorted({h.label for h in hits if h.base})))
                out["labels"].append(",".join(sorted({h.label for h in hits})))
                out["score"].append(float((np.cumsum(covered) > 0).sum() / n) if hits else 0.0)
                out["hits"].append([{"label": h.label, "start": h.start, "end": h.end} for h in hits])
            long, text_ = pa.int64(), pa.string()
            types = [long] * 4 + [text_] * 2 + [pa.float64(), pa.list_(pa.struct([("label", text_), ("start", long), ("end", long)]))]
            yield pa.RecordBatch.from_arrays(
                [b.column("__id"), *[pa.array(v, t) for v, t in zip(out.values(), types)]], names=["__id", *out])

    schema = (f"__id {src.schema['__id'].dataType.simpleString()}, n_words bigint, n_base bigint, first_word bigint, "
              "last_word bigint, base_labels string, labels string, score double, "
              "hits array<struct<label:string,start:bigint,end:bigint>>")
    return src.mapInArrow(run, schema).withColumnRenamed("__id", id_col)


def _pattern(parts: list) -> str:
    """The parsed template as a regular expression over words that a blank follows each."""
    out = ""
    for p in parts:
        if isinstance(p, bytes):
            out += p.decode() + " "
        elif p[0] == "opt":
            out += f"(?:{_pattern(p[1])})?"
        else:
            words = "|".join(sorted(w.decode() for w in p[3])) if p[3] else "[^ ]+"
            out += f"(?:(?:{words}) ){{{p[1]},{p[2]}}}"
    return out


def _most_words(parts: list) -> int:
    """Words of the longest text that the parsed template accepts."""
    return sum(1 if isinstance(p, bytes) else _most_words(p[1]) if p[0] == "opt" else p[2] for p in parts)


def _oracle(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """The contract's columns in DuckDB: each template as a pattern, tried at every word."""
    most = max(_most_words(_parse(t.markup)) for t in templates)
    rows = ", ".join(f"('{t.label}', {t.base}, '{_pattern(_parse(t.markup))}')" for t in templates)
    upper = "".join(map(chr, range(65, 91)))
    return f"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
                                 '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
t(label, base, rx) AS (VALUES {rows}),
c AS (SELECT * FROM d JOIN t ON regexp_matches(' ' || array_to_string(ws, ' ') || ' ', ' ' || rx)),
p AS (SELECT doc_id, ws, label, base, rx, UNNEST(range(0, len(ws))) AS i FROM c),
h AS (SELECT doc_id, label, base, i,
             length(regexp_replace(regexp_extract(array_to_string(ws[i + 1:i + {most}], ' ') || ' ', '^' || rx), '[^ ]', '', 'g')) AS n FROM p),
g AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(i) FILTER (base) AS first_word, max(i) FILTER (base) AS last_word,
             array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
             array_to_string(list_sort(list(DISTINCT label)), ',') AS labels FROM h WHERE n > 0 GROUP BY doc_id),
k AS (SELECT doc_id, count(DISTINCT w) AS covered FROM (SELECT doc_id, UNNEST(range(i, i + n)) AS w FROM h WHERE n > 0) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(CAST(covered AS DOUBLE) / len(ws), 0.0::DOUBLE) AS score
FROM d LEFT JOIN g USING (doc_id) LEFT JOIN k USING (doc_id)"""


ORACLE = _oracle()
