"""Licence notices in whole texts: fixed phrases, and templates with optional and replaceable regions.

A template is words with the markup of licence lists: <<beginOptional>> ... <<endOptional>> may be left
out, <<var;match=a..b>> stands for a to b words of any kind. It is compiled to an automaton over words:
literal words, choices and steps over any word. A text is accepted where the whole automaton runs through
consecutive words, so all mandatory wording must match exactly. Punctuation, case of A-Z and white space
are no part of words. Optional regions at a template's ends don't matter for a search and are dropped.

Places for the automata to start are those of the template's first literal words, found on hashes.

Defined cases: null or empty texts have no words, no labels and score 0; a null doc_id or a repeated row is
treated like any other; very long texts are read whole; where several templates accept a text, it has all their
labels, each once; an empty table gives no rows; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletgraph.llm.words import PLAIN_LOWER, Hasher

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Wordings of public licence notices.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 <<beginOptional>>(the \"License\")<<endOptional>>",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this <<var;match=1..3>> except in compliance with the License. You may obtain a copy of the License at <<var;match=1..12>> Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-2.0-header-whole": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this <<var;match=1..3>> except in compliance with the License. You may obtain a copy of the License at <<var;match=1..12>> Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "mit-notice": "<<beginOptional>>This work is<<endOptional>> released under the <<beginOptional>>terms of the<<endOptional>> MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and <<beginOptional>>associated<<endOptional>> documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE <<var;match=1..8>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "gpl-3.0-notice": "licensed under the GNU General Public License, <<beginOptional>>either<<endOptional>> version 3",
    "gpl-later-notice": "This <<var;match=1..4>> is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version <<var;match=1..2>> of the License, or (at your option) any later version. This <<var;match=1..4>> is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "lgpl-later-notice": "This <<var;match=1..4>> is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version <<var;match=1..2>> of the License, or (at your option) any later version. This <<var;match=1..4>> is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at <<var;match=1..2>> mozilla.org/MPL/2.0",
    "isc": "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND <<var;match=1..8>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;match=1..8>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY <<var;match=1..12>> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;match=1..12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. <<beginOptional>>3.<<endOptional>> Neither the name of <<var;match=1..12>> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY <<var;match=1..12>> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;match=1..12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "gpl-later-grant": "This <<var;match=1..4>> is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version <<var;match=1..2>> of the License, or (at your option) any later version.",
    "cc-by-nc-4.0-notice": "<<beginOptional>>This <<var;match=1..3>> is<<endOptional>> licensed under <<beginOptional>>the terms of<<endOptional>> CC BY-NC 4.0",
    "cc-by-4.0-notice": "licensed under <<beginOptional>>a<<endOptional>> Creative Commons Attribution 4.0 International License",
    "rights-reserved": "Copyright <<beginOptional>>(c)<<endOptional>> <<var;match=1..8>> All rights reserved",
}

LITERAL, ANY, SPLIT, MATCH = range(4)
#: Scores of a text with a template's whole wording, or with a phrase only.
WHOLE, PART = 1.0, 0.5


def word_hashes(text: str) -> list[int]:
    return [int(x) for _, _, own in Hasher(PLAIN_LOWER).words(pa.array([text])) for x in own]


@dataclass
class Automaton:
    """code: (operation, argument); SPLIT tries the next instruction and the one it names."""

    code: list[tuple[int, int]] = field(default_factory=list)

    @staticmethod
    def compile(template: str) -> Automaton:
        tokens = [x for x in re.split(r"(<<.*?>>)", template) if x.strip()]
        parts, stack = [], []
        for x in tokens:
            if x == "<<beginOptional>>":
                stack.append(parts)
                parts = []
            elif x == "<<endOptional>>":
                if not stack:
                    raise ValueError("an optional region is ended that was not begun")
                inner, parts = parts, stack.pop()
                parts.append(("optional", inner))
            elif x.startswith("<<var"):
                found = re.search(r"match=(\d+)\.\.(\d+)", x)
                if not found or int(found[1]) > int(found[2]):
                    raise ValueError(f"a replaceable region needs match=least..most words: {x}")
                parts.append(("var", (int(found[1]), int(found[2]))))
            elif x.startswith("<<"):
                raise ValueError(f"unknown markup: {x}")
            else:
                parts += [("word", h) for h in word_hashes(x)]
        if stack:
            raise ValueError("an optional region is not ended")
        while parts and parts[0][0] == "optional":
            parts = parts[1:]
        while parts and parts[-1][0] == "optional":
            parts = parts[:-1]
        if not parts or parts[0][0] != "word":
            raise ValueError("a template must start with a literal word")
        out = Automaton()
        out._emit(parts)
        out.code.append((MATCH, 0))
        return out

    def _emit(self, parts: list) -> None:
        for kind, x in parts:
            if kind == "word":
                self.code.append((LITERAL, x))
            elif kind == "optional":
                at = len(self.code)
                self.code.append((SPLIT, 0))
                self._emit(x)
                self.code[at] = (SPLIT, len(self.code))
            else:
                low, high = x
                self.code += [(ANY, 0)] * low
                end = len(self.code) + 2 * (high - low)
                self.code += [(SPLIT, end), (ANY, 0)] * (high - low)

    def start(self) -> list[int]:
        """The literal words that every match starts with, three at most."""
        out = []
        for op, x in self.code[:3]:
            if op != LITERAL:
                break
            out.append(x)
        return out

    def accepts(self, words: np.ndarray) -> bool:
        """Whether a match starts at the first of the words."""
        states, at, n = self._closure({0}), 0, len(words)
        while states:
            if any(self.code[s][0] == MATCH for s in states):
                return True
            if at == n:
                return False
            w = int(words[at])
            states = self._closure({s + 1 for s in states if self.code[s][0] == ANY or self.code[s] == (LITERAL, w)})
            at += 1
        return False

    def _closure(self, states: set[int]) -> set[int]:
        todo, out = list(states), set()
        while todo:
            s = todo.pop()
            if s not in out:
                out.add(s)
                if self.code[s][0] == SPLIT:
                    todo += [s + 1, self.code[s][1]]
        return {s for s in out if self.code[s][0] != SPLIT}


def _starts(hashes: np.ndarray, room: np.ndarray, phrase: list[int]) -> np.ndarray:
    """Where the phrase stands within one document; room: words left in the document from each word on."""
    n = len(hashes) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(hashes[:n] == np.uint64(phrase[0]))
    for i, w in enumerate(phrase[1:], 1):
        at = at[hashes[at + i] == np.uint64(w)]
    return at[room[at] >= len(phrase)]


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every document."""
    fixed = [(word_hashes(p), label) for p, label in (PHRASES if phrases is None else phrases).items()]
    machines = [(Automaton.compile(t), label) for label, t in (TEMPLATES if templates is None else templates).items()]

    def run(batches):
        hasher = Hasher(PLAIN_LOWER)
        for batch in batches:
            size = batch.num_rows
            n_words, n_base = np.zeros(size, np.int64), np.zeros(size, np.int64)
            first, last = np.full(size, -1), np.full(size, -1)
            base, more = {}, {}
            for at, counts, hashes in hasher.words(batch["text"]):
                n_words[at : at + len(counts)] = counts
                ends = np.cumsum(counts)
                room = np.repeat(ends, counts) - np.arange(len(hashes))
                for phrase, label in fixed:
                    for place in _starts(hashes, room, phrase).tolist():
                        i = int(np.searchsorted(ends, place, side="right"))
                        doc, word = at + i, place - int(ends[i] - counts[i])
                        base.setdefault(doc, set()).add(label)
                        n_base[doc] += 1
                        first[doc] = word if first[doc] < 0 else min(first[doc], word)
                        last[doc] = max(last[doc], word)
                for machine, label in machines:
                    for place in _starts(hashes, room, machine.start()).tolist():
                        doc = at + int(np.searchsorted(ends, place, side="right"))
                        if label not in more.get(doc, ()) and machine.accepts(hashes[place : place + room[place]]):
                            more.setdefault(doc, set()).add(label)
            some = n_base > 0
            join = lambda x: ",".join(sorted(x))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(n_words),
                    pa.array(n_base),
                    pa.array(first, pa.int64(), mask=~some),
                    pa.array(last, pa.int64(), mask=~some),
                    pa.array([join(base.get(i, ())) for i in range(size)], pa.string()),
                    pa.array([join(base.get(i, set()) | more.get(i, set())) for i in range(size)], pa.string()),
                    pa.array([WHOLE if i in more else PART if i in base else 0.0 for i in range(size)], pa.float64()),
                ],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
