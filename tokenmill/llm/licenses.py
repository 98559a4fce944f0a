"""License scan by template-markup matching.

Templates are short markup texts: plain words are mandatory, ``[[ ... ]]``
is an optional region and ``{{name}}`` (or ``{{name:n}}``) a replaceable
region of 0 to ``n`` words (default 12). Each template is compiled to an
automaton over words; a text is accepted where some run of its words
passes through the automaton, so its mandatory wording matches exactly and
in order. Matching is linear in the words that follow an anchor (the
template's rarest mandatory word); texts without an anchor are not run.

Base phrases are reported as well, wherever their words stand
consecutively. A null text is empty (no words, score 0); empty texts,
ties and repeated rows give one row each; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.common import arrow_map

# Base phrases and their labels.
BASE_PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache",
                ("general", "public", "license"): "gpl"}

# Wording of public licenses and notices, with their labels.
TEMPLATES = {
    "spdx-mit-notice": ("MIT", "[[released]] [[under]] [[licensed under]] the MIT license"),
    "apache-short": ("Apache-2.0", "licensed under the Apache License [[,]] version 2.0"),
    "apache-notice": (
        "Apache-2.0",
        "licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at {{place:12}} unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License"),
    "gpl-3-short": ("GPL-3.0", "licensed under the [[GNU]] General Public License [[,]] version 3 [[or later]]"),
    "gpl-2-short": ("GPL-2.0", "licensed under the [[GNU]] General Public License [[,]] version 2 [[or later]]"),
    "gpl-notice": (
        "GPL",
        "this program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation [[,]] {{version:20}} this program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
        "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details"),
    "lgpl-short": ("LGPL", "licensed under the [[GNU]] Lesser General Public License"),
    "agpl-short": ("AGPL", "licensed under the [[GNU]] Affero General Public License"),
    "mpl-notice": (
        "MPL-2.0",
        "this source code form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, you can obtain one at [[http]] [[https]] [[www]] mozilla.org/MPL/2.0/"),
    "mit-text": (
        "MIT",
        "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: the above copyright notice and this permission notice [[(including the next paragraph)]] shall "
        "be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL {{holders:8}} BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"),
    "isc-text": (
        "ISC",
        "permission to use, copy, modify, [[and]] [[and/or]] distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND {{holders:8}} DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL {{holders:8}} BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE"),
    "bsd-text": (
        "BSD",
        "redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: [[1.]] redistributions of source code must retain the above "
        "copyright notice, this list of conditions and the following disclaimer. [[2.]] redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. "
        "[[ [[3.]] neither the name of {{holder:12}} nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. ]] "
        "THIS SOFTWARE IS PROVIDED BY {{holders:12}} \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO "
        "EVENT SHALL {{holders:12}} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
        "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
        "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN "
        "IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"),
    "unlicense-text": (
        "Unlicense",
        "this is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the "
        "author or authors of this software dedicate any and all copyright interest in the software to the public domain. "
        "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. "
        "We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to "
        "this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE"),
    "zlib-text": (
        "Zlib",
        "this software is provided as-is, without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject "
        "to the following restrictions: [[1.]] the origin of this software must not be misrepresented; you must not claim "
        "that you wrote the original software. If you use this software in a product, an [[acknowledgment]] "
        "[[acknowledgement]] in the product documentation would be appreciated but is not required. [[2.]] altered source "
        "versions must be plainly marked as such, and must not be misrepresented as being the original software. [[3.]] "
        "this notice may not be removed or altered from any source distribution"),
    "cc-by-nc-sa": ("CC-BY-NC-SA", "CC BY NC SA [[{{version:2}}]]"),
    "cc-by-nc": ("CC-BY-NC", "licensed under [[a]] [[the]] CC BY NC [[{{version:2}}]]"),
    "cc-by-sa": ("CC-BY-SA", "licensed under [[a]] [[the]] CC BY SA [[{{version:2}}]]"),
    "cc-by": ("CC-BY", "licensed under [[a]] [[the]] CC BY [[{{version:2}}]] [[international]]"),
    "cc-long-by": ("CC-BY", "licensed under [[a]] [[the]] Creative Commons Attribution [[{{version:2}}]] [[international]] license"),
    "cc0": ("CC0-1.0", "CC0 1.0 [[universal]]"),
    "spdx-id": ("SPDX", "SPDX License Identifier {{expression:6}}"),
}

# every byte that is not a word character becomes a blank; A-Z becomes a-z
_KEEP = bytes(c for c in range(256) if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80)
_TABLE = bytes((c + 32 if 0x41 <= c <= 0x5A else c if c in _KEEP else 0x20) for c in range(256))
_MARK = re.compile(r"(\[\[|\]\]|\{\{[^}]*\}\})")


def license_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, as UTF-8 bytes."""
    return [] if not text else text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Automaton:
    """Word automaton of a template: state -> {word: next states}; ``free``
    states accept any word; ``skip`` edges need none."""

    def __init__(self, markup: str):
        self.step: dict[int, tuple[bytes, int]] = {}
        self.free: dict[int, int] = {}
        self.skip: dict[int, list[int]] = defaultdict(list)
        self.required: list[bytes] = []
        at, stack = 0, []
        for part in _MARK.split(markup):
            if part == "[[":
                stack.append(at)
            elif part == "]]":
                self.skip[stack.pop()].append(at)
            elif part.startswith("{{"):
                n = int(part[2:-2].partition(":")[2] or 12)
                first = at
                for _ in range(n):
                    self.free[at] = at + 1
                    at += 1
                for s in range(first, at):
                    self.skip[s].append(at)
            else:
                for w in license_words(part):
                    self.step[at] = (w, at + 1)
                    at += 1
                    if not stack:
                        self.required.append(w)
        self.final = at
        self.start = self._closure({0})
        self.first = {self.step[s][0] for s in self.start if s in self.step}

    def _closure(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in self.skip.get(todo.pop(), ()):
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    def accepts_at(self, ws: list[bytes], i: int) -> int | None:
        """End of the longest accepted run of words that starts at ``i``, else None."""
        states, end = self.start, None
        while states:
            if self.final in states:
                end = i
            if i >= len(ws):
                break
            w, following = ws[i], set()
            for s in states:
                if s in self.step and self.step[s][0] == w:
                    following.add(self.step[s][1])
                if s in self.free:
                    following.add(self.free[s])
            states = self._closure(following)
            i += 1
        return end


AUTOMATA = {name: (label, Automaton(markup)) for name, (label, markup) in TEMPLATES.items()}
# a template is run only where its least common mandatory words all occur
_RARE = ("hereby", "redistribution", "redistribute", "unencumbered", "warranty", "spdx", "mozilla", "cc0", "creative",
         "apache", "mit", "lesser", "affero", "general", "cc", "license")
_ANCHOR = {name: next(r.encode() for r in _RARE if r.encode() in a.required) for name, (_, a) in AUTOMATA.items()}


def scan(text: str | None) -> tuple[int, list[tuple[int, str]], list[tuple[str, str, int, int]]]:
    """(number of words, base places (start, label), template matches (label, template, start, end))."""
    ws = license_words(text)
    present = set(ws)
    places = []
    if b"license" in present:
        for i, w in enumerate(ws):
            if w != b"license":
                continue
            for phrase, label in BASE_PHRASES.items():
                s = i - len(phrase) + 1
                if s >= 0 and tuple(x.decode("ascii", "replace") for x in ws[s:i + 1]) == phrase:
                    places.append((s, label))
    found = []
    for name, (label, a) in AUTOMATA.items():
        if _ANCHOR[name] in present and present.issuperset(a.required):
            for i, w in enumerate(ws):
                if w in a.first and (end := a.accepts_at(ws, i)) is not None:
                    found.append((label, name, i, end))
    return len(ws), places, found


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, base places, template matches) per row of ``df``; word offsets from 0, ends exclusive."""
    cols = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = cols.schema["doc_id"].dataType.simpleString()

    def run(ids, texts):
        n, places, found = zip(*map(scan, texts)) if texts else ((), (), ())
        return (ids, n, [[{"start": s, "label": x} for s, x in p] for p in places],
                [[{"label": x, "template": t, "start": s, "end": e} for x, t, s, e in f] for f in found])

    return arrow_map(cols, run, f"doc_id {kind}, n_words long, places array<struct<start long, label string>>, "
                                "matches array<struct<label string, template string, start long, end long>>")
