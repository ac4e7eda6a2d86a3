"""License scans by template-markup matching.

A template is a line of words with regions: `[...]` may be left out, `{a-b}` stands for any a to b
words. It is compiled to an automaton over words; a place in a text is accepted if everything
outside the regions stands there exactly. Every template starts with at least two fixed words, by
which its places are looked up.
"""

import re

from pyspark.sql import DataFrame

from .common import as_bytes, map_rows

# Phrases, and the wording of notices, in lower case without punctuation.
PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}
TEMPLATES = {
    "apache-2-notice": "licensed under the apache license version 2 [0] [the license]",
    "cc-by-nc-notice": "licensed under [the] [creative commons] cc by nc [{1-1} 0]",
    "gpl-notice": "is licensed under the [terms of the] gnu general public license [as published by the free "
                  "software foundation] [either] [version {1-2}]",
    "mit-notice": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                "associated documentation files {0-4} to deal in {1-4} without restriction including without "
                "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
                "of the software and to permit persons to whom the software is furnished to do so subject to the "
                "following conditions the above copyright notice and this permission notice [including the next "
                "paragraph] shall be included in all copies or substantial portions of the software the software is "
                "provided as is without warranty of any kind express or implied including but not limited to the "
                "warranties of merchantability fitness for a particular purpose and noninfringement in no event "
                "shall {1-12} be liable for any claim damages or other liability whether in an action of contract "
                "tort or otherwise arising from out of or in connection with the software or the use or other "
                "dealings in the software",
    "isc-text": "permission to use copy modify and [or] distribute this software for any purpose with or without "
                "fee is hereby granted provided that the above copyright notice and this permission notice appear "
                "in all copies the software is provided as is and {1-12} disclaims all warranties with regard to "
                "this software including all implied warranties of merchantability and fitness in no event shall "
                "{1-12} be liable for any special direct indirect or consequential damages or any damages "
                "whatsoever resulting from loss of use data or profits whether in an action of contract negligence "
                "or other tortious action arising out of or in connection with the use or performance of this "
                "software",
    "apache-2-header": "licensed under the apache license version 2 0 the license you may not use {2-3} except in "
                       "compliance with the license you may obtain a copy of the license at [http] [https] [www] "
                       "apache org licenses license 2 0 [txt] [html] unless required by applicable law or agreed to "
                       "in writing software distributed under the license is distributed on an as is basis without "
                       "warranties or conditions of any kind either express or implied see the license for the "
                       "specific language governing permissions and limitations under the license",
    "mpl-2-header": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of "
                    "the mpl was not distributed with this file you can obtain one at [http] [https] [www] mozilla "
                    "org mpl 2 0",
    "unlicense-text": "this is free and unencumbered software released into the public domain anyone is free to copy "
                      "modify publish use compile sell or distribute this software either in source code form or as a "
                      "compiled binary for any purpose commercial or non commercial and by any means in jurisdictions "
                      "that recognize copyright laws the author or authors of this software dedicate any and all "
                      "copyright interest in the software to the public domain we make this dedication for the benefit "
                      "of the public at large and to the detriment of our heirs and successors we intend this "
                      "dedication to be an overt act of relinquishment in perpetuity of all present and future rights "
                      "to this software under copyright law the software is provided as is without warranty of any "
                      "kind express or implied including but not limited to the warranties of merchantability fitness "
                      "for a particular purpose and noninfringement in no event shall the authors be liable for any "
                      "claim damages or other liability whether in an action of contract tort or otherwise arising "
                      "from out of or in connection with the software or the use or other dealings in the software",
    "zlib-text": "this software is provided as is without any express or implied warranty in no event will {1-12} be "
                 "held liable for any damages arising from the use of this software permission is granted to anyone to "
                 "use this software for any purpose including commercial applications and to alter it and redistribute "
                 "it freely subject to the following restrictions [1] the origin of this software must not be "
                 "misrepresented you must not claim that you wrote the original software if you use this software in a "
                 "product an acknowledgment in the product documentation would be appreciated but is not required [2] "
                 "altered source versions must be plainly marked as such and must not be misrepresented as being the "
                 "original software [3] this notice may not be removed or altered from any source distribution",
    "boost-text": "permission is hereby granted free of charge to any person or organization obtaining a copy of the "
                  "software and accompanying documentation covered by this license the software to use reproduce "
                  "display distribute execute and transmit the software and to prepare derivative works of the "
                  "software and to permit third parties to whom the software is furnished to do so all subject to the "
                  "following the copyright notices in the software and this entire statement including the above "
                  "license grant this restriction and the following disclaimer must be included in all copies of the "
                  "software in whole or in part and all derivative works of the software unless such copies or "
                  "derivative works are solely in the form of machine executable object code generated by a source "
                  "language processor the software is provided as is without warranty of any kind express or implied "
                  "including but not limited to the warranties of merchantability fitness for a particular purpose "
                  "title and non infringement in no event shall the copyright holders or anyone distributing the "
                  "software be liable for any damages or other liability whether in contract tort or otherwise arising "
                  "from out of or in connection with the software or the use or other dealings in the software",
}
_BSD = ("redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met [1] [a] redistributions of source code must retain the above copyright "
        "notice this list of conditions and the following disclaimer [2] [b] redistributions in binary form must "
        "reproduce the above copyright notice this list of conditions and the following disclaimer in the "
        "documentation and or other materials provided with the distribution %sthis software is provided by {1-12} "
        "as is and any express or implied warranties including but not limited to the implied warranties of "
        "merchantability and fitness for a particular purpose are disclaimed in no event shall {1-12} be liable for "
        "any direct indirect incidental special exemplary or consequential damages including but not limited to "
        "procurement of substitute goods or services loss of use data or profits or business interruption however "
        "caused and on any theory of liability whether in contract strict liability or tort including negligence or "
        "otherwise arising in any way out of the use of this software even if advised of the possibility of such "
        "damage")
_GNU = ("is free software you can redistribute it and or modify it under the terms of the gnu %s as published by the "
        "free software foundation [either] version {1-2} of the license [or at your option any later version] {1-4} "
        "is distributed in the hope that it will be useful but without any warranty without even the implied "
        "warranty of merchantability or fitness for a particular purpose see the gnu %s for more details")
TEMPLATES |= {
    "bsd-2-text": _BSD % "",
    "bsd-3-text": _BSD % "[3] [c] neither the name of {1-12} nor the names of [its] contributors may be used to endorse "
                         "or promote products derived from this software without specific prior written permission ",
    **{label: _GNU % (name, name) for label, name in (
        ("gpl-header", "general public license"), ("lgpl-header", "lesser general public license"),
        ("lgpl-2-header", "library general public license"), ("agpl-header", "affero general public license"))},
}

_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256))
_QUOTES = "\u201c\u201d\u2018\u2019".encode()  # bytes of curly quotes, which are parts of words


def words(text: bytes) -> list:
    """Runs of digits, letters and characters beyond ASCII, with A-Z in lower case."""
    return text.translate(_WORDS).split()


class Automaton:
    """States are numbered; `steps[s]` has (word, next), None for any word; `free[s]` has the states
    reached without a word."""

    def __init__(self, template: str):
        parts = re.findall(r"\[|\]|\{\d+-\d+\}|[^\s\[\]{}]+", template)
        self.steps, self.free, opened = [[]], [[]], []
        self.anchor = b""
        for n, part in enumerate(parts):
            if part == "[":
                opened.append(self.end)
                self._state()
                self.free[opened[-1]].append(self.end)
            elif part == "]":
                self.free[self._state() - 1].append(self.end)
                self.free[opened.pop()].append(self.end)
            elif part[0] == "{":
                least, most = map(int, part[1:-1].split("-"))
                starts = [self.end]
                for _ in range(most):
                    self._step(None)
                    starts.append(self.end)
                for state in starts[least:-1]:
                    self.free[state].append(self.end)
            else:
                self._step(part.encode())
        fixed = re.match(r"[^\[{]*", template)[0].split()
        if len(fixed) < 2 or opened:
            raise ValueError(f"not a template: {template}")
        self.anchor = " ".join(fixed).encode()

    @property
    def end(self) -> int:
        return len(self.steps) - 1

    def _state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return self.end

    def _step(self, word):
        at = self.end
        self.steps[at].append((word, self._state()))

    def _closure(self, states):
        out, todo = set(), list(states)
        while todo:
            s = todo.pop()
            if s not in out:
                out.add(s)
                todo += self.free[s]
        return out

    def accepts(self, tokens: list, at: int) -> int:
        """End of the longest accepted stretch that starts at word `at`, or -1."""
        states, longest = self._closure([0]), -1
        while states:
            if self.end in states:
                longest = at
            if at == len(tokens):
                break
            states = self._closure(
                nxt for s in states for word, nxt in self.steps[s] if word is None or word == tokens[at])
            at += 1
        return longest


def places(joined: bytes, phrase: bytes) -> list:
    """Word numbers at which the phrase stands in blank-joined words (with a blank at both ends)."""
    out, at, seen, count = [], joined.find(b" " + phrase + b" "), 0, 0
    while at >= 0:
        count += joined.count(b" ", seen, at)
        seen = at
        out.append(count)
        at = joined.find(b" " + phrase + b" ", at + 1)
    return out


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, spans.

    n_base counts the places at which a phrase's words stand one after the other; first_word and
    last_word are their smallest and largest start (words from 0; null without places). base_labels
    and labels (the templates' too) are different, sorted and joined by commas. score is the share
    of the words inside phrases and accepted templates; spans has the latter as (label, start, end).
    Null and empty texts have no words and score 0. Other columns are not read; repeated rows stay.
    """
    fixed = {label: phrase.encode() for label, phrase in phrases.items()}
    automata = {label: Automaton(text) for label, text in templates.items()}

    def one(text):
        tokens = words(text)
        joined = b" " + b" ".join(tokens) + b" "
        found = {label: at for label, phrase in fixed.items() if (at := places(joined, phrase))}
        # Templates are looked up without the quotes around words, which belong to words by the base rules.
        plain = [t.strip(_QUOTES) for t in tokens]
        bare = b" " + b" ".join(plain) + b" "
        spans = [(label, at, end) for label, a in automata.items() for at in places(bare, a.anchor)
                 if (end := a.accepts(plain, at)) >= 0]
        starts = [at for own in found.values() for at in own]
        covered = set()
        for label, own in found.items():
            for at in own:
                covered.update(range(at, at + len(fixed[label].split())))
        for _, at, end in spans:
            covered.update(range(at, end))
        return (len(tokens), len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(found)), ",".join(sorted({*found, *(s[0] for s in spans)})),
                len(covered) / max(1, len(tokens)),
                [{"label": label, "start": at, "end": end} for label, at, end in sorted(spans, key=lambda s: s[1:])])

    def rows(ids, texts):
        yield ids, *zip(*map(one, texts))

    return map_rows(
        docs.select("doc_id", as_bytes()), rows,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, spans array<struct<label: string, start: int, end: int>>")
