"""License scans by conditional compression.

Every licence template is a raw zstandard dictionary.  A block of text that repeats a
template compresses much better with it; the templates are ranked by the bytes they save,
and a candidate is confirmed by the exact differences of wording between block and template.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parts that several notices have in common.
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")


def _gnu_header(kind: str, versions: str) -> str:
    """The header of the GNU licences: their kind and the versions it allows differ."""
    return (f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as "
            f"published by the Free Software Foundation, {versions} This program is distributed in the hope that it will be useful, but "
            "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
            f"{kind}General Public License for more details. You should have received a copy of the GNU {kind}General Public License along "
            "with this program. If not, see <https://www.gnu.org/licenses/>.")


# Public licence notices and statements, as they are worded by their publishers.
TEMPLATES = {
    "Apache-2.0 statement": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "MIT statement": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        'shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY '
        "OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "BSD-2-Clause": _BSD_HEAD + _BSD_END,
    "BSD-3-Clause": _BSD_HEAD + (
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission. ") + _BSD_END,
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies. " 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR '
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
        "THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "All rights reserved": "All rights reserved.",
    "CC0-1.0 statement": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}
for _name, _kind, _versions in (("GPL", "", ("2", "3")), ("LGPL", "Lesser ", ("2.1", "3")), ("AGPL", "Affero ", ("3",))):
    for _v in _versions:
        _id = f"{_name}-{_v if '.' in _v else _v + '.0'}"
        TEMPLATES[f"{_id} statement"] = f"This work is licensed under the GNU {_kind}General Public License, version {_v}."
        for _later, _words in (("only", f"version {_v} of the License."), ("or-later", f"either version {_v} of the License, or (at your option) any later version.")):
            TEMPLATES[f"{_id}-{_later} header"] = _gnu_header(_kind, _words)
for _terms, _long in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC", "Attribution-NonCommercial"),
                      ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    TEMPLATES[f"CC-{_terms}-4.0 {'' if _terms == 'BY-NC' else 'short '}statement"] = f"Licensed under CC {_terms} 4.0."
    TEMPLATES[f"CC-{_terms}-4.0 {'long ' if _terms == 'BY-NC' else ''}statement"] = f"This work is licensed under a Creative Commons {_long} 4.0 International License."
# Stems of which every licence notice has one.
SIGNAL = r"(?i)licen[sc]|copyright|warrant|permission is|redistribut|all rights reserved|spdx"
#: A sentence belongs to a licence block if so many of its words occur in templates.
KNOWN_SHARE = 0.5
#: The dictionary must save this share of the smaller of block and template, and the wording may differ by this share of the
#: template's words.
SAVED_SHARE, DIFFERENT_SHARE = 0.25, 0.2
#: Templates of so few words are compared whatever the dictionary saves: in a long block that is less than chance.
SHORT = 16
#: Words that decide which licence a text is; a template does not stand for a text that differs in one of them.
_DECIDES = re.compile(r"non-?commercial|share-?alike|no-?deriv|^(cc[-0]?)?(by|nc|sa|nd)(-|$)|^cc0|^(lesser|affero|later|only|neither|endorse|promote"
                      r"|mit|isc|bsd|apache|gnu|[al]?gpl.*|mozilla|mpl|attribution.*)$|^v?\d+\.\d+$")
_NUMBER = re.compile(r"v?\d+$")
_SPDX = re.compile(r"SPDX-License-Identifier:[\x20\t]*(\(?[A-Za-z0-9][\w.+()-]*(?:[\x20\t]+(?:OR|AND|WITH)[\x20\t]+[\w.+()-]+)*)")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SENTENCE = re.compile(r"[^\n]*?(?:[.;:!?](?=[\x20\t\n])|\n|$)")
_EDGE = ".,;:!?\"'()<>[]*#"

SCHEMA = ("doc_id long, start int, end int, license string, exact boolean, words_missing int, words_added int, block_bytes int, "
          "bytes_saved int, differences string")


def _plain(words: list[str]) -> list[str]:
    """Words compared without case and without punctuation at their edges."""
    return [w.strip(_EDGE).lower() for w in words]


class Scanner:
    """The templates with their dictionaries; made once per task."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        self.words = {n: [w for w in _plain(_WORD.findall(t)) if w] for n, t in templates.items()}
        self.known = {w for ws in self.words.values() for w in ws}
        self.longest = max(map(len, self.words.values()))
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.size = {n: len(self.plain.compress(t.encode())) for n, t in templates.items()}
        self.with_template = {}
        for n, t in templates.items():
            data = zstandard.ZstdCompressionDict(t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.with_template[n] = zstandard.ZstdCompressor(level=3, dict_data=data, write_content_size=False, write_dict_id=False)

    def blocks(self, text: str) -> Iterator[list[tuple[int, int, str]]]:
        """Runs of words (start, end, plain word) of neighbouring sentences made of template words, in windows of bounded length."""
        run: list[tuple[int, int, str]] = []
        for sentence in _SENTENCE.finditer(text):
            words = [(m.start(), m.end(), m.group().strip(_EDGE).lower()) for m in _WORD.finditer(text, sentence.start(), sentence.end())]
            if not words:
                continue
            named = re.search(SIGNAL, text[sentence.start():sentence.end()])
            if named or sum(w[2] in self.known or not w[2] for w in words) >= KNOWN_SHARE * len(words):
                run += words
                continue
            yield from self._windows(run)
            run = []
        yield from self._windows(run)

    def _windows(self, run: list[tuple[int, int, str]]) -> Iterator[list[tuple[int, int, str]]]:
        step = self.longest
        for k in range(0, max(1, len(run) - step), step):
            if run[k:k + 2 * step]:
                yield run[k:k + 2 * step]

    def ranked(self, block: bytes) -> list[tuple[int, str]]:
        """(bytes saved, template), most first; of equal savings the smaller name first."""
        size = len(self.plain.compress(block))
        saved = [(size - len(self.with_template[n].compress(block)), n) for n in self.names]
        return sorted(((s, n) for s, n in saved if s >= SAVED_SHARE * min(size, self.size[n]) or len(self.words[n]) <= SHORT), key=lambda x: (-x[0], x[1]))

    def scan(self, doc_id: int | None, text: str) -> list[dict]:
        """Confirmed licences of one text, without those inside a longer one."""
        found: dict[tuple[int, int, str], dict] = {}
        for block in self.blocks(text):
            if not re.search(SIGNAL, text[block[0][0]:block[-1][1]]):
                continue
            data = text[block[0][0]:block[-1][1]].encode()
            for saved, name in self.ranked(data):
                for start, end, missing, added, differences in self._confirmed(block, name):
                    found[start, end, name] = {
                        "doc_id": doc_id, "start": start, "end": end, "license": name, "exact": missing + added == 0, "words_missing": missing,
                        "words_added": added, "block_bytes": len(data), "bytes_saved": saved, "differences": differences}
        for m in _SPDX.finditer(text):
            tag = m.group().rstrip(".")
            found[m.start(), m.start() + len(tag), "SPDX"] = {
                "doc_id": doc_id, "start": m.start(), "end": m.start() + len(tag), "license": "SPDX " + m.group(1).rstrip("."), "exact": True,
                "words_missing": 0, "words_added": 0, "block_bytes": len(tag.encode()), "bytes_saved": 0, "differences": ""}
        rows = list(found.values())
        inside = lambda r: any(o is not r and o["start"] <= r["start"] and r["end"] <= o["end"]
                               and (o["end"] - o["start"], r["license"]) > (r["end"] - r["start"], o["license"]) for o in rows)
        return sorted((r for r in rows if not inside(r)), key=lambda r: (r["start"], r["license"]))

    def _confirmed(self, block: list[tuple[int, int, str]], name: str) -> list[tuple]:
        """The stretches of the block that have the template's wording, and how the two differ, word by word."""
        wanted, there = self.words[name], [w[2] for w in block]
        spare = int(DIFFERENT_SHARE * len(wanted)) + 1
        out, todo = [], [(0, len(there))]
        while todo:
            lo, hi = todo.pop()
            common = Counter(wanted) & Counter(there[lo:hi])
            if sum(common.values()) < (1 - DIFFERENT_SHARE) * len(wanted):
                continue
            longest = SequenceMatcher(None, wanted, there[lo:hi], autojunk=False).find_longest_match()
            at = lo + longest.b
            # The template can reach so far to both sides of its longest common run.
            near = max(lo, at - longest.a - spare), min(hi, at - longest.a + len(wanted) + spare)
            first, last, missing, added, notes, decided = self._aligned(wanted, there, *near)
            if missing + added <= DIFFERENT_SHARE * len(wanted) and not decided:
                out.append((block[first][0], block[last - 1][1], missing, added, " ".join(notes)))
                todo += [(lo, first), (last, hi)]
            else:
                todo += [(lo, at), (at + longest.size, hi)]
        return out

    def _aligned(self, wanted: list[str], there: list[str], lo: int, hi: int) -> tuple[int, int, int, int, list[str], bool]:
        """(first, last, missing, added, differences, whether one decides) of the stretch within [lo, hi) that differs least."""
        parts = [(m.a, lo + m.b, m.size) for m in SequenceMatcher(None, wanted, there[lo:hi], autojunk=False).get_matching_blocks()[:-1]]
        best, score, start = (0, (0, 0)), 0, 0
        for k, (_, b, size) in enumerate(parts):
            # A run joins those before it if it brings more words than it adds strange ones.
            gap = sum(map(bool, there[parts[k - 1][1] + parts[k - 1][2]:b])) if k else 0
            score, start = (score - gap + size, start) if k and score > gap else (size, k)
            best = max(best, (score, (-start, k + 1)))
        parts = parts[-best[1][0]:best[1][1]]
        first, last = parts[0][1], parts[-1][1] + parts[-1][2]
        missing, added, notes, a, b, decided = 0, 0, [], 0, first, False
        for to_a, to_b, size in [*parts, (len(wanted), last, 0)]:
            gone, extra = wanted[a:to_a], [w for w in there[b:to_b] if w]
            decided = decided or any(self._decides(ws, i) for ws, x, y in ((wanted, a, to_a), (there, b, to_b)) for i in range(x, y))
            missing, added = missing + len(gone), added + len(extra)
            notes += [f"-{w}" for w in gone] + [f"+{w}" for w in extra]
            a, b = to_a + size, to_b + size
        return first, last, missing, added, notes, decided

    @staticmethod
    def _decides(ws: list[str], i: int) -> bool:
        """Whether word ``i`` names the kind of the licence, or is a version number."""
        if ws[i] == "library":  # the older name of the Lesser licence, but also what a notice calls the work
            return i > 0 and ws[i - 1] == "gnu"
        return bool(_DECIDES.search(ws[i]) or (_NUMBER.match(ws[i]) and i and ws[i - 1] in ("version", "v", "gpl", "lgpl", "agpl", "license")))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per licence found: doc_id, start, end (characters), license, exact, differences of wording, sizes.

    Needs doc_id and text.  Whole texts are searched.  NULL, empty and other texts without a licence word
    give no row; a NULL doc_id is kept; repeated rows are reported once each; of equal savings
    the smaller template name comes first, and a licence within the stretch of a longer one is not
    reported; SPDX lines are reported with their expression, whatever it names; extra columns are not read; an empty table gives an empty result.
    """
    templates = templates or TEMPLATES

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("license", pa.string()),
                            ("exact", pa.bool_()), ("words_missing", pa.int32()), ("words_added", pa.int32()), ("block_bytes", pa.int32()),
                            ("bytes_saved", pa.int32()), ("differences", pa.string())])
        for batch in batches:
            out = [r for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for r in scanner.scan(i, t)]
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.where(F.col("text").rlike(SIGNAL)).mapInArrow(work, SCHEMA)
