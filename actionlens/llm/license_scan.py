"""License scan by conditional compression.

Every template has *cues*: its longest words, one more than a notice may lack, so
no notice is without one of them.  A cue in a document says where its template
would lie; cues that agree on the place give one candidate block, the template's
length and what a notice may have more or less.  The block is compressed by
itself and with the template as zstandard raw dictionary.  Templates are ranked
by the bytes they save, relative to what they save on their own text, and those
under a floor are out.  The winners are confirmed by their exact wording
differences: template and block are aligned word by word, and the template must
be there but for a stated share of its words.  Every place of every template
counts; of places that overlap the best is reported, with its differences.

A template of fewer than ``SHORT`` words saves a handful of bytes, which one word
in between can eat up; its blocks are ranked, but the floor does not hold for them.

Words are split at white space (no-break space included), A-Z lower-cased and
ASCII punctuation at their ends cut off for the alignment.  Null and empty texts
have no block; repeated rows are reported each; texts of any length are scanned
whole; a template without a word is an error.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actionlens.llm.common import documents
from actionlens.llm.textops import lowered, slices, span_hash, words

# Public licence notices.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "proprietary": "All rights reserved.",
}
# The same licences' standard headers, and the texts of the short ones.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
        subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
        BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
        AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
        You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
        distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
        FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU
        General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    "GPL-2.0": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is
        distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
        FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU
        General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth
        Floor, Boston, MA 02110-1301 USA.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor
        the names of its contributors may be used to endorse or promote products derived from this software without specific prior written
        permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
        EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
        DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
        INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
        OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
        with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
}
COVERAGE = 0.85         # least share of a template's words that must be there, in order
SHORT = 7               # shorter templates must be there whole, and the floor does not hold for them
FLOOR = 0.1             # least saving of a block, as a share of what the template saves on its own text
FOUND = "doc_id long, license string, start_word long, end_word long, coverage double, saved_bytes int, differences string"

_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


_SPACE = re.compile("[\x20\x09-\x0d\u00a0]+")


def plain(text: str) -> list[str]:
    """Words for the alignment."""
    low = text.translate({c: c + 32 for c in range(65, 91)})
    return [w for w in (x.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") for x in _SPACE.split(low)) if w]


def _spare(want: list[str]) -> int:
    """Words that a notice may have more than its template."""
    return max(2, len(want) // 4)


class Scanner:
    def __init__(self, templates: dict[str, str] | list[tuple[str, str]]) -> None:
        pairs = list(templates.items()) if isinstance(templates, dict) else templates
        self.names = [name for name, _ in pairs]
        self.words = [plain(t) for _, t in pairs]
        if not all(self.words):
            raise ValueError("a license template needs at least one word")
        self._bags = [Counter(w) for w in self.words]
        self._enough = [len(w) if len(w) < SHORT else math.ceil(COVERAGE * len(w)) for w in self.words]
        self._alone = zstandard.ZstdCompressor(level=9)
        self._given, self._own = [], []
        self.cues: dict[str, list[tuple[int, int]]] = defaultdict(list)     # word -> (template, position in it)
        for t, w in enumerate(self.words):
            low = " ".join(w).encode()
            known = zstandard.ZstdCompressionDict(low, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=9)
            self._given.append(zstandard.ZstdCompressor(level=9, dict_data=known))
            self._own.append(max(1, len(self._alone.compress(low)) - len(self._given[t].compress(low))))
            for p in sorted(range(len(w)), key=lambda p: (-len(w[p]), w[p], p))[:len(w) - self._enough[t] + 1]:
                self.cues[w[p]].append((t, p))

    def blocks(self, met: list[tuple[int, str]], n: int) -> list[tuple[int, int, int]]:
        """(template, first word, end) of the candidate blocks of a document of n words; ``met``: (position, cue)."""
        starts: dict[int, set[int]] = defaultdict(set)
        for at, cue in met:
            for t, p in self.cues[cue]:
                starts[t].add(at - p)
        out = []
        for t, places in starts.items():
            size, less, more = len(self.words[t]), len(self.words[t]) - self._enough[t], _spare(self.words[t])
            group: list[int] = []
            for s in [*sorted(places), math.inf]:       # cues of one notice differ by the words it has more or less
                if group and s - group[0] > less + more:
                    out.append((t, max(0, group[0] - more - less), min(n, group[-1] + size + more + 2 * less)))
                    group = []
                group.append(s)
        return out

    def saving(self, block: list[str], template: int) -> tuple[float, int]:
        """(share of what the template saves on its own text, bytes) that knowing the template saves."""
        low = " ".join(block).encode()
        saved = len(self._alone.compress(low)) - len(self._given[template].compress(low))
        return saved / self._own[template], saved

    def winners(self, blocks: list[tuple[int, int, list[str]]]) -> list[tuple[float, int, int, int, list[str]]]:
        """(relative saving, template, bytes saved, first word, words) of the (template, first word, words) not under the floor, best first."""
        ranked = [(*self.saving(words, t), t, lo, words) for t, lo, words in blocks]
        return sorted(((share, t, saved, lo, words) for share, saved, t, lo, words in ranked if share >= FLOOR or len(self.words[t]) < SHORT),
                      key=lambda x: (-x[0], x[1], x[3]))

    def confirm(self, block: list[str], template: int) -> list[tuple[float, int, int, str]]:
        """(share of the template's words present in order and close together, first, end, differences) of every place with enough of them."""
        want, enough = self.words[template], self._enough[template]
        spare, out, done = _spare(want), {}, 0
        if sum((Counter(block) & self._bags[template]).values()) < enough:
            return []
        head = {w: k for k, w in reversed(list(enumerate(want[:len(want) - enough + 1])))}     # one of these must be there
        for at in sorted({max(0, i - head[w]) for i, w in enumerate(block) if w in head}):
            part = block[at:at + len(want) + spare]
            if at < done or sum((Counter(part) & self._bags[template]).values()) < enough:
                continue
            best = None
            for near in (part, part[:len(want)]):       # without the spare words, which may begin a repeat
                ops = SequenceMatcher(None, want, near, autojunk=False).get_opcodes()
                equal = [op for op in ops if op[0] == "equal"]
                same = sum(i2 - i1 for _, i1, i2, _, _ in equal)
                if same >= enough and (best is None or same > best[0]):
                    begin, end = equal[0][3], equal[-1][4]
                    diff = []
                    for op, i1, i2, j1, j2 in ops:
                        if j2 <= begin:         # words in front of the notice are none of it, but those that took the place of its first
                            j1 = max(j1, j2 - (i2 - i1))
                        if op != "equal" and j1 < end and (i1 < i2 or j1 < j2):
                            diff.append(f"{op}: {' '.join(want[i1:i2])} -> {' '.join(near[j1:j2])}")
                    best = (same, begin, end, "; ".join(diff))
                if same == len(want):
                    break
            if best:
                same, first, end, diff = best
                out.setdefault((same / len(want), at + first, at + end), diff)
                if not diff and same == len(want):      # no better place begins inside an exact one
                    done = at + end
        return [(*place, diff) for place, diff in out.items()]

    def candidates(self, blocks: list[tuple[int, int, list[str]]]) -> list[tuple[str, int, int, float, int, str, int]]:
        """Every place of the winners: (name, first, end, coverage, saved bytes, differences, words that agree less those that don't)."""
        found: dict[tuple, tuple] = {}
        for _, t, saved, lo, block in self.winners(blocks):
            for cover, first, end, diff in self.confirm(block, t):
                first, end = lo + first, lo + end
                agree = round((3 * cover - 1) * len(self.words[t])) - (end - first)
                found.setdefault((t, first, end, cover, diff), (self.names[t], first, end, cover, saved, diff, agree))
        return list(found.values())

    def scan(self, words: list[str]) -> list[tuple[str, int, int, float, int, str]]:
        """Confirmed notices among the words of a text: (name, first, end, coverage, saved bytes, differences); of overlapping ones the best."""
        met = [(i, w) for i, w in enumerate(words) if w in self.cues]
        return resolved(self.candidates([(t, lo, words[lo:hi]) for t, lo, hi in self.blocks(met, len(words))]))


def resolved(hits: list[tuple[str, int, int, float, int, str, int]]) -> list[tuple[str, int, int, float, int, str]]:
    """Of overlapping notices the best: most words that agree less those missing or in between, so a text is not taken for a notice in it."""
    out: list = []
    starts: list[int] = []                      # of the kept ones, which do not overlap, in order
    ends: list[int] = []
    for h in sorted(hits, key=lambda h: (-h[6], -h[3], h[5] != "", -(h[2] - h[1]), -h[4], h[1], h[0])):
        i = bisect_left(starts, h[2])           # the last kept one that begins before this one's end
        if not i or ends[i - 1] <= h[1]:
            starts.insert(i, h[1])
            ends.insert(i, h[2])
            out.append(h[:6])
    return out


def licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """A row for each notice found: doc_id, license, its words [start_word, end_word), coverage, bytes saved, differences."""
    pairs = list(templates.items()) if templates is not None else [*TEMPLATES.items(), *TEXTS.items()]
    Scanner(pairs)              # a faulty template is an error here, not in the tasks

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(pairs)
        cues = sorted(scanner.cues)
        flat = np.frombuffer("".join(cues).encode(), np.uint8)
        size = np.array([len(c.encode()) for c in cues], np.int64)
        wanted = span_hash(flat, np.cumsum(size) - size, np.cumsum(size))
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            out = []
            for a, _, buf, off in slices(batch.column("text")):
                low = lowered(buf)
                wide = np.flatnonzero((low[:-1] == 0xC2) & (low[1:] == 0xA0))       # no-break spaces
                low[wide] = low[wide + 1] = 0x20
                start, end, row = words(low, off)
                s, e = start, end
                while True:
                    front = (s < e) & _PUNCT[low[np.minimum(s, len(low) - 1)]] if len(s) else s > e
                    if not front.any():
                        break
                    s = s + front
                while True:
                    back = (s < e) & _PUNCT[low[e - 1]] if len(s) else s > e
                    if not back.any():
                        break
                    e = e - back
                at = np.flatnonzero(s < e)              # words, without those of punctuation alone
                own, first = row[at], np.searchsorted(row, np.arange(len(off)))
                cue = np.flatnonzero(np.isin(span_hash(low, s[at], e[at]), wanted)) if len(at) else at
                begin = np.searchsorted(own, np.arange(len(off)))
                for r in np.unique(own[cue]).tolist():
                    place = at[begin[r]:begin[r + 1]]

                    def text(lo: int, hi: int) -> list[str]:
                        return [low[s[i]:e[i]].tobytes().decode("utf-8", "replace") for i in place[lo:hi].tolist()]

                    met = [(c, text(c, c + 1)[0]) for c in (cue[own[cue] == r] - begin[r]).tolist()]
                    blocks = scanner.blocks([(c, w) for c, w in met if w in scanner.cues], len(place))
                    hits = resolved(scanner.candidates([(t, lo, text(lo, hi)) for t, lo, hi in blocks]))
                    out += [(ids[a + r], name, int(place[i] - first[r]), int(place[j - 1] - first[r]) + 1, *rest) for name, i, j, *rest in hits]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.string()]
            cols = list(zip(*out)) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[f.split()[0] for f in FOUND.split(", ")])

    return documents(docs).mapInArrow(rows, FOUND).withColumn("coverage", F.round("coverage", 6))
