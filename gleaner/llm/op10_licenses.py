"""License scan by conditional compression.

Paragraphs with licensing words and those beside them make a block, so a notice may be wrapped,
commented out or run over paragraphs. In a block every place where a piece of a template stands
is a candidate window of the template's length. It is compressed once plainly and once with
the template as a raw zstandard dictionary, and the windows are ranked by the bytes that this saves.
In that order the exact difference in wording confirms a license and says which words are
missing or added; a window whose words a better one has taken is left out, so of a whole text and
the notices within it the whole text is reported. With fewer differences than pieces one
piece is always literal, so ranking decides between windows and never hides one.

The JVM tests whole texts for licensing words before any leaves it. Each text is handled alone, so
nothing is shuffled.
"""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import batches

CUE = r"licen[cs]e|copyright|all rights reserved|permission is hereby|public domain|redistribution and use|without warranty"
#: The share of a template's words that may differ.
DIFFERENT = 0.1

#: Words that, one of the two before a notice, deny it; a name of a few words is denied from further off in its clause.
REFUSED = {"not", "never", "isn't", "nor"}
CLOSE, FAR, NAME = 2, 8, 5

# Fixed wordings of public licenses and notices.
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
    "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
    "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
    "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
    "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission. "
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
    "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies. "
)
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "MIT License", "The MIT License (MIT)",
        _MIT,
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.", "BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
        _BSD_START + _BSD_THIRD + _BSD_END,
    ),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", "BSD 2-Clause License", _BSD_START + _BSD_END),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "ISC": (
        _ISC + "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
        "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        _ISC.strip(),
    ),
    "Zlib": (
        "Licensed under the zlib License.",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
        "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
        "including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you "
        "use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution.",
    ),
    "BSL-1.0": (
        "Boost Software License - Version 1.0",
        "Distributed under the Boost Software License, Version 1.0.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",),
    "CC0-1.0": ("This work has been released into the public domain under the CC0 1.0 Universal dedication.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "all-rights-reserved": ("All rights reserved.",),
}

# Every license is also known by its tag; so are the texts that are named with "only" and "or later".
TAG = "SPDX-License-Identifier: {}"
for _name in [n for n in TEMPLATES if n != "all-rights-reserved"]:
    _forms = [_name, f"{_name}-only", f"{_name}-or-later"] if "GPL" in _name else [_name]
    TEMPLATES[_name] = (*TEMPLATES[_name][:-1], *(TAG.format(f) for f in _forms), TEMPLATES[_name][-1])

_WORD = re.compile(r"\w+(?:[.'-]\w+)*")


def words_of(text: str) -> list[tuple[str, int, int]]:
    return [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


class Templates:
    def __init__(self, templates: dict[str, tuple[str, ...]]):
        self.entries = []
        #: First word of a piece to (words of the piece, template, place in it).
        self.pieces: dict[str, list[tuple[list[str], int, int]]] = {}
        for name, wordings in templates.items():
            for wording in wordings:
                folded = " ".join(w for w, _, _ in words_of(wording))
                data = zstandard.ZstdCompressionDict(folded.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                wanted = folded.split()
                # With so many differences one of the pieces is still whole.
                n = int(DIFFERENT * len(wanted)) + 1
                cuts = [len(wanted) * i // n for i in range(n + 1)]
                for x, y in zip(cuts, cuts[1:]):
                    self.pieces.setdefault(wanted[x], []).append((wanted[x:y], len(self.entries), x))
                self.entries.append((name, wanted, zstandard.ZstdCompressor(level=3, dict_data=data)))
        self.plain = zstandard.ZstdCompressor(level=3)

    def saved(self, data: bytes, entry: int) -> int:
        """The bytes by which a template as dictionary makes a text smaller."""
        return len(self.plain.compress(data)) - len(self.entries[entry][2].compress(data))

    def placements(self, part: list[tuple[str, int, int]]) -> list[tuple]:
        """(first, last, name, saving, missing words, added words) of the templates that stand here, by falling bytes saved, none on words of another."""
        folded = [w for w, _, _ in part]
        starts = set()
        for i, w in enumerate(folded):
            for piece, entry, at in self.pieces.get(w, ()):
                if folded[i : i + len(piece)] == piece:
                    starts.add((entry, max(0, i - at)))
        ranked = []
        for entry, start in starts:
            data = " ".join(folded[start : start + len(self.entries[entry][1])]).encode()
            ranked.append((-self.saved(data, entry), start, entry, len(data)))
        out, taken = [], bytearray(len(folded))
        for saved, start, entry, size in sorted(ranked):
            found = self.placed(folded, part, entry, start)
            if found and not any(taken[found[0] : found[1]]):
                first, last, denied, *words = found
                taken[first:last] = b"\1" * (last - first)  # what is denied hides the shorter notices in it, too
                if not denied:
                    out.append((first, last, self.entries[entry][0], max(0, -saved) / max(size, 1), *words))
        return out

    def placed(self, folded: list[str], part: list[tuple[str, int, int]], entry: int, start: int) -> tuple | None:
        """(first, last, whether it is denied, missing words, added words) of a template around a place, if so few of its words differ."""
        wanted = self.entries[entry][1]
        slack = int(DIFFERENT * len(wanted))
        low = max(0, start - slack)
        window = folded[low : start + len(wanted) + slack]
        matches = [m for m in SequenceMatcher(None, wanted, window, autojunk=False).get_matching_blocks() if m.size]
        matches = _tight(matches, len(wanted))
        if not matches:
            return None
        first, last = matches[0].b, matches[-1].b + matches[-1].size
        same = sum(m.size for m in matches)
        if len(wanted) + last - first - 2 * same > DIFFERENT * len(wanted):
            return None
        covered = {i for m in matches for i in range(m.a, m.a + m.size)}
        inside = {i for m in matches for i in range(m.b, m.b + m.size)}
        # Another number is another version.
        numbers = any(any(c.isdigit() for c in w) for i, w in enumerate(wanted) if i not in covered)
        after = folded[low + last : low + last + 1]
        later = wanted[-1][-1].isdigit() and after and after[0].isdigit()
        if numbers or later:
            return None
        at, denied = low + first, False
        for back in range(1, (FAR if len(wanted) <= NAME else CLOSE) + 1):
            i = at - back
            if i < 0 or back > CLOSE and part[i + 1][1] - part[i][2] > 1:  # more than a space ends the clause
                break
            denied = denied or folded[i] in REFUSED
        return (low + first, low + last, denied, " ".join(w for i, w in enumerate(wanted) if i not in covered),
                " ".join(window[i] for i in range(first, last) if i not in inside))

    def confirm(self, block: list[tuple[str, int, int]]) -> list[tuple]:
        """(start, end, name, saving, missing words, added words) of all licenses a block holds."""
        out, left = [], [block]
        # What confirmed spans leave uncovered is searched again until nothing is found.
        while left:
            part = left.pop()
            spans = []
            for first, last, *rest in self.placements(part):
                spans.append((first, last))
                out.append((part[first][1], part[last - 1][2], *rest))
            if spans:
                at = 0
                for first, last in [*sorted(spans), (len(part), len(part))]:
                    if first > at:
                        left.append(part[at:first])
                    at = last
        return out


def _tight(matches: list, length: int) -> list:
    """Leave out matching runs that lie further off than the whole template is long."""
    if not matches:
        return []
    core = max(matches, key=lambda m: m.size)
    return [m for m in matches if abs((m.b - m.a) - (core.b - core.a)) <= max(1, length // 5)]


def blocks(text: str, cue: re.Pattern) -> list[tuple[int, int]]:
    """(start, end) of the runs of paragraphs with licensing words and the paragraph before and after each."""
    paragraphs = [m.span() for m in re.finditer(r"(?:[^\n]*\S[^\n]*(?:\n|$))+", text)]
    wanted = set()
    for i, (start, end) in enumerate(paragraphs):
        if cue.search(text, start, end):
            wanted |= {i - 1, i, i + 1}
    out: list[tuple[int, int]] = []
    before = None
    for i in sorted(wanted & set(range(len(paragraphs)))):
        start, end = paragraphs[i]
        if before == i - 1 and out:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
        before = i
    return out


def find(text: str, templates: Templates, cue: re.Pattern) -> list[tuple]:
    """(start, end, name, saving, missing words, added words) of the licenses of one text, in order of place."""
    return sorted(
        (start + a, start + b, *rest) for start, end in blocks(text, cue) for a, b, *rest in templates.confirm(words_of(text[start:end])))


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_licenses, licenses, best_saving, missing, added.

    ``licenses`` lists name:start:end in order of place, in code points, end exclusive;
    ``missing`` and ``added`` count words by which they differ from their templates; a number of
    the template is never among the missing, so other versions are not reported, and neither
    are notices that a word like "not" denies. ``best_saving`` is the largest share of a window's
    bytes that its template saves. Only paragraphs with a licensing word and those beside them
    are searched. Null and
    empty texts hold none; rows may repeat and ids may be null. An empty table gives an empty
    result; other columns are ignored.
    """
    chosen = templates or TEMPLATES

    def run(frames):
        ready, cue = Templates(chosen), re.compile(CUE, re.I)
        for frame in frames:
            n, names, saving, missing, added = [], [], [], [], []
            for text in frame.column("text").to_pylist():
                found = find(text, ready, cue) if text else []
                n.append(len(found))
                names.append(",".join(f"{f[2]}:{f[0]}:{f[1]}" for f in found))
                saving.append(max((f[3] for f in found), default=0.0))
                missing.append(sum(len(f[4].split()) for f in found))
                added.append(sum(len(f[5].split()) for f in found))
            yield pa.RecordBatch.from_pydict({
                "doc_id": frame.column("doc_id"), "n_licenses": pa.array(n, pa.int64()), "licenses": pa.array(names, pa.string()),
                "best_saving": pa.array(saving, pa.float64()), "missing": pa.array(missing, pa.int64()), "added": pa.array(added, pa.int64()),
            })

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(F.col("text").rlike(f"(?i){CUE}"), F.col("text")).alias("text"))
    return batches(slim, run, "doc_id long, n_licenses long, licenses string, best_saving double, missing long, added long")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License wordings in every text of ``documents``."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
