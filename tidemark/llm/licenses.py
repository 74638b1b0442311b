"""License notices in documents, found by conditional compression.

A text is read in windows of words, twice as long as the longest template and overlapping by half, so that every notice
lies whole in the window in whose first half it begins. A window is a candidate block if it has the words of any template, but
for the share that may be missing. A candidate is compressed alone and with each of the templates as a raw-content
dictionary. In the order of the reductions the templates are confirmed by their exact wording differences, and the first that is
confirmed is the notice; no template is left out of that order. What is left of the block before and behind the notice is
ranked again. Templates and texts are compared as lower-case words without punctuation.
"""

from __future__ import annotations

import difflib
import itertools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.helpers import arrow_map

#: Share of a template's words that may be missing, and that there may be of others between them.
DIFFERENT = 0.2

# Notices by which works state their licenses, in their usual wording.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission.",
    ],
    "BSD-2-Clause": [
        "Released under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details.",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later "
        "version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more "
        "details.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more "
        "details.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more "
        "details.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0."],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0."],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0."],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software.",
    ],
}
#: Names by which short sentences call a license; BSD alone tells no version.
CALLED = {"MIT": "MIT", "ISC": "ISC", "Zlib": "zlib", "Apache-2.0": "Apache 2.0", "MPL-2.0": "MPL 2.0", "BSD": "BSD"}

for _name, _texts in TEMPLATES.items():
    _texts.append(f"SPDX-License-Identifier: {_name}")
for _name, _called in CALLED.items():
    TEMPLATES.setdefault(_name, []).extend([f"This project is {_called} licensed.", f"Distributed under the {_called} license."])

_WORD = re.compile(r"[A-Za-z0-9]+")


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class LicenseScanner:
    def __init__(self, templates: dict[str, list[str]]):
        self.templates = [(name, words) for name, texts in sorted(templates.items()) for words in map(_words, texts)]
        self.alone = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.given = [
            zstandard.ZstdCompressor(
                level=3, write_content_size=False,
                dict_data=zstandard.ZstdCompressionDict(" ".join(w).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for _, w in self.templates
        ]
        self.allowed = [int(DIFFERENT * len(w)) for _, w in self.templates]
        self.kinds = [frozenset(w) for _, w in self.templates]
        self.vocabulary = frozenset().union(*self.kinds)
        #: The most words of a notice.
        self.longest = max(len(w) + m for (_, w), m in zip(self.templates, self.allowed, strict=True))
        # What a template has and a similar one of another license has not; a notice must have it, but for the share that may be missing.
        self.own = [
            [
                own for other, t in self.templates
                if other != name and (own := set(w) - set(t)) and difflib.SequenceMatcher(None, w, t, autojunk=False).ratio() > 1 - 2 * DIFFERENT
            ]
            for name, w in self.templates
        ]

    def scan(self, text: str) -> Iterator[tuple[int, int, str, float, int, int]]:
        """(start, length, license, reduction, missing words, other words) of each notice, in their order.

        start and length are those of the notice in characters, reduction is the share by which its template shrinks the block.
        """
        # The words of the window alone are held, however long the text is.
        for spans, notices in self._windows((m.start(), m.end(), m.group().lower()) for m in _WORD.finditer(text)):
            for first, last, *notice in notices:
                yield (spans[first][0], spans[last - 1][1] - spans[first][0], *notice)

    def _windows(self, words: Iterable[tuple[int, int, str]]) -> Iterator[tuple[list, list]]:
        """Windows with the notices that begin in their first halves; the last window has all of its own."""
        words, held = iter(words), []
        while True:
            held += itertools.islice(words, 2 * self.longest - len(held))
            ended = len(held) < 2 * self.longest
            half = len(held) if ended else self.longest
            found = sorted(n for n in self._notices([w for _, _, w in held]) if n[0] < half)
            if found:
                yield held, found
            if ended:
                return
            # A notice that reaches into the second half is over; the next window begins behind it.
            held = held[max([half, *(n[1] for n in found)]) :]

    def _notices(self, words: list[str]) -> list[tuple[int, int, str, float, int, int]]:
        """(start, end, license, reduction, missing, others) of the notices of a window, which don't overlap."""
        notices, blocks = [], [(0, len(words))]
        while blocks:
            start, end = blocks.pop()
            winner = self._winner(words[start:end])
            if winner is not None:
                first, last, *notice = winner
                notices.append((start + first, start + last, *notice))
                blocks += [(start, start + first), (start + last, end)]
        return notices

    def possible(self, words: list[str]) -> set[int]:
        """The templates of which a block has so many words that it may be confirmed."""
        there = self.vocabulary.intersection(words)
        if len(there) < 3:
            return set()
        return {i for i, kinds in enumerate(self.kinds) if len(kinds - there) <= self.allowed[i]}

    def reductions(self, words: list[str]) -> list[tuple[float, int]]:
        """(reduction, template) of a block by every template, largest first."""
        data = " ".join(words).encode()
        alone = len(self.alone.compress(data))
        return sorted(((1 - len(c.compress(data)) / alone, i) for i, c in enumerate(self.given)), key=lambda r: (-r[0], r[1]))

    def _winner(self, words: list[str]) -> tuple[int, int, str, float, int, int] | None:
        """The confirmed template of the largest reduction; of several with that, the one that differs least for its length."""
        possible = self.possible(words)
        if not possible:
            return None
        for reduction, ranked in itertools.groupby(self.reductions(words), key=lambda r: r[0]):
            places = [p for _, i in ranked if i in possible and (p := self._place(i, words)) is not None]
            if places:
                start, end, missing, others, i = min(places, key=lambda p: (p[2] + p[3] - (p[1] - p[0]), p))
                return start, end, self.templates[i][0], reduction, missing, others
        return None

    def _place(self, i: int, words: list[str]) -> tuple[int, int, int, int, int] | None:
        """(start, end, missing, others, i) of the place where the wording differs least from template i, if little enough."""
        template, allowed = self.templates[i][1], self.allowed[i]
        step = len(template) + allowed
        found = []
        for at in range(0, max(1, len(words) - step), step):
            window = words[at : at + 2 * step]
            if len(self.kinds[i].difference(window)) > allowed:
                continue
            matcher = difflib.SequenceMatcher(None, template, window, autojunk=False)
            runs = [m for m in matcher.get_matching_blocks() if m.size]
            for k, first in enumerate(runs):
                same = 0
                for last in runs[k:]:
                    same += last.size
                    others = last.b + last.size - first.b - same
                    missing = len(template) - same
                    if missing <= allowed and others <= allowed:
                        have = set(words[at + first.b : at + last.b + last.size])
                        if all(len(own - have) <= int(DIFFERENT * len(own)) for own in self.own[i]):
                            found.append((missing + others, at + first.b, at + last.b + last.size, missing, others, i))
        return min(found)[1:] if found else None


def license_notices(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """(doc_id, start, length, license, reduction, missing, others) of every notice; start and length count characters.

    Null and empty texts have none; doc_id may be null or repeated, and repeated rows have their notices each. Other columns
    are not read.
    """
    templates = templates or TEMPLATES
    scanners: list[LicenseScanner] = []

    def work(batch: pa.RecordBatch):
        if not scanners:
            scanners.append(LicenseScanner(templates))
        rows = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            rows += [(doc, *found) for found in scanners[0].scan(text.as_py() or "")]
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64())
            names = ["doc_id", "start", "length", "license", "reduction", "missing", "others"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
            )

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(
        columns, work,
        "doc_id long, start long, length long, license string, reduction double, missing long, others long",
    )
