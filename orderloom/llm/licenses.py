"""License scan: MinHash bands over overlapping text windows retrieve templates, containment verifies.

Windows are counted in five-word shingles. For templates of up to 2s shingles, windows of 3s shingles
start every s, so each occurrence lies whole in some window. The number of bands follows from the least
Jaccard similarity that a window around a sufficient match can have, so that the chance of missing it
is at most ``MISS``. A window that shares a band with a template is verified by exact containment.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import prepare
from orderloom.llm.decontam import WordHashes, word_hashes

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
MISS = 0.001

# Notices and texts of common licenses, in the usual wording.
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
    associated documentation files (the "Software"), to deal in the Software without restriction, including without
    limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
    Software, and to permit persons to whom the Software is furnished to do so"""
_BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted
    provided that the following conditions are met:"""
_BSD_CLAUSES = """1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
    following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
    conditions and the following disclaimer in the documentation and/or other materials provided with the
    distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
    promote products derived from this software without specific prior written permission."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
    IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
    PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
    INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
    SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
    THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN
    ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _gnu(name: str, version: str, mark: str = ":", by: str = ",") -> str:
    return f"""This program is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {name}
        General Public License as published by the Free Software Foundation{by} either version {version} of the License, or
        (at your option) any later version."""


TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied.""",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        f"""{_MIT_GRANT}, subject to the following conditions: The above copyright notice and this permission notice
        shall be included in all copies or substantial portions of the Software.""",
    ),
    (
        "MIT-0",
        f"""{_MIT_GRANT}. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
        BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY""",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", _gnu("", "3")),
    ("GPL-2.0", _gnu("", "2", ";", ";")),
    ("LGPL-3.0", _gnu("Lesser", "3")),
    ("LGPL-2.1", _gnu("Lesser", "2.1", ";", ";")),
    ("AGPL-3.0", _gnu("Affero", "3")),
    ("BSD", _BSD_CONDITIONS),
    ("BSD-2-Clause", f"{_BSD_CONDITIONS} {_BSD_CLAUSES} {_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", f"{_BSD_CONDITIONS} {_BSD_CLAUSES} {_BSD_THIRD} {_BSD_DISCLAIMER}"),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    ),
    (
        "0BSD",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES""",
    ),
    (
        "Zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
        held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
        software for any purpose, including commercial applications, and to alter it and redistribute it freely,
        subject to the following restrictions:""",
    ),
    (
        "BSL-1.0",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software
        and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute,
        execute, and transmit the Software, and to prepare derivative works of the Software""",
    ),
    (
        "Unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,
        for any purpose, commercial or non-commercial, and by any means.""",
    ),
    (
        "EPL-2.0",
        """This program and the accompanying materials are made available under the terms of the Eclipse Public License
        2.0 which is available at""",
    ),
    (
        "EPL-1.0",
        """All rights reserved. This program and the accompanying materials are made available under the terms of the
        Eclipse Public License v1.0 which accompanies this distribution""",
    ),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
    (
        "CC0-1.0",
        """To the extent possible under law, the author has waived all copyright and related or neighboring rights to
        this work.""",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
)

_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(words: np.ndarray) -> np.ndarray:
    """Hash of every run of five words."""
    n = len(words) - SHINGLE_WORDS + 1
    total, factor = np.zeros(max(0, n), np.uint64), np.uint64(0x9E3779B97F4A7C15)
    for at in range(SHINGLE_WORDS if n > 0 else 0):
        total += words[at : at + n]
        total *= factor
    return total ^ (total >> np.uint64(31))


def bands(step: int, least: int) -> int:
    """Single-hash bands that find a sufficient match with probability ``1 - MISS``, for ``least`` shingles."""
    need = math.ceil(CONTAINMENT * least)
    similarity = need / (3 * step + least - need)
    return math.ceil(math.log(MISS) / math.log(1 - similarity)) if similarity < 1 else 1


class Templates:
    """Templates by window size, with the buckets of their bands."""

    def __init__(self, templates: tuple[tuple[str, str], ...]) -> None:
        words = WordHashes()
        self.names = [name for name, _ in templates]
        whole = [shingles(word_hashes(words, text)) for _, text in templates]
        self.shingles, self.lengths = [np.unique(x) for x in whole], [len(x) for x in whole]
        if not all(len(x) for x in self.shingles):
            raise ValueError(f"a template needs {SHINGLE_WORDS} words")
        by_step = defaultdict(list)
        for number, length in enumerate(self.lengths):
            by_step[1 << max(0, math.ceil(math.log2(length / 2)))].append(number)
        self.steps = {}
        for step, numbers in by_step.items():
            many = max(bands(step, len(self.shingles[k])) for k in numbers)
            factors = (np.random.default_rng(step).integers(1, 1 << 62, many).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
            buckets = []
            for factor in factors:
                keys = np.asarray([_mixed(self.shingles[k], factor).min() for k in numbers])
                order = np.argsort(keys)
                buckets.append((factor, keys[order], np.asarray(numbers)[order]))
            self.steps[step] = buckets

    def candidates(self, texts: list[np.ndarray]) -> set[tuple[int, int, int, int]]:
        """(row, template, first and last shingle of the window) that share a band."""
        found = set()
        for step, buckets in self.steps.items():
            # two empty blocks between rows, so no window reaches into another row
            blocks = [-(-len(x) // step) + 2 for x in texts]
            starts = np.cumsum([0, *blocks])
            stream = np.full(starts[-1] * step, _LAST)
            for row, mine in enumerate(texts):
                stream[starts[row] * step : starts[row] * step + len(mine)] = mine
            empty = stream == _LAST
            for factor, keys, numbers in buckets:
                mixed = _mixed(stream, factor)
                mixed[empty] = _LAST
                least = mixed.reshape(-1, step).min(axis=1) if step > 1 else mixed
                least = np.minimum(np.minimum(least[:-2], least[1:-1]), least[2:]) if len(least) > 2 else least[:0]
                spot = np.searchsorted(keys, least)
                spot[spot == len(keys)] = 0
                for window in np.flatnonzero(keys[spot] == least).tolist():
                    row = int(np.searchsorted(starts, window, side="right")) - 1
                    at = (window - int(starts[row])) * step
                    low, high = np.searchsorted(keys, least[window], "left"), np.searchsorted(keys, least[window], "right")
                    found |= {(row, int(k), at, at + 3 * step) for k in numbers[low:high]}
        return found

    def matches(self, batch: list[str | None], words: WordHashes) -> Iterator[tuple[int, int, int, float]]:
        """(row, template, first word, containment): the best window of each row and template.

        Variants of a license share most of their words: a match is passed over where it overlaps one of another
        license that holds more shingles of the text.
        """
        texts = [shingles(word_hashes(words, text)) for text in batch]
        best: dict[int, dict[int, tuple[int, int, int]]] = defaultdict(dict)
        for row, number, low, high in sorted(self.candidates(texts)):
            mine = self.shingles[number]
            many, first, last = _fullest(texts[row][low:high], mine, self.lengths[number])
            if many >= CONTAINMENT * len(mine) and many > best[row].get(number, (0, 0, 0))[0]:
                best[row][number] = (many, low + first, low + last)
        for row, found in sorted(best.items()):
            for number, (many, first, last) in sorted(found.items()):
                others = ((k, *x) for k, x in found.items() if self.names[k] != self.names[number])
                if not any(more > many and low <= last and first <= high for _, more, low, high in others):
                    yield row, number, first, many / len(self.shingles[number])


def _fullest(window: np.ndarray, template: np.ndarray, length: int) -> tuple[int, int, int]:
    """(different shingles of the template, first and last of them) in the fullest stretch of ``length`` shingles."""
    at = np.flatnonzero(np.isin(window, template))
    which = np.searchsorted(template, window[at]).tolist()
    held: dict[int, int] = {}
    best, low = (0, 0, 0), 0
    for high, place in enumerate(at.tolist()):
        held[which[high]] = held.get(which[high], 0) + 1
        while place - at[low] >= length:
            held[which[low]] -= 1
            if not held[which[low]]:
                del held[which[low]]
            low += 1
        if len(held) > best[0]:
            best = (len(held), int(at[low]), place)
    return best


def _mixed(hashes: np.ndarray, factor: np.uint64) -> np.ndarray:
    made = hashes * factor
    return made ^ (made >> np.uint64(32))


def scan(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, license, template, first_word, containment) for every row and template it holds.

    Where templates of several licenses fit one place, that with most shingles of the text counts. ``containment`` is
    the share of the template's five-word shingles within a stretch of the template's length, 0.8 or more.
    Words are compared lower-cased and without the marks around them. Null texts and texts of fewer than
    five words hold none; repeated rows each give rows; null ids are carried; other columns are not
    read; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    known = Templates(templates)
    out = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("license", T.StringType()),
            T.StructField("template", T.IntegerType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("containment", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            found = list(known.matches(batch.column(1).to_pylist(), words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array([f[0] for f in found], pa.int64())),
                    pa.array([known.names[f[1]] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.int32()),
                    pa.array([f[2] for f in found], pa.int64()),
                    pa.array([f[3] for f in found], pa.float64()),
                ],
                names=out.fieldNames(),
            )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, out)
