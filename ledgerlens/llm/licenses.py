"""License scans by conditional compression.

Words that speak of licences are cues. Around each cue as many words are taken, over line ends and blank lines, as a notice that holds the
cue can reach; stretches that touch are one block. Blocks are compressed with zstandard, alone and with each template as raw dictionary: a template that saves too few bytes of a block is out.
Long blocks are compressed in overlapping parts, each wide enough to hold any notice whole, so that the room around a notice does not hide it.
Within a part the stretches that a template could explain are compressed in the same way, and all stretches of a block are ranked by the bytes saved. In that order a
stretch wins if no better one covers it and its exact wording differences confirm it: the words of the template missing there and the words added. A word put in the place of another is one difference.
A notice is so found wherever it stands, wrapped or not, and as often as it is repeated.

Rows are worked on where they lie, without a shuffle; compressors are made once per worker.

Defined results: a null or empty text has no block; repeated rows get equal rows; other columns are ignored; an empty
table gives an empty result. A finding starts and ends with the lines it stands on. Texts of any length are searched whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlens.llm.arrow import filled, pieces
from ledgerlens.llm.text import only

#: Words one of which every block contains.
CUE = re.compile(r"(?i)licen[cs]|copyright|warrant|redistribut|permission is|public domain|spdx|as is|without limitation")
#: What a template must save of a stretch, as a part of its own compressed bytes; and the share of its words that must
#: stand there in order.
SAVED, AGREED = 0.25, 0.8

#: Short notices of public licences (fixed values: their usual wording).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has dedicated all copyright to this work to the public domain under CC0 1.0.",
}

_WORDS = re.compile(r"\w+(?:[.-]\w+)*")


def wording(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def most_differing(size: int) -> float:
    """How many words may be missing from, or added to, a template of so many."""
    return (1 - AGREED) * size + 1


def confirmed(size: int, missing: int, added: int, changed: int) -> bool:
    """Whether a stretch is still the wording of a template: few words missing and added, or few differences where a changed word is one."""
    if size - missing < AGREED * size:
        return False
    return missing + added <= most_differing(size) or changed < (1 - AGREED) * size


def blocks(text: str, reach: int) -> tuple[list[tuple[int, int]], list[str], list[tuple[int, int]]]:
    """First and last but one word of each block: all words up to ``reach`` words from a cue. With the words and their places in the text."""
    cues = [m.span() for m in CUE.finditer(text)]
    if not cues:
        return [], [], []
    found = [m.span() for m in _WORDS.finditer(text)]
    starts, ends = np.array([a for a, _ in found], np.int64), np.array([b for _, b in found], np.int64)
    out: list[tuple[int, int]] = []
    for a, b in cues:
        first = max(int(np.searchsorted(ends, a, "right")) - reach, 0)
        last = min(int(np.searchsorted(starts, b, "left")) + reach, len(found))
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], last
        else:
            out.append((first, last))
    return out, [text[a:b].lower() for a, b in found], found


@dataclass(frozen=True)
class Found:
    license: str
    saved: int
    missing: tuple[str, ...]
    added: tuple[str, ...]


class Matcher:
    """Compressors and wordings of a set of templates."""

    def __init__(self, templates: dict[str, str]) -> None:
        import zstandard

        def size(dictionary: str | None):
            known = zstandard.ZstdCompressionDict(dictionary.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT) if dictionary else None
            made = zstandard.ZstdCompressor(level=9, dict_data=known, write_checksum=False, write_content_size=False)
            return lambda raw: len(made.compress(raw))

        self._alone = size(None)
        self._given = {n: size(self._plain(t)) for n, t in templates.items()}
        self._cost = {n: self._alone(self._plain(t).encode()) for n, t in templates.items()}
        self._wording = {n: wording(t) for n, t in templates.items()}
        self._codes: dict[str, int] = {}
        self._coded = {n: [self._codes.setdefault(w, len(self._codes)) for w in told] for n, told in self._wording.items()}
        longest = max((len(t) for t in self._wording.values()), default=0)
        self.reach = longest + 2 * int(most_differing(longest))

    @staticmethod
    def _plain(text: str) -> str:
        return " ".join(text.split())

    def _raw(self, text: str) -> bytes:
        return self._plain(text).encode()

    def saved(self, name: str, text: str) -> int:
        """Bytes that the template saves of a stretch."""
        raw = self._raw(text)
        return self._alone(raw) - self._given[name](raw)

    @staticmethod
    def _rows(template: list[int], words: np.ndarray) -> Iterator[np.ndarray]:
        """For ever more words of the template, the cost of the best stretch that ends before each word. A differing word costs the
        template's doubled size, a missing one 1 more, so of equal numbers the fewest missing win."""
        unit = 2 * len(template) + 2
        steps = np.arange(len(words) + 1, dtype=np.int64) * unit
        row = np.zeros(len(words) + 1, np.int64)
        yield row
        for code in template:
            new = row + (unit + 1)
            new[1:] = np.where(words == code, np.minimum(new[1:], row[:-1]), new[1:])
            row = np.minimum.accumulate(new - steps) + steps
            yield row

    def _trace(self, name: str, codes: np.ndarray, end: int) -> tuple[int, list[int], list[int], int]:
        """Start of the best stretch that ends at ``end``, the places of the template's words missing in it, and of its added words, and the
        number of differences: between two words that stand there, missing and added words pair up."""
        template = self._coded[name]
        size, unit = len(template), 2 * len(template) + 2
        base = max(end - size - 2 * int(most_differing(size)) - 1, 0)
        rows = list(self._rows(template, codes[base:end]))
        i, j, first, missing, added, changed, gap = size, end - base, end - base, [], [], 0, [0, 0]
        while i:
            if j and codes[base + j - 1] == template[i - 1] and rows[i][j] == rows[i - 1][j - 1]:
                i, j = i - 1, j - 1
                first, changed, gap = j, changed + max(gap), [0, 0]
            elif rows[i][j] == rows[i - 1][j] + unit + 1:
                i -= 1
                missing.append(i)
                gap[0] += 1
            else:
                j -= 1
                added.append(base + j)
                gap[1] += 1
        return base + first, missing[::-1], added[::-1], changed + max(gap)

    def _parts(self, start: int, stop: int) -> Iterator[tuple[int, int]]:
        """Overlapping parts of a block; any stretch of ``reach`` words lies in one of them."""
        while True:
            yield start, min(start + 2 * self.reach, stop)
            if start + 2 * self.reach >= stop:
                return
            start += self.reach

    def _stretches(self, name: str, codes: np.ndarray) -> Iterator[tuple[int, int, list[int], list[int], int]]:
        """Where a template's wording may stand: the best stretch of each end at which fewer words differ than one word before, and not more than one word after."""
        template, held = self._coded[name], set(codes.tolist())
        size = len(template)
        if not size or sum(c in held for c in template) < AGREED * size:
            return
        for row in self._rows(template, codes):
            pass
        # A changed word is a missing and an added one here.
        near = row[1:] // (2 * size + 2) <= 2 * most_differing(size)
        for end in (np.flatnonzero((row[1:] < row[:-1]) & (row[1:] <= np.append(row[2:], row[-1])) & near) + 1).tolist():
            first, missing, added, changed = self._trace(name, codes, end)
            yield first, end, missing, added, changed

    def match(self, text: str) -> tuple[int, list[tuple[int, int, Found]]]:
        """Number of blocks, and the notices in order: those that save most bytes first, no stretch twice."""
        places, words, spans = blocks(text, self.reach)
        taken: list[tuple[int, int, Found]] = []
        for start, stop in places:
            ranked = set()
            for low, high in self._parts(start, stop):
                raw = self._raw(text[spans[low][0] : spans[high - 1][1]])
                alone, codes = self._alone(raw), np.array([self._codes.get(w, -1) for w in words[low:high]], np.int64)
                for name, given in self._given.items():
                    if alone - given(raw) < SAVED * self._cost[name]:
                        continue
                    for first, end, missing, added, changed in self._stretches(name, codes):
                        saved = self.saved(name, text[spans[low + first][0] : spans[low + end - 1][1]])
                        told = tuple(self._wording[name][i] for i in missing), tuple(words[low + k] for k in added)
                        ranked.add((-saved, changed, name, low + first, low + end, told))
            mine: list[tuple[int, int, Found]] = []
            full = np.zeros(stop - start, bool)
            for less, changed, name, first, end, (missing, added) in sorted(ranked):
                fits = -less >= SAVED * self._cost[name] and confirmed(len(self._coded[name]), len(missing), len(added), changed)
                if fits and not full[first - start : end - start].any():
                    full[first - start : end - start] = True
                    mine.append((first, end, Found(name, -less, missing, added)))
            taken += sorted(mine, key=lambda x: x[:2])
        out = []
        for first, end, found in taken:
            a, b = spans[first][0], spans[end - 1][1]
            after = text.find("\n", b)
            out.append((text.rfind("\n", 0, a) + 1, len(text) if after < 0 else after + 1, found))
        return len(places), out


@lru_cache(maxsize=4)
def _matcher(templates: tuple[tuple[str, str], ...]) -> Matcher:
    return Matcher(dict(templates))


FINDINGS = T.ArrayType(T.StructType([
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("license", T.StringType()),
    T.StructField("saved", T.LongType()), T.StructField("missing", T.ArrayType(T.StringType())),
    T.StructField("added", T.ArrayType(T.StringType())),
]))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: number of candidate blocks and the confirmed findings in order."""
    kept, told = docs.schema[doc_id], tuple(templates.items())
    struct = pa.struct([
        ("start", pa.int64()), ("end", pa.int64()), ("license", pa.string()), ("saved", pa.int64()),
        ("missing", pa.list_(pa.string())), ("added", pa.list_(pa.string())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(told)
        for batch in batches:
            for piece in pieces(batch, text):
                counts, findings = [], []
                for t in filled(piece, text).to_pylist():
                    n, found = matcher.match(t)
                    counts.append(n)
                    findings.append([
                        {"start": s, "end": e, "license": f.license, "saved": f.saved, "missing": list(f.missing), "added": list(f.added)}
                        for s, e, f in found
                    ])
                columns = [piece.column(doc_id), pa.array(counts, pa.int64()), pa.array(findings, pa.list_(struct))]
                yield pa.record_batch(columns, [doc_id, "n_blocks", "findings"])

    schema = T.StructType([kept, T.StructField("n_blocks", T.LongType()), T.StructField("findings", FINDINGS)])
    return only(docs, doc_id, text).mapInArrow(run, schema)
