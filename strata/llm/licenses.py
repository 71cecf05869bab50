"""License scan: winnowed fingerprints pick candidates, banded alignment measures them (operator 2)."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm._util import id_type, slices, strings

#: Short license notices: fixed values, a parameter of the operator.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied."),
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
}

_GNU = (" you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software "
        "Foundation; either version {} of the License, or (at your option) any later version.")
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. {}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
    "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.")
TEMPLATES |= {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0-header": "This program is free software:" + _GNU.format("Affero General Public License", 3),
    "BSD-2-Clause-text": _BSD.format(""),
    "BSD-3-Clause-text": _BSD.format(
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. "),
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-header": "This program is free software;" + _GNU.format("General Public License", 2),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "LGPL-2.0-header": "This library is free software;" + _GNU.format("Library General Public License", 2),
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-2.1-header": "This library is free software;" + _GNU.format("Lesser General Public License", 2.1),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0-header": "This program is free software:" + _GNU.format("Lesser General Public License", 3),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."),
}
_CC = {"BY": "", "BY-SA": "-ShareAlike", "BY-ND": "-NoDerivatives", "BY-NC": "-NonCommercial",
       "BY-NC-SA": "-NonCommercial-ShareAlike", "BY-NC-ND": "-NonCommercial-NoDerivatives"}
for _version, _place in (("4.0", "International"), ("3.0", "Unported")):
    for _name, _terms in _CC.items():
        for _kind, _text in (
                ("short", f"Licensed under CC {_name} {_version}."),
                ("notice", "This work is licensed under a Creative Commons "
                           f"Attribution{_terms} {_version} {_place} License.")):
            if _text not in TEMPLATES.values():
                TEMPLATES[f"CC-{_name}-{_version}-{_kind}"] = _text
#: A place has all of these words, and all version numbers, that its template has;
NAMES = frozenset(("apache", "mit", "bsd", "mozilla", "gnu"))
#: and of these words no others.
TERMS = frozenset(("nc", "nd", "sa", "noncommercial", "noderivatives", "noderivs", "sharealike", "lesser", "affero"))
GRAM = 3         # words of a fingerprint
WINDOW = 2       # of consecutive fingerprints the least is kept
BAND = 4         # words that an alignment may drift from its diagonal
COVERAGE = 80    # percent of a template's words that must be matched
_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_VERSION = re.compile(r"v?([0-9]+(?:\.[0-9]+)*?)(?:\.0)*")


def ascii_lowered(text: str) -> str:
    return text.encode().lower().decode()  # A-Z only, so offsets stay


def words_of(low: str) -> list[str]:
    """Words of a lowered text; v3, 3.0 and 3 are one version."""
    return [m.group(1) if "0" <= w[-1] <= "9" and (m := _VERSION.fullmatch(w)) else w for w in _WORD.findall(low)]


class Index:
    """Templates as word ids, and the inverted index of their winnowed fingerprints."""

    def __init__(self, templates: dict[str, str]) -> None:
        self.names = sorted(templates)
        split = [words_of(ascii_lowered(templates[n])) for n in self.names]
        self.words = {w: i for i, w in enumerate(sorted({w for t in split for w in t} | TERMS), 1)}
        self.templates = [[self.words[w] for w in t] for t in split]
        self.terms = {self.words[w] for w in TERMS}
        self.needed = [{self.words[w] for w in t if w in NAMES or w in TERMS or _VERSION.fullmatch(w)} for t in split]
        self.posting: dict[tuple[int, ...], list[tuple[int, int]]] = defaultdict(list)
        for t, ids in enumerate(self.templates):
            grams = [tuple(ids[i:i + GRAM]) for i in range(max(1, len(ids) - GRAM + 1))]
            kept = set()
            for i in range(max(1, len(grams) - WINDOW + 1)):
                at = min(range(i, min(i + WINDOW, len(grams))), key=lambda j: (hash(grams[j]), -j))
                kept.add(at)
            for at in kept:
                self.posting[grams[at]].append((t, at))


def align(doc: list[int], template: list[int], start: int, band: int, reach: int = 0) -> tuple[int, int, int, int]:
    """Most template words matched in order, with the first and last matched place in ``doc``.

    ``start`` is where the template begins on its diagonal; cells further than ``band``
    from it, and from the ``reach`` diagonals behind it, are not visited. A match gains 2, a skipped or replaced word costs 1, so the
    span is as tight as it can be. Returns (matched, first, last + 1, score).
    """
    before: dict[int, tuple[int, int, int, int]] = {}
    best = (0, 0, 0, 0)
    for i, word in enumerate(template):
        now: dict[int, tuple[int, int, int, int]] = {}
        for d in range(-band, reach + band + 1):
            j = start + i + d
            if not 0 <= j < len(doc):
                continue
            # (score, matched, -first, last + 1) of the best path whose last cell is here
            diagonal, up, left = before.get(d), before.get(d + 1), now.get(d - 1)
            options = []
            if doc[j] == word:
                options.append((2, 1, -j, j + 1))
                if diagonal:
                    options.append((diagonal[0] + 2, diagonal[1] + 1, diagonal[2], j + 1))
            elif diagonal:
                options.append((diagonal[0] - 1, *diagonal[1:]))
            if up:
                options.append((up[0] - 1, *up[1:]))
            if left:
                options.append((left[0] - 1, *left[1:]))
            if options:
                now[d] = max(options)
                if now[d] > best:
                    best = now[d]
        before = now
    return best[1], -best[2], best[3], best[0]


def _chained(starts: list[int], size: int, band: int) -> list[tuple[int, int]]:
    """(first, last) of the runs of seed diagonals that one place of a template may join.

    Words put in or left out move the rest of a place to another diagonal, by less than half of
    the template's ``size`` words at the least coverage. Diagonals closer than that are linked, and a
    linked row is cut into windows of that width, each half over the next.
    """
    half = max(1, size // 2)
    out, row = [], []
    for start in [*starts, None]:
        if row and (start is None or start - row[-1] > half):
            low = row[0]
            while True:
                own = row[bisect_left(row, low):bisect_left(row, low + 2 * half)]
                if own and own[-1] - own[0] > band:  # closer ones are in the band of one diagonal
                    out.append((own[0], own[-1]))
                if low + 2 * half > row[-1]:
                    break
                low += half
            row = []
        row.append(start)
    return out


def scan(text: str, index: Index, band: int = BAND, coverage: int = COVERAGE) -> list[tuple[str, int, int, int, int]]:
    """(license, matched words, template words, start, end) of each place, by start.

    Of overlapping places the one with more matched words stays (ties: earlier, then the
    first name); templates of one place share it otherwise.
    """
    low = ascii_lowered(text)
    ids = [index.words.get(w, 0) for w in words_of(low)]
    diagonals: dict[int, set[int]] = defaultdict(set)
    posting, known = index.posting, 0
    for at, word in enumerate(ids):
        known = known + 1 if word else 0
        if known >= GRAM:
            first = at - GRAM + 1
            for t, place in posting.get(tuple(ids[first:at + 1]), ()):
                diagonals[t].add(first - place)
    found = set()
    for t, start, last in [(t, *run) for t, own in diagonals.items() for run in
                           (*((s, s) for s in own), *_chained(sorted(own), len(index.templates[t]), band))]:
        template, needed = index.templates[t], index.needed[t]
        if not needed.issubset(ids[max(0, start - band):max(0, last + len(template) + band)]):
            continue
        matched, first, end, _ = align(ids, template, start, band, last - start)
        place = set(ids[first:end])
        if (100 * matched >= coverage * max(len(template), end - first)  # words put in count, too
                and needed <= place and place & index.terms <= needed):
            found.add((-matched, first, index.names[t], end, len(template)))
    if not found:
        return []
    spans = [m.span() for m in _WORD.finditer(low)]
    taken: list[tuple[int, int]] = []
    out = []
    for negative, first, name, end, size in sorted(found):
        at = bisect_left(taken, (first, end))
        if (at == 0 or taken[at - 1][1] <= first) and (at == len(taken) or end <= taken[at][0]):
            taken.insert(at, (first, end))
            out.append((name, -negative, size, spans[first][0], spans[end - 1][1]))
    return sorted(out, key=lambda m: (m[3], m[0]))


def _scanned(templates: dict[str, str], band: int, coverage: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        for batch in slices(batches):
            ids, rows = batch.column("doc_id").to_pylist(), []
            for doc_id, text in zip(ids, strings(batch.column("text"))):
                rows += [(doc_id, *m) for m in scan(text, index, band, coverage)]
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.column("doc_id").type), pa.array(columns[1], pa.string()),
                 *(pa.array(c, pa.int64()) for c in columns[2:])],
                ["doc_id", "license", "matched_words", "license_words", "start", "end"])
    return run


def license_matches(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id",
                    text_col: str = "text", band: int = BAND, coverage: int = COVERAGE) -> DataFrame:
    """One row per license place: doc_id, license, matched_words, license_words, coverage, start, end.

    Offsets are code points, ends exclusive; coverage is in percent of the template's
    words, rounded down. The templates are small and go to every task. A null or empty
    text has no place. Ids may be null; a repeated row repeats its places. An empty table
    gives an empty result.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = base.mapInArrow(
        _scanned(dict(TEMPLATES if templates is None else templates), band, coverage),
        f"doc_id {id_type(docs, id_col)}, license string, matched_words long, license_words long, start long, end long")
    return found.select("doc_id", "license", "matched_words", "license_words",
                        F.expr("100 * matched_words DIV license_words").alias("coverage"), "start", "end")
