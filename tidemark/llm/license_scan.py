"""License scan: winnowed fingerprints pick candidate places, banded alignment measures them."""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import windows

# Texts of public licenses and their customary notices: fixed values.
TEMPLATES: dict[str, tuple[str, str]] = {
    "MIT notice": ("MIT", "Released under the MIT License."),
    "MIT": (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software.",
    ),
    "Apache-2.0 notice": ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    "Apache-2.0 header": (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
        'or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    "GPL-3.0 notice": ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    "GPL header": (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program "
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    "BSD-2-Clause": (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    "ISC": (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "MPL-2.0": (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "CC-BY-NC-4.0 notice": ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    "CC-BY-4.0 notice": ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0 notice": ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
}

_BSD_2 = TEMPLATES["BSD-2-Clause"][1]
_BSD_AD = (
    "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product "
    "includes software developed by the organization."
)
_BSD_NAME = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission."
)


def _gnu(what: str, name: str, version: str) -> str:
    return TEMPLATES["GPL header"][1].replace("This program", f"This {what}").replace("GNU General", f"GNU {name}").replace("version 3 ", f"version {version} ")


TEMPLATES |= {
    "BSD-3-Clause": ("BSD-3-Clause", f"{_BSD_2} {_BSD_NAME}"),
    "BSD-4-Clause": ("BSD-4-Clause", f"{_BSD_2} {_BSD_AD} {_BSD_NAME}"),
    "Unlicense": (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
    ),
    "CC0-1.0 notice": ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
}
#: Words that must stand one after the other in a match, by template; ``|`` parts alternatives.
DECIDING: dict[str, tuple[str, ...]] = {
    "MIT notice": ("MIT License",),
    "MIT": ("sell copies of", "above copyright notice"),
    "Apache-2.0 notice": ("Apache License, Version 2.0",),
    "Apache-2.0 header": ("Apache License, Version 2.0",),
    "MPL-2.0": ("Mozilla Public License, v. 2.0|Mozilla Public License, version 2.0",),
    "ISC": ("above copyright notice",),
    "BSD-3-Clause": ("to endorse or promote",),
    "BSD-4-Clause": ("advertising materials mentioning", "to endorse or promote"),
    "Unlicense": ("free and unencumbered software",),
    "CC0-1.0 notice": ("waived all copyright and related or neighboring rights",),
    "CC-BY-NC-4.0 notice": ("CC BY-NC 4.0",),
}
for _short, _name, _version in (
    ("GPL", "General", "3"), ("GPL", "General", "2"), ("LGPL", "Lesser General", "2.1"), ("LGPL", "Lesser General", "3"),
    ("LGPL", "Library General", "2"), ("AGPL", "Affero General", "3"),
):
    _spdx = f"{_short}-{_version if '.' in _version else _version + '.0'}"
    _notice, _called = f"{_spdx} notice", f"GNU {_name} Public License"
    TEMPLATES.setdefault(_notice, (_spdx, f"This work is licensed under the {_called}, version {_version}."))
    DECIDING[_notice] = (f"{_called}, version {_version}|{_called}, version {_version}.0|{_called} v{_version}|{_called} v{_version}.0",)
    for _what in ("program", "library"):
        _header = "GPL header" if (_spdx, _what) == ("GPL-3.0", "program") else f"{_spdx} {_what} header"
        TEMPLATES.setdefault(_header, (_spdx, _gnu(_what, _name, _version)))
        DECIDING[_header] = (_called, f"version {_version} of the|version {_version}.0 of the")
for _version in ("4.0", "3.0"):
    for _kind in ("", "-ShareAlike", "-NonCommercial", "-NoDerivatives", "-NonCommercial-ShareAlike", "-NonCommercial-NoDerivatives"):
        _spdx = "CC-BY" + "".join({"ShareAlike": "-SA", "NonCommercial": "-NC", "NoDerivatives": "-ND"}[x] for x in _kind.split("-")[1:]) + f"-{_version}"
        _where = "Unported" if _version == "3.0" else "International"
        _notice = f"{_spdx} notice" if _spdx != "CC-BY-NC-4.0" else f"{_spdx} long notice"
        TEMPLATES.setdefault(_notice, (_spdx, f"This work is licensed under a Creative Commons Attribution{_kind} {_version} {_where} License."))
        DECIDING[_notice] = (f"Commons Attribution{_kind} {_version}",)

_EDGE = "\"'`([{<>)]}.,;:!?#*$%&|_-"
_WORD = re.compile(r"\S+")


@dataclass(frozen=True)
class ScanSpec:
    """Fingerprints are the least of ``window`` consecutive hashes of ``gram`` words, so that every
    shared run of ``gram + window - 1`` words has one in common.  ``band`` is the number of words
    by which an alignment may drift; ``min_coverage`` the least share of a template to report."""

    gram: int = 3
    window: int = 3
    band: int = 8
    min_coverage: float = 0.75


class WordCodes(dict):
    """Hash of a word without case and outer punctuation; 0 for pure punctuation; a bounded cache."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 300_000:
            self.clear()
        bare = word.strip(_EDGE).lower()
        code = self[word] = xxhash.xxh3_64_intdigest(bare.encode()) | 1 if bare else 0
        return code


def words_of(text: str, codes: WordCodes) -> np.ndarray:
    tokens = text.split()
    return np.fromiter(map(codes.__getitem__, tokens), np.uint64, len(tokens))


def winnow(ids: np.ndarray, spec: ScanSpec) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the least hash (rightmost of equal ones) of every window."""
    h = windows(ids, spec.gram)
    if not len(h):
        return np.empty(0, np.int64), h
    w = min(spec.window, len(h))
    views = np.lib.stride_tricks.sliding_window_view(h, w)
    at = np.unique(np.arange(len(views)) + (w - 1 - views[:, ::-1].argmin(axis=1)))
    return at, h[at]


@dataclass(frozen=True)
class Index:
    """Inverted index: sorted fingerprints with the (template, position) entries of each."""

    names: tuple[str, ...]
    licenses: tuple[str, ...]
    words: tuple[np.ndarray, ...]
    hashes: np.ndarray
    entries: tuple[tuple[tuple[int, int], ...], ...]
    deciding: tuple[tuple[tuple[tuple[int, ...], ...], ...], ...]

    def decided(self, t: int, span: list[int]) -> bool:
        """Whether each deciding run of template ``t`` stands unbroken in the words of a match."""
        return all(any(tuple(span[k : k + len(run)]) == run for run in runs for k in range(len(span) - len(run) + 1)) for runs in self.deciding[t])


def build_index(templates: dict[str, tuple[str, str]], spec: ScanSpec) -> Index:
    """Index of (license, text) templates.  Templates of fewer than ``gram`` words have no fingerprint.
    The ones of ``TEMPLATES`` bring their deciding words."""
    codes, found, words = WordCodes(), {}, []
    for t, (_, text) in enumerate(templates.values()):
        ids = words_of(text, codes)
        ids = ids[ids > 0]
        words.append(ids)
        h = windows(ids, spec.gram)  # all grams of a template: a document's winnowed ones are among them
        for k, x in enumerate(h.tolist()):
            found.setdefault(x, []).append((t, k))
    keys = sorted(found)
    deciding = []
    for name, entry in templates.items():
        runs = DECIDING.get(name, ()) if entry == TEMPLATES.get(name) else ()
        deciding.append(tuple(tuple(tuple(words_of(x, codes).tolist()) for x in run.split("|")) for run in runs))
    return Index(tuple(templates), tuple(x[0] for x in templates.values()), tuple(words), np.array(keys, np.uint64), tuple(tuple(found[x]) for x in keys), tuple(deciding))


def align(template: np.ndarray, doc: np.ndarray, shift: int, band: int) -> tuple[int, int, int]:
    """(matched words, first, last matched position in ``doc``) of a longest common subsequence with
    document positions within ``band`` of ``template position + shift``."""
    m, width = len(template), 2 * band + 1
    best = [[0] * (width + 1) for _ in range(m + 1)]
    for i in range(m - 1, -1, -1):
        row, below, word, base = best[i], best[i + 1], template[i], i + shift - band
        for k in range(width - 1, -1, -1):
            j = base + k
            # the next template word has its band one position further
            skip_t = below[k - 1] if k else 0
            value = max(row[k + 1], skip_t)
            if 0 <= j < len(doc) and doc[j] == word:
                value = max(value, 1 + below[k])
            row[k] = value
    i, k, first, last = 0, 0, -1, -1
    while i < m and k < width and best[i][k]:
        j = i + shift - band + k
        if 0 <= j < len(doc) and doc[j] == template[i] and best[i][k] == 1 + best[i + 1][k]:
            first, last = (j if first < 0 else first), j
            i += 1
        elif best[i][k] == best[i][k + 1]:
            k += 1
        else:
            i, k = i + 1, k - 1
    return best[0][0], first, last


def scan_text(text: str, index: Index, codes: WordCodes, spec: ScanSpec) -> list[tuple[str, str, float, int, int]]:
    """(license, template, coverage, start, end) in code points; overlapping matches go to the one with more matched words."""
    raw = words_of(text, codes)
    real = np.flatnonzero(raw)
    ids = raw[real]
    at, h = winnow(ids, spec)
    if not len(h) or not len(index.hashes):
        return []
    slot = np.minimum(np.searchsorted(index.hashes, h), len(index.hashes) - 1)
    hit = np.flatnonzero(index.hashes[slot] == h)
    if not len(hit):
        return []
    shifts: dict[int, list[int]] = {}
    for k in hit:
        for t, pos in index.entries[slot[k]]:
            shifts.setdefault(t, []).append(int(at[k]) - pos)
    found = []
    for t, many in shifts.items():
        last = None
        for shift in sorted(many):
            if last is not None and shift - last <= spec.band // 2:
                continue  # inside the band of the alignment before
            last = shift
            words = index.words[t]
            matched, a, b = align(words.tolist(), ids[max(0, shift - spec.band) : shift + len(words) + spec.band].tolist(), min(shift, spec.band), spec.band)
            base = max(0, shift - spec.band)
            if matched >= spec.min_coverage * len(words) and index.decided(t, ids[base + a : base + b + 1].tolist()):
                found.append((matched, t, base + a, base + b))
    found.sort(key=lambda x: (-x[0], x[2], x[1]))
    kept: list = []
    spans: list = []
    for matched, t, a, b in found:
        k = bisect_right(spans, (a, 1 << 60))
        if (k and spans[k - 1][1] >= a) or (k < len(spans) and spans[k][0] <= b):
            continue
        spans.insert(k, (a, b))
        kept.append((matched, t, a, b))
    if not kept:
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    if len(places) != len(raw):  # str.split and \S differ on a few control characters
        places, end = [], 0
        for token in text.split():
            start = text.index(token, end)
            end = start + len(token)
            places.append((start, end))
    out = [(index.licenses[t], index.names[t], matched / len(index.words[t]), places[real[a]][0], places[real[b]][1]) for matched, t, a, b in kept]
    return sorted(out, key=lambda x: (x[3], x[1]))


def scan(docs: DataFrame, templates: dict[str, tuple[str, str]] | None = None, spec: ScanSpec | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, license, template, coverage, start, end), one row per license passage.

    ``start`` and ``end`` are code points of the matched span, ``coverage`` the share of the
    template's words that the alignment matched.  Null and empty texts give no row; repeated
    rows give their passages again; null ids pass; other columns are not read.
    """
    spec = spec or ScanSpec()
    shared = docs.sparkSession.sparkContext.broadcast(build_index(templates or TEMPLATES, spec))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        codes, index = WordCodes(), shared.value
        for batch in batches:
            rows = [(k, *m) for k, text in enumerate(batch.column(1).to_pylist()) if text for m in scan_text(text, index, codes, spec)]
            at = pa.array([r[0] for r in rows], pa.int64())
            cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64()), 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), *cols], names=["id", "license", "template", "coverage", "start", "end"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, f"id {kind}, license string, template string, coverage double, start long, `end` long").withColumnRenamed("id", id_col)
