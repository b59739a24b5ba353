"""License scans by patience alignment.

Text and template are word sequences.  Words that stand exactly once in
both are anchors; the longest increasing subsequence of their positions
is kept, and the gaps between kept anchors are aligned in the same way,
down to gaps without anchors, whose equal ends are matched word by word.
The coverage is the share of the template's words that are aligned.

Words that a template does not have cannot be aligned to it, so they are
left out of the text first, and a copy may be stretched by any of them.
The rest is aligned in windows, because a text with several copies has no
word once.  Some windows lie around the places where an unstretched copy
may stand: a copy with coverage c lacks at most (1 - c) of the template's
words, so of any larger set of its words at least one is there; the
rarest such set in the text gives the places.  Others have lengths of
twice the template, four times and so on, and each begins half-way
through the one before, so that any passage of up to half a window lies
whole in one.  The lengths end where a copy would be too thin: aligned
words must be at least ``DENSITY`` of the words from the first to the
last of them.  So whatever aligning the whole text finds within that
density lies in a window.  Texts that hold too few of the template's
words are skipped, which loses none.

Every row is handled by itself in its task: no shuffle.

Defined results.  Null, empty or unmatched text: no license, coverage 0,
position null, matches empty.  Several templates: ``matches`` names all
with at least ``COVERAGE``, ``license`` the one with the highest
coverage, at a tie the one with more words, then the first by name.
Repeated licenses in a text count once.  Very long texts are read whole.
A null id stays null; repeated rows give repeated results; an empty table
none; other columns are not read.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm.common import id_and_text, map_batches

COVERAGE = 0.8
# A copy may have nine other words for each of its own.
DENSITY = 0.1

# Notices as their licenses give them.
TEMPLATES = {
    "All-rights-reserved": "All rights reserved.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
}

_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of (i, j), given by rising i, with rising j."""
    tops: list[int] = []
    piles: list[int] = []  # index of each pile's top pair
    back = [-1] * len(pairs)
    for n, (_, j) in enumerate(pairs):
        at = bisect.bisect_left(tops, j)
        back[n] = piles[at - 1] if at else -1
        if at == len(tops):
            tops.append(j)
            piles.append(n)
        else:
            tops[at], piles[at] = j, n
    out, n = [], piles[-1] if piles else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def align(template: list[str], text: list[str]) -> list[tuple[int, int]]:
    """Aligned positions (template, text), both rising."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(template), 0, len(text))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and template[a] == text[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and template[b - 1] == text[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        here = Counter(template[a:b])
        wanted = {w for w, n in here.items() if n == 1}
        there: dict[str, int] = {}
        for j in range(c, d):
            if text[j] in wanted:
                there[text[j]] = -1 if text[j] in there else j
        anchors = [(i, there[template[i]]) for i in range(a, b) if there.get(template[i], -1) >= 0]
        kept = _increasing(anchors)
        if not kept:
            continue
        out += kept
        edges = [(a - 1, c - 1), *kept, (b, d)]
        todo += [(i + 1, k, j + 1, l) for (i, j), (k, l) in zip(edges, edges[1:]) if i + 1 < k and j + 1 < l]
    return sorted(out)


class Scanner:
    def __init__(self, templates: dict[str, str], coverage: float, density: float = DENSITY):
        self.coverage, self.density = coverage, density
        self.templates = [(name, words_of(t)) for name, t in sorted(templates.items())]
        self.counts = [Counter(t) for _, t in self.templates]
        self.vocabulary = frozenset(w for _, t in self.templates for w in t)

    def windows(self, template: list[str], places: dict[str, list[int]], held: list[int], need: int):
        """(first, end) word positions of the windows, tight ones first."""
        size = len(template)
        # The rarest words of which a sufficient copy must hold one.
        by_rarity = sorted(range(size), key=lambda i: len(places.get(template[i], ())))
        slack = max(2, size // 4)
        tight = {(p - i) // slack for i in by_rarity[: size - need + 1] for p in places.get(template[i], ())}
        for s in sorted(tight):
            yield max(0, (s - 1) * slack), (s + 2) * slack + size
        half = size
        while True:
            for t in sorted({p // half for p in held}):
                yield t * half, (t + 2) * half
            if half * self.density >= size:
                return
            half *= 2

    def best(self, template: list[str], counts: Counter, text: list[str], places: dict[str, list[int]]):
        """(coverage, first, last position) of the best window, or None
        if none reaches the threshold."""
        size = len(template)
        need = math.ceil(self.coverage * size - 1e-9)
        if sum(min(n, len(places.get(w, ()))) for w, n in counts.items()) < need:
            return None
        held = sorted(p for w in counts for p in places.get(w, ()))
        words = [text[p] for p in held]
        found, seen = None, set()
        for first, end in self.windows(template, places, held, need):
            lo, hi = bisect.bisect_left(held, first), bisect.bisect_left(held, end)
            if hi - lo < need or (lo, hi) in seen:
                continue
            seen.add((lo, hi))
            matched = align(template, words[lo:hi])
            share = len(matched) / size
            if not matched or share < self.coverage or (found and share <= found[0]):
                continue
            at, to = held[lo + matched[0][1]], held[lo + matched[-1][1]]
            if len(matched) >= self.density * (to - at + 1):
                found = (share, at, to)
                if share == 1:
                    break
        return found

    def scan(self, value: str):
        """(license, coverage, first, last word, all matches)."""
        text = words_of(value)
        places: dict[str, list[int]] = {}
        for n, w in enumerate(text):
            if w in self.vocabulary:
                places.setdefault(w, []).append(n)
        hits = []
        for (name, template), counts in zip(self.templates, self.counts):
            found = self.best(template, counts, text, places)
            if found:
                hits.append((-found[0], -len(template), name, found))
        if not hits:
            return None, 0.0, None, None, ""
        share, first, last = min(hits)[3]
        return min(hits)[2], share, first, last, ",".join(sorted(h[2] for h in hits))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE,
                  density: float = DENSITY) -> DataFrame:
    """(doc_id, license, coverage, first_word, last_word, matches) of
    every row."""
    templates = TEMPLATES if templates is None else templates
    kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.string()]
    names = ["doc_id", "license", "coverage", "first_word", "last_word", "matches"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scanner = Scanner(templates, coverage, density)
        columns = zip(*(scanner.scan(t) for t in batch.column("text").to_pylist()))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    return map_batches(id_and_text(docs), run, "doc_id long, license string, coverage double, first_word long, "
                                               "last_word long, matches string")
