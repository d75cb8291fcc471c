"""License notices in texts: winnowed fingerprints, then banded alignment.

Templates are cut into hashes of ``GRAM`` words of which every window of ``WINDOW``
keeps its smallest; an inverted index leads from a hash to its places in templates.
A text is winnowed the same way, so any shared run of GRAM + WINDOW - 1 words meets
in the index. A meeting gives a template and a diagonal; if the words around it can
cover enough of the template at all, a banded alignment finds how much of the
template is there in order, and where. Where a text has enough of a template's words
but they may share no run (short notices with words put in between), counts of words
over all diagonals lead to the places as well, so no alignment is lost.

Templates of ``LONG`` words and more (whole license texts) need no index: their
diagonals are taken on a grid of one band's width and aligned in a band so much wider
that it holds the band of every diagonal between. Words in common bound each place
of the grid before anything is aligned.

Of templates that are found at largely one place (licenses of one family) only the
closest ones are reported.

The templates are a parameter of bounded size
(``MAX_TEMPLATE_WORDS``). Texts are read once, in their partition.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping
from functools import cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.shingles import U64, WordHashes, mixed

GRAM, WINDOW = 2, 2
COVERAGE = 0.8
MAX_TEMPLATE_WORDS = 200_000
LONG = 100
# alignments that are remembered for one template in one text
MAX_ALIGNED = 50_000
TEXTS = Path(__file__).parent / "licenses"

# Wording of common notices.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at"),
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation"),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction"),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "bsd": "under the BSD License",
    "bsd-style": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    "bsd-2-clause": "under the BSD 2-Clause License",
    "bsd-3-clause": "under the BSD 3-Clause License",
    "isc": "under the ISC License",
    "unlicense": "under the Unlicense",
    "unlicense-dedication": "This is free and unencumbered software released into the public domain.",
    "cc0-1.0": "under CC0 1.0",
    "cc0-waiver": (
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work."),
    "epl-1.0-header": (
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License v1.0 which accompanies this distribution"),
    "epl-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at"),
} | {
    f"{name}": f"This work is licensed under the GNU {kind}, version {version}."
    for name, kind, version in (
        ("gpl-2.0", "General Public License", "2"), ("lgpl-2.1", "Lesser General Public License", "2.1"),
        ("lgpl-3.0", "Lesser General Public License", "3"), ("agpl-3.0", "Affero General Public License", "3"))
} | {
    f"{name}-header": (
        f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU "
        f"{kind} as published by the Free Software Foundation, either version {version} of the License, or "
        "(at your option) any later version.")
    for name, what, kind, version in (
        ("gpl-2.0", "program", "General Public License", "2"), ("gpl-3.0", "program", "General Public License", "3"),
        ("lgpl-2.1", "library", "Lesser General Public License", "2.1"),
        ("lgpl-3.0", "library", "Lesser General Public License", "3"),
        ("agpl-3.0", "program", "Affero General Public License", "3"))
} | {
    f"cc-{code}-{version}": f"Licensed under CC {code.upper()} {version}."
    for code in ("by", "by-sa", "by-nc", "by-nc-sa", "by-nd", "by-nc-nd") for version in ("3.0", "4.0")
} | {
    f"cc-{code}-{version}-notice": f"licensed under a Creative Commons {name} {version} {port} License"
    for code, name in (
        ("by", "Attribution"), ("by-sa", "Attribution-ShareAlike"), ("by-nc", "Attribution-NonCommercial"),
        ("by-nc-sa", "Attribution-NonCommercial-ShareAlike"), ("by-nd", "Attribution-NoDerivatives"),
        ("by-nc-nd", "Attribution-NonCommercial-NoDerivatives"))
    for version, port in (("3.0", "Unported"), ("4.0", "International"))
} | {
    # three and four words, so that all of them are needed
    f"spdx-{name.lower()}": f"License-Identifier: {name}" if name.isalpha() else f"Identifier: {name}"
    for name in (
        "MIT", "ISC", "Unlicense", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0",
        "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-1.1", "MPL-2.0", "EPL-1.0", "EPL-2.0", "CC0-1.0", "CC-BY-3.0",
        "CC-BY-4.0", "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CC-BY-NC-3.0", "CC-BY-NC-4.0", "CC-BY-NC-SA-3.0",
        "CC-BY-NC-SA-4.0", "CC-BY-ND-3.0", "CC-BY-ND-4.0", "CC-BY-NC-ND-3.0", "CC-BY-NC-ND-4.0")
}
MATCHES = ("array<struct<template: string, coverage: double, n_matched: int, n_template: int, "
           "word_start: int, word_end: int, char_start: int, char_end: int>>")

# letters and digits of ASCII in lower case and everything beyond ASCII; the rest separates words
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if chr(b).isalnum() or b > 127 else 32 for b in range(256))
_WORD = re.compile("[A-Za-z0-9\x80-\U0010ffff]+")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def winnowed(h: np.ndarray) -> np.ndarray:
    """Places of the smallest hash of every window, the last one of equals."""
    if len(h) <= WINDOW:
        return np.arange(len(h))[h == h.min()][-1:] if len(h) else np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(h, WINDOW)
    return np.unique(np.arange(len(windows)) + WINDOW - 1 - np.argmin(windows[:, ::-1], axis=1))


def gram_hashes(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    h = np.fromiter(map(hashes.__getitem__, words), U64, len(words))
    n = len(h) - GRAM + 1
    if n < 1:
        return np.empty(0, U64)
    total = np.zeros(n, U64)
    for k in range(GRAM):
        total = mixed(total + h[k:k + n])
    return total


def aligned(template: list, words: list, diagonal: int, band: int):
    """(matched, first, behind) of the best alignment within the band, or None.

    Most matched template words in order, the shortest span of equals; ``diagonal``
    is the text place of the template's first word.
    """
    best = None
    # per text place: matched words so far and the first text place used
    above: dict[int, tuple[int, int]] = {}
    for i, wanted in enumerate(template):
        row: dict[int, tuple[int, int]] = {}
        left = (0, 0)
        low = max(0, diagonal + i - band)
        for j in range(low, min(len(words), diagonal + i + band + 1)):
            cell = max(left, above.get(j, (0, 0)))
            if words[j] == wanted:
                before = above.get(j - 1, (0, 0))
                taken = (before[0] + 1, before[1] if before[0] else j)
                cell = max(cell, taken)
                found = (taken[0], taken[1] - j - 1, taken[1])
                if best is None or found > best:
                    best = found
            row[j] = left = cell
        above = row
    return best and (best[0], best[2], best[2] - best[1])


def aligned_long(template: np.ndarray, text: np.ndarray, diagonal: int, band: int):
    """The same as ``aligned`` for words given as numbers, a row at a time."""
    width = 2 * band + 1
    scale = len(text) + 1
    before = max(0, band - diagonal)
    behind = max(0, diagonal + len(template) + band - len(text))
    padded = np.concatenate([np.full(before, -1, text.dtype), text, np.full(behind, -1, text.dtype)])
    # a cell is the number of matched words times ``scale`` and the first text place
    row = np.zeros(width + 1, np.int64)
    best, best_n = None, 0
    for i, wanted in enumerate(template.tolist()):
        low = diagonal + i - band
        hits = np.flatnonzero(padded[low + before:low + before + width] == wanted)
        above = row
        row = np.zeros(width + 1, np.int64)
        row[:width] = above[1:]
        if len(hits):
            cells = above[hits]
            places = hits + low
            cells = np.where(cells > 0, cells + scale, scale + places)
            row[hits] = np.maximum(row[hits], cells)
            n = int(cells.max()) // scale
            if n >= best_n:
                full = cells >= n * scale
                first = cells[full] - n * scale
                for found in zip((first - places[full] - 1).tolist(), first.tolist()):
                    if best is None or (n, *found) > best:
                        best = (n, *found)
                best_n = n
        np.maximum.accumulate(row[:width], out=row[:width])
    return best and (best[0], best[2], best[2] - best[1])


def apart(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int]]:
    """(matched, first, behind) of hits that do not overlap, the fullest ones first."""
    taken: list[tuple[int, int, int]] = []
    # places of what is taken, in order
    firsts: list[int] = []
    ends: list[int] = []
    for negative, _, first, behind in sorted(set(found)):
        at = bisect_left(firsts, behind)
        if at == 0 or ends[at - 1] <= first:
            taken.append((-negative, first, behind))
            firsts.insert(at, first)
            ends.insert(at, behind)
    return taken


def closest(rows: list[tuple]) -> list[tuple]:
    """Rows without those that have a closer one at largely the same place.

    Closer is what needs fewer words left out or put in between; two rows are at
    one place if more than half of the longer one is in both. Equals all stay.
    """
    lost = set()
    for i, a in enumerate(rows):
        for k in range(i + 1, len(rows)):
            b = rows[k]
            if b[4] >= a[5]:
                break
            if 2 * (min(a[5], b[5]) - b[4]) > max(a[5] - a[4], b[5] - b[4]):
                x, y = (r[3] + r[5] - r[4] - 2 * r[2] for r in (a, b))
                if x != y:
                    lost.add(i if x > y else k)
    return [r for i, r in enumerate(rows) if i not in lost]


class Scanner:
    """The inverted index of the templates and the scan of one text."""

    def __init__(self, templates: Mapping[str, str]) -> None:
        self.hashes = WordHashes()
        self.templates = [(name, words_of(t)) for name, t in sorted(templates.items())]
        self.index: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.numbers: dict[bytes, int] = {}
        self.long: list[tuple[int, np.ndarray]] = []
        self.short: list[tuple[int, np.ndarray]] = []
        for t, (_, words) in enumerate(self.templates):
            if len(words) >= LONG:
                self.long.append((t, np.array(
                    [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words], np.int32)))
                continue
            self.short.append((t, np.array(
                [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words], np.int32)))
            h = gram_hashes(words, self.hashes)
            for at in winnowed(h).tolist():
                self.index[int(h[at])].append((t, at))
        self.coded = {t: template.tolist() for t, template in self.short}
        # how often a template has each word; words of no template are 0
        self.limits = [np.bincount(words, minlength=len(self.numbers) + 1) for _, words in self.long]
        # the same of all short templates as one list: place in ``short``, word, times
        rows = [(k, w, c) for k, (_, words) in enumerate(self.short) for w, c in Counter(words.tolist()).items()]
        self.of, self.word, self.times = np.array(rows or np.empty((0, 3)), np.int64).T
        self.sizes = np.array([len(words) for _, words in self.short], np.int64)
        self.keys = np.sort(np.fromiter(self.index, U64, len(self.index)))

    def numbered(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter((self.numbers.get(w, 0) for w in words), np.int32, len(words))

    def possible(self, words: list[bytes], coverage: float) -> dict[int, np.ndarray]:
        """Diagonals by short template around which enough of its words are."""
        if not len(words) or not self.short:
            return {}
        text = self.numbered(words)
        counts = np.bincount(text, minlength=len(self.numbers) + 1)
        held = np.bincount(self.of, np.minimum(counts[self.word], self.times), len(self.short))
        found = {}
        for k in np.flatnonzero(held >= coverage * self.sizes).tolist():
            t, template = self.short[k]
            n = len(template)
            band = max(2, n // 8)
            known = np.r_[0, np.cumsum(np.isin(text, template))]
            d = np.arange(-n, len(text))
            total = known[np.clip(d + n + band, 0, len(text))] - known[np.clip(d - band, 0, len(text))]
            found[t] = d[total >= coverage * n]
        return found

    def candidates(self, words: list[bytes], coverage: float = COVERAGE) -> dict[int, list[int]]:
        """Diagonals by template."""
        found = defaultdict(set)
        for t, diagonals in self.possible(words, coverage).items():
            found[t].update(diagonals.tolist())
        h = gram_hashes(words, self.hashes)
        if not len(h) or not len(self.keys):
            return {t: sorted(d) for t, d in found.items()}
        at = winnowed(h)
        low = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        for place in at[self.keys[low] == h[at]].tolist():
            for t, offset in self.index[int(h[place])]:
                found[t].add(place - offset)
        return {t: sorted(d) for t, d in found.items()}

    def best(self, t: int, near: np.ndarray, diagonal: int, band: int, coverage: float):
        """(matched, first, behind) around a diagonal if enough words match, or None."""
        template = self.coded[t]
        # words in common bound what any alignment can match
        if sum((Counter(near.tolist()) & Counter(template)).values()) < coverage * len(template):
            return None
        hit = aligned(template, near.tolist(), diagonal, band)
        return hit if hit and hit[0] >= coverage * len(template) else None

    def matches(self, words: list[bytes], candidates: Mapping[int, list[int]], coverage: float):
        """Rows (template, coverage, matched, words, first, behind) that do not overlap."""
        rows = []
        text = self.numbered(words) if candidates else None
        for t, diagonals in sorted(candidates.items()):
            name, template = self.templates[t]
            n = len(template)
            band = max(2, n // 8)
            found = []
            # what a diagonal finds depends on the template's words near it alone; a notice
            # that a text repeats is aligned once for all its places
            known: dict[tuple[int, bytes], tuple[int, int, int] | None] = {}
            for d in diagonals:
                low = max(0, d - band)
                near = text[low:d + n + band]
                key = (d - low, near.tobytes())
                if key not in known:
                    if len(known) >= MAX_ALIGNED:
                        known.clear()
                    known[key] = self.best(t, near, d - low, band, coverage)
                hit = known[key]
                if hit:
                    found.append((-hit[0], hit[2] - hit[1], low + hit[1], low + hit[2]))
            rows += [(name, round(m / n, 6), m, n, first, behind) for m, first, behind in apart(found)]
        return sorted(rows, key=lambda r: (r[4], r[0]))

    def long_matches(self, words: list[bytes], coverage: float) -> list[tuple]:
        """Rows of the long templates."""
        least = min((len(template) for _, template in self.long), default=0)
        if not least or len(words) < coverage * least:
            return []
        text = self.numbered(words)
        if np.count_nonzero(text) < coverage * least:
            return []
        rows = []
        for (t, template), limits in zip(self.long, self.limits):
            n = len(template)
            wanted = coverage * n
            if len(text) < wanted:
                continue
            known = np.r_[0, np.cumsum(limits[text] > 0)]
            step = max(2, n // 8)
            band = step + (step + 1) // 2
            grid = np.arange(-n, len(text) + step, step)
            lows = np.clip(grid - band, 0, len(text))
            highs = np.clip(grid + n + band, 0, len(text))
            places = []
            for k in np.flatnonzero(known[highs] - known[lows] >= wanted).tolist():
                near = np.bincount(text[lows[k]:highs[k]], minlength=len(limits))
                most = int(np.minimum(near, limits).sum())
                if most >= wanted:
                    places.append((-most, int(grid[k]), int(lows[k]), int(highs[k])))
            found: list[tuple[int, int, int, int]] = []
            for negative, d, low, high in sorted(places):
                # nothing fuller and nothing beside a hit can be found there
                if any((m < negative or m == -n == first - behind)
                       and first - low < wanted and high - behind < wanted for m, _, first, behind in found):
                    continue
                hit = aligned_long(template, text, d, band)
                if hit and hit[0] >= wanted:
                    found.append((-hit[0], hit[2] - hit[1], hit[1], hit[2]))
            name = self.templates[t][0]
            rows += [(name, round(m / n, 6), m, n, first, behind) for m, first, behind in apart(found)]
        return rows

    def scan(self, text: str | None, coverage: float) -> list[tuple]:
        words = words_of(text) if text else []
        rows = self.matches(words, self.candidates(words, coverage), coverage) + self.long_matches(words, coverage)
        rows = closest(sorted(rows, key=lambda r: (r[4], r[0])))
        if not rows:
            return []
        spans = [m.span() for m in _WORD.finditer(text)]
        return [(*r, spans[r[4]][0], spans[r[5] - 1][1]) for r in rows]


@cache
def known_licenses() -> dict[str, str]:
    """The usual notices and the whole texts of common licenses."""
    return TEMPLATES | {p.stem: p.read_text("utf-8") for p in sorted(TEXTS.glob("*.txt"))}


def license_matches(templates: Mapping[str, str], text: str = "text", coverage: float = COVERAGE) -> Column:
    """An array of matches in a text, in the order of their places."""
    if sum(len(words_of(t)) for t in templates.values()) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates have more than {MAX_TEMPLATE_WORDS} words; scan in several calls")

    @F.pandas_udf(MATCHES)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(templates)
        names = ("template", "coverage", "n_matched", "n_template", "word_start", "word_end",
                 "char_start", "char_end")
        for texts in batches:
            yield pd.Series([[dict(zip(names, r)) for r in scanner.scan(t, coverage)] for t in texts],
                            dtype=object)
    return scan(text)


def license_report(docs: DataFrame, templates: Mapping[str, str] | None = None,
                   coverage: float = COVERAGE) -> DataFrame:
    """One row per document and match: doc_id, template, coverage, word and character spans.

    ``coverage`` is the share of the template's words found in order. Spans count
    words and code points of the whole text from 0, ends behind the last one.
    Matches of one template do not overlap (the fullest, shortest, first one
    counts); different templates may, but of those at largely one place only the
    closest ones are reported. Without ``templates`` those of ``known_licenses``
    are looked for. Null and empty texts match nothing; repeated
    rows each give their matches; empty tables give empty results.
    """
    found = license_matches(known_licenses() if templates is None else templates, "text", coverage)
    return docs.select("doc_id", found.alias("m")).select("doc_id", F.inline("m"))
