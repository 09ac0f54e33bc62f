"""License scans by conditional compression.

Cue words are taken from the templates: a statement cannot be confirmed without one of its template's. Around each, a block
half as long again as a template, to either side, is cut from the text and compressed alone and with the template as
zstandard raw dictionary. All templates are ranked by the bytes that they save, and confirmed down this ranking: the first wins of which most words occur in the block in order, among them
the names and versions that tell licenses apart. The words that are missing or added are reported. A text has as many findings as it has statements; a cue
inside one that was found starts no new block. SPDX-License-Identifier lines are found by their mark, and their
expression is the license; so are short names as CC BY 4.0 that stand in no statement. What they save may be nothing.

Each row is scanned by itself, whole texts of any length. Null and empty texts have no findings. Rows
keep their doc_id whatever it is; equal rows are scanned each; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import partial

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from sitecharge.llm.shared import in_tasks, slices, text_bytes

# The wording of license notices, as their stewards publish it or as it is commonly put.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    (
        "LicenseRef-BSD-2-or-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("ISC", "Licensed under the ISC License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    ),
    ("LicenseRef-All-Rights-Reserved", "All rights reserved."),
]
#: Share of a template's words that has to be found, in order.
LEAST = 0.8
#: Words that are written large in a template and still do not tell licenses apart.
GENERIC = {"license", "version", "v", "software", "you", "source", "code", "form", "international", "universal"}
#: Words that make another license of a statement, or none, where they are added.
OTHERS = {"lesser", "library", "affero", "share", "alike", "sharealike", "noncommercial", "non-commercial", "noderivatives", "noderivs", "not", "never"}
SPDX = re.compile(r"SPDX-License-Identifier:\s*(\(*[\w.+:-]*[\w+]\)*(?:\s+(?:AND|OR|WITH)\s+\(*[\w.+:-]*[\w+]\)*)*)", re.IGNORECASE)
SHORT = re.compile(r"\bCC[\s-]+(BY(?:-(?:SA|NC|ND|NC-SA|NC-ND))?)[\s-]+(\d\.\d)(?!\.?\d)")
_WORD = re.compile(r"\S+")
_PIECES = re.compile(r"[/,;:!?()\[\]\"']+|\.(?=\D)")
_VERSION = re.compile(r"v?(\d+)(?:\.0)*")
_MARKS = ".,;:!?()[]\"'"
_KEPT = 4096


def _plain(word: str) -> str:
    return word.lower().strip(_MARKS)


def _name(word: str) -> str:
    """``word``, or its number where it is a version: 3, 3.0 and v3 are one."""
    version = _VERSION.fullmatch(word)
    return version[1] if version else word


def names_of(text: str) -> set[str]:
    """The words of a template that tell licenses apart: names and versions, by their capitals and digits."""
    found = set()
    for i, word in enumerate(w.strip(_MARKS) for w in text.split()):
        large = word != word.lower() if i else len(word) > 1 and word == word.upper()
        if "//" not in word and (large or any(c.isdigit() for c in word)) and word.lower() not in GENERIC:
            found.add(word.lower())
    return found


def cues_of(words: list[str], names: set[str], spread: Counter) -> set[str]:
    """Words of a template one of which every confirmed statement holds, rare ones first.

    A name will do, as all of them are demanded; else so many places as may not all be missing.
    """
    rare = sorted({w for w in words if w}, key=lambda w: (spread[w], -len(w), w))
    if sure := [w for w in rare if w in names and _name(w) == w and not w[0].isdigit()]:
        return {sure[0]}
    out, places = set(), 0
    for word in rare:
        if places > len(words) - LEAST * len(words):
            break
        out.add(word)
        places += words.count(word)
    return out


class Scanner:
    """Templates with their compressors; findings of equal blocks are remembered, up to a bound."""

    def __init__(self, templates: list[tuple[str, str]], level: int = 3):
        self.alone = zstandard.ZstdCompressor(level=level)
        self.templates = []
        self.cues: set[str] = set()
        worded = [[_plain(w) for w in text.split()] for _, text in templates]
        spread = Counter(w for words in worded for w in set(words))
        for (name, text), words in zip(templates, worded):
            if not any(words):
                raise ValueError(f"template of {name!r} without words")
            names = names_of(text)
            self.cues |= cues_of(words, names, spread)
            self.templates.append((name, words, self._with(" ".join(words), level), names))
        self.marks = self._with("SPDX-License-Identifier: CC BY-NC-SA 4.0", level)
        self.longest = 3 * max(len(words) for _, words, _, _ in self.templates) // 2
        self.seen: dict[tuple, tuple | None] = {}

    @staticmethod
    def _with(text: str, level: int) -> zstandard.ZstdCompressor:
        dictionary = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(level=level, dict_data=dictionary)

    def _saved(self, text: str, compressor: zstandard.ZstdCompressor) -> int:
        data = text.encode()
        return len(self.alone.compress(data)) - len(compressor.compress(data))

    @staticmethod
    def _wording(template: list[str], block: list[str]) -> tuple[float, int, int, list[str]]:
        """(share of the template found in order, first and last word in the block, differences)."""
        pairs = [m for m in SequenceMatcher(None, template, block, autojunk=False).get_matching_blocks() if m.size]
        if not pairs:
            return 0.0, 0, 0, []
        found = sum(m.size for m in pairs)
        first, last = pairs[0].b, pairs[-1].b + pairs[-1].size
        differences, a, b = [], 0, first
        for m in pairs:
            differences += [f"-{w}" for w in template[a : m.a]] + [f"+{w}" for w in block[b : m.b]]
            a, b = m.a + m.size, m.b + m.size
        # what is added counts against it too
        share = found / max(len(template), last - first)
        return share, first, last, differences + [f"-{w}" for w in template[a:]]

    def best(self, words: list[str], at: int) -> tuple[str, int, int, int, str] | None:
        """(license, first word, last word, bytes saved, differences) of the statement around word ``at``."""
        low = max(0, at - self.longest)
        key = (at - low, *words[low : at + self.longest])
        if key not in self.seen:
            if len(self.seen) >= _KEPT:
                self.seen.clear()
            self.seen[key] = self._best(list(key[1:]), key[0])
        found = self.seen[key]
        return found and (found[0], found[1] + low, found[2] + low, found[3], found[4])

    def _best(self, words: list[str], at: int) -> tuple | None:
        ranked = []
        for i, (_, template, compressor, _) in enumerate(self.templates):
            reach = 3 * len(template) // 2
            low = max(0, at - reach)
            block = words[low : at + reach]
            saved = self._saved(" ".join(block), compressor)
            if saved > 0:
                ranked.append((-saved, i, low, block))
        held = set(words)
        for saved, i, low, block in sorted(ranked, key=lambda r: r[:2]):
            name, template, _, names = self.templates[i]
            if sum(w in held for w in template) < LEAST * len(template):
                continue  # too few of its words, in whatever order: not to be confirmed
            share, first, last, differences = self._wording(template, block)
            if share >= LEAST and first <= at - low < last and self._same(names, block, first, last, differences):
                return name, low + first, low + last, -saved, " ".join(differences)
        return None

    @staticmethod
    def _same(names: set[str], block: list[str], first: int, last: int, differences: list[str]) -> bool:
        """Whether a statement with these differences is still of its template's license."""
        missing = [d[1:] for d in differences if d[0] == "-"]
        if any(d[0] == "+" and d[1:] in OTHERS for d in differences):
            return False
        if not names.intersection(missing):
            return True
        # a version written otherwise, or a name with the next word on it, may stand in a missing word's place
        around = block[max(0, first - len(missing)) : last + len(missing)]
        held = {_name(piece) for word in around for piece in _PIECES.split(word)}
        return all(_name(w) in held for w in names.intersection(missing))

    def scan(self, text: str) -> Iterator[tuple[str, int, int, int, str]]:
        """(license, first, last, bytes saved, differences) with character offsets, in order."""
        found = [(" ".join(m[1].split()), *m.span(), self._saved(m[0], self.marks), "") for m in SPDX.finditer(text)]
        plain = [w.strip(_MARKS) for w in text.lower().split()]
        if not self.cues.isdisjoint(plain):
            words = [m.span() for m in _WORD.finditer(text)]
            marked, after = [(first, last) for _, first, last, _, _ in found], 0
            for at in [i for i, w in enumerate(plain) if w in self.cues]:
                a, b = words[at]
                if a < after or any(first < b and a < last for first, last in marked):
                    continue
                if statement := self.best(plain, at):
                    name, first, last, saved, differences = statement
                    after = words[last - 1][1]
                    found.append((name, words[first][0], after, saved, differences))
        for m in SHORT.finditer(text):
            if not any(first < m.end() and m.start() < last for _, first, last, _, _ in found):
                found.append((f"CC-{m[1]}-{m[2]}", *m.span(), self._saved(m[0], self.marks), ""))
        yield from sorted(found, key=lambda f: f[1:3])


def _scanned(batches: Iterator[pa.RecordBatch], templates: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner(templates)
    names = ["doc_id", "license", "first", "last", "bytes_saved", "differences"]
    for batch in batches:
        for start, stop in slices(text_bytes(batch.column(1))[1]):
            rows, found = [], []
            for row, text in enumerate(batch.column(1)[start:stop].to_pylist(), start):
                for finding in scanner.scan(text or ""):
                    rows.append(row)
                    found.append(finding)
            columns = list(zip(*found)) or [()] * 5
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            values = [pa.array(list(c), kind) for c, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *values], names=names)


def license_findings(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(doc_id, license, first, last, bytes_saved, differences) per statement found; offsets are in characters."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, license string, first long, last long, bytes_saved long, differences string"
    return in_tasks(docs.select("doc_id", "text"), partial(_scanned, templates=templates), schema)
