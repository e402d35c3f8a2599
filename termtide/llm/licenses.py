"""License notices, found by how well known wordings compress a stretch of words."""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Common public notices, one wording each. Fixed values.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "MIT (notice)": "Permission is hereby granted, free of charge, to any person obtaining a copy of "
    "this software and associated documentation files",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related "
    "rights to this work. CC0 1.0 Universal.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "proprietary": "All rights reserved.",
    "MIT (text)": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
    "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions: The above copyright notice and this permission notice shall be included in all copies or substantial "
    "portions of the Software.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD (text)": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the above "
    "copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution.",
    "Apache-2.0 (header)": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
    "file except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0 (header)": "This program is free software: you can redistribute it and/or modify it under the terms of "
    "the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, "
    "or (at your option) any later version.",
    "GPL-2.0 (header)": "This program is free software; you can redistribute it and/or modify it under the terms of "
    "the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, "
    "or (at your option) any later version.",
}
_WORD = re.compile(r"[\w.+-]*\w")


def wording(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def cues_of(templates: dict[str, list[str]], share: float) -> dict[str, list[str]]:
    """Words of each template, one more than it may lack: a notice has one of them at least.

    Those in the fewest templates are taken, the longest first.
    """
    used = Counter(w for words in templates.values() for w in set(words))
    return {
        name: sorted(set(words), key=lambda w: (used[w], -len(w), w))[: int(share * len(words)) + 1]
        for name, words in templates.items()
    }


def extended(template: tuple[str, ...], line: tuple[str, ...]) -> tuple[int, int, list[str], list[str]]:
    """The fewest differences between a template and the start of a line, by a table of all prefixes:
    their number, how many words of the line are taken, those missing and those inside.

    Words of the line after the last equal one don't count.
    """
    cost = [list(range(len(line) + 1))]
    ends = [(len(template), 0, 0)]
    for a, word in enumerate(template, 1):
        above, row = cost[-1], [a]
        for b, other in enumerate(line, 1):
            least = min(above[b], row[b - 1]) + 1
            if word == other:
                least = min(least, above[b - 1])
                ends.append((least + len(template) - a, b, a))
            row.append(least)
        cost.append(row)
    n, taken, a = min(ends)
    b, missing, inside = taken, list(template[a:])[::-1], []
    while a or b:
        if a and b and template[a - 1] == line[b - 1] and cost[a][b] == cost[a - 1][b - 1]:
            a, b = a - 1, b - 1
        elif a and cost[a][b] == cost[a - 1][b] + 1:
            a -= 1
            missing.append(template[a])
        else:
            b -= 1
            inside.append(line[b])
    return n, taken, missing[::-1], inside[::-1]


class Scanner:
    """The templates as word lists and as dictionaries of a compressor each."""

    def __init__(self, templates: dict[str, str], share: float):
        options = {"level": 19, "write_content_size": False}
        self.plain = zstandard.ZstdCompressor(**options)
        self.words = {name: tuple(words) for name, text in templates.items() if (words := wording(text))}
        self.most = {name: int(share * len(words)) for name, words in self.words.items()}
        self.known = {
            name: (
                len(self.plain.compress(text.lower().encode())),
                zstandard.ZstdCompressor(
                    dict_data=zstandard.ZstdCompressionDict(
                        text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
                    ),
                    **options,
                ),
            )
            for name, text in templates.items()
        }
        #: By cue word: templates, and the word's places in each.
        self.cues: dict[str, dict[str, list[int]]] = {}
        for name, cues in cues_of(self.words, share).items():
            for place, word in enumerate(self.words[name]):
                if word in cues:
                    self.cues.setdefault(word, {}).setdefault(name, []).append(place)
        self.saved = lru_cache(1 << 16)(self.saved)
        self.aligned = lru_cache(1 << 16)(self.aligned)

    def saved(self, name: str, stretch: str) -> float:
        """Bytes that the template saves of the compressed stretch, as a share of its own."""
        data = stretch.encode()
        size, tool = self.known[name]
        return (len(self.plain.compress(data)) - len(tool.compress(data))) / size

    def aligned(self, name: str, place: int, before: tuple[str, ...], after: tuple[str, ...]):
        """(differences, words before, words after, missing, inside) around the template's word at
        ``place``, or None if they are too many. The words before come last first."""
        words, most = self.words[name], self.most[name]
        if sum((Counter(words) & Counter((*before, words[place], *after))).values()) < len(words) - most:
            return None
        n, left, missing, inside = extended(words[:place][::-1], before)
        if n > most:
            return None
        m, right, *rest = extended(words[place + 1 :], after)
        return (n + m, left, right, missing[::-1] + rest[0], inside[::-1] + rest[1]) if n + m <= most else None

    def notices(self, text: str, least: float):
        """(first, end, name, saved, missing, inside) of every notice, in order of place; first and end
        are character positions.

        At every cue the words around it, wide enough for all that may stand inside, over line ends, are
        compressed with each template that has the cue. Those that save ``least`` are ranked by what they
        save, and the first whose wording differs little enough is the one for this place. Of places that
        overlap, the one with the fewest differences stays, then the longer template.
        """
        spots = [(m.start(), m.end()) for m in _WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in spots]
        found = {}
        for i, word in enumerate(words):
            if word not in self.cues:
                continue
            for saved, name in self.ranked(words, i, least):
                fits = []
                for place in self.cues[word][name]:
                    before, after = self.around(words, i, name, place)
                    if fit := self.aligned(name, place, before, after):
                        fits.append(fit)
                if fits:
                    n, left, right, missing, inside = min(fits, key=lambda f: f[0])
                    at = i - left, i + right + 1
                    if (name, *at) not in found or (n, -saved) < found[name, *at][:2]:
                        found[name, *at] = n, -saved, name, at, missing, inside
                    break
        taken, out = bytearray(len(words)), []
        order = sorted(found.values(), key=lambda f: (f[0], -len(self.words[f[2]]), f[1], f[2], f[3]))
        for _, saved, name, (a, b), missing, inside in order:
            if not any(taken[a:b]):
                taken[a:b] = b"\1" * (b - a)
                out.append((spots[a][0], spots[b - 1][1], name, -saved, missing, inside))
        return sorted(out, key=lambda x: x[:2])

    def around(self, words: list[str], i: int, name: str, place: int) -> tuple[tuple[str, ...], tuple[str, ...]]:
        """Words before the cue, the nearest first, and after it, that a notice can reach."""
        most, size = self.most[name], len(self.words[name])
        return tuple(words[max(0, i - place - most) : i][::-1]), tuple(words[i + 1 : i + size - place + most])

    def ranked(self, words: list[str], i: int, least: float) -> list[tuple[float, str]]:
        """What each template with this cue saves of the words around it, the most first; of one with the
        cue in several places, its best."""
        out = []
        for name, places in self.cues[words[i]].items():
            most, size = self.most[name], len(self.words[name])
            blocks = {
                " ".join(words[max(0, i - place - most) : i + size - place + most]) for place in places
            }
            saved = max(self.saved(name, block) for block in blocks)
            if saved >= least:
                out.append((saved, name))
        return sorted(out, key=lambda x: (-x[0], x[1]))


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.1, share: float = 0.2,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per license notice: id, line_no (from 0) of its first line, license, reduction (bytes
    saved of the compressed words around its cue, as a share of the template's own compressed size), exact,
    missing and inside (differing words), line (all lines it stands on).

    A notice is a stretch of words, wherever lines end, that differs from a template in at most
    ``share`` of the template's words. Every stretch of the whole text is tried that holds one of
    the words of which a notice can't lack all. A null or empty text has none;
    a repeated row gives its rows again; a null id stays null; no rows of an empty table. Of notices that
    overlap the one with the fewest differences stays, then that of the longer template. Rows don't need one another: there is no shuffle.
    """
    templates = dict(templates or TEMPLATES)
    cues = sorted(Scanner(templates, share).cues)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(
        F.col("text").rlike("(?iu)" + "|".join(re.sub(r"\W", r"\\\g<0>", cue) for cue in cues))
    )
    kind = texts.schema["id"].dataType.simpleString()

    def scanned(batches):
        scanner = Scanner(templates, share)
        for batch in batches:
            rows = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                last = line_no = 0
                for first, end, name, saved, missing, inside in scanner.notices(text, least):
                    line_no += text.count("\n", last, first)
                    last = first
                    until = text.find("\n", end)
                    line = text[text.rfind("\n", 0, first) + 1 : until if until >= 0 else len(text)]
                    rows.append((i, line_no, name, round(saved, 6), not missing + inside, missing, inside, line))
            at, *rest = zip(*rows) if rows else [()] * 8
            words = pa.list_(pa.string())
            kinds = [pa.int32(), pa.string(), pa.float64(), pa.bool_(), words, words, pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(at, pa.int64())), *map(pa.array, rest, kinds)],
                ["id", "line_no", "license", "reduction", "exact", "missing", "inside", "line"],
            )

    words = "missing array<string>, inside array<string>"
    return texts.mapInArrow(
        scanned,
        f"id {kind}, line_no int, license string, reduction double, exact boolean, {words}, line string",
    ).withColumnRenamed("id", id_col)
