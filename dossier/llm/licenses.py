"""License scans by conditional compression (operator 10).

The words around each license cue, as many at either side as a notice may
have, are searched for the wordings of every license, word by word; cues near
each other share their words, whatever else a line holds. A wording is
confirmed if ``SIMILARITY`` of the words agree and no name or number that
tells licenses apart differs. The stretch that it fits is compressed alone and
with the license's wordings as a raw zstandard dictionary; the one with the
most equal words less differing ones wins, then the one whose dictionary saves
the largest share of bytes.

Texts without a cue are put aside by Spark's own string functions. The others
are scanned whole where they are; nothing is shuffled, so it doesn't matter
how often a block or a source occurs. Equal blocks are looked up in a bounded
cache of the worker.

Inputs and their results: a null or empty text has no license; whole texts of
any length are scanned; several notices give a row each, on one line or next
to each other, and of those that overlap only the best; equal scores go by the
name of the license; repeated rows give the same rows again; a null id is kept; an
empty table gives an empty one; other columns are neither read nor returned.
"""

from __future__ import annotations

import bisect
import difflib
import functools
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dossier.llm.base import table

#: Lines without a cue that a block may hold between two lines with one.
BETWEEN = 3
SIMILARITY, LEVEL, CACHE = 0.8, 9, 20_000
#: Longer candidates are not kept in the cache.
CACHED = 4000

#: What a candidate must hold, in lower case. Every wording below
#: holds one; GAP is whatever stands between two words, a line break too.
GAP = r"[\W_]+"
CUES = ("licen", "copyright", "permission", "warrant", "redistribut", f"public{GAP}domain", "spdx",
        f"(?:released|distributed|available){GAP}under", f"under{GAP}the{GAP}terms{GAP}of")
CUE = re.compile("|".join(CUES))

#: How a short notice begins.
FORMS = ("Licensed under", "Released under", "Distributed under", "Available under", "This work is licensed under",
         "This project is licensed under", "This software is released under the terms of",
         "SPDX-License-Identifier:")

#: Words of the names below that tell no license from another.
COMMON = {"the", "license", "version", "gnu", "general", "public", "domain", "dedication", "universal", "creative",
          "commons", "attribution", "international", "by", "clause", "new", "simplified"}

#: Per license the names it goes by in short notices, and its usual wording.
LICENSES = {
    "Apache-2.0": (["the Apache License, Version 2.0", "Apache-2.0", "the Apache 2.0 License"], """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""),
    "MIT": (["the MIT License", "MIT", "the MIT license (MIT)"], """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software."""),
    "ISC": (["the ISC License", "ISC"], """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""),
    "BSD-2-Clause": (["the BSD 2-Clause License", "BSD-2-Clause", "the Simplified BSD License"], """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""),
    "BSD-3-Clause": (["the BSD 3-Clause License", "BSD-3-Clause", "the New BSD License"], """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""),
    "GPL-2.0": (["the GNU General Public License, version 2", "GPL-2.0", "GPLv2", "the GNU GPL v2"], """
This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details."""),
    "GPL-3.0": (["the GNU General Public License, version 3", "GPL-3.0", "GPLv3", "the GNU GPL v3"], """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details."""),
    "LGPL-3.0": (["the GNU Lesser General Public License, version 3", "LGPL-3.0", "LGPLv3"], """
This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later
version."""),
    "AGPL-3.0": (["the GNU Affero General Public License, version 3", "AGPL-3.0", "AGPLv3"], """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version."""),
    "MPL-2.0": (["the Mozilla Public License, version 2.0", "MPL-2.0", "the Mozilla Public License 2.0"], """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    "CC-BY-4.0": (["CC BY 4.0", "the Creative Commons Attribution 4.0 International License"], ""),
    "CC-BY-SA-4.0": (["CC BY-SA 4.0", "the Creative Commons Attribution-ShareAlike 4.0 International License"],
                     ""),
    "CC-BY-NC-4.0": (["CC BY-NC 4.0", "the Creative Commons Attribution-NonCommercial 4.0 International License"],
                     ""),
    "CC0-1.0": (["CC0 1.0", "the CC0 1.0 Universal Public Domain Dedication"], """
To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."""),
    "Unlicense": (["the Unlicense", "Unlicense"], """
This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means."""),
}

TOKEN = re.compile(r"[^\W_]+(?:\.\d+)*")


def words(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def wordings(name: str) -> list[str]:
    names, usual = LICENSES[name]
    return [f"{form} {n}." for n in names for form in FORMS] + [" ".join(usual.split())] * bool(usual)


def normal(text: str) -> str:
    """What is compressed: the words, so that case, marks and line breaks don't count."""
    return " ".join(words(text))


@dataclass
class Template:
    name: str
    forms: list[list[str]]
    #: Per form the words that may not differ.
    musts: list[set[str]]
    compressor: zstandard.ZstdCompressor


def compressor(content: str | None = None) -> zstandard.ZstdCompressor:
    raw = zstandard.ZstdCompressionDict(content.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT) if content else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_dict_id=False,
                                    write_checksum=False)


@functools.cache
def templates() -> tuple[zstandard.ZstdCompressor, list[Template], set[str]]:
    """The plain compressor, the licenses', and the words that tell them
    apart; built once per worker."""
    telling = {w for names, _ in LICENSES.values() for n in names for w in words(n)} - COMMON
    known = []
    for n in sorted(LICENSES):
        forms = [words(w) for w in wordings(n)]
        known.append(Template(n, forms, [{w for w in f if w in telling or w[0].isdigit()} for f in forms],
                              compressor("\n".join(map(normal, wordings(n))))))
    return compressor(), known, telling


def blocks(text: str) -> Iterator[tuple[int, int, str]]:
    """(first line, last line, text) of each candidate block."""
    lines, low = text.split("\n"), text.lower()
    cued, at, i = set(), 0, 0
    for m in CUE.finditer(low):
        i += low.count("\n", at, m.start())
        at = m.start()
        cued.update(range(i, i + 1 + m[0].count("\n")))
    first = last = -1
    for i in sorted(cued):
        if first >= 0 and i - last > BETWEEN + 1:
            yield first, last, "\n".join(lines[first:last + 1])
            first = -1
        first, last = (i if first < 0 else first), i
    if first >= 0:
        yield first, last, "\n".join(lines[first:last + 1])


def ranked(block: str) -> list[tuple[float, Template]]:
    """The licenses by the share of the block's bytes that they save, best first."""
    plain, known, _ = templates()
    data = normal(block).encode()
    alone = len(plain.compress(data))
    return sorted(((1 - len(t.compressor.compress(data)) / alone, t) for t in known), key=lambda x: (-x[0], x[1].name))


@functools.lru_cache(CACHE)
def savings(stretch: str) -> dict[str, float]:
    return {t.name: saved for saved, t in ranked(stretch)}


@functools.cache
def least_run(n: int) -> int:
    """The longest common run that a wording of ``n`` words has at least with a similar stretch."""
    return min(-(-equal // (n + part - 2 * equal + 1)) for part in range(1, longest(n) + 1)
               for equal in range(1, min(n, part) + 1) if 2 * equal >= SIMILARITY * (n + part))


def longest(n: int) -> int:
    """The most words of a stretch that is similar to a wording of ``n`` words."""
    return int(n * (2 / SIMILARITY - 1) + 1e-9)


def dense(form: list[str], at: dict[str, list[int]], lo: int, hi: int) -> list[tuple[int, int]]:
    """The parts of the block's words ``lo`` to ``hi`` where so many are the
    wording's that a stretch may be similar: equal words less half of
    SIMILARITY a word reach half of SIMILARITY for each of the wording."""
    worth = np.full(hi - lo, -SIMILARITY / 2)
    for w in set(form):
        for i in at.get(w, ()):
            if lo <= i < hi:
                worth[i - lo] += 1
    size = longest(len(form))
    sums = np.append(0, worth.cumsum())
    most = np.lib.stride_tricks.sliding_window_view(np.append(sums, np.full(size, sums[-1])), size + 1).max(axis=1)
    out: list[tuple[int, int]] = []
    for i in np.flatnonzero(most - sums >= SIMILARITY / 2 * len(form) - 1e-9).tolist():
        end = min(hi, lo + i + size)
        out.append((out.pop()[0] if out and out[-1][1] >= lo + i else lo + i, end))
    return out


def fits(form: list[str], must: set[str], block: list[str], lo: int, hi: int) -> Iterator[tuple[int, int, int, float, list[str]]]:
    """(first word, end, number and share of equal words, words that differ) of
    each stretch of the block's words ``lo`` to ``hi`` that the wording
    confirms. A stretch lies around a longest common run, from the first to
    the last equal word; the search goes on at both sides of it, or of the run
    if that isn't confirmed."""
    telling, slack, todo = templates()[2], len(form) // 5 + 1, [(lo, hi)]
    while todo:
        a, z = todo.pop()
        if not must.issubset(block[a:z]):
            continue
        run = difflib.SequenceMatcher(None, form, block[a:z], autojunk=False).find_longest_match()
        if run.size < least_run(len(form)):
            continue
        start = a + run.b - run.a
        side = max(a, start - slack)
        near = block[side:min(z, start + len(form) + slack)]
        ops = difflib.SequenceMatcher(None, form, near, autojunk=False).get_matching_blocks()[:-1]
        first, end = side + ops[0].b, side + ops[-1].b + ops[-1].size
        part = block[first:end]
        diff = difflib.SequenceMatcher(None, form, part, autojunk=False)
        changed = [f"{sign}{w}" for tag, i, j, k, m in diff.get_opcodes() if tag != "equal"
                   for sign, ws in (("-", form[i:j]), ("+", part[k:m])) for w in ws]
        if diff.ratio() >= SIMILARITY and not any(w[1:] in telling or w[1].isdigit() for w in changed):
            yield first, end, sum(m.size for m in diff.get_matching_blocks()), diff.ratio(), changed
            todo += [(a, first), (end, z)]
        else:
            todo += [(a, a + run.b), (a + run.b + run.size, z)]


Found = tuple[int, float, str, int, int, float, list[str]]


def confirmed(block: list[str], lo: int, hi: int) -> list[Found]:
    """(differing less equal words, - share saved, license, first word, end,
    similarity, differing words) of each stretch that a license confirms, best first."""
    found, at = [], defaultdict(list)
    for i in range(lo, hi):
        at[block[i]].append(i)
    for t in templates()[1]:
        for form, must in zip(t.forms, t.musts):
            if must <= at.keys():
                size = longest(len(form))
                # overlapping windows, so that the time is linear: each stretch is whole in one
                near = [(i, min(z, i + 2 * size)) for a, z in dense(form, at, lo, hi) for i in range(a, max(a + 1, z - size), size)]
                for a, z in near:
                    for first, end, equal, alike, changed in fits(form, must, block, a, z):
                        saved = savings(" ".join(block[first:end]))[t.name]
                        found.append((len(changed) - equal, -saved, t.name, first, end, alike, changed))
    return sorted(found)


@functools.lru_cache(CACHE)
def apart(near: str) -> list[Found]:
    """The confirmed stretches that don't overlap a better one; what is left
    between them is searched again."""
    block = near.split(" ")
    todo, out = [(0, len(block))], []
    while todo:
        lo, hi = todo.pop()
        if lo == hi:
            continue
        taken: list[tuple[int, int]] = []
        for f in confirmed(block, lo, hi):
            at = bisect.bisect(taken, (f[3], f[4]))
            if (at == 0 or taken[at - 1][1] <= f[3]) and (at == len(taken) or f[4] <= taken[at][0]):
                taken.insert(at, (f[3], f[4]))
                out.append(f)
        if taken:
            todo += zip([lo, *(z for _, z in taken)], [*(a for a, _ in taken), hi])
    return out


def reach() -> int:
    """Words beside a cue that may be of the same notice."""
    return max(longest(len(f)) for t in templates()[1] for f in t.forms)


def notices(text: str) -> list[tuple[int, int, Found]]:
    """(first line, last line, what is confirmed) near the cues of a text."""
    low = text.lower()
    marks = list(TOKEN.finditer(low))
    starts, mine = [m.start() for m in marks], [m[0] for m in marks]
    ends = [m.start() for m in re.finditer("\n", low)]
    near: list[tuple[int, int]] = []
    for m in CUE.finditer(low):
        a = max(0, bisect.bisect_right(starts, m.start()) - 1 - reach())
        z = min(len(mine), bisect.bisect_left(starts, m.end()) + reach())
        near.append((near.pop()[0] if near and near[-1][1] >= a else a, z))
    out = []
    for a, z in near:
        words_near = " ".join(mine[a:z])
        for f in (apart if len(words_near) <= CACHED else apart.__wrapped__)(words_near):
            first, last = (bisect.bisect_left(ends, starts[a + i]) for i in (f[3], f[4] - 1))
            out.append((first, last, f))
    return out


def verdict(block: str) -> tuple[str, float, float, list[str]] | None:
    """(license, share saved, similarity, differing words) of the winner, if one is confirmed."""
    found = [f for _, _, f in notices(block)]
    if not found:
        return None
    _, saved, name, _, _, alike, changed = min(found)
    return name, -saved, alike, changed


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, first_line, last_line, license, saved, similarity, n_differences,
    differences) per confirmed notice; lines count from 0."""
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    cued = plain.where(F.lower("text").rlike(CUE.pattern))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("first_line", T.IntegerType()),
                           T.StructField("last_line", T.IntegerType()), T.StructField("license", T.StringType()),
                           T.StructField("saved", T.DoubleType()), T.StructField("similarity", T.DoubleType()),
                           T.StructField("n_differences", T.IntegerType()), T.StructField("differences", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for b in batches:
            at, found = [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                lines = text.split("\n")
                for first, last, _ in blocks(text):
                    # a notice may go on in the lines beside its cue's
                    above = max(0, first - BETWEEN)
                    for a, z, (_, saved, name, _, _, alike, changed) in notices("\n".join(lines[above:last + BETWEEN + 1])):
                        if above + a <= last and above + z >= first:
                            at.append(i)
                            found.append((above + a, above + z, name, -saved, alike, len(changed), " ".join(changed)))
            columns = list(zip(*found)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(at, pa.int64()))] + [pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:])],
                schema=arrow)

    return cued.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents"))


QUERIES = {"op10_license_scans": op10_license_scans}
ORACLE: dict[str, str] = {}
