"""License scans by conditional compression.

A block of text that repeats a license needs few bytes if the license is known. Candidate blocks
(lines with words of licenses, and what lies between them) are compressed alone and with each
template as a raw dictionary; templates are ranked by the bytes they save. The best ones, and those
that save nearly as much, are then compared word by word with the region of the template around the
longest run of words that both have. The one with the fewest differing words is the finding, if at least
``CONFIRMED`` of the block's words stand in that region in the same order and no difference contradicts
the name or the version of the license: its own name, as in a heading, may be added, other names not, and
none may be missing or changed. The differences in wording are part of the result.

Blocks near each other are looked at together. Stretches of them that follow a template (runs of
``GRAM`` words in the template's order) are candidates from the longest on; each that is confirmed is a
finding, with the headings and copyright lines next to it, and what lies around it is looked at on its
own, so several licenses in a file, or one license twice, are several findings. Where nothing follows a
template at length, the blocks are one finding if they are one license with what lies between them,
and else each is looked at.

A template is a license's notices and its whole text (of AGPL-3.0 and the CC BY licenses the notices only).

Null and empty texts have no blocks. Repeated rows have equal findings. Ties go to the template
with the smaller name. Long lines are cut into sentences first; all of them are looked at. In very long
texts the stretches are found in one walk over the words, and only they are compared word by word.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher
from importlib.resources import files
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cooccur.llm.frames import arrow_rows
from cooccur.llm.text import chunks

#: Templates that are compared word by word, in order of the bytes saved.
BEST = 3
#: Least share of a block's bytes that a template must save, and of its words that it must hold.
SAVED = 0.25
CONFIRMED = 0.8
LONG_LINE = 300
#: Most characters between blocks that are first looked at as one.
NEAR = 4000
#: Words that a stretch shares with a template at a time, most words between two such places, fewest words of a stretch.
GRAM, GAP, STRETCH = 6, 60, 24
#: Most characters between a stretch and a heading or copyright line of it.
BESIDE = 200

#: Fixed texts: how the licenses are named in notices, and the licenses themselves if they are short.
TEMPLATES = {
    "Apache-2.0": """licensed under the apache license, version 2.0 (the "license"); you may not use this file except in
        compliance with the license. you may obtain a copy of the license at http://www.apache.org/licenses/license-2.0
        unless required by applicable law or agreed to in writing, software distributed under the license is distributed on
        an "as is" basis, without warranties or conditions of any kind, either express or implied.
        released under the apache license, version 2.0. this work is licensed under the apache license 2.0.""",
    "MIT": """permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "software"), to deal in the software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to
        permit persons to whom the software is furnished to do so. the above copyright notice and this permission notice
        shall be included in all copies or substantial portions of the software. the software is provided "as is", without
        warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness
        for a particular purpose and noninfringement. in no event shall the authors or copyright holders be liable for any
        claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in
        connection with the software or the use or other dealings in the software. released under the mit license. licensed under the mit license. this work is licensed under
        the mit license.""",
    "GPL-3.0": """this program is free software: you can redistribute it and/or modify it under the terms of the gnu general
        public license as published by the free software foundation, either version 3 of the license, or (at your option)
        any later version. this program is distributed in the hope that it will be useful, but without any warranty; without
        even the implied warranty of merchantability or fitness for a particular purpose. this work is licensed under the
        gnu general public license, version 3. released under the gnu general public license, version 3. licensed under the
        gnu general public license v3.""",
    "GPL-2.0": """this program is free software; you can redistribute it and/or modify it under the terms of the gnu general
        public license as published by the free software foundation; either version 2 of the license, or (at your option)
        any later version. this work is licensed under the gnu general public license, version 2. released under the gnu
        general public license, version 2. licensed under the gnu general public license v2.""",
    "LGPL-2.1": """this library is free software; you can redistribute it and/or modify it under the terms of the gnu lesser
        general public license as published by the free software foundation; either version 2.1 of the license, or (at your
        option) any later version. this work is licensed under the gnu lesser general public license, version 2.1. released
        under the gnu lesser general public license, version 2.1. licensed under the gnu lesser general public license v2.1.""",
    "LGPL-3.0": """this program is free software: you can redistribute it and/or modify it under the terms of the gnu lesser
        general public license as published by the free software foundation, either version 3 of the license, or (at your
        option) any later version. this program is distributed in the hope that it will be useful, but without any warranty;
        without even the implied warranty of merchantability or fitness for a particular purpose. see the gnu lesser general
        public license for more details. you should have received a copy of the gnu lesser general public license along with
        this program. if not, see https://www.gnu.org/licenses/. this work is licensed under the gnu lesser general public
        license, version 3. released under the gnu lesser general public license, version 3. licensed under the gnu lesser
        general public license v3.""",
    "AGPL-3.0": """this program is free software: you can redistribute it and/or modify it under the terms of the gnu affero
        general public license as published by the free software foundation, either version 3 of the license, or (at your
        option) any later version. this program is distributed in the hope that it will be useful, but without any warranty;
        without even the implied warranty of merchantability or fitness for a particular purpose. see the gnu affero general
        public license for more details. you should have received a copy of the gnu affero general public license along with
        this program. if not, see https://www.gnu.org/licenses/. this work is licensed under the gnu affero general public
        license, version 3. released under the gnu affero general public license, version 3. licensed under the gnu affero
        general public license v3.""",
    "BSD-3-Clause": """redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. 2. redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
        the distribution. 3. neither the name of the copyright holder nor the names of its contributors may be used to endorse
        or promote products derived from this software without specific prior written permission. DISCLAIMER released under
        the bsd 3-clause license. licensed under the bsd license.""",
    "BSD-2-Clause": """redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. 2. redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
        the distribution. DISCLAIMER released under the bsd 2-clause license. licensed under the bsd 2-clause license.""",
    "ISC": """permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. the software is
        provided "as is" and the author disclaims all warranties with regard to this software including all implied warranties
        of merchantability and fitness. in no event shall the author be liable for any special, direct, indirect, or
        consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of
        contract, negligence or other tortious action, arising out of or in connection with the use or performance of this
        software. released under the isc license. licensed under the isc license.""",
    "MPL-2.0": """this source code form is subject to the terms of the mozilla public license, v. 2.0. if a copy of the mpl was
        not distributed with this file, you can obtain one at http://mozilla.org/mpl/2.0/. licensed under the mozilla public
        license, version 2.0. released under the mozilla public license.""",
    "CC-BY-4.0": """this work is licensed under the creative commons attribution 4.0 international license. licensed under cc
        by 4.0. released under cc by 4.0.""",
    "CC-BY-SA-4.0": """this work is licensed under the creative commons attribution-sharealike 4.0 international license.
        licensed under cc by-sa 4.0. released under cc by-sa 4.0.""",
    "CC-BY-NC-4.0": """this work is licensed under the creative commons attribution-noncommercial 4.0 international license.
        licensed under cc by-nc 4.0. released under cc by-nc 4.0.""",
    "CC0-1.0": """to the extent possible under law, the author has waived all copyright and related or neighboring rights to
        this work. licensed under cc0 1.0. dedicated to the public domain under cc0 1.0 universal.""",
    "proprietary": """all rights reserved. no part of this work may be reproduced or distributed in any form without the prior
        written permission of the owner. copyright. unauthorized copying is prohibited. proprietary and confidential.""",
}
#: What the licenses are called, in their ids and their notices.
NOTICES = dict(TEMPLATES)
_DISCLAIMER = """this software is provided by the copyright holders and contributors "as is" and any express or implied warranties,
    including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed.
    in no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or
    consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or
    profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or
    tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the
    possibility of such damage."""
for _name in ("BSD-2-Clause", "BSD-3-Clause"):
    TEMPLATES[_name] = TEMPLATES[_name].replace("DISCLAIMER", _DISCLAIMER)
#: The whole texts of the longer licenses.
for _name in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"):
    TEMPLATES[_name] += "\n" + files("cooccur.llm").joinpath("license_texts", f"{_name}.txt").read_text("utf-8")
#: Words that name a license, those that a version follows, and versions.
NAMES = frozenset((
    "apache mit gnu gpl lgpl agpl lesser library affero bsd isc mozilla mpl attribution attribution-sharealike attribution-noncommercial "
    "sharealike noncommercial noderivatives by by-sa by-nc by-nd by-nc-sa by-nc-nd cc cc0").split()) - {"by", "library"}
VERSIONED = NAMES | {"version", "v", "license", "licence", "by", "international"}
_VERSION = re.compile(r"v?\d{1,2}(?:\.\d+)*")
_NUMBERED = re.compile(r"(?:v\d[\d.]*|[al]?gplv?\d[\d.]*|\d-clause|(?:by-|cc)[\w.-]+)")
TRIGGERS = ("licens", "licenc", "copyright", "warranty", "redistribut", "all rights reserved", "public domain", "permission is hereby", "©")
_TRIGGER = re.compile("|".join(map(re.escape, TRIGGERS)), re.IGNORECASE)
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
_SENTENCE = re.compile(r"(?<=[.!?;])\s+")


class Template(NamedTuple):
    """A license's words, its names and versions, where its runs of ``GRAM`` words stand, and a compressor that knows it."""

    name: str
    words: list[str]
    names: frozenset[str]
    places: dict[tuple[str, ...], list[int]]
    compressor: zstandard.ZstdCompressor


def _plain(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _compressor(dictionary: bytes | None) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters.from_level(
        19, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
    known = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if dictionary else None
    return zstandard.ZstdCompressor(compression_params=parameters, dict_data=known)


def _templates(texts: dict[str, str]) -> list[Template]:
    made = []
    for name in sorted(texts):
        words = _plain(texts[name])
        notice = _plain(NOTICES[name]) if texts is TEMPLATES or texts.get(name) == TEMPLATES.get(name) else words
        names = {*_named(notice, 0, len(notice)), name.lower(), *name.lower().split("-"), name.lower().partition("-")[2]}
        places: dict[tuple[str, ...], list[int]] = {}
        for i in range(len(words) - GRAM + 1):
            places.setdefault(tuple(words[i: i + GRAM]), []).append(i)
        made.append(Template(name, words, frozenset(names), places, _compressor(" ".join(words).encode())))
    return made


def segments(text: str) -> list[tuple[int, int]]:
    """Lines; long lines by sentence. (start, end) of each."""
    out, at = [], 0
    for line in text.split("\n"):
        end = at + len(line)
        if len(line) <= LONG_LINE:
            out.append((at, end))
        else:
            start = at
            for cut in _SENTENCE.finditer(text, at, end):
                out.append((start, cut.start()))
                start = cut.end()
            out.append((start, end))
        at = end + 1
    return out


def blocks(text: str) -> list[tuple[int, int]]:
    """Runs of segments with a trigger, together with up to two segments between them."""
    found: list[list[int]] = []
    for place, (start, end) in enumerate(segments(text)):
        if _TRIGGER.search(text, start, end):
            if found and place - found[-1][2] <= 3:
                found[-1][1:] = [end, place]
            else:
                found.append([start, end, place])
    return [(start, end) for start, end, _ in found]


class Finding(NamedTuple):
    license: str
    plain_bytes: int
    known_bytes: int
    matched_words: int
    block_words: int
    differences: list[str]


def _named(words: list[str], low: int, high: int) -> list[str]:
    """The names and versions of licenses among ``words[low:high]``."""
    return [
        words[i] for i in range(low, high)
        if words[i] in NAMES or _NUMBERED.fullmatch(words[i]) is not None or (i > 0 and words[i - 1] in VERSIONED and _VERSION.fullmatch(words[i]) is not None)]


def _wording(block: list[str], license: Template) -> tuple[int, list[str], bool]:
    """(words of the block that stand in the template's best region in order, the differences, whether one contradicts its name)"""
    template = license.words
    anchor = SequenceMatcher(None, template, block, autojunk=False).find_longest_match()
    if not anchor.size:
        return 0, [f"+{w}" for w in block], True
    slack = len(block) // 4 + 8
    low = max(0, anchor.a - anchor.b - slack)
    template = template[low: anchor.a - anchor.b + len(block) + slack]
    matcher = SequenceMatcher(None, template, block, autojunk=False)
    matched = [m for m in matcher.get_matching_blocks() if m.size]
    first, last = matched[0].a, matched[-1].a + matched[-1].size
    differences, contradicted = [], False
    for kind, a0, a1, b0, b1 in matcher.get_opcodes():
        if kind != "equal":
            a0, a1 = max(a0, first), min(a1, last)
            differences += [f"-{w}" for w in template[a0:a1]]
            differences += [f"+{w}" for w in block[b0:b1]]
            missing, added = _named(template, a0, a1), _named(block, b0, b1)
            contradicted = contradicted or not license.names.issuperset(added) or not set(added).issuperset(missing)
    return sum(m.size for m in matched), differences, contradicted


def identify(block: str, templates: list[Template], alone: zstandard.ZstdCompressor) -> Finding | None:
    words = _plain(block)
    data = " ".join(words).encode()
    if not data:
        return None
    plain = len(alone.compress(data))
    ranked = sorted((len(t.compressor.compress(data)), t.name, t) for t in templates)
    findings = []
    nearly = ranked[min(BEST, len(ranked)) - 1][0] + max(8, plain // 10)
    for size, name, template in ranked:
        if size <= nearly and plain - size >= SAVED * plain:
            matched, differences, contradicted = _wording(words, template)
            if matched >= CONFIRMED * len(words) and not contradicted:
                findings.append((len(differences), size, name, Finding(name, plain, size, matched, len(words), differences)))
    return min(findings)[3] if findings else None


def stretches(words: list[str], template: Template) -> list[tuple[int, int]]:
    """(first, end) of the stretches of words that follow the template: equal runs of words in its order, close to each other."""
    found: list[list[int]] = []  # first, end, place in the template of the last run
    for i in range(len(words) - GRAM + 1):
        places = template.places.get(tuple(words[i: i + GRAM]))
        if places is None:
            continue
        if found:
            first, end, at = found[-1]
            step = i - (end - GRAM)
            near = min(places, key=lambda p: abs(p - at - step))
            if step <= GAP + GRAM and at < near <= at + step + GAP:
                found[-1][1:] = [i + GRAM, near]
                continue
        found.append([i, i + GRAM, places[0]])
    return [(first, end) for first, end, _ in found if end - first >= STRETCH]


def _long_findings(text: str, low: int, high: int, templates: list[Template], alone) -> list[tuple[int, int, Finding]]:
    """Confirmed stretches of ``text[low:high]``, by place; each begins and ends with a line or sentence."""
    found = [(m.start() + low, m.end() + low, m.group().lower()) for m in _WORD.finditer(text[low:high])]
    words = [w for _, _, w in found]
    candidates = sorted({s for t in templates for s in stretches(words, t)}, key=lambda s: (s[0] - s[1], s[0]))
    if not candidates:
        return []
    cuts = [(start + low, end + low) for start, end in segments(text[low:high])]
    starts, ends = [c[0] for c in cuts], [c[1] for c in cuts]
    taken: list[tuple[int, int, Finding]] = []
    tried: set[tuple[int, int]] = set()
    for first, last in candidates:
        start, end = starts[bisect_right(starts, found[first][0]) - 1], ends[bisect_left(ends, found[last - 1][1])]
        # What a longer stretch has been confirmed for is cut away.
        for a, b, _ in taken:
            if a < end and start < b:
                start, end = (b, end) if end - b > a - start else (start, a)
        if end <= start or (start, end) in tried or len(_plain(text[start:end])) < STRETCH:
            continue
        tried.add((start, end))
        finding = identify(text[start:end], templates, alone)
        if finding:
            taken.append((start, end, finding))
    return sorted(taken, key=lambda f: f[:2])


def confirmed(text: str, templates: list[Template], alone: zstandard.ZstdCompressor) -> Iterator[tuple[int, int, Finding]]:
    """(start, end, finding) of a text: long stretches first, of the other blocks near each other together, or else of each."""
    groups: list[list[tuple[int, int]]] = []
    for block in blocks(text):
        if groups and block[0] - groups[-1][-1][1] <= NEAR:
            groups[-1].append(block)
        else:
            groups.append([block])
    for n, group in enumerate(groups):
        low, high = group[0][0], group[-1][1]
        # A license may begin before and end after the lines with its words: at most where the next group does.
        before = max(groups[n - 1][-1][1] if n else 0, low - NEAR)
        after = min(groups[n + 1][0][0] if n + 1 < len(groups) else len(text), high + NEAR)
        taken = _long_findings(text, before, after, templates, alone)
        if not taken:
            together = identify(text[low:high], templates, alone)
            found = [(low, high, together)] if together else [
                (start, end, identify(text[start:end], templates, alone)) for start, end in group] if len(group) > 1 else []
            yield from (f for f in found if f[2])
            continue
        for start, end in _between(group, taken):
            beside = [i for i, (a, b, _) in enumerate(taken) if -BESIDE <= a - end <= BESIDE or -BESIDE <= start - b <= BESIDE]
            for i in beside:
                a, b, own = taken[i]
                joined = identify(text[min(a, start): max(b, end)], templates, alone)
                if joined and joined.license == own.license:
                    taken[i] = (min(a, start), max(b, end), joined)
                    break
            else:
                finding = identify(text[start:end], templates, alone)
                if finding:
                    taken.append((start, end, finding))
        yield from sorted(taken, key=lambda f: f[:2])


def _between(group: list[tuple[int, int]], taken: list[tuple[int, int, Finding]]) -> list[tuple[int, int]]:
    """What the blocks hold outside of the findings."""
    rest = []
    for start, end in group:
        for a, b, _ in taken:
            if a < end and start < b:
                if start < a:
                    rest.append((start, a))
                start = b
        if start < end:
            rest.append((start, end))
    return rest


def _may_hold(text: Column) -> Column:
    lowered = F.lower(text)
    found = F.lit(False)
    for trigger in TRIGGERS:
        found = found | F.contains(lowered, F.lit(trigger))
    return found


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """A row for every confirmed block: keep, its span in characters, license, sizes, words, differences, and its text."""
    texts = dict(TEMPLATES if templates is None else templates)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("_license_text"))
    names = [*keep, "start", "end", "license", "plain_bytes", "known_bytes", "matched_words", "block_words", "differences", "block"]

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known, alone = _templates(texts), _compressor(None)
        for chunk in chunks(batch.column(len(keep))):
            place, found = [], []
            for i, (low, high) in enumerate(zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist(), strict=True)):
                text = chunk.text(low, high)
                for start, end, finding in confirmed(text, known, alone):
                    place.append(chunk.first + i)
                    found.append((start, end, *finding, text[start:end]))
            columns = list(zip(*found, strict=True)) or [()] * 9
            kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.int32()] * 4, pa.list_(pa.string()), pa.string()]
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c).take(pa.array(place, pa.int32())) for c in range(len(keep))],
                *[pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]], names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return arrow_rows(rows.where(_may_hold(F.col("_license_text"))), work, ", ".join([
        *fields, "start int, end int, license string, plain_bytes int, known_bytes int, matched_words int, block_words int",
        "differences array<string>, block string"]))
