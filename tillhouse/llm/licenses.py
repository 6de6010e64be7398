"""License notices in texts, by conditional compression against reference wordings.

The words around each cue are cut into windows of a fixed number of words, whatever the lines are; windows overlap by
more than the longest notice, so each notice lies whole in one of them. The parts of a window that may hold a wording
are compressed with that wording as a raw zstandard dictionary. What saves less than SAVED of the plain size is no
candidate; candidates are ranked by the bytes they save, and the winner's words that differ from the wording tell
whether it is the notice (`exact`), a changed notice (`changed`) or none.

Defined results: a NULL or empty text has no notice. A text of any length is read whole, in windows. A notice has at least
FOUND of the words of a wording in order (all of a short one), not more words put in than the wording has, and no
other license's name. Of notices that overlap, the one that saves most counts, then that with fewer differences, then
the license that sorts first. A notice starts where its first word does. Repeated rows are scanned one by one.
Columns other than id and text are not looked at. What has lost every cue word is not a notice.
"""

from __future__ import annotations

import math
import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache

import zstandard
from pyspark.sql import DataFrame

from tillhouse.llm.common import map_rows

# The usual wording of public license notices, by SPDX identifier. The conditions BSD licenses begin with, alone, count as
# BSD-3-Clause.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has dedicated all copyright to the public domain worldwide.",
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "all-rights-reserved": "All rights reserved. No part may be reproduced without permission.",
}
#: Names that notices give their license; wordings are made of these with each of OPENINGS.
NAMES = {
    "AGPL-3.0": ["the GNU Affero General Public License, version 3", "the GNU Affero General Public License v3.0", "the GNU AGPL v3", "the AGPLv3"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License", "Apache-2.0"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License", "the FreeBSD License"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License", "the Modified BSD License"],
    "CC-BY-4.0": ["CC BY 4.0", "CC-BY-4.0", "the Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "CC-BY-NC-4.0", "the Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0", "CC-BY-NC-ND-4.0", "the Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0", "the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "CC-BY-ND-4.0", "the Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "CC-BY-SA-4.0", "the Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0 1.0", "CC0-1.0", "the Creative Commons CC0 1.0 Universal License"],
    "GPL-1.0-or-later": ["the GNU General Public License", "the GNU GPL"],  # no version given
    "GPL-2.0": ["the GNU General Public License, version 2", "the GNU General Public License v2.0", "the GNU GPL v2", "the GPLv2"],
    "GPL-3.0": ["the GNU General Public License, version 3", "the GNU General Public License v3.0", "the GNU GPL v3", "the GPLv3"],
    "ISC": ["the ISC License"],
    "LGPL-2.1": ["the GNU Lesser General Public License, version 2.1", "the GNU Lesser General Public License v2.1", "the GNU LGPL v2.1", "the LGPLv2.1"],
    "LGPL-3.0": ["the GNU Lesser General Public License, version 3", "the GNU Lesser General Public License v3.0", "the GNU LGPL v3", "the LGPLv3"],
    "MIT": ["the MIT License", "the Expat License"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0", "the MPL 2.0"],
    "Unlicense": ["the Unlicense"],
}
OPENINGS = ["Licensed under", "Released under", "Distributed under", "Available under", "Published under", "Licensed under the terms of", "or", "and"]
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_GNU = (
    "{0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} General Public License as published by "
    "the Free Software Foundation{2} either version {3} of the License, or (at your option) any later version."
)
#: Other grants and wordings, beside those of TEMPLATES.
GRANTS = [
    ("AGPL-3.0", _GNU.format("This program", "Affero", ",", "3")),
    ("BSD-2-Clause", _BSD),
    (
        "BSD-3-Clause",
        f"{_BSD} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
    ),
    ("LGPL-2.1", _GNU.format("This library", "Lesser", ";", "2.1")),
    ("LGPL-3.0", _GNU.format("This library", "Lesser", ",", "3")),
    ("LGPL-3.0", _GNU.format("This program", "Lesser", ",", "3")),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "Unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    ("all-rights-reserved", "All rights reserved."),
]
#: (license, wording): all that notices are compared with, each wording once.
WORDINGS = [(license_, text) for license_, text in TEMPLATES.items()] + GRANTS
WORDINGS += [(license_, f"{opening} {name}.") for license_, names in NAMES.items() for name in names for opening in OPENINGS]
WORDINGS += [
    (license_, f"SPDX-License-Identifier: {license_}{end}") for license_ in NAMES for end in (("", "-only", "-or-later") if "GPL" in license_ and license_[-1] == "0" else ("",))
]
WORDINGS += [("LGPL-2.1", f"SPDX-License-Identifier: LGPL-2.1-{end}") for end in ("only", "or-later")]
CUE = re.compile(
    r"(?i:licen[sc]|copyright|\breserved\b|redistribut|permission|public\W+domain|warrant|\bcc0|\bcc[ -]by|creative\W+commons|gpl)"
    r"|\b(?:MIT|BSD|ISC|GNU|MPL|Apache|Mozilla|Anyone is free)\b"
)
#: Each cue has one of these in lower case, or one of the others as it is.
STEMS = ["licens", "licenc", "copyright", "reserved", "redistribut", "permission", "public", "warrant", "cc0", "cc-by", "cc by", "creative", "gpl"]
CAPITALS = ["MIT", "BSD", "ISC", "GNU", "MPL", "Apache", "Mozilla", "Anyone is free"]
#: Least share of the wording's words found in order.
FOUND = 0.75
#: Wordings up to this length have to be complete.
SHORT = 4
#: What a word in its place counts against a word put in, when a wording is aligned.
IN_PLACE = 4
_WORD = re.compile(r"[\w.+-]*\w")
#: Least share of its plain size that a notice loses when it is compressed with its wording.
SAVED = 0.2
#: What a word that differs counts against the bytes saved.
BYTES_A_WORD = 2
#: Words that name a license: with another one a wording is that of another license.
_NAME = re.compile(
    r"(a|l|f)?gpl(v?[\d.]+)?|gnu|lesser|affero|mit|expat|apache(-[\d.]+)?|(free)?bsd|(2|3)-clause|simplified|isc|mozilla|mpl|unlicense|zlib|eclipse|boost"
    r"|cc0?(-[\d.]+)?|(cc-)?by-(nc|nd|sa|nc-sa|nc-nd)(-[\d.]+)?|cc-by-[\d.]+|attribution(-\w+)*|noncommercial|sharealike|noderivatives"
    r"|(agpl|lgpl|gpl)-[\w.-]+|mpl-[\d.]+"
)


def _block(words: list[str]) -> bytes:
    """What is compressed: the words alone, whatever their lines and what stands before them."""
    return " ".join(words).encode(errors="replace")


@cache
def _compressors() -> dict[int, zstandard.ZstdCompressor]:
    out = {
        k: zstandard.ZstdCompressor(
            level=3, dict_data=zstandard.ZstdCompressionDict(_block(_template_words(k)), dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_checksum=False, write_content_size=False
        )
        for k in range(len(WORDINGS))
    }
    return out | {-1: zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=False)}


@cache
def _template_words(k: int) -> list[str]:
    return _WORD.findall(WORDINGS[k][1].lower())


def least(n: int) -> int:
    """How many of a wording's words must be there: all of a short one."""
    return n if n <= SHORT else math.ceil(FOUND * n)


def most_put_in(n: int) -> int:
    """How many words may be put into a wording."""
    return n if n > SHORT else n - 2


@cache
def reach() -> int:
    """Words that the longest notice may span."""
    return max(len(_template_words(k)) + most_put_in(len(_template_words(k))) for k in range(len(WORDINGS)))


def windows(text: str) -> Iterator[list[tuple[str, int, int]]]:
    """The words (in lower case, start, end) around cues: `reach` words before and after each, in overlapping windows."""
    cues = (m.start() for m in CUE.finditer(text))
    cue = next(cues, None)
    if cue is None:
        return
    margin, held, left = reach(), [], 0
    for m in _WORD.finditer(text):
        held.append((m.group().lower(), m.start(), m.end()))
        if cue is not None and cue < m.end():
            left = margin + 1
            while cue is not None and cue < m.end():
                cue = next(cues, None)
        elif not left:
            if cue is None:
                return
            if len(held) > 2 * margin:
                del held[:-margin]
            continue
        left -= 1
        if not left or len(held) >= 4 * margin:
            yield held
            held = held[-margin:]
    if left:
        yield held


def _parts(words: list[str], k: int) -> list[tuple[int, int]]:
    """Where a wording may be: parts of the words with enough of its own close together."""
    wanted = Counter(_template_words(k))
    n = wanted.total()
    span, have, enough, left = n + most_put_in(n), Counter(), 0, 0
    hits = [i for i, word in enumerate(words) if word in wanted]
    out: list[tuple[int, int]] = []
    for i in hits:
        have[words[i]] += 1
        enough += have[words[i]] <= wanted[words[i]]
        while hits[left] <= i - span:
            gone = words[hits[left]]
            enough -= have[gone] <= wanted[gone]
            have[gone] -= 1
            left += 1
        if enough >= least(n):
            if out and hits[left] <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((hits[left], i + 1))
    return out


def aligned(words: list[str], wanted: list[str]) -> list[int]:
    """Places of the words that belong to the best alignment of the wording with a part of the words.

    Names of licenses that the wording has must be there, and no others in between.
    """
    n = len(wanted)
    named = [bool(_NAME.fullmatch(w)) for w in wanted]
    first_name = named.index(True) if any(named) else n
    last_name = n - 1 - named[::-1].index(True) if any(named) else -1
    places: dict[str, list[int]] = {}
    for i, w in enumerate(wanted):
        places.setdefault(w, []).append(i)
    # by words of the wording used up: score and places of the best alignment that is under way
    before: list[tuple[int, tuple | None] | None] = [None] * (n + 1)
    best: tuple[int, tuple | None] = (0, None)
    for j, word in enumerate(words):
        own = places.get(word, ())
        if not own and _NAME.fullmatch(word):
            before = [None] * (n + 1)
            continue
        now: list[tuple[int, tuple | None] | None] = [state and (state[0] - 1, state[1]) if state and state[0] > 1 else None for state in before]
        for i in own:
            last = before[i]
            if last is None or last[0] <= 0:
                last = (0, None) if i <= first_name else None
            if last and (now[i + 1] is None or now[i + 1][0] < last[0] + IN_PLACE):
                now[i + 1] = (last[0] + IN_PLACE, (j, last[1]))
                if i >= last_name and now[i + 1][0] > best[0]:
                    best = now[i + 1]
        for i in range(n):  # words of the wording that are left out
            if now[i] and not named[i] and (now[i + 1] is None or now[i + 1][0] < now[i][0]):
                now[i + 1] = now[i]
        before = now
    out, at = [], best[1]
    while at:
        out.append(at[0])
        at = at[1]
    return out[::-1]


def _fits(words: list[str], k: int) -> Iterator[tuple[int, int, int]]:
    """(first, end, found) of each place of a wording among the words."""
    wanted = _template_words(k)
    todo = _parts(words, k)
    while todo:
        low, high = todo.pop()
        if high - low < least(len(wanted)):
            continue
        at = aligned(words[low:high], wanted)
        if not at:
            continue
        first, end = low + at[0], low + at[-1] + 1
        good = len(at) >= least(len(wanted)) and end - first - len(at) <= most_put_in(len(wanted))
        if good:
            yield first, end, len(at)
        for start, stop in ((low, first), (end if good else first + 1, high)):
            todo += [(start + a, start + b) for a, b in _parts(words[start:stop], k)]


def blocks(fits: list[tuple[int, int, int, int]]) -> Iterator[list[tuple[int, int, int, int]]]:
    """Places (first, end, ...) that overlap, directly or by way of others, together."""
    held: list[tuple[int, int, int, int]] = []
    end = 0
    for fit in sorted(fits):
        if held and fit[0] >= end:
            yield held
            held, end = [], 0
        held.append(fit)
        end = max(end, fit[1])
    if held:
        yield held


def match(text: str, window: list[tuple[str, int, int]]) -> list[tuple[int, int, str, float, int, int]]:
    """(start, end, license, share saved, words that differ, rank) of all that may be a notice in a window.

    The parts of the window that wordings may have are candidate blocks. A block is compressed with each of these wordings as
    its dictionary, and ranks them by the bytes they save of the whole block; a size is true to a byte or two, so words that
    differ count against it. Only what saves enough of its own part's plain size is a candidate.
    """
    words = [word for word, _, _ in window]
    tools, out, have = _compressors(), [], set(words)
    fits = []
    for k in range(len(WORDINGS)):
        wanted = _template_words(k)
        if sum(word in have for word in wanted) >= least(len(wanted)):
            fits += [(first, end, k, found) for first, end, found in _fits(words, k)]
    for block in blocks(fits):
        whole = _block(words[block[0][0] : max(end for _, end, _, _ in block)])
        plain = len(tools[-1].compress(whole))
        saved = {k: plain - len(tools[k].compress(whole)) for k in {k for _, _, k, _ in block}}
        for first, end, k, found in block:
            own = _block(words[first:end])
            share = 1 - len(tools[k].compress(own)) / len(tools[-1].compress(own))
            different = len(_template_words(k)) - found + (end - first - found)
            if share >= SAVED:
                out.append((window[first][1], window[end - 1][2], WORDINGS[k][0], share, different, saved[k] - BYTES_A_WORD * different))
    return out


def notices(text: str) -> list[tuple[int, int, str, float, int, int]]:
    """All notices of a text in its order; what several windows or wordings find at one place is one notice.

    Candidates are taken by their rank, highest first, and keep others away from their place.
    """
    lower = text.lower()
    if not any(stem in lower for stem in STEMS) and not any(stem in text for stem in CAPITALS):
        return []  # much faster than the pattern, for the many texts without a cue
    found = {one for window in windows(text) for one in match(text, window)}
    starts: list[int] = []
    out: list[tuple] = []
    for one in sorted(found, key=lambda x: (-x[5], x[4], x[2], x[0])):
        at = bisect(starts, one[0])
        if (not at or out[at - 1][1] <= one[0]) and (at == len(out) or one[1] <= out[at][0]):
            starts.insert(at, one[0])
            out.insert(at, one)
    return out


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, start (in characters), license, saved, n_different, wording of the notices."""

    def work(batches: Iterable[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("doc_id", "start", "license", "saved", "n_different", "wording")}
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                for start, _, name, saved, different, _ in notices(text or ""):
                    for c, value in zip(out, (doc_id, start, name, saved, different, "changed" if different else "exact"), strict=True):
                        out[c].append(value)
            yield out

    return map_rows(documents.select("doc_id", "text"), work, "doc_id long, start long, license string, saved double, n_different int, wording string")
