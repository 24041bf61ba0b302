"""License scans by conditional compression.

A block is a stretch of words around license vocabulary. It is compressed alone and once more with each template as a raw zstandard
dictionary; what the dictionary saves ranks the templates. They are
confirmed by their exact wording: the block is aligned with each ranked passage word by word, and a place counts only if
the words that differ from the passage are few; they are returned as they stand. Every license with a confirmed place
of its own is returned, however many a block has: confirmed places are masked and the rest of the block is ranked again.

Texts without license vocabulary are filtered by Spark; the others are read whole, in Arrow batches, without a shuffle.
Templates are a parameter (a few kB).

Defined results: null and empty texts have no blocks; a block whose wording no template confirms is returned with
``confirmed`` false and the best ranked template; repeated rows are scanned alike; an empty table gives an empty
result; other columns are not read. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latewatch.llm.inputs import TaskCache, by_size, texts

# Notices and the distinctive passages of common licenses, as their publishers word them.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version.",
    ),
    "BSD": (
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    "BSD-2-Clause": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    "BSD-3-Clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any "
        "later version.",
    ),
    "LGPL-3.0": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
        "is available at",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "Zlib": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter "
        "it and redistribute it freely, subject to the following restrictions:",
    ),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, "
        "and transmit the Software, and to prepare derivative works of the Software",
    ),
    "OFL-1.1": (
        "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    ),
    "Artistic-2.0": (
        "Licensed under the Artistic License 2.0.",
    ),
    "CDDL-1.0": (
        "The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\"). "
        "You may not use this file except in compliance with the License.",
    ),
    "WTFPL": (
        "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is "
        "allowed as long as the name is changed.",
    ),
    "EUPL-1.2": (
        "Licensed under the EUPL, Version 1.2.",
    ),
    "MS-PL": (
        "This license governs use of the accompanying software. If you use the software, you accept this license. If you do not "
        "accept the license, do not use the software.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-ND-4.0": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-NC-SA-4.0": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "CC0-1.0": (
        "Dedicated to the public domain under CC0 1.0.",
    ),
}
CUES = r"(?i)licen[sc]e|copyright|permission|redistribut|creative commons|public domain|all rights reserved"
AROUND = 40
LEAST_SAVED = 0.2
MOST_DIFFERENT = 0.2

_CUES = re.compile(CUES)
_LONGEST_CUE = re.compile("(?i)all rights reserved")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BARE = re.compile(r"[^\w.]+|\.+$")
_dictionaries = TaskCache()


def blocks(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of the text with up to ``AROUND`` words on either side of license words, within a paragraph; those
    that touch are one. A paragraph ends at an empty line."""
    start = 0
    for paragraph in re.split(r"(\n[\x20\t]*\n)", text):
        if _CUES.search(paragraph):
            places = [m.span() for m in _WORD.finditer(paragraph)]
            hits = [
                k for k, (a, b) in enumerate(places)
                if _CUES.search(paragraph, a, min(b + 10, len(paragraph))) or _LONGEST_CUE.match(paragraph, a)
            ]
            at = 0
            while at < len(hits):
                first = last = hits[at]
                while at < len(hits) and hits[at] <= last + 2 * AROUND:
                    last = hits[at]
                    at += 1
                inside = places[max(first - AROUND, 0) : last + AROUND + 1]
                yield start + inside[0][0], start + inside[-1][1]
        start += len(paragraph)


def bare_words(text: str) -> list[str]:
    """Words in small letters without punctuation."""
    return [w for w in (_BARE.sub("", w.lower()) for w in text.split()) if w]


def _compressed(key: str, data: bytes) -> int:
    """Size of ``data`` after compression with the passage ``key`` as raw dictionary (none for an empty key)."""
    if key not in _dictionaries:
        held = zstandard.ZstdCompressionDict(key.encode("utf-8"), dict_type=zstandard.DICT_TYPE_RAWCONTENT) if key else None
        _dictionaries[key] = zstandard.ZstdCompressor(level=6, dict_data=held, write_content_size=False)
    return len(_dictionaries[key].compress(data))


def savings(block: str, templates: dict[str, tuple[str, ...]]) -> list[tuple[float, str, int]]:
    """What each passage of each template saves as dictionary, best first: as a share of the compressed size of the
    block or of the passage, whichever is smaller, so that neither a long block nor a long passage hides the other."""
    data = block.encode("utf-8")
    alone, out = _compressed("", data), []
    for name, passages in templates.items():
        for k, passage in enumerate(passages):
            most = min(alone, _compressed("", passage.encode("utf-8")))
            out.append(((alone - _compressed(passage, data)) / most, name, k))
    return sorted(out, key=lambda s: (-s[0], s[1], s[2]))


def differences(block: str, passage: str) -> tuple[int, list[str]]:
    """How many words of the passage stand in the block in order, and the exact differences between: ``-word`` is
    missing, ``+word`` comes in between."""
    ours, theirs = bare_words(block), bare_words(passage)
    steps = SequenceMatcher(None, theirs, ours, autojunk=False).get_opcodes()
    same = [k for k, s in enumerate(steps) if s[0] == "equal"]
    if not same:
        return 0, [f"-{w}" for w in theirs]
    out = [f"-{w}" for _, a, b, _, _ in steps[: same[0]] for w in theirs[a:b]]
    for kind, a, b, c, d in steps[same[0] : same[-1] + 1]:
        if kind != "equal":
            out += [f"-{w}" for w in theirs[a:b]] + [f"+{w}" for w in ours[c:d]]
    out += [f"-{w}" for _, a, b, _, _ in steps[same[-1] + 1 :] for w in theirs[a:b]]
    return sum(steps[k][2] - steps[k][1] for k in same), out


def _costs(ours: np.ndarray, theirs: np.ndarray, anywhere: bool) -> np.ndarray:
    """For every end in ``ours``: the fewest words missing and in between when ``theirs`` is aligned with the words up
    to there, from the first one or from ``anywhere``."""
    at = np.arange(len(ours) + 1)
    row = np.zeros_like(at) if anywhere else at
    for word in theirs:
        here = row + 1
        np.minimum(here[1:], np.where(ours == word, row[:-1], len(ours) + len(theirs) + 1), out=here[1:])
        row = np.minimum.accumulate(here - at) + at
    return row


def _places(ours: np.ndarray, theirs: np.ndarray) -> list[tuple[int, int]]:
    """``cost, end`` of every alignment of the passage in which few words differ, but not where a slightly longer one
    costs no more."""
    costs = _costs(ours, theirs, True)
    ends = np.flatnonzero(costs <= MOST_DIFFERENT * len(theirs))
    return [(c, int(end)) for end in ends if end and not ((c := int(costs[end])) and costs[end + 1 : end + 2 * c + 1].min(initial=c + 1) <= c)]


def _start(ours: np.ndarray, theirs: np.ndarray, cost: int, end: int) -> int:
    """Start of the longest stretch, that with most words in common, which ends there and has that cost."""
    first = max(end - len(theirs) - cost, 0)
    back = _costs(ours[first:end][::-1], theirs[::-1], False)
    return end - int(np.flatnonzero(back == cost)[-1])


def scan_block(block: str, templates: dict[str, tuple[str, ...]]) -> list[tuple[str, float, str, bool]]:
    """``license, saved, differences, confirmed``: every license that the block has word for word, then every other one
    whose wording differs little at a place of its own; if none, the best ranked one, not confirmed; nothing if none
    saves enough. Where several passages fit at one place, the one with the smallest share of differing words counts,
    of equal ones the best ranked. Confirmed places are masked and the rest is ranked again, until nothing more is found."""
    exact: dict[str, tuple[str, float, str, bool]] = {}
    near: dict[str, tuple[str, float, str, bool]] = {}
    raw = [w for w in block.split() if _BARE.sub("", w.lower())]
    numbers: dict[str, int] = {}
    ours = np.array([numbers.setdefault(_BARE.sub("", w.lower()), len(numbers)) for w in raw], np.int64)
    passages = {
        (name, k): np.array([numbers.get(w, -2) for w in bare_words(passage)], np.int64)
        for name, several in templates.items()
        for k, passage in enumerate(several)
    }
    first = ranked = [s for s in savings(block, templates) if s[0] >= LEAST_SAVED]
    while ranked:
        found = []
        for rank, (saved, name, k) in enumerate(ranked):
            if n := len(passages[name, k]):
                found += [(cost / n, rank, end, cost, saved, name, k) for cost, end in _places(ours, passages[name, k])]
        masked = np.zeros(len(ours), bool)
        for _, _, end, cost, saved, name, k in sorted(found):
            theirs = passages[name, k]
            if not cost:
                exact.setdefault(name, (name, saved, "", True))
                masked[end - len(theirs) : end] = True
            elif not masked[end - 1]:
                start = _start(ours, theirs, cost, end)
                if not masked[start:end].any():
                    changes = differences(" ".join(raw[start:end]), templates[name][k])[1]
                    near.setdefault(name, (name, saved, " ".join(changes), True))
                    masked[start:end] = True
        if not masked.any():
            break
        ours[masked] = -1
        rest = " ".join(w for w, of in zip(raw, ours) if of >= 0)
        ranked = [s for s in savings(rest, templates) if s[0] >= LEAST_SAVED] if rest else []
    if exact or near:
        return [*exact.values(), *(found for name, found in near.items() if name not in exact)]
    if not first:
        return []
    saved, name, k = first[0]
    return [(name, saved, " ".join(differences(block, templates[name][k])[1]), False)]


def scan(
    docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per license found in a block: ``doc_id, block_start, block_end, license, saved, differences, confirmed``."""
    templates = templates or TEMPLATES
    rows = texts(docs, id_column, text_column).filter(F.col("text").rlike(CUES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(batch, 1):
                out: list[tuple] = []
                picked = []
                for k, text in enumerate(part.column(1).to_pylist()):
                    for a, b in blocks(text):
                        for found in scan_block(text[a:b], templates):
                            picked.append(k)
                            out.append((a, b, *found))
                columns = list(zip(*out)) if out else [[]] * 6
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string(), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(picked, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                    names=["doc_id", "block_start", "block_end", "license", "saved", "differences", "confirmed"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, block_start long, block_end long, license string, saved double, differences string, confirmed boolean"
    )
