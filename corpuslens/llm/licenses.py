"""License texts inside documents: MinHash bands over overlapping word windows, then exact containment.

Words are lower-case runs of letters and digits, shingles five words. Templates fall into
classes by the power of two ``c`` that bounds their words. For each class a text is cut
into windows of ``2 c`` words, ``c`` apart, so that every place of a template lies within
one window as a whole. The smallest similarity that such a window can have with a template
contained to ``CONTAINED`` fixes the number of bands: with it, a collision is as likely as
``CERTAIN`` says. Colliding pairs are verified by the exact share of the template's
shingles that the window holds.

A band's value is the hash of one shingle of the window, so a window without any shingle
of a template cannot collide; it gets no signature.

The templates are notices, whole license texts (``license_texts``), and clauses by which
texts that are almost the same are told apart: a place of the text takes the name of the
clause that stands in it, unless it is so long that it may hold both texts.

Defined cases: null or empty texts hold no license; a text that holds a template twice has
a row for each place, places that meet are one; templates of fewer words than a shingle
are refused; repeated documents have rows each; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.words import SPACE, mix, placed_words, slices, utf8, windows

SHINGLE = 5
CONTAINED = 0.75
CERTAIN = 0.9999

FOUND = "doc_id long, license string, containment double, start long, end long"

# Bytes that end a word: all of ASCII but letters and digits.
BREAKS = SPACE.copy()
BREAKS[:128] = True
for _low, _high in ((48, 58), (65, 91), (97, 123)):
    BREAKS[_low:_high] = False

# Notices by which the common licenses are applied (fixed values).
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

# Clauses that only one of several similar texts has; their names replace the text's.
CLAUSES = [
    ("BSD-3-Clause", "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("AGPL-3.0", "if you modify the Program, your modified version must prominently offer all users interacting with it remotely through a computer network (if your version supports such interaction) an opportunity to receive the Corresponding Source of your version by providing access to the Corresponding Source from a network server at no charge"),
    *(
        (f"CC-BY{short}-4.0", f"terms and conditions of this Creative Commons Attribution{long} 4.0 International Public License")
        for short, long in (
            ("", ""), ("-SA", "-ShareAlike"), ("-NC", "-NonCommercial"), ("-ND", "-NoDerivatives"),
            ("-NC-SA", "-NonCommercial-ShareAlike"), ("-NC-ND", "-NonCommercial-NoDerivatives"),
        )
    ),
]
TOLD_BY = {
    "BSD-2-Clause": {"BSD-3-Clause"},
    "GPL-3.0": {"AGPL-3.0"},
    "CC-BY-SA-4.0": {name for name, _ in CLAUSES if name.startswith("CC-")},
}
LONGEST = 1.5  # times a text's words: a longer place may hold two of the similar texts

TEMPLATES += CLAUSES
TEMPLATES += sorted(
    (f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in resources.files(__package__).joinpath("license_texts").iterdir()
)


def bands(words: int, template_shingles: int) -> int:
    """Bands of one hash each that make a collision certain to ``CERTAIN``."""
    window = 2 * words - SHINGLE + 1
    held = math.ceil(CONTAINED * template_shingles)
    least = held / (window + template_shingles - held)
    return 1 if least >= 1 else math.ceil(math.log(1 - CERTAIN) / math.log(1 - least))


def signature(shingles: np.ndarray, count: int) -> np.ndarray:
    """Least value of the shingles under each of ``count`` hash functions."""
    seeds = mix(np.arange(count), 21)
    return mix(shingles[:, None] ^ seeds[None, :], 22).min(axis=0)


@dataclass
class Template:
    license: str
    shingles: np.ndarray
    signature: np.ndarray


@dataclass
class SizeClass:
    words: int
    bands: int
    templates: list[Template]
    all_shingles: np.ndarray


def prepare(templates: Sequence[tuple[str, str]]) -> list[SizeClass]:
    """Templates by size class with the signatures that their class needs."""
    by_size: dict[int, list[tuple[str, np.ndarray]]] = {}
    for name, text in templates:
        hashes, _, _, _ = placed_words(*utf8(pa.array([text])), lower=True, separators=BREAKS)
        if len(hashes) < SHINGLE:
            raise ValueError(f"a template of {name} has fewer than {SHINGLE} words")
        size = 1 << (len(hashes) - 1).bit_length()
        by_size.setdefault(size, []).append((name, np.unique(windows(hashes, SHINGLE))))
    out = []
    for size, own in sorted(by_size.items()):
        count = max(bands(size, len(s)) for _, s in own)
        made = [Template(name, s, signature(s, count)) for name, s in own]
        out.append(SizeClass(size, count, made, np.unique(np.concatenate([s for _, s in own]))))
    return out


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def places(classes: list[SizeClass], runs: np.ndarray) -> Iterator[tuple[str, float, int, int]]:
    """``(license, containment, first word, end word)`` of the licenses in one text's shingles."""
    found = list(template_places(classes, runs))
    for name, share, a, b, size in found:
        told = [other for other, _, c, d, _ in found if other in TOLD_BY.get(name, ()) and c < b and a < d]
        yield told[0] if told and b - a <= LONGEST * size else name, share, a, b


def template_places(classes: list[SizeClass], runs: np.ndarray) -> Iterator[tuple[str, float, int, int, int]]:
    """``(license, containment, first word, end word, words of the template)`` of the templates, in order of words."""
    for group in classes:
        hits = np.flatnonzero(_among(runs, group.all_shingles))
        if not len(hits):
            continue
        cells = np.unique(np.concatenate([hits // group.words, np.maximum(hits // group.words - 1, 0)]))
        found: dict[tuple[str, int], list[list]] = {}
        for cell in cells:
            lo = int(cell) * group.words
            own = runs[lo : lo + 2 * group.words - SHINGLE + 1]
            if not len(own):
                continue
            sign = signature(np.unique(own), group.bands)
            for number, template in enumerate(group.templates):
                if not (sign == template.signature).any():
                    continue
                inside = _among(own, template.shingles)
                share = len(np.unique(own[inside])) / len(template.shingles)
                if share >= CONTAINED:
                    at = np.flatnonzero(inside)
                    found.setdefault((template.license, number), []).append(
                        [lo + int(at[0]), lo + int(at[-1]) + SHINGLE, share]
                    )
        for (name, number), spans in found.items():
            joined: list[list] = []
            for a, b, share in sorted(spans):
                if joined and a < joined[-1][1]:
                    joined[-1][1], joined[-1][2] = max(b, joined[-1][1]), max(share, joined[-1][2])
                else:
                    joined.append([a, b, share])
            for a, b, share in joined:
                yield name, share, a, b, len(group.templates[number].shingles) + SHINGLE - 1


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """A row for each place of a license text, with the code points it spans."""
    classes = prepare(templates)
    names = [x.split()[0] for x in FOUND.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                data, starts = utf8(batch.column("text"))
                hashes, offsets, first, size = placed_words(data, starts, lower=True, separators=BREAKS)
                runs = windows(hashes, SHINGLE)
                ids = batch.column("doc_id").to_pylist()
                rows = []
                for i in range(batch.num_rows):
                    lo, hi = offsets[i], offsets[i + 1]
                    if hi - lo < SHINGLE:
                        continue
                    for name, share, a, b in places(classes, runs[lo : hi - SHINGLE + 1]):
                        begin, end = first[lo + a], first[lo + b - 1] + size[lo + b - 1]
                        before = len(data[starts[i] : begin].tobytes().decode())
                        rows.append((ids[i], name, share, before, before + len(data[begin:end].tobytes().decode())))
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, FOUND)
