import random
import re

import numpy as np

from corpuslens.llm import licenses

SCHEMA = "doc_id LONG, text STRING, license STRING"


def words(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(text):
    """Licenses of which some window of the template's class holds enough shingles."""
    own, out = words(text), set()
    for name, template in licenses.TEMPLATES:
        t = words(template)
        wanted = {tuple(t[i : i + 5]) for i in range(len(t) - 4)}
        size = 1 << (len(t) - 1).bit_length()
        for lo in range(0, max(1, len(own)), size):
            part = own[lo : lo + 2 * size]
            held = {tuple(part[i : i + 5]) for i in range(len(part) - 4)}
            if len(wanted & held) >= 0.75 * len(wanted):
                out.add(name)
    return out


def texts():
    rng = random.Random(2)
    filler = [f"w{i}" for i in range(50)] + ["the", "license", "under", "Licensed", "é"]
    made = [None, "", "License", "Licensed under the Apache", "x " * 300_000 + "Released under the MIT license"]
    for _, template in licenses.TEMPLATES * 3:
        t = template.split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            t[rng.randrange(len(t))] = rng.choice(filler)
        pad = lambda: " ".join(rng.choices(filler, k=rng.randrange(0, 90)))
        made.append(f"{pad()}\n{' '.join(t)} {pad()}")
    return made


def test_same_licenses_as_all_windows(spark):
    made = texts()
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(made)], SCHEMA)
    found = {}
    for r in licenses.scan(df).collect():
        found.setdefault(r.doc_id, set()).add(r.license)
        assert 0 <= r.start < r.end <= len(made[r.doc_id]) and r.containment >= 0.75
    assert found == {i: b for i, t in enumerate(made) if (b := brute(t))}


def test_places(spark):
    line = "Licensed under CC BY-NC 4.0."
    text = f"é😀 first\n{line}\n" + "mid " * 40 + f"\n{line}"
    out = licenses.scan(spark.createDataFrame([(1, text, None), (1, text, None)], SCHEMA)).collect()
    assert len(out) == 4
    assert {text[r.start : r.end] for r in out} == {"Licensed under CC BY-NC 4.0"}


def test_bands_reach_the_wanted_certainty():
    rng = np.random.default_rng(0)
    for group in licenses.prepare(licenses.TEMPLATES):
        for template in group.templates:
            held = int(np.ceil(0.75 * len(template.shingles)))
            misses = 0
            for _ in range(40):
                own = rng.choice(template.shingles, held, replace=False)
                other = rng.integers(0, 1 << 63, 2 * group.words - 4 - held).astype(np.uint64)
                sign = licenses.signature(np.concatenate([own, other]), group.bands)
                misses += not (sign == template.signature).any()
            assert misses <= 1


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).collect() == []


BSD = """Copyright (c) 2020, Somebody. All rights reserved.
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{third}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
THIRD = "3. Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."


def test_whole_texts(spark):
    whole = {n: t for n, t in licenses.TEMPLATES if len(t.split()) > 100}
    assert whole.keys() >= {"Apache-2.0", "BSD-2-Clause", "BSL-1.0", "CC-BY-SA-4.0", "EPL-1.0", "GPL-3.0", "ISC", "MIT", "Zlib"}
    by_sa = whole["CC-BY-SA-4.0"]
    made = dict(whole)
    made["BSD-2-Clause"], made["BSD-3-Clause"] = BSD.format(third=""), BSD.format(third=THIRD)
    made["CC-BY-4.0"] = by_sa.replace("Attribution-ShareAlike", "Attribution")
    made["both"] = BSD.format(third="") + "\n" + BSD.format(third=THIRD)
    names = sorted(made)
    df = spark.createDataFrame([(i, f"first\n{made[n]}\nlast", None) for i, n in enumerate(names)], SCHEMA)
    found = {n: set() for n in names}
    for r in licenses.scan(df).collect():
        if r.end - r.start > len(made[names[r.doc_id]]) * 0.6:
            found[names[r.doc_id]].add(r.license)
    assert found.pop("both") == {"BSD-2-Clause"}
    assert found == {n: {n} for n in found}
    rows = licenses.scan(df.filter(df.doc_id == names.index("both"))).collect()
    assert {r.license for r in rows} == {"BSD", "BSD-2-Clause", "BSD-3-Clause"}
