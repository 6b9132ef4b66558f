"""License scans with DataFrame expressions only.

A text is cut into words (letters and digits, lower case) and 3-word shingles.  Overlapping
windows of ``WINDOW`` shingles, one every ``STEP``, are keyed by ``BANDS`` MinHash bands of
one row; a window that agrees with a template's window in any band retrieves the template, and
nothing else does.  Each band orders the shingles by a hash of its own, so bands are
independent: a passage of five words (three shingles) lies whole in some window, at Jaccard 1/2
or more, which one of ten bands hits with probability 0.999, and longer passages are met by
several windows.  A retrieved template is confirmed where a part of the text of about its
length holds at least ``CONTAINED`` of its shingles, exactly.

All of it is one projection over the documents: nothing is shuffled, and the templates, a
fixed list, are literals of the plan.  The work follows the length of a text, also of one full
of notices: retrieved (window, template) pairs are integers, which Spark makes distinct by
hashing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 3
WINDOW = 6
STEP = 3
BANDS = 10
CONTAINED = 0.8

# Notices of widely used licenses, as they are commonly written.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License "
                   "is distributed on an \"AS IS\" basis, without warranties or conditions of any kind."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met."),
    ("BSD", "Released under the BSD License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    # whole texts
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.
If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.

3. This notice may not be removed or altered from any source distribution."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""),
    ("BSL-1.0", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the
software and accompanying documentation covered by this license (the "Software") to use, reproduce, display,
distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit
third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction
and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all
derivative works of the Software, unless such copies or derivative works are solely in the form of
machine-executable object code generated by a source language processor."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form
or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to
the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in
perpetuity of all present and future rights to this software under copyright law."""),
)

_HASHES = f"""
transform(array(filter(split(lower({{text}}), '[^\\\\p{{{{L}}}}\\\\p{{{{N}}}}]+'), w -> w <> '')), ws ->
  if(size(ws) >= {SHINGLE},
     transform(sequence(0, size(ws) - {SHINGLE}), i -> xxhash64(ws[i], ws[i + 1], ws[i + 2])),
     cast(array() as array<bigint>)))[0]
"""


def shingles(text: str) -> Column:
    """Hashes of the 3-word shingles of a text column, in order; null for a null text."""
    return F.expr(_HASHES.format(text=text))


def _ranked(band: int, use: str) -> str:
    """SQL of ``use`` over ``ranks``, the shingles' order in a band."""
    return (f"transform(array(transform(hs, h -> xxhash64(h, {band}))), ranks -> "
            f"if(size(ranks) > 0, {use}, cast(array() as array<bigint>)))[0]")


def _least(k: str, step: int) -> str:
    """SQL of the minimum of the window that starts at shingle ``k * step``."""
    return f"array_min(slice(ranks, {k} * {step} + 1, {WINDOW}))"


def _long(x: int) -> str:
    # The least long has no literal of its own.
    return f"{x}L" if x != -(1 << 63) else "(-9223372036854775807L - 1L)"


def _longs(values) -> str:
    return f"cast(array({', '.join(_long(x) for x in values)}) as array<bigint>)"


def template_index(spark: SparkSession, templates) -> tuple[list[list[int]], list[dict[int, list[int]]]]:
    """The templates' shingle hashes, and per band which templates have a window of a minimum.

    A template's windows start at every shingle, so some agree with the text's phase.
    """
    rows = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(templates)], "i int, text string") \
        .select("i", shingles("text").alias("hs"))
    bands = [F.expr(_ranked(band, f"transform(sequence(0, size(ranks) - 1), k -> {_least('k', 1)})")).alias(f"b{band}")
             for band in range(BANDS)]
    hashes: list[list[int]] = [[] for _ in templates]
    tables: list[dict[int, set[int]]] = [{} for _ in range(BANDS)]
    for r in rows.select("i", "hs", *bands).collect():      # the fixed list's rows
        hashes[r["i"]] = r["hs"]
        full = max(1, len(r["hs"]) - WINDOW + 1)
        for band, table in enumerate(tables):
            for m in r[f"b{band}"][:full]:
                table.setdefault(m, set()).add(r["i"])
    return hashes, [{m: sorted(found) for m, found in table.items()} for table in tables]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
         templates=TEMPLATES, contained: float = CONTAINED) -> DataFrame:
    """``(id, matches, *carry)`` per row; ``matches`` lists (license, containment, start word).

    A license is listed once, with its best containment and, among equals, its first place.
    A null, empty or very short text has no match.  Null ids, repeated rows, an empty table
    and further columns are fine; templates of fewer than three words match nothing.  A very
    long text is scanned whole, in work and memory that follow its words.
    """
    hashes, tables = template_index(docs.sparkSession, templates)
    n = len(templates)
    none = "cast(array() as array<bigint>)"

    def retrieved(band: int, table: dict[int, list[int]]) -> str:
        """Windows of ``hs`` that agree with a template in the band, as ``window * n + template``."""
        if not table:
            return none
        known = ", ".join(_long(m) for m in table)
        index = f"map_from_arrays({_longs(table)}, array({', '.join(_longs(found) for found in table.values())}))"
        # Only windows of a known minimum go beyond one comparison.
        return _ranked(band, (
            f"flatten(transform(filter(sequence(0, cast((size(ranks) - 1) div {STEP} as int)), k -> {_least('k', STEP)} in ({known})), "
            f"k -> transform(element_at({index}, {_least('k', STEP)}), t -> cast(k as bigint) * {n}L + t)))"))

    bodies = "array(" + ", ".join(
        f"named_struct('name', '{name}', 'own', {_longs(dict.fromkeys(own))})"
        for (name, _), own in zip(templates, hashes, strict=True)) + ")"
    found = "array_distinct(concat(" + ", ".join(retrieved(b, table) for b, table in enumerate(tables)) + "))"
    start = f"cast(c div {n}L as int) * {STEP}"
    checked = (f"transform({found}, c -> transform(array(element_at({bodies}, cast(c % {n}L as int) + 1)), body -> "
               "named_struct('license', body.name, 'containment', "
               f"size(array_intersect(body.own, slice(hs, greatest({start} - size(body.own), 0) + 1, "
               f"2 * size(body.own) + {WINDOW}))) / cast(size(body.own) as double), 'start', {start}))[0])")
    good = f"filter({checked}, m -> m.containment >= {contained}D)"
    best = ("transform(array_sort(array_distinct(transform(ms, m -> m.license))), name -> "
            "array_max(transform(filter(ms, m -> m.license = name), m -> "
            "named_struct('containment', m.containment, 'early', -m.start, 'license', m.license))))")
    matches = (f"transform(array(coalesce(hs, {none})), hs -> transform(array({good}), ms -> "
               f"transform({best}, m -> named_struct('license', m.license, 'containment', m.containment, "
               "'start', -m.early)))[0])[0]")
    base = docs.select(F.col(id_col).cast("long").alias("id"), shingles(f"cast(`{text_col}` as string)").alias("hs"),
                       *(F.col(c) for c in carry))
    return base.select("id", F.expr(matches).alias("matches"), *carry)
