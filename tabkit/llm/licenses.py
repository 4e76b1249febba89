"""Licence scan: word windows of a text against licence templates by Dice over word bigrams.

The whole text is normalised to lower-case words, and every window of it is compared with
the templates: twice the shared bigrams over the bigrams of both.  A bigram that a template
holds k times is shared k times at most.  Line ends do not matter: a notice may stand inside
a line or be wrapped over several.

Only windows that start and end with a shared bigram are looked at, as trimming others off
raises the coefficient, and only where so many of a template's bigrams stand within the
greatest admitted size that the threshold can be reached.  Of overlapping windows the best
is kept: by coefficient, then the longer one, then by name.  All windows that reach the
threshold take part, not only the best of a start: where that one runs into a better notice,
a shorter one stands.  (One that holds a better window overlaps whatever that one overlaps,
and is left out.)  It all happens within a row, by DataFrame functions: nothing is shuffled.

Null and empty texts, and texts without words, have no match.  Of equally good notices
the first by name gives the text its licence.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.llm.common import query, table

THRESHOLD = 0.8

# Licence notices to match (fixed values): name and text.
TEMPLATES = {
    "AGPL-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "EPL-2.0": "Made available under the terms of the Eclipse Public License 2.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Released under the ISC License.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This file is subject to the terms of the Mozilla Public License, version 2.0.",
    "Proprietary": "All rights reserved. No part may be reproduced without written permission.",
    "Rights-Reserved": "All rights reserved.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
# Licence texts and headers of many sentences (fixed values), in their public wording.
FULL_TEXTS = [
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is
        distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
        See the License for the specific language governing permissions and limitations under the License.""",
    ),
    (
        "GPL-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version.
        This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License
        for more details.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
        INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
        ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE,
        DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
        CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial
        portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
        EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN
        AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE
        OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
]
# What stands between words, and what ends a line.
BETWEEN = r"[^\p{L}\p{N}]+"
LINE_END = "\n"


def bigrams_of(text: str) -> list[str]:
    """The bigrams of a template in their order, repeated ones as often as they stand there."""
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    if not pairs:
        raise ValueError(f"a template needs two words: {text!r}")
    return pairs


def bounds(n: int, threshold: float) -> tuple[int, int]:
    """Least and most bigrams of a line whose coefficient with n bigrams may reach the threshold."""
    low = next(m for m in range(1, n + 1) if 2 * m >= threshold * (n + m) - 1e-9)
    high = n
    while 2 * n >= threshold * (n + high + 1) - 1e-9:
        high += 1
    return low, high


def words_of(line: Column) -> Column:
    """Lower-case words of a line."""
    return F.filter(F.split(F.regexp_replace(F.lower(line), BETWEEN, " "), " "), lambda w: w != "")


def bigrams(words: Column) -> Column:
    """Pairs of neighbouring words, of two words at least."""
    return F.transform(
        F.sequence(F.lit(1), F.size(words) - 1),
        lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1)),
    )


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where a lambda reads it often."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def prepared(templates: list[tuple[str, str]], threshold: float) -> tuple[Column, list[str]]:
    """The templates with their size bounds as one literal, and all their bigrams."""
    rows, known = [], set()
    for name, body in templates:
        counts = Counter(bigrams_of(body))
        low, high = bounds(counts.total(), threshold)
        known.update(counts)
        rows.append(
            F.struct(
                F.lit(name).alias("license"), F.lit(counts.total()).alias("n"),
                F.lit(low).alias("low"), F.lit(high).alias("high"),
                F.array(*map(F.lit, counts)).alias("pairs"), F.array(*map(F.lit, counts.values())).alias("counts"),
            )
        )
    return F.array(*rows), sorted(known)


def known_places(words: Column, known: list[str]) -> Column:
    """Where in the words a bigram of any template starts, with the bigram."""
    firsts = sorted({pair.split(" ")[0] for pair in known})

    def pair(i):
        return F.concat_ws(" ", F.get(words, i), F.get(words, i + 1))

    places = F.filter(
        F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.get(words, i).isin(firsts) & pair(i).isin(known)
    )
    none = F.array().cast("array<struct<pair:string,at:int>>")
    return F.when(
        F.size(words) >= 2, F.transform(places, lambda i: F.struct(pair(i).alias("pair"), i.alias("at")))
    ).otherwise(none)


HIT = "array<struct<less:double,fewer:int,license:string,first:int,last:int>>"


def windows(places: Column, t: Column, threshold: float) -> Column:
    """The windows from every start that reach the threshold for one template."""
    mine = F.filter(
        F.transform(
            places,
            lambda p: F.struct(
                p["pair"].alias("pair"), p["at"].alias("at"), F.array_position(t["pairs"], p["pair"]).cast("int").alias("k")
            ),
        ),
        lambda p: p["k"] > 0,
    )

    def linked(found: Column) -> Column:
        """Places with that of the same bigram as many occurrences before as the template has of it."""

        def before(i: Column) -> Column:
            return let(
                F.struct(F.get(found, i).alias("here"), F.get(found, i - F.get(t["counts"], F.get(found, i)["k"] - 1)).alias("then")),
                lambda x: F.struct(
                    x["here"]["at"].alias("at"),
                    F.when(x["then"]["pair"] == x["here"]["pair"], x["then"]["at"]).otherwise(-1).alias("before"),
                ),
            )

        return F.sort_array(F.transform(F.sequence(F.lit(0), F.size(found) - 1), before))

    def reaching(row: Column, a: Column) -> Column:
        """The windows from one start that reach the threshold; a longer one only if no shorter one is better."""
        start = F.get(row, a)["at"]
        zero = F.struct(F.lit(0).alias("shared"), F.lit(0.0).alias("dice"), F.array().cast(HIT).alias("found"))

        def step(told: Column, x: Column) -> Column:
            shared = told["shared"] + F.when(x["before"] < start, 1).otherwise(0)
            size = x["at"] - start + 1
            dice = 2.0 * shared / (size + t["n"])
            good = (size <= t["high"]) & (dice >= told["dice"])
            hit = F.struct(
                (-dice).alias("less"), (start - x["at"]).alias("fewer"), t["license"].alias("license"),
                start.alias("first"), x["at"].alias("last"),
            )
            return F.struct(
                shared.alias("shared"),
                F.when(good, dice).otherwise(told["dice"]).alias("dice"),
                F.when(good & (dice >= threshold - 1e-9), F.concat(told["found"], F.array(hit))).otherwise(told["found"]).alias("found"),
            )

        return F.aggregate(F.slice(row, a + 1, t["high"]), zero, step)["found"]

    def starts(row: Column) -> Column:
        # a window needs as many places of the template as its least size has
        dense = F.filter(
            F.sequence(F.lit(0), F.size(row) - t["low"]),
            lambda a: F.get(row, a + t["low"] - 1)["at"] - F.get(row, a)["at"] < t["high"],
        )
        return F.flatten(F.transform(dense, lambda a: reaching(row, a)))

    none = F.array().cast(HIT)
    return let(
        F.when(F.size(places) >= t["low"], F.sort_array(mine)),
        lambda found: F.when(F.size(found) >= t["low"], let(linked(found), starts)).otherwise(none),
    )


def notices(hits: Column) -> Column:
    """Of windows that share a word the best; the others stay."""

    def add(kept: Column, h: Column) -> Column:
        taken = F.exists(kept, lambda k: (h["first"] <= k["last"] + 1) & (k["first"] <= h["last"] + 1))
        return F.when(taken, kept).otherwise(F.concat(kept, F.array(h)))

    return F.aggregate(F.array_sort(hits), F.array().cast(HIT), add)


def scan(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    templates: dict[str, str] | list[tuple[str, str]] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id``, ``n_lines`` notices found, and the best ``license`` with its ``dice``.

    Templates may be of any length, and several may have one name.  A notice counts once,
    on a line of its own, among other words or over several lines, in texts of any length.
    """
    if templates is None:
        templates = [*sorted(TEMPLATES.items()), *FULL_TEXTS]
    elif isinstance(templates, dict):
        templates = sorted(templates.items())
    compared, known = prepared(templates, threshold)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    found = let(
        let(words_of(body), lambda words: known_places(words, known)),
        lambda places: notices(F.flatten(F.transform(compared, lambda t: windows(places, t, threshold)))),
    )
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), found.alias("found"))
    top = F.array_min(F.transform("found", lambda h: F.struct(h["less"].alias("less"), h["license"].alias("license"))))
    return rows.select(
        "doc_id",
        F.size("found").cast("long").alias("n_lines"),
        top["license"].alias("license"),
        F.round(-top["less"], 6).alias("dice"),
    )


def _sql(templates: list[tuple[str, str]] | None = None) -> str:
    """The same scan in SQL: every window of every whole text against every template."""
    values, pairs_of = [], []
    for t, (name, body) in enumerate(templates or [*sorted(TEMPLATES.items()), *FULL_TEXTS]):
        counts = Counter(bigrams_of(body))
        low, high = bounds(counts.total(), THRESHOLD)
        values.append(f"({t}, '{name}', {counts.total()}, {low}, {high})")
        pairs_of += [f"({t}, '{pair}', {many})" for pair, many in counts.items()]
    return rf"""
    WITH templates(t, license, n, low, high) AS (VALUES {", ".join(values)}),
    known(t, pair, many) AS (VALUES {", ".join(pairs_of)}),
    texts AS (
      SELECT row_number() OVER () AS r, doc_id,
             list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '') AS w
      FROM documents
    ),
    grams AS (
      SELECT r, pos, w[pos + 1] || ' ' || w[pos + 2] AS pair
      FROM (SELECT r, w, unnest(range(0, len(w) - 1)) AS pos FROM texts WHERE len(w) >= 2)
    ),
    -- "since": where the same bigram stands as many occurrences before as the template has of it
    places AS (
      SELECT g.r, k.t, g.pos, coalesce(lag(g.pos, k.many) OVER (PARTITION BY g.r, k.t, g.pair ORDER BY g.pos), -1) AS since
      FROM grams g JOIN known k ON g.pair = k.pair
    ),
    starts AS (
      SELECT p.*, s.license, s.n, s.high FROM places p JOIN templates s ON p.t = s.t
      QUALIFY lead(p.pos, s.low - 1) OVER (PARTITION BY p.r, p.t ORDER BY p.pos) - p.pos < s.high
    ),
    windows AS (
      SELECT a.r, a.t, a.license, a.pos AS first, b.pos AS last,
             2.0 * sum(CASE WHEN b.since < a.pos THEN 1 ELSE 0 END) OVER (PARTITION BY a.r, a.t, a.pos ORDER BY b.pos) / (b.pos - a.pos + 1 + a.n) AS dice
      FROM starts a JOIN places b ON a.r = b.r AND a.t = b.t AND b.pos BETWEEN a.pos AND a.pos + a.high - 1
    ),
    hits AS (
      SELECT r, struct_pack(less := -dice, fewer := first - last, license := license, first := first, last := last) AS h
      FROM windows WHERE dice >= {THRESHOLD} - 1e-9
    ),
    -- of windows that share a word the best
    kept AS (
      SELECT r, list_reduce(list([h] ORDER BY h), lambda found, x: CASE
        WHEN len(list_filter(found, lambda k: x[1].first <= k.last + 1 AND k.first <= x[1].last + 1)) > 0 THEN found
        ELSE list_concat(found, x) END) AS found
      FROM hits GROUP BY r
    ),
    told AS (
      SELECT r, len(found) AS n_lines, list_min(list_transform(found, lambda h: struct_pack(less := h.less, license := h.license))) AS best
      FROM kept
    )
    SELECT d.doc_id, CAST(coalesce(t.n_lines, 0) AS BIGINT) AS n_lines, t.best.license AS license, CAST(round(-t.best.less, 6) AS DOUBLE) AS dice
    FROM texts d LEFT JOIN told t ON d.r = t.r
    """


@query("op3_license_scan", _sql())
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan(table(spark, folder, "documents"))
