"""Licence texts and notices in documents, by Dice coefficient over word bigrams.

A text is folded to lower-case letters a-z and digits.  Texts without any of the words
that every match must share with its template are done with; others are cut into units: its lines,
its paragraphs (between blank lines) and itself as a whole.  A unit is compared with
a template only if its number of distinct word bigrams lets the coefficient reach
the threshold; a unit with too many distinct words is dropped before its bigrams are
made, as w distinct words have w - 1 distinct bigrams at least.

Built-in expressions only; templates are literals, so units never move.  Only the
matches are grouped.  Null and empty texts match nothing, like texts of one word.
Rows that repeat give the same matches once.  Columns not named are dropped.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held

THRESHOLD = 0.8

# Wording of public licences and of the notices that stand for them.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header":
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    "MIT notice": "Released under the MIT License.",
    "MIT":
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR "
        "A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC":
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header":
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "BSD-3-Clause notice": "Released under the BSD 3-Clause License.",
    "All rights reserved": "All rights reserved.",
}


def bigrams(text: str) -> list[str]:
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def bounds(size: int, threshold: float) -> tuple[int, int]:
    """Sizes of sets whose Dice coefficient with one of ``size`` can reach the threshold."""
    share = threshold / (2 - threshold)
    return math.ceil(share * size - 1e-9), math.floor(size / share + 1e-9)


def marks(sets: dict[str, list[str]], threshold: float) -> list[str]:
    """Words of which every matching text has one at least.

    A match has ``share`` of a template's bigrams, so it lacks fewer than the rest plus
    one; words are taken until they touch that many, those that touch most first,
    short ones last.
    """
    found = []
    for bigrams_of in sets.values():
        needed = len(bigrams_of) - bounds(len(bigrams_of), threshold)[0] + 1
        left = list(bigrams_of)
        while len(bigrams_of) - len(left) < needed:
            touched = Counter(w for b in left for w in set(b.split()))
            word = max(sorted(touched), key=lambda w: (w in found, len(w) > 4, touched[w]))
            found.append(word)
            left = [b for b in left if word not in b.split()]
    return sorted(set(found))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD,
         id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, license, score): the best coefficient of any unit, from ``threshold`` up."""
    sets = {name: bigrams(text) for name, text in templates.items()}
    table = F.array(*(
        F.struct(F.lit(name).alias("license"), F.array(*map(F.lit, found)).alias("bigrams"),
                 F.lit(len(found)).alias("n"), *(F.lit(b).alias(c) for b, c in
                                                 zip(bounds(len(found), threshold), ("low", "high"), strict=True)))
        for name, found in sets.items()))
    low = min(bounds(len(s), threshold)[0] for s in sets.values())
    high = max(bounds(len(s), threshold)[1] for s in sets.values())
    folded = (
        held(docs.where(F.col(text_column).isNotNull()).select(
            F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")),
            "folded", F.regexp_replace(F.lower("text"), "[^a-z0-9\n]+", " "))
        .where(reduce(or_, [F.col("folded").contains(word) for word in marks(sets, threshold)]))
        .select("doc_id", F.explode(F.expr(
            "array_distinct(transform(concat(split(folded, '\n'), split(folded, '\n *\n'), array(folded)), "
            "u -> trim(translate(u, '\n', ' '))))")).alias("unit")))
    words = (held(folded, "words", F.split("unit", " +")).where(F.size("words") > low)
             .where(F.size(F.array_distinct("words")) <= high + 1))
    return (
        held(words.select("doc_id", "words"), "bigrams", F.expr(
            "array_distinct(transform(sequence(0, size(words) - 2), i -> concat(words[i], ' ', words[i + 1])))"))
        .withColumn("template", F.explode(F.filter(
            table, lambda t: F.size("bigrams").between(t["low"], t["high"]))))
        .withColumn("score", F.expr(
            "2.0D * size(array_intersect(bigrams, template.bigrams)) / (size(bigrams) + template.n)"))
        .where(F.col("score") >= threshold)
        .groupBy("doc_id", F.col("template.license").alias("license")).agg(F.max("score").alias("score")))


def _sql() -> str:
    rows = ",\n  ".join(f"('{name}', [{', '.join(repr(b) for b in bigrams(text))}])" for name, text in TEMPLATES.items())
    return f"""
with t(license, bigrams) as (values {rows}),
f as (select doc_id, regexp_replace(lower(text), '[^a-z0-9\\n]+', ' ', 'g') folded from documents),
u as (select distinct doc_id, trim(replace(unit, chr(10), ' ')) unit from (
  select doc_id, unnest(list_concat(list_concat(string_split(folded, chr(10)),
    string_split_regex(folded, '\\n *\\n')), [folded])) unit from f)),
w as (select doc_id, string_split_regex(unit, ' +') words from u),
b as (select doc_id, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) bigrams
      from w),
s as (select doc_id, license, 2.0::double * len(list_intersect(b.bigrams, t.bigrams))
        / (len(b.bigrams) + len(t.bigrams)) score
      from b join t on len(b.bigrams) between 0.6 * len(t.bigrams) and 1.7 * len(t.bigrams))
select doc_id, license, max(score) as score from s where score >= {THRESHOLD} group by doc_id, license
"""


SQL = _sql()
