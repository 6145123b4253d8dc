"""Licence scan: known licence sentences, and ordered rules over their identifiers.

A text is cut into paragraphs (blank lines) and sentences (after `.`, `!`, `?`, `;` or `:` and white space). A sentence is normalised: A-Z
lower-cased, each run of other bytes than letters and digits one space. A normalised sentence that is known has an identifier; one that is not known is
tried by its parts between lines without letters and digits (as in comments), and each of these line by line. The identifiers in the order of the text are matched against rules, each a sequence of identifiers:
from left to right, the longest rule that begins at a place takes its identifiers. Identifiers that no rule takes stay
unexplained, which is how a text with only a part of a licence shows.

All of it is a projection of DataFrame functions, without a shuffle; the known sentences and rules are a fixed list in the plan.

Null and empty texts have no licence. Repeated rows are scanned alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence sentences as their texts word them, normalised when the plan is made.
SENTENCES = {
    "apache2-line": "Licensed under the Apache License, Version 2.0.",
    "apache2-grant": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache2-comply": "you may not use this file except in compliance with the License.",
    "apache2-copy": "You may obtain a copy of the License at",
    "apache2-url": "http://www.apache.org/licenses/LICENSE-2.0",
    "apache2-copy-url": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache2-asis": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "apache2-see": "See the License for the specific language governing permissions and limitations under the License.",
    "mit-line": "Released under the MIT License.",
    "mit-line2": "Licensed under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "mit-notice": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software."
    ),
    "mit-asis": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "mit-liable": (
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "gpl3-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software:",
    "gpl3-later": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl-implied": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-see": "See the GNU General Public License for more details.",
    "ccbync4-line": "Licensed under CC BY-NC 4.0.",
    "ccby4-line": "Licensed under CC BY 4.0.",
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer."
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "bsd-name": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."
    ),
}

# Rules, each a licence and the sentences that state it, in order.
RULES = [
    ("Apache-2.0", ["apache2-grant", "apache2-comply", "apache2-copy", "apache2-url", "apache2-asis", "apache2-see"]),
    ("Apache-2.0", ["apache2-grant", "apache2-comply", "apache2-copy-url", "apache2-asis", "apache2-see"]),
    ("Apache-2.0", ["apache2-grant", "apache2-comply"]),
    ("Apache-2.0", ["apache2-line"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-asis", "mit-liable"]),
    ("MIT", ["mit-line"]),
    ("MIT", ["mit-line2"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-later", "gpl-warranty", "gpl-implied", "gpl-see"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-later"]),
    ("GPL-3.0-only", ["gpl3-line"]),
    ("CC-BY-NC-4.0", ["ccbync4-line"]),
    ("CC-BY-4.0", ["ccby4-line"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = r"[ \t\n\x0B\f\r]"
ENDS = rf"(?<=[.!?;:]){SPACE}+|\n{SPACE}*\n"
#: Lines without letters and digits, as between the paragraphs of a comment.
BARE = r"\n(?:[^\p{L}\p{N}\n]*+\n)++"
OTHER = "[^a-z0-9]+"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(sentence, UPPER, LOWER), OTHER, " "))


def plain(sentence: str) -> str:
    """The same of a known sentence."""
    letters = sentence.translate(str.maketrans(UPPER, LOWER))
    return " ".join("".join(c if c in LOWER or c in "0123456789" else " " for c in letters).split())




def sentence_ids(text: Column, sentences: dict[str, str]) -> Column:
    """The identifiers of known sentences in the order of the text."""
    known = F.create_map(*(F.lit(x) for name, s in sentences.items() for x in (plain(s), name)))
    of = lambda s: F.element_at(known, normalised(s))

    def by_lines(paragraph: Column) -> Column:
        whole = of(paragraph)
        lines = F.filter(F.transform(F.split(paragraph, "\n"), of), lambda x: x.isNotNull())
        return F.when(whole.isNotNull(), F.array(whole)).otherwise(lines)

    def tried(sentence: Column) -> Column:
        whole = of(sentence)
        return F.when(whole.isNotNull(), F.array(whole)).otherwise(F.flatten(F.transform(F.split(sentence, BARE), by_lines)))

    return F.flatten(F.transform(F.split(F.coalesce(text, F.lit("")), ENDS), tried))


def matches(ids: Column, rules: list[tuple[str, list[str]]]) -> Column:
    """The rules' sequences taken from left to right, longest first; each is written as `<id><id>`."""
    spelled = F.array_join(F.transform(ids, lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")
    sequences = sorted({"".join(f"<{x}>" for x in rule) for _, rule in rules}, key=lambda s: (-s.count("<"), s))
    return F.regexp_extract_all(spelled, F.lit("(" + "|".join(sequences) + ")"), 1)


def scan(documents: DataFrame, sentences: dict[str, str] = SENTENCES, rules: list[tuple[str, list[str]]] = RULES) -> DataFrame:
    """(doc_id, licenses, sentences, unexplained) of every row of documents (doc_id bigint, text string).

    `licenses` are distinct and in order of their names; `sentences` are all known ones in order of the text; `unexplained`
    counts those of them that no rule takes.
    """
    names = F.create_map(*(F.lit(x) for name, rule in rules for x in ("".join(f"<{y}>" for y in rule), name)))
    found = documents.select("doc_id", sentence_ids(F.col("text"), sentences).alias("sentences"))
    found = found.withColumn("taken", matches(F.col("sentences"), rules))
    licenses = F.array_sort(F.array_distinct(F.transform("taken", lambda x: F.element_at(names, x))))
    explained = F.aggregate("taken", F.lit(0), lambda n, x: n + F.regexp_count(x, F.lit("<")))
    return found.select("doc_id", licenses.alias("licenses"), "sentences", (F.size("sentences") - explained).alias("unexplained"))
