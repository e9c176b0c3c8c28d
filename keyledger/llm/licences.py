"""License scans by sentence rules.

A text is normalised (A-Z lower-cased, everything but letters, digits, line ends
and sentence ends made blank) and cut into sentences, one to a line at least;
known licence sentences map to identifiers, and a document becomes the sequence
of identifiers it holds, in order.  A known sentence may be wrapped: it begins
and ends where a line or a sentence does, and its words may lie on any number of
lines, comment leaders before them, but never across punctuation that ends a
sentence or a blank line.  The colon of an SPDX tag and the dot of "v. 2.0" end
nothing.  Ordered rules then name licences: the longest sequences first, each
match consumed, so the two-clause rule does not fire inside a three-clause text.
Everything happens in the row: DataFrame functions only, and no shuffle.

Defined cases: null text counts as empty; a text without known sentences has
empty lists; sentences that no rule uses are reported as unmatched.  An empty
table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyledger.llm.common import documents, text_or_empty

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A run of ends is tried where it begins and taken whole, so long runs cost no more than their length.
END_OF_SENTENCE = r"(?<![.!?;:])[.!?;:]++([ \t\r\n]|\z)"
NOT_KEPT = r"[^a-z0-9\n]+"
ENDS_NOTHING = r"(?<=license-identifier):|(?<=\bv)\.(?=[^a-z0-9.!?;:]+[0-9])"
BREAK = "E"  # a sentence's end in a lower-cased text; a line's end stays \n

# Sentences of public licence texts and their identifiers.
SENTENCES = {
    "MITref": ["Released under the MIT License.", "Licensed under the MIT License.",
               "This project is licensed under the MIT License.", "SPDX-License-Identifier MIT"],
    "MITperm": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'],
    "MITnotice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "MITasis": ['THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'],
    "MITliable": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "Apache2ref": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier Apache-2.0",
                   'Licensed under the Apache License, Version 2.0 (the "License");'],
    "ApacheUse": ["you may not use this file except in compliance with the License."],
    "ApacheAsis": ['Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'],
    "GPL3ref": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier GPL-3.0-only",
                "Licensed under the GNU General Public License v3.0."],
    "GPL2ref": ["This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier GPL-2.0-only"],
    "GPL3redist": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "GPL2redist": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;"],
    "GPL2version": ["either version 2 of the License, or (at your option) any later version."],
    "GPLwarranty": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"],
    "CCBYNC4ref": ["Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier CC-BY-NC-4.0",
                   "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CCBY4ref": ["Licensed under CC BY 4.0.", "SPDX-License-Identifier CC-BY-4.0",
                 "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "BSDredist": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "BSDsource": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "BSDbinary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "BSDendorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "MPL2ref": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier MPL-2.0"],
}
# Rules, longer sequences before the ones they contain.
RULES = [
    ("Apache-2.0", ["Apache2ref", "ApacheUse", "ApacheAsis"]),
    ("BSD-3-Clause", ["BSDredist", "BSDsource", "BSDbinary", "BSDendorse"]),
    ("MIT", ["MITperm", "MITnotice", "MITasis", "MITliable"]),
    ("BSD-2-Clause", ["BSDredist", "BSDsource", "BSDbinary"]),
    ("GPL-2.0-or-later", ["GPL2redist", "GPL2version", "GPLwarranty"]),
    ("GPL-3.0-or-later", ["GPL3redist", "GPLwarranty"]),
    ("MIT", ["MITperm", "MITnotice"]),
    ("GPL-3.0-or-later", ["GPL3redist"]),
    ("GPL-2.0-or-later", ["GPL2redist", "GPL2version"]),
    ("Apache-2.0", ["Apache2ref"]),
    ("MIT", ["MITref"]),
    ("GPL-3.0", ["GPL3ref"]),
    ("GPL-2.0", ["GPL2ref"]),
    ("CC-BY-NC-4.0", ["CCBYNC4ref"]),
    ("CC-BY-4.0", ["CCBY4ref"]),
    ("MPL-2.0", ["MPL2ref"]),
]


def flat(text: str) -> str:
    """A normalised text with its line ends and BREAKs, as the columns below make it."""
    kept = re.sub(ENDS_NOTHING, " ", text.translate(str.maketrans(UPPER, LOWER)), flags=re.ASCII)
    ended = re.sub(END_OF_SENTENCE.replace(r"\z", r"\Z"), BREAK, kept)
    lines = re.sub(r" *\n *", "\n", re.sub(NOT_KEPT.replace("0-9", f"0-9{BREAK}"), " ", ended))
    return re.sub(f" *{BREAK} *", BREAK, re.sub(r"\n\n+", BREAK, lines)).strip(" ")


def normalise(text: str) -> list[str]:
    """The sentences of a text, those on several lines cut by line."""
    return [s for s in re.split(f"[\n{BREAK}]", flat(text)) if s]


def known_sentences() -> dict[str, str]:
    """Normalised sentence, whole: identifier."""
    return {" ".join(normalise(s)): name for name, sentences in SENTENCES.items() for s in sentences}


def known_pattern() -> str:
    """Any known sentence, on one line or wrapped; the longest first."""
    edge = f"[^\\n{BREAK}]"
    any_of = "|".join(s.replace(" ", r"[ \n]") for s in sorted(known_sentences(), key=lambda s: (-len(s), s)))
    return f"(?<!{edge})(?:{any_of})(?!{edge})"


def _token(name: str) -> str:
    return f" {name} "


def scan_licences(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: n_sentences, n_known, sentence_ids (in
    order), licences (distinct, sorted), n_matches, unmatched."""
    known = known_sentences()
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    kept = F.regexp_replace(F.translate(text_or_empty(), UPPER, LOWER), ENDS_NOTHING, " ")
    ended = F.regexp_replace(kept, END_OF_SENTENCE, BREAK)
    lines = F.regexp_replace(F.regexp_replace(ended, NOT_KEPT.replace("0-9", f"0-9{BREAK}"), " "), r" *\n *", "\n")
    flat_text = F.trim(F.regexp_replace(F.regexp_replace(lines, r"\n\n+", BREAK), f" *{BREAK} *", BREAK))
    a = docs.select("doc_id", flat_text.alias("flat"))
    b = a.select("doc_id", F.size(F.filter(F.split("flat", f"[\n{BREAK}]"), lambda s: s != "")).cast("bigint").alias("n_sentences"),
                 F.transform(F.regexp_extract_all("flat", F.lit(known_pattern()), 0),
                             lambda s: table[F.translate(s, "\n", " ")]).alias("ids"))
    found = F.array_join(F.transform("ids", lambda x: F.concat(F.lit(" "), x, F.lit(" "))), "")
    for i, (_, sequence) in enumerate(RULES):
        found = F.replace(found, F.lit("".join(map(_token, sequence))), F.lit(_token(f"<{i}>")))
    c = b.select("*", F.when(F.size("ids") > 0, F.filter(F.split(found, " +"), lambda x: x != "")).otherwise(
        F.array().cast("array<string>")).alias("marks"))
    names = F.array(*[F.lit(n) for n, _ in RULES])
    rule = F.transform(F.filter("marks", lambda x: x.startswith("<")),
                       lambda x: F.element_at(names, F.regexp_extract(x, r"\d+", 0).cast("int") + 1))
    return c.select(
        "doc_id", "n_sentences", F.size("ids").cast("bigint").alias("n_known"), F.array_join("ids", ",").alias("sentence_ids"),
        F.array_join(F.array_sort(F.array_distinct(rule)), ",").alias("licences"), F.size(rule).cast("bigint").alias("n_matches"),
        F.array_join(F.filter("marks", lambda x: ~x.startswith("<")), ",").alias("unmatched"))


def op9_licence_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licences(documents(spark, sf_dir))


def _oracle() -> str:
    """DuckDB: the same sentences by patterns without looks around.  Line ends and
    BREAKs are doubled, so that a sentence can take one on either side and leave
    one to its neighbour."""
    known = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in known_sentences().items()) + "}"
    any_of = "|".join(s.replace(" ", "( |\\n\\n)") for s in sorted(known_sentences(), key=lambda s: (-len(s), s)))
    steps = [("license-identifier:", "license-identifier "), (r"\bv\.([^a-z0-9.!?;:]+[0-9])", r"v \1"),
             (r"[.!?;:]+([ \t\r\n]|\z)", BREAK), (NOT_KEPT.replace("0-9", f"0-9{BREAK}"), " "), (r" *\n *", "\n"),
             (r"\n\n+", BREAK), (f" *{BREAK} *", BREAK)]
    flat_text = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    for pattern, to in steps:
        flat_text = f"regexp_replace({flat_text}, '{pattern}', " + ("chr(10)" if to == "\n" else f"'{to}'") + ", 'g')"
    found = "array_to_string(list_transform(ids, lambda x: ' ' || x || ' '), '')"
    for i, (_, sequence) in enumerate(RULES):
        found = f"replace({found}, '{''.join(map(_token, sequence))}', '{_token(f'<{i}>')}')"
    names = "[" + ", ".join(f"'{n}'" for n, _ in RULES) + "]"
    return f"""
WITH a AS (SELECT doc_id, trim({flat_text}, ' ') AS flat FROM documents),
b AS (SELECT doc_id, len(list_filter(regexp_split_to_array(flat, '[\n{BREAK}]'), lambda s: s <> ''))::BIGINT AS n_sentences,
  list_transform(regexp_extract_all('{BREAK}' || regexp_replace(flat, '([\n{BREAK}])', '\\1\\1', 'g') || '{BREAK}',
                                    '[\n{BREAK}]({any_of})[\n{BREAK}]', 1), lambda s: {known}[replace(s, chr(10) || chr(10), ' ')]) AS ids FROM a),
c AS (SELECT *, list_filter(regexp_split_to_array({found}, ' +'), lambda x: x <> '') AS marks FROM b),
d AS (SELECT *, list_transform(list_filter(marks, lambda x: x[1:1] = '<'), lambda x: {names}[regexp_extract(x, '[0-9]+')::INT + 1]) AS rule FROM c)
SELECT doc_id, n_sentences, len(ids)::BIGINT AS n_known, array_to_string(ids, ',') AS sentence_ids,
  array_to_string(list_sort(list_distinct(rule)), ',') AS licences, len(rule)::BIGINT AS n_matches,
  array_to_string(list_filter(marks, lambda x: x[1:1] <> '<'), ',') AS unmatched
FROM d
"""


ORACLE = _oracle()
