"""License scan by sentence rules. DataFrame functions only.

Sentences are normalised and mapped to identifiers of known license sentences; ordered rules then match the sequence of
identifiers, and what a rule has matched is taken away before the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of well-known licenses and notices, as identifier and text.
SENTENCES = [
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("mit-notice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit-warranty", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("mit-liability", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd-source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd-endorse", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd-warranty", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("apache2-grant", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("apache2-copy", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache2-copy", "You may obtain a copy of the License at"),
    ("apache2-basis", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("apache2-see", "See the License for the specific language governing permissions and limitations under the License."),
    ("gpl-free", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-free-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("lgpl-free", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("gpl-hope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("gpl-see", "See the GNU General Public License for more details."),
    ("gpl-received", "You should have received a copy of the GNU General Public License along with this program."),
    ("mpl2-subject", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense-free", "This is free and unencumbered software released into the public domain."),
    ("rights-reserved", "All rights reserved."),
]

# How short statements name a license, after "licensed under the" and the like.
NAMES = {
    "MIT": ["MIT License", "MIT"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "Apache 2.0 License"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GPL-3.0", "GPLv3", "GNU GPL v3"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GPL-2.0", "GPLv2", "GNU GPL v2"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "LGPL-2.1", "LGPLv2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPL-3.0", "LGPLv3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPL-3.0", "AGPLv3"],
    "BSD-3-Clause": ["BSD 3-Clause License", "BSD-3-Clause", "3-Clause BSD License", "New BSD License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "BSD-2-Clause", "2-Clause BSD License", "Simplified BSD License"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL-2.0", "MPL 2.0"],
    "ISC": ["ISC License", "ISC"],
    "CC0-1.0": ["CC0 1.0", "CC0-1.0", "CC0 1.0 Universal"],
    **{
        f"CC-{kind}-{version}": [f"CC {kind} {version}", f"CC-{kind}-{version}"]
        for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
        for version in ("3.0", "4.0")
    },
}

# Parts of words in lower case. Every known sentence, as normalised, has a word that holds one of them, and so has every open
# statement; blanks, marks and line ends between words don't matter. No step of the normalisation brings one in.
WORD_HINTS = ["licen", "permi", "warrant", "redistribut", "under", "unencumbered", "reserved", "liable"]
# What the SQL looks for instead. It misses statements without the word license, and phrases broken over lines.
HINTS = ["licen", "permi", "warrant", "copyright", "public domain", "redistribut", "all rights reserved"]

# Stands beside licenses of any kind and by itself grants nothing, so no rule needs to take it.
NEUTRAL = "rights-reserved"

# Ordered: the first rule that finds its identifiers one after the other takes them.
RULES = [
    ("MIT", "mit-grant mit-notice mit-warranty mit-liability"),
    ("MIT", "mit-grant mit-notice mit-warranty"),
    ("MIT", "mit-grant mit-notice"),
    ("BSD-3-Clause", "bsd-grant bsd-source bsd-binary bsd-endorse bsd-warranty"),
    ("BSD-3-Clause", "bsd-grant bsd-source bsd-binary bsd-endorse"),
    ("BSD-2-Clause", "bsd-grant bsd-source bsd-binary bsd-warranty"),
    ("BSD-2-Clause", "bsd-grant bsd-source bsd-binary"),
    ("ISC", "isc-grant"),
    ("Apache-2.0", "apache2-grant apache2-copy apache2-basis apache2-see"),
    ("Apache-2.0", "apache2-grant apache2-copy"),
    ("Apache-2.0", "apache2-grant"),
    ("GPL-3.0-or-later", "gpl-free gpl-hope gpl-see gpl-received"),
    ("GPL-3.0-or-later", "gpl-free"),
    ("GPL-2.0-or-later", "gpl-free-2 gpl-hope gpl-see gpl-received"),
    ("GPL-2.0-or-later", "gpl-free-2"),
    ("LGPL-2.1-or-later", "lgpl-free"),
    ("MPL-2.0", "mpl2-subject"),
    ("Unlicense", "unlicense-free"),
    *[(name, f"under-{name.lower()}") for name in NAMES],
]

LEAD = (
    r"^((this|the|these|all) ([a-z]+ ){1,3}(is|are|was) )?(dual )?(licensed|released|distributed|published|available|made available|provided)"
    r"( and distributed)? under (the )?(terms of (the )?)?"
)
# The parts of a sentence's end: a mark and blanks, or line ends.
SENTENCE_END = r"[.!?][\"')]*[ \t]+|[ \t]*[\r\n]+[ \t]*"
PARAGRAPH_END = r"[.!?][\"')]*[ \t\r\n]+|[\r\n]+[ \t]*[\r\n]+"
LINE_START = r"(^|\n)[ \t]*(//+|#+|\*+|/\*+|;+|--|%+|[0-9]+\.)[ \t]*"

# What a sentence that speaks of a license holds.
OPEN = "(^| )licensed?( |$)"

# Steps of the normalisation after lower case, as pattern and replacement.
STEPS = [
    (r"licence", "license"),
    (r"https?://[^ ]*", "url"),
    (r"\(c\)", "copyright"),
    (r"[^a-z0-9.+-]+", " "),
    (r"[.-]+( |$)", " "),
    (r"(^| )[.-]+", " "),
    (r" +", " "),
    (r"^ | $", ""),
    (LEAD, "under "),
]


def normalised(sentence: Column) -> Column:
    sentence = F.lower(sentence)
    for pattern, replacement in STEPS:
        sentence = F.regexp_replace(sentence, pattern, replacement)
    return sentence


def known_sentences() -> list[tuple[str, str]]:
    """Identifier and text of all known sentences, short statements included."""
    stated = [(f"under-{name.lower()}", f"Licensed under the {form}.") for name, forms in NAMES.items() for form in forms]
    marked = [(f"under-{name.lower()}", f"SPDX-License-Identifier: {name}") for name in NAMES]
    return [*SENTENCES, *stated, *marked]


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """All documents with ``sentence_ids`` (known sentences in order), ``licenses`` (in the order of the rules) and
    ``verdict``: "none", "known", "partial" (known sentences other than ``NEUTRAL`` are left that no rule takes) or "unknown" (a sentence speaks
    of a license but isn't known).

    Each text is read twice, line by line and with lines joined to paragraphs, and the reading with more known sentences
    counts. Everything happens within a row, so there is no shuffle, and a line that a third of all texts hold costs
    nothing extra. Texts without any hint word are done after one look. NULL and empty texts have the verdict "none"; an
    empty table gives an empty result. Input columns of the three names are replaced.
    """
    spark = docs.sparkSession
    listed = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(t).alias("text")) for i, t in known_sentences()])
    known = spark.range(1).select(F.inline(listed)).select("id", normalised(F.col("text")).alias("text"))
    # About a hundred fixed rows.
    places = {row["text"]: row["id"] for row in known.collect()}
    names = F.create_map(*[F.lit(x) for pair in sorted(places.items()) for x in pair])

    lower = F.lower(F.coalesce(F.col(text), F.lit("")))
    hinted = F.lit(False)
    for hint in WORD_HINTS:
        hinted = hinted | lower.contains(hint)

    def read(body: Column, end: str) -> Column:
        sentences = F.transform(F.split(body, end), normalised)
        return F.filter(F.transform(sentences, lambda s: F.struct(s.alias("text"), F.element_at(names, s).alias("id"))), lambda s: s["text"] != "")

    bare = F.regexp_replace(F.col(text), LINE_START, "\n")
    joined = F.regexp_replace(bare, r"([^\r\n])\r?\n([^\r\n])", "$1 $2")

    def count(found: Column) -> Column:
        return F.size(F.filter(found, lambda s: s["id"].isNotNull()))

    found = F.transform(F.array(F.struct(read(bare, SENTENCE_END).alias("lines"), read(joined, PARAGRAPH_END).alias("paragraphs"))), lambda r: F.when(count(r["paragraphs"]) > count(r["lines"]), r["paragraphs"]).otherwise(r["lines"]))[0]
    none = F.array().cast("array<struct<text:string,id:string>>")
    kept = [c for c in docs.columns if c not in ("sentence_ids", "licenses", "verdict")]
    scanned = docs.select(*kept, F.when(hinted, found).otherwise(none).alias("found sentences"))

    # The identifiers as one text, each with blanks of its own on both sides: a rule is a search for a part of it, and a license
    # that stands twice in a row is found twice.
    ids = F.transform(F.filter("found sentences", lambda s: s["id"].isNotNull()), lambda s: s["id"])
    told = F.filter(ids, lambda i: i != NEUTRAL)
    sequence = F.array_join(F.transform(told, lambda i: F.concat(F.lit(" "), i, F.lit(" "))), "")
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(f" {part.replace(' ', '  ')} ").alias("part")) for name, part in RULES])
    start = F.struct(sequence.alias("rest"), F.array().cast("array<string>").alias("names"))

    def apply(state: Column, rule: Column) -> Column:
        matched = F.instr(state["rest"], rule["part"]) > 0
        return F.struct(
            F.when(matched, F.replace(state["rest"], rule["part"], F.lit(" | "))).otherwise(state["rest"]).alias("rest"),
            F.when(matched, F.concat(state["names"], F.array(rule["name"]))).otherwise(state["names"]).alias("names"),
        )

    state = F.when(F.size(ids) > 0, F.aggregate(rules, start, apply)).otherwise(start)
    matched = scanned.select(*kept, "found sentences", ids.alias("sentence_ids"), state.alias("matched rules"))
    open_statement = F.exists("found sentences", lambda s: s["id"].isNull() & s["text"].rlike(OPEN))
    verdict = (
        F.when(F.regexp_replace("matched rules.rest", "[| ]+", "") != "", "partial")
        .when(F.size("matched rules.names") > 0, "known")
        .when(open_statement, "unknown")
        .otherwise("none")
    )
    return matched.select(*kept, "sentence_ids", F.array_distinct("matched rules.names").alias("licenses"), verdict.alias("verdict"))
