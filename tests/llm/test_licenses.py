from __future__ import annotations

import pytest
from helpers import odd_docs, odd_rows

from palisade.llm import licenses

MIT = "\n".join(text for name, text in licenses.SENTENCES if name.startswith("mit"))
WRAPPED = "# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in\n# compliance with the License.\n# You may obtain a copy of the License at\n#\n#     http://www.apache.org/licenses/LICENSE-2.0\n"


@pytest.mark.parametrize(
    "text, names, verdict",
    [
        (f"Copyright (c) 2020 Somebody\n\n{MIT}\n", ["MIT"], "known"),
        (WRAPPED + "import os", ["Apache-2.0"], "known"),
        ("Prose.\nReleased under the MIT License.\nMore prose", ["MIT"], "known"),
        ("This work is licensed under the GNU General Public Licence, version 3.", ["GPL-3.0"], "known"),
        ("SPDX-License-Identifier: MPL-2.0\n", ["MPL-2.0"], "known"),
        ("Licensed under CC BY-NC 4.0. Licensed under the MIT license.", ["MIT", "CC-BY-NC-4.0"], "known"),
        ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", [], "partial"),
        ("This work is licensed under the Moon Dust License.", [], "unknown"),
        ("A permit is no license to kill time.", [], "unknown"),
        ("Nothing of the kind.", [], "none"),
    ],
)
def test_rules(spark, text, names, verdict):
    row = licenses.scan(odd_docs(spark, [(1, text)])).first()
    assert (row.licenses, row.verdict) == (names, verdict)


def test_oddities_and_empty_table(spark):
    found = licenses.scan(odd_docs(spark))
    assert found.count() == len(odd_rows())
    assert {r.verdict for r in found.collect()} == {"none"}
    assert found.columns.count("verdict") == 1
    assert licenses.scan(odd_docs(spark, [])).count() == 0


def test_every_known_sentence_has_a_hint_and_a_rule():
    parts = {part for _, rule in licenses.RULES for part in rule.split()}
    for name, text in licenses.known_sentences():
        assert any(hint in text.lower() for hint in licenses.HINTS), text
        assert name in parts or name == "rights-reserved"


def test_no_python_and_no_shuffle(spark, plan):
    shown = plan(licenses.scan(odd_docs(spark)))
    assert not any(node in shown for node in ("InArrow", "EvalPython", "InPandas", "Exchange"))


def test_every_lead_with_every_name(spark):
    leads = ["This dataset is {} under ", "{} under the terms of the ", "{} under "]
    verbs = ["licensed", "released", "distributed", "published", "available", "made available", "provided"]
    rows = [
        (name, (lead.format(verb) + form + ".").capitalize() if upper else lead.format(verb) + form + ".")
        for name, forms in licenses.NAMES.items() for form in forms for lead in leads for verb in verbs for upper in (True, False)
    ]
    found = licenses.scan(odd_docs(spark, [(i, text) for i, (_, text) in enumerate(rows)])).collect()
    assert len(found) == len(rows)
    assert [rows[r.doc_id] for r in found if (r.licenses, r.verdict) != ([rows[r.doc_id][0]], "known")] == []


def test_phrases_broken_over_lines_and_marks(spark):
    texts = [
        ("This is free and unencumbered software released into the public\ndomain.", ["unlicense-free"]),
        ("// All rights\n// reserved.", ["rights-reserved"]),
        ("All  rights\treserved.", ["rights-reserved"]),
        ("Released under\nCC BY 4.0.", ["under-cc-by-4.0"]),
        ("Released under (MIT).", ["under-mit"]),
        (dict(licenses.SENTENCES)["mit-liability"].replace("COPYRIGHT", "(C)"), ["mit-liability"]),
    ]
    found = licenses.scan(odd_docs(spark, [(i, text) for i, (text, _) in enumerate(texts)])).collect()
    assert {r.doc_id: r.sentence_ids for r in found} == {i: ids for i, (_, ids) in enumerate(texts)}


def test_every_known_sentence_has_a_word_hint_in_one_word(spark):
    listed = spark.createDataFrame([(text,) for _, text in licenses.known_sentences()], "text string")
    for row in listed.select("text", licenses.normalised("text").alias("words")).collect():
        # These words are made by the normalisation, so a text needn't hold them as they are.
        words = [w for w in row.words.split() if w not in ("copyright", "url")]
        assert any(hint in w for hint in licenses.WORD_HINTS for w in words), row.text


def test_a_license_that_stands_twice_and_a_notice_beside_it(spark):
    full = "\n\n".join(text for name, text in licenses.SENTENCES if name.startswith("mit-"))
    bsd = "Copyright (c) 2020, A. All rights reserved.\n\n" + "\n\n".join(text for name, text in licenses.SENTENCES if name.startswith("bsd-"))
    rows = [
        (1, "Released under the MIT License. Released under the MIT License."), (2, f"{full}\n\n{full}"), (3, bsd),
        (4, "All rights reserved."), (5, f"{full}\n\nAll rights reserved.\n\n{full}\n\n{full}"), (6, "See the GNU General Public License for more details."),
    ]
    found = {r.doc_id: (list(r.licenses), r.verdict) for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == {
        1: (["MIT"], "known"), 2: (["MIT"], "known"), 3: (["BSD-3-Clause"], "known"), 4: ([], "none"), 5: (["MIT"], "known"), 6: ([], "partial"),
    }
