from __future__ import annotations

import textwrap

import duckdb

from daybook.llm import licenses
from tests.llm.conftest import ODD

ROWS = [
    (20, licenses.MIT),
    (21, "MIT License\n\nCopyright (c) 2021 A Person <a@b.cc>\n\n" + licenses.MIT.upper().replace(",", " , ")),
    (22, "Some text.\n  ** Licensed under the APACHE Licence, version 2.0 **\nmore text\nAll rights reserved."),
    (23, "Released under the MIT Licence"),
    (24, "This work is licensed under the GNU General Public License, version 3.\r\nx\r\n"),
    (25, "This text says: Released under the MIT License. And goes on."),
    (26, "© 2020 Somebody\nLicensed under CC BY-NC 4.0."),
    (27, licenses.ISC.replace(" and/or ", " & / or ").replace("\n", " ")),
    (28, "Licensed under CC BY-NC 9.0."),
    (23, "Released under the MIT Licence"),
]


def test_findings(documents):
    got = sorted(tuple(r) for r in licenses.scanned(documents(ROWS + ODD)).collect())
    assert got == [
        (20, 0, "MIT"),
        (21, 0, "MIT"),
        (21, 5, "MIT"),
        (22, 2, "Apache-2.0"),
        (22, 4, "all-rights-reserved"),
        (23, 0, "MIT"),
        (23, 0, "MIT"),
        (23, 1, "MIT"),
        (23, 1, "MIT"),
        (24, 1, "GPL-3"),
        (26, 0, "CC-BY-NC-4.0"),
        (26, 2, "CC-BY-NC-4.0"),
        (27, 0, "ISC"),
        (27, 1, "ISC"),
    ]


def test_findings_equal_sql(documents):
    docs = documents(ROWS + ODD + [(40, APACHE_FILE), (41, GPL_FILE), (None, APACHE_FILE), (40, APACHE_FILE)])
    db = duckdb.connect()
    db.register("documents", docs.select("doc_id", "text").toArrow())
    want = db.execute(licenses.scan_sql()).fetchall()
    assert sorted((tuple(r) for r in licenses.scanned(docs).collect()), key=str) == sorted(want, key=str)


# Written out here and not taken from the module.
APACHE_FILE = """# -*- coding: utf-8 -*-
#
# Copyright 2019 The Authors. All rights reserved.
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.

import os
"""
GPL_FILE = """/*
 * A program.
 * Copyright (C) 2007 Somebody
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
 *
 * You should have received a copy of the GNU General Public License
 * along with this program.  If not, see <https://www.gnu.org/licenses/>.
 */"""


def findings(documents, text):
    return sorted((r.line, r.license) for r in licenses.scanned(documents([(1, text)])).collect())


def test_headers_of_files(documents):
    assert findings(documents, APACHE_FILE) == [(5, "Apache-2.0")]
    # The first two paragraphs are a known text of their own, which a program may have without the third.
    assert findings(documents, GPL_FILE) == [(5, "GPL-3")] * 2
    assert findings(documents, APACHE_FILE.replace("limitations", "exceptions")) == []


def test_every_full_text_is_found_whole_wrapped_and_inside_others(documents):
    rows, want = [], {}
    full = licenses._whole_texts()
    for n, (licence, text) in enumerate(full):
        # Lists of conditions may be without blank lines, so lines are joined only within paragraphs of prose.
        wrapped = "\n\n".join("\n".join(textwrap.wrap(" ".join(p.split()), 40)) for p in text.split("\n\n"))
        for k, body in enumerate((text, wrapped)):
            at = 10 * n + 3 * k
            rows += [
                (at, body),
                (at + 1, f"Copyright (c) 1999 Somebody\nCopyright (c) 2001, Another\n\n{body.upper()}"),
                (at + 2, f"Some package.\nIt does things.\n\n© 2020 A\n\n{body}\n\n---\nMore text."),
            ]
            want |= {at: (0, licence), at + 1: (0, licence), at + 2: (6, licence)}
    got = {}
    for r in licenses.scanned(documents(rows)).collect():
        got.setdefault(r.doc_id, set()).add((r.line, r.license))
    assert {i: w for i, w in want.items() if w not in got.get(i, ())} == {}


def test_a_changed_word_or_a_missing_paragraph_is_not_found(documents):
    for text in (licenses.MIT.replace("free of charge", "for a charge"), licenses.ZLIB.rsplit("\n\n", 1)[0]):
        assert findings(documents, text) == [] == findings(documents, f"Title.\n\n{text}\n\nEnd.")


def test_many_paragraphs(documents):
    filler = "\n\n".join(f"paragraph {k}\nof two lines" for k in range(3000))
    text = f"{filler}\n\n{licenses.MIT}\n\n{filler}\n\n{licenses.ZLIB}"
    assert findings(documents, text) == [(9001, "MIT"), (text[: text.index(licenses.ZLIB)].count("\n") + 1, "Zlib")]


def test_runs_do_not_depend_on_first_digests(documents, monkeypatch):
    docs = documents(ROWS + [(1, APACHE_FILE), (2, GPL_FILE)])
    want = sorted(map(tuple, licenses.scanned(docs).collect()))
    monkeypatch.setattr(licenses, "MOST_FIRST", 3)
    assert sorted(map(tuple, licenses.scanned(docs).collect())) == want


def test_own_table_and_shuffled_join(documents, spark, monkeypatch):
    known = spark.createDataFrame([("b", "Some Text"), ("a", "some text!"), ("c", "..."), (None, None)], "license string, text string")
    docs = documents([(1, "x\nSOME text"), (2, "..."), (3, None)])
    assert [tuple(r) for r in licenses.scanned(docs, known).collect()] == [(1, 2, "a")]
    assert licenses.scanned(docs, known.limit(0)).collect() == []
    monkeypatch.setattr(licenses, "BROADCAST_KNOWN", 0)
    assert [tuple(r) for r in licenses.scanned(docs, known).collect()] == [(1, 2, "a")]


def test_empty_table(documents):
    assert licenses.scanned(documents([])).collect() == []
