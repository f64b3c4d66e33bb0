r"""Licence scans by canonical digest.

A text is brought to a canonical form: lower case, no copyright lines, no punctuation, one spelling of
words that are written in several ways. The digest of that form is looked up among the digests of
known licence texts. Looked up are the text of a document as a whole, each of its lines as a whole, and
each run of as many paragraphs as some known text has, so that a notice on a line of its own and a
licence between other paragraphs are found in any document, however their lines are wrapped.

Only built-in expressions are used. The known texts are canonicalised by the same expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_KNOWN = 100_000  # digests of known texts
MOST_FIRST = 4_096  # digests of first paragraphs that go into the plan

# Short licence texts and the wordings of notices.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN
NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all
copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING
OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
ISC_FIRST = """Permission to use, copy, modify, and distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all
copies."""
ZERO_BSD_FIRST = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted."""
BSD_FIRST = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:"""
BSD_SOURCE = """Redistributions of source code must retain the above copyright notice, this list of conditions and
the following disclaimer."""
BSD_BINARY = """Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_NAMES = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""
BSD_LAST = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY
DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications,
and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software.

3. This notice may not be removed or altered from any source distribution."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source
code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all
copyright interest in the software to the public domain. We make this dedication for the benefit of the
public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt
act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE."""
UNLICENSE_LINK = "For more information, please refer to <{}://unlicense.org{}>"
# Headers of files under licences that are too long for each file.
APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

{}://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
MPL was not distributed with this file, You can obtain one at {}://mozilla.org/MPL/2.0/."""
GNU_HEADER = """{subject} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU
{family} as published by the Free Software Foundation{version}

{subject} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {family} for more
details."""
GNU_COPY = """You should have received a copy of the GNU {family} along with {this}. If not, see
<{scheme}://www.gnu.org/licenses/>."""
GNU_FAMILIES = {
    "GPL": ("General Public License", ("2", "3")),
    "LGPL": ("Lesser General Public License", ("2.1", "3")),
    "AGPL": ("Affero General Public License", ("3",)),
}
NAMES = {
    "MIT": ["MIT License"],
    "ISC": ["ISC License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    "Unlicense": ["Unlicense"],
}
# Families with a version in the name.
VERSIONED = {
    ("GPL", ("1", "2", "3")): ["GNU General Public License, version {}", "GNU GPL v{}", "GPL-{}.0"],
    ("LGPL", ("2", "2.1", "3")): ["GNU Lesser General Public License, version {}", "GNU LGPL v{}"],
    ("AGPL", ("3",)): ["GNU Affero General Public License, version {}", "GNU AGPL v{}"],
}
CREATIVE_COMMONS = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
CREATIVE_COMMONS_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
WORDINGS = (
    "Licensed under {}.",
    "Licensed under the {}.",
    "Released under {}.",
    "Released under the {}.",
    "Distributed under the {}.",
    "This work is licensed under {}.",
    "This work is licensed under the {}.",
    "This software is licensed under the {}.",
    "SPDX-License-Identifier: {}",
)


def _whole_texts() -> list[tuple[str, str]]:
    """(licence, text) of the licences and file headers that are known in full, without their titles."""
    isc_last = ISC.split("\n\n")[1]
    texts = [
        ("MIT", MIT),
        ("ISC", ISC),
        ("ISC", f"{ISC_FIRST}\n\n{isc_last}"),
        ("0BSD", f"{ZERO_BSD_FIRST}\n\n{isc_last}"),
        ("Zlib", ZLIB),
        ("Unlicense", UNLICENSE),
    ]
    texts += [
        ("Unlicense", f"{UNLICENSE}\n\n{UNLICENSE_LINK.format(*link)}")
        for link in (("http", ""), ("http", "/"), ("https", ""), ("https", "/"))
    ]
    for licence, parts in (
        ("BSD-2-Clause", [BSD_SOURCE, BSD_BINARY]),
        ("BSD-3-Clause", [BSD_SOURCE, BSD_BINARY, BSD_NAMES]),
    ):
        numbered = [f"{n}. {part}" for n, part in enumerate(parts, 1)]
        # Numbers or dots, between blank lines or not.
        for conditions in ("\n\n".join(numbered), "\n\n".join(parts), "\n".join(numbered), "\n".join(parts)):
            texts.append((licence, f"{BSD_FIRST}\n\n{conditions}\n\n{BSD_LAST}"))
    for scheme in ("http", "https"):
        texts += [("Apache-2.0", APACHE_HEADER.format(scheme)), ("MPL-2.0", MPL_HEADER.format(scheme))]
    for short, (family, versions) in GNU_FAMILIES.items():
        for version in versions:
            for subject, this in (("This program", "this program"), ("This library", "this library")):
                for mark in (":", ";"):
                    for later in (
                        f", either version {version} of the License, or (at your option) any later version.",
                        f"; either version {version} of the License, or (at your option) any later version.",
                        f", version {version}.",
                    ):
                        head = GNU_HEADER.format(subject=subject, mark=mark, family=family, version=later)
                        texts.append((f"{short}-{version}", head))
                        for scheme in ("http", "https"):
                            copy = GNU_COPY.format(family=family, this=this, scheme=scheme)
                            texts.append((f"{short}-{version}", f"{head}\n\n{copy}"))
    return texts


def known_texts() -> list[tuple[str, str]]:
    """(licence, text) of the texts known in full, with and without title, and of every wording of a notice."""
    names = {licence: [licence, *called] for licence, called in NAMES.items()}
    for (family, versions), called in VERSIONED.items():
        for version in versions:
            names[f"{family}-{version}"] = [name.format(version) for name in called]
    for kind in CREATIVE_COMMONS:
        for version in CREATIVE_COMMONS_VERSIONS:
            names[f"CC-{kind}-{version}"] = [f"CC {kind} {version}", f"CC-{kind}-{version}"]
    full = _whole_texts()
    titles = {"MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"], "0BSD": ["BSD Zero Clause License"]}
    titles |= {"ISC": ["ISC License"], "Zlib": ["zlib License"], "Unlicense": ["The Unlicense"]}
    titles |= {kind: NAMES[kind] for kind in ("BSD-2-Clause", "BSD-3-Clause")}
    texts = full + [(licence, f"{title}\n\n{text}") for licence, text in full for title in titles.get(licence, [])]
    texts += [
        (licence, wording.format(name))
        for licence, called in names.items()
        for name in called
        for wording in WORDINGS
    ]
    return [*texts, ("all-rights-reserved", "All rights reserved.")]


# (pattern, replacement with $1), in this order; the first one takes out copyright lines.
_COPYRIGHT = r"(?md)^[^\p{L}\p{N}\n]*(?:copyright[ \t]*(?:\(c\)|©|[0-9]{4}|by )|\(c\)|©)[^\n]*$"
_STEPS = (
    (_COPYRIGHT, ""),
    ("&", " and "),
    (r"[^\p{L}\p{N}\n]+", " "),
    ("licenc", "licens"),
    ("(author|organ|recogn|util|custom|initial)is(e|i|a)", "$1iz$2"),
    ("(fav|behavi|col|hon)our", "$1or"),
    ("(sub|non) (licens|infring)", "$1$2"),
    (r" *\n *", "\n"),
)


def canonical(text: Column) -> Column:
    """The canonical form, line by line as in the text."""
    form = F.lower(text)
    for pattern, replacement in _STEPS:
        form = F.regexp_replace(form, pattern, replacement)
    return F.trim(form)


def _digest(line: Column) -> Column:
    """NULL for a line without letters and digits."""
    line = F.trim(line)
    return F.when(line != "", F.sha2(line, 256))


def _whole(form: Column) -> Column:
    return _digest(F.regexp_replace(form, r"\n+", " "))


def _paragraphs(form: Column) -> Column:
    """What stands between blank lines; copyright lines and lines of punctuation are blank."""
    body = F.regexp_replace(form, r"\A\n+|\n+\z", "")
    return F.when(body != "", F.split(body, r"\n\n+")).otherwise(F.array().cast("array<string>"))


def _paragraph_digests(paragraphs: Column) -> Column:
    return F.transform(paragraphs, lambda p: F.sha2(F.translate(p, "\n", " "), 256))


def _run(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, ","), 256)


def _known_runs(known: DataFrame) -> tuple[DataFrame, list[int], list[str] | None]:
    """(digest, license) of wholes and runs, the lengths of runs, and the digests that runs begin with.

    There are as many lengths as there are different numbers of paragraphs in known texts. The first digests only
    spare work: they are left out where there are more than ``MOST_FIRST``.
    """
    forms = known.select("license", canonical(F.col("text")).alias("form"))
    forms = forms.select("license", "form", _paragraph_digests(_paragraphs(F.col("form"))).alias("parts"))
    table = forms.select("license", F.explode(F.array(_whole(F.col("form")), _run(F.col("parts")))).alias("digest"))
    forms = forms.filter(F.size("parts") > 0)
    lengths = sorted(r[0] for r in forms.select(F.size("parts")).distinct().collect())
    first = [r[0] for r in forms.select(F.col("parts")[0]).distinct().limit(MOST_FIRST + 1).collect()]
    return table, lengths, first if len(first) <= MOST_FIRST else None


def scanned(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """A row per finding: doc_id, line (from 1, or 0 for the whole text) and license.

    A run of paragraphs is found at its first line if it has several lines and is not the whole text; a known text
    inside a longer known one is found too. ``known`` has rows (license, text), by default those of
    ``known_texts``; a canonical text that several licences share counts for the first of them. NULL and empty
    texts and lines without letters and digits are never found. Each row of docs is looked up for itself, so
    rows that repeat are found again; columns other than doc_id and text are left out.
    """
    if known is None:
        known = docs.sparkSession.createDataFrame(known_texts(), "license string, text string")
    known = known.select("license", F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    table, lengths, first = _known_runs(known)
    table = table.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("license").alias("license"))
    if table.count() <= BROADCAST_KNOWN:
        table = F.broadcast(table)
    form = docs.select("doc_id", canonical(F.col("text").cast("string")).alias("form"))
    cut = form.select("doc_id", "form", _paragraphs(F.col("form")).alias("paragraphs"))
    cut = cut.withColumn("parts", _paragraph_digests(F.col("paragraphs")))
    size = F.size("parts")
    places = F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))
    if first is not None:
        places = F.filter(places, lambda i: F.get("parts", i - 1).isin(first))
    cut = cut.withColumn("places", places)

    def runs(length: int) -> Column:
        fits = F.filter(
            "places",
            lambda i: (i + length - 1 <= size)
            & (size != length)
            & (F.lit(length > 1) | F.get("paragraphs", i - 1).contains("\n")),
        )
        return F.transform(
            fits, lambda i: F.struct(i.alias("at"), _run(F.slice("parts", i, F.lit(length))).alias("digest"))
        )

    cut = cut.withColumn("runs", F.flatten(F.array(*map(runs, lengths or [1]))))
    cut = cut.withColumn("lines", F.split("form", "\n"))
    # The first lines of paragraphs, where a run may have been found.
    begins = F.filter(
        F.transform("lines", lambda line, i: F.when((line != "") & ((i == 0) | (F.get("lines", i - 1) == "")), i + 1)),
        lambda line: line.isNotNull(),
    )
    cut = cut.withColumn("begins", F.when(F.size("runs") > 0, begins))
    unit = lambda line, digest: F.struct(line.cast("int").alias("line"), digest.alias("digest"))
    units = F.concat(
        F.array(unit(F.lit(0), _whole(F.col("form")))),
        F.transform("lines", lambda line, i: unit(i + 1, _digest(line))),
        F.transform("runs", lambda run: unit(F.get("begins", run["at"] - 1), run["digest"])),
    )
    found = cut.select("doc_id", F.inline(units))
    return found.filter("digest IS NOT NULL").join(table, "digest").select("doc_id", "line", "license")


def _canonical_sql(text: str) -> str:
    form = f"lower({text})"
    for pattern, replacement in _STEPS:
        pattern = pattern.replace("(?md)", "(?m)").replace("\n", "\\n")
        replacement = replacement.replace("$", "\\")
        form = f"regexp_replace({form}, '{pattern}', '{replacement}', 'g')"
    return f"trim({form})"


def scan_sql() -> str:
    """The rows of ``scanned`` over documents with the default texts."""
    values = ", ".join(
        "('{}', '{}')".format(license, text.replace("'", "''")) for license, text in known_texts()
    )
    whole = "trim(regexp_replace(form, '\\n+', ' ', 'g'))"
    body = "regexp_replace(form, '\\A\\n+|\\n+\\z', '', 'g')"
    paragraphs = f"CASE WHEN {body} <> '' THEN regexp_split_to_array({body}, '\\n\\n+') ELSE [] END"
    parts = "[sha256(replace(p, chr(10), ' ')) FOR p IN paragraphs]"
    return f"""
    WITH known(license, text) AS (VALUES {values}),
    forms AS (SELECT license, form, paragraphs, {parts} AS parts FROM (
      SELECT license, form, {paragraphs} AS paragraphs FROM (
        SELECT license, {_canonical_sql("text")} AS form FROM known))),
    digests AS (
      SELECT digest, min(license) AS license FROM (
        SELECT sha256({whole}) AS digest, license FROM forms WHERE {whole} <> ''
        UNION ALL SELECT sha256(array_to_string(parts, ',')), license FROM forms WHERE len(parts) > 0)
      GROUP BY 1),
    lengths AS (SELECT DISTINCT len(parts) AS n FROM forms WHERE len(parts) > 0),
    docs AS (SELECT doc_id, {_canonical_sql("text")} AS form FROM documents),
    cut AS (SELECT doc_id, form, paragraphs, {parts} AS parts, string_split(form, chr(10)) AS lines FROM (
      SELECT doc_id, form, {paragraphs} AS paragraphs FROM docs)),
    begins AS (
      SELECT *, [i FOR i IN range(1, len(lines) + 1) IF lines[i] <> '' AND (i = 1 OR lines[i - 1] = '')] AS begins
      FROM cut WHERE form <> ''),
    places AS (SELECT *, unnest(range(1, len(parts) + 1)) AS place FROM begins),
    units AS (
      SELECT doc_id, 0 AS line, sha256({whole}) AS digest FROM docs WHERE {whole} <> ''
      UNION ALL
      SELECT doc_id, line, sha256(unit) FROM (
        SELECT doc_id, generate_subscripts(lines, 1) AS line, trim(unnest(lines)) AS unit FROM cut)
      WHERE unit <> ''
      UNION ALL
      SELECT doc_id, begins[place], sha256(array_to_string(parts[place : place + n - 1], ','))
      FROM places, lengths
      WHERE place + n - 1 <= len(parts) AND n <> len(parts) AND (n > 1 OR contains(paragraphs[place], chr(10))))
    SELECT doc_id, line::INTEGER AS line, license FROM units JOIN digests USING (digest)
    """
