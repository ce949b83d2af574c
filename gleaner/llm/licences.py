"""Licence scan by canonical digests, with DataFrame functions only.

A text is brought to a canonical form and its SHA-256 digest is joined to the digests of known licence texts, so
a text is found when the whole of it says the same as a known one. The canonical form, line by line: lower case,
copyright notices dropped, punctuation and white space as one space, equivalent spellings as one. A unit of text is
whatever row is handed in: a whole document, or a line of it for one-line notices.

Defined results: null and empty texts have the digest of the empty text, which is never a known one; repeated rows
are looked up alike; if two known texts share a digest, the smaller licence id counts; an empty table gives no row;
other columns stay as they are. Rows with one digest may be a third of the table: a small table of known texts is
broadcast by its size, a large one takes a join whose skewed partitions Spark splits.
"""

from __future__ import annotations

from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What may stand before a notice on its line: the mark of a comment.
_MARK = "^[ \\t]*(?:[#*/;%!-]{1,3}[ \\t]*|dnl[ \\t]+)?"
_YEAR = "\\b(?:19|20)[0-9]{2}\\b"
#: Copyright notices: those of the publishers and the blanks to fill in, wherever lines break; lines with the word and a sign or a
#: blank, or a year after four words at most; lines with a sign and a year or a short name; and all rights reserved alone. Neither a line of a
#: licence's own words that begins with ``copyright`` nor a list item ``(c)`` is one. Java and RE2 read the pattern alike.
NOTICE = (
    f"(?m)(?:{_MARK})?copyright\\s+\\(c\\)\\s+[0-9, -]+\\s+free\\s+software\\s+foundation,?\\s+inc\\.?(?:\\s*<[^>]*>)?"
    f"|(?:{_MARK})?copyright\\s+(?:(?:\\(c\\)|©)\\s+)?[<\\[{{](?:year|yyyy)[>\\]}}]\\s+[<\\[{{]name\\s+of\\s+(?:author|copyright\\s+owner)[>\\]}}]"
    f"|(?:{_MARK})?copyright\\s+\\(c\\)\\s+year\\s+name\\s+of\\s+author"
    f"|{_MARK}(?:portions[ \\t]+)?copyright\\b(?:[^\\n]*?(?:\\(c\\)|©|[<\\[{{(](?:year|yyyy)\\b)|(?:[ \\t,:]+[^\\s]+){{0,4}}?[ \\t,:]+{_YEAR})[^\\n]*$"
    f"|{_MARK}copyright[ \\t:]*(?:year|yyyy)\\b[^\\n]*$|{_MARK}©[^\\n]*$"
    f"|{_MARK}\\(c\\)[ \\t]*(?:[^\\n]{{0,40}}?{_YEAR}[^\\n]*|[^\\s,;:]+(?:[ \\t]+[^\\s,;:]+){{0,3}}[ \\t\\r]*)$"
    f"|{_MARK}all rights reserved[ \\t.\\r]*$"
)
#: Spellings that licence matching treats as one (left becomes right).
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "catalogue": "catalog", "categorise": "categorize", "centre": "center", "emphasised": "emphasized",
    "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "fulfilment": "fulfillment",
    "https": "http", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling",
    "labour": "labor", "licence": "license", "licenced": "licensed", "licences": "licenses", "maximise": "maximize", "modelled": "modeled",
    "modelling": "modeling", "offence": "offense", "optimise": "optimize", "organisation": "organization",
    "organise": "organize", "practise": "practice", "programme": "program", "realise": "realize",
    "recognise": "recognize", "signalling": "signaling", "sublicence": "sublicense", "utilisation": "utilization",
    "whilst": "while", "wilful": "willful",
}
NO_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE."
)
ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
#: Texts of short public licences.
TEXTS = {
    "MIT": (
        "MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.\n" + NO_WARRANTY
    ),
    "ISC": (
        "ISC License\n" + ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all "
        "copies.\n" + ISC_WARRANTY
    ),
    "0BSD": "BSD Zero Clause License\n" + ISC_GRANT + ".\n" + ISC_WARRANTY,
    "Zlib": (
        'zlib License\nThis software is provided "as-is", without any express or implied warranty. In no event will the '
        "authors be held liable for any damages arising from the use of this software.\nPermission is granted to anyone to "
        "use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
        "subject to the following restrictions:\n1. The origin of this software must not be misrepresented; you must not "
        "claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product "
        "documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, "
        "and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from "
        "any source distribution."
    ),
    "WTFPL": (
        "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\nTERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION\n"
        "0. You just DO WHAT THE FUCK YOU WANT TO."
    ),
}
BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met:\n{}Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.\n{}Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution.\n"
)
BSD_NAMES = (
    "{}Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission.\n"
)
BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
    "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
#: How short licences are headed; each is also known without a title.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "BSD Zero Clause License (0BSD)"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "Modified BSD License"],
}
WTFPL = (
    "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\nVersion 2, December 2004\n\nEveryone is permitted to copy and distribute verbatim or "
    "modified copies of this license document, and changing it is allowed as long as the name is changed.\n\nDO WHAT THE FUCK YOU WANT "
    "TO PUBLIC LICENSE\nTERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION\n\n0. You just DO WHAT THE FUCK YOU WANT TO."
)
#: Whole texts of long licences, one file each in the folder ``texts`` of this package.
LONG = ["Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0"]
#: Long texts are also known up to here, without the part on how to apply them.
LAST_LINE = "END OF TERMS AND CONDITIONS"
#: How licences are named in one-line notices.
NAMES = {
    "MIT": ["MIT License", "the MIT License"],
    "ISC": ["the ISC License"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "Apache 2.0"],
    "BSD-2-Clause": ["the BSD 2-Clause License"],
    "BSD-3-Clause": ["the BSD 3-Clause License"],
    "GPL-2.0": ["the GNU General Public License, version 2", "the GNU GPL v2"],
    "GPL-3.0": ["the GNU General Public License, version 3", "the GNU GPL v3"],
    "LGPL-3.0": ["the GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["the GNU Affero General Public License, version 3"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0"],
    "CC0-1.0": ["CC0 1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0"],
}
SUBJECTS = ["", "This work is ", "This software is ", "This project is ", "This file is ", "This document is "]
VERBS = ["licensed under", "released under", "distributed under", "available under", "published under"]


def canonical(text: Column) -> Column:
    """The canonical form of a text."""
    # One search first: few texts hold a notice. A list of one binds the small letters.
    noticed = lambda low: F.when(low.rlike("copyright|©|\\(c\\)|all rights reserved"), F.regexp_replace(low, NOTICE, " ")).otherwise(low)
    lower = F.get(F.transform(F.array(F.lower(F.coalesce(text, F.lit("")))), noticed), F.lit(0))
    plain = F.trim(F.regexp_replace(lower, "[^\\p{L}\\p{N}]+", " "))

    def respelled(form: Column) -> Column:
        same = form
        for left, right in SPELLINGS.items():
            same = F.regexp_replace(same, f"\\b{left}\\b", right)
        # One search first: few texts hold any of these words.
        return F.when(form.rlike("\\b(?:" + "|".join(SPELLINGS) + ")\\b"), same).otherwise(form)

    # A list of one: the plain form is worked out once, not once for every place that names it.
    return F.get(F.transform(F.array(plain), respelled), F.lit(0))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_texts(spark: SparkSession) -> DataFrame:
    """(licence_id, text): the licence texts of ``TEXTS``, of ``LONG`` and the BSD ones, in all their forms."""
    return spark.createDataFrame(known_forms(), "licence_id string, text string")


def known_forms() -> list[tuple[str, str]]:
    """(licence id, text): the texts with each title and without one, and long ones with and without their appendix."""
    found = [*TEXTS.items(), ("WTFPL", WTFPL)]
    bodies = {name: text.split("\n", 1)[1] for name, text in TEXTS.items() if name in TITLES}
    untitled = [*bodies.items()]
    for marks in (("1. ", "2. ", "3. "), ("* ", "* ", "* ")):
        grant = BSD_GRANT.format(*marks[:2])
        untitled += [("BSD-2-Clause", grant + BSD_WARRANTY), ("BSD-3-Clause", grant + BSD_NAMES.format(marks[2]) + BSD_WARRANTY)]
    found += untitled + [(name, f"{title}\n{body}") for name, body in untitled for title in TITLES[name]]
    for name in LONG:
        text = long_text(name)
        found.append((name, text))
        if LAST_LINE in text:
            terms = text[: text.index(LAST_LINE)]
            found += [(name, terms), (name, terms + LAST_LINE)]
    return found


def long_text(name: str) -> str:
    """The text of a long licence, also out of a package that was shipped as a zip; one that is missing fails."""
    return files(__package__).joinpath("texts", f"{name}.txt").read_text(encoding="utf-8")


def known_notices(spark: SparkSession) -> DataFrame:
    """(licence_id, text): one-line notices made from ``SUBJECTS``, ``VERBS`` and ``NAMES``."""
    rows = [
        (licence, f"{subject}{verb} {name}")
        for licence, names in NAMES.items() for name in names for subject in SUBJECTS for verb in VERBS
    ]
    return spark.createDataFrame(rows, "licence_id string, text string")


def known_digests(known: DataFrame) -> DataFrame:
    found = known.select("licence_id", digest(F.col("text")).alias("digest"))
    return found.filter(F.col("digest") != F.sha2(F.lit(""), 256)).groupBy("digest").agg(F.min("licence_id").alias("licence_id"))


def scan(units: DataFrame, known: DataFrame, how: str = "left") -> DataFrame:
    """``units`` without ``text``, with ``digest`` and ``licence_id`` (null if the text is no known one)."""
    found = units.drop("digest", "licence_id").withColumn("digest", digest(F.col("text"))).drop("text")
    return found.join(known_digests(known), "digest", how)


def scan_documents(docs: DataFrame, known: DataFrame, notices: DataFrame) -> DataFrame:
    """(doc_id, digest, licence_id, notices): whole texts by ``known``, and the lines of each text by ``notices``."""
    whole = scan(docs.select("doc_id", "text"), known)
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("text"))
    noted = scan(lines, notices, "inner").groupBy("doc_id").agg(
        F.array_join(F.array_sort(F.collect_set("licence_id")), ",").alias("notices")
    )
    return whole.join(noted, "doc_id", "left")
