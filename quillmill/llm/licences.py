"""Licence scan by canonical digests.

A text is normalised (case, copyright lines, punctuation, equivalent spellings) and its digest is joined to those of
known licences: a hit means that the whole text is that licence. Lines are looked up in the same way among known
notices. Built-in Spark expressions only.
"""

from __future__ import annotations

import hashlib
import re
import textwrap
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that count as equal, applied in this order to normalised text.
SPELLINGS = (
    ("licence", "license"),
    ("licenc", "licens"),
    ("sub license", "sublicense"),
    ("copyright owner", "copyright holder"),
    ("organisation", "organization"),
    ("authoris", "authoriz"),
    ("recognis", "recogniz"),
    ("utilis", "utiliz"),
    ("favour", "favor"),
    ("behaviour", "behavior"),
    ("wilful", "willful"),
    ("programme", "program"),
    ("merchantibility", "merchantability"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"),
)
#: What makes a copyright notice: the word or sign with a sign, a year or its blank, or a name; "copyright holders be liable" is none.
_MARK = r"(?:(?i:copyright|\(c\)|©)[ \t,:]*(?i:\(c\)|©|[0-9]{4}|<year>|\[?yyyy|\[year|\{yyyy)|(?:Copyright|©)[ \t]+[A-Z][a-z])"
#: What licences go on with after a notice.
_BEGINS = r"[ \t\r\n]+(?i:permission[ \t\r\n]+(?:is|to)|redistribution[ \t\r\n]+and|licensed[ \t\r\n]+under|everyone[ \t\r\n]+is|this[ \t\r\n]+(?:program|library|software|work|is[ \t\r\n]+free)|version[ \t\r\n]+[0-9])"
#: A notice at the start of a line goes up to the line's end or to what follows it in the line; elsewhere, as in texts on one line, up to what follows.
COPYRIGHT_LINE = rf"(?m)^[ \t/*#;]*{_MARK}[^\n]*?({_BEGINS}|$)"
COPYRIGHT_PART = rf"{_MARK}[^\n]*?({_BEGINS})"
RIGHTS = r"(?i:all[ \t\r\n]+rights[ \t\r\n]+reserved)"
SIGNS = r"[^\p{L}\p{N}]+"

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
{0}Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
{1}Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
{2}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_THIRD = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
"""
_ISC = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
"""
_FREE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""
#: Texts of licences, some with and without their titles or the numbers of their clauses.
TEXTS = (
    ("MIT", _MIT + _WARRANTY),
    ("MIT", "MIT License\n" + _MIT + _WARRANTY),
    ("MIT", "The MIT License (MIT)\n" + _MIT + _WARRANTY),
    ("BSD-2-Clause", _BSD.format("", "", "")),
    ("BSD-2-Clause", _BSD.format("1. ", "2. ", "")),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD.format("1. ", "2. ", "")),
    ("BSD-3-Clause", _BSD.format("", "", _THIRD)),
    ("BSD-3-Clause", _BSD.format("1. ", "2. ", "3. " + _THIRD)),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD.format("1. ", "2. ", "3. " + _THIRD)),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC),
    ("ISC", "ISC License\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + _ISC),
    ("Unlicense", _FREE),
)
#: Digests of the canonical forms of published texts that are too long to stand here; each with and without what follows its terms.
DIGESTS = {
    "04e64e0427d80fdde16fa8415931bf2c09bc943f13ec322a09df188bf23a3543": "Apache-2.0",
    "119e2da0e9ec849d113a40405b338c1bbbd2ef9194c22bf2740fa4e195411c40": "Apache-2.0",
    "824065d72ca31b7c727341396be4cf76f464b15d9bef680a3638007ce92a009f": "Apache-2.0",
    "e95eb1718f9f373d56cc586a5f7d1bfa11668867f6e85e982d2b6108b97d90a1": "GPL-2.0",
    "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34": "GPL-2.0",
    "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808": "GPL-2.0",
    "8cfa3790af0cca9aa1e7767268f618987259ccb687e61675ca833dc126f4fc76": "GPL-3.0",
    "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636": "GPL-3.0",
    "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191": "GPL-3.0",
    "d3826e4e563a04a354453ff139a32b19d6c3fe283f518eb566107c54e18cd01f": "LGPL-2.1",
    "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4": "LGPL-2.1",
    "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df": "LGPL-2.1",
    "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be": "LGPL-3.0",
    "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d": "MPL-2.0",
    "075fcdf87448c49dbad8c5f7963f0eb6907a3d8eae1b431ba2988508499ec0de": "MPL-2.0",
    "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e": "CC0-1.0",
}
#: One-line notices.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
)


def canonical(text: Column) -> Column:
    """The normalised text; null as empty."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), COPYRIGHT_LINE, " $1")
    out = F.regexp_replace(F.regexp_replace(out, COPYRIGHT_PART, " $1"), RIGHTS, " ")
    out = F.trim(F.regexp_replace(F.lower(out), SIGNS, " "))
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def canonical_text(text: str) -> str:
    """canonical() for the few known texts."""
    out = re.sub(COPYRIGHT_PART, r" \1", re.sub(COPYRIGHT_LINE, r" \1", text))
    out = re.sub(r"[\W_]+", " ", re.sub(RIGHTS, " ", out).lower()).strip()
    for a, b in SPELLINGS:
        out = out.replace(a, b)
    return out


def digests(known: Iterable[tuple[str, str]]) -> dict[str, str]:
    return {hashlib.sha256(canonical_text(x).encode()).hexdigest(): name for name, x in known}


def variants() -> list[tuple[int, str, str]]:
    """(id, text, name): the known texts as they are published, wrapped in several ways, with notices and other spellings."""
    notices = ("", "Copyright (c) 2019-2024 Jane Doe <jane@site.org>. All rights reserved.", "© 2021 Some Company, Inc.", "Copyright The Project Authors")
    made = []
    for name, x in TEXTS:
        for k, width in enumerate((40, 60, 79, 10**6)):
            title, _, rest = x.partition("\n")
            title, rest = (title, rest) if len(title) < 30 else ("", x)
            body = textwrap.fill(" ".join(rest.split()), width)
            parts = [title, notices[k], body]
            made.append((name, "\n\n".join(p for p in parts if p)))
            if width > 79 and notices[1]:  # all on one line
                made.append((name, " ".join(p for p in (title, notices[1], body) if p)))
        made.append((name, x.upper().replace("LICENSE", "LICENCE").replace(",", " ,")))
        made.append(("", x + "\nAnd one more condition."))
    return [(k, x, name) for k, (name, x) in enumerate(made)]


def scan(docs: DataFrame, texts: tuple[tuple[str, str], ...] = TEXTS, notices: tuple[tuple[str, str], ...] = NOTICES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest, licence (null if the whole text is none that is known), notices for each row of docs.

    notices: the names found in lines, each once, sorted and comma-joined. Null texts are empty and have the digest of
    nothing. Texts are read whole, however long; a licence inside a longer text is none. An empty table gives no rows. The known tables are fixed lists in this file or from the caller, so they are broadcast and written into
    the plan. Repeated rows get equal results; other columns of docs aren't read.
    """
    spark = docs.sparkSession
    known = spark.createDataFrame(sorted((DIGESTS | digests(texts)).items()), "known string, licence string")
    lines = F.filter(F.split(F.coalesce(F.col("_text"), F.lit("")), "\n"), lambda x: F.lower(x).contains("licen") | F.lower(x).contains("public domain"))
    table = F.create_map(*[F.lit(x) for pair in sorted(digests(notices).items()) for x in pair])
    names = F.transform(lines, lambda x: F.try_element_at(table, F.sha2(canonical(x), 256)))
    found = F.array_join(F.array_sort(F.array_distinct(F.filter(names, lambda x: x.isNotNull()))), ",")
    some = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("_text"))
    marked = some.select("doc_id", F.sha2(canonical(F.col("_text")), 256).alias("digest"), found.alias("notices"))
    return marked.join(F.broadcast(known), F.col("digest") == F.col("known"), "left").select("doc_id", "digest", "licence", "notices")


def scan_sql(documents: str = "documents", wanted: str = "") -> str:
    """scan() of documents in DuckDB's SQL; wanted: further columns of theirs."""

    def norm(x: str) -> str:
        out = f"regexp_replace(regexp_replace(coalesce({x}, ''), '{COPYRIGHT_LINE}', ' \\1', 'g'), '{COPYRIGHT_PART}', ' \\1', 'g')"
        out = f"trim(regexp_replace(lower(regexp_replace({out}, '{RIGHTS}', ' ', 'g')), '{SIGNS}', ' ', 'g'))"
        for a, b in SPELLINGS:
            out = f"replace({out}, '{a}', '{b}')"
        return out

    rows = lambda known: ", ".join(f"('{a}', '{b}')" for a, b in sorted(known.items()))
    return f"""
WITH known(known, licence) AS (VALUES {rows(DIGESTS | digests(TEXTS))}), notice(known, name) AS (VALUES {rows(digests(NOTICES))}),
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM {documents}),
hits AS (SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS notices FROM lines JOIN notice ON sha256({norm("line")}) = notice.known
  WHERE contains(lower(line), 'licen') OR contains(lower(line), 'public domain') GROUP BY doc_id)
SELECT d.doc_id, d.digest, k.licence, coalesce(h.notices, '') AS notices{wanted}
FROM (SELECT *, sha256({norm("text")}) AS digest FROM {documents}) d LEFT JOIN known k ON d.digest = k.known LEFT JOIN hits h ON d.doc_id = h.doc_id"""



def scanned_variants(spark: SparkSession) -> DataFrame:
    """scan() of variants(), with the name that each should have; empty for none."""
    texts = spark.createDataFrame(variants(), "doc_id int, text string, wanted string")
    return scan(texts).join(texts.select("doc_id", "wanted"), "doc_id")


def variants_sql() -> str:
    rows = ", ".join("({}, '{}', '{}')".format(k, x.replace("'", "''"), name) for k, x, name in variants())
    return scan_sql(f"(SELECT * FROM (VALUES {rows}) v(doc_id, text, wanted))", ", d.wanted")
