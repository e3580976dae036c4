"""Licence scan by canonical digests.

A text is brought to a canonical form (lower case, equivalent spellings as
one, punctuation as blanks, copyright lines left out) and its SHA-256 is
joined with the digests of known licence texts. This is done for the whole
document and for each of its lines, since a notice is often a line of its
own. A line that begins with "copyright" is left out when a sign or a year
follows, so the form does not depend on where a text is wrapped; a notice
without either ("Copyright Some Body") is known by its place at the head of a
paragraph, and a document that has one, or that begins with a title ("MIT
License"), is compared a second time without these.
Only digests are joined, and the known ones are broadcast up to
``BROADCAST_ROWS``; a larger table of known texts joins by shuffle.

Built-in functions only, no Python runs on the executors.

Defined results: null or empty text has the empty canonical form, which
matches nothing. A known text given twice under several ids yields the least
id. Repeated rows get equal results; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmart.llm.common import stored, text_column
from signalmart.sources.raw import local_table

#: About 0.2 kB each: 20 MB at most.
BROADCAST_ROWS = 100_000
#: With more different lengths of known texts, lines are not sorted out by theirs.
LENGTHS = 500

#: FIXED VALUES: equivalent spellings, each with the one that stands for it.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"),
    ("analys", "analyz"),
    ("authoris", "authoriz"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("favour", "favor"),
    ("fulfilment", "fulfillment"),
    ("initialis", "initializ"),
    ("judgement", "judgment"),
    ("labour", "labor"),
    ("licence", "license"),
    ("merchantibility", "merchantability"),
    ("non-commercial", "noncommercial"),
    ("offence", "offense"),
    ("organis", "organiz"),
    ("programme", "program"),
    ("recognis", "recogniz"),
    ("sub-license", "sublicense"),
    ("utilis", "utiliz"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("http://", "https://"),
    ("&", "and"),
    ("per cent", "percent"),
    ("copyright holder", "copyright owner"),
]

#: FIXED VALUES: public licence texts and the notices that stand for one.
KNOWN = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("BSL-1.0", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software
and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute,
and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the
Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and
the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of
the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by
a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE
COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as
a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all
present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>"""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
]

#: FIXED VALUE: what a copyright line begins with in canonical form.
COPYRIGHT_LINE = r"^(copyright|c copyright|c [0-9]{4}|all rights reserved$)"
#: What such a line goes on with if it is a notice wherever it stands. Others
#: ("copyright notice and this permission ...") may be a wrapped text's words.
NOTICE = r"^(copyright c( |$)|(c )?copyright [0-9]{4}|c [0-9]{4}|all rights reserved$)"
#: Copyright lines at the head of a paragraph.
HEAD = r"^(?:(?:copyright|c copyright|c [0-9]{4})[^\n]*(?:\n|$)|all rights reserved(?:\n|$))+"
#: Lines at the head of a document that name its licence, with version and address.
TITLES = (r"^(?:\n*(?:(?:the )?[a-z0-9 ]{0,40}license[a-z0-9 ]{0,40}|version [0-9][a-z0-9 ]{0,40}"
          r"|https www [a-z0-9 ]{0,60})(?:\n|$))+")


def _plain_lines(text: Column) -> Column:
    out = F.lower(text)
    for spelling, same in SPELLINGS:
        out = F.replace(out, F.lit(spelling), F.lit(same))
    out = F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " ")
    return F.transform(F.split(out, "\n"), lambda x: F.trim(x))


def _body(lines: Column) -> Column:
    return F.filter(lines, lambda x: (x != "") & ~(x.rlike(COPYRIGHT_LINE) & x.rlike(NOTICE)))


def _headless(lines: Column) -> Column:
    """The body of plain lines, also without titles at the head of the document
    and the lines at the head of a paragraph that begin like a copyright line;
    null if the text has none of these."""
    whole = F.array_join(lines, "\n")
    parts = F.transform(F.split(F.regexp_replace(whole, TITLES, ""), "\n\n+"),
                        lambda x: F.regexp_replace(F.ltrim(x, F.lit("\n")), HEAD, ""))
    odd = F.exists(lines, lambda x: x.rlike(COPYRIGHT_LINE) & ~x.rlike(NOTICE)) | whole.rlike(TITLES)
    return F.when(odd, _body(F.split(F.array_join(parts, "\n"), "\n")))


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _joined(lines: Column) -> Column:
    """The lines as one text; spellings of two words are brought to one form
    here too, since a line may have ended within one."""
    out = F.array_join(lines, " ")
    for spelling, same in SPELLINGS:
        words = spelling.replace("-", " ")
        if " " in words:
            out = F.replace(out, F.lit(words), F.lit(same))
    return out


def _with_lines(df: DataFrame, text: Column, **columns: Column) -> DataFrame:
    """``columns``, ``lines`` (in canonical form, without empty ones and
    copyright lines) and ``headless``; a text is cut into lines once."""
    plain = df.select(*[c.alias(n) for n, c in columns.items()], _plain_lines(text).alias("plain"))
    return plain.select(*columns, _body(F.col("plain")).alias("lines"), _headless(F.col("plain")).alias("headless"))


def known_digests(known: DataFrame, text: str = "text", license_id: str = "license_id",
                  headless: bool = False) -> DataFrame:
    """(digest, license, length) of a table of known texts."""
    rows = _with_lines(known, text_column(known, text), license=known[license_id].cast("string"))
    lines = F.coalesce("headless", "lines") if headless else F.col("lines")
    return (rows.select(_joined(lines).alias("canonical"), "license")
            .filter("canonical <> ''").groupBy(_digest(F.col("canonical")).alias("digest"))
            .agg(F.min("license").alias("license"), F.first(F.length("canonical")).alias("length")))


def default_known(spark: SparkSession) -> DataFrame:
    return local_table(spark, KNOWN, "license_id string, text string")


def read_known(spark: SparkSession, folder: str) -> DataFrame:
    """(license_id, text) of the licence texts in a folder, one per file that
    is named for its licence (a suffix like .txt is no part of the name)."""
    files = spark.read.text(folder, wholetext=True).select("value", F.col("_metadata.file_name").alias("name"))
    return files.select(F.regexp_replace("name", r"\.(txt|md)$", "").alias("license_id"), F.col("value").alias("text"))


def scan(df: DataFrame, known: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per input row: struct ``row`` of the columns ``carry`` (all),
    ``digest`` (of the whole canonical text), ``license`` (the known text it
    equals, or null) and ``notices`` (ids of the lines that are known, sorted,
    each once)."""
    names = known_digests(known)
    sizes = [r["length"] for r in names.select("length").distinct().limit(LENGTHS + 1).collect()]
    small = names.count() <= BROADCAST_ROWS
    bare = known_digests(known, headless=True).select(F.col("digest").alias("bare"), F.col("license").alias("bare_license"))
    names = names.drop("length")
    test, bare = (F.broadcast(names), F.broadcast(bare)) if small else (names, bare)
    whole = text_column(df, text)
    rows = _with_lines(df, whole, row=F.struct(*[df[c] for c in carry or df.columns]), key=F.unhex(_digest(whole)))
    # a line of another length than every known text is none of them
    like = F.col("lines") if len(sizes) > LENGTHS else F.filter(
        "lines", lambda x: F.length(x).isin(sizes) if sizes else F.lit(False))
    digest = _digest(_joined(F.col("lines")))
    # each text is looked at once: both searches read what is written here
    docs = stored(rows.select("row", "key", digest.alias("digest"), _digest(_joined(F.col("headless"))).alias("bare"),
                              F.array_distinct(like).alias("maybe")), "canonical")
    docs = docs.withColumn("bare", F.coalesce("bare", "digest"))
    found = (docs.select("key", F.explode("maybe").alias("line")).distinct()
             .select("key", _digest(F.col("line")).alias("digest")).join(test, "digest")
             .groupBy("key").agg(F.array_sort(F.collect_set("license")).alias("notices")))
    return (docs.drop("maybe").join(test, "digest", "left").join(bare, "bare", "left").join(found, "key", "left")
            .select("row", "digest", F.coalesce("license", "bare_license").alias("license"),
                    F.coalesce("notices", F.array().cast("array<string>")).alias("notices")))
