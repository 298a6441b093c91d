"""Licence scan by canonical digests, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.licence_digests import DIGESTS
from daybook.llm.tables import literal_rows

# Equivalent spellings, after punctuation has become spaces.
SPELLINGS = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("organisation", "organization"),
    ("authorisation", "authorization"),
    ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"),
    ("behaviour", "behavior"),
    ("favour", "favor"),
    ("artefact", "artifact"),
    ("catalogue", "catalog"),
    ("cancelled", "canceled"),
    ("whilst", "while"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("all rights reserved", ""),
)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Lines that name a holder: (c), the sign, or the word before a year or a placeholder; the word and a group or a firm.
COPYRIGHT_LINE = (
    r"(^|\n)[^a-z0-9\n(©]*(copyright[ \t]*(\(c\)|©|[0-9<{]|\[)|\(c\)[ \t]*[0-9]|©"
    r"|copyright[ \t]+(by[ \t]+)?the[ \t][^\n]*(authors|contributors|developers|team|project|foundation)\b"
    r"|copyright[ \t]+[^\n]*[ \t,](inc|ltd|llc|gmbh|corp|corporation)\b)[^\n]*"
)
#: A holder in the line of the text itself, up to the words with which a text begins.
COPYRIGHT_PART = (
    r"copyright[ \t]*(\(c\)|©|[0-9])[^\n]*?"
    r"(permission is hereby granted|permission to use|redistribution and use|this software is provided|licensed under|released under)"
)
PUNCTUATION = r"[\x00-\x2f\x3a-\x60\x7b-\x7f“”‘’–—…«»§·]+"

# Texts and notices of well-known licences.
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
    "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
    "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject "
    "to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial "
    "portions of the Software. " + _WARRANTY
)
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES '
    "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
    "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
    "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission. "
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
    "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
    "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this "
    "software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, "
    "an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly "
    "marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any "
    "source distribution."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
    "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
    "means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest "
    "in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs "
    "and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this "
    'software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
    "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
    "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to "
)
_BOOST = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
    'documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and '
    "to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the "
    "following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the "
    "following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, "
    "unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language "
    'processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR "
    "ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
    "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
LICENCES = (
    ("Unlicense", _UNLICENSE + "<https://unlicense.org>"),
    ("Unlicense", _UNLICENSE + "<http://unlicense.org/>"),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003 " + _BOOST),
    ("BSL-1.0", _BOOST),
    ("MIT", _MIT),
    ("MIT", "MIT License " + _MIT),
    ("MIT", "The MIT License (MIT) " + _MIT),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_END),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _ISC_END),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_END),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_NAMES + _BSD_END),
    ("Zlib", _ZLIB),
)
#: How licences are named in notices, by their short name.
NAMES = {
    "MIT": ("MIT License", "MIT"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License"),
    "ISC": ("ISC License",),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GPLv2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPLv3"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "LGPL 2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPLv3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPLv3"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0"),
    "EPL-2.0": ("Eclipse Public License 2.0",),
    "BSL-1.0": ("Boost Software License, Version 1.0",),
    "Unlicense": ("Unlicense",),
    "CC0-1.0": ("CC0 1.0 Universal License", "CC0 License"),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License", "CC BY 4.0"),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0"),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0"),
}
_SENTENCES = (
    "Licensed under the {}.", "Licensed under {}.", "Released under the {}.", "This work is licensed under the {}.", "This project is licensed under the {}.",
    "This software is licensed under the {}.", "Distributed under the {}.", 'Licensed under the {} (the "License");',
)
#: Short names that stand for themselves in an identifier line, also with their ending.
_ENDINGS = {"GPL-2.0": ("-only", "-or-later"), "GPL-3.0": ("-only", "-or-later"), "LGPL-2.1": ("-only", "-or-later"), "LGPL-3.0": ("-only", "-or-later"), "AGPL-3.0": ("-only", "-or-later")}
IDENTIFIERS = tuple((name, f"SPDX-License-Identifier: {name}{end}") for name in (*NAMES, "Zlib", "0BSD") for end in ("", *_ENDINGS.get(name, ())))
NOTICES = IDENTIFIERS + tuple((name, line.format(called)) for name, ways in NAMES.items() for called in ways for line in _SENTENCES) + (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
)


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, runs of punctuation and space as one space, one spelling; null stays null.

    Only A to Z are lowered, so that any engine agrees on the result.
    """
    x = F.translate(text, UPPER, UPPER.lower())
    x = F.regexp_replace(x, COPYRIGHT_PART, "$2")
    x = F.regexp_replace(x, COPYRIGHT_LINE, "\n")
    x = F.regexp_replace(x, PUNCTUATION, " ")
    for other, usual in SPELLINGS:
        x = F.replace(x, F.lit(other), F.lit(usual))
    return F.trim(F.regexp_replace(x, "  +", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_digests(spark: SparkSession, texts: tuple = LICENCES, digests: tuple = DIGESTS) -> DataFrame:
    """(digest, license) of (license, text) pairs, and of (license, digest) pairs of long texts; if two licences have one
    canonical text, the first name in order."""
    table = literal_rows(spark, ["license", "text"], [*texts]).select("license", digest(F.col("text")).alias("digest"))
    if digests:
        table = table.union(literal_rows(spark, ["license", "digest"], [*digests]))
    return table.groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, licences: DataFrame | None = None, notices: DataFrame | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, digest, license, notices``: the licence that a whole text is, and those that whole lines of it are notices of.

    Entire texts, and entire lines that hold "licen", are looked up by the digest of their canonical form. Every document is
    returned; ``license`` and ``notices`` (names in order, joined by commas) are null where nothing matches, ``digest`` is
    null for a null text only. The known tables (digest, license) are small; only documents with lines that may be notices
    are grouped, so copies without one make no hot group. Ids that repeat are told apart, identical rows give equal rows.
    """
    spark = docs.sparkSession
    # The fixed lists of this module are a few rows each; tables given by the caller are joined as Spark sees fit.
    licences = F.broadcast(known_digests(spark)) if licences is None else licences
    notices = F.broadcast(known_digests(spark, NOTICES, ())) if notices is None else notices
    text = F.col(text_column)
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        digest(text).alias("digest"),
        # every notice's canonical form has "license" in it, so other lines can't match
        F.filter(F.split(text, "\n"), lambda line: line.rlike("(?i)licen")).alias("lines"),
    )
    rows = rows.select("doc_id", "digest", F.transform("lines", lambda line: digest(line)).alias("lines"))
    found = rows.join(licences, "digest", "left")
    # identical rows are counted, so that each comes back
    some = found.where(F.size("lines") > 0).groupBy("doc_id", "digest", "license", "lines").agg(F.count("*").alias("rows"))
    hits = some.withColumn("line", F.explode("lines"))
    named = hits.join(notices.withColumnsRenamed({"digest": "line", "license": "notice"}), "line", "left")
    grouped = named.groupBy("doc_id", "digest", "license", "lines", "rows").agg(F.sort_array(F.collect_set("notice")).alias("names"))
    listed = grouped.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows")))).select(
        "doc_id", "digest", "license", F.when(F.size("names") > 0, F.array_join("names", ",")).alias("notices")
    )
    return listed.union(found.where("lines IS NULL OR size(lines) = 0").select("doc_id", "digest", "license", F.lit(None).cast("string")))
