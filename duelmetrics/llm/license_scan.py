"""Licence texts and notices: windows of a text compared with templates by the Dice coefficient over word bigrams.

Text becomes its words of letters and digits, so line breaks, comment marks and punctuation don't
matter. Each template has an anchor, a telling word of it. Wherever a text has that word, the
window of the template's size that puts the word where the template has it (first or last) is
compared with the template; so a notice is found in any surroundings. With coefficient
2 * common / (a + b) >= t the sizes obey t / (2 - t) <= a / b <= (2 - t) / t, and windows cut short by
the text's ends beyond that are never built.

Only DataFrame functions are used. Rows keep their place from the scan to the result: only each
row's best coefficients are shuffled, no text and no words.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words that may anchor a template, the most telling first; a template takes the first that it has.
ANCHORS = ("spdx", "unencumbered", "redistributions", "redistribution", "redistribute", "permission", "dedicated", "copying", "verbatim",
           "accompanying", "warranty", "subject", "licensed", "license", "unlicense", "licenses", "cc0", "cc")

_GPL_HEADER = ("This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {which}General Public License as "
               "published by the Free Software Foundation, either version {n} of the License, or (at your option) any later version.")
_GPL2_HEADER = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.")
_GPL_OPENING = ("Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: ")
_MIT_KEEP = ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. ")
_MIT_WARRANTY = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
                 "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
                 "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
                 "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies. ")
_ISC_WARRANTY = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES "
                 "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
                 "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
                 "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. ")
_BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
              "software without specific prior written permission. ")
_BSD_WARRANTY = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
                 "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
                 "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
                 "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
                 "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
                 "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSL = ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation "
        "covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative "
        "works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: ")
_UNLICENSE = ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
              "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.")
_ZLIB = ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising "
         "from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
         "alter it and redistribute it freely, subject to the following restrictions:")
_APACHE_HEADER = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. ")
_APACHE_REST = ("You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either "
                "express or implied. See the License for the specific language governing permissions and limitations under the License.")
_MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."

#: Texts, notices, titles and tags by licence.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", _APACHE_HEADER), ("Apache-2.0", _APACHE_HEADER + _APACHE_REST),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Apache License, Version 2.0"),
    ("MIT", _MIT + _MIT_KEEP + _MIT_WARRANTY), ("MIT", _MIT), ("MIT", "Released under the MIT License."), ("MIT", "The MIT License (MIT)"),
    ("MIT", "This project is licensed under the MIT License."), ("MIT", "MIT License"),
    ("ISC", _ISC + _ISC_WARRANTY), ("ISC", _ISC), ("ISC", "ISC License"),
    ("BSD-2-Clause", _BSD + _BSD_WARRANTY), ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", _BSD + _BSD_NAMES + _BSD_WARRANTY), ("BSD-3-Clause", "BSD 3-Clause License"), ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc."),
    ("GPL-2.0", _GPL2_HEADER), ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. " + _GPL_OPENING),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"), ("GPL-3.0", _GPL_HEADER.format(what="program", which="", n=3)),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0", "GNU General Public License, version 3"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", _GPL_HEADER.format(what="library", which="Lesser ", n="2.1")),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"), ("LGPL-3.0", _GPL_HEADER.format(what="library", which="Lesser ", n=3)),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"), ("AGPL-3.0", _GPL_HEADER.format(what="program", which="Affero ", n=3)),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"), ("MPL-2.0", _MPL),
    ("MPL-2.0", _MPL + " If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"), ("BSL-1.0", _BSL),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"),
    ("Unlicense", _UNLICENSE), ("Unlicense", "Released under the Unlicense."), ("Zlib", _ZLIB), ("Zlib", "zlib License"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."), ("CC0-1.0", "CC0 1.0 Universal"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
) + tuple((name, f"SPDX-License-Identifier: {name}") for name in (
    "Apache-2.0", "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "EPL-2.0", "BSL-1.0",
    "Unlicense", "Zlib", "CC0-1.0", "CC-BY-4.0"))


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.translate(str.maketrans(_UPPER, _LOWER)))


def bigrams(text: str) -> set[str]:
    words = words_of(text)
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def anchored(templates: tuple[tuple[str, str], ...]) -> list[tuple[int, str, str, int, int]]:
    """(template, license, anchor, words before the anchor, words): where windows of each template begin.

    The anchor's first and last place in the template count.
    """
    out = []
    for k, (name, text) in enumerate(templates):
        words = words_of(text)
        anchor = next((a for a in ANCHORS if a in words), None)
        if anchor is None:
            raise ValueError(f"no anchor word in: {text}")
        places = [n for n, w in enumerate(words) if w == anchor]
        out += [(k, name, anchor, n, len(words)) for n in sorted({places[0], places[-1]})]
    return out


def _text(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, license, dice, licenses), one row per row of ``docs``.

    license is the one with the highest coefficient (the first by name of several), licenses
    lists all by name. Null and empty texts and those that match nothing have null, null and an
    empty list. Rows that repeat get the same answer; other columns are ignored.
    """
    spark = docs.sparkSession
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    starts = anchored(templates)
    known = spark.createDataFrame([(k, name, anchor, before, size, len(bigrams(templates[k][1])), sorted(bigrams(templates[k][1])))
                                   for k, name, anchor, before, size in starts],
                                  "template int, license string, anchor string, before int, size int, b int, known array<string>")
    anchors = sorted({anchor for _, _, anchor, _, _ in starts})
    most_before, most_after = max(n for *_, n, _ in starts), max(size - n for *_, n, size in starts)

    # Whether a text has an anchor at all is told before anything is split.
    has = _text(text).rlike(f"(?<![A-Za-z0-9])(?i:{'|'.join(anchors)})(?![A-Za-z0-9])")
    plain = F.trim(F.regexp_replace(F.translate(_text(text), _UPPER, _LOWER), "[^a-z0-9]+", " "))
    none = F.array().cast("array<string>")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.when(has, F.split(plain, " ")).otherwise(none).alias("words")) \
        .withColumn("row", F.monotonically_increasing_id())
    # Of each anchor's place only as many words around it as the templates take.
    at = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("i"))), lambda p: p["word"].isin(anchors))
    around = F.transform(at, lambda p: F.struct(
        p["word"].alias("anchor"), F.least(p["i"], F.lit(most_before)).alias("at"),
        F.slice("words", F.greatest(p["i"] - most_before, F.lit(0)) + 1, F.least(p["i"], F.lit(most_before)) + most_after).alias("near")))
    places = rows.select("row", "doc_id", F.explode_outer(F.array_distinct(around)).alias("p")).select("row", "doc_id", "p.anchor", "p.at", "p.near")

    # 1 for the first word of the window; a window that begins or ends beyond the text is cut short.
    first = F.greatest(F.col("at") - F.col("before"), F.lit(0))
    last = F.least(F.col("at") - F.col("before") + F.col("size"), F.size("near"))
    windows = places.join(F.broadcast(known), "anchor", "left")
    windows = windows.withColumn("window", F.when(last - first - 1 >= F.col("b") * low, F.slice("near", first + 1, last - first)))
    pairs = F.zip_with(F.slice("window", F.lit(1), F.size("window") - 1), F.slice("window", F.lit(2), F.size("window")), lambda a, b: F.concat_ws(" ", a, b))
    windows = windows.withColumn("pairs", F.when(F.size("window") > 1, F.array_distinct(pairs))).withColumn("a", F.size("pairs"))
    fits = (F.col("a") >= F.col("b") * low) & (F.col("a") <= F.col("b") * high)
    dice = F.when(fits, 2 * F.size(F.array_intersect("pairs", "known")) / (F.col("a") + F.col("b")))
    reached = windows.select("row", "doc_id", "license", dice.alias("dice"))
    # Each row once per licence, below the threshold without one, so that no row is lost.
    ok = F.col("dice") >= threshold
    best = reached.select("row", "doc_id", F.when(ok, F.col("license")).alias("license"), F.when(ok, F.col("dice")).alias("dice")) \
        .groupBy("row", "doc_id", "license").agg(F.max("dice").alias("dice"))
    found = best.groupBy("row", "doc_id").agg(
        F.min(F.when(F.col("license").isNotNull(), F.struct((-F.col("dice")).alias("less"), "license"))).alias("best"),
        F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"))
    return found.select("doc_id", F.col("best.license").alias("license"), (-F.col("best.less")).alias("dice"), "licenses")
