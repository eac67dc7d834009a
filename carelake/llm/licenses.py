"""Licence scan by canonical digests: normalise a text, digest it, look the digest up.

Method
    A text is lower-cased, lines that name a copyright holder are dropped, equivalent spellings are made one
    (licence/license and so on), and everything but letters and digits becomes one space. The MD5 of the
    result is hash-joined with the digests of known licences. Entire texts are compared: the
    document as a whole (without its holder lines, and with them as they may be words of the licence itself),
    and each of its lines and paragraphs as a text of its own (notices stand on one line or are a paragraph;
    lines without a letter or digit, as in comments, part paragraphs).

Known
    ``KNOWN`` (one-line notices, MIT, ISC, 0BSD), which the SQL shares, and ``more_known()``: the full texts in
    ``license_texts`` with and without what follows their terms, BSD-2-Clause and BSD-3-Clause, each short text
    also under its title, and the usual paragraphs and SPDX lines of source files.

Scale
    DataFrame functions only, one pass over the texts. Known licences are a table of fixed rows
    (its row count is checked against ``MOST_KNOWN`` before it is broadcast); lines without a match end
    in the join, and only digests of matches and ids reach the shuffle.

Defined results
    One row per document: null, empty and unknown texts have null ``license`` and no notices. A text that
    normalises to nothing matches nothing. Each row has a row of its own, whether its id is null or
    another row has it too. Other columns are not read, whatever their names are.
"""

from __future__ import annotations

from itertools import product
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import base

MOST_KNOWN = 20_000
#: Equivalent spellings, applied in this order to lower-case words (fixed values).
SPELLINGS = [
    ("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("favour", "favor"),
    ("organisation", "organization"), ("merchantibility", "merchantability"), ("per cent", "percent"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"),
    ("non commercial", "noncommercial"), ("sub license", "sublicense"), ("v2", "version 2"), ("v3", "version 3"),
]
#: Known licences and notices by SPDX id (public texts, fixed values).
KNOWN: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
]
#: Full texts by SPDX id, one file each, as their publishers give them.
TEXTS = Path(__file__).parent / "license_texts"
#: The line after which a full text only says how to apply it.
END_OF_TERMS = "END OF TERMS AND CONDITIONS"
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "License: MIT"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "BSD Zero Clause License (0BSD)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License',
                     "BSD License", "The BSD License", "New BSD License", "Revised BSD License"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}
#: BSD texts: the clauses' numbers (or none, as with bullets), the names in them, and the parties of the disclaimer.
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

{0} Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

{1} Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_THIRD = """
{0} Neither the name of {1} nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission.
"""
BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE {0} AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE {1} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""
BSD_NUMBERS = [("1.", "2.", "3."), ("a.", "b.", "c."), ("*", "*", "*")]
BSD_NAMES = ["the copyright holder", "the copyright holders", "the University", "the organization", "the <organization>",
             "the author", "the names of the copyright holders"]
BSD_PARTIES = [("COPYRIGHT HOLDERS", "COPYRIGHT OWNER"), ("COPYRIGHT HOLDERS", "COPYRIGHT HOLDERS"),
               ("COPYRIGHT HOLDER", "COPYRIGHT HOLDER"), ("REGENTS", "REGENTS"), ("AUTHOR", "AUTHOR"), ("AUTHORS", "AUTHORS")]
#: Paragraphs of source files: the GNU licences' by id, name and version.
GNU = [("GPL-2.0", "GNU General Public License", "2"), ("GPL-3.0", "GNU General Public License", "3"),
       ("LGPL-2.0", "GNU Library General Public License", "2"), ("LGPL-2.1", "GNU Lesser General Public License", "2.1"),
       ("LGPL-3.0", "GNU Lesser General Public License", "3"), ("AGPL-3.0", "GNU Affero General Public License", "3")]
GNU_NOTICE = "This {0} is free software; you can redistribute it and/or modify it under the terms of the {1} as published by the Free Software Foundation{2}"
NOTICES: list[tuple[str, str]] = [
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License. You may obtain a copy of the License at"),
    *[("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
                     f"with the License. You may obtain a copy of the License at {http}://www.apache.org/licenses/LICENSE-2.0")
      for http in ("http", "https")],
    *[("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                  f"distributed with this file, You can obtain one at {http}://mozilla.org/MPL/2.0/.") for http in ("http", "https")],
    *[(x, f"SPDX-License-Identifier: {x}") for x in (
        "0BSD", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0",
        "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1", "LGPL-2.1-only",
        "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "Unlicense")],
]
#: A line of lower-case text that names a copyright holder: the word with (c), the sign, a year, a place for one, or by;
#: the sign or (c) before a year; the word or (c) and a few words that licences don't go on with there.
HOLDER_LINE = (r"(?m)^[^\p{L}\n]*(copyright[ \t:,]*(\(c\)|©|by\b|[^\p{L}\n]*\d{4}|[\[{<])|©|\(c\)[^\p{L}\n]*(\d{4}|[\[{<]|copyright\b)"
               r"|copyright[ \t:,]+(?!(holder|owner|notice|law|license|licence|interest|permission|statement|disclaimer|treat|"
               r"doctrine|the|and|or|on|in|of|to|are|is|if|for|with|that|as)[\p{L}]*\b)\S+([ \t]+\S+){0,4}[ \t\r]*$"
               r"|\(c\)[ \t]+(?!(you|the|under|representations|any|if)\b)\S+([ \t]+\S+){0,4}[ \t\r]*$"
               r"|all rights reserved\b)[^\n]*")
#: The lines that the SQL drops: any that begin with the word.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\n]*(copyright|\(c\)|©|all rights reserved)([^\p{L}\p{N}\n][^\n]*)?$"
OTHER = r"[^\p{L}\p{N}]+"
#: Between paragraphs: lines without a letter or digit.
PARAGRAPH_END = r"\n(?:[^\p{L}\p{N}\n]*\n)+"


def more_known() -> list[tuple[str, str]]:
    """Licences and notices besides ``KNOWN``, in the forms that they come in."""
    short = [(i, t) for i, t in KNOWN if "\n" in t]
    for n, parties in product(BSD_NUMBERS, BSD_PARTIES):
        head, tail = BSD_HEAD.format(*n), BSD_TAIL.format(*parties)
        short.append(("BSD-2-Clause", head + tail))
        short += [("BSD-3-Clause", head + BSD_THIRD.format(n[2], x) + tail) for x in BSD_NAMES]
    out = list(NOTICES)
    for file in sorted(TEXTS.glob("*.txt")):
        text = file.read_text(encoding="utf-8")
        terms = text.split(END_OF_TERMS)[0]
        forms = {text, terms, terms + END_OF_TERMS if terms != text else text}
        forms |= {x.replace("https://", "http://") for x in forms} | {x.replace("http://", "https://") for x in forms}
        if file.stem in TITLES:
            short += [(file.stem, x) for x in sorted(forms)]
        else:
            out += [(file.stem, x) for x in sorted(forms)]
    out += short + [(i, f"{title}\n\n{t}") for i, t in short for title in TITLES[i]]
    for (i, name, v), kind in product(GNU, ("program", "library", "software", "file")):
        out += [(f"{i}-or-later", GNU_NOTICE.format(kind, name, x)) for x in (
            f"; either version {v} of the License, or (at your option) any later version.", f", version {v} or later.")]
        out += [(i, GNU_NOTICE.format(kind, name, x)) for x in (f", version {v}.", f"; version {v} of the License.",
                                                                 f"; version {v}.", f", version {v} of the License.")]
    return out


def without_holders(low: F.Column) -> F.Column:
    """A lower-case text without the lines that name a copyright holder."""
    return F.regexp_replace(low, HOLDER_LINE, " ")


def digest(low: F.Column) -> F.Column:
    """MD5 of the words of a lower-case text, spellings made one; null without words."""
    x = F.concat(F.lit(" "), F.regexp_replace(low, OTHER, " "), F.lit(" "))
    for a, b in SPELLINGS:
        x = F.replace(x, F.lit(f" {a} "), F.lit(f" {b} "))
    n = F.trim(x)
    return F.when(n != "", F.md5(n))


def known_table(spark: SparkSession, known: DataFrame | None = None) -> DataFrame:
    """``digest, license``: one row per digest (of several licences with one text the least id)."""
    known = known if known is not None else spark.createDataFrame(KNOWN + more_known(), "license string, text string")
    low = F.lower(F.col("text"))
    return (known.select("license", F.explode(F.array(without_holders(low), low)).alias("low"))
            .select(digest(F.col("low")).alias("digest"), "license").where("digest is not null")
            .groupBy("digest").agg(F.min("license").alias("license")))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``doc_id, license, notices`` of each row: the licence that its whole text is, and the sorted ones of its lines and paragraphs."""
    table = known_table(docs.sparkSession, known)
    n = table.count()
    side = F.broadcast(table) if n <= MOST_KNOWN else table

    def part(whole: bool, notice: bool | F.Column, t: F.Column) -> F.Column:
        return F.struct(F.lit(whole).alias("whole"), F.lit(notice).alias("notice"), t.alias("t"))

    # the parts of a row are made and, but for one record, put together again in its task
    low = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("low"))
    both = low.select("row", "doc_id", "low", without_holders(F.col("low")).alias("bare"))
    paras = F.split("bare", PARAGRAPH_END)  # one of a single line is a line, one that is all is the whole text
    none = F.array().cast("array<struct<whole:boolean,notice:boolean,t:string>>")
    parts = both.withColumn("paras", paras).select("row", "doc_id", F.explode(F.concat(
        F.array(part(True, F.size("paras") == 1, F.col("bare"))),
        F.when(F.col("low") != F.col("bare"), F.array(part(True, False, F.col("low")))).otherwise(none),
        F.when(F.size("paras") > 1, F.transform(F.filter("paras", lambda t: F.contains(t, F.lit("\n"))),
                                                lambda t: part(False, True, t))).otherwise(none),
        F.transform(F.split("bare", "\n"), lambda t: part(False, True, t)))).alias("x")).select("row", "doc_id", "x.*")
    found = parts.select("row", "doc_id", "whole", "notice", digest(F.col("t")).alias("digest")).join(side, "digest", "left")
    return found.groupBy("row", "doc_id").agg(
        F.min(F.when(F.col("whole"), F.col("license"))).alias("license"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(F.col("notice"), F.col("license"))))).alias("notices")).drop("row")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(base.table(spark, sf_dir, "documents"))


def _sql(x: str) -> str:
    out = f"' ' || regexp_replace(regexp_replace(lower(coalesce({x}, '')), '{COPYRIGHT_LINE}', ' ', 'g'), '{OTHER}', ' ', 'g') || ' '"
    for a, b in SPELLINGS:
        out = f"replace({out}, ' {a} ', ' {b} ')"
    return f"trim({out})"


def _oracle() -> str:
    rows = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in KNOWN)
    return f"""
with known as (
  select md5(n) as digest, min(license) as license
  from (select license, {_sql('text')} as n from (values {rows}) v(license, text)) group by 1),
docs as (select row_number() over () as rn, doc_id, text from documents),
parts as (
  select rn, doc_id, true as whole, coalesce(text, '') as t from docs
  union all
  select rn, doc_id, false, unnest(string_split(coalesce(text, ''), chr(10))) from docs),
found as (
  select p.rn, p.doc_id, p.whole, k.license
  from (select rn, doc_id, whole, {_sql('t')} as n from parts) p left join known k on p.n <> '' and md5(p.n) = k.digest)
select doc_id, min(license) filter (whole) as license,
       coalesce(array_to_string(list_sort(list_distinct(list(license) filter (not whole and license is not null))), ','), '') as notices
from found group by rn, doc_id
"""


ORACLE = _oracle()
