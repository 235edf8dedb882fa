"""Licence scans by sentence rules.

A text is split into sentences: comment marks at the start of lines go, a wrapped line goes on in the next, and a
sentence ends at . ! ? ; : before white space, at a blank line or at the text's end. Each is normalised (lower case,
everything but letters, digits and inner dots is one space) and looked up among known licence sentences; one that is
not known as a whole is looked up line by line, and an SPDX expression licence by licence (OR, AND, WITH; a + is "or later"). The identifiers found, in order, are matched against the licence rules,
first rule first; what a rule matches is used up. Identifiers left over are reported as unmatched.

Native: DataFrame functions only, one pass over the text and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Licences by identifier, as one-line notices name them (normalised). Fixed values.
NAMES = (
    ("Apache-2.0", ("apache license version 2.0", "apache 2.0 license", "apache license 2.0")),
    ("MIT", ("mit license", "mit license see license", "mit license see the license file")),
    ("BSD-2-Clause", ("bsd 2 clause license", "2 clause bsd license")),
    ("BSD-3-Clause", ("bsd 3 clause license", "3 clause bsd license")),
    ("ISC", ("isc license",)),
    ("GPL-2.0", ("gnu general public license version 2", "gnu general public license v2.0", "gpl version 2", "gplv2")),
    ("GPL-2.0-or-later", ("gpl version 2 orlater", "gplv2 orlater")),
    ("GPL-3.0", ("gnu general public license version 3", "gnu general public license v3.0", "gpl version 3", "gplv3")),
    ("GPL-3.0-or-later", ("gpl version 3 orlater", "gplv3 orlater")),
    ("LGPL-2.1", ("gnu lesser general public license version 2.1", "gnu lesser general public license v2.1")),
    ("LGPL-3.0", ("gnu lesser general public license version 3", "gnu lesser general public license v3.0")),
    ("AGPL-3.0", ("gnu affero general public license version 3", "gnu affero general public license v3.0")),
    ("MPL-2.0", ("mozilla public license version 2.0",)),
    ("CC-BY-4.0", ("cc by 4.0", "creative commons attribution 4.0 international license")),
    ("CC-BY-SA-4.0", ("cc by sa 4.0", "creative commons attribution sharealike 4.0 international license")),
    ("CC-BY-NC-4.0", ("cc by nc 4.0", "creative commons attribution noncommercial 4.0 international license")),
    ("CC0-1.0", ("cc0 1.0",)),
)
#: Names that only "licensed under" makes a notice of. Fixed values.
BARE = (("MIT", "mit"), ("Apache-2.0", "apache 2.0"))
LEADS = ("", "this work is ", "this project is ", "this software is ", "this file is ", "the code is ")
VERBS = ("licensed under ", "released under ", "distributed under ", "available under ")
#: Identifiers that stand behind an SPDX tag. Fixed values.
SPDX = (
    "Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later",
    "LGPL-2.0-only", "LGPL-2.0-or-later", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-1.1", "MPL-2.0", "EPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
    "Unlicense", "BSL-1.0", "0BSD", "Zlib", "NCSA", "PostgreSQL", "Python-2.0", "Artistic-2.0", "OFL-1.1", "WTFPL",
    "Classpath-exception-2.0", "GCC-exception-3.1", "LLVM-exception", "Linux-syscall-note",
)
#: What stands before an SPDX expression, and what parts its licences, in normalised lines. Fixed values.
TAG, JOINS = "spdx license identifier ", " (?:or|and|with) "
#: Identifier and normalised sentence, as the published texts are split. Fixed values.
TEXTS = (
    ("apache2notice", "licensed under the apache license version 2.0 the license"),
    ("apache2you", "you may not use this file except in compliance with the license"),
    ("apache2get", "you may obtain a copy of the license at"),
    ("apache2asis", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache2see", "see the license for the specific language governing permissions and limitations under the license"),
    ("mitgrant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mitkeep", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mitasis", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mitliable", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("bsdgrant", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsdsource", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsdbinary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsdname", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsdasis", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("bsdliable", "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services"),
    ("bsdliable", "in no event shall the copyright owner or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services"),
    ("bsdloss", "loss of use data or profits"),
    ("bsdcaused", "or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("iscgrant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("iscasis", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("gplfree", "this program is free software"),
    ("gpl3later", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl3later", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl3later", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gplterms", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl2later", "either version 2 of the license or at your option any later version"),
    ("gplhope", "this program is distributed in the hope that it will be useful but without any warranty"),
    ("gpleven", "without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("lgplfree", "this library is free software"),
    ("lgplterms", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("lgpl21later", "either version 2.1 of the license or at your option any later version"),
    ("lgplhope", "this library is distributed in the hope that it will be useful but without any warranty"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("boosttitle", "boost software license version 1.0 august 17th 2003"),
    ("boosttitle", "boost software license version 1.0"),
    ("mpl2line", "this source code form is subject to the terms of the mozilla public license v.2.0"),
    ("cc0line", "this work is dedicated to the public domain under cc0 1.0"),
    ("allrights", "all rights reserved"),
)


def _plain(name: str) -> str:
    return name.lower().replace("-or-later", " orlater").replace("-", " ")


SENTENCES = (
    *TEXTS,
    *((f"line:{licence}", f"{lead}{verb}{the}{name}") for licence, names in NAMES for name in names for lead in LEADS for verb in VERBS for the in ("the ", "a ", "")),
    *((f"line:{licence}", f"{lead}licensed under {the}{name}") for licence, name in BARE for lead in LEADS for the in ("the ", "")),
    *((f"spdx:{licence}", f"{TAG}{_plain(licence)}") for licence in SPDX),
    *(("dual:Apache-2.0 OR MIT", f"{lead}dual licensed under {the}{a} {both} {the}{b}") for lead in LEADS for the in ("the ", "") for both in ("and", "or")
      for x, y in (("MIT", "Apache-2.0"), ("Apache-2.0", "MIT")) for a in dict(NAMES)[x][:1] for b in dict(NAMES)[y]),
)
#: Licence and the identifiers that name it, in order; rules are tried in this order. Fixed values.
RULES = (
    *(("Apache-2.0", (first, "apache2you", "apache2get", "apache2asis", *last)) for last in (("apache2see",), ()) for first in ("apache2notice", "line:Apache-2.0")),
    *(("MIT", (*first, "mitgrant", "mitkeep", "mitasis", *last)) for last in (("mitliable",), ()) for first in (("line:MIT",), ())),
    *((name, ("bsdgrant", "bsdsource", "bsdbinary", *own, *last)) for last in (("bsdasis", "bsdliable", "bsdloss", "bsdcaused"), ()) for name, own in (("BSD-3-Clause", ("bsdname",)), ("BSD-2-Clause", ()))),
    ("ISC", ("iscgrant", "iscasis")),
    ("ISC", ("iscgrant",)),
    *((name, ("gplfree", *terms, *last)) for last in (("gplhope", "gpleven"), ()) for name, terms in (
        ("GPL-3.0-or-later", ("gpl3later",)), ("AGPL-3.0-or-later", ("agpl3later",)), ("LGPL-3.0-or-later", ("lgpl3later",)), ("GPL-2.0-or-later", ("gplterms", "gpl2later")),
    )),
    *(("LGPL-2.1-or-later", ("lgplfree", "lgplterms", "lgpl21later", *last)) for last in (("lgplhope", "gpleven"), ())),
    ("Apache-2.0 OR MIT", ("dual:Apache-2.0 OR MIT",)),
    ("Unlicense", ("unlicense",)),
    ("BSL-1.0", ("boosttitle",)),
    ("Apache-2.0", ("apache2notice",)),
    ("MPL-2.0", ("mpl2line",)),
    *((name, (f"spdx:{name}",)) for name in SPDX),
    *((name, (f"line:{name}",)) for name, _ in NAMES),
    ("CC0-1.0", ("cc0line",)),
    ("Proprietary", ("allrights",)),
)
#: Every known sentence holds one of these; a text without any has no identifier.
HINTS = ("licen", "copyright", "warrant", "permi", "software", "gpl", "cc0", "cc by", "cc-by", "public", "rights", "profits", "business", "compliance", "version", "mozilla")
END = "\u0002"
#: Regular expressions of the split, in order, and what replaces a match; they read alike in Java and RE2.
STEPS = (
    (r"(?m)^[ \t]*(/\*+|\*+/|\*+|//+|#+|;+|--+|<!--|%+)", ""),
    (r"spdx-license-identifier[ \t]*:", "spdx-license-identifier "),
    (r"\bv\.[ \t\r\n]+", "v."),
    (r"-or-later\b", " orlater"),
    (r"([0-9])\+", "\\1 orlater"),
    (r"[.!?;:]+([ \t\r\n]|$)", END + "\\1"),
    (r"\n([ \t\r]*\n)+", END),
    (r"[^a-z0-9.\n" + END + "]+", " "),
    (r" ?\n ?", "\n"),
)


def sentences(text: Column) -> Column:
    """Sentences, normalised but for the line breaks in them."""
    out = F.lower(text)
    for pattern, by in STEPS:
        out = F.regexp_replace(out, pattern, by.replace("\\1", "$1"))
    return F.split(out, END)


def identifiers(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    known = dict((s, i) for i, s in reversed(SENTENCES))
    names = F.create_map(*[F.lit(x) for s, i in known.items() for x in (s, i)])
    some = list(known)

    def licences_of(line: Column) -> Column:
        """A line, or one for each licence of the SPDX expression that it is."""
        each = F.transform(F.split(F.substring(line, F.lit(len(TAG) + 1), F.length(line)), JOINS), lambda x: F.concat(F.lit(TAG), F.trim(x)))
        return F.when(line.startswith(TAG), each).otherwise(F.array(line))

    def found(sentence: Column) -> Column:
        lines = F.filter(F.transform(F.split(sentence, "\n"), lambda x: F.trim(x)), lambda x: x != "")
        whole = F.array_join(lines, " ")
        pieces = F.flatten(F.transform(lines, licences_of))
        return F.when(whole.isin(some), F.array(whole)).otherwise(F.filter(pieces, lambda x: x.isin(some)))

    hit = F.transform(F.flatten(F.transform(sentences(text), found)), lambda s: F.element_at(names, s))
    hinted = F.lower(text).rlike("|".join(HINTS))
    return F.when(hinted, hit).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input's columns plus license_scan: struct<identifiers, licenses (in rule order, repeats kept), unmatched>.

    Null and empty texts have none of either. Each row is scanned alone and whole, however long, so repeated rows agree
    and an empty table gives an empty table. An input column named license_scan gives way to the result.
    """
    names = [c for c in docs.columns if c != "license_scan"]
    row = F.struct(F.lit(0).alias("n"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)])
    seen = docs.select(row.alias("row"), identifiers(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("ids"))
    # every identifier stands between separators of its own, and what a rule used up between bars
    left = F.when(F.size("ids") > 0, F.concat(F.lit(";"), F.array_join("ids", ";;"), F.lit(";"))).otherwise(F.lit(""))
    state = F.struct(left.alias("left"), F.array().cast("array<string>").alias("found"))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(f";{';;'.join(ids)};").alias("rule")) for name, ids in RULES])

    def use(s: Column, r: Column) -> Column:
        times = ((F.length(s["left"]) - F.length(F.replace(s["left"], r["rule"], F.lit("")))) / F.length(r["rule"])).cast("int")
        return F.struct(F.replace(s["left"], r["rule"], F.lit("|")).alias("left"), F.concat(s["found"], F.array_repeat(r["name"], times)).alias("found"))

    seen = seen.withColumn("state", state)
    done = F.when(F.size("ids") > 0, F.aggregate(rules, F.col("state"), use)).otherwise(F.col("state"))
    seen = seen.withColumn("done", done)
    return seen.select(
        *[F.col("row")[f"c{k}"].alias(c) for k, c in enumerate(names)],
        F.struct(
            F.col("ids").alias("identifiers"),
            F.col("done.found").alias("licenses"),
            F.filter(F.split("done.left", "[;|]+"), lambda x: x != "").alias("unmatched"),
        ).alias("license_scan"),
    )
