"""License scans by sentence rules.

A text is cut into sentences and lines, these are brought to a normal form and looked up in a
fixed table of known sentences; where one has names in it, a template with holes is matched. The identifiers of a document, in order, are matched against
ordered rules: a rule names a sequence of identifiers and the license it means; a
matched sequence is used up, so the general rules see what the special ones left.

Only a sentence that contains one of the words that every known sentence contains is
looked up; both tables are constants of this module, hence broadcast.

Defined results: NULL and empty text have no identifiers and no license; a sentence that is known but
completes no rule is listed in ``unmatched``; repeated sentences count each; repeated rows are
scanned alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailmart.llm.text import filled


def _free(what: str, name: str, version: str) -> tuple[str, str]:
    """The grant of the GNU notices, as one sentence and as what stands after ``free software:``."""
    grant = (
        f"you can redistribute it and or modify it under the terms of the {name} as published by the free software foundation "
        f"either version {version} of the license or at your option any later version"
    )
    return f"this {what} is free software {grant}", grant


def _creative(kind: str, name: str) -> tuple[str, ...]:
    """The notices of a Creative Commons license 4.0, by its short and its long name."""
    long = f"creative commons {name} 4 0 international license"
    return (f"licensed under cc {kind} 4 0", f"this work is licensed under cc {kind} 4 0", f"this work is licensed under a {long}", f"this work is licensed under the {long}")


# fixed values: identifier -> known sentences in normal form (lower case, letters and digits, single blanks)
SENTENCES = {
    "mit-name": ("mit license", "the mit license", "the mit license mit", "released under the mit license", "licensed under the mit license", "this project is licensed under the mit license"),
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    ),
    "mit-notice": ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",),
    "apache-2-name": ("licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license", "released under the apache license version 2 0"),
    "apache-comply": ("you may not use this file except in compliance with the license",),
    "apache-grant": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
        "licensed to you under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    ),
    "apache-copy": (
        "you may obtain a copy of the license at",
        *(
            f"you may obtain a copy of the license at {scheme} www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software "
            "distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"
            for scheme in ("http", "https")
        ),
        "you may obtain a copy of the license at http www apache org licenses license 2 0",
        "you may obtain a copy of the license at https www apache org licenses license 2 0",
    ),
    "apache-address": ("http www apache org licenses license 2 0", "https www apache org licenses license 2 0"),
    "gpl-2-name": ("this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2"),
    "gpl-3-name": ("this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3"),
    "gpl-free": _free("program", "gnu general public license", "3"),
    "gpl-2-free": _free("program", "gnu general public license", "2"),
    "gpl-2-only": tuple(
        start + "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation"
        for start in ("this program is free software ", "")
    ),
    "lgpl-2.1-free": _free("library", "gnu lesser general public license", "2 1"),
    "lgpl-3-free": _free("library", "gnu lesser general public license", "3") + _free("program", "gnu lesser general public license", "3")[:1],
    "agpl-3-free": _free("program", "gnu affero general public license", "3"),
    "bsd-grant": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    ),
    "bsd-source": ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
        "in the documentation and or other materials provided with the distribution",
    ),
    "bsd-names": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission",
    ),
    "bsd-disclaimer": (
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to "
        "the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    ),
    "mit-disclaimer": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to "
        "the warranties of merchantability fitness for a particular purpose and noninfringement",
    ),
    "isc-disclaimer": (
        "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    ),
    "zlib-disclaimer": ("this software is provided as is without any express or implied warranty",),
    "epl-2-name": ("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",),
    "cc0-name": (
        "cc0 1 0 universal", "creative commons zero v1 0 universal", "licensed under cc0 1 0", "this work is licensed under cc0 1 0", "this work is marked with cc0 1 0",
        "this work is marked with cc0 1 0 universal", "released under cc0 1 0", "public domain dedication cc0 1 0",
    ),
    "spdx-expression": ("spdx license identifier mit or apache 2 0",),
    "mpl-2-name": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
    "cc-by-4-name": _creative("by", "attribution"),
    "cc-by-sa-4-name": _creative("by sa", "attribution sharealike"),
    "cc-by-nc-4-name": _creative("by nc", "attribution noncommercial"),
    "cc-by-nd-4-name": _creative("by nd", "attribution noderivatives"),
    "cc-by-nc-sa-4-name": _creative("by nc sa", "attribution noncommercial sharealike"),
    "cc-by-nc-nd-4-name": _creative("by nc nd", "attribution noncommercial noderivatives"),
    "isc-grant": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "0bsd-grant": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",),
    "zlib-grant": (
        "permission is granted to anyone to use this software for any purpose including commercial applications "
        "and to alter it and redistribute it freely subject to the following restrictions",
    ),
    "boost-name": ("distributed under the boost software license version 1 0",),
    "unlicense-refer": ("for more information please refer to http unlicense org", "for more information please refer to https unlicense org"),
    "reserved": ("all rights reserved",),
}
# fixed values: identifier -> normal forms with holes for names; each holds a sign, as known sentences do
TEMPLATES = {
    "bsd-names": (
        r"^neither the names? of .{1,200} (?:nor|or) the names of .{0,60}contributors may be used to endorse or promote products "
        r"derived from this software without (?:specific )?prior written permission$",
    ),
    "apache-grant": (
        r"^.{1,100} licenses this file to you under the apache license version 2 0 the license you may not use this file except in compliance with the license$",
    ),
    "bsd-disclaimer": (
        r"^this software is provided by .{1,200} as is and any express or implied warranties including but not limited to "
        r"the implied warranties of merchantability and fitness for a particular purpose are disclaimed$",
    ),
    "epl-2-name": (
        r"^this program and the accompanying materials are made available under the terms of the eclipse public license v? ?2 0"
        r"(?: which (?:is available at https? www eclipse org legal epl .{1,20}|accompanies this distribution.{0,100}))?$",
    ),
    "cc0-name": (r"^to the extent possible under law .{1,200} ha(?:s|ve) (?:waived|dedicated) all copyright and related (?:or|and) neighbou?ring rights to .{1,200}$",),
    "spdx-expression": (r"^spdx license identifier .{1,100} (?:and|or|with) .{1,100}$",),
}
# fixed values: ordered rules, special ones first
RULES = (
    (("mit-grant", "mit-notice", "mit-disclaimer"), "MIT"),
    (("mit-grant", "mit-notice"), "MIT"),
    (("mit-grant",), "MIT"),
    (("mit-name",), "MIT"),
    (("apache-2-name", "apache-comply", "apache-copy", "apache-address"), "Apache-2.0"),
    (("apache-2-name", "apache-comply", "apache-copy"), "Apache-2.0"),
    (("apache-grant", "apache-copy", "apache-address"), "Apache-2.0"),
    (("apache-grant", "apache-copy"), "Apache-2.0"),
    (("apache-grant",), "Apache-2.0"),
    (("apache-2-name",), "Apache-2.0"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-disclaimer"), "BSD-3-Clause"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"), "BSD-3-Clause"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-disclaimer"), "BSD-2-Clause"),
    (("bsd-grant", "bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (("gpl-free",), "GPL-3.0-or-later"),
    (("gpl-2-free",), "GPL-2.0-or-later"),
    (("gpl-2-only",), "GPL-2.0-only"),
    (("lgpl-2.1-free",), "LGPL-2.1-or-later"),
    (("lgpl-3-free",), "LGPL-3.0-or-later"),
    (("agpl-3-free",), "AGPL-3.0-or-later"),
    (("gpl-3-name",), "GPL-3.0-only"),
    (("gpl-2-name",), "GPL-2.0-only"),
    (("mpl-2-name",), "MPL-2.0"),
    (("cc-by-nc-sa-4-name",), "CC-BY-NC-SA-4.0"),
    (("cc-by-nc-nd-4-name",), "CC-BY-NC-ND-4.0"),
    (("cc-by-nc-4-name",), "CC-BY-NC-4.0"),
    (("cc-by-nd-4-name",), "CC-BY-ND-4.0"),
    (("cc-by-sa-4-name",), "CC-BY-SA-4.0"),
    (("cc-by-4-name",), "CC-BY-4.0"),
    (("isc-grant", "isc-disclaimer"), "ISC"),
    (("isc-grant",), "ISC"),
    (("0bsd-grant", "isc-disclaimer"), "0BSD"),
    (("0bsd-grant",), "0BSD"),
    (("zlib-disclaimer", "zlib-grant"), "Zlib"),
    (("zlib-grant",), "Zlib"),
    (("epl-2-name",), "EPL-2.0"),
    (("cc0-name",), "CC0-1.0"),
    (("boost-name",), "BSL-1.0"),
    (("unlicense-refer",), "Unlicense"),
    (("reserved",), "All-rights-reserved"),
)
# fixed values: each known sentence contains one of these words
SIGNS = ("licen[sc]e", "permission", "redistribut", "rights reserved", "under cc", "cc0", "commons zero", "neighbou?ring rights", "provided\\W+as\\W+is", "\\bas\\W+is\\W+and\\W+any")
# a tag of one licence that the rules know
TAGS = {f"spdx-{name.lower()}": name for _, name in RULES if name != "All-rights-reserved"}
SENTENCES |= {tag: (f"spdx license identifier {re.sub('[^a-z0-9]+', ' ', name.lower())}",) for tag, name in TAGS.items()}
RULES += tuple(((tag,), name) for tag, name in TAGS.items())

# no sentence ends after the v. of a version, nor after a firm's short form if a small letter follows
ENDS = r"(?<=[.!?:])(?<!\b[vV]\.)(?!(?<=\b(?:Inc|Ltd|Co|Corp)\.)\s+[a-z])[\"')\]]*\s+|\n\s*\n"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def normal_form(text: Column) -> Column:
    """Lower case; anything but letters and digits becomes one blank."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """All rows with ``license_sentences`` (identifiers in order), ``licenses`` (in rule order) and ``unmatched``.

    Columns of these names are replaced. The scan is done in the row; nothing is shuffled.
    """
    added = ("license_sentences", "licenses", "unmatched")
    columns = [c for c in df.columns if c not in added]
    signs = "(?i)" + "|".join(SIGNS)
    known = F.create_map(*[F.lit(x) for name, forms in SENTENCES.items() for form in forms for x in (form, name)])
    out = df.select(*columns, F.when(filled(text).rlike(signs), filled(text)).alias("__text"))

    def named(form: Column) -> Column:
        return F.coalesce(F.element_at(known, form), *[F.when(form.rlike(t), F.lit(n)) for n, ts in TEMPLATES.items() for t in ts])

    def pieces(pattern: str) -> Column:
        texts, gaps = F.split(F.col("__text"), pattern, -1), F.regexp_extract_all("__text", F.lit(pattern), F.lit(0))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,end:int,name:string>>").alias("found"))

        def placed(state: Column, x: Column) -> Column:
            name = F.when(x["text"].rlike(signs), _let(normal_form(x["text"]), named))
            first = state["at"] + F.char_length(x["text"]) - F.char_length(F.regexp_replace(x["text"], r"^[^\p{L}\p{N}]+", ""))
            last = first + F.char_length(F.regexp_replace(x["text"], r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]++$", ""))
            here = F.array(F.struct(first.alias("at"), last.alias("end"), name.alias("name")))
            after = state["at"] + F.char_length(x["text"]) + F.coalesce(F.char_length(x["gap"]), F.lit(0))
            return F.struct(after.alias("at"), F.when(name.isNotNull(), F.concat(state["found"], here)).otherwise(state["found"]).alias("found"))

        return F.aggregate(F.zip_with(texts, gaps, lambda a, b: F.struct(a.alias("text"), b.alias("gap"))), start, placed, lambda s: s["found"])

    # A line is looked at by itself as well: a notice on its own line may follow one without a full stop.
    # Each piece is placed by the lengths of what stands before it; of pieces within each other the longest counts.
    out = out.select(*columns, F.concat(pieces("\n"), pieces(ENDS)).alias("__pieces"))
    apart = F.filter("__pieces", lambda x: ~F.exists("__pieces", lambda y: (y["at"] <= x["at"]) & (y["end"] >= x["end"]) & (y["end"] - y["at"] > x["end"] - x["at"])))
    out = out.select(*columns, F.sort_array(F.array_distinct(apart)).alias("__placed"))
    names = F.coalesce(F.transform("__placed", lambda x: x["name"]), F.array().cast("array<string>"))
    out = out.select(*columns, names.alias("license_sentences"))
    # <a><b>: a used sequence becomes a dot, which keeps its neighbours apart
    state = F.array_join(F.transform("license_sentences", lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")
    out = out.select(*columns, "license_sentences", state.alias("__left"), F.array().cast("array<string>").alias("licenses"))
    for sequence, name in RULES:
        wanted = F.lit("".join(f"<{x}>" for x in sequence))
        hit = F.contains("__left", wanted)
        more = F.when(hit, F.array_union("licenses", F.array(F.lit(name)))).otherwise(F.col("licenses"))
        out = out.select(*columns, "license_sentences", F.replace("__left", wanted, F.lit(".")).alias("__left"), more.alias("licenses"))
    unmatched = F.regexp_extract_all("__left", F.lit("<([^>]+)>"), F.lit(1))
    return out.select(*columns, "license_sentences", "licenses", unmatched.alias("unmatched"))
