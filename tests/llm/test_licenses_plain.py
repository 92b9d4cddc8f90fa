"""License scans against a plain version, and notices with names, tags and disclaimers."""

import textwrap

import regex
from conftest import SMALL
from small_documents import documents  # noqa: F401
from test_text_operators import BSD, HEADERS

from retailmart.llm import licenses


def plain(text):
    """Identifiers in order, licenses and what is left."""
    text, found = text or "", set()
    signs = regex.compile("|".join(licenses.SIGNS), regex.I)
    known = {form: name for name, forms in licenses.SENTENCES.items() for form in forms}
    for pattern in ("\n", licenses.ENDS):
        start = 0
        cuts = [*[m.span() for m in regex.finditer(pattern, text)], (len(text), len(text))]
        for end, after in cuts:
            piece = text[start:end]
            form = regex.sub(r"[^\p{L}\p{N}]+", " ", piece.lower()).strip()
            name = known.get(form) or next((n for n, ts in licenses.TEMPLATES.items() for t in ts if regex.search(t, form)), None)
            if name and signs.search(piece):
                inner = regex.sub(r"^[^\p{L}\p{N}]+", "", piece)
                at = start + len(piece) - len(inner)
                found.add((at, at + len(regex.sub(r"[^\p{L}\p{N}]+$", "", inner)), name))
            start = after
    names = [n for a, b, n in sorted(found) if not any(c <= a and d >= b and d - c > b - a for c, d, _ in found)]
    left, said = list(names), []
    for sequence, name in licenses.RULES:
        i = 0
        while i + len(sequence) <= len(left):
            if tuple(left[i : i + len(sequence)]) == sequence:
                left[i : i + len(sequence)] = ["."]
                if name not in said:
                    said.append(name)
            i += 1
    return names, said, [n for n in left if n != "."]


def agree(df):
    rows = licenses.scan(df).collect()
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in rows:
        assert (r.license_sentences, r.licenses, r.unmatched) == plain(texts[r.doc_id]), texts[r.doc_id][:300]
    return rows


NAMED = BSD + "3. Neither the name of Google Inc. nor the names of its contributors may be used to endorse or promote products derived from\nthis software without specific prior written permission.\n"
ASF = (
    "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements.  See the NOTICE file distributed with this work for "
    'additional information regarding copyright ownership.  The ASF licenses this file to You under the Apache License, Version 2.0 (the "License"); you may not '
    "use this file except in compliance with the License.  You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n"
)
DISCLAIMED = (
    'THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THEY BE LIABLE."
)
CASES = [
    (NAMED, ["BSD-3-Clause"]), (f"{NAMED}\n{DISCLAIMED}", ["BSD-3-Clause"]), (f"{BSD}\n{DISCLAIMED}", ["BSD-2-Clause"]), (ASF, ["Apache-2.0"]),
    ("// SPDX-License-Identifier: MIT\nint a;", ["MIT"]), ("# SPDX-License-Identifier: GPL-2.0-or-later\n", ["GPL-2.0-or-later"]),
    ("<!-- SPDX-License-Identifier: BSD-3-Clause -->", ["BSD-3-Clause"]),
    ("To the extent possible under law, Ann Lee has waived all copyright and related or neighboring rights to this work.", ["CC0-1.0"]),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
     "https://www.eclipse.org/legal/epl-2.0/\n\nmore", ["EPL-2.0"]),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0.", ["EPL-2.0"]),
]


def test_notices_with_names_tags_and_disclaimers(documents):
    # a tag stands on a line of its own, which wrapping would join to the next
    wrapped = [t if "SPDX" in t else "\n\n".join(textwrap.fill(p, 72) for p in regex.split(r"\n\n", t)) for t, _ in CASES[3:]]
    commented = ["\n".join(f" * {line}".rstrip() for line in w.split("\n")) for w in wrapped]
    rows = [(i, t) for i, (t, _) in enumerate(CASES)] + [(100 + i, t) for i, t in enumerate(wrapped, 3)] + [(200 + i, t) for i, t in enumerate(commented, 3)]
    got = {r.doc_id: r for r in agree(documents(*rows))}
    for k, r in got.items():
        assert (r.licenses, r.unmatched) == (CASES[k % 100][1], []), k
    other = agree(documents((1, "SPDX-License-Identifier: MIT OR Apache-2.0"), (2, "The house is provided as is and the license stays."), (3, "neighbouring rights")))
    assert [(r.licenses, r.unmatched) for r in sorted(other, key=lambda r: r.doc_id)] == [([], ["spdx-expression"]), ([], []), ([], [])]


def test_a_plain_version_agrees(spark, documents):
    agree(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text"))
    texts = list(HEADERS.values())
    agree(documents(*[(i * 100 + j, f"{a}\n{b}\n{a}") for i, a in enumerate(texts) for j, b in enumerate(texts)], (-1, None), (-2, "")))
