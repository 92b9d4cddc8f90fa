"""Quality, mixing, fingerprints, pseudonyms, licenses and languages on small tables."""

import datetime
import hashlib
import random
import re
import string
import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F
from small_documents import documents  # noqa: F401

from retailmart.llm import langid, licenses, mixing, pii, quality, simhash
from retailmart.llm.follow import followed

LONG = "x" * 70_000
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three four"), (5, "one two three four"), (None, "no id here"), (7, LONG), (8, " ".join(["a b c"] * 9000))]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base(text):
    w = words(text)
    count = Counter(zip(w, w[1:], w[2:], strict=False))
    places = {p for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(places)


def made(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))


def test_measures_equal_brute_force(documents):
    rng = random.Random(1)
    texts = ["\n".join(" ".join(rng.choices(["a", "b", "É", "#x", "<&>"], k=rng.randint(0, 9))) for _ in range(rng.randint(1, 6))) for _ in range(60)]
    rows = [*ODD, *[(100 + i, t) for i, t in enumerate(texts)]]
    found = quality.measure(documents(*rows, extra=("n_words", "__other")))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = sorted((r.text or "", *[r[n] for n in names], r.base_failed) for r in found.collect())
    want = sorted((t or "", *(b := base(t)), b[0] < 50 or 100 * b[4] > 50 * b[0]) for _, t in rows)
    assert got == want and found.columns.count("n_words") == 1


def test_frequent_lines_go_and_depleted_documents_are_rejected(documents):
    menu = "\n".join(f"Menu {made(9000 + i, 9)}" for i in range(10))
    pages = [(i, f"{menu}\n{made(i, 120)}\n{made(1000 + i, 20)}", "shop") for i in range(40)]
    shell = [(100, f"{menu}\n{made(5, 8)}", "shop"), (101, f"{menu.upper()}\n{made(6, 9)}", "shop")]
    elsewhere = [(200, f"{menu}\n{made(7, 5)}", "blog"), *[(300 + i, made(i + 50, 60), "blog") for i in range(20)], (400, made(3, 80), None)]
    copies = [(500 + i, made(77, 90) + "\n" + made(78, 60), "copied") for i in range(60)]
    found = {r.doc_id: r for r in quality.judge(documents(*pages, *shell, *elsewhere, *copies)).collect()}
    assert not found[100].kept and not found[101].kept and found[100].left_words == 8
    assert all(found[i].kept and "Menu" not in found[i].left_text and found[i].left_words == 140 for i in range(40))
    assert found[200].kept and found[200].left_text.startswith("Menu")
    assert all(found[500 + i].kept and found[500 + i].left_words == 150 for i in range(60))
    assert found[400].kept


def test_furniture_of_the_smallest_digest_goes(documents):
    smallest = min((f"menu {made(i, 3)}" for i in range(20_000)), key=lambda x: hashlib.md5(x.encode()).digest())
    menu = "\n".join([smallest, *[f"Menu {made(9000 + i, 3)}" for i in range(10)]])
    pages = [(i, f"{menu}\n{made(i, 70)}", "shop") for i in range(40)]
    found = {r.doc_id: r for r in quality.judge(documents(*pages)).collect()}
    assert all(found[i].left_words == 70 and found[i].kept for i in range(40))


def test_pages_of_furniture_are_rejected(documents):
    """Pages that share most of their lines, near copies of each other too, beside clean ones of their host."""
    shared = "\n".join(made(9000 + i, 20) for i in range(5))
    pages = [(i, f"{shared}\n{made(i, 8)}", "shop") for i in range(200)]
    clean = [(1000 + i, f"{made(1000 + i, 60)}\n{made(2000 + i, 40)}", "shop") for i in range(300)]
    few = [(5000 + i, f"{shared}\n{made(i, 8)}", "blog") for i in range(quality.MAX_DOCUMENTS)]
    found = {r.doc_id: r for r in quality.judge(documents(*pages, *clean, *few)).collect()}
    assert not any(found[i].kept for i in range(200)) and all(found[i].left_words == 8 for i in range(200))
    assert all(found[k].kept and found[k].left_words == found[k].n_words for k in found if k >= 1000)


def test_the_limit_does_not_grow_with_the_host(documents):
    rows = [(i, made(i, 60) + ("\n" + made(9000, 10) if i < 90 else ""), "large") for i in range(1000)]
    rows += [(2000 + i, made(2000 + i, 60) + ("\n" + made(9000, 10) if i < 21 else ""), "small") for i in range(30)]
    found = {r.doc_id: r for r in quality.judge(documents(*rows)).collect()}
    assert all(r.left_words == 60 and r.kept for r in found.values())


def test_repeated_rows_and_lines_in_quality(documents):
    """Words of every copy of a flagged line are lost; rows of one text are judged alike, also under one id or none."""
    line = made(9000, 10)
    rows = [(i, f"{line}\n{made(i, 60)}\n{line.upper()}", "a") for i in range(30)]
    rows += [(None, rows[3][1], "a"), (None, rows[3][1], "a"), (3, rows[3][1], "a"), (50, rows[3][1], None), (51, rows[3][1], "b")]
    found = quality.judge(documents(*rows, extra=("lines", "key", "words", "host"))).collect()
    assert len(found) == len(rows) and all(r.left_words == (60 if r.source == "a" else 80) for r in found)


def test_odd_rows_do_not_break_quality(documents):
    found = quality.judge(documents(*ODD, extra=("kept", "__flags2"))).collect()
    assert len(found) == len(ODD) and not any(r.kept for r in found)
    assert quality.judge(documents().limit(0)).count() == 0


def filled_up(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = [n for n in names if n not in capped]
        level = (total - sum(3 * sizes[n] for n in capped)) / (sum(weight[n] for n in rest) or 1)
        new = {n for n in rest if 3 * sizes[n] < level * weight[n]}
        if not new:
            return {n: min(3 * sizes[n], level * weight[n]) for n in names}
        capped |= new


def test_mix_fills_targets(documents):
    rng = random.Random(3)
    rows = [(i, made(i, rng.randint(0, 60)), rng.choice(["a", "a", "a", "b", "Z", "é", None])) for i in range(600)]
    mixed = mixing.mix(documents(*rows, extra=("copies", "rank")))
    got = mixed.collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(words(text))
    goals, taken = filled_up(sizes), Counter()
    for r in got:
        assert r["size"] == len(words(r.text)) and r.source_size == sizes[r.source] and r["copies"] <= 3
        assert r.target == pytest.approx(goals[r.source])
        taken[r.source] += r["copies"] * r["size"]
    assert all(abs(taken[s] - goals[s]) <= 120 for s in sizes)
    again = mixing.mix(documents(*reversed(rows)).repartition(7)).collect()
    assert sorted((r.doc_id, r["copies"]) for r in again) == sorted((r.doc_id, r["copies"]) for r in got)


def test_mix_of_odd_rows(documents):
    got = mixing.mix(documents(*ODD)).collect()
    assert len(got) == len(ODD) and len({r["copies"] for r in got if r.doc_id == 5}) == 1
    assert mixing.mix(documents((1, None), (2, ""))).agg(F.sum("copies"), F.sum("target")).first() == (0, 0.0)
    assert mixing.mix(documents().limit(0)).count() == 0


def brute_fingerprint(text, spark):
    w = words(text.lower())
    terms = [w[i : i + 5] for i in range(max(1, len(w) - 4))]
    rows = [tuple((t + [None] * 5)[:5]) for t in terms]
    hashes = [r[0] for r in spark.createDataFrame(rows, "a string, b string, c string, d string, e string").select(F.xxhash64("a", "b", "c", "d", "e")).collect()]
    bits = sum((2 * sum(h >> i & 1 for h in hashes) > len(hashes)) << i for i in range(64))
    return bits - (1 << 64) if bits >> 63 else bits


def test_fingerprints_equal_brute_force(spark, documents):
    texts = [made(1, 40), made(1, 40) + " more", "Two words", "", None, "a b c d e", LONG]
    df = documents(*enumerate(texts), (0, texts[0]), extra=("side", "__at2"))
    found = {r.doc_id: r.fingerprint for r in simhash.fingerprints(df, ["doc_id"]).collect()}
    assert found == {i: brute_fingerprint(t or "", spark) for i, t in enumerate(texts)}
    assert found[3] == found[4]
    assert simhash.fingerprints(df.limit(0), ["doc_id"]).count() == 0


@pytest.mark.parametrize(("radius", "blocks"), [(3, 6), (1, 4), (0, 1)])
def test_search_finds_all_within_the_radius(spark, radius, blocks):
    rng = random.Random(radius)
    start = [rng.getrandbits(64) for _ in range(30)]
    near = [x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for x in start for _ in range(6)]
    values = [x - (1 << 64) if x >> 63 else x for x in [*start, *near, 0]]
    df = spark.createDataFrame([(x,) for x in [*values, None]], "fingerprint bigint")
    asked = df.limit(50)
    got = {tuple(r) for r in simhash.within(asked, df, radius, blocks).collect()}
    want = {(x, y) for x in values[:50] for y in values if ((x ^ y) & (1 << 64) - 1).bit_count() <= radius}
    assert got == want


def test_next_row(spark):
    ids = random.Random(2).sample(range(-500, 500), 300)
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "id bigint, text string").repartition(5)
    got = {r.id: (r.next_id, r.next_text) for r in followed(df, "id", ["id", "text"]).collect()}
    order = sorted(ids)
    assert got == {a: (b, f"t{b}") for a, b in zip(order, [*order[1:], order[0]], strict=True)}
    one = followed(df.where(f"id = {ids[0]}"), "id", ["text"]).collect()
    assert [(r.id, r.next_text) for r in one] == [(ids[0], f"t{ids[0]}")]
    assert followed(df.limit(0), "id", ["text"]).count() == 0
    odd = spark.createDataFrame([(None, "n"), (1, "b"), (1, "a"), (2, None)], "id bigint, text string")
    assert sorted((r.text or "-", r.next_text or "-") for r in followed(odd, "id", ["text"]).collect()) == [("-", "n"), ("a", "b"), ("b", "-"), ("n", "a")]


PRIVATE = {
    "email": "anna.lee42@mail5.example.com", "ip": "152.143.123.131", "phone": "+1 (743) 555-3824", "card": "4737097684299439",
    "iban": "GB82WEST12345698765432", "date": "2021-02-28", "secret": "24be64439e3e49cf46b2d7c90f3602a3d0b907ff",
}


def luhn(number):
    digits = [int(c) for c in reversed(number)]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def test_pseudonyms_keep_their_format_and_link(documents):
    text = "; ".join(PRIVATE.values())
    got = {r.doc_id: r for r in pii.pseudonymize(documents((1, text), (2, f"See {PRIVATE['card']}, or {PRIVATE['card']}."), (3, "4737 0976 8429 9439 and 743-555-3824")), "k").collect()}
    assert all(got[1][f"n_{k}"] == 1 for k in pii.KINDS)
    new = dict(zip(PRIVATE, got[1].text.split("; "), strict=True))
    assert all(new[k] != PRIVATE[k] and len(re.sub("[^ (]", "", new[k])) == len(re.sub("[^ (]", "", PRIVATE[k])) for k in PRIVATE)
    assert luhn(new["card"]) and len(new["card"]) == 16
    assert datetime.date.fromisoformat(new["date"]) and all(0 <= int(x) <= 255 for x in new["ip"].split("."))
    assert re.fullmatch(r"[a-z]{4}\.[a-z]{3}\d\d@mail5\.example\.com", new["email"]) and re.fullmatch("[0-9a-f]{40}", new["secret"])
    assert got[2].text == f"See {new['card']}, or {new['card']}." and got[2].n_card == 2
    assert re.sub("[^0-9]", "", got[3].text)[:16] == new["card"] and got[3].text[4] == " "
    assert re.sub("[^0-9]", "", got[3].text)[16:] == re.sub("[^0-9]", "", new["phone"])[1:]
    other = pii.pseudonymize(documents((1, text)), "another").first().text
    assert other != got[1].text


def test_cards_beside_other_numbers(documents):
    card = "4111 1111 1111 1111"
    texts = [card, f"{card} 123", f"{card} 12/25", f"order 12 {card}", f"id 123456 {card}", f"{card} 4737-0976-8429-9439", f"{card} 2021-02-28", "1234567 743-555-3824"]
    got = {r.doc_id: r for r in pii.pseudonymize(documents(*enumerate(texts)), "k").collect()}
    new = got[0].text
    assert [got[i].text for i in range(1, 5)] == [f"{new} 123", f"{new} 12/25", f"order 12 {new}", f"id 123456 {new}"]
    assert [got[i].n_card for i in range(8)] == [1, 1, 1, 1, 1, 2, 1, 0] and new != card
    assert got[5].text.startswith(new) and "4737" not in got[5].text and got[6].n_date == 1 and got[7].n_phone == 1


def test_clean_text_stays(documents):
    clean = ["Version 1.2.3 of 2021, 4737097684299430", "2021-02-30 and 1/2/99 and 31.2.2020", "300.1.1.1", "a@b and @c", "", None, LONG, "12345678901234567890", "0000000000000000", "\n x \t"]
    got = {r.doc_id: r for r in pii.pseudonymize(documents(*enumerate(clean), extra=("n_card", "kind")), "k").collect()}
    assert [got[i].text for i in range(len(clean))] == clean
    assert all(got[i][f"n_{k}"] == 0 for i in got for k in pii.KINDS)
    assert pii.pseudonymize(documents().limit(0), "k").count() == 0


def test_feistel_is_a_bijection(spark):
    values = spark.range(189 * 7).selectExpr("array(cast(id % 189 as int), cast(id div 189 as int)) v")
    moved = values.select(pii.feistel(F.col("v"), F.array(F.lit(189), F.lit(7)), F.lit("t"), "k").alias("w"))
    assert moved.distinct().count() == 189 * 7
    assert moved.where("w[0] not between 0 and 188 or w[1] not between 0 and 6").isEmpty()


def test_dates_are_permuted_as_dates(documents):
    days = [datetime.date(1999, 12, 25) + datetime.timedelta(i * 37) for i in range(300)]
    got = {r.doc_id: r.text for r in pii.pseudonymize(documents(*[(i, d.isoformat()) for i, d in enumerate(days)], (900, "3/14/2015 05.11.2020 25/3/2015")), "k").collect()}
    moved = {datetime.date.fromisoformat(got[i]) for i in range(300)}
    assert len(moved) == 300 and all(1700 <= d.year <= 2099 for d in moved)
    a, b, c = got[900].split()
    assert datetime.datetime.strptime(a, "%m/%d/%Y") and datetime.datetime.strptime(b, "%d.%m.%Y") and datetime.datetime.strptime(c, "%d/%m/%Y")


def test_licenses(documents):
    apache = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may"
    rows = [
        (1, "Some text without stop\nReleased under the MIT License.\nMore."),
        (2, "Licensed under the Apache License, Version 2.0. You may not use this file except in compliance with the License. "
            "You may obtain a copy of the License at\n\n   http://www.apache.org/licenses/LICENSE-2.0"),
        (3, "All rights reserved. Licensed under CC BY-NC 4.0."),
        (4, "You may not use this file except in compliance with the License."),
        (5, "The license of the driver was all in order."), (6, None), (7, ""), (8, LONG), (9, apache),
        (10, "RELEASED UNDER THE MIT LICENSE!\nReleased under the MIT License."),
        (11, "Redistribution and use in source and binary forms, with or\nwithout modification, are permitted provided that the following conditions are met:"),
    ]
    got = {r.doc_id: r for r in licenses.scan(documents(*rows, extra=("licenses", "name"))).collect()}
    assert [got[i].licenses for i in (1, 2, 3)] == [["MIT"], ["Apache-2.0"], ["CC-BY-NC-4.0", "All-rights-reserved"]]
    assert got[3].license_sentences == ["reserved", "cc-by-nc-4-name"]
    assert (got[4].licenses, got[4].unmatched) == ([], ["apache-comply"])
    assert got[11].unmatched == ["bsd-grant"] and got[10].license_sentences == ["mit-name"] * 2 and got[10].licenses == ["MIT"]
    assert all(got[i].license_sentences == [] and got[i].licenses == [] for i in (5, 6, 7, 8, 9))
    assert licenses.scan(documents().limit(0)).count() == 0


BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer\n"
    "in the documentation and/or other materials provided with the distribution.\n"
)


def test_repeated_notices_keep_their_order(documents):
    again = "All rights reserved under law.\nAll rights reserved.\nReleased under the MIT License."
    got = {r.doc_id: r for r in licenses.scan(documents((1, f"{BSD}\nint a;\n\n{BSD}"), (2, again))).collect()}
    assert got[1].license_sentences == ["bsd-grant", "bsd-source", "bsd-binary"] * 2
    assert (got[1].licenses, got[1].unmatched) == (["BSD-2-Clause"], [])
    assert got[2].license_sentences == ["reserved", "mit-name"]


def gnu(what, name, version, mark=";"):
    return (
        f"This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the {name} as published by the "
        f"Free Software Foundation{',' if mark == ':' else ';'} either version {version} of the License, or (at your option) any later version."
    )


ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
HEADERS = {
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
    "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software "
    'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "GPL-3.0-or-later": gnu("program", "GNU General Public License", "3", ":"), "GPL-2.0-or-later": gnu("program", "GNU General Public License", "2"),
    "LGPL-2.1-or-later": gnu("library", "GNU Lesser General Public License", "2.1"), "LGPL-3.0-or-later": gnu("library", "GNU Lesser General Public License", "3", ":"),
    "AGPL-3.0-or-later": gnu("program", "GNU Affero General Public License", "3", ":"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
    "You can obtain one at https://mozilla.org/MPL/2.0/.",
    "CC-BY-SA-4.0": "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-ND-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "ISC": f"{ISC}, provided that the above copyright notice and this permission notice appear in all copies.", "0BSD": f"{ISC}.", "BSD-2-Clause": BSD,
    "Unlicense": "For more information, please refer to <https://unlicense.org>",
}


def test_published_headers_wrapped_and_in_one_line(documents):
    wrapped = ["\n\n".join(textwrap.fill(p, 70) for p in text.split("\n\n")) for text in HEADERS.values()]
    rows = [*enumerate(wrapped), *[(100 + i, " ".join(t.split())) for i, t in enumerate(HEADERS.values())]]
    got = {r.doc_id: r for r in licenses.scan(documents(*rows)).collect()}
    for i, name in enumerate(HEADERS):
        assert [(got[k].licenses, got[k].unmatched) for k in (i, 100 + i)] == [([name], [])] * 2, name


def test_known_sentences_are_in_normal_form_and_carry_a_sign():
    for forms in licenses.SENTENCES.values():
        for form in forms:
            assert form == " ".join(re.findall("[a-z0-9]+", form)) and any(re.search(s, form) for s in licenses.SIGNS)
    assert {s for rule, _ in licenses.RULES for s in rule} <= set(licenses.SENTENCES)


LANGUAGES = {"xx": "bcd aei", "yy": "klm oua", "zz": "éèà ñçü"}


def spoken(lang, seed, n=60):
    rng = random.Random(f"{lang}{seed}")
    a, b = LANGUAGES[lang].split()
    return " ".join("".join(rng.choice(a) + rng.choice(b) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_languages(spark, documents):
    rows = [(f"{x}{i}", spoken(x, i), x) for x in LANGUAGES for i in range(40)]
    train = spark.createDataFrame([*rows, ("n", "words", None), ("m", None, "xx"), ("o", "123", "yy")], "id string, text string, lang string")
    model = langid.train(train, "id", "text", "lang", per_language=30, landmarks=8)
    assert model.languages == sorted(LANGUAGES) and model.landmarks.shape[1] == 24
    texts = [(i, spoken(x, 1000 + i, 5), x) for i, x in enumerate([*LANGUAGES] * 10)]
    odd = [(100, None), (101, ""), (102, "12 .,"), (103, spoken("xx", 5, 200_000)), (104, "京都")]
    asked = documents(*[(i, t) for i, t, _ in texts], *odd, extra=("score", "lang_pred"))
    got = {r.doc_id: r for r in langid.identify(asked, model).collect()}
    assert [got[i].lang_pred for i, _, _ in texts] == [x for _, _, x in texts]
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (100, 101, 102))
    assert got[103].lang_pred == "xx" and got[104].lang_pred in LANGUAGES and all(0 <= r.score <= 1 for r in got.values())
    assert langid.identify(asked.limit(0), model).count() == 0
    nothing = langid.train(train.limit(0), "id", "text", "lang")
    assert nothing is None and {r.lang_pred for r in langid.identify(asked, nothing).collect()} == {"und"}


def test_grams_equal_brute_force():
    classes = langid._classes(string.ascii_lowercase)
    text = "The cat, the HAT!"
    plain = " " + " ".join(re.findall("[a-z]+", text.lower())) + " "
    want = {plain[i : i + n] for n in range(1, 5) for i in range(len(plain) - n + 1)}
    assert len(langid.grams(text, classes)) == len(want)
    sizes = langid._PIECE
    try:
        langid._PIECE = 5
        assert len(langid.grams(text, classes)) == len(want)
    finally:
        langid._PIECE = sizes
