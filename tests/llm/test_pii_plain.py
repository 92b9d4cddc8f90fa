"""Pseudonyms against a plain version that goes through a text number by number, written with big integers and loops."""

import datetime
import hashlib
import random
import time

import pytest
import regex
from conftest import SMALL

from retailmart.llm import pii

KEY = "k"


def shifted(values, radices, tweak):
    """The Feistel network, ten rounds."""
    half = (len(values) + 1) // 2
    a, ra, b, rb = values[:half], radices[:half], values[half:], radices[half:]
    for n in range(1, 11):
        said = ",".join([KEY, tweak, str(n), str(len(a)), ".".join(map(str, b))])
        stream = "".join(hashlib.sha256(f"{said}:{i}".encode()).hexdigest() for i in range(len(a) // 16 + 1))
        a, ra, b, rb = b, rb, [(x + int(stream[4 * i : 4 * i + 4], 16)) % ra[i] for i, x in enumerate(a)], ra
    return a + b


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10


def refilled(text, new, fits):
    new = iter(new)
    return "".join(next(new) if fits(c) else c for c in text)


def card(was):
    digits = [int(c) for c in was if c.isdigit()]
    body = "".join(map(str, shifted(digits[:-1], [10] * (len(digits) - 1), "card")))
    return refilled(was, body + next(d for d in "0123456789" if luhn(body + d) == 0), str.isdigit)


def phone(was):
    digits = [c for c in was if c.isdigit()]
    last = shifted(list(map(int, digits[-10:])), [10] * len(digits[-10:]), "phone")
    return refilled(was, digits[:-10] + list(map(str, last)), str.isdigit)


def iban(was):
    plain = was.replace(" ", "")
    assert plain[:2].isalpha()
    if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 != 1:
        return None
    body = [(int(c), 10) if c.isdigit() else (ord(c) - 65, 26) for c in plain[4:]]
    new = shifted([v for v, _ in body], [r for _, r in body], "iban" + plain[:2])
    new = "".join(str(x) if r == 10 else chr(65 + x) for x, (_, r) in zip(new, body, strict=True))
    check = 98 - int("".join(str(int(c, 36)) for c in new + plain[:2] + "00")) % 97
    return refilled(was, f"{plain[:2]}{check:02}{new}", str.isalnum)


def email(was):
    local, domain = was.split("@")
    small = [c.lower() if len(c.lower()) == 1 else c for c in local]
    places = []
    for c in small:
        inside = [(f, n) for f, n in pii.ALPHABETS if f <= ord(c) < f + n]
        other = (ord(c) - ord(c) % pii.BLOCK, pii.BLOCK) if regex.match(r"[\p{L}\p{N}]", c) else (ord(c), 1)
        places.append(inside[0] if inside else other)
    new = shifted([ord(c) - f for c, (f, _) in zip(small, places, strict=True)], [n for _, n in places], "email@" + domain.lower())
    out = [chr(x + f) for x, (f, _) in zip(new, places, strict=True)]
    return "".join(o.upper() if c != s and len(o.upper()) == 1 else o for o, c, s in zip(out, local, small, strict=True)) + "@" + domain


def ip(was):
    octets = [int(x) for x in was.split(".")]
    return ".".join(map(str, shifted(octets, [256] * 4, "ip"))) if max(octets) < 256 else None


def secret(was):
    out = "".join("0123456789abcdef"[x] for x in shifted([int(c, 16) for c in was], [16] * len(was), "secret"))
    return out.upper() if regex.search("[A-F]", was) else out


def date(was):
    parts = regex.split("[-/.]", was)
    if "-" in was:
        order = (0, 1, 2)
    else:
        order = (2, 1, 0) if "." in was or int(parts[0]) > 12 else (2, 0, 1)
    try:
        day = datetime.date(*(int(parts[i]) for i in order))
    except ValueError:
        return None
    if not 1700 <= day.year <= 2099:
        return None
    first = datetime.date(1700, 1, 1)
    a, b = shifted(list(divmod((day - first).days, 773)), [189, 773], "date")
    moved = first + datetime.timedelta(a * 773 + b)
    new = {i: str(v).zfill(4 if v is moved.year else 2 if len(parts[i]) == 2 else 1) for i, v in zip(order, (moved.year, moved.month, moved.day), strict=True)}
    marks = regex.findall("[-/.]", was)
    return f"{new[0]}{marks[0]}{new[1]}{marks[1]}{new[2]}"


def issued(d):
    """First digits and lengths of issuers' cards."""
    n, two, three, four, six = len(d), int(d[:2]), int(d[:3]), int(d[:4]), int(d[:4])
    return (
        (d[0] == "4" and n in (13, 16, 19)) or (n == 16 and (51 <= two <= 55 or 2221 <= six <= 2720 or 3528 <= four <= 3589))
        or (n == 15 and two in (34, 37)) or (n == 14 and (300 <= three <= 305 or two in (36, 38, 39)))
        or (n in (16, 19) and (four == 6011 or 644 <= three <= 659)) or (two == 62 and 16 <= n <= 19)
    )


def cards(run):
    """A run of numbers with its cards replaced."""
    parts = regex.findall(r"\d+|\D+", run)
    out, i = [], 0
    while i < len(parts):
        found = []
        for size in range(1, 38, 2):
            groups, marks = parts[i : i + size : 2], parts[i + 1 : i + size : 2]
            digits, sizes = "".join(groups), [len(g) for g in groups]
            if not parts[i].isdigit() or len(parts[i : i + size]) < size or not 13 <= len(digits) <= 19 or luhn(digits) or not int(digits):
                continue
            usual = len(set(marks)) < 2 and sizes in ([4, 4, 4, 4], [4, 4, 4, 4, 3], [4, 6, 4], [4, 6, 5])
            odd = not {"."} & set(marks) and all(s in (4, 6, 8, 12) for s in sizes[:-1]) and sizes[-1] < 14
            alone = size == len(parts) and usual and not all(len(g) < 4 or g[:2] in ("19", "20") for g in groups)
            if size == 1 or (issued(digits) and (usual or odd)) or alone:
                found.append((usual or size == 1, len(digits), size))
        size = max(found)[2] if found else 1
        out.append(card("".join(parts[i : i + size])) if found else parts[i])
        i += size
    return "".join(out)


MAKE = {"email": email, "secret": secret, "iban": iban, "ip": ip, "date": date, "phone": phone}


def plain(text):
    if text is None:
        return None

    def between(part):
        return regex.sub(pii.PATTERNS["card"], lambda m: cards(m[0]), part)

    out, last = [], 0
    for m in regex.finditer(pii.ANY, text):
        kind = next(k for k in MAKE if regex.fullmatch(pii.PATTERNS[k], m[0]) or (k == "email" and "@" in m[0]))
        out += [between(text[last : m.start()]), MAKE[kind](m[0]) or m[0]]
        last = m.end()
    return "".join([*out, between(text[last:])])


RANDOM = random.Random(7)
TEXTS = [
    "years 2015 2016 2017 2018 2019 2020 2021 2022", "2015 2016 2017 2018", "order 1234 4111 1111 1111 1111 1225", "4111.1111.1111.1111, 4111  1111  1111  1111",
    "41111111 11111111", "3782 822463 10005 and 3782-822463-10005", "4111-1111 1111 1111", "4111 1111 1111 1111 4737 0976 8429 9439", "6304 0000 0000 0000 0 12",
    "иван@mail.ru Иван@mail.ru ИВАН@почта.рф", "田中@x.jp müller.ö@x.de STRAßE@x.de a1@x.com", "DE89 3704 0044 0532 0130 00 DE89370400440532013000 DE88370400440532013000",
    "GB82 WEST 1234 5698 7654 32 THE", "+1 (743) 555-3824, 743-555-3824", "152.143.123.131 300.1.1.1", "2021-02-28 3/14/2015 05.11.2020 25/3/2015 31.2.2020", "", None, "@ 1",
    *(" ".join(str(RANDOM.choice([4111, 5555, 37, RANDOM.randint(0, 10 ** RANDOM.randint(1, 8))])) for _ in range(14)) for _ in range(120)),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id int, text string")


def test_crafted_texts_agree(texts):
    got = {r.doc_id: r.text for r in pii.pseudonymize(texts, KEY).collect()}
    assert [got[i] for i in range(len(TEXTS))] == [plain(t) for t in TEXTS]


def test_documents_agree(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    found = pii.pseudonymize(docs, KEY).collect()
    was = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.text for r in found} == {i: plain(t) for i, t in was.items()}
    assert sum(r[f"n_{k}"] for r in found for k in pii.KINDS) > 0


def test_number_tables_and_years_stay(spark):
    tables = [" ".join(str(RANDOM.randint(0, 10 ** RANDOM.randint(1, 3))) for _ in range(12)) for _ in range(300)]
    tables += [" ".join(str(y) for y in range(start, start + 30)) for start in range(1900, 2070, 10)]
    tables += [" ".join(f"{RANDOM.random():.4f}" for _ in range(12)) for _ in range(100)]
    got = pii.pseudonymize(spark.createDataFrame(list(enumerate(tables)), "doc_id int, text string"), KEY).collect()
    assert {r.doc_id: r.text for r in got} == dict(enumerate(tables))


def test_every_letter_of_an_address_goes_and_case_links(texts):
    got = {r.doc_id: r for r in pii.pseudonymize(texts, KEY).collect()}
    first, second, third = got[9].text.split()
    assert first.endswith("@mail.ru") and not set("иван") & set(first[:4]) or first[:4] != "иван"
    assert first == second.lower() and third.endswith("@почта.рф") and got[9].n_email == 3
    assert got[11].n_iban == 2 and got[11].text.split()[-2] == "".join(got[11].text.split()[:6]) and got[12].text.endswith(" THE")


def test_long_runs_take_time_in_proportion(spark):
    long = " ".join(str(RANDOM.randint(1000, 9999)) for _ in range(100_000))
    start = time.perf_counter()
    assert pii.pseudonymize(spark.createDataFrame([(1, long)], "doc_id int, text string"), KEY).first().n_card > 0
    assert time.perf_counter() - start < 60
