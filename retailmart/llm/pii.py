"""Format-preserving pseudonyms for personal data in text.

Finds e-mail addresses, card numbers, bank accounts (IBAN), phone numbers, IPv4 addresses, calendar dates
and secret tokens, validates them (check digits, octets, real dates), and replaces
each by a keyed permutation within its format: digits stay digits, a card keeps a valid check
digit, a date stays a date, a letter stays in its script. Equal values give equal pseudonyms in every document, also
where the punctuation of a number differs.

The permutation is a balanced Feistel network over positions of any radix. Half the
positions are shifted by a keyed digest of the other half, then the halves change
roles. It is a bijection of exactly the values of the format, so nothing is
walked or rejected. A date is a pair (189 x 773 = 146,097 days, one Gregorian
cycle, here the years 1700 to 2099).

Defined results: NULL text stays NULL, without findings; an empty text stays empty; a text without
findings is returned unchanged, character for character; repeated rows are treated alike; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
FIRST_DAY, CYCLE = "1700-01-01", (189, 773)

# fixed values: what a candidate of each kind looks like; the order decides where two fit
BETWEEN = r"(?: {1,2}|[.-])"  # what may stand between the groups of a card
PATTERNS = {
    "email": r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]{1,64}+@(?:[\p{L}\p{M}\p{N}-]{1,63}+\.)++[\p{L}\p{M}]{2,63}",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}+|[0-9A-F]{32,128}+)(?![0-9A-Za-z])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4})(?: (?=[A-Z]{0,3}\d)[A-Z0-9]{4}){1,6}(?: (?=[A-Z]{0,2}\d)[A-Z0-9]{1,3})?)(?![\p{L}\p{N}])",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d]|[./-]\d)",
    "phone": r"(?<![\d\p{L}+])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}|\(\d{3}\) ?\d{3}[ -]\d{4}|\d{3}-\d{3}-\d{4})(?![\d]|-\d)",
    "card": rf"(?<![\d])\d(?:{BETWEEN}?\d){{12,}}+",  # a run of numbers, in which cards are looked for
}
KINDS = tuple(PATTERNS)
ANY = "|".join(f"(?:{p})" for k, p in PATTERNS.items() if k != "card")
# fixed values: the groups of a card, the usual ones first; longest first among the others
SHAPES = (
    r"^\d{4}( {1,2}|[.-])\d{4}\1\d{4}\1\d{4}(?:\1\d{3})(?!\d)",
    r"^\d{4}( {1,2}|[.-])\d{4}\1\d{4}\1\d{4}(?!\d)",
    r"^\d{4}( {1,2}|[.-])\d{6}\1\d{4,5}(?!\d)",
    r"^\d{13,19}(?!\d)",
    *(rf"^\d(?:(?: {{1,2}}|-)?\d){{{size - 1}}}(?!\d)" for size in range(19, 12, -1)),
)
USUAL = r"^(?:\d{13,19}|\d{4}( {1,2}|[.-])\d{4}\1\d{4}\1\d{4}(?:\1\d{3})?|\d{4}( {1,2}|[.-])\d{6}\2\d{4,5})$"
ODD = r"^(?:(?:\d{4}|\d{6}|\d{8}|\d{12})(?: {1,2}|-))+\d{1,13}$"
FIRST_GROUP = r"^(?:\d{4}|\d{6}|\d{8}|\d{12,19})$"
YEARS = r"^(?:(?:19|20)\d\d\D*)+$"
# fixed values: first digits and lengths of cards by issuer
ISSUED = (
    r"^(?:4\d{12}(?:\d{3}){0,2}|5[1-5]\d{14}|2(?:22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720)\d{12}|3[47]\d{13}|3(?:0[0-5]|[689]\d)\d{11}"
    r"|35(?:2[89]|[3-8]\d)\d{12}|6(?:011|4[4-9]\d|5\d\d)\d{12}(?:\d{3})?|62\d{14,17})$"
)
# fixed values: first code point and number of the digits and lower-case letters of common scripts
ALPHABETS = (
    (0x30, 10), (0x61, 26), (0xE0, 23), (0xF8, 8), (0x100, 128), (0x180, 208), (0x3B1, 25), (0x430, 48), (0x561, 38), (0x5D0, 27),
    (0x620, 43), (0x904, 54), (0xE01, 48), (0x3041, 86), (0x30A1, 90), (0x4E00, 20992), (0xAC00, 11172),
)
BLOCK = 64  # code points that other letters are permuted within


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, and written once into the expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def feistel(values: Column, radices: Column, tweak: Column, key: str, rounds: int = ROUNDS) -> Column:
    """Permute an array of ints, each below its radix; a bijection for every tweak, length and radices."""
    return _let(F.struct(values.alias("v"), radices.alias("r")), lambda x: _network(x["v"], x["r"], tweak, key, rounds))


def _network(values: Column, radices: Column, tweak: Column, key: str, rounds: int) -> Column:
    half = F.ceil(F.size(values) / 2).cast("int")

    def swapped(state: Column, number: Column) -> Column:
        moving, still, r, s = state["a"], state["b"], state["ra"], state["rb"]
        said = F.concat_ws(",", F.lit(key), tweak, number.cast("string"), F.size(moving).cast("string"), F.concat_ws(".", F.transform(still, lambda x: x.cast("string"))))
        # 16 positions of 16 bits from each digest
        digests = F.transform(F.sequence(F.lit(0), F.floor(F.size(moving) / 16).cast("int")), lambda i: F.sha2(F.concat_ws(":", said, i.cast("string")), 256))
        stream = F.concat_ws("", digests)

        def shifted(keys: Column) -> Column:
            return F.transform(moving, lambda x, i: ((x + F.conv(F.substr(keys, i * 4 + 1, F.lit(4)), 16, 10).cast("int")) % F.get(r, i)).cast("int"))

        return F.struct(still.alias("a"), _let(stream, shifted).alias("b"), s.alias("ra"), r.alias("rb"))

    start = F.struct(
        F.slice(values, F.lit(1), half).alias("a"),
        F.slice(values, half + 1, F.size(values)).alias("b"),
        F.slice(radices, F.lit(1), half).alias("ra"),
        F.slice(radices, half + 1, F.size(values)).alias("rb"),
    )
    rounds += rounds % 2  # an even number leaves the halves in place
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, swapped, lambda s: F.concat(s["a"], s["b"]))


def _letters(text: Column) -> Column:
    """The characters of a text."""
    return F.array_remove(F.split(text, ""), "")


def _digits(text: Column) -> Column:
    return F.transform(_letters(F.regexp_replace(text, "[^0-9]", "")), lambda c: c.cast("int"))


def _check_sum(digits: Column, odd: int) -> Column:
    """Luhn sum; every digit whose place from the right has the parity ``odd`` is doubled."""

    def weighed(total: Column, x: Column) -> Column:
        twice = F.when((x["i"] % 2) == odd, x["d"] * 2).otherwise(x["d"])
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    placed = F.transform(F.reverse(digits), lambda d, i: F.struct(d.alias("d"), i.alias("i")))
    return F.aggregate(placed, F.lit(0), weighed)


def _masked(text: Column, digits: Column, alphabet: str = "0-9", skip: Column | None = None) -> Column:
    """The text with its characters of the alphabet, past the first ``skip``, replaced in order."""
    skip = F.lit(0) if skip is None else skip
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))

    def put(state: Column, c: Column) -> Column:
        fits = c.rlike(f"^[{alphabet}]$")
        new = F.when(fits & (state["n"] >= skip), F.get(digits, state["n"] - skip)).otherwise(c)
        return F.struct(F.concat(state["out"], new).alias("out"), (state["n"] + F.when(fits, 1).otherwise(0)).alias("n"))

    return F.aggregate(_letters(text), start, put, lambda s: s["out"])


def _repeat(radix: int, n: Column) -> Column:
    return F.array_repeat(F.lit(radix), n)


def _texts(values: Column) -> Column:
    return F.transform(values, lambda x: x.cast("string"))


def _card(m: Column, key: str) -> Column:
    digits = _digits(m)
    body = F.slice(digits, F.lit(1), F.size(digits) - 1)
    moved = _let(body, lambda b: feistel(b, _repeat(10, F.size(b)), F.lit("card"), key))

    def checked(d: Column) -> Column:
        return F.concat(d, F.array(((F.lit(10) - (_check_sum(d, 0) % 10)) % 10).cast("int")))

    return _let(_texts(_let(moved, checked)), lambda d: _masked(m, d))


def _phone(m: Column, key: str) -> Column:
    """Ten last digits are permuted, all but the country code where the number is longer or shorter."""
    skip = F.greatest(F.size(_digits(m)) - 10, F.lit(0))
    body = _let(_digits(m), lambda d: F.slice(d, F.greatest(F.size(d) - 10, F.lit(0)) + 1, F.size(d)))
    moved = _let(body, lambda b: feistel(b, _repeat(10, F.size(b)), F.lit("phone"), key))
    return _let(_texts(moved), lambda d: _masked(m, d, skip=skip))


def _ip(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    return F.concat_ws(".", _texts(feistel(octets, _repeat(256, F.lit(4)), F.lit("ip"), key)))


def _secret(m: Column, key: str) -> Column:
    upper = m.rlike("[A-F]")
    values = F.transform(_letters(F.lower(m)), lambda c: F.instr(F.lit("0123456789abcdef"), c) - 1)
    moved = feistel(values, _repeat(16, F.size(values)), F.lit("secret"), key)
    out = F.concat_ws("", F.transform(moved, lambda x: F.substr(F.lit("0123456789abcdef"), x + 1, F.lit(1))))
    return F.when(upper, F.upper(out)).otherwise(out)


def _remainder(chars: Column) -> Column:
    """The remainder by 97 of characters read as numbers, A as 10."""

    def put(rest: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (rest * 10 + c.cast("int")) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(chars, F.lit(0), put)


def _account(m: Column) -> Column:
    """The characters of an account number, country and check digits last."""
    return _let(_letters(F.replace(m, F.lit(" "))), lambda c: F.concat(F.slice(c, F.lit(5), F.size(c)), F.slice(c, 1, 4)))


def _iban(m: Column, key: str) -> Column:
    """The account is permuted, digits among digits; the country stays and the check digits are made anew."""
    country = F.substr(m, F.lit(1), F.lit(2))
    plain = F.slice(_account(m), F.lit(1), F.char_length(F.replace(m, F.lit(" "))) - 4)

    def moved(chars: Column) -> Column:
        radices = F.transform(chars, lambda c: F.when(c.between("0", "9"), 10).otherwise(26))
        values = F.transform(chars, lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 65))
        new = feistel(values, radices, F.concat(F.lit("iban"), country), key)
        return F.zip_with(new, radices, lambda x, r: F.when(r == 10, x.cast("string")).otherwise(F.chr(x + 65)))

    def checked(chars: Column) -> Column:
        check = F.lit(98) - _remainder(F.concat(chars, _letters(F.concat(country, F.lit("00")))))
        return F.concat(_letters(F.concat(country, F.lpad(check.cast("string"), 2, "0"))), chars)

    return _let(_let(_let(plain, moved), checked), lambda c: _masked(m, c, "0-9A-Z"))


def _place(c: Column) -> Column:
    """Where a character stands: the first code point and the number of those it is permuted among, itself if it is no letter."""
    point = F.ascii(c)

    def among(first, number) -> Column:
        return F.struct(F.lit(first).cast("int").alias("first") if isinstance(first, int) else first.cast("int").alias("first"), F.lit(number).alias("radix"))

    out = F.when(c.rlike(r"^[\p{L}\p{N}]$"), among(point - point % BLOCK, BLOCK)).otherwise(among(point, 1))
    for first, number in reversed(ALPHABETS):
        out = F.when(point.between(first, first + number - 1), among(first, number)).otherwise(out)
    return out


def _character(point: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")


def _email(m: Column, key: str) -> Column:
    """Letters and digits of the local part are permuted within their alphabets; other characters, case and domain stay."""
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)

    def small(c: Column) -> Column:
        return F.when(F.char_length(F.lower(c)) == 1, F.lower(c)).otherwise(c)

    def renamed(chars: Column) -> Column:
        def moved(places: Column) -> Column:
            values = F.zip_with(chars, places, lambda c, p: F.ascii(small(c)) - p["first"])
            new = feistel(values, F.transform(places, lambda p: p["radix"]), F.concat(F.lit("email@"), F.lower(domain)), key)
            return F.zip_with(new, places, lambda x, p: _character(x + p["first"]))

        def cased(was: Column, now: Column) -> Column:
            return F.when((was != small(was)) & (F.char_length(F.upper(now)) == 1), F.upper(now)).otherwise(now)

        new = _let(F.transform(chars, lambda c: _place(small(c))), moved)
        return F.array_join(F.zip_with(chars, new, cased), "")

    return F.concat(_let(_letters(local), renamed), F.lit("@"), domain)


def _day(m: Column) -> Column:
    """The date of a match, NULL if it is none: year first, month first with slashes, day first with dots.

    A first number over 12 before a slash is a day.
    """
    parts = F.transform(F.split(m, "[-/.]"), lambda x: x.cast("int"))
    a, b, c = F.get(parts, 0), F.get(parts, 1), F.get(parts, 2)
    day_first = m.contains(".") | (m.contains("/") & (a > 12))
    year = F.when(m.contains("-"), a).otherwise(c)
    month = F.when(m.contains("-") | day_first, b).otherwise(a)
    day = F.when(m.contains("-"), c).when(day_first, a).otherwise(b)
    date = F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd")
    return F.when(year.between(1700, 2099), date)


def _date(m: Column, key: str) -> Column:
    a, b = CYCLE
    number = F.date_diff(_day(m), F.lit(FIRST_DAY).cast("date"))
    pair = _let(number, lambda n: F.array(F.floor(n / b).cast("int"), (n % b).cast("int")))
    moved = feistel(pair, F.array(F.lit(a), F.lit(b)), F.lit("date"), key)
    day = _let(moved, lambda v: F.date_add(F.lit(FIRST_DAY).cast("date"), F.get(v, 0) * b + F.get(v, 1)))
    return _let(day, lambda d: _dated(m, d))


def _dated(m: Column, day: Column) -> Column:
    """The day written as the match was."""
    day_first = m.contains(".") | (F.split(m, "[-/.]")[0].cast("int") > 12)
    wide = F.split(m, "[-/.]")
    two = lambda n, like: F.when(F.length(like) == 2, F.lpad(n.cast("string"), 2, "0")).otherwise(n.cast("string"))
    mark = F.when(m.contains("."), F.lit(".")).otherwise(F.lit("/"))
    head = F.when(day_first, F.concat_ws("|", two(F.dayofmonth(day), F.get(wide, 0)), two(F.month(day), F.get(wide, 1))))
    head = head.otherwise(F.concat_ws("|", two(F.month(day), F.get(wide, 0)), two(F.dayofmonth(day), F.get(wide, 1))))
    numbers = F.concat(F.replace(head, F.lit("|"), mark), mark, F.year(day).cast("string"))
    return F.when(m.contains("-"), F.date_format(day, "yyyy-MM-dd")).otherwise(numbers)


def kind_of(m: Column) -> Column:
    """The kind of a match after validation, NULL if it is nothing personal."""
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    return (
        F.when(m.contains("@"), F.lit("email"))
        .when(m.rlike("^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$"), "secret")
        .when(m.rlike(f"^(?:{PATTERNS['iban']})$"), F.when(_remainder(_account(m)) == 1, F.lit("iban")))
        .when(m.rlike(f"^(?:{PATTERNS['ip']})$"), F.when(F.forall(octets, lambda x: x <= 255), F.lit("ip")))
        .when(m.rlike(f"^(?:{PATTERNS['date']})$"), F.when(_day(m).isNotNull(), F.lit("date")))
        .when(m.rlike(f"^(?:{PATTERNS['phone']})$"), "phone")
    )


def _plain(text: Column) -> Column:
    return F.struct(text.alias("was"), F.lit(None).cast("string").alias("kind"))


def _cards(run: Column) -> Column:
    """A run of numbers as pieces ``(was, kind)``: its cards, and what stands between.

    A card has 13 to 19 digits and a valid check digit. It is one unbroken number, or groups with the first digits
    and the length of an issuer's cards: the usual groups, or groups of 4, 6, 8 or 12 digits and a rest. A run that is
    nothing but the usual groups may be of any issuer, but if all four look like years. Of cards that
    overlap the first counts. Time is linear in the numbers of the run.
    """

    def found(parts: Column) -> Column:
        def at(part: Column, i: Column) -> Column:
            tail = F.array_join(F.slice(parts, i + 1, F.lit(37)), "")
            first = _let(F.filter(_let(tail, shapes), valid), lambda good: F.get(good, F.lit(0)))
            return F.struct(i.alias("at"), F.when(part.rlike(FIRST_GROUP), first).alias("was"))

        def shapes(tail: Column) -> Column:
            return F.array(*[F.regexp_extract(tail, shape, 0) for shape in SHAPES])

        def valid(was: Column) -> Column:
            digits = F.regexp_replace(was, "[^0-9]", "")
            issued = digits.rlike(ISSUED) & (was.rlike(USUAL) | was.rlike(ODD))
            alone = (was == run) & was.rlike(USUAL) & ~was.rlike(YEARS)
            return (was != "") & (was.rlike(r"^\d+$") | issued | alone) & digits.rlike("[1-9]") & (_check_sum(_digits(was), 1) % 10 == 0)

        return F.filter(F.transform(parts, at), lambda w: w["was"].isNotNull())

    def chosen(cards: Column) -> Column:
        start = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<at:int,end:int,was:string>>").alias("all"))

        def put(state: Column, w: Column) -> Column:
            end = w["at"] + F.size(_parts(w["was"]))
            more = F.struct(w["at"].alias("at"), end.alias("end"), w["was"].alias("was"))
            return F.when(w["at"] < state["end"], state).otherwise(F.struct(end.alias("end"), F.concat(state["all"], F.array(more)).alias("all")))

        return F.aggregate(cards, start, put, lambda state: state["all"])

    def pieces(parts: Column, cards: Column) -> Column:
        def before(c: Column, i: Column) -> Column:
            end = F.coalesce(F.get(cards, i - 1)["end"], F.lit(0))
            return F.array(_plain(F.array_join(F.slice(parts, end + 1, c["at"] - end), "")), F.struct(c["was"].alias("was"), F.lit("card").alias("kind")))

        end = F.coalesce(F.get(cards, F.size(cards) - 1)["end"], F.lit(0))
        return F.concat(F.flatten(F.transform(cards, before)), F.array(_plain(F.array_join(F.slice(parts, end + 1, F.size(parts)), ""))))

    return _let(_parts(run), lambda parts: _let(_let(found(parts), chosen), lambda cards: pieces(parts, cards)))


def _parts(run: Column) -> Column:
    """Numbers and what stands between them."""
    return F.regexp_extract_all(run, F.lit(r"\d+|\D+"), F.lit(0))


def _split_cards(text: Column) -> Column:
    """A text between other findings as pieces ``(was, kind)``."""
    runs = F.transform(F.regexp_extract_all(text, F.lit(PATTERNS["card"]), F.lit(0)), _cards)
    gaps = F.transform(F.split(text, PATTERNS["card"], -1), lambda x: F.array(_plain(x)))
    return F.flatten(F.zip_with(gaps, runs, lambda a, b: F.concat(a, F.coalesce(b, F.array().cast("array<struct<was:string,kind:string>>")))))


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    made = {"email": _email, "secret": _secret, "iban": _iban, "ip": _ip, "date": _date, "phone": _phone, "card": _card}
    out = F.lit(None).cast("string")
    for name, make in made.items():
        out = F.when(kind == name, make(m, key)).otherwise(out)
    return F.coalesce(out, m)


def pseudonymize(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """All rows, ``text`` with pseudonyms, and ``n_<kind>`` counts; columns of these names are replaced.

    A text is cut at the candidates, these are replaced, and the pieces joined again.
    """
    counts = [f"n_{k}" for k in KINDS]
    columns = [c for c in df.columns if c not in counts]
    out = df.select(*columns, F.when(F.col(text).rlike("[0-9@]|[0-9a-fA-F]{32}"), F.col(text)).alias("__text"))
    out = out.select(*columns, F.regexp_extract_all("__text", F.lit(ANY), F.lit(0)).alias("__found"), F.split("__text", ANY, -1).alias("__between"))
    found = F.transform("__found", lambda m: F.array(F.struct(m.alias("was"), kind_of(m).alias("kind"))))
    between = F.transform("__between", _split_cards)
    parts = F.flatten(F.zip_with(between, found, lambda a, b: F.concat(a, F.coalesce(b, F.array().cast("array<struct<was:string,kind:string>>")))))
    out = out.select(*columns, parts.alias("__parts"))
    out = out.select(*columns, F.when(F.exists("__parts", lambda x: x["kind"].isNotNull()), F.col("__parts")).alias("__parts"))
    now = F.transform("__parts", lambda x: F.when(x["kind"].isNull(), x["was"]).otherwise(pseudonym(x["was"], x["kind"], key)))
    out = out.select(*columns, F.col("__parts.kind").alias("__kinds"), now.alias("__now"))
    new = F.when(F.col("__now").isNotNull(), F.concat_ws("", "__now")).otherwise(F.col(text))

    def number(kind: str) -> Column:
        return F.when(F.col("__kinds").isNull(), 0).otherwise(F.size(F.filter("__kinds", lambda k: k == kind))).cast("bigint")

    counted = [number(kind).alias(name) for kind, name in zip(KINDS, counts, strict=True)]
    return out.select(*[new.alias(c) if c == text else F.col(c) for c in columns], *counted)
