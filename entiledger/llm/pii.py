"""Format-preserving pseudonyms for personal data, in built-in functions only.

Validated numbers, addresses and dates are found in a text, and their symbols run through
a keyed Feistel network: places alternate between two halves, and each round adds to
every symbol of one half, modulo the symbol's own radix, a number drawn from a keyed
digest of the other half. The network permutes the values of a format. So equal values
get equal pseudonyms in all documents without any join, different values stay different,
and separators, case and length stay. Check digits are made anew, so that a valid number
gives a valid one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiledger.llm.common import spare

ROUNDS = 10
#: Key of the network where the caller gives none; a real run passes a secret.
KEY = "entiledger"

OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
ALONE, END = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"

#: Lengths of the account numbers of each country.
IBAN_SIZES = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST",
    26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}


def _account(size: int, countries: str) -> str:
    """Pattern of an account number of a length, with blanks between groups or without."""
    groups, rest = divmod(size - 4, 4)
    tail = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{tail}"


IBAN = ALONE + "(?:" + "|".join(_account(*x) for x in IBAN_SIZES.items()) + ")" + END
#: Of a country without a known length, or of another length than its country's.
OTHER_IBAN = ALONE + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + END
CARD = (
    ALONE + r"(?:[0-9]{13,19}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}"
    r"|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}|[0-9]{4} [0-9]{6} [0-9]{5}"
    r"|[0-9]{4}-[0-9]{6}-[0-9]{5})" + END
)
SSN = (
    r"(?<![A-Za-z0-9\-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}"
    r"(?![A-Za-z0-9\-])"
)
IP = r"(?<![A-Za-z0-9.])(?:" + OCTET + r"\.){3}" + OCTET + r"(?!\.?[A-Za-z0-9])"
DATE = (
    ALONE + r"(?:(?:18|19|20|21)[0-9]{2}-[0-9]{2}-[0-9]{2}(?:(?=T[0-9])|" + END + ")"
    r"|(?:[0-9]{2}/[0-9]{2}/(?:18|19|20|21)[0-9]{2}"
    r"|[0-9]{2}\.[0-9]{2}\.(?:18|19|20|21)[0-9]{2}"
    r"|[0-9]{2}-[0-9]{2}-(?:18|19|20|21)[0-9]{2})" + END + ")"
)
#: A digit of a phone number, in a group of its own only with another one behind it.
DIGIT = r"(?:(?:[ .\-]?\(|[ .\-])(?=[0-9]{2}))?[0-9]\)?"

#: The formats, in the order in which they are looked for. A phone number
#: has 8 to 15 digits, and ends where a value of another format follows it.
FORMATS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}+@"
    r"(?:[A-Za-z0-9\-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9\-])",
    "iban": f"(?:{IBAN}|{OTHER_IBAN})",
    "phone": r"(?<![A-Za-z0-9+])(?:\+1[ .\-]?(?:\([0-9]{3}\) ?|[0-9]{3}[ .\-]?)"
    r"[0-9]{3}[ .\-]?[0-9]{4}"
    r"|(?:1[ .\-])?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[.\-])[2-9][0-9]{2}[.\-][0-9]{4}"
    rf"|\+[2-9](?:{DIGIT}){{7}}(?:(?! (?:{CARD}|{SSN}|{IP}|{DATE})){DIGIT}){{0,7}})" + END,
    "card": CARD,
    "ssn": SSN,
    "ip": IP,
    "date": DATE,
}
#: Formats with a validation that a match may fail.
VALIDATED = ("iban", "card", "date")
#: (format, pattern) of each pass over what earlier passes leave.
PASSES = [
    step
    for kind, pattern in FORMATS.items()
    for step in ([(kind, IBAN), (kind, OTHER_IBAN)] if kind == "iban" else [(kind, pattern)])
]
#: What every value has at least one of; texts without are passed over.
HINT = "[0-9@]"

#: The days of a date's domain, from 1800-01-01 on, as two symbols of these radices; those
#: of the years 1800 to 2199; and how often a date is permuted at most until it is one of
#: them and reads as before, which two dates in three do and a part of 10**-25 never would.
FIRST_DAY, WIDE, NARROW = "1800-01-01", 400, 366
DAYS = 146_097
WALK = 64


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _chars(value: Column) -> Column:
    return F.split(value, "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def feistel(symbols: Column, radices: Column, tweak: Column, key: str) -> Column:
    """Permuted symbols: longs, each from 0 up to the radix of its place.

    The tweak and the radices pick a permutation of their own.
    """

    def turned(state: Column, turn: Column, radices: Column, domain: Column) -> Column:
        fixed = F.filter(state, lambda x, i: (i + turn) % 2 == 0)
        head = F.concat_ws(
            "|", domain, turn.cast("string"), F.array_join(fixed.cast("array<string>"), ",")
        )
        blocks = F.sequence(F.lit(0), F.floor((F.size(state) - 1) / 16).cast("int"))

        def digests(head: Column) -> Column:
            return F.transform(
                blocks, lambda b: F.sha2(F.concat_ws("|", head, b.cast("string")), 256)
            )

        def moved(x: Column, i: Column, drawn: Column) -> Column:
            place = F.floor(i / 2).cast("int")
            piece = F.substring(
                F.get(drawn, F.floor(place / 8).cast("int")), place % 8 * 8 + 1, F.lit(8)
            )
            number = F.conv(piece, 16, 10).cast("long")
            return F.when((i + turn) % 2 == 0, x).otherwise(
                F.pmod(x + number, F.get(radices, i))
            )

        return _let(
            _let(head, digests),
            lambda drawn: F.transform(state, lambda x, i: moved(x, i, drawn)),
        )

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return _let(
        radices,
        lambda r: _let(
            F.concat_ws(
                "|", F.lit(key), tweak, F.array_join(r.cast("array<string>"), ",")
            ),
            lambda domain: F.aggregate(
                rounds,
                symbols.cast("array<bigint>"),
                lambda state, turn: turned(state, turn, r, domain),
            ),
        ),
    )


def _spelt(value: Column, skip: Column, spare: Column, kind: str, key: str) -> Column:
    """A value whose letters and digits are permuted, but for some at either end.

    skip, spare: how many of them stay at the start and at the end. Digits stay digits
    and letters letters of their case. Separators stay and don't matter: a value written
    with others gets the same letters and digits.
    """

    def high(c: Column, i: Column) -> Column:
        """Area and exchange codes of a phone number start with 2 to 9."""
        return (F.lit(kind) == "phone") & i.isin(0, 3) & c.between(50, 57)

    def base(c: Column, i: Column) -> Column:
        return F.when(high(c, i), _long(50)).when(c < 58, _long(48)).otherwise(_long(97))

    def radix(c: Column, i: Column) -> Column:
        return F.when(high(c, i), _long(8)).when(c < 58, _long(10)).otherwise(_long(26))

    def permuted(codes: Column) -> Column:
        start = F.transform(codes, lambda c, i: c - base(c, i))
        moved = feistel(start, F.transform(codes, radix), F.lit(kind), key)
        return F.zip_with(
            F.transform(codes, base), moved, lambda b, m: F.char(b + m)
        )

    def placed(plain: Column, new: Column) -> Column:
        def at(c: Column, i: Column) -> Column:
            before = F.length(
                F.regexp_replace(F.substring(value, F.lit(1), i), "[^A-Za-z0-9]", "")
            )
            put = F.get(new, before - skip)
            inside = before.between(skip, F.length(plain) - spare - 1)
            return (
                F.when(~c.rlike("[A-Za-z0-9]") | ~inside, c)
                .when(c.rlike("[A-Z]"), F.upper(put))
                .otherwise(put)
            )

        return F.array_join(F.transform(_chars(value), at), "")

    def body(plain: Column) -> Column:
        cut = F.substring(plain, skip + 1, F.length(plain) - skip - spare)
        codes = F.transform(_chars(cut), lambda c: F.ascii(c).cast("long"))
        return _let(_let(codes, permuted), lambda new: placed(plain, new))

    return _let(F.lower(F.regexp_replace(value, "[^A-Za-z0-9]", "")), body)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of a string of digits, 0 for a valid number."""
    doubled = F.transform(
        _chars(F.reverse(digits)),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10


def _card(value: Column, key: str) -> Column:
    """Another card number, its last digit the check digit."""


    def checked(trunk: Column) -> Column:
        check = F.pmod(10 - luhn(F.concat(_digits(trunk), F.lit("0"))), F.lit(10))
        return F.concat(trunk, check.cast("string"))

    body = _spelt(value, F.lit(0), F.lit(1), "card", key)
    return _let(F.substring(body, F.lit(1), F.length(value) - 1), checked)


def _rest(value: Column, place: int) -> Column:
    """What a value has from a place on, counted from 1."""
    return F.substring(value, F.lit(place), F.length(value))


def mod97(packed: Column) -> Column:
    """Remainder by 97 of digits and capitals, A counting as 10."""
    return F.aggregate(
        F.transform(_chars(packed), F.ascii),
        F.lit(0),
        lambda a, c: F.when(c < 58, a * 10 + c - 48).otherwise(a * 100 + c - 55) % 97,
    )


def _iban(value: Column, key: str) -> Column:
    """Another account number of the same country, with its check digits."""


    def checked(body: Column) -> Column:
        country = F.substring(body, 1, 2)
        packed = F.concat(
            _rest(F.regexp_replace(body, " ", ""), 5), country, F.lit("00")
        )
        check = F.lpad((98 - mod97(packed)).cast("string"), 2, "0")
        return F.concat(country, check, _rest(body, 5))

    return _let(_spelt(value, F.lit(4), F.lit(0), "iban", key), checked)


def _ip(value: Column, key: str) -> Column:
    """Another address, each of its numbers of as many digits."""

    def base(p: Column) -> Column:
        return F.when(p < 10, 0).when(p < 100, 10).otherwise(100)

    def radix(p: Column) -> Column:
        return F.when(p < 10, _long(10)).when(p < 100, _long(90)).otherwise(_long(156))

    def moved(parts: Column) -> Column:
        start = F.transform(parts, lambda p: p - base(p))
        new = feistel(start, F.transform(parts, radix), F.lit("ip"), key)
        return F.array_join(
            F.zip_with(new, parts, lambda m, p: (m + base(p)).cast("string")), "."
        )

    return _let(F.split(value, r"\.").cast("array<int>"), moved)


def _parsed(value: Column, order: str) -> Column:
    spot = F.translate(value, "./", "--")
    return F.try_to_timestamp(spot, F.lit(order)).cast("date")


def _day(value: Column) -> Column:
    """The date that a value names, null for none; the day comes first if it can."""
    return F.coalesce(
        _parsed(value, "yyyy-MM-dd"),
        _parsed(value, "dd-MM-yyyy"),
        _parsed(value, "MM-dd-yyyy"),
    )


def _date(value: Column, key: str) -> Column:
    """Another date, written as the value is.

    The date is permuted until it is in the format's years and, written month first, does
    not read day first. So equal dates stay linked, and different ones different.
    """
    start = F.lit(FIRST_DAY).cast("date")
    order = (
        F.when(_parsed(value, "yyyy-MM-dd").isNotNull(), F.lit("yyyy-MM-dd"))
        .when(_parsed(value, "dd-MM-yyyy").isNotNull(), F.lit("dd-MM-yyyy"))
        .otherwise(F.lit("MM-dd-yyyy"))
    )

    def permuted(place: Column) -> Column:
        halves = F.array(F.floor(place / NARROW), place % NARROW)
        moved = feistel(halves, F.array(_long(WIDE), _long(NARROW)), F.lit("date"), key)
        return F.aggregate(moved, _long(0), lambda a, m: a * NARROW + m)

    def fits(place: Column, how: Column) -> Column:
        day = F.dayofmonth(F.date_add(start, place.cast("int")))
        return (place < DAYS) & ((how != "MM-dd-yyyy") | (day > 12))

    def walked(how: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(WALK)),
            F.date_diff(_day(value), start).cast("long"),
            lambda place, turn: F.when((turn > 1) & fits(place, how), place).otherwise(
                permuted(place)
            ),
        )

    def written(how: Column) -> Column:
        new = F.date_add(start, walked(how).cast("int"))
        day_first = F.when(how == "dd-MM-yyyy", F.date_format(new, "dd-MM-yyyy"))
        iso = F.when(how == "yyyy-MM-dd", F.date_format(new, "yyyy-MM-dd"))
        return F.coalesce(iso, day_first, F.date_format(new, "MM-dd-yyyy"))

    mark = F.regexp_extract(value, "[^0-9]", 0)
    return F.replace(_let(order, written), F.lit("-"), mark)


def _ssn(value: Column, key: str) -> Column:
    """Another social security number, of the numbers that may be given out.

    Its three parts are permuted among the 898 areas, 99 groups and 9999 serial numbers.
    """

    def moved(parts: Column) -> Column:
        area = F.get(parts, 0)
        places = F.array(
            area - F.when(area > 666, 2).otherwise(1), F.get(parts, 1) - 1, F.get(parts, 2) - 1
        ).cast("array<bigint>")
        radices = F.array(_long(898), _long(99), _long(9999))
        return _let(feistel(places, radices, F.lit("ssn"), key), spelt)

    def spelt(places: Column) -> Column:
        area = F.get(places, 0)
        parts = [
            (area + F.when(area >= 665, 2).otherwise(1), 3),
            (F.get(places, 1) + 1, 2),
            (F.get(places, 2) + 1, 4),
        ]
        return F.concat_ws("-", *[F.lpad(p.cast("string"), n, "0") for p, n in parts])

    return _let(F.split(value, "-").cast("array<int>"), moved)


def _valid(value: Column, kind: str) -> Column:
    """Whether a match of a format passes its validation."""
    if kind == "card":
        return luhn(_digits(value)) == 0
    if kind == "iban":
        plain = F.regexp_replace(value, " ", "")
        return mod97(F.concat(_rest(plain, 5), F.substring(plain, 1, 4))) == 1
    past = F.date_diff(_day(value), F.lit(FIRST_DAY).cast("date"))
    return F.coalesce(past.between(0, WIDE * NARROW - 1), F.lit(False))


def _apart(gaps: Column, values: Column) -> Column:
    return F.struct(gaps.alias("gaps"), values.alias("values"))


def _plain(open_text: Column, pattern: str) -> Column:
    """Text between the matches of a pattern, and the matches."""
    return _apart(
        F.split(open_text, pattern), F.regexp_extract_all(open_text, F.lit(pattern), F.lit(0))
    )


def _checked(open_text: Column, pattern: str, kind: str) -> Column:
    """Text between the valid values of a format, and these, the leftmost first.

    A value may start at every place, also within a match that isn't valid.
    """
    # The text is cut before every match, so each piece but perhaps the first starts one.
    ahead = f"(?={pattern})"

    def between(pieces: Column, a: Column, b: Column) -> Column:
        return F.array_join(F.slice(pieces, a + 1, b - a), "")

    def of(pieces: Column, found: Column) -> Column:
        # A match at the very start cuts no piece off.
        head = F.size(pieces) - F.size(found)

        def end(spots: Column, i: Column) -> Column:
            return F.coalesce(F.get(spots, i + 1), F.size(found))

        def room(spots: Column, spot: Column, i: Column) -> Column:
            return F.length(between(pieces, spot + head, end(spots, i) + head))

        def free(spots: Column, rooms: Column) -> Column:
            """Spots of values that no earlier one of them covers."""
            start = F.struct(
                F.array().cast("array<int>").alias("kept"), F.lit(0).alias("reach")
            )

            def step(state: Column, i: Column) -> Column:
                spot, clear = F.get(spots, i), state["reach"] <= 0
                reach = F.when(clear, F.length(F.get(found, spot))).otherwise(state["reach"])
                kept = F.when(clear, F.array_append(state["kept"], spot)).otherwise(
                    state["kept"]
                )
                return F.struct(kept.alias("kept"), (reach - F.get(rooms, i)).alias("reach"))

            order = F.sequence(F.lit(0), F.size(spots) - 1)
            covers = F.exists(
                order, lambda i: F.length(F.get(found, F.get(spots, i))) > F.get(rooms, i)
            )
            kept = F.aggregate(order, start, step, lambda state: state["kept"])
            return F.when(covers, kept).otherwise(spots)

        def cut_out(spots: Column) -> Column:
            first = between(pieces, F.lit(0), F.get(spots, F.lit(0)) + head)
            after = F.transform(
                spots,
                lambda spot, i: F.substring(
                    between(pieces, spot + head, end(spots, i) + head),
                    F.length(F.get(found, spot)) + 1,
                    F.length(open_text),
                ),
            )
            return _apart(
                F.concat(F.array(first), after),
                F.transform(spots, lambda spot: F.get(found, spot)),
            )

        def taken(spots: Column) -> Column:
            rooms = F.transform(spots, lambda spot, i: room(spots, spot, i))
            kept = _let(_let(rooms, lambda r: free(spots, r)), cut_out)
            none = _apart(F.array(open_text), F.array().cast("array<string>"))
            return F.when(F.size(spots) > 0, kept).otherwise(none)

        good = F.transform(
            found, lambda v, i: F.when(_valid(v, kind), i).otherwise(F.lit(None).cast("int"))
        )
        return _let(F.filter(good, lambda i: i.isNotNull()), taken)

    matches = F.regexp_extract_all(open_text, F.lit(f"(?=({pattern}))"), F.lit(1))
    none = _apart(F.array(open_text), F.array().cast("array<string>"))
    return _let(
        matches,
        lambda found: F.when(
            F.size(found) > 0,
            _let(F.split(open_text, ahead), lambda pieces: of(pieces, found)),
        ).otherwise(none),
    )


def _marked(text: Column) -> Column:
    """A text as an array of (gap, value, kind): what lies before each value, and it.

    The last has no value. Formats are looked for one after the other in what earlier
    ones leave, so a match that fails its validation hides no value of another format.
    """
    none = F.lit(None).cast("string")
    marked = F.array(F.struct(text.alias("gap"), none.alias("value"), none.alias("kind")))

    def split_up(kind: str, pattern: str) -> Callable[[Column], Column]:
        def of(entry: Column) -> Column:
            gap = entry["gap"]
            if kind in VALIDATED:
                return _let(_checked(gap, pattern, kind), lambda a: entries(entry, a))
            return _let(_plain(gap, pattern), lambda a: entries(entry, a))

        def entries(entry: Column, apart: Column) -> Column:
            values = apart["values"]
            last = F.size(values)
            return F.transform(
                apart["gaps"],
                lambda g, i: F.struct(
                    g.alias("gap"),
                    F.when(i < last, F.get(values, i)).otherwise(entry["value"]).alias("value"),
                    F.when(i < last, F.lit(kind)).otherwise(entry["kind"]).alias("kind"),
                ),
            )

        return of

    for kind, pattern in PASSES:
        marked = F.flatten(F.transform(marked, split_up(kind, pattern)))
    return marked


def _pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a value; the value itself where its kind is null."""
    none = F.lit(0)
    count = F.length(_digits(value))
    # A country code stays: what stands before the last ten digits of a number of the
    # North American plan, two digits of any other.
    code = F.when(value.rlike(r"^\+[2-9]"), F.lit(2)).otherwise(count - 10)
    top = F.length(F.substring_index(value, ".", -1))
    made = {
        "email": _spelt(value, none, top, "email", key),
        "iban": _iban(value, key),
        "phone": _spelt(value, code, none, "phone", key),
        "card": _card(value, key),
        "ssn": _ssn(value, key),
        "ip": _ip(value, key),
        "date": _date(value, key),
    }
    out = F.when(kind.isNull(), value)
    for name, new in made.items():
        out = out.when(kind == name, new)
    return out


def pseudonymise(
    docs: DataFrame, key: str = KEY, text: str = "text", into: str = "pii"
) -> DataFrame:
    """docs with pseudonyms in a text column, and the formats replaced in `into`.

    `into` is an array of format names in the order of the text, empty for a null or
    empty text and for one without personal data, which stay as they are. Values that
    fail their validation (a check digit, a calendar date, a count of digits) stay too.
    Each row is treated by itself, without a shuffle, so repeated rows get equal results;
    pseudonyms depend on nothing but the value and the key. Lengths don't change. Other
    columns stay; one that is already called `into` is replaced.
    """
    whole, inner = F.col(text), spare(docs, "_parts")
    parts = F.when(whole.rlike(HINT), _marked(whole))
    new = F.transform(
        F.col(inner),
        lambda m: F.concat(
            m["gap"], F.coalesce(_pseudonym(m["value"], m["kind"], key), F.lit(""))
        ),
    )
    kinds = F.filter(
        F.transform(F.col(inner), lambda m: m["kind"]), lambda k: k.isNotNull()
    )
    kept = [c for c in docs.columns if c != into]
    changed = F.size(inner) > 1
    return docs.select(*kept, parts.alias(inner)).select(
        *[
            F.when(changed, F.array_join(new, "")).otherwise(whole).alias(text)
            if c == text
            else F.col(c)
            for c in kept
        ],
        F.coalesce(kinds, F.array().cast("array<string>")).alias(into),
    )
