"""Format-preserving pseudonyms for personal data, on built-in functions.

Numbers and dates that pass their validation are permuted with a key within
their own format: card numbers stay valid card numbers, phone numbers phone
numbers, account numbers account numbers, dates dates. The permutation is a Feistel network over two parts of
the value with moduli of their own, so it can be undone with the key, no two
values share a pseudonym, and equal values stay equal in all documents. The
local part of a mail address is replaced by letters made from the whole address
and the key.

Defined results: a null text stays null and has no finds. What fails its
validation stays as it is, and so does every character outside of a find.
Repeated rows get equal results. An empty table gives no rows. All columns of
the documents pass through; ``n_private`` is added or replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.words import free_name

ROUNDS = 8
# The formats. Each stands alone, without letters or digits beside it.
EMAIL = r"[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])"
# Ten digits, in groups or whole after +1; a country code and digits in groups; a zero and digits in groups.
TEN = r"(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])(?![.-][0-9])"
AMERICAN = r"\+1[ .-]?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-]?)[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
_GAP = r"(?:[ ./-]| ?\(|\)[ ./-]?)?"
ABROAD = rf"(?:\+(?!1)|00(?=[1-9][0-9]{{0,2}}[ ./-]))[1-9](?:{_GAP}[0-9]){{7,14}}(?![0-9])"
TRUNK = r"(?:\(0[0-9]{2,4}\) ?|0[0-9]{2,4}[ /-])[0-9]{3,4}[ -]?[0-9]{3,5}(?![0-9A-Za-z])(?![ .-][0-9])"
PAIRS = r"0[0-9](?:[ .-][0-9]{2}){4}(?![0-9A-Za-z])(?![ .-][0-9])"
NATIONAL = rf"(?:1[ .-])?{TEN}|{PAIRS}|{TRUNK}"
PHONE = rf"{AMERICAN}|{ABROAD}|{NATIONAL}"
# Calling codes of one and two digits; all others have three.
COUNTRY = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
CARD = r"(?:{}|{}|[0-9]{{13,19}}+)(?![A-Za-z0-9])".format(
    *(
        rf"[0-9]{{4}}{gap}(?:[0-9]{{6}}{gap}[0-9]{{4,5}}|[0-9]{{4}}{gap}[0-9]{{4}}{gap}[0-9]{{4}}(?:{gap}[0-9]{{3}}(?![0-9]))?)"
        for gap in " -"
    )
)
SSN = r"(?:[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])|(?<![0-9][ -])[0-9]{3} [0-9]{2} [0-9]{4}(?![0-9A-Za-z-])(?! [0-9]))"
ADDRESS = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z])(?!\.[0-9])"
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}(?:(?=[Tt][0-9]{2})|(?![0-9A-Za-z-]))"
DAY_FIRST = r"[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}(?![0-9A-Za-z])"
# Lengths of international account numbers by country.
ACCOUNT_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}


def _account_pattern() -> str:
    """Account numbers whole or in groups of four."""
    kinds = []
    for length, countries in ACCOUNT_LENGTHS.items():
        groups, rest = divmod(length - 4, 4)
        tail = f" [A-Z0-9]{{{rest}}}" if rest else ""
        body = f"[A-Z0-9]{{{length - 4}}}|(?: [A-Z0-9]{{4}}){{{groups}}}{tail}"
        kinds.append(f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:{body})")
    return rf"(?=[A-Z]{{2}}[0-9]{{2}}[A-Z0-9 ])(?:{'|'.join(kinds)})(?![A-Za-z0-9])"


ACCOUNT = _account_pattern()
PRIVATE = (
    rf"(?<![A-Za-z0-9._%+-])(?:{EMAIL}|{ACCOUNT}|{DATE}|{DAY_FIRST}|{SSN}|{ADDRESS}|{CARD}|{NATIONAL})"
    rf"|(?<![A-Za-z0-9+])(?:{AMERICAN}|{ABROAD})"
)
# 1900-01-01 and the days up to 2099-12-31, which are 319 times 229.
FIRST_DAY, DAY_PARTS = "1900-01-01", (319, 229)
# Further turns until a day is above 12; two of five days are not, so this many in a row do not occur.
MOST_TURNS = 64


def permute(high: Column, low: Column, highs: Column, lows: Column, key: str, kind: str) -> Column:
    """Feistel network on ``high`` below ``highs`` and ``low`` below ``lows``; a struct of both.

    Each round adds a keyed number made from one part to the other part.
    """

    def step(state: Column, turn: Column) -> Column:
        one, other = state["high"], state["low"]
        even = turn % 2 == 0
        told = F.when(even, other).otherwise(one)
        return F.struct(
            F.when(even, F.pmod(one + _keyed(key, kind, turn, told), highs)).otherwise(one).alias("high"),
            F.when(even, other).otherwise(F.pmod(other + _keyed(key, kind, turn, told), lows)).alias("low"),
        )

    start = F.struct(high.cast("long").alias("high"), low.cast("long").alias("low"))
    return F.reduce(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _keyed(key: str, kind: str, turn: Column, value: Column) -> Column:
    """A number below 2^52 that only the key tells."""
    told = F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.sha2(told, 256), 1, 13), 16, 10).cast("long")


def _digits(value: Column, start: int, length: int) -> Column:
    return F.substring(value, start, length).cast("long")


def _padded(value: Column, length: Column | int) -> Column:
    return F.lpad(value.cast("string"), length, F.lit("0"))


def luhn_sum(digits: Column) -> Column:
    """Sum of Luhn over digits of which the last one counts once."""
    places = F.sequence(F.lit(1), F.length(digits))

    def counted(place: Column) -> Column:
        digit = F.substring(digits, place, F.lit(1)).cast("int")
        twice = digit * 2
        doubled = F.when(twice > 9, twice - 9).otherwise(twice)
        return F.when((F.length(digits) - place) % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.transform(places, counted), F.lit(0), lambda total, n: total + n)


def _digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _respelled(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced one by one; null where ``digits`` is."""

    def put(place: Column) -> Column:
        character = F.substring(value, place, F.lit(1))
        number = F.length(_digits_of(F.substring(value, F.lit(1), place)))
        return F.when(character.rlike("[0-9]"), F.substring(digits, number, F.lit(1))).otherwise(character)

    places = F.sequence(F.lit(1), F.length(value))
    return F.when(digits.isNotNull(), F.array_join(F.transform(places, put), ""))


def _card(value: Column, key: str) -> Column:
    """A card number in any grouping; three digits behind one of 16 may be no part of it."""
    digits = _digits_of(value)
    short = F.concat(_card_digits(F.substring(digits, 1, 16), key), F.substring(digits, 17, 3))
    grouped = F.when(value.rlike("[ -]") & (F.length(digits) == 19), short)
    return _respelled(value, F.coalesce(_card_digits(digits, key), grouped))


def _card_digits(value: Column, key: str) -> Column:
    """The first digit stays, the last is the check digit, and what is between is permuted."""
    middle = F.length(value) - 2
    left = (middle / 2).cast("int")
    highs, lows = (F.pow(F.lit(10), n).cast("long") for n in (left, middle - left))
    high = F.substring(value, F.lit(2), left).cast("long")
    low = F.substring(value, left + 2, middle - left).cast("long")
    new = permute(high, low, highs, lows, key, "card")
    body = F.concat(F.substring(value, 1, 1), _padded(new["high"], left), _padded(new["low"], middle - left))
    check = F.pmod(10 - luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10))
    return F.when(luhn_sum(value) % 10 == 0, F.concat(body, check.cast("string")))


def _phone(value: Column, key: str) -> Column:
    """Punctuation, country code and leading zero stay; a number has one pseudonym in all its groupings."""
    digits = _digits_of(value)
    kept = (
        F.when(value.startswith("+"), F.length(F.regexp_extract(digits, COUNTRY, 0)))
        .when(value.rlike(f"^(?:1[ .-])?{TEN}$"), F.length(digits) - 10)
        .when(value.rlike(f"^(?:{ABROAD})$"), 2 + F.length(F.regexp_extract(F.substring(digits, 3, 15), COUNTRY, 0)))
        .otherwise(F.lit(1))
    )
    rest = F.length(digits) - kept - 3
    high = F.substring(digits, kept + 1, F.lit(3)).cast("long")
    low = F.substring(digits, kept + 4, rest).cast("long")
    new = permute(high, low, F.lit(1000), F.pow(F.lit(10), rest).cast("long"), key, "phone")
    whole = F.concat(F.substring(digits, F.lit(1), kept), _padded(new["high"], 3), _padded(new["low"], rest))
    return _respelled(value, whole)


def _account(value: Column, key: str) -> Column:
    """Country and letters stay, all digits behind the check digits are permuted and these made anew."""
    body = F.replace(F.substring(value, F.lit(5), F.length(value)), F.lit(" "), F.lit(""))
    country, digits = F.substring(value, 1, 2), _digits_of(body)
    left = (F.length(digits) / 2).cast("int")
    right = F.length(digits) - left
    highs, lows = (F.pow(F.lit(10), n).cast("long") for n in (left, right))
    high, low = F.substring(digits, F.lit(1), left).cast("long"), F.substring(digits, left + 1, right).cast("long")
    new = permute(high, low, highs, lows, key, "account")
    permuted = F.concat(_padded(new["high"], left), _padded(new["low"], right))
    check = 98 - account_remainder(F.concat(_respelled(body, permuted), country, F.lit("00")))
    valid = account_remainder(F.concat(body, country, F.substring(value, 3, 2))) == 1
    spelled = F.concat(country, _respelled(F.substring(value, F.lit(3), F.length(value)), F.concat(_padded(check, 2), permuted)))
    return F.when(valid & (left > 0), spelled)


def account_remainder(characters: Column) -> Column:
    """Remainder by 97 of digits and letters, where A counts 10 and Z 35."""
    codes = F.transform(F.split(characters, ""), F.ascii)

    def appended(total: Column, code: Column) -> Column:
        return F.when(code >= 65, total * 100 + code - 55).otherwise(total * 10 + code - 48) % 97

    return F.aggregate(F.filter(codes, lambda c: c > 0), F.lit(0), appended)


def _ssn(value: Column, key: str) -> Column:
    """Areas 001 to 899 without 666, groups and serials without zero; the separator stays."""
    area, group, serial = _digits(value, 1, 3), _digits(value, 5, 2), _digits(value, 8, 4)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    new = permute(place * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn")
    turned = (new["high"] / 99).cast("long")
    new_area = F.when(turned >= 665, turned + 2).otherwise(turned + 1)
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    parts = (_padded(new_area, 3), _padded(new["high"] % 99 + 1, 2), _padded(new["low"] + 1, 4))
    gap = F.substring(value, 4, 1)
    return F.when(valid, F.concat(parts[0], gap, parts[1], gap, parts[2]))


def _address(value: Column, key: str) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("long"))
    high, low = parts[0] * 256 + parts[1], parts[2] * 256 + parts[3]
    new = permute(high, low, F.lit(65536), F.lit(65536), key, "address")
    octets = [(new[p] / 256).cast("long") if whole else new[p] % 256 for p in ("high", "low") for whole in (1, 0)]
    valid = F.forall(parts, lambda p: p <= 255)
    return F.when(valid, F.concat_ws(".", *[o.cast("string") for o in octets]))


def _day(day: Column, key: str) -> Column:
    number = F.date_diff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
    parts, per_part = DAY_PARTS
    new = permute((number / per_part).cast("long"), number % per_part, F.lit(parts), F.lit(per_part), key, "date")
    moved = F.date_add(F.lit(FIRST_DAY).cast("date"), (new["high"] * per_part + new["low"]).cast("int"))
    return F.when(number.between(0, parts * per_part - 1), moved)


def _date(value: Column, key: str) -> Column:
    return F.date_format(_day(F.try_to_date(value, "yyyy-MM-dd"), key), "yyyy-MM-dd")


def _day_first(value: Column, key: str) -> Column:
    """Both separators stay, and so does the way without leading zeros; the same day has the same pseudonym in every format that is not month-first.

    What is no date with the day first is taken with the month first. Its day is
    above 12 and so is that of its pseudonym, which can only be read in one way.
    """
    parts = F.split(value, "[./]")
    one, two, year = F.lpad(parts[0], 2, "0"), F.lpad(parts[1], 2, "0"), parts[2]
    gaps = F.regexp_replace(value, "[0-9]", "")
    short = (F.length(parts[0]) == 1) | (F.length(parts[1]) == 1)
    moved = _day(F.try_to_date(F.concat_ws("-", year, two, one), "yyyy-MM-dd"), key)
    start = _day(F.try_to_date(F.concat_ws("-", year, one, two), "yyyy-MM-dd"), key)
    turned = F.reduce(
        F.sequence(F.lit(1), F.lit(MOST_TURNS)),
        start,
        lambda day, _: F.when(F.dayofmonth(day) <= 12, _day(day, key)).otherwise(day),
    )

    def spelled(day: Column, first: str, second: str) -> Column:
        def number(form: str) -> Column:
            return F.when(short, F.date_format(day, form)).otherwise(F.date_format(day, form * 2))

        return F.concat(
            number(first), F.substring(gaps, 1, 1), number(second), F.substring(gaps, 2, 1), F.date_format(day, "yyyy")
        )

    return F.when(moved.isNotNull(), spelled(moved, "d", "M")).otherwise(spelled(turned, "M", "d"))


def _email(value: Column, key: str) -> Column:
    told = F.sha2(F.concat_ws("|", F.lit(key), F.lit("mail"), F.lower(value)), 256)
    letters = F.translate(F.substring(told, 1, 16), "0123456789", "ghijklmnop")
    return F.concat(letters, F.lit("@"), F.substring_index(value, "@", -1))


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a find, or null when it is not valid."""
    kinds = [
        (EMAIL, _email), (ACCOUNT, _account), (PHONE, _phone), (CARD, _card), (SSN, _ssn),
        (ADDRESS, _address), (DATE, _date), (DAY_FIRST, _day_first),
    ]
    result = F.lit(None).cast("string")
    for pattern, rule in kinds:
        result = F.when(value.rlike(f"^(?:{pattern})$"), rule(value, key)).otherwise(result)
    return result


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """Documents with pseudonyms in their texts and the number of finds replaced."""
    between = F.split("text", PRIVATE, -1)
    finds = F.regexp_extract_all("text", F.lit(PRIVATE), F.lit(0))
    replaced = F.transform(
        finds, lambda found: F.struct(found.alias("found"), pseudonym(found, key).alias("new"))
    )
    name = free_name(docs, "__finds")
    pieces = F.zip_with(
        between,
        name,
        lambda piece, f: F.concat(F.coalesce(piece, F.lit("")), F.coalesce(f["new"], f["found"], F.lit(""))),
    )
    n_private = F.coalesce(F.size(F.filter(name, lambda f: f["new"].isNotNull())), F.lit(0)).cast("long")
    text = F.when(F.col(name).isNull(), F.col("text")).otherwise(F.array_join(pieces, ""))
    found = docs.withColumn(name, F.when(F.col("text").rlike(PRIVATE), replaced))
    return found.withColumns({"n_private": n_private, "text": text}).drop(name)
