"""Format-preserving pseudonyms for personal values, with DataFrame functions only.

Each kind of value is found by its pattern, checked, and replaced by the result of a keyed Feistel permutation of the same
format: a card number becomes another one with a right check digit, a date another date. The permutation depends on the key
and the value alone, so equal values stay equal in all documents, however they are punctuated, and different ones differ.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KEY = "change this key"
ALPHABET = "0123456789abcdef"

# Patterns of the kinds, in the order in which they are tried at a place. All begin where no letter, digit or underscore stands
# before, which is checked first and settles most places of a text.
KINDS = {
    "email": r"[A-Za-z0-9][\w.+-]*+@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\.[A-Za-z]{2,}",
    "secret": r"(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![\w])",
    "ip": r"(?<!\d\.)(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)",
    "date": r"(?<!\d[./-])(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})(?![\d]|[./-]\d)",
    "ssn": r"(?<!\d-)\d{3}-\d{2}-\d{4}(?![\d]|-\d)",
    "phone": r"(?<!\+)(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\d]|-\d)",
    "card": r"(?<!\d-)\d(?:[ -]?\d){12,18}(?![\d]|-\d)",
}
ANY = rf"(?<!\w)(?=[0-9A-Za-z+(])(?:{'|'.join(KINDS.values())})"

# 400 years of the calendar repeat; their days are 189 times 773. Numbers of the other two kinds that are valid, as products.
DAYS = (189, 773)
FIRST_DAY, FIRST_YEAR, LAST_YEAR = "1800-01-01", 1800, 2199
OCTETS = (1 << 16, 1 << 16)
AREAS, GROUPS, SERIALS = 898, 99, 9999


def _noise(key: str, kind: str, turn: Column, part: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), part.cast("string")).cast("binary"), 256)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used."""
    return F.transform(F.array(value), lambda x: use(x))[0]


def permuted_number(number: Column, radix: tuple[int, int], key: str, kind: str) -> Column:
    """A permutation of the numbers below the product of the two radixes."""

    def turn(state: Column, i: Column) -> Column:
        even = i % 2 == 0
        shift = F.conv(F.substring(_noise(key, kind, i, F.when(even, state["b"]).otherwise(state["a"])), 1, 15), 16, 10).cast("long")
        moved_a = F.pmod(state["a"] + F.pmod(shift, F.lit(radix[0])), F.lit(radix[0]))
        moved_b = F.pmod(state["b"] + F.pmod(shift, F.lit(radix[1])), F.lit(radix[1]))
        return F.struct(F.when(even, moved_a).otherwise(state["a"]).alias("a"), F.when(even, state["b"]).otherwise(moved_b).alias("b"))

    halves = F.struct(F.floor(number / radix[1]).cast("long").alias("a"), F.pmod(number, F.lit(radix[1])).cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), halves, turn, lambda s: s["a"] * radix[1] + s["b"])


def permuted_digits(digits: Column, radix: int, key: str, kind: str) -> Column:
    """A permutation of the strings of as many digits (radix 10 or 16; up to 64 of them)."""

    def turn(state: Column, i: Column) -> Column:
        noise = _noise(key, f"{kind}{radix}", i, F.concat_ws(":", F.length(state["a"]), state["b"]))

        def added(noise: Column, at: Column) -> Column:
            shift = F.conv(noise.substr(2 * at - 1, F.lit(2)), 16, 10).cast("int")
            value = F.call_function("locate", state["a"].substr(at, F.lit(1)), F.lit(ALPHABET)) - 1
            return F.lit(ALPHABET).substr(F.pmod(value + shift, F.lit(radix)) + 1, F.lit(1))

        moved = _let(noise, lambda x: F.array_join(F.transform(F.sequence(F.lit(1), F.length(state["a"])), lambda at: added(x, at)), ""))
        return F.struct(state["b"].alias("a"), moved.alias("b"))

    half = F.floor(F.length(digits) / 2).cast("int")
    start = F.struct(digits.substr(F.lit(1), half).alias("a"), digits.substr(half + 1, F.length(digits)).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: F.concat(s["a"], s["b"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refilled(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced by others in order."""

    def char(new: Column, at: Column) -> Column:
        own = value.substr(at, F.lit(1))
        return F.when(own.between("0", "9"), new.substr(F.length(_digits(value.substr(F.lit(1), at))), F.lit(1))).otherwise(own)

    return _let(digits, lambda x: F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), lambda at: char(x, at)), ""))


def _email(value: Column, key: str) -> Column:
    name = F.substring(_noise(key, "email", F.lit(0), F.lower(value)), 1, 16)
    return F.concat(F.lit("user-"), name, F.lit("@example.invalid"))


def _secret(value: Column, key: str) -> Column:
    return _let(permuted_digits(F.lower(value), 16, key, "secret"), lambda new: F.when(value == F.upper(value), F.upper(new)).otherwise(new))


def _ip(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda s, x: s * 256 + x)
    new = _let(permuted_number(number, OCTETS, key, "ip"), lambda x: F.concat_ws(".", *[F.pmod(F.shiftright(x, n), F.lit(256)).cast("string") for n in (24, 16, 8, 0)]))
    return F.when(F.forall(octets, lambda x: x <= 255), new)


def _date(value: Column, key: str) -> Column:
    """ISO dates, and month and day (or day and month, where only that is a date) before the year."""
    digits = _digits(value)
    iso = value.substr(5, 1) == "-"
    last = digits.substr(5, 4)

    def day(year: Column, month: Column, of_month: Column) -> Column:
        return F.try_to_date(F.concat_ws("-", year, month, of_month), "yyyy-MM-dd")

    month_first = day(last, digits.substr(1, 2), digits.substr(3, 2))
    day_first = day(last, digits.substr(3, 2), digits.substr(1, 2))
    found = F.when(iso, day(digits.substr(1, 4), digits.substr(5, 2), digits.substr(7, 2))).otherwise(F.coalesce(month_first, day_first))
    # A date before or after the 400 years takes the place of the same day in them.
    ok = found.isNotNull() & F.year(found).between(FIRST_YEAR, LAST_YEAR)
    start = F.lit(FIRST_DAY).cast("date")
    new = F.date_add(start, permuted_number(F.datediff(found, start).cast("long"), DAYS, key, "date").cast("int"))
    written = F.date_format(new, "yyyyMMdd")
    written = F.when(iso, written).otherwise(_let(written, lambda w: F.concat(F.when(month_first.isNotNull(), w.substr(5, 4)).otherwise(F.concat(w.substr(7, 2), w.substr(5, 2))), w.substr(1, 4))))
    return F.when(ok, _refilled(value, written))


def _ssn(value: Column, key: str) -> Column:
    digits = _digits(value)
    area, group, serial = (digits.substr(a, n).cast("long") for a, n in ((1, 3), (4, 2), (6, 4)))
    ok = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - F.when(area > 666, 2).otherwise(1)
    new = permuted_number((place * GROUPS + group - 1) * SERIALS + serial - 1, (AREAS * GROUPS, SERIALS), key, "ssn")

    def written(x: Column) -> Column:
        high = F.floor(x / SERIALS).cast("long")
        moved = F.floor(high / GROUPS).cast("long") + 1
        parts = (moved + F.when(moved >= 666, 1).otherwise(0), F.pmod(high, F.lit(GROUPS)) + 1, F.pmod(x, F.lit(SERIALS)) + 1)
        return F.concat_ws("-", *[F.lpad(p.cast("string"), n, "0") for p, n in zip(parts, (3, 2, 4), strict=True)])

    return F.when(ok, _let(new, written))


def _phone(value: Column, key: str) -> Column:
    digits = _digits(value)
    country = F.length(digits) - 10
    return _refilled(value, F.concat(digits.substr(F.lit(1), country), permuted_digits(digits.substr(country + 1, F.lit(10)), 10, key, "phone")))


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    body = permuted_digits(digits.substr(F.lit(1), F.length(digits) - 1), 10, key, "card")

    def checked(x: Column) -> Column:
        return F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda c: F.concat(x, c.cast("string"))), lambda n: F.call_function("luhn_check", n))[0]

    return F.when(F.call_function("luhn_check", digits), _refilled(value, _let(body, checked)))


_NEW: dict[str, Callable[[Column, str], Column]] = {"email": _email, "secret": _secret, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def _number_of(values: Column, kind: str) -> Column:
    return F.greatest(F.coalesce(F.size(F.filter(values, lambda x: x["kind"] == kind)), F.lit(0)), F.lit(0))


def pseudonymise(docs: DataFrame, text: str = "text", key: str = KEY, counts: str | None = None) -> DataFrame:
    """``docs`` with the personal values in ``text`` replaced; all other columns and rows stay as they are.

    With ``counts`` a map column of that name tells how many values of each kind were replaced. Kinds: e-mail addresses (a keyed
    name), hexadecimal secrets of 32 to 64 digits, IPv4 addresses, dates of 1800 to 2199, social security numbers, phone
    numbers of ten digits with or without +1, and card numbers of 13 to 19 digits. What fails its check (an octet over 255, a day
    that is none, a number that is never given, a wrong check digit) is left alone. Replaced values are of the same length
    and punctuation, but for e-mail and IPv4 addresses. A null text stays null, a text without values stays as it is.
    """
    value = F.col(text)
    touched = value.rlike("[0-9@]")

    def renamed(found: Column, kind: Column) -> Column:
        new = F.lit(None).cast("string")
        for name, rule in _NEW.items():
            new = F.when(kind == name, rule(found, key)).otherwise(new)
        return _let(new, lambda x: F.struct(F.when(x.isNotNull(), kind).alias("kind"), F.coalesce(x, found).alias("new")))

    def replaced(found: Column) -> Column:
        kind = F.lit(None).cast("string")
        for name in reversed(KINDS):
            kind = F.when(found.rlike(f"^(?:{KINDS[name]})$"), F.lit(name)).otherwise(kind)
        return _let(kind, lambda x: renamed(found, x))

    out = next(name for i in count() if (name := f"new_{text}_{i}") not in docs.columns)
    taken = F.transform(F.regexp_extract_all(value, F.lit(ANY), F.lit(0)), replaced)
    rows = docs.withColumn(out, F.when(touched, taken))
    # What stands between the values, and the values, in turn.
    between = F.split(value, ANY, -1)
    joined = F.array_join(F.zip_with(between, F.transform(F.col(out), lambda x: x["new"]), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    rows = rows.withColumn(text, F.when(F.col(out).isNull(), value).otherwise(joined))
    if counts:
        per_kind = [F.struct(F.lit(name).alias("kind"), _number_of(F.col(out), name).alias("n")) for name in KINDS]
        rows = rows.withColumn(counts, F.map_from_entries(F.array(*per_kind)))
    return rows.drop(out)
