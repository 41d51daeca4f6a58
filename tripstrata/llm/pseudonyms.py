"""Format-preserving pseudonyms for personal numbers, dates and addresses, by keyed Feistel networks.

A value is recognised by its format and validated (check digit, calendar, octets, number ranges);
then a Feistel network with SHA-256 rounds permutes it within the values of that format. The same
key maps equal values to equal pseudonyms in every document, two values never to one, and the
holder of the key can turn it back (``invert=True``).

=======  ===================================================  ====================================
kind     recognised                                           permuted
=======  ===================================================  ====================================
card     13 to 19 digits with a right Luhn digit, adjacent    all between the first and the last
         or in groups with blanks or hyphens                  digit; the last is computed anew
phone    +c (ddd) ddd-dddd, (ddd) ddd-dddd and ddd-ddd-dddd   the ten digits; for +1 and without a
                                                              code a first digit of 2 to 9 stays
                                                              one, and so does 0 or 1
ssn      ddd-dd-dddd in its three ranges                      within these ranges
ip       four octets                                          all 32 bits
date     y-m-d, also before T and a time, d.m.y, m/d/y (or    the day within these 400 years, or
         d/m/y), 1800 to 2199; parts of one digit             those whose parts fit as many digits
email    name@host                                            letters and digits of the name, each
                                                              within its class
=======  ===================================================  ====================================

Everything is one projection of SQL functions: no shuffle, no Python. Defined results: NULL stays
NULL, texts without a valid value stay byte for byte, a value that looks right but does not validate
stays; extra columns pass unchanged, rows that repeat get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.text import fresh, let

ROUNDS = 10
EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}+@[A-Za-z0-9](?:[A-Za-z0-9\-]*\.)+[A-Za-z]{2,}"
PHONE = r"(?<![\w+])\+\d{1,3}[ .\-]?\(\d{3}\)[ .\-]?\d{3}[ .\-]\d{4}(?!\d)"
AREA_PHONE = r"(?<![\w+)])\(\d{3}\)[ .\-]?\d{3}[ .\-]\d{4}(?!\d)"
PLAIN_PHONE = r"(?<![\w.\-])\d{3}-\d{3}-\d{4}(?![\w\-])"
SSN = r"(?<![\w.\-])\d{3}-\d{2}-\d{4}(?![\w\-])"
IP = r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)"
ISO_DATE = r"(?<![\w.\-])\d{4}-\d{1,2}-\d{1,2}(?:(?![\w\-])|(?=[Tt]\d{2}))"
DOT_DATE = r"(?<![\w.])\d{1,2}\.\d{1,2}\.\d{4}(?!\w|\.\d)"
SLASH_DATE = r"(?<![\w/])\d{1,2}/\d{1,2}/\d{4}(?![\w/])"
CARD = r"(?<![\w.])\d{13,19}(?!\w|\.\d)"
#: Four by four, 4-6-5 and 4-6-4, and 6-13, with the same mark between all groups.
GROUPED_CARD = r"(?<![\w.\-])(?:" + "|".join(
    rf"\d{{4}}{s}\d{{4}}{s}\d{{4}}{s}\d{{4}}{s}\d{{1,3}}|\d{{4}}{s}\d{{4}}{s}\d{{4}}{s}\d{{1,4}}"
    rf"|\d{{4}}{s}\d{{6}}{s}\d{{4,5}}|\d{{6}}{s}\d{{13}}" for s in (" ", "-")) + r")(?!\w|-\w|\.\d)"
ANY = "|".join(f"(?:{p})" for p in (
    EMAIL, PHONE, AREA_PHONE, PLAIN_PHONE, SSN, ISO_DATE, DOT_DATE, SLASH_DATE, IP, GROUPED_CARD, CARD))
KINDS = ("card", "phone", "ssn", "ip", "date", "email")
#: 400 Gregorian years have 146,097 days, which is 189 times 773.
FIRST_DAY, LEFT_DAYS, RIGHT_DAYS = "1800-01-01", 189, 773
#: Steps to a day that is written with as many digits; at least a fifth of all days are.
STEPS = 300
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def round_value(secret: str, kind: str, turn: Column, half: Column) -> Column:
    """60 bits that depend on the key, the kind of value, the round and the other half."""
    data = F.concat_ws("|", F.lit(secret), F.lit(kind), turn.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(data, 256), 1, 15), 16, 10).cast("long")


def feistel(value: Column, left: Column, right: Column, secret: str, kind: str, invert: bool = False) -> Column:
    """Keyed permutation of 0 .. left * right - 1: the halves take turns to be shifted by a hash of the other."""
    turns = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if invert else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    sign = -1 if invert else 1

    def step(s: Column, turn: Column) -> Column:
        a, b = s["a"], s["b"]
        return F.when(turn % 2 == 0, F.struct(
            F.pmod(a + sign * F.pmod(round_value(secret, kind, turn, b), left), left).alias("a"), b.alias("b"))
        ).otherwise(F.struct(
            a.alias("a"), F.pmod(b + sign * F.pmod(round_value(secret, kind, turn, a), right), right).alias("b")))

    start = F.struct(((value - F.pmod(value, right)) / right).cast("long").alias("a"), F.pmod(value, right).alias("b"))
    return F.aggregate(turns, start, step, lambda s: s["a"] * right + s["b"])


def long(n: int) -> Column:
    return F.lit(n).cast("long")


def power_of_ten(n: Column) -> Column:
    return F.element_at(F.array(*[long(10 ** k) for k in range(10)]), n + 1)


def padded(value: Column, width: Column) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def luhn_digit(payload: Column) -> Column:
    """The check digit for ``payload``, as a number."""
    n = F.length(payload)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(payload, n - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    return F.pmod(10 - F.pmod(F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add), F.lit(10)), F.lit(10))


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def with_digits(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced by ``digits``, one after another."""
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: let(
        F.substr(value, i, F.lit(1)), lambda c: F.when(c.rlike(r"\d"), F.substr(
            digits, F.length(digits_of(F.substr(value, F.lit(1), i))), F.lit(1))).otherwise(c))), "")


def new_card(value: Column, secret: str, invert: bool) -> Column:
    def moved(digits: Column) -> Column:
        inner = F.substr(digits, F.lit(2), F.length(digits) - 2)
        n = F.length(inner)
        half = F.floor(n / 2).cast("int")
        middle = padded(feistel(inner.cast("long"), power_of_ten(half), power_of_ten(n - half), secret, "card", invert), n)
        payload = F.concat(F.substring(digits, 1, 1), middle)
        valid = luhn_digit(F.substr(digits, F.lit(1), F.length(digits) - 1)) == F.substr(
            digits, F.length(digits), F.lit(1)).cast("int")
        return F.when(valid, F.concat(payload, luhn_digit(payload).cast("string")))

    return let(let(digits_of(value), moved), lambda new: F.when(value.rlike(r"\D"), F.when(
        new.isNotNull(), with_digits(value, new))).otherwise(new))


def new_phone(value: Column, secret: str, invert: bool) -> Column:
    lead = F.regexp_extract(value, r"^\+\d{1,3}[ .\-]?(?=\()", 0)

    def moved(ten: Column) -> Column:
        def within(left: int, kind: str, least: int = 0) -> Column:
            number = ten.cast("long") - least
            return padded(feistel(number, long(left), long(100_000), secret, kind, invert) + least, F.lit(10))

        # The plan of +1, which numbers without a code follow, has first digits from 2 on; others are kept apart.
        return F.when(~digits_of(lead).isin("", "1"), within(100_000, "phone-any")).when(
            F.substring(ten, 1, 1).cast("int") >= 2, within(80_000, "phone", 2 * 10 ** 9)).otherwise(
            within(20_000, "phone-low"))

    rest = F.substr(value, F.length(lead) + 1)
    return F.concat(lead, let(let(F.right(digits_of(value), F.lit(10)), moved), lambda new: with_digits(rest, new)))


def new_ssn(value: Column, secret: str, invert: bool) -> Column:
    area, group, serial = (F.substring(value, *p).cast("long") for p in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    number = (area - 1 - F.when(area > 666, 1).otherwise(0)) * (99 * 9999) + (group - 1) * 9999 + (serial - 1)
    moved = feistel(number, long(898), long(99 * 9999), secret, "ssn", invert)
    low = F.pmod(moved, long(99 * 9999))
    first = ((moved - low) / (99 * 9999)).cast("long") + 1
    last = F.pmod(low, long(9999))
    return F.when(valid, F.concat_ws(
        "-", padded(first + F.when(first >= 666, 1).otherwise(0), F.lit(3)),
        padded(((low - last) / 9999).cast("long") + 1, F.lit(2)), padded(last + 1, F.lit(4))))


def new_ip(value: Column, secret: str, invert: bool) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda o: o.cast("long"))
    number = F.aggregate(octets, long(0), lambda a, o: a * 256 + o)
    moved = feistel(number, long(65_536), long(65_536), secret, "ip", invert)
    shown = F.concat_ws(".", *[F.pmod(F.shiftright(moved, s), long(256)).cast("string") for s in (24, 16, 8, 0)])
    return F.when(F.forall(octets, lambda o: o <= 255), shown)


def new_date(value: Column, secret: str, invert: bool) -> Column:
    first = F.to_date(F.lit(FIRST_DAY))

    def step(day: Column) -> Column:
        number = F.datediff(day, first).cast("long")
        return F.date_add(first, feistel(number, long(LEFT_DAYS), long(RIGHT_DAYS), secret, "date", invert).cast("int"))

    def moved(p: Column) -> Column:
        """For year, month and day as they are written."""
        year, month, day = p["y"], p["m"], p["d"]
        short = (F.length(month) == 1) | (F.length(day) == 1)

        def go(old: Column) -> Column:
            return let(step(old), lambda new: F.struct(new.alias("day"), (
                ((F.length(month) == 2) | (F.month(new) < 10)) & ((F.length(day) == 2) | (F.day(new) < 10))).alias("fits")))

        def shown(new: Column) -> Column:
            y, m, d = F.year(new).cast("string"), *(
                F.right(padded(n, F.lit(2)), F.length(old)) for n, old in ((F.month(new), month), (F.day(new), day)))
            return F.when(value.contains("-"), F.concat_ws("-", y, m, d)).when(
                value.contains("."), F.concat_ws(".", d, m, y)).when(p["us"], F.concat_ws("/", m, d, y)).otherwise(
                F.concat_ws("/", d, m, y))

        def new(old: Column) -> Column:
            # The permutation is applied until the day can be written as the old one, which permutes such days.
            steps = F.when(short, F.sequence(F.lit(1), F.lit(STEPS))).otherwise(F.array().cast("array<int>"))
            walked = F.aggregate(steps, go(old), lambda s, _: F.when(s["fits"], s).otherwise(go(s["day"])))
            return F.when(F.datediff(old, first).between(0, LEFT_DAYS * RIGHT_DAYS - 1), let(walked, lambda s: F.when(
                s["fits"], shown(s["day"]))))

        return let(F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd"), new)

    def parts(p: Column) -> Column:
        a, b, c = (F.get(p, F.lit(i)) for i in range(3))
        iso, us = value.contains("-"), value.contains("/") & (a.cast("int") <= 12)
        return F.struct(F.when(iso, a).otherwise(c).alias("y"), F.when(us, a).otherwise(b).alias("m"),
                        F.when(iso, c).when(us, b).otherwise(a).alias("d"), us.alias("us"))

    return let(let(F.split(value, r"\D"), parts), moved)


def new_email(value: Column, secret: str, invert: bool) -> Column:
    """Each round shifts the letters and digits of one half of the name within their classes.

    A name of one character has no halves: it is shifted by what its host gives, never by nothing.
    """
    name = F.substring_index(value, "@", 1)
    middle = F.floor(F.length(name) / 2).cast("int")
    turns = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if invert else F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def shifted(half: Column, other: Column, turn: Column) -> Column:
        by = F.sha2(F.concat_ws("|", F.lit(secret), F.lit("email"), turn.cast("string"), other), 256)

        def one(i: Column) -> Column:
            c = F.substr(half, i, F.lit(1))
            move = F.conv(F.substr(by, F.pmod(i * 2 - 2, F.lit(60)) + 1, F.lit(4)), 16, 10).cast("int")
            out = c
            for letters in (LOWER, UPPER, DIGITS):
                place = F.instr(F.lit(letters), c)
                new = F.pmod(place - 1 + (-move if invert else move), F.lit(len(letters))) + 1
                out = F.when((c != "") & (place > 0), F.substr(F.lit(letters), new, F.lit(1))).otherwise(out)
            return out

        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(half)), one), "")

    def step(s: Column, turn: Column) -> Column:
        return F.when(turn % 2 == 0, F.struct(shifted(s["a"], s["b"], turn).alias("a"), s["b"].alias("b"))).otherwise(
            F.struct(s["a"].alias("a"), shifted(s["b"], s["a"], turn).alias("b")))

    start = F.struct(F.substr(name, F.lit(1), middle).alias("a"), F.substr(name, middle + 1).alias("b"))
    moved = F.aggregate(turns, start, step, lambda s: F.concat(s["a"], s["b"]))
    host = F.substr(value, F.length(name) + 1)
    by = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(secret), F.lit("email"), F.lower(host)), 256), 1, 15), 16, 10)
    single = name
    for letters in (LOWER, UPPER, DIGITS):
        place, move = F.instr(F.lit(letters), name), F.pmod(by.cast("long"), long(len(letters) - 1)).cast("int") + 1
        new = F.pmod(place - 1 + (-move if invert else move), F.lit(len(letters))) + 1
        single = F.when(place > 0, F.substr(F.lit(letters), new, F.lit(1))).otherwise(single)
    return F.concat(F.when(F.length(name) == 1, single).otherwise(moved), host)


def kind_of(value: Column) -> Column:
    def whole(pattern: str) -> Column:
        return value.rlike(f"^(?:{pattern})$")

    return (F.when(value.contains("@"), "email").when(whole(PHONE) | whole(AREA_PHONE) | whole(PLAIN_PHONE), "phone")
            .when(whole(SSN), "ssn").when(whole(ISO_DATE) | whole(DOT_DATE) | whole(SLASH_DATE), "date")
            .when(whole(IP), "ip").otherwise("card"))


def pseudonym(value: Column, kind: Column, secret: str, invert: bool = False) -> Column:
    """The pseudonym of a value of ``kind``; NULL if it does not validate."""
    makers = {"card": new_card, "phone": new_phone, "ssn": new_ssn, "ip": new_ip, "date": new_date, "email": new_email}
    out = F.lit(None).cast("string")
    for name, make in makers.items():
        out = F.when(kind == name, make(value, secret, invert)).otherwise(out)
    return out


def pseudonymise(documents: DataFrame, secret: str, text: str = "text", invert: bool = False) -> DataFrame:
    """``documents`` with valid values in ``text`` replaced, and ``n_<kind>`` counts of them added."""
    own = documents[text]
    may = own.rlike("[0-9@]")
    none = F.array().cast("array<string>")
    own_values, renewed = fresh(documents, "_found", "_new")
    found = documents.select("*", F.when(may, F.regexp_extract_all(own, F.lit(ANY), 0)).otherwise(none).alias(own_values))
    values = found.withColumn(renewed, F.transform(own_values, lambda v: F.struct(
        v.alias("old"), kind_of(v).alias("kind")))).withColumn(renewed, F.transform(renewed, lambda m: F.struct(
            m["old"].alias("old"), m["kind"].alias("kind"), pseudonym(m["old"], m["kind"], secret, invert).alias("new"))))
    filled = let(F.split(F.col(text), ANY), lambda gaps: F.concat(F.element_at(gaps, 1), F.array_join(F.transform(
        F.col(renewed), lambda m, i: F.concat(F.coalesce(m["new"], m["old"]), F.get(gaps, i + 1))), "")))

    def count(kind: str) -> Column:
        return F.size(F.filter(renewed, lambda m: (m["kind"] == kind) & m["new"].isNotNull())).cast("long")

    return values.select(
        *[F.when(F.size(own_values) > 0, filled).otherwise(F.col(c)).alias(c) if c == text else F.col(c)
          for c in documents.columns],
        *[count(k).alias(f"n_{k}") for k in KINDS])
