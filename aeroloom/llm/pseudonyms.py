"""Format-preserving pseudonyms for personal data in texts, by Feistel permutations in DataFrame functions alone.

What is found is validated, turned into an index of its format and permuted there under a key: a card number becomes
another card number with a right check digit, a date another date, an address another address.  As each is a permutation,
equal values stay equal in all documents and different ones stay different, and who has the key can turn them back.

A numeric format with a * b values is an index (l, r) below a and b; in turn ``l += F(r) mod a`` and ``r += F(l) mod b``,
where F is SHA-256 over key, format, round and the other half.  Strings are permuted alike: each letter or digit of one
half moves within its alphabet by what the hash of the other half gives.  Values are few beside the text, which is
scanned by one regular expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from aeroloom.llm import text as T

ROUNDS = 10
DIGITS, LOWER, UPPER, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"
FIRST_DAY, DAYS = "1900-01-01", 73049  # to 2099-12-31; 17 * 4297

_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])"
_SECRET = r"(?<![A-Za-z0-9])(?i:password|passwd|pwd|token|secret|api[_-]?key)[ ]?[=:][ ]?[\"']?[A-Za-z0-9_+/.-]{8,256}+"
_ACCESS_KEY = r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"
#: Length of an IBAN by country, which says where one printed in groups ends.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_GROUPED_IBAN = "(?:" + "|".join(
    f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:[ -][A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (f"[ -][A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, countries in _IBAN_LENGTHS.items()) + ")"
_IBAN = r"(?<![A-Za-z0-9])(?:[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}|" + _GROUPED_IBAN + r")(?![A-Za-z0-9])"
_IP = r"(?<![A-Za-z0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![A-Za-z0-9]|\.[0-9])"
_ISO_DATE = r"(?<![A-Za-z0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9A-SU-Za-z-])"
_DATE = r"(?<![A-Za-z0-9./])[0-9]{2}([./])[0-9]{2}\1[0-9]{4}(?![A-Za-z0-9/])"
_PHONE = r"(?<![A-Za-z0-9+])(?:\+1[ .-]?)?(?:\([0-9]{3}\)[ ]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![A-Za-z0-9])"
# What begins behind a number and a blank or hyphen is not taken for more of its digits.
_OTHER = (r"[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2}|(?:[0-9]{1,3}\.){3}|[0-9]{2}[./][0-9]{2}[./]|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}"
          r"|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[A-Za-z0-9._%+-]{1,64}@")
_WORLD_PHONE = rf"(?<![A-Za-z0-9+])\+[0-9](?:[ -]?[0-9]){{6}}(?:[0-9]|[ -](?!{_OTHER})[0-9]){{1,8}}(?![A-Za-z0-9])"
_SSN = r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])"
_CARD = r"(?<![A-Za-z0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\3[0-9]{5})(?![A-Za-z0-9])"
# One look-behind for all, then what can begin with the character at hand: most places fail at once.
_ANY = ("(?<![A-Za-z0-9])(?:(?=[0-9+(])(?:" + "|".join([_EMAIL, _IP, _ISO_DATE, _DATE, _PHONE, _WORLD_PHONE, _SSN, _CARD])
        + ")|(?=[A-Za-z._%-])(?:" + "|".join([_EMAIL, _SECRET, _ACCESS_KEY, _IBAN]) + "))")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _is(c: Column, pattern: str) -> Column:
    """The whole of ``c`` is a match; back references count from 1 in each pattern by itself."""
    for group in (3, 2):
        if f"\\{group}" in pattern and "\\1" not in pattern:
            pattern = pattern.replace(f"\\{group}", f"\\{group - 1}")
    return c.rlike(f"^(?:{pattern})$")


def _hash_number(key: str, tag: str, round_: Column, half: Column) -> Column:
    text = F.concat_ws("|", F.lit(key), F.lit(tag), round_.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long")


def permute(index: Column, a: int, b: int, key: str, tag: str, inverse: bool = False) -> Column:
    """Keyed permutation of the numbers from 0 to a * b - 1."""
    start = F.struct(((index - index % b) / b).cast("long").alias("l"), (index % b).cast("long").alias("r"))
    sign = -1 if inverse else 1

    def turn(s: Column, k: Column) -> Column:
        left = k % 2 == 0
        h = _hash_number(key, tag, k, F.when(left, s["r"]).otherwise(s["l"]))
        return F.struct(F.when(left, F.pmod(s["l"] + sign * (h % a), F.lit(a))).otherwise(s["l"]).cast("long").alias("l"),
                        F.when(left, s["r"]).otherwise(F.pmod(s["r"] + sign * (h % b), F.lit(b))).cast("long").alias("r"))

    rounds = list(range(ROUNDS))[::sign]
    return F.aggregate(F.array(*[F.lit(k) for k in rounds]), start, turn, lambda s: s["l"] * b + s["r"])


def permute_digits(digits: Column, key: str, tag: str, inverse: bool = False) -> Column:
    """Keyed permutation of the digit strings of one length, up to 18 digits."""
    return _let(digits, lambda d: _permute_digits(d, key, tag, inverse))


def _permute_digits(digits: Column, key: str, tag: str, inverse: bool) -> Column:
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    a, b = (F.round(F.pow(F.lit(10.0), k)).cast("long") for k in (n - half, half))
    start = F.struct(F.substr(digits, F.lit(1), n - half).cast("long").alias("l"),
                     F.when(half > 0, F.substr(digits, n - half + 1, half).cast("long")).otherwise(F.lit(0).cast("long")).alias("r"))
    sign = -1 if inverse else 1

    def turn(s: Column, k: Column) -> Column:
        left = k % 2 == 0
        h = _hash_number(key, tag, F.concat_ws(":", k.cast("string"), n.cast("string")), F.when(left, s["r"]).otherwise(s["l"]))
        return F.struct(F.when(left, F.pmod(s["l"] + sign * (h % a), a)).otherwise(s["l"]).cast("long").alias("l"),
                        F.when(left, s["r"]).otherwise(F.pmod(s["r"] + sign * (h % b), b)).cast("long").alias("r"))

    def join(s: Column) -> Column:
        return F.concat(F.lpad(s["l"].cast("string"), n - half, F.lit("0")), F.when(half > 0, F.lpad(s["r"].cast("string"), half, F.lit("0"))).otherwise(F.lit("")))

    return F.aggregate(F.array(*[F.lit(k) for k in list(range(ROUNDS))[::sign]]), start, turn, join)


def _moved(c: Column, by: Column, alphabets: tuple[str, ...]) -> Column:
    """A character moved within its alphabet; any other stays."""
    out = c
    for letters in reversed(alphabets):
        at = F.instr(F.lit(letters), c)
        out = F.when(at > 0, F.substr(F.lit(letters), F.pmod(at - 1 + by, F.lit(len(letters))) + 1, F.lit(1))).otherwise(out)
    return out


def permute_string(value: Column, key: str, tag: str, alphabets: tuple[str, ...] = (DIGITS, LOWER, UPPER), inverse: bool = False) -> Column:
    """Keyed permutation of the strings with the same pattern of alphabets; signs stay where they are."""
    return _let(value, lambda v: _permute_string(v, key, tag, alphabets, inverse))


def _permute_string(value: Column, key: str, tag: str, alphabets: tuple[str, ...], inverse: bool) -> Column:
    n = F.length(value)
    cut = F.ceil(n / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), cut).alias("l"), F.substr(value, cut + 1, n).alias("r"))
    sign = -1 if inverse else 1

    def shifted(moving: Column, other: Column, k: Column) -> Column:
        stream = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), k.cast("string"), other), 512)
        return _let(stream, lambda hexes: F.array_join(F.transform(F.split(moving, ""), lambda c, i: _moved(
            c, sign * F.conv(F.substr(hexes, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int"), alphabets)), ""))

    def turn(s: Column, k: Column) -> Column:
        left = k % 2 == 0
        new = shifted(F.when(left, s["l"]).otherwise(s["r"]), F.when(left, s["r"]).otherwise(s["l"]), k)
        return F.struct(F.when(left, new).otherwise(s["l"]).alias("l"), F.when(left, s["r"]).otherwise(new).alias("r"))

    return F.aggregate(F.array(*[F.lit(k) for k in list(range(ROUNDS))[::sign]]), start, turn, lambda s: F.concat(s["l"], s["r"]))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _refill(shape: Column, digits: Column, skip: int = 0) -> Column:
    """``shape`` with its digits (after the first ``skip``) replaced in order by ``digits``."""
    def put(c: Column, i: Column, new: Column) -> Column:
        at = F.length(_digits(F.substr(shape, F.lit(1), i + 1))) - skip
        return F.when(c.rlike("[0-9]") & (at > 0), F.substr(new, at, F.lit(1))).otherwise(c)
    return _let(digits, lambda new: F.array_join(F.transform(F.split(shape, ""), lambda c, i: put(c, i, new)), ""))


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string, its last digit being the check digit."""
    return _let(digits, _luhn_sum)


def _luhn_sum(digits: Column) -> Column:
    n = F.length(digits)
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        return total + F.when((n - i) % 2 == 1, doubled(d)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _mod97(text: Column) -> Column:
    """Number that an IBAN's letters and digits stand for, modulo 97."""
    def add(total: Column, c: Column) -> Column:
        letter = F.instr(F.lit(UPPER), c)
        return F.when(letter > 0, (total * 100 + letter + 9) % 97).otherwise((total * 10 + F.instr(F.lit(DIGITS), c) - 1) % 97).cast("int")
    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _card(m: Column, key: str, inverse: bool) -> Column:
    def checked(body: Column) -> Column:
        return F.concat(body, F.pmod(F.lit(10) - luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string"))

    def new(d: Column) -> Column:
        body = F.concat(F.substr(d, F.lit(1), F.lit(1)), permute_digits(F.substr(d, F.lit(2), F.length(d) - 2), key, "card", inverse))
        return F.when(luhn_sum(d) % 10 == 0, _refill(m, _let(body, checked))).otherwise(m)
    return _let(_digits(m), new)


def _phone(m: Column, key: str, inverse: bool) -> Column:
    """North American numbers: area code and exchange from 200 to 999, and those below among themselves."""
    def written(n: Column) -> Column:
        rest = F.floor(n / 10000)
        return F.concat((F.floor(rest / 800) + 200).cast("string"), (rest % 800 + 200).cast("string"), F.lpad((n % 10000).cast("string"), 4, "0"))

    def new(d: Column) -> Column:
        area, exchange = F.substr(d, F.lit(1), F.lit(3)).cast("long"), F.substr(d, F.lit(4), F.lit(3)).cast("long")
        index = ((area - 200) * 800 + exchange - 200) * 10000 + F.right(d, F.lit(4)).cast("long")
        out = _let(permute(index, 80000, 80000, key, "phone", inverse), written)
        # Area codes below 200 are not given out, but written as numbers all the same: permuted among themselves.
        low = _let(permute((area * 800 + exchange - 200) * 10000 + F.right(d, F.lit(4)).cast("long"), 40000, 40000, key, "low phone", inverse),
                   lambda n: F.lpad((n + 2000000 + F.floor(n / 8000000) * 2000000).cast("string"), 10, "0"))
        # Nor are exchanges below 200.
        short = _let(permute((area * 200 + exchange) * 10000 + F.right(d, F.lit(4)).cast("long"), 50000, 40000, key, "low exchange", inverse), lambda n: F.concat(
            F.lpad(F.floor(n / 2000000).cast("string"), 3, "0"), F.lpad((F.floor(n / 10000) % 200).cast("string"), 3, "0"), F.lpad((n % 10000).cast("string"), 4, "0")))
        either = F.when(exchange < 200, short).when(area >= 200, out).otherwise(low)
        return F.when(F.length(_digits(m)) == 11, _refill(m, either, 1)).otherwise(_refill(m, either))
    return _let(F.right(_digits(m), F.lit(10)), new)


def _world_phone(m: Column, key: str, inverse: bool) -> Column:
    """International numbers: the first two digits, with the country in them, stay."""
    return _let(_digits(m), lambda d: _refill(m, permute_digits(F.substr(d, F.lit(3), F.length(d)), key, "world phone", inverse), 2))


def _ssn(m: Column, key: str, inverse: bool) -> Column:
    area, group, serial = (F.substr(m, F.lit(s), F.lit(n)).cast("long") for s, n in ((1, 3), (5, 2), (8, 4)))
    slot = F.when(area > 666, area - 2).otherwise(area - 1)

    def written(n: Column) -> Column:
        front = F.floor(n / 9999)
        place = F.floor(front / 99)
        area_out = F.when(place >= 665, place + 2).otherwise(place + 1)
        return F.concat_ws("-", F.lpad(area_out.cast("string"), 3, "0"), F.lpad((front % 99 + 1).cast("string"), 2, "0"), F.lpad((n % 9999 + 1).cast("string"), 4, "0"))

    out = _let(permute((slot * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999, key, "ssn", inverse), written)
    return F.when((area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0), out).otherwise(m)


def _ip(m: Column, key: str, inverse: bool) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda p: p.cast("long"))
    index = F.aggregate(parts, F.expr("0L"), lambda x, p: x * 256 + p)
    out = _let(permute(index, 65536, 65536, key, "ip", inverse), lambda n: F.array_join(F.transform(
        F.array(*[F.lit(s) for s in (24, 16, 8, 0)]), lambda s: (F.floor(n / F.pow(F.lit(2.0), s)).cast("long") % 256).cast("string")), "."))
    return F.when(F.forall(parts, lambda p: p < 256), out).otherwise(m)


def _date(m: Column, form: str, key: str, inverse: bool) -> tuple[Column, Column]:
    """Whether ``m`` is a date of the form, and its pseudonym."""
    day = F.try_to_timestamp(m, F.lit(form)).cast("date")
    index = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
    new = F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), permute(index, 17, DAYS // 17, key, f"date {form}", inverse).cast("int")), form)
    return (index >= 0) & (index < DAYS), new


def _dates(m: Column, forms: list[str], key: str, inverse: bool) -> Column:
    out = m
    for form in reversed(forms):
        good, new = _date(m, form, key, inverse)
        out = F.when(good, new).otherwise(out)
    return out


def _iban(m: Column, key: str, inverse: bool) -> Column:
    """Printed whole or in groups; in groups that fail the check, a card number is looked for."""
    def new(d: Column) -> Column:
        country, check, account = F.substr(d, F.lit(1), F.lit(2)), F.substr(d, F.lit(3), F.lit(2)), F.substr(d, F.lit(5), F.length(d))
        out = _let(permute_string(account, key, "iban", (DIGITS, UPPER), inverse), lambda new: F.concat(
            country, F.lpad((F.lit(98) - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0"), new))
        grouped = _let(out, lambda o: F.array_join(F.transform(F.split(m, ""), lambda c, i: F.when(c.rlike("[A-Z0-9]"), F.substr(
            o, F.length(F.regexp_replace(F.substr(m, F.lit(1), i + 1), "[ -]", "")), F.lit(1))).otherwise(c)), ""))
        card = F.regexp_extract(m, r"(?<![A-Za-z0-9])[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![A-Za-z0-9])", 0)
        other = _let(card, lambda c: F.when(c != "", F.replace(m, c, _card(c, key, inverse))).otherwise(m))
        return F.when(_mod97(F.concat(account, country, check)) == 1, F.when(F.length(d) == F.length(m), out).otherwise(grouped)).otherwise(other)
    return _let(F.regexp_replace(m, "[ -]", ""), new)


def _email(m: Column, key: str, inverse: bool) -> Column:
    """All but the top-level domain."""
    top = F.regexp_extract(m, r"\.[A-Za-z]+$", 0)
    return F.concat(permute_string(F.substr(m, F.lit(1), F.length(m) - F.length(top)), key, "email", inverse=inverse), top)


def _secret(m: Column, key: str, inverse: bool) -> Column:
    """The value behind the word; one of lower-case hexadecimal digits stays one."""
    value = F.regexp_extract(m, "[A-Za-z0-9_+/.-]{8,}$", 0)
    new = F.when(value.rlike("^[0-9a-f]+$"), permute_string(value, key, "hex", (HEX,), inverse)).otherwise(permute_string(value, key, "secret", inverse=inverse))
    return F.concat(F.substr(m, F.lit(1), F.length(m) - F.length(value)), new)


def pseudonym(m: Column, key: str, inverse: bool = False) -> Column:
    """Pseudonym of one match; what does not pass its validation stays."""
    return (F.when(_is(m, _EMAIL), _email(m, key, inverse))
            .when(_is(m, _SECRET), _secret(m, key, inverse))
            .when(_is(m, _ACCESS_KEY), F.concat(F.lit("AKIA"), permute_string(F.substr(m, F.lit(5), F.lit(16)), key, "access key", (DIGITS, UPPER), inverse)))
            .when(_is(m, _IBAN), _iban(m, key, inverse))
            .when(_is(m, _IP), _ip(m, key, inverse))
            .when(_is(m, _ISO_DATE), _dates(m, ["yyyy-MM-dd"], key, inverse))
            .when(_is(m, _DATE), F.when(F.substr(m, F.lit(3), F.lit(1)) == ".", _dates(m, ["dd.MM.yyyy"], key, inverse))
                  .otherwise(_dates(m, ["dd/MM/yyyy", "MM/dd/yyyy"], key, inverse)))
            .when(_is(m, _PHONE), _phone(m, key, inverse))
            .when(_is(m, _WORLD_PHONE), _world_phone(m, key, inverse))
            .when(_is(m, _SSN), _ssn(m, key, inverse))
            .when(_is(m, _CARD), _card(m, key, inverse))
            .otherwise(m))


def pseudonymise(docs: DataFrame, key: str, inverse: bool = False) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced; all other columns and all other text stay.

    Covers e-mail addresses, North American phone numbers with blanks, dots or hyphens, international ones ('+' and 8 to
    15 digits, with single blanks or hyphens or none), payment cards (Luhn), IBANs (mod 97; whole, or in groups of four with
    blanks or hyphens if the country is in ``_IBAN_LENGTHS``), US
    social security numbers, IPv4 addresses, dates from 1900 to 2099 (yyyy-mm-dd, dd.mm.yyyy, dd/mm/yyyy, and mm/dd/yyyy
    where the other order is no date), access keys and the values of passwords and tokens.  A number that fails its
    validation stays.  A null text stays null, an empty one empty.  ``inverse`` with the same key turns pseudonyms back
    (but for mm/dd/yyyy dates, whose pseudonyms may read as dd/mm/yyyy).
    """
    found, new, between = (T.free_name(docs.columns, n) for n in ("found", "new", "between"))
    any_found = F.size(F.col(found)) > 0
    # zip_with would lose the last stretch, which has no match behind it.
    rebuilt = F.array_join(F.transform(F.arrays_zip(F.col(between).alias("b"), F.col(new).alias("n")),
                                       lambda z: F.concat(z["b"], F.coalesce(z["n"], F.lit("")))), "")
    return (docs.withColumn(found, F.regexp_extract_all("text", F.lit(_ANY), F.lit(0)))
            .withColumn(new, F.when(any_found, F.transform(F.col(found), lambda m: pseudonym(m, key, inverse))))
            .withColumn(between, F.when(any_found, F.split("text", _ANY, -1)))
            .withColumn("text", F.when(any_found, rebuilt).otherwise(F.col("text")))
            .drop(found, new, between))
