"""Format-preserving Feistel pseudonyms for personal data, in DataFrame functions only."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

# What may be personal: each form as it starts in a text, the longer forms first. No form can match inside a word.
_START, _END = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}"
SECRET = r"(?i:password|passwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9+/_-]{8,}+"
CLOUD_KEY = r"AKIA[0-9A-Z]{16}"
PHONE = r"\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}"
NATIONAL_PHONE = r"\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}"
ISO_DATE = r"\d{4}-\d{2}-\d{2}"
DAY_DATE = r"\d{1,2}[./]\d{1,2}[./]\d{4}"
#: The date of a timestamp such as 2024-01-05T10:00:00Z; the time stays.
STAMP_DATE = r"\d{4}-\d{2}-\d{2}(?=T\d{2}:?\d{2})"
#: Country calling codes, fixed values: 1 and 7, those of two digits; all others have three.
CALLING_CODE = r"\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{1,3})"
SOCIAL = r"\d{3}-\d{2}-\d{4}"
ADDRESS = r"(?<!\d\.)\d{1,3}(?:\.\d{1,3}){3}(?!\.\d)"
#: Countries by the length of their IBANs, so that a match ends where the IBAN does.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_of(length: int, countries: str) -> str:
    groups, rest = divmod(length - 4, 4)
    return rf"(?:{countries.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}" + (rf" ?[A-Z0-9]{{{rest}}}" if rest else "")


# What has another length or country is looked at as far as it goes.
IBAN = "|".join([*(_iban_of(n, c) for n, c in IBAN_LENGTHS.items()), r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"])
CARD = r"\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19}"
FORMS = (EMAIL, SECRET, CLOUD_KEY, ISO_DATE, DAY_DATE, SOCIAL, ADDRESS, IBAN, CARD, NATIONAL_PHONE)
CANDIDATE = f"(?:{_START}(?:{'|'.join(FORMS)})|(?<![A-Za-z0-9+])(?:{PHONE})){_END}|{_START}{STAMP_DATE}"


def _noise(key: str, tag: Column | str, step: Column, value: Column) -> Column:
    tag = F.lit(tag) if isinstance(tag, str) else tag
    return F.sha2(F.concat_ws("|", F.lit(key), tag, step.cast("string"), value.cast("string")), 256)


def feistel_numbers(left: Column, right: Column, lefts: int, rights: int, key: str, tag: str) -> Column:
    """A keyed permutation of the pairs (0..lefts-1, 0..rights-1), as struct<l, r>: each round shifts one half by a keyed hash of the other."""

    def turn(acc: Column, step: Column) -> Column:
        even = step % 2 == 0
        other = F.when(even, acc["r"]).otherwise(acc["l"])
        shift = F.conv(F.substring(_noise(key, tag, step, other), 1, 15), 16, 10).cast("long")
        return F.struct(
            F.when(even, F.pmod(acc["l"] + shift, F.lit(lefts))).otherwise(acc["l"]).alias("l"),
            F.when(even, acc["r"]).otherwise(F.pmod(acc["r"] + shift, F.lit(rights))).alias("r"),
        )

    first = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), first, turn)


def _shifted(text: Column, noise: Column) -> Column:
    """Moves each letter or digit within its own alphabet by one byte of the noise; all else stays."""

    def move(c: Column, i: Column) -> Column:
        by = F.conv(F.substr(noise, F.pmod(i, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        out = c
        for alphabet in (LOWER, UPPER, DIGITS):
            at = F.instr(F.lit(alphabet), c)
            out = F.when(at > 0, F.substr(F.lit(alphabet), F.pmod(at - 1 + by, F.lit(len(alphabet))) + 1, F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(text, ""), move), "")


def feistel_text(text: Column, key: str, tag: str) -> Column:
    """A keyed permutation of all texts with the same kinds of characters (small, capital, digit) in the same places."""
    half = F.floor(F.length(text) / 2).cast("int")

    def turn(acc: Column, step: Column) -> Column:
        even = step % 2 == 0
        left = _shifted(acc["l"], _noise(key, tag, step, acc["r"]))
        right = _shifted(acc["r"], _noise(key, tag, step, acc["l"]))
        return F.struct(F.when(even, left).otherwise(acc["l"]).alias("l"), F.when(even, acc["r"]).otherwise(right).alias("r"))

    first = F.struct(F.substr(text, F.lit(1), half).alias("l"), F.substr(text, half + 1).alias("r"))
    end = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), first, turn)
    return F.concat(end["l"], end["r"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _relaid(text: Column, fresh: Column, kind: str = "[0-9]") -> Column:
    """`text` with its characters of a kind replaced, in order, by those of `fresh`."""

    def put(acc: Column, c: Column) -> Column:
        is_kind = c.rlike(kind)
        return F.struct(
            F.concat(acc["s"], F.when(is_kind, F.substr(fresh, acc["k"] + 1, F.lit(1))).otherwise(c)).alias("s"),
            (acc["k"] + is_kind.cast("int")).alias("k"),
        )

    return F.aggregate(F.split(text, ""), F.struct(F.lit("").alias("s"), F.lit(0).alias("k")), put)["s"]


def luhn_sum(digits: Column) -> Column:
    """Sum of digits, every second from the right doubled and reduced; a card number is valid if 10 divides it."""

    def add(acc: Column, c: Column) -> Column:
        d = c.cast("int") * (1 + acc["k"] % 2)
        return F.struct((acc["t"] + d - F.when(d > 9, 9).otherwise(0)).alias("t"), (acc["k"] + 1).alias("k"))

    return F.aggregate(F.split(F.reverse(digits), ""), F.struct(F.lit(0).alias("t"), F.lit(0).alias("k")), add)["t"]


def mod_97(text: Column) -> Column:
    """An IBAN's characters, moved and spelled as digits, modulo 97; valid ones give 1."""

    def add(acc: Column, c: Column) -> Column:
        letter = F.instr(F.lit(UPPER), c)
        return F.when(letter > 0, (acc * 100 + letter + 9) % 97).otherwise((acc * 10 + c.cast("int")) % 97)

    return F.aggregate(F.split(F.concat(F.substr(text, F.lit(5)), F.substr(text, F.lit(1), F.lit(4))), ""), F.lit(0), add)


# Days from 1900-01-01 to 2099-12-31 are 17 x 4297, the area codes and exchanges of a North American number 800 each.
DAYS = (17, 4297)


def _date(day: Column, form: str, key: str) -> Column:
    since = F.datediff(day, F.lit("1900-01-01").cast("date"))
    moved = feistel_numbers(F.floor(since / DAYS[1]), since % DAYS[1], *DAYS, key, "date")
    fresh = F.date_add(F.lit("1900-01-01").cast("date"), (moved["l"] * DAYS[1] + moved["r"]).cast("int"))
    return F.when((since >= 0) & (since < DAYS[0] * DAYS[1]), F.date_format(fresh, form))


def _split_day(m: Column, first: int, second: int) -> Column:
    """The date of three numbers, the day at place `first` and the month at `second`."""
    parts = F.split(m, "[./]")
    part = lambda k: F.lpad(parts[k], 2, "0")
    return F.try_to_date(F.concat(parts[2], F.lit("-"), part(second), F.lit("-"), part(first)), "yyyy-MM-dd")


def _unpadded(m: Column, day: Column) -> Column:
    """Eight digits of a date laid out like `m`, without leading zeros."""
    number = lambda at: F.substr(day, F.lit(at), F.lit(2)).cast("int").cast("string")
    mark = lambda k: F.regexp_extract(m, r"^\d+([./])\d+([./])", k)
    return F.concat(number(1), mark(1), number(3), mark(2), F.substr(day, F.lit(5)))


def _cased(text: Column, like: Column) -> Column:
    """`text` with capitals where `like`, of the same length, has them."""
    letters = F.zip_with(F.split(text, ""), F.split(like, ""), lambda c, old: F.when(old.rlike("[A-Z]"), F.upper(c)).otherwise(c))
    return F.when(like.rlike("[A-Z]"), F.array_join(letters, "")).otherwise(text)


def pseudonym(m: Column, key: str) -> Column:
    """What stands for one candidate: null where it doesn't pass the check of its form."""
    whole = lambda form: m.rlike(f"^(?:{form})$")
    digits, plain = _digits(m), F.regexp_replace(m, " ", "")
    # Cards: all but the last digit move; the last is the check digit of the rest.
    body = feistel_text(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card")
    card = F.concat(body, F.pmod(-luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))
    account = feistel_text(F.substr(plain, F.lit(5)), key, "iban")
    check = F.lpad((98 - mod_97(F.concat(F.substr(plain, F.lit(1), F.lit(2)), F.lit("00"), account))).cast("string"), 2, "0")
    iban = F.concat(F.substr(plain, F.lit(1), F.lit(2)), check, account)
    octets = F.split(m, r"\.")
    octet = lambda i: octets[i].cast("int")
    network = feistel_numbers(octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), 65536, 65536, key, "address")
    pair = lambda v: F.concat_ws(".", F.floor(v / 256).cast("string"), (v % 256).cast("string"))
    # North American numbers: area code and exchange from 200 to 999, then four digits.
    local = F.right(digits, F.lit(10))
    part = lambda at, n: F.substr(local, F.lit(at), F.lit(n)).cast("int")
    phone = feistel_numbers((part(1, 3) - 200) * 800 + part(4, 3) - 200, part(7, 4), 640_000, 10_000, key, "phone")
    fresh = F.concat(
        (200 + F.floor(phone["l"] / 800)).cast("string"), (200 + phone["l"] % 800).cast("string"), F.lpad(phone["r"].cast("string"), 4, "0")
    )
    american = (part(1, 3) >= 200) & (part(4, 3) >= 200)
    # Other numbers keep the sign, the country code and the first digit after it.
    country = F.regexp_extract(m, f"^{CALLING_CODE}", 0)
    rest = F.substr(m, F.length(country) + 1)
    other = F.regexp_replace(rest, "[^0-9]", "")
    abroad = F.concat(F.substr(other, F.lit(1), F.lit(1)), feistel_text(F.substr(other, F.lit(2)), key, "abroad"))
    prefix = F.regexp_extract(m, r"^(?i:password|passwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?", 0)
    at = F.instr(m, "@")
    ending = F.regexp_extract(m, r"\.[A-Za-z]+$", 0)
    domain = F.substr(m, at + 1, F.length(m) - at - F.length(ending))
    # An address is the same in any case, and its pseudonym has its capitals.
    name = F.substr(m, F.lit(1), at - 1)
    email = F.concat(_cased(feistel_text(F.lower(name), key, "name"), name), F.lit("@"), _cased(feistel_text(F.lower(domain), key, "domain"), domain), ending)
    social = F.substr(digits, F.lit(1), F.lit(3)).cast("int").between(1, 899) & ~m.rlike("^666|-00-|-0000$")
    # The area moves among 1 to 899 without 666, group and serial among their own values.
    area = F.substr(digits, F.lit(1), F.lit(3)).cast("int")
    code = feistel_numbers(
        area - F.when(area > 666, 2).otherwise(1), (F.substr(digits, F.lit(4), F.lit(2)).cast("int") - 1) * 9999 + F.substr(digits, F.lit(6), F.lit(4)).cast("int") - 1, 898, 99 * 9999, key, "social"
    )
    three = code["l"] + F.when(code["l"] >= 665, 2).otherwise(1)
    number = F.concat_ws(
        "-", F.lpad(three.cast("string"), 3, "0"), F.lpad((F.floor(code["r"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((code["r"] % 9999 + 1).cast("string"), 4, "0")
    )
    day = F.coalesce(_date(_split_day(m, 0, 1), "ddMMyyyy", key), _date(_split_day(m, 1, 0), "MMddyyyy", key))
    return (
        F.when(at > 0, email)
        .when(prefix != "", F.concat(prefix, feistel_text(F.substr(m, F.length(prefix) + 1), key, "secret")))
        .when(whole(CLOUD_KEY), F.concat(F.lit("AKIA"), feistel_text(F.substr(m, F.lit(5)), key, "key")))
        .when(whole(ISO_DATE), _date(F.try_to_date(m, "yyyy-MM-dd"), "yyyy-MM-dd", key))
        .when(whole(DAY_DATE), F.when(F.length(m) == 10, _relaid(m, day)).otherwise(_unpadded(m, day)))
        .when(whole(SOCIAL), F.when(social, number))
        .when(whole(ADDRESS), F.when((octet(0) < 256) & (octet(1) < 256) & (octet(2) < 256) & (octet(3) < 256), F.concat_ws(".", pair(network["l"]), pair(network["r"]))))
        .when(whole(IBAN), F.when(mod_97(plain) == 1, _relaid(m, iban, "[A-Z0-9]")))
        .when(whole(CARD), F.when(luhn_sum(digits) % 10 == 0, _relaid(m, card)))
        .when(m.startswith("+") & ~(m.startswith("+1") & (F.length(digits) == 11)), F.concat(country, _relaid(rest, abroad)))
        .when(american, F.concat(F.when(m.startswith("+"), F.lit("+1")).otherwise(F.lit("")), _relaid(F.when(m.startswith("+"), F.substr(m, F.lit(3))).otherwise(m), fresh)))
    )


def pseudonymised(docs: DataFrame, key: str, text: str = "text", count: str | None = None, per_value: Callable[[Column, str], Column] = pseudonym) -> DataFrame:
    """`docs` with the personal values of `text` replaced, and optionally how many were (`count`).

    Card numbers (Luhn), IBANs (mod 97), network addresses, social security and telephone numbers and dates that pass the check of
    their form are permuted within the form under `key`: the same value has the same pseudonym in all documents, two
    values never share one, check digits are right again, and separators stay. The characters of e-mail addresses, cloud
    keys and secrets after a name like `token=` are permuted in the same way. What fails its check stays, as does all
    other text. A null text stays null with count 0. Rows are independent of each other, no other column is looked at.
    """
    source = F.col(text)
    # Names of its own, whatever columns there are.
    tag = uuid.uuid4().hex
    held, made = f"found_{tag}", f"fresh_{tag}"
    # Only texts with one of these characters can hold a value; the others skip the long pattern.
    maybe = source.rlike("[0-9@=:]")
    found = F.when(maybe, F.regexp_extract_all(source, F.lit(CANDIDATE), F.lit(0)))
    between = F.split(source, CANDIDATE, -1)
    fresh = F.transform(held, lambda m: per_value(m, key))
    joined = F.zip_with(
        F.zip_with(between, F.col(held), lambda a, m: F.struct(a.alias("a"), m.alias("m"))), F.col(made),
        lambda x, f: F.concat(x["a"], F.coalesce(f, x["m"], F.lit(""))),
    )
    out = docs.withColumn(held, found).withColumn(made, F.when(F.size(held) > 0, fresh))
    out = out.withColumn(text, F.when(F.size(held) > 0, F.array_join(joined, "")).otherwise(source))
    if count:
        out = out.withColumn(count, F.coalesce(F.size(F.filter(made, lambda f: f.isNotNull())), F.lit(0)))
        out = out.withColumn(count, F.greatest(F.col(count), F.lit(0)))
    return out.drop(held, made)
