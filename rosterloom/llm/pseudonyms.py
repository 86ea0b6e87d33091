"""Personal data replaced by pseudonyms of the same format, equal for equal values in all documents.

Only DataFrame functions. One pattern finds the candidates; each is validated by its kind. Digits of numbers and days of
dates go through a keyed Feistel network over exactly the valid values of their format, which permutes them: different
values of a format get different pseudonyms of it, valid themselves, and who has the key can undo it. Check digits are
computed anew. Phone numbers keep all but their last ten digits. Addresses and secrets, which have no fixed format, get a
keyed name of 128 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.storage import unused

_ROUNDS = 8
_DAYS = 146097  # of 400 years, 1700-01-01 to 2099-12-31: 189 * 773
_FIRST_DAY = -98615  # 1700-01-01, counted from 1970-01-01
_LONG_DAYS = _DAYS - 400 * 12 * 12  # days after the twelfth of a month: 88,497 of 297 * 298 numbers
_AREAS, _GROUPS, _SERIALS = 898, 99, 9999  # of social security numbers: no area 000, 666 or from 900, no zeros
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_LOCAL = "A-Za-z0-9._%+-"
_LABEL = "[A-Za-z0-9]++(?:-++[A-Za-z0-9]++)*+"
#: What ends here is not the beginning of an e-mail address.
_END = f"(?![{_LOCAL}]{{1,64}}+@)"
#: In order of preference; names are those of the counts. Possessive, and addresses begin where a run of their letters
#: begins, so that time is in proportion to the text and no repetition needs the stack.
_KINDS = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++@{_LABEL}(?:\.{_LABEL})++",
    "secret": r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)"
    r"|(?<!\w)(?i:password|passwd|pwd|secret|token|api_?key)(?!\w)\s{0,3}[=:]\s{0,3}(?:\"[^\"\s]{6,}+\"|'[^'\s]{6,}+'|[^\s\"',;]{6,}+)"
    r"|(?<!\w)(?:sk|ghp|gho|xox[bp])[_-][0-9A-Za-z_-]{15,}\w",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\d]|\.\d){_END}",
    "date": rf"(?:(?<!\d)\d{{4}}-\d{{2}}-\d{{2}}(?!\d)|(?<!\d)\d{{2}}/\d{{2}}/\d{{4}}(?!\d)){_END}",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4} \d{4} \d{4} \d{1,7}|\d{4}-\d{4}-\d{4}-\d{1,7}|\d{4}[ -]\d{6}[ -]\d{4,5})(?!\d)" + _END,
    "ssn": rf"(?<![\d-])\d{{3}}-\d{{2}}-\d{{4}}(?![\d-]){_END}",
    "phone": r"(?:(?<![\w+])\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    rf"|(?<![\w+])\+\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)[ .-]?)?\d{{2,4}}(?:[ .-]?(?!{_OCTET}(?:\.{_OCTET}){{3}})\d{{2,4}}){{1,4}}(?!\d)"
    r"|(?<![\w+(])\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?!\d))" + _END,
}
PATTERN = "|".join(f"(?:{p})" for p in _KINDS.values())


def _keyed(key: str, *parts: Column) -> Column:
    """56 bits of a keyed hash as a long."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), *parts), 256), 1, 14), 16, 10).cast("long")


def feistel(value: Column, left: Column | int, right: Column | int, key: str, tweak: Column) -> Column:
    """A keyed permutation of 0 .. left * right - 1. `tweak` selects the permutation.

    The value is split in two parts; in turns, one part is moved, within its own range, by a keyed hash of the other.
    """
    left, right = (F.lit(x).cast("long") if isinstance(x, int) else x.cast("long") for x in (left, right))
    start = F.struct(F.floor(value / right).cast("long").alias("a"), F.pmod(value, right).alias("b"))

    def turn(state: Column, k: Column) -> Column:
        move = _keyed(key, tweak, k.cast("string"), F.when(k % 2 == 0, state["b"]).otherwise(state["a"]).cast("string"))
        return F.struct(
            F.when(k % 2 == 0, F.pmod(state["a"] + move, left)).otherwise(state["a"]).alias("a"),
            F.when(k % 2 == 1, F.pmod(state["b"] + move, right)).otherwise(state["b"]).alias("b"),
        )

    rounds = F.array(*[F.lit(k) for k in range(_ROUNDS)])
    return F.aggregate(rounds, start, turn, lambda s: s["a"] * right + s["b"])


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), (n + 1).cast("int"), "0").cast("long")


def permuted_digits(digits: Column, key: str, tweak: str) -> Column:
    """Digits (1 to 17 of them) to as many digits."""
    n = F.char_length(digits)
    half = F.floor(n / 2)
    mixed = feistel(digits.cast("long"), _power(half), _power(n - half), key, F.concat(F.lit(tweak), n.cast("string")))
    return F.lpad(mixed.cast("string"), n, "0")


def _luhn_sum(digits: Column, offset: int) -> Column:
    """Sum of Luhn's digits; every second one from the right counts double, from the place `offset` on."""
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when((i + offset) % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(each, F.lit(0), lambda s, d: s + F.coalesce(d, F.lit(0)))


def _number(text: Column, at: int, size: int) -> Column:
    return F.substring(text, at, size).try_cast("long")


def _padded(n: Column, size: int) -> Column:
    return F.lpad(n.cast("string"), size, "0")


def permuted_ssn(digits: Column, key: str) -> Column:
    """Nine digits of a valid number to those of another, with hyphens."""
    area, group, serial = _number(digits, 1, 3), _number(digits, 4, 2), _number(digits, 6, 4)
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    value = (place * _GROUPS + group - 1) * _SERIALS + serial - 1
    moved = feistel(value, _AREAS * _GROUPS, _SERIALS, key, F.lit("ssn"))
    first = F.floor(moved / (_GROUPS * _SERIALS)).cast("long") + 1
    parts = [
        _padded(first + F.when(first >= 666, 1).otherwise(0), 3),
        _padded(F.pmod(F.floor(moved / _SERIALS).cast("long"), F.lit(_GROUPS)) + 1, 2),
        _padded(F.pmod(moved, F.lit(_SERIALS)) + 1, 4),
    ]
    return F.concat_ws("-", *parts)


def _day(n: Column) -> Column:
    """The date of a number of days since the first."""
    return F.date_add(F.lit("1970-01-01").cast("date"), (n + _FIRST_DAY).cast("int"))


def _days(date: Column) -> Column:
    return (F.datediff(date, F.lit("1970-01-01").cast("date")) - _FIRST_DAY).cast("long")


def _month_begins(month: Column) -> Column:
    """How many of the days after the twelfth of a month come before a month, counted from January 1700."""
    return _days(F.add_months(_day(F.lit(0)), month.cast("int"))) - 12 * month


def permuted_date(found: Column, key: str) -> Column:
    """A date to another of the same spelling, one to one within each set that can be told apart by its spelling.

    Those sets are yyyy-MM-dd; two numbers up to 12 and a year, which may be read either way and are moved as numbers;
    dd/MM/yyyy and MM/dd/yyyy with a day after the twelfth.
    """
    iso = F.substring(found, 5, 1) == "-"
    number = feistel(_days(F.try_to_date(found, "yyyy-MM-dd")), 189, 773, key, F.lit("date"))
    first, second, year = _number(found, 1, 2), _number(found, 4, 2), _number(found, 7, 4) - 1700
    slashed = lambda a, b, y: F.concat_ws("/", _padded(a, 2), _padded(b, 2), _padded(y + 1700, 4))
    either = feistel((year * 12 + first - 1) * 12 + second - 1, 240, 240, key, F.lit("date 12/12"))
    twelfths = slashed(
        F.pmod(F.floor(either / 12).cast("long"), F.lit(12)) + 1, F.pmod(either, F.lit(12)) + 1, F.floor(either / 144).cast("long")
    )
    # Days after the twelfth are counted through; numbers beyond the last of them are moved again, and as there are nine
    # such numbers, ten moves always end at a day.
    month, day = F.least(first, second), F.greatest(first, second)
    since = _days(F.try_to_date(F.concat_ws("-", _padded(year + 1700, 4), _padded(month, 2), _padded(day, 2)), "yyyy-MM-dd"))
    rank = since - 12 * (year * 12 + month)
    tweak = F.when(first > 12, "date dd/MM").otherwise("date MM/dd")
    step = lambda n: feistel(n, 297, 298, key, tweak)
    again = F.array(*[F.lit(k) for k in range(9)])
    moved = F.aggregate(again, step(rank), lambda n, _: F.when(n >= _LONG_DAYS, step(n)).otherwise(n))
    guess = F.floor(moved * 4800 / _LONG_DAYS).cast("long")  # right but for one month
    at = guess + F.when(_month_begins(guess + 1) <= moved, 1).when(_month_begins(guess) <= moved, 0).otherwise(-1)
    other = _day(moved + 12 * (at + 1))
    late = F.when(first > 12, F.date_format(other, "dd/MM/yyyy")).otherwise(F.date_format(other, "MM/dd/yyyy"))
    return F.when(iso, F.date_format(_day(number), "yyyy-MM-dd")).when(day <= 12, twelfths).otherwise(late)


def _refilled(shape: Column, digits: Column) -> Column:
    """`shape` with its digits replaced, in order, by `digits`."""
    parts = F.split(shape, r"\d", -1)
    return F.array_join(
        F.transform(parts, lambda p, i: F.concat(p, F.when(i < F.size(parts) - 1, F.substr(digits, i + 1, F.lit(1))).otherwise(""))),
        "",
    )


def _pseudonym(found: Column, kind: Column, key: str) -> Column:
    """What stands for a validated value of the kind."""
    digits = F.regexp_replace(found, r"\D", "")
    n = F.char_length(digits)
    # All but the check digit are permuted; the issuer's first digit stays.
    body = F.concat(F.substring(digits, 1, 1), permuted_digits(F.substr(digits, F.lit(2), n - 2), key, "card"))
    check = F.pmod(-_luhn_sum(body, 1), F.lit(10)).cast("string")
    octets = F.transform(F.split(found, r"\."), lambda o: o.cast("long"))
    address = F.aggregate(octets, F.lit(0).cast("long"), lambda s, o: s * 256 + o)
    moved = feistel(address, 65536, 65536, key, F.lit("ip"))
    dotted = F.concat_ws(".", *[F.pmod(F.floor(moved / (256**k)), F.lit(256)).cast("string") for k in (3, 2, 1, 0)])
    # Country code and the exchange stay a phone's format; the last ten digits at most are permuted.
    tail = F.least(n, F.lit(10))
    phone = F.concat(F.substr(digits, F.lit(1), n - tail), permuted_digits(F.substr(digits, n - tail + 1, tail), key, "phone"))
    name = F.substring(F.sha2(F.concat_ws("|", F.lit(key), kind, F.lower(found)), 256), 1, 32)
    secret = F.substring(F.sha2(F.concat_ws("|", F.lit(key), kind, found), 256), 1, 32)
    return (
        F.when(kind == "email", F.concat(F.lit("user-"), name, F.lit("@example.invalid")))
        .when(kind == "secret", F.concat(F.lit("secret-"), secret))
        .when(kind == "ip", dotted)
        .when(kind == "date", permuted_date(found, key))
        .when(kind == "card", _refilled(found, F.concat(body, check)))
        .when(kind == "ssn", permuted_ssn(digits, key))
        .when(kind == "phone", _refilled(found, phone))
        .otherwise(found)
    )


def _valid_date(found: Column) -> Column:
    parsed = F.coalesce(*[F.try_to_date(found, p) for p in ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy")])
    return parsed.isNotNull() & F.year(parsed).between(1700, 2099)


def _kind(found: Column) -> Column:
    """The kind whose pattern and validation a value meets, or null."""
    digits = F.regexp_replace(found, r"\D", "")
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(_KINDS.items()):
        meets = F.rlike(found, F.lit(rf"^(?:{pattern})$"))
        if kind == "date":
            meets = meets & _valid_date(found)
        if kind == "card":
            meets = meets & F.char_length(digits).between(13, 19) & (_luhn_sum(digits, 0) % 10 == 0)
        if kind == "ssn":
            meets = meets & ~F.rlike(found, F.lit(r"^(?:000|666|9)|-00-|-0000$"))
        if kind == "phone":
            meets = meets & F.char_length(digits).between(7, 15)
        out = F.when(meets, F.lit(kind)).otherwise(out)
    return out


def with_pseudonyms(docs: DataFrame, key: str) -> DataFrame:
    """`docs` with a struct column `private`: text, with pseudonyms in place of values, and n_<kind> counts of them.

    Kinds: e-mail addresses, secrets, IPv4 addresses, dates (1700 to 2099), card numbers that pass Luhn's check, social
    security numbers, phone numbers. What looks like a value and fails its validation stays. Values overlap nowhere: the
    text is read from left to right. Null and empty texts stay the empty text with counts 0; repeated rows are treated
    row by row, alike. Columns of `docs` stay, whatever their names; `private` gets underscores if the name is taken.
    """
    text, cut = unused(docs, "private_text"), unused(docs, "private_cut")
    whole = docs.withColumn(text, F.coalesce(F.col("text").cast("string"), F.lit("")))
    found = F.regexp_extract_all(text, F.lit(f"({PATTERN})"), 1)
    values = F.transform(found, lambda f: F.struct(f.alias("found"), _kind(f).alias("kind")))
    marked = whole.withColumn(
        cut,
        # Most texts have nothing to replace; a value needs a digit, an @ or an = or :.
        F.when(F.rlike(text, F.lit(r"[@=:]|\d")), values).otherwise(F.array().cast("array<struct<found:string,kind:string>>")),
    )
    gaps = F.split(text, PATTERN, -1)
    told = F.transform(cut, lambda v: _pseudonym(v["found"], v["kind"], key))
    joined = F.array_join(F.flatten(F.zip_with(gaps, told, lambda g, t: F.array(g, F.coalesce(t, F.lit(""))))), "")


    def count(kind: str) -> Column:
        return F.size(F.filter(cut, lambda v: v["kind"] == kind)).cast("long").alias(f"n_{kind}")

    result = F.struct(F.when(F.size(cut) == 0, F.col(text)).otherwise(joined).alias("text"), *map(count, _KINDS))
    return marked.select(*docs.columns, result.alias(unused(docs, "private")))
