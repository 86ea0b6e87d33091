"""Lossy parsing of numbers and flags. A value that cannot be read becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterloom.functions.text import strip_accents, trim_spaces

# Words read as true and as false, compared in upper case without accents.
TRUE_WORDS = ("SIM", "S", "TRUE", "VERDADEIRO", "1", "X", "Y", "YES")
FALSE_WORDS = ("NAO", "N", "FALSE", "FALSO", "0", "NO")
# Fixed value: characters ignored anywhere in a number (currency sign, blanks, per cent).
NUMBER_NOISE = r"(?U)[R$\s%]"

# A cast would also accept '12d', 'NaN' or 'Infinity', which are not numbers in a spreadsheet.
PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def parse_decimal(c: Column) -> Column:
    """``R$ 1.234,56``, ``1234.56`` or ``12%`` as double; a comma is the decimal mark."""
    digits = F.regexp_replace(c.cast("string"), NUMBER_NOISE, "")
    without_dots = F.replace(digits, F.lit("."), F.lit(""))
    dotted = F.regexp_replace(without_dots, r"^([^,]*),", "$1.")
    plain = F.when(F.contains(digits, F.lit(",")), dotted).otherwise(digits)
    return F.when(plain.rlike(PLAIN_NUMBER), plain.try_cast("double"))


def parse_integer(c: Column) -> Column:
    """Like :func:`parse_decimal`, rounded half-even to a bigint."""
    return F.bround(parse_decimal(c), 0).try_cast("bigint")


def parse_boolean(c: Column) -> Column:
    """Yes/no words as boolean; other words are null."""
    word = strip_accents(F.upper(trim_spaces(c.cast("string"))))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
