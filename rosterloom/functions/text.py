"""Text cleaning."""

from __future__ import annotations

import string
import unicodedata
from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters that lose their accent, and the plain letter each one becomes.
ACCENTED = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑáàâãäéèêëíìîïóòôõöúùûüçñ"
PLAIN = "AAAAAEEEEIIIIOOOOOUUUUCNaaaaaeeeeiiiiooooouuuucn"


# What a header or value code is made of; anything else parts its words.
_CODE_LETTERS = frozenset(string.digits + string.ascii_uppercase)


def trim_spaces(c: Column) -> Column:
    """Trim every Unicode space, not only U+0020."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean_text(c: Column) -> Column:
    """Trim, squeeze runs of white space to one blank, and turn empty text into null.

    ASCII text whose only white space is single blanks, as most cells are, is not looked through by character classes.
    """
    ascii_only = F.octet_length(c) == F.char_length(c)
    single_blanks = ascii_only & ~F.contains(c, F.lit("  ")) & ~c.rlike(r"[\t-\r]")
    squeezed = F.when(single_blanks, c).otherwise(F.regexp_replace(c, r"(?U)\s+", " "))
    return F.nullif(F.trim(squeezed), F.lit(""))


def starts_visibly(c: Column) -> Column:
    """Text that begins with a visible ASCII character, by the order of bytes; false also for null and for other visible ones."""
    return F.coalesce((c >= "!") & (c < "\x80"), F.lit(False))


def strip_accents(c: Column) -> Column:
    """Replace accented letters by plain ones in a single pass; case is kept."""
    return F.translate(c, ACCENTED, PLAIN)


def zero_pad(c: Column, width: int) -> Column:
    """Left-pad with zeros up to ``width``. Longer text is kept whole; a sign stays in front."""
    sign = F.regexp_extract(c, r"^[+-]?", 0)
    rest = F.regexp_replace(c, r"^[+-]", "")
    width_of_rest = F.greatest(F.length(rest), F.lit(width) - F.length(sign))
    return F.concat(sign, F.lpad(rest, width_of_rest, F.lit("0")))


def header_code(header: str) -> str:
    """Comparable form of a column header. Works on schema names, never on rows."""
    letters = (ch for ch in unicodedata.normalize("NFKD", str(header)) if ch.isascii())
    return "_".join("".join(ch if ch in _CODE_LETTERS else " " for ch in map(str.upper, letters)).split())


def value_code(c: Column) -> Column:
    """Comparable form of a cell value: no accents, upper case, words joined by ``_``."""
    words = F.regexp_replace(F.upper(strip_accents(c.cast("string"))), "[^0-9A-Z]+", "_")
    return F.btrim(words, F.lit("_"))


def label_from_map(c: Column, labels: Mapping[str, str]) -> Column:
    """Look the value's code up in ``labels``; anything unmapped becomes null."""
    if not labels:
        return F.lit(None).cast("string")
    coded = {header_code(k): v.upper() for k, v in labels.items()}
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(coded.items())])
    return F.try_element_at(table, value_code(c))
