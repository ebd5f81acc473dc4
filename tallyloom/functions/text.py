"""Text keys and codes.

The source tables compare text without regard to case or accents, while Spark
compares bytes. ``ci_key`` gives the key under which two strings count as equal;
``norm_key`` also evens out whitespace. Joins, groupings and distincts on text
use one of them on both sides and show the smallest raw value of the group.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the pattern of an e-mail address inside free text.
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def _accent_rule() -> tuple[str, str]:
    """(from, to) for ``translate``: in every script, letters with marks to their base letter and marks to nothing.

    Derived from Unicode decomposition. Hangul syllables decompose into letters, not marks, and stay.
    """
    source, target, marks = [], [], []
    # The planes in between hold no letters with marks.
    for code in (*range(0x80, 0x30000), *range(0xE0000, 0xE0200)):
        letter = chr(code)
        if unicodedata.category(letter) == "Mn":
            marks.append(letter)
            continue
        base, *rest = unicodedata.normalize("NFD", letter)
        if base != letter and all(unicodedata.category(c) == "Mn" for c in rest) and letter == letter.lower():
            source.append(letter)
            target.append(base)
    return "".join(source + marks), "".join(target)


_ACCENTED, _BASE = _accent_rule()


# Letters of one byte whose words are parted by single spaces: all that is left to do is to trim and lower them.
_PLAIN = r"\A *+[!-~]++(?: [!-~]++)*+ *+\z"


def ci_key(text: Column) -> Column:
    """Case- and accent-insensitive comparison key.

    Text of one byte a letter holds no marks and skips ``translate``, which looks up letter by letter.
    """
    lower = F.lower(text)
    return F.when(F.octet_length(text) == F.char_length(text), lower).otherwise(F.translate(lower, _ACCENTED, _BASE))


def clean_trim(text: Column) -> Column:
    """Runs of whitespace, no-break spaces included, become one space; ends are cut."""
    return F.trim(F.regexp_replace(text, r"[\s\u00A0]+", " "))


def norm_key(text: Column) -> Column:
    """Key for comparing hand-typed names: whitespace, case and accents are ignored.

    Written with few steps for plain text, since a stage whose code gets long is not compiled by the JVM.
    """
    full = F.translate(F.lower(clean_trim(text)), _ACCENTED, _BASE)
    return F.when(text.rlike(_PLAIN), F.lower(F.trim(text))).otherwise(full)


def not_blank(text: Column) -> Column:
    """True where there is text besides spaces (false or NULL otherwise)."""
    return F.trim(text) != ""


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def plain_address(text: Column) -> Column:
    return F.lower(F.trim(text))


def extract_email(text: Column) -> Column:
    """First address in free text, or the whole text if it holds none."""
    return plain_address(F.coalesce(F.regexp_substr(text, F.lit(EMAIL_PATTERN)), text))


def code_from_id(prefix: str, number: Column, width: int = 3) -> Column:
    """``AWD007``; ids with more than ``width`` digits keep all of them."""
    digits = number.cast("string")
    return F.concat(
        F.lit(prefix),
        F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")),
    )


def code_from_hash(prefix: str, text: Column, width: int = 8) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.md5(text), 1, width))
