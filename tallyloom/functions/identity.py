"""Deterministic person identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import blank_to_null, not_blank, plain_address

PSEUDO_SUFFIX = "@pseudo"


def has_address(email: Column) -> Column:
    """True or false, never NULL: the text can serve as an e-mail identity."""
    return F.coalesce(not_blank(email) & email.contains("@"), F.lit(False))


def _pseudo(name: Column, affiliation: Column, country: Column) -> Column:
    digest = F.md5(F.concat(F.lower(name), F.lit("|"), F.lower(affiliation), F.lit("|"), F.lower(country)))
    return F.concat(
        F.lower(F.replace(name, F.lit(" "), F.lit(""))),
        F.lit("|"),
        F.substring(digest, 1, 10),
        F.lit(PSEUDO_SUFFIX),
    )


def person_key(
    email: Column, name: Column, affiliation: Column, country: Column, null_as: str | None = "unknown"
) -> Column:
    """The lower-cased e-mail, or a hash of name, affiliation and country.

    With ``null_as=None`` (the strict form) a missing part makes the key NULL;
    otherwise missing and blank parts count as ``null_as``.
    """
    def part(text: Column) -> Column:
        if null_as is None:
            return F.trim(text)
        return F.coalesce(blank_to_null(text), F.lit(null_as))

    pseudo = _pseudo(part(name), part(affiliation), part(country))
    return F.when(has_address(email), plain_address(email)).otherwise(pseudo)


def person_key_without_context(email: Column, name: Column) -> Column:
    """Identity for a stored author of whom only the name is known."""
    known_name = F.coalesce(blank_to_null(name), F.lit("unknown"))
    pseudo = _pseudo(known_name, F.lit("unknown_affiliation"), F.lit("unknown_country"))
    return F.when(has_address(email), plain_address(email)).otherwise(pseudo)
