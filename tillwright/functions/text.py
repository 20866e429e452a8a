"""Rules for text columns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

# Which text stands for "no value", what an address, a phone and an id look like,
# how countries and yes/no answers are spelled.
NULL_TOKENS = ("", "null")
NUMBER_PLACEHOLDERS = ("", "null", "n/a", "na", "none", "?")
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE_DIGITS = (10, 15)
PRODUCT_ID_PATTERN = r"^P\d{4}$"
COUNTRY_SPELLINGS = {
    "USA": ("usa", "u.s.a.", "united states", "us"),
    "Canada": ("canada",),
    "Mexico": ("mexico",),
}
YES_WORDS = ("true", "yes", "y")
NO_WORDS = ("false", "no", "n")


def blank_to_null(text: Column) -> Column:
    """Text without surrounding spaces; NULL when nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def tokens_to_null(text: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Text without surrounding spaces; NULL when it is one of ``tokens`` in any case."""
    bare = F.trim(text)
    return F.when(~F.lower(bare).isin(*tokens), bare)


def email_address(text: Column, pattern: str = EMAIL_PATTERN) -> Column:
    """A well-formed address in lower case, else NULL."""
    return F.when(text.rlike(pattern), F.lower(text))


def phone_number(text: Column, digits: tuple[int, int] = PHONE_DIGITS) -> Column:
    """The digits of a phone number, NULL when there are too few or too many."""
    only_digits = F.regexp_replace(text, "[^0-9]", "")
    return F.when(F.length(only_digits).between(*digits), only_digits)


def canonical(text: Column, spellings: Mapping[str, Iterable[str]] = COUNTRY_SPELLINGS) -> Column:
    """Known spellings (lower case) become their canonical form, other text stays as it is.

    The spellings are a literal map inside the plan; a vocabulary that grows with the data
    belongs in a table and a join instead.
    """
    entries = [(spelling, name) for name, known in spellings.items() for spelling in known]
    lookup = F.create_map(*[F.lit(part) for entry in entries for part in entry])
    return F.coalesce(F.try_element_at(lookup, F.lower(text)), text)


def upper_code(text: Column) -> Column:
    """A code without surrounding spaces, in upper case."""
    return F.upper(F.trim(text))


def yes_no(text: Column, yes: Iterable[str] = YES_WORDS, no: Iterable[str] = NO_WORDS) -> Column:
    """Boolean from a vocabulary, NULL for any other word."""
    word = F.lower(text)
    return F.when(word.isin(*yes, *no), word.isin(*yes))


def matches(text: Column, pattern: str = PRODUCT_ID_PATTERN) -> Column:
    """True when an id has the given form; NULL ids give NULL, so a filter drops them."""
    return text.rlike(pattern)


def fingerprint(text: Column, secret: str) -> Column:
    """Keyed SHA-256 (HMAC) of trimmed lower-case text, to link records without showing them.

    Without the secret an address cannot be confirmed by hashing a guess.
    """
    key = hashlib.sha256(secret.encode()).digest().ljust(64, b"\0")
    inner, outer = (bytes(byte ^ pad for byte in key).hex() for pad in (0x36, 0x5C))
    first = F.sha2(F.concat(F.unhex(F.lit(inner)), F.lower(F.trim(text)).cast("binary")), 256)
    return F.sha2(F.concat(F.unhex(F.lit(outer)), F.unhex(first)), 256)
