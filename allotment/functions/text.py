"""Text cleaning and URL screening."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contracts import ACCENTED, NULL_TOKENS, NULL_TOKENS_ANY_CASE, SECRET_QUERY_KEYS, UNACCENTED

# What Python's str.strip() takes off, which is more than SQL TRIM's blanks.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.trim(text, F.lit(WHITE_SPACE))


def fold_accents(text: Column) -> Column:
    """Replace Spanish accented vowels and ñ by their plain letters.

    Pure ASCII text, which has as many bytes as characters, is left alone:
    looking up every one of its characters would change nothing.
    """
    only_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(only_ascii, text).otherwise(F.translate(text, ACCENTED, UNACCENTED))


def null_token_to_null(text: Column, any_case: bool = False, trimmed: bool = False) -> Column:
    """Trimmed text, or NULL when it only spells "no value".

    By default blanks are trimmed and the tokens compared exactly; with
    ``any_case`` all white space is trimmed and case is ignored. ``trimmed``
    says that the text has been trimmed already.
    """
    if not trimmed:
        text = strip(text) if any_case else F.trim(text)
    if any_case:
        return F.when(~F.lower(text).isin(NULL_TOKENS_ANY_CASE), text)
    return F.when(~text.isin(NULL_TOKENS), text)


def carries_secret(url: Column) -> Column:
    """True when the URL's query string has a key that holds a secret.

    Keys count with a blank value or with none at all, in any case, and when
    percent-encoded.
    """
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)

    def decoded_key(pair: Column) -> Column:
        raw = F.substring_index(pair, "=", 1)
        return F.lower(F.coalesce(F.try_url_decode(raw), raw))

    has_key = F.exists(F.split(query, "&"), lambda pair: decoded_key(pair).isin(SECRET_QUERY_KEYS))
    return F.coalesce(F.when(F.contains(url, F.lit("?")), has_key), F.lit(False))


def is_https(url: Column) -> Column:
    """True when the URL's scheme is https."""
    return F.coalesce(F.lower(strip(url)).startswith("https:"), F.lit(False))
