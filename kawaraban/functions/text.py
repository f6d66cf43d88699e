"""Text clean-up.  Every function maps a string Column to a Column."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, functions as F

# --- fixed values -----------------------------------------------------------
ENGLISH_TAGS = r"<(?:p*|/p|br|/br|a*|/a)>"
ENGLISH_PUNCTUATION = r"""[\n(),.“"”'’]+"""
ANY_TAG = r"<[^>]*?>"
PAREN_SUFFIX = r" \(.*\)"
WIDE_PAREN = r"（[^）]*）"
IDEOGRAPHIC_SPACE = "　"
CONTINUED = "…続き"
FULL_STOP = "。"
# ----------------------------------------------------------------------------

# Half-width forms.  ASCII sits at a constant distance from its full-width form,
# and Unicode compatibility composition gives the kana.
_ASCII = [chr(c) for c in range(0x21, 0x7F)]
_KANA = [chr(c) for c in range(0xFF61, 0xFFA0)]
HALF = " " + "".join(_ASCII) + "".join(_KANA)
FULL = (
    IDEOGRAPHIC_SPACE
    + "".join(chr(ord(c) + 0xFEE0) for c in _ASCII)
    + "".join(
        {"ﾞ": "゛", "ﾟ": "゜"}.get(c, unicodedata.normalize("NFKC", c)) for c in _KANA
    )
)
_MARKS = "ﾞﾟ"
VOICED = {
    k + m: unicodedata.normalize("NFKC", k + m)
    for m in _MARKS
    for k in _KANA
    if len(unicodedata.normalize("NFKC", k + m)) == 1
}


def clean_en(c: Column) -> Column:
    """Delete bare p/br/a tags, newlines and English punctuation; lower-case.

    No tag holds a character that is deleted, so tags can go first.
    """
    return F.lower(F.regexp_replace(F.regexp_replace(c, ENGLISH_TAGS, ""), ENGLISH_PUNCTUATION, ""))


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, ANY_TAG, "")


def drop_chars(c: Column, chars: str) -> Column:
    """Delete every character that occurs in ``chars``; one pass over runs of them."""
    return F.regexp_replace(c, f"[{re.escape(chars)}]+", "")


def clean_snippet(c: Column) -> Column:
    """Delete ideographic spaces and the 'continued' marker."""
    return F.replace(drop_chars(c, IDEOGRAPHIC_SPACE), F.lit(CONTINUED), F.lit(""))


def drop_paren_suffix(c: Column) -> Column:
    return F.regexp_replace(c, PAREN_SUFFIX, "")


def drop_wide_paren(c: Column) -> Column:
    return F.regexp_replace(c, WIDE_PAREN, "")


def to_fullwidth(c: Column) -> Column:
    """Half-width ASCII, space and kana to full-width forms.

    A kana followed by a voicing mark becomes one character.  Those pairs are
    only looked for in text that has a half-width mark at all.
    """
    joined = c
    for pair, full in VOICED.items():
        joined = F.replace(joined, F.lit(pair), F.lit(full))
    return F.translate(F.when(c.rlike(f"[{_MARKS}]"), joined).otherwise(c), HALF, FULL)


def first_sentence(c: Column, sep: str = FULL_STOP) -> Column:
    return F.substring_index(c, sep, 1)


def word_tokens(c: Column) -> Column:
    """Lower-cased runs of letters and digits, as an array."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
