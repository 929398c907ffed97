"""Column expressions over dirty text. All are built-in expressions, none throws on bad input.

Each parser names its input once wherever it can: a column expression is copied at every mention, and
a parser used in a filter and a projection is copied again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom import spec

# Every character Python's str.strip() removes, and those of them that are ASCII.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())
_ASCII_WHITESPACE = "".join(char for char in WHITESPACE if char.isascii())

# Numbers as text: sign, digits grouped by single underscores, point, exponent; or infinity.
_PAD = "[" + "".join(f"\\x{{{ord(char):x}}}" for char in WHITESPACE) + "]*"
_DIGITS = r"\d+(?:_\d+)*"
_NUMBER = (
    rf"^{_PAD}([+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?|(?i:inf|infinity))){_PAD}$"
)
_WHOLE = rf"^{_PAD}([+-]?{_DIGITS})(?:\.0*)?{_PAD}$"

_FLAGS = {"0": 0, "0.0": 0, "1": 1, "1.0": 1}


def strip(c: Column) -> Column:
    """Trim all white space; Spark's plain trim removes only spaces.

    Trimming costs a look at every listed character, so text of single bytes gets the short list.
    """
    single_bytes = F.octet_length(c) == F.length(c)
    return F.when(single_bytes, F.btrim(c, F.lit(_ASCII_WHITESPACE))).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def lookup(c: Column, mapping: Mapping, default: str | None = None) -> Column:
    """Replace codes by values through a small fixed map; other codes give `default`."""
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    found = F.create_map(*pairs)[c]
    return found if default is None else F.coalesce(found, F.lit(default))


def is_missing(c: Column, blanks: Sequence[str] = spec.CLEANING_BLANKS) -> Column:
    """True for NULL and for any blank marker."""
    return F.coalesce(F.lower(strip(c)).isin(*blanks), F.lit(True))


def _matched(c: Column, pattern: str) -> Column:
    """The number a pattern finds, group marks removed; NULL where it finds none.

    Matching first keeps the cast from failing: a failed cast costs an exception per row.
    """
    return F.replace(F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")), F.lit("_"), F.lit(""))


def parse_double(c: Column) -> Column:
    """A number, or NULL for blanks and for anything else.

    The pattern turns away spellings a bare cast would take, such as '3d' or '0x1p3'. Blank markers
    are no numbers either, so no blank list is needed.
    """
    return _matched(c, _NUMBER).try_cast("double")


def plain_whole(c: Column) -> Column:
    """A whole number as BIGINT from plain digits: '7' and '2.0' count, '2.5' and '1e3' are NULL."""
    return _matched(c, _WHOLE).try_cast("bigint")


def parse_whole(c: Column) -> Column:
    """A whole number as BIGINT in any spelling: '7', '2.0' and '1e3' count, '2.5' is NULL."""
    number = F.when(F.lower(c).contains("e"), parse_double(c))
    return F.coalesce(plain_whole(c), F.when(number == F.rint(number), number.try_cast("bigint")))


def parse_flag(c: Column) -> Column:
    """0 or 1 from '0', '0.0', '1', '1.0'; NULL for everything else."""
    return lookup(strip(c), _FLAGS)


def flag_state(c: Column, blanks: Sequence[str] = spec.PROFILE_BLANKS) -> Column:
    """'0', '1', 'INVALID', or NULL where missing."""
    known = lookup(strip(c), {text: str(flag) for text, flag in _FLAGS.items()}, "INVALID")
    return F.when(~is_missing(c, blanks), known)


def clean_text(c: Column, default: str = "Unknown") -> Column:
    """Stripped text, or `default` where missing."""
    return F.when(is_missing(c), F.lit(default)).otherwise(strip(c))


def keep_text(c: Column) -> Column:
    """Stripped text, or the empty string where missing."""
    return clean_text(c, "")


def smoking_group(c: Column) -> Column:
    """Fold smoking answers into Never, Former, Current and Unknown."""
    return lookup(F.lower(strip(c)), spec.SMOKING_GROUPS, "Unknown")


def normalize_line(line: Column) -> Column:
    """Tidy one delimited text line and turn its commas into tabs. Not quote-aware."""
    tidy = F.regexp_replace(line, r"\r$", "")
    tidy = F.regexp_replace(tidy, r"^\s+|\s+$", "")
    tidy = F.regexp_replace(tidy, r"\s*,\s*", "\t")
    return F.regexp_replace(tidy, r"No Info|no info|No info", "no_info")


def four_places(c: Column) -> Column:
    """Fixed-point text with four decimals, NULL for NULL."""
    return F.when(c.isNotNull(), F.format_string("%.4f", c))


def two_place_percent(part: Column, whole: Column) -> Column:
    """Share of `whole` in percent, two decimals, 0 for an empty whole."""
    return F.round(F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0)), 2)
