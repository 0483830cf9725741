"""Text expressions. All are JVM expressions and stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code point ranges that count as Unicode white space.
WHITE_SPACE_RANGES = [
    (0x0009, 0x000D),
    (0x001C, 0x0020),
    (0x0085, 0x0085),
    (0x00A0, 0x00A0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
]
WHITE_SPACE = "".join(chr(c) for low, high in WHITE_SPACE_RANGES for c in range(low, high + 1))

# A word is a run of letters and digits of any script; case is kept.
WORD_BREAK = r"[^\p{L}\p{N}]+"


def strip_unicode(text: Column) -> Column:
    """Remove Unicode white space at both ends (`trim` alone removes only U+0020).

    `btrim` with a character set is linear; a `\\s+$` pattern is quadratic on long inner runs.
    """
    return F.btrim(text, F.lit(WHITE_SPACE))


def clean_text(text: Column) -> Column:
    """Null becomes '', each tab and line break becomes one space, both ends are stripped."""
    return strip_unicode(F.translate(F.coalesce(text, F.lit("")), "\t\n\r", "   "))


def fill_empty(text: Column, source: Column) -> Column:
    """`source` where `text` is empty. Both must be cleaned already."""
    return F.when(text == "", source).otherwise(text)


def wrap_text(text: Column, every: int = 12) -> Column:
    """Line break after each `every` code points, none at the end."""
    if every < 1:
        raise ValueError("every must be at least 1")
    return F.regexp_replace(text, "(?s)(.{%d})(?=.)" % every, "$1\n")


def words(text: Column) -> Column:
    """Array of the runs of letters and digits in `text`; may hold empty strings."""
    return F.split(text, WORD_BREAK)


def display_name(code: Column, names: dict[str, str]) -> Column:
    """Name of a code, or the code itself when `names` does not have it."""
    if not names:
        return code
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), code)


def digest(*parts: Column) -> Column:
    """32-byte key for the given values, nulls told apart from empty text.

    Shuffles of long texts move this instead of the text. Each part is written with its length, so
    ("a", "bc") and ("ab", "c") differ.
    """
    coded = []
    for part in parts:
        value = part.cast("string")
        coded.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("~")))
    return F.unhex(F.sha2(F.concat(*coded), 256))
