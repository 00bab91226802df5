"""Line splitting with the rules of the JVM's ``String.split``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the regular expression \s stands for, and the characters
# String.trim removes (U+0000 to U+0020).
WHITESPACE = " \t\n\x0b\f\r"
TRIMMED = "".join(chr(c) for c in range(0x21))

_SINGLE_CHARACTERS = {" ": " ", ",": ",", r"\s": WHITESPACE}


def java_split(line: Column, separator: str) -> Column:
    """Fields of ``line``: inner and leading empty ones stay, trailing ones go.

    An empty line gives one empty field; a line of separators only gives none.
    """
    if separator in _SINGLE_CHARACTERS:
        body = F.rtrim(line, F.lit(_SINGLE_CHARACTERS[separator]))
    else:
        body = F.regexp_replace(line, rf"(?:{separator})+\z", "")
    fields = F.split(body, separator)
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(body == "", F.array().cast("array<string>"))
        .otherwise(fields)
    )


def java_trim(text: Column) -> Column:
    """``text`` without control characters and blanks at both ends."""
    return F.btrim(text, F.lit(TRIMMED))


def tokens(line: Column, separator: str = r"\s") -> Column:
    """The words of ``line``, as an array ready for ``explode``."""
    return java_split(line, separator)


def not_empty(line: Column) -> Column:
    """Keeps every line but the empty one; blanks count as content."""
    return F.length(line) > 0
