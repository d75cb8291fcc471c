"""Column helpers shared by the text operators: built-in functions only."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII white space, U+0009..U+000D and U+0020
SPACE = "\t\n\x0b\x0c\r "


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often it is used."""
    return F.transform(F.array(value), body)[0]


def split_words(text: Column) -> Column:
    """Words between ASCII white space; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x09-\x0D\x20]+"))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; other letters stay as they are.

    ``lower`` is several times faster than ``translate`` and does the same to a
    text of ASCII characters only.
    """
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def alphanumeric_words(text: Column) -> Column:
    """Words of a-z, 0-9 and characters beyond ASCII, after lowering A-Z."""
    other = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), other), lambda w: w != "")
