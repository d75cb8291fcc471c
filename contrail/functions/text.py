"""Text clean-up, keys and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text standing in for null in surrogate keys.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def clean(col: Column | str) -> Column:
    return F.trim(_column(col))


def clean_lower(col: Column | str) -> Column:
    return F.lower(F.trim(_column(col)))


def clean_upper(col: Column | str) -> Column:
    return F.upper(F.trim(_column(col)))


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the ``-`` joined text of the columns, nulls replaced, not skipped."""
    pieces: list[Column] = []
    for position, col in enumerate(cols):
        if position:
            pieces.append(F.lit("-"))
        pieces.append(F.coalesce(_column(col).cast("string"), F.lit(NULL_KEY_PART)))
    return F.md5(F.concat(*pieces))


def pair_label(left: Column | str, right: Column | str, arrow: str = " → ") -> Column:
    """``left → right``; null when either end is null."""
    return F.concat(_column(left), F.lit(arrow), _column(right))


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
