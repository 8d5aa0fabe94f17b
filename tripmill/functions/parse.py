"""Text to typed value. A value that is not well formed becomes NULL, except a timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmill.schema import AMOUNT

# \z and not $: in Java, $ also matches before a final newline.
_WHOLE = r"^[0-9]+(\.0+)?\z"
_DECIMAL = r"^-?[0-9]+(\.?[0-9]+)?\z"


def int_or_null(text: Column) -> Column:
    """Unsigned whole number, also written ``2.0``; blanks around it are allowed."""
    bare = F.trim(text)
    # The pattern leaves nothing but zeros behind the point.
    return F.when(bare.rlike(_WHOLE), F.substring_index(bare, ".", 1).cast("int"))


def decimal_or_null(text: Column) -> Column:
    """Decimal of two places; blanks around it are allowed."""
    bare = F.trim(text)
    return F.when(bare.rlike(_DECIMAL), bare.cast(AMOUNT))


def strict_decimal_or_null(text: Column) -> Column:
    """Decimal of two places; text with blanks around the number is not well formed."""
    return F.when(text.rlike(_DECIMAL), text.cast(AMOUNT))


def timestamp(text: Column) -> Column:
    """Wall-clock timestamp. A zone is dropped; malformed text is an error under ANSI mode."""
    return text.cast("timestamp_ntz")


def timestamp_or_null(text: Column) -> Column:
    """As ``timestamp``, with NULL for malformed text."""
    return text.try_cast("timestamp_ntz")


def trimmed(text: Column) -> Column:
    """Text without surrounding spaces (spaces only, other white space stays)."""
    return F.trim(text)
