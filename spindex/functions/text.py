"""Scalar text helpers: natural sort key, fixed-width padding, score format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def natural_key(name: Column) -> Column:
    """Version-sort key of the part of ``name`` before its first dot.

    Digit runs become ``<10-digit length><digits without leading zeros>``
    (numeric order, and before letters); other characters keep binary order,
    except that non-letters are prefixed with ``~`` so that they sort after
    letters, and that a ``~`` sorts even before the end of the name (U+0001
    against U+0002), as in version sort.
    """
    stem = F.substring_index(F.coalesce(name, F.lit("")), ".", 1)
    parts = F.regexp_extract_all(stem, F.lit("[0-9]+|[^0-9]+"), 0)

    def enc(s: Column) -> Column:
        digits = F.regexp_replace(s, "^0+", "")
        return F.when(s.rlike("^[0-9]"), F.concat(F.lpad(F.length(digits).cast("string"), 10, "0"), digits)) \
            .otherwise(F.regexp_replace(F.translate(s, "~", "\x01"), "([^A-Za-z\x01])", "~$1"))

    return F.concat(F.array_join(F.transform(parts, enc), ""), F.lit("\x02"))


def blanks(col: Column, width: Column | int) -> Column:
    """The blanks that a value lacks to ``width`` bytes of UTF-8; none if it is longer."""
    lacking = (F.lit(width) if isinstance(width, int) else width) - F.octet_length(col)
    return F.repeat(F.lit(" "), F.greatest(lacking, F.lit(0)).cast("int"))


def pad(col: Column, width: Column | int) -> Column:
    """Right-pad with blanks to ``width`` bytes; a longer value is kept whole."""
    c = col.cast("string")
    return F.concat(c, blanks(c, width))


def pad_left(col: Column, width: Column | int) -> Column:
    """Left-pad with blanks to ``width`` bytes; a longer value is kept whole."""
    c = col.cast("string")
    return F.concat(blanks(c, width), c)


def fixed_decimal(col: Column, decimals: int = 6) -> Column:
    """Fixed notation text of a double (no exponent), rounded on the exact
    binary value, half to even, as C and Python format. Java's ``%.nf``
    rounds the shortest decimal string half up instead (1/128 = 0.0078125
    would print 0.007813, not 0.007812); ``format_number`` rounds like C but
    groups thousands, so its separators are removed."""
    return F.replace(F.format_number(col, decimals), F.lit(","), F.lit(""))


def score_text(col: Column) -> Column:
    """Four-decimal score text of the result list."""
    return fixed_decimal(col, 4)
