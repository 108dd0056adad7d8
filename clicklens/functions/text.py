"""Repair of damaged text fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits of the largest BIGINT.
BIGINT_DIGITS = 19


def _sci_parts(text: Column) -> tuple[Column, Column, Column]:
    """Where the ``e`` is, the digits before it, and the width asked for."""
    mark = F.instr(text, "e")
    digits = F.replace(F.substring(text, F.lit(1), mark - 1), F.lit(","), F.lit(""))
    # two characters are skipped: the "e" and the sign
    exponent = F.substring(text, mark + 2, F.length(text)).try_cast("double")
    return mark, digits, exponent.try_cast("int").cast("bigint") + 1


def expand_sci_text(text: Column) -> Column:
    """Integer text for scientific text such as ``1,404e+12``, else NULL.

    The digits before the ``e`` lose their commas and are padded with zeros up
    to the width the exponent asks for; longer digits stay as they are. An
    exponent that is no INT gives NULL.
    """
    mark, digits, width = _sci_parts(text)
    padded = F.when(F.length(digits) >= width, digits).otherwise(
        F.rpad(digits, width.try_cast("int"), F.lit("0"))
    )
    return F.when(mark > 0, padded)


def sci_number(text: Column) -> Column:
    """``expand_sci_text`` as a BIGINT, NULL where it is none.

    A width beyond BIGINT is never written out: only zeros have a value then.
    """
    mark, digits, width = _sci_parts(text)
    number = (
        F.when(F.length(digits) >= width, digits.try_cast("bigint"))
        .when(
            width <= BIGINT_DIGITS,
            F.rpad(digits, width.try_cast("int"), F.lit("0")).try_cast("bigint"),
        )
        .when((width > BIGINT_DIGITS) & digits.rlike("^0+$"), F.lit(0))
    )
    return F.when(mark > 0, number)


def merged_page_url(merged: Column) -> Column:
    """The page URL of a merged field: all up to the first of a quote pair."""
    pair = F.instr(merged, '""')
    return F.when(pair > 0, F.substring(merged, F.lit(1), pair))


def merged_previous_page(merged: Column) -> Column:
    """The previous page of a merged field: all after a quote pair, no spaces."""
    pair = F.instr(merged, '""')
    rest = F.substring(merged, pair + 2, F.length(merged))
    return F.when(pair > 0, F.replace(rest, F.lit(" "), F.lit("")))


def strip_marks(text: Column) -> Column:
    """Text without backslashes, bars and double quotes."""
    return F.regexp_replace(text, r'[\\|"]', "")
