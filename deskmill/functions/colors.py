"""Colors as ``#RRGGBB`` and as numbers between 0 and 1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def channel(color: Column, position: int) -> Column:
    """Red (0), green (1) or blue (2) of ``#RRGGBB`` or ``RRGGBB`` as 0..1; null if malformed."""
    digits = F.regexp_replace(F.trim(color), "^#", "")
    pair = F.substring(digits, 1 + 2 * position, 2)
    number = F.conv(pair, 16, 10).cast("double") / 255
    return F.when(digits.rlike("^[0-9A-Fa-f]{6}$"), number)


def hex_color(red: Column, green: Column, blue: Column) -> Column:
    """``#RRGGBB`` from channels of 0..1; out-of-range channels are clamped, missing ones are 0."""

    def pair(value: Column) -> Column:
        level = F.bround(F.coalesce(value, F.lit(0.0)) * 255, 0).cast("bigint")
        return F.lpad(F.hex(F.greatest(F.lit(0), F.least(F.lit(255), level))), 2, "0")

    return F.concat(F.lit("#"), pair(red), pair(green), pair(blue))
