"""Spreadsheet addresses: column letters, quoted titles, cell and range labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _letter(n: Column) -> Column:
    return F.char((n + 65).cast("bigint"))


# Seven letters name more columns than a 32-bit number counts.
MAX_LETTERS = 7


def column_letters(index: Column) -> Column:
    """Zero-based column number to letters: 0 A, 25 Z, 26 AA, 18278 AAAA."""
    letters, first = F.lit(None).cast("string"), 0
    spans = []
    for n in range(1, MAX_LETTERS + 1):
        spans.append((n, first, first + 26**n))
        first += 26**n
    for n, low, high in reversed(spans):
        rest = index.cast("bigint") - low
        written = F.concat(*[_letter(F.floor(rest / 26 ** (n - 1 - i)) % 26) for i in range(n)])
        letters = F.when((index >= low) & (index < high), written).otherwise(letters)
    return letters


def column_index(letters: Column) -> Column:
    """Column letters to a zero-based number; null for blank input."""
    codes = F.transform(F.split(F.upper(letters), ""), F.ascii)
    number = F.aggregate(codes, F.lit(0), lambda acc, code: acc * 26 + (code - 64))
    return F.when(letters != "", number - 1)


def quoted_title(title: Column) -> Column:
    """A sheet title as used in front of ``!``: quoted unless it is letters, digits or ``_``."""
    inner = F.replace(title, F.lit("'"), F.lit("''"))
    return F.when(title.rlike("^[A-Za-z0-9_]+$"), title).otherwise(
        F.concat(F.lit("'"), inner, F.lit("'"))
    )


def cell_label(row: Column, col: Column) -> Column:
    """``B3`` for row 2, column 1."""
    return F.concat(column_letters(col), (row + 1).cast("string"))


def cell_address(title: Column, row: Column, col: Column) -> Column:
    """``'My sheet'!B3``."""
    return F.concat(quoted_title(title), F.lit("!"), cell_label(row, col))


def range_label(row0: Column, col0: Column, row1: Column, col1: Column) -> Column:
    """``B3:D9`` with inclusive corners; a single cell has one label."""
    first, last = cell_label(row0, col0), cell_label(row1, col1)
    return F.when(first == last, first).otherwise(F.concat(first, F.lit(":"), last))


# One corner of a range: letters, digits or both, each perhaps behind a dollar sign.
_CORNER = r"^\$?([A-Za-z]*)\$?([0-9]*)$"


def range_bounds(text: Column) -> Column:
    """``'My sheet'!B3:D9`` as ``sheet, r0, r1, c0, c1, valid``: zero-based, half-open, null where open.

    Without a title ``sheet`` is null. A text that is no range has null bounds and is not ``valid``.
    """

    def split(t: Column) -> Column:
        inner = F.replace(F.regexp_extract(t, "^'(.*?)'!", 1), F.lit("''"), F.lit("'"))
        plain = F.btrim(F.btrim(F.regexp_extract(t, "^([^!]*)!", 1)), F.lit("'"))
        sheet = F.when(t.rlike("^'.*?'!"), inner).when(F.contains(t, F.lit("!")), plain)
        area = F.regexp_replace(t, "^(?:'.*?'!|[^!]*!)", "")
        corners = F.when(F.contains(area, F.lit(":")), F.split(area, ":", 2)).otherwise(F.array(area, area))
        return F.struct(sheet.alias("sheet"), corners.alias("corners"))

    def bounds(parts: Column) -> Column:
        first, last = parts["corners"][0], parts["corners"][1]
        valid = F.coalesce(F.forall(parts["corners"], lambda c: (c != "") & c.rlike(_CORNER)), F.lit(False))

        def row(corner: Column) -> Column:
            return F.regexp_extract(corner, _CORNER, 2).try_cast("bigint")

        def col(corner: Column) -> Column:
            return column_index(F.regexp_extract(corner, _CORNER, 1))

        found = {"r0": row(first) - 1, "r1": row(last), "c0": col(first), "c1": col(last) + 1}
        return F.struct(
            parts["sheet"].alias("sheet"), *[F.when(valid, b).alias(n) for n, b in found.items()], valid.alias("valid")
        )

    # Inside a list of one, the text and its parts are computed once, however often they are used.
    return F.transform(F.transform(F.array(text), split), bounds)[0]
