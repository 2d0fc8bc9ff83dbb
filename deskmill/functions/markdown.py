"""Markdown for runs, paragraphs and tables, as expressions over nested columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deskmill.functions.text import stripped

# Heading prefix per paragraph style, and the fonts that mean code.
HEADINGS = {
    "TITLE": "#",
    "SUBTITLE": "##",
    "HEADING_1": "#",
    "HEADING_2": "##",
    "HEADING_3": "###",
    "HEADING_4": "####",
    "HEADING_5": "#####",
    "HEADING_6": "######",
}
MONO_FONTS = ("Courier New", "Consolas", "Roboto Mono", "Source Code Pro")

RUN_TYPE = (
    "struct<content:string,bold:boolean,italic:boolean,strikethrough:boolean,font:string,url:string>"
)


def _wrapped(text: Column, mark: str) -> Column:
    return F.concat(F.lit(mark), text, F.lit(mark))


def run_markdown(run: Column) -> Column:
    """One text run with its emphasis, strike-through, link or code marks."""
    text = F.rtrim(run["content"], F.lit("\n"))
    bold, italic = F.coalesce(run["bold"], F.lit(False)), F.coalesce(run["italic"], F.lit(False))
    marked = (
        F.when(bold & italic, _wrapped(text, "***"))
        .when(bold, _wrapped(text, "**"))
        .when(italic, _wrapped(text, "*"))
        .otherwise(text)
    )
    struck = F.when(run["strikethrough"], _wrapped(marked, "~~")).otherwise(marked)
    linked = F.when(
        F.coalesce(run["url"], F.lit("")) != "",
        F.concat(F.lit("["), struck, F.lit("]("), run["url"], F.lit(")")),
    ).otherwise(struck)
    return (
        F.when(F.coalesce(text, F.lit("")) == "", "")
        .when(run["font"].isin(*MONO_FONTS), _wrapped(text, "`"))
        .otherwise(linked)
    )


def paragraph_markdown(runs: Column) -> Column:
    """All runs of a paragraph, stripped; empty for a missing list."""
    return stripped(F.coalesce(F.array_join(F.transform(runs, run_markdown), ""), F.lit("")))


def cell_markdown(paragraphs: Column) -> Column:
    """Non-blank paragraphs of a cell joined by a blank, pipes escaped."""
    texts = F.filter(F.transform(paragraphs, paragraph_markdown), lambda t: t != "")
    return F.replace(F.array_join(texts, " "), F.lit("|"), F.lit("\\|"))


def table_markdown(rows: Column) -> Column:
    """Rows of cells of paragraphs of runs, with the separator line after the first row."""
    lines = F.transform(
        rows,
        lambda row, i: F.concat(
            F.lit("| "),
            F.array_join(F.transform(row, cell_markdown), " | "),
            F.lit(" |"),
            F.when(
                i == 0,
                F.concat(
                    F.lit("\n| "),
                    F.array_join(F.transform(row, lambda _: F.lit("---")), " | "),
                    F.lit(" |"),
                ),
            ).otherwise(""),
        ),
    )
    return F.coalesce(F.array_join(lines, "\n"), F.lit(""))


def heading_prefix(style: Column) -> Column:
    """``## `` for a heading style, empty for body text."""
    prefix = F.lit("")
    for name, mark in HEADINGS.items():
        prefix = F.when(style == name, F.lit(f"{mark} ")).otherwise(prefix)
    return prefix
