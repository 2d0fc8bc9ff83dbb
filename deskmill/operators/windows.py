"""Ordered operators: threads, list numbering, rendering, calendars, first table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskmill.functions.markdown import heading_prefix, paragraph_markdown, table_markdown
from deskmill.functions.text import stripped
from deskmill.operators.running import CHUNK, Running, by_position, by_time, ranged, running
from deskmill.session import durable_cut


def _one() -> Column:
    return F.lit(1).cast("bigint")


def assemble_threads(messages: DataFrame, thread: str = "thread_id", pos: str = "pos") -> DataFrame:
    """Number the messages of a thread and give all of them the subject of the first one.

    ``messages`` has ``sender``, ``date`` and ``subject`` taken from headers by exact name. The
    message keeps a subject of its own only where it differs from that of the thread.
    """
    named = messages.withColumns(
        {
            "sender": F.coalesce("sender", F.lit("(unknown sender)")),
            "date": F.coalesce("date", F.lit("(unknown date)")),
            "subject": F.coalesce("subject", F.lit("(no subject)")),
        }
    )
    numbered = running(
        named,
        [thread],
        [pos],
        by_position(pos),
        {
            "message_no": Running("sum", _one()),
            "n_messages": Running("group_sum", _one()),
            "thread_subject": Running("group_first", F.col("subject")),
        },
    )
    return numbered.withColumn("subject", F.nullif("subject", "thread_subject"))


def _flagged(elements: DataFrame) -> DataFrame:
    """Paragraphs and tables with the flags that numbering and rendering go by."""
    blank = (F.col("type") == "paragraph") & (stripped(F.coalesce("text", F.lit(""))) == "")
    listed = (F.col("type") == "paragraph") & ~blank & F.col("list_id").isNotNull()
    return elements.filter(F.col("type").isin("paragraph", "table")).withColumns(
        {"is_blank": blank, "is_item": listed, "nesting": F.coalesce("nesting", F.lit(0))}
    )


def _is_break() -> Column:
    return ~F.col("is_blank") & ~F.col("is_item")


def _counts() -> Column:
    return F.col("is_item") & F.coalesce("ordered", F.lit(False))


def list_numbering(elements: DataFrame, doc: str = "doc_id", pos: str = "pos") -> DataFrame:
    """Paragraphs and tables with the number of every ordered list item.

    Counts run per (list, nesting) and start again after a non-blank, non-list paragraph or a
    table that directly follows a list item. A blank paragraph, bulleted or not, ends the list
    without starting the counts again; other element kinds are passed over.

    One scan in chunks of positions: elements are numbered inside their chunk and written. What a chunk hands on is whether it starts the counts
    again, and its counts since it last did; a chunk that does so forgets what came before. That is put together over the chunks and
    joined once.
    """
    placed = _flagged(elements).withColumns({CHUNK: by_position(pos), "_list": F.coalesce("list_id", F.lit("")), "_break": _is_break(), "_count": _counts()})
    here = Window.partitionBy(doc, CHUNK)
    so_far = here.orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The element before the first one of a chunk is known to the chunk before.
    inside = placed.withColumns({"_first": F.lag(F.lit(False), 1, True).over(here.orderBy(pos)), "resets": F.col("_break") & F.lag("is_item", 1, False).over(here.orderBy(pos))})
    inside = inside.withColumn("_section", F.sum(F.col("resets").cast("int")).over(so_far))
    same = Window.partitionBy(doc, CHUNK, "_section", "_list", "nesting").orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumns({"_last": F.max("_section").over(here), "_no": F.sum(F.col("_count").cast("bigint")).over(same)})
    local = durable_cut(inside)

    order = F.col(pos)
    ends = local.groupBy(doc, CHUNK).agg(F.min_by("_break", order).alias("_opens"), F.max_by("is_item", order).alias("_closes"), F.max("_last").alias("_last"))
    chunks = Window.partitionBy(doc).orderBy(CHUNK)
    starts = ends.withColumn("_starts", F.col("_opens") & F.lag("_closes", 1, False).over(chunks))
    again = (F.col("_starts") | (F.col("_last") > 0)).cast("int")
    before = F.sum(again).over(chunks.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - again
    epochs = starts.select(doc, CHUNK, "_starts", before.alias("_before"), (before + again).alias("_after"))

    counted = F.sum(F.when((F.col("_section") == F.col("_last")) & F.col("_count"), 1).otherwise(0)).cast("bigint")
    tails = local.groupBy(doc, CHUNK, "_list", "nesting").agg(counted.alias("_tail")).join(epochs, [doc, CHUNK])
    # A chunk takes over the counts of its epoch so far, and then adds its own to the epoch it ends in.
    taken = F.struct(F.col("_before").alias("epoch"), F.lit(0).alias("turn"), F.lit(0).cast("bigint").alias("n"))
    given = F.struct(F.col("_after").alias("epoch"), F.lit(1).alias("turn"), F.col("_tail").alias("n"))
    turns = tails.select(doc, CHUNK, "_list", "nesting", "_starts", F.explode(F.array(taken, given)).alias("_turn"))
    running_sum = Window.partitionBy(doc, "_list", "nesting", "_turn.epoch").orderBy(CHUNK, "_turn.turn")
    summed = turns.withColumn("_carry", F.sum("_turn.n").over(running_sum.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    carry = summed.filter("_turn.turn = 0").select(doc, CHUNK, "_list", "nesting", "_starts", "_carry")

    joined = local.join(carry, [doc, CHUNK, "_list", "nesting"])
    carried = F.when((F.col("_section") == 0) & ~F.col("_starts"), F.col("_carry")).otherwise(0)
    number = F.when(F.col("_count"), F.col("_no") + carried)
    names = [*elements.columns, *[c for c in ("is_blank", "is_item", "nesting") if c not in elements.columns]]
    return joined.select(*names, (F.col("resets") | (F.col("_first") & F.col("_starts"))).alias("resets"), number.alias("item_no"))


def _numbered_together(flagged: DataFrame, doc: str, pos: str) -> DataFrame:
    """The numbering of ``list_numbering`` with each document in one task, after one shuffle."""
    so_far = (Window.unboundedPreceding, Window.currentRow)
    order = Window.partitionBy(doc).orderBy(pos)
    resets = _is_break() & F.coalesce(F.lag("is_item").over(order), F.lit(False))
    section = F.sum(F.col("resets").cast("bigint")).over(order.rowsBetween(*so_far))
    same_list = Window.partitionBy(doc, "_section", F.coalesce("list_id", F.lit("")), "nesting")
    number = F.sum(_counts().cast("bigint")).over(same_list.orderBy(pos).rowsBetween(*so_far))
    sections = flagged.withColumn("resets", resets).withColumn("_section", section)
    return sections.withColumn("item_no", F.when(_counts(), number)).drop("_section")


def _body() -> Column:
    """A table, or the text of a paragraph behind the mark of its style."""
    heading = F.when(F.col("is_item"), "").otherwise(heading_prefix(F.coalesce("style", F.lit("NORMAL_TEXT"))))
    return F.when(F.col("type") == "table", table_markdown(F.col("table_rows"))).otherwise(F.concat(heading, F.col("text")))


def _block() -> Column:
    """``body`` with its bullet or number, or the line breaks around it."""
    indent = F.repeat(F.when(F.col("item_no").isNotNull(), F.lit("   ")).otherwise(F.lit("  ")), F.col("nesting"))
    bullet = F.coalesce(F.concat(F.col("item_no").cast("string"), F.lit(". ")), F.lit("- "))
    gap = F.when(F.col("resets"), F.lit("\n")).otherwise("")
    return F.when(F.col("is_item"), F.concat(indent, bullet, F.col("body"))).otherwise(
        F.concat(gap, F.col("body"), F.lit("\n"))
    )


def markdown_blocks(elements: DataFrame, doc: str = "doc_id", pos: str = "pos") -> DataFrame:
    """One Markdown block per element that shows: ``(doc, pos, block)``, for documents of any size.

    Besides the columns of ``list_numbering`` an element has ``runs`` (text runs of a paragraph),
    ``style`` and ``table_rows`` (rows of cells of paragraphs of runs).
    """
    numbered = list_numbering(elements.withColumn("text", paragraph_markdown(F.col("runs"))), doc, pos)
    shown = numbered.filter(~F.col("is_blank")).withColumn("body", _body())
    return shown.select(doc, pos, _block().alias("block"))


def render_markdown(elements: DataFrame, doc: str = "doc_id", pos: str = "pos") -> DataFrame:
    """One Markdown text per document, from the columns of ``markdown_blocks``.

    As the blocks of a document become one value, they meet in one task anyway: paragraphs and tables
    are rendered where they lie and shuffled once, for numbering and joining alike.
    """
    flagged = _flagged(elements.withColumn("text", paragraph_markdown(F.col("runs"))))
    rendered = flagged.select(
        doc, pos, "is_blank", "is_item", "list_id", "nesting", "ordered", _body().alias("body")
    )
    shown = _numbered_together(rendered, doc, pos).filter(~F.col("is_blank"))
    whole = F.expr(f"listagg(block, '\\n') WITHIN GROUP (ORDER BY {pos})")
    return (
        shown.select(doc, pos, _block().alias("block"))
        .groupBy(doc)
        .agg(whole.alias("body"))
        .select(doc, F.concat(F.rtrim("body", F.lit("\n")), F.lit("\n")).alias("markdown"))
    )


def free_busy(
    events: DataFrame,
    tmin: Column,
    tmax: Column,
    calendar: str = "calendar_id",
    event: str = "event_id",
    calendars: DataFrame | None = None,
) -> DataFrame:
    """Busy intervals per calendar inside ``[tmin, tmax)``; overlapping and touching ones are merged.

    Calendars of ``calendars`` without a busy interval get one row with null bounds (free).
    """
    inside = events.select(
        calendar,
        event,
        F.greatest(F.col("start_ts"), tmin).alias("start_ts"),
        F.least(F.col("end_ts"), tmax).alias("end_ts"),
    ).filter(F.col("start_ts") < F.col("end_ts"))
    # All events that run at tmin start there, so chunks go by the number of events, not by the day.
    clipped = ranged(inside, [calendar], ["start_ts", event])
    merged = running(
        clipped,
        [calendar],
        ["start_ts", event],
        F.col(CHUNK),
        {
            "reach": Running("max", F.col("end_ts"), before=True),
            "earlier": Running("sum", _one(), before=True),
        },
    )
    # An interval opens where nothing before it reaches it. All that came before the next opening
    # belongs to it, so its end and its count are read off there.
    opening = durable_cut(
        merged.filter(F.col("reach").isNull() | (F.col("start_ts") > F.col("reach"))).select(
            calendar, CHUNK, "start_ts", "reach", F.coalesce("earlier", F.lit(0)).alias("earlier")
        )
    )
    ends = running(
        opening,
        [calendar],
        ["start_ts"],
        F.col(CHUNK),
        {"next_reach": Running("lead", F.col("reach")), "next_earlier": Running("lead", F.col("earlier"))},
    )
    totals = clipped.groupBy(calendar).agg(F.max("end_ts").alias("last"), F.count("*").alias("all"))
    busy = ends.join(totals, calendar).select(
        calendar,
        "start_ts",
        F.coalesce("next_reach", "last").alias("end_ts"),
        (F.coalesce("next_earlier", "all") - F.col("earlier")).alias("n_events"),
    )
    if calendars is None:
        return busy
    idle = calendars.select(calendar).distinct().join(busy.select(calendar).distinct(), calendar, "left_anti")
    return busy.unionByName(idle.withColumn("n_events", F.lit(0).cast("bigint")), allowMissingColumns=True)


def free_gaps(busy: DataFrame, tmin: Column, tmax: Column, calendar: str = "calendar_id") -> DataFrame:
    """The parts of ``[tmin, tmax)`` that ``busy`` (as given by ``free_busy``) leaves free."""
    taken = busy.filter(F.col("start_ts").isNotNull())
    before = running(
        taken,
        [calendar],
        ["start_ts"],
        by_time("start_ts"),
        {"free_from": Running("lag", F.col("end_ts"))},
    ).select(
        calendar,
        F.coalesce(F.col("free_from"), tmin).alias("free_from"),
        F.col("start_ts").alias("free_to"),
    )
    tail = busy.groupBy(calendar).agg(F.coalesce(F.max("end_ts"), tmin).alias("free_from"))
    tail = tail.select(calendar, "free_from", tmax.alias("free_to"))
    return before.unionByName(tail).filter(F.col("free_from") < F.col("free_to"))


def find_first_table(
    cells: DataFrame, text: str, doc: str = "doc_id", match_case: bool = False
) -> DataFrame:
    """Per document the first table with a cell that holds ``text``."""
    content = F.col("text") if match_case else F.lower("text")
    wanted = text if match_case else text.lower()
    return (
        cells.filter(F.contains(content, F.lit(wanted)))
        .groupBy(doc)
        .agg(F.min("table_idx").alias("table_idx"))
    )
