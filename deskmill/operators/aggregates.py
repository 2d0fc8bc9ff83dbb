"""Counts, profiles and summaries over workspace records."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskmill.functions.addresses import cell_label, range_label
from deskmill.functions.colors import channel, hex_color
from deskmill.operators.intervals import cells_in_ranges
from deskmill.operators.percentiles import percentile_points
from deskmill.session import durable_cut


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def document_stats(
    elements: DataFrame, segments: DataFrame | None = None, doc: str = "doc_id", docs: DataFrame | None = None
) -> DataFrame:
    """Per document: elements by kind, total length, table cells, largest table, header and footer.

    ``elements`` has ``pos, type, end_index`` and for tables ``n_rows, n_cols`` (columns of the first
    row); ``segments`` has ``doc, kind`` with kind ``header`` or ``footer``. With ``docs`` a document without
    any element has a row too, with counts of 0.
    """
    known = F.col("type").isin("paragraph", "table", "section_break", "table_of_contents")
    kind, size = F.col("type"), F.col("n_rows") * F.col("n_cols")
    table = kind == "table"
    stats = elements.groupBy(doc).agg(
        F.count_if(known).alias("n_elements"),
        F.count_if(table).alias("n_tables"),
        F.count_if(kind == "paragraph").alias("n_paragraphs"),
        F.count_if(kind == "section_break").alias("n_section_breaks"),
        F.max_by("end_index", F.when(known, F.col("pos"))).alias("total_length"),
        F.sum(F.when(table, size)).alias("n_table_cells"),
        F.max(F.when(table, size)).alias("largest_table"),
    )
    if docs is not None:
        stats = docs.select(doc).distinct().join(stats, doc, "left")
        counts = ("n_elements", "n_tables", "n_paragraphs", "n_section_breaks")
        stats = stats.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in counts})
    if segments is None:
        return stats
    flags = segments.groupBy(doc).agg(
        F.bool_or(F.col("kind") == "header").alias("has_headers"),
        F.bool_or(F.col("kind") == "footer").alias("has_footers"),
    )
    return stats.join(flags, doc, "left").withColumns(
        {c: F.coalesce(c, F.lit(False)) for c in ("has_headers", "has_footers")}
    )


def used_range(cells: DataFrame, sheet: str = "sheet_id") -> DataFrame:
    """Per sheet the tight rectangle of cells, its cell count, its start cell and its label."""
    corners = cells.groupBy(sheet).agg(
        F.min("row").alias("r0"), F.min("col").alias("c0"), F.max("row").alias("r1"), F.max("col").alias("c1")
    )
    count = (F.col("r1") - F.col("r0") + 1) * (F.col("c1") - F.col("c0") + 1)
    return corners.withColumns(
        {
            "n_cells": count.cast("bigint"),
            "start": cell_label(F.col("r0"), F.col("c0")),
            "label": range_label(F.col("r0"), F.col("c0"), F.col("r1"), F.col("c1")),
        }
    )


# The size limits of a table.
MAX_TABLE_ROWS = 1000
MAX_TABLE_COLUMNS = 20


def profile_table(rows: DataFrame, table: str = "table_id") -> DataFrame:
    """Per table its size and the first rule it breaks, or null.

    ``rows`` is one row per table row with the list ``cells``; a table without rows has one row with
    a null list.
    """
    width = F.when(F.col("cells").isNotNull(), F.size("cells"))
    hole = F.coalesce(F.exists("cells", lambda c: c.isNull()), F.lit(False))
    sizes = rows.groupBy(table).agg(
        F.count("cells").alias("n_rows"),
        F.count_if(width == 0).alias("n_empty_rows"),
        F.min(width).alias("min_width"),
        F.max(width).alias("max_width"),
        F.count_if(hole).alias("n_rows_with_null"),
    )
    reason = (
        F.when(F.col("n_rows") == 0, "empty table")
        .when(F.col("n_empty_rows") > 0, "empty rows")
        .when(F.col("min_width") != F.col("max_width"), "ragged rows")
        .when(F.col("n_rows") > MAX_TABLE_ROWS, "too many rows")
        .when(F.col("max_width") > MAX_TABLE_COLUMNS, "too many columns")
        .when(F.col("n_rows_with_null") > 0, "null cell")
    )
    return sizes.withColumn("reason", reason)


def find_replace(
    docs: DataFrame, find: str, replacement: str, match_case: bool = False, text: str = "text"
) -> DataFrame:
    """Documents with the literal replaced and ``n_replaced``, the number of occurrences."""
    pattern = ("" if match_case else "(?iu)") + "".join(re.escape(ch) for ch in find)
    safe = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return docs.withColumns(
        {
            "n_replaced": F.regexp_count(F.col(text), F.lit(pattern)).cast("bigint"),
            text: F.regexp_replace(F.col(text), pattern, safe),
        }
    )


def replace_totals(replaced: DataFrame) -> DataFrame:
    """Documents changed and occurrences over all documents."""
    return replaced.agg(
        F.count_if(F.col("n_replaced") > 0).alias("n_docs"), F.sum("n_replaced").alias("n_replaced")
    )


def outcome_summary(results: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Per batch and reason, per batch, and over all: requests that succeeded and that failed.

    ``reason`` is null for a success. ``level`` is 0 for (batch, reason), 1 for a batch, 2 for all.
    """
    failed = F.col("reason").isNotNull()
    return (
        results.withColumn("outcome", F.coalesce("reason", F.lit("ok")))
        .rollup(batch, "outcome")
        .agg(
            F.count_if(~failed).alias("n_ok"),
            F.count_if(failed).alias("n_failed"),
            F.grouping_id().alias("_level"),
        )
        .withColumn("level", F.when(F.col("_level") == 0, 0).when(F.col("_level") == 1, 1).otherwise(2))
        .drop("_level")
    )


def reply_summary(replies: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Per batch: replies, and items created (``created_id`` given)."""
    return replies.groupBy(batch).agg(
        F.count("*").alias("n_replies"), F.count("created_id").alias("n_created")
    )


def label_catalog(labels: DataFrame, items: DataFrame) -> DataFrame:
    """Labels with their kind (anything not ``system`` is ``user``) and the items that have them.

    ``labels`` has ``label, type``; ``items`` has the list ``labels``.
    """
    used = items.select(F.explode(F.array_distinct("labels")).alias("label")).groupBy("label").agg(
        F.count("*").alias("n_items")
    )
    kind = F.when(F.col("type") == "system", "system").otherwise("user")
    return labels.select("label", kind.alias("kind")).join(used, "label", "left").withColumn(
        "n_items", F.coalesce("n_items", _zero())
    )


def facet_counts(hits: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``facet, value, n_hits`` for each value of each column, and the total under ``(all)``.

    All facets come out of one grouping-sets aggregate.
    """
    sets = [[F.col(c)] for c in columns] + [[]]
    counted = hits.groupingSets(sets, *columns).agg(
        F.count("*").alias("n_hits"), *[F.grouping(c).alias(f"_{c}") for c in columns]
    )
    facet, value = F.lit("(all)"), F.lit(None).cast("string")
    for c in columns:
        facet = F.when(F.col(f"_{c}") == 0, F.lit(c)).otherwise(facet)
        value = F.when(F.col(f"_{c}") == 0, F.col(c).cast("string")).otherwise(value)
    return counted.select(facet.alias("facet"), value.alias("value"), "n_hits")


# Bucket length per grain and its offset; weeks start on Monday, four days after the
# epoch's Thursday.
GRAINS = {"DAILY": ("1 day", "0 days"), "WEEKLY": ("7 days", "4 days")}


def metric_window(ts: str, grain: str) -> Column:
    """The bucket of a run, for batch and streaming use."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}")
    length, offset = GRAINS[grain]
    return F.window(F.col(ts), length, startTime=offset)


def execution_metrics(runs: DataFrame, grain: str = "DAILY") -> DataFrame:
    """Active users, executions and failures per day or week; empty buckets in between are zero.

    ``runs`` has ``ts, user_id, failed`` and is read once: each bucket that has runs gives the empty
    ones up to the next, over a window of one row per bucket.
    """
    counts = (
        runs.groupBy(metric_window("ts", grain).alias("w"))
        .agg(
            F.count_distinct("user_id").alias("active_users"),
            F.count("*").alias("total_executions"),
            F.count_if("failed").alias("failed_executions"),
        )
        .select("w.start", "active_users", "total_executions", "failed_executions")
    )
    return fill_buckets(counts, grain)


def fill_buckets(counts: DataFrame, grain: str) -> DataFrame:
    """Buckets (``start`` and counts) with empty ones in between, as ``start_time``, ``end_time`` and the counts."""
    step = F.expr(f"INTERVAL {GRAINS[grain][0]}")
    following = F.coalesce(F.lead("start").over(Window.orderBy("start")), F.col("start") + step)
    names = ("active_users", "total_executions", "failed_executions")
    last = counts.withColumn("_last", following - step)
    filled = last.withColumn("start_time", F.explode(F.sequence("start", "_last", step)))
    return filled.select(
        "start_time",
        (F.col("start_time") + step).alias("end_time"),
        *[F.when(F.col("start_time") == F.col("start"), F.col(c)).otherwise(_zero()).alias(c) for c in names],
    )


def duration_seconds(text: Column) -> Column:
    """``5s`` or ``1.25s`` to seconds."""
    return F.regexp_extract(text, r"^([0-9]+(?:\.[0-9]+)?)s$", 1).try_cast("double")


def execution_status(runs: DataFrame) -> DataFrame:
    """Runs per function and status with average and 95th percentile of the duration.

    ``runs`` has ``function_name, status, duration`` (text such as ``5s``); missing names are
    ``Unknown``.
    """
    keys = ["function_name", "status"]
    timed = runs.select(
        *[F.coalesce(k, F.lit("Unknown")).alias(k) for k in keys], duration_seconds(F.col("duration")).alias("seconds")
    )
    counts = timed.groupBy(*keys).agg(
        F.count("*").alias("n_runs"), F.round(F.avg("seconds"), 6).alias("avg_seconds")
    )
    wanted = counts.select(*keys, F.lit(0.95).alias("fraction"))
    high = percentile_points(timed, keys, "seconds", wanted)
    return counts.join(high, keys, "left").select(
        *keys, "n_runs", "avg_seconds", F.round("point", 6).alias("p95_seconds")
    )


def gradient_points(cells: DataFrame, rules: DataFrame, sheet: str = "sheet_id") -> DataFrame:
    """Cells with the color a two- or three-point scale gives them, per rule.

    ``rules`` has a range (``r0 … c1``) and ``points``, a list of ``type, value, color``. Points are
    resolved over the numbers in the range: MIN, MAX, NUMBER, PERCENT (of the span) and PERCENTILE.
    """
    inside = cells_in_ranges(cells, rules, sheet).withColumn("v", F.col("value").try_cast("double"))
    # Spans, percentiles and colors all need the numbers in the ranges, which are looked up once.
    numbers = durable_cut(inside.filter(F.col("v").isNotNull()).select(*cells.columns, "rule_idx", "v"))
    spans = numbers.groupBy("rule_idx").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    points = rules.select("rule_idx", F.posexplode("points").alias("k", "p")).select("rule_idx", "k", "p.*")
    share = F.col("value").try_cast("double") / 100
    wanted = points.filter(F.col("type") == "PERCENTILE").select("rule_idx", share.alias("fraction"))
    ranks = percentile_points(numbers, ["rule_idx"], "v", wanted)
    placed = (
        points.withColumn("fraction", F.when(F.col("type") == "PERCENTILE", share))
        .join(spans, "rule_idx")
        .join(ranks, ["rule_idx", "fraction"], "left")
    )
    at = (
        F.when(F.col("type") == "MIN", F.col("lo"))
        .when(F.col("type") == "MAX", F.col("hi"))
        .when(F.col("type") == "NUMBER", F.col("value").try_cast("double"))
        .when(F.col("type") == "PERCENT", F.col("lo") + share * (F.col("hi") - F.col("lo")))
        .otherwise(F.col("point"))
    )
    stop = F.struct(at.alias("at"), *[channel(F.col("color"), i).alias(f"c{i}") for i in range(3)])
    stops = [F.max(F.when(F.col("k") == k, stop)).alias(f"p{k}") for k in range(3)]
    # Two points: the second one is the last.
    scale = placed.groupBy("rule_idx").agg(*stops).withColumn("last", F.coalesce("p2", "p1"))

    def between(v: Column, i: int) -> Column:
        def ramp(a: str, b: str) -> Column:
            part = (v - F.col(f"{a}.at")) / F.nullif(F.col(f"{b}.at") - F.col(f"{a}.at"), F.lit(0.0))
            return F.col(f"{a}.c{i}") + F.coalesce(part, F.lit(0.0)) * (F.col(f"{b}.c{i}") - F.col(f"{a}.c{i}"))

        return (
            F.when(v <= F.col("p0.at"), F.col(f"p0.c{i}"))
            .when(v >= F.col("last.at"), F.col(f"last.c{i}"))
            .when(v <= F.col("p1.at"), ramp("p0", "p1"))
            .otherwise(ramp("p1", "p2"))
        )

    value = F.col("v")
    return numbers.join(scale, "rule_idx").select(
        *cells.columns, "rule_idx", hex_color(*[between(value, i) for i in range(3)]).alias("color")
    )


def comment_threads(comments: DataFrame, replies: DataFrame, include_resolved: bool = False) -> DataFrame:
    """Comments with reply count and last reply; resolved ones only when asked for.

    ``comments`` has ``file_id, comment_id, author, content, anchor, resolved``; ``replies`` has
    ``comment_id, created``.
    """
    kept = comments if include_resolved else comments.filter(~F.coalesce("resolved", F.lit(False)))
    talk = replies.groupBy("comment_id").agg(
        F.count("*").alias("n_replies"), F.max("created").alias("last_reply")
    )
    return kept.join(talk, "comment_id", "left").withColumns(
        {
            "author": F.coalesce("author", F.lit("Unknown")),
            "content": F.coalesce("content", F.lit("")),
            "anchor": F.coalesce("anchor", F.lit("")),
            "resolved": F.coalesce("resolved", F.lit(False)),
            "n_replies": F.coalesce("n_replies", _zero()),
        }
    )


def comment_replies(comments: DataFrame, replies: DataFrame) -> DataFrame:
    """Each comment with its replies, a row per reply; a comment without any keeps one row.

    ``comments`` has ``file_id, comment_id, author, content, created, resolved``; ``replies`` has
    ``comment_id, reply_id, author, content, created``.
    """
    said = replies.select(
        "comment_id",
        "reply_id",
        F.coalesce("author", F.lit("Unknown")).alias("reply_author"),
        F.coalesce("content", F.lit("")).alias("reply_content"),
        F.col("created").alias("reply_created"),
    )
    named = comments.select(
        "file_id",
        "comment_id",
        F.coalesce("author", F.lit("Unknown")).alias("author"),
        F.coalesce("content", F.lit("")).alias("content"),
        "created",
        F.coalesce("resolved", F.lit(False)).alias("resolved"),
    )
    return named.join(said, "comment_id", "left")


def comment_share(comments: DataFrame) -> DataFrame:
    """Per file: comments, open ones, and their share."""
    open_ = ~F.coalesce("resolved", F.lit(False))
    return comments.groupBy("file_id").agg(
        F.count("*").alias("n_comments"),
        F.count_if(open_).alias("n_open"),
        F.round(F.count_if(open_) / F.count("*"), 6).alias("open_share"),
    )


def form_response_counts(responses: DataFrame, questions: DataFrame) -> DataFrame:
    """Per response: answers given, and required questions without an answer.

    ``responses`` has ``form_id, response_id`` and the map ``answers``; ``questions`` has
    ``form_id, question_id, required``. A form's required questions are one list, so each response is
    settled in its own row.
    """
    required = questions.filter("required").groupBy("form_id").agg(F.collect_set("question_id").alias("_required"))
    none = F.array().cast("array<string>")
    answered = F.coalesce(F.map_keys(F.map_filter("answers", lambda _, given: F.size(given) > 0)), none)
    narrow = responses.select(
        "form_id",
        "response_id",
        F.size(F.coalesce(F.map_keys("answers"), none)).cast("bigint").alias("n_answers"),
        answered.alias("_answered"),
    )
    missing = F.size(F.array_except(F.coalesce("_required", none), "_answered")).cast("bigint")
    return narrow.join(required, "form_id", "left").select(
        "form_id", "response_id", "n_answers", missing.alias("n_required_missing")
    )


def question_rates(responses: DataFrame, questions: DataFrame) -> DataFrame:
    """Per question: responses that answer it, and their share of the responses of the form."""
    answers = responses.select("form_id", F.explode("answers").alias("question_id", "given"))
    answered = answers.filter(F.size("given") > 0).groupBy("form_id", "question_id").agg(
        F.count("*").alias("n_answered")
    )
    totals = responses.groupBy("form_id").agg(F.count("*").alias("n_responses"))
    return (
        questions.join(totals, "form_id", "left")
        .join(answered, ["form_id", "question_id"], "left")
        .withColumns(
            {"n_answered": F.coalesce("n_answered", _zero()), "n_responses": F.coalesce("n_responses", _zero())}
        )
        .withColumn("answered_rate", F.round(F.col("n_answered") / F.nullif("n_responses", _zero()), 6))
    )
