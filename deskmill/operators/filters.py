"""Filters and predicates over files, events, tasks, pages, cells and share requests."""

from __future__ import annotations

import operator
import re
from collections.abc import Iterable, Sequence
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmill.functions.addresses import cell_label
from deskmill.functions.sharing import SHARE_ROLES, SHARE_TYPES, is_public
from deskmill.functions.text import host, stripped
from deskmill.functions.times import is_rfc3339, literal_instant
from deskmill.operators.grams import Q, candidates, needle_tokens, text_posts
from deskmill.operators.intervals import cells_in_ranges
from deskmill.session import durable_cut

COMPARE = {"=": operator.eq, "!=": operator.ne, ">": operator.gt, "<": operator.lt}


def file_condition(field: str, op: str, value: Any) -> Column:
    """One ``(field, op, value)`` triple: a comparison, ``contains``, or ``in`` for a list field."""
    if op in COMPARE:
        return COMPARE[op](F.col(field), F.lit(value))
    if op == "contains":
        return F.contains(F.col(field), F.lit(value))
    if op == "in":
        return F.array_contains(F.col(field), value)
    raise ValueError(f"unknown operator {op!r}")


def filter_files(files: DataFrame, conditions: Iterable[tuple[str, str, Any]]) -> DataFrame:
    """Files for which all triples hold."""
    return files.filter(reduce(operator.and_, [file_condition(*c) for c in conditions], F.lit(True)))


def fulltext_contains(df: DataFrame, columns: Sequence[str], phrase: str) -> DataFrame:
    """Records with the phrase in any of the columns, whatever the case."""
    wanted = F.lit(phrase.lower())
    hits = [F.coalesce(F.contains(F.lower(c), wanted), F.lit(False)) for c in columns]
    return df.filter(reduce(operator.or_, hits))


def fulltext_phrases(df: DataFrame, columns: Sequence[str], phrases: DataFrame, key: str) -> DataFrame:
    """Pairs of a record and a phrase it holds in any of the columns, whatever the case, for tables of phrases of any size.

    ``phrases`` has ``phrase_id`` and ``phrase``; ``key`` names the records. A phrase is filed under its rarest q-gram and held against the records that
    have it. Blank phrases find nothing. The result has the columns of ``df``, ``phrase_id`` and ``phrase``.
    """
    needle = F.lower("phrase")
    wanted = phrases.filter(F.coalesce(needle, F.lit("")) != "").select("phrase_id", "phrase", F.lit(0).alias("part"), needle_tokens("", needle).alias("tokens"), (F.length(needle) < Q).alias("is_short"))
    text = F.concat_ws("\n", *[F.lower(c) for c in columns])

    def posts(short: Column) -> DataFrame:
        return text_posts(df, [key], "", text, short)

    pairs = candidates(posts, wanted, [], key, "phrase_id")
    # Phrases join the narrow side, and a text is folded once, however many phrases are held against it.
    asked = pairs.join(phrases.select("phrase_id", "phrase"), "phrase_id").withColumn("_needle", needle)
    folded = df.repartition(key).withColumns({f"_folded{i}": F.lower(c) for i, c in enumerate(columns)})
    hits = [F.coalesce(F.contains(F.col(f"_folded{i}"), F.col("_needle")), F.lit(False)) for i in range(len(columns))]
    return folded.join(asked, key).filter(reduce(operator.or_, hits)).select(*df.columns, "phrase_id", "phrase")


def time_range(
    df: DataFrame, ts: str, now: str, tmin: str | None = None, tmax: str | None = None
) -> DataFrame:
    """Records in ``[tmin, tmax)``; ``tmin`` is ``now`` when not given, dates are midnight UTC."""
    kept = F.col(ts) >= literal_instant(tmin or now)
    if tmax:
        kept = kept & (F.col(ts) < literal_instant(tmax))
    return df.filter(kept)


def filter_tasks(
    tasks: DataFrame,
    show_completed: bool = True,
    show_deleted: bool = False,
    show_hidden: bool = False,
    show_assigned: bool = False,
    completed_min: str | None = None,
    completed_max: str | None = None,
    due_min: str | None = None,
    due_max: str | None = None,
    updated_min: str | None = None,
) -> DataFrame:
    """Tasks by flags and bounds. ``due_max`` names a day that is still included."""
    kept = F.lit(True)
    shown = {
        "deleted": show_deleted,
        "hidden": show_hidden,
        "assigned": show_assigned,
    }
    if not show_completed:
        kept = kept & ~F.coalesce(F.col("status") == "completed", F.lit(False))
    for flag, show in shown.items():
        if not show:
            kept = kept & ~F.coalesce(F.col(flag), F.lit(False))
    if completed_min:
        kept = kept & (F.col("completed") >= literal_instant(completed_min))
    if completed_max:
        kept = kept & (F.col("completed") < literal_instant(completed_max))
    if due_min:
        kept = kept & (F.col("due") >= literal_instant(due_min))
    if due_max:
        kept = kept & (F.col("due") < literal_instant(due_max) + F.expr("INTERVAL 1 DAY"))
    if updated_min:
        kept = kept & (F.col("updated") >= literal_instant(updated_min))
    return tasks.filter(kept)


# The units of a relative date.
DATE_UNITS = {"d": "days", "w": "weeks", "m": "months", "y": "years"}


def relative_date(df: DataFrame, ts: str, spec: str, now: str) -> DataFrame:
    """Records of the past N days, weeks, months or years: ``d5``, ``w2``, ``m3``, ``y1``."""
    found = re.fullmatch(r"([dwmy])(\d+)", spec)
    if not found:
        raise ValueError(f"unknown relative date {spec!r}")
    span = F.make_interval(**{DATE_UNITS[found.group(1)]: F.lit(int(found.group(2)))})
    return df.filter(F.col(ts) >= literal_instant(now) - span)


def host_suffixes(name: Column) -> Column:
    """``a.b.org`` to ``[a.b.org, b.org, org]``: the site names a host belongs to."""
    labels = F.split(name, r"\.")
    return F.transform(
        labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels) - i), ".")
    )


def site_filter(df: DataFrame, url: str, sites: Sequence[str] | DataFrame, mode: str = "include") -> DataFrame:
    """Keep or drop records of some sites, their sub-domains included.

    ``sites`` is a list of names, or a table with a column ``site`` of any size.
    """
    if mode not in ("include", "exclude"):
        raise ValueError(f"unknown mode {mode!r}")
    if not isinstance(sites, DataFrame):
        wanted = F.array(*[F.lit(s.lower()) for s in sites]).cast("array<string>")
        hit = F.coalesce(F.arrays_overlap(host_suffixes(host(F.col(url))), wanted), F.lit(False))
        return df.filter(hit if mode == "include" else ~hit)
    keyed = df.withColumn("_host", host(F.col(url)))
    names = sites.select(F.lower("site").alias("_suffix")).distinct()
    hosts = (
        keyed.select("_host")
        .distinct()
        .withColumn("_suffix", F.explode(host_suffixes(F.col("_host"))))
        .join(names, "_suffix", "left_semi")
        .select("_host")
        .distinct()
    )
    return keyed.join(hosts, "_host", "left_semi" if mode == "include" else "left_anti").drop("_host")


def is_error_token(value: Column) -> Column:
    """``#REF!``, ``#NAME?``, ``#N/A`` and the like; a lone ``#`` is no error."""
    t = F.upper(stripped(value))
    marked = F.startswith(t, F.lit("#")) & (F.endswith(t, F.lit("!")) | F.endswith(t, F.lit("?")))
    return F.coalesce((t == "#N/A") | marked, F.lit(False))


def error_cells(cells: DataFrame) -> DataFrame:
    """The cells that show an error, with their label."""
    return cells.filter(is_error_token(F.col("value"))).withColumn(
        "cell", cell_label(F.col("row"), F.col("col"))
    )


def rows_with_error_tokens(cells: DataFrame, sheet: str = "sheet_id") -> DataFrame:
    """Per sheet: any error, how many, and the first one (by row, then column; a cell without a place is first and has no label)."""
    # A place as one number, which a hash table can hold where a text or a pair would be sorted for.
    width = F.lit(Decimal(1 << 63))
    number = [(F.coalesce(F.col(c).cast("decimal(38,0)"), F.lit(Decimal(-1))) + 1).cast("decimal(38,0)") for c in ("row", "col")]
    bad = is_error_token(F.col("value"))
    found = cells.groupBy(sheet).agg(
        F.bool_or(bad).alias("has_errors"),
        F.count_if(bad).alias("n_errors"),
        F.min(F.when(bad, (number[0] * width).cast("decimal(38,0)") + number[1])).alias("_place"),
    )
    row, col = F.expr(f"_place div {1 << 63}BD") - 1, (F.col("_place") % width).cast("decimal(38,0)").cast("bigint") - 1
    label = F.when((row >= 0) & (col >= 0), cell_label(row, col))
    return found.select(sheet, "has_errors", "n_errors", label.alias("first_error"))


def condition_holds(kind: Column, values: Column, value: Column) -> Column:
    """Whether a cell value meets a typed condition. A value of the wrong kind meets none."""
    first, second = F.try_element_at(values, F.lit(1)), F.try_element_at(values, F.lit(2))
    number, limit = value.try_cast("double"), first.try_cast("double")
    day, day1, day2 = value.try_cast("date"), first.try_cast("date"), second.try_cast("date")
    blank = F.coalesce(value, F.lit("")) == ""
    tests = {
        "NUMBER_GREATER": number > limit,
        "NUMBER_GREATER_THAN_EQ": number >= limit,
        "NUMBER_LESS": number < limit,
        "NUMBER_LESS_THAN_EQ": number <= limit,
        "NUMBER_EQ": number == limit,
        "NUMBER_NOT_EQ": number != limit,
        "TEXT_CONTAINS": F.contains(value, first),
        "TEXT_NOT_CONTAINS": ~F.contains(value, first),
        "TEXT_STARTS_WITH": F.startswith(value, first),
        "TEXT_ENDS_WITH": F.endswith(value, first),
        "TEXT_EQ": value == first,
        "DATE_BEFORE": day < day1,
        "DATE_ON_OR_BEFORE": day <= day1,
        "DATE_AFTER": day > day1,
        "DATE_ON_OR_AFTER": day >= day1,
        "DATE_EQ": day == day1,
        "DATE_NOT_EQ": day != day1,
        "DATE_BETWEEN": day.between(day1, day2),
        "DATE_NOT_BETWEEN": ~day.between(day1, day2),
        "NOT_BLANK": ~blank,
        "BLANK": blank,
    }
    chosen = F.lit(False)
    for name, test in tests.items():
        chosen = F.when(kind == name, test).otherwise(chosen)
    return F.coalesce(chosen, F.lit(False))


def cell_conditions(cells: DataFrame, rules: DataFrame, sheet: str = "sheet_id") -> DataFrame:
    """Cells that meet the condition of a rule whose range holds them, with ``rule_idx``.

    For ``ONE_OF_RANGE`` the rule has a second range, ``src_sheet`` with ``src_r0 … src_c1``, and
    the value must be one of the values there.
    """
    other = F.col("type") == "ONE_OF_RANGE"
    bounds = ("r0", "r1", "c0", "c1")
    carry = ("rule_idx", "type", "values", "is_source")
    targets = rules.select(sheet, *bounds, "rule_idx", "type", "values", F.lit(False).alias("is_source"))
    sources = rules.filter(other).select(F.col("src_sheet").alias(sheet), *[F.col(f"src_{c}").alias(c) for c in bounds], "rule_idx", "type", "values", F.lit(True).alias("is_source"))
    # The ranges that hold the allowed values are looked up together with those the rules apply to, and only cells that count are written.
    found = cells_in_ranges(cells, targets.unionByName(sources), sheet, carry)
    found = durable_cut(found.filter(other | condition_holds(F.col("type"), F.col("values"), F.col("value"))).drop("values"))
    direct = found.filter(~other).select(*cells.columns, "rule_idx")
    allowed = found.filter(other & F.col("is_source")).select("rule_idx", "value").distinct()
    listed = found.filter(other & ~F.col("is_source")).join(allowed, ["rule_idx", "value"], "left_semi")
    return direct.unionByName(listed.select(*direct.columns))


def publicly_shared(files: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per owner, kind ...: files, files open to anyone, and their share."""
    public = is_public(F.col("permissions"))
    return files.groupBy(*by).agg(
        F.count("*").alias("n_files"),
        F.count_if(public).alias("n_public"),
        F.round(F.count_if(public) / F.count("*"), 6).alias("public_share"),
    )


def validate_shares(requests: DataFrame) -> DataFrame:
    """Share requests with defaults filled in and ``reason``, the first check that fails or null."""
    filled = requests.withColumns(
        {
            "share_type": F.coalesce("share_type", F.lit("user")),
            "role": F.coalesce("role", F.lit("reader")),
        }
    )

    def missing(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit("")) == ""

    kind = F.col("share_type")
    reason = (
        F.when((kind == "domain") & missing("domain"), "missing domain")
        .when((kind != "domain") & missing("email"), "missing email")
        .when(~F.col("role").isin(*SHARE_ROLES), "invalid role")
        .when(~kind.isin(*SHARE_TYPES), "invalid share_type")
        .when(~missing("expiration_time") & ~is_rfc3339(F.col("expiration_time")), "invalid expiration_time")
    )
    return filled.withColumn("reason", reason)


def split_shares(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted requests, and rejected ones with their reason."""
    checked = validate_shares(requests)
    return checked.filter(F.col("reason").isNull()).drop("reason"), checked.filter(F.col("reason").isNotNull())
