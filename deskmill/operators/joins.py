"""Joins between workspace records. Sides are broadcast only where Spark measures them as small."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskmill.functions.scopes import HIERARCHY, expanded
from deskmill.functions.sharing import is_public
from deskmill.operators import grams as grams_
from deskmill.operators.intervals import LEVELS, TAIL, ancestor, cover, overlap_pairs
from deskmill.operators.nested import hit_details
from deskmill.operators.paging import top_per_group
from deskmill.operators.running import Running, by_position, running
from deskmill.session import durable_cut

# The kinds of a shortcut and of a folder, and the longest chain that is followed.
SHORTCUT_TYPE = "application/vnd.google-apps.shortcut"
FOLDER_TYPE = "application/vnd.google-apps.folder"
MAX_HOPS = 5


def _blank(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) == ""


def resolve_senders(messages: DataFrame, people: DataFrame) -> DataFrame:
    """Messages with ``sender``: own name, else directory name, else its email, else the id.

    ``messages`` has ``sender_id`` (``users/…``) and ``sender_name``; ``people`` has one row per
    ``resource_name`` (``people/…``) with ``display_name`` and ``email``.
    """
    key = F.regexp_replace("sender_id", "^users/", "people/")
    directory = people.select(
        F.col("resource_name").alias("_person"),
        F.coalesce(F.nullif("display_name", F.lit("")), F.nullif("email", F.lit(""))).alias("_found"),
    )
    joined = messages.withColumn("_person", key).join(directory, "_person", "left")
    sender = F.coalesce(
        F.nullif("sender_name", F.lit("")),
        F.when(~_blank("sender_id"), F.coalesce("_found", "sender_id")),
        F.lit("Unknown Sender"),
    )
    return joined.select(*messages.columns, sender.alias("sender"))


def search_hits(
    messages: DataFrame, spaces: DataFrame, people: DataFrame, phrase: str, groups: int = 10, k: int = 5
) -> DataFrame:
    """The hits of ``top_per_group`` with ``sender``, and the lists ``links`` and ``attachments`` of each message.

    Links are held against the whole text, before it is shortened; senders are looked up for the hits only.
    """
    return resolve_senders(top_per_group(hit_details(messages), spaces, phrase, groups, k), people)


def resolve_shortcuts(files: DataFrame, max_hops: int = MAX_HOPS, folders_only: bool = False) -> DataFrame:
    """``id, resolved_id, hops, error`` for every file, following ``target_id`` of shortcuts.

    Only shortcuts are joined, once per hop; rows that are settled look themselves up, so their
    keys stay spread. Chains longer than ``max_hops`` (loops too), shortcuts without a target and
    targets that do not exist end in an error.
    """
    kind = F.coalesce(F.col("mime_type") == SHORTCUT_TYPE, F.lit(False))
    text = files.schema["target_id"].dataType.simpleString() == "string"
    target = F.nullif("target_id", F.lit("")) if text else F.col("target_id")
    look = files.select(
        F.col("id").alias("_at"),
        kind.alias("_shortcut"),
        target.alias("_next"),
        F.col("mime_type").alias("_kind"),
    )
    no_target = F.lit("missing target")
    plain = look.filter(~F.col("_shortcut")).select(
        F.col("_at").alias("id"),
        F.col("_at").alias("resolved_id"),
        F.lit(0).alias("hops"),
        F.lit(None).cast("string").alias("error"),
        "_kind",
    )
    chain = look.filter("_shortcut").select(
        F.col("_at").alias("id"),
        F.coalesce("_next", "_at").alias("at"),
        F.when(F.col("_next").isNull(), 0).otherwise(1).alias("hops"),
        F.when(F.col("_next").isNull(), no_target).alias("error"),
        F.col("_next").isNull().alias("settled"),
        F.col("_kind").alias("kind"),
    )
    for hop in range(1, max_hops + 1):
        step = chain.join(look, chain["at"] == look["_at"], "left")
        open_ = ~F.col("settled")
        lost, real = F.col("_at").isNull(), ~F.col("_shortcut")
        dead_end = F.col("_next").isNull()
        stops = lost | real | dead_end | F.lit(hop == max_hops)
        chain = step.select(
            "id",
            F.when(open_ & ~stops, F.col("_next")).otherwise(F.col("at")).alias("at"),
            F.when(open_ & ~stops, F.col("hops") + 1).otherwise(F.col("hops")).alias("hops"),
            F.when(
                open_,
                F.when(lost, F.lit("not found"))
                .when(real, F.lit(None))
                .when(dead_end, no_target)
                .when(F.lit(hop == max_hops), F.lit("too many hops")),
            )
            .otherwise(F.col("error"))
            .alias("error"),
            F.when(open_, stops).otherwise(F.lit(True)).alias("settled"),
            F.when(open_, F.col("_kind")).otherwise(F.col("kind")).alias("kind"),
        )
    followed = chain.select(
        "id",
        F.when(F.col("error").isNull(), F.col("at")).alias("resolved_id"),
        "hops",
        "error",
        F.col("kind").alias("_kind"),
    )
    done = plain.unionByName(followed)
    if folders_only:
        wrong = F.col("error").isNull() & ~F.coalesce(F.col("_kind") == FOLDER_TYPE, F.lit(False))
        done = done.withColumn("error", F.when(wrong, F.lit("not a folder")).otherwise(F.col("error")))
    return done.drop("_kind")


def group_members(
    membership: DataFrame, people: DataFrame, max_members: int | None = None
) -> DataFrame:
    """Members of every group with what the directory knows; ``max_members`` lists the first ones.

    ``membership`` is one row per ``(group_id, member)``; a list column is exploded before.
    """
    listed = membership
    if max_members is not None:
        place = F.row_number().over(Window.partitionBy("group_id").orderBy("member"))
        listed = membership.withColumn("_place", place).filter(F.col("_place") <= max_members).drop("_place")
    known = people.select(F.col("resource_name").alias("member"), "display_name", F.lit(True).alias("_known"))
    return (
        listed.join(known, "member", "left")
        .withColumn("resolved", F.coalesce("_known", F.lit(False)))
        .drop("_known")
    )


def group_member_counts(groups: DataFrame, membership: DataFrame, people: DataFrame) -> DataFrame:
    """Per group: the declared member count, members listed, and members found in the directory."""
    members = group_members(membership, people)
    counts = members.groupBy("group_id").agg(
        F.count("*").alias("n_members"), F.count_if("resolved").alias("n_resolved")
    )
    zero = F.lit(0).cast("bigint")
    return groups.join(counts, "group_id", "left").withColumns(
        {
            "n_members": F.coalesce("n_members", zero),
            "n_resolved": F.coalesce("n_resolved", zero),
        }
    )


def unresolved_refs(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Keys of ``child`` that ``parent`` does not have, with the number of child rows.

    The child side is counted per key before it is joined.
    """
    known = parent.select(F.col(parent_key or key).alias(key))
    return child.groupBy(key).agg(F.count("*").alias("n_refs")).join(known, key, "left_anti")


def _one_per_key(rows: DataFrame, key: str, columns: Sequence[str], version: str | None) -> DataFrame:
    """One row per key: the latest given value of each column; without a ``version`` a repeated key is an error."""
    if version:
        picked = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(version))).alias(c) for c in columns]
    else:
        twice = F.raise_error(F.concat(F.lit(f"several updates of {key} "), F.col(key).cast("string")))
        picked = [F.when(F.count("*") > 1, twice).otherwise(F.first(c)).alias(c) for c in columns]
    return rows.groupBy(key).agg(*picked)


def patch_merge(base: DataFrame, patch: DataFrame, key: str, columns: Sequence[str], version: str | None = None) -> DataFrame:
    """Sparse update: a new value that is not null wins, else the old one is kept.

    Of several patches to a key the latest by ``version`` counts, column by column; without that column they are an error.
    """
    fresh = _one_per_key(patch, key, columns, version).select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    merged = base.join(fresh, key, "left")
    return merged.withColumns({c: F.coalesce(F.col(f"_new_{c}"), F.col(c)) for c in columns}).select(
        *base.columns
    )


def masked_batch_update(
    base: DataFrame, updates: DataFrame, key: str, version: str, columns: Sequence[str], latest: str | None = None
) -> DataFrame:
    """Batch update under one mask, the union of the fields of all usable updates.

    Updates for unknown keys, for records without a version, or without any field are skipped. A
    masked field an update does not give becomes null in its record. Of several updates to a key the latest by the column ``latest`` counts, field by
    field; without that column they are an error.
    """
    current = base.filter(F.col(version).isNotNull()).select(key)
    given = reduce(operator.or_, [F.col(c).isNotNull() for c in columns])
    usable = updates.filter(given).join(current, key, "left_semi")
    # One row, found while the update runs.
    mask = usable.agg(F.struct(*[F.coalesce(F.bool_or(F.col(c).isNotNull()), F.lit(False)).alias(c) for c in columns])).scalar()
    fresh = _one_per_key(usable, key, columns, latest)
    fresh = fresh.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("updated"), mask.alias("_mask"))
    merged = base.join(fresh, key, "left").withColumn("updated", F.coalesce("updated", F.lit(False)))
    return merged.withColumns(
        {c: F.when(F.col("updated") & F.col("_mask")[c], F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    ).select(*base.columns, "updated")


def apply_label_changes(items: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """Labels after ``(labels ∪ add) \\ remove`` for the items listed; removal wins.

    ``changes`` has lists ``add`` and ``remove``; those of several rows of one key are put together.
    """
    none = F.array().cast("array<string>")
    lists = [F.array_distinct(F.flatten(F.collect_set(c))).alias(c) for c in ("add", "remove")]
    joined = items.join(changes.groupBy(key).agg(*lists), key, "left")
    labels = F.array_except(
        F.array_union(F.coalesce("labels", none), F.coalesce("add", none)), F.coalesce("remove", none)
    )
    return joined.withColumn("labels", F.sort_array(labels)).select(*items.columns)


def element_at_index(
    elements: DataFrame, points: DataFrame, doc: str = "doc_id", cells: DataFrame | None = None
) -> DataFrame:
    """Points ``(doc, point_id, index)`` with the element that holds them: ``start <= index < end``.

    Elements of a document do not overlap, so the only candidate is the last one that starts at or
    before the point: one ordered pass instead of a comparison of pairs. With ``cells`` (``table_pos,
    row, col, start_index, end_index``) the table cell that holds the point is added.
    """
    found = _stab(elements.select(doc, "pos", "type", "start_index", "end_index"), points, doc, ["pos", "type"])
    if cells is None:
        return found
    inside = _stab(cells.select(doc, "row", "col", "start_index", "end_index"), points, doc, ["row", "col"])
    return found.join(inside.select(doc, "point_id", "row", "col"), [doc, "point_id"], "left")


def _stab(intervals: DataFrame, points: DataFrame, doc: str, carry: list[str]) -> DataFrame:
    box = F.struct("end_index", *carry)
    starts = intervals.select(doc, F.col("start_index").alias("index"), F.lit(0).alias("_is_point"), box.alias("_box"))
    asked = points.select(doc, "index").distinct().withColumn("_is_point", F.lit(1))
    both = starts.unionByName(asked, allowMissingColumns=True)
    swept = running(
        both,
        [doc],
        ["index", "_is_point"],
        by_position("index", 65536),
        {"_held": Running("last_before", F.col("_box"))},
    ).filter("_is_point = 1")
    inside = F.col("index") < F.col("_held.end_index")
    answers = swept.select(doc, "index", *[F.when(inside, F.col(f"_held.{c}")).alias(c) for c in carry])
    return points.join(answers, [doc, "index"], "left")


def next_paragraph(elements: DataFrame, points: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Points with ``next_index``: the first paragraph start after them, else the document's end.

    The end is ``total_length - 1``, or 1 for an empty document. A forward as-of join as one
    ordered pass over points and paragraph starts.
    """
    starts = elements.filter(F.col("type") == "paragraph").select(
        doc, F.col("start_index").alias("index"), F.lit(0).alias("_is_point")
    )
    asked = points.select(doc, "index").distinct().withColumn("_is_point", F.lit(1))
    swept = running(
        starts.unionByName(asked),
        [doc],
        ["index", "_is_point"],
        by_position("index", 65536),
        {"_next": Running("min_after", F.when(F.col("_is_point") == 0, F.col("index")))},
    ).filter("_is_point = 1")
    ends = elements.groupBy(doc).agg(F.max_by("end_index", "pos").alias("_length"))
    fallback = F.when(F.col("_length") > 0, F.col("_length") - 1).otherwise(F.lit(1))
    return (
        points.join(swept.select(doc, "index", "_next"), [doc, "index"], "left")
        .join(ends, doc, "left")
        .select(*points.columns, F.coalesce("_next", fallback).cast("bigint").alias("next_index"))
    )


def paragraphs_in_ranges(elements: DataFrame, ranges: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Starts of the paragraphs that overlap a range ``(doc, range_id, range_start, range_end)``.

    A range that meets no paragraph gives its own start.
    """
    paragraphs = elements.filter(F.col("type") == "paragraph").select(doc, "start_index", "end_index")
    asked = ranges.select(doc, "range_id", "range_start", "range_end")
    hits = overlap_pairs(
        asked, paragraphs, [doc], ("range_start", "range_end"), ("start_index", "end_index")
    ).select(doc, "range_id", "start_index")
    return asked.join(hits, [doc, "range_id"], "left").select(
        doc, "range_id", F.coalesce("start_index", "range_start").alias("paragraph_start")
    )


def anchor_comments(docs: DataFrame, comments: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Comments with the place of their anchor in the text: ``at`` (from 1), null for the appendix.

    ``comments`` has ``comment_no`` (from 1), ``anchor``, ``author``, ``content`` and ``resolved``. The
    text leaves the job right after the join; only positions are kept. Comments of an unknown document stay, without a place.
    """
    joined = comments.join(docs.select(doc, "text"), doc, "left")
    at = F.when(~_blank("anchor"), F.nullif(F.position(F.col("anchor"), F.col("text")), F.lit(0)))
    return joined.withColumn("at", at).select(*comments.columns, "at").withColumn(
        "ref", F.concat(F.lit("[^c"), F.col("comment_no").cast("string"), F.lit("]"))
    )


def annotate_documents(
    docs: DataFrame, comments: DataFrame, replies: DataFrame | None = None, doc: str = "doc_id"
) -> DataFrame:
    """Document text with comment marks at the anchors, footnotes, and an appendix of the rest.

    ``replies`` has ``doc, comment_no, reply_no, author, content``. One text per document is the
    result, so what is gathered per document is a part of that text.
    """
    placed = anchor_comments(docs, comments, doc)
    # Fixed value: the name of an author who is not given.
    said = F.concat(F.coalesce("author", F.lit("Unknown")), F.lit("**: "), F.coalesce("content", F.lit("")))
    foot_line = F.concat(F.col("ref"), F.lit(": **"), said)
    done_mark = F.when(F.col("resolved"), F.lit(" *(Resolved)*")).otherwise("")
    quote = F.when(_blank("anchor"), "").otherwise(F.concat(F.lit("> "), F.col("anchor"), F.lit("\n\n")))
    rest_line = F.concat(quote, F.lit("- **"), said, done_mark)
    if replies is None:
        talked = placed.withColumn("_said", F.lit(None).cast("array<struct<reply_no:bigint,line:string>>"))
    else:
        line = F.concat(F.lit("- **"), said)
        listed = replies.groupBy(doc, "comment_no").agg(
            F.sort_array(F.collect_list(F.struct("reply_no", line.alias("line")))).alias("_said")
        )
        talked = placed.join(listed, [doc, "comment_no"], "left")

    def with_replies(line: Column, indent: str) -> Column:
        more = F.transform("_said", lambda r: F.concat(F.lit("\n" + indent), r["line"]))
        return F.concat(line, F.coalesce(F.array_join(more, ""), F.lit("")))

    found = F.col("at").isNotNull()
    lined = talked.select(
        doc,
        "comment_no",
        F.when(found, F.struct((F.col("at") + F.length("anchor") - 1).alias("cut"), (-F.col("comment_no")).alias("no"), "ref")).alias("mark"),
        F.when(found, with_replies(foot_line, "    ")).alias("foot"),
        F.when(~found, F.concat(with_replies(rest_line, "  "), F.lit("\n"))).alias("rest"),
    )
    gathered = lined.groupBy(doc).agg(
        F.sort_array(F.collect_list("mark")).alias("marks"),
        F.expr("listagg(foot, '\\n') WITHIN GROUP (ORDER BY comment_no)").alias("feet"),
        F.expr("listagg(rest, '\\n') WITHIN GROUP (ORDER BY comment_no)").alias("rests"),
    )
    whole = docs.select(doc, "text").join(gathered, doc, "left")
    pieces = F.transform(
        F.col("marks"),
        lambda m, i: F.concat(
            F.substring(
                F.col("text"),
                F.when(i > 0, F.try_element_at(F.col("marks"), i)["cut"]).otherwise(0) + 1,
                m["cut"] - F.when(i > 0, F.try_element_at(F.col("marks"), i)["cut"]).otherwise(0),
            ),
            m["ref"],
        ),
    )
    marked = F.when(
        F.size("marks") > 0,
        F.concat(
            F.array_join(pieces, ""), F.substr("text", F.element_at("marks", -1)["cut"].cast("int") + 1)
        ),
    ).otherwise(F.col("text"))
    newline = F.lit("\n")
    footed = F.when(
        F.col("feet").isNotNull(),
        F.concat(F.rtrim(marked, newline), F.lit("\n\n"), F.col("feet"), newline),
    ).otherwise(marked)
    full = F.when(
        F.col("rests").isNotNull(),
        F.concat(F.rtrim(footed, newline), F.lit("\n\n## Comments\n\n"), F.col("rests")),
    ).otherwise(footed)
    return whole.select(doc, full.alias("annotated"))


# The criteria of a mail rule; an absent one restricts nothing.
RULE_COLUMNS = (
    "rule_id", "from", "to", "subject", "query", "negated_query", "has_attachment", "exclude_chats",
    "size", "size_comparison", "add_labels", "remove_labels", "forward",
)


def _with_folded_text(messages: DataFrame) -> DataFrame:
    """Lower-case copies of the text columns, made once for all rules."""
    return messages.withColumns({f"_{c}": F.lower(c) for c in ("sender", "recipients", "subject", "text")})


def _rule_holds(rule: dict[str, Column]) -> Column:
    """All criteria of a rule against the message columns ``sender, recipients, subject, text,
    has_attachment, is_chat, size``. Text criteria match whatever the case."""

    def mentions(column: str, wanted: Column) -> Column:
        return F.coalesce(F.contains(F.col(f"m._{column}"), F.lower(wanted)), F.lit(False))

    def asked(name: str) -> Column:
        return F.coalesce(rule[name].cast("string"), F.lit("")) != ""

    def anywhere(wanted: Column) -> Column:
        return mentions("subject", wanted) | mentions("text", wanted)

    size_ok = (
        F.when(F.lower(rule["size_comparison"]) == "smaller", F.col("m.size") < rule["size"])
        .otherwise(F.col("m.size") > rule["size"])
    )
    return (
        (~asked("from") | mentions("sender", rule["from"]))
        & (~asked("to") | mentions("recipients", rule["to"]))
        & (~asked("subject") | mentions("subject", rule["subject"]))
        & (~asked("query") | anywhere(rule["query"]))
        & (~asked("negated_query") | ~anywhere(rule["negated_query"]))
        & (~F.coalesce(rule["has_attachment"], F.lit(False)) | F.col("m.has_attachment"))
        & (~F.coalesce(rule["exclude_chats"], F.lit(False)) | ~F.col("m.is_chat"))
        & (rule["size"].isNull() | F.coalesce(size_ok, F.lit(False)))
    )


def apply_filter_rules(messages: DataFrame, rules: Sequence[dict[str, Any]]) -> DataFrame:
    """Messages with what a list of rules does to them, in one pass without a join.

    Adds ``rule_ids``, ``add_labels``, ``remove_labels`` and ``forwards`` (sorted lists).
    """
    types = {"has_attachment": "boolean", "exclude_chats": "boolean", "size": "bigint"}
    hits = []
    for rule in rules:
        literals = {
            c: F.lit(rule.get(c)).cast(types.get(c, "string")) for c in RULE_COLUMNS if not c.endswith("labels")
        }
        effect = F.struct(
            F.lit(rule["rule_id"]).alias("rule_id"),
            F.array(*[F.lit(x) for x in rule.get("add_labels", [])]).cast("array<string>").alias("add"),
            F.array(*[F.lit(x) for x in rule.get("remove_labels", [])]).cast("array<string>").alias("remove"),
            literals["forward"].alias("forward"),
        )
        hits.append(F.when(_rule_holds(literals), effect))
    found = _with_folded_text(messages).alias("m").select(
        *[F.col(f"m.{c}") for c in messages.columns], F.array_compact(F.array(*hits)).alias("_hits")
    )

    def union(field: str) -> Column:
        lists = F.transform(F.col("_hits"), lambda h: h[field])
        return F.sort_array(F.array_distinct(F.flatten(lists)))

    return found.withColumns(
        {
            "rule_ids": F.sort_array(F.transform("_hits", lambda h: h["rule_id"])),
            "add_labels": union("add"),
            "remove_labels": union("remove"),
            "forwards": F.sort_array(F.array_distinct(F.array_compact(F.transform("_hits", lambda h: h["forward"])))),
        }
    ).drop("_hits")


# Text criteria of a rule, and the text that must hold them; a query may stand in the subject or in the text.
_RULE_TEXTS = {"from": "sender", "to": "recipients", "subject": "subject", "query": "any"}


def _told(criterion: str) -> Column:
    return F.coalesce(F.col(f"rule.{criterion}"), F.lit("")) != ""


def _by_query() -> Column:
    """Whether a rule is filed by its query: whole texts are looked through only where no address or subject is asked for."""
    return _told("query") & ~(_told("from") | _told("to") | _told("subject"))


def _rule_tokens(own: DataFrame) -> DataFrame:
    """``tokens`` of each rule: q-grams of its texts, else the nodes of its sizes, else what is marked or all."""
    size, larger = F.col("rule.size"), F.coalesce(F.lower("rule.size_comparison") != "smaller", F.lit(True))
    low, high = F.when(larger, size + 1), F.when(~larger, F.greatest(size, F.lit(0)))
    sizes = F.transform(cover(low, high, 1), _size_token)
    needles = {c: F.lower(F.col(f"rule.{c}")) for c in _RULE_TEXTS}
    told = {c: _by_query() if c == "query" else _told(c) for c in needles}
    none = F.array().cast("array<string>")
    grams = F.concat(*[F.when(told[c], grams_.needle_tokens(_RULE_TEXTS[c], needles[c])).otherwise(none) for c in _RULE_TEXTS])
    plain = F.when(F.coalesce(F.col("rule.has_attachment"), F.lit(False)), F.lit("attachment")).otherwise(F.lit("all"))
    # A rule with sizes only must meet each of their nodes, so it is looked for in several parts.
    some_text = reduce(operator.or_, told.values())
    is_short = reduce(operator.or_, [told[c] & (F.length(needles[c]) < grams_.Q) for c in needles])
    texts = own.filter(some_text).select("*", F.lit(0).alias("part"), grams.alias("tokens"), is_short.alias("is_short"))
    others = own.filter(~some_text).select("*", F.posexplode(F.when(size.isNotNull(), sizes).otherwise(F.array(plain))).alias("part", "token"))
    return texts.unionByName(others.select(*own.columns, "part", F.array("token").alias("tokens"), F.lit(False).alias("is_short")))


def _size_token(node: Column) -> Column:
    return F.concat(F.lit("size|"), node["level"].cast("string"), F.lit("|"), node["node"].cast("string"))


def _mail_posts(messages: DataFrame, mailbox: str, key: str, short: Column, queried: Column) -> DataFrame:
    """The tokens of each message: q-grams of its texts, nodes of its size, and marks."""
    whole = F.when(queried, F.concat_ws("\n", "_subject", "_text"))
    fields = {"sender": F.col("_sender"), "recipients": F.col("_recipients"), "subject": F.col("_subject"), "any": whole}
    texts = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(t, F.lit("")).alias("text")) for f, t in fields.items()]))
    told = messages.select(mailbox, key, texts.alias("t"))
    grams = grams_.text_posts(told, [mailbox, key], F.col("t.field"), F.col("t.text"), short)
    levels = [*range(LEVELS), *range(TAIL - 1, TAIL + LEVELS + 1)]
    nodes = F.transform(F.array(*[F.lit(x) for x in levels]), lambda level: F.struct(level.alias("level"), ancestor(F.col("size"), 1, level).alias("node")))
    marks = F.array(F.lit("all"), F.when(F.col("has_attachment"), F.lit("attachment")))
    plain = F.array_compact(F.concat(marks, F.transform(nodes, _size_token)))
    return grams.unionAll(messages.select(mailbox, key, F.explode(plain).alias("token")))


def apply_rule_table(messages: DataFrame, rules: DataFrame, mailbox: str = "mailbox", key: str = "message_id") -> DataFrame:
    """Pairs of message and rule of the same mailbox where the rule holds, for rule tables of any size.

    ``key`` names the messages. A rule is filed under the rarest q-gram of its texts in the mailbox, one without texts under the nodes of its sizes
    or a mark; only the messages with that token are held against it.
    """
    folded = _with_folded_text(messages)
    number = durable_cut(rules.select(mailbox, F.struct(*RULE_COLUMNS).alias("rule")).withColumn("rule_no", F.monotonically_increasing_id()))
    queried = number.agg(F.coalesce(F.bool_or(_by_query()), F.lit(False))).scalar()
    pairs = grams_.candidates(lambda short: _mail_posts(folded, mailbox, key, short, queried), _rule_tokens(number), [mailbox], key, "rule_no")
    met = pairs.join(number, [mailbox, "rule_no"])
    joined = folded.join(met, [mailbox, key]).alias("m")
    criteria = {c: F.col(f"rule.{c}") for c in RULE_COLUMNS}
    return joined.filter(_rule_holds(criteria)).select(
        *[F.col(f"m.{c}") for c in messages.columns], "rule.rule_id", "rule.add_labels", "rule.remove_labels", "rule.forward"
    )


def rule_hits(messages: DataFrame, rules: Sequence[dict[str, Any]]) -> DataFrame:
    """Messages hit per rule."""
    return (
        apply_filter_rules(messages, rules)
        .select(F.explode("rule_ids").alias("rule_id"))
        .groupBy("rule_id")
        .agg(F.count("*").alias("n_hits"))
    )


def missing_scopes(
    grants: DataFrame, required: DataFrame, hierarchy: dict[str, list[str]] | None = None
) -> DataFrame:
    """Rows of ``required (user, scope)`` that no grant of the user covers, broad grants included.

    A user's grants and needs are bits of a few words, and what is lacking is one minus the other. A null scope is never covered.
    """
    covers = HIERARCHY if hierarchy is None else hierarchy
    # Each scope that is asked for is a bit of a word of 64; there are few scopes, however many users.
    asked = required.select("scope").distinct()
    place = F.row_number().over(Window.orderBy("scope")) - 1
    numbers = asked.select("scope", F.floor(place / 64).cast("int").alias("word"), (place % 64).alias("bit"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))
    broad = grants.select("scope").distinct()
    covered = broad.select(F.col("scope").alias("grant"), F.explode(expanded(F.col("scope"), covers)).alias("scope")).join(numbers, "scope")
    words = covered.groupBy("grant", "word").agg(F.bit_or(one).alias("bits"))
    held = grants.join(words, F.col("scope") == F.col("grant")).groupBy(F.col("user").alias("_user"), F.col("word").alias("_word")).agg(F.bit_or("bits").alias("_held"))
    named = numbers.withColumnRenamed("scope", "_scope")
    needed = required.join(named, F.col("scope").eqNullSafe(F.col("_scope"))).groupBy("user", "word").agg(F.bit_or(one).alias("needed"))
    # What is needed and not held; only that becomes rows again.
    lacking = needed.join(held, (F.col("user") == F.col("_user")) & (F.col("word") == F.col("_word")), "left")
    lacking = lacking.withColumn("lacking", F.col("needed").bitwiseAND(F.bitwise_not(F.coalesce("_held", F.lit(0).cast("bigint")))))
    bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftright", F.col("lacking"), i).bitwiseAND(1) == 1)
    return lacking.filter("lacking <> 0").select("user", "word", F.explode(bits).alias("bit")).join(numbers, ["word", "bit"]).select("user", "scope")


def scope_check(
    users: DataFrame, grants: DataFrame, required: DataFrame, hierarchy: dict[str, list[str]] | None = None
) -> DataFrame:
    """Per user whether every required grant is covered, and how many are not."""
    lacking = missing_scopes(grants, required, hierarchy).groupBy("user").agg(
        F.count("*").alias("n_missing"), F.min("scope").alias("first_missing")
    )
    return (
        users.select("user")
        .join(lacking, "user", "left")
        .withColumn("n_missing", F.coalesce("n_missing", F.lit(0).cast("bigint")))
        .withColumn("passes", F.col("n_missing") == 0)
    )


def files_by_name(files: DataFrame, names: DataFrame) -> DataFrame:
    """Per wanted name: namesakes, the first file by id, and whether that one is open to anyone.

    Only the two smallest facts per name are aggregated, so a name with very many files is no
    burden. Names without a file have ``n_files`` 0.
    """
    wanted = names.select("name").distinct()
    first = F.struct("id", is_public(F.col("permissions")).alias("public"))
    counts = (
        files.join(wanted, "name", "left_semi")
        .groupBy("name")
        .agg(F.count("*").alias("n_files"), F.min_by(first, "id").alias("_first"))
    )
    return wanted.join(counts, "name", "left").select(
        "name",
        F.coalesce("n_files", F.lit(0).cast("bigint")).alias("n_files"),
        F.col("_first.id").alias("id"),
        F.col("_first.public").alias("public"),
    )


def change_report(
    current: DataFrame, requested: DataFrame, key: str, columns: Sequence[str], blank_is_null: Sequence[str] = (), latest: str | None = None
) -> DataFrame:
    """One row per field that really changes: ``key, field, old, new`` (as text).

    A field that is not requested (null) is no change; for ``blank_is_null`` columns empty text and
    null are the same. Of several requests for a key the latest by the column ``latest`` counts, field by field; without that column they are an error.
    """

    def entry(c: str) -> Column:
        old, new = F.col(f"_old_{c}").cast("string"), F.col(f"_new_{c}").cast("string")
        if c in blank_is_null:
            same = F.coalesce(old, F.lit("")) == F.coalesce(new, F.lit(""))
        else:
            same = old.eqNullSafe(new)
        return F.when(new.isNotNull() & ~same, F.struct(F.lit(c).alias("field"), old.alias("old"), new.alias("new")))

    before = current.select(key, *[F.col(c).alias(f"_old_{c}") for c in columns])
    after = _one_per_key(requested, key, columns, latest).select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    changes = F.array_compact(F.array(*[entry(c) for c in columns]))
    return (
        before.join(after, key)
        .select(key, F.explode(changes).alias("change"))
        .select(key, "change.field", "change.old", "change.new")
    )


def change_counts(changes: DataFrame, requested: DataFrame, key: str, current: DataFrame | None = None) -> DataFrame:
    """Changes per field; the field ``(none)`` counts the requested keys that change nothing, of those in ``current`` if it is given."""
    per_field = changes.groupBy("field").agg(F.count("*").alias("n_changes"))
    asked = requested.select(key).distinct()
    if current is not None:
        asked = asked.join(current.select(key), key, "left_semi")
    still = asked.join(changes.select(key).distinct(), key, "left_anti")
    return per_field.unionByName(
        still.agg(F.count("*").alias("n_changes")).select(F.lit("(none)").alias("field"), "n_changes")
    )
