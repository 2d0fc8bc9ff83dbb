"""Projections of nested records: mail, events, contacts, chat, sheets, documents, slides, forms."""

from __future__ import annotations

from collections.abc import Sequence

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmill.functions.addresses import cell_address
from deskmill.functions.text import (
    decode_base64url,
    host,
    shortened,
    stripped,
    visible_text,
    without_prefix,
)


def _given(column: Column) -> Column:
    return F.coalesce(column, F.lit("")) != ""


# ---- mail -------------------------------------------------------------------------------------


def pivot_headers(headers: DataFrame, names: Sequence[str], exact_case: bool = False) -> DataFrame:
    """One row per message with a column per wanted header; the last of several wins.

    ``headers`` has ``msg_id, pos, name, value``. Names match whatever the case unless ``exact_case``.
    """

    def matches(name: str) -> Column:
        return F.col("name") == name if exact_case else F.lower("name") == name.lower()

    picked = [F.max_by("value", F.when(matches(n), F.col("pos"))).alias(n) for n in names]
    return headers.groupBy("msg_id").agg(*picked)


def select_bodies(parts: DataFrame) -> DataFrame:
    """Per message the first non-empty plain text and the first non-empty HTML, breadth first.

    ``parts`` has ``msg_id, depth, pos, mime, data`` (base64url) for the parts a reader reaches. The
    outermost part (depth 0) of a message with several parts comes last.
    """
    text = F.when(F.col("mime").isin("text/plain", "text/html"), decode_base64url(F.col("data")))
    place = F.struct(F.col("depth") == 0, F.col("depth"), F.col("pos"))
    # A message without a readable part keeps its row, with two empty texts.
    read = parts.withColumn("_text", text)

    def first(mime: str) -> Column:
        ranked = F.when((F.col("mime") == mime) & _given(F.col("_text")), place)
        return F.coalesce(F.min_by("_text", ranked), F.lit(""))

    return read.groupBy("msg_id").agg(first("text/plain").alias("text"), first("text/html").alias("html"))


# Where a long page is cut, what is put there, and what an empty message says.
BODY_LIMIT = 20000
CUT_MARK = "\n\n[Content truncated...]"
NOTHING_READABLE = "[No readable content found]"


def choose_body(bodies: DataFrame) -> DataFrame:
    """``choice`` and ``content`` of a message from its ``text`` and ``html``.

    HTML is used when the plain text is blank, holds an HTML comment, or is more than 50 times
    shorter.
    """
    text, html = F.col("_t"), F.col("_h")
    use_html = (html != "") & (
        (text == "") | F.contains(text, F.lit("<!--")) | (F.length(html) > F.length(text) * 50)
    )
    choice = F.when(use_html, "html").when(text != "", "text").otherwise("none")
    shown = F.col("_shown")
    cut = F.when(
        F.length(shown) > BODY_LIMIT, F.concat(F.substring(shown, 1, BODY_LIMIT), F.lit(CUT_MARK))
    ).otherwise(shown)
    return (
        bodies.withColumns({f"_{c[0]}": stripped(F.coalesce(c, F.lit(""))) for c in ("text", "html")})
        .withColumn("choice", choice)
        .withColumn("_shown", F.when(F.col("choice") == "html", visible_text(html)))
        .withColumn(
            "content",
            F.when(F.col("choice") == "html", cut)
            .when(F.col("choice") == "text", F.col("text"))
            .otherwise(NOTHING_READABLE),
        )
        .drop("_t", "_h", "_shown")
    )


def body_choices(bodies: DataFrame) -> DataFrame:
    """Messages and characters per choice."""
    return choose_body(bodies).groupBy("choice").agg(
        F.count("*").alias("n_messages"), F.sum(F.length("content")).alias("n_chars")
    )


def page_text(pages: DataFrame) -> DataFrame:
    """Visible text and host of every page."""
    return pages.select("page_id", host(F.col("url")).alias("host"), visible_text(F.col("html")).alias("text"))


def page_text_corpus(pages: DataFrame) -> DataFrame:
    """Per host: pages and length of their visible text."""
    return page_text(pages).groupBy("host").agg(
        F.count("*").alias("n_pages"), F.sum(F.length("text")).alias("n_chars")
    )


def attachments_inventory(parts: DataFrame) -> DataFrame:
    """Parts that are attachments (file name and attachment id), with defaults filled in."""
    return parts.filter(_given(F.col("filename")) & _given(F.col("attachment_id"))).select(
        "msg_id",
        "filename",
        F.coalesce("mime", F.lit("application/octet-stream")).alias("mime"),
        F.coalesce("size", F.lit(0)).cast("bigint").alias("size"),
        "attachment_id",
    )


def attachment_totals(parts: DataFrame) -> DataFrame:
    """Attachments and bytes per kind."""
    return attachments_inventory(parts).groupBy("mime").agg(
        F.count("*").alias("n_attachments"), F.sum("size").alias("n_bytes")
    )


# ---- calendar and contacts --------------------------------------------------------------------


def attendee_rows(events: DataFrame) -> DataFrame:
    """One row per attendee with an e-mail address, with defaults.

    ``attendees`` is a list of ``email, responseStatus, optional, organizer``; ``guests``, if there is
    such a column, a list of bare addresses.
    """
    return _attendees(events).filter(F.col("email").isNotNull())


def _attendees(events: DataFrame) -> DataFrame:
    """All attendees; an event without any keeps one row of nulls."""
    people = F.coalesce("attendees", F.expr("array()").cast(events.schema["attendees"].dataType))
    if "guests" in events.columns:
        bare = F.transform(
            F.coalesce("guests", F.array().cast("array<string>")),
            lambda g: F.struct(
                g.alias("email"),
                F.lit(None).cast("string").alias("responseStatus"),
                F.lit(None).cast("boolean").alias("optional"),
                F.lit(None).cast("boolean").alias("organizer"),
            ),
        )
        people = F.concat(people, bare)
    known = F.col("a.email").isNotNull()
    return events.select("event_id", F.explode_outer(people).alias("a")).select(
        "event_id",
        "a.email",
        F.when(known, F.coalesce("a.responseStatus", F.lit("unknown"))).alias("response"),
        F.when(known, F.coalesce("a.optional", F.lit(False))).alias("optional"),
        F.when(known, F.coalesce("a.organizer", F.lit(False))).alias("organizer"),
    )


# The answers an attendee can give.
RESPONSES = ("accepted", "declined", "tentative", "needsAction", "unknown")


def attendee_responses(events: DataFrame) -> DataFrame:
    """Per event, also one without attendees, their number by answer, of optional ones and of organizers."""
    by_answer = [F.count_if(F.col("response") == r).alias(f"n_{r}") for r in RESPONSES]
    return _attendees(events).groupBy("event_id").agg(
        F.count("email").alias("n_attendees"),
        *by_answer,
        F.count_if("optional").alias("n_optional"),
        F.count_if("organizer").alias("n_organizers"),
    )


def flatten_contacts(people: DataFrame) -> DataFrame:
    """One flat row per contact: first name, organization and address; joined e-mails, phones, links, sources."""

    def first(column: str, field: str) -> Column:
        return F.nullif(F.try_element_at(F.col(column), F.lit(1))[field], F.lit(""))

    def joined(column: str) -> Column:
        values = F.filter(F.transform(column, lambda x: x["value"]), lambda v: _given(v))
        return F.nullif(F.array_join(values, ", "), F.lit(""))

    title, company = first("organizations", "title"), first("organizations", "name")
    organization = F.nullif(F.concat_ws(" ", title, F.concat(F.lit("at "), company)), F.lit(""))
    born = F.try_element_at(F.col("birthdays"), F.lit(1))["date"]
    unknown = F.lit("?")
    day = F.concat(
        F.coalesce(born["month"].cast("string"), unknown), F.lit("/"), F.coalesce(born["day"].cast("string"), unknown)
    )
    birthday = F.when(
        born.isNotNull(), F.concat_ws("/", F.when(born["year"] > 0, born["year"].cast("string")), day)
    )
    kinds = F.transform("metadata.sources", lambda s: F.coalesce(s["type"], F.lit("")))
    sources = F.nullif(F.array_join(kinds, ", "), F.lit("")) if "metadata" in people.columns else F.lit(None).cast("string")
    return people.select(
        F.coalesce(without_prefix(F.col("resourceName"), "people/"), F.lit("Unknown")).alias("contact_id"),
        first("names", "displayName").alias("name"),
        joined("emailAddresses").alias("email"),
        joined("phoneNumbers").alias("phone"),
        organization.alias("organization"),
        first("addresses", "formattedValue").alias("address"),
        birthday.alias("birthday"),
        joined("urls").alias("urls"),
        shortened(first("biographies", "value"), 200).alias("notes"),
        sources.alias("sources"),
    )


def contact_profile(people: DataFrame) -> DataFrame:
    """Per field the share of contacts that have it."""
    flat = flatten_contacts(people)
    fields = [c for c in flat.columns if c != "contact_id"]
    counted = flat.agg(F.count("*").alias("_all"), *[F.count(c).alias(c) for c in fields])
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("n_filled")) for c in fields])
    return counted.select(F.explode(pairs).alias("f"), "_all").select(
        "f.field", "f.n_filled", F.round(F.col("f.n_filled") / F.col("_all"), 6).alias("filled_rate")
    )


# ---- chat -------------------------------------------------------------------------------------


def rich_links(messages: DataFrame) -> DataFrame:
    """Links of RICH_LINK annotations that the text does not show: ``space, name, uri``."""
    uri = F.col("a.richLinkMetadata.uri")
    return (
        messages.select("space", "name", "text", F.explode("annotations").alias("a"))
        .filter((F.col("a.type") == "RICH_LINK") & _given(uri))
        .filter(~F.contains(F.coalesce("text", F.lit("")), uri))
        .select("space", "name", uri.alias("uri"))
    )


def hit_details(messages: DataFrame) -> DataFrame:
    """``messages`` with the lists ``links`` (those the text does not show) and ``attachments`` (their names)."""
    uris = F.transform(F.filter("annotations", lambda a: a["type"] == "RICH_LINK"), lambda a: a["richLinkMetadata"]["uri"])
    hidden = F.filter(uris, lambda u: _given(u) & ~F.contains(F.coalesce("text", F.lit("")), u))
    # Fixed value: the name of an attachment that has none.
    names = F.transform("attachment", lambda a: F.coalesce(a["contentName"], F.lit("unnamed")))
    none = F.array().cast("array<string>")
    return messages.withColumns({"links": F.coalesce(hidden, none), "attachments": F.coalesce(names, none)})


def rich_link_counts(messages: DataFrame) -> DataFrame:
    """Hidden links per space."""
    return rich_links(messages).groupBy("space").agg(F.count("*").alias("n_links"))


def message_attachments(messages: DataFrame) -> DataFrame:
    """Attachments of chat messages with their index, name and type."""
    # The name and the type of an attachment that has none.
    return messages.select("name", F.posexplode("attachment").alias("index", "a")).select(
        "name",
        "index",
        F.coalesce("a.contentName", F.lit("unnamed")).alias("content_name"),
        F.coalesce("a.contentType", F.lit("unknown type")).alias("content_type"),
    )


def reaction_totals(messages: DataFrame) -> DataFrame:
    """Per message and symbol the number of reactions; custom emoji show as ``:uid:``."""
    emoji = F.col("r.emoji")
    custom = F.concat(F.lit(":"), F.coalesce(emoji["customEmoji"]["uid"], F.lit("?")), F.lit(":"))
    symbol = F.coalesce(F.nullif(emoji["unicode"], F.lit("")), custom)
    return (
        messages.select("name", F.explode("emojiReactionSummaries").alias("r"))
        .select("name", symbol.alias("symbol"), F.coalesce("r.reactionCount", F.lit(0)).alias("n"))
        .groupBy("name", "symbol")
        .agg(F.sum("n").cast("bigint").alias("n_reactions"))
    )


# ---- sheets -----------------------------------------------------------------------------------


def cell_hyperlinks(cells: DataFrame) -> DataFrame:
    """Distinct links per cell, the cell's own first, then those of its text runs, order kept.

    ``cells`` has ``title, row, col, link`` and the list ``run_links``.
    """
    none = F.array().cast("array<string>")
    links = F.concat(F.array("link"), F.coalesce("run_links", none))
    distinct = F.array_distinct(F.filter(links, lambda u: _given(u)))
    return cells.select("title", "row", "col", F.posexplode(distinct).alias("place", "url")).select(
        cell_address(F.col("title"), F.col("row"), F.col("col")).alias("cell"), "place", "url"
    )


def rectangularise(rows: DataFrame, table: str = "table_id") -> DataFrame:
    """Rows padded with empty text to the width of the first row; longer rows stay as they are."""
    width = rows.groupBy(table).agg(F.min_by(F.size("cells"), "row_idx").alias("_width"))
    pad = F.array_repeat(F.lit(""), F.greatest(F.lit(0), F.col("_width") - F.size("cells")))
    return rows.join(width, table).withColumn("cells", F.concat("cells", pad)).drop("_width")


# ---- documents and slides ---------------------------------------------------------------------


def paragraph_text(paragraph: Column) -> Column:
    """The text runs of a paragraph joined."""
    return F.array_join(F.transform(paragraph["elements"], lambda e: e["textRun"]["content"]), "")


def flatten_document(docs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Elements of nested documents in order: kind, positions, text, table size; others are dropped.

    ``content`` is the list of body elements. No shuffle: each document is read where it lies.
    """
    e = F.col("e")
    kind = (
        F.when(e["paragraph"].isNotNull(), "paragraph")
        .when(e["table"].isNotNull(), "table")
        .when(e["sectionBreak"].isNotNull(), "section_break")
        .when(e["tableOfContents"].isNotNull(), "table_of_contents")
    )
    table_rows = e["table"]["tableRows"]
    first_row = F.try_element_at(table_rows, F.lit(1))
    is_table = e["table"].isNotNull()
    return (
        docs.select(doc, F.posexplode("content").alias("pos", "e"))
        .select(
            doc,
            F.col("pos").cast("bigint").alias("pos"),
            kind.alias("type"),
            F.coalesce(e["startIndex"], F.lit(0)).cast("bigint").alias("start_index"),
            F.coalesce(e["endIndex"], F.lit(0)).cast("bigint").alias("end_index"),
            F.when(e["paragraph"].isNotNull(), paragraph_text(e["paragraph"])).alias("text"),
            e["paragraph"]["paragraphStyle"]["namedStyleType"].alias("style"),
            e["paragraph"]["bullet"]["listId"].alias("list_id"),
            e["paragraph"]["bullet"]["nestingLevel"].alias("nesting"),
            F.when(is_table, F.coalesce(F.size(table_rows), F.lit(0))).alias("n_rows"),
            F.when(is_table, F.coalesce(F.size(first_row["tableCells"]), F.lit(0))).alias("n_cols"),
        )
        .filter(F.col("type").isNotNull())
    )


def _plain_runs(paragraph: Column) -> Column:
    """Text runs with the marks Markdown knows, one flat record each."""

    def plain(e: Column) -> Column:
        style = e["textRun"]["textStyle"]
        return F.struct(
            e["textRun"]["content"].alias("content"),
            style["bold"].alias("bold"),
            style["italic"].alias("italic"),
            style["strikethrough"].alias("strikethrough"),
            style["weightedFontFamily"]["fontFamily"].alias("font"),
            style["link"]["url"].alias("url"),
        )

    return F.transform(F.filter(paragraph["elements"], lambda e: e["textRun"].isNotNull()), plain)


def markdown_elements(docs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Nested documents as the elements ``render_markdown`` takes. No shuffle.

    A list item is ordered when its list gives its nesting level a glyph type.
    """
    e = F.col("e")
    bullet = e["paragraph"]["bullet"]
    nesting = F.coalesce(bullet["nestingLevel"], F.lit(0))
    levels = F.try_element_at("lists", bullet["listId"])["listProperties"]["nestingLevels"]
    glyph = F.coalesce(F.try_element_at(levels, nesting + 1)["glyphType"], F.lit(""))
    cells = F.transform(
        e["table"]["tableRows"],
        lambda row: F.transform(
            row["tableCells"],
            lambda cell: F.transform(
                F.filter(cell["content"], lambda c: c["paragraph"].isNotNull()), lambda c: _plain_runs(c["paragraph"])
            ),
        ),
    )
    return docs.select(doc, "lists", F.posexplode("content").alias("pos", "e")).select(
        doc,
        F.col("pos").cast("bigint").alias("pos"),
        F.when(e["paragraph"].isNotNull(), "paragraph").when(e["table"].isNotNull(), "table").alias("type"),
        e["paragraph"]["paragraphStyle"]["namedStyleType"].alias("style"),
        bullet["listId"].alias("list_id"),
        nesting.alias("nesting"),
        (~glyph.isin("", "GLYPH_TYPE_UNSPECIFIED")).alias("ordered"),
        _plain_runs(e["paragraph"]).alias("runs"),
        cells.alias("table_rows"),
    )


def document_segments(docs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``doc, kind`` for every header and footer of nested documents."""

    def of(kind: str) -> DataFrame:
        return docs.select(doc, F.explode(F.map_keys(f"{kind}s"))).select(doc, F.lit(kind).alias("kind"))

    return of("header").unionByName(of("footer"))


def document_cells(docs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``doc, table_idx, row, col, text, start_index, end_index`` of all table cells."""
    tables = F.filter("content", lambda e: e["table"].isNotNull())
    text = F.array_join(
        F.transform(F.col("cell")["content"], lambda c: F.coalesce(paragraph_text(c["paragraph"]), F.lit(""))), ""
    )
    return (
        docs.select(doc, F.posexplode(tables).alias("table_idx", "t"))
        .select(doc, "table_idx", F.posexplode("t.table.tableRows").alias("row", "r"))
        .select(doc, "table_idx", "row", F.posexplode("r.tableCells").alias("col", "cell"))
        .select(
            doc,
            "table_idx",
            "row",
            "col",
            stripped(text).alias("text"),
            F.coalesce(F.col("cell")["startIndex"], F.lit(0)).cast("bigint").alias("start_index"),
            F.coalesce(F.col("cell")["endIndex"], F.lit(0)).cast("bigint").alias("end_index"),
        )
    )


def table_inventory(docs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``doc, table_idx, start_index, end_index, n_rows, n_cols`` of all tables; columns are those of the first row."""
    tables = F.filter("content", lambda e: e["table"].isNotNull())
    rows = F.col("t")["table"]["tableRows"]
    return docs.select(doc, F.posexplode(tables).alias("table_idx", "t")).select(
        doc,
        "table_idx",
        F.coalesce(F.col("t")["startIndex"], F.lit(0)).cast("bigint").alias("start_index"),
        F.coalesce(F.col("t")["endIndex"], F.lit(0)).cast("bigint").alias("end_index"),
        F.coalesce(F.size(rows), F.lit(0)).alias("n_rows"),
        F.coalesce(F.size(F.try_element_at(rows, F.lit(1))["tableCells"]), F.lit(0)).alias("n_cols"),
    )


def slide_text(slides: DataFrame) -> DataFrame:
    """Per slide its text: runs of a shape by start index, shapes by line, blank lines dropped."""

    def shape_text(element: Column) -> Column:
        runs = F.filter(
            element["shape"]["text"]["textElements"], lambda t: _given(t["textRun"]["content"])
        )
        keyed = F.transform(
            runs,
            lambda t, i: F.struct(
                F.coalesce(t["startIndex"], F.lit(0)).alias("at"), i.alias("i"), t["textRun"]["content"].alias("text")
            ),
        )
        return F.array_join(F.transform(F.sort_array(keyed), lambda t: t["text"]), "")

    texts = F.filter(F.transform("pageElements", shape_text), lambda t: _given(t))
    lines = F.filter(F.split(F.array_join(texts, "\n"), "\n"), lambda line: stripped(line) != "")
    return slides.select("objectId", F.array_join(lines, "\n").alias("text"))


def slide_elements(slides: DataFrame) -> DataFrame:
    """Elements per kind over all slides."""
    e = F.col("e")
    kind = (
        F.when(e["shape"].isNotNull(), "shape")
        .when(e["table"].isNotNull(), "table")
        .when(e["line"].isNotNull(), "line")
        .otherwise("unknown")
    )
    return (
        slides.select(F.explode("pageElements").alias("e"))
        .groupBy(kind.alias("kind"))
        .agg(F.count("*").alias("n_elements"))
    )


# ---- forms, search hits, files ----------------------------------------------------------------

# Fixed value: the text of a question that was not answered.
NO_ANSWER = "No answer provided"


def _answer_text(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.array_join(values, ", ", "")).otherwise(NO_ANSWER)


def form_answers_long(responses: DataFrame) -> DataFrame:
    """One row per answer: ``form_id, response_id, question_id, answer``."""
    return responses.select(
        "form_id", "response_id", F.explode("answers").alias("question_id", "given")
    ).select("form_id", "response_id", "question_id", _answer_text(F.col("given")).alias("answer"))


def form_answers_wide(responses: DataFrame, questions: Sequence[str]) -> DataFrame:
    """One column per question, null where the response does not have it. No shuffle."""

    def answer(question: str) -> Column:
        given = F.try_element_at(F.col("answers"), F.lit(question))
        return F.when(F.map_contains_key("answers", question), _answer_text(given)).alias(question)

    return responses.select("form_id", "response_id", *[answer(q) for q in questions])


# The page properties a search hit shows, as patterns with one group.
META_PROPERTIES = {"og_type": ("og:type", ""), "published": ("article:published_time", "{0,10}")}


def _meta_patterns(name: str, most: str) -> list[str]:
    """The content of a property's tag, attributes in any order, in double quotes, single quotes or none."""
    tag = rf"""(?i)<meta\b(?=[^>]*\sproperty\s*=\s*["']?{re.escape(name)}["'\s/>])[^>]*\scontent\s*=\s*"""
    return [f"{tag}{quote}([^{ends}]{most or '*'})" for quote, ends in (('"', '"'), ("'", "'"), ("(?![\"'])", r"\s>"))]


META_PATTERNS = {column: _meta_patterns(*rule) for column, rule in META_PROPERTIES.items()}


def page_metadata(pages: DataFrame, patterns: dict[str, str | list[str]] | None = None) -> DataFrame:
    """``page_id, host`` and one column per property, null where the page lacks it; of several patterns the first that finds some."""

    def first(ways: str | list[str]) -> Column:
        tried = [F.nullif(F.regexp_extract("html", p, 1), F.lit("")) for p in ([ways] if isinstance(ways, str) else ways)]
        return F.coalesce(*tried)

    found = [first(ways).alias(name) for name, ways in (META_PATTERNS if patterns is None else patterns).items()]
    return pages.select("page_id", host(F.col("url")).alias("host"), *found)


def metadata_coverage(pages: DataFrame, patterns: dict[str, str] | None = None) -> DataFrame:
    """Per host: pages, and pages that have each property."""
    meta = page_metadata(pages, patterns)
    names = meta.columns[2:]
    return meta.groupBy("host").agg(F.count("*").alias("n_pages"), *[F.count(n).alias(f"n_{n}") for n in names])


# Kind of a file by its extension.
EXTENSION_TYPES = {
    ".md": "text/markdown",
    ".markdown": "text/markdown",
    ".txt": "text/plain",
    ".text": "text/plain",
    ".html": "text/html",
    ".htm": "text/html",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".doc": "application/msword",
    ".rtf": "application/rtf",
    ".odt": "application/vnd.oasis.opendocument.text",
}


def classify_files(files: DataFrame) -> DataFrame:
    """Files with ``mime_type`` from the extension of ``name``, else from signs of Markdown in ``text``."""
    entries = [F.lit(x) for pair in EXTENSION_TYPES.items() for x in pair]
    extension = F.lower(F.regexp_extract("name", r"[^/](\.[^./]+)$", 1))
    text = F.coalesce("text", F.lit(""))
    markdown = F.startswith(text, F.lit("#")) | F.contains(text, F.lit("```")) | F.contains(text, F.lit("**"))
    by_content = F.when(markdown, "text/markdown").otherwise("text/plain")
    known = F.try_element_at(F.create_map(*entries), extension)
    return files.withColumn("mime_type", F.coalesce(known, by_content))


def file_type_counts(files: DataFrame) -> DataFrame:
    """Files per kind."""
    return classify_files(files).groupBy("mime_type").agg(F.count("*").alias("n_files"))
