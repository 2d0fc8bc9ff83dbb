"""Registered queries of the sources and of the projections of nested records."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from deskmill.functions.addresses import column_index, column_letters
from deskmill.functions.text import encode_base64url
from deskmill.operators import nested
from deskmill.operators.windows import render_markdown
from deskmill.plans import bindings as b
from deskmill.plans.summaries import form_responses
from deskmill.session import configure, shared_dir
from deskmill.sources import exports, sheets
from deskmill.sources.tables import TABLES, read_table
from deskmill.streaming import landing


def _text(value):
    return F.lit(value).cast("string")


def _scratch(spark):
    return f"{shared_dir(configure(spark)).rstrip('/')}/out-{uuid.uuid4().hex}"


# ---- sources ----------------------------------------------------------------------------------


def _tables(spark, d):
    parts = [
        read_table(spark, d, t).agg(F.count("*").alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
        for t in TABLES
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def people(spark, d):
    """Customers as contact records."""
    k = F.col("c_custkey")
    key = k.cast("string")
    value = lambda v: F.struct(v.alias("value"))
    mail = F.concat(key, F.lit("@example.com"))
    source = lambda name: F.struct(F.lit(name).alias("type"))
    sources = F.array_compact(F.array(F.when(k % 2 == 0, source("CONTACT")), F.when(k % 5 != 0, source("PROFILE"))))
    return read_table(spark, d, "customer").select(
        F.concat(F.lit("people/c"), key).alias("resourceName"),
        F.lit("e").alias("etag"),
        F.array(
            F.struct(
                F.when(k % 10 != 0, F.col("c_name")).alias("displayName"), _text(None).alias("givenName"), _text(None).alias("familyName")
            )
        ).alias("names"),
        F.array(value(mail), value(F.lit("")), value(F.when(k % 2 == 0, F.upper(mail)))).alias("emailAddresses"),
        F.when(k % 3 == 0, F.array(value(F.concat(F.lit("+1 "), key)))).alias("phoneNumbers"),
        F.array(
            F.struct(
                F.when(k % 4 != 0, F.col("c_mktsegment")).alias("name"), F.when(k % 6 != 0, F.lit("Buyer")).alias("title")
            )
        ).alias("organizations"),
        F.array(F.struct(F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")).alias("formattedValue"))).alias("addresses"),
        F.when(
            k % 5 != 0,
            F.array(
                F.struct(
                    F.struct(
                        F.when(k % 2 == 0, (k % 60 + 1940)).cast("int").alias("year"),
                        (k % 12 + 1).cast("int").alias("month"),
                        F.when(k % 7 != 0, k % 28 + 1).cast("int").alias("day"),
                    ).alias("date")
                )
            ),
        ).alias("birthdays"),
        F.array().cast("array<struct<value:string>>").alias("urls"),
        F.array(value(F.repeat(F.concat("c_name", F.lit(" ")), (k % 16).cast("int")))).alias("biographies"),
        F.when(k % 9 != 0, F.struct(sources.alias("sources"))).alias("metadata"),
    )


def _read_export(spark, d):
    where = exports.write_export(people(spark, d), _scratch(spark), "person")
    return nested.flatten_contacts(exports.read_export(spark, where, "person"))


def _text_field(entity: str) -> str:
    return next(f.name for f in exports.entity_schema(entity) if f.dataType.simpleString() == "string")


def _landed(spark, d):
    """A line per supplier and entity, some of them broken off, landed by a stream and then once more without anything new."""
    names, key = sorted(exports.ENTITIES), F.col("s_suppkey")
    where = _scratch(spark)
    for number, entity in enumerate(names):
        broken = (key + number) % 7 == 0
        line = F.concat(F.lit(f'{{"{_text_field(entity)}": "'), F.col("s_name"), F.when(broken, F.lit("")).otherwise(F.lit('"}')))
        read_table(spark, d, "supplier").select(line.alias("value")).write.text(f"{where}/in/{entity}")
    for _ in range(2):
        for query in [landing.land_export(spark, f"{where}/in", entity, f"{where}/out") for entity in names]:
            query.awaitTermination()
    return landing.landing_counts(spark, f"{where}/out", names)


_ENTITY_SQL = ", ".join(f"({i}, '{e}')" for i, e in enumerate(sorted(exports.ENTITIES)))


def _delimited(spark, d):
    doc = F.col("doc_id")
    blobs = read_table(spark, d, "documents").select(
        "doc_id",
        F.when(doc % 3 == 0, F.replace("text", F.lit(". "), F.lit("\t")))
        .when(doc % 3 == 1, F.replace("text", F.lit(","), F.lit("")))
        .otherwise(F.col("text"))
        .alias("text"),
    )
    return sheets.read_delimited_tables(blobs, "doc_id")


def _grid(spark, d):
    sheet = F.col("sheet_id")
    title = F.when(sheet % 3 == 0, F.concat(F.lit("It's "), sheet.cast("string"))).otherwise(
        F.concat(F.lit("S_"), sheet.cast("string"))
    )
    values = F.array(*b.line_values())
    holed = F.transform(values, lambda v, i: F.when((i != 2) | (sheet % 2 == 0), v))
    blocks = b.order_lines(spark, d).select(
        title.alias("title"),
        F.when(F.col("row") > 0, F.col("row")).alias("start_row"),
        (sheet % 800).alias("start_col"),
        F.array(holed).alias("rows"),
    )
    cells = sheets.flatten_grid(blocks)
    letters = F.regexp_extract("address", r"!([A-Z]+)\d+$", 1)
    return cells.withColumn("col_again", column_index(letters)).withColumn(
        "next_col", column_letters(F.col("col") + 1)
    )


def _written(spark, d):
    cells = b.sheet_cells(spark, d)
    k = F.col("o_orderkey")
    ranges = read_table(spark, d, "orders").filter("o_orderstatus = 'P'").select(
        k.alias("rule_idx"), k.alias("sheet_id"), F.lit(0).cast("bigint").alias("r0"), F.lit(3).cast("bigint").alias("r1"),
        F.lit(1).alias("c0"), F.lit(3).alias("c1"),
    )
    updates = cells.filter("col < 3").withColumn("value", F.concat(F.lit("new "), "value"))
    return sheets.write_range(cells, _scratch(spark), ranges, updates)


def _cleared(spark, d):
    cells = b.sheet_cells(spark, d)
    k = F.col("o_orderkey")
    nothing = F.lit(None).cast("bigint")
    ranges = read_table(spark, d, "orders").filter("o_orderstatus = 'F'").select(
        k.alias("rule_idx"), k.alias("sheet_id"), nothing.alias("r0"), nothing.alias("r1"), F.lit(2).alias("c0"), F.lit(4).alias("c1")
    )
    return sheets.write_range(cells, _scratch(spark), ranges, mode="clear")[0]


# ---- mail -------------------------------------------------------------------------------------


def _headers(spark, d):
    k = F.col("c_custkey")
    entry = lambda n, v: F.struct(F.lit(n).alias("name"), v.alias("value"))
    entries = F.array_compact(
        F.array(
            entry("Subject", F.col("c_name")),
            entry("FROM", F.col("c_mktsegment")),
            F.when(k % 3 == 0, entry("subject", F.concat(F.lit("Re: "), "c_name"))),
            entry("X-Other", F.lit("x")),
            F.when(k % 2 == 0, entry("to", F.concat(F.lit("n"), F.col("c_nationkey").cast("string")))),
        )
    )
    return read_table(spark, d, "customer").select(
        k.alias("msg_id"), F.posexplode(entries).alias("pos", "h")
    ).select("msg_id", "pos", "h.name", "h.value")


def _pivot_headers(spark, d):
    headers = _headers(spark, d)
    folded = nested.pivot_headers(headers, ["Subject", "From", "To", "Cc"])
    exact = nested.pivot_headers(headers, ["Subject", "From"], exact_case=True).select(
        "msg_id", F.col("Subject").alias("exact_subject"), F.col("From").alias("exact_from")
    )
    return folded.join(exact, "msg_id")


def _parts(spark, d):
    doc, text = F.col("doc_id"), F.col("text")

    def part(depth, pos, mime, body):
        return F.struct(
            F.lit(depth).alias("depth"), F.lit(pos).alias("pos"), F.lit(mime).alias("mime"), encode_base64url(body).alias("data")
        )

    parts = F.array_compact(
        F.array(
            F.when(doc % 5 == 0, part(0, 0, "text/plain", F.concat(F.lit("root "), "lang"))),
            part(0, 0, "text/html", F.concat(F.lit("<i>"), "source")),
            part(1, 0, "text/plain", F.when(doc % 4 == 0, F.concat(F.lit("first "), "text")).otherwise("")),
            part(1, 1, "image/png", F.lit("img")),
            F.when(doc % 3 != 0, part(1, 2, "text/html", F.concat(F.lit("<p>"), "text", F.lit("</p>")))),
            F.when(doc % 2 == 0, part(2, 0, "text/plain", text)),
        )
    )
    return read_table(spark, d, "documents").select(doc.alias("msg_id"), F.explode(parts).alias("p")).select(
        "msg_id", "p.*"
    )


def _bodies(spark, d):
    doc = F.col("doc_id")
    text = F.when(doc % 4 == 0, F.lit(" \n ")).when(doc % 4 == 1, F.col("text")).when(
        doc % 4 == 2, F.concat(F.lit("<!-- x -->"), "text")
    ).otherwise(F.lit("short"))
    docs = read_table(spark, d, "documents").select("doc_id", text.alias("text"))
    pages = read_table(spark, d, "pages").select(F.col("page_id").alias("doc_id"), "html")
    return docs.join(pages, "doc_id", "left")


def _attachments(spark, d):
    doc = F.col("doc_id")
    return read_table(spark, d, "documents").select(
        doc.alias("msg_id"),
        F.when(doc % 3 != 0, F.concat(F.lit("f"), doc.cast("string"))).otherwise("").alias("filename"),
        F.when(F.col("lang") != "de", F.concat(F.lit("x/"), "lang")).alias("mime"),
        F.when(doc % 2 == 0, F.col("n_chars")).alias("size"),
        F.when(doc % 5 != 0, F.concat(F.lit("a"), doc.cast("string"))).alias("attachment_id"),
    )


# ---- calendar, contacts, chat -----------------------------------------------------------------


def _attendees(spark, d):
    e = F.col("event_id")
    kind = F.col("event_type")
    answer = (
        F.when(kind == "view", "accepted").when(kind == "click", "declined").when(kind == "error", "tentative")
        .when(kind == "purchase", "needsAction")
    )
    user = F.col("user_id").cast("string")

    def person(email, response, optional, organizer):
        return F.struct(
            email.alias("email"), response.alias("responseStatus"), optional.alias("optional"), organizer.alias("organizer")
        )

    no = F.lit(None).cast("boolean")
    attendees = F.array(
        person(F.concat(user, F.lit("@x")), _text("accepted"), no, F.lit(True)),
        person(F.when(e % 3 != 0, F.concat(user, F.lit("@y"))), answer, e % 2 == 0, no),
    )
    guests = F.when(e % 4 == 0, F.array(F.concat(F.lit("g"), user, F.lit("@z"))))
    return read_table(spark, d, "events").select(
        "event_id", F.when(e % 7 != 0, attendees).alias("attendees"), guests.alias("guests")
    )


def chat_messages(spark, d):
    """Conversation turns as chat messages with links and attachments."""
    conv, turn = F.col("conv_id").cast("string"), F.col("turn")
    link = F.concat(F.lit("http://x.example/"), conv)

    def note(kind, uri):
        return F.struct(_text(kind).alias("type"), F.struct(uri.alias("uri")).alias("richLinkMetadata"))

    return read_table(spark, d, "conversations").select(
        F.col("role").alias("space"),
        F.concat(conv, F.lit("/"), turn.cast("string")).alias("name"),
        F.when(turn % 2 == 0, F.concat("text", F.lit(" "), link)).otherwise(F.col("text")).alias("text"),
        F.array(
            note("RICH_LINK", link), note("USER_MENTION", F.lit("http://y.example/")),
            note("RICH_LINK", F.when(turn % 3 == 0, F.lit("http://z.example/")).otherwise("")),
        ).alias("annotations"),
        F.transform(
            F.sequence(F.lit(1), turn),
            lambda i: F.struct(
                F.when(i % 2 == 0, F.concat(F.lit("file"), i.cast("string"))).alias("contentName"),
                F.when(i % 3 == 0, F.lit("image/png")).alias("contentType"),
            ),
        ).alias("attachment"),
    ).withColumn("attachment", F.when(F.col("name").endswith("/0"), F.expr("slice(attachment, 1, 0)")).otherwise(F.col("attachment")))


def _reactions(spark, d):
    kind = F.col("event_type")

    def reaction(unicode, uid, count):
        return F.struct(
            F.struct(unicode.alias("unicode"), F.struct(uid.alias("uid")).alias("customEmoji")).alias("emoji"),
            count.cast("int").alias("reactionCount"),
        )

    reactions = F.array(
        reaction(F.when(kind == "view", F.lit("👍")).when(kind == "click", F.lit("")), F.when(kind != "error", kind), F.floor("value")),
        reaction(F.lit("🎉"), _text(None), F.when(kind != "signup", F.lit(1))),
    )
    return read_table(spark, d, "events").select(
        F.col("user_id").alias("name"), reactions.alias("emojiReactionSummaries")
    )


# ---- sheets, documents, slides ----------------------------------------------------------------


def _hyperlinks(spark, d):
    page = F.col("page_id")
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    cells = read_table(spark, d, "pages").select(
        F.when(page % 2 == 0, F.lit("Links")).otherwise("My links").alias("title"),
        page.alias("row"), (page % 900).alias("col"), F.when(page % 3 != 0, F.col("url")).alias("link"),
        F.when(page % 5 != 0, F.concat(links, links)).alias("run_links"),
    )
    return nested.cell_hyperlinks(cells)


def _rectangular(spark, d):
    lines = read_table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("row_idx", "line"))
    rows = lines.select(F.col("doc_id").alias("table_id"), "row_idx", F.split("line", ",").alias("cells"))
    return nested.rectangularise(rows).select(
        "table_id", "row_idx", F.size("cells").alias("width"), F.array_join("cells", "|").alias("line")
    )


def nested_documents(spark, d):
    """Documents with a nested body: each line an element, by its place a bold, listed or plain paragraph,
    a table, a break, a table of contents or an unknown kind."""
    style_type = (
        "struct<bold:boolean,italic:boolean,strikethrough:boolean,link:struct<url:string>,"
        "weightedFontFamily:struct<fontFamily:string>>"
    )
    para_type = (
        f"struct<elements:array<struct<textRun:struct<content:string,textStyle:{style_type}>>>,"
        "paragraphStyle:struct<namedStyleType:string>,bullet:struct<listId:string,nestingLevel:int>>"
    )
    cell_type = f"struct<startIndex:int,endIndex:int,content:array<struct<paragraph:{para_type}>>>"
    no = F.lit(None).cast("boolean")

    def run(text, bold=no):
        style = F.struct(
            bold.alias("bold"), no.alias("italic"), no.alias("strikethrough"),
            F.lit(None).cast("struct<url:string>").alias("link"),
            F.lit(None).cast("struct<fontFamily:string>").alias("weightedFontFamily"),
        )
        return F.struct(F.struct(text.alias("content"), style.alias("textStyle")).alias("textRun"))

    def paragraph(runs, style=None, list_id=None):
        bullet = F.struct(list_id.alias("listId"), F.lit(None).cast("int").alias("nestingLevel")) if list_id is not None else None
        return F.struct(
            runs.alias("elements"),
            F.struct(F.lit(style).cast("string").alias("namedStyleType")).alias("paragraphStyle"),
            (F.when(list_id.isNotNull(), bullet) if bullet is not None else F.lit(None)).alias("bullet"),
        ).cast(para_type)

    def table(line, i):
        rows = F.split(line, r"\. ")
        return F.struct(
            F.transform(
                rows,
                lambda r, j: F.struct(
                    F.transform(
                        F.split(r, ","),
                        lambda c, m: F.struct(
                            (i * 1000 + j * 10 + m).alias("startIndex"),
                            (i * 1000 + j * 10 + m + 1).alias("endIndex"),
                            F.array(F.struct(paragraph(F.array(run(c))).alias("paragraph"))).alias("content"),
                        ).cast(cell_type),
                    ).alias("tableCells")
                ),
            ).alias("tableRows")
        )

    def element(line, i):
        kind = i % 9
        return F.struct(
            F.when(i > 0, i * 1000).alias("startIndex"),
            (i * 1000 + 999).alias("endIndex"),
            F.when(
                kind < 5,
                paragraph(
                    F.array(run(line, kind == 0), run(F.lit("\n"))), "NORMAL_TEXT", F.when(kind.isin(1, 2), F.lit("num"))
                ),
            ).alias("paragraph"),
            F.when(kind == 5, table(line, i)).alias("table"),
            F.when(kind == 6, F.struct(F.lit("x").alias("sectionStyle"))).alias("sectionBreak"),
            F.when(kind == 7, F.struct(F.lit("x").alias("content"))).alias("tableOfContents"),
        )

    levels = F.array(F.struct(F.lit("DECIMAL").alias("glyphType")))
    lists = F.create_map(F.lit("num"), F.struct(F.struct(levels.alias("nestingLevels")).alias("listProperties")))
    return read_table(spark, d, "documents").select(
        "doc_id", lists.alias("lists"), F.transform(F.split("text", "\n"), element).alias("content")
    )


def _flat_documents(spark, d):
    return nested.flatten_document(nested_documents(spark, d))


def slides(spark, d):
    """Documents as slides: the words of the text in reverse order, a blank shape, a table, a line, an unknown."""
    words = F.split("text", " ")
    runs = F.reverse(
        F.transform(
            words,
            lambda w, i: F.struct(
                F.when(i > 0, i * 10).alias("startIndex"),
                F.struct(F.concat(w, F.lit(" ")).alias("content")).alias("textRun"),
            ),
        )
    )
    documents = read_table(spark, d, "documents").select("doc_id", runs.alias("runs"))
    runs = F.col("runs")
    shape = lambda text: F.struct(F.struct(text.alias("textElements")).alias("text"))
    blank = F.slice(runs, 1, 0)

    def element(shape_, table=None, line=None):
        return F.struct(
            shape_.alias("shape"),
            F.lit(table).cast("struct<rows:int>").alias("table") if table is None else F.struct(F.lit(table).alias("rows")).alias("table"),
            F.lit(line).cast("struct<lineType:string>").alias("line") if line is None else F.struct(F.lit(line).alias("lineType")).alias("line"),
        )

    no_shape = F.when(F.lit(False), shape(runs))
    elements = F.concat(
        F.array(element(shape(runs)), element(shape(blank)), element(no_shape, table=3), element(no_shape, line="STRAIGHT")),
        F.when(F.col("doc_id") % 2 == 0, F.array(element(no_shape))).otherwise(F.array(element(shape(F.slice(runs, 1, 1))))),
    )
    return documents.select(F.col("doc_id").alias("objectId"), elements.alias("pageElements"))


# ---- forms, pages, files ----------------------------------------------------------------------

PAGE_PATTERNS = {
    "charset": r'(?i)<meta[^>]*charset="([^"]*)"',
    "title": r"(?is)<title>(.*?)</title>",
    "lang": r'(?i)<html[^>]*lang="([^"]*)"',
    "og_type": nested.META_PATTERNS["og_type"],
}


def marked_pages(spark, d):
    """Pages with quoted signs, open ends and page properties put in by their number."""
    k, html = F.col("page_id"), F.col("html")
    # Attributes in any order and quotes.
    head = F.concat(
        F.when(k % 3 == 0, F.lit('<meta property="og:type" content="article">')).when(k % 3 == 1, F.lit("<META content='web site' property='og:type'>")).otherwise(F.lit("")),
        F.when(k % 4 < 2, F.concat(F.lit('<meta name="x" property="article:published_time" content="2024-0'), (k % 9 + 1).cast("string"), F.lit('-11T10:00:00Z">'))).otherwise(F.lit("")),
    )
    tail = (
        F.when(k % 5 == 0, F.lit("<p title='a>b' data-x=\"c > 'd'\">quoted</p>"))
        .when(k % 5 == 1, F.lit("shown<style media=print>.x > y { } never closed <p>hidden"))
        .when(k % 5 == 2, F.lit("<script>if (a < b) { s = '</p>' }</script >1 < 2 <b>and</b> 3"))
        .when(k % 5 == 3, F.lit("kept <!-- open <p>hidden</p>"))
        .otherwise(F.lit("<p title=\"odd>text</p><i class='"))
    )
    return read_table(spark, d, "pages").select("page_id", "url", F.concat(head, html, tail).alias("html"))


def _named_files(spark, d):
    doc = F.col("doc_id")
    ending = (
        F.when(doc % 8 == 0, ".md").when(doc % 8 == 1, ".HTML").when(doc % 8 == 2, ".docx").when(doc % 8 == 3, ".tar.odt")
        .when(doc % 8 == 4, ".bin").otherwise("")
    )
    stem = F.when(doc % 8 == 7, F.lit(".rtf")).otherwise(F.concat(F.lit("doc"), doc.cast("string")))
    return read_table(spark, d, "documents").select("doc_id", F.concat(stem, ending).alias("name"), "text")


QUERIES = {
    "s1_read_tables": _tables,
    "s1_read_export": _read_export,
    "s1_landed_entities": _landed,
    "s2_read_delimited_tables": _delimited,
    "s3_flatten_grid": _grid,
    "s4_write_range": lambda s, d: _written(s, d)[0],
    "s4_write_counts": lambda s, d: _written(s, d)[1],
    "s4_clear_range": _cleared,
    "p1_pivot_headers": _pivot_headers,
    "p2_select_bodies": lambda s, d: nested.select_bodies(_parts(s, d)),
    "p3_choose_body": lambda s, d: nested.choose_body(_bodies(s, d)).select("doc_id", "choice", "content"),
    "p3_body_choices": lambda s, d: nested.body_choices(_bodies(s, d)),
    "p4_page_text": lambda s, d: nested.page_text(read_table(s, d, "pages")),
    "p4_page_text_corpus": lambda s, d: nested.page_text_corpus(read_table(s, d, "pages")),
    "p4_marked_page_text": lambda s, d: nested.page_text(marked_pages(s, d)),
    "p5_attachments_inventory": lambda s, d: nested.attachments_inventory(_attachments(s, d)),
    "p5_attachment_totals": lambda s, d: nested.attachment_totals(_attachments(s, d)),
    "p6_attendee_rows": lambda s, d: nested.attendee_rows(_attendees(s, d)),
    "p6_attendee_responses": lambda s, d: nested.attendee_responses(_attendees(s, d)),
    "p7_flatten_contacts": lambda s, d: nested.flatten_contacts(people(s, d)),
    "p7_contact_profile": lambda s, d: nested.contact_profile(people(s, d)),
    "p8_rich_links": lambda s, d: nested.rich_links(chat_messages(s, d)),
    "p8_rich_link_counts": lambda s, d: nested.rich_link_counts(chat_messages(s, d)),
    "p8_message_attachments": lambda s, d: nested.message_attachments(chat_messages(s, d)),
    "p9_reaction_totals": lambda s, d: nested.reaction_totals(_reactions(s, d)),
    "p10_cell_hyperlinks": _hyperlinks,
    "p11_rectangularise": _rectangular,
    "p12_flatten_document": _flat_documents,
    "p13_table_inventory": lambda s, d: nested.table_inventory(nested_documents(s, d)),
    "p13_document_cells": lambda s, d: nested.document_cells(nested_documents(s, d)),
    "w3_render_nested_documents": lambda s, d: render_markdown(nested.markdown_elements(nested_documents(s, d))),
    "p15_slide_text": lambda s, d: nested.slide_text(slides(s, d)),
    "p15_slide_elements": lambda s, d: nested.slide_elements(slides(s, d)),
    "p16_form_answers_long": lambda s, d: nested.form_answers_long(form_responses(s, d)),
    "p16_form_answers_wide": lambda s, d: nested.form_answers_wide(form_responses(s, d), ["role", "opening", "long", "even"]),
    "p17_page_metadata": lambda s, d: nested.page_metadata(read_table(s, d, "pages"), PAGE_PATTERNS),
    "p17_page_properties": lambda s, d: nested.page_metadata(marked_pages(s, d)),
    "p17_metadata_coverage": lambda s, d: nested.metadata_coverage(read_table(s, d, "pages"), PAGE_PATTERNS),
    "p18_classify_files": lambda s, d: nested.classify_files(_named_files(s, d)).select("doc_id", "name", "mime_type"),
    "p18_file_type_counts": lambda s, d: nested.file_type_counts(_named_files(s, d)),
}

BLANK = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"


def _visible_sql(column: str, markup: tuple[str, ...] = (r"(?is)<script\b.*?</script\s*>", r"(?is)<style\b.*?</style\s*>", r"(?s)<!--.*?-->", "<[^>]+>")) -> str:
    sql = column
    for pattern in markup:
        sql = f"regexp_replace({sql}, '{pattern}', '', 'g')"
    for entity, char in (
        ("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("copy", "©"), ("middot", "·"),
        ("hellip", "…"), ("mdash", "—"), ("ndash", "–"), ("amp", "&"),
    ):
        sql = f"replace({sql}, '&{entity};', '{char}')"
    return f"trim(regexp_replace({sql}, '{BLANK}+', ' ', 'g'))"


# The same scan with what this engine's patterns can say: no look-around, and a script's end without a reference.
_ATTRIBUTES_SQL = """(?:[^"''>]|"[^"]*"|''[^'']*'')*"""
_MARKUP_SQL = "(?is)" + "|".join(
    [
        r"<!--.*?(?:-->|\z)",
        *[rf"<{t}(?:[\s/]{_ATTRIBUTES_SQL})?>.*?(?:</{t}\s*>|\z)" for t in ("script", "style")],
        f"</?[a-z]{_ATTRIBUTES_SQL}>",
        "<[!?/a-z][^>]*>",
        r"<[!?/a-z].*\z",
    ]
)
# The pages of marked_pages.
_MARKED_SQL = """
marked AS (SELECT page_id, url, html || CASE page_id % 5 WHEN 0 THEN '<p title=''a>b'' data-x="c > ''d''">quoted</p>'
  WHEN 1 THEN 'shown<style media=print>.x > y { } never closed <p>hidden' WHEN 2 THEN '<script>if (a < b) { s = ''</p>'' }</script >1 < 2 <b>and</b> 3'
  WHEN 3 THEN 'kept <!-- open <p>hidden</p>' ELSE '<p title="odd>text</p><i class=''' END AS html FROM pages)
"""


def _stripped_sql(column: str) -> str:
    return f"regexp_replace({column}, '^{BLANK}+|{BLANK}+$', '', 'g')"


HOST_SQL = "lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1))"

CONTACTS_SQL = """
contacts AS (SELECT 'c' || c_custkey AS contact_id, CASE WHEN c_custkey % 10 <> 0 THEN c_name END AS name,
  c_custkey || '@example.com' || CASE WHEN c_custkey % 2 = 0 THEN ', ' || c_custkey || '@EXAMPLE.COM' ELSE '' END AS email,
  CASE WHEN c_custkey % 3 = 0 THEN '+1 ' || c_custkey END AS phone,
  CASE WHEN c_custkey % 4 = 0 AND c_custkey % 6 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN 'Buyer'
       WHEN c_custkey % 6 = 0 THEN 'at ' || c_mktsegment ELSE 'Buyer at ' || c_mktsegment END AS organization,
  'Nation ' || c_nationkey AS address,
  CASE WHEN c_custkey % 5 <> 0 THEN CASE WHEN c_custkey % 2 = 0 THEN (c_custkey % 60 + 1940) || '/' ELSE '' END || (c_custkey % 12 + 1) || '/'
    || CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 28 + 1 AS VARCHAR) ELSE '?' END END AS birthday,
  CAST(NULL AS VARCHAR) AS urls,
  CASE WHEN c_custkey % 16 = 0 THEN NULL WHEN (length(c_name) + 1) * (c_custkey % 16) > 200
    THEN left(repeat(c_name || ' ', c_custkey % 16), 200) || '...' ELSE repeat(c_name || ' ', c_custkey % 16) END AS notes,
  CASE WHEN c_custkey % 9 <> 0 THEN nullif(concat_ws(', ', CASE WHEN c_custkey % 2 = 0 THEN 'CONTACT' END,
    CASE WHEN c_custkey % 5 <> 0 THEN 'PROFILE' END), '') END AS sources FROM customer)
"""

BODIES_SQL = f"""
bodies AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN ' ' || chr(10) || ' ' WHEN 1 THEN text WHEN 2 THEN '<!-- x -->' || text
    ELSE 'short' END AS text, html FROM documents LEFT JOIN pages ON page_id = doc_id),
trimmed AS (SELECT doc_id, text, {_stripped_sql('text')} AS t, {_stripped_sql("coalesce(html, '')")} AS h FROM bodies),
chosen AS (SELECT *, CASE WHEN h <> '' AND (t = '' OR contains(t, '<!--') OR length(h) > length(t) * 50) THEN 'html'
    WHEN t <> '' THEN 'text' ELSE 'none' END AS choice FROM trimmed),
shown AS (SELECT *, {_visible_sql('h')} AS v FROM chosen),
final AS (SELECT doc_id, choice, CASE choice WHEN 'html' THEN CASE WHEN length(v) > 20000
    THEN left(v, 20000) || chr(10) || chr(10) || '[Content truncated...]' ELSE v END
    WHEN 'text' THEN text ELSE '[No readable content found]' END AS content FROM shown)
"""

LINKS_SQL = """
links AS (SELECT role AS space, conv_id || '/' || turn AS name, 'http://x.example/' || conv_id AS uri FROM conversations WHERE turn % 2 = 1
  UNION ALL SELECT role, conv_id || '/' || turn, 'http://z.example/' FROM conversations WHERE turn % 3 = 0)
"""

ATTENDEES_SQL = """
rows_ AS (
  SELECT event_id, user_id || '@x' AS email, 'accepted' AS response, false AS optional, true AS organizer FROM events WHERE event_id % 7 <> 0
  UNION ALL SELECT event_id, user_id || '@y', CASE event_type WHEN 'view' THEN 'accepted' WHEN 'click' THEN 'declined'
    WHEN 'error' THEN 'tentative' WHEN 'purchase' THEN 'needsAction' ELSE 'unknown' END, event_id % 2 = 0, false
  FROM events WHERE event_id % 7 <> 0 AND event_id % 3 <> 0
  UNION ALL SELECT event_id, 'g' || user_id || '@z', 'unknown', false, false FROM events WHERE event_id % 4 = 0)
"""

META_SQL = f"""
meta AS (SELECT page_id, {HOST_SQL} AS host,
  nullif(regexp_extract(html, '(?i)<meta[^>]*charset="([^"]*)"', 1), '') AS charset,
  nullif(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '') AS title,
  nullif(regexp_extract(html, '(?i)<html[^>]*lang="([^"]*)"', 1), '') AS lang, CAST(NULL AS VARCHAR) AS og_type FROM pages)
"""

KINDS_SQL = """
named AS (SELECT doc_id, CASE WHEN doc_id % 8 = 7 THEN '.rtf' ELSE 'doc' || doc_id END || CASE doc_id % 8 WHEN 0 THEN '.md' WHEN 1 THEN '.HTML'
  WHEN 2 THEN '.docx' WHEN 3 THEN '.tar.odt' WHEN 4 THEN '.bin' ELSE '' END AS name, text FROM documents),
kinds AS (SELECT doc_id, name, CASE doc_id % 8 WHEN 0 THEN 'text/markdown' WHEN 1 THEN 'text/html'
  WHEN 2 THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document' WHEN 3 THEN 'application/vnd.oasis.opendocument.text'
  ELSE CASE WHEN text LIKE '#%' OR contains(text, '```') OR contains(text, '**') THEN 'text/markdown' ELSE 'text/plain' END END AS mime_type
  FROM named)
"""

ANSWERS_SQL = """
answers AS (
  SELECT role AS form_id, conv_id * 100 + turn AS response_id, 'role' AS question_id, role AS answer FROM conversations
  UNION ALL SELECT role, conv_id * 100 + turn, 'opening', array_to_string(string_split(text, ' ')[1:2], ', ') FROM conversations
  UNION ALL SELECT role, conv_id * 100 + turn, 'long', CASE WHEN length(text) >= 200 THEN 'yes' ELSE 'No answer provided' END FROM conversations
  UNION ALL SELECT role, conv_id * 100 + turn, 'even', CAST(turn AS VARCHAR) FROM conversations WHERE turn % 2 = 0)
"""

LETTERS_SQL = """CASE WHEN {c} < 26 THEN chr(CAST(65 + {c} AS INTEGER)) WHEN {c} < 702 THEN chr(CAST(64 + {c} // 26 AS INTEGER)) || chr(CAST(65 + {c} % 26 AS INTEGER))
  ELSE chr(CAST(65 + ({c} - 702) // 676 AS INTEGER)) || chr(CAST(65 + (({c} - 702) // 26) % 26 AS INTEGER)) || chr(CAST(65 + ({c} - 702) % 26 AS INTEGER)) END"""

ORACLES = {
    "s1_read_tables": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES),
    "s1_landed_entities": f"""
SELECT entity, count(*) AS n_read, count(*) FILTER (WHERE (s_suppkey + k) % 7 = 0) AS n_rejected, count(*) FILTER (WHERE (s_suppkey + k) % 7 <> 0) AS n_kept
FROM supplier, (VALUES {_ENTITY_SQL}) e(k, entity) GROUP BY 1""",
    "s1_read_export": f"WITH {CONTACTS_SQL} SELECT * FROM contacts",
    "s2_read_delimited_tables": f"""
WITH blobs AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN replace(text, '. ', chr(9)) WHEN 1 THEN replace(text, ',', '') ELSE text END AS text FROM documents),
k AS (SELECT *, CASE WHEN contains(text, chr(9)) THEN 'tab' WHEN contains(text, ',') THEN 'comma' ELSE 'blank' END AS how,
  string_split({_stripped_sql('text')}, chr(10)) AS ls FROM blobs),
l AS (SELECT doc_id, how, unnest(ls) AS line, CAST(unnest(range(len(ls))) AS INTEGER) AS row FROM k),
c AS (SELECT doc_id, row, CASE how WHEN 'tab' THEN string_split(line, chr(9)) WHEN 'comma' THEN string_split(line, ',')
  ELSE list_filter(regexp_split_to_array(line, '\\s+'), lambda w: w <> '') END AS cs FROM l)
SELECT doc_id, row, CAST(unnest(range(len(cs))) AS INTEGER) AS col, unnest(cs) AS value FROM c""",
    "s3_flatten_grid": f"""
WITH {b.CELLS_SQL},
g AS (SELECT CASE WHEN sheet_id % 3 = 0 THEN 'It''s ' || sheet_id ELSE 'S_' || sheet_id END AS title, row, sheet_id % 800 + col AS col, value
  FROM cells WHERE col <> 2 OR sheet_id % 2 = 0),
h AS (SELECT *, {LETTERS_SQL.format(c='col')} AS letters, {LETTERS_SQL.format(c='(col + 1)')} AS next_col FROM g)
SELECT title, row, col, value, CASE WHEN title LIKE 'It%' THEN '''' || replace(title, '''', '''''') || '''' ELSE title END || '!' || letters || (row + 1) AS address,
  CAST(col AS INTEGER) AS col_again, next_col FROM h""",
    "s4_write_range": f"""
WITH {b.CELLS_SQL}
SELECT sheet_id, row, col, CASE WHEN o_orderstatus = 'P' AND row < 3 AND col IN (1, 2) THEN 'new ' || value ELSE value END AS value
FROM cells LEFT JOIN orders ON o_orderkey = sheet_id""",
    "s4_write_counts": f"""
WITH {b.CELLS_SQL}
SELECT sheet_id, count(*) AS updated_cells, count(DISTINCT row) AS updated_rows, count(DISTINCT col) AS updated_columns
FROM cells JOIN orders ON o_orderkey = sheet_id WHERE o_orderstatus = 'P' AND row < 3 AND col IN (1, 2) GROUP BY 1""",
    "s4_clear_range": f"""
WITH {b.CELLS_SQL}
SELECT cells.* FROM cells LEFT JOIN orders ON o_orderkey = sheet_id WHERE NOT (coalesce(o_orderstatus, '') = 'F' AND col IN (2, 3))""",
    "p1_pivot_headers": """
SELECT c_custkey AS msg_id, CASE WHEN c_custkey % 3 = 0 THEN 'Re: ' || c_name ELSE c_name END AS "Subject", c_mktsegment AS "From",
  CASE WHEN c_custkey % 2 = 0 THEN 'n' || c_nationkey END AS "To", CAST(NULL AS VARCHAR) AS "Cc", c_name AS exact_subject,
  CAST(NULL AS VARCHAR) AS exact_from FROM customer""",
    "p2_select_bodies": """
SELECT doc_id AS msg_id, CASE WHEN doc_id % 4 = 0 THEN 'first ' || text WHEN doc_id % 2 = 0 THEN text
  WHEN doc_id % 5 = 0 THEN 'root ' || lang ELSE '' END AS text,
  CASE WHEN doc_id % 3 <> 0 THEN '<p>' || text || '</p>' ELSE '<i>' || source END AS html FROM documents""",
    "p3_choose_body": f"WITH {BODIES_SQL} SELECT * FROM final",
    "p3_body_choices": f"""
WITH {BODIES_SQL} SELECT choice, count(*) AS n_messages, CAST(sum(length(content)) AS BIGINT) AS n_chars FROM final GROUP BY 1""",
    "p4_page_text": f"SELECT page_id, {HOST_SQL} AS host, {_visible_sql('html')} AS text FROM pages",
    "p4_marked_page_text": f"WITH {_MARKED_SQL} SELECT page_id, {HOST_SQL} AS host, {_visible_sql('html', (_MARKUP_SQL,))} AS text FROM marked",
    "p4_page_text_corpus": f"""
SELECT {HOST_SQL} AS host, count(*) AS n_pages, CAST(sum(length({_visible_sql('html')})) AS BIGINT) AS n_chars FROM pages GROUP BY 1""",
    "p5_attachments_inventory": """
SELECT doc_id AS msg_id, 'f' || doc_id AS filename, CASE WHEN lang <> 'de' THEN 'x/' || lang ELSE 'application/octet-stream' END AS mime,
  CASE WHEN doc_id % 2 = 0 THEN n_chars ELSE 0 END AS size, 'a' || doc_id AS attachment_id
FROM documents WHERE doc_id % 3 <> 0 AND doc_id % 5 <> 0""",
    "p5_attachment_totals": """
SELECT CASE WHEN lang <> 'de' THEN 'x/' || lang ELSE 'application/octet-stream' END AS mime, count(*) AS n_attachments,
  CAST(sum(CASE WHEN doc_id % 2 = 0 THEN n_chars ELSE 0 END) AS BIGINT) AS n_bytes
FROM documents WHERE doc_id % 3 <> 0 AND doc_id % 5 <> 0 GROUP BY 1""",
    "p6_attendee_rows": f"WITH {ATTENDEES_SQL} SELECT * FROM rows_",
    "p6_attendee_responses": f"""
WITH {ATTENDEES_SQL} SELECT e.event_id, count(email) AS n_attendees, """
    + ", ".join(f"count(*) FILTER (WHERE response = '{r}') AS \"n_{r}\"" for r in nested.RESPONSES)
    + """, count(*) FILTER (WHERE optional) AS n_optional, count(*) FILTER (WHERE organizer) AS n_organizers
FROM events e LEFT JOIN rows_ USING (event_id) GROUP BY 1""",
    "p7_flatten_contacts": f"WITH {CONTACTS_SQL} SELECT * FROM contacts",
    "p7_contact_profile": f"WITH {CONTACTS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS field, count({c}) AS n_filled, round(count({c}) / count(*), 6) AS filled_rate FROM contacts"
        for c in ("name", "email", "phone", "organization", "address", "birthday", "urls", "notes", "sources")
    ),
    "p8_rich_links": f"WITH {LINKS_SQL} SELECT * FROM links",
    "p8_rich_link_counts": f"WITH {LINKS_SQL} SELECT space, count(*) AS n_links FROM links GROUP BY 1",
    "p8_message_attachments": """
WITH a AS (SELECT conv_id || '/' || turn AS name, unnest(range(1, turn + 1)) AS i FROM conversations)
SELECT name, CAST(i - 1 AS INTEGER) AS index, CASE WHEN i % 2 = 0 THEN 'file' || i ELSE 'unnamed' END AS content_name,
  CASE WHEN i % 3 = 0 THEN 'image/png' ELSE 'unknown type' END AS content_type FROM a""",
    "p9_reaction_totals": """
WITH r AS (SELECT user_id AS name, CASE event_type WHEN 'view' THEN '👍' WHEN 'error' THEN ':?:' ELSE ':' || event_type || ':' END AS symbol,
    CAST(floor(value) AS BIGINT) AS n FROM events
  UNION ALL SELECT user_id, '🎉', CASE WHEN event_type <> 'signup' THEN 1 ELSE 0 END FROM events)
SELECT name, symbol, CAST(sum(n) AS BIGINT) AS n_reactions FROM r GROUP BY 1, 2""",
    "p10_cell_hyperlinks": f"""
WITH l AS (SELECT page_id, page_id % 900 AS col, list_concat(CASE WHEN page_id % 3 <> 0 THEN [url] ELSE [] END,
    CASE WHEN page_id % 5 <> 0 THEN regexp_extract_all(html, 'href="([^"]*)"', 1) ELSE [] END) AS us FROM pages),
u AS (SELECT page_id, col, unnest(us) AS url, unnest(range(len(us))) AS i FROM l),
f AS (SELECT page_id, col, url, min(i) AS i FROM u WHERE url <> '' GROUP BY ALL)
SELECT CASE WHEN page_id % 2 = 0 THEN 'Links' ELSE '''My links''' END || '!' || {LETTERS_SQL.format(c='col')} || (page_id + 1) AS cell,
  CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS place, url FROM f""",
    "p11_rectangularise": f"""
WITH {b.LINES_SQL},
w AS (SELECT doc_id, CAST(pos AS INTEGER) AS row_idx, len(string_split(text, ',')) AS n, replace(text, ',', '|') AS line,
  first_value(len(string_split(text, ','))) OVER (PARTITION BY doc_id ORDER BY pos) AS first_n FROM raw_lines)
SELECT doc_id AS table_id, row_idx, CAST(greatest(n, first_n) AS INTEGER) AS width, line || repeat('|', greatest(first_n - n, 0)) AS line FROM w""",
    "p12_flatten_document": f"""
WITH {b.LINES_SQL}
SELECT doc_id, pos, CASE WHEN pos % 9 < 5 THEN 'paragraph' WHEN pos % 9 = 5 THEN 'table' WHEN pos % 9 = 6 THEN 'section_break'
    ELSE 'table_of_contents' END AS type, pos * 1000 AS start_index, pos * 1000 + 999 AS end_index,
  CASE WHEN pos % 9 < 5 THEN text || chr(10) END AS text, CASE WHEN pos % 9 < 5 THEN 'NORMAL_TEXT' END AS style,
  CASE WHEN pos % 9 IN (1, 2) THEN 'num' END AS list_id, CAST(NULL AS INTEGER) AS nesting,
  CASE WHEN pos % 9 = 5 THEN CAST(len(string_split(text, '. ')) AS INTEGER) END AS n_rows,
  CASE WHEN pos % 9 = 5 THEN CAST(len(string_split(string_split(text, '. ')[1], ',')) AS INTEGER) END AS n_cols
FROM raw_lines WHERE pos % 9 < 8""",
    "p13_document_cells": f"""
WITH {b.LINES_SQL},
t AS (SELECT doc_id, pos, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS table_idx, string_split(text, '. ') AS rs
  FROM raw_lines WHERE pos % 9 = 5),
r AS (SELECT doc_id, pos, table_idx, CAST(unnest(range(len(rs))) AS INTEGER) AS row, string_split(unnest(rs), ',') AS cs FROM t)
SELECT doc_id, table_idx, row, CAST(unnest(range(len(cs))) AS INTEGER) AS col, {_stripped_sql('unnest(cs)')} AS text,
  pos * 1000 + row * 10 + unnest(range(len(cs))) AS start_index, pos * 1000 + row * 10 + unnest(range(len(cs))) + 1 AS end_index FROM r""",
    "p13_table_inventory": f"""
WITH {b.LINES_SQL}
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS table_idx, pos * 1000 AS start_index,
  pos * 1000 + 999 AS end_index, CAST(len(string_split(text, '. ')) AS INTEGER) AS n_rows,
  CAST(len(string_split(string_split(text, '. ')[1], ',')) AS INTEGER) AS n_cols FROM raw_lines WHERE pos % 9 = 5""",
    "w3_render_nested_documents": f"""
WITH {b.LINES_SQL},
cells AS (SELECT doc_id, pos, i, len(string_split(s, ',')) AS n,
    array_to_string(list_transform(string_split(s, ','), lambda c: replace({_stripped_sql('c')}, '|', '\\|')), ' | ') AS line
  FROM (SELECT doc_id, pos, unnest(string_split(text, '. ')) AS s, unnest(range(len(string_split(text, '. ')))) AS i
        FROM raw_lines WHERE pos % 9 = 5)),
tables AS (SELECT doc_id, pos, string_agg('| ' || line || ' |' || CASE WHEN i = 0 THEN chr(10) || '|' || repeat(' --- |', n) ELSE '' END,
    chr(10) ORDER BY i) AS grid FROM cells GROUP BY doc_id, pos),
blocks AS (SELECT doc_id, pos, CASE pos % 9 WHEN 0 THEN '**' || text || '**' || chr(10)
    WHEN 1 THEN '1. ' || {_stripped_sql('text')} WHEN 2 THEN '2. ' || {_stripped_sql('text')}
    WHEN 3 THEN chr(10) || {_stripped_sql('text')} || chr(10) WHEN 4 THEN {_stripped_sql('text')} || chr(10)
    ELSE grid || chr(10) END AS block
  FROM raw_lines LEFT JOIN tables USING (doc_id, pos) WHERE pos % 9 < 6)
SELECT doc_id, rtrim(string_agg(block, chr(10) ORDER BY pos), chr(10)) || chr(10) AS markdown FROM blocks GROUP BY doc_id""",
    "p15_slide_text": f"""
WITH s AS (SELECT doc_id, text || ' ' || CASE WHEN doc_id % 2 = 1 THEN chr(10) || list_extract(string_split(text, ' '), -1) || ' ' ELSE '' END AS t FROM documents),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: {_stripped_sql('x')} <> '') AS ls FROM s)
SELECT doc_id AS "objectId", array_to_string(ls, chr(10)) AS text FROM l""",
    "p15_slide_elements": """
SELECT 'shape' AS kind, 2 * count(*) + count(*) FILTER (WHERE doc_id % 2 = 1) AS n_elements FROM documents
UNION ALL SELECT 'table', count(*) FROM documents UNION ALL SELECT 'line', count(*) FROM documents
UNION ALL SELECT 'unknown', count(*) FILTER (WHERE doc_id % 2 = 0) FROM documents""",
    "p16_form_answers_long": f"WITH {ANSWERS_SQL} SELECT * FROM answers",
    "p16_form_answers_wide": f"""
WITH {ANSWERS_SQL} SELECT form_id, response_id, """
    + ", ".join(f"max(answer) FILTER (WHERE question_id = '{q}') AS \"{q}\"" for q in ("role", "opening", "long", "even"))
    + " FROM answers GROUP BY 1, 2",
    "p17_page_properties": f"""
SELECT page_id, {HOST_SQL} AS host, CASE page_id % 3 WHEN 0 THEN 'article' WHEN 1 THEN 'web site' END AS og_type,
  CASE WHEN page_id % 4 < 2 THEN '2024-0' || (page_id % 9 + 1) || '-11' END AS published FROM pages""",
    "p17_page_metadata": f"WITH {META_SQL} SELECT * FROM meta",
    "p17_metadata_coverage": f"""
WITH {META_SQL} SELECT host, count(*) AS n_pages, count(charset) AS n_charset, count(title) AS n_title, count(lang) AS n_lang,
  count(og_type) AS n_og_type FROM meta GROUP BY 1""",
    "p18_classify_files": f"WITH {KINDS_SQL} SELECT * FROM kinds",
    "p18_file_type_counts": f"WITH {KINDS_SQL} SELECT mime_type, count(*) AS n_files FROM kinds GROUP BY 1",
}
