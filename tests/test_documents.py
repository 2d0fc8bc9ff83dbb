"""Documents: structure, numbering, Markdown, positions, comments, tables, slides, tabs."""

import json
import random

import pytest
from pyspark.sql import functions as F

from deskmill.functions.markdown import RUN_TYPE
from deskmill.operators import aggregates, joins, nested, trees, windows
from deskmill.sources.exports import entity_schema
from deskmill.sources.sheets import flatten_grid, read_delimited_tables

ELEMENT = (
    "doc_id string, pos long, type string, style string, list_id string, nesting int, ordered boolean, "
    f"runs array<{RUN_TYPE}>, table_rows array<array<array<array<{RUN_TYPE}>>>>"
)


def run(content, bold=None, italic=None, strikethrough=None, font=None, url=None):
    return (content, bold, italic, strikethrough, font, url)


def para(*runs, style=None, lst=None, nesting=None, ordered=None):
    return ("paragraph", style, lst, nesting, ordered, list(runs), None)


def table(*rows):
    return ("table", None, None, None, None, None, [[[[run(c)]] for c in row] for row in rows])


def elements(spark, *items):
    return spark.createDataFrame([("d", i, *item) for i, item in enumerate(items)], ELEMENT)


def markdown(spark, *items):
    rows = windows.render_markdown(elements(spark, *items)).collect()
    return rows[0].markdown if rows else ""


def test_inline_marks(spark):
    text = markdown(
        spark,
        para(run("This is "), run("bold", bold=True), run(" and "), run("italic", italic=True), run(" text.\n")),
        para(run("x", True, True), run("code", font="Consolas", bold=True), run("gone", strikethrough=True)),
        para(run("site", bold=True, url="http://a"), run("\n")),
    )
    assert text == "This is **bold** and *italic* text.\n\n***x***`code`~~gone~~\n\n[**site**](http://a)\n"


def test_headings_and_table(spark):
    text = markdown(
        spark,
        para(run("Title\n"), style="TITLE"),
        para(run("Heading one\n"), style="HEADING_1"),
        para(run("Heading two\n"), style="HEADING_2"),
        table(["Name", "Age"], ["Al|ice", "30"]),
    )
    assert text.startswith("# Title\n\n# Heading one\n\n## Heading two\n\n| Name | Age |\n| --- | --- |\n| Al\\|ice | 30 |")
    assert text.endswith("30 |\n") and not text.endswith("\n\n")


def test_bullets(spark):
    text = markdown(spark, para(run("Item one\n"), lst="l"), para(run("Item two\n"), lst="l", nesting=1), para(run("after")))
    assert text == "- Item one\n  - Item two\n\nafter\n"


def test_empty_document(spark):
    assert markdown(spark, para(run("\n"))).strip() == ""
    assert windows.render_markdown(elements(spark)).count() == 0


def numbers(spark, *items):
    rows = windows.list_numbering(elements(spark, *items).withColumn("text", F.col("runs")[0]["content"])).collect()
    return [r.item_no for r in sorted(rows, key=lambda r: r.pos)]


def item(text="x", lst="l", nesting=0, ordered=True):
    return para(run(text), lst=lst, nesting=nesting, ordered=ordered)


def test_numbering(spark):
    plain, blank, blank_bullet = para(run("p")), para(run(" ")), para(run(" "), lst="l", ordered=True)
    section = ("section_break", None, None, None, None, None, None)
    assert numbers(spark, item(), item(), item(nesting=1), item()) == [1, 2, 1, 3]
    assert numbers(spark, item(), plain, item()) == [1, None, 1]
    assert numbers(spark, item(), table(["a"]), item()) == [1, None, 1]
    assert numbers(spark, item(), blank, plain, item()) == [1, None, None, 2]
    assert numbers(spark, item(), blank_bullet, plain, item()) == [1, None, None, 2]
    assert numbers(spark, item(), section, plain, item()) == [1, None, 1]
    assert numbers(spark, item(), item(lst="m"), item(ordered=False), item()) == [1, 1, None, 2]
    assert numbers(spark, item(), plain, plain, item(lst="m"), blank, item()) == [1, None, None, 1, None, 1]


def test_nested_document_to_markdown(spark):
    word = lambda t, **style: {"textRun": {"content": t, "textStyle": style}}
    entry = lambda t, lst, level=0: {
        "paragraph": {"elements": [word(t)], "bullet": {"listId": lst, **({"nestingLevel": level} if level else {})}}
    }
    cell = lambda *texts: {"content": [{"paragraph": {"elements": [word(t)]}} for t in texts]}
    levels = lambda *glyphs: {"listProperties": {"nestingLevels": [{"glyphType": g} for g in glyphs]}}
    docs = [
        {
            "doc_id": "d",
            "lists": {"num": levels("DECIMAL", "GLYPH_TYPE_UNSPECIFIED"), "dot": levels("GLYPH_TYPE_UNSPECIFIED")},
            "headers": {"h1": {}},
            "content": [
                {"sectionBreak": {}},
                {"paragraph": {"elements": [word("Head\n")], "paragraphStyle": {"namedStyleType": "HEADING_3"}}},
                {"paragraph": {"elements": [word("a "), word("b", bold=True, link={"url": "u"}), {"startIndex": 3}, word("\n")]}},
                entry("one\n", "num"), entry("sub\n", "num", 1), entry("two\n", "num"), entry("deep\n", "num", 7), entry("dot\n", "dot"),
                {"table": {"tableRows": [{"tableCells": [cell("x", " ", "y"), cell()]}]}},
                {"table": {}},
                entry("one again", "num"),
            ],
        },
        {"doc_id": "empty", "content": []},
    ]
    df = spark.createDataFrame([(json.dumps(x),) for x in docs], "j string").select(
        F.from_json("j", entity_schema("document")).alias("d")
    ).select("d.*")
    got = {r.doc_id: r.markdown for r in windows.render_markdown(nested.markdown_elements(df)).collect()}
    assert got == {
        "d": "### Head\n\na [**b**](u)\n\n1. one\n  - sub\n2. two\n" + " " * 14 + "- deep\n- dot\n\n| x y |  |\n| --- | --- |\n\n\n\n1. one again\n"
    }
    assert [tuple(r) for r in nested.document_segments(df).collect()] == [("d", "header")]


def test_numbering_across_chunks(spark):
    rows = [("d", i * 3000, *(para(run("p")) if i % 7 == 6 else item())) for i in range(30)]
    df = spark.createDataFrame(rows, ELEMENT).withColumn("text", F.col("runs")[0]["content"])
    got = [r.item_no for r in sorted(windows.list_numbering(df).collect(), key=lambda r: r.pos)]
    assert got == [None if i % 7 == 6 else i % 7 + 1 for i in range(30)]


FLAT = "doc_id string, pos long, type string, start_index long, end_index long, n_rows long, n_cols long"


@pytest.fixture(scope="module")
def flat(spark):
    return spark.createDataFrame(
        [
            ("d", 0, "section_break", 0, 1, None, None),
            ("d", 1, "paragraph", 1, 10, None, None),
            ("d", 2, "table", 10, 40, 2, 3),
            ("d", 3, "paragraph", 40, 50, None, None),
            ("d", 4, "table", 50, 60, 1, 4),
            ("t", 0, "table", 1, 9, 1, 1),
        ],
        FLAT,
    )


def test_stats(spark, flat):
    segments = spark.createDataFrame([("d", "header")], "doc_id string, kind string")
    got = {r.doc_id: tuple(r)[1:] for r in aggregates.document_stats(flat, segments).collect()}
    assert got["d"] == (5, 2, 2, 1, 60, 10, 6, True, False)
    assert got["t"] == (1, 1, 0, 0, 9, 1, 1, False, False)


def test_positions(spark, flat):
    points = spark.createDataFrame(
        [("d", i, i) for i in (0, 1, 9, 10, 25, 49, 60, 99)] + [("d", 100, 25), ("t", 0, 5), ("none", 0, 5)],
        "doc_id string, point_id int, index long",
    )
    cells = spark.createDataFrame(
        [("d", 0, 0, 11, 20), ("d", 0, 1, 20, 39)], "doc_id string, row int, col int, start_index long, end_index long"
    )
    found = joins.element_at_index(flat, points, cells=cells).collect()
    got = {(r.doc_id, r.point_id): (r.pos, r.type, r.row, r.col) for r in found}
    assert len(found) == 11
    assert got["d", 0] == (0, "section_break", None, None) and got["d", 9] == (1, "paragraph", None, None)
    assert got["d", 10] == (2, "table", None, None) and got["d", 25] == got["d", 100] == (2, "table", 0, 1)
    assert got["d", 60] == got["d", 99] == got["none", 0] == (None, None, None, None)
    nxt = {(r.doc_id, r.point_id): r.next_index for r in joins.next_paragraph(flat, points).collect()}
    assert nxt["d", 0] == 1 and nxt["d", 1] == nxt["d", 25] == 40 and nxt["d", 49] == nxt["d", 99] == 59
    assert nxt["t", 0] == 8 and nxt["none", 0] == 1


def test_ranges(spark, flat):
    ranges = spark.createDataFrame(
        [("d", 0, 0, 60), ("d", 1, 9, 41), ("d", 2, 10, 40), ("d", 3, 500, 600), ("d", 4, 10000, 90000)],
        "doc_id string, range_id int, range_start long, range_end long",
    )
    got = sorted((r.range_id, r.paragraph_start) for r in joins.paragraphs_in_ranges(flat, ranges).collect())
    assert got == [(0, 1), (0, 40), (1, 1), (1, 40), (2, 10), (3, 500), (4, 10000)]


def annotate(spark, text, comments, replies=()):
    docs = spark.createDataFrame([("d", text)], "doc_id string, text string")
    schema = "doc_id string, comment_no long, anchor string, author string, content string, resolved boolean"
    rows = [("d", i + 1, *c) for i, c in enumerate(comments)]
    said = spark.createDataFrame(
        list(replies), "doc_id string, comment_no long, reply_no long, author string, content string"
    )
    return joins.annotate_documents(docs, spark.createDataFrame(rows, schema), said).first().annotated


def test_comments_in_text(spark):
    assert annotate(spark, "Some text here.\n", [("text", "Alice", "Note.", False)]) == (
        "Some text[^c1] here.\n\n[^c1]: **Alice**: Note.\n"
    )
    missing = annotate(spark, "No match.\n", [("missing", "Bob", "Hm.", True)])
    assert missing == "No match.\n\n## Comments\n\n> missing\n\n- **Bob**: Hm. *(Resolved)*\n"
    assert annotate(spark, "Untouched\n", []) == "Untouched\n"
    both = annotate(
        spark,
        "one two one",
        [("one", "A", "x", False), ("", "B", "y", False), ("two", "C", "z", False), ("one", "D", "w", False)],
        [("d", 1, 2, "F", "second"), ("d", 1, 1, "E", "first"), ("d", 2, 1, "G", "re")],
    )
    assert both == (
        "one[^c4][^c1] two[^c3] one\n\n"
        "[^c1]: **A**: x\n    - **E**: first\n    - **F**: second\n[^c3]: **C**: z\n[^c4]: **D**: w\n\n"
        "## Comments\n\n- **B**: y\n  - **G**: re\n"
    )


def test_comment_threads(spark):
    comments = spark.createDataFrame(
        [("f", 1, "A", "open", None, None), ("f", 2, None, "done", "q", True)],
        "file_id string, comment_id int, author string, content string, anchor string, resolved boolean",
    )
    replies = spark.createDataFrame([(1, "t1"), (1, "t2")], "comment_id int, created string")
    kept = aggregates.comment_threads(comments, replies).collect()
    assert [(r.comment_id, r.n_replies, r.last_reply) for r in kept] == [(1, 2, "t2")]
    everything = {r.comment_id: r.author for r in aggregates.comment_threads(comments, replies, True).collect()}
    assert everything == {1: "A", 2: "Unknown"}
    assert tuple(aggregates.comment_share(comments).first()) == ("f", 2, 1, 0.5)


def test_nested_document(spark):
    schema = entity_schema("document")
    text = lambda t: {"elements": [{"textRun": {"content": t}}, {"textRun": None}, {"textRun": {"content": "!"}}]}
    cell = lambda t, s: {"startIndex": s, "endIndex": s + 5, "content": [{"paragraph": text(t)}, {"paragraph": text(" z\n")}]}
    content = [
        {"endIndex": 1, "sectionBreak": {}},
        {"startIndex": 1, "endIndex": 9, "paragraph": text("hello")},
        {"startIndex": 9, "endIndex": 10},
        {"startIndex": 10, "endIndex": 50, "table": {"tableRows": [{"tableCells": [cell("a", 11), cell("b", 16)]}, {"tableCells": [cell("c", 21)]}]}},
        {"startIndex": 50, "endIndex": 51, "table": {"tableRows": []}},
        {"startIndex": 51, "endIndex": 60, "tableOfContents": {}},
    ]
    raw = json.dumps({"doc_id": "d", "content": content})
    docs = spark.createDataFrame([(raw,)], "j string").select(F.from_json("j", schema).alias("d")).select("d.*")
    flat = [(r.pos, r.type, r.start_index, r.text, r.n_rows, r.n_cols) for r in nested.flatten_document(docs).collect()]
    assert flat == [
        (0, "section_break", 0, None, None, None),
        (1, "paragraph", 1, "hello!", None, None),
        (3, "table", 10, None, 2, 2),
        (4, "table", 50, None, 0, 0),
        (5, "table_of_contents", 51, None, None, None),
    ]
    cells = [tuple(r)[1:6] for r in nested.document_cells(docs).collect()]
    assert cells == [(0, 0, 0, "a! z\n!", 11), (0, 0, 1, "b! z\n!", 16), (0, 1, 0, "c! z\n!", 21)]


def test_first_table(spark):
    cells = spark.createDataFrame([("d", 0, "x"), ("d", 2, "Total"), ("d", 1, "total")], "doc_id string, table_idx int, text string")
    assert windows.find_first_table(cells, "TOTAL").first().table_idx == 1
    assert windows.find_first_table(cells, "Total", match_case=True).first().table_idx == 2


def test_slides(spark):
    schema = entity_schema("slide")
    piece = lambda at, t: {"startIndex": at, "textRun": {"content": t} if t is not None else None}
    shape = lambda *p: {"shape": {"text": {"textElements": list(p)}}}
    slide = {
        "objectId": "s",
        "pageElements": [
            shape(piece(5, "world\n\n"), piece(None, "hello "), piece(3, None)), {"table": {"rows": 1}}, {"line": {}}, {}, shape(), shape(piece(0, " \n")),
        ],
    }
    df = spark.createDataFrame([(json.dumps(slide),)], "j string").select(F.from_json("j", schema).alias("s")).select("s.*")
    assert nested.slide_text(df).first().text == "hello world"
    kinds = {r.kind: r.n_elements for r in nested.slide_elements(df).collect()}
    assert kinds == {"shape": 3, "table": 1, "line": 1, "unknown": 1}


def test_tabs(spark):
    docs = spark.createDataFrame([("d", "Main\n"), ("e", " ")], "doc_id string, text string")
    tabs = spark.createDataFrame(
        [("d", "t1", None, 1, "One", "1\n"), ("d", "t3", "t1", 2, "Kid b", "3\n"), ("d", "t2", "t1", 1, "Kid a", "2\n"), ("d", "t0", None, 0, "Zero", None)],
        "doc_id string, tab_id string, parent_id string, pos int, title string, text string",
    )
    got = {r.doc_id: r.text for r in trees.document_tabs_text(docs, tabs).collect()}
    assert got == {
        "d": "Main\n\n--- TAB: Zero ---\n\n--- TAB: One ---\n1\n"
        "\n--- TAB:     Kid a ( ID: t2) ---\n2\n\n--- TAB:     Kid b ( ID: t3) ---\n3\n"
    }


def test_delimited(spark):
    blobs = spark.createDataFrame(
        [(1, "a\tb, c\nd\n"), (2, "a,b\nc,,d"), (3, "  a  b\nc "), (4, "x\n\ny")], "id int, text string"
    )
    got = {}
    for r in read_delimited_tables(blobs, "id").collect():
        got.setdefault(r.id, {})[r.row, r.col] = r.value
    assert got[1] == {(0, 0): "a", (0, 1): "b, c", (1, 0): "d"}
    assert got[2] == {(0, 0): "a", (0, 1): "b", (1, 0): "c", (1, 1): "", (1, 2): "d"}
    assert got[3] == {(0, 0): "a", (0, 1): "b", (1, 0): "c"}
    assert got[4] == {(0, 0): "x", (2, 0): "y"}


def test_grid(spark):
    blocks = spark.createDataFrame(
        [("My sheet", 2, 26, [["a", None], None, ["b", "c"]]), ("S", None, None, [["z"]])],
        "title string, start_row int, start_col int, rows array<array<string>>",
    )
    got = {r.address: r.value for r in flatten_grid(blocks).collect()}
    assert got == {"'My sheet'!AA3": "a", "'My sheet'!AA5": "b", "'My sheet'!AB5": "c", "S!A1": "z"}


def test_rows_and_tables(spark):
    rows = spark.createDataFrame(
        [
            ("short", 0, ["a", "b"]), ("short", 1, ["c"]), ("short", 2, ["d", "e", "f"]), ("ok", 0, ["a"]), ("hole", 0, ["a", None]),
            ("gap", 0, []), ("gap", 1, ["x"]), ("wide", 0, ["x"] * 21), ("none", None, None),
        ]
        + [("tall", i, ["x"]) for i in range(1001)],
        "table_id string, row_idx int, cells array<string>",
    )
    reasons = {r.table_id: r.reason for r in aggregates.profile_table(rows).collect()}
    assert reasons == {
        "short": "ragged rows", "ok": None, "hole": "null cell", "gap": "empty rows", "wide": "too many columns",
        "none": "empty table", "tall": "too many rows",
    }
    padded = nested.rectangularise(rows.filter("table_id = 'short'")).orderBy("row_idx").collect()
    assert [r.cells for r in padded] == [["a", "b"], ["c", ""], ["d", "e", "f"]]


def test_links_of_cells(spark):
    df = spark.createDataFrame(
        [("S", 0, 0, "u1", ["u2", "u1", "", "u2"]), ("S", 1, 0, None, None), ("S", 2, 0, "", ["u3"])],
        "title string, row int, col int, link string, run_links array<string>",
    )
    got = [(r.cell, r.url) for r in nested.cell_hyperlinks(df).collect()]
    assert got == [("S!A1", "u1"), ("S!A1", "u2"), ("S!A3", "u3")]


def test_gradient(spark):
    cells = spark.createDataFrame([(1, r, 0, str(v)) for r, v in enumerate([0, 50, 100, "x"])], "sheet_id long, row long, col int, value string")

    def colors(*points):
        rules = spark.createDataFrame(
            [(0, 1, None, None, None, None, list(points))],
            "rule_idx int, sheet_id long, r0 long, r1 long, c0 int, c1 int, points array<struct<type:string,value:string,color:string>>",
        )
        return [r.color for r in aggregates.gradient_points(cells, rules).orderBy("row").collect()]

    assert colors(("MIN", None, "#000000"), ("MAX", None, "#C8C8C8")) == ["#000000", "#646464", "#C8C8C8"]
    assert colors(("MIN", None, "#000000"), ("PERCENTILE", "50", "#0000FF"), ("MAX", None, "#FFFFFF")) == ["#000000", "#0000FF", "#FFFFFF"]
    assert colors(("NUMBER", "10", "#000000"), ("PERCENT", "60", "#0A0A0A")) == ["#000000", "#080808", "#0A0A0A"]
    assert colors(("NUMBER", "50", "#000000"), ("NUMBER", "50", "#FFFFFF")) == ["#000000", "#000000", "#FFFFFF"]


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 1000])
def test_numbers_do_not_depend_on_the_chunks(spark, monkeypatch, rows):
    rng = random.Random(rows)
    kinds, data = ["item", "item", "item", "plain", "blank", "table", "other"], []
    for doc in range(6):
        for pos in range(60):
            kind = rng.choice(kinds)
            data.append((doc, pos, {"table": "table", "other": "sectionBreak"}.get(kind, "paragraph"), "" if kind == "blank" else "x", rng.choice(["a", "b"]) if kind == "item" else None, rng.choice([0, 1, None]), rng.random() < 0.8))
    want = {}
    for doc in range(6):
        counts, previous = {}, False
        for d, pos, kind, text, list_id, nesting, ordered in data:
            if d != doc or kind == "sectionBreak":
                continue
            blank = kind == "paragraph" and text == ""
            item = kind == "paragraph" and not blank and list_id is not None
            resets = not blank and not item and previous
            if resets:
                counts = {}
            key = (list_id, nesting or 0)
            if item and ordered:
                counts[key] = counts.get(key, 0) + 1
            want[doc, pos] = (resets, counts[key] if item and ordered else None)
            previous = item
    df = spark.createDataFrame(data, "doc_id int, pos long, type string, text string, list_id string, nesting int, ordered boolean")
    monkeypatch.setattr(windows, "by_position", lambda column: F.floor(F.col(column) / rows))
    got = {(r.doc_id, r.pos): (r.resets, r.item_no) for r in windows.list_numbering(df).collect()}
    assert got == want
