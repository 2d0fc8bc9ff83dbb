"""Records that are easily lost: empty sides, unknown keys, odd spellings."""

import base64

import pytest
from pyspark.sql import functions as F

from deskmill.functions.addresses import column_letters
from deskmill.functions.text import visible_text
from deskmill.operators import aggregates, filters, joins, nested, trees


def test_a_message_without_a_readable_part_stays(spark):
    data = base64.urlsafe_b64encode(b"hello").decode()
    parts = spark.createDataFrame(
        [(1, 0, 0, "image/png", data), (2, 1, 0, "text/plain", data), (2, 1, 1, "image/png", data)],
        "msg_id long, depth int, pos int, mime string, data string",
    )
    found = {r.msg_id: (r.text, r.html) for r in nested.select_bodies(parts).collect()}
    assert found == {1: ("", ""), 2: ("hello", "")}


def test_an_event_without_attendees_stays(spark):
    kind = "event_id string, attendees array<struct<email:string,responseStatus:string,optional:boolean,organizer:boolean>>"
    events = spark.createDataFrame([("a", []), ("b", None), ("c", [("x@y", None, None, True), (None, "accepted", None, None)])], kind)
    found = {r.event_id: (r.n_attendees, r.n_unknown, r.n_accepted, r.n_organizers) for r in nested.attendee_responses(events).collect()}
    assert found == {"a": (0, 0, 0, 0), "b": (0, 0, 0, 0), "c": (1, 1, 0, 1)}
    assert nested.attendee_rows(events).count() == 1


def test_documents_without_known_elements_have_zeros(spark):
    elements = spark.createDataFrame([(1, 0, "odd", 5, None, None)], "doc_id long, pos int, type string, end_index int, n_rows int, n_cols int")
    docs = spark.createDataFrame([(1,), (2,)], "doc_id long")
    found = {r.doc_id: (r.n_elements, r.n_tables, r.total_length) for r in aggregates.document_stats(elements, docs=docs).collect()}
    assert found == {1: (0, 0, None), 2: (0, 0, None)}


def test_nodes_below_an_unknown_parent_are_unreached(spark):
    nodes = spark.createDataFrame([("a", None, "1"), ("b", "a", "2"), ("c", "zz", "3"), ("d", "c", "4")], "id string, parent string, sibling string")
    found = {r.id: (r.root, r.depth) for r in trees.resolve_roots(nodes).collect()}
    assert found == {"a": ("a", 0), "b": ("a", 1), "c": (None, None), "d": (None, None)}
    assert {r.id: (r.place, r.n_below) for r in trees.tour(nodes).collect()} == {"a": (1, 1), "b": (2, 0), "c": (None, None), "d": (None, None)}


def test_tabs_of_an_unknown_parent_come_last(spark):
    docs = spark.createDataFrame([(1, "body")], "doc_id long, text string")
    tabs = spark.createDataFrame(
        [(1, 1, None, 0, "A", "one"), (1, 2, 9, 0, "B", "two")], "doc_id long, tab_id long, parent_id long, pos int, title string, text string"
    )
    (row,) = trees.document_tabs_text(docs, tabs).collect()
    assert row.text == "body\n--- TAB: A ---\none\n--- TAB: B ---\ntwo"


def test_comments_without_author_or_document_stay(spark):
    docs = spark.createDataFrame([(1, "some text here")], "doc_id long, text string")
    comments = spark.createDataFrame(
        [(1, 1, "text", None, None, False), (2, 1, "text", "x", "y", False)],
        "doc_id long, comment_no int, anchor string, author string, content string, resolved boolean",
    )
    assert {(r.doc_id, r.at) for r in joins.anchor_comments(docs, comments).collect()} == {(1, 6), (2, None)}
    (row,) = joins.annotate_documents(docs, comments).collect()
    assert "[^c1]: **Unknown**: " in row[1]


def test_error_tokens_between_any_white_space(spark):
    rows = spark.createDataFrame([("\t#REF!\n",), (" #n/a",), ("#",), ("x",), (None,)], "value string")
    assert [r[0] for r in rows.select(filters.is_error_token(F.col("value"))).collect()] == [True, True, False, False, False]


def test_case_is_ignored_beyond_ascii(spark):
    docs = spark.createDataFrame([("un ÉTÉ et un été",)], "text string")
    assert aggregates.find_replace(docs, "été", "an").first()["n_replaced"] == 2


@pytest.mark.parametrize(
    "tag",
    [
        '<meta property="og:type" content="article">',
        "<meta content='article' property='og:type' />",
        "<META name=x property=og:type content=article>",
    ],
)
def test_page_properties_in_any_spelling(spark, tag):
    pages = spark.createDataFrame([(1, "http://a.b/", f"<head>{tag}</head>")], "page_id long, url string, html string")
    assert nested.page_metadata(pages).first()["og_type"] == "article"


def test_entities_are_decoded_once(spark):
    rows = spark.createDataFrame([("<p>caf&eacute; &#8364;&#x41; &amp;lt; &nope; &#xD800; a & b</p>",), (None,)], "html string")
    assert [r[0] for r in rows.select(visible_text(F.col("html"))).collect()] == ["café €A &lt; &nope; &#xD800; a & b", None]


def test_unknown_keys_are_no_unchanged_ones(spark):
    current = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    asked = spark.createDataFrame([(1, "x"), (2, "b"), (3, "c")], "id long, name string")
    changes = joins.change_report(current, asked, "id", ["name"])
    assert {r.field: r.n_changes for r in joins.change_counts(changes, asked, "id", current).collect()} == {"name": 1, "(none)": 1}


def test_repeated_patches_do_not_multiply_rows(spark):
    base = spark.createDataFrame([(1, "a", "p"), (2, "b", "q")], "id long, name string, phone string")
    patch = spark.createDataFrame([(1, "x", None, 1), (1, None, "r", 2), (1, "y", None, 3)], "id long, name string, phone string, v int")
    found = sorted(map(tuple, joins.patch_merge(base, patch, "id", ["name", "phone"], version="v").collect()))
    assert found == [(1, "y", "r"), (2, "b", "q")]
    with pytest.raises(Exception, match="several updates of id 1"):
        joins.patch_merge(base, patch, "id", ["name", "phone"]).collect()


def test_the_used_range_names_its_corner(spark):
    cells = spark.createDataFrame([(1, 1, 2, "x"), (1, 3, 1, "y")], "sheet_id long, row int, col int, value string")
    found = aggregates.used_range(cells).first()
    assert (found["start"], found["label"]) == ("B2", "B2:C4")


def test_columns_beyond_three_letters_have_names(spark):
    rows = spark.range(0, 1).select(F.explode(F.array(*[F.lit(i) for i in (0, 25, 26, 701, 702, 18277, 18278, -1)])).alias("i"))
    assert [r[0] for r in rows.select(column_letters(F.col("i"))).collect()] == ["A", "Z", "AA", "ZZ", "AAA", "ZZZ", "AAAA", None]
