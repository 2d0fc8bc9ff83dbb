"""Literal cases for mail, contacts, chat, forms, sharing, files and grants."""

import pytest
from pyspark.sql import functions as F

from deskmill.functions import addresses, colors
from deskmill.functions.scopes import PREFIX
from deskmill.functions.sharing import permission_sentence
from deskmill.functions.text import decode_base64url, encode_base64url, host, id_from_url, stripped, with_prefix
from deskmill.functions.times import instant, is_rfc3339, start_instant
from deskmill.operators import aggregates, filters, joins, nested, paging
from deskmill.sources.exports import entity_schema


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


# ---- helpers ----------------------------------------------------------------------------------


def test_column_letters(spark):
    cases = {0: "A", 25: "Z", 26: "AA", 51: "AZ", 52: "BA", 701: "ZZ", 702: "AAA", 18277: "ZZZ", -1: None}
    df = spark.createDataFrame([(k,) for k in cases], "i long")
    letters = {r.i: r.x for r in df.select("i", addresses.column_letters(F.col("i")).alias("x")).collect()}
    assert letters == cases
    for index, name in cases.items():
        if name:
            assert one(spark, addresses.column_index(F.lit(name.lower()))) == index


def test_labels(spark):
    lit = F.lit
    assert one(spark, addresses.cell_address(lit("Bob's sheet"), lit(2), lit(1))) == "'Bob''s sheet'!B3"
    for text, want in (
        ("Sheet1!A1:B2", ("Sheet1", 0, 2, 0, 2, True)),
        ("'My Sheet'!$A$1:$B$10", ("My Sheet", 0, 10, 0, 2, True)),
        ("'Bob''s!'!C:D", ("Bob's!", None, None, 2, 4, True)),
        ("b2", (None, 1, 2, 1, 2, True)),
        ("2:5", (None, 1, 5, None, None, True)),
        ("S!", ("S", None, None, None, None, False)),
        ("A1:", (None, None, None, None, None, False)),
        ("A1B", (None, None, None, None, None, False)),
        ("", (None, None, None, None, None, False)),
    ):
        assert tuple(one(spark, addresses.range_bounds(lit(text)))) == want, text
    assert one(spark, addresses.cell_address(lit("Data_1"), lit(0), lit(0))) == "Data_1!A1"
    assert one(spark, addresses.range_label(lit(1), lit(1), lit(1), lit(1))) == "B2"
    assert one(spark, addresses.range_label(lit(1), lit(1), lit(9), lit(3))) == "B2:D10"


def test_colors(spark):
    assert one(spark, colors.channel(F.lit("#FF8000"), 0)) == 1.0
    assert one(spark, colors.channel(F.lit("FF8000"), 2)) == 0.0
    assert one(spark, colors.channel(F.lit("red"), 0)) is None
    assert one(spark, colors.hex_color(F.lit(1.7), F.lit(None).cast("double"), F.lit(0.5))) == "#FF0080"


def test_text_helpers(spark):
    text = "héllo <>?~ wörld"
    assert one(spark, decode_base64url(encode_base64url(F.lit(text)))) == text
    assert one(spark, decode_base64url(F.lit("aGk="))) == "hi"
    assert one(spark, decode_base64url(F.lit("!!"))) is None
    assert one(spark, stripped(F.lit(" \n a b \t "))) == "a b"
    assert one(spark, id_from_url(F.lit("https://x.example/document/d/aB_-9/edit"))) == "aB_-9"
    assert one(spark, host(F.lit("HTTPS://A.Example.com:8080/x?y#z"))) == "a.example.com"
    assert one(spark, with_prefix(F.lit("c1"), "people/")) == "people/c1"


def test_times(spark):
    for good in ("2025-01-15T00:00:00Z", "2025-01-15T00:00:00.5+02:00"):
        assert one(spark, is_rfc3339(F.lit(good)))
    for bad in ("2025-01-15", "2025-01-15T00:00:00", "x2025-01-15T00:00:00Z"):
        assert not one(spark, is_rfc3339(F.lit(bad)))
    assert str(one(spark, instant(F.lit("2025-01-15T01:00:00+01:00")))) == "2025-01-15 00:00:00"
    assert str(one(spark, instant(F.lit("2025-01-15")))) == "2025-01-15 00:00:00"
    assert one(spark, instant(F.lit("soon"))) is None
    day = F.struct(F.lit(None).cast("string").alias("dateTime"), F.lit("2025-02-01").alias("date"))
    assert str(one(spark, start_instant(day))) == "2025-02-01 00:00:00"


# ---- mail -------------------------------------------------------------------------------------


def body(spark, text, html):
    df = spark.createDataFrame([(text, html)], "text string, html string")
    r = nested.choose_body(df).first()
    return r.choice, r.content


def test_choose_body(spark):
    assert body(spark, "plain", "<p>x</p>") == ("text", "plain")
    assert body(spark, " \n", "<p>a &amp; b</p>") == ("html", "a & b")
    assert body(spark, "see <!-- x -->", "<b>h</b>") == ("html", "h")
    assert body(spark, "x", "<p>" + "y" * 60 + "</p>") == ("html", "y" * 60)
    assert body(spark, "x", "y" * 50) == ("text", "x")
    assert body(spark, None, None) == ("none", "[No readable content found]")
    long = body(spark, "", "z" * 20001)[1]
    assert long == "z" * 20000 + "\n\n[Content truncated...]"


def test_visible_text(spark):
    html = "<title>T</title><style>p{}</style><script>var a='</p>';</script><!-- c --><p>a&nbsp;\n b</p>&lt;i&gt; &amp;lt;"
    assert body(spark, "", html)[1] == "Ta b<i> &lt;"


def test_select_bodies(spark):
    enc = encode_base64url
    parts = spark.createDataFrame(
        [
            ("m", 0, 0, "text/plain", "outer"),
            ("m", 1, 0, "text/plain", ""),
            ("m", 2, 0, "text/plain", "deep"),
            ("m", 1, 1, "text/html", "first html"),
            ("m", 1, 2, "text/html", "second html"),
            ("single", 0, 0, "text/plain", "only"),
        ],
        "msg_id string, depth int, pos int, mime string, body string",
    ).withColumn("data", enc(F.col("body")))
    got = {r.msg_id: (r.text, r.html) for r in nested.select_bodies(parts).collect()}
    assert got == {"m": ("deep", "first html"), "single": ("only", "")}


def test_headers(spark):
    headers = spark.createDataFrame(
        [("m", 0, "Subject", "one"), ("m", 1, "SUBJECT", "two"), ("m", 2, "X", "y")],
        "msg_id string, pos int, name string, value string",
    )
    assert nested.pivot_headers(headers, ["Subject", "From"]).first().asDict() == {
        "msg_id": "m", "Subject": "two", "From": None,
    }
    assert nested.pivot_headers(headers, ["Subject"], exact_case=True).first().Subject == "one"


def test_rules(spark):
    mail = spark.createDataFrame(
        [("a", "Ann@x", "me@y", "Invoice 7", "please pay", True, False, 10), ("b", "bob@x", "me@y", "hi", "lunch", False, True, 99)],
        "message_id string, sender string, recipients string, subject string, text string, "
        "has_attachment boolean, is_chat boolean, size long",
    )

    def hits(**criteria):
        got = joins.apply_filter_rules(mail, [{"rule_id": "r", **criteria}])
        return sorted(r.message_id for r in got.collect() if r.rule_ids)

    assert hits() == ["a", "b"]
    assert hits(**{"from": "ann"}) == ["a"]
    assert hits(query="INVOICE") == ["a"] and hits(query="lunch") == ["b"]
    assert hits(negated_query="pay") == ["b"]
    assert hits(has_attachment=True) == ["a"] and hits(has_attachment=False) == ["a", "b"]
    assert hits(exclude_chats=True) == ["a"]
    assert hits(size=50, size_comparison="larger") == ["b"] and hits(size=50, size_comparison="smaller") == ["a"]
    assert hits(**{"from": "ann"}, query="lunch") == []


def test_label_changes(spark):
    items = spark.createDataFrame([("1", ["INBOX", "x"]), ("2", ["INBOX"]), ("3", None)], "id string, labels array<string>")
    changes = spark.createDataFrame(
        [("1", ["y", "z"], ["INBOX", "z"]), ("3", ["a"], None)], "id string, add array<string>, remove array<string>"
    )
    got = {r.id: r.labels for r in joins.apply_label_changes(items, changes).collect()}
    assert got == {"1": ["x", "y"], "2": ["INBOX"], "3": ["a"]}


# ---- contacts ---------------------------------------------------------------------------------


def contact(spark, **fields):
    row = {f.name: fields.get(f.name) for f in entity_schema("person")}
    df = spark.createDataFrame([row], entity_schema("person"))
    return nested.flatten_contacts(df).first()


def test_contacts(spark):
    assert contact(spark, resourceName="people/c1234567890").contact_id == "c1234567890"
    assert contact(spark).contact_id == "Unknown"
    for org, want in (
        ({"name": "Acme Corp", "title": "Engineer"}, "Engineer at Acme Corp"),
        ({"name": "Acme Corp"}, "at Acme Corp"),
        ({"title": "CEO"}, "CEO"),
    ):
        full = {"name": None, "title": None, **org}
        assert contact(spark, organizations=[full]).organization == want
    assert contact(spark, birthdays=[{"date": {"year": 1990, "month": 5, "day": 15}}]).birthday == "1990/5/15"
    assert contact(spark, birthdays=[{"date": {"year": None, "month": 5, "day": 15}}]).birthday == "5/15"
    sources = contact(spark, metadata={"sources": [{"type": "CONTACT"}, {"type": None}, {"type": "PROFILE"}]}).sources
    assert sources == "CONTACT, , PROFILE" and contact(spark).sources is None
    assert contact(spark, biographies=[{"value": "n" * 300}]).notes == "n" * 200 + "..."
    mails = contact(spark, emailAddresses=[{"value": "a@x"}, {"value": ""}, {"value": "b@x"}])
    assert mails.email == "a@x, b@x" and mails.phone is None


def test_masked_update(spark):
    base = spark.createDataFrame(
        [("1", "e", "n1", "p1", "o1"), ("2", "e", "n2", "p2", "o2"), ("3", None, "n3", "p3", "o3")],
        "id string, etag string, name string, phone string, org string",
    )
    updates = spark.createDataFrame(
        [("1", "new", None, None), ("2", None, "555", None), ("3", "x", "x", "x"), ("9", "x", None, None), ("1x", None, None, None)],
        "id string, name string, phone string, org string",
    )
    got = {r.id: tuple(r)[2:] for r in joins.masked_batch_update(base, updates, "id", "etag", ["name", "phone", "org"]).collect()}
    assert got == {
        "1": ("new", None, "o1", True), "2": (None, "555", "o2", True), "3": ("n3", "p3", "o3", False),
    }


def test_group_members(spark):
    groups = spark.createDataFrame([("g", 2), ("empty", 0)], "group_id string, member_count int")
    members = spark.createDataFrame([("g", "people/1"), ("g", "people/2"), ("g", "people/3")], "group_id string, member string")
    people = spark.createDataFrame([("people/1", "Ann"), ("people/3", "Cy")], "resource_name string, display_name string")
    counts = {r.group_id: (r.n_members, r.n_resolved) for r in joins.group_member_counts(groups, members, people).collect()}
    assert counts == {"g": (3, 2), "empty": (0, 0)}
    assert joins.group_members(members, people, max_members=2).count() == 2


# ---- chat, forms ------------------------------------------------------------------------------


def test_chat(spark):
    schema = entity_schema("chat_message")
    blank = {f.name: None for f in schema}
    link = lambda kind, uri: {"type": kind, "richLinkMetadata": {"uri": uri}}
    rows = [
        {
            **blank, "space": "s", "name": "m1", "text": "see http://a",
            "annotations": [link("RICH_LINK", "http://a"), link("RICH_LINK", "http://b"), link("X", "http://c")],
            "attachment": [
                {"name": "n", "contentName": "image.png", "contentType": "image/png", "source": None},
                {"name": "n", "contentName": None, "contentType": None, "source": None},
            ],
            "emojiReactionSummaries": [
                {"emoji": {"unicode": "👍", "customEmoji": None}, "reactionCount": 2},
                {"emoji": {"unicode": None, "customEmoji": {"uid": "u1"}}, "reactionCount": 1},
            ],
        },
        {**blank, "space": "s", "name": "m2"},
    ]
    df = spark.createDataFrame(rows, schema)
    assert [r.uri for r in nested.rich_links(df).collect()] == ["http://b"]
    found = [tuple(r)[1:] for r in nested.message_attachments(df).collect()]
    assert found == [(0, "image.png", "image/png"), (1, "unnamed", "unknown type")]
    assert {(r.symbol, r.n_reactions) for r in nested.reaction_totals(df).collect()} == {("👍", 2), (":u1:", 1)}


def test_senders(spark):
    people = spark.createDataFrame(
        [("people/1", "Ann", "a@x"), ("people/2", None, "b@x"), ("people/3", None, None)],
        "resource_name string, display_name string, email string",
    )
    messages = spark.createDataFrame(
        [(1, "users/1", "Own"), (2, "users/1", None), (3, "users/2", ""), (4, "users/3", None), (5, "users/9", None), (6, None, None), (7, "", None)],
        "n int, sender_id string, sender_name string",
    )
    got = {r.n: r.sender for r in joins.resolve_senders(messages, people).collect()}
    assert got == {1: "Own", 2: "Ann", 3: "b@x", 4: "users/3", 5: "users/9", 6: "Unknown Sender", 7: "Unknown Sender"}


def test_search_in_spaces(spark):
    spaces = spark.createDataFrame([(f"s{i:02d}", f"General {i}") for i in range(15)], "space string, space_name string")
    messages = spark.createDataFrame(
        [(f"s{i:02d}", j, j, ("Report " if j % 2 else "other ") + "x" * 150) for i in range(15) for j in range(30)],
        "space string, message_id int, create_time int, text string",
    )
    got = paging.top_per_group(messages, spaces, "report").collect()
    assert len(got) == 50 and {r.space for r in got} == {f"s{i:02d}" for i in range(10)}
    assert sorted(r.message_id for r in got if r.space == "s00") == [21, 23, 25, 27, 29]
    assert all(len(r.text) == 103 and r.text.endswith("...") for r in got)


def test_forms(spark):
    responses = spark.createDataFrame(
        [("f", "1", {"q1": ["a", "b"], "q2": []}), ("f", "2", {}), ("f", "3", None)],
        "form_id string, response_id string, answers map<string,array<string>>",
    )
    questions = spark.createDataFrame([("f", "q1", True), ("f", "q2", True)], "form_id string, question_id string, required boolean")
    long = {(r.response_id, r.question_id): r.answer for r in nested.form_answers_long(responses).collect()}
    assert long == {("1", "q1"): "a, b", ("1", "q2"): "No answer provided"}
    wide = {r.response_id: (r.q1, r.q2) for r in nested.form_answers_wide(responses, ["q1", "q2"]).collect()}
    assert wide == {"1": ("a, b", "No answer provided"), "2": (None, None), "3": (None, None)}
    counts = {r.response_id: (r.n_answers, r.n_required_missing) for r in aggregates.form_response_counts(responses, questions).collect()}
    assert counts == {"1": (2, 1), "2": (0, 2), "3": (0, 2)}
    rates = {r.question_id: (r.n_answered, r.answered_rate) for r in aggregates.question_rates(responses, questions).collect()}
    assert rates == {"q1": (1, 0.333333), "q2": (0, 0.0)}


# ---- sharing, files, grants -------------------------------------------------------------------


def test_share_checks_stop_at_the_first(spark):
    rows = [
        (None, None, None, None, None, "missing email"),
        ("a@x", None, None, None, None, None),
        ("a@x", None, None, "domain", None, "missing domain"),
        (None, "x.org", "owner", "domain", "bad", "invalid role"),
        ("a@x", None, "writer", "team", "bad", "invalid share_type"),
        ("a@x", None, "writer", "user", "2025-01-15", "invalid expiration_time"),
        ("a@x", None, "writer", "anyone", "", None),
        ("a@x", None, "commenter", "group", "2025-01-15T00:00:00Z", None),
    ]
    df = spark.createDataFrame(
        rows, "email string, domain string, role string, share_type string, expiration_time string, want string"
    )
    assert all(r.reason == r.want for r in filters.validate_shares(df).collect())
    accepted, rejected = filters.split_shares(df)
    assert (accepted.count(), rejected.count()) == (3, 5)


def test_public_files(spark):
    schema = "id int, name string, owner string, permissions array<struct<type:string,role:string>>"
    rows = [
        (1, "n", "o", [("anyone", "reader")]), (2, "n", "o", [("anyone", "owner"), ("user", "writer")]), (3, "m", "o", None),
    ]
    files = spark.createDataFrame(rows, schema)
    assert filters.publicly_shared(files, ["owner"]).first().n_public == 1
    names = spark.createDataFrame([("n",), ("none",)], "name string")
    got = {r.name: (r.n_files, r.id, r.public) for r in joins.files_by_name(files, names).collect()}
    assert got == {"n": (2, 1, True), "none": (0, None, None)}


def test_permission_sentence(spark):
    schema = entity_schema("file")["permissions"].dataType.elementType
    base = {f.name: None for f in schema}
    rows = [
        ({**base, "type": "user", "role": "writer", "id": "1", "emailAddress": "a@x"}, "User: a@x (writer) [id: 1]"),
        ({**base, "type": "anyone", "role": "reader"}, "Anyone with the link (reader) [id: ]"),
        ({**base, "type": "robot"}, "robot (unknown) [id: ]"),
        (
            {
                **base, "type": "domain", "role": "reader", "id": "d", "expirationTime": "T",
                "permissionDetails": [{"inherited": False, "inheritedFrom": "x"}, {"inherited": True, "inheritedFrom": "top"}],
            },
            "Domain: unknown (reader) [id: d] | expires: T, inherited from: top",
        ),
    ]
    for permission, want in rows:
        df = spark.createDataFrame([(permission,)], "p " + schema.simpleString())
        assert df.select(permission_sentence(F.col("p")).alias("x")).first().x == want


def test_shortcuts(spark):
    s, f = joins.SHORTCUT_TYPE, joins.FOLDER_TYPE
    rows = [("real", "text/plain", None), ("dir", f, None), ("none", s, None), ("blank", s, ""), ("lost", s, "gone"), ("loop", s, "loop")]
    rows += [("c1", s, "dir")] + [(f"c{i}", s, f"c{i - 1}") for i in range(2, 8)]
    files = spark.createDataFrame(rows, "id string, mime_type string, target_id string")
    got = {r.id: (r.resolved_id, r.hops, r.error) for r in joins.resolve_shortcuts(files).collect()}
    assert got["real"] == ("real", 0, None)
    assert got["none"] == got["blank"] == (None, 0, "missing target")
    assert got["lost"] == (None, 1, "not found")
    assert got["loop"] == (None, 5, "too many hops")
    assert got["c1"] == ("dir", 1, None) and got["c5"] == ("dir", 5, None)
    assert got["c6"][2] == got["c7"][2] == "too many hops"
    folders = {r.id: r.error for r in joins.resolve_shortcuts(files, folders_only=True).collect()}
    assert folders["real"] == "not a folder" and folders["c1"] is None


def test_classify(spark):
    rows = [
        ("a.md", "", "text/markdown"), ("a.MARKDOWN", "", "text/markdown"), ("a.tar.rtf", "", "application/rtf"),
        (".md", "x", "text/plain"), ("noext", "# t", "text/markdown"), ("a.xyz", "has ``` fence", "text/markdown"),
        ("a.xyz", "**b**", "text/markdown"), ("a.xyz", None, "text/plain"),
    ]
    df = spark.createDataFrame(rows, "name string, text string, want string")
    assert [r.want for r in nested.classify_files(df).collect()] == [r[2] for r in rows]
    assert all(r.mime_type == r.want for r in nested.classify_files(df).collect())


@pytest.mark.parametrize(
    ("granted", "required", "passes"),
    [
        (["gmail.readonly"], ["gmail.readonly"], True),
        (["gmail.readonly"], ["gmail.send"], False),
        ([], ["gmail.readonly"], False),
        (["gmail.readonly"], [], True),
        ([], [], True),
        (["gmail.modify"], ["gmail.readonly", "gmail.send", "gmail.compose", "gmail.labels"], True),
        (["gmail.modify"], ["gmail.settings.basic"], False),
        (["gmail.readonly"], ["gmail.modify"], False),
        (["gmail.modify", "drive.file"], ["gmail.send", "drive.file"], True),
        (["gmail.modify", "drive.file"], ["gmail.send", "drive.readonly"], False),
    ],
)
def test_grants(spark, granted, required, passes):
    rows = lambda scopes: spark.createDataFrame([("u", PREFIX + s) for s in scopes], "user string, scope string")
    users = spark.createDataFrame([("u",)], "user string")
    assert joins.scope_check(users, rows(granted), rows(required)).first().passes is passes


def test_change_report(spark):
    schema = "id int, name string, description string, starred boolean"
    now = spark.createDataFrame([(1, "a", None, None), (2, "b", "", True), (3, "c", "d", False)], schema)
    asked = spark.createDataFrame([(1, "a", "", False), (2, None, None, True), (3, "C", "", None), (4, "x", None, None)], schema)
    changes = joins.change_report(now, asked, "id", ["name", "description", "starred"], ["description"])
    assert {tuple(r) for r in changes.collect()} == {
        (1, "starred", None, "false"), (3, "name", "c", "C"), (3, "description", "d", ""),
    }
    counts = {r.field: r.n_changes for r in joins.change_counts(changes, asked, "id").collect()}
    assert counts == {"starred": 1, "name": 1, "description": 1, "(none)": 2}


# ---- tasks, dates, sites, pages ---------------------------------------------------------------


def test_task_filter(spark):
    rows = [
        ("a", "needsAction", "2025-01-10", None, False, None, None), ("b", "completed", "2025-01-11", "2025-01-12", False, None, None),
        ("c", "needsAction", "2025-01-12", None, True, None, None), ("d", "needsAction", None, None, None, True, None),
        ("e", "needsAction", "2025-01-01", None, None, None, True),
    ]
    df = spark.createDataFrame(
        rows, "id string, status string, due string, completed string, deleted boolean, hidden boolean, assigned boolean"
    ).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("due", "completed")}).withColumn("updated", F.col("due"))
    ids = lambda **k: sorted(r.id for r in filters.filter_tasks(df, **k).collect())
    assert ids() == ["a", "b"]
    assert ids(show_completed=False) == ["a"]
    assert ids(show_deleted=True, show_hidden=True, show_assigned=True) == ["a", "b", "c", "d", "e"]
    assert ids(due_max="2025-01-11") == ["a", "b"] and ids(due_max="2025-01-10") == ["a"]
    assert ids(due_min="2025-01-11") == ["b"]
    assert ids(completed_min="2025-01-12", completed_max="2025-01-13") == ["b"]


def test_relative_dates(spark):
    df = spark.createDataFrame([("2025-02-28",), ("2025-02-20",), ("2024-03-01",)], "d string").select(
        F.col("d").cast("timestamp_ntz").alias("ts")
    )
    count = lambda spec: filters.relative_date(df, "ts", spec, "2025-03-01").count()
    assert [count(s) for s in ("d1", "w1", "m1", "y1")] == [1, 1, 2, 3]
    with pytest.raises(ValueError):
        count("h3")


def test_sites(spark):
    urls = ["http://example.com/a", "https://www.example.com", "http://badexample.com/", "http://a.org/example.com", "nonsense"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    table = spark.createDataFrame([("Example.com",), ("www.example.com",)], "site string")
    for sites in (["example.com", "www.example.com"], table):
        assert [r.url for r in filters.site_filter(df, "url", sites).orderBy("url").collect()] == sorted(urls[:2])
        kept = filters.site_filter(df, "url", sites, "exclude").collect()
        assert sorted(r.url for r in kept) == sorted(urls[2:])


def test_file_filter(spark):
    df = spark.createDataFrame(
        [(1, "Plan A", ["p"], True), (2, "plan b", ["q"], False)], "id int, name string, parents array<string>, starred boolean"
    )
    ids = lambda *c: [r.id for r in filters.filter_files(df, c).collect()]
    assert ids(("name", "contains", "Plan")) == [1]
    assert ids(("parents", "in", "q")) == [2]
    assert ids(("starred", "=", True), ("id", "<", 2)) == [1]
    assert ids() == [1, 2]
    with pytest.raises(ValueError):
        ids(("name", "~", "x"))
    assert [r.id for r in filters.fulltext_contains(df, ["name"], "PLAN").collect()] == [1, 2]


def test_error_tokens(spark):
    values = {"#REF!": True, " #name? ": True, "#n/a": True, "#": False, "#ERROR": False, "REF!": False, None: False}
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert {r.v: r.x for r in df.select("v", filters.is_error_token(F.col("v")).alias("x")).collect()} == values


def test_pages(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "id long")
    page = paging.page_after(df, "id", 3, 4).collect()
    assert [r.id for r in page] == [4, 5, 6, 7] and all(r.has_more for r in page)
    last = paging.page_after(df, "id", 5, 4).collect()
    assert [r.id for r in last] == [6, 7, 8, 9] and not any(r.has_more for r in last)
    assert paging.page_after(df, "id", None, 2).count() == 2
    assert [r.id for r in paging.page_positions(df, "id", 3, 2).collect()] == [2, 3]


def test_page_metadata(spark):
    html = '<meta property="og:type" content="article"><meta property="article:published_time" content="2024-05-06T07:08:09Z">'
    df = spark.createDataFrame([(1, "http://a.b/", html), (2, "http://a.b/x", "<p>")], "page_id int, url string, html string")
    got = {r.page_id: (r.host, r.og_type, r.published) for r in nested.page_metadata(df).collect()}
    assert got == {1: ("a.b", "article", "2024-05-06"), 2: ("a.b", None, None)}


def test_find_replace(spark):
    df = spark.createDataFrame([("a.b A.B axb",)], "text string")
    r = aggregates.find_replace(df, "a.b", "$0\\").first()
    assert (r.text, r.n_replaced) == ("$0\\ $0\\ axb", 2)
    assert aggregates.find_replace(df, "a.b", "", match_case=True).first().n_replaced == 1


def test_runs(spark):
    runs = spark.createDataFrame(
        [("f", "COMPLETED", "5s"), ("f", "COMPLETED", "1.5s"), ("f", "COMPLETED", "bad"), (None, None, None)],
        "function_name string, status string, duration string",
    )
    got = {(r.function_name, r.status): (r.n_runs, r.avg_seconds, r.p95_seconds) for r in aggregates.execution_status(runs).collect()}
    assert got == {("f", "COMPLETED"): (3, 3.25, 4.825), ("Unknown", "Unknown"): (1, None, None)}


def test_empty_buckets_are_zero(spark):
    runs = spark.createDataFrame(
        [("2024-01-01 10:00:00", 1, False), ("2024-01-03 10:00:00", 1, True), ("2024-01-15 00:00:00", 2, False)],
        "t string, user_id int, failed boolean",
    ).withColumn("ts", F.col("t").cast("timestamp_ntz"))
    days = sorted(tuple(r) for r in aggregates.execution_metrics(runs).collect())
    assert len(days) == 15 and sum(d[3] for d in days) == 3 and sum(d[4] for d in days) == 1
    weeks = sorted(tuple(r) for r in aggregates.execution_metrics(runs, "WEEKLY").collect())
    assert [str(w[0]) for w in weeks] == ["2024-01-01 00:00:00", "2024-01-08 00:00:00", "2024-01-15 00:00:00"]
    assert [w[3] for w in weeks] == [2, 0, 1]


def test_replies_and_outcomes(spark):
    replies = spark.createDataFrame([(1, "item_a"), (1, None), (1, "item_c")], "batch_id int, created_id string")
    assert tuple(aggregates.reply_summary(replies).first()) == (1, 3, 2)
    results = spark.createDataFrame([(1, None), (1, "bad"), (2, None)], "batch_id int, reason string")
    got = {(r.batch_id, r.outcome): (r.n_ok, r.n_failed, r.level) for r in aggregates.outcome_summary(results).collect()}
    assert got[1, None] == (1, 1, 1) and got[None, None] == (2, 1, 2) and got[1, "bad"] == (0, 1, 0)
