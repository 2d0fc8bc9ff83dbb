"""Registered queries of the joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskmill.functions.addresses import column_letters, range_bounds
from deskmill.functions.scopes import PREFIX
from deskmill.operators import intervals, joins, snapshots
from deskmill.plans import bindings as b
from deskmill.plans.shapes import chat_messages
from deskmill.sources.tables import read_table


def _text(column):
    return F.col(column).cast("string")


def _people(spark, d):
    k = F.col("c_custkey")
    return read_table(spark, d, "customer").select(
        F.concat(F.lit("people/"), _text("c_custkey")).alias("resource_name"),
        F.when(k % 3 != 0, F.col("c_name")).alias("display_name"),
        F.when(k % 6 != 0, F.concat(_text("c_custkey"), F.lit("@example.com"))).alias("email"),
    )


def _senders(spark, d):
    k = F.col("o_orderkey")
    messages = read_table(spark, d, "orders").select(
        k.alias("message_id"),
        F.when(k % 10 != 0, F.concat(F.lit("users/"), _text("o_custkey"))).alias("sender_id"),
        F.when(k % 4 == 0, F.concat(F.lit("Own "), _text("o_custkey"))).otherwise("").alias("sender_name"),
    )
    return joins.resolve_senders(messages, _people(spark, d))


def _search_hits(spark, d):
    turn = F.split_part("name", F.lit("/"), F.lit(2)).cast("bigint")
    messages = chat_messages(spark, d).select(
        F.split_part("name", F.lit("/"), F.lit(1)).cast("bigint").alias("space"), turn.alias("message_id"), turn.alias("create_time"),
        "text", "annotations", "attachment",
    )
    named = messages.withColumns(
        {
            "sender_id": F.concat(F.lit("users/"), _text("space")),
            "sender_name": F.when(F.col("message_id") % 2 == 0, F.concat(F.lit("Own "), _text("space"))),
        }
    )
    spaces = messages.select("space", F.concat(F.lit("Space "), _text("space")).alias("space_name")).distinct()
    return joins.search_hits(named, spaces, _people(spark, d), "LE").select(
        "space", "space_name", "message_id", "place", "text", "sender",
        F.array_join("links", " ").alias("links"), F.array_join("attachments", ", ").alias("attachments"),
    )


def _range_bounds(spark, d):
    """Order keys as texts of ranges: one cell, a rectangle, whole columns, whole rows, and none."""
    k = F.col("o_orderkey")
    row, col, kind = k % 1000, k % 800, k % 5
    label = lambda c, r="": F.concat(column_letters(col + c), (row + r + 1).cast("string") if r != "" else F.lit(""))
    area = (
        F.when(kind == 0, label(0, 0))
        .when(kind == 1, F.concat(label(0, 0), F.lit(":"), label(3, 10)))
        .when(kind == 2, F.concat(F.lit("$"), label(0), F.lit(":$"), label(2)))
        .when(kind == 3, F.concat((row + 1).cast("string"), F.lit(":"), (row + 5).cast("string")))
        .otherwise("A1 B2")
    )
    title = F.when(k % 3 == 1, F.concat(F.lit("S_"), k.cast("string"), F.lit("!"))).when(
        k % 3 == 2, F.concat(F.lit("'It''s "), k.cast("string"), F.lit("'!"))
    ).otherwise("")
    ranges = read_table(spark, d, "orders").select(k.alias("range_id"), range_bounds(F.concat(title, area)).alias("b"))
    return ranges.select("range_id", "b.*")


def _shortcuts(spark, d):
    k = F.col("p_partkey")
    files = read_table(spark, d, "part").select(
        k.alias("id"),
        F.when(k % 3 != 0, joins.SHORTCUT_TYPE)
        .when(F.col("p_size") > 25, joins.FOLDER_TYPE)
        .otherwise("text/plain")
        .alias("mime_type"),
        F.when(k % 50 == 7, F.lit(None))
        .when(k % 40 == 11, k)
        .when(k % 60 == 13, F.lit(-1))
        .otherwise(F.floor(k / 2))
        .alias("target_id"),
    )
    return joins.resolve_shortcuts(files, folders_only=True)


def _groups(spark, d):
    n = read_table(spark, d, "nation")
    groups = n.select(
        F.col("n_nationkey").alias("group_id"), F.col("n_name").alias("name"),
        (F.col("n_regionkey") + 60).alias("member_count"),
    )
    customers = read_table(spark, d, "customer")
    membership = customers.select(
        F.col("c_nationkey").alias("group_id"),
        F.concat(F.lit("people/"), F.lpad(_text("c_custkey"), 9, "0")).alias("member"),
    )
    people = customers.filter("c_acctbal > 0").select(
        F.concat(F.lit("people/"), F.lpad(_text("c_custkey"), 9, "0")).alias("resource_name"),
        F.col("c_name").alias("display_name"),
    )
    return groups, membership, people


def _group_members(spark, d):
    _, membership, people = _groups(spark, d)
    return joins.group_members(membership, people, max_members=20)


def _unresolved(spark, d):
    k = F.col("l_orderkey")
    lines = read_table(spark, d, "lineitem").select(F.when(k % 7 == 3, -k).otherwise(k).alias("order_id"))
    orders = read_table(spark, d, "orders")
    return joins.unresolved_refs(lines, orders, "order_id", "o_orderkey")


def _patch(spark, d):
    base = read_table(spark, d, "customer")
    k = F.col("c_custkey")
    patch = base.filter("c_acctbal < 3000").select(
        "c_custkey",
        F.when(k % 2 == 0, F.upper("c_name")).alias("c_name"),
        F.when(k % 3 == 0, F.lit("MOVED")).alias("c_mktsegment"),
        F.when(k % 5 == 0, F.lit(0.0)).alias("c_acctbal"),
    )
    return joins.patch_merge(base, patch, "c_custkey", ["c_name", "c_mktsegment", "c_acctbal"])


def _masked(spark, d):
    s = read_table(spark, d, "supplier")
    k = F.col("s_suppkey")
    base = s.select(
        k.alias("id"), F.when(F.col("s_acctbal") > 500, F.lit("e1")).alias("etag"),
        F.col("s_name").alias("name"), _text("s_nationkey").alias("phone"), F.lit("x").alias("note"),
    )
    updates = s.select(
        (k + 20).alias("id"),
        F.when(k % 2 == 0, F.concat(F.lit("New "), _text("s_suppkey"))).alias("name"),
        F.when(k % 3 == 0, F.lit("555")).alias("phone"),
        F.lit(None).cast("string").alias("note"),
    )
    return joins.masked_batch_update(base, updates, "id", "etag", ["name", "phone", "note"])


def _label_changes(spark, d):
    items = read_table(spark, d, "labels").select(
        F.col("doc_id").alias("id"),
        F.array_compact(
            F.array(
                F.lit("INBOX"),
                F.when(F.col("quality") == 1, F.lit("good")),
                F.when(F.col("toxic") == 1, F.lit("toxic")),
            )
        ).alias("labels"),
    )
    changes = read_table(spark, d, "documents").filter("lang <> 'en'").select(
        F.col("doc_id").alias("id"),
        F.array(F.col("lang"), F.lit("toxic")).alias("add"),
        F.when(F.col("n_chars") > 400, F.array(F.lit("INBOX"), F.lit("toxic"))).alias("remove"),
    )
    return joins.apply_label_changes(items, changes).select("id", F.array_join("labels", ",").alias("labels"))


def _cell_ranges(spark, d):
    k = F.col("o_orderkey")
    ranges = read_table(spark, d, "orders").select(
        k.alias("rule_idx"), k.alias("sheet_id"),
        F.when(k % 5 != 0, F.col("o_custkey") % 4).alias("r0"),
        F.when(k % 3 != 0, F.col("o_custkey") % 4 + F.when(k % 2 == 0, 2).otherwise(5000)).alias("r1"),
        F.when(k % 2 == 0, F.lit(1)).alias("c0"),
        F.when(k % 7 != 0, F.lit(4)).alias("c1"),
    )
    return intervals.cells_in_ranges(b.sheet_cells(spark, d), ranges)


def _points(spark, d):
    n = F.length("text").cast("bigint")
    spots = F.array(F.floor(n / 3), F.floor(n / 2), n - 1, n, n + 10, F.lit(0).cast("bigint"))
    return read_table(spark, d, "documents").select(
        "doc_id", F.posexplode(spots).alias("point_id", "index")
    )


def _element_at(spark, d):
    elements = b.landed_elements(spark, d)
    middle = F.col("start_index") + F.floor((F.col("end_index") - F.col("start_index")) / 2)
    halves = F.array(
        F.struct(F.lit(0).alias("row"), F.lit(0).alias("col"), F.col("start_index"), middle.alias("end_index")),
        F.struct(F.lit(0).alias("row"), F.lit(1).alias("col"), middle.alias("start_index"), F.col("end_index")),
    )
    cells = elements.filter("type = 'table'").select("doc_id", F.explode(halves).alias("c")).select("doc_id", "c.*")
    return joins.element_at_index(elements, _points(spark, d), cells=cells)


def _next_paragraph(spark, d):
    return joins.next_paragraph(b.landed_elements(spark, d), _points(spark, d))


def _paragraph_ranges(spark, d):
    n = F.length("text").cast("bigint")
    lit = lambda v: F.lit(v).cast("bigint")
    spans = F.array(
        F.struct(F.floor(n / 4).alias("range_start"), F.floor(n / 2).alias("range_end")),
        F.struct(lit(0).alias("range_start"), lit(1).alias("range_end")),
        F.struct((n + 50).alias("range_start"), (n + 60).alias("range_end")),
        F.struct(lit(5).alias("range_start"), lit(5).alias("range_end")),
        F.struct(lit(1).alias("range_start"), (n + 1).alias("range_end")),
    )
    ranges = read_table(spark, d, "documents").select(
        "doc_id", F.posexplode(spans).alias("range_id", "s")
    ).select("doc_id", "range_id", "s.*")
    return joins.paragraphs_in_ranges(b.landed_elements(spark, d), ranges)


def _comments(spark, d):
    docs = read_table(spark, d, "documents")
    half = F.floor(F.length("text") / 2).cast("int")
    notes = F.array(
        F.struct(F.split_part("text", F.lit(" "), F.lit(3)).alias("anchor"), F.lit(False).alias("resolved")),
        F.struct(F.lit("no such words").alias("anchor"), (F.col("n_chars") > 500).alias("resolved")),
        F.struct(F.substr("text", half + 1, F.lit(12)).alias("anchor"), F.lit(False).alias("resolved")),
        F.struct(F.lit("").alias("anchor"), F.lit(True).alias("resolved")),
    )
    comments = docs.select(
        "doc_id", F.col("lang").alias("author"), F.col("source").alias("content"),
        F.posexplode(notes).alias("n", "c"),
    ).select("doc_id", (F.col("n") + 1).cast("bigint").alias("comment_no"), "c.*", "author", "content")
    return docs.select("doc_id", "text"), comments


def _anchors(spark, d):
    return joins.anchor_comments(*_comments(spark, d))


def _annotated(spark, d):
    docs, comments = _comments(spark, d)
    marks = read_table(spark, d, "labels")
    replies = marks.select(
        "doc_id",
        F.explode(F.array(F.lit(1), F.lit(2)).cast("array<bigint>")).alias("comment_no"),
        F.lit(1).cast("bigint").alias("reply_no"),
        F.lit("grader").alias("author"),
        F.concat(F.lit("quality "), _text("quality")).alias("content"),
    )
    more = replies.withColumns({"reply_no": F.lit(2).cast("bigint"), "content": F.lit("noted")})
    return joins.annotate_documents(docs, comments, replies.unionByName(more))


RULES = [
    {"rule_id": "r1", "from": "SRC1", "query": "the", "add_labels": ["team"], "remove_labels": ["INBOX"]},
    {"rule_id": "r2", "to": "fr@", "negated_query": "zz", "add_labels": ["french", "team"], "forward": "fr@example.net"},
    {"rule_id": "r3", "has_attachment": True, "exclude_chats": True, "add_labels": ["big"]},
    {"rule_id": "r4", "size": 300, "size_comparison": "smaller", "remove_labels": ["UNREAD"], "forward": "all@example.net"},
    {"rule_id": "r5", "subject": "le ", "size": 250, "size_comparison": "larger", "add_labels": ["le"]},
]


def _mail(spark, d):
    return read_table(spark, d, "documents").select(
        F.col("doc_id").alias("message_id"),
        F.concat("source", F.lit("@example.com")).alias("sender"),
        F.concat("lang", F.lit("@example.org")).alias("recipients"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("subject"),
        "text",
        (F.col("n_chars") > 1500).alias("has_attachment"),
        (F.col("source") == "src5").alias("is_chat"),
        F.col("n_chars").alias("size"),
    )


def _rules(spark, d):
    join = lambda c: F.array_join(c, ",").alias(c)
    return joins.apply_filter_rules(_mail(spark, d), RULES).select(
        "message_id", join("rule_ids"), join("add_labels"), join("remove_labels"), join("forwards")
    )


def _rule_table(spark, d):
    mail = _mail(spark, d).withColumn("mailbox", F.col("sender"))
    sources = read_table(spark, d, "documents").select("source").distinct()
    text = lambda v: F.lit(v).cast("string")
    rules = sources.select(
        F.concat("source", F.lit("@example.com")).alias("mailbox"),
        F.concat(F.lit("own "), "source").alias("rule_id"),
        text(None).alias("from"), text("en@").alias("to"), text(None).alias("subject"),
        F.when(F.col("source") < "src15", F.lit("and")).alias("query"), text(None).alias("negated_query"),
        F.lit(False).alias("has_attachment"), F.lit(True).alias("exclude_chats"),
        F.lit(400).cast("bigint").alias("size"), text("larger").alias("size_comparison"),
        F.array(F.lit("x")).alias("add_labels"), F.array().cast("array<string>").alias("remove_labels"),
        text(None).alias("forward"),
    )
    return joins.apply_rule_table(mail, rules).select("message_id", "rule_id", F.array_join("add_labels", ",").alias("add_labels"))


def _grants(spark, d):
    p = F.col("o_orderpriority")
    scope = (
        F.when(p == "1-URGENT", "gmail.modify").when(p == "2-HIGH", "drive").when(p == "3-MEDIUM", "calendar.readonly")
        .when(p == "4-NOT SPECIFIED", "tasks").otherwise("drive.file")
    )
    grants = read_table(spark, d, "orders").select(
        F.col("o_custkey").alias("user"), F.concat(F.lit(PREFIX), scope).alias("scope")
    )
    customers = read_table(spark, d, "customer")
    needs = F.array(*[F.lit(PREFIX + s) for s in ("gmail.readonly", "drive.file", "calendar.readonly", "tasks.readonly")])
    required = customers.filter("c_mktsegment <> 'HOUSEHOLD'").select(
        F.col("c_custkey").alias("user"), F.explode(needs).alias("scope")
    )
    return customers.select(F.col("c_custkey").alias("user")), grants, required


def _missing_scopes(spark, d):
    _, grants, required = _grants(spark, d)
    return joins.missing_scopes(grants, required)


def _by_name(spark, d):
    files = read_table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.array(
            F.struct(
                F.when(F.col("p_size") % 2 == 0, "anyone").otherwise("user").alias("type"), F.lit("reader").alias("role")
            )
        ).alias("permissions"),
    )
    names = read_table(spark, d, "part").select(F.col("p_name").alias("name")).unionByName(
        read_table(spark, d, "region").select(F.col("r_name").alias("name"))
    )
    return joins.files_by_name(files, names)


def _snapshots(spark, d):
    """Customers as they are, and with some added, removed and changed."""
    k, nation = F.col("c_custkey"), F.col("c_nationkey")
    old = read_table(spark, d, "customer").select(k.alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("folder"), nation.alias("owner"))
    i = F.col("id")
    new = old.filter(i % 97 != 5).withColumns({
        "name": F.when(i % 101 == 7, F.lit(None)).when(i % 103 == 8, F.upper("name")).otherwise(F.col("name")),
        "owner": F.when(i % 107 == 9, F.col("owner") + 1).otherwise(F.col("owner")),
    }).unionByName(old.filter(i % 109 == 10).withColumn("id", i + 10_000_000))
    return snapshots.snapshot_changes(old, new, "id", ["name", "folder", "owner"])


def _changes(spark, d):
    c = read_table(spark, d, "customer")
    k = F.col("c_custkey")
    current = c.select(
        k.alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("folder"),
        F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, F.lit("old")).alias("description"),
        (k % 2 == 0).alias("starred"),
    )
    requested = c.filter("c_acctbal > 0").select(
        k.alias("id"),
        F.when(k % 3 == 0, F.upper("c_name")).when(k % 3 == 1, F.col("c_name")).alias("name"),
        F.when(F.col("c_nationkey") < 5, F.lit("BUILDING")).alias("folder"),
        F.when(k % 5 == 0, F.lit("")).when(k % 5 == 1, F.lit("new")).alias("description"),
        F.when(k % 7 == 0, F.lit(True)).alias("starred"),
    )
    changes = joins.change_report(current, requested, "id", ["name", "folder", "description", "starred"], ["description"])
    return changes, requested


QUERIES = {
    "j1_resolve_senders": _senders,
    "j2_resolve_shortcuts": _shortcuts,
    "j3_group_members": _group_members,
    "j3_group_member_counts": lambda s, d: joins.group_member_counts(*_groups(s, d)),
    "j4_unresolved_refs": _unresolved,
    "j5_patch_merge": _patch,
    "j6_masked_batch_update": _masked,
    "j7_apply_label_changes": _label_changes,
    "j8_cells_in_ranges": _cell_ranges,
    "j9_element_at_index": _element_at,
    "j10_next_paragraph": _next_paragraph,
    "l3_search_hits": _search_hits,
    "j8_range_bounds": _range_bounds,
    "j11_anchor_comments": _anchors,
    "j11_annotate_documents": _annotated,
    "j12_apply_filter_rules": _rules,
    "j12_rule_hits": lambda s, d: joins.rule_hits(_mail(s, d), RULES),
    "j12_apply_rule_table": _rule_table,
    "j13_missing_scopes": _missing_scopes,
    "j13_scope_check": lambda s, d: joins.scope_check(*_grants(s, d)),
    "j14_files_by_name": _by_name,
    "j15_paragraphs_in_ranges": _paragraph_ranges,
    "j16_change_report": lambda s, d: _changes(s, d)[0],
    "j16_snapshot_changes": _snapshots,
    "j16_change_counts": lambda s, d: joins.change_counts(*_changes(s, d), "id"),
}

GROUP_SQL = """
members AS (SELECT c_nationkey AS group_id, 'people/' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS member,
  CASE WHEN c_acctbal > 0 THEN c_name END AS display_name, c_acctbal > 0 AS resolved,
  row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS place FROM customer)
"""

POINTS_SQL = """
spots AS (SELECT doc_id, length(text) AS n FROM documents),
points AS (SELECT doc_id, CAST(unnest([0, 1, 2, 3, 4, 5]) AS INTEGER) AS point_id,
  CAST(unnest([n // 3, n // 2, n - 1, n, n + 10, 0]) AS BIGINT) AS index FROM spots)
"""

COMMENTS_SQL = """
notes AS (SELECT doc_id, text, lang AS author, source AS content,
  CAST(unnest([1, 2, 3, 4]) AS BIGINT) AS comment_no,
  unnest([split_part(text, ' ', 3), 'no such words', substr(text, length(text) // 2 + 1, 12), '']) AS anchor,
  unnest([false, n_chars > 500, false, true]) AS resolved FROM documents),
placed AS (SELECT * EXCLUDE (text), CASE WHEN anchor <> '' AND strpos(text, anchor) > 0
    THEN CAST(strpos(text, anchor) AS INTEGER) END AS at, '[^c' || comment_no || ']' AS ref FROM notes)
"""

MAIL_SQL = """
mail AS (SELECT doc_id AS message_id, source || '@example.com' AS sender, lang || '@example.org' AS recipients,
  split_part(text, chr(10), 1) AS subject, text, n_chars > 1500 AS has_attachment, source = 'src5' AS is_chat,
  n_chars AS size FROM documents),
marks AS (SELECT message_id,
  contains(lower(sender), 'src1') AND (contains(lower(text), 'the') OR contains(lower(subject), 'the')) AS r1,
  contains(lower(recipients), 'fr@') AND NOT contains(lower(text), 'zz') AS r2,
  has_attachment AND NOT is_chat AS r3, size < 300 AS r4,
  contains(lower(subject), 'le ') AND size > 250 AS r5 FROM mail)
"""

SCOPES_SQL = f"""
held0 AS (SELECT DISTINCT o_custkey AS u, CASE o_orderpriority WHEN '1-URGENT' THEN 'gmail.modify'
  WHEN '2-HIGH' THEN 'drive' WHEN '3-MEDIUM' THEN 'calendar.readonly' WHEN '4-NOT SPECIFIED' THEN 'tasks'
  ELSE 'drive.file' END AS s FROM orders),
held AS (SELECT u, s FROM held0 UNION SELECT u, 'gmail.readonly' FROM held0 WHERE s = 'gmail.modify'
  UNION SELECT u, 'drive.file' FROM held0 WHERE s = 'drive' UNION SELECT u, 'tasks.readonly' FROM held0 WHERE s = 'tasks'),
needs AS (SELECT c_custkey AS u, unnest(['gmail.readonly', 'drive.file', 'calendar.readonly', 'tasks.readonly']) AS s
  FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'),
missing AS (SELECT u AS user, '{PREFIX}' || s AS scope FROM needs WHERE (u, s) NOT IN (SELECT (u, s) FROM held))
"""

CHANGES_SQL = """
req AS (SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN upper(c_name) WHEN 1 THEN c_name END AS name,
  CASE WHEN c_nationkey < 5 THEN 'BUILDING' END AS folder,
  CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'new' END AS description,
  CASE WHEN c_custkey % 7 = 0 THEN 'true' END AS starred FROM customer WHERE c_acctbal > 0),
cur AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS folder,
  CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'old' END AS description,
  CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END AS starred FROM customer),
changes AS (
  SELECT id, 'name' AS field, cur.name AS old, req.name AS new FROM cur JOIN req USING (id) WHERE req.name <> cur.name
  UNION ALL SELECT id, 'folder', cur.folder, req.folder FROM cur JOIN req USING (id) WHERE req.folder <> cur.folder
  UNION ALL SELECT id, 'description', cur.description, req.description FROM cur JOIN req USING (id)
    WHERE req.description IS NOT NULL AND req.description <> coalesce(cur.description, '')
  UNION ALL SELECT id, 'starred', cur.starred, req.starred FROM cur JOIN req USING (id) WHERE req.starred <> cur.starred)
"""

ORACLES = {
    "j1_resolve_senders": """
WITH m AS (SELECT o_orderkey AS message_id, CASE WHEN o_orderkey % 10 <> 0 THEN 'users/' || o_custkey END AS sender_id,
    CASE WHEN o_orderkey % 4 = 0 THEN 'Own ' || o_custkey ELSE '' END AS sender_name, o_custkey FROM orders)
SELECT message_id, sender_id, sender_name, CASE WHEN sender_name <> '' THEN sender_name
  WHEN sender_id IS NULL THEN 'Unknown Sender' WHEN c_custkey % 3 <> 0 THEN c_name
  WHEN c_custkey % 6 <> 0 THEN c_custkey || '@example.com' ELSE sender_id END AS sender
FROM m LEFT JOIN customer ON c_custkey = o_custkey""",
    "j2_resolve_shortcuts": f"""
WITH RECURSIVE files AS (SELECT p_partkey AS id, p_partkey % 3 <> 0 AS is_short, p_size > 25 AS big,
    CASE WHEN p_partkey % 50 = 7 THEN NULL WHEN p_partkey % 40 = 11 THEN p_partkey WHEN p_partkey % 60 = 13 THEN -1
         ELSE p_partkey // 2 END AS target FROM part),
walk AS (SELECT id, id AS spot, 0 AS hops FROM files
  UNION ALL
  SELECT w.id, f.target, w.hops + 1 FROM walk w JOIN files f ON f.id = w.spot
  WHERE f.is_short AND f.target IS NOT NULL AND w.hops < 6),
ends AS (SELECT id, max(hops) AS hops, arg_max(spot, hops) AS spot FROM walk GROUP BY id)
SELECT e.id, CASE WHEN e.hops <= 5 AND f.id IS NOT NULL AND NOT f.is_short THEN e.spot END AS resolved_id,
  CAST(least(e.hops, 5) AS INTEGER) AS hops,
  CASE WHEN e.hops > 5 THEN 'too many hops' WHEN f.id IS NULL THEN 'not found' WHEN f.is_short THEN 'missing target'
       WHEN NOT f.big THEN 'not a folder' END AS error
FROM ends e LEFT JOIN files f ON f.id = e.spot""",
    "j3_group_members": f"""
WITH {GROUP_SQL} SELECT group_id, member, display_name, resolved FROM members WHERE place <= 20""",
    "j3_group_member_counts": f"""
WITH {GROUP_SQL} SELECT n_nationkey AS group_id, n_name AS name, n_regionkey + 60 AS member_count,
  count(member) AS n_members, count(*) FILTER (WHERE resolved) AS n_resolved
FROM nation LEFT JOIN members ON group_id = n_nationkey GROUP BY ALL""",
    "j4_unresolved_refs": """
WITH l AS (SELECT CASE WHEN l_orderkey % 7 = 3 THEN -l_orderkey ELSE l_orderkey END AS order_id FROM lineitem)
SELECT order_id, count(*) AS n_refs FROM l WHERE order_id NOT IN (SELECT o_orderkey FROM orders) GROUP BY 1""",
    "j5_patch_merge": """
SELECT c_custkey, CASE WHEN c_acctbal < 3000 AND c_custkey % 2 = 0 THEN upper(c_name) ELSE c_name END AS c_name, c_nationkey,
  CASE WHEN c_acctbal < 3000 AND c_custkey % 5 = 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_acctbal < 3000 AND c_custkey % 3 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment FROM customer""",
    "j6_masked_batch_update": """
WITH u AS (SELECT s_suppkey + 20 AS id, CASE WHEN s_suppkey % 2 = 0 THEN 'New ' || s_suppkey END AS name,
    CASE WHEN s_suppkey % 3 = 0 THEN '555' END AS phone FROM supplier)
SELECT s_suppkey AS id, CASE WHEN s_acctbal > 500 THEN 'e1' END AS etag,
  CASE WHEN u.id IS NOT NULL THEN u.name ELSE s_name END AS name,
  CASE WHEN u.id IS NOT NULL THEN u.phone ELSE CAST(s_nationkey AS VARCHAR) END AS phone, 'x' AS note,
  u.id IS NOT NULL AS updated
FROM supplier LEFT JOIN u ON u.id = s_suppkey AND s_acctbal > 500 AND (u.name IS NOT NULL OR u.phone IS NOT NULL)""",
    "j7_apply_label_changes": """
WITH l AS (SELECT l.doc_id AS id, list_concat(['INBOX'], CASE WHEN quality = 1 THEN ['good'] ELSE [] END,
      CASE WHEN toxic = 1 THEN ['toxic'] ELSE [] END, CASE WHEN d.lang <> 'en' THEN [d.lang, 'toxic'] ELSE [] END) AS x,
    coalesce(d.lang <> 'en' AND d.n_chars > 400, false) AS cut FROM labels l LEFT JOIN documents d USING (doc_id))
SELECT id, array_to_string(list_sort(list_distinct(list_filter(x, lambda v: NOT cut OR v NOT IN ('INBOX', 'toxic')))), ',')
  AS labels FROM l""",
    "j8_cells_in_ranges": f"""
WITH {b.CELLS_SQL},
r AS (SELECT o_orderkey AS rule_idx, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey % 4 END AS r0,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey % 4 + CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 5000 END END AS r1,
  CASE WHEN o_orderkey % 2 = 0 THEN 1 END AS c0, CASE WHEN o_orderkey % 7 <> 0 THEN 4 END AS c1 FROM orders)
SELECT sheet_id, row, col, value, rule_idx FROM cells JOIN r ON sheet_id = rule_idx AND row >= coalesce(r0, row)
  AND row < coalesce(r1, row + 1) AND col >= coalesce(c0, col) AND col < coalesce(c1, col + 1)""",
    "j9_element_at_index": f"""
WITH {b.ELEMENTS_SQL}, {POINTS_SQL}
SELECT p.doc_id, p.index, point_id, pos, type, CASE WHEN type = 'table' THEN 0 END AS row,
  CASE WHEN type = 'table' THEN CASE WHEN p.index < start_index + (end_index - start_index) // 2 THEN 0 ELSE 1 END END AS col
FROM points p LEFT JOIN elements e ON e.doc_id = p.doc_id AND start_index <= p.index AND p.index < end_index""",
    "j10_next_paragraph": f"""
WITH {b.ELEMENTS_SQL}, {POINTS_SQL}
SELECT p.doc_id, point_id, p.index, CAST(coalesce(min(start_index) FILTER (WHERE type = 'paragraph' AND start_index > p.index),
  max(end_index) - 1) AS BIGINT) AS next_index FROM points p JOIN elements e USING (doc_id) GROUP BY 1, 2, 3""",
    "l3_search_hits": """
WITH s AS (SELECT DISTINCT conv_id FROM conversations ORDER BY conv_id LIMIT 10),
m AS (SELECT conv_id AS space, turn, CASE WHEN turn % 2 = 0 THEN text || ' http://x.example/' || conv_id ELSE text END AS text
  FROM conversations JOIN s USING (conv_id)),
h AS (SELECT *, row_number() OVER (PARTITION BY space ORDER BY turn DESC) AS place FROM m WHERE lower(text) LIKE '%le%')
SELECT space, 'Space ' || space AS space_name, CAST(turn AS BIGINT) AS message_id, CAST(place AS INTEGER) AS place,
  CASE WHEN length(text) > 100 THEN left(text, 100) || '...' ELSE text END AS text,
  CASE WHEN turn % 2 = 0 THEN 'Own ' || space WHEN c_custkey % 3 <> 0 THEN c_name WHEN c_custkey % 6 <> 0 THEN c_custkey || '@example.com'
    ELSE 'users/' || space END AS sender,
  concat_ws(' ', CASE WHEN turn % 2 = 1 THEN 'http://x.example/' || space END, CASE WHEN turn % 3 = 0 THEN 'http://z.example/' END) AS links,
  coalesce(array_to_string(list_transform(range(1, turn + 1), lambda i: CASE WHEN i % 2 = 0 THEN 'file' || i ELSE 'unnamed' END), ', '), '') AS attachments
FROM h LEFT JOIN customer ON c_custkey = space WHERE place <= 5""",
    "j8_range_bounds": """
WITH o AS (SELECT o_orderkey AS k, o_orderkey % 1000 AS r, CAST(o_orderkey % 800 AS INTEGER) AS c, o_orderkey % 5 AS kind FROM orders)
SELECT k AS range_id, CASE k % 3 WHEN 1 THEN 'S_' || k WHEN 2 THEN 'It''s ' || k END AS sheet,
  CASE WHEN kind IN (0, 1, 3) THEN r END AS r0, CASE kind WHEN 0 THEN r + 1 WHEN 1 THEN r + 11 WHEN 3 THEN r + 5 END AS r1,
  CASE WHEN kind < 3 THEN c END AS c0, CASE kind WHEN 0 THEN c + 1 WHEN 1 THEN c + 4 WHEN 2 THEN c + 3 END AS c1, kind <> 4 AS valid FROM o""",
    "j11_anchor_comments": f"WITH {COMMENTS_SQL} SELECT * FROM placed",
    "j11_annotate_documents": f"""
WITH {COMMENTS_SQL},
r AS (SELECT doc_id, '- **grader**: quality ' || quality AS a, '- **grader**: noted' AS z FROM labels),
f AS (SELECT p.*, CASE WHEN comment_no <= 2 AND a IS NOT NULL THEN a END AS a, z FROM placed p LEFT JOIN r USING (doc_id)),
lines AS (SELECT *, "at" + length(anchor) - 1 AS cut,
    ref || ': **' || author || '**: ' || content || coalesce(chr(10) || '    ' || a || chr(10) || '    ' || z, '') AS foot,
    CASE WHEN anchor <> '' THEN '> ' || anchor || chr(10) || chr(10) ELSE '' END || '- **' || author || '**: ' || content
      || CASE WHEN resolved THEN ' *(Resolved)*' ELSE '' END
      || coalesce(chr(10) || '  ' || a || chr(10) || '  ' || z, '') || chr(10) AS rest FROM f),
g AS (SELECT doc_id, max(cut) FILTER (WHERE comment_no = 1) AS c1, max(cut) FILTER (WHERE comment_no = 3) AS c3,
    string_agg(foot, chr(10) ORDER BY comment_no) FILTER (WHERE "at" IS NOT NULL) AS feet,
    string_agg(rest, chr(10) ORDER BY comment_no) FILTER (WHERE "at" IS NULL) AS rests FROM lines GROUP BY doc_id),
t AS (SELECT doc_id, feet, rests, CASE
    WHEN c1 IS NULL AND c3 IS NULL THEN text
    WHEN c3 IS NULL THEN left(text, c1) || '[^c1]' || substr(text, c1 + 1)
    WHEN c1 IS NULL THEN left(text, c3) || '[^c3]' || substr(text, c3 + 1)
    WHEN c1 < c3 THEN left(text, c1) || '[^c1]' || substr(text, c1 + 1, c3 - c1) || '[^c3]' || substr(text, c3 + 1)
    ELSE left(text, c3) || '[^c3]' || substr(text, c3 + 1, c1 - c3) || '[^c1]' || substr(text, c1 + 1) END AS body
  FROM documents JOIN g USING (doc_id)),
u AS (SELECT doc_id, rests, CASE WHEN feet IS NULL THEN body
    ELSE rtrim(body, chr(10)) || chr(10) || chr(10) || feet || chr(10) END AS body FROM t)
SELECT doc_id, rtrim(body, chr(10)) || chr(10) || chr(10) || '## Comments' || chr(10) || chr(10) || rests AS annotated FROM u""",
    "j12_apply_filter_rules": f"""
WITH {MAIL_SQL}
SELECT message_id,
  concat_ws(',', CASE WHEN r1 THEN 'r1' END, CASE WHEN r2 THEN 'r2' END, CASE WHEN r3 THEN 'r3' END,
    CASE WHEN r4 THEN 'r4' END, CASE WHEN r5 THEN 'r5' END) AS rule_ids,
  concat_ws(',', CASE WHEN r3 THEN 'big' END, CASE WHEN r2 THEN 'french' END, CASE WHEN r5 THEN 'le' END,
    CASE WHEN r1 OR r2 THEN 'team' END) AS add_labels,
  concat_ws(',', CASE WHEN r1 THEN 'INBOX' END, CASE WHEN r4 THEN 'UNREAD' END) AS remove_labels,
  concat_ws(',', CASE WHEN r4 THEN 'all@example.net' END, CASE WHEN r2 THEN 'fr@example.net' END) AS forwards
FROM marks""",
    "j12_rule_hits": f"""
WITH {MAIL_SQL}, h AS (SELECT unnest([CASE WHEN r1 THEN 'r1' END, CASE WHEN r2 THEN 'r2' END, CASE WHEN r3 THEN 'r3' END,
    CASE WHEN r4 THEN 'r4' END, CASE WHEN r5 THEN 'r5' END]) AS rule_id FROM marks)
SELECT rule_id, count(*) AS n_hits FROM h WHERE rule_id IS NOT NULL GROUP BY 1""",
    "j12_apply_rule_table": """
SELECT doc_id AS message_id, 'own ' || source AS rule_id, 'x' AS add_labels FROM documents WHERE lang = 'en'
  AND source <> 'src5' AND n_chars > 400 AND (source >= 'src15' OR contains(lower(text), 'and'))""",
    "j13_missing_scopes": f"WITH {SCOPES_SQL} SELECT * FROM missing",
    "j13_scope_check": f"""
WITH {SCOPES_SQL} SELECT c_custkey AS user, count(scope) AS n_missing, min(scope) AS first_missing, count(scope) = 0 AS passes
FROM customer LEFT JOIN missing ON missing.user = c_custkey GROUP BY 1""",
    "j14_files_by_name": """
WITH n AS (SELECT p_name AS name FROM part UNION SELECT r_name FROM region)
SELECT name, count(p_partkey) AS n_files, min(p_partkey) AS id,
  CASE WHEN count(p_partkey) > 0 THEN arg_min(p_size % 2 = 0, p_partkey) END AS public
FROM n LEFT JOIN part ON p_name = name GROUP BY name""",
    "j15_paragraphs_in_ranges": f"""
WITH {b.ELEMENTS_SQL},
n AS (SELECT doc_id, length(text) AS n FROM documents),
r AS (SELECT doc_id, CAST(unnest([0, 1, 2, 3, 4]) AS INTEGER) AS range_id,
  CAST(unnest([n // 4, 0, n + 50, 5, 1]) AS BIGINT) AS s, CAST(unnest([n // 2, 1, n + 60, 5, n + 1]) AS BIGINT) AS e FROM n)
SELECT r.doc_id, range_id, coalesce(start_index, s) AS paragraph_start FROM r LEFT JOIN elements x
  ON x.doc_id = r.doc_id AND type = 'paragraph' AND end_index > s AND start_index < e""",
    "j16_change_report": f"WITH {CHANGES_SQL} SELECT * FROM changes",
    "j16_snapshot_changes": """
WITH o AS (SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS owner, c_nationkey FROM customer),
n AS (SELECT id, CASE WHEN id % 101 = 7 THEN NULL WHEN id % 103 = 8 THEN upper(name) ELSE name END AS name,
  CASE WHEN id % 107 = 9 THEN CAST(c_nationkey + 1 AS VARCHAR) ELSE owner END AS owner FROM o WHERE id % 97 <> 5)
SELECT id, 'changed' AS kind, 'name' AS field, o.name AS old, n.name AS new FROM o JOIN n USING (id) WHERE o.name IS DISTINCT FROM n.name
UNION ALL SELECT id, 'changed', 'owner', o.owner, n.owner FROM o JOIN n USING (id) WHERE o.owner IS DISTINCT FROM n.owner
UNION ALL SELECT id, 'removed', NULL, NULL, NULL FROM o WHERE id % 97 = 5
UNION ALL SELECT id + 10000000, 'added', NULL, NULL, NULL FROM o WHERE id % 109 = 10""",
    "j16_change_counts": f"""
WITH {CHANGES_SQL} SELECT field, count(*) AS n_changes FROM changes GROUP BY 1
UNION ALL SELECT '(none)', count(*) FROM req WHERE id NOT IN (SELECT id FROM changes)""",
}
