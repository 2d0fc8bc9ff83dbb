"""Registered queries of the aggregates and trees."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import functions as F

from deskmill.operators import aggregates, filters, trees
from deskmill.plans import bindings as b
from deskmill.session import shared_dir
from deskmill.sources.tables import TABLES, read_table
from deskmill.streaming.buckets import read_buckets, stream_buckets
from deskmill.streaming.metrics import late_rows, read_run_stream, stream_execution_metrics, write_metrics


def _document_stats(spark, d):
    pos, table = F.col("pos"), F.col("type") == "table"
    elements = b.flagged_elements(spark, d).withColumns(
        {
            "type": F.when(pos % 17 == 3, "section_break").otherwise(F.col("type")),
            "n_rows": F.when(table, pos % 4 + 1),
            "n_cols": F.when(table, pos % 3 + 2),
        }
    )
    docs = read_table(spark, d, "documents")
    segments = docs.filter("lang = 'en'").select("doc_id", F.lit("header").alias("kind")).unionByName(
        docs.filter("source = 'src1'").select("doc_id", F.lit("footer").alias("kind"))
    )
    return aggregates.document_stats(elements, segments)


def _used_range(spark, d):
    cells = b.sheet_cells(spark, d)
    return aggregates.used_range(cells.withColumn("row", (F.col("row") + F.col("sheet_id") % 3).cast("int")))


def _table_rows(spark, d):
    doc, pos = F.col("doc_id"), F.col("pos")
    docs = read_table(spark, d, "documents").select("doc_id", "text", "lang")
    lines = docs.select("doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    text = lambda v: F.lit(v).cast("string")
    cells = (
        F.when((doc % 5 == 4) & (pos == 0), F.array().cast("array<string>"))
        .when(doc % 5 == 0, F.array(F.when(pos != 2, F.col("line")), F.col("lang")))
        .when(doc % 5 == 1, F.split("line", ","))
        .when(doc % 5 == 2, F.array_repeat("lang", 21))
        .otherwise(F.array("lang", "lang"))
    )
    rows = lines.select(doc.alias("table_id"), pos.alias("row_idx"), cells.alias("cells"))
    empty = read_table(spark, d, "region").select((-F.col("r_regionkey") - 1).cast("bigint").alias("table_id"))
    return rows.unionByName(empty, allowMissingColumns=True)


def _find_replace(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    return aggregates.find_replace(docs, "The ", "$1 \\The ")


def _replace_totals(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    parts = [
        aggregates.replace_totals(aggregates.find_replace(docs, "Le", "*", match_case=case)).withColumn(
            "match_case", F.lit(case)
        )
        for case in (True, False)
    ]
    return parts[0].unionByName(parts[1])


def _outcomes(spark, d):
    return aggregates.outcome_summary(filters.validate_shares(b.share_requests(spark, d)))


def _replies(spark, d):
    replies = read_table(spark, d, "customer").select(
        F.col("c_nationkey").alias("batch_id"), F.when(F.col("c_acctbal") > 1000, F.col("c_custkey")).alias("created_id")
    )
    return aggregates.reply_summary(replies)


def _labels(spark, d):
    docs = read_table(spark, d, "documents")
    text = lambda v: F.lit(v).cast("string")
    catalog = (
        docs.select(F.col("lang").alias("label"), F.when(F.col("lang") == "en", "system").alias("type"))
        .distinct()
        .unionByName(read_table(spark, d, "region").select(F.col("r_name").alias("label"), text("custom").alias("type")))
    )
    items = docs.select(F.array("lang", "source", "lang").alias("labels"))
    return aggregates.label_catalog(catalog, items)


def task_rows(spark, d):
    """Orders as tasks; some parents are missing, a few point at themselves."""
    k = F.col("o_orderkey")
    o = read_table(spark, d, "orders")
    return o.select(
        k.alias("id"),
        F.when(k % 500 == 499, k).when(k % 13 == 6, -F.floor(k / 50) - 1).when(k % 5 != 0, F.floor(k / 4)).alias("parent"),
        F.when(k % 11 != 0, F.col("o_custkey")).cast("decimal(20,0)").alias("position"),
        F.when(F.col("o_orderstatus") == "O", "completed").otherwise("needsAction").alias("status"),
        F.col("o_orderdate").alias("due"),
    )


def _task_tree(spark, d):
    return trees.task_tree(task_rows(spark, d)).select(
        "id", "parent", "depth", "root", "place", "n_below", "is_placeholder", "in_cycle", "below_cycle", "cycle_id"
    )


def _tabs(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    tabs = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("tab_id", "text")).select(
        "doc_id",
        "tab_id",
        F.when(F.col("tab_id") > 0, F.floor((F.col("tab_id") - 1) / 2)).alias("parent_id"),
        (100 - F.col("tab_id") % 7).alias("pos"),
        F.concat(F.lit("T"), F.col("tab_id").cast("string")).alias("title"),
        "text",
    )
    return trees.document_tabs_text(docs, tabs)


def _runs(spark, d):
    return read_table(spark, d, "events").select(
        "ts",
        "user_id",
        (F.col("event_type") == "error").alias("failed"),
        F.when(F.col("event_type") != "signup", F.col("event_type")).alias("function_name"),
        F.when(F.col("event_id") % 3 == 0, "COMPLETED").otherwise("FAILED").alias("status"),
        F.when(
            F.col("event_id") % 13 != 0, F.concat(F.col("value").cast("decimal(12,2)").cast("string"), F.lit("s"))
        ).alias("duration"),
    )


def _metrics(spark, d):
    runs = _runs(spark, d)
    parts = [
        aggregates.execution_metrics(runs, grain).withColumn("grain", F.lit(grain)) for grain in ("DAILY", "WEEKLY")
    ]
    return parts[0].unionByName(parts[1])


def _streamed_metrics(spark, d):
    """Buckets closed by the watermark, from the events read as a stream; users are approximate, so left out."""
    events = read_run_stream(spark, d, TABLES["events"], "events.parquet")
    runs = events.select("ts", "user_id", (F.col("event_type") == "error").alias("failed"))
    place = f"{shared_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    query = write_metrics(stream_execution_metrics(runs), f"{place}/out", f"{place}/state")
    query.awaitTermination()
    if late := late_rows(query):
        logging.getLogger(__name__).warning("g9_stream_execution_metrics: %d aggregated rows were behind the watermark", late)
    closed = "start_time timestamp_ntz, end_time timestamp_ntz, total_executions bigint, failed_executions bigint"
    return spark.read.schema(closed).parquet(f"{place}/out")


def _stream_buckets(spark, d):
    """Days and weeks of the events read as a stream; estimated users against the exact ones, as they are in the batch form."""
    events = read_run_stream(spark, d, TABLES["events"], "events.parquet")
    runs = events.select("ts", "user_id", (F.col("event_type") == "error").alias("failed"))
    place = f"{shared_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    stream_buckets(runs, f"{place}/table", f"{place}/state").awaitTermination()
    parts = [read_buckets(spark, f"{place}/table", grain).withColumn("grain", F.lit(grain)) for grain in ("DAILY", "WEEKLY")]
    exact = _metrics(spark, d).select("grain", "start_time", F.col("active_users").alias("exact"))
    found = parts[0].unionByName(parts[1]).join(exact, ["grain", "start_time"])
    near = F.abs(F.col("active_users") - F.col("exact")) <= 0.04 * F.col("exact")
    return found.select("grain", "start_time", "end_time", near.alias("users_near"), "total_executions", "failed_executions")


def _gradient(spark, d):
    cells = read_table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("sheet_id"),
        F.col("l_orderkey").alias("row"),
        F.col("l_linenumber").alias("col"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("value"),
    )

    def point(kind, value, color):
        return F.struct(
            F.lit(kind).alias("type"), F.lit(value).cast("string").alias("value"), F.lit(color).alias("color")
        )

    k = F.col("s_suppkey")
    points = (
        F.when(k % 3 == 0, F.array(point("MIN", None, "#102030"), point("MAX", None, "#F0E0D1")))
        .when(
            k % 3 == 1,
            F.array(point("MIN", None, "FF0000"), point("PERCENTILE", "35", "#00FF07"), point("MAX", None, "#0000FF")),
        )
        .otherwise(
            F.array(point("PERCENT", "10", "#FFFFFF"), point("NUMBER", "40000", "#888888"), point("PERCENTILE", "95", "#010203"))
        )
    )
    rules = read_table(spark, d, "supplier").select(
        k.alias("rule_idx"), k.alias("sheet_id"), F.when(k % 2 == 0, F.lit(100)).cast("bigint").alias("r0"),
        F.lit(None).cast("bigint").alias("r1"), F.lit(1).alias("c0"), F.lit(6).alias("c1"), points.alias("points"),
    )
    return aggregates.gradient_points(cells, rules)


def _threads(spark, d):
    talk = read_table(spark, d, "conversations")
    comments = talk.filter("turn = 0").select(
        F.floor(F.col("conv_id") / 10).alias("file_id"), F.col("conv_id").alias("comment_id"),
        F.when(F.col("role") != "system", F.col("role")).alias("author"), F.col("text").alias("content"),
        F.lit(None).cast("string").alias("anchor"), (F.col("conv_id") % 4 == 0).alias("resolved"),
    )
    replies = talk.filter("turn > 0").select(F.col("conv_id").alias("comment_id"), F.col("turn").alias("created"))
    return comments, replies


def _comment_replies(spark, d):
    talk = read_table(spark, d, "conversations")
    comments = _threads(spark, d)[0].withColumn("created", F.lit(None).cast("string"))
    replies = talk.filter("turn > 0").select(
        F.col("conv_id").alias("comment_id"), F.col("turn").alias("reply_id"),
        F.when(F.col("role") != "system", F.col("role")).alias("author"),
        F.when(F.col("turn") % 3 != 0, F.col("text")).alias("content"), F.col("turn").alias("created"),
    )
    return aggregates.comment_replies(comments, replies)


def form_responses(spark, d):
    """Conversation turns as form responses; the role is the form."""
    text = F.col("text")
    entry = lambda q, values: F.struct(F.lit(q).alias("key"), values.alias("value"))
    entries = F.array_compact(
        F.array(
            entry("role", F.array("role")),
            entry("opening", F.slice(F.split(text, " "), 1, 2)),
            entry("long", F.when(F.length(text) >= 200, F.array(F.lit("yes"))).otherwise(F.array().cast("array<string>"))),
            F.when(F.col("turn") % 2 == 0, entry("even", F.array(F.col("turn").cast("string")))),
        )
    )
    return read_table(spark, d, "conversations").select(
        F.col("role").alias("form_id"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("response_id"),
        F.map_from_entries(entries).alias("answers"),
    )


def form_questions(spark, d):
    asked = F.array(
        *[
            F.struct(F.lit(q).alias("question_id"), F.lit(r).alias("required"))
            for q, r in (("role", True), ("opening", False), ("long", True), ("even", True), ("never", True))
        ]
    )
    roles = read_table(spark, d, "conversations").select(F.col("role").alias("form_id")).distinct()
    return roles.select("form_id", F.explode(asked).alias("q")).select("form_id", "q.*")


QUERIES = {
    "g1_document_stats": _document_stats,
    "g2_used_range": _used_range,
    "g3_profile_table": lambda s, d: aggregates.profile_table(_table_rows(s, d)),
    "g4_find_replace": _find_replace,
    "g4_replace_totals": _replace_totals,
    "g5_outcome_summary": _outcomes,
    "g5_reply_summary": _replies,
    "g6_label_catalog": _labels,
    "g7_task_rollup": lambda s, d: trees.task_rollup(task_rows(s, d)),
    "g8_facet_counts": lambda s, d: aggregates.facet_counts(read_table(s, d, "documents"), ["lang", "source"]),
    "g9_execution_metrics": _metrics,
    "g9_stream_execution_metrics": _streamed_metrics,
    "g9_stream_buckets": _stream_buckets,
    "g10_execution_status": lambda s, d: aggregates.execution_status(_runs(s, d)),
    "g11_gradient_points": _gradient,
    "g12_comment_threads": lambda s, d: aggregates.comment_threads(*_threads(s, d)),
    "g12_comment_replies": _comment_replies,
    "g12_comment_share": lambda s, d: aggregates.comment_share(_threads(s, d)[0]),
    "g13_form_response_counts": lambda s, d: aggregates.form_response_counts(form_responses(s, d), form_questions(s, d)),
    "g13_question_rates": lambda s, d: aggregates.question_rates(form_responses(s, d), form_questions(s, d)),
    "t1_task_tree": _task_tree,
    "p14_document_tabs_text": _tabs,
}

TASKS_SQL = """
tasks AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 500 = 499 THEN o_orderkey WHEN o_orderkey % 13 = 6 THEN -(o_orderkey // 50) - 1 WHEN o_orderkey % 5 <> 0 THEN o_orderkey // 4 END AS parent,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS position, o_orderstatus = 'O' AS completed, o_orderdate AS due
  FROM orders),
nodes AS (SELECT *, false AS is_placeholder FROM tasks
  UNION ALL SELECT DISTINCT parent, NULL, NULL, false, NULL, true FROM tasks
  WHERE parent IS NOT NULL AND parent NOT IN (SELECT id FROM tasks)),
keyed AS (SELECT *, CASE WHEN position IS NULL THEN '1' ELSE '0' || lpad(CAST(position AS VARCHAR), 20, '0') END || ':'
  || lpad(CAST(id AS VARCHAR), 20, '0') AS seg FROM nodes),
walk AS (SELECT id, id AS root, 0 AS depth, seg AS path, CAST([] AS BIGINT[]) AS above FROM keyed WHERE parent IS NULL
  UNION ALL SELECT k.id, w.root, w.depth + 1, w.path || ' ' || k.seg, list_append(w.above, w.id) FROM keyed k JOIN walk w ON k.parent = w.id)
"""

RUNS_SQL = """
runs AS (SELECT ts, user_id, event_type = 'error' AS failed, CASE WHEN event_type <> 'signup' THEN event_type ELSE 'Unknown' END AS f,
  CASE WHEN event_id % 3 = 0 THEN 'COMPLETED' ELSE 'FAILED' END AS s,
  CASE WHEN event_id % 13 <> 0 THEN CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) END AS secs FROM events)
"""

ANSWERS_SQL = """
answers AS (
  SELECT role AS form_id, conv_id * 100 + turn AS response_id, 'role' AS question_id, role AS answer, true AS given FROM conversations
  UNION ALL SELECT role, conv_id * 100 + turn, 'opening', array_to_string(string_split(text, ' ')[1:2], ', '), true FROM conversations
  UNION ALL SELECT role, conv_id * 100 + turn, 'long', CASE WHEN length(text) >= 200 THEN 'yes' ELSE 'No answer provided' END,
    length(text) >= 200 FROM conversations
  UNION ALL SELECT role, conv_id * 100 + turn, 'even', CAST(turn AS VARCHAR), true FROM conversations WHERE turn % 2 = 0)
"""

ORACLES = {
    "g1_document_stats": f"""
WITH {b.ELEMENTS_SQL},
e AS (SELECT *, CASE WHEN pos % 17 = 3 THEN 'section_break' ELSE type END AS t,
  CASE WHEN type = 'table' THEN (pos % 4 + 1) * (pos % 3 + 2) END AS size FROM elements)
SELECT e.doc_id, count(*) AS n_elements, count(*) FILTER (WHERE t = 'table') AS n_tables,
  count(*) FILTER (WHERE t = 'paragraph') AS n_paragraphs, count(*) FILTER (WHERE t = 'section_break') AS n_section_breaks,
  arg_max(end_index, pos) AS total_length, CAST(sum(size) FILTER (WHERE t = 'table') AS BIGINT) AS n_table_cells,
  max(size) FILTER (WHERE t = 'table') AS largest_table, any_value(lang = 'en') AS has_headers, any_value(source = 'src1') AS has_footers
FROM e JOIN documents d ON d.doc_id = e.doc_id GROUP BY e.doc_id""",
    "g2_used_range": f"""
WITH {b.CELLS_SQL},
r AS (SELECT sheet_id, CAST(min(row + sheet_id % 3) AS INTEGER) AS r0, min(col) AS c0, CAST(max(row + sheet_id % 3) AS INTEGER) AS r1, max(col) AS c1 FROM cells GROUP BY 1)
SELECT *, CAST((r1 - r0 + 1) * (c1 - c0 + 1) AS BIGINT) AS n_cells, chr(65 + c0) || (r0 + 1) AS start, chr(65 + c0) || (r0 + 1) ||
  CASE WHEN r0 = r1 AND c0 = c1 THEN '' ELSE ':' || chr(65 + c1) || (r1 + 1) END AS label FROM r""",
    "g3_profile_table": f"""
WITH {b.LINES_SQL},
r AS (SELECT doc_id AS table_id, CASE WHEN doc_id % 5 = 4 AND pos = 0 THEN 0 WHEN doc_id % 5 = 1 THEN len(string_split(text, ','))
      WHEN doc_id % 5 = 2 THEN 21 ELSE 2 END AS w, doc_id % 5 = 0 AND pos = 2 AS hole FROM raw_lines),
s AS (SELECT table_id, count(*) AS n_rows, count(*) FILTER (WHERE w = 0) AS n_empty_rows, CAST(min(w) AS INTEGER) AS min_width,
    CAST(max(w) AS INTEGER) AS max_width, count(*) FILTER (WHERE hole) AS n_rows_with_null FROM r GROUP BY 1
  UNION ALL SELECT -r_regionkey - 1, 0, 0, NULL, NULL, 0 FROM region)
SELECT *, CASE WHEN n_rows = 0 THEN 'empty table' WHEN n_empty_rows > 0 THEN 'empty rows' WHEN min_width <> max_width THEN 'ragged rows'
  WHEN n_rows > 1000 THEN 'too many rows' WHEN max_width > 20 THEN 'too many columns' WHEN n_rows_with_null > 0 THEN 'null cell' END AS reason
FROM s""",
    "g4_find_replace": r"""
SELECT doc_id, regexp_replace(text, '(?i)the ', '$1 \\The ', 'g') AS text,
  CAST(len(regexp_extract_all(text, '(?i)the ')) AS BIGINT) AS n_replaced FROM documents""",
    "g4_replace_totals": """
WITH n AS (SELECT len(regexp_extract_all(text, 'Le')) AS a, len(regexp_extract_all(text, '(?i)Le')) AS i FROM documents)
SELECT true AS match_case, count(*) FILTER (WHERE a > 0) AS n_docs, CAST(sum(a) AS BIGINT) AS n_replaced FROM n
UNION ALL SELECT false, count(*) FILTER (WHERE i > 0), CAST(sum(i) AS BIGINT) FROM n""",
    "g5_outcome_summary": f"""
WITH {b.SHARES_SQL}, o AS (SELECT *, coalesce(reason, 'ok') AS outcome FROM checked)
SELECT batch_id, outcome, count(*) FILTER (WHERE reason IS NULL) AS n_ok, count(reason) AS n_failed,
  CAST(CASE WHEN grouping(batch_id, outcome) = 0 THEN 0 WHEN grouping(batch_id, outcome) = 1 THEN 1 ELSE 2 END AS INTEGER) AS level
FROM o GROUP BY ROLLUP (batch_id, outcome)""",
    "g5_reply_summary": """
SELECT c_nationkey AS batch_id, count(*) AS n_replies, count(*) FILTER (WHERE c_acctbal > 1000) AS n_created FROM customer GROUP BY 1""",
    "g6_label_catalog": """
WITH l AS (SELECT DISTINCT lang AS label, CASE WHEN lang = 'en' THEN 'system' ELSE 'user' END AS kind FROM documents
  UNION ALL SELECT r_name, 'user' FROM region)
SELECT label, kind, (SELECT count(*) FROM documents WHERE lang = label OR source = label) AS n_items FROM l""",
    "g7_task_rollup": f"""
WITH RECURSIVE {TASKS_SQL}
SELECT root, count(*) FILTER (WHERE NOT is_placeholder AND n.id <> root) AS n_subtasks, max(depth) AS max_depth,
  round(count(*) FILTER (WHERE NOT is_placeholder AND completed) / count(*) FILTER (WHERE NOT is_placeholder), 6) AS completed_share,
  min(due) AS earliest_due, bool_or(is_placeholder) AS orphaned
FROM nodes n JOIN walk USING (id) GROUP BY root""",
    "g8_facet_counts": """
SELECT 'lang' AS facet, lang AS value, count(*) AS n_hits FROM documents GROUP BY lang
UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source
UNION ALL SELECT '(all)', NULL, count(*) FROM documents""",
    "g9_execution_metrics": f"""
WITH {RUNS_SQL},
d AS (SELECT 'DAILY' AS grain, date_trunc('day', ts) AS start_time, date_trunc('day', ts) + INTERVAL 1 DAY AS end_time, * FROM runs
  UNION ALL SELECT 'WEEKLY', date_trunc('week', ts), date_trunc('week', ts) + INTERVAL 7 DAY, * FROM runs)
SELECT grain, CAST(start_time AS TIMESTAMP) AS start_time, CAST(end_time AS TIMESTAMP) AS end_time, count(DISTINCT user_id) AS active_users,
  count(*) AS total_executions, count(*) FILTER (WHERE failed) AS failed_executions FROM d GROUP BY 1, 2, 3""",
    "g9_stream_execution_metrics": f"""
WITH {RUNS_SQL}
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS start_time, CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS TIMESTAMP) AS end_time,
  count(*) AS total_executions, count(*) FILTER (WHERE failed) AS failed_executions FROM runs
WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM runs) - INTERVAL 1 HOUR GROUP BY 1, 2""",
    "g9_stream_buckets": f"""
WITH {RUNS_SQL},
d AS (SELECT 'DAILY' AS grain, date_trunc('day', ts) AS start_time, date_trunc('day', ts) + INTERVAL 1 DAY AS end_time, * FROM runs
  UNION ALL SELECT 'WEEKLY', date_trunc('week', ts), date_trunc('week', ts) + INTERVAL 7 DAY, * FROM runs)
SELECT grain, CAST(start_time AS TIMESTAMP) AS start_time, CAST(end_time AS TIMESTAMP) AS end_time, true AS users_near,
  count(*) AS total_executions, count(*) FILTER (WHERE failed) AS failed_executions FROM d GROUP BY 1, 2, 3""",
    "g10_execution_status": f"""
WITH {RUNS_SQL}
SELECT f AS function_name, s AS status, count(*) AS n_runs, round(avg(secs), 6) AS avg_seconds,
  round(quantile_cont(secs, 0.95), 6) AS p95_seconds FROM runs GROUP BY 1, 2""",
    "g11_gradient_points": """
WITH c AS (SELECT l_suppkey AS sheet_id, l_orderkey AS row, l_linenumber AS col, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS value,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS v FROM lineitem
  WHERE l_linenumber BETWEEN 1 AND 5 AND (l_suppkey % 2 <> 0 OR l_orderkey >= 100)),
p AS (SELECT sheet_id, sheet_id % 3 AS k, min(v) AS lo, max(v) AS hi, quantile_cont(v, 0.35) AS q35, quantile_cont(v, 0.95) AS q95 FROM c GROUP BY 1),
s AS (SELECT sheet_id,
  CASE k WHEN 2 THEN lo + 0.1 * (hi - lo) ELSE lo END AS a0, CASE k WHEN 0 THEN hi WHEN 1 THEN q35 ELSE 40000 END AS a1,
  CASE k WHEN 2 THEN q95 ELSE hi END AS a2,
  CASE k WHEN 0 THEN [16, 32, 48] WHEN 1 THEN [255, 0, 0] ELSE [255, 255, 255] END AS c0,
  CASE k WHEN 0 THEN [240, 224, 209] WHEN 1 THEN [0, 255, 7] ELSE [136, 136, 136] END AS c1,
  CASE k WHEN 0 THEN [240, 224, 209] WHEN 1 THEN [0, 0, 255] ELSE [1, 2, 3] END AS c2 FROM p),
x AS (SELECT c.*, list_transform([1, 2, 3], lambda i: CAST(round_even(CASE WHEN v <= a0 THEN c0[i] / 255.0 WHEN v >= a2 THEN c2[i] / 255.0
    WHEN v <= a1 THEN c0[i] / 255.0 + (v - a0) / (a1 - a0) * (c1[i] / 255.0 - c0[i] / 255.0)
    ELSE c1[i] / 255.0 + (v - a1) / (a2 - a1) * (c2[i] / 255.0 - c1[i] / 255.0) END * 255, 0) AS BIGINT)) AS rgb
  FROM c JOIN s USING (sheet_id))
SELECT sheet_id, row, col, value, sheet_id AS rule_idx, printf('#%02X%02X%02X', rgb[1], rgb[2], rgb[3]) AS color FROM x""",
    "g12_comment_threads": """
SELECT conv_id // 10 AS file_id, conv_id AS comment_id, CASE WHEN role <> 'system' THEN role ELSE 'Unknown' END AS author, text AS content,
  '' AS anchor, false AS resolved, (SELECT count(*) FROM conversations r WHERE r.conv_id = c.conv_id AND r.turn > 0) AS n_replies,
  (SELECT max(turn) FROM conversations r WHERE r.conv_id = c.conv_id AND r.turn > 0) AS last_reply
FROM conversations c WHERE turn = 0 AND conv_id % 4 <> 0""",
    "g12_comment_replies": """
SELECT c.conv_id // 10 AS file_id, c.conv_id AS comment_id, CASE WHEN c.role <> 'system' THEN c.role ELSE 'Unknown' END AS author,
  c.text AS content, CAST(NULL AS VARCHAR) AS created, c.conv_id % 4 = 0 AS resolved, r.turn AS reply_id,
  CASE WHEN r.turn IS NULL THEN NULL WHEN r.role <> 'system' THEN r.role ELSE 'Unknown' END AS reply_author,
  CASE WHEN r.turn % 3 = 0 THEN '' ELSE r.text END AS reply_content, r.turn AS reply_created
FROM conversations c LEFT JOIN conversations r ON r.conv_id = c.conv_id AND r.turn > 0 WHERE c.turn = 0""",
    "g12_comment_share": """
SELECT conv_id // 10 AS file_id, count(*) AS n_comments, count(*) FILTER (WHERE conv_id % 4 <> 0) AS n_open,
  round(count(*) FILTER (WHERE conv_id % 4 <> 0) / count(*), 6) AS open_share FROM conversations WHERE turn = 0 GROUP BY 1""",
    "g13_form_response_counts": f"""
WITH {ANSWERS_SQL}
SELECT form_id, response_id, count(*) AS n_answers,
  4 - count(*) FILTER (WHERE given AND question_id IN ('role', 'long', 'even')) AS n_required_missing FROM answers GROUP BY 1, 2""",
    "g13_question_rates": f"""
WITH {ANSWERS_SQL},
q AS (SELECT DISTINCT role AS form_id, unnest(['role', 'opening', 'long', 'even', 'never']) AS question_id FROM conversations)
SELECT form_id, question_id, question_id <> 'opening' AS required,
  (SELECT count(*) FROM conversations WHERE role = form_id) AS n_responses,
  (SELECT count(*) FROM answers a WHERE a.form_id = q.form_id AND a.question_id = q.question_id AND given) AS n_answered,
  round((SELECT count(*) FROM answers a WHERE a.form_id = q.form_id AND a.question_id = q.question_id AND given)
    / (SELECT count(*) FROM conversations WHERE role = form_id), 6) AS answered_rate FROM q""",
    "t1_task_tree": f"""
WITH RECURSIVE {TASKS_SQL}, n AS (SELECT id, depth, root, row_number() OVER (ORDER BY path) AS place FROM walk),
b AS (SELECT id, count(*) AS n_below FROM (SELECT unnest(above) AS id FROM walk) GROUP BY 1),
c AS (SELECT id, id AS cycle_id FROM keyed WHERE parent = id UNION ALL SELECT k.id, c.cycle_id FROM keyed k JOIN c ON k.parent = c.id AND k.parent <> k.id)
SELECT k.id, parent, depth, root, place, CASE WHEN place IS NOT NULL THEN coalesce(n_below, 0) END AS n_below, is_placeholder, coalesce(c.id IS NOT NULL AND parent = k.id, false) AS in_cycle, coalesce(c.id IS NOT NULL AND parent <> k.id, false) AS below_cycle, cycle_id
FROM keyed k LEFT JOIN n ON n.id = k.id LEFT JOIN c ON c.id = k.id LEFT JOIN b ON b.id = k.id""",
    "p14_document_tabs_text": f"""
WITH RECURSIVE {b.LINES_SQL},
tabs AS (SELECT doc_id, pos AS tab_id, CASE WHEN pos > 0 THEN (pos - 1) // 2 END AS parent_id, text,
  lpad(CAST(100 - pos % 7 AS VARCHAR), 20, '0') || ':' || pos AS seg FROM raw_lines),
walk AS (SELECT doc_id, tab_id, 0 AS depth, seg AS path, text FROM tabs WHERE parent_id IS NULL
  UNION ALL SELECT t.doc_id, t.tab_id, w.depth + 1, w.path || ' ' || t.seg, t.text FROM tabs t
  JOIN walk w ON w.doc_id = t.doc_id AND w.tab_id = t.parent_id),
parts AS (SELECT doc_id, '0' AS place, text AS part FROM documents WHERE trim(text) <> ''
  UNION ALL SELECT doc_id, '1' || path, chr(10) || '--- TAB: ' || CASE WHEN depth > 0 THEN repeat('    ', depth) || 'T' || tab_id
    || ' ( ID: ' || tab_id || ')' ELSE 'T' || tab_id END || ' ---' || chr(10) || text FROM walk)
SELECT doc_id, string_agg(part, '' ORDER BY place) AS text FROM parts GROUP BY doc_id""",
}
