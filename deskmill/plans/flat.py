"""Registered queries of the flat filters and of paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskmill.functions.sharing import permission_sentence
from deskmill.operators import filters, paging
from deskmill.plans import bindings as b
from deskmill.sources.tables import read_table

NOW = "2024-01-30T00:00:00Z"


def _files(spark, d):
    return read_table(spark, d, "documents").select(
        "doc_id", "lang", "source", "n_chars", "text",
        F.array("source", F.lit("root")).alias("parents"),
        (F.col("n_chars") > 1000).alias("starred"),
    )


def _filter_files(spark, d):
    conditions = [
        ("lang", "=", "en"), ("source", "!=", "src3"), ("n_chars", ">", 300), ("n_chars", "<", 9000),
        ("text", "contains", "the"), ("parents", "in", "root"), ("starred", "=", False),
    ]
    return filters.filter_files(_files(spark, d), conditions).select("doc_id", "source", "n_chars")


def _fulltext(spark, d):
    docs = read_table(spark, d, "documents")
    return filters.fulltext_contains(docs, ["text", "source"], "THE the").select("doc_id", "lang")


def _phrases(spark, d):
    """Beginnings of benchmark items, names of nations, and sources."""

    def named(rows, mark, key, phrase):
        return rows.select(F.concat(F.lit(mark), F.col(key).cast("string")).alias("phrase_id"), phrase.alias("phrase"))

    docs = read_table(spark, d, "documents").select("doc_id", "text", "source")
    phrases = named(read_table(spark, d, "benchmark"), "start ", "item_id", F.substring("text", 1, 25))
    phrases = phrases.unionByName(named(read_table(spark, d, "nation"), "name ", "n_nationkey", F.col("n_name")))
    phrases = phrases.unionByName(named(docs.select("source").distinct(), "source ", "source", F.upper("source")))
    return filters.fulltext_phrases(docs, ["text", "source"], phrases, "doc_id").select("doc_id", "phrase_id")


def _time_range(spark, d):
    events = read_table(spark, d, "events")
    bounded = filters.time_range(events, "ts", NOW, "2024-01-10", "2024-01-20T06:30:00+02:00")
    upcoming = filters.time_range(events, "ts", NOW)
    return bounded.unionByName(upcoming).select("event_id", "ts")


def _tasks(spark, d):
    o = read_table(spark, d, "orders")
    priority = F.col("o_orderpriority")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", "completed").otherwise("needsAction").alias("status"),
        (priority == "5-LOW").alias("deleted"),
        F.when(priority == "4-NOT SPECIFIED", F.lit(True)).alias("hidden"),
        (F.col("o_custkey") % 10 == 0).alias("assigned"),
        F.col("o_orderdate").alias("due"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("completed"),
        F.col("o_orderdate").alias("updated"),
    )


def _filter_tasks(spark, d):
    tasks = _tasks(spark, d)
    open_ones = filters.filter_tasks(
        tasks, show_completed=False, show_assigned=True, due_min="1996-01-01", due_max="1999-12-31"
    )
    done = filters.filter_tasks(
        tasks, show_deleted=True, show_hidden=True, completed_min="1997-01-01T00:00:00Z",
        completed_max="1998-01-01T00:00:00Z", updated_min="1997-06-01",
    )
    return open_ones.withColumn("part", F.lit("open")).unionByName(done.withColumn("part", F.lit("done"))).select(
        "part", "id", "due"
    )


def _relative_date(spark, d):
    events = read_table(spark, d, "events")
    parts = [
        filters.relative_date(events, "ts", spec, now).select(F.lit(spec).alias("spec"), "event_id")
        for spec, now in (("d5", NOW), ("w2", NOW), ("m1", "2024-02-15"), ("y1", "2025-01-20"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def _site_filter(spark, d):
    pages = read_table(spark, d, "pages").select("page_id", "url")
    sites = ["example.com", "spam-farm.example.org"]
    kept = filters.site_filter(pages, "url", sites)
    dropped = filters.site_filter(pages, "url", ["example.com", "example.net"], "exclude")
    return kept.withColumn("mode", F.lit("include")).unionByName(dropped.withColumn("mode", F.lit("exclude")))


def _condition_rules(spark, d):
    """One rule per order, on the cells of that order."""
    # The kinds of conditions.
    kinds = [
        "NUMBER_GREATER", "NUMBER_GREATER_THAN_EQ", "NUMBER_LESS", "NUMBER_LESS_THAN_EQ", "NUMBER_EQ",
        "NUMBER_NOT_EQ", "TEXT_CONTAINS", "TEXT_NOT_CONTAINS", "TEXT_STARTS_WITH", "TEXT_ENDS_WITH",
        "TEXT_EQ", "DATE_BEFORE", "DATE_ON_OR_BEFORE", "DATE_AFTER", "DATE_ON_OR_AFTER", "DATE_EQ",
        "DATE_NOT_EQ", "DATE_BETWEEN", "DATE_NOT_BETWEEN", "NOT_BLANK", "BLANK", "ONE_OF_RANGE",
    ]
    k = F.col("o_orderkey")
    kind = F.element_at(F.array(*[F.lit(x) for x in kinds]), (k % 22 + 1).cast("int"))
    day = F.col("o_orderdate").cast("date")
    value = (
        F.when(F.startswith(kind, F.lit("NUMBER")), F.array(F.lit("25")))
        .when(F.startswith(kind, F.lit("TEXT")), F.array(F.lit("A")))
        .otherwise(F.array(day.cast("string"), F.date_add(day, 400).cast("string")))
    )
    nothing = F.lit(None).cast("bigint")
    return read_table(spark, d, "orders").select(
        k.alias("rule_idx"), k.alias("sheet_id"), kind.alias("type"), value.alias("values"),
        F.when(k % 5 != 0, F.col("o_custkey") % 3).alias("r0"),
        F.when(k % 3 != 0, F.col("o_custkey") % 3 + 3).alias("r1"),
        F.when(k % 2 == 0, F.lit(0)).cast("int").alias("c0"),
        F.when(k % 7 != 0, F.lit(5)).cast("int").alias("c1"),
        (k - 1).alias("src_sheet"), nothing.alias("src_r0"), F.lit(6).cast("bigint").alias("src_r1"),
        F.lit(0).alias("src_c0"), F.lit(4).alias("src_c1"),
    )


def _publicly_shared(spark, d):
    return filters.publicly_shared(b.shared_files(spark, d), ["owner", "mime_type"])


def _permission_list(spark, d):
    files = b.shared_files(spark, d)
    return files.select("id", F.explode("permissions").alias("p")).select(
        "id", permission_sentence(F.col("p")).alias("permission")
    )


def _validate_shares(spark, d):
    return filters.validate_shares(b.share_requests(spark, d))


def _latest(spark, d):
    files = read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("mime_type"),
        (F.col("o_orderstatus") == "F").alias("trashed"), F.col("o_orderdate").alias("modified_time"),
    )
    return paging.latest_files(files, "1-URGENT", 25).select("id", "modified_time")


def _page_after(spark, d):
    events = read_table(spark, d, "events").select("event_id", "event_type")
    return paging.page_after(events, "event_id", 99, 40)


def _page_positions(spark, d):
    events = read_table(spark, d, "events").select("event_id", "event_type")
    return paging.page_positions(events, "event_id", 11, 10)


def _top_per_group(spark, d):
    talk = read_table(spark, d, "conversations")
    spaces = talk.select(
        F.col("conv_id").alias("space"),
        F.concat(F.lit("Space "), F.col("conv_id").cast("string")).alias("space_name"),
    ).distinct()
    messages = talk.select(
        F.col("conv_id").alias("space"), F.col("turn").alias("message_id"),
        F.col("turn").alias("create_time"), "text",
    )
    return paging.top_per_group(messages, spaces, "LE", groups=10, k=5).select(
        "space", "space_name", "message_id", "place", "text"
    )


def _preview(spark, d):
    lines = read_table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    return paging.preview_with_overflow(lines, "l_suppkey", ["l_orderkey", "l_linenumber", "l_partkey"], 50)


QUERIES = {
    "f1_filter_files": _filter_files,
    "f2_fulltext_contains": _fulltext,
    "f2_fulltext_phrases": _phrases,
    "f3_time_range": _time_range,
    "f4_filter_tasks": _filter_tasks,
    "f5_relative_date": _relative_date,
    "f6_site_filter": _site_filter,
    "f7_rows_with_error_tokens": lambda s, d: filters.rows_with_error_tokens(b.sheet_cells(s, d)),
    "f7_error_cells": lambda s, d: filters.error_cells(b.sheet_cells(s, d)),
    "f8_cell_conditions": lambda s, d: filters.cell_conditions(b.sheet_cells(s, d), _condition_rules(s, d)),
    "f9_publicly_shared": _publicly_shared,
    "f9_permission_list": _permission_list,
    "f10_validate_shares": _validate_shares,
    "l1_latest_files": _latest,
    "l2_page_after": _page_after,
    "l2_page_positions": _page_positions,
    "l3_top_per_group": _top_per_group,
    "l4_preview_with_overflow": _preview,
}

ORACLES = {
    "f1_filter_files": """
SELECT doc_id, source, n_chars FROM documents WHERE lang = 'en' AND source <> 'src3' AND n_chars > 300
  AND n_chars < 9000 AND contains(text, 'the') AND NOT n_chars > 1000""",
    "f2_fulltext_contains": "SELECT doc_id, lang FROM documents WHERE lower(text) LIKE '%the the%' OR lower(source) LIKE '%the the%'",
    "f2_fulltext_phrases": """
WITH p AS (SELECT 'start ' || item_id AS phrase_id, substr(text, 1, 25) AS phrase FROM benchmark
           UNION ALL SELECT 'name ' || n_nationkey, n_name FROM nation UNION ALL SELECT 'source ' || source, upper(source) FROM (SELECT DISTINCT source FROM documents))
SELECT doc_id, phrase_id FROM documents d JOIN p ON phrase <> '' AND (contains(lower(d.text), lower(phrase)) OR contains(lower(d.source), lower(phrase)))""",
    "f3_time_range": """
SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 04:30:00'
UNION ALL SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00'""",
    "f4_filter_tasks": """
SELECT 'open' AS part, o_orderkey AS id, o_orderdate AS due FROM orders WHERE o_orderstatus <> 'F'
  AND o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')
  AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate < TIMESTAMP '2000-01-01 00:00:00'
UNION ALL
SELECT 'done', o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 10 <> 0
  AND o_orderdate >= TIMESTAMP '1997-06-01 00:00:00' AND o_orderdate < TIMESTAMP '1998-01-01 00:00:00'""",
    "f5_relative_date": """
SELECT 'd5' AS spec, event_id FROM events WHERE ts >= TIMESTAMP '2024-01-25 00:00:00'
UNION ALL SELECT 'w2', event_id FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'
UNION ALL SELECT 'm1', event_id FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'
UNION ALL SELECT 'y1', event_id FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'""",
    "f6_site_filter": """
WITH h AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) AS host FROM pages)
SELECT page_id, url, 'include' AS mode FROM h WHERE host = 'example.com' OR host LIKE '%.example.com'
  OR host = 'spam-farm.example.org' OR host LIKE '%.spam-farm.example.org'
UNION ALL
SELECT page_id, url, 'exclude' FROM h WHERE NOT (host = 'example.com' OR host LIKE '%.example.com'
  OR host = 'example.net' OR host LIKE '%.example.net')""",
    "f7_rows_with_error_tokens": f"""
WITH {b.CELLS_SQL},
t AS (SELECT *, upper(trim(value)) AS v FROM cells),
e AS (SELECT *, v = '#N/A' OR (v LIKE '#%' AND (v LIKE '%!' OR v LIKE '%?')) AS bad FROM t)
SELECT sheet_id, bool_or(bad) AS has_errors, count(*) FILTER (WHERE bad) AS n_errors,
  min(chr(65 + col) || (row + 1)) FILTER (WHERE bad) AS first_error FROM e GROUP BY sheet_id""",
    "f7_error_cells": f"""
WITH {b.CELLS_SQL}
SELECT *, chr(65 + col) || (row + 1) AS cell FROM cells WHERE upper(trim(value)) = '#N/A'
  OR (trim(value) LIKE '#%' AND (trim(value) LIKE '%!' OR trim(value) LIKE '%?'))""",
    "f8_cell_conditions": f"""
WITH {b.CELLS_SQL},
kinds AS (SELECT ['NUMBER_GREATER', 'NUMBER_GREATER_THAN_EQ', 'NUMBER_LESS', 'NUMBER_LESS_THAN_EQ', 'NUMBER_EQ',
  'NUMBER_NOT_EQ', 'TEXT_CONTAINS', 'TEXT_NOT_CONTAINS', 'TEXT_STARTS_WITH', 'TEXT_ENDS_WITH', 'TEXT_EQ',
  'DATE_BEFORE', 'DATE_ON_OR_BEFORE', 'DATE_AFTER', 'DATE_ON_OR_AFTER', 'DATE_EQ', 'DATE_NOT_EQ', 'DATE_BETWEEN',
  'DATE_NOT_BETWEEN', 'NOT_BLANK', 'BLANK', 'ONE_OF_RANGE'] AS k),
rules AS (SELECT o_orderkey AS rule_idx, k[o_orderkey % 22 + 1] AS type,
    CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey % 3 END AS r0, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey % 3 + 3 END AS r1,
    CASE WHEN o_orderkey % 2 = 0 THEN 0 END AS c0, CASE WHEN o_orderkey % 7 <> 0 THEN 5 END AS c1,
    CAST(o_orderdate AS DATE) AS d1, CAST(o_orderdate AS DATE) + 400 AS d2 FROM orders, kinds),
m AS (SELECT c.*, r.*, try_cast(value AS DOUBLE) AS n, try_cast(value AS DATE) AS d FROM cells c JOIN rules r
  ON c.sheet_id = r.rule_idx AND row >= coalesce(r0, row) AND row < coalesce(r1, row + 1)
  AND col >= coalesce(c0, col) AND col < coalesce(c1, col + 1))
SELECT sheet_id, row, col, value, rule_idx FROM m WHERE CASE type
  WHEN 'NUMBER_GREATER' THEN n > 25 WHEN 'NUMBER_GREATER_THAN_EQ' THEN n >= 25 WHEN 'NUMBER_LESS' THEN n < 25
  WHEN 'NUMBER_LESS_THAN_EQ' THEN n <= 25 WHEN 'NUMBER_EQ' THEN n = 25 WHEN 'NUMBER_NOT_EQ' THEN n <> 25
  WHEN 'TEXT_CONTAINS' THEN contains(value, 'A') WHEN 'TEXT_NOT_CONTAINS' THEN NOT contains(value, 'A')
  WHEN 'TEXT_STARTS_WITH' THEN value LIKE 'A%' WHEN 'TEXT_ENDS_WITH' THEN value LIKE '%A' WHEN 'TEXT_EQ' THEN value = 'A'
  WHEN 'DATE_BEFORE' THEN d < d1 WHEN 'DATE_ON_OR_BEFORE' THEN d <= d1 WHEN 'DATE_AFTER' THEN d > d1
  WHEN 'DATE_ON_OR_AFTER' THEN d >= d1 WHEN 'DATE_EQ' THEN d = d1 WHEN 'DATE_NOT_EQ' THEN d <> d1
  WHEN 'DATE_BETWEEN' THEN d BETWEEN d1 AND d2 WHEN 'DATE_NOT_BETWEEN' THEN d NOT BETWEEN d1 AND d2
  WHEN 'NOT_BLANK' THEN coalesce(value, '') <> '' WHEN 'BLANK' THEN coalesce(value, '') = ''
  WHEN 'ONE_OF_RANGE' THEN EXISTS (SELECT 1 FROM cells s WHERE s.sheet_id = m.rule_idx - 1 AND s.value = m.value
       AND s.row < 6 AND s.col < 4) END""",
    "f9_publicly_shared": """
SELECT c_nationkey AS owner, c_mktsegment AS mime_type, count(*) AS n_files,
  count(*) FILTER (WHERE c_custkey % 4 = 0 AND c_custkey % 3 < 2) AS n_public,
  round(count(*) FILTER (WHERE c_custkey % 4 = 0 AND c_custkey % 3 < 2) / count(*), 6) AS public_share
FROM customer GROUP BY 1, 2""",
    "f9_permission_list": """
WITH r AS (SELECT *, CASE c_custkey % 3 WHEN 0 THEN 'writer' WHEN 1 THEN 'reader' ELSE 'owner' END AS role FROM customer)
SELECT c_custkey AS id, 'User: ' || lower(c_name) || ' (writer) [id: u' || c_custkey || '] | inherited from: root' AS permission
FROM r WHERE c_custkey % 4 IN (0, 2)
UNION ALL SELECT c_custkey, 'Anyone with the link (' || role || ') [id: a' || c_custkey || ']' FROM r WHERE c_custkey % 4 = 0
UNION ALL SELECT c_custkey, 'Domain: example.com (' || role || ') [id: d' || c_custkey || '] | expires: 2030-01-01'
FROM r WHERE c_custkey % 4 = 1""",
    "f10_validate_shares": f"WITH {b.SHARES_SQL} SELECT * FROM checked",
    "l1_latest_files": """
SELECT o_orderkey AS id, o_orderdate AS modified_time FROM orders WHERE o_orderpriority = '1-URGENT'
  AND o_orderstatus <> 'F' ORDER BY o_orderdate DESC, o_orderkey LIMIT 25""",
    "l2_page_after": """
SELECT event_id, event_type, (SELECT count(*) FROM events WHERE event_id > 99) > 40 AS has_more
FROM events WHERE event_id > 99 ORDER BY event_id LIMIT 40""",
    "l2_page_positions": "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 10 OFFSET 10",
    "l3_top_per_group": """
WITH s AS (SELECT DISTINCT conv_id FROM conversations ORDER BY conv_id LIMIT 10),
h AS (SELECT conv_id AS space, turn AS message_id, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS place
  FROM conversations JOIN s USING (conv_id) WHERE lower(text) LIKE '%le%')
SELECT space, 'Space ' || space AS space_name, message_id, CAST(place AS INTEGER) AS place,
  CASE WHEN length(text) > 100 THEN left(text, 100) || '...' ELSE text END AS text FROM h WHERE place <= 5""",
    "l4_preview_with_overflow": """
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, CAST(place AS INTEGER) AS place, greatest(n - 50, 0) AS n_more
FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS place,
  count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem) WHERE place <= 50""",
}
