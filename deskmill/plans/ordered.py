"""Registered queries of the ordered operators (threads, rendering, calendars)."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskmill.functions.times import literal_instant
from deskmill.operators import windows
from deskmill.plans import bindings as b
from deskmill.sources.tables import read_table

TMIN, TMAX = "2024-01-05T00:00:00Z", "2024-01-25T12:00:00Z"


def _threads(spark, d):
    talk = read_table(spark, d, "conversations")
    first_word = F.split("text", " ")[0]
    messages = talk.select(
        F.col("conv_id").alias("thread_id"),
        F.col("turn").alias("pos"),
        F.when(F.col("role") != "system", F.col("role")).alias("sender"),
        F.lit(None).cast("string").alias("date"),
        F.when(~F.startswith("text", F.lit("E")), first_word).alias("subject"),
    )
    return windows.assemble_threads(messages)


def _numbering(spark, d):
    return windows.list_numbering(b.flagged_elements(spark, d)).select(
        "doc_id", "pos", "type", "is_blank", "is_item", "resets", "item_no"
    )


def _markdown(spark, d):
    e = b.flagged_elements(spark, d)
    text = F.col("text")

    def run(content, bold=False, italic=False, strike=False, font=None, url=None):
        return F.struct(
            content.alias("content"),
            F.lit(bold).alias("bold"),
            F.lit(italic).alias("italic"),
            F.lit(strike).alias("strikethrough"),
            F.lit(font).cast("string").alias("font"),
            F.lit(url).cast("string").alias("url"),
        )

    head, tail = F.split_part(text, F.lit(" "), F.lit(1)), F.substr(text, F.locate(" ", text))
    broken = F.locate(" ", text) > 0
    runs = (
        F.when(~broken, F.array(run(text, bold=True)))
        .when(F.col("pos") % 5 == 0, F.array(run(head, bold=True), run(tail)))
        .when(F.col("pos") % 5 == 1, F.array(run(head, italic=True, strike=True), run(tail)))
        .when(F.col("pos") % 5 == 2, F.array(run(head, font="Consolas"), run(tail)))
        .when(F.col("pos") % 5 == 3, F.array(run(head, True, True, url="http://x.example/"), run(tail)))
        .otherwise(F.array(run(text)))
    )
    plain_run = lambda c: F.array(F.array(run(c)))
    rows = F.when(
        F.col("type") == "table",
        F.transform(
            F.split(text, r"\. "),
            lambda sentence: F.transform(F.split(sentence, ","), plain_run),
        ),
    )
    style = (
        F.when(F.col("pos") == 0, "TITLE").when(F.col("pos") % 10 == 4, "HEADING_2").otherwise("NORMAL_TEXT")
    )
    shaped = e.withColumns({"runs": runs, "style": style, "table_rows": rows})
    return windows.render_markdown(shaped)


def _bounds():
    return literal_instant(TMIN), literal_instant(TMAX)


def _free_busy(spark, d):
    entries = b.calendar_events(spark, d)
    people = read_table(spark, d, "customer").select(F.col("c_custkey").alias("calendar_id"))
    return windows.free_busy(entries, *_bounds(), calendars=people)


def _free_gaps(spark, d):
    busy = windows.free_busy(b.calendar_events(spark, d), *_bounds())
    return windows.free_gaps(busy, *_bounds())


def _free_gaps_all(spark, d):
    """W5 as the complement of W4: a calendar without a busy interval is free over the whole range."""
    return windows.free_gaps(_free_busy(spark, d), *_bounds())


def _first_table(spark, d):
    cells = b.document_lines(spark, d).select("doc_id", F.col("pos").alias("table_idx"), "text")
    return windows.find_first_table(cells, "THE")


QUERIES = {
    "w1_assemble_threads": _threads,
    "w2_list_numbering": _numbering,
    "w3_render_markdown": _markdown,
    "w4_free_busy": _free_busy,
    "w5_free_gaps": _free_gaps,
    "w5_free_gaps_all_calendars": _free_gaps_all,
    "w6_find_first_table": _first_table,
}

BUSY_SQL = (
    b.CALENDAR_SQL
    + """,
clipped AS (
  SELECT calendar_id, event_id, greatest(start_ts, TIMESTAMP '2024-01-05 00:00:00') AS start_ts,
         least(end_ts, TIMESTAMP '2024-01-25 12:00:00') AS end_ts FROM entries),
marked AS (
  SELECT *, CASE WHEN start_ts <= max(end_ts) OVER (PARTITION BY calendar_id ORDER BY start_ts, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens
  FROM clipped WHERE start_ts < end_ts),
islands AS (
  SELECT *, sum(opens) OVER (PARTITION BY calendar_id ORDER BY start_ts, event_id) AS island FROM marked),
busy AS (
  SELECT calendar_id, min(start_ts) AS start_ts, max(end_ts) AS end_ts, count(*) AS n_events
  FROM islands GROUP BY calendar_id, island)
"""
)

GAPS_SQL = """
gaps AS (
  SELECT calendar_id, coalesce(lag(end_ts) OVER (PARTITION BY calendar_id ORDER BY start_ts),
           TIMESTAMP '2024-01-05 00:00:00') AS free_from, start_ts AS free_to FROM busy
  UNION ALL
  SELECT calendar_id, max(end_ts), TIMESTAMP '2024-01-25 12:00:00' FROM busy GROUP BY calendar_id)
"""

ORACLES = {
    "w1_assemble_threads": """
WITH m AS (SELECT conv_id AS thread_id, turn AS pos,
    CASE WHEN role <> 'system' THEN role ELSE '(unknown sender)' END AS sender, '(unknown date)' AS date,
    CASE WHEN text LIKE 'E%' THEN '(no subject)' ELSE split_part(text, ' ', 1) END AS s FROM conversations),
t AS (SELECT *, row_number() OVER (PARTITION BY thread_id ORDER BY pos) AS message_no,
    count(*) OVER (PARTITION BY thread_id) AS n_messages,
    first_value(s) OVER (PARTITION BY thread_id ORDER BY pos) AS thread_subject FROM m)
SELECT thread_id, pos, sender, date, nullif(s, thread_subject) AS subject, message_no, n_messages,
  thread_subject FROM t""",
    "w2_list_numbering": f"""
WITH {b.ELEMENTS_SQL}
SELECT doc_id, pos, type, is_blank, is_item, resets, item_no FROM numbered""",
    "w3_render_markdown": f"""
WITH {b.ELEMENTS_SQL},
parts AS (SELECT *, strpos(text, ' ') AS cut FROM numbered WHERE NOT is_blank),
md AS (SELECT *, trim(CASE
    WHEN cut = 0 THEN '**' || text || '**'
    WHEN pos % 5 = 0 THEN '**' || left(text, cut - 1) || '**' || substr(text, cut)
    WHEN pos % 5 = 1 THEN '~~*' || left(text, cut - 1) || '*~~' || substr(text, cut)
    WHEN pos % 5 = 2 THEN '`' || left(text, cut - 1) || '`' || substr(text, cut)
    WHEN pos % 5 = 3 THEN '[***' || left(text, cut - 1) || '***](http://x.example/)' || substr(text, cut)
    ELSE text END) AS body FROM parts),
cells AS (SELECT doc_id, pos, i, len(list_transform(string_split(s, ','), lambda c: 1)) AS n,
    array_to_string(list_transform(string_split(s, ','), lambda c: replace(trim(c), '|', '\\|')), ' | ') AS line
  FROM (SELECT doc_id, pos, unnest(string_split(text, '. ')) AS s,
               unnest(range(len(string_split(text, '. ')))) AS i FROM parts WHERE type = 'table')),
tables AS (SELECT doc_id, pos, string_agg('| ' || line || ' |' ||
    CASE WHEN i = 0 THEN chr(10) || '|' || repeat(' --- |', n) ELSE '' END, chr(10) ORDER BY i) AS grid
  FROM cells GROUP BY doc_id, pos),
blocks AS (SELECT doc_id, pos,
    CASE WHEN type = 'table' THEN CASE WHEN resets THEN chr(10) ELSE '' END || grid || chr(10)
         WHEN is_item THEN repeat('   ', nesting) || item_no || '. ' || body
         ELSE CASE WHEN resets THEN chr(10) ELSE '' END
              || CASE WHEN pos = 0 THEN '# ' WHEN pos % 10 = 4 THEN '## ' ELSE '' END || body || chr(10) END AS block
  FROM md LEFT JOIN tables USING (doc_id, pos))
SELECT doc_id, rtrim(string_agg(block, chr(10) ORDER BY pos), chr(10)) || chr(10) AS markdown
FROM blocks GROUP BY doc_id""",
    "w4_free_busy": f"""
WITH {BUSY_SQL}
SELECT calendar_id, start_ts, end_ts, n_events FROM busy
UNION ALL
SELECT c_custkey, NULL, NULL, 0 FROM customer WHERE c_custkey NOT IN (SELECT calendar_id FROM busy)""",
    "w5_free_gaps": f"""
WITH {BUSY_SQL},
gaps AS (
  SELECT calendar_id, coalesce(lag(end_ts) OVER (PARTITION BY calendar_id ORDER BY start_ts),
           TIMESTAMP '2024-01-05 00:00:00') AS free_from, start_ts AS free_to FROM busy
  UNION ALL
  SELECT calendar_id, max(end_ts), TIMESTAMP '2024-01-25 12:00:00' FROM busy GROUP BY calendar_id)
SELECT * FROM gaps WHERE free_from < free_to""",
    "w5_free_gaps_all_calendars": f"""
WITH {BUSY_SQL},
{GAPS_SQL}
SELECT * FROM gaps WHERE free_from < free_to
UNION ALL
SELECT c_custkey, TIMESTAMP '2024-01-05 00:00:00', TIMESTAMP '2024-01-25 12:00:00' FROM customer
WHERE c_custkey NOT IN (SELECT calendar_id FROM busy)""",
    "w6_find_first_table": f"""
WITH {b.LINES_SQL}
SELECT doc_id, min(pos) AS table_idx FROM lines WHERE contains(lower(text), 'the') GROUP BY doc_id""",
}
