"""The given tables shaped into workspace entities, with the same shapes as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmill.operators.running import Running, by_position, running
from deskmill.session import durable_cut
from deskmill.sources.tables import read_table


def document_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Lines of the documents with half-open character positions: one paragraph per line."""
    docs = read_table(spark, directory, "documents").select("doc_id", "text")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text")).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), "text"
    )
    size = F.length("text").cast("bigint") + 1
    placed = running(lines, ["doc_id"], ["pos"], by_position("pos"), {"end0": Running("sum", size)})
    return placed.select(
        "doc_id",
        "pos",
        "text",
        (F.col("end0") - size + 1).alias("start_index"),
        (F.col("end0") + 1).alias("end_index"),
    )


LINES_SQL = """
raw_lines AS (
  SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos,
         unnest(string_split(text, chr(10))) AS text
  FROM documents),
lines AS (
  SELECT doc_id, pos, text,
         e - length(text) AS start_index, e + 1 AS end_index
  FROM (SELECT *, CAST(sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS e
        FROM raw_lines))
"""


def flagged_elements(spark: SparkSession, directory: str) -> DataFrame:
    """Document lines with planted kinds: tables, blank paragraphs, list items, plain paragraphs."""
    pos, doc = F.col("pos"), F.col("doc_id")
    is_table = pos % 13 == 6
    is_blank = ~is_table & (pos % 11 == 5)
    is_item = ~is_table & ~is_blank & (pos % 7 < 4)
    return document_lines(spark, directory).select(
        "doc_id",
        "pos",
        F.when(is_table, "table").otherwise("paragraph").alias("type"),
        F.when(is_blank, "").otherwise(F.col("text")).alias("text"),
        F.when(is_item, (doc % 2).cast("string")).alias("list_id"),
        F.when(is_item, pos % 2).otherwise(F.lit(0)).cast("int").alias("nesting"),
        is_item.alias("ordered"),
        "start_index",
        "end_index",
    )


def landed_elements(spark: SparkSession, directory: str) -> DataFrame:
    """Kinds and positions of ``flagged_elements`` as a table of its own, without the text.

    For queries that read the elements several times.
    """
    return durable_cut(
        flagged_elements(spark, directory).select("doc_id", "pos", "type", "start_index", "end_index")
    )


ELEMENTS_SQL = (
    LINES_SQL
    + """,
elements AS (
  SELECT doc_id, pos, start_index, end_index,
         CASE WHEN pos % 13 = 6 THEN 'table' ELSE 'paragraph' END AS type,
         CASE WHEN pos % 13 <> 6 AND pos % 11 = 5 THEN '' ELSE text END AS text,
         CASE WHEN pos % 13 <> 6 AND pos % 11 <> 5 AND pos % 7 < 4
              THEN CAST(doc_id % 2 AS VARCHAR) END AS list_id,
         CAST(CASE WHEN pos % 13 <> 6 AND pos % 11 <> 5 AND pos % 7 < 4 THEN pos % 2 ELSE 0 END AS INTEGER)
           AS nesting
  FROM lines),
flags AS (
  SELECT *, type = 'paragraph' AND trim(text) = '' AS is_blank,
         type = 'paragraph' AND trim(text) <> '' AND list_id IS NOT NULL AS is_item
  FROM elements),
resets AS (
  SELECT *, NOT is_blank AND NOT is_item
            AND coalesce(lag(is_item) OVER (PARTITION BY doc_id ORDER BY pos), false) AS resets
  FROM flags),
sections AS (
  SELECT *, sum(CAST(resets AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY pos) AS section FROM resets),
numbered AS (
  SELECT *, CASE WHEN is_item THEN CAST(sum(CAST(is_item AS INTEGER)) OVER (
             PARTITION BY doc_id, section, list_id, nesting ORDER BY pos) AS BIGINT) END AS item_no
  FROM sections)
"""
)


def calendar_events(spark: SparkSession, directory: str) -> DataFrame:
    """Events as calendar entries: the user is the calendar, ``value`` the length in minutes."""
    return read_table(spark, directory, "events").select(
        F.col("user_id").alias("calendar_id"),
        "event_id",
        F.col("ts").alias("start_ts"),
        F.expr("timestampadd(SECOND, cast(round(value * 60) as bigint), ts)").alias("end_ts"),
    )


CALENDAR_SQL = """
entries AS (
  SELECT user_id AS calendar_id, event_id, ts AS start_ts,
         ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS end_ts
  FROM events)
"""


def sheet_cells(spark: SparkSession, directory: str) -> DataFrame:
    """Order lines as sheets: the order is the sheet, the line number the row, five columns.

    Column 3 has planted error tokens. ``(order, line number)`` is not unique in the table, so
    lines are added up first.
    """
    return cells_of(order_lines(spark, directory))


def order_lines(spark: SparkSession, directory: str) -> DataFrame:
    """One row per (order, line number).

    A least text is found by sorting. Keys seldom come twice in a task of the scan, so the lines are dealt out first and sorted once, in
    partitions of the shuffle; a task of the scan holds nothing.
    """
    lines = read_table(spark, directory, "lineitem").select(
        F.col("l_orderkey").alias("sheet_id"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("row"),
        "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate",
    )
    return (
        lines.repartition("sheet_id", "row")
        .groupBy("sheet_id", "row")
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
            F.max("l_extendedprice").alias("price"),
            F.max("l_discount").alias("discount"),
            F.min("l_returnflag").alias("flag"),
            F.max("l_shipdate").alias("ship"),
        )
    )


def line_values() -> list:
    """The five cell values of an order line, as text."""
    sheet, row = F.col("sheet_id"), F.col("row")
    return [
        F.col("quantity").cast("string"),
        F.col("price").cast("decimal(12,2)").cast("string"),
        F.col("discount").cast("decimal(4,2)").cast("string"),
        F.when((sheet + row) % 97 == 0, "#REF!")
        .when((sheet + row) % 89 == 0, " #n/a ")
        .when((sheet + row) % 83 == 0, "#")
        .otherwise(F.col("flag")),
        F.col("ship").cast("date").cast("string"),
    ]


def cells_of(lines: DataFrame) -> DataFrame:
    return lines.select("sheet_id", "row", F.posexplode(F.array(*line_values())).alias("col", "value"))


CELLS_SQL = """
order_lines AS (
  SELECT l_orderkey AS sheet_id, CAST(l_linenumber - 1 AS BIGINT) AS row,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, max(l_extendedprice) AS price,
         max(l_discount) AS discount, min(l_returnflag) AS flag, max(l_shipdate) AS ship
  FROM lineitem GROUP BY 1, 2),
cells AS (
  SELECT sheet_id, row, CAST(unnest([0, 1, 2, 3, 4]) AS INTEGER) AS col, unnest([
    CAST(quantity AS VARCHAR), CAST(CAST(price AS DECIMAL(12,2)) AS VARCHAR),
    CAST(CAST(discount AS DECIMAL(4,2)) AS VARCHAR),
    CASE WHEN (sheet_id + row) % 97 = 0 THEN '#REF!' WHEN (sheet_id + row) % 89 = 0 THEN ' #n/a '
         WHEN (sheet_id + row) % 83 = 0 THEN '#' ELSE flag END,
    CAST(CAST(ship AS DATE) AS VARCHAR)]) AS value
  FROM order_lines)
"""


def share_requests(spark: SparkSession, directory: str) -> DataFrame:
    """Customers as share requests, with gaps and wrong values planted by key."""
    k = F.col("c_custkey")
    return read_table(spark, directory, "customer").select(
        F.col("c_nationkey").cast("bigint").alias("batch_id"),
        k.alias("request_id"),
        F.when(k % 7 != 0, F.concat(F.lower("c_mktsegment"), F.lit("@example.com"))).alias("email"),
        F.when(k % 5 != 0, F.lit("example.com")).alias("domain"),
        F.when(k % 11 == 0, F.lit("owner")).when(k % 3 == 0, F.lit("writer")).alias("role"),
        F.when(k % 4 == 0, F.lit("domain")).when(k % 13 == 0, F.lit("team")).alias("share_type"),
        F.when(k % 17 == 0, F.lit("2025-01-15"))
        .when(k % 6 == 0, F.lit("2025-01-15T00:00:00Z"))
        .when(k % 19 == 0, F.lit(""))
        .alias("expiration_time"),
    )


SHARES_SQL = """
requests AS (
  SELECT CAST(c_nationkey AS BIGINT) AS batch_id, c_custkey AS request_id,
    CASE WHEN c_custkey % 7 <> 0 THEN lower(c_mktsegment) || '@example.com' END AS email,
    CASE WHEN c_custkey % 5 <> 0 THEN 'example.com' END AS domain,
    CASE WHEN c_custkey % 11 = 0 THEN 'owner' WHEN c_custkey % 3 = 0 THEN 'writer' ELSE 'reader' END AS role,
    CASE WHEN c_custkey % 4 = 0 THEN 'domain' WHEN c_custkey % 13 = 0 THEN 'team' ELSE 'user' END AS share_type,
    CASE WHEN c_custkey % 17 = 0 THEN '2025-01-15' WHEN c_custkey % 6 = 0 THEN '2025-01-15T00:00:00Z'
         WHEN c_custkey % 19 = 0 THEN '' END AS expiration_time
  FROM customer),
checked AS (
  SELECT *, CASE
    WHEN share_type = 'domain' AND coalesce(domain, '') = '' THEN 'missing domain'
    WHEN share_type <> 'domain' AND coalesce(email, '') = '' THEN 'missing email'
    WHEN role NOT IN ('reader', 'commenter', 'writer') THEN 'invalid role'
    WHEN share_type NOT IN ('user', 'group', 'domain', 'anyone') THEN 'invalid share_type'
    WHEN coalesce(expiration_time, '') <> '' AND NOT regexp_matches(expiration_time,
         '^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}(\\.\\d+)?(Z|[+-]\\d{2}:\\d{2})$')
      THEN 'invalid expiration_time' END AS reason
  FROM requests)
"""


def shared_files(spark: SparkSession, directory: str) -> DataFrame:
    """Customers as files with a permission list: some open to anyone, some to a domain."""
    k = F.col("c_custkey")

    def permission(kind: str, role, email=None, domain=None, expires=None, inherited=None):
        text = lambda v: (F.lit(v) if not hasattr(v, "cast") else v).cast("string")
        details = F.array(
            F.struct(F.lit(inherited is not None).alias("inherited"), text(inherited).alias("inheritedFrom"))
        )
        return F.struct(
            F.concat(F.lit(kind[0]), k.cast("string")).alias("id"),
            F.lit(kind).alias("type"),
            text(role).alias("role"),
            text(email).alias("emailAddress"),
            text(domain).alias("domain"),
            text(expires).alias("expirationTime"),
            details.alias("permissionDetails"),
        )

    role = F.when(k % 3 == 0, "writer").when(k % 3 == 1, "reader").otherwise("owner")
    user = permission("user", "writer", email=F.lower("c_name"), inherited="root")
    return read_table(spark, directory, "customer").select(
        k.alias("id"),
        F.col("c_mktsegment").alias("mime_type"),
        F.col("c_nationkey").alias("owner"),
        F.col("c_acctbal").alias("balance"),
        F.when(k % 4 == 0, F.array(user, permission("anyone", role)))
        .when(k % 4 == 1, F.array(permission("domain", role, domain="example.com", expires="2030-01-01")))
        .when(k % 4 == 2, F.array(user))
        .alias("permissions"),
    )
