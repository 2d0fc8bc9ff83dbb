"""Exported workspace records: declared schemas, defaults, and the reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskmill.session import configure

_RUN = (
    "struct<startIndex:int,endIndex:int,textRun:struct<content:string,textStyle:struct<bold:boolean,"
    "italic:boolean,strikethrough:boolean,link:struct<url:string>,weightedFontFamily:struct<fontFamily:string>>>>"
)
_PARAGRAPH = (
    f"struct<elements:array<{_RUN}>,paragraphStyle:struct<namedStyleType:string>,"
    "bullet:struct<listId:string,nestingLevel:int>>"
)
_TABLE = (
    "struct<rows:int,columns:int,tableRows:array<struct<tableCells:array<struct<startIndex:int,endIndex:int,"
    f"content:array<struct<paragraph:{_PARAGRAPH}>>>>>>>"
)
CONTENT = (
    f"array<struct<startIndex:int,endIndex:int,paragraph:{_PARAGRAPH},table:{_TABLE},"
    "sectionBreak:struct<sectionStyle:map<string,string>>,"
    "tableOfContents:struct<content:array<struct<startIndex:int,endIndex:int>>>>>"
)
_SEGMENT = "struct<content:array<struct<startIndex:int,endIndex:int>>>"
_PERMISSION = (
    "struct<id:string,type:string,role:string,emailAddress:string,domain:string,expirationTime:string,"
    "permissionDetails:array<struct<inherited:boolean,inheritedFrom:string>>>"
)
_VALUE = "array<struct<value:string>>"
_INSTANT = "struct<dateTime:string,date:string>"

# The exported entities and their columns.
ENTITIES = {
    "message_part": (
        "msg_id string, thread_id string, part_id string, parent_id string, depth int, pos int, mime string, "
        "data string, filename string, size bigint, attachment_id string"
    ),
    "message_header": "msg_id string, pos int, name string, value string",
    "filter_rule": (
        "mailbox string, rule_id string, `from` string, `to` string, subject string, query string, "
        "negated_query string, has_attachment boolean, exclude_chats boolean, size bigint, "
        "size_comparison string, add_labels array<string>, remove_labels array<string>, forward string"
    ),
    "file": (
        "id string, name string, mime_type string, modified_time string, size string, parents array<string>, "
        f"trashed boolean, starred boolean, target_id string, permissions array<{_PERMISSION}>, "
        "owners array<struct<displayName:string,emailAddress:string>>"
    ),
    "share_request": (
        "batch_id bigint, request_id bigint, email string, domain string, role string, share_type string, "
        "expiration_time string"
    ),
    "event": (
        f"calendar_id string, event_id string, summary string, description string, location string, "
        f"start {_INSTANT}, end {_INSTANT}, "
        "attendees array<struct<email:string,responseStatus:string,optional:boolean,organizer:boolean>>"
    ),
    "document": (
        "doc_id string, title string, "
        "lists map<string,struct<listProperties:struct<nestingLevels:array<struct<glyphType:string,glyphSymbol:string>>>>>, "
        f"headers map<string,{_SEGMENT}>, footers map<string,{_SEGMENT}>, content {CONTENT}"
    ),
    "comment": (
        "file_id string, comment_id string, author string, content string, anchor string, created string, "
        "resolved boolean"
    ),
    "reply": "comment_id string, reply_id string, author string, content string, created string",
    "grid": "sheet_id bigint, title string, start_row int, start_col int, rows array<array<string>>",
    "task": (
        "list_id string, id string, parent string, title string, status string, notes string, "
        "position string, due string, completed string, updated string, deleted boolean, hidden boolean, "
        "assigned boolean"
    ),
    "person": (
        "resourceName string, etag string, "
        "names array<struct<displayName:string,givenName:string,familyName:string>>, "
        f"emailAddresses {_VALUE}, phoneNumbers {_VALUE}, organizations array<struct<name:string,title:string>>, "
        "addresses array<struct<formattedValue:string>>, "
        f"birthdays array<struct<date:struct<year:int,month:int,day:int>>>, urls {_VALUE}, biographies {_VALUE}, "
        "metadata struct<sources:array<struct<type:string>>>"
    ),
    "contact_group": "group_id string, name string, group_type string, member_count int, members array<string>",
    "chat_message": (
        "space string, name string, text string, createTime string, "
        "sender struct<name:string,displayName:string>, thread struct<name:string>, threadReply boolean, "
        "annotations array<struct<type:string,richLinkMetadata:struct<uri:string>>>, "
        "attachment array<struct<name:string,contentName:string,contentType:string,source:string>>, "
        "emojiReactionSummaries array<struct<emoji:struct<unicode:string,customEmoji:struct<uid:string>>,"
        "reactionCount:int>>"
    ),
    "form_response": (
        "form_id string, response_id string, create_time string, last_submitted_time string, "
        "answers map<string,array<string>>"
    ),
    "slide": (
        "objectId string, pageElements array<struct<objectId:string,shape:struct<shapeType:string,"
        "text:struct<textElements:array<struct<startIndex:int,textRun:struct<content:string>>>>>,"
        "table:struct<rows:int,columns:int>,line:struct<lineType:string>>>"
    ),
    "script_run": (
        "script_id string, user_id string, function_name string, status string, start_time string, duration string"
    ),
}

# What stands for a missing field.
DEFAULTS = {
    "message_header": {"value": ""},
    "file": {"size": "0"},
    "event": {"summary": "No Title", "description": "No Description", "location": "No Location"},
    "comment": {"author": "Unknown", "content": "", "resolved": False},
    "reply": {"author": "Unknown", "content": ""},
    "person": {"resourceName": "Unknown"},
    "chat_message": {"text": "No text content", "createTime": "Unknown Time"},
    "script_run": {"function_name": "Unknown", "status": "Unknown", "duration": "Unknown"},
}

CORRUPT = "_corrupt_record"


def entity_schema(entity: str) -> T.StructType:
    """The declared columns of an entity; all of them may be null."""
    if entity not in ENTITIES:
        raise ValueError(f"unknown entity {entity!r}, known are {sorted(ENTITIES)}")
    return T._parse_datatype_string(ENTITIES[entity])


def read_export(
    spark: SparkSession, directory: str, entity: str, file_format: str = "json", keep_corrupt: bool = True
) -> DataFrame:
    """An exported entity, ``<directory>/<entity>``, with its declared schema and defaults.

    JSON records that cannot be read are kept as rows with their text in ``_corrupt_record``, null for all others; without
    ``keep_corrupt`` there is no such column and they are left out.
    """
    configure(spark)
    schema = entity_schema(entity)
    path = f"{directory.rstrip('/')}/{entity}"
    if file_format == "json":
        if keep_corrupt:
            wide = schema.add(CORRUPT, "string")
            df = spark.read.schema(wide).option("columnNameOfCorruptRecord", CORRUPT).json(path)
        else:
            df = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    elif file_format == "parquet":
        df = spark.read.schema(schema).parquet(path)
    else:
        raise ValueError(f"unknown format {file_format!r}")
    return with_defaults(df, entity)


def with_defaults(df: DataFrame, entity: str) -> DataFrame:
    """Missing fields of an entity filled in."""
    defaults = DEFAULTS.get(entity, {})
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()}) if defaults else df


def write_export(df: DataFrame, directory: str, entity: str, file_format: str = "json") -> str:
    """Write records as an export that ``read_export`` reads; returns the directory."""
    shaped = df.select(*[F.col(c).cast(t) for c, t in ((f.name, f.dataType) for f in entity_schema(entity))])
    path = f"{directory.rstrip('/')}/{entity}"
    if file_format == "json":
        shaped.write.json(path)
    else:
        shaped.write.parquet(path)
    return directory
