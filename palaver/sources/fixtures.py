"""Binding of the driver's parquet files to the logical tables (see FIXTURES.md)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.sources.tables import Tables

AS_OF = datetime(2024, 1, 31)
# Bytes of text in a part where a message returns its text many times.
SPREAD_BYTES = 1 << 19


# The columns of a message before its text, the text, and the columns behind it.
_BEFORE = """e.event_id AS message_id, e.event_id % 25 AS server_id,
               (e.event_id % 25) * 10 + CASE e.event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2
                   WHEN 'error' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END AS channel_id,
               e.event_type AS channel_name, CAST(e.user_id AS BIGINT) AS user_id,"""
_CONTENT = """concat(
                   CASE WHEN e.event_id % 20 = 0
                        THEN concat('**Hack Night ', CAST(e.event_id % 50 AS {text}), '** 2024-02-0',
                                    CAST(1 + e.event_id % 9 AS {text}), ' ')
                        WHEN e.event_id % 20 = 10 THEN '**Weekly Schedule** ' ELSE '' END,
                   CASE WHEN e.event_id % 31 = 0 THEN '' ELSE d.text END,
                   CASE WHEN e.event_id % 41 = 0
                        THEN concat(' https://bit.ly/x', CAST(e.event_id AS {text}))
                        WHEN e.event_id % 43 = 0
                        THEN ' see https://docs.google.com/d/1 and https://tinyurl.com/z'
                        ELSE '' END)"""
_AFTER = """e.ts AS created_at,
               CASE WHEN e.event_id % 10 = 0 THEN e.ts + INTERVAL '5' MINUTE END AS edited_at,
               CASE WHEN e.event_id % 13 = 0 THEN e.ts + INTERVAL '1' HOUR END AS deleted_at,
               e.event_id % 13 = 0 AS is_deleted,
               CASE WHEN e.event_id % 4 = 0 AND e.event_id >= 25 THEN e.event_id - 25 END
                   AS reply_to_message_id,
               CASE WHEN e.event_id % 6 = 0
                    THEN (e.event_id % 25) * 10 + CASE e.event_type WHEN 'view' THEN 1
                        WHEN 'click' THEN 2 WHEN 'error' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END
                    END AS thread_id"""

# The table definitions, in SQL both engines read the same way; {ts} is the naive timestamp type.
# Spark reads the hint, DuckDB skips it as a comment: a broadcast of the narrow side would leave the
# texts in as many tasks as their file has row groups; the merge join deals the messages to all.
DEFINITIONS = {
    "servers": """
        SELECT CAST(n_nationkey AS BIGINT) AS server_id, n_name AS server_name,
               CAST(NULL AS {ts}) AS created_at,
               CAST('2023-01-01 00:00:00' AS {ts}) AS monitored_from,
               n_nationkey % 5 <> 4 AS active
        FROM {nation}""",
    "users": """
        SELECT CAST(c_custkey AS BIGINT) AS user_id,
               CAST(c_custkey + 1000000 AS BIGINT) AS discord_id,
               CASE WHEN c_custkey % 17 = 0 THEN concat('Deleted User ', c_name) ELSE c_name END
                   AS current_username,
               CAST('2023-12-20 00:00:00' AS {ts}) + ((c_custkey * 7) % 40) * INTERVAL '1' DAY
                   AS created_at,
               CAST('2024-01-31 00:00:00' AS {ts}) AS last_seen
        FROM {customer}""",
    "username_history": """
        SELECT CAST(c_custkey AS BIGINT) AS user_id, c_name AS username,
               concat('old_', c_name) AS changed_from,
               CAST('2023-06-01 00:00:00' AS {ts}) + (c_custkey % 90) * INTERVAL '1' DAY
                   AS changed_at,
               1 AS change_no
        FROM {customer} WHERE c_custkey % 3 = 0""",
    "messages": f"""
        SELECT /*+ SHUFFLE_MERGE(e) */ {_BEFORE}
               {_CONTENT} AS content,
               {_AFTER}
        FROM (SELECT event_id, event_type, user_id, ts,
                     event_id % (SELECT count(*) FROM {{documents}}) AS doc_no FROM {{events}}) e
        JOIN {{documents}} d ON d.doc_id = e.doc_no""",
    "reactions": """
        SELECT l_orderkey * 100000 + l_suppkey * 10
                   + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 2 ELSE 4 END
                   + CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS id,
               l_orderkey AS message_id, concat(l_returnflag, l_linestatus) AS emoji,
               CAST(l_suppkey AS BIGINT) AS user_id, min(l_shipdate) AS added_at
        FROM {lineitem} GROUP BY l_orderkey, l_returnflag, l_linestatus, l_suppkey""",
    "server_members": """
        SELECT o_orderkey % 25 AS server_id, CAST(o_custkey AS BIGINT) AS user_id,
               min(o_orderdate) AS joined_at,
               CASE WHEN (o_orderkey % 25 + o_custkey) % 7 = 0 THEN max(o_orderdate) END AS left_at,
               (o_orderkey % 25 + o_custkey) % 7 <> 0 AS is_active
        FROM {orders} GROUP BY o_orderkey % 25, o_custkey""",
}

# The same messages in two steps, so that narrow rows can meet other tables before their texts join them.
HEADS = f"""
        SELECT {_BEFORE}
               {_AFTER}
        FROM {{events}} e"""
WITH_TEXTS = f"""
        SELECT /*+ SHUFFLE_MERGE(e) */ e.*, {_CONTENT} AS content
        FROM (SELECT *, message_id AS event_id,
                     message_id % (SELECT count(*) FROM {{documents}}) AS doc_no FROM {{heads}}) e
        JOIN {{documents}} d ON d.doc_id = e.doc_no"""

SOURCE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey long, c_name string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string",
    "documents": "doc_id long, text string",
    "lineitem": "l_orderkey long, l_suppkey long, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
}

_SOURCES = {
    "servers": ("nation",),
    "users": ("customer",),
    "username_history": ("customer",),
    "messages": ("events", "documents"),
    "reactions": ("lineitem",),
    "server_members": ("orders",),
}


def bind(spark: SparkSession, sf_dir: str) -> Tables:
    """The logical tables over one driver folder, as lazy plans."""

    def source(name: str) -> DataFrame:
        return spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")

    def run(text: str, **frames: DataFrame) -> DataFrame:
        return spark.sql(text.replace("{ts}", "TIMESTAMP_NTZ").replace("{text}", "STRING"), **frames)

    def table(name: str) -> DataFrame:
        return run(DEFINITIONS[name], **{s: source(s) for s in _SOURCES[name]})

    def with_texts(heads: DataFrame) -> DataFrame:
        return run(WITH_TEXTS, documents=source("documents"), heads=heads).drop("event_id", "doc_no")

    def spread() -> DataFrame:
        texts = source("documents")
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(-(-size // SPREAD_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
        joined = DEFINITIONS["messages"].replace("JOIN {documents}", "JOIN {texts}")
        return run(joined, events=source("events"), documents=texts, texts=texts.repartition(parts, "doc_id"))

    return Tables(table, heads=lambda: run(HEADS, events=source("events")), with_texts=with_texts, spread=spread)


def duckdb_ctes() -> str:
    """The same definitions as a WITH list for the SQL check."""
    parts = []
    for name, text in DEFINITIONS.items():
        text = text.replace("{ts}", "TIMESTAMP").replace("{text}", "VARCHAR")
        for source in _SOURCES[name]:
            text = text.replace("{" + source + "}", source)
        parts.append(f"{name} AS ({text})")
    return ",\n".join(parts)
