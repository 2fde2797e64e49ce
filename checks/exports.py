"""Export documents that Spark derives from the bound tables, to run the ingest operators on.

Every message appears in a second export: two events share one message id, half of the ids and
authors are stored already, names change with the event, and some rows and files are unusable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver import schemas
from palaver.sources.tables import Tables

FILE_ROWS = 1000

# One arrival per event, in SQL both engines read the same way.
ARRIVALS = """
    SELECT message_id AS event_id, server_id, channel_id, channel_name, created_at,
           edited_at, content, reply_to_message_id,
           concat('exports/', CAST(channel_id AS {text}), '/', CAST(CAST(created_at AS DATE) AS {text}),
                  '-', CAST(CAST(floor(message_id / 1000) AS BIGINT) AS {text}), '.json') AS file_path,
           channel_name = 'error' AND CAST(created_at AS DATE) = DATE '2024-01-05' AS no_guild,
           concat('Server ', CAST(server_id AS {text}), ' on ',
                  CAST(CAST(created_at AS DATE) AS {text})) AS guild_name,
           CAST(3 * floor(message_id / 2) AS BIGINT) AS export_id,
           1000000 + 2 * user_id AS author_id,
           concat('user', CAST(user_id AS {text})) AS author_name,
           CASE WHEN message_id % 3 = 0 THEN concat('nick', CAST(user_id AS {text})) ELSE '' END
               AS nickname,
           CASE WHEN message_id % 5 = 0 THEN '0042' ELSE '0' END AS tag,
           message_id % 47 = 0 AS bad_time,
           message_id % 53 = 0 AS bad_id,
           message_id % 59 = 0 AS no_author
    FROM {messages}"""


def no_text() -> Column:
    """The content of a message in documents that are made for operators which read no text."""
    return F.lit(None).cast("string")


def text_digest() -> Column:
    """The content of a message in documents whose texts are returned as digests only.

    An empty text stays empty, and a missing one missing, for they are replaced by the file names.
    """
    return F.when(F.col("content") == "", F.col("content")).otherwise(F.md5("content"))


def content_md5(content: Column) -> Column:
    """The digest of a normalised content, which holds one already unless it lists files.

    A list begins with a bracket, a digest never does; a missing text without files gives the empty one.
    """
    return F.when((content == "") | content.startswith("["), F.md5(content)).otherwise(content)


def export_documents(tables: Tables, content: Column | None = None) -> DataFrame:
    """JSON documents of at most FILE_ROWS messages of one channel and day, parsed by schema.

    ``content`` stands for the texts: they are longer than all else together, and a document brings the
    messages of many tasks into one, so what is returned of them is worked out before.
    """
    text = ARRIVALS.replace("{text}", "STRING")
    messages = tables.messages
    if content is not None:
        messages = messages.withColumn("content", content)
    arrivals = messages.sparkSession.sql(text, messages=messages)
    local = F.col("created_at") + F.expr("INTERVAL 2 HOURS")
    stamp = F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00"))
    edited = F.concat(F.date_format("edited_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    files = F.concat(F.lit("file"), F.col("event_id").cast("string"), F.lit(".png"))
    message = F.struct(
        "event_id",
        F.when(F.col("bad_id"), "x").otherwise(F.col("export_id").cast("string")).alias("id"),
        F.when(F.col("bad_time"), "soon").otherwise(stamp).alias("timestamp"),
        edited.alias("timestampEdited"),
        "content",
        F.struct(
            F.when(~F.col("no_author"), F.col("author_id").cast("string")).alias("id"),
            F.col("author_name").alias("name"),
            "nickname",
            F.col("tag").alias("discriminator"),
        ).alias("author"),
        F.array(
            F.struct(files.alias("fileName")), F.struct(F.lit(None).cast("string").alias("fileName"))
        ).alias("attachments"),
        F.when(
            F.col("reply_to_message_id").isNotNull(),
            F.struct(F.col("reply_to_message_id").cast("string").alias("messageId")),
        ).alias("reference"),
    )
    kind = F.when(F.col("channel_name") == "purchase", "GuildPublicThread").otherwise(
        "GuildTextChat"
    )
    guild = F.struct(
        F.when(~F.col("no_guild"), F.col("server_id").cast("string")).alias("id"),
        F.col("guild_name").alias("name"),
    )
    channel = F.struct(
        F.col("channel_id").cast("string").alias("id"),
        F.col("channel_name").alias("name"),
        kind.alias("type"),
    )
    documents = arrivals.groupBy("file_path").agg(
        F.any_value(guild).alias("guild"),
        F.any_value(channel).alias("channel"),
        F.array_sort(F.collect_list(message)).alias("messages"),
    )
    parsed = F.from_json(F.to_json(F.struct("guild", "channel", "messages")), schemas.EXPORT)
    return documents.select("file_path", parsed.alias("d")).select(
        "d.*", F.lit(None).cast("string").alias("_corrupt"), "file_path"
    )


# The normalised rows of the same documents, written down independently for the SQL check.
NORMALISED_SQL = (
    "arrivals AS (" + ARRIVALS.replace("{text}", "VARCHAR").replace("{messages}", "messages") + """),
rows AS (
    SELECT file_path, event_id, server_id, guild_name AS server_name, channel_id, channel_name,
           CASE WHEN NOT bad_id THEN export_id END AS message_id,
           CASE WHEN NOT no_author THEN author_id END AS discord_id,
           concat(CASE WHEN nickname <> '' THEN nickname ELSE author_name END,
                  CASE WHEN tag = '0042' THEN '#0042' ELSE '' END) AS username,
           CASE WHEN NOT bad_time THEN created_at END AS created_at,
           edited_at,
           CASE WHEN content = '' THEN concat('[file', event_id, '.png, attachment]')
                ELSE content END AS content,
           reply_to_message_id,
           CASE WHEN channel_name = 'purchase' THEN channel_id END AS thread_id,
           CASE WHEN bad_id THEN 'no message id' WHEN no_author THEN 'no author id'
                WHEN bad_time THEN 'no timestamp' END AS reject
    FROM arrivals WHERE NOT no_guild)"""
)
