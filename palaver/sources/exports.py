"""Chat-export JSON documents: read, explode, validate, normalise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver import schemas
from palaver.functions import ingest

CORRUPT = "_corrupt"
SCHEMA = f"{schemas.EXPORT}, {CORRUPT} string"


def decoded_path(path: Column) -> Column:
    """The metadata path is percent-encoded; '+' is literal there, so shield it from the decoder."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _with_path(documents: DataFrame) -> DataFrame:
    return documents.select("*", decoded_path(F.col("_metadata.file_path")).alias("file_path"))


def read_exports(spark: SparkSession, path: str) -> DataFrame:
    """All ``*.json`` documents below a folder, or one file. A broken file is one row with
    ``_corrupt`` set; the others still load."""
    return _with_path(
        spark.read.schema(SCHEMA)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def stream_exports(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same documents as a file stream."""
    reader = (
        spark.readStream.schema(SCHEMA)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _with_path(reader.json(path))


def _file_error() -> Column:
    guild, channel = F.col("guild"), F.col("channel")
    return (
        F.when(F.col(CORRUPT).isNotNull(), F.lit("unreadable file"))
        .when(ingest.parse_id(guild["id"]).isNull(), F.lit("no guild id"))
        .when(ingest.parse_id(channel["id"]).isNull(), F.lit("no channel id"))
    )


def file_rows(documents: DataFrame) -> DataFrame:
    """One row per document: parsed ids, defaults, thread flag, and ``error`` if it is unusable."""
    guild, channel = F.col("guild"), F.col("channel")
    return documents.select(
        "file_path",
        _file_error().alias("error"),
        ingest.parse_id(guild["id"]).alias("server_id"),
        F.coalesce(guild["name"], F.lit(ingest.DEFAULT_SERVER_NAME)).alias("server_name"),
        ingest.parse_id(channel["id"]).alias("channel_id"),
        F.coalesce(channel["name"], F.lit(ingest.DEFAULT_CHANNEL_NAME)).alias("channel_name"),
        F.coalesce(channel["type"], F.lit("")).alias("channel_type"),
        "messages",
    )


def explode_messages(documents: DataFrame) -> DataFrame:
    """One row per message of the usable documents, in arrival order ``(file_path, pos)``."""
    return explode_file_rows(file_rows(documents))


def explode_file_rows(files: DataFrame) -> DataFrame:
    """The same of documents that are parsed already (``file_rows``)."""
    return (
        files.filter(F.col("error").isNull())
        .select(
            "file_path",
            "server_id",
            "server_name",
            "channel_id",
            "channel_name",
            "channel_type",
            F.posexplode("messages").alias("pos", "message"),
        )
    )


def normalise(exploded: DataFrame) -> DataFrame:
    """Typed message rows plus ``reject``: why the message is skipped, NULL when it is kept.

    A row without a usable time still carries its author, which counts as seen.
    """
    message = F.col("message")
    row = exploded.select(
        "file_path",
        "pos",
        "server_id",
        "server_name",
        "channel_id",
        "channel_name",
        ingest.parse_id(message["id"]).alias("message_id"),
        ingest.parse_id(message["author"]["id"]).alias("discord_id"),
        ingest.display_name(message["author"]).alias("username"),
        ingest.parse_ts(message["timestamp"]).alias("created_at"),
        ingest.parse_ts(message["timestampEdited"]).alias("edited_at"),
        ingest.message_content(message["content"], message["attachments"]).alias("content"),
        ingest.reply_to(message["reference"]).alias("reply_to_message_id"),
        ingest.thread_id(F.col("channel_type"), F.col("channel_id")).alias("thread_id"),
    )
    return row.withColumn(
        "reject",
        F.when(F.col("message_id").isNull(), F.lit("no message id"))
        .when(F.col("discord_id").isNull(), F.lit("no author id"))
        .when(F.col("created_at").isNull(), F.lit("no timestamp")),
    )


def author_rows(rows: DataFrame) -> DataFrame:
    """Rows whose author and membership are stored: message and author id are valid."""
    return rows.filter(F.col("message_id").isNotNull() & F.col("discord_id").isNotNull())


def message_rows(rows: DataFrame) -> DataFrame:
    """Rows whose message is stored."""
    return rows.filter(F.col("reject").isNull())


def rejects(documents: DataFrame, rows: DataFrame) -> DataFrame:
    """Every unusable file and skipped message with its reason."""
    files = file_rows(documents).filter(F.col("error").isNotNull())
    return files.select(
        "file_path", F.lit(None).cast("int").alias("pos"), F.col("error").alias("reason")
    ).unionByName(
        rows.filter(F.col("reject").isNotNull()).select(
            "file_path", "pos", F.col("reject").alias("reason")
        )
    )


def import_preview(documents: DataFrame) -> DataFrame:
    """Dry run: raw array length per usable file and the thread flag, nothing validated."""
    return (
        file_rows(documents)
        .filter(F.col("error").isNull())
        .select(
            "file_path",
            "server_name",
            "channel_name",
            F.coalesce(F.array_size("messages"), F.lit(0)).cast("long").alias("new"),
            ingest.is_thread(F.col("channel_type")).alias("is_thread"),
        )
    )
