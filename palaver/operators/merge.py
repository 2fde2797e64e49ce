"""Keyed merges of newly exported rows with the stored tables.

``rows`` are the normalised rows of an export (``sources.exports.normalise``); their arrival
order is ``(file_path, pos)``. Every merge first reduces the batch to one row per key with
aggregates that combine before the shuffle, so many copies of one key stay cheap, then joins
the stored table on the key.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.operators.ordering import salted_join, segments
from palaver.sources.exports import author_rows, message_rows
from palaver.sources.tables import timestamp


def _arrival() -> Column:
    return F.struct("file_path", "pos")


def merge_servers(stored: DataFrame, files: DataFrame, load_time: datetime) -> DataFrame:
    """Last seen name per server; ``monitored_from`` is set once. A file without messages
    counts."""
    batch = (
        files.filter(F.col("error").isNull())
        .groupBy("server_id")
        .agg(F.max_by("server_name", "file_path").alias("new_name"))
    )
    return (
        stored.withColumn("known", F.lit(True))
        .join(batch, "server_id", "full_outer")
        .select(
            "server_id",
            F.coalesce("new_name", "server_name").alias("server_name"),
            "created_at",
            F.when(F.col("known"), F.col("monitored_from"))
            .otherwise(timestamp(load_time))
            .alias("monitored_from"),
            F.coalesce("active", F.lit(True)).alias("active"),
        )
    )


def merge_users(stored: DataFrame, rows: DataFrame, load_time: datetime) -> DataFrame:
    """New users by platform id, last name wins, ``last_seen`` moves to the load time.

    A new user's ``user_id`` is the platform id itself: unique without global numbering.
    """
    batch = (
        author_rows(rows)
        .groupBy("discord_id")
        .agg(F.max_by("username", _arrival()).alias("new_name"))
    )
    seen = F.col("new_name").isNotNull()
    return stored.join(batch, "discord_id", "full_outer").select(
        F.coalesce("user_id", "discord_id").alias("user_id"),
        "discord_id",
        F.coalesce("new_name", "current_username").alias("current_username"),
        F.when(F.col("user_id").isNull(), timestamp(load_time))
        .otherwise(F.col("created_at"))
        .alias("created_at"),
        F.when(seen, timestamp(load_time)).otherwise(F.col("last_seen")).alias("last_seen"),
    )


def username_changes(stored: DataFrame, rows: DataFrame, load_time: datetime) -> DataFrame:
    """One row per name that differs from the user's previous one in arrival order.

    Names are compared inside each file first; only a file's first name and its changes go on
    to the comparison across files. There the rows are sorted in blocks, with the stored name before a
    user's first row, and a user may span any number of blocks: a block learns from the borders of
    those before it which name, id and number of changes it goes on from. So a user with a third of
    all rows is spread like any others. ``change_no`` counts a user's changes of this load in arrival
    order, from 1: all of them share the load time.
    """
    named = author_rows(rows).select("discord_id", "file_path", "pos", "username")
    in_file = Window.partitionBy("discord_id", "file_path").orderBy("pos")
    starts = (
        named.withColumn("previous", F.lag("username").over(in_file))
        .filter(F.col("previous").isNull() | (F.col("previous") != F.col("username")))
        .select("discord_id", "file_path", "pos", "username", F.lit(None).cast("long").alias("user_id"))
    )
    authors = named.select("discord_id").distinct()
    known = stored.join(authors, "discord_id", "left_semi").select(
        "discord_id",
        F.lit(None).cast("string").alias("file_path"),  # sorts before every file
        F.lit(None).cast("int").alias("pos"),
        F.col("current_username").alias("username"),
        F.coalesce("user_id", "discord_id").alias("user_id"),
    )
    blocks, borders = segments(starts.unionByName(known), "discord_id", ["file_path", "pos"])

    # Inside a block: the row before, and the stored id so far.
    here = Window.partitionBy("_block", "discord_id").orderBy("_pos")
    so_far = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = F.struct(F.col("username").alias("name"), F.lit(True).alias("there"))
    seen = blocks.withColumn("_before", F.lag(row).over(here)).withColumn("_id", F.max("user_id").over(so_far))

    # At the borders, one row per block: the name that the block before ends with, if it is the same user.
    chain = Window.orderBy("_block")
    entering = borders.select(
        "_block",
        F.lag("_last").over(chain).alias("_end"),
        "_first",
    ).select("_block", F.when(F.col("_end.discord_id") == F.col("_first"), F.col("_end.username")).alias("_name"),
             F.col("_first").alias("discord_id"))
    named_before = (
        seen.join(F.broadcast(entering), ["_block", "discord_id"], "left")
        .withColumn("changed_from", F.when(F.col("_before.there"), F.col("_before.name")).otherwise(F.col("_name")))
        .withColumn("_change", F.col("file_path").isNotNull() & (F.col("changed_from") != F.col("username")))
        .withColumn("_change", F.coalesce("_change", F.lit(False)).cast("long"))
        .drop("_before", "_name")
    )
    # What a block passes on for its last user: changes there, the stored id, and whether it holds nobody else.
    figures = named_before.groupBy("_block", "discord_id").agg(
        F.sum("_change").alias("changes"), F.max("_id").alias("id"), F.max("_pos").alias("end")
    )
    passed = (
        figures.groupBy("_block")
        .agg(
            F.max_by(F.struct("discord_id", "changes", "id"), "end").alias("out"),
            F.min_by("discord_id", "end").alias("first"),
        )
        .withColumn("prior", F.lag("out.discord_id").over(chain))
        .withColumn("goes_on", (F.col("first") == F.col("out.discord_id")) & (F.col("prior") == F.col("first")))
        .withColumn("run", F.sum(F.when(F.coalesce("goes_on", F.lit(False)), 0).otherwise(1)).over(chain))
    )
    in_run = Window.partitionBy("run").orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = (
        passed.withColumn("sum", F.sum("out.changes").over(in_run))
        .withColumn("id", F.max("out.id").over(in_run))
        .select(
            "_block",
            F.col("first").alias("discord_id"),
            F.lag(F.struct(F.col("out.discord_id").alias("user"), "sum", "id")).over(chain).alias("from"),
        )
        .filter(F.col("from.user") == F.col("discord_id"))
    )
    return (
        named_before.withColumn("_no", F.sum("_change").over(so_far))
        .filter("_change = 1")
        .join(F.broadcast(carried), ["_block", "discord_id"], "left")
        .select(
            F.coalesce("_id", "from.id", "discord_id").alias("user_id"),
            "username",
            "changed_from",
            timestamp(load_time).alias("changed_at"),
            (F.col("_no") + F.coalesce("from.sum", F.lit(0).cast("long"))).cast("int").alias("change_no"),
        )
    )


def merge_members(
    stored: DataFrame, users: DataFrame, rows: DataFrame, load_time: datetime
) -> DataFrame:
    """New (server, user) pairs join at the load time; known ones become active again and
    keep ``left_at``. ``users`` is the merged user table."""
    pairs = author_rows(rows).select("server_id", "discord_id").distinct()
    batch = pairs.join(users.select("user_id", "discord_id"), "discord_id").select(
        "server_id", "user_id", F.lit(True).alias("seen")
    )
    return stored.join(batch, ["server_id", "user_id"], "full_outer").select(
        "server_id",
        "user_id",
        F.when(F.col("is_active").isNull(), timestamp(load_time))
        .otherwise(F.col("joined_at"))
        .alias("joined_at"),
        "left_at",
        F.coalesce("seen", "is_active").alias("is_active"),
    )


FIRST_VALUES = (
    "server_id",
    "channel_id",
    "channel_name",
    "discord_id",
    "created_at",
    "reply_to_message_id",
    "thread_id",
)
LAST_VALUES = ("content", "edited_at")


def batch_messages(rows: DataFrame) -> DataFrame:
    """One row per message of the batch: first place, author and time; last edit, and where its text
    arrived last (``file_path``, ``pos``). No text is read."""
    arrival = _arrival()
    return (
        message_rows(rows)
        .groupBy("message_id")
        .agg(
            F.min_by(F.struct(*FIRST_VALUES), arrival).alias("first"),
            F.max_by(F.struct("edited_at", "file_path", "pos"), arrival).alias("last"),
        )
        .select("message_id", "first.*", "last.*")
    )


def kept_messages(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """Stored messages the batch does not bring. For a usual load the ids of the batch are small
    enough for Spark to broadcast, and the stored text stays where it is."""
    ids = message_rows(rows).select("message_id").distinct()
    return stored.join(ids, "message_id", "left_anti")


def changed_messages(stored: DataFrame, users: DataFrame, rows: DataFrame) -> DataFrame:
    """The messages of the batch as they are to be stored.

    A known message takes the new text and edit time and becomes live again; everything else
    about it keeps its first value, so the join reads no stored text. All is decided on narrow rows;
    the text of a message joins them last, from the place where it arrived last. An author of many
    messages is dealt to many tasks.
    """
    known = stored.drop(*LAST_VALUES, "is_deleted").withColumn("known", F.lit(True))
    authors = author_rows(rows).select("discord_id").distinct()
    people = users.join(authors, "discord_id", "left_semi").select("discord_id", "user_id")
    batch = salted_join(batch_messages(rows), people, "discord_id", "message_id", "left").withColumn(
        "user_id", F.coalesce("user_id", "discord_id")
    )
    texts = message_rows(rows).select(
        F.col("message_id").alias("text_id"), F.col("file_path").alias("text_path"),
        F.col("pos").alias("text_pos"), "content",
    )

    def first(name: str) -> Column:
        return F.when(F.col("known"), F.col(f"s.{name}")).otherwise(F.col(f"b.{name}")).alias(name)

    decided = batch.alias("b").join(known.alias("s"), F.col("s.message_id") == F.col("b.message_id"), "left")
    at = (
        (F.col("text_id") == F.col("b.message_id"))
        & (F.col("text_path") == F.col("b.file_path"))
        & (F.col("text_pos") == F.col("b.pos"))
    )
    return (
        decided.join(texts, at)
        .select(
            F.col("b.message_id").alias("message_id"),
            *[first(c) for c in ("server_id", "channel_id", "channel_name", "user_id")],
            "content",
            first("created_at"),
            "b.edited_at",
            "s.deleted_at",
            F.lit(False).alias("is_deleted"),
            first("reply_to_message_id"),
            first("thread_id"),
        )
    )


def merge_messages(stored: DataFrame, users: DataFrame, rows: DataFrame) -> DataFrame:
    """The message table after the batch. ``users`` is the merged user table."""
    return kept_messages(stored, rows).unionByName(changed_messages(stored, users, rows))


def import_stats(stored: DataFrame, files: DataFrame, rows: DataFrame) -> DataFrame:
    """Per file: new, updated, skipped and errors.

    A message is new in the file where it first arrives if the store lacks it; every other
    arrival is an update. ``stored`` is the message table before the merge.
    """
    per_file = (
        files.groupBy("file_path")
        .agg(F.count("error").alias("errors"))
        .join(
            rows.groupBy("file_path").agg(
                F.count(F.when(F.col("reject").isNull(), 1)).alias("valid"),
                F.count("reject").alias("skipped"),
            ),
            "file_path",
            "left",
        )
    )
    first_seen = (
        message_rows(rows)
        .groupBy("message_id")
        .agg(F.min("file_path").alias("file_path"))
        .join(stored.select("message_id"), "message_id", "left_anti")
        .groupBy("file_path")
        .agg(F.count(F.lit(1)).alias("new"))
    )
    return (
        per_file.join(first_seen, "file_path", "left")
        .na.fill(0, ["new", "valid", "skipped"])
        .select(
            "file_path", "new", (F.col("valid") - F.col("new")).alias("updated"), "skipped", "errors"
        )
    )


def import_totals(stats: DataFrame, merged: DataFrame) -> DataFrame:
    """The sums over all files, and the rows now in the message table."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("new", "updated", "skipped", "errors")]
    stored = merged.agg(F.count(F.lit(1)).alias("message_count")).scalar()
    return stats.agg(*sums).withColumn("message_count", stored)
