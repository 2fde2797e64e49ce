"""Community questions over the logical tables.

Every function is lazy and set-based. Where ``server_id`` is optional, leaving it out answers
the question for all servers at once, with ``server_id`` as a leading column.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.functions.text import contains_ilike, sorted_distinct
from palaver.operators.ordering import top_per_group
from palaver.sources.tables import Tables, timestamp


def _newest_first() -> list[Column]:
    return [F.desc_nulls_first("created_at"), F.desc("message_id")]


def _oldest_first() -> list[Column]:
    return [F.asc_nulls_last("created_at"), F.asc("message_id")]


def _of_server(frame: DataFrame, server_id: int | None) -> DataFrame:
    return frame if server_id is None else frame.filter(F.col("server_id") == server_id)


def _non_empty(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("content").isNotNull() & (F.col("content") != ""))


def _authors(tables: Tables) -> DataFrame:
    return tables.users.select("user_id", F.col("current_username").alias("author"))


def _server_names(tables: Tables) -> DataFrame:
    return tables.servers.select("server_id", "server_name")


# --- people ------------------------------------------------------------------------------


def users_across_servers(tables: Tables, min_servers: int = 3) -> DataFrame:
    """Users active in at least ``min_servers`` servers, with the sorted server names."""
    memberships = (
        tables.server_members.filter("is_active")
        .select("server_id", "user_id")
        .join(_server_names(tables), "server_id")
        .groupBy("user_id")
        .agg(
            F.count_distinct("server_id").alias("server_count"),
            sorted_distinct(F.col("server_name")).alias("servers"),
        )
        .filter(F.col("server_count") >= min_servers)
    )
    return (
        memberships.join(tables.users, "user_id")
        .select("discord_id", "current_username", "server_count", "servers")
        .orderBy(F.desc("server_count"), "discord_id")
    )


def find_user(tables: Tables, username: str) -> DataFrame:
    """Users whose name contains the term (``%`` and ``_`` in it are wildcards)."""
    return (
        tables.users.filter(contains_ilike(F.col("current_username"), username))
        .select("user_id", "discord_id", "current_username")
        .orderBy(F.asc_nulls_last("current_username"), "user_id")
    )


def user_by_discord_id(tables: Tables, discord_id: int) -> DataFrame:
    return tables.users.filter(F.col("discord_id") == discord_id).select("user_id")


def username_lookup(tables: Tables, name: str, at: datetime | None = None) -> DataFrame:
    """Who carried a name: intervals from the name history, optionally those covering ``at``.

    A user's first interval (the name replaced by the first recorded change) has no start, the
    last has no end. Changes of one load share its time and follow each other by ``change_no``; a
    name that lasted for no time covers no moment. Only users who ever carried the name enter the
    window.
    """
    in_order = Window.partitionBy("user_id").orderBy("changed_at", "change_no", "username")
    carried = (F.col("username") == name) | (F.col("changed_from") == name)
    carriers = tables.username_history.filter(carried).select("user_id")
    history = tables.username_history.join(carriers, "user_id", "left_semi").withColumn("first", F.row_number().over(in_order) == 1)
    later = history.select(
        "user_id",
        "username",
        F.col("changed_at").alias("valid_from"),
        F.lead("changed_at").over(in_order).alias("valid_to"),
    )
    earlier = history.filter("first").select(
        "user_id",
        F.col("changed_from").alias("username"),
        F.lit(None).cast("timestamp_ntz").alias("valid_from"),
        F.col("changed_at").alias("valid_to"),
    )
    spans = later.unionByName(earlier).filter(F.col("username") == name)
    if at is not None:
        moment = timestamp(at)
        spans = spans.filter(
            (F.col("valid_from").isNull() | (F.col("valid_from") <= moment))
            & (F.col("valid_to").isNull() | (F.col("valid_to") > moment))
        )
    users = tables.users.select("user_id", "discord_id", "current_username")
    return spans.join(users, "user_id").select(
        "user_id", "discord_id", "current_username", "username", "valid_from", "valid_to"
    )


# --- messages ----------------------------------------------------------------------------


def user_messages(
    tables: Tables, as_of: datetime, user_ids: int | DataFrame, days: int | None = None
) -> DataFrame:
    """Live messages of one user, or of a DataFrame of ``user_id``, with the server name."""
    messages = tables.live_messages if days is None else tables.live_within(as_of, days)
    if isinstance(user_ids, DataFrame):
        messages = messages.join(user_ids.select("user_id").distinct(), "user_id", "left_semi")
    else:
        messages = messages.filter(F.col("user_id") == user_ids)
    return messages.join(_server_names(tables), "server_id").select(
        "user_id", "message_id", "created_at", "server_name", "channel_name", "content", "is_deleted"
    )


def user_message_context(
    tables: Tables, as_of: datetime, user_ids: int | DataFrame, days: int | None = None
) -> DataFrame:
    """The user's live messages with reaction counts, newest first.

    Reactions are cut down to the user's messages before they are counted.
    """
    messages = user_messages(tables, as_of, user_ids, days)
    counts = (
        tables.reactions.select("message_id")
        .join(messages.select("message_id"), "message_id", "left_semi")
        .groupBy("message_id")
        .agg(F.count(F.lit(1)).alias("reaction_count"))
    )
    result = messages.join(counts, "message_id", "left").withColumn(
        "reaction_count", F.coalesce("reaction_count", F.lit(0).cast("long"))
    )
    columns = [
        "message_id", "created_at", "server_name", "channel_name", "content", "is_deleted",
        "reaction_count",
    ]
    if isinstance(user_ids, DataFrame):
        columns.insert(0, "user_id")
    return result.select(*columns).orderBy(*_newest_first())


def channel_messages(
    tables: Tables, as_of: datetime, server_id: int, channel_id: int, days: int = 30
) -> DataFrame:
    """Live messages of a channel in the window with the author, oldest first."""
    return (
        tables.live_within(as_of, days)
        .filter((F.col("server_id") == server_id) & (F.col("channel_id") == channel_id))
        .join(_authors(tables), "user_id")
        .select("message_id", "created_at", "author", "content", "reply_to_message_id", "thread_id")
        .orderBy(*_oldest_first())
    )


def channel_all_messages(
    tables: Tables, server_id: int, channel_name: str, limit: int | None = None
) -> DataFrame:
    """Non-empty live messages of a channel, found by name, oldest first; all unless a limit is given."""
    messages = tables.live_messages.filter(
        (F.col("server_id") == server_id) & (F.col("channel_name") == channel_name)
    )
    found = (
        _non_empty(messages)
        .join(_authors(tables), "user_id")
        .select("message_id", "created_at", "author", "content")
        .orderBy(*_oldest_first())
    )
    return found if limit is None else found.limit(limit)


def search_messages(
    tables: Tables, query: str, server_id: int | None = None, limit: int | None = None
) -> DataFrame:
    """Case-insensitive substring search over live content, newest first; all hits unless a limit is given.

    Tables with a search index read the text of its candidates only.
    """
    found = (
        _of_server(tables.live_containing(query), server_id)
        .join(_server_names(tables), "server_id")
        .join(_authors(tables), "user_id")
        .select("message_id", "created_at", "server_name", "channel_name", "author", "content")
        .orderBy(*_newest_first())
    )
    return found if limit is None else found.limit(limit)


def recent_sample(
    tables: Tables, as_of: datetime, server_id: int | None = None, days: int = 30, limit: int = 60
) -> DataFrame:
    """Newest non-empty live messages with their author; of every server when none is named.

    The rows are chosen by their keys; only then their text is fetched.
    """
    recent = _non_empty(_of_server(tables.live_within(as_of, days), server_id))
    keys = recent.select("message_id", "server_id", "user_id", "created_at").join(_authors(tables), "user_id")
    text = recent.select(F.col("message_id").alias("text_of"), "content")
    if server_id is not None:
        # At most ``limit`` rows, so every task may hold them.
        chosen = F.broadcast(keys.orderBy(*_newest_first()).limit(limit))
        columns = []
    else:
        chosen = top_per_group(keys, ["server_id"], _newest_first(), limit)
        columns = ["server_id", "rank"]
    found = text.join(chosen, F.col("text_of") == F.col("message_id"))
    found = found.select(*columns, "message_id", "created_at", "author", "content")
    return found if columns else found.orderBy(*_newest_first())


def latest_messages(tables: Tables, limit: int = 5) -> DataFrame:
    return (
        tables.messages.select("message_id", "channel_name", "created_at", "content")
        .orderBy(*_newest_first())
        .limit(limit)
    )


# --- counts and trends -------------------------------------------------------------------


def server_health(tables: Tables, server_id: int | None = None) -> DataFrame:
    """Monthly distinct joiners and leavers and the net change, newest month first."""
    keys = ["server_id", "month"] if server_id is None else ["month"]
    moves = (
        _of_server(tables.server_members, server_id)
        .select(
            "server_id",
            "user_id",
            F.expr("stack(2, joined_at, true, left_at, false) AS (moved_at, joined)"),
        )
        .filter(F.col("moved_at").isNotNull())
        .withColumn("month", F.trunc(F.col("moved_at").cast("date"), "month"))
    )
    counted = moves.groupBy(*keys).agg(
        F.count_distinct(F.when(F.col("joined"), F.col("user_id"))).alias("new_members"),
        F.count_distinct(F.when(~F.col("joined"), F.col("user_id"))).alias("left_members"),
    )
    return counted.withColumn(
        "net_change", F.col("new_members") - F.col("left_members")
    ).orderBy(*keys[:-1], F.desc("month"))


def server_activity(tables: Tables, as_of: datetime, server_id: int | None, days: int) -> DataFrame:
    """Messages, posters and channels per server that has live messages in the window."""
    recent = tables.live_within(as_of, days)
    counted = (
        _of_server(recent, server_id)
        .groupBy("server_id")
        .agg(
            F.count("message_id").alias("total_messages"),
            F.count_distinct("user_id").alias("active_users"),
            F.count_distinct("channel_id").alias("active_channels"),
        )
    )
    return counted.join(_server_names(tables), "server_id").select(
        "server_id", "server_name", "total_messages", "active_users", "active_channels"
    )


def summary_top_users(
    tables: Tables, as_of: datetime, server_id: int | None = None, days: int = 7, limit: int = 10
) -> DataFrame:
    """Top contributors per server with their distinct channel names."""
    recent = tables.live_within(as_of, days)
    counted = (
        _of_server(recent, server_id)
        .groupBy("server_id", "user_id")
        .agg(
            F.count("message_id").alias("message_count"),
            sorted_distinct(F.col("channel_name")).alias("channels"),
        )
        .join(tables.users.select("user_id", "current_username"), "user_id")
    )
    order = [F.desc("message_count"), F.asc("user_id")]
    return top_per_group(counted, ["server_id"], order, limit).select(
        "server_id", "rank", "current_username", "message_count", "channels"
    )


def server_summary(
    tables: Tables, as_of: datetime, server_id: int | None = None, days: int = 7
) -> DataFrame:
    """Activity of a server with its top contributors nested; no row without activity."""
    top = (
        summary_top_users(tables, as_of, server_id, days)
        .groupBy("server_id")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("rank", "current_username", "message_count", "channels"))
            ).alias("ranked")
        )
        .select(
            "server_id",
            F.transform(
                "ranked",
                lambda u: F.struct(
                    u["current_username"].alias("current_username"),
                    u["message_count"].alias("message_count"),
                    u["channels"].alias("channels"),
                ),
            ).alias("top_users"),
        )
    )
    return (
        server_activity(tables, as_of, server_id, days)
        .join(top, "server_id", "left")
        .withColumn("days", F.lit(days))
    )


def recent_active_users(
    tables: Tables,
    as_of: datetime,
    server_id: int | None = None,
    days: int = 30,
    limit: int = 20,
) -> DataFrame:
    """Most active users of a server (of every server when none is named) in the window.

    Users are joined after counting, so the join moves one row per user, not per message.
    """
    recent = tables.live_within(as_of, days)
    counted = (
        _of_server(recent, server_id)
        .groupBy("server_id", "user_id")
        .agg(
            F.count("message_id").alias("message_count"),
            F.max("created_at").alias("last_active"),
            F.count_distinct("channel_id").alias("channels_used"),
        )
        .join(tables.users.select("user_id", "discord_id", "current_username"), "user_id")
    )
    order = [F.desc("message_count"), F.asc("user_id")]
    columns = ["discord_id", "current_username", "message_count", "last_active", "channels_used"]
    if server_id is not None:
        return counted.orderBy(*order).limit(limit).select("user_id", *columns)
    return top_per_group(counted, ["server_id"], order, limit).select(
        "server_id", "rank", "user_id", *columns
    )


def week_start(column: str = "created_at") -> Column:
    """Monday of the ISO week as a date."""
    return F.date_trunc("week", column).cast("date")


def weekly_active_users(tables: Tables, server_id: int | None = None) -> DataFrame:
    """Distinct users and messages per ISO week, newest first."""
    keys = ["server_id", "week_start"] if server_id is None else ["week_start"]
    return (
        _of_server(tables.live_messages, server_id)
        .withColumn("week_start", week_start())
        .groupBy(*keys)
        .agg(
            F.count_distinct("user_id").alias("active_users"),
            F.count("message_id").alias("total_messages"),
        )
        .orderBy(*keys[:-1], F.desc("week_start"))
    )


def recent_weeks(tables: Tables, server_id: int, weeks: int = 8) -> DataFrame:
    return weekly_active_users(tables, server_id).limit(weeks)


def total_messages(tables: Tables) -> DataFrame:
    """All stored messages, deleted ones included."""
    return tables.messages.agg(F.count(F.lit(1)).alias("message_count"))


def messages_per_server(tables: Tables) -> DataFrame:
    """Messages per server name, deleted ones included; servers of the same name add up."""
    counted = tables.messages.groupBy("server_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        counted.join(_server_names(tables), "server_id")
        .groupBy("server_name")
        .agg(F.sum("n").alias("message_count"))
        .orderBy(F.desc("message_count"), "server_name")
    )


# --- servers and channels ----------------------------------------------------------------


def all_servers(tables: Tables) -> DataFrame:
    return _server_names(tables).orderBy(F.asc_nulls_last("server_name"), "server_id")


def server_by_id(tables: Tables, server_id: int) -> DataFrame:
    return _server_names(tables).filter(F.col("server_id") == server_id)


def find_channel(
    tables: Tables, server_id: int, term: str = "discussion", limit: int | None = 1
) -> DataFrame:
    """The channel of the server whose name contains the term, the lowest id; more with another limit."""
    found = (
        tables.messages.filter(
            (F.col("server_id") == server_id) & contains_ilike(F.col("channel_name"), term)
        )
        .select("channel_id", "channel_name")
        .distinct()
        .orderBy("channel_id", "channel_name")
    )
    return found if limit is None else found.limit(limit)
