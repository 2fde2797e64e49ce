"""Weekly job: statistics, trends and link review, all servers in one plan each."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.functions.text import contains_ilike, mentions
from palaver.operators.ordering import materialise, top_per_group
from palaver.operators.queries import week_start
from palaver.sources.tables import Tables, within_days

# Link markers, URL patterns, account-name term and review windows.
LINK_MARKERS = ("drive.google.com", "docs.google.com", "bit.ly", "tinyurl", "shorturl")
SHORTLINK_MARKERS = ("bit.ly", "tinyurl", "shorturl")
URL_PATTERN = r'https?://[^\s<>"]+'
SHORTLINK_PATTERN = r'https?://(?:bit\.ly|tinyurl\.com|shorturl\.at)/[^\s<>"]+'
DELETED_ACCOUNT_TERM = "deleted"
NEW_ACCOUNT_DAYS = 7
TREND_WEEKS = 8
TOP_N = 5


def _recent(tables: Tables, as_of: datetime, days: int, server_id: int | None) -> DataFrame:
    messages = tables.live_within(as_of, days)
    return messages if server_id is None else messages.filter(F.col("server_id") == server_id)


def server_stats(
    tables: Tables, as_of: datetime, days: int = 7, server_id: int | None = None
) -> DataFrame:
    """Activity of every server, idle ones with zeros, busiest first.

    Messages are counted per server before the outer join, so the join moves one row per
    server. ``message_id`` is the key of the table, so plain counts equal distinct counts.
    """
    counted = (
        _recent(tables, as_of, days, server_id)
        .groupBy("server_id")
        .agg(
            F.count("message_id").alias("total_messages"),
            F.count_distinct("user_id").alias("unique_posters"),
            F.count_distinct("channel_id").alias("active_channels"),
            F.count(F.when(F.col("thread_id").isNotNull(), F.col("message_id"))).alias(
                "thread_messages"
            ),
        )
    )
    servers = tables.servers.select("server_id", "server_name")
    if server_id is not None:
        servers = servers.filter(F.col("server_id") == server_id)
    measures = ["total_messages", "unique_posters", "active_channels", "thread_messages"]
    return (
        servers.join(counted, "server_id", "left")
        .na.fill(0, measures)
        .select("server_id", "server_name", *measures)
        .orderBy(F.desc("total_messages"), "server_id")
    )


def top_users_per_server(
    tables: Tables, as_of: datetime, days: int = 7, server_id: int | None = None, limit: int = TOP_N
) -> DataFrame:
    counted = (
        _recent(tables, as_of, days, server_id)
        .groupBy("server_id", "user_id")
        .agg(F.count(F.lit(1)).alias("messages"))
        .join(tables.users.select("user_id", "current_username"), "user_id")
    )
    order = [F.desc("messages"), F.asc("user_id")]
    return top_per_group(counted, ["server_id"], order, limit).select(
        "server_id", "rank", "current_username", "messages"
    )


def top_channels_per_server(
    tables: Tables, as_of: datetime, days: int = 7, server_id: int | None = None, limit: int = TOP_N
) -> DataFrame:
    """Busiest channel names, threads left out."""
    counted = (
        _recent(tables, as_of, days, server_id)
        .filter(F.col("thread_id").isNull())
        .groupBy("server_id", "channel_name")
        .agg(F.count(F.lit(1)).alias("messages"))
    )
    order = [F.desc("messages"), F.asc_nulls_last("channel_name")]
    return top_per_group(counted, ["server_id"], order, limit).select(
        "server_id", "rank", "channel_name", "messages"
    )


def new_users_per_server(
    tables: Tables, as_of: datetime, days: int = 7, server_id: int | None = None
) -> DataFrame:
    """Users first stored in the window who have any message on the server, deleted or old
    ones included.

    Messages shrink to distinct (server, user) pairs before the join. It is an inner join on the
    users' key, since a semi join would be moved below the distinct, to every message.
    """
    posters = tables.messages.select("server_id", "user_id")
    if server_id is not None:
        posters = posters.filter(F.col("server_id") == server_id)
    fresh = tables.users.filter(within_days("created_at", as_of, days)).select("user_id")
    return (
        posters.distinct()
        .join(fresh, "user_id")
        .groupBy("server_id")
        .agg(F.count(F.lit(1)).alias("new_users"))
    )


def _nested(ranked: DataFrame, name: str, label: str, column: str) -> DataFrame:
    entries = F.array_sort(F.collect_list(F.struct("rank", column, "messages")))
    return (
        ranked.groupBy("server_id")
        .agg(entries.alias("ranked"))
        .select(
            "server_id",
            F.transform(
                "ranked",
                lambda e: F.struct(e[column].alias(label), e["messages"].alias("messages")),
            ).alias(name),
        )
    )


def server_stats_nested(
    tables: Tables, as_of: datetime, days: int = 7, server_id: int | None = None, limit: int = TOP_N
) -> DataFrame:
    """One record per server: the measures plus arrays of the ``limit`` top users and channels."""
    users = _nested(
        top_users_per_server(tables, as_of, days, server_id, limit),
        "top_users", "username", "current_username",
    )
    channels = _nested(
        top_channels_per_server(tables, as_of, days, server_id, limit),
        "top_channels", "channel", "channel_name",
    )
    record = (
        server_stats(tables, as_of, days, server_id)
        .join(new_users_per_server(tables, as_of, days, server_id), "server_id", "left")
        .na.fill(0, ["new_users"])
        .join(users, "server_id", "left")
        .join(channels, "server_id", "left")
        .withColumn("days", F.lit(days))
    )
    for name, label in (("top_users", "username"), ("top_channels", "channel")):
        empty = F.array().cast(f"array<struct<{label}:string,messages:bigint>>")
        record = record.withColumn(name, F.coalesce(name, empty))
    return record


def weekly_trends(
    tables: Tables, as_of: datetime, weeks: int = TREND_WEEKS, by_name: bool = True
) -> DataFrame:
    """Posts and distinct users per server and ISO week over the last weeks.

    ``by_name`` adds servers of the same name together; otherwise rows are per ``server_id``.
    Messages shrink to (server, week, user) before the names are joined.
    """
    per_user = (
        tables.live_within(as_of, 7 * weeks)
        .groupBy("server_id", week_start().alias("week"), "user_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(tables.servers.select("server_id", "server_name"), "server_id")
    )
    keys = ["server_name"] if by_name else ["server_id", "server_name"]
    return (
        per_user.groupBy(*keys, "week")
        .agg(F.sum("n").alias("posts"), F.count_distinct("user_id").alias("unique_users"))
        .orderBy(F.asc_nulls_last("server_name"), *keys[:-1], F.desc("week"))
    )


def weekly_trends_nested(
    tables: Tables, as_of: datetime, weeks: int = TREND_WEEKS, by_name: bool = True
) -> DataFrame:
    """One record per server with its weeks as an array, newest first."""
    keys = ["server_name"] if by_name else ["server_id", "server_name"]
    week = F.struct("week", "posts", "unique_users")
    return (
        weekly_trends(tables, as_of, weeks, by_name)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(week), asc=False).alias("weeks"))
        .withColumn(
            "weeks",
            F.transform(
                "weeks",
                lambda w: F.struct(
                    w["week"].cast("string").alias("week"),
                    w["posts"].alias("posts"),
                    w["unique_users"].alias("unique_users"),
                ),
            ),
        )
    )


# --- link review -------------------------------------------------------------------------


def marked_messages(tables: Tables, as_of: datetime | None = None, days: int = 7) -> DataFrame:
    """Live messages that carry a link marker, with the URLs cut out of their text; all, or those of a window.

    This is the one pass over message text; what follows moves no text. A message that carries
    a marker but no matching URL gives no row.
    """
    messages = tables.live_messages if as_of is None else tables.live_within(as_of, days)
    # The byte search for the scheme, which every URL pattern needs, spares most text the rest.
    marked = F.contains("content", F.lit("://")) & mentions(F.lower("content"), LINK_MARKERS)
    return (
        messages.filter(marked)
        .select(
            "message_id",
            "server_id",
            "channel_name",
            "user_id",
            "created_at",
            F.regexp_extract_all("content", F.lit(URL_PATTERN), F.lit(0)).alias("urls"),
            F.when(
                mentions(F.lower("content"), SHORTLINK_MARKERS),
                F.regexp_extract_all("content", F.lit(SHORTLINK_PATTERN), F.lit(0)),
            ).alias("short_urls"),
        )
        .filter(F.size("urls") > 0)
    )


def _links(tables: Tables, found: DataFrame, users: DataFrame, urls: str) -> DataFrame:
    """Joined rows, one per URL."""
    people = users.select(
        "user_id", "current_username", F.col("created_at").alias("account_created_at")
    )
    return (
        found.filter(F.size(urls) > 0)
        .join(people, "user_id")
        .join(tables.servers.select("server_id", "server_name"), "server_id")
        .select("*", F.posexplode(urls).alias("url_no", "url"))
        .withColumn("date", F.col("created_at").cast("date"))
    )


def _found(tables: Tables, found: DataFrame | None, as_of: datetime, days: int) -> DataFrame:
    if found is None:
        return marked_messages(tables, as_of, days)
    return found.filter(within_days("created_at", as_of, days))


def deleted_account_links(tables: Tables, found: DataFrame | None = None) -> DataFrame:
    """Links in live messages of accounts whose name says deleted, of all time.

    The three lists take ``found``, the marked messages, when they are wanted together.
    """
    gone = tables.users.filter(contains_ilike(F.col("current_username"), DELETED_ACCOUNT_TERM))
    return _links(tables, marked_messages(tables) if found is None else found, gone, "urls")


def recent_shortlinks(
    tables: Tables, as_of: datetime, days: int = 7, found: DataFrame | None = None
) -> DataFrame:
    """Links behind a shortener in the window."""
    return _links(tables, _found(tables, found, as_of, days), tables.users, "short_urls")


def new_account_links(
    tables: Tables, as_of: datetime, days: int = 7, found: DataFrame | None = None
) -> DataFrame:
    """Links posted less than seven days after the account was stored; a post dated before
    that counts too."""
    age = F.col("created_at") - F.col("account_created_at")
    return (
        _links(tables, _found(tables, found, as_of, days), tables.users, "urls")
        .filter(age < F.make_dt_interval(F.lit(NEW_ACCOUNT_DAYS)))
        .withColumn("account_created", F.col("account_created_at").cast("date"))
    )


def link_lists(tables: Tables, as_of: datetime, days: int) -> tuple[DataFrame, ...]:
    """The three lists, written down once: the text is read in a single pass."""
    found = materialise(marked_messages(tables))
    return (
        materialise(deleted_account_links(tables, found)),
        materialise(recent_shortlinks(tables, as_of, days, found)),
        materialise(new_account_links(tables, as_of, days, found)),
    )


def _newest_links(links: DataFrame, *extra: str) -> DataFrame:
    return links.orderBy(
        F.desc_nulls_first("created_at"), F.desc("message_id"), "url_no"
    ).select("server_name", "channel_name", "current_username", *extra, "date", "url")


def links_deleted_accounts(tables: Tables) -> DataFrame:
    return _newest_links(deleted_account_links(tables))


def shortlinks(tables: Tables, as_of: datetime, days: int = 7) -> DataFrame:
    return _newest_links(recent_shortlinks(tables, as_of, days))


def links_new_accounts(tables: Tables, as_of: datetime, days: int = 7) -> DataFrame:
    return _newest_links(new_account_links(tables, as_of, days), "account_created")


LINK_LISTS = ("deleted_account_links", "shortlinks", "new_account_links")


def _flags(tables: Tables, as_of: datetime, days: int) -> DataFrame:
    """The three lists in one frame, unsorted; the text is read in a single pass."""
    found = materialise(marked_messages(tables))
    lists = (
        deleted_account_links(tables, found),
        recent_shortlinks(tables, as_of, days, found),
        new_account_links(tables, as_of, days, found),
    )
    keys = ("created_at", "message_id", "url_no")
    shown = ("server_name", "channel_name", "current_username", "date", "url", "account_created")
    parts = []
    for place, (category, links) in enumerate(zip(LINK_LISTS, lists)):
        texts = [F.col(c).cast("string").alias(c) for c in shown if c in links.columns]
        parts.append(links.select(F.lit(place).alias("place"), *keys, F.lit(category).alias("category"), *texts))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def security_flags(tables: Tables, as_of: datetime, days: int = 7) -> DataFrame:
    """The three lists as text under one ``category`` column, newest first in each; sorted once."""
    newest = ("place", F.desc_nulls_first("created_at"), F.desc("message_id"), "url_no")
    return _flags(tables, as_of, days).orderBy(*newest).drop("place", "created_at", "message_id", "url_no")


def security_summary(tables: Tables, as_of: datetime, days: int = 7) -> DataFrame:
    """Flags per category, zeros included, and in total."""
    counts = _flags(tables, as_of, days).agg(
        *[F.count(F.when(F.col("category") == c, 1)).alias(c) for c in LINK_LISTS],
        F.count(F.lit(1)).alias("total"),
    )
    return counts.unpivot([], [*LINK_LISTS, "total"], "category", "flags")
