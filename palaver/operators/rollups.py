"""Mergeable daily rollups of live messages: weekly figures without reading the messages.

``daily_channels`` counts the messages of a day, server and channel; ``daily_users`` holds the
authors of a day and server as bitmaps over user numbers, 32,768 numbers to a bitmap. Counts add up
and bitmaps are or-ed, so any set of whole days gives exact distinct users: a week, the servers of one
name, or the last eight weeks. Only the one day that a moving window cuts is read from the
messages themselves.

A load changes the rollups of the days it touches and no others; both tables are laid out in folders
of the ISO week, and a touched week is counted anew from the messages its days can be in.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.operators.ordering import number_rows
from palaver.sources.tables import within_days

DAILY_CHANNELS = "day date, server_id long, channel_id long, messages long, thread_messages long"
DAILY_USERS = "day date, server_id long, bucket long, users binary"
USER_NUMBERS = "user_id long, user_no long"
#: Tables and columns of a store that keeps rollups.
ROLLUPS = {"daily_channels": DAILY_CHANNELS, "daily_users": DAILY_USERS}
#: A Monday; weeks are numbered from it.
FIRST_MONDAY = date(1970, 1, 5)


def week_no(day: str | Column) -> Column:
    """Number of the ISO week of a date; a day without a time has none."""
    day = F.col(day) if isinstance(day, str) else day
    return F.floor(F.datediff(day, F.lit(FIRST_MONDAY)) / 7).cast("int")


def week_start(day: Column) -> Column:
    return F.date_trunc("week", day).cast("date")


def new_user_numbers(numbers: DataFrame, messages: DataFrame) -> DataFrame:
    """Numbers for the authors that have none yet, following on from the highest one given."""
    fresh = messages.select("user_id").distinct().filter("user_id IS NOT NULL").join(numbers, "user_id", "left_anti")
    highest = numbers.agg(F.coalesce(F.max("user_no"), F.lit(-1))).first()[0]
    return number_rows(fresh, ["user_id"], "user_no").select(
        "user_id", (F.col("user_no") + F.lit(highest + 1)).alias("user_no")
    )


def _day() -> Column:
    return F.col("created_at").cast("date").alias("day")


def daily_channels(live: DataFrame) -> DataFrame:
    """Messages and thread messages per day, server and channel; messages without a time count under no day."""
    return live.groupBy(_day(), "server_id", "channel_id").agg(
        F.count("message_id").alias("messages"),
        F.count(F.when(F.col("thread_id").isNotNull(), F.col("message_id"))).alias("thread_messages"),
    )


def daily_users(live: DataFrame, numbers: DataFrame) -> DataFrame:
    """Authors per day and server as bitmaps of their numbers. Each author of a day moves once."""
    authors = live.select(_day(), "server_id", "user_id").distinct().join(numbers, "user_id")
    return authors.groupBy("day", "server_id", F.bitmap_bucket_number("user_no").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_no")).alias("users")
    )


class Rollups:
    """Daily tables, and a way to the live messages newer than a time for the day a window cuts.

    ``live_since`` is called with the window's start and may give more than that. ``numbers`` gives the
    authors' numbers; an author there without one has not been rolled up yet.
    """

    def __init__(
        self,
        channels: DataFrame,
        users: DataFrame,
        numbers: DataFrame,
        live_since: Callable[[datetime], DataFrame],
    ):
        self.channels = channels
        self.users = users
        self.numbers = numbers
        self.live_since = live_since

    def window(self, as_of: datetime, days: int) -> tuple[DataFrame, DataFrame]:
        """The daily tables of the window: whole days from the rollups, the cut first day from messages."""
        since = as_of - timedelta(days=days)
        first = F.lit(since.date())
        cut = self.live_since(since).filter(
            within_days("created_at", as_of, days) & (F.col("created_at").cast("date") == first)
        )
        return (
            self.channels.filter(F.col("day") > first).unionByName(daily_channels(cut)),
            self.users.filter(F.col("day") > first).unionByName(daily_users(cut, self.numbers)),
        )


def _distinct_users(users: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Exact distinct authors per key: bitmaps of one bucket are or-ed, then the bits are counted."""
    merged = users.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("users")).alias(name))


def _together(counts: DataFrame, users: DataFrame, keys: list[str]) -> DataFrame:
    same = [counts[k].eqNullSafe(users[k]) for k in keys]
    condition = same[0]
    for one in same[1:]:
        condition = condition & one
    return counts.join(users, condition, "left").select(*[counts[c] for c in counts.columns], *[c for c in users.columns if c not in keys])


def weekly_active_users(rollups: Rollups, server_id: int | None = None) -> DataFrame:
    """``queries.weekly_active_users`` from the rollups."""
    keys = ["server_id", "week_start"] if server_id is None else ["week_start"]

    def prepared(daily: DataFrame) -> DataFrame:
        daily = daily if server_id is None else daily.filter(F.col("server_id") == server_id)
        return daily.withColumn("week_start", week_start(F.col("day")))

    posts = prepared(rollups.channels).groupBy(*keys).agg(F.sum("messages").alias("total_messages"))
    users = _distinct_users(prepared(rollups.users), keys, "active_users")
    return (
        _together(posts, users, keys)
        .select(*keys, F.coalesce("active_users", F.lit(0).cast("long")).alias("active_users"), "total_messages")
        .orderBy(*keys[:-1], F.desc("week_start"))
    )


def server_stats(rollups: Rollups, servers: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """``weekly.server_stats`` from the rollups and the messages of one day."""
    channels, users = rollups.window(as_of, days)
    posts = (
        channels.groupBy("server_id")
        .agg(
            F.sum("messages").alias("total_messages"),
            F.count_distinct("channel_id").alias("active_channels"),
            F.sum("thread_messages").alias("thread_messages"),
        )
    )
    posters = _distinct_users(users, ["server_id"], "unique_posters")
    measures = ["total_messages", "unique_posters", "active_channels", "thread_messages"]
    return (
        servers.select("server_id", "server_name")
        .join(posts, "server_id", "left")
        .join(posters, "server_id", "left")
        .na.fill(0, measures)
        .select("server_id", "server_name", *measures)
        .orderBy(F.desc("total_messages"), "server_id")
    )


def weekly_trends(
    rollups: Rollups, servers: DataFrame, as_of: datetime, weeks: int = 8, by_name: bool = True
) -> DataFrame:
    """``weekly.weekly_trends`` from the rollups; servers of the same name merge their bitmaps."""
    keys = ["server_name"] if by_name else ["server_id", "server_name"]
    names = servers.select("server_id", "server_name")
    channels, users = (
        daily.withColumn("week", week_start(F.col("day"))).join(names, "server_id")
        for daily in rollups.window(as_of, 7 * weeks)
    )
    posts = channels.groupBy(*keys, "week").agg(F.sum("messages").alias("posts"))
    unique = _distinct_users(users, [*keys, "week"], "unique_users")
    return (
        _together(posts, unique, [*keys, "week"])
        .select(*keys, "week", "posts", F.coalesce("unique_users", F.lit(0).cast("long")).alias("unique_users"))
        .orderBy(F.asc_nulls_last("server_name"), *keys[:-1], F.desc("week"))
    )
