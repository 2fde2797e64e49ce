"""The logical tables as DataFrames, from parquet or from an existing database."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from functools import reduce
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver import schemas
from palaver.functions.text import contains_ilike


class Tables:
    """The logical tables. A table is opened when an operator first asks for it.

    ``recent`` opens the messages that may be newer than a time, ``containing`` those that may match a
    search term; both may give more than that. Without them all messages are opened. Where texts are kept apart
    from the messages, ``heads`` opens the messages without them, ``with_texts`` adds them to such rows, and
    ``spread`` opens the messages in parts of few texts each.
    """

    def __init__(
        self,
        load: Callable[[str], DataFrame],
        recent: Callable[[datetime], DataFrame] | None = None,
        containing: Callable[[str], DataFrame] | None = None,
        heads: Callable[[], DataFrame] | None = None,
        with_texts: Callable[[DataFrame], DataFrame] | None = None,
        spread: Callable[[], DataFrame] | None = None,
    ):
        self._load = load
        self._recent = recent
        self._containing = containing
        self._heads = heads
        self._with_texts = with_texts
        self._spread = spread

    @cached_property
    def servers(self) -> DataFrame:
        return self._load("servers")

    @cached_property
    def users(self) -> DataFrame:
        return self._load("users")

    @cached_property
    def username_history(self) -> DataFrame:
        return self._load("username_history")

    @cached_property
    def messages(self) -> DataFrame:
        return self._load("messages")

    @cached_property
    def reactions(self) -> DataFrame:
        return self._load("reactions")

    @cached_property
    def server_members(self) -> DataFrame:
        return self._load("server_members")

    @property
    def live_messages(self) -> DataFrame:
        return _live(self.messages)

    def live_spread(self) -> DataFrame:
        """Live messages for results that are far larger than the texts they are made from.

        Spark sizes the tasks behind a join by what they read. Where texts are kept apart, their parts are
        sized here, so that a task returns a bounded result and its writer finds equal texts again.
        """
        return self.live_messages if self._spread is None else _live(self._spread())

    def live_joined(self, other: DataFrame, key: str) -> DataFrame:
        """Live messages joined with another table. Texts kept apart join last, so they are not shuffled for it."""
        if self._heads is None:
            return self.live_messages.join(other, key)
        return self._with_texts(_live(self._heads()).join(other, key))

    def live_within(self, as_of: datetime, days: int) -> DataFrame:
        """Live messages strictly newer than ``as_of`` minus ``days``; a store opens only the folders that hold any."""
        since = as_of - timedelta(days=days)
        messages = self.messages if self._recent is None else self._recent(since)
        return _live(messages).filter(within_days("created_at", as_of, days))

    def live_containing(self, term: str) -> DataFrame:
        """Live messages that contain a term, ``%`` and ``_`` in it being wildcards, whatever the case.

        A search index only spares text the test; the rows are the same without it.
        """
        messages = self.messages if self._containing is None else self._containing(term)
        return _live(messages).filter(contains_ilike(F.col("content"), term))


def _live(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("is_deleted") == F.lit(False))


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a parquet store; filters and column lists reach the scan."""
    return spark.read.schema(schemas.TABLES[name]).parquet(f"{folder}/{name}")


def load_tables(spark: SparkSession, folder: str) -> Tables:
    return Tables(lambda name: load_table(spark, folder, name))


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    name: str,
    partition_column: str,
    bounds: tuple[int, int],
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A table of an existing relational store, read in parallel ranges of a numeric column."""
    return spark.read.jdbc(
        url,
        name,
        column=partition_column,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=partitions,
        properties=properties or {},
    )


def timestamp(value: datetime) -> Column:
    """A constant naive timestamp."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def within_days(column: str, as_of: datetime, days: int) -> Column:
    """Strictly newer than ``as_of`` minus ``days``; there is no upper bound.

    The bound is a constant, so it is pushed to the parquet scan.
    """
    return F.col(column) > timestamp(as_of - timedelta(days=days))


def export_bounds(
    messages: DataFrame, after: datetime | int | None = None, before: datetime | int | None = None
) -> DataFrame:
    """History strictly between two bounds, each a time or a message id."""
    if after is not None:
        if isinstance(after, datetime):
            messages = messages.filter(F.col("created_at") > timestamp(after))
        else:
            messages = messages.filter(F.col("message_id") > after)
    if before is not None:
        if isinstance(before, datetime):
            messages = messages.filter(F.col("created_at") < timestamp(before))
        else:
            messages = messages.filter(F.col("message_id") < before)
    return messages


def select_scope(
    messages: DataFrame,
    server_ids: Sequence[int] | DataFrame | None = None,
    channel_ids: Sequence[int] | DataFrame | None = None,
) -> DataFrame:
    """Rows of the configured servers united with those of the configured channels.

    Each is a list, or a DataFrame of ``server_id`` or ``channel_id``; with neither, all rows.
    """
    tests = []
    for column, chosen in (("server_id", server_ids), ("channel_id", channel_ids)):
        if isinstance(chosen, DataFrame):
            mark = f"_in_{column}"
            keys = chosen.select(F.col(column).alias(mark)).distinct()
            messages = messages.join(keys, F.col(column) == F.col(mark), "left")
            tests.append(F.col(mark).isNotNull())
        elif chosen is not None:
            tests.append(F.coalesce(F.col(column).isin(list(chosen)), F.lit(False)))
    if not tests:
        return messages
    return messages.filter(reduce(lambda a, b: a | b, tests)).drop("_in_server_id", "_in_channel_id")
