"""Event catalogue: extraction per channel set, de-duplication, labels."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.functions import events as ev
from palaver.functions.text import strip
from palaver.operators.ordering import top_per_group
from palaver.sources.tables import Tables

EVENT_ORDER = ("channel_rank", "created_at", "message_id", "pos")


@dataclass(frozen=True)
class ChannelSet:
    """Configured channel names in reading order: announcement channels, then sports channels."""

    event: tuple[str, ...] = ()
    sports: tuple[str, ...] = ()

    def places(self, kind: str) -> list[tuple[str, int]]:
        """``(channel name, rank)`` of one kind; ranks run on over both kinds."""
        names, first = (self.event, 0) if kind == "event" else (self.sports, len(self.event))
        return [(name, first + i) for i, name in enumerate(names)]


def channel_set_messages(
    tables: Tables, server_id: int | None, channels: ChannelSet, kind: str, limit: int | None = None
) -> DataFrame:
    """Non-empty live messages of every configured channel of a kind.

    The channel names reach the scan as a filter. All messages are read unless the caller gives a
    ``limit`` per channel, which keeps the oldest ones of known authors; it is cut in salted parts
    first, by keys alone, so a channel that holds most rows is not sorted in one task. Without a limit
    the authors are left to be looked up once the text has been worked on.
    """
    messages = tables.live_messages
    if server_id is not None:
        messages = messages.filter(F.col("server_id") == server_id)
    places = channels.places(kind)
    entries = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(r).alias("rank")) for n, r in places])
    mine = F.filter(entries, lambda e: e["name"] == F.col("channel_name"))
    chosen = (
        messages.filter(F.col("channel_name").isin([name for name, _ in places]))
        .filter(F.col("content").isNotNull() & (F.col("content") != ""))
        .select(
            "server_id",
            "user_id",
            "channel_name",
            F.explode(F.transform(mine, lambda e: e["rank"])).alias("channel_rank"),
            "created_at",
            "message_id",
            "content",
        )
    )
    if limit is None:
        return chosen
    order = [F.asc_nulls_last("created_at"), F.asc("message_id")]
    keys = chosen.drop("content", "channel_name").join(_authors(tables), "user_id")
    first = top_per_group(keys, ["server_id", "channel_rank"], order, limit, "_row", salt_on="message_id")
    return chosen.join(first.select("message_id", "channel_rank"), ["message_id", "channel_rank"])


def _authors(tables: Tables) -> DataFrame:
    """The known authors. They are joined by their key; a semi join would be moved down to the text."""
    return tables.users.select("user_id")


def _titles() -> Column:
    return F.when(ev.long_enough(F.col("content"), ev.MIN_EVENT_CHARS), ev.titles(F.col("content")))


def extract_titles(messages: DataFrame) -> DataFrame:
    """One row per bold title of a message: ``pos`` (from 0) and ``title``."""
    kept = [c for c in messages.columns if c != "content"]
    found = messages.filter(ev.is_marked(F.col("content"))).select(*kept, _titles().alias("_found"))
    return found.select(*kept, F.posexplode("_found").alias("pos", "title"))


def extract_events(messages: DataFrame, raw_chars: int | None = None) -> DataFrame:
    """One event per bold title, with the message's date and whole text, or its first ``raw_chars``.

    Date and text are taken per message, before its titles become rows.
    """
    kept = [c for c in messages.columns if c != "content"]
    found = messages.filter(ev.is_marked(F.col("content"))).select(
        *kept,
        _titles().alias("_found"),
        ev.event_date(F.col("content")).alias("date"),
        ev.raw_text(F.col("content"), raw_chars).alias("raw_text"),
    )
    return found.select(
        *kept,
        F.posexplode("_found").alias("pos", "title"),
        "date",
        F.lit(None).cast("string").alias("category"),
        F.col("channel_name").alias("source_channel"),
        "raw_text",
    )


def drop_noise_titles(events: DataFrame, strict_case: bool = False) -> DataFrame:
    return events.filter(~ev.is_noise(F.col("title"), strict_case))


def extract_sports(messages: DataFrame, raw_chars: int | None = None) -> DataFrame:
    """One pre-labelled event per organising post, titled by its first line, with its whole text
    or the first ``raw_chars``."""
    content = F.col("content")
    return messages.filter(ev.is_sports_post(content)).select(
        *[c for c in messages.columns if c != "content"],
        F.lit(0).alias("pos"),
        ev.first_line(content).alias("title"),
        ev.event_date(content).alias("date"),
        F.lit(ev.SPORTS_CATEGORY).alias("category"),
        F.col("channel_name").alias("source_channel"),
        ev.raw_text(content, raw_chars).alias("raw_text"),
    )


def collect_channel_sets(
    tables: Tables,
    server_id: int | None,
    channels: ChannelSet,
    strict_case: bool = False,
    limit: int | None = None,
    raw_chars: int | None = None,
) -> DataFrame:
    """Events of the announcement channels (noise dropped) and of the sports channels.

    ``limit`` keeps the oldest messages of each channel, ``raw_chars`` the first characters of each text; without
    them every message is read and kept whole. Events are cut out of the text where it is scanned;
    their authors are looked up afterwards.
    """
    found = []
    if channels.event:
        messages = channel_set_messages(tables, server_id, channels, "event", limit)
        found.append(drop_noise_titles(extract_events(messages, raw_chars), strict_case))
    if channels.sports:
        messages = channel_set_messages(tables, server_id, channels, "sports", limit)
        found.append(extract_sports(messages, raw_chars))
    events = reduce(DataFrame.unionByName, found)
    if limit is None:
        events = events.join(_authors(tables), "user_id")
    return events.drop("user_id")


def title_key(title: Column) -> Column:
    return strip(F.lower(title))


def dedup_events(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First event of each title, ignoring case and outer space, in channel and time order.

    Channel and category do not take part. Spark keeps one row per title on each side of the
    shuffle, so a title that fills a third of the rows does not gather in one task.
    """
    keyed = events.withColumn("_key", title_key(F.col("title")))
    order = [F.asc_nulls_last(c) for c in EVENT_ORDER]
    return top_per_group(keyed, [*by, "_key"], order, 1, "_first").drop("_key", "_first")


def split_prelabelled(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(pre-labelled, unlabelled)``."""
    return events.filter(F.col("category").isNotNull()), events.filter(F.col("category").isNull())


def label_missing_as_other(events: DataFrame) -> DataFrame:
    """Without a model every unlabelled event is "other"."""
    return events.withColumn("category", F.coalesce("category", F.lit(ev.OTHER_CATEGORY)))


def keyword_category(
    events: DataFrame, rules: Sequence[tuple[str, Sequence[str]]] = ev.KEYWORD_RULES
) -> DataFrame:
    """Label every title by the ordered keyword rules and name the keyword that decided."""
    return (
        events.withColumn("_label", ev.keyword_label(F.col("title"), rules))
        .withColumn("category", F.col("_label")["category"])
        .withColumn("matched_keyword", F.col("_label")["keyword"])
        .drop("_label")
    )


def label_coverage(labelled: DataFrame) -> DataFrame:
    """How many titles a rule matched; NULL percent when there are none."""
    hit = F.coalesce(F.sum((F.col("category") != ev.OTHER_CATEGORY).cast("long")), F.lit(0))
    return (
        labelled.agg(F.count(F.lit(1)).alias("total"), hit.cast("long").alias("matched"))
        .withColumn("unmatched", F.col("total") - F.col("matched"))
        .withColumn("percent", F.expr("try_divide(100 * matched, total)"))
        .withColumn("percent", F.floor("percent").cast("long"))
    )


def unmatched_sample(
    labelled: DataFrame, order: Sequence[str | Column] = EVENT_ORDER, limit: int = 30
) -> DataFrame:
    """First titles in input order that no rule matched."""
    rest = labelled.filter(F.col("category") == ev.OTHER_CATEGORY)
    return rest.orderBy(*order).limit(limit).select("title")


def category_counts(events: DataFrame) -> DataFrame:
    category = F.coalesce("category", F.lit(ev.OTHER_CATEGORY)).alias("category")
    return (
        events.groupBy(category)
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy(F.desc("events"), "category")
    )
