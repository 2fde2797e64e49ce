"""The full analysis of one server: digest, channel FAQ, member profiles, membership trend."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.operators import prompts, queries
from palaver.operators.ordering import materialise
from palaver.plans.weekly_report import ORDER, _joined, _texts, report_lines, save_report
from palaver.sources.tables import Tables

__all__ = ["analysis_report", "report_lines", "save_report", "ORDER"]

HEALTH_MONTHS = 12


def recent_channel_messages(
    tables: Tables, as_of: datetime, channels: DataFrame, days: int
) -> DataFrame:
    """Live messages in the window of the channels given by ``server_id, channel_id``."""
    authors = tables.users.select("user_id", F.col("current_username").alias("author"))
    return (
        tables.live_within(as_of, days)
        .drop("channel_name")
        .join(channels, ["server_id", "channel_id"])
        .join(authors, "user_id")
    )


def channel_faq(
    tables: Tables, as_of: datetime, channels: DataFrame, days: int, model: Callable[[str], str]
) -> DataFrame:
    """One answer per chunk of every channel. The answers stay rows, in ``chunk_no`` order: a
    busy channel has too many for one value."""
    messages = recent_channel_messages(tables, as_of, channels, days)
    return prompts.apply_model(prompts.channel_faq_prompts(messages), model)


def health_lines(health: DataFrame, months: int = HEALTH_MONTHS) -> DataFrame:
    """Table rows of the newest months with the signed net change."""
    return (
        health.orderBy(F.desc("month"))
        .limit(months)
        .select(
            "month",
            F.format_string(
                "| %s | %d | %d | %+d |",
                F.col("month").cast("string"),
                "new_members",
                "left_members",
                "net_change",
            ).alias("line"),
        )
    )


def analysis_report(
    tables: Tables,
    as_of: datetime,
    server_id: int,
    model: Callable[[str], str],
    days: int = 30,
    channel_term: str = "discussion",
    channel_limit: int | None = 1,
    months: int = HEALTH_MONTHS,
    users: int = 10,
    digest_messages: int = 60,
    profile_chunks: int | None = None,
) -> DataFrame:
    """The report's lines with their place; model texts come from the caller's function.

    It answers for the first ``channel_limit`` channels that match the term (all for None), the ``users`` most
    active members, each by all chunks of their messages or the first ``profile_chunks``, and the
    newest ``months``; the digest takes the ``digest_messages`` newest messages.
    """
    server = queries.server_by_id(tables, server_id)
    channel = queries.find_channel(tables, server_id, channel_term, channel_limit).withColumn(
        "server_id", F.lit(server_id).cast("long")
    )
    # Answers are written down, so that sorting the report does not ask the model again.
    digest = materialise(
        prompts.apply_model(
            prompts.digest_prompts(tables, as_of, server_id, days, limit=digest_messages), model
        )
    )
    faq = materialise(channel_faq(tables, as_of, channel, days, model))
    profiles = materialise(
        prompts.apply_model(
            prompts.user_story_prompts(tables, as_of, server_id, days, users, chunks=profile_chunks),
            model,
            answer="profile",
        )
    )
    health = queries.server_health(tables, server_id)

    zero = F.lit(0).cast("long")

    def placed(frame: DataFrame, section: int, first, second, lines, before=F.lit(0)) -> DataFrame:
        """``before`` is the number of places that earlier rows of the same two places may take."""
        return frame.select(
            F.lit(section).alias("section"),
            first.cast("long").alias("place_1"),
            second.cast("long").alias("place_2"),
            before.cast("int").alias("before"),
            F.posexplode(lines).alias("place_3", "line"),
        ).select("section", "place_1", "place_2", (F.col("before") + F.col("place_3")).alias("place_3"), "line")

    opening = _texts(
        _joined("# ", F.col("server_name"), " — Full Analysis"),
        f"_Generated {as_of:%Y-%m-%d %H:%M} · last {days} days_",
        "", "---", "", "", "", "## Weekly Digest", "",
        F.coalesce("answer", F.lit("_No activity in this period._")),
        "", "", f"## Channel FAQ — #{channel_term}", "",
    )
    no_faq = (
        F.when(F.col("answers") > 0, F.array().cast("array<string>"))
        .when(F.col("channels") > 0, _texts("_No messages in this period._"))
        .otherwise(_texts("_Channel not found._"))
    )
    counts = faq.agg(F.count(F.lit(1)).alias("answers")).select(
        "answers", channel.agg(F.count(F.lit(1))).scalar().alias("channels")
    )
    title = _joined("### ", F.col("current_username"), " (", F.col("message_count"), " messages)")
    profile = F.when(F.col("chunk_no") == 0, _texts("", title, "", F.col("profile"))).otherwise(
        _texts("", F.col("profile"))
    )
    table_head = F.when(
        F.col("n") > 0,
        _texts("| Month | Joined | Left | Net |", "| ----- | ------ | ---- | --- |"),
    ).otherwise(_texts("_No membership data available._"))
    parts = [
        placed(
            server.join(digest.select("server_id", "answer"), "server_id", "left"),
            0, zero, zero, opening,
        ),
        placed(faq, 1, F.col("channel_id"), F.col("chunk_no"), F.array("answer")),
        placed(counts, 1, zero, zero, no_faq),
        placed(server, 2, zero, zero, _texts("", "", "## User Profiles", "")),
        placed(
            profiles, 3, -F.col("message_count"), F.col("user_id"), profile, 4 * F.col("chunk_no"),
        ),
        placed(
            health.agg(F.count(F.lit(1)).alias("n")), 4, zero, zero,
            F.concat(_texts("", "", "## Server Health — Monthly Trends", ""), table_head),
        ),
        placed(health_lines(health, months), 5, -F.unix_date("month"), zero, F.array("line")),
    ]
    return reduce(DataFrame.unionByName, parts)
