"""The weekly report as ordered text lines."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.operators import weekly
from palaver.sources.tables import Tables

ORDER = ("section", "place_1", "place_2", "place_3")

# Headings and tables of the report.
NO_ACTIVITY = "_No activity this period._"
NONE_FOUND = "_None found._"
LINK_HEADER = ("| Date | Server | Channel | User | URL |", "| ---- | ------ | ------- | ---- | --- |")
NEW_ACCOUNT_HEADER = (
    "| Date | Server | Channel | User | Account created | URL |",
    "| ---- | ------ | ------- | ---- | --------------- | --- |",
)
LINK_TITLES = (
    "## Links from deleted accounts",
    "## Shortlinks (destination hidden)",
    "## Links from brand-new accounts (<7 days old)",
)


def _texts(*lines: str | Column) -> Column:
    return F.array(*[F.lit(x) if isinstance(x, str) else x for x in lines])


def _joined(*parts: str | Column) -> Column:
    texts = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.concat(*[F.coalesce(t, F.lit("None")) for t in texts])


def _block(entries: Column, title: Column, lines: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.when(F.size(entries) > 0, F.concat(title, lines, _texts(""))).otherwise(none)


def _server_lines(
    tables: Tables, as_of: datetime, days: int, server_id: int | None, weeks: int, top: int
) -> DataFrame:
    trends = weekly.weekly_trends_nested(tables, as_of, weeks, by_name=False)
    trends = trends.select("server_id", "weeks")
    record = (
        weekly.server_stats_nested(tables, as_of, days, server_id, top)
        .join(trends, "server_id", "left")
        .withColumn(
            "weeks",
            F.coalesce(
                "weeks",
                F.array().cast("array<struct<week:string,posts:bigint,unique_users:bigint>>"),
            ),
        )
    )
    metrics = _texts(
        "| Metric | Value |",
        "| ------ | ----- |",
        _joined("| Messages | ", F.col("total_messages"), " |"),
        _joined("| Unique posters | ", F.col("unique_posters"), " |"),
        _joined("| Active channels | ", F.col("active_channels"), " |"),
        _joined("| Thread messages | ", F.col("thread_messages"), " |"),
        _joined("| New users | ", F.col("new_users"), " |"),
        "",
    )
    users = F.transform(
        "top_users", lambda u: _joined("- **", u["username"], "** — ", u["messages"], " messages")
    )
    channels = F.transform(
        "top_channels", lambda c: _joined("- #", c["channel"], " — ", c["messages"], " messages")
    )
    week_rows = F.transform(
        "weeks",
        lambda w: _joined("| ", w["week"], " | ", w["posts"], " | ", w["unique_users"], " |"),
    )
    trend_title = _texts(
        "", f"**Weekly trend (last {weeks} weeks):**", "",
        "| Week | Posts | Unique users |", "| ---- | ----- | ------------ |",
    )
    busy = F.concat(
        metrics,
        _block(F.col("top_users"), _texts("", "**Top contributors:**", ""), users),
        _block(F.col("top_channels"), _texts("", "**Most active channels:**", ""), channels),
        _block(F.col("weeks"), trend_title, week_rows),
    )
    body = F.when(F.col("total_messages") == 0, _texts(NO_ACTIVITY, "")).otherwise(busy)
    lines = F.concat(_texts("", _joined("## ", F.col("server_name")), ""), body)
    return record.select(
        F.lit(1).alias("section"),
        (-F.col("total_messages")).alias("place_1"),
        F.col("server_id").alias("place_2"),
        F.posexplode(lines).alias("place_3", "line"),
    )


def _link_lines(links: DataFrame, section: int, dated: bool) -> DataFrame:
    cells = ["| ", F.col("date"), " | ", F.col("server_name"), " | #", F.col("channel_name")]
    cells += [" | ", F.col("current_username")]
    if dated:
        cells += [" | ", F.col("account_created")]
    return links.select(
        F.lit(section).alias("section"),
        (-F.unix_micros(F.col("created_at").cast("timestamp"))).alias("place_1"),
        (-F.col("message_id")).alias("place_2"),
        F.col("url_no").alias("place_3"),
        _joined(*cells, " | ", F.col("url"), " |").alias("line"),
    )


def weekly_report(
    tables: Tables,
    as_of: datetime,
    days: int = 7,
    server_id: int | None = None,
    title: str = "Weekly community statistics",
    weeks: int = weekly.TREND_WEEKS,
    top: int = weekly.TOP_N,
) -> DataFrame:
    """The report's lines with their place; ``report_lines`` sorts them.

    ``weeks`` is the length of the trend, ``top`` the number of users and channels of a server.

    The link lists cover all servers also when the statistics are limited to one.
    """
    spark = tables.servers.sparkSession
    lists = weekly.link_lists(tables, as_of, days)
    head = [f"# {title} — {as_of:%Y-%m-%d} (last {days} days)", "", "---", ""]
    scan = ["", "---", "", "# Security Scan", "", "_Flags links that warrant manual review._", ""]
    fixed = [(0, i, text) for i, text in enumerate(head)]
    fixed += [(2, i, text) for i, text in enumerate(scan)]
    zero = F.lit(0).cast("long")
    parts = [
        spark.createDataFrame(fixed, "section int, place_3 int, line string").select(
            "section", zero.alias("place_1"), zero.alias("place_2"), "place_3", "line"
        ),
        _server_lines(tables, as_of, days, server_id, weeks, top),
    ]
    for i, (links, heading) in enumerate(zip(lists, LINK_TITLES)):
        header = NEW_ACCOUNT_HEADER if i == 2 else LINK_HEADER
        opening = F.when(F.col("n") > 0, _texts(*header)).otherwise(_texts(NONE_FOUND))
        parts.append(
            links.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(3 + 2 * i).alias("section"),
                zero.alias("place_1"),
                zero.alias("place_2"),
                F.posexplode(F.concat(_texts("", heading, ""), opening)).alias("place_3", "line"),
            )
        )
        parts.append(_link_lines(links, 4 + 2 * i, dated=i == 2))
    return reduce(DataFrame.unionByName, parts)


def report_lines(report: DataFrame) -> DataFrame:
    return report.orderBy(*ORDER).select("line")


def save_report(report: DataFrame, path: str) -> None:
    """Text part files that follow each other in report order."""
    report_lines(report).write.text(path)
