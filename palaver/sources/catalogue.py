"""CSV source and sinks of the weekly table and the event catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver import schemas

# Column order of the written files.
WEEKLY_COLUMNS = ("week_start", "active_users", "total_messages")
EVENT_COLUMNS = ("title", "date", "category", "source_channel", "raw_text")
LABELLED_COLUMNS = ("title", "date", "category", "matched_keyword", "source_channel", "raw_text")


def read_events_csv(spark: SparkSession, path: str) -> DataFrame:
    """Event catalogue with a header, quoted multi-line fields and only string columns."""
    return (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .schema(schemas.EVENT_CATALOGUE)
        .option("enforceSchema", False)
        .csv(path)
        .na.fill("")
    )


def _write(frame: DataFrame, path: str) -> None:
    (
        frame.write.option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )


def write_weekly_csv(weekly: DataFrame, path: str) -> None:
    """Newest week first; the part files follow each other in that order."""
    _write(weekly.select(*WEEKLY_COLUMNS).orderBy(F.desc("week_start")), path)


def event_rows(events: DataFrame) -> DataFrame:
    """Catalogue rows in date-string order, undated events first."""
    return _dated(events, EVENT_COLUMNS)


def labelled_rows(events: DataFrame) -> DataFrame:
    return _dated(events, LABELLED_COLUMNS)


def _dated(events: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    undated_first = F.coalesce("date", F.lit(""))
    return events.select(*columns).orderBy(undated_first, "title", "source_channel")


def write_events_csv(events: DataFrame, path: str) -> None:
    _write(event_rows(events), path)


def write_labelled_csv(events: DataFrame, path: str) -> None:
    """Same with ``matched_keyword``. The target is a new path: Spark reads its input lazily."""
    _write(labelled_rows(events), path)
