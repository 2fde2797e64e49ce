"""One load: exported documents into the stored tables."""

from __future__ import annotations

from datetime import datetime, time, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.operators import merge, rollups, search
from palaver.sources import exports
from palaver.sources.large_exports import LargeExports
from palaver.sources.store import INDEX, LEDGER, LOAD, Load, Store, bucket_of


def ingest(
    documents: DataFrame | LargeExports, store: Store, load_time: datetime, load_id: str
) -> DataFrame:
    """Merge a batch of documents and return its statistics per file.

    The documents are parsed once into staged tables that all merges read. Every table is written
    to folders of this load, which readers see at once when the load commits, or never. A load
    that broke may be repeated under its id; one that is done is not repeated, and its statistics
    are returned as they are.
    """
    load = store.begin(load_id)
    if not load.done:
        _merge(documents, load, load_time)
        load.commit()
    return store.log(LEDGER).filter(F.col(LOAD) == load_id).drop(LOAD)


def _merge(documents: DataFrame | LargeExports, load: Load, load_time: datetime) -> None:
    if isinstance(documents, LargeExports):
        files = load.staged("files", documents.files)
        exploded = documents.messages
    else:
        parsed = load.staged("files", exports.file_rows(documents))
        files, exploded = parsed.drop("messages"), exports.explode_file_rows(parsed)
    rows = load.staged("rows", exports.normalise(exploded))
    broken = files.filter(F.col("error").isNotNull()).select(
        "file_path", F.lit(None).cast("int").alias("pos"), F.col("error").alias("reason")
    )
    skipped = rows.filter(F.col("reject").isNotNull()).select(
        "file_path", "pos", F.col("reject").alias("reason")
    )
    load.publish_log("rejects", broken.unionByName(skipped))

    base = load.base
    usable = files.filter(F.col("error").isNull())
    server_folders = load.touched(usable, "server_id")
    user_folders = load.touched(exports.author_rows(rows), "discord_id")
    message_folders = load.touched(exports.message_rows(rows), "message_id")

    known_messages = base.table("messages", message_folders)
    load.publish_log("import_stats", merge.import_stats(known_messages, files, rows))
    known_users = base.table("users", user_folders)
    load.publish_log("username_history", merge.username_changes(known_users, rows, load_time))

    servers = merge.merge_servers(base.table("servers", server_folders), files, load_time)
    load.publish("servers", servers)
    users = load.publish("users", merge.merge_users(known_users, rows, load_time))
    members = base.table("server_members", server_folders)
    load.publish("server_members", merge.merge_members(members, users, rows, load_time))
    messages = load.publish(
        "messages",
        merge.changed_messages(known_messages, users, rows),
        kept=merge.kept_messages(known_messages, rows),
    )
    if load.store.search_index:
        index = search.postings(messages)
        order, folder = ["gram", "message_id"], bucket_of("message_id")
        load.publish(INDEX, index, folder=folder, sort=order, covers=message_folders)
    if load.store.daily_rollups:
        _roll_up(load, messages, rows)


def _roll_up(load: Load, messages: DataFrame, rows: DataFrame) -> None:
    """Count the weeks anew in which the load's messages lie, from all folders that reach into them."""
    ids = exports.message_rows(rows).select("message_id").distinct()
    week = rollups.week_no(F.col("created_at").cast("date"))
    touched = messages.join(ids, "message_id", "left_semi").select(week).distinct()
    weeks = sorted(row[0] for row in touched.collect())  # bound by the weeks there are
    starts = [datetime.combine(rollups.FIRST_MONDAY, time()) + timedelta(weeks=w) for w in weeks]
    spans = [(start, start + timedelta(weeks=1)) for start in starts]
    live = load.view().table("messages", spans=spans).filter(~F.col("is_deleted") & week.isin(weeks))

    known = load.base.log("user_numbers").drop(LOAD)
    load.publish_log("user_numbers", rollups.new_user_numbers(known, live))
    numbers = load.view().log("user_numbers").drop(LOAD)
    folder = rollups.week_no("day")
    load.publish("daily_channels", rollups.daily_channels(live), folder=folder, instead_of=weeks)
    load.publish("daily_users", rollups.daily_users(live, numbers), folder=folder, instead_of=weeks)
