"""Row normalisation of exported chat documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Channel types that are threads, and the defaults for missing fields.
THREAD_TYPES = ("GuildPublicThread", "GuildPrivateThread", "GuildNewsThread")
DEFAULT_SERVER_NAME = "Unknown Server"
DEFAULT_CHANNEL_NAME = "unknown"
DEFAULT_AUTHOR_NAME = "unknown"
DEFAULT_ATTACHMENT = "attachment"
NO_DISCRIMINATOR = ("", "0", "0000")


def parse_id(raw: Column) -> Column:
    """Numeric text to bigint, anything else NULL."""
    return raw.try_cast("long")


def parse_ts(raw: Column) -> Column:
    """ISO-8601 text to naive UTC; no offset means UTC; empty or bad text gives NULL.

    Goes through the epoch so the result does not depend on the session time zone.
    """
    offset = raw.rlike(r"[Tt ].*(?:[Zz]|[+-]\d{2}(?::?\d{2}){0,2})$")
    zoned = F.when(offset, raw).otherwise(
        F.concat(raw, F.when(F.length(raw) == 10, F.lit("T00:00:00Z")).otherwise(F.lit("Z")))
    )
    micros = F.unix_micros(F.try_to_timestamp(zoned))
    seconds = (micros.cast("decimal(20,0)") / F.lit(1000000)).cast("decimal(18,6)")
    naive = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}"), naive)


def display_name(author: Column) -> Column:
    """Nickname, else name; a legacy four-digit tag is appended as ``#1234``."""
    name = F.coalesce(author["name"], F.lit(DEFAULT_AUTHOR_NAME))
    display = F.coalesce(F.nullif(author["nickname"], F.lit("")), name)
    tag = F.coalesce(author["discriminator"], F.lit("0000"))
    return F.when(tag.isin(*NO_DISCRIMINATOR), display).otherwise(
        F.concat(display, F.lit("#"), tag)
    )


def message_content(content: Column, attachments: Column) -> Column:
    """The text, or ``[file, file]`` for a message that only carries attachments."""
    text = F.coalesce(content, F.lit(""))
    names = F.transform(
        attachments, lambda a: F.coalesce(a["fileName"], F.lit(DEFAULT_ATTACHMENT))
    )
    listed = F.concat(F.lit("["), F.array_join(names, ", "), F.lit("]"))
    return F.when((text == "") & (F.size(attachments) > 0), listed).otherwise(text)


def is_thread(channel_type: Column) -> Column:
    return F.coalesce(channel_type, F.lit("")).isin(*THREAD_TYPES)


def thread_id(channel_type: Column, channel_id: Column) -> Column:
    return F.when(is_thread(channel_type), channel_id)


def reply_to(reference: Column) -> Column:
    return parse_id(reference["messageId"])
