"""Export documents of the checks: digests in place of texts give the rows that the texts give."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import exports as made
from palaver.operators import merge
from palaver.sources import exports
from palaver.sources.tables import Tables

AT = datetime(2024, 1, 2, 3)
MESSAGES = (
    "message_id long, server_id long, channel_id long, channel_name string, user_id long, content string, "
    "created_at timestamp_ntz, edited_at timestamp_ntz, deleted_at timestamp_ntz, is_deleted boolean, "
    "reply_to_message_id long, thread_id long"
)
TEXTS = ["plain", "", None, "[listed]", " ", "0" * 32, "a\nb", "x" * 9000]


@pytest.fixture
def tables(spark):
    rows = [(i, 1, 11, "view", i % 3, text, AT, None, None, False, None, None) for i, text in enumerate(TEXTS * 3)]
    messages = spark.createDataFrame(rows, MESSAGES)
    users = spark.createDataFrame(
        [(1, 1000002, "known", AT, AT)],
        "user_id long, discord_id long, current_username string, created_at timestamp_ntz, last_seen timestamp_ntz",
    )
    return Tables(lambda name: {"messages": messages, "users": users}[name])


def parsed(tables, content=None):
    return exports.normalise(exports.explode_messages(made.export_documents(tables, content)))


def test_digests_stand_for_texts(tables):
    whole = parsed(tables).withColumn("content", F.md5("content"))
    digests = parsed(tables, made.text_digest())
    longest = digests.agg(F.max(F.length("content"))).first()[0]
    assert longest <= 32  # no text enters a document
    digests = digests.withColumn("content", made.content_md5(F.col("content")))
    assert sorted(map(str, digests.collect())) == sorted(map(str, whole.collect()))


def test_merged_digests_are_those_of_merged_texts(tables):
    def merged(rows, stored):
        users = merge.merge_users(tables.users, rows, AT)
        return merge.merge_messages(stored, users, rows)

    texts = merged(parsed(tables), tables.messages).withColumn("content", F.md5("content"))
    rows = parsed(tables, made.text_digest()).withColumn("content", made.content_md5(F.col("content")))
    digests = merged(rows, tables.messages.withColumn("content", F.md5("content")))
    assert sorted(map(str, digests.collect())) == sorted(map(str, texts.collect()))


def test_rows_without_texts_differ_in_nothing_else(tables):
    without = parsed(tables, made.no_text()).drop("content")
    assert sorted(map(str, without.collect())) == sorted(map(str, parsed(tables).drop("content").collect()))
