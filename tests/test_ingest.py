"""Export documents: scalars, rejects, merges, repeated loads, stream against batch."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from palaver.functions import ingest as fn
from palaver.operators import merge
from palaver.plans.ingest import ingest
from palaver.sources import exports
from palaver.sources.store import Store
from palaver.streaming.incremental import incremental_ingest

T1, T2 = datetime(2024, 5, 1), datetime(2024, 5, 2)
BIG = 123456789012345678


def message(id, author=1, name="ann", content="hi", timestamp="2024-01-15T14:32:00.000+00:00", **more):
    return {
        "id": str(id), "timestamp": timestamp, "content": content,
        "author": {"id": str(author), "name": name, "discriminator": "0000"}, **more,
    }


def document(*messages, guild=10, guild_name="Home", channel=20, channel_name="talk", type="GuildTextChat"):
    return {
        "guild": {"id": str(guild), "name": guild_name},
        "channel": {"id": str(channel), "name": channel_name, "type": type},
        "messages": list(messages),
        "extra": {"ignored": True},
    }


def write(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in files.items():
        text = content if isinstance(content, str) else json.dumps(content)
        (folder / f"{name}.json").write_text(text, encoding="utf-8")
    return str(folder)


def rows_of(spark, path):
    return exports.normalise(exports.explode_messages(exports.read_exports(spark, path)))


def values(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=repr)


def test_ids_and_times(spark):
    frame = spark.createDataFrame(
        [(str(BIG), "2024-01-15T14:32:00.000+00:00"), ("7", "2024-01-15T14:32:00+02:00"),
         ("x", "2024-01-15T14:32:00Z"), ("1.5", "2024-01-15 14:32:00"), (None, ""),
         ("", "bad"), (" 9 ", None), ("1", "2024-01-15"), ("2", "12:30"), ("3", "2024-13-45T00:00:00Z"),
         ("4", "2024-03-31T02:30:00.123456")],
        "id string, ts string",
    )
    noon = datetime(2024, 1, 15, 14, 32)
    for zone in ("UTC", "Europe/Helsinki"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = frame.select(fn.parse_id(F.col("id")), fn.parse_ts(F.col("ts"))).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert [r[0] for r in got] == [BIG, 7, None, None, None, None, 9, 1, 2, 3, 4]
        assert [r[1] for r in got] == [
            noon, datetime(2024, 1, 15, 12, 32), noon, noon, None, None, None,
            datetime(2024, 1, 15), None, None, datetime(2024, 3, 31, 2, 30, 0, 123456),
        ]


def test_names_content_threads(spark, tmp_path):
    def named(i, **author):
        return {"id": i, "timestamp": "2024-01-01T00:00:00Z", "content": "x", "author": {"id": i, **author}}

    files = [{"fileName": "a.png"}, {"fileName": "b.png"}]
    path = write(
        tmp_path / "in",
        names=document(
            named(1, name="ann", discriminator="0"), named(2, name="ann", discriminator="0000"),
            named(3, name="ann", discriminator=""), named(4, name="ann", discriminator="1234"),
            named(5, name="ann"), named(6, name="ann", nickname=""),
            named(7, name="ann", nickname="Queen", discriminator="1234"), named(8),
        ),
        contents=document(
            message(11, content="", attachments=files), message(12, content="", attachments=[]),
            message(13, content="text", attachments=files), message(14, content="", attachments=[{}]),
            message(15, content=None, reference={"messageId": "11"}),
            message(16, reference=None), type="GuildPublicThread",
        ),
    )
    rows = rows_of(spark, path)
    assert dict(values(rows.filter("message_id < 10"), "message_id", "username")) == {
        1: "ann", 2: "ann", 3: "ann", 4: "ann#1234", 5: "ann", 6: "ann", 7: "Queen#1234", 8: "unknown",
    }
    thread = rows.filter("message_id > 10")
    assert dict(values(thread, "message_id", "content")) == {
        11: "[a.png, b.png]", 12: "", 13: "text", 14: "[attachment]", 15: "", 16: "hi",
    }
    assert {r[0] for r in values(thread, "thread_id")} == {20}
    assert {r[0] for r in values(rows.filter("message_id < 10"), "thread_id")} == {None}
    assert values(thread.filter("reply_to_message_id is not null"), "message_id") == [(15,)]


def unusable(tmp_path):
    no_author = message(2)
    no_author["author"] = {"name": "ghost"}
    return write(
        tmp_path / "bad",
        broken='{"guild": {"id": "1"',
        no_guild={"channel": {"id": "1"}, "messages": [message(1)]},
        no_channel={"guild": {"id": "1"}, "messages": [message(1)]},
        empty=document(guild=77, guild_name="Quiet"),
        skips=document(
            message("x"), no_author, message(3, author=33, name="late", timestamp="bad"), message(4)
        ),
    )


def short(path):
    return path.rsplit("/", 1)[-1]


def test_rejects_and_preview(spark, tmp_path):
    path = unusable(tmp_path)
    documents = exports.read_exports(spark, path)
    found = exports.rejects(documents, rows_of(spark, path)).collect()
    assert sorted((short(r.file_path), r.pos, r.reason) for r in found) == [
        ("broken.json", None, "unreadable file"),
        ("no_channel.json", None, "no channel id"),
        ("no_guild.json", None, "no guild id"),
        ("skips.json", 0, "no message id"),
        ("skips.json", 1, "no author id"),
        ("skips.json", 2, "no timestamp"),
    ]
    preview = exports.import_preview(documents).collect()
    assert sorted((short(r.file_path), r.new) for r in preview) == [("empty.json", 0), ("skips.json", 4)]


def test_load_counts_and_stores(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    stats = ingest(exports.read_exports(spark, unusable(tmp_path)), store, T1, "a").collect()
    assert sorted((short(r.file_path), r.new, r.updated, r.skipped, r.errors) for r in stats) == [
        ("broken.json", 0, 0, 0, 1), ("empty.json", 0, 0, 0, 0), ("no_channel.json", 0, 0, 0, 1),
        ("no_guild.json", 0, 0, 0, 1), ("skips.json", 1, 0, 3, 0),
    ]
    tables = store.tables()
    assert values(tables.messages, "message_id") == [(4,)]
    # The author of the message without a usable time is still known.
    assert values(tables.users, "discord_id", "current_username") == [(1, "ann"), (33, "late")]
    assert values(tables.servers, "server_id", "server_name") == [(10, "Home"), (77, "Quiet")]
    assert values(tables.server_members, "server_id", "user_id", "is_active") == [
        (10, 1, True), (10, 33, True),
    ]


def two_loads(tmp_path):
    first = write(
        tmp_path / "one",
        a=document(
            message(BIG, name="A", content="old"), message(BIG + 1, name="B"), message(5, name="A"),
            message(6, author=2, name="bob"),
        ),
        b=document(message(BIG, name="A", content="new", timestampEdited="2024-01-16T00:00:00Z"),
                   guild=11, channel=21, channel_name="other"),
    )
    second = write(
        tmp_path / "two",
        a=document(message(BIG, name="C", content="newer"), guild_name="Renamed"),
        c=document(message(9, author=3, name="cat"), guild_name="Renamed"),
    )
    return first, second


def check_two_loads(store):
    tables = store.tables()
    row = tables.messages.filter(F.col("message_id") == BIG).first()
    assert (row.server_id, row.channel_id, row.channel_name, row.content, row.edited_at) == (
        10, 20, "talk", "newer", None,
    )
    assert values(tables.messages, "message_id") == [(123456789012345678,), (123456789012345679,), (5,), (6,), (9,)]
    assert values(tables.users, "discord_id", "current_username", "created_at", "last_seen") == [
        (1, "C", T1, T2), (2, "bob", T1, T1), (3, "cat", T2, T2),
    ]
    assert values(tables.username_history, "changed_from", "username", "changed_at") == [
        ("A", "B", T1), ("A", "C", T2), ("B", "A", T1),
    ]
    assert values(tables.servers, "server_id", "server_name", "monitored_from") == [
        (10, "Renamed", T1), (11, "Home", T1),
    ]
    assert values(tables.server_members, "server_id", "user_id", "joined_at") == [
        (10, 1, T1), (10, 2, T1), (10, 3, T2), (11, 1, T1),
    ]


def test_two_loads_and_repeats(spark, tmp_path):
    first, second = two_loads(tmp_path)
    store = Store(spark, str(tmp_path / "store"))
    stats = ingest(exports.read_exports(spark, first), store, T1, "1").collect()
    assert sorted((short(r.file_path), r.new, r.updated) for r in stats) == [
        ("a.json", 4, 0), ("b.json", 0, 1),
    ]
    ingest(exports.read_exports(spark, second), store, T2, "2")
    check_two_loads(store)
    # A load that is repeated, as after a failure, changes nothing.
    ingest(exports.read_exports(spark, second), store, T2, "2")
    check_two_loads(store)
    # The same files as a later load bring no new row.
    again = ingest(exports.read_exports(spark, second), store, T2, "3").collect()
    assert sum(r.new for r in again) == 0 and sum(r.updated for r in again) == 2
    totals = merge.import_totals(store.log("import_stats").filter("load_id = '3'"), store.table("messages"))
    assert tuple(totals.first()) == (0, 2, 0, 0, 5)


def test_stream_equals_batch(spark, tmp_path):
    first, second = two_loads(tmp_path)
    store = Store(spark, str(tmp_path / "stream"))
    inbox = tmp_path / "inbox"
    for source, clock in ((first, T1), (second, T2)):
        for file in sorted(__import__("pathlib").Path(source).iterdir()):
            target = inbox / source.rsplit("/", 1)[-1] / file.name
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_text(file.read_text())
        query = incremental_ingest(
            spark, str(inbox), store, str(tmp_path / "progress"), clock=lambda now=clock: now
        )
        query.awaitTermination()
    check_two_loads(store)
    before = store.log("import_stats").count()
    incremental_ingest(spark, str(inbox), store, str(tmp_path / "progress")).awaitTermination()
    assert store.log("import_stats").count() == before


def test_reimport_revives_deleted_message_and_member(spark):
    rows = spark.createDataFrame(
        [("f", 0, 10, "Home", 20, "talk", 5, 1, "ann", T1, None, "back", None, None, None)],
        "file_path string, pos int, server_id long, server_name string, channel_id long, "
        "channel_name string, message_id long, discord_id long, username string, "
        "created_at timestamp_ntz, edited_at timestamp_ntz, content string, "
        "reply_to_message_id long, thread_id long, reject string",
    )
    users = spark.createDataFrame(
        [(100, 1, "ann", T1, T1)],
        "user_id long, discord_id long, current_username string, created_at timestamp_ntz, "
        "last_seen timestamp_ntz",
    )
    stored = spark.createDataFrame(
        [(5, 10, 20, "talk", 100, "gone", T1, None, T1, True, None, None),
         (6, 10, 20, "talk", 100, "other", T1, None, T1, True, None, None)],
        "message_id long, server_id long, channel_id long, channel_name string, user_id long, "
        "content string, created_at timestamp_ntz, edited_at timestamp_ntz, "
        "deleted_at timestamp_ntz, is_deleted boolean, reply_to_message_id long, thread_id long",
    )
    merged = merge.merge_messages(stored, users, rows)
    assert values(merged, "message_id", "content", "is_deleted") == [(5, "back", False), (6, "other", True)]
    members = spark.createDataFrame(
        [(10, 100, T1, T2, False)],
        "server_id long, user_id long, joined_at timestamp_ntz, left_at timestamp_ntz, is_active boolean",
    )
    again = merge.merge_members(members, users, rows, T2)
    assert values(again, "joined_at", "left_at", "is_active") == [(T1, T2, True)]


def test_hot_author_across_files(spark):
    names = [["A", "A", "B"], ["B", "B"], ["A"], ["A", "C", "C", "A"]]
    rows = [
        (f"f{i}", j, 1, name, 1) for i, part in enumerate(names) for j, name in enumerate(part)
    ]
    frame = spark.createDataFrame(
        rows, "file_path string, pos int, discord_id long, username string, message_id long"
    )
    stored = spark.createDataFrame([(100, 1, "Z")], "user_id long, discord_id long, current_username string")
    got = merge.username_changes(stored, frame, T1)
    assert values(got, "change_no", "changed_from", "username") == [
        (1, "Z", "A"), (2, "A", "B"), (3, "B", "A"), (4, "A", "C"), (5, "C", "A"),
    ]


@pytest.mark.parametrize("name", ["plain", "with space", "50% + more"])
def test_paths_are_decoded(spark, tmp_path, name):
    path = write(tmp_path / name, x=document(message(1)))
    assert rows_of(spark, path).first().file_path.endswith(f"/{name}/x.json")
