"""Search by trigrams and daily rollups in a store, against the full scan."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_ingest import document, message, write
from test_store import at, load, opened

from palaver.operators import queries, rollups, search, weekly
from palaver.sources.store import Store
from palaver.sources.tables import Tables

NOW = datetime(2024, 3, 1)
TEXTS = [
    "Hack Night on Friday", "hack night", "HACKNIGHT", "100% sure_thing", "a_b c%d", "back\\slash it", "ab", "",
    "İstanbul ſtraße K", "ΑΣ ΣΑΣ ας", "the night 😀 is young", "n1ght hack",
]
TERMS = [
    "hack", "HACK", "night", "hack night", "h_ck", "hack%night", "n_ght", "ab", "a", "", "100\\%", "sure\\_thing", "a\\_b",
    "c\\%d", "\\\\slash", "straße", "istanbul", "σας", "ας", "😀", "t 😀 i", "%", "___", "zzz", "night%zzz", "k",
]


def stamp(moment):
    return moment.strftime("%Y-%m-%dT%H:%M:%S.000+00:00")


def post(day, author=1, content="x", number=0, **more):
    moment = NOW - timedelta(days=day, hours=1)
    return message(at(moment) + number, author=author, name=f"u{author}", content=content, timestamp=stamp(moment), **more)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """Three loads: messages of three months; an edit, late and new ones; a thread and a second server of the same name."""
    folder = tmp_path_factory.mktemp("indexed")
    store = Store(spark, str(folder / "store"), search_index=True, daily_rollups=True)
    first = [post(7 * i, author=1 + i % 3, content=text, number=i) for i, text in enumerate(TEXTS)]
    load(spark, store, write(folder / "1", a=document(*first)), NOW, "1")
    second = [
        post(7, author=2, content="edited to a hackathon", number=1, timestampEdited=stamp(NOW)),
        post(50, author=9, content="late night", number=99), post(0, author=9, content="fresh hack", number=98),
        post(6, author=4, content="six days", number=97),
    ]
    load(spark, store, write(folder / "2", a=document(*second)), NOW, "2")
    third = [post(1, author=5, number=50), post(2, author=1, number=51), post(1, author=1, number=52)]
    path = write(folder / "3", a=document(*third, guild=11, channel=31, type="GuildPublicThread"))
    load(spark, store, path, NOW, "3")
    return store


def plain(snapshot):
    """The same tables without index, zone maps or rollups."""
    return Tables(lambda name: snapshot.log(name).drop("load_id") if name == "username_history" else snapshot.table(name))


def rows(frame):
    return [tuple(r) for r in frame.collect()]


@pytest.mark.parametrize("term", TERMS)
def test_search_is_equal_with_and_without_index(store, term):
    snapshot = store.snapshot()
    found = rows(queries.search_messages(snapshot.tables(), term))
    assert found == rows(queries.search_messages(plain(snapshot), term))


def test_index_chooses_folders(store):
    tables = store.snapshot().tables()
    everything = opened(tables.messages)
    one = opened(queries.search_messages(tables, "late night"))
    assert len(one) == 1 < len(everything)
    assert opened(queries.search_messages(tables, "zzz")) == set()
    # Too short for a trigram: every folder is read.
    assert opened(queries.search_messages(tables, "ni")) == everything


def test_folder_without_index_is_read(spark, tmp_path):
    """Also a store that had no index at first finds every row."""
    store = Store(spark, str(tmp_path / "store"))
    load(spark, store, write(tmp_path / "1", a=document(post(60, content="old hack"))), NOW, "1")
    store.search_index = True
    load(spark, store, write(tmp_path / "2", a=document(post(0, content="new hack"))), NOW, "2")
    found = queries.search_messages(store.tables(), "hack").select("content")
    assert rows(found) == [("new hack",), ("old hack",)]


def test_literal_parts():
    assert search.literal_parts(r"%a\%b_cd\\e%") == ["", "a%b", r"cd\e", ""]
    assert search.literal_parts("x\\") == ["x\\"]


def check_rollups(snapshot):
    tables, rolled = plain(snapshot), snapshot.rollups()
    servers = tables.servers
    assert rows(rollups.weekly_active_users(rolled)) == rows(queries.weekly_active_users(tables))
    assert rows(rollups.weekly_active_users(rolled, 10)) == rows(queries.weekly_active_users(tables, 10))
    for as_of in (NOW, NOW - timedelta(hours=1), NOW - timedelta(days=1, hours=1, seconds=1), NOW - timedelta(days=40)):
        for days in (1, 7, 30):
            got = rollups.server_stats(rolled, servers, as_of, days)
            assert rows(got) == rows(weekly.server_stats(tables, as_of, days)), (as_of, days)
        for by_name in (True, False):
            got = rollups.weekly_trends(rolled, servers, as_of, 8, by_name)
            assert rows(got) == rows(weekly.weekly_trends(tables, as_of, 8, by_name)), (as_of, by_name)


def test_rollups_after_late_and_edited_messages(store):
    check_rollups(store.snapshot())


def test_a_load_touches_its_weeks_only(store):
    old, new = store.snapshot(2), store.snapshot(3)
    before = {e.folder: e.load_id for e in old.folders("daily_users")}
    after = {e.folder: e.load_id for e in new.folders("daily_users")}
    changed = {week for week, load_id in after.items() if before.get(week) != load_id}
    touched = {((NOW - timedelta(days=d, hours=1)).date() - rollups.FIRST_MONDAY).days // 7 for d in (1, 2)}
    assert changed == touched and {after[w] for w in changed} == {"3"} and len(before) > 8
    numbers = new.log("user_numbers")
    assert sorted(r[0] for r in numbers.select("user_no").collect()) == list(range(numbers.count()))


def test_a_week_whose_messages_are_gone(spark, tmp_path):
    """A recount that finds nothing in a touched week takes its folder away."""
    store = Store(spark, str(tmp_path / "store"), daily_rollups=True)
    load(spark, store, write(tmp_path / "1", a=document(post(0), post(30))), NOW, "1")
    started = store.begin("2")
    weeks = [e.folder for e in store.snapshot().folders("daily_channels")]
    live = store.table("messages").filter(F.col("created_at") > NOW - timedelta(days=7))
    started.publish(
        "daily_channels", rollups.daily_channels(live), folder=rollups.week_no("day"), instead_of=weeks
    )
    assert [e.rows for e in started.view().folders("daily_channels")] == [1]
    assert len(weeks) == 2
