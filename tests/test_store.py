"""The versioned store: broken and repeated loads, whole versions only, time windows, clean-up."""

import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from palaver.operators import queries, weekly
from palaver.plans.ingest import ingest
from palaver.sources import exports
from palaver.sources.store import ConcurrentLoadError, Load, Store, bucket_of
from palaver.streaming.incremental import incremental_ingest
from test_ingest import BIG, T1, T2, check_two_loads, document, message, two_loads, values, write

TABLES = ("servers", "users", "messages", "server_members")


def load(spark, store, path, time, name):
    return ingest(exports.read_exports(spark, path), store, time, name)


def content(store):
    snapshot = store.snapshot()
    rows = {name: sorted(map(repr, snapshot.table(name).collect())) for name in TABLES}
    rows["history"] = sorted(map(repr, snapshot.log("username_history").drop("load_id").collect()))
    return rows


class Broken(Exception):
    pass


@pytest.fixture(scope="module")
def one_load(spark, tmp_path_factory):
    """A store after its first load, and the files of the second."""
    folder = tmp_path_factory.mktemp("one")
    first, second = two_loads(folder)
    load(spark, Store(spark, str(folder / "store")), first, T1, "1")
    return folder / "store", second


@pytest.mark.parametrize("step", range(8))
def test_load_broken_between_any_two_tables(spark, tmp_path, monkeypatch, one_load, step):
    """After a break the version before stands; the repeated load ends like one that never broke."""
    first, second = one_load
    shutil.copytree(first, tmp_path / "store")
    store = Store(spark, str(tmp_path / "store"))
    before, held = content(store), store.snapshot()
    write_folders, commit, done = Load._write, Load.commit, []

    def count_down(name):
        if len(done) == step:
            raise Broken(name)
        done.append(name)

    def breaking_write(self, name, frame, folder):
        count_down(name)
        return write_folders(self, name, frame, folder)

    def breaking_commit(self):
        count_down("commit")
        return commit(self)

    monkeypatch.setattr(Load, "_write", breaking_write)
    monkeypatch.setattr(Load, "commit", breaking_commit)
    with pytest.raises(Broken):
        load(spark, store, second, T2, "2")
    monkeypatch.undo()
    assert content(store) == before and store.versions() == [1]
    load(spark, store, second, T2, "2")
    check_two_loads(store)
    # A reader that held the version before still reads it.
    assert sorted(map(repr, held.table("messages").collect())) == before["messages"]


def test_manifest_without_its_mark_is_no_version(spark, tmp_path):
    """The job dies while the manifest is written: its folder is there, its mark is not."""
    first, second = two_loads(tmp_path)
    store = Store(spark, str(tmp_path / "store"))
    load(spark, store, first, T1, "1")
    before = content(store)
    load(spark, store, second, T2, "2")
    (tmp_path / "store" / "_manifest" / "version=000000000002" / "_SUCCESS").unlink()
    assert store.versions() == [1] and content(store) == before
    load(spark, store, second, T2, "2")
    check_two_loads(store)
    assert store.versions() == [1, 3]


def test_done_load_is_not_repeated(spark, tmp_path):
    first, second = two_loads(tmp_path)
    store = Store(spark, str(tmp_path / "store"))
    stats = load(spark, store, first, T1, "1").collect()
    # Other files under a done id change nothing: the ledger knows the load.
    again = load(spark, store, second, T2, "1").collect()
    assert sorted(map(repr, again)) == sorted(map(repr, stats)) and store.versions() == [1]
    with pytest.raises(ValueError):
        store.begin("../x")


def test_load_on_an_old_version_is_refused(spark, tmp_path):
    first, second = two_loads(tmp_path)
    store = Store(spark, str(tmp_path / "store"))
    late = store.begin("late")
    load(spark, store, first, T1, "1")
    with pytest.raises(ConcurrentLoadError):
        late.commit()
    load(spark, store, second, T2, "2")
    check_two_loads(store)


def test_expire_keeps_what_versions_name(spark, tmp_path):
    first, second = two_loads(tmp_path)
    store = Store(spark, str(tmp_path / "store"))
    load(spark, store, first, T1, "1")
    load(spark, store, second, T2, "2")
    load(spark, store, second, T2, "3")
    store.begin("broken").publish("servers", store.table("servers"))
    store.expire(keep=1)
    assert store.versions() == [3]
    messages = tmp_path / "store" / "messages"
    assert not (tmp_path / "store" / "servers" / "load_id=broken").exists()
    assert {p.name for p in messages.iterdir()} <= {"load_id=1", "load_id=2", "load_id=3"}
    assert values(store.table("users"), "discord_id") == [(1,), (2,), (3,)]
    assert len(values(store.table("messages"), "message_id")) == 5
    assert len(values(store.log("username_history"), "username")) >= 3


def test_checkpoint_made_again_at_the_same_path_loses_nothing(spark, tmp_path):
    """Batch 0 of the new checkpoint is another load than batch 0 of the deleted one."""
    store = Store(spark, str(tmp_path / "store"))
    inbox, checkpoint = tmp_path / "inbox", tmp_path / "progress"

    def run(name, number, time):
        write(inbox, **{name: document(message(number, name=f"n{number}"))})
        query = incremental_ingest(spark, str(inbox), store, str(checkpoint), clock=lambda: time)
        query.awaitTermination()

    run("a", 1, T1)
    shutil.rmtree(checkpoint)
    run("b", 2, T2)
    snapshot = store.snapshot()
    assert values(snapshot.table("messages"), "message_id") == [(1,), (2,)]
    assert len(snapshot.loads) == 2
    # The second checkpoint read both files; the log of its load is there as well.
    assert values(snapshot.log("username_history"), "changed_from", "username") == [("n1", "n2")]
    assert snapshot.log("import_stats").count() == 3


def at(moment):
    """An id whose high bits are the time, as the platform draws them."""
    return int((moment - datetime(2015, 1, 1)).total_seconds() * 1000) << 22


def opened(frame):
    return {path.split("/messages/")[1].rsplit("/", 1)[0] for path in frame.inputFiles() if "/messages/" in path}


def test_window_opens_only_folders_with_its_days(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    as_of = datetime(2024, 3, 1)
    days = [as_of - timedelta(days=n, hours=1) for n in (0, 2, 6, 8, 20, 40, 90)]

    def text(moment):
        return moment.strftime("%Y-%m-%dT%H:%M:%S.000+00:00")

    path = write(tmp_path / "in", a=document(*(message(at(d), timestamp=text(d)) for d in days)))
    load(spark, store, path, T1, "1")
    # Imported late: an old id, edited now, its time stays; and an old id with a recent time.
    odd = at(as_of - timedelta(days=300))
    path = write(
        tmp_path / "late",
        a=document(message(at(days[5]), timestamp=text(days[5]), content="edited"),
                   message(odd, author=2, name="bob", timestamp=text(as_of - timedelta(days=1)))),
    )
    load(spark, store, path, T2, "2")
    snapshot = store.snapshot()
    tables = snapshot.tables()
    recent = tables.live_within(as_of, 7)
    assert values(recent, "message_id") == sorted([(at(d),) for d in days[:3]] + [(odd,)], key=repr)
    # Folders: those of the three recent ids, and that of the old id with the recent time.
    wanted = {m >> 51 for m in (*(at(d) for d in days[:3]), odd)}
    assert {int(p.split("folder=")[1]) for p in opened(recent)} <= wanted | {at(days[3]) >> 51}
    assert len(opened(recent)) < len(opened(tables.messages))
    whole = type(tables)(lambda name: snapshot.table(name) if name != "username_history" else None)
    for query in (
        lambda t: weekly.server_stats(t, as_of),
        lambda t: queries.recent_active_users(t, as_of, None, 7),
        lambda t: queries.recent_sample(t, as_of, None, 7).select("message_id"),
        lambda t: queries.user_messages(t, as_of, 1, 7),
    ):
        assert sorted(map(repr, query(tables).collect())) == sorted(map(repr, query(whole).collect()))


def test_folder_of_an_id(spark):
    row = spark.range(1).select(bucket_of(F.lit(BIG)), bucket_of(F.lit(-1))).first()
    assert tuple(row) == (BIG >> 51, -1)
