"""The logical tables as versioned snapshots below one shared folder.

Ids are snowflakes: their high bits are the creation time. Every keyed table is laid out in
folders of ``id >> BUCKET_SHIFT`` (about six days each, at most 4,096 over the id range), a
function of the key alone. A load reads just the folders of the ids it brings and writes new
copies of them below its own name; nothing that a reader may see is ever overwritten:

    messages/load_id=<load>/folder=<n>/part-*.parquet
    _manifest/version=<v>/part-*.parquet, _SUCCESS

A version's manifest names the load that holds each folder of each table, with its rows and the range
of its times. It is the last thing a load writes, and it counts once its ``_SUCCESS`` mark is there. So a
reader sees whole loads only, a load that breaks leaves the version before it, and the loads a
manifest names are the ledger that makes a repeated load change nothing. A store has one writer at a
time; a load whose base is no longer the newest version is refused and may be repeated.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from palaver import schemas
from palaver.operators import rollups, search
from palaver.sources import folders
from palaver.sources.tables import Tables

BUCKET_SHIFT = 51
FOLDER = "folder"
LOAD = "load_id"
KEYS = {
    "servers": "server_id",
    "users": "discord_id",
    "messages": "message_id",
    "server_members": "server_id",
    "reactions": "message_id",
}
#: Kept beside the tables: rows that each load adds and no load replaces.
LOGS = {
    "username_history": schemas.USERNAME_HISTORY,
    "rejects": "file_path string, pos int, reason string",
    "import_stats": "file_path string, new long, updated long, skipped long, errors long",
    "user_numbers": rollups.USER_NUMBERS,
}
#: Kept where the store asks for it: the search index, in the folders of the messages it was made from.
INDEX = "message_grams"
#: The time whose range a manifest keeps for every folder.
TIMES = {"messages": "created_at"}
MANIFEST = (
    "name string, folder int, load_id string, rows long, oldest timestamp_ntz, newest timestamp_ntz"
)
#: The log that every load writes; its name there is the proof of the load.
LEDGER = "import_stats"


class ConcurrentLoadError(RuntimeError):
    """Another load was published meanwhile; repeat this one."""


def bucket_of(key: str | Column) -> Column:
    return F.shiftright(key, BUCKET_SHIFT).cast("int")


@dataclass(frozen=True)
class Snapshot:
    """One version of all tables. Its files never change, so a reader may keep it for as long as it likes."""

    spark: SparkSession
    root: str
    version: int
    entries: tuple[Row, ...] = field(repr=False)

    def folders(
        self,
        name: str,
        numbers: Sequence[int] | None = None,
        spans: Sequence[tuple[datetime, datetime]] | None = None,
    ) -> list[Row]:
        """The manifest entries of a table, or of some folders, or of those with a time in one of the spans."""
        wanted = None if numbers is None else set(numbers)
        return [
            e
            for e in self.entries
            if e.name == name
            and (wanted is None or e.folder in wanted)
            and (
                spans is None
                or (e.newest is not None and any(a <= e.newest and e.oldest <= b for a, b in spans))
            )
        ]

    def _read(self, name: str, schema: str, paths: list[str], more: tuple[str, ...] = ()) -> DataFrame:
        kept = [part.split()[0] for part in re.split(r",\s*", schema)] + list(more)
        if not paths:
            empty = ", ".join([schema, *(f"{column} string" for column in more)])
            return self.spark.createDataFrame([], empty)
        extra = "".join(f", {column} string" for column in more)
        reader = self.spark.read.schema(schema + extra).option("basePath", f"{self.root}/{name}")
        return reader.parquet(*paths).select(*kept)

    def read(
        self,
        name: str,
        schema: str,
        numbers: Sequence[int] | None = None,
        spans: Sequence[tuple[datetime, datetime]] | None = None,
    ) -> DataFrame:
        """A table kept in folders; only the folders asked for are opened."""
        chosen = [e for e in self.folders(name, numbers, spans) if e.rows]
        return self._read(
            name, schema, [f"{self.root}/{name}/{LOAD}={e.load_id}/{FOLDER}={e.folder}" for e in chosen]
        )

    def table(
        self,
        name: str,
        numbers: Sequence[int] | None = None,
        spans: Sequence[tuple[datetime, datetime]] | None = None,
    ) -> DataFrame:
        return self.read(name, schemas.TABLES[name], numbers, spans)

    def log(self, name: str) -> DataFrame:
        """The rows of all loads with the load that brought them."""
        paths = [f"{self.root}/{name}/{LOAD}={e.load_id}" for e in self.folders(name)]
        return self._read(name, LOGS[name], paths, (LOAD,))

    def tables(self) -> Tables:
        def load(name: str) -> DataFrame:
            return self.table(name) if name in KEYS else self.log(name).drop(LOAD)

        return Tables(load, self.messages_since, self.messages_containing)

    def messages_since(self, since: datetime) -> DataFrame:
        """The messages of the folders that hold one at or after a time."""
        return self.table("messages", spans=[(since, datetime.max)])

    def messages_containing(self, term: str) -> DataFrame:
        """The messages that may match a search term, by the index; folders without one are read whole."""
        grams = search.pattern_grams(self.spark, term)
        indexed = {(e.folder, e.load_id) for e in self.folders(INDEX)}
        known = [e.folder for e in self.folders("messages") if (e.folder, e.load_id) in indexed]
        if not grams or not known:
            return self.table("messages")
        ids = search.candidate_ids(self.read(INDEX, search.GRAMS, known), grams)
        # Bound by the number of folders.
        hit = [row[0] for row in ids.select(bucket_of("message_id")).distinct().collect()]
        rest = {e.folder for e in self.folders("messages")} - set(known)
        found = self.table("messages", hit).join(ids, "message_id", "left_semi")
        return found.unionByName(self.table("messages", sorted(rest))) if rest else found

    def rollups(self) -> rollups.Rollups:
        """The daily rollups; the store must keep them."""
        daily = [self.read(name, schema) for name, schema in rollups.ROLLUPS.items()]

        def live_since(since: datetime) -> DataFrame:
            return self.messages_since(since).filter(~F.col("is_deleted"))

        return rollups.Rollups(*daily, self.log("user_numbers").drop(LOAD), live_since)

    @property
    def loads(self) -> set[str]:
        return {e.load_id for e in self.entries if e.name == LEDGER}


class Store:
    """The versions below one shared folder. Nothing is cached: every call sees the newest version.

    ``search_index`` and ``daily_rollups`` make every load keep a trigram index of the messages it writes, and
    the rollups of the weeks it touches. Both hold for a store from its first load on.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        search_index: bool = False,
        daily_rollups: bool = False,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.search_index = search_index
        self.daily_rollups = daily_rollups

    def _version_path(self, version: int) -> str:
        return f"{self.root}/_manifest/version={version:012d}"

    def _versions(self, complete: bool = True) -> list[int]:
        names = folders.children(self.spark, f"{self.root}/_manifest")
        found = sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))
        if not complete:
            return found
        # Only the newest can be unfinished, or one that a broken load left before it.
        return [v for v in found if folders.exists(self.spark, f"{self._version_path(v)}/_SUCCESS")]

    def versions(self) -> list[int]:
        return self._versions()

    def newest(self) -> int:
        """The newest whole version, 0 before the first load."""
        for version in reversed(self._versions(complete=False)):
            if folders.exists(self.spark, f"{self._version_path(version)}/_SUCCESS"):
                return version
        return 0

    def snapshot(self, version: int | None = None) -> Snapshot:
        """A version, the newest unless one is named."""
        version = self.newest() if version is None else version
        entries: list[Row] = []
        if version:
            # One row for each folder of a table and each log of a load: bound by the id range and the loads.
            entries = self.spark.read.schema(MANIFEST).parquet(self._version_path(version)).collect()
        return Snapshot(self.spark, self.root, version, tuple(entries))

    def tables(self) -> Tables:
        return self.snapshot().tables()

    def table(self, name: str, numbers: Sequence[int] | None = None) -> DataFrame:
        return self.snapshot().table(name, numbers)

    def log(self, name: str) -> DataFrame:
        return self.snapshot().log(name)

    def begin(self, load_id: str) -> Load:
        """A load on top of the newest version. Its id names folders: letters, digits, dots, dashes."""
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", load_id):
            raise ValueError(f"not a load id: {load_id!r}")
        return Load(self, load_id, self.snapshot())

    def expire(self, keep: int = 10) -> None:
        """Delete all versions but the last ``keep``, and the folders that none of those names.

        Readers of an older version must be done, and no load may be running.
        """
        versions = self._versions()
        kept = versions[-keep:]
        used = {(e.name, e.load_id, e.folder) for v in kept for e in self.snapshot(v).entries}
        loads = {(name, load) for name, load, _ in used}
        for version in self._versions(complete=False):
            if version not in kept:
                folders.delete(self.spark, self._version_path(version))
        for name in folders.children(self.spark, self.root):
            if name.startswith("_"):
                continue
            for part in folders.children(self.spark, f"{self.root}/{name}"):
                load = part.removeprefix(f"{LOAD}=")
                if (name, load) not in loads:
                    folders.delete(self.spark, f"{self.root}/{name}/{part}")
                    continue
                for inner in folders.children(self.spark, f"{self.root}/{name}/{part}"):
                    number = inner.removeprefix(f"{FOLDER}=")
                    if number != inner and (name, load, int(number)) not in used:
                        folders.delete(self.spark, f"{self.root}/{name}/{part}/{inner}")


class Load:
    """New folders on top of a snapshot, seen by nobody until ``commit``.

    A load that broke may be begun again under the same id: its unfinished folders are no part of any
    version and are written anew.
    """

    def __init__(self, store: Store, load_id: str, base: Snapshot):
        self.store = store
        self.spark = store.spark
        self.load_id = load_id
        self.base = base
        self.done = load_id in base.loads
        self._new: list[Row] = []
        self._emptied: set[tuple[str, int]] = set()

    def _path(self, name: str) -> str:
        return f"{self.store.root}/{name}/{LOAD}={self.load_id}"

    def staged(self, name: str, frame: DataFrame) -> DataFrame:
        """A written copy that later steps of this load read instead of recomputing."""
        path = f"{self.store.root}/_staging/{self.load_id}/{name}"
        frame.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def touched(self, rows: DataFrame, key: str) -> list[int]:
        """The folders a batch falls into; their number is bound by the id range."""
        found = rows.select(bucket_of(key).alias(FOLDER)).distinct()
        return sorted(row[0] for row in found.collect() if row[0] is not None)

    def publish(
        self,
        name: str,
        changed: DataFrame,
        kept: DataFrame | None = None,
        folder: Column | None = None,
        sort: Sequence[str] = (),
        instead_of: Sequence[int] = (),
        covers: Sequence[int] = (),
    ) -> DataFrame:
        """Write the folders present in the rows; returns them as written, ``folder`` included.

        Changed rows are gathered by folder into even files (the hint splits a large folder);
        ``kept`` rows come from files of one folder each and are not moved. ``folder`` is the folder
        of a row, the key's unless given; ``sort`` orders the rows of a file. The folders
        ``instead_of`` which the rows are written are gone afterwards, also where no row is left;
        those it ``covers`` are entered as empty.
        """
        number = bucket_of(KEYS[name]) if folder is None else folder
        rows = changed.withColumn(FOLDER, number).hint("rebalance", FOLDER)
        if kept is not None:
            rows = rows.unionByName(kept.withColumn(FOLDER, number))
        if sort:
            rows = rows.sortWithinPartitions(FOLDER, *sort)
        self._emptied |= {(name, n) for n in instead_of}
        written = self._write(name, rows, FOLDER)
        for number in set(covers) - {e.folder for e in self._new if e.name == name}:
            self._add(name, number, 0, None, None)
        return written

    def publish_log(self, name: str, frame: DataFrame) -> DataFrame:
        return self._write(name, frame.hint("rebalance"), None)

    def _write(self, name: str, frame: DataFrame, folder: str | None) -> DataFrame:
        writer = frame.write.mode("overwrite")
        (writer.partitionBy(folder) if folder else writer).parquet(self._path(name))
        written = self.spark.read.schema(frame.schema).parquet(self._path(name))
        if folder is None:
            self._add(name, None, written.count(), None, None)
            return written
        time = F.col(TIMES[name]) if name in TIMES else F.lit(None).cast("timestamp_ntz")
        for row in written.groupBy(folder).agg(F.count(F.lit(1)), F.min(time), F.max(time)).collect():
            self._add(name, *row)
        return written

    def _add(self, name: str, folder: int | None, rows: int, oldest, newest) -> None:
        entry = Row(name=name, folder=folder, load_id=self.load_id, rows=rows, oldest=oldest, newest=newest)
        self._new.append(entry)

    def view(self) -> Snapshot:
        """The tables as they will be after this load, as far as it is written."""
        replaced = {(e.name, e.folder) for e in self._new if e.folder is not None} | self._emptied
        entries = [e for e in self.base.entries if (e.name, e.folder) not in replaced]
        return Snapshot(self.spark, self.store.root, self.base.version, (*entries, *self._new))

    def commit(self) -> Snapshot:
        """Publish all folders of the load at once: the manifest's mark is the switch."""
        store = self.store
        if store.newest() != self.base.version:
            raise ConcurrentLoadError(f"{self.load_id}: version {self.base.version} is no longer the newest")
        entries = [tuple(e) for e in self.view().entries]
        # A version that a broken load left unfinished keeps its number; it is never taken up.
        version = max(store._versions(complete=False), default=0) + 1
        rows = self.spark.createDataFrame(entries, MANIFEST).coalesce(1)
        rows.write.mode("errorifexists").parquet(store._version_path(version))
        folders.delete(self.spark, f"{store.root}/_staging/{self.load_id}")
        return store.snapshot(version)
