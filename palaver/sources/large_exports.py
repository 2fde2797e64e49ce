"""Exported documents of any size: messages are read one by one, in bounded batches.

A JSON reader holds a whole document in one row. Here the file is read as pieces of text that end at
``}``, which any number of tasks cut out; the pieces of a file then meet again in order, sorted on disk
if they have to be, and one pass gives out its messages. A task holds one message and one batch,
whatever the length of the file. A document with a broken tail is rejected as a whole, as the plain
reader does, and rows come out as that one gives them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver import schemas
from palaver.operators.ordering import materialise, salted_join
from palaver.sources.exports import CORRUPT, decoded_path, file_rows

#: Bytes of messages that a task gives out at a time.
BATCH_BYTES = 4 << 20

_SPACE = re.compile(rb"[ \t\r\n]*")
_OUTSIDE = re.compile(rb'["{}\[\]]')
_INSIDE = re.compile(rb'["\\]')
_SCALAR_END = re.compile(rb"[,\]} \t\r\n]")


class BrokenDocument(ValueError):
    """The text is no JSON object, or its messages are no array of objects."""


class MessageReader:
    """Reads one document from its pieces; holds at most one value beside the piece at hand."""

    def __init__(self) -> None:
        self.fields: dict[str, bytes] = {}
        self.count = 0
        self._rest = b""
        self._state = "open"
        self._key = ""
        # How far the value at the front has been looked at.
        self._seen, self._depth, self._quoted = 0, 0, False

    def feed(self, piece: bytes) -> Iterator[bytes]:
        """Take the next piece; gives the messages that end in it."""
        self._rest += piece
        at = 0
        while True:
            at = _SPACE.match(self._rest, at).end()
            if at >= len(self._rest):
                break
            if self._state in ("value", "element"):
                if self._state == "element" and self._rest[at : at + 1] == b"]" and not self._seen:
                    if self.count and self._comma:
                        raise BrokenDocument("a comma before the end of the messages")
                    self._state, at = "after", at + 1
                    continue
                if self._state == "value" and self._key == "messages" and self._rest[at : at + 1] == b"[":
                    self._state, self._comma, at = "element", False, at + 1
                    continue
                end = self._value_end(at)
                if end is None:
                    break
                value = self._checked(self._rest[at:end])
                at = end
                if self._state == "element":
                    self._state = "after element"
                    self.count += 1
                    yield value
                else:
                    self.fields[self._key] = value
                    self._state = "after"
                continue
            if self._state == "key":
                end = self._value_end(at) if self._rest[at : at + 1] == b'"' else at
                if end is None:
                    break
                if end == at:
                    if self._rest[at : at + 1] != b"}" or self.fields or self._comma:
                        raise BrokenDocument("no key")
                    self._state, at = "end", at + 1
                    continue
                self._key = json.loads(self._checked(self._rest[at:end], False))
                self._state, at = "colon", end
                continue
            self._punctuation(self._rest[at : at + 1])
            at += 1
        self._rest = self._rest[at:]

    def _punctuation(self, sign: bytes) -> None:
        steps = {
            ("open", b"{"): "key", ("colon", b":"): "value", ("after", b","): "key", ("after", b"}"): "end",
            ("after element", b","): "element", ("after element", b"]"): "after",
        }
        if (self._state, sign) not in steps:
            raise BrokenDocument(f"{sign!r} in state {self._state}")
        self._comma = sign == b","
        self._state = steps[self._state, sign]

    def _value_end(self, start: int) -> int | None:
        """End of the value at ``start``, None if it is not there yet."""
        first = self._rest[start : start + 1]
        if first not in b'"{[':
            found = _SCALAR_END.search(self._rest, start)
            return found.start() if found else None
        at = start + self._seen
        while True:
            found = (_INSIDE if self._quoted else _OUTSIDE).search(self._rest, at)
            if found is None:
                self._seen = len(self._rest) - start
                return None
            sign, at = found.group(), found.end()
            if sign == b"\\":
                if at == len(self._rest):  # the escaped byte is in the next piece
                    self._seen = found.start() - start
                    return None
                at += 1
                continue
            if sign == b'"':
                self._quoted = not self._quoted
            else:
                self._depth += 1 if sign in b"{[" else -1
            if not self._quoted and self._depth <= 0:
                self._seen, self._depth = 0, 0
                return at

    def _checked(self, value: bytes, structured: bool = True) -> bytes:
        try:
            parsed = json.loads(value)
        except ValueError as error:
            raise BrokenDocument(str(error)) from error
        if structured and self._state == "element" and not isinstance(parsed, dict | None):
            raise BrokenDocument("a message that is no object")
        if structured and self._state == "value" and self._key == "messages" and parsed is not None:
            raise BrokenDocument("messages that are no array")
        return value

    def close(self) -> None:
        """The document has to be complete."""
        if self._state != "end" or self._rest.strip(b" \t\r\n"):
            raise BrokenDocument(f"the text ends in state {self._state}")


@dataclass(frozen=True)
class LargeExports:
    """``files`` as ``exports.file_rows`` gives them, without messages; ``messages`` as ``exports.explode_messages`` does."""

    files: DataFrame
    messages: DataFrame


_READ = "file_path string, pos int, message string, guild string, channel string, broken boolean"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to rows: one for each message, then one for the document."""
    types = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_()]
    names = [field.split()[0] for field in _READ.split(", ")]
    rows: list[tuple] = []
    size = 0
    path, reader, used, broken = None, MessageReader(), 0, False

    def batch() -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def finish() -> None:
        fault = broken
        if not fault:
            try:
                reader.close()
            except BrokenDocument:
                fault = True
        parts = [None if fault or name not in reader.fields else reader.fields[name].decode() for name in ("guild", "channel")]
        rows.append((path, None, None, *parts, fault))

    for found in batches:
        for low in range(0, len(found), 256):
            for row in found.slice(low, 256).to_pylist():
                if row["file_path"] != path:
                    if path is not None:
                        finish()
                    path, reader, used, broken = row["file_path"], MessageReader(), 0, False
                if broken:
                    continue
                piece = row["value"]
                if not used:
                    piece = piece.removeprefix(b"\xef\xbb\xbf")
                used += len(row["value"]) + 1
                # Every piece but the last of a file has lost its brace; that one if the file goes on to its length.
                if used <= row["file_size"]:
                    piece += b"}"
                try:
                    for message in reader.feed(piece):
                        rows.append((path, reader.count - 1, message.decode(), None, None, None))
                        size += len(message)
                        if size > BATCH_BYTES:
                            yield batch()
                            rows, size = [], 0
                except BrokenDocument:
                    broken = True
    if path is not None:
        finish()
    yield batch()


def read_large_exports(spark: SparkSession, path: str) -> LargeExports:
    """All ``*.json`` documents below a folder, or one file, of any size; files without a byte are passed over.

    The documents are read once and their rows written down, since whether a document is whole is known
    at its end only.
    """
    reader = spark.read.option("lineSep", "}").option("recursiveFileLookup", True)
    pieces = reader.option("pathGlobFilter", "*.json").text(path).select(
        F.col("value").cast("binary").alias("value"),
        "_metadata.file_path",
        "_metadata.file_size",
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("turn"),
    )
    in_order = pieces.repartition("file_path").sortWithinPartitions("file_path", "block", "turn")
    rows = materialise(in_order.select("file_path", "file_size", "value").mapInArrow(_read, _READ))

    fields = {f.name: f.dataType for f in T.StructType.fromDDL(schemas.EXPORT).fields}
    heads = rows.filter(F.col("pos").isNull()).select(
        decoded_path(F.col("file_path")).alias("file_path"),
        *(F.from_json(name, fields[name]).alias(name) for name in ("guild", "channel")),
        F.when(F.col("broken"), F.lit("")).alias(CORRUPT),
        F.lit(None).cast(fields["messages"]).alias("messages"),
    )
    files = file_rows(heads).drop("messages")
    whole = files.filter(F.col("error").isNull()).drop("error")
    exploded = rows.filter(F.col("pos").isNotNull()).select(
        decoded_path(F.col("file_path")).alias("file_path"), "pos", F.from_json("message", fields["messages"].elementType).alias("message")
    )
    # The messages of a large file are dealt to many tasks.
    messages = salted_join(exploded, whole, "file_path", "pos")
    return LargeExports(
        files, messages.select("file_path", "server_id", "server_name", "channel_id", "channel_name", "channel_type", "pos", "message")
    )
