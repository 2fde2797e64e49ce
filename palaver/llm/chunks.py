"""Substring dedup by content-defined chunking with a gear rolling hash.

A byte ends a chunk where the gear hash of the last 16 bytes is the smallest of ``WIDTH``
neighbouring ones, so cut points depend on nearby bytes only, find their place again after an
insertion, and are at most ``WIDTH`` bytes apart. Chunks are known by a 128-bit digest. A chunk is a repeat if its digest belongs to a smaller doc_id or came before in
the same document. Repeats are removed where neighbouring ones make a passage of ``least``
bytes or more; single short chunks, which plain language repeats by chance, stay.

Two equal passages have equal cut points between the smallest hash of their first whole window
and that of their last one, so at most 2 * WIDTH + REACH - 2 bytes at the edges are in no
whole chunk: a repeated passage of ``always(least)`` bytes or more is always found. The bytes at
its edges stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm.common import NO_ID, SPACES, buffer, mixed, sliding_min, small, texts
from palaver.llm.repeats import first_in_batch

#: Bytes that the gear hash covers.
REACH = 16
#: Hashes of which the smallest ends a chunk: inner chunks have about half as many bytes, and never more.
WIDTH = 48
#: Shortest passage of repeated chunks that is removed, in bytes.
LEAST = 160
#: Bytes that are hashed at a time; memory of a step is about 50 times that.
STEP = 1 << 18
#: Chunks whose digests are made at a time, and rows of a batch that is handed on.
ROWS = 1 << 14
#: Bytes of text that are cut into chunks at a time, and whose chunks are compared before they are sent.
CUT = 1 << 20
SENT = 16 << 20

_GEAR = np.random.default_rng(11).integers(0, 2**32, 256, dtype=np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash after each byte, over the last ``REACH`` bytes: sum of codes shifted by their age."""
    value, reach = _GEAR[data], 1
    while reach < REACH:
        older = np.zeros_like(value)
        older[reach:] = value[:-reach] << np.uint32(reach)
        value = value + older
        reach *= 2
    return value


def always(least: int = LEAST) -> int:
    """Bytes from which a repeated passage is found wherever it stands; 6 of them for cut characters."""
    return least + 2 * WIDTH + REACH - 2 + 6


def cut_points(data: np.ndarray, offsets: np.ndarray | None = None) -> np.ndarray:
    """Places after which ``data`` is cut: behind the smallest of each ``WIDTH`` hashes, the last one of equals.

    Hashes and windows lie inside one of the texts between ``offsets``, by default all of ``data``.
    """
    offsets = np.array([0, len(data)]) if offsets is None else offsets
    first, last = offsets[:-1] + REACH - 1, offsets[1:] - WIDTH + 1
    whole = first < last
    first, last = first[whole], last[whole]
    out = []
    places = np.uint64((1 << 21) - 1)
    for at in range(0, len(data), STEP):
        low = max(0, at - REACH + 1)  # bytes before the step that its hashes still cover
        hashes = mixed(gear(data[low : at + STEP + WIDTH - 1])[at - low :].astype(np.uint64))
        key = (hashes & ~places) | (places - np.arange(len(hashes), dtype=np.uint64))
        least = sliding_min(key, WIDTH)
        least = least[_inside(first, last, at, at + len(least))]
        found = (places - (least & places)).astype(np.int64)
        out.append(found[np.r_[True, found[1:] != found[:-1]]] + at + 1 if len(found) else found)
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.int64)


def _inside(first: np.ndarray, last: np.ndarray, low: int, high: int) -> np.ndarray:
    """Which of the places low..high are in one of the ranges first..last, which are apart and in order."""
    some = slice(np.searchsorted(last, low, "right"), np.searchsorted(first, high, "left"))
    edges = np.zeros(high - low + 1, np.int8)
    edges[np.maximum(first[some], low) - low] = 1
    edges[np.minimum(last[some], high) - low] = -1
    return np.cumsum(edges[:-1], dtype=np.int8) > 0


def text_chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, begin, end) of the chunks of every text. The first chunk has at least ``REACH`` bytes, if the text has."""
    low = int(offsets[0])
    cuts = cut_points(data[low : int(offsets[-1])], offsets - low) + low
    borders = np.union1d(cuts, offsets)
    begin, end = borders[:-1], borders[1:]
    row = np.searchsorted(offsets, begin, "right") - 1
    return row, begin, end


def digests(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """(n, 2) digests of 128 bits."""
    view = memoryview(np.ascontiguousarray(data))
    make = hashlib.blake2b
    out = np.empty((len(begin), 2), np.int64)
    for at in range(0, len(begin), ROWS):
        part = slice(at, at + ROWS)
        joined = b"".join([make(view[b:e], digest_size=16).digest() for b, e in zip(begin[part].tolist(), end[part].tolist(), strict=True)])
        out[part] = np.frombuffer(joined, np.int64).reshape(-1, 2)
    return out


def _chunked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = buffer(batch["text"])
    if offsets[-1] == offsets[0]:
        none = np.zeros(0, np.int64)
        return data, none, none, none, np.zeros((0, 2), np.int64)
    row, begin, end = text_chunks(data, offsets)
    return data, row, begin, end, digests(data, begin, end)


def _digested(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(row, digest) of the chunks of every text; their places are not kept."""
    rows, found, at = [], [], 0
    for part in small(iter([batch]), "text", CUT):
        _, row, _, _, digest = _chunked(part)
        rows.append((row + at).astype(np.int32))
        found.append(digest)
        at += len(part)
    return np.concatenate(rows), np.concatenate(found)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches, "text", SENT):
        owner = batch["id"].to_numpy()
        row, digest = _digested(batch)
        if not len(row):
            continue
        kept, shadowed = first_in_batch([digest[:, 0], digest[:, 1]], owner[row])
        for at in range(0, len(kept), ROWS):
            some = kept[at : at + ROWS]
            yield _rows(owner[row[some]], digest[some, 0], digest[some, 1], None)
        order = shadowed[np.argsort(row[shadowed], kind="stable")]
        if len(order):
            cuts = np.flatnonzero(np.r_[True, row[order][1:] != row[order][:-1]])
            seen = pa.ListArray.from_arrays(pa.array(np.r_[cuts, len(order)].astype(np.int32)), pa.array(digest[order, 0]))
            ids = owner[row[order[cuts]]]
            yield _rows(ids, mixed(ids.view(np.uint64)).view(np.int64), np.zeros(len(ids), np.int64), seen)


def _rows(ids: np.ndarray, high: np.ndarray, low: np.ndarray, seen: pa.ListArray | None) -> pa.RecordBatch:
    lists = pa.nulls(len(ids), pa.list_(pa.int64())) if seen is None else seen
    arrays = [pa.array(ids, pa.int64()), pa.array(np.ascontiguousarray(high)), pa.array(np.ascontiguousarray(low)), lists]
    return pa.RecordBatch.from_arrays(arrays, names=["id", "high", "low", "seen"])


def _kept(batch: pa.RecordBatch, least: int) -> list[tuple[int, int, int, str]]:
    """(bytes, removed bytes, removed passages, kept text) of every row."""
    data, row, begin, end, digest = _chunked(batch)
    _, offsets = buffer(batch["text"])
    again = _again(row, digest[:, 0], batch["seen"])
    cuts = np.searchsorted(row, np.arange(len(batch) + 1))
    out = []
    for r in range(len(batch)):
        low, high = int(cuts[r]), int(cuts[r + 1])
        whole = data[offsets[r] : offsets[r + 1]]
        spans = []
        if again[low:high].any():
            edge = np.diff(np.r_[0, again[low:high].astype(np.int8), 0])
            spans = [
                (int(begin[low + a] - offsets[r]), int(end[low + b - 1] - offsets[r]))
                for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)
            ]
            spans = [s for s in (_whole_characters(whole, s) for s in spans) if s[1] - s[0] >= least]
        at, left = 0, []
        for a, b in spans:
            left.append(whole[at:a].tobytes())
            at = b
        left.append(whole[at:].tobytes())
        out.append((len(whole), sum(b - a for a, b in spans), len(spans), b"".join(left).decode()))
    return out


def _apply(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, "text", CUT):
            size, removed, passages, kept = zip(*_kept(batch, least), strict=True) if len(batch) else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(passages, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_passages", "kept_text"],
            )

    return run


def _replace(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, "text", CUT):
            kept = pa.array([text for *_, text in _kept(batch, least)], pa.string())
            yield pa.RecordBatch.from_arrays([kept, batch["row"]], names=["text", "row"])

    return run


def _whole_characters(whole: np.ndarray, span: tuple[int, int]) -> tuple[int, int]:
    """Shrink a span so that it starts and ends between characters."""
    low, high = span
    while low < high and low < len(whole) and (whole[low] & 0xC0) == 0x80:
        low += 1
    while high > low and high < len(whole) and (whole[high] & 0xC0) == 0x80:
        high -= 1
    return low, high


def _again(row: np.ndarray, digest: np.ndarray, seen: pa.ListArray) -> np.ndarray:
    order = np.lexsort((np.arange(len(row)), digest, row))
    later = np.zeros(len(row), bool)
    if len(order):
        later[order[1:]] = (row[order][1:] == row[order][:-1]) & (digest[order][1:] == digest[order][:-1])
    lengths = seen.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    if lengths.sum():
        values, ends = np.asarray(seen.flatten()), np.cumsum(lengths)
        cuts = np.searchsorted(row, np.arange(len(seen) + 1))
        for r in np.flatnonzero(lengths):
            later[cuts[r] : cuts[r + 1]] |= np.isin(digest[cuts[r] : cuts[r + 1]], values[ends[r] - lengths[r] : ends[r]])
    return later


RESULT = "doc_id long, n_bytes long, n_removed long, n_passages long, kept_text string"


def remove_repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_passages, kept_text.

    The first document (smallest doc_id, null smallest) keeps a passage. Null text is empty and
    stays empty. Rows that share an id do not remove from each other. Texts stay valid UTF-8.
    A chunk's 128-bit digest decides who owns it; inside a document its first half names it. Further
    columns are left out, whatever their names.
    """
    return _told(texts(docs, _own())).mapInArrow(_apply(least), RESULT)


def _own() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("own")


def _told(named: DataFrame) -> DataFrame:
    """Rows with ``own`` and ``text``, joined with the list ``seen`` of chunks that an earlier document has."""
    members = named.select(F.col("own").alias("id"), "text").mapInArrow(_members, "id long, high long, low long, seen array<long>")
    owner = F.min("id").over(Window.partitionBy("high", "low"))
    judged = (
        members.withColumn("owner", owner)
        .filter(F.col("seen").isNotNull() | (F.col("id") > F.col("owner")))
        .select("id", F.coalesce("seen", F.array("high")).alias("seen"))
    )
    seen = judged.groupBy(F.col("id").alias("own")).agg(F.flatten(F.collect_list("seen")).alias("seen"))
    return named.join(seen, "own", "left")


def without_repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """All columns of ``docs`` with the kept text, and n_chars to match; rows left without a word go.

    Null text counts as empty, a null id as the smallest; rows that share an id do not remove from each
    other. An empty table stays empty. Columns may have any names.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_chars")]
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    # The caller's other columns travel as one value, so that no name of ours meets one of theirs.
    told = _told(docs.select(_own(), text, F.struct(*others).alias("row")))
    kept = told.mapInArrow(_replace(least), told.select("text", "row").schema)
    kept = kept.filter(F.btrim("text", F.lit(SPACES)) != "")

    def column(name: str) -> Column:
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            return F.length("text").cast(docs.schema["n_chars"].dataType).alias(name)
        return F.col("row").getField(name).alias(name)

    return kept.select(*map(column, docs.columns))
