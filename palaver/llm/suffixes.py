"""Suffix-array dedup of repeated byte strings by a depth-limited radix sort.

A byte goes if a string of ``width`` bytes over it also starts earlier (smaller doc_id, or earlier in
the same document). Suffixes are ordered through ``width`` bytes only, in most-significant-digit
passes; a group that a pass leaves with one member is done, and groups that stay equal through the
last digit are exactly the repeated windows. Three choices make the passes affordable:

* Neighbouring window starts share their first digit. Among the hashes of the 32-byte strings in a
  window, the smallest (of equal ones the last) is its anchor; windows with equal bytes have equal anchors at the same
  offset. Starts with one anchor are a run, about 35 starts, and are sorted as one suffix.
* Pass 1 takes the anchor as digit. Pass 2 takes all bytes that the run's windows cover: where these
  repeat, so does every window of the run, and no text has to move.
* Pass 3 orders single windows, only in runs that repeat an anchor but not all their bytes: the
  borders of repeated passages. Only the bytes of those runs are moved.

A key that very many documents share arrives once for each batch of texts; a group too large for one task of
pass 3 is dealt out by the window's own hash, in the same exchange, so the texts move once for both. Hashes have 64 bits and are compared together with the
64-bit anchor, so two different windows pass as equal with a chance of 2**-64 within an anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm.common import NO_ID, Rolling, buffer, mixed, pieces, sliding_min, small, texts, written
from palaver.llm.repeats import first_in_batch
from palaver.llm.simhash import whole_groups

WIDTH = 100
ANCHOR = 32
#: Bytes of text that one numpy step takes; a step needs about a hundred bytes for each.
STEP = 1 << 18
#: Bytes of text whose runs a task holds at a time.
HELD = 16 << 20
#: Runs of one anchor that pass 3 orders in one task; larger groups are dealt out by window.
GROUP = 4096
#: What a row of pass 3 is: a run with its bytes, a single window of a large group, or a span known to repeat.
RUN, SINGLE, KNOWN = 0, 1, 2
BORDER = "kind int, digit long, id long, text_key long, start long, count int, bytes binary"

_ROLL = Rolling(seed=7)
#: Bits for a place in a numpy step: it has at most two times STEP bytes and the overlap.
_PLACES = np.uint64((1 << 22) - 1)


def runs(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, begin, count, anchor, all) arrays: runs of window starts, as places in ``data``.

    ``anchor`` is the hash of the run's first digit, ``all`` that of every byte its windows cover.
    Every window of a row is in one run.
    """
    for row, begin, end in pieces(offsets, STEP, width - 1):
        long = end - begin >= width
        row, begin, end = row[long], begin[long], end[long]
        if not len(row):
            continue
        low = int(begin.min())
        part = data[low : int(end.max())]
        sums = _ROLL.sums(part)
        grams = _ROLL.grams(sums, ANCHOR)
        # Smallest hash by its upper bits, of equal ones the last: place counts down in the lower bits.
        ranked = (grams & ~_PLACES) | (_PLACES - np.arange(len(grams), dtype=np.uint64))
        chosen = _PLACES - (sliding_min(ranked, width - ANCHOR + 1) & _PLACES)
        count = end - begin - width + 1
        which = np.repeat(np.arange(len(row)), count)
        starts = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin - low, count)
        place = chosen[starts]
        new = np.r_[True, (place[1:] != place[:-1]) | (which[1:] != which[:-1])]
        first = np.flatnonzero(new)
        size = np.diff(np.r_[first, len(starts)])
        at = starts[first]
        every = _ROLL.between(sums, at, at + size + width - 1) + size.astype(np.uint64)
        yield row[which[first]], at + low, size, grams[place[first].astype(np.int64)], every


def _members(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, "text", HELD):
            data, offsets = buffer(batch["text"])
            owner = batch["id"].to_numpy()
            held: list[tuple[np.ndarray, ...]] = [(row, anchor, every) for row, _, _, anchor, every in runs(data, offsets, width)]
            if not held:
                continue
            row, anchor, every = (np.concatenate(x) for x in zip(*held, strict=True))
            kept, shadowed = first_in_batch([anchor, every], owner[row])
            yield _member_rows(owner[row[kept]], anchor[kept], every[kept], None)
            # Runs that an earlier document of the batch has: only their document must hear of it.
            order = shadowed[np.argsort(row[shadowed], kind="stable")]
            cuts = np.flatnonzero(np.r_[True, row[order][1:] != row[order][:-1]]) if len(order) else np.zeros(0, int)
            if len(order):
                ends = np.r_[cuts, len(order)].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(every[order].view(np.int64)))
                ids = owner[row[order[cuts]]]
                yield _member_rows(ids, mixed(ids.view(np.uint64)), np.zeros(len(ids), np.uint64), lists)

    return run


def _member_rows(ids: np.ndarray, anchor: np.ndarray, every: np.ndarray, seen: pa.ListArray | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(anchor.view(np.int64)),
            pa.array(every.view(np.int64)),
            pa.nulls(len(ids), pa.list_(pa.int64())) if seen is None else seen,
        ],
        names=["id", "anchor", "every", "seen"],
    )


def _border_rows(width: int):
    """Pass 3 input: bytes of the runs named for each text; of large groups, single windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, "text", HELD):
            data, offsets = buffer(batch["text"])
            owner, text_key = batch["id"].to_numpy(), batch["text_key"].to_numpy()
            out: list[tuple] = []
            large: list[tuple[np.ndarray, ...]] = []
            for row, begin, size, anchor, every in runs(data, offsets, width):
                for item in _named(row, every, batch["asked"]):
                    at, n = int(begin[item]), int(size[item])
                    out.append((anchor[item], row[item], at, n, data[at : at + n + width - 1].tobytes()))
                if items := _named(row, every, batch["asked_large"]):
                    large.append((row[items], begin[items], size[items], anchor[items]))
            if out:
                anchor, row, at, n, text = zip(*out, strict=True)
                row = np.array(row)
                yield _border_batch(RUN, np.array(anchor, np.uint64), owner[row], text_key[row], np.array(at) - offsets[row], np.array(n), pa.array(text, pa.binary()))
            if large:
                row, begin, size, anchor = (np.concatenate(x) for x in zip(*large, strict=True))
                yield from _single_rows(data, begin, size, anchor, owner[row], text_key[row], begin - offsets[row], width)

    return run


def _border_batch(
    kind: int, digit: np.ndarray, owner: np.ndarray, text_key: np.ndarray, start: np.ndarray, count: np.ndarray, text: pa.Array | None = None
) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(digit), kind, np.int32)),
            pa.array(digit.view(np.int64)),
            pa.array(owner),
            pa.array(text_key),
            pa.array(start, pa.int64()),
            pa.array(count, pa.int32()),
            pa.nulls(len(digit), pa.binary()) if text is None else text,
        ],
        names=["kind", "digit", "id", "text_key", "start", "count", "bytes"],
    )


def _single_rows(
    data: np.ndarray, begin: np.ndarray, size: np.ndarray, anchor: np.ndarray, owner: np.ndarray, text_key: np.ndarray, start: np.ndarray, width: int
) -> Iterator[pa.RecordBatch]:
    """The windows of runs, a bounded number at a time. Those that a smaller id has among them are
    known to repeat and leave as spans, so a window that very many documents share arrives once for each time."""
    ends = np.cumsum(size + width - 1)
    cuts = np.searchsorted(ends, np.arange(0, int(ends[-1]), HELD // 8))
    for low, high in zip(cuts, np.r_[cuts[1:], len(ends)], strict=True):
        if low == high:
            continue
        part = np.concatenate([data[at : at + n] for at, n in zip(begin[low:high], size[low:high] + width - 1, strict=True)])
        places = np.r_[0, ends[low:high] - (ends[low - 1] if low else 0)]
        item, step, key = window_keys(anchor[low:high], places, part, size[low:high], width)
        who, text, at = owner[low:high][item], text_key[low:high][item], start[low:high][item] + step
        order = np.lexsort((who, key))
        new = np.r_[True, key[order][1:] != key[order][:-1]]
        known = np.zeros(len(key), bool)
        known[order] = who[order] > who[order][new][np.cumsum(new) - 1]
        yield _border_batch(SINGLE, key[~known], who[~known], text[~known], at[~known], np.ones(int((~known).sum()), np.int32))
        if known.any():
            ids, keys, first, last = (x.to_numpy() for x in span_rows(who[known], text[known], at[known]).columns)
            yield _border_batch(KNOWN, mixed(ids.view(np.uint64)), ids, keys, first, last - first + 1)


def _named(row: np.ndarray, every: np.ndarray, asked: pa.ListArray) -> list[int]:
    """Places of the runs whose hash is in their row's list; of a repeated run only the first."""
    values, at = np.asarray(asked.flatten()), np.diff(np.r_[0, np.cumsum(asked.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
    ends = np.cumsum(at)
    out: list[int] = []
    cuts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    for low, high in zip(cuts, np.r_[cuts[1:], len(row)], strict=True):
        r = int(row[low])
        want = values[ends[r] - at[r] : ends[r]].view(np.uint64)
        if len(want):
            found = np.flatnonzero(np.isin(every[low:high], want))
            _, first = np.unique(every[low:high][found], return_index=True)
            out += (found[np.sort(first)] + low).tolist()
    return out


def window_keys(anchor: np.ndarray, offsets: np.ndarray, data: np.ndarray, count: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, step, key) of every window of the runs; ``data`` holds their bytes side by side."""
    sums = _ROLL.sums(data)
    run = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    at = offsets[:-1][run] + step
    return run, step, mixed(_ROLL.between(sums, at, at + width) ^ anchor[run])


def _borders(width: int):
    """Pass 3: order the windows of each anchor; all but the first of equal windows are repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in whole_groups(batches, ["digit"], 8192):
            kinds = whole["kind"].to_numpy()
            for kind in np.unique(kinds).tolist():
                table = whole.filter(pa.array(kinds == kind)).combine_chunks()
                digit, owner, text_key, start = (table[c].to_numpy() for c in ("digit", "id", "text_key", "start"))
                count = table["count"].to_numpy().astype(np.int64)
                if kind == RUN:
                    data, offsets = buffer(table["bytes"].chunk(0))
                    base = int(offsets[0])
                    item, step, key = window_keys(digit.view(np.uint64), offsets - base, data[base : int(offsets[-1])], count, width)
                    yield _spans(key, owner[item], text_key[item], start[item] + step)
                elif kind == SINGLE:
                    yield _later_singles(digit, owner, text_key, start)
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (owner, text_key, start, start + count - 1)], names=["id", "text_key", "low", "high"])

    return run


def _later_singles(key: np.ndarray, owner: np.ndarray, text_key: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Windows behind the first of their key, by a larger id or later in the same text."""
    order = np.lexsort((start, text_key, owner, key))
    key, owner, text_key, start = key[order], owner[order], text_key[order], start[order]
    new = np.r_[True, key[1:] != key[:-1]]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    again = (owner > owner[first]) | ((owner == owner[first]) & (text_key == text_key[first]) & (start > start[first]))
    return span_rows(owner[again], text_key[again], start[again])


def _spans(key: np.ndarray, owner: np.ndarray, text_key: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Starts of windows that are repeats, neighbouring ones as one span. Rows that share an id but
    not their text do not repeat each other."""
    order = np.lexsort((start, text_key, owner, key))
    key, owner, text_key, start = key[order], owner[order], text_key[order], start[order]
    new = np.r_[True, key[1:] != key[:-1]]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    newly = np.r_[True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]) | (text_key[1:] != text_key[:-1])]
    again = (owner > owner[first]) | ~newly
    return span_rows(owner[again], text_key[again], start[again])


def span_rows(owner: np.ndarray, text_key: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((start, text_key, owner))
    owner, text_key, start = owner[order], text_key[order], start[order]
    cut = np.r_[True, (owner[1:] != owner[:-1]) | (text_key[1:] != text_key[:-1]) | (start[1:] > start[:-1] + 1)][: len(start)]
    at = np.flatnonzero(cut)
    last = np.r_[at[1:], len(start)] - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(owner[at], pa.int64()), pa.array(text_key[at], pa.int64()), pa.array(start[at], pa.int64()), pa.array(start[last[: len(at)]], pa.int64())],
        names=["id", "text_key", "low", "high"],
    )


def _apply(width: int, with_text: bool):
    """Remove the repeated windows from each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, "text", HELD):
            data, offsets = buffer(batch["text"])
            covers: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
            for row, begin, size, _, every in runs(data, offsets, width):
                again = _again(row, every, batch["seen"])
                for r, b, n in zip(row[again].tolist(), begin[again].tolist(), size[again].tolist(), strict=True):
                    covers.setdefault(r, []).append((b, b + n + width - 1))
            for r, (key, spans) in enumerate(zip(batch["text_key"].to_pylist(), batch["spans"].to_pylist(), strict=True)):
                for span in (span for span in spans or () if span["text_key"] == key):
                    covers.setdefault(r, []).append((int(offsets[r]) + span["low"], int(offsets[r]) + span["high"] + width))
            out = []
            for r in range(len(batch)):
                low, high = int(offsets[r]), int(offsets[r + 1])
                whole = data[low:high]
                kept, removed, spans = whole.tobytes(), 0, 0
                if r in covers:
                    edge = np.zeros(high - low + 1, np.int32)
                    ends = np.array(covers[r]) - low
                    np.add.at(edge, ends[:, 0], 1)
                    np.add.at(edge, ends[:, 1], -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    removed, spans = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = whole[~gone].tobytes()
                out.append((high - low, removed, spans, kept))
            size, removed, spans, kept = zip(*out, strict=True) if out else ((), (), (), ())
            arrays = [batch["doc_id"], pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())]
            arrays.append(pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()))
            if with_text:
                arrays.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text)

    return run


def _again(row: np.ndarray, every: np.ndarray, seen: pa.ListArray) -> np.ndarray:
    """Runs that an earlier document has, or that came before in their own row."""
    order = np.lexsort((np.arange(len(row)), every, row))
    later = np.zeros(len(row), bool)
    later[order[1:]] = (row[order][1:] == row[order][:-1]) & (every[order][1:] == every[order][:-1])
    lengths = seen.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    if lengths.sum():
        values, ends = np.asarray(seen.flatten()).view(np.uint64), np.cumsum(lengths)
        cuts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        for low, high in zip(cuts, np.r_[cuts[1:], len(row)], strict=True):
            r = int(row[low])
            if lengths[r]:
                later[low:high] |= np.isin(every[low:high], values[ends[r] - lengths[r] : ends[r]])
    return later


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, width: int = WIDTH, group: int = GROUP, with_text: bool = False) -> DataFrame:
    """One row per document with what is left of it once repeated strings of ``width`` bytes are gone.

    Null text is empty; texts under ``width`` bytes stay whole. A null id counts as the
    smallest. Rows that share an id (null included) are judged against smaller ids and against themselves,
    not against each other. ``with_text`` adds the kept bytes. ``width`` is at least 33.
    """
    own = F.coalesce(F.col("doc_id"), F.lit(NO_ID))
    named = texts(docs).select("doc_id", own.alias("id"), F.xxhash64("text").alias("text_key"), "text")
    members = named.select("id", "text").mapInArrow(_members(width), "id long, anchor long, every long, seen array<long>")

    # Passes 1 and 2, in one exchange by the first digit.
    grouped = members.repartition("anchor")
    by_anchor = Window.partitionBy("anchor")
    by_run = Window.partitionBy("anchor", "every").orderBy("id")
    judged = (
        grouped.withColumn("owner", F.first("id").over(by_run))
        .withColumn("turn", F.row_number().over(by_run))
        .withColumn("heads", F.sum(F.when(F.col("turn") == 1, 1).otherwise(0)).over(by_anchor))
        .filter(F.col("seen").isNotNull() | (F.col("id") > F.col("owner")) | ((F.col("turn") == 1) & (F.col("heads") > 1)))
        .select(
            "id",
            F.when(F.col("seen").isNotNull(), F.col("seen")).when(F.col("id") > F.col("owner"), F.array("every")).alias("seen"),
            F.when(F.col("seen").isNull() & (F.col("id") <= F.col("owner")) & (F.col("heads") <= group), F.col("every")).alias("asked"),
            F.when(F.col("seen").isNull() & (F.col("id") <= F.col("owner")) & (F.col("heads") > group), F.col("every")).alias("asked_large"),
        )
    )
    found = written(judged)

    # Pass 3 on the borders, of small and large groups in one exchange.
    asked = found.filter(F.col("asked").isNotNull() | F.col("asked_large").isNotNull())
    lists = asked.groupBy("id").agg(F.collect_list("asked").alias("asked"), F.collect_list("asked_large").alias("asked_large"))
    # All columns of the texts, used or not: so one exchange of the texts serves this join and the last one.
    borders = named.join(lists, "id").mapInArrow(_border_rows(width), BORDER)
    spans = borders.repartition("digit").sortWithinPartitions("digit").mapInArrow(_borders(width), "id long, text_key long, low long, high long")

    seen = found.filter(F.col("seen").isNotNull()).groupBy("id").agg(F.flatten(F.collect_list("seen")).alias("seen"))
    spans = spans.groupBy("id").agg(F.collect_list(F.struct("text_key", "low", "high")).alias("spans"))
    told = named.join(seen.join(spans, "id", "full"), "id", "left")
    return told.mapInArrow(_apply(width, with_text), RESULT + ", kept binary" * with_text)
