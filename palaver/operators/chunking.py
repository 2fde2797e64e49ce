"""Packing ordered messages into token-budget chunks.

The packing is a sequential fold: a message joins the current chunk unless that would exceed
the budget, then it starts the next chunk. A running sum cut into equal buckets gives other
chunks, so the fold has to be kept, but it does not have to run in one task per channel:

1. The rows (keys, order and token count, no text) are range-partitioned into sorted blocks.
2. A block cannot know how full the chunk is that reaches it from the block before. It reports
   how its own outcome depends on that fill: a step function with at most ``budget + 1`` steps,
   since the fill only decides where the first new chunk begins. Only the first and last key of
   a block can continue elsewhere, so there are at most two reports per block.
3. The reports of one key, taken in block order, give the fill that enters each block.
4. Every block packs its rows with that fill, all blocks at the same time.

Chunk texts need the lines in that order. Large keys are cut into parts that begin with a chunk; a task holds lines
until they take some 32 MB, compresses those of one part together and sends them on, so that what is shuffled is less
than half of the text. A part is unpacked, sorted and joined by one worker.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from palaver.functions.text import DEFAULT_MAX_TOKENS, estimate_tokens, format_line, line_lead, token_counts
from palaver.operators.ordering import freeze_sorted, materialise, passing

_REPORT_FIELDS = "_total long, _reach array<long>, _fill array<long>, _new array<long>"
_ENTRY_FIELDS = "_fill long, _chunk long"
# Texts of so many tokens or bytes, in whole chunks, are sorted and joined together; a key with more is cut into parts.
PART_TOKENS = 8_000_000
PART_BYTES = 1 << 25
# What a message takes beside its text: its line's lead, its place and its numbers.
ROW_BYTES = 64
# A task compresses lines as soon as it holds so many bytes of them.
HELD_BYTES = 1 << 25
ZSTD_LEVEL = 2
# A worker hands on so many bytes of chunk text at a time; a chunk with more leaves in pieces.
PIECE_BYTES = 1 << 24


# --- packing one run of rows that share a key ----------------------------------------------


def _next_start(sums: np.ndarray, start: np.ndarray, budget: int) -> np.ndarray:
    """First row after ``start`` that no longer fits the chunk beginning at ``start``."""
    overflow = np.searchsorted(sums, sums[start] + budget, side="right") - 1
    return np.maximum(start + 1, overflow)


def _first_start(sums: np.ndarray, fill: int, budget: int) -> int:
    """First row that does not fit a chunk already holding ``fill`` tokens."""
    return int(np.searchsorted(sums[1:], budget - fill, side="right"))


def _follow(sums: np.ndarray, starts: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """For chunks beginning at ``starts``: fill at the end of the run, and chunks begun after."""
    last, rows = starts.copy(), len(sums) - 1
    begun = np.zeros(len(starts), dtype=np.int64)
    active = np.flatnonzero(last < rows)
    while active.size:
        following = _next_start(sums, last[active], budget)
        inside = following < rows
        active = active[inside]
        last[active] = following[inside]
        begun[active] += 1
    return sums[-1] - sums[last], begun


def _report(tokens: np.ndarray, budget: int, fresh: bool) -> tuple[int, list, list, list]:
    """Outcome of a run: ``reach[i]`` is the token sum at which the i-th possible first new
    chunk begins, ``fill``/``new`` what then leaves the run. A fresh run has one outcome."""
    sums = np.concatenate(([0], np.cumsum(tokens)))
    if fresh:
        fill, begun = _follow(sums, np.array([0]), budget)
        return int(sums[-1]), [], fill.tolist(), begun.tolist()
    possible = (sums[:-1] <= budget) & (tokens > 0)
    possible[0] = True
    starts = np.flatnonzero(possible)
    fill, begun = _follow(sums, starts, budget)
    reach, new = sums[starts + 1], begun + 1
    # Neighbouring starts that end alike are one step.
    keep = np.append((fill[1:] != fill[:-1]) | (new[1:] != new[:-1]), True)
    return int(sums[-1]), reach[keep].tolist(), fill[keep].tolist(), new[keep].tolist()


def _apply_report(fill: int, report: tuple[int, list, list, list], budget: int) -> tuple[int, int]:
    """Fill and begun chunks after a run that was entered with ``fill`` tokens."""
    total, reach, fills, new = report
    step = int(np.searchsorted(reach, budget - fill, side="right"))
    return (fill + total, 0) if step == len(reach) else (fills[step], new[step])


def _pack(tokens: np.ndarray, entry: tuple[int, int] | None, budget: int):
    """Chunk number of every row and the ``(fill, chunk)`` that leaves the run."""
    sums = np.concatenate(([0], np.cumsum(tokens)))
    rows = len(tokens)
    begins = np.zeros(rows, dtype=np.int64)
    chunk, start = 0, 0
    if entry is not None:
        fill, chunk = entry
        start = _first_start(sums, fill, budget)
        if start == rows:
            return np.full(rows, chunk), (fill + int(sums[-1]), chunk)
        begins[start] = 1
    while (following := int(_next_start(sums, start, budget))) < rows:
        begins[following] = 1
        start = following
    numbers = chunk + np.cumsum(begins)
    return numbers, (int(sums[-1] - sums[start]), int(numbers[-1]))


# --- runs inside Arrow batches -------------------------------------------------------------


def _runs(batch: pa.RecordBatch, keys: Sequence[str]) -> list[tuple[int, int]]:
    """Row ranges of equal keys; the rows are sorted by key."""
    changed = np.zeros(batch.num_rows, dtype=bool)
    changed[0] = True
    for key in keys:
        column = batch.column(key)
        left, right = column.slice(0, len(column) - 1), column.slice(1)
        differ = pc.fill_null(pc.not_equal(left, right), False)
        null_edge = pc.not_equal(left.is_null(), right.is_null())
        changed[1:] |= pc.or_(differ, null_edge).to_numpy(zero_copy_only=False)
    edges = np.append(np.flatnonzero(changed), batch.num_rows)
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


def _key_at(batch: pa.RecordBatch, keys: Sequence[str], row: int) -> tuple:
    return tuple(batch.column(key)[row].as_py() for key in keys)


def _reporter(keys: list[str], schema: pa.Schema, budget: int):
    """Reports of the first and the last key of a block. Inner keys begin and end inside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, first, current, parts, rows = None, None, None, [], []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            block = batch.column("_block")[0].as_py()
            tokens = batch.column("tokens").to_numpy(zero_copy_only=False)
            for begin, end in _runs(batch, keys):
                key = _key_at(batch, keys, begin)
                if current is None:
                    first = key
                elif key != current:
                    if current == first:
                        outcome = _report(np.concatenate(parts), budget, fresh=False)
                        rows.append((*current, block, True, *outcome))
                    parts = []
                current = key
                parts.append(tokens[begin:end])
        if current is None:
            return
        run_tokens = np.concatenate(parts)
        if current == first:
            rows.append((*current, block, True, *_report(run_tokens, budget, fresh=False)))
        # The last key may begin here: its outcome as a fresh run goes along.
        rows.append((*current, block, False, *_report(run_tokens, budget, fresh=True)))
        columns = [pa.array(values, type=f.type) for values, f in zip(zip(*rows), schema)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _chainer(keys: list[str], schema: pa.Schema, budget: int):
    """Entry state of every block that continues a key, from the reports in block order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                here = tuple(row[k] for k in keys)
                report = (row["_total"], row["_reach"], row["_fill"], row["_new"])
                if here != key:
                    key, state = here, None
                if row["_continues"] and state is not None:
                    out.append((*here, row["_block"], *state))
                    fill, new = _apply_report(state[0], report, budget)
                    state = (fill, state[1] + new)
                elif not row["_continues"] and state is None:
                    state = (report[2][0], report[3][0])
            if out:
                columns = [pa.array(values, type=f.type) for values, f in zip(zip(*out), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _packer(keys: list[str], schema: pa.Schema, budget: int):
    """Chunk numbers of a block, batch after batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            tokens = batch.column("tokens").to_numpy(zero_copy_only=False)
            numbers = np.empty(batch.num_rows, dtype=np.int64)
            for begin, end in _runs(batch, keys):
                here = _key_at(batch, keys, begin)
                if key is None or here != key:
                    fill = batch.column("_fill")[begin].as_py() if "_fill" in batch.schema.names else None
                    entered = fill is not None
                    state = (fill, batch.column("_chunk")[begin].as_py()) if entered else None
                    key = here
                numbers[begin:end], state = _pack(tokens[begin:end], state, budget)
            kept = [batch.column(f.name) for f in schema if f.name != "chunk_no"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(numbers)], schema=schema)

    return run


def _counter(schema: pa.Schema):
    """Tokens and size of every message, in place of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content = batch.column("content")
            size = pc.fill_null(pc.binary_length(content), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            kept = [batch.column(name) for name in schema.names[:-2]]
            counted = [pa.array(token_counts(content)), pa.array(size + ROW_BYTES)]
            yield pa.RecordBatch.from_arrays([*kept, *counted], schema=schema)

    return run


# --- lines on their way to the worker that joins them ----------------------------------------


def _shipper(keys: list[str], schema: pa.Schema):
    """One row for the lines of a part that a task holds together: their places, tokens and sizes, and their bytes compressed."""
    part = [*keys, "_part"]

    def shipped(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=ZSTD_LEVEL)
        table = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        table = table.take(pc.sort_indices(table, sort_keys=[(name, "ascending") for name in part]))
        for batch in table.to_batches():
            line = batch.column("line")
            filled = batch.column("_filled").to_numpy(zero_copy_only=False)
            lead = batch.column("_lead").to_numpy(zero_copy_only=False)
            size = pc.binary_length(line)
            ends = np.concatenate(([0], np.cumsum(pc.fill_null(size, 0).to_numpy(zero_copy_only=False), dtype=np.int64)))
            _, offsets, data = line.buffers()
            start = int(np.frombuffer(offsets, np.int64 if pa.types.is_large_string(line.type) else np.int32)[line.offset])
            runs = _runs(batch, part)
            edges = np.array([*(begin for begin, _ in runs), batch.num_rows], np.int32)
            raw = np.diff(ends[edges])
            packed = [
                codec.compress(data.slice(start + int(ends[begin]), int(ends[end] - ends[begin])), asbytes=True) if ends[end] > ends[begin] else b""
                for begin, end in runs
            ]
            values = {
                "created_at": batch.column("created_at"), "message_id": batch.column("message_id"),
                "tokens": pa.array(token_counts(line, lead, filled)), "size": size.cast(pa.int32()),
            }
            lists = [pa.ListArray.from_arrays(pa.array(edges), v.cast(schema.field(n).type.value_type), type=schema.field(n).type) for n, v in values.items()]
            first = batch.select(part).take(pa.array(edges[:-1]))
            columns = [*first.columns, *lists, pa.array(raw, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= HELD_BYTES:
                yield from shipped(held)
                size = 0
        if held:
            yield from shipped(held)

    return run


def _sorted_places(created: pa.Array, number: pa.Array, tokens: np.ndarray, newest_first: bool) -> np.ndarray:
    """The order of ``_order`` and tokens."""

    def ranked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        values = pc.fill_null(column.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
        return column.is_null().to_numpy(zero_copy_only=False), ~values if newest_first else values

    (open_, time), (nameless, number) = ranked(created), ranked(number)
    # Last key first. Times: unknown ones are the newest; ids: unknown ones are the smallest.
    return np.lexsort((tokens, number, nameless == newest_first, time, open_ != newest_first))


def _liner(keys: list[str], schema: pa.Schema, budget: int, newest_first: bool):
    """Chunk texts of parts, which begin with a chunk; the rows of a part follow each other.

    A text of more than ``PIECE_BYTES`` leaves in pieces, which are marked and say where they stand.
    """
    part = [*keys, "_part"]

    def joined(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flat(name: str) -> pa.Array:
            return pa.concat_arrays([batch.column(name).flatten() for batch in rows])

        codec = pa.Codec("zstd")
        texts = [
            codec.decompress(packed.as_buffer(), raw.as_py())
            for batch in rows
            for packed, raw in zip(batch.column("_lines"), batch.column("_raw"))
            if raw.as_py()
        ]
        data = pa.py_buffer(b"".join(texts))
        del texts
        size, tokens = flat("size"), flat("tokens").to_numpy(zero_copy_only=False)
        filled = size.is_valid().to_numpy(zero_copy_only=False)
        size = pc.fill_null(size, 0).to_numpy(zero_copy_only=False)
        offsets = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
        lines = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), data)
        order = _sorted_places(flat("created_at"), flat("message_id"), tokens, newest_first)
        numbers, _ = _pack(tokens[order], None, budget)
        first, before = rows[0].slice(0, 1), rows[0].column("_part")[0].as_py()
        # Lines in order, without blank messages; a chunk of these alone has no text, which is given as ''.
        ends = np.append(np.flatnonzero(np.diff(numbers)) + 1, len(numbers))
        kept = np.concatenate(([0], np.cumsum(filled[order])))[ends]
        order = order[filled[order]]
        total = np.concatenate(([0], np.cumsum(size[order] + 1, dtype=np.int64)))
        pieces: list[tuple[int, int, bool, int, int]] = []  # chunk, piece, whole, first and last line
        for chunk, (begin, end) in enumerate(zip(np.append(0, kept[:-1]).tolist(), kept.tolist())):
            whole, piece = total[end] - total[begin] <= PIECE_BYTES, 0
            while piece == 0 or begin < end:
                last = end if whole else min(end, max(begin + 1, int(np.searchsorted(total, total[begin] + PIECE_BYTES, "right")) - 1))
                pieces.append((chunk, piece, whole, begin, last))
                begin, piece = last, piece + 1
        low = 0
        while low < len(pieces):
            begin, high = pieces[low][3], low + 1
            while high < len(pieces) and total[pieces[high][4]] - total[begin] <= PIECE_BYTES:
                high += 1
            chunk, piece, whole, begins, lasts = (list(c) for c in zip(*pieces[low:high]))
            some = lines.take(pa.array(order[begin : lasts[-1]])).cast(pa.string())
            lists = pa.ListArray.from_arrays(pa.array([b - begin for b in [*begins, lasts[-1]]], pa.int32()), some)
            same = first.take(pa.array(np.zeros(high - low, np.int64)))
            columns = [*[same.column(k) for k in keys], pa.array(chunk, pa.int64()), pa.array(piece, pa.int32()), pa.array(whole, pa.bool_())]
            columns[len(keys)] = pc.add(columns[len(keys)], before)
            yield pa.RecordBatch.from_arrays([*columns, pc.binary_join(lists, "\n")], schema=schema)
            low = high

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            for begin, end in _runs(batch, part):
                here = _key_at(batch, part, begin)
                if held and here != key:
                    yield from joined(held)
                    held = []
                key = here
                held.append(batch.slice(begin, end - begin))
        if held:
            yield from joined(held)

    return run


# --- operators -----------------------------------------------------------------------------

OLDEST_FIRST = "created_at ASC NULLS LAST, message_id ASC"
NEWEST_FIRST = "created_at DESC NULLS FIRST, message_id DESC"


def _order(newest_first: bool) -> list[Column]:
    if newest_first:
        return [F.desc_nulls_first("created_at"), F.desc("message_id")]
    return [F.asc_nulls_last("created_at"), F.asc("message_id")]


def _schema(fields: list[T.StructField], more: str) -> T.StructType:
    return T.StructType([*fields, *T.StructType.fromDDL(more).fields])


def chunk_messages(
    messages: DataFrame,
    keys: Sequence[str],
    max_tokens: int = DEFAULT_MAX_TOKENS,
    newest_first: bool = False,
) -> DataFrame:
    """``message_id``, ``created_at``, ``tokens`` and ``chunk_no`` (from 0) per key.

    Messages stay whole; one above the budget stands alone. A worker sees a text once, to count its words.
    """
    return _chunked(messages, list(keys), max_tokens, newest_first).drop("_bytes")


def _chunked(messages: DataFrame, keys: list[str], max_tokens: int, newest_first: bool) -> DataFrame:
    """``chunk_messages`` with the size of every message."""
    texts = messages.select(*keys, "created_at", F.col("message_id").cast("long").alias("message_id"), "content")
    fields = [*[texts.schema[k] for k in keys], texts.schema["created_at"]]
    counted = _schema(fields, "message_id long, tokens long, _bytes long")
    narrow = texts.mapInArrow(_counter(to_arrow_schema(counted)), counted)
    # Rows of one place are packed by size, so that every reading packs them alike.
    frozen = freeze_sorted(narrow, [*keys, *_order(newest_first), "tokens"])
    packed_schema = _schema(fields, "message_id long, tokens long, _bytes long, chunk_no long")
    return _entered(frozen, keys, max_tokens).mapInArrow(
        _packer(keys, to_arrow_schema(packed_schema), max_tokens), packed_schema
    )


def _place() -> Column:
    """What ``_order`` sorts by, as one value to compare."""
    return F.struct(F.col("created_at").isNull().alias("open"), "created_at", "message_id")


def _cuts(chunked: DataFrame, keys: list[str], part_chunks: int, newest_first: bool) -> DataFrame:
    """Where each part of a large key begins: one row per key that has any, one entry per ``part_chunks`` chunks
    or ``PART_BYTES`` of them. A part is named by its first chunk.

    A cut between rows of one place is left out: the part before it goes on.
    """
    ends = (F.max, F.min) if newest_first else (F.min, F.max)
    group = F.floor(F.col("chunk_no") / part_chunks).alias("_group")
    earlier = Window.partitionBy(*keys, "_group").orderBy("chunk_no").rowsBetween(Window.unboundedPreceding, -1)
    by_part = Window.partitionBy(*keys).orderBy("_part")
    return (
        chunked.withColumn("_place", _place())
        .groupBy(*keys, group, "chunk_no")
        .agg(ends[0]("_place").alias("_first"), ends[1]("_place").alias("_last"), F.sum("_bytes").alias("_bytes"))
        .withColumn("_share", F.floor(F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)) / PART_BYTES))
        .groupBy(*keys, "_group", "_share")
        .agg(F.min("chunk_no").alias("_part"), ends[0]("_first").alias("_first"), ends[1]("_last").alias("_last"))
        .withColumn("_before", F.lag("_last").over(by_part))
        .filter((F.col("_part") > 0) & (F.col("_before") != F.col("_first")))
        .groupBy(*keys)
        .agg(F.collect_list(F.struct("_part", "_first")).alias("_cuts"))
    )


def _entered(frozen: DataFrame, keys: list[str], max_tokens: int) -> DataFrame:
    """The sorted blocks with the state that enters them: chunk fill and number, NULL for none."""
    key_fields = [frozen.schema[k] for k in keys]
    reports_schema = _schema(key_fields, f"_block int, _continues boolean, {_REPORT_FIELDS}")
    entries_schema = _schema(key_fields, f"_block int, {_ENTRY_FIELDS}")
    reports = frozen.select(*keys, "_block", "tokens").mapInArrow(
        _reporter(keys, to_arrow_schema(reports_schema), max_tokens), reports_schema
    )
    # At most two reports per block meet here, also for a key that spans all blocks.
    entries = (
        reports.repartition(*keys)
        .sortWithinPartitions(*keys, "_block", F.desc("_continues"))
        .mapInArrow(_chainer(keys, to_arrow_schema(entries_schema), max_tokens), entries_schema)
    )
    same = F.col("f._block") == F.col("e._block")
    for key in keys:
        same = same & F.col(f"f.{key}").eqNullSafe(F.col(f"e.{key}"))
    # One entry per block at most, so its size is bound by the number of blocks; the broadcast
    # join keeps the rows of a block together and in order.
    return (
        frozen.alias("f")
        .join(F.broadcast(entries).alias("e"), same, "left")
        .select("f.*", "_fill", "_chunk")
    )


def join_lines(rows: DataFrame, keys: Sequence[str], newest_first: bool = False) -> DataFrame:
    """``text``: the non-NULL ``line`` values of each group joined by newlines, '' for none."""
    order = NEWEST_FIRST if newest_first else OLDEST_FIRST
    text = F.expr(f"listagg(line, '\\n') WITHIN GROUP (ORDER BY {order})")
    return rows.groupBy(*keys).agg(F.coalesce(text, F.lit("")).alias("text"))


def chunk_and_format(
    messages: DataFrame,
    keys: Sequence[str],
    max_tokens: int = DEFAULT_MAX_TOKENS,
    newest_first: bool = False,
    include_timestamps: bool = True,
    author: str | None = None,
    chunks: int | None = None,
) -> DataFrame:
    """One formatted text per key and chunk; a chunk of blank messages gives ''. All chunks, or the
    first ``chunks`` of each key.

    Chunks are found on narrow rows, by a pass whose shuffle files go as it ends. Then the lines move, once, compressed
    and not written: to the part of their key, which begins with a chunk, so that every part packs its rows by itself.
    Only pieces of very long texts move again, to be joined. A chunk holds one budget of words (or one oversize
    message), so its text is small; blank messages contribute no line to it. ``messages`` is read twice.
    """
    keys = list(keys)
    about = F.col("created_at") if include_timestamps else None, F.col(author) if author else None
    line = format_line(F.col("content"), *about)
    part_chunks = max(1, PART_TOKENS // max_tokens)
    with passing(messages.sparkSession):
        cuts = materialise(_cuts(_chunked(messages, keys, max_tokens, newest_first), keys, part_chunks, newest_first))
    # One entry for every 32 MB of text or so.
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"m.{key}").eqNullSafe(F.col(f"c.{key}"))
    begun = F.filter("_cuts", lambda c: c["_first"] >= _place() if newest_first else c["_first"] <= _place())
    part = F.coalesce(F.array_max(F.transform(begun, lambda c: c["_part"])), F.lit(0).cast("long"))
    lines = messages.select(
        *keys, "created_at", F.col("message_id").cast("long").alias("message_id"),
        (F.coalesce("content", F.lit("")) != "").alias("_filled"),
        F.octet_length(line_lead(*about)).alias("_lead"), line.alias("line"),
    )
    placed = lines.alias("m").join(F.broadcast(cuts).alias("c"), same, "left").select("m.*", part.alias("_part"))
    if chunks is not None:
        placed = placed.filter(F.col("_part") < chunks)
    key_fields, time = [lines.schema[k] for k in keys], lines.schema["created_at"].dataType.simpleString()
    shipped = _schema(
        key_fields,
        f"_part long, created_at array<{time}>, message_id array<long>, tokens array<long>, size array<int>, _raw long, _lines binary",
    )
    parts = (
        placed.select(*keys, "_part", "created_at", "message_id", "_filled", "_lead", "line")
        .mapInArrow(_shipper(keys, to_arrow_schema(shipped)), shipped)
        .repartition(*keys, "_part")
        .sortWithinPartitions(*keys, "_part")
    )
    schema = _schema(key_fields, "chunk_no long, _piece int, _whole boolean, text string")
    pieces = parts.mapInArrow(_liner(keys, to_arrow_schema(schema), max_tokens, newest_first), schema)
    if chunks is not None:
        pieces = pieces.filter(F.col("chunk_no") < chunks)
    columns = [*keys, "chunk_no", "text"]
    together = F.expr("listagg(text, '\\n') WITHIN GROUP (ORDER BY _piece)")
    long = pieces.filter(~F.col("_whole")).groupBy(*keys, "chunk_no").agg(together.alias("text"))
    return pieces.filter("_whole").select(*columns).unionByName(long.select(*columns))


def chunk_stats(messages: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Size of a message set: messages, tokens, estimated chunks, mean tokens (half-even)."""
    total, tokens = F.count(F.lit(1)), F.coalesce(F.sum("tokens"), F.lit(0).cast("long"))
    chunks = F.ceil(F.col("total_tokens") / F.lit(DEFAULT_MAX_TOKENS)).cast("long")
    mean = F.bround(F.col("total_tokens") / F.col("total_messages"), 1)
    filled = F.col("total_messages") > 0
    return (
        messages.select(*keys, estimate_tokens(F.col("content")).alias("tokens"))
        .groupBy(*keys)
        .agg(total.alias("total_messages"), tokens.alias("total_tokens"))
        .withColumn(
            "estimated_chunks",
            F.when(filled, F.greatest(F.lit(1).cast("long"), chunks)).otherwise(
                F.lit(0).cast("long")
            ),
        )
        .withColumn("avg_tokens_per_message", F.when(filled, mean).otherwise(F.lit(0.0)))
    )
