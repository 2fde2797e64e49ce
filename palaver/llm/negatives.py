"""Hard negatives by Hilbert-ordered candidate blocks with zone maps.

Candidates are sorted by (label, Hilbert index) and written once as Parquet blocks of at most ``BLOCK``
rows. Every block carries its zone map: the least and greatest value of each dimension. By interval
arithmetic a zone map bounds the score of an anchor with any row of the block from below and above,
so a block is read for an anchor only if that range meets one of the anchor's windows:

* for positives, blocks of the anchor's label that can reach its fifth best score so far; the first
  scores come from the blocks around the anchor itself, at the time they are written;
* for negatives, blocks with other labels that can hold a score of a positive's window, and can still
  beat the third best found there.

Blocks are gathered in parts of at most ``PART_BLOCKS``, which have zone maps as well. The anchors of a
part are one group: near each other on the curve, they need much the same blocks. Groups meet the zone
maps of all parts in chunks of bounded size, and move only to the parts that some of their anchors need;
there the blocks of the part are held once and the groups stream past. So no task holds more than one
part and one group, whatever the number of anchors, and a label that holds a third of all rows is only
more parts. Scores are products of whole numbers, exact at the float width chosen for them.

How much the zone maps save depends on the vectors: clustered ones leave few blocks to an anchor,
directions spread evenly over many dimensions nearly all of them. The result is exact either way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm.common import written

POSITIVES = 5
NEGATIVES = 3
#: A window is from ``LEAST`` to ``MOST`` hundredths of the positive's score.
LEAST, MOST = 50, 95
#: Components are whole numbers, cut off at this size (131,072.0 before the scaling by 256).
TOP = 1 << 25
#: Rows of a block, and blocks of a part.
BLOCK = 256
PART_BLOCKS = 64
#: Zone maps of parts that one chunk holds, and rows (anchors, windows) scored at a time.
CHUNK_PARTS = 2_048
BATCH = 512
#: Dimensions that the Hilbert curve runs through, those of most variance, and bits of each.
HILBERT_DIMS = 16
HILBERT_BITS = 4

#: Below every score; also stands for a null id, which counts as the smallest.
NONE = -(2**62)


# --- rows that take part -------------------------------------------------------------------------


def prepared(vectors: DataFrame, change_labels: bool = True) -> DataFrame:
    """(vec_id, label, v): the rows that take part, with whole components."""
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    if change_labels:
        label = F.when(F.pmod(vec_id, F.lit(7)) == 0, (label + 1) % 10).otherwise(label)
    values = F.col("embedding").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    top = F.lit(float(TOP))
    whole = F.transform(values, lambda x: F.floor(F.greatest(-top, F.least(top, x * F.lit(256.0)))).cast("int"))
    taken = vectors.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    return taken.select(vec_id.alias("vec_id"), label.alias("label"), whole.alias("v"))


def matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of whole numbers; a shorter vector counts as zero in the dimensions it lacks."""
    values = lists.flatten().to_numpy()
    lengths = np.diff(lists.offsets.to_numpy())
    if (lengths == dims).all():
        return values.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), np.int32)
    out[np.arange(dims)[None, :] < lengths[:, None]] = values
    return out


_TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    arrays = [pa.array(column, _TYPES[kind]) for column, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def _ids(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NONE)


# --- Hilbert order ---------------------------------------------------------------------------------


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (rows of coordinates below 2**bits) on the Hilbert curve, in at most 64 bits.

    Skilling's transform: undo the turns of the curve bit by bit, Gray-code, and interleave.
    """
    x = cells.T.astype(np.int64)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(len(x)):
            turned = (x[i] >> bit) & 1 == 1
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= ((x[-1] >> bit) & 1) * ((1 << bit) - 1)
    x ^= turn
    index = np.zeros(cells.shape[0], np.uint64)
    for bit in range(bits - 1, -1, -1):
        for row in x:
            index = (index << np.uint64(1)) | ((row >> bit) & 1).astype(np.uint64)
    return index


class Curve:
    """Number of rows and dimensions, and the dimensions of most variance with their mean and deviation."""

    def __init__(self, rows: DataFrame) -> None:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, total, square = 0, np.zeros(0), np.zeros(0)
            for batch in batches:
                lengths = np.diff(batch["v"].offsets.to_numpy())
                wide = max(len(total), int(lengths.max(initial=0)))
                total, square = (np.pad(a, (0, wide - len(a))) for a in (total, square))
                values = matrix(batch["v"], wide).astype(float)
                n += len(values)
                total += values.sum(axis=0)
                square += (values**2).sum(axis=0)
            # The rows are counted under dimension -1.
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, len(total), dtype=np.int32)), pa.array(np.r_[n, total]), pa.array(np.r_[0.0, square])],
                names=["dim", "s", "q"],
            )

        found = (
            rows.select("v").mapInArrow(sums, "dim int, s double, q double").groupBy("dim").agg(F.sum("s").alias("s"), F.sum("q").alias("q"))
        ).toArrow()  # one row for each dimension
        order = np.argsort(found["dim"].to_numpy())
        s, q = (found[name].to_numpy()[order] for name in ("s", "q"))
        self.rows = int(s[0]) if len(s) else 0
        self.dims = max(1, len(s) - 1)
        mean = np.zeros(self.dims)
        deviation = np.zeros(self.dims)
        if self.rows and len(s) > 1:
            mean = s[1:] / self.rows
            deviation = np.sqrt(np.maximum(q[1:] / self.rows - mean**2, 0))
        self.chosen = np.sort(np.argsort(-deviation, kind="stable")[:HILBERT_DIMS])
        self.mean = mean[self.chosen]
        self.step = np.maximum(deviation[self.chosen], 1e-9) * 4 / (1 << HILBERT_BITS)

    def places(self, values: np.ndarray) -> np.ndarray:
        """Places on the curve as signed numbers in the same order. Cells span two deviations to each side."""
        cells = np.floor((values[:, self.chosen] - self.mean) / self.step) + (1 << (HILBERT_BITS - 1))
        cells = np.clip(cells, 0, (1 << HILBERT_BITS) - 1).astype(np.int64)
        return (hilbert_index(cells, HILBERT_BITS) ^ np.uint64(1 << 63)).view(np.int64)


def in_order(rows: DataFrame, curve: Curve) -> DataFrame:
    """Rows with their place on the curve, ``h``."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("h", pa.array(curve.places(matrix(batch["v"], curve.dims)), pa.int64()))

    return rows.mapInArrow(place, "vec_id long, label long, v array<int>, h long")


# --- scores and bounds -------------------------------------------------------------------------------


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows, exact: by the narrowest numbers that hold every sum."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of each row of ``a`` with any vector inside each box, by interval arithmetic."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


class Best:
    """For each of several searches, its best few rows by (greatest score, smallest id, place)."""

    def __init__(self, searches: int, keep: int) -> None:
        self.keep = keep
        self.score = np.full((searches, keep), NONE, np.int64)
        self.id = np.zeros((searches, keep), np.int64)
        self.place = np.zeros((searches, keep), np.int64)

    def take(self, searches: np.ndarray, scores: np.ndarray, ids: np.ndarray, base: int) -> None:
        """Merge the scores of a block, whose columns are in order of ids; ``NONE`` does not count."""
        width = scores.shape[1]
        if width > self.keep and np.abs(scores[scores > NONE]).max(initial=0) < 2**53:
            # The first of equal scores ranks higher.
            rank = np.maximum(scores, -(2**53)) * width - np.arange(width)
            chosen = np.argpartition(-rank, self.keep - 1, axis=1)[:, : self.keep]
        else:
            chosen = np.argsort(-scores, axis=1, kind="stable")[:, : self.keep]
        merged = [
            np.concatenate([old[searches], new], axis=1)
            for old, new in ((self.score, np.take_along_axis(scores, chosen, 1)), (self.id, ids[chosen]), (self.place, base + chosen))
        ]
        order = np.lexsort((merged[2], merged[1], -merged[0]), axis=1)[:, : self.keep]
        self.score[searches], self.id[searches], self.place[searches] = (np.take_along_axis(m, order, 1) for m in merged)


# --- blocks with zone maps -----------------------------------------------------------------------------

# Matrices, ids and labels as bytes. The first block of a part carries the zone map of the part and the
# group of its anchors: their places in the part, and as limit the score that so many others there reach.
_BLOCK_FIELDS = "part long, block int, ids binary, labels binary, v binary, low binary, high binary"
_ZONE_FIELDS = "part_low binary, part_high binary, label_from long, label_to long"
_GROUP_FIELDS = "places binary, anchor_ids binary, anchor_labels binary, anchors binary, limits binary"


def part_rows_for(rows: int, tasks: int) -> int:
    """Rows of a part: enough parts for all tasks, and full parts where there are many rows."""
    return int(min(BLOCK * PART_BLOCKS, max(BLOCK, -(-rows // max(1, 4 * tasks)))))


def _seeds(anchors: np.ndarray, labels: np.ndarray, v: np.ndarray, positives: int) -> np.ndarray:
    """For each anchor the score that ``positives`` other rows of its label reach, as far as there are so many."""
    out = np.full(len(anchors), NONE, np.int64)
    if len(v) < positives:
        return out
    for at in range(0, len(anchors), BATCH):
        own = anchors[at : at + BATCH]
        scores = products(v[own], v)
        scores[labels[own][:, None] != labels[None, :]] = NONE
        scores[np.arange(len(own)), own] = NONE
        out[at : at + BATCH] = -np.partition(-scores, positives - 1, axis=1)[:, positives - 1]
    return out


def _layout(dims: int, part_rows: int, every: int, positives: int):
    """Sorted rows into blocks and parts."""

    def part_of(number: int, held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        ids, labels, v = (np.concatenate(column) for column in zip(*held, strict=True))
        # Inside a block rows stand in order of ids, so ties need no further look.
        order = np.lexsort((ids, np.arange(len(ids)) // BLOCK))
        ids, labels, v = ids[order], labels[order], v[order]
        anchors = np.flatnonzero((ids != NONE) & (ids % every == 0))
        first = (
            v.min(axis=0).tobytes(), v.max(axis=0).tobytes(), int(labels.min()), int(labels.max()),
            anchors.astype(np.int64).tobytes(), ids[anchors].tobytes(), labels[anchors].tobytes(), v[anchors].tobytes(),
            _seeds(anchors, labels, v, positives).tobytes(),
        )
        rows = []
        for block, at in enumerate(range(0, len(ids), BLOCK)):
            own = slice(at, at + BLOCK)
            box = v[own].min(axis=0).tobytes(), v[own].max(axis=0).tobytes()
            content = ids[own].tobytes(), labels[own].tobytes(), v[own].tobytes()
            rows.append((number, block, *content, *box, *(first if block == 0 else (None,) * len(first))))
        return _batch(rows, f"{_BLOCK_FIELDS}, {_ZONE_FIELDS}, {_GROUP_FIELDS}")

    def layout(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            ids = batch["vec_id"].fill_null(NONE).to_numpy()
            labels = batch["label"].to_numpy()
            v = matrix(batch["v"], dims)
            at = 0
            while at < len(ids):
                end = min(len(ids), at + part_rows - size)
                held.append((ids[at:end], labels[at:end], v[at:end].copy()))
                size += end - at
                at = end
                if size == part_rows:
                    yield part_of(number, held)
                    number, held, size = number + 1, [], 0
        if held:
            yield part_of(number, held)

    return layout


def candidate_blocks(rows: DataFrame, curve: Curve, every: int, positives: int) -> DataFrame:
    """The candidates in order of (label, curve) as written blocks, one row each."""
    part_rows = part_rows_for(curve.rows, rows.sparkSession.sparkContext.defaultParallelism)
    order = ["label", "h", "vec_id"]
    ranges = max(1, -(-curve.rows // (4 * part_rows)))
    ordered = in_order(rows, curve).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return written(
        ordered.select("vec_id", "label", "v").mapInArrow(
            _layout(curve.dims, part_rows, every, positives), f"{_BLOCK_FIELDS}, {_ZONE_FIELDS}, {_GROUP_FIELDS}"
        )
    )


class Part:
    """The blocks of one part, as one task holds them."""

    def __init__(self, blocks: list[dict], dims: int) -> None:
        blocks = sorted(blocks, key=lambda b: b["block"])
        self.ids = [_longs(b["ids"]) for b in blocks]
        self.labels = [_longs(b["labels"]) for b in blocks]
        self.v = [np.frombuffer(b["v"], np.int32).reshape(-1, dims) for b in blocks]
        self.low = np.stack([np.frombuffer(b["low"], np.int32) for b in blocks])
        self.high = np.stack([np.frombuffer(b["high"], np.int32) for b in blocks])
        self.first = np.cumsum([0, *map(len, self.ids)])


class Group:
    """Anchors of one part: places there, ids, labels, vectors, and the limits of their searches, a row each."""

    def __init__(self, row: dict, dims: int) -> None:
        self.places = _longs(row["places"])
        self.ids = _longs(row["anchor_ids"])
        self.labels = _longs(row["anchor_labels"])
        self.v = np.frombuffer(row["anchors"], np.int32).reshape(-1, dims)
        self.limits = _longs(row["limits"]).reshape(len(self.places), -1)

    def some(self, chosen: np.ndarray) -> tuple[bytes, ...]:
        return tuple(a[chosen].tobytes() for a in (self.places, self.ids, self.labels, self.v, self.limits))


# --- from anchors to the parts they need -------------------------------------------------------------------


def _routed(groups: DataFrame, blocks: DataFrame, parts: int, dims: int, needs: Callable) -> DataFrame:
    """(part, home, ``_GROUP_FIELDS``): of each group the anchors that need a part, by the zone maps of parts.

    Zone maps come in chunks of about ``CHUNK_PARTS`` parts, one row each. A group meets each chunk
    once, in a join keyed by the chunk and a share of the groups; a task holds one of each.
    """
    chunks = -(-parts // CHUNK_PARTS)
    shares = max(1, min(parts, 4 * blocks.sparkSession.sparkContext.defaultParallelism))
    zone = F.struct("part", "label_from", "label_to", "part_low", "part_high")
    packed = (
        blocks.filter("block = 0")
        .groupBy(F.pmod(F.xxhash64("part"), F.lit(chunks)).alias("chunk"))
        .agg(F.collect_list(zone).alias("zones"))
        .withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    )
    met = groups.withColumn("share", F.pmod(F.xxhash64("home"), F.lit(shares))).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))
    )

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                group, zones = Group(row, dims), row["zones"]
                low, high = (np.stack([np.frombuffer(z[name], np.int32) for z in zones]) for name in ("part_low", "part_high"))
                labels = np.array([(z["label_from"], z["label_to"]) for z in zones], np.int64)
                needed = needs(group, labels, *bounds(group.v, low, high))
                out = []
                for zone, chosen in zip(zones, needed.T, strict=True):
                    if chosen.any():
                        out.append((zone["part"], row["home"], *group.some(chosen)))
                    if len(out) == 64:
                        yield _batch(out, f"part long, home long, {_GROUP_FIELDS}")
                        out = []
                yield _batch(out, f"part long, home long, {_GROUP_FIELDS}")

    joined = met.join(packed, ["chunk", "share"]).drop("chunk", "share")
    return joined.mapInArrow(route, f"part long, home long, {_GROUP_FIELDS}")


def _read(blocks: DataFrame, routed: DataFrame, parts: int, dims: int, search: Callable, schema: str) -> DataFrame:
    """Bring groups to the parts they need and ``search`` there: blocks are held, groups stream past."""
    left = blocks.select(*[field.split()[0] for field in _BLOCK_FIELDS.split(", ")])
    names = ["home", *(field.split()[0] for field in _GROUP_FIELDS.split(", "))]
    tasks = min(parts, max(4 * blocks.sparkSession.sparkContext.defaultParallelism, parts // 16))
    together = (
        left.unionByName(routed, allowMissingColumns=True)
        .repartition(tasks, "part")
        .sortWithinPartitions("part", F.asc_nulls_last("block"))
        .select("part", "block", "ids", "labels", "v", "low", "high", *names)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blocks_of, part = None, [], None
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["part"] != now:
                    now, blocks_of, part = row["part"], [], None
                if row["block"] is not None:
                    blocks_of.append(row)
                    continue
                if part is None:
                    part, blocks_of = Part(blocks_of, dims), []
                group = Group(row, dims)
                for columns in search(part, group, now, row["home"]):
                    count = len(columns[0])
                    around = [pa.array(np.full(count, row["home"], np.int64)), pa.array(np.full(count, now, np.int64))]
                    names = [field.split()[0] for field in schema.split(", ")]
                    yield pa.RecordBatch.from_arrays(around + columns, names=names)

    return together.mapInArrow(run, schema)


# --- the two searches ------------------------------------------------------------------------------------

_POSITIVE = "home long, part long, place long, anchor_id long, positive_id long, positive_score long, row long"
_NEGATIVE = "home long, part long, place long, positive_score long, negative_id long, negative_score long, row long"


def _needs_for_positives(group: Group, labels: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    own = group.labels[:, None]
    return (labels[None, :, 0] <= own) & (own <= labels[None, :, 1]) & (most >= group.limits[:, :1])


def _search_positives(positives: int):
    def search(part: Part, group: Group, number: int, home: int) -> Iterator[list[pa.Array]]:
        for at in range(0, len(group.places), BATCH):
            cut = slice(at, at + BATCH)
            v, labels, seed, places = group.v[cut], group.labels[cut], group.limits[cut, 0], group.places[cut]
            best = Best(len(v), positives)
            _, most = bounds(v, part.low, part.high)
            for block in np.argsort(-most.max(axis=0), kind="stable"):
                same = np.isin(labels, part.labels[block])
                rows = np.flatnonzero(same & (most[:, block] >= np.maximum(seed, best.score[:, -1])))
                if not len(rows):
                    continue
                scores = products(v[rows], part.v[block])
                scores[labels[rows][:, None] != part.labels[block][None, :]] = NONE
                if number == home:  # a row is no positive of itself
                    own = places[rows] - part.first[block]
                    mine = np.flatnonzero((own >= 0) & (own < len(part.ids[block])))
                    scores[mine, own[mine]] = NONE
                best.take(rows, scores, part.ids[block], int(part.first[block]))
            row, column = np.nonzero(best.score > NONE)
            yield [
                pa.array(places[row]), pa.array(group.ids[cut][row]), _ids(best.id[row, column]),
                pa.array(best.score[row, column]), pa.array(best.place[row, column]),
            ]

    return search


def window(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of a negative for each score of a positive; empty for scores below zero."""
    return -((-LEAST * positive) // 100), MOST * positive // 100


def _needs_for_negatives(group: Group, labels: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    other = (labels[None, :, 0] != group.labels[:, None]) | (labels[None, :, 1] != group.labels[:, None])
    met = np.zeros(most.shape, bool)
    for positive in group.limits.T:
        low, high = window(positive)
        met |= (positive != NONE)[:, None] & (most >= low[:, None]) & (least <= high[:, None]) & (low <= high)[:, None]
    return other & met


def _search_negatives(negatives: int):
    def search(part: Part, group: Group, number: int, home: int) -> Iterator[list[pa.Array]]:
        for at in range(0, len(group.places), BATCH):
            cut = slice(at, at + BATCH)
            v, labels, places = group.v[cut], group.labels[cut], group.places[cut]
            # One search for each window; equal scores of an anchor share theirs.
            whose, column = np.nonzero(group.limits[cut] != NONE)
            positive = group.limits[cut][whose, column]
            low, high = window(positive)
            best = Best(len(positive), negatives)
            least, most = bounds(v, part.low, part.high)
            for block in np.argsort(-most.max(axis=0), kind="stable"):
                floor = np.maximum(low, best.score[:, -1])
                open_ = np.flatnonzero((most[whose, block] >= floor) & (least[whose, block] <= high))
                if not len(open_):
                    continue
                rows, back = np.unique(whose[open_], return_inverse=True)
                scores = products(v[rows], part.v[block])
                scores[labels[rows][:, None] == part.labels[block][None, :]] = NONE
                inside = scores[back]
                inside[(inside < floor[open_][:, None]) | (inside > high[open_][:, None])] = NONE
                hit = np.flatnonzero(inside.max(axis=1) > NONE)
                if len(hit):
                    best.take(open_[hit], inside[hit], part.ids[block], int(part.first[block]))
            row, column = np.nonzero(best.score > NONE)
            yield [
                pa.array(places[whose[row]]), pa.array(positive[row]), _ids(best.id[row, column]),
                pa.array(best.score[row, column]), pa.array(best.place[row, column]),
            ]

    return search


def _first(found: DataFrame, keys: list[str], score: str, ident: str, keep: int, rank: str) -> DataFrame:
    """The best ``keep`` rows of each key; every part has sent its own best few."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_first(ident), "part", "row")
    return found.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= keep).drop("part", "row")


def _with_windows(groups: DataFrame, positives: DataFrame, keep: int, dims: int) -> DataFrame:
    """The groups with the scores of their positives as limits, each score of an anchor once."""
    scores = positives.groupBy("home").agg(F.collect_set(F.struct("place", "positive_score")).alias("scores"))

    def limits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                of: dict[int, list[int]] = {}
                for one in row["scores"]:
                    of.setdefault(one["place"], []).append(one["positive_score"])
                places = _longs(row["places"]).tolist()
                table = np.array([(of.get(p, []) + [NONE] * keep)[:keep] for p in places], np.int64)
                yield _batch(
                    [(row["home"], row["places"], row["anchor_ids"], row["anchor_labels"], row["anchors"], table.tobytes())],
                    f"home long, {_GROUP_FIELDS}",
                )

    return groups.join(scores, "home").mapInArrow(limits, f"home long, {_GROUP_FIELDS}")


def hard_negatives(
    vectors: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, change_labels: bool = True
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exact.

    Anchors are the rows whose vec_id is divisible by ``every``; positives are an anchor's best rows of
    its label, negatives the best rows of other labels inside a positive's window. A row with a null
    label or vector, or with a null or non-finite component, takes no part. A null vec_id is no
    anchor; it is the smallest id where scores tie. Rows that share a vec_id are rows of their own: each
    may be an anchor, a positive and a negative, also of the other. A shorter vector counts as
    zero in the dimensions it lacks. An anchor without positives, or a positive with an empty window
    (every score below zero), gives no row; so does an empty table. Further columns are left out,
    whatever their names. Whole components beyond ``TOP`` count as ``TOP``.
    """
    rows = prepared(vectors, change_labels)
    curve = Curve(rows)
    blocks = candidate_blocks(rows, curve, every, positives)
    parts = max(1, blocks.filter("block = 0").count())
    groups = blocks.filter("block = 0 and octet_length(places) > 0").select(
        F.col("part").alias("home"), *(field.split()[0] for field in _GROUP_FIELDS.split(", "))
    )
    dims = curve.dims

    routed = _routed(groups, blocks, parts, dims, _needs_for_positives)
    found = _read(blocks, routed, parts, dims, _search_positives(positives), _POSITIVE)
    chosen = written(_first(found, ["home", "place"], "positive_score", "positive_id", positives, "turn").drop("turn"))

    routed = _routed(_with_windows(groups, chosen, positives, dims), blocks, parts, dims, _needs_for_negatives)
    found = _read(blocks, routed, parts, dims, _search_negatives(negatives), _NEGATIVE)
    mined = _first(found, ["home", "place", "positive_score"], "negative_score", "negative_id", negatives, "rank")
    return chosen.join(mined, ["home", "place", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
