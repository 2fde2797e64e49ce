"""SimHash near-dedup: fingerprints, a binary trie self-join, and connected components.

Fingerprints that differ in at most two of 64 bits agree on two of four 16-bit blocks. Each
fingerprint goes to the six pairs of blocks with those 32 bits in front (or to more and shorter
fronts for a larger budget); a group of equal fronts is the root of a trie over the other bits. The self-join walks pairs of trie nodes together,
adds up the bits where their paths differ, and drops a pair above the budget or with an empty side.
Groups hold distinct fingerprints only. A group too large for a task is split by the same walk:
its rows are dealt to pairs of child nodes, level by level, until every pair fits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm.common import NO_ID, discard, texts, written

BITS = 64
#: Fingerprints of a trie that one task walks.
GROUP = 20_000
#: Bits of one split of a large trie.
STEP = 4
#: Pairs of one task after which they become stars; bounds the memory for large groups of copies.
SETTLE = 1_000_000
#: Shingles hashed at a time; bounds the memory for a long text.
CHUNK = 50_000


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles: a bit is set if over half of the hashes set it.

    A-Z are lowered. A text with fewer words than a shingle is one shingle; without words it is 0.
    """
    ones, size = np.zeros(BITS, np.int64), 0
    for hashes in _hashes(text, shingle, seed):
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        size += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > size).tobytes(), "big")


def _hashes(text: str, shingle: int, seed: int) -> Iterator[np.ndarray]:
    """Hashes of the word shingles in their order, ``CHUNK`` at a time."""
    words = text.encode().lower().split()
    if not words:
        return
    line = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    begins = np.r_[0, ends[:-1] + 1]
    if len(words) >= shingle:
        begins, ends = begins[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        begins, ends = begins[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(begins), CHUNK):
        part = [digest(line[b:e], seed) for b, e in zip(begins[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)]
        yield np.array(part, np.uint64)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long. Null text is the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(text, shingle) for text in batch["text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found.view(np.int64), pa.int64())], names=["doc_id", "fp"])

    return texts(docs).mapInArrow(run, "doc_id long, fp long")


def _fronts(fp: Column, blocks: int, agree: int) -> Column:
    """The orders of the blocks that put each choice of ``agree`` blocks first."""
    width = BITS // blocks
    block = [F.shiftrightunsigned(fp, BITS - width * (i + 1)).bitwiseAND(F.lit((1 << width) - 1)) for i in range(blocks)]
    orders = []
    for first in combinations(range(blocks), agree):
        turned = [*first, *(i for i in range(blocks) if i not in first)]
        value = F.lit(0).cast("long")
        for place, i in enumerate(turned):
            value = value.bitwiseOR(F.shiftleft(block[i], BITS - width * (place + 1)))
        orders.append(value)
    return F.posexplode(F.array(*orders))


def _top(value: Column, bits: int) -> Column:
    return F.shiftrightunsigned(value, BITS - bits) if bits else F.lit(0).cast("long")


def trie_pairs(values: np.ndarray, group: np.ndarray, side: np.ndarray, crossed: np.ndarray, depth: int, budget: int, frontier: int = 100_000) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of values in one group that differ in at most ``budget`` bits.

    Rows are sorted by (group, side, value); values of one side agree on the first ``depth``
    bits. A group with one side is joined with itself, one with two sides across them;
    ``crossed`` are the bits that the sides differ in so far.

    The pairs are a spanning part of all: once many are found they become stars, and node pairs
    whose rows are one component already are dropped, so large groups of copies aren't compared pair by pair.
    """
    cuts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (side[1:] != side[:-1])])
    ends = np.r_[cuts[1:], len(values)]
    alone = np.r_[True, group[cuts][1:] != group[cuts][:-1]] & np.r_[group[cuts][1:] != group[cuts][:-1], True]
    left = np.flatnonzero(side[cuts] == 0)
    both = left[~alone[left]]
    own = left[alone[left] & (crossed[cuts[left]] == 0)]
    start = np.concatenate([own, both]), np.concatenate([own, both + 1])
    stack = [(depth, cuts[start[0]], ends[start[0]], cuts[start[1]], ends[start[1]], crossed[cuts[start[0]]].astype(np.int64))]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    zeros: dict[int, np.ndarray] = {}
    label = np.arange(len(values))
    breaks = np.cumsum(np.r_[0, label[1:] != label[:-1]])
    pending = 0
    while stack:
        if pending > SETTLE:
            stars = forest(*(np.concatenate([part[i] for part in found]) for i in (0, 1)))
            found, pending = [stars], 0
            label = np.arange(len(values))
            label[stars[0]] = stars[1]
            breaks = np.cumsum(np.r_[0, label[1:] != label[:-1]])
        bit, a0, a1, b0, b1, gone = stack.pop()
        same = a0 == b0
        live = (a1 > a0) & (b1 > b0) & (gone <= budget) & ~(same & (a1 - a0 < 2))
        a0, a1, b0, b1, gone, same = (x[live] for x in (a0, a1, b0, b1, gone, same))
        # Rows of one component on both sides: nothing to find.
        live = (label[a0] != label[b0]) | (breaks[a1 - 1] != breaks[a0]) | (breaks[b1 - 1] != breaks[b0])
        a0, a1, b0, b1, gone, same = (x[live] for x in (a0, a1, b0, b1, gone, same))
        if not len(a0):
            continue
        if len(a0) > frontier:
            half = len(a0) // 2
            stack += [(bit, a0[x], a1[x], b0[x], b1[x], gone[x]) for x in (slice(half), slice(half, None))]
            continue
        # Pairs of small nodes are leaves: compare their values directly.
        small = (a1 - a0) * (b1 - b0) <= 16
        if bit == BITS:
            small[:] = True
        if small.any():
            x0, x1, y0, y1 = a0[small], a1[small], b0[small], b1[small]
            if bit == BITS:
                x1 = x0 + 1  # rows of a last node are equal: its first row stands for them
            for x, y in _crossings(x0, x1, y0, y1):
                near = (x < y) & (np.bitwise_count(values[x] ^ values[y]) <= budget)
                if near.any():
                    found.append((x[near], y[near]))
                    pending += int(near.sum())
            a0, a1, b0, b1, gone, same = (x[~small] for x in (a0, a1, b0, b1, gone, same))
        if not len(a0):
            continue
        if bit not in zeros:
            zeros[bit] = np.r_[0, np.cumsum((values >> np.uint64(BITS - 1 - bit)) & np.uint64(1) == 0)]
        count = zeros[bit]
        am, bm = a0 + count[a1] - count[a0], b0 + count[b1] - count[b0]
        cross = ~same  # of a node with itself, one of the two crossings is enough
        stack.append(
            (
                bit + 1,
                np.concatenate([a0, am, a0, am[cross]]),
                np.concatenate([am, a1, am, a1[cross]]),
                np.concatenate([b0, bm, bm, b0[cross]]),
                np.concatenate([bm, b1, b1, bm[cross]]),
                np.concatenate([gone, gone, gone + 1, gone[cross] + 1]),
            )
        )
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *(x for x, _ in found)]), np.concatenate([none, *(y for _, y in found)])


def _crossings(x0: np.ndarray, x1: np.ndarray, y0: np.ndarray, y1: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of the ranges x0..x1 and y0..y1, about ``SETTLE`` at a time."""
    node = np.repeat(np.arange(len(x0)), x1 - x0)
    x = np.arange(len(node)) - np.repeat(np.cumsum(x1 - x0) - (x1 - x0), x1 - x0) + x0[node]
    size = (y1 - y0)[node]
    ends = np.cumsum(size)
    at = 0
    while at < len(x):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + SETTLE, "right")))
        part = size[at:to]
        each = np.repeat(np.arange(at, to), part)
        yield x[each], np.arange(len(each)) - np.repeat(np.cumsum(part) - part, part) + y0[node[each]]
        at = to


def forest(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of the pairs: (node, smallest node), fewer edges with the same components."""
    nodes, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    u, v = at[: len(x)], at[len(x) :]
    label = np.arange(len(nodes))
    while True:
        low = label.copy()
        np.minimum.at(low, u, label[v])
        np.minimum.at(low, v, label[u])
        low = low[low]
        if (low == label).all():
            break
        label = low
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def links(distinct: DataFrame, budget: int = 2, agree: int = 2, group: int = GROUP) -> DataFrame:
    """(a, b): links whose components are those of all fingerprint pairs within ``budget`` bits.

    ``distinct`` has one row per fingerprint (column fp). Of budget + ``agree`` equal blocks, a pair
    within the budget agrees on ``agree`` at least, so every such pair is found; a task gives a
    spanning forest of its pairs.
    """
    blocks = budget + agree
    if BITS % blocks:
        raise ValueError("budget + agree must divide 64")
    fronts = _fronts(F.col("fp"), blocks, agree).alias("turn", "value")
    return _self_join(distinct.select("fp", fronts), budget, agree * BITS // blocks, group)


def _self_join(rows: DataFrame, budget: int, depth: int, group: int) -> DataFrame:
    """Links from (fp, turn, value) rows whose values may be near only if their first ``depth`` bits agree."""
    rows = rows.select("fp", "value", "turn", F.lit(0).alias("side"), F.lit(0).cast("long").alias("flips"))
    done: list[DataFrame] = []
    while True:
        # A node pair is named by the path of its first side and the bits its second side flips.
        keyed = rows.withColumn("node", F.when(F.col("side") == 0, _top(F.col("value"), depth)).otherwise(_top(F.col("value"), depth).bitwiseXOR(F.col("flips"))))
        keyed = keyed.withColumn("depth", F.lit(depth))
        counts = keyed.groupBy("turn", "node", "flips").agg(
            F.sum(F.when(F.col("side") == 0, 1).otherwise(0)).alias("firsts"), F.sum("side").alias("seconds")
        )
        is_live = F.when(F.col("flips") == 0, F.col("firsts") > 1).otherwise((F.col("firsts") > 0) & (F.col("seconds") > 0))
        big = counts.filter(F.col("firsts") + F.col("seconds") > group).select("turn", "node", "flips", is_live.alias("live"))
        big = written(big) if depth < BITS else None
        if big is None or big.isEmpty():
            done.append(keyed)
            break
        done.append(keyed.join(big, ["turn", "node", "flips"], "left_anti"))
        large = written(keyed.join(big.filter("live"), ["turn", "node", "flips"], "left_semi"))
        rows = _children(large, depth, budget)
        depth += STEP
    edges = [_walk(frame, budget) for frame in done]
    out = edges[0]
    for frame in edges[1:]:
        out = out.unionByName(frame)
    return out.distinct()


def _children(large: DataFrame, depth: int, budget: int) -> DataFrame:
    """Deal the rows of large node pairs to the pairs of their child nodes, ``STEP`` bits deeper."""
    masks = [m for m in range(1 << STEP) if m.bit_count() <= budget]
    spent = F.bit_count("flips")
    digit = F.shiftrightunsigned("value", BITS - depth - STEP).bitwiseAND(F.lit((1 << STEP) - 1))
    choice = F.explode(F.array(*[F.lit(m).cast("long") for m in masks]))
    dealt = large.select("fp", "value", "turn", "side", "flips", choice.alias("mask")).filter(spent + F.bit_count("mask") <= budget)
    own = F.col("flips") == 0
    # Inside one node, the child with the smaller digit is the first side of a crossing.
    side = F.when(own & (F.col("mask") != 0), (digit > digit.bitwiseXOR(F.col("mask"))).cast("int")).otherwise(F.col("side"))
    return dealt.select(
        "fp", "value", "turn", side.alias("side"), F.shiftleft("flips", STEP).bitwiseOR(F.col("mask")).alias("flips")
    )


def _walk(frame: DataFrame, budget: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["turn", "node", "flips"], 200_000):
            value, fp = table["value"].to_numpy().view(np.uint64), table["fp"].to_numpy()
            flips, side = table["flips"].to_numpy(), table["side"].to_numpy()
            keys = [table[name].to_numpy() for name in ("turn", "node", "flips")]
            group = np.cumsum(np.r_[False, np.any([k[1:] != k[:-1] for k in keys], axis=0)])
            depth = int(table["depth"][0].as_py()) if len(table) else 0
            crossed = np.bitwise_count(flips.view(np.uint64)).astype(np.int64)
            x, y = trie_pairs(value, group, side, crossed, depth, budget)
            places, first = np.unique(fp, return_inverse=True)
            x, y = forest(first[x], first[y])
            yield pa.RecordBatch.from_arrays([pa.array(places[x], pa.int64()), pa.array(places[y], pa.int64())], names=["a", "b"])

    order = ["turn", "node", "flips", "side", "value"]
    # Unsigned order of the values is the order of the trie.
    unsigned = F.col("value").bitwiseXOR(F.lit(NO_ID))
    sorted_rows = (
        frame.repartition("turn", "node", "flips")
        .sortWithinPartitions(*order[:4], unsigned)
        .select("fp", *order, "depth")
    )
    return sorted_rows.mapInArrow(run, "a long, b long")


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[pa.Table]:
    """Tables of about ``rows`` sorted rows that never cut a group of equal ``keys``."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        count += len(batch)
        if count < rows:
            continue
        table = pa.Table.from_batches(held)
        last = np.ones(len(table), bool)
        for key in keys:
            column = table[key].to_numpy()
            last &= column == column[-1]
        cut = int(np.flatnonzero(~last)[-1]) + 1 if (~last).any() else 0
        if cut:
            yield table.slice(0, cut).combine_chunks()
        held = table.slice(cut).combine_chunks().to_batches()
        count = len(table) - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for nodes with an edge, by alternating stars.

    Every round links each node's larger neighbours, then its smaller ones, to its smallest
    neighbour; paths of length n end after about log(n) rounds. Rounds are written, so a lost
    executor repeats one round only. Nodes are compared as signed numbers.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(lowest, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u != v")
        large = large.distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lowest, "u").select(
            F.explode(F.array(F.struct("u", F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e")
        ).select("e.u", "e.v").filter("u != v")
        after = written(small.distinct())
        # A forest of stars, each node below one root that has no edge of its own, stays as it is.
        done = after.exceptAll(edges).isEmpty() and edges.exceptAll(after).isEmpty()
        discard(edges)
        if done:
            return after.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = after


def near_duplicates(docs: DataFrame, shingle: int = 3, budget: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) for every row: the smallest doc_id reachable over linked fingerprints.

    Rows with equal fingerprints share a component. Null ids count as the smallest id and give a
    null component; texts without words have fingerprint 0 and are linked like any others.
    """
    return cluster(written(fingerprints(docs, shingle)), budget)


def cluster(prints: DataFrame, budget: int = 2) -> DataFrame:
    own = F.coalesce(F.col("doc_id"), F.lit(NO_ID))
    table = roots(prints.select("fp", own.alias("own")), budget)
    smallest = table.groupBy("root").agg(F.min("first").alias("component_id"))
    named = table.join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", F.expr(f"nullif(component_id, {NO_ID})").alias("component_id"))


def roots(owned: DataFrame, budget: int) -> DataFrame:
    """(fp, first, root) of (fp, own): the smallest owner of each fingerprint, and its component."""
    distinct = written(owned.groupBy("fp").agg(F.min("own").alias("first")))
    linked = written(components(links(distinct, budget)))
    return distinct.join(linked, distinct["fp"] == linked["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def one_of_each(docs: DataFrame, shingle: int = 3, budget: int = 2) -> DataFrame:
    """Of each group of near copies, as ``near_duplicates`` finds them, one row of ``docs`` with all its columns.

    The row with the smallest (doc_id, text hash) of a component stays, a null id counting as the
    smallest; of equal rows one stays, and rows that share only their id are told apart. Null text is
    empty; all texts without words are one group. An empty table stays empty. Columns may have any
    names. Texts are read for their fingerprints, and moved once for the rows that stay.
    """
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("own")
    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(text, shingle) for text in batch["text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64), pa.int64()), batch["own"], batch["text_hash"]], names=["fp", "own", "text_hash"])

    rows = texts(docs, own, text_hash).select("text", "own", "text_hash")
    prints = rows.mapInArrow(run, "fp long, own long, text_hash long")
    table = roots(prints.select("fp", F.struct("own", "text_hash").alias("own")), budget)
    firsts = table.groupBy("root").agg(F.min("first").alias("first")).select("first.own", "first.text_hash")
    # The caller's row travels as one value, so that no name of ours meets one of theirs.
    keyed = docs.select(own, text_hash, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    turn = F.row_number().over(Window.partitionBy("own", "text_hash").orderBy(F.lit(0))).alias("turn")
    kept = keyed.join(firsts, ["own", "text_hash"], "left_semi").select("row", turn)
    return kept.filter("turn = 1").select("row.*")


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
