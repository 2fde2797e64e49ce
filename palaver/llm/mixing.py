"""Mixing sources to target weights by balanced sampling with the cube method.

A source whose target is r times its size takes every document floor(r) times, and once more
with probability frac(r). The extra copies are chosen by the cube method: the vector of inclusion
probabilities moves inside the unit cube along directions that leave the expected number of
documents and of words unchanged, until almost every entry is 0 or 1. With two constraints, at
most two documents of a block stay fractional. Blocks run in parallel; their fractional
documents meet in fewer blocks and move on, until at most two per source remain: the landing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm.common import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
#: Documents of one source that one flight takes.
BLOCK = 4096


def word_count(text: Column | str) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    Sources in code point order, null last, take the weights in turn. Targets add up to ``share``
    of all sizes; none is above ``most`` times its source. Sharing an excess by weight until none
    is above ends where every free source has the same target per weight: sources reach
    their limit in the order of limit per weight, which running sums find without a loop.
    One row per source meets in these windows, never a document.
    """
    named = F.when(F.col("source").isNull(), 1).otherwise(0)
    turn = F.row_number().over(Window.orderBy(named, F.col("source").cast("binary"))) - 1
    picked = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(turn, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.select("source", "source_size", picked.alias("weight")).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ladder = Window.orderBy(F.col("limit") / F.col("weight"), named, F.col("source").cast("binary"))
    before = ladder.rowsBetween(Window.unboundedPreceding, -1)
    steps = (
        ranked.withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("full", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("free", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("free"))
        .withColumn("stuck", F.col("level") * F.col("weight") > F.col("limit"))
    )
    # The first source that stays below its limit sets the level of all later ones.
    level = F.first(F.when(~F.col("stuck"), F.col("level")), ignorenulls=True).over(
        ladder.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return steps.select(
        "source", "source_size", F.least(F.col("limit"), F.coalesce(level * F.col("weight"), F.col("limit"))).alias("target")
    )


def flight(chance: np.ndarray, sizes: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Move ``chance`` until at most two entries are strictly between 0 and 1.

    Sum of chances and of chances times sizes stay as they are (up to rounding). Three fractional
    documents at a time have a direction in the null space of the two constraints; the step ends
    where one of them becomes 0 or 1. ``draws`` decide between the two ends.
    """
    out = chance.copy()
    held: list[int] = []
    for item in np.flatnonzero((chance > 0) & (chance < 1)):
        held.append(int(item))
        if len(held) < 3:
            continue
        a, b, c = held
        x, y, z = sizes[a], sizes[b], sizes[c]
        along = np.array([y - z, z - x, x - y], float)
        if not along.any():
            along = np.array([1.0, -1.0, 0.0])  # equal sizes: move one against another
        now = out[held]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(along > 0, (1 - now) / along, np.where(along < 0, -now / along, np.inf)).min()
            down = np.where(along > 0, now / along, np.where(along < 0, (now - 1) / along, np.inf)).min()
        step = up if draws[item] * (up + down) < down else -down
        moved = now + step * along
        moved[moved < 1e-9] = 0.0
        moved[moved > 1 - 1e-9] = 1.0
        out[held] = moved
        held = [i for i in held if 0 < out[i] < 1]
        if len(held) == 3:  # rounding kept all three inside: settle the nearest
            near = min(held, key=lambda i: min(out[i], 1 - out[i]))
            out[near] = round(out[near])
            held.remove(near)
    return out


STATE = "doc_id long, source string, size long, text_key long, copies long, chance double"


def _fly(group: pd.DataFrame) -> pd.DataFrame:
    # Content decides the order, so reruns agree; equal rows are interchangeable.
    group = group.sort_values(["draw", "doc_id", "text_key", "size"], kind="stable", na_position="first")
    draws = (group["draw"].to_numpy(np.int64).view(np.uint64) >> np.uint64(11)).astype(float) / 2.0**53
    moved = flight(group["chance"].to_numpy(float), group["size"].to_numpy(float), draws)
    group["copies"] += (moved >= 1).astype(np.int64)
    group["chance"] = np.where(moved >= 1, 0.0, moved)
    return group[["doc_id", "source", "size", "text_key", "copies", "chance"]]


def choose_copies(sized: DataFrame, targets: DataFrame, block: int = BLOCK, seed: int = 1) -> DataFrame:
    """``STATE`` plus source_size and target: whole copies of each document, and the chance left at landing.

    At most two documents of a source keep a chance between 0 and 1.
    """
    rates = targets.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    pending = sized.join(rates, sized["source"].eqNullSafe(rates["source"])).select(
        sized["doc_id"], sized["source"], "size", "text_key",
        F.floor("rate").cast("long").alias("copies"),
        F.when(F.col("size") > 0, F.col("rate") - F.floor("rate")).otherwise(F.lit(0.0)).alias("chance"),
    )
    settled: list[DataFrame] = []
    level = 0
    while True:
        # Blocks by content: each source is dealt over as many as its documents need.
        counts = pending.groupBy("source").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(block))).cast("long").alias("blocks"))
        draw = F.xxhash64("doc_id", "text_key", F.lit(seed), F.lit(level))
        dealt = (
            pending.withColumn("draw", draw).alias("p").join(counts.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")))
            .select("p.*", "blocks", F.pmod(F.xxhash64("draw"), F.col("blocks")).alias("block"))
        )
        flown = written(dealt.groupBy("source", "block").applyInPandas(_fly, STATE))
        most = flown.filter(_fractional()).groupBy(F.col("source")).count().agg(F.max("count")).first()[0] or 0
        if most <= 2:
            settled.append(flown)
            break
        settled.append(flown.filter(~_fractional()))
        pending = flown.filter(_fractional())
        level += 1
    out = settled[0]
    for frame in settled[1:]:
        out = out.unionByName(frame)
    return out.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))).select("s.*", "source_size", "target")


def _fractional() -> Column:
    return (F.col("chance") > 0) & (F.col("chance") < 1)


def sized_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, text_key): one narrow row per document."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"),
        F.xxhash64(F.col("text").cast("string")).alias("text_key"),
    )


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, whole: bool = False, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, source, size, text_key, source_size, target, copies, taken.

    ``taken`` counts words, repeats included. Landing: the at most two fractional documents of a
    source give the words of their chance, so the source meets its target to a word. With
    ``whole=True`` documents are never split, and the landing takes a document if its
    chance is at least one half. Null text has size 0; a document without words is never
    repeated for its own sake. Null source is a source of its own. Equal rows are all kept.
    """
    sized = written(sized_documents(docs))
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    state = choose_copies(sized, written(targets), block)
    copies = F.col("copies") + (F.when(F.col("chance") >= 0.5, 1).otherwise(0) if whole else F.lit(0))
    part = F.lit(0) if whole else F.round(F.col("chance") * F.col("size"))
    return state.select(
        "doc_id", "source", "size", "text_key", "source_size", "target",
        copies.cast("long").alias("copies"), (copies * F.col("size") + part).cast("long").alias("taken"),
    )


def repeated(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (not at all, once or more), with all their columns.

    Documents are never split. Equal rows (id, source and text) share their number of copies evenly, in whole
    copies: such rows are interchangeable, so the first of them are repeated once more. Null ids, sources
    and texts are values like any other; a document without words is taken as its source's share
    says. An empty table stays empty. Columns may have any names.
    """
    taken = (
        mix(docs, weights, share, most, whole=True)
        .groupBy("doc_id", "source", "text_key")
        .agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
        .select(F.col("doc_id").alias("taken_id"), F.col("source").alias("taken_source"), F.col("text_key").alias("taken_key"), "copies", "rows")
    )
    # The caller's row travels as one value, so that no name of ours meets one of theirs.
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64(F.col("text").cast("string")).alias("text_key"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("taken_id")) & F.col("source").eqNullSafe(F.col("taken_source")) & (F.col("text_key") == F.col("taken_key"))
    # Sum of copies over equal rows = whole copies per row, and one more for the first of them.
    order = Window.partitionBy("taken_id", "taken_source", "taken_key").orderBy("taken_key")
    turn = F.when(F.col("rows") > 1, F.row_number().over(order)).otherwise(1)
    each = F.floor(F.col("copies") / F.col("rows")) + (turn <= F.col("copies") % F.col("rows")).cast("int")
    counted = keyed.join(taken, same).select("row", each.cast("int").alias("each")).filter("each > 0")
    return counted.select("row", F.explode(F.sequence(F.lit(1), F.col("each")))).select("row.*")
