"""Order-dependent building blocks that keep hot groups spread over tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palaver.session import ensure_checkpoint_dir

# monotonically_increasing_id keeps the partition above bit 33 and the position below.
_POSITION_BITS = 33


def top_per_group(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    limit: int,
    rank: str = "rank",
    salt_on: str | None = None,
    salts: int = 64,
) -> DataFrame:
    """First ``limit`` rows of each group in ``order``, numbered from 1.

    Spark prunes small limits before the shuffle. For a large limit name a ``salt_on``
    column: groups are first cut in salted parts, so that no task sorts a whole hot group and
    the last step sees at most ``salts * limit`` rows of it. The result is the same.
    """
    if salt_on is not None:
        salted = frame.withColumn("_salt", F.pmod(F.xxhash64(salt_on), F.lit(salts)))
        part = Window.partitionBy(*keys, "_salt").orderBy(*order)
        frame = (
            salted.withColumn("_rank", F.row_number().over(part))
            .filter(F.col("_rank") <= limit)
            .drop("_salt", "_rank")
        )
    group = Window.partitionBy(*keys).orderBy(*order)
    return frame.withColumn(rank, F.row_number().over(group)).filter(F.col(rank) <= limit)


def materialise(frame: DataFrame) -> DataFrame:
    """A written copy in the shared checkpoint folder, for a small result used several times."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffle files as they end, not when the driver happens to collect garbage.

    For a pass over large rows of which only a written copy is used later, once.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def freeze_sorted(frame: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Globally sorted rows in contiguous ranges, written once to the shared checkpoint folder.

    Each range is one partition, numbered ``_block`` in sort order. ``order`` must be total.
    The written copy makes every later use see the same ranges, also after a lost executor.
    ``frame`` should be narrow: it is written before it is sorted as well, so that finding the
    range borders does not compute it a second time.
    """
    return (
        materialise(frame)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_block", F.spark_partition_id())
        .checkpoint()
    )


def salted_join(
    left: DataFrame, right: DataFrame, key: str, salt_on: str, how: str = "inner", salts: int = 16
) -> DataFrame:
    """Join a side with hot keys to a narrow one: the rows of a key are dealt to ``salts`` tasks.

    The right side is copied that often, so it should be small beside the left.
    """
    dealt = left.withColumn("_salt", F.pmod(F.xxhash64(salt_on), F.lit(salts)))
    every = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    copies = right.withColumn("_salt", F.explode(every))
    return dealt.join(copies, [key, "_salt"], how).drop("_salt")


def segments(frame: DataFrame, key: str, order: Sequence[Column | str]) -> tuple[DataFrame, DataFrame]:
    """Rows sorted by key and order in blocks, and one row for the borders of each block.

    A window per key gathers a hot key in one task. Here a key may span any number of blocks: a window
    over ``_block`` and key sees the rows of one block, and what enters it from the blocks before follows
    from the borders alone. ``_pos`` is the place inside a block.
    """
    frozen = freeze_sorted(frame, [key, *order]).withColumn(
        "_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    )
    borders = frozen.groupBy("_block").agg(
        F.min_by(F.struct(key), "_pos").getField(key).alias("_first"),
        F.max_by(F.struct(*frame.columns), "_pos").alias("_last"),
    )
    return frozen, borders


def number_rows(frame: DataFrame, order: Sequence[Column | str], name: str = "row_no") -> DataFrame:
    """Exact global row number from 0 without moving the rows into one partition.

    Only the row counts of the ranges, one row per partition, meet in a single window.
    """
    frozen = freeze_sorted(frame, order).withColumn(
        "_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    )
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        frozen.groupBy("_block")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        frozen.join(F.broadcast(offsets), "_block")
        .withColumn(name, F.col("_offset") + F.col("_pos"))
        .drop("_block", "_pos", "_offset")
    )
