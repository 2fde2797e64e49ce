"""Text search by an inverted index of character trigrams.

The index has one row for each trigram of each message, in lower case, sorted by trigram inside the
message folders, so a lookup reads the few row groups that hold its trigrams. A message can only
match a pattern if it has all trigrams of the pattern's literal parts. ``ILIKE`` is then tested on those
messages alone, so the rows found are the same with and without an index.

Signatures are the smaller index: one bit set per message, a bit for each of its trigrams. All are read
in a lookup, which the postings spare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.functions.text import like_pattern
from palaver.operators.ordering import materialise

GRAM_CHARS = 3
GRAMS = "gram string, message_id long"
_EVERY_GRAM = rf"(?s)(?=(.{{{GRAM_CHARS}}}))"


def _grams(lowered: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(lowered, F.lit(_EVERY_GRAM), F.lit(1)))


def postings(messages: DataFrame) -> DataFrame:
    """``gram``, ``message_id``: the distinct trigrams of every message, deleted ones included."""
    return messages.select(F.explode(_grams(F.lower("content"))).alias("gram"), "message_id")


def literal_parts(pattern: str) -> list[str]:
    """The text between the wildcards of a LIKE pattern."""
    parts, current, i = [], [], 0
    while i < len(pattern):
        if pattern[i] == "\\" and i + 1 < len(pattern):
            i += 1
            current.append(pattern[i])
        elif pattern[i] in "%_":
            parts.append("".join(current))
            current = []
        else:
            current.append(pattern[i])
        i += 1
    return [*parts, "".join(current)]


def pattern_grams(spark: SparkSession, term: str) -> list[str]:
    """Trigrams that every text matching the term has; none if all literal parts are too short.

    Case is folded by the engine's own function, over the whole pattern, as ``ILIKE`` does.
    """
    lowered = spark.range(1).select(F.lower(F.lit(like_pattern(term)))).first()[0]
    return sorted(
        {
            part[i : i + GRAM_CHARS]
            for part in literal_parts(lowered)
            for i in range(len(part) - GRAM_CHARS + 1)
        }
    )


def candidate_ids(index: DataFrame, grams: list[str]) -> DataFrame:
    """Ids of the messages that have all the trigrams. The filter reaches the scan of the index."""
    return (
        index.filter(F.col("gram").isin(grams))
        .groupBy("message_id")
        .agg(F.count(F.lit(1)).alias("found"))
        .filter(F.col("found") == len(grams))
        .select("message_id")
    )


def chosen_messages(messages: DataFrame, index: DataFrame, term: str) -> DataFrame:
    """The messages that may match the term by the index; all if the term has no trigram."""
    grams = pattern_grams(messages.sparkSession, term)
    if not grams:
        return messages
    return messages.join(candidate_ids(index, grams), "message_id", "left_semi")


# --- signatures ------------------------------------------------------------------------------

SIGNATURE_BITS = 2048
SIGNATURES = "message_id long, signature array<long>"
_ROWS_AT_ONCE = 256


def _gram_bits(points: np.ndarray) -> np.ndarray:
    """The signature bit of the trigram that begins at each code point but the last two."""
    a, b, c = (points[i : len(points) - 2 + i].astype(np.uint64) for i in range(GRAM_CHARS))
    mixed = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (c * np.uint64(0x165667B19E3779F9))
    mixed ^= mixed >> np.uint64(32)
    return (mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - SIGNATURE_BITS.bit_length() + 1)


def _points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = SIGNATURE_BITS // 64
    for batch in batches:
        for begin in range(0, batch.num_rows, _ROWS_AT_ONCE):
            rows = batch.slice(begin, _ROWS_AT_ONCE)
            texts = rows.column("lowered").to_pylist()
            lengths = np.array([len(text) for text in texts])
            bits = np.zeros((len(texts), SIGNATURE_BITS), dtype=bool)
            if lengths.sum() >= GRAM_CHARS:
                row = np.repeat(np.arange(len(texts)), lengths)
                own = row[: 1 - GRAM_CHARS] == row[GRAM_CHARS - 1 :]  # no trigram spans two texts
                bits[row[: 1 - GRAM_CHARS][own], _gram_bits(_points(texts))[own]] = True
            packed = np.packbits(bits, axis=1, bitorder="little").view(np.int64).ravel()
            offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * words)
            signatures = pa.ListArray.from_arrays(offsets, pa.array(packed))
            yield pa.RecordBatch.from_arrays([rows.column("message_id"), signatures], ["message_id", "signature"])


def signatures(messages: DataFrame) -> DataFrame:
    """``message_id``, ``signature``: one bit for each trigram of a message, set in ``SIGNATURE_BITS``.

    A row for each message with a text, of the same size whatever the text: for texts read once or seldom
    it is far smaller than the postings, which have a row for each trigram.
    """
    lowered = messages.filter(F.col("content").isNotNull()).select("message_id", F.lower("content").alias("lowered"))
    return lowered.mapInArrow(_sign, SIGNATURES)


def signed_ids(index: DataFrame, grams: list[str]) -> DataFrame:
    """``message_id``, ``rows``: the ids of which a row has the bits of all the trigrams, and how many rows they have."""
    signed = F.lit(True)
    for bit in sorted({int(_gram_bits(_points([gram]))[0]) for gram in grams}):
        signed = signed & (F.getbit(F.col("signature")[bit // 64], F.lit(bit % 64)) == 1)
    rows = index.select("message_id", signed.alias("signed")).groupBy("message_id")
    return rows.agg(F.max("signed").alias("signed"), F.count(F.lit(1)).alias("rows")).filter("signed").drop("signed")


def chosen_by_signature(messages: DataFrame, index: DataFrame, term: str) -> DataFrame:
    """The messages that may match the term by their signatures; all if the term has no trigram.

    An id of several rows is chosen as the postings choose it, which are worked out for such ids alone.
    """
    grams = pattern_grams(messages.sparkSession, term)
    if not grams:
        return messages
    signed = materialise(signed_ids(index, grams))
    ids, repeated = signed.filter("rows = 1").select("message_id"), signed.filter("rows > 1")
    if not repeated.isEmpty():
        rows = messages.join(repeated, "message_id", "left_semi")
        ids = ids.unionByName(candidate_ids(postings(rows), grams))
    return messages.join(ids, "message_id", "left_semi")
