"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of one to three characters by language on Spark; the table of
log-probabilities has a row for each hash bucket and one column a language, and it is broadcast. There are
``BUCKETS`` buckets, fewer with so many languages that the table would be above ``TABLE_BYTES``; training
rows are bounded, and with them the languages. Scoring is sparse: a text looks up the rows of its own
n-grams and adds them, in numpy, piece by piece.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import fold, texts

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
#: Labelled documents that training reads at most, chosen by a hash of their id.
TRAIN_ROWS = 20_000
#: Characters that one numpy step takes.
STEP = 1 << 18
#: Size of the broadcast table, and the fewest buckets: with more than 16,384 languages the table grows
#: beyond it, to 80 MB at most for ``TRAIN_ROWS`` languages.
TABLE_BYTES = 64 << 20
LEAST_BUCKETS = 1 << 10
SMOOTHING = 0.5

UNKNOWN = "und"
_MAYBE_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether a character is a letter (Unicode category L); fractions, circled numbers and the like are none."""
    return any(found.group().isalpha() for found in _MAYBE_LETTER.finditer(text))


def buckets_for(languages: int) -> int:
    """A power of two that keeps the table of so many languages in ``TABLE_BYTES``."""
    size = BUCKETS
    while size > LEAST_BUCKETS and 4 * size * languages > TABLE_BYTES:
        size //= 2
    return size


def buckets(text: str, size: int = BUCKETS) -> Iterator[np.ndarray]:
    """Hash buckets of all n-grams of the lower-cased text, a step at a time."""
    longest = max(ORDERS)
    for at in range(0, len(text), STEP):
        part = text[at : at + STEP + longest - 1].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        own = min(len(codes), STEP) if len(text) > at + STEP else len(codes)
        value = np.zeros(len(codes), np.uint64)
        for order in range(1, longest + 1):
            value = value[: len(codes) - order + 1] * np.uint64(0x100000001B3) + codes[order - 1 :]
            if order in ORDERS:
                spread = (value[:own] + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
                yield (spread >> np.uint64(48)).astype(np.int64) % size


def counts(labelled: DataFrame, size: int = BUCKETS) -> DataFrame:
    """(lang, bucket, n) over (text, lang) rows; batches are counted before anything moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), strict=True):
                total = sums.setdefault(lang, np.zeros(size, np.int64))
                for found in buckets(text, size):
                    total += np.bincount(found, minlength=size)
            for lang, total in sums.items():
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at])], names=["lang", "bucket", "n"])

    return labelled.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, smoothing: float = SMOOTHING) -> tuple[list[str], np.ndarray]:
    """Languages in order, and float32 log-probabilities [bucket, language]."""
    languages = sorted(row.lang for row in labelled.select("lang").distinct().collect())
    size = buckets_for(len(languages))
    if not languages:
        return languages, np.zeros((size, 0), np.float32)
    rows = counts(labelled, size).toArrow()  # at most one row for each cell of the table
    table = np.full((size, len(languages)), smoothing)
    place = {lang: i for i, lang in enumerate(languages)}
    column = np.array([place[lang] for lang in rows["lang"].to_pylist()], np.int64)
    np.add.at(table, (rows["bucket"].to_numpy(), column), rows["n"].to_numpy())
    return languages, np.log(table / table.sum(axis=0, keepdims=True)).astype(np.float32)


def predict(text: str, languages: list[str], table: np.ndarray) -> tuple[str, float]:
    """Most likely language of the whole text and its probability, under equal priors."""
    if not languages or not has_letter(text):
        return UNKNOWN, 0.0
    total = np.zeros(len(languages))
    for found in buckets(text, len(table)):
        seen = np.bincount(found, minlength=0)
        at = np.flatnonzero(seen)
        total += seen[at] @ table[at].astype(float) if len(at) < len(found) else table[found].sum(axis=0, dtype=float)
    best = int(np.argmax(total))
    return languages[best], float(1.0 / np.exp(np.minimum(total - total[best], 0)).sum())


def identify(docs: DataFrame, folds: int = 3, held: int = 1, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row.

    The model learns from text and non-null lang of rows whose fold is not ``held`` (a null id has the
    fold of the empty text), at most ``train_rows`` of them. Null text and texts without a letter
    are ``und`` with score 0, as is everything if no row has a language. Repeated rows count, and are
    answered, each. An empty table gives an empty one; further columns are left out, whatever their names.
    """
    place = F.xxhash64(F.col("doc_id").cast("string"), F.col("text"))
    labelled = (
        texts(docs, F.col("lang").cast("string").alias("lang"))
        .filter(F.col("lang").isNotNull() & (F.col("text") != "") & (fold("doc_id", folds) != held))
    )
    # The bound as a share of the hash range needs one count and no sort.
    rows = docs.filter(F.col("lang").isNotNull()).count()
    if rows > train_rows:
        labelled = labelled.filter(F.pmod(place, F.lit(1_000_000)) < int(1_000_000 * train_rows / rows))
    model = docs.sparkSession.sparkContext.broadcast(train(labelled.select("text", "lang")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, table = model.value
        for batch in batches:
            told = [predict(text, languages, table) for text in batch["text"].to_pylist()]
            lang, score = zip(*told, strict=True) if told else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"]
            )

    inputs = texts(docs, (fold("doc_id", folds) == held).alias("held_out"))
    return inputs.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
