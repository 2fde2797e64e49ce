"""Document fingerprints by winnowing: the smallest k-gram hash of every window, with its place.

Any two texts that share a substring of at least window + k - 1 characters share a fingerprint;
of equal hashes in a window the rightmost is taken. Places are kept, so a match can be shown.

To compare a document with the next one, rows are dealt to ranges of neighbouring ids and read as
sorted streams: each text moves once, and a task holds two texts. The first document of every range
travels to the range before it as well, so a range needs nothing of the others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import NO_ID, Rolling, mixed, sliding_min, texts, written

GRAM = 20
WINDOW = 61
#: Characters that one numpy step takes.
STEP = 1 << 18
#: Bytes of text of an average range, and the most ranges (then ranges are longer streams).
RANGE_BYTES, RANGES = 1 << 20, 200_000

_FACTOR = 0x9E3779B97F4A7C15


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class _Grams(Rolling):
    """Rolling hashes over characters: their numbers, spread, stand for the byte codes."""

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(mixed((data.astype(np.uint64) + np.uint64(1)) * np.uint64(_FACTOR)) * self.up[: len(data)], out=out[1:])
        return out


_ROLL = _Grams(seed=3)


def winnow(codes: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the chosen k-grams, by place. Texts shorter than a k-gram give one hash.

    Texts with fewer k-grams than a window give their smallest.
    """
    if len(codes) < gram:
        if not len(codes):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        sums = _ROLL.sums(codes)
        return _ROLL.between(sums, np.array([0]), np.array([len(codes)])), np.zeros(1, np.int64)
    hashes, places = [], []
    last = -1
    for at in range(0, len(codes) - gram + 1, STEP):
        part = codes[at : at + STEP + window + gram - 2]
        values = _ROLL.grams(_ROLL.sums(part), gram)
        if at and len(values) < window:
            break  # the windows that end here are those of the step before
        # Upper bits of the hash, then the place counted down: the minimum is the rightmost smallest.
        low = np.uint64((1 << 20) - 1)
        ranked = (values & ~low) | (low - np.arange(len(values), dtype=np.uint64))
        best = sliding_min(ranked, min(window, len(values)))
        place = (low - (best & low)).astype(np.int64)
        place = place[np.r_[True, place[1:] != place[:-1]]]
        place = place[place + at > last]
        if len(place):
            last = int(place[-1]) + at
            hashes.append(values[place])
            places.append(place + at)
    return np.concatenate(hashes), np.concatenate(places)


def printed(hashes: np.ndarray, places: np.ndarray) -> str:
    """``hash@place`` of every chosen k-gram: 12 hexadecimal digits of the hash and the place, by place."""
    return " ".join([f"{h:012x}@{p}" for h, p in zip((hashes >> np.uint64(16)).tolist(), places.tolist(), strict=True)])


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """Jaccard similarity of the sets of hashes; two empty ones are alike."""
    if not len(left) and not len(right):
        return 1.0
    a, b = np.unique(left), np.unique(right)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def read(doc_id: int | None, text: str) -> tuple:
    """A document as ``compared`` takes it: id, characters and fingerprint."""
    codes = _codes(text)
    return doc_id, codes, winnow(codes)


def compared(document: tuple, following: tuple) -> tuple:
    """The row of a document whose next document is ``following``."""
    doc_id, codes, own = document
    _, after, other = following
    half = len(codes) // 2
    # The last floor(n/2) characters give way to the first as many of the next document, or all it has.
    edited = np.concatenate([codes[: len(codes) - half], after[:half]])
    changed = winnow(edited)
    spelled = edited.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    return (
        doc_id, len(codes), hashlib.sha256(spelled).hexdigest(), printed(*own), printed(*changed),
        likeness(own[0], changed[0]), likeness(own[0], other[0]),
    )


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_NAMES = [part.split()[0] for part in RESULT.split(", ")]


def _borders(keys: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(id, lead of the text) with which every range begins, in order.

    Results do not depend on where ranges begin. One key of a range's worth is chosen by its hash, and the
    smallest key; at most about ``RANGES`` narrow rows reach the driver.
    """
    total = keys.agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes"), F.min(F.struct("id", "lead")).alias("least")).first()
    if not total["rows"]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ranges = min(RANGES, max(1, (total["bytes"] or 0) // RANGE_BYTES))
    every = max(1, total["rows"] // ranges)
    begins = keys.filter(F.pmod(F.xxhash64("id", "lead"), F.lit(every)) == 0).select("id", "lead").distinct()
    chosen = {(row["id"], row["lead"]) for row in begins.collect()} | {tuple(total["least"])}
    found = np.array(sorted(chosen), np.int64)
    return found[:, 0], found[:, 1]


DEALT = "doc_id long, text string, id long, lead long, range long, ahead boolean"
DEALT_NAMES = [part.split()[0] for part in DEALT.split(", ")]


def _deal(ids: np.ndarray, leads: np.ndarray):
    """Give every row its range; rows that may be the first of a range also go ``ahead`` to the one before.

    A task sends such a row only if its text is smaller than those it sent for that range.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[int, str] = {}
        for batch in batches:
            own, lead = batch["id"].to_numpy(), batch["lead"].to_numpy()
            low, high = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
            place, begins = low - 1, []
            for row in np.flatnonzero(high > low).tolist():
                at = int(low[row] + np.searchsorted(leads[low[row] : high[row]], lead[row], "right")) - 1
                place[row] = at
                if at >= low[row] and leads[at] == lead[row]:
                    text = batch["text"][row].as_py()
                    if at not in sent or text < sent[at]:
                        sent[at] = text
                        begins.append(row)
            names = DEALT_NAMES
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64()), pa.array(np.zeros(len(batch), bool))], names=names)
            if begins:
                first = batch.take(pa.array(begins))
                before = (place[begins] - 1) % len(ids)
                yield pa.RecordBatch.from_arrays([*first.columns, pa.array(before, pa.int64()), pa.array(np.ones(len(begins), bool))], names=names)

    return run


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each row of a range with the next; the row sent ahead by the next range ends it."""
    place: int | None = None
    held: tuple | None = None
    for batch in batches:
        for at in range(0, len(batch), 500):
            part, found = batch.slice(at, 500), []
            columns = [part[name].to_pylist() for name in ("range", "ahead", "doc_id", "text")]
            for number, ahead, doc_id, text in zip(*columns, strict=True):
                if number == place and held is None:
                    continue  # the range has ended: of the rows sent ahead, the first one counts
                row = read(doc_id, text)
                if number == place:
                    found.append(compared(held, row))
                place, held = number, None if ahead else row
            table = zip(*found, strict=True) if found else [[] for _ in _KINDS]
            yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(table, _KINDS, strict=True)], names=_NAMES)


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and their likeness.

    The next document follows in (doc_id, text) order, null ids first; the last is followed by the
    first, a single document by itself. Null text is empty; empty texts have an empty fingerprint.
    """
    keyed = texts(docs, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"))
    # The first bytes of a text as a number, in the order of texts: they split the rows of one id.
    lead = F.conv(F.rpad(F.hex(F.substring(F.col("text").cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long")
    keyed = keyed.withColumn("lead", lead)
    ids, leads = _borders(written(keyed.select("id", "lead", F.octet_length("text").cast("long").alias("bytes"))))
    dealt = keyed.mapInArrow(_deal(ids, leads), DEALT).repartition("range")
    ordered = dealt.sortWithinPartitions("range", "ahead", "id", "text").select("range", "ahead", "doc_id", "text")
    return ordered.mapInArrow(_stream, RESULT)
