"""Best-fit packing of documents into token sequences, certified by dual-feasible bounds.

Only (piece, length) rows move. Every partition packs its pieces by best-fit decreasing and
compares its sequence count with a lower bound from dual-feasible functions. Sequences of a
partition that meets its bound stay as they are. A partition with a gap, and the open sequences
of every partition (those that are not full), give their pieces to an exchange: fewer, larger
partitions pack them again, until nothing is gained or one partition is left. As only the
partially filled sequences are exchanged, the last round is small at any input size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import kept_by_worker, texts, written

CAPACITY = 2048
#: Pieces that one packing task takes; memory of a task is about 100 bytes a piece.
PIECES_PER_TASK = 25_000
#: Words of one generation of a worker's memory, which holds two. Results do not depend on it.
MEMORY_WORDS = 400_000

#: ASCII marks but the apostrophe.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Token ids of words, remembered by a worker for as long as they fit.

    The tokenizer drops white space and never joins characters across it, so the ids of a text
    are those of its words in order.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # A full generation becomes the older one; what is still met there moves to the new one.
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.specials = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def encode(self, values: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, then id 0."""
        return [b"".join((ids, b"\0\0\0\0")) for at in range(0, len(values), 64) for ids in self._rows(values[at : at + 64])]

    def _rows(self, values: list[str]) -> list[bytes]:
        if len(self.known) > MEMORY_WORDS:
            self.known, self.older = {}, self.known
        rows = [value.encode().split() for value in values]
        found = [list(map(self.known.get, row)) for row in rows]
        holes = [[i for i, ids in enumerate(one) if ids is None] if None in one else [] for one in found]
        fresh = {row[i] for row, empty in zip(rows, holes, strict=True) for i in empty}
        if fresh:
            self._learn(fresh)
            for row, one, empty in zip(rows, found, holes, strict=True):
                for i in empty:
                    one[i] = self.known[row[i]]
        return list(map(b"".join, found))

    def _learn(self, fresh: set[bytes]) -> None:
        """Give all ``fresh`` words their ids.

        A word is marks, letters, marks; each run is encoded by itself. Apostrophes may join what follows.
        """
        known, older = self.known, self.older
        parts: list[tuple[bytes, bytes, bytes, bytes]] = []
        others: set[bytes] = set()
        asked: set[bytes] = set()
        for word in fresh:
            if (ids := older.get(word)) is not None:
                known[word] = ids
                continue
            text = word.decode()
            stem = text.strip(MARKS)
            plain = stem.isascii()
            # Lowering may take a letter to something else.
            if not stem.isalpha() or not (plain or stem.lower().isalpha()) or any(special in text for special in self.specials):
                others.add(word)
                continue
            low = stem.encode()
            at = word.index(low)
            before, after = word[:at], word[at + len(low) :]
            if plain:
                low = low.lower()
            parts.append((word, before, low, after))
            asked.add(low)
            if before:
                others.add(before)
            if after:
                others.add(after)
        known |= self._lines([low for low in asked if low not in known])
        known |= self._each([word for word in others if word not in known])
        for word, before, low, after in parts:
            ids = known[low]
            if before:
                ids = known[before] + ids
            known[word] = ids + known[after] if after else ids

    def _lines(self, plain: list[bytes]) -> dict[bytes, bytes]:
        """Words of letters, many to a line: each ends with the only token that closes a word."""
        lines = [plain[at : at + 64] for at in range(0, len(plain), 64)]
        coded = self.tokenizer.encode_batch_fast([b" ".join(line).decode() for line in lines], add_special_tokens=False)
        found: dict[bytes, bytes] = {}
        for line, one in zip(lines, coded, strict=True):
            ids = np.array(one.ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(line):
                found |= self._each(line)
                continue
            data, at = ids.tobytes(), 0
            for word, cut in zip(line, (4 * cuts).tolist(), strict=True):
                found[word] = data[at:cut]
                at = cut
        return found

    def _each(self, words: list[bytes]) -> dict[bytes, bytes]:
        coded = self.tokenizer.encode_batch_fast([word.decode() for word in words], add_special_tokens=False)
        return {word: np.array(one.ids, "<u4").tobytes() for word, one in zip(words, coded, strict=True)}


def packed_ids(values: list[str], path: str) -> list[bytes]:
    """Token ids of each text as little-endian 32-bit numbers, then id 0."""
    return kept_by_worker("word ids", path, lambda: WordIds(path)).encode(values)


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Documents as pieces of at most ``capacity`` tokens; only longer documents are cut."""
    width = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            texts_of = (
                item
                for part in (batch.slice(at, 256) for at in range(0, len(batch), 256))
                for item in zip(part["doc_id"].to_pylist(), packed_ids(part["text"].to_pylist(), path), strict=True)
            )
            for doc_id, ids in texts_of:
                for piece, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
                if rows
                else [pa.array([], kind) for kind in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return texts(docs).mapInArrow(cut, PIECES)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Least number of bins, by the best of two families of dual-feasible functions and the volume.

    A function f is dual feasible if numbers that sum to at most 1 have values that sum to at
    most 1; then the sum of f over all items bounds the bins from below.
    """
    if len(lengths) == 0:
        return 0
    sizes, counts = np.unique(lengths, return_counts=True)
    best = -(-int((sizes * counts).sum()) // capacity)
    # f_e: items over capacity - e count whole, those below e count nothing, others by their size.
    for least in np.unique(np.minimum(sizes, capacity - sizes)):
        if 0 < least <= capacity // 2:
            big = sizes > capacity - least
            rest = (sizes >= least) & ~big
            total = int(counts[big].sum()) * capacity + int((sizes * counts)[rest].sum())
            best = max(best, -(-total // capacity))
    # u_k: x(k+1) whole stays x, else floor((k+1)x)/k; in whole numbers over k * capacity.
    for k in range(1, 33):
        scaled = sizes * (k + 1)
        value = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item: longest first, into the fullest bin that still takes it.

    Bins are kept by their free space, and a bit mask finds the least space that is enough.
    """
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces = 0
    opened = 0
    for item in order:
        size = int(lengths[item])
        fitting = spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            chosen = free[space].pop()
            if not free[space]:
                spaces &= ~(1 << space)
        else:
            space, chosen = capacity, opened
            opened += 1
        bins[item] = chosen
        left = space - size
        if left:
            free[left].append(chosen)
            spaces |= 1 << left
    return bins


def _pack(capacity: int):
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        # The order of the rows decides ties, so it is fixed by their content.
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable", na_position="first")
        lengths = group["length"].to_numpy(np.int64)
        bins = best_fit_decreasing(lengths, capacity)
        count = int(bins.max()) + 1
        filled = np.bincount(bins, lengths, count).astype(np.int64)
        before = np.cumsum(lengths) - lengths  # offsets: running length inside a bin, in row order
        by_bin = np.argsort(bins, kind="stable")
        running = np.cumsum(lengths[by_bin]) - lengths[by_bin]
        first = np.r_[True, bins[by_bin][1:] != bins[by_bin][:-1]]
        base = np.maximum.accumulate(np.where(first, running, 0))
        before[by_bin] = running - base
        certified = count == lower_bound(lengths, capacity)
        spare = filled < capacity
        if certified and spare.any():  # optimal by itself: only its emptiest sequence may still be merged
            spare &= np.arange(count) == int(np.argmin(filled))
        return group.assign(bin=bins, offset=before, filled=filled[bins], open=spare[bins], certified=certified)

    return pack


PACKED = f"{PIECES}, part long, round int, bin long, offset long, filled long, open boolean, certified boolean"


def pack(parts: DataFrame, capacity: int = CAPACITY, pieces_per_task: int = PIECES_PER_TASK, rounds: int = 12) -> DataFrame:
    """Place pieces (``PIECES``) in sequences of ``capacity`` tokens: adds sequence_id and offset.

    Null ids, equal rows and pieces without tokens are packed like any others. An empty table
    gives an empty one. Sequence ids are any distinct numbers; offsets have no gaps. ``rounds``
    bounds the exchanges; every piece is placed after any number of them.
    """
    whole = parts.filter(F.col("length") >= capacity)
    pending = parts.filter(F.col("length") < capacity)
    partitions = max(1, -(-pending.count() // pieces_per_task))
    done: list[DataFrame] = []
    for level in range(rounds):
        packed = written(
            pending.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(level)), F.lit(partitions)))
            .withColumn("round", F.lit(level))
            .groupBy("part")
            .applyInPandas(_pack(capacity), PACKED)
        )
        left, bins, bound = _open_figures(packed.filter("open"), capacity)
        # One partition has nobody to exchange with; a met bound cannot be beaten.
        if partitions == 1 or bins == bound or level == rounds - 1:
            done.append(packed)
            break
        done.append(packed.filter(~F.col("open")))
        pending = packed.filter("open").select(*parts.columns)
        partitions = max(1, -(-left // pieces_per_task))
    # Distinct numbers without a global sort: round, partition and bin side by side; whole pieces below zero.
    number = (F.col("round") * F.lit(1 << 56) + F.col("part") * F.lit(1 << 32) + F.col("bin")).cast("long")
    alone = (-F.lit(1) - F.monotonically_increasing_id()).alias("sequence_id")
    placed = whole.select(*parts.columns, alone, F.lit(0).cast("long").alias("offset"))
    for frame in done:
        placed = placed.unionByName(frame.select(*parts.columns, number.alias("sequence_id"), "offset"))
    return placed


def _open_figures(opened: DataFrame, capacity: int) -> tuple[int, int, int]:
    """Pieces and bins that are open, and the volume bound on their bins."""
    row = opened.groupBy("part", "bin").agg(F.count(F.lit(1)).alias("n"), F.max("filled").alias("filled")).agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum("filled"), F.lit(0))
    ).first()
    return int(row[0]), int(row[1]), -(-int(row[2]) // capacity)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, **options: int) -> DataFrame:
    """Tokenize documents and pack all of them; see :func:`pack`. A null text is the single id 0."""
    return pack(written(token_pieces(docs, path or tokenizer_path(), capacity)), capacity, **options)
