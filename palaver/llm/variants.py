"""Spelling variants by Bloom-guided neighbourhoods.

Every word of the vocabulary generates the hashes of its edits and probes them against blocked
Bloom filters of the vocabulary, one filter per word length. Most edits are no words and end
there; what a filter lets through moves as (edit, word) to an exact join with the vocabulary, which
removes the false positives.

* Two words are near from both sides, so half of the edits will do: every deletion, and every
  replacement by a later letter. Each near pair is then found exactly once.
* The hash of an edit follows from the hash of its word by one term, for all places and letters at
  once in numpy. A text is only built for the edits that a filter lets through.
* A filter has blocks of 512 bits, one bit in each of eight 64-bit words, about 32 bits a key: about one
  false positive in a hundred thousand probes. All filters that are broadcast at once take at most
  ``FILTER_BYTES``; a larger vocabulary is probed in rounds, each with the slice of the blocks that
  fits, so that the broadcast is bounded whatever the vocabulary.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import kept_by_worker, mixed, texts, written

#: Letters of a run, lower case as words hold them: the alphabet of edits.
LOWER = "abcdefghijklmnopqrstuvwxyz"
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))
RUN = "[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A share of one in ``SLIPS`` (document, run) pairs loses a letter before words are counted.
SLIPS = 31
#: A form has at least so many times the count of its variant.
MARGIN = 10

#: Bytes of all filters broadcast at once, and bytes of filter for each word.
FILTER_BYTES = 32 << 20
BYTES_PER_WORD = 4
_BLOCK = 8  # 64-bit words in a block
#: Edits probed at a time by one task.
PROBES = 1 << 21
#: Words that one task probes.
WORDS_PER_TASK = 20_000
#: Distinct words a task counts before it hands them on.
HELD_WORDS = 400_000

WORD_COUNTS = "word string, n long"


def _count_runs(least: int, slips: int):
    long_run = re.compile(f"{RUN}{{{least},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
            )
            held.clear()
            return out

        def add(runs: Counter[str], salt: int) -> None:
            for run, n in runs.items():
                h = zlib.crc32(run.encode(), salt)
                if h % slips == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < least:
                        continue
                held[run] += n

        for batch in batches:
            for low in range(0, len(batch), 64):
                part = batch.slice(low, 64)
                for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                    salt = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    # bytes.lower() touches A-Z alone.
                    text = text.encode().lower().decode()
                    if len(text) < 1 << 22:
                        add(Counter(long_run.findall(text)), salt)
                    else:  # a very long text: its distinct runs are held, not all of them
                        add(Counter(found.group() for found in long_run.finditer(text)), salt)
                    if len(held) >= HELD_WORDS:
                        yield flush()
        if held:
            yield flush()

    return count


def vocabulary(docs: DataFrame, least: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, slips: int = SLIPS) -> DataFrame:
    """(word, n): the long words of all texts. Each task counts before anything moves."""
    # A run shorter than the least length cannot become a word, with or without a slip.
    counted = texts(docs).mapInArrow(_count_runs(least, slips), WORD_COUNTS)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# --- hashes of words and edits -----------------------------------------------------------------


class _Hash:
    """Sum of letter codes times powers of an odd base, over code points; never mixed here."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self.codes = np.zeros(256, np.uint64)
        points = [ord(letter) for letter in LETTERS]
        self.codes[points] = np.random.default_rng(11).integers(1, 2**64, len(points), dtype=np.uint64)
        self.up = np.ones(1, np.uint64)

    def powers(self, size: int) -> np.ndarray:
        if len(self.up) < size:
            steps = np.full(max(size, 64), self.BASE, np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps)
        return self.up[:size]

    def words(self, letters: np.ndarray) -> np.ndarray:
        """Hash of each row of a matrix of code points."""
        return (self.codes[letters] * self.powers(letters.shape[1])).sum(axis=1, dtype=np.uint64)


HASH = _Hash()


def _place(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each hash, and the bits that choose a place in each of its words."""
    spread = mixed(hashes)
    return ((spread >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32), mixed(spread ^ np.uint64(0x5851F42D4C957F2D))


def _bit(chooser: np.ndarray, word: int) -> np.ndarray:
    return np.uint64(1) << ((chooser >> np.uint64(6 * word)) & np.uint64(63))


def _matrix(words: list[str]) -> np.ndarray:
    """Code points of words of one length; every letter is below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def filter_blocks(words: int) -> int:
    """Blocks of the filter for so many words."""
    return max(1, -(-words * BYTES_PER_WORD // (8 * _BLOCK)))


class Filters:
    """Slices of blocked filters: for a length, the blocks from ``low`` on, of ``blocks`` in all."""

    def __init__(self, slices: dict[int, tuple[int, int, bytes]]) -> None:
        self.slices = {
            length: (blocks, low, np.frombuffer(data, np.uint64)) for length, (blocks, low, data) in slices.items()
        }

    def maybe(self, length: int, hashes: np.ndarray) -> np.ndarray:
        """Indexes of the hashes that a word of this length, in the slice held, may have."""
        if length not in self.slices:
            return np.zeros(0, np.int64)
        blocks, low, bits = self.slices[length]
        block, chooser = _place(hashes, blocks)
        at = (block - np.uint64(low)).astype(np.int64)  # below the slice: wraps to a negative number
        left = np.flatnonzero((at >= 0) & (at < len(bits) // _BLOCK))
        at, chooser = at[left] * _BLOCK, chooser[left]
        for word in range(_BLOCK):
            bit = _bit(chooser, word)
            hit = np.flatnonzero(bits[at + word] & bit == bit)
            left, at, chooser = left[hit], at[hit], chooser[hit]
        return left


def _set_bits(blocks_of: dict[int, int]):
    """(length, block, eight words) of each block that words of a batch fall into, or-ed per batch."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array(batch["word"].to_pylist(), object)
            lengths = np.array([len(word) for word in values], np.int64)
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for length in np.unique(lengths):
                hashes = _hash_all(values[lengths == length].tolist())
                block, chooser = _place(hashes, blocks_of[int(length)])
                order = np.argsort(block, kind="stable")
                block, chooser = block[order], chooser[order]
                first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
                bits = np.stack([np.bitwise_or.reduceat(_bit(chooser, word), first) for word in range(_BLOCK)], axis=1)
                out.append((np.full(len(first), length, np.int64), block[first].astype(np.int64), bits.view(np.int64)))
            if out:
                length, block, bits = (np.concatenate(part) for part in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(length.astype(np.int32)), pa.array(block), *(pa.array(bits[:, i].copy()) for i in range(_BLOCK))],
                    names=["length", "block", *(f"w{i}" for i in range(_BLOCK))],
                )

    return rows


def _hash_all(words: list[str]) -> np.ndarray:
    """Hashes of words of one length, in parts of bounded size."""
    step = max(1, PROBES // max(1, len(words[0])))
    return np.concatenate([HASH.words(_matrix(words[at : at + step])) for at in range(0, len(words), step)])


def rounds_of(counts: dict[int, int], filter_bytes: int = FILTER_BYTES) -> list[dict[int, tuple[int, int]]]:
    """Blocks [low, high) of each length in every round; each round takes at most ``filter_bytes``."""
    room = max(1, filter_bytes // (8 * _BLOCK))
    rounds: list[dict[int, tuple[int, int]]] = [{}]
    left = room
    for length in sorted(counts):
        low, blocks = 0, filter_blocks(counts[length])
        while low < blocks:
            if not left:
                rounds.append({})
                left = room
            high = min(blocks, low + left)
            rounds[-1][length] = low, high
            left -= high - low
            low = high
    return rounds


def _collect_filters(bits: DataFrame, blocks_of: dict[int, int], chosen: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int, bytes]]:
    """The slice of the filters that one round broadcasts; its size is bounded by ``rounds_of``."""
    test = F.lit(False)
    for length, (low, high) in chosen.items():
        test = test | ((F.col("length") == length) & F.col("block").between(low, high - 1))
    found = bits.filter(test).toArrow()
    lengths, block = found["length"].to_numpy(), found["block"].to_numpy()
    words = np.stack([found[f"w{i}"].to_numpy() for i in range(_BLOCK)], axis=1).view(np.uint64)
    slices = {}
    for length, (low, high) in chosen.items():
        data = np.zeros((high - low, _BLOCK), np.uint64)
        own = lengths == length
        data[block[own] - low] = words[own]
        slices[length] = blocks_of[length], low, data.tobytes()
    return slices


# --- probing ---------------------------------------------------------------------------------

CANDIDATES = "edit string, word string, n long"


def _edits_found(words: list[str], filters: Filters) -> Iterator[tuple[int, str]]:
    """(index of the word, edit) for each deletion and each replacement by a later letter that a filter lets through."""
    length = len(words[0])
    alphabet = np.array([ord(letter) for letter in LETTERS], np.uint8)
    codes = HASH.codes[alphabet]
    powers = HASH.powers(length)
    down = np.uint64(pow(_Hash.BASE, -1, 2**64))
    per_word = max(1, PROBES // (length * len(alphabet)))
    for low in range(0, len(words), per_word):
        part = words[low : low + per_word]
        letters = _matrix(part)
        terms = HASH.codes[letters] * powers
        whole = terms.sum(axis=1, dtype=np.uint64)
        if length - 1 in filters.slices:
            before = np.cumsum(terms, axis=1, dtype=np.uint64)
            # Letters behind a deleted one move a place to the front: one power less.
            hashes = (before - terms) + (whole[:, None] - before) * down
            # Deleting any letter of a run of equal letters gives the same edit: only its first is taken.
            first = np.ones(letters.shape, bool)
            first[:, 1:] = letters[:, 1:] != letters[:, :-1]
            at = np.flatnonzero(first)
            for hit in at[filters.maybe(length - 1, hashes.ravel()[at])]:
                row, place = divmod(int(hit), length)
                word = part[row]
                yield low + row, word[:place] + word[place + 1 :]
        if length in filters.slices:
            step = max(1, PROBES // (len(part) * len(alphabet)))
            for begin in range(0, length, step):
                old = letters[:, begin : begin + step]
                rest = whole[:, None] - terms[:, begin : begin + step]
                hashes = rest[:, :, None] + codes[None, None, :] * powers[None, begin : begin + step, None]
                at = np.flatnonzero(alphabet[None, None, :] > old[:, :, None])
                for hit in at[filters.maybe(length, hashes.ravel()[at])]:
                    cell, letter = divmod(int(hit), len(alphabet))
                    row, place = divmod(cell, old.shape[1])
                    word = part[row]
                    yield low + row, word[: begin + place] + LETTERS[letter] + word[begin + place + 1 :]


def _probe(shared):
    key = uuid.uuid4().hex  # workers outlive a job, so a filter is known by its own name

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = kept_by_worker("variant filters", key, lambda: Filters(shared.value))
        for batch in batches:
            values = np.array(batch["word"].to_pylist(), object)
            counts = batch["n"].to_numpy()
            lengths = np.array([len(word) for word in values], np.int64)
            edits: list[str] = []
            whose: list[int] = []
            size = 0
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                for index, edit in _edits_found(values[own].tolist(), filters):
                    edits.append(edit)
                    whose.append(int(own[index]))
                    size += 2 * len(edit)
                    if size > 8 << 20:  # edits of very long words go out early
                        yield _candidates(edits, values, counts, whose)
                        edits, whose, size = [], [], 0
            yield _candidates(edits, values, counts, whose)

    return probe


def _candidates(edits: list[str], words: np.ndarray, counts: np.ndarray, whose: list[int]) -> pa.RecordBatch:
    at = np.array(whose, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(edits, pa.string()), pa.array(words[at].tolist(), pa.string()), pa.array(counts[at], pa.int64())],
        names=["edit", "word", "n"],
    )


def near_pairs(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, other, other_n): every pair of near words once. ``words`` is a written (word, n) table."""
    counts = {int(r[0]): int(r[1]) for r in words.groupBy(F.length("word")).count().collect()}
    blocks_of = {length: filter_blocks(n) for length, n in counts.items()}
    bits = words.select("word").mapInArrow(
        _set_bits(blocks_of), "length int, block long, " + ", ".join(f"w{i} long" for i in range(_BLOCK))
    )
    bits = bits.groupBy("length", "block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(_BLOCK)))
    rounds = rounds_of(counts, filter_bytes)
    if len(rounds) > 1:
        bits = written(bits)
    context = words.sparkSession.sparkContext
    # Words are dealt anew: the aggregation may leave them in few tasks.
    dealt = words.repartition(max(context.defaultParallelism, -(-sum(counts.values()) // WORDS_PER_TASK)), "word")
    found = None
    for chosen in rounds:
        shared = context.broadcast(_collect_filters(bits, blocks_of, chosen) if counts else {})
        part = dealt.mapInArrow(_probe(shared), CANDIDATES)
        if len(rounds) > 1:
            part = written(part)
            shared.unpersist()
        found = part if found is None else found.unionByName(part)
    exact = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    return found.join(exact, F.col("edit") == F.col("other")).select("word", "n", "other", "other_n")


# --- forms and roots -------------------------------------------------------------------------


def _roots(forms: DataFrame, most: int, margin: int) -> DataFrame:
    """(word, root) of the words that have a form, by doubling.

    A form has ``margin`` times the count, so a chain has at most log(most) steps to that base, and so
    many doublings reach its end.
    """
    steps = 1
    while LEAST_COUNT * margin**steps < most:
        steps += 1
    links = written(forms.select("word", F.col("form").alias("root")))
    for _ in range(max(0, (steps - 1).bit_length())):
        on = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        links = written(links.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")))
    return links


def group_variants(words: DataFrame, margin: int = MARGIN, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n) with distinct words of ``LETTERS``.

    A word's form is its near word of the largest count, the smallest of equals, if that count is
    at least ``margin`` times its own; its root is the end of its chain of forms.
    """
    words = written(words.select("word", "n"))
    pairs = written(near_pairs(words, filter_bytes))
    both = pairs.unionByName(
        pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    )
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"), F.first("n").alias("own"))
    strong = -F.col("best.less") >= F.lit(margin) * F.col("own")
    near = written(
        near.select(
            "word",
            "n_near",
            F.when(strong, F.col("best.form")).alias("form"),
            F.when(strong, -F.col("best.less")).alias("form_n"),
        )
    )
    most = words.agg(F.max("n")).first()[0] or 0
    roots = _roots(near.filter(F.col("form").isNotNull()), int(most), margin)
    return (
        words.join(near, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form_n",
        )
    )


def spelling_variants(docs: DataFrame, **options: int) -> DataFrame:
    """Spelling variants among the long words of all documents; see :func:`group_variants`.

    A null text has no words; a null id counts as the empty text before the colon. Repeated rows
    count each. No documents, or none with a word that occurs twice, give an empty table. Further
    columns are left out, whatever their names. A run of any length is a word like any other: its edits
    are probed a stretch at a time.
    """
    return group_variants(vocabulary(docs), **options)
