"""Language model scoring by context-tree weighting over bytes.

A text is its bytes and an end. Each of these symbols is nine binary decisions: whether the text ends,
and if not, the bits of the byte. For each decision (the bits of the symbol decided so far) there
is a context tree whose depth-d nodes are the last d bytes, d = 0 to ``DEPTH``; before a text stand zero
bytes. A node with a zeros and b ones has the Krichevsky-Trofimov estimate Pe(a, b); its weighted
probability is Pw = (Pe + product of its children's Pw) / 2, and Pe at full depth. So every node has a
posterior weight for stopping there, Pe / (2 Pw), and a decision's probability mixes the estimates
(b + 1/2) / (a + b + 1) of all depths on its path by those weights. A path ends at the last
node that training has seen. The probabilities of all texts add up to at most one.

The nodes are exact and grow with the corpus; no task holds the tree:

1. Symbols with their contexts (grams) are counted in batches and summed by Spark, for training and in all.
2. Grams are dealt by the last two bytes of their context and sorted by it, so that every subtree from
   depth three on is a run of neighbouring rows. One pass weighs the nodes from depth five up to two.
3. Depths one and zero have at most 65,792 nodes; Spark sums them and every task gets them.
4. A second pass over the same runs walks every distinct gram down its path: its code length.
5. Texts look their grams up: the most frequent ones, at most ``TABLE`` of them, in a broadcast table; the
   others of a text are counted, move, and join their code lengths.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.common import buffer, discard, fold, kept_by_worker, pieces, texts, written
from palaver.llm.simhash import whole_groups

DEPTH = 5
#: Bytes that one numpy step takes.
STEP = 1 << 19
#: Distinct grams that a task merges before it hands them on.
MERGE = 1 << 21
#: Rows that a task hands on at once; the worker and its executor both hold them.
OUT = 1 << 16
#: Rows of the sorted grams that a task works on at a time; a subtree of depth three stays whole.
ROWS = 50_000
#: Grams whose code lengths every task holds; 24 bytes each in a worker.
TABLE = 1_500_000
#: Most frequent training words whose counts every task holds; other words are joined.
WORDS = 150_000
#: Longer words are known by their digest, so a word takes no more than this.
WORD_BYTES = 64
#: The end of a text among the tokens. A word never holds a space.
END = b" "

#: A gram is five context bytes, the nearest one on top, and the symbol in nine bits.
SYMBOL = 9
_END_SYMBOL = 256
_MIX = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.uint64(2**64 - 1)


# --- grams -------------------------------------------------------------------------------------------


def text_grams(data: np.ndarray, offsets: np.ndarray, depth: int = DEPTH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, gram) of every byte and every end, in steps."""
    empty = np.flatnonzero(np.diff(offsets) == 0)
    if len(empty):
        yield empty, np.full(len(empty), _END_SYMBOL, np.uint64)
    for row, begin, end in pieces(offsets, STEP):
        size = end - begin
        last = end == offsets[row + 1]
        # Each part stands behind its context, and before its end if it is a text's last part.
        start = np.cumsum(size + DEPTH + last) - (size + DEPTH + last)
        flat = np.zeros(int(start[-1] + size[-1] + DEPTH + last[-1]), np.uint64)
        own = np.arange(int(end[-1] - begin[0])) + np.repeat(start + DEPTH - (begin - begin[0]), size)
        flat[own] = data[begin[0] : end[-1]]
        for part in np.flatnonzero(begin > offsets[row]):
            back = min(DEPTH, int(begin[part] - offsets[row[part]]))
            flat[start[part] + DEPTH - back : start[part] + DEPTH] = data[begin[part] - back : begin[part]]
        ends = (start + DEPTH + size)[last]
        flat[ends] = _END_SYMBOL
        gram = flat.copy()
        for back in range(1, depth + 1):
            gram[back:] |= flat[:-back] << np.uint64(SYMBOL + 8 * (DEPTH - back))
        yield np.concatenate([np.repeat(row, size), row[last]]), np.concatenate([gram[own], gram[ends]])


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sums of all runs. ``held`` is emptied, so that no array stays longer than it is needed."""
    key, n = (np.concatenate(column) for column in zip(*held, strict=True))
    held.clear()
    order = np.argsort(key, kind="stable")  # a merge of runs that are sorted already
    key = key[order]
    n = n[order]
    del order
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(n, first)


def _count(depth: int):
    """(gram, n, n_all) of a task's texts, merged as far as ``MERGE`` grams go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def rows() -> Iterator[pa.RecordBatch]:
            every, times = _merged(held)
            for at in range(0, len(every), OUT):
                key, n = every[at : at + OUT], times[at : at + OUT]
                train = np.where(key & np.uint64(1) == 0, n, 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((key >> np.uint64(1)).view(np.int64)), pa.array(train), pa.array(n)], names=["gram", "n", "n_all"]
                )

        for batch in batches:
            data, offsets = buffer(batch["text"])
            aside = batch["held_out"].to_numpy(zero_copy_only=False).astype(np.uint64)
            for row, gram in text_grams(data, offsets, depth):
                held.append(np.unique((gram << np.uint64(1)) | aside[row], return_counts=True))
                if sum(len(k) for k, _ in held) > MERGE:
                    held.append(_merged(held))
                    if 2 * len(held[0][0]) > MERGE:
                        yield from rows()
        if held:
            yield from rows()

    return run


def counted_grams(named: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(part, gram, n, n_all): how often training and all texts have each gram; ``part`` is the last two context bytes."""

    counted = named.select("text", "held_out").mapInArrow(_count(depth), "gram long, n long, n_all long")
    part = F.shiftrightunsigned("gram", SYMBOL + 8 * (DEPTH - 2)).cast("int").alias("part")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("n_all").alias("n_all")).select(part, "gram", "n", "n_all")


# --- nodes --------------------------------------------------------------------------------------------


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of a string with these counts."""
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - _lgamma(zeros + ones + 1.0) - np.log(np.pi)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x >= 0.5: Stirling's series from 8 on, stepped down below."""
    shift = np.zeros_like(x)
    value = x.astype(float).copy()
    for _ in range(8):
        low = value < 8
        shift[low] += np.log(value[low])
        value[low] += 1
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * value**2)) / value**2) / value**2) / value
    return (value - 0.5) * np.log(value) - value + 0.5 * np.log(2 * np.pi) + series - shift


class Nodes:
    """The nodes of one depth: key (context, decision), estimate of a one, weight of stopping here."""

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, split: np.ndarray | None) -> None:
        self.key, self.zeros, self.ones = key, zeros, ones
        own = log_estimate(zeros.astype(float), ones.astype(float))
        if split is None:
            self.total, self.weight = own, np.ones(len(key))
        else:
            self.total = np.logaddexp(own, split) - np.log(2)
            self.weight = np.exp(own - np.log(2) - self.total)
        self.one = (ones + 0.5) / (zeros + ones + 1.0)

    def shorter(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(key, zeros, ones, split) with the farthest context byte left out, summed."""
        key = ((self.key >> np.uint64(16)) << np.uint64(8)) | (self.key & np.uint64(255))
        return summed(key, self.zeros, self.ones, self.total)


def summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    key, back = np.unique(key, return_inverse=True)
    return key, *(np.bincount(back, value, len(key)) for value in values)


def decisions(symbol: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, decision, bit) for each of the nine decisions: 0 is whether the text ends, then 1 to 255."""
    end = symbol == _END_SYMBOL
    yield np.arange(len(symbol)), np.zeros(len(symbol), np.uint64), end
    rows = np.flatnonzero(~end)
    byte = symbol[rows]
    for place in range(8):
        decided = (np.uint64(1) << np.uint64(place)) | (byte >> np.uint64(8 - place))
        yield rows, decided, (byte >> np.uint64(7 - place)) & np.uint64(1) == 1


def subtrees(gram: np.ndarray, n: np.ndarray, depth: int) -> list[Nodes]:
    """Nodes of depth 3 to ``depth`` over training grams, index 0 being depth 3. Context bytes are read nearest first."""
    seen = n > 0
    gram, n = gram[seen], n[seen]
    symbol, context = gram & np.uint64(511), gram >> np.uint64(SYMBOL + 8 * (DEPTH - depth))
    keys, counts = [], []
    for rows, decided, bit in decisions(symbol):
        keys.append((context[rows] << np.uint64(8)) | decided)
        counts.append((np.where(bit, 0, n[rows]), np.where(bit, n[rows], 0)))
    zeros, ones = (np.concatenate(part) for part in zip(*counts, strict=True))
    level = Nodes(*summed(np.concatenate(keys), zeros, ones), None)
    levels = [level]
    while len(levels) < depth - 2:
        level = Nodes(*level.shorter())
        levels.insert(0, level)
    return levels


_SECOND = "part int, decision int, zeros double, ones double, total double, one double, weight double"


def _weigh(depth: int):
    """Depth-two nodes of sorted grams: the sums of their subtrees, which may come in several tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.uint64), *(np.zeros(0) for _ in range(3)))
        for table in whole_groups(batches, ["third"], ROWS):
            gram, n = table["gram"].to_numpy().view(np.uint64), table["n"].to_numpy()
            level = subtrees(gram, n, depth)[0]
            held = summed(*(np.concatenate(pair) for pair in zip(held, level.shorter(), strict=True)))
            now = np.uint64(int(table["part"][-1].as_py()))
            done = held[0] >> np.uint64(8) != now
            yield _second(tuple(a[done] for a in held))
            held = tuple(a[~done] for a in held)
        yield _second(held)

    return run


def _second(held: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    nodes = Nodes(*held)
    part, decision = (nodes.key >> np.uint64(8)).astype(np.int32), (nodes.key & np.uint64(255)).astype(np.int32)
    columns = [part, decision, *(np.asarray(a, float) for a in (nodes.zeros, nodes.ones, nodes.total, nodes.one, nodes.weight))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[f.split()[0] for f in _SECOND.split(", ")])


class Upper:
    """Depths zero and one as dense arrays; an estimate below zero was never seen."""

    def __init__(self, second: DataFrame) -> None:
        sums = [F.sum(c).alias(c) for c in ("zeros", "ones", "total")]
        nearest = F.shiftright("part", 8)
        first = second.groupBy(nearest.alias("byte"), "decision").agg(*sums).toArrow()  # at most 65,536 rows
        byte, decision = first["byte"].to_numpy(), first["decision"].to_numpy()
        key = (byte.astype(np.uint64) << np.uint64(8)) | decision.astype(np.uint64)
        order = np.argsort(key)
        one = Nodes(*(a[order] for a in (key, *(first[c].to_numpy() for c in ("zeros", "ones", "total")))))
        root = Nodes(*summed(one.key & np.uint64(255), one.zeros, one.ones, one.total))
        self.levels = []
        for nodes, size in ((root, 256), (one, 65_536)):
            estimate, weight = np.full(size, -1.0), np.ones(size)
            estimate[nodes.key.astype(np.int64)], weight[nodes.key.astype(np.int64)] = nodes.one, nodes.weight
            self.levels.append((estimate, weight))


def code_lengths(gram: np.ndarray, levels: list[Nodes], second: Nodes, upper: list[tuple[np.ndarray, np.ndarray]], depth: int) -> np.ndarray:
    """Log10 probability of each gram's symbol after its context."""
    symbol = gram & np.uint64(511)
    out = np.zeros(len(gram))
    for rows, decided, bit in decisions(symbol):
        mix, met = np.full(len(rows), 0.5), np.zeros(len(rows), bool)
        for d in range(depth, -1, -1):
            key = ((gram[rows] >> np.uint64(SYMBOL + 8 * (DEPTH - d))) << np.uint64(8)) | decided
            if d < 2:
                one, weight = (a[key.astype(np.int64)] for a in upper[d])
                seen = one >= 0
            else:
                nodes = levels[d - 3] if d > 2 else second
                if not len(nodes.key):
                    continue
                at = np.minimum(np.searchsorted(nodes.key, key), len(nodes.key) - 1)
                one, weight, seen = nodes.one[at], nodes.weight[at], nodes.key[at] == key
            # The deepest node seen stops for certain; above it the weights mix.
            mix = np.where(seen, np.where(met, weight * one + (1 - weight) * mix, one), mix)
            met |= seen
        out[rows] += np.log10(np.where(bit, mix, 1 - mix))
    return out


class _Plain:
    """Nodes that are weighed already."""

    def __init__(self, key: np.ndarray, one: np.ndarray, weight: np.ndarray) -> None:
        order = np.argsort(key)
        self.key, self.one, self.weight = key[order], one[order], weight[order]


def _measure(depth: int, upper: list[tuple[np.ndarray, np.ndarray]]):
    """Code lengths of sorted grams. The depth-two nodes of a part stand before its grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near: dict[int, tuple[np.ndarray, ...]] = {}

        def grams() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                is_node = batch["nodes"].is_valid().to_numpy(zero_copy_only=False)
                for row in np.flatnonzero(is_node).tolist():
                    data = np.frombuffer(batch["nodes"][row].as_py(), np.float64).reshape(3, -1)
                    near[batch["part"][row].as_py()] = tuple(data)
                yield batch.filter(pa.array(~is_node)).drop_columns(["nodes"])

        for table in whole_groups(grams(), ["third"], ROWS):
            gram, n = table["gram"].to_numpy().view(np.uint64), table["n"].to_numpy()
            part = table["part"].to_numpy()
            found = [(np.uint64(p << 8) | near[p][0].astype(np.uint64), *near[p][1:]) for p in np.unique(part).tolist() if p in near]
            empty = (np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
            second = _Plain(*(np.concatenate(c) for c in zip(empty, *found, strict=True)))
            length = code_lengths(gram, subtrees(gram, n, depth), second, upper, depth)
            yield pa.RecordBatch.from_arrays(
                [table["gram"].combine_chunks(), table["n_all"].combine_chunks(), pa.array(length.astype(np.float32))],
                names=["gram", "n_all", "length"],
            )
            for p in [p for p in near if p < part[-1]]:
                del near[p]

    return run


def fit(named: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram, n_all, length): the code length of every distinct gram of all texts, learned from those not held out."""
    counted = written(counted_grams(named, depth))
    third = F.shiftrightunsigned("gram", SYMBOL + 8 * (DEPTH - 3)).alias("third")
    rows = counted.select("part", third, "gram", "n", "n_all")
    in_order = rows.filter("n > 0").repartition("part").sortWithinPartitions("part", "gram")
    second = written(in_order.mapInArrow(_weigh(depth), _SECOND))
    upper = Upper(second).levels

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [np.array(row, float).tobytes() for row in zip(*(batch[c].to_pylist() for c in ("decision", "one", "weight")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["part"], pa.array(data, pa.binary())], names=["part", "nodes"])

    # At most 256 decisions to a part.
    lists = second.groupBy("part").agg(
        F.array_sort(F.collect_list(F.struct("decision", "one", "weight"))).alias("all")
    ).select("part", F.col("all.decision").cast("array<double>").alias("decision"), F.col("all.one").alias("one"), F.col("all.weight").alias("weight"))
    nodes = lists.mapInArrow(packed, "part int, nodes binary")
    together = rows.unionByName(nodes, allowMissingColumns=True)
    walked = together.repartition("part").sortWithinPartitions("part", F.asc_nulls_first("gram"))
    lengths = written(walked.mapInArrow(_measure(depth, upper), "gram long, n_all long, length float"))
    discard(counted, second)
    return lengths


# --- lookup --------------------------------------------------------------------------------------------


class Lengths:
    """Code lengths of frequent grams in an open hash table."""

    def __init__(self, gram: np.ndarray, length: np.ndarray) -> None:
        self.bits = max(8, int(2 * len(gram)).bit_length())
        size = 1 << self.bits
        self.key, self.length = np.full(size, _NONE, np.uint64), np.zeros(size, np.float32)
        for low in range(0, len(gram), OUT):
            self._add(gram[low : low + OUT], length[low : low + OUT])

    def _add(self, gram: np.ndarray, length: np.ndarray) -> None:
        left, at = np.arange(len(gram)), self._at(gram)
        while len(left):
            free = self.key[at] == _NONE
            # Of several grams at one free place the first takes it; the others go one on.
            _, first = np.unique(at, return_index=True)
            takes = np.zeros(len(left), bool)
            takes[first] = free[first]
            self.key[at[takes]], self.length[at[takes]] = gram[left[takes]], length[left[takes]]
            left, at = left[~takes], (at[~takes] + 1) & (len(self.key) - 1)

    def _at(self, gram: np.ndarray) -> np.ndarray:
        return (gram * _MIX >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, gram: np.ndarray) -> np.ndarray:
        """Lengths, NaN for grams that are not in the table."""
        at = self._at(gram)
        key = self.key[at]
        out = self.length[at]
        left = np.flatnonzero(key != gram)
        while len(left):
            gone = self.key[at[left]] == _NONE
            out[left[gone]] = np.nan
            left = left[~gone]
            at[left] = (at[left] + 1) & (len(self.key) - 1)
            hit = self.key[at[left]] == gram[left]
            out[left[hit]] = self.length[at[left[hit]]]
            left = left[~hit]
        return out


def usual(rows: DataFrame, count: str, most: int) -> DataFrame:
    """The rows of the greatest counts: as many whole classes as fit ``most``.

    A count below 1,024 is a class of its own, above it each power of two is one. So at most ``most`` rows ever
    come to the driver, whatever the number of rows or partitions.
    """
    n = F.col(count)
    level = F.when(n < 1024, n).otherwise(F.lit(1014) + F.floor(F.log2(n)))
    least, total = None, 0
    for value, size in sorted(((r[0], r[1]) for r in rows.groupBy(level).count().collect()), reverse=True):
        total += size
        if total > most:
            break
        least = value
    return rows.filter(F.lit(False) if least is None else level >= least)


def frequent(lengths: DataFrame, most: int = TABLE) -> tuple[np.ndarray, np.ndarray]:
    """Grams and code lengths of the most frequent grams."""
    found = usual(lengths, "n_all", most).select("gram", "length").toArrow()
    return found["gram"].to_numpy().view(np.uint64), found["length"].to_numpy()


def tokens(text: str) -> list[bytes]:
    """Words with A-Z lowered."""
    return text.encode().lower().split()


def short(word: bytes) -> bytes:
    """The word, or a space and its digest if it is longer than ``WORD_BYTES``; no word holds a space."""
    return word if len(word) <= WORD_BYTES else b" " + hashlib.blake2b(word, digest_size=16).digest()


def counted_words(train: DataFrame) -> DataFrame:
    """(word, n) over all training tokens; the end token is :data:`END`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for low in range(0, len(batch), 64):
                for text in batch["text"].slice(low, 64).to_pylist():
                    seen.update(tokens(text))
                    seen[END] += 1
                    if len(seen) > 300_000:
                        yield _word_rows(seen)
                        seen.clear()
        if seen:
            yield _word_rows(seen)

    return train.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _word_rows(seen: Counter) -> pa.RecordBatch:
    for word in [word for word in seen if len(word) > WORD_BYTES]:
        seen[short(word)] += seen.pop(word)
    return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])


# One row for a text, then one for each other word and each other gram it has.
SCORED = "id long, doc_id long, held_out boolean, n_tokens long, n_known long, common double, score double, word binary, gram long, times long"


def _score_rows(common, table, depth: int):
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.int64(), pa.int64()]
    names = [part.split()[0] for part in SCORED.split(", ")]
    key = uuid.uuid4().hex

    def batch_of(columns: dict[str, list | np.ndarray], size: int) -> pa.RecordBatch:
        arrays = [pa.array(columns[name], kind) if name in columns else pa.nulls(size, kind) for name, kind in zip(names, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def rest(place: np.ndarray, row: np.ndarray, gram: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The grams of a step that are not in the table, counted by text. Rows and grams share 64 bits."""
        low = int(row.min())
        for at in range(low, int(row.max()) + 1, 1 << 15):
            own = (row >= at) & (row < at + (1 << 15))
            pair, times = np.unique(((row[own] - at).astype(np.uint64) << np.uint64(49)) | gram[own], return_counts=True)
            ids = place[(pair >> np.uint64(49)).astype(np.int64) + at]
            gram_of = (pair & np.uint64(2**49 - 1)).view(np.int64)
            for low_row in range(0, len(times), OUT):
                part = slice(low_row, low_row + OUT)
                yield batch_of({"id": ids[part], "gram": gram_of[part], "times": times[part]}, len(times[part]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.value
        lengths = kept_by_worker("code lengths", key, lambda: Lengths(*table.value))
        for batch in batches:
            data, offsets = buffer(batch["text"])
            place = batch["id"].to_numpy()
            score = np.zeros(len(batch))
            for row, gram in text_grams(data, offsets, depth):
                found = lengths.find(gram)
                other = np.flatnonzero(np.isnan(found))
                found[other] = 0
                score += np.bincount(row, found, len(batch))
                if len(other):
                    yield from rest(place, row[other], gram[other])
            for low in range(0, len(batch), 64):
                part = batch.slice(low, 64)
                rows: list[tuple] = []
                rare: list[tuple] = []
                for i, text in enumerate(part["text"].to_pylist()):
                    words = tokens(text)
                    words.append(END)
                    logs = list(map(known.get, words))
                    total, n_known = sum(filter(None, logs)), len(words)  # no logarithm is zero
                    if None in logs:
                        missing = Counter([w for w, one in zip(words, logs, strict=True) if one is None])
                        for word, times in missing.items():
                            word = short(word)
                            log = known.get(word)
                            if log is None:
                                rare.append((int(place[low + i]), word, times))
                                n_known -= times
                            else:
                                total += times * log
                    rows.append((len(words), n_known, total))
                n_tokens, n_known, sums = zip(*rows, strict=True)
                yield batch_of(
                    {
                        "id": place[low : low + len(part)], "doc_id": part["doc_id"], "held_out": part["held_out"], "n_tokens": n_tokens,
                        "n_known": n_known, "common": sums, "score": score[low : low + len(part)],
                    },
                    len(part),
                )
                if rare:
                    ids, words, times = zip(*rare, strict=True)
                    yield batch_of({"id": ids, "word": words, "times": times}, len(ids))

    return run


def score(docs: DataFrame, folds: int = 7, held: int = 2, depth: int = DEPTH, words: int = WORDS, table: int = TABLE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    ``score`` is the model's log10 probability of the text, its end included; ``base_score`` that of
    its tokens under add-one word counts. Both learn from the rows whose fold is not ``held``; a
    null id has the fold of the empty text. Null text is empty. Equal rows count and are scored each.
    No rows give no rows; further columns are left out, whatever their names. ``depth`` is 3 to 5;
    ``words`` and ``table`` bound what is broadcast and change no result.
    """
    if not 3 <= depth <= DEPTH:
        raise ValueError("depth is 3 to 5")
    spark: SparkSession = docs.sparkSession
    named = texts(docs, (fold("doc_id", folds) == held).alias("held_out"))
    lengths = fit(named, depth)
    codes = spark.sparkContext.broadcast(frequent(lengths, table))

    vocabulary = written(counted_words(named.filter(~F.col("held_out"))))
    total, distinct = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    divisor = float(total + distinct + 1)
    log = F.log10((F.col("n") + 1) / F.lit(divisor))
    held_words = usual(vocabulary, "n", words).select("word", log.alias("log")).toArrow()
    common = spark.sparkContext.broadcast(dict(zip(held_words["word"].to_pylist(), held_words["log"].to_pylist(), strict=True)))

    # A number per row joins the sums of its other words and grams; the rows are written, so it stays.
    numbered = named.select("doc_id", "held_out", "text", F.monotonically_increasing_id().alias("id"))
    scored = written(numbered.select("id", "doc_id", "held_out", "text").mapInArrow(_score_rows(common, codes, depth), SCORED))
    by_word = scored.filter(F.col("word").isNotNull()).select("id", "word", "times").join(vocabulary, "word", "left")
    times = F.col("times")
    more_words = by_word.select(
        "id",
        (times * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(divisor))).alias("rare"),
        F.when(F.col("n").isNotNull(), times).otherwise(F.lit(0)).alias("rare_known"),
        F.lit(0.0).alias("rest"),
    )
    by_gram = scored.filter(F.col("gram").isNotNull()).select("id", "gram", "times").join(lengths.select("gram", "length"), "gram")
    more_grams = by_gram.select("id", F.lit(0.0).alias("rare"), F.lit(0).cast("long").alias("rare_known"), (times * F.col("length")).alias("rest"))
    other = more_words.unionByName(more_grams).groupBy("id").agg(*(F.sum(c).alias(c) for c in ("rare", "rare_known", "rest")))
    return (
        scored.filter(F.col("word").isNull() & F.col("gram").isNull())
        .join(other, "id", "left")
        .select(
            "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"), (F.col("common") + F.coalesce("rare", F.lit(0.0))).alias("base_score"),
            (F.col("score") + F.coalesce("rest", F.lit(0.0))).alias("score"),
        )
    )
