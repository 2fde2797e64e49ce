"""Toxicity by a string-kernel support vector machine with Nystroem landmarks.

The kernel between a word and a landmark counts their common subsequences of three characters, each
gap costing a factor, and is normalised to 1 for equal strings. So "idiot", "id-iot" and
"i.d.i.o.t" are near each other. Landmarks are all words of the labelled sentences that stand in texts
labelled 1 more often than chance explains: a word counts if the odds of so uneven a share are below
one to the number of words looked at. Of near copies one is an example, since copies of one text
would make all its words look telling. A sentence is described by its largest kernel value with each
landmark, mapped through the inverse root of the landmarks' own kernel matrix (Nystroem), and a linear
support vector machine is trained on the labelled sentences by dual coordinate descent. A text scores as its
worst sentence. Words are counted and sentences described on Spark; the driver sees words with their
counts and descriptions of sentences, no text.
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

from palaver.llm.common import discard, fold, kept_by_worker, mixed, texts, written

ORDER = 3
DECAY = 0.7
#: Landmarks of a machine at most, those of most weight; the features and the broadcast grow with them.
LANDMARKS = 256
#: Longest word, in characters, that may be a landmark.
LANDMARK_CHARS = 40
#: Labelled documents that training reads at most, chosen by a hash of their id.
TRAIN_ROWS = 4_000
#: Min-hashes that tell near copies among the training rows.
SIGNATURES = 6
#: Words a worker remembers.
MEMORY_WORDS = 400_000
#: Longest stretch of a word that the kernel sees at once; longer words are seen through a sliding stretch.
STRETCH = 24
#: New words that are compared together.
PAIRED = 50_000
#: Texts whose new words are worked out together.
BATCH = 400
#: Kernel values below this count as 0, so that chance likeness of ordinary words adds nothing.
FLOOR = 0.35

#: Spaces behind a full stop, or a line break; it begins with the space, so that a search passes over all else.
_SENTENCES = re.compile(r"\s(?:(?<=[.!?]\s)\s*|(?<=\n))")
_SPACED = re.compile(r"(?<!\S)(?:\S[ \t]+){2,}\S(?!\S)")
#: Stands in whatever ``_SPACED`` finds, and is found faster.
_SINGLE = re.compile(r"[ \t]\S[ \t]+\S(?!\S)")
_MARKS = re.compile(r"[\W_]+")
_BARE = re.compile(r"[^\w\s]+")


def words(sentence: str) -> list[str]:
    """Lower-cased letters and digits of the words; single characters in a row are read as one word."""
    lowered = sentence.lower()
    joined = _SPACED.sub(lambda m: m.group().replace(" ", "").replace("\t", ""), lowered)
    return [bare for word in joined.split() if (bare := word if word.isalnum() else _MARKS.sub("", word))]


def bare(lowered: str) -> str:
    """Only the letters, digits and spaces."""
    return _BARE.sub("", lowered.replace("_", ""))


def kernel(strings: list[str], landmark: str, order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """Gap-weighted subsequence kernel of each string with one landmark, for all strings at once."""
    if not strings:
        return np.zeros(0)
    width = max(map(len, strings))
    codes = np.zeros((len(strings), width), np.uint32)
    flat = np.frombuffer("".join(s.ljust(width, "\0") for s in strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes[:] = flat.reshape(len(strings), width)
    target = np.frombuffer(landmark.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _weighted(codes.T, np.repeat(target[:, None], len(strings), axis=1), order, decay)


def _weighted(codes: np.ndarray, target: np.ndarray, order: int, decay: float) -> np.ndarray:
    """Gap-weighted common subsequences of column i of ``codes`` and column i of ``target``, for all columns at once.

    Single precision is enough for likeness; columns lie side by side in memory.
    """
    width, size = codes.shape
    if size == 1:  # sums are rounded alike, however many columns there are
        return _weighted(np.repeat(codes.T, 2, axis=0).T, np.repeat(target, 2, axis=1), order, decay)[:1]
    hit = (codes[:, None, :] == target[None, :, :]).astype(np.float32) * np.float32(decay**2)
    decay = np.float32(decay)
    # before: weighted pairs of subsequences of one length that end in both prefixes, gaps counted to the ends.
    before = np.ones((width + 1, len(target) + 1, size), np.float32)
    for _ in range(1, order):
        run = hit * before[:-1, :-1]
        for j in range(1, len(target)):
            run[:, j] += run[:, j - 1] * decay
        after = np.zeros_like(before)
        for s in range(width):
            np.multiply(after[s], decay, out=after[s + 1])
            after[s + 1, 1:] += run[s]
        before = after
    return np.einsum("sjn,sjn->n", hit, before[:-1, :-1]).astype(float)


def least_self_kernel(width: int) -> float:
    """What the kernel of a string of this length with itself is at least: each subsequence with itself alone."""
    return sum((width - span + 1) * (span - ORDER + 1) * DECAY ** (2 * span) for span in range(ORDER, width + 1))


def stretches(word: str) -> list[str]:
    """The word, or overlapping stretches of a long one, equal ones once."""
    if len(word) <= STRETCH:
        return [word]
    return list(dict.fromkeys(word[start : start + STRETCH] for start in range(0, len(word) - STRETCH // 2, STRETCH // 2)))


class Similarity:
    """Normalised kernel values of words with all landmarks, remembered by a worker."""

    def __init__(self, landmarks: list[str]) -> None:
        self.landmarks = landmarks
        self.own = self_kernels(landmarks)
        self.letters = letter_sets(landmarks)
        self.least = (3 * np.bitwise_count(self.letters) + 3) // 4
        self.known: set[str] = set()
        #: Values of the known words that are near a landmark.
        self.near: dict[str, np.ndarray] = {}
        #: Places and code points of the landmarks of each length.
        self.by_length: list[tuple[np.ndarray, np.ndarray]] = []
        size = np.array([len(one) for one in landmarks], np.int64)
        for length in np.unique(size).tolist():
            places = np.flatnonzero(size == length)
            self.by_length.append((places, _codes([landmarks[i] for i in places.tolist()])))

    def learn(self, found: set[str]) -> None:
        """Values of unknown words. A landmark counts only where the word has most of its letters."""
        fresh = found - self.known
        if len(self.known) + len(fresh) > MEMORY_WORDS:
            self.known.clear()
            self.near.clear()
            fresh = found
        self.known |= fresh
        able = [word for word in fresh if len(word) >= ORDER]
        for low in range(0, len(able), PAIRED):
            part = able[low : low + PAIRED]
            letters = letter_sets(part)
            size = np.array([len(word) for word in part], np.int64)
            for width in np.unique(np.minimum(size, STRETCH + 1)).tolist():
                own = np.flatnonzero(np.minimum(size, STRETCH + 1) == width).tolist()
                if width <= STRETCH:
                    some = [part[i] for i in own]
                    self._compare(some, some, letters[own])
                    continue
                for i in own:
                    rows = stretches(part[i])
                    for length in {len(row) for row in rows}:
                        equal = [row for row in rows if len(row) == length]
                        self._compare([part[i]] * len(equal), equal, np.repeat(letters[i], len(equal)))

    def _compare(self, of: list[str], rows: list[str], letters: np.ndarray) -> None:
        """Values of words by their stretches ``rows``, which have one length; ``letters`` are those of the words."""
        bound = FLOOR * 0.999 * np.sqrt(least_self_kernel(len(rows[0])))
        for low in range(0, len(rows), 10_000):
            some = slice(low, low + 10_000)
            codes, mine = _codes(rows[some]), letters[some, None]
            for places, target in self.by_length:
                at, landmark = np.nonzero(np.bitwise_count(mine & self.letters[places]) >= self.least[places])
                for first in range(0, len(at), 2000):
                    a, b = at[first : first + 2000], landmark[first : first + 2000]
                    value = _weighted(codes[a].T, np.ascontiguousarray(target[b].T), ORDER, DECAY) / np.sqrt(self.own[places[b]])
                    # Few values pass the least that a word of this length asks for; only these need the word's own.
                    passed = np.flatnonzero(value >= bound)
                    norm = np.sqrt(self_kernels([rows[low + k] for k in a[passed].tolist()]))
                    for k, n in zip(passed.tolist(), norm.tolist(), strict=True):
                        if value[k] >= FLOOR * n:
                            known = self.near.setdefault(of[low + a[k]], np.zeros(len(self.landmarks), np.float32))
                            i = places[b[k]]
                            known[i] = max(known[i], min(1.0, value[k] / n))

    def texts(self, some: list[str]) -> list[list[np.ndarray]]:
        """For each text its sentences near any landmark: the largest value with each over their words.

        Sentences end at spaces, so a text's words are those of its sentences, but for single characters in a row.
        A text that has neither those nor a word near a landmark is not split.
        """
        split: list[list[list[str]] | None] = []
        found = []
        for text in some:
            lowered = text.lower()
            if _SINGLE.search(lowered) and _SPACED.search(lowered):
                split.append([words(sentence) for sentence in _SENTENCES.split(text)])
                found.append({word for parts in split[-1] for word in parts})
            else:
                split.append(None)
                found.append(set(bare(lowered).split()))
        self.learn(set().union(*found))
        out = []
        for text, sentences, own in zip(some, split, found, strict=True):
            near = own & self.near.keys()
            if near and sentences is None:
                # No sentence holds a line break.
                sentences = [one.split() for one in bare("\n".join(_SENTENCES.split(text.lower()))).split("\n")]
            near_parts = ([self.near[word] for word in parts if word in near] for parts in sentences or () if not near.isdisjoint(parts))
            out.append([np.max(values, axis=0) for values in near_parts])
        return out


def _codes(strings: list[str]) -> np.ndarray:
    """Code points of strings of one length, a string to a row."""
    return np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(strings), -1)


def self_kernels(strings: list[str]) -> np.ndarray:
    """Kernel of each string with itself, by the same recursion over strings of equal length."""
    out = np.zeros(len(strings))
    by_length: dict[int, list[int]] = {}
    for i, s in enumerate(strings):
        by_length.setdefault(len(s), []).append(i)
    for width, places in by_length.items():
        for some in range(0, len(places), 2000):
            at = places[some : some + 2000]
            codes = _codes([strings[i] for i in at] * (2 if len(at) == 1 else 1))
            out[at] = _weighted(codes.T, codes.T, ORDER, DECAY)[: len(at)]
    return out


def letter_sets(some: list[str]) -> np.ndarray:
    """The letters of each string as bits of one number; letters 64 code points apart share a bit."""
    size = np.array([len(one) for one in some], np.int64)
    codes = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(len(some), np.uint64)
    if len(codes):
        bits = np.uint64(1) << (codes & np.uint32(63)).astype(np.uint64)
        out[size > 0] = np.bitwise_or.reduceat(bits, (np.cumsum(size) - size)[size > 0])
    return out


def choose_landmarks(counts: list[tuple[str, int, int]], texts_with: tuple[int, int], looked_at: int, most: int = LANDMARKS) -> list[str]:
    """Words that tell label 1, from (word, texts labelled 0, texts labelled 1).

    A word is taken if it is more frequent under label 1 and the chance of a share as uneven is below
    1 / ``looked_at`` (Chernoff's bound on the binomial tail), so about one word is taken by mistake.
    """
    zeros, ones = texts_with
    if not zeros or not ones:
        return []
    share = ones / (zeros + ones)

    def weight(n0: int, n1: int) -> float:
        """n times the divergence of the word's share from the share of all: minus the logarithm of the bound."""
        n, q = n0 + n1, n1 / (n0 + n1)
        if q <= share:
            return 0.0
        return n * (q * np.log(q / share) + ((1 - q) * np.log((1 - q) / (1 - share)) if q < 1 else 0.0))

    found = [(weight(n0, n1), word) for word, n0, n1 in counts]
    able = [(w, word) for w, word in found if w > np.log(max(2, looked_at))]
    return [word for _, word in sorted(able, key=lambda x: (-x[0], x[1]))[:most]]


class Machine:
    """Linear support vector machine on Nystroem features, with a calibrated score."""

    def __init__(self, similarity: Similarity, root: np.ndarray, weight: np.ndarray, bias: float, slope: float, shift: float) -> None:
        self.similarity, self.root, self.weight, self.bias, self.slope, self.shift = similarity, root, weight, bias, slope, shift

    def plain(self) -> tuple:
        return self.similarity.landmarks, self.root, self.weight, self.bias, self.slope, self.shift

    def margins(self, some: list[str]) -> np.ndarray:
        """Largest margin over the sentences of each text; that of an empty sentence if none is near."""
        project = self.root @ self.weight
        return np.array([float(np.max(np.array(found) @ project)) if found else 0.0 for found in self.similarity.texts(some)]) + self.bias

    def scores(self, some: list[str]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * self.margins(some) + self.shift, -60, 60)))


def descend(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 40, seed: int = 1) -> np.ndarray:
    """Weights of an L1-loss support vector machine by dual coordinate descent; the last column is the bias."""
    weight, dual = np.zeros(x.shape[1]), np.zeros(len(x))
    norm = (x * x).sum(axis=1)
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            if norm[i]:
                now = min(max(dual[i] - (y[i] * (weight @ x[i]) - 1) / norm[i], 0.0), cost[i])
                if now != dual[i]:
                    weight += (now - dual[i]) * y[i] * x[i]
                    dual[i] = now
    return weight


def signatures(text: str) -> np.ndarray:
    """``SIGNATURES`` min-hashes of the five-word shingles of a text; near copies share most of them."""
    found = text.lower().split()
    codes = np.zeros(max(len(found), 1) + 4, np.uint64)
    codes[: len(found)] = [zlib.crc32(word.encode("utf-8", "surrogatepass")) for word in found]
    shingles = np.zeros(max(1, len(found) - 4), np.uint64)
    for k in range(5):
        shingles = mixed(shingles + codes[k : k + len(shingles)] + np.uint64(k))
    return np.array([mixed(shingles + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)).min() for k in range(1, SIGNATURES + 1)], np.uint64)


def independent(sample: DataFrame) -> DataFrame:
    """One row of each group of near copies, so that a text that was copied often is one example.

    Rows that share a signature, and chains of them, are a group; of each label its first row stays.
    ``sample`` has rows (row, doc_id, text, toxic), and as many signatures as training takes rows come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signatures(text) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["row"], batch["toxic"], pa.array([one.view(np.int64).tolist() for one in found], pa.list_(pa.int64()))], names=["row", "toxic", "found"])

    told = sample.mapInArrow(run, "row long, toxic int, found array<long>").orderBy("row").toArrow()
    rows, labels = told["row"].to_pylist(), told["toxic"].to_pylist()
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first: dict[tuple[int, int], int] = {}
    for i, found in enumerate(told["found"].to_pylist()):
        for key in enumerate(found):
            parent[root(i)] = root(first.setdefault(key, i))
    kept: dict[tuple[int, int], int] = {}
    for i, row in enumerate(rows):
        kept.setdefault((root(i), labels[i]), row)
    chosen = sample.sparkSession.createDataFrame([(row,) for row in kept.values()], "row long")
    return sample.join(chosen, "row", "left_semi")


def word_counts(sample: DataFrame) -> DataFrame:
    """(word, zeros, ones): texts of each label that hold a word a landmark may be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
                seen[label].update({w for w in words(text) if ORDER <= len(w) <= LANDMARK_CHARS})
        every = sorted(set(seen[0]) | set(seen[1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(every, pa.string()), *(pa.array([n[w] for w in every], pa.int64()) for n in seen)], names=["word", "zeros", "ones"]
        )

    counted = sample.mapInArrow(run, "word string, zeros long, ones long")
    return counted.groupBy("word").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))


def described(sample: DataFrame, landmarks: list[str]) -> tuple[list[list[np.ndarray]], np.ndarray]:
    """For each labelled text its sentences near any landmark, and its label. No text leaves its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        similarity = Similarity(landmarks)
        for batch in batches:
            for low in range(0, len(batch), BATCH):
                part = batch.slice(low, BATCH)
                near = [np.unique(np.array(one), axis=0).tobytes() if one else b"" for one in similarity.texts(part["text"].to_pylist())]
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["toxic"], pa.array(near, pa.binary())], names=["doc_id", "toxic", "near"])

    rows = sample.mapInArrow(run, "doc_id long, toxic int, near binary").orderBy("doc_id", "toxic", "near").toArrow()
    found = [list(np.frombuffer(one, np.float32).reshape(-1, len(landmarks)).astype(float)) for one in rows["near"].to_pylist()]
    return found, rows["toxic"].to_numpy().astype(float)


def fit(sample: DataFrame) -> Machine | float:
    """Train on (doc_id, text, toxic) rows, no two of them copies. With one label only, or no telling word, the share of label 1."""
    totals = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    zeros, ones = totals.get(0, 0), totals.get(1, 0)
    if not zeros or not ones:
        return ones / (zeros + ones) if zeros + ones else 0.0
    counts = written(word_counts(sample))
    # A word of a few texts, or as frequent under label 0, cannot pass the test.
    asked = counts.filter((F.col("ones") >= 2) & (F.col("ones") * zeros > F.col("zeros") * ones))
    candidates = [(r.word, r.zeros, r.ones) for r in asked.toLocalIterator()]
    landmarks = choose_landmarks(candidates, (zeros, ones), counts.count())
    discard(counts)
    if not landmarks:
        return ones / (zeros + ones)
    similarity = Similarity(landmarks)
    gram = np.array([kernel(landmarks, one) for one in landmarks]) / np.sqrt(np.outer(similarity.own, similarity.own))
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    root = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T
    # Sentences: of a text labelled 1 the one nearest to a landmark; of others every near one, or an empty one.
    nothing = np.zeros(len(landmarks))
    near, labels = described(sample, landmarks)
    x, y = [], []
    for found, label in zip(near, labels, strict=True):
        if label:
            x.append(max(found, key=lambda v: v.max()) if found else nothing)
            y.append(1)
        else:
            x += found or [nothing]
            y += [-1] * max(1, len(found))
    features = np.c_[np.array(x) @ root, np.ones(len(x))]
    sign = np.array(y, float)
    cost = np.where(sign > 0, len(sign) / max(1, (sign > 0).sum()), len(sign) / max(1, (sign < 0).sum())) / 2
    weight = descend(features, sign, cost)
    machine = Machine(similarity, root, weight[:-1], float(weight[-1]), 1.0, 0.0)
    project = root @ weight[:-1]
    margins = np.array([max((float(v @ project) for v in found), default=0.0) for found in near]) + machine.bias
    machine.slope, machine.shift = _calibrate(margins, labels)
    return machine


def _calibrate(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic slope and shift of the margins, by Newton steps with a small penalty."""
    theta = np.array([1.0, 0.0])
    x = np.c_[margin, np.ones(len(margin))]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - label) + 1e-3 * (theta - [1, 0]))
        theta = theta - step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(theta[0], 1e-3)), float(theta[1])


def score(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Labels (doc_id, toxic) count from rows whose fold is not ``held``, at most ``train_rows`` of them by a
    hash of the id; null labels and ids do not count, several labels of an id are one (1 if any is), and
    rows of ``docs`` that share a labelled id are examples each. Null and empty texts get the score of a text
    without any near word. Texts of any length are read whole, a stretch of a long word at a time.
    No rows give no rows; further columns are left out, whatever their names.
    """
    spark = docs.sparkSession
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold("doc_id", folds) != held))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    rows = usable.count()
    if rows > train_rows:
        usable = usable.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000)) < int(1_000_000 * train_rows / rows))
    sample = texts(docs).join(usable, "doc_id").select("doc_id", "text", "toxic").repartition("doc_id")
    # Sorted, so that a repeat numbers and keeps the same rows; a number is part of the written table.
    sample = written(sample.sortWithinPartitions("doc_id", "text").withColumn("row", F.monotonically_increasing_id()))
    examples = written(independent(sample))
    fitted = fit(examples)
    discard(sample, examples)
    plain = fitted.plain() if isinstance(fitted, Machine) else fitted
    machine = spark.sparkContext.broadcast((uuid.uuid4().hex, plain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, plain = machine.value
        model = kept_by_worker("machine", key, lambda: Machine(Similarity(plain[0]), *plain[1:]) if isinstance(plain, tuple) else plain)
        for batch in batches:
            for part in (batch.slice(at, BATCH) for at in range(0, len(batch), BATCH)):
                some = part["text"].to_pylist()
                found = model.scores(some) if isinstance(model, Machine) else np.full(len(some), float(model))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["held_out"], pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    inputs = texts(docs, (fold("doc_id", folds) == held).alias("held_out"))
    return inputs.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
