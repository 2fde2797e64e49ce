"""Context-tree weighting and the string kernel against plain versions."""

import itertools
import math
import random
import re
import tracemalloc
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from palaver.llm import common, toxicity, treeweights


def estimate(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


def plain_scores(train, texts, depth):
    """Log10 probabilities by a dictionary tree."""
    counts = defaultdict(lambda: [0, 0])

    def steps(text):
        data = text.encode()
        padded = b"\0" * depth + data
        for i in range(len(data) + 1):
            context = padded[i : i + depth]
            yield 0, context, int(i == len(data))
            for place in range(8 if i < len(data) else 0):
                yield (1 << place) | (data[i] >> (8 - place)), context, data[i] >> (7 - place) & 1

    for text in train:
        for decided, context, bit in steps(text):
            for d in range(depth + 1):
                counts[decided, context[depth - d :]][bit] += 1
    total, weight, split = {}, {}, defaultdict(float)
    for (decided, context), (a, b) in sorted(counts.items(), key=lambda x: -len(x[0][1])):
        own = estimate(a, b)
        if len(context) == depth:
            total[decided, context], weight[decided, context] = own, 1.0
        else:
            below = split[decided, context]
            high = max(own, below)
            value = high + math.log(0.5 * math.exp(own - high) + 0.5 * math.exp(below - high))
            total[decided, context], weight[decided, context] = value, 0.5 * math.exp(own - value)
        if context:
            split[decided, context[1:]] += total[decided, context]
    out = []
    for text in texts:
        score = 0.0
        for decided, context, bit in steps(text):
            one, left, last = 0.0, 1.0, 0.5
            for d in range(depth + 1):
                node = decided, context[depth - d :]
                if node not in counts:
                    break
                a, b = counts[node]
                last = (b + 0.5) / (a + b + 1)
                one += left * weight[node] * last
                left *= 1 - weight[node]
            one += left * last
            score += math.log10(one if bit else 1 - one)
        out.append(score)
    return out


def words_of(text):
    return text.encode().lower().split() + [b" "]


@pytest.mark.parametrize("options", [{}, {"table": 40, "words": 3}, {"table": 0, "words": 0}, {"depth": 3, "table": 200}])
def test_scores_equal_a_plain_tree(spark, monkeypatch, options):
    """At the registered depth, with a held table of all, some and no grams and words; subtrees come in many tables."""
    monkeypatch.setattr(treeweights, "ROWS", 50)
    monkeypatch.setattr(treeweights, "MERGE", 60)
    rng = random.Random(8)
    long = "x" * 70
    rows = [(i, " ".join(rng.choice(["the", "tree", "oft", "é", "Of", "o\0f", long]) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    rows += [(60, None), (None, "null id"), (61, ""), (62, " "), (63, "漢字 unseen ÿ"), (64, "\0\0"), (1, "the same id"), (2, rows[2][1])]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, word string, gram long").repartition(4)
    found = treeweights.score(docs, **options)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in rows]
    texts = [t or "" for _, t in rows]
    train = [t for t, aside in zip(texts, held, strict=True) if not aside]
    plain = plain_scores(train, texts, options.get("depth", treeweights.DEPTH))
    counts = Counter(w for t in train for w in words_of(t))
    total, distinct = sum(counts.values()), len(counts)
    expected = []
    for (i, _), text, aside, score in zip(rows, texts, held, plain, strict=True):
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words_of(text))
        known = sum(counts[w] > 0 for w in words_of(text))
        expected.append((-1 if i is None else i, aside, len(words_of(text)), known, total, base, score))
    got = [tuple(-1 if x is None else x for x in r) for r in found.collect()]
    assert len(got) == len(rows) and any(held) and not all(held)
    for one, other in zip(sorted(got), sorted(expected), strict=True):
        assert one[:5] == other[:5]
        assert math.isclose(one[5], other[5], rel_tol=1e-9) and math.isclose(one[6], other[6], rel_tol=1e-5), (one, other)


def test_probabilities_of_texts_add_up_to_at_most_one(spark):
    """Over all texts of up to two letters of four, and the empty one; every other text has a share of the rest."""
    train = ["ab", "ba", "", "a", "abab", "b"] * 3
    letters = "ab\0é"
    asked = [""] + list(letters) + [x + y for x in letters for y in letters]
    rows = [(i, t) for i, t in enumerate(train) if zlib.crc32(str(i).encode()) % 7 != 2]
    number = (i for i in itertools.count(1000) if zlib.crc32(str(i).encode()) % 7 == 2)
    held = {next(number): text for text in asked}
    docs = spark.createDataFrame(rows + list(held.items()), "doc_id long, text string")
    scores = {r.doc_id: r.score for r in treeweights.score(docs).collect() if r.doc_id in held}
    shares = {held[i]: 10**score for i, score in scores.items()}
    assert 0.2 < sum(shares.values()) <= 1 and 0 < shares[""] < 0.5


def test_each_context_shares_out_one(spark):
    """The 257 symbols after any context, seen or not, have probabilities that add up to one."""
    docs = spark.createDataFrame([(i, "abracadabra, abrakadabra" * (i % 3)) for i in range(20)], "doc_id long, text string")
    contexts = [b"dabra", b"xabra", b"zzzzz", b"\0\0\0\0\0", b"\0\0abr"]
    base = [sum(b << (treeweights.SYMBOL + 8 * i) for i, b in enumerate(c)) for c in contexts]
    grams = np.sort((np.array(base, np.uint64)[:, None] | np.arange(257, dtype=np.uint64)).ravel())
    named = docs.selectExpr("doc_id", "text", "false AS held_out")
    seen = {r.gram: r for r in treeweights.counted_grams(named).collect()}
    rows = [(g >> 33, g >> 25, g, seen[g].n if g in seen else 0) for g in set(seen) | set(grams.tolist())]
    counted = spark.createDataFrame(rows, "part int, third long, gram long, n long").withColumn("n_all", F.col("n") + 1)
    second = counted.filter("n > 0").repartition("part").sortWithinPartitions("part", "gram").mapInArrow(treeweights._weigh(5), treeweights._SECOND)
    upper = treeweights.Upper(second).levels
    near = second.toPandas()
    key = (near["part"].to_numpy().astype(np.uint64) << np.uint64(8)) | near["decision"].to_numpy().astype(np.uint64)
    nodes = treeweights._Plain(key, near["one"].to_numpy(), near["weight"].to_numpy())
    every = np.array(sorted(r[2] for r in rows), np.uint64)
    n = np.array([seen[g].n if g in seen else 0 for g in every.tolist()])
    length = dict(zip(every.tolist(), treeweights.code_lengths(every, treeweights.subtrees(every, n, 5), nodes, upper, 5), strict=True))
    for start in base:
        assert abs(sum(10 ** length[start | s] for s in range(257)) - 1) < 1e-9


def test_grams_do_not_depend_on_steps(monkeypatch):
    parts = [b"", b"a", b"some bytes", b"xy" * 40, b""]
    data, offsets = np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])

    def rows():
        found = [(r, g) for row, gram in treeweights.text_grams(data, offsets) for r, g in zip(row.tolist(), gram.tolist(), strict=True)]
        return sorted(found)

    expected = []
    for r, p in enumerate(parts):
        padded = b"\0" * 5 + p
        for i in range(len(p) + 1):
            context = sum(b << (9 + 8 * k) for k, b in enumerate(padded[i : i + 5]))
            expected.append((r, context | (p[i] if i < len(p) else 256)))
    assert rows() == sorted(expected)
    monkeypatch.setattr(treeweights, "STEP", 7)
    assert rows() == sorted(expected)


def test_lookup_table_is_exact():
    rng = np.random.default_rng(5)
    gram = np.unique(rng.integers(0, 2**49, 5000).astype(np.uint64))
    length = rng.random(len(gram)).astype(np.float32)
    table = treeweights.Lengths(gram[::2], length[::2])
    found = table.find(gram)
    assert (found[::2] == length[::2]).all() and np.isnan(found[1::2]).all()
    assert np.isnan(treeweights.Lengths(gram[:0], length[:0]).find(gram)).all()


def most_memory(run):
    """MB that numpy and Python held at once."""
    tracemalloc.start()
    run()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most / 1e6


def test_a_lookup_table_is_built_in_little_more_than_its_own_size():
    gram = np.arange(1_000_000, dtype=np.uint64) * np.uint64(977)
    length = np.zeros(len(gram), np.float32)
    table = 12 * (1 << 21) / 1e6
    assert most_memory(lambda: treeweights.Lengths(gram, length)) < 1.6 * table


def test_weighing_holds_few_subtrees_at_once():
    """Four hundred thousand grams of 4,000 subtrees, as Spark hands them over."""
    third = np.repeat(np.arange(4000, dtype=np.uint64), 100)
    gram = (third << np.uint64(25)) | (np.tile(np.arange(100, dtype=np.uint64), 4000) << np.uint64(9)) | np.uint64(97)
    columns = {"part": (third >> np.uint64(8)).astype(np.int32), "third": third.view(np.int64), "gram": gram.view(np.int64), "n": np.ones(len(gram), np.int64)}
    batch = pa.RecordBatch.from_pydict(columns)
    batches = [batch.slice(at, 10_000) for at in range(0, len(batch), 10_000)]

    def run():
        for _ in treeweights._weigh(5)(iter(batches)):
            pass

    assert most_memory(run) < 80


def test_grams_leave_a_task_in_small_batches(monkeypatch):
    monkeypatch.setattr(treeweights, "OUT", 100)
    monkeypatch.setattr(treeweights, "MERGE", 400)
    monkeypatch.setattr(treeweights, "STEP", 300)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 400))) for _ in range(40)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "held_out": [i % 3 == 0 for i in range(40)]})
    found, expected = Counter(), Counter()
    for out in treeweights._count(5)(iter([batch, batch])):
        assert 0 < len(out) <= 100
        for gram, n, n_all in zip(*(column.to_pylist() for column in out.columns), strict=True):
            found[gram, "train"] += n
            found[gram, "all"] += n_all
    for i, text in enumerate(texts):
        data, offsets = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])
        for _, gram in treeweights.text_grams(data, offsets):
            for g in gram.tolist():
                expected[g, "all"] += 2
                expected[g, "train"] += 2 * (i % 3 != 0)
    assert +found == +expected


def test_a_worker_drops_the_old_before_it_builds_the_new():
    class Kept:
        pass

    old = weakref.ref(common.kept_by_worker("tried", 1, Kept))
    assert old() is common.kept_by_worker("tried", 1, Kept)
    there = common.kept_by_worker("tried", 2, lambda: old() is None)
    assert there is True and common.kept_by_worker("tried", 2, Kept) is True


def test_usual_rows_are_bounded(spark):
    counts = [1] * 50 + [2] * 20 + [3] * 5 + [2000] * 4 + [1025] * 3 + [10**9]
    frame = spark.createDataFrame([(n,) for n in counts], "n long")
    for most, least in ((1000, 1), (83, 1), (82, 2), (33, 2), (32, 3), (13, 3), (12, 1024), (8, 1024), (7, 10**9), (1, 10**9)):
        found = [r.n for r in treeweights.usual(frame, "n", most).collect()]
        assert sorted(found) == sorted(n for n in counts if n >= least), (most, least)
    assert treeweights.usual(frame, "n", 0).collect() == []


def test_scores_of_nothing(empty):
    assert treeweights.score(empty).collect() == []


def plain_kernel(s, t, order=3, decay=toxicity.DECAY):
    total = 0.0
    for i in itertools.combinations(range(len(s)), order):
        for j in itertools.combinations(range(len(t)), order):
            if all(s[a] == t[b] for a, b in zip(i, j, strict=True)):
                total += decay ** (i[-1] - i[0] + 1 + j[-1] - j[0] + 1)
    return total


def test_kernel_equals_all_subsequences():
    strings = ["idiot", "id-iot", "i.d.i.o.t", "toidi", "ab", "scummy", "ééidiot"]
    for landmark in ("idiot", "scum"):
        assert np.allclose(toxicity.kernel(strings, landmark), [plain_kernel(s, landmark) for s in strings])
    assert np.allclose(toxicity.self_kernels(strings), [plain_kernel(s, s) for s in strings])


def plain_near(text, landmarks):
    """The sentences of a text near any landmark, word by word and stretch by stretch."""
    out = []
    for sentence in re.split(r"(?<=[.!?])\s+|\n", text):
        values = []
        for word in toxicity.words(sentence):
            starts = range(0, len(word) - 12, 12) if len(word) > 24 else (0,)
            value = np.zeros(len(landmarks), np.float32)
            for i, landmark in enumerate(landmarks):
                if 4 * len(set(word) & set(landmark)) >= 3 * len(set(landmark)):
                    for one in (word[start : start + 24] for start in starts):
                        norm = np.sqrt(toxicity.self_kernels([one])[0])
                        v = toxicity.kernel([one], landmark)[0] / np.sqrt(toxicity.self_kernels([landmark])[0])
                        if norm and v >= toxicity.FLOOR * norm:
                            value[i] = max(value[i], min(1.0, v / norm))
            if value.any():
                values.append(value)
        if values:
            out.append(np.max(values, axis=0))
    return out


@pytest.mark.parametrize("remembered", [toxicity.MEMORY_WORDS, 60])
def test_near_sentences_equal_a_plain_search(monkeypatch, remembered):
    monkeypatch.setattr(toxicity, "MEMORY_WORDS", remembered)
    landmarks = ["idiot", "moron", "scummy", "οδός", "dim"]
    rng = random.Random(21)
    parts = ["idiot", "IDIOT", "i_d.i-ot", "i d i o t", "s c\tu m m y", "morons", "mo--ron", "ΟΔΌΣ", "ΟΔΌΣ.", "İdiot", "di", "m", "a", "_", "...", "dim" * 9]
    parts += ["plain", "meadow", "o.d", "dot", "motor", "room", "ridiots", "id\x0biot", "idi\u2028ot", "x" * 30 + "idiot" + "y" * 30, "é" * 40, "漢字", "summoned"]
    ends = [" ", "  ", ". ", "! \n ", "?\t", "\n", ".", "\n\n", " . ", ".\x85", "\u00a0", " \t"]
    texts = ["", " ", ".", "i d i o t", "i d i o t\n", "i. d. i. o. t"]
    texts += ["".join(rng.choice(parts) + rng.choice(ends) for _ in range(rng.randint(0, 25))) for _ in range(150)]
    found = toxicity.Similarity(landmarks)
    for low in range(0, len(texts), 40):
        for text, near in zip(texts[low : low + 40], found.texts(texts[low : low + 40]), strict=True):
            expected = plain_near(text, landmarks)
            assert len(near) == len(expected), text
            assert all(np.allclose(one, other, rtol=1e-6) for one, other in zip(near, expected, strict=True)), text


def test_a_self_kernel_is_never_below_its_bound():
    strings = ["abc", "aaa", "abcabc", "mississippi", "q" * 24, "abcdefghijklmnopqrstuvwx"]
    assert all(k >= toxicity.least_self_kernel(len(s)) * 0.99999 for s, k in zip(strings, toxicity.self_kernels(strings), strict=True))
    assert math.isclose(toxicity.least_self_kernel(24), toxicity.self_kernels(strings[-1:])[0], rel_tol=1e-5)


def test_short_words_cost_no_more_beside_a_long_one(monkeypatch):
    """Kernels see words at their own length, a length at a time."""
    cells, calls = [], []
    weighted = toxicity._weighted

    def counted(codes, target, *rest):
        cells.append(codes.size * len(target))
        return weighted(codes, target, *rest)

    class Sentences:
        def split(self, text):
            calls.append(text)
            return [text]

    rng = random.Random(6)
    found = toxicity.Similarity(["idiot", "moron"])
    monkeypatch.setattr(toxicity, "_weighted", counted)
    monkeypatch.setattr(toxicity, "_SENTENCES", Sentences())
    words = ["".join(rng.choice("idotmrn") for _ in range(4)) for _ in range(400)]
    texts = [" ".join(words), "x" * 20 + "idiot", "nothing of the kind", "an idiot"]
    near = found.texts(texts)
    assert sum(cells) < 1.5 * 400 * 2 * 4 * 5
    assert near[2] == [] and near[3] and texts[2] not in calls  # a text without a near word is not split


def test_insults_with_gaps_are_found(spark):
    rng = random.Random(9)
    plain = ["meadow", "window", "ladder", "carpet", "lumber", "pencil", "summer"]
    bad = ["idiot", "moron", "scum"]

    def text(insult=None):
        words = [rng.choice(plain) for _ in range(30)]
        if insult:
            words[rng.randrange(30)] = insult
        return ". ".join(" ".join(words[i : i + 10]) for i in range(0, 30, 10))

    rows = [(i, text(rng.choice(bad) if i % 3 == 0 else None), int(i % 3 == 0)) for i in range(300)]
    rows += [(1000, text("i.d.i.o.t"), 1), (1001, text("mo-ron"), 1), (1002, text("s c u m"), 1), (1003, text("idiiot"), 1), (1004, None, None), (1005, "", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = {r.doc_id: r for r in toxicity.score(frame.drop("toxic"), frame.filter("doc_id < 1000").select("doc_id", "toxic")).collect()}
    assert len(found) == len(rows)
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)
    assert all(found[i].predicted == label for i, _, label in rows[:300])
    assert all(found[i].predicted == 1 for i in (1000, 1001, 1002, 1003))
    assert found[1004].predicted == found[1005].predicted == 0
    assert all(0 <= r.score <= 1 for r in found.values())


def test_more_telling_words_than_a_short_list_holds(spark):
    """Sixty insults, one to a toxic text; nine of ten held-out toxic texts are found, few others are."""
    rng = random.Random(12)

    def word(letters, n):
        return "".join(rng.choice(letters) for _ in range(n))

    plain = [word("abcdefghilmnoprstu", rng.randint(3, 8)) for _ in range(600)]
    insults = [word("bcdfgjklmnpqvwxzaeiou", 7) for _ in range(60)]
    rows = []
    for i in range(3000):
        words = [rng.choice(plain) for _ in range(40)]
        if i % 3 == 0:
            words[rng.randrange(40)] = rng.choice(insults)
        rows.append((i, ". ".join(" ".join(words[k : k + 10]) for k in range(0, 40, 10)), int(i % 3 == 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(8)
    found = {r.doc_id: r for r in toxicity.score(frame.drop("toxic"), frame.select("doc_id", "toxic")).collect()}
    held = [(i, label) for i, _, label in rows if found[i].held_out]
    bad = [found[i].predicted for i, label in held if label]
    good = [found[i].predicted for i, label in held if not label]
    assert sum(bad) >= 0.9 * len(bad) and sum(good) <= 0.03 * len(good)


def test_landmarks_are_words_beyond_chance():
    counts = [("often", 2, 400), ("rare", 0, 3), ("even", 300, 310), ("clean", 400, 2), ("some", 1, 30)]
    assert toxicity.choose_landmarks(counts, (1000, 1000), 5000) == ["often", "some"]
    assert toxicity.choose_landmarks(counts, (1000, 1000), 5000, most=1) == ["often"]
    assert toxicity.choose_landmarks(counts, (0, 1000), 5000) == []


def test_copies_are_one_example(spark):
    """Near copies of one toxic text do not make its ordinary words telling."""
    rng = random.Random(2)
    plain = [f"word{i}" for i in range(4000)]
    base = [rng.choice(plain) for _ in range(300)]
    rows = []
    for i in range(200):
        copy = list(base)
        for at in rng.sample(range(300), 6):
            copy[at] = rng.choice(plain)
        rows.append((i, i, " ".join(copy), 1))
    rows += [(i, i, " ".join(rng.choice(plain) for _ in range(300)), i % 2) for i in range(200, 260)]
    rows += [(i, i, text, 0) for i, text in ((300, ""), (301, ""), (302, "a"), (303, "a b"))]
    sample = spark.createDataFrame(rows, "row long, doc_id long, text string, toxic int").repartition(4)
    kept = sorted(r.row for r in toxicity.independent(sample).collect())
    assert kept == [0, *range(200, 260), 300, 302, 303]


def test_descent_equals_a_plain_solver():
    """Weights of the machine against many steps of subgradient descent on the same objective."""
    rng = np.random.default_rng(4)
    x = np.c_[rng.normal(size=(60, 3)), np.ones(60)]
    y = np.where(x[:, 0] + 0.5 * x[:, 1] + 0.3 * rng.normal(size=60) > 0, 1.0, -1.0)
    cost = np.full(60, 0.7)

    def objective(w):
        return 0.5 * w @ w + (cost * np.maximum(0, 1 - y * (x @ w))).sum()

    weight = toxicity.descend(x, y, cost, rounds=200)
    slow, best = np.zeros(4), np.inf
    for step in range(1, 40_000):
        active = y * (x @ slow) < 1
        slow = slow - (slow - ((cost * y)[active, None] * x[active]).sum(axis=0)) * (0.5 / step)
        best = min(best, objective(slow))
    assert objective(weight) <= best * 1.001


def test_repeated_ids_and_long_texts(spark):
    """Repeated labels count once; a very long text and a very long word are read whole."""
    rows = [(i, f"{i * 7} plain {i * 3} words {i} here" + (" idiot" if i % 2 else ""), i % 2) for i in range(200)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(500, "x" * 200_000 + " id-iot"), (501, "word " * 50_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, label) for i, _, label in rows] * 3, "doc_id long, toxic int")
    found = {r.doc_id: r.predicted for r in toxicity.score(docs, labels).collect()}
    assert len(found) == 202 and found[500] == 1 and found[501] == 0
    assert all(found[i] == label for i, _, label in rows)


def test_scores_without_labels(docs, empty, corpus, spark):
    none = spark.createDataFrame([(None, None)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(empty, none).collect() == []
