import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from palaver.llm import variants


def plain_vocabulary(rows, least=7, least_count=2, slips=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]+", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % slips == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least_count}


def near(a, b):
    """Exactly one inserted, deleted or replaced code point, by its definition."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_groups(words, margin=10):
    forms, out = {}, {}
    for w, n in words.items():
        others = [o for o in words if near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best is not None and words[best] >= margin * n else None
        out[w] = len(others)

    def root(w):
        while forms[w] is not None:
            w = forms[w]
        return w

    return sorted((w, forms[w] or "", root(w), n, out[w], words.get(forms[w], 0)) for w, n in words.items())


def rows(frame):
    assert frame.columns[:6] == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in frame.collect())


def vocabulary(seed, size=250):
    """Words with many neighbours, repeated letters and accents; counts that make chains of forms."""
    rng = random.Random(seed)
    words = set()
    stems = ["".join(rng.choice("abàÿ") for _ in range(rng.randint(7, 9))) for _ in range(25)]
    while len(words) < size:
        w = list(rng.choice(stems))
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(len(w))
            edit = rng.randrange(3)
            if edit == 0 and len(w) > 7:
                del w[i]
            elif edit == 1:
                w[i] = rng.choice("abczÀ×ÿ")
            else:
                w.insert(i, rng.choice("abcÿ"))
        words.add("".join(w))
    return {w: rng.choice([2, 2, 3, 25, 30, 300, 3000, 40_000]) for w in words}


@pytest.mark.parametrize("filter_bytes", [variants.FILTER_BYTES, 64, 640])
def test_groups_equal_brute_force(spark, filter_bytes):
    """Also when the filters do not fit one broadcast and are probed a slice at a time."""
    words = vocabulary(filter_bytes)
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows(variants.group_variants(frame, filter_bytes=filter_bytes)) == plain_groups(words)


def test_documents_equal_brute_force(spark, corpus, docs):
    rng = random.Random(8)
    base = ["brother", "brothel", "strängerÿ", "STRANGE", "mountain", "aaaaaaaaa"]
    more = []
    for i in range(300):
        words = [rng.choice(base) if rng.random() < 0.9 else rng.choice(base).replace("r", "", 1) for _ in range(8)]
        more.append((1000 + i, f"{words[0]}. {' '.join(words[1:])}—{words[0].title()}"))
    more += [(None, "brother brother"), (5, None), (6, ""), (7, "ab" * 400 + " " + "ab" * 400), (8, "漢字brotherß"), (8, "brother")]
    frame = spark.createDataFrame(more, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(1))
    got = rows(variants.spelling_variants(frame.repartition(3)))
    words = plain_vocabulary(more)
    assert got == plain_groups(words) and len(got) > 15
    corpus_rows = [(r[0], r[1]) for r in corpus]
    assert rows(variants.spelling_variants(docs)) == plain_groups(plain_vocabulary(corpus_rows))


def test_empty(spark, empty):
    assert rows(variants.spelling_variants(empty)) == []
    none = spark.createDataFrame([(1, "only short words once"), (2, None)], "doc_id long, text string")
    assert rows(variants.spelling_variants(none)) == []


def test_very_long_words(spark):
    """A run of ten thousand letters is a word; its edits are probed a stretch at a time."""
    long = "ab" * 5000
    words = {long: 100, long[:-1]: 2, long[:4000] + "z" + long[4001:]: 3, "a" * 9000: 5, "a" * 9001: 60}
    got = rows(variants.group_variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == plain_groups(words)


def test_rounds_cover_every_block_once():
    counts = {7: 1000, 8: 5, 9: 40_000, 300: 1}
    for room in (64, 1000, 50_000, 1 << 25):
        rounds = variants.rounds_of(counts, room)
        assert all(64 * sum(high - low for low, high in r.values()) <= max(64, room) for r in rounds)
        for length, n in counts.items():
            spans = sorted(r[length] for r in rounds if length in r)
            assert spans[0][0] == 0 and spans[-1][1] == variants.filter_blocks(n)
            assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_filters_lose_no_word_and_let_few_others_through():
    rng = random.Random(2)
    words = list({"".join(rng.choice(variants.LETTERS) for _ in range(8)) for _ in range(4000)})
    known, others = words[:2000], words[2000:]
    blocks = variants.filter_blocks(len(known))
    bits = np.zeros((blocks, 8), np.uint64)
    block, chooser = variants._place(variants._hash_all(known), blocks)
    for w in range(8):
        np.bitwise_or.at(bits[:, w], block.astype(np.int64), variants._bit(chooser, w))
    filters = variants.Filters({8: (blocks, 0, bits.tobytes())})
    assert len(filters.maybe(8, variants._hash_all(known))) == len(known)
    assert len(filters.maybe(8, variants._hash_all(others))) <= 4
    assert len(filters.maybe(9, variants._hash_all(known))) == 0
