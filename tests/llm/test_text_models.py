"""Language identification and winnowing against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from palaver.llm import language, winnow


def test_language_of_held_out_documents(spark):
    rng = random.Random(1)
    letters = {"aa": "abcde ", "bb": "cdefgh ", "éé": "éèçbd "}
    rows = [(i, "".join(rng.choice(letters[l]) for _ in range(120)), l) for i, l in enumerate(sorted(letters) * 60)]
    found = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in rows)
    held = [(i, l) for i, _, l in rows if found[i].held_out]
    assert sum(found[i].lang_pred == l for i, l in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_odd_texts_get_a_language_or_none(docs, corpus):
    found = language.identify(docs).collect()
    assert len(found) == len(corpus)
    named = {r.doc_id: r for r in found}
    assert all(named[i].lang_pred == "und" and named[i].score == 0 for i in (400, 401, 402))
    assert named[407].lang_pred in ("en", "fr")


def test_language_without_training_rows(spark, empty):
    assert language.identify(empty).collect() == []
    rows = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in language.identify(rows).collect()] == [(1, zlib.crc32(b"1") % 3 == 1, "und", 0.0)]


@pytest.mark.parametrize("many", [3, 700])
def test_equals_plain_naive_bayes(spark, monkeypatch, many):
    """Over few languages, and over more than one table of full width holds."""
    monkeypatch.setattr(language, "TABLE_BYTES", 1 << 22)
    rng = random.Random(many)
    names = [f"l{i:03d}" for i in range(many)]
    rows = [(i, "".join(rng.choice(f"abc{chr(0x100 + i % many)} É") for _ in range(30)), names[i % many]) for i in range(2 * many + 40)]
    found = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    size = language.buckets_for(many)
    assert 4 * size * many <= 1 << 22 or size == language.LEAST_BUCKETS
    train = [(t, l) for i, t, l in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    languages = sorted({l for _, l in train})

    def grams(text):
        low = text.lower()
        return [low[i : i + n] for n in language.ORDERS for i in range(len(low) - n + 1)]

    def bucket(gram):
        value = 0
        for c in gram:
            value = (value * 0x100000001B3 + ord(c)) % 2**64
        return ((value + len(gram)) * 0x9E3779B97F4A7C15 % 2**64 >> 48) % size

    counts = {l: Counter() for l in languages}
    for text, l in train:
        counts[l].update(map(bucket, grams(text)))
    totals = {l: sum(c.values()) + size * language.SMOOTHING for l, c in counts.items()}
    for r in sorted(found, key=lambda r: r.doc_id)[:60]:
        own = [bucket(g) for g in grams(rows[r.doc_id][1])]
        logs = {l: sum(math.log((counts[l][b] + language.SMOOTHING) / totals[l]) for b in own) for l in languages}
        best = max(logs.values())
        share = 1 / sum(math.exp(v - best) for v in logs.values())
        assert logs[r.lang_pred] > best - 1e-3 and math.isclose(r.score, share, rel_tol=1e-2)


def test_only_letters_count_as_letters():
    for text in ("²", "½ 12", "Ⅷ", "①", "_", "12", "", "\u0301", "!?"):
        assert not language.has_letter(text)
    for text in ("a", "½ é", "漢", "ʰ", "ǅ", "_ß_", "ª"):
        assert language.has_letter(text)


def test_buckets_do_not_depend_on_steps(monkeypatch):
    text = "Several words and ÄÖ signs, " * 50
    whole = np.bincount(np.concatenate(list(language.buckets(text))), minlength=language.BUCKETS)
    monkeypatch.setattr(language, "STEP", 97)
    parts = np.bincount(np.concatenate(list(language.buckets(text))), minlength=language.BUCKETS)
    assert (whole == parts).all()


def plain_winnow(codes, gram, window):
    values = [int(winnow._ROLL.grams(winnow._ROLL.sums(codes[i : i + gram]), gram)[0]) >> 20 for i in range(len(codes) - gram + 1)]
    width = min(window, len(values))
    return sorted({min(range(s, s + width), key=lambda i: (values[i], -i)) for s in range(len(values) - width + 1)})


def test_winnow_equals_a_plain_search(monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab cdé") for _ in range(n)) for n in (20, 21, 60, 80, 81, 200, 700)] + ["a" * 300, "ab" * 150]
    for step in (1 << 18, 100):
        monkeypatch.setattr(winnow, "STEP", step)
        for text in texts:
            codes = winnow._codes(text)
            _, places = winnow.winnow(codes)
            assert places.tolist() == plain_winnow(codes, winnow.GRAM, winnow.WINDOW), (step, len(text))


def test_shared_passages_share_a_fingerprint():
    rng = random.Random(6)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    for _ in range(20):
        passage = prose(winnow.WINDOW + winnow.GRAM - 1)
        a, b = (winnow.winnow(winnow._codes(prose(rng.randint(1, 90)) + passage + prose(50)))[0] for _ in range(2))
        assert len(np.intersect1d(a, b))


def test_fingerprints_of_documents_and_their_edits(docs, corpus):
    found = sorted(map(tuple, winnow.fingerprints(docs).collect()), key=repr)
    rows = sorted(((r[0], r[1] or "") for r in corpus), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))
    wanted = []
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, changed, other = (winnow.winnow(winnow._codes(t)) for t in (text, edited, after))
        sets = [set(x[0].tolist()) for x in (own, changed, other)]
        near = [1.0 if not sets[0] | s else len(sets[0] & s) / len(sets[0] | s) for s in sets[1:]]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        wanted.append((doc_id, len(text), digest, winnow.printed(*own), winnow.printed(*changed), *near))
    assert found == sorted(wanted, key=repr)


def test_fingerprints_of_few_documents(spark, empty):
    assert winnow.fingerprints(empty).collect() == []
    one = winnow.fingerprints(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in one] == [(5, 4, hashlib.sha256(b"abab").hexdigest())]


def test_results_do_not_depend_on_ranges(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, f"{i} " + "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 300)))) for i in range(60)]
    rows += [(None, f"same start {rng.random()}") for _ in range(20)] + [(7, None), (7, ""), (7, "zz"), (7, "zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    whole = sorted(map(tuple, winnow.fingerprints(docs).collect()), key=repr)
    for size in (1, 700):
        monkeypatch.setattr(winnow, "RANGE_BYTES", size)
        assert sorted(map(tuple, winnow.fingerprints(docs).collect()), key=repr) == whole
