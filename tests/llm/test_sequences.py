"""Packing, mixing, quality and the pipeline on odd documents."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from palaver.llm import mixing, packing, quality


def test_packing_places_every_token_once(docs, corpus):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    wanted = Counter()
    for doc_id, text, *_ in corpus:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            wanted[doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    found = packing.pack_documents(docs, pieces_per_task=20).collect()
    assert Counter(tuple(r[:5]) for r in found) == wanted
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_lower_bound_holds():
    rng = np.random.default_rng(1)
    for _ in range(200):
        lengths = rng.integers(1, 101, rng.integers(1, 40))
        bins = packing.best_fit_decreasing(lengths, 100)
        assert np.bincount(bins, lengths).max() <= 100
        assert packing.lower_bound(lengths, 100) <= bins.max() + 1
    assert packing.lower_bound(np.array([60, 60, 60]), 100) == 3


def test_mix_meets_its_targets(docs, corpus):
    found = mixing.mix(docs, block=8).collect()
    again = mixing.mix(docs.repartition(3), block=8).collect()
    assert len(found) == len(corpus)
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))
    taken, target = Counter(), {}
    for r in found:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 2 for s in target)


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by the words of the contract: the excess over twice a source's size is shared anew until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full, free = share * sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(full.values())
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level > most * sizes[s] + 1e-9}
        if not above:
            return full | {s: weight[s] * level for s in free}
        full |= {s: most * sizes[s] for s in above}
        free -= above
    return full


def test_targets_equal_a_plain_sharing(spark):
    rng = random.Random(7)
    for n in (1, 2, 3, 8, 25):
        sizes = {f"s{i}" if i else None: rng.choice([0, 1, 10, 500, 100_000]) for i in range(n)}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = {r.source: r.target for r in mixing.source_targets(frame).collect()}
        plain = plain_targets(sizes)
        assert found.keys() == plain.keys()
        assert all(math.isclose(found[s], plain[s], rel_tol=1e-9, abs_tol=1e-6) for s in plain), (sizes, found, plain)


def test_mix_sizes_and_targets_of_odd_documents(docs, corpus):
    found = mixing.mix(docs, block=8).collect()
    counted = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    assert Counter((r.doc_id, r.size) for r in found) == Counter((r[0], counted(r[1])) for r in corpus)
    sizes = Counter()
    for row in corpus:
        sizes[row[3]] += counted(row[1])
    plain = plain_targets(dict(sizes))
    assert all(r.source_size == sizes[r.source] and math.isclose(r.target, plain[r.source]) for r in found)
    assert sum(r.taken for r in found) <= 2 * sum(sizes.values())


def plain_figures(text):
    """The figures of op8 by their definitions."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed,
    )


@pytest.mark.parametrize("place", [quality._PLACE, 62, 3])
def test_quality_figures_equal_plain_ones(spark, docs, corpus, monkeypatch, place):
    """On odd documents; with so few hash bits that different windows clash, and so few place bits that none fit."""
    monkeypatch.setattr(quality, "_PLACE", place)
    rng = random.Random(3)
    more = [(1000 + i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 40)))) for i in range(60)]
    more += [(1, "a\x0bb\x0cc\td\r\ne"), (2, "# * $ % & | < > x\n\n x \nx"), (3, "same line\nsame line\n same line"), (4, "\u00a0 é \u2003 漢 😀" * 20)]
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    rows = [(r[0], r[1]) for r in corpus] + more
    found = quality.figures(frame).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found)
    assert got == Counter((doc_id, *plain_figures(text)) for doc_id, text in rows)
    assert not any(r.kept and r.base_failed for r in found)
    kept = Counter((r.doc_id, r.text) for r in quality.keep(frame).collect())
    assert sum(kept.values()) == sum(r.kept for r in found)


def test_quality_figures_of_nothing(empty):
    assert quality.figures(empty).collect() == []


def test_pipeline_stages_keep_the_columns(spark, docs, empty):
    import corpus_pipeline

    for frame in (docs, empty):
        at = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            at = stage(spark, at, "")
            assert at.columns == docs.columns
            at = spark.createDataFrame(at.collect(), docs.schema)
        rows = corpus_pipeline.STAGES[-1][1](spark, at, "").count()
        assert (rows > 0) == (frame is docs)
